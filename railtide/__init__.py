"""Spark operators for messy-sheet loading, announcement triage and weather upkeep."""
