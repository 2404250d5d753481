"""Every registered query with, where SQL can say it, its equivalent in SQL."""

from railtide.registry import announcements, jobs, loads, sheets, texts, weather  # noqa: F401
from railtide.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
