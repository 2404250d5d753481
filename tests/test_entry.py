"""The entry module works without what only the corpus operations need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), 'keyword_gate' in e.queries())"


@pytest.mark.parametrize("hidden", ["xxhash", "regex", "corpus_pipeline", "railtide.llm"])
def test_other_queries_stay(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; {COUNT}"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    count, rest = out.split(" ", 1)
    assert rest.strip() == "[] True" and int(count) >= 80
