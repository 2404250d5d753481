import hashlib
import re

import pytest
from pyspark.sql import functions as F

from railtide.llm import infill

FOLDER = "/root/testdata/sf0.001"


def plain(doc, text, seed=7, rate=100, first=50):
    """(n, form, prefix, middle, output) by plain slices."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def check(rows, got):
    want = []
    for doc, text in rows:
        n, form, p, m, out = plain(doc, text)
        want.append((doc, n, form, p, m, sha(out), sha(text)))
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[c] for c in names)) for r in got)
    return want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = check([(r["doc_id"], r["text"]) for r in docs.collect()], infill.op11(docs).collect())
    assert {w[2] for w in want} >= {"spm", "psm"}


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check([r[:2] for r in odd_rows], infill.op11(odd_docs).collect())
    assert infill.op11(no_docs).collect() == []


def test_markers_breaks_and_signs(docs_of):
    texts = ["\n", "\n\n\n", "a\nb", "a\nb\n", "x <S> y\nz", "<P", "a <\nP> <\nS>", "$1 \\2\n$3 {4}\n(5)\n", "\r\n\r\n", "𝄞\n漢\ń",
             "<M>", "a\x00\nb\x00", "<<\n<<S\n<S", "\\E\n\\Q"]
    rows = [(i, t) for i in range(12) for t in texts]
    check(rows, infill.op11(docs_of(rows)).collect())


def test_very_many_and_very_long_lines(docs_of):
    rows = [(i, "\n".join(f"line {n}" for n in range(200_000))) for i in (1, 2, 3)] + [(4, "x" * 3_000_000), (5, "y\n" * 500_000)]
    check(rows, infill.op11(docs_of(rows)).collect())


@pytest.mark.parametrize("rate, first", [(0, 50), (30, 0), (30, 100)])
def test_rates(docs_of, rate, first):
    rows = [(i, f"a {i}\nb\nc\nd") for i in range(200)]
    got = infill.fill_in_middle(docs_of(rows), rate=rate, suffix_first=first).select("row.doc_id", "form", "output").collect()
    want = {d: plain(d, t, rate=rate, first=first) for d, t in rows}
    assert all((r["form"], r["output"]) == (want[r["doc_id"]][1], want[r["doc_id"]][4]) for r in got)
    assert len(got) == 200


def test_own_units_and_markers(docs_of):
    marks = ("$<p>\\", "[s]*", "(m)")
    rows = [(i, f"one two three {i} four") for i in range(20)]
    done = infill.fill_in_middle(docs_of(rows), unit=r"[^ ]*+ |[^ ]++", markers=marks)
    got = done.select("row.doc_id", "form", "output", infill.restore(F.col("output"), F.col("form"), marks).alias("back")).collect()
    assert {r["doc_id"]: r["back"] for r in got} == dict(rows)
    assert {r["form"] for r in got} == {"psm", "spm"} and all(r["output"].count("(m)") == 1 for r in got)


def test_row_keeps_all_columns(odd_docs, odd_rows):
    out = infill.fill_in_middle(odd_docs).select("row.*")
    assert out.columns == odd_docs.columns and out.count() == len(odd_rows)
