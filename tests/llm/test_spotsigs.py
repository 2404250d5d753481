import hashlib
import re

import pytest

from railtide.llm import spotsigs

FOLDER = "/root/testdata/sf0.001"


def slow_signatures(text):
    found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    out = set()
    for i, w in enumerate(found):
        if w in spotsigs.ANCHORS:
            chain = [c for c in found[i + 1 :] if c not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add(" ".join([w, *chain]))
    return out or ({" ".join(found)} if found else set())


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(df, rows):
    order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    got = {r["doc_id"]: r for r in df.collect()}
    assert len(got) == len(rows)
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        mine, changed, following = map(slow_signatures, (text, edited, after))
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == hashlib.sha256("\n".join(sorted(mine)).encode()).hexdigest()
        assert r["edited_fingerprint"] == hashlib.sha256("\n".join(sorted(changed)).encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(mine, changed))
        assert r["near_next"] == pytest.approx(alike(mine, following))


@pytest.mark.parametrize("rows_a_range", [3, 1000])
def test_whole_table(spark, monkeypatch, rows_a_range):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", rows_a_range)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check(spotsigs.op1(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("rows", [
    [(1, "The cat sat on the mat by a door")], [(1, None), (2, "")], [(5, "the a of"), (None, "x y the z w"), (9, "x" * 50_000)],
    [(-4, "a b c"), (0, "\U0001f600é the ñandú corre hoy"), (7, "the the of red green"), (8, "!!")],
])
def test_small_tables(docs_of, rows):
    check(spotsigs.op1(docs_of(rows)), rows)


def test_repeated_rows_and_clashing_names(odd_docs, odd_rows, no_docs):
    got = spotsigs.op1(odd_docs).collect()
    assert len(got) == len(odd_rows)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (6, 7)}
    assert len(same) == 1
    assert spotsigs.op1(no_docs).collect() == []


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_near_pairs_against_all_pairs(spark, threshold):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sets = {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        signed = frozenset(slow_signatures(r["text"] or ""))
        if signed and signed not in sets.values():
            sets[r["doc_id"]] = signed
    expected = {(a, b): alike(sets[a], sets[b]) for a in sets for b in sets if a < b and alike(sets[a], sets[b]) >= threshold}
    got = {(r["a"], r["b"]): r["likeness"] for r in spotsigs.near_pairs(docs, threshold).collect()}
    assert got == pytest.approx(expected)
    assert expected or threshold == 0.8


def test_near_pairs_of_odd_rows(odd_docs, no_docs):
    assert all(r["a"] < r["b"] for r in spotsigs.near_pairs(odd_docs).collect())
    assert spotsigs.near_pairs(no_docs).collect() == []
