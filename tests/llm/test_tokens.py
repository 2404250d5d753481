import public_tokenizers
import pytest
from tokenizers import Tokenizer

from railtide.llm import tokens

FOLDER = "/root/testdata/sf0.001"


def library(texts, name="byte_bpe_50k.json"):
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    return [len(whole.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r["doc_id"]: r for r in tokens.op9(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert [got[r["doc_id"]]["n_tokens"] for r in rows] == library([r["text"] for r in rows])
    assert all(got[r["doc_id"]]["n_bytes"] == len((r["text"] or "").encode()) for r in rows)


def test_odd_texts(odd_docs, odd_rows):
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in tokens.op9(odd_docs).collect())
    assert got == sorted((str(r[0]), n) for r, n in zip(odd_rows, library([r[1] for r in odd_rows])))


@pytest.mark.parametrize("table", [0, 8])
def test_white_space_contractions_and_new_letters(spark, docs_of, table):
    texts = ["a   b", "  lead", "tail  ", "it's 'S ''s don't", "x\r\n\r\n y", "a　b", "1½²", "<|endoftext|><|endoftext|> z",
             "<|endoftext", "\U0001f600 ok", "ꟓ꟔ new", "ՠ x ᲀ", "-- ... !!??", "\x00\x1f\x85 q"]
    df = tokens.count_tokens(docs_of(list(enumerate(texts))), entries=max(table, 1), rows=max(table, 1))
    got = {r["doc_id"]: r["n_tokens"] for r in df.collect()}
    assert [got[i] for i in range(len(texts))] == library(texts)


def test_other_tokenizers_go_through_the_library(docs_of):
    texts = ["Hello there", "the the THE", ""]
    df = tokens.count_tokens(docs_of(list(enumerate(texts))), tokenizer="word_bpe_49k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in df.collect()}
    assert [got[i] for i in range(3)] == library(texts, "word_bpe_49k.json")


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    counts = tokens.Counts("byte_bpe_50k.json")
    texts = ["alpha beta gamma delta epsilon zeta", "eta theta iota kappa"]
    assert [counts.count(t) for t in texts * 2] == library(texts * 2)
    assert len(counts) <= 4


def test_empty_table(no_docs):
    assert tokens.op9(no_docs).collect() == []


def test_every_partition_names_frequent_pieces(spark):
    texts = [("red " * 30 + "rare", 1), ("blue " * 20, 2), ("green " * 40, 3), (None, 4)]
    df = spark.createDataFrame(texts, "text string, part int").repartitionByRange(4, "part")
    found = tokens.frequent_pieces(df, "text", "byte_bpe_50k.json", rows=1, entries=3)
    assert set(found) == {" red", " blue", " green"} and all(n == 1 for n in found.values())
