import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from railtide.llm import align, encode

FOLDER = "/root/testdata/sf0.001"
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


LETTERS = byte_letters()


def tokens(text):
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(f" {text}", add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def slow_groups(text):
    """Groups of ids between the places where tokens of both sides end."""
    if not text:
        return []
    a, b = tokens(text)
    raw = f" {text}".encode()
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return []
    ends_a = list(itertools.accumulate(len(t) for _, t in a))
    ends_b = list(itertools.accumulate(len(t) for _, t in b))
    cuts = sorted(set(ends_a) & set(ends_b))
    out, before = [], 0
    for cut in cuts:
        out.append(([i for (i, _), e in zip(a, ends_a) if before < e <= cut], [i for (i, _), e in zip(b, ends_b) if before < e <= cut]))
        before = cut
    return out


def slow(rows):
    """Result rows by plain loops."""
    found, holders = [], Counter()
    for _, text in rows:
        groups = slow_groups(text)
        links = Counter(p for a, b in groups for p in itertools.product(a, b))
        holders.update(links.keys())
        found.append((groups, links))
    most = Counter()
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, _), (groups, links) in zip(rows, found):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if holders[p] == most[p[0]]), sum(n * holders[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def check(rows, got):
    assert sorted(map(repr, slow(rows))) == sorted(repr(tuple(r[c] for c in NAMES)) for r in got)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"] if len(r["text"] or "") < 20_000 else None) for r in docs.collect()]
    check(rows, align.op12(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 20_000]
    short = odd_docs.where("text is null or length(text) < 20000")
    check(rows, align.op12(short).collect())
    assert align.op12(no_docs).collect() == []


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\t", "\n", "▁", "é", "漢", "<s>", "<|endoftext|>", "0x41", "<0x41>", "'s", "ß", "　", "=", "ﬁ", "the", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_blanks_marks_and_specials(spark):
    rows = list(enumerate(odd_texts(1) + ["a ", " ", "   ", "=" * 3000, " " * 999 + "x", "<unk>", "a▁b"]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    check(rows, align.op12(df).collect())


def test_small_chunks_and_slices(spark, monkeypatch):
    rows = list(enumerate(odd_texts(2, 120))) + [(7, "the cat sat on the mat") for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = align.align(df, chunk_bytes=50, whole_groups=True).collect()
    hashed = [r.asDict() | {"groups_sha256": hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""} for r in got]
    check(rows, hashed)


@pytest.mark.parametrize("at_once", [1, 3, 50])
def test_long_groups_in_slices(monkeypatch, at_once):
    monkeypatch.setattr(align, "LINKS_AT_ONCE", at_once)
    rng = random.Random(at_once)
    a_groups, b_groups = np.repeat(np.arange(4), [5, 1, 9, 3]), np.repeat(np.arange(4), [2, 1, 7, 8])
    a_ids, b_ids = np.array([rng.randrange(4) for _ in a_groups]), np.array([rng.randrange(3) for _ in b_groups])
    doc = np.array([0, 0, 1, 1])
    keys, times = align.linked(a_groups, a_ids, b_groups, b_ids, doc, 10, 7)
    want = Counter()
    for g, i in zip(a_groups, a_ids):
        for h, j in zip(b_groups, b_ids):
            if g == h:
                want[(doc[g] * 10 + i) * 7 + j] += 1
    assert dict(zip(keys.tolist(), times.tolist())) == want and keys.tolist() == sorted(keys.tolist())


def test_groups_end_where_both_sides_end():
    a, b = align.coalesce(np.array([2, 2, 1, 3]), np.array([1, 3, 2, 2]))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1, 1]


@pytest.mark.parametrize("entries", [7, 10_000])
def test_cached_ids_equal_the_libraries(entries):
    odd = encode.odd_pattern("byte_bpe_50k.json")
    a, c = (encode.ByteIds("byte_bpe_50k.json", special, odd, entries) for special in (False, True))
    b = encode.PieceIds("piece_bpe_32k.model", entries)
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in odd_texts(3, 1500) + ["ՠ x ꟓ", "a\U0001f600 ok"]:
        assert a.ids(text) == encode.packed(A.encode(text, add_special_tokens=False).ids)
        assert b.ids(text) == encode.packed(B.encode(text))
        assert c.ids(text) == encode.packed(default.encode(text, add_special_tokens=False).ids)
