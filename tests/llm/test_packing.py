import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from railtide.llm import packing
from railtide.llm.encode import packed

FOLDER = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, got, window=2048):
    """Every id of every row in one piece, sequences gapless; (padding, sequences)."""
    docs = defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append(ids_of(text))
    assert docs.keys() == want.keys()
    for doc, pieces in docs.items():
        spans = sorted((r["start"], r["start"] + r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces)
        expected = []
        if len(want[doc]) == 1:
            ids = want[doc][0]
            assert spans[0][0] == 0 and spans[-1][1] == len(ids) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            expected = [(s, e, zlib.crc32(struct.pack(f"<{e - s}I", *ids[s:e])), len(ids)) for s, e, _, _ in spans]
            assert spans == expected
        assert sum(r["length"] for r in pieces) == sum(map(len, want[doc]))
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, len(sequences)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    padding, _ = check(rows, packing.op13(docs.repartition(3)).collect())
    assert padding == 0


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert check([r[:2] for r in odd_rows], packing.op13(odd_docs).collect())[0] == 0
    assert packing.op13(no_docs).collect() == []


def slow_choice(counts, size, window):
    """The level with the least sum of squares by trying all; the fullest of equals, a new window last."""
    found = []
    for level in range(window - size + 1):
        if level and not counts[level]:
            continue
        after = counts.copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        found.append((int((after[1:window] ** 2).sum()), level == 0, -level))
    return -min(found)[2]


@pytest.mark.parametrize("seed", range(4))
def test_least_sum_of_squares(seed):
    rng, levels = random.Random(seed), packing.Levels(24)
    for _ in range(400):
        size = rng.randrange(1, 25)
        level = levels.choose(size)
        assert level == slow_choice(levels.counts, size, 24)
        if level:
            levels.take(level)
        levels.put(level + size, 0)
    assert levels.counts[:24].sum() == levels.total == sum(map(len, levels.open))


@pytest.mark.parametrize("sizes", [[1500] * 500, [1] * 3000, [2048, 4096, 1], [2047, 2, 2047], [5], list(range(1, 600))])
@pytest.mark.parametrize("most_open", [1, 8, 1024])
def test_any_sizes_without_padding(sizes, most_open):
    packer = packing.Packer(2048, most_open, 5)
    out = []
    for row, n in enumerate(sizes):
        out += packer.add(row, packed(np.arange(n) + row))
        assert packer.levels.total == len(packer.held) <= most_open
    out += packer.close()
    fills, docs = defaultdict(int), defaultdict(bytes)
    for row, start, name, offset, ids in sorted(out, key=lambda p: (p[2], p[3])):
        assert offset == fills[name]
        fills[name] += len(ids) // 4
    for row, start, _, _, ids in sorted(out, key=lambda p: (p[0], p[1])):
        assert start == len(docs[row]) // 4
        docs[row] += ids
    assert [docs[r] for r in range(len(sizes))] == [packed(np.arange(n) + r) for r, n in enumerate(sizes)]
    assert all(n == 2048 or n & (n - 1) == 0 for n in fills.values()) and sum(n < 2048 for n in fills.values()) <= 11
