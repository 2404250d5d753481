"""SimHash near-dedup: a byte-position inverted index with count filtering."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from railtide.llm.components import components
from railtide.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BYTES = 8
U64 = np.uint64
LOW32 = np.uint64(0xFFFFFFFF)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; no words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=U64)
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(U64)[0])


def fingerprint_column(shingle_words: int = SHINGLE_WORDS):
    """A Column function: text to its fingerprint as a signed bigint; NULL is the empty text."""
    @pandas_udf("long")
    def run(values: pd.Series) -> pd.Series:
        prints = np.fromiter((fingerprint(v, shingle_words) for v in values), dtype=U64, count=len(values))
        return pd.Series(prints.view(np.int64))

    return lambda value: run(F.coalesce(value, F.lit("")))


def posting_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks of the byte positions of each postings list.

    Two prints that differ in at most ``max_bits`` bits share at least 8 - max_bits positional
    bytes, so they meet in the list of the positions they share.
    """
    need = BYTES - max_bits
    return [sum(0xFF << 8 * p for p in chosen) for chosen in itertools.combinations(range(BYTES), need)]


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of positional bytes that two arrays of prints share."""
    same = (a ^ b).view(np.uint8).reshape(-1, BYTES) == 0
    return same.sum(axis=1)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally of shared positional bytes first, then the differing bits of what reaches the minimum."""
    out = np.zeros(len(a), dtype=bool)
    enough = np.flatnonzero(shared_bytes(a, b) >= BYTES - max_bits)
    out[enough] = np.bitwise_count(a[enough] ^ b[enough]) <= max_bits
    return out


def _spanning(members: np.ndarray, max_bits: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within one postings list: fewer than it has members.

    Grows each component from its first member; a member is compared with those not yet reached,
    so no list of pairs is ever made.  A list holds at most 2 ** (8 * max_bits) different prints.
    """
    left = members.copy()
    sources, targets = [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            part, front = front[:block], front[block:]
            from_ = np.zeros(len(left), dtype=np.int64) - 1
            for i, p in enumerate(part):
                hit = (from_ < 0) & (np.bitwise_count(left ^ p) <= max_bits)
                from_[hit] = i
            reached = from_ >= 0
            sources.append(part[from_[reached]])
            targets.append(left[reached])
            front = np.concatenate([front, left[reached]])
            left = left[~reached]
    if not sources:
        return members[:0], members[:0]
    return np.concatenate(sources), np.concatenate(targets)


def _links_in_lists(max_bits: int):
    """Batches of (list, key, print) sorted by list and key, to links inside each postings list."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held_key, held = None, []

        def flush():
            if held_key is not None and sum(map(len, held)) > 1:
                return _spanning(np.unique(np.concatenate(held)), max_bits)
            return None

        def batch_of(parts):
            parts = [p for p in parts if p is not None and len(p[0])]
            if parts:
                a = np.concatenate([p[0] for p in parts]).view(np.int64)
                b = np.concatenate([p[1] for p in parts]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0).to_numpy(zero_copy_only=False)
            key = batch.column(1).to_numpy(zero_copy_only=False)
            prints = batch.column(2).to_numpy(zero_copy_only=False).view(U64)
            cut = np.flatnonzero((place[1:] != place[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.append(0, cut), np.append(cut, len(key))
            found = []
            this = (place[0], key[0])
            if held_key is not None and held_key != this:
                found.append(flush())
                held = []
            held_key = this
            held.append(prints[starts[0] : ends[0]])
            if len(starts) > 1:
                found.append(flush())
                size = ends - starts
                inner = np.arange(1, len(starts) - 1)
                twos = inner[size[inner] == 2]
                if len(twos):  # most lists: one pair
                    a, b = prints[starts[twos]], prints[starts[twos] + 1]
                    ok = (a != b) & _near(a, b, max_bits)
                    found.append((a[ok], b[ok]))
                for i in inner[size[inner] > 2]:
                    found.append(_spanning(np.unique(prints[starts[i] : ends[i]]), max_bits))
                held_key, held = (place[-1], key[-1]), [prints[starts[-1] : ends[-1]]]
            yield from batch_of(found)
        yield from batch_of([flush()])

    return run


def near_links(prints: DataFrame, column: str = "print", max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between different prints with at most ``max_bits`` differing bits.

    Everything that is linked is joined by these links, but not every linked pair is listed: each
    postings list gives a spanning forest of its own.  ``prints`` holds each print once.
    """
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in posting_masks(max_bits)]
    lists = F.array(*[
        F.struct(F.lit(i).cast("short").alias("place"), F.col("print").bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
        for i, m in enumerate(masks)
    ])
    posted = (
        prints.select(F.col(column).alias("print")).select("print", F.explode(lists).alias("at"))
        .select(F.col("at.place").alias("place"), F.col("at.key").alias("key"), "print")
    )
    # a list holds at most 2 ** 24 different prints, whatever the corpus: bounded for one task
    met = posted.repartition("place", "key").sortWithinPartitions("place", "key")
    return met.mapInArrow(_links_in_lists(max_bits), "a bigint, b bigint").distinct()


def print_roots(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``nodes``, which holds each ``print`` once, with the ``root`` of its component."""
    roots = components(near_links(nodes, "print", max_bits))
    return nodes.join(roots, nodes["print"] == roots["node"], "left").select(*[nodes[c] for c in nodes.columns], F.coalesce("root", "print").alias("root"))


def near_components(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(key, print, component): the smallest key reachable over links of at most ``max_bits`` bits.

    Equal prints are linked, also those of texts without words (print 0).  Repeated rows stay as
    often as they come, NULL keys are ignored when the smallest key is sought (a component of NULL
    keys alone has NULL).  Only (key, print) leaves the scan; copies meet as one print before the
    index is built, so groups of copies cost one entry.
    """
    rows = cut_lineage(docs.select(F.col(key).alias("key"), fingerprint_column(shingle_words)(F.col(text)).alias("print")))
    joined = print_roots(cut_lineage(rows.groupBy("print").agg(F.min("key").alias("least"))), max_bits)
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    member = joined.join(smallest, "root").select("print", "component")
    return rows.join(member, "print").select(F.col("key").alias(key), "print", "component")


def op10(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return near_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near copies, that of the smallest key; same columns.

    Groups are the components of ``near_components``.  Rows are told apart by key and text, so two
    texts under one key are dropped only where each is near another: of equal keys the smallest text
    digest stays, of rows equal in both any one.  NULL is the empty text; texts without words are
    copies of each other.  Rows without a key stay, as nothing tells which of them is first, and
    displace nothing.  An empty table stays empty.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = cut_lineage(docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), digest.alias("digest"), fingerprint_column(shingle_words)(F.col(text)).alias("print")
    ))
    joined = print_roots(cut_lineage(rows.groupBy("print").agg(F.min(F.struct("key", "digest")).alias("least"))), max_bits)
    first = joined.groupBy("root").agg(F.min("least").alias("least")).select("least.key", "least.digest")
    held = docs.where(F.col(key).isNotNull()).select(F.struct("*").alias("row"), F.col(key).alias("key"), digest.alias("digest"))
    # a digest belongs to one group and so to one first row; repeats of that row are cut before the shuffle
    once = Window.partitionBy("key", "digest").orderBy("key")
    met = held.join(first, ["key", "digest"], "left_semi").withColumn("place", F.row_number().over(once)).where("place = 1")
    return met.select("row.*").unionByName(docs.where(F.col(key).isNull()))
