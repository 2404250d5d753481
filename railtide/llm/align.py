"""Cross-tokenizer alignment: token ranges of two tokenizers coalesced into groups that end together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.encode import byte_ids, odd_pattern, piece_ids
from railtide.session import cut_lineage

A_TOKENIZER = "byte_bpe_50k.json"
B_TOKENIZER = "piece_bpe_32k.model"
# bytes of text that are aligned together; bounds the memory of a task
CHUNK_BYTES = 2_000_000
# links expanded at a time
LINKS_AT_ONCE = 2_000_000
I64 = np.int64


def coalesce(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A and each B token, from 0 on; both lists cover the same bytes without gaps.

    All tokens are sorted by start.  Where a start reaches the largest end before it, no token of
    either side lies across: a group ends there.
    """
    ends = np.concatenate([np.cumsum(a_lengths), np.cumsum(b_lengths)])
    starts = ends - np.concatenate([a_lengths, b_lengths])
    side = np.repeat(np.array([0, 1], np.int8), [len(a_lengths), len(b_lengths)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), dtype=I64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), dtype=I64)
    groups[order] = np.cumsum(breaks) - 1
    return groups[: len(a_lengths)], groups[len(a_lengths) :]


def tally(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and the sum of their weights (1 each)."""
    if not len(keys):
        return keys, np.zeros(0, I64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    if weights is None:
        return ordered[at], np.diff(np.append(at, len(keys)))
    return ordered[at], np.add.reduceat(weights[order], at)


def linked(a_groups, a_ids, b_groups, b_ids, doc_of_group, a_size: int, b_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different (document, id pair) keys and their number of links.

    A pair is a * b_size + b, a key is document * a_size * b_size + pair.  Ids that repeat in a group are counted before A and B meet,
    and the meetings are expanded in slices, so a long group needs no memory for its square.
    """
    span = I64(1 << 32)
    a_key, a_times = tally(a_groups * span + a_ids)
    b_key, b_times = tally(b_groups * span + b_ids)
    a_group, b_group = a_key // span, b_key // span
    held = np.bincount(b_group)
    first = np.cumsum(held) - held
    fan = held[a_group]
    reach = np.cumsum(fan)
    keys, weights, at = [], [], 0
    while at < len(a_key):
        done = reach[at - 1] if at else 0
        to = max(int(np.searchsorted(reach, done + LINKS_AT_ONCE, side="right")), at + 1)
        part = fan[at:to]
        a = np.repeat(np.arange(at, to), part)
        b = np.arange(len(a)) - np.repeat(np.cumsum(part) - part, part) + np.repeat(first[a_group[at:to]], part)
        doc = doc_of_group[a_group[a]]
        found = tally((doc * a_size + a_key[a] % span) * b_size + b_key[b] % span, a_times[a] * b_times[b])
        keys.append(found[0])
        weights.append(found[1])
        at = to
    if not keys:
        return np.zeros(0, I64), np.zeros(0, I64)
    return tally(np.concatenate(keys), np.concatenate(weights)) if len(keys) > 1 else (keys[0], weights[0])


class Chunk:
    """Some documents' tokens, aligned; documents that cannot be aligned have none."""

    def __init__(self, texts: list[str | None], a, b):
        a_parts, b_parts = [], []
        for text in texts:
            found = (b"", b"")
            if text:
                raw = f" {text}".encode("utf-8", "surrogatepass")
                a.exact = b.exact = True
                tokens = a.ids(f" {text}"), b.ids(text)
                if a.covers(tokens[0], raw) and b.covers(tokens[1], raw):
                    found = tokens
            a_parts.append(found[0])
            b_parts.append(found[1])
        self.n_a = np.fromiter((len(p) // 4 for p in a_parts), I64, len(texts))
        self.n_b = np.fromiter((len(p) // 4 for p in b_parts), I64, len(texts))
        self.a_ids = np.frombuffer(b"".join(a_parts), "<u4").astype(I64)
        self.b_ids = np.frombuffer(b"".join(b_parts), "<u4").astype(I64)
        self.a_sizes, self.b_sizes = lengths_of(a), lengths_of(b)
        self.a_groups, self.b_groups = coalesce(self.a_sizes[self.a_ids], self.b_sizes[self.b_ids])
        self.a_held, self.b_held = np.bincount(self.a_groups), np.bincount(self.b_groups)
        # documents end where tokens of both sides end, so a group lies in one document
        a_first = np.cumsum(self.a_held) - self.a_held
        self.doc_of_group = np.searchsorted(np.cumsum(self.n_a), a_first, side="right")
        self.n_groups = np.bincount(self.doc_of_group, minlength=len(texts)).astype(I64)
        self.n_links = np.zeros(len(texts), I64)
        np.add.at(self.n_links, self.doc_of_group, self.a_held * self.b_held)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, links of that pair there), in order of the first two."""
        size = len(self.a_sizes) * len(self.b_sizes)
        keys, times = linked(
            self.a_groups, self.a_ids, self.b_groups, self.b_ids, self.doc_of_group, len(self.a_sizes), len(self.b_sizes)
        )
        return keys // size, keys % size, times

    def groups(self) -> Iterator[str]:
        """Per document its groups: A ids, ``|``, B ids, with commas between ids and ``;`` between groups."""
        a_first, b_first = np.cumsum(self.a_held) - self.a_held, np.cumsum(self.b_held) - self.b_held
        start = a_first + b_first
        place = np.arange(len(self.a_ids)) - a_first[self.a_groups]
        codes = np.empty(len(self.a_ids) + len(self.b_ids), I64)
        codes[start[self.a_groups] + place] = 3 * self.a_ids + (place + 1 == self.a_held[self.a_groups])
        place = np.arange(len(self.b_ids)) - b_first[self.b_groups]
        codes[start[self.b_groups] + self.a_held[self.b_groups] + place] = (
            3 * self.b_ids + 2 * (place + 1 == self.b_held[self.b_groups])
        )
        written = _written(max(len(self.a_sizes), len(self.b_sizes))).__getitem__
        ends = np.cumsum(self.n_a + self.n_b)
        for end, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist()):
            yield "".join(map(written, codes[end - n : end].tolist()))[:-1]


_lengths: dict[int, np.ndarray] = {}
_texts: dict[int, list[str]] = {}


def lengths_of(encoder) -> np.ndarray:
    """Bytes of each id."""
    if id(encoder) not in _lengths:
        _lengths[id(encoder)] = np.fromiter(map(len, encoder.token_bytes), I64)
    return _lengths[id(encoder)]


def _written(size: int) -> list[str]:
    """Each id with each of the three marks that may follow it."""
    if size not in _texts:
        _texts[size] = [f"{i}{mark}" for i in range(size) for mark in ",|;"]
    return _texts[size]


def _squeezed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _spread(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * count, codec="zstd", asbytes=True), "<i4").astype(I64)


def _chunks(batches, limit: int) -> Iterator[tuple[list, list[str | None]]]:
    """Keys and texts in runs of about ``limit`` bytes; a longer text is a run of its own."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            more = 4 * len(text or "") if text and not text.isascii() else len(text or "")
            if keys and size + more > limit:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += more
    if keys:
        yield keys, texts


DOC_FIELDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, held int"


def aligned_chunks(docs: DataFrame, text: str = "text", key: str = "doc_id", a_tokenizer: str = A_TOKENIZER,
                   b_tokenizer: str = B_TOKENIZER, whole_groups: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per run of documents of a scan partition, written to the checkpoint folder.

    (chunk, docs, pairs, holders, places, times): the documents' own numbers and groups (as text, or
    their SHA-256), the run's different id pairs with the number of its documents that hold them,
    and per document the places of its pairs in that list with their numbers of links.
    """
    kind = docs.schema[key].dataType.simpleString()
    fields = f"key {kind}, {DOC_FIELDS}"
    schema = (
        f"chunk bigint, docs array<struct<{fields.replace(' ', ':', 1).replace(', ', ',').replace(' ', ':')}>>, "
        "pairs array<bigint>, holders array<int>, places binary, times binary"
    )

    def run(batches):
        from pyspark import TaskContext

        a, b = byte_ids(a_tokenizer, special=False, odd=odd), piece_ids(b_tokenizer)
        number = TaskContext.get().partitionId() << 32
        for keys, texts in _chunks(batches, chunk_bytes):
            done = Chunk(texts, a, b)
            doc, pair, times = done.pairs()
            pairs, places, holders = np.unique(pair, return_inverse=True, return_counts=True)
            rows = [
                {"key": k, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "held": held,
                 "groups": g if whole_groups or not g else hashlib.sha256(g.encode()).hexdigest()}
                for k, n_a, n_b, n_groups, n_links, held, g in zip(
                    keys, done.n_a.tolist(), done.n_b.tolist(), done.n_groups.tolist(), done.n_links.tolist(),
                    np.bincount(doc, minlength=len(keys)).tolist(), done.groups())
            ]
            yield pa.RecordBatch.from_pylist([{
                "chunk": number, "docs": rows, "pairs": pairs, "holders": holders.astype(np.int32),
                "places": _squeezed(np.diff(places, prepend=0)), "times": _squeezed(times),
            }], schema=arrow)
            number += 1

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    odd = odd_pattern(a_tokenizer)
    return cut_lineage(docs.select(F.col(key), F.col(text)).mapInArrow(run, schema))


def pair_counts(chunks: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best) of every id pair: documents that hold it linked, and whether no other pair of its A id has more.

    Runs' own counts are summed, so a pair that every document holds has one row per run.
    """
    held = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("at")).select("at.pairs", "at.holders")
    totals = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n"))
    totals = cut_lineage(totals.withColumn("a", F.floor(F.col("pair") / b_size)))
    most = totals.groupBy("a").agg(F.max("n").alias("most"))
    return totals.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, text: str = "text", key: str = "doc_id", a_tokenizer: str = A_TOKENIZER,
          b_tokenizer: str = B_TOKENIZER, whole_groups: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row of ``docs``.

    Both tokenizers cover a blank and the text.  Groups are the shortest byte ranges in which tokens
    of both begin and end; every A token of a group is linked to every B token of it.  A pair's
    count is the number of rows, copies included, that hold it linked; ``n_best`` counts the links
    whose pair has the largest count of its A id, ties included.  ``groups`` is text such as
    ``a1,a2|b1;a3|b2`` or its SHA-256.  NULL and empty texts, and texts that a tokenizer does not
    give back byte by byte, have no tokens: zeros and ''.  NULL keys stay, repeated rows have
    a row each, an empty table gives an empty result.

    Texts are encoded once and never shuffled: runs of about ``chunk_bytes`` send their different
    pairs to be summed, and get those pairs' counts back.
    """
    chunks = aligned_chunks(docs, text, key, a_tokenizer, b_tokenizer, whole_groups, chunk_bytes)
    counts = pair_counts(chunks, len(piece_ids(b_tokenizer).token_bytes))
    own = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    back = own.join(counts, "pair").groupBy("chunk").agg(F.collect_list(F.struct("place", "n", "best")).alias("counts"))
    kind = docs.schema[key].dataType.simpleString()
    out = f"{key} {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(0)[i].values
                n_docs = len(rows)
                held = rows.field("held").to_numpy()
                best, total = np.zeros(n_docs, I64), np.zeros(n_docs, I64)
                if held.sum():
                    found = batch.column(3)[i].values
                    at = found.field("place").to_numpy()
                    count, top = np.empty(len(at), I64), np.empty(len(at), bool)
                    count[at] = found.field("n").to_numpy()
                    top[at] = found.field("best").to_numpy(zero_copy_only=False)
                    places = np.cumsum(_spread(batch.column(1)[i].as_py(), held.sum()))
                    times = _spread(batch.column(2)[i].as_py(), held.sum())
                    doc = np.repeat(np.arange(n_docs), held)
                    np.add.at(best, doc, times * top[places])
                    np.add.at(total, doc, times * count[places])
                yield pa.RecordBatch.from_arrays(
                    [rows.field("key"), *(rows.field(f) for f in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(best), pa.array(total), rows.field("groups")],
                    names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
                )

    met = chunks.select("chunk", "docs", "places", "times").join(back, "chunk", "left")
    return met.select("docs", "places", "times", "counts").mapInArrow(finish, out)


def op12(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return align(docs.select("doc_id", "text"), whole_groups=False).withColumnRenamed("groups", "groups_sha256")
