"""Removal of long byte strings that occur earlier in the corpus, exact over all documents.

1. Each window of LENGTH bytes has an anchor, the smallest hash of its GRAM-byte strings.  Equal
   windows have equal anchors at equal places, so windows are dealt by the anchor's hash and no
   row per byte is ever made: about one row per forty bytes is.
2. A stretch of windows with one anchor that occurs before as a whole goes as a whole.
3. Stretches that share an anchor but differ are cut out of their texts and put in suffix order
   (two-stage sorting) with all others of that anchor; windows that share LENGTH bytes are then
   neighbours, and all but the first in the corpus go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.suffixes import packed, share_prefix, suffix_order, symbols
from railtide.llm.wordhash import U64, mix
from railtide.operators.ids import number_rows
from railtide.session import cut_lineage

LENGTH = 100
# bytes of an anchor; a multiple of 8
GRAM = 24
CHUNK_BYTES = 2_000_000
# different stretches of one anchor that one task puts in suffix order; more are compared by
# 128-bit names of their windows, which spread over all tasks
MOST_STRETCHES = 8_192

SMALLEST = -(1 << 63)
STRETCH = pa.schema([("v", pa.int64()), ("c", pa.int64()), ("ident", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
FOUND = pa.schema([("v", pa.int64()), ("ident", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
CUT = pa.schema([("v", pa.int64()), ("ident", pa.int64()), ("start", pa.int32()), ("bytes", pa.binary())])
NAME = pa.schema([("v", pa.int64()), ("c", pa.int64()), ("ident", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
FOUND_SQL = "v bigint, ident bigint, start int, stop int"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each place."""
    count = len(data) - GRAM + 1
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = np.full(count, 0x9E3779B97F4A7C15, dtype=U64)
    for at in range(0, GRAM, 8):
        out ^= eight[at : at + count]
        out *= U64(0xBF58476D1CE4E5B9)
        out ^= out >> U64(29)
    return mix(out)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours from each place, by doubling."""
    size, reach = len(values) - width + 1, 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:size], values[width - reach : width - reach + size])


def stretches(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, start, stop, anchor hash, content hash) of the stretches of windows with one anchor."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = b"".join(texts)
    empty = np.zeros(0, dtype=np.int64)
    if len(joined) < LENGTH:
        return empty, empty, empty, empty, empty
    data = np.frombuffer(joined, dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    hashes = _gram_hashes(data)
    # high half of the hash, then the place: ties go to the leftmost
    ranked = hashes >> U64(32) << U64(32) | np.arange(len(hashes), dtype=U64)
    anchor = (_sliding_least(ranked, LENGTH - GRAM + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    long = sizes >= LENGTH
    mark = np.zeros(len(data) + 1, dtype=np.int8)
    mark[begin[long]] += 1
    mark[begin[long] + sizes[long] - LENGTH + 1] -= 1
    window = np.flatnonzero(np.cumsum(mark[: len(anchor)], dtype=np.int8))
    if not len(window):
        return empty, empty, empty, empty, empty
    own = anchor[window]
    head = np.append(True, own[1:] != own[:-1])
    start = window[head]
    stop = window[np.append(np.flatnonzero(head)[1:], len(window)) - 1] + LENGTH
    view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(view[a:b]) for a, b in zip(start.tolist(), stop.tolist())), dtype=U64, count=len(start))
    text = np.searchsorted(begin, start, side="right") - 1
    # empty texts share their beginning with the next one, which is the last of them
    return text, start - begin[text], stop - begin[text], hashes[own[head]].view(np.int64), content.view(np.int64)


def _merged(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of one text as one; all in order."""
    if not len(text):
        return text, start, stop
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    # a running maximum within each text: texts are kept apart by an offset
    base = (np.cumsum(np.append(0, text[1:] != text[:-1])) * (int(stop.max()) + 1)).astype(np.int64)
    reach = np.maximum.accumulate(stop + base)
    head = np.append(True, (start[1:] + base[1:] > reach[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(head)
    return text[first], start[first], np.maximum.reduceat(stop + base, first) - base[first]


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _texts(batches, column: int = 1):
    """Runs of (ident, text bytes) of about CHUNK_BYTES."""
    idents, texts, size = [], [], 0
    for batch in batches:
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(column).to_pylist()):
            idents.append(ident)
            texts.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield np.array(idents, dtype=np.int64), texts
                idents, texts, size = [], [], 0
    if texts:
        yield np.array(idents, dtype=np.int64), texts


def _emit_stretches(batches):
    """Stretches of the texts.  What repeats within the run already is gone: its rows have no anchor."""
    for idents, texts in _texts(batches):
        text, start, stop, v, c = stretches(texts)
        if not len(text):
            continue
        order = np.lexsort((start, idents[text], c, v))
        text, start, stop, v, c = (x[order] for x in (text, start, stop, v, c))
        again = np.append(False, (v[1:] == v[:-1]) & (c[1:] == c[:-1]))
        yield _batch(STRETCH, v[~again], c[~again], idents[text[~again]], start[~again], stop[~again])
        gone, a, b = _merged(text[again], start[again], stop[again])
        if len(gone):
            # dealt evenly by their own hash; NULL contents tell them apart
            own = mix(idents[gone].view(U64) + a.astype(U64)).view(np.int64)
            yield _batch(STRETCH, own, pa.nulls(len(gone), pa.int64()), idents[gone], a, b)


def _resolve(batches):
    """Of stretches sorted by (v, c, ident, start): spans that repeat as a whole (no v), and the
    first of each content where an anchor has several (with v)."""
    held = None  # the last first-of-its-content, whose successor is not known yet: (v, c, ident, start, stop, asked)
    last = None  # (v, c) of the last row
    for batch in batches:
        if not batch.num_rows:
            continue
        table = [batch.column(i) for i in range(5)]
        gone = table[1].is_null().to_numpy(zero_copy_only=False)
        v, ident, start, stop = (table[i].to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2, 3, 4))
        c = table[1].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if gone.any():
            yield _batch(FOUND, pa.nulls(int(gone.sum()), pa.int64()), ident[gone], start[gone], stop[gone])
            v, c, ident, start, stop = (x[~gone] for x in (v, c, ident, start, stop))
        if not len(v):
            continue
        new = np.append(last is None or last != (v[0], c[0]), (v[1:] != v[:-1]) | (c[1:] != c[:-1]))
        last = (v[-1], c[-1])
        if not new.all():
            again = ~new
            yield _batch(FOUND, pa.nulls(int(again.sum()), pa.int64()), ident[again], start[again], stop[again])
        v, ident, start, stop = v[new], ident[new], start[new], stop[new]
        if not len(v):
            continue
        like_next = np.append(v[1:] == v[:-1], False)
        like_before = np.append(held is not None and held[0] == v[0], like_next[:-1])
        if held is not None and (held[4] or like_before[0]):
            yield _batch(FOUND, [held[0]], [held[1]], [held[2]], [held[3]])
        asked = like_next | like_before
        ready = asked.copy()
        ready[-1] = False
        if ready.any():
            yield _batch(FOUND, v[ready], ident[ready], start[ready], stop[ready])
        held = (v[-1], ident[-1], start[-1], stop[-1], bool(asked[-1]))
    if held is not None and held[4]:
        yield _batch(FOUND, [held[0]], [held[1]], [held[2]], [held[3]])


def _pack(batches):
    """(ident, key, text) with texts compressed, for the shuffle."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed_texts = [packer.compress(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed_texts, type=pa.binary())], names=["ident", "key", "packed"]
        )


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def _emit_cuts(batches):
    """Bytes of the stretches asked for."""
    for batch in batches:
        out = ([], [], [], [])
        for ident, data, asked in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = _unpack(data)
            for part in asked:
                for column, value in zip(out, (part["v"], ident, part["start"], text[part["start"] : part["stop"]])):
                    column.append(value)
        yield _batch(CUT, *out)


def repeated_windows(idents: np.ndarray, starts: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, ...]:
    """(ident, start, stop) of the windows in ``strings`` that also occur in an earlier one.

    Strings are stretches: no window occurs twice in one, and (ident, start) orders them.
    """
    order = np.lexsort((starts, idents))
    idents, starts, strings = idents[order], starts[order], [strings[i] for i in order]
    sym, begin = symbols(strings)
    words = packed(sym, LENGTH)
    sizes = np.diff(np.append(begin, len(sym))) - 1
    string = np.repeat(np.arange(len(strings)), sizes + 1)
    inside = np.arange(len(sym)) - begin[string]
    suffixes = suffix_order(sym, words, LENGTH)
    suffixes = suffixes[inside[suffixes] + LENGTH <= sizes[string[suffixes]]]
    if not len(suffixes):
        return idents[:0], starts[:0], starts[:0]
    head = np.flatnonzero(~share_prefix(suffixes, words, LENGTH))
    rank = string[suffixes]
    least = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(rank))))
    gone = suffixes[rank != least]
    one, at = string[gone], inside[gone]
    text, a, b = _merged(one, at, at + LENGTH)
    return idents[text], starts[text] + a, starts[text] + b


def _sort_suffixes(batches):
    """Repeated windows of cuts sorted by v; whole anchors are put in order together, in runs of CHUNK_BYTES."""
    held = ([], [], [], [])
    size = 0

    def solve(count: int):
        nonlocal held, size
        _, ident, start, data = (x[:count] for x in held)
        held = tuple(x[count:] for x in held)
        size = sum(map(len, held[3]))
        i, a, b = repeated_windows(np.array(ident, dtype=np.int64), np.array(start, dtype=np.int64), data)
        return _batch(FOUND, pa.nulls(len(i), pa.int64()), i, a, b)

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if size >= CHUNK_BYTES and row[0] != held[0][-1]:
                yield solve(len(held[0]))
            for column, value in zip(held, row):
                column.append(value)
            size += len(row[3])
    if held[0]:
        yield solve(len(held[0]))


def _name_windows(batches):
    """128-bit names of all windows of cuts."""
    for batch in batches:
        for _, ident, start, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            names = [xxhash.xxh3_128_digest(data[i : i + LENGTH]) for i in range(len(data) - LENGTH + 1)]
            both = np.frombuffer(b"".join(names), dtype=np.int64).reshape(-1, 2)
            at = np.arange(len(names)) + start
            yield _batch(NAME, both[:, 0], both[:, 1], np.full(len(at), ident), at, at + LENGTH)


def _later_windows(batches):
    """Windows sorted by (v, c, ident, start) whose name the row before has."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        v, c, ident, start, stop = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        again = np.append(last == (v[0], c[0]), (v[1:] == v[:-1]) & (c[1:] == c[:-1]))
        last = (v[-1], c[-1])
        yield _batch(FOUND, pa.nulls(int(again.sum()), pa.int64()), ident[again], start[again], stop[again])


def _keep(batches):
    """What is left of each text: (key, n_bytes, spans, kept)."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        out = ([], [], [], [])
        for key, data, one, two in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text, merged = _unpack(data), []
            for part in sorted([*(one or ()), *(two or ())], key=lambda p: p["start"]):
                if merged and part["start"] <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], part["stop"])
                else:
                    merged.append({"start": part["start"], "stop": part["stop"]})
            edges = [0, *(x for p in merged for x in (p["start"], p["stop"])), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for column, value in zip(out, (key, len(text), merged, kept)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], spans_type), pa.array(out[3], pa.binary())],
            names=["key", "n_bytes", "spans", "kept"],
        )


def _by_document(found: DataFrame) -> DataFrame:
    """(ident, asked, gone): spans of each document, as many as its text has room for."""
    part = F.struct("v", "start", "stop")
    listed = found.groupBy("ident").agg(F.collect_list(part).alias("parts"))
    return listed.select(
        "ident", F.filter("parts", lambda p: p["v"].isNotNull()).alias("asked"), F.filter("parts", lambda p: p["v"].isNull()).alias("gone")
    )


def _with_ident(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(ident, key, data) of all rows, and (ident, data) of each document once.

    ident orders documents as the key does; NULL keys come first.  Where keys repeat, rows are
    numbered by (key, text) instead, and rows equal in both are one document.
    """
    rows = docs.select(
        F.coalesce(F.col(key), F.lit(SMALLEST)).alias("ident"), F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
    )
    if rows.groupBy("ident").count().where("count > 1").isEmpty():
        return rows, rows.select("ident", "data")
    named = rows.withColumn("digest", F.unhex(F.md5("data")))
    numbers = number_rows(named.select("ident", "digest").distinct(), ["ident", "digest"], "number")
    numbered = named.join(numbers, ["ident", "digest"]).select(F.col("number").alias("ident"), "key", "data")
    return numbered, numbered.select("ident", "data").dropDuplicates(["ident"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, spans, kept): each text without the bytes of strings of LENGTH bytes that start earlier.

    Earlier means a smaller key, or the same text at an earlier place.  Strings are judged on the
    input; spans are the maximal runs removed, in bytes; ``kept`` is what is left and need not be
    valid UTF-8.  NULL is the empty text, which keeps nothing and loses nothing.
    """
    rows, places = _with_ident(docs, text, key)
    dealt = (
        places.mapInArrow(_emit_stretches, "v bigint, c bigint, ident bigint, start int, stop int")
        .repartition("v").sortWithinPartitions("v", "c", "ident", "start")
    )
    first = cut_lineage(_by_document(dealt.mapInArrow(_resolve, FOUND_SQL)))
    asked = first.where(F.size("asked") > 0).select(F.col("ident").alias("_ident"), "asked")
    packed = "ident bigint, key bigint, packed binary"
    once = places.select("ident", F.col("ident").alias("key"), "data").mapInArrow(_pack, packed)
    cuts = (
        once.join(asked, F.col("ident") == F.col("_ident")).select("ident", "packed", "asked")
        .mapInArrow(_emit_cuts, "v bigint, ident bigint, start int, bytes binary")
    )
    often = asked.select(F.explode("asked.v").alias("often")).groupBy("often").count().where(F.col("count") > MOST_STRETCHES)
    often = cut_lineage(often.select("often"))
    rare = cuts
    found = []
    if not often.isEmpty():
        rare = cuts.join(often, cuts["v"] == often["often"], "left_anti")
        named = (
            cuts.join(often, cuts["v"] == often["often"], "left_semi")
            .mapInArrow(_name_windows, "v bigint, c bigint, ident bigint, start int, stop int")
            .repartition("v", "c").sortWithinPartitions("v", "c", "ident", "start")
        )
        found.append(named.mapInArrow(_later_windows, FOUND_SQL))
    found.append(rare.repartition("v").sortWithinPartitions("v").mapInArrow(_sort_suffixes, FOUND_SQL))
    late = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    second = cut_lineage(_by_document(late)).select(F.col("ident").alias("_late"), F.col("gone").alias("late"))
    early = first.select(F.col("ident").alias("_early"), F.col("gone").alias("early"))
    spans = early.join(second, F.col("_early") == F.col("_late"), "left").select("_early", "early", "late")
    met = rows.mapInArrow(_pack, packed).join(spans, F.col("ident") == F.col("_early"), "left").select("key", "packed", "early", "late")
    kept = met.mapInArrow(_keep, "key bigint, n_bytes bigint, spans array<struct<start:int,stop:int>>, kept binary")
    return kept.withColumnRenamed("key", key)


def op3(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
