"""Cross-entropy difference of matched target and background n-gram models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from railtide.llm.wordhash import STEP, U64, chunks, mix, words_of
from railtide.session import cut_lineage

# words met fewer times in the whole corpus are one unknown word
LEAST_COUNT = 2
# pull of word pairs towards the single word's probability
PULL = 4.0
UNKNOWN, START = U64(1), U64(2)
# Documents are counted in chunks of so many bytes of text, before anything is shuffled
CHUNK_BYTES = 8_000_000
# what a document adds to its chunk beside its bytes, so that empty texts fill chunks too
DOCUMENT_BYTES = 64
# Counts are summed in ranges of the 64-bit hashes, one range at a time in a task: there are more
# ranges the more entries the corpus gives, about so many entries each
RANGE_ENTRIES = 2_000_000


def _pack(values: np.ndarray) -> bytes:
    """Compressed with equal bytes of all values side by side."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=U64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, U64), dtype=U64)


def _rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}


def _counts(place: np.ndarray, size: int, weights: np.ndarray) -> np.ndarray:
    return np.bincount(place, weights, minlength=size).astype(np.int64)


def _chunked(docs: DataFrame) -> DataFrame:
    """Rows of (key, text) to one row per CHUNK_BYTES of text: keys and lengths of its documents, its
    different words and, per token, which of them it is.

    Tokens name words by their place in descending frequency, which compresses best; ``order`` has
    the place of each among the sorted words.
    """
    document = StructType().add("key", docs.schema["key"].dataType).add("n", LongType())
    schema = (
        StructType().add("chunk", LongType()).add("docs", ArrayType(document)).add("words", BinaryType()).add("tokens", BinaryType())
        .add("order", BinaryType()).add("n_words", LongType()).add("n_tokens", LongType()).add("starts", LongType())
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    listed = arrow.field("docs").type

    def row(number, keys, run):
        found, lengths = [], []
        for part in chunks(run):
            words, owner = words_of(part, fold=True, marks=False)
            found.append(words)
            lengths.append(np.bincount(owner, minlength=len(part)))
        lengths = np.concatenate(lengths).astype(np.int64)
        words, tokens, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        held = pa.StructArray.from_arrays([pa.concat_arrays(keys).cast(listed.value_type[0].type), pa.array(lengths)], fields=list(listed.value_type))
        values = [
            pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(run)], pa.int32()), held).cast(listed),
            *[pa.array([v], pa.binary()) for v in (_pack_keys(words), _pack(rank[tokens]), _pack(order.astype(np.uint32)))],
            *[pa.array([int(v)], pa.int64()) for v in (len(words), len(tokens), np.count_nonzero(lengths))],
        ]
        return pa.RecordBatch.from_arrays(values, schema=arrow)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        keys, texts, size = [], [], 0
        for batch in batches:
            first = 0
            for at, (text, n) in enumerate(zip(batch.column(1).to_pylist(), pc.binary_length(batch.column(1)).to_pylist())):
                if texts and size + n > CHUNK_BYTES:
                    yield row(number, [*keys, batch.column(0).slice(first, at - first)], texts)
                    keys, texts, size, first, number = [], [], 0, at, number + 1
                texts.append(text)
                size += n + DOCUMENT_BYTES
            keys.append(batch.column(0).slice(first))
        if texts:
            yield row(number, keys, texts)

    return docs.mapInArrow(run, schema)


PARTS = pa.schema([("chunk", pa.int64()), ("range", pa.int32()), ("keys", pa.binary()), ("target", pa.binary()), ("all", pa.binary())])
SUMS = pa.schema([("chunk", pa.int64()), ("range", pa.int32()), ("target", pa.binary()), ("all", pa.binary()), ("known", pa.int64())])
PARTS_DDL = "chunk long, range int, keys binary, target binary, all binary"
SUMS_DDL = "chunk long, range int, target binary, all binary, known long"


def _parts(chunk: int, ranges: int, keys: np.ndarray, target: np.ndarray, every: np.ndarray, first: int = 0) -> pa.RecordBatch:
    """Counts of a chunk by sorted key, cut at the bounds of the ranges, which are numbered from ``first``."""
    place = (keys >> U64(32)) * U64(ranges) >> U64(32)
    cuts = np.append(np.append(0, np.flatnonzero(place[1:] != place[:-1]) + 1), len(keys))
    spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
    return pa.RecordBatch.from_arrays([
        pa.array([chunk] * len(spans), pa.int64()), pa.array([first + int(place[s.start]) for s in spans], pa.int32()),
        pa.array([_pack_keys(keys[s]) for s in spans], pa.binary()), pa.array([_pack(target[s].astype(np.uint32)) for s in spans], pa.binary()),
        pa.array([_pack(every[s].astype(np.uint32)) for s in spans], pa.binary()),
    ], schema=PARTS)


def _summed(parts: DataFrame) -> DataFrame:
    """For each chunk, in the order of its own keys, the counts of all other chunks: exact, and zero
    for a key that no other chunk has, which compression leaves next to nothing of.

    Of every range there is one row more, without a chunk: the number of keys with LEAST_COUNT or more.
    """
    def of_range(number, held):
        keys = [_unpack_keys(k) for _, k, _, _ in held]
        own = [[_unpack(h[i], np.uint32).astype(np.int64) for h in held] for i in (2, 3)]
        ends = np.cumsum([0, *map(len, keys)])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        size = int(place.max()) + 1
        target, every = (_counts(place, size, np.concatenate(o)) for o in own)
        known = int(np.count_nonzero(every >= LEAST_COUNT))
        spans = [place[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return pa.RecordBatch.from_arrays([
            pa.array([None, *(h[0] for h in held)], pa.int64()), pa.array([number] * (len(held) + 1), pa.int32()),
            *[pa.array([None, *(_pack(sums[s] - o) for s, o in zip(spans, mine))], pa.binary()) for sums, mine in zip((target, every), own)],
            pa.array([known] + [None] * len(held), pa.int64()),
        ], schema=SUMS)

    def run(batches):
        number, held = None, []
        for r in _rows(batches):
            if held and r["range"].as_py() != number:
                yield of_range(number, held)
                held = []
            number = r["range"].as_py()
            held.append((r["chunk"].as_py(), r["keys"].as_py(), r["target"].as_py(), r["all"].as_py()))
        if held:
            yield of_range(number, held)

    return parts.repartition("range").sortWithinPartitions("range").mapInArrow(run, SUMS_DDL)


def _by_chunk(sums: DataFrame, name: str) -> DataFrame:
    """One row per chunk: its sums in the order of the ranges, which is that of its keys."""
    return sums.where("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "target", "all"))).alias(name))


def _joined(got: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    rows = got.as_py() or []
    return tuple(np.concatenate([np.zeros(0, np.int64), *(_unpack(r[m], np.int64) for r in rows)]) for m in ("target", "all"))


def _ranges(entries: int | None) -> int:
    return max(1, -(-(entries or 0) // RANGE_ENTRIES))


def _words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Different words of a chunk, sorted, and which of them each token is."""
    return _unpack_keys(row["words"].as_py()), _unpack(row["order"].as_py(), np.uint32)[_unpack(row["tokens"].as_py(), np.uint32)]


class _Chunk:
    """Tokens of a chunk after rare words have become one: single words and pairs with the word before."""

    def __init__(self, row: dict):
        self.number = row["chunk"].as_py()
        words, tokens = _words(row)
        self.keys, lengths = row["docs"].values.flatten()
        self.lengths = lengths.to_numpy()
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        flags = np.zeros(len(self.lengths), dtype=np.int64)
        flags[row["places"].as_py() or []] = 1
        counts = np.bincount(tokens, minlength=len(words)) + _joined(row["word_sums"])[1]
        self.singles, place = np.unique(np.where(counts < LEAST_COUNT, UNKNOWN, words), return_inverse=True)
        self.single = place[tokens]
        word = self.singles[self.single]
        self.opens = np.append(True, self.owner[1:] != self.owner[:-1])[: len(word)]
        before = np.append(START, word[:-1])[: len(word)].astype(U64)
        before[self.opens] = START
        self.pairs, self.pair = np.unique(mix(before * U64(3) + (word ^ STEP)), return_inverse=True)
        target = flags[self.owner]
        self.own_pairs, self.own_singles = (
            (_counts(at, len(keys), target), np.bincount(at, minlength=len(keys)))
            for at, keys in ((self.pair, self.pairs), (self.single, self.singles))
        )


def score_documents(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, score): bits per token and their difference.

    ``target`` (key) names the documents of the target model, the background is every document.
    The models match in vocabulary, order and smoothing, so the difference of their losses is about
    the texts.  Counts of words and of word pairs are exact (by 64-bit hash) and grow with the
    corpus: each chunk of documents adds up its words and sends the sums to ranges of hashes, which
    send back what the other chunks have; that tells rare words.  Then it does the same with words and
    pairs of both models.  No model is held as a whole anywhere, and texts do not move: target
    documents are found by key, their places go to the chunks.

    A low score means closer to the target than to the corpus.  Tokens are lower-cased words; texts
    without any (NULL, empty, punctuation) have losses and score 0.  Equal texts score alike, repeated
    rows stay and are counted as often as they come, NULL keys are never in the target.
    """
    chosen = target.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    held = cut_lineage(_chunked(docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))))
    size = held.agg(*[F.sum(c).alias(c) for c in ("n_words", "n_tokens", "starts")]).first()
    places = cut_lineage(
        held.select("chunk", F.posexplode("docs").alias("place", "doc")).select("chunk", "place", "doc.key", "doc.n").join(chosen, "key", "left_semi")
        .groupBy("chunk").agg(F.collect_list("place").alias("places"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("starts"))
    )
    aim = places.agg(F.sum("n").alias("n_tokens"), F.sum("starts").alias("starts")).first()
    totals, starts = ((aim[c] or 0, size[c] or 0) for c in ("n_tokens", "starts"))
    word_ranges, pair_ranges = _ranges(size["n_words"]), _ranges(size["n_tokens"])

    def word_parts(batches):
        for r in _rows(batches):
            words, tokens = _words(r)
            if len(words):
                counts = np.bincount(tokens, minlength=len(words))
                yield _parts(r["chunk"].as_py(), word_ranges, words, np.zeros_like(counts), counts)

    def both_parts(batches):
        for r in _rows(batches):
            c = _Chunk(r)
            if len(c.pairs):
                yield _parts(c.number, pair_ranges, c.pairs, *c.own_pairs)
                yield _parts(c.number, word_ranges, c.singles, *c.own_singles, first=pair_ranges)

    content = held.select("chunk", "docs", "words", "tokens", "order")
    word_sums = cut_lineage(_summed(content.mapInArrow(word_parts, PARTS_DDL)))
    known = word_sums.agg(F.sum("known").alias("n")).first()["n"] or 0
    told = content.join(places.select("chunk", "places"), "chunk", "left").join(_by_chunk(word_sums, "word_sums"), "chunk", "left")
    both_sums = _by_chunk(_summed(told.mapInArrow(both_parts, PARTS_DDL)), "both_sums")

    kind = docs.schema[key].dataType
    schema = StructType().add("key", kind).add("n_tokens", LongType()).add("target_loss", DoubleType()).add("background_loss", DoubleType())
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def losses(batches):
        for r in _rows(batches):
            c = _Chunk(r)
            others, out = _joined(r["both_sums"]), []
            for m in (0, 1):
                pairs = others[m][: len(c.pairs)] + c.own_pairs[m]
                word = (others[m][len(c.pairs) :] + c.own_singles[m])[c.single].astype(float)
                before = np.append(0.0, word[:-1])[: len(word)]
                before[c.opens] = starts[m]
                single = (word + 1.0) / (totals[m] + known + 1.0)
                p = (pairs[c.pair] + PULL * single) / (before + PULL)
                out.append(np.bincount(c.owner, -np.log2(p), minlength=len(c.lengths)) / np.maximum(c.lengths, 1))
            yield pa.RecordBatch.from_arrays([c.keys.cast(arrow[0].type), pa.array(c.lengths), *map(pa.array, out)], schema=arrow)

    scored = told.join(both_sums, "chunk", "left").mapInArrow(losses, schema)
    return scored.select(
        F.col("key").alias(key), "n_tokens", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"),
    )


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Result of the registered query: documents labelled as good are the target."""
    return score_documents(docs, labels.where("quality = 1").select("doc_id"))
