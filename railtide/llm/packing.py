"""Packing of token sequences into windows by sums of squares, as documents come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.encode import byte_ids, odd_pattern, packed

TOKENIZER = "byte_bpe_50k.json"
WINDOW = 2048
END = 1
# partially filled windows that a task keeps; beyond them a document is cut to fill the fullest one
MOST_OPEN = 1024
WIDTH = 4
# pre-tokens whose ids a worker remembers
CACHE_ENTRIES = 600_000


class Levels:
    """Partially filled windows by fill level.

    ``counts[h]`` is their number at level h, 0 < h < window; full and empty windows count nothing.
    """

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(window)]
        self.total = 0

    def choose(self, size: int) -> int:
        """Level to place ``size`` tokens at, 0 for a new window, that leaves the least sum of squared counts.

        Leaving level h takes 2 counts[h] - 1 off the sum, entering one adds 2 counts + 1, filling a
        window adds nothing.  Of equal sums the fullest level counts, a new window last.
        """
        room = self.window - size
        levels = np.flatnonzero(self.counts[: room + 1])
        after = 2 * self.counts[levels + size] + 1
        if len(levels) and levels[-1] == room:
            after[-1] = 0
        change = after - 2 * self.counts[levels] + 1
        fresh = 2 * self.counts[size] + 1 if size < self.window else 0
        if not len(levels):
            return 0
        at = len(change) - 1 - int(np.argmin(change[::-1]))
        return int(levels[at]) if change[at] <= fresh else 0

    def fullest(self) -> int:
        return int(np.flatnonzero(self.counts)[-1])

    def take(self, level: int) -> int:
        """A window at a level, which leaves it."""
        self.counts[level] -= 1
        self.total -= 1
        return self.open[level].pop()

    def put(self, level: int, window: int) -> None:
        if level < self.window:
            self.counts[level] += 1
            self.total += 1
            self.open[level].append(window)


class Packer:
    """Windows of one task; pieces are (row, start, sequence, offset, ids)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN, first: int = 0):
        self.window, self.most_open = window, most_open
        self.levels = Levels(window)
        self.next = first
        # pieces of partially filled windows; they leave when a window is full
        self.held: dict[int, list[tuple]] = {}

    def _into(self, level: int, row, start: int, ids: bytes) -> Iterator[tuple]:
        """Append to a window at a level (0: a new one); a full window is handed out."""
        if level:
            name = self.levels.take(level)
        else:
            name, self.next = self.next, self.next + 1
        pieces = self.held.pop(name, [])
        pieces.append((row, start, name, level, ids))
        fill = level + len(ids) // WIDTH
        if fill == self.window:
            yield from pieces
        else:
            self.held[name] = pieces
            self.levels.put(fill, name)

    def add(self, row, ids: bytes) -> Iterator[tuple]:
        """Pieces of windows that this document fills.  Whole windows are cut off, what is left is placed."""
        size, start = len(ids) // WIDTH, 0
        while size - start >= self.window:
            yield from self._into(0, row, start, ids[start * WIDTH : (start + self.window) * WIDTH])
            start += self.window
        while start < size:
            level = self.levels.choose(size - start)
            if not level and self.levels.total >= self.most_open:
                level = self.levels.fullest()
            end = min(size, start + self.window - level)
            yield from self._into(level, row, start, ids[start * WIDTH : end * WIDTH])
            start = end

    def close(self) -> Iterator[tuple]:
        """What is left: the emptiest windows are cut up to fill the others, the last one ends in powers of two.

        A sequence whose length is a power of two needs no padding.
        """
        left = sorted(self.held.items(), key=lambda item: -sum(len(p[4]) for p in item[1]))
        fills = [sum(len(p[4]) for p in pieces) // WIDTH for _, pieces in left]
        rest = sum(fills)
        # windows kept open to be filled; the others give what fills them
        keep = rest // self.window
        todo = [(row, start, ids) for _, pieces in left[keep:] for row, start, _, _, ids in pieces]
        targets = [(name, fill, self.window) for (name, _), fill in zip(left[:keep], fills)]
        for _, pieces in left[:keep]:
            yield from pieces
        rest -= keep * self.window
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                targets.append((self.next, 0, 1 << bit))
                self.next += 1
        todo.reverse()
        for name, fill, end in targets:
            while fill < end:
                row, start, ids = todo.pop()
                fits = min(len(ids) // WIDTH, end - fill)
                yield row, start, name, fill, ids[: fits * WIDTH]
                fill += fits
                if fits * WIDTH < len(ids):
                    todo.append((row, start + fits, ids[fits * WIDTH :]))
        self.held, self.levels = {}, Levels(self.window)


def pack_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str = TOKENIZER, end: int = END,
                window: int = WINDOW, most_open: int = MOST_OPEN) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): pieces of documents in sequences of ``window``.

    A document is its tokens and the id ``end``; NULL and empty texts are that id alone.  Every id
    lies in one piece.  ``ids`` are unsigned 32-bit numbers, little end first.  Each partition of
    the scan packs its own documents in the order they come, and keeps at most ``most_open``
    partially filled windows in memory; only their last ones are shorter than ``window``, each a power of two,
    so nothing is padded.  Sequence ids are unique, with gaps between partitions.  NULL keys
    stay, repeated rows are packed each, an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    last, odd = packed([end]), odd_pattern(tokenizer)

    def run(batches):
        from pyspark import TaskContext

        encoder = byte_ids(tokenizer, odd=odd, entries=CACHE_ENTRIES)
        packer = Packer(window, most_open, TaskContext.get().partitionId() << 33)

        def batch_of(pieces, key_type):
            rows, start, sequence, offset, ids = zip(*pieces)
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // WIDTH
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], key_type), pa.array(start, pa.int64()), pa.array(length),
                pa.array(ids, pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()),
            ], names=names)

        def pieces():
            for batch in batches:
                kinds.append(batch.schema.field(0).type)
                for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encoder.ids(value.as_py() or "") + last
                    yield from packer.add((name, len(ids) // WIDTH), ids)
            yield from packer.close()

        kinds: list = []
        held: list = []
        for piece in pieces():
            held.append(piece)
            if len(held) == 4096:
                yield batch_of(held, kinds[-1])
                held = []
        if held:
            yield batch_of(held, kinds[-1])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def op13(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return pack_tokens(docs.select("doc_id", "text")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
