"""Hashed words of many texts at once, with numpy inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# bytes of text that are hashed together; bounds the memory of a task whatever the batch size
CHUNK_BYTES = 4_000_000

SPACE, WORD, MARK = 0, 1, 2

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    x ^= x >> U64(31)
    return x


def _classes() -> np.ndarray:
    out = np.full(256, MARK, dtype=np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        out[first : last + 1] = WORD
    return out


CLASS = _classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE_CODE = mix(np.arange(1, 257, dtype=U64))
STEP = U64(0x9E3779B97F4A7C15)


def chunks(texts: Sequence[str], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts as UTF-8, in runs of about ``limit`` bytes; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if run and size + len(data) > limit:
            yield run
            run, size = [], 0
        run.append(data)
        size += len(data)
    if run:
        yield run


def words_of(run: Sequence[bytes], fold: bool = False, marks: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, place of its text in ``run``).

    A word is a run of letters, digits and bytes above 127; with ``marks`` a run of other visible
    bytes is one too.  ``fold`` lower-cases A-Z.
    """
    if not run:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    data = np.frombuffer(b"\n".join(run) + b"\n", dtype=np.uint8)
    ends_of_text = np.cumsum(np.fromiter((len(r) + 1 for r in run), dtype=np.int64, count=len(run)))
    kind = CLASS[data]
    if not marks:
        kind = np.where(kind == MARK, np.uint8(SPACE), kind)
    if fold:
        data = LOWER[data]
    change = np.empty(len(data), dtype=bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    edges = np.flatnonzero(change)
    keep = kind[edges] != SPACE
    starts = edges[keep]
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(edges, len(data)))
    place = np.arange(len(data), dtype=np.int64) - np.repeat(edges, lengths)
    power = np.cumprod(np.full(int(lengths.max()) + 1, STEP, dtype=U64))
    codes = BYTE_CODE[data]
    codes *= power[place]
    codes[kind == SPACE] = 0
    # each sum runs to the next word's start; what lies between is zero
    hashes = mix(np.add.reduceat(codes, starts))
    return hashes, np.searchsorted(ends_of_text, starts, side="right")


def pairs_of(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each pair of neighbouring words, place of its text)."""
    same = owner[1:] == owner[:-1]
    both = mix(words[:-1] * U64(3) + (words[1:] ^ STEP))
    return both[same], owner[1:][same]
