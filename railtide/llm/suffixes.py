"""Suffix order by two-stage sorting, with numpy inside a task."""

from __future__ import annotations

import numpy as np

# symbols are bytes plus one; zero ends a string
ENDS = 257
PER_WORD = 7
SYMBOL_BITS = 9


def symbols(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all strings, each ended by zero; place where each starts)."""
    sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    starts = np.cumsum(sizes + 1) - sizes - 1
    sym = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.uint16) + np.uint16(1)
    sym[starts + sizes] = 0
    return sym, starts


def packed(sym: np.ndarray, depth: int) -> np.ndarray:
    """Seven symbols from each place in one number that sorts as they do; zeros follow the end."""
    wide = np.concatenate([sym, np.zeros(depth + 2 * PER_WORD, dtype=np.uint16)]).astype(np.int64)
    size = len(wide) - PER_WORD
    out = np.zeros(size, dtype=np.int64)
    for i in range(PER_WORD):
        out <<= SYMBOL_BITS
        out |= wide[i : i + size]
    return out


def ascending(sym: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts a symbol later."""
    if not len(sym):
        return np.zeros(0, dtype=bool)
    turn = np.flatnonzero(sym[1:] != sym[:-1])
    lengths = np.diff(np.concatenate([[-1], turn, [len(sym) - 1]]))
    return np.repeat(np.append(sym[turn] < sym[turn + 1], False), lengths)


def sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ``at`` in the order of their first ``depth`` symbols, seven at a time; only ties go on."""
    if not len(at):
        return at
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    head = np.append(True, key[1:] != key[:-1])
    for done in range(PER_WORD, depth, PER_WORD):
        tied = np.flatnonzero(~head | ~np.append(head[1:], True))
        if not len(tied):
            break
        group = np.cumsum(head)[tied]
        key = words[at[tied] + done]
        order = np.lexsort((key, group))
        at[tied] = at[tied][order]
        key = key[order]
        head[tied] |= np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))
    return at


def suffix_order(sym: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes, ordered by their first ``depth`` symbols at least.

    Only suffixes smaller than their successors are sorted.  The others follow from a scan of the
    buckets of first symbols in order: a suffix that has its place gives the next place in its
    bucket to the suffix that starts a symbol before it.
    """
    if not len(sym):
        return np.zeros(0, dtype=np.int64)
    small = ascending(sym)
    direct = sort_directly(np.flatnonzero(small), words, depth)
    first = np.searchsorted(sym[direct], np.arange(ENDS + 1))
    induced: list[list[np.ndarray]] = [[] for _ in range(ENDS)]
    out = []

    def induce(placed: np.ndarray, bucket: int) -> np.ndarray:
        """Deal the larger neighbours of placed suffixes to their buckets; returns those of this bucket."""
        before = placed[placed > 0] - 1
        before = before[~small[before]]
        symbol = sym[before]
        same = before[symbol == bucket]
        before, symbol = before[symbol != bucket], symbol[symbol != bucket]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for part in np.split(before, cuts):
            if len(part):
                induced[sym[part[0]]].append(part)
        return same

    induced[sym[-1]].append(np.array([len(sym) - 1]))
    for bucket in range(ENDS):
        wave = np.concatenate(induced[bucket]) if induced[bucket] else np.zeros(0, dtype=np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, bucket)
        own = direct[first[bucket] : first[bucket + 1]]
        if len(own):
            out.append(own)
            induce(own, bucket)
    return np.concatenate(out)


def share_prefix(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """True where a suffix shares its first ``depth`` symbols with the one before it in ``order``."""
    same = np.zeros(len(order), dtype=bool)
    left = np.arange(1, len(order))
    for at in [*range(0, depth - PER_WORD, PER_WORD), depth - PER_WORD]:
        left = left[words[order[left] + at] == words[order[left - 1] + at]]
    same[left] = True
    return same
