"""Keyword lists looked up together: one automaton over the words of all groups, one pass over a text."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from railtide.functions.text import contains_any

# groups that one bigint tells apart
MASK_BITS = 63


class Automaton:
    """Words of numbered groups as one goto and fail table; a text is read once, whatever the lists hold.

    A worker builds it when it first meets the lists and keeps it.
    """

    def __init__(self, groups: Sequence[Sequence[str]]):
        import ahocorasick

        masks: dict[str, int] = {}
        for bit, words in enumerate(groups):
            for word in words:
                masks[word.casefold()] = masks.get(word.casefold(), 0) | 1 << bit
        # the empty word is in every text
        self.always = masks.pop("", 0)
        self.full = functools.reduce(int.__or__, masks.values(), self.always)
        self.table = ahocorasick.Automaton()
        for word, mask in masks.items():
            self.table.add_word(word, mask)
        if masks:
            self.table.make_automaton()

    def mask(self, text: str) -> int:
        """Bits of the groups of which a word occurs; stops once all have been met."""
        found = self.always
        if found != self.full:
            for _, bits in self.table.iter(text):
                found |= bits
                if found == self.full:
                    break
        return found


@functools.cache
def automaton(groups: tuple[tuple[str, ...], ...]) -> Automaton:
    return Automaton(groups)


@functools.cache
def _mask_udf(groups: tuple[tuple[str, ...], ...]):
    @F.pandas_udf(LongType())
    def mask(values: pd.Series) -> pd.Series:
        of = automaton(groups).mask
        return pd.Series([None if v is None else of(v) for v in values], dtype="Int64")

    return mask


def group_mask(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """A bit per group, in order, set if any of its words occurs in ``text`` (already folded); NULL for NULL.

    Words match inside other words too.  At most ``MASK_BITS`` groups; a group without words never matches.
    """
    if len(groups) > MASK_BITS:
        raise ValueError(f"{len(groups)} groups, a mask tells {MASK_BITS} apart")
    return _mask_udf(tuple(tuple(words) for words in groups.values()))(text)


def in_mask(mask: Column, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Per group whether its bit is set."""
    return {name: mask.bitwiseAND(F.lit(1 << bit)) != 0 for bit, name in enumerate(groups)}


def groups_found(text: Column, groups: Mapping[str, Sequence[str]], mode: str = "substring") -> dict[str, Column]:
    """Per group whether any of its words occurs in ``text`` (already folded); NULL for NULL.

    All columns read masks that are evaluated once for a row.  ``word`` mode wants word boundaries
    and is one pattern per group.
    """
    if mode != "substring":
        return {name: contains_any(text, words, mode) for name, words in groups.items()}
    names, out = list(groups), {}
    for at in range(0, len(names), MASK_BITS):
        part = {name: groups[name] for name in names[at : at + MASK_BITS]}
        out.update(in_mask(group_mask(text, part), part))
    return out
