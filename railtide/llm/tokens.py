"""Exact token counts without a shuffle of pre-tokens."""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections import Counter

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# entries of the broadcast table: its size is bounded whatever the corpus
TABLE_ENTRIES = 32_768
# rows of each partition that the table is fitted on, and pieces that each of them names; the table
# is a speed-up only, counts never depend on it
TABLE_ROWS = 256
TASK_ENTRIES = 4_096
# misses a worker remembers before it starts anew
CACHE_ENTRIES = 600_000

# split pattern of byte-level BPE vocabularies (fixed value)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# texts below this code point take the standard library's faster matcher
PLAIN_BELOW = 0x540


def _plain_split() -> str:
    """SPLIT for characters below PLAIN_BELOW, with its classes spelt out."""
    def members(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(PLAIN_BELOW) if regex.match(kind, chr(c)))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return (
        SPLIT.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]")
        .replace(r"\p{N}", f"[{numbers}]").replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]")
    )


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write visible bytes as themselves and the others as letters from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()

_workers: dict[str, "Counts"] = {}


class Counts(dict):
    """Pre-token to number of tokens: the broadcast table first, then this worker's own misses."""

    def __init__(self, name: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.any_pieces = regex.compile(SPLIT).findall
        self.plain_pieces = re.compile(_plain_split()).findall
        self.beyond = re.compile(f"[{chr(PLAIN_BELOW)}-{chr(0x10FFFF)}]").search
        self.frequent: dict[str, int] = {}
        added = self.library.get_added_tokens_decoder().values()
        # plain added tokens cut a text; with any other kind or another splitter the library does it all
        self.plain = (
            "ByteLevel" in repr(self.library.pre_tokenizer)[:200] and self.library.normalizer is None
            and not any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added)
        )
        specials = sorted((a.content for a in added), key=len, reverse=True)
        self.odd = regex.compile("(?!)").search
        self.cut = regex.compile("|".join(map(regex.escape, specials))).split if specials else lambda t: [t]

    def use(self, table: dict[str, int], odd: str) -> None:
        if table is not self.frequent:
            self.frequent = table
            self.update(table)
            self.odd = regex.compile(odd).search

    @functools.cached_property
    def odd_characters(self) -> str:
        """Pattern of the characters that the library and SPLIT class differently (other Unicode versions)."""
        if not self.plain:
            return "(?!)"
        ranges = []
        for block in range(0, 0x110000, 64):
            if 0xD800 <= block < 0xE000:
                continue
            probe = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in range(block, block + 64))
            theirs = [end for _, (_, end) in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            if theirs != list(itertools.accumulate(map(len, self.pieces(probe)))):
                ranges.append(f"\\U{block:08x}-\\U{block + 63:08x}")
        return f"[{''.join(ranges)}]" if ranges else "(?!)"

    def pieces(self, text: str) -> list[str]:
        return self.any_pieces(text) if self.beyond(text) else self.plain_pieces(text)

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.frequent) + CACHE_ENTRIES:
            self.clear()
            self.update(self.frequent)
        letters = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_LETTERS)
        n = self[piece] = len(self.library.model.tokenize(letters))
        return n

    def count(self, text: str) -> int:
        if not self.plain or self.beyond(text) and self.odd(text):
            return self.whole(text)
        parts = self.cut(text)
        of = self.__getitem__
        return len(parts) - 1 + sum(sum(map(of, self.pieces(p))) for p in parts if p)


def _worker(name: str) -> Counts:
    if name not in _workers:
        _workers[name] = Counts(name)
    return _workers[name]


def frequent_pieces(docs: DataFrame, text: str, tokenizer: str, rows: int = TABLE_ROWS,
                    entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """At most ``entries`` pre-tokens with their token counts, the commonest of ``rows`` rows of every partition.

    Every partition has a say, so a table that is ordered by source or language is covered like
    any other.  A task reads no further than its rows and names TASK_ENTRIES pieces at most; these
    short lists are all that is shuffled, the pre-tokens of the texts are not.
    """
    def tally(batches):
        counts = _worker(tokenizer)
        seen: Counter = Counter()
        read = 0
        for batch in batches:
            for value in batch["text"].iloc[: rows - read]:
                for part in counts.cut(value) if counts.plain else ():
                    seen.update(counts.pieces(part))
            read += len(batch)
            if read >= rows:
                break
        top = seen.most_common(TASK_ENTRIES)
        if top:
            pieces, times = zip(*top)
            yield pd.DataFrame({"piece": pieces, "times": times, "tokens": [counts[p] for p in pieces]})

    sample = docs.select(F.col(text).alias("text")).where("text is not null")
    named = sample.mapInPandas(tally, "piece string, times bigint, tokens int").groupBy("piece")
    common = named.agg(F.sum("times").alias("times"), F.min("tokens").alias("tokens")).orderBy(F.desc("times"), "piece")
    return {r["piece"]: r["tokens"] for r in common.limit(entries).collect()}


def token_counter(docs: DataFrame, text: str = "text", tokenizer: str = "byte_bpe_50k.json",
                  rows: int = TABLE_ROWS, entries: int = TABLE_ENTRIES):
    """A Column function: text to its number of tokens, as the tokenizer's library counts them.

    NULL counts as the empty text, which has no tokens.  Strings of added tokens inside a text
    count as the library counts them by default.  Texts are read whole.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, text, tokenizer, rows, entries))
    odd = _worker(tokenizer).odd_characters

    @pandas_udf("long")
    def count(values: pd.Series) -> pd.Series:
        counts = _worker(tokenizer)
        counts.use(table.value, odd)
        return pd.Series([counts.count(v) for v in values], dtype="int64")

    return lambda value: count(F.coalesce(value, F.lit("")))


def count_tokens(docs: DataFrame, text: str = "text", out: str = "n_tokens", **options) -> DataFrame:
    """``docs`` with the token count of each text in ``out``, a column of that name is replaced.

    One pass over the scan's own partitions: a broadcast table holds the lengths of frequent
    pre-tokens, the worker's cache those it has met itself, and only the rest is encoded.
    Repeated rows are counted each; an empty table gives an empty result.
    """
    counter = token_counter(docs, text, **options)
    return docs.withColumn(out, counter(F.col(text)))


def op9(docs: DataFrame, limit: int = 512) -> DataFrame:
    """Result of the registered query."""
    plain: Column = F.coalesce("text", F.lit(""))
    counted = count_tokens(docs.select("doc_id", plain.alias("text")))
    return counted.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
