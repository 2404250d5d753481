"""Text cleaning and matching on columns; only NFKD itself leaves the JVM."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from railtide import vocab

# white space as Unicode sees it, plus the four ASCII separator controls; no flag needed
SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_SPACE = SPACE.replace("[", "[^", 1)
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class _WithoutMarks(dict):
    """Translation table that drops nonspacing marks, filled on first use of a character."""

    def __missing__(self, point: int):
        kept = None if unicodedata.category(chr(point)) == "Mn" else point
        self[point] = kept
        return kept


class _LetterHoles(_WithoutMarks):
    """Also reads unassigned places of the mathematical alphabets as the letter they stand for."""

    FIRST, LAST = 0x1D400, 0x1D6A3

    def __missing__(self, point: int):
        if self.FIRST <= point <= self.LAST and unicodedata.category(chr(point)) == "Cn":
            place = (point - self.FIRST) % 52
            self[point] = place + (ord("A") if place < 26 else ord("a") - 26)
            return self[point]
        return super().__missing__(point)


_TABLES = {False: _WithoutMarks(), True: _LetterHoles()}


def _nfkd(values: pd.Series, holes: bool) -> pd.Series:
    table = _TABLES[holes]
    return values.map(
        lambda v: v if v.isascii() else unicodedata.normalize("NFKD", v).translate(table), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkd_plain(values: pd.Series) -> pd.Series:
    return _nfkd(values, False)


@F.pandas_udf(StringType())
def _nfkd_holes(values: pd.Series) -> pd.Series:
    return _nfkd(values, True)


def normalize_unicode(text: Column, fill_holes: bool = False, guard: bool = True) -> Column:
    """NFKD without nonspacing marks.

    With ``guard`` pure ASCII text never crosses to Python; the guard names ``text`` several times,
    so leave it out where ``text`` is itself costly to evaluate.
    """
    udf = _nfkd_holes if fill_holes else _nfkd_plain
    if not guard:
        return udf(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, text).otherwise(udf(F.when(~ascii_only, text)))


@F.pandas_udf(StringType())
def _fold(values: pd.Series) -> pd.Series:
    return _nfkd(values, False).map(str.casefold, na_action="ignore")


def fold(text: Column) -> Column:
    """Normalised and case-folded text in one pass.

    The result is a plain column of the plan, so any number of word tests read it without
    evaluating it again.
    """
    return _fold(text)


def casefold(text: Column) -> Column:
    """Case folding; exact for text that went through ``normalize_unicode``."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def squash(text: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, rf"{SPACE}+", " "))


def blank_to_null(text: Column) -> Column:
    return F.when(strip(text) != "", text)


def minimal_words(words: Iterable[str]) -> list[str]:
    """Leave out words that hold another word of the list: they can never change an any-match."""
    unique = list(dict.fromkeys(words))
    return [w for w in unique if not any(o != w and o in w for o in unique)]


def _literal(word: str) -> str:
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def contains_any(text: Column, words: Sequence[str], mode: str = "substring") -> Column:
    """True if any of a few ``words`` occurs in ``text`` (already folded), in generated code.

    ``substring`` matches inside words too; ``word`` wants word boundaries.  Each word is a scan of
    its own: keyword lists go through ``keywords.groups_found``, which reads a text once.
    """
    if not words:
        return F.lit(False)
    folded = [w.casefold() for w in words]
    if mode == "word":
        alternatives = "|".join(_literal(w) for w in dict.fromkeys(folded))
        return text.rlike(rf"(?U)(?<!\w)(?:{alternatives})(?!\w)")
    if mode != "substring":
        raise ValueError(f"unknown match mode {mode!r}")
    return _any_of([text.contains(F.lit(w)) for w in minimal_words(folded)])


def _any_of(tests: list[Column]) -> Column:
    """A balanced OR, so that long lists do not nest deeply."""
    while len(tests) > 1:
        tests = [
            functools.reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)
        ]
    return tests[0]


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """The words of the list that occur in ``text``, in list order."""
    return F.array_compact(
        F.array(*[F.when(text.contains(F.lit(w.casefold())), F.lit(w)) for w in words])
    )


def strip_symbols(text: Column) -> Column:
    # every symbol lies past U+200C, which settles most characters with one comparison
    return F.regexp_replace(text, rf"[\x{{200D}}-\x{{10FFFF}}&&{vocab.SYMBOL_CLASS}]+", "")


def strip_boilerplate(text: Column, patterns: Sequence[str] = tuple(vocab.BOILERPLATE)) -> Column:
    out = F.coalesce(text, F.lit(""))
    for pattern in patterns:
        out = F.regexp_replace(out, pattern, "")
    return strip(out)


def clean_caption(text: Column) -> Column:
    """Boilerplate, then Unicode, then symbols, then the expand link, then white space."""
    out = strip_symbols(normalize_unicode(strip_boilerplate(text), guard=False))
    return squash(F.regexp_replace(out, vocab.EXPAND_TAIL, ""))


def split_lines(text: Column) -> Column:
    return F.split(text, r"\r\n|\r|\n")


def distinct_lines(lines: Column) -> Column:
    """Case-insensitive dedupe of an array of lines that keeps the first spelling and the order.

    A hash set tells whether any line repeats.  If so, sorting by folded text groups the repeats,
    so a text of n lines costs n log n, not n squared.
    """
    def no_repeats(all_lines: Column) -> Column:
        return F.size(F.array_distinct(F.transform(all_lines, lambda x: F.lower(x)))) == F.size(all_lines)

    return let(lines, lambda all_lines: F.when(no_repeats(all_lines), all_lines).otherwise(_first_spellings(all_lines)))


def _first_spellings(lines: Column) -> Column:
    tagged = F.array_sort(
        F.transform(lines, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x")))
    )

    def firsts(all_tagged: Column) -> Column:
        before = F.concat(
            F.array(F.lit(None).cast("struct<k:string,i:int,x:string>")),
            F.slice(all_tagged, 1, F.size(all_tagged) - 1),
        )
        return F.zip_with(
            all_tagged, before,
            lambda s, b: F.when(b.isNull() | (s["k"] != b["k"]), F.struct(s["i"].alias("i"), s["x"].alias("x"))),
        )

    return F.transform(F.array_sort(F.array_compact(let(tagged, firsts))), lambda s: s["x"])


def clean_ocr_lines(text: Column) -> Column:
    """The kept lines of recognised text, as an array (before repeats are dropped)."""
    out = strip_symbols(normalize_unicode(text))
    out = F.regexp_replace(out, r"(?U)[^\S\r\n]+", " ")
    out = F.regexp_replace(out, r"(?U)\s*\n\s*", "\n")
    trimmed = F.transform(split_lines(out), lambda x: F.btrim(x, F.lit(vocab.LINE_TRIM_CHARS)))
    # a plain scan for what every footer holds spares most lines the pattern
    kept = F.filter(trimmed, lambda x: F.length(x) >= vocab.MIN_LINE_CHARS)
    return F.filter(
        kept,
        lambda x: ~F.when(
            let(F.lower(x), lambda low: _any_of([low.contains(F.lit(mark)) for mark in vocab.FOOTER_MARKS])),
            x.rlike(vocab.FOOTER_LINE),
        ).otherwise(False),
    )


def clean_ocr(text: Column) -> Column:
    return F.array_join(distinct_lines(clean_ocr_lines(text)), " ")


def joined_text(caption: Column, image_text: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(image_text, F.lit("")))


def _head(text: Column, chars: int) -> Column:
    """So much of the text that squashing it gives the first ``chars`` characters of the squashed text.

    A run of white space counts as one character, however long it is.
    """
    return F.regexp_extract(text, rf"^{SPACE}*+((?:{NON_SPACE}|{SPACE}++){{0,{chars + 1}}})", 1)


def text_key(caption: Column, image_text: Column | None = None, chars: int = vocab.TEXT_KEY_CHARS) -> Column:
    """Dedupe key: the first characters of the folded, squashed text; NULL when there is none."""
    text = joined_text(caption, image_text) if image_text is not None else F.coalesce(caption, F.lit(""))
    return F.nullif(F.substring(casefold(squash(_head(text, chars))), 1, chars), F.lit(""))


def raw_text_key(caption: Column, image_text: Column | None = None, chars: int = vocab.TEXT_KEY_CHARS) -> Column:
    """The repair pass's key: trimmed only, case and inner spacing as they are."""
    text = joined_text(caption, image_text) if image_text is not None else F.coalesce(caption, F.lit(""))
    return F.nullif(F.substring(strip(text), 1, chars), F.lit(""))


def snippet(text: Column, chars: int = 1000) -> Column:
    return F.substring(squash(text), 1, chars)


def cap(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)
