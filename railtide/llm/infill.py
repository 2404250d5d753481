"""Fill-in-middle: documents cut into prefix, middle and suffix by a counted-quantifier pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a line with its break, or what follows the last break; no part gives anything back
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# of 100 documents: how many are transformed, and how many of those put the suffix first
RATE = 100
SUFFIX_FIRST = 50


def draws(key: Column, seed: int, count: int = 4) -> list[Column]:
    """Numbers drawn for a key: groups of eight hexadecimal digits of a hash.  A NULL key counts as ''."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def cut_pattern(first: Column, second: Column, unit: str = LINE) -> Column:
    """Pattern of one row: ``first`` units, the units up to the ``second``, and the rest.

    The counted groups are possessive, which the matcher runs as plain loops: no backtracking and no
    deep recursion, however many units a text has.
    """
    return F.concat(
        F.lit(rf"(?s)\A((?:{unit}){{"), first.cast("string"), F.lit(rf"}}+)((?:{unit}){{"),
        (second - first).cast("string"), F.lit(r"}+)(.*+)\z"),
    )


def _plain(marker: str) -> str:
    """A marker as it is written in a replacement."""
    return marker.replace("\\", "\\\\").replace("$", "\\$")


def _quoted(marker: str) -> str:
    """A marker as it is written in a pattern."""
    return rf"\Q{marker}\E"


def orders(prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE) -> dict[str, tuple[str, str, str]]:
    """Per form: its replacement, the pattern that takes its output apart, and the text's parts there."""
    p, s, m = _plain(prefix), _plain(suffix), _plain(middle)
    return {
        "psm": (f"{p}$1{s}$3{m}$2", rf"(?s)\A{_quoted(prefix)}(.*?){_quoted(suffix)}(.*?){_quoted(middle)}(.*+)\z", "$1$3$2"),
        "spm": (f"{s}$3{p}$1{m}$2", rf"(?s)\A{_quoted(suffix)}(.*?){_quoted(prefix)}(.*?){_quoted(middle)}(.*+)\z", "$2$3$1"),
    }


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", unit: str = LINE, seed: int = SEED, rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """(row, n, form, output): each row of ``docs`` as one struct, its number of units, its form and text.

    Two of n + 1 places between units are drawn from the key's hash; they may be equal, then the
    middle is empty.  One match cuts the text there and puts the parts in the order of the form.
    Empty and NULL texts, texts that hold a marker, and those that the rate leaves out are plain:
    the output is the text, NULL counts as empty.  A NULL key draws as the empty string.  Repeated
    rows are drawn alike, other columns travel in ``row``, an empty table gives an empty result.
    A map over the scan, without a shuffle.
    """
    prefix, suffix, middle = markers
    plain = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(key), seed)
    counted = docs.select(
        F.struct("*").alias("row"), plain.alias("text"), F.regexp_count(plain, F.lit(unit)).cast("bigint").alias("n"),
        h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"),
    )
    marked = F.contains("text", F.lit(prefix)) | F.contains("text", F.lit(suffix)) | F.contains("text", F.lit(middle))
    left_out = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    placed = counted.select(
        "row", "text", "n", F.least(one, two).alias("first"), F.greatest(one, two).alias("second"),
        F.when(left_out, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm").alias("form"),
    )
    forms = orders(*markers)
    replacement = F.when(F.col("form") == "spm", forms["spm"][0]).otherwise(forms["psm"][0])
    cut = F.regexp_replace(F.col("text"), cut_pattern(F.col("first"), F.col("second"), unit), replacement)
    return placed.select("row", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(cut).alias("output"))


def restore(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output and its form stand for."""
    back = {name: F.regexp_replace(output, F.lit(pattern), F.lit(parts)) for name, (_, pattern, parts) in orders(*markers).items()}
    return F.when(form == "psm", back["psm"]).when(form == "spm", back["spm"]).otherwise(output)


def part_lengths(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> tuple[Column, Column]:
    """Code points of prefix and middle; NULL for plain rows.

    No text holds a marker and no marker starts inside another, so a marker's first place is its own.
    """
    prefix, suffix, middle = markers
    at_suffix, at_prefix, at_middle = (F.instr(output, F.lit(m)) for m in (suffix, prefix, middle))
    before = F.when(form == "psm", at_suffix - 1 - len(prefix)).when(form == "spm", at_middle - at_prefix - len(prefix))
    return before.cast("bigint"), F.when(form != "plain", F.length(output) - at_middle - len(middle) + 1).cast("bigint")


def op11(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    done = fill_in_middle(docs.select("doc_id", "text"))
    prefix_chars, middle_chars = part_lengths(F.col("output"), F.col("form"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", prefix_chars.alias("prefix_chars"),
        middle_chars.alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units
), placed AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                   OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s
  FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""
