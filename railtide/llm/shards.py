"""Sharding: best-fit-decreasing bin packing of groups of equal texts."""

from __future__ import annotations

import bisect
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.operators.ids import number_rows
from railtide.session import cut_lineage

SHARDS = 24
ROW_BYTES = 8
# sizes are graded to this many leading bits, rounded up: at most 2 ** 11 grades per doubling, and
# so about 100,000 grades whatever the corpus; sizes below 4,096 keep their exact value
GRADE_BITS = 12
# grades may be broadcast up to this many entries
BROADCAST_ENTRIES = 200_000


def grade(size: int, bits: int = GRADE_BITS) -> int:
    """The smallest number of at most ``bits`` leading bits that is not below ``size``."""
    shift = max(size.bit_length() - bits, 0)
    return (size + (1 << shift) - 1) >> shift << shift


def grade_column(size: Column, bits: int = GRADE_BITS) -> Column:
    """The same as a column; ``size`` is a bigint of at least 0."""
    unit = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(size)) - bits, F.lit(0))).cast("bigint")
    return F.floor((size + unit - 1) / unit).cast("bigint") * unit


def best_fit(grades: Iterable[tuple[int, int]], capacity: int, most: int | None = None):
    """Best fit of (size, count), largest first: [(size, bin, count)], or None if over ``most`` bins.

    Free space is kept in order of (space, bin), the ordered tree of the method.  An item goes to
    the tightest bin it fits; that bin is then tighter still, so it goes on taking items of the
    same size until they no longer fit, which is why a whole size is placed at once.
    """
    free: list[tuple[int, int]] = []
    out, bins = [], 0
    for size, count in grades:
        while count:
            at = bisect.bisect_left(free, (size, -1))
            if at == len(free):
                if most is not None and bins == most:
                    return None
                space, chosen = max(capacity, size), bins
                bins += 1
            else:
                space, chosen = free.pop(at)
            taken = min(count, space // size)
            out.append((size, chosen, taken))
            bisect.insort(free, (space - taken * size, chosen))
            count -= taken
    return out


def best_fit_even(grades: Iterable[tuple[int, int]], shards: int):
    """Best fit into ``shards`` bins of an even share; what fits nowhere goes to the emptiest bin."""
    left = list(grades)
    share = -(-sum(s * n for s, n in left) // shards)
    free = [(share, i) for i in range(shards)]
    out = []
    for size, count in left:
        while count:
            at = bisect.bisect_left(free, (size, -1))
            fits = at < len(free)
            space, chosen = free.pop(at if fits else -1)
            taken = min(count, space // size) if fits else 1
            out.append((size, chosen, taken))
            bisect.insort(free, (space - taken * size, chosen))
            count -= taken
    return out


def spread_of(placed: list[tuple[int, int, int]], shards: int) -> int:
    """Difference of the fullest and the emptiest bin."""
    held = [0] * shards
    for size, chosen, n in placed:
        held[chosen] += size * n
    return max(held) - min(held)


def pack(grades: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Best fit into exactly ``shards`` bins: (size, bin, count).

    Two capacities are tried, the smallest that holds everything and the even share with overflow;
    the more even result counts.  A group larger than an even share cannot be divided: it has a
    shard of its own, and the rest is packed into the other shards.
    """
    left = sorted(([s, n] for s, n in grades if s > 0 and n > 0), reverse=True)
    total, alone = sum(s * n for s, n in left), []
    while left and len(alone) < shards and left[0][0] * (shards - len(alone)) > total:
        size = left[0][0]
        alone.append((size, len(alone), 1))
        total -= size
        left[0][1] -= 1
        if not left[0][1]:
            left.pop(0)
    if not left:
        return alone
    rest = shards - len(alone)
    low = max(-(-total // rest), left[0][0])
    high = low + left[0][0]
    while best_fit(left, high, rest) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if best_fit(left, middle, rest) is None:
            low = middle + 1
        else:
            high = middle
    found = [best_fit(left, high, rest), best_fit_even(left, rest)]
    even = min(found, key=lambda placed: spread_of(placed, rest))
    return alone + [(s, b + len(alone), n) for s, b, n in even]


def digest_of(text: str = "text") -> Column:
    """16 bytes that name a text; NULL is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + ROW_BYTES).cast("bigint")


def shard_groups(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(digest, shard) of the groups in ``rows`` (digest, size): equal digests share a shard.

    Copies are summed before the shuffle.  The driver packs a table of (graded size, number of
    groups), whose length is bounded by GRADE_BITS; which group of a size goes where follows from
    its place among them, numbered over range partitions.
    """
    spark = rows.sparkSession
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size")).select("digest", grade_column(F.col("size")).alias("grade"))
    numbered = number_rows(groups, ["grade", "digest"], "place")
    counted = {r["grade"]: r["n"] for r in numbered.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    cuts: dict[int, list[tuple[int, int]]] = {g: [] for g in counted}
    starts, place = {}, 0
    for g in sorted(counted):
        starts[g], place = place, place + counted[g]
    for g, shard, n in pack(sorted(counted.items()), shards):
        before = cuts[g][-1][0] if cuts[g] else starts[g]
        cuts[g].append((before + n, shard))
    table = spark.createDataFrame(
        list(cuts.items()), "grade bigint, cuts array<struct<last bigint, shard int>>"
    )
    if sum(map(len, cuts.values())) <= BROADCAST_ENTRIES:
        table = F.broadcast(table)
    chosen = F.filter("cuts", lambda c: c["last"] >= F.col("place"))[0]["shard"]
    return numbered.join(table, "grade").select("digest", chosen.alias("shard"))


def pack_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of all rows of ``docs``.

    Size is the text's UTF-8 bytes plus 8; NULL is the empty text.  Equal texts form a group that
    is never divided.  Slots number the rows of a shard from 0 by (key, digest), NULL keys first;
    repeated rows have slots of their own.  Shards may stay empty if there are few groups.
    """
    plain = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = cut_lineage(docs.select(
        F.col(key).alias("key"), size_of(text).alias("size"), F.crc32(plain).alias("crc"), digest_of(text).alias("digest"),
    ))
    placed = rows.join(shard_groups(rows, shards), "digest")
    numbered = number_rows(placed, ["shard", "key", "digest"], "place")
    held = {r["shard"]: r["n"] for r in numbered.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    starts, place = [], 0
    for shard in range(shards):
        starts.append(place)
        place += held.get(shard, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("shard") + 1)
    return numbered.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - 1 - start).alias("slot")
    )


def op4(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return pack_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in ``out``; a column of that name is replaced.

    NULL is the empty text, rows of equal texts share a shard, repeated rows stay.  Other columns may
    have any names; an empty table stays empty.
    """
    rows = docs.select(size_of(text).alias("size"), digest_of(text).alias("digest"))
    held = docs.drop(out).select(F.struct("*").alias("row"), digest_of(text).alias("digest"))
    return held.join(shard_groups(rows, shards), "digest").select("row.*", F.col("shard").alias(out))
