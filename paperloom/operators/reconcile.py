"""Differences between two copies of a table, by checksums over ranges of the key space.

Keys are spread over a 64-bit hash space, so that a key prefix that holds a tenth or a third of the rows is
no longer one range. Both sides get an order-free checksum for every range of the finest level; coarser ranges
sum up finer ones. From the whole space down, only ranges whose checksums differ are cut further; fields are
compared only for the keys in the differing ranges of the finest level.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import materialize

#: Rows (both sides together) that a range of the finest level should hold, and key bits that one level adds.
ROWS_PER_RANGE, BITS_PER_LEVEL, MAX_BITS = 32, 4, 40


def null_safe_hash(columns: Sequence[Column]) -> Column:
    """xxhash64 in which a null differs from every value and from an absent column."""
    return F.xxhash64(*[x for c in columns for x in (c.isNull(), c)])


def _hashes(df: DataFrame, keys: Sequence[str], fields: Sequence[str], side: int) -> DataFrame:
    key, row = [F.col(k) for k in keys], [F.col(c) for c in [*keys, *fields]]
    return df.select(F.lit(side).alias("side"), null_safe_hash(key).alias("kh"), null_safe_hash(row).alias("rh"))


def _checksums(rows: DataFrame, bucket: Column) -> DataFrame:
    return rows.groupBy(bucket.alias("range_id")).agg(
        *[F.coalesce(F.bit_xor(F.when(F.col("side") == s, F.col("rh"))), F.lit(0)).alias(f"x{s}") for s in (1, 2)],
        *[F.count(F.when(F.col("side") == s, 1)).alias(f"n{s}") for s in (1, 2)],
    )


def _rolled(level: DataFrame, bits: int) -> DataFrame:
    return level.groupBy(F.shiftrightunsigned("range_id", bits).alias("range_id")).agg(
        *[F.bit_xor(f"x{s}").alias(f"x{s}") for s in (1, 2)], *[F.sum(f"n{s}").alias(f"n{s}") for s in (1, 2)]
    )


def differing_ranges(leaves: DataFrame, bits: int, step: int = BITS_PER_LEVEL) -> DataFrame:
    """Range ids of the finest level whose checksums differ, found from the coarsest level down.

    ``leaves`` has the checksums of the finest level, whose ids have ``bits`` bits. A range of a level is
    looked at only if the range that contains it differs.
    """
    levels, at = [leaves], bits
    while at > step:
        levels.append(_rolled(levels[-1], step))
        at -= step
    differs = (F.col("x1") != F.col("x2")) | (F.col("n1") != F.col("n2"))
    found = levels[-1].where(differs).select("range_id")
    for level in reversed(levels[:-1]):
        parents = found.select(F.col("range_id").alias("parent_id"))
        found = level.where(differs).join(parents, F.shiftrightunsigned("range_id", step) == F.col("parent_id"), "left_semi").select("range_id")
    return found


def differing_keys(first: DataFrame, second: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Hashes ``kh`` of the keys that are on one side only or whose rows differ.

    Rows that are delivered twice count once. Only hashes are shuffled, never the fields. The hashes of the rows
    are written once into the shared folder, as they are read for the checksums and again in differing ranges.
    """
    hashes = materialize(_hashes(first, keys, fields, 1).unionByName(_hashes(second, keys, fields, 2)).distinct())
    total = hashes.count()
    if not total:
        return hashes.select("kh").where("false")
    bits = min(MAX_BITS, max(BITS_PER_LEVEL, BITS_PER_LEVEL * math.ceil(math.log2(max(2, total / ROWS_PER_RANGE)) / BITS_PER_LEVEL)))
    bucket = F.shiftrightunsigned("kh", 64 - bits)
    leaves = materialize(_checksums(hashes, bucket))
    ranges = differing_ranges(leaves, bits)
    suspects = hashes.withColumn("range_id", bucket).join(ranges, "range_id", "left_semi")
    sides = suspects.groupBy("kh").agg(
        *[F.bit_xor(F.when(F.col("side") == s, F.col("rh"))).alias(f"x{s}") for s in (1, 2)],
        *[F.count(F.when(F.col("side") == s, 1)).alias(f"n{s}") for s in (1, 2)],
    )
    return sides.where(~F.col("x1").eqNullSafe(F.col("x2")) | (F.col("n1") != F.col("n2"))).select("kh")


def compare_copies(first: DataFrame, second: DataFrame, keys: Sequence[str], fields: Sequence[str], row_field: str = "row") -> DataFrame:
    """Rows (keys..., field_name, state) for everything in which two copies differ.

    A key in one copy only gives field_name ``row`` and ``only_first`` or ``only_second``; a field whose values
    differ gives ``differs``. Null equals null and nothing else, in keys too. Rows delivered twice count once; if
    one side holds different rows under one key, the least of them (by its fields in order) is compared. Empty
    tables are fine. Other columns are ignored.
    """
    suspects = differing_keys(first, second, keys, fields)

    def side(df: DataFrame, mark: str) -> DataFrame:
        rows = df.select(*keys, *fields).withColumn("kh", null_safe_hash([F.col(k) for k in keys])).join(suspects, "kh", "left_semi")
        values = F.struct(*[F.col(c).alias(c) for c in fields])
        return rows.groupBy("kh", *keys).agg(F.min(values).alias(f"_{mark}")).withColumnsRenamed({k: f"_{mark}_{k}" for k in ["kh", *keys]})

    a, b = side(first, "a"), side(second, "b")
    same = a["_a_kh"] == b["_b_kh"]
    for k in keys:
        same = same & a[f"_a_{k}"].eqNullSafe(b[f"_b_{k}"])
    both = a.join(b, same, "full_outer")
    state = [
        F.when(F.col("_b").isNull(), F.struct(F.lit(row_field).alias("field_name"), F.lit("only_first").alias("state"))),
        F.when(F.col("_a").isNull(), F.struct(F.lit(row_field).alias("field_name"), F.lit("only_second").alias("state"))),
        *[
            F.when(
                F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_a")[c].eqNullSafe(F.col("_b")[c]),
                F.struct(F.lit(c).alias("field_name"), F.lit("differs").alias("state")),
            )
            for c in fields
        ],
    ]
    out = [F.when(F.col("_a_kh").isNotNull(), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys]
    return both.select(*out, F.explode(F.array_compact(F.array(*state))).alias("_d")).select(*keys, "_d.field_name", "_d.state")


def _digest(value: Column) -> Column:
    """128 bits that stand for a text; null stays null."""
    return F.unhex(F.md5(value.cast("binary")))


def check_report(report: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows (package_name, location, para_index, field_name, state) of a saved report that no longer hold.

    ``text1`` is held against ``accepted`` of the first copy at ``index1``, ``text2`` against the second copy at
    ``index2``; a null index says nothing. ``differs``: the values differ; ``only_report``: no such row.
    Texts are compared by a 128-bit digest, so that no text is shuffled.
    """
    place = ["package_name", "location", "para_index"]
    claim = lambda side: F.struct(F.lit(side).alias("side"), F.col(f"index{side}").alias("para_index"), F.lit(f"text{side}").alias("field_name"), _digest(F.col(f"text{side}")).alias("claimed"))
    claims = report.select("package_name", "location", F.inline(F.array(claim(1), claim(2)))).where(F.col("para_index").isNotNull()).distinct()
    rows = first.select(F.lit(1).alias("r_side"), *[F.col(c).alias(f"r_{c}") for c in place], _digest(F.col("accepted")).alias("actual")).unionByName(
        second.select(F.lit(2).alias("r_side"), *[F.col(c).alias(f"r_{c}") for c in place], _digest(F.col("accepted")).alias("actual"))
    )
    on = claims["side"] == rows["r_side"]
    for c in place:
        on = on & claims[c].eqNullSafe(rows[f"r_{c}"])
    state = F.when(F.col("r_side").isNull(), "only_report").when(~F.col("claimed").eqNullSafe(F.col("actual")), "differs")
    return claims.join(rows, on, "left").select(*place, "field_name", state.alias("state")).where(F.col("state").isNotNull()).distinct()


def paragraph_differences(paragraph: DataFrame, report: DataFrame) -> DataFrame:
    """Everything in which the two copies of ``paragraph`` differ, and what a saved report has wrong of them."""
    keys, fields = ["package_name", "location", "para_index"], ["accepted", "rejected", "has_tracked_changes"]
    copies = [paragraph.where(F.col("copy_no") == n) for n in (1, 2)]
    found = compare_copies(*copies, keys, fields).unionByName(check_report(report, *copies))
    return found.withColumn("para_index", F.col("para_index").cast("bigint"))
