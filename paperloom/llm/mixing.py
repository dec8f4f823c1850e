"""Combine the records of several sources so that each holds a target share of all tokens."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import materialize

#: Bits of a record's seeded place, and how many of them one pass over the counted records resolves.
PLACE_BITS, STEP_BITS = 60, 12
#: Sources that a target may name (its rows, and one row of sums for each, come to the driver); more are refused.
MAX_SOURCES = 10_000


def source_name(column: Column) -> Column:
    """A source in one spelling: lower case, blanks trimmed, blanks and hyphens inside as underscores."""
    return F.regexp_replace(F.lower(F.regexp_replace(column, r"^\s+|\s+$", "")), r"[\s\-_]+", "_")


def water_fill(sizes: Mapping[str, int], shares: Mapping[str, float], caps: Mapping[str, int], total: float | None = None) -> dict[str, float]:
    """Tokens to take of each source.

    A source is clamped at ``caps`` times its size; what it cannot give goes to the others in proportion to their
    shares, until every source can give what it is asked for. ``total`` defaults to all tokens of the sources. If
    all sources are clamped, the sum falls short of it. Sources without tokens, shares or repeats give nothing.
    """
    limit = {s: max(0, caps.get(s) or 0) * sizes.get(s, 0) for s in shares}
    wanted = float(sum(sizes.get(s, 0) for s in shares)) if total is None else float(total)
    take = {s: 0.0 for s in shares}
    free = {s for s in shares if limit[s] > 0 and (shares[s] or 0) > 0}
    left = wanted
    while free and left > 0:
        weight = sum(shares[s] for s in free)
        over = {s for s in free if shares[s] / weight * left >= limit[s]}
        if not over:
            for s in free:
                take[s] = shares[s] / weight * left
            break
        for s in over:
            take[s] = float(limit[s])
            left -= limit[s]
        free -= over
    return take


def mix(counted: DataFrame, target: DataFrame, seed: int = 7, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, shares): how often each record is taken, and what each source holds then.

    ``counted`` has (doc_id, source, n_tokens); ``target`` has (source, target_share, max_repeats), one row for each
    source (a second row of a source is ignored). Records: (doc_id, source, n_tokens, repeats), repeats at least 1.
    Every record of a source is taken the whole number of times that its tokens fit into what the source gives; the
    rest is filled by records in the order of a seeded hash of 60 bits, up to the one record that would exceed it
    (records that share all 60 bits are taken or left together). Shares:
    (source, target_share, max_repeats, records, available_tokens, taken_tokens, reached_share, clamped).
    Records of null or unlisted sources and records without tokens are never taken. A target of more than
    ``MAX_SOURCES`` rows is an error.
    """
    spark = counted.sparkSession
    rows = counted.select("doc_id", source_name(F.col("source")).alias("source"), "n_tokens", place_of(seed, F.col("doc_id")).alias("place")).where("n_tokens > 0")
    wanted = target.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"a target may name at most {MAX_SOURCES} sources")
    aims = {r["source"]: r for r in reversed(wanted)}
    rows = materialize(rows.where(F.col("source").isin(sorted(aims)))) if aims else rows.where("false")
    sums = {r["source"]: r for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("records")).collect()}  # one row a source
    sizes = {s: int(r["size"]) for s, r in sums.items()}
    shares, caps = {s: float(r["target_share"] or 0) for s, r in aims.items()}, {s: int(r["max_repeats"] or 0) for s, r in aims.items()}
    take = water_fill(sizes, shares, caps, total)
    whole = {s: int(take[s] // n) for s, n in sizes.items()}
    cut = _cuts(rows, {s: take[s] - whole[s] * n for s, n in sizes.items() if take[s] - whole[s] * n >= 1})
    plan = spark.createDataFrame([(s, whole[s], *cut.get(s, (-1,))) for s in sizes], "source string, whole bigint, last_place bigint")
    records = rows.join(F.broadcast(plan), "source").select(
        "doc_id", "source", "n_tokens", (F.col("whole") + F.when(F.col("place") <= F.col("last_place"), 1).otherwise(0)).cast("bigint").alias("repeats")
    ).where("repeats > 0")
    held = records.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("taken_tokens"))
    report = spark.createDataFrame(
        [(s, shares[s], caps[s], int(sums[s]["records"]) if s in sums else 0, sizes.get(s, 0), bool(take[s] >= caps[s] * sizes.get(s, 0))) for s in aims],
        "source string, target_share double, max_repeats bigint, records bigint, available_tokens bigint, clamped boolean",
    )
    report = report.join(F.broadcast(held), "source", "left").fillna(0, ["taken_tokens"])
    report = report.withColumn("all_tokens", F.sum("taken_tokens").over(Window.partitionBy()))  # one row for each source of the target
    return records, report.select("source", "target_share", "max_repeats", "records", "available_tokens", "taken_tokens", F.coalesce(F.try_divide("taken_tokens", "all_tokens"), F.lit(0.0)).alias("reached_share"), "clamped")


def place_of(seed: int, key: Column) -> Column:
    """A record's seeded place, of ``PLACE_BITS`` bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 64 - PLACE_BITS)


def _cuts(rows: DataFrame, rest: dict[str, float]) -> dict[str, tuple[int]]:
    """For each source the last seeded place up to which its records fill ``rest`` tokens without exceeding them.

    Each pass sums the tokens by ``STEP_BITS`` more bits of the place within the stretch where the rest runs out, until
    that stretch holds one record: the driver sees at most 4,096 sums for each source and pass, and the number of
    passes grows with the logarithm of the number of records.
    """
    spark = rows.sparkSession
    low, left, found = {s: 0 for s in rest}, dict(rest), {}
    for shift in range(PLACE_BITS - STEP_BITS, -1, -STEP_BITS):
        if not low:
            break
        at = spark.createDataFrame(list(low.items()), "source string, low bigint")
        near = rows.join(F.broadcast(at), "source").where(F.shiftright("place", shift + STEP_BITS) == F.shiftright("low", shift + STEP_BITS))
        bins: dict[str, list[tuple[int, int, int]]] = {}
        for r in near.groupBy("source", F.shiftright("place", shift).alias("bin")).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("records")).collect():
            bins.setdefault(r["source"], []).append((r["bin"], r["n"], r["records"]))
        for s in list(low):
            for b, n, records in sorted(bins.get(s, ())):
                if n > left[s]:
                    if records == 1 or shift == 0:
                        found[s] = ((b << shift) - 1,)
                        del low[s]
                    else:
                        low[s] = b << shift
                    break
                left[s] -= n
            else:
                found[s] = ((1 << PLACE_BITS) - 1,)
                del low[s]
    return found
