"""Framework mappings: answers, gaps, coverage, broad targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order of confidences; those that cover.
RANKS = {"high": 0, "medium": 1, "low": 2}
COVERING = ("high", "medium")
RESULT_SCHEMA = "map<string,struct<matches:array<struct<target_id:string,confidence:string,rationale:string>>,unique_to_source:boolean,gap_rationale:string>>"


def strip_fence(text: Column) -> Column:
    """The inside of a code fence if there is one, else the text."""
    inner = F.regexp_extract(text, r"(?s)```[a-z]*\s*(.*?)\s*```", 1)
    return F.when(inner != "", inner).otherwise(text)


def parse_results(files: DataFrame, text: str = "value", name: str = "file") -> DataFrame:
    """(file, source_id, unique_to_source, gap_rationale, pos, target_id, confidence, rationale); unreadable files give no row."""
    parsed = files.select(name, F.from_json(strip_fence(F.col(text)), RESULT_SCHEMA).alias("_m")).where("_m is not null")
    rows = parsed.select(name, F.explode("_m").alias("source_id", "_r"))
    return rows.select(name, "source_id", F.coalesce("_r.unique_to_source", F.lit(True)).alias("unique_to_source"), "_r.gap_rationale", F.posexplode_outer("_r.matches").alias("pos", "_t")).select(
        name, "source_id", "unique_to_source", "gap_rationale", "pos", "_t.target_id", F.coalesce(F.lower("_t.confidence"), F.lit("low")).alias("confidence"), "_t.rationale"
    )


def rank(confidence: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RANKS.items() for x in kv]), confidence), F.lit(3))


def merge_matches(matches: DataFrame) -> DataFrame:
    """(source_id, target_id, confidence, place): the best answer for each pair (the first of equals), in rank order.

    ``matches`` has (source_id, target_id, confidence, ord).
    """
    best = matches.groupBy("source_id", "target_id").agg(F.min(F.struct(rank(F.col("confidence")).alias("r"), F.col("ord"), F.col("confidence"))).alias("_b"), F.min("ord").alias("_first"))
    w = Window.partitionBy("source_id").orderBy("_b.r", "_first", "target_id")
    return best.select("source_id", "target_id", F.col("_b.confidence").alias("confidence"), F.row_number().over(w).cast("bigint").alias("place"))


def full_mapping(merged: DataFrame) -> DataFrame:
    """(source_id, covered, targets, unique_to_source): covering targets in order, their number, whether there is none."""
    cover = F.col("confidence").isin(list(COVERING))
    rows = merged.groupBy("source_id").agg(F.array_sort(F.collect_list(F.when(cover, F.struct("place", "target_id")))).alias("_t"))
    names = F.transform("_t", lambda x: x["target_id"].cast("string"))
    return rows.select("source_id", F.size("_t").cast("bigint").alias("covered"), F.array_join(names, "\n").alias("targets"), (F.size("_t") == 0).alias("unique_to_source"))


def gaps(merged: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id) of the targets that no covering answer names."""
    return targets.join(merged.where(F.col("confidence").isin(list(COVERING))).select("target_id").distinct(), "target_id", "left_anti")


def completeness(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, state): identifiers that are missing from the answers or extra in them."""
    missing = expected.select(key).distinct().join(found.select(key), key, "left_anti").withColumn("state", F.lit("missing"))
    return missing.unionByName(found.select(key).distinct().join(expected.select(key), key, "left_anti").withColumn("state", F.lit("extra")))


def broad_targets(merged: DataFrame, family: Column, broad: int = 10, very_broad: int = 15, families: int = 3, medium: int = 3) -> DataFrame:
    """(target_id, sources, families, medium, flags) of targets that many sources name, or of many families."""
    rows = merged.where(F.col("confidence").isin(list(COVERING))).groupBy("target_id").agg(
        F.count(F.lit(1)).alias("sources"), F.count_distinct(family).alias("families"), F.count_if(F.col("confidence") == "medium").alias("medium")
    )
    flags = F.concat_ws(
        ", ", F.when(F.col("sources") >= very_broad, "very broad").when(F.col("sources") >= broad, "broad"), F.when(F.col("families") >= families, "cross family"),
        F.when((F.col("medium") == F.col("sources")) & (F.col("medium") >= medium), "medium only"),
    )
    return rows.withColumn("flags", flags).where("flags <> ''")


def family_code(identifier: Column) -> Column:
    return F.nullif(F.regexp_extract(identifier, r"^([A-Z]{2,4})[-.]", 1), F.lit(""))


def stale_results(batches: DataFrame, results: DataFrame, name: str = "name") -> DataFrame:
    """(name) of the result files ``<batch>_result.json`` that have no batch any more."""
    wanted = batches.select(F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_result.json")).alias(name)).distinct()
    return results.select(name).distinct().join(wanted, name, "left_anti")


def coverage_check(merged: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(side, total, covered, uncovered, consistent, covered_share) for both sides: covered and uncovered are counted apart
    and must make up the total; identifiers of the answers that a side does not have break that."""
    cover = merged.where(F.col("confidence").isin(list(COVERING)))

    def one(side: str, known: DataFrame, key: str) -> DataFrame:
        total = known.select(key).distinct()
        seen = cover.select(key).distinct()
        marked = total.withColumn("_k", F.lit(1)).join(seen.withColumn("_c", F.lit(1)), key, "full_outer")
        return marked.agg(F.count("_k").alias("total"), F.count("_c").alias("covered"), F.count_if(F.col("_c").isNull()).alias("uncovered")).select(
            F.lit(side).alias("side"), "total", "covered", "uncovered", (F.col("covered") + F.col("uncovered") == F.col("total")).alias("consistent"), F.try_divide("covered", "total").alias("covered_share")
        )

    return one("source", sources, "source_id").unionByName(one("target", targets, "target_id"))


def first_of_sources(frames: list[DataFrame], key: str, order: str) -> DataFrame:
    """The first row of each key, frames in order (a catalog before a standard), then by ``order``."""
    rows = frames[0].withColumn("_src", F.lit(0))
    for k, frame in enumerate(frames[1:], 1):
        rows = rows.unionByName(frame.withColumn("_src", F.lit(k)), allowMissingColumns=True)
    names = [c for c in rows.columns if c not in (key, "_src")]
    return rows.groupBy(key).agg(F.min_by(F.struct(*names), F.struct("_src", order)).alias("_r")).select(key, "_r.*")


def family_of(identifier: Column, names: dict[str, str]) -> Column:
    """The name of an identifier's family by its code, the code itself without one, empty without a code."""
    code = F.coalesce(family_code(identifier), F.lit(""))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), code), code)
