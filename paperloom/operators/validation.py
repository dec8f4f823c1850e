"""Validation of control records, confidence scores, and what reviewers' verdicts say of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.controls import GUIDANCE

# Names of suspect sections, words of table headers, penalties.
SUSPECT_SECTIONS = ("revision history", "framework crosswalk", "references", "glossary", "definitions", "document control")
TABLE_WORDS = ("control id", "nist mapping", "implementation status", "responsible party", "framework ref", "control family")
PENALTIES = {
    "EMPTY_DESCRIPTION": 40, "SHORT_DESCRIPTION": 30, "LONG_DESCRIPTION": 20, "SUSPECT_SECTION": 35, "APPENDIX_SECTION": 15, "DUPLICATE_ID_SAME_DOC": 25, "DUPLICATE_ID_CROSS_DOC": 10,
    "TABLE_HEADERS_IN_DESC": 20, "GUIDANCE_IN_DESC": 15, "TABLE_SOURCE": 10, "EMPTY_BASELINE": 10, "EMPTY_NAME": 5, "MULTI_CONTROL_PARAGRAPH": 10,
}
SHORT, LONG = 20, 2_000


def places_of_ids(mentions: DataFrame) -> DataFrame:
    """(control_id, files): the files that mention each identifier, in order."""
    return mentions.groupBy("control_id").agg(F.array_join(F.array_sort(F.collect_set("file")), ", ").alias("files"))


def status_of(controls: DataFrame, mentions: DataFrame, split: bool = True) -> DataFrame:
    """(control_id, parent, found_in, status): PASS if a part of the control's own parent mentions it, MISSING if no
    part does, else RELOCATED; N/A for all where documents were not split (there is no manifest of parts).

    ``controls`` has (control_id, parent), ``mentions`` (control_id, file, file_parent). Both sides are reduced to
    distinct rows before the join.
    """
    wanted = controls.select("control_id", "parent").distinct()
    seen = mentions.select("control_id", "file_parent", "file").distinct().groupBy("control_id", "file_parent").agg(F.count(F.lit(1)).alias("n"))
    joined = wanted.join(seen, "control_id", "left").groupBy("control_id", "parent").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found_in"), F.coalesce(F.max(F.col("file_parent") == F.col("parent")), F.lit(False)).alias("own"))
    return joined.select("control_id", "parent", "found_in", F.when(F.lit(not split), "N/A").when(F.col("found_in") == 0, "MISSING").when(F.col("own"), "PASS").otherwise("RELOCATED").alias("status"))


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def confidence(controls: DataFrame, several: Column | None = None) -> DataFrame:
    """Add ``score`` (100 less the penalties, at least 0) and ``flags``. Blank and null fields are empty.

    Repeats and siblings are counted by identifier and file, and only these counts are joined back to the records.
    ``several`` says whether a record shares its paragraph with another one.
    """
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = controls.withColumns({"_id": t("control_id"), "_f": t("source_file")})
    seen = rows.groupBy("_id", "_f").agg(F.count(F.lit(1)).alias("_same"), F.max(t("baseline") != "").alias("_b"), F.max(t("control_name") != "").alias("_n"))
    files = seen.groupBy("_f").agg(F.max("_b").alias("_base"), F.max("_n").alias("_name"))
    totals = seen.groupBy("_id").agg(F.sum("_same").alias("_all"))
    rows = rows.join(seen.select("_id", "_f", "_same").join(files, "_f").join(totals, "_id"), ["_id", "_f"])
    text, section = t("control_description"), F.lower(t("section_header"))
    low = F.lower(text)
    flag = lambda name, when: F.when(when, F.lit(name))
    flags = F.array_compact(
        F.array(
            flag("EMPTY_DESCRIPTION", text == ""), flag("SHORT_DESCRIPTION", (F.length(text) > 0) & (F.length(text) < SHORT)), flag("LONG_DESCRIPTION", F.length(text) > LONG),
            flag("SUSPECT_SECTION", _has(section, SUSPECT_SECTIONS)), flag("APPENDIX_SECTION", ~_has(section, SUSPECT_SECTIONS) & F.contains(section, F.lit("appendix"))),
            flag("DUPLICATE_ID_SAME_DOC", F.col("_same") > 1), flag("DUPLICATE_ID_CROSS_DOC", (F.col("_same") == 1) & (F.col("_all") > 1)),
            flag("TABLE_HEADERS_IN_DESC", _has(low, TABLE_WORDS)), flag("GUIDANCE_IN_DESC", _has(low, GUIDANCE)), flag("TABLE_SOURCE", F.lower(t("extraction_source")) == "table"),
            flag("EMPTY_BASELINE", (t("baseline") == "") & F.col("_base")), flag("EMPTY_NAME", (t("control_name") == "") & F.col("_name")),
            flag("MULTI_CONTROL_PARAGRAPH", several if several is not None else F.lit(False)),
        )
    )
    table = F.create_map(*[F.lit(x) for kv in PENALTIES.items() for x in kv])
    rows = rows.withColumn("flags", flags)
    lost = F.aggregate("flags", F.lit(0), lambda a, f: a + F.element_at(table, f))
    return rows.withColumn("score", F.greatest(F.lit(100) - lost, F.lit(0)).cast("bigint")).drop("_id", "_f", "_same", "_base", "_name", "_all")


def band(score: Column) -> Column:
    return F.when(score <= 30, "low").when(score <= 60, "medium").otherwise("high")


def review_summary(scored: DataFrame) -> DataFrame:
    """(source_file, controls, score_sum, low, medium, high) of every file, and of all of them under ``(all)``."""
    rows = scored.withColumn("_b", band(F.col("score"))).rollup("source_file").agg(
        F.count(F.lit(1)).alias("controls"), F.sum("score").alias("score_sum"), *[F.count_if(F.col("_b") == b).alias(b) for b in ("low", "medium", "high")], F.grouping("source_file").alias("_g")
    )
    return rows.withColumn("source_file", F.when(F.col("_g") == 1, "(all)").otherwise(F.col("source_file"))).drop("_g")


def flag_counts(scored: DataFrame) -> DataFrame:
    """(flag, n)."""
    return scored.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def source_context(paragraphs: DataFrame, first: DataFrame, keys: list[str], order: str, around: int = 3) -> DataFrame:
    """(control_id, context): the paragraphs around the first mention of each control, that one marked.

    ``first`` has (control_id, keys..., at). Mentions are spread to the places around them, so the join is on
    equality, not on a range.
    """
    near = first.select("control_id", *keys, "at", F.explode(F.sequence(F.col("at") - around, F.col("at") + around)).alias(order))
    rows = near.join(paragraphs, [*keys, order]).withColumn("_t", F.concat(F.when(F.col(order) == F.col("at"), ">>> ").otherwise("    "), F.col("text")))
    return rows.groupBy("control_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_t"))), lambda x: x["_t"]), "\n").alias("context"))


WRONG = "Wrong-FalsePositive"


def status_counts(reviewed: DataFrame) -> DataFrame:
    return reviewed.groupBy(F.coalesce(F.nullif(F.trim("status"), F.lit("")), F.lit("(unreviewed)")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def confirmed(controls: DataFrame, reviewed: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """Records that reviewers did not call wrong, and those that they added; the last verdict on a key holds."""
    last = reviewed.groupBy(*keys).agg(F.max_by("status", "ord").alias("status"))
    kept = controls.join(last, keys, "left").where(~F.col("status").eqNullSafe(F.lit(WRONG)))
    return kept.unionByName(added.withColumn("status", F.lit("Added")), allowMissingColumns=True)


def error_patterns(reviewed: DataFrame, by: Column, least: int = 3) -> DataFrame:
    """(pattern, wrong): where wrong records are frequent."""
    return reviewed.where(F.col("status") == WRONG).groupBy(by.alias("pattern")).agg(F.count(F.lit(1)).alias("wrong")).where(F.col("wrong") >= least)


def flag_precision(reviewed: DataFrame) -> DataFrame:
    """(flag, flagged, wrong): how many of the flagged records were wrong."""
    rows = reviewed.select("status", F.explode("flags").alias("flag"))
    return rows.groupBy("flag").agg(F.count(F.lit(1)).alias("flagged"), F.count_if(F.col("status") == WRONG).alias("wrong"))


def file_accuracy(reviewed: DataFrame) -> DataFrame:
    """(source_file, reviewed, wrong)."""
    seen = F.coalesce(F.trim("status"), F.lit("")) != ""
    return reviewed.groupBy("source_file").agg(F.count_if(seen).alias("reviewed"), F.count_if(F.col("status") == WRONG).alias("wrong"))


def flag_correlation(reviewed: DataFrame, verdicts: tuple[str, ...], flag: str) -> DataFrame:
    """(errors, with_flag, share): of the rows with one of these verdicts, how many carry a flag."""
    wrong = reviewed.where(F.trim("status").isin(list(verdicts)))
    rows = wrong.agg(F.count(F.lit(1)).alias("errors"), F.count_if(F.array_contains("flags", flag)).alias("with_flag"))
    return rows.withColumn("share", F.try_divide("with_flag", "errors"))


def missing_patterns(missing: DataFrame) -> DataFrame:
    """(kind, value, n): rows that reviewers added, by file and by section (in lower case); blank ones are left out."""
    parts = F.array(F.struct(F.lit("file").alias("kind"), F.trim("source_file").alias("value")), F.struct(F.lit("section").alias("kind"), F.lower(F.trim("section_header")).alias("value")))
    return missing.select(F.inline(parts)).where("value <> ''").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def suggestions(patterns: DataFrame, correlation: DataFrame, bad_ids: DataFrame, least: int = 3) -> DataFrame:
    """(type, value, n): what reviewers' verdicts suggest to change: sections that are often wrong, guidance words when
    enough errors carry the flag, and identifiers that no pattern matches."""
    a = patterns.where(F.col("wrong") >= least).select(F.lit("suspect_section").alias("type"), F.col("pattern").alias("value"), F.col("wrong").alias("n"))
    b = correlation.where(F.col("with_flag") >= least).select(F.lit("guidance_keywords").alias("type"), F.lit("GUIDANCE_IN_DESC").alias("value"), F.col("with_flag").alias("n"))
    c = bad_ids.groupBy(F.trim("control_id").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("value <> ''").select(F.lit("control_id_pattern").alias("type"), "value", "n")
    return a.unionByName(b).unionByName(c)
