"""Profiles of documents and of the corpus, from ordered elements and section extents."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import WORD_END, WORD_START, keyword_hits, word_count
from paperloom.operators import headings as H
from paperloom.operators.order import numbered

# Limits, weights and words of the profile.
PAGE_PARAGRAPHS, SPLIT_CHARS, PAGE_CHARS = 30, 36_000, 1_800
PROCEDURE_WORDS = ("step 1", "step 2", "procedure", "escalation", "workflow", "response process", "playbook")
WEIGHTS = {"tables": 2.0, "cross_refs": 1.5, "fake_headings": 1.0, "pages": 0.5, "missing_sections": 1.5, "merged_tables": 1.0}
OVER_LIMIT_BONUS, USAGE_WEIGHT = 3.0, 2.0
# The classes of tables, with the fewest columns and the words of each.
TABLE_CLASSES: dict[str, tuple[int, tuple[str, ...]]] = {
    "control_matrix": (3, ("control id", "control", "requirement", "framework", "nist", "status", "implementation", "responsible", "owner")),
    "applicability_table": (2, ("applies to", "applicability", "system", "environment", "in scope", "yes", "no", "n/a")),
    "reference_table": (2, ("term", "definition", "acronym", "glossary", "abbreviation", "description")),
    "crosswalk_table": (3, ("nist", "cis", "cmmc", "iso", "mapping", "alignment", "framework")),
    "role_responsibility": (2, ("role", "responsibility", "responsible", "accountable", "raci")),
}


def pages(paragraphs: Column) -> Column:
    return F.bround(paragraphs / F.lit(PAGE_PARAGRAPHS), 1)


def sizes(elements: DataFrame, limit: int = SPLIT_CHARS) -> DataFrame:
    """(doc_id, chars, words, paragraphs, pages, over_limit)."""
    size = F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint")
    rows = elements.groupBy("doc_id").agg(size.alias("chars"), F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0)).cast("bigint").alias("words"), F.count(F.lit(1)).alias("paragraphs"))
    return rows.withColumns({"pages": pages(F.col("paragraphs")), "over_limit": F.col("chars") > limit})


def heading_counts(elements: DataFrame) -> DataFrame:
    """Headings of every document that has any, by level and origin."""
    real = ~F.col("fake")
    return elements.where(F.col("level").isNotNull()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("headings"), *[F.count_if(real & (F.col("level") == k)).alias(f"h{k}") for k in (1, 2, 3)],
        F.count_if("fake").alias("fake_headings"), F.count_if(real & H.is_heading_style(F.col("style"))).alias("builtin_headings"),
    )


def standard_presence(extents: DataFrame) -> DataFrame:
    """(doc_id, has_<kind>..., missing): ``missing`` names the absent kinds in their order."""
    kinds = list(H.STANDARD_SECTIONS)
    rows = extents.withColumn("_k", H.standard_section(F.col("heading"))).groupBy("doc_id").agg(*[F.bool_or(F.col("_k") == k).alias(f"has_{k}") for k in kinds])
    return rows.withColumn("missing", F.concat_ws(", ", *[F.when(~F.col(f"has_{k}"), F.lit(k)) for k in kinds]))


def largest_section(extents: DataFrame) -> DataFrame:
    """(doc_id, largest_section, largest_chars, controls_chars, appendix_chars); the first of equally large ones."""
    kind = H.standard_section(F.col("heading"))
    part = lambda k: F.coalesce(F.sum(F.when(kind == k, F.col("chars"))), F.lit(0)).cast("bigint")
    return extents.groupBy("doc_id").agg(
        F.max_by("heading", F.struct("chars", -F.col("start_seq"))).alias("largest_section"), F.max("chars").alias("largest_chars"), part("controls").alias("controls_chars"), part("appendix").alias("appendix_chars")
    )


def control_density(elements: DataFrame, least: int = 5) -> DataFrame:
    """(doc_id, ids, paragraphs, dense) of documents with control identifiers; each pattern counts for itself."""
    found = reduce(lambda a, b: a + b, [F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)) for p in H.CONTROL_IDS])
    rows = elements.groupBy("doc_id").agg(F.sum(found).cast("bigint").alias("ids"), F.count(F.lit(1)).alias("paragraphs")).where("ids > 0")
    return rows.withColumn("dense", F.col("ids") * PAGE_PARAGRAPHS >= least * F.col("paragraphs"))


def heading_variance(elements: DataFrame, skips: int = 2, fake_part: float = 0.5) -> DataFrame:
    """(doc_id, reasons) of documents that skip levels, have many fake headings, or only headings of level 1."""
    level = F.when(F.col("fake"), 1).otherwise(F.col("level"))
    heads = elements.where(F.col("level").isNotNull()).select("doc_id", "seq", "fake", level.alias("lv")).withColumn("_j", F.col("lv") > F.lag("lv").over(H.by_document()) + 1)
    rows = heads.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_j").alias("skips"), F.count_if("fake").alias("fakes"), F.count_if(~F.col("fake") & (F.col("lv") == 1)).alias("ones"), F.count_if(~F.col("fake") & (F.col("lv") > 1)).alias("deeper")
    )
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("skips") >= skips, F.concat(F.lit("level skips: "), F.col("skips"))),
        F.when(F.col("fakes") >= F.col("n") * fake_part, F.concat(F.lit("fake headings: "), F.col("fakes"), F.lit(" of "), F.col("n"))),
        F.when((F.col("ones") > 1) & (F.col("deeper") == 0), F.lit("flat")),
    )
    return rows.select("doc_id", reasons.alias("reasons")).where("reasons <> ''")


def unlabelled_sections(extents: DataFrame) -> DataFrame:
    """(doc_id, sections, n): headings that are no standard sections, in order."""
    rows = extents.where((F.col("level") > 0) & (H.standard_section(F.col("heading")) == "none")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_seq", "heading"))).alias("_s"))
    return rows.select("doc_id", F.array_join(F.transform("_s", lambda s: s["heading"]), " | ").alias("sections"), F.size("_s").cast("bigint").alias("n"))


def classify(appendix_part: Column, table_part: Column, hits: Column) -> Column:
    """Document type: D by appendix share, A by table share, then B or C by procedure words."""
    return F.when(appendix_part >= 60, "D").when(table_part >= 40, "A").when(table_part <= 10, F.when(hits >= 2, "C").otherwise("B")).otherwise("C")


def document_types(extents: DataFrame, documents: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """(doc_id, doc_type, procedure_hits, reason). ``tables`` has (doc_id, table_chars): the characters in tables, which
    count among those of the text; documents without a row have none."""
    appendix = F.sum(F.when(H.standard_section(F.col("heading")) == "appendix", F.col("chars")).otherwise(0))
    rows = extents.groupBy("doc_id").agg(appendix.alias("appendix"))
    texts = documents.select("doc_id", F.greatest(F.length("text"), F.lit(1)).alias("total"), keyword_hits(F.col("text"), PROCEDURE_WORDS).cast("bigint").alias("procedure_hits"))
    rows = rows.join(texts, "doc_id")
    rows = rows.join(tables.select("doc_id", "table_chars"), "doc_id", "left") if tables is not None else rows.withColumn("table_chars", F.lit(0))
    in_appendix, in_tables = F.col("appendix") * 100 / F.col("total"), F.coalesce("table_chars", F.lit(0)) * 100 / F.col("total")
    kind = classify(in_appendix, in_tables, F.col("procedure_hits"))
    share = lambda x: F.floor(x).cast("string")
    reason = (
        F.when(kind == "D", F.concat(F.lit("appendix "), share(in_appendix), F.lit("%"))).when(kind == "A", F.concat(F.lit("tables "), share(in_tables), F.lit("%")))
        .otherwise(F.concat(F.lit("tables "), share(in_tables), F.lit("%, procedure words "), F.col("procedure_hits").cast("string")))
    )
    return rows.select("doc_id", kind.alias("doc_type"), "procedure_hits", reason.alias("reason"))


def search_terms(texts: DataFrame, terms: Sequence[str], whole_words: bool = True) -> DataFrame:
    """(doc_id, term_<term>...): how often each term occurs as a word, or anywhere if not ``whole_words``, whatever the case."""
    ends = (WORD_START, WORD_END) if whole_words else ("", "")
    count = lambda t: F.regexp_count(F.upper("text"), F.lit(f"{ends[0]}{re.escape(t.upper())}{ends[1]}")).cast("bigint")
    return texts.select("doc_id", *[count(t).alias(f"term_{t.lower()}") for t in terms])


def table_class(header: Column, columns: Column) -> Column:
    """The class whose keywords occur most often in a header row (the first of equals), given enough columns."""
    joined = F.lower(F.array_join(F.transform(header, lambda h: F.left(F.trim(h), F.lit(100))), " "))
    scores = [
        F.struct(F.when(columns >= least, keyword_hits(joined, words)).otherwise(0).alias("s"), F.lit(-k).alias("o"), F.lit(name).alias("name"))
        for k, (name, (least, words)) in enumerate(TABLE_CLASSES.items())
    ]
    best = F.array_max(F.array(*scores))
    return F.when(best["s"] > 0, best["name"]).otherwise("unclassified")


def table_profile(cells: DataFrame) -> DataFrame:
    """(doc_id, table_idx, rows, columns, chars, words, merged, table_class) from cells.

    ``cells`` has (doc_id, table_idx, row_idx, col_idx, tc_id, text); a merged cell is repeated in every grid place.
    """
    header = F.array_sort(F.collect_list(F.when(F.col("row_idx") == 0, F.struct("col_idx", "text"))))
    rows = cells.groupBy("doc_id", "table_idx").agg(
        (F.max("row_idx") + 1).cast("bigint").alias("rows"), (F.max("col_idx") + 1).cast("bigint").alias("columns"), F.sum(F.length("text")).cast("bigint").alias("chars"),
        F.sum(word_count(F.col("text"))).cast("bigint").alias("words"), (F.count("tc_id") > F.count_distinct("tc_id")).alias("merged"), header.alias("_h"),
    )
    header = F.transform("_h", lambda h: h["text"])
    return rows.withColumns({"table_class": table_class(header, F.col("columns")), "header_row": F.array_join(header, " | ")}).drop("_h")


def table_stats(tables: DataFrame) -> DataFrame:
    """(doc_id, tables, table_chars, table_words, merged_tables, classes): totals of ``table_profile``'s rows for each
    document; ``classes`` is a map from class to number of tables."""
    per_class = tables.groupBy("doc_id", "table_class").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("words").alias("words"), F.count_if("merged").alias("merged")
    )
    return per_class.groupBy("doc_id").agg(
        F.sum("n").alias("tables"), F.sum("chars").alias("table_chars"), F.sum("words").alias("table_words"), F.sum("merged").alias("merged_tables"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("table_class", "n")))).alias("classes")
    )


def priority_scores(elements: DataFrame, extents: DataFrame, usage: Mapping[str, float] | None = None, tables: DataFrame | None = None, refs: DataFrame | None = None) -> DataFrame:
    """(doc_id, filename, score): weighted sum of what makes a document laborious.

    ``tables`` has (doc_id, tables, merged_tables), ``refs`` (doc_id, cross_refs); documents without a row have none.
    """
    kinds = extents.withColumn("_k", H.standard_section(F.col("heading"))).groupBy("doc_id").agg(F.count_distinct(F.when(F.col("_k") != "none", F.col("_k"))).alias("kinds"))
    own = elements.groupBy("doc_id", "filename").agg(F.count_if("fake").alias("fakes"), F.count(F.lit(1)).alias("paragraphs"), F.sum(F.length("text")).alias("chars"))
    rows = own.join(kinds, "doc_id")
    rows = rows.join(tables.select("doc_id", "tables", "merged_tables"), "doc_id", "left") if tables is not None else rows.withColumns({"tables": F.lit(0), "merged_tables": F.lit(0)})
    rows = rows.join(refs.select("doc_id", "cross_refs"), "doc_id", "left") if refs is not None else rows.withColumn("cross_refs", F.lit(0))
    weighed = lambda column, weight: F.coalesce(F.col(column), F.lit(0)) * WEIGHTS[weight]
    score = (
        weighed("tables", "tables") + weighed("cross_refs", "cross_refs") + weighed("merged_tables", "merged_tables") + weighed("fakes", "fake_headings")
        + (len(H.STANDARD_SECTIONS) - F.col("kinds")) * WEIGHTS["missing_sections"] + pages(F.col("paragraphs")) * WEIGHTS["pages"]
        + F.when(F.col("chars") > SPLIT_CHARS, OVER_LIMIT_BONUS).otherwise(0.0)
    )
    if usage:
        score = score + USAGE_WEIGHT * F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in usage.items() for x in kv]), F.col("filename")), F.lit(0.0))
    return rows.select("doc_id", "filename", score.alias("score"))


def ranked(scores: DataFrame) -> DataFrame:
    """(doc_id, filename, score_100, priority_rank): rank by falling score, then file name (``order.numbered``)."""
    rows = scores.select("doc_id", "filename", F.round(F.col("score") * 100).cast("bigint").alias("score_100"))
    return numbered(rows, [F.desc("score_100"), F.asc("filename")], "priority_rank")


def summary(profile: DataFrame) -> DataFrame:
    """(label, value): totals over all documents."""
    total = profile.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("characters"), F.sum("words").alias("words"), F.sum("paragraphs").alias("paragraphs"), F.count_if("over_limit").alias("over_limit"), F.max("chars").alias("largest")
    )
    return total.unpivot([], total.columns, "label", "value")


def conversion_stats(elements: DataFrame) -> DataFrame:
    """(doc_id, paragraphs, headings, blank, with_pipe)."""
    blank = F.trim("text") == ""
    return elements.groupBy("doc_id").agg(F.count_if(F.col("level").isNull() & ~blank).alias("paragraphs"), F.count("level").alias("headings"), F.count_if(blank).alias("blank"), F.count_if(F.contains("text", F.lit("|"))).alias("with_pipe"))


def freshness(modified: Column, as_of: Column) -> Column:
    """Age band of a date: over 365 days, over 30 days, else current; null stays null."""
    age = F.date_diff(as_of, modified)
    return F.when(age > 365, "Overdue").when(age > 30, "Review Soon").when(age.isNotNull(), "Current")


def totals_over_limit(parts: DataFrame, size: str, limit: int = SPLIT_CHARS) -> DataFrame:
    """(parts, over_limit, largest): how many parts a split left over the limit."""
    return parts.agg(F.count(F.lit(1)).alias("parts"), F.count_if(F.col(size) > limit).alias("over_limit"), F.max(size).alias("largest"))


def step_report(found: DataFrame, step: str, file: str, error: str) -> DataFrame:
    """(step, file, rows, failures): what a step made of each file, and how often it failed there."""
    return found.groupBy(F.col(file).alias("file")).agg(F.count_if(F.col(error).isNull()).alias("rows"), F.count(error).alias("failures")).select(F.lit(step).alias("step"), "file", "rows", "failures")


def with_all_keys(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames with the columns of any; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
