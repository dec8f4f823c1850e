"""Wide frames for reading by people: the inventory of documents, its lists and summary, and the review sheet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators import crossrefs as X
from paperloom.operators import headings as H
from paperloom.operators import profile as G

#: What marks a document's package, and what the inventory says of it.
ANOMALIES = ("has_text_boxes", "has_tracked_changes", "has_comments", "has_images", "has_embedded_objects", "has_password_protection")
#: Shares and numbers from which a document is called dense.
TABLE_DENSE = 30


def marks(texts: DataFrame) -> DataFrame:
    """(doc_id, seq, cross_ref_text, pattern_matched): every match of the profiler's patterns, whatever the case, in the
    order of patterns, with its label. ``texts`` has (doc_id, seq, text)."""
    def found(pattern: str, label: str) -> Column:
        return F.transform(F.regexp_extract_all("text", F.lit("(?i)" + pattern), F.lit(0)), lambda m: F.struct(m.alias("cross_ref_text"), F.lit(label).alias("pattern_matched")))

    every = F.concat(*[found(p, label) for p, label in X.PROFILE_PATTERNS.items()])
    return texts.where(F.col("text").isNotNull()).select("doc_id", "seq", F.inline(every))


def reference_counts(texts: DataFrame) -> DataFrame:
    """(doc_id, cross_refs, cross_ref_patterns) of documents with any; the second is a map from label to count."""
    counts = marks(texts).groupBy("doc_id", "pattern_matched").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("doc_id").agg(F.sum("n").alias("cross_refs"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern_matched", "n")))).alias("cross_ref_patterns"))


def crossref_list(elements: DataFrame) -> DataFrame:
    """(filename, cross_ref_text, pattern_matched, paragraph_index, parent_section), the latter the last heading of level
    1 or 2 before. ``elements`` has the filename."""
    rows = H.parent_heading(elements, "parent_section")
    return marks(rows).join(rows.select("doc_id", "seq", "filename", "parent_section"), ["doc_id", "seq"]).select("filename", "cross_ref_text", "pattern_matched", F.col("seq").cast("bigint").alias("paragraph_index"), "parent_section")


def section_list(elements: DataFrame) -> DataFrame:
    """The list of sections, ten columns: file, heading with level, style and origin, standard section, size, and the
    references in the lines from the heading to the next one of level 1 to 3."""
    own = F.last(F.when(~F.col("fake") & (F.col("level") <= 3), F.col("seq")), ignorenulls=True).over(H.by_document().rowsBetween(Window.unboundedPreceding, 0))
    hits = sum((F.coalesce(F.regexp_count("text", F.lit("(?i)" + p)), F.lit(0)) for p in X.PROFILE_PATTERNS), F.lit(0))
    refs = elements.withColumn("start_seq", F.coalesce(own, F.lit(0)).cast("bigint")).groupBy("doc_id", "start_seq").agg(F.sum(hits).cast("bigint").alias("cross_ref_count"))
    heads = elements.select("doc_id", F.col("seq").cast("bigint").alias("start_seq"), "filename", "style", "fake")
    rows = H.section_extents(elements).join(heads, ["doc_id", "start_seq"]).join(refs, ["doc_id", "start_seq"], "left")
    return rows.select(
        "filename", F.col("heading").alias("section_heading"), F.col("level").alias("heading_level"), F.col("style").alias("heading_style"), H.is_heading_style(F.col("style")).alias("is_builtin_style"), F.col("fake").alias("is_fake_heading"),
        H.standard_section(F.col("heading")).alias("standard_section"), F.col("chars").alias("char_count"), F.col("paragraphs").alias("paragraph_count"), F.coalesce("cross_ref_count", F.lit(0)).alias("cross_ref_count"),
    )


def table_list(tables: DataFrame, names: DataFrame) -> DataFrame:
    """The list of tables, eight columns, from ``profile.table_profile``; ``names`` has (doc_id, filename)."""
    return tables.join(names, "doc_id").select("filename", F.col("table_idx").alias("table_index"), "rows", F.col("columns").alias("cols"), F.col("table_class").alias("classification"), F.col("merged").alias("has_merged_cells"), F.col("chars").alias("char_count"), "header_row")


def _text_of(counts: Column) -> Column:
    """A map from name to count as text, in the order of names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string"))), "; ")


def inventory(elements: DataFrame, documents: DataFrame, tables: DataFrame, terms: tuple[str, ...] = (), flags: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """One row for each document with everything the profile knows, and one column for each search term, by rank.

    ``documents`` has (doc_id, filename, text), ``tables`` is ``profile.table_profile``'s frame, ``flags`` has
    (doc_id, <anomaly>..., nested_tables), ``errors`` (filename, error): files that could not be read, which get a row of
    type ``Error`` without rank.
    """
    extents = H.section_extents(elements)
    stats, refs = G.table_stats(tables), reference_counts(elements)
    rows = G.sizes(elements)
    for frame in (
        G.heading_counts(elements), G.standard_presence(extents), G.largest_section(extents), G.control_density(elements).drop("paragraphs"), G.heading_variance(elements), G.unlabelled_sections(extents).withColumnsRenamed({"n": "unique_section_count", "sections": "unique_sections"}),
        stats, refs, G.document_types(extents, documents, stats),
    ):
        rows = rows.join(frame, "doc_id", "left")
    if terms:
        rows = rows.join(G.search_terms(documents.where("text is not null"), terms), "doc_id", "left")
    if flags is not None:
        rows = rows.join(flags, "doc_id", "left")
    ranks = G.ranked(G.priority_scores(elements, extents, tables=stats, refs=refs))
    rows = rows.join(ranks, "doc_id")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    share = F.coalesce("table_chars", F.lit(0)) * 100 / F.greatest("chars", F.lit(1))
    out = rows.select(
        "priority_rank", "score_100", "doc_id", "filename", "doc_type", "reason", "chars", "words", "paragraphs", "pages", "over_limit",
        *[n(c) for c in ("headings", "h1", "h2", "h3", "fake_headings", "builtin_headings")], *[yes(f"has_{k}") for k in H.STANDARD_SECTIONS], "missing", "largest_section", "largest_chars", "controls_chars", "appendix_chars",
        *[n(c) for c in ("tables", "table_chars", "table_words", "merged_tables")], _text_of(F.col("classes")).alias("table_classes"), (share >= TABLE_DENSE).alias("table_dense"), n("cross_refs"), _text_of(F.col("cross_ref_patterns")).alias("cross_ref_patterns"),
        F.coalesce("ids", F.lit(0)).cast("bigint").alias("control_ids"), F.coalesce("dense", F.lit(False)).alias("control_dense"), F.col("reasons").alias("heading_variance"), n("unique_section_count"), "unique_sections", n("procedure_hits"),
        *[f"term_{t.lower()}" for t in terms], *([yes(a) for a in ANOMALIES] + [n("nested_tables")] if flags is not None else []),
    )
    if errors is not None:
        bad = errors.select("filename", F.lit("Error").alias("doc_type"), F.col("error").alias("reason"))
        out = out.unionByName(bad, allowMissingColumns=True)
    return out


def corpus_summary(rows: DataFrame) -> DataFrame:
    """(label, value): counts by type and condition, averages and totals over the rows of ``inventory``."""
    known = F.col("doc_type") != "Error"
    have = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("double")
    mean = lambda c, places: F.coalesce(F.round(F.avg(F.when(known, c)), places), F.lit(0.0)).cast("double")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
    lines: Mapping[str, Column] = {
        "documents": F.count(F.lit(1)).cast("double"), **{f"type {t}": have(F.col("doc_type") == t) for t in ("A", "B", "C", "D", "Error")}, "over limit": have(F.col("over_limit")), "with fake headings": have(F.col("fake_headings") > 0),
        "with merged tables": have(F.col("merged_tables") > 0), "with cross-references": have(F.col("cross_refs") > 0), "missing standard sections": have(F.col("missing") != ""), "control dense": have(F.col("control_dense")),
        "heading variance": have(F.col("heading_variance") != ""), "table dense": have(F.col("table_dense")), "with unique sections": have(F.col("unique_section_count") > 0), "average controls a page": mean(F.col("control_ids") / F.greatest("pages", F.lit(0.1)), 1),
        "average characters": mean(F.col("chars"), 0), "average words": mean(F.col("words"), 0), "average pages": mean(F.col("pages"), 1), "average tables": mean(F.col("tables"), 1), "average cross-references": mean(F.col("cross_refs"), 1),
        "total words": total("words"), "total tables": total("tables"), "total cross-references": total("cross_refs"),
    }
    return rows.agg(*[c.alias(k) for k, c in lines.items()]).unpivot([], list(lines), "label", "value")


def review_sheet(scored: DataFrame, context: DataFrame) -> DataFrame:
    """The 14 columns of the review sheet, ``Row #`` from 1 by rising confidence, file and identifier.

    ``scored`` is ``validation.confidence``'s frame, ``context`` has (control_id, context).
    """
    from paperloom.operators.order import numbered

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = scored.drop("context").join(context.select(F.col("control_id").alias("_k"), "context"), F.col("control_id") == F.col("_k"), "left").select(
        F.col("score").alias("Confidence"), F.array_join("flags", ", ").alias("Flags"), text("control_id").alias("Control ID"), text("source_file").alias("Source File"), text("section_header").alias("Section Header"), text("extraction_source").alias("Extraction Source"),
        F.coalesce("context", F.lit("(Source document not available)")).alias("Source Context"), text("control_description").alias("Extracted Description"), text("supplemental_guidance").alias("Extracted Guidance"), text("baseline").alias("Baseline"), text("control_name").alias("Control Name"),
        F.lit("").alias("Validation Status"), F.lit("").alias("Reviewer Notes"), F.col("row_id").alias("_id"),
    )
    return numbered(rows, [F.col("Confidence"), F.col("`Source File`"), F.col("`Control ID`"), F.col("_id")], "Row #").drop("_id")


def export_rows(controls: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Rows in the columns of an export: each is a column of the controls or an expression; nulls are empty texts."""
    return controls.select(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")).alias(k) for k, c in columns.items()])
