"""Headings and sections of ordered elements (doc_id, seq, text, style, level, ...).

All windows share one specification, so that one exchange and one sort by document serve them all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import first_category, word_count

# Keywords of the standard sections, in order.
STANDARD_SECTIONS = {
    "purpose": ("purpose", "policy purpose", "1.0 purpose", "document purpose"),
    "scope": ("scope", "policy scope", "2.0 scope", "applicability", "applicability and scope"),
    "intent": ("intent", "policy intent", "3.0 intent", "objective", "policy objective", "security objective"),
    "controls": ("controls", "technical controls", "security controls", "4.0 controls", "control requirements", "requirements", "policy requirements", "implementation requirements"),
    "appendix": ("appendix", "appendices", "5.0 appendix", "supplementary", "reference", "references", "glossary", "definitions"),
}
# Numbering of headings.
NUMBERED_1, NUMBERED_2, NUMBERED_3 = r"^(?:\d+\.0\s+|[IVXLC]+\.\s+)", r"^(?:\d+\.\d+\s+|[A-Z]\.\s+)", r"^\d+\.\d+\.\d+\s+"
# Identifiers of control records.
CONTROL_IDS = (r"\b[A-Z]{2,4}[-.]?\d{1,3}[-.]\d{2,4}\b", r"\b[A-Z]{2,4}\s+\d{1,3}\.\d{2,4}\b", r"\b[A-Z]{2,4}\d{2,3}\.\d{2,4}\b")
ANY_CONTROL_ID = "|".join(f"(?:{p})" for p in CONTROL_IDS)

NO_HEADING, NO_HEADINGS, UNKNOWN = "(No heading found)", "(No headings)", "(unknown)"


def by_document(key: str = "doc_id", order: str = "seq"):
    return Window.partitionBy(key).orderBy(order)


def before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def after(window):
    return window.rowsBetween(1, Window.unboundedFollowing)


def is_heading_style(style: Column) -> Column:
    return style.rlike(r"^Heading \d$")


def style_level(style: Column) -> Column:
    """Level 1 to 9 of a heading style, else null."""
    return F.nullif(F.regexp_extract(style, r"^Heading (\d)$", 1), F.lit("")).cast("int")


def mapped_style(style: Column, custom: Mapping[str, str]) -> Column:
    """The heading style that a custom style (whatever its case) stands for, else the style itself."""
    if not custom:
        return style
    table = F.create_map(*[F.lit(x) for k, v in custom.items() for x in (k.lower(), v)])
    return F.coalesce(F.element_at(table, F.lower(style)), style)


def all_bold(runs: Column, style_bold: Column) -> Column:
    """Bold by its style, or every run bold and at least one run."""
    return F.coalesce(style_bold, F.lit(False)) | ((F.size(runs) > 0) & F.forall(runs, lambda r: F.coalesce(r["bold"], F.lit(False))))


def is_fake_heading(text: Column, style: Column, bold: Column, most: int = 120) -> Column:
    """A short bold paragraph of another style that does not end with a full stop."""
    t = F.trim(text)
    return bold & (F.length(t) > 0) & ~is_heading_style(style) & (F.length(t) < most) & ~F.endswith(t, F.lit("."))


def is_fake_heading_by_size(text: Column, any_bold: Column, size: Column, least: float = 12, most: int = 200) -> Column:
    """The profiler's definition: some bold, at most ``most`` characters, large, or without size and at most 100."""
    n = F.length(F.trim(text))
    return any_bold & (n > 0) & (n <= most) & ((size >= least) | (size.isNull() & (n <= 100)))


def numbered_level(text: Column, otherwise: int = 2) -> Column:
    """Level by numbering; three numbers go before a zero or roman number, that before two numbers or a letter."""
    return F.when(text.rlike(NUMBERED_3), 3).when(text.rlike(NUMBERED_1), 1).when(text.rlike(NUMBERED_2), 2).otherwise(otherwise)


def effective_level(style: Column, custom: Mapping[str, str], text: Column, fake: Column) -> Column:
    """Level by style, else by custom style, else by numbering for fake headings; null for other paragraphs."""
    return F.coalesce(style_level(mapped_style(style, custom)), F.when(fake, numbered_level(text)))


def restyle_log(elements: DataFrame, custom: Mapping[str, str]) -> DataFrame:
    """(doc_id, seq, original_style, new_style, preview, change_type): custom styles first, then fake headings."""
    mapped = mapped_style(F.col("style"), custom)
    new = F.when(mapped != F.col("style"), mapped).when(F.col("fake"), F.concat(F.lit("Heading "), numbered_level(F.col("text")).cast("string")))
    kind = F.when(mapped != F.col("style"), "custom_style").otherwise("fake_heading")
    rows = elements.select("doc_id", "seq", F.col("style").alias("original_style"), new.alias("new_style"), F.left("text", F.lit(80)).alias("preview"), kind.alias("change_type"))
    return rows.where(F.col("new_style").isNotNull() & (F.col("new_style") != F.col("original_style")))


def parent_heading(elements: DataFrame, out: str = "parent_heading", deepest: int = 2) -> DataFrame:
    """Add the nearest heading strictly before each element, of level 1 to ``deepest``."""
    last = F.last(F.when(F.col("level") <= deepest, F.col("text")), ignorenulls=True).over(before(by_document()))
    return elements.withColumn(out, F.coalesce(last, F.lit(NO_HEADING)))


def section_of(elements: DataFrame, out: str = "section") -> DataFrame:
    """Add the heading (of any level) that is last at or before each element."""
    last = F.last(F.when(F.col("level").isNotNull(), F.col("text")), ignorenulls=True).over(by_document().rowsBetween(Window.unboundedPreceding, 0))
    return elements.withColumn(out, F.coalesce(last, F.lit(UNKNOWN)))


def section_extents(elements: DataFrame, deepest: int = 3) -> DataFrame:
    """(doc_id, start_seq, end_seq, level, heading, chars, paragraphs) of every section, nested ones overlapping.

    A section of level k ends before the next heading of level k or less; its characters are those of its paragraphs
    with one between two, the heading included. Running sums give the sizes, so no paragraph is joined to a section.
    A document without headings is one section, chosen with the others and not by a union: within larger plans, Spark loses
    the partitioning of a union that it has relied on, and the query fails.
    """
    w = by_document()
    real = F.when(~F.col("fake"), F.col("level"))
    size = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    rows = elements.select("doc_id", "seq", "text", real.alias("level"), size.alias("n")).withColumn("sum_before", F.sum("n").over(w) - F.col("n"))
    total, count = F.sum("n").over(Window.partitionBy("doc_id")), F.max("seq").over(Window.partitionBy("doc_id")) + 1
    has = F.max(F.when(F.col("level") <= deepest, 1)).over(Window.partitionBy("doc_id"))
    end = {k: F.min(F.when(F.col("level") <= k, F.struct("seq", "sum_before"))).over(after(w)) for k in range(1, deepest + 1)}
    chosen = F.coalesce(*[F.when(F.col("level") == k, end[k]) for k in end])
    rows = rows.withColumns({"e": chosen, "total": total, "count": count.cast("bigint"), "has": has})
    whole = F.col("has").isNull() & (F.col("seq") == 0)
    zero = F.lit(0).cast("bigint")
    sections = rows.where(F.col("level").between(1, deepest) | whole).select(
        "doc_id", F.col("seq").cast("bigint").alias("start_seq"), F.coalesce(F.col("e.seq").cast("bigint"), F.col("count")).alias("end_seq"), F.when(whole, zero).otherwise(F.col("level").cast("bigint")).alias("level"),
        F.when(whole, F.lit(NO_HEADINGS)).otherwise(F.col("text")).alias("heading"), F.when(whole, zero).otherwise(F.col("sum_before")).alias("sum_before"), F.coalesce(F.col("e.sum_before"), F.col("total")).alias("sum_end"),
    )
    n = F.col("end_seq") - F.col("start_seq")
    return sections.select("doc_id", "start_seq", "end_seq", "level", "heading", (F.col("sum_end") - F.col("sum_before") + n - 1).alias("chars"), n.alias("paragraphs"))


def standard_section(heading: Column) -> Column:
    return first_category(heading, STANDARD_SECTIONS)


def level_skips(elements: DataFrame) -> DataFrame:
    """(doc_id, headings, skips): how often a heading is more than one level below the one before."""
    heads = elements.where(F.col("level").isNotNull()).select("doc_id", "seq", F.when(F.col("fake"), 1).otherwise(F.col("level")).alias("level"))
    jumped = F.col("level") > F.lag("level").over(by_document()) + 1
    return heads.withColumn("_j", jumped).groupBy("doc_id").agg(F.count(F.lit(1)).alias("headings"), F.count_if("_j").alias("skips"))


def breadcrumbs(elements: DataFrame) -> DataFrame:
    """Add h1, h2, h3: the headings above each element; a shallower heading clears the deeper ones."""
    w = by_document().rowsBetween(Window.unboundedPreceding, 0)
    last = {k: F.last(F.when(F.col("level") == k, F.struct("seq", "text")), ignorenulls=True).over(w) for k in (1, 2, 3)}
    rows = elements.withColumns({f"_l{k}": c for k, c in last.items()})
    under = lambda k: F.greatest(*[F.coalesce(F.col(f"_l{j}.seq"), F.lit(-1)) for j in range(1, k)], F.lit(-1)) if k > 1 else F.lit(-1)
    return rows.withColumns({f"h{k}": F.when(F.col(f"_l{k}.seq") > under(k), F.col(f"_l{k}.text")) for k in (1, 2, 3)}).drop("_l1", "_l2", "_l3")


def is_section_header(text: Column, style: Column, first_bold: Column) -> Column:
    """Whether a paragraph heads a section: five signals in order; never if it holds a control identifier."""
    t = F.trim(text)
    caps = (t == F.upper(t)) & (F.length(t) < 80) & ~F.endswith(t, F.lit(".")) & (word_count(t) >= 3)
    bold = first_bold & (F.length(t) < 60) & ~F.endswith(t, F.lit(".")) & ~F.endswith(t, F.lit(":"))
    signal = is_heading_style(style) | t.rlike(r"^[Ss]ection\s+\d{1,2}") | t.rlike(r"^\d{1,2}\.?\d{0,2}\s+[A-Z][a-zA-Z\s]{3,50}$") | caps | bold
    return (F.length(t) > 0) & ~t.rlike(ANY_CONTROL_ID) & signal


def shifted_levels(elements: DataFrame, deepest: int = 2) -> DataFrame:
    """Add ``out_level``: levels moved so that a document's least is 1, at most ``deepest``."""
    least = F.min("level").over(Window.partitionBy("doc_id"))
    return elements.withColumn("out_level", F.least(F.col("level") - least + 1, F.lit(deepest)))
