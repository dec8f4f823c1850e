"""Deletions and rewrites of ordered elements, in the order that ``CLEANING_ORDER`` fixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.headings import by_document, mapped_style, numbered_level, style_level

CLEANING_ORDER = (
    "tracked_changes", "comments", "table_of_contents", "headers_footers", "page_numbers", "phrases",
    "headings", "revision_tables", "definition_tables", "sections", "italics",
)
# Paragraphs that are page numbers.
PAGE_NUMBERS = (r"(?i)^Page\s+\d+(\s+of\s+\d+)?$", r"^\d+$", r"^-\s*\d+\s*-$")


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def matches_filter(value: Column, patterns: Sequence[str]) -> Column:
    """Equal to a pattern, or beginning with what stands before its final ``*``."""
    return _any([F.startswith(value, F.lit(p[:-1])) if p.endswith("*") else value == p for p in patterns])


def apply_filters(df: DataFrame, column: str, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> DataFrame:
    """Rows that the allowed patterns match (all without such patterns) and no denied one does; null values never match."""
    value = F.coalesce(F.col(column), F.lit(""))
    kept = df.where(matches_filter(value, allow)) if allow else df
    return kept.where(~matches_filter(value, deny)) if deny else kept


def delete_phrases(text: Column, phrases: Sequence[str], ignore_case: bool = True) -> Column:
    """The text without the phrases, double blanks collapsed, ends trimmed."""
    quoted = [("(?i)" if ignore_case else "") + "".join("\\" + c if not c.isalnum() and c != " " else c for c in p) for p in phrases]
    return F.trim(F.regexp_replace(reduce(lambda t, p: F.regexp_replace(t, p, ""), quoted, text), "  +", " "))


def phrase_log(df: DataFrame, key: str, text: str, phrases: Sequence[str]) -> DataFrame:
    """(key, phrase): one row for each phrase that a text holds, whatever the case."""
    low = F.lower(text)
    return df.select(key, F.explode(F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p.lower())), F.lit(p)) for p in phrases]))).alias("phrase"))


def in_deleted_section(target: Column, deepest: int = 4) -> Column:
    """Whether an element lies in a section whose heading is a target: at it or after it, before the next heading of
    its level or less. One pass is enough, since sections nest or abut. Needs doc_id, seq and level."""
    w = by_document().rowsBetween(Window.unboundedPreceding, 0)
    inside = []
    for k in range(1, deepest + 1):
        aim = F.max(F.when(target & (F.col("level") == k), F.col("seq"))).over(w)
        cut = F.max(F.when(F.col("level") <= k, F.col("seq"))).over(w)
        inside.append(F.coalesce(aim == cut, F.lit(False)))
    return _any(inside)


def delete_sections(elements: DataFrame, contains: Sequence[str] = (), equals: Sequence[str] = ()) -> DataFrame:
    """Elements outside the sections whose heading contains or equals one of the names, whatever the case."""
    low = F.lower(F.trim("text"))
    target = _any([F.contains(low, F.lit(x.lower())) for x in contains] + [low == x.lower() for x in equals])
    return elements.withColumn("_gone", in_deleted_section(target)).where(~F.col("_gone")).drop("_gone")


def delete_page_numbers(elements: DataFrame) -> DataFrame:
    return elements.where(~_any([F.trim("text").rlike(p) for p in PAGE_NUMBERS]))


def delete_contents(elements: DataFrame) -> DataFrame:
    """Without the paragraphs in a style of the table of contents."""
    return elements.where(~F.startswith(F.upper(F.coalesce("style", F.lit(""))), F.lit("TOC")))


def delete_margins(parts: DataFrame) -> DataFrame:
    """Without headers and footers."""
    return parts.where(~F.coalesce(F.col("location").rlike(r"^(header|footer)\d*$"), F.lit(False)))


def is_revision_table(header: Column) -> Column:
    """A header row with version, date, and one of changes, description, author, modified by."""
    has = lambda word: F.exists(header, lambda h: F.contains(F.lower(h), F.lit(word)))
    return has("version") & has("date") & _any([has(w) for w in ("changes", "description", "author", "modified by")])


def control_table_kind(header: Column) -> Column:
    """``control``, ``skip`` or ``other`` by the words of a header row."""
    has = lambda word: F.exists(header, lambda h: F.contains(F.lower(h), F.lit(word)))
    ident = has("control id") | has("control #") | (has("control") & has("description"))
    return F.when(ident, "control").when(is_revision_table(header) | (has("term") & has("definition")) | has("acronym"), "skip").otherwise("other")


def flatten_definitions(elements: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc_id, seq, text): the rows of the first table after a heading on terms as ``term: definition`` paragraphs.

    ``elements`` has (doc_id, seq, kind, text, level, table_idx); the table must come before the next heading. The
    first row is a header; rows without term are dropped. New paragraphs get places between the table and the next.
    """
    w = by_document()
    heads = F.last(F.when(F.col("level").isNotNull(), F.struct("seq", F.lower("text").alias("t"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    tables = elements.withColumn("_h", heads).where((F.col("kind") == "table") & F.col("_h.t").rlike("terms|definitions|glossary"))
    first = tables.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "_h.seq").orderBy("seq"))).where("_n = 1").select("doc_id", "seq", "table_idx")
    rows = cells.where("row_idx > 0 and col_idx < 2").groupBy("doc_id", "table_idx", "row_idx").agg(F.max(F.when(F.col("col_idx") == 0, F.trim("text"))).alias("term"), F.max(F.when(F.col("col_idx") == 1, F.trim("text"))).alias("meaning"))
    return first.join(rows.where("term <> ''"), ["doc_id", "table_idx"]).select("doc_id", (F.col("seq") + F.col("row_idx") / 1_000_000).alias("seq"), F.concat_ws(": ", "term", "meaning").alias("text"))


def drop_italics(runs: Column) -> Column:
    return F.transform(runs, lambda r: r.withField("italic", F.lit(False)))


def collapse_blank_lines(text: Column, most: int = 1) -> Column:
    """At most ``most`` blank lines one after the other; trailing blanks of lines and of the text dropped."""
    tidy = F.regexp_replace(F.regexp_replace(text, r"[ \t]+\n", "\n"), r"\n{%d,}" % (most + 2), "\n" * (most + 1))
    return F.regexp_replace(tidy, r"\s+$", "")


def visible_rows(df: DataFrame, grants: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows that any grant shows: a grant names a column and the values that the reader may see; ``*`` shows all."""
    if any("*" in values for values in grants.values()):
        return df
    return df.where(_any([F.col(c).isin(list(values)) for c, values in grants.items()]))


def drop_comments(parts: DataFrame) -> DataFrame:
    """Parts of packages without those that hold comments, and runs without their marks."""
    kept = parts.where(~F.coalesce(F.col("location").rlike(r"^comments"), F.lit(False)))
    return kept.withColumn("text", F.regexp_replace("text", r"\[comment:\d+\]", "")) if "text" in parts.columns else kept


def clean(elements: DataFrame, phrases: Sequence[str] = (), custom: Mapping[str, str] | None = None, contains: Sequence[str] = (), equals: Sequence[str] = (), steps: Sequence[str] = CLEANING_ORDER) -> tuple[DataFrame, DataFrame]:
    """(elements, log): the chosen steps of ``CLEANING_ORDER``, always in that order, over (doc_id, seq, location, text, rejected,
    style, level, fake, header, runs); a step whose columns the elements lack is refused.

    ``text`` is the accepted view, ``header`` the first row of a table or null. The log has (doc_id, step, removed,
    changed) for every step that did something. All windows are by document, so the steps share one exchange.
    """
    unknown = [s for s in steps if s not in CLEANING_ORDER]
    if unknown:
        raise ValueError(f"no such steps: {unknown}")
    none = F.lit(False)
    header = F.coalesce(F.col("header"), F.array().cast("array<string>"))
    gone: dict[str, Column] = {
        "comments": F.coalesce(F.col("location").rlike(r"^comments"), none), "table_of_contents": F.startswith(F.upper(F.coalesce("style", F.lit(""))), F.lit("TOC")),
        "headers_footers": F.coalesce(F.col("location").rlike(r"^(header|footer)\d*$"), none), "page_numbers": F.coalesce(_any([F.trim("text").rlike(p) for p in PAGE_NUMBERS]), none), "revision_tables": is_revision_table(header),
    }
    low = F.lower(F.trim("text"))
    target = _any([F.contains(low, F.lit(x.lower())) for x in contains] + [low == x.lower() for x in equals])
    new: dict[str, dict[str, Column]] = {
        "tracked_changes": {"rejected": F.col("text")}, "phrases": {"text": delete_phrases(F.col("text"), phrases)},
        "headings": {"style": F.coalesce(F.when(mapped_style(F.col("style"), custom or {}) != F.col("style"), mapped_style(F.col("style"), custom or {})), F.when(F.col("fake"), F.concat(F.lit("Heading "), numbered_level(F.col("text")).cast("string"))), F.col("style"))},
        "definition_tables": {"text": F.when(F.exists(header, lambda h: F.contains(F.lower(h), F.lit("term"))), F.concat_ws(": ", header)).otherwise(F.col("text"))}, "italics": {"runs": drop_italics(F.col("runs"))},
    }
    rows = elements.withColumns({"_by": F.lit(None).cast("string"), "_did": F.array().cast("array<string>")})
    for step in (s for s in CLEANING_ORDER if s in steps):
        alive = F.col("_by").isNull()
        if step in gone or step == "sections":
            hit = gone[step] if step in gone else F.coalesce(in_deleted_section(F.coalesce(alive & target & F.col("level").isNotNull(), none)), none)
            rows = rows.withColumn("_by", F.when(alive & hit, F.lit(step)).otherwise(F.col("_by")))
        else:
            values = {k: F.when(alive, v).otherwise(F.col(k)) for k, v in new[step].items()}
            differs = _any([~F.col(k).eqNullSafe(v) for k, v in values.items()])
            rows = rows.withColumns({**values, "_did": F.when(differs, F.array_append("_did", F.lit(step))).otherwise(F.col("_did"))})
            if step == "headings":
                rows = rows.withColumn("level", F.coalesce(F.when(alive, style_level(F.col("style"))), F.col("level")))
    removed = rows.where("_by is not null").groupBy("doc_id", F.col("_by").alias("step")).agg(F.count(F.lit(1)).alias("removed")).withColumn("changed", F.lit(0).cast("bigint"))
    changed = rows.select("doc_id", F.explode("_did").alias("step")).groupBy("doc_id", "step").agg(F.count(F.lit(1)).alias("changed")).withColumn("removed", F.lit(0).cast("bigint"))
    return rows.where("_by is null").drop("_by", "_did"), removed.unionByName(changed)
