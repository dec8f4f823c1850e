"""References to sections and documents, and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases, words for documents, and the profiler's patterns with the label of each.
INTERNAL_PHRASES = ("see", "refer to", "per", "as described in", "as defined in")
EXTERNAL_PHRASES = ("as described in", "as defined in", "refer to", "in accordance with")
DOCUMENT_WORDS = ("Policy", "Standard", "Plan", "Procedure", "Guide", "Guideline", "Program", "Framework", "Charter")
PROFILE_PATTERNS = {
    r"see section\s+[\d\.]+[a-z]?": "See section reference",
    r"refer to\s+(section|the)": "Refer to clause/section",
    r"as described in\s+(the|section)": "As described in reference",
    r"per section\s+[\d\.]+": "Per section reference",
    r"in accordance with\s+(the|section)": "In accordance with",
    r"as defined in\s+(the|section)": "As defined in reference",
    r"as outlined in\s+(the|section)": "As outlined in reference",
    r"per the organization'?s\s+\w+": "Per organization document",
    r"see the\s+\w+\s+policy": "See policy reference",
    r"as specified in\s+(the|section)": "As specified in reference",
}
URL = r"https?://[^\s<>\"]+|www\.[^\s<>\"]+"


def reference_patterns(internal: Sequence[str] = INTERNAL_PHRASES, external: Sequence[str] = EXTERNAL_PHRASES, words: Sequence[str] = DOCUMENT_WORDS) -> list[tuple[str, str]]:
    """(type, pattern) in order; group 1 of a pattern is what is referred to."""
    ends = "|".join(words)
    return [("internal", rf"(?i)\b{p}\s+section\s+(\d+(?:\.\d+)*)") for p in internal] + [("external", rf"\b(?i:{p})\s+(?:the\s+)?([A-Z][A-Za-z\s&-]{{4,}}?(?:{ends}))\b") for p in external]


def references(elements: DataFrame, patterns: Sequence[tuple[str, str]], keep: Sequence[str] = ("doc_id", "seq"), text: str = "text") -> DataFrame:
    """(keep..., ord, match_no, reference_type, matched, target): all matches of all patterns of every paragraph."""
    def found(k: int, kind: str, pattern: str) -> Column:
        whole, target = (F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(g)) for g in (0, 1))
        as_row = lambda z, i: F.struct(F.lit(k).cast("bigint").alias("ord"), i.cast("bigint").alias("match_no"), F.lit(kind).alias("reference_type"), z["m"].alias("matched"), z["t"].alias("target"))
        return F.transform(F.arrays_zip(whole.alias("m"), target.alias("t")), as_row)

    rows = F.concat(*[found(k, kind, p) for k, (kind, p) in enumerate(patterns)])
    return elements.where(F.col(text).isNotNull()).select(*keep, F.inline(rows))


def pattern_counts(elements: DataFrame, patterns: Sequence[str] = tuple(PROFILE_PATTERNS), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pattern, n): how often each pattern occurs in a document, whatever the case."""
    counts = F.array(*[F.struct(F.lit(readable(p)).alias("pattern"), F.coalesce(F.regexp_count(F.col(text), F.lit("(?i)" + p)), F.lit(0)).cast("bigint").alias("n")) for p in patterns])
    rows = elements.select(key, F.inline(counts)).where("n > 0")
    return rows.groupBy(key, "pattern").agg(F.sum("n").alias("n"))


def readable(pattern: str) -> str:
    """A pattern's label: the fixed one of the profiler's patterns, any other as it is after ``Pattern: ``."""
    return PROFILE_PATTERNS.get(pattern, f"Pattern: {pattern}")


def link_kind(text: Column) -> Column:
    """What a link's text refers to: ``internal`` for a section, ``external`` for a document, else null."""
    return F.when(text.rlike(r"(?i)^\s*section\s+\d"), "internal").when(text.rlike(r"\b(" + "|".join(DOCUMENT_WORDS) + r")\b"), "external")


def urls(rows: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """(keep..., pos, url): every web address in a text, in order."""
    return rows.select(*keep, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(URL), F.lit(0))).alias("pos", "url"))


#: The columns of the list of references and links.
RECORD = ("source_doc", "source_section", "source_paragraph_index", "matched_text", "reference_type", "target_reference", "resolution_status", "target_url", "url_display_text", "url_type")


def reference_records(elements: DataFrame, patterns: Sequence[tuple[str, str]], links: DataFrame | None = None) -> DataFrame:
    """The list of references and links, ten columns, empty texts where a column does not apply.

    ``elements`` has (doc_id, seq, filename, text, level). Every match of every pattern and every web address in a text is a
    row, with the last heading of level 1 or 2 before it; ``links`` (doc_id, seq, target_url, url_display_text, url_type) adds those of packages.
    """
    from paperloom.operators.headings import parent_heading

    rows = parent_heading(elements, "source_section").where(F.trim("text") != "")
    head = [F.col("filename").alias("source_doc"), "source_section", F.col("seq").cast("bigint").alias("source_paragraph_index")]
    filled = lambda df: df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns and c != "source_paragraph_index" else F.col(c) if c in df.columns else F.lit("").alias(c) for c in RECORD])
    said = references(rows, patterns, ("filename", "source_section", "seq")).select(*head, F.trim("matched").alias("matched_text"), "reference_type", F.trim("target").alias("target_reference"))
    bare = urls(rows, ("filename", "source_section", "seq"), "text").select(*head, F.col("url").alias("target_url"), F.lit("bare_text").alias("url_type"))
    out = filled(said).unionByName(filled(bare))
    if links is not None:
        linked = links.where("url_type <> 'bare_text'").join(rows.select("doc_id", "seq", "filename", "source_section"), ["doc_id", "seq"])
        out = out.unionByName(filled(linked.select(*head, "target_url", "url_display_text", "url_type")))
    return out
