"""Control records from ordered paragraphs: identifiers, blocks, names, guidance, document metadata."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.headings import ANY_CONTROL_ID, by_document, is_section_header

# Words that part a description from its guidance, and what begins document metadata.
GUIDANCE = ("implementation guidance", "implementation:", "guidelines:", "how to implement", "supplemental guidance")
TRIGGERS = {"purpose": ("purpose", "objective", "intent"), "scope": ("scope", "coverage", "boundary"), "applicability": ("applicability", "applies to", "applies for")}
METADATA_LINES = 40
_BASELINE = r"\s*\(\s*([LMH](?:\s*,\s*[LMH])*)\s*\)"


def control_ids(text: Column) -> Column:
    """All control identifiers of a text, in order."""
    return F.regexp_extract_all(text, F.lit(ANY_CONTROL_ID), F.lit(0))


def counted_ids(text: Column, bold_text: Column, bypass: Column, anchor: int | None = None) -> Column:
    """The identifiers that count: in bold (unless bypassed, as in tables and headings) and near the beginning."""
    ids = F.filter(control_ids(text), lambda x: bypass | F.contains(bold_text, x))
    return ids if anchor is None else F.filter(ids, lambda x: F.instr(text, x) - 1 <= anchor)


def control_blocks(paragraphs: DataFrame, keys: Sequence[str], order: str, text: str = "text", style: Column | None = None, bold: Column | None = None, least_lines: int = 0) -> DataFrame:
    """(keys..., start, control_id, ids, section_header, body, lines) of every control block.

    Paragraphs are walked in order. A section header closes the block before it; a paragraph with identifiers opens
    one; any other non-empty paragraph joins the open block or is dropped. Blocks are islands: the running number
    of opening and closing paragraphs names them, so one window and one aggregation find them all.
    """
    rows = paragraphs.select(*keys, F.col(order).cast("bigint").alias("_o"), F.trim(F.coalesce(F.col(text), F.lit(""))).alias("_t"), (style if style is not None else F.lit("Normal")).alias("_s"), (bold if bold is not None else F.lit(False)).alias("_b"))
    rows = rows.where(F.length("_t") > 0).withColumn("_ids", control_ids(F.col("_t")))
    event = F.when(is_section_header(F.col("_t"), F.col("_s"), F.col("_b")), "H").when(F.size("_ids") > 0, "C")
    w = Window.partitionBy(*keys).orderBy("_o")
    rows = rows.withColumn("_e", event).withColumns({"_island": F.count("_e").over(w), "_head": F.last(F.when(F.col("_e") == "H", F.col("_t")), ignorenulls=True).over(w)})
    opened = F.max(F.when(F.col("_e") == "C", F.struct("_o", "_ids", "_head")))
    blocks = rows.where("_island > 0").groupBy(*keys, "_island").agg(opened.alias("_c"), F.array_sort(F.collect_list(F.struct("_o", "_t"))).alias("_lines"))
    blocks = blocks.where(F.col("_c").isNotNull() & (F.size("_lines") >= least_lines))
    return blocks.select(
        *keys, F.col("_c._o").alias("start"), F.col("_c._ids")[0].alias("control_id"), F.size("_c._ids").cast("bigint").alias("ids"), F.coalesce("_c._head", F.lit("")).alias("section_header"),
        F.array_join(F.transform("_lines", lambda x: x["_t"]), "\n").alias("body"), F.size("_lines").cast("bigint").alias("lines"),
    )


def split_guidance(text: Column, keywords: Sequence[str] = GUIDANCE) -> tuple[Column, Column, Column]:
    """(description, guidance, rest): the text before, between and after the first two guidance words."""
    either = "(?:" + "|".join(keywords) + ")"
    has = lambda t: t.rlike(f"(?is){either}")
    head = lambda t: F.when(has(t), F.regexp_extract(t, f"(?is)^(.*?){either}", 1)).otherwise(t)
    tail = lambda t: F.when(has(t), F.regexp_extract(t, f"(?is)^.*?{either}(.*)$", 1)).otherwise("")
    after = tail(text)
    return F.trim(head(text)), F.trim(head(after)), F.trim(tail(after))


def baseline_and_name(text: Column, control_id: Column) -> tuple[Column, Column]:
    """(baseline, name) from the paragraph that opens a control, in five layouts; empty where absent.

    A baseline is a list of L, M and H in parentheses: right after the identifier, at the end of the name, or at the
    end of a name without dash. Without any name after the identifier, the words before it are the name.
    """
    at = F.instr(text, control_id)
    rest = F.substr(text, at + F.length(control_id))
    first = F.regexp_extract(rest, "^" + _BASELINE, 1)
    rest = F.regexp_replace(rest, "^" + _BASELINE, "")
    dashed = rest.rlike(r"^\s*[-–—]\s*.+")
    name = F.trim(F.regexp_extract(rest, r"^\s*[-–—]\s*(.+)", 1))
    late = F.regexp_extract(name, _BASELINE, 1)
    cut_name = F.when((first == "") & (late != ""), F.trim(F.regexp_replace(name, _BASELINE + ".*$", ""))).otherwise(name)
    bare = F.trim(rest)
    bare_base = F.regexp_extract(bare, _BASELINE, 1)
    bare_name = F.when(bare_base != "", F.trim(F.regexp_replace(bare, _BASELINE + ".*$", ""))).when((bare != "") & ~bare.rlike(r"^[(.]"), bare).otherwise("")
    lead = F.regexp_replace(F.trim(F.regexp_replace(F.substr(text, F.lit(1), at - 1), r"[\s\-–—]+$", "")), r"(?i)\bcontrol\s*(id)?\s*$", "")
    after = F.when(dashed, cut_name).otherwise(bare_name)
    base = F.when(first != "", first).when(dashed, late).when(bare_name != "", bare_base).otherwise("")
    known = at > 0
    return F.when(known, F.replace(base, F.lit(" "), F.lit(""))).otherwise(""), F.when(known, F.when(after != "", after).otherwise(F.trim(lead))).otherwise("")


def document_metadata(elements: DataFrame, first_lines: int = METADATA_LINES) -> DataFrame:
    """(doc_id, purpose, scope, applicability): the text from a line with a trigger word to the next such line or
    heading, within the first lines; a line with triggers of several fields feeds them all; the first text wins."""
    rows = elements.where((F.col("seq") < first_lines) & (F.length(F.trim("text")) > 0))
    fires = {k: F.lower("text").rlike(rf"\b({'|'.join(p)})\b") for k, p in TRIGGERS.items()}
    any_fires = F.when(fires["purpose"] | fires["scope"] | fires["applicability"] | F.col("level").isNotNull(), 1)
    rows = rows.withColumn("_i", F.count(any_fires).over(by_document()))
    label = rf"(?i)^\s*[\d.]*\s*({'|'.join(w for p in TRIGGERS.values() for w in p)})\s*[:\-]?\s*"
    body = F.when(any_fires.isNotNull(), F.trim(F.regexp_replace("text", label, ""))).otherwise(F.trim("text"))
    rows = rows.where("_i > 0").groupBy("doc_id", "_i").agg(
        *[F.bool_or(F.coalesce(any_fires.isNotNull() & c, F.lit(False))).alias(f"_{k}") for k, c in fires.items()], F.array_sort(F.collect_list(F.struct("seq", body.alias("t")))).alias("_l")
    )
    text = F.array_join(F.filter(F.transform("_l", lambda x: x["t"]), lambda t: t != ""), " ")
    return rows.withColumn("_text", text).where("_text <> ''").groupBy("doc_id").agg(*[F.coalesce(F.min_by(F.when(F.col(f"_{k}"), F.col("_text")), F.when(F.col(f"_{k}"), F.col("_i"))), F.lit("")).alias(k) for k in fires])


def compliance_dates(elements: DataFrame, within: int = 10) -> DataFrame:
    """(doc_id, compliance_date): ``as of Month D, YYYY`` within ten lines of a compliance heading, else anywhere first."""
    found = F.try_to_timestamp(F.regexp_extract("text", r"(?i)\bas of\s+([A-Z][a-z]+ \d{1,2}, \d{4})", 1), F.lit("MMMM d, yyyy")).cast("date")
    w = by_document().rowsBetween(-within, 0)
    near = F.max(F.when(F.lower("text").contains("compliance date"), 1)).over(w).isNotNull()
    rows = elements.withColumns({"_d": F.when(F.col("text").rlike(r"(?i)\bas of\s+[A-Z][a-z]+ \d{1,2}, \d{4}"), found), "_n": near}).where("_d is not null")
    return rows.groupBy("doc_id").agg(F.min_by("_d", F.struct(~F.col("_n"), "seq")).alias("compliance_date"))


def table_controls(cells: DataFrame) -> DataFrame:
    """(doc_id, table_idx, row_idx, control_id, title, description) of table rows with a control identifier.

    The header row says which column holds which; cells of a row are brought together by column.
    """
    head = cells.where("row_idx = 0").select("doc_id", "table_idx", "col_idx", F.lower("text").alias("h"))
    role = F.when(F.col("h").rlike(r"control (id|#)|^id$"), "id").when(F.col("h").rlike("title|name"), "title").when(F.col("h").rlike("description|requirement|statement"), "description")
    rows = cells.where("row_idx > 0").join(head.select("doc_id", "table_idx", "col_idx", role.alias("role")).where("role is not null"), ["doc_id", "table_idx", "col_idx"])
    pick = lambda k: F.min_by(F.when(F.col("role") == k, F.trim("text")), F.when(F.col("role") == k, F.col("col_idx")))
    out = rows.groupBy("doc_id", "table_idx", "row_idx").agg(F.try_element_at(control_ids(pick("id")), F.lit(1)).alias("control_id"), pick("title").alias("title"), pick("description").alias("description"))
    return out.where("control_id is not null")


def merge_sources(structured: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("doc_id", "control_id")) -> DataFrame:
    """Structured rows, then the blocks whose identifier no structured row of the document has."""
    return structured.unionByName(blocks.join(structured.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def bold_or_all(bold_blocks: DataFrame, all_blocks: DataFrame) -> DataFrame:
    """Blocks found by bold identifiers; for documents without any, the blocks found without that rule."""
    return bold_blocks.unionByName(all_blocks.join(bold_blocks.select("doc_id").distinct(), "doc_id", "left_anti"))


def id_matches(rows: DataFrame, key: str, text: str, around: int = 50) -> DataFrame:
    """(key, position, control_id, context, ends_sentence): every identifier with its place and surroundings."""
    pattern = re.compile(ANY_CONTROL_ID, re.ASCII)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (k, m.start(), m[0], t[max(0, m.start() - around) : m.end() + around], "." in t[m.end() : m.end() + around])
                for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for m in pattern.finditer(t or "")
            ]
            kinds = [batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.bool_()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[key, "position", "control_id", "context", "ends_sentence"])

    kind = dict(rows.dtypes)[key]
    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, position bigint, control_id string, context string, ends_sentence boolean")


def unfinished(files: DataFrame, done: DataFrame, key: str = "filename") -> DataFrame:
    """The files that a run that broke off has not finished."""
    return files.join(done.select(key).distinct(), key, "left_anti")


def strip_prefix(text: Column, control_id: Column) -> Column:
    """The body of the paragraph that opens a control: without what stands before the identifier, the identifier, its
    baseline, and a name after a dash or one that a baseline ends. A text without the identifier stays as it is."""
    at = F.instr(text, control_id)
    rest = F.regexp_replace(F.substr(text, at + F.length(control_id)), "^" + _BASELINE, "")
    dashed = r"^\s*[-–—]\s*[^\n]+"
    late = F.regexp_extract(rest, r"(?s)^.*?" + _BASELINE + r"(.*)$", 2)
    body = F.when(rest.rlike(dashed), F.regexp_replace(rest, dashed, "")).when(rest.rlike(_BASELINE), late).otherwise(rest)
    return F.when(at == 0, text).otherwise(F.trim(body))
