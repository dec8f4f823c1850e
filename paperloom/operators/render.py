"""Metadata blocks and renderings: front matter, Markdown, pipe tables, retrieval texts."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import name_key, truncate_at_sentence
from paperloom.operators.controls import control_ids

LONG_VALUE = 120
#: Characters of a reference that are joined in one block.
BLOCK = 1 << 18


def resolve(field: Mapping[str, str], columns: Mapping[str, Column]) -> tuple[Column, Column]:
    """(value, origin) of a metadata field: ``static:text``, ``column:name`` or ``auto:name``, else its default."""
    kind, _, rest = field.get("source", "").partition(":")
    default = F.lit(field.get("default", ""))
    if kind == "static":
        return F.lit(rest), F.lit("static")
    found = columns.get(rest if rest else kind)
    if found is None:
        return default, F.lit("default")
    filled = F.nullif(F.trim(found), F.lit(""))
    return F.coalesce(filled, default), F.when(filled.isNotNull(), F.lit(kind)).otherwise("default")


def merge_tags(*lists: Column) -> Column:
    """All tags in order, the first spelling of each kept, whatever the case."""
    tags = F.filter(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])), lambda t: F.length(F.trim(t)) > 0)
    seen = F.aggregate(
        tags, F.array().cast("array<string>"),
        lambda acc, t: F.when(F.exists(acc, lambda x: F.lower(x) == F.lower(F.trim(t))), acc).otherwise(F.array_append(acc, F.trim(t))),
    )
    return seen


def front_matter(fields: Sequence[tuple[str, Column]]) -> Column:
    """A YAML block of the fields that have a value, in order."""
    lines = F.concat_ws("\n", *[F.when(F.length(v) > 0, F.concat(F.lit(f"{k}: "), v)) for k, v in fields])
    return F.concat(F.lit("---\n"), lines, F.lit("\n---\n"))


def bottom_block(fields: Sequence[tuple[str, Column]]) -> Column:
    return F.concat_ws("\n", F.lit("---"), *[F.when(F.length(v) > 0, F.concat(F.lit(f"**{k}:** "), v)) for k, v in fields])


def place_metadata(elements: DataFrame, block: DataFrame, placement: str = "top") -> DataFrame:
    """Elements with the metadata lines of ``block`` (doc_id, pos, text) before them, after them, or both."""
    count = block.groupBy("doc_id").agg((F.max("pos") + 1).alias("_n"))
    rows = elements.select("doc_id", F.col("seq").cast("bigint").alias("seq"), "text")
    if placement in ("top", "top_and_bottom"):
        top = block.join(count, "doc_id").select("doc_id", (F.col("pos") - F.col("_n")).cast("bigint").alias("seq"), "text")
        rows = rows.unionByName(top)
    if placement in ("bottom", "top_and_bottom"):
        last = elements.groupBy("doc_id").agg(F.max("seq").alias("_l"))
        rows = rows.unionByName(block.join(last, "doc_id").select("doc_id", (F.col("_l") + 1 + F.col("pos")).cast("bigint").alias("seq"), "text"))
    return rows


def header_line(values: Sequence[Column], most: int = 80) -> Column:
    """The values on one line, cut to ``most`` characters."""
    line = F.concat_ws(" | ", *[F.nullif(v, F.lit("")) for v in values])
    return F.when(F.length(line) > most, F.concat(F.left(line, F.lit(most - 3)), F.lit("..."))).otherwise(line)


def text_under(elements: DataFrame, pattern: str, most: int = 300, scan: int = 60, lines: int = 14) -> DataFrame:
    """(doc_id, text): what stands under the first heading that matches, up to the next heading; for documents without
    one, the next lines after the first of the leading lines that matches. Cut at the end of a sentence."""
    from paperloom.operators.headings import by_document

    hit = F.lower("text").rlike(pattern)
    w = by_document().rowsBetween(Window.unboundedPreceding, 0)
    rows = elements.select("doc_id", "seq", "text", "level", F.max(F.when(F.col("level").isNotNull(), F.col("seq"))).over(w).alias("_h"), F.min(F.when(F.col("level").isNotNull() & hit, F.col("seq"))).over(Window.partitionBy("doc_id")).alias("_at"),
                           F.min(F.when((F.col("seq") < scan) & hit, F.col("seq"))).over(Window.partitionBy("doc_id")).alias("_scan"))
    under = (F.col("_h") == F.col("_at")) & (F.col("seq") > F.col("_at"))
    near = F.col("_at").isNull() & F.col("seq").between(F.col("_scan") + 1, F.col("_scan") + lines) & F.col("level").isNull()
    own = rows.where((under | near) & (F.trim("text") != "")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", F.trim("text").alias("t")))).alias("_l"))
    return own.select("doc_id", truncate_at_sentence(F.array_join(F.transform("_l", lambda x: x["t"]), " "), most).alias("text"))


def render_runs(runs: Column) -> Column:
    """Markdown of an array of runs (text, bold, strike, href): neighbours of one format are joined, blanks at the
    ends of a format stand outside its marks, links become ``[text](href)``."""
    kind = "array<struct<text:string,bold:boolean,strike:boolean,href:string>>"
    of = lambda r: F.struct(F.coalesce(r["text"], F.lit("")).alias("text"), F.coalesce(r["bold"], F.lit(False)).alias("bold"), F.coalesce(r["strike"], F.lit(False)).alias("strike"), r["href"].alias("href"))
    joined = F.aggregate(
        F.transform(runs, of), F.array().cast(kind),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["bold"] == r["bold"]) & (F.try_element_at(acc, F.lit(-1))["strike"] == r["strike"]) & F.try_element_at(acc, F.lit(-1))["href"].eqNullSafe(r["href"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.try_element_at(acc, F.lit(-1)).withField("text", F.concat(F.try_element_at(acc, F.lit(-1))["text"], r["text"])).cast("struct<text:string,bold:boolean,strike:boolean,href:string>"))),
        ).otherwise(F.concat(acc, F.array(r.cast("struct<text:string,bold:boolean,strike:boolean,href:string>")))),
    )

    def marked(r: Column) -> Column:
        inner = F.trim(r["text"])
        lead, tail = F.regexp_extract(r["text"], r"^(\s*)", 1), F.regexp_extract(r["text"], r"(\s*)$", 1)
        linked = F.when(r["href"].isNotNull(), F.concat(F.lit("["), inner, F.lit("]("), r["href"], F.lit(")"))).otherwise(inner)
        struck = F.when(r["strike"], F.concat(F.lit("~~"), linked, F.lit("~~"))).otherwise(linked)
        bold = F.when(r["bold"], F.concat(F.lit("**"), struck, F.lit("**"))).otherwise(struck)
        return F.when(inner == "", r["text"]).otherwise(F.concat(lead, bold, tail))

    return F.array_join(F.transform(joined, marked), "")


def list_item(text: Column, level: Column, ordered: Column) -> Column:
    """A list item, two blanks for each level before its mark."""
    return F.concat(F.repeat(F.lit("  "), level), F.when(ordered, "1. ").otherwise("- "), text)


def escape_cell(text: Column, line_end: str = "<br>") -> Column:
    return F.replace(F.replace(F.trim(F.coalesce(text, F.lit(""))), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(line_end))


def pipe_tables(cells: DataFrame, keys: Sequence[str] = ("doc_id", "table_idx"), line_end: str = "<br>") -> DataFrame:
    """(keys..., markdown): a pipe table from cells (row_idx, col_idx, text, optional tc_id); a merged cell that the
    grid repeats stands once, short rows are padded."""
    rows = cells.withColumn("_c", F.col("tc_id") if "tc_id" in cells.columns else F.col("col_idx"))
    once = rows.groupBy(*keys, "row_idx", "_c").agg(F.min("col_idx").alias("col"), F.min_by("text", "col_idx").alias("text"))
    lines = once.groupBy(*keys, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col", escape_cell(F.col("text"), line_end).alias("t")))).alias("_r"))
    width = F.max(F.size("_r")).over(Window.partitionBy(*keys))
    lines = lines.withColumn("_w", width)
    padded = F.concat(F.transform("_r", lambda c: c["t"]), F.array_repeat(F.lit(""), F.col("_w") - F.size("_r")))
    line = F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.col("_w")))
    lines = lines.withColumn("_line", F.when(F.col("row_idx") == 0, F.concat(line, F.lit("\n"), rule)).otherwise(line))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "_line"))), lambda x: x["_line"]), "\n").alias("markdown"))


def html_tables(cells: DataFrame, keys: Sequence[str] = ("doc_id", "table_idx")) -> DataFrame:
    """(keys..., html, merged): a table with column spans; a cell that the grid repeats spans those columns."""
    once = cells.groupBy(*keys, "row_idx", "tc_id").agg(F.min("col_idx").alias("col"), F.count(F.lit(1)).alias("span"), F.min_by("text", "col_idx").alias("text"))
    text = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cell = F.concat(F.lit("<td"), F.when(F.col("span") > 1, F.concat(F.lit(' colspan="'), F.col("span"), F.lit('"'))).otherwise(""), F.lit(">"), text, F.lit("</td>"))
    rows = once.groupBy(*keys, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col", cell.alias("c")))).alias("_r"), F.max("span").alias("_s"))
    line = F.concat(F.lit("<tr>"), F.array_join(F.transform("_r", lambda x: x["c"]), ""), F.lit("</tr>"))
    out = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row_idx", line.alias("l")))).alias("_t"), (F.max("_s") > 1).alias("merged"))
    return out.select(*keys, F.concat(F.lit("<table>\n"), F.array_join(F.transform("_t", lambda x: x["l"]), "\n"), F.lit("\n</table>")).alias("html"), "merged")


def image_text(alt: Column, extracted: Column, path: Column) -> Column:
    """An image as a link where it is extracted, else a placeholder with its description."""
    described = F.coalesce(F.nullif(F.trim(alt), F.lit("")), F.lit("image"))
    return F.when(extracted, F.concat(F.lit("!["), described, F.lit("]("), path, F.lit(")"))).otherwise(F.concat(F.lit("[Image: "), described, F.lit("]")))


def markdown(elements: DataFrame) -> DataFrame:
    """(doc_id, content): headings with marks, other lines as they are, in order."""
    line = F.when(F.col("level").isNotNull(), F.concat(F.repeat(F.lit("#"), F.least("level", F.lit(6))), F.lit(" "), F.trim("text"))).otherwise(F.col("text"))
    rows = elements.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", line.alias("t")))).alias("_l"))
    return rows.select("doc_id", F.array_join(F.transform("_l", lambda x: x["t"]), "\n\n").alias("content"))


def retrieval_text(fields: Sequence[tuple[str, str]]) -> Column:
    """Labelled fields that have a value, one a line."""
    return F.concat_ws("\n", *[F.when(F.length(F.trim(F.col(c))) > 0, F.concat(F.lit(f"{label}: "), F.trim(F.col(c)))) for label, c in fields])


def control_markdown(identifier: Column, name: Column, fields: Sequence[tuple[str, Column]]) -> Column:
    """A control as Markdown: a heading, then its fields, long values on lines of their own."""
    head = F.concat(F.lit("## "), F.concat_ws(" - ", identifier, F.nullif(F.trim(name), F.lit(""))))
    value = lambda k, v: F.when(F.length(F.trim(v)) > LONG_VALUE, F.concat(F.lit(f"**{k}:**\n\n"), F.trim(v))).when(F.length(F.trim(v)) > 0, F.concat(F.lit(f"**{k}:** "), F.trim(v)))
    return F.concat_ws("\n\n", head, *[value(k, v) for k, v in fields])


def by_file(rows: DataFrame, file: str, order: str, text: str) -> DataFrame:
    """(file, content): the texts of each file in order."""
    out = rows.groupBy(file).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_l"))
    return out.select(file, F.array_join(F.transform("_l", lambda x: x[text]), "\n\n").alias("content"))


def dominant_family(rows: DataFrame, key: str, text: str, folders: Mapping[str, str], default: str = "general") -> DataFrame:
    """(key, family, folder, flagged): the family of most identifiers of a text (the first of equals by name), and
    its folder; texts without family or folder go to the default and are flagged."""
    ids = rows.select(key, F.explode_outer(control_ids(F.col(text))).alias("_i")).withColumn("family", F.regexp_extract("_i", "^([A-Z]+)", 1))
    counts = ids.groupBy(key, "family").agg(F.count("_i").alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct(-F.col("n"), "family")).alias("_b"))
    table = F.create_map(*[F.lit(x) for kv in folders.items() for x in kv])
    folder = F.element_at(table, F.col("_b.family"))
    return best.select(key, F.col("_b.family").alias("family"), F.coalesce(folder, F.lit(default)).alias("folder"), folder.isNull().alias("flagged"))


def unique_names(rows: DataFrame, name: str, order: str) -> DataFrame:
    """Add ``file``: the name, the second and later rows of one name with `` (2)`` and so on."""
    n = F.row_number().over(Window.partitionBy(name_key(F.col(name))).orderBy(order))
    return rows.withColumn("file", F.when(n > 1, F.concat(F.col(name), F.lit(" ("), n, F.lit(")"))).otherwise(F.col(name)))


def key_value_rows(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, ord, label, value): each row as labelled values, empty ones left out."""
    pairs = F.array(*[F.struct(F.lit(k).cast("bigint").alias("ord"), F.lit(c).alias("label"), F.trim(F.col(c).cast("string")).alias("value")) for k, c in enumerate(columns)])
    return rows.select(key, F.inline(pairs)).where("value <> ''")


def list_kind(style: Column, level: Column) -> tuple[Column, Column]:
    """(level, ordered) of a list paragraph: the level of its numbering, else the one that the style's name ends with, from
    0; null for other paragraphs. Styles that name a number are ordered."""
    by_style = F.when(F.lower(style).rlike("^list"), F.coalesce(F.nullif(F.regexp_extract(style, r"(\d+)$", 1), F.lit("")).cast("int") - 1, F.lit(0)))
    return F.coalesce(level, by_style), F.coalesce(F.lower(style).rlike("number"), F.lit(False))


def reference_text(controls: DataFrame, title: str | None = None, extras: Sequence[str] = (), mark: str = "###") -> DataFrame:
    """(content): controls (ord, domain, id, title, description, extras...) as one list, by domain in first-seen order.

    A null domain is ``Ungrouped``; without any domain column, one flat list. Rows are sorted over all tasks and joined to
    blocks there. The one value at the end holds what the reference is, a text that people and prompts read; one task only
    appends the blocks, which are packed until then, to it outside the heap.
    """
    entry = F.concat_ws(" ", F.concat(F.lit("- **"), "id", F.lit("**")), F.when(F.length("title") > 0, F.concat(F.lit("| "), "title")), F.concat(F.lit("| "), F.coalesce("description", F.lit(""))))
    line = F.concat_ws("\n", entry, *[F.when(F.length(F.col(x)) > 0, F.concat(F.lit(f"  - *{x}*: "), F.col(x))) for x in extras])
    domain = F.coalesce("domain", F.lit("Ungrouped")) if "domain" in controls.columns else F.lit("")
    lines = controls.select("ord", domain.alias("_d"), line.alias("_l"))
    firsts = lines.groupBy("_d").agg(F.min("ord").alias("_f"), F.min(F.struct("ord", "_l")).alias("_s"))
    head = F.when(F.struct("ord", "_l").eqNullSafe(F.col("_s")), F.when(F.col("_d") == "", "").otherwise(F.concat(F.lit(f"{mark} "), "_d", F.lit("\n"))))
    rows = lines.join(firsts, "_d").select("_f", "_d", "ord", "_l", head.alias("_h"))
    spark = controls.sparkSession
    order = ("_f", "_d", "ord", "_l")  # equal rows come to one partition, so a domain begins once
    placed = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("_d", "_h", "_l")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, n, last = TaskContext.get().partitionId(), [], 0, 0, None
        emit = lambda: pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([zlib.compress("".join(held).encode(), 1)], pa.binary())], names=["part", "n", "text"])
        for batch in batches:
            for own, heading, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held += ["\n\n", heading, text] if heading is not None and own != last else ["\n", text]
                last, size = own, size + len(text)
                if size > BLOCK:
                    yield emit()
                    held, size, n = [], 0, n + 1
        if held:
            yield emit()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, title_size = bytearray(), None
        for batch in batches:
            for packed in batch.column(0):
                piece = zlib.decompress(packed.as_buffer())
                whole += piece[2:] if title_size == len(whole) else piece  # the first domain needs no parting lines
                title_size = len(whole) if title_size is None else title_size
        batch = packed = piece = None  # noqa: F841  # let go before the value is sent
        ends = pa.py_buffer(array("i", [0, len(whole)]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(1, ends, pa.py_buffer(whole))], names=["content"])

    opening = spark.range(1).select(F.lit(-1).alias("part"), F.lit(0).alias("n"), F.lit(zlib.compress(f"# {title}\n\n".encode() if title else b"")).alias("text"))
    pieces = opening.unionByName(placed.mapInArrow(blocks, "part int, n int, text binary"))
    return pieces.repartition(1).sortWithinPartitions("part", "n").select("text").mapInArrow(join, "content string")


#: Ways to render the rows of a sheet.
MODES = ("row_as_heading", "table", "key_value", "list", "prose")


def render_rows(rows: DataFrame, key: str, columns: Sequence[str], mode: str) -> DataFrame:
    """(key, pos, kind, level, text): the rows of a sheet as elements, in one of five ways; empty values are left out.

    ``row_as_heading``: the first column as a heading, the others as labelled lines; ``table``: one line of a pipe table;
    ``key_value``: a labelled line for each value; ``list``: one item, values joined; ``prose``: one paragraph.
    """
    if mode not in MODES:
        raise ValueError(f"no such way to render: {mode}")
    value = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    element = lambda kind, level, text: F.struct(F.lit(kind).alias("kind"), F.lit(level).cast("int").alias("level"), text.alias("text"))
    labelled = lambda c: element("paragraph", None, F.when(value(c) != "", F.concat(F.lit(f"{c}: "), value(c))).otherwise(""))
    if mode == "row_as_heading":
        parts = [element("heading", 2, value(columns[0])), *[labelled(c) for c in columns[1:]]]
    elif mode == "key_value":
        parts = [labelled(c) for c in columns]
    elif mode == "table":
        parts = [element("table", None, F.concat(F.lit("| "), F.concat_ws(" | ", *[escape_cell(F.col(c).cast("string")) for c in columns]), F.lit(" |")))]
    else:
        joined = F.array_join(F.filter(F.array(*[value(c) for c in columns]), lambda v: v != ""), " - " if mode == "list" else " ")
        parts = [element("list" if mode == "list" else "paragraph", None, joined)]
    kept = F.filter(F.array(*parts), lambda e: e["text"] != "")
    return rows.select(key, F.posexplode(kept).alias("pos", "_e")).select(key, F.col("pos").cast("bigint").alias("pos"), "_e.kind", F.col("_e.level").cast("bigint").alias("level"), "_e.text")


# Labels of the retrieval text's fields, those on the label's own line, and those below it.
INLINE_LABELS = {"family_name": "Family", "baseline": "Baseline", "applicability": "Applicability"}
BLOCK_LABELS = {"description": "Description", "supplemental_guidance": "Supplemental Guidance", "purpose": "Purpose", "scope": "Scope"}
RETRIEVAL_ORDER = ("family_name", "baseline", "description", "supplemental_guidance", "purpose", "scope", "applicability")


def rag_content(columns: Mapping[str, Column]) -> Column:
    """One text of a record for retrieval: ``Control <id>: <name>``, then its fields in order, long ones below their label;
    blank and absent ones are left out."""
    value = lambda k: F.trim(F.coalesce(columns[k].cast("string"), F.lit("")))
    head = F.when(value("control_id") != "", F.concat_ws(": ", F.concat(F.lit("Control "), value("control_id")), F.nullif(value("control_name"), F.lit(""))))
    lines = [F.when(value(k) != "", F.concat(F.lit(f"{INLINE_LABELS[k]}: " if k in INLINE_LABELS else f"\n{BLOCK_LABELS[k]}:\n"), value(k))) for k in RETRIEVAL_ORDER if k in columns]
    return F.trim(F.concat_ws("\n", head, *lines))
