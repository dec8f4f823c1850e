"""Tables to files: CSV, JSON lines, Markdown, workbooks, issue logs."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.sources.office import workbook_rows

#: Rows of a sheet; a workbook is for reading by people, a larger table belongs into CSV or Parquet.
SHEET_ROWS = 1_048_575


def write_csv(df: DataFrame, path: str, append: bool = False, quote_all: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON object a line, letters of all scripts as they are; with ``by``, a folder for each value."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def envelope_lines(profiles: DataFrame, key: str, version: str) -> DataFrame:
    """(ord, key, value): the lines of one JSON text with version, count and list, one profile a line; sorted by ord and key
    and written in order, they are the envelope, and no task holds the list."""
    total = profiles.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    opening = total.select(F.lit(0).alias("ord"), F.lit(None).cast(dict(profiles.dtypes)[key]).alias("key"), F.concat(F.lit('{"profiler_version": '), F.lit(json.dumps(version)), F.lit(', "document_count": '), F.col("n").cast("string"), F.lit(', "profiles": [')).alias("value"))
    body = profiles.select(F.col(key).alias("key"), F.to_json(F.struct(*profiles.columns), {"ignoreNullFields": "false"}).alias("_j")).join(F.broadcast(total.select(F.col("first").alias("key"), F.lit(True).alias("_first"))), "key", "left")
    lines = body.select(F.lit(1).alias("ord"), "key", F.concat(F.when(F.col("_first"), "").otherwise(","), "_j").alias("value"))
    return opening.unionByName(lines).unionByName(total.select(F.lit(2).alias("ord"), F.lit(None).cast(dict(profiles.dtypes)[key]).alias("key"), F.lit("]}").alias("value")))


def write_envelope(profiles: DataFrame, key: str, version: str, folder: str) -> None:
    """The envelope as text parts that, one after the other by name, are one JSON text. ``key`` must be unique."""
    envelope_lines(profiles, key, version).repartitionByRange("ord", "key").sortWithinPartitions("ord", "key").select("value").write.mode("overwrite").text(folder)


def write_texts(files: DataFrame, folder: str) -> None:
    """(file, content) as one text file each, written where the rows are, through the cluster's file system."""
    files.select("file", F.col("content").alias("value")).repartition("file").write.mode("overwrite").partitionBy("file").option("lineSep", "\n").text(folder)


def with_mark(text: Column) -> Column:
    """A text led by the byte-order mark that some spreadsheet programs want."""
    return F.concat(F.lit(chr(0xFEFF)), text)


def issue_log(rows: DataFrame, step: str, file: str, kind: str, message: Column, at: Column) -> DataFrame:
    """(timestamp, step, filename, issue_type, message) of the rows with an error; the time is a parameter."""
    return rows.where(message.isNotNull()).select(at.alias("timestamp"), F.lit(step).alias("step"), F.col(file).alias("filename"), F.lit(kind).alias("issue_type"), message.alias("message"))


def _sheet(rows: Sequence[Sequence[object]]) -> str:
    def cell(v: object) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, bool) or not isinstance(v, int | float):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape("".join(c for c in str(v) if c >= " " or c in chr(9) + chr(10)))}</t></is></c>'
        return f"<c><v>{v}</v></c>"

    lines = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{lines}</sheetData></worksheet>'


def workbook(sheets: Mapping[str, Sequence[Sequence[object]]]) -> bytes:
    """A minimal workbook of named sheets."""
    names = [n.translate({ord(c): None for c in "[]:*?/\\"})[:31] for n in sheets]
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{"".join(f"<sheet name={quoteattr(n)} sheetId={quoteattr(str(k))} r:id={quoteattr(f"rId{k}")}/>" for k, n in enumerate(names, 1))}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}/relationships">{"".join(f"<Relationship Id={quoteattr(f"rId{k}")} Type={quoteattr(rel + "/worksheet")} Target={quoteattr(f"worksheets/sheet{k}.xml")}/>" for k in range(1, len(names) + 1))}</Relationships>')
        for k, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{k}.xml", _sheet(rows))
    return buffer.getvalue()


def write_workbook(frames: Mapping[str, DataFrame], path: str) -> None:
    """Frames as the sheets of one workbook, in their order, empty ones left out; a frame beyond a sheet's rows is refused."""
    if not frames:
        raise ValueError("a workbook needs a sheet")
    sheets: dict[str, list[list[object]]] = {}
    for name, df in frames.items():
        rows = df.limit(SHEET_ROWS + 1).collect()
        if len(rows) > SHEET_ROWS:
            raise ValueError(f"{name} has more rows than a sheet; write it as CSV")
        if rows:
            sheets[name] = [list(df.columns), *[list(r) for r in rows]]
    _save(next(iter(frames.values())).sparkSession, path, workbook(sheets))


def _save(spark: SparkSession, path: str, content: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(content))
    out.close()


def append_to_workbook(rows: DataFrame, path: str, sheet: str, content: bytes | None) -> None:
    """Rows after those that a sheet of a workbook has; ``content`` is the book as it is, None for a new one. Columns go by
    the sheet's header; a book is never read back half written, since it is replaced as a whole."""
    sheets: dict[str, list[list[object]]] = {}
    for name, _, values in workbook_rows(content) if content else ():
        sheets.setdefault(name, []).append(list(values))
    head = [str(h) for h in sheets[sheet][0]] if sheet in sheets else list(rows.columns)
    found = rows.limit(SHEET_ROWS + 1).collect()
    if len(found) + len(sheets.get(sheet, ())) > SHEET_ROWS:
        raise ValueError(f"{sheet} would have more rows than a sheet; write CSV")
    sheets.setdefault(sheet, [list(head)]).extend([r.asDict().get(h) for h in head] for r in found)
    _save(rows.sparkSession, path, workbook(sheets))


def consolidated(spark: SparkSession, outputs: Mapping[str, str], order: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Sheets by name from the CSV files or folders that the steps wrote, those of ``order`` first (issues before all); files that
    are not there are left out. What comes back goes into ``write_workbook``."""
    hadoop = spark._jsc.hadoopConfiguration()
    there = {}
    for name, path in outputs.items():
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(hadoop).exists(target):
            there[name] = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return {n: there[n] for n in [*[o for o in order if o in there], *[n for n in there if n not in order]]}


def comparison_book(found: Mapping[str, DataFrame], revisions: DataFrame, comments: DataFrame, properties: DataFrame) -> dict[str, DataFrame]:
    """The seven sheets of a comparison of two document sets from ``docdiff.compare_sets`` and the views of the packages."""
    texts = found["texts"].withColumn("inline_ops", F.to_json("inline_ops"))
    return {"Summary": found["pairs"], "Text": texts, "Tracked changes": revisions, "Comments": comments, "Metadata": properties, "Signals": found["signals"], "Tally": found["tally"]}


def gap_book(merged: DataFrame, full: DataFrame, gaps: DataFrame) -> dict[str, DataFrame]:
    """The sheets of a gap analysis: sources without covering target, targets without covering source, the full mapping."""
    return {"Source unique": full.where("unique_to_source").select("source_id"), "Target unique": gaps, "Full mapping": full.drop("unique_to_source"), "Answers": merged}


def conversion_book(stats: DataFrame, issues: DataFrame) -> dict[str, DataFrame]:
    """The sheets of a conversion's log: every document, totals, and what went wrong."""
    numbers = [c for c, t in stats.dtypes if t in ("int", "bigint", "double") and c != "doc_id"]
    total = stats.agg(F.count(F.lit(1)).alias("documents"), *[F.sum(c).alias(c) for c in numbers])
    return {"Documents": stats, "Totals": total.select(*[F.col(c).cast("double").alias(c) for c in total.columns]).unpivot([], total.columns, "label", "value"), "Issues": issues}
