"""Text files, lookups and settings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.mapping import family_of
from paperloom.operators.order import numbered
from paperloom.sources.office import workbook_rows


def read_csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder with their name in ``source_file``; columns that a file lacks are null.

    Files with one header line are one scan, however many there are; the driver sees one line a file.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    heads: dict[str, list[str]] = {}
    for r in lines.where("block = 0").groupBy("path").agg(F.min_by("value", "n").alias("head")).collect():
        heads.setdefault(r["head"], []).append(r["path"])
    frames = [spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(sorted(paths)).withColumn("source_file", F.col("_metadata.file_name")) for _, paths in sorted(heads.items())]
    if not frames:
        return spark.createDataFrame([], "source_file string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def split_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(parts, parents) of the manifest that a split writes: its rows (original_doc, sub_doc_filename, heading_text,
    character_count, page_estimate) with numbers as numbers, and (part, parent) by lower-case names without extension."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.withColumns({"character_count": F.col("character_count").try_cast("bigint"), "page_estimate": F.col("page_estimate").try_cast("double")})
    bare = lambda c: F.lower(F.regexp_replace(c, r"\.[^.]*$", ""))
    return rows, rows.where("sub_doc_filename is not null").select(bare("sub_doc_filename").alias("part"), bare("original_doc").alias("parent")).distinct()


def with_row_index(rows: DataFrame, order: str, out: str = "row_idx") -> DataFrame:
    """Rows numbered from 0 in order, as a reader of the file would count them."""
    return numbered(rows, [F.col(order)], "_n").withColumn(out, F.col("_n") - 1).drop("_n")


def framework_controls(rows: DataFrame, ident: int, description: int, supplemental: Mapping[str, int]) -> DataFrame:
    """(ord, id, description, <label>...) from a sheet by the places of its columns (from 0, the ``ord`` column not counted);
    rows without identifier are left out, columns that the sheet lacks are empty."""
    names = [c for c in rows.columns if c != "ord"]
    at = lambda k: F.trim(F.coalesce(F.col(f"`{names[k]}`").cast("string"), F.lit(""))) if k < len(names) else F.lit("")
    return rows.select("ord", at(ident).alias("id"), at(description).alias("description"), *[at(k).alias(label) for label, k in supplemental.items()]).where("id <> ''")


def catalog_controls(rows: DataFrame, columns: Mapping[str, str], source: str, families: Mapping[str, str]) -> DataFrame:
    """A catalog's rows in one schema: columns by their names in the catalog (whatever the case), the family that the
    identifier's code names, and where they come from; rows without identifier are left out."""
    out = select_columns(rows, columns).where(F.length(F.trim("control_id")) > 0)
    return out.withColumns({"control_id": F.trim("control_id"), "family": family_of(F.trim("control_id"), dict(families)), "source": F.lit(source)})


def read_profiles(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Profiles from JSON: a bare list, or an envelope with ``profiles``; unreadable files give nothing."""
    files = spark.read.text(path, wholetext=True)
    item = schema if isinstance(schema, str) else schema.simpleString()[7:-1]
    kind = f"array<struct<{item.replace(' ', ':').replace(',:', ',')}>>" if isinstance(schema, str) else f"array<{schema.simpleString()}>"
    bare = F.from_json("value", kind)
    envelope = F.from_json("value", f"struct<profiles:{kind}>")["profiles"]
    return files.select(F.inline(F.when(F.startswith(F.ltrim("value"), F.lit("[")), bare).otherwise(envelope)))


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value): the JSON answers of a folder as texts, one row a file."""
    return spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")


def tag_lists(rows: DataFrame, name: str, tags: str) -> DataFrame:
    """(name, tags): comma-separated tags as arrays, trimmed, without empty ones."""
    return rows.select(F.col(name).alias("name"), F.filter(F.transform(F.split(tags, ","), lambda t: F.trim(t)), lambda t: t != "").alias("tags"))


def acronym_definitions(rows: DataFrame) -> DataFrame:
    """(document, acronym, definition, ord): defined rows that are no instruction and no false positive."""
    kept = rows.where(~F.startswith(F.coalesce("Document", F.lit("")), F.lit("(")) & (F.lower(F.trim(F.coalesce("Status", F.lit("")))) != "false positive"))
    return kept.select(F.col("Document").alias("document"), F.trim("Acronym").alias("acronym"), F.trim("Definition").alias("definition"), "ord").where("definition <> '' and acronym <> ''")


def select_columns(rows: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Columns by other names: an equal name whatever its case, else the first that contains it; missing ones are null."""
    low = {c.lower(): c for c in rows.columns}

    def find(name: str) -> str | None:
        return low.get(name.lower()) or next((c for k, c in low.items() if name.lower() in k), None)

    return rows.select(*[(F.col(f"`{found}`") if (found := find(source)) else F.lit(None).cast("string")).alias(out) for out, source in wanted.items()])


def coerce(value: Any) -> Any:
    """A setting's text as a truth value, whole number or number where it reads as one."""
    if not isinstance(value, str):
        return value
    text = value.strip()
    if text.lower() in ("true", "yes", "false", "no"):
        return text.lower() in ("true", "yes")
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def nested(flat: Mapping[str, Any]) -> dict[str, Any]:
    """Settings with dotted names as nested ones."""
    out: dict[str, Any] = {}
    for name, value in flat.items():
        at = out
        *path, last = name.split(".")
        for p in path:
            at = at.setdefault(p, {})
        at[last] = coerce(value)
    return out


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """Settings with others laid over them, nested ones key by key."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def load_settings(spark: SparkSession, names: Sequence[str], defaults: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Settings from the first of these files that is there, a workbook or YAML, over the defaults; places are tried in
    order, such as one in the working folder and one above it. No file at all gives the defaults."""
    for name in names:
        path = Path(name)
        if not path.is_file():
            continue
        if path.suffix.lower() == ".xlsx":
            return merged(defaults or {}, settings_of_sheets(path.read_bytes()))
        try:
            import yaml
        except ImportError as e:  # settings in files are optional
            raise RuntimeError("reading settings from YAML needs PyYAML") from e
        return merged(defaults or {}, yaml.safe_load(path.read_text(encoding="utf-8")) or {})
    return dict(defaults or {})


def settings_of_sheets(content: bytes) -> dict[str, Any]:
    """Settings from a workbook. A sheet with the columns Setting and Value holds dotted names; one whose first column alone
    has a header is a list; any other is a table, one mapping a row by the headers; its name, in lower case with
    underscores, is the key. Cells read as truth values and numbers where they do; rows that begin with ``#`` are remarks."""
    sheets: dict[str, list[list[str | None]]] = {}
    for sheet, _, values in workbook_rows(content):
        sheets.setdefault(sheet, []).append(values)
    out: dict[str, Any] = {}
    for sheet, (head, *body) in sheets.items():
        names = [(h or "").strip() for h in head]
        rows = [[*r, *[None] * (len(names) - len(r))] for r in body if any(x not in (None, "") for x in r) and not str(r[0] or "").startswith("#")]
        low = [n.lower() for n in names]
        if low[:2] == ["setting", "value"]:
            out = merged(out, nested({r[0].strip(): r[1] for r in rows if r[0]}))
            continue
        key = re.sub(r"[^a-z0-9]+", "_", sheet.lower()).strip("_")
        out[key] = [coerce(r[0]) for r in rows] if len([n for n in names if n]) == 1 else [{n: coerce(v) for n, v in zip(names, r, strict=False) if n} for r in rows]
    return out


def steps(text: str, last: int = 9) -> list[int]:
    """Steps named as ``0``, ``1-3``, ``2,4`` or ``0,2-4``, in order, each once."""
    out: set[int] = set()
    for piece in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = piece.partition("-")
        out |= set(range(int(a), int(b or a) + 1))
    if any(n > last for n in out):
        raise ValueError(f"there is no step above {last}: {text}")
    return sorted(out)
