"""Word packages and workbooks as tables, read on executors with the standard library only."""

from __future__ import annotations

import hashlib
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_W14, _W15 = "{http://schemas.microsoft.com/office/word/2010/wordml}", "{http://schemas.microsoft.com/office/word/2012/wordml}"
_INSERTED, _DELETED = {f"{_W}ins", f"{_W}moveTo"}, {f"{_W}del", f"{_W}moveFrom"}

ELEMENTS = (
    "doc string, seq int, kind string, style string, text string, bold_all boolean, bold_any boolean, bold_text string, max_size double, "
    "runs array<struct<text:string,bold:boolean,italic:boolean,strike:boolean,href:string>>, list_level int, table_idx int, error string"
)
CELLS = "doc string, table_idx int, row_idx int, col_idx int, tc_id string, text string"
PARTS = "doc string, location string, idx int, accepted string, rejected string, tracked boolean"
REVISIONS = "doc string, location string, rev_type string, author string, date string, text string"
COMMENTS = "doc string, comment_id string, parent_id string, author string, initials string, date string, anchor_text string, text string, resolved boolean"
PROPERTIES = "doc string, category string, field string, value string"
FLAGS = "doc string, nested_tables int, has_text_boxes boolean, has_tracked_changes boolean, has_comments boolean, has_images boolean, has_embedded_objects boolean, has_password_protection boolean, error string"
LINKS = "doc string, seq int, target_url string, url_display_text string, url_type string"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.docx", recursive: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """(path, doc, modificationTime, length, content) of the files of a folder; names that hold an excluded text
    (whatever its case) are left out, as are the lock files of open documents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    files = files.withColumn("doc", F.element_at(F.split("path", "/"), -1)).where(~F.startswith("doc", F.lit("~$")))
    for text in exclude:
        files = files.where(~F.contains(F.lower("doc"), F.lit(text.lower())))
    return files


def _on(node: ET.Element | None, tag: str) -> bool | None:
    found = None if node is None else node.find(f"{_W}{tag}")
    return None if found is None else found.get(f"{_W}val", "1") not in ("0", "false", "none")


class Package:
    """One Word package: its styles, links and parts."""

    def __init__(self, content: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())
        self.styles = self._styles()
        self.links = self._links("word/_rels/document.xml.rels")

    def xml(self, name: str) -> ET.Element | None:
        return ET.fromstring(self.zip.read(name)) if name in self.names else None

    def _styles(self) -> dict[str, tuple[str, bool, float | None]]:
        root, out = self.xml("word/styles.xml"), {}
        for s in root.iter(f"{_W}style") if root is not None else ():
            name, run = s.find(f"{_W}name"), s.find(f"{_W}rPr")
            size = None if run is None else run.find(f"{_W}sz")
            shown = name.get(f"{_W}val", "") if name is not None else ""
            shown = re.sub(r"^heading (\d)$", r"Heading \1", shown)
            out[s.get(f"{_W}styleId", "")] = (shown, bool(_on(run, "b")), float(size.get(f"{_W}val")) / 2 if size is not None else None)
        return out

    def _links(self, name: str) -> dict[str, str]:
        root = self.xml(name)
        return {r.get("Id", ""): r.get("Target", "") for r in root} if root is not None else {}

    def runs(self, p: ET.Element, style_bold: bool, rejected: bool = False) -> list[dict]:
        """Runs of a paragraph in the accepted (or rejected) view."""
        out: list[dict] = []

        def walk(node: ET.Element, href: str | None) -> None:
            for child in node:
                if child.tag in (_INSERTED if rejected else _DELETED) or child.tag in (f"{_W}txbxContent", "{http://schemas.openxmlformats.org/markup-compatibility/2006}Fallback"):
                    continue
                if child.tag == f"{_W}r":
                    text = "".join({f"{_W}t": n.text or "", f"{_W}delText": (n.text or "") if rejected else "", f"{_W}tab": "\t", f"{_W}br": "\n"}.get(n.tag, "") for n in child)
                    pr = child.find(f"{_W}rPr")
                    bold, size = _on(pr, "b"), None if pr is None else pr.find(f"{_W}sz")
                    if text:
                        out.append({"text": text, "bold": style_bold if bold is None else bold, "italic": bool(_on(pr, "i")), "strike": bool(_on(pr, "strike")), "href": href, "size": float(size.get(f"{_W}val")) / 2 if size is not None else None})
                elif child.tag == f"{_W}hyperlink":
                    walk(child, self.links.get(child.get(f"{_R}id", ""), "#" + child.get(f"{_W}anchor", "") if child.get(f"{_W}anchor") else None))
                elif child.tag != f"{_W}pPr":
                    walk(child, href)

        walk(p, None)
        return out

    def boxes(self, p: ET.Element, rejected: bool = False) -> list[str]:
        """The texts of the paragraphs in a paragraph's text boxes; the copy for older programs is left out."""
        found: list[ET.Element] = []

        def walk(node: ET.Element) -> None:
            for child in node:
                if child.tag == f"{_W}txbxContent":
                    found.extend(child.iter(f"{_W}p"))
                elif not child.tag.endswith("}Fallback"):
                    walk(child)

        walk(p)
        return [self.text(x, rejected) for x in found]

    def style(self, p: ET.Element) -> tuple[str, bool, float | None]:
        found = p.find(f"{_W}pPr/{_W}pStyle")
        return self.styles.get(found.get(f"{_W}val", "") if found is not None else "Normal", ("Normal", False, None))

    def text(self, p: ET.Element, rejected: bool = False) -> str:
        return "".join(r["text"] for r in self.runs(p, False, rejected))

    def parts(self) -> Iterator[tuple[str, ET.Element]]:
        """The body, then headers, footers, footnotes and endnotes by name."""
        for name in ["word/document.xml", *sorted(n for n in self.names if re.fullmatch(r"word/(header\d*|footer\d*|footnotes|endnotes)\.xml", n))]:
            root = self.xml(name)
            if root is not None:
                yield ("body" if name.endswith("document.xml") else name[5:-4]), root


def elements_of(doc: str, package: Package) -> list[dict]:
    """The body's paragraphs and tables in order."""
    root = package.xml("word/document.xml")
    out: list[dict] = []
    tables = 0
    for node in root.find(f"{_W}body") if root is not None else ():
        row: dict = {"doc": doc, "seq": len(out), "kind": None, "error": None}
        if node.tag == f"{_W}p":
            style, bold, size = package.style(node)
            runs = package.runs(node, bold)
            shown = [r for r in runs if r["text"].strip()]
            level = node.find(f"{_W}pPr/{_W}numPr/{_W}ilvl")
            sizes = [r["size"] or size for r in shown if r["size"] or size]
            row |= {
                "kind": "paragraph", "style": style, "text": "".join(r["text"] for r in runs), "bold_all": bool(shown) and all(r["bold"] for r in shown), "bold_any": any(r["bold"] for r in shown),
                "bold_text": "".join(r["text"] for r in runs if r["bold"]), "max_size": max(sizes, default=None), "runs": [{k: r[k] for k in ("text", "bold", "italic", "strike", "href")} for r in runs],
                "list_level": int(level.get(f"{_W}val")) if level is not None else None,
            }
        elif node.tag == f"{_W}tbl":
            row |= {"kind": "table", "table_idx": tables}
            tables += 1
        if row["kind"]:
            out.append(row)
        for text in package.boxes(node) if node.tag == f"{_W}p" else ():
            if text.strip():
                out.append({"doc": doc, "seq": len(out), "kind": "textbox", "style": "Normal", "text": text, "bold_all": False, "bold_any": False, "bold_text": "", "error": None})
    return out


def cells_of(doc: str, package: Package) -> list[dict]:
    """Cells of the body's tables by grid place; a merged cell is repeated in each of its places."""
    root, out = package.xml("word/document.xml"), []
    for t, table in enumerate(root.find(f"{_W}body").findall(f"{_W}tbl") if root is not None else ()):
        above: dict[int, tuple[str, str]] = {}
        for r, line in enumerate(table.findall(f"{_W}tr")):
            col = 0
            for k, cell in enumerate(line.findall(f"{_W}tc")):
                pr = cell.find(f"{_W}tcPr")
                span = pr.find(f"{_W}gridSpan") if pr is not None else None
                merge = pr.find(f"{_W}vMerge") if pr is not None else None
                ident, text = f"{r}.{k}", "\n".join(package.text(p) for p in cell.findall(f"{_W}p"))
                if merge is not None and merge.get(f"{_W}val", "continue") == "continue" and col in above:
                    ident, text = above[col]
                for _ in range(int(span.get(f"{_W}val")) if span is not None else 1):
                    out.append({"doc": doc, "table_idx": t, "row_idx": r, "col_idx": col, "tc_id": ident, "text": text})
                    above[col] = (ident, text)
                    col += 1
    return out


def parts_of(doc: str, package: Package) -> list[dict]:
    """Paragraphs of all parts in the accepted and the rejected view."""
    marks = _INSERTED | _DELETED
    return [
        {"doc": doc, "location": where, "idx": k, "accepted": package.text(p), "rejected": package.text(p, True), "tracked": any(n.tag in marks for n in p.iter())}
        for where, root in package.parts() for k, p in enumerate(root.iter(f"{_W}p"))
    ]


def revisions_of(doc: str, package: Package) -> list[dict]:
    """Insertions, deletions and moves of all parts."""
    return [
        {"doc": doc, "location": where, "rev_type": n.tag[len(_W):], "author": n.get(f"{_W}author"), "date": n.get(f"{_W}date"), "text": "".join(x.text or "" for x in n.iter() if x.tag in (f"{_W}t", f"{_W}delText"))}
        for where, root in package.parts() for n in root.iter() if n.tag in _INSERTED | _DELETED
    ]


def comments_of(doc: str, package: Package) -> list[dict]:
    """Comments with their parent, state and the text that they are anchored to; an open anchor runs to the end."""
    root, extended = package.xml("word/comments.xml"), package.xml("word/commentsExtended.xml")
    if root is None:
        return []
    anchors: dict[str, list[str]] = {}
    live: list[str] = []
    body = package.xml("word/document.xml")
    for n in body.iter() if body is not None else ():
        if n.tag == f"{_W}commentRangeStart":
            live.append(n.get(f"{_W}id", ""))
        elif n.tag == f"{_W}commentRangeEnd" and n.get(f"{_W}id", "") in live:
            live.remove(n.get(f"{_W}id", ""))
        elif n.tag == f"{_W}t":
            for c in live:
                anchors.setdefault(c, []).append(n.text or "")
    notes = list(root.iter(f"{_W}comment"))
    para = {p.get(f"{_W14}paraId"): c.get(f"{_W}id") for c in notes for p in c.iter(f"{_W}p") if p.get(f"{_W14}paraId")}
    state = {e.get(f"{_W15}paraId"): (e.get(f"{_W15}paraIdParent"), e.get(f"{_W15}done") == "1") for e in extended} if extended is not None else {}
    by_comment = {para[k]: v for k, v in state.items() if k in para}
    out = []
    for c in notes:
        ident = c.get(f"{_W}id", "")
        parent, done = by_comment.get(ident, (None, False))
        out.append({"doc": doc, "comment_id": ident, "parent_id": para.get(parent), "author": c.get(f"{_W}author"), "initials": c.get(f"{_W}initials"), "date": c.get(f"{_W}date"),
                    "anchor_text": "".join(anchors.get(ident, [])), "text": "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in c.iter(f"{_W}p")), "resolved": done})
    return out


def properties_of(doc: str, package: Package) -> list[dict]:
    """Core, application and custom properties, hashes of the body, and revision save ids, as rows."""
    rows: list[tuple[str, str, str | None]] = []
    for category, name in (("core", "docProps/core.xml"), ("app", "docProps/app.xml"), ("custom", "docProps/custom.xml")):
        root = package.xml(name)
        for n in root if root is not None else ():
            rows.append((category, n.get("name") or n.tag.rpartition("}")[2], "".join(n.itertext())))
    for name in sorted(n for n in package.names if n.startswith("word/") and n.endswith(".xml")):
        raw = package.zip.read(name)
        rows.append(("hash", name, hashlib.sha256(ET.canonicalize(raw.decode("utf-8")).encode()).hexdigest()))
    settings = package.xml("word/settings.xml")
    rows += [("rsid", "rsid", n.get(f"{_W}val")) for n in settings.iter(f"{_W}rsid")] if settings is not None else []
    return [{"doc": doc, "category": a, "field": b, "value": c} for a, b, c in rows]


def flags_of(doc: str, package: Package) -> list[dict]:
    """One row: tables in tables, and what a conversion loses or doubles."""
    root, settings = package.xml("word/document.xml"), package.xml("word/settings.xml")

    def depth(node: ET.Element, inside: bool) -> int:
        table = node.tag == f"{_W}tbl"
        return int(table and inside) + sum(depth(c, inside or table) for c in node)

    tags = {n.tag for _, part in package.parts() for n in part.iter()}
    return [{
        "doc": doc, "nested_tables": depth(root, False) if root is not None else 0, "has_text_boxes": f"{_W}txbxContent" in tags, "has_tracked_changes": bool(tags & (_INSERTED | _DELETED)), "has_comments": f"{_W}commentReference" in tags or "word/comments.xml" in package.names,
        "has_images": any(n.startswith("word/media/") for n in package.names), "has_embedded_objects": f"{_W}object" in tags or any(n.startswith("word/embeddings/") for n in package.names), "has_password_protection": settings is not None and settings.find(f"{_W}documentProtection") is not None, "error": None,
    }]


def links_of(doc: str, package: Package) -> list[dict]:
    """Links of the body's paragraphs: addresses outside, anchors inside, and addresses that stand in the text."""
    out = []
    for e in elements_of(doc, package):
        for href, run in groupby(e.get("runs") or (), lambda r: r["href"]):
            if href:
                inside = href.startswith("#")
                out.append({"doc": doc, "seq": e["seq"], "target_url": href[1:] if inside else href, "url_display_text": "".join(r["text"] for r in run).strip(), "url_type": "internal" if inside else "external"})
        out += [{"doc": doc, "seq": e["seq"], "target_url": u, "url_display_text": "", "url_type": "bare_text"} for u in re.findall(r"https?://[^\s<>\"]+|www\.[^\s<>\"]+", e.get("text") or "")]
    return out


_READERS = {"flags": (flags_of, FLAGS), "links": (links_of, LINKS), "elements": (elements_of, ELEMENTS), "cells": (cells_of, CELLS), "parts": (parts_of, PARTS), "revisions": (revisions_of, REVISIONS), "comments": (comments_of, COMMENTS), "properties": (properties_of, PROPERTIES)}


def read_word(files: DataFrame, view: str) -> DataFrame:
    """One view of all packages: elements, cells, parts, revisions, comments, properties, flags or links.

    A package that cannot be read gives one row with its error in the views of elements and flags, and nothing in the
    others; ``unreadable`` names all such packages.
    """
    function, schema = _READERS[view]
    names = [c.split(" ")[0] for c in re.split(r", (?![^<]*>)", schema)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[dict] = []
            for doc, content in zip(frame["doc"], frame["content"], strict=True):
                try:
                    rows += function(doc, Package(bytes(content)))
                except (zipfile.BadZipFile, ET.ParseError, KeyError, AttributeError, ValueError) as e:
                    if "error" in names:
                        rows.append({"doc": doc, "seq": 0, "kind": "error", "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names).astype(object)

    return files.select("doc", "content").mapInPandas(run, schema)


def element_inventory(files: DataFrame) -> DataFrame:
    """(doc, paragraphs, headings, tables, lists, textboxes, <kind>_links, images, tracked_changes, comments): what a conversion
    of every package meets; unreadable ones are left out."""
    kind = lambda k: F.count_if(F.col("kind") == k)
    rows = read_word(files, "elements").where("error is null").groupBy("doc").agg(
        kind("paragraph").alias("paragraphs"), F.count_if(F.col("style").rlike(r"^Heading \d$")).alias("headings"), kind("table").alias("tables"), F.count("list_level").alias("lists"), kind("textbox").alias("textboxes")
    )
    links = read_word(files, "links").groupBy("doc").agg(*[F.count_if(F.col("url_type") == t).alias(n) for t, n in (("external", "external_links"), ("internal", "internal_links"), ("bare_text", "bare_links"))])
    flags = read_word(files, "flags").select("doc", F.col("has_images").alias("images"), F.col("has_tracked_changes").alias("tracked_changes"), F.col("has_comments").alias("comments"))
    return rows.join(links, "doc", "left").fillna(0).join(flags, "doc")


def unreadable(files: DataFrame) -> DataFrame:
    """(filename, error) of the packages that cannot be read."""
    return read_word(files, "flags").where("error is not null").select(F.col("doc").alias("filename"), "error")


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def workbook_rows(content: bytes) -> list[tuple[str, int, list[str | None]]]:
    """(sheet, row number from 1, values) of every row of a workbook, as texts."""
    z = zipfile.ZipFile(io.BytesIO(content))
    names = set(z.namelist())
    shared = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    links = {r.get("Id"): r.get("Target", "").lstrip("/") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for sheet in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"):
        target = links[sheet.get(f"{_R}id")]
        for row in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_S}row"):
            values: list[str | None] = []
            for c in row.findall(f"{_S}c"):
                at = _column(c.get("r", "A"))
                values += [None] * (at - len(values))
                v, inline = c.find(f"{_S}v"), c.find(f"{_S}is")
                text = "".join(t.text or "" for t in inline.iter(f"{_S}t")) if inline is not None else v.text if v is not None else None
                values.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
            out.append((sheet.get("name"), int(row.get("r", len(out) + 1)), values))
    return out


def read_sheet(spark: SparkSession, path: str, sheet: str, header_row: int = 1, skip: Sequence[int] = ()) -> DataFrame:
    """A lookup sheet as a table of texts with an ``ord`` column; headers are trimmed, missing ones are ``Col<n>``.

    Lookup sheets are read on the driver: they are made by hand, and their order is part of their meaning.
    """
    content = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    rows = [(n, v) for s, n, v in workbook_rows(content) if s == sheet and n >= header_row and n not in skip]
    if not rows:
        return spark.createDataFrame([], "ord int")
    width = max(len(v) for _, v in rows)
    head = [*rows[0][1], *[None] * (width - len(rows[0][1]))]
    names = [(h or "").strip() or f"Col{k + 1}" for k, h in enumerate(head)]
    data = [(k, *v, *[None] * (width - len(v))) for k, (_, v) in enumerate(rows[1:]) if any(x not in (None, "") for x in v)]
    return spark.createDataFrame(data, "ord int, " + ", ".join(f"`{n}` string" for n in names))
