"""Cut long texts into pieces under a limit, at the coarsest boundaries that suffice."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP_WORDS = 1_500, 30
#: Boundaries from coarse to fine; ``none`` cuts between any two characters.
BOUNDARIES = ("heading_1", "heading_2", "heading_3", "heading_4", "paragraph", "sentence", "word", "none")
_HEADINGS = 4
#: The separators that no piece keeps, by boundary.
_SEPARATORS = {"paragraph": re.compile("\n"), "sentence": re.compile("(?<=[.!?]) "), "word": re.compile(" ")}


def _cut(text: str, start: int, end: int, boundary: str, heads: dict[int, int], limit: int) -> list[tuple[int, int]]:
    """The stretch [start, end) cut at every boundary of this kind in it; the separators belong to no stretch."""
    if boundary == "none":
        return [(at, min(at + limit, end)) for at in range(start, end, limit)]
    if boundary.startswith("heading"):
        most = int(boundary[-1])
        ends = [at - 1 for at, level in heads.items() if level <= most and start < at < end]
    else:
        ends = [m.start() for m in _SEPARATORS[boundary].finditer(text, start, end)]
    out = []
    for at in ends:
        out.append((start, at))
        start = at + 1
    return [*out, (start, end)]


def stretches(text: str, heads: dict[int, int], limit: int = LIMIT) -> tuple[list[tuple[int, int]], int]:
    """Stretches of at most ``limit`` characters, and the number of the finest boundary that was needed.

    ``heads`` gives the level of the heading whose line starts at a place, in order. Only stretches over the limit
    are cut at the next finer boundary.
    """
    deepest = 0

    def down(start: int, end: int, level: int) -> Iterator[tuple[int, int]]:
        nonlocal deepest
        if end - start <= limit:
            yield start, end
            return
        deepest = max(deepest, level)
        for a, b in _cut(text, start, end, BOUNDARIES[level], heads, limit):
            yield from down(a, b, level + 1)

    return list(down(0, len(text), 0)), deepest


def pack(parts: list[tuple[int, int]], limit: int = LIMIT) -> list[tuple[int, int]]:
    """Neighbouring stretches joined greedily while the text from first to last stays under the limit."""
    out: list[tuple[int, int]] = []
    for start, end in parts:
        if out and end - out[-1][0] <= limit:
            out[-1] = (out[-1][0], end)
        elif end > start:
            out.append((start, end))
    return out


def _heads(text: str, lines: list[dict] | None) -> dict[int, int]:
    """Places where the lines of headings start, with their level; lines that the text lacks are left out."""
    if not lines:
        return {}
    level: dict[int, int] = {}
    for x in lines:
        level[x["line"]] = min(x["level"], level.get(x["line"], 9))
    starts, at = {0: 0} if 0 in level else {}, -1
    last = max(level)
    for k in range(1, last + 1):
        at = text.find("\n", at + 1)
        if at < 0:
            break
        if k in level:
            starts[k] = at + 1
    return {starts[k]: level[k] for k in sorted(starts)}


def last_words(text: str, count: int) -> str:
    return " ".join(text.rsplit(maxsplit=count)[-count:]) if count and text.strip() else ""


def _split(limit: int, overlap: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, lines in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                parts, deepest = stretches(text, _heads(text, lines), limit)
                pieces = pack(parts, limit)
                lead = ""
                for k, (a, b) in enumerate(pieces):
                    own = text[a:b] if with_text else None
                    rows.append((doc, BOUNDARIES[deepest] if len(text) > limit else None, k, len(pieces), a, b - a, lead, own))
                    if with_text:
                        lead = last_words(f"{lead} {own}", overlap)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=_NAMES)

    return run


_NAMES = ["doc_id", "boundary", "piece_no", "pieces", "start", "own_chars", "lead", "own_text"]
_SCHEMA = "doc_id bigint, boundary string, piece_no bigint, pieces bigint, start bigint, own_chars bigint, lead string, own_text string"


def split_documents(documents: DataFrame, section_info: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP_WORDS, long_only: bool = False, with_text: bool = True) -> DataFrame:
    """Pieces (doc_id, boundary, piece_no, pieces, start, own_chars, lead, own_text) of every text, in order.

    ``boundary`` is the finest boundary that the document needed, null where it is under the limit; ``lead`` holds
    the last ``overlap`` words of the piece before (with its own lead). Headings come from ``section_info``: its
    line number decides, a null level reads as 2, repeated rows count once. Null and empty texts have no piece.
    Sizes are code points of the text; recorded counts are not used. With ``long_only``, documents under the limit
    are left out before anything is shuffled; without ``with_text``, lead and own_text stay empty.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.length("text") > (limit if long_only else 0))
    level = F.coalesce(F.col("heading_level"), F.lit(2)).cast("int")
    heads = section_info.where(F.col("start_para_index") >= 0).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.struct(F.col("start_para_index").alias("line"), level.alias("level")).alias("h"))
    heads = heads.where(F.col("h.level").between(1, _HEADINGS)).groupBy("doc_id").agg(F.collect_set("h").alias("lines"))
    return texts.join(heads, "doc_id", "left").select("doc_id", "text", "lines").mapInArrow(_split(limit, overlap, with_text), _SCHEMA)


def found_boundaries(documents: DataFrame, section_info: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, boundary) of the documents over the limit, from the first of their pieces."""
    pieces = split_documents(documents, section_info, limit, long_only=True, with_text=False)
    return pieces.where("piece_no = 0").select("doc_id", "boundary")
