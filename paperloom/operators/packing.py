"""Cutting and packing of ordered elements: sub-documents, chunks with overlap, batches.

Whatever needs a fold over ordered parts gets the parts of one document (or family) as one array, built by an
ordered aggregation; the fold itself is a plain function that runs over Arrow batches. A group is bounded by the
parts of one document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import safe_filename
from paperloom.operators.headings import by_document
from paperloom.operators.order import numbered, running

SPLIT_CHARS, PAGE_CHARS, CHUNK_CHARS, OVERLAP_WORDS, CHUNK_LEAST = 36_000, 1_800, 1_500, 30, 100


def fold(rows: DataFrame, key: str, parts: str, function: Callable[[list[dict]], list[tuple]], kinds: Sequence[tuple[str, pa.DataType]]) -> DataFrame:
    """Apply a function to the array ``parts`` of every row; each result is one row (key, ...)."""
    names = [n for n, _ in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[Any, ...]] = [(k, *r) for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in function(p or [])]
            columns = list(zip(*out, strict=True)) or [()] * (len(kinds) + 1)
            types = [batch.column(0).type, *(t for _, t in kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", *names])

    spark_names = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}
    schema = f"key {dict(rows.dtypes)[key]}, " + ", ".join(f"{n} {spark_names[t]}" for n, t in kinds)
    return rows.select(key, parts).mapInArrow(run, schema).withColumnRenamed("key", key)


def split_at_h1(elements: DataFrame) -> DataFrame:
    """(doc_id, part_no, heading, chars, paragraphs, pages): one part for each heading of level 1.

    What stands before the first one is put before every part and counts in each; a document without such headings
    is one part, ``Full Document``.
    """
    part = F.count(F.when(F.col("level") == 1, 1)).over(by_document())
    rows = elements.withColumn("part_no", part).groupBy("doc_id", "part_no").agg(
        F.min_by("text", "seq").alias("heading"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("own"), F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("doc_id")
    lead = {c: F.coalesce(F.max(F.when(F.col("part_no") == 0, F.col(c))).over(w), F.lit(0)) for c in ("own", "n")}
    rows = rows.withColumns({"last": F.max("part_no").over(w), "lead_own": lead["own"], "lead_n": lead["n"]}).where("part_no > 0 or last = 0")
    whole = F.col("part_no") == 0
    out = rows.select(
        "doc_id", F.greatest("part_no", F.lit(1)).cast("bigint").alias("part_no"), F.when(whole, "Full Document").otherwise(F.col("heading")).alias("heading"),
        (F.col("own") + F.when(whole, 0).otherwise(F.col("lead_own"))).alias("chars"), (F.col("n") + F.when(whole, 0).otherwise(F.col("lead_n"))).alias("paragraphs"),
    )
    return out.withColumn("pages", page_estimate(F.col("chars")))


def page_estimate(chars: Column) -> Column:
    return F.bround(chars / F.lit(PAGE_CHARS), 1)


def clone_scope(elements: DataFrame, names: Sequence[str]) -> DataFrame:
    """Elements with the sections of these names moved before the first heading (into the preamble), if the document
    has another section; the new place is negative, in the old order."""
    low = F.lower(F.trim("text"))
    w = by_document().rowsBetween(Window.unboundedPreceding, 0)
    head = F.last(F.when(F.col("level") == 1, low), ignorenulls=True).over(w)
    rows = elements.withColumn("_m", F.coalesce(head.isin([n.lower() for n in names]), F.lit(False)))
    others = F.max(F.when((F.col("level") == 1) & ~F.col("_m"), 1)).over(Window.partitionBy("doc_id")).isNotNull()
    moved = F.col("_m") & others
    return rows.withColumns({"level": F.when(moved, None).otherwise(F.col("level")), "seq": F.when(moved, F.col("seq") - 1_000_000_000).otherwise(F.col("seq"))}).drop("_m")


def h2_parts(parts: list[dict], lead: int, limit: int, strict: bool = False) -> list[tuple[str, int, int]]:
    """(heading, chars, elements) of an over-long section cut at its headings of level 2.

    At such a heading the part is closed if lead and part exceed the limit already; with ``strict``, if they would
    exceed it with what follows up to the next such heading.
    """
    groups: list[list[dict]] = []
    for p in parts:
        if p["level"] == 2 or not groups:
            groups.append([])
        groups[-1].append(p)
    out: list[list[dict]] = []
    for g in groups:
        have = sum(len(x["text"] or "") for x in out[-1]) if out else 0
        more = sum(len(x["text"] or "") for x in g) if strict else 0
        if out and lead + have + more <= limit:
            out[-1].extend(g)
        else:
            out.append(list(g))
    return [(o[0]["text"], sum(len(x["text"] or "") for x in o), len(o)) for o in out]


def split_oversized(elements: DataFrame, limit: int = SPLIT_CHARS, strict: bool = False) -> DataFrame:
    """(section, part_no, heading, chars, elements) of every section at level 1, over-long ones cut at level 2.

    ``section`` is ``<doc_id>/<number>``; a section under the limit (with its document's preamble) is one part.
    """
    number = F.count(F.when(F.col("level") == 1, 1)).over(by_document())
    rows = elements.withColumn("_s", number)
    lead = F.sum(F.when(F.col("_s") == 0, F.length("text")).otherwise(0)).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("_lead", lead).where("_s > 0").groupBy(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("_s").cast("string")).alias("section")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "text", F.col("level").cast("int").alias("level"), F.col("_lead").alias("lead")))).alias("parts")
    )

    def cut(parts: list[dict]) -> list[tuple]:
        before = parts[0]["lead"] or 0
        whole = sum(len(p["text"] or "") for p in parts)
        found = h2_parts(parts, before, limit, strict) if before + whole > limit else [(parts[0]["text"], whole, len(parts))]
        return [(k, *f) for k, f in enumerate(found)]

    return fold(rows, "section", "parts", cut, [("part_no", pa.int64()), ("heading", pa.string()), ("chars", pa.int64()), ("elements", pa.int64())])


def chunk_parts(parts: list[dict], most: int = CHUNK_CHARS, overlap: int = OVERLAP_WORDS, least: int = CHUNK_LEAST) -> list[tuple[str, str]]:
    """(heading, text) of the chunks of a document from its ordered parts (kind, text, level).

    A heading closes the chunk before it and is kept beside the text, not in it. Parts are joined by line ends up to
    ``most`` characters; a single longer part is a chunk of its own. Every chunk after the first is led by the last
    words of the chunk before, if that has more of them. A last chunk under ``least`` goes to the one before it.
    """
    chunks: list[tuple[str, str]] = []
    current: list[str] = []
    heading = ""

    def flush(texts: list[str]) -> None:
        own = "\n".join(texts).strip()
        if own:
            words = chunks[-1][1].split() if chunks else []
            lead = " ".join(words[-overlap:]) + "\n\n" if overlap and len(words) > overlap else ""
            chunks.append((heading, lead + own))

    def shrink() -> None:
        while len("\n".join(current).strip()) > most:
            n = 1
            while n < len(current) and len("\n".join(current[: n + 1]).strip()) <= most:
                n += 1
            flush(current[:n])
            del current[:n]

    for p in parts:
        text = p["text"] or ""
        if p.get("level"):
            flush(current)
            current.clear()
            heading = text
            continue
        if p.get("kind") == "table" and current and sum(map(len, current)) + len(text) > most:
            flush(current)
            current.clear()
        if text.strip():
            current.append(text)
            shrink()
    flush(current)
    if len(chunks) > 1 and len(chunks[-1][1]) < least:
        last = chunks.pop()
        chunks[-1] = (chunks[-1][0], chunks[-1][1] + "\n\n" + last[1])
    return chunks


def document_chunks(elements: DataFrame, most: int = CHUNK_CHARS, overlap: int = OVERLAP_WORDS, least: int = CHUNK_LEAST) -> DataFrame:
    """(doc_id, chunk_index, total_chunks, chunk_id, heading, text, char_count)."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "text", F.col("level").cast("int").alias("level"))))
    rows = elements.groupBy("doc_id").agg(ordered.alias("parts"))

    def cut(parts: list[dict]) -> list[tuple]:
        found = chunk_parts(parts, most, overlap, least)
        return [(k, len(found), h, t, len(t)) for k, (h, t) in enumerate(found)]

    kinds = [("chunk_index", pa.int64()), ("total_chunks", pa.int64()), ("heading", pa.string()), ("text", pa.string()), ("char_count", pa.int64())]
    out = fold(rows, "doc_id", "parts", cut, kinds)
    return out.withColumn("chunk_id", F.format_string("%s_%03d", F.col("doc_id").cast("string"), F.col("chunk_index") + 1))


def pack_sections(sections: list[dict], most: int, most_items: int | None = None, start: int = 0) -> list[tuple[str, int, int]]:
    """(last heading, chars, sections) of Markdown files packed greedily from sections (heading, chars, items)."""
    out: list[list[dict]] = []
    size = items = 0
    for s in sections:
        full = size + s["chars"] > most or (most_items is not None and items + (s.get("items") or 0) > most_items)
        if not out or (out[-1] and full):
            out.append([])
            size, items = start, 0
        out[-1].append(s)
        size += s["chars"]
        items += s.get("items") or 0
    return [(o[-1]["heading"], sum(x["chars"] for x in o), len(o)) for o in out]


def packed_markdown(elements: DataFrame, most: int) -> DataFrame:
    """(doc_id, file_no, heading, chars, sections): sections at every heading, packed greedily."""
    number = F.count("level").over(by_document())
    sections = elements.withColumn("_n", number).groupBy("doc_id", "_n").agg(F.min_by("text", "seq").alias("heading"), F.sum(F.length("text") + 1).cast("bigint").alias("chars"))
    rows = sections.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("_n", "heading", "chars"))).alias("parts"))
    kinds = [("file_no", pa.int64()), ("heading", pa.string()), ("chars", pa.int64()), ("sections", pa.int64())]
    return fold(rows, "doc_id", "parts", lambda p: [(k, *x) for k, x in enumerate(pack_sections(p, most))], kinds)


def batches(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """(group, order, batch_no, batch_name): slices of ``size`` rows of each group, groups in first-seen order."""
    w = Window.partitionBy(group).orderBy(order)
    rows = rows.select(group, order).withColumn("_k", F.floor((F.row_number().over(w) - 1) / size))
    parts = rows.groupBy(group).agg(F.min(order).alias("_first"), F.max("_k").alias("_last"))
    parts = running(parts, [F.col("_first"), F.col(group)], F.col("_last") + 1, "_upto").withColumn("_before", F.col("_upto") - F.col("_last") - 1)
    name = F.when(F.col("_last") > 0, F.concat(F.col(group), F.lit(" (part "), F.col("_k") + 1, F.lit(")"))).otherwise(F.col(group))
    return rows.join(parts, group).select(group, order, (F.col("_before") + F.col("_k") + 1).cast("bigint").alias("batch_no"), name.alias("batch_name"))


def base_id(identifier: Column) -> Column:
    """An identifier without its enhancements in parentheses."""
    return F.trim(F.regexp_replace(identifier, r"\(.*$", ""))


def natural_key(identifier: Column) -> Column:
    """A sort key by prefix, number, and numbers in what follows."""
    prefix, number, rest = (F.regexp_extract(identifier, r"^([A-Za-z&]+)[-. ]?0*(\d*)(.*)$", k) for k in (1, 2, 3))
    inner = F.transform(F.regexp_extract_all(rest, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))
    return F.struct(prefix.alias("p"), F.coalesce(number.try_cast("int"), F.lit(0)).alias("n"), inner.alias("e"), identifier.alias("i"))


class FamilyPacker:
    """Packs members that come one by one, families in order: families are joined while under both budgets; a larger
    family is cut between identifiers, which keep their enhancements. Only the chunk at hand is held."""

    def __init__(self, most: int, budget: int) -> None:
        self.most, self.budget = most, budget
        self.names: list[str] = []
        self.count = self.chars = 0
        self.run: tuple[str, int, int] | None = None
        self.family: object = None
        self.cutting = False

    def close(self) -> Iterator[tuple[str, int, int]]:
        if self.run:
            yield from self._place(self.run)
            self.run = None
        if self.count:
            yield "+".join(self.names), self.count, self.chars
        self.names, self.count, self.chars = [], 0, 0

    def _place(self, run: tuple[str, int, int]) -> Iterator[tuple[str, int, int]]:
        if self.count and (self.count + run[1] > self.most or self.chars + run[2] > self.budget):
            yield "+".join(self.names), self.count, self.chars
            self.count = self.chars = 0
        self.count, self.chars = self.count + run[1], self.chars + run[2]

    def add(self, family: str, members: int, size: int, identifier: str, chars: int) -> Iterator[tuple[str, int, int]]:
        """The chunks that are full when a member of a family of so many members and characters comes."""
        if family != self.family:
            large = members > self.most or size > self.budget
            if self.cutting or large or self.count + members > self.most or self.chars + size > self.budget:
                yield from self.close()
            self.family, self.cutting, self.names = family, large, [*self.names, family]
        if not self.cutting:
            self.count, self.chars = self.count + 1, self.chars + chars
            return
        base = re.sub(r"\(.*$", "", identifier).strip()
        if self.run and self.run[0] != base:
            yield from self._place(self.run)
            self.run = None
        self.run = (base, (self.run[1] if self.run else 0) + 1, (self.run[2] if self.run else 0) + chars)


def combine_families(families: Sequence[tuple[str, list[dict]]], most: int, budget: int) -> list[tuple[str, int, int]]:
    """(names, members, chars) of the chunks of whole families (id, chars) in order."""
    packer = FamilyPacker(most, budget)
    out: list[tuple[str, int, int]] = []
    for name, members in families:
        for m in members:
            out.extend(packer.add(name, len(members), sum(x["chars"] for x in members), m["id"], m["chars"]))
    return [*out, *packer.close()]


def family_chunks(controls: DataFrame, most: int, budget: int) -> DataFrame:
    """(collection, chunk_no, families, members, chars) from (collection, family, ord, id, chars).

    Families come in first-seen order within their collection, members in natural order. ``family`` may be the prefix
    of an identifier or the domain that a catalog gives it. Packing is a walk in order: a collection is sorted and
    walked in one task, which holds one chunk at a time.
    """
    sizes = controls.groupBy(F.col("collection").alias("_c"), F.col("family").alias("_f")).agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("chars").cast("bigint").alias("size"))
    rows = controls.join(sizes, F.col("collection").eqNullSafe(F.col("_c")) & F.col("family").eqNullSafe(F.col("_f"))).select("collection", "family", "first", "n", "size", "id", F.col("chars").cast("bigint").alias("chars"), natural_key(F.col("id")).alias("_k"))
    walked = rows.repartition("collection").sortWithinPartitions("collection", "first", "family", "_k").select("collection", "family", "n", "size", "id", "chars")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = object()
        packer, number = FamilyPacker(most, budget), 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["collection", "chunk_no", "families", "members", "chars"])

        for frame in frames:
            out: list[tuple] = []
            for collection, *member in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                if collection != at:
                    out += [(at, number + k, *c) for k, c in enumerate(packer.close())]
                    at, packer, number = collection, FamilyPacker(most, budget), 0
                for chunk in packer.add(member[0] or "", *member[1:3], member[3] or "", member[4] or 0):
                    out.append((at, number, *chunk))
                    number += 1
            yield batch(out)
        yield batch([(at, number + k, *c) for k, c in enumerate(packer.close())])

    return walked.mapInArrow(run, "collection string, chunk_no bigint, families string, members bigint, chars bigint")


def pairs_of(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target, number, label): every source batch against every target chunk, numbered in order.

    ``sources`` and ``targets`` have (name). The product is what is asked for: names are numbered on both sides, every
    source is spread over the numbers of the targets, and these are joined on equality.
    """
    left, right = (numbered(df.select("name").distinct(), [F.col("name")], "_k") for df in (sources, targets))
    many = F.lit(right.count())
    rows = left.select(F.col("name").alias("source"), F.col("_k").alias("_s"), F.explode(F.sequence(F.lit(1).cast("bigint"), many)).alias("_k")).join(right.withColumnRenamed("name", "target"), "_k")
    rows = rows.select("source", "target", ((F.col("_s") - 1) * many + F.col("_k")).alias("number"))
    return rows.withColumn("label", F.format_string("%02d_%s_x_%s", F.col("number"), safe_label(F.col("source")), safe_label(F.col("target"))))


def safe_label(name: Column) -> Column:
    """A name with every run of other characters than letters and digits as one underscore."""
    return F.regexp_replace(F.replace(name, F.lit("&"), F.lit("and")), "[^A-Za-z0-9]+", "_")


def passed_through(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, part_no, chars): every document as its one part, for runs that split nothing."""
    return documents.select(key, F.lit(1).cast("bigint").alias("part_no"), F.length(text).cast("bigint").alias("chars"))


def chunk_names(chunks: DataFrame, name: str, heading: str) -> DataFrame:
    """Add ``chunk_id`` and ``file``: the stem of the document's file name with the chunk's number, and a file name led by the
    last heading in the chunk. ``chunks`` has ``chunk_index`` from 0."""
    number = F.format_string("%03d", F.col("chunk_index") + 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return chunks.withColumns({"chunk_id": F.concat_ws("_", stem, number), "file": F.concat(number, F.lit("_"), F.coalesce(F.nullif(safe_filename(F.col(heading)), F.lit("")), stem), F.lit(".md"))})


def patched_title(block: Column, title: Column) -> Column:
    """A metadata block whose ``title:`` line says another title; a block without one gets it as its first line."""
    line = F.concat(F.lit("title: "), title)
    quoted = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(block.rlike(r"(?m)^title:"), F.regexp_replace(block, F.lit(r"(?m)^title:[^\n]*"), quoted)).otherwise(F.regexp_replace(block, F.lit(r"^---\n"), F.concat(F.lit("---\n"), quoted, F.lit("\n"))))


def cloned_scope(chunks: DataFrame, scope: DataFrame) -> DataFrame:
    """Chunks (doc_id, chunk_index, text), each after the first led by its document's scope (doc_id, scope), if it has one."""
    joined = chunks.join(scope, "doc_id", "left")
    later = (F.col("chunk_index") > 0) & (F.length("scope") > 0)
    return joined.withColumn("text", F.when(later, F.concat("scope", F.lit("\n\n"), "text")).otherwise(F.col("text"))).drop("scope")
