"""How often every term occurs and in how many records, by count arrays over a global integer dictionary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrow import offsets
from paperloom.session import materialize

#: Terms of one range of identifiers, and ranges that a task holds before it hands them on.
RANGE, HELD = 4_096, 512
#: A term in more than this part of all (record, term) rows is encoded through a broadcast of at most as many rows.
HOT_PART = 1_000


def dictionary(uses: DataFrame) -> DataFrame:
    """(term, term_id, records): a dense number for every distinct term, in their order.

    Terms are range-partitioned and numbered within their partition; only the partitions' sizes come to the driver.
    """
    terms = uses.groupBy("term").agg(F.count(F.lit(1)).alias("records"))
    parts = int(uses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = materialize(terms.repartitionByRange(parts, "term").sortWithinPartitions("term").withColumn("_n", F.monotonically_increasing_id()))
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(F.shiftright("_n", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    begin, at = {}, 0
    for part, n in sizes:
        begin[part] = at
        at += n
    first = F.element_at(F.create_map(*[F.lit(x) for kv in begin.items() for x in kv]), F.shiftright("_n", 33)) if begin else F.lit(0)
    return numbered.select("term", (first + F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint").alias("term_id"), "records")


def encode(uses: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, occurrences) of every row of ``uses``; hot terms take a broadcast, the others a shuffled join."""
    total = terms.agg(F.sum("records")).first()[0] or 0
    hot = terms.where(F.col("records") * HOT_PART > F.lit(total)).select("term", "term_id")  # under HOT_PART rows
    through = uses.join(F.broadcast(hot), "term", "left")
    direct = through.where(F.col("term_id").isNotNull()).select("term_id", "occurrences")
    rest = through.where(F.col("term_id").isNull()).select("term", "occurrences").join(terms.select("term", "term_id"), "term").select("term_id", "occurrences")
    return direct.unionByName(rest)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count arrays of this task: one row for each range of identifiers that it met."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        at = [np.flatnonzero(n) for _, n in held.values()]
        cuts = pa.array(offsets(np.array([len(x) for x in at], np.int64)), pa.int32())
        places = np.concatenate(at)
        occurrences = np.concatenate([o[x] for (o, _), x in zip(held.values(), at, strict=True)])
        records = np.concatenate([n[x] for (_, n), x in zip(held.values(), at, strict=True)])
        made = [pa.ListArray.from_arrays(cuts, pa.array(v, pa.int64())) for v in (places, occurrences, records)]
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *made], names=["range_id", "places", "occurrences", "records"])
        held.clear()
        return batch

    for batch in batches:
        ids, times = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
        ranges = ids // RANGE
        for r in np.unique(ranges):
            mine = ranges == r
            occurrences, records = held.setdefault(int(r), (np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)))
            place = ids[mine] - r * RANGE
            np.add.at(occurrences, place, times[mine])
            records += np.bincount(place, minlength=RANGE)
            if len(held) > HELD:
                yield out()
    if held:
        yield out()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of one range after the other, summed."""
    at, occurrences, records = None, np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)

    def out() -> pa.RecordBatch:
        there = np.flatnonzero(records)
        return pa.RecordBatch.from_arrays([pa.array(there + at * RANGE), pa.array(occurrences[there]), pa.array(records[there])], names=["term_id", "occurrences", "records"])

    for batch in batches:
        for r, places, times, n in zip(*(batch.column(k) for k in range(4)), strict=True):
            r = r.as_py()
            if r != at:
                if at is not None:
                    yield out()
                at, occurrences, records = r, np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)
            where = places.values.to_numpy()
            occurrences[where] += times.values.to_numpy()
            records[where] += n.values.to_numpy()
    if at is not None:
        yield out()


def term_counts(uses: DataFrame) -> DataFrame:
    """(term, occurrences, records) of every term of ``uses`` (record, term, occurrences), one row a pair of the two.

    Each task adds its rows into count arrays, one pair of arrays for each range of identifiers; arrays of one range
    are summed. What is shuffled for a term is one number a task, however hot it is.
    """
    uses = materialize(uses.select("term", F.col("occurrences").cast("bigint").alias("occurrences")))
    terms = dictionary(uses)
    arrays = encode(uses, terms).mapInArrow(_blocks, "range_id bigint, places array<bigint>, occurrences array<bigint>, records array<bigint>")
    summed = arrays.repartition("range_id").sortWithinPartitions("range_id").mapInArrow(_summed, "term_id bigint, occurrences bigint, records bigint")
    return terms.select("term", "term_id").join(summed, "term_id").select("term", "occurrences", "records")


def acronym_value(column: Column) -> Column:
    """An acronym in upper case without blanks, hyphens and slashes at its ends; empty ones become null."""
    return F.nullif(F.upper(F.regexp_replace(column, r"^[\s \-/]+|[\s \-/]+$", "")), F.lit(""))


def acronym_uses(per_document: DataFrame) -> DataFrame:
    """(record, term, occurrences): every value that a document uses, its occurrences over all spellings.

    Repeated rows count once; rows whose occurrences are null or not above 0, and empty values, say nothing.
    """
    rows = per_document.select("entry_id", "document", "acronym", "occurrences").distinct()
    rows = rows.select(F.col("document").alias("record"), acronym_value(F.col("acronym")).alias("term"), F.col("occurrences").cast("bigint").alias("occurrences"))
    return rows.where("record is not null and term is not null and occurrences > 0").groupBy("record", "term").agg(F.sum("occurrences").alias("occurrences"))


def acronym_counts(per_document: DataFrame, rare: int = 2, common_part: float = 0.2) -> DataFrame:
    """(acronym, occurrences, documents, band): band is ``rare`` up to ``rare`` documents, ``common`` in more than
    ``common_part`` of all distinct documents of the table, else ``kept``. A value that is both is ``rare``."""
    counts = term_counts(acronym_uses(per_document))
    documents = per_document.agg(F.count_distinct("document")).first()[0]
    band = F.when(F.col("records") <= rare, "rare").when(F.col("records") > F.lit(documents * common_part), "common").otherwise("kept")
    return counts.select(F.col("term").alias("acronym"), "occurrences", F.col("records").alias("documents"), band.alias("band"))
