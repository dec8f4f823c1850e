"""Incremental versions: a source that grows, results that a restart does not repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructType


def stream_table(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    """A folder of parquet files as a stream: files that arrive later are read later."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there now and stop; a later run goes on after it (the checkpoint knows what is done)."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return query


def idempotent_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A sink whose batches overwrite themselves: a batch that is run again after a crash leaves one copy."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def first_per_key(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """One row of each key: repeats of it are dropped as long as they come within the time that late rows may take.

    ``late`` bounds the state: keys older than it are forgotten, and a repeat that comes later still passes again.
    """
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def triggers(stream: DataFrame, state: Column, lock: Column, keys: list[str], time: str, late: str = "7 days") -> DataFrame:
    """The changes that start an action: rows in the state whose lock is empty, each change (``keys``) once."""
    return first_per_key(stream.where(state & (F.length(F.trim(F.coalesce(lock.cast("string"), F.lit("")))) == 0)), keys, time, late)


def ready_rows(stream: DataFrame, ready: Column, done: Column) -> tuple[DataFrame, DataFrame]:
    """(to copy, to warn of): ready rows that are not done, and rows that are done without being ready."""
    return stream.where(ready & ~F.coalesce(done, F.lit(False))), stream.where(~F.coalesce(ready, F.lit(False)) & F.coalesce(done, F.lit(False)))


def window_counts(rows: DataFrame, time: str, keys: list[str], length: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(window_start, keys..., n): an extension, rows by tumbling windows of event time; works on streams and tables."""
    marked = rows.withWatermark(time, late) if rows.isStreaming else rows
    return marked.groupBy(F.window(time, length).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("window_start"), *keys, "n")


def session_counts(rows: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """(session_start, keys..., n): an extension, rows by sessions of event time."""
    marked = rows.withWatermark(time, late) if rows.isStreaming else rows
    return marked.groupBy(F.session_window(time, gap).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("session_start"), *keys, "n")


def state_steps(rows: DataFrame, key: str, time: str, state: str) -> DataFrame:
    """(state, next, n): how often each state is followed by each other one, by key in order of time."""
    step = rows.withColumn("next", F.lead(state).over(Window.partitionBy(key).orderBy(time, state)))
    return step.where("next is not null").groupBy(F.col(state).alias("state"), "next").agg(F.count(F.lit(1)).alias("n"))


def bad_steps(rows: DataFrame, key: str, time: str, state: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, time, state, next) of the changes that a state machine does not allow; staying in a state is allowed."""
    step = rows.withColumn("next", F.lead(state).over(Window.partitionBy(key).orderBy(time, state))).where("next is not null")
    table = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]) if v else F.array().cast("array<string>"))])
    fine = (F.col(state) == F.col("next")) | F.coalesce(F.array_contains(F.element_at(table, F.col(state)), F.col("next")), F.lit(False))
    return step.where(~fine).select(key, time, F.col(state).alias("state"), "next")


def state_machine(stream: DataFrame, key: str, time: str, state: str, allowed: Mapping[str, Sequence[str]], late: str = "7 days") -> DataFrame:
    """(key, time, state, next, valid): every change of state on a stream, checked against a state machine.

    The state kept for a key is its last state and the time of it; it is dropped when the watermark has passed that
    time by ``late``. Rows of a key within one batch are taken in order of time.
    """
    kind, kept = dict(stream.dtypes), "state string, at timestamp"

    def walk(keys: tuple, frames: Iterator[pd.DataFrame], memory: GroupState) -> Iterator[pd.DataFrame]:
        if memory.hasTimedOut:
            memory.remove()
            return
        last, at = memory.get if memory.exists else (None, None)
        out = []
        for when, now in sorted((w, s) for f in frames for w, s in zip(f[time], f[state], strict=True)):
            if last is not None:
                out.append((keys[0], when, last, now, now == last or now in allowed.get(last, ())))
            last, at = now, when
        memory.update((last, at))
        memory.setTimeoutTimestamp(max(int(pd.Timestamp(at).timestamp() * 1000), memory.getCurrentWatermarkMs()) + 1 + int(pd.Timedelta(late).total_seconds() * 1000))
        yield pd.DataFrame(out, columns=[key, time, "state", "next", "valid"])

    marked = stream.select(key, time, state).withWatermark(time, late)
    return marked.groupBy(key).applyInPandasWithState(walk, f"{key} {kind[key]}, {time} timestamp, state string, next string, valid boolean", kept, "append", "EventTimeTimeout")


def versions(old: DataFrame, new: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, changed): the labels of the new rows, and whether they differ from the old ones: writing only the
    changed ones makes an update that may run again."""
    joined = new.select(key, label).join(old.select(key, F.col(label).alias("_old")), key, "left")
    return joined.select(key, label, (~F.col(label).eqNullSafe(F.col("_old"))).alias("changed"))


def reminders(facts: DataFrame, key: str, open_rows: Column, since: str, as_of: Column, every: int = 7) -> DataFrame:
    """(key, days, round): the open rows that a run at a day reminds of: those waiting for ``every`` days or more, and the
    how many-th reminder it is; run again on the same day, it gives the same rows."""
    days = F.date_diff(as_of, F.to_date(since)).cast("bigint")
    return facts.where(open_rows).select(key, days.alias("days")).where(F.col("days") >= every).withColumn("round", F.floor(F.col("days") / every).cast("bigint"))
