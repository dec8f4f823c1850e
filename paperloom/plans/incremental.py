"""Queries on streams over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.plans.registry import Registry
from paperloom.session import scratch, table
from paperloom.streaming import events as S

R = Registry()
query = R.query


def _stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    return S.stream_table(spark, f"{d}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _through(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """The rows that a stream writes when it has read what is there."""
    base = scratch(spark)
    S.run_available(stream, S.idempotent_sink(f"{base}/out"), f"{base}/state", mode)
    return spark.read.schema(stream.schema).parquet(f"{base}/out").select(*stream.columns)


@query("t1_available_now", "select event_type, count(*) as n, sum(cast(round(value * 100) as bigint))::bigint as cents from events group by 1")
def t1_available_now(spark: SparkSession, d: str) -> DataFrame:
    """Events copied by a stream that can be resumed, then counted."""
    rows = _through(spark, _stream(spark, d).select("event_id", "event_type", "value"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


@query("t2_triggers", "select distinct user_id, event_type from events where event_type in ('signup', 'error') and value > 0")
def t2_triggers(spark: SparkSession, d: str) -> DataFrame:
    """Each change to a state with an empty lock once, through a stream whose state is bounded by 30 days."""
    stream = _stream(spark, d).withColumn("lock", F.when(F.col("value") > 0, "").otherwise("held"))
    found = S.triggers(stream.select("user_id", "event_type", "lock", "ts"), F.col("event_type").isin("signup", "error"), F.col("lock"), ["user_id", "event_type"], "ts", "30 days")
    return _through(spark, found.select("user_id", "event_type"))


@query("t4_reminders", "select o_orderkey, n as days, n // 7 as round from (select o_orderkey, date_diff('day', o_orderdate::date, date '1998-09-01') as n from orders where o_orderstatus = 'O') where n >= 7")
def t4_reminders(spark: SparkSession, d: str) -> DataFrame:
    """T4: the open rows that a weekly run at a day reminds of."""
    return S.reminders(table(spark, d, "orders"), "o_orderkey", F.col("o_orderstatus") == "O", "o_orderdate", F.lit("1998-09-01").cast("date"))


@query("t5_versions", "with l as (select filename, max(rev_type) as label from tracked_change group by 1), o as (select filename, min(rev_type) as label from tracked_change group by 1) select l.filename, l.label, l.label is distinct from o.label as changed from l left join o on l.filename = o.filename")
def t5_versions(spark: SparkSession, d: str) -> DataFrame:
    """T5: labels of files, and which of them an update must write."""
    rows = table(spark, d, "tracked_change")
    one = lambda f: rows.groupBy("filename").agg(f("rev_type").alias("label"))
    return S.versions(one(F.min), one(F.max), "filename", "label")


@query("t3_ready_rows", "select event_id from events where event_type = 'purchase' and value > 10")
def t3_ready_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are ready and not done."""
    ready, _ = S.ready_rows(_stream(spark, d), F.col("event_type") == "purchase", F.col("value") <= 10)
    return _through(spark, ready.select("event_id"))


@query("t6_state_steps", "with s as (select event_type as state, lead(event_type) over (partition by user_id order by ts, event_type) as next from events) select state, next, count(*) as n from s where next is not null group by 1, 2")
def t6_state_steps(spark: SparkSession, d: str) -> DataFrame:
    """Which state follows which."""
    return S.state_steps(table(spark, d, "events"), "user_id", "ts", "event_type")


@query("t9_window_counts", "select event_type, count(*) as n, epoch_us(time_bucket(interval 1 hour, ts)) as start_us from events group by 1, 3")
def t9_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Extension: events of each hour, from a stream with late rows."""
    rows = _through(spark, S.window_counts(_stream(spark, d), "ts", ["event_type"]), "update")
    return rows.groupBy("event_type", F.unix_micros("window_start").alias("start_us")).agg(F.max("n").alias("n"))


_ALLOWED = {"signup": ["view"], "view": ["click", "purchase"], "click": ["view", "purchase"], "purchase": ["view"], "error": []}
_ALLOWED_SQL = " or ".join(f"(state = '{k}' and next = '{v}')" for k, vs in _ALLOWED.items() for v in vs)


@query("t6_bad_steps", f"with s as (select user_id, ts, event_type as state, lead(event_type) over (partition by user_id order by ts, event_type) as next from events) select user_id, epoch_us(ts) as ts_us, state, next from s where next is not null and state <> next and not ({_ALLOWED_SQL})")
def t6_bad_steps(spark: SparkSession, d: str) -> DataFrame:
    """Changes that the state machine does not allow."""
    rows = S.bad_steps(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "event_type", _ALLOWED)
    return rows.select("user_id", F.unix_micros("ts").alias("ts_us"), "state", "next")


@query("t6_state_machine", f"with s as (select user_id, event_type as next, lag(event_type) over (partition by user_id order by ts, event_type) as state from events) select valid, count(*) as n from (select state = next or ({_ALLOWED_SQL}) as valid from s where state is not null) group by 1")
def t6_state_machine(spark: SparkSession, d: str) -> DataFrame:
    """Every change of state on a stream, checked against the state machine."""
    found = S.state_machine(_stream(spark, d), "user_id", "ts", "event_type", _ALLOWED)
    return _through(spark, found).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))
