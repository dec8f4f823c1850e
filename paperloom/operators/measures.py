"""Measures of a fact table with states and two dates; the states are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.order import numbered


def state_counts(facts: DataFrame, by: Sequence[str], state: str, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """(by..., total, <name>...): rows in each group of states."""
    return facts.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(state).isin(list(v))).alias(k) for k, v in names.items()])


def ratio(part: Column, whole: Column) -> Column:
    """A share, null where the whole is zero."""
    return F.try_divide(part, whole)


def state_shares(facts: DataFrame, by: Sequence[str], state: str, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """(by..., <name>_share...): the share of each group of states among all rows, null where there are none."""
    rows = state_counts(facts, by, state, names)
    return rows.select(*by, *[ratio(F.col(k), F.col("total")).alias(f"{k}_share") for k in names])


def cycle_times(facts: DataFrame, by: Sequence[str], begun: str, ended: str, within: int) -> DataFrame:
    """(by..., finished, days, average, longest, in_time, in_time_share): whole days between two dates where both are known."""
    rows = facts.withColumn("_d", days_between(F.col(begun), F.col(ended)))
    out = rows.groupBy(*by).agg(F.count("_d").alias("finished"), F.sum("_d").alias("days"), F.avg("_d").alias("average"), F.max("_d").alias("longest"), F.count_if(F.col("_d") <= within).alias("in_time"))
    return out.withColumn("in_time_share", ratio(F.col("in_time"), F.col("finished")))


def days_between(begun: Column, ended: Column) -> Column:
    """Whole days between two dates, null where one is unknown."""
    return F.date_diff(F.to_date(ended), F.to_date(begun)).cast("bigint")


def pending_age(facts: DataFrame, by: Sequence[str], begun: str, open_rows: Column, as_of: Column, stuck: int) -> DataFrame:
    """(by..., pending, days, average, oldest, stuck) of the rows that are open at a day; never the clock of the machine."""
    rows = facts.where(open_rows).withColumn("_d", days_between(F.col(begun), as_of))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("pending"), F.sum("_d").alias("days"), F.avg("_d").alias("average"), F.max("_d").alias("oldest"), F.count_if(F.col("_d") > stuck).alias("stuck"))


def is_late(due: Column, open_rows: Column, as_of: Column) -> Column:
    """Whether an open row's day is over at a day; a row without a day is never late."""
    return F.coalesce(open_rows & (F.to_date(due) < as_of), F.lit(False))


def with_age_columns(facts: DataFrame, begun: str, ended: str, due: str, open_rows: Column, as_of: Column) -> DataFrame:
    """Add ``cycle_days`` (null while open), ``queue_days`` (0 for closed rows and those without a begin) and ``is_overdue``."""
    waiting = F.when(open_rows, F.coalesce(days_between(F.col(begun), as_of), F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return facts.withColumns({"cycle_days": days_between(F.col(begun), F.col(ended)), "queue_days": waiting, "is_overdue": is_late(F.col(due), open_rows, as_of)})


def person_measures(facts: DataFrame, person: str, state: str, names: Mapping[str, Sequence[str]], begun: str, ended: str, due: str, again: Column, as_of: Column) -> DataFrame:
    """What the pages of requesters and approvers show, one row for each person: (person, total, <name>..., overdue,
    due_today, again, oldest, average_days). ``names`` must have ``pending``, the states of open rows."""
    waiting = F.col(state).isin(list(names["pending"]))
    rows = with_age_columns(facts, begun, ended, due, waiting, as_of)
    return rows.groupBy(F.col(person).alias("person")).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(state).isin(list(v))).alias(k) for k, v in names.items()], F.count_if("is_overdue").alias("overdue"), F.count_if(F.coalesce(waiting & (F.to_date(due) == as_of), F.lit(False))).alias("due_today"),
        F.count_if(F.coalesce(again, F.lit(False))).alias("again"), F.max(F.when(waiting, F.col("queue_days"))).alias("oldest"), F.avg("cycle_days").alias("average_days"),
    )


def selected_label(rows: DataFrame, column: str, several: str = "(several)") -> DataFrame:
    """(label): the one value that a column holds, or that there are several, or null without rows."""
    return rows.agg(F.when(F.min(column) == F.max(column), F.min(column).cast("string")).when(F.count(column) > 0, F.lit(several)).alias("label"))


def leaders(facts: DataFrame, by: str, most: int) -> DataFrame:
    """(by, n) of the ``most`` values with most rows; of equal ones the least."""
    return facts.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(most)


def board(facts: DataFrame, state: str, order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """(state, keep..., place, cards): the cards of a board, numbered within their column in order, and how many it has.

    Cards are numbered over the whole table by ranges, so that a column with a third of all cards is not one task.
    """
    rows = numbered(facts.select(state, *keep), [F.col(state), *order], "_n")
    sizes = rows.groupBy(F.col(state).alias("_s")).agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("cards"))
    return rows.join(sizes, F.col(state).eqNullSafe(F.col("_s"))).select(state, *keep, (F.col("_n") - F.col("_first") + 1).alias("place"), "cards")


def stage_queue(facts: DataFrame, state: str, stage: str, days: str, key: str, person: str | None = None, me: str | None = None) -> DataFrame:
    """(key, days, place): the rows of a stage, the longest waiting first; with ``me``, only those of this person, whatever
    the case of the name."""
    rows = facts.where(F.col(state) == stage)
    if person and me is not None:
        rows = rows.where(F.lower(person) == me.lower())
    return numbered(rows.select(key, F.col(days).alias("days")), [F.desc("days"), F.asc(key)], "place")


def reviews_due(facts: DataFrame, key: str, due: str, as_of: Column, within: int) -> DataFrame:
    """(key, due, days, status): rows whose review is due within so many days or overdue; ``days`` are those left or over."""
    left = days_between(as_of, F.col(due))
    rows = facts.select(key, F.to_date(due).alias("due"), left.alias("_left")).where(F.col("_left") <= within)
    return rows.select(key, "due", F.abs("_left").alias("days"), F.when(F.col("_left") < 0, "overdue").otherwise("due").alias("status"))


def month_over_month(facts: DataFrame, date: str) -> DataFrame:
    """(month, n, before, change, change_share): every month from the first to the last against the month before it.

    A month without rows counts 0. The share is null where the month before has none. The window runs over one row a
    month.
    """
    seen = facts.groupBy(F.trunc(F.to_date(date), "month").alias("month")).agg(F.count(F.lit(1)).alias("n")).where("month is not null")
    months = seen.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null").select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    rows = months.join(seen, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))
    rows = rows.withColumn("before", F.lag("n").over(Window.orderBy("month")))
    return rows.withColumns({"change": F.col("n") - F.col("before"), "change_share": ratio(F.col("n") - F.col("before"), F.col("before"))})


def date_table(rows: DataFrame, date: str) -> DataFrame:
    """(day, year, month, weekday): every day from the first to the last of a column."""
    ends = rows.agg(F.min(F.to_date(date)).alias("a"), F.max(F.to_date(date)).alias("b")).where("a is not null")
    days = ends.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select("day", F.year("day").cast("bigint").alias("year"), F.month("day").cast("bigint").alias("month"), F.weekday("day").cast("bigint").alias("weekday"))
