"""Running totals over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import materialize


def running(rows: DataFrame, order: Sequence[Column], amount: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over all rows up to each one, itself included, in ``order`` (which should be total).

    Rows are range-partitioned by the order, written once, and summed within their partition; the sums of the partitions
    before, one row each, give the rest.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = materialize(materialize(rows).repartitionByRange(parts, *order).withColumns({"_part": F.spark_partition_id(), "_amount": amount}))
    sums = spread.groupBy("_part").agg(F.sum("_amount").alias("_sum"))
    ahead = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_ahead"))  # one row a partition
    inside = F.sum("_amount").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return spread.withColumn("_inside", inside).join(F.broadcast(ahead), "_part").withColumn(out, (F.col("_inside") + F.col("_ahead")).cast("bigint")).drop("_part", "_amount", "_inside", "_ahead")


def numbered(rows: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Add ``out``: the number of each row, from 1, in ``order``."""
    return running(rows, order, F.lit(1), out)
