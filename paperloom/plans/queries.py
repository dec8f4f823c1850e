"""Named queries over the driver's tables: each takes (spark, directory of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.operators import reconcile, timestamps
from paperloom.plans import compare, extraction, incremental, inventory, records, review, structure
from paperloom.session import table


def p3_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of both tables with its instant and how it was placed."""
    return timestamps.normalised_dates(*(table(spark, sf_dir, t) for t in ("tracked_change", "review_comment", "author_locale")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that denote an instant and are not stored in the target form."""
    return timestamps.found_dates(p3_dates(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the copies of paragraph, and what the saved report has wrong."""
    return reconcile.paragraph_differences(table(spark, sf_dir, "paragraph"), table(spark, sf_dir, "paragraph_diff"))


_FAMILIES = (structure.R, records.R, extraction.R, review.R, inventory.R, compare.R, incremental.R)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f.__name__: f for f in (p3_found, p3_dates, p5_found)},
    **{name: f for family in _FAMILIES for name, f in family.queries.items()},
}
