"""Plain texts as ordered elements: one line is one paragraph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def text_lines(documents: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, keep..., seq, text): every line of every text with its 0-based number; null texts have none."""
    return documents.select("doc_id", *keep, F.posexplode(F.split("text", "\n")).alias("seq", "text"))


def text_elements(documents: DataFrame, sections: DataFrame, *keep: str) -> DataFrame:
    """Lines with the style, level and fake flag that a heading table gives them.

    Columns: doc_id, keep..., seq, text, style (``Normal`` where the line is no heading), level (null there; a
    heading without level reads as 2), fake. Repeated rows of the heading table count once; of different rows for
    one line the least counts. Headings are joined to whole documents before these are cut into lines: the texts
    are shuffled once, by document, and windows and aggregations by document then need no further exchange.
    """
    about = F.struct(F.col("heading_style").alias("style"), F.coalesce("heading_level", F.lit(2)).alias("level"), F.col("is_fake_heading").alias("fake"))
    heads = sections.where(F.col("start_para_index").isNotNull()).groupBy("doc_id", F.col("start_para_index").cast("int").alias("_s")).agg(F.min(about).alias("_h"))
    heads = heads.groupBy(F.col("doc_id").alias("_d")).agg(F.map_from_entries(F.collect_list(F.struct("_s", "_h"))).alias("_heads"))
    joined = documents.select("doc_id", *keep, "text").join(heads, F.col("doc_id") == F.col("_d"), "left")
    lines = joined.select("doc_id", *keep, "_heads", F.posexplode(F.split("text", "\n")).alias("seq", "text")).withColumn("_h", F.try_element_at("_heads", F.col("seq")))
    return lines.select("doc_id", *keep, "seq", "text", F.coalesce("_h.style", F.lit("Normal")).alias("style"), F.col("_h.level").alias("level"), F.coalesce("_h.fake", F.lit(False)).alias("fake"))


def text_tables(documents: DataFrame) -> DataFrame:
    """(doc_id, table_idx, row_idx, col_idx, tc_id, text): the tables of plain texts, runs of lines of which each has at
    least two non-blank cells parted by tabs."""
    cells = F.transform(F.split("text", "\t"), lambda c: F.trim(c))
    lines = text_lines(documents).select("doc_id", "seq", cells.alias("cells")).where(F.size(F.filter("cells", lambda c: c != "")) >= 2)
    w = Window.partitionBy("doc_id").orderBy("seq")
    rows = lines.withColumn("_new", F.coalesce(F.col("seq") - F.lag("seq").over(w) > 1, F.lit(True))).withColumn("table_idx", F.sum(F.col("_new").cast("int")).over(w) - 1)
    first = F.min("seq").over(Window.partitionBy("doc_id", "table_idx"))
    rows = rows.select("doc_id", F.col("table_idx").cast("bigint").alias("table_idx"), (F.col("seq") - first).cast("bigint").alias("row_idx"), F.posexplode("cells").alias("_c", "text"))
    return rows.select("doc_id", "table_idx", "row_idx", F.col("_c").cast("bigint").alias("col_idx"), F.concat_ws(".", "row_idx", "_c").alias("tc_id"), "text")
