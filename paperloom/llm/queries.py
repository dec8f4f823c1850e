"""Queries of the corpus operators: each takes (spark, directory of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, language, lookalikes, mixing, neardup, splitting, terms
from paperloom.session import table


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = lookalikes.policy_texts(table(spark, sf_dir, "control_row"), table(spark, sf_dir, "paragraph"))
    return lookalikes.repair_texts(texts, ["field_name", "id"], "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose stored texts differ but look the same."""
    return lookalikes.same_look_pairs(_forms(spark, sf_dir), "field_name", "id", "text", "look").distinct()


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one form of every text of both fields."""
    return _forms(spark, sf_dir).select("field_name", F.col("id").cast("bigint").alias("id"), "form").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of control records whose texts are at least as alike as the threshold."""
    pairs = neardup.similar_records(neardup.control_texts(table(spark, sf_dir, "control_row")))
    return pairs.select(neardup.field_name(), F.col("key_1").alias("row_id_1"), F.col("key_2").alias("row_id_2")).distinct()


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every control record that is alike to another, and how many it is alike to."""
    groups = neardup.similar_groups(neardup.control_texts(table(spark, sf_dir, "control_row")))
    return groups.select(neardup.field_name(), F.col("key").alias("row_id"), F.col("group_key").alias("group_id"), "links").distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over the limit with the coarsest boundary that suffices."""
    return splitting.found_boundaries(table(spark, sf_dir, "documents"), table(spark, sf_dir, "section_info"))


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all documents."""
    return splitting.split_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "section_info"))


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every acronym with its occurrences, documents and band."""
    return terms.acronym_counts(table(spark, sf_dir, "acronym_per_document"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acronyms that are too rare or too common."""
    return p6_counts(spark, sf_dir).where("band in ('rare', 'common')").select("acronym", "band")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"), ["doc_id"], "text")


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counted = bpe.count_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"], "text")
    return mixing.mix(counted, table(spark, sf_dir, "mix_target"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken into the mix."""
    return _mixed(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source holds of the mix."""
    return _mixed(spark, sf_dir)[1]


def p9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document and of every line in another one, with its confidence."""
    return language.detect_languages(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong label, and lines in another language."""
    return language.found_languages(p9_languages(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_forms, p2_found, p2_groups, p4_found, p4_pieces, p6_found, p6_counts, p7_ids, p8_mix, p8_shares, p9_found, p9_languages)
}
