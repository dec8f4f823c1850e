"""Acronyms of texts: occurrences, definitions, tags and glossaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import WORD_END, WORD_START

MIN_LENGTH, MAX_LENGTH, MOST_DOCUMENTS, MOST_TAGS = 2, 8, 3, 15
# Words in capitals that are no acronyms.
IGNORED = (
    "THE", "AND", "FOR", "NOT", "BUT", "ALL", "ARE", "CAN", "HAS", "HER", "WAS", "ONE", "OUR", "OUT", "YOU", "USE", "MAY", "SHALL", "MUST", "WILL", "WITH", "THIS", "THAT", "FROM", "THEY", "BEEN", "HAVE", "EACH", "MAKE",
    "WHEN", "DOES", "INTO", "THEM", "THEN", "THAN", "ONLY", "OVER", "SUCH", "ALSO", "SOME", "THESE", "OTHER", "WHICH", "THEIR", "THERE", "WOULD", "ABOUT", "AFTER", "COULD", "WHERE", "SHOULD", "THOSE",
    "II", "III", "IV", "VI", "VII", "VIII", "IX", "XI", "XII", "PAGE", "DATE", "DRAFT", "FINAL", "NOTE", "TABLE", "FIGURE", "REV", "VER", "NA", "TBD", "TODO", "YES", "NO",
)
_DEFINED = r"([A-Za-z\s\-]+?)\s*\(([A-Z][A-Z\-/]{1,9})\)"


def acronym_hits(parts: DataFrame, keys: Sequence[str] = ("doc_id", "location"), text: str = "text") -> DataFrame:
    """(keys..., acronym, definition): one row for each run of capitals, and one for each acronym in parentheses.

    Hyphens and slashes at the ends, ignored words, digits and runs that are too short are dropped. A definition is
    the run of letters before the parenthesis; it is kept if it is longer than the acronym.
    """
    plain = parts.select(*keys, F.explode(F.regexp_extract_all(F.col(text), F.lit(rf"{WORD_START}[A-Z]{{{MIN_LENGTH},{MAX_LENGTH}}}{WORD_END}"), F.lit(0))).alias("acronym"), F.lit(None).cast("string").alias("definition"))
    said, short = (F.regexp_extract_all(F.col(text), F.lit(_DEFINED), F.lit(k)) for k in (1, 2))
    likely = parts.where(F.col(text).rlike(r"\([A-Z][A-Z\-/]{1,9}\)"))  # the longer pattern looks back from every place
    defined = likely.select(*keys, F.explode(F.arrays_zip(said.alias("d"), short.alias("a"))).alias("z")).select(*keys, F.col("z.a").alias("acronym"), F.trim("z.d").alias("definition"))
    rows = plain.unionByName(defined).withColumn("acronym", F.regexp_replace(F.regexp_replace("acronym", "^-+|-+$", ""), "^/+|/+$", ""))
    kept = rows.where((F.length("acronym") >= MIN_LENGTH) & ~F.col("acronym").isin(list(IGNORED)) & ~F.col("acronym").rlike(r"\d"))
    return kept.withColumn("definition", F.when(F.length("definition") > F.length("acronym"), F.col("definition")))


def per_document(hits: DataFrame, least: int = 1) -> DataFrame:
    """(doc_id, acronym, n, locations, definitions)."""
    rows = hits.groupBy("doc_id", "acronym").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("location")), ", ").alias("locations"), F.array_join(F.array_sort(F.collect_set("definition")), "; ").alias("definitions")
    )
    return rows.where(F.col("n") >= least)


def over_corpus(documents: DataFrame, least: int = 1) -> DataFrame:
    """(acronym, total, documents, defined) from per-document rows."""
    rows = documents.groupBy("acronym").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("documents"), F.bool_or(F.col("definitions") != "").alias("defined"))
    return rows.where(F.col("total") >= least)


def undefined(corpus: DataFrame) -> DataFrame:
    return corpus.where(~F.col("defined")).select("acronym", "total", "documents")


def rare_tags(uses: DataFrame, most_documents: int = MOST_DOCUMENTS, most: int = MOST_TAGS) -> DataFrame:
    """(document, tags): the most frequent acronyms of each document among those of few documents."""
    spread = uses.groupBy("acronym").agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") <= most_documents)
    w = Window.partitionBy("document").orderBy(F.desc("n"), "acronym")
    rows = uses.join(spread.select("acronym"), "acronym").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    return rows.groupBy("document").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "acronym"))), lambda x: x["acronym"]), ", ").alias("tags"))


def glossary(definitions: DataFrame, most: int | None = None) -> DataFrame:
    """(document, glossary): ``A = D`` for the first definition of each acronym (whatever its case), in order.

    All definitions of a document are kept, or the first ``most``.
    """
    first = definitions.groupBy("document", F.lower("acronym").alias("_k")).agg(F.min(F.struct("ord", "acronym", "definition")).alias("_f"))
    lines = F.transform(F.array_sort(F.collect_list("_f")), lambda f: F.concat(f["acronym"], F.lit(" = "), f["definition"]))
    return first.groupBy("document").agg(F.array_join(lines if most is None else F.slice(lines, 1, most), ", ").alias("glossary"))


def collisions(definitions: DataFrame) -> DataFrame:
    """(acronym, definitions): acronyms with more than one definition."""
    return definitions.groupBy("acronym").agg(F.count_distinct("definition").alias("definitions")).where("definitions > 1")
