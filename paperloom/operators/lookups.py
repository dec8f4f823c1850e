"""Ordered lookups: the first entry of a table that matches a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import either_contains

#: Lengths of the pieces by which a text is found in a longer one: the longest that fits.
PIECES = (8, 4, 2, 1)

Match = Callable[[Column, Column], Column]


def _pieces(text: Column) -> Column:
    """All pieces of a text, each once."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda k: F.substr(text, k, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[of(n) for n in PIECES])))


def _piece(text: Column) -> Column:
    """One piece of the longest length that fits, the least by its hash; null for an empty text."""
    of = lambda n: F.array_min(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda k: F.struct(F.xxhash64(F.substr(text, k, F.lit(n))).alias("h"), F.substr(text, k, F.lit(n)).alias("p"))))["p"]
    return F.coalesce(*[F.when(F.length(text) >= n, of(n)) for n in PIECES])


def _candidates(texts: DataFrame, keys: DataFrame, both_ways: bool) -> DataFrame:
    """(_t, _k): pairs of texts and keys of which the key may lie in the text or, ``both_ways``, the text in the key.

    What lies in a longer text has all its pieces there: the inner one is found by one piece, the outer one by all.
    """
    found = texts.select("_t", F.explode(_pieces(F.col("_t"))).alias("_p")).join(keys.select("_k", _piece(F.col("_k")).alias("_p")), "_p").select("_t", "_k")
    if both_ways:
        found = found.unionByName(keys.select("_k", F.explode(_pieces(F.col("_k"))).alias("_p")).join(texts.select("_t", _piece(F.col("_t")).alias("_p")), "_p").select("_t", "_k"))
    return found.distinct()


def lookup_all(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, order: str, match: Match = either_contains, out: str = "found") -> DataFrame:
    """Add ``out``: the values of all matching entries, in the table's order; an empty array for none.

    ``match`` is ``either_contains`` or ``contains_key``. Null and empty texts and keys match nothing. Every distinct text
    is looked up once, by equality of pieces, so neither table is collected or compared as a whole.
    """
    texts = rows.select(F.col(column).alias("_t")).where(F.length("_t") > 0).distinct()
    entries = table.select(F.col(order).alias("_o"), F.col(key).alias("_k"), F.col(value).alias("_v")).where(F.length("_k") > 0)
    near = _candidates(texts, entries.select("_k").distinct(), match is either_contains).where(match(F.col("_t"), F.col("_k")))
    lists = near.join(entries, "_k").groupBy("_t").agg(F.array_sort(F.collect_list(F.struct("_o", "_k", "_v"))).alias("_l"))
    lists = lists.select("_t", F.transform("_l", lambda e: e["_v"]).alias(out))
    none = F.array().cast(f"array<{dict(table.dtypes)[value]}>")
    return rows.join(lists, rows[column] == lists["_t"], "left").drop("_t").withColumn(out, F.coalesce(out, none))


def lookup_first(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, order: str, match: Match = either_contains, out: str = "found") -> DataFrame:
    """Add ``out``: the value of the first matching entry in the table's order, null without one."""
    return lookup_all(rows, column, table, key, value, order, match, "_list").withColumn(out, F.try_element_at("_list", F.lit(1))).drop("_list")


def tags_of(rows: DataFrame, name: str, table: DataFrame, key: str, tags: str, order: str, fixed: Column, out: str = "tags") -> DataFrame:
    """Add ``out``: the tags of the entry whose key equals the name, else the name with underscores as blanks, else the
    first whose key contains the name or lies in it, whatever the case; then ``fixed`` ones, each once."""
    from paperloom.operators.render import merge_tags

    entries = table.select(F.col(order).alias("_to"), F.lower(key).alias("_tk"), F.col(tags).alias("_tt"))
    first = entries.groupBy("_tk").agg(F.min_by("_tt", "_to").alias("_tt"))
    low = F.lower(F.col(name))
    found = rows.withColumns({"_n1": low, "_n2": F.replace(low, F.lit("_"), F.lit(" "))})
    for k in (1, 2):
        found = found.join(first.select(F.col("_tk").alias(f"_k{k}"), F.col("_tt").alias(f"_t{k}")), F.col(f"_n{k}") == F.col(f"_k{k}"), "left").drop(f"_k{k}")
    found = lookup_first(found, "_n1", entries, "_tk", "_tt", "_to", either_contains, "_t3")
    return found.withColumn(out, merge_tags(best_of(F.col("_t1"), F.col("_t2"), F.col("_t3")), fixed)).drop("_n1", "_n2", "_t1", "_t2", "_t3")


def list_values(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, order: str, label: str | None = None, out: str = "found") -> DataFrame:
    """Add ``out``: the values of all matching entries without those that say ``_ERROR``, as ``label = value`` if a column
    for the label is given."""
    kept = table.where(~F.contains(F.coalesce(F.col(value).cast("string"), F.lit("")), F.lit("_ERROR")))
    said = kept.withColumn("_said", F.concat_ws(" = ", F.col(label), F.col(value)) if label else F.col(value))
    return lookup_all(rows, column, said, key, "_said", order, either_contains, out)


def with_fallbacks(found: Column, template: str | None, name: Column, missing: str = "(URL not configured)") -> tuple[Column, Column]:
    """(value, origin): the found value, else the template with the name's blanks as underscores, else ``missing``."""
    filled = F.replace(F.lit(template), F.lit("{filename}"), F.replace(name, F.lit(" "), F.lit("_"))) if template else F.lit(None).cast("string")
    value = F.coalesce(found, filled, F.lit(missing))
    origin = F.when(found.isNotNull(), "lookup").when(F.lit(bool(template)) & name.isNotNull(), "template").otherwise("missing")
    return value, origin


def contains_key(text: Column, key: Column) -> Column:
    """One-way match: the text contains the key."""
    return (F.length(key) > 0) & F.contains(text, key)


def best_of(*ranked: Column) -> Column:
    """The first of several lookups that found something: exact, then spelled with blanks, then by substring."""
    return F.coalesce(*ranked)


def last_by(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys..., value): the value of the last row of each key, in order; later repeats win."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key, in order: a deduplication in which order counts."""
    names = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*names), order).alias("_r")).select(*keys, "_r.*")


def three_way(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., side): whether each key is in the first frame only, in the second only, or in both."""
    marked = first.select(*keys).distinct().withColumn("_a", F.lit(1)).unionByName(second.select(*keys).distinct().withColumn("_a", F.lit(2)))
    seen = marked.groupBy(*keys).agg(F.sum("_a").alias("_s"))
    return seen.select(*keys, F.when(F.col("_s") == 1, "only1").when(F.col("_s") == 2, "only2").otherwise("both").alias("side"))


def upsert_actions(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys..., action): ``append``, ``removed``, ``changed`` or ``same`` for every key of either side."""
    a = old.select(*keys, F.struct(*fields).alias("_o"))
    b = new.select(*keys, F.struct(*fields).alias("_n"))
    action = F.when(F.col("_o").isNull(), "append").when(F.col("_n").isNull(), "removed").when(F.col("_o").eqNullSafe(F.col("_n")), "same").otherwise("changed")
    return a.join(b, keys, "full_outer").select(*keys, action.alias("action"))


def stem(name: Column) -> Column:
    """A file name in lower case without extension and marks of the steps that it went through."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"(?i)(_fixed|_optimized|_backup)$", ""))


def resolved_parents(files: DataFrame, name: str, manifest: DataFrame) -> DataFrame:
    """Add ``parent`` and ``origin``: the parent that the manifest (part, parent) gives a file, whatever the case, else what
    stands before `` - `` in its stem. Of several parents in the manifest the least holds."""
    known = manifest.groupBy(F.lower("part").alias("_part")).agg(F.min(F.lower("parent")).alias("_parent"))
    joined = files.join(known, F.lower(name) == F.col("_part"), "left")
    own = F.split_part(stem(F.col(name)), F.lit(" - "), F.lit(1))
    return joined.withColumns({"parent": F.coalesce("_parent", own), "origin": F.when(F.col("_parent").isNotNull(), "manifest").otherwise("name")}).drop("_part", "_parent")


def by_stem(rows: DataFrame, name: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """Add ``value`` of the table's row whose name has the same stem; of several the least."""
    known = table.groupBy(stem(F.col(key)).alias("_stem")).agg(F.min(value).alias(value))
    return rows.join(known, stem(F.col(name)) == F.col("_stem"), "left").drop("_stem")
