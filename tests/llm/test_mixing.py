"""Shares of a mix: targets, caps, reports, determinism."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.llm import mixing as M
from paperloom.llm import queries
from paperloom.session import table


def test_water_filling():
    sizes, shares = {"a": 100, "b": 100, "c": 10}, {"a": 0.4, "b": 0.3, "c": 0.3, "d": 0.0}
    take = M.water_fill(sizes, shares, {"a": 1, "b": 5, "c": 2, "d": 3})
    assert take["c"] == 20 and take["a"] == 100 and take["b"] == pytest.approx(90) and take["d"] == 0
    assert M.water_fill(sizes, shares, {"a": 1, "b": 1, "c": 1}, 10_000) == {"a": 100, "b": 100, "c": 10, "d": 0}
    assert M.water_fill({}, shares, {}) == {"a": 0, "b": 0, "c": 0, "d": 0}
    free = M.water_fill({"a": 1_000, "b": 1_000}, {"a": 0.75, "b": 0.25}, {"a": 9, "b": 9})
    assert free == {"a": 1_500, "b": 500}


def rows(n=4_000):
    rng = random.Random(1)
    return [(k, rng.choice(["Alpha", " alpha ", "be-ta", "BE_TA", "gamma"] if k % 3 else ["Alpha"]), rng.randrange(1, 50), "x") for k in range(n)]


def test_shares_and_repeats(spark):
    counted = spark.createDataFrame([*rows(), (10_000, None, 5, "x"), (10_001, "other", 5, "x"), (10_002, "alpha", 0, "x")], "doc_id bigint, source string, n_tokens bigint, place string")
    target = spark.createDataFrame([("alpha", 0.5, 2), ("be_ta", 0.3, 3), ("gamma", 0.15, 1), ("absent", 0.05, 4), ("alpha", 0.9, 9)], "source string, target_share double, max_repeats int")
    records, shares = M.mix(counted, target)
    got = {r["source"]: r for r in shares.collect()}
    assert set(got) == {"alpha", "be_ta", "gamma", "absent"} and got["absent"]["taken_tokens"] == 0
    taken = [tuple(r) for r in records.collect()]
    assert len({t[0] for t in taken}) == len(taken) and not {10_000, 10_001, 10_002} & {t[0] for t in taken}
    caps = {"alpha": 2, "be_ta": 3, "gamma": 1}
    assert all(1 <= t[3] <= caps[t[1]] for t in taken)
    total = sum(t[2] * t[3] for t in taken)
    for s in caps:
        assert got[s]["taken_tokens"] == sum(t[2] * t[3] for t in taken if t[1] == s)
        assert got[s]["reached_share"] == pytest.approx(got[s]["taken_tokens"] / total)
    sizes = {s: got[s]["available_tokens"] for s in caps}
    want = M.water_fill(sizes, {"alpha": 0.5, "be_ta": 0.3, "gamma": 0.15, "absent": 0.05}, {**caps, "absent": 4})
    assert all(0 <= want[s] - got[s]["taken_tokens"] < 200 for s in caps)
    again = [tuple(r) for r in M.mix(counted.repartition(7), target)[0].collect()]
    assert sorted(again) == sorted(taken)


def test_each_source_is_filled_up_to_one_record(spark):
    counted = spark.createDataFrame(rows(), "doc_id bigint, source string, n_tokens bigint, place string")
    target = spark.createDataFrame([("alpha", 0.5, 2), ("be_ta", 0.3, 3), ("gamma", 0.2, 2)], "source string, target_share double, max_repeats int")
    records, shares = M.mix(counted, target, seed=11, total=90_000)
    taken = {r["doc_id"]: r["repeats"] for r in records.collect()}
    sizes = {r["source"]: r["available_tokens"] for r in shares.collect()}
    want = M.water_fill(sizes, {"alpha": 0.5, "be_ta": 0.3, "gamma": 0.2}, {"alpha": 2, "be_ta": 3, "gamma": 2}, 90_000)
    placed = counted.select("doc_id", M.source_name(F.col("source")).alias("source"), "n_tokens", M.place_of(11, F.col("doc_id")).alias("place")).collect()
    for source, n in sizes.items():
        whole, rest = int(want[source] // n), want[source] - int(want[source] // n) * n
        for r in sorted((r for r in placed if r["source"] == source), key=lambda r: r["place"]):
            rest -= r["n_tokens"]
            assert taken.get(r["doc_id"], 0) == whole + (rest >= 0), source
            if rest < 0:
                rest = float("-inf")


def test_shares_of_the_tables_equal_a_plain_sum(spark, small):
    tokens = {r["doc_id"]: len(r["ids"]) for r in queries.p7_ids(spark, small).collect()}
    source = {r["doc_id"]: r["s"] for r in table(spark, small, "documents").select("doc_id", M.source_name(F.col("source")).alias("s")).collect()}
    aims = {r["source"]: r for r in table(spark, small, "mix_target").collect()}
    mixed = queries.p8_mix(spark, small).collect()
    held, sizes = dict.fromkeys(aims, 0), dict.fromkeys(aims, 0)
    for doc, n in tokens.items():
        if source[doc] in sizes:
            sizes[source[doc]] += n
    for r in mixed:
        assert r["source"] == source[r["doc_id"]] and r["n_tokens"] == tokens[r["doc_id"]] and 1 <= r["repeats"] <= aims[r["source"]]["max_repeats"]
        held[r["source"]] += r["n_tokens"] * r["repeats"]
    got = {r["source"]: r for r in queries.p8_shares(spark, small).collect()}
    want = M.water_fill(sizes, {k: a["target_share"] for k, a in aims.items()}, {k: a["max_repeats"] for k, a in aims.items()})
    assert set(got) == set(aims)
    for k, r in got.items():
        assert (r["available_tokens"], r["taken_tokens"]) == (sizes[k], held[k]) and r["reached_share"] == pytest.approx(held[k] / sum(held.values()))
        assert 0 <= want[k] - held[k] < max(tokens.values())


def test_too_many_sources_are_refused(spark):
    counted = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    target = spark.range(M.MAX_SOURCES + 1).selectExpr("cast(id as string) as source", "0.1D as target_share", "1 as max_repeats")
    with pytest.raises(ValueError, match="at most"):
        M.mix(counted, target)


def test_nothing_to_mix(spark):
    counted = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    target = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    records, shares = M.mix(counted, target)
    assert records.count() == 0 and [r["reached_share"] for r in shares.collect()] == [0.0]
    assert M.mix(counted, target.where("false"))[0].count() == 0
