"""Differences between two copies, against brute force, with skew, nulls and repeats."""

import random

from paperloom.operators import reconcile as R

KIND = "package_name string, location string, para_index bigint, accepted string, rejected string, has_tracked_changes boolean, kh bigint, side int"


def brute(a, b):
    first, second = ({r[:3]: r[3:6] for r in x} for x in (a, b))
    out = set()
    for key in first.keys() | second.keys():
        if key not in second:
            out.add((*key, "row", "only_first"))
        elif key not in first:
            out.add((*key, "row", "only_second"))
        else:
            out |= {(*key, f, "differs") for f, x, y in zip(("accepted", "rejected", "has_tracked_changes"), first[key], second[key], strict=True) if x != y}
    return out


def run(spark, a, b):
    frames = [spark.createDataFrame([(*r, 0, 0) for r in x], KIND) for x in (a, b)]
    found = R.compare_copies(*frames, ["package_name", "location", "para_index"], ["accepted", "rejected", "has_tracked_changes"])
    return sorted(map(tuple, found.collect()), key=repr)


def test_matches_brute_force_with_a_hot_package(spark):
    rng = random.Random(3)
    base = {("hot" if rng.random() < 0.4 else f"p{rng.randrange(60)}", "body", k): (f"text {k}", None if rng.random() < 0.1 else f"old {k}", rng.choice([True, False, None])) for k in range(4_000)}
    other = dict(base)
    for key in rng.sample(sorted(base), 150):
        kind = rng.randrange(5)
        if kind == 0:
            del other[key]
        elif kind == 1:
            other[(key[0], key[1], key[2] + 100_000)] = base[key]
        elif kind == 2:
            other[key] = (None, *base[key][1:])
        elif kind == 3:
            other[key] = (base[key][0], base[key][0], base[key][2])
        else:
            other[key] = (base[key][0], base[key][1], None if base[key][2] else True)
    a, b = ([(*k, *v) for k, v in x.items()] for x in (base, other))
    got = run(spark, a + a[:50], b + b[:50])
    assert got == sorted(brute(a, b), key=repr)


def test_null_keys_null_values_and_empty_sides(spark):
    a = [(None, "body", 1, "x", None, None), ("p", None, 1, None, None, True)]
    b = [(None, "body", 1, "x", "", None), ("p", None, 1, None, None, True)]
    assert run(spark, a, b) == [(None, "body", 1, "rejected", "differs")]
    assert run(spark, a, []) == sorted([(None, "body", 1, "row", "only_first"), ("p", None, 1, "row", "only_first")], key=repr)
    assert run(spark, [], []) == []


def test_swapped_nulls_are_seen(spark):
    assert run(spark, [("p", "b", 1, None, "x", None)], [("p", "b", 1, "x", None, None)]) == [("p", "b", 1, "accepted", "differs"), ("p", "b", 1, "rejected", "differs")]


def test_report(spark):
    kind = "diff_id bigint, package_name string, location string, index1 bigint, index2 bigint, kind string, text1 string, text2 string"
    report = spark.createDataFrame([(1, "p", "b", 1, 1, "changed", "x", "y"), (1, "p", "b", 1, 1, "changed", "x", "y"), (2, "p", "b", None, 9, "added", None, "z"), (3, "p", "b", 2, None, "removed", None, None)], kind)
    first = spark.createDataFrame([("p", "b", 1, "x", None, None, 0, 0), ("p", "b", 2, None, None, None, 0, 0)], KIND)
    second = spark.createDataFrame([("p", "b", 1, "other", None, None, 0, 0)], KIND)
    assert sorted(map(tuple, R.check_report(report, first, second).collect())) == [("p", "b", 1, "text2", "differs"), ("p", "b", 9, "text2", "only_report")]
