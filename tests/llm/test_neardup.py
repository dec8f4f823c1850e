"""Near-duplicate records against brute force."""

import random

import numpy as np
import pyarrow as pa

from paperloom.llm import groups as G
from paperloom.llm import neardup as N

KIND = "field int, text string, key bigint, digest string, words string, part int"


def run(spark, rows, **how):
    df = spark.createDataFrame([(f, t, k, "extra", "extra", 1) for f, t, k in rows], KIND)
    return sorted(map(tuple, N.similar_records(df, **how).distinct().collect()))


def brute(rows, least=8, size=3, threshold=0.6):
    seen = {}
    for f, t, k in rows:
        w = N.words_of(t, least)
        if w:
            words = w.split(" ")
            seen[(f, k)] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    keys = sorted(seen)
    return sorted((f, a, b) for i, (f, a) in enumerate(keys) for g, b in keys[i + 1 :] if f == g and len(seen[(f, a)] & seen[(f, b)]) >= threshold * len(seen[(f, a)] | seen[(f, b)]) - 1e-9)


def corpus(rng, n):
    words = [f"w{k}" for k in range(400)]
    base = [rng.choices(words, k=rng.randrange(9, 80)) for _ in range(max(1, n // 6))]
    rows = []
    for k in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            at = rng.randrange(len(t))
            kind = rng.randrange(3)
            if kind == 0:
                t.insert(at, rng.choice(words))
            elif kind == 1 and len(t) > 8:
                del t[at]
            else:
                t = t[at:] + t[:at]
        rows.append((rng.randrange(2), " ".join(t), k))
    return rows


def test_matches_brute_force(spark):
    rows = corpus(random.Random(5), 500)
    want, got = brute(rows), run(spark, rows)
    assert set(got) <= set(want)
    assert len(got) >= 0.998 * len(want) and len(want) > 300


def test_small_parts_and_blocks_change_nothing(spark):
    rows = corpus(random.Random(6), 200) + [(0, "one stock text that very many of these rows repeat word for word", k) for k in range(1_000, 1_060)]
    rows += [(0, f"one stock text that very many of these rows repeat word for word and {k}", k) for k in range(2_000, 2_020)]
    want = brute(rows)
    for how in ({"part_bytes": 4_000}, {"copies": 7}, {"part_bytes": 700, "copies": 25}):
        got = run(spark, rows, **how)
        assert set(got) <= set(want) and len(got) >= 0.99 * len(want), how


def payload(texts, ids):
    symbols = N._symbols(*N._sequences(texts, 3))
    return N._packed(np.array(ids), N._planes(symbols), np.stack((N._variants(symbols, 0)[2:] >> np.uint64(40)).astype(np.uint32), axis=1))


def test_texts_that_share_an_id_are_all_kept():
    base = " ".join(f"a{k}" for k in range(60))
    other = " ".join(f"b{k}" for k in range(60))
    texts = [base, other, base + " more", other + " more", other]  # the first two share an id, the last is a copy
    met = {tuple(sorted(p)) for block in N._meetings([payload(texts, [7, 7, 8, 9, 7])]) for p in block.tolist()}
    assert met == {(7, 8), (7, 9)}
    near = {tuple(sorted(p)) for block in N._meetings([payload([base, base + " more"], [7, 7])]) for p in block.tolist()}
    assert near == {(7, 7)}
    sides = {tuple(sorted(p)) for block in N._meetings([payload([base, base + " more"], [1, 2]), payload([base + " less"], [3])], [0, 1]) for p in block.tolist()}
    assert sides == {(1, 3), (2, 3)}


def test_parts_of_an_oversized_bucket_are_cut():
    texts = [f"{' '.join(f'a{k}' for k in range(60))} {n}" for n in range(6)]
    rows = [payload([t], [n]) for n, t in enumerate(texts)]
    batch = N._rows([5] * 6, rows)
    whole = [b.to_pylist() for b in N._candidates(24, 1_000)(iter([batch]))]
    pieces = [r for b in N._candidates(24, 2 * N.ENTRY)(iter([batch])) for r in b.to_pylist()]
    assert {r["kind"] for r in pieces} == {N.PIECE} and {(r["field"], r["a"]) for r in pieces} == {(5, 0), (5, 1), (5, 2)}
    units = [(5, min(r["a"], o), max(r["a"], o), r["a"], r["digest"]) for r in pieces for o in range(3)]
    units.sort(key=lambda u: u[:3])
    table = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*units, strict=True)], names=["part", "low", "high", "block", "payload"])
    cut = {(r["a"], r["b"]) for b in N._met_blocks(24)(iter([table])) for r in b.to_pylist()}
    assert cut == {(r["a"], r["b"]) for b in whole for r in b} and len(cut) > 5


def test_copies_of_a_hot_text_use_several_tasks(spark):
    members = spark.range(50_000).selectExpr("0 as field", "id as key", "id as id", "if(id % 10 < 9, 'hot', cast(id as string)) as digest").selectExpr("field", "key", "id", "cast(digest as binary) as digest")
    hot, most = N.hot_texts(members, 50_000)
    assert most == N.COPIES and hot.count() == 1
    blocks = N.in_blocks(members, hot).where("digest = cast('hot' as binary)").groupBy("block").count().collect()
    assert len(blocks) == 23 and max(r["count"] for r in blocks) < 1.2 * N.COPIES
    assert N.hot_texts(members, 10**12)[0].count() == 0  # no more than MOST_HOT texts are ever broadcast


def test_hot_copies_nulls_short_and_long_texts(spark):
    hot = "one text that a third of all rows repeat word for word in this table"
    rows = [(0, hot, k) for k in range(30)] + [(0, hot.upper() + "!", 100), (0, None, 101), (0, "", 102), (0, "too few words here", 103), (1, hot, 104)]
    long = " ".join(f"x{k}" for k in range(20_000))
    rows += [(1, long, 105), (1, long + " end", 106), (1, "ｏne text thаt a third of all rows repeat word for word in this table", 107)]
    assert run(spark, rows) == brute(rows)


def test_groups(spark):
    rows = [*corpus(random.Random(11), 150), (0, "lonely words that no other row has anywhere in this table", 900)]
    links = brute(rows)
    root, degree = {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for f, a, b in links:
        degree[(f, a)] = degree.get((f, a), 0) + 1
        degree[(f, b)] = degree.get((f, b), 0) + 1
        x, y = find((f, a)), find((f, b))
        root[max(x, y)] = min(x, y)
    want = sorted((f, k, find((f, k))[1], n) for (f, k), n in degree.items())
    df = spark.createDataFrame([(f, t, k) for f, t, k in rows], "field int, text string, key bigint")
    assert sorted(map(tuple, N.similar_groups(df).collect())) == want
    assert N.similar_groups(df.where("false")).count() == 0


def test_long_chain_is_one_group(spark):
    links = spark.createDataFrame([(0, k, k + 1) for k in range(300)], "f int, a bigint, b bigint")
    got = G.components(links, "f", "a", "b").collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


def test_threshold_is_inclusive(spark):
    a = " ".join(f"a{k}" for k in range(10))
    b = " ".join([*(f"a{k}" for k in range(8)), "z1", "z2"])
    rows = [(0, a, 1), (0, b, 2)]
    assert brute(rows) == [(0, 1, 2)] and run(spark, rows) == [(0, 1, 2)]


def test_empty_table(spark):
    df = spark.createDataFrame([], KIND)
    assert N.similar_records(df).count() == 0
