"""Term counts against plain counting, with a hot term and a hot document."""

import random
from collections import Counter, defaultdict

from paperloom.llm import terms as T

KIND = "entry_id bigint, document string, acronym string, occurrences int, term string, records int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", 0) for r in rows], KIND)


def brute(rows):
    uses, docs = defaultdict(set), Counter()
    for _, d, a, n in set(rows):
        v = a.strip(" \t-/" + chr(0xA0)).upper() if a else ""
        if v and d is not None and n and n > 0:
            uses[v].add(d)
            docs[v] += n
    total = len({r[1] for r in rows if r[1] is not None})
    return {v: (docs[v], len(d), "rare" if len(d) <= 2 else "common" if len(d) > total / 5 else "kept") for v, d in uses.items()}


def counts(spark, rows):
    return {r["acronym"]: (r["occurrences"], r["documents"], r["band"]) for r in T.acronym_counts(frame(spark, rows)).collect()}


def test_matches_plain_counting(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for k in range(3_000):
        hot = rng.random()
        word = "HOT" if hot < 0.33 else f"T{rng.randrange(900)}"
        doc = "big" if rng.random() < 0.33 else f"d{rng.randrange(80)}"
        rows.append((k, doc, rng.choice([word, word.lower(), f" {word}", f"-{word}/", f"{word}{chr(0xA0)}"]), rng.choice([1, 2, 5, 0, None])))
    rows += [(9_000, "d1", None, 3), (9_001, "d1", " - ", 3), (9_002, None, "X", 3), (9_003, "d2", "A/B", 1)]
    want = brute(rows)
    for size, held in ((4_096, 512), (16, 2)):
        monkeypatch.setattr(T, "RANGE", size)
        monkeypatch.setattr(T, "HELD", held)
        monkeypatch.setattr(T, "_blocks", T._blocks)
        assert counts(spark, rows + rows[:200]) == want


def test_dictionary_is_dense(spark):
    uses = spark.createDataFrame([(f"t{k}", 1) for k in range(500)] * 2, "term string, occurrences bigint")
    ids = sorted(r["term_id"] for r in T.dictionary(uses).collect())
    assert ids == list(range(500))


def test_no_rows(spark):
    assert counts(spark, [(1, "d", None, None)]) == {}
    assert T.acronym_counts(frame(spark, [(1, "d", "x", 1)]).where("false")).count() == 0
