"""Pieces of texts: limits, order, overlap, and the coarsest boundary that suffices."""

import random

import pytest

from paperloom.llm import splitting as S


def texts(n):
    rng = random.Random(4)
    for _ in range(n):
        lines = []
        for _ in range(rng.randrange(1, 12)):
            sentences = [" ".join("x" * rng.randrange(1, rng.choice([4, 9, 40])) for _ in range(rng.randrange(1, 15))) + rng.choice([".", "!", "?", ""]) for _ in range(rng.randrange(0, 6))]
            lines.append(" ".join(sentences))
        heads = {}
        at = 0
        for k, line in enumerate(lines):
            if rng.random() < 0.3:
                heads[at] = rng.choice([1, 2, 3, 4])
            at += len(line) + 1
        yield "\n".join(lines), heads


@pytest.mark.parametrize("limit", [20, 60, 150])
def test_laws(limit):
    for text, heads in texts(120):
        parts, deepest = S.stretches(text, heads, limit)
        pieces = S.pack(parts, limit)
        assert all(0 < b - a <= limit for a, b in pieces)
        assert all(a[1] <= b[0] for a, b in zip(pieces, pieces[1:], strict=False))
        covered = [False] * len(text)
        for a, b in pieces:
            covered[a:b] = [True] * (b - a)
        assert all(c or text[k] in " \n" for k, c in enumerate(covered))
        if len(text) > limit:
            assert S.BOUNDARIES[deepest] == coarsest(text, heads, limit)


def coarsest(text, heads, limit):
    cuts = set()
    for name in S.BOUNDARIES[:-1]:
        if name.startswith("heading"):
            cuts |= {at - 1 for at, level in heads.items() if level <= int(name[-1]) and at}
        else:
            cuts |= {m.start() for m in S._SEPARATORS[name].finditer(text)}
        ends = sorted(cuts) + [len(text)]
        starts = [0, *(e + 1 for e in ends[:-1])]
        if all(e - s <= limit for s, e in zip(starts, ends, strict=True)):
            return name
    return "none"


def test_frames(spark):
    long = "A first sentence. " * 100
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "short", 0), (4, long, 0), (5, "y" * 4_000, 0), (6, "h\n" + "a b " * 300 + "\nh2\n" + "c d " * 300, 0)], "doc_id bigint, text string, lines int")
    heads = spark.createDataFrame([(6, 0, None, "x")] * 2 + [(6, 2, None, "x"), (6, 99, 1, "x"), (7, 1, 1, "x"), (6, None, 1, "x")], "doc_id bigint, start_para_index bigint, heading_level int, text string")
    got = S.split_documents(docs, heads).orderBy("doc_id", "piece_no").collect()
    assert [r["doc_id"] for r in got if r["piece_no"] == 0] == [3, 4, 5, 6]
    assert all(r["own_chars"] <= S.LIMIT and len(r["own_text"]) == r["own_chars"] for r in got)
    for a, b in zip(got, got[1:], strict=False):
        if a["doc_id"] == b["doc_id"]:
            assert b["lead"] == " ".join((a["lead"] + " " + a["own_text"]).split()[-30:])
    assert {tuple(r) for r in S.found_boundaries(docs, heads).collect()} == {(4, "sentence"), (5, "none"), (6, "heading_2")}
    assert S.found_boundaries(docs.where("false"), heads.where("false")).count() == 0
