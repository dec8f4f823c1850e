"""Every core query against its SQL on the smallest tables."""

import difflib
import os

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from paperloom.functions.text import pairing_key
from paperloom.operators import docdiff
from paperloom.plans.oracle import SQL
from paperloom.plans.queries import QUERIES
from paperloom.plans.structure import elements


def _chunks(spark, small):
    """Chunks by a plain walk over the lines of every document."""
    lines = {}
    for r in elements(spark, small).collect():
        lines.setdefault(r["doc_id"], []).append((r["seq"], r["text"], r["level"]))
    for doc, parts in lines.items():
        out, held, heading = [], [], ""

        def emit(texts):
            own = "\n".join(texts).strip()  # noqa: B023
            tail = out[-1][1].split() if out else []  # noqa: B023
            if own:
                out.append((heading, (" ".join(tail[-30:]) + "\n\n" if len(tail) > 30 else "") + own))  # noqa: B023

        for _, text, level in sorted(parts):
            if level:
                emit(held)
                held, heading = [], text
            elif text.strip():
                held.append(text)
                while len("\n".join(held).strip()) > 1_500:
                    fits = [k for k in range(1, len(held)) if len("\n".join(held[:k]).strip()) <= 1_500]
                    emit(held[: max(fits, default=1)])
                    held = held[max(fits, default=1) :]
        emit(held)
        if len(out) > 1 and len(out[-1][1]) < 100:
            out[-2:] = [(out[-2][0], out[-2][1] + "\n\n" + out[-1][1])]
        for k, (h, t) in enumerate(out):
            yield {"doc_id": doc, "chunk_index": k, "total_chunks": len(out), "chunk_id": f"{doc}_{k + 1:03d}", "heading": h, "text": t, "char_count": len(t)}


def _differences(spark, small):
    """Differences of every place by the standard library's matcher over its whole paragraphs."""
    places = {}
    for r in spark.read.parquet(f"{small}/paragraph.parquet").select("package_name", "location", "para_index", "copy_no", "accepted").distinct().collect():
        places.setdefault((r["package_name"], r["location"]), ([], []))[r["copy_no"] - 1].append((r["para_index"], r["accepted"] or ""))
    for (package, location), (a, b) in places.items():
        a, b = sorted(a), sorted(b)
        for op, i1, i2, j1, j2 in difflib.SequenceMatcher(None, [t for _, t in a], [t for _, t in b], autojunk=False).get_opcodes():
            for k in range(0 if op == "equal" else max(i2 - i1, j2 - j1)):
                x, y = (a[i1 + k] if i1 + k < i2 else None), (b[j1 + k] if j1 + k < j2 else None)
                if x and y:
                    kind, ops = ("changed" if difflib.SequenceMatcher(None, x[1], y[1], autojunk=False).ratio() >= 0.6 else "replaced"), [Row(**o) for o in docdiff.word_ops(x[1], y[1])]
                else:
                    kind, ops = ("removed", [Row(op="delete", text=x[1])]) if x else ("added", [Row(op="insert", text=y[1])])
                yield {"package_name": package, "location": location, "index1": x and x[0], "index2": y and y[0], "kind": kind, "text1": x[1] if x else "", "text2": y[1] if y else "", "inline_ops": ops}


def _pairs(spark, small):
    """Pairs of names by equality, normalised names, then the most alike first, over all names that are left."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "filename", pairing_key(F.col("filename")).alias("k")).collect()
    key = {r["filename"]: r["k"] for r in docs}
    left, right = ({r["filename"] for r in docs if r["doc_id"] % 2 == side} for side in (0, 1))
    out = []

    def take(x, y, how):
        left.discard(x)
        right.discard(y)
        out.append({"name1": x, "name2": y, "how": how})

    for x in sorted(left):
        same = sorted(y for y in right if y.lower() == x.lower())
        if same:
            take(x, same[0], "exact")
    for k in {key[x] for x in left}:
        for x, y in list(zip(sorted(n for n in left if key[n] == k), sorted(n for n in right if key[n] == k), strict=False)):
            take(x, y, "normalised")
    scored = sorted((-s, x, y) for x in left for y in right if (s := difflib.SequenceMatcher(None, key[x], key[y]).ratio()) > 0.9)
    for _, x, y in scored:
        if x in left and y in right:
            take(x, y, "fuzzy")
    return [*out, *[{"name1": x, "name2": None, "how": "orphan"} for x in left], *[{"name1": None, "name2": y, "how": "orphan"} for y in right]]


#: What queries without SQL are held against.
PLAIN = {"b7_chunks": _chunks, "d2_paragraph_diff": _differences, "j16_paired_files": _pairs}


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(_plain(r[c]) for c in columns)) for r in df.collect())
    if name not in SQL:
        assert got == sorted(repr(tuple(r[c] for c in columns)) for r in PLAIN[name](spark, small))
        return
    with duckdb.connect() as c:
        for file in os.listdir(small):
            c.execute(f"create view {file.removesuffix('.parquet')} as select * from '{small}/{file}'")
        result = c.execute(SQL[name])
        names = [d[0] for d in result.description]
        rows = result.fetchall()
    assert sorted(names) == columns
    want = sorted(repr(tuple(_plain(r[names.index(c)]) for c in columns)) for r in rows)
    assert got == want


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["doc_id", "filename", "score_100", "priority_rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
