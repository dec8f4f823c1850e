"""Every corpus query on the smallest tables, against its SQL where it has one."""

import os

import duckdb
import pytest

from paperloom.llm import neardup
from paperloom.llm.oracle import SQL
from paperloom.llm.queries import QUERIES
from paperloom.session import table


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got and (name == "p4_pieces" or len(set(got)) == len(got))
    if name in SQL:
        with duckdb.connect() as c:
            for file in os.listdir(small):
                c.execute(f"create view {file.removesuffix('.parquet')} as select * from '{small}/{file}'")
            result = c.execute(SQL[name])
            names = [d[0] for d in result.description]
            assert sorted(names) == columns
            assert got == sorted(repr(tuple(r[names.index(k)] for k in columns)) for r in result.fetchall())


def test_pieces_of_all_documents(spark, small):
    """Every piece of every document: own text under the limit and in place, only one separator left out between two, all
    text kept, and the last 30 words of the piece before in front."""
    texts = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect() if r["text"]}
    pieces = {}
    for r in QUERIES["p4_pieces"](spark, small).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc, rows in pieces.items():
        rows.sort(key=lambda r: r["piece_no"])
        assert [r["piece_no"] for r in rows] == list(range(len(rows))) and {r["pieces"] for r in rows} == {len(rows)}
        at, said = 0, ""
        for r in rows:
            own = r["own_text"]
            assert own == texts[doc][r["start"] : r["start"] + r["own_chars"]] and 0 < len(own) <= 1_500
            assert set(texts[doc][at : r["start"]]) <= {"\n", " "} and (r["piece_no"] == 0 or r["start"] - at <= 1 or not texts[doc][at : r["start"]].strip())
            assert r["lead"] == (" ".join(said.split()[-30:]) if r["piece_no"] else "")
            at, said = r["start"] + r["own_chars"], f"{r['lead']} {own}"
        assert not texts[doc][at:].strip()


def test_confidence_says_how_often_a_language_is_right(spark, small):
    """Labels are right for about nine of ten documents; the surer a language is, the more often its label agrees."""
    rows = [r for r in QUERIES["p9_languages"](spark, small).collect() if r["line_no"] == -1 and r["label_lang"]]
    share = lambda part: sum(r["lang"] == r["label_lang"] for r in part) / len(part)
    sure = [r for r in rows if r["confidence"] >= 0.9]
    assert len(sure) > 0.8 * len(rows) and share(sure) > 0.8


def test_near_duplicates_of_the_tables_equal_brute_force(spark, small):
    want = set()
    for field in ("control_description", "supplemental_guidance"):
        sets = {}
        for r in table(spark, small, "control_row").select("row_id", field).distinct().collect():
            w = neardup.words_of(r[field], 8)
            if w:
                w = w.split(" ")
                sets[r["row_id"]] = set(zip(w, w[1:], w[2:], strict=False))
        keys = sorted(sets)
        want |= {(field, a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) - 1e-9}
    got = {tuple(r) for r in QUERIES["p2_found"](spark, small).select("field_name", "row_id_1", "row_id_2").collect()}
    assert got <= want and len(got) >= 0.999 * len(want) and len(want) > 100
