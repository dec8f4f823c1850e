"""Operators that join others: cleaning, inventories, comparisons, measures, chunk names."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import controls, docdiff, inventory, mapping, measures, order, packing, profile, render, rewrite, validation
from paperloom.operators.headings import section_extents
from paperloom.sources.text import text_tables

KIND = "doc_id bigint, seq int, location string, text string, rejected string, style string, level int, fake boolean, header array<string>, runs array<struct<text:string,italic:boolean>>"


def test_cleaning_in_its_fixed_order(spark):
    rows = [
        (1, 0, "body", "Contents", "Contents", "TOC 1", None, False, None, None), (1, 1, "body", "1.0 Glossary", "old", "Normal", None, True, None, None), (1, 2, "body", "a term", "a term", "Normal", None, False, None, None),
        (1, 3, "body", "Rules", "Rules", "PolicyHead1", None, False, None, None), (1, 4, "body", "do it as agreed now", "x", "Normal", None, False, None, [("do", True)]), (1, 5, "header1", "head", "head", "Normal", None, False, None, None),
        (1, 6, "body", "Page 3 of 4", "Page 3 of 4", "Normal", None, False, None, None), (1, 7, "body", None, None, "Normal", None, False, ["Version", "Date", "Author"], None), (1, 8, "comments", "note", "note", "Normal", None, False, None, None),
    ]
    kept, log = rewrite.clean(spark.createDataFrame(rows, KIND), ["as agreed"], {"PolicyHead1": "Heading 1"}, contains=["glossary"])
    assert [(r["seq"], r["text"], r["style"], r["level"]) for r in kept.orderBy("seq").collect()] == [(3, "Rules", "Heading 1", 1), (4, "do it now", "Normal", None)]
    assert kept.where("seq = 4").first()["runs"][0]["italic"] is False
    steps = {r["step"]: (r["removed"], r["changed"]) for r in log.collect()}
    assert steps["table_of_contents"] == (1, 0) and steps["sections"] == (2, 0) and steps["headers_footers"] == (1, 0) and steps["page_numbers"] == (1, 0) and steps["revision_tables"] == (1, 0) and steps["comments"] == (1, 0)
    assert steps["phrases"] == (0, 1) and steps["italics"] == (0, 1) and steps["tracked_changes"][1] == 2
    with pytest.raises(ValueError, match="no such steps"):
        rewrite.clean(spark.createDataFrame(rows, KIND), steps=["other"])
    assert rewrite.clean(spark.createDataFrame([], KIND))[0].count() == 0


def test_tables_and_types_of_texts(spark):
    text = "Purpose\n" + "\n".join("nist\tcontrol id\tstatus" if k == 0 else f"a{k}\tbb\tccc" for k in range(40)) + "\nbetween\nx\ty"
    docs = spark.createDataFrame([(1, "a.docx", text), (2, "b.docx", "only prose"), (3, "c.docx", None)], "doc_id bigint, filename string, text string")
    tables = profile.table_profile(text_tables(docs))
    got = {r["table_idx"]: (r["rows"], r["columns"], r["table_class"], r["merged"]) for r in tables.collect()}
    assert got == {0: (40, 3, "control_matrix", False), 1: (1, 2, "unclassified", False)}
    stats = profile.table_stats(tables)
    assert stats.first()["classes"] == {"control_matrix": 1, "unclassified": 1}
    lines = docs.where("text is not null").select("doc_id", "filename", F.posexplode(F.split("text", "\n")).alias("seq", "text")).withColumns({"style": F.lit("Normal"), "level": F.lit(None).cast("int"), "fake": F.lit(False)})
    types = {r["doc_id"]: r["doc_type"] for r in profile.document_types(section_extents(lines), docs, stats).collect()}
    assert types == {1: "A", 2: "B"}
    whole = inventory.inventory(lines, docs, tables, ("nist",), errors=spark.createDataFrame([("bad.docx", "BadZipFile")], "filename string, error string"))
    rows = {r["filename"]: r for r in whole.collect()}
    assert rows["bad.docx"]["doc_type"] == "Error" and rows["bad.docx"]["priority_rank"] is None and rows["a.docx"]["term_nist"] == 1 and rows["a.docx"]["table_dense"]
    labels = {r["label"]: r["value"] for r in inventory.corpus_summary(whole).collect()}
    assert labels["documents"] == 3 and labels["type A"] == 1 and labels["type Error"] == 1 and labels["total tables"] == 2
    assert text_tables(docs.where("false")).count() == 0


def test_references_get_their_fixed_labels(spark):
    rows = spark.createDataFrame([(1, 0, "See Section 4.1a, refer to the plan; as specified in section 3", "f"), (1, 1, None, "f")], "doc_id bigint, seq int, text string, filename string")
    assert [(r["cross_ref_text"], r["pattern_matched"]) for r in inventory.marks(rows).collect()] == [("See Section 4.1a", "See section reference"), ("refer to the", "Refer to clause/section"), ("as specified in section", "As specified in reference")]


def test_running_totals_in_order(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(9)) for k in range(500)]
    got = {r["k"]: r["s"] for r in order.running(spark.createDataFrame(rows, "k int, v int").repartition(7), [F.desc("k")], F.col("v"), "s").collect()}
    total = 0
    for k, v in reversed(rows):
        total += v
        assert got[k] == total
    assert order.numbered(spark.createDataFrame([], "k int"), [F.col("k")], "n").count() == 0


def test_signals_of_packages(spark):
    kind = "pair string, field string, value string"
    a = spark.createDataFrame([("p", "core.revision", "10"), ("p", "app.Words", "5"), ("p", "core.lastModifiedBy", "x"), ("p", "core.modified", "2024-01-02")], kind)
    b = spark.createDataFrame([("p", "core.revision", "9"), ("p", "app.Words", "5"), ("p", "core.lastModifiedBy", "y"), ("p", "app.Pages", "2")], kind)
    got = {r["signal"]: r["side"] for r in docdiff.signals(a, b).collect()}
    assert len(got) == 15 and got["core.revision"] == "1" and got["app.Words"] == "tie" and got["app.Pages"] == "2" and got["core.modified"] == "1"
    assert got["core.lastModifiedBy"] == "n/a" and got["app.AppVersion"] == "missing" and got["archive SHA-256"] == "n/a" and got["core.created"] == "missing"
    assert docdiff.tally(docdiff.signals(a, b)).first().asDict() == {"pair": "p", "first": 2, "second": 1, "tie": 1, "undecided": 11}


def test_comparison_of_two_sets(spark):
    pairs = spark.createDataFrame([("a", "a2", "fuzzy"), ("b", "b", "exact"), ("c", None, "orphan"), ("d", "d", "exact"), ("e", "e", "exact")], "name1 string, name2 string, how string")
    texts = "name string, location string, index bigint, text string"
    first = spark.createDataFrame([("a", "body", 0, "one"), ("b", "body", 0, "same"), ("d", "body", 0, "x"), ("e", "body", 0, "x")], texts)
    second = spark.createDataFrame([("a2", "body", 0, "new"), ("a2", "body", 1, "one"), ("b", "body", 0, "same"), ("d", "body", 0, "x"), ("e", "body", 0, "x")], texts)
    props = [spark.createDataFrame([("d", "core.revision", v), ("e", "core.revision", "1")], "name string, field string, value string") for v in ("1", "2")]
    found = docdiff.compare_sets(pairs, first, second, tuple(props), spark.createDataFrame([("b",)], "name string"))
    assert {r["name1"]: r["status"] for r in found["pairs"].collect()} == {"a": "CHANGED", "b": "ERROR", "c": "ORPHAN", "d": "METADATA ONLY", "e": "IDENTICAL"}
    row = found["texts"].first()
    assert (row["kind"], row["text1"], row["text2"], [tuple(o) for o in row["inline_ops"]]) == ("added", "", "new", [("insert", "new")])


def test_months_without_rows_count(spark):
    rows = spark.createDataFrame([("2024-01-05",), ("2024-01-09",), ("2024-03-01",), (None,)], "d string")
    assert [tuple(r)[1:] for r in measures.month_over_month(rows, "d").orderBy("month").collect()] == [(2, None, None, None), (0, 2, -2, -1.0), (1, 0, 1, None)]
    assert measures.month_over_month(rows.where("false"), "d").count() == 0


def test_names_titles_and_scopes_of_chunks(spark):
    chunks = spark.createDataFrame([(1, 0, "Policy A.docx", "Scope: all", "t0"), (1, 1, "Policy A.docx", "", "t1")], "doc_id bigint, chunk_index bigint, filename string, heading string, text string")
    named = [(r["chunk_id"], r["file"]) for r in packing.chunk_names(chunks, "filename", "heading").orderBy("chunk_index").collect()]
    assert named == [("Policy A_001", "001_Scope all.md"), ("Policy A_002", "002_Policy A.md")]
    scope = spark.createDataFrame([(1, "for all")], "doc_id bigint, scope string")
    assert [r["text"] for r in packing.cloned_scope(chunks, scope).orderBy("chunk_index").collect()] == ["t0", "for all\n\nt1"]
    blocks = spark.createDataFrame([("---\ntitle: old\nk: v\n---\n",), ("---\nk: v\n---\n",)], "b string")
    assert [r["x"] for r in blocks.select(packing.patched_title(F.col("b"), F.lit("a $1 b")).alias("x")).collect()] == ["---\ntitle: a $1 b\nk: v\n---\n", "---\ntitle: a $1 b\nk: v\n---\n"]
    parts = spark.createDataFrame([(1, 0, "Scope", 1), (1, 1, "of all", None), (1, 2, "Rules", 1), (1, 3, "do", None)], "doc_id bigint, seq int, text string, level int")
    assert [r["text"] for r in packing.clone_scope(parts, ["scope"]).orderBy("seq").collect()] == ["Scope", "of all", "Rules", "do"]
    assert packing.split_at_h1(packing.clone_scope(parts, ["scope"])).first()["heading"] == "Rules"


def test_bodies_lists_and_status(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    body = lambda t, i: one(controls.strip_prefix(F.lit(t), F.lit(i)))
    assert body("MON02.001 SIEM Log Ingestion and Correlation (L, M, H)", "MON02.001") == "" and body("AC-1.001 (L) the org shall", "AC-1.001") == "the org shall" and body("none", "AC-1.001") == "none"
    level, ordered = render.list_kind(F.lit("List Number 2"), F.lit(None).cast("int"))
    assert (one(level), one(ordered)) == (1, True)
    have, seen = spark.createDataFrame([("AC-1", "p")], "control_id string, parent string"), spark.createDataFrame([], "control_id string, file string, file_parent string")
    assert validation.status_of(have, seen, split=False).first()["status"] == "N/A" and validation.status_of(have, seen).first()["status"] == "MISSING"
    runs = F.array(F.struct(F.lit("a").alias("text"), F.lit(True).alias("bold")))
    from paperloom.operators import headings

    assert one(headings.all_bold(runs, F.lit(None).cast("boolean"))) is True and one(headings.all_bold(F.array().cast("array<struct<text:string,bold:boolean>>"), F.lit(False))) is False
    assert mapping.stale_results(spark.createDataFrame([("b1.md",)], "name string"), spark.createDataFrame([("b1_result.json",), ("old_result.json",)], "name string")).first()["name"] == "old_result.json"
