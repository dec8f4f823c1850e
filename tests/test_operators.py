"""Operators on small fixtures with known results."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import acronyms, controls, crossrefs, docdiff, headings, lookups, mapping, measures, packing, profile, render, rewrite, validation
from paperloom.sources.files import coerce, merged, nested, steps
from paperloom.sources.text import text_elements, text_lines


def elements(spark, rows, kind="doc_id bigint, seq int, text string, style string, level int, fake boolean"):
    return spark.createDataFrame(rows, kind)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "level"), [("1.1.1 x", 3), ("1.0 x", 1), ("IV. x", 1), ("1.1 x", 2), ("A. x", 2), ("C. x", 1), ("x", 2)])
def test_numbered_levels(spark, text, level):
    assert one(spark, headings.numbered_level(F.lit(text))) == level


@pytest.mark.parametrize(
    ("text", "identifier", "baseline", "name"),
    [
        ("AC-1.001 (L, M, H) - Access Control Policy", "AC-1.001", "L,M,H", "Access Control Policy"),
        ("MON02.001 SIEM Log Ingestion and Correlation (L, M, H)", "MON02.001", "L,M,H", "SIEM Log Ingestion and Correlation"),
        ("Log Retention Requirements  Control MON02.002  (L,M, H)", "MON02.002", "L,M,H", "Log Retention Requirements"),
        ("AC-1.001 - Name (H)", "AC-1.001", "H", "Name"), ("AC-1.001", "AC-1.001", "", ""), ("nothing", "AC-1.001", "", ""),
    ],
)
def test_baseline_and_name(spark, text, identifier, baseline, name):
    a, b = controls.baseline_and_name(F.lit(text), F.lit(identifier))
    assert (one(spark, a), one(spark, b)) == (baseline, name)


def test_names(spark):
    keys = {one(spark, T.name_key(F.lit(n))) for n in ("POL-AC-2026-001.docx", "POL_AC_2026_001.docx", "POL AC 2026 001.docx")}
    assert keys == {"pol ac 2026 001"}
    assert one(spark, T.pairing_key(F.lit("Policy_v2.docx"))) == one(spark, T.pairing_key(F.lit("Policy - Final.docx"))) == "policy"
    assert one(spark, T.parent_key(F.lit("X_fixed.docx"))) == "x"
    assert one(spark, T.safe_filename(F.lit('a<b>:  "c"?'))) == "ab c"
    assert one(spark, T.clean_quotes(F.lit("“a” – ‘b’…"))) == "\"a\" -- 'b'..."
    assert one(spark, T.truncate_at_sentence(F.lit("One two. Three four five"), 12)) == "One two...."
    assert one(spark, F.lit("NIST_x.xlsx").rlike(T.glob_pattern("nist*.xlsx")))


def test_settings():
    assert [steps(s) for s in ("0", "1-3", "2,4", "0,2-4")] == [[0], [1, 2, 3], [2, 4], [0, 2, 3, 4]]
    assert nested({"a.b": "3", "a.c": "yes"}) == {"a": {"b": 3, "c": True}}
    assert merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 5}}) == {"a": {"b": 5, "c": 2}}
    assert coerce(" 1.5 ") == 1.5


def test_sections_breadcrumbs_and_skips(spark):
    rows = [(1, 0, "intro", "Normal", None, False), (1, 1, "A", "Heading 1", 1, False), (1, 2, "aa", "Normal", None, False), (1, 3, "B", "Heading 3", 3, False), (1, 4, "bb", "Normal", None, False),
            (1, 5, "C", "Heading 1", 1, False), (1, 6, "cc", "Normal", None, False), (2, 0, "only", "Normal", None, False)]
    df = elements(spark, rows)
    got = {(r["doc_id"], r["start_seq"]): (r["end_seq"], r["level"], r["chars"]) for r in headings.section_extents(df).collect()}
    assert got == {(1, 1): (5, 1, 9), (1, 3): (5, 3, 4), (1, 5): (7, 1, 4), (2, 0): (1, 0, 4)}
    crumbs = {(r["doc_id"], r["seq"]): (r["h1"], r["h2"], r["h3"]) for r in headings.breadcrumbs(df).collect()}
    assert crumbs[(1, 4)] == ("A", None, "B") and crumbs[(1, 6)] == ("C", None, None)
    assert [r["skips"] for r in headings.level_skips(df).collect()] == [1]
    assert {r["seq"]: r["parent_heading"] for r in headings.parent_heading(df).where("doc_id = 1").collect()}[3] == "A"


def test_section_deletion_equals_a_walk(spark):
    rng = random.Random(1)
    rows, expect = [], set()
    for doc in range(30):
        gone = 0
        for seq in range(rng.randrange(1, 40)):
            level = rng.choice([None, None, 1, 2, 3])
            text = rng.choice(["Glossary", "Scope", "References"]) if level else "words"
            if level and gone and level <= gone:
                gone = 0
            if level and not gone and text != "Scope":
                gone = level
            rows.append((doc, seq, text, "Normal", level, False))
            if not gone:
                expect.add((doc, seq))
    kept = rewrite.delete_sections(elements(spark, rows), contains=["glossary"], equals=["references"])
    assert {(r["doc_id"], r["seq"]) for r in kept.collect()} == expect


def test_rewrites(spark):
    assert one(spark, rewrite.delete_phrases(F.lit("Keep (this)  DRAFT text"), ["draft", "(this)"])) == "Keep text"
    assert one(spark, rewrite.collapse_blank_lines(F.lit("a  \n\n\n\nb\n \n"))) == "a\n\nb"
    df = spark.createDataFrame([("Page 3 of 9",), ("- 4 -",), ("12",), ("Page three",)], "text string")
    assert [r["text"] for r in rewrite.delete_page_numbers(df).collect()] == ["Page three"]
    assert one(spark, rewrite.is_revision_table(F.array(F.lit("Version"), F.lit("Date"), F.lit("Author"))))
    assert one(spark, rewrite.control_table_kind(F.array(F.lit("Control ID"), F.lit("Text")))) == "control"
    runs = spark.createDataFrame([([("x", True)],)], "runs array<struct<text:string,italic:boolean>>").select(rewrite.drop_italics(F.col("runs")).alias("r")).first()["r"]
    assert runs[0]["italic"] is False
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, owner string")
    assert rewrite.visible_rows(rows, {"owner": ["a"]}).count() == 1 and rewrite.visible_rows(rows, {"owner": ["*"]}).count() == 3
    els = spark.createDataFrame([(1, 0, "paragraph", "Terms and Definitions", 1, None), (1, 1, "table", None, None, 0), (1, 2, "paragraph", "Next", 1, None), (1, 3, "table", None, None, 1)], "doc_id int, seq int, kind string, text string, level int, table_idx int")
    cells = spark.createDataFrame([(1, t, r, c, x) for t in (0, 1) for r, row in enumerate([("Term", "Definition"), ("MFA", "many"), ("", "none")]) for c, x in enumerate(row)], "doc_id int, table_idx int, row_idx int, col_idx int, text string")
    assert [r["text"] for r in rewrite.flatten_definitions(els, cells).collect()] == ["MFA: many"]


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "access policy v2"), (2, "zzz"), (3, None), (4, "")], "k int, name string")
    table = spark.createDataFrame([(0, "policy", "second"), (1, "access policy", "first"), (2, "acc", "third")], "ord int, name string, url string")
    found = {r["k"]: r["found"] for r in lookups.lookup_first(rows, "name", table, "name", "url", "ord").collect()}
    assert found == {1: "second", 2: None, 3: None, 4: None}
    assert {r["k"]: r["found"] for r in lookups.lookup_all(rows, "name", table, "name", "url", "ord").collect()}[1] == ["second", "first", "third"]


def test_acronyms(spark):
    df = spark.createDataFrame([(1, "body", "Multi-Factor Authentication (MFA) and MFA, CUI-X, THE CIO/CTO, A1B")], "doc_id int, location string, text string")
    got = {r["acronym"]: (r["n"], r["definitions"]) for r in acronyms.per_document(acronyms.acronym_hits(df)).collect()}
    assert got["MFA"] == (3, "Multi-Factor Authentication") and got["CUI"][0] == 1 and got["CIO"][0] == 1 and "THE" not in got


def test_glossary_keeps_all_definitions(spark):
    df = spark.range(1_500).select(F.lit("d").alias("document"), F.col("id").alias("ord"), F.concat(F.lit("A"), F.col("id")).alias("acronym"), F.concat(F.lit("term "), F.col("id")).alias("definition"))
    lines = [f"A{k} = term {k}" for k in range(1_500)]
    assert acronyms.glossary(df).first()["glossary"] == ", ".join(lines)
    assert acronyms.glossary(df, 2).first()["glossary"] == ", ".join(lines[:2])


def test_control_blocks(spark):
    lines = ["Intro", "AC-1.001 (L) - First", "body one", "", "CONTROL REQUIREMENTS FOR ALL", "lost", "AC-1.002 and AC-1.003", "tail"]
    df = spark.createDataFrame([(1, k, t) for k, t in enumerate(lines)], "doc int, k int, text string")
    got = [(r["control_id"], r["ids"], r["section_header"], r["body"]) for r in controls.control_blocks(df, ["doc"], "k").orderBy("start").collect()]
    assert got == [("AC-1.001", 1, "", "AC-1.001 (L) - First\nbody one"), ("AC-1.002", 2, "CONTROL REQUIREMENTS FOR ALL", "AC-1.002 and AC-1.003\ntail")]
    a, b, c = controls.split_guidance(F.lit("Do it. Implementation: how. Guidelines: more"))
    assert [one(spark, x) for x in (a, b, c)] == ["Do it.", "how.", "more"]
    dates = elements(spark, [(1, 0, "Compliance Date", None, None, False), (1, 1, "due as of March 3, 2025", None, None, False), (2, 0, "as of May 1, 2024", None, None, False)])
    assert {r[0]: str(r[1]) for r in controls.compliance_dates(dates).collect()} == {1: "2025-03-03", 2: "2024-05-01"}
    cells = spark.createDataFrame([(1, 0, r, c, t) for r, row in enumerate([("Control ID", "Title", "Description"), ("AC-1.001", "T", "D"), ("none", "T", "D")]) for c, t in enumerate(row)], "doc_id int, table_idx int, row_idx int, col_idx int, text string")
    assert [tuple(r)[3:] for r in controls.table_controls(cells).collect()] == [("AC-1.001", "T", "D")]
    bold = spark.createDataFrame([(1, "A")], "doc_id int, control_id string")
    every = spark.createDataFrame([(1, "B"), (2, "C")], "doc_id int, control_id string")
    assert sorted(r["control_id"] for r in controls.bold_or_all(bold, every).collect()) == ["A", "C"]
    counted = controls.counted_ids(F.lit("AC-1.001 then AC-1.002"), F.lit("AC-1.002"), F.lit(False), 25)
    assert one(spark, counted) == ["AC-1.002"]


def test_references(spark):
    df = spark.createDataFrame([(1, 0, "see Section 4.2 and refer to the Access Control Policy, https://a.b/c.")], "doc_id int, seq int, text string")
    got = {(r["reference_type"], r["target"]) for r in crossrefs.references(df, crossrefs.reference_patterns()).collect()}
    assert got == {("internal", "4.2"), ("external", "Access Control Policy")}
    assert one(spark, crossrefs.link_kind(F.lit("Section 4"))) == "internal"
    assert crossrefs.pattern_counts(df).collect()[0]["pattern"] == "refer to section/the" or crossrefs.pattern_counts(df).count() == 2


def test_chunk_laws():
    rng = random.Random(2)
    for _ in range(60):
        parts = [{"text": " ".join(rng.choices(["alpha", "be", "gamma-delta"], k=rng.randrange(0, 60))), "level": rng.choice([None] * 6 + [1]), "kind": rng.choice(["paragraph", "paragraph", "table"])} for _ in range(rng.randrange(0, 60))]
        own = [t for _, t in packing.chunk_parts(parts, 300, 0, 0)]
        body = [p["text"].strip() for p in parts if not p["level"] and p["text"].strip()]
        assert "\n".join(own).split() == "\n".join(body).split()
        assert all(len(t) <= 300 or any(len(b) > 300 and b in t for b in body) for t in own)
        led = packing.chunk_parts(parts, 300, 5, 0)
        for (_, a), (_, b) in zip(led, led[1:], strict=False):
            assert len(a.split()) <= 5 or b.startswith(" ".join(a.split()[-5:]) + "\n\n")
        assert sum(n for _, _, n in packing.h2_parts([p | {"level": p["level"] and 2} for p in parts], 0, 200)) == len(parts)


def test_family_packing():
    families = [("A", [{"id": f"A-{k}", "chars": 10} for k in range(4)]), ("B", [{"id": "B-1", "chars": 10}]), ("C", [{"id": f"C-{k}", "chars": 10} for k in range(9)] + [{"id": "C-8(1)", "chars": 10}])]
    got = [(n, m) for n, m, _ in packing.combine_families(families, 5, 1_000)]
    assert got == [("A+B", 5), ("C", 5), ("C", 5)]  # C-8 and its enhancement stay together
    assert packing.pack_sections([{"heading": h, "chars": c} for h, c in (("a", 5), ("b", 6), ("c", 30), ("d", 1))], 12) == [("b", 11, 2), ("c", 30, 1), ("d", 1, 1)]


def test_known_packings(spark):
    """A published catalog of 207 controls packs into 9 chunks, and 36 controls of 6 domains into 8 batches."""
    sizes = {"A&A": (6, 1349), "AIS": (8, 1753), "BCR": (11, 2553), "CCC": (9, 1996), "CEK": (21, 5132), "DCS": (18, 4483), "DSP": (19, 4490), "GRC": (8, 1779), "HRS": (13, 3579), "IAM": (15, 3265),
             "IPY": (4, 1274), "I&S": (9, 2251), "LOG": (14, 2827), "SEF": (10, 2529), "STA": (16, 3317), "TVM": (12, 2920), "UEM": (14, 2474)}
    rows = [("c", f, k, f"{f}-{n + 1:02d}", chars // count + (n < chars % count)) for k, (f, (count, chars)) in enumerate(sizes.items()) for n in range(count)]
    chunks = packing.family_chunks(spark.createDataFrame(rows, "collection string, family string, ord int, id string, chars int").repartition(5), 30, 7_000)
    want = [("A&A+AIS+BCR", 25), ("CCC", 9), ("CEK", 21), ("DCS", 18), ("DSP+GRC", 27), ("HRS+IAM", 28), ("IPY+I&S+LOG", 27), ("SEF+STA", 26), ("TVM+UEM", 26)]
    assert [(r["families"], r["members"]) for r in chunks.orderBy("chunk_no").collect()] == want
    domains = [(d, 100 * d + k) for d, n in enumerate((4, 1, 21, 2, 7, 1)) for k in range(n)]
    numbers = packing.batches(spark.createDataFrame(domains, "d int, k int").selectExpr("cast(d as string) as d", "k"), "d", "k", 8).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in numbers] == [4, 1, 8, 8, 5, 2, 7, 1]


def test_identifiers(spark):
    rows = [one(spark, packing.base_id(F.lit(x))) for x in ("AC-2", "AC-2(1)", "AC-2(1)(a)", "A&A-01")]
    assert rows == ["AC-2", "AC-2", "AC-2", "A&A-01"]
    df = spark.createDataFrame([(x,) for x in ("AC-10", "AC-2(10)", "AC-2(2)", "AC-2", "AB-1")], "i string")
    assert [r["i"] for r in df.orderBy(packing.natural_key(F.col("i"))).collect()] == ["AB-1", "AC-2", "AC-2(2)", "AC-2(10)", "AC-10"]
    assert [one(spark, mapping.family_code(F.lit(x))) for x in ("AC-2", "CM-6(1)", "IA-2")] == ["AC", "CM", "IA"]


def test_mapping_answers(spark):
    text = '```json\n{"S1": {"matches": [{"target_id": "T1", "confidence": "High", "rationale": "r"}, {"target_id": "T2"}], "unique_to_source": false}, "S2": {"matches": []}}\n```'
    rows = mapping.parse_results(spark.createDataFrame([("a", text), ("b", "no json")], "file string, value string")).collect()
    assert {(r["source_id"], r["target_id"], r["confidence"], r["unique_to_source"]) for r in rows} == {("S1", "T1", "high", False), ("S1", "T2", "low", False), ("S2", None, "low", True)}


@pytest.mark.parametrize(("length", "score"), [(0, 60), (19, 70), (20, 100), (2000, 100), (2001, 80)])
def test_confidence_by_length(spark, length, score):
    df = spark.createDataFrame([("AC-1", "f", "", "L", "n", "body", "x" * length)], "control_id string, source_file string, section_header string, baseline string, control_name string, extraction_source string, control_description string")
    assert validation.confidence(df).first()["score"] == score


def test_confidence_flags(spark):
    rows = [("AC-1", "f", "Glossary", "", "", "Table", "x" * 30 + " supplemental guidance"), ("AC-1", "f", "Appendix A", "L", "n", "body", "control family " + "x" * 30), ("AC-1", "g", "", None, None, None, None)]
    df = spark.createDataFrame(rows, "control_id string, source_file string, section_header string, baseline string, control_name string, extraction_source string, control_description string")
    got = [set(r["flags"]) for r in validation.confidence(df).collect()]
    assert {"SUSPECT_SECTION", "DUPLICATE_ID_SAME_DOC", "GUIDANCE_IN_DESC", "TABLE_SOURCE", "EMPTY_BASELINE", "EMPTY_NAME"} in got
    assert {"APPENDIX_SECTION", "DUPLICATE_ID_SAME_DOC", "TABLE_HEADERS_IN_DESC"} in got and {"EMPTY_DESCRIPTION", "DUPLICATE_ID_CROSS_DOC"} in got


def test_diff(spark):
    got = docdiff.sequence_diff([(0, "same"), (1, "old words here"), (2, "gone")], [(0, "same"), (1, "old words there"), (5, "new")])
    assert [(a, b, k) for a, b, k, *_ in got] == [(1, 1, "changed"), (2, 5, "replaced")]
    assert "".join(o["text"] for o in docdiff.word_ops("a b c", "a x c") if o["op"] != "insert") == "a b c"
    one_, two = (spark.createDataFrame([(x,) for x in names], "filename string") for names in (["Policy_v2.docx", "Alpha.docx", "Net access rules.docx"], ["Policy v2.docx", "alpha.docx", "Net access rule.docx", "Solo.docx"]))
    pairs = {(r["name1"], r["how"]) for r in docdiff.pair_files(one_, two).collect()}
    assert pairs == {("Alpha.docx", "exact"), ("Policy_v2.docx", "normalised"), ("Net access rules.docx", "fuzzy"), (None, "orphan")}


def test_blocks_equal_those_of_difflib(monkeypatch):
    rng = random.Random(4)
    for _ in range(400):
        monkeypatch.setattr(docdiff, "RARE", rng.randrange(4))
        size = rng.choice([2, 4, 8, 30])
        a = [rng.randrange(size) for _ in range(rng.randrange(40))]
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(3)] = [rng.randrange(size) for _ in range(rng.randrange(4))]
        assert docdiff.BlockMatcher(a, b).get_opcodes() == difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()


@pytest.mark.parametrize("more", [5, 450])
def test_insertion_at_the_top_of_a_long_place(spark, more):
    kind = "package_name string, location string, para_index bigint, accepted string"
    text = lambda k: "" if k % 7 == 0 else f"paragraph {k}"
    old = spark.createDataFrame([("p", "body", k, text(k)) for k in range(1_300)], kind)
    new = spark.createDataFrame([("p", "body", k, f"new {k}" if k < more else text(k - more)) for k in range(1_300 + more)], kind)
    got = docdiff.paragraph_diff(old, new).collect()
    assert sorted((r["index2"], r["kind"]) for r in got) == [(k, "added") for k in range(more)]


def test_typo_in_the_first_word_of_a_name(spark):
    one_, two = (spark.createDataFrame([(n,)], "filename string") for n in ("po sc 2023 000103 part 7.docx", "pol sc 2023 000103 part 7.docx"))
    assert [r["how"] for r in docdiff.pair_files(one_, two).collect()] == ["fuzzy"]


def test_alike_names_equal_brute_force(spark):
    rng = random.Random(5)
    names = []
    for _ in range(60):
        name = f"{rng.choice(['pol', 'gdl'])} {rng.choice(['sc', 'ac'])} 202{rng.randrange(5)} {rng.randrange(400):06} part {rng.randrange(30)}"[: rng.randrange(8, 30)]
        names += [name, *("".join(rng.choice([c, c, c, c, c, c, c, c, c, c, "", c + "x", "y"]) for c in name) for _ in range(3))]
    names = sorted(set(names))
    left, right = names[::2], names[1::2]
    scored = sorted((-difflib.SequenceMatcher(None, x, y).ratio(), x, y) for x in left for y in right)
    used, want = set(), set()
    for score, x, y in scored:
        if -score > 0.9 and (1, x) not in used and (2, y) not in used:
            used |= {(1, x), (2, y)}
            want.add((x, y))
    one_, two = (spark.createDataFrame([(n, n) for n in side], f"name{k} string, k{k} string") for k, side in ((1, left), (2, right)))
    assert {(r["name1"], r["name2"]) for r in docdiff.alike_pairs(one_, two).collect()} == want
    assert any(x.split()[0] != y.split()[0] for x, y in want)


def test_render(spark):
    kind = "array<struct<text:string,bold:boolean,strike:boolean,href:string>>"
    runs = F.lit(None).cast(kind)
    assert one(spark, F.coalesce(render.render_runs(runs), F.lit("none"))) in ("none", "")
    df = spark.createDataFrame([([("a ", True, False, None), ("b", True, None, None), (" c", False, False, None), ("site", None, None, "http://x")],)], f"r {kind}")
    assert df.select(render.render_runs(F.col("r")).alias("x")).first()["x"] == "**a b** c[site](http://x)"
    cells = spark.createDataFrame([(1, 0, 0, 0, "0.0", "a|b"), (1, 0, 0, 1, "0.0", "a|b"), (1, 0, 1, 0, "1.0", "c\nd"), (1, 0, 1, 1, "1.1", None)], "doc_id int, table_idx int, row_idx int, col_idx int, tc_id string, text string")
    assert render.pipe_tables(cells).first()["markdown"] == "| a\\|b |  |\n| --- | --- |\n| c<br>d |  |"
    html = render.html_tables(cells).first()
    assert html["merged"] and 'colspan="2"' in html["html"]
    assert one(spark, render.merge_tags(F.array(F.lit("A"), F.lit("b")), F.array(F.lit("a"), F.lit(" C ")))) == ["A", "b", "C"]
    assert profile.table_profile(cells).first()["merged"]
    assert one(spark, render.header_line([F.lit("x" * 90)])).endswith("...")
    els = elements(spark, [(1, 0, "Scope", "", 1, False), (1, 1, "All staff. More", "", None, False), (1, 2, "Next", "", 1, False), (2, 0, "about the scope", "", None, False), (2, 1, "Here", "", None, False)])
    assert {r["doc_id"]: r["text"] for r in render.text_under(els, "scope").collect()} == {1: "All staff. More", 2: "Here"}
    block = spark.createDataFrame([(1, 0, "top"), (1, 1, "line")], "doc_id bigint, pos int, text string")
    assert [r["text"] for r in render.place_metadata(els.where("doc_id = 1"), block, "top_and_bottom").orderBy("seq").collect()] == ["top", "line", "Scope", "All staff. More", "Next", "top", "line"]


def test_elements_with_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a\nb")], "doc_id bigint, text string")
    sections = spark.createDataFrame([(9, 3, 1, None, None, None)] * 2, "section_id bigint, doc_id bigint, start_para_index bigint, heading_style string, heading_level int, is_fake_heading boolean")
    got = sorted((r["doc_id"], r["seq"], r["level"]) for r in text_elements(docs, sections).collect())
    assert got == [(2, 0, None), (3, 0, None), (3, 1, 2)]
    assert text_lines(docs.where("false")).count() == 0
    assert measures.month_over_month(spark.createDataFrame([], "d date"), "d").count() == 0


def test_extents_join_without_broadcast(spark):
    docs = spark.createDataFrame([(d, "\n".join(f"line {k}" for k in range(9))) for d in range(300)], "doc_id bigint, text string").repartition(4)
    sections = spark.createDataFrame([(d, s, "Heading 1", 1, False) for d in range(0, 300, 2) for s in (0, 5)], "doc_id bigint, start_para_index bigint, heading_style string, heading_level int, is_fake_heading boolean").repartition(4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = text_elements(docs, sections)
        extents = headings.section_extents(lines)
        whole = profile.sizes(lines).join(profile.standard_presence(extents), "doc_id", "left").join(profile.largest_section(extents), "doc_id", "left")
        rows = whole.collect()
        assert len(rows) == 300 and sum(r["largest_section"] == headings.NO_HEADINGS for r in rows) == 150 and {r["missing"] for r in rows} == {"purpose, scope, intent, controls, appendix"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_few_pairs_of_numbered_names_are_compared(spark):
    rng = random.Random(6)
    names = sorted({f"{rng.choice(['pol', 'std', 'gdl'])} {rng.choice(['sc', 'ac', 'ir'])} 20{rng.randrange(18, 26)} {rng.randrange(30_000):06}{rng.choice(['', ' ', ' part '])}{rng.randrange(10**6)}" for _ in range(400)})
    names += [n[:k] + n[k + 1 :] for n in names[::3] for k in (3, len(n) - 2)] + [n[:20] + "xyzuv"[: rng.randrange(1, 6)] + n[20:] for n in names[::5]]
    names = sorted({n[:30] for n in names})
    left, right = names[::2], names[1::2]
    for threshold in (0.93, 0.9):
        kinds = {docdiff.sides(len(x), len(y), threshold)[0] for x in left for y in right if docdiff.sides(len(x), len(y), threshold)}
        assert kinds == {"whole", "halves"}
        want = {(x, y) for x in left for y in right if difflib.SequenceMatcher(None, x, y).ratio() > threshold}
        one_, two = (spark.createDataFrame([(n, n) for n in side], f"name{k} string, k{k} string") for k, side in ((1, left), (2, right)))
        got = {(r["name1"], r["name2"]) for r in docdiff.candidates(one_, two, threshold).collect()}
        assert want <= got and len(got) < 10 * len(want)


def _sides(spark, left, right):
    return (spark.createDataFrame([(n, n) for n in side], f"name{k} string, k{k} string") for k, side in ((1, left), (2, right)))


def _common(a, b):
    """The length of the longest common subsequence, cell by cell."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_few_pairs_of_names_with_too_many_forms_are_candidates(spark):
    rng = random.Random(7)
    names = sorted({f"pol ir 2022 000007 part {rng.randrange(10**6, 2 * 10**6)}" for _ in range(400)})
    left, right = names[::2], names[1::2]
    want = {(x, y) for x in left for y in right if difflib.SequenceMatcher(None, x, y).ratio() > 0.9}
    got = {(r["name1"], r["name2"]) for r in docdiff.candidates(*_sides(spark, left, right), 0.9).collect()}
    assert want and want <= got and len(got) < 1.5 * len(want)


@pytest.mark.parametrize("task", [300, 10**8])
def test_every_pair_of_names_is_compared_once(spark, monkeypatch, task):
    monkeypatch.setattr(docdiff, "TASK_PAIRS", task)
    rng = random.Random(8)
    base = ["net access rules for staff 2024", "регламент доступа 2024", "アクセス規則の手順書 第12版", "a" * 70 + " long name " + "b" * 20, "0" * 12 + "777", "x[y]{z}|~ & co", "ab"]
    names = {"".join(rng.choice([c] * 14 + ["", c + "7", "é"]) for c in b) for b in base for _ in range(12)} - {""}
    names = sorted(names)
    left, right = names[::2], names[1::2]
    for threshold in (0.9, 0.7):
        bound = {(x, y): 2.0 * _common(x, y) / (len(x) + len(y)) for x in left for y in right}
        rows = docdiff.candidates(*_sides(spark, [*left, "", None], [*right, "", None]), threshold).collect()
        got = {(r["name1"], r["name2"]): r["bound"] for r in rows}
        want = {k: v for k, v in bound.items() if v > threshold}
        assert len(rows) == len(got) and set(want) <= set(got) and len(got) < 1.1 * len(want)
        assert all(got[k] >= v for k, v in want.items())


def test_close_pairs_in_small_steps(monkeypatch):
    rng = random.Random(9)
    one_, two = (docdiff.Names(["".join(rng.choice("ab01") for _ in range(n)) for _ in range(40)]) for n in (9, 10))
    want = {(i, j, m) for i, x in enumerate(one_.texts) for j, y in enumerate(two.texts) if 19 - 2 * (m := _common(x, y)) <= 5}
    for at_once, held in ((1 << 15, 1 << 20), (28, 3)):
        monkeypatch.setattr(docdiff, "AT_ONCE", at_once)
        monkeypatch.setattr(docdiff, "HELD", held)
        got = [t for found in docdiff.close_pairs(one_, two, 5) for t in zip(*(x.tolist() for x in found), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_names_paired_by_forms_and_by_comparison_equal_brute_force(spark, monkeypatch):
    rng = random.Random(10)
    names = sorted({"".join(rng.choice("aab") for _ in range(rng.randrange(18, 24))) for _ in range(240)})
    left, right = names[::2], names[1::2]
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    used, want = set(), set()
    for score, x, y in sorted((-ratio(x, y), x, y) for x in left for y in right):
        if -score > 0.9 and (1, x) not in used and (2, y) not in used:
            used |= {(1, x), (2, y)}
            want.add((x, y))
    assert any(2.0 * _common(x, y) / (len(x) + len(y)) > max(0.9, ratio(x, y)) for x in left for y in right)
    assert {(r["name1"], r["name2"]) for r in docdiff.alike_pairs(*_sides(spark, left, right)).collect()} == want
    monkeypatch.setattr(docdiff, "MANY", 0)
    monkeypatch.setattr(docdiff, "FORM_COST", 0)
    assert {(r["name1"], r["name2"]) for r in docdiff.alike_pairs(*_sides(spark, left, right)).collect()} == want


def test_reference_text_is_joined_from_blocks(spark, monkeypatch):
    monkeypatch.setattr(render, "BLOCK", 40)
    rows = [(7, "b", "x", "t", "é"), (7, "b", "x", "t", "é"), (3, None, "y", None, None), (9, "a", "z", "", "d"), (8, "b", "w", "u", "v")] + [(k, "c", f"i{k}", None, "text") for k in range(10, 60)]
    df = spark.createDataFrame(rows, "ord bigint, domain string, id string, title string, description string").repartition(5)
    line = lambda r: f"- **{r[2]}**" + (f" | {r[3]}" if r[3] else "") + f" | {r[4] or ''}"
    want = "# All\n\n" + "\n\n".join(f"### {d or 'Ungrouped'}\n" + "\n".join(line(r) for r in sorted((r for r in rows if r[1] == d), key=lambda r: r[0])) for d in (None, "b", "a", "c"))
    text = render.reference_text(df, "All")
    assert [r["content"] for r in text.collect()] == [want]
    assert render.reference_text(df.drop("domain")).first()["content"] == "\n".join(line(r) for r in sorted(rows, key=lambda r: r[0]))
    assert render.reference_text(df.where("false"), "All").collect()[0]["content"] == "# All\n\n"
    assert "collect_list" not in text._jdf.queryExecution().optimizedPlan().toString()  # no task holds all rows
