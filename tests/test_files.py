"""Packages, workbooks, text files and streams, written and read again."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from paperloom.sinks import files as sinks
from paperloom.sources import files, office
from paperloom.streaming import events

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def package(body, **more):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f'<w:styles {W}><w:style w:styleId="H1"><w:name w:val="heading 1"/><w:rPr><w:b/></w:rPr></w:style></w:styles>')
        for name, text in more.items():
            z.writestr(f"word/{name}.xml", text)
    return buffer.getvalue()


def p(text, style=None, bold=False):
    return f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>" if style else ""}<w:r>{"<w:rPr><w:b/></w:rPr>" if bold else ""}<w:t>{text}</w:t></w:r></w:p>'


TABLE = '<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr>' + p("wide") + "</w:tc></w:tr><w:tr><w:tc>" + p("a") + "</w:tc><w:tc>" + p("b") + "</w:tc></w:tr></w:tbl>"
TRACKED = '<w:p><w:r><w:t>keep </w:t></w:r><w:ins w:author="me" w:date="2024-01-01T00:00:00Z"><w:r><w:t>new</w:t></w:r></w:ins><w:del w:author="me"><w:r><w:delText>old</w:delText></w:r></w:del></w:p>'
NOTED = '<w:p><w:commentRangeStart w:id="0"/><w:r><w:t>anchored</w:t></w:r><w:commentRangeEnd w:id="0"/></w:p>'


def test_word_packages(spark, tmp_path):
    comments = f'<w:comments {W}><w:comment w:id="0" w:author="me" w:initials="M"><w:p><w:r><w:t>why?</w:t></w:r></w:p></w:comment></w:comments>'
    (tmp_path / "a.docx").write_bytes(package(p("Title", "H1") + p("text", bold=True) + TABLE + TRACKED + NOTED, header1=f"<w:hdr {W}>{p('head')}</w:hdr>", comments=comments))
    (tmp_path / "b_backup.docx").write_bytes(package(p("no")))
    (tmp_path / "broken.docx").write_bytes(b"no package")
    docs = office.list_files(spark, str(tmp_path), exclude=["BACKUP"])
    rows = office.read_word(docs, "elements").orderBy("doc", "seq").collect()
    assert [(r["doc"], r["kind"], r["style"], r["text"]) for r in rows[:4]] == [("a.docx", "paragraph", "Heading 1", "Title"), ("a.docx", "paragraph", "Normal", "text"), ("a.docx", "table", None, None), ("a.docx", "paragraph", "Normal", "keep new")]
    assert rows[0]["bold_all"] and rows[1]["bold_all"] and rows[-1]["kind"] == "error" and "BadZipFile" in rows[-1]["error"]
    assert [(r["col_idx"], r["text"]) for r in office.read_word(docs, "cells").orderBy("row_idx", "col_idx").collect()] == [(0, "wide"), (1, "wide"), (0, "a"), (1, "b")]
    parts = {(r["location"], r["accepted"]): r["rejected"] for r in office.read_word(docs, "parts").collect()}
    assert parts[("body", "keep new")] == "keep old" and ("header1", "head") in parts
    assert {(r["rev_type"], r["text"]) for r in office.read_word(docs, "revisions").collect()} == {("ins", "new"), ("del", "old")}
    assert [(r["anchor_text"], r["text"], r["resolved"]) for r in office.read_word(docs, "comments").collect()] == [("anchored", "why?", False)]
    assert office.read_word(docs, "properties").where("category = 'hash'").count() == 4


def test_workbooks(spark, tmp_path):
    path = tmp_path / "book.xlsx"
    df = spark.createDataFrame([("Policy A", "http://a", 1), ("Policy <B>", None, 2)], "Document_Name string, URL string, n int")
    sinks.write_workbook({"Lookup": df, "Empty": df.where("false")}, f"file://{path}")
    got = office.read_sheet(spark, str(path), "Lookup")
    assert got.columns == ["ord", "Document_Name", "URL", "n"]
    assert [tuple(r) for r in files.select_columns(got, {"name": "document_name", "url": "url", "none": "zzz"}).collect()] == [("Policy A", "http://a", None), ("Policy <B>", None, None)]
    assert office.read_sheet(spark, str(path), "Missing").count() == 0


def test_text_files(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv/a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "csv/b.csv").write_text("y,z\n3,4\n")
    assert sorted(map(str, (tuple(r.asDict()[k] for k in ("x", "y", "z", "source_file")) for r in files.read_csv_folder(spark, f"file://{tmp_path}/csv").collect()))) == sorted(map(str, [("1", "2", None, "a.csv"), (None, "3", "4", "b.csv")]))
    for name, value in (("list", [{"n": 1}]), ("envelope", {"profiles": [{"n": 2}]})):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert [r["n"] for r in files.read_profiles(spark, f"file://{tmp_path}/{name}.json", "n int").collect()] == [1 if name == "list" else 2]
    df = spark.createDataFrame([("a", "ü \"q\""), ("b", None)], "k string, t string")
    sinks.write_json_lines(df, f"file://{tmp_path}/j")
    assert "ü" in "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "j").glob("*.json"))
    sinks.write_csv(df, f"file://{tmp_path}/c", quote_all=True)
    assert spark.read.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/c").where("t is not null").first()["t"] == 'ü "q"'
    sinks.write_envelope(df, "k", "1", f"file://{tmp_path}/e")
    whole = json.loads("".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / "e").glob("part*.txt"))))
    assert whole == {"profiler_version": "1", "document_count": 2, "profiles": [{"k": "a", "t": 'ü "q"'}, {"k": "b", "t": None}]}
    sinks.write_texts(spark.createDataFrame([("one.md", "# x\ny")], "file string, content string"), f"file://{tmp_path}/m")
    assert next((tmp_path / "m/file=one.md").glob("*.txt")).read_text() == "# x\ny\n"
    log = sinks.issue_log(df, "step", "k", "error", F.col("t"), F.lit("now"))
    assert log.count() == 1
    tags = files.tag_lists(spark.createDataFrame([("d", "a, b,,")], "n string, t string"), "n", "t").first()["tags"]
    assert tags == ["a", "b"]
    words = spark.createDataFrame([(0, "(instructions)", "A", "d", ""), (1, "x", "B", "d", "False Positive"), (2, "x", "C", "", ""), (3, "x", "D", "def", None)], "ord int, Document string, Acronym string, Definition string, Status string")
    assert [r["acronym"] for r in files.acronym_definitions(words).collect()] == ["D"]


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, kind string")
    first.write.parquet(source)
    run = lambda: events.run_available(events.stream_table(spark, source, first.schema), events.idempotent_sink(out), state)
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3, "c")], "id int, kind string").write.mode("append").parquet(source)
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_marks_links_and_text_boxes(spark, tmp_path):
    box = "<w:p><w:r><w:t>around</w:t></w:r><w:r><w:pict><w:txbxContent>" + p("boxed") + "</w:txbxContent></w:pict></w:r></w:p>"
    nested = "<w:tbl><w:tr><w:tc>" + TABLE + "</w:tc></w:tr></w:tbl>"
    anchor = '<w:p><w:hyperlink w:anchor="there"><w:r><w:t>see there</w:t></w:r></w:hyperlink><w:r><w:t> and www.example.org/x or nothing</w:t></w:r></w:p>'
    settings = f"<w:settings {W}><w:documentProtection/></w:settings>"
    (tmp_path / "a.docx").write_bytes(package(box + nested + TRACKED + anchor, settings=settings))
    (tmp_path / "bad.docx").write_bytes(b"no package")
    docs = office.list_files(spark, str(tmp_path))
    flags = {r["doc"]: r for r in office.read_word(docs, "flags").collect()}
    a = flags["a.docx"]
    assert (a["nested_tables"], a["has_text_boxes"], a["has_tracked_changes"], a["has_password_protection"]) == (1, True, True, True)
    assert not (a["has_images"] or a["has_comments"] or a["has_embedded_objects"]) and "BadZipFile" in flags["bad.docx"]["error"]
    assert [r["filename"] for r in office.unreadable(docs).collect()] == ["bad.docx"]
    links = {(r["url_type"], r["target_url"], r["url_display_text"]) for r in office.read_word(docs, "links").collect()}
    assert links == {("internal", "there", "see there"), ("bare_text", "www.example.org/x", "")}
    found = {r["doc"]: (r["paragraphs"], r["tables"], r["textboxes"], r["internal_links"], r["bare_links"], r["images"]) for r in office.element_inventory(docs).collect()}
    assert found["a.docx"] == (3, 1, 1, 1, 1, False)
    rows = [(r["kind"], r["text"]) for r in office.read_word(docs, "elements").where("doc = 'a.docx'").orderBy("seq").collect()]
    assert rows[:2] == [("paragraph", "around"), ("textbox", "boxed")]


def test_manifests_catalogs_and_settings(spark, tmp_path):
    (tmp_path / "m.csv").write_text('original_doc,sub_doc_filename,heading_text,character_count,page_estimate\nA_fixed.docx,A - One.docx,"One, two",120,0.1\nB.docx,,x,,\n')
    rows, parents = files.split_manifest(spark, f"file://{tmp_path}/m.csv")
    assert rows.count() == 2 and [tuple(r) for r in parents.collect()] == [("a - one", "a_fixed")]
    sheet = spark.createDataFrame([(0, "AC-1", "d1", "Access"), (1, None, "lost", "x"), (2, " AC-2 ", None, None)], "ord int, c0 string, c1 string, c2 string")
    assert [tuple(r) for r in files.framework_controls(sheet, 0, 1, {"Domain": 2, "Title": 9}).orderBy("ord").collect()] == [(0, "AC-1", "d1", "Access", ""), (2, "AC-2", "", "", "")]
    got = files.catalog_controls(sheet.withColumnsRenamed({"c0": "Control ID", "c1": "Text"}), {"control_id": "control id", "text": "text", "none": "zzz"}, "catalog", {"AC": "Access Control"}).orderBy("control_id").collect()
    assert [(r["control_id"], r["family"], r["source"], r["none"]) for r in got] == [("AC-1", "Access Control", "catalog", None), ("AC-2", "Access Control", "catalog", None)]
    assert [r["row_idx"] for r in files.with_row_index(sheet, "ord").orderBy("ord").collect()] == [0, 1, 2]
    book = sinks.workbook({"General": [["Setting", "Value"], ["a.b", "3"], ["# note", "x"], ["a.c", "yes"]], "Ignore Words": [["Word"], ["THE"], ["AND"]], "Sites": [["name", "url"], ["x", "u"], ["y", None]]})
    assert files.settings_of_sheets(book) == {"a": {"b": 3, "c": True}, "ignore_words": ["THE", "AND"], "sites": [{"name": "x", "url": "u"}, {"name": "y", "url": None}]}
    (tmp_path / "c.xlsx").write_bytes(book)
    assert files.load_settings(spark, [str(tmp_path / "none.yaml"), str(tmp_path / "c.xlsx")], {"a": {"d": 1}})["a"] == {"b": 3, "c": True, "d": 1}
    assert files.load_settings(spark, [str(tmp_path / "none.yaml")], {"k": 1}) == {"k": 1}


def test_books(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    path = tmp_path / "grow.xlsx"
    sinks.append_to_workbook(df, f"file://{path}", "Rows", None)
    sinks.append_to_workbook(spark.createDataFrame([(2, "b", "extra")], "n int, k string, more string"), f"file://{path}", "Rows", path.read_bytes())
    assert [r[2] for r in office.workbook_rows(path.read_bytes())] == [["k", "n"], ["a", "1"], ["b", "2"]]
    sinks.write_csv(df, f"file://{tmp_path}/s1")
    sinks.write_csv(df, f"file://{tmp_path}/issues")
    sheets = sinks.consolidated(spark, {"Step 1": f"file://{tmp_path}/s1", "Gone": f"file://{tmp_path}/gone", "Issues": f"file://{tmp_path}/issues"}, ["Issues"])
    assert list(sheets) == ["Issues", "Step 1"]
    stats = spark.createDataFrame([("d", 3, 1)], "doc string, paragraphs int, headings int")
    log = sinks.conversion_book(stats, df)
    assert {r["label"]: r["value"] for r in log["Totals"].collect()} == {"documents": 1.0, "paragraphs": 3.0, "headings": 1.0}


def test_a_state_machine_on_a_stream(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00", "draft"), ("a", "2024-01-01 01:00:00", "review"), ("b", "2024-01-01 00:00:00", "draft"), ("b", "2024-01-01 02:00:00", "published")], "k string, t string, s string").selectExpr("k", "cast(t as timestamp) as t", "s")
    rows.write.parquet(source)
    allowed = {"draft": ["review"], "review": ["published"]}
    run = lambda: events.run_available(events.state_machine(events.stream_table(spark, source, rows.schema), "k", "t", "s", allowed), events.idempotent_sink(out), state)
    run()
    spark.createDataFrame([("a", "2024-01-01 03:00:00", "published")], "k string, t string, s string").selectExpr("k", "cast(t as timestamp) as t", "s").write.mode("append").parquet(source)
    run()
    assert sorted((r["k"], r["state"], r["next"], r["valid"]) for r in spark.read.parquet(out).collect()) == [("a", "draft", "review", True), ("a", "review", "published", True), ("b", "draft", "published", False)]
