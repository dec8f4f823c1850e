"""Queries on acronyms, control records and references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import acronyms as A
from paperloom.operators import controls as C
from paperloom.operators import crossrefs as X
from paperloom.operators.headings import ANY_CONTROL_ID
from paperloom.plans.registry import Registry
from paperloom.plans.structure import EL, _long, elements
from paperloom.session import table

R = Registry()
query = R.query

#: Letters and digits beyond ASCII as ``x``, so that the word ends of the statement's patterns are those of the text.
_MASKED = "regexp_replace(regexp_replace(text, '[^\\x00-\\x7F\\P{L}]', 'x', 'g'), '[^\\x00-\\x7F\\P{N}]', 'x', 'g')"
_NO_ACRONYMS = (
    "THE", "AND", "FOR", "NOT", "BUT", "ALL", "ARE", "CAN", "HAS", "HER", "WAS", "ONE", "OUR", "OUT", "YOU", "USE", "MAY", "SHALL", "MUST", "WILL", "WITH", "THIS", "THAT", "FROM", "THEY", "BEEN",
    "HAVE", "EACH", "MAKE", "WHEN", "DOES", "INTO", "THEM", "THEN", "THAN", "ONLY", "OVER", "SUCH", "ALSO", "SOME", "THESE", "OTHER", "WHICH", "THEIR", "THERE", "WOULD", "ABOUT", "AFTER", "COULD", "WHERE", "SHOULD", "THOSE",
    "II", "III", "IV", "VI", "VII", "VIII", "IX", "XI", "XII", "PAGE", "DATE", "DRAFT", "FINAL", "NOTE", "TABLE", "FIGURE", "REV", "VER", "NA", "TBD", "TODO", "YES", "NO",
)
_IGNORED = ", ".join(f"'{w}'" for w in _NO_ACRONYMS)
_HITS = f"""with h as (select doc_id, unnest(regexp_extract_all({_MASKED}, '\\b[A-Z]{{2,8}}\\b')) as acronym from documents where text is not null union all
  select doc_id, unnest(regexp_extract_all({_MASKED}, '([A-Za-z\\s\\-]+?)\\s*\\(([A-Z][A-Z\\-/]{{1,9}})\\)', 2)) from documents where text is not null),
k as (select doc_id, regexp_replace(regexp_replace(acronym, '^-+|-+$', '', 'g'), '^/+|/+$', '', 'g') as acronym from h),
u as (select doc_id, acronym, count(*) as n from k where length(acronym) >= 2 and acronym not in ({_IGNORED}) and not regexp_matches(acronym, '[0-9]') group by 1, 2)"""


def _per_document(spark: SparkSession, d: str) -> DataFrame:
    """Acronyms of the documents' texts, each as one place."""
    texts = table(spark, d, "documents").where("text is not null").select("doc_id", F.lit("body").alias("location"), "text")
    return A.per_document(A.acronym_hits(texts))


@query("a2_document_acronyms", _HITS + " select doc_id, acronym, n from u")
def a2_document_acronyms(spark: SparkSession, d: str) -> DataFrame:
    """A1, A2: acronyms of every document with their count."""
    return _per_document(spark, d).select("doc_id", "acronym", "n")


@query("a3_corpus_acronyms", _HITS + " select acronym, cast(sum(n) as bigint) as total, count(*) as documents from u group by 1")
def a3_corpus_acronyms(spark: SparkSession, d: str) -> DataFrame:
    """A3: acronyms of the corpus."""
    return A.over_corpus(_per_document(spark, d)).select("acronym", "total", "documents")


_ROWS = "select distinct entry_id, document, upper(trim(acronym)) as acronym, occurrences as n, found_in, definitions_detected as definition from acronym_per_document where trim(acronym) <> '' and occurrences > 0"
_PLACES = ("body", "footer", "header", "table", "textbox")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "acronym_per_document").select("entry_id", "document", F.upper(F.trim("acronym")).alias("acronym"), F.col("occurrences").alias("n"), "found_in", F.col("definitions_detected").alias("definition"))
    return rows.where("acronym <> '' and n > 0").distinct()


@query("a5_place_matrix", f"with r as ({_ROWS}), p as (select acronym, n, unnest(string_split(found_in, ', ')) as place from r) select acronym, {', '.join(f'''cast(sum(case when place = '{p}' then n end) as bigint) as {p}''' for p in _PLACES)} from p group by 1")
def a5_place_matrix(spark: SparkSession, d: str) -> DataFrame:
    """A5: acronyms against the places where they stand."""
    rows = _rows(spark, d).select("acronym", F.col("n").cast("bigint").alias("n"), F.explode(F.split("found_in", ", ")).alias("place"))
    return rows.groupBy("acronym").pivot("place", list(_PLACES)).agg(F.sum("n"))


@query("a6_listing", f"with r as ({_ROWS}), g as (select document, acronym, sum(n)::bigint as n from r group by 1, 2) select document, acronym, n, row_number() over (partition by document order by n desc, acronym) as place from g")
def a6_listing(spark: SparkSession, d: str) -> DataFrame:
    """Acronyms of each document in falling frequency."""
    from pyspark.sql import Window

    rows = _rows(spark, d).groupBy("document", "acronym").agg(F.sum("n").cast("bigint").alias("n"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("document").orderBy(F.desc("n"), "acronym")).cast("bigint"))


@query(
    "a7_rare_tags",
    f"with r as ({_ROWS}), g as (select document, acronym, sum(n)::bigint as n from r group by 1, 2), s as (select acronym from g group by 1 having count(*) <= 3), t as (select document, acronym, row_number() over (partition by document order by n desc, acronym) as k from g where acronym in (select acronym from s)) select document, string_agg(acronym, ', ' order by k) as tags from t where k <= 15 group by 1",
)
def a7_rare_tags(spark: SparkSession, d: str) -> DataFrame:
    """The rare acronyms of each document as tags."""
    return A.rare_tags(_rows(spark, d).groupBy("document", "acronym").agg(F.sum("n").cast("bigint").alias("n")))


@query(
    "a8_glossary",
    f"with r as ({_ROWS}), f as (select document, lower(acronym) as k, min(struct_pack(o := entry_id, a := acronym, m := definition)) as f from r where definition <> '' group by 1, 2) select document, string_agg(f.a || ' = ' || f.m, ', ' order by f.o) as glossary from f group by 1",
)
def a8_glossary(spark: SparkSession, d: str) -> DataFrame:
    """The definitions of each document as one text."""
    return A.glossary(_rows(spark, d).where("definition <> ''").select("document", F.col("entry_id").alias("ord"), "acronym", "definition"))


@query("a4_undefined", f"with r as ({_ROWS}), g as (select document, acronym, sum(n)::bigint as n, max(coalesce(definition, '') <> '') as said from r group by 1, 2) select acronym, sum(n)::bigint as total, count(*) as documents from g group by 1 having not bool_or(said)")
def a4_undefined(spark: SparkSession, d: str) -> DataFrame:
    """A4: acronyms of the lists that no document defines."""
    listed = _rows(spark, d).groupBy(F.col("document").alias("doc_id"), "acronym").agg(F.sum("n").cast("bigint").alias("n"), F.array_join(F.array_sort(F.collect_set("definition")), "; ").alias("definitions"))
    return A.undefined(A.over_corpus(listed))


@query("a9_collisions", f"with r as ({_ROWS}) select acronym, count(distinct definition) as definitions from r where definition <> '' group by 1 having count(distinct definition) > 1")
def a9_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Acronyms with several definitions."""
    return A.collisions(_rows(spark, d).where("definition <> ''"))


_ID = "(?:\\b[A-Z]{2,4}[-.]?[0-9]{1,3}[-.][0-9]{2,4}\\b)|(?:\\b[A-Z]{2,4}\\s+[0-9]{1,3}\\.[0-9]{2,4}\\b)|(?:\\b[A-Z]{2,4}[0-9]{2,3}\\.[0-9]{2,4}\\b)"
_P = "select distinct copy_no::bigint as copy_no, package_name, location, para_index, trim(accepted) as t from paragraph where length(trim(accepted)) > 0"
_PLACE = ("copy_no", "package_name", "location")


def _paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The non-blank paragraphs of both copies."""
    rows = table(spark, d, "paragraph").select(F.col("copy_no").cast("bigint").alias("copy_no"), "package_name", "location", "para_index", F.col("accepted").alias("text")).distinct()
    return rows.where(F.length(F.trim("text")) > 0)


def _mentioned_context(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs around the first mention of each control."""
    from paperloom.operators import validation as V

    rows = _paragraphs(spark, d).where("location = 'body'").select("package_name", "copy_no", "para_index", F.trim("text").alias("text"))
    seen = rows.select("package_name", "copy_no", "para_index", F.explode(C.control_ids(F.col("text"))).alias("control_id"))
    first = seen.groupBy("control_id").agg(F.min(F.struct("package_name", "copy_no", "para_index")).alias("_f")).select("control_id", "_f.package_name", "_f.copy_no", F.col("_f.para_index").alias("at"))
    return V.source_context(rows, first, ["package_name", "copy_no"], "para_index")


@query("c1_control_ids", f"with p as ({_P}) select copy_no, package_name, location, para_index, array_to_string(regexp_extract_all(t, '{_ID}'), ', ') as ids from p where regexp_matches(t, '{_ID}')")
def c1_control_ids(spark: SparkSession, d: str) -> DataFrame:
    """The control identifiers of every paragraph."""
    rows = _paragraphs(spark, d).withColumn("_i", C.control_ids(F.col("text"))).where(F.size("_i") > 0)
    return rows.select(*_PLACE, "para_index", F.array_join("_i", ", ").alias("ids"))


_HEADER = f"""not regexp_matches(t, '{_ID}') and (regexp_matches(t, '^[Ss]ection\\s+[0-9]{{1,2}}') or regexp_matches(t, '^[0-9]{{1,2}}\\.?[0-9]{{0,2}}\\s+[A-Z][a-zA-Z\\s]{{3,50}}$')
  or (t = upper(t) and length(t) < 80 and not ends_with(t, '.') and len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) >= 3))"""


@query("h17_section_headers", f"with p as ({_P}) select copy_no, package_name, location, para_index, t as header from p where {_HEADER}")
def h17_section_headers(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs that head a section."""
    from paperloom.operators.headings import is_section_header

    rows = _paragraphs(spark, d)
    return rows.where(is_section_header(F.col("text"), F.lit("Normal"), F.lit(False))).select(*_PLACE, "para_index", F.trim("text").alias("header"))


_BLOCKS = f"""with p as ({_P}), e as (select *, case when {_HEADER} then 'H' when regexp_matches(t, '{_ID}') then 'C' end as ev from p),
i as (select *, count(ev) over z as island, last_value(case when ev = 'H' then t end ignore nulls) over z as head from e window z as (partition by copy_no, package_name, location order by para_index rows between unbounded preceding and current row)),
b as (select copy_no, package_name, location, island, min(case when ev = 'C' then para_index end) as start, arg_min(case when ev = 'C' then t end, case when ev = 'C' then para_index end) as first_line, arg_min(case when ev = 'C' then head end, case when ev = 'C' then para_index end) as head, string_agg(t, chr(10) order by para_index) as body, count(*) as lines from i where island > 0 group by 1, 2, 3, 4)"""


@query("c3_control_blocks", _BLOCKS + f" select copy_no, package_name, location, start, regexp_extract_all(first_line, '{_ID}')[1] as control_id, len(regexp_extract_all(first_line, '{_ID}'))::bigint as ids, coalesce(head, '') as section_header, body, lines from b where start is not null")
def c3_control_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Control blocks of every package."""
    return C.control_blocks(_paragraphs(spark, d), _PLACE, "para_index")


_GW = "implementation guidance|implementation:|guidelines:|how to implement|supplemental guidance"
_TEXT = "coalesce(control_description, '') || ' Implementation guidance ' || coalesce(supplemental_guidance, '') || ' How to implement ' || coalesce(miscellaneous, '')"


@query(
    "c5_guidance",
    f"""with t as (select row_id, {_TEXT} as t from control_row), a as (select row_id, regexp_extract(t, '(?is)^(.*?)(?:{_GW})', 1) as d, regexp_extract(t, '(?is)^.*?(?:{_GW})(.*)$', 1) as r from t)
    select row_id, trim(d) as description, trim(case when regexp_matches(r, '(?is)(?:{_GW})') then regexp_extract(r, '(?is)^(.*?)(?:{_GW})', 1) else r end) as guidance, trim(case when regexp_matches(r, '(?is)(?:{_GW})') then regexp_extract(r, '(?is)^.*?(?:{_GW})(.*)$', 1) else '' end) as rest from a""",
)
def c5_guidance(spark: SparkSession, d: str) -> DataFrame:
    """Description, guidance and the rest of a joined text."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    text = F.concat(part("control_description"), F.lit(" Implementation guidance "), part("supplemental_guidance"), F.lit(" How to implement "), part("miscellaneous"))
    a, b, c = C.split_guidance(text)
    return table(spark, d, "control_row").select("row_id", a.alias("description"), b.alias("guidance"), c.alias("rest"))


_BASE = "\\s*\\(\\s*([LMH](?:\\s*,\\s*[LMH])*)\\s*\\)"


@query(
    "c6_baseline_names",
    f"""with p as ({_P}), a as (select copy_no, package_name, location, para_index, t, regexp_extract_all(t, '{_ID}')[1] as id from p where regexp_matches(t, '{_ID}')), b as (select *, substr(t, instr(t, id) + length(id)) as r0, regexp_extract(substr(t, instr(t, id) + length(id)), '^{_BASE}', 1) as b1 from a),
    c as (select *, regexp_replace(r0, '^{_BASE}', '') as r from b), e as (select *, regexp_matches(r, '^\\s*[-–—]\\s*.+') as dashed, trim(regexp_extract(r, '^\\s*[-–—]\\s*(.+)', 1)) as nm, trim(r) as bare from c),
    f as (select *, regexp_extract(nm, '{_BASE}', 1) as late, regexp_extract(bare, '{_BASE}', 1) as bb from e),
    g as (select *, case when b1 = '' and late <> '' then trim(regexp_replace(nm, '{_BASE}.*$', '')) else nm end as cut_name, case when bb <> '' then trim(regexp_replace(bare, '{_BASE}.*$', '')) when bare <> '' and not regexp_matches(bare, '^[(.]') then bare else '' end as bare_name,
      trim(regexp_replace(trim(regexp_replace(substr(t, 1, instr(t, id) - 1), '[\\s\\-–—]+$', '')), '\\bcontrol\\s*(id)?\\s*$', '', 'i')) as lead from f)
    select copy_no, package_name, location, para_index, id as control_id, replace(case when b1 <> '' then b1 when dashed then late when bare_name <> '' then bb else '' end, ' ', '') as baseline, case when (case when dashed then cut_name else bare_name end) <> '' then (case when dashed then cut_name else bare_name end) else lead end as name from g""",
)
def c6_baseline_names(spark: SparkSession, d: str) -> DataFrame:
    """Baseline and name from the paragraphs with an identifier."""
    rows = _paragraphs(spark, d).withColumn("text", F.trim("text")).withColumn("control_id", F.try_element_at(C.control_ids(F.col("text")), F.lit(1))).where("control_id is not null")
    baseline, name = C.baseline_and_name(F.col("text"), F.col("control_id"))
    return rows.select(*_PLACE, "para_index", "control_id", baseline.alias("baseline"), name.alias("name"))


_TRIG = {"purpose": "purpose|objective|intent", "scope": "scope|coverage|boundary", "applicability": "applicability|applies to|applies for"}
_LABEL = f"^\\s*[0-9.]*\\s*({'|'.join(_TRIG.values())})\\s*[:\\-]?\\s*"
_FIRES = {k: f"regexp_matches(lower(text), '\\b({p})\\b')" for k, p in _TRIG.items()}


@query(
    "c10_document_metadata",
    EL + f""", r as (select doc_id, seq, text, {", ".join(f"{v} as {k}" for k, v in _FIRES.items())}, level is not null as hd from el where seq < 40 and length(trim(text)) > 0),
    i as (select *, count(case when purpose or scope or applicability or hd then 1 end) over (partition by doc_id order by seq) as i, case when purpose or scope or applicability or hd then trim(regexp_replace(text, '{_LABEL}', '', 'i')) else trim(text) end as b from r),
    g as (select doc_id, i, bool_or(purpose) as p, bool_or(scope) as s, bool_or(applicability) as a, string_agg(case when b <> '' then b end, ' ' order by seq) as t from i where i > 0 group by 1, 2)
    select doc_id, coalesce(arg_min(case when p then t end, case when p then i end), '') as purpose, coalesce(arg_min(case when s then t end, case when s then i end), '') as scope, coalesce(arg_min(case when a then t end, case when a then i end), '') as applicability from g where t <> '' group by 1""",
)
def c10_document_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Purpose, scope and applicability of every document."""
    return C.document_metadata(elements(spark, d))


@query(
    "c13_id_matches",
    f"""with t as (select doc_id, text, string_split_regex(text, '{_ID}') as p, regexp_extract_all(text, '{_ID}') as m from documents where regexp_matches(text, '{_ID}')), u as (select *, unnest(range(1, len(m) + 1)) as i from t),
    q as (select doc_id, text, m[i] as control_id, (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as position from u)
    select doc_id, position, control_id, substr(text, greatest(position - 50, 0) + 1, position + length(control_id) + 50 - greatest(position - 50, 0)) as context, contains(substr(text, position + length(control_id) + 1, 50), '.') as ends_sentence from q""",
)
def c13_id_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every identifier of the documents with its place and surroundings."""
    return C.id_matches(table(spark, d, "documents"), "doc_id", "text")


@query("c15_unfinished", "select distinct filename from documents where filename not in (select filename from tracked_change where filename is not null)")
def c15_unfinished(spark: SparkSession, d: str) -> DataFrame:
    """The files that are not yet done."""
    return C.unfinished(table(spark, d, "documents").select("filename").distinct(), table(spark, d, "tracked_change"))


_PATTERNS = [("external", r"(?i)in line with the ([a-z]+) plan"), ("internal", r"(?i)section\s+([0-9]+(?:\.[0-9]+)*)")]


@query(
    "x2_references",
    EL + """, m as (select doc_id, seq, 0 as ord, 'external' as reference_type, unnest(regexp_extract_all(text, '(?i)in line with the ([a-z]+) plan', 0)) as matched, unnest(regexp_extract_all(text, '(?i)in line with the ([a-z]+) plan', 1)) as target, unnest(generate_series(0, len(regexp_extract_all(text, '(?i)in line with the ([a-z]+) plan', 0)) - 1)) as match_no from el
    union all select doc_id, seq, 1, 'internal', unnest(regexp_extract_all(text, '(?i)section\\s+([0-9]+(?:\\.[0-9]+)*)', 0)), unnest(regexp_extract_all(text, '(?i)section\\s+([0-9]+(?:\\.[0-9]+)*)', 1)), unnest(generate_series(0, len(regexp_extract_all(text, '(?i)section\\s+([0-9]+(?:\\.[0-9]+)*)', 0)) - 1)) from el)
    select doc_id, seq, ord::bigint as ord, match_no::bigint as match_no, reference_type, matched, target from m where matched is not null""",
)
def x2_references(spark: SparkSession, d: str) -> DataFrame:
    """All matches of all patterns with what they refer to."""
    return _long(X.references(elements(spark, d), _PATTERNS), "doc_id", "seq", "ord", "match_no", "reference_type", "matched", "target")


@query("x4_urls", "select row_id, unnest(regexp_extract_all(published_url, 'https?://[^\\s<>\"]+|www\\.[^\\s<>\"]+')) as url from control_row where published_url is not null")
def x4_urls(spark: SparkSession, d: str) -> DataFrame:
    """Web addresses."""
    return X.urls(table(spark, d, "control_row"), ("row_id",), "published_url").select("row_id", "url")


#: The profiler's patterns as the statement names them, and one that has no label of its own.
_PROFILE = {
    "see section\\s+[0-9.]+[a-z]?": "See section reference", "refer to\\s+(section|the)": "Refer to clause/section", "as described in\\s+(the|section)": "As described in reference", "per section\\s+[0-9.]+": "Per section reference",
    "in accordance with\\s+(the|section)": "In accordance with", "as defined in\\s+(the|section)": "As defined in reference", "as outlined in\\s+(the|section)": "As outlined in reference", "per the organization''?s\\s+\\w+": "Per organization document",
    "see the\\s+\\w+\\s+policy": "See policy reference", "as specified in\\s+(the|section)": "As specified in reference", "in line with the": "Pattern: in line with the",
}


@query(
    "x5_pattern_counts",
    "with p as (select doc_id, unnest([" + ", ".join(f"struct_pack(p := '{v}', n := len(regexp_extract_all(text, '(?i){k}')))" for k, v in _PROFILE.items()) + "]) as x from documents where text is not null) select doc_id, x.p as pattern, sum(x.n)::bigint as n from p where x.n > 0 group by 1, 2",
)
def x5_pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each of the profiler's patterns, and one of another kind, occurs in each document, by its label."""
    return X.pattern_counts(table(spark, d, "documents"), (*X.PROFILE_PATTERNS, "in line with the"))


@query("r5_bad_ids", f"select row_id, control_id from control_row where not regexp_full_match(trim(control_id), '{_ID}')")
def r5_bad_ids(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers that no pattern matches as a whole."""
    return table(spark, d, "control_row").where(~F.trim("control_id").rlike(f"^(?:{ANY_CONTROL_ID})$")).select("row_id", "control_id")


@query(
    "c7_bodies",
    f"""with p as ({_P}), a as (select copy_no, package_name, location, para_index, t, regexp_extract_all(t, '{_ID}')[1] as id from p where regexp_matches(t, '{_ID}')), b as (select *, regexp_replace(substr(t, instr(t, id) + length(id)), '^{_BASE}', '') as r from a)
    select copy_no, package_name, location, para_index, id as control_id, trim(case when regexp_matches(r, '^\\s*[-–—]\\s*[^\\n]+') then regexp_replace(r, '^\\s*[-–—]\\s*[^\\n]+', '') when regexp_matches(r, '{_BASE}') then regexp_extract(r, '(?s)^.*?{_BASE}(.*)$', 2) else r end) as body from b""",
)
def c7_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs with an identifier, without it, its baseline and its name."""
    rows = _paragraphs(spark, d).withColumn("text", F.trim("text")).withColumn("control_id", F.try_element_at(C.control_ids(F.col("text")), F.lit(1))).where("control_id is not null")
    return rows.select(*_PLACE, "para_index", "control_id", C.strip_prefix(F.col("text"), F.col("control_id")).alias("body"))


@query(
    "x2_reference_records",
    EL + """, p as (select *, coalesce(last_value(case when level <= 2 then text end ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and 1 preceding), '(No heading found)') as parent from el),
    m as (select filename, parent, seq, 'external' as t, unnest(regexp_extract_all(text, '(?i)in line with the ([a-z]+) plan', 0)) as a, unnest(regexp_extract_all(text, '(?i)in line with the ([a-z]+) plan', 1)) as b, '' as u, '' as k from p
    union all select filename, parent, seq, 'internal', unnest(regexp_extract_all(text, '(?i)section\\s+([0-9]+(?:\\.[0-9]+)*)', 0)), unnest(regexp_extract_all(text, '(?i)section\\s+([0-9]+(?:\\.[0-9]+)*)', 1)), '', '' from p
    union all select filename, parent, seq, '', '', '', unnest(regexp_extract_all(text, 'https?://[^\\s<>"]+|www\\.[^\\s<>"]+')), 'bare_text' from p)
    select filename as source_doc, parent as source_section, seq as source_paragraph_index, trim(a) as matched_text, t as reference_type, trim(b) as target_reference, '' as resolution_status, u as target_url, '' as url_display_text, k as url_type from m""",
)
def x2_reference_records(spark: SparkSession, d: str) -> DataFrame:
    """The list of references and links of the documents."""
    return X.reference_records(elements(spark, d, "filename"), _PATTERNS)
