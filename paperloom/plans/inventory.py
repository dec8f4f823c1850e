"""Queries on tables in texts, types, priorities, and the lists and sheets that people read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import inventory as I
from paperloom.operators import profile as G
from paperloom.operators import validation as V
from paperloom.operators.headings import section_extents
from paperloom.plans import structure as S
from paperloom.plans.extraction import _ID, _P, _mentioned_context
from paperloom.plans.registry import Registry
from paperloom.plans.review import _SCORED, _scored
from paperloom.plans.structure import _EXTENTS, EL, _long, elements, section_kind_sql
from paperloom.session import table
from paperloom.sources.text import text_tables

R = Registry()
query = R.query

_CLASSES = {
    "control_matrix": (3, ("control id", "control", "requirement", "framework", "nist", "status", "implementation", "responsible", "owner")),
    "applicability_table": (2, ("applies to", "applicability", "system", "environment", "in scope", "yes", "no", "n/a")),
    "reference_table": (2, ("term", "definition", "acronym", "glossary", "abbreviation", "description")),
    "crosswalk_table": (3, ("nist", "cis", "cmmc", "iso", "mapping", "alignment", "framework")),
    "role_responsibility": (2, ("role", "responsibility", "responsible", "accountable", "raci")),
}
_SCORES = [f"case when cols >= {least} then {' + '.join(f'''contains(h, '{w}')::int''' for w in words)} else 0 end" for least, words in _CLASSES.values()]
_BEST = f"case when greatest({', '.join(_SCORES)}) = 0 then 'unclassified' " + " ".join(f"when {s} = greatest({', '.join(_SCORES)}) then '{n}'" for s, n in zip(_SCORES, _CLASSES, strict=True)) + " end"
#: Tables of texts as ``tp``, and the totals of each document as ``ts``.
_TABLES = f"""tl as (select doc_id, seq, list_transform(string_split(text, chr(9)), lambda c: trim(c, ' ')) as cells from ln where len(list_filter(string_split(text, chr(9)), lambda c: trim(c, ' ') <> '')) >= 2),
ti as (select *, seq - row_number() over (partition by doc_id order by seq) as island from tl),
tg as (select *, dense_rank() over (partition by doc_id order by island) - 1 as table_idx from ti),
tq as (select doc_id, table_idx, count(*) as n_rows, max(len(cells)) as cols, sum(list_sum(list_transform(cells, lambda x: length(x)))) as chars, sum(list_sum(list_transform(cells, lambda x: len(list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> ''))))) as words,
  arg_min(array_to_string(cells, ' | '), seq) as header_row, lower(array_to_string(list_transform(arg_min(cells, seq), lambda x: left(trim(x, ' '), 100)), ' ')) as h from tg group by 1, 2),
tp as (select *, {_BEST} as class from tq),
tc as (select doc_id, class, count(*) as n, sum(chars) as chars, sum(words) as words from tp group by 1, 2),
ts as (select doc_id, sum(n)::bigint as tables, sum(chars)::bigint as table_chars, sum(words)::bigint as table_words, string_agg(class || ': ' || n, '; ' order by class) as classes from tc group by 1)"""
_REFS = {
    "see section\\s+[0-9.]+[a-z]?": "See section reference", "refer to\\s+(section|the)": "Refer to clause/section", "as described in\\s+(the|section)": "As described in reference", "per section\\s+[0-9.]+": "Per section reference",
    "in accordance with\\s+(the|section)": "In accordance with", "as defined in\\s+(the|section)": "As defined in reference", "as outlined in\\s+(the|section)": "As outlined in reference", "per the organization''?s\\s+\\w+": "Per organization document",
    "see the\\s+\\w+\\s+policy": "See policy reference", "as specified in\\s+(the|section)": "As specified in reference",
}
#: References of lines as ``mk``, and their number for each document as ``rc``.
_MARKS = (
    "mk as (" + " union all ".join(f"select doc_id, seq, unnest(regexp_extract_all(text, '(?i){p}')) as cross_ref_text, '{label}' as pattern_matched from ln" for p, label in _REFS.items()) + "),"
    " rq as (select doc_id, pattern_matched, count(*) as n from mk group by 1, 2), rc as (select doc_id, sum(n)::bigint as cross_refs, string_agg(pattern_matched || ': ' || n, '; ' order by pattern_matched) as patterns from rq group by 1)"
)


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return G.table_profile(text_tables(table(spark, d, "documents")))


@query("g5_table_stats", EL + ", " + _TABLES + " select doc_id, tables, table_chars, table_words, 0::bigint as merged_tables, classes from ts")
def g5_table_stats(spark: SparkSession, d: str) -> DataFrame:
    """Tables of every document with their size and class."""
    stats = G.table_stats(_tables(spark, d))
    return stats.select("doc_id", "tables", "table_chars", "table_words", "merged_tables", I._text_of(F.col("classes")).alias("classes"))


@query("g6_reference_counts", "with ln as (select row_id as doc_id, 0 as seq, supplemental_guidance as text from control_row where supplemental_guidance is not null), " + _MARKS + " select doc_id, cross_refs, patterns from rc")
def g6_reference_counts(spark: SparkSession, d: str) -> DataFrame:
    """References of the guidance of every control by label."""
    texts = table(spark, d, "control_row").select(F.col("row_id").alias("doc_id"), F.lit(0).alias("seq"), F.col("supplemental_guidance").alias("text"))
    return I.reference_counts(texts).select("doc_id", "cross_refs", I._text_of(F.col("cross_ref_patterns")).alias("patterns"))


_TYPES = S._TYPE_SQL + ", " + _TABLES + """, ty as (select z.doc_id, case when 100 * appendix_chars >= 60 * total then 'D' when 100 * coalesce(table_chars, 0) >= 40 * total then 'A' when 100 * coalesce(table_chars, 0) > 10 * total then 'C' when hits >= 2 then 'C' else 'B' end as doc_type, cast(hits as bigint) as procedure_hits,
  appendix_chars * 100 // total as ap, coalesce(table_chars, 0) * 100 // total as tb from z left join ts on z.doc_id = ts.doc_id),
tr as (select doc_id, doc_type, procedure_hits, case doc_type when 'D' then 'appendix ' || ap || '%' when 'A' then 'tables ' || tb || '%' else 'tables ' || tb || '%, procedure words ' || procedure_hits end as reason from ty)"""


@query("g10_document_types", _EXTENTS + _TYPES + " select * from tr")
def g10_document_types(spark: SparkSession, d: str) -> DataFrame:
    """The type of every document by appendix share, table share and procedure words."""
    return G.document_types(section_extents(elements(spark, d)), table(spark, d, "documents"), G.table_stats(_tables(spark, d)))


_RANKED = f"""{_EXTENTS}, {_TABLES}, {_MARKS}, k as (select x.doc_id, any_value(el.filename) as filename, count(distinct case when {section_kind_sql('heading')} <> 'none' then {section_kind_sql('heading')} end) as kinds from x join el on x.doc_id = el.doc_id group by 1),
f as (select doc_id, count(case when fake then 1 end) as fakes, count(*) as paragraphs, sum(length(text)) as chars from el group by 1),
sc as (select k.doc_id, filename, coalesce(tables, 0) * 2.0 + coalesce(cross_refs, 0) * 1.5 + (5 - kinds) * 1.5 + fakes * 1.0 + round_even(paragraphs / 30.0, 1) * 0.5 + case when chars > 36000 then 3 else 0 end as score
  from k join f on k.doc_id = f.doc_id left join ts on k.doc_id = ts.doc_id left join rc on k.doc_id = rc.doc_id)
select doc_id, filename, cast(round(score * 100) as bigint) as score_100, row_number() over (order by cast(round(score * 100) as bigint) desc, filename) as priority_rank from sc"""


@query("a0_ranked_profile", _RANKED)
def a0_ranked_profile(spark: SparkSession, d: str) -> DataFrame:
    """G12 and the ranking: documents by how much work they need, all six weights."""
    rows = elements(spark, d, "filename")
    stats = G.table_stats(_tables(spark, d))
    return G.ranked(G.priority_scores(rows, section_extents(rows), tables=stats, refs=I.reference_counts(rows)))


_g = S.R.sql
_INVENTORY = f"""select r.priority_rank, r.score_100, a.doc_id, r.filename, t.doc_type, t.reason, a.chars, a.words, a.paragraphs, a.pages, a.over_limit, coalesce(h.headings, 0) as headings, coalesce(h.h1, 0) as h1, coalesce(h.h2, 0) as h2, coalesce(h.h3, 0) as h3, coalesce(h.fake_headings, 0) as fake_headings,
  coalesce(h.builtin_headings, 0) as builtin_headings, has_purpose, has_scope, has_intent, has_controls, has_appendix, missing, largest_section, largest_chars, controls_chars, appendix_chars, coalesce(s.tables, 0) as tables, coalesce(s.table_chars, 0) as table_chars, coalesce(s.table_words, 0) as table_words,
  0::bigint as merged_tables, s.classes as table_classes, 100 * coalesce(s.table_chars, 0) >= 30 * greatest(a.chars, 1) as table_dense, coalesce(x.cross_refs, 0) as cross_refs, x.patterns as cross_ref_patterns, coalesce(c.ids, 0) as control_ids, coalesce(c.dense, false) as control_dense, v.reasons as heading_variance,
  coalesce(u.n, 0) as unique_section_count, u.sections as unique_sections, coalesce(t.procedure_hits, 0) as procedure_hits, q.term_ac, q.term_cloud, q.term_audit
from ({_g['g1_document_sizes']}) a join ({_RANKED}) r using (doc_id) left join ({_g['g2_heading_counts']}) h using (doc_id) left join ({_g['g3_standard_presence']}) p using (doc_id) left join ({_g['g4_largest_section']}) l using (doc_id) left join ({_g['g7_control_density']}) c using (doc_id)
left join ({_g['g8_heading_variance']}) v using (doc_id) left join ({_g['g9_unlabelled_sections']}) u using (doc_id) left join ({R.sql['g5_table_stats']}) s using (doc_id) left join ({EL}, {_MARKS} select doc_id, cross_refs, patterns from rc) x using (doc_id) left join ({R.sql['g10_document_types']}) t using (doc_id) left join ({_g['g13_search_terms']}) q using (doc_id)"""


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    return I.inventory(elements(spark, d, "filename"), table(spark, d, "documents"), _tables(spark, d), ("AC", "Cloud", "Audit"))


@query("k1_inventory", _INVENTORY)
def k1_inventory(spark: SparkSession, d: str) -> DataFrame:
    """K1: one wide row for each document."""
    return _inventory(spark, d)


_LINES = {
    "documents": "count(*)", **{f"type {t}": f"count(case when doc_type = '{t}' then 1 end)" for t in ("A", "B", "C", "D", "Error")}, "over limit": "count(case when over_limit then 1 end)", "with fake headings": "count(case when fake_headings > 0 then 1 end)", "with merged tables": "count(case when merged_tables > 0 then 1 end)",
    "with cross-references": "count(case when cross_refs > 0 then 1 end)", "missing standard sections": "count(case when missing <> '' then 1 end)", "control dense": "count(case when control_dense then 1 end)", "heading variance": "count(case when heading_variance <> '' then 1 end)",
    "table dense": "count(case when table_dense then 1 end)", "with unique sections": "count(case when unique_section_count > 0 then 1 end)", "average controls a page": "round(avg(control_ids / greatest(pages, 0.1)), 1)", "average characters": "round(avg(chars))", "average words": "round(avg(words))",
    "average pages": "round(avg(pages), 1)", "average tables": "round(avg(tables), 1)", "average cross-references": "round(avg(cross_refs), 1)", "total words": "sum(words)", "total tables": "sum(tables)", "total cross-references": "sum(cross_refs)",
}


@query("g17_inventory_summary", f"with i as ({_INVENTORY}), s as (select {', '.join(f'({e})::double as c{k}' for k, e in enumerate(_LINES.values()))} from i) select unnest([{', '.join(repr(k) for k in _LINES)}]) as label, unnest([{', '.join(f'c{k}' for k in range(len(_LINES)))}]) as value from s")
def g17_inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts by type and condition, averages and totals."""
    return I.corpus_summary(_inventory(spark, d))


@query(
    "k2_sections",
    _EXTENTS + f""", ow as (select doc_id, seq, text, coalesce(last_value(case when not fake and level <= 3 then seq end ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and current row), 0) as start_seq from el),
    rf as (select doc_id, start_seq, sum({' + '.join(f"len(regexp_extract_all(text, '(?i){p}'))" for p in _REFS)})::bigint as n from ow group by 1, 2)
    select el.filename, x.heading as section_heading, x.level as heading_level, el.style as heading_style, regexp_matches(el.style, '^Heading [0-9]$') as is_builtin_style, el.fake as is_fake_heading, {section_kind_sql('x.heading')} as standard_section, (own + end_seq - x.start_seq - 1)::bigint as char_count, end_seq - x.start_seq as paragraph_count, coalesce(rf.n, 0) as cross_ref_count
    from x join el on x.doc_id = el.doc_id and x.start_seq = el.seq left join rf on x.doc_id = rf.doc_id and x.start_seq = rf.start_seq""",
)
def k2_sections(spark: SparkSession, d: str) -> DataFrame:
    """K2: the list of sections."""
    return I.section_list(elements(spark, d, "filename"))


@query("k2_tables", EL + ", " + _TABLES + " select filename, table_idx as table_index, n_rows as rows, cols, class as classification, false as has_merged_cells, chars::bigint as char_count, header_row from tp join (select doc_id, filename from documents) using (doc_id)")
def k2_tables(spark: SparkSession, d: str) -> DataFrame:
    """K2: the list of tables."""
    return I.table_list(_tables(spark, d), table(spark, d, "documents").select("doc_id", "filename"))


@query("k2_crossrefs", EL + ", " + _MARKS + """, pp as (select doc_id, seq, filename, coalesce(last_value(case when level <= 2 then text end ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and 1 preceding), '(No heading found)') as parent_section from el)
    select filename, cross_ref_text, pattern_matched, seq as paragraph_index, parent_section from mk join pp using (doc_id, seq)""")
def k2_crossrefs(spark: SparkSession, d: str) -> DataFrame:
    """The list of references."""
    return I.crossref_list(elements(spark, d, "filename"))


_CONTEXT = f"""with p as ({_P}), x as (select package_name, copy_no, para_index, unnest(regexp_extract_all(t, '{_ID}')) as control_id from p where location = 'body'), f as (select control_id, min(struct_pack(a := package_name, c := copy_no, b := para_index)) as f from x group by 1)
    select control_id, string_agg(case when para_index = f.b then '>>> ' else '    ' end || t, chr(10) order by para_index) as context from f join p on p.location = 'body' and package_name = f.a and copy_no = f.c and para_index between f.b - 3 and f.b + 3 group by 1"""


@query(
    "k10_review_sheet",
    _SCORED + f""", cx as ({_CONTEXT}), k as (select score as "Confidence", array_to_string(flags, ', ') as "Flags", coalesce(o.control_id, '') as "Control ID", coalesce(o.source_file, '') as "Source File", coalesce(o.section_header, '') as "Section Header", coalesce(o.extraction_source, '') as "Extraction Source",
      coalesce(cx.context, '(Source document not available)') as "Source Context", coalesce(o.control_description, '') as "Extracted Description", coalesce(o.supplemental_guidance, '') as "Extracted Guidance", coalesce(o.baseline, '') as "Baseline", coalesce(o.control_name, '') as "Control Name", '' as "Validation Status", '' as "Reviewer Notes", fl.row_id as i
      from fl join control_row o on fl.row_id = o.row_id left join cx on o.control_id = cx.control_id)
    select * exclude (i), row_number() over (order by "Confidence", "Source File", "Control ID", i) as "Row #" from k""",
)
def k10_review_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The sheet that reviewers fill in."""
    return I.review_sheet(_scored(spark, d), _mentioned_context(spark, d))


@query("k10_missing_sheet", f"""with p as ({_P}), x as (select distinct unnest(regexp_extract_all(t, '{_ID}')) as control_id from p) select coalesce(control_id, '') as "Control ID", coalesce(source_file, '') as "Source File", coalesce(section_header, '') as "Section Header", coalesce(control_description, '') as "Control Description",
    coalesce(supplemental_guidance, '') as "Supplemental Guidance", coalesce(baseline, '') as "Baseline", coalesce(control_name, '') as "Control Name", '' as "Reviewer Notes" from control_row c where not exists (select 1 from x where x.control_id = c.control_id)""")
def k10_missing_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The controls that no paragraph mentions, in the columns of the sheet for missing ones."""
    from paperloom.plans.review import _mentions

    rows = table(spark, d, "control_row").join(_mentions(spark, d).select("control_id").distinct(), "control_id", "left_anti")
    names = {"Control ID": "control_id", "Source File": "source_file", "Section Header": "section_header", "Control Description": "control_description", "Supplemental Guidance": "supplemental_guidance", "Baseline": "baseline", "Control Name": "control_name", "Reviewer Notes": F.lit("")}
    return I.export_rows(rows, names)


_FAMILY_NAMES = {"AC": "Access Control", "AU": "Audit and Accountability", "CM": "Configuration Management", "SI": "System and Information Integrity"}
_t = lambda c: f"trim(coalesce({c}, ''), ' ')"


@query(
    "k17_export_rows",
    f"""with c as (select *, regexp_extract(upper(control_id), '^([A-Z]{{2,4}})[-.]', 1) as family from control_row), n as (select *, case family {' '.join(f"when '{k}' then '{v}'" for k, v in _FAMILY_NAMES.items())} else family end as family_name from c)
    select {', '.join(f"coalesce({c}, '') as {c}" for c in ("control_id", "control_name", "family", "family_name", "supplemental_guidance", "baseline", "purpose", "scope", "applicability", "compliance_date", "published_url"))}, coalesce(control_description, '') as description, 'catalog' as source,
      trim(concat_ws(chr(10), case when {_t('control_id')} <> '' then 'Control ' || {_t('control_id')} || case when {_t('control_name')} <> '' then ': ' || {_t('control_name')} else '' end end, case when {_t('family_name')} <> '' then 'Family: ' || {_t('family_name')} end, case when {_t('baseline')} <> '' then 'Baseline: ' || {_t('baseline')} end,
      {', '.join(f"case when {_t(c)} <> '' then chr(10) || '{label}:' || chr(10) || {_t(c)} end" for c, label in (("control_description", "Description"), ("supplemental_guidance", "Supplemental Guidance"), ("purpose", "Purpose"), ("scope", "Scope")))}, case when {_t('applicability')} <> '' then 'Applicability: ' || {_t('applicability')} end), ' ') as rag_content from n""",
)
def k17_export_rows(spark: SparkSession, d: str) -> DataFrame:
    """The 14 columns of the export, with the family's name and the text for retrieval."""
    from paperloom.operators.mapping import family_code, family_of
    from paperloom.operators.render import rag_content

    ident = F.upper("control_id")
    columns = {**{c: F.col(c) for c in ("control_id", "control_name")}, "family": family_code(ident), "family_name": family_of(ident, _FAMILY_NAMES), "description": F.col("control_description"), **{c: F.col(c) for c in ("supplemental_guidance", "baseline", "purpose", "scope", "applicability", "compliance_date", "published_url")}, "source": F.lit("catalog")}
    return I.export_rows(table(spark, d, "control_row"), {**columns, "rag_content": rag_content(columns)})


@query("g18_totals_over_limit", f"with p as ({_EXTENTS} select own + end_seq - start_seq - 1 as chars from x) select count(*) as parts, count(case when chars > 3000 then 1 end) as over_limit, max(chars)::bigint as largest from p")
def g18_totals_over_limit(spark: SparkSession, d: str) -> DataFrame:
    """Sections, how many are over a limit, and the largest."""
    return G.totals_over_limit(section_extents(elements(spark, d)), "chars", 3_000)


@query("g19_step_report", "select 'profile' as step, filename as file, count(case when len(errors) = 0 then 1 end) as rows, count(case when len(errors) > 0 then 1 end) as failures from (select distinct doc_id, filename, errors from document_profile) group by 1, 2")
def g19_step_report(spark: SparkSession, d: str) -> DataFrame:
    """What a step made of each file, and where it failed."""
    rows = table(spark, d, "document_profile").select("doc_id", "filename", "errors").distinct()
    return G.step_report(rows.withColumn("error", F.try_element_at("errors", F.lit(1))), "profile", "filename", "error")


@query("g20_all_keys", "select change_id as id, filename, author, rev_type, null as resolved from tracked_change union all select comment_key, filename, author, null, resolved from review_comment")
def g20_all_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows of several kinds with the keys of all."""
    changes = table(spark, d, "tracked_change").select(F.col("change_id").alias("id"), "filename", "author", "rev_type")
    return G.with_all_keys([changes, table(spark, d, "review_comment").select(F.col("comment_key").alias("id"), "filename", "author", "resolved")])
