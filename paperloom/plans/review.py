"""Queries on packing, mappings, validation and review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import document_key
from paperloom.operators import controls as C
from paperloom.operators import mapping as M
from paperloom.operators import packing as B
from paperloom.operators import validation as V
from paperloom.plans.extraction import _ID, _P, _mentioned_context, _paragraphs
from paperloom.plans.registry import Registry
from paperloom.plans.structure import EL, elements
from paperloom.session import table

R = Registry()
query = R.query


@query(
    "b1_h1_parts",
    EL + """, p as (select *, count(case when level = 1 then 1 end) over (partition by doc_id order by seq) as part_no from el), g as (select doc_id, part_no, arg_min(text, seq) as heading, sum(length(text)) as own, count(*) as n from p group by 1, 2),
    w as (select *, max(part_no) over (partition by doc_id) as last, coalesce(max(case when part_no = 0 then own end) over (partition by doc_id), 0) as lo, coalesce(max(case when part_no = 0 then n end) over (partition by doc_id), 0) as ln from g),
    o as (select doc_id, greatest(part_no, 1)::bigint as part_no, case when part_no = 0 then 'Full Document' else heading end as heading, (own + case when part_no = 0 then 0 else lo end)::bigint as chars, (n + case when part_no = 0 then 0 else ln end)::bigint as paragraphs from w where part_no > 0 or last = 0)
    select *, round_even(chars / 1800.0, 1)::double as pages from o""",
)
def b1_h1_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts at headings of level 1, the preamble in each."""
    return B.split_at_h1(elements(spark, d))


_WALK = EL.replace("with ", "with recursive ", 1)


@query(
    "b4_oversized_parts",
    _WALK + """, n as (select *, count(case when level = 1 then 1 end) over (partition by doc_id order by seq) as s from el), l as (select doc_id, sum(case when s = 0 then length(text) else 0 end) as lead from n group by 1),
    h as (select n.*, lead, count(case when level = 2 then 1 end) over (partition by n.doc_id, s order by seq) as g, sum(length(text)) over (partition by n.doc_id, s) as whole from n join l on n.doc_id = l.doc_id where s > 0),
    u as (select doc_id, s, case when lead + whole > 3000 then g else 0 end as g, lead, arg_min(text, seq) as heading, sum(length(text)) as chars, count(*) as elements from h group by 1, 2, 3, 4),
    r as (select *, row_number() over (partition by doc_id, s order by g) as k from u),
    w as (select doc_id, s, k, 0::bigint as part_no, heading, chars::hugeint as chars, elements from r where k = 1
      union all select r.doc_id, r.s, r.k, w.part_no + b.b, case when b.b = 1 then r.heading else w.heading end, r.chars + case when b.b = 1 then 0 else w.chars end, r.elements + case when b.b = 1 then 0 else w.elements end
      from w join r on r.doc_id = w.doc_id and r.s = w.s and r.k = w.k + 1, lateral (select case when r.lead + w.chars > 3000 then 1 else 0 end as b) b)
    select doc_id || '/' || s as section, part_no, any_value(heading) as heading, max(chars)::bigint as chars, max(elements)::bigint as elements from w group by 1, 2""",
)
def b4_oversized_parts(spark: SparkSession, d: str) -> DataFrame:
    """Sections over the limit cut at level 2 (limit 3,000 here)."""
    return B.split_oversized(elements(spark, d), 3_000)


@query("b7_chunks")
def b7_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks for retrieval with overlap."""
    return B.document_chunks(elements(spark, d))


@query(
    "b11_markdown_files",
    _WALK + """, n as (select *, count(level) over (partition by doc_id order by seq) as n from el), u as (select doc_id, n, arg_min(text, seq) as heading, sum(length(text) + 1) as chars from n group by 1, 2), r as (select *, row_number() over (partition by doc_id order by n) as k from u),
    w as (select doc_id, k, 0::bigint as file_no, heading, chars::hugeint as chars, 1::bigint as sections from r where k = 1
      union all select r.doc_id, r.k, w.file_no + b.b, r.heading, r.chars + case when b.b = 1 then 0 else w.chars end, 1 + case when b.b = 1 then 0 else w.sections end from w join r on r.doc_id = w.doc_id and r.k = w.k + 1, lateral (select case when w.chars + r.chars > 4000 then 1 else 0 end as b) b)
    select doc_id, file_no, arg_max(heading, k) as heading, max(chars)::bigint as chars, max(sections) as sections from w group by 1, 2""",
)
def b11_markdown_files(spark: SparkSession, d: str) -> DataFrame:
    """Sections packed greedily into files of at most 4,000 characters."""
    return B.packed_markdown(elements(spark, d), 4_000)


@query(
    "b13_batches",
    """with r as (select p_brand, p_partkey, (row_number() over (partition by p_brand order by p_partkey) - 1) // 50 as k from part), g as (select p_brand, min(p_partkey) as f, max(k) as l from r group by 1),
    b as (select *, coalesce(sum(l + 1) over (order by f, p_brand rows between unbounded preceding and 1 preceding), 0) as before from g)
    select r.p_brand, r.p_partkey, (before + k + 1)::bigint as batch_no, case when l > 0 then r.p_brand || ' (part ' || (k + 1) || ')' else r.p_brand end as batch_name from r join b on r.p_brand = b.p_brand""",
)
def b13_batches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each group in batches of 50."""
    return B.batches(table(spark, d, "part"), "p_brand", "p_partkey", 50)


# Units are families, or of larger ones the runs of one identifier with its enhancements; a walk puts them into chunks.
_FAMILY_CHUNKS = """with recursive m as (select source_file as collection, regexp_extract(control_id, '^([A-Z]+)', 1) as family, row_id as ord, control_id as id, coalesce(length(control_description), 0) as chars, regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 1) as p,
  coalesce(try_cast(regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 2) as int), 0) as n, list_transform(regexp_extract_all(regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 3), '[0-9]+'), lambda x: x::int) as e from control_row),
f as (select collection, family, min(ord) as first, count(*) > 30 or sum(chars) > 7000 as large from m group by 1, 2),
o as (select m.*, first, large, trim(regexp_replace(id, '\\(.*$', '')) as base, row_number() over (partition by m.collection order by first, m.family, p, n, e, id, ord) as k from m join f on m.collection = f.collection and m.family = f.family),
s as (select *, case when family is distinct from lag(family) over (partition by collection order by k) or (large and base is distinct from lag(base) over (partition by collection order by k)) then 1 else 0 end as new from o),
t as (select *, sum(new) over (partition by collection order by k) as unit from s),
u as (select collection, unit, any_value(family) as family, bool_or(large) as large, count(*) as members, sum(chars) as chars from t group by 1, 2),
w as (select collection, unit, family, large, 0::bigint as chunk_no, members, chars::hugeint as chars from u where unit = 1
  union all select u.collection, u.unit, u.family, u.large, w.chunk_no + b.b, u.members + case when b.b = 1 then 0 else w.members end, u.chars + case when b.b = 1 then 0 else w.chars end
  from w join u on u.collection = w.collection and u.unit = w.unit + 1, lateral (select case when u.large <> w.large or (u.large and u.family <> w.family) or w.members + u.members > 30 or w.chars + u.chars > 7000 then 1 else 0 end as b) b)
select collection, chunk_no, string_agg(family, '+' order by f_at) as families, max(m)::bigint as members, max(c)::bigint as chars from (select collection, chunk_no, family, min(unit) as f_at, max(members) as m, max(chars) as c from w group by 1, 2, 3) group by 1, 2"""


@query("b15_family_chunks", _FAMILY_CHUNKS)
def b15_family_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Families of identifiers packed under two budgets, one collection for each file."""
    rows = table(spark, d, "control_row").select(
        F.col("source_file").alias("collection"), F.regexp_extract("control_id", "^([A-Z]+)", 1).alias("family"), F.col("row_id").alias("ord"), F.col("control_id").alias("id"), F.coalesce(F.length("control_description"), F.lit(0)).alias("chars")
    )
    return B.family_chunks(rows, 30, 7_000)


@query("b17_natural_order", "with k as (select distinct control_id, regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 1) as p, coalesce(try_cast(regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 2) as int), 0) as n, list_transform(regexp_extract_all(regexp_extract(control_id, '^([A-Za-z&]+)[-. ]?0*([0-9]*)(.*)$', 3), '[0-9]+'), lambda x: x::int) as e from control_row) select control_id, row_number() over (partition by p order by n, e, control_id) as place from k")
def b17_natural_order(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers in natural order within their family."""
    from pyspark.sql import Window

    rows = table(spark, d, "control_row").select("control_id").distinct().withColumn("_k", B.natural_key(F.col("control_id")))
    return rows.select("control_id", F.row_number().over(Window.partitionBy("_k.p").orderBy("_k.n", "_k.e", "_k.i")).cast("bigint").alias("place"))


@query("j20_pairs", "with s as (select distinct n_name as source from nation), t as (select distinct r_name as target from region), p as (select source, target, row_number() over (order by source, target) as number from s cross join t) select *, printf('%02d_', number) || regexp_replace(source, '[^A-Za-z0-9]+', '_', 'g') || '_x_' || regexp_replace(target, '[^A-Za-z0-9]+', '_', 'g') as label from p")
def j20_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every batch of the source against every chunk of the target, numbered."""
    names = lambda t, c: table(spark, d, t).select(F.col(c).alias("name")).distinct()
    return B.pairs_of(names("nation", "n_name"), names("region", "r_name"))


_MATCHES = "with m as (select l_suppkey as source_id, l_partkey as target_id, case l_returnflag when 'A' then 'high' when 'N' then 'medium' else 'low' end as confidence, l_orderkey * 10 + l_linenumber as ord from lineitem), r as (select *, case confidence when 'high' then 0 when 'medium' then 1 else 2 end as rk from m), b as (select source_id, target_id, min(struct_pack(r := rk, o := ord, c := confidence)) as b, min(ord) as f from r group by 1, 2), g as (select source_id, target_id, b.c as confidence, row_number() over (partition by source_id order by b.r, f, target_id) as place from b)"


def _merged(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("l_returnflag") == "A", "high").when(F.col("l_returnflag") == "N", "medium").otherwise("low")
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("target_id"), level.alias("confidence"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return M.merge_matches(rows)


@query("m2_merged_matches", _MATCHES + " select * from g")
def m2_merged_matches(spark: SparkSession, d: str) -> DataFrame:
    """M2: the best answer for each pair, in rank order."""
    return _merged(spark, d)


@query("m4_gaps", _MATCHES + " select p_partkey as target_id from part where p_partkey not in (select target_id from g where confidence in ('high', 'medium'))")
def m4_gaps(spark: SparkSession, d: str) -> DataFrame:
    """M4, M6: targets without covering answer."""
    return M.gaps(_merged(spark, d), table(spark, d, "part").select(F.col("p_partkey").alias("target_id")))


@query("m5_full_mapping", _MATCHES + " select source_id, count(case when confidence in ('high', 'medium') then 1 end)::bigint as covered, coalesce(string_agg(case when confidence in ('high', 'medium') then target_id::varchar end, chr(10) order by place), '') as targets, count(case when confidence in ('high', 'medium') then 1 end) = 0 as unique_to_source from g group by 1")
def m5_full_mapping(spark: SparkSession, d: str) -> DataFrame:
    """M5: one row for each source with its covering targets."""
    return M.full_mapping(_merged(spark, d))


@query("m3_completeness", "with a as (select distinct filename as k from documents), b as (select distinct filename as k from tracked_change where filename is not null union select distinct document from acronym_per_document where document like 'P%') select k, 'missing' as state from a where k not in (select k from b) union all select k, 'extra' from b where k not in (select k from a)")
def m3_completeness(spark: SparkSession, d: str) -> DataFrame:
    """M3: expected names without answer, and answers without expected name."""
    found = table(spark, d, "tracked_change").select(F.col("filename").alias("k")).unionByName(table(spark, d, "acronym_per_document").where("document like 'P%'").select(F.col("document").alias("k"))).where("k is not null")
    return M.completeness(table(spark, d, "documents").select(F.col("filename").alias("k")), found, "k")


@query("m3_stale_results", "select distinct regexp_replace(filename, '\\.[^.]*$', '') || '_result.json' as name from documents where regexp_replace(filename, '\\.[^.]*$', '') not in (select regexp_replace(filename, '\\.[^.]*$', '') from tracked_change where filename is not null)")
def m3_stale_results(spark: SparkSession, d: str) -> DataFrame:
    """M3: result files without a batch."""
    results = table(spark, d, "documents").select(F.concat(F.regexp_replace("filename", r"\.[^.]*$", ""), F.lit("_result.json")).alias("name"))
    return M.stale_results(table(spark, d, "tracked_change").where("filename is not null").select(F.col("filename").alias("name")), results)


@query(
    "m6_coverage_check",
    _MATCHES + """, c as (select * from g where confidence in ('high', 'medium')), s as (select distinct s_suppkey as k from supplier), t as (select distinct p_partkey as k from part),
    a as (select 'source' as side, (select count(*) from s) as total, (select count(distinct source_id) from c) as covered, (select count(*) from s where k not in (select source_id from c)) as uncovered union all select 'target', (select count(*) from t), (select count(distinct target_id) from c), (select count(*) from t where k not in (select target_id from c)))
    select side, total, covered, uncovered, covered + uncovered = total as consistent, covered / nullif(total, 0)::double as covered_share from a""",
)
def m6_coverage_check(spark: SparkSession, d: str) -> DataFrame:
    """M6: whether covered and uncovered identifiers make up each side."""
    return M.coverage_check(_merged(spark, d), table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id")), table(spark, d, "part").select(F.col("p_partkey").alias("target_id")))


@query("m8_first_of_sources", "select control_id, row_id, extraction_source from (select *, row_number() over (partition by control_id order by case extraction_source when 'table' then 0 else 1 end, row_id) as n from (select control_id, row_id, extraction_source from control_row where control_id is not null and extraction_source is not null)) where n = 1")
def m8_first_of_sources(spark: SparkSession, d: str) -> DataFrame:
    """M8: the first row of each identifier, those from tables before the others."""
    rows = table(spark, d, "control_row").where("control_id is not null and extraction_source is not null").select("control_id", "row_id", "extraction_source")
    return M.first_of_sources([rows.where("extraction_source = 'table'"), rows.where("extraction_source <> 'table'")], "control_id", "row_id")


@query("m7_broad_targets", _MATCHES + ", c as (select target_id, count(*) as sources, count(distinct source_id % 7) as families, count(case when confidence = 'medium' then 1 end) as medium from g where confidence in ('high', 'medium') group by 1), f as (select *, concat_ws(', ', case when sources >= 15 then 'very broad' when sources >= 10 then 'broad' end, case when families >= 3 then 'cross family' end, case when medium = sources and medium >= 3 then 'medium only' end) as flags from c) select * from f where flags <> ''")
def m7_broad_targets(spark: SparkSession, d: str) -> DataFrame:
    """M7: targets that many sources name."""
    return M.broad_targets(_merged(spark, d), F.col("source_id") % 7)


@query("m9_family_codes", "select coalesce(nullif(regexp_extract(control_id, '^([A-Z]{2,4})[-.]', 1), ''), '(none)') as family, count(*) as controls from control_row group by 1")
def m9_family_codes(spark: SparkSession, d: str) -> DataFrame:
    """Families of identifiers."""
    return table(spark, d, "control_row").groupBy(F.coalesce(M.family_code(F.col("control_id")), F.lit("(none)")).alias("family")).agg(F.count(F.lit(1)).alias("controls"))


_MENTIONS = f"with p as ({_P}), x as (select distinct package_name as file, unnest(regexp_extract_all(t, '{_ID}')) as control_id from p)"


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return _paragraphs(spark, d).select(F.col("package_name").alias("file"), F.explode(C.control_ids(F.col("text"))).alias("control_id")).distinct()


@query("v1_places_of_ids", _MENTIONS + " select control_id, string_agg(file, ', ' order by file) as files from x group by 1")
def v1_places_of_ids(spark: SparkSession, d: str) -> DataFrame:
    """V1: the packages that mention each identifier."""
    return V.places_of_ids(_mentions(spark, d))


_PARENT = "lower(trim(regexp_replace(regexp_replace(split_part(regexp_replace({0}, '\\.[^. ]*$', ''), ' - ', 1), '(_fixed|_optimized|_backup)$', '', 'i'), '[_\\-\\s]+', ' ', 'g')))"


@query(
    "v2_control_status",
    _MENTIONS + f""", c as (select distinct control_id, {_PARENT.format('source_file')} as parent from control_row), s as (select control_id, {_PARENT.format('file')} as fp, count(*) as n from x group by 1, 2)
    select c.control_id, c.parent, coalesce(sum(n), 0)::bigint as found_in, case when coalesce(sum(n), 0) = 0 then 'MISSING' when coalesce(bool_or(fp = c.parent), false) then 'PASS' else 'RELOCATED' end as status from c left join s on c.control_id = s.control_id group by 1, 2""",
)
def v2_control_status(spark: SparkSession, d: str) -> DataFrame:
    """Whether each control is found, and in a part of its own parent, by the whole name of the document."""
    controls = table(spark, d, "control_row").select("control_id", document_key(F.col("source_file")).alias("parent"))
    mentions = _mentions(spark, d).select("control_id", "file", document_key(F.col("file")).alias("file_parent"))
    return V.status_of(controls, mentions)


_like = lambda column, words: "(" + " or ".join(f"contains({column}, '{w}')" for w in words) + ")"
_SUSPECT = ("revision history", "framework crosswalk", "references", "glossary", "definitions", "document control")
_LOSS = {
    "EMPTY_DESCRIPTION": 40, "SHORT_DESCRIPTION": 30, "LONG_DESCRIPTION": 20, "SUSPECT_SECTION": 35, "APPENDIX_SECTION": 15, "DUPLICATE_ID_SAME_DOC": 25, "DUPLICATE_ID_CROSS_DOC": 10, "TABLE_HEADERS_IN_DESC": 20, "GUIDANCE_IN_DESC": 15, "TABLE_SOURCE": 10,
    "EMPTY_BASELINE": 10, "EMPTY_NAME": 5,
}
_FLAGS = [
    ("EMPTY_DESCRIPTION", "t = ''"), ("SHORT_DESCRIPTION", "length(t) > 0 and length(t) < 20"), ("LONG_DESCRIPTION", "length(t) > 2000"), ("SUSPECT_SECTION", _like("s", _SUSPECT)),
    ("APPENDIX_SECTION", f"not {_like('s', _SUSPECT)} and contains(s, 'appendix')"), ("DUPLICATE_ID_SAME_DOC", "same > 1"), ("DUPLICATE_ID_CROSS_DOC", "same = 1 and total > 1"),
    ("TABLE_HEADERS_IN_DESC", _like("lower(t)", ("control id", "nist mapping", "implementation status", "responsible party", "framework ref", "control family"))),
    ("GUIDANCE_IN_DESC", _like("lower(t)", ("implementation guidance", "implementation:", "guidelines:", "how to implement", "supplemental guidance"))), ("TABLE_SOURCE", "src = 'table'"), ("EMPTY_BASELINE", "b = '' and any_b"), ("EMPTY_NAME", "nm = '' and any_n"),
]
_SCORED = f"""with c as (select row_id, source_file, status, trim(coalesce(control_id, '')) as id, trim(coalesce(source_file, '')) as f, trim(coalesce(control_description, '')) as t, lower(trim(coalesce(section_header, ''))) as s, trim(coalesce(baseline, '')) as b, trim(coalesce(control_name, '')) as nm, lower(trim(coalesce(extraction_source, ''))) as src
  from (select *, case row_id % 7 when 0 then 'Wrong-FalsePositive' when 1 then '' when 2 then null else 'Correct' end as status from control_row)),
w as (select *, count(*) over (partition by id, f) as same, count(*) over (partition by id) as total, bool_or(b <> '') over (partition by f) as any_b, bool_or(nm <> '') over (partition by f) as any_n from c),
fl as (select *, list_filter([{', '.join(f"case when {c} then '{n}' end" for n, c in _FLAGS)}], lambda x: x is not null) as flags,
  greatest(100 - ({' + '.join(f"case when {c} then {_LOSS[n]} else 0 end" for n, c in _FLAGS)}), 0)::bigint as score from w)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("row_id") % 7
    status = F.when(kind == 0, V.WRONG).when(kind == 1, "").when(kind != 2, "Correct")
    return V.confidence(table(spark, d, "control_row").withColumn("status", status))


@query("v4_confidence", _SCORED + " select row_id, score, array_to_string(flags, ', ') as flags, case when score <= 30 then 'low' when score <= 60 then 'medium' else 'high' end as band from fl")
def v4_confidence(spark: SparkSession, d: str) -> DataFrame:
    """V4, V5: the confidence of every record, its flags and band."""
    return _scored(spark, d).select("row_id", "score", F.array_join("flags", ", ").alias("flags"), V.band(F.col("score")).alias("band"))


@query("v6_review_summary", _SCORED + " select coalesce(source_file, '(all)') as source_file, count(*) as controls, sum(score)::bigint as score_sum, count(case when score <= 30 then 1 end) as low, count(case when score > 30 and score <= 60 then 1 end) as medium, count(case when score > 60 then 1 end) as high from fl group by rollup (source_file)")
def v6_review_summary(spark: SparkSession, d: str) -> DataFrame:
    """V6: totals, and the same for every file."""
    return V.review_summary(_scored(spark, d))


@query("v6_flag_counts", _SCORED + " select flag, count(*) as n from (select unnest(flags) as flag from fl) group by 1")
def v6_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    """V6: how often each flag is set."""
    return V.flag_counts(_scored(spark, d))


@query(
    "v7_source_context",
    f"""with p as ({_P}), x as (select package_name, copy_no, para_index, unnest(regexp_extract_all(t, '{_ID}')) as control_id from p where location = 'body'), f as (select control_id, min(struct_pack(a := package_name, c := copy_no, b := para_index)) as f from x group by 1)
    select control_id, string_agg(case when para_index = f.b then '>>> ' else '    ' end || t, chr(10) order by para_index) as context from f join p on p.location = 'body' and package_name = f.a and copy_no = f.c and para_index between f.b - 3 and f.b + 3 group by 1""",
)
def v7_source_context(spark: SparkSession, d: str) -> DataFrame:
    """V7: the paragraphs around the first mention of each control."""
    return _mentioned_context(spark, d)


@query("r1_confirmed", _SCORED + " select row_id, coalesce(status, '(none)') as status from fl where status is distinct from 'Wrong-FalsePositive'")
def r1_confirmed(spark: SparkSession, d: str) -> DataFrame:
    """Records without those that reviewers called wrong."""
    rows = _scored(spark, d)
    out = V.confirmed(rows.drop("status"), rows.select("row_id", "status", F.lit(0).alias("ord")), rows.drop("status").where("false"), ["row_id"])
    return out.select("row_id", F.coalesce("status", F.lit("(none)")).alias("status"))


@query("r2_status_counts", _SCORED + " select coalesce(nullif(trim(status), ''), '(unreviewed)') as status, count(*) as n from fl group by 1")
def r2_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """R2: records by verdict."""
    return V.status_counts(_scored(spark, d))


@query("r3_error_patterns", _SCORED + " select s as pattern, count(*) as wrong from fl where status = 'Wrong-FalsePositive' group by 1 having count(*) >= 3")
def r3_error_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Sections in which records are often wrong."""
    return V.error_patterns(_scored(spark, d), F.lower(F.trim(F.coalesce("section_header", F.lit("")))))


@query("r6_flag_precision", _SCORED + " select flag, count(*) as flagged, count(case when status = 'Wrong-FalsePositive' then 1 end) as wrong from (select status, unnest(flags) as flag from fl) group by 1")
def r6_flag_precision(spark: SparkSession, d: str) -> DataFrame:
    """How often a flagged record is wrong."""
    return V.flag_precision(_scored(spark, d))


@query("r7_file_accuracy", _SCORED + " select source_file, count(case when coalesce(trim(status), '') <> '' then 1 end) as reviewed, count(case when status = 'Wrong-FalsePositive' then 1 end) as wrong from fl group by 1")
def r7_file_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts by file."""
    return V.file_accuracy(_scored(spark, d))


@query("r4_flag_correlation", _SCORED + " select count(*) as errors, count(case when list_contains(flags, 'TABLE_SOURCE') then 1 end) as with_flag, count(case when list_contains(flags, 'TABLE_SOURCE') then 1 end) / nullif(count(*), 0)::double as share from fl where trim(status) = 'Wrong-FalsePositive'")
def r4_flag_correlation(spark: SparkSession, d: str) -> DataFrame:
    """How many of the wrong records carry a flag."""
    return V.flag_correlation(_scored(spark, d), (V.WRONG,), "TABLE_SOURCE")


@query("r5_missing_patterns", "with m as (select source_file, section_header from control_row where not contains(coalesce(control_id, ''), '-')), u as (select 'file' as kind, trim(source_file, ' ') as value from m union all select 'section', lower(trim(section_header, ' ')) from m) select kind, value, count(*) as n from u where value <> '' group by 1, 2")
def r5_missing_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose identifier is not in the usual style, by file and by section."""
    return V.missing_patterns(table(spark, d, "control_row").where(~F.contains(F.coalesce("control_id", F.lit("")), F.lit("-"))))


@query("k19_suggestions", _SCORED + f""", a as (select 'suspect_section' as type, s as value, count(*) as n from fl where status = 'Wrong-FalsePositive' group by 2 having count(*) >= 3), b as (select count(case when list_contains(flags, 'TABLE_SOURCE') then 1 end) as n from fl where trim(status) = 'Wrong-FalsePositive'),
    cp as (select 'control_id_pattern' as type, trim(control_id, ' ') as value, count(*) as n from control_row where not regexp_full_match(trim(control_id, ' '), '{_ID}') group by 2)
    select * from a union all select 'guidance_keywords', 'GUIDANCE_IN_DESC', n from b where n >= 3 union all select * from cp where value <> ''""")
def k19_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """What the verdicts suggest to change."""
    from paperloom.plans.extraction import r5_bad_ids

    rows = _scored(spark, d)
    patterns = V.error_patterns(rows, F.lower(F.trim(F.coalesce("section_header", F.lit("")))))
    return V.suggestions(patterns, V.flag_correlation(rows, (V.WRONG,), "TABLE_SOURCE"), r5_bad_ids(spark, d))


@query("b5_parts_as_they_are", "select doc_id, 1::bigint as part_no, length(text)::bigint as chars from documents where text is not null")
def b5_parts_as_they_are(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are passed on uncut."""
    return B.passed_through(table(spark, d, "documents").where("text is not null"), "doc_id", "text")
