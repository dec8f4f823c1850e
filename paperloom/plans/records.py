"""Queries on rewrites and ordered lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import lookups as J
from paperloom.operators import profile as G
from paperloom.operators import rewrite as W
from paperloom.plans.registry import Registry
from paperloom.plans.structure import EL, _long, elements
from paperloom.session import table

R = Registry()
query = R.query

PHRASES = ("in line with the", "at all times", "as agreed with")
#: Keywords of a lookup table, in order, with what each stands for.
SITES = (("policy library", "https://site/policies"), ("standards", "https://site/standards"), ("wiki", "https://site/wiki"), ("portal export", "https://site/portal"), ("export", "https://site/exports"))


def _sites(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, u) for k, (n, u) in enumerate(SITES)], "ord int, name string, url string")


@query("f1_filtered_controls", "select row_id, control_id from control_row where (starts_with(control_id, 'AC') or starts_with(control_id, 'AU') or control_id = 'SI 4.027') and not starts_with(control_id, 'AU 1')")
def f1_filtered_controls(spark: SparkSession, d: str) -> DataFrame:
    """controls by allowed and denied identifiers."""
    return W.apply_filters(table(spark, d, "control_row").select("row_id", "control_id"), "control_id", ("AC*", "AU*", "SI 4.027"), ("AU 1*",))


@query("f2_deleted_phrases", "select row_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(control_description, 'in line with the', '', 'gi'), 'at all times', '', 'gi'), 'as agreed with', '', 'gi'), '  +', ' ', 'g')) as text from control_row where control_description is not null")
def f2_deleted_phrases(spark: SparkSession, d: str) -> DataFrame:
    """descriptions without the phrases."""
    return table(spark, d, "control_row").where("control_description is not null").select("row_id", W.delete_phrases(F.col("control_description"), PHRASES).alias("text"))


@query("f2_phrase_log", "select phrase, count(*) as records from control_row, (select unnest(['in line with the', 'at all times', 'as agreed with']) as phrase) where contains(lower(control_description), phrase) group by 1")
def f2_phrase_log(spark: SparkSession, d: str) -> DataFrame:
    """records that hold each phrase."""
    return W.phrase_log(table(spark, d, "control_row"), "row_id", "control_description", PHRASES).groupBy("phrase").agg(F.count(F.lit(1)).alias("records"))


_DELETED = ", ".join(
    f"max(case when level = {k} and (contains(lower(trim(text)), 'glossary') or lower(trim(text)) = 'references' or contains(lower(trim(text)), 'revision history')) then seq end) over z a{k}, max(case when level <= {k} then seq end) over z c{k}"
    for k in (1, 2, 3, 4)
)


@query("f3_kept_lines", EL + f", w as (select doc_id, seq, {_DELETED} from el window z as (partition by doc_id order by seq rows between unbounded preceding and current row)) select doc_id, seq from w where not (coalesce(a1 = c1, false) or coalesce(a2 = c2, false) or coalesce(a3 = c3, false) or coalesce(a4 = c4, false))")
def f3_kept_lines(spark: SparkSession, d: str) -> DataFrame:
    """lines outside the deleted sections."""
    return _long(W.delete_sections(elements(spark, d), contains=("glossary", "revision history"), equals=("references",)), "doc_id", "seq")


@query("f4_revision_views", "select package_name, copy_no::bigint as copy_no, count(*) as paragraphs, cast(count(case when has_tracked_changes then 1 end) as bigint) as tracked, cast(sum(coalesce(length(accepted), 0)) as bigint) as accepted_chars, cast(sum(coalesce(length(rejected), 0)) as bigint) as rejected_chars from (select distinct * exclude (ingested_at) from paragraph) group by all")
def f4_revision_views(spark: SparkSession, d: str) -> DataFrame:
    """the accepted and rejected views of every package."""
    rows = table(spark, d, "paragraph").drop("ingested_at").distinct()
    size = lambda c: F.sum(F.coalesce(F.length(c), F.lit(0))).cast("bigint")
    return rows.groupBy("package_name", F.col("copy_no").cast("bigint").alias("copy_no")).agg(
        F.count(F.lit(1)).alias("paragraphs"), F.count_if("has_tracked_changes").alias("tracked"), size("accepted").alias("accepted_chars"), size("rejected").alias("rejected_chars")
    )


@query("f6_body_text", "select para_id, accepted from (select distinct para_id, location, accepted from paragraph) where not regexp_matches(location, '^(header|footer)[0-9]*$') and not (coalesce(regexp_matches(trim(accepted), '^Page\\s+[0-9]+(\\s+of\\s+[0-9]+)?$', 'i'), false) or coalesce(regexp_matches(trim(accepted), '^[0-9]+$'), false) or coalesce(regexp_matches(trim(accepted), '^-\\s*[0-9]+\\s*-$'), false)) and accepted is not null")
def f6_body_text(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs without headers, footers and page numbers."""
    rows = table(spark, d, "paragraph").select("para_id", "location", F.col("accepted").alias("text")).distinct().where("text is not null")
    return W.delete_page_numbers(W.delete_margins(rows)).select("para_id", F.col("text").alias("accepted"))


@query("f14_collapsed_texts", "select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '\\s+$', '') as text from documents where text is not null")
def f14_collapsed_texts(spark: SparkSession, d: str) -> DataFrame:
    """texts with at most one blank line between lines."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", W.collapse_blank_lines(F.col("text")).alias("text"))


@query("f17_open_orders", "select o_orderkey, o_orderpriority from orders where o_orderstatus not in ('F', 'P') and o_orderpriority is not null and o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1997-01-01'")
def f17_open_orders(spark: SparkSession, d: str) -> DataFrame:
    """equality, absence and range predicates, pushed to the scan."""
    o = table(spark, d, "orders")
    return o.where(~F.col("o_orderstatus").isin("F", "P") & F.col("o_orderpriority").isNotNull() & (F.col("o_orderdate") >= "1995-01-01") & (F.col("o_orderdate") < "1997-01-01")).select("o_orderkey", "o_orderpriority")


_KEY = "lower(trim(regexp_replace(regexp_replace(filename, '\\.[^.]*$', ''), '[_\\-\\s]+', ' ', 'g')))"


@query("j1_name_keys", f"select doc_id, {_KEY} as name_key, trim(regexp_replace({_KEY}, '(\\s+(v[0-9]+|r[0-9]+|\\([0-9]+\\)|final|draft|copy|latest))+$', '')) as pairing_key from documents")
def j1_name_keys(spark: SparkSession, d: str) -> DataFrame:
    """File names for comparison and for pairing."""
    name = F.col("filename")
    return table(spark, d, "documents").select("doc_id", T.name_key(name).alias("name_key"), T.pairing_key(name).alias("pairing_key"))


_SITE_ROWS = ", ".join(f"({k}, '{n}', '{u}')" for k, (n, u) in enumerate(SITES))
_SOURCE_KEY = "lower(trim(regexp_replace(source, '[_\\-\\s]+', ' ', 'g')))"


@query(
    "j3_first_match",
    f"""with s as (select * from (values {_SITE_ROWS}) t(ord, name, url)), d as (select doc_id, filename, {_SOURCE_KEY} k from documents),
    m as (select d.doc_id, d.filename, d.k, arg_min(url, ord) as url from d left join s on length(k) > 0 and (contains(k, name) or contains(name, k)) group by 1, 2, 3)
    select doc_id, coalesce(url, 'https://files/' || replace(filename, ' ', '_')) as url, case when url is null then 'template' else 'lookup' end as origin from m""",
)
def j3_first_match(spark: SparkSession, d: str) -> DataFrame:
    """The first entry whose name contains the source or is contained in it, else a template."""
    rows = table(spark, d, "documents").select("doc_id", "filename", F.lower(F.trim(F.regexp_replace("source", r"[_\-\s]+", " "))).alias("_k"))
    found = J.lookup_first(rows, "_k", _sites(spark), "name", "url", "ord")
    url, origin = J.with_fallbacks(F.col("found"), "https://files/{filename}", F.col("filename"))
    return found.select("doc_id", url.alias("url"), origin.alias("origin"))


@query(
    "j6_ranked_lookup",
    f"""with s as (select source, max_repeats from mix_target), d as (select doc_id, source, {_SOURCE_KEY} k from documents)
    select doc_id, coalesce((select any_value(s.max_repeats) from s where s.source = d.source), (select any_value(s.max_repeats) from s where replace(s.source, '_', ' ') = d.k))::bigint as most from d""",
)
def j6_ranked_lookup(spark: SparkSession, d: str) -> DataFrame:
    """An exact match goes before one by the normalised name."""
    target = table(spark, d, "mix_target").select("source", F.col("max_repeats").cast("bigint").alias("m"))
    rows = table(spark, d, "documents").select("doc_id", "source", F.lower(F.trim(F.regexp_replace("source", r"[_\-\s]+", " "))).alias("_k"))
    exact = target.select(F.col("source").alias("_s1"), F.col("m").alias("m1"))
    plain = target.select(F.replace("source", F.lit("_"), F.lit(" ")).alias("_s2"), F.col("m").alias("m2"))
    joined = rows.join(exact, F.col("source") == F.col("_s1"), "left").join(plain, F.col("_k") == F.col("_s2"), "left")
    return joined.select("doc_id", J.best_of(F.col("m1"), F.col("m2")).alias("most"))


@query(
    "j8_all_matches",
    f"""with s as (select * from (values {_SITE_ROWS}) t(ord, name, url)), d as (select doc_id, {_SOURCE_KEY} k from documents)
    select d.doc_id, coalesce(string_agg(url, ', ' order by ord), '') as urls from d left join s on length(k) > 0 and (contains(k, name) or contains(name, k)) group by 1""",
)
def j8_all_matches(spark: SparkSession, d: str) -> DataFrame:
    """All matching entries as one list."""
    rows = table(spark, d, "documents").select("doc_id", F.lower(F.trim(F.regexp_replace("source", r"[_\-\s]+", " "))).alias("_k"))
    return J.lookup_all(rows, "_k", _sites(spark), "name", "url", "ord").select("doc_id", F.array_join("found", ", ").alias("urls"))


@query("j10_one_way", f"with s as (select * from (values {_SITE_ROWS}) t(ord, name, url)), d as (select doc_id, {_SOURCE_KEY} k from documents) select d.doc_id, arg_min(url, ord) as url from d left join s on contains(k, name) group by 1")
def j10_one_way(spark: SparkSession, d: str) -> DataFrame:
    """The first entry whose name the source contains."""
    rows = table(spark, d, "documents").select("doc_id", F.lower(F.trim(F.regexp_replace("source", r"[_\-\s]+", " "))).alias("_k"))
    return J.lookup_first(rows, "_k", _sites(spark), "name", "url", "ord", J.contains_key).select("doc_id", F.col("found").alias("url"))


@query("j11_parents", "select doc_id, lower(split_part(regexp_replace(filename, '\\.[^.]*$', ''), ' - ', 1)) as parent, contains(filename, ' - ') as is_part from documents")
def j11_parents(spark: SparkSession, d: str) -> DataFrame:
    """The parent of a part, from its name."""
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    return table(spark, d, "documents").select("doc_id", F.lower(F.split_part(stem, F.lit(" - "), F.lit(1))).alias("parent"), F.contains("filename", F.lit(" - ")).alias("is_part"))


@query(
    "j14_merged_sources",
    """with c as (select row_id, source_file, control_id, extraction_source from control_row), t as (select * from c where extraction_source = 'table')
    select row_id, source_file, control_id, extraction_source from t union all select c.row_id, c.source_file, c.control_id, c.extraction_source from c where extraction_source = 'body' and not exists (select 1 from t where t.source_file = c.source_file and t.control_id = c.control_id)""",
)
def j14_merged_sources(spark: SparkSession, d: str) -> DataFrame:
    """Rows from tables, then rows from the body that no table row of the file has."""
    from paperloom.operators.controls import merge_sources

    rows = table(spark, d, "control_row").select("row_id", "source_file", "control_id", "extraction_source")
    return merge_sources(rows.where("extraction_source = 'table'"), rows.where("extraction_source = 'body'"), ("source_file", "control_id"))


@query("j15_last_status", "select filename, location, arg_max(rev_type, change_id) as rev_type from tracked_change group by 1, 2")
def j15_last_status(spark: SparkSession, d: str) -> DataFrame:
    """The last row of each key wins."""
    return J.last_by(table(spark, d, "tracked_change"), ["filename", "location"], "rev_type", "change_id")


@query("s18_first_rows", "select source_file, control_id, row_id, extraction_source from (select *, row_number() over (partition by source_file, control_id order by row_id) as n from control_row) where n = 1")
def s18_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each key wins."""
    return J.first_by(table(spark, d, "control_row").select("source_file", "control_id", "row_id", "extraction_source"), ["source_file", "control_id"], "row_id")


@query(
    "j18_recorded_values",
    """with a as (select distinct doc_id, total_char_count as c, total_paragraphs::bigint as p from document_profile), b as (select doc_id, coalesce(length(text), 0)::bigint as c, len(string_split(text, chr(10)))::bigint as p from documents),
    j as (select coalesce(a.doc_id, b.doc_id) as doc_id, a.c ac, b.c bc, a.p ap, b.p bp from a full join b on a.doc_id = b.doc_id)
    select doc_id, 'chars' as field, ac as recorded, bc as actual, bc - ac as delta from j where ac is distinct from bc union all select doc_id, 'paragraphs', ap, bp, bp - ap from j where ap is distinct from bp""",
)
def j18_recorded_values(spark: SparkSession, d: str) -> DataFrame:
    """Recorded against actual values, field by field, with their difference."""
    a = table(spark, d, "document_profile").select("doc_id", F.col("total_char_count").alias("ac"), F.col("total_paragraphs").cast("bigint").alias("ap")).distinct()
    b = table(spark, d, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("bc"), F.size(F.split("text", "\n")).cast("bigint").alias("_bp"), "text")
    b = b.select("doc_id", "bc", F.when(F.col("text").isNotNull(), F.col("_bp")).alias("bp"))
    pair = lambda f, x, y: F.struct(F.lit(f).alias("field"), F.col(x).alias("recorded"), F.col(y).alias("actual"))
    rows = a.join(b, "doc_id", "full_outer").select("doc_id", F.inline(F.array(pair("chars", "ac", "bc"), pair("paragraphs", "ap", "bp"))))
    return rows.where(~F.col("recorded").eqNullSafe(F.col("actual"))).withColumn("delta", F.col("actual") - F.col("recorded"))


@query(
    "j19_three_way",
    """with a as (select distinct filename, author from tracked_change), b as (select distinct filename, author from review_comment)
    select coalesce(a.filename, b.filename) as filename, coalesce(a.author, b.author) as author, case when b.filename is null then 'only1' when a.filename is null then 'only2' else 'both' end as side
    from a full join b on a.filename is not distinct from b.filename and a.author is not distinct from b.author""",
)
def j19_three_way(spark: SparkSession, d: str) -> DataFrame:
    """Keys of either table, labelled by where they are."""
    return J.three_way(table(spark, d, "tracked_change"), table(spark, d, "review_comment"), ["filename", "author"])


@query("j21_uncovered", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def j21_uncovered(spark: SparkSession, d: str) -> DataFrame:
    """Targets that nothing covers."""
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query(
    "j23_two_dates",
    """with s as (select l_orderkey, max(l_shipdate) as done from lineitem group by 1), o as (select date_trunc('month', o_orderdate)::date as begun, date_trunc('month', done)::date as ended from orders left join s on o_orderkey = l_orderkey)
    select coalesce(a.m, b.m) as month, coalesce(a.n, 0)::bigint as begun, coalesce(b.n, 0)::bigint as ended from (select begun m, count(*) n from o group by 1) a full join (select ended m, count(*) n from o where ended is not null group by 1) b on a.m = b.m""",
)
def j23_two_dates(spark: SparkSession, d: str) -> DataFrame:
    """One date table in two roles, begun and ended."""
    done = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("done"))
    month = lambda c: F.trunc(F.to_date(c), "month")
    o = table(spark, d, "orders").join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(month("o_orderdate").alias("b"), month("done").alias("e"))
    begun = o.groupBy(F.col("b").alias("month")).agg(F.count(F.lit(1)).alias("begun"))
    ended = o.where("e is not null").groupBy(F.col("e").alias("month")).agg(F.count(F.lit(1)).alias("ended"))
    return begun.join(ended, "month", "full_outer").fillna(0, ["begun", "ended"])


@query(
    "c12_update_actions",
    """with r as (select control_id, extraction_source, arg_min(baseline, row_id) as baseline from control_row group by 1, 2), a as (select * from r where extraction_source = 'table'), b as (select * from r where extraction_source = 'body')
    select coalesce(a.control_id, b.control_id) as control_id, case when a.control_id is null then 'append' when b.control_id is null then 'removed' when a.baseline is not distinct from b.baseline then 'same' else 'changed' end as action from a full join b on a.control_id = b.control_id""",
)
def c12_update_actions(spark: SparkSession, d: str) -> DataFrame:
    """What an update of one extraction by another would do."""
    rows = table(spark, d, "control_row")
    side = lambda s: rows.where(F.col("extraction_source") == s).groupBy("control_id").agg(F.min_by("baseline", "row_id").alias("baseline"))
    return J.upsert_actions(side("table"), side("body"), ["control_id"], ["baseline"])


@query("e13_clean_quotes", "select doc_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(text, '“', '\"'), '”', '\"'), '‘', ''''), '’', ''''), '–', '--'), '—', '---'), '…', '...'), '[' || chr(8203) || chr(8204) || chr(8205) || chr(65279) || ']', '', 'g') as text from documents where text is not null")
def e13_clean_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Typographic characters in plain spelling."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.clean_quotes(F.col("text")).alias("text"))


@query("z1_clean_strings", "select row_id, trim(regexp_replace(regexp_replace(control_name, '[^\\x20-\\x7E\\n]', '', 'g'), '\\s+', ' ', 'g')) as ascii_name, rtrim(left(trim(regexp_replace(regexp_replace(control_name, '[<>:\"/\\\\|?*]', '', 'g'), '\\s+', ' ', 'g')), 50)) as file_name, left(translate(control_name, '[]:*?/\\', ''), 31) as sheet_name from control_row")
def z1_clean_strings(spark: SparkSession, d: str) -> DataFrame:
    """Scalar functions: ASCII, file and sheet names."""
    name = F.col("control_name")
    return table(spark, d, "control_row").select("row_id", T.clean_ascii(name).alias("ascii_name"), T.safe_filename(name).alias("file_name"), T.safe_sheet(name).alias("sheet_name"))


@query("z2_freshness", "select doc_id, core_modified_date, case when date_diff('day', try_cast(core_modified_date as date), date '2025-06-30') > 365 then 'Overdue' when date_diff('day', try_cast(core_modified_date as date), date '2025-06-30') > 30 then 'Review Soon' when try_cast(core_modified_date as date) is not null then 'Current' end as age_band from (select distinct doc_id, core_modified_date from document_profile)")
def z2_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Date functions: the age band of a document at a fixed day."""
    rows = table(spark, d, "document_profile").select("doc_id", "core_modified_date").distinct()
    return rows.withColumn("age_band", G.freshness(F.col("core_modified_date").try_cast("date"), F.lit("2025-06-30").cast("date")))


@query("b18_truncated", "with c as (select row_id, control_description t, left(control_description, 300) as h from control_row where control_description is not null), e as (select *, length(regexp_extract(h, '(?s)^(.*[.!?])(?:\\s|$)', 1)) as n from c) select row_id, case when length(t) <= 300 then t when n > 150 then left(h, n) || '...' else regexp_replace(h, ' +$', '') || '...' end as text from e")
def b18_truncated(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions cut at the end of a sentence."""
    return table(spark, d, "control_row").where("control_description is not null").select("row_id", T.truncate_at_sentence(F.col("control_description"), 300).alias("text"))


@query(
    "f12_cleaned_documents",
    EL + """, w as (select *, upper(style) like 'TOC%' as toc, coalesce(regexp_matches(trim(text, ' '), '^Page\\s+[0-9]+(\\s+of\\s+[0-9]+)?$', 'i') or regexp_matches(trim(text, ' '), '^[0-9]+$') or regexp_matches(trim(text, ' '), '^-\\s*[0-9]+\\s*-$'), false) as num from el),
    a as (select *, case when toc then 'table_of_contents' when num then 'page_numbers' end as gone from w),
    b as (select *, case when gone is null then trim(regexp_replace(regexp_replace(text, 'in line with the', '', 'gi'), '  +', ' ', 'g')) else text end as t2 from a),
    c as (select *, case when gone is null and fake then case when regexp_matches(t2, '^[0-9]+\\.[0-9]+\\.[0-9]+\\s+') then 3 when regexp_matches(t2, '^(?:[0-9]+\\.0\\s+|[IVXLC]+\\.\\s+)') then 1 else 2 end end as fl from b),
    d as (select *, case when gone is not null then level when fl is not null and not regexp_matches(style, '^Heading [0-9]$') and lower(style) not like 'policyhead_' then fl when gone is null and regexp_matches(style, '^Heading [0-9]$') then right(style, 1)::int when gone is null and lower(style) like 'policyhead_' then right(style, 1)::int else level end as l2 from c),
    e as (select *, gone is null and l2 is not null and contains(lower(trim(t2, ' ')), 'glossary') as aim from d),
    f as (select *, """ + ", ".join(f"max(case when aim and l2 = {k} then seq end) over z as a{k}, max(case when l2 <= {k} then seq end) over z as c{k}" for k in (1, 2, 3, 4)) + """ from e window z as (partition by doc_id order by seq rows between unbounded preceding and current row))
    select doc_id, seq, t2 as text from f where gone is null and not (coalesce(a1 = c1, false) or coalesce(a2 = c2, false) or coalesce(a3 = c3, false) or coalesce(a4 = c4, false))""",
)
def f12_cleaned_documents(spark: SparkSession, d: str) -> DataFrame:
    """all rewrites of a document in their fixed order."""
    from paperloom.plans.structure import CUSTOM

    rows = elements(spark, d).withColumns({"location": F.lit("body"), "rejected": F.col("text"), "header": F.array().cast("array<string>"), "runs": F.array().cast("array<struct<text:string,italic:boolean>>")})
    kept, _ = W.clean(rows, phrases=("in line with the",), custom=CUSTOM, contains=("glossary",))
    return _long(kept, "doc_id", "seq", "text")


@query(
    "j9_pairs_as_text",
    f"""with s as (select * from (values {_SITE_ROWS}) t(ord, name, url)), d as (select doc_id, {_SOURCE_KEY} k from documents)
    select d.doc_id, coalesce(string_agg(name || ' = ' || url, '; ' order by ord), '') as pairs from d left join s on length(k) > 0 and (contains(k, name) or contains(name, k)) and not contains(url, '_ERROR') group by 1""",
)
def j9_pairs_as_text(spark: SparkSession, d: str) -> DataFrame:
    """All matching entries without errors, each as ``name = value``."""
    rows = table(spark, d, "documents").select("doc_id", F.lower(F.trim(F.regexp_replace("source", r"[_\-\s]+", " "))).alias("_k"))
    found = J.list_values(rows, "_k", _sites(spark), "name", "url", "ord", "name")
    return found.select("doc_id", F.array_join("found", "; ").alias("pairs"))


@query(
    "j6_tags",
    f"""with s as (select * from (values {_SITE_ROWS}) t(ord, name, url)), d as (select doc_id, lower(source) as n1, replace(lower(source), '_', ' ') as n2 from documents),
    m as (select doc_id, coalesce((select min_by(url, ord) from s where name = n1), (select min_by(url, ord) from s where name = n2), (select min_by(url, ord) from s where length(n1) > 0 and (contains(n1, name) or contains(name, n1)))) as u from d)
    select doc_id, case when u is null then 'Corpus' else u || ', Corpus' end as tags from m""",
)
def j6_tags(spark: SparkSession, d: str) -> DataFrame:
    """The tags of the equal name, else of the name with blanks, else of the first that contains it or lies in it."""
    rows = table(spark, d, "documents").select("doc_id", "source")
    entries = _sites(spark).select("ord", "name", F.array("url").alias("tags"))
    found = J.tags_of(rows, "source", entries, "name", "tags", "ord", F.array(F.lit("Corpus")))
    return found.select("doc_id", F.array_join("tags", ", ").alias("tags"))


_STEM = "lower(regexp_replace(regexp_replace(filename, '\\.[^.]*$', ''), '(_fixed|_optimized|_backup)$', '', 'i'))"


@query(
    "j11_resolved_parents",
    f"""with m as (select distinct lower(filename) as part, lower(policy_key) as parent from documents where contains(filename, ' - ')), u as (select part, min(parent) as parent from m group by 1)
    select doc_id, coalesce(u.parent, split_part({_STEM}, ' - ', 1)) as parent, case when u.parent is not null then 'manifest' else 'name' end as origin from documents d left join u on lower(d.filename) = u.part""",
)
def j11_resolved_parents(spark: SparkSession, d: str) -> DataFrame:
    """The parent of a part from the manifest of parts, else from its name."""
    docs = table(spark, d, "documents").select("doc_id", "filename", "policy_key")
    manifest = docs.where(F.contains("filename", F.lit(" - "))).select(F.col("filename").alias("part"), F.col("policy_key").alias("parent"))
    return J.resolved_parents(docs, "filename", manifest).select("doc_id", "parent", "origin")


@query(
    "j12_profiles_of_parents",
    f"""with k as (select distinct lower(regexp_replace(regexp_replace(filename, '\\.[^.]*$', ''), '(_fixed|_optimized|_backup)$', '', 'i')) as k, doc_type from document_profile), g as (select k, min(doc_type) as doc_type from k group by 1)
    select doc_id, g.doc_type from documents d left join g on {_STEM} = g.k""",
)
def j12_profiles_of_parents(spark: SparkSession, d: str) -> DataFrame:
    """The profile of a document by the stem of its file name."""
    return J.by_stem(table(spark, d, "documents").select("doc_id", "filename"), "filename", table(spark, d, "document_profile"), "filename", "doc_type").select("doc_id", "doc_type")
