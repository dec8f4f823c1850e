"""Queries on headings, sections and document profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import headings as H
from paperloom.operators import profile as G
from paperloom.plans.registry import Registry
from paperloom.session import table
from paperloom.sources.text import text_elements

R = Registry()
query = R.query

CUSTOM = {f"PolicyHead{k}": f"Heading {k}" for k in (1, 2, 3, 4)}

#: Lines of documents with what section_info says of them, as ``el``.
EL = """with ln as (select doc_id, filename, unnest(l) as text, cast(generate_subscripts(l, 1) - 1 as bigint) as seq
  from (select doc_id, filename, string_split(text, chr(10)) l from documents where text is not null)),
hd as (select distinct doc_id, start_para_index, heading_style, coalesce(heading_level, 2) lvl, is_fake_heading from section_info),
el as (select ln.*, coalesce(hd.heading_style, 'Normal') as style, cast(hd.lvl as bigint) as level, coalesce(hd.is_fake_heading, false) as fake
  from ln left join hd on ln.doc_id = hd.doc_id and ln.seq = hd.start_para_index)"""


def elements(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    return text_elements(table(spark, d, "documents"), table(spark, d, "section_info"), *keep)


def _long(df: DataFrame, *names: str) -> DataFrame:
    """The columns with whole numbers as bigint."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(n).cast("bigint").alias(n) if kinds[n] in ("int", "smallint") else F.col(n) for n in names])


@query(
    "h1_heading_styles",
    """select heading_style, cast(case when regexp_matches(heading_style, '^Heading [0-9]$') then regexp_extract(heading_style, '([0-9])$', 1) end as bigint) as style_level,
    case when lower(heading_style) like 'policyhead%' then 'Heading ' || right(heading_style, 1) else heading_style end as mapped_style, count(*) as sections
    from (select distinct section_id, heading_style from section_info) group by 1, 2, 3""",
)
def h1_heading_styles(spark: SparkSession, d: str) -> DataFrame:
    """H1 to H3: sections by style, its level, and the style that a custom one stands for."""
    rows = table(spark, d, "section_info").select("section_id", "heading_style").distinct()
    style = F.col("heading_style")
    return rows.groupBy("heading_style", H.style_level(style).cast("bigint").alias("style_level"), H.mapped_style(style, CUSTOM).alias("mapped_style")).agg(F.count(F.lit(1)).alias("sections"))


@query("h5_fake_headings", EL + """ select doc_id, seq from el where fake and trim(text) <> '' and not regexp_matches(style, '^Heading [0-9]$') and length(trim(text)) < 120 and not ends_with(trim(text), '.')""")
def h5_fake_headings(spark: SparkSession, d: str) -> DataFrame:
    """H4, H5: short bold paragraphs without a heading style."""
    return _long(elements(spark, d).where(H.is_fake_heading(F.col("text"), F.col("style"), F.col("fake"))), "doc_id", "seq")


@query("h6_sized_fake_headings", EL + """ select doc_id, seq from el where level is not null and length(trim(text)) between 1 and 100""")
def h6_sized_fake_headings(spark: SparkSession, d: str) -> DataFrame:
    """H6: the profiler's fake headings, with every heading line read as bold and without size."""
    rows = elements(spark, d)
    return _long(rows.where(H.is_fake_heading_by_size(F.col("text"), F.col("level").isNotNull(), F.lit(None).cast("double"))), "doc_id", "seq")


@query(
    "h7_numbered_levels",
    """select section_id, heading_text, cast(case when regexp_matches(heading_text, '^[0-9]+\\.[0-9]+\\.[0-9]+\\s+') then 3
    when regexp_matches(heading_text, '^(?:[0-9]+\\.0\\s+|[IVXLC]+\\.\\s+)') then 1 when regexp_matches(heading_text, '^(?:[0-9]+\\.[0-9]+\\s+|[A-Z]\\.\\s+)') then 2 else 2 end as bigint) as numbered_level
    from (select distinct section_id, heading_text from section_info)""",
)
def h7_numbered_levels(spark: SparkSession, d: str) -> DataFrame:
    """H7: the level that a heading's numbering gives."""
    rows = table(spark, d, "section_info").select("section_id", "heading_text").distinct()
    return rows.select("section_id", "heading_text", H.numbered_level(F.col("heading_text")).cast("bigint").alias("numbered_level"))


@query(
    "h8_effective_levels",
    EL + """ select doc_id, seq, cast(case when regexp_matches(style, '^Heading [0-9]$') or lower(style) like 'policyhead_' then cast(right(style, 1) as int)
    when fake then case when regexp_matches(text, '^[0-9]+\\.[0-9]+\\.[0-9]+\\s+') then 3 when regexp_matches(text, '^(?:[0-9]+\\.0\\s+|[IVXLC]+\\.\\s+)') then 1 else 2 end end as bigint) as effective_level
    from el where regexp_matches(style, '^Heading [0-9]$') or lower(style) like 'policyhead_' or fake""",
)
def h8_effective_levels(spark: SparkSession, d: str) -> DataFrame:
    """H8: level by style, custom style, or numbering of a fake heading."""
    rows = elements(spark, d).withColumn("effective_level", H.effective_level(F.col("style"), CUSTOM, F.col("text"), F.col("fake")))
    return _long(rows.where("effective_level is not null"), "doc_id", "seq", "effective_level")


@query(
    "h9_restyle_log",
    EL + """, c as (select doc_id, seq, style as original_style, case when lower(style) like 'policyhead_' then 'Heading ' || right(style, 1)
    when fake then 'Heading ' || case when regexp_matches(text, '^[0-9]+\\.[0-9]+\\.[0-9]+\\s+') then '3' when regexp_matches(text, '^(?:[0-9]+\\.0\\s+|[IVXLC]+\\.\\s+)') then '1' else '2' end end as new_style,
    left(text, 80) as preview, case when lower(style) like 'policyhead_' then 'custom_style' else 'fake_heading' end as change_type from el)
    select * from c where new_style is not null and new_style <> original_style""",
)
def h9_restyle_log(spark: SparkSession, d: str) -> DataFrame:
    """H9: what restyling changes."""
    return _long(H.restyle_log(elements(spark, d), CUSTOM), "doc_id", "seq", "original_style", "new_style", "preview", "change_type")


@query(
    "h10_parent_heading",
    EL + """ select doc_id, seq, coalesce(last_value(case when level <= 2 then text end ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and 1 preceding), '(No heading found)') as parent_heading from el""",
)
def h10_parent_heading(spark: SparkSession, d: str) -> DataFrame:
    """The nearest heading of level 1 or 2 before every line."""
    return _long(H.parent_heading(elements(spark, d)), "doc_id", "seq", "parent_heading")


_EXTENTS = EL + """, r as (select doc_id, seq, text, case when not fake and level <= 3 then level end as level, length(text) n from el),
s as (select *, sum(n) over (partition by doc_id order by seq) - n as sum_before, sum(n) over (partition by doc_id) as total, max(seq) over (partition by doc_id) + 1 as cnt,
  max(level) over (partition by doc_id) as has from r),
e as (select a.doc_id, a.seq as start_seq, a.level, a.text as heading, a.sum_before, a.total, a.cnt, min(b.seq) as nxt, min(b.sum_before) as nxt_sum
  from s a left join s b on a.doc_id = b.doc_id and b.seq > a.seq and b.level <= a.level where a.level is not null group by all),
x as (select doc_id, start_seq, coalesce(nxt, cnt) as end_seq, level, heading, coalesce(nxt_sum, total) - sum_before as own from e
  union all select doc_id, 0, cnt, 0, '(No headings)', total from s where has is null and seq = 0)"""


@query("h11_section_extents", _EXTENTS + " select doc_id, start_seq, end_seq, level, heading, cast(own + end_seq - start_seq - 1 as bigint) as chars, end_seq - start_seq as paragraphs from x")
def h11_section_extents(spark: SparkSession, d: str) -> DataFrame:
    """Every section with its extent and size."""
    return H.section_extents(elements(spark, d))


_KINDS = " ".join(
    f"when {' or '.join(f'''contains(lower(trim({{0}})), '{k}') or contains('{k}', lower(trim({{0}})))''' for k in keywords)} then '{name}'"
    for name, keywords in {
        "purpose": ("purpose", "policy purpose", "1.0 purpose", "document purpose"), "scope": ("scope", "policy scope", "2.0 scope", "applicability", "applicability and scope"),
        "intent": ("intent", "policy intent", "3.0 intent", "objective", "policy objective", "security objective"),
        "controls": ("controls", "technical controls", "security controls", "4.0 controls", "control requirements", "requirements", "policy requirements", "implementation requirements"),
        "appendix": ("appendix", "appendices", "5.0 appendix", "supplementary", "reference", "references", "glossary", "definitions"),
    }.items()
)


def section_kind_sql(column: str) -> str:
    return f"case when trim({column}) = '' then 'none' {_KINDS.format(column)} else 'none' end"


@query("h13_standard_sections", f"select heading_text, {section_kind_sql('heading_text')} as standard_section, count(*) as sections from (select distinct section_id, heading_text from section_info) group by 1, 2")
def h13_standard_sections(spark: SparkSession, d: str) -> DataFrame:
    """The standard section that each heading belongs to."""
    rows = table(spark, d, "section_info").select("section_id", "heading_text").distinct()
    return rows.groupBy("heading_text", H.standard_section(F.col("heading_text")).alias("standard_section")).agg(F.count(F.lit(1)).alias("sections"))


@query(
    "h14_section_of_line",
    EL + """ select doc_id, seq, coalesce(last_value(case when level is not null then text end ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and current row), '(unknown)') as section from el""",
)
def h14_section_of_line(spark: SparkSession, d: str) -> DataFrame:
    """The last heading at or before every line."""
    return _long(H.section_of(elements(spark, d)), "doc_id", "seq", "section")


@query(
    "h15_level_skips",
    EL + """, h as (select doc_id, seq, case when fake then 1 else level end as lv from el where level is not null),
    j as (select doc_id, lv, lag(lv) over (partition by doc_id order by seq) as p from h)
    select doc_id, count(*) as headings, cast(count(case when lv > p + 1 then 1 end) as bigint) as skips from j group by 1""",
)
def h15_level_skips(spark: SparkSession, d: str) -> DataFrame:
    """How often a document jumps over a level."""
    return H.level_skips(elements(spark, d))


@query(
    "h16_breadcrumbs",
    EL + """, w as (select doc_id, seq, level, max(case when level = 1 then seq end) over z s1, max(case when level = 2 then seq end) over z s2, max(case when level = 3 then seq end) over z s3,
    last_value(case when level = 1 then text end ignore nulls) over z t1, last_value(case when level = 2 then text end ignore nulls) over z t2, last_value(case when level = 3 then text end ignore nulls) over z t3
    from el window z as (partition by doc_id order by seq rows between unbounded preceding and current row))
    select doc_id, seq, t1 as h1, case when s2 > coalesce(s1, -1) then t2 end as h2, case when s3 > greatest(coalesce(s1, -1), coalesce(s2, -1)) then t3 end as h3 from w where level is null""",
)
def h16_breadcrumbs(spark: SparkSession, d: str) -> DataFrame:
    """The headings above every line of text."""
    return _long(H.breadcrumbs(elements(spark, d)).where("level is null"), "doc_id", "seq", "h1", "h2", "h3")


@query("h18_shifted_levels", EL + """ select doc_id, seq, least(level - min(level) over (partition by doc_id) + 1, 2) as out_level from el where level is not null""")
def h18_shifted_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels that start at 1 in every document."""
    return _long(H.shifted_levels(elements(spark, d)).where("level is not null"), "doc_id", "seq", "out_level")


_G1 = EL + """, g as (select doc_id, filename, cast(sum(length(text)) as bigint) as chars, cast(sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''))) as bigint) as words, count(*) as paragraphs from el group by 1, 2),
p as (select *, round_even(paragraphs / 30.0, 1)::double as pages, chars > 36000 as over_limit from g)"""


@query("g1_document_sizes", _G1 + " select doc_id, chars, words, paragraphs, pages, over_limit from p")
def g1_document_sizes(spark: SparkSession, d: str) -> DataFrame:
    """G1: characters, words, paragraphs and pages of every document."""
    return G.sizes(elements(spark, d)).select("doc_id", "chars", "words", "paragraphs", "pages", "over_limit")


@query(
    "g2_heading_counts",
    EL + """ select doc_id, count(*) as headings, count(case when not fake and level = 1 then 1 end) as h1, count(case when not fake and level = 2 then 1 end) as h2, count(case when not fake and level = 3 then 1 end) as h3,
    count(case when fake then 1 end) as fake_headings, count(case when not fake and regexp_matches(style, '^Heading [0-9]$') then 1 end) as builtin_headings from el where level is not null group by 1""",
)
def g2_heading_counts(spark: SparkSession, d: str) -> DataFrame:
    """Headings by level and origin."""
    return G.heading_counts(elements(spark, d))


@query(
    "g3_standard_presence",
    _EXTENTS + f""", k as (select doc_id, {section_kind_sql('heading')} as kind from x), p as (select doc_id, bool_or(kind = 'purpose') a, bool_or(kind = 'scope') b, bool_or(kind = 'intent') c, bool_or(kind = 'controls') e, bool_or(kind = 'appendix') f from k group by 1)
    select doc_id, a as has_purpose, b as has_scope, c as has_intent, e as has_controls, f as has_appendix,
    concat_ws(', ', case when not a then 'purpose' end, case when not b then 'scope' end, case when not c then 'intent' end, case when not e then 'controls' end, case when not f then 'appendix' end) as missing from p""",
)
def g3_standard_presence(spark: SparkSession, d: str) -> DataFrame:
    """Which standard sections every document has and misses."""
    return G.standard_presence(H.section_extents(elements(spark, d)))


@query(
    "g4_largest_section",
    _EXTENTS + f""", y as (select *, own + end_seq - start_seq - 1 as chars, {section_kind_sql('heading')} as kind from x)
    select doc_id, arg_max(heading, struct_pack(c := chars, s := -start_seq)) as largest_section, cast(max(chars) as bigint) as largest_chars,
    cast(coalesce(sum(case when kind = 'controls' then chars end), 0) as bigint) as controls_chars, cast(coalesce(sum(case when kind = 'appendix' then chars end), 0) as bigint) as appendix_chars from y group by 1""",
)
def g4_largest_section(spark: SparkSession, d: str) -> DataFrame:
    """The largest section (the first of equals) and the size of controls and appendices."""
    return G.largest_section(H.section_extents(elements(spark, d)))


_ID_SQL = "[A-Z]{2,4}[-.]?[0-9]{1,3}[-.][0-9]{2,4}"


@query(
    "g7_control_density",
    EL + """, m as (select doc_id, sum(len(regexp_extract_all(text, '\\b[A-Z]{2,4}[-.]?[0-9]{1,3}[-.][0-9]{2,4}\\b')) + len(regexp_extract_all(text, '\\b[A-Z]{2,4}\\s+[0-9]{1,3}\\.[0-9]{2,4}\\b')) + len(regexp_extract_all(text, '\\b[A-Z]{2,4}[0-9]{2,3}\\.[0-9]{2,4}\\b'))) as ids, count(*) as paragraphs from el group by 1)
    select doc_id, cast(ids as bigint) as ids, cast(paragraphs as bigint) as paragraphs, ids * 30 >= 5 * paragraphs as dense from m where ids > 0""",
)
def g7_control_density(spark: SparkSession, d: str) -> DataFrame:
    """Control identifiers of every document, and whether a page of 30 paragraphs has five or more."""
    return G.control_density(elements(spark, d))


@query(
    "g8_heading_variance",
    EL + """, h as (select doc_id, seq, fake, case when fake then 1 else level end as lv from el where level is not null), j as (select *, lag(lv) over (partition by doc_id order by seq) as p from h),
    c as (select doc_id, count(*) as headings, count(case when lv > p + 1 then 1 end) as skips, count(case when fake then 1 end) as fakes, count(case when not fake and lv = 1 then 1 end) as ones, count(case when not fake and lv > 1 then 1 end) as deeper from j group by 1)
    select doc_id, concat_ws('; ', case when skips >= 2 then 'level skips: ' || skips end, case when 2 * fakes >= headings then 'fake headings: ' || fakes || ' of ' || headings end, case when ones > 1 and deeper = 0 then 'flat' end) as reasons
    from c where skips >= 2 or 2 * fakes >= headings or (ones > 1 and deeper = 0)""",
)
def g8_heading_variance(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose headings are uneven, with the reasons."""
    return G.heading_variance(elements(spark, d))


@query(
    "g9_unlabelled_sections",
    _EXTENTS + f""" select doc_id, string_agg(heading, ' | ' order by start_seq) as sections, count(*) as n from x where {section_kind_sql('heading')} = 'none' and level > 0 group by 1""",
)
def g9_unlabelled_sections(spark: SparkSession, d: str) -> DataFrame:
    """Headings of sections that are no standard ones, in order."""
    return G.unlabelled_sections(H.section_extents(elements(spark, d)))


_TYPE_SQL = """, t as (select distinct doc_id, filename, text from documents),
p as (select x.doc_id, cast(sum(case when {kind} = 'appendix' then own + end_seq - start_seq - 1 else 0 end) as bigint) as appendix_chars from x group by 1),
z as (select p.doc_id, t.filename, appendix_chars, greatest(length(t.text), 1) as total, (contains(lower(t.text), 'step 1'))::int + (contains(lower(t.text), 'step 2'))::int + (contains(lower(t.text), 'procedure'))::int + (contains(lower(t.text), 'escalation'))::int
  + (contains(lower(t.text), 'workflow'))::int + (contains(lower(t.text), 'response process'))::int + (contains(lower(t.text), 'playbook'))::int as hits from p join t on p.doc_id = t.doc_id)""".format(kind=section_kind_sql("heading"))


@query(
    "g13_search_terms",
    """select doc_id, cast(len(regexp_extract_all(upper(t), '\\bAC\\b')) as bigint) as term_ac, cast(len(regexp_extract_all(upper(t), '\\bCLOUD\\b')) as bigint) as term_cloud, cast(len(regexp_extract_all(upper(t), '\\bAUDIT\\b')) as bigint) as term_audit
    from (select doc_id, regexp_replace(regexp_replace(text, '[^\\x00-\\x7F\\P{L}]', 'x', 'g'), '[^\\x00-\\x7F\\P{N}]', 'x', 'g') t from documents where text is not null)""",
)
def g13_search_terms(spark: SparkSession, d: str) -> DataFrame:
    """How often each search term occurs, as one column a term."""
    return G.search_terms(table(spark, d, "documents").where("text is not null"), ("AC", "Cloud", "Audit"))


@query(
    "g17_corpus_summary",
    _G1 + """, s as (select count(*) as documents, sum(chars) as chars, sum(words) as words, sum(paragraphs) as paragraphs, count(case when over_limit then 1 end) as over_limit, max(chars) as largest from p)
    select unnest(['documents', 'characters', 'words', 'paragraphs', 'over_limit', 'largest']) as label, cast(unnest([documents, chars, words, paragraphs, over_limit, largest]) as bigint) as value from s""",
)
def g17_corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    """Totals over the corpus as labelled values."""
    return G.summary(G.sizes(elements(spark, d)))


@query(
    "g19_rows_by_file",
    """select source_file, count(*) as controls, count(case when coalesce(control_description, '') = '' then 1 end) as without_text, count(distinct control_id) as ids from control_row group by 1""",
)
def g19_rows_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Counts for every source file."""
    rows = table(spark, d, "control_row")
    return rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("controls"), F.count_if(F.coalesce("control_description", F.lit("")) == "").alias("without_text"), F.count_distinct("control_id").alias("ids")
    )


@query(
    "g21_conversion_stats",
    EL + """ select doc_id, count(case when level is null and trim(text) <> '' then 1 end) as paragraphs, count(level) as headings, count(case when trim(text) = '' then 1 end) as blank, count(case when contains(text, '|') then 1 end) as with_pipe from el group by 1""",
)
def g21_conversion_stats(spark: SparkSession, d: str) -> DataFrame:
    """What a conversion of every document meets."""
    return G.conversion_stats(elements(spark, d))
