"""Queries on renderings, document differences and measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import docdiff as D
from paperloom.operators import measures as Q
from paperloom.operators import render as E
from paperloom.plans.extraction import _ID
from paperloom.plans.registry import Registry
from paperloom.plans.structure import EL, elements
from paperloom.session import table

R = Registry()
query = R.query


@query("e3_tags", "with t as (select doc_id, lower(trim(lang)) as a, lower(trim(source)) as b, policy_key as c from documents) select doc_id, concat_ws(', ', case when a <> '' then a end, case when b <> '' and b is distinct from a then b end, 'Corpus') as tags from t")
def e3_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags of several origins, the first spelling of each kept."""
    rows = table(spark, d, "documents")
    tags = E.merge_tags(F.array(F.lower(F.trim("lang")), F.lower(F.trim("source"))), F.array(F.lit("Corpus"), F.upper(F.trim("source"))))
    return rows.select("doc_id", F.array_join(tags, ", ").alias("tags"))


@query("e5_front_matter", "select doc_id, '---' || chr(10) || concat_ws(chr(10), 'title: ' || regexp_replace(filename, '\\.[^.]*$', ''), case when length(trim(source)) > 0 then 'source: ' || trim(source) end, 'kind: policy') || chr(10) || '---' || chr(10) as block from documents")
def e5_front_matter(spark: SparkSession, d: str) -> DataFrame:
    """A metadata block for every document."""
    columns = {"name": F.regexp_replace("filename", r"\.[^.]*$", ""), "source": F.col("source")}
    fields = [("title", {"source": "auto:name"}), ("source", {"source": "column:source"}), ("kind", {"source": "static:policy"})]
    return table(spark, d, "documents").select("doc_id", E.front_matter([(k, E.resolve(f, columns)[0]) for k, f in fields]).alias("block"))


@query(
    "e9_pipe_tables",
    """with c as (select n_regionkey as t, row_number() over (partition by n_regionkey order by n_nationkey) as r, n_nationkey::varchar as a, n_name as b from nation), l as (select t, 0 as r, '| key | name |' || chr(10) || '| --- | --- |' as line from c group by 1 union all select t, r, '| ' || a || ' | ' || b || ' |' from c)
    select t::bigint as table_idx, string_agg(line, chr(10) order by r) as markdown from l group by 1""",
)
def e9_pipe_tables(spark: SparkSession, d: str) -> DataFrame:
    """A pipe table of the nations of every region."""
    from pyspark.sql import Window

    rows = table(spark, d, "nation").withColumn("row_idx", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")))
    pair = lambda a, b: F.array(F.struct(F.lit(0).alias("col_idx"), a.alias("text")), F.struct(F.lit(1).alias("col_idx"), b.alias("text")))
    body = rows.select(F.col("n_regionkey").cast("bigint").alias("table_idx"), "row_idx", F.inline(pair(F.col("n_nationkey").cast("string"), F.col("n_name"))))
    head = rows.select(F.col("n_regionkey").cast("bigint").alias("table_idx")).distinct().select("table_idx", F.lit(0).alias("row_idx"), F.inline(pair(F.lit("key"), F.lit("name"))))
    return E.pipe_tables(head.unionByName(body), ("table_idx",))


@query("e12_markdown", EL + " select doc_id, string_agg(case when level is not null then repeat('#', least(level, 6)::int) || ' ' || trim(text) else text end, chr(10) || chr(10) order by seq) as content from el group by 1")
def e12_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Every document as Markdown."""
    return E.markdown(elements(spark, d))


@query("e15_retrieval_texts", "select row_id, concat_ws(chr(10), case when length(trim(control_id)) > 0 then 'Control: ' || trim(control_id) end, case when length(trim(control_name)) > 0 then 'Name: ' || trim(control_name) end, case when length(trim(control_description)) > 0 then 'Description: ' || trim(control_description) end) as content from control_row")
def e15_retrieval_texts(spark: SparkSession, d: str) -> DataFrame:
    """Labelled fields of a record as one text."""
    return table(spark, d, "control_row").select("row_id", E.retrieval_text([("Control", "control_id"), ("Name", "control_name"), ("Description", "control_description")]).alias("content"))


_MD = """concat_ws(chr(10) || chr(10), '## ' || concat_ws(' - ', control_id, nullif(trim(control_name), '')), case when length(trim(baseline)) > 0 then '**Baseline:** ' || trim(baseline) end,
  case when length(trim(control_description)) > 120 then '**Description:**' || chr(10) || chr(10) || trim(control_description) when length(trim(control_description)) > 0 then '**Description:** ' || trim(control_description) end)"""


@query("e16_control_markdown", f"select source_file, string_agg({_MD}, chr(10) || chr(10) order by row_id) as content from control_row group by 1")
def e16_control_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The controls of every file as Markdown."""
    text = E.control_markdown(F.col("control_id"), F.col("control_name"), [("Baseline", F.col("baseline")), ("Description", F.col("control_description"))])
    return E.by_file(table(spark, d, "control_row").select("source_file", "row_id", text.alias("text")), "source_file", "row_id", "text")


@query(
    "e18_routing",
    f"""with i as (select doc_id, unnest(regexp_extract_all(text, '{_ID}')) as x from documents where text is not null), f as (select d.doc_id, regexp_extract(i.x, '^([A-Z]+)', 1) as family, count(i.x) as n from documents d left join i on d.doc_id = i.doc_id group by 1, 2),
    b as (select doc_id, min(struct_pack(n := -n, f := family)) as b from f group by 1) select doc_id, b.f as family, case b.f when 'AC' then 'access' when 'AU' then 'audit' when 'CM' then 'configuration' else 'general' end as folder, coalesce(b.f not in ('AC', 'AU', 'CM'), true) as flagged from b""",
)
def e18_routing(spark: SparkSession, d: str) -> DataFrame:
    """The folder of each document by its dominant control family."""
    return E.dominant_family(table(spark, d, "documents"), "doc_id", "text", {"AC": "access", "AU": "audit", "CM": "configuration"})


@query("k8_unique_names", "select doc_id, policy_key || case when row_number() over (partition by policy_key order by doc_id) > 1 then ' (' || row_number() over (partition by policy_key order by doc_id) || ')' else '' end as file from documents")
def k8_unique_names(spark: SparkSession, d: str) -> DataFrame:
    """K8: a file name for every row, numbered where it repeats."""
    return E.unique_names(table(spark, d, "documents"), "policy_key", "doc_id").select("doc_id", "file")


@query("k21_labelled_values", "select row_id, o::bigint as ord, label, value from (select row_id, 0 o, 'control_id' as label, trim(control_id) as value from control_row union all select row_id, 1, 'control_name', trim(control_name) from control_row union all select row_id, 2, 'baseline', trim(baseline) from control_row) where value <> ''")
def labelled_values(spark: SparkSession, d: str) -> DataFrame:
    """Rows as labelled values."""
    return E.key_value_rows(table(spark, d, "control_row"), "row_id", ("control_id", "control_name", "baseline"))


@query("j16_paired_files")
def j16_paired_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of two sets, paired by name, normalised name and likeness."""
    rows = table(spark, d, "documents").select("doc_id", "filename")
    return D.pair_files(rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1"))


@query("d2_paragraph_diff")
def d2_paragraph_diff(spark: SparkSession, d: str) -> DataFrame:
    """Differences of the two copies' paragraphs, with word-level operations."""
    rows = table(spark, d, "paragraph")
    return D.paragraph_diff(rows.where("copy_no = 1"), rows.where("copy_no = 2"))


_PROPS = "with a as (select package_name as pair, sum(coalesce(length(accepted), 0))::bigint as chars, count(*)::bigint as paragraphs, count(case when has_tracked_changes then 1 end) as tracked, min(location) as place, md5(max(accepted)) as digest from (select distinct * exclude (ingested_at) from paragraph) where copy_no = {0} group by 1)"
_newer = lambda x: f"case when a.{x} is null and b.{x} is null then 'missing' when a.{x} is null then '2' when b.{x} is null then '1' when a.{x} = b.{x} then 'tie' when a.{x} > b.{x} then '1' else '2' end"
_SIGNALS = (
    _PROPS.format(1) + ", " + _PROPS.format(2).replace("with a as", "b as")
    + f", s as (select coalesce(a.pair, b.pair) as pair, unnest(['app.Characters', 'app.Paragraphs', 'tracked', 'core.place', 'digest']) as signal, unnest([{_newer('chars')}, {_newer('paragraphs')}, {_newer('tracked')},"
    " case when a.place is null and b.place is null then 'missing' when a.place is not distinct from b.place then 'tie' else 'n/a' end, case when a.digest = b.digest then 'tie' else 'n/a' end]) as side from a full join b on a.pair = b.pair)"
)


def _properties(spark: SparkSession, d: str, copy: int) -> DataFrame:
    rows = table(spark, d, "paragraph").where(F.col("copy_no") == copy).drop("ingested_at").distinct()
    text = lambda c: c.cast("string")
    wide = rows.groupBy(F.col("package_name").alias("pair")).agg(
        text(F.sum(F.coalesce(F.length("accepted"), F.lit(0)))).alias("app.Characters"), text(F.count(F.lit(1))).alias("app.Paragraphs"), text(F.count_if("has_tracked_changes")).alias("tracked"), F.min("location").alias("core.place"), F.md5(F.max("accepted").cast("binary")).alias("digest")
    )
    names = ["`app.Characters`", "`app.Paragraphs`", "tracked", "`core.place`", "digest"]
    return wide.unpivot(["pair"], names, "field", "value").where("value is not null")


def _signals(spark: SparkSession, d: str) -> DataFrame:
    return D.signals(_properties(spark, d, 1), _properties(spark, d, 2), ("app.Characters", "app.Paragraphs", "tracked"), ("core.place",), ("digest",))


@query("d4_signals", _SIGNALS + " select pair, signal, side from s")
def d4_signals(spark: SparkSession, d: str) -> DataFrame:
    """Which copy of each package each property speaks for: ordered ones, an identity and a digest."""
    return _signals(spark, d)


@query("d5_tally", _SIGNALS + " select pair, count(case when side = '1' then 1 end) as first, count(case when side = '2' then 1 end) as second, count(case when side = 'tie' then 1 end) as tie, count(case when side in ('missing', 'n/a') then 1 end) as undecided from s group by 1")
def d5_tally(spark: SparkSession, d: str) -> DataFrame:
    """Signals by side."""
    return D.tally(_signals(spark, d))


@query(
    "d7_pair_status",
    """with p as (select distinct package_name, location, para_index, copy_no, accepted, rejected from paragraph), a as (select * from p where copy_no = 1), b as (select * from p where copy_no = 2),
    j as (select coalesce(a.package_name, b.package_name) as pair, a.package_name is null or b.package_name is null or a.accepted is distinct from b.accepted as t, a.package_name is not null and b.package_name is not null and a.rejected is distinct from b.rejected as m, a.package_name is not null as ia, b.package_name is not null as ib
      from a full join b on a.package_name = b.package_name and a.location = b.location and a.para_index = b.para_index)
    select pair, case when not (bool_or(ia) and bool_or(ib)) then 'ORPHAN' when count(case when t then 1 end) > 0 then 'CHANGED' when count(case when m then 1 end) > 0 then 'METADATA ONLY' else 'IDENTICAL' end as status, count(case when t then 1 end) as texts, count(case when m then 1 end) as others from j group by 1""",
)
def d7_pair_status(spark: SparkSession, d: str) -> DataFrame:
    """The state of each package's two copies."""
    rows = table(spark, d, "paragraph").select("package_name", "location", "para_index", "copy_no", "accepted", "rejected").distinct()
    side = lambda n: rows.where(F.col("copy_no") == n).select("package_name", "location", "para_index", F.struct("accepted", "rejected").alias(f"s{n}"))
    both = side(1).join(side(2), ["package_name", "location", "para_index"], "full_outer")
    one_only = F.col("s1").isNull() | F.col("s2").isNull()
    text = one_only | ~F.col("s1.accepted").eqNullSafe(F.col("s2.accepted"))
    other = ~one_only & ~F.col("s1.rejected").eqNullSafe(F.col("s2.rejected"))
    agg = both.groupBy(F.col("package_name").alias("pair")).agg(F.count_if(text).alias("texts"), F.count_if(other).alias("others"), F.count("s1").alias("_a"), F.count("s2").alias("_b"))
    return agg.select("pair", D.pair_status(F.col("texts"), F.col("others"), (F.col("_a") == 0) | (F.col("_b") == 0)).alias("status"), "texts", "others")


@query("d6_latest_arrival", "select filename, max(ingested_at) as latest from (select filename, ingested_at from tracked_change union all select filename, ingested_at from review_comment) group by 1")
def d6_latest_arrival(spark: SparkSession, d: str) -> DataFrame:
    """The latest time of each file over both tables."""
    rows = table(spark, d, "tracked_change").select("filename", "ingested_at").unionByName(table(spark, d, "review_comment").select("filename", "ingested_at"))
    return rows.groupBy("filename").agg(F.max("ingested_at").alias("latest"))


_FACTS = "with s as (select l_orderkey, max(l_shipdate) as ended from lineitem group by 1), f as (select o.*, ended from orders o left join s on o_orderkey = l_orderkey)"


def _facts(spark: SparkSession, d: str) -> DataFrame:
    ended = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ended"))
    return table(spark, d, "orders").join(ended, F.col("o_orderkey") == F.col("l_orderkey"), "left")


@query("q1_state_counts", "select o_orderpriority, count(*) as total, count(case when o_orderstatus = 'F' then 1 end) as finished, count(case when o_orderstatus in ('O', 'P') then 1 end) as open from orders group by 1")
def q1_state_counts(spark: SparkSession, d: str) -> DataFrame:
    """Q1: rows by state for each group."""
    return Q.state_counts(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", {"finished": ["F"], "open": ["O", "P"]})


@query("q2_state_shares", "select o_orderpriority, count(case when o_orderstatus = 'F' then 1 end) / nullif(count(*), 0)::double as approved_share, count(case when o_orderstatus = 'P' then 1 end) / nullif(count(*), 0)::double as rejected_share from orders group by 1")
def q2_state_shares(spark: SparkSession, d: str) -> DataFrame:
    """Q2: shares of two states in each group."""
    return Q.state_shares(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", {"approved": ["F"], "rejected": ["P"]})


@query("q3_cycle_times", _FACTS + ", d as (select o_orderpriority, date_diff('day', o_orderdate::date, ended::date) as n from f) select o_orderpriority, count(n) as finished, sum(n)::bigint as days, avg(n) as average, max(n) as longest, count(case when n <= 60 then 1 end) as in_time, count(case when n <= 60 then 1 end) / nullif(count(n), 0)::double as in_time_share from d group by 1")
def q3_cycle_times(spark: SparkSession, d: str) -> DataFrame:
    """Q3, Q4: days from the first to the last date, and the share in time."""
    return Q.cycle_times(_facts(spark, d), ["o_orderpriority"], "o_orderdate", "ended", 60)


@query("q5_pending_age", "select o_orderpriority, count(*) as pending, sum(n)::bigint as days, avg(n) as average, max(n) as oldest, count(case when n > 1000 then 1 end) as stuck from (select o_orderpriority, date_diff('day', o_orderdate::date, date '1999-01-01') as n from orders where o_orderstatus = 'O') group by 1")
def q5_pending_age(spark: SparkSession, d: str) -> DataFrame:
    """Q5: the age of open rows at a fixed day."""
    return Q.pending_age(table(spark, d, "orders"), ["o_orderpriority"], "o_orderdate", F.col("o_orderstatus") == "O", F.lit("1999-01-01").cast("date"), 1_000)


_DUE = _FACTS + ", g as (select f.*, o_orderdate::date + 60 as due, o_orderstatus = 'O' as is_open from f), h as (select *, date_diff('day', o_orderdate::date, ended::date) as cycle_days, case when is_open then date_diff('day', o_orderdate::date, date '1998-06-01') else 0 end as queue_days, is_open and due < date '1998-06-01' as is_overdue from g)"
_STATES = {"pending": ["O"], "approved": ["F"], "rejected": ["P"]}
_AS_OF = "1998-06-01"


def _dated(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d).withColumn("due", F.date_add(F.to_date("o_orderdate"), 60))


def _people(spark: SparkSession, d: str, person: str) -> DataFrame:
    return Q.person_measures(_dated(spark, d), person, "o_orderstatus", _STATES, "o_orderdate", "ended", "due", F.col("o_totalprice") < 1_000, F.lit(_AS_OF).cast("date"))


_PERSON = _DUE + " select {0} as person, count(*) as total, count(case when o_orderstatus = 'O' then 1 end) as pending, count(case when o_orderstatus = 'F' then 1 end) as approved, count(case when o_orderstatus = 'P' then 1 end) as rejected, count(case when is_overdue then 1 end) as overdue, count(case when is_open and due = date '1998-06-01' then 1 end) as due_today, count(case when o_totalprice < 1000 then 1 end) as again, max(case when is_open then queue_days end) as oldest, avg(cycle_days) as average_days from h group by 1"


@query("q7_requester_measures", _PERSON.format("o_custkey"))
def q7_requester_measures(spark: SparkSession, d: str) -> DataFrame:
    """Q7, Q9: the measures of every requester."""
    return _people(spark, d, "o_custkey")


@query("q8_approver_measures", _PERSON.format("o_orderpriority"))
def q8_approver_measures(spark: SparkSession, d: str) -> DataFrame:
    """Q8: the measures of every approver."""
    return _people(spark, d, "o_orderpriority")


@query("q9_selected_label", "select case when min(o_orderstatus) = max(o_orderstatus) then min(o_orderstatus) when count(o_orderstatus) > 0 then '(several)' end as label from orders")
def q9_selected_label(spark: SparkSession, d: str) -> DataFrame:
    """Q9: the label of a selection."""
    return Q.selected_label(table(spark, d, "orders"), "o_orderstatus")


@query("q12_age_columns", _DUE + " select o_orderkey, cycle_days, queue_days, is_overdue from h")
def q12_age_columns(spark: SparkSession, d: str) -> DataFrame:
    """Q10, Q12: days of the cycle and in the queue, and whether a row is overdue."""
    rows = Q.with_age_columns(_dated(spark, d), "o_orderdate", "ended", "due", F.col("o_orderstatus") == "O", F.lit(_AS_OF).cast("date"))
    return rows.select("o_orderkey", "cycle_days", "queue_days", "is_overdue")


@query("q13_board", "select o_orderstatus, o_orderkey, row_number() over (partition by o_orderstatus order by o_orderdate desc, o_orderkey) as place, count(*) over (partition by o_orderstatus) as cards from orders")
def q13_board(spark: SparkSession, d: str) -> DataFrame:
    """Q13: the cards of every state, the latest first, with their number."""
    return Q.board(table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate"), "o_orderstatus", [F.desc("o_orderdate"), F.asc("o_orderkey")], ["o_orderkey", "o_orderdate"]).drop("o_orderdate")


@query("q14_stage_queue", _DUE + " select o_orderkey, queue_days as days, row_number() over (order by queue_days desc, o_orderkey) as place from h where o_orderstatus = 'O' and lower(o_orderpriority) = '1-urgent'")
def q14_stage_queue(spark: SparkSession, d: str) -> DataFrame:
    """Q14: one person's rows of a stage, the longest waiting first."""
    rows = Q.with_age_columns(_dated(spark, d), "o_orderdate", "ended", "due", F.col("o_orderstatus") == "O", F.lit(_AS_OF).cast("date"))
    return Q.stage_queue(rows, "o_orderstatus", "O", "queue_days", "o_orderkey", "o_orderpriority", "1-URGENT")


@query("q15_reviews_due", "select o_orderkey, due, abs(n) as days, case when n < 0 then 'overdue' else 'due' end as status from (select o_orderkey, o_orderdate::date + 365 as due, date_diff('day', date '1998-06-01', o_orderdate::date + 365) as n from orders) where n <= 90")
def q15_reviews_due(spark: SparkSession, d: str) -> DataFrame:
    """Q15: reviews due within 90 days, and those overdue."""
    rows = table(spark, d, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 365).alias("due"))
    return Q.reviews_due(rows, "o_orderkey", "due", F.lit(_AS_OF).cast("date"), 90)


@query(
    "q6_month_over_month",
    """with m as (select date_trunc('month', o_orderdate)::date as month, count(*) as n from orders group by 1), a as (select unnest(generate_series(min(month), max(month), interval 1 month))::date as month from m),
    j as (select a.month, coalesce(n, 0) as n, lag(coalesce(n, 0)) over (order by a.month) as before from a left join m on a.month = m.month) select month, n, before, n - before as change, (n - before) / nullif(before, 0)::double as change_share from j""",
)
def q6_month_over_month(spark: SparkSession, d: str) -> DataFrame:
    """Q6: rows of each month against the month before."""
    return Q.month_over_month(table(spark, d, "orders"), "o_orderdate")


@query("q10_date_table", "select d::date as day, year(d) as year, month(d) as month, isodow(d) - 1 as weekday from (select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day)) as d from orders)")
def q10_date_table(spark: SparkSession, d: str) -> DataFrame:
    """Q10: every day of a column's range."""
    return Q.date_table(table(spark, d, "orders"), "o_orderdate")


@query("q11_pivot", "select o_orderpriority, count(case when o_orderstatus = 'F' then 1 end) as f, count(case when o_orderstatus = 'O' then 1 end) as o, count(case when o_orderstatus = 'P' then 1 end) as p from orders group by 1")
def q11_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Q11: groups against states."""
    rows = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    return rows.withColumnsRenamed({"F": "f", "O": "o", "P": "p"})


@query("q11_leaders", "select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 10")
def q11_leaders(spark: SparkSession, d: str) -> DataFrame:
    """Q11: the ten customers with most orders."""
    return Q.leaders(table(spark, d, "orders"), "o_custkey", 10)


@query("q11_by_month", "select date_trunc('month', o_orderdate)::date as month, o_orderstatus, count(*) as n from orders group by 1, 2")
def q11_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Q11: rows by month and state."""
    return table(spark, d, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_ENTRY = "'- **' || control_id || '**' || case when length(control_name) > 0 then ' | ' || control_name else '' end || ' | ' || coalesce(control_description, '') || case when length(baseline) > 0 then chr(10) || '  - *baseline*: ' || baseline else '' end"


@query("e17_reference_text", f"with l as (select coalesce(extraction_source, 'Ungrouped') as dom, row_id as o, {_ENTRY} as line from control_row), g as (select dom, min(o) as f, '### ' || dom || chr(10) || string_agg(line, chr(10) order by o) as t from l group by 1) select '# Controls' || chr(10) || chr(10) || string_agg(t, chr(10) || chr(10) order by f) as content from g")
def e17_reference_text(spark: SparkSession, d: str) -> DataFrame:
    """The reference of all controls by domain."""
    rows = table(spark, d, "control_row").select(F.col("row_id").alias("ord"), F.col("extraction_source").alias("domain"), F.col("control_id").alias("id"), F.col("control_name").alias("title"), F.col("control_description").alias("description"), "baseline")
    return E.reference_text(rows, "Controls", ("baseline",))


_value = lambda c: f"trim(coalesce({c}, ''), ' ')"
_RENDERED = f"""with v as (select row_id, {_value('control_id')} as a, {_value('control_name')} as b, {_value('baseline')} as c from control_row), e as (
  select row_id, 'row_as_heading' as mode, 0 as k, 'heading' as kind, 2 as level, a as text from v union all select row_id, 'row_as_heading', 1, 'paragraph', null, case when b <> '' then 'control_name: ' || b else '' end from v union all select row_id, 'row_as_heading', 2, 'paragraph', null, case when c <> '' then 'baseline: ' || c else '' end from v
  union all select row_id, 'key_value', 0, 'paragraph', null, case when a <> '' then 'control_id: ' || a else '' end from v union all select row_id, 'key_value', 1, 'paragraph', null, case when b <> '' then 'control_name: ' || b else '' end from v union all select row_id, 'key_value', 2, 'paragraph', null, case when c <> '' then 'baseline: ' || c else '' end from v
  union all select row_id, 'table', 0, 'table', null, '| ' || replace(a, '|', '\\|') || ' | ' || replace(b, '|', '\\|') || ' | ' || replace(c, '|', '\\|') || ' |' from v union all select row_id, 'list', 0, 'list', null, concat_ws(' - ', nullif(a, ''), nullif(b, ''), nullif(c, '')) from v union all select row_id, 'prose', 0, 'paragraph', null, concat_ws(' ', nullif(a, ''), nullif(b, ''), nullif(c, '')) from v)
select mode, row_id, row_number() over (partition by mode, row_id order by k) - 1 as pos, kind, level::bigint as level, text from e where text <> ''"""


@query("k21_rendered_rows", _RENDERED)
def k21_rendered_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a sheet as elements, in each of the five ways."""
    rows = table(spark, d, "control_row")
    frames = [E.render_rows(rows, "row_id", ("control_id", "control_name", "baseline"), m).withColumn("mode", F.lit(m)) for m in E.MODES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
