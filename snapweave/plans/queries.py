"""Queries over the driver's tables: each applies operators of this package, and has SQL for an independent engine where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.functions import scalars, text
from snapweave.operators import linkage, picks, profiling, quality, revisions, snapshot, spatial, timeseries, upsert
from snapweave.sources.documents import html_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DATES = [f"2024-01-{d:02d}" for d in range(1, 6)]


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and day is the user's state that day."""
    e = t(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return e.groupBy("day", "user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "value")).alias("_e")).select("day", "user_id", F.col("_e.event_type").alias("state"), F.col("_e.value").alias("value"))


_STATES = """s as (select day, user_id, event_type as state, value from (select cast(ts as date) as day, user_id, event_type, value, row_number() over (partition by cast(ts as date), user_id order by ts desc, event_id desc) as rn from events) where rn = 1)"""
_DIFF = (
    "with "
    + _STATES
    + """, d as (select day, lag(day) over (order by day) as prev from (select distinct day from s)),
p as (select s.day, s.user_id, o.state as before, s.state as after, case when o.state is null then 'new' when o.state = s.state then 'unchanged' when s.state = 'error' then 'opened' when o.state = 'error' then 'closed' else 'open_state_changed' end as label from s join d on s.day = d.day left join s o on o.day = d.prev and o.user_id = s.user_id),
g as (select d.day, o.user_id, o.state as before, cast(null as varchar) as after, 'removed_from_listing' as label from d join s o on o.day = d.prev left join s n on n.day = d.day and n.user_id = o.user_id where n.user_id is null),
a as (select * from p union all select * from g) """
)


@query(_DIFF + "select day, label, count(*) as n_rows, count(distinct user_id) as n_subjects from a group by all")
def snapshot_diff_counts(spark, sf_dir):
    return snapshot.day_counts(snapshot.consecutive_days(states(spark, sf_dir), "day", "user_id", "state", "error"), "day", "label", "user_id")


@query(_DIFF + "select day, user_id, before, after, label from a")
def snapshot_diff_rows(spark, sf_dir):
    return snapshot.consecutive_days(states(spark, sf_dir), "day", "user_id", "state", "error").select("day", "user_id", "before", "after", "label")


@query(_DIFF + "select day, user_id, before, label from g")
def snapshot_removed(spark, sf_dir):
    return snapshot.consecutive_days(states(spark, sf_dir), "day", "user_id", "state", "error").where("label = 'removed_from_listing'").select("day", "user_id", "before", "label")


@query(
    "with "
    + _STATES
    + """, c as (select *, state <> 'error' as is_open, case when value >= 50 then 'high' else 'low' end as band from s where day = date '2024-01-03'), p as (select *, state <> 'error' as is_open, case when value >= 50 then 'high' else 'low' end as band from s where day = date '2024-01-02')
select c.user_id, c.state, case when p.user_id is null then 'new' when p.state = c.state and p.band = c.band then 'unchanged' else concat_ws(';', case when not p.is_open and c.is_open then 'opened' when p.is_open and not c.is_open then 'closed' end, case when p.state <> c.state then 'state_changed' end, case when p.band <> c.band then 'band_changed' end) end as change_type
from c left join p on c.user_id = p.user_id"""
)
def multi_field_change_list(spark, sf_dir):
    s = states(spark, sf_dir).withColumns({"is_open": F.col("state") != "error", "band": F.when(F.col("value") >= 50, "high").otherwise("low")})
    day = lambda d: s.where(F.col("day") == F.to_date(F.lit(d))).drop("day")
    tracked = (snapshot.TrackedField("state", "state_changed", "state"), snapshot.TrackedField("band", "band_changed", "band"))
    return snapshot.diff(day("2024-01-03"), day("2024-01-02"), "user_id", tracked=tracked).select("user_id", "state", "change_type")


@query(
    """with w as (select * from (select o_custkey, o_orderstatus, o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1996-04-01') where rn = 1)
select c.c_custkey as custkey, coalesce(w.o_orderstatus, 'not listed') as status, w.o_totalprice as price, case when w.o_custkey is null then 'default' else 'listed' end as source from customer c left join w on c.c_custkey = w.o_custkey
union all select w.o_custkey, w.o_orderstatus, w.o_totalprice, 'unmatched' from w left join customer c on c.c_custkey = w.o_custkey where c.c_custkey is null"""
)
def population_overlay(spark, sf_dir):
    o = t(spark, sf_dir, "orders").where("o_orderdate >= '1996-01-01' and o_orderdate < '1996-04-01'")
    listed = o.select(F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.struct("o_orderdate", "o_orderkey").alias("_ord"))
    population = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return snapshot.overlay(population, listed, "custkey", {"status": F.lit("not listed")}, tie="_ord").select("custkey", "status", "price", "source")


@query(
    """with e as (select o_orderkey as id, o_orderpriority as name, o_totalprice as amount, case when o_orderkey % 3 = 0 then 'missing' when o_orderkey % 11 = 0 then 'preserved_previous_parsed' else 'parsed' end as status from orders where o_orderkey % 10 < 7),
n as (select o_orderkey as id, upper(o_orderstatus) as name, case when o_orderkey % 5 = 0 then null else o_totalprice + 1 end as amount, case when o_orderkey % 5 = 0 then 'missing' else 'parsed' end as status from orders where o_orderkey % 10 >= 4)
select coalesce(n.id, e.id) as id, case when n.id is null then e.name else n.name end as name, case when n.id is null then e.amount when n.status <> 'parsed' and e.status in ('parsed', 'preserved_previous_parsed') then e.amount else n.amount end as amount, case when n.id is null then e.status when n.status <> 'parsed' and e.status in ('parsed', 'preserved_previous_parsed') then 'preserved_previous_parsed' else n.status end as status
from e full outer join n on e.id = n.id"""
)
def master_upsert_preserve(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    old = o.where(k % 10 < 7).select(k.alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("amount"), F.when(k % 3 == 0, "missing").when(k % 11 == 0, upsert.PRESERVED).otherwise(upsert.PARSED).alias("status"))
    bad = k % 5 == 0
    new = o.where(k % 10 >= 4).select(k.alias("id"), F.upper("o_orderstatus").alias("name"), F.when(~bad, F.col("o_totalprice") + 1).alias("amount"), F.when(bad, "missing").otherwise(upsert.PARSED).alias("status"))
    return upsert.merge_master(old, new, ["id"], ["amount"], "status")


@query(
    """with l as (select o_orderdate as at, o_orderkey as id, o_totalprice as v from orders where o_orderkey % 4 <> 0), n as (select o_orderdate as at, o_orderkey as id, o_totalprice * 2 as v from orders where o_orderkey % 4 = 1 or o_orderkey % 4 = 0)
select * from l where not exists (select 1 from n where n.at = l.at and n.id = l.id) union all select * from n"""
)
def keyed_log_upsert(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    log = o.where("o_orderkey % 4 <> 0").select(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    new = o.where("o_orderkey % 4 in (0, 1)").select(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("v"))
    return upsert.upsert_log(log, new, ["at", "id"], ["at", "id"])


@query(
    """select day, user_id, event_id, event_type from (select cast(ts as date) as day, user_id, event_id, event_type, row_number() over (partition by cast(ts as date), user_id order by case event_type when 'purchase' then 2 when 'view' then 1 else 0 end desc, case when value >= 50 then 1 else 0 end desc, event_id) as rn from events) where rn = 1"""
)
def priority_pick_first_wins(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    p = [F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "view", 1).otherwise(0), F.when(F.col("value") >= 50, 1).otherwise(0)]
    return picks.first_wins(e, ["day", "user_id"], p, "event_id").select("day", "user_id", "event_id", "event_type")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def last_wins_index(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("_ord", F.struct("ts", "event_id"))
    return picks.last_wins(e, ["user_id"], "_ord").select("user_id", "event_id", "event_type")


def _pivot_sql(value: str, default: str | None) -> str:
    cells = ", ".join((f"coalesce(max(case when day = date '{d}' then {value} end), {default})" if default else f"max(case when day = date '{d}' then {value} end)") + f' as "{d}"' for d in DATES)
    return f"with {_STATES} select user_id, {cells} from s where day between date '{DATES[0]}' and date '{DATES[-1]}' group by user_id"


def _pivot(spark, sf_dir, value, default):
    s = states(spark, sf_dir).where(F.col("day").between(F.to_date(F.lit(DATES[0])), F.to_date(F.lit(DATES[-1])))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
    return timeseries.pivot_dates(s, ["user_id"], "day", value, DATES, default)


@query(_pivot_sql("state", "'absent'"))
def pivot_status_by_date(spark, sf_dir):
    return _pivot(spark, sf_dir, F.col("state"), "absent")


@query(_pivot_sql("case when state = 'error' then null when state = 'signup' then 0 else 1 end", None))
def pivot_open_by_date(spark, sf_dir):
    return _pivot(spark, sf_dir, F.when(F.col("state") == "signup", 0).when(F.col("state") != "error", 1), None)


@query(_pivot_sql("case when state = 'error' then '状態不明' when state = 'signup' then '未開設' when value >= 50 then '開設（high）' else '開設（不明）' end", "'未開設'"))
def pivot_label_by_date(spark, sf_dir):
    state = F.when(F.col("state") != "error", F.col("state") != "signup")
    return _pivot(spark, sf_dir, scalars.status_label(state, F.when(F.col("value") >= 50, "high").otherwise("---")), "未開設")


@query("select user_id, arg_max(event_type, epoch_us(ts) * 1000000 + event_id) filter (where event_type <> 'view') as event_type, arg_max(props, epoch_us(ts) * 1000000 + event_id) filter (where props like '%5%') as props from (select user_id, cast(ts as timestamp) as ts, event_id, event_type, props from events) group by user_id".replace("epoch_us(ts) * 1000000 + event_id", "(cast(epoch_us(ts) as hugeint) * 1000000000 + event_id)"))
def last_non_blank_attributes(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), F.when(F.contains("props", F.lit("5")), F.col("props")).otherwise("").alias("props"))
    return timeseries.last_non_blank(e, ["user_id"], ["event_type", "props"], ["ts", "event_id"])


_MONTHS = ["1995-01", "1995-02", "1995-03"]


@query("select c_custkey as custkey, " + ", ".join(f"max(case when m = '{m}' then n end) as \"{m}\"" for m in _MONTHS) + " from customer left join (select o_custkey, strftime(o_orderdate, '%Y-%m') as m, count(*) as n from orders group by all) on o_custkey = c_custkey group by c_custkey")
def wide_counts_blank_not_zero(spark, sf_dir):
    n = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey"), F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.count("*").alias("n"))
    return timeseries.wide_counts(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), n.where(F.col("m").isin(_MONTHS)), "custkey", "m", "n", _MONTHS)


def _observations(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"), F.sha2("event_type", 256).alias("content"), "event_id")
    log = e.where("event_id % 2 = 0").groupBy("user_id", "day", "content").agg(F.min("event_id").alias("event_id"))
    from pyspark.sql import Window

    return log.withColumn("revision", F.row_number().over(Window.partitionBy("user_id", "day").orderBy("event_id"))), e.where("event_id % 2 = 1")


_LOG = """e as (select user_id, cast(ts as date) as day, sha256(event_type) as content, event_id from events), l as (select *, cast(row_number() over (partition by user_id, day order by event_id) as int) as revision from (select user_id, day, content, min(event_id) as event_id from e where event_id % 2 = 0 group by all))"""
_NEW = """, f as (select i.user_id, i.day, i.content, min(i.event_id) as event_id from e i left join l on l.user_id = i.user_id and l.day = i.day and l.content = i.content where i.event_id % 2 = 1 and l.content is null group by all), n as (select f.user_id, f.day, f.content, f.event_id, cast(coalesce((select max(revision) from l where l.user_id = f.user_id and l.day = f.day), 0) + row_number() over (partition by f.user_id, f.day order by f.event_id) as int) as revision from f)"""


@query(f"with {_LOG}{_NEW} select user_id, day, content, event_id, revision from n")
def revision_assign(spark, sf_dir):
    log, incoming = _observations(spark, sf_dir)
    return revisions.assign_revisions(incoming, log, "user_id", "day", "content", "event_id").select("user_id", "day", "content", "event_id", "revision")


@query(f"with {_LOG} select user_id, day, content, event_id, revision from (select *, max(revision) over (partition by user_id, day) as m from l) where revision = m")
def latest_revision(spark, sf_dir):
    return revisions.latest_revision(_observations(spark, sf_dir)[0], "user_id", "day").select("user_id", "day", "content", "event_id", "revision")


@query(f"with {_LOG}, m as (select *, max(day) over (partition by user_id) as last from l), k as (select *, max(revision) over (partition by user_id, day) as top from m where day = last) select user_id, day, content, revision from k where revision = top")
def latest_per_group(spark, sf_dir):
    return revisions.latest_observation(_observations(spark, sf_dir)[0], "user_id", "day").select("user_id", "day", "content", "revision")


@query("select day, source_n, sha256(rows) as content_hash from (select cast(ts as date) as day, count(*) as source_n, '[' || string_agg('{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}', ',' order by event_type, user_id, event_id) || ']' as rows from events group by 1)")
def snapshot_content_hash(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    n = e.groupBy("day").agg(F.count("*").alias("source_n"))
    return n.join(revisions.snapshot_hash(e, ["day"], ["event_type", "user_id", "event_id"], ["event_type", "user_id"]), "day")


@query("select min(doc_id) as doc_id, any_value(lang) as lang from documents group by text, lang")
def dedup_first_seen(spark, sf_dir):
    return picks.dedup_first_seen(t(spark, sf_dir, "documents"), ["text", "lang"], "doc_id").select("doc_id", "lang")


@query("select c_custkey, substr(sha256(concat(c_mktsegment, '|', c_name, '|', c_nationkey)), 1, 20) as id, substr(sha256(concat(c_mktsegment, '|', c_name, '|', c_nationkey)), 1, 24) as match_key from customer")
def stable_id(spark, sf_dir):
    parts = [F.col("c_mktsegment"), F.col("c_name"), F.col("c_nationkey")]
    return t(spark, sf_dir, "customer").select("c_custkey", scalars.stable_id(*parts).alias("id"), scalars.match_key(*parts).alias("match_key"))


@query("select p_partkey, sha256(concat(p_name, '|', p_brand, '|', p_type, '|', p_size)) as hash from part")
def record_hash(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", scalars.record_hash([F.col(c) for c in ("p_name", "p_brand", "p_type", "p_size")]).alias("hash"))


@query("""with g as (select s_nationkey % 5 as grp, cast(s_suppkey as varchar) as id, s_nationkey from supplier), k as (select s_nationkey, list_sort(list(id) filter (where grp > 1)) as ids, min(id) as web from g group by s_nationkey)
select s_nationkey, case when ids is null or len(ids) = 0 then 'web:' || web when len(ids) = 1 then 'ref:' || ids[1] else 'refgroup:' || substr(sha256(array_to_string(ids, '|')), 1, 20) end as tracking_id from k""")
def tracking_id(spark, sf_dir):
    g = t(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.when(F.col("s_nationkey") % 5 > 1, F.col("s_suppkey").cast("string")))).alias("ids"), F.min(F.col("s_suppkey").cast("string")).alias("web"))
    return g.select("s_nationkey", scalars.tracking_id(F.col("ids"), F.col("web")).alias("tracking_id"))


_CELLS = "case o_orderkey % 8 when 0 then '開設' when 1 then '閉鎖' when 2 then '---' when 3 then '' when 4 then '不明' when 5 then '開設（未開設）' when 6 then '開所 中' else 'other' end"


@query(f"select o_orderkey, case when s in ('---', '-') then 'false' when s in ('', '不明', '未入力') then 'unknown' when regexp_matches(s, '閉鎖|未開設|閉設|解除|終了|休止') then 'false' when regexp_matches(s, '開設|開所') then 'true' else 'unknown' end as state from (select o_orderkey, {_CELLS} as s from orders)")
def status_classifier(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.open_text(scalars.open_state(F.expr(_CELLS))).alias("state"))


@query("select event_id, cast(nullif(replace(regexp_extract(props, '-?[0-9][0-9,]*'), ',', ''), '') as bigint) as n from events")
def parse_int(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", scalars.parse_int(F.col("props")).alias("n"))


_RAW = "case p_partkey % 6 when 0 then null when 1 then '0' when 2 then '1,' || lpad(cast(p_size as varchar(10)), 3, '0') when 3 then '-' || p_size when 4 then 'abc' else cast(p_size as varchar(10)) end"


@query(f"select p_partkey, coalesce(r, '') as raw, case when n > 0 then n end as persons, case when r is null then 'missing' when n is null then 'invalid' when n = 0 then 'missing_zero' when n < 0 then 'invalid_negative' else 'parsed' end as status from (select p_partkey, r, try_cast(replace(r, ',', '') as bigint) as n from (select p_partkey, {_RAW} as r from part))")
def parse_capacity(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", scalars.parse_capacity(F.expr(_RAW)).alias("c")).select("p_partkey", "c.raw", "c.persons", "c.status")


@query("""select o_orderkey, case when o_orderkey % 4 = 3 then null else o_orderdate end as at from (select o_orderkey, date_trunc('minute', o_orderdate) as o_orderdate from orders)""")
def parse_datetime_variants(spark, sf_dir):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format(d, "yyyy/M/d H:mm")).when(k == 1, F.date_format(d, "yyyy年M月d日H時m分")).when(k == 2, F.concat(F.lit("as of "), F.date_format(d, "yyyy/MM/dd HH:mm"), F.lit(" now"))).otherwise(F.date_format(d, "yyyy/13/d H:mm"))
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.parse_datetime(written).cast("timestamp_ntz").alias("at"))


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then make_timestamp(2018 + cast(1 + o_orderkey % 7 as bigint), month(d), day(d), hour(d), minute(d), 0.0) else make_timestamp(case when o_orderkey % 3 = 1 then 2024 else 2020 end, month(d), day(d), hour(d), minute(d), 0.0) end as at from (select o_orderkey, date '2000-01-01' + cast(o_orderkey % 28 as int) + interval 1 minute * (o_orderkey % 1440) as d from orders)""")
def era_datetime(spark, sf_dir):
    k = F.col("o_orderkey")
    day, hour, minute = (k % 28 + 1).cast("string"), F.floor(k % 1440 / 60).cast("int"), (k % 60).cast("string")
    h12 = F.concat(F.when(hour < 12, "午前").otherwise("午後"), F.when(hour > 12, hour - 12).otherwise(hour).cast("string"))
    era = F.concat(F.lit("令和 "), (k % 7 + 1).cast("string"), F.lit("年 1月"), day, F.lit("日 現在 "), hour.cast("string"), F.lit("時"), minute, F.lit("分"))
    plain = F.concat(F.when(k % 3 == 1, "2024年").otherwise(""), F.lit("1月"), day, F.lit("日 "), h12, F.lit("時"), minute, F.lit("分"))
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.era_datetime(F.when(k % 3 == 0, era).otherwise(plain), F.lit(2020)).cast("timestamp_ntz").alias("at"))


@query("select page_id, regexp_extract(url, '^(.+?(?:com|org|net))', 1) as place, regexp_extract(url, '^https?://([^/]+)/([a-z]+)', 2) as section from pages")
def municipality_extract(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.infer_municipality(F.col("url"), "com|org|net").alias("place"), F.regexp_extract("url", "^https?://([^/]+)/([a-z]+)", 2).alias("section"))


@query("select p_partkey, regexp_extract(p_name, '^([A-Za-z]+)', 1) as head, upper(regexp_extract(p_brand, '([0-9]+)$', 1)) as number from part")
def regex_projection(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_name", "^([A-Za-z]+)", 1).alias("head"), F.upper(F.regexp_extract("p_brand", "([0-9]+)$", 1)).alias("number"))


@query("select coalesce(nullif(trim(case when o_orderkey % 9 = 0 then ' ' else o_orderpriority end), ''), '(blank)') as value, count(*) as n from orders group by 1")
def value_frequency(spark, sf_dir):
    return quality.value_frequency(t(spark, sf_dir, "orders").withColumn("p", F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.col("o_orderpriority"))), "p")


@query("select o_orderpriority, count(*) as n, count(*) filter (where o_orderstatus = 'F') as n_matched, round(count(*) filter (where o_orderstatus = 'F') / count(*), 6) as rate from orders group by 1")
def match_rate(spark, sf_dir):
    return quality.match_rate(t(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", ["o_orderpriority"]).withColumn("rate", F.round("rate", 6))


@query("select o_orderkey, round(o_totalprice, 2) as published, round(s, 2) as calculated, abs(coalesce(s, 0) - o_totalprice) <= 0.01 as agrees from orders left join (select l_orderkey, sum(l_extendedprice * (1 + l_tax) * (1 - l_discount)) as s from lineitem group by 1) on l_orderkey = o_orderkey")
def control_total_check(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    amount = F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))
    return quality.control_total(lines, t(spark, sf_dir, "orders"), "o_orderkey", amount, "o_totalprice", 0.01).select("o_orderkey", F.round("published", 2).alias("published"), F.round("calculated", 2).alias("calculated"), "agrees")


@query("select a.p_partkey as left_key, b.p_partkey as right_key from part a join part b on a.p_name = b.p_name and a.p_brand = b.p_brand and a.p_partkey < b.p_partkey")
def exact_key_join(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    right = p.select(F.col("p_partkey").alias("right_key"), "p_name", "p_brand")
    return p.select(F.col("p_partkey").alias("left_key"), "p_name", "p_brand").join(right, ["p_name", "p_brand"]).where("left_key < right_key").select("left_key", "right_key")


@query("with m as (select p_name, p_brand, count(*) as n, min(p_partkey) as id from part where p_partkey % 2 = 0 group by all) select p_partkey, case when n = 1 then 'matched' when n > 1 then 'ambiguous' else 'unmatched' end as status, case when n = 1 then id end as matched_id, coalesce(n, 0) as n_candidates from part left join m using (p_name, p_brand) where p_partkey % 2 = 1")
def unique_or_ambiguous(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    out = linkage.unique_or_ambiguous(p.where("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_brand"), p.where("p_partkey % 2 = 0"), ["p_name", "p_brand"], "p_partkey")
    return out.select("p_partkey", "status", "matched_id", "n_candidates")


@query("""with s as (select * from part where p_partkey % 2 = 1), m as (select * from part where p_partkey % 2 = 0),
x3 as (select p_name, p_brand, p_type, count(*) as n, min(p_partkey) as id from m group by all), x2 as (select p_name, p_brand, count(*) as n, min(p_partkey) as id from m group by all), x1 as (select p_name, count(*) as n, min(p_partkey) as id from m group by all)
select s.p_partkey, case when x3.n = 1 then 'matched' when x3.n > 1 then 'ambiguous' when x2.n = 1 then 'matched' when x2.n > 1 then 'ambiguous' when x1.n = 1 then 'matched' else 'unmatched' end as status, case when x3.n = 1 then 'triple' when x3.n > 1 then 'duplicate_triple' when x2.n = 1 then 'name_brand' when x2.n > 1 then 'duplicate_name_brand' when x1.n = 1 then 'unique_name' else 'no_candidate' end as method, case when x3.n = 1 then x3.id when x3.n > 1 then null when x2.n = 1 then x2.id when x2.n > 1 then null when x1.n = 1 then x1.id end as id
from s left join x3 using (p_name, p_brand, p_type) left join x2 on x2.p_name = s.p_name and x2.p_brand = s.p_brand left join x1 on x1.p_name = s.p_name""")
def tier_cascade_exact(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    master = p.where("p_partkey % 2 = 0")

    def tier(keys, one, several):
        groups = master.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("p_partkey").cast("string").alias("_id"))

        def run(rest):
            hit = rest.join(groups, keys)
            hit = hit if several else hit.where("_n = 1")
            single = F.col("_n") == 1
            return hit.select("p_partkey", *linkage.decision(F.when(single, "matched").otherwise("ambiguous"), F.when(single, one).otherwise(several or ""), F.when(single, 1.0).otherwise(0.0), F.when(single, F.array("_id")).otherwise(F.array().cast("array<string>"))))

        return run

    tiers = [tier(["p_name", "p_brand", "p_type"], "triple", "duplicate_triple"), tier(["p_name", "p_brand"], "name_brand", "duplicate_name_brand"), tier(["p_name"], "unique_name", None)]
    out = linkage.cascade(p.where("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_brand", "p_type"), "p_partkey", tiers)
    return out.select("p_partkey", "status", "method", F.element_at(F.when(F.size("matches") > 0, F.col("matches")), 1).cast("long").alias("id"))


@query("select s_nationkey, s_suppkey, s_acctbal, runner_up, round(s_acctbal - runner_up, 2) as margin from (select *, coalesce(lead(s_acctbal) over (partition by s_nationkey order by s_acctbal desc, s_suppkey), 0) as runner_up, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as rn from supplier) where rn = 1")
def topk_margin(spark, sf_dir):
    out = picks.top_with_margin(t(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", "s_suppkey")
    return out.select("s_nationkey", "s_suppkey", "s_acctbal", "runner_up", F.round("margin", 2).alias("margin"))


@query("select s_nationkey, s_suppkey, cast(rn as int) as rank from (select *, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as rn from supplier) where rn <= 3")
def topk_candidates(spark, sf_dir):
    return picks.top_k(t(spark, sf_dir, "supplier"), ["s_nationkey"], [F.desc("s_acctbal"), F.asc("s_suppkey")], 3).select("s_nationkey", "s_suppkey", "rank")


_LAT, _LON = "32.0 + ({k} * 7919 % 1000) / 1000.0", "130.0 + ({k} * 104729 % 1000) / 1000.0"


def _point(name: str, key: str) -> str:
    return _LAT.format(k=key) if name == "lat" else _LON.format(k=key)


def _points(spark, sf_dir):
    d = lambda name, key: F.expr(f"cast({_point(name, key)} as double)")
    c = t(spark, sf_dir, "customer").select("c_custkey", d("lat", "c_custkey").alias("c_lat"), d("lon", "c_custkey").alias("c_lon"))
    s = t(spark, sf_dir, "supplier").select("s_suppkey", d("lat", "s_suppkey * 3").alias("s_lat"), d("lon", "s_suppkey * 3").alias("s_lon"))
    return c, s


_NEAR = f"""p as (select c_custkey, s_suppkey, 2 * 6371008.8 * asin(least(1.0, sqrt(h))) as m from (select c_custkey, s_suppkey, pow(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin(radians(b.lo - a.lo) / 2), 2) as h from (select c_custkey, cast({_point('lat', 'c_custkey')} as double) as la, cast({_point('lon', 'c_custkey')} as double) as lo from customer) a, (select s_suppkey, cast({_point('lat', '(s_suppkey * 3)')} as double) as la, cast({_point('lon', '(s_suppkey * 3)')} as double) as lo from supplier) b where abs(a.la - b.la) < 0.05 and abs(a.lo - b.lo) < 0.06))"""


@query(f"with {_NEAR} select c_custkey, s_suppkey, round(m, 3) as distance_m from p where m <= 3000")
def haversine_radius_join(spark, sf_dir):
    c, s = _points(spark, sf_dir)
    return spatial.radius_join(c, s, 3000.0, "c_lat", "c_lon", "s_lat", "s_lon", 34.0).select("c_custkey", "s_suppkey", F.round("distance_m", 3).alias("distance_m"))


@query(f"with {_NEAR}, r as (select *, row_number() over (partition by c_custkey order by m, s_suppkey) as rn, lead(m) over (partition by c_custkey order by m, s_suppkey) as m2 from p where m <= 3000) select c_custkey, s_suppkey, case when m2 - m < 400 then 'ambiguous' when m <= 1000 then 'matched' else 'unmatched' end as status from r where rn = 1")
def spatial_near_tie(spark, sf_dir):
    c, s = _points(spark, sf_dir)
    # customers of one place have one answer, which needs the two nearest suppliers only
    places = c.select("c_lat", "c_lon").distinct().withColumn("place", F.struct("c_lat", "c_lon"))
    near = spatial.radius_join(places, spatial.first_targets(s, ["s_lat", "s_lon"], "s_suppkey"), 3000.0, "c_lat", "c_lon", "s_lat", "s_lon", 34.0).withColumns({"name_score": F.lit(1.0), "address_score": F.lit(1.0)})
    rules = spatial.Acceptance(tie_m=400.0, tiers=((1000.0, 0.55, 0.0, 0.0), (1000.0, 0.55, 0.0, 0.0)))
    out = c.join(spatial.accept_nearest(near, "place", tie="s_suppkey", rules=rules), ["c_lat", "c_lon"])
    return out.select("c_custkey", "s_suppkey", F.coalesce("status", F.lit("unmatched")).alias("status"))


@query("select c_custkey, case when c_custkey % 2 = 0 then 32.5 when c_custkey % 3 = 0 then 33.0 when c_custkey % 5 = 0 then 31.5 end as latitude, case when c_custkey % 2 = 0 then 'reference' when c_custkey % 3 = 0 then 'manual' when c_custkey % 5 = 0 then 'portal' end as coordinate_source, case when c_custkey % 2 = 0 or c_custkey % 3 = 0 or c_custkey % 5 = 0 then 'complete' else 'missing' end as coordinate_status from customer".replace("32.5", "cast(32.5 as double)").replace("33.0", "cast(33.0 as double)").replace("31.5", "cast(31.5 as double)"))
def coordinate_priority(spark, sf_dir):
    k = F.col("c_custkey")
    texts = lambda lat, when, bad: scalars.valid_pair(F.when(when, lat), F.when(bad, "999").otherwise("130.5"))
    pairs = [("reference", texts("32.5", k % 2 == 0, F.lit(False))), ("manual", texts("33.0", k % 3 == 0, F.lit(False))), ("portal", texts("31.5", k % 5 == 0, F.lit(False))), ("out_of_range", texts("33.5", k > 0, F.lit(True)))]
    return t(spark, sf_dir, "customer").select("c_custkey", *linkage.choose_coordinates(pairs)).select("c_custkey", F.col("latitude").cast("double").alias("latitude"), "coordinate_source", "coordinate_status")


@query("select a.c_custkey as key, 'left_only' as side from customer a left join (select distinct o_custkey from orders) o on o.o_custkey = a.c_custkey where o.o_custkey is null union all select o.o_custkey, 'right_only' from (select distinct o_custkey from orders) o left join customer c on c.c_custkey = o.o_custkey where c.c_custkey is null")
def set_reconcile(spark, sf_dir):
    return quality.set_difference(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), "key")


@query("select 'order_customer' as rule, 'error' as severity, count(*) as n_checked, count(*) filter (where c_custkey is null) as n_violations, min(case when c_custkey is null then cast(o_custkey as varchar) end) as example from orders left join (select c_custkey from customer where c_custkey % 7 <> 0) on c_custkey = o_custkey where o_custkey is not null")
def fk_check(spark, sf_dir):
    return quality.foreign_key(t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer").where("c_custkey % 7 <> 0"), "o_custkey", "c_custkey", "order_customer")


_CHANGED = "select o_orderkey, case when o_orderkey % 13 = 0 then 'X' else o_orderstatus end as status, case when o_orderkey % 17 = 0 then null else o_orderpriority end as priority from orders where o_orderkey % 19 <> 0"


@query(f"with a as (select o_orderkey, o_orderstatus as status, o_orderpriority as priority from orders), b as ({_CHANGED}) select o_orderkey, 'status' as \"column\", a.status as \"left\", b.status as \"right\" from a full outer join b using (o_orderkey) where a.status is distinct from b.status union all select o_orderkey, 'priority', a.priority, b.priority from a full outer join b using (o_orderkey) where a.priority is distinct from b.priority")
def cell_compare(spark, sf_dir):
    a = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    k = F.col("o_orderkey")
    b = a.where(k % 19 != 0).select("o_orderkey", F.when(k % 13 == 0, "X").otherwise(F.col("status")).alias("status"), F.when(k % 17 != 0, F.col("priority")).alias("priority"))
    return quality.cell_differences(a, b, ["o_orderkey"], ["status", "priority"])


def _rule_sql(name: str, cond: str) -> str:
    return f"select '{name}' as rule, 'error' as severity, count(*) as n_checked, count(*) filter (where {cond}) as n_violations, min(case when {cond} then cast(o_orderkey as varchar) end) as example from orders"


@query(" union all ".join([_rule_sql("positive_price", "o_totalprice <= 1000"), _rule_sql("known_status", "o_orderstatus not in ('O', 'F')"), _rule_sql("date_range", "o_orderdate >= timestamp '2001-01-01'"), "select 'unique_orders', 'error', count(*), count(*) filter (where n > 1), min(case when n > 1 then cast(o_orderkey as varchar) end) from (select o_orderkey, count(*) as n from orders group by 1)", "select 'min_rows', 'error', count(*), case when count(*) < 100 then 1 else 0 end, cast(count(*) as varchar) from orders"]))
def dq_report(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    rules = {"positive_price": F.col("o_totalprice") <= 1000, "known_status": ~F.col("o_orderstatus").isin("O", "F"), "date_range": F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")}
    return quality.check_rows(o, rules, "o_orderkey").unionByName(quality.unique(o, ["o_orderkey"], "unique_orders")).unionByName(quality.least(o, "min_rows", F.count("*"), 100))


@query("with " + _STATES + """, a as (select user_id, day, state from s where day between date '2024-01-01' and date '2024-01-04'), b as (select user_id, day, case when user_id % 10 = 0 and day = date '2024-01-02' then 'X' else state end as state from a),
u as (select distinct user_id from a), d as (select unnest(['2024-01-01', '2024-01-02', '2024-01-03', '2024-01-04']) as day)
select u.user_id, d.day, a.state as before, b.state as after from u cross join d left join a on a.user_id = u.user_id and cast(a.day as varchar) = d.day left join b on b.user_id = u.user_id and cast(b.day as varchar) = d.day where a.state is distinct from b.state""")
def unpivot_immutability(spark, sf_dir):
    dates = DATES[:4]
    s = states(spark, sf_dir).withColumn("day", F.date_format("day", "yyyy-MM-dd")).where(F.col("day").isin(dates))
    new = s.withColumn("state", F.when((F.col("user_id") % 10 == 0) & (F.col("day") == dates[1]), "X").otherwise(F.col("state")))
    wide = lambda x: timeseries.pivot_dates(x, ["user_id"], "day", F.col("state"), dates)
    return timeseries.changed_cells(wide(s), wide(new), ["user_id"], dates)


@query("with k as (select unnest(['article', 'License', 'the ']) as keyword) select page_id, keyword, cast((length(html) - length(replace(html, keyword, ''))) / length(keyword) as bigint) as n from pages, k where contains(html, keyword)")
def keyword_counts(spark, sf_dir):
    return profiling.page_keywords(t(spark, sf_dir, "pages"), "page_id", "html", ["article", "License", "the "], contexts=1).select("page_id", "keyword", "n")


@query("select page_id, substr(html, greatest(p - 20, 1), p + 40 - greatest(p - 20, 1)) as context from (select page_id, html, strpos(html, '<h1>') as p from pages) where p > 0")
def kwic_context(spark, sf_dir):
    hits = text.keyword_contexts(F.col("html"), "<h1>", 20, 40, 1)
    return t(spark, sf_dir, "pages").select("page_id", F.get(hits, 0).alias("context")).where("context is not null")


@query("""with a as (select page_id, regexp_extract(url, '^(https?://[^/]+)', 1) as origin, unnest(regexp_extract_all(html, '<a href="([^"]+)">[^<]*</a>', 1)) as raw, unnest(regexp_extract_all(html, '<a href="[^"]+">([^<]*)</a>', 1)) as label from pages),
u as (select page_id, origin || raw as url, 5 + case when raw like '%a' then 100 end + case when contains(label, 'the') or contains(origin || raw, 'the') then 20 else 0 end as score from a)
select page_id, url, max(score) as score from u where score is not null group by all""")
def link_discovery_rank(spark, sf_dir):
    out = profiling.rank_links(t(spark, sf_dir, "pages"), "page_id", "html", "url", "a", {"the": 20}, text_score=0)
    return out.where("score >= 100").select("page_id", "url", "score")


@query("select '$.k' as path, count(*) as n, count(distinct json_extract_string(props, '$.k')) as n_values from events where json_extract(props, '$.k') is not null")
def json_profile(spark, sf_dir):
    nodes = profiling.json_nodes(t(spark, sf_dir, "events"), "props")
    return nodes.where("type not in ('object', 'array') and path = '$.k'").groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))


@query("select array_to_string(list_sort(json_keys(props)), ',') as shape, count(*) as n from events group by 1 order by n desc, shape limit 30")
def json_shapes(spark, sf_dir):
    return profiling.object_shapes(t(spark, sf_dir, "events"), "props")


@query("with d as (select distinct user_id, cast(ts as date) as day from events), g as (select user_id, day, day - cast(row_number() over (partition by user_id order by day) as int) as island from d) select user_id, min(day) as first_day, max(day) as last_day, count(*) as days from g group by user_id, island")
def open_streaks(spark, sf_dir):
    return picks.open_streaks(t(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day")), ["user_id"], "day")


@query("select string_agg(distinct event_type, ' | ' order by event_type) as joined, user_id, cast(min(ts) as date) as first_day, cast(max(ts) as date) as last_day, count(distinct event_type) as n_types, count(*) filter (where event_type = 'error') as n_errors from events group by user_id")
def conditional_counts(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("user_id").agg(text.unique_join(F.array_sort(F.collect_set("event_type"))).alias("joined"), F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day"), F.count_distinct("event_type").alias("n_types"), F.count_if(F.col("event_type") == "error").alias("n_errors"))


@query("select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as varchar) as brand from customer union all select p_partkey, p_name, null, p_brand from part")
def column_union(spark, sf_dir):
    from snapweave.sources.tables import concat_columns

    return concat_columns([t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))])


@query()
def fuzzy_link(spark, sf_dir):
    """Odd parts to even parts of one brand by block-matching similarity of name and type."""
    p = t(spark, sf_dir, "part")
    s = p.where("p_partkey % 2 = 1").select("p_partkey", "p_brand", F.lower("p_name").alias("s_name"), F.lower("p_type").alias("s_addr"))
    m = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("m_id"), "p_brand", F.lower("p_name").alias("m_name"), F.lower("p_type").alias("m_addr"))
    return linkage.fuzzy_tier(linkage.name_pairs(s, m, "p_partkey", "m_id", ["p_brand"]), "p_partkey", "m_id", linkage.REFERENCE_FUZZY)


def _parts(spark, sf_dir, odd: bool):
    """Parts as facilities: brand and container size stand for the municipality, some fields blank, some unknown."""
    p = t(spark, sf_dir, "part").where(f"p_partkey % 2 = {int(odd)}")
    k = F.col("p_partkey")
    town = F.concat("p_brand", F.lit("市"))
    town = F.when(k % 17 == 0, "").when(k % 19 == 0, "elsewhere市").otherwise(town) if odd else town
    address = F.when(k % 7 == 0, "").otherwise(F.concat(F.concat("p_brand", F.lit("市")), "p_type"))
    name = F.when(k % 101 == 0, "").otherwise(F.concat_ws(" ", "p_name", F.when(k % 3 == 0, F.concat(F.lit("no "), (k % 50).cast("string"))))) if odd else F.concat_ws(" ", "p_name", F.when(k % 3 != 0, F.concat(F.lit("no "), (k % 50).cast("string"))))
    at = lambda c, low: (F.lit(low) + F.pmod(c, F.lit(997)) * 0.0004).cast("string")
    return p.select(k.alias("row_id"), town.alias("municipality"), name.alias("shelter_name"), address.alias("address"), F.when(k % 4 > 0, at(k, 32.0)).alias("latitude"), F.when(k % 4 > 0, at(k * 31, 130.0)).alias("longitude"))


def _decisions(df):
    return df.select("row_id", "status", "method", F.round("score", 9).alias("score"), F.array_join("matches", ",").alias("matches"), F.array_join("candidates", ",").alias("candidates"))


@query()
def reference_match(spark, sf_dir):
    """Odd parts to even ones through the cascade of the reference master."""
    master = _parts(spark, sf_dir, False).select(F.col("row_id").alias("common_id"), "shelter_name", "address")
    return _decisions(linkage.match_reference(_parts(spark, sf_dir, True), master))


@query()
def capacity_match(spark, sf_dir):
    """Odd parts to even ones through the cascade of the capacity master, with places."""
    m = _parts(spark, sf_dir, False)
    master = m.select(F.col("row_id").cast("string").alias("portal_shelter_id"), "municipality", "shelter_name", "address", F.col("latitude").alias("portal_latitude"), F.col("longitude").alias("portal_longitude"))
    source = _parts(spark, sf_dir, True).withColumn("portal_shelter_id", F.when(F.col("row_id") % 23 == 0, (F.col("row_id") + 1).cast("string")))
    return _decisions(linkage.match_capacity(source, master))


@query()
def manual_match(spark, sf_dir):
    """Odd parts to even ones by ids and identity."""
    m = _parts(spark, sf_dir, False)
    manual = m.select(F.concat(F.when(F.col("row_id") % 3 == 0, "web:").otherwise(""), F.col("row_id").cast("string")).alias("shelter_id"), "municipality", "shelter_name", "address")
    near = (F.col("row_id") + 1).cast("string")
    source = _parts(spark, sf_dir, True).withColumns({"shelter_id": F.when(F.col("row_id") % 5 == 0, near), "web_shelter_id": F.when(F.col("row_id") % 5 == 1, near).when(F.col("row_id") % 5 == 2, F.concat(F.lit("web:"), near))})
    return _decisions(linkage.match_manual(source, manual))


@query()
def municipal_match(spark, sf_dir):
    """Odd parts to even ones through the cascade of municipal records, by one container kind at a time."""
    m = _parts(spark, sf_dir, False)
    shelters = m.select(F.concat(F.when(F.col("row_id") % 3 == 0, "web:").otherwise("s"), F.col("row_id").cast("string")).alias("shelter_id"), "municipality", "shelter_name", "address", (F.col("row_id") % 4 == 0).alias("is_open"), F.when(F.col("row_id") % 6 == 0, "1,200").otherwise("0").alias("capacity"))
    aliases = _parts(spark, sf_dir, True).where("row_id % 47 = 0").select("municipality", F.col("shelter_name").alias("source_shelter_name"), F.col("address").alias("source_address"), F.concat(F.lit("s"), (F.col("row_id") + 1).cast("string")).alias("shelter_id"), F.col("row_id").alias("_ord"))
    return _decisions(linkage.match_municipal(_parts(spark, sf_dir, True), shelters, aliases))


@query()
def name_variants_link(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    key = text.name_variants(text.name_key_municipal(F.col("p_name")))
    a = p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("left_key"), "p_brand", F.explode(key).alias("variant"))
    b = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("right_key"), "p_brand", F.explode(key).alias("variant"))
    return a.join(b, ["p_brand", "variant"]).select("left_key", "right_key").distinct()


@query()
def nfkc_normalize(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_text(F.col("text")), 256).alias("normalized_sha256"), F.length(text.clean_text(F.col("text"))).alias("n_chars"))


@query()
def html_table_dimensions(spark, sf_dir):
    return profiling.table_dimensions(html_tables(t(spark, sf_dir, "pages"), "page_id", "html"), ["page_id", "table_idx"])
