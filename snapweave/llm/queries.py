"""The query of each operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapweave.llm import bpe, decontaminate, html_text, near_duplicates, passages, pii, quality, sharding, token_files, warc
from snapweave.llm.shared import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact phrases, and proximity matches in the last two columns."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.join(table(spark, sf_dir, "documents"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.archive(table(spark, sf_dir, "pages"), path)
    return warc.page_rows(spark, path)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), digests=True)


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), token_files.token_folder(spark)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_decontamination, op3_ngram_jaccard_join, op4_repeated_passages, op5_warc, op6_html_extraction, op7_bpe, op8_hilbert_sharding, op9_quality_rules, op10_token_files)}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": rf"""with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
q as (select distinct item, n, array_to_string(w[i : i + n - 1], ' ') as win from (select item, w, least(10, len(w)) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
x as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as win from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from q))),
h as (select doc_id, i, x.n, item from x join q on x.win = q.win and x.n = q.n),
c as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from h) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from h) group by 1),
v as (select row_number() over () as v, item, n, cast(ceil(0.8 * n) as int) as need, string_split(win, ' ') as w from q where n >= 3),
k as (select v, n, need, item, unnest(w) as word, unnest(range(n)) as k from v),
o as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p from d),
f as (select word, count(*) as c from o group by 1),
r as (select k.*, row_number() over (partition by v order by coalesce(c, 0), k) as rarest from k left join f on f.word = k.word),
y as (select distinct v, need, item, doc_id, p - k + unnest(range(-3, 4)) as place from r join o on o.word = r.word where rarest <= n - need + 1),
z as (select y.v, y.need, y.item, y.doc_id, place from y join k on k.v = y.v join o on o.doc_id = y.doc_id and o.word = k.word and o.p between place + k - 3 and place + k + 3 group by all having count(distinct k) >= y.need),
m as (select doc_id, count(*) as n_near_items, string_agg(item, ',' order by item) as near_items from (select distinct doc_id, item from z) group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near_items, 0) as n_near_items, coalesce(near_items, '') as near_items from d left join c on c.doc_id = d.doc_id left join t on t.doc_id = d.doc_id left join m on m.doc_id = d.doc_id""",
    "op3_ngram_jaccard_join": rf"""with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 75 * (nx.n + ny.n - c)),
u as (select x as a, y as b from e union all select y, x from e),
r as (select doc_id as id, doc_id as root from d union select u.b, r.root from r join u on u.a = r.id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.root) as component_id from d left join n on n.doc_id = d.doc_id join r on r.id = d.doc_id group by all""",
    "op5_warc": """with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as x from pages), f as (select *, min(page_id) over (partition by h) as first_id from p)
select page_id, strlen(h) as payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(x, 1 + 10 * (i // 8), 10) as bigint) >> cast(35 - 5 * (i % 8) as bigint)) & 31 as int) + 1, 1)), '') as payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type, case when page_id <> first_id then first_id end as refers_to from f""",
}
