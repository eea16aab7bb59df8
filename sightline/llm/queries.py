"""The queries of problems 3 to 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.columns import cve_id, lower_trimmed
from sightline.llm.cooccur import cooccurrence
from sightline.llm.encode import TOKENIZER, encoded, sizes
from sightline.llm.foldhash import collapsed, copies
from sightline.llm.mixing import mixed, rates, report
from sightline.llm.subjects import composition, subject_areas
from sightline.llm.survivor import Field, says_something, survivors
from sightline.oracle_canonical import observed
from sightline.session import settled


def _tags() -> F.Column:
    return F.filter(F.transform("context.tags", lower_trimmed), lambda x: x.isNotNull())


def p3_found(spark: SparkSession, d: str, min_share: str = "0.004", min_lift: str = "3") -> DataFrame:
    """tag_a, tag_b: pairs of tags that occur together often, and much more often than chance."""
    found = cooccurrence(spark.read.parquet(f"{d}/indicator_records.parquet"), _tags(), min_share, min_lift)
    return found.select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"))


def p3_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of tags that occurs together, with its counts; no limits."""
    found = cooccurrence(spark.read.parquet(f"{d}/indicator_records.parquet"), _tags())
    return found.select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"), "n_ab", "n_a", "n_b", "n_baskets", F.round("lift", 6).alias("lift"))


def _cves(spark: SparkSession, d: str, at: str = "observed_at", **how: bool) -> DataFrame:
    rows = spark.read.parquet(f"{d}/cve_records.parquet").select(cve_id(F.col("cve.cve_id")).alias("cve_key"), "record_id", F.col(at).alias("at"), "cve.summary", "cve.cvss_score", "cve.epss_score", "cve.known_exploited")
    score = lambda c, top: F.coalesce(F.col(c).between(0, top), F.lit(False))
    fields = [
        Field("summary", F.col("summary"), says_something(F.col("summary"))),
        Field("cvss", F.col("cvss_score"), score("cvss_score", 10)),
        Field("epss", F.col("epss_score"), score("epss_score", 1)),
        Field("exploited", F.col("known_exploited").cast("int"), F.coalesce(F.col("known_exploited"), F.lit(False))),
    ]
    return survivors(rows, "cve_key", "at", "record_id", fields, **how)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The record that has the best summary and scores of each CVE with two records or more; -1 where none has."""
    found = _cves(spark, d, values=False).where("n_rows >= 2")
    return found.select("cve_key", *[F.coalesce(f"{f}_record_id", F.lit(-1)).cast("long").alias(f"{f}_record_id") for f in ("summary", "cvss", "epss")], F.col("exploited_record_id").isNotNull().cast("int").alias("known_exploited"))


def _survivors(found: DataFrame) -> DataFrame:
    return found.select("cve_key", "n_rows", "summary", F.col("cvss").alias("cvss_score"), F.col("epss").alias("epss_score"), F.coalesce(F.col("exploited") == 1, F.lit(False)).alias("known_exploited"))


def p4_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each CVE, built from its best values."""
    return _survivors(_cves(spark, d))


def p4_current(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each CVE by the times at which the sources say that they changed it (cve.modified_at), which
    many rows lack: what they say is placed by the order in which values follow each other elsewhere."""
    return _survivors(_cves(spark, d, "cve.modified_at", weigh=True))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """record_id_a, record_id_b: the first record of each observable, with each of its other ones."""
    rows = spark.read.parquet(f"{d}/indicator_records.parquet")
    found = copies(rows, "record_id", F.col("indicator.type"), F.col("indicator.raw_value"))
    return found.select(F.col("keep_id").alias("record_id_a"), F.col("record_id").alias("record_id_b"))


def p5_observables(spark: SparkSession, d: str) -> DataFrame:
    """Each observable once: the first record that has it, how that record writes it, and the number of its records."""
    rows = spark.read.parquet(f"{d}/indicator_records.parquet").select("record_id", "indicator.type", "indicator.raw_value")
    return collapsed(rows, "record_id", F.col("type"), F.col("raw_value"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def p6_ids(spark: SparkSession, d: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, ids: the token ids of each document; none ([]) of empty and null texts."""
    return encoded(_documents(spark, d), "doc_id", "text", tokenizer)


def _mix_plan(spark: SparkSession, d: str, tokenizer: str) -> tuple[DataFrame, DataFrame, list]:
    docs, targets = _documents(spark, d), spark.read.parquet(f"{d}/mix_targets.parquet")
    sized = settled(sizes(docs, "doc_id", "text", tokenizer, keep=("source",)).withColumnRenamed("doc_id", "id"))
    return sized, targets, rates(sized, targets)


def p7_mix(spark: SparkSession, d: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """The mixed corpus: whole documents, each as often as it is used, in an order by hash."""
    _, _, plan = _mix_plan(spark, d, tokenizer)
    return mixed(_documents(spark, d).select("doc_id", "source", "lang", "text"), "doc_id", "source", plan)


def p7_shares(spark: SparkSession, d: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Of each target source, the share of all tokens that it was to have and has, and how its documents are used."""
    sized, targets, plan = _mix_plan(spark, d, tokenizer)
    return report(sized, targets, plan)


def _areas(spark: SparkSession, d: str) -> DataFrame:
    areas, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("subject_areas", "subject_labels"))
    return subject_areas(_documents(spark, d), "doc_id", "text", areas, labels)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, subject: each subject that a document treats in a substantial part."""
    return _areas(spark, d).select("doc_id", "subject")


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by subject: documents that treat it, their words, divided by each document's shares, and the terms that
    the subject is found by."""
    return composition(_areas(spark, d), spark.read.parquet(f"{d}/subject_areas.parquet"))


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_pairs, p4_found, p4_survivors, p4_current, p5_found, p5_observables, p6_ids, p7_mix, p7_shares, p8_found, p8_composition)}


TAGS = """
    with r as (select row_number() over () as i, list_distinct(list_filter(list_transform(context.tags, lambda x: lower(regexp_replace(regexp_replace(x, '^\\s+', ''), '\\s+$', ''))), lambda x: x <> '')) as t from indicator_records),
         b as (select * from r where len(t) > 0),
         x as (select i, unnest(t) as tag from b),
         n as (select tag, count(*) as n from x group by 1),
         p as (select a.tag as tag_a, c.tag as tag_b, count(*) as n_ab from x a join x c on a.i = c.i and a.tag < c.tag group by 1, 2),
         f as (select tag_a, tag_b, n_ab, na.n as n_a, nb.n as n_b, (select count(*) from b) as n_baskets from p join n na on na.tag = tag_a join n nb on nb.tag = tag_b)
"""
CVES = """
    with k as (select regexp_extract(upper(trim(cve.cve_id, chr(9) || chr(10) || chr(13) || ' ')), '^CVE-([0-9]{4})-([0-9]{4,})$', ['y', 'n']) as m, record_id, observed_at, cve.* from cve_records),
         r as (select 'CVE-' || m.y || '-' || lpad(ltrim(m.n, '0'), greatest(4, length(ltrim(m.n, '0')))::int, '0') as cve_key, *,
                      coalesce(lower(trim(summary)), '') not in ('', '-', 'n/a', 'null', '(none)', 'tbd', 'to be determined', 'awaiting analysis', 'no description available.', 'description pending', '** reserved **') as s_ok,
                      coalesce(cvss_score between 0 and 10, false) as c_ok, coalesce(epss_score between 0 and 1, false) as e_ok from k where m.y <> '')
"""


CURRENT = CVES + """,
         x as (select cve_key as k, record_id as id, epoch_us(modified_at) as t, 0 as f, summary as s from r where s_ok union all select cve_key, record_id, epoch_us(modified_at), 1, cvss_score::varchar from r where c_ok
               union all select cve_key, record_id, epoch_us(modified_at), 2, epss_score::varchar from r where e_ok union all select cve_key, record_id, epoch_us(modified_at), 3, '1' from r where known_exploited),
         d as (select k, f, s, lag(s) over (partition by k, f order by t, id) as p from x where t is not null),
         n as (select f, least(p, s) as a, greatest(p, s) as b, sum(case when p < s then 1 else -1 end) as net from d where p <> s group by 1, 2, 3),
         o as (select f, case when net > 0 then a else b end as a, case when net > 0 then b else a end as b from n where net <> 0),
         l as (select k, f, arg_max(id, (t, -id)) as id, arg_max(s, (t, -id)) as s from x where t is not null group by 1, 2),
         u as (select k, f, s, min(id) as id from x where t is null group by 1, 2, 3),
         c as (select k, f, s, min((late, id)) as r from (select *, 1 as late from u union all select k, f, s, id, 0 from l semi join u using (k, f)) group by 1, 2, 3),
         q as (select distinct c.k, c.f, c.s, 1 as passed from c join o on o.f = c.f and o.a = c.s join c as e on e.k = c.k and e.f = c.f and e.s = o.b),
         w as (select k, f, arg_min(r[2], (coalesce(passed, 0), r[1], r[2])) as id from c left join q using (k, f, s) group by 1, 2),
         b as (select k, f, coalesce(w.id, l.id) as id from w full join l using (k, f)),
         v as (select b.k, b.f, r.* from b join r on r.record_id = b.id)
    select cve_key, count(*) as n_rows, (select any_value(summary) from v where v.k = r.cve_key and f = 0) as summary, (select any_value(cvss_score) from v where v.k = r.cve_key and f = 1) as cvss_score,
           (select any_value(epss_score) from v where v.k = r.cve_key and f = 2) as epss_score, exists (select 1 from v where v.k = r.cve_key and f = 3) as known_exploited from r group by 1
"""


OBSERVED = "with " + observed("o", "indicator_records", "record_id, indicator", "indicator.type", "indicator.raw_value")


def oracle_sql() -> dict[str, str]:
    latest = lambda ok, what: f"arg_max({what}, (epoch_us(observed_at), -record_id)) filter ({ok})"
    return {
        "p3_found": TAGS + "select tag_a, tag_b from f where n_ab * 1000 >= 4 * n_baskets and n_ab * n_baskets >= 3 * n_a * n_b",
        "p3_pairs": TAGS + "select *, round(n_ab * n_baskets::double / (n_a::double * n_b), 6) as lift from f",
        "p4_found": CVES + f"select cve_key, coalesce({latest('s_ok', 'record_id')}, -1) as summary_record_id, coalesce({latest('c_ok', 'record_id')}, -1) as cvss_record_id, coalesce({latest('e_ok', 'record_id')}, -1) as epss_record_id, coalesce(bool_or(known_exploited), false)::int as known_exploited from r group by 1 having count(*) >= 2",
        "p4_current": CURRENT,
        "p5_found": OBSERVED + ", g as (select type, value, min(record_id) as record_id_a from o where value is not null group by 1, 2) select record_id_a, record_id as record_id_b from o join g using (type, value) where record_id <> record_id_a",
        "p5_observables": OBSERVED + ", g as (select min(record_id) as record_id, count(*) as n_copies from o where value is not null group by type, value) select record_id, indicator.type as type, indicator.raw_value as raw_value, n_copies from g join o using (record_id)",
        "p4_survivors": CVES + f"select cve_key, count(*) as n_rows, {latest('s_ok', 'summary')} as summary, {latest('c_ok', 'cvss_score')} as cvss_score, {latest('e_ok', 'epss_score')} as epss_score, coalesce(bool_or(known_exploited), false) as known_exploited from r group by 1",
    }
