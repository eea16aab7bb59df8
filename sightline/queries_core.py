"""The queries of problems 1 and 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.columns import lower_trimmed, rfc3339_micros
from sightline.operators.intervals import periods_and_gaps
from sightline.operators.ranges import profile, ranks
from sightline.session import settled


def _by_slug(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/indicator_records.parquet").select(lower_trimmed(F.col("source_slug")).alias("slug"), "observed_at", "record_id")


def p1_found(spark: SparkSession, d: str, share: float = 1 / 20) -> DataFrame:
    """slug: each that holds more than `share` of all rows."""
    found = settled(profile(_by_slug(spark, d), "slug", "observed_at", "record_id"))
    total = found.agg(F.sum("n_rows")).first()[0] or 0
    return found.where(F.col("slug").isNotNull() & (F.col("n_rows") > share * total)).select("slug")


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, first and last observation and the longest gap between observations, of each source."""
    return profile(_by_slug(spark, d), "slug", "observed_at", "record_id")


def p1_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The place of each record among those of its source, by observed_at and record_id."""
    return ranks(_by_slug(spark, d), "slug", "observed_at", "record_id").select("record_id", "slug", "rank_in_key")


def _windows(spark: SparkSession, d: str) -> DataFrame:
    seen = F.from_json("context", "first_seen string, last_seen string")
    rows = spark.read.parquet(f"{d}/sighting.parquet").select("entity_id", seen.alias("c"))
    return rows.select("entity_id", rfc3339_micros(F.col("c.first_seen")).alias("start_us"), rfc3339_micros(F.col("c.last_seen")).alias("end_us"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """entity_id, what, start_us, end_us: the continuous periods of each entity, and the gaps between them."""
    return periods_and_gaps(_windows(spark, d), "entity_id", "start_us", "end_us")


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_profile, p1_ranks, p2_found)}


SLUG = "nullif(lower(regexp_replace(regexp_replace(source_slug, '^\\s+', ''), '\\s+$', '')), '')"
TIME = "case when regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\\.[0-9]+)?(Z|[+-][0-9]{{2}}:[0-9]{{2}})') then epoch_us(try_cast({0} as timestamptz)) end"


def oracle_sql() -> dict[str, str]:
    first, last = (TIME.format(f"json_extract_string(context, '$.{x}_seen')") for x in ("first", "last"))
    return {
        "p1_found": f"select {SLUG} as slug from indicator_records where {SLUG} is not null group by 1 having count(*) > (select count(*) from indicator_records) / 20.0",
        "p1_profile": f"""
            with r as (select {SLUG} as slug, epoch_us(observed_at) as us from indicator_records),
                 g as (select slug, us, us - lag(us) over (partition by slug order by us nulls first) as gap from r)
            select slug, count(*) as n_rows, count(us) as n_timed, min(us) as first_us, max(us) as last_us, max(gap) as max_gap_us from g group by slug""",
        "p1_ranks": f"select record_id, {SLUG} as slug, row_number() over (partition by {SLUG} order by observed_at nulls first, record_id) as rank_in_key from indicator_records",
        "p2_found": f"""
            with w as (select entity_id, {first} as s, {last} as e from sighting where entity_id is not null),
                 v as (select * from w where s <= e),
                 m as (select *, max(e) over (partition by entity_id order by s, e rows between unbounded preceding and 1 preceding) as reach from v),
                 i as (select *, sum(case when reach is null or s > reach then 1 else 0 end) over (partition by entity_id order by s, e rows unbounded preceding) as n from m),
                 p as (select entity_id, n, min(s) as s, max(e) as e from i group by 1, 2),
                 g as (select entity_id, e as s, lead(s) over (partition by entity_id order by s) as e from p)
            select entity_id, 'period' as what, s as start_us, e as end_us from p
            union all select entity_id, 'gap', s, e from g where e is not null""",
    }
