"""Records and edges of envelopes as rows of the tables, and what is dropped on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions import columns as C
from sightline.operators import context as X
from sightline.plans.schemas import MAX_DROP_RATIO


def entity_id(kind: Column, key: Column) -> Column:
    """The id of an entity, made from what it is: the same on every run, so nothing has to be looked up."""
    h = F.sha2(F.concat(kind, F.lit("\0"), key), 256)
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))


def timestamp(c: Column) -> Column:
    return F.timestamp_micros(C.rfc3339_micros(c))


def year_of(c: Column) -> Column:
    """The year that a time is written with, in its own offset."""
    return F.nullif(c, F.lit("")).substr(1, 4).try_cast("int")


def lower_or_null(c: Column) -> Column:
    return F.nullif(C.ascii_lower(c), F.lit(""))


def built(records: DataFrame) -> DataFrame:
    """records (`sources.envelopes.records`) with observed, ctx, tags, confidence, first_seen, last_seen, key, type and reason.

    key is null and reason set for a record that is dropped: its value has no canonical form ('canonicalise'),
    its kind's payload isn't there ('missing_payload'), or its kind is none ('unknown_kind').
    """
    found = X.fields(F.col("default_context"), F.col("context"))
    rows = records.withColumns({"observed": timestamp(F.coalesce(X.set_(F.col("observed_at")), F.col("collected_at"))), "ctx": X.effective(F.col("default_context"), F.col("context")), "tags": found["tags"], "confidence": found["confidence"]})
    first, last = X.seen_window(found, F.col("observed"))
    slug = C.breach_slug(F.col("breach.slug"), F.col("breach.name"), year_of(F.col("breach.breach_date")), year_of(F.col("breach.disclosed_at")))
    rows = rows.withColumn("first_seen", first).withColumn("last_seen", last)
    rows = C.with_observable(rows, "seen", F.col("indicator.type"), F.when(F.col("kind") == "indicator", F.col("indicator.raw_value")))
    key = F.when(F.col("kind") == "indicator", F.col("seen.value")).when(F.col("kind") == "cve", C.cve_id(F.col("cve.cve_id"))).when(F.col("kind") == "breach", slug)
    known = F.coalesce(F.col("kind").isin("indicator", "cve", "breach"), F.lit(False))
    absent = F.when(F.col("kind") == "indicator", F.col("indicator").isNull()).when(F.col("kind") == "cve", F.col("cve").isNull()).otherwise(F.col("breach").isNull())
    reason = F.when(~known, "unknown_kind").when(absent, "missing_payload").when(F.col("key").isNull(), "canonicalise")
    return rows.withColumn("key", key).withColumn("type", F.col("seen.type")).withColumn("reason", reason).drop("seen")


def built_edges(edges: DataFrame) -> DataFrame:
    """edges (`sources.envelopes.relationships`) with source_key, source_type, target_key, target_type, their window
    as timestamps, and reason; an end without a canonical form drops the edge."""
    collected = timestamp(F.col("collected_at"))
    first, last = X.edge_window(timestamp(F.col("first_seen")), timestamp(F.col("last_seen")), collected)
    rows = edges.withColumns({"first_": first, "last_": last})
    for x in ("source", "target"):
        rows = C.with_endpoint_key(rows, x, x)
    reason = F.when(F.col("source_key").isNull() | F.col("target_key").isNull(), "canonicalise")
    metadata = F.when(F.size(X.members(F.col("metadata"))) > 0, F.col("metadata"))
    return rows.withColumn("reason", reason).withColumn("metadata", metadata).drop("first_seen", "last_seen").withColumnsRenamed({"first_": "first_seen", "last_": "last_seen"})


def drop_report(rows: DataFrame, group: list[str], limit: float = MAX_DROP_RATIO, edges: DataFrame | None = None) -> DataFrame:
    """Per group of records (an envelope): n_records, n_dropped, ratio, and whether it is rejected: more than `limit`
    dropped, or nothing left, neither a record nor one of `edges` (columns of `group`) that could be built."""
    seen = rows.groupBy(*group).agg(F.count("*").alias("n_records"), F.count("reason").alias("n_dropped"))
    left = F.lit(False)
    if edges is not None:
        seen = seen.join(edges.select(*group).distinct().withColumn("left_", F.lit(True)), group, "left")
        left = F.coalesce("left_", F.lit(False))
    ratio = F.col("n_dropped") / F.col("n_records")
    return seen.withColumn("ratio", ratio).withColumn("rejected", (ratio > limit) | ((F.col("n_dropped") == F.col("n_records")) & ~left)).drop("left_")


def drop_examples(rows: DataFrame, group: list[str], order: list[str], most: int = 3) -> DataFrame:
    """The first few dropped rows of each group: enough to see what is wrong, however many there are."""
    first = Window.partitionBy(*group).orderBy(*order)
    return rows.where(F.col("reason").isNotNull()).withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)


def ends(edges: DataFrame) -> DataFrame:
    """Both ends of each edge as rows, the source before the target: seq, place, kind, key, type, first_seen, last_seen."""
    sides = F.array(*[F.struct((F.col("idx") * 2 + i).alias("place"), F.col(f"{x}_kind").alias("kind"), F.col(f"{x}_key").alias("key"), F.col(f"{x}_type").alias("type")) for i, x in enumerate(("source", "target"))])
    return edges.select("seq", F.explode(sides).alias("end"), "first_seen", "last_seen").select("seq", "end.*", "first_seen", "last_seen")


def stubs(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Ends of edges that no record of their envelope describes, each once (its first place): indicators and CVEs get a
    row of their own from this, breaches don't, as an edge doesn't name them."""
    found = ends(edges).where(F.col("kind").isin("indicator", "cve"))
    first = found.groupBy("seq", "kind", "key").agg(F.min(F.struct("place", "type", "first_seen", "last_seen")).alias("r")).select("seq", "kind", "key", "r.*")
    return first.join(rows.select("seq", "kind", "key").distinct(), ["seq", "kind", "key"], "left_anti")


def entities(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """kind, key, first_seen, last_seen of every record and every end of an edge, self-edges included; not yet folded."""
    return rows.select("kind", "key", "first_seen", "last_seen").unionByName(ends(edges).select("kind", "key", "first_seen", "last_seen"))


def written(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """seq, table, n: the rows that each envelope writes to each table, from its records and edges that were built."""
    described = rows.select("seq", "kind", "key")
    named = ends(edges).select("seq", "kind", "key")
    parts = {
        "entity": described.unionByName(named).distinct().select("seq"),
        "relationship": edge_rows(edges).select("seq", "source_id", "target_id", "type").distinct().select("seq"),
        "sighting": described.select("seq"),
    }
    out = [p.select("seq", F.lit(t).alias("table")) for t, p in parts.items()]
    modules = described.unionByName(named.where(F.col("kind").isin("indicator", "cve"))).distinct()  # stubs too
    out.append(modules.select("seq", F.col("kind").alias("table")))
    return reduce(DataFrame.unionByName, out).groupBy("seq", "table").agg(F.count("*").alias("n"))


def indicator_rows(rows: DataFrame) -> DataFrame:
    raw = F.nullif(F.nullif(F.col("indicator.raw_value"), F.lit("")), F.col("key"))
    return rows.where("kind = 'indicator'").select("seq", "idx", entity_id(F.col("kind"), F.col("key")).alias("entity_id"), "type", F.col("key").alias("value"), raw.alias("raw_value"))


def cve_rows(rows: DataFrame) -> DataFrame:
    c = F.col("cve")
    text = [X.set_(c[x]).alias(x) for x in ("summary", "cvss_vector")]
    return rows.where("kind = 'cve'").select(
        "seq", "idx", entity_id(F.col("kind"), F.col("key")).alias("entity_id"), F.col("key").alias("cve_id"), *text, lower_or_null(c["severity"]).alias("severity"),
        X.number(c["cvss_score"]).cast("float").alias("cvss_score"), X.number(c["epss_score"]).cast("float").alias("epss_score"), F.coalesce(c["known_exploited"], F.lit(False)).alias("known_exploited"),
        c["cwe"].alias("cwe"), timestamp(c["published_at"]).alias("published_at"), timestamp(c["modified_at"]).alias("modified_at"), c["refs"].alias("refs"),
    )


def with_domain(df: DataFrame, name: str, c: Column) -> DataFrame:
    """df with the canonical domain, so that it meets indicators; what has none is kept as it is; null if empty."""
    df = C.with_observable(df, "seen_", F.lit("domain"), X.set_(c))
    return df.withColumn(name, F.coalesce("seen_.value", X.set_(c))).drop("seen_")


def breach_rows(rows: DataFrame) -> DataFrame:
    c = F.col("breach")
    return with_domain(rows.where("kind = 'breach'"), "domain", c["domain"]).select(
        "seq", "idx", entity_id(F.col("kind"), F.col("key")).alias("entity_id"), F.col("key").alias("slug"), c["name"].alias("name"), "domain",
        X.set_(c["description"]).alias("description"), F.try_to_date(X.set_(c["breach_date"]), "yyyy-MM-dd").alias("breach_date"), timestamp(c["disclosed_at"]).alias("disclosed_at"),
        c["record_count"].alias("record_count"), c["data_classes"].alias("data_classes"), F.coalesce(c["verified"], F.lit(False)).alias("verified"),
    )


def sighting_rows(rows: DataFrame) -> DataFrame:
    return rows.select(entity_id(F.col("kind"), F.col("key")).alias("entity_id"), "source", F.col("observed").alias("observed_at"), X.set_(F.col("content_hash")).alias("content_hash"), X.set_(F.col("raw_ref")).alias("raw_ref"), X.encoded(F.col("ctx")).alias("context"), month(F.col("observed")).alias("month"))


def month(c: Column) -> Column:
    """The month of a time in UTC, whatever the session's time zone."""
    day = 86_400_000_000
    since = (F.unix_micros(c) - F.pmod(F.unix_micros(c), F.lit(day))) / day
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), since.cast("int")), "yyyy_MM")


def month_bounds(c: Column) -> tuple[Column, Column, Column]:
    """(name, first instant, first instant of the next) of the month, in UTC, that a time is in; instants in microseconds."""
    name = month(c)
    first = F.to_date(name, "yyyy_MM")
    instant = lambda day: F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000
    return name, instant(first), instant(F.add_months(first, 1))


def edge_rows(edges: DataFrame) -> DataFrame:
    """Edges between different entities, by the entities' ids."""
    ids = {x: entity_id(F.col(f"{x}_kind"), F.col(f"{x}_key")).alias(f"{x}_id") for x in ("source", "target")}
    rows = edges.select("seq", "idx", ids["source"], ids["target"], "type", X.number(F.col("confidence")).cast(T.FloatType()).alias("confidence"), "first_seen", "last_seen", "metadata")
    return rows.where("source_id <> target_id")


def verdict_rows(rows: DataFrame) -> DataFrame:
    """What the lookup table learns from indicator records."""
    return rows.where("kind = 'indicator'").select("seq", "idx", "type", F.col("key").alias("value"), "first_seen", "last_seen", "source", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), X.number(F.col("confidence")).alias("confidence"))
