"""Queries over the domain tables, one for each operator, and the same in SQL where SQL can say it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions import columns as C
from sightline.operators import build, context, folds, fuzzy, graph, lookup, metrics, validate
from sightline.operators.build import entity_id
from sightline.plans.schemas import BREACH, CONTEXT, CVE, INDICATOR, RECORD, RELATIONSHIP
from sightline.session import scratch_path, settled
from sightline.sources import archive, dead_letters, registry
from sightline.streaming.intake import windowed_counts

NOW = "2026-01-01T00:00:00Z"  # the clock of all queries
CUTOFF = "2025-06-10"
HASHES = ("md5", "sha1", "sha256", "sha512")
BOUNDS = [60.0, 300.0, 600.0, 1800.0, 3600.0, 21600.0, 86400.0, 604800.0]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text_time(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def us(c: Column | str, name: str) -> Column:
    return F.unix_micros(c).alias(name)


def envelopes_once(spark: SparkSession, d: str) -> DataFrame:
    """Each envelope once, as it was first received."""
    return folds.first_row(table(spark, d, "envelopes").select("envelope_id", "received_at", "collected_at", "default_context", "content_hash", "raw_ref"), ["envelope_id"], "received_at")


def records(spark: SparkSession, d: str, kinds: tuple[str, ...] = ("indicator", "cve", "breach")) -> DataFrame:
    """All records of some kinds in the form that envelopes give them in; tables of other kinds are not read."""
    base = ["envelope_id", F.col("record_index").alias("idx"), F.col("source_slug").alias("source"), "kind", text_time("observed_at").alias("observed_at")]
    c, b = F.col("cve"), F.col("breach")
    own = {
        "indicator": ["context", "indicator"],
        "cve": [c.withField("published_at", text_time("cve.published_at")).withField("modified_at", text_time("cve.modified_at")).alias("cve")],
        "breach": [b.withField("breach_date", F.col("breach.breach_date").cast("string")).withField("disclosed_at", text_time("breach.disclosed_at")).alias("breach")],
    }
    parts = [table(spark, d, f"{k}_records").select(*base, *own[k]) for k in kinds]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    absent = {"context": CONTEXT, "indicator": INDICATOR, "cve": CVE, "breach": BREACH}
    rows = rows.withColumns({k: (F.col(k) if k in rows.columns else F.lit(None)).cast(t) for k, t in absent.items() if k == "context" or k not in rows.columns})
    return rows.join(envelopes_once(spark, d), "envelope_id").withColumnRenamed("envelope_id", "seq").withColumn("collected_at", text_time("collected_at"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "relationship").select("envelope_id", "edge_id", "source", "target", "type", "confidence", "first_seen", "last_seen", "metadata")
    rows = own.join(envelopes_once(spark, d).select("envelope_id", "collected_at"), "envelope_id")
    return rows.withColumnsRenamed({"envelope_id": "seq", "edge_id": "idx"}).withColumns({x: text_time(x) for x in ("first_seen", "last_seen", "collected_at")})


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Edges by the entities at their ends, kind:key in canonical form; null where an end has none."""
    rows = table(spark, d, "relationship").select("source", "target")
    for x in ("source", "target"):
        rows = C.with_endpoint_key(rows, x, x)
    name = lambda x: F.concat(f"{x}_kind", F.lit(":"), f"{x}_key")
    return rows.select(name("source").alias("source"), name("target").alias("target"))


# Scalar rules


def defanged_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "indicator_records").select("record_id", C.defang(F.col("indicator.raw_value")).alias("value"))


def canonical_indicators(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("record_id", "indicator")
    return C.with_observable(rows, "seen", F.col("indicator.type"), F.col("indicator.raw_value")).select("record_id", "seen.type", "seen.value")


def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("indicator.raw_value")
    return C.with_observable(rows, "seen", F.lit("auto"), F.col("raw_value")).groupBy("seen.type").agg(F.count("*").alias("n"))


def hash_values(spark: SparkSession, d: str) -> DataFrame:
    """Values that are hashes, and those that are only declared to be, with nulls."""
    rows = table(spark, d, "indicator_records").select("record_id", "indicator")
    seen = C.with_observable(rows, "seen", F.col("indicator.type"), F.col("indicator.raw_value"))
    return seen.where(F.col("seen.type").isin(*HASHES) | F.col("indicator.type").isin(*HASHES)).select("record_id", "seen.type", "seen.value")


def ipv4_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("record_id", "indicator")
    seen = C.with_observable(rows, "seen", F.col("indicator.type"), F.col("indicator.raw_value"))
    return seen.where("seen.type = 'ipv4'").select("record_id", F.col("seen.value").alias("value"))


def cve_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cve_records").select("record_id", C.cve_id(F.col("cve.cve_id")).alias("cve_id"))


def breach_slugs(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("breach")
    return table(spark, d, "breach_records").select("record_id", C.breach_slug(b["slug"], b["name"], F.year(b["breach_date"]), F.year(b["disclosed_at"])).alias("slug"))


def endpoint_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = C.with_endpoint_key(table(spark, d, "relationship"), "source", "source")
    return C.with_endpoint_key(rows, "target", "target").select("edge_id", "source_kind", "source_key", "source_type", "target_kind", "target_key", "target_type")


# Context and windows


def effective_contexts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("record_id", "envelope_id", "context").join(envelopes_once(spark, d), "envelope_id")
    c = context.effective(F.col("default_context"), F.col("context"))
    rows = rows.select("record_id", c.alias("c"))
    names = F.array_join(F.sort_array(F.map_keys(F.from_json("c.attributes", "map<string,string>"))), ",")
    return rows.select("record_id", "c.first_seen", "c.last_seen", "c.confidence", F.array_join("c.tags", "|").alias("tags"), "c.tlp", names.alias("attribute_names"))


def seen_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("record_id", "envelope_id", "observed_at", "context").join(envelopes_once(spark, d).select("envelope_id", "collected_at", "default_context"), "envelope_id")
    found = context.fields(F.col("default_context"), F.col("context"))
    first, last = context.seen_window(found, F.coalesce("observed_at", "collected_at"))
    return rows.select("record_id", us(first, "first_us"), us(last, "last_us"))


def empty_contexts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "indicator_records").select("record_id", "envelope_id", "context").join(envelopes_once(spark, d).select("envelope_id", "default_context"), "envelope_id")
    rows = rows.withColumn("c", context.effective(F.col("default_context"), F.col("context")))
    return rows.where(context.encoded(F.col("c")).isNull()).select("record_id")


def edge_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "relationship").join(envelopes_once(spark, d).select("envelope_id", "collected_at"), "envelope_id")
    first, last = context.edge_window(F.col("first_seen"), F.col("last_seen"), F.col("collected_at"))
    return rows.select("edge_id", us(first, "first_us"), us(last, "last_us"))


# Validation


def _problems(rows: DataFrame, row_id: str, found: Column) -> DataFrame:
    return rows.select(row_id, F.explode(found).alias("p")).select(row_id, "p.path", "p.message")


def indicator_problems(spark: SparkSession, d: str) -> DataFrame:
    found = F.concat(validate.indicator_problems(F.col("indicator"), F.lit("indicator")), validate.context_problems(F.col("context"), F.lit("context"), F.lit(NOW).cast("timestamp")))
    return _problems(table(spark, d, "indicator_records"), "record_id", found)


def cve_problems(spark: SparkSession, d: str) -> DataFrame:
    return _problems(table(spark, d, "cve_records"), "record_id", validate.cve_problems(F.col("cve"), F.lit("cve"), F.lit(NOW).cast("timestamp"), "timestamp"))


def breach_problems(spark: SparkSession, d: str) -> DataFrame:
    return _problems(table(spark, d, "breach_records"), "record_id", validate.breach_problems(F.col("breach"), F.lit("breach"), F.lit(NOW).cast("timestamp"), "timestamp"))


def edge_problems(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "relationship").select("edge_id", F.struct("source", "target", "type", "confidence", "first_seen", "last_seen").alias("r"))
    return _problems(rows, "edge_id", validate.relationship_problems(F.col("r"), F.lit("edge"), F.lit(NOW).cast("timestamp"), "timestamp"))


def record_problems(spark: SparkSession, d: str) -> DataFrame:
    """All that is wrong with each record of each kind, checked as a whole."""
    text = {"cve": ("published_at", "modified_at"), "breach": ("disclosed_at",)}
    found = []
    for kind, form in {"indicator": INDICATOR, "cve": CVE, "breach": BREACH}.items():
        rows = table(spark, d, f"{kind}_records")
        payload = reduce(lambda c, x: c.withField(x, text_time(f"{kind}.{x}")), text.get(kind, ()), F.col(kind))
        parts = {"kind": F.col("kind"), "observed_at": text_time("observed_at"), "context": (F.col("context") if kind == "indicator" else F.lit(None)).cast(CONTEXT)}
        parts |= {k: F.lit(None).cast(t) for k, t in {"indicator": INDICATOR, "cve": CVE, "breach": BREACH}.items()} | {kind: payload.cast(form)}
        r = rows.select("record_id", F.struct(*[c.alias(k) for k, c in parts.items()]).alias("r"))
        found.append(_problems(r, "record_id", validate.record_problems(F.col("r"), F.lit("record"), F.lit(NOW).cast("timestamp"))).withColumn("of", F.lit(kind)))
    return reduce(DataFrame.unionByName, found)


def envelope_heads(spark: SparkSession, d: str) -> DataFrame:
    """All that is wrong with each envelope but for its records: its own fields, and its default context."""
    head = ["schema_version", "source", "source_run_id", text_time("collected_at").alias("collected_at"), "content_hash", "raw_ref", "default_context"]
    fine = F.from_json(F.lit('{"kind": "cve", "cve": {"cve_id": "CVE-2024-1234"}}'), RECORD)
    rest = [F.lit(None).cast("struct<media_type:string,encoding:string,data:string>").alias("raw"), F.array(fine).alias("records"), F.lit(None).cast(f"array<{RELATIONSHIP}>").alias("relationships")]
    rows = table(spark, d, "envelopes").select("envelope_id", F.struct(*head, *rest).alias("e"))
    return _problems(rows, "envelope_id", validate.envelope_problems(F.col("e"), F.lit(NOW).cast("timestamp")))


def drop_gate(spark: SparkSession, d: str) -> DataFrame:
    """All records by envelope: how many are dropped, and whether that is too many."""
    return build.drop_report(build.built(records(spark, d)), ["seq"]).withColumnRenamed("seq", "envelope_id").withColumn("ratio", F.round("ratio", 9))


def first_drops(spark: SparkSession, d: str) -> DataFrame:
    """The first three CVE records of each source with a score that no score can have."""
    bad = ~F.coalesce(F.col("cve.cvss_score").between(0, 10), F.lit(True)) | ~F.coalesce(F.col("cve.epss_score").between(0, 1), F.lit(True))
    rows = table(spark, d, "cve_records").select(C.lower_trimmed(F.col("source_slug")).alias("slug"), "record_id", F.when(bad, "score").alias("reason"))
    return build.drop_examples(rows, ["slug"], ["record_id"]).select("slug", "record_id", F.col("n").cast("long").alias("place"))


def written_counts(spark: SparkSession, d: str) -> DataFrame:
    """The rows that each envelope writes to each table."""
    rows = build.built(records(spark, d)).where("reason is null")
    joined = build.built_edges(edges(spark, d)).where("reason is null")
    return build.written(rows, joined).withColumnRenamed("seq", "envelope_id")


def drops_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return build.built(records(spark, d)).where("reason is not null").groupBy("source", "reason").agg(F.count("*").alias("n"))


# Folds


def entity_registry(spark: SparkSession, d: str) -> DataFrame:
    rows = build.built(records(spark, d)).where("reason is null")
    ends = build.built_edges(edges(spark, d)).where("reason is null")
    out = folds.fold(build.entities(rows, ends), ["kind", "key"], folds.LAWS["entity"])
    return out.select(entity_id(F.col("kind"), F.col("key")).alias("entity_id"), "kind", F.col("key").alias("canonical_key"), us("first_seen", "first_us"), us("last_seen", "last_us"))


def cve_entities(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cve_records").select(C.cve_id(F.col("cve.cve_id")).alias("canonical_key"), F.col("observed_at").alias("first_seen"), F.col("observed_at").alias("last_seen"))
    out = folds.fold(rows.where("canonical_key is not null"), ["canonical_key"], folds.LAWS["entity"])
    return out.select("canonical_key", us("first_seen", "first_us"), us("last_seen", "last_us"))


def cve_fold(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("cve")
    rows = table(spark, d, "cve_records").select(
        F.col("envelope_id").alias("seq"), F.col("record_index").alias("idx"), C.cve_id(c["cve_id"]).alias("cve_id"), *[context.set_(c[x]).alias(x) for x in ("summary", "cvss_vector")],
        build.lower_or_null(c["severity"]).alias("severity"), context.number(c["cvss_score"]).alias("cvss_score"), context.number(c["epss_score"]).alias("epss_score"), F.coalesce(c["known_exploited"], F.lit(False)).alias("known_exploited"),
        c["cwe"].alias("cwe"), c["published_at"].alias("published_at"), c["modified_at"].alias("modified_at"), c["refs"].alias("refs"),
    ).where("cve_id is not null")
    laws = {k: v for k, v in folds.LAWS["cve"].items() if k != "cve_id"}
    out = folds.fold(folds.last_row(rows, ["cve_id", "seq"]), ["cve_id"], laws, "seq")
    return out.withColumn("cwe", F.array_join("cwe", "|")).withColumns({"published_us": F.unix_micros("published_at"), "modified_us": F.unix_micros("modified_at")}).drop("published_at", "modified_at")


def breach_fold(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("breach")
    rows = table(spark, d, "breach_records").select(
        F.col("envelope_id").alias("seq"), F.col("record_index").alias("idx"), C.breach_slug(b["slug"], b["name"], F.year(b["breach_date"]), F.year(b["disclosed_at"])).alias("slug"), b["name"].alias("name"),
        context.set_(b["description"]).alias("description"), b["breach_date"].alias("breach_date"), b["disclosed_at"].alias("disclosed_at"), b["record_count"].alias("record_count"),
        b["data_classes"].alias("data_classes"), F.coalesce(b["verified"], F.lit(False)).alias("verified"),
    ).where("slug is not null")
    laws = {k: v for k, v in folds.LAWS["breach"].items() if k not in ("slug", "domain")}
    out = folds.fold(folds.last_row(rows, ["slug", "seq"]), ["slug"], laws, "seq")
    return out.withColumn("data_classes", F.array_join("data_classes", "|")).withColumn("disclosed_us", F.unix_micros("disclosed_at")).withColumn("breach_date", F.col("breach_date").cast("string")).drop("disclosed_at")


def indicator_fold(spark: SparkSession, d: str) -> DataFrame:
    rows = build.indicator_rows(build.built(records(spark, d, ("indicator",))).where("reason is null"))
    return folds.fold(folds.last_row(rows, ["entity_id", "seq"]), ["entity_id"], folds.LAWS["indicator"], "seq")


def edge_fold(spark: SparkSession, d: str) -> DataFrame:
    rows = build.edge_rows(build.built_edges(edges(spark, d)).where("reason is null"))
    out = folds.fold_edges(rows, ["source_id", "target_id", "type"])
    return out.withColumns({"first_us": F.unix_micros("first_seen"), "last_us": F.unix_micros("last_seen")}).drop("first_seen", "last_seen")


def edge_fold_as_written(spark: SparkSession, d: str) -> DataFrame:
    """Edges folded by their ends as they are written."""
    rows = table(spark, d, "relationship").join(envelopes_once(spark, d).select("envelope_id", "collected_at"), "envelope_id")
    first, last = context.edge_window(F.col("first_seen"), F.col("last_seen"), F.col("collected_at"))
    name = lambda x: F.concat_ws(":", f"{x}.kind", f"{x}.value")
    rows = rows.select(F.col("envelope_id").alias("seq"), F.col("edge_id").alias("idx"), name("source").alias("source_key"), name("target").alias("target_key"), "type", "confidence", first.alias("first_seen"), last.alias("last_seen"), "metadata")
    out = folds.fold_edges(rows, ["source_key", "target_key", "type"])
    return out.withColumns({"first_us": F.unix_micros("first_seen"), "last_us": F.unix_micros("last_seen")}).drop("first_seen", "last_seen")


def first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Each envelope's first delivery; later ones of the same source and digest have no effect."""
    rows = table(spark, d, "envelopes").select(C.lower_trimmed(F.col("source")).alias("source"), "envelope_digest", "envelope_id", "received_at")
    out = rows.groupBy("source", "envelope_digest").agg(F.min(F.struct("received_at", "envelope_id")).alias("r"), F.count("*").alias("n_deliveries"))
    return out.select("source", "envelope_digest", "r.envelope_id", us("r.received_at", "received_us"), "n_deliveries")


def source_runs(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "envelopes").select(C.lower_trimmed(F.col("source")).alias("slug"), F.col("collected_at").alias("at"))
    return registry.run(table(spark, d, "sources"), runs).select("slug", us("last_run_at", "last_run_us"))


def lookup_table(spark: SparkSession, d: str) -> DataFrame:
    rows = build.verdict_rows(build.built(records(spark, d, ("indicator",))).where("reason is null"))
    out = lookup.fold_lookup(rows.withColumn("source", C.lower_trimmed(F.col("source"))))
    return out.select("entity_id", "type", "value", us("first_seen", "first_us"), us("last_seen", "last_us"), F.array_join("sources", "|").alias("sources"), F.array_join("tags", "|").alias("tags"), "confidence")


def lookup_state(spark: SparkSession, d: str) -> DataFrame:
    """The lookup table as a state that is stored after half of the envelopes, and what came since."""
    rows = build.verdict_rows(build.built(records(spark, d, ("indicator",))).where("reason is null")).withColumn("source", C.lower_trimmed(F.col("source"))).withColumn("refreshed_at", F.lit(NOW).cast("timestamp"))
    half = F.percentile_approx("envelope_id", 0.5)
    cut = table(spark, d, "envelopes").agg(half).first()[0] or 0
    out = lookup.merged(lookup.fold_lookup(rows.where(F.col("seq") <= cut)), lookup.fold_lookup(rows.where(F.col("seq") > cut)))
    return out.select("entity_id", "type", "value", us("first_seen", "first_us"), us("last_seen", "last_us"), F.array_join("sources", "|").alias("sources"), F.array_join("tags", "|").alias("tags"), "confidence")


def lookup_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The lookup table of values that are hashes."""
    rows = table(spark, d, "indicator_records").join(envelopes_once(spark, d).select("envelope_id", "collected_at", "default_context"), "envelope_id")
    found = context.fields(F.col("default_context"), F.col("context"))
    first, last = context.seen_window(found, F.coalesce("observed_at", "collected_at"))
    rows = rows.withColumns({"first": first, "last": last, "tags": found["tags"], "confidence": found["confidence"]})
    rows = C.with_observable(rows, "seen", F.col("indicator.type"), F.col("indicator.raw_value")).where(F.col("seen.type").isin(*HASHES))
    verdicts = rows.select(F.col("envelope_id").alias("seq"), F.col("record_index").alias("idx"), "seen.type", "seen.value", F.col("first").alias("first_seen"), F.col("last").alias("last_seen"), C.lower_trimmed(F.col("source_slug")).alias("source"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "confidence")
    out = lookup.fold_lookup(verdicts)
    return out.select("type", "value", us("first_seen", "first_us"), us("last_seen", "last_us"), F.array_join("sources", "|").alias("sources"), F.array_join("tags", "|").alias("tags"), "confidence")


def capped_tags(spark: SparkSession, d: str) -> DataFrame:
    """The last 8 of the distinct tags of each source, in the order in which they first came."""
    rows = table(spark, d, "indicator_records").select(C.lower_trimmed(F.col("source_slug")).alias("slug"), "record_id", F.posexplode("context.tags").alias("i", "tag")).where("slug is not null")
    return lookup.last_distinct(rows, ["slug"], "tag", 8, "record_id", "i").select("slug", F.array_join("values", "|").alias("tags"))


# Joins and graph


def source_status(spark: SparkSession, d: str) -> DataFrame:
    rows = registry.resolved(table(spark, d, "indicator_records"), table(spark, d, "sources"), "source_slug")
    return rows.groupBy("source_status").agg(F.count("*").alias("n"))


def sources_list(spark: SparkSession, d: str) -> DataFrame:
    return registry.listing(table(spark, d, "sources")).select("slug", "name", "url", "tlp", "enabled")


def stub_cves(spark: SparkSession, d: str) -> DataFrame:
    """CVEs that an edge of an envelope names and no record of that envelope describes."""
    rows = table(spark, d, "cve_records").select(F.col("envelope_id").alias("seq"), F.lit("cve").alias("kind"), C.cve_id(F.col("cve.cve_id")).alias("key"))
    ends = table(spark, d, "relationship").select(F.col("envelope_id").alias("seq"), F.col("edge_id").alias("idx"), "source", "target", "first_seen", "last_seen")
    for x in ("source", "target"):
        ends = ends.withColumns({f"{x}_kind": F.col(f"{x}.kind"), f"{x}_key": F.when(F.col(f"{x}.kind") == "cve", C.cve_id(F.col(f"{x}.value"))), f"{x}_type": F.lit(None).cast("string")})
    return build.stubs(rows, ends).where("kind = 'cve' and key is not null").select("seq", F.col("key").alias("cve_id"), "place")


def stub_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = build.built(records(spark, d)).where("reason is null")
    return build.stubs(rows, build.built_edges(edges(spark, d)).where("reason is null")).select("seq", "kind", "key", "type", "place")


def breach_domains(spark: SparkSession, d: str) -> DataFrame:
    """The domain of each breach, and how many indicator records are of it."""
    breaches = build.with_domain(table(spark, d, "breach_records").select("record_id", "breach.domain"), "d", F.col("domain")).select("record_id", F.col("d").alias("value"))
    known = C.with_observable(table(spark, d, "indicator_records").select("indicator"), "seen", F.col("indicator.type"), F.col("indicator.raw_value")).where("seen.type = 'domain'")
    return breaches.join(known.groupBy(F.col("seen.value").alias("value")).agg(F.count("*").alias("n")), "value", "left").select("record_id", F.col("value").alias("domain"), F.coalesce("n", F.lit(0)).alias("n_records"))


def self_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose ends are the same entity, however each is written."""
    rows = table(spark, d, "relationship")
    for x in ("source", "target"):
        rows = C.with_endpoint_key(rows, x, x)
    return rows.where((F.col("source_kind") == F.col("target_kind")) & (F.col("source_key") == F.col("target_key"))).select("edge_id")


def node_degrees(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(nodes(spark, d))


def two_hops(spark: SparkSession, d: str) -> DataFrame:
    return graph.two_hop_counts(nodes(spark, d))


def reachable(spark: SparkSession, d: str) -> DataFrame:
    """All nodes within three edges of the CVEs that edges begin at."""
    found = settled(nodes(spark, d))  # read in each hop
    return graph.reach(found, found.where(F.col("source").startswith("cve:")).select(F.col("source").alias("node")), 3)


def orphan_sightings(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "sources").select(F.col("id").alias("source_id"))
    return table(spark, d, "sighting").join(known, "source_id", "left_anti").select("sighting_id")


def similar_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of breaches that are alike; queries are the records whose id is divisible by 50."""
    rows = table(spark, d, "breach_records").select("record_id", F.col("breach.name").alias("text"))
    return fuzzy.similar(rows.where(F.col("record_id") % 50 == 0), rows, "0.5").select("query", "text", F.round("similarity", 6).alias("similarity"))


def similar_values(spark: SparkSession, d: str) -> DataFrame:
    """Canonical indicator values that are alike; queries are those of the records whose id is divisible by 50."""
    rows = C.with_observable(table(spark, d, "indicator_records").select("record_id", "indicator"), "seen", F.col("indicator.type"), F.col("indicator.raw_value"))
    values = settled(rows.groupBy(F.col("seen.value").alias("text")).agg(F.max(F.col("record_id") % 50 == 0).alias("asked")).where("text is not null"))
    return fuzzy.similar(values.where("asked"), values, "0.5").select("query", "text", F.round("similarity", 6).alias("similarity"))


# Storage and maintenance


def sightings_by_month(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sighting").groupBy(build.month(F.col("observed_at")).alias("month")).agg(F.count("*").alias("n"))


def retained_months(spark: SparkSession, d: str) -> DataFrame:
    """Months of sightings, whether each is dropped at the cutoff: only if it ends by then."""
    name, start, end = build.month_bounds(F.col("observed_at"))
    months = table(spark, d, "sighting").select(name.alias("month"), start.alias("start_us"), end.alias("end_us")).distinct()
    return months.where("month is not null").withColumn("dropped", F.col("end_us") <= F.unix_micros(F.lit(f"{CUTOFF}T00:00:00Z").cast("timestamp")))


def archive_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", archive.content_hash(F.encode("text", "utf-8")).alias("content_hash"))
    return archive.first_copies(rows, "doc_id").withColumn("key", archive.key(F.col("content_hash")))


def dead_letter_rows(spark: SparkSession, d: str) -> DataFrame:
    """Values as if each were a message that failed: kept as they are if they are JSON, else as a JSON string."""
    rows = table(spark, d, "sighting").where("context is not null").select("sighting_id", "context")
    bad = F.concat("context", F.when(F.col("sighting_id") % 3 == 0, " rest").otherwise(""))
    return rows.withColumn("body", bad).select("sighting_id", dead_letters.payload(F.col("body")).alias("payload"))


# Analytics


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("at"), F.lit(1).alias("n"))


def event_rates(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.rate(_events(spark, d), ["event_type"], "at", "n", 300)
    return out.select("event_type", us("t", "t_us"), F.round("rate", 9).alias("rate"))


def event_increase(spark: SparkSession, d: str) -> DataFrame:
    return metrics.increase(_events(spark, d), ["event_type"], "at", "n", 3600).select("event_id", "increase")


def duplicate_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Of the deliveries of each day, the share that were delivered before."""
    rows = table(spark, d, "envelopes").select("envelope_digest", "received_at", "envelope_id")
    first = rows.groupBy("envelope_digest").agg(F.min("received_at").alias("first_at"))
    days = rows.join(first, "envelope_digest").withColumn("day", F.date_format("received_at", "yyyy-MM-dd"))
    whole = days.groupBy("day").agg(F.count("*").alias("n"))
    again = days.groupBy("day").agg(F.count(F.when(F.col("received_at") > F.col("first_at"), 1)).alias("n"))
    return metrics.ratio(again, whole, ["day"], "n").withColumn("ratio", F.round("ratio", 9))


def delivery_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """How long the slowest hundredth of each source's envelopes takes from collection to receipt, from a histogram."""
    rows = table(spark, d, "envelopes").select(C.lower_trimmed(F.col("source")).alias("source"), ((F.unix_micros("received_at") - F.unix_micros("collected_at")) / 1e6).alias("s"))
    return metrics.bucket_quantile(rows, ["source"], "s", 0.99, BOUNDS).select("source", F.round("quantile", 6).alias("p99"))


def alert_silent_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources with indicator records but without a record of a CVE."""
    slug = C.lower_trimmed(F.col("source_slug")).alias("slug")
    some = table(spark, d, "indicator_records").select(slug).where("slug is not null").distinct()
    return metrics.unless(some, table(spark, d, "cve_records").select(slug), ["slug"])


def alert_held(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of an hour or more in which every event of a type has a value above 20."""
    rows = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"), "value").groupBy("event_type", "at").agg(F.min("value").alias("value"))
    return metrics.firing(rows, ["event_type"], "at", F.col("value") > 20, 3600).select("event_type", us("start", "start_us"), us("end", "end_us"))


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream, by windows of 5 minutes; those that the watermark has closed."""
    source = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    out, check = scratch_path(spark, "windows"), scratch_path(spark, "windows-state")
    counts = windowed_counts(source.select("ts", "event_type"), "ts", "event_type").select("event_type", us("start", "start_us"), "n")
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_type string, start_us long, n long").parquet(out)


QUERIES = (
    defanged_values, canonical_indicators, inferred_types, hash_values, ipv4_values, cve_ids, breach_slugs, endpoint_keys, effective_contexts, seen_windows, empty_contexts, edge_windows,
    indicator_problems, cve_problems, breach_problems, edge_problems, record_problems, envelope_heads, drop_gate, first_drops, written_counts, drops_by_reason, entity_registry, cve_entities, cve_fold, breach_fold, indicator_fold, edge_fold,
    edge_fold_as_written, first_deliveries, source_runs, lookup_table, lookup_state, lookup_hashes, capped_tags, source_status, sources_list, stub_cves, stub_rows, breach_domains, self_edges, node_degrees, two_hops,
    reachable, orphan_sightings, similar_names, similar_values, sightings_by_month, retained_months, archive_keys, dead_letter_rows, event_rates, event_increase, duplicate_ratio, delivery_quantiles,
    alert_silent_sources, alert_held, stream_windows,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from sightline import oracle_entities, oracle_reference

    return oracle_reference.oracle_sql() | oracle_entities.oracle_sql()
