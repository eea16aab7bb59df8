"""The course of a batch of envelope files: decode, validate, build, judge, claim, write."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators import build, validate
from sightline.operators.ranges import ranks
from sightline.plans.schemas import MAX_DROP_RATIO
from sightline.plans.store import Store
from sightline.session import settled
from sightline.sources import archive, dead_letters, envelopes
from sightline.sources.registry import resolved, run

#: Attempts after which a file that fails again and again is parked.
MAX_ATTEMPTS = 5


def checked(files: DataFrame, now: Column) -> DataFrame:
    """files with digest, e, and problems: what decoding or validation found (empty if nothing)."""
    rows = envelopes.decoded(files)
    found = F.when(F.col("problem").isNotNull(), F.array(F.struct(F.lit("").alias("path"), F.col("problem").alias("message")))).otherwise(validate.envelope_problems(F.col("e"), now))
    return rows.withColumn("problems", found)


def report(files: DataFrame, now: Column) -> DataFrame:
    """path, ok, source, records, relationships, problems of each file: nothing is written."""
    rows = checked(files, now)
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    lines = F.transform("problems", lambda p: F.concat_ws(": ", F.nullif(p["path"], F.lit("")), p["message"]))
    return rows.select("path", (F.size("problems") == 0).alias("ok"), F.coalesce(F.col("e.source"), envelopes.source_of(F.col("body"))).alias("source"), size(F.col("e.records")).alias("records"), size(F.col("e.relationships")).alias("relationships"), lines.alias("problems"))


def ordered(rows: DataFrame, first: int) -> DataFrame:
    """rows with seq: their order of arrival, by time and path, from `first` on. Files are numbered by ranges of (time,
    path), without their bodies, so any number of them is spread over the partitions."""
    keys = ranks(rows.select("path", "modified").withColumn("all", F.lit(0)), "all", "modified", "path")
    return rows.join(keys.select("path", (F.col("rank_in_key") + F.lit(first - 1)).cast("long").alias("seq")), "path")


# Upper bounds of the histograms of seconds a batch and records an envelope.
SECONDS = (0.005, 0.025, 0.1, 0.25, 1, 2.5, 10, 30, 60)
SIZES = (1, 10, 100, 1000, 5000, 20000, 50000)


def within(x: Column, bounds: tuple) -> Column:
    """The least of the bounds that x doesn't exceed, as text; +inf beyond the last."""
    out = F.lit("+inf")
    for b in reversed(bounds):
        out = F.when(x <= b, str(b)).otherwise(out)
    return out


def counters(rows: DataFrame, made: DataFrame, claimed: DataFrame, now: Column, seconds: float) -> DataFrame:
    """What a batch did, as increments: envelopes by outcome, records by kind, drops by reason, sightings, and envelopes by
    their number of records, of each source; and batches by how long they took, of each source that is in them."""
    done = rows.join(claimed.withColumn("new", F.lit(True)), "seq", "left")
    outcome = F.when(F.col("stage").isNotNull(), "dead_letter").when(F.col("new"), "written").otherwise("duplicate")
    taken = made.join(claimed, "seq", "left_semi")
    parts = [
        done.select("source", F.lit("envelopes").alias("metric"), outcome.alias("label")),
        taken.where("reason is null").select("source", F.lit("records").alias("metric"), F.col("kind").alias("label")),
        taken.where("reason is not null").select("source", F.lit("dropped").alias("metric"), F.col("reason").alias("label")),
    ]
    sizes = taken.groupBy("source", "seq").agg(F.count("*").alias("n"))
    parts += [
        taken.where("reason is null").select("source", F.lit("sightings").alias("metric"), F.lit("").alias("label")),
        sizes.select("source", F.lit("envelope_records").alias("metric"), within(F.col("n"), SIZES).alias("label")),
        sizes.select("source").distinct().select("source", F.lit("write_seconds").alias("metric"), within(F.lit(seconds), SECONDS).alias("label")),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("source", "metric", "label").agg(F.count("*").alias("n")).withColumn("at", now)


def process(files: DataFrame, store: Store, batch: str, now: Column, sources: DataFrame | None = None, max_drop_ratio: float = MAX_DROP_RATIO, attempts: DataFrame | None = None) -> dict[str, int]:
    """Take in a batch of files (path, modified, body); returns how many envelopes were written, duplicates or parked.

    Parked, with the stage at which: what can't be decoded or validated, comes from a source that is unknown or
    disabled (if `sources` is given), loses more than `max_drop_ratio` of its records, or has failed more than
    5 times (`attempts`: digest, n). An envelope whose digest was written before, or that is in the batch twice, has
    no effect. Processing a batch again has none either.
    """
    began = time.monotonic()
    if batch in store.batches:
        return {"written": 0, "duplicate": 0, "parked": 0}
    before = store.delta("envelope_log")
    top = before.agg(F.max("seq")).first()[0]
    if attempts is None:
        rows = checked(files, now).withColumn("poison", F.lit(False))
    else:  # what failed again and again is not even decoded once more
        known = attempts.where(F.col("n") > MAX_ATTEMPTS).select(F.col("digest").alias("digest_")).distinct()
        match = envelopes.digest(F.col("body")) == F.col("digest_")
        rows = checked(files.join(known, match, "left_anti"), now).withColumn("poison", F.lit(False))
        poison = files.join(known, match, "left_semi").where(F.length("body") > 0).withColumn("digest", envelopes.digest(F.col("body"))).withColumn("poison", F.lit(True))
        empty = {k: F.lit(None).cast(rows.schema[k].dataType) for k in ("e", "problem")} | {"problems": F.array().cast(rows.schema["problems"].dataType)}
        rows = rows.unionByName(poison.withColumns(empty))
    rows = settled(ordered(rows, 0 if top is None else top + 1))

    stage = F.when(F.col("poison"), "poison").when(F.size("problems") > 0, "validate")
    reason = F.when(F.col("poison"), "failed again and again").when(F.size("problems") > 0, validate.summary(F.col("problems")))
    rows = rows.withColumn("source", F.col("e.source"))
    if sources is not None:
        rows = resolved(rows, sources, "source")
        refused = F.col("source_status") != "known"
        stage = F.coalesce(stage, F.when(refused, "source"))
        reason = F.coalesce(reason, F.when(refused, F.concat(F.lit("source is "), F.col("source_status"))))
    rows = rows.withColumn("stage", stage).withColumn("reason", reason)
    inline = F.when(F.col("stage").isNull() & F.col("e.raw").isNotNull(), archive.payload(F.col("e.raw")))
    content = F.coalesce(F.nullif(F.col("e.content_hash"), F.lit("")), F.when(inline.isNotNull(), archive.content_hash(inline)))
    ref = F.coalesce(F.when(inline.isNotNull(), archive.key(archive.content_hash(inline))), F.nullif(F.col("e.raw_ref"), F.lit("")))
    rows = rows.withColumn("inline", inline).withColumn("e", F.when(F.col("e").isNotNull(), F.col("e").withField("content_hash", content).withField("raw_ref", ref)))

    fit = rows.where("stage is null")
    made = settled(build.built(envelopes.records(fit)))
    joined = settled(build.built_edges(envelopes.relationships(fit))).where("reason is null")
    bad = build.drop_report(made, ["seq"], max_drop_ratio, joined).where("rejected").select("seq", F.concat(F.col("n_dropped"), F.lit(" of "), F.col("n_records"), F.lit(" records dropped")).alias("why"))
    rows = rows.join(settled(bad), "seq", "left").withColumn("stage", F.coalesce("stage", F.when(F.col("why").isNotNull(), "canonicalise"))).withColumn("reason", F.coalesce("reason", "why")).drop("why")

    # the claim: the first delivery of each digest of a source, unless it was written before
    good = rows.where("stage is null")
    claimed = good.groupBy("source", "digest").agg(F.min("seq").alias("seq")).join(before.select("source", F.col("envelope_digest").alias("digest")), ["source", "digest"], "left_anti").select("seq")
    claimed = settled(claimed)
    taken = made.join(claimed, "seq", "left_semi").where("reason is null")
    edges = joined.join(claimed, "seq", "left_semi")
    extra = build.stubs(taken, edges)
    identity = build.entity_id(F.col("kind"), F.col("key"))
    stub = extra.select("seq", F.lit(2_000_000_000).alias("idx"), identity.alias("entity_id"), "kind", "key", "type")
    deltas = {
        "entity": build.entities(taken, edges).groupBy("kind", "key").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")).select(identity.alias("entity_id"), "kind", F.col("key").alias("canonical_key"), "first_seen", "last_seen"),
        "indicator": build.indicator_rows(taken).unionByName(stub.where("kind = 'indicator'").select("seq", "idx", "entity_id", "type", F.col("key").alias("value")), allowMissingColumns=True),
        "cve": build.cve_rows(taken).unionByName(stub.where("kind = 'cve'").select("seq", "idx", "entity_id", F.col("key").alias("cve_id"), F.lit(False).alias("known_exploited")), allowMissingColumns=True),
        "breach": build.breach_rows(taken), "relationship": build.edge_rows(edges), "sighting": build.sighting_rows(taken), "lookup": build.verdict_rows(taken).withColumn("refreshed_at", now),
        "envelope_log": good.join(claimed, "seq", "left_semi").join(taken.groupBy("seq").agg(F.count("*").alias("record_count")), "seq", "left").select("seq", "source", F.col("digest").alias("envelope_digest"), F.col("e.content_hash").alias("content_hash"), F.col("e.source_run_id").alias("source_run_id"), F.col("e.schema_version").alias("schema_version"), F.coalesce("record_count", F.lit(0)).alias("record_count"), F.col("e.raw_ref").alias("raw_ref"), F.col("modified").alias("received_at"), now.alias("processed_at")),
        "dead_letter": dead_letters.rows(rows.where("stage is not null").select(F.coalesce("source", envelopes.source_of(F.col("body"))).alias("source"), F.col("path").alias("message_id"), "stage", "reason", F.col("body").cast("string").alias("body"), now.alias("failed_at"))),
    }
    deltas["metrics_log"] = lambda: counters(rows, made, claimed, now, time.monotonic() - began)  # the last to be written
    archive.put(store.spark, f"{store.root}/raw", rows.where("inline is not null").select(archive.content_hash(F.col("inline")).alias("content_hash"), archive.media_type(F.col("e.raw")).alias("media_type"), F.col("inline").alias("body")))
    if store.commit(batch, deltas) and store.has_sources:
        runs = good.join(claimed, "seq", "left_semi").select(F.col("source").alias("slug"), build.timestamp(F.col("e.collected_at")).alias("at"))
        store.save_sources(run(store.sources(), runs))
    n = rows.agg(F.count("*").alias("all"), F.count("stage").alias("parked")).first()
    written = claimed.count()
    return {"written": written, "duplicate": n["all"] - n["parked"] - written, "parked": n["parked"]}
