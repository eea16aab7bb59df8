"""The registry of sources: id, slug, name, url, tlp, enabled, config, last_run_at, created_at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.columns import lower_trimmed
from sightline.operators.folds import fold
from sightline.plans.schemas import TLP


def listing(sources: DataFrame) -> DataFrame:
    return sources.orderBy("slug")


def resolved(rows: DataFrame, sources: DataFrame, slug: str) -> DataFrame:
    """rows with source_id and source_status: 'known', 'disabled' or 'unknown' (a null slug too).

    The registry is small and its size is known (one row for each feed that someone set up): Spark may send it to all
    executors, and decides by its size.
    """
    known = sources.select(lower_trimmed(F.col("slug")).alias("slug_"), F.col("id").alias("source_id"), "enabled")
    status = F.when(F.col("source_id").isNull(), "unknown").when(F.col("enabled"), "known").otherwise("disabled")
    return rows.join(known, lower_trimmed(F.col(slug)) == F.col("slug_"), "left").withColumn("source_status", status).drop("slug_", "enabled")


def added(sources: DataFrame, new: DataFrame) -> DataFrame:
    """The registry with sources added or changed (slug, name, url, tlp, enabled, created_at): name, marking and state
    are the new ones, an url is kept where none is given. A marking that there is none of is refused (the row is left out)."""
    rows = sources.withColumn("seq", F.lit(0)).unionByName(new.where(F.col("tlp").isin(*TLP)).withColumn("seq", F.lit(1)), allowMissingColumns=True)
    laws = {"id": "first_set", "name": "last", "url": "keep", "tlp": "last", "enabled": "last", "config": "keep", "last_run_at": "keep", "created_at": "first_set"}
    return fold(rows, ["slug"], laws, "seq")


def registered(sources: DataFrame, slugs: DataFrame, now: Column) -> DataFrame:
    """The registry with slugs (column slug) that it didn't have; those it has stay as they are."""
    new = slugs.select("slug").where("slug is not null").distinct().join(sources.select("slug"), "slug", "left_anti")
    filled = new.select(F.sha2("slug", 256).substr(1, 32).alias("id"), "slug", F.col("slug").alias("name"), F.lit("clear").alias("tlp"), F.lit(True).alias("enabled"), now.alias("created_at"))
    return sources.unionByName(filled, allowMissingColumns=True)


def enabled(sources: DataFrame, slug: str, state: bool) -> DataFrame:
    return sources.withColumn("enabled", F.when(F.col("slug") == slug, F.lit(state)).otherwise(F.col("enabled")))


def run(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """The registry with last_run_at moved up to each source's latest run (runs: slug, at); never back."""
    latest = runs.groupBy("slug").agg(F.max("at").alias("at"))
    return sources.join(latest, "slug", "left").withColumn("last_run_at", F.greatest("last_run_at", "at")).drop("at")
