"""What is wrong, by the counters that batches leave (source, metric, label, n, at: increments)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators import metrics

# The share of dropped records, the seconds of a batch, and how long each has to last.
DROPPED, DROPPED_FOR = 0.05, 900
SLOW, SLOW_FOR = 30.0, 600
BOUNDS = (0.005, 0.025, 0.1, 0.25, 1.0, 2.5, 10.0, 30.0, 60.0)


def _rate(log: DataFrame, metric: str, seconds: int) -> DataFrame:
    return metrics.rate(log.where(F.col("metric") == metric), ["source"], "at", "n", seconds)


def dropping(log: DataFrame) -> DataFrame:
    """source, start, end: more than 5 of 100 records were dropped, over 15 minutes, for 15 minutes."""
    both = log.where(F.col("metric").isin("records", "dropped")).withColumn("metric", F.lit("all"))
    shares = metrics.ratio(_rate(log, "dropped", 900), _rate(both, "all", 900), ["source", "t"], "rate")
    return metrics.firing(shares, ["source"], "t", F.col("ratio") > DROPPED, DROPPED_FOR)


def nothing_usable(log: DataFrame) -> DataFrame:
    """source, start, end: records were dropped, and none was taken in, for 15 minutes."""
    return metrics.firing(metrics.unless(_rate(log, "dropped", 900), _rate(log, "records", 900), ["source", "t"]), ["source"], "t", F.col("rate") > 0, DROPPED_FOR)


def dead_letters(log: DataFrame) -> DataFrame:
    """source, start, end: some envelope was parked within the hour before."""
    parked = _rate(log.where("label = 'dead_letter'"), "envelopes", 3600)
    return metrics.firing(parked, ["source"], "t", F.col("rate") > 0, 0)


def slow_writes(log: DataFrame) -> DataFrame:
    """source, start, end: the slowest hundredth of batches took more than 30 seconds, over 5 minutes, for 10 minutes."""
    seen = log.where("metric = 'write_seconds'").withColumn("bound", F.coalesce(F.col("label").try_cast("double"), F.lit(float("inf"))))
    counts = metrics.rate(seen, ["source", "bound"], "at", "n", 300)
    total = counts.groupBy("source", "t").agg(F.sum("rate").alias("n"), *[F.sum(F.when(F.col("bound") <= b, F.col("rate")).otherwise(0)).alias(f"c{i}") for i, b in enumerate(BOUNDS)])
    return metrics.firing(total.withColumn("p99", metrics.quantile_of(0.99, list(BOUNDS))), ["source"], "t", F.col("p99") > SLOW, SLOW_FOR)


def all_of(log: DataFrame) -> DataFrame:
    """alert, source, start, end of each."""
    found = [f(log).select(F.lit(f.__name__).alias("alert"), "source", "start", "end") for f in (dropping, nothing_usable, dead_letters, slow_writes)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
