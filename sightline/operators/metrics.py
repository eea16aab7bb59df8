"""Rates, ratios, quantiles and alerts over rows of (labels, time, amount): increments, not running counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.operators.ranges import changes, placed
from sightline.session import settled


def increase(df: DataFrame, labels: list[str], at: str, amount: str, seconds: int, name: str = "increase") -> DataFrame:
    """df with the sum of `amount` over the `seconds` up to each row's time (the earliest instant excluded), by labels.

    Windows are laid over stretches of `seconds`, into which each row is also carried from the stretch before, so a
    label with most rows is divided by time. Rows without a time have null.
    """
    span = seconds * 1_000_000
    now = F.unix_micros(at)
    stretch = F.floor(now / span)
    rows = df.withColumn("stretch_", F.explode(F.when(now.isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.array(stretch, stretch + 1))))
    frame = Window.partitionBy(*labels, "stretch_").orderBy(now).rangeBetween(-span + 1, 0)
    total = F.when(now.isNotNull(), F.sum(amount).over(frame))
    return rows.withColumn(name, total).where(now.isNull() | (F.col("stretch_") == stretch)).drop("stretch_")


def rate(df: DataFrame, labels: list[str], at: str, amount: str, seconds: int, step: int = 30) -> DataFrame:
    """labels, t, rate: the amount a second over the `seconds` up to t, at each multiple of `step` seconds at which it
    isn't 0. Rows are added up by step before windows are laid over them, so a label with most rows is no burden."""
    if seconds % step:
        raise ValueError("seconds must be a multiple of step")
    tick = (F.ceil(F.unix_micros(at) / (step * 1_000_000)) * step).alias("tick")
    sums = df.where(F.col(at).isNotNull()).groupBy(*labels, tick).agg(F.sum(amount).alias("n"))
    ticks = F.explode(F.sequence("tick", F.col("tick") + seconds - step, F.lit(step)))
    out = sums.select(*labels, ticks.alias("t"), "n").groupBy(*labels, "t").agg((F.sum("n") / seconds).alias("rate"))
    return out.withColumn("t", F.timestamp_seconds("t"))


def ratio(part: DataFrame, whole: DataFrame, on: list[str], value: str, least: float = 1e-9) -> DataFrame:
    """on, ratio: part / whole where both have a row; a divisor below `least` counts as `least`."""
    a, b = part.select(*on, F.col(value).alias("a")), whole.select(*on, F.col(value).alias("b"))
    return a.join(b, on).select(*on, (F.col("a") / F.greatest("b", F.lit(least))).alias("ratio"))


def unless(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The rows of `left` that have no partner in `right`."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def bucket_quantile(df: DataFrame, labels: list[str], value: str, q: float, bounds: list[float]) -> DataFrame:
    """labels, quantile: by linear interpolation in a histogram with these upper bounds (and +inf), as monitoring
    systems do; a quantile beyond the last bound is the last bound. Null values don't count."""
    counts = [F.sum((F.col(value) <= b).cast("long")).alias(f"c{i}") for i, b in enumerate(bounds)]
    rows = df.where(F.col(value).isNotNull()).groupBy(*labels).agg(*counts, F.count("*").alias("n"))
    return rows.select(*labels, quantile_of(q, bounds).alias("quantile"))


def quantile_of(q: float, bounds: list[float]) -> Column:
    """The quantile of a histogram: columns c0, c1, ... hold how many are up to each bound, n how many there are."""
    rank = F.col("n") * q
    out: Column = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, before = (F.lit(float(bounds[i - 1])), F.col(f"c{i - 1}")) if i else (F.lit(0.0), F.lit(0))
        held = F.col(f"c{i}") - before
        inside = low + (bounds[i] - low) * (rank - before) / F.when(held > 0, held).otherwise(1)
        out = F.when(F.col(f"c{i}") >= rank, inside).otherwise(out)
    return out


def firing(df: DataFrame, labels: list[str], at: str, condition: Column, seconds: int) -> DataFrame:
    """labels, start, end: stretches of consecutive samples that all meet the condition and last `seconds` or more.

    Samples are placed by (labels, time), so a label with most samples spans many partitions. Each gives its runs
    of samples that agree; only the runs at a partition's edges are put together with their neighbours.
    """
    rows = df.where(F.col(at).isNotNull()).select(*labels, F.unix_micros(at).alias("us"), F.coalesce(condition, F.lit(False)).alias("ok"))
    kinds = ", ".join(f"{x} {rows.schema[x].dataType.simpleString()}" for x in labels)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None  # the run still open
        for batch in batches:
            if not batch.num_rows:
                continue
            us, ok = batch.column(len(labels)), batch.column(len(labels) + 1)
            table = pa.Table.from_arrays([*[batch.column(i) for i in range(len(labels))], ok, us, us], names=[*labels, "ok", "start", "end"])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            new = np.zeros(table.num_rows, bool)
            for c in [*labels, "ok"]:
                new |= changes(table.column(c))
            first = np.flatnonzero(new)
            last = np.append(first[1:], table.num_rows) - 1
            found = table.select([*labels, "ok", "start"]).take(pa.array(first)).append_column("end", table.column("end").take(pa.array(last)))
            held, whole = found.slice(found.num_rows - 1), found.slice(0, found.num_rows - 1)
            if whole.num_rows:
                edge = np.zeros(whole.num_rows, bool)
                edge[0] = seen == 0
                seen += whole.num_rows
                yield from whole.append_column("edge", pa.array(edge)).append_column("part", pa.array(np.full(whole.num_rows, part, np.int32))).combine_chunks().to_batches()
        if held is not None:
            yield from held.append_column("edge", pa.array([True])).append_column("part", pa.array([part], pa.int32())).combine_chunks().to_batches()

    found = settled(placed(rows, *labels, "us").mapInArrow(runs, f"{kinds}, ok boolean, start long, end long, edge boolean, part int"))
    order = Window.partitionBy(*labels).orderBy("start", "part")  # over at most two rows a partition
    edges = found.where("edge").withColumn("new_", (F.col("ok") != F.coalesce(F.lag("ok").over(order), ~F.col("ok"))).cast("int"))
    # a run inside a partition parts the edges on either side of it
    edges = edges.withColumn("same_part_", (F.col("part") == F.lag("part").over(order)).cast("int")).withColumn("run_", F.sum(F.greatest("new_", F.coalesce("same_part_", F.lit(0)))).over(order))
    joined = edges.where("ok").groupBy(*labels, "run_").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run_")
    inner = found.where("ok and not edge").select(*labels, "start", "end")
    return inner.unionByName(joined).where(F.col("end") - F.col("start") >= seconds * 1_000_000).select(*labels, F.timestamp_micros("start").alias("start"), F.timestamp_micros("end").alias("end"))
