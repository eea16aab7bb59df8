"""Continuous periods and gaps from overlapping, nested, touching and separate intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators.ranges import changes, placed
from sightline.session import settled


def merge_sorted(new: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of intervals sorted by (key, start), `new` marking each key's first: the index at which each maximal
    union begins, and where it ends in time.  The one merge step: of raw intervals, of partial lists, of both.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), end
    order = np.argsort(end, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    high = np.maximum.accumulate(rank + (np.cumsum(new) - 1) * n)  # running maximum within a key
    reach = end[order[high % n]]
    apart = new.copy()
    apart[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(apart)
    return at, reach[np.append(at[1:], n) - 1]


def _leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted disjoint lists of the keys of one block of rows, where they lie."""
    for batch in batches:
        batch = batch.take(pc.sort_indices(batch, sort_keys=[("k", "ascending"), ("s", "ascending")]))
        at, end = merge_sorted(changes(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pc.take(batch.column(1), pa.array(at)), pa.array(end)], names=["k", "s", "e"])


def _lists(batches: Iterator[pa.RecordBatch], seed: tuple | None = None) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """The disjoint lists of a sorted partition in blocks; the last interval of each block is held for the next.

    `seed` is an interval of the partition's first key that reaches in from the partitions before.
    """
    held = None if seed is None else pa.RecordBatch.from_arrays([pa.array([x]) for x in seed], names=["k", "s", "e"])
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(["k", "s", "e"])
        if held is not None:
            batch = pa.Table.from_batches([held.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
        at, end = merge_sorted(changes(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy())
        whole = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(end)], names=["k", "s", "e"])
        held = whole.slice(whole.num_rows - 1)
        if whole.num_rows > 1:
            yield whole.slice(0, whole.num_rows - 1), False
    if held is not None:
        yield held, True


def periods_and_gaps(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, what ('period' or 'gap'), start_us, end_us: closed intervals [start, end] in integer microseconds.

    Intervals that share at least an instant are one period, touching ends included; a gap runs from a
    period's end to the start of the key's next.  Rows with a null key, a null bound or start > end hold no
    interval and are left out; repeated rows change nothing; an empty table gives no rows; other columns are
    not read.

    The aggregate is a sorted list of disjoint intervals.  Lists are made where the rows lie, one for each
    key and block, and merged in a tree: blocks into partitions that hold a range of (key, start), and those
    at their edges, where only the reach of the partitions before matters: one interval a partition, made
    by folding (start of the open period, its end) over at most two rows a partition.  So a key with any
    number of periods is spread over many partitions, and none holds another's list.
    """
    raw = df.select(F.col(key).alias("k"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")).where("k is not null and s <= e")
    schema = raw.schema

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, leading, first = TaskContext.get().partitionId(), True, None
        last = None
        for block, done in _lists(batches):
            keys = block.column(0)
            first = keys[0].as_py() if first is None else first
            mark = np.zeros(block.num_rows, bool)  # the last interval of the first key, and the partition's last
            if last is not None:
                if leading and keys[0].as_py() != first:
                    last = last.set_column(3, "mark", pa.array([True]))
                    leading = False
                yield last
            if leading:
                cut = np.flatnonzero(changes(keys))
                if len(cut) > 1:
                    mark[cut[1] - 1], leading = True, False
            mark[-1] |= done
            rows = pa.RecordBatch.from_arrays([*block.columns, pa.array(mark), pa.array(np.full(block.num_rows, part, np.int32))], names=["k", "s", "e", "mark", "part"])
            last = rows.slice(rows.num_rows - 1)
            yield rows.slice(0, rows.num_rows - 1)
        if last is not None:
            yield last

    leaves = settled(raw.mapInArrow(_leaf, schema))  # narrow rows, read for the quantiles and once more to be placed
    lists = settled(placed(leaves, "k", "s").mapInArrow(level, T.StructType([*schema, T.StructField("mark", T.BooleanType()), T.StructField("part", T.IntegerType())])))

    seeds: dict[int, tuple] = {}
    open_: tuple | None = None  # key, start and end of the period that is open at the end of a partition
    part = None
    for r in sorted(lists.where("mark").collect(), key=lambda r: (r["part"], r["k"], r["s"])):  # at most two rows a partition
        if r["part"] != part:
            part = r["part"]
            if open_ is not None and open_[0] == r["k"]:
                seeds[part] = open_
        reaches = open_ is not None and open_[0] == r["k"] and r["s"] <= open_[2]
        open_ = (r["k"], open_[1], max(open_[2], r["e"])) if reaches else (r["k"], r["s"], r["e"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def rest():
            yield first
            yield from batches

        seed = seeds.get(first.column(4)[0].as_py())
        tail, leading = None, True
        for block, done in _lists(rest(), seed):
            if tail is not None:
                block = pa.Table.from_batches([tail, block.cast(tail.schema)]).combine_chunks().to_batches()[0]
            n = block.num_rows
            same = ~changes(block.column(0))[1:]
            s, e = block.column(1).to_numpy(), block.column(2).to_numpy()
            edge = np.zeros(n, bool)
            edge[0], edge[-1] = leading, done
            fresh = slice(0 if tail is None else 1, n)
            k = block.column(0)
            yield pa.RecordBatch.from_arrays([k.slice(fresh.start), pa.array(["period"] * (n - fresh.start)), pa.array(s[fresh]), pa.array(e[fresh]), pa.array(edge[fresh])], names=["k", "what", "s", "e", "edge"])
            i = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays([k.take(pa.array(i)), pa.array(["gap"] * len(i), pa.string()), pa.array(e[i]), pa.array(s[i + 1]), pa.array(np.zeros(len(i), bool))], names=["k", "what", "s", "e", "edge"])
            tail, leading = block.slice(n - 1), False

    found = lists.mapInArrow(finish, f"k {schema['k'].dataType.simpleString()}, what string, s long, e long, edge boolean")
    found = settled(found)
    # a period that crosses an edge is in both partitions, its last part with the furthest end
    crossing = found.where("edge").groupBy("k", "what", "s").agg(F.max("e").alias("e"))
    return found.where("not edge").drop("edge").unionByName(crossing).select(F.col("k").alias(key), "what", F.col("s").alias("start_us"), F.col("e").alias("end_us"))
