"""Work on keys of any size: rows are placed by sampled quantiles of (key, order), not by key.

A key that holds a third of all rows then spans a third of the partitions, in order.  Each partition
reduces its stretch of every key to a state; only the keys that cross a partition's edge have more than
one state, and those are stitched from (partition, state) in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def placed(df: DataFrame, *by: str) -> DataFrame:
    """df range-partitioned on `by` by sampled quantiles, sorted within each partition. Nulls come first."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def changes(keys: pa.Array | pa.ChunkedArray, before=None) -> np.ndarray:
    """Where a sorted key differs from the one in front of it; `before` is the key that came before the first."""
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    out = np.ones(len(keys), bool)
    if len(keys):
        a, b = keys[1:], keys[:-1]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        out[1:] = ~same.to_numpy(zero_copy_only=False)
        out[0] = before is None or before[0] != keys[0].as_py()
    return out


def profile(df: DataFrame, key: str, at: str, row_id: str) -> DataFrame:
    """Per key: rows, rows with a time, first and last time, and the longest gap between neighbours in time.

    Columns: key, n_rows, n_timed, first_us, last_us, max_gap_us (microseconds).  One key may hold any share
    of the rows.  Null keys form one group; null times count in n_rows only; a key without two times has a
    null gap; an empty table gives no rows.  Other columns of df are not read.
    """
    rows = df.select(F.col(key).alias("k"), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), F.col(row_id).alias("id"))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list | None = None  # [key, rows, timed, first, last, gap] of the stretch still open

        def out(found: list[list]) -> pa.RecordBatch:
            cols = list(zip(*found)) if found else [()] * 6
            kinds = (pa.string(), *[pa.int64()] * 5)
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds)), pa.array([part] * len(found), pa.int32())], names=["k", "n_rows", "n_timed", "first_us", "last_us", "gap", "part"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            cut = np.flatnonzero(changes(keys))
            us, timed = batch.column(1).fill_null(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            ends = np.append(cut[1:], len(us))
            n_timed = np.add.reduceat(timed.astype(np.int64), cut)
            step = np.zeros(len(us), np.int64)
            step[1:] = us[1:] - us[:-1]
            step[~timed] = 0
            step[1:][~timed[:-1]] = 0
            step[cut] = 0
            gap = np.maximum.reduceat(step, cut)
            first = np.minimum(ends - n_timed, ends - 1)  # nulls sort first within a key
            found = []
            for i, j in enumerate(cut):
                t = int(n_timed[i])
                state = [keys[int(j)].as_py(), int(ends[i] - j), t, int(us[first[i]]) if t else None, int(us[ends[i] - 1]) if t else None, int(gap[i]) if t > 1 else None]
                if held is not None and held[0] == state[0]:
                    held = stitched(held, state)
                else:
                    if held is not None:
                        found.append(held)
                    held = state
            yield out(found)
        if held is not None:
            yield out([held])

    parts = placed(rows, "k", "us", "id").mapInArrow(states, "k string, n_rows long, n_timed long, first_us long, last_us long, gap long, part int")
    # at most one state for each partition that holds some of the key
    seen = parts.groupBy("k").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_timed").alias("n_timed"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.max("gap").alias("gap"), F.array_sort(F.collect_list(F.when(F.col("n_timed") > 0, F.struct("part", "first_us", "last_us")))).alias("s"))
    joints = F.transform(F.expr("slice(s, 2, size(s))"), lambda x, i: x["first_us"] - F.col("s")[i]["last_us"])
    return seen.select(F.col("k").alias(key), "n_rows", "n_timed", "first_us", "last_us", F.array_max(F.concat(joints, F.array("gap"))).alias("max_gap_us"))


def stitched(a: list, b: list) -> list:
    """The state of two stretches of one key that follow each other."""
    gaps = [x for x in (a[5], b[5], b[3] - a[4] if a[2] and b[2] else None) if x is not None]
    return [a[0], a[1] + b[1], a[2] + b[2], a[3] if a[2] else b[3], b[4] if b[2] else a[4], max(gaps, default=None)]


def _unused(df: DataFrame, name: str) -> str:
    """A name that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ranks(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df with rank_in_key: 1, 2, ... in each key by `order` (nulls first), without a task per key.

    A column of that name is replaced. `order` should end in a unique column, else ties are ranked arbitrarily.  The placed rows are written to
    the shared folder once; each partition numbers its own, and adds how many rows of its first key came in
    the partitions before (one small row for each partition).
    """
    from sightline.session import settled

    n = "rank_in_key"
    df = df.drop(n)
    at_part, at_open, at_base = (_unused(df, x) for x in ("part", "open", "base"))
    schema = T.StructType([*df.schema, T.StructField(at_part, T.IntegerType()), T.StructField(n, T.LongType()), T.StructField(at_open, T.BooleanType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, before, leading = TaskContext.get().partitionId(), 0, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key))
            new = changes(keys, before)
            at = np.arange(len(new))
            since = np.maximum.accumulate(np.where(new, at, -1))
            number = np.where(since < 0, seen + at + 1, at - since + 1)
            crossed = np.cumsum(new) > (1 if before is None else 0)
            opened = ~crossed if leading else np.zeros(len(new), bool)
            leading = leading and not crossed[-1]
            seen, before = int(number[-1]), (keys[len(new) - 1].as_py(),)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(new), part, np.int32)), pa.array(number), pa.array(opened)], names=[*batch.schema.names, at_part, n, at_open])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge: dict = {}
        for batch in batches:
            if batch.num_rows:
                k, m, p = batch.columns
                edge.setdefault("first", k[0].as_py())
                edge |= {at_part: p[0].as_py(), "last": k[batch.num_rows - 1].as_py(), "n": m[batch.num_rows - 1].as_py()}
        if edge:
            yield pa.RecordBatch.from_pylist([edge], schema=pa.schema([(at_part, pa.int32()), ("first", k.type), ("last", k.type), ("n", pa.int64())]))

    local = settled(placed(df, key, *order).mapInArrow(number, schema))
    kind = schema[key].dataType.simpleString()
    carry, count, base = object(), 0, []
    for r in sorted(local.select(key, n, at_part).mapInArrow(ends, f"{at_part} int, first {kind}, last {kind}, n long").collect(), key=lambda r: r[at_part]):  # one row a partition
        base.append((r[at_part], count if r["first"] == carry else 0))
        count = r["n"] + (base[-1][1] if r["first"] == r["last"] else 0)
        carry = r["last"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(base, f"{at_part} int, {at_base} long"))
    return local.join(offsets, at_part).withColumn(n, F.col(n) + F.when(F.col(at_open), F.col(at_base)).otherwise(0)).drop(at_part, at_open, at_base)
