"""Items that occur together in baskets, and how much more often than chance: a blocked Gram matrix."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import settled

WIDTH = 512  # items in a block of columns
CELLS = 4_000_000  # cells of a dense block, or products of two entries, that are held at once
ENTRIES = 2_000_000  # entries of the matrix in one block of records
NAMED = 1_000_000  # items that may be sent to all executors; of more, none is

Entries = tuple[np.ndarray, np.ndarray]  # rows and columns of a binary block, sorted by row


def product(x: Entries, y: Entries, width: int) -> np.ndarray:
    """X'Y of two sparse binary blocks of the same records: a width x width matrix of counts.

    Only records with entries in both matter. Blocks that are full enough are multiplied as dense matrices, a stretch of
    records at a time; of sparse ones the entries of each record are multiplied, as many at a time as CELLS allows (a
    record has at most width x width of them in two blocks, whatever its length).
    """
    rows = np.intersect1d(x[0], y[0])
    out = np.zeros((width, width), np.int64)
    if not len(rows):
        return out
    sides = []
    for r, c in (x, y):
        at = np.minimum(np.searchsorted(rows, r), len(rows) - 1)
        own = rows[at] == r
        sides.append((at[own], c[own]))
    (ri, ci), (rj, cj) = sides
    per_i, per_j = np.bincount(ri, minlength=len(rows)), np.bincount(rj, minlength=len(rows))
    begin_i, begin_j = np.cumsum(per_i) - per_i, np.cumsum(per_j) - per_j
    times = per_i * per_j
    if 16 * times.sum() > len(rows) * width * width:  # a product of dense matrices is cheaper
        step = max(CELLS // width, 1)
        for lo in range(0, len(rows), step):
            n = min(step, len(rows) - lo)
            dense = []
            for r, c, begin, per in ((ri, ci, begin_i, per_i), (rj, cj, begin_j, per_j)):
                part = slice(begin[lo], begin[lo + n - 1] + per[lo + n - 1])
                block = np.zeros((n, width), np.float32)
                block[r[part] - lo, c[part]] = 1
                dense.append(block)
            out += (dense[0].T @ dense[1]).astype(np.int64)
        return out
    total = np.cumsum(times)
    cuts = np.unique(np.r_[0, np.searchsorted(total, np.arange(CELLS, total[-1], CELLS)), len(rows)])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        mine = slice(begin_i[lo], begin_i[hi - 1] + per_i[hi - 1])
        n = per_j[ri[mine]]
        left = np.repeat(ci[mine], n)
        right = cj[np.repeat(begin_j[ri[mine]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)]
        out += np.bincount(left * width + right, minlength=width * width).reshape(width, width)
    return out


def gram(rows: np.ndarray, cols: np.ndarray, n_items: int, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, count) for the pairs a < b that occur in one block of records, block of items by block of items.

    rows, cols: the entries of the binary matrix records x items, each once, sorted by row.
    """
    order = np.argsort(cols // width, kind="stable")
    rows, cols = rows[order], cols[order]
    edges = np.searchsorted(cols // width, np.arange(-(-n_items // width) + 1))
    blocks = [(rows[lo:hi], cols[lo:hi] - k * width) for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))]
    for i, x in enumerate(blocks):
        for j in range(i, len(blocks)) if len(x[0]) else ():
            g = product(x, blocks[j], width) if len(blocks[j][0]) else None
            if g is not None and g.any():
                a, b = np.nonzero(np.triu(g, 1) if i == j else g)
                yield a + i * width, b + j * width, g[a, b]


def _at_least(left: tuple[str, int], right: tuple[str, str, int], n: int) -> Column:
    """left[0] * left[1] >= right[0] * right[1] * right[2] without rounding, for counts of at most n."""
    d = len(str(n))
    digits = [len(str(x)) for x in (left[1], right[2])]
    if max(d + digits[0], 2 * d + digits[1]) + 2 <= 38:
        wide = lambda x, p: (F.col(x) if isinstance(x, str) else F.lit(str(x))).cast(f"decimal({p},0)")
        return wide(left[0], d) * wide(left[1], digits[0]) >= (wide(right[0], d) * wide(right[1], d)).cast(f"decimal({2 * d},0)") * wide(right[2], digits[1])

    @F.pandas_udf("boolean")
    def enough(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:  # numbers of any length
        return pd.Series([int(i) * left[1] >= int(j) * int(k) * right[2] for i, j, k in zip(x, y, z)], dtype=bool)

    return enough(left[0], right[0], right[1])


def cooccurrence(baskets: DataFrame, items: Column, min_share: str = "0", min_lift: str = "0") -> DataFrame:
    """item_a, item_b (a < b by code point), n_ab, n_a, n_b, n_baskets, lift, of each pair that occurs together
    in at least `min_share` of the baskets and at least `min_lift` times as often as chance would have it.

    `items` is an array of strings; null and repeated items within a basket count once or not at all, and
    baskets without items don't count.  Both limits are given as decimal text and compared exactly.  An empty
    table gives no rows.  Other columns are not read.

    The baskets of one block of records are a sparse binary matrix X over the items that occur in them; X'X
    is made block of items by block of items, and the sums of blocks of records are added up by pair.  A block takes
    in ENTRIES entries, over as many batches as that needs, so a pair is given out once for each block; a basket of any
    length is one record of it.  A limit above 0 also bounds the items that can matter: an item must itself
    reach min_share, so at most (mean basket size / min_share) items do; they are the only ones kept, and the
    only thing sent to all executors.  Without a limit, or where more than NAMED items reach it, no vocabulary is sent
    at all, and the limits are applied to the sums alone.
    """
    share, lift = Fraction(min_share), Fraction(min_lift)
    clean = baskets.select(F.array_distinct(F.filter(items, lambda x: x.isNotNull())).alias("t")).where(F.size("t") > 0)
    # one row of null for each basket counts the baskets in the same pass
    counts = settled(clean.select(F.explode(F.array_append("t", F.lit(None).cast("string"))).alias("item")).groupBy("item").agg(F.count("*").alias("n")))
    n = (counts.where("item is null").first() or [None, 0])[1]
    least = -(-n * share.numerator // share.denominator)  # of records, in whole numbers
    single = counts.where(F.col("item").isNotNull() & (F.col("n") >= F.lit(least)))
    kept = None
    if share > 0:
        names = [r[0] for r in single.select("item").limit(NAMED + 1).collect()]
        kept = pa.array(sorted(names), pa.string()) if len(names) <= NAMED else None

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        n_rows = n_entries = 0

        def made() -> Iterator[pa.RecordBatch]:
            values, rows = pa.chunked_array([v for v, _ in held], pa.string()).combine_chunks(), np.concatenate([r for _, r in held])
            names = kept if kept is not None else pc.unique(values).sort()
            ids = pc.index_in(values, value_set=names).to_numpy().astype(np.int64)
            for a, b, g in gram(rows, ids, len(names), min(WIDTH, len(names))):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(g)], names=["item_a", "item_b", "n_ab"])

        for batch in batches:
            values, owner = batch.column(0).flatten(), pc.list_parent_indices(batch.column(0))
            if kept is not None:
                there = pc.is_in(values, value_set=kept)
                values, owner = values.filter(there), owner.filter(there)
            if len(values):
                held.append((values, owner.to_numpy().astype(np.int64) + n_rows))
                n_rows, n_entries = n_rows + batch.num_rows, n_entries + len(values)
            if n_entries >= ENTRIES:
                yield from made()
                held, n_rows, n_entries = [], 0, 0
        if held:
            yield from made()

    pairs = clean.mapInArrow(blocks, "item_a string, item_b string, n_ab long").groupBy("item_a", "item_b").agg(F.sum("n_ab").alias("n_ab"))
    pairs = pairs.where(F.col("n_ab") >= F.lit(least))
    for x in ("a", "b"):
        pairs = pairs.join(single.select(F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")), f"item_{x}")
    # n_ab * n / (n_a * n_b) >= lift
    enough = _at_least(("n_ab", n * lift.denominator), ("n_a", "n_b", lift.numerator), n) if lift > 0 else F.lit(True)
    return pairs.where(enough).select("item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(n).cast("long").alias("n_baskets"), (F.col("n_ab") * F.lit(float(n)) / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"))
