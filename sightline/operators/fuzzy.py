"""Texts that are alike by their trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRIES = 2_000_000  # trigrams of the texts of one block, about
SMALL = 200_000  # blocks of fewer aren't worth the queries' way to them
CHARACTERS = 1_000_000  # of queries, or of texts, that are read at once; a longer text alone
PAIRS = 200_000  # that are given out at once, or those of one query with one block
COMMON = 64  # trigrams of a block that are kept as the bits of one number for each text


def padded(text: str):
    """The words of a text in lower case, with two blanks before and one behind each, and a line's end after each."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(words != "", F.concat(F.lit("  "), F.replace(words, F.lit(" "), F.lit(" \n  ")), F.lit(" \n"))).otherwise("")


def grams(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of each of `padded` texts, as the text's place and a number made of the three characters."""
    length = pc.utf8_length(lines).to_numpy(zero_copy_only=False)
    x = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = x == ord("\n")
    whole = ~(end[:-2] | end[1:-1] | end[2:])
    key = (x[:-2] << 42 | x[1:-1] << 21 | x[2:])[whole]
    row = np.repeat(np.arange(len(lines)), length)[:-2][whole]
    names, which = np.unique(key, return_inverse=True)
    row, which = np.divmod(np.unique(row * max(len(names), 1) + which), max(len(names), 1))
    return row, names[which]


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most CHARACTERS, or of one text."""
    total = np.cumsum(pc.binary_length(batch.column("lines")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + CHARACTERS, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


class Block:
    """The texts of a block in order of size, and for each trigram, the most frequent first, the places of the texts that
    have it."""

    def __init__(self, texts: list[pa.Array], entries: list[tuple[np.ndarray, np.ndarray]]):
        n = sum(map(len, texts))
        begin = np.cumsum([0, *map(len, texts)])
        row = np.concatenate([r + b for (r, _), b in zip(entries, begin)])
        self.names, which, df = np.unique(np.concatenate([k for _, k in entries]), return_inverse=True, return_counts=True)
        size = np.bincount(row, minlength=n)
        order = np.argsort(size, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.sizes, self.runs = np.unique(size, return_counts=True)
        self.size, self.text = size[order], pa.concat_arrays(texts).take(pa.array(order))
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
        self.cells = np.sort(self.rank[which] * n + place[row])  # (trigram, text) as one number
        self.texts = self.cells % n
        self.bits = np.zeros(n, np.uint64)
        for k in range(min(COMMON, len(df))):
            lo, hi = np.searchsorted(self.cells, (k * n, (k + 1) * n))
            self.bits[self.texts[lo:hi]] |= np.uint64(1 << k)

    def alike(self, lines: pa.Array, t: Fraction) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each query its place, the places of the texts that are alike, and their similarity.

        Texts of a size that can reach t are counted by the query's trigrams, without the block's most common ones; of
        those that could still have enough if they had all of the common ones that the query has, the bits tell.
        """
        n = len(self.text)
        row, key = grams(lines)
        at = np.minimum(np.searchsorted(self.names, key), len(self.names) - 1)
        known = self.names[at] == key
        sizes = np.bincount(row, minlength=len(lines))
        row, rank = row[known], self.rank[at[known]]
        order = np.lexsort((rank, row))
        row, rank = row[order], rank[order]
        low = np.searchsorted(self.size, -(-sizes * t.numerator // t.denominator))
        high = np.searchsorted(self.size, sizes * t.denominator // t.numerator, "right")
        begin, end = self.place(rank * n + low[row]), self.place(rank * n + high[row])
        common = rank < COMMON  # of each query, these come first
        bits = np.zeros(len(lines), np.uint64)
        np.bitwise_or.at(bits, row[common], np.uint64(1) << rank[common].astype(np.uint64))
        n_common = np.bincount(row[common], minlength=len(lines))
        first = np.searchsorted(row, np.arange(len(lines) + 1)).tolist()
        last = (-1, -1)
        for q in np.lexsort((n_common, sizes)).tolist():
            size, k, a, z, lo, hi = int(sizes[q]), int(n_common[q]), first[q], first[q + 1], int(low[q]), int(high[q])
            if a == z or lo >= hi:
                continue
            kind = np.uint8 if size < 256 else np.int64  # no count is above the query's size
            if last != (size, k):  # the trigrams that a text must share, besides common ones
                runs = slice(*np.searchsorted(self.sizes, self.size[[lo, hi - 1]]) + (0, 1))
                least = -(-(size + self.sizes[runs]) * t.numerator // (t.numerator + t.denominator))
                rest, last = np.repeat(np.maximum(least - k, 0).astype(kind), self.runs[runs]), (size, k)
            if z > a + k:
                seen = np.bincount(np.concatenate([self.texts[x:y] for x, y in zip(begin[a + k : z], end[a + k : z])]) - lo, minlength=hi - lo)
                near = np.flatnonzero(seen.astype(kind) >= rest)
                both = seen[near]
            else:
                near = np.flatnonzero(rest == 0)
                both = np.zeros(len(near), np.int64)
            both = both + np.bitwise_count(self.bits[lo + near] & bits[q])
            near = near + lo
            enough = both * (t.numerator + t.denominator) >= (size + self.size[near]) * t.numerator
            if enough.any():
                near, both = near[enough], both[enough]
                yield q, near, both / (size + self.size[near] - both)

    def place(self, cells: np.ndarray) -> list[int]:
        order = np.argsort(cells)  # near each other they are found faster
        at = np.empty(len(cells), np.int64)
        at[order] = np.searchsorted(self.cells, cells[order])
        return at.tolist()


def similar(queries: DataFrame, texts: DataFrame, least: str = "0.5") -> DataFrame:
    """query, text, similarity (trigrams in common / trigrams in either) of each pair of distinct texts with at least
    `least`, which is over 0; both tables have a column text. Equal texts are not paired.

    Exact. The texts lie in blocks by their hash, each of about ENTRIES trigrams; the queries are sent to all of them, and
    pass each block's index as a stream. So no pair moves that isn't in the result, and neither memory nor what is sent
    depends on how many texts have a trigram.
    """
    t = Fraction(least)
    if t <= 0:
        raise ValueError("least must be over 0")
    spark = texts.sparkSession
    q, x = (df.select("text").where("text is not null").distinct() for df in (queries, texts))
    total = x.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(max(-(-total // ENTRIES), min(2 * spark.sparkContext.defaultParallelism, -(-total // SMALL)), 1))
    x = x.select("text", F.lit(False).alias("asked"), F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int").alias("block"))
    q = q.select("text", F.lit(True).alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    rows = x.unionByName(q).repartitionById(blocks, "block").sortWithinPartitions("asked").select("text", "asked", padded("text").alias("lines")).where("lines <> ''")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        entries: list[tuple[np.ndarray, np.ndarray]] = []
        block: Block | None = None
        for part in (p for batch in batches for p in parts(batch)):
            n = part.num_rows - (part.column("asked").true_count)  # texts come before queries
            if n:
                held.append(part.column("text").slice(0, n))
                entries.append(grams(part.column("lines").slice(0, n)))
            if n == part.num_rows or not held:
                continue
            block = block or Block(held, entries)
            entries.clear()
            asked, lines = part.column("text").slice(n), part.column("lines").slice(n)
            found, count = [], 0
            for one in block.alike(lines, t):
                found.append(one)
                count += len(one[1])
                if count >= PAIRS:
                    yield given(block, asked, found)
                    found, count = [], 0
            if found:
                yield given(block, asked, found)

    def given(block: Block, asked: pa.Array, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        query = asked.take(pa.array(np.repeat([i for i, _, _ in found], [len(x) for _, x, _ in found])))
        text = block.text.take(pa.array(np.concatenate([x for _, x, _ in found])))
        out = pa.RecordBatch.from_arrays([query, text, pa.array(np.concatenate([s for _, _, s in found]))], names=["query", "text", "similarity"])
        return out.filter(pc.not_equal(query, text))

    return rows.mapInArrow(search, "query string, text string, similarity double")
