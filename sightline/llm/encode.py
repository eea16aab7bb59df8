"""Texts as token ids of a public byte-pair tokenizer, long texts by tree concatenation.

Why a join is exact.  Ids are the right ones of a text if (1) every place at which the pattern splits the text is
an edge of a token, and (2) of two neighbours that it doesn't split, merging the bytes of both gives the two again:
merges go by rank, so what never merges across the edge of any two neighbours never merges across it in a longer
run either.  A window around a join is encoded anew; where it has a token at the very place at which a side has the
same one, the side's ids up to that token and the window's from there on meet both conditions: each pair of
neighbours stands in one of the two, and the pattern, which doesn't look back, splits alike from there on.  It looks
ahead by at most three characters ('re, blanks before a word), so such a token counts only that far from the end of
what was read.  No split of the pattern is needed for that: a run of letters of any length is joined like prose.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import settled

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # ranks; the same vocabulary as byte_bpe_50k.json

# Fixed value: the pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LEAF = 8_192  # characters: what one step encodes; a longer text is a tree of such leaves
FAN = 64  # leaves, or nodes, that one task puts together
WINDOW = 32  # tokens on either side of a join, at first
AHEAD = 12  # bytes of three characters: how far the pattern looks ahead


class Encoder:
    """Texts to ids and back to bytes, by a file of ranks."""

    def __init__(self, path: str):
        import tiktoken

        if not os.path.exists(path):  # the package that holds the files may lie elsewhere on an executor
            import public_tokenizers

            path = public_tokenizers.path(os.path.basename(path))
        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            self.words[rank] = word
        self.sizes = np.array([len(x) for x in self.words], np.int64)
        self.opens = np.array([not x or x[0] & 0xC0 != 0x80 for x in self.words])  # begins at a character's first byte
        self.tiktoken = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def leaf(self, text: str) -> np.ndarray:
        return np.frombuffer(array("I", self.tiktoken.encode_ordinary(text)), np.uint32)

    def bytes(self, ids: np.ndarray) -> bytes:
        return b"".join([self.words[i] for i in ids.tolist()])

    def text(self, text: str, leaf: int = LEAF) -> np.ndarray:
        """The ids of a text of any length, leaf by leaf."""
        return self.leaf(text) if len(text) <= leaf else self.chain([self.leaf(text[i : i + leaf]) for i in range(0, len(text), leaf)])

    def chain(self, parts: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
        """The ids of neighbouring texts put together, from the ids of each.

        Each join changes only the end of what stands before it and the beginning of what comes behind, so the
        parts stay apart until all joins are made.
        """
        done: list[np.ndarray] = []
        for part in parts:
            while done and len(part):
                keep, between, drop = self.join(done[-1], part, window)
                if not keep and len(done) > 1:  # the window took in all of the part before: its own join is made again
                    part = np.concatenate([between, part[drop:]])
                    done.pop()
                    continue
                done[-1] = done[-1][:keep]
                part = np.concatenate([between, part[drop:]])
                break
            if len(part):
                done.append(part)
        return np.concatenate(done) if done else np.zeros(0, np.uint32)

    def join(self, a: np.ndarray, b: np.ndarray, window: int = WINDOW) -> tuple[int, np.ndarray, int]:
        """(n, ids, m): the ids of both texts together are a[:n], ids, b[m:].

        The window begins and ends at edges of tokens that are edges of characters, and grows on each side until that
        side agrees with it on a token, or is in it as a whole.
        """
        left = right = window
        while True:
            start, stop = max(len(a) - left, 0), min(right, len(b))
            while start and not self.opens[a[start]]:
                start -= 1
            while stop < len(b) and not self.opens[b[stop]]:
                stop += 1
            ids = self.text((self.bytes(a[start:]) + self.bytes(b[:stop])).decode("utf-8"))
            ends = np.cumsum(self.sizes[ids])
            begins = ends - self.sizes[ids]
            middle = int(self.sizes[a[start:]].sum())
            first, last = 0, len(ids)  # what of the window is used
            if start:
                own = np.cumsum(self.sizes[a[start:]])
                n, k = self._common(own - self.sizes[a[start:]], own, begins, ends, -1, middle - AHEAD)
                if n is None:
                    left *= 2
                    continue
                start, first = start + n, k
            if stop < len(b):
                own = middle + np.cumsum(self.sizes[b[:stop]])
                n, k = self._common(own - self.sizes[b[:stop]], own, begins, ends, middle - 1, int(ends[-1]) - AHEAD, last=True)
                if n is None:
                    right *= 2
                    continue
                stop, last = n, k
            return start, ids[first:last], stop

    @staticmethod
    def _common(begins_a: np.ndarray, ends_a: np.ndarray, begins_b: np.ndarray, ends_b: np.ndarray, above: int, upto: int, last: bool = False) -> tuple[int | None, int]:
        """The places in both lists of the first (the last) token that both have and that begins in (above, upto]."""
        both, i, j = np.intersect1d(begins_a, begins_b, assume_unique=True, return_indices=True)
        fit = np.flatnonzero((ends_a[i] == ends_b[j]) & (both > above) & (both <= upto))
        if not len(fit):
            return None, 0
        return (int(i[fit[-1]]), int(j[fit[-1]])) if last else (int(i[fit[0]]), int(j[fit[0]]))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int32) if found else np.zeros(0, np.int32)))


def _leaves(batch: pa.RecordBatch, leaf: int) -> Iterator[pa.RecordBatch]:
    """id, keep, piece, text: texts cut into leaves, at most FAN of them in a batch."""
    for row, text in enumerate(batch.column(2).to_pylist()):
        for i in range(0, len(text), FAN * leaf):
            some = [text[j : j + leaf] for j in range(i, min(i + FAN * leaf, len(text)), leaf)]
            same = pa.array([row] * len(some))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(same), batch.column(1).take(same), pa.array(range(i // leaf, i // leaf + len(some)), pa.int32()), pa.array(some)], names=["id", "keep", "piece", "text"])


def _together(leaves: DataFrame, base: str, path: str, only_sizes: bool) -> DataFrame:
    """id, keep and ids or n_ids, from id, keep, piece, text: leaves are encoded wherever they lie after a shuffle by
    (id, piece), put together by FAN, and what comes of that once more."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                node = pa.array(some.column(2).to_numpy() // FAN)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), node, some.column(2), _lists([own.leaf(x) for x in some.column(3).to_pylist()])], names=["id", "keep", "node", "piece", "ids"])

    def joined(by: str, out: str) -> Callable[[pa.Table], pa.Table]:
        def join(group: pa.Table) -> pa.Table:
            table = group.sort_by(by)
            ids = encoder(path).chain([np.array(x.values, np.uint32) for x in table.column("ids")])
            first = table.slice(0, 1)
            columns = {"id": first.column("id"), "keep": first.column("keep"), "node": first.column("node"), "ids": _lists([ids]), "n_ids": pa.array([len(ids)], pa.int64())}
            return pa.table({c: columns[c] for c in out.split()})

        return join

    result = ("n_ids", "n_ids long") if only_sizes else ("ids", "ids array<int>")
    coded = leaves.repartition("id", "piece").mapInArrow(encode, f"{base}, node int, piece int, ids array<int>")
    nodes = coded.groupBy("id", "node").applyInArrow(joined("piece", "id keep node ids"), f"{base}, node int, ids array<int>")
    return nodes.groupBy("id").applyInArrow(joined("node", f"id keep {result[0]}"), f"{base}, {result[1]}")


def _rows(df: DataFrame, row_id: str, text: str, keep: tuple[str, ...]) -> tuple[DataFrame, str]:
    rows = df.select(F.col(row_id).alias("id"), F.struct(F.lit(0).alias("none"), *keep).alias("keep"), F.col(text).alias("text"))
    return rows, f"id {rows.schema['id'].dataType.simpleString()}, keep {rows.schema['keep'].dataType.simpleString()}"


def encoded(df: DataFrame, row_id: str, text: str, path: str = TOKENIZER, leaf: int = LEAF) -> DataFrame:
    """row_id, ids: the token ids of each whole text, without special tokens. Null and empty texts have no ids: [].

    Texts of one leaf (up to `leaf` characters) are encoded where they lie, without a shuffle.  Longer ones are cut
    into leaves that are spread and encoded in parallel, then joined by `FAN` in a task, and these nodes once more: at
    a join only a window of some tokens is encoded anew, so no task encodes a long text again, whatever it is made of.
    Only a run of one repeated character or word, whose tokens all move when it begins elsewhere, has its part
    behind a join encoded anew as a whole, once at each of the two levels.

    The table is read once for each of the two: ids are not written to be read again.  row_id must be unique.  An
    empty table gives no rows; other columns are not read.
    """
    rows, base = _rows(df, row_id, text, ())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), _lists([own.leaf(x or "") for x in some.column(2).to_pylist()])], names=["id", "keep", "ids"])

    long = F.coalesce(F.length("text") > leaf, F.lit(False))
    split = rows.where(long).mapInArrow(lambda it: (x for b in it for x in _leaves(b, leaf)), f"{base}, piece int, text string")
    both = rows.where(~long).mapInArrow(whole, f"{base}, ids array<int>").unionByName(_together(split, base, path, only_sizes=False))
    return both.select(F.col("id").alias(row_id), "ids")


def sizes(df: DataFrame, row_id: str, text: str, path: str = TOKENIZER, leaf: int = LEAF, keep: tuple[str, ...] = ()) -> DataFrame:
    """row_id, the columns of `keep`, n_ids: how many ids `encoded` gives, without handing them over.

    One pass over the table: it gives the size of each text of one leaf, and the leaves of longer ones; both are
    written to the shared folder, from where only the leaves go on.
    """
    rows, base = _rows(df, row_id, text, keep)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        names = ["id", "keep", "piece", "text", "n_ids"]
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                texts = some.column(2).to_pylist()
                short = pa.array([len(x or "") <= leaf for x in texts], pa.bool_())
                found = [len(own.leaf(x or "")) for x in texts if len(x or "") <= leaf]
                n = len(found)
                mine = some.filter(short)
                yield pa.RecordBatch.from_arrays([mine.column(0), mine.column(1), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.array(found, pa.int64())], names=names)
                for x in _leaves(some.filter(pc.invert(short)), leaf):
                    yield pa.RecordBatch.from_arrays([*x.columns, pa.nulls(x.num_rows, pa.int64())], names=names)

    seen = settled(rows.mapInArrow(first, f"{base}, piece int, text string, n_ids long"))
    long = _together(seen.where("piece is not null").drop("n_ids"), base, path, only_sizes=True)
    both = seen.where("piece is null").select("id", "keep", "n_ids").unionByName(long)
    return both.select(F.col("id").alias(row_id), *[f"keep.{c}" for c in keep], "n_ids")
