"""One surviving record of each group of duplicates, chosen field by field, by currency reasoning.

Where rows have times, the latest usable value of a field is the current one.  Where some have none, the order in which
values follow each other is learned from the dated rows of all groups: a value precedes another if it is followed by it
more often than it follows it.  That order, cut down to the values that a group has, is the group's own partial
order, and a value that none of the group's others comes after is the current one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators.ranges import changes, placed
from sightline.session import settled

# Texts that stand for a missing text, as words in lower case without marks.
STAND_INS = (
    "na|n a|nan|nil|none|null|unknown|undefined|unspecified|empty|blank|missing|pending|placeholder|reserved|rejected|reject|withheld|redacted|todo|tbd|tba|tbc|test"
    "|to (?:be|follow)(?: (?:determined|announced|confirmed|defined|decided|added|provided|supplied|assigned|completed|published|updated|done|written|disclosed))?"
    "|(?:not|none) (?:yet )?(?:available|applicable|provided|specified|known|given|set|assigned|assessed|analyzed|analysed|disclosed|defined|published|supplied)(?: yet)?"
    "|(?:no|without|missing|empty|unknown) (?:description|summary|text|details?|information|info|data|content|value|comment)s?(?: (?:is|was|are))?(?: (?:available|provided|given|yet|known|found|supplied|specified|exists?|at this time|currently))*"
    "|(?:description|summary|details?|information|analysis|text|content) (?:is |to be |to |was |has been )?(?:pending|missing|unavailable|follow|reserved|withheld|empty|tbd|tba|na|n a|not (?:yet )?(?:available|provided|given))"
    "|(?:pending|awaiting|under|in|needs|undergoing) (?:further )?(?:analysis|review|description|summary|details?|information|publication|disclosure|assessment|enrichment|reanalysis|progress)"
    "|(?:coming|available|see) (?:soon|later)|see (?:reference|references|advisory|link|links|above|below|vendor advisory)|this candidate (?:has been|is) reserved.*|reserved cve|cve reserved|lorem ipsum.*"
)


def says_something(text: Column) -> Column:
    """Whether a text is more than null, blank or a stand-in for a missing text."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?<=\w)['’/](?=\w)", ""), r"[^\p{L}\p{N}]+", " "))
    return F.coalesce((words != "") & words.rlike(r"\p{L}") & ~words.rlike(rf"^(?:{STAND_INS})\z"), F.lit(False))


@dataclass(frozen=True)
class Field:
    """A value, whether it can be used, and the form in which it is compared: rows with one form have one value."""

    name: str
    value: Column
    usable: Column
    form: Column | None = None


BASE = 2 * 10**19  # above all 64-bit ids


def latest(at: Column, row_id: Column) -> Column:
    """An aggregate: the row_id of the greatest `at` (a whole number; if equal, the smallest row_id) as one number, so that
    it is kept up to date in place and no rows are sorted; `place` gives the row_id back."""
    return F.max(at.cast("decimal(19,0)") * _whole(BASE) - (row_id.cast("decimal(20,0)") + _whole(2**63 + 1)))


def place(code: Column) -> Column:
    return (_whole(BASE - 2**63 - 1) - F.pmod(code, _whole(BASE))).cast("long")


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def transitions(rows: DataFrame, n_fields: int) -> DataFrame:
    """field, a, b, n: how often value a is followed by another value b, over all keys' dated rows in order of time.

    rows: k, t, id and columns s0, s1, ... with each field's value as a 64-bit hash, null where unusable.  Rows are
    placed by (key, time), so a key may hold any share of them; pairs across partitions are made from two small
    rows a partition and field.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        head: dict[int, tuple] = {}
        tail: dict[int, tuple] = {}
        names = ["part", "field", "a", "b", "first", "last", "n"]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

        def out(f: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            none = [None] * len(a)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((none, [f] * len(a), a, b, none, none, n), kinds)], names=names)

        for batch in batches:
            for f in range(n_fields):
                states = batch.column(3 + f)
                there = states.is_valid()
                s, k = states.filter(there).to_numpy(), batch.column(0).filter(there)
                if not len(s):
                    continue
                same = ~changes(k)
                same[1:] &= s[1:] != s[:-1]
                i = np.flatnonzero(same[1:]) + 1
                pairs, n = np.unique(np.stack([s[i - 1], s[i]], 1), axis=0, return_counts=True)
                yield out(f, pairs[:, 0], pairs[:, 1], n)
                first, last = (k[0].as_py(), s[0]), (k[len(s) - 1].as_py(), s[-1])
                if f in tail and tail[f][0] == first[0] and tail[f][1] != first[1]:
                    yield out(f, np.array([tail[f][1]]), np.array([first[1]]), np.array([1]))
                head.setdefault(f, first)
                tail[f] = last
        ends = [(part, f, head[f][1], tail[f][1], head[f][0], tail[f][0], 0) for f in head]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*ends)) or [()] * 7, kinds)], names=names)

    kinds = "part int, field int, a long, b long, first string, last string, n long"
    seen = placed(rows.withColumn("k", F.col("k").cast("string")), "k", "t", "id").mapInArrow(count, kinds)
    seen = settled(seen.groupBy("part", "field", "a", "b", "first", "last").agg(F.sum("n").alias("n")))
    across, before = [], {}
    for r in sorted(seen.where("part is not null").collect(), key=lambda r: r["part"]):  # one row a partition and field
        held = before.get(r["field"])
        if held is not None and held[0] == r["first"] and held[1] != r["a"]:
            across.append((r["field"], held[1], r["a"], 1))
        before[r["field"]] = r["last"], r["b"]
    more = rows.sparkSession.createDataFrame(across, "field int, a long, b long, n long")
    return seen.where("part is null").select("field", "a", "b", "n").unionByName(more)


def precedence(found: DataFrame) -> DataFrame:
    """field, a, b: a precedes b, as it is followed by b more often than it follows b. found: `transitions`."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    net = found.groupBy("field", low.alias("x"), high.alias("y")).agg(F.sum(F.when(F.col("a") == low, F.col("n")).otherwise(-F.col("n"))).alias("net")).where("net <> 0")
    ahead = F.col("net") > 0
    return net.select("field", F.when(ahead, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(ahead, F.col("y")).otherwise(F.col("x")).alias("b"))


def survivors(df: DataFrame, key: str, at: str, row_id: str, fields: list[Field], weigh: bool = False, values: bool = True) -> DataFrame:
    """Per key: n_rows, and for each field <name>_<row_id> of the row whose value is the best, and <name> (the value;
    left out without `values`).

    The best is the usable value of the latest `at`; if equal, of the smallest row_id.  Usable values of rows without a
    time are compared by the learned order (see above): where no usable value of the key has a time, or, with
    `weigh`, also against the one that is latest by its time.  Of the values that none of the key's others comes after,
    the dated one is taken, else that of the smallest row_id; if they go round in a circle, so of all.  Without `weigh`
    a time goes before what is only learned.  A field without a usable value is null.  Rows with a null key are left
    out; repeated rows change nothing; an empty table gives no rows.  `at` is a timestamp or a whole number, row_id a
    whole number, unique within its key.

    All choices by time are maxima, so each partition combines its own rows first, whatever share a key holds.  Values
    are compared by joins with the learned order, never with each other; the order is learned only if there is a
    usable value without a time.
    """
    kind = df.schema[at].dataType
    moment = F.unix_micros(F.col(at).cast("timestamp")) if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType) else F.col(at).cast("long")
    forms = [F.when(f.usable, F.xxhash64((f.value if f.form is None else f.form).cast("string"))).alias(f"s{i}") for i, f in enumerate(fields)]
    held = [F.when(f.usable, f.value).alias(f"v{i}") for i, f in enumerate(fields)] if values else []
    shaped = lambda part: part.select(F.col(key).alias("k"), moment.alias("t"), F.col(row_id).cast("long").alias("id"), *forms, *held).where("k is not null")
    rows = shaped(df)
    places = range(len(fields))
    dated = [latest(F.when(F.col(f"s{i}").isNotNull(), F.col("t")), F.col("id")).alias(f"c{i}") for i in places]
    best = rows.groupBy("k").agg(F.count("*").alias("n_rows"), *dated).select("k", "n_rows", *[place(F.col(f"c{i}")).alias(f"id{i}") for i in places])

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"s{i}").alias("s")) for i in places])).alias("x")
    bare = shaped(df.where(F.col(at).isNull())).select("k", "id", each).select("k", "x.field", "x.s", "id").where("s is not null")
    if not bare.isEmpty():
        best = settled(best)
        order = precedence(transitions(rows.where("t is not null").select("k", "t", "id", *[f"s{i}" for i in places]), len(fields)))
        bare = settled(bare.groupBy("k", "field", "s").agg(F.min("id").alias("id")))
        chosen = best.select("k", F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"id{i}").alias("id")) for i in places])).alias("x")).select("k", "x.field", "x.id").where("id is not null")
        if weigh:
            timed = rows.where("t is not null").select("k", "id", each).select("k", "x.field", "id", "x.s").where("s is not null").distinct()
            timed = chosen.join(bare.select("k", "field").distinct(), ["k", "field"], "left_semi").join(timed, ["k", "field", "id"]).select("k", "field", "s", "id")
            both = bare.withColumn("late", F.lit(1)).unionByName(timed.withColumn("late", F.lit(0)))
            bare = settled(both.groupBy("k", "field", "s").agg(F.min(F.struct("late", "id")).alias("r")).select("k", "field", "s", "r.late", "r.id"))
        else:
            bare = settled(bare.join(chosen, ["k", "field"], "left_anti").withColumn("late", F.lit(1)))
        # what another value of its own key comes after
        passed = bare.select("k", "field", F.col("s").alias("a")).join(order, ["field", "a"]).select("k", "field", "a", F.col("b").alias("s"))
        passed = passed.join(bare.select("k", "field", "s"), ["k", "field", "s"], "left_semi").select("k", "field", F.col("a").alias("s")).distinct().withColumn("passed", F.lit(1))
        last = bare.join(passed, ["k", "field", "s"], "left").groupBy("k", "field").agg(F.min(F.struct(F.coalesce("passed", F.lit(0)).alias("passed"), "late", "id")).alias("r"))
        ids = last.groupBy("k").agg(*[F.max(F.when(F.col("field") == i, F.col("r.id"))).alias(f"u{i}") for i in places])
        best = best.join(ids, "k", "left").select("k", "n_rows", *[F.coalesce(f"u{i}", f"id{i}").alias(f"id{i}") for i in places])

    out = best
    if values:
        best = settled(best)
        won = best.select("k", F.explode(F.array_distinct(F.array(*[f"id{i}" for i in places]))).alias("id"), *[f"id{i}" for i in places]).where("id is not null")
        found = rows.select("k", "id", *[f"v{i}" for i in places]).join(won, ["k", "id"])
        out = best.join(found.groupBy("k").agg(*[F.max(F.when(F.col("id") == F.col(f"id{i}"), F.col(f"v{i}"))).alias(f"v{i}") for i in places]), "k", "left")
    return out.select(F.col("k").alias(key), "n_rows", *[c for i, f in enumerate(fields) for c in (F.col(f"id{i}").alias(f"{f.name}_{row_id}"), *[F.col(f"v{i}").alias(f.name)] * values)])
