"""The projection that answers "is this known?": one row for each type and value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.operators.build import entity_id
from sightline.operators.folds import first_row
from sightline.plans.schemas import LOOKUP_SOURCES, LOOKUP_TAGS, LOOKUP_TTL_DAYS
from sightline.session import settled


def last_distinct(rows: DataFrame, keys: list[str], value: str, most: int | Column, *order: str) -> DataFrame:
    """keys, values: each key's distinct values in the order in which they first came; if more than `most`, the last
    `most` of these. Nulls and '' don't count.

    Values are counted as rows and ranked in each key; no key's rows are gathered, only at most `most` values.
    """
    first = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("p"))
    late = first.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("p").desc()))).where(F.col("n") <= most)
    return late.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))), lambda x: x["v"]).alias("values"))


def fold_lookup(verdicts: DataFrame) -> DataFrame:
    """verdicts: seq, idx, type, value, first_seen, last_seen, source, tags, confidence.

    Of several in one envelope the first counts, whole. Across envelopes: the widest window, the highest confidence
    that is set, and the sources and tags, the last 32 and 64 of them once there is more than one envelope. If
    verdicts have refreshed_at, the time at which they were written, the latest is kept.
    """
    keys = ["type", "value"]
    rows = settled(first_row(verdicts, [*keys, "seq"]))  # read twice below
    fresh = [F.max("refreshed_at").alias("refreshed_at")] if "refreshed_at" in verdicts.columns else []
    out = rows.groupBy(*keys).agg(*fresh, F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("confidence").alias("confidence"), F.count("*").alias("n_envelopes"), F.max("tags").alias("only_"))
    # sources and tags are ranked in one pass, as what = 0 and 1
    marks = F.concat(F.array(F.struct(F.lit(0).alias("what"), F.col("source").alias("v"), F.lit(0).alias("i"))), F.transform("tags", lambda t, i: F.struct(F.lit(1).alias("what"), t.alias("v"), i.alias("i"))))
    each = rows.select(*keys, "seq", F.explode(marks).alias("m")).select(*keys, "seq", "m.what", "m.v", "m.i")
    kept = last_distinct(each, [*keys, "what"], "v", F.when(F.col("what") == 0, LOOKUP_SOURCES).otherwise(LOOKUP_TAGS), "seq", "i")
    lists = kept.groupBy(*keys).agg(*[F.flatten(F.collect_list(F.when(F.col("what") == i, F.col("values")))).alias(x) for i, x in enumerate(("sources", "last_tags"))])  # two rows a key
    none = F.array().cast("array<string>")
    merged = F.when(F.col("n_envelopes") == 1, F.col("only_")).otherwise(F.coalesce("last_tags", none))
    return out.join(lists, keys, "left").select(entity_id(F.lit("indicator"), F.col("value")).alias("entity_id"), *keys, "first_seen", "last_seen", F.coalesce("sources", none).alias("sources"), merged.alias("tags"), "confidence", *["refreshed_at"] * len(fresh))


def capped(values: Column, most: int) -> Column:
    """The last `most` of an array."""
    return F.when(F.size(values) > most, F.slice(values, F.size(values) - most + 1, F.lit(most))).otherwise(values)


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """The projection with what came since: both as `fold_lookup` gives them, `new` of later envelopes only.

    Where both have a row: the widest window, the highest confidence, the latest refresh, and the last 32 sources and
    64 tags of both lists, the old ones first. Of a source that had been pushed out of the old list nothing is known
    any more: if it comes again, it counts as new.
    """
    keys = ["type", "value"]
    rest = ["first_seen", "last_seen", "sources", "tags", "confidence", "refreshed_at"]
    a, b = (df.select(*keys, F.struct(*rest).alias(x)) for df, x in ((old, "a"), (new, "b")))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    list_ = lambda c, most: F.when(both, capped(F.filter(F.array_union(f"a.{c}", f"b.{c}"), lambda x: x != ""), most)).otherwise(F.coalesce(f"a.{c}", f"b.{c}")).alias(c)
    out = a.join(b, keys, "full")
    return out.select(
        entity_id(F.lit("indicator"), F.col("value")).alias("entity_id"), *keys, F.least("a.first_seen", "b.first_seen").alias("first_seen"), F.greatest("a.last_seen", "b.last_seen").alias("last_seen"),
        list_("sources", LOOKUP_SOURCES), list_("tags", LOOKUP_TAGS), F.greatest("a.confidence", "b.confidence").alias("confidence"), F.greatest("a.refreshed_at", "b.refreshed_at").alias("refreshed_at"),
    )


BUCKETS = 256  # folders of the stored projection: a point get reads one


def bucket(kind: Column, value: Column) -> Column:
    return F.pmod(F.xxhash64(kind, value), F.lit(BUCKETS)).cast("int")


def alive(lookup: DataFrame, now: Column, days: int = LOOKUP_TTL_DAYS) -> DataFrame:
    """The rows that were refreshed within the last `days`; any write refreshes a row."""
    return lookup.where(F.col("refreshed_at") + F.make_interval(days=F.lit(days)) > now)


def find(lookup: DataFrame, kind: str, value: str) -> DataFrame:
    """The row of one canonical value; none if it isn't known. Both predicates reach the scan."""
    return lookup.where((F.col("type") == kind) & (F.col("value") == value))
