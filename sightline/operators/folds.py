"""How rows of one key become one row, column by column.

Every law is an aggregate that partitions combine first (minimum, maximum, any, or the value at the greatest
or smallest place), so folding is associative: any division of the batches gives the same table, and a key
that holds most rows is no burden.  `seq` is the order of arrival of envelopes, `idx` that within one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.context import members, object_text
from sightline.session import settled

# Within an envelope, then across envelopes, by table. "last" and "first": of the rows in order, whole rows within an
# envelope; "keep": the last that isn't null.
LAWS: dict[str, dict[str, str]] = {
    "entity": {"first_seen": "min", "last_seen": "max"},
    "indicator": {"type": "last", "value": "last", "raw_value": "keep"},
    "cve": {"cve_id": "last", "summary": "keep", "cvss_score": "keep", "cvss_vector": "keep", "severity": "keep", "epss_score": "keep", "known_exploited": "any", "cwe": "keep", "published_at": "keep", "modified_at": "max", "refs": "keep"},
    "breach": {"slug": "last", "name": "last", "domain": "keep", "description": "keep", "breach_date": "keep", "disclosed_at": "keep", "record_count": "max", "data_classes": "keep", "verified": "any"},
}


def law(name: str, column: str, *order: str) -> Column:
    value = F.col(column)
    place = F.struct(*order)
    if name == "min":
        return F.min(value).alias(column)
    if name == "max":
        return F.max(value).alias(column)
    if name == "any":
        return F.max(F.coalesce(value, F.lit(False))).alias(column)
    if name == "last":
        return F.max(F.struct(place.alias("p"), value.alias("v")))["v"].alias(column)
    if name == "keep":
        return F.max(F.when(value.isNotNull(), F.struct(place.alias("p"), value.alias("v"))))["v"].alias(column)
    if name == "first":
        return F.min(F.struct(place.alias("p"), value.alias("v")))["v"].alias(column)
    if name == "first_set":
        return F.min(F.when(value.isNotNull(), F.struct(place.alias("p"), value.alias("v"))))["v"].alias(column)
    raise ValueError(name)


def last_row(df: DataFrame, keys: list[str], idx: str = "idx") -> DataFrame:
    """The last row of each key, whole: the law of module rows within one envelope."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(idx, *[c for c in rest if c != idx])).alias("r")).select(*keys, "r.*")


def first_row(df: DataFrame, keys: list[str], idx: str = "idx") -> DataFrame:
    """The first row of each key, whole: the law of lookup rows and of stubs within one envelope."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(idx, *[c for c in rest if c != idx])).alias("r")).select(*keys, "r.*")


def fold(df: DataFrame, keys: list[str], laws: Mapping[str, str], *order: str) -> DataFrame:
    """One row a key. Columns without a law are left out. Null keys form a group; an empty table gives no rows."""
    return df.groupBy(*keys).agg(*[law(n, c, *order) for c, n in laws.items()])


def fold_edges(df: DataFrame, keys: list[str]) -> DataFrame:
    """Edges in two steps. Within an envelope: the widest window, the first confidence that is set, and the metadata of
    the first edge only. Across envelopes: the widest window, the last confidence that is set, and metadata
    merged member by member, the last winning; from the second envelope on it is an object, be it empty.

    Members are merged as rows, so an edge that is reported any number of times is no burden.
    """
    within = settled(fold(df, [*keys, "seq"], {"first_seen": "min", "last_seen": "max", "confidence": "first_set", "metadata": "first"}, "idx"))
    rows = within.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), law("keep", "confidence", "seq"), F.count("*").alias("n_envelopes"), F.max("metadata").alias("only_"))
    single = within.select(*keys, "seq", F.explode(members(F.col("metadata"))).alias("m")).select(*keys, "seq", "m.k", "m.v")
    latest = single.groupBy(*keys, "k").agg(F.max(F.struct("seq", "v"))["v"].alias("v"))
    merged = latest.groupBy(*keys).agg(object_text(F.collect_list(F.struct("k", "v"))).alias("metadata"))
    metadata = F.when((F.col("n_envelopes") == 1) & F.col("only_").isNull(), None).otherwise(F.coalesce("metadata", F.lit("{}")))
    return rows.join(merged, keys, "left").withColumn("metadata", metadata).drop("only_", "n_envelopes")
