"""The raw archive: payloads under the hash of their content, written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import files


def content_hash(payload: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(payload, 256))


def key(content: Column) -> Column:
    """raw/sha256/ab/cd/<hex> of a content hash; null if it is none."""
    digest = F.when(content.rlike(r"^sha256:[0-9a-f]{64}\z"), content.substr(8, 64))
    return F.concat_ws("/", F.when(digest.isNotNull(), F.lit("raw/sha256")), digest.substr(1, 2), digest.substr(3, 2), digest).substr(F.lit(1), F.when(digest.isNotNull(), F.lit(200)))


def safe(ref: Column) -> Column:
    """Whether a reference may be read: relative, with no way up."""
    return F.coalesce(~ref.startswith("/") & ~ref.rlike(r"(?:^|/)\.\.(?:/|\z)") & (ref != ""), F.lit(False))


def payload(raw: Column) -> Column:
    """The bytes of an inline payload struct(media_type, encoding, data); null if they can't be decoded."""
    return F.when(raw["encoding"] == "base64", F.try_to_binary(raw["data"], F.lit("base64"))).otherwise(F.encode(raw["data"], "utf-8"))


def media_type(raw: Column) -> Column:
    return F.coalesce(F.nullif(raw["media_type"], F.lit("")), F.lit("application/octet-stream"))


def first_copies(payloads: DataFrame, row_id: str) -> DataFrame:
    """payloads (content_hash, ...) with the smallest row_id of each content."""
    return payloads.where("content_hash is not null").groupBy("content_hash").agg(F.min(row_id).alias(row_id), F.count("*").alias("n_copies"))


def put(spark: SparkSession, root: str, payloads: DataFrame) -> None:
    """Append the payloads (content_hash, media_type, body) whose content isn't there yet, by the first two digits."""
    rows = payloads.where("content_hash is not null").groupBy("content_hash").agg(F.min(F.struct("media_type", "body")).alias("r")).select("content_hash", "r.*")
    rows = rows.withColumn("part", F.col("content_hash").substr(8, 2))
    fs, where = files(spark, root)
    if fs.exists(where):
        held = spark.read.schema("content_hash string, media_type string, body binary, part string").parquet(root)
        rows = rows.join(held.select("content_hash", "part"), ["content_hash", "part"], "left_anti")
    rows.write.mode("append").partitionBy("part").parquet(root)


def get(spark: SparkSession, root: str, content: str) -> DataFrame:
    """The payload with this content hash: one partition is read; no row if it isn't there."""
    return spark.read.parquet(root).where((F.col("part") == content[7:9]) & (F.col("content_hash") == content))
