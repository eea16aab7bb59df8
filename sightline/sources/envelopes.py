"""Envelopes: files of one JSON document each, their digest, strict decoding, and their records as rows."""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.plans.schemas import ENVELOPE

TIMES = {"collected_at", "first_seen", "last_seen", "observed_at", "published_at", "modified_at", "disclosed_at"}
FREE = {"attributes": dict, "metadata": dict, "refs": list}
RFC3339 = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})")
DECODED = T.StructType([T.StructField("doc", T.StringType()), T.StructField("problem", T.StringType())])


def read(spark: SparkSession, path: str) -> DataFrame:
    """path, modified, body: whole files; of the path '-', what comes in on standard input."""
    if path == "-":
        rows = [("-", bytearray(sys.stdin.buffer.read()))]
        return spark.createDataFrame(rows, "path string, body binary").select("path", F.current_timestamp().alias("modified"), "body")
    return spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("modified"), F.col("content").alias("body"))


def digest(body: Column) -> Column:
    """The key by which a delivery is known: SHA-256 of its exact bytes, in hex."""
    return F.sha2(body, 256)


def source_of(body: Column) -> Column:
    """The source that even a malformed document may name; null if it doesn't."""
    return F.nullif(F.get_json_object(body.cast("string"), "$.source"), F.lit(""))


def _shape(kind: T.DataType):
    if isinstance(kind, T.StructType):
        return {f.name: _shape(f.dataType) for f in kind}
    return [_shape(kind.elementType)] if isinstance(kind, T.ArrayType) else kind.typeName()


def _checked(value, shape, path: str, name: str):
    """The value in the given shape, its names in their proper case and others left out; raises ValueError."""
    if value is None:
        return None
    if name in FREE:
        if not isinstance(value, FREE[name]) or (name == "refs" and not all(isinstance(x, dict) for x in value)):
            raise ValueError(f"{path}: wrong type")
        return value
    if isinstance(shape, dict):
        if not isinstance(value, dict):
            raise ValueError(f"{path}: an object is wanted")
        names = {k.lower(): k for k in shape}
        return {names[k.lower()]: _checked(v, shape[names[k.lower()]], f"{path}.{k}".lstrip("."), names[k.lower()]) for k, v in value.items() if k.lower() in names}
    if isinstance(shape, list):
        if not isinstance(value, list):
            raise ValueError(f"{path}: an array is wanted")
        return [_checked(x, shape[0], f"{path}[{i}]", "") for i, x in enumerate(value)]
    wanted = {"string": str, "double": (int, float), "long": int, "boolean": bool}[shape]
    if not isinstance(value, wanted) or (isinstance(value, bool) and shape != "boolean"):
        raise ValueError(f"{path}: {shape} is wanted")
    if name in TIMES and not RFC3339.fullmatch(value):
        raise ValueError(f"{path}: no RFC 3339 time")
    if name == "breach_date" and value and not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        raise ValueError(f"{path}: no date")
    return value


def _refused(text: str):
    raise ValueError(f"{text} is no JSON number")


def decoder() -> Column:
    """A UDF: bytes to (doc: normal JSON, problem). One call a file, not a record: Spark's own parser is lenient where
    a whole document has to be refused (rubbish behind it, wrong types)."""
    shape = _shape(T._parse_datatype_string(ENVELOPE))

    @F.pandas_udf(DECODED)
    def decode(body: pd.Series) -> pd.DataFrame:
        out = []
        for b in body:
            try:
                out.append((json.dumps(_checked(json.loads(bytes(b).decode("utf-8"), parse_constant=_refused), shape, "", ""), ensure_ascii=False), None))
            except (ValueError, RecursionError) as e:
                out.append((None, f"decode: {e}"[:500]))
        return pd.DataFrame(out, columns=["doc", "problem"])

    return decode


def decoded(files: DataFrame) -> DataFrame:
    """files (path, modified, body) with digest, e (the envelope; null if refused) and problem. Empty files are left out."""
    rows = files.where(F.length("body") > 0).withColumn("digest", digest(F.col("body"))).withColumn("d", decoder()(F.col("body")))
    return rows.withColumn("e", F.from_json("d.doc", ENVELOPE)).withColumn("problem", F.col("d.problem")).drop("d")


def records(envelopes: DataFrame) -> DataFrame:
    """One row a record of envelopes (seq, digest, e): its place, what it holds, and what it takes from its envelope."""
    rows = envelopes.select("seq", "digest", "e", F.posexplode("e.records").alias("idx", "r"))
    return rows.select("seq", "digest", "idx", F.col("e.source").alias("source"), "r.kind", "r.observed_at", F.col("e.collected_at").alias("collected_at"), "r.context", F.col("e.default_context").alias("default_context"), "r.indicator", "r.cve", "r.breach", F.col("e.content_hash").alias("content_hash"), F.col("e.raw_ref").alias("raw_ref"))


def relationships(envelopes: DataFrame) -> DataFrame:
    """One row an edge of envelopes (seq, digest, e)."""
    rows = envelopes.select("seq", "digest", "e", F.posexplode("e.relationships").alias("idx", "r"))
    return rows.select("seq", "digest", "idx", F.col("e.source").alias("feed"), F.col("e.collected_at").alias("collected_at"), "r.source", "r.target", "r.type", "r.confidence", "r.first_seen", "r.last_seen", "r.metadata")
