"""What could not be taken in, kept with the reason."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.plans.schemas import MAX_REASON


def is_json() -> Column:
    """A UDF: whether a text is one JSON document, strictly. Spark's own functions let rubbish behind it pass."""

    def refuse(_: str):
        raise ValueError

    @F.pandas_udf("boolean")
    def check(text: pd.Series) -> pd.Series:
        def ok(x: str | None) -> bool:
            try:
                json.loads(x, parse_constant=refuse)
            except (ValueError, TypeError, RecursionError):
                return False
            return True

        return text.map(ok)

    return check


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("x")))  # {"x":"..."}
    return whole.substr(F.lit(6), F.length(whole) - 6)


def payload(text: Column) -> Column:
    """The text if it is JSON, else the text as a JSON string, so that the evidence stays as it came."""
    return F.when(is_json()(text), text).otherwise(quoted(F.coalesce(text, F.lit(""))))


def cut(reason: Column, most: int = MAX_REASON) -> Column:
    """A text of at most `most` bytes, and a note if there was more; a character that is cut through is left out."""
    start = F.rtrim(F.make_valid_utf8(F.substring(F.encode(reason, "utf-8"), 1, most).cast("string")), F.lit("\ufffd"))
    return F.when(F.octet_length(reason) > most, F.concat(start, F.lit("… (truncated)"))).otherwise(reason)


def rows(failed: DataFrame) -> DataFrame:
    """failed: source, message_id, stage, reason, body (text), failed_at."""
    return failed.select(F.nullif("source", F.lit("")).alias("source_slug"), F.nullif("message_id", F.lit("")).alias("message_id"), "stage", cut(F.col("reason")).alias("reason"), payload(F.col("body")).alias("payload"), "failed_at")
