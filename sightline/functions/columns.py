"""Canonical forms as Spark columns.

Ordinary ASCII spellings are handled by built-in expressions, so they stay in generated code.  What those
cannot decide (other scripts, IPv6, networks of it, unusual URLs, malformed values) goes to `scalar.py` in
Arrow batches; rows that need no such help are sent as null and cost next to nothing there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions import scalar

NAME = r"(?:[a-z0-9_](?:[a-z0-9_]|-(?!-))*(?<!-)\.)+[a-z_](?:[a-z0-9_]|-(?!-))*(?<!-)"  # labels without hyphens at an end or in a row; the last is no number
HOST_PORT = rf"({NAME})(?::([0-9]*))?"
PATH = r"((?:/(?!/|\.)[a-zA-Z0-9_.~$&+,:;=@!'()*-]*)*)"
QUERY = r"(?:\?([^#%\x00-\x1F\x7F]*))?"
LINK = rf"^(?:([a-zA-Z][a-zA-Z0-9+.-]*)://)?(?i:{HOST_PORT}){PATH}{QUERY}(?:#[^%]*)?\z"
RESULT = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())])


def trim_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(scalar.BLANKS))


def lower_trimmed(c: Column) -> Column:
    """Lower case without surrounding blanks; null if nothing is left."""
    return F.nullif(F.lower(trim_blanks(c)), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def defang(c: Column) -> Column:
    """Undo the spellings by which values are disarmed; null for null."""
    v = F.btrim(trim_blanks(c), F.lit(scalar.QUOTES))
    v = F.regexp_replace(v, r"(?i)^(?:h(?:xxp|xtp|\*\*p)|htxp)s(?=[\[({]?:)", "https")
    v = F.regexp_replace(v, r"(?i)^(?:h(?:xxp|xtp|\*\*p)|htxp)(?=[\[({]?:)", "http")
    v = F.regexp_replace(v, r"(?i)^fxp(?=[\[({]?:)", "ftp")
    plain = v
    for pattern, to in scalar.DISARMED:
        flag = "(?i)" if pattern.flags & 2 else ""
        plain = F.regexp_replace(plain, flag + pattern.pattern, to)
    return trim_blanks(F.when(v.rlike(r"[\[({\\]"), plain).otherwise(v))


@F.pandas_udf(RESULT)
def _rest(kind: pd.Series, raw: pd.Series) -> pd.DataFrame:
    memo: dict = {}
    form, value = np.full(len(raw), None, object), np.full(len(raw), None, object)
    for i in np.flatnonzero(raw.notna().to_numpy()):  # few: what built-in expressions leave
        pair = kind.iat[i], raw.iat[i]
        if pair not in memo:
            memo[pair] = scalar.observable(*pair) or (None, None)
        form[i], value[i] = memo[pair]
    return pd.DataFrame({"type": form, "value": value})


# It is deterministic; saying otherwise keeps filters on its result from being rewritten into filters on the rules, which
# would run all of them twice. As other filters don't pass it either, callers filter first.
_rest = _rest.asNondeterministic()


def with_observable(df: DataFrame, name: str, kind: Column, raw: Column) -> DataFrame:
    """df with `name`: struct(type, value) in canonical form, both null where there is none.

    It is built in steps, each a projection of its own, so that no expression is written out twice.
    """
    k, v, low, parts, fast, ask = (f"{name}_{x}_" for x in ("kind", "v", "low", "parts", "fast", "ask"))
    df = df.withColumns({k: F.coalesce(F.nullif(kind, F.lit("")), F.lit("auto")), f"{name}_raw_": raw, v: defang(raw)}).withColumn(low, F.lower(v))
    df = df.withColumn(parts, _link(F.col(k), F.col(v)))
    df = df.withColumn(fast, _fast(F.col(k), F.col(v), F.col(low), F.col(parts)))
    df = df.withColumn(ask, F.coalesce(F.col(fast)["value"].isNull() & (F.col(v) != ""), F.lit(False)))
    df = df.withColumn(name, _rest(F.when(F.col(ask), F.col(k)), F.when(F.col(ask), F.col(f"{name}_raw_"))))
    return df.withColumn(name, F.when(F.col(ask), F.col(name)).otherwise(F.col(fast))).drop(k, v, low, parts, fast, ask, f"{name}_raw_")


def _link(declared: Column, v: Column) -> Column:
    """[scheme, host, port, path, query] of an ordinary URL, from one match; null of anything else. A value whose type is
    to be inferred is one only with a scheme, or with a slash and without an at sign."""
    maybe = (declared == "url") | ((declared == "auto") & (v.contains("://") | (v.contains("/") & ~v.contains("@"))))
    parts = F.split(F.regexp_replace(v, LINK, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    return F.when(maybe & ~v.contains("\x01"), F.when(F.size(parts) == 5, parts))


def _fast(declared: Column, v: Column, low: Column, parts: Column) -> Column:
    """struct(type, value) of ordinary spellings, null for all others."""
    auto = declared == "auto"
    size = F.length(v)
    by_size = F.when(size == 32, "md5").when(size == 40, "sha1").when(size == 64, "sha256").when(size == 128, "sha512")
    mail = rf"^[a-z0-9._+-]+@{NAME}\.?\z"
    made = lambda t, x: F.struct((F.lit(t) if isinstance(t, str) else t).alias("type"), x.alias("value"))
    dotless = F.regexp_replace(low, r"\.\z", "")
    named = F.length(low) <= 253
    labels = ~low.rlike(r"[a-z0-9_-]{64}")

    scheme = F.when(parts[0] == "", "http").otherwise(F.lower(parts[0]))
    default = F.create_map(*[F.lit(x) for kv in scalar.DEFAULT_PORT.items() for x in kv])
    url = F.concat(
        scheme, F.lit("://"), F.lower(parts[1]),
        F.when((parts[2] == "") | F.coalesce(default[scheme] == parts[2], F.lit(False)), "").otherwise(F.concat(F.lit(":"), parts[2])),
        F.when(parts[3] == "", "/").otherwise(parts[3]), F.when(parts[4] == "", "").otherwise(F.concat(F.lit("?"), parts[4])),
    )

    fast = F.when(auto & by_size.isNotNull() & low.rlike(r"^[0-9a-f]+\z"), made(by_size, low))
    for algorithm, n in scalar.HEX_LENGTH.items():
        digits = F.regexp_replace(low, f"^{algorithm}:", "")
        fast = fast.when((declared == algorithm) & digits.rlike(rf"^[0-9a-f]{{{n}}}\z"), made(algorithm, digits))
    return (
        fast.when(parts.isNotNull(), made("url", url))
        .when(declared.isin("auto", "ipv4") & v.rlike(rf"^{scalar.OCTET}(?:\.{scalar.OCTET}){{3}}\z"), made("ipv4", v))
        .when(declared.isin("auto", "domain") & named & low.rlike(rf"^{NAME}\.?\z") & labels, made("domain", dotless))
        .when(declared.isin("auto", "email") & named & low.rlike(mail) & labels, made("email", dotless))
    )


def cve_id(c: Column) -> Column:
    v = F.upper(trim_blanks(c))
    pattern = r"^CVE-([0-9]{4})-([0-9]{4,})\z"
    digits = F.regexp_replace(F.regexp_extract(v, pattern, 2), "^0+", "")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return F.when(v.rlike(pattern), F.concat(F.lit("CVE-"), F.regexp_extract(v, pattern, 1), F.lit("-"), padded))


def slugify(c: Column) -> Column:
    marked = "".join(scalar.PLAIN_LETTERS.values())
    plain = "".join(k * len(x) for k, x in scalar.PLAIN_LETTERS.items())
    v = F.translate(F.lower(trim_blanks(c)), marked, plain)
    v = F.regexp_replace(F.regexp_replace(v, r"[^\x00-\x7F]", ""), "[^a-z0-9]+", "-")
    ends = "^-+|-+$"
    return F.coalesce(F.regexp_replace(F.substring(F.regexp_replace(v, ends, ""), 1, 200), ends, ""), F.lit(""))


def breach_slug(slug: Column, name: Column, breach_year: Column, disclosed_year: Column) -> Column:
    """The given slug, else name and year; null if neither has a letter or digit."""
    base, year = slugify(name), F.coalesce(breach_year, disclosed_year)
    made = F.when(year.isNull(), base).otherwise(F.concat_ws("-", base, year.cast("string")))
    return F.when(slugify(slug) != "", slugify(slug)).when(base != "", made)


def with_endpoint_key(df: DataFrame, name: str, end: str) -> DataFrame:
    """df with <name>_kind, <name>_key and <name>_type: how an edge names its end (struct kind, type, value); null key where
    it has no canonical form."""
    kind, value, seen = F.col(f"{end}.kind"), F.col(f"{end}.value"), f"{name}_seen"
    df = with_observable(df, seen, F.col(f"{end}.type"), F.when(kind == "indicator", value))
    key = F.when(kind == "indicator", F.col(f"{seen}.value")).when(kind == "cve", cve_id(value)).when(kind == "breach", F.nullif(slugify(value), F.lit("")))
    return df.withColumns({f"{name}_kind": kind, f"{name}_key": key, f"{name}_type": F.col(f"{seen}.type")}).drop(seen)


def rfc3339_micros(c: Column) -> Column:
    """Microseconds since 1970 of an RFC 3339 time with any offset and precision, cut to microseconds; else null.

    Spark's own cast also takes dates, region names and times without an offset, so the form is checked first.
    """
    form = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})\z"
    return F.when(c.rlike(form), F.unix_micros(c.try_cast(T.TimestampType())))
