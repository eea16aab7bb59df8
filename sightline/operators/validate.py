"""All that is wrong with an envelope, each problem with its place; never only the first.

Every rule is a column: a (path, message) where it is broken, else null.  Lengths are in bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.columns import rfc3339_micros, trim_blanks
from sightline.plans import schemas as S

PROBLEMS = "array<struct<path:string,message:string>>"


def at(path: Column | str, name: str = "") -> Column:
    return F.concat(F.lit(path) if isinstance(path, str) else path, F.lit(name))


def rule(broken: Column, path: Column, message: str) -> Column:
    return F.when(broken, F.struct(path.alias("path"), F.lit(message).alias("message")))


def listed(*rules: Column) -> Column:
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def each(items: Column, check: Callable[[Column, Column], Column]) -> Column:
    """The problems of all items of an array; none of null."""
    return F.coalesce(F.flatten(F.transform(items, check)), F.array().cast(PROBLEMS))


def missing(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def one_of(c: Column, allowed: tuple[str, ...]) -> Column:
    return F.coalesce(c.isin(*allowed), F.lit(False))


def within(c: Column, low: float, high: float) -> Column:
    """Whether a number, if there is one, is outside."""
    return F.coalesce(~c.between(low, high), F.lit(False))


def micros(c: Column, kind: str = "text") -> Column:
    return rfc3339_micros(c) if kind == "text" else F.unix_micros(c)


def time_rules(c: Column, path: Column, now: Column, kind: str = "text") -> list[Column]:
    us = micros(c, kind)
    return [
        rule(us < F.unix_micros(F.lit(S.EARLIEST).cast("timestamp")), path, "too early"),
        rule(us > F.unix_micros(now) + S.AHEAD_HOURS * 3_600_000_000, path, "too far ahead"),
    ]


def context_problems(c: Column, path: Column, now: Column) -> Column:
    first, last = micros(c["first_seen"]), micros(c["last_seen"])
    own = listed(
        *time_rules(c["first_seen"], at(path, ".first_seen"), now), *time_rules(c["last_seen"], at(path, ".last_seen"), now),
        rule(last < first, at(path, ".last_seen"), "before first_seen"),
        rule(within(c["confidence"], 0, 1), at(path, ".confidence"), "not between 0 and 1"),
        rule(~missing(c["tlp"]) & ~one_of(c["tlp"], S.TLP), at(path, ".tlp"), "unknown marking"),
        rule(F.size(c["tags"]) > S.MAX_TAGS, at(path, ".tags"), "too many"),
    )
    tags = each(c["tags"], lambda t, i: listed(rule(missing(t), F.concat(path, F.lit(".tags["), i, F.lit("]")), "empty"), rule(F.octet_length(t) > S.MAX_TAG_BYTES, F.concat(path, F.lit(".tags["), i, F.lit("]")), "too long")))
    return F.when(c.isNull(), F.array().cast(PROBLEMS)).otherwise(F.concat(own, tags))


def indicator_problems(c: Column, path: Column) -> Column:
    return F.when(c.isNull(), F.array().cast(PROBLEMS)).otherwise(listed(
        rule(missing(c["type"]), at(path, ".type"), "required"),
        rule(~missing(c["type"]) & ~one_of(c["type"], S.OBSERVABLE_TYPES), at(path, ".type"), "unknown type"),
        rule(missing(c["raw_value"]), at(path, ".raw_value"), "required"),
        rule(F.octet_length(c["raw_value"]) > S.MAX_VALUE_BYTES, at(path, ".raw_value"), "too long"),
    ))


def cve_problems(c: Column, path: Column, now: Column, kind: str = "text") -> Column:
    own = listed(
        rule(missing(c["cve_id"]), at(path, ".cve_id"), "required"),
        rule(~missing(c["cve_id"]) & ~c["cve_id"].rlike(r"^(?i:CVE)-[0-9]{4}-[0-9]{4,}\z"), at(path, ".cve_id"), "no CVE id"),
        rule(within(c["cvss_score"], 0, 10), at(path, ".cvss_score"), "not between 0 and 10"),
        rule(within(c["epss_score"], 0, 1), at(path, ".epss_score"), "not between 0 and 1"),
        rule(~missing(c["severity"]) & ~one_of(F.lower(c["severity"]), S.SEVERITIES), at(path, ".severity"), "unknown severity"),
        *time_rules(c["published_at"], at(path, ".published_at"), now, kind), *time_rules(c["modified_at"], at(path, ".modified_at"), now, kind),
    )
    cwe = each(c["cwe"], lambda w, i: listed(rule(~F.coalesce(w.rlike(r"^CWE-[0-9]+\z"), F.lit(False)), F.concat(path, F.lit(".cwe["), i, F.lit("]")), "no CWE id")))
    return F.when(c.isNull(), F.array().cast(PROBLEMS)).otherwise(F.concat(own, cwe))


def breach_problems(c: Column, path: Column, now: Column, kind: str = "text") -> Column:
    day = F.concat(F.nullif(c["breach_date"].cast("string"), F.lit("")), F.lit("T00:00:00Z"))
    return F.when(c.isNull(), F.array().cast(PROBLEMS)).otherwise(listed(
        rule(F.coalesce(trim_blanks(c["name"]), F.lit("")) == "", at(path, ".name"), "required"),
        rule(c["record_count"] < 0, at(path, ".record_count"), "negative"),
        *time_rules(c["disclosed_at"], at(path, ".disclosed_at"), now, kind), *time_rules(day, at(path, ".breach_date"), now),
    ))


def record_problems(r: Column, path: Column, now: Column) -> Column:
    rules = [*time_rules(r["observed_at"], at(path, ".observed_at"), now), rule(missing(r["kind"]), at(path, ".kind"), "required"), rule(~missing(r["kind"]) & ~one_of(r["kind"], S.KINDS), at(path, ".kind"), "unknown kind")]
    for kind in S.KINDS:
        is_kind = F.coalesce(r["kind"] == kind, F.lit(False))
        rules += [rule(is_kind & r[kind].isNull(), at(path, f".{kind}"), "required by kind"), rule(~is_kind & r[kind].isNotNull(), at(path, f".{kind}"), "not what kind says")]
    return F.concat(
        context_problems(r["context"], at(path, ".context"), now), listed(*rules), indicator_problems(r["indicator"], at(path, ".indicator")),
        cve_problems(r["cve"], at(path, ".cve"), now), breach_problems(r["breach"], at(path, ".breach"), now),
    )


def endpoint_rules(c: Column, path: Column) -> list[Column]:
    return [
        rule(missing(c["kind"]), at(path, ".kind"), "required"),
        rule(~missing(c["kind"]) & ~one_of(c["kind"], S.KINDS), at(path, ".kind"), "unknown kind"),
        rule(~missing(c["type"]) & ~F.coalesce(c["kind"] == "indicator", F.lit(False)), at(path, ".type"), "only for indicators"),
        rule(~missing(c["type"]) & (c["kind"] == "indicator") & ~one_of(c["type"], S.OBSERVABLE_TYPES), at(path, ".type"), "unknown type"),
        rule(missing(c["value"]), at(path, ".value"), "required"),
        rule(F.octet_length(c["value"]) > S.MAX_VALUE_BYTES, at(path, ".value"), "too long"),
    ]


def relationship_problems(r: Column, path: Column, now: Column, kind: str = "text") -> Column:
    return listed(
        *endpoint_rules(r["source"], at(path, ".source")), *endpoint_rules(r["target"], at(path, ".target")),
        rule(missing(r["type"]), at(path, ".type"), "required"),
        rule(~missing(r["type"]) & ~one_of(r["type"], S.VERBS), at(path, ".type"), "unknown verb"),
        rule(within(r["confidence"], 0, 1), at(path, ".confidence"), "not between 0 and 1"),
        *time_rules(r["first_seen"], at(path, ".first_seen"), now, kind), *time_rules(r["last_seen"], at(path, ".last_seen"), now, kind),
    )


def raw_problems(raw: Column) -> Column:
    encoding = F.coalesce(raw["encoding"], F.lit(""))
    data = F.when(encoding == "base64", F.try_to_binary(raw["data"], F.lit("base64"))).otherwise(F.encode(raw["data"], "utf-8"))
    known = encoding.isin("", "utf8", "base64")
    return F.when(raw.isNull(), F.array().cast(PROBLEMS)).otherwise(listed(
        rule(missing(raw["data"]), F.lit("raw.data"), "required"),
        rule(~missing(raw["data"]) & ~known, F.lit("raw.encoding"), "unknown encoding"),
        rule(~missing(raw["data"]) & known & data.isNull(), F.lit("raw.data"), "no base64"),
        rule(~missing(raw["data"]) & known & (F.octet_length(data) > S.MAX_RAW_BYTES), F.lit("raw.data"), "too large"),
    ))


def envelope_problems(e: Column, now: Column) -> Column:
    """All problems of an envelope, as an array of (path, message) in the order of the document."""
    version = F.coalesce(e["schema_version"], F.lit(""))
    head = listed(
        rule(version == "", F.lit("schema_version"), "required"),
        rule((version != "") & ~version.rlike(r"^[0-9]+\.[0-9]+\z"), F.lit("schema_version"), "not MAJOR.MINOR"),
        rule(version.rlike(r"^[0-9]+\.[0-9]+\z") & ~version.rlike(r"^0*1\."), F.lit("schema_version"), "unknown major version"),
        rule(missing(e["source"]), F.lit("source"), "required"),
        rule(F.octet_length(e["source"]) > S.MAX_SOURCE_BYTES, F.lit("source"), "too long"),
        rule(~missing(e["source"]) & (F.octet_length(e["source"]) <= S.MAX_SOURCE_BYTES) & ~e["source"].rlike(r"^[a-z0-9]+(?:[-_.][a-z0-9]+)*\z"), F.lit("source"), "no slug"),
        rule(missing(e["collected_at"]), F.lit("collected_at"), "required"), *time_rules(e["collected_at"], F.lit("collected_at"), now),
        rule(~missing(e["content_hash"]) & ~e["content_hash"].rlike(r"^sha256:[0-9a-f]{64}\z"), F.lit("content_hash"), "no sha256 hash"),
        rule(F.coalesce(F.size(e["records"]), F.lit(0)) <= 0, F.lit("records"), "required"),
        rule(F.size(e["records"]) > S.MAX_RECORDS, F.lit("records"), "too many"),
        rule(F.size(e["relationships"]) > S.MAX_RELATIONSHIPS, F.lit("relationships"), "too many"),
    )
    place = lambda name, i: F.concat(F.lit(f"{name}["), i, F.lit("]"))
    return F.concat(
        head, raw_problems(e["raw"]), context_problems(e["default_context"], F.lit("default_context"), now),
        each(e["records"], lambda r, i: record_problems(r, place("records", i), now)),
        each(e["relationships"], lambda r, i: relationship_problems(r, place("relationships", i), now)),
    )


def summary(problems: Column, most: int = 10) -> Column:
    """How many problems there are, the first of them, and how many more; null of none."""
    n = F.size(problems)
    lines = F.array_join(F.transform(F.slice(problems, 1, most), lambda p: F.concat_ws(": ", p["path"], p["message"])), "; ")
    more = F.when(n > most, F.concat(F.lit("; and "), n - most, F.lit(" more"))).otherwise("")
    return F.when(n > 0, F.concat(n, F.lit(" problems: "), lines, more))
