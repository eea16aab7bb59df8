"""The wire format, the tables, and the closed vocabularies and limits (fixed values)."""

from __future__ import annotations

KINDS = ("indicator", "cve", "breach")
OBSERVABLE_TYPES = ("auto", "ipv4", "ipv6", "cidr", "domain", "url", "email", "md5", "sha1", "sha256", "sha512")
VERBS = ("indicates", "exploits", "mitigates", "attributed-to", "targets", "related-to", "derived-from", "exposed-in")
TLP = ("clear", "green", "amber", "amber+strict", "red")
SEVERITIES = ("none", "low", "medium", "high", "critical")

MAX_RECORDS = MAX_RELATIONSHIPS = 50_000
MAX_RAW_BYTES = 1 << 20
MAX_BODY = 32 << 20
MAX_SOURCE_BYTES = MAX_TAG_BYTES = 128
MAX_TAGS = 64
MAX_VALUE_BYTES = 4096
EARLIEST = "1990-01-01T00:00:00Z"
AHEAD_HOURS = 48
MAX_DROP_RATIO = 0.25
MAX_REASON = 8192
LOOKUP_SOURCES, LOOKUP_TAGS, LOOKUP_TTL_DAYS = 32, 64, 30

CONTEXT = "struct<first_seen:string,last_seen:string,confidence:double,tags:array<string>,tlp:string,attributes:string>"
INDICATOR = "struct<type:string,raw_value:string>"
CVE = (
    "struct<cve_id:string,summary:string,cvss_score:double,cvss_vector:string,severity:string,epss_score:double,"
    "known_exploited:boolean,cwe:array<string>,published_at:string,modified_at:string,refs:string>"
)
BREACH = (
    "struct<slug:string,name:string,domain:string,description:string,breach_date:string,disclosed_at:string,"
    "record_count:bigint,data_classes:array<string>,verified:boolean>"
)
ENDPOINT = "struct<kind:string,type:string,value:string>"
RECORD = f"struct<kind:string,observed_at:string,context:{CONTEXT},indicator:{INDICATOR},cve:{CVE},breach:{BREACH}>"
RELATIONSHIP = f"struct<source:{ENDPOINT},target:{ENDPOINT},type:string,confidence:double,first_seen:string,last_seen:string,metadata:string>"
ENVELOPE = (
    "struct<schema_version:string,source:string,source_run_id:string,collected_at:string,content_hash:string,raw_ref:string,"
    f"raw:struct<media_type:string,encoding:string,data:string>,default_context:{CONTEXT},records:array<{RECORD}>,relationships:array<{RELATIONSHIP}>>"
)

#: Tables: columns and the key by which rows are one.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "entity": ("entity_id string, kind string, canonical_key string, first_seen timestamp, last_seen timestamp", ("kind", "canonical_key")),
    "indicator": ("entity_id string, type string, value string, raw_value string", ("entity_id",)),
    "cve": ("entity_id string, cve_id string, summary string, cvss_score float, cvss_vector string, severity string, epss_score float, known_exploited boolean, cwe array<string>, published_at timestamp, modified_at timestamp, refs string", ("entity_id",)),
    "breach": ("entity_id string, slug string, name string, domain string, description string, breach_date date, disclosed_at timestamp, record_count long, data_classes array<string>, verified boolean", ("entity_id",)),
    "relationship": ("source_id string, target_id string, type string, confidence float, first_seen timestamp, last_seen timestamp, metadata string", ("source_id", "target_id", "type")),
    "sighting": ("entity_id string, source string, observed_at timestamp, content_hash string, raw_ref string, context string, month string", ()),
    "lookup": ("entity_id string, type string, value string, first_seen timestamp, last_seen timestamp, sources array<string>, tags array<string>, confidence double, refreshed_at timestamp", ("type", "value")),
    "envelope_log": ("source string, envelope_digest string, content_hash string, source_run_id string, schema_version string, record_count long, raw_ref string, received_at timestamp, processed_at timestamp", ("source", "envelope_digest")),
    "dead_letter": ("source_slug string, message_id string, stage string, reason string, payload string, failed_at timestamp", ()),
    "metrics_log": ("source string, metric string, label string, n long, at timestamp", ()),
}
VERSION = 2

#: What brings a store's manifest from the version before to each version. 2: the log of envelopes is read by position, the
#: lookup projection is stored; batches of version 1 hold all that it is made from.
MIGRATIONS = {2: lambda manifest: {k: v for k, v in manifest.items() if k != "compacted"}}
