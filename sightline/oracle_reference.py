"""The queries of queries_reference.py in SQL for DuckDB, where SQL can say them."""

from __future__ import annotations

NOW_US = "epoch_us(timestamptz '2026-01-01 00:00:00+00')"
LIMITS = ("epoch_us(timestamptz '1990-01-01 00:00:00+00')", f"({NOW_US} + 48 * 3600000000)")
BLANK = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def trim(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{BLANK}+', ''), '{BLANK}+$', '')"


def slug_of(c: str) -> str:
    return f"nullif(lower({trim(c)}), '')"


def defang(c: str) -> str:
    v = f"regexp_replace(regexp_replace({trim(c)}, '^[<>\"''`]+', ''), '[<>\"''`]+$', '')"
    v = f"regexp_replace({v}, '^(?:h(?:xxp|xtp|\\*\\*p)|htxp)(s?)([\\[({{]?:)', 'http\\1\\2', 'i')"
    v = f"regexp_replace({v}, '^fxp([\\[({{]?:)', 'ftp\\1', 'i')"
    v = f"regexp_replace({v}, '^httpS([\\[({{]?:)', 'https\\1')"
    gap = "[\\t\\n\\f\\r ]*"
    for pattern, to in ((f"[\\[({{]{gap}:{gap}/{gap}/{gap}[\\])}}]", "://"), (f"[\\[({{]{gap}(?:\\.|dot|punto|point){gap}[\\])}}]", "."), (f"[\\[({{]{gap}(?:@|at){gap}[\\])}}]", "@"), (f"[\\[({{]{gap}:{gap}[\\])}}]", ":"), (f"[\\[({{]{gap}//?{gap}[\\])}}]", "/"), ("\\\\\\.", ".")):
        v = f"regexp_replace({v}, '{pattern}', '{to}', 'gi')"
    return trim(v)


def slugify(c: str) -> str:
    v = f"translate(lower({trim(c)}), 'áàâäãåéèêëíìîïóòôöõøúùûüñçýÿß', 'aaaaaaeeeeiiiioooooouuuuncyys')"
    v = f"regexp_replace(regexp_replace({v}, '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g')"
    return f"coalesce(trim(left(trim({v}, '-'), 200), '-'), '')"


CVE_KEY = "case when regexp_full_match({0}, 'CVE-[0-9]{{4}}-[0-9]{{4,}}') then left({0}, 9) || lpad(ltrim(substr({0}, 10), '0'), greatest(4, length(ltrim(substr({0}, 10), '0')))::int, '0') end"


def cve_key(c: str) -> str:
    return CVE_KEY.format(f"upper({trim(c)})")


def time_us(c: str) -> str:
    return f"case when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\\.[0-9]+)?(Z|[+-][0-9]{{2}}:[0-9]{{2}})') then epoch_us(try_cast({c} as timestamptz)) end"


BREACH_SLUG = f"""case when {slugify('breach.slug')} <> '' then {slugify('breach.slug')} when {slugify('breach.name')} <> '' then {slugify('breach.name')} ||
    coalesce('-' || coalesce(year(breach.breach_date), year(breach.disclosed_at))::varchar, '') end"""
ONCE = "e as (select envelope_id, arg_min(collected_at, received_at) as collected_at, arg_min({'c': default_context}, received_at).c as default_context from envelopes group by 1)"


def rules(source: str, row_id: str, found: list[tuple[str, str, str]]) -> str:
    return " union all ".join(f"select {row_id}, {path} as path, '{message}' as message from {source} where {broken}" for broken, path, message in found)


def times(us: str, path: str) -> list[tuple[str, str, str]]:
    return [(f"{us} < {LIMITS[0]}", f"'{path}'", "too early"), (f"{us} > {LIMITS[1]}", f"'{path}'", "too far ahead")]


def outside(c: str, top: int) -> str:
    return f"{c} is not null and not coalesce({c} between 0 and {top}, false)"


def oracle_sql() -> dict[str, str]:
    first, last = time_us("context.first_seen"), time_us("context.last_seen")
    types = "('auto','ipv4','ipv6','cidr','domain','url','email','md5','sha1','sha256','sha512')"
    ends = [
        x for s in ("source", "target") for x in (
            (f"coalesce({s}.kind, '') = ''", f"'edge.{s}.kind'", "required"), (f"{s}.kind <> '' and {s}.kind not in ('indicator','cve','breach')", f"'edge.{s}.kind'", "unknown kind"),
            (f"{s}.type <> '' and {s}.kind is distinct from 'indicator'", f"'edge.{s}.type'", "only for indicators"), (f"{s}.type <> '' and {s}.kind = 'indicator' and {s}.type not in {types}", f"'edge.{s}.type'", "unknown type"),
            (f"coalesce({s}.value, '') = ''", f"'edge.{s}.value'", "required"), (f"strlen({s}.value) > 4096", f"'edge.{s}.value'", "too long"),
        )
    ]
    keep = lambda c: f"arg_max({c}, seq) filter ({c} is not null) as {c}"
    return {
        "defanged_values": f"select record_id, {defang('indicator.raw_value')} as value from indicator_records",
        "cve_ids": f"select record_id, {cve_key('cve.cve_id')} as cve_id from cve_records",
        "breach_slugs": f"select record_id, {BREACH_SLUG} as slug from breach_records",
        "effective_contexts": f"""
            with {ONCE}, r as (select record_id, context as o, default_context as d from indicator_records join e using (envelope_id))
            select record_id,
                case when d is null then o.first_seen when o is null then d.first_seen else coalesce(nullif(o.first_seen, ''), d.first_seen) end as first_seen,
                case when d is null then o.last_seen when o is null then d.last_seen else coalesce(nullif(o.last_seen, ''), d.last_seen) end as last_seen,
                case when d is null then o.confidence when o is null then d.confidence else coalesce(o.confidence, d.confidence) end as confidence,
                array_to_string(case when d is null then o.tags when o is null then d.tags when len(o.tags) > 0 then list_filter(list_concat(coalesce(d.tags, []), o.tags), lambda x, i: list_position(list_concat(coalesce(d.tags, []), o.tags), x) = i) else d.tags end, '|') as tags,
                case when d is null then o.tlp when o is null then d.tlp else coalesce(nullif(o.tlp, ''), d.tlp) end as tlp,
                array_to_string(list_sort(case when d is null then json_keys(o.attributes) when o is null then json_keys(d.attributes) when o.attributes is null then json_keys(d.attributes) when d.attributes is null then json_keys(o.attributes) else list_distinct(list_concat(json_keys(d.attributes), json_keys(o.attributes))) end), ',') as attribute_names
            from r""",
        "edge_windows": f"""
            with {ONCE}, r as (select edge_id, epoch_us(coalesce(first_seen, collected_at)) as a, epoch_us(coalesce(last_seen, collected_at)) as b from relationship join e using (envelope_id))
            select edge_id, least(a, b) as first_us, greatest(a, b) as last_us from r""",
        "indicator_problems": rules("indicator_records", "record_id", [
            ("indicator is not null and coalesce(indicator.type, '') = ''", "'indicator.type'", "required"), (f"indicator.type <> '' and indicator.type not in {types}", "'indicator.type'", "unknown type"),
            ("indicator is not null and coalesce(indicator.raw_value, '') = ''", "'indicator.raw_value'", "required"), ("strlen(indicator.raw_value) > 4096", "'indicator.raw_value'", "too long"),
            *times(first, "context.first_seen"), *times(last, "context.last_seen"), (f"{last} < {first}", "'context.last_seen'", "before first_seen"),
            (outside("context.confidence", 1), "'context.confidence'", "not between 0 and 1"), ("context.tlp <> '' and context.tlp not in ('clear','green','amber','amber+strict','red')", "'context.tlp'", "unknown marking"),
            ("len(context.tags) > 64", "'context.tags'", "too many"),
        ]) + " union all select record_id, 'context.tags[' || (i - 1) || ']', case when coalesce(t, '') = '' then 'empty' else 'too long' end from (select record_id, unnest(context.tags) as t, generate_subscripts(context.tags, 1) as i from indicator_records) where coalesce(t, '') = '' or strlen(t) > 128",
        "cve_problems": rules("cve_records", "record_id", [
            ("cve is not null and coalesce(cve.cve_id, '') = ''", "'cve.cve_id'", "required"), ("cve.cve_id <> '' and not regexp_full_match(cve.cve_id, '(?i:CVE)-[0-9]{4}-[0-9]{4,}')", "'cve.cve_id'", "no CVE id"),
            (outside("cve.cvss_score", 10), "'cve.cvss_score'", "not between 0 and 10"), (outside("cve.epss_score", 1), "'cve.epss_score'", "not between 0 and 1"),
            ("cve.severity <> '' and lower(cve.severity) not in ('none','low','medium','high','critical')", "'cve.severity'", "unknown severity"),
            *times("epoch_us(cve.published_at)", "cve.published_at"), *times("epoch_us(cve.modified_at)", "cve.modified_at"),
        ]) + " union all select record_id, 'cve.cwe[' || (i - 1) || ']', 'no CWE id' from (select record_id, unnest(cve.cwe) as w, generate_subscripts(cve.cwe, 1) as i from cve_records) where not coalesce(regexp_full_match(w, 'CWE-[0-9]+'), false)",
        "breach_problems": rules("breach_records", "record_id", [
            (f"breach is not null and coalesce({trim('breach.name')}, '') = ''", "'breach.name'", "required"), ("breach.record_count < 0", "'breach.record_count'", "negative"),
            *times("epoch_us(breach.disclosed_at)", "breach.disclosed_at"), *times("epoch_us(breach.breach_date::timestamp)", "breach.breach_date"),
        ]),
        "edge_problems": rules("relationship", "edge_id", [
            *ends, ("coalesce(type, '') = ''", "'edge.type'", "required"), ("type <> '' and type not in ('indicates','exploits','mitigates','attributed-to','targets','related-to','derived-from','exposed-in')", "'edge.type'", "unknown verb"),
            (outside("confidence", 1), "'edge.confidence'", "not between 0 and 1"), *times("epoch_us(first_seen)", "edge.first_seen"), *times("epoch_us(last_seen)", "edge.last_seen"),
        ]),
        "first_drops": f"""
            with r as (select {slug_of('source_slug')} as slug, record_id, row_number() over (partition by {slug_of('source_slug')} order by record_id) as place from cve_records
                       where not coalesce(cve.cvss_score between 0 and 10, true) or not coalesce(cve.epss_score between 0 and 1, true))
            select * from r where place <= 3""",
        "cve_entities": f"select {cve_key('cve.cve_id')} as canonical_key, min(epoch_us(observed_at)) as first_us, max(epoch_us(observed_at)) as last_us from cve_records where {cve_key('cve.cve_id')} is not null group by 1",
        "cve_fold": f"""
            with r as (select envelope_id as seq, record_index as idx, {cve_key('cve.cve_id')} as cve_id, cve as c from cve_records),
                 w as (select seq, cve_id, arg_max({{'c': c}}, idx).c as c from r where cve_id is not null group by 1, 2),
                 f as (select seq, cve_id, nullif(c.summary, '') as summary, nullif(c.cvss_vector, '') as cvss_vector, nullif(lower(c.severity), '') as severity, case when isfinite(c.cvss_score) then c.cvss_score end as cvss_score, case when isfinite(c.epss_score) then c.epss_score end as epss_score,
                              coalesce(c.known_exploited, false) as known_exploited, array_to_string(c.cwe, '|') as cwe, epoch_us(c.published_at) as published_us, epoch_us(c.modified_at) as modified_us, c.refs as refs from w)
            select cve_id, {', '.join(keep(x) for x in ('summary', 'cvss_score', 'cvss_vector', 'severity', 'epss_score', 'cwe', 'published_us', 'refs'))}, bool_or(known_exploited) as known_exploited, max(modified_us) as modified_us from f group by 1""",
        "breach_fold": f"""
            with r as (select envelope_id as seq, record_index as idx, {BREACH_SLUG} as slug, breach as b from breach_records),
                 w as (select seq, slug, arg_max({{'b': b}}, idx).b as b from r where slug is not null group by 1, 2),
                 f as (select seq, slug, b.name as name, nullif(b.description, '') as description, b.breach_date::varchar as breach_date, epoch_us(b.disclosed_at) as disclosed_us, b.record_count as record_count,
                              array_to_string(b.data_classes, '|') as data_classes, coalesce(b.verified, false) as verified from w)
            select slug, arg_max({{'n': name}}, seq).n as name, {', '.join(keep(x) for x in ('description', 'breach_date', 'disclosed_us', 'data_classes'))}, max(record_count) as record_count, bool_or(verified) as verified from f group by 1""",
        "edge_fold_as_written": f"""
            with {ONCE}, r as (select envelope_id as seq, edge_id as idx, concat_ws(':', source.kind, source.value) as source_key, concat_ws(':', target.kind, target.value) as target_key, type, confidence, metadata,
                              epoch_us(coalesce(first_seen, collected_at)) as a, epoch_us(coalesce(last_seen, collected_at)) as b from relationship join e using (envelope_id)),
                 w as (select seq, source_key, target_key, type, min(least(a, b)) as first_us, max(greatest(a, b)) as last_us, arg_min(confidence, idx) filter (confidence is not null) as confidence, arg_min({{'m': metadata}}, idx).m as metadata from r group by 1, 2, 3, 4),
                 k as (select seq, source_key, target_key, type, metadata, unnest(json_keys(metadata)) as k from w),
                 l as (select source_key, target_key, type, k, arg_max(json_extract(metadata, '$."' || k || '"'), seq) as v from k group by 1, 2, 3, 4),
                 m as (select source_key, target_key, type, '{{' || string_agg('"' || k || '":' || v, ',' order by k) || '}}' as m from l group by 1, 2, 3),
                 f as (select source_key, target_key, type, min(first_us) as first_us, max(last_us) as last_us, arg_max(confidence, seq) filter (confidence is not null) as confidence, count(*) as n, count(metadata) as nm from w group by 1, 2, 3)
            select f.source_key, f.target_key, f.type, first_us, last_us, confidence, case when n = 1 and nm = 0 then null else coalesce(m, '{{}}') end as metadata from f left join m on f.source_key = m.source_key and f.target_key = m.target_key and f.type is not distinct from m.type""",
        "first_deliveries": f"select {slug_of('source')} as source, envelope_digest, arg_min(envelope_id, (received_at, envelope_id)) as envelope_id, epoch_us(min(received_at)) as received_us, count(*) as n_deliveries from envelopes group by 1, 2",
        "source_runs": f"select slug, greatest(epoch_us(last_run_at), latest) as last_run_us from sources left join (select {slug_of('source')} as slug, max(epoch_us(collected_at)) as latest from envelopes group by 1) using (slug)",
        "capped_tags": f"""
            with x as (select {slug_of('source_slug')} as slug, record_id, unnest(context.tags) as tag, generate_subscripts(context.tags, 1) as i from indicator_records),
                 f as (select slug, tag, min((record_id, i)) as p from x where slug is not null and tag <> '' group by 1, 2),
                 r as (select *, row_number() over (partition by slug order by p desc) as n from f)
            select slug, string_agg(tag, '|' order by n desc) as tags from r where n <= 8 group by 1""",
        "source_status": f"select case when s.slug is null then 'unknown' when s.enabled then 'known' else 'disabled' end as source_status, count(*) as n from indicator_records r left join sources s on {slug_of('r.source_slug')} = s.slug group by 1",
        "sources_list": "select slug, name, url, tlp, enabled from sources",
        "stub_cves": f"""
            with x as (select envelope_id as seq, edge_id * 2 as place, source.kind as kind, source.value as v from relationship union all select envelope_id, edge_id * 2 + 1, target.kind, target.value from relationship),
                 k as (select seq, {cve_key('v')} as cve_id, min(place) as place from x where kind = 'cve' group by 1, 2)
            select * from k where cve_id is not null and (seq, cve_id) not in (select envelope_id, {cve_key('cve.cve_id')} from cve_records where {cve_key('cve.cve_id')} is not null)""",
        "orphan_sightings": "select sighting_id from sighting where source_id is null or source_id not in (select id from sources)",
        "similar_names": """
            with n as (select distinct breach.name as t, record_id % 50 = 0 as q from breach_records where breach.name is not null),
                 w as (select distinct t, q, unnest(list_filter(string_split_regex(lower(t), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) as w from n),
                 g as (select distinct t, q, unnest(list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i::int, 3))) as g from w),
                 c as (select t, count(distinct g) as n from g group by 1),
                 p as (select a.t as query, b.t as text, count(distinct a.g) as shared from (select distinct t, g from g where q) a join (select distinct t, g from g) b using (g) where a.t <> b.t group by 1, 2)
            select query, text, round(shared / (x.n + y.n - shared), 6) as similarity from p join c x on x.t = query join c y on y.t = text where shared * 2 >= x.n + y.n - shared""",
        "sightings_by_month": "select strftime(observed_at at time zone 'UTC', '%Y_%m') as month, count(*) as n from sighting group by 1",
        "retained_months": """
            with m as (select distinct date_trunc('month', observed_at at time zone 'UTC')::timestamp as m from sighting where observed_at is not null)
            select strftime(m, '%Y_%m') as month, epoch_us(m) as start_us, epoch_us(m + interval 1 month) as end_us, m + interval 1 month <= timestamp '2025-06-10' as dropped from m""",
        "archive_keys": """
            with h as (select doc_id, sha256(text) as h from documents where text is not null)
            select 'sha256:' || h as content_hash, min(doc_id) as doc_id, count(*) as n_copies, 'raw/sha256/' || substr(h, 1, 2) || '/' || substr(h, 3, 2) || '/' || h as key from h group by h""",
        "dead_letter_rows": "select sighting_id, case when sighting_id % 3 = 0 then to_json(context || ' rest')::varchar else context end as payload from sighting where context is not null",
        "event_rates": """
            with s as (select event_type, (ceil(epoch_us(ts) / 30000000.0) * 30)::bigint as tick, count(*) as n from events where ts is not null group by 1, 2),
                 x as (select event_type, unnest(generate_series(tick, tick + 270, 30)) as t, n from s)
            select event_type, t * 1000000 as t_us, round(sum(n) / 300.0, 9)::double as rate from x group by 1, 2""",
        "event_increase": "select event_id, count(*) over (partition by event_type order by epoch_us(ts) range between 3599999999 preceding and current row) as increase from events",
        "duplicate_ratio": """
            with f as (select envelope_digest, min(received_at) as first_at from envelopes group by 1)
            select strftime(received_at at time zone 'UTC', '%Y-%m-%d') as day, round(count(*) filter (received_at > first_at) / count(*), 9) as ratio from envelopes join f using (envelope_digest) group by 1""",
        "delivery_quantiles": f"""
            with b as (select * from (values (0, 60.0::double), (1, 300), (2, 600), (3, 1800), (4, 3600), (5, 21600), (6, 86400), (7, 604800)) v(i, hi)),
                 r as (select {slug_of('source')} as source, (epoch_us(received_at) - epoch_us(collected_at)) / 1e6 as s from envelopes),
                 n as (select source, count(s) as n from r where s is not null group by 1),
                 c as (select source, i, hi, count(*) filter (s <= hi) as c from r, b where s is not null group by 1, 2, 3),
                 l as (select *, lag(c, 1, 0) over w as before, lag(hi, 1, 0) over w as lo from c window w as (partition by source order by i)),
                 x as (select source, min(i) filter (c >= n * 0.99::double) as i from l join n using (source) group by 1)
            select x.source, round(case when x.i is null then 604800 else lo + (hi - lo) * (n * 0.99::double - before) / greatest(c - before, 1) end, 6)::double as p99
            from x join n on n.source is not distinct from x.source left join l on l.source is not distinct from x.source and l.i = x.i""",
        "alert_silent_sources": f"select distinct {slug_of('source_slug')} as slug from indicator_records where {slug_of('source_slug')} is not null and {slug_of('source_slug')} not in (select {slug_of('source_slug')} from cve_records where {slug_of('source_slug')} is not null)",
        "alert_held": """
            with v as (select event_type, ts, min(value) > 20 as ok from events group by 1, 2),
                 c as (select *, case when ok is distinct from lag(ok) over w then 1 else 0 end as new from v window w as (partition by event_type order by ts)),
                 r as (select *, sum(new) over (partition by event_type order by ts rows unbounded preceding) as run from c)
            select event_type, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us from r where ok group by event_type, run having epoch_us(max(ts)) - epoch_us(min(ts)) >= 3600000000""",
        "stream_windows": """
            with w as (select event_type, epoch_us(ts) // 300000000 * 300000000 as start_us from events)
            select event_type, start_us, count(*) as n from w where start_us + 300000000 <= (select epoch_us(max(ts)) // 1000 * 1000 from events) - 600000000 group by 1, 2""",
    }
