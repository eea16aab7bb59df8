"""The queries that build on canonical values, in SQL for DuckDB."""

from __future__ import annotations

from sightline.oracle_canonical import endpoints, observed
from sightline.oracle_reference import BREACH_SLUG, ONCE, cve_key, outside, rules, slug_of, time_us, times, trim

HASHES = "('md5', 'sha1', 'sha256', 'sha512')"
INDICATORS = observed("o", "indicator_records", "record_id, indicator", "indicator.type", "indicator.raw_value")


def entity(kind: str, key: str) -> str:
    h = f"sha256({kind} || chr(0) || {key})"
    return f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), substr({h}, 21, 12))"


def own(field: str, empty: bool = False) -> str:
    """A field of the context once the envelope's default `d` is taken in: the record's own, `c`, where it is set."""
    return f"case when d is null then c.{field} when c is null then d.{field} else coalesce({f'''nullif(c.{field}, '')''' if empty else f'c.{field}'}, d.{field}) end"


FIRST, LAST = (time_us(f"({own(x, True)})") for x in ("first_seen", "last_seen"))
TAGS = "case when d is null then c.tags when c is null then d.tags when len(c.tags) > 0 then list_filter(list_concat(coalesce(d.tags, []), c.tags), lambda x, i: list_position(list_concat(coalesce(d.tags, []), c.tags), x) = i) else d.tags end"
NONE = "null::struct(first_seen varchar, last_seen varchar, confidence double, tags varchar[], tlp varchar, attributes varchar)"

# every record: seq, idx, source, kind, key, type, reason, first_us, last_us, tags, confidence, raw
RECORDS = f"""{ONCE}, {observed("o", "indicator_records", "record_id, envelope_id, record_index, source_slug, kind, observed_at, context, indicator", "indicator.type", "case when kind = 'indicator' then indicator.raw_value end")},
    a as (select envelope_id, record_index as idx, source_slug as source, kind, observed_at, context as c, indicator is null as absent, value as key, type, indicator.raw_value as raw from o
          union all select envelope_id, record_index, source_slug, kind, observed_at, {NONE}, cve is null, {cve_key("cve.cve_id")}, null, null from cve_records
          union all select envelope_id, record_index, source_slug, kind, observed_at, {NONE}, breach is null, {BREACH_SLUG}, null, null from breach_records),
    b as (select *, default_context as d, epoch_us(coalesce(observed_at, collected_at)) as seen, case when coalesce(kind, '') not in ('indicator', 'cve', 'breach') then 'unknown_kind' when absent then 'missing_payload' when key is null then 'canonicalise' end as reason from a join e using (envelope_id)),
    r as (select envelope_id as seq, idx, source, kind, key, type, raw, reason, least(seen, {FIRST}) as first_us, greatest(seen, {LAST}) as last_us, {TAGS} as tags, {own("confidence")} as confidence from b)"""

# edges whose ends both have a key: seq, idx, verb, confidence, metadata, first_us, last_us, and kind, key, type of both ends
EDGES = f"""{endpoints("n", "relationship", "edge_id")},
    p as (select edge_id, any_value(kind) filter (place = 0) as sk, any_value(key) filter (place = 0) as s, any_value(type) filter (place = 0) as st, any_value(kind) filter (place = 1) as tk, any_value(key) filter (place = 1) as t, any_value(type) filter (place = 1) as tt from n group by 1),
    g as (select *, envelope_id as seq, edge_id as idx, epoch_us(coalesce(first_seen, collected_at)) as x1, epoch_us(coalesce(last_seen, collected_at)) as x2 from relationship join e using (envelope_id) join p using (edge_id) where s is not null and t is not null),
    x as (select seq, idx * 2 as place, sk as kind, s as key, st as type, least(x1, x2) as first_us, greatest(x1, x2) as last_us from g union all select seq, idx * 2 + 1, tk, t, tt, least(x1, x2), greatest(x1, x2) from g)"""

NUMBERED = "q as materialized (select *, row_number() over () as i from relationship)"  # rows may be repeated
NODES = f"""{NUMBERED}, {endpoints("n", "q", "i")}, z as (select i, place, kind || ':' || key as node from n),
    p as (select distinct a.node as s, b.node as t from z a join z b using (i) where a.place = 0 and b.place = 1 and a.node is not null and b.node is not null)"""


def lookup(where: str, columns: str) -> str:
    return f"""with {RECORDS},
        v as (select seq, idx, type, key as value, first_us, last_us, {slug_of("source")} as source, coalesce(tags, []) as tags, confidence from r where kind = 'indicator' and reason is null and {where}),
        w as (select seq, type, value, unnest(arg_min({{'first_us': first_us, 'last_us': last_us, 'source': source, 'tags': tags, 'confidence': confidence}}, idx)) from v group by 1, 2, 3),
        s0 as (select type, value, source, min(seq) as p from w where source <> '' group by 1, 2, 3),
        s1 as (select *, row_number() over (partition by type, value order by p desc) as n from s0),
        s as (select type, value, string_agg(source, '|' order by n desc) as sources from s1 where n <= 32 group by 1, 2),
        t0 as (select type, value, seq, unnest(tags) as tag, generate_subscripts(tags, 1) as i from w),
        t1 as (select type, value, tag, min((seq, i)) as p from t0 where tag <> '' group by 1, 2, 3),
        t2 as (select *, row_number() over (partition by type, value order by p desc) as n from t1),
        t as (select type, value, string_agg(tag, '|' order by n desc) as tags from t2 where n <= 64 group by 1, 2),
        f as (select type, value, min(first_us) as first_us, max(last_us) as last_us, max(confidence) as confidence, count(*) as n, array_to_string(max(tags), '|') as own from w group by 1, 2)
        select {columns}f.type, f.value, first_us, last_us, confidence, coalesce(s.sources, '') as sources, case when n = 1 then own else coalesce(t.tags, '') end as tags
        from f left join s on s.type = f.type and s.value = f.value left join t on t.type = f.type and t.value = f.value"""


def context_rules(source: str, row_id: str, c: str, path: str) -> str:
    """The rules of a context `c` as rows."""
    first, last = time_us(f"{c}.first_seen"), time_us(f"{c}.last_seen")
    tags = f" union all select {row_id}, '{path}.tags[' || (i - 1) || ']', case when coalesce(t, '') = '' then 'empty' else 'too long' end from (select *, unnest({c}.tags) as t, generate_subscripts({c}.tags, 1) as i from {source}) where coalesce(t, '') = '' or strlen(t) > 128"
    return rules(source, row_id, [
        *times(first, f"{path}.first_seen"), *times(last, f"{path}.last_seen"), (f"{last} < {first}", f"'{path}.last_seen'", "before first_seen"), (outside(f"{c}.confidence", 1), f"'{path}.confidence'", "not between 0 and 1"),
        (f"{c}.tlp <> '' and {c}.tlp not in ('clear','green','amber','amber+strict','red')", f"'{path}.tlp'", "unknown marking"), (f"len({c}.tags) > 64", f"'{path}.tags'", "too many"),
    ]) + tags


def record_rules(kind: str, own: list[tuple[str, str, str]]) -> str:
    return rules(f"{kind}_records", f"'{kind}' as of, record_id", [
        *times("epoch_us(observed_at)", "record.observed_at"), ("coalesce(kind, '') = ''", "'record.kind'", "required"), ("kind <> '' and kind not in ('indicator', 'cve', 'breach')", "'record.kind'", "unknown kind"),
        *[(f"kind = '{k}' and {f'{kind} is null' if k == kind else 'true'}", f"'record.{k}'", "required by kind") for k in ("indicator", "cve", "breach")], (f"kind is distinct from '{kind}' and {kind} is not null", f"'record.{kind}'", "not what kind says"), *own,
    ])


def oracle_sql() -> dict[str, str]:
    version, digits = "schema_version", "regexp_full_match(schema_version, '[0-9]+\\.[0-9]+')"
    types = "('auto','ipv4','ipv6','cidr','domain','url','email','md5','sha1','sha256','sha512')"
    keys = "(select {0} from n where n.i = q.i and place = {1})"
    members = "json_keys({0}.attributes)"
    return {
        "canonical_indicators": f"with {INDICATORS} select record_id, type, value from o",
        "inferred_types": f"with {observed('o', 'indicator_records', 'record_id', 'null::varchar', 'indicator.raw_value')} select type, count(*) as n from o group by 1",
        "hash_values": f"with {INDICATORS} select record_id, type, value from o where type in {HASHES} or indicator.type in {HASHES}",
        "ipv4_values": f"with {INDICATORS} select record_id, value from o where type = 'ipv4'",
        "endpoint_keys": f"with {NUMBERED}, {endpoints('n', 'q', 'i')} select edge_id, {', '.join(f'{keys.format(c, i)} as {x}_{c}' for i, x in enumerate(('source', 'target')) for c in ('kind', 'key', 'type'))} from q",
        "envelope_heads": rules("envelopes", "envelope_id", [
            (f"coalesce({version}, '') = ''", "'schema_version'", "required"), (f"{version} <> '' and not {digits}", "'schema_version'", "not MAJOR.MINOR"), (f"{digits} and not regexp_matches({version}, '^0*1\\.')", "'schema_version'", "unknown major version"),
            ("coalesce(source, '') = ''", "'source'", "required"), ("strlen(source) > 128", "'source'", "too long"), ("source <> '' and strlen(source) <= 128 and not regexp_full_match(source, '[a-z0-9]+(?:[-_.][a-z0-9]+)*')", "'source'", "no slug"),
            ("collected_at is null", "'collected_at'", "required"), *times("epoch_us(collected_at)", "collected_at"), ("content_hash <> '' and not regexp_full_match(content_hash, 'sha256:[0-9a-f]{64}')", "'content_hash'", "no sha256 hash"),
        ]) + " union all " + context_rules("envelopes", "envelope_id", "default_context", "default_context"),
        "record_problems": record_rules("indicator", [
            ("indicator is not null and coalesce(indicator.type, '') = ''", "'record.indicator.type'", "required"), (f"indicator.type <> '' and indicator.type not in {types}", "'record.indicator.type'", "unknown type"),
            ("indicator is not null and coalesce(indicator.raw_value, '') = ''", "'record.indicator.raw_value'", "required"), ("strlen(indicator.raw_value) > 4096", "'record.indicator.raw_value'", "too long"),
        ]) + " union all " + context_rules("indicator_records", "'indicator' as of, record_id", "context", "record.context") + " union all " + record_rules("cve", [
            ("cve is not null and coalesce(cve.cve_id, '') = ''", "'record.cve.cve_id'", "required"), ("cve.cve_id <> '' and not regexp_full_match(cve.cve_id, '(?i:CVE)-[0-9]{4}-[0-9]{4,}')", "'record.cve.cve_id'", "no CVE id"),
            (outside("cve.cvss_score", 10), "'record.cve.cvss_score'", "not between 0 and 10"), (outside("cve.epss_score", 1), "'record.cve.epss_score'", "not between 0 and 1"),
            ("cve.severity <> '' and lower(cve.severity) not in ('none','low','medium','high','critical')", "'record.cve.severity'", "unknown severity"),
            *times("epoch_us(cve.published_at)", "record.cve.published_at"), *times("epoch_us(cve.modified_at)", "record.cve.modified_at"),
        ]) + " union all select 'cve', record_id, 'record.cve.cwe[' || (i - 1) || ']', 'no CWE id' from (select record_id, unnest(cve.cwe) as w, generate_subscripts(cve.cwe, 1) as i from cve_records) where not coalesce(regexp_full_match(w, 'CWE-[0-9]+'), false) union all " + record_rules("breach", [
            (f"breach is not null and coalesce({trim('breach.name')}, '') = ''", "'record.breach.name'", "required"), ("breach.record_count < 0", "'record.breach.record_count'", "negative"),
            *times("epoch_us(breach.disclosed_at)", "record.breach.disclosed_at"), *times("epoch_us(breach.breach_date::timestamp)", "record.breach.breach_date"),
        ]),
        "seen_windows": f"with {ONCE}, b as (select record_id, context as c, default_context as d, epoch_us(coalesce(observed_at, collected_at)) as seen from indicator_records join e using (envelope_id)) select record_id, least(seen, {FIRST}) as first_us, greatest(seen, {LAST}) as last_us from b",
        "empty_contexts": f"""with {ONCE}, b as (select record_id, context as c, default_context as d from indicator_records join e using (envelope_id))
            select record_id from b where coalesce({own("first_seen", True)}, '') = '' and coalesce({own("last_seen", True)}, '') = '' and ({own("confidence")}) is null and coalesce(len({TAGS}), 0) = 0 and coalesce({own("tlp", True)}, '') = ''
                and coalesce(len({members.format('c')}), 0) + coalesce(len({members.format('d')}), 0) = 0""",
        "drop_gate": f"""with {RECORDS}, n as (select seq as envelope_id, count(*) as n_records, count(reason) as n_dropped from r group by 1)
            select *, round(n_dropped / n_records, 9) as ratio, n_dropped / n_records > 0.25 or n_dropped = n_records as rejected from n""",
        "drops_by_reason": f"with {RECORDS} select source, reason, count(*) as n from r where reason is not null group by 1, 2",
        "entity_registry": f"""with {RECORDS}, {EDGES}, y as (select kind, key, first_us, last_us from r where reason is null union all select kind, key, first_us, last_us from x)
            select {entity("kind", "key")} as entity_id, kind, key as canonical_key, min(first_us) as first_us, max(last_us) as last_us from y group by kind, key""",
        "indicator_fold": f"""with {RECORDS}, w as (select key, seq, max((idx, type, key, nullif(nullif(raw, ''), key))) as m from r where kind = 'indicator' and reason is null group by 1, 2),
                y as (select key, seq, m[2] as type, m[4] as raw from w)
            select {entity("'indicator'", "key")} as entity_id, arg_max(type, seq) as type, key as value, arg_max(raw, seq) filter (raw is not null) as raw_value from y group by key""",
        "edge_fold": f"""with {ONCE}, {EDGES},
                r as (select seq, idx, {entity("sk", "s")} as source_id, {entity("tk", "t")} as target_id, type, case when isfinite(confidence) then confidence::float end as confidence, case when len(json_keys(metadata)) > 0 then metadata end as metadata, least(x1, x2) as a, greatest(x1, x2) as b from g),
                w as (select seq, source_id, target_id, type, min(a) as first_us, max(b) as last_us, arg_min(confidence, idx) filter (confidence is not null) as confidence, arg_min({{'m': metadata}}, idx).m as metadata from r where source_id <> target_id group by 1, 2, 3, 4),
                k as (select seq, source_id, target_id, type, metadata, unnest(json_keys(metadata)) as k from w),
                l as (select source_id, target_id, type, k, arg_max(json_extract(metadata, '$."' || k || '"'), seq) as v from k group by 1, 2, 3, 4),
                m as (select source_id, target_id, type, '{{' || string_agg('"' || k || '":' || v, ',' order by k) || '}}' as m from l group by 1, 2, 3),
                f as (select source_id, target_id, type, min(first_us) as first_us, max(last_us) as last_us, arg_max(confidence, seq) filter (confidence is not null) as confidence, count(*) as n, count(metadata) as nm from w group by 1, 2, 3)
            select f.source_id, f.target_id, f.type, first_us, last_us, confidence, case when n = 1 and nm = 0 then null else coalesce(m, '{{}}') end as metadata from f left join m on f.source_id = m.source_id and f.target_id = m.target_id and f.type is not distinct from m.type""",
        "lookup_table": lookup("true", entity("'indicator'", "f.value") + " as entity_id, "),
        "lookup_state": lookup("true", entity("'indicator'", "f.value") + " as entity_id, "),
        "written_counts": f"""with {RECORDS}, {EDGES}, k as (select seq, kind, key from r where reason is null),
                y as (select distinct * from (select * from k union all select seq, kind, key from x)), m as (select distinct * from (select * from k union all select seq, kind, key from x where kind in ('indicator', 'cve'))),
                w as (select distinct seq, sk, s, tk, t, type from g where (sk, s) <> (tk, t)),
                z as (select seq, 'entity' as t from y union all select seq, kind from m union all select seq, 'relationship' from w union all select seq, 'sighting' from k)
            select seq as envelope_id, t as table, count(*) as n from z group by 1, 2""",
        "lookup_hashes": lookup(f"type in {HASHES}", ""),
        "stub_rows": f"""with {RECORDS}, {EDGES}, y as (select seq, kind, key, unnest(min({{'place': place, 'type': type}})) from x where kind in ('indicator', 'cve') group by 1, 2, 3)
            select seq, kind, key, type, place from y anti join (select seq, kind, key from r where reason is null) using (seq, kind, key)""",
        "breach_domains": f"""with {INDICATORS}, {observed("d", "breach_records", "record_id, breach", "'domain'", "breach.domain")}, n as (select value, count(*) as n from o where type = 'domain' group by 1)
            select record_id, coalesce(d.value, nullif(breach.domain, '')) as domain, coalesce(n, 0) as n_records from d left join n on n.value = coalesce(d.value, nullif(breach.domain, ''))""",
        "self_edges": f"with {NUMBERED}, {endpoints('n', 'q', 'i, edge_id')} select a.edge_id from n a join n b using (i) where a.place = 0 and b.place = 1 and a.kind = b.kind and a.key = b.key",
        "node_degrees": f"with {NODES}, x as (select s as node, 1 as o, 0 as i from p union all select t, 0, 1 from p) select node, sum(o)::bigint as n_out, sum(i)::bigint as n_in from x group by 1",
        "two_hops": f"with {NODES} select a.s as node, count(*) as n_paths from p a join p b on a.t = b.s group by 1",
        "reachable": f"with recursive {NODES}, r as (select distinct s as node, 0 as hops from p where starts_with(s, 'cve:') union select p.t, r.hops + 1 from r join p on p.s = r.node where r.hops < 3) select node, min(hops) as hops from r group by 1",
        "similar_values": rf"""with {INDICATORS}, n as (select value as t, max(record_id % 50 = 0) as q from o where value is not null group by 1),
                w as (select distinct t, q, unnest(list_filter(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) as w from n),
                h as (select distinct t, q, unnest(list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i::int, 3))) as g from w),
                c as (select t, count(*) as n from (select distinct t, g from h) group by 1),
                p as (select a.t as query, b.t as text, count(*) as shared from (select distinct t, g from h where q) a join (select distinct t, g from h) b using (g) where a.t <> b.t group by 1, 2)
            select query, text, round(shared / (x.n + y.n - shared), 6) as similarity from p join c x on x.t = query join c y on y.t = text where shared * 2 >= x.n + y.n - shared""",
    }
