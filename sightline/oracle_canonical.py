"""Canonical observables in SQL for DuckDB: what `functions/scalar.py` does, for hosts in ASCII.

SQL has no mapping of international names; hosts in other scripts or in punycode, percent escapes and addresses in
brackets have no value here (the given tables hold none). They are tested against the scalar rules instead.
"""

from __future__ import annotations

from sightline.functions.scalar import DEFAULT_PORT, HEX_LENGTH, OCTET
from sightline.oracle_reference import cve_key, defang, slugify

QUAD = rf"{OCTET}(?:\.{OCTET}){{3}}"
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"


def _when(pairs: list[tuple[str, str]], other: str = "null") -> str:
    return "case " + " ".join(f"when {a} then {b}" for a, b in pairs) + f" else {other} end"


def _labels(host: str, form: str) -> str:
    """Whether all labels of a host have the form and no hyphens at an end or at places 3 and 4."""
    return f"len(list_filter(string_split({host}, '.'), lambda x: not (regexp_full_match(x, '{form}') and x[1] <> '-' and right(x, 1) <> '-' and not (length(x) > 4 and substr(x, 3, 2) = '--')))) = 0"


def _domain(host: str) -> str:
    return f"(length({host}) <= 253 and contains({host}, '.') and {_labels(host, '[a-z0-9_-]{1,63}')})"


def observed(name: str, source: str, keep: str, kind: str, raw: str) -> str:
    """Named tables, the last being `name`: the columns of `keep`, type and value of each row of `source`, both null
    where there is no canonical form."""
    n = name
    runs = [(f"contains(s6, repeat(':0', {k}) || ':')", f"substr(left(s6, instr(s6, repeat(':0', {k}) || ':') - 1), 2) || '::' || rtrim(substr(s6, instr(s6, repeat(':0', {k}) || ':') + {2 * k + 1}), ':')") for k in range(8, 1, -1)]
    port = _when([(f"scheme = '{s}'", f"'{p}'") for s, p in DEFAULT_PORT.items()])
    infer = _when(
        [
            *[(f"regexp_full_match(v, '[0-9a-fA-F]{{{size}}}')", f"'{t}'") for t, size in HEX_LENGTH.items()],
            ("sch", "'url'"), ("ip4 is not null", "'ipv4'"), ("ip6 is not null", "'ipv6'"), ("net is not null", "'cidr'"), ("contains(v, '@')", "'email'"), ("contains(v, '/')", "'url'"),
            (r"contains(v, '.') and not regexp_matches(v, '[ \t?#:]') and domain is not null", "'domain'"),
        ]
    )
    hashes = [(f"t = '{t}'", f"case when regexp_full_match(regexp_replace(v, '^{t}:', '', 'i'), '[0-9a-fA-F]{{{size}}}') then lower(regexp_replace(v, '^{t}:', '', 'i')) end") for t, size in HEX_LENGTH.items()]
    values = _when([("t = 'ipv4'", "ip4"), ("t = 'ipv6'", "ip6"), ("t = 'cidr'", "net"), ("t = 'domain'", "domain"), ("t = 'url'", "url"), ("t = 'email'", "email"), *hashes])
    return rf"""
    {n}_0 as (select {keep}, coalesce(nullif({kind}, ''), 'auto') as k, {defang(raw)} as v from {source}),
    {n}_1 as (select *, regexp_matches(v, '{SCHEME}') as sch, contains(v, '/') as cut, case when contains(v, '/') then regexp_replace(v, '/[^/]*$', '') else split_part(v, '%', 1) end as addr,
                     regexp_extract(v, '/(0|[1-9][0-9]?[0-9]?)$', 1) as bits, case when regexp_matches(v, '{SCHEME}') then v else 'http://' || v end as u from {n}_0),
    {n}_2 as (select *, lower(case when regexp_full_match(addr, '[0-9a-fA-F:]*:{QUAD}') then regexp_replace(addr, '[0-9.]+$', '') ||
                         printf('%x:%x', split_part(regexp_extract(addr, '[0-9.]+$'), '.', 1)::int * 256 + split_part(addr, '.', 2)::int, split_part(addr, '.', 3)::int * 256 + split_part(addr, '.', 4)::int) else addr end) as a6,
                     case when regexp_full_match(addr, '{QUAD}') then list_transform(string_split(addr, '.'), lambda x: x::bigint) end as n4, case when bits <> '' and not contains(addr, '%') then bits::int end as b,
                     split_part(u, '#', 1) as u1 from {n}_1),
    {n}_3 as (select *, case when not regexp_full_match(a6, '[0-9a-f:]*:[0-9a-f:]*') or contains(a6, ':::') then null when len(string_split(a6, '::')) = 1 then string_split(a6, ':') when len(string_split(a6, '::')) > 2 then null else
                         list_concat(list_concat(list_filter(string_split(split_part(a6, '::', 1), ':'), lambda x: x <> '' or starts_with(a6, ':') and not starts_with(a6, '::')),
                             case when len(string_split(trim(a6, ':'), ':')) - 1 <= 8 then list_transform(range(8 - len(list_filter(string_split(a6, ':'), lambda x: x <> ''))), lambda x: '0') end),
                             list_filter(string_split(split_part(a6, '::', 2), ':'), lambda x: x <> '' or ends_with(a6, ':') and not ends_with(a6, '::'))) end as g,
                     lower(split_part(u1, '://', 1)) as scheme, substr(u1, strpos(u1, '://') + 3) as rest from {n}_2),
    {n}_4 as (select *, case when len(g) = 8 and len(list_filter(g, lambda x: regexp_full_match(x, '[0-9a-f]{{1,4}}'))) = 8 and (not contains(a6, '::') or len(list_filter(string_split(a6, ':'), lambda x: x <> '')) < 8)
                         then list_transform(g, lambda x, i: ('0x' || x)::bigint & (65536 - (1 << (16 - greatest(0, least(16, coalesce(b, 128) - 16 * (i - 1))))))) end as n6,
                     split_part(rest, '?', 1) as r1, case when contains(rest, '?') then substr(rest, strpos(rest, '?') + 1) else '' end as query from {n}_3),
    {n}_5 as (select *, coalesce(n6[1:5] = [0, 0, 0, 0, 0] and n6[6] = 65535, false) as mapped, ':' || array_to_string(list_transform(n6, lambda x: printf('%x', x)), ':') || ':' as s6, split_part(r1, '/', 1) as authority,
                     substr(r1, length(split_part(r1, '/', 1)) + 1) as path from {n}_4),
    {n}_6 as (select *, {_when(runs, "trim(s6, ':')")} as f6, regexp_extract(authority, '([^@]*)$', 1) as hp, case when contains(authority, '@') then regexp_replace(authority, '[^@]*$', '') else '' end as usr from {n}_5),
    {n}_7 as (select *, case when cut then null when n4 is not null then addr when mapped then concat_ws('.', n6[7] >> 8, n6[7] & 255, n6[8] >> 8, n6[8] & 255) end as ip4, case when not cut and not mapped then f6 end as ip6,
                     case when n4 is not null and b <= 32 then array_to_string(list_transform(n4, lambda x, i: x & (256 - (1 << (8 - greatest(0, least(8, b - 8 * (i - 1))))))), '.') || '/' || b when n6 is not null and b <= 128 then f6 || '/' || b end as net,
                     hp <> '' and not regexp_matches(u, '[%\x00-\x1F\x7F]') and regexp_full_match(usr, '[a-zA-Z0-9_.~$&+,;=:@-]*') and regexp_full_match(hp, '[a-zA-Z0-9_.~!$&''()*+,;=:<>"-]*') and regexp_full_match(hp, '[^:]*|.*:[0-9]*')
                         and regexp_full_match(path, '[a-zA-Z0-9_.~$&+,/:;=@!''()*\[\]-]*') as fit,
                     lower(case when regexp_full_match(hp, '[^:]*:[0-9]*') then split_part(hp, ':', 1) else hp end) as host, case when regexp_full_match(hp, '[^:]*:[0-9]*') then split_part(hp, ':', 2) else '' end as port from {n}_6),
    {n}_8 as (select *, list_reduce(list_transform(list_filter(string_split(path, '/'), lambda x: x not in ('', '.')), lambda x: [x]), lambda a, x: case when x[1] = '..' then a[1:len(a) - 1] else list_concat(a, x) end, []::varchar[]) as segments,
                     regexp_replace(regexp_extract(regexp_extract(case when sch and fit then hp else v end, '^([^/?#]*)', 1), '([^@]*)$', 1), '\.$', '') as d from {n}_7),
    {n}_9 as (select *, lower(case when regexp_full_match(d, '[^:]*:(?:[+-]?[0-9]+)?') then split_part(d, ':', 1) else d end) as dh, regexp_replace(regexp_extract(v, '([^@]*)$', 1), '\.$', '') as eh, regexp_replace(v, '@?[^@]*$', '') as local,
                     case when fit and {_labels('host', '.*')} then scheme || '://' || usr || case when contains(host, ':') then '[' || host || ']' else host end || case when port <> '' and {port} is distinct from port then ':' || port else '' end ||
                         '/' || array_to_string(segments, '/') || case when len(segments) > 0 and ends_with(path, '/') then '/' else '' end || case when query <> '' then '?' || query else '' end end as url from {n}_8),
    {n}_10 as (select *, case when {_domain('dh')} and not regexp_full_match(dh, '{QUAD}') then dh end as domain, case when local <> '' and contains(v, '@') and {_domain('lower(eh)')} then lower(local) || '@' || lower(eh) end as email from {n}_9),
    {n}_11 as (select *, case when k = 'auto' then {infer} else k end as t from {n}_10),
    {n}_12 as (select *, case when v <> '' then {values} end as value from {n}_11),
    {n} as (select {', '.join(x.split(' as ')[-1].split('.')[-1] for x in keep.split(', '))}, case when value is not null then t end as type, value from {n}_12)"""


def endpoints(name: str, source: str, keep: str) -> str:
    """Named tables, the last being `name`: the columns of `keep` and kind, key and type of both ends of edges (place 0:
    the source, 1: the target); a null key where an end has no canonical form."""
    ends = f"{name}_e as (select {keep}, 0 as place, source as x from {source} union all select {keep}, 1, target from {source})"
    return f"""{ends}, {observed(f"{name}_o", f"{name}_e", f"{keep}, place, x", "x.type", "case when x.kind = 'indicator' then x.value end")},
    {name} as (select {keep}, place, x.kind as kind, case x.kind when 'indicator' then value when 'cve' then {cve_key("x.value")} when 'breach' then nullif({slugify("x.value")}, '') end as key, type from {name}_o)"""

