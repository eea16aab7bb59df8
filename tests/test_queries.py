"""Registered queries against brute force by the scalar rules, on own small tables."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sightline import queries_reference as Q
from sightline.functions import scalar

END = "struct<kind:string,type:string,value:string>"
IP = ["10.1.2.3", "10[.]1[.]2[.]3", "::ffff:10.1.2.3"]
EDGES = [
    (("cve", None, "cve-2024-01234"), ("indicator", "auto", IP[0])), (("cve", None, " CVE-2024-1234 "), ("indicator", "auto", IP[1])), (("indicator", "ipv4", IP[1]), ("indicator", "auto", "MAL[.]example")),
    (("indicator", "auto", IP[2]), ("indicator", "domain", "mal.example.")), (("indicator", "auto", "mal.example"), ("breach", None, "Foo  Bär")), (("breach", None, "foo-bar"), ("cve", None, "CVE-2020-0001")),
    (("indicator", "auto", IP[0]), ("indicator", "ipv4", IP[2])), (("indicator", "auto", "mal.example"), ("indicator", "auto", "mal.example")), (("cve", None, "no id"), ("cve", None, "no id")),
    (("indicator", "auto", "no value"), ("indicator", "auto", IP[0])), (("thing", None, "x"), ("cve", None, "CVE-2020-0001")), (None, ("cve", None, "CVE-2020-0001")), (("cve", None, "CVE-2024-1234"), ("cve", None, None)),
]


def node(end):
    kind, declared, value = end or (None, None, None)
    if kind == "indicator":
        seen = scalar.observable(declared, value)
        key = seen and seen[1]
    else:
        key = {"cve": scalar.cve_id, "breach": scalar.slugify}[kind](value) if kind in ("cve", "breach") and value else None
    return f"{kind}:{key}" if key else None


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("graph"))
    rows = [(i, *e) for i, e in enumerate(EDGES)]
    spark.createDataFrame(rows, f"edge_id long, source {END}, target {END}").write.parquet(f"{d}/relationship.parquet")
    return d, {(a, b) for a, b in ((node(s), node(t)) for s, t in EDGES) if a and b}


def test_graph_of_entities(spark, graph):
    d, pairs = graph
    assert len(pairs) == 6  # spellings meet
    out, back = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    assert {tuple(r) for r in Q.node_degrees(spark, d).collect()} == {(n, out[n], back[n]) for n in out | back}
    ways = Counter(a for a, b in pairs for c, _ in pairs if b == c)
    assert {tuple(r) for r in Q.two_hops(spark, d).collect()} == set(ways.items())
    hops = {a: 0 for a, _ in pairs if a.startswith("cve:")}
    for i in (1, 2, 3):
        hops = {b: i for a, b in pairs if hops.get(a) == i - 1} | hops
    assert "breach:foo-bar" in hops and {tuple(r) for r in Q.reachable(spark, d).collect()} == set(hops.items())


TIME = "2025-01-02T03:04:05Z"
CONTEXT = "struct<first_seen:string,last_seen:string,confidence:double,tags:array<string>,tlp:string,attributes:string>"
DEFAULTS = {1: ("2024-12-01T00:00:00Z", None, 0.7, ["feed"], "green", None), 2: None, 3: (None, None, None, [], "", "{}"), 4: (None, None, 0.2, None, None, None), 5: None}
MD5, SHA1 = "0123456789abcdef" * 2, "0123456789abcdef0123" * 2
INDICATORS = [  # envelope, context, type, raw value
    (1, None, "auto", "mal[.]example"), (1, (None, None, 0.9, ["own", "feed"], None, None), "md5", MD5.upper()), (1, None, "auto", MD5), (1, (None, None, None, None, None, None), "auto", "::ffff:10.1.2.3"),
    (2, None, "auto", "no value"), (2, None, "md5", "no"), (2, (None, None, None, ["x"], None, None), "auto", MD5), (2, None, "sha1", "sha1:" + SHA1), (2, None, "ipv4", "::ffff:10[.]1[.]2[.]3"), (2, None, "auto", "2001:db8::1"),
    (3, None, "auto", "10.1.2.3"), (3, ("", "", None, [], "", "{}"), "auto", "mal.example"), (3, None, "", SHA1), (4, None, "auto", "no value"), (4, None, "sha1", "no"), (4, ("2024-01-01T00:00:00Z", None, None, None, None, None), "auto", "a@mal.example"),
    (4, None, "ipv4", "10.1.2.3:80"), (5, None, "auto", "http://mal.example:80"), (5, None, "auto", "mal.example."), (5, None, "auto", "x.example"), (5, None, "domain", "no value"), (5, None, None, None),
]
CVES = [(1, "cve-2024-1234"), (1, "bad"), (4, "CVE-2024-1"), (5, "bad")]
BREACHES = [(2, None, "Foo"), (4, None, "!!"), (5, "foo", "x")]


@pytest.fixture(scope="module")
def domain(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("domain"))
    save = lambda rows, schema, name, **more: spark.createDataFrame(rows, schema).withColumns(more).write.parquet(f"{d}/{name}.parquet")
    at = F.lit(TIME).cast("timestamp")
    save([(k, v, None, None) for k, v in DEFAULTS.items()] * 2, f"envelope_id long, default_context {CONTEXT}, content_hash string, raw_ref string", "envelopes", collected_at=at, received_at=at)
    base = "record_id long, envelope_id long, record_index int, source_slug string"
    save([(i, e, i, " Feed-A", c, (t, v)) for i, (e, c, t, v) in enumerate(INDICATORS)], f"{base}, context {CONTEXT}, indicator struct<type:string,raw_value:string>", "indicator_records", observed_at=at, kind=F.lit("indicator"))
    cve = "struct<cve_id:string,summary:string,published_at:timestamp,modified_at:timestamp>"
    save([(i, e, 100 + i, "b", (v, None, None, None)) for i, (e, v) in enumerate(CVES)], f"{base}, cve {cve}", "cve_records", observed_at=at, kind=F.lit("cve"))
    breach = "struct<slug:string,name:string,breach_date:date,disclosed_at:timestamp>"
    save([(i, e, 200 + i, "b", (s, n, None, None)) for i, (e, s, n) in enumerate(BREACHES)], f"{base}, breach {breach}", "breach_records", observed_at=at, kind=F.lit("breach"))
    return d


def test_gate_of_all_records(spark, domain):
    keys = [(e, scalar.observable(t, v)) for e, _, t, v in INDICATORS] + [(e, scalar.cve_id(v)) for e, v in CVES] + [(e, scalar.breach_slug(s, n, None, None)) for e, s, n in BREACHES]
    found = defaultdict(list)
    for e, key in keys:
        found[e].append(key is None)
    want = {(e, len(x), sum(x), round(sum(x) / len(x), 9), sum(x) > 0.25 * len(x)) for e, x in found.items()}
    got = {(r["envelope_id"], r["n_records"], r["n_dropped"], r["ratio"], r["rejected"]) for r in Q.drop_gate(spark, domain).collect()}
    assert got == want and {r[4] for r in want} == {True, False}


def test_self_edges_of_entities(spark, graph):
    want = {i for i, (s, t) in enumerate(EDGES) if node(s) and node(s) == node(t)}
    assert want == {6, 7} and {r["edge_id"] for r in Q.self_edges(spark, graph[0]).collect()} == want


def test_mapped_addresses_are_ipv4(spark, domain):
    seen = [(i, scalar.observable(t, v)) for i, (_, _, t, v) in enumerate(INDICATORS)]
    want = {(i, x[1]) for i, x in seen if x and x[0] == "ipv4"}
    assert {3, 8, 10} <= {i for i, _ in want} and {tuple(r) for r in Q.ipv4_values(spark, domain).collect()} == want


def effective(default, own):
    """(first_seen, last_seen, confidence, tags, whether anything is set): the record's own wins, its tags are added."""
    blank = (None,) * 6
    d, o = default or blank, own or blank
    tags = list(dict.fromkeys([*(d[3] or []), *o[3]])) if o[3] else list(d[3] or [])
    plain = [o[i] or d[i] for i in (0, 1, 4)]
    confidence = d[2] if o[2] is None else o[2]
    return plain[0], plain[1], confidence, tags, any(plain) or confidence is not None or bool(tags)


def test_default_context_counts(spark, domain):
    found = [effective(DEFAULTS[e], c) for e, c, _, _ in INDICATORS]
    empty = {i for i, x in enumerate(found) if not x[4]}
    assert {4, 10, 11} <= empty and 0 not in empty and 13 not in empty
    assert {r["record_id"] for r in Q.empty_contexts(spark, domain).collect()} == empty
    micros = lambda x: spark.sql(f"select unix_micros(timestamp '{x}')").first()[0]
    at = micros(TIME)
    windows = {(i, min(at, micros(x[0])) if x[0] else at, max(at, micros(x[1])) if x[1] else at) for i, x in enumerate(found)}
    assert {tuple(r) for r in Q.seen_windows(spark, domain).collect()} == windows


def test_hashes_by_canonical_type(spark, domain):
    seen = [scalar.observable(t, v) or (None, None) for _, _, t, v in INDICATORS]
    want = {(i, *x) for i, x in enumerate(seen) if x[0] in Q.HASHES or INDICATORS[i][2] in Q.HASHES}
    assert {(2, "md5", MD5), (5, None, None), (12, "sha1", SHA1)} <= want and {tuple(r) for r in Q.hash_values(spark, domain).collect()} == want
    got = {(r["type"], r["value"]): r for r in Q.lookup_hashes(spark, domain).collect()}
    assert set(got) == {x for x in seen if x[0] in Q.HASHES}
    assert (got["md5", MD5]["tags"], got["md5", MD5]["confidence"], got["md5", MD5]["sources"]) == ("feed|own|x", 0.9, "feed-a")
    whole = Q.lookup_table(spark, domain).where(F.col("type").isin(*Q.HASHES)).drop("entity_id")
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in got.values()}


def test_similar_canonical_values(spark, tmp_path):
    raw = ["mal[.]example", "MAL.example", "mall.example", "10.1.2.3", "10[.]1[.]2[.]30", "no value", "http://mal.example:80", "other.test", "mal.example.org", None]
    rows = [(50 * i if i < 4 else 50 * i + 1, ("auto", v)) for i, v in enumerate(raw)]
    spark.createDataFrame(rows, "record_id long, indicator struct<type:string,raw_value:string>").write.parquet(f"{tmp_path}/indicator_records.parquet")
    grams = lambda t: {f"  {w} "[i : i + 3] for w in re.split("[^a-z0-9]+", t) if w for i in range(len(w) + 1)}
    seen = [(i, scalar.observable("auto", v)[1]) for i, (_, v) in rows if scalar.observable("auto", v)]
    asked, texts = {v for i, v in seen if i % 50 == 0}, {v for _, v in seen}
    want = {(a, b) for a in asked for b in texts if a != b and 2 * len(grams(a) & grams(b)) >= len(grams(a) | grams(b))}
    assert ("mal.example", "http://mal.example/") in want and {(r["query"], r["text"]) for r in Q.similar_values(spark, str(tmp_path)).collect()} == want
