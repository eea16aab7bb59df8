"""Canonical forms: own sample values for each rule, and laws that hold for all values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.functions import columns as C
from sightline.functions import scalar as S

CASES = [
    ("auto", "mal[.]example", ("domain", "mal.example")), ("auto", "mal{DOT}example", ("domain", "mal.example")), ("auto", "mal(punto)example", ("domain", "mal.example")),
    ("auto", "mal\\.example", ("domain", "mal.example")), ("auto", "<mal.example>", ("domain", "mal.example")), ("auto", "\u2003mal.example.\n", ("domain", "mal.example")),
    ("auto", "hxxps[:]//mal[.]example[/]x", ("url", "https://mal.example/x")), ("auto", "h**p://mal.example", ("url", "http://mal.example/")), ("auto", "fxp[://]mal.example/f", ("url", "ftp://mal.example/f")),
    ("url", "http://mal.example/hxxp/x", ("url", "http://mal.example/hxxp/x")), ("auto", "192[.]0[.]2[.]7", ("ipv4", "192.0.2.7")), ("auto", "::ffff:192.0.2.7", ("ipv4", "192.0.2.7")),
    ("ipv6", "2001:0DB8:0:0:0:0:0:1", ("ipv6", "2001:db8::1")), ("auto", "fe80::1%en0", ("ipv6", "fe80::1")), ("auto", "10.9.8.7/8", ("cidr", "10.0.0.0/8")), ("cidr", "2001:db8::7/32", ("cidr", "2001:db8::/32")),
    ("cidr", "10.0.0.0/08", None), ("cidr", "10.0.0.0", None), ("domain", "münchen.example", ("domain", "xn--mnchen-3ya.example")), ("domain", "XN--MNCHEN-3YA.EXAMPLE", ("domain", "xn--mnchen-3ya.example")),
    ("domain", "mal.example:8080", ("domain", "mal.example")), ("auto", "mal.example:8080", None), ("domain", "https://u@mal.example/x?y", ("domain", "mal.example")), ("domain", "_dmarc.mal.example", ("domain", "_dmarc.mal.example")),
    ("domain", "-mal.example", None), ("domain", "ab--cd.example", None), ("domain", "intranet", None), ("domain", "192.0.2.7", None), ("domain", "a" * 64 + ".example", None),
    ("url", "HTTPS://Mal.Example:443/A", ("url", "https://mal.example/A")), ("url", "http://mal.example:081/", ("url", "http://mal.example:081/")), ("url", "http://mal.example/a/./b/../c//d/", ("url", "http://mal.example/a/c/d/")),
    ("url", "http://mal.example/a?B=1#part", ("url", "http://mal.example/a?B=1")), ("url", "http://mal.example/a b", ("url", "http://mal.example/a%20b")), ("url", "http://mal.example/%zz", None),
    ("url", "http://[2001:0db8::1]:80/a", ("url", "http://[2001:db8::1]/a")), ("url", "http://[mal]/a", None), ("url", "http:///a", None), ("url", "http://User:Pw@mal.example/", ("url", "http://User:Pw@mal.example/")),
    ("email", "A.B+c@MAL.example.", ("email", "a.b+c@mal.example")), ("auto", "a[at]mal[.]example", ("email", "a@mal.example")), ("email", "a@", None), ("email", "@mal.example", None),
    ("md5", "MD5:" + "AB" * 16, ("md5", "ab" * 16)), ("auto", "AB" * 20, ("sha1", "ab" * 20)), ("md5", "zz" * 16, None), ("sha256", "ab" * 16, None), ("ipv4", "2001:db8::1", None), ("ipv4", "300.1.1.1", None),
    ("auto", "some words", None), ("auto", "", None), ("auto", None, None), (None, "mal.example", ("domain", "mal.example")), ("hostname", "mal.example", None),
]


@pytest.mark.parametrize(("kind", "raw", "want"), CASES)
def test_observable(kind, raw, want):
    assert S.observable(kind, raw) == want


def test_columns_agree_with_scalar(spark):
    rows = spark.createDataFrame([(i, k, r) for i, (k, r, _) in enumerate(CASES)], "i int, kind string, raw string")
    got = {r["i"]: r["seen"] for r in C.with_observable(rows, "seen", F.col("kind"), F.col("raw")).collect()}
    for i, (_, _, want) in enumerate(CASES):
        assert (tuple(got[i]) if got[i] and got[i]["value"] is not None else None) == want, CASES[i]


def test_columns_agree_on_the_data(spark, sf):
    rows = spark.read.parquet(f"{sf}/indicator_records.parquet").select("indicator.type", "indicator.raw_value")
    for r in C.with_observable(rows, "seen", F.col("type"), F.col("raw_value")).collect():
        assert (S.observable(r["type"], r["raw_value"]) or (None, None)) == tuple(r["seen"] or (None, None))


@given(st.text(alphabet="aB1.-_/:@[]()%?# \\x*é", max_size=24))
@settings(max_examples=400, deadline=None)
def test_canonical_forms_stay(raw):
    first = S.observable("auto", raw)
    if first is not None and first[0] != "url":
        assert S.observable(*first) == first


@given(st.sampled_from(["mal.example", "www.a-b.test", "http://mal.example/a?b=1", "a.b@mal.example", "192.0.2.1"]), st.data())
@settings(max_examples=150, deadline=None)
def test_disarmed_spellings_meet(value, data):
    dots = [data.draw(st.sampled_from([".", "[.]", "(dot)", "{ . }", "\\."])) for _ in range(value.count("."))]
    parts = value.split(".")
    raw = parts[0] + "".join(d + p for d, p in zip(dots, parts[1:]))
    raw = data.draw(st.sampled_from(["", " ", "\t", "\u00a0"])) + data.draw(st.sampled_from(["", "'", "<"])) + raw.replace("http:", data.draw(st.sampled_from(["http:", "hxxp:", "HXXP[:]", "h**p:"]))) + "\n"
    assert S.observable("auto", raw) == S.observable("auto", value)


def test_ids_and_slugs(spark):
    rows = [(" cve-2024-0003094\n", "CVE-2024-3094"), ("CVE-2024-0001", "CVE-2024-0001"), ("CVE-2024-1234567", "CVE-2024-1234567"), ("CVE-24-3094", None), ("CVE-2024-309", None), (None, None), ("CVE-2024-3094\nx", None)]
    got = spark.createDataFrame(rows, "c string, want string").withColumn("got", C.cve_id(F.col("c"))).collect()
    assert all(r["got"] == r["want"] == S.cve_id(r["c"]) for r in got)
    texts = ["Foo  Bar, Inc.", "Café Ñandú", "---", "", None, "x" * 250, "a-" * 120, "日本 9"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("got", C.slugify(F.col("t"))).collect()
    assert [r["got"] for r in got] == [S.slugify(t) for t in texts]
    rows = [(None, "Foo", 2020, 2021, "foo-2020"), ("", "Foo", None, 2021, "foo-2021"), ("A b", "Foo", 2020, None, "a-b"), (None, "!!", 2020, None, None), (None, "Foo", None, None, "foo")]
    got = spark.createDataFrame(rows, "s string, n string, b int, d int, want string").withColumn("got", C.breach_slug(F.col("s"), F.col("n"), F.col("b"), F.col("d"))).collect()
    assert all(r["got"] == r["want"] == S.breach_slug(r["s"], r["n"], r["b"], r["d"]) for r in got)


def test_times(spark):
    rows = [("2025-01-02T03:04:05Z", 1735787045000000), ("2025-01-02T03:04:05.123456789+01:00", 1735783445123456), ("2025-01-02", None), ("2025-01-02T03:04:05", None), ("unknown", None), (None, None), ("2025-13-02T03:04:05Z", None)]
    got = spark.createDataFrame(rows, "t string, want long").withColumn("got", C.rfc3339_micros(F.col("t"))).collect()
    assert all(r["got"] == r["want"] for r in got)
