"""Context, validation, folds, graph, metrics, store and stream on own small fixtures."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sightline import api
from sightline.operators import alerts, build, context, folds, fuzzy, graph, lookup, metrics, validate
from sightline.plans.intake import process
from sightline.plans.schemas import CONTEXT, ENVELOPE, MAX_SOURCE_BYTES, MAX_TAG_BYTES, MAX_TAGS, MAX_VALUE_BYTES, VERSION
from sightline.plans.store import Pending, Store
from sightline.sources import archive, dead_letters, envelopes, registry

NOW = "2025-06-01T00:00:00Z"


def doc(**more):
    return {"schema_version": "1.0", "source": "feed-a", "collected_at": "2025-01-02T03:04:05Z", "records": [{"kind": "indicator", "indicator": {"type": "auto", "raw_value": "mal.example"}}]} | more


def problems(spark, *docs):
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(docs)], "i int, t string").withColumn("e", F.from_json("t", ENVELOPE))
    found = rows.select("i", validate.envelope_problems(F.col("e"), F.lit(NOW).cast("timestamp")).alias("p")).orderBy("i").collect()
    return [[p["path"] for p in r["p"]] for r in found]


CVE = {"kind": "cve", "cve": {"cve_id": "CVE-2024-1234"}}


def record(kind, context=None, **payload):
    return {"kind": kind, kind: payload} | ({"context": context} if context else {})


def edge(source=("cve", "CVE-2024-1234"), target=("indicator", "mal.example"), **more):
    return {"source": dict(zip(("kind", "value", "type"), source)), "target": dict(zip(("kind", "value", "type"), target)), "type": "exploits"} | more


# What is broken, by the place at which it has to be reported.
BROKEN = {
    "relationships[1].type": doc(relationships=[edge(), edge(type="likes")]),
    "relationships[0].confidence": doc(relationships=[edge(confidence=-0.1)]),
    "relationships[0].target.kind": doc(relationships=[edge(target=("actor", "x"))]),
    "relationships[0].source.value": doc(relationships=[edge(source=("cve", ""))]),
    "relationships[0].target.type": doc(relationships=[edge(target=("breach", "shop-2020", "domain"))]),
    "relationships[0].source.type": doc(relationships=[edge(source=("indicator", "mal.example", "hostname"))]),
    "records": doc(records=[]),
    "records[1].kind": doc(records=[CVE, {"kind": "malware"}]),
    "records[1].cve": doc(records=[CVE, {"kind": "cve"}]),
    "records[0].breach": doc(records=[CVE | {"breach": {"name": "Shop"}}]),
    "records[0].observed_at": doc(records=[CVE | {"observed_at": "1961-04-12T06:07:00Z"}]),
    "records[0].indicator.type": doc(records=[record("indicator", type="asn", raw_value="AS64496")]),
    "records[0].indicator.raw_value": doc(records=[record("indicator", type="url", raw_value="ü" * (MAX_VALUE_BYTES // 2 + 1))]),
    "records[0].context.tags[2]": doc(records=[record("indicator", {"tags": ["a", "b", "ö" * (MAX_TAG_BYTES // 2 + 1)]}, type="auto", raw_value="mal.example")]),
    "records[0].context.tags": doc(records=[record("indicator", {"tags": [f"t{i}" for i in range(MAX_TAGS + 1)]}, type="auto", raw_value="mal.example")]),
    "records[0].cve.cve_id": doc(records=[record("cve", cve_id="CVE-24-77")]),
    "records[0].cve.epss_score": doc(records=[record("cve", cve_id="CVE-2021-7777", epss_score=1.01)]),
    "records[0].cve.cvss_score": doc(records=[record("cve", cve_id="CVE-2021-7777", cvss_score=-3)]),
    "records[0].cve.severity": doc(records=[record("cve", cve_id="CVE-2021-7777", severity="grave")]),
    "records[0].cve.cwe[0]": doc(records=[record("cve", cve_id="CVE-2021-7777", cwe=["CWE79"])]),
    "records[0].breach.name": doc(records=[record("breach", name="\t")]),
    "records[0].breach.record_count": doc(records=[record("breach", name="Shop", record_count=-70)]),
    "default_context.tlp": doc(default_context={"tlp": "purple"}),
    "default_context.confidence": doc(default_context={"confidence": 1.5}),
    "default_context.last_seen": doc(default_context={"first_seen": "2024-12-24T18:00:00+01:00", "last_seen": "2024-12-24T16:59:59Z"}),
    "raw.encoding": doc(raw={"data": "aa", "encoding": "base32"}),
    "raw.data": doc(raw={"data": "=a=", "encoding": "base64"}),
    "content_hash": doc(content_hash="md5:" + "0" * 64),
    "collected_at": doc(collected_at="2025-06-03T00:00:01Z"),
    "source": doc(source="feed a"),
    "schema_version": doc(schema_version="7.1"),
}
TWICE = doc(source="s" * (MAX_SOURCE_BYTES + 1), relationships=[edge(type=""), edge(source=("cve", "", "url"))])


def test_validation(spark):
    for path, got in zip(BROKEN, problems(spark, *BROKEN.values())):
        assert got == [path]
    assert sorted(problems(spark, TWICE)[0]) == ["relationships[0].type", "relationships[1].source.type", "relationships[1].source.value", "source"]  # all, not only the first
    fine = problems(spark, doc(), doc(schema_version="1.9", extra=1), doc(records=[CVE], default_context={"tlp": "amber+strict", "tags": ["a"]}))
    assert fine == [[], [], []]


def test_decoding_is_strict(spark):
    texts = [json.dumps(doc()), json.dumps(doc()) + " x", json.dumps(doc(records="x")), json.dumps(doc(collected_at="yesterday")), '{"SOURCE": "a", "Records": []}', "[1]", "", json.dumps(doc(default_context={"attributes": [1]})), '{"source": NaN}']
    files = spark.createDataFrame([(f"f{i}", bytearray(t.encode())) for i, t in enumerate(texts)], "path string, body binary").withColumn("modified", F.lit(NOW).cast("timestamp"))
    got = {r["path"]: r for r in envelopes.decoded(files).collect()}
    assert [got[f"f{i}"]["problem"] is None for i in (0, 1, 2, 3, 4, 5, 7, 8)] == [True, False, False, False, True, False, False, False]
    assert "f6" not in got and got["f4"]["e"]["source"] == "a" and len(got["f0"]["digest"]) == 64


def ctx(spark, default, own):
    row = spark.createDataFrame([(json.dumps(default) if default is not None else None, json.dumps(own) if own is not None else None)], "d string, o string")
    c = context.effective(F.from_json("d", CONTEXT), F.from_json("o", CONTEXT))
    return row.select(c.alias("c"), context.encoded(c).alias("j")).first()


def test_context(spark):
    got = ctx(spark, {"tags": ["a", "b"], "tlp": "green", "attributes": {"x": 1, "y": 2}}, {"tags": ["b", "c", "c"], "confidence": 0.5, "attributes": {"y": "two"}})
    assert got["c"]["tags"] == ["a", "b", "c"] and got["c"]["tlp"] == "green" and json.loads(got["c"]["attributes"]) == {"x": 1, "y": "two"}
    assert ctx(spark, None, {"tags": ["a", "a"]})["c"]["tags"] == ["a", "a"]
    assert ctx(spark, {"tags": ["a"]}, {"tags": []})["c"]["tags"] == ["a"]
    assert ctx(spark, {"tags": []}, None)["j"] is None and ctx(spark, None, None)["j"] is None
    assert json.loads(ctx(spark, {"tlp": "red"}, {"attributes": {"k": None}})["j"]) == {"tlp": "red", "attributes": {"k": None}}


def test_fold_is_associative(spark):
    r = random.Random(5)
    rows = [(s, i, r.choice("ab"), r.choice([None, "x", "y", "z"]), r.choice([None, 1, 2]), r.choice([None, True, False]), r.choice([None, [], ["q"]])) for s in range(6) for i in range(4)]
    df = spark.createDataFrame(rows, "seq long, idx int, k string, summary string, score int, flag boolean, list array<string>")
    laws = {"summary": "keep", "score": "max", "flag": "any", "list": "keep"}
    whole = folds.last_row(df, ["k", "seq"])
    once = {tuple(map(str, x)) for x in folds.fold(whole, ["k"], laws, "seq").collect()}
    state = {}
    for s in range(6):  # one envelope after the other
        last = {}
        for row in rows:
            if row[0] == s:
                last[row[2]] = row
        for k, row in last.items():
            old = state.get(k, (None, None, False, None))
            state[k] = (row[3] if row[3] is not None else old[0], max((x for x in (row[4], old[1]) if x is not None), default=None), bool(row[5]) or old[2], row[6] if row[6] is not None else old[3])
    assert once == {tuple(map(str, (k, *v))) for k, v in state.items()}


def test_a_number_that_is_none_overrides_nothing(spark):
    rows = [(1, 0, 5.0), (2, 0, float("nan")), (3, 0, float("inf")), (4, 0, None)]
    df = spark.createDataFrame(rows, "seq long, idx int, x double").select("seq", "idx", F.lit("k").alias("k"), context.number(F.col("x")).alias("score"))
    assert folds.fold(df, ["k"], {"score": "keep"}, "seq").first()["score"] == 5.0


def test_edges(spark):
    rows = [(1, 0, "a", "b", "t", None, 5, 9, '{"m":1}'), (1, 1, "a", "b", "t", 0.5, 3, 4, '{"n":2}'), (2, 0, "a", "b", "t", None, 7, 8, '{"m":"new"}'), (1, 2, "a", "c", "t", 0.1, 1, 1, None), (3, 0, "x", "y", "t", None, 1, 1, None), (4, 0, "x", "y", "t", None, 1, 1, None)]
    df = spark.createDataFrame(rows, "seq long, idx int, s string, d string, type string, confidence double, first_seen long, last_seen long, metadata string")
    got = {(r["s"], r["d"]): (r["first_seen"], r["last_seen"], r["confidence"], r["metadata"]) for r in folds.fold_edges(df, ["s", "d", "type"]).collect()}
    assert got == {("a", "b"): (3, 9, 0.5, '{"m":"new"}'), ("a", "c"): (1, 1, 0.1, None), ("x", "y"): (1, 1, None, "{}")}


def test_lookup(spark):
    rows = [(1, 0, "a", 5, 6, "s1", ["t1", "t1"], 0.4), (1, 1, "a", 1, 9, "s1", ["zz"], 0.9), (2, 0, "a", 4, 5, "s2", ["t2", "t1"], None)] + [(s, 0, "b", s, s, f"s{s}", [f"t{s}"], None) for s in range(1, 80)]
    df = spark.createDataFrame(rows, "seq long, idx int, value string, first_seen long, last_seen long, source string, tags array<string>, confidence double").withColumn("type", F.lit("domain"))
    got = {r["value"]: r for r in lookup.fold_lookup(df).collect()}
    assert (got["a"]["first_seen"], got["a"]["last_seen"], got["a"]["sources"], got["a"]["tags"], got["a"]["confidence"]) == (4, 6, ["s1", "s2"], ["t1", "t2"], 0.4)
    assert got["b"]["sources"] == [f"s{s}" for s in range(48, 80)] and got["b"]["tags"] == [f"t{s}" for s in range(16, 80)]
    fresh = spark.createDataFrame([("2025-05-20",), ("2025-03-01",)], "d string").select(F.col("d").cast("timestamp").alias("refreshed_at"))
    assert lookup.alive(fresh, F.lit(NOW).cast("timestamp")).count() == 1


def test_graph(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "a"), ("d", "d")], "source string, target string")
    assert {tuple(r) for r in graph.reach(df, spark.createDataFrame([("a",)], "node string"), 9).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert {tuple(r) for r in graph.degrees(df).collect()} == {("a", 1, 1), ("b", 1, 1), ("c", 2, 1), ("d", 1, 2)}
    assert {tuple(r) for r in graph.two_hop_counts(df).collect()} == {("a", 1), ("b", 2), ("c", 2), ("d", 1)}


def test_similar(spark):
    names = ["alpha beta", "alpha betta", "gamma", "ALPHA beta", None, "", "gamm", "delta"]
    grams = lambda t: {f"  {w} "[i : i + 3] for w in t.lower().split() for i in range(len(w) + 1)}
    df = spark.createDataFrame([(n,) for n in names], "text string")
    got = {(r["query"], r["text"]) for r in fuzzy.similar(df, df, "0.4").collect()}
    real = [n for n in names if n]
    assert got == {(a, b) for a in real for b in real if a != b and len(grams(a) & grams(b)) >= 0.4 * len(grams(a) | grams(b))}


def test_similar_in_blocks_moves_no_candidates(spark, monkeypatch):
    """Texts of few common words, so that most pairs have trigrams in common; what is shuffled follows the texts, not the pairs."""
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdeäβ𝒜7") for _ in range(draw.randint(1, 7))) for _ in range(40)]
    texts = [draw.choice("-_/ .").join(draw.sample(words, draw.randint(1, 9))) for _ in range(900)]
    texts += [texts[0].upper(), texts[1] + "!", "...", "", "x" * 9, " ".join(f"{i:04}" for i in range(400)), " ".join(f"{i:04}" for i in range(300)), *texts[:5]]

    def grams(t):
        return {f"  {w} "[i : i + 3] for w in re.split(r"[\W_]+", t.lower()) if w for i in range(len(w) + 1)}

    known = {t: grams(t) for t in texts}
    asked = texts[::3]
    want = {(a, b, len(known[a] & known[b]) / len(known[a] | known[b])) for a in asked for b in known if a != b and known[a] and 5 * len(known[a] & known[b]) >= 3 * len(known[a] | known[b])}
    monkeypatch.setattr(fuzzy, "ENTRIES", 4000, raising=False)
    monkeypatch.setattr(fuzzy, "CHARACTERS", 2000, raising=False)
    monkeypatch.setattr(fuzzy, "PAIRS", 3, raising=False)
    q, x = (spark.createDataFrame([(t,) for t in rows], "text string") for rows in (asked, texts))

    def shuffled():
        time.sleep(1)  # until the listener has it
        found = spark.sparkContext._jsc.sc().statusStore().executorList(True)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    before = shuffled()
    got = [tuple(r) for r in fuzzy.similar(q, x, "0.6").collect()]
    assert len(want) > 20 and len(got) == len(set(got)) and set(got) == want
    assert shuffled() - before < 12 * sum(len(t.encode()) for t in texts)  # five blocks or more have the queries
    assert fuzzy.similar(q.limit(0), x).count() == fuzzy.similar(q, x.limit(0)).count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([("a", 0, 2), ("a", 30, 1), ("a", 400, 5), ("b", 10, 1)], "l string, t long, n int").withColumn("at", F.timestamp_seconds("t"))
    got = {(r["l"], int(r["t"].timestamp())): round(r["rate"] * 300) for r in metrics.rate(df, ["l"], "at", "n", 300).collect()}
    assert got["a", 0] == 2 and got["a", 270] == 3 and got["a", 300] == 1 and got["b", 30] == 1 and got["a", 420] == 5 and ("a", 360) not in got
    q = metrics.bucket_quantile(spark.createDataFrame([("x", float(v)) for v in range(1, 101)], "l string, v double"), ["l"], "v", 0.5, [10, 100]).first()
    assert abs(q["quantile"] - 50) < 1e-9
    held = metrics.firing(df.withColumn("v", F.col("n")), ["l"], "at", F.col("v") >= 1, 300).collect()
    assert [r["l"] for r in held] == ["a"]


def test_windows_of_a_hot_label(spark):
    r = random.Random(9)
    rows = [("hot" if r.random() < 0.8 else r.choice("ab"), r.randrange(4000) * 7, i, r.random() < 0.9) for i in range(3000)]
    rows = list({(k, t): (k, t, i, ok) for k, t, i, ok in rows}.values()) + [("a", None, 9999, True)]
    df = spark.createDataFrame(rows, "l string, t long, id int, ok boolean").withColumn("at", F.timestamp_seconds("t")).withColumn("n", F.lit(1)).repartition(6)
    got = {x["id"]: x["increase"] for x in metrics.increase(df, ["l"], "at", "n", 600).collect()}
    assert got == {i: None if t is None else sum(k == q and u is not None and t - 600 < u <= t for q, u, _, _ in rows) for k, t, i, _ in rows}
    for seconds in (0, 50, 200):
        want = set()
        for key in ("hot", "a", "b"):
            run: list = []
            for t, ok in [*sorted((t, ok) for k, t, _, ok in rows if k == key and t is not None), (0, False)]:
                if ok:
                    run.append(t)
                    continue
                if run and run[-1] - run[0] >= seconds:
                    want.add((key, run[0], run[-1]))
                run = []
        assert {(x["l"], int(x["start"].timestamp()), int(x["end"].timestamp())) for x in metrics.firing(df, ["l"], "at", F.col("ok"), seconds).collect()} == want


def test_registry(spark):
    rows = spark.createDataFrame([("1", "a", "A", None, "clear", True), ("2", "b", "B", "u", "red", False)], "id string, slug string, name string, url string, tlp string, enabled boolean").withColumns({"config": F.lit(None).cast("string"), "last_run_at": F.lit(None).cast("timestamp"), "created_at": F.lit(NOW).cast("timestamp")})
    got = registry.resolved(spark.createDataFrame([(" A",), ("b",), ("c",), (None,)], "s string"), rows, "s")
    assert [r["source_status"] for r in sorted(got.collect(), key=lambda r: str(r["s"]))] == ["known", "unknown", "disabled", "unknown"]
    new = spark.createDataFrame([("b", "Bee", None, "green", True), ("c", "C", None, "purple", True)], "slug string, name string, url string, tlp string, enabled boolean")
    assert {(r["slug"], r["name"], r["url"], r["enabled"], r["id"]) for r in registry.added(rows, new).collect()} == {("a", "A", None, True, "1"), ("b", "Bee", "u", True, "2")}
    assert registry.registered(rows, spark.createDataFrame([("a",), ("z",), ("z",)], "slug string"), F.lit(NOW).cast("timestamp")).count() == 3
    assert registry.enabled(rows, "a", False).where("enabled").count() == 0


def test_archive_and_dead_letters(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    rows = spark.createDataFrame([(bytearray(b""),), (bytearray(b"x"),), (bytearray(b"x"),)], "body binary").withColumn("content_hash", archive.content_hash(F.col("body"))).withColumn("media_type", F.lit("text/plain"))
    archive.put(spark, root, rows)
    archive.put(spark, root, rows)
    assert spark.read.parquet(root).count() == 2
    empty = "sha256:e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert bytes(archive.get(spark, root, empty).first()["body"]) == b"" and archive.get(spark, root, empty[:-1] + "0").count() == 0
    keys = spark.createDataFrame([(empty,), ("sha256:zz",), (None,)], "c string").select(archive.key(F.col("c")).alias("k"), archive.safe(F.col("c")).alias("s")).collect()
    assert keys[0]["k"] == "raw/sha256/e3/b0/" + empty[7:] and keys[1]["k"] is None and keys[2]["k"] is None
    refs = spark.createDataFrame([("raw/a",), ("../a",), ("/a",), ("a/../b",), ("a..b",)], "r string").select(archive.safe(F.col("r"))).collect()
    assert [r[0] for r in refs] == [True, False, False, False, True]
    kept = spark.createDataFrame([('{"a":1}',), ('{"a":1} x',), ("NaN",), (None,)], "t string").select(dead_letters.payload(F.col("t"))).collect()
    assert [r[0] for r in kept] == ['{"a":1}', '"{\\"a\\":1} x"', '"NaN"', '""']


def write(folder, name, value):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value))


def test_store_and_stream(spark, tmp_path):
    from sightline.streaming.intake import start

    land = tmp_path / "in"
    full = doc(
        records=[{"kind": "indicator", "indicator": {"type": "auto", "raw_value": "mal[.]example"}, "context": {"tags": ["x"]}}, CVE | {"observed_at": "2023-05-05T00:00:00Z"}, {"kind": "cve", "cve": {"cve_id": "cve-2024-01234", "summary": "later"}}],
        relationships=[{"source": {"kind": "indicator", "value": "mal.example"}, "target": {"kind": "cve", "value": "CVE-2020-0001"}, "type": "exploits"}, {"source": {"kind": "indicator", "value": "mal.example"}, "target": {"kind": "indicator", "value": "MAL.example"}, "type": "related-to"}, {"source": {"kind": "breach", "value": "Foo 1"}, "target": {"kind": "cve", "value": "bad"}, "type": "targets"}],
        raw={"data": "aGk=", "encoding": "base64"},
    )
    write(land, "1.json", full)
    write(land, "2.json", full)
    write(land, "3.json", '{"source": "feed-z"} rubbish')
    write(land, "4.json", doc(records=[{"kind": "indicator", "indicator": {"type": "md5", "raw_value": "no"}}]))
    write(land, "5.json", "")
    store = Store(spark, f"file://{tmp_path}/store")
    for _ in range(2):  # the second run finds nothing new
        start(spark, str(land), store, str(tmp_path / "check"), available_now=True).awaitTermination()
    assert store.batches == ["stream-0"]
    write(land, "6.json", full | {"source_run_id": "again", "records": [{"kind": "cve", "cve": {"cve_id": "CVE-2024-1234", "cvss_score": 5, "known_exploited": True}}], "relationships": []})
    start(spark, str(land), store, str(tmp_path / "check"), available_now=True).awaitTermination()
    assert {(r["kind"], r["canonical_key"]) for r in store.read("entity").collect()} == {("indicator", "mal.example"), ("cve", "CVE-2024-1234"), ("cve", "CVE-2020-0001")}
    cves = {r["cve_id"]: r for r in store.read("cve").collect()}
    assert cves["CVE-2024-1234"]["summary"] == "later" and cves["CVE-2024-1234"]["cvss_score"] == 5 and cves["CVE-2024-1234"]["known_exploited"] and cves["CVE-2020-0001"]["summary"] is None
    assert store.read("relationship").count() == 1 and store.read("sighting").count() == 4 and store.read("envelope_log").count() == 2
    assert {(r["source_slug"], r["stage"]) for r in store.read("dead_letter").collect()} == {("feed-z", "validate"), ("feed-a", "canonicalise")}
    assert store.sightings("2025-01-01", "2025-02-01").count() == 3
    assert api.maintain(store, "2024-01-15", dry_run=True) == {"dropped": ["2023_05"]} and store.read("sighting").count() == 4
    assert api.maintain(store, "2024-01-15") == {"dropped": ["2023_05"]} and store.read("sighting").count() == 3 and store.read("entity").count() == 3
    files = envelopes.read(spark, str(land))
    assert process(files, store, "again", F.lit(NOW).cast("timestamp")) == {"written": 0, "duplicate": 3, "parked": 2}


def test_compaction_changes_nothing(spark, tmp_path):
    land, now = tmp_path / "in", F.lit(NOW).cast("timestamp")
    for i in range(3):
        write(land, f"{i}.json", doc(default_context={"tags": [f"t{i}", "all"], "confidence": i / 4},source_run_id=str(i), collected_at=f"2025-01-0{i + 1}T00:00:00Z", records=[{"kind": "cve", "cve": {"cve_id": "CVE-2024-1234", "summary": [None, "two", None][i], "cvss_score": [1, None, 3][i]}}, record("indicator", type="auto", raw_value="mal.example")], relationships=[edge(metadata={"k": i, f"m{i}": 1})]))
    store = Store(spark, f"file://{tmp_path}/store")
    tables = ("entity", "indicator", "cve", "breach", "relationship", "sighting", "envelope_log", "dead_letter", "metrics_log", "lookup")
    for i in range(3):
        api.load(spark, str(land / f"{i}.json"), store, f"b{i}", now)
        before = {t: sorted(map(str, store.read(t).collect())) for t in tables}
        assert [str(r) for r in store.find("domain", "mal.example").collect()] == before["lookup"] and store.find("domain", "x.example").isEmpty()
        api.maintain(store, compact=i != 2, now=now)
        assert {t: sorted(map(str, store.read(t).collect())) for t in tables} == before
    assert store.read("cve").first()["cvss_score"] == 3 and store.read("cve").first()["summary"] == "two"
    assert json.loads(store.read("relationship").first()["metadata"]) == {"k": 2, "m0": 1, "m1": 1, "m2": 1}
    known = store.find("domain", "mal.example").first()
    assert known["tags"] == ["t0", "all", "t1", "t2"] and known["confidence"] == 0.5 and known["sources"] == ["feed-a"]
    log = {(r["metric"], r["label"]): r["n"] for r in store.read("metrics_log").where("metric <> 'write_seconds'").groupBy("metric", "label").agg(F.sum("n").alias("n")).collect()}
    assert log == {("envelopes", "written"): 3, ("records", "cve"): 3, ("records", "indicator"): 3, ("sightings", ""): 6, ("envelope_records", "10"): 3}
    assert store.read("metrics_log").where("metric = 'write_seconds'").agg(F.sum("n")).first()[0] == 3
    with pytest.raises(ValueError):
        store.compact("lookup")
    before = {t: sorted(map(str, store.read(t).collect())) for t in tables}
    assert store.vacuum() == 0  # all is younger than a day
    api.maintain(store, compact=True, now=now)
    assert store.vacuum(-1) > 10 and {t: sorted(map(str, store.read(t).collect())) for t in tables} == before
    assert len(list((tmp_path / "store" / "manifest").glob("*.json"))) == 1 and len(list((tmp_path / "store" / "cve").iterdir())) == 1
    api.load(spark, str(land / "0.json"), store, "again", now)
    assert store.batches == ["b0", "b1", "b2", "again"] and {t: sorted(map(str, store.read(t).collect())) for t in tables if t != "metrics_log"} == {t: x for t, x in before.items() if t != "metrics_log"}
    store.refresh_lookup(F.lit("2025-08-01").cast("timestamp"))  # not refreshed for two months
    assert store.read("lookup").isEmpty() and store.read("indicator").count() == 1


def test_lookup_state_and_what_came_since(spark):
    rows = [(s, i, r, s, s, f"s{s % 5}", [f"t{s}", "all"], s / 99, s) for s in range(1, 99) for i, r in enumerate(("a", "b") if s % 2 else ("a",))]
    df = spark.createDataFrame(rows, "seq long, idx int, value string, first_seen long, last_seen long, source string, tags array<string>, confidence double, refreshed_at long").withColumn("type", F.lit("domain"))
    whole = {tuple(map(str, r)) for r in lookup.fold_lookup(df).collect()}
    for cut in (0, 1, 40, 98):
        got = lookup.merged(lookup.fold_lookup(df.where(F.col("seq") <= cut)), lookup.fold_lookup(df.where(F.col("seq") > cut)))
        assert {r["value"]: (r["first_seen"], r["last_seen"], r["confidence"], sorted(r["sources"]), len(r["tags"])) for r in got.collect()} == {"a": (1, 98, 98 / 99, [f"s{i}" for i in range(5)], 64), "b": (1, 97, 97 / 99, [f"s{i}" for i in range(5)], 50)}
    assert len(whole) == 2


def test_two_writers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/store"
    rows = spark.createDataFrame([("feed-a", "m", "l", 1)], "source string, metric string, label string, n long").withColumn("at", F.lit(NOW).cast("timestamp"))
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda i: Store(spark, root).commit(f"b{i % 5}", {"metrics_log": rows}), range(6)))
    store = Store(spark, root)
    assert sorted(store.batches) == [f"b{i}" for i in range(5)] and sum(done) == 5  # the same batch twice counts once
    assert store.read("metrics_log").count() == 5
    # a writer that died in the act holds up the others for its lease only
    claim = tmp_path / "store" / "claims" / f"{store._latest()[0] + 1:012d}"
    claim.write_text("")
    waits = []

    def wait(seconds):
        import os

        waits.append(seconds)
        os.utime(claim, (0, 0))

    assert store._update(lambda m: m | {"x": 1}, wait) and waits and store._manifest()["x"] == 1


def test_older_stores(spark, tmp_path):
    folder = tmp_path / "store" / "manifest"
    folder.mkdir(parents=True)
    (folder / "000000000004.json").write_text(json.dumps({"version": 1, "batches": ["b"], "compacted": {"cve": ["compact-1", 1]}}))
    with pytest.raises(Pending):
        Store(spark, f"file://{tmp_path}/store")
    assert Store(spark, f"file://{tmp_path}/store", migrating=True).migrate() == list(range(2, VERSION + 1))
    store = Store(spark, f"file://{tmp_path}/store")
    assert store.batches == ["b"] and "compacted" not in store._manifest() and store.migrate() == []
    (folder / "000000000009.json").write_text(json.dumps({"version": VERSION + 1, "batches": []}))
    with pytest.raises(RuntimeError):
        Store(spark, f"file://{tmp_path}/store")


def test_alerts(spark):
    ticks = [(s, m, label, n, t) for t in range(0, 3600, 30) for s, m, label, n in [("bad", "dropped", "canonicalise", 9), ("mixed", "records", "cve", 9), ("mixed", "dropped", "canonicalise", 1), ("good", "records", "cve", 99), ("good", "dropped", "canonicalise", 1), ("good", "write_seconds", "1", 1), ("mixed", "write_seconds", "60", 1)]]
    rows = [*ticks, ("good", "envelopes", "written", 5, 60), ("late", "envelopes", "dead_letter", 1, 90)]
    log = spark.createDataFrame(rows, "source string, metric string, label string, n long, t long").withColumn("at", F.timestamp_seconds("t"))
    got = {(r["alert"], r["source"]) for r in alerts.all_of(log).collect()}
    assert got == {("dropping", "bad"), ("dropping", "mixed"), ("nothing_usable", "bad"), ("dead_letters", "late"), ("slow_writes", "mixed")}
    assert alerts.all_of(log.limit(0)).isEmpty()


def test_months_are_those_of_utc(spark):
    rows = spark.sql("select timestamp_micros(x) as t from values (1735689599999999), (1735689600000000), (-1), (null) v(x)")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert [r[0] for r in rows.select(build.month(F.col("t"))).collect()] == ["2024_12", "2025_01", "1969_12", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bounds_of_months(spark):
    from sightline.plans.store import instant

    rows = spark.sql("select timestamp_micros(x) as t from values (1706745600000000), (1709251199999999), (null) v(x)")
    got = rows.select(*[c.alias(n) for n, c in zip("abc", build.month_bounds(F.col("t")))]).collect()
    assert [tuple(r) for r in got] == [("2024_02", 1706745600000000, 1709251200000000)] * 2 + [(None, None, None)]
    assert f"{instant('2025-06-01T00:00:00+02:00'):%Y_%m}" == "2025_05" and instant("2025-06-01") == instant("2025-06-01T00:00:00Z")


def test_reasons_are_cut_by_bytes(spark):
    rows = spark.createDataFrame([("é" * 10,), ("abc",), (None,), ("a" + "é" * 10,)], "t string").select(dead_letters.cut(F.col("t"), 6)).collect()
    assert [r[0] for r in rows] == ["ééé… (truncated)", "abc", None, "aéé… (truncated)"]


def test_supervision():
    from sightline.streaming.intake import supervise

    waits, left = [], [3]

    class Query:
        def awaitTermination(self):
            if left[0]:
                left[0] -= 1
                raise RuntimeError("down")

    assert supervise(Query, wait=waits.append, longest=3) == 3 and waits == [1, 2, 3]
    left[0] = 9
    assert supervise(Query, most=2, wait=waits.append) == 2


def test_months_ahead():
    from datetime import date

    assert api.months_ahead(date(2024, 11, 30), 3) == ["2024_11", "2024_12", "2025_01", "2025_02"]


def test_sources_attempts_and_limits(spark, tmp_path):
    land = tmp_path / "in"
    write(land, "1.json", doc(source="off"))
    write(land, "2.json", doc(source="new"))
    write(land, "3.json", doc(source="on"))
    sources = spark.createDataFrame([("1", "off", False), ("2", "on", True)], "id string, slug string, enabled boolean")
    store = Store(spark, f"file://{tmp_path}/store")
    assert api.load(spark, str(land), store, "b", F.lit(NOW).cast("timestamp"), sources) == {"written": 1, "duplicate": 0, "parked": 2}
    files = envelopes.read(spark, str(land))
    tries = files.select(envelopes.digest(F.col("body")).alias("digest"), F.lit(6).alias("n"))
    assert process(files, Store(spark, f"file://{tmp_path}/other"), "b", F.lit(NOW).cast("timestamp"), attempts=tries)["parked"] == 3
    with pytest.raises(ValueError):
        store.commit("../x", {})


def test_commands(spark, tmp_path):
    land, box = tmp_path / "in", tmp_path / "box"
    write(land, "ok.json", doc())
    write(land, "bad.json", doc(source="No Slug", records=[]))
    now = F.lit(NOW).cast("timestamp")
    report = {r["path"].rsplit("/", 1)[1]: r for r in api.validate(spark, str(land), now).collect()}
    assert report["ok.json"]["ok"] and not report["bad.json"]["ok"] and len(report["bad.json"]["problems"]) == 2
    api.submit(spark, str(land / "ok.json"), str(box), now)
    api.submit(spark, str(land / "bad.json"), str(box), now)
    assert len([x for x in box.iterdir() if x.suffix == ".json"]) == 1
    refused = api.submit(spark, str(land / "ok.json"), str(box), now, most=10).first()
    assert not refused["ok"] and "too large" in refused["problems"][0] and len([x for x in box.iterdir() if x.suffix == ".json"]) == 1
    assert api.without_secrets("redis://me:pw@host/0") == "redis://me:***@host/0"
    config = api.Config.of({"SIGHTLINE_STORE": "s", "SIGHTLINE_MAX_DROP_RATIO": "0", "SIGHTLINE_TTL_DAYS": "x"})
    assert config.max_drop_ratio == 0 and len(config.problems) == 2


def test_build_of_dropped_records(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, "canonicalise"), (1, 2, None), (1, 3, None), (2, 0, "canonicalise"), (2, 1, None)], "seq long, idx int, reason string")
    got = {r["seq"]: (r["n_dropped"], r["rejected"]) for r in build.drop_report(rows, ["seq"]).collect()}
    assert got == {1: (1, False), 2: (1, True)}
    gone = spark.createDataFrame([(1, "canonicalise"), (2, "canonicalise"), (3, None)], "seq long, reason string")
    left = spark.createDataFrame([(2,), (2,)], "seq long")
    for limit, want in ((1.0, {1: True, 2: False, 3: False}), (0.5, {1: True, 2: True, 3: False})):
        assert {r["seq"]: r["rejected"] for r in build.drop_report(gone, ["seq"], limit, left).collect()} == want
