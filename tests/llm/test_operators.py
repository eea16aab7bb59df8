"""Each operator against brute force on small fixtures, with nulls, ties, repeated rows, empty tables and clashing names."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.functions import scalar
from sightline.llm import encode, foldhash, mixing, subjects
from sightline.llm.cooccur import cooccurrence, gram
from sightline.llm.survivor import Field, says_something, survivors

# Pairs of items


def pairs_of(baskets):
    n, single, both = 0, {}, {}
    for b in baskets:
        items = sorted({x for x in b or [] if x is not None})
        n += bool(items)
        for i, x in enumerate(items):
            single[x] = single.get(x, 0) + 1
            for y in items[i + 1 :]:
                both[x, y] = both.get((x, y), 0) + 1
    return n, single, both


@pytest.mark.parametrize(("share", "lift"), [("0", "0"), ("0.05", "0"), ("0.02", "1.5"), ("0.013", "2.7183"), ("0.01", "1.00000000000000000000000000000001")])
def test_cooccurrence(spark, share, lift):
    r = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["é", "Z"]
    baskets = [None, [], [None], ["w1"], ["w1", "w1", None, "w2"], words * 2] + [r.choices(words, [1 / (i + 1) for i in range(32)], k=r.randrange(6)) for _ in range(2000)]
    df = spark.createDataFrame([(b,) for b in baskets], "tags array<string>").repartition(5).withColumn("n_ab", F.lit("clash")).withColumn("item_a", F.lit(1))
    n, single, both = pairs_of(baskets)
    want = {(a, b): (c, single[a], single[b], n) for (a, b), c in both.items() if c >= float(share) * n and c * n >= float(lift) * single[a] * single[b]}
    got = cooccurrence(df, F.col("tags"), share, lift).collect()
    assert {(x["item_a"], x["item_b"]): (x["n_ab"], x["n_a"], x["n_b"], x["n_baskets"]) for x in got} == want
    assert all(abs(x["lift"] - x["n_ab"] * n / x["n_a"] / x["n_b"]) < 1e-9 for x in got)


def test_cooccurrence_of_nothing(spark):
    for share in ("0", "0.1"):
        assert cooccurrence(spark.createDataFrame([], "tags array<string>"), F.col("tags"), share, "2").count() == 0
        assert cooccurrence(spark.createDataFrame([(None,), ([],)], "tags array<string>"), F.col("tags"), share).count() == 0


@given(st.lists(st.sets(st.integers(0, 20), max_size=9), max_size=30), st.sampled_from([2, 5, 32]))
@settings(max_examples=80, deadline=None)
def test_gram(baskets, width):
    rows = np.array([i for i, b in enumerate(baskets) for _ in b], np.int64)
    cols = np.array([c for b in baskets for c in sorted(b)], np.int64)
    got = {}
    for a, b, n in gram(rows, cols, 21, width):
        for x, y, c in zip(a.tolist(), b.tolist(), n.tolist()):
            got[x, y] = got.get((x, y), 0) + c
    assert got == {(a, b): n for (a, b), n in pairs_of(baskets)[2].items()}


def test_products_of_full_and_sparse_blocks_agree(monkeypatch):
    from sightline.llm import cooccur

    r = np.random.default_rng(2)
    for fill, cells in ((0.02, 100), (0.02, 10**6), (0.7, 100), (0.7, 10**6)):
        dense = r.random((90, 40)) < fill
        dense[7] = True
        monkeypatch.setattr(cooccur, "CELLS", cells)
        rows, cols = (x.astype(np.int64) for x in np.nonzero(dense))
        got = np.zeros((40, 40), int)
        for a, b, n in gram(rows, cols, 40, 16):
            got[a, b] += n
        assert (got == np.triu(dense.T.astype(int) @ dense, 1)).all()


def test_one_long_basket(spark):
    long = [f"i{k}" for k in range(50_000)]
    df = spark.createDataFrame([(long,)] + [(["i1", "i2", "i3"],)] * 60 + [(["i4"],)] * 40, "tags array<string>")
    got = {(x["item_a"], x["item_b"]): x["n_ab"] for x in cooccurrence(df, F.col("tags"), "0.1", "1.5").collect()}
    assert got == {("i1", "i2"): 61, ("i1", "i3"): 61, ("i2", "i3"): 61}
    pairs = cooccurrence(df.limit(1).select(F.slice("tags", 1, 3000).alias("tags")), F.col("tags"))
    assert pairs.count() == 3000 * 2999 // 2


# Survivors


def fields():
    return [Field("v", F.col("v"), F.col("v").isNotNull())]


def survived(spark, rows, **how):
    df = spark.createDataFrame(rows, "k string, at long, id long, v string").withColumn("n_rows", F.lit("clash")).withColumn("t", F.lit("clash")).repartition(4)
    return {r["k"]: (r["n_rows"], r["v_id"], r["v"]) for r in survivors(df, "k", "at", "id", fields(), **how).collect()}


def test_survivors_with_times(spark):
    r = random.Random(6)
    rows = [(r.choice(["hot", "hot", "a", "b", "c"]), r.randrange(-9, 50), i, r.choice([None, "x", "y", "z"])) for i in range(1500)] + [(None, 1, 9000, "x"), ("empty", 1, 9001, None), ("a", 10**15, 9002, "tie"), ("a", 10**15, 9003, "tied"), ("far", -5, -(2**63), "low"), ("far", -6, 2**63 - 1, "old")]
    got = survived(spark, rows)
    for key in {x[0] for x in rows if x[0]}:
        usable = [(t, -i, v) for k, t, i, v in rows if k == key and v is not None]
        best = max(usable) if usable else (None, None, None)
        assert got[key] == (sum(x[0] == key for x in rows), -best[1] if usable else None, best[2])
    assert None not in got
    df = spark.createDataFrame(rows, "k string, at long, id long, v string")
    bare = survivors(df, "k", "at", "id", fields(), values=False)
    assert bare.columns == ["k", "n_rows", "v_id"] and {r["k"]: (r["n_rows"], r["v_id"]) for r in bare.collect()} == {k: x[:2] for k, x in got.items()}


def test_survivors_without_times(spark):
    # elsewhere draft is followed by review, and review by final; a lone step back doesn't count
    dated = [(f"k{i}", t, 10 * i + t, v) for i in range(40) for t, v in enumerate(["draft", "review", "final"])] + [("back", 1, 9000, "final"), ("back", 2, 9001, "review")]
    bare = [("u", None, 5003, "final"), ("u", None, 5001, "draft"), ("u", None, 5002, "review"), ("u", None, 5004, "final"), ("w", None, 6001, "draft"), ("w", None, 6003, "review"), ("w", None, 6002, "odd"), ("m", None, 7001, "review"), ("m", 3, 7002, "draft"), ("n", None, 8001, None), ("o", None, 8100, "draft"), ("o", 1, 8101, "review")]
    got = survived(spark, dated + bare)
    assert got["u"] == (4, 5003, "final")  # without the learned order it would be 5001
    assert got["w"] == (3, 6002, "odd")  # nothing is known of odd: of the two that none comes after, the smaller id
    assert got["m"] == (2, 7002, "draft") and got["o"] == (2, 8101, "review")  # a time goes before what is only learned
    assert got["n"] == (1, None, None)
    weighed = survived(spark, dated + bare, weigh=True)
    assert weighed["m"] == (2, 7001, "review")  # what is latest by its time is passed by what comes after it
    assert weighed["o"] == (2, 8101, "review") and all(weighed[k] == x for k, x in got.items() if k != "m")
    assert survived(spark, [("a", None, 1, "x"), ("a", None, 1, "x")]) == {"a": (2, 1, "x")}
    circle = [(f"c{i}", t, 10 * i + t, v) for i, pair in enumerate(["ab", "bc", "ca"]) for t, v in enumerate(pair)] + [("z", None, 100 + i, v) for i, v in enumerate("cba")]
    assert survived(spark, circle)["z"] == (3, 100, "c")  # round in a circle: the smallest id of all


def by_hand(rows, weigh):
    """What survives of (k, at, id, v), by plain loops."""
    follows = {}
    for key in {x[0] for x in rows}:
        seen = [v for t, i, v in sorted((t, i, v) for k, t, i, v in rows if k == key and t is not None and v is not None)]
        for a, b in zip(seen, seen[1:]):
            follows[a, b] = follows.get((a, b), 0) + (a != b)
    before = {(a, b) for (a, b), n in follows.items() if n > follows.get((b, a), 0)}
    out = {}
    for key in {x[0] for x in rows} - {None}:
        mine = [x for x in rows if x[0] == key and x[3] is not None]
        dated = max(((t, -i, v) for _, t, i, v in mine if t is not None), default=None)
        bare = {v: (1, min(i for _, t, i, w in mine if t is None and w == v)) for _, t, _, v in mine if t is None}
        if dated and (weigh and bare):
            bare[dated[2]] = (0, -dated[1])
        elif dated:
            bare = {dated[2]: (0, -dated[1])}
        best = min(((any((v, w) in before for w in bare), *x, v) for v, x in bare.items()), default=(0, 0, None, None))
        out[key] = (sum(x[0] == key for x in rows), best[2], best[3])
    return out


@pytest.mark.parametrize("weigh", [False, True])
def test_survivors_of_mixed_groups(spark, weigh):
    r = random.Random(12)
    words = "abcdefgh"
    rows = []
    for i in range(900):
        key = r.choice(["hot"] * 6 + [f"k{j}" for j in range(60)])
        t = r.choice([None, r.randrange(60)])
        late = (t if t is not None else r.randrange(60)) // 8  # values drift upwards in time
        rows.append((key, t, i, r.choice([None, words[min(late, 7)], words[min(late, 7)], r.choice(words)])))
    got = survived(spark, rows, weigh=weigh)
    assert got == by_hand(rows, weigh)
    assert survived(spark, [(k, None, i, v) for k, _, i, v in rows], weigh=weigh) != got  # nothing dated: nothing is learned


def test_survivors_of_nothing(spark):
    assert survived(spark, []) == {}


def test_stand_ins(spark):
    nothing = [None, "", " \t", "-", "n/a", "N/A.", "None", "(none)", "null", "TBD", "to be determined", "** RESERVED **", "Awaiting analysis", "No description available.", "description pending", "not yet available", "???", "No summary provided"]
    something = ["A race condition in the log...", "Unknown devices can connect to the console.", "No authentication is needed to reach the console", "Reserved memory is freed twice", "Null dereference in the parser", "X 1.2: none of the checks run"]
    rows = spark.createDataFrame([(x,) for x in nothing + something], "t string").select("t", says_something(F.col("t")).alias("s")).collect()
    assert [r["s"] for r in rows] == [False] * len(nothing) + [True] * len(something)


# Copies

SAMPLES = [
    ("auto", "mal[.]example"), ("domain", "MAL.example."), (None, " <mal.example>"), ("url", "mal.example"), ("auto", "http://mal.example/"), ("url", "hxxp[:]//MAL(dot)example:80"), ("url", "HTTP://mal.example/#x"), ("auto", "mal.example/"),
    ("url", "http://mal.example/A"), ("url", "http://mal.example/a"), ("url", "http://mal.example//a"), ("url", "http://mal.example/a?"), ("url", "http://mal.example:080/a"), ("url", "https://mal.example:443/a"), ("url", "https://mal.example/a"),
    ("auto", "192[.]0[.]2[.]1"), ("ipv4", "::ffff:192.0.2.1"), ("auto", "2001:DB8::1"), ("ipv6", "2001:db8:0::0:1"), ("domain", "münchen.example"), ("domain", "xn--mnchen-3ya.example"), ("email", "A@Mal.example"), ("auto", "a{at}mal[.]example"),
    ("md5", "MD5:" + "AB" * 16), ("auto", "ab" * 16), ("sha1", "ab" * 16), ("cidr", "10.1.1.1/8"), ("auto", "10.0.0.0/8"), ("auto", None), ("url", ""), ("host", "x"), ("auto", "words only"), ("url", "http://[2001:db8::1]/"), ("auto", "http://[2001:db8:0::1]:80"),
    ("url", "http://a_b.example/%41"), ("url", "http://u@mal.example/"), ("url", "http://mal.example/(.)x"), ("url", "http://mal.example/..x"), ("auto", "x" * 5000 + ".example"), ("auto", "http://mal.example/" + "y" * 5000), ("url", "HTTP://MAL.EXAMPLE/" + "y" * 5000),
]


def test_copies(spark):
    r = random.Random(7)
    rows = [(i, *r.choice(SAMPLES)) for i in r.sample(range(10**6), 900)] + [(2 * 10**6 + i, "url", f"http://mal.example/{'a' * (i % 2)}") for i in range(1200)]
    df = spark.createDataFrame(rows, "record_id long, type string, raw_value string").repartition(5).withColumn("keep_id", F.lit("clash")).withColumn("a", F.lit(1))
    groups = {}
    for i, k, v in rows:
        groups.setdefault(scalar.observable(k, v), []).append(i)
    groups.pop(None)
    want = {(min(x), i) for x in groups.values() for i in x if i != min(x)}
    written = {i: (k, v) for i, k, v in rows}
    for bits in (64, 2, 0):  # of each hash: with few, different values collide
        assert {tuple(x) for x in foldhash.copies(df, "record_id", F.col("type"), F.col("raw_value"), bits).collect()} == want
        got = {x["record_id"]: x for x in foldhash.collapsed(df, "record_id", F.col("type"), F.col("raw_value"), bits).collect()}
        assert {i: x["n_copies"] for i, x in got.items()} == {min(x): len(x) for x in groups.values()}
        assert all((x["type"], x["raw_value"]) == written[i] for i, x in got.items())


def test_a_group_over_all_partitions(spark):
    rows = [(i, "url", f"http{'s' * (i % 7 == 0)}://mal.example/{'#' * (i % 3 == 0)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "record_id long, type string, raw_value string").repartition(6)
    pairs = foldhash.copies(df, "record_id", F.col("type"), F.col("raw_value")).collect()
    assert {tuple(x) for x in pairs} == {(0 if i % 7 == 0 else 1, i) for i in range(2, 3000)} and len(pairs) == 2998
    got = {x["record_id"]: x["n_copies"] for x in foldhash.collapsed(df, "record_id", F.col("type"), F.col("raw_value")).collect()}
    assert got == {0: 429, 1: 2571}


def test_copies_of_nothing(spark):
    assert foldhash.copies(spark.createDataFrame([], "i long, k string, r string"), "i", F.col("k"), F.col("r")).count() == 0
    assert foldhash.copies(spark.createDataFrame([(1, "auto", None), (2, None, " ")], "i long, k string, r string"), "i", F.col("k"), F.col("r")).count() == 0


def test_collisions_are_parted(spark, monkeypatch):
    # all hashes equal: the comparison alone has to keep groups apart
    values = [("url", "http://mal.example/a"), ("url", "http://mal.example/b"), ("url", "hxxp://mal[.]example/b"), ("url", "HTTP://mal.example/a"), ("domain", "mal.example"), ("domain", "mal[.]example")]
    kinds, raws = (pa.array(x) for x in zip(*values))
    first = pa.array([0] * 6)
    assert foldhash.same(kinds.take(first), raws.take(first), kinds, raws).tolist() == [True, False, False, True, False, False]


PIECES = ["http://", "hxxps[:]//", "ftp://", "fxp:[//]", "a", "B", "mal", "example", ".", "[.]", "(dot)", "\\.", "-", "_", "1", "10.1.2.3", "::ffff:", "::", "2001:db8", "0:0", "[:]", ":", ":80", ":080", "/", "//", "[/]", "/..", "/.", "/../", "/./", "...", "/.d", "?q", "#f",
          "%41", "%zz", "@", "[at]", "user:pw@", " ", "\t", "\xa0", "\u2003", "<", '"', "é", "/24", "/64", "/0", "/08", "ab" * 16, "md5:", "ffff", "(", "]", "x" * 64]
SPELT = st.one_of(st.text(alphabet="aB1.-_/:@[]()%?# \\x*é'\t", max_size=20), st.lists(st.sampled_from(PIECES), max_size=8).map("".join), st.lists(st.sampled_from(["0", "0000", "db8", "DB8", "::", ":", "[:]", "ffff", "/64", "/8"]), max_size=12).map("".join))


@given(st.lists(st.tuples(st.sampled_from(["auto", "url", "domain", "email", "ipv4", "ipv6", "cidr", "md5", None]), SPELT), max_size=12))
@settings(max_examples=300, deadline=None)
def test_comparisons(rows):
    forms = [scalar.observable(*x) for x in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if forms[i] is not None and forms[j] is not None]
    sides = [pa.array([rows[p[k]][c] for p in pairs], pa.string()) for k in (0, 1) for c in (0, 1)]
    assert foldhash.same(*sides).tolist() == [forms[i] == forms[j] for i, j in pairs]


def test_what_the_table_reads(sf):
    import pyarrow.parquet as pq

    seen = pq.read_table(f"{sf}/indicator_records.parquet", columns=["indicator"]).column("indicator").combine_chunks()
    kinds, raws = seen.field("type"), seen.field("raw_value")
    valid = np.array([scalar.observable(*x) is not None for x in zip(kinds.to_pylist(), raws.to_pylist())])
    assert foldhash.Reader(kinds, raws).hashes()[2][valid].mean() > 0.98


@given(st.lists(st.tuples(st.sampled_from(["auto", "url", "domain", "email", "ipv4", "ipv6", "cidr", "md5", None]), SPELT | st.text(alphabet="aB1.-_/:@[]()%?# \\x*é'\t", max_size=20)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_fingerprints(rows):
    kinds, raws = pa.array([k for k, _ in rows], pa.string()), pa.array([r for _, r in rows], pa.string())
    a, b, valid = foldhash.fingerprints(kinds, raws)
    forms = [scalar.observable(*x) for x in rows]
    assert valid.tolist() == [x is not None for x in forms]
    for i, x in enumerate(forms):
        for j, y in enumerate(forms):
            if x is not None and y is not None:
                assert ((a[i], b[i]) == (a[j], b[j])) == (x == y), (rows[i], rows[j])


# Token ids


TEXTS = [None, "", "a", "  \n", "don't stop", "é" * 50, "x" * 900, "word " * 400, "it's 12'll ''s\r\n\r\n  end", "日本語" * 90, "<|endoftext|>", "\ufeff\u00a0\u200b", " " * 3000 + "x", "-=" * 2000, "\n\t" * 900, "🙂" * 500]


def test_encoding(spark):
    texts = TEXTS * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3).withColumn("ids", F.lit("clash")).withColumn("piece", F.lit(0)).withColumn("node", F.lit(1))
    own = encode.encoder(encode.TOKENIZER)
    for leaf in (64, 7, encode.LEAF):  # a tree of two levels, one with more than FAN leaves, and leaves alone
        got = {r["doc_id"]: r["ids"] for r in encode.encoded(df, "doc_id", "text", leaf=leaf).collect()}
        assert got == {i: own.leaf(t or "").tolist() for i, t in enumerate(texts)}
        kept = encode.sizes(df, "doc_id", "text", leaf=leaf, keep=("piece",)).collect()
        assert {r["doc_id"]: r["n_ids"] for r in kept} == {i: len(x) for i, x in got.items()} and {r["piece"] for r in kept} == {0}
    assert encode.encoded(df.limit(0), "doc_id", "text").count() == 0 and encode.sizes(df.limit(0), "doc_id", "text").count() == 0
    assert all(own.bytes(np.array(got[i], np.uint32)).decode() == (t or "") for i, t in enumerate(texts))
    assert encode.encoded(df.withColumn("doc_id", F.col("doc_id").cast("string")), "doc_id", "text").count() == len(texts)


ONE_KIND = ["etaoinshrdlu", "оеаинтсрвл", "0123456789", "日本語一二三", "-=_!'\"", " \n\t\u3000", "🙂👩\u200dé", "a", "ab", "'sretvmld", " 'sl"]


@given(st.sampled_from(ONE_KIND).flatmap(lambda a: st.text(alphabet=a, max_size=300)), st.integers(1, 60), st.sampled_from([1, 2, 5, 32]))
@settings(max_examples=400, deadline=None)
def test_joins_within_runs_of_one_kind(text, leaf, window):
    own = encode.encoder(encode.TOKENIZER)
    parts = [own.leaf(text[i : i + leaf]) for i in range(0, len(text), leaf)]
    assert own.chain(parts, window).tolist() == own.leaf(text).tolist()


@given(st.text(alphabet=" \n\t'sltrevdmab1,.-é日\r", max_size=200), st.integers(1, 40), st.sampled_from([1, 3, 32]))
@settings(max_examples=300, deadline=None)
def test_joins_are_exact(text, leaf, window):
    own = encode.encoder(encode.TOKENIZER)
    parts = [own.leaf(text[i : i + leaf]) for i in range(0, len(text), leaf)]
    assert own.chain(parts, window).tolist() == own.leaf(text).tolist()


@pytest.mark.parametrize("alphabet", ONE_KIND[:5])
def test_windows_stay_small(monkeypatch, alphabet):
    r = random.Random(3)
    text = "".join(r.choices(alphabet, k=200_000))  # nothing that the pattern splits, but for the marks
    own = encode.encoder(encode.TOKENIZER)
    parts = [own.leaf(text[i : i + encode.LEAF]) for i in range(0, len(text), encode.LEAF)]
    again = []
    plain = encode.Encoder.text
    monkeypatch.setattr(encode.Encoder, "text", lambda self, x: again.append(len(x)) or plain(self, x))
    assert own.chain(parts).tolist() == own.leaf(text).tolist()
    assert max(again) < 2000 and sum(again) < 20_000


def test_a_long_text_without_splits(spark):
    r = random.Random(5)
    text = "".join(r.choices("etaoinshrdlucmfwyp", k=10_000_000))
    own = encode.encoder(encode.TOKENIZER)
    df = spark.createDataFrame([(1, text), (2, "x"), (3, " " * 2_000_000 + "y")], "doc_id long, text string")
    table = encode.encoded(df, "doc_id", "text").toArrow().sort_by("doc_id")
    ids = [np.array(x.values, np.uint32) for x in table.column("ids")]
    assert np.array_equal(ids[0], own.leaf(text)) and len(ids[1]) == 1 and own.bytes(ids[2]) == b" " * 2_000_000 + b"y"


# Mixing


def test_poisson():
    for mean in (0.01, 1.3, 40.0):
        term, total = math.exp(-mean), 0.0
        for k, t in enumerate(mixing.below(30, mean)):
            total += term
            term *= mean / (k + 1)
            assert abs(t - total) < 1e-12
    assert mixing.below(3, 0.0).tolist() == [1, 1, 1] and 0.4 < mixing.below(2000, 2000.0)[-1] < 0.6  # e ** -2000 is 0 as a number
    rate = mixing.Rate("s", 0.5, 3, 1.3, 0)
    assert rate.thresholds() == sorted(rate.thresholds()) and abs(rate.thresholds()[1] - math.exp(-1.3) * 2.3) < 1e-12


def test_mixing_with_many_repeats(spark):
    rows = [(i, "a" if i < 900 else "b", 100) for i in range(1000)]
    sized = spark.createDataFrame(rows, "id long, source string, n_ids long")
    targets = spark.createDataFrame([("a", 0.1, 3), ("b", 0.9, 400)], "source string, target_share double, max_repeats int")
    for total in (100_000, 800_000, 3_000_000):
        plan = mixing.rates(sized, targets, total=float(total))
        got = {r["source"]: r for r in mixing.report(sized, targets, plan).collect()}
        assert all(abs(got[s]["n_tokens"] - share * total) <= 100 for s, share in (("a", 0.1), ("b", 0.9)) if not got[s]["at_cap"])
        assert got["a"]["at_cap"] == (total == 3_000_000) and got["b"]["most_copies"] <= 400
    assert got["a"]["n_tokens"] == 270_000


def test_mixing(spark):
    r = random.Random(8)
    rows = [(i, "big" if i < 3000 else "mid" if i < 3600 else "small" if i < 3700 else r.choice([None, "other"]), r.randrange(50, 400), f"text {i}") for i in range(3800)] + [(9000, "small", 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_ids long, text string").repartition(4)
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 4), ("absent", 0.1, 3), ("off", 0.0, 2), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    sized = docs.select(F.col("doc_id").alias("id"), "source", "n_ids")
    plan = mixing.rates(sized, targets)
    assert [p.source for p in plan] == ["big", "mid", "small"]
    report = {x["source"]: x for x in mixing.report(sized, targets, plan).collect()}
    have = {s: sum(n for _, q, n, _ in rows if q == s) for s in ("big", "mid", "small")}
    total = min(have["big"] / (0.5 / 0.9), 2 * have["mid"] / (0.3 / 0.9), 4 * have["small"] / (0.1 / 0.9))
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.1)):
        assert abs(report[s]["n_tokens"] - total * share / 0.9) <= 400, s
        assert abs(report[s]["actual_share"] - share / 0.9) < 0.005
    assert report["small"]["most_copies"] == 4 and report["big"]["most_copies"] == 1 and report["mid"]["most_copies"] <= 2
    assert [s for s in report if report[s]["at_cap"]] == [min(have, key=lambda s: {"big": 1, "mid": 2, "small": 4}[s] * have[s] / {"big": 0.5, "mid": 0.3, "small": 0.1}[s])]
    assert report["absent"]["n_tokens"] == report["off"]["n_tokens"] == 0
    mix = mixing.mixed(docs, "doc_id", "source", plan).collect()
    assert len({(x["doc_id"], x["copy"]) for x in mix}) == len(mix) == sum(x["n_copies"] for x in report.values())
    assert {x["source"] for x in mix} == {"big", "mid", "small"}
    counts = {}
    for x in mix:
        counts[x["doc_id"]] = counts.get(x["doc_id"], 0) + 1
        assert x["text"] == (None if x["doc_id"] == 9000 else f"text {x['doc_id']}")
    assert max(counts.values()) == 4
    half = {p.source: p for p in mixing.rates(sized, targets, total=total / 2)}
    assert half["small"].mean < 4 and mixing.rates(sized.limit(0), targets) == [] and mixing.rates(sized, targets.limit(0)) == []
    assert mixing.report(sized.limit(0), targets, []).count() == 5 and mixing.mixed(docs, "doc_id", "source", []).count() == 0


# Subjects

PAPER = r"""\documentclass{article}
\newcommand{\Ab}{ribosome} \def\Cd{gene~expression}
\title{On the \Ab{}}
\begin{document}
The \emph{cell mem\-brane} and \Cd{} of the al\-lele\footnote{mutation}. Enzymes, larvae; G\'enome.
% compiler debugger compiler debugger
\iffalse compiler \fi \begin{comment} debugger \end{comment} See \cite{galaxy}.
\begin{thebibliography}{9}\bibitem{galaxy} Of galaxies, quasar and supernova.\end{thebibliography}
\end{document}
compiler debugger
"""


def test_reading():
    seen = subjects.readable(PAPER)
    assert "on the ribosome" in seen and "cell membrane" in seen and "gene expression" in seen and "allele" in seen and "mutation" in seen
    for hidden in ("compiler", "debugger", "galax", "quasar", "documentclass", "emph"):
        assert hidden not in seen
    assert [subjects.readable(x) for x in (None, "", " \n", "% only", "\\documentclass{a}\n\\begin{document}\\input{x}\\end{document}")] == [""] * 5
    assert subjects.readable('M\\"{a}nnig\\-faltig\ufb01x caf\\\'{\\i}a') == "männigfaltigfix cafía"
    assert subjects.readable("a \\includegraphics[width=3cm]{figs/x1} b \\bibliographystyle{plain} c \\citep[p. 3]{star} d") == "a b c d"
    assert subjects.readable("50\\% of it % not this") == "50 of it"


def test_counting():
    words = subjects.lexicon()
    got, n = subjects.counted("Star formation, stars; black-hole in a galaxy. Larvae! Café, Zellmembranen, órbita", words.terms)
    assert {words.terms[k]: c for k, c in got.items()} == {"star": 2, "black hole": 1, "galaxy": 1, "larvae": 1, "zellmembran": 1, "orbita": 1} and n == 12
    assert subjects.counted(None, words.terms) == ({}, 0) and subjects.counted("a b", ()) == ({}, 2)
    assert all((words.weight[:, i] > 0).sum() >= 80 for i in range(len(words.subjects)))


def test_lexicon_of_given_areas():
    words = subjects.lexicon((("cooking", "Recipes, kitchens and those that cook in them"), ("law", None), ("void ?", ""), ("-", None), ("baking", "Bread from kitchens")))
    of = lambda s: {t for k, t in enumerate(words.terms) if words.weight[k, words.subjects.index(s)] > 0}
    assert of("cooking") == {"cooking", "recipes", "cook"} and of("baking") == {"baking", "bread"} and of("void ?") == {"void"}  # kitchens tells them not apart
    assert words.without_terms == ["-"] and "plaintiff" in of("law") and words.beside[words.terms.index("nucleus")]


def test_subjects(spark):
    bio, law = "The enzyme and the genome of a larva. ", "The plaintiff and the statute. "
    rows = [(1, bio * 5), (2, bio * 5 + law * 6), (3, bio * 12 + "A plaintiff."), (4, None), (5, ""), (6, "% " + bio), (7, "Simply nothing of interest."), (8, bio * 5 + "The nucleus and the culture. " * 4), (9, "The nucleus and the root. " * 9), (10, bio), (11, "Recipes and ovens"), (12, "to be or not " * 300 + law)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("subject", F.lit("clash")).withColumn("share", F.lit(1))
    areas = spark.createDataFrame([("biology", "x"), ("law", "y"), ("astronomy", "z"), ("cooking", "Recipes and ovens"), ("-", None), (None, None)], "subject string, description string")
    labels = spark.createDataFrame([(1, "biology"), (2, "biology"), (2, "law"), (None, "law")], "doc_id long, subject string")
    want = {(1, "biology"), (2, "biology"), (2, "law"), (3, "biology"), (8, "biology"), (10, "biology"), (11, "cooking")}  # a short text too
    for given_labels in (labels.limit(0), None):
        assert {(r["doc_id"], r["subject"]) for r in subjects.subject_areas(docs, "doc_id", "text", areas, given_labels).collect()} == want
    found = subjects.subject_areas(docs, "doc_id", "text", areas, labels)
    assert {(r["doc_id"], r["subject"]) for r in found.collect()} >= {(1, "biology"), (2, "biology"), (2, "law")}
    made = {r["subject"]: r for r in subjects.composition(found, areas).collect()}
    assert set(made) == {"biology", "law", "astronomy", "cooking", "-"} and (made["-"]["n_terms"], made["-"]["n_docs"]) == (0, 0) and made["cooking"]["n_terms"] == 3 and made["biology"]["n_docs"] >= 2
    assert subjects.subject_areas(docs.limit(0), "doc_id", "text", areas, labels).count() == 0


def test_thresholds_on_labels_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, areas, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "subject_areas", "subject_labels"))
    wanted = subjects.given_areas(areas)
    words = subjects.lexicon(wanted)
    seen = subjects.settled(subjects.counts(docs, "doc_id", "text", words.terms))
    found = subjects.calibrated(seen, labels, "doc_id", words, np.ones(len(words.subjects), bool), subjects.rarity(seen, words))
    assert found.n_held_out > 20 and found.recall > 0.85 and found.precision > 0.8 and 0.08 < found.share < 0.25


def test_thresholds_from_all_labels(spark):
    """21 000 labelled documents: all count, and the thresholds are those of all errors."""
    words = subjects.lexicon((("biology", None), ("law", None)))
    given = np.array([s in ("biology", "law") for s in words.subjects])
    term = {s: next(k for k in range(len(words.terms)) if words.weight[k, words.subjects.index(s)] and not words.beside[k]) for s in ("biology", "law")}
    rare = np.ones(len(words.terms))
    seen = spark.range(21_000).select("id", F.expr(f"cast(array({term['biology']}, {term['law']}) as array<int>)").alias("terms"), F.expr("cast(array(20 + id % 7, id % 23) as array<int>)").alias("times"), F.expr("600 + 300 * (id % 11)").alias("n_words"))
    labels = spark.range(21_000).select(F.col("id").alias("doc_id"), F.explode(F.expr("if(id % 23 > 8, array('biology', 'law'), array('biology'))")).alias("subject"))
    found = subjects.calibrated(seen, labels, "doc_id", words, given, rare)
    assert found.n_held_out == 21_000
    table = seen.toArrow().combine_chunks()
    share, density = subjects.measured(table.column("terms").chunk(0), table.column("times").chunk(0), table.column("n_words").to_numpy(), words, rare)
    ids = table.column("id").to_numpy()
    truth = np.array([np.full(len(ids), True) if s == "biology" else ids % 23 > 8 for s in np.array(words.subjects)[given]]).T
    wrong = np.array([[(((share >= a) & (density >= b))[:, given] != truth).sum() for b in subjects.DENSITIES] for a in subjects.SHARES])
    i, j = subjects.fitted(wrong)
    assert (found.share, found.density) == (subjects.SHARES[i], subjects.DENSITIES[j])


# Whole queries


def test_queries_on_the_data(spark, sf):
    from sightline.llm import queries

    found = {name: f(spark, sf).collect() for name, f in queries.queries().items()}
    assert [r for name, rows in found.items() if name != "p3_found" and not rows for r in [name]] == []
    rows = spark.read.parquet(f"{sf}/indicator_records.parquet").select("record_id", "indicator").collect()
    groups = {}
    for r in rows:
        groups.setdefault(scalar.observable(r["indicator"]["type"], r["indicator"]["raw_value"]), []).append(r["record_id"])
    groups.pop(None, None)
    assert {tuple(r) for r in found["p5_found"]} == {(min(x), i) for x in groups.values() for i in x if i != min(x)}
    labels = {(r["doc_id"], r["subject"]) for r in spark.read.parquet(f"{sf}/subject_labels.parquet").collect()}
    known = {d for d, _ in labels}
    got = {tuple(r) for r in found["p8_found"] if r["doc_id"] in known}
    assert 2 * len(got & labels) / (len(got) + len(labels)) > 0.85
    shares = {r["source"]: r for r in found["p7_shares"]}
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9
