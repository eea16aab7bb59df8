"""A corpus mixed from several sources to target shares, by Poisson replication."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1 << 16  # of the hash, in the first histogram
FINE = 1 << 12  # of each of its bins that matters, in the second


@dataclass(frozen=True)
class Rate:
    """How a source is used: `mean` of the Poisson distribution of a document's copies, at most `cap` copies."""

    source: str
    share: float
    cap: int
    mean: float
    target: float

    def thresholds(self) -> list[float]:
        """P(fewer than k copies), k = 1 to cap: a document whose hash is above the k-th has k copies or more."""
        return below(self.cap, self.mean).tolist() if math.isfinite(self.mean) else [-1.0] * self.cap


def below(cap: int, mean: float) -> np.ndarray:
    """P(X < k) of a Poisson variable, k = 1 to cap; made from logarithms, so that no mean is too great."""
    if mean <= 0:
        return np.ones(cap)
    k = np.arange(cap)
    logs = k * math.log(mean) - mean - np.array([math.lgamma(x + 1.0) for x in k])
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def uniform(row_id: Column, seed: int) -> Column:
    """A number in (0, 1) by the hash of an id."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_id), 11).cast("double") + 0.5) / F.lit(float(2**53))


def rates(sized: DataFrame, targets: DataFrame, seed: int = 7, total: float | None = None) -> list[Rate]:
    """The rate of each source of `targets` (source, target_share, max_repeats) that has tokens and a share above 0.

    sized: id, source, n_ids.  `total`: tokens of the mix; by default the most for which every share can be
    reached under the caps.  A source that is short of `total` gives all it may.  A null cap counts as 1; the
    shares of sources without a token go to the others in proportion.  Of a target listed twice, the larger holds.

    A document has k copies or more if its hash is above P(X < k), so the tokens of a source's mix at any mean follow
    from how its tokens lie along the hash.  That is counted for all documents in BINS, and once more, FINE times as
    fine, for the few bins that the thresholds lie in; the mean is the one at which the tokens come closest to the
    target.  How often documents may be used makes no difference to the cost of a row.
    """
    wanted = {r[0]: (float(r[1]), int(r[2])) for r in targets.groupBy("source").agg(F.max("target_share"), F.max(F.coalesce("max_repeats", F.lit(1)))).collect() if r[0] is not None and r[1] and r[1] > 0 and r[2] > 0}
    named = sized.where(F.col("source").isin(list(wanted)))
    have = {r[0]: r[1] for r in named.groupBy("source").agg(F.sum("n_ids")).collect() if r[1]}
    if not have:
        return []
    whole = sum(wanted[s][0] for s in have)
    share = {s: wanted[s][0] / whole for s in have}
    most = min(wanted[s][1] * have[s] / share[s] for s in have)
    goal = {s: min(share[s] * (most if total is None else total), wanted[s][1] * have[s]) for s in have}
    full = {s for s in have if goal[s] >= wanted[s][1] * have[s] * (1 - 1e-12)}
    means = dict.fromkeys(full, math.inf)
    caps = {s: wanted[s][1] for s in have if s not in full}
    if caps:
        rows = named.where(F.col("source").isin(list(caps))).select("source", (uniform(F.col("id"), seed) * F.lit(float(BINS))).alias("x"), "n_ids").withColumn("bin", F.floor("x").cast("int"))
        sums = {s: np.zeros(BINS) for s in caps}
        for r in rows.groupBy("source", "bin").agg(F.sum("n_ids").alias("n")).collect():  # at most BINS rows a source
            sums[r[0]][r[1]] = r[2]
        above = {s: np.append(np.cumsum(x[::-1])[::-1], 0.0) for s, x in sums.items()}  # tokens in this bin and behind it
        near: dict[str, dict[int, np.ndarray]] = {s: {} for s in caps}

        def tokens(s: str, mean: float) -> float:
            """Tokens of the copies at a mean: of bins that are known in detail by those, of others in proportion."""
            total = 0.0
            for t in below(caps[s], mean) * BINS:
                i = min(int(t), BINS - 1)
                if i in near[s]:
                    total += above[s][i + 1] + near[s][i][min(int((t - i) * FINE), FINE - 1) + 1 :].sum()
                else:
                    total += above[s][i + 1] + (i + 1 - t) * sums[s][i]
            return total

        def solved(s: str) -> tuple[float, float]:
            """The two means, as close as numbers go, between which the tokens pass the target."""
            low, high = 0.0, 1.0
            while tokens(s, high) < goal[s] and high < 1e9:
                high *= 2
            for _ in range(100):
                mid = (low + high) / 2
                low, high = (mid, high) if tokens(s, mid) < goal[s] else (low, mid)
            return low, high

        for s in caps:
            for t in below(caps[s], solved(s)[1]) * BINS:
                near[s] |= {i: np.zeros(FINE) for i in range(max(int(t) - 1, 0), min(int(t) + 2, BINS))}
        some = F.lit(False)
        for s in caps:
            some = some | ((F.col("source") == s) & F.col("bin").isin(list(near[s])))
        fine = F.least(F.floor((F.col("x") - F.col("bin")) * FINE).cast("int"), F.lit(FINE - 1)).alias("fine")
        for r in rows.where(some).groupBy("source", "bin", fine).agg(F.sum("n_ids").alias("n")).collect():  # at most 3 x cap x FINE rows a source
            near[r[0]][r[1]][r[2]] = r[3]
        for s in caps:
            low, high = solved(s)
            means[s] = low if abs(tokens(s, low) - goal[s]) < abs(tokens(s, high) - goal[s]) else high
    return [Rate(s, wanted[s][0], wanted[s][1], means[s], goal[s]) for s in sorted(have)]


def copies(row_id: Column, source: Column, plan: list[Rate], seed: int = 7) -> Column:
    """How often a document is used: its hash, read as a quantile of its source's Poisson distribution, up to the cap."""
    n = F.lit(0)
    for r in plan:
        reached = F.size(F.filter(F.lit(r.thresholds()), lambda t: uniform(row_id, seed) > t))
        n = F.when(source == r.source, reached).otherwise(n)
    return n


def mixed(docs: DataFrame, row_id: str, source: str, plan: list[Rate], seed: int = 7) -> DataFrame:
    """The documents, each as often as the plan uses it, with `copy` (1, 2, ...) and in an order by hash (`place`)
    over the whole mix.  Documents of sources without a target (null too) are left out."""
    n = copies(F.col(row_id), F.col(source), plan, seed)
    out = docs.withColumn("copy", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)))).withColumn("place", F.xxhash64(F.lit(seed + 1), F.col(row_id), F.col("copy")))
    return out.repartition("place").sortWithinPartitions("place")


def report(sized: DataFrame, targets: DataFrame, plan: list[Rate], seed: int = 7) -> DataFrame:
    """source, target_share, actual_share, n_tokens, n_copies, n_docs, most_copies, at_cap: for each target source.

    at_cap: all documents of the source are used as often as they may be.  Where no total was asked for, the mix is as
    large as the scarcest source allows, and that one is at its cap.
    """
    n = copies(F.col("id"), F.col("source"), plan, seed)
    used = sized.select("source", "n_ids", n.alias("n")).where("n > 0").groupBy("source").agg(F.sum(F.col("n") * F.col("n_ids")).alias("n_tokens"), F.sum("n").cast("long").alias("n_copies"), F.count("*").alias("n_docs"), F.max("n").cast("long").alias("most_copies"))
    total = float(used.agg(F.sum("n_tokens")).first()[0] or 1)
    zero = {"n_tokens": 0, "n_copies": 0, "n_docs": 0, "most_copies": 0}
    wanted = targets.groupBy("source").agg(F.max("target_share").alias("target_share")).where("source is not null")
    return wanted.join(F.broadcast(used), "source", "left").fillna(zero).withColumn("actual_share", F.col("n_tokens") / F.lit(total)).withColumn("at_cap", F.col("source").isin([r.source for r in plan if math.isinf(r.mean)]))
