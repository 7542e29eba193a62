"""Boosted trees from histograms, grown leaf by leaf: the second kind of boosting beside ``pyspark.ml``'s.

Features become bins once: numbers by quantiles of the training rows, levels in the order of their share of positives, absent
values and levels not seen have a bin of their own. A round of a tree is one aggregation: the sums of gradients and
curvatures by (leaf, feature, bin) of the smaller halves of the leaves that were split, as those of the other halves are what is
left of the whole; the driver gets leaves x features x bins numbers at most, whatever the rows, and splits the leaves that
gain most. So a tree grows where it pays, not level by level. Sums are whole numbers of 1e-12, so that a model does not depend
on the order of the rows. The rows with their bins and scores are stored as a table every few trees.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
import math

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.plans.learning import CATEGORICAL, NUMERIC
from orderloom.session import scratch_path

BINS, STORED_EVERY = 32, 4


@dataclass(frozen=True)
class Bins:
    """Cuts of each number and ranks of each level."""

    cuts: dict[str, list[float]]
    ranks: dict[str, dict[str, int]]

    @property
    def names(self) -> list[str]:
        return [*self.cuts, *self.ranks]

    def columns(self) -> dict[str, Column]:
        """The bin of each feature, as ``_b0``, ``_b1``, ...; 0 for absent and unknown values."""
        out = []
        for name, cuts in self.cuts.items():
            above = reduce(Column.__add__, [(F.col(name) > c).cast("int") for c in cuts], F.lit(1))
            out.append(F.when(F.col(name).isNull() | F.isnan(name), 0).otherwise(above))
        for name, ranks in self.ranks.items():
            known = F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair)) if ranks else None
            out.append(F.lit(0) if known is None else F.coalesce(F.try_element_at(known, F.col(name)), F.lit(0)))
        return {f"_b{i}": c.cast("smallint") for i, c in enumerate(out)}


def fit_bins(train: DataFrame, bins: int = BINS) -> Bins:
    """From all training rows: quantiles in one pass, levels by one aggregation each. Levels beyond ``bins`` - 1, the rarest
    ones, are left to the bin of unknown values."""
    probs = [k / (bins - 1) for k in range(1, bins - 1)]
    quantiles = train.approxQuantile(list(NUMERIC), probs, 0.001)
    ranks = {}
    for name in CATEGORICAL:
        levels = train.filter(F.col(name).isNotNull()).groupBy(name).agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("share"))
        common = levels.orderBy(F.desc("n"), name).limit(bins - 1).collect()
        ranks[name] = {r[name]: i + 1 for i, r in enumerate(sorted(common, key=lambda r: (r.share, r[name])))}
    return Bins({n: sorted(set(q)) for n, q in zip(NUMERIC, quantiles)}, ranks)


@dataclass
class Tree:
    """Node 1 is the root; node i splits into 2 i (bin at most the cut) and 2 i + 1. Leaves have values."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=lambda: {1: 0.0})

    def walk(self, leaf) -> Column:
        """``leaf(node)`` of the leaf that a row's bins lead to."""

        def at(node: int) -> Column:
            if node not in self.splits:
                return F.lit(leaf(node))
            feature, cut = self.splits[node]
            return F.when(F.col(f"_b{feature}") <= cut, at(2 * node)).otherwise(at(2 * node + 1))

        return at(1)


@dataclass(frozen=True)
class Booster:
    bins: Bins
    base: float
    trees: list[Tree]

    def margin(self) -> Column:
        return reduce(Column.__add__, [t.walk(t.values.__getitem__) for t in self.trees], F.lit(self.base))


# A histogram: feature -> bin -> (gradient, curvature, rows), the first two as whole numbers of 1 / UNIT ** 2.
UNIT = 1_000_000
Histogram = dict[int, dict[int, tuple[int, int, int]]]


def _histograms(rows: DataFrame, tree: Tree, fresh: Sequence[int], features: int) -> dict[int, Histogram]:
    """The histograms of the given leaves."""
    chance = 1 / (1 + F.exp(-F.col("_margin")))
    whole = lambda c: F.floor(F.col(c) * UNIT)
    rest = lambda c: F.round((F.col(c) * UNIT - whole(c)) * UNIT).cast("bigint")
    placed = rows.withColumn("_leaf", tree.walk(int)).filter(F.col("_leaf").isin(list(fresh))).select(
        "*", (F.col("weight") * (chance - F.col("label"))).alias("_g"), (F.col("weight") * chance * (1 - chance)).alias("_h"))
    dealt = placed.select(
        "_leaf", whole("_g").alias("g"), rest("_g").alias("g_rest"), whole("_h").alias("h"), rest("_h").alias("h_rest"),
        F.posexplode(F.array(*[f"_b{i}" for i in range(features)])).alias("f", "b"))
    out: dict[int, Histogram] = {n: {} for n in fresh}
    parts = [F.sum(c) for c in ("g", "g_rest", "h", "h_rest")]
    for leaf, f, b, g, g_rest, h, h_rest, n in dealt.groupBy("_leaf", "f", "b").agg(*parts, F.count(F.lit(1))).collect():
        out[leaf].setdefault(f, {})[b] = g * UNIT + g_rest, h * UNIT + h_rest, n
    return out


def _without(whole: Histogram, part: Histogram) -> Histogram:
    """What is left of a leaf's histogram without one of its halves."""
    out: Histogram = {}
    for f, bins in whole.items():
        left = {b: tuple(x - y for x, y in zip(sums, part.get(f, {}).get(b, (0, 0, 0)))) for b, sums in bins.items()}
        out[f] = {b: sums for b, sums in left.items() if sums[2]}
    return out


def _best_split(histogram: Histogram, smooth: float, least_rows: int) -> tuple[float, int, int, tuple[float, float], bool] | None:
    """gain, feature, cut, the two leaf weights of the best split and whether its first half has fewer rows; None if none gains."""
    best = None
    for f, sums in sorted(histogram.items()):
        bins = [(b, g / UNIT**2, h / UNIT**2, n) for b, (g, h, n) in sorted(sums.items())]
        total_g, total_h, total_n = (sum(b[k] for b in bins) for k in (1, 2, 3))
        g = h = n = 0.0
        for b, dg, dh, dn in bins[:-1]:
            g, h, n = g + dg, h + dh, n + dn
            if min(n, total_n - n) < least_rows:
                continue
            other_g, other_h = total_g - g, total_h - h
            gain = g * g / (h + smooth) + other_g * other_g / (other_h + smooth) - total_g * total_g / (total_h + smooth)
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = gain, f, b, (-g / (h + smooth), -other_g / (other_h + smooth)), 2 * n <= total_n
    return best


def _stored(rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, which every round reads."""
    path = scratch_path(rows.sparkSession, "boosting")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def fit(
    train: DataFrame, trees: int = 16, leaves: int = 8, rate: float = 0.3, smooth: float = 1.0, least_rows: int = 20, per_round: int = 2
) -> Booster:
    """Trees of at most ``leaves`` leaves on ``label`` (0, 1) and ``weight``; each round splits the ``per_round`` leaves of greatest gain."""
    bins = fit_bins(train)
    columns = bins.columns()
    positives = train.agg(F.sum(F.col("weight") * F.col("label")).alias("p"), F.sum("weight").alias("w")).first()
    share = min(max((positives.p or 0.0) / (positives.w or 1.0), 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    rows = _stored(train.select(F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"),
                                *[c.alias(n) for n, c in columns.items()], F.lit(base).alias("_margin")))
    grown: list[Tree] = []
    for number in range(1, trees + 1):
        tree, fresh, open_, known = Tree(), [1], {}, {}
        while fresh and len(tree.values) < leaves:
            found = _histograms(rows, tree, fresh, len(columns))
            known |= found | {node ^ 1: _without(known.pop(node // 2), found[node]) for node in fresh if node > 1}
            for node in sorted({n for node in fresh for n in (node, node ^ 1) if n > 0 and n in known}):
                if best_split := _best_split(known[node], smooth, least_rows):
                    open_[node] = best_split
            fresh = []
            best = sorted(open_, key=lambda node: (-open_[node][0], node))[:min(per_round, leaves - len(tree.values))]
            for node in best:
                _, feature, cut, (left, right), first_smaller = open_.pop(node)
                tree.splits[node] = feature, cut
                del tree.values[node]
                tree.values |= {2 * node: rate * left, 2 * node + 1: rate * right}
                fresh.append(2 * node if first_smaller else 2 * node + 1)
        grown.append(tree)
        rows = rows.withColumn("_margin", F.col("_margin") + tree.walk(tree.values.__getitem__))
        if number % STORED_EVERY == 0:
            rows = _stored(rows)
    return Booster(bins, base, grown)


def score(model: Booster, df: DataFrame) -> DataFrame:
    """order_id, label, probability of the positive class."""
    return df.withColumns(model.bins.columns()).select("order_id", "label", (1 / (1 + F.exp(-model.margin()))).alias("score"))


def importances(model: Booster, df: DataFrame) -> DataFrame:
    """How often each feature splits a leaf, greatest first; as long as the list of features."""
    counts = dict.fromkeys(model.bins.names, 0)
    for tree in model.trees:
        for feature, _ in tree.splits.values():
            counts[model.bins.names[feature]] += 1
    rows = df.sparkSession.createDataFrame(list(counts.items()), "feature string, splits int")
    return rows.orderBy(F.col("splits").desc(), "feature")
