"""Second-order boosted trees, grown by Spark aggregations.

Every row has a gradient and a curvature of the logistic loss at its margin. A level of a tree is one
aggregation: gradients and curvatures summed by (node, feature, bin), which is combined in the map
tasks, so what is shuffled is bounded by nodes, features and bins. Splits are chosen from running
sums over the bins; only the best split of each node leaves Spark. Rows and columns are drawn once for a tree.

A numeric feature is split at one of its quantiles, with missing values on the side that gains more.
A category has a column of its own if it is among the most frequent ones, as in one-hot encoding,
and is split from all others. Gradients are summed as whole numbers (``SCALE`` to one), so that the
trees do not depend on the order of the rows.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir

SCALE = 1 << 20
INFREQUENT = "infrequent"
MISSING = -1  # the bin of a missing number


@dataclass(frozen=True)
class Boost:
    """Trees, depth, shrinkage, shares of rows and columns drawn for a tree, penalty on leaf values, least
    curvature of a child, least gain of a split, bins of a number, columns of a categorical feature, the
    probability that margins start from, seed, and after how many trees the margins are written anew."""

    trees: int = 200
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    least_weight: float = 1.0
    least_gain: float = 0.0
    bins: int = 256
    categories: int = 50
    base: float = 0.5
    seed: int = 42
    written: int = 10


@dataclass(frozen=True)
class Node:
    """A split (``feature``, and ``cut`` or ``category``) or a leaf (``value``). The children of node n are 2n and
    2n + 1: left where a number is below the cut (none is below -infinity, which parts missing numbers from all others), right where a category is the named one. ``weight`` is
    the curvature of the training rows that came here."""

    number: int
    weight: float
    value: float | None = None
    feature: str | None = None
    cut: float | None = None
    category: str | None = None
    missing_left: bool = False
    gain: float = 0.0

    @property
    def column(self) -> str:
        """The encoded column that is split."""
        return self.feature if self.category is None else f"{self.feature}_{self.category}"


Tree = Mapping[int, Node]


@dataclass(frozen=True)
class Boosted:
    """Trees, the margin they start from, numeric features, and the categories with a column of their own."""

    base: float
    trees: tuple[Tree, ...]
    numeric: tuple[str, ...]
    kept: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def walk(tree: Tree, number: int, left: Callable[[Node], Column], leaf: Callable[[Node], Column]) -> Column:
    """``leaf`` of the node that a row falls into; ``left`` says whether it goes left at a split."""
    node = tree[number]
    if node.feature is None:
        return leaf(node)
    return F.when(left(node), walk(tree, 2 * number, left, leaf)).otherwise(walk(tree, 2 * number + 1, left, leaf))


def goes_left(model: Boosted) -> Callable[[Node], Column]:
    """On the columns of a frame with the features."""

    def left(node: Node) -> Column:
        x = F.col(node.feature)
        if node.category is None:
            x = x.cast("double")
            return F.when(x.isNull() | F.isnan(x), F.lit(node.missing_left)).otherwise(x < F.lit(float(node.cut)))
        if node.category == INFREQUENT and INFREQUENT not in model.kept[node.feature]:
            return F.coalesce(x.isin(*model.kept[node.feature]), F.lit(True))
        return F.coalesce(x != F.lit(node.category), F.lit(True))

    return left


def margin(model: Boosted) -> Column:
    """The sum of the leaves of all trees, as an expression over the features."""
    left = goes_left(model)
    return reduce(lambda s, tree: s + walk(tree, 1, left, lambda n: F.lit(n.value)), model.trees, F.lit(model.base))


def probability(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


# Bins ---------------------------------------------------------------------------------------------
def quantile_cuts(frame: DataFrame, numeric: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Up to ``bins - 1`` cuts of every number, in one pass."""
    if not numeric or bins < 2:
        return {x: [] for x in numeric}
    shares = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    clean = lambda x: F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double"))
    row = frame.agg(*(F.percentile_approx(clean(x), shares, F.lit(10_000)).alias(x) for x in numeric)).first()
    return {x: sorted(set(row[x] or ())) for x in numeric}


def frequent(frame: DataFrame, categorical: Sequence[str], columns: int) -> dict[str, tuple[str, ...]]:
    """The categories that get a column of their own: all of them if they fit, else the most frequent
    ones, with one column left for the rest. Counts are combined in the tasks and the first few are taken
    in Spark, so at most ``columns + 1`` of them leave it."""
    out = {}
    for x in categorical:
        top = frame.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("n"))
        rows = top.orderBy(F.desc("n"), x).limit(columns + 1).collect()
        names = [r[x] for r in rows]
        out[x] = tuple(names if len(names) <= columns else names[:columns - 1])
    return out


def binned(cuts: Mapping[str, Sequence[float]], kept: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """The bin of each feature: how many cuts are not above a number; a category's place, the last one for the rest."""
    out = {}
    for x, values in cuts.items():
        number = F.col(x).cast("double")
        below = F.size(F.filter(F.array(*map(F.lit, values)), lambda c: c <= number)) if values else F.lit(0)
        out[x] = F.when(number.isNull() | F.isnan(number), F.lit(MISSING)).otherwise(below)
    for x, names in kept.items():
        place = F.array_position(F.array(*map(F.lit, names)), F.col(x)).cast("int") - 1 if names else F.lit(-1)
        out[x] = F.when(F.coalesce(place, F.lit(-1)) < 0, F.lit(len(names))).otherwise(place)
    return out


# Growing ------------------------------------------------------------------------------------------
def _written(df: DataFrame) -> DataFrame:
    path = work_dir(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def histograms(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``node``, ``f``, ``bin``, ``g``, ``h``: sums of every bin, of rows that lie in a node."""
    cells = F.array(*(F.struct(F.lit(i).alias("f"), F.col(f"_bin{i}").alias("bin")) for i in range(len(features))))
    each = rows.filter("node is not null").select("node", "g", "h", F.inline(cells))
    return each.groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(sums: DataFrame, last: Mapping[int, int], drawn: Sequence[tuple[int, int | None]], params: Boost) -> DataFrame:
    """``node``, its sums ``g`` and ``h``, and ``best``, its split with the largest gain, if any has one.

    ``last``: the last bin of each numeric feature. ``drawn``: the columns that may be split, a feature and, for
    a categorical one, the bin. Ties go to the first feature, then the first bin.
    """
    group = Window.partitionBy("node", "f")
    running = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    here = lambda c: F.when(F.col("bin") != MISSING, F.col(c)).otherwise(0)
    lost = lambda c: F.when(F.col("bin") == MISSING, F.col(c)).otherwise(0)
    rows = sums.withColumns({
        "all_g": F.sum("g").over(group), "all_h": F.sum("h").over(group),
        "below_g": F.sum(here("g")).over(running), "below_h": F.sum(here("h")).over(running),
        "lost_g": F.sum(lost("g")).over(group), "lost_h": F.sum(lost("h")).over(group)})
    side = lambda g, h, missing: F.struct(g.alias("gl"), h.alias("hl"), F.lit(missing).alias("missing_left"))
    col = F.col
    number = F.array(side(col("below_g"), col("below_h"), False), side(col("below_g") + col("lost_g"), col("below_h") + col("lost_h"), True))
    gone = F.array(side(col("lost_g"), col("lost_h"), True))  # missing ones on one side, all numbers on the other
    category = F.array(side(col("all_g") - col("g"), col("all_h") - col("h"), False))
    end = F.lit(None).cast("int")
    for f, b in last.items():
        end = F.when(col("f") == f, b).otherwise(end)
    numbers = [f for f, b in drawn if b is None]
    columns = [f * 100_000 + b for f, b in drawn if b is not None]
    may = F.when(end.isNotNull(), (col("bin") < end) & col("f").isin(numbers)).otherwise(
        (col("f") * 100_000 + col("bin")).isin(columns))
    # a split of a number without missing values has one side for them only
    sides = F.when(end.isNull(), category).when(col("bin") == MISSING, gone).when(col("lost_h") > 0, number).otherwise(F.slice(number, 1, 1))
    tried = rows.select("node", "all_g", "all_h", "f", "bin", may.alias("may"), F.inline(sides))
    real = lambda c: col(c).cast("double") / SCALE
    gl, hl, gr, hr = real("gl"), real("hl"), real("all_g") - real("gl"), real("all_h") - real("hl")
    score = lambda g, h: g * g / (h + params.l2)
    gain = score(gl, hl) + score(gr, hr) - score(real("all_g"), real("all_h"))
    good = col("may") & (hl >= params.least_weight) & (hr >= params.least_weight) & (gain > params.least_gain)
    split = F.struct(gain.alias("gain"), (-col("f")).alias("f"), (-col("bin")).alias("bin"),
                     (~col("missing_left")).alias("missing_right"), col("gl"), col("hl"))
    return tried.groupBy("node").agg(F.max("all_g").alias("g"), F.max("all_h").alias("h"), F.max(F.when(good, split)).alias("best"))


def _grow(rows: DataFrame, features: Sequence[str], cuts: Mapping, kept: Mapping, drawn: list, params: Boost) -> dict[int, Node]:
    """One tree, a job a level."""
    last = {i: len(cuts[x]) for i, x in enumerate(features) if x in cuts}
    tree: dict[int, Node] = {}
    sums: dict[int, tuple[int, int]] = {}
    open_nodes: set[int] = {1}
    for _ in range(params.depth):
        at = walk(tree, 1, _left_by_bin(features, cuts, kept), lambda n: F.lit(n.number if n.number in open_nodes else None)) if tree else F.lit(1)
        found = best_splits(histograms(rows.withColumn("node", at), features), last, drawn, params).collect()
        split: set[int] = set()
        for r in found:
            sums[r.node] = (r.g, r.h)
            if r.best is None:
                continue
            x, b = features[-r.best.f], -r.best.bin
            name = None if x in cuts else (kept[x][b] if b < len(kept[x]) else INFREQUENT)
            cut = None if x not in cuts else cuts[x][b] if b != MISSING else -math.inf
            tree[r.node] = Node(r.node, r.h / SCALE, None, x, cut, name, not r.best.missing_right, r.best.gain)
            sums[2 * r.node] = (r.best.gl, r.best.hl)
            sums[2 * r.node + 1] = (r.g - r.best.gl, r.h - r.best.hl)
            split |= {2 * r.node, 2 * r.node + 1}
        for n, (g, h) in sums.items():
            if n not in tree or tree[n].feature is None:
                tree[n] = Node(n, h / SCALE, -(g / SCALE) / (h / SCALE + params.l2) * params.rate)
        open_nodes = split
        if not split:
            break
    return tree or {1: Node(1, 0.0, 0.0)}  # no row was drawn


def _left_by_bin(features: Sequence[str], cuts: Mapping, kept: Mapping) -> Callable[[Node], Column]:
    def left(node: Node) -> Column:
        x = F.col(f"_bin{features.index(node.feature)}")
        if node.category is None:
            below = x <= F.lit(MISSING if node.cut == -math.inf else list(cuts[node.feature]).index(node.cut))
            return below & (x != MISSING) if not node.missing_left else below
        names = kept[node.feature]
        return x != F.lit(names.index(node.category) if node.category in names else len(names))

    return left


def fit(frame: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], key: Sequence[str],
        params: Boost = Boost(), cuts: Mapping[str, Sequence[float]] | None = None) -> Boosted:
    """Boosted trees for a label of 0 and 1; rows are drawn by a hash of ``key``. Without rows there are no trees.

    ``cuts``: where numbers may be split; by default their quantiles. A null category matches no column.
    A category beyond those with a column of their own, one that was not seen too, counts as the shared one.
    """
    cuts = {x: list(map(float, v)) for x, v in (cuts or quantile_cuts(frame, numeric, params.bins)).items()}
    kept = frequent(frame, categorical, params.categories)
    features = [*numeric, *categorical]
    bins = binned(cuts, kept)
    begin = math.log(params.base / (1 - params.base))
    rows = _written(frame.select(
        F.xxhash64(*key).alias("_draw"), F.col(label).cast("double").alias("_y"), F.lit(begin).alias("_margin"),
        *(bins[x].alias(f"_bin{i}") for i, x in enumerate(features))))
    if rows.isEmpty():
        return Boosted(begin, (), tuple(numeric), kept)
    columns = [(i, None) for i in range(len(numeric))]
    columns += [(features.index(x), b) for x in categorical for b in range(len(kept[x]) + 1)]
    trees = []
    left = _left_by_bin(features, cuts, kept)
    for t in range(params.trees):
        drawn = random.Random(f"{params.seed}:{t}").sample(columns, max(1, int(params.columns * len(columns))))
        p = probability(F.col("_margin"))
        whole = lambda c: F.round(c * SCALE).cast("long")
        share = F.xxhash64("_draw", F.lit(params.seed), F.lit(t)) / F.lit(2.0**64) + 0.5
        some = rows if params.rows >= 1 else rows.filter(share < params.rows)
        tree = _grow(some.withColumns({"g": whole(p - F.col("_y")), "h": whole(p * (1 - p))}), features, cuts, kept, sorted(drawn, key=str), params)
        trees.append(tree)
        rows = rows.withColumn("_margin", F.col("_margin") + walk(tree, 1, left, lambda n: F.lit(n.value)))
        if (t + 1) % params.written == 0 and t + 1 < params.trees:
            rows = _written(rows)
    return Boosted(begin, tuple(trees), tuple(numeric), kept)


# Model as a table ---------------------------------------------------------------------------------
def node_rows(model: Boosted) -> DataFrame:
    """One row for every node."""
    rows = [(t, n.number, n.feature, n.cut, n.category, n.missing_left, float(n.weight), n.value, float(n.gain))
            for t, tree in enumerate(model.trees) for n in tree.values()]
    return SparkSession.active().createDataFrame(
        rows, "tree int, node int, feature string, cut double, category string, missing_left boolean, weight double, value double, gain double")


def gains(model: Boosted) -> DataFrame:
    """The gain of every encoded column over all trees, the largest first."""
    total: dict[str, float] = {}
    for tree in model.trees:
        for n in tree.values():
            if n.feature is not None:
                total[n.column] = total.get(n.column, 0.0) + n.gain
    rows = sorted(total.items(), key=lambda x: (-x[1], x[0]))
    return SparkSession.active().createDataFrame(rows, "feature string, gain double")


def dumps(model: Boosted) -> str:
    return json.dumps({"base": model.base, "numeric": model.numeric, "kept": model.kept,
                       "trees": [[asdict(n) for n in tree.values()] for tree in model.trees]})


def loads(text: str) -> Boosted:
    found = json.loads(text)
    trees = tuple({n["number"]: Node(**n) for n in tree} for tree in found["trees"])
    return Boosted(found["base"], trees, tuple(found["numeric"]), {x: tuple(v) for x, v in found["kept"].items()})
