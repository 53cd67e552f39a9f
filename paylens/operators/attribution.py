"""Attribution of every row's margin to the columns of boosted trees, by Shapley values.

The value of a set of columns is what a tree gives if only these columns are known: a split on an
unknown column passes on both children, weighted by the training rows that went there. That value is
a sum over the leaves, and a leaf's part is a product over the columns on its path: of 0 or 1 for a known column, whether
the row fulfils all its conditions, and of the share of training rows that go on for an unknown one. So a column's Shapley value in
a leaf is

    leaf * (fulfils - share) * sum over sizes k of  k! (d - 1 - k)! / d! * E_k,

where d columns are on the path and E_k sums the products over all sets of k known ones among the
others. The E_k are the coefficients of the product of (share + fulfils * t). Leaves are a table; it meets the rows
tree by tree, and the parts are summed by row and column before they are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import INFREQUENT, Boosted, Node, Tree

LEAVES = ("tree int, value double, weights array<double>, "
          "path array<struct<column: string, place: int, category: string, equal: boolean, low: double, high: double, missing: boolean, share: double>>")


def _conditions(path: Sequence[tuple[Node, bool, float]], model: Boosted) -> list[tuple]:
    """The columns on a path (split, went left, share that went there), each with all its conditions as one."""
    merged: dict[str, list] = {}
    categorical = list(model.kept)
    for node, left, share in path:
        number = node.category is None
        place = model.numeric.index(node.feature) if number else categorical.index(node.feature)
        row = merged.setdefault(node.column, [node.column, place, node.category, True, None, None, True, 1.0])
        if number:
            if left:
                row[5] = node.cut if row[5] is None else min(row[5], node.cut)
            else:
                row[4] = node.cut if row[4] is None else max(row[4], node.cut)
            row[6] = row[6] and node.missing_left == left
        else:
            row[3] = not left
        row[7] *= share
    return [tuple(row) for row in merged.values()]


def _paths(tree: Tree, number: int, so_far: list) -> list[tuple[Node, list]]:
    node = tree[number]
    if node.feature is None:
        return [(node, so_far)]
    out = []
    for child, left in ((2 * number, True), (2 * number + 1, False)):
        share = tree[child].weight / node.weight if node.weight else 0.0
        out += _paths(tree, child, [*so_far, (node, left, share)])
    return out


def leaf_rows(model: Boosted) -> list[tuple]:
    """Rows of :data:`LEAVES`: every leaf that has a path."""
    out = []
    for t, tree in enumerate(model.trees):
        for leaf, path in _paths(tree, 1, []):
            if path:
                found = _conditions(path, model)
                d = len(found)
                weights = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
                out.append((t, leaf.value, weights, found))
    return out


def expected(model: Boosted) -> float:
    """The margin if no column is known."""
    return model.base + sum(leaf.value * math.prod(share for *_, share in path)
                            for tree in model.trees for leaf, path in _paths(tree, 1, []))


_FULFILS = """case when c.category is not null then coalesce(_words[c.place] = c.category, false) = c.equal
    when _numbers[c.place] is null or isnan(_numbers[c.place]) then c.missing
    else coalesce(_numbers[c.place] >= c.low, true) and coalesce(_numbers[c.place] < c.high, true) end"""
_PATH = f"transform(path, c -> struct(c.column as column, c.share as r, cast(({_FULFILS}) as double) as z))"
_TIMES = """zip_with(concat(transform(p, a -> a * q.r), array(0D)), concat(array(0D), transform(p, a -> a * q.z)), (u, v) -> u + v)"""
_OTHERS = f"aggregate(filter(_path, (q, j) -> j != i), array(1D), (p, q) -> {_TIMES})"
_PARTS = f"""transform(_path, (e, i) -> struct(e.column as column, value * (e.z - e.r) *
    aggregate(zip_with({_OTHERS}, weights, (a, b) -> a * b), 0D, (s, x) -> s + x) as part))"""


def attributions(model: Boosted, frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key``, ``column``, ``contribution``: a row for every row of ``frame`` and column on a tree's path.

    A row's contributions and :func:`expected` add up to its margin. A missing number takes the side its split
    gives to missing ones; a missing category is none of the named ones. Repeated keys are added up: ``key`` has to
    name rows. Without trees, or without rows, the result is empty. The table of leaves is as large as the model, which is bounded
    by its trees and their depth.
    """
    spark = SparkSession.active()
    leaves = spark.createDataFrame(leaf_rows(model), LEAVES)

    def named(x: str):
        names = model.kept[x]
        if not names:
            return F.lit(INFREQUENT)
        return F.when(F.col(x).isin(*names) | F.col(x).isNull(), F.col(x)).otherwise(F.lit(INFREQUENT))

    numbers = F.array(*(F.col(x).cast("double") for x in model.numeric)) if model.numeric else F.lit(None).cast("array<double>")
    words = F.array(*map(named, model.kept)) if model.kept else F.lit(None).cast("array<string>")
    rows = frame.select(*key, numbers.alias("_numbers"), words.alias("_words"),
                        F.explode(F.sequence(F.lit(0), F.lit(max(0, len(model.trees) - 1)))).alias("tree"))
    met = rows.join(F.broadcast(leaves), "tree").withColumn("_path", F.expr(_PATH))
    parts = met.select(*key, F.inline(F.expr(_PARTS)))
    return parts.groupBy(*key, "column").agg(F.sum("part").alias("contribution"))


def attribution_summary(found: DataFrame, n: int | None = None) -> DataFrame:
    """Mean size of the contributions of every column, the largest first, over the rows it has any in; all columns, or the first ``n``."""
    out = found.groupBy("column").agg(F.avg(F.abs("contribution")).alias("mean_size"), F.avg("contribution").alias("mean"))
    out = out.orderBy(F.desc("mean_size"), "column")
    return out if n is None else out.limit(n)
