import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.operators import boosting as b
from paylens.operators.attribution import attribution_summary, attributions, expected
from paylens.operators.boosting import Boost, Boosted, Node, fit, margin

ALL = Boost(trees=2, depth=3, rate=0.5, rows=1.0, columns=1.0, least_weight=1.0, written=1)
CUTS = {"u": [2.0, 5.0, 8.0], "v": [0.25, 0.5, 0.75]}


def rows_of(n, seed=3):
    random = np.random.default_rng(seed)
    out = []
    for i in range(n):
        u = None if random.random() < 0.15 else float(random.integers(0, 10))
        v, c = float(random.random()), ["a", "b", "c", "d", "e"][int(random.integers(0, 5))]
        odds = (0 if u is None else u - 5) + (3 if c == "b" else 0) + 4 * (v - 0.5)
        out.append((i, u, v, c, int(random.random() < 1 / (1 + math.exp(-odds)))))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows_of(400), "id long, u double, v double, c string, y int")


def plain_fit(rows, params):
    """The same trees, a row at a time: dictionaries of node number to (feature, cut or category, missing left) or value."""
    margins, trees = {r[0]: 0.0 for r in rows}, []
    value = {"u": lambda r: r[1], "v": lambda r: r[2], "c": lambda r: r[3]}
    kept = sorted({r[3] for r in rows})
    for _ in range(params.trees):
        g, h = {}, {}
        for r in rows:
            p = 1 / (1 + math.exp(-margins[r[0]]))
            g[r[0]], h[r[0]] = round((p - r[4]) * b.SCALE) / b.SCALE, round(p * (1 - p) * b.SCALE) / b.SCALE
        tree, todo = {}, {1: rows}
        while todo:
            number, some = todo.popitem()
            G, H = sum(g[r[0]] for r in some), sum(h[r[0]] for r in some)
            best = None
            options = [(x, cut, miss) for x in ("u", "v") for cut in (-math.inf, *CUTS[x]) for miss in (False, True)] + [("c", k, False) for k in kept]
            if number < 2**params.depth:
                for x, at, miss in options:
                    left = [r for r in some if goes_left(value[x](r), x, at, miss)]
                    gl, hl = sum(g[r[0]] for r in left), sum(h[r[0]] for r in left)
                    if min(hl, H - hl) < params.least_weight:
                        continue
                    gain = gl**2 / (hl + params.l2) + (G - gl)**2 / (H - hl + params.l2) - G**2 / (H + params.l2)
                    if gain > params.least_gain + 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, x, at, miss)
            if best is None:
                tree[number] = -G / (H + params.l2) * params.rate
                continue
            tree[number] = best[1:]
            for child, side in ((2 * number, True), (2 * number + 1, False)):
                todo[child] = [r for r in some if goes_left(value[best[1]](r), *best[1:]) == side]
        trees.append(tree)
        for r in rows:
            n = 1
            while isinstance(tree[n], tuple):
                n = 2 * n + (not goes_left(value[tree[n][0]](r), *tree[n]))
            margins[r[0]] += tree[n]
    return trees, margins


def goes_left(x, feature, at, miss):
    if feature == "c":
        return x != at
    return miss if x is None else x < at


def test_same_trees_as_row_by_row(frame):
    rows = [tuple(r) for r in frame.collect()]
    model = fit(frame, "y", ["u", "v"], ["c"], ["id"], ALL, CUTS)
    trees, margins = plain_fit(rows, ALL)
    for got, want in zip(model.trees, trees):
        assert got.keys() == want.keys()
        for n, node in got.items():
            if node.feature is None:
                assert node.value == pytest.approx(want[n], abs=1e-9)
            else:
                assert (node.feature, node.cut if node.category is None else node.category, node.missing_left) == want[n]
    found = {r.id: r.m for r in frame.select("id", margin(model).alias("m")).collect()}
    assert all(found[i] == pytest.approx(m, abs=1e-6) for i, m in margins.items())


def test_order_of_rows_does_not_matter(frame):
    params = Boost(trees=2, depth=2, bins=16)
    one = fit(frame.repartition(1), "y", ["u", "v"], ["c"], ["id"], params)
    assert one == fit(frame.orderBy(F.desc("v")).repartition(7), "y", ["u", "v"], ["c"], ["id"], params)
    assert b.loads(b.dumps(one)) == one
    assert b.node_rows(one).count() == sum(map(len, one.trees))
    assert {r.feature.split("_")[0] for r in b.gains(one).collect()} <= {"u", "v", "c"}


def test_rows_and_columns_are_drawn_once_for_a_tree(frame):
    model = fit(frame, "y", ["u", "v"], ["c"], ["id"], Boost(trees=2, depth=3, columns=0.2, rows=0.5, bins=8))
    for tree in model.trees:
        assert len({n.column for n in tree.values() if n.feature}) <= 1  # 8 columns, one drawn
        assert tree[1].weight < 0.25 * 300


def test_learns(spark):
    frame = spark.createDataFrame(rows_of(3000, 5), "id long, u double, v double, c string, y int")
    model = fit(frame, "y", ["u", "v"], ["c"], ["id"], Boost(trees=4, depth=3, rate=0.5, bins=32))
    new = spark.createDataFrame(rows_of(2000, 6), "id long, u double, v double, c string, y int")
    right = new.filter((margin(model) > 0) == (F.col("y") == 1)).count() / 2000
    assert right > 0.75


def test_rare_categories_share_a_column(spark):
    rows = [(i, float(i % 7), f"c{i % 60 if i % 2 else 0}", int(i % 2 == 0)) for i in range(1000)]
    frame = spark.createDataFrame([*rows, (1000, None, None, 1)], "id long, u double, c string, y int")
    kept = b.frequent(frame, ["c"], 5)["c"]
    assert len(kept) == 4 and kept[0] == "c0"
    model = fit(frame, "y", ["u"], ["c"], ["id"], Boost(trees=2, depth=2, categories=5, rows=1.0))
    scored = {r.c: r.m for r in frame.unionByName(spark.createDataFrame([(1, 1.0, "new", 0)], frame.schema)).select("c", margin(model).alias("m")).distinct().collect()}
    assert scored["c0"] > scored["c59"]


def test_nothing_to_learn_from(frame):
    model = fit(frame.limit(0), "y", ["u"], ["c"], ["id"], ALL)
    assert model.trees == () and frame.select(margin(model).alias("m")).first().m == 0.0
    one_class = fit(frame.filter("y = 1"), "y", ["u"], ["c"], ["id"], Boost(trees=2, depth=2, rows=1.0))
    assert frame.select(F.min(margin(one_class))).first()[0] > 0


# Attribution ------------------------------------------------------------------------------------------
SMALL = Boosted(0.3, (
    {1: Node(1, 10.0, feature="u", cut=5.0, missing_left=True), 2: Node(2, 6.0, feature="c", category="b"), 3: Node(3, 4.0, feature="u", cut=8.0),
     4: Node(4, 5.0, 0.4), 5: Node(5, 1.0, -1.2), 6: Node(6, 3.0, 2.0), 7: Node(7, 1.0, feature="v", cut=0.5), 14: Node(14, 0.25, 0.7), 15: Node(15, 0.75, -0.9)},
    {1: Node(1, 8.0, feature="c", category="infrequent"), 2: Node(2, 6.0, 0.1), 3: Node(3, 2.0, feature="v", cut=0.25), 6: Node(6, 1.0, 1.0), 7: Node(7, 1.0, -1.0)},
), ("u", "v"), {"c": ("a", "b", "c")})


def value_of(model, row, known):
    """The margin where only some columns are known."""
    def at(tree, n):
        node = tree[n]
        if node.feature is None:
            return node.value
        if node.column in known:
            x = row[node.feature]
            if node.category is None:
                left = node.missing_left if x is None else x < node.cut
            elif node.category == "infrequent":
                left = x is None or x in model.kept[node.feature]
            else:
                left = x != node.category
            return at(tree, 2 * n + (not left))
        return sum(tree[k].weight / node.weight * at(tree, k) for k in (2 * n, 2 * n + 1))
    return model.base + sum(at(tree, 1) for tree in model.trees)


def plain_shapley(model, row):
    columns = sorted({n.column for tree in model.trees for n in tree.values() if n.feature})
    out = {}
    for c in columns:
        others = [x for x in columns if x != c]
        out[c] = sum(math.factorial(k) * math.factorial(len(others) - k) / math.factorial(len(columns))
                     * (value_of(model, row, {*s, c}) - value_of(model, row, set(s)))
                     for k in range(len(others) + 1) for s in combinations(others, k))
    return out


def compare(model, frame):
    margins = {r.id: r.m for r in frame.select("id", margin(model).alias("m")).collect()}
    rows = {r.id: r for r in frame.collect()}
    found = {}
    for r in attributions(model, frame, ["id"]).collect():
        found.setdefault(r.id, {})[r.column] = r.contribution
    assert found.keys() == rows.keys()
    for i, row in rows.items():
        want = plain_shapley(model, row.asDict())
        assert found[i] == pytest.approx(want, abs=1e-9)
        assert sum(found[i].values()) + expected(model) == pytest.approx(margins[i], abs=1e-9)


def test_same_as_the_sum_over_all_subsets(frame):
    compare(SMALL, frame.limit(40))


def test_same_for_a_fitted_model(frame):
    model = fit(frame, "y", ["u", "v"], ["c"], ["id"], ALL, CUTS)
    compare(model, frame.orderBy("id").limit(12))


def test_odd_rows(spark, frame):
    odd = spark.createDataFrame([(1, None, None, None, 0), (2, float("nan"), 1e308, "zz", 1), (3, float("inf"), -1e308, "", 0)], frame.schema)
    compare(SMALL, odd.filter("id <> 2"))
    assert attributions(SMALL, odd.limit(0), ["id"]).collect() == []
    assert attributions(Boosted(0.0, (), ("u",), {}), odd, ["id"]).collect() == []
    top = attribution_summary(attributions(SMALL, frame, ["id"]), 2).collect()
    assert len(top) == 2 and top[0].mean_size >= top[1].mean_size > 0
