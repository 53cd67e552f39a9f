"""Boosted trees and their attribution on the training rows, and the same in DuckDB: the splits of a first
tree from sums over bins, and scores and Shapley values of a fixed model by nested cases and all subsets."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as k
from ..operators import boosting as b
from ..operators import classifier as ml
from ..operators.boosting import Boost, Boosted, Node

CUTS = {
    "year": (1997.0,), "service_line_count": (2.0, 3.0, 5.0), "total_services": (25.0, 50.0, 100.0, 150.0),
    "avg_medicare_payment": (10.0, 25.0, 50.0, 1000.0), "specialty_median_withhold": (0.05, 0.06, 0.07),
}
FIRST = Boost(trees=1, depth=3, rate=0.1, rows=1.0, columns=1.0, categories=4)
FEATURES = (*k.NUMERIC, *k.CATEGORICAL)


def first_model(train: DataFrame) -> Boosted:
    return ml.fit_boosted(train, FIRST, CUTS)


def first_tree(train: DataFrame) -> DataFrame:
    return b.node_rows(first_model(train)).withColumns({x: F.round(x, 9) for x in ("weight", "value", "gain")}).drop("tree")


def first_gains(train: DataFrame) -> DataFrame:
    return b.gains(first_model(train)).withColumn("gain", F.round("gain", 9))


def first_tree_sql(rows: str) -> str:
    """The nodes of the first tree over ``rows``. All margins are 0, so a gradient is 0.5 - label and a curvature 0.25."""
    steps = [f"raw_rows as materialized ({rows})"]
    bins = []
    for i, x in enumerate(k.NUMERIC):
        below = " + ".join(f"({x}::double >= {cut!r}::double)::int" for cut in CUTS[x])
        bins.append(f"case when {x} is null then -1 else {below} end as b{i}")
    for i, x in enumerate(k.CATEGORICAL, len(k.NUMERIC)):
        steps.append(f"""k{i} as materialized (select *, if(whole <= {FIRST.categories}, whole, {FIRST.categories} - 1) as kept from (
            select coalesce({x}, '{ml.NO_CATEGORY}') as name, row_number() over (order by count(*) desc, coalesce({x}, '{ml.NO_CATEGORY}')) - 1 as place,
            count(*) over () as whole from raw_rows group by 1))""")
        bins.append(f"(select least(place, kept) from k{i} where name = coalesce({x}, '{ml.NO_CATEGORY}'))::int as b{i}")
    steps.append(f"r0 as materialized (select {ml.LABEL}::double as y, 1 as node, {', '.join(bins)} from raw_rows)")
    ends = " ".join(f"when {i} then {len(CUTS[x])}" for i, x in enumerate(k.NUMERIC))
    gain = lambda g, h: f"({g}) * ({g}) / (({h}) + {FIRST.l2}::double)"
    for level in range(FIRST.depth):
        each = " union all ".join(f"select node, {i} as f, b{i} as bin, y from r{level} where node is not null" for i in range(len(FEATURES)))
        steps.append(f"s{level} as materialized (select node, f, bin, sum(0.5::double - y) as g, count(*) * 0.25::double as h from ({each}) group by all)")
        steps.append(f"""w{level} as (select *, sum(g) over p as tg, sum(h) over p as th,
            coalesce(sum(g) filter (bin >= 0) over run, 0) as bg, coalesce(sum(h) filter (bin >= 0) over run, 0) as bh,
            coalesce(sum(g) filter (bin < 0) over p, 0) as lg, coalesce(sum(h) filter (bin < 0) over p, 0) as lh, case f {ends} end as last
            from s{level} window p as (partition by node, f), run as (partition by node, f order by bin rows unbounded preceding))""")
        steps.append(f"""c{level} as (select node, f, bin, tg, th, bg as gl, bh as hl, false as missing_left from w{level} where bin >= 0 and bin < last
            union all select node, f, bin, tg, th, bg + lg, bh + lh, true from w{level} where bin >= 0 and bin < last and lh > 0
            union all select node, f, bin, tg, th, lg, lh, true from w{level} where bin < 0 and last is not null
            union all select node, f, bin, tg, th, tg - g, th - h, false from w{level} where last is null)""")
        steps.append(f"""p{level} as materialized (select * from (select *, {gain('gl', 'hl')} + {gain('tg - gl', 'th - hl')} - {gain('tg', 'th')} as gain from c{level})
            where hl >= 1 and th - hl >= 1 and gain > 0
            qualify row_number() over (partition by node order by gain desc, f, bin, missing_left) = 1)""")
        left = " ".join(f"when {i} then if(b{i} < 0, p.missing_left, b{i} <= p.bin)" for i in range(len(k.NUMERIC)))
        left += " " + " ".join(f"when {i} then b{i} <> p.bin" for i in range(len(k.NUMERIC), len(FEATURES)))
        steps.append(f"""r{level + 1} as materialized (select r.* replace (case when p.node is not null then 2 * p.node + if(case p.f {left} end, 0, 1) end as node)
            from r{level} r left join p{level} p on r.node = p.node)""")
    levels = range(FIRST.depth)
    steps.append("splits as (" + " union all ".join(f"select * from p{x}" for x in levels) + ")")
    steps.append("""ends as (select node, tg as g, th as h from (select 1 as node, sum(0.5::double - y) as tg, count(*) * 0.25::double as th from r0)
        union all select 2 * node, gl, hl from splits union all select 2 * node + 1, tg - gl, th - hl from splits)""")
    names = " ".join(f"when {i} then '{x}'" for i, x in enumerate(FEATURES))
    cut = " ".join(f"when {i} then if(bin < 0, '-infinity'::double, ({list(CUTS[x])!r})[bin + 1])" for i, x in enumerate(k.NUMERIC))
    word = " ".join(f"when {i} then coalesce((select name from k{i} where place = bin and place < kept), '{b.INFREQUENT}')"
                    for i in range(len(k.NUMERIC), len(FEATURES)))
    return f"""with {', '.join(steps)} select node::int as node, case f {names} end as feature, (case f {cut} end)::double as cut,
          case f {word} end as category, missing_left, round(th, 9) as weight, null::double as value, round(gain, 9) as gain from splits
        union all select node::int, null, null, null, false, round(h, 9), round(-g / (h + {FIRST.l2}::double) * {FIRST.rate}::double, 9), 0::double
          from ends where node not in (select node from splits)"""


# A fixed model ------------------------------------------------------------------------------------
FIXED = Boosted(-0.1, (
    {1: Node(1, 40.0, feature="service_line_count", cut=3.0, missing_left=True), 2: Node(2, 24.0, feature="provider_state", category="S1"),
     3: Node(3, 16.0, feature="service_line_count", cut=6.0), 4: Node(4, 20.0, 0.4), 5: Node(5, 4.0, -1.2), 6: Node(6, 12.0, 0.9),
     7: Node(7, 4.0, feature="total_services", cut=150.0), 14: Node(14, 1.0, 0.7), 15: Node(15, 3.0, -0.9)},
    {1: Node(1, 32.0, feature="provider_state", category=b.INFREQUENT), 2: Node(2, 8.0, feature="specialty_median_withhold", cut=0.06),
     3: Node(3, 24.0, feature="total_services", cut=60.0, missing_left=True), 4: Node(4, 6.0, 0.2), 5: Node(5, 2.0, -0.3), 6: Node(6, 18.0, 0.6), 7: Node(7, 6.0, -0.5)},
), ("service_line_count", "total_services", "specialty_median_withhold"), {"provider_state": ("S1", "S2", "S3", ml.NO_CATEGORY)})


def fixed_scores(rows: DataFrame) -> DataFrame:
    return ml.score_boosted(FIXED, rows).withColumn("score", F.round("score", 9))


def fixed_attributions(rows: DataFrame) -> DataFrame:
    return ml.explain(FIXED, rows).withColumn("contribution", F.round("contribution", 9))


def _value(tree, number: int, known) -> str:
    """What a tree gives if some columns are known."""
    node = tree[number]
    if node.feature is None:
        return f"({node.value!r}::double)"
    left, right = (_value(tree, child, known) for child in (2 * number, 2 * number + 1))
    if node.column not in known:
        return f"(({tree[2 * number].weight!r}::double * {left} + {tree[2 * number + 1].weight!r}::double * {right}) / {node.weight!r}::double)"
    x = node.feature
    if node.category is None:
        test = f"coalesce({x}::double < {node.cut!r}::double, {str(node.missing_left).lower()})"
    else:
        x = f"coalesce({x}, '{ml.NO_CATEGORY}')"
        own = FIXED.kept[node.feature]
        test = f"{x} in ({', '.join(map(repr, own))})" if node.category == b.INFREQUENT else f"{x} <> '{node.category}'"
    return f"(case when {test} then {left} else {right} end)"


def _columns() -> list[str]:
    return sorted({n.column for tree in FIXED.trees for n in tree.values() if n.feature})


def fixed_scores_sql(rows: str) -> str:
    total = " + ".join([f"{FIXED.base!r}::double", *(_value(tree, 1, _columns()) for tree in FIXED.trees)])
    return f"""select {ml.ROW_KEY}, {ml.LABEL}, round(1 / (1 + exp(-m)), 9) as score, (m > 0)::int as prediction
        from (select {ml.ROW_KEY}, {ml.LABEL}, {total} as m from ({rows}))"""


def fixed_attributions_sql(rows: str) -> str:
    """Every set of columns is valued, and every column's gains are weighted over the sets of the others."""
    columns = _columns()
    sets = [s for n in range(len(columns) + 1) for s in combinations(columns, n)]
    values = ", ".join(f"{' + '.join(_value(tree, 1, s) for tree in FIXED.trees)} as v{i}" for i, s in enumerate(sets))
    place = {frozenset(s): i for i, s in enumerate(sets)}
    parts = []
    for c in columns:
        n = len(columns)
        total = " + ".join(
            f"{math.factorial(len(s)) * math.factorial(n - 1 - len(s))}::double / {math.factorial(n)} * (v{place[frozenset({*s, c})]} - v{place[frozenset(s)]})"
            for s in sets if c not in s)
        parts.append(f"""select {ml.ROW_KEY}, '{c}' as "column", round({total}, 9) as contribution from v""")
    return f"with v as materialized (select {ml.ROW_KEY}, {values} from ({rows})) " + " union all ".join(parts)
