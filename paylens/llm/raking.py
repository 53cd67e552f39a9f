"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted in cells of source, language and topic. The cells' weights are raked: scaled
until their sums over each source, each language and each topic match the target shares, one
margin after the other, round by round. A document is then drawn with the probability that brings
its cell to its weight. Everything is DataFrame operations; cells are aggregated before anything
moves, and documents meet their cell's probability in a lookup join.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .store import stored

MARGINS = ("source", "lang", "topic")
NONE = "(none)"
WORD = "[^\\x20\\x09-\\x0D]+"
FEW = 200_000  # cells that are fitted in the driver; more are fitted where they lie, by a written table a round
LOG = logging.getLogger(__name__)

# Marks that put a document under a topic; the first topic with a mark holds.
TOPICS: dict[str, tuple[str, ...]] = {
    "legal": ("icense", "opyright", "ights reserved"),
    "technical": ("password", "token =", "AKIA"),
    "contact": ("@", "+1 ("),
    "noisy": ("***", "$$$", "%%%", "&&&", "###", "!!"),
}
OTHER = "general"


@dataclass(frozen=True)
class Mix:
    """Target shares and sampling rate.

    ``shares``: of the values of a margin. Values that are not named, and missing ones, share what the named
    ones leave, by their tokens; if the named shares add up to one, they have their own share of the tokens and the
    named ones share the rest (without ``own`` they are never drawn then). Named values without tokens are left out and
    the rest scaled to one. A margin that is not named here is flattened: its target is tokens to the power ``flatten``.
    ``rate``: share of all tokens to draw. Fitting goes on until no margin is off by more than ``close`` of all drawn tokens, at
    most ``rounds``, or ``most`` rounds. Margins that are still off are logged.
    ``bounded``: no cell is fitted beyond the tokens it has; what a scarce cell cannot give comes
    from others of its source, language and topic, and what a scarce value cannot give from the
    other values of its margin, by their targets. Targets that cannot be met together are moved
    towards the shares of the tokens, as far as it takes, and logged. Otherwise such cells are cut after fitting.
    """

    shares: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: {
        "lang": {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15},
        "topic": {"general": 0.8, "legal": 0.05, "technical": 0.03, "contact": 0.07, "noisy": 0.05},
    })
    flatten: float = 0.5
    rate: float = 0.4
    rounds: int | None = None
    close: float = 1e-9
    seed: str = "mix"
    own: bool = True
    most: int = 10_000
    bounded: bool = True


def topic_of(text: Column) -> Column:
    found = F.lit(OTHER)
    for name, marks in reversed(TOPICS.items()):
        found = F.when(reduce(or_, (F.contains(text, F.lit(m)) for m in marks)), F.lit(name)).otherwise(found)
    return found


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with its cell and tokens in columns of their own (``__mix_source``, ``__mix_lang``, ``__mix_topic``, ``__mix_tokens``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "__mix_source": F.coalesce("source", F.lit(NONE)), "__mix_lang": F.coalesce("lang", F.lit(NONE)), "__mix_topic": topic_of(text),
        "__mix_tokens": F.regexp_count(text, F.lit(WORD)).cast("long")})


def _share(part: Column, whole: Column) -> Column:
    """Of nothing, every share is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def targets(cells: DataFrame, margin: str, mix: Mix) -> DataFrame:
    """The margin's values with tokens, and ``target``: the share of all tokens that each should have."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    named = mix.shares.get(margin)
    if named is None:
        raw = F.pow(F.col("t").cast("double"), F.lit(mix.flatten))
    else:
        left = max(0.0, 1.0 - sum(named.values()))
        given = reduce(lambda c, kv: F.when(F.col(margin) == kv[0], F.lit(float(kv[1]))).otherwise(c), named.items(), F.lit(None).cast("double"))
        unnamed = F.when(given.isNull(), F.col("t"))
        total = sums.agg(F.sum(unnamed).alias("u"))
        raw = F.coalesce(given, F.col("t") / F.col("u") * left)
        sums = sums.join(F.broadcast(total))  # one row
        if mix.own and left < 1e-9:
            each = sums.agg(F.sum("t").alias("all"), F.sum(F.when(given.isNotNull(), given)).alias("named"))
            rest = 1 - F.coalesce(F.col("u"), F.lit(0)) / F.col("all")
            sums, raw = sums.join(F.broadcast(each)), F.coalesce(given / F.col("named") * rest, F.col("t") / F.col("all"))
    sums = sums.withColumn("raw", raw)
    whole = sums.agg(F.sum("raw").alias("whole"))
    return sums.join(F.broadcast(whole)).select(margin, _share(F.col("raw"), F.col("whole")).alias("target"))


def _feasible(goals: list[np.ndarray], codes: list[np.ndarray], cap: np.ndarray) -> list[np.ndarray]:
    """``goals`` that ``cap`` can meet, each margin by itself: what a value cannot give goes to the others."""
    alive = np.all([goal[code] > 0 for code, goal in zip(codes, goals)], axis=0)
    out = []
    for code, goal in zip(codes, goals):
        has = np.bincount(code, cap * alive, len(goal))
        goal = np.minimum(goal, has)
        while (gap := 1 - goal.sum()) > 1e-15 and (free := (goal > 0) & (goal < has)).any():
            goal = np.minimum(has, np.where(free, goal * (1 + gap / goal[free].sum()), goal))
        out.append(goal)
    least = min(goal.sum() for goal in out)
    return [goal * _ratio(least, goal.sum()) for goal in out]


def _ratio(part, whole):
    return np.divide(part, whole, out=np.zeros(np.shape(whole)), where=np.asarray(whole) > 0)


def _stalled(offs: list[float]) -> bool:
    """Whether a hundred rounds brought nothing."""
    return len(offs) > 200 and offs[-1] > 0.98 * offs[-101]


def _rake(codes: list[np.ndarray], goals: list[np.ndarray], weight: np.ndarray, cap: np.ndarray, mix: Mix) -> tuple[np.ndarray, float]:
    """A step scales the cells that are not full to what the full ones leave of the target, and cuts them at ``cap``."""
    offs: list[float] = []
    for _ in range(mix.rounds or mix.most):
        for code, goal in zip(codes, goals):
            sums = np.bincount(code, weight, len(goal))
            full = np.bincount(code, np.where(weight >= cap, weight, 0), len(goal))
            more = np.where(sums - full > 1e-15, _ratio(goal - full, sums - full), 1.0)
            scale = np.where(goal <= sums, _ratio(goal, sums), more)
            weight = np.minimum(cap, weight * scale[code])
        offs.append(max(np.abs(np.bincount(code, weight, len(goal)) - goal).max() for code, goal in zip(codes, goals)))
        if offs[-1] <= mix.close or (mix.bounded and _stalled(offs)):
            break
    return weight, offs[-1]


def _nearest(attempt, close: float):
    """The first of the results of ``attempt(0)`` to ``attempt(1)`` in sixteenths that is off by no more than ``close``, and the place."""
    best, at = attempt(0.0), 0.0
    low, high = 0, 16
    if best[1] > close:
        best, at = attempt(1.0), 1.0
        while high - low > 1:
            middle = (low + high) // 2
            found = attempt(middle / 16)
            if found[1] <= close:
                best, at, high = found, middle / 16, middle
            else:
                low = middle
        LOG.warning("mix: the targets cannot be met together; they are moved by %.4g of the way to the shares of the tokens", at)
    return best


def fit(codes: list[np.ndarray], goals: list[np.ndarray], tokens: np.ndarray, mix: Mix) -> tuple[np.ndarray, float]:
    """Raked weights of cells, and how far the worst margin is off. ``codes`` has each cell's place in each margin's ``goals``."""
    weight = tokens / tokens.sum()
    if not mix.bounded:
        return _rake(codes, goals, weight, np.full(len(tokens), np.inf), mix)
    cap = weight / mix.rate
    met = _feasible(goals, codes, cap)
    short = max(np.abs(a - b).max() for a, b in zip(goals, met))
    if short > mix.close:
        LOG.warning("mix: the tokens there are leave a target short by %.3g of all drawn ones", short)
    alive = np.all([goal[code] > 0 for code, goal in zip(codes, met)], axis=0)
    held = weight * alive
    shares = [np.bincount(code, held, len(goal)) * _ratio(goal.sum(), held.sum()) for code, goal in zip(codes, met)]
    return _nearest(lambda t: _rake(codes, [(1 - t) * goal + t * share for goal, share in zip(met, shares)], held, cap, mix), mix.close)


def _raked_here(cells: DataFrame, goals: dict[str, DataFrame], mix: Mix) -> tuple[DataFrame, float]:
    """In the driver, which holds a few numbers for each cell."""
    rows = cells.select(*MARGINS, "tokens").toArrow()
    if not rows.num_rows:
        return cells.withColumn("weight", F.lit(0.0)), 0.0
    codes, wanted = [], []
    for m in MARGINS:
        goal = {r[m]: r["target"] for r in goals[m].collect()}
        place = {value: k for k, value in enumerate(goal)}
        codes.append(np.array([place[v] for v in rows.column(m).to_pylist()]))
        wanted.append(np.array(list(goal.values()), float))
    weight, worst = fit(codes, wanted, rows.column("tokens").to_numpy().astype(float), mix)
    return cells.sparkSession.createDataFrame(rows.append_column("weight", pa.array(weight))), worst


def _raked_there(cells: DataFrame, goals: dict[str, DataFrame], mix: Mix) -> tuple[DataFrame, float]:
    """By aggregates and joins."""
    weight = F.col("tokens") / cells.agg(F.sum("tokens")).first()[0]
    begun = cells.withColumn("weight", weight).withColumn("cap", weight / mix.rate if mix.bounded else F.lit(float("inf")))
    if not mix.bounded:
        return _rake_there(begun, goals, mix)
    met = _feasible_there(begun, goals)
    for m in MARGINS:
        begun = begun.join(met[m].filter("target > 0").select(m), m, "left_semi")
    begun = stored(begun, "begun")
    held = begun.agg(F.sum("weight")).first()[0] or 0.0
    whole = met[MARGINS[0]].agg(F.sum("target")).first()[0] or 0.0
    shares = {m: begun.groupBy(m).agg((F.sum("weight") * (whole / held if held else 0.0)).alias("share")) for m in MARGINS}
    moved = lambda m, t: met[m].join(shares[m], m).select(m, (F.col("target") * (1 - t) + F.col("share") * t).alias("target"))
    return _nearest(lambda t: _rake_there(begun, {m: stored(moved(m, t), f"target-{m}") for m in MARGINS}, mix), mix.close)


def _rake_there(fitted: DataFrame, goals: dict[str, DataFrame], mix: Mix) -> tuple[DataFrame, float]:
    """:func:`_rake` by aggregates and joins."""
    offs: list[float] = []
    full = F.when(F.col("weight") >= F.col("cap"), F.col("weight")).otherwise(0.0)
    for _ in range(mix.rounds or mix.most):
        off = []
        for margin in MARGINS:
            sums = fitted.groupBy(margin).agg(F.sum("weight").alias("_sum"), F.sum(full).alias("_full"))
            free = F.col("_sum") - F.col("_full")
            more = F.when(free > 1e-15, (F.col("target") - F.col("_full")) / free).otherwise(1.0)
            step = F.when(F.col("target") <= F.col("_sum"), _share(F.col("target"), F.col("_sum"))).otherwise(more)
            scale = sums.join(goals[margin], margin).select(margin, step.alias("_scale"))
            fitted = fitted.join(scale, margin).withColumn("weight", F.least("cap", F.col("weight") * F.col("_scale"))).drop("_scale")
        fitted = stored(fitted, "raked")
        for margin in MARGINS:
            sums = fitted.groupBy(margin).agg(F.sum("weight").alias("_sum")).join(goals[margin], margin)
            off.append(sums.select(F.abs(F.col("_sum") - F.col("target")).alias("off")))
        offs.append(reduce(DataFrame.union, off).agg(F.max("off")).first()[0] or 0.0)
        if offs[-1] <= mix.close or (mix.bounded and _stalled(offs)):
            break
    return fitted.drop("cap"), offs[-1]


def _feasible_there(cells: DataFrame, goals: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`_feasible` by aggregates and joins."""
    alive = cells
    for m in MARGINS:
        alive = alive.join(goals[m].filter("target > 0").select(m), m, "left_semi")
    out, wholes = {}, {}
    for m in MARGINS:
        has = alive.groupBy(m).agg(F.sum("cap").alias("has"))
        goal = stored(goals[m].join(has, m, "left").select(m, F.coalesce("has", F.lit(0.0)).alias("has"), F.least("target", F.coalesce("has", F.lit(0.0))).alias("target")), "goal")
        free = F.when((F.col("target") > 0) & (F.col("target") < F.col("has")), F.col("target"))
        while True:
            whole, left = goal.agg(F.sum("target"), F.sum(free)).first()
            if not left or 1 - whole <= 1e-15:
                break
            goal = stored(goal.withColumn("target", F.least("has", F.when(free.isNotNull(), F.col("target") * (1 + (1 - whole) / left)).otherwise(F.col("target")))), "goal")
        out[m], wholes[m] = goal.drop("has"), whole or 0.0
    least = min(wholes.values())
    return {m: goal.withColumn("target", F.col("target") * (least / wholes[m] if wholes[m] else 0.0)) for m, goal in out.items()}


def raked(cells: DataFrame, mix: Mix) -> DataFrame:
    """``cells`` (margins and ``tokens``) with ``weight``: raked shares, which add up to one, or under
    a bound to less if the targets leave too few tokens."""
    cells = stored(cells.filter("tokens > 0"), "filled")
    goals = {m: stored(targets(cells, m, mix), f"target-{m}") for m in MARGINS}
    fitted, worst = (_raked_here if cells.count() <= FEW else _raked_there)(cells, goals, mix)
    if worst > mix.close:
        LOG.warning("mix: a margin is off by %.3g of all tokens after %d rounds", worst, mix.rounds or mix.most)
    return fitted


def probabilities(docs: DataFrame, mix: Mix) -> DataFrame:
    """``__mix_source``, ``__mix_lang``, ``__mix_topic``, ``__mix_chance`` of every cell with tokens, from described documents."""
    cells = docs.groupBy(*(F.col(f"__mix_{m}").alias(m) for m in MARGINS)).agg(F.sum("__mix_tokens").alias("tokens"))
    fitted = raked(stored(cells, "cells"), mix)
    # at most all tokens of a cell can be drawn
    total = fitted.agg(F.sum("tokens").alias("_all"), F.sum("weight").alias("_whole"))
    share = F.col("weight") if mix.bounded else _share(F.col("weight"), F.col("_whole"))
    wanted = share * F.col("_all") * mix.rate
    shared = fitted.join(F.broadcast(total)).withColumn("probability", F.least(F.lit(1.0), wanted / F.col("tokens")))
    return stored(shared.select(*(F.col(m).alias(f"__mix_{m}") for m in MARGINS),
                                F.col("probability").alias("__mix_chance")), "probabilities")


def sampled(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` with ``__mix_source``, ``__mix_lang``, ``__mix_topic``, ``__mix_tokens``, ``__mix_probability`` and ``__mix_kept``.

    Needs ``doc_id``, ``text``, ``source`` and ``lang``; further columns pass through. A document
    is kept where a number drawn from its id lies below its cell's probability, so repeated rows
    are kept or left together. A missing source or language is a value of its own; a document
    without an id is drawn by its text. Null, empty and blank texts have no tokens: they do not
    count, their probability is 1 and they are kept. An empty table gives an empty result.
    """
    rows = described(docs)
    chances = probabilities(rows, mix)
    keys = [f"__mix_{m}" for m in MARGINS]
    joined = lookup_join(rows, chances, keys, ["doc_id"])
    chance = F.when(F.col("__mix_tokens") == 0, F.lit(1.0)).otherwise(F.coalesce("__mix_chance", F.lit(0.0)))
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text")), F.lit(""))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(mix.seed + ":"), name)), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return joined.withColumn("__mix_probability", chance).withColumn("__mix_kept", drawn < F.col("__mix_probability")).drop("__mix_chance")


def oracle(mix: Mix = Mix()) -> str:
    """The result of the query over ``documents`` in DuckDB, where the targets can be met together. Targets are
    filled up, and rounds repeated, by recursion."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    topic = " ".join(f"when {' or '.join(f'contains(x, {quoted(m)})' for m in marks)} then '{name}'" for name, marks in TOPICS.items())
    steps = [
        f"""d as materialized (select doc_id, coalesce(source, '{NONE}') as source, coalesce(lang, '{NONE}') as lang, case {topic} else '{OTHER}' end as topic,
            len(regexp_extract_all(x, '{WORD}')) as tokens, text from (select *, coalesce(text, '') as x from documents))""",
        "c as materialized (select source, lang, topic, sum(tokens)::double as tokens from d group by 1, 2, 3 having sum(tokens) > 0)",
    ]
    for m in MARGINS:
        if m in mix.shares:
            named = mix.shares[m]
            given = f"case {m} " + " ".join(f"when {quoted(k)} then {v!r}e0" for k, v in named.items()) + " end"
            left = max(0.0, 1.0 - sum(named.values()))
            raw = f"coalesce({given}, t / (sum(case when {given} is null then t end) over ()) * {left!r}e0)"
            if left < 1e-9:
                rest = f"(1 - coalesce(sum(case when {given} is null then t end) over (), 0) / sum(t) over ())"
                raw = f"coalesce({given} / sum({given}) over () * {rest}, t / sum(t) over ())"
        else:
            raw = f"pow(t, {mix.flatten!r}e0)"
        steps.append(f"t_{m} as materialized (select {m}, raw / sum(raw) over () as target from (select {m}, {raw} as raw from "
                     f"(select {m}, sum(tokens) as t from c group by 1)))")
    wanted = " and ".join(f"{m} in (select {m} from t_{m} where target > 0)" for m in MARGINS)
    steps.append(f"""b as materialized (select * from (select *, tokens / sum(tokens) over () as weight, tokens / sum(tokens) over () / {mix.rate!r}e0 as cap from c)
        where {wanted})""")
    for m in MARGINS:
        free = "target > 0 and target < has"
        steps.append(f"""h_{m} as (select 0 as step, {m}, has, least(target, has) as target from t_{m} join (select {m}, sum(cap) as has from b group by 1) using ({m})
            union all select step + 1, {m}, has, least(has, if({free}, target * (1 + (1 - whole) / free), target)) from
              (select *, sum(target) over () as whole, sum(target) filter ({free}) over () as free from h_{m}) where free > 0 and 1 - whole > 1e-15)""")
        steps.append(f"f_{m} as materialized (select {m}, target, sum(target) over () as whole from h_{m} where step = (select max(step) from h_{m}))")
    least = f"least({', '.join(f'(select max(whole) from f_{m})' for m in MARGINS)})"
    steps += [f"g_{m} as materialized (select {m}, target * ({least} / whole) as target from f_{m})" for m in MARGINS]
    inner = f"select * from w where off > {mix.close!r}::double and round < {mix.most}"
    for m in MARGINS:
        step = f"""case when g.target <= s then coalesce(g.target / nullif(s, 0), 0) when s - f > 1e-15 then (g.target - f) / (s - f) else 1 end"""
        inner = f"""select x.* exclude (s, f) replace (least(cap, weight * ({step})) as weight) from (select *, sum(weight) over (partition by {m}) as s,
            sum(if(weight >= cap, weight, 0)) over (partition by {m}) as f from ({inner})) x join g_{m} g using ({m})"""
    far = ", ".join(f"max(abs(s_{m} - g_{m}.target)) over ()" for m in MARGINS)
    sums = ", ".join(f"sum(weight) over (partition by {m}) as s_{m}" for m in MARGINS)
    steps.append(f"""w as (select 0 as round, source, lang, topic, tokens, weight, cap, 1e9::double as off from b
        union all select round + 1, source, lang, topic, tokens, weight, cap, greatest({far}) from
          (select *, {sums} from ({inner})) {' '.join(f'join g_{m} using ({m})' for m in MARGINS)})""")
    steps.append(f"""p as (select *, least(1e0, weight * (select sum(tokens) from c) * {mix.rate!r}e0 / tokens) as probability from w where round = (select max(round) from w))""")
    steps.append("""r as (select d.*, case when d.tokens = 0 then 1e0 else coalesce(p.probability, 0) end as chance,
        ('0x' || substr(md5('%s:' || coalesce(doc_id::varchar, md5(text), '')), 1, 8))::bigint / 4294967296e0 as drawn
        from d left join p on d.source = p.source and d.lang = p.lang and d.topic = p.topic)""" % mix.seed)
    return "with recursive " + ", ".join(steps) + """ select doc_id, source, lang, topic, tokens::bigint as n_tokens, round(chance, 6) as probability,
        drawn < chance as kept from r"""
