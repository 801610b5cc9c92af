"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col
from sheaf.session import settle

OTHER = "*"


def kept_share(tokens: np.ndarray, target: np.ndarray) -> float:
    """The last value's target that, scaled with those of the other values that have tokens, is its share of the tokens."""
    named, rest = target[:-1][tokens[:-1] > 0].sum(), tokens[:-1].sum()
    return float(named * tokens[-1] / rest) if named > 0 else 1.0


def scaled(weights: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """The factors that bring each small axis in turn to its targets, those of values without tokens left out."""
    factors = np.ones(weights.shape)
    for axis, target in enumerate(targets):
        others = tuple(i for i in range(weights.ndim) if i != axis)
        wanted = np.where(tokens.sum(axis=others) > 0, target, 0.0)
        wanted = wanted / wanted.sum() if wanted.sum() > 0 else wanted
        now = (weights * factors).sum(axis=others)
        step = np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)
        factors = factors * step.reshape([-1 if i == axis else 1 for i in range(weights.ndim)])
    return factors


def _sums(table: DataFrame, values: str, n: int) -> np.ndarray:
    """The ``n`` components of the array ``values`` added up over all rows."""
    row = table.selectExpr(f"{values} AS v").selectExpr(*[f"sum(v[{j}]) AS s{j}" for j in range(n)]).first()
    return np.array([x or 0.0 for x in row])


def _array(numbers: np.ndarray) -> str:
    return "array(" + ", ".join(f"{float(x)!r}D" for x in numbers.ravel()) + ")"


def _source_factor(factors: np.ndarray) -> str:
    """What brings a source to its goal when its cells are scaled by ``factors``."""
    return f"coalesce(goal / nullif(aggregate(zip_with(t, {_array(factors)}, (x, f) -> x * f), 0D, (a, x) -> a + x), 0D), 0D)"


def fit(sources: DataFrame, shape: list[int], targets: list[np.ndarray], tokens: np.ndarray, rounds: int) -> DataFrame:
    """``sources(goal, t)`` with ``rate``, the weight per token of each cell, after ``rounds`` of proportional fitting.

    A cell's weight is its tokens times a factor of its source and one of its place on the small axes. A source's factor
    needs that source's row only, and the small axes need the sums of the cells over all sources, so a round
    is one aggregate to as many numbers as there are small cells, however many sources there are.
    """
    last = factors = np.full(tokens.size, 1.0 / max(tokens.sum(), 1e-300))
    for _ in range(rounds):
        own = sources.selectExpr("t", f"{_source_factor(factors)} AS a")
        weights = _sums(own, f"zip_with(t, {_array(factors)}, (x, f) -> x * f * a)", tokens.size)
        last, factors = factors, factors * scaled(weights.reshape(shape), tokens.reshape(shape), targets).ravel()
    own = sources.selectExpr("*", f"{_source_factor(last)} AS a")
    return own.selectExpr("*", f"transform({_array(factors)}, f -> f * a) AS rate").drop("a")


def calibration(cells: DataFrame, n: int, budget: float) -> float:
    """The factor s for which ``sum(t * min(1, s * rate))`` over all cells is ``budget``; infinite if there is too little.

    Cells whose probability reaches 1 are taken whole and the rest is scaled up, until no more cells reach it.
    """
    scale = 0.0
    while True:
        full = _sums(cells, f"zip_with(t, rate, (x, r) -> if(r * {scale!r}D > 1, x, 0D))", n)
        part = _sums(cells, f"zip_with(t, rate, (x, r) -> if(r * {scale!r}D > 1, 0D, x * r))", n)
        whole, held = full.sum(), part.sum()
        if held <= 1e-15:
            return float("inf")
        if (budget - whole) / held <= scale * (1 + 1e-12):
            return scale
        scale = float((budget - whole) / held)


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    digest = F.md5(F.concat(F.lit(salt + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    axes: dict[str, tuple[Column, dict[str, float]]],
    tokens: Column,
    share: float = 0.5,
    key: str = "doc_id",
    salt: str = "mix",
    rounds: int = 20,
    source: Column | None = None,
    temper: float = 0.5,
) -> DataFrame:
    """The sampled rows of ``docs`` with ``_tokens``, ``_weight`` and ``_probability``.

    ``axes`` has for each small marginal its column and the target weight of each value; values that are not named, and
    nulls, count together as ``*``. Without a target of its own ``*`` keeps its share of the tokens, so that
    nothing is left out unless a target of 0 asks for it. ``source`` is an axis of any number of values, one cell each
    and null one of them; its targets are the shares of the tokens to the power of ``temper``, scaled to 1, so that
    large sources give way to small ones. Only sums over the small axes reach the driver; sources stay a table.
    About ``share`` of all tokens are wanted; a cell that has too few is taken whole and the others make up for it. A
    row is taken if a number made of its key is below its cell's probability, so equal keys go together and a task
    that is run again takes the same rows. Rows without tokens are never taken. An empty table gives no rows. Columns
    ``_tokens``, ``_weight`` and ``_probability`` are replaced.
    """
    wanted = [dict.fromkeys([*target, OTHER], 0.0) | target for _, target in axes.values()]
    shape, place = [len(w) for w in wanted], F.lit(0)
    for (column, given), values in zip(axes.values(), wanted):
        at = F.lit(list(values).index(OTHER))
        for i, v in enumerate(values):
            at = at if v == OTHER else F.when(column == v, i).otherwise(at)
        place = place * len(values) + at
    n = int(np.prod(shape))
    rows = docs.withColumns({"_tokens": tokens.cast("long"), "_source": F.lit("") if source is None else source, "_place": place.cast("int")})
    held = [F.sum(F.when(F.col("_place") == j, F.col("_tokens")).otherwise(0)).cast("double") for j in range(n)]
    sums = settle(rows.groupBy("_source").agg(F.array(*[F.coalesce(h, F.lit(0.0)) for h in held]).alias("t")))
    size = F.aggregate("t", F.lit(0.0), lambda a, x: a + x)
    cells = _sums(sums, "t", n)
    tempered = F.when(size > 0, F.pow(size, F.lit(temper))).otherwise(0.0)
    all_tempered = sums.agg(F.sum(tempered)).first()[0] or 1.0
    sources = settle(sums.withColumn("goal", tempered / F.lit(all_tempered)))
    targets = [np.array(list(w.values()), float) for w in wanted]
    order = [list(w).index(OTHER) for w in wanted]
    for axis, (_, given) in enumerate(axes.values()):
        if OTHER not in given:
            others = tuple(i for i in range(len(shape)) if i != axis)
            targets[axis][order[axis]] = kept_share(cells.reshape(shape).sum(axis=others), targets[axis])
    fitted = settle(fit(sources, shape, targets, cells, rounds))
    scale = calibration(fitted, n, share * cells.sum())
    chance = F.transform("rate", lambda r: F.when(r > 0, F.least(F.lit(1.0), r * F.lit(scale))).otherwise(0.0))
    weight = F.zip_with("t", "rate", lambda t, r: t * r)
    plan = settle(fitted.select(F.col("_source").alias("_of"), weight.alias("_weights"), chance.alias("_chances")))
    taken = rows.drop("_weight", "_probability").join(plan, F.col("_source").eqNullSafe(F.col("_of")))
    taken = taken.withColumns({"_weight": F.get("_weights", F.col("_place")), "_probability": F.get("_chances", F.col("_place"))})
    return taken.where(uniform(col(key), salt) < F.col("_probability")).drop("_source", "_of", "_place", "_weights", "_chances")
