"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed to cells (source, language, topic).  Raking multiplies
the cells' weights until their sums by source, by language and by topic meet
the target shares.  Documents are then sampled.  With the targets first, the
cells' expected tokens are raked again, none above the cell's own tokens, to
the targets' shares of the budget or, where the tables hold too little of a
value for that, of the largest budget found that the targets can meet.  With
the budget first, the inclusion probability is the cell's weight per token
times one factor, at most 1, and clipped cells leave the targets.  Cells stay
in DataFrames; only sums and errors reach the driver.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import discard, materialise

DIMENSIONS = ("source", "lang", "topic")
#: Without given targets a dimension's shares are its token shares to this power.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
BUDGET, SEED = 0.8, 17
#: How near the budget found comes to the largest that the targets can meet.
CLOSE = 1.015
#: As many cells are raked in one task, without shuffles.  Spark's driver needs
#: 4 MB for each table read, stage and broadcast, so few jobs are run as well.
FEW_CELLS = 100_000


def word_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]++"))


def document_form(text: str = "text", words: Column | None = None) -> Column:
    """The default topic: the form of a text, by its words and table bars."""
    words = word_count(text) if words is None else words
    return (F.when(F.contains(F.col(text), F.lit(" | ")), "table").when(words < 100, "short")
            .when(words < 600, "medium").otherwise("long"))


def _value(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def with_cells(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``_row`` (the columns of ``docs``), ``_source, _lang, _topic, _tokens``
    (words, at least 1) and ``_draw``'s key, one row per row of ``docs``."""
    form = topic is None
    rows = docs.select(  # the words of a text are counted once
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"),
        _value(F.col("source")).alias("_source"), _value(F.col("lang")).alias("_lang"), word_count().alias("_words"),
        _key().alias("_key"), (F.lit(None).cast("string") if form else _value(topic)).alias("_topic"))
    return rows.select("_row", "_key", "_source", "_lang",
                       (_value(document_form("_text", F.col("_words"))) if form else F.col("_topic")).alias("_topic"),
                       F.greatest("_words", F.lit(1)).cast("long").alias("_tokens"))


def _kept(spark: SparkSession, cells: DataFrame, name: str, few: bool) -> DataFrame:
    """``cells`` written and read back, few of them by one task."""
    out = materialise(spark, cells.coalesce(1) if few else cells, name)
    if not few:
        return out
    one = out.coalesce(1)
    one.scratch = out.scratch
    return one


def _stepped(spark: SparkSession, step: DataFrame, name: str, few: bool, errors: list[str]) -> tuple[DataFrame, float]:
    """``step`` written, without its columns ``errors``, and their largest
    value (not by an Observation: a session that had one fails to serialise,
    and Spark ML's models with it)."""
    out = _kept(spark, step, name, few)
    kept = out.drop(*errors)
    kept.scratch = out.scratch
    return kept, max(out.agg(*[F.max(e) for e in errors]).first())


def _with_goals(spark: SparkSession, cells: DataFrame, targets: dict[str, DataFrame], total: float,
                few: bool) -> DataFrame:
    """``cells`` with ``goal_source, goal_lang, goal_topic``, the tokens that
    their values are to have (null: not in ``targets``)."""
    out = cells
    for dim in DIMENSIONS:
        values = cells.select(F.col(f"_{dim}").alias("value")).distinct()
        there = targets[dim].join(values.hint("merge") if few else values, "value")
        if few:
            share = F.sum("share").over(Window.partitionBy())
            share = F.when(share != 0, share).otherwise(1.0)
        else:
            share = F.lit(there.agg(F.sum("share")).first()[0] or 1.0)
        goal = there.select(F.col("value").alias(f"_{dim}"), (F.col("share") * (F.lit(total) / share)).alias(f"goal_{dim}"))
        out = out.join(goal.hint("merge") if few else goal, f"_{dim}", "left")
    return _kept(spark, out, "mix-goals", few)


def rake(spark: SparkSession, cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 30,
         tolerance: float = 1e-3, few: bool = False) -> DataFrame:
    """``cells`` with column ``w`` raked to ``targets`` (dimension to
    ``value, share``).  Shares of values that no cell has are spread over the
    others; without mass in a cell its weight stays 0.  Ends when every
    marginal is within ``tolerance`` of its target, or after ``rounds``.
    ``few``: one task holds all cells."""
    weighted = cells.withColumn("w", F.col("t").cast("double"))
    total = weighted.agg(F.sum("w")).first()[0]
    if not total:
        return weighted
    cells = _with_goals(spark, weighted, targets, total, few)
    factors = [f"f_{dim}" for dim in DIMENSIONS]
    for _ in range(rounds):
        step = cells
        for dim in DIMENSIONS:
            value, goal = f"_{dim}", F.col(f"goal_{dim}")
            if few:
                step = step.withColumn(f"f_{dim}", F.coalesce(F.try_divide(
                    goal, F.sum("w").over(Window.partitionBy(value))), F.lit(1.0)))
            else:
                step = step.join(step.groupBy(value).agg(F.coalesce(F.try_divide(
                    F.max(goal), F.sum("w")), F.lit(1.0)).alias(f"f_{dim}")), value)
            step = step.withColumn("w", F.col("w") * F.col(f"f_{dim}"))
        for f in factors:
            step = step.withColumn(f, F.abs(F.col(f) - 1))
        before = cells
        cells, worst = _stepped(spark, step, "mix-cells", few, factors)
        discard(spark, before)
        if worst < tolerance:
            break
    return cells.drop(*[f"goal_{dim}" for dim in DIMENSIONS])


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """``value, share``: token shares of ``dim`` to ``power``."""
    return cells.groupBy(F.col(f"_{dim}").alias("value")).agg(F.pow(F.sum("t").cast("double"), F.lit(power)).alias("share"))


def _factor(cells: DataFrame, budget: float) -> float:
    """The factor at which ``sum(t * min(1, factor * w / t))`` meets the
    budget's share of all tokens; found by three rounds of a grid."""
    low, high, total = cells.agg(F.min(F.col("t") / F.col("w")), F.max(F.col("t") / F.col("w")), F.sum("t")).first()
    if low is None:
        return 0.0
    if budget >= 1:
        return high
    low *= min(1.0, budget)
    for _ in range(3):
        grid = [low * (high / low) ** (i / 64) for i in range(65)]
        sums = cells.agg(*[F.sum(F.col("t") * F.least(F.lit(1.0), F.lit(g) * F.col("w") / F.col("t"))).alias(f"g{i}")
                           for i, g in enumerate(grid)]).first()
        i = next((i for i, s in enumerate(sums) if s >= budget * total), 64)
        low, high = grid[max(0, i - 1)], grid[i]
        if low >= high:
            break
    return high


def reachable(cells: DataFrame, dim: str, power: float, budget: float) -> DataFrame:
    """``value, share``: tempered shares, none above what the value has of the
    budget's tokens: a value with few tokens is asked for all of them, and
    does not hold back all others."""
    total = cells.agg(F.sum("t")).first()[0] or 1
    have, every = F.sum("t").cast("double"), Window.partitionBy()
    rows = cells.groupBy(F.col(f"_{dim}").alias("value")).agg(
        (have / F.lit(min(1.0, budget) * total)).alias("cap"), F.pow(have, F.lit(power)).alias("w"))
    # one row per value: few enough for one task.  A value is full if the sum of min(cap, f w) is still
    # within 1 at the f that fills it
    upto = Window.orderBy(F.col("cap") / F.col("w"))
    rows = rows.withColumn("full", F.sum("cap").over(upto) + F.col("cap") / F.col("w") * (
        F.sum("w").over(every) - F.sum("w").over(upto)) <= 1)
    room = 1 - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    return rows.select("value", F.when(F.col("full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.try_divide(room, free) * F.col("w"))).alias("share"))


def _bounded_step(cells: DataFrame, dim: str, budget: float) -> DataFrame:
    """``z`` of each value's cells times the factor at which the sum of
    ``min(t, z)`` is the value's goal; ``e_dim`` is its error before.  A cell
    is full if the sum is still within the goal when ``z`` reaches its ``t``."""
    value, goal = Window.partitionBy(f"_{dim}"), F.col(f"goal_{dim}") * F.lit(budget)
    upto = value.orderBy("_at")
    z, t, full = F.col("z"), F.col("t").cast("double"), F.col("_full")
    step = cells.withColumn("_at", F.when(z > 0, F.try_divide(t, z)).otherwise(F.lit(float("inf"))))
    step = step.withColumns({
        f"e_{dim}": F.coalesce(F.abs(F.try_divide(F.sum(F.least(t, z)).over(value), goal) - 1), F.lit(0.0)),
        "_full": F.coalesce((z > 0) & (F.sum(t).over(upto) + F.col("_at") * (
            F.sum(z).over(value) - F.sum(z).over(upto)) <= goal), F.lit(False))})
    free = F.sum(F.when(full, 0.0).otherwise(z)).over(value)
    factor = F.when(free > 0, F.try_divide(goal - F.sum(F.when(full, t).otherwise(0.0)).over(value), free)).otherwise(
        F.max(F.when(z > 0, F.col("_at"))).over(value))
    return step.withColumn("z", F.coalesce(z * F.when(goal > 0, factor), z)).drop("_at", "_full")


def _bounded(spark: SparkSession, cells: DataFrame, budget: float, few: bool, rounds: int = 6,
             tolerance: float = 1e-3) -> DataFrame | None:
    """``cells`` with column ``z``, so that ``min(t, z)`` has the marginals
    ``budget`` times ``goal_source, goal_lang, goal_topic`` (within
    ``tolerance``); None if ``rounds`` of three sweeps do not get there or
    one does not halve the error."""
    last, mine, errors = float("inf"), None, [f"e_{dim}" for dim in DIMENSIONS]
    step = cells.withColumn("z", F.col("w") * F.lit(budget))
    for _ in range(rounds):
        for _ in range(3):
            for dim in DIMENSIONS:
                step = _bounded_step(step, dim, budget)
        before = mine
        mine, worst = _stepped(spark, step, "mix-bounded", few, errors)
        if before is not None:
            discard(spark, before)
        if worst < tolerance:
            return mine
        if worst > last / 2:
            break
        last, step = worst, mine
    discard(spark, mine)
    return None


def _probabilities(spark: SparkSession, raked: DataFrame, targets: dict[str, DataFrame], budget: float,
                   few: bool) -> DataFrame:
    """``raked`` with ``z`` (``min(t, z)`` are a cell's expected tokens, which
    meet the targets) and the ``budget`` that was found: the asked one, or
    one within ``CLOSE`` of the largest that works, between the most that any
    single value allows and the one that fills no cell."""
    total, sure = raked.where("w > 0").agg(F.sum("t"), F.min(F.col("t") / F.col("w"))).first()
    found = None
    if sure >= budget:
        sure = budget
    else:
        most = budget
        raked = _with_goals(spark, raked, targets, float(total), few)
        for dim in DIMENSIONS:
            have = raked.groupBy(f"_{dim}").agg(F.sum("t").alias("have"), F.max(f"goal_{dim}").alias("goal"))
            most = min(most, 0.99 * (have.where("goal > 0").agg(F.min(F.col("have") / F.col("goal"))).first()[0] or 1.0))
        share = most / CLOSE  # mostly it works, and nothing is left to search
        while share > sure:
            tried = _bounded(spark, raked, share, few)
            if tried is None:
                most = share
            else:
                if found is not None:
                    discard(spark, found)
                found, sure = tried, share
            share = math.sqrt(sure * most) if most > sure * CLOSE * (1 + 1e-9) else 0.0
        warnings.warn(f"mixing: the targets allow {sure:.4f} of the tokens; the budget is {budget}")
    if found is None:
        found = raked.withColumn("z", F.col("w") * F.lit(sure))
    return found.withColumn("budget", F.lit(sure))


def mixing_cells(spark: SparkSession, docs: DataFrame, targets: dict[str, DataFrame] | None = None,
                 budget: float = BUDGET, topic: Column | None = None, targets_first: bool = False,
                 within_reach: bool = False) -> DataFrame:
    """One row per cell: ``t`` tokens, raked ``weight`` per token (mean 1),
    the inclusion ``probability`` of its documents and the ``budget`` that the
    probabilities meet.  ``targets_first``: the expected tokens have the
    target shares, if need be of less than ``budget``; otherwise they meet
    ``budget``, and clipped cells leave the targets.  ``within_reach``: of a
    dimension without given targets, the shares of ``reachable``."""
    cells = materialise(spark, with_cells(docs, topic).groupBy("_source", "_lang", "_topic").agg(
        F.sum("_tokens").alias("t")), "mix-tokens")
    if few := cells.limit(FEW_CELLS + 1).count() <= FEW_CELLS:
        before, cells = cells, _kept(spark, cells, "mix-tokens", few)
        discard(spark, before)
    targets = dict(targets or {})
    for dim in DIMENSIONS:
        if dim not in targets:
            targets[dim] = (reachable(cells, dim, TEMPER[dim], budget) if within_reach
                            else tempered(cells, dim, TEMPER[dim]))
    raked = rake(spark, cells, targets, few=few)
    if not raked.take(1):
        return raked.select("_source", "_lang", "_topic", "t", F.lit(0.0).alias("weight"),
                            F.lit(0.0).alias("probability"), F.lit(0.0).alias("budget"))
    if targets_first:
        placed = _probabilities(spark, raked, targets, budget, few)
    else:
        placed = raked.withColumn("z", F.lit(_factor(raked.where("w > 0"), budget)) * F.col("w")).withColumn(
            "budget", F.lit(float(budget)))
    return placed.select("_source", "_lang", "_topic", "t", (F.col("w") / F.col("t")).alias("weight"),
                         F.least(F.lit(1.0), F.col("z") / F.col("t")).alias("probability"), "budget")


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))


def draw(seed: int = SEED, key: Column | None = None) -> Column:
    """A number in [0, 1) fixed by the document's id (without one, its text)."""
    key = _key() if key is None else key
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 12), 16, 10).cast("double") / float(1 << 48)


def mixed(spark: SparkSession, docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``_row`` (the columns of ``docs``), ``_source, _lang, _topic, _tokens,
    _weight, _probability, _sampled``, one row per row of ``docs``; unless told
    otherwise, the targets go before the budget.  Null and blank values are
    values of their own; null and blank texts count one token; rows with the
    same id are drawn alike; an empty table gives no rows."""
    topic = how.get("topic")
    cells = mixing_cells(spark, docs, **{"targets_first": True, **how}).select(
        "_source", "_lang", "_topic", F.col("weight").alias("_weight"), F.col("probability").alias("_probability"))
    out = with_cells(docs, topic).join(cells, ["_source", "_lang", "_topic"])
    return out.select("_row", "_source", "_lang", "_topic", "_tokens", "_weight", "_probability",
                      (draw(seed, F.col("_key")) < F.col("_probability")).alias("_sampled"))


def mixed_sample(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The sampled rows of ``docs``, all its columns unchanged (see ``mixed``
    for nulls, repeated rows and empty tables)."""
    return mixed(spark, docs, **how).where("_sampled").select("_row.*")
