"""Mixing sources to target weights by iterative proportional fitting (operator 3, DataFrame functions only).

Token counts are summed per cell of all dimensions (source, language, topic). Raking multiplies a dimension's cells by
target over actual share, dimension after dimension, until every marginal is met; what results are the cells' token weights. A document
of a cell is kept with probability ``min(1, scale * weight / tokens)``. ``scale`` is the largest at which no cell
would have to repeat documents, or meets a ``budget`` of tokens, then cells that reach probability 1 pass on their excess.
The draw is a hash of the document id, so it is the same in every run.

Documents are read once to be counted and once to be drawn; only cell sums move. Cells are a table as well: marginals
are partial sums joined back, no dimension's cells meet in one task by design. What is summed and joined to its own sums is
stored first, so that no plan holds the steps of another: unstored, each such join doubles the plan that the driver keeps.

Edge cases: a null dimension value is a value of its own; a null or empty text has no tokens, and weight, probability
and ``sampled`` of a cell without tokens are 0, 0 and false. A target share for a value without tokens is spread over
the others; values without a target keep their present share of what is left. A null id draws like the id ''; repeated ids share their draw. Other
columns are kept by :func:`sample`, also when they are named like a result column, which is then replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.session import materialize

ROUNDS = 50
TOLERANCE = 1e-9


def token_count(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares in proportion to a power of the present token sums: ``value``, ``share``."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("_t")).where("_t > 0")
    raised = sums.select("value", F.pow("_t", F.lit(power)).alias("_p"))
    return raised.join(raised.agg(F.sum("_p").alias("_all")), how="cross").select("value", (F.col("_p") / F.col("_all")).alias("share"))


def cell_table(df: DataFrame, dimensions: Sequence[str], tokens: Column) -> DataFrame:
    return df.groupBy(*dimensions).agg(F.sum(tokens).cast("double").alias("tokens"))


def complete_targets(cells: DataFrame, dimension: str, targets: DataFrame) -> DataFrame:
    """Target shares of the values that have tokens, summing to 1; other values share the rest as they do now. Stored."""
    sums = cells.groupBy(F.col(dimension).alias("_v")).agg(F.sum("tokens").alias("_t")).where("_t > 0")
    met = materialize(sums.join(targets, F.col("_v").eqNullSafe(F.col("value")), "left"), "shares")
    whole = met.agg(
        F.coalesce(F.sum("share"), F.lit(0.0)).alias("_given"),
        F.coalesce(F.sum(F.when(F.col("share").isNull(), F.col("_t"))), F.lit(0.0)).alias("_open"),
    )
    rest = F.greatest(1 - F.col("_given"), F.lit(0.0))
    share = F.coalesce("share", rest * F.col("_t") / F.col("_open"))
    out = materialize(met.join(whole, how="cross").select("_v", share.alias("_s")), "shares")
    total = out.agg(F.sum("_s").alias("_sum"))
    summed = out.join(total, how="cross").select("_v", (F.col("_s") / F.col("_sum")).alias("_s"))
    return materialize(summed.where("_s > 0"), "shares")


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``cells`` with ``weight``, token shares whose marginals are the targets, and ``gap``, how far they are from them at most.

    Each round fits the dimensions in order, every fit stored. It ends when the largest difference between a marginal
    and its target before a round's fits is at most ``tolerance``, or after ``rounds``; targets that no weights of the present
    cells can meet together leave a ``gap``.
    """
    total = cells.agg(F.sum("tokens").alias("_total"))
    state = cells.join(total, how="cross").withColumn("weight", F.coalesce(F.col("tokens") / F.col("_total"), F.lit(0.0))).drop("_total")
    # Each cell carries its targets, so that a fit joins the cells with one sum only.
    shares = {}
    for i, (dimension, table) in enumerate(targets.items()):
        want = complete_targets(cells, dimension, table).withColumnsRenamed({"_v": f"_v{i}", "_s": f"_s{i}"})
        state = state.join(want, F.col(dimension).eqNullSafe(F.col(f"_v{i}")), "left").drop(f"_v{i}")
        shares[dimension] = F.coalesce(f"_s{i}", F.lit(0.0))
    state = materialize(state.withColumn("_off", F.lit(0.0)), "cells")
    for _ in range(rounds):
        fitted = state.withColumn("_off", F.lit(0.0))
        for dimension, share in shares.items():
            have = fitted.groupBy(F.col(dimension).alias("_v")).agg(F.sum("weight").alias("_w"))
            fitted = materialize(
                fitted.join(have, F.col(dimension).eqNullSafe(F.col("_v")))
                .withColumn("weight", F.when(F.col("_w") > 0, F.col("weight") * share / F.col("_w")).otherwise(F.lit(0.0)))
                .withColumn("_off", F.greatest("_off", F.abs(share - F.col("_w"))))
                .drop("_v", "_w"),
                "cells",
            )
        state = fitted
        if (state.agg(F.max("_off")).first()[0] or 0.0) <= tolerance:
            break
    gap = reduce(DataFrame.union, [_gaps(state, dimension, share) for dimension, share in shares.items()])
    gap = gap.agg(F.coalesce(F.max("_gap"), F.lit(0.0)).alias("gap"))
    # Stored, as the calibration reads it many times.
    return materialize(state.drop("_off", *[f"_s{i}" for i in range(len(shares))]).join(gap, how="cross"), "cells")


def _gaps(state: DataFrame, dimension: str, share: Column) -> DataFrame:
    """How far each value of a dimension is from its target."""
    return state.groupBy(dimension).agg(F.sum("weight").alias("_w"), F.max(share).alias("_s")).select(
        F.abs(F.col("_w") - F.col("_s")).alias("_gap")
    )


def calibrate(cells: DataFrame, budget: float | None = None) -> DataFrame:
    """``cells`` with ``probability``: tokens drawn in proportion to the weights.

    Without a ``budget`` the draw is as large as the tightest cell allows. With one, the scale is raised until the
    expected tokens meet it, as far as there are tokens, cells at probability 1 giving all they have.
    """
    ratio = F.when((F.col("tokens") > 0) & (F.col("weight") > 0), F.col("tokens") / F.col("weight"))
    if budget is None:
        scale = cells.agg(F.min(ratio).alias("_scale"))
        scaled = cells.join(scale, how="cross")
    else:
        # Few rounds: each settles the cells that are full at the present scale.
        scale_now = 0.0
        for _ in range(ROUNDS):
            full = (F.col("weight") * scale_now >= F.col("tokens")) & (F.col("weight") > 0)
            row = cells.agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("full"),
                F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"),
            ).first()
            if not row["open"] or row["open"] <= 0:
                break
            raised = max(0.0, budget - row["full"]) / row["open"]
            if raised <= scale_now * (1 + 1e-12):
                break
            scale_now = raised
        scaled = cells.withColumn("_scale", F.lit(scale_now))
    chance = F.least(F.lit(1.0), F.col("_scale") * F.col("weight") / F.col("tokens"))
    return scaled.withColumn("probability", F.when(F.col("tokens") > 0, chance).otherwise(F.lit(0.0))).drop("_scale")


def draw(id_col: str) -> Column:
    """A number in [0, 1) that follows from the id."""
    key = F.xxhash64(F.lit("mixing"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))


def _matched(df, dimensions, powers, targets, budget, budget_share, text_col) -> tuple[DataFrame, str]:
    """``df`` with, under a prefix that is returned, dimensions by number, ``tokens``, ``weight``, ``probability`` and ``gap``."""
    at = "_mix_"
    while any(c.lower().startswith(at) for c in df.columns):
        at = f"_{at}"
    names = list(dimensions)
    added = {f"{at}{i}": column for i, column in enumerate(dimensions.values())}
    rows = df.withColumns({**added, f"{at}tokens": token_count(F.col(text_col))})
    # Only what the cells need is read for the counts.
    cells = materialize(cell_table(rows, list(added), F.col(f"{at}tokens")), "mix-cells")
    if budget_share is not None:
        budget = budget_share * (cells.agg(F.sum("tokens")).first()[0] or 0.0)
    wanted = {}
    for i, name in enumerate(names):
        given = (targets or {}).get(name)
        if given is None:
            given = tempered_targets(cells, f"{at}{i}", (powers or {})[name])
        wanted[f"{at}{i}"] = given
    ready = materialize(calibrate(rake(cells, wanted), budget), "mix-cells").select(
        *[F.col(c).alias(f"{c}_") for c in added], *[F.col(c).alias(f"{at}{c}") for c in ("weight", "probability", "gap")]
    )
    return rows.join(ready, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in added], "left"), at


def sample(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    powers: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    budget: float | None = None,
    budget_share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``df`` with the dimensions, ``n_tokens``, ``weight``, ``probability``, ``sampled`` and ``gap``, which replace columns of
    these names.

    ``dimensions`` names the columns to rake and says how to get them. Their targets are tables of ``value`` and
    ``share``, or ``powers`` of the present token sums. ``budget_share`` is a budget as a share of all tokens. ``gap`` is the
    largest difference between a marginal of the weights and its target.
    """
    met, at = _matched(df, dimensions, powers, targets, budget, budget_share, text_col)
    out = {name: F.col(f"{at}{i}") for i, name in enumerate(dimensions)}
    out |= {"n_tokens": F.col(f"{at}tokens"), "weight": F.col(f"{at}weight"), "probability": F.col(f"{at}probability")}
    out |= {"sampled": draw(id_col) < F.col(f"{at}probability"), "gap": F.col(f"{at}gap")}
    kept = [F.col(c) for c in df.columns if c not in out]
    return met.select(*kept, *[column.alias(name) for name, column in out.items()])


def keep_sampled(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    powers: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    budget: float | None = None,
    budget_share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``df`` that :func:`sample` draws, with their columns as they are."""
    met, at = _matched(df, dimensions, powers, targets, budget, budget_share, text_col)
    return met.where(draw(id_col) < F.col(f"{at}probability")).select(*df.columns)


def content_type(text: Column) -> Column:
    """A coarse topic by marks in the whole text: table, contact, licence, noise or prose."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("@"), "contact")
        .when(text.contains("License"), "licence")
        .when(text.rlike(r"[#*$%&]{2}"), "noise")
        .otherwise("prose")
    )
