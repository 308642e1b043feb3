"""Is a fitted lasso regression optimal? Subgradients per feature, and the duality gap.

The regression minimises ``sum(r^2) / 2n + penalty * sum(scale * |weight|)``, ``r`` being
the residual and ``scale`` a feature's sample deviation. Features are codes, so a feature's
gradient is a sum of residuals over the claims with that code: one grouping by (position,
code) gives all of them, whatever the number of features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.sources.writers import materialise


def code_residuals(scored: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """``position, code, n, residual``: claims with each code, and the sum of their residuals.

    ``scored`` as from ``score_by_weights``; claims without prediction or label are left out.
    Summed per task before the shuffle, so a code on all claims is one row per task.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.col(c).alias("code")) for i, c in enumerate(columns)])
    residual = F.col(label).cast("double") - F.col("prediction")
    rows = scored.where(residual.isNotNull()).select(residual.alias("residual"), F.inline(entries))
    return rows.groupBy("position", "code").agg(F.count("*").alias("n"), F.sum("residual").alias("residual"))


def subgradients(
    scored: DataFrame, weights: DataFrame, columns: Sequence[str], penalty: float = fixed.REG_PARAM, label: str = "label"
) -> DataFrame:
    """``position, code, feature, n, scale, weight, slope, violation`` per feature of the model.

    ``slope`` is the loss's descent in the feature, in units of its scale. At the optimum it
    is ``penalty`` with the weight's sign, and for a weight of 0 at most ``penalty`` either
    way; ``violation`` is how far from that it is. The feature's mean is taken out,
    as the intercept is free. Features no claim has, or all claims have, have no slope.
    """
    # A row per code; written, as claims are read for it.
    sums = materialise(code_residuals(scored, columns, label), "code-residuals")
    # Each position sees every claim once: its sums are the totals.
    claims, total = sums.where("position = 0").agg(F.sum("n"), F.sum("residual")).first()
    claims, total = F.lit(float(claims or 0)), F.lit(float(total or 0))
    features = weights.where(F.col("feature").isNotNull()).select("position", "code", "feature", "weight")
    share = F.try_divide("n", claims)
    rows = (
        features.join(sums, ["position", "code"], "left")
        .withColumns({"n": F.coalesce("n", F.lit(0)), "residual": F.coalesce("residual", F.lit(0.0))})
        .withColumn("scale", F.sqrt(share * (1 - share) * F.try_divide(claims, claims - 1)))
    )
    slope = F.try_divide(F.col("residual") - share * total, claims * F.col("scale"))
    excess = F.when(F.col("weight") == 0, F.greatest(F.abs("slope") - penalty, F.lit(0.0))).otherwise(
        F.abs(F.col("slope") - penalty * F.signum("weight"))
    )
    return rows.withColumn("slope", slope).select(
        "position", "code", "feature", "n", "scale", "weight", "slope", excess.alias("violation")
    )


def duality_gap(
    scored: DataFrame, gradients: DataFrame, penalty: float = fixed.REG_PARAM, label: str = "label"
) -> DataFrame:
    """``claims, primal, dual, gap``: no weights can have a loss below ``dual``.

    ``gradients`` as from ``subgradients`` over the same claims. The residuals, shrunk until no
    slope exceeds the penalty, are a feasible point of the dual problem.
    """
    y, r = F.col(label).cast("double"), F.col(label).cast("double") - F.col("prediction")
    sums = scored.where(r.isNotNull()).agg(
        F.count("*").alias("claims"), F.var_pop(y).alias("spread"), F.covar_pop(y, r).alias("along"), F.var_pop(r).alias("left"),
        F.avg(r).alias("shift"),
    )
    steepest, size = gradients.agg(F.max(F.abs("slope")), F.sum(F.col("scale") * F.abs("weight"))).first()
    shrink = min(1.0, penalty / steepest) if steepest else 1.0
    primal = (F.col("left") + F.col("shift") * F.col("shift")) / 2 + penalty * (size or 0.0)
    # Half of y'y - (y - s r)'(y - s r), per claim and about the means.
    dual = shrink * F.col("along") - shrink * shrink * F.col("left") / 2
    return sums.select("claims", primal.alias("primal"), dual.alias("dual"), (primal - dual).alias("gap"))
