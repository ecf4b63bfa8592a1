"""Checks that a fitted linear model is at the minimum of its objective, from one pass over its training rows.

Both objectives are convex, so a model that meets their first-order conditions is the right one, whoever fitted it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.operators.regressors import ELASTIC_NET, HUBER, TARGET_ORDINAL

#: How far a gradient may be from where it should be, per row.
TOLERANCE = 1e-4
CONDITIONS = "condition string, value double, wanted double, slack double"


def conditions(rows: Sequence[tuple[str, float, float, float]], df: DataFrame, tolerance: float) -> DataFrame:
    """``condition`` and whether it ``holds``: the value is within its slack and the tolerance of what is wanted."""
    table = df.sparkSession.createDataFrame(list(rows), CONDITIONS)
    return table.select("condition", (F.abs(F.col("value") - F.col("wanted")) <= F.col("slack") + tolerance).alias("holds"))


def means_beside(scored: DataFrame, features: Sequence[str], pull: Column, extra: Sequence[Column] = ()) -> list[float]:
    """Means over the rows of ``pull``, of its product with each scaled feature, and of the extra columns."""
    z = vector_to_array("features")
    products = [F.avg(pull * z[i]).alias(f"g{i}") for i in range(len(features))]
    return [float(v) for v in scored.agg(F.avg(pull).alias("pull"), *products, *[F.avg(e).alias(f"e{i}") for i, e in enumerate(extra)]).first()]


def elastic_net_conditions(
    model: PipelineModel,
    train: DataFrame,
    features: Sequence[str],
    alpha: float = ELASTIC_NET["alpha"],
    l1_ratio: float = ELASTIC_NET["l1_ratio"],
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """For least squares with absolute and squared penalty: the mean residual is 0, and the mean product of residual
    and feature is the slope of the penalty, or inside it for a weight of 0."""
    linear = model.stages[-1]
    residual = F.col(TARGET_ORDINAL) - F.col(linear.getPredictionCol())
    pull, *products = means_beside(model.transform(train), features, residual)
    rows = [("intercept", pull, 0.0, 0.0)]
    for name, value, weight in zip(features, products, linear.coefficients.toArray().tolist()):
        edge, bend = alpha * l1_ratio, alpha * (1 - l1_ratio) * weight
        sign = (weight > 0) - (weight < 0)
        rows.append((name, value, sign * edge + bend, 0.0 if sign else edge))
    return conditions(rows, train, tolerance)


def huber_conditions(
    model: PipelineModel,
    train: DataFrame,
    features: Sequence[str],
    epsilon: float = HUBER["epsilon"],
    alpha: float = HUBER["alpha"],
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """For the regression that is linear in large errors: residuals over the scale, cut off at ``epsilon``, have a mean
    of 0, a mean square of 1, and a mean product with each feature that is the slope of the squared penalty."""
    linear = model.stages[-1]
    residual = (F.col(TARGET_ORDINAL) - F.col(linear.getPredictionCol())) / F.lit(linear.scale)
    cut = F.greatest(F.lit(-epsilon), F.least(F.lit(epsilon), residual))
    count = train.count()
    pull, *rest = means_beside(model.transform(train), features, cut, [cut * cut])
    rows = [("intercept", pull, 0.0, 0.0), ("scale", rest[-1], 1.0, 0.0)]
    for name, value, weight in zip(features, rest, linear.coefficients.toArray().tolist()):
        rows.append((name, value, alpha * weight / max(count, 1), 0.0))
    return conditions(rows, train, tolerance)
