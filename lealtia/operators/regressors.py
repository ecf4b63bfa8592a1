"""The three ordinal regressors as Spark ML pipelines, with the settings of the published models."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET_ORDINAL = "target_ordinal"

# Settings of the three models.
ELASTIC_NET = {"alpha": 0.1, "l1_ratio": 0.5}
HUBER = {"epsilon": 1.35, "alpha": 1e-4}
BOOSTED = {"trees": 300, "depth": 4, "learning_rate": 0.05, "row_share": 0.8, "column_share": 0.8, "seed": 42}


def scaled_features(features: Sequence[str], rows: int) -> list:
    """Stages that standardise by the population's standard deviation instead of the sample's."""
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="unit", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="unit", outputCol="features", scalingVec=Vectors.dense([factor] * len(features))),
    ]


def elastic_net(
    train: DataFrame, features: Sequence[str], alpha: float = ELASTIC_NET["alpha"], l1_ratio: float = ELASTIC_NET["l1_ratio"]
) -> PipelineModel:
    """Least squares with ``alpha * l1_ratio`` on the absolute and ``alpha * (1 - l1_ratio)`` on the squared weights.

    Spark divides the squared part by the label's standard deviation, so it is multiplied by it here.
    """
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(TARGET_ORDINAL).alias("s")).first()
    absolute, squared = alpha * l1_ratio, alpha * (1 - l1_ratio) * (row["s"] or 1.0)
    strength = absolute + squared
    model = LinearRegression(
        labelCol=TARGET_ORDINAL,
        solver="l-bfgs",
        standardization=False,
        regParam=strength,
        elasticNetParam=absolute / strength if strength else 0.0,
        maxIter=1000,
        tol=1e-10,
    )
    return Pipeline(stages=[*scaled_features(features, row["n"]), model]).fit(train)


def huber(
    train: DataFrame, features: Sequence[str], epsilon: float = HUBER["epsilon"], alpha: float = HUBER["alpha"]
) -> PipelineModel:
    """Regression that is linear in large errors. Spark averages the loss over the rows, so the penalty is too."""
    rows = train.count()
    model = LinearRegression(
        labelCol=TARGET_ORDINAL,
        loss="huber",
        epsilon=epsilon,
        solver="l-bfgs",
        standardization=False,
        regParam=alpha / max(rows, 1),
        maxIter=1000,
        tol=1e-8,
    )
    return Pipeline(stages=[*scaled_features(features, rows), model]).fit(train)


def boosted_trees(train: DataFrame, features: Sequence[str], trees: int = BOOSTED["trees"]) -> PipelineModel:
    """Gradient-boosted trees on squared error."""
    model = GBTRegressor(
        labelCol=TARGET_ORDINAL,
        featuresCol="features",
        lossType="squared",
        maxIter=trees,
        maxDepth=BOOSTED["depth"],
        stepSize=BOOSTED["learning_rate"],
        subsamplingRate=BOOSTED["row_share"],
        featureSubsetStrategy=str(BOOSTED["column_share"]),
        seed=BOOSTED["seed"],
        checkpointInterval=25,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), model]).fit(train)
