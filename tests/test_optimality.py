"""The conditions of a minimum hold for fitted linear models and fail for others."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lealtia.operators import optimality as op
from lealtia.operators import regressors as rg


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 10, 100, 0]
    y = x @ [0.5, 0.02, 0.0, 1.0] + rng.normal(size=300) + np.where(rng.random(300) < 0.05, 20, 0)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, flat double, target_ordinal double").cache()


FEATURES = ["a", "b", "c", "flat"]


@pytest.mark.parametrize(
    "fit, check, wrong",
    [
        (rg.elastic_net, op.elastic_net_conditions, {"alpha": 0.2}),
        (rg.huber, op.huber_conditions, {"epsilon": 1.8}),
    ],
)
def test_conditions_tell_a_minimum(train, fit, check, wrong):
    model = fit(train, FEATURES)
    found = {r["condition"]: r["holds"] for r in check(model, train, FEATURES).collect()}
    assert all(found.values()) and {"intercept", *FEATURES} <= set(found)
    assert not all(r["holds"] for r in check(fit(train, FEATURES, **wrong), train, FEATURES).collect())
    moved = train.withColumn("target_ordinal", F.col("target_ordinal") + 0.5)
    assert not {r["condition"]: r["holds"] for r in check(model, moved, FEATURES).collect()}["intercept"]
