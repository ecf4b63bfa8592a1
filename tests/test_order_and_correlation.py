import random

import numpy as np
import pytest

from lealtia.operators import correlation as co
from lealtia.operators.explore import histogram
from lealtia.operators.order import exact_quantiles, running_totals
from lealtia.operators.scaling import RobustScale


@pytest.mark.parametrize("slices", [2, 16, 300])
def test_quantiles_are_exact_with_heavy_values(spark, slices):
    rng = random.Random(3)
    rows = [(rng.choice([0.0, 0.0, rng.gauss(0, 5)]), float(k), None if k % 4 else rng.random(), 7.0) for k in range(2001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    got = exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.25, 0.5, 0.75, 0.999, 1.0], slices)
    for i, name in enumerate("abcd"):
        values = [r[i] for r in rows if r[i] is not None]
        np.testing.assert_allclose(got[name], np.quantile(values, [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]), rtol=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}


def test_robust_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "a double, b double")
    scale = RobustScale.fit(df, ["a", "b"])
    assert (scale.medians["a"], scale.ranges["a"], scale.ranges["b"]) == (2.5, 3.0, 1.0)
    assert [tuple(r) for r in scale.apply(df).orderBy("a").collect()] == [
        (-0.5, 0.0),
        (-0.5 / 3, 0.0),
        (0.5 / 3, 0.0),
        (2.5, 0.0),
    ]


@pytest.mark.parametrize("slices", [2, 7, 100])
def test_running_totals(spark, slices):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(float(v), v % 5, 1) for v in values], "x double, p long, q long").repartition(4)
    for row in running_totals(df, "x", ["p", "q"], slices).collect():
        assert row["q_before"] == row["x"]
        assert row["p_before"] == sum(v % 5 for v in range(int(row["x"])))


def test_correlation_of_present_pairs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1, (400, 4))
    x[:, 1] = x[:, 0] * 2 + rng.normal(0, 0.1, 400)
    x[:, 3] = 5.0
    rows = [tuple(None if (i + j) % 7 == 0 and j < 3 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(3)
    for row in co.correlation_pairs(df).collect():
        both = [(r[row["p1"]], r[row["p2"]]) for r in rows if r[row["p1"]] is not None and r[row["p2"]] is not None]
        if 3 in (row["p1"], row["p2"]):
            assert row["correlation"] is None
        else:
            assert row["correlation"] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-9)


def test_redundant_columns_follow_any_earlier_one(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300)
    b = a + rng.normal(0, 0.2, 300)
    c = b + rng.normal(0, 0.2, 300)
    d = -a
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c, d)], "a double, b double, c double, d double")
    corr = np.abs(np.corrcoef([a, b, c, d]))
    expected = ["abcd"[j] for j in range(4) if any(corr[i, j] >= 0.9 for i in range(j))]
    pairs = co.correlation_pairs(df)
    assert [r["feature"] for r in co.redundant_columns(pairs).collect()] == expected
    assert co.reduced(df).columns == [x for x in "abcd" if x not in expected]
    strong = co.high_pairs(pairs).collect()
    assert [r["correlation"] for r in strong] == sorted((r["correlation"] for r in strong), reverse=True)
    wide = co.wide_matrix(co.correlation_matrix(df), ["a", "b", "c", "d"]).collect()
    assert [r["feature"] for r in wide] == ["a", "b", "c", "d"]
    assert wide[0]["d"] == pytest.approx(-1.0)
    assert wide[3]["a"] == wide[0]["d"]


@pytest.mark.parametrize("values", [[0.1 * k for k in range(31)], [3, 3, 3], [-5, 0, 5, 5, 5, 2.5], list(range(100))])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = histogram(df, "x", 10).orderBy("bin").collect()
    edges = np.histogram_bin_edges(values, 10)
    counts, _ = np.histogram(values, bins=edges)
    assert [r["n"] for r in got] == list(counts)
    np.testing.assert_allclose([r["low"] for r in got] + [got[-1]["high"]], edges, atol=1e-12)


def test_histogram_of_nothing(spark):
    assert histogram(spark.createDataFrame([], "x double"), "x", 5).count() == 0
