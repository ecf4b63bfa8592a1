"""Feature states, bucketed tables, stored sketches, accounted loading, odd numbers, blocked moments."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_features import make_customers, make_rows

from lealtia.functions.scalars import mean, round_even, total
from lealtia.operators import correlation as co
from lealtia.operators import sketches as sk
from lealtia.operators.anchor import ID
from lealtia.operators.order import exact_quantiles
from lealtia.plans import incremental as inc
from lealtia.plans.customer_features import customer_features
from lealtia.session import clear_staged, fresh_path
from lealtia.sinks.writers import create_bucketed
from lealtia.sources.loading import load_csv
from lealtia.sources.readers import customers, dated, transactions
from lealtia.sources.schemas import CUSTOMERS, TRANSACTIONS

CATEGORIES = ["COMIDA", "DEPORTE", "HOGAR", "TECNOLOGIA"]


@pytest.fixture(scope="module")
def tables(spark):
    rows = make_rows()
    rows += [(1, 60, "2023-01-05 00:00:00", "HOGAR", "Sale", 1e30, 1.0), (2, 60, "2023-01-06 00:00:00", "HOGAR", "Sale", 5.0, 1.0)]
    rows += [(3, 61, "2023-01-05 00:00:00", None, "Sale", float("nan"), 2.0), (4, 61, "2023-02-05 00:00:00", None, "Sale", 5.0, 2.0)]
    people = [*make_customers(), (60, None, None, 1, 1.0, None), (61, None, None, 1, 1.0, None)]
    tx = transactions(spark.createDataFrame(rows, TRANSACTIONS)).repartition(4)
    return tx.cache(), customers(spark.createDataFrame(people, CUSTOMERS)).cache()


def same(one, two):
    """Equal rows; NaN equals NaN."""
    assert one.columns == two.columns
    pairs = [[tuple(str(v) for v in r) for r in df.orderBy(ID).collect()] for df in (one, two)]
    assert pairs[0] == pairs[1]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_states_of_batches_give_the_whole_feature_table(spark, tables, order):
    tx, people = tables
    expected = customer_features(tx, people, CATEGORIES, thresholds=(4, 2, 1))
    # By time, so that a late batch shifts windows; undated rows are in the first.
    year = F.coalesce(F.year("fecha"), F.lit(2022))
    batches = [tx.where(year == 2022), tx.where(year == 2023), tx.where(year > 2023)]
    path = fresh_path(spark, "states")
    for i in order:
        inc.add_batch(batches[i], path, f"b{i}")
    same(inc.features_of_states(spark, path, people, CATEGORIES, thresholds=(4, 2, 1)), expected)
    # A batch that comes again counts once, and compacted states say the same.
    inc.add_batch(batches[1], path, "b1")
    smaller = fresh_path(spark, "states")
    inc.compact(spark, path, smaller)
    same(inc.features_of_states(spark, smaller, people, CATEGORIES, thresholds=(4, 2, 1)), expected)
    assert inc.read_recent(spark, smaller).count() < inc.read_recent(spark, path).count() < tx.count()
    clear_staged(spark)


def test_an_increment_on_compacted_states_reads_no_history(spark, tables):
    tx, people = tables
    old, new = tx.where(F.coalesce(F.year("fecha"), F.lit(0)) < 2024), tx.where(F.year("fecha") >= 2024)
    first, path = fresh_path(spark, "states"), fresh_path(spark, "states")
    inc.add_batch(old, first, "old")
    inc.compact(spark, first, path)
    inc.add_batch(new, path, "new")
    found = inc.features_of_states(spark, path, people, CATEGORIES)
    same(found, customer_features(tx, people, CATEGORIES))
    assert all(path in name for name in found.inputFiles())
    clear_staged(spark)


def test_bucketed_tables_need_no_shuffle(spark, tables):
    tx, people = tables
    names = []
    for kind, table in (("tx", tx), ("people", people)):
        path = fresh_path(spark, kind)
        names.append(f"bucketed_{kind}_test")
        create_bucketed(table, names[-1], ID, 4, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = customer_features(*[spark.table(n) for n in names], CATEGORIES, busy_rows=None)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange", plan)
        assert plan.count("Bucketed: true") == 3
        same(found, customer_features(tx, people, CATEGORIES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE {name}")
    clear_staged(spark)


def test_odd_numbers_count_in_sums_and_means(spark):
    values = {"huge": [1.0, 2.0, 1e30], "nan": [1.0, 2.0, math.nan], "inf": [1.0, math.inf], "plain": [0.1] * 10, "none": [None]}
    rows = [(k, v) for k, own in values.items() for v in own]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(total("v").alias("t"), mean("v").alias("m"))
    got = {r["k"]: (r["t"], r["m"]) for r in df.collect()}
    assert got["huge"] == (1e30, 1e30 / 3)
    assert all(math.isnan(v) for v in got["nan"])
    assert got["inf"] == (math.inf, math.inf)
    assert got["plain"] == (1.0, 0.1)
    assert got["none"] == (0.0, None)
    big = spark.createDataFrame([(1e305,), (-1e305,), (0.125,), (2.0**53 + 2,)], "v double").select(round_even("v").alias("v"))
    assert [r["v"] for r in big.collect()] == [1e305, -1e305, 0.12, 2.0**53 + 2]


def test_distinct_sketches_merge_over_any_grouping(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("city"), (F.col("id") % 12).alias("month"), (F.col("id") % 17_001).alias("who"))
    cells = sk.distinct_sketches(df, ["city", "month"], "who").cache()
    assert cells.count() == 60
    for keys in (["city"], ["month"], []):
        estimated = sk.distinct_counts(cells, keys)
        exact = df.groupBy(*keys).agg(F.count_distinct("who").alias("exact"))
        both = estimated.join(exact, keys) if keys else estimated.crossJoin(exact)
        assert all(abs(r["n"] - r["exact"]) <= 0.02 * r["exact"] for r in both.collect())
    nobody = sk.distinct_sketches(df.withColumn("who", F.lit(None).cast("long")), ["city"], "who")
    assert {r["n"] for r in sk.distinct_counts(nobody, ["city"]).collect()} == {0}


def test_quantile_sketches_are_as_near_as_stated(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(3, 2, 30_000), np.full(10_000, 7.0)])
    rows = [(int(i % 9), float(v), float(i % 3) if i % 4 else None, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "day int, x double, y double, z double").repartition(5).cache()
    cells = sk.quantile_sketches(df, ["day"], ["x", "y", "z"])
    merged = sk.merged_quantiles(cells).cache()
    assert {r["feature"]: r["n"] for r in merged.collect()} == {"x": 40_000, "y": 30_000}
    points = [0.01, 0.25, 0.5, 0.75, 0.99]
    for r in sk.quantiles(merged.where("feature = 'x'"), points).collect():
        low, high = (x < r["value"]).mean(), (x <= r["value"]).mean()
        assert low - sk.rank_error() <= r["probability"] <= high + sk.rank_error()
    scale = sk.robust_scale(merged)
    exact = exact_quantiles(df, ["y"], [0.25, 0.5, 0.75])["y"]
    assert [scale.medians["y"], scale.ranges["y"]] == [exact[1], exact[2] - exact[0]]
    bins = sk.histogram_of_sketch(merged, 6).where("feature = 'y'").orderBy("bin").collect()
    assert sum(r["n"] for r in bins) == 30_000 and (bins[0]["low"], bins[-1]["high"]) == (0.0, 2.0)
    assert sk.histogram_of_sketch(merged.limit(0), 4).count() == 0


def test_every_line_of_a_file_is_accepted_or_rejected(spark, tmp_path):
    path = tmp_path / "people.csv"
    lines = ["saldo_puntos,id_cliente,ciudad,genero,estrato_social,fecha_nacimiento,nota"]
    lines += ["1.5,1,Cali,F,2,1990-01-01,a", ",2,,M,,,b", "x,3,Cali,F,2,1990-01-01,c", "1,4,Cali,F,2,not a date,d"]
    lines += ["1,5,Cali", "1,,Cali,F,2,1990-01-01,e", "1,7,Cali,F,2,1990-01-01,f,too,many"]
    path.write_text("\n".join(lines) + "\n")
    schema = dated(CUSTOMERS, "fecha_nacimiento")
    loaded = load_csv(spark, str(path), schema, str(tmp_path / "out"), [ID])
    assert (loaded.accepted_rows, loaded.rejected_rows) == (2, 5)
    assert loaded.accepted.schema.names == schema.names
    assert sorted(r[ID] for r in loaded.accepted.collect()) == [1, 2]
    why = {r["id_cliente"]: r["reasons"] for r in loaded.rejected.collect()}
    assert why["3"] == ["saldo_puntos: x"] and why["4"] == ["fecha_nacimiento: not a date"]
    assert why[None] == ["id_cliente: missing"] and why["5"] == ["line"] and why["7"] == ["line"]
    assert {r["column"]: (r["non_null"], r["rows"]) for r in loaded.profile.collect()} == {
        "id_cliente": (2, 2),
        "ciudad": (1, 2),
        "genero": (2, 2),
        "estrato_social": (1, 2),
        "saldo_puntos": (1, 2),
        "fecha_nacimiento": (1, 2),
    }
    with pytest.raises(ValueError, match="puntos"):
        load_csv(spark, str(path), TRANSACTIONS, str(tmp_path / "other"))


@pytest.mark.parametrize("width", [1, 3, 7])
def test_blocks_of_columns_give_the_same_moments(spark, width):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 7)) * 100 + 5
    x[:, 3] = 2 * x[:, 1]
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(7))).repartition(3)
    key = ["p1", "p2"]
    whole = {(r["p1"], r["p2"]): r["correlation"] for r in co.correlation_pairs(df).select(*key, "correlation").collect()}
    found = co.correlation_pairs(df, width=width).select(*key, "correlation").collect()
    assert len(found) == len(whole) == 28
    assert all(r["correlation"] == pytest.approx(whole[r["p1"], r["p2"]], abs=1e-12) for r in found)
