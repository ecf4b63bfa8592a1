from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lealtia.functions import scalars as sc


def values(spark, column, rows, kind):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(column).collect()]


def test_score_limits_are_closed_on_the_right(spark):
    scores = [-0.6, -0.5, -0.49, 0.5, 0.51, 1.5, 2.5, 3.5, 3.6, None]
    expected = [None, None, "sin_compra", "sin_compra", "baja", "baja", "media", "alta", None, None]
    assert values(spark, sc.score_class("x"), scores, "double") == expected


def test_counts_reach_classes_by_threshold(spark):
    counts = [0, 1, 2, 3, 4, 5]
    local = ["sin_compra", "baja", "media", "media", "alta", "alta"]
    cloud = ["sin_compra", "baja", "baja", "media", "media", "alta"]
    assert values(spark, sc.intensity_class("x"), counts, "long") == local
    assert values(spark, sc.intensity_class("x", sc.CLOUD_THRESHOLDS), counts, "long") == cloud


def test_class_codes(spark):
    names = ["sin_compra", "baja", "media", "alta", "otra", None]
    assert values(spark, sc.class_code("x"), names, "string") == [0, 1, 2, 3, None, None]


def test_months_are_clipped_to_the_end_and_keep_the_time(spark):
    column = sc.months_before("x", 3)
    rows = [datetime(2024, 5, 31, 10, 30), datetime(2023, 5, 31)]
    assert values(spark, column, rows, "timestamp_ntz") == [datetime(2024, 2, 29, 10, 30), datetime(2023, 2, 28)]


@pytest.mark.parametrize(
    "later, earlier, days",
    [
        (datetime(2024, 1, 2, 9), datetime(2024, 1, 1, 9), 1),
        (datetime(2024, 1, 2, 8, 59), datetime(2024, 1, 1, 9), 0),
        (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9), -1),
        (datetime(2024, 1, 1), datetime(2024, 1, 2, 1), -2),
    ],
)
def test_whole_days_round_down(spark, later, earlier, days):
    df = spark.createDataFrame([(later, earlier)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(sc.whole_days("a", "b")).first()[0] == days


def test_age_rounds_down_before_birth_too(spark):
    df = spark.createDataFrame([(datetime(2000, 1, 1), datetime(2000, 1, 2))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(sc.age_in_years("a", "b")).first()[0] == -1


def test_rounding_is_half_to_even_without_negative_zero(spark):
    got = values(spark, sc.round_even("x"), [0.125, 0.375, -0.001, 2.5], "double")
    assert got == [0.12, 0.38, 0.0, 2.5]
    assert str(got[2]) == "0.0"


def test_logarithm_is_null_outside_its_range(spark):
    got = values(spark, sc.log10_plus_one("x"), [9.0, -1.0, -5.0, None], "double")
    assert got == [1.0, None, None, None]


def test_bad_texts_become_null(spark):
    assert values(spark, sc.parse_timestamp("x"), ["2024-01-02", "no-date", None], "string") == [
        datetime(2024, 1, 2),
        None,
        None,
    ]
    assert values(spark, sc.parse_number("x"), ["1.5", "x", None], "string") == [1.5, None, None]


def test_categories_not_listed_stay(spark):
    rows = ["COMIDAS", "DEPORTES", "DEPORTE", "LICORES Y CIGARRILLOS", "SALUD Y BELLEZA", "HOGAR", None]
    expected = ["COMIDA", "DEPORTE", "DEPORTE", "LICORES", "SALUD_BELLEZA", "HOGAR", None]
    assert values(spark, sc.canonical_category("x"), rows, "string") == expected


def test_negative_sales(spark):
    rows = [("Sale", -1.0, 1.0), ("Sale", 1.0, -1.0), ("Sale", 1.0, None), ("Sale", None, -1.0), ("Redemption", -1.0, -1.0), (None, -1.0, -1.0)]
    df = spark.createDataFrame(rows, "tipo_transaccion string, valor_transaccion double, puntos double")
    assert [r[0] for r in df.select(sc.is_negative_sale()).collect()] == [True, True, False, True, False, False]


def test_sums_without_rows_are_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    row = df.agg(sc.total("x").alias("t"), sc.occurrences("x").alias("n"), sc.total("x", F.lit(False)).alias("u")).first()
    assert tuple(row) == (0.0, 0, 0.0)


def test_row_total_counts_nulls_as_zero(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double")
    assert df.select(sc.row_total(["a", "b", "c"])).first()[0] == 3.0


def test_clamped_scores_get_the_outermost_class(spark):
    got = values(spark, sc.score_class("x", clamp=True), [-3.0, -0.5, 0.5, 3.6, 9.0, None], "double")
    assert got == ["sin_compra", "sin_compra", "sin_compra", "alta", "alta", None]


def test_totals_do_not_depend_on_the_order_of_addition(spark):
    numbers = [1e10 + i * 0.01 for i in range(2000)]
    frame = spark.createDataFrame([(x,) for x in numbers], "x double")
    orders = [frame.repartition(p, "x").sort("x", ascending=a) for p in (1, 3, 7) for a in (True, False)]
    assert len({df.agg(sc.total("x")).first()[0] for df in orders}) == 1
