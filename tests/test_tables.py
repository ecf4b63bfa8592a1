import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lealtia.operators import evaluation as ev
from lealtia.operators import explore as ex
from lealtia.operators import reports as rp
from lealtia.session import staged
from lealtia.sinks import writers as wr
from lealtia.sources import readers as rd
from lealtia.sources.schemas import CUSTOMERS, TRANSACTIONS

HEADER = "puntos,id_cliente,id_transaccion,fecha,categoria,tipo_transaccion,valor_transaccion\n"


def test_csv_is_read_by_name_and_bad_values_become_null(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(HEADER + "1.5,7,1,2024-01-31 10:00:00,HOGAR,Sale,100\nx,8,2,no-date,,Redemption,\n")
    raw = rd.read_csv(spark, str(path), TRANSACTIONS)
    assert raw.columns == TRANSACTIONS.names
    rows = rd.transactions(raw).orderBy("id_transaccion").collect()
    assert (rows[0]["puntos"], rows[0]["fecha"].hour, rows[0]["valor_transaccion"]) == (1.5, 10, 100.0)
    assert (rows[1]["puntos"], rows[1]["fecha"], rows[1]["categoria"], rows[1]["valor_transaccion"]) == (None,) * 4


def test_missing_source_column_is_an_error(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text("id_cliente\n1\n")
    with pytest.raises(ValueError, match="id_transaccion, fecha"):
        rd.read_csv(spark, str(path), TRANSACTIONS)


def test_table_from_query_is_snappy_parquet(spark):
    people = spark.createDataFrame(
        [(1, "Cali"), (1, "Cali"), (2, "Cali"), (3, "Bogota"), (4, "Tunja"), (5, "Bogota"), (6, None)],
        "id_cliente long, ciudad string",
    )
    wr.create_table(rp.top_cities(people), "top_cities_test")
    rows = rd.read_table(spark, "top_cities_test").orderBy("ciudad").collect()
    assert [tuple(r) for r in rows] == [("Bogota", 2), ("Cali", 2)]
    files = spark.table("top_cities_test").inputFiles()
    assert all(name.endswith(".snappy.parquet") for name in files)
    spark.sql("DROP TABLE top_cities_test")


def test_csv_and_parquet_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "Cali, Valle", None, 2, 1.25, "1990-01-01")], CUSTOMERS)
    wr.write_csv(df, str(tmp_path / "csv"))
    wr.write_parquet(df, str(tmp_path / "parquet"))
    assert rd.read_csv(spark, str(tmp_path / "csv"), CUSTOMERS).collect() == df.collect()
    assert rd.read_parquet(spark, str(tmp_path / "parquet"), CUSTOMERS).collect() == df.collect()


def test_report_as_json(spark, tmp_path):
    df = spark.createDataFrame([("baja", "baja"), ("baja", "alta")], "t string, p string")
    wr.write_json(wr.report_document(ev.classification_report(df, "t", "p")), str(tmp_path / "report"))
    (part,) = Path(tmp_path / "report").glob("*.json")
    report = json.loads(part.read_text())["report"]
    assert report["baja"]["recall"] == 0.5
    assert report["accuracy"]["support"] == 2.0


def test_staged_table_has_its_schema_and_rows(spark):
    df = spark.range(10).withColumn("x", F.array(F.col("id").cast("double")))
    again = staged(df, "numbers")
    assert again.dtypes == df.dtypes
    assert again.count() == 10
    assert "Scan parquet" in again._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_present_values(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "x long, y string")
    assert [tuple(r) for r in ex.column_profile(df).collect()] == [(0, "x", "bigint", 2, 2), (1, "y", "string", 1, 2)]


def test_redeemed_points_both_ways(spark):
    rows = [(1, "Redemption", -5.0), (2, "Redemption", -1.0), (2, "Sale", 9.0), (3, "Redemption", -5.0)]
    tx = spark.createDataFrame(rows, "id_cliente long, tipo_transaccion string, puntos double")
    assert [r["id_cliente"] for r in rp.top_redeemed(tx).collect()] == [2, 1, 3]
    assert [r["id_cliente"] for r in rp.top_redeemed_by_size(tx).collect()] == [1, 3, 2]


def test_months_without_a_date_come_last(spark):
    rows = [("2024-02-10", "Sale", 1.0), ("bad", "Sale", 2.0), ("2024-01-10", "Redemption", -3.0)]
    tx = spark.createDataFrame(rows, "fecha string, tipo_transaccion string, puntos double")
    assert [tuple(r) for r in rp.monthly_points(tx).collect()] == [
        ("2024-01", 0.0, -3.0),
        ("2024-02", 1.0, 0.0),
        (None, 2.0, 0.0),
    ]
