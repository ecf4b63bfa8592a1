"""Writing tables, documents, metrics and models to any path Spark can open."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. A row label is an ordinary column, so tables with labels go the same way."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def create_table(df: DataFrame, name: str) -> None:
    """Catalog table from a query, as Parquet with Snappy."""
    df.write.mode("overwrite").format("parquet").option("compression", "snappy").saveAsTable(name)


def create_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table with its rows in ``buckets`` by ``key``, sorted inside each, as Parquet with Snappy.

    Tables with the same buckets are joined and grouped by the key without a shuffle. Rows move once, on the way in,
    so that every bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("compression", "snappy")
    writer = writer.bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; nulls are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def put_metrics(metrics: DataFrame, path: str) -> None:
    """Puts ``model``, ``metric``, ``value`` rows into one table; a metric of a model that is there is replaced."""
    rows = metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("model", "metric").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("metric string, value double, model string").parquet(path)
    return rows.select("model", "metric", "value")


def report_document(report: DataFrame) -> DataFrame:
    """Classification report as one row: a map from label to its measures."""
    measures = F.struct("precision", "recall", "f1_score", "support")
    return report.agg(F.map_from_entries(F.collect_list(F.struct("label", measures))).alias("report"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
