"""Reading the two input tables from CSV, Parquet or the catalog, at any path Spark can open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lealtia.sources.schemas import CUSTOMERS, TRANSACTIONS, conform


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line, matched to ``schema`` by name.

    The columns are read as text first, so their order in the file does not matter and a value that
    does not parse becomes null instead of shifting or dropping its row.
    """
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return conform(text, schema) if schema is not None else text


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    df = spark.table(name)
    return conform(df, schema) if schema is not None else df


def dated(schema: T.StructType, date: str) -> T.StructType:
    """``schema`` with its date as a timestamp."""
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name == date else f.dataType) for f in schema])


def transactions(df: DataFrame) -> DataFrame:
    """Transactions with ``fecha`` as a timestamp; texts that do not parse become null."""
    return conform(df, dated(TRANSACTIONS, "fecha"))


def customers(df: DataFrame) -> DataFrame:
    """Customers with ``fecha_nacimiento`` as a timestamp; texts that do not parse become null."""
    return conform(df, dated(CUSTOMERS, "fecha_nacimiento"))
