"""Table schemas and the checks made on load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("id_transaccion", T.LongType()),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("fecha", T.StringType()),
        T.StructField("categoria", T.StringType()),
        T.StructField("tipo_transaccion", T.StringType()),
        T.StructField("valor_transaccion", T.DoubleType()),
        T.StructField("puntos", T.DoubleType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("id_cliente", T.LongType()),
        T.StructField("ciudad", T.StringType()),
        T.StructField("genero", T.StringType()),
        T.StructField("estrato_social", T.IntegerType()),
        T.StructField("saldo_puntos", T.DoubleType()),
        T.StructField("fecha_nacimiento", T.StringType()),
    ]
)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Select ``names`` in that order; a missing one is an error that lists every missing name."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df.select(*names)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema``; values that do not fit their type become null."""
    require_columns(df, schema.names)
    columns: list[Column] = []
    for field in schema.fields:
        same = df.schema[field.name].dataType == field.dataType
        value = F.col(field.name)
        columns.append(value if same else value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)
