"""Exploration tables: cleaned customers, frequencies, histograms, column profile."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import age_in_years, as_column, steady
from lealtia.operators.anchor import ID

# The genders and ages that count as valid.
VALID_GENDERS = ["F", "M"]
VALID_AGES = (20, 100)


def clean_customers(customers: DataFrame, as_of: datetime) -> DataFrame:
    """Customers of valid gender and age, with their age on ``as_of``."""
    aged = customers.where(F.col("genero").isin(VALID_GENDERS)).withColumn(
        "edad", age_in_years(F.lit(as_of).cast("timestamp_ntz"), "fecha_nacimiento")
    )
    return aged.where(F.col("edad").between(*VALID_AGES))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Number of rows per value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def transactions_per_customer(tx: DataFrame) -> DataFrame:
    counts = tx.where(F.col(ID).isNotNull()).groupBy(ID)
    return counts.agg(F.count(F.lit(1)).alias("num_transacciones"))


def spend_per_customer(tx: DataFrame) -> DataFrame:
    sums = tx.where(F.col(ID).isNotNull()).groupBy(ID)
    return sums.agg(steady(F.coalesce(F.sum("valor_transaccion"), F.lit(0.0))).alias("total_gastado"))


def histogram(df: DataFrame, value: Column | str, bins: int) -> DataFrame:
    """Equal-width histogram over the whole range: ``bin``, ``low``, ``high``, ``n``, empty bins included.

    The last bin includes its upper edge. If all values are equal, the range is widened by 0.5 on
    either side. Nulls are left out.
    """
    values = df.select(as_column(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    limits = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    step = (F.col("hi") - F.col("lo")) / bins

    def low_edge(k: Column) -> Column:
        return F.col("lo") + k * step

    guess = F.least(F.floor((F.col("v") - F.col("lo")) / step).cast("int"), F.lit(bins - 1))
    # The division may land one bin off; the edges themselves decide.
    placed = F.when(F.col("v") < low_edge(guess), guess - 1).when(
        (guess < bins - 1) & (F.col("v") >= low_edge(guess + 1)), guess + 1
    ).otherwise(guess)
    counts = (
        values.select("v", lo.alias("lo"), hi.alias("hi"))
        .select(F.greatest(placed, F.lit(0)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = limits.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi"
    )
    high = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(low_edge(F.col("bin") + 1))
    return grid.join(counts, "bin", "left").select(
        "bin",
        low_edge(F.col("bin")).alias("low"),
        high.alias("high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, non-null count and row count of every column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(name).alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))
