"""The customer feature table from partial states, so that new transactions do not have the history read again.

Every batch of transactions leaves two tables of states. ``profile`` has the whole-history measures of each customer
in it, which add up. ``recent`` has what its windows can still ask for: the measures per customer, moment and
category of the months before the customer's latest transaction in the batch. That date only ever grows, so what a
batch leaves out no later table can need. States are a fraction of the detail and merge in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lealtia.functions.scalars import (
    decimal_part,
    is_negative_sale,
    months_before,
    negative_part,
    odd_part,
    positive_part,
    steady,
    whole_sum,
)
from lealtia.operators import features as fe
from lealtia.operators.anchor import ID, LAST_DATE, edge, in_window
from lealtia.plans.customer_features import assembled

#: Months before the latest transaction that some window reaches back to.
REACH = max(w.start for w in fe.FULL_WINDOWS + fe.TECH_WINDOWS)
MEASURES = ("gasto", "ganados", "redimidos")
PROFILE = (
    f"{ID} long, {LAST_DATE} timestamp_ntz, n long, negativas long, "
    + ", ".join(f"{m} decimal(38,12), {m}_odd double" for m in MEASURES)
    + ", batch string"
)
RECENT = (
    f"{ID} long, fecha timestamp_ntz, categoria string, n long, "
    + ", ".join(f"{m} decimal(38,12), {m}_odd double" for m in MEASURES)
    + ", batch string"
)


def sums() -> list[Column]:
    """Sums of stored partial sums."""
    return [F.sum(f"{m}{part}").alias(f"{m}{part}") for m in MEASURES for part in ("", "_odd")]


def partial_sums() -> list[Column]:
    values = (F.col("valor_transaccion"), positive_part("puntos"), negative_part("puntos"))
    parts = {"": decimal_part, "_odd": odd_part}
    return [F.sum(part(v)).cast("decimal(38,12)" if not s else "double").alias(f"{m}{s}") for m, v in zip(MEASURES, values) for s, part in parts.items()]


def profile_state(tx: DataFrame) -> DataFrame:
    return tx.where(F.col(ID).isNotNull()).groupBy(ID).agg(
        F.max("fecha").alias(LAST_DATE),
        F.count("id_transaccion").alias("n"),
        F.count_if(is_negative_sale()).alias("negativas"),
        *partial_sums(),
    )


def recent_state(tx: DataFrame, last: DataFrame) -> DataFrame:
    """Measures per customer, moment and category, as far back from the customer's latest date as windows reach."""
    moments = fe.recode_category(tx).where(F.col(ID).isNotNull() & F.col("fecha").isNotNull()).groupBy(ID, "fecha", "categoria")
    counted = moments.agg(F.count("id_transaccion").alias("n"), *partial_sums())
    return in_reach(counted, last)


def in_reach(states: DataFrame, last: DataFrame) -> DataFrame:
    kept = states.join(last.select(ID, months_before(LAST_DATE, REACH).alias("_since")), ID)
    return kept.where(F.col("fecha") >= F.col("_since")).drop("_since")


def put(df: DataFrame, path: str, batch: str) -> None:
    rows = df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("batch").parquet(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).parquet(f"{path}/profile")


def read_recent(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECENT).parquet(f"{path}/recent")


def add_batch(tx: DataFrame, path: str, batch: str) -> None:
    """States of one batch of transactions; a batch that comes again replaces itself.

    Batches may overlap in time and come in any order, but every transaction belongs to one batch.
    """
    put(profile_state(tx), f"{path}/profile", batch)
    stored = read_profile(tx.sparkSession, path).where(F.col("batch") == batch)
    put(recent_state(tx, stored), f"{path}/recent", batch)


def merged_profile(profile: DataFrame) -> DataFrame:
    return profile.groupBy(ID).agg(
        F.max(LAST_DATE).alias(LAST_DATE), F.sum("n").alias("n"), F.sum("negativas").alias("negativas"), *sums()
    )


def compact(spark: SparkSession, source: str, destination: str) -> None:
    """All batches of ``source`` as the one batch ``base`` of ``destination``, without what no window reaches now.

    The source stays as it is, so readers of it are not disturbed.
    """
    profile, recent = read_profile(spark, source), read_recent(spark, source)
    put(merged_profile(profile), f"{destination}/profile", "base")
    last = read_profile(spark, destination)
    moments = recent.groupBy(ID, "fecha", "categoria").agg(F.sum("n").alias("n"), *sums())
    put(in_reach(moments, last), f"{destination}/recent", "base")


def picked(measure: str, condition: Column | None = None) -> Column:
    """A measure summed over states, those that meet the condition, as :func:`lealtia.functions.scalars.total` does."""
    parts = [F.col(f"{measure}{p}") for p in ("", "_odd")]
    parts = [F.sum(p if condition is None else F.when(condition, p)) for p in parts]
    return steady(F.coalesce(whole_sum(*parts), F.lit(0.0)))


def counted(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def window_columns(categories: Sequence[str], target: bool) -> list[Column]:
    """All windowed columns of the feature table, from recent states with the edges of their customer."""
    columns = []
    for w in fe.FULL_WINDOWS:
        inside = in_window(w.start, w.end)
        columns.append(counted(inside).alias(f"num_tx_{w.name}"))
        names = {"gasto": "gasto", "puntos_ganados": "ganados", "puntos_redimidos": "redimidos"}
        columns += [picked(m, inside).alias(f"{name}_{w.name}") for name, m in names.items()]
    year, name = in_window(fe.YEAR, None), F.col("categoria")
    columns += [picked("gasto", year & (name == c)).alias(f"gasto_{c}_12m") for c in categories]
    columns.append(picked("gasto", year & name.isNotNull()).alias("_gasto_12m"))
    for w in fe.TECH_WINDOWS:
        inside = in_window(w.start, w.end) & (name == fe.TECH)
        columns.append((picked("gasto", inside) / w.months).alias(f"avg_gasto_tecnologia_{w.months}m"))
    if target:
        columns.append(counted(in_window(fe.TARGET_MONTHS, 0) & (name == fe.TECH)).alias("num_tx_target"))
    return columns


def features_of_states(
    spark: SparkSession,
    path: str,
    customers: DataFrame,
    categories: Sequence[str],
    as_of: datetime | None = None,
    thresholds: Sequence[int] | None = None,
) -> DataFrame:
    """The full feature table, equal to that of all transactions of all batches, from their states alone."""
    profile, recent = read_profile(spark, path), read_recent(spark, path)
    spend_columns = [*sorted(categories), *([] if fe.TECH in categories else [fe.TECH])]
    whole = merged_profile(profile)
    months = fe.window_edges(fe.FULL_WINDOWS) | fe.window_edges(fe.TECH_WINDOWS) | {fe.YEAR, fe.TARGET_MONTHS}
    edges = [months_before(LAST_DATE, m).alias(edge(m)) for m in sorted(months - {0})]
    # A customer without dated transactions has a profile and no windows.
    dated = whole.select(ID, LAST_DATE, *edges).join(recent.drop("batch"), ID, "left")
    windows = dated.groupBy(ID).agg(*window_columns(spend_columns, thresholds is not None))
    double = lambda m: steady(F.coalesce(whole_sum(F.col(m), F.col(f"{m}_odd")), F.lit(0.0)))
    active = whole.select(
        ID,
        LAST_DATE,
        F.col("n").alias("num_tx_total"),
        double("gasto").alias("total_gasto"),
        double("ganados").alias("puntos_ganados_total"),
        double("redimidos").alias("puntos_redimidos_total"),
        F.col("negativas").alias("num_tx_negativas"),
    ).join(windows, ID)
    return assembled(active, customers, sorted(categories), as_of, thresholds)
