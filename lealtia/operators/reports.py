"""The six business reports over the raw tables.

Every top-n report breaks ties by id or name, so that its rows do not depend on the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import month_key, parse_timestamp, steady
from lealtia.operators.anchor import ID


def top_cities(customers: DataFrame, n: int = 2) -> DataFrame:
    """Cities with the most customers."""
    users = customers.groupBy("ciudad").agg(F.countDistinct(ID).alias("total_usuarios"))
    return users.orderBy(F.desc("total_usuarios"), "ciudad").limit(n)


def top_spenders(tx: DataFrame, category: str, n: int = 10) -> DataFrame:
    """Customers who spent most in one category."""
    spend = tx.where(F.col("categoria") == category).groupBy(ID)
    ranked = spend.agg(steady(F.sum("valor_transaccion")).alias("total_consumo"))
    return ranked.orderBy(F.desc("total_consumo"), ID).limit(n)


def redeemed_points(tx: DataFrame) -> DataFrame:
    """Signed sum of redeemed points per customer."""
    redeemed = tx.where(F.col("tipo_transaccion") == "Redemption").groupBy(ID)
    return redeemed.agg(steady(F.sum("puntos")).alias("total_puntos"))


def top_redeemed(tx: DataFrame, n: int = 10) -> DataFrame:
    """Customers by the signed sum of redeemed points, largest first."""
    return redeemed_points(tx).orderBy(F.desc("total_puntos"), ID).limit(n)


def top_redeemed_by_size(tx: DataFrame, n: int = 10) -> DataFrame:
    """Customers who redeemed most, where redemptions are booked as negative points."""
    return redeemed_points(tx).orderBy("total_puntos", ID).limit(n)


def top_balances(customers: DataFrame, n: int = 10) -> DataFrame:
    """Customers with the largest point balance."""
    return customers.select(ID, "saldo_puntos").orderBy(F.desc("saldo_puntos"), ID).limit(n)


def redeemed_and_balance(tx: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Redeemed points next to the balance, for customers who redeemed; largest balance first."""
    joined = redeemed_points(tx).join(customers.select(ID, "saldo_puntos"), ID)
    return joined.orderBy(F.desc("saldo_puntos"), F.desc("total_puntos"), ID).limit(n)


def monthly_points(tx: DataFrame) -> DataFrame:
    """Points earned and redeemed per month."""
    month = month_key(parse_timestamp("fecha")).alias("mes")

    def points(kind: str):
        return steady(F.sum(F.when(F.col("tipo_transaccion") == kind, F.col("puntos")).otherwise(0.0)))

    by_month = tx.groupBy(month).agg(
        points("Sale").alias("total_acumulacion"), points("Redemption").alias("total_redencion")
    )
    return by_month.orderBy(F.asc_nulls_last("mes"))
