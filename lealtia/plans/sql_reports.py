"""The business reports as SQL text over the views ``raw_customers`` and ``raw_transacciones``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUSTOMERS_VIEW = "raw_customers"
TRANSACTIONS_VIEW = "raw_transacciones"

REDEEMED = f"""WITH redeemed AS (
  SELECT id_cliente, sum(puntos) AS total_puntos FROM {TRANSACTIONS_VIEW}
  WHERE tipo_transaccion = 'Redemption' GROUP BY id_cliente
)"""

REPORTS = {
    "top_cities": f"""
SELECT ciudad, count(DISTINCT id_cliente) AS total_usuarios
FROM {CUSTOMERS_VIEW} GROUP BY ciudad ORDER BY total_usuarios DESC, ciudad LIMIT 2""",
    "top_spend_category": f"""
SELECT id_cliente, rint(CAST(sum(CAST(valor_transaccion AS DECIMAL(38, 12))) AS DOUBLE) * 1e6) / 1e6 AS total_consumo
FROM {TRANSACTIONS_VIEW} WHERE categoria = :category
GROUP BY id_cliente ORDER BY total_consumo DESC, id_cliente LIMIT 10""",
    "top_redeemed": f"{REDEEMED} SELECT * FROM redeemed ORDER BY total_puntos DESC, id_cliente LIMIT 10",
    "top_redeemed_magnitude": f"{REDEEMED} SELECT * FROM redeemed ORDER BY total_puntos, id_cliente LIMIT 10",
    "top_balance": f"""
SELECT id_cliente, saldo_puntos FROM {CUSTOMERS_VIEW} ORDER BY saldo_puntos DESC, id_cliente LIMIT 10""",
    "redeem_and_balance": f"""{REDEEMED}
SELECT r.id_cliente, r.total_puntos, c.saldo_puntos
FROM redeemed r JOIN {CUSTOMERS_VIEW} c ON r.id_cliente = c.id_cliente
ORDER BY c.saldo_puntos DESC, r.total_puntos DESC, r.id_cliente LIMIT 10""",
    "monthly_points": f"""
SELECT date_format(CAST(fecha AS TIMESTAMP), 'yyyy-MM') AS mes,
  coalesce(sum(puntos) FILTER (WHERE tipo_transaccion = 'Sale'), 0.0) AS total_acumulacion,
  coalesce(sum(puntos) FILTER (WHERE tipo_transaccion = 'Redemption'), 0.0) AS total_redencion
FROM {TRANSACTIONS_VIEW} GROUP BY 1 ORDER BY 1""",
}


def register_views(transactions: DataFrame, customers: DataFrame) -> None:
    """Make both tables known to SQL under their names, for this session."""
    transactions.createOrReplaceTempView(TRANSACTIONS_VIEW)
    customers.createOrReplaceTempView(CUSTOMERS_VIEW)


def report(spark: SparkSession, name: str, category: str = "SALUD Y BELLEZA") -> DataFrame:
    """A report by its SQL text, over the registered views."""
    args = {"category": category} if ":category" in REPORTS[name] else None
    return spark.sql(REPORTS[name], args=args)
