"""The customer feature tables: full, supervised, and the selections made from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import INTENSITY_CLASSES, LOCAL_THRESHOLDS, age_in_years, intensity_class, round_even
from lealtia.operators import features as fe
from lealtia.operators.anchor import BUSY_ROWS, ID, LAST_DATE, with_anchor
from lealtia.sources.schemas import numeric_columns, require_columns

# The columns of the selected supervised set, in order.
SELECTED_FEATURES = [
    "num_tx_total",
    "total_gasto",
    "recencia_dias",
    "log_num_tx_total",
    "log_total_gasto",
    "gasto_TECNOLOGIA_12m",
    "pct_tecnologia_12m",
    "avg_gasto_tecnologia_3m",
    "avg_gasto_tecnologia_6m",
    "num_tx_1m",
    "puntos_redimidos_1m",
    "puntos_redimidos_3m",
    "edad",
    "estrato_social",
    "saldo_puntos",
]

# The columns of the supervised feature table, in order.
SUPERVISED_FEATURES = [
    "estrato_social",
    "saldo_puntos",
    "edad",
    "num_tx_total",
    "total_gasto",
    "recencia_dias",
    "log_num_tx_total",
    "log_total_gasto",
    "num_tx_3m",
    "gasto_3m",
    "puntos_ganados_3m",
    "puntos_redimidos_3m",
    "num_tx_6m",
    "gasto_6m",
    "puntos_ganados_6m",
    "puntos_redimidos_6m",
    "gasto_TECNOLOGIA_12m",
    "pct_tecnologia_12m",
    "compra_tecnologia",
    "avg_gasto_tecnologia_3m",
    "avg_gasto_tecnologia_6m",
]


def fill_numbers(df: DataFrame) -> DataFrame:
    """Nulls of numeric columns become 0; texts and dates keep theirs."""
    return df.fillna(0, subset=numeric_columns(df))


def round_numbers(df: DataFrame, digits: int = 2) -> DataFrame:
    """Fractional columns rounded half to even."""
    kinds = dict(df.dtypes)
    return df.select(*[round_even(c, digits).alias(c) if kinds[c] in ("double", "float") else c for c in df.columns])


def demographics(customers: DataFrame, last: DataFrame) -> DataFrame:
    """Stratum, balance and age at the latest transaction, for every customer."""
    return customers.join(last, ID, "left").select(
        ID, "estrato_social", "saldo_puntos", age_in_years(LAST_DATE, "fecha_nacimiento").alias("edad")
    )


def customer_features(
    tx: DataFrame,
    customers: DataFrame,
    categories: Sequence[str] | None = None,
    as_of: datetime | None = None,
    thresholds: Sequence[int] | None = None,
    busy_rows: int | None = BUSY_ROWS,
) -> DataFrame:
    """Full feature table: one row per customer, inactive ones with zeros, rounded to 2 decimals.

    ``categories`` fixes the category columns; without it they are looked up first. With ``thresholds``
    the label comes along, from the same pass; it is null for inactive customers. ``busy_rows=None`` joins the latest
    dates without looking for busy customers, which keeps the layout of tables that are bucketed by customer.
    """
    tx = fe.recode_category(tx)
    categories = sorted(categories) if categories is not None else fe.category_values(tx)
    months = fe.window_edges(fe.FULL_WINDOWS) | fe.window_edges(fe.TECH_WINDOWS) | {fe.YEAR}
    if thresholds is not None:
        months |= {fe.TARGET_MONTHS}
    spend_columns = [*categories, *([] if fe.TECH in categories else [fe.TECH])]
    active = fe.per_customer(
        with_anchor(tx, months, busy_rows),
        fe.profile_block(),
        fe.window_block(fe.FULL_WINDOWS),
        fe.category_block(spend_columns),
        fe.tech_mean_block(fe.TECH_WINDOWS),
        [] if thresholds is None else fe.target_block(),
    )
    return assembled(active, customers, categories, as_of, thresholds)


def assembled(
    active: DataFrame,
    customers: DataFrame,
    categories: Sequence[str],
    as_of: datetime | None = None,
    thresholds: Sequence[int] | None = None,
) -> DataFrame:
    """The full feature table from the aggregates of the active customers."""
    label = F.when(F.col("num_tx_target").isNotNull(), intensity_class("num_tx_target", thresholds)) if thresholds else None
    logs = fe.log_columns(
        {
            "log_num_tx_total": "num_tx_total",
            "log_total_gasto": "total_gasto",
            "log_puntos_ganados": "puntos_ganados_total",
        }
    )
    wide = customers.join(active, ID, "left").select(
        *customers.columns,
        LAST_DATE,
        "num_tx_total",
        "total_gasto",
        "puntos_ganados_total",
        "puntos_redimidos_total",
        fe.recency(as_of).alias("recencia_dias"),
        "num_tx_negativas",
        *[
            f"{measure}_{w.name}"
            for w in fe.FULL_WINDOWS
            for measure in ("num_tx", "gasto", "puntos_ganados", "puntos_redimidos")
        ],
        *[f"gasto_{c}_12m" for c in categories],
        *fe.tech_share(),
        *[f"avg_gasto_tecnologia_{w.months}m" for w in fe.TECH_WINDOWS],
        age_in_years(LAST_DATE, "fecha_nacimiento").alias("edad"),
        *logs,
        *([] if label is None else [label.alias(fe.TARGET)]),
    )
    return round_numbers(fill_numbers(wide))


def supervised_features(
    tx: DataFrame,
    customers: DataFrame,
    thresholds: Sequence[int] = LOCAL_THRESHOLDS,
    as_of: datetime | None = None,
) -> DataFrame:
    """Supervised feature table with its label: one row per active customer."""
    windows, means = fe.SUPERVISED_WINDOWS, fe.SUPERVISED_WINDOWS
    months = fe.window_edges(windows) | {fe.YEAR, fe.TARGET_MONTHS}
    active = fe.per_customer(
        with_anchor(tx, months),
        fe.slim_profile_block(),
        fe.window_block(windows),
        fe.tech_year_block(),
        fe.tech_mean_block(means),
        fe.target_block(),
    )
    logs = fe.log_columns({"log_num_tx_total": "num_tx_total", "log_total_gasto": "total_gasto"})
    traits = customers.select(ID, "estrato_social", "saldo_puntos", "fecha_nacimiento")
    wide = traits.join(active, ID, "right").select(
        "*",
        age_in_years(LAST_DATE, "fecha_nacimiento").alias("edad"),
        fe.recency(as_of).alias("recencia_dias"),
        *logs,
        *fe.tech_share(),
        intensity_class("num_tx_target", thresholds).alias(fe.TARGET),
    )
    return fill_numbers(require_columns(wide, [ID, *SUPERVISED_FEATURES, fe.TARGET]))


def selected_features(features: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The selected columns with the label; customers without one count as non-buyers.

    Without ``labels`` the features have to hold the label already.
    """
    joined = features if labels is None else features.join(labels.select(ID, fe.TARGET), ID, "left")
    label = F.coalesce(F.col(fe.TARGET), F.lit(INTENSITY_CLASSES[0])).alias(fe.TARGET)
    wide = require_columns(joined, [ID, *SELECTED_FEATURES, fe.TARGET])
    return wide.select(ID, *SELECTED_FEATURES, label).dropna(subset=[fe.TARGET])


def clustering_features(reduced: DataFrame) -> DataFrame:
    """Numeric columns for clustering. The customer id stays as the key, it is not a feature."""
    return reduced.select(ID, *[c for c in numeric_columns(reduced) if c != ID])
