"""Customer feature blocks. Each block is a list of aggregates over anchored transactions and their measures, so any mix
of blocks is one pass over the table. Conditions are SQL text for ``FILTER``: a sum is touched by the rows that count
in it only, where a sum of conditional values would be read and written for every row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import (
    LOCAL_THRESHOLDS,
    canonical_category,
    decimal_part,
    indicator,
    intensity_class,
    is_negative_sale,
    log10_plus_one,
    months_before,
    negative_part,
    odd_part,
    parse_number,
    positive_part,
    steady,
    total,
    whole_days,
    whole_sum,
)
from lealtia.operators.anchor import ID, LAST_DATE, edge, in_window, with_anchor

TECH = "TECNOLOGIA"
TARGET = "target_compra_tecnologia"
MAX_CATEGORIES = 1_000
#: What the measures of a transaction are made of: amount, points earned and points redeemed.
MEASURES = ("_gasto", "_ganados", "_redimidos")


class Window(NamedTuple):
    """Window of months before the latest transaction, and the name its columns carry."""

    name: str
    start: int
    end: int

    @property
    def months(self) -> int:
        return self.start - self.end


# The windows of the full and of the supervised feature table.
FULL_WINDOWS = [Window("1m", 3, 0), Window("3m", 6, 3), Window("6m", 9, 3), Window("12m", 15, 3)]
SUPERVISED_WINDOWS = [Window("3m", 6, 3), Window("6m", 9, 3)]
TECH_WINDOWS = [Window("3m", 6, 3), Window("6m", 9, 3), Window("12m", 15, 3)]
YEAR = 12
TARGET_MONTHS = 3


def window_edges(windows: Sequence[Window]) -> set[int]:
    return {m for w in windows for m in (w.start, w.end)}


def recode_category(tx: DataFrame) -> DataFrame:
    """One spelling per category."""
    return tx.withColumn("categoria", canonical_category("categoria"))


def mark_negative_sales(tx: DataFrame) -> DataFrame:
    """Adds ``tx_negativa``: sales booked with a negative amount or negative points."""
    return tx.withColumn("tx_negativa", is_negative_sale())


def category_values(tx: DataFrame) -> list[str]:
    """Categories in alphabetical order. They become columns, so too many of them is an error."""
    found = tx.where(F.col("categoria").isNotNull()).select("categoria").distinct()
    values = [row[0] for row in found.limit(MAX_CATEGORIES + 1).collect()]
    if len(values) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories; name the wanted ones")
    return sorted(values)


def recency(as_of: datetime | None) -> Column:
    """Days from the latest transaction to ``as_of``. Without a date: to the latest transaction itself."""
    if as_of is None:
        return F.when(F.col(LAST_DATE).isNotNull(), F.lit(0).cast("long"))
    return whole_days(F.lit(as_of).cast("timestamp_ntz"), LAST_DATE)


def measured(tx: DataFrame) -> DataFrame:
    """Adds the measures, each as the decimal that is summed and, beside it, what a decimal cannot hold."""
    values = (F.col("valor_transaccion"), positive_part("puntos"), negative_part("puntos"))
    parts = {"": decimal_part, "_odd": odd_part}
    return tx.withColumns({f"{m}{s}": part(v) for m, v in zip(MEASURES, values) for s, part in parts.items()})


def inside(start: int, end: int | None) -> str:
    """:func:`lealtia.operators.anchor.in_window` as SQL text."""
    return f"fecha >= {edge(start)}" + ("" if end is None else f" AND fecha < {edge(end)}")


def of_category(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"categoria = '{escaped}'"


def picked(measure: str, condition: str = "true") -> Column:
    """A measure summed over the rows where ``condition`` holds, as :func:`lealtia.functions.scalars.total` does."""
    decimals = F.expr(f"sum({measure}) FILTER (WHERE {condition})")
    odd = F.expr(f"sum({measure}_odd) FILTER (WHERE {condition} AND {measure}_odd IS NOT NULL)")
    return steady(F.coalesce(whole_sum(decimals, odd), F.lit(0.0)))


def counted(condition: str = "true") -> Column:
    """Number of transactions with an id where ``condition`` holds."""
    return F.expr(f"count(id_transaccion) FILTER (WHERE {condition})")


def profile_block() -> list[Column]:
    """Whole history: counts, spend, points earned and redeemed, negative sales."""
    return [
        counted().alias("num_tx_total"),
        picked("_gasto").alias("total_gasto"),
        picked("_ganados").alias("puntos_ganados_total"),
        picked("_redimidos").alias("puntos_redimidos_total"),
        F.count_if(is_negative_sale()).alias("num_tx_negativas"),
    ]


def slim_profile_block() -> list[Column]:
    return profile_block()[:2]


def activity_block(name: str, condition: str = "true") -> list[Column]:
    """Count, spend, points earned and redeemed of the rows inside a window."""
    return [
        counted(condition).alias(f"num_tx_{name}"),
        picked("_gasto", condition).alias(f"gasto_{name}"),
        picked("_ganados", condition).alias(f"puntos_ganados_{name}"),
        picked("_redimidos", condition).alias(f"puntos_redimidos_{name}"),
    ]


def window_block(windows: Sequence[Window] = FULL_WINDOWS) -> list[Column]:
    return [c for w in windows for c in activity_block(w.name, inside(w.start, w.end))]


def category_block(categories: Sequence[str]) -> list[Column]:
    """Spend of the last year per category, and over all named categories."""
    recent = inside(YEAR, None)
    spend = [picked("_gasto", f"{recent} AND {of_category(c)}").alias(f"gasto_{c}_12m") for c in categories]
    return [*spend, picked("_gasto", f"{recent} AND categoria IS NOT NULL").alias("_gasto_12m")]


def tech_year_block() -> list[Column]:
    """Technology spend of the last year and spend on everything, uncategorised rows included."""
    recent = inside(YEAR, None)
    return [
        picked("_gasto", f"{recent} AND {of_category(TECH)}").alias(f"gasto_{TECH}_12m"),
        picked("_gasto", recent).alias("_gasto_12m"),
    ]


def tech_share(spend: str = f"gasto_{TECH}_12m") -> list[Column]:
    """Technology share of the year's spend, and whether there was any."""
    return [
        F.try_divide(F.col(spend), F.col("_gasto_12m") + 1).alias("pct_tecnologia_12m"),
        indicator(F.col(spend) > 0).alias("compra_tecnologia"),
    ]


def tech_mean_block(windows: Sequence[Window] = TECH_WINDOWS) -> list[Column]:
    """Monthly mean of technology spend per window."""
    return [
        (picked("_gasto", f"{inside(w.start, w.end)} AND {of_category(TECH)}") / w.months).alias(
            f"avg_gasto_tecnologia_{w.months}m"
        )
        for w in windows
    ]


def target_block(months: int = TARGET_MONTHS, category: str = TECH) -> list[Column]:
    """Purchases in the label window, which ends before the latest transaction."""
    return [counted(f"{inside(months, 0)} AND {of_category(category)}").alias("num_tx_target")]


def log_columns(pairs: dict[str, str]) -> list[Column]:
    return [log10_plus_one(source).alias(name) for name, source in pairs.items()]


def per_customer(anchored: DataFrame, *blocks: list[Column]) -> DataFrame:
    """One row per active customer with the columns of all blocks."""
    return measured(anchored).groupBy(ID, LAST_DATE).agg(*[c for block in blocks for c in block])


def profile(tx: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Whole-history profile of the active customers; needs no join, the date is one more aggregate."""
    names = ["num_tx_total", "total_gasto", "puntos_ganados_total", "puntos_redimidos_total"]
    return (
        measured(tx.where(F.col(ID).isNotNull()))
        .groupBy(ID)
        .agg(F.max("fecha").alias(LAST_DATE), *profile_block())
        .select(ID, *names, recency(as_of).alias("recencia_dias"), "num_tx_negativas")
    )


def window_features(tx: DataFrame, windows: Sequence[Window] = FULL_WINDOWS) -> DataFrame:
    """Activity per window for every active customer, 0 where a window is empty."""
    anchored = with_anchor(tx, window_edges(windows))
    return per_customer(anchored, window_block(windows)).drop(LAST_DATE)


def window_features_as_of(tx: DataFrame, months: int, as_of: datetime) -> DataFrame:
    """Activity since ``months`` before a given date, for customers who have any."""
    start = months_before(F.lit(as_of).cast("timestamp_ntz"), months)
    recent = tx.where(F.col(ID).isNotNull() & (F.col("fecha") >= start))
    return measured(recent).groupBy(ID).agg(*activity_block(f"{months}m"))


def tech_mean_as_of(tx: DataFrame, months: int, as_of: datetime) -> DataFrame:
    """Monthly mean of technology spend since ``months`` before a given date, for customers who have any."""
    start = months_before(F.lit(as_of).cast("timestamp_ntz"), months)
    recent = tx.where(F.col(ID).isNotNull() & (F.col("fecha") >= start) & (F.col("categoria") == TECH))
    value = total(parse_number("valor_transaccion")) / months
    return recent.groupBy(ID).agg(value.alias(f"avg_gasto_tecnologia_{months}m"))


def category_features(tx: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Spend of the last year per category as columns, with the technology share and flag."""
    if TECH not in categories:
        categories = [*categories, TECH]
    wide = per_customer(with_anchor(tx, [YEAR]), category_block(categories))
    return wide.select(ID, *[f"gasto_{c}_12m" for c in categories], *tech_share())


def tech_means(tx: DataFrame, windows: Sequence[Window] = TECH_WINDOWS) -> DataFrame:
    """Monthly technology means for customers who bought technology in at least one window.

    The widest outer join of the single windows, done as one aggregation: a window without such
    purchases is null.
    """
    anchored = with_anchor(tx.where(F.col(ID).isNotNull()), window_edges(windows))
    is_tech = F.col("categoria") == TECH
    seen = [F.count_if(in_window(w.start, w.end) & is_tech).alias(f"_seen_{w.name}") for w in windows]
    wide = per_customer(anchored, tech_mean_block(windows), seen)
    columns = []
    for w in windows:
        name = f"avg_gasto_tecnologia_{w.months}m"
        columns.append(F.when(F.col(f"_seen_{w.name}") > 0, F.col(name)).alias(name))
    return wide.select(ID, *columns).dropna("all", subset=[f"avg_gasto_tecnologia_{w.months}m" for w in windows])


def tech_year(tx: DataFrame) -> DataFrame:
    """Technology spend, share and flag of the last year, for customers with a dated transaction."""
    wide = per_customer(with_anchor(tx, [YEAR]), tech_year_block()).where(F.col(LAST_DATE).isNotNull())
    return wide.select(ID, f"gasto_{TECH}_12m", *tech_share())


def target(
    tx: DataFrame,
    thresholds: Sequence[int] = LOCAL_THRESHOLDS,
    months: int = TARGET_MONTHS,
    category: str = TECH,
) -> DataFrame:
    """Purchases in the label window and their class, for every active customer."""
    counted = per_customer(with_anchor(tx, [months]), target_block(months, category))
    return counted.select(ID, "num_tx_target", intensity_class("num_tx_target", thresholds).alias(TARGET))
