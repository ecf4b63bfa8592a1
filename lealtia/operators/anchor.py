"""Latest transaction per customer, and its join back to every transaction."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import months_before

ID = "id_cliente"
LAST_DATE = "last_date"

# A customer with at least this many rows is joined by broadcast instead of by shuffle. There is at most
# one per so many rows of the table, which bounds the broadcast.
BUSY_ROWS = 1_000_000


def last_transaction(tx: DataFrame) -> DataFrame:
    """One row per active customer: ``id_cliente``, ``last_date``."""
    return tx.where(F.col(ID).isNotNull()).groupBy(ID).agg(F.max("fecha").alias(LAST_DATE))


def edge(months: int) -> str:
    """Name of the column that holds the moment ``months`` before the latest transaction."""
    return LAST_DATE if months == 0 else f"_edge_{months}"


def in_window(start: int, end: int | None, date: str = "fecha") -> Column:
    """From ``start`` months before the latest transaction up to, not including, ``end`` months before.

    ``end=None`` leaves the window open at the top.
    """
    after_start = F.col(date) >= F.col(edge(start))
    return after_start if end is None else after_start & (F.col(date) < F.col(edge(end)))


def with_anchor(tx: DataFrame, months: Iterable[int] = (), busy_rows: int | None = BUSY_ROWS) -> DataFrame:
    """Transactions with the latest date of their customer and its window edges.

    The edges are computed once per customer, before the join. The rows of very busy customers stay
    where they were read and meet their date by broadcast, so that no task gets all of them. With ``busy_rows=None``
    there is one plain join, which a table bucketed by customer needs no shuffle for.
    """
    known = tx.where(F.col(ID).isNotNull())
    counted = known.groupBy(ID).agg(F.max("fecha").alias(LAST_DATE), F.count(F.lit(1)).alias("_rows"))
    edges = [months_before(LAST_DATE, m).alias(edge(m)) for m in sorted(set(months) - {0})]
    if busy_rows is None:
        return known.join(counted.select(ID, LAST_DATE, *edges), ID)
    # All uses read the same two aggregates, so Spark computes them once and reuses the exchange.
    busy = counted.where(F.col("_rows") >= busy_rows).select(ID, LAST_DATE, *edges)
    anchors = counted.where(F.col("_rows") > 0).select(ID, LAST_DATE, *edges)
    held = known.join(F.broadcast(busy), ID)
    # No date is after the latest. Without it the date would be pruned here, and the aggregate made once more.
    theirs = busy.select(F.col(ID).alias("_busy"), F.col(LAST_DATE).alias("_latest"))
    mine = (F.col(ID) == F.col("_busy")) & F.coalesce(F.col("fecha") <= F.col("_latest"), F.lit(True))
    # A few numbers per customer are hashed, so the transactions are not sorted.
    moved = known.join(F.broadcast(theirs), mine, "left_anti").join(anchors.hint("shuffle_hash"), ID)
    return held.unionByName(moved)
