"""Correlation of all pairs of numeric columns, and the columns that repeat an earlier one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import round_even
from lealtia.sources.schemas import numeric_columns

# Fixed value: columns correlated at least this much repeat each other.
REDUNDANT_AT = 0.90
# Relative variance below which a column counts as constant.
FLAT = 1e-13
#: Columns in a block; six arrays of its square are held by a task.
BLOCK_COLUMNS = 512
MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments per pair of columns over the rows where both are present, one row per pair.

    Each task reduces its rows to one small matrix per moment; only those are shuffled.
    """
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # Sums are taken around the means, which keeps them small and exact.
    row = numbers.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centre = np.array([row[c] if row[c] is not None else 0.0 for c in columns])
    first, second = np.triu_indices(len(columns))

    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(MOMENTS), len(columns), len(columns)))
        for batch in batches:
            x = batch.to_numpy(dtype="float64", na_value=np.nan) - centre
            present = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x, nan=0.0)
            sums, squares = x.T @ present, (x * x).T @ present
            acc += np.stack([present.T @ present, sums, sums.T, squares, squares.T, x.T @ x])
        values = {m: acc[k][first, second] for k, m in enumerate(MOMENTS)}
        yield pd.DataFrame({"p1": first.astype("int32"), "p2": second.astype("int32"), **values})

    schema = "p1 int, p2 int, " + ", ".join(f"{m} double" for m in MOMENTS)
    partial = numbers.mapInPandas(reduce_task, schema)
    return partial.groupBy("p1", "p2").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def block_moments(df: DataFrame, columns: Sequence[str], width: int) -> DataFrame:
    """The moments of :func:`pair_moments`, one pair of column blocks after the other.

    A pass reads the columns of two blocks and holds their cross products only: memory in a task and the rows that are
    shuffled are bounded by the square of ``width``, however many columns there are. ``df`` should be a stored table,
    which is read once per block for every block.
    """
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    centres: list[float] = []
    for start in range(0, len(columns), width):
        row = numbers.agg(*[F.avg(c).alias(c) for c in columns[start : start + width]]).first()
        centres += [v if v is not None else 0.0 for v in row]
    parts = []
    for a in range(0, len(columns), width):
        for b in range(a, len(columns), width):
            ends = min(a + width, len(columns)), min(b + width, len(columns))
            parts.append(cross_moments(numbers, columns, np.array(centres), (a, ends[0]), (b, ends[1])))
    return reduce(DataFrame.unionByName, parts)


def cross_moments(
    numbers: DataFrame, columns: list[str], centres: np.ndarray, left: tuple[int, int], right: tuple[int, int]
) -> DataFrame:
    """Moments of each pair of a column of ``left`` and one of ``right`` (first, end); each pair once."""
    same = left == right
    wanted = columns[slice(*left)] + ([] if same else columns[slice(*right)])
    shift = np.concatenate([centres[slice(*left)], [] if same else centres[slice(*right)]])
    m, n = left[1] - left[0], right[1] - right[0]
    first, second = np.triu_indices(m) if same else (g.ravel() for g in np.mgrid[:m, :n])

    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((len(MOMENTS), m, n))
        for batch in batches:
            both = batch.to_numpy(dtype="float64", na_value=np.nan) - shift
            x, y = both[:, :m], both if same else both[:, m:]
            in_x, in_y = (~np.isnan(v) for v in (x, y))
            in_x, in_y = in_x.astype("float64"), in_y.astype("float64")
            x, y = np.nan_to_num(x, nan=0.0), np.nan_to_num(y, nan=0.0)
            acc += np.stack([in_x.T @ in_y, x.T @ in_y, in_x.T @ y, (x * x).T @ in_y, in_x.T @ (y * y), x.T @ y])
        values = {name: acc[k][first, second] for k, name in enumerate(MOMENTS)}
        places = {"p1": (first + left[0]).astype("int32"), "p2": (second + right[0]).astype("int32")}
        yield pd.DataFrame({**places, **values})

    schema = "p1 int, p2 int, " + ", ".join(f"{name} double" for name in MOMENTS)
    partial = numbers.select(*wanted).mapInPandas(reduce_task, schema)
    return partial.groupBy("p1", "p2").agg(*[F.sum(name).alias(name) for name in MOMENTS])


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, width: int = BLOCK_COLUMNS) -> DataFrame:
    """Pearson correlation per pair, each pair once: ``p1 < p2`` are column positions.

    Null where a column does not vary. Up to ``width`` columns take one pass; more go block by block.
    """
    columns = list(columns or numeric_columns(df))
    names = F.array(*[F.lit(c) for c in columns])
    n, sx, sy, sxx, syy, sxy = (F.col(m) for m in MOMENTS)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    varies = (vx > FLAT * n * sxx) & (vy > FLAT * n * syy)
    value = F.when(varies, (n * sxy - sx * sy) / F.sqrt(vx) / F.sqrt(vy))
    moments = pair_moments(df, columns) if len(columns) <= width else block_moments(df, columns, width)
    return moments.select(
        "p1",
        "p2",
        F.element_at(names, F.col("p1") + 1).alias("feature_1"),
        F.element_at(names, F.col("p2") + 1).alias("feature_2"),
        F.when(F.abs(value) > 1, F.signum(value)).otherwise(value).alias("correlation"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full matrix in long form, both halves and the diagonal."""
    return both_halves(correlation_pairs(df, columns))


def both_halves(pairs: DataFrame) -> DataFrame:
    both = F.array(
        F.struct("p1", "p2", "feature_1", "feature_2"),
        F.struct(
            F.col("p2").alias("p1"),
            F.col("p1").alias("p2"),
            F.col("feature_2").alias("feature_1"),
            F.col("feature_1").alias("feature_2"),
        ),
    )
    sides = F.when(F.col("p1") == F.col("p2"), F.slice(both, 1, 1)).otherwise(both)
    return pairs.select(F.inline(sides), "correlation")


def upper_triangle(pairs: DataFrame) -> DataFrame:
    """Each pair of different columns once, with the size of its correlation."""
    return pairs.where(F.col("p1") < F.col("p2")).withColumn("correlation", F.abs("correlation"))


def high_pairs(pairs: DataFrame, threshold: float = REDUNDANT_AT) -> DataFrame:
    """Pairs correlated at least ``threshold``, strongest first."""
    strong = upper_triangle(pairs).where(F.col("correlation") >= threshold)
    return strong.select("feature_1", "feature_2", "correlation").orderBy(
        F.desc(round_even("correlation", 9)), "feature_1", "feature_2"
    )


def redundant_columns(pairs: DataFrame, threshold: float = REDUNDANT_AT) -> DataFrame:
    """Columns correlated at least ``threshold`` with any earlier column, in column order."""
    strong = upper_triangle(pairs).where(F.col("correlation") >= threshold)
    return strong.groupBy("p2", "feature_2").agg(F.count(F.lit(1)).alias("repeats")).orderBy("p2").select(
        F.col("feature_2").alias("feature"), "repeats"
    )


def reduced(df: DataFrame, threshold: float = REDUNDANT_AT, columns: Sequence[str] | None = None) -> DataFrame:
    """The numeric columns without the redundant ones."""
    columns = list(columns or numeric_columns(df))
    found = redundant_columns(correlation_pairs(df, columns), threshold)
    drop = {row["feature"] for row in found.collect()}  # column names only
    return df.select(*[c for c in columns if c not in drop])


def wide_matrix(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix with one column per feature and its row labels as a column."""
    return (
        matrix.groupBy("p1", F.col("feature_1").alias("feature"))
        .pivot("feature_2", list(columns))
        .agg(F.first("correlation"))
        .orderBy("p1")
        .drop("p1")
    )


def unpivot(df: DataFrame, key: str) -> DataFrame:
    """One row per key and numeric column."""
    names = [c for c in numeric_columns(df) if c != key]
    wide = df.select(key, *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot(key, names, "feature", "value")
