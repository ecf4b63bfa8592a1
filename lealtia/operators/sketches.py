"""Sketches that are stored once and merged for any question: distinct counts (HLL) and quantiles (KLL).

A table holds one sketch per smallest cell, such as a city and a month. Any coarser grouping is a merge of those
rows, so the detail rows are read once, and a new month only adds its own cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.operators.scaling import RobustScale

#: Log of the number of registers: a relative standard error of 1.04 / sqrt(2 ** 15), which is 0.6 percent.
DISTINCT_LOG = 15
#: Size of a quantile sketch, and with it its rank error.
QUANTILE_SIZE = 800
QUARTILES = (0.25, 0.5, 0.75)


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """By how much the rank of one quantile can be off, as a share of the rows, with 99 percent confidence."""
    return 2.296 / size**0.9021


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, log: int = DISTINCT_LOG) -> DataFrame:
    """One row per cell of ``keys`` with a ``sketch`` of the different values of ``column``; nulls do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, log).alias("sketch"))


def distinct_counts(sketches: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """The estimated number of different values for a coarser grouping, from stored sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def quantile_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """One row per cell of ``keys`` and column: ``feature``, ``n`` (values that are not null), ``sketch``.

    All columns are sketched in one pass. A cell in which a column has no value has no row for it.
    """
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(c).alias("n"),
            F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias("sketch"),
        )
        for c in columns
    ]
    wide = df.groupBy(*keys).agg(F.array(*parts).alias("cells"))
    return wide.select(*keys, F.inline("cells")).where("n > 0")


def merged_quantiles(sketches: DataFrame, keys: Sequence[str] = (), size: int = QUANTILE_SIZE) -> DataFrame:
    """The sketches of each column merged over a coarser grouping: ``feature``, ``n``, ``sketch``."""
    merged = F.kll_merge_agg_double("sketch", size).alias("sketch")
    return sketches.groupBy(*keys, "feature").agg(F.sum("n").alias("n"), merged)


def quantiles(merged: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """A row per column and probability: ``probability``, ``value``. The rank is off by ``rank_error`` at most."""
    keys = [c for c in merged.columns if c != "sketch"]
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    values = F.kll_sketch_get_quantile_double("sketch", points)
    pairs = F.arrays_zip(points.alias("probability"), values.alias("value"))
    return merged.select(*keys, F.inline(pairs))


def histogram_of_sketch(merged: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value: ``feature``, ``bin`` (from 1), ``low``, ``high``,
    ``n``. Counts are differences of estimated ranks; a column of one value is one bin.

    ``merged`` has one row per column; two numbers of each are collected.
    """
    ends: dict[str, list[float]] = {}
    for row in quantiles(merged, (0.0, 1.0)).orderBy("probability").collect():
        ends.setdefault(row["feature"], []).append(row["value"])
    parts = []
    for feature, (least, most) in sorted(ends.items()):
        count = bins if least < most else 1
        edges = [least + (most - least) * i / count for i in range(count)] + [most]
        inner = [F.lit(float(e)) for e in edges[1:-1]]
        ranks = F.kll_sketch_get_rank_double("sketch", F.array(*inner)) if inner else F.array().cast("array<double>")
        upto = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
        cells = F.arrays_zip(
            F.sequence(F.lit(1), F.lit(count)).alias("bin"),
            F.array(*[F.lit(float(e)) for e in edges[:-1]]).alias("low"),
            F.array(*[F.lit(float(e)) for e in edges[1:]]).alias("high"),
            F.zip_with(F.slice(upto, 2, count), F.slice(upto, 1, count), lambda x, y: x - y).alias("share"),
        )
        own = merged.where(F.col("feature") == feature).select("feature", "n", F.inline(cells))
        parts.append(own.select("feature", "bin", "low", "high", F.rint(F.col("n") * F.col("share")).cast("long").alias("n")))
    if not parts:
        return merged.sparkSession.createDataFrame([], "feature string, bin int, low double, high double, n long")
    return reduce(DataFrame.unionByName, parts)


def robust_scale(merged: DataFrame) -> RobustScale:
    """Median and interquartile range per column from merged sketches; a few numbers per column are collected."""
    found: dict[str, dict[float, float]] = {}
    for row in quantiles(merged, QUARTILES).collect():
        found.setdefault(row["feature"], {})[row["probability"]] = row["value"]
    medians = {c: v[0.5] for c, v in found.items()}
    ranges = {c: v[0.75] - v[0.25] if v[0.75] > v[0.25] else 1.0 for c, v in found.items()}
    return RobustScale(medians, ranges)
