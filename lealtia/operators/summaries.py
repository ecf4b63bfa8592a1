"""Cluster summaries under a radius limit: number, mean and summed squared distance to it, which merge exactly.

A task turns its points into summaries none of which is wider than the limit; summaries of several tasks are merged
in rounds. Where there would be too many of them the limit is raised, and the limit reached is part of the result.
From such summaries come micro-clusters for a hierarchy, and silhouettes with a proven error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.session import staged

# Fixed value: radius limit of the micro-clusters.
THRESHOLD = 0.5
#: Summaries held by a task and in the result at most; the limit is raised until they suffice.
MOST = 1_024
#: Parts merged by one task in a round.
FAN_IN = 8
#: Points inserted at once.
BLOCK = 1_024
#: Rows compared at once with all that wait to stand on their own, and points measured at once.
STANDING, MEASURED = 256, 128
#: Labellings whose summaries are made side by side; their last merges have few tasks each.
SIDE_BY_SIDE = 8
#: Factor by which a limit is raised.
RAISE = 1.25

SCHEMA = "label long, part long, size double, centre array<double>, spread double, threshold double"
IN_ARROW = pa.schema(
    [
        ("label", pa.int64()),
        ("part", pa.int64()),
        ("size", pa.float64()),
        ("centre", pa.list_(pa.float64())),
        ("spread", pa.float64()),
        ("threshold", pa.float64()),
    ]
)


class Summaries(NamedTuple):
    """Sizes, centres (one row each), summed squared distances to the centre."""

    size: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    @classmethod
    def of_points(cls, x: np.ndarray) -> Summaries:
        return cls(np.ones(len(x)), x, np.zeros(len(x)))

    def rows(self, picked: np.ndarray) -> Summaries:
        return Summaries(self.size[picked], self.centre[picked], self.spread[picked])

    def beside(self, other: Summaries) -> Summaries:
        return Summaries(*[np.concatenate(pair) for pair in zip(self, other)])

    def radius(self) -> np.ndarray:
        return np.sqrt(self.spread / self.size)


def merged_radius(a: Summaries, b: Summaries) -> np.ndarray:
    """Radius of the union of each summary of ``a`` with the one of ``b`` beside it."""
    size = a.size + b.size
    apart = ((a.centre - b.centre) ** 2).sum(axis=1)
    return np.sqrt((a.spread + b.spread + a.size * b.size / size * apart) / size)


def union(parts: Summaries) -> Summaries:
    """All summaries as one."""
    size = parts.size.sum()
    centre = (parts.size[:, None] * parts.centre).sum(axis=0) / size
    spread = parts.spread.sum() + (parts.size * ((parts.centre - centre) ** 2).sum(axis=1)).sum()
    return Summaries(np.array([size]), centre[None, :], np.array([spread]))


def closest(a: Summaries, b: Summaries) -> np.ndarray:
    """For each summary of ``a`` the number of the nearest centre of ``b``."""
    return ((b.centre**2).sum(axis=1) - 2.0 * (a.centre @ b.centre.T)).argmin(axis=1)


def absorbed(held: Summaries, new: Summaries, limit: float) -> Summaries:
    """``held`` with every one of ``new`` taken into its nearest summary, or standing on its own, none over ``limit``.

    What one summary takes in at once is the longest run, nearest first, whose union keeps the limit.
    """
    while len(new.size):
        place = closest(new, held) if len(held.size) else np.zeros(len(new.size), np.int64)
        fits = merged_radius(new, held.rows(place)) <= limit if len(held.size) else np.zeros(len(new.size), bool)
        left = np.ones(len(new.size), bool)
        if fits.any():
            left[taken_in(held, new, place, np.flatnonzero(fits), limit)] = False
        # What fits nowhere stands on its own, but for what fits one that now does: that is tried again.
        alone = standing(new, np.flatnonzero(~fits), limit)
        left[alone] = False
        held, new = held.beside(new.rows(alone)), new.rows(left)
    return held


def taken_in(held: Summaries, new: Summaries, place: np.ndarray, own: np.ndarray, limit: float) -> np.ndarray:
    """Those of the rows ``own`` of ``new`` that ``held`` takes in, each at its ``place``; ``held`` is changed.

    All summaries search for the length of their runs at once, each by halving.
    """
    apart = ((new.centre[own] - held.centre[place[own]]) ** 2).sum(axis=1)
    own = own[np.lexsort((apart, place[own]))]
    targets, starts, counts = np.unique(place[own], return_index=True, return_counts=True)
    run = np.repeat(np.arange(len(targets)), counts)
    rank = np.arange(len(own)) - starts[run]
    into = held.rows(targets)
    gap = new.centre[own] - into.centre[run]

    def unions(first: np.ndarray) -> Summaries:
        """Each target with the first so many of its run."""
        some = np.where(rank < first[run], new.size[own], 0.0)
        size = into.size + np.add.reduceat(some, starts)
        step = np.add.reduceat(some[:, None] * gap, starts, axis=0) / size[:, None]
        inner = np.where(some > 0, new.spread[own], 0.0) + some * ((gap - step[run]) ** 2).sum(axis=1)
        spread = into.spread + into.size * (step**2).sum(axis=1) + np.add.reduceat(inner, starts)
        return Summaries(size, into.centre + step, spread)

    def whole(k: int, length: int) -> Summaries:
        return union(into.rows(np.array([k])).beside(new.rows(own[starts[k] : starts[k] + length])))

    fewest, most = np.ones(len(targets), np.int64), counts.copy()
    while (fewest < most).any():
        middle = (fewest + most + 1) // 2
        rough = unions(middle)
        keeps = rough.radius() <= limit
        # Where rounding could decide, the union itself does.
        unsure = 1e-12 * (limit**2 + (rough.centre**2).sum(axis=1)) + 1e-9 * limit**2
        for k in np.flatnonzero((fewest < most) & (np.abs(rough.spread / rough.size - limit**2) <= unsure)):
            keeps[k] = whole(k, middle[k]).radius()[0] <= limit
        fewest, most = np.where(keeps, middle, fewest), np.where(keeps, most, middle - 1)
        most = np.maximum(fewest, most)
    for k, target in enumerate(targets):
        for column, value in zip(held, whole(k, fewest[k])):
            column[target] = value[0]
    return own[rank < fewest[run]]


def standing(new: Summaries, waiting: np.ndarray, limit: float) -> np.ndarray:
    """The first of the rows ``waiting``, the next one that does not fit it, the next that fits neither, and so on."""
    alone: list[int] = []
    squared = (new.centre**2).sum(axis=1)
    count = 8
    while len(waiting):
        first, count = waiting[:count], min(2 * count, STANDING)
        a, b = new.rows(first), new.rows(waiting)
        size = a.size[:, None] + b.size
        apart = squared[first][:, None] + squared[waiting] - 2.0 * (a.centre @ b.centre.T)
        share = a.size[:, None] * b.size / size
        radius = (a.spread[:, None] + b.spread + share * apart) / size
        close = radius <= limit**2
        # Where rounding could decide, the differences do.
        unsure = 1e-12 * (limit**2 + radius + share / size * (squared[first][:, None] + squared[waiting]))
        i, j = np.nonzero(~(np.abs(radius - limit**2) > unsure))
        for at in range(0, len(i), STANDING * STANDING):
            p, q = i[at : at + STANDING * STANDING], j[at : at + STANDING * STANDING]
            close[p, q] = merged_radius(a.rows(p), b.rows(q)) <= limit
        free = np.ones(len(waiting), bool)
        for row in range(len(first)):
            if free[row]:
                alone.append(first[row])
                free &= ~close[row]
        free[: len(first)] = False
        waiting = waiting[free]
    return np.array(alone, np.int64)


def tightened(held: Summaries, limit: float, most: int) -> tuple[Summaries, float]:
    """At most ``most`` summaries, with the limit raised as far as that takes."""
    while len(held.size) > most:
        if limit == 0.0:
            apart = np.sort(((held.centre - held.centre[closest_other(held)]) ** 2).sum(axis=1))
            limit = float(np.sqrt(apart[apart > 0][: len(apart) // 4 + 1].max(initial=1e-300)) / 2)
        else:
            limit *= RAISE
        order = np.argsort(-held.size, kind="stable")
        rows = held.rows(order)
        held = absorbed(Summaries(np.zeros(0), np.zeros((0, rows.centre.shape[1])), np.zeros(0)), rows, limit)
    return held, limit


def closest_other(held: Summaries) -> np.ndarray:
    gaps = (held.centre**2).sum(axis=1)[None, :] - 2.0 * (held.centre @ held.centre.T)
    np.fill_diagonal(gaps, np.inf)
    return gaps.argmin(axis=1)


def summarise(points: DataFrame, threshold: float = THRESHOLD, most: int = MOST, label: str | None = None) -> DataFrame:
    """Summaries of the points, for each value of ``label`` its own: ``label``, ``size``, ``centre``, ``spread``,
    ``threshold``.

    No summary has a larger radius (root mean square distance of its points to their mean) than the ``threshold``
    in its row. It is the one asked for, or the one that had to be reached for a label to have at most ``most``
    summaries. Sizes, means and squared distances add up to those of the points whatever the partitioning, and the
    squared distance inside summaries is at most size times threshold squared; which points share a summary depends
    on the order they are met in. Points must have one length and no nulls. There must be few labels, as for
    clusters: a task holds at most ``most`` summaries of each.
    """
    marked = F.lit(0) if label is None else F.col(label)
    given = points.select(marked.cast("long").alias("label"), F.col("features").cast("array<double>").alias("features"))

    def empty(dims: int) -> Summaries:
        return Summaries(np.zeros(0), np.zeros((0, dims)), np.zeros(0))

    def out(label: int, part: int, held: Summaries, limit: float) -> pa.RecordBatch:
        n = len(held.size)
        columns = [[label] * n, [part] * n, held.size, held.centre.tolist(), held.spread, [limit] * n]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, IN_ARROW)], schema=IN_ARROW)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[int, tuple[Summaries, float]] = {}
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(batch), -1) if len(batch) else flat.reshape(0, 0)
            for mark in np.unique(marks).tolist():
                own = x[marks == mark]
                for start in range(0, len(own), BLOCK):
                    now, limit = held.get(mark) or (empty(x.shape[1]), threshold)
                    same, counts = np.unique(own[start : start + BLOCK], axis=0, return_counts=True)
                    new = Summaries(counts.astype("float64"), same, np.zeros(len(same)))
                    held[mark] = tightened(absorbed(now, new, limit), limit, most)
        for mark, (now, limit) in held.items():
            yield out(mark, part, now, limit)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        label, part = (k.as_py() for k in key)
        limit = max(rows.column("threshold").to_pylist())
        all_of_them = Summaries(
            rows.column("size").to_numpy(), np.array(rows.column("centre").to_pylist()), rows.column("spread").to_numpy()
        )
        # In an order that does not depend on how the rows came together.
        order = np.lexsort((*all_of_them.centre.T[::-1], -all_of_them.size))
        now = absorbed(empty(all_of_them.centre.shape[1]), all_of_them.rows(order), limit)
        return pa.Table.from_batches([out(label, part, *tightened(now, limit, most))])

    held = staged(given.mapInArrow(per_task, SCHEMA), "summaries")
    parts = (held.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        grouped = held.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("label", "part")
        held = staged(grouped.applyInArrow(merge, SCHEMA), "summaries")
    return held.drop("part")


def labelled_by_summary(points: DataFrame, centres: np.ndarray, labels: Sequence[int], name: str = "cluster") -> DataFrame:
    """Points with ``micro`` (the nearest of the centres) and the label of that centre."""
    shared = points.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("int")
    def nearest_centre(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype="int32")
        x = np.stack(features.to_numpy())
        return pd.Series(((shared.value**2).sum(axis=1) - 2.0 * (x @ shared.value.T)).argmin(axis=1).astype("int32"))

    found = points.withColumn("micro", nearest_centre(F.col("features").cast("array<double>")))
    names = F.array(*[F.lit(int(x)) for x in labels])
    return found.withColumn(name, F.get(names, F.col("micro")))


def silhouette_bounds(points: DataFrame, labels: Sequence[str], most: int = 256) -> DataFrame:
    """Mean Euclidean silhouette of several labellings from summaries: ``labelling``, ``value``, ``error``.

    The exact mean is within ``error`` of ``value``. The mean distance of a point to the points of a summary lies
    between its distance d to their mean and the root of d squared plus their mean squared distance to it; summed
    over the summaries of a cluster this bounds the silhouette of every point. The work grows with the points times
    the summaries, of which a cluster has at most ``most``; with a summary per different point the error is 0.
    Points of a cluster of one have the silhouette 0, as have all points where there is only one cluster.
    """
    with ThreadPool(SIDE_BY_SIDE) as pool:
        return reduce(DataFrame.unionByName, pool.map(lambda name: bounds_of(points, name, most), labels))


def bounds_of(points: DataFrame, label: str, most: int) -> DataFrame:
    rows = summarise(points, 0.0, most, label).collect()  # at most ``most`` per cluster
    names = sorted({r["label"] for r in rows})
    place = {name: i for i, name in enumerate(names)}
    order = sorted(rows, key=lambda r: place[r["label"]])
    shared = points.sparkSession.sparkContext.broadcast(
        (
            names,
            np.array([place[r["label"]] for r in order]),
            np.array([r["size"] for r in order]),
            np.array([r["centre"] for r in order]),
            np.array([r["spread"] for r in order]),
        )
    )
    given = points.select(F.col(label).cast("long").alias("label"), F.col("features").cast("array<double>").alias("features"))
    schema = "n double, low double, high double"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, cluster, size, centre, spread = shared.value
        sums = np.zeros(3)
        member = np.zeros((len(size), len(names)))
        member[np.arange(len(size)), cluster] = size
        whole = member.sum(axis=0)
        squared = (centre**2).sum(axis=1)
        for batch in batches:
            marks = np.searchsorted(names, batch.column(0).to_numpy(zero_copy_only=False))
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x_all = flat.reshape(len(batch), -1) if len(batch) else centre[:0]
            for start in range(0, len(x_all), MEASURED):
                x, own = x_all[start : start + MEASURED], marks[start : start + MEASURED]
                row = np.arange(len(x))
                apart = np.maximum(0.0, squared - 2.0 * (x @ centre.T) + (x**2).sum(axis=1)[:, None])
                # Rounding leaves a little of a distance that is none.
                apart[apart <= 1e-12 * (squared + 1.0)] = 0.0
                near, far = np.sqrt(apart) @ member, np.sqrt(apart + spread / size) @ member
                mates = whole[own] - 1
                others = np.ones((len(x), len(names)), bool)
                others[row, own] = False
                a = [d[row, own] / np.maximum(mates, 1) for d in (near, far)]
                b = [np.where(others, d / whole, np.inf).min(axis=1) for d in (near, far)]
                alone = (mates == 0) | (len(names) == 1)
                for k, (inner, outer) in enumerate(((a[1], b[0]), (a[0], b[1]))):
                    top = np.maximum(inner, outer)
                    score = np.where(alone | (top == 0), 0.0, (outer - inner) / np.where(top == 0, 1.0, top))
                    sums[k + 1] += score.sum() if len(names) > 1 else 0.0
                sums[0] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in sums], ["n", "low", "high"])

    n, low, high = F.sum("n"), F.sum("low"), F.sum("high")
    return given.mapInArrow(measure, schema).agg(
        F.lit(label).alias("labelling"),
        F.try_divide(low + high, 2 * n).alias("value"),
        F.try_divide(high - low, 2 * n).alias("error"),
    )
