"""Approximate nearest neighbours by largest inner product: p-stable hashing with several probes per table.

Vectors are scaled by the largest norm of their kind (length and order of magnitude) and get one more component that
puts them on the unit sphere, so the largest inner product is the smallest distance. A table cuts Gaussian
projections into steps; a query visits the buckets around its own in the order of their estimated success, which is
the squared distance of its projections to the bucket. How fine the buckets are and how many a query visits is
fitted on a bounded sample whose true neighbours are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lealtia.llm.common import sized, stored

K = 20
TABLES = 2
#: Width of a step. Projections of unit vectors have a standard deviation of 1.
WIDTH = 2.0
#: Functions of a table are added until a vector shares its bucket with about so many others.
BUCKET_ROWS = 2_048
#: Vectors and queries of the sample that hashing is fitted on, and the recall that its queries have to reach.
SAMPLE_ROWS = 1_024
SAMPLE_QUERIES = 64
RECALL = 0.97
#: Buckets of a table that a query visits at most; where they would not do, buckets are made coarser.
MOST_PROBES = 4_096
#: Vectors and queries compared at once.
TILE_ROWS = 2_048
TILE_QUERIES = 1_024
SEED = 11

PAIRS = "scores array<double>, ids array<bigint>"


class Kind(NamedTuple):
    """Vectors of one length and order of magnitude: their largest norm."""

    length: int
    order: int
    norm: float


class Hashing(NamedTuple):
    """What a fit decides: the kinds of vectors, functions per table, and buckets visited per table."""

    kinds: list[Kind]
    tables: int
    functions: int
    probes: int


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a batch whose vectors have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        part = batch.filter(pa.array(lengths == n))
        yield part, matrix(part.column(column))


def norms(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1)
    return largest * np.sqrt(((x / largest[:, None]) ** 2).sum(axis=1))


def orders(x: np.ndarray) -> np.ndarray:
    """Powers of two nearest to the norms."""
    largest = np.abs(x).max(axis=1)
    return np.rint(np.log2(largest) + 0.5 * np.log2(((x / largest[:, None]) ** 2).sum(axis=1))).astype("int64")


def on_sphere(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors over ``norm``, with a component that makes their length 1."""
    scaled = x / norm
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
    return np.hstack([scaled, rest[:, None]])


def projections(length: int, tables: int, functions: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (table, function, component) and shifts (table, function), the same in every task.

    A table with fewer functions has the first ones of a table with more.
    """
    directions = np.empty((tables, functions, length + 1))
    shifts = np.empty((tables, functions))
    for t in range(tables):
        for f in range(functions):
            rng = np.random.default_rng((SEED, length, t, f))
            directions[t, f] = rng.normal(size=length + 1)
            shifts[t, f] = rng.uniform(0, WIDTH)
    return directions, shifts


def heights(points: np.ndarray, hashing: Hashing) -> np.ndarray:
    """(table, row, function): where a point's projections lie, in steps."""
    directions, shifts = projections(points.shape[1] - 1, hashing.tables, hashing.functions)
    return (np.einsum("tfd,nd->tnf", directions, points) + shifts[:, None, :]) / WIDTH


def bucket_ids(steps: np.ndarray, table: int, kind: Kind) -> np.ndarray:
    """One number per row of whole steps (row, function), the kind and the table."""
    mix = np.full(len(steps), (table + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for column in [np.full(len(steps), kind.length), np.full(len(steps), kind.order), *steps.T]:
        mix = (mix ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        mix ^= mix >> np.uint64(29)
    return mix.view(np.int64)


def visiting_order(place: np.ndarray, probes: int) -> np.ndarray:
    """(row, probe, function): the buckets of one table by estimated success, likeliest first.

    ``place`` (row, function) are projections in steps. The measure of a bucket is a sum over the functions, so the
    best few of all functions are among the best few of all but the last, each with every step of the last.
    """
    rows, functions = place.shape
    reach = int(np.ceil(8 / WIDTH))
    moves = np.arange(-reach, reach + 1)
    steps = np.zeros((rows, 1, 0), np.int64)
    measure = np.zeros((rows, 1))
    for f in range(functions):
        own = np.floor(place[:, f]).astype(np.int64)
        lower = own[:, None] + moves
        gap = np.maximum(0.0, np.maximum(lower - place[:, f, None], place[:, f, None] - lower - 1)) ** 2
        total = (measure[:, :, None] + gap[:, None, :]).reshape(rows, -1)
        best = np.argsort(total, axis=1, kind="stable")[:, :probes]
        measure = np.take_along_axis(total, best, axis=1)
        before, last = np.divmod(best, len(moves))
        kept = np.take_along_axis(steps, before[:, :, None], axis=1)
        steps = np.concatenate([kept, np.take_along_axis(lower, last, axis=1)[:, :, None]], axis=2)
    return steps


def valid_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    picked = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return picked.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0.0)
    )


def vector_print() -> list:
    return [F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(SEED), F.col("vector")).alias("b")]


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """One row per different vector: its print ``a``, ``b``, ``vector`` and its ``k`` + 1 smallest ids."""
    order = Window.partitionBy("a", "b", "vector").orderBy("id")
    numbered = vectors.select("id", "vector", *vector_print()).withColumn("place", F.dense_rank().over(order))
    few = numbered.where(F.col("place") <= k + 1).groupBy("a", "b", "vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return stored(few, "vectors")


def vector_kinds(vectors: DataFrame) -> list[Kind]:
    """The kinds of all vectors; a row per length and power of two, of which there are few."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], float] = {}
        for batch in batches:
            for _, x in by_length(batch, "vector"):
                for order, norm in zip(orders(x).tolist(), norms(x).tolist()):
                    key = (x.shape[1], order)
                    found[key] = max(found.get(key, 0.0), norm)
        rows = [(*key, norm) for key, norm in found.items()]
        columns = zip(*rows) if rows else ([], [], [])
        types = (pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["length", "kind", "norm"])

    per_task = vectors.select("vector").mapInArrow(largest, "length long, kind long, norm double")
    rows = per_task.groupBy("length", "kind").agg(F.max("norm").alias("norm")).orderBy("length", "kind").collect()
    return [Kind(*r) for r in rows]


def best_pairs(queries: np.ndarray, vectors: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``keep`` vectors of largest inner product, largest first: their places and inner products.

    The inner products returned are summed component by component, so they do not depend on the other rows.
    """
    rough = queries @ vectors.T
    keep = min(keep, vectors.shape[0])
    # A margin for the order of addition.
    wide = min(keep + 4, vectors.shape[0])
    places = np.argpartition(-rough, wide - 1, axis=1)[:, :wide]
    scores = np.zeros(places.shape)
    for d in range(queries.shape[1]):
        scores += queries[:, d, None] * vectors[:, d][places]
    order = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(places, order, axis=1), np.take_along_axis(scores, order, axis=1)


def true_neighbours(queries: DataFrame, vectors: DataFrame, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A bounded sample of queries, all of one length, and their true nearest vectors, by one pass over all vectors."""
    first = queries.orderBy("a", "b").limit(1).select(F.size("vector").alias("n")).first()
    if first is None:
        return np.zeros((0, 0)), []
    picked = queries.where(F.size("vector") == first["n"]).orderBy("a", "b").limit(SAMPLE_QUERIES).collect()
    sample = np.array([r["vector"] for r in picked], "float64")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_scores = np.zeros((len(sample), 0))
        held = np.zeros((len(sample), 0, sample.shape[1]))
        for batch in batches:
            for _, x in by_length(batch, "vector"):
                if x.shape[1] != sample.shape[1]:
                    continue
                places, scores = best_pairs(sample, x, k + 1)
                held_scores = np.hstack([held_scores, scores])
                held = np.concatenate([held, x[places]], axis=1)
                best = np.argsort(-held_scores, axis=1, kind="stable")[:, : k + 1]
                held_scores = np.take_along_axis(held_scores, best, axis=1)
                held = np.take_along_axis(held, best[:, :, None], axis=1)
        rows = [(q, s, v.tolist()) for q in range(len(sample)) for s, v in zip(held_scores[q].tolist(), held[q])]
        columns = zip(*rows) if rows else ([], [], [])
        types = (pa.int64(), pa.float64(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["query", "score", "near"])

    found = vectors.select("vector").mapInArrow(nearest, "query long, score double, near array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    rows = found.withColumn("rank", rank).where(F.col("rank") <= k + 1).orderBy("query", "rank").collect()
    # The first is the query itself, or as near as that.
    near = [[r["near"] for r in rows if r["query"] == q][1:] for q in range(len(sample))]
    return sample, [np.array(n, "float64").reshape(-1, sample.shape[1]) for n in near]


def probes_needed(sample: np.ndarray, near: list[np.ndarray], hashing: Hashing) -> int | None:
    """Buckets per table that the sampled queries have to visit for ``RECALL`` of their neighbours; None beyond the most."""
    kinds = {(k.length, k.order): k for k in hashing.kinds}
    needed = []
    for query, found in zip(sample, near):
        if not len(found):
            continue
        place = heights(on_sphere(query[None, :], norms(query[None, :])[0]), hashing)[:, 0, :]
        points = np.vstack(
            [on_sphere(v[None, :], kinds[len(v), o].norm) for v, o in zip(found, orders(found).tolist())]
        )
        steps = np.floor(heights(points, hashing)).astype(np.int64)
        earliest = np.full(len(found), MOST_PROBES)
        for t in range(hashing.tables):
            order = visiting_order(place[t : t + 1], MOST_PROBES)[0]
            visited = {bucket.tobytes(): i for i, bucket in reversed(list(enumerate(order)))}
            earliest = np.minimum(earliest, [visited.get(s.tobytes(), MOST_PROBES) for s in steps[t]])
        needed.extend(earliest.tolist())
    if not needed:
        return 1
    most = int(np.quantile(needed, RECALL, method="higher"))
    return most + 1 if most < MOST_PROBES else None


def fit(vectors: DataFrame, queries: DataFrame, k: int) -> Hashing:
    """Functions and probes, from counts over all vectors and the documented sample."""
    kinds = vector_kinds(vectors)
    rows = vectors.count()
    hashing = Hashing(kinds, TABLES, 0, 1)
    if rows <= BUCKET_ROWS:
        return hashing._replace(tables=1)
    sample, near = true_neighbours(queries, vectors, k)
    points = vectors.orderBy("a", "b").limit(SAMPLE_ROWS).select("vector").collect()
    of_length: dict[int, list] = {}
    for r in points:
        of_length.setdefault(len(r["vector"]), []).append(r["vector"])
    by_kind = {(kind.length, kind.order): kind for kind in kinds}
    cut = []
    for n, held in of_length.items():
        x = np.array(held, "float64")
        sphere = np.vstack([on_sphere(v[None, :], by_kind[n, o].norm) for v, o in zip(x, orders(x).tolist())])
        finest = int(np.ceil(np.log2(rows / BUCKET_ROWS)))
        cut.append(np.floor(heights(sphere, hashing._replace(functions=finest))).astype(np.int64)[0])
    functions = 0
    while functions < finest:
        shares = [np.unique(c[:, :functions], axis=0, return_counts=True)[1] for c in cut]
        if rows * sum((s**2).sum() for s in shares) / len(points) ** 2 <= BUCKET_ROWS:
            break
        functions += 1
    while functions:
        found = hashing._replace(functions=functions)
        probes = probes_needed(sample, near, found)
        if probes is not None:
            return found._replace(probes=probes)
        functions -= 1
    return hashing._replace(tables=1)


def placed_vectors(vectors: DataFrame, hashing: Hashing) -> DataFrame:
    """Every vector once per table, with its ``bucket``."""
    kinds = {(k.length, k.order): k for k in hashing.kinds}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in by_length(batch, "vector"):
                order = orders(x)
                for o in np.unique(order):
                    chosen = order == o
                    kind = kinds[x.shape[1], int(o)]
                    steps = np.floor(heights(on_sphere(x[chosen], kind.norm), hashing)).astype(np.int64)
                    own = part.filter(pa.array(chosen))
                    for t in range(hashing.tables):
                        buckets = pa.array(bucket_ids(steps[t], t, kind))
                        yield pa.RecordBatch.from_arrays([buckets, *own.columns], ["bucket", *own.schema.names])

    return vectors.mapInArrow(place, "bucket long, a long, b long, vector array<double>, ids array<bigint>")


def probed_buckets(queries: DataFrame, hashing: Hashing) -> DataFrame:
    """Every query once per table and bucket it visits, whether there is anything in it or not."""
    rows_at_once = max(1, (1 << 18) // hashing.probes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in by_length(batch, "vector"):
                for start in range(0, len(x), rows_at_once):
                    own = part.slice(start, rows_at_once)
                    q = x[start : start + rows_at_once]
                    # The length of a query changes no order among its neighbours.
                    place = heights(on_sphere(q, 1.0 * norms(q)[:, None]), hashing)
                    for t in range(hashing.tables):
                        steps = visiting_order(place[t], hashing.probes)
                        for kind in hashing.kinds:
                            if kind.length != x.shape[1]:
                                continue
                            buckets = bucket_ids(steps.reshape(len(q) * steps.shape[1], hashing.functions), t, kind)
                            rows = pa.array(np.repeat(np.arange(len(q)), steps.shape[1]))
                            columns = [own.column(c).take(rows) for c in ("a", "b")]
                            yield pa.RecordBatch.from_arrays([pa.array(buckets), *columns], ["bucket", "a", "b"])

    return queries.mapInArrow(probe, "bucket long, a long, b long")


def in_tiles(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Per query and tile of a bucket it visits: the best ``k`` + 1 different vectors as ``scores`` and ``ids``.

    Large buckets, and buckets with many visitors, are several tiles, so no group has more than a bounded number of
    rows. Both sides have ``bucket``, ``a``, ``b``, ``vector``.
    """
    sizes = vectors.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_vectors"))
    visits = queries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_queries"))
    counted = stored(sizes.join(visits, "bucket"), "bucket-sizes")
    parts = F.ceil(F.col("n_vectors") / TILE_ROWS).cast("int")
    rounds = F.ceil(F.col("n_queries") / TILE_QUERIES).cast("int")
    counted = sized(counted.select("bucket", parts.alias("parts"), rounds.alias("rounds")))
    spread = F.xxhash64("a", "b")
    left = vectors.join(counted, "bucket").select(
        "bucket",
        F.pmod(spread, F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round"),
        "vector",
        "ids",
    )
    right = queries.join(counted, "bucket").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(spread, F.col("rounds")).cast("int").alias("round"),
        "a",
        "b",
        "vector",
    )

    def compare(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        x = matrix(vectors.column("vector").combine_chunks()) if len(vectors) else np.zeros((0, 0))
        q = matrix(queries.column("vector").combine_chunks()) if len(queries) else np.zeros((0, 0))
        if not len(x) or not len(q):
            places, scores = np.zeros((0, 0), np.int64), np.zeros((0, 0))
            queries = queries.slice(0, 0)
        else:
            places, scores = best_pairs(q, x, k + 1)
        ids = vectors.column("ids").combine_chunks()
        flat = ids.take(pa.array(places.ravel()))
        # The ids of one vector share its score.
        counts = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts.reshape(places.shape).sum(axis=1))]).astype(np.int32)
        both = [pa.array(np.repeat(scores.ravel(), counts)), flat.flatten()]
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), c) for c in both]
        return pa.table([queries.column("a"), queries.column("b"), *lists], ["a", "b", "scores", "ids"])

    keys = ("bucket", "part", "round")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, f"a long, b long, {PAIRS}")


def merged(lists: DataFrame, k: int) -> DataFrame:
    """Per query ``a``, ``b`` the best ``k`` + 1 different ids of its lists, best first, ties to the smaller id."""

    def best(scores: list[np.ndarray], ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        all_scores, all_ids = np.concatenate(scores), np.concatenate(ids)
        order = np.lexsort((all_ids, -all_scores))
        all_scores, all_ids = all_scores[order], all_ids[order]
        first = np.sort(np.unique(all_ids, return_index=True)[1])[: k + 1]
        return all_scores[first], all_ids[first]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, scores, ids = None, [], []
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "scores", "ids")]
            for a, b, s, i in zip(*columns):
                if key != (a, b):
                    if key is not None:
                        done.append((*key, *best(scores, ids)))
                    key, scores, ids = (a, b), [], []
                scores.append(np.array(s, "float64"))
                ids.append(np.array(i, "int64"))
                if len(scores) >= 64:
                    scores, ids = ([x] for x in best(scores, ids))
            yield batch_of(done)
        if key is not None:
            yield batch_of([(*key, *best(scores, ids))])

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * 4
        types = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["a", "b", "scores", "ids"])

    return lists.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(merge, f"a long, b long, {PAIRS}")


def nearest_neighbours(
    rows: DataFrame,
    is_query,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    hashing: Hashing | None = None,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows found for every query.

    ``is_query`` is a condition on the column ``id``. Nearest is the largest inner product in double precision, ties
    to the smaller id; a row's own id is never its neighbour, and where there are fewer rows than ``k`` all are given.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
    Vectors meet only vectors of their own length. Equal vectors are searched once; each shows at most its ``k`` + 1
    smallest ids, which is as many as can count. Rows that share an id are that id's vectors: it is compared by the
    best of them. Other columns are not read, whatever their names.

    Without ``hashing`` it is fitted: one pass compares at most 64 queries with all vectors, and the number of probes
    is what they need for 0.97 of their neighbours. Queries that have found fewer than ``k`` rows, though there are
    more, are compared with all rows.
    """
    given = stored(valid_vectors(rows, id_column, vector_column), "given")
    vectors = distinct_vectors(given, k)
    asked = given.where(is_query).select("id", *vector_print(), "vector")
    queries = stored(asked.groupBy("a", "b").agg(F.first("vector").alias("vector")), "queries")
    hashing = hashing or fit(vectors, queries, k)
    visits = probed_buckets(queries, hashing).join(queries, ["a", "b"])
    found = stored(merged(in_tiles(placed_vectors(vectors, hashing), visits, k), k), "found")
    found = whole_lists(found, vectors, queries, k)
    listed = F.arrays_zip("scores", "ids")
    own = asked.select(F.col("id").alias("query_id"), "a", "b").join(found, ["a", "b"])
    others = own.select("query_id", F.explode(F.filter(listed, lambda p: p["ids"] != F.col("query_id"))).alias("p"))
    flat = others.groupBy("query_id", F.col("p.ids").alias("vec_id")).agg(F.max("p.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def whole_lists(found: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The lists found, and for queries with fewer than ``k`` + 1 ids in theirs those of a comparison with all vectors."""
    short = queries.join(found.where(F.size("ids") <= k).select("a", "b"), ["a", "b"], "left_semi").unionByName(
        queries.join(found.select("a", "b"), ["a", "b"], "left_anti")
    )
    short = stored(short, "short")
    if short.limit(1).count() == 0:
        return found
    everything = [t.withColumn("bucket", F.size("vector").cast("long")) for t in (vectors, short)]
    again = merged(in_tiles(*everything, k), k)
    return found.join(short.select("a", "b"), ["a", "b"], "left_anti").unionByName(again)
