"""Near duplicates by an inverted join of signature coordinates.

Every text becomes a set of hashed word shingles and a signature of ``COORDINATES`` minima, whose
(coordinate, value) pairs are posted as tokens. Texts with the same set are one class from then on.
Tokens of a single class are skipped. A pair of classes must agree in ``MATCHES`` coordinates, so it meets
in a list of the rarest ``COORDINATES - MATCHES + 1`` tokens of both: only these prefixes are merged, which
skips the long lists of common passages. Each list first links its members to a few hubs, in two rounds;
only pairs that are still in different components are looked at after that. A pair becomes a row only if its sketches pass,
so a large group of copies gives about as many rows as it has members. Every link is confirmed on the full
sets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.llm.common import MULTIPLIER, Powers, letter_values, mixed, sized, split_words, stored, text_slices

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
#: Fewer equal coordinates than this have a chance of 1.9e-7 at a similarity of 0.75.
MATCHES = 70
#: Bits of each coordinate in the sketch that travels with a post.
SKETCH_BITS = 8
#: Minima of which four bits each are kept for the last comparison; fewest equal first bits, and fewest equal minima, of
#: a link (chances 1.3e-7 and 1.5e-7 at a similarity of 0.75).
LONG_BITS = 1024
LONG_PLANES = 4
LONG_MATCHES = 839
LONG_EQUAL = 713
#: Neighbouring coordinates that a post of the last comparison holds: a link misses all of them with a chance of 1e-10.
BAND = 3
#: Seeds of the orders that pick the hubs of a list, per round. Lists of one group pick the same hubs.
HUB_ROUNDS = ((1, 2, 3, 4), (5, 6, 7, 8, 9, 10))

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; of the whole sequence if it is shorter, none if empty."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    count = len(words) - width + 1
    sums = np.full(count, width, np.uint64)
    for place in range(width):
        sums = sums * MULTIPLIER + words[place : place + count]
    return np.unique(mixed(sums))


def text_sets(texts: pa.Array, width: int, powers: Powers) -> Iterator[np.ndarray]:
    values = letter_values(fold=True)
    for first, end, data, offsets in text_slices(texts):
        words = split_words(data, offsets, _SPACE, values, powers)
        for i in range(end - first):
            yield shingle_hashes(words.hashes[words.bounds[i] : words.bounds[i + 1]], width)


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A token per coordinate: the coordinate and the least of its seeded shingle hashes."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(shingles), 8192):
        np.minimum(least, ((shingles[first : first + 8192] ^ seeds[:, None]) * MULTIPLIER).min(axis=1), out=least)
    return mixed(least ^ (seeds * MULTIPLIER))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The low bits of all tokens, bit by bit: 64 tokens to a number."""
    planes = [np.packbits((tokens >> np.uint64(bit) & np.uint64(1)).astype(np.uint8)) for bit in range(SKETCH_BITS)]
    return np.concatenate(planes).view(np.uint64)


def different(one: str, two: str, coordinates: int) -> Column:
    """In how many coordinates two sketches differ; at most as many as the signatures do."""
    words = coordinates // 64
    total = F.lit(0)
    for word in range(words):
        bits = [F.get(one, F.lit(b * words + word)).bitwiseXOR(F.get(two, F.lit(b * words + word))) for b in range(SKETCH_BITS)]
        total = total + F.bit_count(reduce(Column.bitwiseOR, bits))
    return total


def signatures(docs: DataFrame, width: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """``doc_id``, ``n_shingles``, 128 bits for the set (``set_a``, ``set_b``), ``tokens`` and ``sketch`` of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        seeds = mixed(np.arange(1, coordinates + 1, dtype=np.uint64))
        for batch in batches:
            sizes, first, second, tokens, sketches = [], [], [], [], []
            for shingles in text_sets(batch.column(1), width, powers):
                sizes.append(len(shingles))
                first.append(mixed(shingles ^ np.uint64(1)).sum(dtype=np.uint64))
                second.append(mixed(shingles ^ np.uint64(2)).sum(dtype=np.uint64))
                tokens.append(signature(shingles, seeds) if len(shingles) else np.zeros(0, np.uint64))
                sketches.append(sketch(tokens[-1]).astype(np.int64))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(first, np.uint64).astype(np.int64)),
                    pa.array(np.array(second, np.uint64).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int64))),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "tokens", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rows, "doc_id long, n_shingles long, set_a long, set_b long, tokens array<long>, sketch array<long>"
    )


def full_sets(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the whole ``shingles`` of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            sets = list(text_sets(batch.column(1), width, powers))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int64)))],
                names=["doc_id", "shingles"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rows, "doc_id long, shingles array<long>"
    )


def long_sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id`` and ``bits``: ``LONG_PLANES`` bits of each of ``LONG_BITS`` minima, plane by plane, of every row that
    has shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        seeds = mixed(np.arange(1001, 1001 + LONG_BITS, dtype=np.uint64))
        for batch in batches:
            bits = []
            for shingles in text_sets(batch.column(1), width, powers):
                if len(shingles):
                    minima = signature(shingles, seeds)
                    planes = [(minima >> np.uint64(p) & np.uint64(1)).astype(np.uint8) for p in range(LONG_PLANES)]
                    bits.append(np.packbits(np.concatenate(planes)).view(np.int64))
                else:
                    bits.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, pa.list_(pa.int64()))], names=["doc_id", "bits"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(rows, "doc_id long, bits array<long>").where("bits IS NOT NULL")


def band_posts(classes: DataFrame, coordinates: int) -> DataFrame:
    """``id``, ``token`` for every group of ``BAND`` neighbouring coordinates, and the ``earlier`` ones of the same id."""
    groups = [
        F.xxhash64(F.lit(first), *[F.get("tokens", F.lit(first + k)) for k in range(BAND)])
        for first in range(0, coordinates, BAND)
    ]
    each = classes.select(F.col("doc_id").alias("id"), F.array(*groups).alias("bands")).distinct()
    placed = each.select("id", "bands", F.posexplode("bands").alias("place", "token"))
    return placed.select("id", "token", F.slice("bands", F.lit(1), F.col("place")).alias("earlier"))


def prefix_posts(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """``token``, ``id`` for the rarest tokens of each class, without those that only one class has.

    A class with fewer than ``matches`` shared tokens has no partner and is left out.
    """
    posts = classes.select(F.col("doc_id").alias("id"), F.explode("tokens").alias("token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        posts.join(shared, "token")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("list"))
        .where(F.size("list") >= matches)
    )
    own = F.slice("list", 1, F.size("list") - (matches - 1))
    return ranked.select("id", F.explode(F.transform(own, lambda x: x["token"])).alias("token"))


def agreeing(
    posts: DataFrame,
    others: DataFrame,
    classes: DataFrame,
    open_pair: Column,
    coordinates: int,
    matches: int,
    percent: int,
) -> DataFrame:
    """Pairs (``a``, ``b``) of a post and one of the ``others`` with its token, of like size and with like sketches.

    The test is part of the join, so only pairs that can be links become rows.
    """
    traits = classes.select("doc_id", "n_shingles", "sketch")
    one = others.join(traits.toDF("a", "size_a", "sketch_a"), "a")
    two = posts.join(traits.toDF("b", "size_b", "sketch_b"), "b")
    like = (F.col("size_a") * 100 >= F.col("size_b") * percent) & (F.col("size_b") * 100 >= F.col("size_a") * percent)
    near = different("sketch_a", "sketch_b", coordinates) <= coordinates - matches
    met = one.join(two, (one["token"] == two["token"]) & open_pair & like & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def agreeing_closely(
    open_posts: DataFrame, docs: DataFrame, classes: DataFrame, coordinates: int, width: int, percent: int
) -> DataFrame:
    """Pairs (``a``, ``b``) of classes in open lists whose components differ, of like size and with like long sketches.

    A pair becomes a row only in the first list that both are in, and only if its sketches pass.
    """
    nodes = open_posts.select("id", "component").distinct()
    some = docs.join(sized(nodes.select(F.col("id").alias("open_id"))), F.col("doc_id") == F.col("open_id"), "left_semi")
    bits = stored(long_sketches(some, width), "near-long")
    found = classes.join(nodes, F.col("doc_id") == F.col("id"))
    traits = found.select("id", "component", "n_shingles").join(bits, F.col("id") == F.col("doc_id")).drop("doc_id")
    posts = band_posts(found.drop("id"), coordinates).join(traits, "id")
    one = posts.toDF("a", "token", "earlier_a", "x", "size_a", "bits_a")
    two = posts.toDF("b", "token", "earlier_b", "y", "size_b", "bits_b")
    like = (F.col("size_a") * 100 >= F.col("size_b") * percent) & (F.col("size_b") * 100 >= F.col("size_a") * percent)
    words = LONG_BITS // 64
    gap = lambda w: F.get("bits_a", w).bitwiseXOR(F.get("bits_b", w))
    unequal = sum((F.bit_count(gap(F.lit(w))) for w in range(words)), F.lit(0))
    close = unequal <= LONG_BITS - LONG_MATCHES
    any_plane = lambda w: reduce(Column.bitwiseOR, [gap(w + p * words) for p in range(LONG_PLANES)])
    places = F.sequence(F.lit(0), F.lit(words - 1))
    closer = F.aggregate(places, F.lit(0), lambda n, w: n + F.bit_count(any_plane(w))) <= LONG_BITS - LONG_EQUAL
    first = ~F.exists(F.zip_with("earlier_a", "earlier_b", lambda p, q: p == q), lambda same: same)
    met = one.join(two, (one["token"] == two["token"]) & (F.col("x") < F.col("y")) & like & close & closer & first)
    return met.select("a", "b")


def hubs_of(placed: DataFrame, seeds: Sequence[int]) -> DataFrame:
    """``token``, hub ``a`` and its component ``x``: for each seed the first member of the list in its order."""
    member = F.struct("id", "component")
    firsts = [F.min_by(member, F.xxhash64(F.lit(seed), "id")) for seed in seeds]
    hubs = placed.groupBy("token").agg(F.count("*").alias("n"), F.array_distinct(F.array(*firsts)).alias("hubs"))
    each = hubs.where("n > 1").select("token", F.explode("hubs").alias("hub"))
    return each.select("token", F.col("hub.id").alias("a"), F.col("hub.component").alias("x"))


def open_lists(posts: DataFrame, found: DataFrame) -> DataFrame:
    """The posts of lists with more than one component, with their ``component``."""
    placed = stored(labelled(posts, found, "id"), "near-placed")
    several = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return stored(placed.join(several.select("token"), "token"), "near-open")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    ends = [pairs.select(F.col(end).alias("wanted")).distinct() for end in ("a", "b")]
    wanted = ends[0].unionByName(ends[1]).distinct()
    some = docs.join(sized(wanted), F.col("doc_id") == F.col("wanted"), "left_semi")
    sets = stored(full_sets(some, width), "near-sets")
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(one, "a").join(two, "b").where(common * 100 >= union * percent).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and the smallest reachable ``component`` for every end of a link, by alternating stars.

    Each turn hangs all neighbours of a node under its smallest one, so the depth halves; the turns end
    when the links no longer change. Only the links of one turn are kept, as a stored table.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        last = state


def labelled(ids: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``ids`` with ``component``: that of ``column``, or the id itself without links."""
    names = found.select(F.col("id").alias("__near_id"), "component")
    joined = ids.join(names, F.col(column) == F.col("__near_id"), "left").drop("__near_id")
    return joined.withColumn("component", F.coalesce("component", column))


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets. A null, empty or
    blank text has no shingles and is linked with nothing. Rows of one id are one node, linked through
    any of their texts. A row without an id has no component and is kept. Extra columns are left out, whatever
    their names; an empty table gives no rows. Very long texts count whole, in slices of a few MB at a time.

    A link at exactly the similarity is lost with a chance of 4.7e-7, all stages together; closer ones with less.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(signatures(docs, width, coordinates), "near-signatures")
    named = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["n_shingles", "set_a", "set_b"]
    classes = stored(
        named.groupBy(key)
        .agg(F.min_by(F.struct("tokens", "sketch"), "doc_id").alias("s"), F.min("doc_id").alias("doc_id"))
        .select(*key, "doc_id", "s.*"),
        "near-classes",
    )
    posts = stored(prefix_posts(classes, coordinates, matches), "near-posts")

    tested = {"classes": classes, "coordinates": coordinates, "matches": matches, "percent": percent}
    placed, links = posts.withColumn("component", F.col("id")), None
    for seeds in HUB_ROUNDS:
        members = placed.select("token", F.col("id").alias("b"), F.col("component").alias("y"))
        pairs = stored(agreeing(members, hubs_of(placed, seeds), open_pair=F.col("x") != F.col("y"), **tested), "near-pairs")
        fresh = stored(confirmed(pairs, docs, width, percent), "near-links")
        links = fresh if links is None else links.unionByName(fresh)
        placed = open_lists(posts, components(links))
    across = stored(agreeing_closely(placed, docs, classes, coordinates, width, percent), "near-pairs")
    found = components(links.unionByName(confirmed(across, docs, width, percent)))
    by_class = labelled(classes.select(*key, F.col("doc_id").alias("least")), found, "least").select(*key, "component")
    joined = rows.drop("tokens", "sketch").join(by_class, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    judged = joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
    return stored(judged, "near-judged")
