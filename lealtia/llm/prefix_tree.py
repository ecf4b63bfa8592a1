"""Tree of conversation prefixes, rolled up in depth bands.

Every node carries the names of its ancestors inside its band of fixed height, so a subtree sum is one grouping of
nodes exploded to those ancestors. What hangs below a band is summed over the tree of band roots first, which is
rolled up the same way, in bands of bands: the number of groupings grows with the logarithm of the depth, and no
node is exploded to more than a band.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lealtia.llm.common import stored

#: Depths in a band. A node is exploded to at most so many ancestors.
BAND = 16
#: Ids of one node's ends are joined into texts of about so many characters before they meet in one task.
END_CHARACTERS = 1 << 16
# Conversations in a family that share their first turns, and the number of lengths shared.
FAMILY, HEADS = 100, 6

ROOT = hashlib.blake2b(digest_size=16).digest()
VISITS = (
    "node binary, parent binary, depth long, conv_id long, ends long, chars long,"
    " bands array<array<binary>>, above array<array<binary>>"
)


def turn_print(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that stand for a turn."""
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(told.cast("binary"), 256), 1, 32)


def rebuilt_turns(rows: DataFrame) -> DataFrame:
    """Turns in order of ``conv_id``, ``place``; place 0 carries the borrowed first turns as ``heads``."""
    plain = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    printed = plain.select(
        "conv_id", "turn", "role", turn_print(F.col("role"), F.col("text")).alias("print"), F.char_length("text").cast("long").alias("chars")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "print")
    turns = stored(printed.select("conv_id", F.row_number().over(order).alias("place"), "print", "chars"), "turns")
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    lenders = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS))
    heads = lenders.groupBy(F.col("conv_id").alias("lender")).agg(
        F.array_sort(F.collect_list(F.struct("place", "print", "chars"))).alias("heads")
    )
    firsts = turns.where("place = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("lender"))
    starts = firsts.join(heads, "lender", "left").select(
        "conv_id",
        F.lit(0).alias("place"),
        F.lit("").alias("print"),
        F.lit(0).cast("long").alias("chars"),
        F.slice(F.coalesce("heads", F.array()), F.lit(1), borrowed).alias("heads"),
    )
    own = turns.where(F.col("place") > borrowed).withColumn("heads", F.lit(None).cast(starts.schema["heads"].dataType))
    return starts.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", "place")


class Trail:
    """The nodes on the way down one conversation, as far as later rows need them.

    ``bands[k]`` holds the nodes at depths that are multiples of ``band ** k``, from the last multiple of
    ``band ** (k + 1)`` on; ``above[k]`` is the band before it.
    """

    def __init__(self, band: int) -> None:
        self.band, self.depth, self.node, self.parent = band, 0, ROOT, None
        self.bands, self.above = [], []

    def levels(self) -> int:
        """How many times the band's height divides the depth of the present node, at least once."""
        if not self.depth:
            return max(1, len(self.bands))
        level, size = 1, self.band
        while self.depth % size == 0:
            level, size = level + 1, size * self.band
        return level

    def enter(self) -> tuple[list[list[bytes]], list[list[bytes]]]:
        """Enter the present node; its ancestors by level, itself last, and those in the band before if it opens one."""
        levels, opened = self.levels(), []
        while len(self.bands) < levels:
            # The root opens every level.
            self.bands.append([ROOT] if self.depth else [])
        for k in range(levels):
            if k + 1 < levels:
                opened.append(self.bands[k])
                self.bands[k] = []
            self.bands[k].append(self.node)
        return [list(b) for b in self.bands[:levels]], opened

    def step(self, print_: str) -> None:
        self.parent, self.depth = self.node, self.depth + 1
        self.node = hashlib.blake2b(self.node + bytes.fromhex(print_), digest_size=16).digest()


def visits(rows: DataFrame, band: int = BAND) -> DataFrame:
    """One row per rebuilt conversation and node on its way: ``node``, ``parent``, ``depth``, ``ends``, ``chars``
    (of the last text), and the ancestors by level: ``bands`` in its own band, ``above`` in the band before."""
    names = [c.split()[0] for c in VISITS.split(", ")]
    lists = pa.list_(pa.list_(pa.binary()))
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 4, lists, lists]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        open_row: list | None = None
        trail = Trail(band)

        def pending(conv_id: int, chars: int) -> list:
            bands, above = trail.enter()
            return [trail.node, trail.parent, trail.depth, conv_id, 0, chars, bands, above]

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "place", "print", "chars", "heads")]
            for conv_id, place, print_, chars, heads in zip(*columns):
                if place == 0:
                    if open_row:
                        open_row[4] = 1
                        out.append(open_row)
                    trail = Trail(band)
                    open_row = pending(conv_id, 0)
                    steps = [(h["print"], h["chars"]) for h in heads]
                else:
                    steps = [(print_, chars)]
                for print_, chars in steps:
                    out.append(open_row)
                    trail.step(print_)
                    open_row = pending(conv_id, chars)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names) if out else empty()
            out = []
        if open_row:
            open_row[4] = 1
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(open_row, types)], names)

    def empty() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names)

    return rebuilt_turns(rows).mapInArrow(walk, VISITS)


def ends_digests(visited: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ascending ids, comma-joined.

    The ids of one node are sorted across tasks, joined into long texts there, and only these meet in one task,
    which reads them one after the other.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def run() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"node": [node], "first": pa.array([first], pa.int64()), "ids": [",".join(ids)]},
                schema=pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]),
            )

        for batch in batches:
            for new, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (new != node or size >= END_CHARACTERS):
                    yield run()
                    ids, size = [], 0
                if not ids:
                    node, first = new, conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
        if ids:
            yield run()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for new, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if new == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = new, hashlib.sha256(ids.encode())
            yield batch_of(done)
        if node is not None:
            yield batch_of([(node, digest.hexdigest())])

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        nodes, texts = zip(*done) if done else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(texts, pa.string())], ["node", "ends_sha256"])

    ends = visited.where("ends = 1").select("node", "conv_id")
    joined = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        runs, "node binary, first long, ids string"
    )
    whole = joined.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return whole.mapInArrow(digests, "node binary, ends_sha256 string")


SUMS = ("n_leaves", "saved_tokens")


def summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("node").agg(*[F.sum(c).alias(c) for c in SUMS])


def subtree_sums(nodes: DataFrame, weights: DataFrame, level: int, levels: int) -> DataFrame:
    """Sums of ``weights`` over the subtree of every node at a depth that ``band ** level`` divides.

    ``weights`` has a row for every such node, ``bands`` and ``above`` included. The nodes that open a band of this
    level are those of the next one; their sums come from there and are brought to the band above them.
    """
    within = weights.select(F.explode(F.get("bands", F.lit(level))).alias("node"), *SUMS)
    if level + 1 == levels:
        return summed(within)
    inside = stored(summed(within), f"bands-{level}")
    roots = nodes.where(F.size("bands") > level + 1).select("node", "bands", "above")
    carried = roots.join(inside, "node")
    below = subtree_sums(nodes, carried, level + 1, levels).join(roots.select("node", "above"), "node")
    brought = below.where(F.size("above") > level).select(F.explode(F.get("above", F.lit(level))).alias("node"), *SUMS)
    return summed(inside.unionByName(brought))


def prefix_tree(rows: DataFrame, band: int = BAND) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. A conversation c is rebuilt from the first h turns of c - c % 100 and its
    own turns behind its first h, h being the crc32 of its decimal id modulo 6.

    A null role or text is empty; rows without a ``conv_id`` take no part; rows of one turn stand in order of role
    and then of a hash of role and text. Other columns are not read, whatever their names. Without conversations
    there are no rows. Prefixes are told apart by 128 bits.

    A conversation is read by one task as a stream; what is held of it are two bands of nodes per level.
    """
    visited = stored(visits(rows, band), "visits")
    firsts = [F.first(c).alias(c) for c in ("parent", "depth", "chars", "bands", "above")]
    grouped = visited.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends"), *firsts
    )
    nodes = stored(grouped, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, reach = 1, band
    while reach <= deepest:
        levels, reach = levels + 1, reach * band
    # The root's levels are only known once the deepest conversation is.
    root_bands = F.transform(F.sequence(F.lit(1), F.lit(levels)), lambda _: F.array(F.lit(ROOT)))
    nodes = nodes.withColumn("bands", F.when(F.col("depth") == 0, root_bands).otherwise(F.col("bands")))
    own = nodes.select(
        "bands",
        "above",
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    sums = subtree_sums(nodes, own, 0, levels)
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.select("node", "parent", "conv_id", "depth", "n_convs")
        .join(sums, "node")
        .join(children, "node", "left")
        .join(ends_digests(visited), "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )
