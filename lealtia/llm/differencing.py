"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group, and a group stays together. Groups above a set share of all bytes are
items of their own; all others are dealt by hash into a fixed number of packets, which are items too. So
the differencing has a bounded number of items at every size, and the many small groups only move along
with their packet.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lealtia.llm.common import stored, text_print

SHARDS = 16
#: A group with at least this part of all bytes is an item; there are at most as many of them.
LARGE_PARTS = 65_536
PACKETS = 4_096
#: Slots are numbered per shard and hash lane first, then shifted by the lanes' counts.
LANES = 1_024


def difference(items: Iterable[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each (size, name): the two partial partitions of largest spread are joined, oppositely ordered.

    Ties are broken by the order of the items. The largest shard is number 0.
    """
    heap: list[tuple[int, int, list[int], list]] = []
    for order, (size, name) in enumerate(items):
        heap.append((-size, order, [size] + [0] * (shards - 1), [name] + [None] * (shards - 1)))
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other_sums, other_members = heapq.heappop(heap)
        joined = [
            (a + b, x if y is None else y if x is None else (x, y))
            for a, b, x, y in zip(sums, reversed(other_sums), members, reversed(other_members))
        ]
        joined.sort(key=lambda pair: -pair[0])
        sums = [s for s, _ in joined]
        heapq.heappush(heap, (sums[-1] - sums[0], order, sums, [m for _, m in joined]))
        order += 1
    placed: dict[int, int] = {}
    for shard, member in enumerate(heap[0][3] if heap else []):
        stack = [] if member is None else [member]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            else:
                placed[node] = shard
    return placed


def balanced_shards(
    docs: DataFrame, shards: int = SHARDS, packets: int = PACKETS, large_parts: int = LARGE_PARTS
) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot`` (gapless per shard) of every row.

    A null text counts as empty, so all nulls and empty texts are one group. Null ids are kept; repeated
    rows each have their slot. Slots follow a hash of the id, then the id. Extra columns are left out;
    an empty table gives no rows. A group larger than an even shard makes that shard larger.
    """
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(whole) + F.lit(1)).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            *text_print(whole),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("text_a", "text_b").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * large_parts >= total
    singles = groups.where(large).orderBy("text_a", "text_b").collect()
    packet = F.pmod("text_b", F.lit(packets))
    rest = groups.where(~large).groupBy(packet.alias("packet")).agg(F.sum("bytes").alias("bytes")).collect()
    items = [(r["bytes"], i) for i, r in enumerate(singles)]
    items += [(r["bytes"], len(singles) + r["packet"]) for r in sorted(rest, key=lambda r: r["packet"])]
    placed = difference(items, shards)

    spark = docs.sparkSession
    single_shards = spark.createDataFrame(
        [(r["text_a"], r["text_b"], placed[i]) for i, r in enumerate(singles)], "text_a long, text_b long, own int"
    )
    packet_shards = spark.createDataFrame(
        [(name - len(singles), shard) for name, shard in placed.items() if name >= len(singles)],
        "packet long, common int",
    )
    sharded = (
        rows.withColumn("packet", packet)
        .join(F.broadcast(single_shards), ["text_a", "text_b"], "left")
        .join(F.broadcast(packet_shards), "packet", "left")
        .withColumn("shard", F.coalesce("own", "common"))
        .withColumn("lane", F.pmod(F.xxhash64("doc_id", "text_a"), F.lit(LANES)))
    )
    counts = sharded.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_a", "text_b")
    return (
        sharded.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(bases), ["shard", "lane"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot"))
    )
