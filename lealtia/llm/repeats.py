"""Long repeated byte strings, removed wherever they stand.

Every string of ``length`` bytes has one anchor: the least hash of the strings of ``gram`` bytes in it.
Neighbouring starts with the same anchor form a run, and equal strings have equal anchors, so only runs
whose anchor stands elsewhere too can hold repeats: one count of anchors leaves out most of the text. The
rest is refined in intervals: first whole runs are compared by a hash of all bytes they reach, then their
parts of ``BLOCKS[0]`` starts, then single starts. An interval that two places share is repeated as a whole
and leaves the refinement with one place as a witness. An interval goes on only if its core, the bytes
that all its strings have in common, is found at another interval too; else it is unique. Where an anchor
stands twice in one string, its places don't align: such runs are cut into single starts at once, each
with its whole string as its core, which nothing can refine further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.llm.common import SMALL_ROWS, Powers, letter_values, mixed, sized, stored, text_slices

LENGTH = 400
GRAM = 280
#: Starts per part in the second and third comparison.
BLOCKS = (16, 1)
#: Bytes of text hashed at a time: each takes some hundred bytes of arrays. Longer texts are a slice of their own.
SLICE = 1 << 20
#: The low bits of an anchor hold its position, so that the least anchor also tells where it is.
PLACE = np.uint64(511)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by minima from both ends of blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class ByteHashes:
    """Hashes of any stretch of a slice of texts from one running sum."""

    def __init__(self, powers: Powers, values: np.ndarray, data: np.ndarray) -> None:
        up, self.down = powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[:-1], out=self.sums[1:])

    def sliding(self, width: int) -> np.ndarray:
        """``of`` all stretches of ``width`` bytes, without arrays of places."""
        n = max(len(self.sums) - width, 0)
        return mixed((self.sums[len(self.sums) - n :] - self.sums[:n]) * self.down[:n] + np.uint64(width))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def text_runs(anchors: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Of one text: per run the anchor, the first start, the number of starts, the anchor's place, and whether it is twice there."""
    place = np.arange(len(anchors), dtype=np.uint64) & PLACE
    early = sliding_least(anchors & ~PLACE | place, width)
    late = sliding_least(anchors & ~PLACE | (PLACE - place), width)
    twice = early & PLACE != PLACE - (late & PLACE)
    first = np.concatenate([[0], np.flatnonzero(early[1:] != early[:-1]) + 1])
    count = np.diff(np.concatenate([first, [len(early)]]))
    at = first + ((early[first] & PLACE).astype(np.int64) - first) % (int(PLACE) + 1)
    return early[first] & ~PLACE, first, count, at, np.logical_or.reduceat(twice, first)


def anchor_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``id``, ``print`` and the ``runs`` of every text of at least ``length`` bytes."""
    kind = pa.struct(
        [("anchor", pa.int64()), ("span", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("at", pa.int32()), ("loose", pa.bool_())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values = Powers(), letter_values(fold=False)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(2), SLICE):
                hashes = ByteHashes(powers, values, data)
                anchors = hashes.sliding(gram)
                parts: list[tuple[np.ndarray, ...]] = []
                counts = np.zeros(end - first, np.int64)
                for i in range(end - first):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    if b - a < length:
                        continue
                    anchor, lo, n, at, loose = text_runs(anchors[a : b - gram + 1], length - gram + 1)
                    span = hashes.of(a + lo, a + lo + n + length - 1)
                    parts.append((anchor, span, lo, n, at, loose))
                    counts[i] = len(lo)
                columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
                types = (np.int64, np.int64, np.int32, np.int32, np.int32, bool)
                flat = pa.StructArray.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, types)], fields=list(kind))
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first), pa.ListArray.from_arrays(bounds, flat)],
                    names=["id", "print", "runs"],
                )

    long_enough = docs.where(F.octet_length("text") >= length)
    return long_enough.select("id", "print", "text").mapInArrow(
        rows, "id long, print long, runs array<struct<anchor:long,span:long,lo:int,n:int,at:int,loose:boolean>>"
    )


def at_texts(docs: DataFrame, lists: DataFrame, size: str, how: str) -> DataFrame:
    """``docs`` with their row of ``lists``; that side is broadcast while its lists together are small."""
    small = lists.agg(F.sum(size)).first()[0] or 0
    side = lists.withColumnsRenamed({"id": "list_id", "print": "list_print"})
    side = F.broadcast(side) if small <= SMALL_ROWS else side
    met = F.col("id").eqNullSafe(F.col("list_id")) & (F.col("print") == F.col("list_print"))
    return docs.join(side, met, how).drop("list_id", "list_print")


def parts_of(docs: DataFrame, units: DataFrame, length: int, block: int) -> DataFrame:
    """The units cut into parts of ``block`` starts counted from their anchor, loose ones into single starts, with
    hashes of all bytes they reach."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values = Powers(), letter_values(fold=False)
        for batch in batches:
            units = batch.column(3)
            for first, end, data, offsets in text_slices(batch.column(2), SLICE):
                hashes = ByteHashes(powers, values, data)
                own = units.slice(first, end - first)
                flat, per_text = own.flatten(), np.diff(own.offsets.to_numpy())
                text = np.repeat(np.arange(end - first), per_text)
                lo, n, at = (flat.field(f).to_numpy().astype(np.int64) for f in ("lo", "n", "at"))
                loose = flat.field("loose").to_numpy(zero_copy_only=False)
                unit = np.repeat(np.arange(len(lo)), n)
                start = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n) + lo[unit]
                part = np.where(loose[unit], start, (start - at[unit]) // block)
                fresh = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (part[1:] != part[:-1])])) if len(unit) else np.zeros(0, np.int64)
                count = np.diff(np.concatenate([fresh, [len(unit)]]))
                unit, start, part = unit[fresh], start[fresh], part[fresh]
                base = offsets[text[unit]] + start
                span = hashes.of(base, base + count + length - 1)
                aligned = np.where(loose[unit], base, offsets[text[unit]] + at[unit] + part * block)
                core = hashes.of(aligned + block - 1, np.minimum(aligned + length, len(data)))
                core = np.where(loose[unit], span, mixed(core ^ part.astype(np.uint64)))
                where = pa.array(first + text[unit])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(where),
                        batch.column(1).take(where),
                        pa.array(core.astype(np.int64)),
                        pa.array(span.astype(np.int64)),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(at[unit].astype(np.int32)),
                        flat.field("open").take(pa.array(unit)),
                    ],
                    names=["id", "print", "core", "span", "lo", "n", "at", "open"],
                )

    unit = F.struct("lo", "n", "at", "loose", "open")
    lists = stored(units.groupBy("id", "print").agg(F.collect_list(unit).alias("units")), "repeat-units")
    found = at_texts(docs.select("id", "print", "text"), lists.withColumn("size", F.size("units")), "size", "inner")
    # A row given twice lists its units twice; they are witnesses then, never open, so the count stays right.
    return found.select("id", "print", "text", "units").mapInArrow(
        rows, "id long, print long, core long, span long, lo int, n int, at int, open boolean"
    ).withColumn("loose", F.lit(False))


def refined(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated intervals, units to compare in smaller parts) of units with their hash."""
    place = F.struct("id", "print", "lo", "at")
    classes = stored(
        units.groupBy("core", "n", "span").agg(
            F.count("*").alias("copies"), F.max("open").alias("open"), F.max("loose").alias("loose"), F.min(place).alias("place")
        ),
        "repeat-classes",
    )
    shared = classes.where("copies > 1 AND open").select("core", "n", "span")
    repeated = units.where("open").join(shared, ["core", "n", "span"]).select("id", "print", "lo", "n")
    alone = F.col("open") & (F.col("copies") == 1)
    groups = classes.groupBy("core").agg(
        F.count("*").alias("classes"), F.max(alone).alias("needs"), F.max("loose").alias("loose")
    )
    wanted = stored(groups.where("needs AND (classes > 1 OR loose)").select("core", "loose"), "repeat-cores")
    following = classes.drop("loose").join(sized(wanted), "core").select("n", "loose", alone.alias("open"), "place.*")
    return repeated, following


def repeated_intervals(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``id``, ``print``, ``lo`` and ``n``: runs of ``n`` starts whose strings also start elsewhere."""
    runs = stored(anchor_runs(docs, length, gram), "anchor-runs")
    anchors = runs.select(F.explode("runs").alias("r")).groupBy(F.col("r.anchor").alias("anchor")).agg(
        F.count("*").alias("copies"), F.max("r.loose").alias("loose")
    )
    shared = stored(anchors.where("copies > 1 OR loose").select("anchor"), "shared-anchors")
    side = F.broadcast(shared) if shared.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else shared
    units = runs.select("id", "print", F.explode("runs").alias("r")).select("id", "print", "r.*").join(side, "anchor", "left_semi")
    units = stored(units.withColumnRenamed("anchor", "core").withColumn("open", F.lit(True)), "anchor-units")
    found, following = refined(units)
    for block in BLOCKS:
        units = stored(parts_of(docs, following, length, block).where("n > 0"), "repeat-parts")
        more, following = refined(units)
        found = found.unionByName(more)
    return found


def merged_spans(intervals: DataFrame, length: int) -> DataFrame:
    """``id``, ``print`` and the ``spans`` (bytes, end exclusive) that the intervals cover, joined where they touch."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col("lo").alias("start"), (F.col("lo") + F.col("n") + length - 1).alias("end"))))
    last = lambda acc: F.element_at(acc, -1)

    def join(acc, x):
        longer = F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], x["end"]).alias("end"))
        touching = (F.size(acc) > 0) & (x["start"] <= last(acc)["end"])
        return F.when(touching, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return intervals.groupBy("id", "print").agg(pairs.alias("pairs")).select(
        "id", "print", F.aggregate("pairs", none, join).alias("spans")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, the removed ``spans`` and the ``kept`` bytes of every row.

    A null text is empty. Texts shorter than ``length`` lose nothing; every row counts, so a row given
    twice is repeated. Null ids stay null; extra columns are left out; an empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("print"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    spans = stored(merged_spans(repeated_intervals(texts, length, gram), length), "repeat-spans")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                cuts = batch.column(2).slice(first, end - first).to_pylist()
                kept, removed = [], []
                for i, spans_here in enumerate(cuts):
                    text = data[offsets[i] : offsets[i + 1]]
                    stay = np.ones(len(text), bool)
                    for cut in spans_here or ():
                        stay[cut["start"] : cut["end"]] = False
                    kept.append(text[stay].tobytes())
                    removed.append(int(len(text) - len(kept[-1])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(np.diff(offsets)),
                        pa.array(removed, pa.int64()),
                        pa.array([len(c or ()) for c in cuts], pa.int64()),
                        batch.column(2).slice(first, end - first),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    found = at_texts(texts, spans.withColumn("size", F.size("spans")), "size", "left")
    return found.select("id", "text", "spans").mapInArrow(
        rows,
        "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary",
    )
