"""What several operators of this subpackage share: stored tables, text fingerprints, byte-level word splitting."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lealtia.session import fresh_path

#: A key set with at most so many rows is broadcast; larger ones meet by a shuffled join with the same result.
SMALL_ROWS = 1_000_000
#: Texts are handled in slices of about so many bytes, so that a task's arrays stay small.
SLICE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, without a shuffle.

    It cuts the lineage: a lost executor costs a task, not the work before it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(small: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``small`` marked for broadcast if counting shows at most ``limit`` rows, else as it is."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def text_print(text: Column) -> list[Column]:
    """128 bits that stand for a text (null counts as empty), as two long columns ``text_a``, ``text_b``."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("text_a"), F.xxhash64(F.lit(7), whole).alias("text_b")]


def ascii_lower(text: Column) -> Column:
    """``text`` with A to Z lower-cased and nothing else; plain ``lower`` where the text is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often a lambda in ``body`` reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_values(fold: bool) -> np.ndarray:
    """A pseudo-random number for each byte; with ``fold`` A to Z share those of a to z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
    if fold:
        values[65:91] = values[97:123]
    return values


class Powers:
    """Powers of a multiplier and of its inverse modulo 2^64, extended as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
            for name, base in (("up", MULTIPLIER), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


class Words(NamedTuple):
    """Words of a slice of texts: 64-bit hash, first and end byte, and per text the number of its first word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray, values: np.ndarray, powers: Powers) -> Words:
    """Maximal runs of bytes that are no ``delimiter`` (a flag per byte value), never across texts."""
    inside = ~delimiter[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    up, down = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:-1], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64, copy=False))
