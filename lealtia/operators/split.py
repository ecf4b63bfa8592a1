"""Stratified train/test split with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lealtia.operators.anchor import ID

# Share of the test set and seed.
TEST_SHARE = 0.25
SEED = 42
MAX_CLASSES = 10_000


def shuffle_key(key: str = ID, seed: int = SEED) -> Column:
    """Text that puts the rows in an order unrelated to their ids."""
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def quotas(counts: DataFrame, label: str, share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class: ``ceil(share * n)`` in all, shared out by largest remainder on the training side.

    ``counts`` has one row per class.
    """
    everyone = W.partitionBy()
    rows = F.sum("n").over(everyone)
    train = rows - F.ceil(rows * share)
    exact = F.col("n") * train / rows
    shared = counts.select(label, "n", train.alias("train"), exact.alias("exact"))
    remainder = F.col("exact") - F.floor("exact")
    missing = F.col("train") - F.sum(F.floor("exact")).over(everyone)
    place = F.row_number().over(W.orderBy(remainder.desc(), label))
    quota = F.floor("exact") + F.when(F.col("place") <= F.col("missing"), 1).otherwise(0)
    placed = shared.select(label, "n", "exact", missing.alias("missing"), place.alias("place"))
    return placed.select(label, "n", (F.col("n") - quota).cast("long").alias("test_n"))


def stratified_split(
    df: DataFrame, label: str, key: str = ID, share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``: per class exactly its quota of rows, the first in shuffled order.

    ``df`` is read three times, so it should be a stored table. No class is ever sorted. Rows are counted by class and the first digits of their shuffle key,
    which tells in which of the 4,096 slices the last test row of a class lies; only that slice is put
    in order. Its row then serves as the class's limit, looked up by every row where it is.
    """
    keyed = df.select(F.col(label).alias("c"), shuffle_key(key, seed).alias("k"), F.col(key).alias("i"))
    digits = F.substring("k", 1, 3)
    per_slice = keyed.groupBy("c", digits.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    # From here on a few rows per class: at most one per slice.
    earlier = W.partitionBy("c").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    with_before = per_slice.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    quota = quotas(per_slice.groupBy("c").agg(F.sum("n").alias("n")), "c", share)
    limit = with_before.join(quota.select("c", "test_n"), "c").where(
        (F.col("before") < F.col("test_n")) & (F.col("test_n") <= F.col("before") + F.col("n"))
    )
    last_slices = limit.select(F.struct("c", "s").alias("e"), (F.col("test_n") - F.col("before")).alias("wanted"))
    wanted = last_slices.agg(F.map_from_entries(F.collect_list(F.struct("e", "wanted"))).alias("m"))
    in_last = keyed.withColumn("wanted", F.try_element_at(guarded(wanted), F.struct("c", digits.alias("s"))))
    place = F.row_number().over(W.partitionBy("c").orderBy("k", "i"))
    limits = in_last.where(F.col("wanted").isNotNull()).withColumn("place", place)
    lookup = limits.where(F.col("place") == F.col("wanted")).agg(
        F.map_from_entries(F.collect_list(F.struct("c", F.struct("k", "i")))).alias("m")
    )
    at_most = F.try_element_at(guarded(lookup), F.col(label))
    mine = F.struct(shuffle_key(key, seed).alias("k"), F.col(key).alias("i"))
    return df.withColumn("is_test", F.coalesce(mine <= at_most, F.lit(False)))


def guarded(lookup: DataFrame) -> Column:
    """One-row lookup as a value, which must stay small: one entry per class."""
    value = lookup.select(
        F.when(F.size("m") <= MAX_CLASSES, F.col("m")).otherwise(
            F.raise_error(F.lit(f"more than {MAX_CLASSES} classes"))
        )
    )
    return value.scalar()


def split_sizes(split: DataFrame, label: str) -> DataFrame:
    """Training and test rows per class."""
    return split.groupBy(label).agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows")
    )
