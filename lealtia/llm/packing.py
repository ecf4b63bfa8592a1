"""Concatenate and cut: all documents form one stream of token ids, cut into windows of one length.

Pass one encodes every text once and stores the ids with the running count inside its task. Pass two sums
the tasks' totals, which gives every document its offset in the whole stream, and cuts at multiples of
the window length. No ids are shuffled and only one number per task is brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lealtia.llm.common import SLICE_BYTES, longs, sized, stored
from lealtia.llm.tokens import BYTE_VOCABULARY, encoder

WINDOW = 2048
#: Documents of one task are written in rows of about so many characters at a time.
BATCH_CHARACTERS = SLICE_BYTES


def character_batches(texts: list[str | None], limit: int = BATCH_CHARACTERS) -> Iterator[tuple[int, int]]:
    """First and end index of runs of texts with about ``limit`` characters."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def encoded(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: ``doc_id``, the task ``part``, ``local_start`` (ids before it in the task), ``n_tokens``, ``ids``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in character_batches(texts):
                ids = encoder(vocabulary).encode(texts[first:end])
                starts = []
                for coded in ids:
                    starts.append(seen)
                    seen += len(coded) // 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(c) // 4 for c in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"],
                )

    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(
        encode, "doc_id long, part int, local_start long, n_tokens long, ids binary"
    )


def part_bases(parts: DataFrame) -> DataFrame:
    """From the rows (part, n) of all tasks: ``part`` and the sum of n over the parts before it."""
    totals = parts.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def pack(
    docs: DataFrame,
    vocabulary: str = BYTE_VOCABULARY,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document: its place in its document and in its sequence, and its ids.

    A null or empty text is the end id alone. A null id stays null; repeated rows are documents of their
    own, and extra columns are left out. An empty table gives no rows. Only the last sequence can be
    shorter than ``window``; no document is cut more often than the windows ask for.
    """
    table = stored(encoded(docs, vocabulary, id_column, text_column), "packing-ids")
    bases = part_bases(table.select("part", F.col("n_tokens").alias("n")))
    placed = table.join(sized(bases), "part").withColumn("first", F.col("base") + F.col("local_start"))
    last = F.col("first") + F.col("n_tokens") - 1
    cut = placed.withColumn(
        "sequence_id",
        F.explode(F.sequence(F.floor(F.col("first") / window), F.floor(last / window))),
    )
    begin = F.greatest(F.col("sequence_id") * window, F.col("first"))
    end = F.least((F.col("sequence_id") + 1) * window, F.col("first") + F.col("n_tokens"))
    return cut.select(
        "doc_id",
        (begin - F.col("first")).alias("start"),
        (end - begin).alias("length"),
        F.col("n_tokens").alias("doc_tokens"),
        F.col("sequence_id").cast("long").alias("sequence_id"),
        (begin - F.col("sequence_id") * window).alias("offset"),
        F.substring("ids", (4 * (begin - F.col("first")) + 1).cast("int"), (4 * (end - begin)).cast("int")).alias("ids"),
    )


def boundaries(pieces: DataFrame) -> DataFrame:
    """The boundary records of the packed sequences: where each piece lies, without its ids."""
    return pieces.select("sequence_id", "offset", "length", "doc_id", "start", "doc_tokens")


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences: the ids of their pieces in order. A sequence has at most a window of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
