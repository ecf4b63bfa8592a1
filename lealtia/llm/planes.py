"""Token-id files whose blocks are stored as bit or byte planes.

A file row is a chunk of whole documents in ascending id order. Its ids are cut into blocks of a fixed
size; each block is transposed into planes (all first bytes, all second bytes, or all ids' lowest bits,
...) and each plane is compressed by zstandard on its own. The chunk index holds, per chunk, its task,
number, ids, documents and first and last document; the files are Parquet, so that any store holds them
and a lost executor leaves no half-written file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lealtia.llm.common import sized
from lealtia.llm.packing import character_batches, part_bases
from lealtia.llm.tokens import WORD_VOCABULARY, encoder

#: Ids of a block; only the last block of a chunk has fewer.
BLOCK = 1 << 16
#: A chunk takes documents until it has so many ids.
CHUNK = 1 << 18
LEVEL = 3
SCHEMA = (
    "part int, chunk int, local_start long, n_ids long, first_doc long, last_doc long,"
    " doc_ids array<long>, doc_tokens array<long>, block_ids array<int>, planes array<array<binary>>"
)
INDEX = ["part", "chunk", "local_start", "n_ids", "n_docs", "first_doc", "last_doc"]


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids, lowest first; planes above the highest set one are left out."""
    top = int(ids.max()) if len(ids) else 0
    if kind == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
        return [rows[i].tobytes() for i in range(max(1, (top.bit_length() + 7) // 8))]
    return [np.packbits((ids >> np.uint32(bit)) & np.uint32(1)).tobytes() for bit in range(max(1, top.bit_length()))]


def join_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ids of a block from its planes."""
    ids = np.zeros(n, "<u4")
    for place, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * place)
        else:
            ids |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(place)
    return ids


def write_ids(
    docs: DataFrame,
    path: str,
    vocabulary: str = WORD_VOCABULARY,
    kind: str = "byte",
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> None:
    """Encode all documents and write them to ``path``/data and ``path``/index, ascending by ``doc_id``.

    Null texts are empty (the end id alone). Null ids come first; rows of one id are ordered by text, and
    each is a document of its own. Extra columns are left out; an empty table gives files without rows.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        coded: list[bytes] = []
        pack = zstandard.ZstdCompressor(level=LEVEL)

        def flush() -> pa.RecordBatch:
            nonlocal number, before
            ids = np.frombuffer(b"".join(coded), "<u4")
            cuts = range(0, len(ids), block)
            row = {
                "part": part,
                "chunk": number,
                "local_start": before,
                "n_ids": len(ids),
                "first_doc": names[0],
                "last_doc": names[-1],
                "doc_ids": list(names),
                "doc_tokens": [len(c) // 4 for c in coded],
                "block_ids": [len(ids[i : i + block]) for i in cuts],
                "planes": [[pack.compress(p) for p in split_planes(ids[i : i + block], kind)] for i in cuts],
            }
            number, before = number + 1, before + len(ids)
            names.clear()
            coded.clear()
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema)

        held = 0
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for first, end in character_batches(texts, chunk):
                for name, one in zip(ids[first:end], encoder(vocabulary).encode(texts[first:end])):
                    names.append(name)
                    coded.append(one)
                    held += len(one) // 4
                    if held >= chunk:
                        held = 0
                        yield flush()
        if coded:
            yield flush()

    arrow_schema = pa.schema(
        [
            ("part", pa.int32()),
            ("chunk", pa.int32()),
            ("local_start", pa.int64()),
            ("n_ids", pa.int64()),
            ("first_doc", pa.int64()),
            ("last_doc", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())),
            ("block_ids", pa.list_(pa.int32())),
            ("planes", pa.list_(pa.list_(pa.binary()))),
        ]
    )
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(chunks, SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/data")
    data = docs.sparkSession.read.parquet(f"{path}/data").withColumn("n_docs", F.size("doc_ids"))
    data.select(INDEX).coalesce(1).write.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str, kind: str = "byte") -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                blocks = [
                    join_planes([unpack.decompress(p) for p in planes], n, kind)
                    for planes, n in zip(row["planes"], row["block_ids"])
                ]
                raw = np.concatenate(blocks).tobytes()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - np.array(row["doc_tokens"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first"], pa.int64()),
                        pa.array(row["doc_tokens"], pa.int64()),
                        pa.array([raw[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    index = spark.read.parquet(f"{path}/index")
    bases = part_bases(index.select("part", F.col("n_ids").alias("n")))
    chunks = spark.read.parquet(f"{path}/data").join(sized(bases), "part")
    return chunks.select(
        (F.col("base") + F.col("local_start")).alias("first"), "doc_ids", "doc_tokens", "block_ids", "planes"
    ).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
