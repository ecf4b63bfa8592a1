"""A training corpus from raw documents: quality rules, line dedup, near dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return
the columns of documents. ``run`` writes each stage's rows to the shared folder and reads them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lealtia.llm.common import read_table, sized
from lealtia.llm.fm_index import find_passages
from lealtia.llm.lines import drop_shared_lines
from lealtia.llm.near import near_duplicates
from lealtia.llm.packing import pack
from lealtia.llm.quality import judge_documents
from lealtia.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


OWN = ("doc_id", "text")


def hidden(docs: DataFrame) -> list[str]:
    """Names under which the columns of the documents go through a stage, so that none is taken for a measure."""
    return [c if c in OWN else f"__column_{i}" for i, c in enumerate(docs.columns)]


def carried(docs: DataFrame) -> DataFrame:
    return docs.select([F.col(f"`{c}`").alias(name) for c, name in zip(docs.columns, hidden(docs))])


def restored(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as they came."""
    return kept.select([F.col(name).alias(c) for c, name in zip(docs.columns, hidden(docs))])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.

    A null, empty or blank text fails the rules and goes. A null id is judged like any other; repeated rows are
    judged row by row, and texts of any length whole. Columns stay as they came. An empty table stays empty.
    """
    judged = judge_documents(carried(docs), read_table(spark, sf_dir, "labels"), columns=hidden(docs))
    return restored(judged.where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many of them share; ``n_chars`` is that of the text left.

    A null text stays null unless a line is dropped, of which it has none; an empty one stays empty. Rows of one id
    are one document for the counts. Columns other than ``text`` and ``n_chars`` stay as they came. Texts of any
    length are read whole. An empty table stays empty.
    """
    kept = drop_shared_lines(carried(docs))
    if "n_chars" in docs.columns:
        name = hidden(docs)[docs.columns.index("n_chars")]
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn(name, F.when(F.col("n_dropped") > 0, counted).otherwise(F.col(name)))
    return restored(kept, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows without an id, and texts without words, are kept. Rows of one id, repeated ones too, go or stay together.
    Columns stay as they came, whatever their names; texts of any length are compared whole. An empty table stays empty.
    """
    found = near_duplicates(docs)
    gone = sized(found.where("NOT kept").select("doc_id").distinct())
    return restored(carried(docs).join(gone, "doc_id", "left_anti"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark is not a twentieth or more.

    A null or empty text has no words and stays, as does a row without an id. Repeated rows are judged row by row, and
    texts of any length whole. Columns stay as they came. An empty table stays empty; an empty benchmark takes nothing.
    """
    found = find_passages(carried(docs), read_table(spark, sf_dir, "benchmark"), hidden(docs))
    return restored(found.where("NOT contaminated"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with a checksum of their ids.

    A null or empty text is the end id alone; a null id stays null; repeated rows are documents of their own; texts of
    any length are cut at the windows. Other columns are left out. An empty table has no pieces.
    """
    pieces = pack(docs)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The hashed n-grams of the first stage and the token ids of the last are not SQL.
ORACLE_SQL = None
