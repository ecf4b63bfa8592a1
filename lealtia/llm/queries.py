"""The operators of this subpackage over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lealtia.llm.common import read_table
from lealtia.llm.differencing import balanced_shards
from lealtia.llm.fm_index import find_passages
from lealtia.llm.lines import drop_shared_lines
from lealtia.llm.near import near_duplicates
from lealtia.llm.neighbours import nearest_neighbours
from lealtia.llm.packing import pack
from lealtia.llm.pii import KINDS, personal_spans
from lealtia.llm.planes import read_ids, write_ids
from lealtia.llm.prefix_tree import prefix_tree
from lealtia.llm.quality import judge_documents
from lealtia.llm.repair import repair_conversations
from lealtia.llm.repeats import without_repeats
from lealtia.llm.site_text import extract_main_text
from lealtia.session import fresh_path


def op1_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(read_table(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["strict"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )


def op2_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_documents(docs, read_table(spark, sf_dir, "labels"), columns=["doc_id"])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op4_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_byte_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-planes")
    write_ids(read_table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return find_passages(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_coordinate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(read_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op12_iterative_deepening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read_table(spark, sf_dir, "conversations"))


def op13_depth_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree(read_table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_weak_supervision": op1_weak_supervision,
    "op2_likelihood_ratio": op2_likelihood_ratio,
    "op3_line_dedup": op3_line_dedup,
    "op4_concat_and_cut": op4_concat_and_cut,
    "op5_byte_planes": op5_byte_planes,
    "op6_karmarkar_karp": op6_karmarkar_karp,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_fm_index": op8_fm_index,
    "op9_coordinate_join": op9_coordinate_join,
    "op10_site_templates": op10_site_templates,
    "op11_multiprobe": op11_multiprobe,
    "op12_iterative_deepening": op12_iterative_deepening,
    "op13_depth_bands": op13_depth_bands,
    "pipeline": corpus_pipeline.run,
}
