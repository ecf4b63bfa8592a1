"""Drop lines that many documents share.

Lines are exploded with their position, normalised and hashed to 128 bits; documents are counted per hash
without repeats, and lines over the limit lose every place but those in the document with the largest id.
The positions to drop return to their document, which is then put together again in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.llm.common import ascii_lower, bound, sized, stored, text_print

MIN_CHARACTERS = 20
MIN_DOCUMENTS = 3
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A to Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def drop_shared_lines(
    docs: DataFrame, min_characters: int = MIN_CHARACTERS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """All columns of ``docs``, ``text`` without the dropped lines, and ``n_lines`` and ``n_dropped``.

    A null or empty text is one empty line; a text that loses no line keeps its value. Rows of one id are
    one document when documents are counted; a null id is one document with the smallest id. Columns of
    ``docs`` named like the two counts are replaced.
    """
    texts = docs.select(
        F.col("doc_id").alias("__ld_id"),
        *[c.alias(f"__ld_{n}") for c, n in zip(text_print(docs["text"]), "ab")],
        F.col("text").alias("__ld_text"),
    )
    lines = texts.select(
        "__ld_id", "__ld_a", "__ld_b", F.posexplode(F.split("__ld_text", "\n")).alias("__ld_place", "__ld_line")
    )
    key = lines.where(F.char_length("__ld_line") >= min_characters).withColumn("__ld_key", line_key(F.col("__ld_line")))
    keys = stored(
        key.where(F.char_length("__ld_key") >= min_characters).select(
            "__ld_id",
            "__ld_a",
            "__ld_b",
            "__ld_place",
            F.xxhash64("__ld_key").alias("__ld_h"),
            F.xxhash64(F.lit(7), "__ld_key").alias("__ld_g"),
        ),
        "line-keys",
    )
    counted = (
        keys.select("__ld_h", "__ld_g", "__ld_id")
        .distinct()
        .groupBy("__ld_h", "__ld_g")
        .agg(F.count("*").alias("__ld_n"), F.max("__ld_id").alias("__ld_keeper"))
    )
    shared = stored(counted.where(F.col("__ld_n") >= min_documents).drop("__ld_n"), "shared-lines")
    drops = (
        keys.join(sized(shared), ["__ld_h", "__ld_g"])
        .where(~F.col("__ld_id").eqNullSafe(F.col("__ld_keeper")))
        .groupBy("__ld_id", "__ld_a", "__ld_b")
        .agg(F.collect_set("__ld_place").alias("__ld_drop"))
    )
    whole = docs.drop("n_lines", "n_dropped").withColumns(dict(zip(("__ld_a", "__ld_b"), text_print(docs["text"]))))
    found = whole.join(
        drops.withColumnsRenamed({"__ld_a": "__ld_da", "__ld_b": "__ld_db"}),
        F.col("doc_id").eqNullSafe(F.col("__ld_id")) & (F.col("__ld_a") == F.col("__ld_da")) & (F.col("__ld_b") == F.col("__ld_db")),
        "left",
    )
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = bound(
        split,
        lambda lines: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__ld_drop")), lambda i: F.get(lines, i)
        ),
    )
    return (
        found.withColumn("__ld_lines", F.size(split))
        .withColumn("text", F.when(F.col("__ld_drop").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")))
        .withColumn("n_lines", F.col("__ld_lines").cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("__ld_drop"), F.lit(0)).cast("long"))
        .select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
    )
