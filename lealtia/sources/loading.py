"""Loading a CSV with an account of every line: accepted rows, rejected rows with their reasons, and a profile.

The file is read once. That pass writes both tables and takes the profile by observing what goes by.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lealtia.sources.schemas import require_columns

CORRUPT = "_corrupt_line"
PROFILE = "column string, type string, non_null long, rows long"


class Loaded(NamedTuple):
    """The rows that fit the schema; the others as text with ``reasons``; per column the accepted values."""

    accepted: DataFrame
    rejected: DataFrame
    profile: DataFrame
    accepted_rows: int
    rejected_rows: int


def reasons(schema: T.StructType, required: list[str]) -> Column:
    """Why a row of texts is rejected, as an array: ``line`` if it has too many or too few fields, ``name: value`` for
    a value that does not parse, ``name: missing`` for a required one that is not there."""
    found = [F.when(F.col(CORRUPT).isNotNull(), F.lit("line"))]
    for field in schema.fields:
        text = F.col(field.name)
        unparsed = text.isNotNull() & (F.trim(text) != "") & text.try_cast(field.dataType).isNull()
        found.append(F.when(unparsed, F.concat(F.lit(f"{field.name}: "), text)))
        if field.name in required:
            found.append(F.when(text.isNull() | (F.trim(text) == ""), F.lit(f"{field.name}: missing")))
    return F.array_compact(F.array(*found))


def header_of(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, destination: str, required: list[str] | None = None
) -> Loaded:
    """Split the lines of a CSV with a header into accepted and rejected rows, stored as Parquet at ``destination``.

    Columns are matched by name; a column of ``schema`` that the file lacks is an error. An empty field is null and no
    reason to reject, unless its column is ``required``. Accepted and rejected rows together are the lines of the file.
    """
    names = header_of(spark, path)
    require_columns(spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names])), schema.names)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    reader = spark.read.schema(texts).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    lines = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    judged = lines.withColumn("reasons", reasons(schema, required or [])).withColumn("rejected", F.size("reasons") > 0)
    good = ~F.col("rejected")
    seen = Observation("load")
    counts = [F.count_if(good & F.col(f.name).try_cast(f.dataType).isNotNull()).alias(f"c{i}") for i, f in enumerate(schema.fields)]
    watched = judged.observe(seen, F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"), *counts)
    watched.write.mode("overwrite").partitionBy("rejected").parquet(destination)
    stored_schema = texts.add("reasons", T.ArrayType(T.StringType())).add("rejected", T.BooleanType())
    stored = spark.read.schema(stored_schema).parquet(destination)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    found = seen.get
    rows = [(f.name, f.dataType.simpleString(), found[f"c{i}"], found["accepted"]) for i, f in enumerate(schema.fields)]
    return Loaded(
        stored.where(~F.col("rejected")).select(*typed),
        stored.where("rejected").select(*names, CORRUPT, "reasons"),
        spark.createDataFrame(rows, PROFILE),
        found["accepted"],
        found["rejected"],
    )
