"""Batch scoring: a stored model, a CSV of customers in, a CSV of scores out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lealtia.operators.anchor import ID
from lealtia.plans.training import score
from lealtia.sinks.writers import load_model, write_csv
from lealtia.sources.readers import read_csv


def score_csv(spark: SparkSession, model_path: str, source: str, destination: str) -> DataFrame:
    """Score every customer of the CSV at ``source`` and write id, score and class to ``destination``."""
    model = load_model(model_path)
    features = model.stages[0].getInputCols()
    schema = T.StructType(
        [T.StructField(ID, T.LongType()), *[T.StructField(c, T.DoubleType()) for c in features]]
    )
    scored = score(model, read_csv(spark, source, schema)).select(ID, "prediction", "predicted_class")
    write_csv(scored, destination)
    return read_csv(
        spark,
        destination,
        T.StructType(
            [
                T.StructField(ID, T.LongType()),
                T.StructField("prediction", T.DoubleType()),
                T.StructField("predicted_class", T.StringType()),
            ]
        ),
    )
