"""From the supervised table to trained, evaluated, stored and applied models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import INTENSITY_CLASSES, class_code, score_class
from lealtia.operators import evaluation as ev
from lealtia.operators.anchor import ID
from lealtia.operators.features import TARGET
from lealtia.operators.regressors import TARGET_ORDINAL, boosted_trees, elastic_net, huber
from lealtia.operators.split import stratified_split
from lealtia.session import staged

# Names of the models in the metric tables, in the order they are compared.
MODELS: dict[str, Callable[[DataFrame, Sequence[str]], PipelineModel]] = {
    "ElasticNet": elastic_net,
    "xgboost": boosted_trees,
    "huber": huber,
}


@dataclass(frozen=True)
class Trained:
    """A fitted model, its features, and its scored test rows."""

    name: str
    model: PipelineModel
    features: list[str]
    train_rows: int
    predictions: DataFrame


def prepare(supervised: DataFrame) -> DataFrame:
    """Supervised table with the class code and the split, written once for all models."""
    coded = staged(supervised.withColumn(TARGET_ORDINAL, class_code(TARGET).cast("double")), "supervised")
    return staged(stratified_split(coded, TARGET), "prepared")


def feature_names(prepared: DataFrame) -> list[str]:
    return [c for c in prepared.columns if c not in (ID, TARGET, TARGET_ORDINAL, "is_test")]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows of ``df`` with ``prediction`` and its class, without the vectors made on the way."""
    scored = model.transform(df).withColumn("predicted_class", score_class("prediction"))
    return scored.select(*df.columns, "prediction", "predicted_class")


def train(name: str, prepared: DataFrame, **settings) -> Trained:
    features = feature_names(prepared)
    training = prepared.where(~F.col("is_test"))
    model = MODELS[name](training, features, **settings)
    predictions = staged(score(model, prepared.where("is_test")), "predictions")
    return Trained(name, model, features, training.count(), predictions)


def metric_rows(trained: Trained) -> DataFrame:
    """MAE, accuracy and weighted F1 of the test rows: ``model``, ``metric``, ``value``."""
    rows = trained.predictions
    report = ev.classification_report(rows, TARGET, "predicted_class")
    parts = [
        ev.mean_absolute_error(rows, TARGET_ORDINAL, "prediction").select(
            F.lit("mae_ordinal").alias("metric"), F.col("mae_ordinal").alias("value")
        ),
        ev.accuracy(rows, TARGET, "predicted_class").select(F.lit("accuracy"), "accuracy"),
        report.where(F.col("label") == "weighted avg").select(F.lit("weighted_f1"), "f1_score"),
    ]
    table = parts[0].union(parts[1]).union(parts[2])
    return table.select(F.lit(trained.name).alias("model"), "metric", "value")


def missing_models(metrics: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The expected models that have no ordinal error, and so no place in the comparison."""
    names = metrics.sparkSession.createDataFrame([(n,) for n in expected], "model string")
    return names.join(metrics.where(F.col("metric") == "mae_ordinal"), "model", "left_anti").orderBy("model")


def compare(metrics: DataFrame) -> DataFrame:
    """Models by ordinal error, best first; ``missing_models`` names those without one."""
    errors = metrics.where(F.col("metric") == "mae_ordinal")
    return errors.select("model", F.col("value").alias("mae_ordinal")).orderBy("mae_ordinal", "model")


def metrics_document(trained: Trained) -> DataFrame:
    """One row: accuracy, sizes of the two sets, kind of target, classes."""
    rows = trained.predictions
    hits = F.coalesce(F.col(TARGET) == F.col("predicted_class"), F.lit(False))
    return rows.agg(
        F.avg(hits.cast("double")).alias("accuracy"),
        F.lit(trained.train_rows).alias("num_train_samples"),
        F.count(F.lit(1)).alias("num_test_samples"),
        F.lit("ordinal_multiclass").alias("target_type"),
        ev.label_column(INTENSITY_CLASSES).alias("labels"),
    )


def display_document(trained: Trained) -> DataFrame:
    """One row: accuracy and weighted F1, nested the way a model registry shows them."""
    report = ev.classification_report(trained.predictions, TARGET, "predicted_class")
    picked = report.agg(
        F.max(F.when(F.col("label") == "accuracy", F.col("f1_score"))).alias("accuracy"),
        F.max(F.when(F.col("label") == "weighted avg", F.col("f1_score"))).alias("weighted_f1"),
    )
    values = [F.struct(F.col(m).alias("value")).alias(m) for m in ("accuracy", "weighted_f1")]
    return picked.select(F.struct(*values).alias("classification_metrics"))


def model_document(trained: Trained) -> DataFrame:
    """One row that describes the model: name, kind, target codes, settings, features."""
    stage = trained.model.stages[-1]
    settings = {p.name: str(v) for p, v in stage.extractParamMap().items()}
    codes = [F.lit(x) for pair in zip(INTENSITY_CLASSES, range(len(INTENSITY_CLASSES))) for x in pair]
    pairs = [F.lit(x) for item in sorted(settings.items()) for x in item]
    return trained.predictions.sparkSession.range(1).select(
        F.lit(trained.name).alias("model_name"),
        F.lit(type(stage).__name__).alias("model_type"),
        F.lit("ordinal_regression").alias("problem_type"),
        F.create_map(*codes).alias("target_mapping"),
        F.create_map(*pairs).alias("training_params"),
        F.array(*[F.lit(c) for c in trained.features]).alias("features"),
        F.lit("spark.ml").alias("framework"),
    )
