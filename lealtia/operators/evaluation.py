"""Evaluation tables of predictions.

Everything but the ROC measures derives from counts per (true, predicted) class, so a prediction
table of any size is reduced to a few rows in one partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.functions.scalars import INTENSITY_CLASSES, mean
from lealtia.operators.order import running_totals
from lealtia.session import staged


def mean_absolute_error(df: DataFrame, truth: str, score: str) -> DataFrame:
    return df.agg(mean(F.abs(F.col(truth) - F.col(score))).alias("mae_ordinal"))


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Share of rows whose class is right; a missing prediction is wrong."""
    hit = F.coalesce(F.col(truth) == F.col(predicted), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    pairs = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted"))
    return pairs.agg(F.count(F.lit(1)).alias("n"))


def label_column(labels: Sequence[str]) -> Column:
    return F.array(*[F.lit(name) for name in labels])


def confusion_matrix(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = INTENSITY_CLASSES
) -> DataFrame:
    """Rows per pair of classes, pairs that do not occur included, in the order of ``labels``."""
    grid = (
        df.sparkSession.range(1)
        .select(F.posexplode(label_column(labels)).alias("row", "truth"))
        .select("row", "truth", F.posexplode(label_column(labels)).alias("col", "predicted"))
    )
    counts = pair_counts(df, truth, predicted)
    filled = grid.join(counts, ["truth", "predicted"], "left")
    return filled.select("row", "col", "truth", "predicted", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def wide_confusion(matrix: DataFrame, labels: Sequence[str] = INTENSITY_CLASSES) -> DataFrame:
    """The matrix with one column per predicted class and the true class as row label."""
    wide = matrix.groupBy("row", F.concat(F.lit("Real_"), "truth").alias("label"))
    table = wide.pivot("predicted", list(labels)).agg(F.sum("n")).orderBy("row").drop("row")
    return table.withColumnsRenamed({name: f"Pred_{name}" for name in labels})


def classification_report(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = INTENSITY_CLASSES
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted mean.

    Ratios without a denominator are 0. Classes that neither occur nor are predicted are left out.
    """
    counts = pair_counts(df, truth, predicted)
    label = F.explode(label_column(labels)).alias("label")
    here, there = F.col("truth") == F.col("label"), F.col("predicted") == F.col("label")
    n = F.col("n")
    per_class = (
        counts.select("*", label)
        .groupBy("label")
        .agg(
            F.coalesce(F.sum(F.when(here & there, n)), F.lit(0)).alias("hits"),
            F.coalesce(F.sum(F.when(there, n)), F.lit(0)).alias("called"),
            F.coalesce(F.sum(F.when(here, n)), F.lit(0)).alias("support"),
            F.sum(n).alias("rows"),
        )
        .where((F.col("called") > 0) | (F.col("support") > 0))
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    scored = per_class.select(
        "label",
        "hits",
        "rows",
        ratio(F.col("hits"), F.col("called")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("called") + F.col("support")).alias("f1_score"),
        F.col("support").cast("double").alias("support"),
    )
    measures = ["precision", "recall", "f1_score"]
    right = F.sum("hits") / F.max("rows")
    summary = scored.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in measures],
        right.alias("accuracy"),
        F.sum("support").alias("support"),
    )

    def entry(name: str, values: Sequence[Column]) -> Column:
        named = [v.alias(m) for v, m in zip(values, measures)]
        return F.struct(F.lit(name).alias("label"), *named, F.col("support"))

    means = summary.select(
        F.inline(
            F.array(
                entry("accuracy", [F.col("accuracy")] * 3),
                entry("macro avg", [F.col(f"macro_{m}") for m in measures]),
                entry("weighted avg", [F.col(f"weighted_{m}") for m in measures]),
            )
        )
    )
    return scored.select("label", *measures, "support").unionByName(means)


def score_totals(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with the totals of all smaller scores."""
    hit = F.col(truth) == 1
    per_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    )
    return running_totals(staged(per_score, "scores"), "score", ["pos", "neg"])


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties counted half. Null without both kinds."""
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    sums = score_totals(df, truth, score).agg(
        F.sum(wins).alias("wins"), F.sum(F.col("pos").cast("double")).alias("p"), F.sum("neg").alias("n")
    )
    return sums.select(F.try_divide("wins", F.col("p") * F.col("n")).alias("roc_auc"))


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct score as threshold, and the empty start."""
    totals = score_totals(df, truth, score)
    sums = totals.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    p, n = sums.select("p").scalar(), sums.select("n").scalar()
    points = totals.select(
        F.col("score").alias("threshold"),
        F.try_divide(n - F.col("neg_before"), n).alias("fpr"),
        F.try_divide(p - F.col("pos_before"), p).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)
