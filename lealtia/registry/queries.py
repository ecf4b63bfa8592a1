"""Every operator as a named query over the shared tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lealtia.functions.scalars import (
    CLOUD_THRESHOLDS,
    INTENSITY_CLASSES,
    LOCAL_THRESHOLDS,
    class_code,
    intensity_class,
    log10_plus_one,
    month_key,
    round_even,
    score_class,
)
from lealtia.operators import cluster_metrics as cm
from lealtia.operators import clustering as cl
from lealtia.operators import correlation as co
from lealtia.operators import evaluation as ev
from lealtia.operators import explore as ex
from lealtia.operators import features as fe
from lealtia.operators import optimality as op
from lealtia.operators import regressors as rg
from lealtia.operators import reports as rp
from lealtia.operators import sketches as sk
from lealtia.operators import split as sp
from lealtia.operators import summaries as su
from lealtia.operators.anchor import ID, last_transaction, with_anchor
from lealtia.operators.scaling import robust_scaled
from lealtia.plans import customer_features as cf
from lealtia.plans import incremental as inc
from lealtia.plans import segmentation as sg
from lealtia.plans import sql_reports as sr
from lealtia.plans import training as tr
from lealtia.plans.scoring import score_csv
from lealtia.session import fresh_path, staged
from lealtia.sinks.writers import create_bucketed, load_model, save_model, write_csv
from lealtia.sources.loading import load_csv
from lealtia.sources.readers import customers as typed_customers
from lealtia.sources.readers import dated
from lealtia.sources.readers import transactions as typed_transactions
from lealtia.sources.schemas import CUSTOMERS
from lealtia.sources.retail import raw_customers, raw_transacciones, scan, stored_transactions

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 1)
AS_OF_TX = datetime(2001, 6, 30)
AS_OF_MONTHS = 12
CATEGORIES = ["COMIDA", "DEPORTE", "HOGAR", "LICORES", "SALUD_BELLEZA", "TECNOLOGIA"]
REPORT_CATEGORY = "SALUD Y BELLEZA"
# Years in which the two increments of the states begin, and buckets of the catalog tables.
INCREMENTS = (1997, 1998)
BUCKETS = 8
# Columns in a block of the correlation that shows the blocked way on a table of some dozens.
NARROW_BLOCK = 16
# Factors of the formulas whose scores stand for three models.
FORMULAS = {"flat": 3.0, "plain": 4.6, "steep": 6.0}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Registers a query; its fractions are rounded and its dates written out, so that engines compare."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(spark, sf_dir)
        columns = []
        for name, kind in df.dtypes:
            if kind in ("double", "float"):
                columns.append(round_even(name, 6).alias(name))
            elif kind in ("timestamp_ntz", "timestamp", "date"):
                columns.append(F.col(name).cast("string").alias(name))
            else:
                columns.append(F.col(name))
        return df.select(*columns)

    QUERIES[function.__name__] = run
    return function


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_transactions(stored_transactions(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_customers(raw_customers(spark, sf_dir))


def full_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.customer_features(transactions(spark, sf_dir), customers(spark, sf_dir), CATEGORIES)


def supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.supervised_features(transactions(spark, sf_dir), customers(spark, sf_dir))


# Reports


@query
def rep_top_cities(spark, sf_dir):
    return rp.top_cities(raw_customers(spark, sf_dir))


@query
def rep_top_spend_category(spark, sf_dir):
    return rp.top_spenders(raw_transacciones(spark, sf_dir), REPORT_CATEGORY)


@query
def rep_top_redeemed(spark, sf_dir):
    return rp.top_redeemed(raw_transacciones(spark, sf_dir))


@query
def rep_top_redeemed_magnitude(spark, sf_dir):
    return rp.top_redeemed_by_size(raw_transacciones(spark, sf_dir))


@query
def rep_top_balance(spark, sf_dir):
    return rp.top_balances(raw_customers(spark, sf_dir))


@query
def rep_redeem_and_balance(spark, sf_dir):
    return rp.redeemed_and_balance(raw_transacciones(spark, sf_dir), raw_customers(spark, sf_dir))


@query
def rep_monthly_points(spark, sf_dir):
    return rp.monthly_points(raw_transacciones(spark, sf_dir))


def sql_report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sr.register_views(raw_transacciones(spark, sf_dir), raw_customers(spark, sf_dir))
        return sr.report(spark, name)

    return run


QUERIES.update({f"sql_{name}": sql_report(name) for name in sr.REPORTS})


@query
def rep_active_customers_sketch(spark, sf_dir):
    """Customers with transactions per city, counted exactly and from one stored sketch per city and month."""
    active = transactions(spark, sf_dir).join(customers(spark, sf_dir).select(ID, "ciudad"), ID)
    cells = sk.distinct_sketches(active.withColumn("mes", month_key("fecha")), ["ciudad", "mes"], ID)
    estimated = sk.distinct_counts(staged(cells, "distinct-sketches"), ["ciudad"], "estimated")
    exact = active.groupBy("ciudad").agg(F.count_distinct(ID).alias("clientes_activos"))
    near = F.abs(F.col("estimated") - F.col("clientes_activos")) <= 0.02 * F.col("clientes_activos")
    return exact.join(estimated, "ciudad").select("ciudad", "clientes_activos", near.alias("within_2_percent"))


# Exploration


@query
def eda_profile(spark, sf_dir):
    tx = ex.column_profile(transactions(spark, sf_dir)).withColumn("table", F.lit("raw_transacciones"))
    return tx.unionByName(
        ex.column_profile(customers(spark, sf_dir)).withColumn("table", F.lit("raw_customers"))
    )


@query
def eda_clean_customers(spark, sf_dir):
    return ex.clean_customers(customers(spark, sf_dir), AS_OF)


@query
def eda_gender_counts(spark, sf_dir):
    return ex.frequencies(ex.clean_customers(customers(spark, sf_dir), AS_OF), "genero")


@query
def eda_age_hist(spark, sf_dir):
    return ex.histogram(ex.clean_customers(customers(spark, sf_dir), AS_OF), "edad", 25)


@query
def eda_balance_hist(spark, sf_dir):
    return ex.histogram(ex.clean_customers(customers(spark, sf_dir), AS_OF), "saldo_puntos", 50)


@query
def eda_balance_log_hist(spark, sf_dir):
    clean = ex.clean_customers(customers(spark, sf_dir), AS_OF)
    return ex.histogram(clean, log10_plus_one("saldo_puntos"), 30)


@query
def eda_tx_count_hist(spark, sf_dir):
    return ex.histogram(ex.transactions_per_customer(raw_transacciones(spark, sf_dir)), "num_transacciones", 50)


@query
def eda_tx_count_log_hist(spark, sf_dir):
    counts = ex.transactions_per_customer(raw_transacciones(spark, sf_dir))
    return ex.histogram(counts, log10_plus_one("num_transacciones"), 30)


@query
def eda_spend_hist(spark, sf_dir):
    return ex.histogram(ex.spend_per_customer(raw_transacciones(spark, sf_dir)), "total_gastado", 50)


@query
def eda_spend_log_hist(spark, sf_dir):
    spend = ex.spend_per_customer(raw_transacciones(spark, sf_dir))
    return ex.histogram(spend, log10_plus_one("total_gastado"), 30)


@query
def load_accounted(spark, sf_dir):
    """Customers through a CSV in which every 50th birth date does not parse: rows accepted and rejected per column."""
    source, destination = fresh_path(spark, "people-csv"), fresh_path(spark, "people")
    write_csv(raw_customers(spark, sf_dir), source)
    loaded = load_csv(spark, source, dated(CUSTOMERS, "fecha_nacimiento"), destination, [ID])
    refused = loaded.rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").count()
    return loaded.profile.select("column", "non_null", F.col("rows")).unionByName(
        refused.select(F.col("reason").alias("column"), F.lit(loaded.rejected_rows).cast("long").alias("non_null"), F.col("count").alias("rows"))
    )


@query
def eda_quantile_sketches(spark, sf_dir):
    """Quartiles of amounts and points from one stored sketch per month, and whether their ranks are as near as stated."""
    tx = transactions(spark, sf_dir).withColumn("mes", month_key("fecha"))
    names = ["valor_transaccion", "puntos"]
    cells = staged(sk.quantile_sketches(tx, ["mes"], names), "quantile-sketches")
    found = sk.quantiles(sk.merged_quantiles(cells), sk.QUARTILES).collect()  # three rows per column
    ranks = [
        F.struct(
            F.lit(r["feature"]).alias("feature"),
            F.lit(r["probability"]).alias("probability"),
            F.count(r["feature"]).alias("n"),
            F.count_if(F.col(r["feature"]) < r["value"]).alias("below"),
            F.count_if(F.col(r["feature"]) <= r["value"]).alias("upto"),
        )
        for r in found
    ]
    counted = tx.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))
    slack, wanted = sk.rank_error() * F.col("n"), F.col("probability") * F.col("n")
    near = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return counted.select("feature", "probability", "n", near.alias("within_error"))


# Feature blocks


@query
def feat_last_tx(spark, sf_dir):
    return last_transaction(transactions(spark, sf_dir))


@query
def feat_recode_category(spark, sf_dir):
    return ex.frequencies(fe.recode_category(raw_transacciones(spark, sf_dir)), "categoria")


@query
def feat_negative_flags(spark, sf_dir):
    marked = fe.mark_negative_sales(raw_transacciones(spark, sf_dir))
    return marked.select("id_transaccion", ID, "tx_negativa")


@query
def feat_profile(spark, sf_dir):
    return fe.profile(transactions(spark, sf_dir))


@query
def feat_profile_recency(spark, sf_dir):
    return fe.profile(transactions(spark, sf_dir), AS_OF).select(ID, "recencia_dias")


@query
def feat_windows(spark, sf_dir):
    return fe.window_features(transactions(spark, sf_dir))


@query
def feat_windows_asof(spark, sf_dir):
    return fe.window_features_as_of(transactions(spark, sf_dir), AS_OF_MONTHS, AS_OF_TX)


@query
def feat_tech_avg_asof(spark, sf_dir):
    return fe.tech_mean_as_of(transactions(spark, sf_dir), AS_OF_MONTHS, AS_OF_TX)


@query
def feat_category_pivot(spark, sf_dir):
    return fe.category_features(fe.recode_category(transactions(spark, sf_dir)), CATEGORIES)


@query
def feat_tech_avg(spark, sf_dir):
    anchored = with_anchor(transactions(spark, sf_dir), fe.window_edges(fe.TECH_WINDOWS))
    return fe.per_customer(anchored, fe.tech_mean_block()).drop("last_date")


@query
def feat_tech_avg_outer(spark, sf_dir):
    return fe.tech_means(transactions(spark, sf_dir))


@query
def feat_tech_12m(spark, sf_dir):
    return fe.tech_year(transactions(spark, sf_dir))


@query
def feat_demographics(spark, sf_dir):
    return cf.demographics(customers(spark, sf_dir), last_transaction(transactions(spark, sf_dir)))


@query
def feat_target(spark, sf_dir):
    local = fe.target(transactions(spark, sf_dir), LOCAL_THRESHOLDS)
    return local.withColumn("target_cloud", intensity_class("num_tx_target", CLOUD_THRESHOLDS))


@query
def feat_target_counts(spark, sf_dir):
    return ex.frequencies(fe.target(transactions(spark, sf_dir)), fe.TARGET)


# Feature tables


@query
def feat_customer(spark, sf_dir):
    return full_features(spark, sf_dir)


@query
def feat_customer_incremental(spark, sf_dir):
    """The feature table after a first load and two increments, from stored states."""
    tx, path = transactions(spark, sf_dir), fresh_path(spark, "states")
    year = F.coalesce(F.year("fecha"), F.lit(0))
    ends = [*INCREMENTS, 9_999]
    for since, until in zip([0, *INCREMENTS], ends):
        inc.add_batch(tx.where((year >= since) & (year < until)), path, f"from-{since}")
    compacted = fresh_path(spark, "states")
    inc.compact(spark, path, compacted)
    return inc.features_of_states(spark, compacted, customers(spark, sf_dir), CATEGORIES)


@query
def feat_customer_bucketed(spark, sf_dir):
    """The feature table from catalog tables that are bucketed by customer."""
    tables = []
    for kind, table in (("tx", transactions(spark, sf_dir)), ("people", customers(spark, sf_dir))):
        path = fresh_path(spark, f"bucketed-{kind}")
        name = f"lealtia_{kind}_{path.rsplit('-', 1)[1]}"
        create_bucketed(table, name, ID, BUCKETS, path)
        tables.append(spark.table(name))
    return cf.customer_features(*tables, CATEGORIES, busy_rows=None)


@query
def feat_supervised(spark, sf_dir):
    return supervised(spark, sf_dir)


@query
def feat_supervised_selected(spark, sf_dir):
    tables = transactions(spark, sf_dir), customers(spark, sf_dir)
    return cf.selected_features(cf.customer_features(*tables, CATEGORIES, thresholds=LOCAL_THRESHOLDS))


# Correlation


@query
def stat_correlation(spark, sf_dir):
    matrix = co.correlation_matrix(staged(full_features(spark, sf_dir), "features"))
    return matrix.select("feature_1", "feature_2", "correlation")


@query
def stat_correlation_blocks(spark, sf_dir):
    """The same matrix from blocks of columns, as a table with very many of them needs it."""
    features = staged(full_features(spark, sf_dir), "features")
    pairs = co.correlation_pairs(features, width=NARROW_BLOCK)
    return co.both_halves(pairs).select("feature_1", "feature_2", "correlation")


@query
def stat_high_pairs(spark, sf_dir):
    return co.high_pairs(co.correlation_pairs(staged(full_features(spark, sf_dir), "features")))


@query
def stat_redundant(spark, sf_dir):
    return co.redundant_columns(co.correlation_pairs(staged(full_features(spark, sf_dir), "features")))


@query
def stat_reduced(spark, sf_dir):
    kept = co.reduced(staged(full_features(spark, sf_dir), "features"))
    return co.unpivot(kept.withColumn("customer", F.col(ID)), "customer")


# Clustering


def clustering_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.clustering_set(staged(full_features(spark, sf_dir), "features"))


def segment_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.segment_points(staged(full_features(spark, sf_dir), "features"))


def labelled_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scan(spark, sf_dir, "embeddings")
    return vectors.select(
        F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("features")
    )


@query
def clu_features(spark, sf_dir):
    return co.unpivot(clustering_set(spark, sf_dir), ID)


@query
def clu_robust_scale(spark, sf_dir):
    features = clustering_set(spark, sf_dir)
    return co.unpivot(robust_scaled(features, [c for c in features.columns if c != ID]), ID)


@query
def clu_davies_bouldin(spark, sf_dir):
    return cm.davies_bouldin(cm.cluster_summary(labelled_embeddings(spark, sf_dir)))


@query
def clu_calinski(spark, sf_dir):
    return cm.calinski_harabasz(cm.cluster_summary(labelled_embeddings(spark, sf_dir)))


@query
def clu_silhouette(spark, sf_dir):
    return cm.silhouettes(labelled_embeddings(spark, sf_dir), ["cluster"])


@query
def clu_silhouette_squared(spark, sf_dir):
    points = labelled_embeddings(spark, sf_dir)
    return spark.createDataFrame([("cluster", cm.silhouette_squared(points))], "labelling string, value double")


@query
def clu_metrics(spark, sf_dir):
    return cm.cluster_metrics(labelled_embeddings(spark, sf_dir))


@query
def clu_profile_stratum(spark, sf_dir):
    return cl.cluster_profile(full_features(spark, sf_dir), "estrato_social")


@query
def clu_kmeans_sweep(spark, sf_dir):
    return cl.sweep(segment_points(spark, sf_dir))


@query
def clu_kmeans_labels(spark, sf_dir):
    return sg.segments(segment_points(spark, sf_dir)).labels()


@query
def clu_kmeans_metrics(spark, sf_dir):
    return sg.segments(segment_points(spark, sf_dir)).metrics()


@query
def clu_profile(spark, sf_dir):
    return sg.segments(segment_points(spark, sf_dir)).profile()


@query
def clu_bisecting(spark, sf_dir):
    return cl.bisecting(segment_points(spark, sf_dir)).select(ID, "cluster")


@query
def clu_micro_merge(spark, sf_dir):
    return cl.merged(segment_points(spark, sf_dir)).select(ID, "micro", "micro_radius", "cluster")


@query
def clu_ward(spark, sf_dir):
    return cl.merged(segment_points(spark, sf_dir)).select(ID, "cluster")


@query
def clu_cf_tree(spark, sf_dir):
    return cl.cf_tree(segment_points(spark, sf_dir)).select(ID, "micro", "threshold", "cluster")


@query
def clu_silhouette_bounds(spark, sf_dir):
    return su.silhouette_bounds(labelled_embeddings(spark, sf_dir), ["cluster"])


@query
def clu_summary_totals(spark, sf_dir):
    """What the summaries of the labelled vectors add up to, per label."""
    entries = su.summarise(labelled_embeddings(spark, sf_dir), su.THRESHOLD, label="cluster")
    size = F.col("size")
    means = entries.select("label", "size", "threshold", "spread", F.posexplode("centre").alias("dim", "x"))
    widths = means.groupBy("label", "dim").agg(F.sum("size").alias("n"), F.try_divide(F.sum(size * F.col("x")), F.sum("size")).alias("mean"))
    apart = means.join(widths, ["label", "dim"]).groupBy("label").agg(F.sum(size * (F.col("x") - F.col("mean")) ** 2).alias("between"))
    totals = entries.groupBy("label").agg(
        F.sum("size").cast("long").alias("points"), F.sum("spread").alias("within"),
        F.bool_and(F.sqrt(F.col("spread") / size) <= F.col("threshold")).alias("within_limit"),
    )
    return totals.join(apart, "label").select("label", "points", (F.col("within") + F.col("between")).alias("squared"), "within_limit")


@query
def clu_stored_model(spark, sf_dir):
    features = staged(clustering_set(spark, sf_dir), "clustering-set")
    path = fresh_path(spark, "segment-model")
    save_model(sg.fit_segment_model(features), path)
    return sg.score_segments(load_model(path), features)


@query
def clu_pca(spark, sf_dir):
    return cl.principal_components(segment_points(spark, sf_dir))


# Supervised learning and evaluation


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers with their class, a score and a chance made from their spend, and a 0/1 outcome."""
    spend, truth = F.col("total_gasto"), F.col(fe.TARGET)
    return staged(supervised(spark, sf_dir), "supervised").select(
        ID,
        truth.alias("truth"),
        (spend / (spend + 500_000) * 4.6 - 0.8).alias("score"),
        F.when(truth == INTENSITY_CLASSES[0], 0).otherwise(1).alias("bought"),
        (spend / (spend + 1_000_000)).alias("chance"),
    )


@query
def ml_bin_scores(spark, sf_dir):
    return rated(spark, sf_dir).select(
        ID, "truth", "score", class_code("truth").alias("code"), score_class("score").alias("predicted")
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).select("truth", "score", score_class("score").alias("predicted"))


@query
def ml_mae(spark, sf_dir):
    coded = predicted(spark, sf_dir).withColumn("code", class_code("truth"))
    return ev.mean_absolute_error(coded, "code", "score")


@query
def ml_accuracy(spark, sf_dir):
    return ev.accuracy(predicted(spark, sf_dir), "truth", "predicted")


@query
def ml_confusion(spark, sf_dir):
    return ev.confusion_matrix(predicted(spark, sf_dir), "truth", "predicted").drop("row", "col")


@query
def ml_class_report(spark, sf_dir):
    return ev.classification_report(predicted(spark, sf_dir), "truth", "predicted")


@query
def ml_roc_auc(spark, sf_dir):
    return ev.roc_auc(rated(spark, sf_dir), "bought", "chance")


@query
def ml_roc_curve(spark, sf_dir):
    curve = ev.roc_curve(rated(spark, sf_dir), "bought", "chance")
    return curve.withColumn("threshold", F.nullif("threshold", F.lit(float("inf"))))


@query
def ml_split(spark, sf_dir):
    labels = staged(fe.target(transactions(spark, sf_dir)), "labels")
    return sp.stratified_split(labels, fe.TARGET).select(ID, fe.TARGET, "is_test")


@query
def ml_split_counts(spark, sf_dir):
    labels = staged(fe.target(transactions(spark, sf_dir)), "labels")
    return sp.split_sizes(sp.stratified_split(labels, fe.TARGET), fe.TARGET)


@query
def ml_standard_scale(spark, sf_dir):
    coded = supervised(spark, sf_dir).drop(fe.TARGET)
    table = staged(coded, "supervised")
    names = [c for c in table.columns if c != ID]
    scaled = Pipeline(stages=rg.scaled_features(names, table.count())).fit(table).transform(table)
    values = vector_to_array("features")
    return co.unpivot(scaled.select(ID, *[values[i].alias(c) for i, c in enumerate(names)]), ID)


def model_scores(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = tr.train(name, tr.prepare(supervised(spark, sf_dir))).predictions
    return scored.select(ID, fe.TARGET, "target_ordinal", "prediction", "predicted_class")


@query
def ml_elasticnet(spark, sf_dir):
    return model_scores("ElasticNet", spark, sf_dir)


@query
def ml_huber(spark, sf_dir):
    return model_scores("huber", spark, sf_dir)


def trained_on(name: str, spark: SparkSession, sf_dir: str):
    prepared = tr.prepare(supervised(spark, sf_dir))
    return tr.train(name, prepared), prepared.where(~F.col("is_test"))


@query
def ml_elasticnet_optimality(spark, sf_dir):
    """Whether the fitted elastic net meets the conditions of its minimum on all training rows."""
    trained, rows = trained_on("ElasticNet", spark, sf_dir)
    return op.elastic_net_conditions(trained.model, rows, trained.features)


@query
def ml_huber_optimality(spark, sf_dir):
    """Whether the fitted Huber regression meets the conditions of its minimum on all training rows."""
    trained, rows = trained_on("huber", spark, sf_dir)
    return op.huber_conditions(trained.model, rows, trained.features)


def formula_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows of three stored score tables, each a formula of the customers' spend."""
    table = staged(supervised(spark, sf_dir), "supervised")
    spend = F.col("total_gasto")
    metrics = []
    for name, factor in FORMULAS.items():
        scored = table.select(ID, fe.TARGET, class_code(fe.TARGET).cast("double").alias("target_ordinal"), (spend / (spend + 500_000) * factor - 0.8).alias("prediction"))
        stored = staged(scored.withColumn("predicted_class", score_class("prediction")), "predictions")
        metrics.append(tr.metric_rows(tr.Trained(name, None, [], 0, stored)))
    return metrics[0].unionByName(metrics[1]).unionByName(metrics[2])


@query
def ml_metrics_of_scores(spark, sf_dir):
    return formula_metrics(spark, sf_dir)


@query
def ml_compare_of_scores(spark, sf_dir):
    return tr.compare(formula_metrics(spark, sf_dir))


@query
def ml_gbt(spark, sf_dir):
    return model_scores("xgboost", spark, sf_dir)


@query
def ml_compare(spark, sf_dir):
    prepared = tr.prepare(supervised(spark, sf_dir))
    metrics = [tr.metric_rows(tr.train(name, prepared)) for name in tr.MODELS]
    return tr.compare(metrics[0].unionByName(metrics[1]).unionByName(metrics[2]))


@query
def ml_metrics(spark, sf_dir):
    return tr.metric_rows(tr.train("ElasticNet", tr.prepare(supervised(spark, sf_dir))))


@query
def ml_batch_score(spark, sf_dir):
    prepared = tr.prepare(supervised(spark, sf_dir))
    trained = tr.train("ElasticNet", prepared)
    model, source, scores = (fresh_path(spark, name) for name in ("model", "to-score", "scores"))
    save_model(trained.model, model)
    write_csv(prepared.select(ID, *trained.features), source)
    return score_csv(spark, model, source, scores)
