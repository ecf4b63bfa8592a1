import hashlib
import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lealtia.operators import evaluation as ev
from lealtia.operators import regressors as rg
from lealtia.operators.split import stratified_split
from lealtia.plans import training as tr
from lealtia.plans.scoring import score_csv
from lealtia.sinks import writers as wr

CLASSES = ["sin_compra", "baja", "media", "alta"]


def test_split_has_exact_sizes_and_a_known_order(spark):
    rng = random.Random(4)
    sizes = {"sin_compra": 1801, "baja": 130, "media": 7, "alta": 1, None: 2}
    rows = [(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id_cliente long, label string").where("label is not null").repartition(4)
    got = stratified_split(df, "label").collect()
    total = sum(n for c, n in sizes.items() if c)
    train = total - math.ceil(total * 0.25)
    exact = {c: n * train / total for c, n in sizes.items() if c}
    quota = {c: math.floor(v) for c, v in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (-(exact[c] - quota[c]), c))
    for c in by_remainder[: train - sum(quota.values())]:
        quota[c] += 1
    for c in quota:
        ids = sorted((r["id_cliente"] for r in got if r["label"] == c), key=lambda i: (hashlib.md5(f"{i}-42".encode()).hexdigest(), i))
        test = {r["id_cliente"] for r in got if r["label"] == c and r["is_test"]}
        assert test == set(ids[: len(ids) - quota[c]])


def stored_run(spark):
    """The 61 test rows of the published model, as its report determines them."""
    counts = {
        ("sin_compra", "sin_compra"): 53,
        ("sin_compra", "baja"): 2,
        ("baja", "sin_compra"): 1,
        ("baja", "baja"): 2,
        ("media", "baja"): 1,
        ("media", "media"): 1,
        ("alta", "baja"): 1,
    }
    rows = [pair for pair, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "truth string, predicted string"), counts


def test_report_reproduces_the_published_one(spark):
    df, _ = stored_run(spark)
    got = {r["label"]: (r["precision"], r["recall"], r["f1_score"], r["support"]) for r in ev.classification_report(df, "truth", "predicted").collect()}
    expected = {
        "alta": (0.0, 0.0, 0.0, 1.0),
        "baja": (0.3333333333333333, 0.6666666666666666, 0.4444444444444444, 3.0),
        "media": (1.0, 0.5, 0.6666666666666666, 2.0),
        "sin_compra": (0.9814814814814815, 0.9636363636363636, 0.9724770642201835, 55.0),
        "macro avg": (0.5787037037037037, 0.5325757575757575, 0.5208970438328236, 61.0),
        "weighted avg": (0.9341226472374013, 0.9180327868852459, 0.9205394294881436, 61.0),
        "accuracy": (0.9180327868852459,) * 3 + (61.0,),
    }
    assert set(got) == set(expected)
    for label, values in expected.items():
        assert got[label] == pytest.approx(values, abs=1e-12)
    assert ev.accuracy(df, "truth", "predicted").first()[0] == pytest.approx(56 / 61)


def test_confusion_matrix(spark):
    df, counts = stored_run(spark)
    matrix = ev.confusion_matrix(df, "truth", "predicted")
    got = {(r["truth"], r["predicted"]): r["n"] for r in matrix.collect()}
    assert got == {pair: counts.get(pair, 0) for pair in product(CLASSES, CLASSES)}
    wide = ev.wide_confusion(matrix)
    assert wide.columns == ["label", *[f"Pred_{c}" for c in CLASSES]]
    assert [tuple(r) for r in wide.collect()][0] == ("Real_sin_compra", 53, 2, 0, 0)


def test_missing_predictions_are_wrong(spark):
    df = spark.createDataFrame([("baja", None), ("baja", "baja"), (None, "baja")], "t string, p string")
    assert ev.accuracy(df, "t", "p").first()[0] == pytest.approx(1 / 3)


def test_roc_with_ties(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0, 1, 1]), rng.choice([0.5, 0.5, rng.randint(0, 30) / 30])) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(4)
    wins = [(a > b) + 0.5 * (a == b) for y, a in rows if y for z, b in rows if not z]
    assert ev.roc_auc(df, "y", "p").first()[0] == pytest.approx(sum(wins) / len(wins))
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    curve = ev.roc_curve(df, "y", "p").collect()
    assert len(curve) == len({p for _, p in rows}) + 1
    for r in curve:
        assert r["tpr"] == pytest.approx(sum(y for y, p in rows if p >= r["threshold"]) / pos)
        assert r["fpr"] == pytest.approx(sum(1 - y for y, p in rows if p >= r["threshold"]) / neg)


def test_roc_of_one_kind_is_undefined(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert ev.roc_auc(df, "y", "p").first()[0] is None


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 3)) * [1, 10, 0.1] + [0, 5, 2]
    z = x[:, 0] + 0.05 * x[:, 1] + rng.normal(0, 0.3, 240)
    y = np.digitize(z, [0.3, 1.0, 1.8])
    rows = [(i, *map(float, r), 1.0, CLASSES[c]) for i, (r, c) in enumerate(zip(x, y))]
    schema = "id_cliente long, a double, b double, c double, flat double, target_compra_tecnologia string"
    return tr.prepare(spark.createDataFrame(rows, schema))


def arrays(df):
    rows = df.orderBy("id_cliente").collect()
    return np.array([[r["a"], r["b"], r["c"]] for r in rows]), np.array([r["target_ordinal"] for r in rows])


def test_elastic_net_minimises_the_published_objective(prepared):
    trained = tr.train("ElasticNet", prepared)
    x, y = arrays(prepared.where("not is_test"))
    z = (x - x.mean(0)) / x.std(0)
    w = np.zeros(3)
    for _ in range(2000):
        for j in range(3):
            rest = y - y.mean() - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ rest / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 0.05, 0) / ((z[:, j] ** 2).mean() + 0.05)
    model = trained.model.stages[-1]
    np.testing.assert_allclose(model.coefficients.toArray(), [*w, 0.0], atol=1e-5)
    assert model.intercept == pytest.approx(y.mean(), abs=1e-6)


def test_huber_is_close_to_the_joint_optimum(prepared):
    trained = tr.train("huber", prepared)
    x, y = arrays(prepared.where("not is_test"))
    z = (x - x.mean(0)) / x.std(0)
    model = trained.model.stages[-1]
    w, b, scale = model.coefficients.toArray()[:3], model.intercept, model.scale

    def loss(w, b, s):
        r = np.abs(y - z @ w - b) / s
        return (s + np.where(r < 1.35, r**2, 2.7 * r - 1.35**2) * s).sum() + 1e-4 * (w @ w)

    best = loss(w, b, scale)
    rng = np.random.default_rng(0)
    for _ in range(300):
        step = rng.normal(0, 0.02, 5)
        assert loss(w + step[:3], b + step[3], abs(scale + step[4])) >= best - 1e-6


def test_boosted_trees_learn_and_repeat(prepared):
    features = tr.feature_names(prepared)
    training = prepared.where("not is_test")
    errors = []
    for trees in (1, 20, 20):
        scored = tr.score(rg.boosted_trees(training, features, trees), training)
        errors.append(ev.mean_absolute_error(scored, "target_ordinal", "prediction").first()[0])
    assert errors[1] < errors[0]
    assert errors[1] == errors[2]


def test_documents_metrics_and_comparison(spark, prepared, tmp_path):
    trained = tr.train("ElasticNet", prepared)
    other = tr.train("huber", prepared)
    path = str(tmp_path / "metrics")
    wr.put_metrics(tr.metric_rows(trained), path)
    wr.put_metrics(tr.metric_rows(trained), path)
    wr.put_metrics(tr.metric_rows(other), path)
    metrics = wr.read_metrics(spark, path)
    assert metrics.count() == 6
    table = tr.compare(metrics).collect()
    assert {r["model"] for r in table} == {"ElasticNet", "huber"}
    assert table[0]["mae_ordinal"] <= table[1]["mae_ordinal"]
    document = tr.metrics_document(trained).first()
    assert (document["num_train_samples"], document["num_test_samples"]) == (180, 60)
    assert document["labels"] == CLASSES
    described = tr.model_document(trained).first()
    assert described["target_mapping"] == dict(zip(CLASSES, range(4)))
    assert described["features"] == ["a", "b", "c", "flat"]
    shown = tr.display_document(trained).first()["classification_metrics"]
    assert shown["accuracy"]["value"] == pytest.approx(document["accuracy"])


def test_stored_model_scores_a_csv(spark, prepared, tmp_path):
    trained = tr.train("ElasticNet", prepared)
    wr.save_model(trained.model, str(tmp_path / "model"))
    source = prepared.select("c", "id_cliente", "b", "a", "flat")
    wr.write_csv(source, str(tmp_path / "in"))
    got = score_csv(spark, str(tmp_path / "model"), str(tmp_path / "in"), str(tmp_path / "out"))
    direct = tr.score(trained.model, prepared)
    joined = got.join(direct.select("id_cliente", F.col("prediction").alias("p"), F.col("predicted_class").alias("c")), "id_cliente")
    assert joined.count() == 240
    assert joined.where((F.abs(F.col("prediction") - F.col("p")) > 1e-9) | ~F.col("predicted_class").eqNullSafe(F.col("c"))).count() == 0
