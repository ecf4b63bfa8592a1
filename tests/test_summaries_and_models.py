"""K-Means in shared passes, summaries under a radius limit, silhouette bounds, stored segment models."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clusters import blobs, brute_silhouette, frame

from lealtia.operators import clustering as cl
from lealtia.operators import lloyd
from lealtia.operators import summaries as su
from lealtia.plans import segmentation as sg
from lealtia.session import clear_staged, fresh_path
from lealtia.sinks.writers import load_model, save_model


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_shared_passes_find_the_best_of_separate_fits(spark, seed):
    x, labels = blobs(150, seed)
    df = frame(spark, x, labels)
    shared = lloyd.best_runs(lloyd.fit_runs(df, [(k, 42 + r) for k in (3, 4) for r in range(10)]))
    separate = cl.fit_many(df, [3], 42, 5)
    assert shared[3].cost == pytest.approx(separate[3].summary.trainingCost, rel=1e-6)
    for k, run in shared.items():
        gaps = ((x[:, None] - run.centres[None]) ** 2).sum(-1)
        assert run.cost == pytest.approx(gaps.min(axis=1).sum(), rel=1e-9)
        # Every centre is the mean of the points nearest to it.
        for c in range(k):
            own = x[gaps.argmin(axis=1) == c]
            assert np.abs(run.centres[c] - own.mean(axis=0)).max() <= 1e-3
    assert shared[4].cost < shared[3].cost


def test_shared_passes_of_equal_points_and_few_points(spark):
    x = np.array([[1.0, 2.0]] * 50 + [[3.0, 4.0]] * 50)
    df = frame(spark, x, np.zeros(100))
    runs = lloyd.fit_runs(df, [(1, 1), (2, 1), (5, 1)])
    assert [len(r.centres) for r in runs] == [1, 2, 2]
    assert runs[0].cost == pytest.approx(200.0) and runs[1].cost == runs[2].cost == 0.0
    with pytest.raises(ValueError, match="no points"):
        lloyd.fit_runs(df.limit(0), [(2, 1)])


def members(x, rows):
    """Sizes, sum and squared distance to the overall mean, from summaries."""
    size = np.array([r["size"] for r in rows])
    centre = np.array([r["centre"] for r in rows])
    mean = (size[:, None] * centre).sum(0) / size.sum()
    return size.sum(), mean, sum(r["spread"] for r in rows) + (size * ((centre - mean) ** 2).sum(1)).sum()


@pytest.mark.parametrize("parts, threshold, most", [(1, 0.5, 1_024), (5, 0.5, 1_024), (20, 1.0, 12), (7, 0.0, 30)])
def test_no_summary_is_wider_than_the_limit_reached(spark, parts, threshold, most):
    x, labels = blobs(400, seed=3)
    x[:90] = x[0]  # many equal points
    df = frame(spark, x, labels).repartition(parts)
    rows = su.summarise(df, threshold, most).collect()
    reached = {r["threshold"] for r in rows}
    assert len(rows) <= most and len(reached) == 1 and min(reached) >= threshold
    assert max(np.sqrt(r["spread"] / r["size"]) for r in rows) <= min(reached) * (1 + 1e-9)
    # What they add up to does not depend on the partitioning.
    count, mean, squared = members(x, rows)
    assert count == len(x)
    np.testing.assert_allclose(mean, x.mean(0), rtol=1e-9)
    assert squared == pytest.approx(((x - x.mean(0)) ** 2).sum(), rel=1e-9)
    assert sum(r["spread"] for r in rows) <= len(x) * min(reached) ** 2
    if most == 1_024:
        assert min(reached) == threshold
    clear_staged(spark)


def test_absorbed_keeps_the_limit_and_loses_nothing():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 4))
    held = su.Summaries(np.zeros(0), np.zeros((0, 4)), np.zeros(0))
    for start in range(0, 700, 100):
        held = su.absorbed(held, su.Summaries.of_points(x[start : start + 100].copy()), 0.8)
    assert held.size.sum() == 700 and held.radius().max() <= 0.8
    whole = su.union(held)
    np.testing.assert_allclose(whole.centre[0], x.mean(0))
    assert whole.spread[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    # Two summaries that could be one stay apart only if something nearer was there.
    assert 1 < len(held.size) < 300


def test_summaries_of_labels_do_not_mix(spark):
    x, labels = blobs(200, seed=4)
    rows = su.summarise(frame(spark, x, labels), 0.7, label="cluster").collect()
    for label in set(labels):
        own = [r for r in rows if r["label"] == label]
        count, mean, _ = members(x, own)
        assert count == (labels == label).sum()
        np.testing.assert_allclose(mean, x[labels == label].mean(0))


def test_tree_of_summaries_separates_what_is_separate(spark):
    x, labels = blobs(300, seed=2)
    x += labels[:, None] * 10.0
    df = frame(spark, x, labels).drop("cluster")
    got = cl.cf_tree(df, k=3).collect()
    assert len({(r["cluster"], int(labels[r["id_cliente"]])) for r in got}) == 3
    centres = {}
    for r in got:
        centres.setdefault(r["micro"], []).append(np.array(r["features"]))
    assert len(got) == 300 and all(r["threshold"] == su.THRESHOLD for r in got)
    assert cl.cf_tree(df.limit(0), k=3).count() == 0


@pytest.mark.parametrize("most", [4, 16, 64, 1_000])
def test_silhouette_is_inside_its_bounds(spark, most):
    x, labels = blobs(240, seed=6)
    x[:30] = x[1]
    other = np.arange(len(x)) % 5
    other[0] = 9  # a cluster of one
    df = frame(spark, x, labels).withColumn("other", F.when(F.col("id_cliente") == 0, 9).otherwise(F.col("id_cliente") % 5))
    rows = {r["labelling"]: r for r in su.silhouette_bounds(df, ["cluster", "other"], most).collect()}
    for name, marks in (("cluster", labels), ("other", other)):
        exact = brute_silhouette(x, marks)
        assert abs(rows[name]["value"] - exact) <= rows[name]["error"] + 1e-9
        if most == 1_000:
            assert rows[name]["error"] == pytest.approx(0.0, abs=1e-9)
        if most == 64:
            assert rows[name]["error"] < 0.06
    one = df.withColumn("cluster", F.lit(3))
    assert su.silhouette_bounds(one, ["cluster"], most).first()["value"] == 0.0
    clear_staged(spark)


def test_sweep_states_the_error_of_its_silhouette(spark):
    x, labels = blobs(90)
    df = frame(spark, x, labels).drop("cluster")
    row = cl.sweep(df, ks=[3], restarts=3).first()
    model = cl.fit_kmeans(df, 3, restarts=3)
    marks = np.array([r["cluster"] for r in cl.assign(model, df).orderBy("id_cliente").collect()])
    assert abs(row["silhouette"] - brute_silhouette(x, marks)) <= row["silhouette_error"] + 1e-9
    assert row["inertia"] == pytest.approx(model.summary.trainingCost)


def test_stored_segment_model_scores_new_customers(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 3)) + np.repeat([[0, 0, 0], [9, 0, 3], [0, 8, -4]], 40, axis=0)
    rows = [(i, *map(float, r), None if i == 5 else float(i % 7)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id_cliente long, a double, b double, c double, d double")
    model = sg.fit_segment_model(df, k=3, restarts=4)
    path = fresh_path(spark, "segment-model")
    save_model(model, path)
    again = load_model(path)
    before, after = (sg.score_segments(m, df).orderBy("id_cliente").collect() for m in (model, again))
    assert before == after
    assert len({(r["cluster"], r["id_cliente"] // 40) for r in after}) == 3
    # New customers, other columns and another order of columns.
    new = spark.createDataFrame([("x", 0.0, 9.5, 3.1, 0.2, 1_000)], "note string, d double, a double, c double, b double, id_cliente long")
    scored = sg.score_segments(again, new).first()
    near = [r["cluster"] for r in after if r["id_cliente"] // 40 == 1]
    assert scored["id_cliente"] == 1_000 and scored["cluster"] == near[0]
    assert again.stages[1].summary.trainingCost == model.stages[1].summary.trainingCost
    assert again.stages[1].getOrDefault("restarts") == 4
    clear_staged(spark)


def test_centres_of_all_runs_move_as_each_alone():
    """one product for all runs; equally near centres and odd numbers go to the first of them as before."""
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, (1300, 3)).astype("float64")
    x[7, 1] = np.nan
    centres = {4: np.array([[1.0, 0, 0], [-1.0, 0, 0]]), 9: np.array([[0.0, 0, 0]] * 2 + [[1.0, 1, 1]]), 2: x[:1].copy()}
    one, all_at_once = {}, {}
    lloyd.cluster_sums(one, np.delete(x, 7, 0), centres)
    lloyd.cluster_moves(all_at_once, np.delete(x, 7, 0), centres)
    for run in centres:
        for before, now in zip(one[run], all_at_once[run]):
            assert (before[2], *before[4]) == pytest.approx((now[2], *now[4]))
    odd = {}
    lloyd.cluster_moves(odd, x, centres)
    assert sum(row[2] for row in odd[9]) == len(x)


@pytest.mark.parametrize("limit", [0.0, 0.4, 2.0])
def test_rows_stand_alone_as_one_after_the_other_decides(limit):
    """decided in blocks, where rows are equal or far out too."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 4))
    x[:300] = x[rng.integers(300, 400, 300)]
    x[300:330] += 1e6
    new = su.Summaries(rng.integers(1, 5, len(x)).astype("float64"), x, np.zeros(len(x)))
    waiting, plain = np.arange(len(x)), []
    while len(waiting):
        plain.append(waiting[0])
        first = new.rows(np.full(len(waiting) - 1, waiting[0]))
        waiting = waiting[1:][su.merged_radius(new.rows(waiting[1:]), first) > limit]
    assert su.standing(new, np.arange(len(x)), limit).tolist() == plain
