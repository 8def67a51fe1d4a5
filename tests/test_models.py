from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from clickwarden.operators import binning, ensembles, metrics, models, split
from clickwarden.runtime import spill

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b, int(a + 0.5 * b + rng.gauss(0, 0.7) > 1)))
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    return spill(models.assemble(df, NAMES, "y"))


def test_logistic_regression_solves_the_balanced_problem(data):
    """Coefficients against Newton steps on 0.5 |w|^2 + sum of weighted losses."""
    rows = data.select("a", "b", "label").collect()
    x = np.array([[r["a"], r["b"], 1.0] for r in rows])
    y = np.array([r["label"] for r in rows])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, ridge = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        beta -= np.linalg.solve(hessian, x.T @ (w * (p - y)) + ridge @ beta)
    model = models.train_lr(data)
    assert np.allclose([*model.coefficients, model.intercept], beta, atol=1e-4)


def test_gradient_tells_a_solution_from_a_perturbed_one(data):
    model = models.train_lr(data)
    rows = models.lr_gradient(model, data).collect()
    assert [r["position"] for r in rows] == [0, 1, 2]
    assert all(abs(r["gradient"]) < 1e-4 * r["scale"] for r in rows)

    class Perturbed:
        coefficients, intercept = [model.coefficients[0] + 0.05, model.coefficients[1]], model.intercept

    assert max(abs(r["gradient"]) / r["scale"] for r in models.lr_gradient(Perturbed, data).collect()) > 1e-3
    with pytest.raises(Exception, match="both classes"):
        models.lr_gradient(model, data.filter("label = 1")).collect()


def test_boosting_repeats_and_separates(data):
    train, test = split.split_at(data, ["id"], 450)
    first = models.score(models.train_gbt(train, 5, depth=3), test)
    second = models.score(models.train_gbt(train, 5, depth=3), test)
    assert first.select("id", "score").collect() == second.select("id", "score").collect()
    assert metrics.roc_auc(first).first()[0] > 0.8


def test_warm_start_lowers_the_loss(data):
    older, newer = split.split_history(data, ["id"])
    base = models.train_gbt(older, 3, depth=3)
    warm = models.continue_gbt(base, newer, 6, depth=3, store_every=2)

    def loss(model):
        weight = models.positive_weight(newer)
        p = F.greatest(F.least("score", F.lit(1 - 1e-9)), F.lit(1e-9))
        term = F.when(F.col("label") == 1, -weight * F.log(p)).otherwise(-F.log(1 - p))
        return models.score(model, newer).agg(F.avg(term)).first()[0]

    assert loss(warm) < loss(base)
    untouched = models.TreeEnsemble.of(base)
    rows = models.score(untouched, models.score(base, newer).withColumnRenamed("score", "p"))
    assert all(math.isclose(r["score"], r["p"], abs_tol=1e-9) for r in rows.collect())


def test_warm_model_is_stored_and_continued(spark, data, tmp_path):
    older, newer = split.split_history(data, ["id"])
    base = models.train_gbt(older, 3, depth=3)
    added = models.further_trees(base, newer, 4, depth=3, store_every=2)
    warm = models.TreeEnsemble.of(base, added, models.RATE)
    chained = models.margin(base, data)
    for tree in added:
        chained = tree.transform(chained).withColumn(
            "_margin", F.col("_margin") + models.RATE * F.col("prediction")).drop("prediction")
    want = {r["id"]: 1 / (1 + math.exp(-2 * r["_margin"])) for r in chained.collect()}

    path = str(tmp_path / "warm")
    models.save_model(warm, path, NAMES, spark)
    loaded = models.load_model(path, NAMES, spark)
    assert loaded.stages[0].nodes == warm.nodes and loaded.stages[0].uid == warm.uid
    got = {r["id"]: r["score"] for r in models.score(loaded, data).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in got)
    again = models.continue_gbt(loaded.stages[0], newer, 1, depth=2)
    assert len({row[0] for row in again.nodes}) == 8
    assert models.score(warm, data.limit(0)).count() == 0


def test_tree_nodes_walk_left_first():
    class Printed:
        toDebugString = """model
  Tree 0 (weight 0.5):
    If (feature 1 <= 2.5E-3)
     If (feature 0 <= 1.0)
      Predict: -1.0
     Else (feature 0 > 1.0)
      Predict: 3.0
    Else (feature 1 > 2.5E-3)
     Predict: 7.0
  Tree 1 (weight 2.0):
    Predict: 0.25
"""

    assert ensembles.tree_nodes(Printed(), 2.0, 4) == [
        (4, 0, 1.0, 1, 0.0025, 1, 4, 0.0), (4, 1, 1.0, 0, 1.0, 2, 3, 0.0), (4, 2, 1.0, 0, 0.0, 2, 2, -1.0),
        (4, 3, 1.0, 0, 0.0, 3, 3, 3.0), (4, 4, 1.0, 0, 0.0, 4, 4, 7.0), (5, 0, 4.0, 0, 0.0, 0, 0, 0.25)]
    Printed.toDebugString = "Tree 0 (weight 1.0):\n If (feature 0 in {1.0})"
    with pytest.raises(ValueError):
        ensembles.tree_nodes(Printed())


def test_comparison_report(data):
    clicks = data.select("id", "a", "b", F.col("y").alias("is_fraud"))
    report = models.training_report(
        clicks, NAMES, "is_fraud", trees=4, max_iter=20, depth=3, order=["id"])
    rows = {r["model"]: r for r in report.collect()}
    assert set(rows) == {"logistic_regression", "boosted_trees", "warm_start", "cold_w1_w2"}
    assert rows["boosted_trees"]["threshold"] is not None
    assert rows["warm_start"]["threshold"] is None
    assert all(r["roc_auc"] > 0.7 for r in rows.values())


def test_model_store_checks_the_feature_order(spark, data, tmp_path):
    path = str(tmp_path / "m")
    model = models.train_gbt(data, 2, depth=2)
    models.save_model(model, path, NAMES, spark)
    loaded = models.load_model(path, NAMES, spark)
    assert models.score(loaded, data).select("score").collect() == models.score(
        model, data).select("score").collect()
    with pytest.raises(ValueError):
        models.load_model(path, NAMES[::-1], spark)


def test_walk_forward(data):
    blocks = split.walk_forward_folds(data, 3, ["id"])
    scores = models.walk_forward_scores(blocks, lambda part: models.train_lr(part, 10), 3)
    assert scores.count() == 450
    row = metrics.walk_forward_metrics(scores, "fold").first()
    assert row["folds"] == 3 and row["roc_auc_mean"] > 0.7 and row["roc_auc_std"] < 0.2


def test_trees_are_fitted_on_rows_counted_by_bins(spark, data, monkeypatch):
    """Repeated rows cost no more to train on, and the trees on values are MLlib's on bins."""
    fitted = []

    class Recorded(models.GBTClassifier):
        def fit(self, df):
            model = super().fit(df)
            fitted.append((df.count(), df.agg(F.sum("weight")).first()[0], model))
            return model

    monkeypatch.setattr(models, "GBTClassifier", Recorded)
    coarse = spill(models.assemble(data.selectExpr("id", "round(a) a", "round(b) b", "y"), NAMES, "y"))
    repeated = spill(coarse.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(20)))))
    rows = {}
    for df in (coarse, repeated):
        model = models.train_gbt(df, 3, 2.0, depth=3)
        n, weight, own = fitted.pop()
        assert math.isclose(weight, df.agg(F.sum(1 + F.col("label"))).first()[0], rel_tol=1e-9)
        edges = binning.bin_edges(df)
        groups = binning.binned(df, edges)
        assert groups.agg(F.sum("n")).first()[0] == df.count()
        assert n < 10 * groups.count() or n < 2 * binning.PIECES
        rows[df] = groups.count()
        bins = df.select("a", "b", "label").rdd.map(lambda r: (
            r["a"], r["b"], DenseVector([sum(e < r[c] for e in edges[i]) for i, c in enumerate(NAMES)]))).toDF(
            ["a", "b", "features"]).dropDuplicates(["a", "b"])
        want = {(r["a"], r["b"]): r["score"] for r in models.score(own, bins).collect()}
        got = {(r["a"], r["b"]): r["score"] for r in models.score(model, df).select("a", "b", "score").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    assert rows[coarse] == rows[repeated] < 150


def test_heavy_groups_are_cut_for_the_share_of_rows(spark):
    df = spark.createDataFrame([(0.0, 0.0, 5000.0), (1.0, 1.0, 3.0)], "x double, label double, n double").selectExpr(
        "array(x) x", "label", "n", "cast(cast(x as string) as binary) codes")
    cut = binning.in_pieces(df)
    assert cut.agg(F.sum("n")).first()[0] == 5003.0 and cut.agg(F.max("n")).first()[0] <= 1.0
    assert cut.count() == 5003


def test_bin_edges_keep_rare_and_heavy_values(spark):
    assert binning.chosen_edges([0.0] * 4095 + [1.0, 2.0]) == [0.0, 1.0]
    some = binning.chosen_edges([0.0] * 3000 + [float(i) for i in range(1, 1097)])
    assert some[0] == 0.0 and len(some) == 31 and max(b - a for a, b in zip(some, some[1:])) < 50
    nan = spark.createDataFrame([(float(i), 0.0) for i in range(100)] + [(float("nan"), 1.0)], "x double, label double")
    edges = binning.bin_edges(models.assemble(nan, ["x"], "label"))
    assert len(edges[0]) == 31 and not any(math.isnan(e) for e in edges[0])
    last = binning.binned(models.assemble(nan, ["x"], "label"), edges).where("label = 1").first()
    assert last["features"][0] == 31.0
