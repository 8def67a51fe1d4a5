"""Training, warm start, scoring and comparison of models with MLlib."""

from __future__ import annotations

import json

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.operators.binning import bin_edges, binned, in_pieces, merged_edges
from clickwarden.operators.ensembles import TreeEnsemble, TreeRegression
from clickwarden.operators.features import vectorize
from clickwarden.operators.metrics import (
    apply_threshold, best_f1_threshold, class_weight, ranking_metrics,
)
from clickwarden.operators.split import chronological_split, fold, split_history
from clickwarden.runtime import spill

SEED = 42
# Fixed values of the boosted model.
DEPTH, RATE, ROW_SHARE, COLUMN_SHARE = 6, 0.1, 0.9, "0.9"


def assemble(df: DataFrame, names: list[str], label: str) -> DataFrame:
    """Add ``features`` (ML vector in fixed order) and ``label``."""
    return vectorize(df, names, "_vector").withColumn(
        "features", array_to_vector("_vector")
    ).withColumn("label", F.col(label).cast("double")).drop("_vector")


def positive_weight(df: DataFrame) -> float:
    return class_weight(df).first()["class_weight"]


def weighted(df: DataFrame, weight: float) -> DataFrame:
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(weight)).otherwise(1.0))


def train_lr(df: DataFrame, max_iter: int = 500) -> Model:
    """Logistic regression with balanced classes and the unit L2 penalty on the sum.

    MLlib divides the loss by the weight sum, so the penalty is divided by it too.
    """
    counts = class_weight(df).first()
    n, pos, neg = counts["positives"] + counts["negatives"], counts["positives"], counts["negatives"]
    balanced = F.when(F.col("label") == 1, F.lit(n / (2 * pos))).otherwise(F.lit(n / (2 * neg)))
    return LogisticRegression(
        maxIter=max_iter, regParam=1.0 / n, elasticNetParam=0.0, standardization=False,
        weightCol="weight",
    ).fit(df.withColumn("weight", balanced))


def lr_gradient(model: Model, df: DataFrame) -> DataFrame:
    """The balanced objective's gradient at a logistic model: one row (position, gradient, scale).

    The last position is the intercept, which has no penalty. ``scale`` is the sum of the
    absolute terms, so gradient / scale tells how far the terms are from balance. One
    aggregate over the rows; labels of one class only raise, as in training.
    """
    counts = class_weight(df).first()
    pos, neg = counts["positives"], counts["negatives"]
    share = F.when(F.col("label") == 1, (pos + neg) / (2 * pos)).otherwise((pos + neg) / (2 * neg))
    weights = [float(c) for c in model.coefficients]
    values = vector_to_array("features")
    z = F.lit(float(model.intercept))
    for at, c in enumerate(weights):
        z = z + F.lit(c) * F.col("_x")[at]
    terms = df.select(values.alias("_x"), "label", share.alias("_w")).select(
        "_x", (F.col("_w") * (1 / (1 + F.exp(-z)) - F.col("label"))).alias("_r"))
    sums = []
    for at, c in enumerate([*weights, 0.0]):
        term = F.col("_r") * (F.col("_x")[at] if at < len(weights) else F.lit(1.0))
        sums.append(F.struct(F.lit(at).alias("position"), (F.sum(term) + c).alias("gradient"),
                             (F.sum(F.abs(term)) + abs(c)).alias("scale")))
    return terms.agg(F.array(*sums).alias("g")).select(F.inline("g"))


def train_gbt(
    df: DataFrame, trees: int = 120, weight: float | None = None, depth: int = DEPTH
) -> TreeEnsemble:
    """Boosted trees with the positive class weighted by negatives per positive.

    MLlib fits them on the rows counted by bins, and the model compares values again.
    """
    weight = positive_weight(df) if weight is None else weight
    edges = bin_edges(df)
    fitted = GBTClassifier(
        maxDepth=depth, stepSize=RATE, maxIter=trees, subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE, weightCol="weight", seed=SEED,
    ).fit(_weighted_groups(in_pieces(binned(df, edges)), weight))
    return TreeEnsemble.of(fitted).on_values(edges)


def _weighted_groups(groups: DataFrame, weight: float) -> DataFrame:
    return weighted(groups, weight).withColumn("weight", F.col("weight") * F.col("n")).drop("n")


def retrain(df: DataFrame, trees: int = 200, depth: int = DEPTH) -> Model:
    """Batch retraining of the transaction model."""
    return train_gbt(df, trees, depth=depth)


def margin(model: Model, df: DataFrame, out: str = "_margin") -> DataFrame:
    """Raw score of a boosted model: the log odds are twice the margin."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("rawPrediction")[1]).select(*df.columns, out)


def continue_gbt(
    model: Model, df: DataFrame, trees: int = 60, rate: float = RATE, depth: int = DEPTH,
    store_every: int = 10,
) -> TreeEnsemble:
    """Warm start: a boosted model with further trees fitted on newer data.

    The result can be stored, loaded, scored and continued again like its base.
    """
    return TreeEnsemble.of(model, further_trees(model, df, trees, rate, depth, store_every), rate)


def further_trees(
    model: Model, df: DataFrame, trees: int = 60, rate: float = RATE, depth: int = DEPTH,
    store_every: int = 10,
) -> list[TreeRegression]:
    """Trees that follow a boosted model, to be added with the weight ``rate`` each.

    Each round fits the gradient of the log loss at the current margin, on the same shares
    of rows and columns as the first trees. Rows are counted by bins whose edges include the
    model's thresholds, so that all rows of a group have one margin. The margin is stored every
    few rounds so that the plan does not grow with the trees.
    """
    base, own = TreeEnsemble.of(model), bin_edges(df)
    edges = merged_edges(own, base.thresholds(len(own)))
    data = _weighted_groups(in_pieces(binned(df, edges)), positive_weight(df))
    state = spill(margin(base.on_bins(edges), data), "margin")
    sign = 2 * F.col("label") - 1
    added = []
    for number in range(trees):
        gradient = 4 * sign / (1 + F.exp(2 * sign * F.col("_margin")))
        tree = RandomForestRegressor(  # a forest of one tree takes both shares
            numTrees=1, bootstrap=False, subsamplingRate=ROW_SHARE, featureSubsetStrategy=COLUMN_SHARE,
            maxDepth=depth, labelCol="_residual", weightCol="weight", seed=SEED + number,
        ).fit(state.withColumn("_residual", gradient))
        added.append(TreeRegression.of(tree).on_values(edges))
        step = F.col("_margin") + F.lit(rate) * F.col("prediction")
        state = tree.transform(state).withColumn("_margin", step).drop("prediction")
        if (number + 1) % store_every == 0 and number + 1 < trees:
            state = spill(state, "margin")
    return added


def score(model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Add the probability of the positive class; with a threshold also the flag."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    out = scored.select(*df.columns, "_p")
    if threshold is None:
        return out.withColumnRenamed("_p", "score")
    return apply_threshold(out, threshold, "_p").drop("_p")


def _evaluated(name: str, model, test: DataFrame) -> DataFrame:
    scored = score(model, test).select("label", "score")
    return ranking_metrics(scored).select(
        F.lit(name).alias("model"), "positives", "negatives",
        F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"))


def warm_vs_cold(
    train: DataFrame, test: DataFrame, trees: int = 120, depth: int = DEPTH,
    order: list[str] = ("timestamp", "click_id"), cold: Model | None = None,
) -> DataFrame:
    """Half the trees on the older half plus half on the newer, against all trees on both.

    ``cold`` may be given when the same model has been trained already.
    """
    older, newer = split_history(train, order)
    warm = continue_gbt(train_gbt(older, trees // 2, depth=depth), newer, trees // 2, depth=depth)
    cold = cold or train_gbt(train, trees, depth=depth)
    return _evaluated("warm_start", warm, test).unionByName(_evaluated("cold_w1_w2", cold, test))


def fit_and_compare(
    df: DataFrame, names: list[str] = tuple(schemas.CLICK_FEATURES), label: str = "is_fraud",
    test_fraction: float = 0.2, trees: int = 120, max_iter: int = 500, depth: int = DEPTH,
    order: list[str] = ("timestamp", "click_id"),
) -> tuple[DataFrame, Model]:
    """The training report and the boosted model it describes.

    One row per model: logistic, boosted, warm start and cold, on one time split, with
    the sizes and positive rates of both parts and the order of the features.
    ``threshold`` and ``f1`` are the best F1 operating point of the boosted model.
    """
    ready = spill(assemble(df.select(*names, label, *order), list(names), label), "training")
    train, test = chronological_split(ready, test_fraction, list(order))
    boosted = train_gbt(train, trees, depth=depth)
    best = best_f1_threshold(score(boosted, test).select("label", "score")).first()
    rows = _evaluated("logistic_regression", train_lr(train, max_iter), test)
    rows = rows.unionByName(_evaluated("boosted_trees", boosted, test))
    # Same rows, trees and seed: the boosted model is the cold one.
    rows = rows.unionByName(warm_vs_cold(train, test, trees, depth, order, boosted))
    parts = {name: part.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).first()
             for name, part in (("train", train), ("test", test))}
    for name, part in parts.items():
        rows = rows.withColumns({
            f"{name}_rows": F.lit(part["n"]), f"{name}_positive_rate": F.lit(part["rate"])})
    rows = rows.withColumns({
        "rows": F.col("train_rows") + F.col("test_rows"), "features": F.lit(json.dumps(list(names)))})
    mine = F.col("model") == "boosted_trees"
    report = rows.withColumns({
        "threshold": F.when(mine, F.lit(round(best["threshold"], 6))),
        "f1": F.when(mine, F.lit(round(best["f1"], 6))),
    })
    return report, boosted


def training_report(df: DataFrame, *args, **kwargs) -> DataFrame:
    """The report of ``fit_and_compare`` with the same arguments."""
    return fit_and_compare(df, *args, **kwargs)[0]


def walk_forward_scores(
    df: DataFrame, fit, folds: int = 5, block: str = "block"
) -> DataFrame:
    """Out-of-fold scores: fit on the blocks before each block and score that block."""
    parts = None
    for number in range(1, folds + 1):
        train, test = fold(df, number, block)
        scored = score(fit(train), test).select(F.col(block).alias("fold"), "label", "score")
        parts = scored if parts is None else parts.unionByName(scored)
    return parts


def save_model(model: Model, path: str, names: list[str], spark: SparkSession) -> None:
    """Store a fitted model together with the order of its features."""
    stages = model if isinstance(model, PipelineModel) else PipelineModel([model])
    stages.write().overwrite().save(f"{path}/model")
    order = spark.createDataFrame([(json.dumps(list(names)),)], "features string")
    order.write.mode("overwrite").json(f"{path}/feature_order")


def load_model(path: str, names: list[str], spark: SparkSession) -> PipelineModel:
    """Load a model; fails when its feature order differs from ``names``."""
    stored = json.loads(spark.read.schema("features string").json(f"{path}/feature_order").first()[0])
    if stored != list(names):
        raise ValueError(f"model was trained on {stored}, not on {list(names)}")
    return PipelineModel.load(f"{path}/model")
