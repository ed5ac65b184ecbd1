"""Model families, fold evaluation, selection and scoring.

Models are pooled: one fit over all series. Every fit is a Spark job; the driver loops over
models and folds only and keeps nothing but scores.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmill import fixed
from seriesmill.operators import features, folds, forecast, metrics, roles
from seriesmill.operators.elastic_net import GramElasticNet
from seriesmill.operators.extra_trees import ExtraTrees
from seriesmill.session import settle, settle_compact
from seriesmill.sources import bundles, files

SCORE_SCHEMA = (
    "rmse double, mae double, mape double, r2 double, task string, horizon int, "
    "model_name string, fold int, accuracy double"
)
MAJORITY = "dummy_classifier"


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the model families; the defaults are the published ones."""

    trees: int = 300
    wide_trees: int = 400
    boosts: int = 250
    rate: float = 0.05
    boost_depth: int = 3
    depth: int = 30
    min_leaf: int = 2
    penalty: float = 0.01
    l1_share: float = 0.3
    net_steps: int = 20_000
    logit_steps: int = 5_000
    seed: int = 42


@dataclass(frozen=True)
class Recipe:
    """How to prepare the features and which estimator to fit on them."""

    encoding: str
    scale: bool
    make: object  # rows -> Estimator

    def estimator(self, label: str, n_rows: int) -> Estimator:
        return self.make(n_rows).setLabelCol(label).setFeaturesCol("features")


def regressors(s: ModelSettings = ModelSettings()) -> dict[str, Recipe]:
    forest = dict(minInstancesPerNode=s.min_leaf, maxDepth=s.depth, seed=s.seed)
    return {
        "elastic_net": Recipe("onehot", True, lambda n: GramElasticNet(s.penalty, s.l1_share, s.net_steps)),
        "random_forest": Recipe("onehot", False, lambda n: RandomForestRegressor(
            numTrees=s.trees, featureSubsetStrategy="all", **forest)),
        "extra_trees": Recipe("onehot", False, lambda n: ExtraTrees(s.wide_trees, s.min_leaf, s.depth, s.seed)),
        "gradient_boosting": Recipe("ordinal", False, lambda n: GBTRegressor(
            maxIter=s.boosts, stepSize=s.rate, maxDepth=s.boost_depth, seed=s.seed)),
    }


def classifiers(s: ModelSettings = ModelSettings()) -> dict[str, Recipe]:
    forest = dict(minInstancesPerNode=s.min_leaf, maxDepth=s.depth, seed=s.seed)
    return {
        "logistic_regression": Recipe("onehot", True, lambda n: LogisticRegression(
            maxIter=s.logit_steps, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)),
        "random_forest_cls": Recipe("onehot", False, lambda n: RandomForestClassifier(
            numTrees=s.trees, featureSubsetStrategy="sqrt", **forest)),
        "extra_trees_cls": Recipe("onehot", False, lambda n: ExtraTrees(s.wide_trees, s.min_leaf, s.depth, s.seed, classes=True)),
        "gradient_boosting_cls": Recipe("ordinal", False, lambda n: GBTClassifier(
            maxIter=s.boosts, stepSize=s.rate, maxDepth=s.boost_depth, seed=s.seed)),
    }


def recipes(task: str, settings: ModelSettings, names: Sequence[str] | None = None) -> dict[str, Recipe]:
    known = regressors(settings) if task == "regression" else classifiers(settings)
    return {n: known[n] for n in names} if names else known


def fit_model(
    train: DataFrame, recipe: Recipe, r: roles.Roles, label: str,
    learned: features.Learned | None = None,
) -> PipelineModel:
    """Preprocessing and estimator fitted on ``train`` as one savable pipeline."""
    learned = learned or features.learn(train, r.numeric, r.categorical)
    prep = features.preprocessing_stages(train, learned, recipe.encoding, recipe.scale)
    data = PipelineModel(prep).transform(train).select("features", F.col(label).cast("double"))
    data.persist()
    try:
        fitted = recipe.estimator(label, data.count()).fit(data)
    finally:
        data.unpersist()
    return PipelineModel([*prep, fitted])


def majority_model(train: DataFrame, label: str) -> PipelineModel:
    value = metrics.majority_class(train, label).first()["majority"]
    return PipelineModel(
        [SQLTransformer(statement=f"SELECT *, CAST({float(value)!r} AS DOUBLE) AS prediction FROM __THIS__")]
    )


def evaluate_horizon(
    panel: DataFrame,
    horizon: int,
    min_train: int = fixed.MIN_TRAIN_MONTHS,
    valid: int = fixed.VALID_MONTHS,
    max_splits: int = fixed.MAX_SPLITS,
    embargo: int = 0,
    settings: ModelSettings = ModelSettings(),
    models: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Scores of every model on every fold of one horizon, both tasks.

    Classification folds with one class in the training or validation part are skipped. The
    labelled matrix is written to the shared folder, so no fit recomputes the panel, in as many parts
    as its rows need, so the tasks of a fit do not grow with the tasks that made the panel.
    """
    scores = []
    for task in roles.TASKS:
        chosen = recipes(task, settings, (models or {}).get(task))
        scores += _score_task(panel, task, horizon, chosen, (min_train, valid, max_splits, embargo))
    return panel.sparkSession.createDataFrame(scores, SCORE_SCHEMA)


def _score_task(panel, task, horizon, chosen: dict[str, Recipe], split: tuple) -> list[tuple]:
    r, label = roles.infer_roles(panel), roles.label_name(task, horizon)
    matrix = settle_compact(roles.training_matrix(panel, horizon, task, r), f"matrix-{task}-h{horizon}")
    split_months = folds.expanding_folds(matrix, r.date, *split)
    bounds = folds.fold_bounds(split_months)
    if task == "classification":
        usable = _folds_with_two_classes(matrix, split_months, label, r.date)
        bounds = [b for b in bounds if b[0] in usable]
    month = F.trunc(r.date, "MM")
    out = []
    for fold, last_train, first, last in bounds:
        train = matrix.where(month <= F.lit(last_train))
        held = matrix.where(month.between(F.lit(first), F.lit(last)))
        learned = features.learn(train, r.numeric, r.categorical)
        for name, recipe in chosen.items():
            scored = fit_model(train, recipe, r, label, learned).transform(held)
            if task == "regression":
                m = metrics.regression_metrics(scored, label, "prediction").first()
                out.append((m["rmse"], m["mae"], m["mape"], m["r2"], task, horizon, name, fold, None))
            else:
                m = metrics.accuracy(scored, label, "prediction").first()
                out.append((None, None, None, None, task, horizon, name, fold, m["accuracy"]))
    return out


def _folds_with_two_classes(matrix, split_months, label: str, date: str) -> set[int]:
    """Folds whose training and validation parts both hold two classes; one job for all folds."""
    classes = (
        folds.with_folds(matrix.select(date, label), split_months, date)
        .groupBy("fold", "role")
        .agg(F.countDistinct(label).alias("n"))
        .where("n >= 2")
        .groupBy("fold")
        .agg(F.count(F.lit(1)).alias("parts"))
    )
    return {r["fold"] for r in classes.where("parts = 2").collect()}


def _two_classes(df: DataFrame, label: str) -> bool:
    return df.agg(F.countDistinct(label)).first()[0] >= 2


def train_best_models(
    panel: DataFrame,
    model_dir: str,
    horizons: Sequence[int] = fixed.HORIZONS,
    settings: ModelSettings = ModelSettings(),
    models: dict[str, Sequence[str]] | None = None,
    **split,
) -> tuple[DataFrame, DataFrame]:
    """Evaluate, choose, refit on all labelled rows and save; returns scores and selection.

    Writes one bundle per task and horizon plus ``benchmark_scores``, ``selected_models`` (CSV)
    and ``training_metadata`` (JSON) below ``model_dir``.
    """
    panel = settle_compact(panel, "panel")
    r = roles.infer_roles(panel)
    scores, winners = None, {}
    for horizon in horizons:
        found = evaluate_horizon(panel, horizon, settings=settings, models=models, **split)
        scores = found if scores is None else scores.unionByName(found)
        winners |= {(w["task"], horizon): w["model_name"] for w in
                    metrics.best_models(metrics.score_summary(found)).collect()}

    def refit(matrix: DataFrame, task: str, horizon: int, name: str) -> PipelineModel:
        return fit_model(matrix, recipes(task, settings)[name], r, roles.label_name(task, horizon))

    return save_best_models(panel, model_dir, scores, winners, horizons, refit)


def save_best_models(
    panel: DataFrame,
    model_dir: str,
    scores: DataFrame,
    winners: dict[tuple[str, int], str],
    horizons: Sequence[int],
    refit: Callable[[DataFrame, str, int, str], PipelineModel],
    at_once: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Write what ``train_best_models`` promises; ``refit`` fits a winner of (task, horizon) on all labelled rows, ``at_once`` of them side by side."""
    spark, r = panel.sparkSession, roles.infer_roles(panel)

    def save(cell: tuple[int, str]) -> tuple[str, str]:
        horizon, task = cell
        label = roles.label_name(task, horizon)
        matrix = roles.training_matrix(panel, horizon, task, r)
        name = winners.get((task, horizon))
        if task == "classification" and (name is None or not _two_classes(matrix, label)):
            name = name or MAJORITY
            model = majority_model(matrix, label)
        else:
            model = refit(matrix, task, horizon, name)
        types = dict(matrix.dtypes)
        bundle = bundles.Bundle(task, horizon, name, r.features, [types[c] for c in r.features], model)
        return name, bundles.save_bundle(spark, model_dir, bundle)

    cells = [(h, t) for h in horizons for t in roles.TASKS]
    with ThreadPoolExecutor(at_once) as pool:
        saved = dict(zip(cells, pool.map(save, cells)))
    selected = [(h, *[saved[h, t][i] for i in (0, 1) for t in roles.TASKS]) for h in horizons]
    chosen = spark.createDataFrame(
        selected,
        "horizon int, best_regression_model string, best_classification_model string, "
        "regression_model_path string, classification_model_path string",
    )
    base = model_dir.rstrip("/")
    files.write_csv(scores.coalesce(1), f"{base}/benchmark_scores", "overwrite")
    files.write_csv(chosen.coalesce(1), f"{base}/selected_models", "overwrite")
    note = F.lit("direct forecast per horizon from the monthly panel").alias("note")
    record = chosen.agg(F.sort_array(F.collect_list(F.struct(*chosen.columns))).alias("selected_models"))
    files.write_json(record.select(note, "selected_models"), f"{base}/training_metadata", "overwrite")
    return scores, chosen


def predict_latest(
    panel: DataFrame, model_dir: str, horizons: Sequence[int] = fixed.HORIZONS
) -> DataFrame:
    """Price and direction of every series for each horizon, from the saved models.

    The driver holds one model at a time: what it says is written to the shared folder before the next is loaded.
    """
    spark: SparkSession = panel.sparkSession
    latest = panel.where("row_is_latest")
    out = None
    for horizon in horizons:
        rows = forecast.horizon_rows(latest, [horizon])
        for task, column in (("regression", "predicted_price"), ("classification", "predicted_direction")):
            bundle = bundles.load_bundle(spark, model_dir, horizon, task)
            base = rows.columns
            missing = [c for c in bundle.feature_cols if c not in base]
            ready = rows.withColumns({c: F.lit(None).cast(bundle.dtypes[c]) for c in missing}) if missing else rows
            rows = settle(bundle.model.transform(ready).select(*base, F.col("prediction").alias(column)), "predicted")
            del bundle, ready
        part = forecast.finish(rows)
        out = part if out is None else out.unionByName(part)
    return out
