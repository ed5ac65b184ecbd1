"""Queries over the daily base, the monthly panel, profiles, folds, scores and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from seriesmill import fixed
from seriesmill.functions import dates
from seriesmill.operators import (
    daily, elastic_net, extra_trees, features, fold_stats, folds, forecast, grid, metrics, models, panel, profile, roles,
)
from seriesmill.plans import standins as st
from seriesmill.session import fresh_dir, settle, settle_compact
from seriesmill.sources import files, star

SERIES = ["region_id", "rice_id"]
PRICE_PLACES = 3
# small models for the checks; the library defaults are the published sizes
SMALL = models.ModelSettings(trees=10, wide_trees=10, boosts=5, depth=5, net_steps=50, logit_steps=50)


# --- daily layer ---------------------------------------------------------------------


def _star(spark, sf) -> dict[str, DataFrame]:
    return star.clean_tables(st.star(spark, sf))


def _base(spark, sf) -> DataFrame:
    return daily.daily_model_base(_star(spark, sf), "row_key", fert_ids=st.FERT_IDS)


def _monthly(spark, sf) -> DataFrame:
    """Monthly prices and measures without dimension columns: what most panel queries need."""
    facts = daily.daily_facts(star.clean_fact(st.fact(spark, sf)), "row_key", fert_ids=st.FERT_IDS)
    return panel.monthly_aggregate(facts)


def _panel(spark, sf) -> DataFrame:
    return panel.monthly_panel(_base(spark, sf))


def profile_shape(spark, sf) -> DataFrame:
    return profile.shapes(st.star(spark, sf))


def daily_context(spark, sf) -> DataFrame:
    return st.rounded(daily.daily_context(star.clean_fact(st.fact(spark, sf)), "row_key"))


def daily_target(spark, sf) -> DataFrame:
    return st.rounded(daily.daily_target(star.clean_fact(st.fact(spark, sf))), PRICE_PLACES)


def fert_wide(spark, sf) -> DataFrame:
    return st.rounded(daily.fertilizer_wide(star.clean_fact(st.fact(spark, sf)), st.FERT_IDS))


def daily_base(spark, sf) -> DataFrame:
    return st.rounded(_base(spark, sf), PRICE_PLACES)


# --- monthly panel -------------------------------------------------------------------


def monthly_agg(spark, sf) -> DataFrame:
    return st.rounded(panel.monthly_aggregate(_base(spark, sf)), PRICE_PLACES)


def monthly_mode(spark, sf) -> DataFrame:
    facts = star.clean_fact(st.fact(spark, sf)).where("region_id IS NOT NULL")
    months = facts.withColumn("month", dates.month_start(F.col("date_id")))
    return panel.frequent_value(months, ["month", "region_id"], "eco_id")


def _with(spark, sf, columns, keep=("price_rice",)) -> DataFrame:
    return _monthly(spark, sf).select("date_id", *SERIES, *keep, *[c.alias(n) for n, c in columns.items()])


def calendar_features(spark, sf) -> DataFrame:
    return st.rounded(_with(spark, sf, panel.calendar_columns(), keep=()))


def target_lags(spark, sf) -> DataFrame:
    return st.rounded(_with(spark, sf, panel.target_lag_columns()), PRICE_PLACES)


def _measures() -> list[str]:
    return [*fixed.CONTEXT_MEASURES, *[f"{fixed.FERT_PREFIX}{f}" for f in st.FERT_IDS]]


def feature_lags(spark, sf) -> DataFrame:
    return st.rounded(_with(spark, sf, panel.feature_lag_columns(_measures())), PRICE_PLACES)


def rolling_mean(spark, sf) -> DataFrame:
    cols = panel.rolling_columns(["price_rice", *_measures()], stats=("mean",))
    return st.rounded(_with(spark, sf, cols), PRICE_PLACES)


def rolling_std(spark, sf) -> DataFrame:
    cols = panel.rolling_columns(["price_rice", *_measures()], stats=("std",))
    return st.rounded(_with(spark, sf, cols), PRICE_PLACES)


def diff_pct(spark, sf) -> DataFrame:
    return st.rounded(_with(spark, sf, panel.change_columns()), PRICE_PLACES)


def lead_targets(spark, sf) -> DataFrame:
    cols = {n: c for n, c in panel.target_columns().items() if n.startswith("target")}
    return st.rounded(_with(spark, sf, cols), PRICE_PLACES)


def direction_labels(spark, sf) -> DataFrame:
    cols = {n: c for n, c in panel.target_columns().items() if n.startswith("direction")}
    return _with(spark, sf, cols, keep=())


def latest_row(spark, sf) -> DataFrame:
    facts = star.clean_fact(st.fact(spark, sf)).where("region_id IS NOT NULL AND price_rice IS NOT NULL")
    rows = panel.latest_rows(
        facts.select("region_id", "rice_id", "date_id", "row_key", "price_rice"), SERIES, "date_id", ["row_key"]
    )
    return rows


def monthly_panel(spark, sf) -> DataFrame:
    return st.rounded(_panel(spark, sf), PRICE_PLACES)


def training_matrix(spark, sf) -> DataFrame:
    return st.rounded(roles.training_matrix(_panel(spark, sf), 1, "classification"), PRICE_PLACES)


def align_columns(spark, sf) -> DataFrame:
    latest = _panel(spark, sf).where("row_is_latest")
    wanted = ["date_id", *SERIES, "price_rice", "price_rice_lag_1", "price_fert_Z", "region_name"]
    return st.rounded(roles.align_columns(latest, wanted), PRICE_PLACES)


def infer_roles(spark, sf) -> DataFrame:
    p = _panel(spark, sf)
    found = roles.infer_roles(p)
    counts = profile.nonnull_counts(p, found.features)
    role = F.when(F.col("column_name").isin(found.categorical), "categorical").otherwise("numeric")
    return counts.withColumn("role", role)


# --- profiles ------------------------------------------------------------------------


def series_length(spark, sf) -> DataFrame:
    return profile.series_lengths(_monthly(spark, sf), SERIES)


def value_counts(spark, sf) -> DataFrame:
    return profile.value_counts(daily.daily_target(star.clean_fact(st.fact(spark, sf))), "rice_id")


def nonnull_profile(spark, sf) -> DataFrame:
    return profile.nonnull_counts(star.clean_fact(st.fact(spark, sf)))


def corr_with_target(spark, sf) -> DataFrame:
    wide = _with(spark, sf, panel.target_lag_columns(), keep=("price_rice", *_measures()))
    candidates = [*_measures(), *panel.target_lag_columns()]
    return st.rounded(profile.correlations(wide, "price_rice", candidates))


# --- folds, baseline scores and choice -----------------------------------------------


def expanding_folds(spark, sf) -> DataFrame:
    monthly = settle(_monthly(spark, sf).select("date_id", *SERIES), "monthly")  # read for the folds and for the members
    members = folds.with_folds(monthly.select("date_id", *SERIES), folds.expanding_folds(monthly))
    return members.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date_id").alias("first_month"),
        F.max("date_id").alias("last_month"),
    )


def _baseline_rows(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Validation rows of every horizon with the guesses of simple rules."""
    cols = {
        **panel.rolling_columns(["price_rice"], stats=("mean",)),
        **panel.change_columns(),
        **panel.target_columns(),
    }
    p = settle(_with(spark, sf, cols), "baseline")
    price, moved = F.col("price_rice"), F.col("price_rice_diff_1")
    mean3 = F.col("price_rice_roll_mean_3")
    rules = {
        "regression": {"last_value": price, "mean_3": mean3, "mean_6": F.col("price_rice_roll_mean_6")},
        "classification": {
            "repeat_move": F.when(moved > 0, 1.0).otherwise(0.0),
            "back_to_mean": F.when(price < mean3, 1.0).otherwise(0.0),
        },
    }
    out = {}
    for task, guesses in rules.items():
        parts = []
        for h in fixed.HORIZONS:
            label = roles.label_name(task, h)
            known = p.where(F.col(label).isNotNull())
            held = folds.with_folds(known, folds.expanding_folds(known).where("role = 'valid'"))
            guess = F.explode(
                F.array(*[F.struct(F.lit(n).alias("model_name"), c.alias("guess")) for n, c in guesses.items()])
            )
            parts.append(
                held.select(F.lit(h).alias("horizon"), "fold", F.col(label).alias("truth"), guess.alias("g"))
                .select(F.lit(task).alias("task"), "horizon", "g.model_name", "fold", "truth", "g.guess")
            )
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        out[task] = rows
    return out["regression"], out["classification"]


GROUP = ["task", "horizon", "model_name", "fold"]


def reg_metrics(spark, sf) -> DataFrame:
    rows, _ = _baseline_rows(spark, sf)
    return st.rounded(metrics.regression_metrics(rows, "truth", "guess", GROUP), PRICE_PLACES)


def cls_accuracy(spark, sf) -> DataFrame:
    _, rows = _baseline_rows(spark, sf)
    return st.rounded(metrics.accuracy(rows, "truth", "guess", GROUP))


def _scores(spark, sf) -> DataFrame:
    reg, cls = _baseline_rows(spark, sf)
    return metrics.union_scores(
        metrics.regression_metrics(reg, "truth", "guess", GROUP), metrics.accuracy(cls, "truth", "guess", GROUP)
    )


def score_union(spark, sf) -> DataFrame:
    return st.rounded(_scores(spark, sf), PRICE_PLACES)


def score_summary(spark, sf) -> DataFrame:
    return st.rounded(metrics.score_summary(_scores(spark, sf)), PRICE_PLACES)


def best_model(spark, sf) -> DataFrame:
    return metrics.best_models(score_summary(spark, sf))


def majority_class(spark, sf) -> DataFrame:
    labelled = _with(spark, sf, panel.target_columns())
    return metrics.majority_class(labelled, "direction_t_plus_1", ["rice_id"])


# --- features ------------------------------------------------------------------------


def _gappy_lines(spark, sf) -> DataFrame:
    key = F.col("l_orderkey")
    return st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.when(key % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(key % 3 != 0, F.col("l_returnflag")).alias("l_returnflag"),
    )


def impute_median(spark, sf) -> DataFrame:
    return st.rounded(features.impute_median(_gappy_lines(spark, sf), ["l_quantity", "l_extendedprice"]))


def impute_mode(spark, sf) -> DataFrame:
    return features.impute_mode(_gappy_lines(spark, sf), ["l_returnflag"]).select(
        "l_orderkey", "l_partkey", "l_returnflag"
    )


def _known_and_all(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = st.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rows.where(F.col("o_orderpriority") != "3-MEDIUM"), rows


def one_hot(spark, sf) -> DataFrame:
    known, rows = _known_and_all(spark, sf)
    hot = vector_to_array("o_orderpriority_hot")
    return features.one_hot(rows, known, ["o_orderpriority"]).select(
        "o_orderkey",
        F.size(hot).alias("width"),
        (F.array_position(hot, F.lit(1.0)) - 1).cast("int").alias("hot_at"),
    )


def ordinal_encode(spark, sf) -> DataFrame:
    known, rows = _known_and_all(spark, sf)
    return features.ordinal_codes(rows, known, "o_orderpriority", "code").select("o_orderkey", "code")


def standardize(spark, sf) -> DataFrame:
    rows = st.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return st.rounded(features.standardize(rows, ["l_quantity", "l_extendedprice"]))


# --- forecasts -----------------------------------------------------------------------


def forecast_calendar(spark, sf) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    months = st.table(spark, sf, "orders").select(
        "o_orderkey", day.alias("day"), F.explode(F.array(*map(F.lit, fixed.HORIZONS))).alias("horizon")
    )
    ahead = dates.forecast_month(F.col("day"), F.col("horizon"))
    return months.select(
        "o_orderkey", "horizon", ahead.alias("forecast_month"),
        dates.month_label(ahead).alias("label"), F.year(ahead).alias("year"), F.month(ahead).alias("month"),
    )


def forecast_export(spark, sf) -> DataFrame:
    return forecast.export(forecast.last_value_forecast(st.rounded(_panel(spark, sf), PRICE_PLACES)))


def forecast_sink(spark, sf) -> DataFrame:
    """The report layout as it is read back from its CSV file, which a second run replaces."""
    made = forecast.last_value_forecast(st.rounded(_panel(spark, sf), PRICE_PLACES))
    folder = fresh_dir(spark, "forecast")
    forecast.write_forecast(made.limit(0), folder)
    forecast.write_forecast(made, folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in forecast.export(made).schema)
    return files.read_csv(spark, f"{folder}/forecast_export", schema)


# --- every fold and horizon from one read ----------------------------------------------


FOLD_SPLIT = (fixed.MIN_TRAIN_MONTHS, fixed.VALID_MONTHS, fixed.MAX_SPLITS, 0)


def _fold_panel(spark, sf) -> DataFrame:
    columns = {**panel.target_lag_columns(), **panel.target_columns()}
    return settle(_with(spark, sf, columns, keep=("price_rice", *_measures())), "fold-panel")


def fold_statistics(spark, sf) -> DataFrame:
    """Median, mean and deviation after filling, per horizon, fold and column: what a fold's preparation learns."""
    p = _fold_panel(spark, sf)
    plan, r = fold_stats.plan_folds(p, "regression", fixed.HORIZONS, *FOLD_SPLIT), roles.infer_roles(p)
    rows = settle(fold_stats.fold_rows(p, plan, r), "fold-rows")
    medians = fold_stats.fold_medians(rows, r.numeric, plan.keys())
    moments = fold_stats.fold_moments(rows, medians)
    found = [(h, f, c, m, *moments[h, f][c]) for (h, f), known in medians.items() for c, m in known.items()]
    return st.rounded(spark.createDataFrame(found, "horizon int, fold int, column_name string, median double, mean double, dev double"), 3)


def fold_modes(spark, sf) -> DataFrame:
    """Most frequent calendar and series texts per horizon and fold, from the classification rows."""
    series = {"rice": F.col("rice_id"), "region": F.col("region_id").cast("string"), "month_text": F.when(F.month("date_id") != 3, F.date_format("date_id", "MM"))}
    p = settle(_with(spark, sf, {**panel.target_columns(), **series}), "fold-texts")
    plan, r = fold_stats.plan_folds(p, "classification", fixed.HORIZONS, *FOLD_SPLIT), roles.infer_roles(p)
    rows = settle(fold_stats.fold_rows(p, plan, r), "fold-rows")
    return fold_stats.fold_modes(rows, r.categorical, plan).select("horizon", "fold", F.col("c").alias("column_name"), F.col("v").alias("text"), F.col("n").alias("n_rows"))


def elastic_net_folds(spark, sf) -> DataFrame:
    """Elastic nets of all folds and horizons at the published settings: rows, whether each is at its optimum, and whether it holds the mean."""
    p = _fold_panel(spark, sf)
    nets = elastic_net.FoldElasticNet(p, fold_stats.plan_folds(p, "regression", fixed.HORIZONS, *FOLD_SPLIT))
    fitted = spark.createDataFrame([(m.horizon, m.fold, m.train_rows, m.gap <= 1e-6) for m in nets.models.values()], "horizon int, fold int, train_rows long, optimal boolean")
    held = nets.predictions().groupBy("horizon", "fold").agg(F.count("prediction").alias("valid_rows"), F.avg("y").alias("valid_mean"))
    return st.rounded(fitted.join(held, ["horizon", "fold"]), PRICE_PLACES)


def extra_trees_level(spark, sf) -> DataFrame:
    """First split of each of 25 extremely randomised trees on measures and price lags (absent ones as 0), for the next month's price."""
    p = _fold_panel(spark, sf).where("target_t_plus_1 IS NOT NULL")
    names = [*_measures(), *panel.target_lag_columns()]
    x = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names])
    made = extra_trees.grow(p.select(x.alias("x"), F.col("target_t_plus_1").cast("double").alias("y")), len(names), 25, 2, 1, 42)
    found = []
    for tree in range(25):
        left, right = (made.stats[made.left[tree] + i] for i in (0, 1))
        found.append((tree, names[made.feature[tree]], float(made.cut[tree]), int(left[0]), int(right[0]), left[1] / left[0], right[1] / right[0]))
    schema = "tree int, column_name string, cut double, n_left long, n_right long, mean_left double, mean_right double"
    return st.rounded(spark.createDataFrame(found, schema), 3)


# --- models --------------------------------------------------------------------------


def _fit_scores(spark, sf, task: str) -> DataFrame:
    """Every model family fitted on all labelled months but the last six, scored on those."""
    p = _panel(spark, sf)
    r, label = roles.infer_roles(p), roles.label_name(task, 1)
    matrix = settle_compact(roles.training_matrix(p, 1, task, r), "fit")
    cut = F.add_months(F.lit(matrix.agg(F.max("date_id")).first()[0]), -6)
    train, held = matrix.where(F.col("date_id") <= cut), matrix.where(F.col("date_id") > cut)
    out, learned = None, features.learn(train, r.numeric, r.categorical)
    for name, recipe in models.recipes(task, SMALL).items():
        scored = models.fit_model(train, recipe, r, label, learned).transform(held)
        if task == "regression":
            m = metrics.regression_metrics(scored, label, "prediction")
        else:
            m = metrics.accuracy(scored, label, "prediction")
        part = m.select(F.lit(name).alias("model_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def fit_regressors(spark, sf) -> DataFrame:
    return _fit_scores(spark, sf, "regression")


def fit_classifiers(spark, sf) -> DataFrame:
    return _fit_scores(spark, sf, "classification")


FEW = {
    "regression": ["elastic_net", "random_forest"],
    "classification": ["logistic_regression", "gradient_boosting_cls"],
}


def evaluate_horizon(spark, sf) -> DataFrame:
    return models.evaluate_horizon(settle(_panel(spark, sf), "panel"), 1, max_splits=2, settings=SMALL, models=FEW)


def train_select(spark, sf) -> DataFrame:
    _, chosen = models.train_best_models(
        _panel(spark, sf), fresh_dir(spark, "models"), [1], SMALL, FEW, max_splits=1
    )
    return chosen.select("horizon", "best_regression_model", "best_classification_model")


def forecast_frame(spark, sf) -> DataFrame:
    """Forecasts of all horizons by the best of all families over six folds, at the published sizes."""
    p = settle_compact(_panel(spark, sf), "panel")
    folder = fresh_dir(spark, "models")
    grid.train_best_models(p, folder)
    return models.predict_latest(p, folder)


QUERIES = [
    profile_shape, daily_context, daily_target, fert_wide, daily_base, monthly_agg, monthly_mode,
    calendar_features, target_lags, feature_lags, rolling_mean, rolling_std, diff_pct, lead_targets,
    direction_labels, latest_row, monthly_panel, training_matrix, align_columns, infer_roles,
    series_length, value_counts, nonnull_profile, corr_with_target, expanding_folds, reg_metrics,
    cls_accuracy, score_union, score_summary, best_model, majority_class, impute_median, impute_mode,
    one_hot, ordinal_encode, standardize, forecast_calendar, forecast_export, forecast_sink,
    fold_statistics, fold_modes, elastic_net_folds, extra_trees_level, fit_regressors,
    fit_classifiers, evaluate_horizon, train_select, forecast_frame,
]
