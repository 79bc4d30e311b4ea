"""Demand forecasting models on the daily series.

Features are lags / lagged SMAs of the target built with the series
windows; models are the boosted trees of ``boosting`` and Spark ML's decision
tree; validation uses *expanding* time-series folds (train strictly before
test).  ``CrossValidator`` is not used here because even with ``foldCol`` it
trains on every other fold, i.e. on the future.  All folds (and draws) of a
frame grow together.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import boosting, series

DAY = series.DAY

# The published lags (days) of the demand features, the window of the
# target's moving average, the search grid and the final model.
FEATURE_LAGS = {"total_unique_item": 6, "refund_sales": 12, "free_qty": 16, "total_sales": 6}
LABEL_LAG, LABEL_LAGS = 6, {"cluster_3": 12}
SMA_WINDOW = 7
SEARCH_CHOICES = {"rounds": [100, 200, 300, 400, 500], "rate": [0.01, 0.05, 0.1, 0.2, 0.3], "leaves": [10, 20, 30, 40, 50],
                  "depth": [5, 10, 15, 20, 25]}
FINAL_PARAMS = boosting.Params(rounds=1000, rate=0.01, depth=10, leaves=100)
PLAIN_PARAMS = boosting.Params(rounds=100, rate=0.1, depth=31, leaves=31)      # a depth that 31 leaves never reach


def _doubles(daily: DataFrame, columns: list[str]) -> DataFrame:
    return daily.select(DAY, *[F.col(c).cast("double").alias(c) for c in columns])


def _others(daily: DataFrame, target: str) -> list[str]:
    """The daily columns beside the target."""
    return [c for c in daily.columns if c not in (DAY, target)]


def lag_frame(daily: DataFrame, target: str, lags: list[int], others: list[str] | None = None) -> DataFrame:
    """W6 features: the target, and each column of ``others``, lagged by each n
    in ``lags``; rows whose features are incomplete (the first max(lags) days)
    are dropped (F14).  ``others`` are lagged too: their values of the same day
    tell the target's."""
    others = others or []
    d = series.add_lags(_doubles(daily, [target, *others]), {c: lags for c in (target, *others)})
    return d.drop(*others).na.drop("any")


def lagged_sma_frame(daily: DataFrame, target: str, window: int, others: list[str] | None = None) -> DataFrame:
    """W8 features: SMA over ``window`` days shifted by ``window`` days, and the
    columns of ``others`` shifted alike."""
    others = others or []
    d = series.add_sma(_doubles(daily, [target, *others]), target, [window], lagged=True, digits=10)
    return series.add_lags(d, {c: [window] for c in others}).drop(*others).na.drop("any")


def demand_features(daily: DataFrame, label_prefix: str = "cluster_") -> DataFrame:
    """The feature matrix of M23: the target ``total_qty`` with each daily column, and each
    count of a customer label, lagged by its own number of days, the lagged moving average
    of the sales, the calendar and (where ``daily`` has it) the holiday flag, which are known
    ahead and not lagged.  The first days keep their rows; what they lack is null."""
    labels = [c for c in daily.columns if c.startswith(label_prefix)]
    known = [c for c in ("is_holiday",) if c in daily.columns]
    lags = {**FEATURE_LAGS, **{c: LABEL_LAGS.get(c, LABEL_LAG) for c in labels}}
    d = daily.select(DAY, *[F.col(c).cast("double").alias(c) for c in ("total_qty", *lags, *known)])
    d = series.add_sma(d, "total_sales", [SMA_WINDOW], lagged=True, digits=10)
    d = series.add_lags(d, {c: [n] for c, n in lags.items()}).drop(*lags)
    return series.calendar_features(d).drop("day_name")


def _features(frame: DataFrame, label: str) -> list[str]:
    return [c for c in frame.columns if c not in (DAY, label)]


def with_parts(frame: DataFrame, n_splits: int) -> DataFrame:
    """The frame with ``_part``: 0 for the days before the first test window, k for the days
    of the k-th one (W12)."""
    n = frame.agg(F.count(F.lit(1)).alias("_n"))                       # one row
    size = F.floor(F.col("_n") / (n_splits + 1))
    part = F.floor((F.col("t") - (F.col("_n") - n_splits * size)) / F.when(size > 0, size)) + 1
    return (series.with_row_index(frame).crossJoin(F.broadcast(n))
            .withColumn("_part", F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)).cast("int")).drop("t", "_n"))


def _boosted_scores(frame: DataFrame, label: str, features: list[str], n_splits: int, params: boosting.Params, seed: int = 0):
    """(fold, r2, rmse, mae) of every fold, all of them grown together."""
    data = boosting.binned(with_parts(frame, n_splits), features, label, DAY, False, fold="_part", seed=seed)
    fits = [boosting.Fit(params, k, k - 1, seed) for k in range(1, n_splits + 1)]
    found = [boosting.measures(0, c) for _, c in boosting.grow(data, fits, False)]
    return [(k, m["r2"], m["rmse"], m["mae"]) for k, m in enumerate(found)]


def with_folds(frame: DataFrame, n_splits: int) -> DataFrame:
    """The frame joined to its fold roles, written once (parquet lineage cut):
    every fit below re-reads it many times."""
    from sparkmart.session import reliable_checkpoint
    folds = series.time_series_folds(frame.select(DAY), n_splits)
    return reliable_checkpoint(frame.join(folds, DAY))


def _score_fold(data: DataFrame, f: int, label: str, features: list[str], params: dict | None, seed: int):
    """One fold of a Spark ML decision tree."""
    part = VectorAssembler(inputCols=features, outputCol="features").transform(data.filter(F.col("fold") == f))
    train, test = part.filter(F.col("role") == "train"), part.filter(F.col("role") == "test")
    tree = DecisionTreeRegressor(featuresCol="features", labelCol=label, seed=seed)
    pred = tree.copy({getattr(tree, k): v for k, v in (params or {}).items()}).fit(train).transform(test)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return (f, ev.setMetricName("r2").evaluate(pred), ev.setMetricName("rmse").evaluate(pred),
            ev.setMetricName("mae").evaluate(pred))


def fold_scores(frame: DataFrame, label: str, features: list[str], kind: str = "tree", n_splits: int = 5,
                params=None, seed: int = 0, parallelism: int = 8) -> list[tuple]:
    """Expanding-window CV: (fold, r2, rmse, mae).  ``kind``: "tree" (params: Spark ML names)
    or "boosted" (params: ``boosting.Params``)."""
    if kind == "boosted":
        return _boosted_scores(frame, label, features, n_splits, params or PLAIN_PARAMS, seed)
    if kind != "tree":
        raise ValueError(kind)
    data = with_folds(frame, n_splits)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda f: _score_fold(data, f, label, features, params, seed), range(n_splits)))


def _mean_scores(spark, jobs: list[tuple], names: str, keys: list[str]) -> DataFrame:
    """``jobs``: (key values, frame, label, features, kind, n_splits).  Frames are validated
    concurrently; a row of mean scores for each."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        found = list(pool.map(lambda j: [(*j[0], *s[1:]) for s in fold_scores(*j[1:5], n_splits=j[5])], jobs))
    df = spark.createDataFrame([r for rows in found for r in rows], f"{names}, r2 double, rmse double, mae double")
    return df.groupBy(*keys).agg(F.avg("r2").alias("r2"), F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))


def lag_cross_validation(daily: DataFrame, target: str = "total_qty", lag_sets=((3,), (6,), (9,), (12,)),
                         kinds=("tree", "boosted"), n_splits: int = 5) -> DataFrame:
    """Mean fold scores for each model kind and lag set; all columns of
    ``daily`` are features, lagged."""
    others = _others(daily, target)
    jobs = []
    for lags in lag_sets:
        frame = lag_frame(daily, target, list(lags), others)
        feats = [f"{c}_lag{n}" for c in (target, *others) for n in lags]
        jobs += [((kind, ",".join(map(str, lags))), frame, target, feats, kind, n_splits) for kind in kinds]
    return _mean_scores(daily.sparkSession, jobs, "model string, lags string", ["model", "lags"])


def sma_cross_validation(daily: DataFrame, target: str = "total_qty", windows=range(1, 16), kind: str = "boosted",
                         n_splits: int = 5) -> DataFrame:
    """Mean fold scores of the boosted model for each lagged-SMA window,
    with the other columns of ``daily`` lagged by as many days."""
    others = _others(daily, target)
    jobs = [((int(w),), lagged_sma_frame(daily, target, w, others), target, [f"{target}_lag_sma{w}", *[f"{c}_lag{w}" for c in others]],
             kind, n_splits) for w in windows]
    return _mean_scores(daily.sparkSession, jobs, "window int", ["window"])


def random_search(frame: DataFrame, label: str, features: list[str] | None = None, n_draws: int = 100, n_splits: int = 10,
                  seed: int = 0, choices: dict[str, list] | None = None, base: boosting.Params = boosting.Params(),
                  halving: int | None = None) -> boosting.Search:
    """Random search of boosted trees on expanding folds by mean squared error; all
    draws and folds grow together."""
    data = boosting.binned(with_parts(frame, n_splits), features or _features(frame, label), label, DAY, False, fold="_part", seed=seed)
    return boosting.search(data, boosting.draws(choices or SEARCH_CHOICES, n_draws, seed, base), n_splits, "rmse", False,
                           expanding=True, halving=halving, seed=seed)


def search_table(spark, found: boosting.Search) -> DataFrame:
    """The draws as they were last grown with their mean scores, best first (a row for each)."""
    rows = [(i + 1, p.rounds, p.rate, p.leaves, p.depth, m["rmse"], m["mae"]) for i, (p, m) in enumerate(found.scores)]
    return spark.createDataFrame(rows, "rank int, rounds int, rate double, leaves int, depth int, rmse double, mae double")


def fit_and_score(frame: DataFrame, target: str, params: boosting.Params = FINAL_PARAMS, train_fraction: float = 0.8,
                  seed: int = 0) -> DataFrame:
    """Fit the final model on the first 80 % of days of a frame (the target and its
    features), score the rest (RMSE, MAPE) next to the train-mean baseline."""
    from sparkmart.session import reliable_checkpoint
    feats = _features(frame, target)
    data = reliable_checkpoint(series.chronological_split(frame, train_fraction))
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    model = boosting.fit(train, feats, target, DAY, params, False, seed)
    model_m = series.forecast_metrics(model.transform(test), target, "prediction").withColumn("model", F.lit("boosted"))
    mean = train.agg(F.avg(target).alias("prediction"))
    base = series.forecast_metrics(test.crossJoin(F.broadcast(mean)), target, "prediction") \
        .withColumn("model", F.lit("train_mean"))
    return model_m.unionByName(base)
