"""Model training and scoring on Spark ML (MD1-MD20)."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import new_path, written
from .checks import error_metrics
from .order import quantiles


def feature_stages(num: list[str], cat: list[str]) -> list:
    """Median imputing, one-hot coding with unknowns, one vector ``features``."""
    stages = [Imputer(strategy="median", inputCols=num, outputCols=[f"{c}_i" for c in num])] if num else []
    if cat:
        stages += [StringIndexer(inputCols=cat, outputCols=[f"{c}_x" for c in cat], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_x" for c in cat], outputCols=[f"{c}_v" for c in cat], handleInvalid="keep")]
    return [*stages, VectorAssembler(inputCols=[f"{c}_i" for c in num] + [f"{c}_v" for c in cat], outputCol="features", handleInvalid="keep")]


def feature_pipeline(num: list[str], cat: list[str], estimator=None) -> Pipeline:
    return Pipeline(stages=[*feature_stages(num, cat), *([estimator] if estimator is not None else [])])


def _vectors(stages: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    """The rows' feature vectors, written: estimators pass over them dozens of times, in as many tasks as the table's size asks for."""
    return written(stages.transform(rows).select("features", *dict.fromkeys(keep)), "vectors")


def _labels(estimator) -> list[str]:
    """The columns that an estimator reads beside the features."""
    weight = estimator.getWeightCol() if estimator.isDefined("weightCol") else ""
    return [estimator.getLabelCol(), *([weight] if weight else [])]


def fit_pipeline(rows: DataFrame, num: list[str], cat: list[str], estimator) -> PipelineModel:
    """``feature_pipeline`` fitted stage by stage: the rows are read for the features only."""
    stages = feature_pipeline(num, cat).fit(rows)
    return PipelineModel([*stages.stages, estimator.fit(_vectors(stages, rows, _labels(estimator)))])


def without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model saved and read back: what tasks get of it are its parameters, not the training run's summary, which need not be serializable."""
    path = new_path(spark, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def candidates(label: str, weight: str | None = None, seed: int = 1) -> dict:
    """Ridge, boosted trees and random forest for a label."""
    extra = {"weightCol": weight} if weight else {}
    return {
        "ridge": LinearRegression(labelCol=label, regParam=0.1, elasticNetParam=0.0, **extra),
        "gbt": GBTRegressor(labelCol=label, maxIter=20, maxDepth=4, seed=seed, **extra),
        "rf": RandomForestRegressor(labelCol=label, numTrees=30, maxDepth=6, seed=seed, **extra),
    }


def clip_standardise(df: DataFrame, cols: list[str], train: Column, lo: float = 0.005, hi: float = 0.995) -> DataFrame:
    """Clip at the training rows' quantiles, then centre and scale by their population deviation."""
    d = df
    for c in cols:
        d = d.crossJoin(F.broadcast(quantiles(df.where(train), [], c, (lo, hi)).select(F.col("q").alias(f"__q_{c}"))))  # one row
    d = d.withColumns({c: F.when(F.col(c).isNotNull(), F.greatest(F.col(f"__q_{c}")[0], F.least(F.col(f"__q_{c}")[1], F.col(c)))) for c in cols})
    s = d.where(train).agg(*(F.avg(c).alias(f"__m_{c}") for c in cols), *(F.stddev_pop(c).alias(f"__s_{c}") for c in cols))
    z = {c: (F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(1.0) for c in cols}
    return d.crossJoin(F.broadcast(s)).withColumns(z).select(*df.columns)  # one row


def time_folds(df: DataFrame, ts: str, n: int) -> DataFrame:
    """``fold``: the block (0..n) of the row's date, of n + 1 blocks of equally many dates. Fold i validates in block i and trains before it.

    With fewer than 10 dates there are two blocks, 80 to 20.
    """
    dates = df.select(ts).where(F.col(ts).isNotNull()).distinct()
    ranked = dates.withColumn("__r", F.percent_rank().over(W.orderBy(ts)))  # one row per date
    size = dates.agg(F.count(F.lit(1)).alias("__n"))
    block = F.when(F.col("__n") < 10, (F.col("__r") >= 0.8).cast("int")).otherwise(F.least(F.floor(F.col("__r") * (n + 1)), F.lit(n)).cast("int"))
    return df.join(ranked.crossJoin(F.broadcast(size)).select(ts, block.alias("fold")), ts, "left")


def time_split(df: DataFrame, ts: str, q: float = 0.8) -> DataFrame:
    """``is_train``: dates up to the q-quantile of the rows' dates."""
    days = df.select(F.unix_date(F.col(ts).cast("date")).alias("__day"))
    cut = quantiles(days, [], "__day", (q,)).select(F.col("q")[0].alias("__cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("is_train", F.unix_date(F.col(ts).cast("date")) <= F.col("__cut")).drop("__cut")  # one row


def fold_predictions(df: DataFrame, label: str, options: dict[str, Callable[[DataFrame], Callable[[DataFrame], DataFrame]]], ts: str, folds: int = 3) -> DataFrame:
    """Every candidate's predictions of every validation block, each fitted on the blocks before it, written once.

    ``options``: name -> function that fits on rows and returns a function that adds ``prediction``.
    Adds ``fold`` and ``candidate`` to the labelled rows; what is compared later reads this table only.
    """
    placed = written(time_folds(df.where(F.col(label).isNotNull()), ts, folds), "folds")
    last, parts = placed.agg(F.max("fold")).first()[0] or 0, []
    for i in range(1, last + 1):
        before = placed.where(F.col("fold") < i)
        for name, fit in options.items():
            score = fit(before)
            parts.append(score(placed.where(F.col("fold") == i)).select(*placed.columns, F.lit(name).alias("candidate"), F.col("prediction").cast("double").alias("prediction")))
    return written(reduce(DataFrame.unionByName, parts), "predictions") if parts else placed.limit(0).withColumns({"candidate": F.lit(""), "prediction": F.lit(0.0)})


def fold_scores(predictions: DataFrame, label: str, weights: tuple[float, float, float] = (0.6, 0.3, 0.1)) -> tuple[DataFrame, DataFrame]:
    """Errors by candidate and fold; and ``(candidate, score, best)`` by mean MAE, mean WAPE and deviation of the MAEs."""
    errors = error_metrics(predictions, label, "prediction", None, ["candidate", "fold"])
    a, b, c = weights
    score = a * F.avg("mae") + b * F.avg(F.coalesce("wape", F.lit(0.0))) + c * F.stddev_pop("mae")
    scores = errors.groupBy("candidate").agg(score.alias("score"))
    return errors, scores.withColumn("best", F.row_number().over(W.orderBy("score", "candidate")) == 1)  # a row for each candidate


def target_metrics(scored: DataFrame, targets: dict[str, str], by: list[str], prefix: str = "pred_") -> DataFrame:
    """Weighted errors of several targets (name -> weight column) by segment, in one pass over the rows."""
    cells = F.array(*(F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y"), F.col(f"{prefix}{t}").cast("double").alias("p"), F.col(w).cast("double").alias("w")) for t, w in targets.items()))
    return error_metrics(scored.select(*by, F.inline(cells)), "y", "p", "w", ["target", *by])


def select_model(df: DataFrame, num: list[str], cat: list[str], label: str, options: dict, ts: str, folds: int = 3, weights: tuple[float, float, float] = (0.6, 0.3, 0.1)):
    """The candidate with the least MAE / WAPE / deviation score over forward folds, fitted on all rows; and the scores."""
    made: list = [None, None, None]  # the rows that the candidates are being fitted on, their stages and vectors

    def fit(rows: DataFrame, estimator) -> PipelineModel:
        if made[0] is not rows:
            stages = feature_pipeline(num, cat).fit(rows)
            made[:] = rows, stages, _vectors(stages, rows, [c for e in options.values() for c in _labels(e)])
        return PipelineModel([*made[1].stages, estimator.fit(made[2])])

    fits = {name: lambda rows, e=estimator: fit(rows, e).transform for name, estimator in options.items()}
    found = fold_scores(fold_predictions(df, label, fits, ts, folds), label, weights)[1].collect()  # a row for each candidate
    scores = {name: math.inf for name in options} | {r["candidate"]: r["score"] for r in found}
    best = min(scores, key=lambda k: (scores[k], k))
    return fit(df.where(F.col(label).isNotNull()), options[best]), best, scores


def train_per_level(df: DataFrame, level: str, num: list[str], cat: list[str], label: str, levels: list, constant: float, min_n: int = 20, seed: int = 1) -> Callable[[DataFrame], DataFrame]:
    """One model for each of a given list of levels; levels with fewer than ``min_n`` labelled rows, and all others, get the constant.

    The returned function scores: ``prediction`` and its source (``MODEL`` or ``CONSTANT``). The list is
    the domain's (its grades), so that the number of fits does not grow with the data.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(level).isin(levels))
    seen = {r[0]: r[1] for r in rows.groupBy(level).count().collect()}
    models = {v: fit_pipeline(rows.where(F.col(level) == v), num, cat, GBTRegressor(labelCol=label, maxIter=15, maxDepth=3, seed=seed)) for v in levels if seen.get(v, 0) >= min_n}

    def score(new: DataFrame) -> DataFrame:
        parts = [m.transform(new.where(F.col(level) == v)).select(*new.columns, "prediction", F.lit("MODEL").alias("prediction_source")) for v, m in models.items()]
        rest = new.where(F.col(level).isNull() | ~F.col(level).isin(list(models))) if models else new
        parts.append(rest.select("*", F.lit(float(constant)).alias("prediction"), F.lit("CONSTANT").alias("prediction_source")))
        return reduce(DataFrame.unionByName, parts)

    return score


def segment_fallback(df: DataFrame, history: DataFrame, segment: list[str], pred: str, y: str, constant: float, out: str = "value") -> DataFrame:
    """The prediction, else the segment's median of the history, else a constant; with the source's name."""
    found = df.join(history.groupBy(*segment).agg(F.median(y).alias("__m")), segment, "left")
    source = F.when(F.col(pred).isNotNull(), "MODEL").when(F.col("__m").isNotNull(), "SEGMENT").otherwise("CONSTANT")
    return found.withColumns({out: F.coalesce(pred, "__m", F.lit(float(constant))), f"{out}_source": source}).drop("__m")


def training_weight(total: str) -> Column:
    """Square root of the stems behind a row, in [0.2, 5]."""
    return F.greatest(F.lit(0.2), F.least(F.lit(5.0), F.sqrt(F.greatest(F.col(total), F.lit(0.0)))))


def train_target(df: DataFrame, num: list[str], cat: list[str], label: str, forward: Callable, inverse: Callable, bounds: tuple[float, float], weight: str | None = None, seed: int = 1) -> Callable[[DataFrame], DataFrame]:
    """Fit on ``forward`` of the label; the returned function scores: ``prediction`` is the clipped ``inverse``."""
    rows = df.withColumn("__t", forward(F.col(label))).where(F.col("__t").isNotNull() & ~F.isnan("__t"))
    extra = {"weightCol": weight} if weight else {}
    model = fit_pipeline(rows, num, cat, GBTRegressor(labelCol="__t", maxIter=20, maxDepth=4, seed=seed, **extra))
    return lambda new: model.transform(new).withColumn("prediction", F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), inverse(F.col("prediction")))))


def train_residual(df: DataFrame, num: list[str], cat: list[str], label: str, weight: str | None = None, seed: int = 1):
    """Robust (absolute loss) regressor of a residual."""
    extra = {"weightCol": weight} if weight else {}
    return fit_pipeline(df.where(F.col(label).isNotNull()), num, cat, GBTRegressor(labelCol=label, lossType="absolute", maxIter=20, maxDepth=3, seed=seed, **extra))


def best_threshold(scored: DataFrame, label: str, p: str, grid: int = 19) -> float:
    """The threshold of the largest F1; the smaller one on ties."""
    steps, y = [(i + 1) / (grid + 1) for i in range(grid)], F.col(label).cast("boolean")
    row = scored.agg(F.count_if(y), *(F.count_if(c) for t in steps for c in (F.col(p) >= t, (F.col(p) >= t) & y))).first()
    f1 = [2 * row[2 * i + 2] / max(row[2 * i + 1] + row[0], 1) for i in range(grid)]
    return max(zip(f1, [-t for t in steps], steps, strict=True))[2]


def gate_two_stage(df: DataFrame, num: list[str], cat: list[str], label: str, group: str, q: float = 0.8, seed: int = 1) -> Callable[[DataFrame], DataFrame]:
    """A gate (logistic, extreme = beyond the group's quantile) with an F1-tuned threshold, and one regressor on each side."""
    cut = quantiles(df, [group], label, (q,)).select(group, F.col("q")[0].alias("__cut"))
    rows = written(df.join(cut, group).withColumn("__y", (F.col(label) > F.col("__cut")).cast("double")), "gated")
    gate = without_summary(fit_pipeline(rows, num, cat, LogisticRegression(labelCol="__y", regParam=0.01, probabilityCol="__prob", rawPredictionCol="__raw", predictionCol="__gate")), df.sparkSession)
    probability = vector_to_array("__prob")[1]
    threshold = best_threshold(gate.transform(rows).withColumn("__p", probability), "__y", "__p")
    sides = {}
    for name, side in (("normal", 0.0), ("extreme", 1.0)):
        own = rows.where(F.col("__y") == side)
        sides[name] = fit_pipeline(rows if own.isEmpty() else own, num, cat, GBTRegressor(labelCol=label, maxIter=15, maxDepth=3, seed=seed, predictionCol=f"__{name}"))

    def score(new: DataFrame) -> DataFrame:
        helpers = ("features", *(f"{c}_i" for c in num), *(f"{c}_{t}" for c in cat for t in "xv"))
        out = gate.transform(new).withColumn("p_extreme", probability).drop("__prob", "__raw", "__gate", *helpers)
        for model in sides.values():
            out = model.transform(out).drop(*helpers)
        return out.withColumn("prediction", F.when(F.col("p_extreme") >= threshold, F.col("__extreme")).otherwise(F.col("__normal"))).drop("__extreme", "__normal")

    return score


def zero_inflated(df: DataFrame, num: list[str], cat: list[str], label: str, seed: int = 1) -> Callable[[DataFrame], DataFrame]:
    """Probability of a positive value times the expectation of positive ones."""
    rows = df.where(F.col(label).isNotNull()).withColumn("__y", (F.col(label) > 0).cast("double"))
    chance = fit_pipeline(rows, num, cat, GBTClassifier(labelCol="__y", maxIter=15, maxDepth=3, seed=seed, predictionCol="__cls").setProbabilityCol("__prob").setRawPredictionCol("__raw"))
    positive = rows.where("__y > 0")
    size = fit_pipeline(rows if positive.isEmpty() else positive, num, cat, GBTRegressor(labelCol=label, maxIter=15, maxDepth=3, seed=seed, predictionCol="__size"))
    helpers = ("features", *(f"{c}_i" for c in num), *(f"{c}_{t}" for c in cat for t in "xv"))

    def score(new: DataFrame) -> DataFrame:
        out = size.transform(chance.transform(new).withColumn("p_positive", vector_to_array("__prob")[1]).drop("__prob", "__raw", "__cls", *helpers)).drop(*helpers)
        return out.withColumn("prediction", F.col("p_positive") * F.greatest(F.col("__size"), F.lit(0.0))).drop("__size")

    return score


def benchmark_targets(df: DataFrame, targets: dict[str, str], num: list[str], cat: list[str], ts: str, q: float = 0.8):
    """Per target (name -> weight column) the candidate with the least validation MAE: ``{target: (name, model, maes)}``."""
    split = written(time_split(df, ts, q), "split")
    out = {}
    for target, weight in targets.items():
        rows = split.where(F.col(target).isNotNull() & (F.col(weight) > 0))
        stages = feature_pipeline(num, cat).fit(rows.where("is_train"))
        vectors = _vectors(stages, rows, [target, weight, "is_train"])
        models = {name: e.fit(vectors.where("is_train")) for name, e in candidates(target, weight).items()}
        maes = {name: error_metrics(m.transform(vectors.where("not is_train")), target, "prediction", weight).first()["mae"] for name, m in models.items()}
        fitted = {name: PipelineModel([*stages.stages, m]) for name, m in models.items()}
        best = min(maes, key=lambda k: (math.inf if maes[k] is None else maes[k], k))
        out[target] = (best, fitted[best], maes)
    return out


def predict_targets(df: DataFrame, winners: dict) -> DataFrame:
    """``pred_<target>`` of every winner, from one frame (MD13)."""
    out = df
    for target, (_, model, _) in winners.items():
        out = model.transform(out).withColumnRenamed("prediction", f"pred_{target}").select(*out.columns, f"pred_{target}")
    return out


def mask_outliers(df: DataFrame, x: str, weight: str, train: Column, lo: float = 0.01, hi: float = 0.99, min_n: int = 80) -> DataFrame:
    """Weight 0 outside the training rows' quantiles, if there are ``min_n`` of them."""
    q = quantiles(df.where(train & (F.col(weight) > 0)), [], x, (lo, hi)).select(F.col("q").alias("__q"), F.col("n").alias("__n"))
    out = (F.col("__n") >= min_n) & ~F.col(x).between(F.col("__q")[0], F.col("__q")[1])
    return df.crossJoin(F.broadcast(q)).withColumn(weight, F.when(out, F.lit(0.0)).otherwise(F.col(weight))).drop("__q", "__n")  # one row


def fit_shrinkage(df: DataFrame, base: str, corr: str, y: str, w: str, steps: int = 11) -> DataFrame:
    """One row ``gamma``: of 0, 0.1.. 1 the one of least weighted error of base + gamma corr."""
    rows = df.where(F.col(y).isNotNull()).select(base, corr, y, w, F.explode(F.array(*(F.lit(i / (steps - 1)) for i in range(steps)))).alias("g"))
    error = F.sum(F.col(w) * F.abs(F.col(base) + F.col("g") * F.col(corr) - F.col(y))) / F.sum(w)
    return rows.groupBy("g").agg(error.alias("e")).agg(F.min(F.struct("e", "g")).alias("b")).select(F.col("b.g").alias("gamma"), F.col("b.e").alias("mae"))


def apply_correction(df: DataFrame, base: str, corr: str, gamma: DataFrame, bounds: tuple[float, float], y: str | None = None, mode: str = "add", out: str = "final") -> DataFrame:
    """base with gamma times the correction, clipped; the base stays where the labelled rows' error would grow."""
    from ..functions.columns import apply_corr

    step = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), F.col("gamma") * F.col(corr)))
    d = df.crossJoin(F.broadcast(gamma.select("gamma"))).withColumn("__new", apply_corr(base, step, mode))  # one row
    if y is None:
        return d.withColumn(out, F.coalesce("__new", base)).drop("__new", "gamma")
    worse = d.agg((F.coalesce(F.avg(F.abs(F.col("__new") - F.col(y))), F.lit(0.0)) > F.coalesce(F.avg(F.abs(F.col(base) - F.col(y))), F.lit(0.0))).alias("__worse"))
    return d.crossJoin(F.broadcast(worse)).withColumn(out, F.when(F.col("__worse"), F.col(base)).otherwise(F.coalesce("__new", base))).drop("__new", "gamma", "__worse")  # one row


def coupled_predict(df: DataFrame, step: Callable[[DataFrame], DataFrame], values: list[str], max_rounds: int = 3, tol: float = 1e-3) -> DataFrame:
    """Repeat ``step`` (which recomputes ``values``) until no value changes by more than ``tol``, relatively. Each round is checkpointed."""
    now = df
    for _ in range(max_rounds):
        old = now.withColumns({f"__{v}": F.col(v) for v in values})
        new = step(old)
        if df.sparkSession.sparkContext.getCheckpointDir():
            new = new.checkpoint()
        change = F.greatest(*(F.coalesce(F.max(F.abs(F.col(v) - F.col(f"__{v}")) / F.greatest(F.abs(F.col(f"__{v}")), F.lit(1e-9))), F.lit(0.0)) for v in values), F.lit(0.0))
        done = new.agg(change.alias("c")).first()["c"] <= tol
        now = new.drop(*(f"__{v}" for v in values))
        if done:
            break
    return now


def feature_f_test(df: DataFrame, ys: list[str], xs: list[str]) -> DataFrame:
    """``(target, feature, n, r, f, near_constant)`` with F = r^2 / (1 - r^2) (n - 2)."""
    long = df.select(*ys, F.inline(F.array(*(F.struct(F.lit(x).alias("feature"), F.col(x).cast("double").alias("x")) for x in xs))))
    long = long.select("feature", "x", F.inline(F.array(*(F.struct(F.lit(y).alias("target"), F.col(y).cast("double").alias("y")) for y in ys)))).where("x is not null and y is not null")
    stats = long.groupBy("target", "feature").agg(F.count(F.lit(1)).alias("n"), F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("r"), (F.coalesce(F.var_pop("x"), F.lit(0.0)) < 1e-12).alias("near_constant"))
    r2 = F.col("r") * F.col("r")
    return stats.withColumn("f", F.when((r2 < 1) & (F.col("n") > 2), r2 / (1 - r2) * (F.col("n") - 2)))


def ols_hc3(df: DataFrame, y: str, xs: list[str]) -> dict[str, tuple[float, float]]:
    """``{name: (coefficient, HC3 standard error)}`` with an intercept; only p x p sums come to the driver."""
    names = ["intercept", *xs]
    ok = df.select(F.lit(1.0).alias("intercept"), *(F.col(x).cast("double").alias(x) for x in xs), F.col(y).cast("double").alias("__y")).na.drop()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]

    def gram(weight: Column) -> np.ndarray:
        row = ok.agg(*(F.sum(F.col(names[i]) * F.col(names[j]) * weight) for i, j in pairs)).first()
        m = np.zeros((len(names), len(names)))
        for (i, j), v in zip(pairs, row, strict=True):
            m[i, j] = m[j, i] = v
        return m

    inverse = np.linalg.pinv(gram(F.lit(1.0)))
    xy = np.array(ok.agg(*(F.sum(F.col(n) * F.col("__y")) for n in names)).first(), dtype=float)
    beta = inverse @ xy
    fitted = sum((F.lit(float(b)) * F.col(n) for b, n in zip(beta, names, strict=True)), F.lit(0.0))
    leverage = sum((F.lit(float(inverse[i, j]) * (1 if i == j else 2)) * F.col(names[i]) * F.col(names[j]) for i, j in pairs), F.lit(0.0))
    scaled = (F.col("__y") - fitted) / F.greatest(1 - leverage, F.lit(1e-9))
    meat = gram(scaled * scaled)
    errors = np.sqrt(np.diag(inverse @ meat @ inverse))
    return {n: (float(b), float(e)) for n, b, e in zip(names, beta, errors, strict=True)}
