"""Queries for feature preparation, folds, corrections, diagnostics and fitted models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import grids, linear, ml
from ..sources.shared import written
from .base import DAILY, LINES, daily, lines, long, r6, table
from .registry import query


@query("md1_feature_pipeline", """WITH k AS (SELECT count(DISTINCT c_mktsegment) AS k FROM customer) SELECT c_custkey, (k + 2)::BIGINT AS n_features, CASE WHEN c_custkey % 10 > 0 THEN c_acctbal END AS balance, 1::BIGINT AS n_hot FROM customer, k""")
def md1(spark, sf):
    """The imputed balance is the stages' approximate median; the known ones pass through."""
    c = table(spark, sf, "customer").withColumn("b", F.when(F.col("c_custkey") % 10 > 0, F.col("c_acctbal")))
    out = ml.feature_pipeline(["b"], ["c_mktsegment"]).fit(c).transform(c).withColumn("v", vector_to_array("features"))
    hot = F.aggregate(F.slice("v", 2, 100), F.lit(0.0), lambda a, x: a + x)
    return out.select("c_custkey", long(F.size("v"), "n_features"), F.when(F.col("b").isNotNull(), F.get("v", F.lit(0))).alias("balance"), long(hot, "n_hot"))


@query("md2_clip_standardise", """WITH t AS (SELECT *, p_partkey % 4 > 0 AS train FROM part), q AS (SELECT quantile_cont(p_retailprice, 0.005) AS lo, quantile_cont(p_retailprice, 0.995) AS hi FROM t WHERE train),
c AS (SELECT p_partkey, train, greatest(lo, least(hi, p_retailprice)) AS x FROM t, q), s AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM c WHERE train) SELECT p_partkey, round((x - m) / s, 6) AS z FROM c, s""")
def md2(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return ml.clip_standardise(p, ["p_retailprice"], F.col("p_partkey") % 4 > 0).select("p_partkey", r6("p_retailprice", "z"))


@query("md3_time_folds", "WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), r AS (SELECT day, percent_rank() OVER (ORDER BY day) AS r FROM d) SELECT o_orderkey, least(floor(r * 4), 3)::BIGINT AS fold FROM orders JOIN r ON o_orderdate::DATE = day")
def md3(spark, sf):
    return ml.time_folds(table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")), "day", 3).select("o_orderkey", long("fold"))


@query("md4_time_split", "WITH q AS (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', o_orderdate::DATE), 0.8) AS c FROM orders) SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) <= c AS is_train FROM orders, q")
def md4(spark, sf):
    return ml.time_split(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "is_train")


@query("md7_training_weight", "WITH " + DAILY + " SELECT ciclo, fecha, round(greatest(0.2, least(5, sqrt(x))), 6) AS weight FROM d")
def md7(spark, sf):
    return daily(spark, sf).select("ciclo", "fecha", r6(ml.training_weight("x"), "weight"))


@query("md14_mask_outliers", "WITH " + LINES + ", t AS (SELECT *, fecha < DATE '1998-01-01' AS train FROM l), q AS (SELECT quantile_cont(peso, 0.01) AS lo, quantile_cont(peso, 0.99) AS hi, count(peso) AS n FROM t WHERE train AND tallos > 0) SELECT pedido, grado::BIGINT AS grado, parte, CASE WHEN n >= 80 AND NOT peso BETWEEN lo AND hi THEN 0 ELSE tallos END AS tallos FROM t, q")
def md14(spark, sf):
    return ml.mask_outliers(lines(spark, sf), "peso", "tallos", F.col("fecha") < "1998-01-01").select("pedido", long("grado"), "parte", "tallos")


CORRECTED = LINES + ', c AS (SELECT pedido, grado, parte, destino, tallos, peso * (1 - "desc") AS base, peso * "desc" * 1.3 AS corr, peso FROM l)'


def _corrected(spark, sf) -> DataFrame:
    return lines(spark, sf).withColumns({"base": F.col("peso") * (1 - F.col("desc")), "corr": F.col("peso") * F.col("desc") * 1.3})


@query("md15_fit_shrinkage", "WITH " + CORRECTED + ", g AS (SELECT i / 10 AS g, sum(tallos * abs(base + i / 10 * corr - peso)) / sum(tallos) AS e FROM c, (SELECT unnest(range(0, 11)) AS i) GROUP BY i) SELECT g AS gamma, round(e, 4) AS mae FROM g ORDER BY e, g LIMIT 1")
def md15(spark, sf):
    return ml.fit_shrinkage(_corrected(spark, sf), "base", "corr", "peso", "tallos").select("gamma", F.round("mae", 4).alias("mae"))


@query("md16_apply_correction", "WITH " + CORRECTED + ", n AS (SELECT *, base + greatest(-500, least(500, 0.8 * corr)) AS new FROM c), w AS (SELECT avg(abs(new - peso)) > avg(abs(base - peso)) AS worse FROM n) SELECT pedido, grado::BIGINT AS grado, parte, round(CASE WHEN worse THEN base ELSE new END, 4) AS final FROM n, w")
def md16(spark, sf):
    gamma = spark.createDataFrame([(0.8,)], "gamma double")
    return ml.apply_correction(_corrected(spark, sf), "base", "corr", gamma, (-500.0, 500.0), "peso").select("pedido", long("grado"), "parte", F.round("final", 4).alias("final"))


@query("md17_coupled_predict", "SELECT o_orderkey, round(o_totalprice / 8 + 17.5, 6) AS price, round((o_totalprice / 4 + 15) / 3 + 1, 6) AS dummy FROM orders")
def md17(spark, sf):
    """Two quantities that depend on each other, for three rounds."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit(0.0).alias("dummy"))
    step = lambda d: d.withColumns({"price": F.col("price") / 2 + 10, "dummy": F.col("price") / 3 + 1})
    return ml.coupled_predict(o, step, ["price", "dummy"], 3, 1e-12).select("o_orderkey", r6("price"), r6("dummy"))


@query("md18_segment_fallback", "WITH " + LINES + """, p AS (SELECT *, CASE WHEN parte % 3 > 0 THEN peso END AS pred FROM l), s AS (SELECT ciclo, parte, median(CASE WHEN tallos <= 45 THEN peso END) AS m FROM l GROUP BY 1, 2)
SELECT pedido, p.grado::BIGINT AS grado, p.parte, round(coalesce(pred, m, 100), 4) AS value, CASE WHEN pred IS NOT NULL THEN 'MODEL' WHEN m IS NOT NULL THEN 'SEGMENT' ELSE 'CONSTANT' END AS value_source FROM p LEFT JOIN s ON p.ciclo = s.ciclo AND p.parte = s.parte""")
def md18(spark, sf):
    l = lines(spark, sf).withColumn("pred", F.when(F.col("parte") % 3 > 0, F.col("peso")))  # noqa: E741
    # segments so fine that some have no weighed row
    out = ml.segment_fallback(l, l.withColumn("weighed", F.when(F.col("tallos") <= 45, F.col("peso"))), ["ciclo", "parte"], "pred", "weighed", 100.0)
    return out.select("pedido", long("grado"), "parte", F.round("value", 4).alias("value"), "value_source")


FTEST = """WITH x AS (SELECT t.target, f.feature, CASE t.target WHEN 'l_quantity' THEN l_quantity ELSE l_discount END AS y, CASE f.feature WHEN 'l_extendedprice' THEN l_extendedprice ELSE l_tax END AS x FROM lineitem, (SELECT unnest(['l_quantity', 'l_discount']) AS target) t, (SELECT unnest(['l_extendedprice', 'l_tax']) AS feature) f),
r AS (SELECT target, feature, count(*) AS n, corr(x, y) AS r, var_pop(x) < 1e-12 AS near_constant FROM x GROUP BY 1, 2) SELECT target, feature, n, round(r, 6) AS r, round(r * r / (1 - r * r) * (n - 2), 4) AS f, near_constant FROM r"""


@query("md19_feature_f_test", FTEST)
def md19(spark, sf):
    out = ml.feature_f_test(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], ["l_extendedprice", "l_tax"])
    return out.select("target", "feature", "n", r6("r"), F.round("f", 4).alias("f"), "near_constant")


@query("md20_ols_hc3", """WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem), m AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n, var_pop(x) * count(*) AS sxx, covar_pop(x, y) * count(*) AS sxy FROM d), b AS (SELECT *, sxy / sxx AS b, my - sxy / sxx * mx AS a FROM m),
e AS (SELECT x, mx, sxx, n, b, a, (y - a - b * x) / (1 - 1.0 / n - (x - mx) ^ 2 / sxx) AS e FROM d, b), v AS (SELECT any_value(b) AS b, any_value(a) AS a, sqrt(sum(((x - mx) * e) ^ 2)) / any_value(sxx) AS sb, sqrt(sum(((1.0 / n - mx * (x - mx) / sxx) * e) ^ 2)) AS sa FROM e)
SELECT 'intercept' AS name, round(a, 3) AS coefficient, round(sa, 3) AS error FROM v UNION ALL SELECT 'l_quantity', round(b, 3), round(sb, 3) FROM v""")
def md20(spark, sf):
    fit = ml.ols_hc3(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return spark.createDataFrame([(n, round(b, 3), round(e, 3)) for n, (b, e) in fit.items()], "name string, coefficient double, error double")


@query("md21_expand_horizon", "WITH " + LINES + """, s AS (SELECT ciclo, min(fecha) AS a, (10 + ciclo % 7)::INT AS h FROM l GROUP BY 1), g AS (SELECT ciclo, a, unnest(range(1, h + 1)) AS i FROM s)
SELECT g.ciclo, i AS day_index, a + i::INT - 1 AS day, sum(tallos) AS x FROM g LEFT JOIN l ON g.ciclo = l.ciclo AND l.fecha = a + i::INT - 1 GROUP BY 1, 2, 3""")
def md21(spark, sf):
    d = daily(spark, sf)
    s = d.groupBy("ciclo").agg(F.min("fecha").alias("a")).withColumn("h", 10 + F.col("ciclo") % 7)
    have = d.join(s, "ciclo").where("datediff(fecha, a) < h").select("ciclo", "fecha", "x")
    return grids.expand_horizon(have, s, ["ciclo"], "fecha", "a", "h").select("ciclo", long("day_index"), F.col("fecha").alias("day"), "x")


# --- comparison over forward folds: closed-form candidates, so that SQL can follow ------------------


FOLDED = """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), r AS (SELECT day, percent_rank() OVER (ORDER BY day) AS r FROM d), f AS (SELECT least(floor(r * 4), 3)::INT AS fold, o_totalprice / 1000 AS y, c_acctbal / 1000 AS x FROM orders JOIN r ON o_orderdate::DATE = day JOIN customer ON o_custkey = c_custkey),
t AS (SELECT i, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(y) AS m FROM f, (SELECT unnest([1, 2, 3]) AS i) WHERE fold < i GROUP BY i),
p AS (SELECT fold, 'line' AS candidate, y, a + b * x AS p FROM f JOIN t ON fold = i UNION ALL SELECT fold, 'mean', y, m FROM f JOIN t ON fold = i), e AS (SELECT candidate, fold, count(*) AS n, avg(abs(p - y)) AS mae, sum(abs(p - y)) / sum(abs(y)) AS wape FROM p GROUP BY 1, 2)"""


def _compared(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1000).alias("y"), (F.col("c_acctbal") / 1000).alias("x"), F.lit(1.0).alias("w"))

    def least_squares(xs):
        def fit(train):
            fits = linear.fit_targets(train, {"y": "w"}, xs)
            return lambda new: linear.predict_targets(new, fits, xs).withColumnRenamed("pred_y", "prediction")

        return fit

    return ml.fold_scores(ml.fold_predictions(rows, "y", {"line": least_squares(["x"]), "mean": least_squares([])}, "day", 3), "y")


@query("md5_fold_scores", FOLDED + " SELECT candidate, fold::BIGINT AS fold, n, round(mae, 5) AS mae, round(wape, 6) AS wape FROM e")
def md5_folds(spark, sf):
    return _compared(spark, sf)[0].select("candidate", long("fold"), "n", F.round("mae", 5).alias("mae"), r6("wape"))


@query("md5_candidate_scores", FOLDED + ", s AS (SELECT candidate, 0.6 * avg(mae) + 0.3 * avg(wape) + 0.1 * stddev_pop(mae) AS score FROM e GROUP BY 1) SELECT candidate, round(score, 5) AS score, score = min(score) OVER () AS best FROM s")
def md5_scores(spark, sf):
    return _compared(spark, sf)[1].select("candidate", F.round("score", 5).alias("score"), "best")


# --- fitted models: SQL has no counterpart, so these are held to bounds on later rows in the tests ---


def _sales(spark, sf) -> DataFrame:
    """Orders with labels that follow the customer's balance and segment, by day; ``is_train`` marks the first 80 %. Written: fits read it many times."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    noise = F.pmod(F.xxhash64("o_orderkey"), F.lit(1000)) / 1000.0
    rows = o.select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.month("o_orderdate").cast("double").alias("month"), "c_acctbal", "c_mktsegment", "o_orderpriority", F.lit(1.0).alias("w"),
        (2 + F.col("c_acctbal") / 1000 + F.when(F.col("c_mktsegment") == "BUILDING", 3.0).otherwise(0.0) + noise).alias("y"),
    )
    return written(ml.time_split(rows, "day", 0.8), "sales")


NUM, CAT = ["c_acctbal", "month"], ["c_mktsegment"]


def _train(rows: DataFrame) -> DataFrame:
    return rows.where("is_train")


def _scored(scored: DataFrame, value: str | Column = "prediction") -> DataFrame:
    return scored.select("o_orderkey", "day", "is_train", F.round("y", 4).alias("y"), F.round(value, 4).alias("prediction"))


@query("md5_select_model")
def md5(spark, sf):
    """All three candidates over three forward folds of the earlier rows."""
    rows = _sales(spark, sf)
    model, _, _ = ml.select_model(_train(rows), NUM, CAT, "y", ml.candidates("y"), "day", 3)
    return _scored(model.transform(rows))


@query("md6_train_per_level")
def md6(spark, sf):
    rows = _sales(spark, sf)
    score = ml.train_per_level(_train(rows), "o_orderpriority", NUM, CAT, "y", ["1-URGENT", "2-HIGH"], 1.5)
    return score(rows).select("o_orderkey", "o_orderpriority", "is_train", F.round("y", 4).alias("y"), F.round("prediction", 4).alias("prediction"), "prediction_source")


@query("md8_train_target")
def md8(spark, sf):
    rows = _sales(spark, sf)
    return _scored(ml.train_target(_train(rows), NUM, CAT, "y", F.log1p, F.expm1, (0.0, 50.0), "w")(rows))


@query("md9_train_residual")
def md9(spark, sf):
    rows = _sales(spark, sf).withColumn("r", F.col("y") - 6)
    return _scored(ml.train_residual(_train(rows), NUM, CAT, "r", "w").transform(rows), F.col("prediction") + 6)


@query("md10_gate_two_stage")
def md10(spark, sf):
    rows = _sales(spark, sf)
    return _scored(ml.gate_two_stage(_train(rows), NUM, CAT, "y", "c_mktsegment")(rows))


@query("md11_zero_inflated")
def md11(spark, sf):
    rows = _sales(spark, sf).withColumn("y", F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("y")))
    return _scored(ml.zero_inflated(_train(rows), NUM, CAT, "y")(rows))


def _benchmarked(spark, sf):
    """Two targets, the second with a mask: it is only known where the balance is positive."""
    rows = _sales(spark, sf).drop("is_train").withColumns({"z": F.when(F.col("c_acctbal") > 0, 10 - F.col("y") / 2), "wz": F.when(F.col("c_acctbal") > 0, 1.0).otherwise(0.0)})
    winners = ml.benchmark_targets(rows, {"y": "w", "z": "wz"}, NUM, CAT, "day")
    return ml.time_split(ml.predict_targets(rows, winners), "day", 0.8)


@query("md12_md13_benchmark_targets")
def md1213(spark, sf):
    return _scored(_benchmarked(spark, sf), "pred_y")


@query("md12_target_metrics")
def md12_metrics(spark, sf):
    """Errors of each target by segment, on later rows."""
    out = ml.target_metrics(_benchmarked(spark, sf).where("not is_train"), {"y": "w", "z": "wz"}, ["c_mktsegment"])
    return out.select("target", "c_mktsegment", "n", *(F.round(c, 4).alias(c) for c in ("mae", "bias", "wape")))
