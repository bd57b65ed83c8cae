"""Fitted models have no SQL counterpart: each must beat the mean by a margin on later rows, which it was not fitted on."""

import pytest
from pyspark.sql import functions as F

from agroplan.operators import ml
from agroplan.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["md5_select_model", "md8_train_target", "md9_train_residual", "md10_gate_two_stage", "md11_zero_inflated", "md12_md13_benchmark_targets"])
def test_beats_the_mean_on_later_rows(spark, name):
    out = registry.queries()[name](spark, DATA).cache()
    assert out.where("prediction is not null").count() == spark.read.parquet(f"{DATA}/orders.parquet").count()
    days = out.agg(F.max(F.when(F.col("is_train"), F.col("day"))), F.min(F.when(~F.col("is_train"), F.col("day")))).first()
    assert days[0] < days[1]
    mean = out.where("is_train").agg(F.avg("y")).first()[0]
    n, ours, flat = out.where("not is_train").agg(F.count("*"), F.avg(F.abs(F.col("prediction") - F.col("y"))), F.avg(F.abs(F.lit(mean) - F.col("y")))).first()
    assert n > 200 and ours < 0.5 * flat


def test_metrics_of_each_target(spark):
    rows = {(r.target, r.c_mktsegment): r for r in registry.queries()["md12_target_metrics"](spark, DATA).collect()}
    assert {t for t, _ in rows} == {"y", "z"} and len(rows) == 10
    assert all(r.mae < 1.5 for r in rows.values()) and sum(r.n for (t, _), r in rows.items() if t == "z") < sum(r.n for (t, _), r in rows.items() if t == "y")


def test_levels_without_rows_get_the_constant(spark):
    out = registry.queries()["md6_train_per_level"](spark, DATA).where("not is_train")
    by = {r.o_orderpriority: r for r in out.groupBy("o_orderpriority").agg(F.min("prediction_source").alias("a"), F.max("prediction_source").alias("z"), F.avg(F.abs(F.col("prediction") - F.col("y"))).alias("mae"), F.max("prediction").alias("most")).collect()}
    assert {k for k, r in by.items() if r.a == r.z == "MODEL"} == {"1-URGENT", "2-HIGH"}
    assert all(r.most == 1.5 for k, r in by.items() if r.a == "CONSTANT") and by["1-URGENT"].mae < 2.0


def test_no_data_is_the_constant(spark):
    empty = spark.createDataFrame([], "level string, x double, y double")
    score = ml.train_per_level(empty, "level", ["x"], [], "y", ["a"], 7.0)
    assert [r.prediction for r in score(spark.createDataFrame([("a", 1.0, 2.0), (None, 1.0, 2.0)], "level string, x double, y double")).collect()] == [7.0, 7.0]


def test_fits_read_written_vectors(spark):
    """Estimators pass over a written table of vectors, not over the plan that made the rows; a saved gate has no summary."""
    rows = spark.range(400).selectExpr("cast(id % 17 as double) as x", "cast(id % 2 as string) as c", "cast(id % 17 > 8 as double) as y", "1.0D as w").cache()
    seen = []

    class Spy(ml.LogisticRegression):
        def fit(self, data):
            seen.append((data.columns, data._jdf.queryExecution().optimizedPlan().toString()))
            return super().fit(data)

    model = ml.fit_pipeline(rows, ["x"], ["c"], Spy(labelCol="y", weightCol="w"))
    assert seen[0][0] == ["features", "y", "w"] and "parquet" in seen[0][1] and "InMemory" not in seen[0][1]
    assert model.stages[-1].hasSummary
    bare = ml.without_summary(model, spark)
    assert not bare.stages[-1].hasSummary and bare.stages[-1].coefficients == model.stages[-1].coefficients


def test_best_threshold_takes_the_smaller_of_equals(spark):
    scored = spark.createDataFrame([(1.0, 0.9), (1.0, 0.62), (0.0, 0.5), (0.0, 0.1)], "y double, p double")
    assert ml.best_threshold(scored, "y", "p") == 0.55
