"""Semantics that the driver's tables do not hit: ties, nulls, empty groups, loops as references."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from agroplan.functions import columns as C
from agroplan.operators import aggs, alloc, checks, curves, grain, grids, joins, ml, windows
from agroplan.sources import sheets, tables

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_text_and_numbers(spark):
    df = spark.createDataFrame([("  a  b ",), ("",), (None,), ("1 234,5",), ("40GR",), ("BQT",), ("303B",)], "s string")
    got = df.select(C.canon_str("s", "UNKNOWN"), C.to_num("s"), C.extract_int("s"), C.extract_int("s", "leading")).collect()
    assert [r[0] for r in got][:3] == ["A B", "UNKNOWN", "UNKNOWN"]
    assert got[3][1] == 1234.5 and got[4][1] is None
    assert (got[4][2], got[5][2], got[6][3]) == (40, None, 303)


def test_week_keys(spark):
    df = spark.createDataFrame([(D(2024, 12, 30),), (D(2021, 1, 1),), (D(2023, 1, 1),)], "d date")
    got = [tuple(r) for r in df.select(C.week_key("d"), C.week_key("d", "yyww_mixed"), C.week_key("d", "sunday")).collect()]
    assert got == [(2501, 2401, 52), (2053, 2153, 1), (2252, 2352, 1)]


def test_corrections_invert(spark):
    df = spark.createDataFrame([(2.0, 3.0), (0.0, 1.0)], "y double, p double")
    for mode in ("add", "log"):
        back = df.select("y", C.apply_corr("p", C.encode_corr("y", "p", mode), mode).alias("b")).collect()
        assert all(math.isclose(r.y, r.b, abs_tol=1e-9) for r in back)


def test_header_and_unpivot(spark):
    grid = spark.createDataFrame([(0, "x", None, None), (1, " Cliente ", "FINCA", "2024-01-02"), (2, "a", "f", "1,5"), (3, "b", "f", "")], "i int, c0 string, c1 string, c2 string")
    table = sheets.promote_header(grid, "i", ["Cliente", "FINCA"])
    assert table.columns == ["i", "Cliente", "FINCA", "2024-01-02"]
    assert rows(sheets.unpivot_dates(table.drop("i"), ["Cliente", "FINCA"])) == [("a", "f", D(2024, 1, 2), 1.5), ("b", "f", D(2024, 1, 2), None)]
    assert sheets.dedup_columns(["a", " a", None, "a  b", ""]) == ["a", "a__2", "col", "a b", "col__2"]
    assert sheets.coerce_columns(table.select("Cliente", "2024-01-02")).dtypes == [("Cliente", "string"), ("2024-01-02", "double")]


def test_sources(spark, tmp_path):
    tables.write_table(spark.range(3).toDF("a"), f"{tmp_path}/t")
    assert tables.first_available(spark, [f"{tmp_path}/none", f"{tmp_path}/t"]).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.first_available(spark, [f"{tmp_path}/none"])
    assert tables.stamp(tables.read_table(spark, f"{tmp_path}/t"), "s").columns == ["a", "source_name", "extracted_at"]
    assert tables.calendar_dim(spark, "2024-02-28", "2024-03-01").count() == 3


def test_asof_and_nearest(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 10), ("a", 20), ("b", 5), (None, 5)], "k string, x int")
    right = spark.createDataFrame([("a", 5, 12, "p"), ("a", 15, 30, "q"), (None, 4, 9, "n")], "k string, r int, until int, v string")
    got = {(r.k, r.x): r.v for r in joins.asof_backward(left, right, ["k"], "x", "r", ["v", "until"], "until").collect()}
    assert got == {("a", 1): None, ("a", 5): "p", ("a", 10): "p", ("a", 20): "q", ("b", 5): None, (None, 5): "n"}
    near = {(r.k, r.x): r.v for r in joins.nearest_join(left, right, ["k"], "x", "r", ["v"]).collect()}
    assert near[("a", 10)] == "p" and near[("a", 1)] == "p" and near[("a", 20)] == "q" and near[("b", 5)] is None


def test_overlap_and_intervals(spark):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame([(1, t(6, 30), t(8, 0)), (2, t(9, 0), t(9, 0))], "i int, a timestamp, z timestamp")
    assert rows(joins.overlap_hours(df, "a", "z").select("i", F.hour("hour"), "overlap_h")) == [(1, 6, 0.5), (1, 7, 1.0)]
    w = spark.createDataFrame([("x", 1, 5, "VEG", 1), ("x", 4, None, "POST", 2)], "k string, a int, z int, s string, p int")
    days = spark.createDataFrame([("x", 3), ("x", 4), ("x", 9), ("x", 0), ("x", 4)], "k string, d int")
    assert rows(joins.assign_interval(days, w, ["k"], "d", "a", "z", "s", "p")) == [("x", 0, None), ("x", 3, "VEG"), ("x", 4, "POST"), ("x", 4, "POST"), ("x", 9, "POST")]


def test_cascade_and_mode(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9)], "g string, h int")
    fine, coarse = spark.createDataFrame([("a", 1, 10.0)], "g string, h int, v double"), spark.createDataFrame([("a", 7.0)], "g string, v double")
    got = rows(joins.lookup_cascade(df, [(fine, ["g", "h"], "v"), (coarse, ["g"], "v")], "o", 0.5, (0.0, 8.0)).select("g", "h", "o", "o_level"))
    assert got == [("a", 1, 8.0, 1), ("a", 2, 7.0, 2), ("b", 9, 0.5, 0)]
    ref = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), ("a", 2)], "g string, m int")
    assert rows(joins.attach_mode(spark.createDataFrame([("a",), ("c",)], "g string"), ref, ["g"], "m")) == [("a", 1), ("c", None)]


def test_shares_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("z", 0.0), ("z", 0.0), (None, 2.0)], "k string, x double")
    get = lambda mode: [r[-1] for r in windows.share_within(df, ["k"], "x", mode).orderBy("k", "x").collect()]
    assert get("null") == [1.0, 0.0, 1.0, None, None] and get("uniform")[3:] == [0.5, 0.5] and get("zero")[3:] == [0.0, 0.0]
    assert rows(grain.prefer_in_group(df, ["k"], F.col("x") > 0)) == rows(df.where("x > 0 or k = 'z'"))


def test_weighted_statistics(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 3.0), ("a", 9.0, 0.0), ("b", 5.0, None)], "k string, x double, w double")
    assert rows(aggs.weighted_median(df, ["k"], "x", "w")) == [("a", 2.0)]
    assert rows(aggs.weighted_quantile(df, ["k"], "x", "w", 0.5)) == [("a", 1 + 1 / 3)]
    assert rows(aggs.weighted_mean_or_median(df, ["k"], "x", "w")) == [("a", 1.75), ("b", 5.0)]


def test_clamped_balance_is_the_loop(spark):
    draw = random.Random(3)
    start = dt.datetime(2024, 1, 30)
    data = [("s", start + dt.timedelta(hours=i), draw.uniform(-2, 2)) for i in range(200)] + [("t", start, None)]
    got = {(r.k, r.ts): (r.balance_before, r.balance) for r in windows.clamped_balance(spark.createDataFrame(data, "k string, ts timestamp, d double"), ["k"], "ts", "d", 0.0, 3.0).collect()}
    x = 0.0
    for k, ts, d in data[:-1]:
        before, x = x, min(3.0, max(0.0, x + d))
        assert got[(k, ts)] == pytest.approx((before, x), abs=1e-9)
    assert got[("t", start)] == (0.0, 0.0)


def test_clamped_balance_of_a_dense_day(spark):
    """Many blocks of rows in a day, and equal times by delta."""
    draw = random.Random(4)
    start = dt.datetime(2024, 1, 31, 20)
    data = sorted((start + dt.timedelta(seconds=40 * (i // 2)), round(draw.uniform(-2, 2), 3)) for i in range(1000))
    df = spark.createDataFrame([("s", t, d) for t, d in data], "k string, ts timestamp, d double").repartition(7)
    got = [(r.balance_before, r.balance) for r in windows.clamped_balance(df, ["k"], "ts", "d", 0.0, 3.0, 1.0).orderBy("ts", "d").collect()]
    x, wanted = 1.0, []
    for _, d in data:
        wanted.append((x, min(3.0, max(0.0, x + d))))
        x = wanted[-1][1]
    assert got == [pytest.approx(w, abs=1e-9) for w in wanted]


def test_cap_redistribute_is_the_loop(spark):
    draw = random.Random(5)
    data = [(g, i, draw.uniform(0, 10), draw.uniform(0, 8)) for g in range(30) for i in range(draw.randrange(1, 9))]
    got = {(r.g, r.i): r for r in alloc.cap_redistribute(spark.createDataFrame(data, "g int, i int, x double, c double"), ["g"], "x", "c").collect()}
    for g in range(30):
        own = [(i, x, c) for h, i, x, c in data if h == g]
        v = {i: x for i, x, _ in own}
        for _ in range(200):
            over = sum(max(0.0, v[i] - c) for i, _, c in own)
            v = {i: min(v[i], c) for i, _, c in own}
            slack = sum(c - v[i] for i, _, c in own)
            if over < 1e-12 or slack < 1e-12:
                break
            v = {i: v[i] + over * (c - v[i]) / slack for i, _, c in own}
        assert all(got[(g, i)].capped == pytest.approx(min(v[i], c), abs=1e-6) for i, _, c in own)


def test_anchor_keeps_totals(spark):
    data = [("a", D(2024, 1, i), 10.0, 8.0 if i <= 2 else None, False) for i in range(1, 6)] + [("c", D(2024, 1, i), 10.0, 1.0, True) for i in range(1, 4)] + [("n", D(2024, 2, 1), 5.0, None, False)]
    df = alloc.anchor_to_actual(spark.createDataFrame(data, "k string, d date, p double, r double, closed boolean"), ["k"], "d", "p", "r", F.lit("2024-01-02").cast("date"), "closed")
    sums = {r.k: r.s for r in df.groupBy("k").agg(F.sum("anchored").alias("s")).collect()}
    assert sums == pytest.approx({"a": 50.0, "c": 3.0, "n": 5.0})


def test_allocation_edges(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 3), ("a", 3, None, 4)], "k string, day int, x double, n int")
    assert rows(alloc.complete_horizon(df, ["k"], "day", "n", ["x"]).select("k", "day", "x")) == [("a", 1, 5.0), ("a", 2, None), ("a", 3, None), ("a", 4, None)]
    assert rows(alloc.observed_zero_fill(df, ["k"], "day", "x").select("day", "x")) == [(1, 5.0), (3, None)]
    mix = spark.createDataFrame([("w1", 2.0, 1.0, 1.0), ("DEFAULT", 8.0, 1.0, 1.0)], "week string, B double, A double, T double")
    out = alloc.split_wide(spark.createDataFrame([("w1", 4.0), ("w9", 10.0)], "week string, total double"), mix, ["week"], ["B", "A", "T"], "total", {"week": "DEFAULT"})
    assert {(r.week, r.finish): r.value for r in out.collect()} == pytest.approx({("w1", "B"): 2, ("w1", "A"): 1, ("w1", "T"): 1, ("w9", "B"): 8, ("w9", "A"): 1, ("w9", "T"): 1})


def test_curve_shapes_keep_totals(spark):
    draw = random.Random(9)
    data = [(g, i, draw.uniform(1, 9), draw.uniform(1, 9)) for g in range(12) for i in range(1, 21)]
    df = spark.createDataFrame(data, "g int, i int, x double, b double")
    for out, name in ((alloc.cap_spikes(df, ["g"], "i", "x"), "despiked"), (alloc.decay_flat_tail(df.withColumn("x", F.lit(4.0)), ["g"], "i", "x"), "decayed")):
        total = {r.g: (r.a, r.b) for r in out.groupBy("g").agg(F.sum("x").alias("a"), F.sum(name).alias("b")).collect()}
        assert all(a == pytest.approx(b) for a, b in total.values())
    share = curves.cdf_to_share(df.withColumn("c", F.col("i") / 20), ["g"], "i", "c", "b").groupBy("g").agg(F.sum("cdf_share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in share)
    curve = curves.apply_curve(df.withColumns({"t": F.lit(100.0), "m": F.lit(0.0), "cap": F.lit(50.0)}), ["g"], "i", "t", "b", "m", "cap")
    assert all(r.s == pytest.approx(100.0) for r in curve.groupBy("g").agg(F.sum("value").alias("s")).collect())


def test_fit_beta_finds_the_curve(spark):
    n = 40
    pos = spark.range(n).select(F.lit(1).alias("k"), ((F.col("id") + 0.5) / n).alias("rel"))
    fit = curves.fit_beta(curves.beta_share(pos.withColumns({"a": F.lit(3.0), "b": F.lit(5.0)}), ["k"], "rel", "a", "b"), ["k"], "rel", "beta_share").first()
    assert fit.alpha == pytest.approx(3.0, rel=0.1) and fit.beta == pytest.approx(5.0, rel=0.1)


def test_checks_and_grids(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, None)], "k int, x double")
    got = checks.all_checks([checks.check_unique(df, ["k"], "t"), checks.check_identity(df, F.col("x"), F.col("x"), "t", "same"), checks.check_ranges(df, {"x": (0, 2.5)}, "t")])
    assert got.columns == checks.CHECK_COLUMNS and sorted((r.check_id, r.status) for r in got.collect()) == [("AU1_unique", "FAIL"), ("AU5_range", "FAIL"), ("AU8_identity", "PASS")]
    with pytest.raises(ValueError):
        grain.assert_unique(df, ["k"])
    days = spark.createDataFrame([(D(2024, 1, 1), 2.5), (D(2024, 1, 1), 0.2)], "a date, n double")
    assert [r.day_index for r in grids.explode_n_days(days, "a", "n").collect()] == [1, 2]
    events = grids.event_rows(df, "VEG", ["k"], {"x": (F.col("x"), 0, 2.5)}, F.lit(1.0))
    assert rows(events.select("target_x", "mask_x")) == [(2.0, 1.0), (2.5, 1.0), (None, 0.0)]


def _signal(spark, n=400):
    draw = random.Random(2)
    data = []
    for i in range(n):
        x, g = draw.uniform(0, 4), draw.choice("ab")
        data.append((D(2024, 1, 1) + dt.timedelta(days=i // 8), x, g, max(0.0, 2 * x - 1 + (g == "a") + draw.gauss(0, 0.2)), 1.0))
    return spark.createDataFrame(data, "d date, x double, g string, y double, w double")


def test_models_beat_the_median(spark):
    df = _signal(spark)
    folds = ml.time_folds(df, "d", 3)
    edges = folds.groupBy("fold").agg(F.min("d").alias("a"), F.max("d").alias("z")).orderBy("fold").collect()
    assert all(p.z < q.a for p, q in zip(edges, edges[1:], strict=False))
    options = {k: v for k, v in ml.candidates("y").items() if k != "rf"}
    model, best, scores = ml.select_model(df, ["x"], ["g"], "y", options, "d", 2)
    base = df.agg(F.avg(F.abs(F.col("y") - F.lit(df.agg(F.median("y")).first()[0])))).first()[0]
    assert best in scores and checks.error_metrics(model.transform(df), "y", "prediction").first()["mae"] < base / 2
    for score in (ml.zero_inflated(df, ["x"], ["g"], "y"), ml.gate_two_stage(df, ["x"], ["g"], "y", "g")):
        assert checks.error_metrics(score(df), "y", "prediction").first()["mae"] < base


def test_corrections_and_ols(spark):
    df = _signal(spark).withColumns({"base": F.col("y") + 1.0, "corr": F.lit(-2.0)})
    gamma = ml.fit_shrinkage(df, "base", "corr", "y", "w")
    assert gamma.first().gamma == pytest.approx(0.5)
    assert ml.apply_correction(df, "base", "corr", gamma, (-3, 3), "y").agg(F.max(F.abs(F.col("final") - F.col("y")))).first()[0] < 1e-9
    bad = ml.apply_correction(df, "y", "corr", gamma, (-3, 3), "y")
    assert bad.where("final <> y").count() == 0
    fit = ml.ols_hc3(df.withColumn("z", F.col("x") * 2 + 1), "z", ["x"])
    assert fit["x"][0] == pytest.approx(2.0) and fit["intercept"][0] == pytest.approx(1.0)
    f = {r.feature: r.f for r in ml.feature_f_test(df, ["y"], ["x", "w"]).collect()}
    assert f["x"] > 100 and f["w"] is None
    step = lambda d: d.withColumn("y", F.col("y") / 2)
    assert ml.coupled_predict(df.limit(1).withColumn("y", F.lit(8.0)), step, ["y"]).first().y == 1.0


def test_sc3_jdbc_since(spark):
    """From an embedded database: the bound is pushed to the source, readers split a numeric column."""
    from agroplan.sources import tables

    options = {"url": "jdbc:derby:memory:harvest;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(100).selectExpr("cast(id as int) as ID", "timestamp_seconds(1700000000 + id * 3600) as AT")
    rows.write.format("jdbc").options(**options).option("dbtable", "READINGS").mode("overwrite").save()
    since = tables.read_jdbc_since(spark, options, "READINGS", "AT", "2023-11-16 00:00:00", ("ID", 0, 100, 3))
    assert {r.ID for r in since.collect()} == {r.ID for r in rows.where("AT >= '2023-11-16 00:00:00'").collect()} != set()
    assert "PushedFilters: [*IsNotNull(AT), *GreaterThanOrEqual(AT" in since._jdf.queryExecution().executedPlan().toString()


def test_quantiles_read_one_range(spark):
    """A column of 10^6 distinct values: exact, and no task sorts or holds more than a part of it."""
    from agroplan.operators import order

    n = 1_000_000
    df = spark.range(n, numPartitions=16).select(F.pmod(F.col("id") * 7919, F.lit(n)).cast("double").alias("x"))
    qs = (0.0, 0.01, 0.255, 0.5, 0.99, 1.0)
    out = order.quantiles(df, [], "x", qs)
    assert out.first()["q"] == [pytest.approx((n - 1) * q, abs=1e-6) for q in qs] and out.first()["n"] == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert " percentile(" not in plan and "__range" in plan
    counted = order._counted(df.withColumn("k", F.lit(0)), ["k"], "x", order.RANGES)
    sizes = counted.groupBy("__range").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < n / 100 and sizes[1] > 200


def test_quantiles_and_ranks_of_groups(spark):
    import random
    import statistics

    from agroplan.operators import order

    draw = random.Random(1)
    rows = [("a", float(draw.randrange(40))) for _ in range(900)] + [("a", 7.0)] * 600 + [(None, draw.random()) for _ in range(57)] + [("b", 3.5), ("c", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    theirs = df.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, (0.1, 0.5, 0.93)))).alias("q"), F.count("x").alias("n")).where("n > 0")
    assert sorted(map(str, order.quantiles(df, ["k"], "x", (0.1, 0.5, 0.93), 8).collect())) == sorted(map(str, theirs.collect()))
    ranks = {r.x: r["rank"] for r in order.average_ranks(df.where("k = 'a'"), ["k"], "x", ranges=8).collect()}
    ordered = sorted(x for k, x in rows if k == "a")
    assert ranks == {x: statistics.mean(i + 1 for i, y in enumerate(ordered) if y == x) for x in set(ordered)}
    assert [r.n for r in order.quantiles(df.limit(0), [], "x", (0.5,)).collect()] == [0]


def brute_asof(left, right):
    """The latest right row at or before, and the closest one (the smaller on ties)."""
    out = []
    for k, t in left:
        own = sorted((x, v) for j, x, v in right if j == k)
        before = [r for r in own if r[0] <= t]
        ahead = [r for r in own if r[0] > t]
        near = before[-1] if before and (not ahead or t - before[-1][0] <= ahead[0][0] - t) else ahead[0] if ahead else (None, None)
        out.append((k, t, before[-1][1] if before else None, near[1]))
    return out


def test_asof_of_one_hot_key(spark):
    """All rows of one key are dealt over the slices, and each row finds the same neighbour as by brute force."""
    import random

    from agroplan.operators import joins, order

    draw = random.Random(5)
    left = [("hot", draw.randrange(4000)) for _ in range(1500)] + [("cold", 5), (None, 9), ("none", 1)]
    right = [("hot", draw.randrange(4000), i) for i in range(400)] + [("hot", 2000, 900 + i) for i in range(50)] + [("cold", 6, 1), ("cold", 4, 2), (None, 9, 3)]
    l, r = spark.createDataFrame(left, "k string, t long").repartition(4), spark.createDataFrame(right, "k string, s long, v long").repartition(4)  # noqa: E741
    back = {(x.k, x.t): x.v for x in joins.asof_backward(l, r, ["k"], "t", "s", ["v"]).collect()}
    near = {(x.k, x.t): x.v for x in joins.nearest_join(l, r, ["k"], "t", "s", ["v"]).collect()}
    for k, t, b, n in brute_asof(left, right):
        assert (back[k, t], near[k, t]) == (b, n), (k, t)
    counts = [c for (c,) in order.sliced(l.where("k = 'hot'"), "t", n=16).groupBy("__slice").count().select("count").collect()]
    assert len(counts) == 16 and max(counts) < 300


def test_slices_follow_the_longest_key(spark, monkeypatch):
    """Short keys are not cut, however many shuffle partitions there are; a long one is, and its rows find the same neighbours."""
    from agroplan.operators import order

    short = spark.range(2000).selectExpr("id % 500 as k", "id as t")
    assert order.slices(short, ["k"]) == 1 and order.slices(short.limit(0), ["k"]) == 1
    monkeypatch.setattr(order, "KEY_ROWS", 200)
    assert order.slices(short.withColumn("k", F.lit("hot")), ["k"]) == 10
    test_asof_of_one_hot_key(spark)
    test_running_sums_of_one_hot_key(spark)


def test_neighbours_ahead_take_one_pass(spark):
    """A frame up to the group's end is read anew for each of its rows."""
    from agroplan.operators import joins

    l, r = spark.range(20).selectExpr("1 as k", "id as t"), spark.range(20).selectExpr("1 as k", "id as s", "id as v")  # noqa: E741
    plan = joins.nearest_join(l, r, ["k"], "t", "s", ["v"])._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_running_sums_of_one_hot_key(spark):
    from agroplan.operators import order

    rows = [("hot", i, float(i % 7)) for i in range(3000)] + [("cold", 3, 2.0), (None, 1, 1.5), (None, 2, None)]
    out = order.running_sums(spark.createDataFrame(rows, "k string, t long, x double").repartition(5), ["k"], "t", {"n": F.lit(1), "c": F.col("x")}).collect()
    got = {(r.k, r.t): (r.n, r.c) for r in out}
    total = 0.0
    for k, t, x in rows[:3000]:
        total += x
        assert got[k, t] == (t + 1, total)
    assert len(out) == len(rows) and got["cold", 3] == (1, 2.0) and got[None, 2] == (2, 1.5)
