"""Coupled scoring, panels, reconciliation, linear models, incremental extracts and audited writes, against plain loops."""

import datetime as dt
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from agroplan.operators import checks, linear, observed, panel, reconcile, windows
from agroplan.plans import coupled, q_ml2, registry
from agroplan.sources import incremental, shared

DATA = "/root/testdata/sf0.001"
D = dt.date


def test_coupled_scoring_stops_at_a_fixed_point(spark):
    """Corrections that die out: the loop ends before its limit; a plain loop agrees."""
    events = q_ml2._events(spark, DATA).where("ciclo <= 3")
    targets = [coupled.Target("factor", coupled.HG, 0.5 * (1.2 - F.col("pred_factor")), 1.0, "add", (-1.0, 1.0), (0.0, 5.0)), coupled.Target("dh", coupled.POST, 0.5 * (9 - F.col("pred_dh")), 1.0, "add", (-9.0, 9.0), (0.0, 30.0), real="real_dh")]
    done = coupled.score_coupled(events, targets, 40, 1e-3)
    assert done.converged and 5 < done.rounds < 20 and done.changes[-1] <= 1e-3 < done.changes[-2] and list(done.changes) == sorted(done.changes, reverse=True)
    rows = [r.asDict() for r in events.collect()]
    for _ in range(done.rounds):
        for r in rows:
            if r["stage"] == coupled.HG:
                r["pred_factor"] += 0.5 * (1.2 - r["pred_factor"])
            elif r["stage"] == coupled.POST:
                r["pred_dh"] = r["real_dh"] if r["real_dh"] is not None else r["pred_dh"] + 0.5 * (9 - r["pred_dh"])
    key = lambda r: (r["stage"], r["ciclo"], r["fecha"], r["grado"], r["destino"])
    got = {key(r): r for r in (x.asDict() for x in done.state.collect())}
    assert len(got) == len(rows)
    for r in rows:
        mine = got[key(r)]
        if r["stage"] == coupled.HG:
            assert mine["pred_factor"] == pytest.approx(r["pred_factor"]) and mine["tallos_dia"] == pytest.approx(r["tallos_dia_ref"] * r["pred_factor"] / r["factor_ref"])
        if r["stage"] == coupled.POST:
            assert mine["pred_dh"] == pytest.approx(r["pred_dh"]) and mine["fecha_post"] == r["fecha"] + dt.timedelta(days=round(r["pred_dh"]))
            parent = got[coupled.HG, r["ciclo"], r["fecha"], r["grado"], None]
            assert mine["tallos_post"] == pytest.approx(r["tallos_post_ref"] * parent["tallos_grado"] / parent["tallos_grado_ref"])


def test_coupled_rounds_leave_one_table_and_need_no_shuffle(spark, tmp_path, monkeypatch):
    """Rounds after the first read the one before in its buckets; only the last one's files stay."""
    monkeypatch.setattr(coupled.shared, "new_path", lambda _, name: f"file://{tmp_path}/{name}-{len([*tmp_path.iterdir()])}")
    done = coupled.score_coupled(q_ml2._events(spark, DATA), q_ml2.coupled_targets(), 2, 0.0)
    assert done.rounds == 2 and [f.name for f in tmp_path.iterdir()] == ["round-1"]
    plan = coupled.recompute_links(done.state)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and done.state.count() > 0


def test_coupled_rounds_hold_only_events_and_predictions(spark, tmp_path, monkeypatch):
    """Lines are shuffled once, into buckets that follow their count; references and links are not written, and the state is that of rounds that hold them."""
    paths = [f"file://{tmp_path}/round-{i}" for i in range(4)]
    monkeypatch.setattr(coupled.shared, "new_path", lambda *_: paths.pop(0))
    monkeypatch.setattr(q_ml2, "BUCKET_LINES", 500)
    planned, buckets = q_ml2._planned(spark, DATA)
    assert buckets == 12 and planned._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # of 6,000 lines
    done = coupled.score_coupled(planned, q_ml2.coupled_targets(), 2, 0.0, q_ml2._references(), buckets)
    (left,) = tmp_path.iterdir()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535" and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"  # as before
    written = spark.read.parquet(f"file://{left}").columns
    assert sorted(written) == sorted(planned.columns) and not {*q_ml2._references()} & {*written} and len([*left.glob("part-*")]) > 4
    whole = coupled.score_coupled(planned.withColumns(q_ml2._references()), q_ml2.coupled_targets(), 2, 0.0)
    assert done.changes == pytest.approx(whole.changes)
    key, columns = ("stage", "ciclo", "fecha", "grado", "destino"), sorted(done.state.columns)
    rows = lambda d: sorted((r for r in d.state.select(*columns).collect()), key=lambda r: [str(r[k]) for k in key])
    a, b = rows(done), rows(whole)
    assert len(a) == len(b) > 6000
    for x, y in zip(a, b, strict=True):
        assert all(p == (pytest.approx(q) if isinstance(q, float) else q) for p, q in zip(x, y, strict=True))


def test_coupled_events_of_repeated_and_missing_keys(spark, tmp_path):
    """Many lines of a finish, null cycles and days, null weights: the rows of the SQL."""
    draw = random.Random(5)
    day = dt.datetime(1994, 1, 1)
    rows = [(draw.choice([1, 2, 3, None]), draw.choice([day, day + dt.timedelta(days=1), day + dt.timedelta(days=300), None]), draw.choice([1, 2, 4]), draw.choice("ANR"), "O", float(draw.randrange(1, 50)), draw.choice([None, 1000.0, 2500.5]), draw.randrange(10) / 100, i, i) for i in range(400)]
    rows += [(9, None, 1, "A", "O", 5.0, 100.0, 0.0, 900, 900)]
    lines = spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double, l_discount double, l_orderkey long, l_partkey long")
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = q_ml2.coupled_scoring(spark, f"file://{tmp_path}")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.oracle_sql()['ml2_coupled_scoring']})").fetchall()
    order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: [str(v) for v in r[:5]])
    a, b = order(got.collect()), order(want)
    assert len(a) == len(b) and {r[0] for r in a} == {coupled.VEG, coupled.HG, coupled.POST}
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5] and all(p == (pytest.approx(float(q), abs=1.01e-4) if isinstance(p, float) and q is not None else q) for p, q in zip(x[5:], y[5:], strict=True)), (x, y)


def test_coupled_links_without_calendar_or_grades(spark):
    """A cycle without VEG keeps its calendar, a day without shares gets even ones, a POST row without a grade keeps its plan."""
    all_ = q_ml2._events(spark, DATA)
    events = all_.where("ciclo = 1 and stage <> 'VEG'").withColumn("pred_share", F.lit(0.0))
    out = coupled.recompute_links(events.unionByName(all_.where("ciclo = 2 and stage = 'POST'"))).collect()
    assert {r.rel_pos for r in out} == {0.5} and all(r.harvest_start is None for r in out)
    days = {}
    for r in out:
        if r.stage == coupled.HG:
            days.setdefault(r.fecha, []).append(r.pred_share)
    assert all(v == pytest.approx([1 / len(v)] * len(v)) for v in days.values())
    assert all(r.tallos_post == r.tallos_post_ref and r.kg == r.kg_post_ref for r in out if r.ciclo == 2)
    assert coupled.recompute_links(events.limit(0)).count() == 0


def test_panel_brute_force(spark):
    draw = random.Random(6)
    day = lambda n: D(2024, 1, 1) + dt.timedelta(days=n)
    a = [(draw.choice("pqr"), day(draw.randrange(90)), draw.choice([None, 1.0, 2.5])) for _ in range(300)]
    b = [("p", day(draw.randrange(90)), float(draw.randrange(9))) for _ in range(200)]
    entities = [(i, draw.choice("pqrs"), day(20), day(20 + i)) for i in range(40)] + [(99, "p", day(30), day(10))]
    frame = spark.createDataFrame(entities, "id int, k string, a date, t date")
    out = panel.asof_panel(frame, ["id"], ["k"], "a", "t", {"one": (spark.createDataFrame(a, "k string, d date, x double"), "d", ["x"]), "two": (spark.createDataFrame(b, "k string, e date, y double"), "e", ["y"])}, (7,))
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(entities)
    for i, k, start, t in entities:
        r = got[i]
        for rows, x, s in ((a, "x", "one"), (b, "y", "two")):
            since = [v for j, d, v in rows if j == k and start <= d <= t]
            last = [v for j, d, v in rows if j == k and max(start, t - dt.timedelta(days=6)) <= d <= t]
            seen = [d for j, d, _ in rows if j == k and d <= t]
            if t >= start:
                assert r[f"{x}_since"] == pytest.approx(sum(v or 0 for v in since)) and r[f"{x}_last7"] == pytest.approx(sum(v or 0 for v in last)), (i, x)
            assert r[f"{s}_rows"] == len(since) and r[f"{s}_seen"] == max(seen, default=None)
    assert panel.leakage(out, "t", ["one_seen", "two_seen"]).first().n_late == 0
    late = out.withColumn("one_seen", F.when(F.col("id") < 3, F.date_add("t", 1)).otherwise(F.col("one_seen")))
    assert panel.leakage(late, "t", ["one_seen", "two_seen"]).first().n_late == 3
    labels = spark.createDataFrame([("p", day(40), 5.0), ("q", day(1), 6.0)], "k string, until date, y_label double")
    for r in panel.attach_labels(frame, labels, ["k"], "t", "until", ["y_label"]).collect():
        assert r.y_label == (5.0 if r.k == "p" and r.t < day(40) else None) and r.labelled == (r.y_label is not None)


def test_hierarchy_adds_up_and_keeps_what_was_seen(spark):
    draw = random.Random(3)
    leaves = [(c, d, g, f, float(draw.choice([0, 1, 5, 20]))) for c in (1, 2, None) for d in range(6) for g in range(4) for f in "ABC"]
    days = [(c, d, float(draw.randrange(80, 160))) for c in (1, 2, None) for d in range(0, 6, 2)]
    cells = [(c, d, g, "B", 2.0) for c in (1, 2, None) for d in range(6) for g in range(0, 4, 2)]
    totals = [(1, 900.0), (2, 1000.0)]
    frame = lambda rows, keys, kinds: (spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, t in zip([*keys, "v"], [*kinds, "double"], strict=True))), "v")
    levels = [["c"], ["c", "d"], ["c", "d", "g"], ["c", "d", "g", "f"]]
    out = reconcile.reconcile_hierarchy(spark.createDataFrame(leaves, "c int, d int, g int, f string, plan double"), levels, "plan", [frame(totals, "c", ["int"]), frame(days, "cd", ["int", "int"]), None, frame(cells, "cdgf", ["int", "int", "int", "string"])]).collect()
    assert len(out) == len(leaves) and all(r.value >= -1e-9 for r in out)
    total = lambda *ks: sum(r.value for r in out if (r.c, r.d, r.g, r.f)[: len(ks)] == ks)
    assert total(1) == pytest.approx(900) and total(2) == pytest.approx(1000)
    for c, d, v in days:
        assert total(c, d) == pytest.approx(v)
    for c, d, g, f, v in cells:
        assert total(c, d, g, f) == pytest.approx(v), (c, d, g)
    empty = reconcile.reconcile_hierarchy(spark.createDataFrame([], "c int, d int, plan double"), [["c"], ["c", "d"]], "plan", [None, None])
    assert empty.count() == 0


def test_hierarchy_of_all_seen_is_scaled_and_nothing_is_shared_evenly(spark):
    rows = spark.createDataFrame([(1, 1, 3.0), (1, 2, 5.0), (2, 1, 0.0), (2, 2, 0.0)], "c int, d int, plan double")
    seen = spark.createDataFrame([(1, 1, 2.0), (1, 2, 6.0)], "c int, d int, v double")
    top = spark.createDataFrame([(1, 16.0), (2, 10.0)], "c int, v double")
    out = {(r.c, r.d): r.value for r in reconcile.reconcile_hierarchy(rows, [["c"], ["c", "d"]], "plan", [(top, "v"), (seen, "v")]).collect()}
    assert out == pytest.approx({(1, 1): 4.0, (1, 2): 12.0, (2, 1): 5.0, (2, 2): 5.0})


def test_fit_targets_against_numpy(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 3)) * [1, 10, 0.1] + [100, 0, 5]
    w = draw.uniform(0, 2, size=400)
    y1, y2 = x @ [1.0, -0.2, 7.0] + 3 + draw.normal(size=400), x @ [0.0, 0.5, 0.0] - 1
    rows = [(*map(float, r), float(a), None if i % 3 == 0 else float(b), float(v), 1.0) for i, (r, a, b, v) in enumerate(zip(x, y1, y2, w, strict=True))] + [(None, 1.0, 1.0, 5.0, 5.0, 1.0, 1.0), (1.0, 1.0, 1.0, 9e9, None, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y1 double, y2 double, w double, u double").withColumn("never", F.lit(None).cast("double"))
    fits = linear.fit_targets(df, {"y1": "w", "y2": "u", "never": "u"}, ["a", "b", "c"])
    assert set(fits) == {"y1", "y2"} and fits["y1"].n == 400 and fits["y2"].n == sum(i % 3 > 0 for i in range(400))
    full, root = np.hstack([np.ones((400, 1)), x]), np.sqrt(w)[:, None]
    assert fits["y1"].coefficients == pytest.approx(np.linalg.lstsq(full * root, y1 * root[:, 0], rcond=None)[0], rel=1e-5)
    assert fits["y2"].coefficients == pytest.approx([-1, 0, 0.5, 0], abs=1e-6)
    scored = linear.predict_targets(df, fits, ["a", "b", "c"]).first()
    assert scored.pred_y1 == pytest.approx(fits["y1"].coefficients[0] + sum(b * v for b, v in zip(fits["y1"].coefficients[1:], x[0], strict=True)))


def test_ols_with_dummies_and_delta_errors(spark):
    draw = np.random.default_rng(2)
    rows = [(float(a), float(b), "xyz"[i % 3], float(2 * a + b + 3 * a * b + (i % 3) + e)) for i, (a, b, e) in enumerate(zip(draw.normal(size=300), draw.uniform(size=300), draw.normal(size=300), strict=True))]
    df = spark.createDataFrame(rows, "s double, g double, dest string, y double")
    df, names = linear.interactions(df, ["s"], ["g"])
    df, marks = linear.dummies(df, "dest", "dest")
    xs = ["s", "g", *names.values(), *marks]
    fit = linear.ols(df, "y", xs)
    assert marks == ["dest_y", "dest_z"]
    full = np.array([[1.0, a, b, a * b, t == "y", t == "z"] for a, b, t, _ in rows], dtype=float)
    y = np.array([r[3] for r in rows])
    inverse = np.linalg.inv(full.T @ full)
    beta = inverse @ full.T @ y
    e = (y - full @ beta) / (1 - np.einsum("ij,jk,ik->i", full, inverse, full))
    cov = inverse @ (full.T * e**2) @ full @ inverse
    assert fit.beta == pytest.approx(beta) and fit.covariance == pytest.approx(cov)
    assert fit.r2 == pytest.approx(1 - ((y - full @ beta) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    ((a, scenario, effect, error),) = linear.marginals(fit, ["s"], names, {"half": {"g": 0.5}})
    g = np.array([0, 1, 0, 0.5, 0, 0])
    assert (a, scenario) == ("s", "half") and effect == pytest.approx(beta[1] + 0.5 * beta[3]) and error == pytest.approx(math.sqrt(g @ cov @ g))
    with pytest.raises(ValueError, match="levels"):
        linear.dummies(spark.range(500).withColumn("d", F.col("id").cast("string")), "d", "d")


def test_incremental_runs_equal_one_read(spark):
    """From an embedded database, in ranges of a numeric column: late rows and changed rows are picked up."""
    options = {"url": "jdbc:derby:memory:grown;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schema = "ID int, AT timestamp, V double"

    def fill(rows):
        spark.createDataFrame(rows, schema).write.format("jdbc").options(**options).option("dbtable", "GROWN").mode("overwrite").save()

    first = [(i, day(i), float(i)) for i in range(30)]
    fill(first)
    read = incremental.jdbc_source(spark, options, "GROWN", "ID", 3)
    state = shared.new_path(spark, "state")
    run = lambda: {(r.ID, r.AT, r.V) for r in incremental.extract_increment(spark, read, state, ["ID"], "AT", "2024-01-01", 7).collect()}
    assert run() == set(first) and read(F.lit(True)).rdd.getNumPartitions() == 3
    second = [*first, (100, day(25), 1.5), (101, day(40), 2.5)]
    second[28] = (28, day(28), -1.0)
    fill(second)
    assert run() == set(second)
    third = [(28, day(41), -2.0) if r[0] == 28 else r for r in second]
    fill(third)
    assert run() == set(third) == {(r.ID, r.AT, r.V) for r in read(F.lit(True)).collect()} and run() == set(third)
    fill([])
    assert run() == set(third)
    number, mark, _ = incremental.last_mark(spark, state)
    assert mark == day(41) and number >= 3


def test_incremental_state_of_a_run_that_died(spark, monkeypatch):
    state = shared.new_path(spark, "state")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a")], "k int, t timestamp, v string")
    incremental.extract_increment(spark, rows.where, state, ["k"], "t", "2020-01-01")
    before = incremental.last_mark(spark, state)
    more = rows.unionByName(spark.createDataFrame([(2, dt.datetime(2024, 1, 2), "b")], "k int, t timestamp, v string"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "merge_latest", dies)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.extract_increment(spark, more.where, state, ["k"], "t", "2020-01-01")
    assert incremental.last_mark(spark, state) == before
    assert incremental.extract_increment(spark, more.where, state, ["k"], "t", "2020-01-01").count() == 2


def test_observed_audits_take_one_job(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "a", 2.0), (2, "b", None), (3, None, -1.0)], "k int, g string, x double")
    path = shared.new_path(spark, "audited")
    tracker, group = spark.sparkContext.statusTracker(), "audited-write"
    spark.sparkContext.setJobGroup(group, group)
    got = observed.write_audited(df, path, "t", ["k", "g"], {"x": (0.0, 1.0)})
    scans = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    plain = checks.all_checks([checks.check_unique(df, ["k", "g"], "t"), checks.check_ranges(df, {"x": (0.0, 1.0)}, "t")])
    assert scans <= 2  # with adaptive execution the shuffle before the write is a job of its own
    assert sorted(map(tuple, got.where("check_id <> 'AU11_filled'").collect())) == sorted(map(tuple, plain.collect()))
    assert spark.read.parquet(path).columns == df.columns and spark.read.parquet(path).count() == 4
    nothing = observed.write_audited(df.limit(0), shared.new_path(spark, "audited"), "t", ["k"], {"x": (0.0, 1.0)})
    assert {r.check_id: r.status for r in nothing.collect()} == {"AU1_unique": "PASS", "AU5_range": "PASS", "AU11_filled": "FAIL"}


def test_bucketed_tables_are_read_without_a_shuffle(spark):
    rows = spark.range(4000).select((F.col("id") % 97).alias("k"), F.col("id").alias("t"), F.rand(1).alias("x"))
    a = shared.write_bucketed(rows, ["k"], ["t"], 6)
    plain = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rolled = windows.rolling(windows.share_within(a, ["k"], "x"), ["k"], ["t"], "x", 7)
    assert "Exchange" not in plain(rolled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        totals = shared.write_bucketed(rows.groupBy("k").agg(F.max("x").alias("y")), ["k"], [], 6, "totals")
        joined = a.join(totals, "k")
        assert "Exchange" not in plain(joined) and joined.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rolled.count() == 4000
