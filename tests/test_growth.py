"""Work that must not grow faster than the rows."""

import math
import random

from pyspark.sql import functions as F

from agroplan.operators import curves, order, reconcile


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_quantiles_count_rows_by_range(spark):
    """A row is placed by a few compiled comparisons, not by a walk through 256 cuts; the numbers are those of ``percentile``."""
    rng = random.Random(7)
    rows = [(k, rng.choice([rng.gauss(0, 1), 0.25, None])) for k in ("a", "b", None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, x double")
    for ranges in (2, 8):
        out = order.quantiles(df, ["k"], "x", (0.0, 0.05, 0.5, 0.95, 1.0), ranges)
        want = df.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, (0.0, 0.05, 0.5, 0.95, 1.0)))).alias("q"), F.count("x").alias("n"))
        got, want = ({r.k: r for r in d.collect()} for d in (out, want))
        assert got.keys() == want.keys()
        for k in want:
            assert got[k].n == want[k].n and all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12) for x, y in zip(got[k].q, want[k].q, strict=True))
    assert "filter(__cuts" not in _plan(order.quantiles(df, ["k"], "x", (0.05, 0.95)))


def test_beta_fit_prices_candidates_without_a_row_for_each(spark):
    """15 copies of a row price 225 candidates; the best one is that of a plain search, also for a narrow curve."""
    rows = [("wide", (i + 0.5) / 40, 1.0 + (i % 7)) for i in range(40)] + [("narrow", 0.5 + (i - 10) / 2000, math.exp(-((i - 10) ** 2) / 20)) for i in range(21)] + [("none", 0.5, 0.0)]
    fit = curves.fit_beta(spark.createDataFrame(rows, "k string, r double, s double"), ["k"], "r", "s")
    assert "ib#" not in _plan(fit)
    got = {r.k: r for r in fit.collect()}
    assert got.keys() == {"wide", "narrow"}
    for k, r in got.items():
        own = [(x, s) for key, x, s in rows if key == k]
        total = sum(s for _, s in own)
        mu, m2 = (sum(x**p * s for x, s in own) / total for p in (1, 2))
        scale = max(mu * (1 - mu) / max(m2 - mu * mu, 1e-4) - 1, 2.05)
        a0, b0 = max(mu * scale, 1.01), max((1 - mu) * scale, 1.01)

        def nll(a, b, own=own, total=total):
            ls = [(a - 1) * math.log(x) + (b - 1) * math.log(1 - x) for x, _ in own]
            return max(ls) + math.log(sum(math.exp(v - max(ls)) for v in ls)) - sum(s / total * v for (_, s), v in zip(own, ls, strict=True))

        best = min(nll(max(a0 * math.exp(0.12 * i), 1.0001), max(b0 * math.exp(0.12 * j), 1.0001)) for i in range(-7, 8) for j in range(-7, 8))
        assert math.isclose(r.nll, best, rel_tol=1e-9) and math.isclose(nll(r.alpha, r.beta), best, rel_tol=1e-9)


def test_reconciled_partitions_follow_the_leaves(spark, monkeypatch):
    """No task's part of a level grows with the table; null keys are cells of their own, observations without a cell are none."""
    monkeypatch.setattr(reconcile, "TASK_ROWS", 20)
    leaves = spark.createDataFrame([(c, d, float(d % 5)) for c in (1, 2, None) for d in range(140)], "c int, d int, plan double")
    seen = spark.createDataFrame([(None, 3, 50.0), (1, 7, 10.0), (9, 9, 1000.0)], "c long, d long, v double")
    out = reconcile.reconcile_hierarchy(leaves, [["c"], ["c", "d"]], "plan", [None, (seen, "v")])
    assert out.rdd.getNumPartitions() == 21  # 420 leaves
    rows = {(r.c, r.d): r.value for r in out.collect()}
    assert len(rows) == 420 and math.isclose(rows[None, 3], 50.0) and math.isclose(rows[1, 7], 10.0) and out.schema["c"].dataType.simpleString() == "int"
    for c in (1, 2, None):
        assert math.isclose(sum(v for (k, _), v in rows.items() if k == c), 280.0)
