"""Queries for allocation and curve operators that build on daily curves."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import alloc, curves, windows
from ..sources import tables
from .base import DAILY, LINES, daily, lines, long, r6, table
from .registry import query

PLACED = DAILY + ", c AS (SELECT *, row_number() OVER (PARTITION BY ciclo ORDER BY fecha) AS i, count(*) OVER (PARTITION BY ciclo) AS n FROM d)"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def placed(spark, sf):
    """The daily curve with the day's number ``i`` and the number of days ``n``."""
    w = W.partitionBy("ciclo")
    return daily(spark, sf).withColumns({"i": F.row_number().over(w.orderBy("fecha")), "n": F.count(F.lit(1)).over(w)})


@query("al1_spread_uniform", "WITH " + PLACED + " SELECT ciclo, fecha, round(sum(x) OVER (PARTITION BY ciclo) / n, 6) AS value FROM c")
def al1(spark, sf):
    d = placed(spark, sf).withColumn("total", F.sum("x").over(W.partitionBy("ciclo")))
    return alloc.spread_uniform(d, "total", "n").select("ciclo", "fecha", r6("value"))


@query("al4_split_wide", "WITH " + LINES + """, p AS (SELECT parte || '-' || grado AS k, avg(tallos) FILTER (destino = 'A') AS A, avg(tallos) FILTER (destino = 'N') AS N, avg(tallos) FILTER (destino = 'R') AS R FROM l GROUP BY 1),
o AS (SELECT avg(tallos) FILTER (destino = 'A') AS A, avg(tallos) FILTER (destino = 'N') AS N, avg(tallos) FILTER (destino = 'R') AS R FROM l),
g AS (SELECT ciclo, parte || '-' || grado AS k, sum(peso) AS peso FROM l GROUP BY 1, 2),
j AS (SELECT ciclo, g.k, peso, coalesce(p.A, o.A) AS A, coalesce(p.N, o.N) AS N, coalesce(p.R, o.R) AS R FROM g LEFT JOIN p ON g.k = p.k CROSS JOIN o)
SELECT ciclo, k, finish, round(peso * v / (A + N + R) + 0.00001, 3) AS value FROM (SELECT *, unnest(['A', 'N', 'R']) AS finish, unnest([A, N, R]) AS v FROM j)""")
def al4(spark, sf):
    """By part and grade; a finish that a part and grade never had gets the whole table's weight."""
    l = lines(spark, sf).withColumn("k", F.concat_ws("-", "parte", "grado"))  # noqa: E741
    wide = lambda d, *keys: d.groupBy(*keys).pivot("destino", ["A", "N", "R"]).agg(F.avg("tallos"))
    weights = wide(l, "k").unionByName(wide(l.withColumn("k", F.lit("DEFAULT")), "k"))
    out = alloc.split_wide(l.groupBy("ciclo", "k").agg(F.sum("peso").alias("peso")), weights, ["k"], ["A", "N", "R"], "peso", {"k": "DEFAULT"})
    return out.select("ciclo", "k", "finish", F.round(F.col("value") + 0.00001, 3).alias("value"))  # no half at the third place


@query("al6_week_to_day", """WITH w AS (SELECT date_trunc('week', o_orderdate)::DATE AS week, sum(o_totalprice) AS v FROM orders GROUP BY 1),
c AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS day FROM orders)
SELECT day, round(v / 7, 4) AS v FROM w JOIN c ON date_trunc('week', day)::DATE = week""")
def al6(spark, sf):
    o = table(spark, sf, "orders")
    a, z = o.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    calendar = tables.calendar_dim(spark, str(a), str(z)).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    weekly = o.groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(F.sum("o_totalprice").alias("v"))
    return alloc.week_to_day(weekly, calendar, "week", "v").select("day", F.round("v", 4).alias("v"))


SHARES = LINES + ", g AS (SELECT ciclo, grado, sum(tallos) AS t, sum(peso) AS w FROM l GROUP BY 1, 2), s AS (SELECT *, t / sum(t) OVER (PARTITION BY ciclo) AS share FROM g)"


def _grades(spark, sf):
    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"), F.sum("peso").alias("w"))
    return windows.share_within(g, ["ciclo"], "t")


@query("al9_bound_share", "WITH " + SHARES + ", b AS (SELECT ciclo, grado, least(greatest(share, 0.1), CASE WHEN grado <= 5 THEN 0.2 ELSE share END) AS b FROM s) SELECT ciclo, grado::BIGINT AS grado, round(b / sum(b) OVER (PARTITION BY ciclo), 6) AS share FROM b")
def al9(spark, sf):
    g = _grades(spark, sf).withColumns({"lo": F.lit(0.1), "hi": F.when(F.col("grado") <= 5, 0.2)})
    return alloc.bound_share(g, ["ciclo"], "share", "lo", "hi").select("ciclo", long("grado"), r6("share"))


@query("al10_factor_chain", "WITH " + LINES + ' SELECT pedido, grado::BIGINT AS grado, parte, round(CASE WHEN grado <> 1 THEN peso * sqrt(1 - "desc") * tallos / (grado - 1) END, 4) AS final FROM l')
def al10(spark, sf):
    l = lines(spark, sf).withColumns({"yield_": F.sqrt(1 - F.col("desc")), "ideal": F.col("grado") - 1})  # noqa: E741
    return alloc.factor_chain(l, "peso", ["yield_", "tallos"], ["ideal"]).select("pedido", long("grado"), "parte", F.round("final", 4).alias("final"))


STATES = """CASE WHEN closed AND r IS NOT NULL THEN 'REAL_CLOSED' WHEN closed THEN 'ML1_CLOSED' WHEN r IS NOT NULL THEN 'REAL_ACTIVE' ELSE 'ML2_ACTIVE' END"""


@query("al12_select_by_state", "WITH " + LINES + ", s AS (SELECT *, ciclo % 3 = 0 AS closed, CASE WHEN destino = 'A' THEN tallos END AS r FROM l) SELECT pedido, grado::BIGINT AS grado, parte, CASE WHEN r IS NOT NULL THEN r WHEN closed THEN peso ELSE \"desc\" END AS value, " + STATES + " AS value_source FROM s")
def al12(spark, sf):
    l = lines(spark, sf).withColumn("real", F.when(F.col("destino") == "A", F.col("tallos")))  # noqa: E741
    return alloc.select_by_state(l, F.col("ciclo") % 3 == 0, "real", "peso", "desc").select("pedido", long("grado"), "parte", "value", "value_source")


@query("al15_reconcile_children", "WITH " + SHARES + ", p AS (SELECT ciclo, sum(w) * 0.9 AS total FROM g GROUP BY 1) SELECT s.ciclo, grado::BIGINT AS grado, round(total * share, 4) AS value FROM s JOIN p ON s.ciclo = p.ciclo")
def al15(spark, sf):
    g = _grades(spark, sf)
    parent = g.groupBy("ciclo").agg((F.sum("w") * 0.9).alias("total"))
    return alloc.reconcile_children(g, parent, ["ciclo"], "t", "total").select("ciclo", long("grado"), F.round("value", 4).alias("value"))


@query("al17_observed_zero_fill", "WITH " + PLACED + ", h AS (SELECT ciclo, fecha, CASE WHEN i % 3 > 0 AND i < n - 5 THEN x END AS x FROM c) SELECT ciclo, fecha, CASE WHEN x IS NULL AND fecha <= max(fecha) FILTER (x IS NOT NULL) OVER (PARTITION BY ciclo) THEN 0 ELSE x END AS x FROM h")
def al17(spark, sf):
    d = placed(spark, sf).withColumn("x", F.when((F.col("i") % 3 > 0) & (F.col("i") < F.col("n") - 5), F.col("x")))
    return alloc.observed_zero_fill(d, ["ciclo"], "fecha", "x").select("ciclo", "fecha", "x")


@query("al20_bound_by_caps", "WITH " + LINES + """, a AS (SELECT parte, destino, avg(tallos) * 0.5 AS lo, avg(tallos) * 1.5 AS hi FROM l GROUP BY 1, 2 HAVING count(*) >= 12), b AS (SELECT parte, avg(tallos) * 0.6 AS lo, avg(tallos) * 1.4 AS hi FROM l GROUP BY 1 HAVING count(*) >= 30)
SELECT pedido, l.grado::BIGINT AS grado, l.parte, round(greatest(coalesce(a.lo, b.lo, 10), least(coalesce(a.hi, b.hi, 40), tallos)), 6) AS bounded FROM l LEFT JOIN a ON l.destino = a.destino AND l.parte = a.parte LEFT JOIN b ON l.parte = b.parte""")
def al20(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    caps = lambda n, keys, lo, hi: l.groupBy(*keys).agg((F.avg("tallos") * lo).alias("lo"), (F.avg("tallos") * hi).alias("hi"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= n)
    levels = [(caps(12, ["parte", "destino"], 0.5, 1.5), ["parte", "destino"]), (caps(30, ["parte"], 0.6, 1.4), ["parte"])]
    return alloc.bound_by_caps(l, levels, "tallos", (10.0, 40.0)).select("pedido", long("grado"), "parte", r6("bounded"))


BLEND = PLACED + """, v AS (SELECT ciclo, fecha, x AS m, w AS b, stddev_pop(x) OVER q / avg(x) OVER q AS cm, stddev_pop(w) OVER q / avg(w) OVER q AS cb, w * sum(x) OVER q / sum(w) OVER q AS sb FROM c WINDOW q AS (PARTITION BY ciclo)),
y AS (SELECT *, CASE WHEN cb < 0.08 THEN m WHEN cm >= cb THEN 0.8 * m + 0.2 * sb ELSE 0.7 * m + 0.3 * sb END AS y FROM v),
bl AS (SELECT ciclo, fecha, CASE WHEN cm >= cb THEN 0.9 * y + 0.1 * avg(y) OVER k ELSE 0.8 * y + 0.2 * avg(y) OVER k END AS blended FROM y WINDOW k AS (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))"""


@query("al24_adaptive_blend", "WITH " + BLEND + " SELECT ciclo, fecha, round(blended, 6) AS blended FROM bl")
def al24(spark, sf):
    return alloc.adaptive_blend(daily(spark, sf), ["ciclo"], "fecha", "x", "w").select("ciclo", "fecha", r6("blended"))


@query("al21_harvest_chain", "WITH " + BLEND + """, t AS (SELECT ciclo, sum(x) * 1.1 AS total FROM d GROUP BY 1), k AS (SELECT bl.ciclo, fecha, total * blended / sum(blended) OVER (PARTITION BY bl.ciclo) AS stems FROM bl JOIN t ON bl.ciclo = t.ciclo),
s AS (SELECT ciclo, grado, sum(tallos) / sum(sum(tallos)) OVER (PARTITION BY ciclo) AS share FROM l GROUP BY 1, 2), g AS (SELECT grado, avg(tallos) AS stem_g FROM l GROUP BY 1)
SELECT k.ciclo, fecha, s.grado::BIGINT AS grade, round(stems * share, 6) AS stems, round(stems * share * stem_g / 1000, 6) AS kg FROM k JOIN s ON k.ciclo = s.ciclo LEFT JOIN g ON s.grado = g.grado""")
def al21(spark, sf):
    l, d = lines(spark, sf), daily(spark, sf)
    total = d.groupBy("ciclo").agg((F.sum("x") * 1.1).alias("total"))
    grades = l.groupBy("ciclo", F.col("grado").alias("grade")).agg(F.sum("tallos").alias("share"))
    weights = l.groupBy(F.col("grado").alias("grade")).agg(F.avg("tallos").alias("stem_g"))
    out = alloc.harvest_chain(d.join(total, "ciclo"), grades, weights, ["ciclo"], "fecha", "x", "w", "total")
    return out.select("ciclo", "fecha", long("grade"), r6("stems"), r6("kg"))


@query("al22_propagate_ratio", "WITH " + LINES + ' SELECT pedido, grado::BIGINT AS grado, parte, round(CASE WHEN "desc" > 0 THEN peso * tallos / "desc" ELSE peso END, 4) AS propagated FROM l')
def al22(spark, sf):
    return alloc.propagate_ratio(lines(spark, sf), "tallos", "desc", "peso").select("pedido", long("grado"), "parte", F.round("propagated", 4).alias("propagated"))


@query("al25_cap_spikes", "WITH " + PLACED + """, q AS (SELECT i, quantile_cont(w, 0.8) AS q, count(w) AS k FROM c GROUP BY 1),
e AS (SELECT c.*, q, k, list_sort([v FOR v IN [lag(w) OVER o, w, lead(w) OVER o] IF v IS NOT NULL]) AS near, quantile_cont(w, 0.5) OVER (PARTITION BY ciclo ORDER BY c.i ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS f FROM c JOIN q ON c.i = q.i WINDOW o AS (PARTITION BY ciclo ORDER BY c.i)),
b AS (SELECT *, least(w, CASE WHEN k >= 10 THEN q END, 2 * near[len(near) // 2 + 1], CASE WHEN i <= 2 THEN 2.25 * f END) AS b FROM e),
t AS (SELECT *, w - b AS cut, w - b <= 0 AND i / n BETWEEN 0.25 AND 0.80 AS takes FROM b),
s AS (SELECT *, sum(cut) OVER z AS cuts, sum(CASE WHEN takes THEN w ELSE 0 END) OVER z AS base FROM t WINDOW z AS (PARTITION BY ciclo))
SELECT ciclo, i, round(b + CASE WHEN takes AND base > 0 THEN cuts * w / base ELSE 0 END, 4) AS despiked FROM s""")
def al25(spark, sf):
    return alloc.cap_spikes(placed(spark, sf), ["ciclo"], "i", "w").select("ciclo", long("i"), F.round("despiked", 4).alias("despiked"))


@query("al26_decay_flat_tail", "WITH " + PLACED + """, f AS (SELECT ciclo, i, n, CASE WHEN ciclo % 2 = 0 AND i > n - 8 THEN 50.0 + i % 2 * 0.1 ELSE x END AS x FROM c), k AS (SELECT *, n - i + 1 AS r, least(n, 6) AS k FROM f),
m AS (SELECT *, avg(x) FILTER (r <= k) OVER q AS mean, stddev_pop(x) FILTER (r <= k) OVER q AS sd FROM k WINDOW q AS (PARTITION BY ciclo)),
y AS (SELECT *, x * CASE WHEN mean > 0 AND sd / mean < 0.01 AND r <= k THEN 1 - 0.08 * ((k - r) / greatest(k - 1, 1)) ELSE 1 END AS y FROM m)
SELECT ciclo, i, round(y * sum(x) OVER q / sum(y) OVER q, 6) AS decayed FROM y WINDOW q AS (PARTITION BY ciclo)""")
def al26(spark, sf):
    flat = F.when((F.col("ciclo") % 2 == 0) & (F.col("i") > F.col("n") - 8), 50.0 + F.col("i") % 2 * 0.1).otherwise(F.col("x"))
    return alloc.decay_flat_tail(placed(spark, sf).withColumn("x", flat), ["ciclo"], "i", "x").select("ciclo", long("i"), r6("decayed"))


@query("al27_scale_to_floor", "WITH " + PLACED + ", t AS (SELECT *, sum(x) OVER (PARTITION BY ciclo) AS s, sum(x) FILTER (ciclo % 2 = 0) OVER (PARTITION BY ciclo) * 1.2 AS o FROM c) SELECT ciclo, fecha, round(x * greatest(s * 0.9, coalesce(o, 0)) / s, 6) AS scaled FROM t")
def al27(spark, sf):
    total = F.sum("x").over(W.partitionBy("ciclo"))
    d = placed(spark, sf).withColumns({"projected": total * 0.9, "observed": F.when(F.col("ciclo") % 2 == 0, total * 1.2)})
    return alloc.scale_to_floor(d, ["ciclo"], "x", "projected", "observed").select("ciclo", "fecha", r6("scaled"))


@query("cv3_log_multiplier", "WITH " + PLACED + " SELECT ciclo, fecha, round(greatest(-0.5, least(0.5, ln((x / sum(x) OVER q + 1e-6) / (w / sum(w) OVER q + 1e-6)))), 6) AS log_mult FROM c WINDOW q AS (PARTITION BY ciclo)")
def cv3(spark, sf):
    d = windows.share_within(placed(spark, sf), ["ciclo"], "w", out="base")
    return curves.log_multiplier(d, ["ciclo"], "x", "base", 0.5).select("ciclo", "fecha", r6("log_mult"))


@query("cv4_apply_curve", "WITH " + PLACED + """, a AS (SELECT *, sum(x) OVER q * 1.1 AS total, w / sum(w) OVER q * exp(0.1 * (i % 3)) AS e FROM c WINDOW q AS (PARTITION BY ciclo)), s AS (SELECT *, 0.95 * e / sum(e) OVER (PARTITION BY ciclo) + 0.05 / n AS s FROM a),
m AS (SELECT *, avg(s) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM s), v AS (SELECT ciclo, fecha, total * m / sum(m) OVER (PARTITION BY ciclo) AS v FROM m), b AS (SELECT *, least(v, 30.0) AS b FROM v),
k AS (SELECT *, sum(v - b) OVER q AS e, sum(30.0 - b) OVER q AS s FROM b WINDOW q AS (PARTITION BY ciclo)) SELECT ciclo, fecha, round(b + (30.0 - b) * CASE WHEN s > 0 THEN least(1, e / s) ELSE 0 END, 6) AS value, round(greatest(e - s, 0), 4) AS uncovered FROM k""")
def cv4(spark, sf):
    d = windows.share_within(placed(spark, sf), ["ciclo"], "w", out="base")
    d = d.withColumns({"total": F.sum("x").over(W.partitionBy("ciclo")) * 1.1, "mult": 0.1 * (F.col("i") % 3), "cap": F.lit(30.0)})
    return curves.apply_curve(d, ["ciclo"], "fecha", "total", "base", "mult", "cap").select("ciclo", "fecha", r6("value"), F.round("uncovered", 4).alias("uncovered"))


@query("cv5_cdf_to_share", "WITH " + PLACED + f""", p AS (SELECT ciclo, fecha, greatest(0, least(1, sum(x) OVER (PARTITION BY ciclo ORDER BY fecha {RUN}) / sum(x) OVER (PARTITION BY ciclo) - 0.02 * (i % 3))) AS c FROM c),
m AS (SELECT *, max(c) OVER (PARTITION BY ciclo ORDER BY fecha {RUN}) AS m FROM p), z AS (SELECT *, (m - min(m) OVER q) / (max(m) OVER q - min(m) OVER q) AS z FROM m WINDOW q AS (PARTITION BY ciclo)),
s AS (SELECT *, z - coalesce(lag(z) OVER (PARTITION BY ciclo ORDER BY fecha), 0) AS s FROM z), k AS (SELECT *, avg(s) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS k FROM (SELECT ciclo, fecha, s / sum(s) OVER (PARTITION BY ciclo) AS s FROM s))
SELECT ciclo, fecha, round(k / sum(k) OVER (PARTITION BY ciclo), 6) AS cdf_share FROM k""")
def cv5(spark, sf):
    d = windows.progress(windows.share_within(placed(spark, sf), ["ciclo"], "w", out="base"), ["ciclo"], ["fecha"], "x")
    return curves.cdf_to_share(d.withColumn("cdf", F.col("pct") - 0.02 * (F.col("i") % 3)), ["ciclo"], "fecha", "cdf", "base").select("ciclo", "fecha", r6("cdf_share"))


@query("cv6_share_curve", "WITH " + PLACED + """, s AS (SELECT ciclo, fecha, least(x / sum(x) OVER (PARTITION BY ciclo), 1.5 / n) AS s FROM c), b AS (SELECT ciclo, fecha, s / sum(s) OVER (PARTITION BY ciclo) AS s FROM s),
m AS (SELECT ciclo, fecha, avg(s) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM b) SELECT ciclo, fecha, round(m / sum(m) OVER (PARTITION BY ciclo), 6) AS curve_share FROM m""")
def cv6(spark, sf):
    d = windows.share_within(placed(spark, sf), ["ciclo"], "x").withColumn("cap", 1.5 / F.col("n"))
    return curves.share_curve(d, ["ciclo"], "fecha", "share", "cap").select("ciclo", "fecha", r6("curve_share"))
