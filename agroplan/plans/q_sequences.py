"""Queries for windows, allocation, curves, grids and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alloc, checks, curves, grids, windows
from .base import DAILY, HOURLY, LINES, daily, hourly, lines, long, r6, table
from .registry import query

RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("wn2_supplier_progress", "WITH " + DAILY + f", p AS (SELECT ciclo, fecha, sum(x) OVER (PARTITION BY ciclo ORDER BY fecha {RUN}) AS cum, sum(x) OVER (PARTITION BY ciclo) AS t FROM d) SELECT ciclo, fecha, cum, floor(cum / t * 1e6)::BIGINT AS pct_millionths FROM p")
def wn2(spark, sf):
    return windows.progress(daily(spark, sf), ["ciclo"], ["fecha"], "x").select("ciclo", "fecha", "cum", F.floor(F.col("pct") * 1e6).cast("long").alias("pct_millionths"))


@query("wn1_share_within", "WITH " + LINES + " SELECT pedido, grado::BIGINT AS grado, round(tallos / sum(tallos) OVER (PARTITION BY pedido), 6) AS share FROM l")
def wn1(spark, sf):
    return windows.share_within(lines(spark, sf), ["pedido"], "tallos").select("pedido", long("grado"), r6("share"))


@query("wn3_wn4_monotone", "WITH " + DAILY + f", m AS (SELECT *, max(x) OVER (PARTITION BY ciclo ORDER BY fecha {RUN}) AS monotone FROM d) SELECT ciclo, fecha, monotone, monotone - coalesce(lag(monotone) OVER (PARTITION BY ciclo ORDER BY fecha), 0) AS increment FROM m")
def wn34(spark, sf):
    m = windows.monotone(daily(spark, sf), ["ciclo"], ["fecha"], "x")
    return windows.increments(m, ["ciclo"], ["fecha"], "monotone").select("ciclo", "fecha", "monotone", "increment")


@query("wn5_wn6_rolling", "WITH " + DAILY + " SELECT ciclo, fecha, round(avg(x) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS lag_mean, sum(x) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling FROM d")
def wn56(spark, sf):
    d = windows.lag_rolling_mean(daily(spark, sf), ["ciclo"], ["fecha"], "x", 7)
    return windows.rolling(d, ["ciclo"], ["fecha"], "x", 7).select("ciclo", "fecha", r6("lag_mean"), "rolling")


@query("wn7_smooth_share", "WITH " + DAILY + ", m AS (SELECT *, avg(x) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM d) SELECT ciclo, fecha, round(m / sum(m) OVER (PARTITION BY ciclo), 8) AS smooth FROM m")
def wn7(spark, sf):
    return windows.smooth_share(daily(spark, sf), ["ciclo"], ["fecha"], "x", 5).select("ciclo", "fecha", F.round("smooth", 8).alias("smooth"))


@query("wn8_edge_values", "WITH " + DAILY + ", v AS (SELECT ciclo, fecha, CASE WHEN x > 20 THEN x END AS x FROM d) SELECT ciclo, fecha, arg_min(x, fecha) FILTER (x IS NOT NULL) OVER (PARTITION BY ciclo) AS first_value, arg_max(x, fecha) FILTER (x IS NOT NULL) OVER (PARTITION BY ciclo) AS last_value FROM v")
def wn8(spark, sf):
    d = daily(spark, sf).withColumn("x", F.when(F.col("x") > 20, F.col("x")))
    return windows.edge_values(d, ["ciclo"], ["fecha"], "x").select("ciclo", "fecha", "first_value", "last_value")


@query("wn9_asof_snapshot", "WITH " + DAILY + """, s AS (SELECT ciclo, min(fecha) + 100 AS a FROM d GROUP BY 1), e AS (SELECT ciclo, a, a + o AS "asof" FROM s, (SELECT unnest([50, 200, 400]) AS o)),
j AS (SELECT e.ciclo, a, e."asof", x, row_number() OVER (PARTITION BY e.ciclo, e."asof" ORDER BY fecha DESC) AS n FROM e LEFT JOIN d ON e.ciclo = d.ciclo AND fecha BETWEEN a AND e."asof")
SELECT ciclo, "asof", count(x) AS n_rows, round(coalesce(sum(x), 0), 6) AS x_since, round(coalesce(sum(x) FILTER (n <= 7), 0), 6) AS x_last7, round(coalesce(sum(x) FILTER (n <= 14), 0), 6) AS x_last14 FROM j GROUP BY 1, 2""")
def wn9(spark, sf):
    d = daily(spark, sf)
    e = d.groupBy("ciclo").agg(F.date_add(F.min("fecha"), 100).alias("a")).withColumn("asof", F.explode(F.array(*(F.date_add("a", o) for o in (50, 200, 400)))))
    out = windows.asof_snapshot(d.select("ciclo", "fecha", "x"), e, ["ciclo"], "fecha", "a", "asof", ["x"])
    return out.select("ciclo", "asof", long("n_rows"), r6("x_since"), r6("x_last7"), r6("x_last14"))


@query("wn13_absorb_residual", "WITH " + DAILY + ", r AS (SELECT ciclo, fecha, floor(x * 0.37) AS y, round(sum(x) OVER (PARTITION BY ciclo) * 0.37, 3) AS t, max(fecha) OVER (PARTITION BY ciclo) AS z FROM d) SELECT ciclo, fecha, round(CASE WHEN fecha = z THEN y + t - sum(y) OVER (PARTITION BY ciclo) ELSE y END, 6) AS y FROM r")
def wn13(spark, sf):
    from pyspark.sql import Window as W

    d = daily(spark, sf).withColumns({"y": F.floor(F.col("x") * 0.37).cast("double"), "t": F.round(F.sum("x").over(W.partitionBy("ciclo")) * 0.37, 3)})
    return windows.absorb_residual(d, ["ciclo"], "fecha", "y", "t").select("ciclo", "fecha", r6("y"))


@query("wn15_clamped_balance", "WITH RECURSIVE " + HOURLY + """, m AS (SELECT station, avg(value) AS m FROM h GROUP BY 1), s AS (SELECT h.station, ts, (value - m) / 10 AS s, row_number() OVER (PARTITION BY h.station ORDER BY ts) AS n FROM h JOIN m ON h.station = m.station),
b AS (SELECT station, ts, n, 0.0::DOUBLE AS before, least(3.0, greatest(0.0, s))::DOUBLE AS bal FROM s WHERE n = 1 UNION ALL SELECT s.station, s.ts, s.n, b.bal, least(3.0, greatest(0.0, b.bal + s.s))::DOUBLE FROM b JOIN s ON s.station = b.station AND s.n = b.n + 1)
SELECT station, ts, round(before, 6) AS balance_before, round(bal, 6) AS balance, CASE WHEN round(bal, 6) <= 0.3 THEN 'SECO' WHEN round(bal, 6) <= 2.0 THEN 'HUMEDO' ELSE 'MOJADO' END AS state FROM b""")
def wn15(spark, sf):
    h = hourly(spark, sf)
    mean = h.groupBy("station").agg(F.avg("value").alias("m"))
    s = h.join(mean, "station").withColumn("s", (F.col("value") - F.col("m")) / 10)
    out = windows.clamped_balance(s, ["station"], "ts", "s", 0.0, 3.0).select("station", "ts", r6("balance_before"), r6("balance"))
    return out.withColumn("state", windows.wetness_state(F.col("balance")))


@query("al3_split_by_share", "WITH " + LINES + ", g AS (SELECT destino, grado, sum(tallos) AS t FROM l GROUP BY 1, 2), s AS (SELECT destino, grado, t / sum(t) OVER (PARTITION BY destino) AS p FROM g), o AS (SELECT destino, ciclo, sum(peso) AS peso FROM l GROUP BY 1, 2) SELECT o.destino, ciclo, grado::BIGINT AS grado, round(peso * p, 4) AS value FROM o JOIN s ON o.destino = s.destino")
def al3(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    s = windows.share_within(l.groupBy("destino", "grado").agg(F.sum("tallos").alias("t")), ["destino"], "t", out="p").select("destino", "grado", "p")
    return alloc.split_by_share(l.groupBy("destino", "ciclo").agg(F.sum("peso").alias("peso")), s, ["destino"], "peso", "p").select("destino", "ciclo", long("grado"), F.round("value", 4).alias("value"))


@query("al2_al7_split_by_effort", "WITH " + DAILY + ", t AS (SELECT ciclo, sum(x) * 1.1 AS total FROM d GROUP BY 1) SELECT d.ciclo, fecha, round(total * sqrt(w) / sum(sqrt(w)) OVER (PARTITION BY d.ciclo), 6) AS units FROM d JOIN t ON d.ciclo = t.ciclo")
def al27(spark, sf):
    d = daily(spark, sf)
    t = d.groupBy("ciclo").agg((F.sum("x") * 1.1).alias("total"))
    return alloc.split_by_effort(d.join(t, "ciclo").withColumn("e", F.sqrt("w")), ["ciclo"], "total", "e").select("ciclo", "fecha", r6("units"))


@query("al5_override_share", "WITH " + LINES + """, g AS (SELECT ciclo, grado, sum(tallos) AS t, sum(peso) AS w, count(*) AS n FROM l GROUP BY 1, 2), s AS (SELECT ciclo, grado, t / sum(t) OVER (PARTITION BY ciclo) AS share FROM g), r AS (SELECT ciclo, grado, CASE WHEN n >= 60 THEN w / sum(w) OVER (PARTITION BY ciclo) END AS share FROM g),
m AS (SELECT s.ciclo, s.grado, coalesce(r.share, s.share) AS share, CASE WHEN r.share IS NULL THEN 'PLAN' ELSE 'REAL' END AS source FROM s LEFT JOIN r ON s.ciclo = r.ciclo AND s.grado = r.grado) SELECT ciclo, grado::BIGINT AS grado, source, round(share / sum(share) OVER (PARTITION BY ciclo), 6) AS share FROM m""")
def al5(spark, sf):
    """Shares by weight stand in for observed ones, where a grade has lines enough to tell."""
    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"), F.sum("peso").alias("w"), F.count(F.lit(1)).alias("n"))
    real = windows.share_within(g, ["ciclo"], "w").withColumn("share", F.when(F.col("n") >= 60, F.col("share")))
    plan = windows.share_within(g, ["ciclo"], "t").select("ciclo", "grado", "share")
    return alloc.override_share(plan, real, ["ciclo", "grado"], ["ciclo"]).select("ciclo", long("grado"), "source", r6("share"))


@query("al8_cap_redistribute", "WITH " + DAILY + """, c AS (SELECT *, 30.0 + (day(fecha) % 7) AS cap FROM d), b AS (SELECT *, least(x, cap) AS b FROM c), e AS (SELECT *, sum(x - b) OVER (PARTITION BY ciclo) AS e, sum(cap - b) OVER (PARTITION BY ciclo) AS s FROM b)
SELECT ciclo, fecha, round(b + (cap - b) * CASE WHEN s > 0 THEN least(1, e / s) ELSE 0 END, 6) AS capped, round(greatest(e - s, 0), 6) AS uncovered FROM e""")
def al8(spark, sf):
    d = daily(spark, sf).withColumn("cap", 30.0 + F.dayofmonth("fecha") % 7)
    return alloc.cap_redistribute(d, ["ciclo"], "x", "cap").select("ciclo", "fecha", r6("capped"), r6("uncovered"))


@query("al11_anchor_to_actual", "WITH " + DAILY + """, p AS (SELECT ciclo, fecha, x AS real, x * (1 + 0.1 * (day(fecha) % 3)) AS pred, ciclo % 4 = 0 AS closed, fecha <= DATE '1996-06-30' AS seen FROM d),
t AS (SELECT *, sum(pred) OVER w - sum(CASE WHEN seen THEN real ELSE 0 END) OVER w AS rest, sum(CASE WHEN seen THEN 0 ELSE pred END) OVER w AS ahead FROM p WINDOW w AS (PARTITION BY ciclo))
SELECT ciclo, fecha, round(CASE WHEN closed OR seen THEN real WHEN ahead > 0 THEN pred * greatest(rest, 0) / ahead ELSE 0 END, 6) AS anchored FROM t""")
def al11(spark, sf):
    d = daily(spark, sf).withColumns({"pred": F.col("x") * (1 + 0.1 * (F.dayofmonth("fecha") % 3)), "closed": F.col("ciclo") % 4 == 0})
    return alloc.anchor_to_actual(d, ["ciclo"], "fecha", "pred", "x", F.lit("1996-06-30").cast("date"), "closed").select("ciclo", "fecha", r6("anchored"))


@query("al13_extend_horizon", "WITH " + DAILY + ", h AS (SELECT ciclo, 40 AS elapsed, 60 AS horizon, sum(x) FILTER (fecha < DATE '1995-06-01') / sum(x) AS done, 0.55 AS expected FROM d GROUP BY 1) SELECT ciclo, coalesce(done > 0 AND done < 0.98 * expected, false) AS is_late, CASE WHEN done > 0 AND done < 0.98 * expected THEN greatest(least(ceil(elapsed / done), 120), horizon) ELSE horizon END::BIGINT AS horizon_new FROM h")
def al13(spark, sf):
    h = daily(spark, sf).groupBy("ciclo").agg((F.sum(F.when(F.col("fecha") < "1995-06-01", F.col("x"))) / F.sum("x")).alias("done"))
    h = h.withColumns({"elapsed": F.lit(40), "horizon": F.lit(60), "expected": F.lit(0.55)})
    return alloc.extend_horizon(h, "elapsed", "horizon", "done", "expected").select("ciclo", "is_late", long("horizon_new"))


@query("al14_rescale_to_target", "WITH " + DAILY + ", t AS (SELECT *, month(fecha) <= 3 AS fixed, sum(x) OVER (PARTITION BY ciclo) * 0.8 AS target FROM d), k AS (SELECT *, sum(CASE WHEN fixed THEN x ELSE 0 END) OVER w AS kept, sum(CASE WHEN fixed THEN 0 ELSE x END) OVER w AS free FROM t WINDOW w AS (PARTITION BY ciclo)) SELECT ciclo, fecha, round(CASE WHEN fixed THEN x WHEN free > 0 THEN x * (greatest(target, kept) - kept) / free ELSE x END, 6) AS rescaled FROM k")
def al14(spark, sf):
    from pyspark.sql import Window as W

    d = daily(spark, sf).withColumn("target", F.sum("x").over(W.partitionBy("ciclo")) * 0.8)
    return alloc.rescale_to_target(d, ["ciclo"], "x", "target", F.month("fecha") <= 3).select("ciclo", "fecha", r6("rescaled"))


@query("al16_fill_residual", "WITH " + LINES + """, g AS (SELECT ciclo, grado, sum(tallos) AS t FROM l GROUP BY 1, 2), m AS (SELECT *, sum(t) OVER (PARTITION BY ciclo) AS total, CASE WHEN grado <= 4 THEN t * 0.9 END AS "real", t / sum(t) OVER (PARTITION BY ciclo) AS mix FROM g),
f AS (SELECT *, CASE WHEN "real" IS NOT NULL THEN "real" WHEN sum(CASE WHEN "real" IS NULL THEN mix ELSE 0 END) OVER w > 0 THEN greatest(total - sum(coalesce("real", 0)) OVER w, 0) * mix / sum(CASE WHEN "real" IS NULL THEN mix ELSE 0 END) OVER w ELSE 0 END AS f FROM m WINDOW w AS (PARTITION BY ciclo))
SELECT ciclo, grado::BIGINT AS grado, round(f * total / sum(f) OVER (PARTITION BY ciclo), 6) AS filled FROM f""")
def al16(spark, sf):
    from pyspark.sql import Window as W

    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"))
    g = g.withColumns({"total": F.sum("t").over(W.partitionBy("ciclo")), "real": F.when(F.col("grado") <= 4, F.col("t") * 0.9)}).withColumn("mix", F.col("t") / F.col("total"))
    return alloc.fill_residual(g, ["ciclo"], "real", "mix", "total").select("ciclo", long("grado"), r6("filled"))


@query("al18_complete_horizon", "WITH n AS (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS d, l_quantity AS q FROM lineitem), k AS (SELECT l_orderkey, unnest(range(1, 8)) AS d FROM (SELECT DISTINCT l_orderkey FROM n)) SELECT coalesce(n.l_orderkey, k.l_orderkey) AS l_orderkey, coalesce(n.d, k.d) AS d, q FROM n FULL JOIN k ON n.l_orderkey = k.l_orderkey AND n.d = k.d")
def al18(spark, sf):
    n = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("d"), F.col("l_quantity").alias("q"), F.lit(7).alias("n")).distinct()
    return alloc.complete_horizon(n, ["l_orderkey"], "d", "n", ["q"]).select("l_orderkey", long("d"), "q")


@query("al19_shrink_to_prior", "WITH " + LINES + """, g AS (SELECT ciclo, grado, sum(tallos) AS t, sum(peso) AS w FROM l GROUP BY 1, 2), s AS (SELECT *, t / sum(t) OVER (PARTITION BY ciclo) AS y, w / sum(w) OVER (PARTITION BY ciclo) AS p FROM g), r AS (SELECT *, avg(y) OVER (PARTITION BY grado) AS prior FROM s),
x AS (SELECT grado, i * 0.9 / 18 AS l, sum(t * abs((1 - i * 0.9 / 18) * p + i * 0.9 / 18 * prior - y)) / sum(t) AS e, count(*) AS n FROM r, (SELECT unnest(range(0, 19)) AS i) GROUP BY 1, 2), o AS (SELECT grado, arg_min(l, (e, l)) AS l FROM x WHERE n >= 5 GROUP BY 1)
SELECT r.grado::BIGINT AS grado, count(*) AS n, round(max(o.l), 6) AS lambda FROM r JOIN o ON r.grado = o.grado GROUP BY 1""")
def al19(spark, sf):
    from pyspark.sql import Window as W

    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"), F.sum("peso").alias("w"))
    g = windows.share_within(windows.share_within(g, ["ciclo"], "t", out="y"), ["ciclo"], "w", out="p").withColumn("prior", F.avg("y").over(W.partitionBy("grado")))
    out = alloc.shrink_to_prior(g, ["ciclo"], "p", "prior", "y", "t", "grado", 5)
    return out.groupBy("grado").agg(F.count(F.lit(1)).alias("n"), F.max("lambda").alias("lambda")).select(long("grado"), "n", r6("lambda"))


@query("al23_required_hours", "SELECT o_orderpriority, round(count(*) / 37.5, 6) AS hours, ceil(round(count(*) / 37.5, 9) / 9.5)::BIGINT AS people FROM orders GROUP BY 1")
def al23(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("u")).withColumn("rate", F.lit(37.5))
    return alloc.required_hours(o, "u", "rate").select("o_orderpriority", r6("hours"), long("people"))


@query("al28_level_constant", "WITH p AS (SELECT l_orderkey, count(DISTINCT l_linestatus) AS d, count(l_linestatus) AS n FROM lineitem GROUP BY 1) SELECT round(avg((d = 1)::DOUBLE), 6) AS constant_rate, count(*) AS n_groups, avg((d = 1)::DOUBLE) > 0.01 AS not_at_this_grain FROM p WHERE n > 1")
def al28(spark, sf):
    return alloc.check_level_constant(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linestatus").select(r6("constant_rate"), "n_groups", "not_at_this_grain")


CURVE = DAILY + ", c AS (SELECT *, (row_number() OVER (PARTITION BY ciclo ORDER BY fecha) - 0.5) / count(*) OVER (PARTITION BY ciclo) AS rel FROM d)"


def _curve(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("ciclo")
    return daily(spark, sf).withColumn("rel", (F.row_number().over(w.orderBy("fecha")) - 0.5) / F.count(F.lit(1)).over(w))


@query("cv1_beta_share", "WITH " + CURVE + ", e AS (SELECT *, exp(1.5 * ln(rel) + 2.0 * ln(1 - rel)) AS e FROM c) SELECT ciclo, fecha, round(e / sum(e) OVER (PARTITION BY ciclo), 8) AS beta_share FROM e")
def cv1(spark, sf):
    d = _curve(spark, sf).withColumns({"a": F.lit(2.5), "b": F.lit(3.0)})
    return curves.beta_share(d, ["ciclo"], "rel", "a", "b").select("ciclo", "fecha", F.round("beta_share", 8).alias("beta_share"))


@query("cv2_fit_beta", "WITH " + CURVE + """, x AS (SELECT ciclo, greatest(1e-4, least(1 - 1e-4, rel)) AS x, x AS s, x / sum(x) OVER (PARTITION BY ciclo) AS w FROM c), m AS (SELECT ciclo, sum(x * s) / sum(s) AS mu, sum(x * x * s) / sum(s) AS m2 FROM x GROUP BY 1),
k AS (SELECT ciclo, mu, greatest(mu * (1 - mu) / greatest(m2 - mu * mu, 1e-4) - 1, 2.05) AS k FROM m), a AS (SELECT ciclo, greatest(mu * k, 1.01) AS a0, greatest((1 - mu) * k, 1.01) AS b0 FROM k),
g AS (SELECT ciclo, i, j, greatest(a0 * exp(i * 0.12), 1.0001) AS al, greatest(b0 * exp(j * 0.12), 1.0001) AS be FROM a, (SELECT unnest(range(-7, 8)) AS i), (SELECT unnest(range(-7, 8)) AS j)),
f AS (SELECT g.ciclo, i, j, ln(sum(exp((al - 1) * ln(x) + (be - 1) * ln(1 - x)))) - sum(w * ((al - 1) * ln(x) + (be - 1) * ln(1 - x))) AS nll FROM g JOIN x ON g.ciclo = x.ciclo GROUP BY 1, 2, 3)
SELECT ciclo, round(min(nll), 6) AS nll FROM f GROUP BY 1""")
def cv2(spark, sf):
    return curves.fit_beta(_curve(spark, sf), ["ciclo"], "rel", "x").select("ciclo", r6("nll"))


@query("cv8_curve_metrics", "WITH " + CURVE + f""", p AS (SELECT ciclo, fecha, rel, x / sum(x) OVER (PARTITION BY ciclo) AS p, w / sum(w) OVER (PARTITION BY ciclo) AS q, row_number() OVER (PARTITION BY ciclo ORDER BY fecha) AS i FROM c), g AS (SELECT *, abs(sum(p - q) OVER (PARTITION BY ciclo ORDER BY i {RUN})) AS g FROM p)
SELECT ciclo, round(sum(abs(p - q)), 6) AS l1, round(max(g), 6) AS ks, round(sum(CASE WHEN rel <= 0.2 THEN p ELSE 0 END), 6) AS early_p, round(sum(CASE WHEN rel >= 0.8 THEN q ELSE 0 END), 6) AS late_q FROM g GROUP BY 1""")
def cv8(spark, sf):
    from pyspark.sql import Window as W

    d = windows.share_within(windows.share_within(_curve(spark, sf), ["ciclo"], "x", out="p"), ["ciclo"], "w", out="q").withColumn("i", F.row_number().over(W.partitionBy("ciclo").orderBy("fecha")))
    return curves.curve_metrics(d, ["ciclo"], "i", "p", "q", "rel").select("ciclo", r6("l1"), r6("ks"), r6("early_p"), r6("late_q"))


@query("cv7_summarise_cycle", "WITH " + DAILY + " SELECT ciclo, round(avg(x), 6) AS x_mean, sum(x) AS x_sum, arg_max(x, fecha) AS x_last FROM d GROUP BY 1")
def cv7(spark, sf):
    return curves.summarise_cycle(daily(spark, sf), ["ciclo"], "fecha", ["x"], ["x"], ["x"]).select("ciclo", r6("x_mean"), "x_sum", "x_last")


@query("gr1_explode_dates", "WITH i AS (SELECT l_orderkey, l_linenumber::BIGINT AS line, l_shipdate::DATE AS a, l_shipdate::DATE + round_even(l_quantity / 10, 0)::INT - 1 AS z FROM lineitem) SELECT l_orderkey, line, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS day FROM i WHERE z >= a")
def gr1(spark, sf):
    days = F.rint(F.col("l_quantity") / 10).cast("int")
    l = table(spark, sf, "lineitem").withColumn("a", F.to_date("l_shipdate")).withColumn("z", F.date_add("a", days - 1))  # noqa: E741
    return grids.explode_dates(l, "a", "z").select("l_orderkey", long("l_linenumber", "line"), "day")


@query("gr2_explode_n_days", "WITH i AS (SELECT c_custkey, DATE '1995-01-01' AS a, round_even(c_acctbal / 1000, 0)::INT AS n FROM customer) SELECT c_custkey, k AS day_index, a + k::INT - 1 AS day, round(k / n, 6) AS rel FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM i WHERE n >= 1)")
def gr2(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.lit("1995-01-01").cast("date").alias("a"), (F.col("c_acctbal") / 1000).alias("n"))
    return grids.explode_n_days(c, "a", "n").select("c_custkey", long("day_index"), "day", r6("rel"))


@query("gr3_asof_dates", "WITH " + LINES + """, s AS (SELECT ciclo, min(fecha) AS a, min(fecha) + 20 + (ciclo % 100)::INT AS z FROM l GROUP BY 1), g AS (SELECT ciclo, z - 1 AS last, unnest(generate_series(a + 14, z - 1, INTERVAL 7 DAY))::DATE AS "asof" FROM s WHERE a + 14 <= z - 1), u AS (SELECT ciclo, "asof" FROM g UNION SELECT ciclo, last FROM g)
SELECT ciclo, "asof" FROM u QUALIFY row_number() OVER (PARTITION BY ciclo ORDER BY "asof" DESC) <= 10""")
def gr3(spark, sf):
    s = lines(spark, sf).groupBy("ciclo").agg(F.min("fecha").alias("a")).withColumn("z", F.date_add("a", (20 + F.col("ciclo") % 100).cast("int")))
    return grids.asof_dates(s, "a", "z").select("ciclo", "asof")


@query("gr4_gr5_stage_windows", "WITH " + LINES + """, m AS (SELECT ciclo, min(fecha) AS a, min(fecha) + 90 AS b, max(fecha) AS z FROM l GROUP BY 1)
SELECT ciclo, 'VEG' AS stage, a AS start, b - 1 AS "end" FROM m UNION ALL SELECT ciclo, 'HARVEST', b, CASE WHEN z >= b THEN z END FROM m UNION ALL SELECT ciclo, 'POST', b, CASE WHEN z + 9 >= b THEN z + 9 END FROM m""")
def gr45(spark, sf):
    m = lines(spark, sf).groupBy("ciclo").agg(F.min("fecha").alias("a"), F.max("fecha").alias("z"))
    long_ = grids.milestones(m, ["ciclo"], {"SP": F.col("a"), "START": F.date_add("a", 90), "END": F.col("z")}, "REAL")
    return grids.stage_windows(long_, ["ciclo"], {"VEG": ("SP", "START", -1), "HARVEST": ("START", "END", 0), "POST": ("START", "END", 9)}).select("ciclo", "stage", "start", "end")


@query("gr6_infer_milestones", "WITH " + LINES + """, h AS (SELECT pedido, min(destino) AS seg, date_diff('day', min(fecha), max(fecha)) AS n FROM l GROUP BY 1), s AS (SELECT seg, median(n) AS m FROM h GROUP BY 1 HAVING count(n) >= 300), g AS (SELECT median(n) AS m FROM h)
SELECT pedido, DATE '1996-01-01' + round_even(coalesce(s.m, g.m), 0)::INT AS finish, CASE WHEN s.m IS NULL THEN 2 ELSE 1 END::BIGINT AS finish_level FROM h LEFT JOIN s ON h.seg = s.seg CROSS JOIN g""")
def gr6(spark, sf):
    h = lines(spark, sf).groupBy("pedido").agg(F.min("destino").alias("seg"), F.datediff(F.max("fecha"), F.min("fecha")).alias("n")).withColumn("a", F.lit("1996-01-01").cast("date"))
    return grids.infer_milestones(h, h, ["seg"], "a", {"finish": "n"}, 300).select("pedido", "finish", long("finish_level"))


@query("gr8_residual_dataset", "WITH r AS (SELECT l_suppkey AS s, l_shipdate::DATE AS d, sum(l_extendedprice * (1 - l_discount)) AS p, sum(l_extendedprice) AS y, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) SELECT s, d, CASE WHEN q >= 20 THEN round(greatest(-0.05, least(0.05, ln((y + 1e-6) / (p + 1e-6)))), 6) END AS target, q >= 20 AS in_real FROM r WHERE d <= DATE '1995-06-30'")
def gr8(spark, sf):
    r = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.to_date("l_shipdate").alias("d")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p"), F.sum("l_extendedprice").alias("y"), F.sum("l_quantity").alias("q"))
    real = r.withColumn("y", F.when(F.col("q") >= 20, F.col("y")))  # small days were not weighed
    return grids.residual_dataset(r.select("s", "d", "p"), real, ["s", "d"], "p", "y", "log", (-0.05, 0.05), "d", "1995-06-30").select("s", "d", r6("target"), "in_real")


PRED = LINES + ', e AS (SELECT *, peso * (1 - "desc") AS p FROM l)'


def _pred(spark, sf):
    return lines(spark, sf).withColumn("p", F.col("peso") * (1 - F.col("desc")))


@query("ev1_ev2_error_metrics", "WITH " + PRED + """, m AS (SELECT destino, count(*) AS n, sum(tallos) AS w, sum(tallos * abs(p - peso)) AS ae, sum(tallos * (p - peso)) AS b, sum(tallos * (p - peso) ^ 2) AS se, sum(tallos * peso) / sum(tallos) AS my, sum(tallos * peso * peso) AS yy, sum(tallos * abs(peso)) AS ay, sum(tallos * 2 * abs(p - peso) / (abs(p) + abs(peso))) AS sm FROM e GROUP BY 1)
SELECT destino, n, round(ae / w, 4) AS mae, round(b / w, 4) AS bias, round(sqrt(se / w), 4) AS rmse, round(1 - se / (yy - w * my * my), 4) AS r2, round(ae / ay, 6) AS wape, round(sm / w, 6) AS smape FROM m""")
def ev12(spark, sf):
    m = checks.error_metrics(_pred(spark, sf), "peso", "p", "tallos", ["destino"])
    return m.select("destino", "n", *(F.round(c, 4).alias(c) for c in ("mae", "bias", "rmse", "r2")), r6("wape"), r6("smape"))


@query("ev3_log_ratio_mae", "WITH " + PRED + " SELECT destino, count(*) AS n, round(sum(tallos * abs(ln(p / peso))) / sum(tallos), 6) AS log_mae FROM e WHERE p > 0 GROUP BY 1")
def ev3(spark, sf):
    return checks.log_ratio_mae(_pred(spark, sf), "peso", "p", "tallos", ["destino"]).select("destino", "n", r6("log_mae"))


@query("ev4_compare_models", "WITH " + PRED + """, s AS (SELECT 'ALL' AS segment, 'ALL' AS value, peso, p FROM e UNION ALL SELECT 'destino', destino, peso, p FROM e UNION ALL SELECT 'grado', grado::VARCHAR, peso, p FROM e)
SELECT segment, value, count(*) AS n, round(avg(abs(p - peso)), 4) AS mae_a, round(avg(abs(p * 1.04 - peso)), 4) AS mae_b, round(1 - avg(abs(p * 1.04 - peso)) / avg(abs(p - peso)), 6) AS improvement FROM s GROUP BY 1, 2""")
def ev4(spark, sf):
    c = checks.compare_models(_pred(spark, sf).withColumn("q", F.col("p") * 1.04), "peso", "p", "q", ["destino", "grado"])
    return c.select("segment", "value", "n", F.round("mae_a", 4).alias("mae_a"), F.round("mae_b", 4).alias("mae_b"), r6("improvement"))


@query("ev5_describe_dist", "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, " + ", ".join(f"round(quantile_cont(value, {q}), 6) AS p{round(q * 100):02d}" for q in (0.05, 0.25, 0.5, 0.75, 0.95)) + " FROM events GROUP BY 1")
def ev5(spark, sf):
    return checks.describe_dist(table(spark, sf, "events"), "value", ["event_type"]).select("event_type", "n", *(r6(c) for c in ("mean", "p05", "p25", "p50", "p75", "p95")))


@query("ev6_zero_rates", "WITH " + LINES + """, d AS (SELECT ciclo, fecha, sum("desc") AS y, sum("desc" * (parte % 3)) AS p, sum(tallos) AS w FROM l GROUP BY 1, 2) SELECT count(*) AS n_days, round(sum(CASE WHEN y > 0.03 AND p <= 0.05 THEN w ELSE 0 END) / sum(CASE WHEN y > 0.03 THEN w END), 6) AS nonzero_as_zero, round(sum(CASE WHEN y <= 0.03 AND p > 0.05 THEN w ELSE 0 END) / sum(CASE WHEN y <= 0.03 THEN w END), 6) AS zero_as_nonzero FROM d""")
def ev6(spark, sf):
    l = lines(spark, sf).withColumn("p", F.col("desc") * (F.col("parte") % 3))  # noqa: E741
    return checks.zero_rates(l, ["ciclo", "fecha"], "desc", "p", "tallos").select("n_days", r6("nonzero_as_zero"), r6("zero_as_nonzero"))


@query("au_checks", "WITH " + LINES + """, u AS (SELECT (sum(n - 1) / sum(n))::DOUBLE AS v FROM (SELECT count(*) AS n FROM l GROUP BY pedido, grado)), c AS (SELECT avg((c_custkey NOT IN (SELECT o_custkey FROM orders))::INT) AS v FROM customer), r AS (SELECT avg((NOT "desc" BETWEEN 0 AND 0.09)::INT) AS v FROM l), k AS (SELECT count(*)::DOUBLE AS v FROM (SELECT pedido FROM l GROUP BY 1 HAVING count(DISTINCT destino) > 1)),
a AS (SELECT 'AU1_unique' AS check_id, 'lineitem' AS source, '' AS key, v FROM u UNION ALL SELECT 'AU3_coverage', 'orders', '', v FROM c UNION ALL SELECT 'AU5_range', 'lineitem', 'desc', v FROM r UNION ALL SELECT 'AU6_constant', 'lineitem', 'destino', v FROM k)
SELECT check_id, source, key, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status, round(v, 6) AS value, 0.0::DOUBLE AS expected, 0.0::DOUBLE AS tolerance, '' AS details FROM a""")
def au(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    customers, orders = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    parts = [checks.check_unique(l, ["pedido", "grado"], "lineitem"), checks.check_coverage(customers, orders, ["k"], "orders"), checks.check_ranges(l, {"desc": (0, 0.09)}, "lineitem"), checks.check_constant(l, ["pedido"], "destino", "lineitem")]
    return checks.all_checks(parts).withColumn("value", r6("value"))


@query("au9_clip_impact", "WITH " + CURVE + " SELECT least(floor(rel * 10), 9)::BIGINT AS bin, count(*) AS n, round(avg((x > 40)::INT), 6) AS hit_rate, round(sum(greatest(x - 40, 0)), 4) AS mass_cut FROM c GROUP BY 1")
def au9(spark, sf):
    d = _curve(spark, sf).withColumn("y", F.least(F.col("x"), F.lit(40.0)))
    return checks.clip_impact(d, [], "rel", "x", "y").select(long("bin"), "n", r6("hit_rate"), F.round("mass_cut", 4).alias("mass_cut"))
