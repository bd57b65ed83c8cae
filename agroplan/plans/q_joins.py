"""Queries for joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs, grain, joins, windows
from .base import DAILY, LINES, daily, lines, long, r6, table
from .registry import query


@query("jn4_complete_grid", "SELECT s_suppkey, g::BIGINT AS g, count(l_orderkey) AS n FROM supplier CROSS JOIN (SELECT DISTINCT l_linenumber AS g FROM lineitem) LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_linenumber = g GROUP BY 1, 2")
def jn4(spark, sf):
    li = table(spark, sf, "lineitem")
    grid = joins.complete_grid(table(spark, sf, "supplier").select("s_suppkey"), li.select(F.col("l_linenumber").alias("g")).distinct())
    n = li.groupBy(F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["s_suppkey", "g"], "left").fillna(0, ["n"]).select("s_suppkey", long("g"), "n")


@query("jn5_key_overlap", "SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS n_a, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_b, (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) AS n_both")
def jn5(spark, sf):
    return joins.key_overlap(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


def _starts(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("start")).agg(F.max("o_orderkey").alias("ciclo_id")).withColumn("until", F.date_add("start", 400))


def _days(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("o_custkey").alias("k"), F.to_date("l_shipdate").alias("fecha"), "l_orderkey", F.col("l_linenumber").cast("long").alias("line"))


STARTS = """s AS (SELECT o_custkey AS k, o_orderdate::DATE AS start, max(o_orderkey) AS ciclo_id FROM orders GROUP BY 1, 2),
f AS (SELECT o_custkey AS k, l_shipdate::DATE AS fecha, l_orderkey, l_linenumber::BIGINT AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("jn7_asof_backward", "WITH " + STARTS + " SELECT f.l_orderkey, f.line, f.fecha, CASE WHEN s.start + 400 >= f.fecha THEN s.ciclo_id END AS ciclo_id FROM f ASOF LEFT JOIN s ON f.k = s.k AND f.fecha >= s.start")
def jn7(spark, sf):
    found = joins.asof_backward(_days(spark, sf), _starts(spark, sf), ["k"], "fecha", "start", ["ciclo_id", "until"], "until")
    return found.select("l_orderkey", "line", "fecha", "ciclo_id")


@query("jn8_nearest_join", "WITH " + STARTS + """, b AS (SELECT f.*, s.start AS b, s.ciclo_id AS bi FROM f ASOF LEFT JOIN s ON f.k = s.k AND f.fecha >= s.start),
a AS (SELECT b.*, s.start AS a, s.ciclo_id AS ai FROM b ASOF LEFT JOIN s ON b.k = s.k AND b.fecha <= s.start)
SELECT l_orderkey, line, CASE WHEN a IS NULL OR (b IS NOT NULL AND fecha - b <= a - fecha) THEN bi ELSE ai END AS ciclo_id FROM a""")
def jn8(spark, sf):
    right = _starts(spark, sf).withColumn("sx", F.unix_date("start"))
    found = joins.nearest_join(_days(spark, sf).withColumn("fx", F.unix_date("fecha")), right, ["k"], "fx", "sx", ["ciclo_id"])
    return found.select("l_orderkey", "line", "ciclo_id")


WINDOWS = """w AS (SELECT l_suppkey AS k, 'VEG' AS stage, min(l_shipdate)::DATE AS a, min(l_shipdate)::DATE + 700 AS z, 1 AS p FROM lineitem GROUP BY 1
UNION ALL SELECT l_suppkey, 'HARVEST', min(l_shipdate)::DATE + 600, min(l_shipdate)::DATE + 1500, 2 FROM lineitem GROUP BY 1
UNION ALL SELECT l_suppkey, 'POST', min(l_shipdate)::DATE + 1400, NULL, 3 FROM lineitem GROUP BY 1)"""


@query("jn9_assign_interval", "WITH " + WINDOWS + " SELECT l_orderkey, l_linenumber::BIGINT AS line, arg_max(stage, p) AS stage FROM lineitem LEFT JOIN w ON l_suppkey = k AND l_shipdate::DATE >= a AND (z IS NULL OR l_shipdate::DATE <= z) GROUP BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_partkey")
def jn9(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("d"), "l_orderkey", long("l_linenumber", "line"))
    first = li.groupBy("k").agg(F.min("d").alias("m"))
    rows = F.inline(F.array(*(F.struct(F.lit(s).alias("stage"), F.date_add("m", a).alias("a"), (F.date_add("m", z) if z else F.lit(None).cast("date")).alias("z"), F.lit(p).alias("p")) for s, a, z, p in (("VEG", 0, 700, 1), ("HARVEST", 600, 1500, 2), ("POST", 1400, None, 3)))))
    return joins.assign_interval(li, first.select("k", rows), ["k"], "d", "a", "z", "stage", "p").select("l_orderkey", "line", "stage")


@query("jn11_overlap_hours", """
WITH s AS (SELECT event_id, ts AS a, ts + INTERVAL 1 SECOND * (1 + abs(value)::BIGINT * 60) AS z FROM events),
h AS (SELECT event_id, a, z, unnest(generate_series(date_trunc('hour', a), date_trunc('hour', z), INTERVAL 1 HOUR)) AS hour FROM s)
SELECT event_id, hour, round((least(epoch_us(z), epoch_us(hour) + 3600000000) - greatest(epoch_us(a), epoch_us(hour))) / 3.6e9, 6) AS overlap_h FROM h
WHERE least(epoch_us(z), epoch_us(hour) + 3600000000) > greatest(epoch_us(a), epoch_us(hour))""")
def jn11(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("ts").alias("a"), (F.col("ts") + F.make_dt_interval(secs=(1 + F.rint(F.abs("value")) * 60).cast("decimal(18,6)"))).alias("z"))
    return joins.overlap_hours(e, "a", "z").select("event_id", "hour", r6("overlap_h"))


@query("jn12_lookup_cascade", "WITH " + LINES + """, a AS (SELECT parte, destino, avg(tallos) AS v FROM l GROUP BY 1, 2 HAVING count(*) >= 12),
b AS (SELECT parte, avg(tallos) AS v FROM l GROUP BY 1 HAVING count(*) >= 30), g AS (SELECT avg(tallos) AS v FROM l)
SELECT pedido, l.grado::BIGINT AS grado, l.parte, round(coalesce(a.v, b.v, g.v), 6) AS v, CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 ELSE 3 END::BIGINT AS v_level
FROM l LEFT JOIN a ON l.parte = a.parte AND l.destino = a.destino LEFT JOIN b ON l.parte = b.parte CROSS JOIN g""")
def jn12(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    mean = lambda n, *keys: l.groupBy(*keys).agg(F.avg("tallos").alias("v"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= n)
    out = joins.lookup_cascade(l, [(mean(12, "parte", "destino"), ["parte", "destino"], "v"), (mean(30, "parte"), ["parte"], "v"), (l.agg(F.avg("tallos").alias("v")), [], "v")], "v", 0.0)
    return out.select("pedido", long("grado"), "parte", r6("v"), long("v_level"))


@query("jn15_attach_mode", "WITH n AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT s_suppkey, arg_max(l_linenumber, (n, -l_linenumber))::BIGINT AS modal FROM supplier LEFT JOIN n ON s_suppkey = l_suppkey GROUP BY 1")
def jn15(spark, sf):
    ref = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    return joins.attach_mode(table(spark, sf, "supplier").select("s_suppkey"), ref, ["s_suppkey"], "l_linenumber", "modal").select("s_suppkey", long("modal"))


@query("jn16_best_offset", "WITH " + DAILY + """, a AS (SELECT DISTINCT ciclo, fecha FROM d), m AS (SELECT o, count(DISTINCT (a.ciclo, a.fecha)) AS n FROM a CROSS JOIN (SELECT unnest([-2, -1, 0, 1, 2]) AS o) JOIN (SELECT DISTINCT ciclo, fecha + 1 AS fecha FROM d) b ON a.ciclo = b.ciclo AND a.fecha + o = b.fecha GROUP BY o)
SELECT o::BIGINT AS "offset", n, o = (SELECT arg_max(o, (n, -o)) FROM m) AS best FROM m""")
def jn16(spark, sf):
    d = daily(spark, sf).select("ciclo", "fecha")
    return joins.best_offset(d, d.withColumn("fecha", F.date_add("fecha", 1)), ["ciclo"], "fecha", [-2, -1, 0, 1, 2]).select(long("offset"), "n", "best")


@query("ag1_rollup", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price, max(l_discount) AS max_disc, count(l_tax) AS n FROM lineitem GROUP BY 1, 2")
def ag1(spark, sf):
    out = aggs.rollup_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {"sum_qty": ("sum", "l_quantity"), "avg_price": ("avg", "l_extendedprice"), "max_disc": ("max", "l_discount"), "n": ("count", "l_tax")})
    return out.withColumn("avg_price", r6("avg_price"))


@query("ag2_quantile_baseline", "SELECT p_brand, round(quantile_cont(p_retailprice, 0.25), 6) AS p25, round(quantile_cont(p_retailprice, 0.5), 6) AS p50, round(quantile_cont(p_retailprice, 0.75), 6) AS p75, count(*) AS n FROM part GROUP BY 1")
def ag2(spark, sf):
    return aggs.quantile_baseline(table(spark, sf, "part"), ["p_brand"], "p_retailprice").select("p_brand", r6("p25"), r6("p50"), r6("p75"), "n")


@query("ag3_weighted_mean", "WITH " + LINES + " SELECT grado::BIGINT AS grado, destino, round(sum(peso * tallos) / sum(tallos), 6) AS peso FROM l GROUP BY 1, 2")
def ag3(spark, sf):
    return aggs.weighted_mean_or_median(lines(spark, sf), ["grado", "destino"], "peso", "tallos").select(long("grado"), "destino", r6("peso"))


BYVALUE = LINES + """, v AS (SELECT grado, tallos, sum("desc" + 0.01) AS w FROM l GROUP BY 1, 2),
c AS (SELECT *, sum(w) OVER (PARTITION BY grado ORDER BY tallos) AS cw, sum(w) OVER (PARTITION BY grado) AS total FROM v)"""


@query("ag4_weighted_median", "WITH " + BYVALUE + " SELECT grado::BIGINT AS grado, min(tallos) AS weighted_median FROM c WHERE cw >= total / 2 GROUP BY 1")
def ag4(spark, sf):
    return aggs.weighted_median(lines(spark, sf).withColumn("w", F.col("desc") + 0.01), ["grado"], "tallos", "w").select(long("grado"), "weighted_median")


@query("ag5_weighted_quantile", "WITH " + BYVALUE + """, p AS (SELECT *, lag(tallos) OVER (PARTITION BY grado ORDER BY tallos) AS px, lag(cw) OVER (PARTITION BY grado ORDER BY tallos) AS pc FROM c)
SELECT grado::BIGINT AS grado, round(arg_min(CASE WHEN px IS NULL THEN tallos ELSE px + (tallos - px) * (0.9 * total - pc) / (cw - pc) END, tallos), 4) AS q FROM p WHERE cw >= 0.9 * total GROUP BY 1""")
def ag5(spark, sf):
    q = aggs.weighted_quantile(lines(spark, sf).withColumn("w", F.col("desc") + 0.01), ["grado"], "tallos", "w", 0.9)
    return q.select(long("grado"), F.round("weighted_quantile", 4).alias("q"))


@query("ag6_quantile_of_medians", "WITH " + LINES + """, m AS (SELECT destino, ciclo, median(peso) AS m, count(*) >= 200 AS ok FROM l GROUP BY 1, 2), k AS (SELECT *, bool_or(ok) OVER (PARTITION BY destino) AS a FROM m)
SELECT destino, round(quantile_cont(m, 0.75), 6) AS value, count(*) AS n_groups FROM k WHERE ok OR NOT a GROUP BY 1""")
def ag6(spark, sf):
    return aggs.quantile_of_medians(lines(spark, sf), ["destino"], ["ciclo"], "peso", 200, 0.75).select("destino", r6("value"), "n_groups")


@query("ag9_rollup_levels", "WITH " + LINES + " SELECT destino, grado::BIGINT AS grado, sum(tallos) AS tallos, CASE WHEN grouping(grado) = 0 THEN 0 WHEN grouping(destino) = 0 THEN 1 ELSE 2 END::BIGINT AS level FROM l GROUP BY GROUPING SETS ((destino, grado), (destino), ())")
def ag9(spark, sf):
    return aggs.rollup_levels(lines(spark, sf), [["destino", "grado"], ["destino"], []], ["tallos"]).select("destino", long("grado"), "tallos", long("level"))


@query("ag10_pivot_wide", "WITH " + LINES + " SELECT ciclo, " + ", ".join(f"sum(tallos) FILTER (grado = {g}) AS g_{g}" for g in range(1, 8)) + " FROM l GROUP BY 1")
def ag10(spark, sf):
    return aggs.pivot_wide(lines(spark, sf), ["ciclo"], "grado", "tallos", list(range(1, 8)), prefix="g_")


SHARE = LINES + """, g AS (SELECT ciclo, destino, grado, sum(tallos) AS t FROM l GROUP BY 1, 2, 3), s AS (SELECT *, t / sum(t) OVER (PARTITION BY ciclo, destino) AS p FROM g)"""


def _shares(spark, sf):
    g = lines(spark, sf).groupBy("ciclo", "destino", "grado").agg(F.sum("tallos").alias("t"))
    return windows.share_within(g, ["ciclo", "destino"], "t", out="p")


@query("ag11_mix_features", "WITH " + SHARE + """, k AS (SELECT *, row_number() OVER (PARTITION BY ciclo, destino ORDER BY p DESC) AS n FROM s)
SELECT ciclo, destino, round(sum(-p * ln(p)), 6) AS entropy, round(max(p), 6) AS top1, CASE WHEN count(*) >= 3 THEN round(sum(CASE WHEN n <= 3 THEN p END), 6) END AS top3, round(sum(p * grado) / sum(p), 6) AS mean_level, round(sum(CASE WHEN grado <= 3 THEN p ELSE 0 END), 6) AS share_low FROM k GROUP BY 1, 2""")
def ag11(spark, sf):
    m = aggs.mix_features(_shares(spark, sf), ["ciclo", "destino"], "grado", "p", {"low": (1, 3)})
    return m.select("ciclo", "destino", *(r6(c) for c in ("entropy", "top1", "top3", "mean_level", "share_low")))


@query("ag12_hist_share", """WITH e AS (SELECT quantile_cont(p_retailprice, 0.01) AS lo, quantile_cont(p_retailprice, 0.99) AS hi FROM part),
b AS (SELECT p_size::BIGINT % 5 AS k, floor((p_retailprice - lo) / 100)::BIGINT AS bin, sum(p_size) AS weight FROM part, e WHERE p_retailprice BETWEEN lo AND hi GROUP BY 1, 2)
SELECT k, bin, round(weight / sum(weight) OVER (PARTITION BY k), 6) AS share FROM b""")
def ag12(spark, sf):
    p = table(spark, sf, "part").withColumn("k", F.col("p_size").cast("long") % 5)
    return aggs.hist_share(p, ["k"], "p_retailprice", "p_size", 100.0).select("k", long("bin"), r6("share"))


@query("ag13_compare_dist", "WITH " + SHARE + """, a AS (SELECT ciclo, grado, p FROM s WHERE destino = 'A'), b AS (SELECT ciclo, grado, p FROM s WHERE destino = 'N'),
j AS (SELECT coalesce(a.ciclo, b.ciclo) AS ciclo, coalesce(a.grado, b.grado) AS grado, coalesce(a.p, 0) AS p, coalesce(b.p, 0) AS q FROM a FULL JOIN b ON a.ciclo = b.ciclo AND a.grado = b.grado),
c AS (SELECT *, abs(sum(p - q) OVER (PARTITION BY ciclo ORDER BY grado)) AS gap FROM j)
SELECT ciclo, round(sum(abs(q - p)), 6) AS l1, round(sum((q - p) * grado), 6) AS mean_shift, round(sum(greatest(q - p, 0)), 6) AS mass_up, round(sum(gap), 6) AS emd FROM c GROUP BY 1""")
def ag13(spark, sf):
    s = _shares(spark, sf).withColumnRenamed("p", "share")
    out = aggs.compare_dist(s.where("destino = 'A'"), s.where("destino = 'N'"), ["ciclo"], "grado")
    return out.select("ciclo", r6("l1"), r6("mean_shift"), r6("mass_up"), r6("emd"))


@query("ag14_corr_table", """WITH x AS (SELECT p_retailprice AS y, 'p_size' AS feature, p_size::DOUBLE AS x FROM part UNION ALL SELECT p_retailprice, 'p_partkey', p_partkey::DOUBLE FROM part),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry FROM x)
SELECT feature, count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM r GROUP BY 1""")
def ag14(spark, sf):
    return aggs.corr_table(table(spark, sf, "part"), "p_retailprice", ["p_size", "p_partkey"]).select("feature", "n", r6("pearson"), r6("spearman"))


@query("ag15_decile_profile", """WITH e AS (SELECT list_distinct([""" + ", ".join(f"quantile_cont(o_totalprice, {i / 10})" for i in range(11)) + """]) AS e FROM orders),
b AS (SELECT greatest(len([v FOR v IN e IF v < o_totalprice]), 1) AS bin, o_totalprice, o_custkey FROM orders, e)
SELECT bin::BIGINT AS bin, count(*) AS n, round(avg(o_totalprice), 4) AS mean_x, round(avg(o_custkey), 4) AS mean_y FROM b GROUP BY 1""")
def ag15(spark, sf):
    return aggs.decile_profile(table(spark, sf, "orders"), "o_totalprice", "o_custkey").select(long("bin"), "n", F.round("mean_x", 4).alias("mean_x"), F.round("mean_y", 4).alias("mean_y"))


@query("ag16_winsorize", "WITH q AS (SELECT event_type, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi, count(value) AS n FROM events GROUP BY 1) SELECT event_id, round(CASE WHEN n >= 5 THEN greatest(lo, least(hi, value)) ELSE value END, 6) AS value FROM events JOIN q USING (event_type)")
def ag16(spark, sf):
    return aggs.winsorize(table(spark, sf, "events"), ["event_type"], "value", min_n=5).select("event_id", r6("value"))


@query("ag17_relative_factor", "WITH " + LINES + """, m AS (SELECT variedad, destino, median(peso) AS m, count(peso) AS n FROM l GROUP BY 1, 2), b AS (SELECT variedad, m AS base FROM m WHERE destino = 'N')
SELECT m.variedad, destino, n, round(CASE WHEN n < 200 OR destino = 'N' OR base IS NULL OR base <= 0 THEN 1 ELSE greatest(0.6, least(1.6, m / base)) END, 6) AS factor FROM m LEFT JOIN b ON m.variedad = b.variedad""")
def ag17(spark, sf):
    return aggs.relative_factor(lines(spark, sf), ["variedad"], "destino", "N", "peso", 200, (0.6, 1.6)).select("variedad", "destino", "n", r6("factor"))


@query("ag18_segment_caps", "WITH g AS (SELECT quantile_cont(p_retailprice, 0.05) AS lo, quantile_cont(p_retailprice, 0.95) AS hi FROM part), s AS (SELECT p_brand, quantile_cont(p_retailprice, 0.05) AS lo, quantile_cont(p_retailprice, 0.95) AS hi, count(*) AS n FROM part GROUP BY 1) SELECT p_brand, n, round(CASE WHEN n >= 85 THEN s.lo ELSE g.lo END, 6) AS lo, round(CASE WHEN n >= 85 THEN s.hi ELSE g.hi END, 6) AS hi FROM s, g")
def ag18(spark, sf):
    return aggs.segment_caps(table(spark, sf, "part"), ["p_brand"], "p_retailprice", (0.05, 0.95), 85).select("p_brand", "n", r6("lo"), r6("hi"))


@query("ag19_share_by", "WITH " + LINES + ", s AS (SELECT month(fecha)::BIGINT AS month, grado::BIGINT AS grado, sum(tallos) AS value FROM l GROUP BY 1, 2) SELECT month, grado, round(value / sum(value) OVER (PARTITION BY month), 6) AS share FROM s")
def ag19(spark, sf):
    l = lines(spark, sf).withColumns({"month": F.month("fecha").cast("long"), "grado": F.col("grado").cast("long")})  # noqa: E741
    return aggs.share_by(l, ["month"], "grado", "tallos").select("month", "grado", r6("share"))


@query("ag20_top_n_other", """WITH t AS (SELECT n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY sum(o_totalprice) DESC, n_name LIMIT 5)
SELECT o_orderpriority, CASE WHEN n_name IN (SELECT n_name FROM t) THEN n_name ELSE 'OTHER' END AS n_name, round(sum(o_totalprice), 2) AS o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def ag20(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("one", F.lit(1.0))
    return aggs.top_n_other(o, ["o_orderpriority"], "n_name", "o_totalprice", "one", 5).select("o_orderpriority", "n_name", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("ag21_pick_feature", """WITH s AS (SELECT 'p_size' AS feature, avg((p_size IS NOT NULL)::DOUBLE) AS coverage, var_samp(p_size) AS v FROM part UNION ALL SELECT 'p_retailprice', avg((p_retailprice IS NOT NULL)::DOUBLE), var_samp(p_retailprice) FROM part)
SELECT feature, coverage, round(v, 4) AS variance, feature = (SELECT arg_max(feature, v * coverage) FROM s) AS best FROM s""")
def ag21(spark, sf):
    return aggs.pick_feature(table(spark, sf, "part"), ["p_size", "p_retailprice"], 0.5).select("feature", "coverage", F.round("variance", 4).alias("variance"), "best")


@query("jn3_full_outer", "SELECT coalesce(a.k, b.k) AS k, na, nb FROM (SELECT c_nationkey::BIGINT AS k, count(*) AS na FROM customer WHERE c_acctbal > 5000 GROUP BY 1) a FULL JOIN (SELECT s_nationkey::BIGINT AS k, count(*) AS nb FROM supplier GROUP BY 1) b ON a.k = b.k")
def jn3(spark, sf):
    a = table(spark, sf, "customer").where("c_acctbal > 5000").groupBy(long("c_nationkey", "k")).agg(F.count(F.lit(1)).alias("na"))
    b = table(spark, sf, "supplier").groupBy(long("s_nationkey", "k")).agg(F.count(F.lit(1)).alias("nb"))
    return joins.full_outer(a, b, ["k"])


@query("jn13_bridge_join", """WITH m AS (SELECT l_suppkey AS b, l_partkey AS id, min(l_orderkey) AS o FROM lineitem GROUP BY 1, 2), g AS (SELECT DISTINCT l_partkey AS id, l_shipdate::DATE AS d FROM lineitem WHERE l_returnflag = 'A')
SELECT l_orderkey, l_linenumber::BIGINT AS line, m.o FROM lineitem JOIN m ON l_suppkey = b AND l_partkey = id WHERE (l_partkey, l_shipdate::DATE) IN (SELECT id, d FROM g)""")
def jn13(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("b"), F.col("l_partkey").alias("id"), F.to_date("l_shipdate").alias("d"), "l_orderkey", long("l_linenumber", "line"), "l_returnflag")
    return joins.bridge_join(li, li.groupBy("b", "id").agg(F.min("l_orderkey").alias("o")), li.where("l_returnflag = 'A'"), ["b", "id"], ["id", "d"]).select("l_orderkey", "line", "o")


@query("jn14_duplicate_keys", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def jn14(spark, sf):
    return grain.duplicate_keys(table(spark, sf, "orders"), ["o_custkey"])


@query("jn6_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def jn6(spark, sf):
    return joins.anti_join(table(spark, sf, "customer"), table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).select("c_custkey")
