"""Queries for the model tiers, comparisons and audits on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import windows
from . import harvest, planning
from .base import LINES, lines, long, r6, table
from .q_alloc import placed
from .registry import query

CYCLES = LINES + ", cy AS (SELECT ciclo, min(fecha) AS start, (20 + ciclo % 30)::INT AS n, sum(tallos) * 1.1 AS total FROM l GROUP BY 1)"
GRID = CYCLES + ", gr AS (SELECT ciclo, start, n, total, unnest(range(1, n + 1)) AS i FROM cy)"
CURVE = GRID + """, e AS (SELECT *, exp(1.5 * ln((i - 0.5) / n) + 2.0 * ln(1 - (i - 0.5) / n)) AS e FROM gr), dy AS (SELECT ciclo, start, start + i::INT - 1 AS day, total * e / sum(e) OVER (PARTITION BY ciclo) AS tallos_day FROM e)"""
STEMS = CURVE + """, sh AS (SELECT ciclo, grado, sum(tallos) AS s, sum(count(*)) OVER (PARTITION BY ciclo) AS n FROM l GROUP BY 1, 2), ow AS (SELECT ciclo, grado, s / sum(s) OVER (PARTITION BY ciclo) AS share FROM sh WHERE n >= 600),
wh AS (SELECT grado, sum(s) / sum(sum(s)) OVER () AS share FROM sh GROUP BY 1), al AS (SELECT * FROM ow UNION ALL SELECT ciclo, grado, share FROM (SELECT ciclo FROM cy WHERE ciclo NOT IN (SELECT ciclo FROM ow)), wh),
st AS (SELECT dy.ciclo, day, grado, tallos_day * share AS tallos FROM dy JOIN al ON dy.ciclo = al.ciclo)"""


def _cycles(spark, sf):
    return lines(spark, sf).groupBy("ciclo").agg(F.min("fecha").alias("start"), (F.sum("tallos") * 1.1).alias("total")).withColumn("n", (20 + F.col("ciclo") % 30).cast("int"))


def _days(spark, sf):
    return planning.beta_curve(planning.universe_grid(_cycles(spark, sf)), 2.5, 3.0)


def _stems(spark, sf):
    shares = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("share"), F.count(F.lit(1)).alias("n"))
    return planning.stems_by_grade(_days(spark, sf), shares, 600)


@query("ml1_universe_grid", "WITH " + GRID + " SELECT ciclo, i AS day_index, start + i::INT - 1 AS day, round(i / n, 6) AS rel FROM gr")
def universe(spark, sf):
    return planning.universe_grid(_cycles(spark, sf)).select("ciclo", long("day_index"), "day", r6("rel"))


@query("ml1_tallos_day", "WITH " + CURVE + " SELECT ciclo, day, round(tallos_day, 4) AS tallos FROM dy")
def tallos_day(spark, sf):
    return _days(spark, sf).select("ciclo", "day", F.round("tallos_day", 4).alias("tallos"))


@query("ml1_tallos_grado_dia", "WITH " + STEMS + " SELECT ciclo, day, grado::BIGINT AS grado, round(tallos, 4) AS tallos FROM st")
def tallos_grade(spark, sf):
    return _stems(spark, sf).select("ciclo", "day", long("grado"), F.round("tallos", 4).alias("tallos"))


@query("ml1_kg_cajas", "WITH " + STEMS + """, w AS (SELECT grado, median(peso) / 1000 AS stem_g FROM l GROUP BY 1), k AS (SELECT st.*, tallos * coalesce(stem_g, 25) / 1000 AS kg FROM st LEFT JOIN w ON st.grado = w.grado)
SELECT ciclo, day, grado::BIGINT AS grado, round(sum(kg), 4) AS kg, round(sum(kg) / 10, 4) AS cajas, CASE WHEN grouping(grado) = 0 THEN 0 WHEN grouping(day) = 0 THEN 1 ELSE 2 END::BIGINT AS level FROM k GROUP BY GROUPING SETS ((ciclo, day, grado), (ciclo, day), (ciclo))""")
def kg_boxes(spark, sf):
    weights = lines(spark, sf).groupBy("grado").agg((F.median("peso") / 1000).alias("stem_g"))
    return planning.kg_and_boxes(_stems(spark, sf), weights).select("ciclo", "day", long("grado"), F.round("kg", 4).alias("kg"), F.round("cajas", 4).alias("cajas"), long("level"))


@query("ml1_curve_smoothed", "WITH " + LINES + """, d AS (SELECT ciclo, fecha, sum(peso) AS w FROM l GROUP BY 1, 2), c AS (SELECT ciclo, row_number() OVER q AS o, row_number() OVER q / count(*) OVER (PARTITION BY ciclo) AS rel, w / sum(w) OVER (PARTITION BY ciclo) AS share FROM d WINDOW q AS (PARTITION BY ciclo ORDER BY fecha)),
b AS (SELECT *, least(floor(rel * 10), 9) AS bin FROM c), q AS (SELECT bin, count(*) AS n, quantile_cont(share, 0.05) AS lo, quantile_cont(share, 0.95) AS hi FROM b GROUP BY 1), g AS (SELECT quantile_cont(share, 0.05) AS lo, quantile_cont(share, 0.95) AS hi FROM b),
x AS (SELECT ciclo, o, least(greatest(share, CASE WHEN n >= 20 THEN q.lo ELSE g.lo END), CASE WHEN n >= 20 THEN q.hi ELSE g.hi END) AS x FROM b JOIN q ON b.bin = q.bin, g), m AS (SELECT ciclo, o, avg(x) OVER (PARTITION BY ciclo ORDER BY o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM x)
SELECT ciclo, o AS "order", round(m / sum(m) OVER (PARTITION BY ciclo), 8) AS smooth FROM m""")
def curve_smoothed(spark, sf):
    d = windows.share_within(placed(spark, sf), ["ciclo"], "w").withColumns({"rel": F.col("i") / F.col("n")}).select("ciclo", F.col("i").alias("order"), "rel", "share")
    return planning.smoothed_curve(d).select("ciclo", long("order"), F.round("smooth", 8).alias("smooth"))


@query("ml1_field_views", "WITH " + STEMS + """, k AS (SELECT ciclo, destino, count(*) AS k FROM l GROUP BY 1, 2), a AS (SELECT ciclo, arg_max(destino, (k, -ascii(destino))) AS area FROM k GROUP BY 1), p AS (SELECT st.*, area, ((isoyear(day) % 100) * 100 + week(day))::BIGINT AS week FROM st JOIN a ON st.ciclo = a.ciclo)
SELECT day, week, area, grado::BIGINT AS grado, round(sum(tallos), 3) AS tallos, CASE WHEN grouping(grado) = 0 THEN 0 WHEN grouping(day) = 0 AND grouping(area) = 0 THEN 1 WHEN grouping(week) = 0 THEN 2 ELSE 3 END::BIGINT AS level FROM p GROUP BY GROUPING SETS ((day, area, grado), (day, area), (week, area), (day))""")
def field_views(spark, sf):
    blocks = lines(spark, sf).select("ciclo", F.col("destino").alias("area"))
    return planning.field_views(_stems(spark, sf), blocks).select("day", long("week"), "area", long("grado"), F.round("tallos", 3).alias("tallos"), long("level"))


@query("gold_real_vs_proyectado", "WITH " + CURVE + """, r AS (SELECT l.ciclo, fecha, sum(tallos) AS t FROM l JOIN cy ON l.ciclo = cy.ciclo WHERE fecha <= start + 90 GROUP BY 1, 2), f AS (SELECT coalesce(r.ciclo, dy.ciclo) AS ciclo, coalesce(fecha, day) AS fecha, coalesce(t, 0) AS t, coalesce(tallos_day, 0) AS p FROM r FULL JOIN dy ON r.ciclo = dy.ciclo AND fecha = day),
c AS (SELECT ciclo, fecha, sum(t) OVER w AS rc, sum(p) OVER w AS pc FROM f WINDOW w AS (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT ciclo::VARCHAR AS ciclo_id, fecha, round(rc, 4) AS real_cum, round(pc, 4) AS plan_cum, CASE WHEN NOT pc > 0 THEN 'NO_PLAN' WHEN rc / pc < 0.8 THEN 'BEHIND' WHEN rc / pc <= 1.05 THEN 'IN_RANGE' ELSE 'AHEAD' END AS state FROM c""")
def real_vs_plan(spark, sf):
    cycles = _cycles(spark, sf).select(F.col("ciclo").cast("string").alias("bloque"), F.col("start").alias("fecha_inicio"), F.col("ciclo").cast("string").alias("ciclo_id"), F.date_add("start", 90).alias("fecha_fin"))
    real = lines(spark, sf).select(F.col("ciclo").cast("string").alias("bloque"), "fecha", "tallos")
    plan = _days(spark, sf).select(F.col("ciclo").cast("string").alias("ciclo_id"), F.col("day").alias("fecha"), F.col("tallos_day").alias("tallos_plan"))
    out = harvest.real_against_plan(real, plan, cycles)
    return out.select("ciclo_id", "fecha", F.round("real_cum", 4).alias("real_cum"), F.round("plan_cum", 4).alias("plan_cum"), "state")


def _kpi_sql(segments: tuple[str, ...]) -> str:
    cells = ", ".join(f"('{m}', {m})" for m in ("mae", "bias", "wape", "log_mae"))
    rows = " UNION ALL ".join(
        f"SELECT '{s or 'ALL'}' AS segment, {s + '::VARCHAR' if s else chr(39) + 'ALL' + chr(39)} AS value, '{name}' AS model, sum(tallos * abs({p} - peso)) / sum(tallos) AS mae, sum(tallos * ({p} - peso)) / sum(tallos) AS bias, "
        f"sum(tallos * abs({p} - peso)) / sum(tallos * abs(peso)) AS wape, sum(tallos * abs(ln({p} / peso))) / sum(tallos) AS log_mae FROM e" + (f" GROUP BY {s}" if s else "")
        for s in ("", *segments) for name, p in (("a", "pa"), ("b", "pb"))
    )
    return "WITH " + LINES + f', e AS (SELECT *, peso * sqrt(1.01 - "desc") AS pa, peso * (1.003 + "desc" / 7) AS pb FROM l), k AS ({rows}) SELECT segment, value, model, u.metric, round(u.amount, 5) AS amount FROM k, LATERAL (VALUES {cells}) u(metric, amount)'


def _kpi(spark, sf, segments):
    e = lines(spark, sf).withColumns({"pa": F.col("peso") * F.sqrt(1.01 - F.col("desc")), "pb": F.col("peso") * (1.003 + F.col("desc") / 7)})
    return planning.kpi_table(e, "peso", "pa", "pb", "tallos", list(segments)).select("segment", "value", "model", "metric", F.round("amount", 5).alias("amount"))


@query("kpi_peso_tallo", _kpi_sql(("grado", "variedad")))
def kpi_weight(spark, sf):
    return _kpi(spark, sf, ("grado", "variedad"))


@query("kpi_poscosecha_baseline", _kpi_sql(("destino",)))
def kpi_post(spark, sf):
    return _kpi(spark, sf, ("destino",))


SPANS = LINES + """, o AS (SELECT pedido, max(destino) FILTER (grado = 1) AS destino, (count(*))::VARCHAR AS tamano, date_diff('day', min(fecha), max(fecha)) AS y, 350 + 250 * count(*) AS pa, 500 + 200 * count(*) + avg(tallos) AS pb FROM l GROUP BY 1),
m AS (SELECT o.*, model, CASE model WHEN 'a' THEN pa ELSE pb END AS p FROM o, (SELECT unnest(['a', 'b']) AS model)), s AS (SELECT 'ALL' AS segment, 'ALL' AS value, model, y, p FROM m UNION ALL SELECT 'destino', destino, model, y, p FROM m UNION ALL SELECT 'tamano', tamano, model, y, p FROM m)"""


@query("kpi_harvest_horizon", "WITH " + SPANS + " SELECT segment, value, model, count(*) AS n, round(avg(abs(p - y)), 5) AS mae, round(avg(p - y), 5) AS bias, round(avg((round_even(p, 0) = y)::INT), 6) AS exact, round(avg((abs(p - y) <= 3)::INT), 6) AS within_3, " + ", ".join(f"round(quantile_cont(abs(p - y), {q}), 5) AS p{round(100 * q)}" for q in (0.25, 0.5, 0.75, 0.95)) + " FROM s GROUP BY 1, 2, 3")
def kpi_horizon(spark, sf):
    """Days between the first and the last shipment of an order, by two models."""
    o = lines(spark, sf).groupBy("pedido").agg(F.max(F.when(F.col("grado") == 1, F.col("destino"))).alias("destino"), F.count(F.lit(1)).alias("tamano"), F.datediff(F.max("fecha"), F.min("fecha")).alias("y"), (350 + 250 * F.count(F.lit(1))).alias("pa"), (500 + 200 * F.count(F.lit(1)) + F.avg("tallos")).alias("pb"))
    out = planning.kpi_days(o, "y", "pa", "pb", ["destino", "tamano"])
    return out.select("segment", "value", "model", "n", *(F.round(c, 5).alias(c) for c in ("mae", "bias")), r6("exact"), r6("within_3"), *(F.round(c, 5).alias(c) for c in ("p25", "p50", "p75", "p95")))


GRADED = LINES + """, g AS (SELECT ciclo, grado, sum(tallos) AS t, sum(peso) AS w, count(*) AS n FROM l GROUP BY 1, 2), s AS (SELECT ciclo, grado, sum(t) OVER c AS amount, t / sum(t) OVER c AS y, w / sum(w) OVER c AS pa, n / 600.0 AS pb FROM g WINDOW c AS (PARTITION BY ciclo)),
m AS (SELECT ciclo, grado, amount, y, model, CASE model WHEN 'a' THEN pa ELSE pb END AS raw FROM s, (SELECT unnest(['a', 'b']) AS model)), z AS (SELECT *, raw / sum(raw) OVER c AS p, (abs(sum(raw) OVER c - 1) > 1e-6)::INT AS off, (grado = min(grado) OVER c)::INT AS f FROM m WINDOW c AS (PARTITION BY ciclo, model)),
u AS (SELECT 'ALL' AS segment, 'ALL' AS value, * FROM z UNION ALL SELECT 'grado', grado::VARCHAR, * FROM z)"""


@query("kpi_share_grado", "WITH " + GRADED + " SELECT segment, value, model, round(sum(amount * abs(p - y)) / sum(amount), 7) AS mae, round(sum(amount * abs(p - y)) / sum(amount * y), 6) AS wape FROM u GROUP BY 1, 2, 3")
def kpi_share(spark, sf):
    """Grade shares of a cycle by weight and by lines, against those of the stems."""
    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"), F.sum("peso").alias("w"), F.count(F.lit(1)).alias("n"))
    g = windows.share_within(windows.share_within(g, ["ciclo"], "t", out="y"), ["ciclo"], "w", out="pa").withColumns({"pb": F.col("n") / 600.0, "amount": F.sum("t").over(Window.partitionBy("ciclo"))})
    out = planning.kpi_shares(g, ["ciclo"], "y", "pa", "pb", "amount", ["grado"])
    return out.select("segment", "value", "model", F.round("mae", 7).alias("mae"), r6("wape"))


@query("kpi_share_sums", "WITH " + GRADED + " SELECT model, round(sum(off * f) / sum(f), 6) AS off_rate FROM z GROUP BY 1")
def kpi_share_sums(spark, sf):
    g = lines(spark, sf).groupBy("ciclo", "grado").agg(F.sum("tallos").alias("t"), F.sum("peso").alias("w"), F.count(F.lit(1)).alias("n"))
    g = windows.share_within(windows.share_within(g, ["ciclo"], "t", out="y"), ["ciclo"], "w", out="pa").withColumns({"pb": F.col("n") / 600.0, "amount": F.sum("t").over(Window.partitionBy("ciclo"))})
    return planning.kpi_shares(g, ["ciclo"], "y", "pa", "pb", "amount", ["grado"]).where("segment = 'ALL'").select("model", r6("off_rate"))


AUDITED = """, ck AS (SELECT 'AU1_unique' AS check_id, 'offer' AS source, (SELECT sum(n - 1) / sum(n) FROM (SELECT count(*) AS n FROM dy GROUP BY ciclo, day))::DOUBLE AS v UNION ALL SELECT 'AU1_unique', 'gold', (SELECT sum(n - 1) / sum(n) FROM (SELECT count(*) AS n FROM gd GROUP BY ciclo, day, grado))::DOUBLE
UNION ALL SELECT 'AU4_mass_balance', 'gold', (SELECT count(*) FILTER (abs(coalesce(g, 0) - coalesce(o, 0)) > greatest(1e-3, 1e-5 * abs(coalesce(o, 0)))) FROM (SELECT ciclo, sum(tallos) AS g FROM gd GROUP BY 1) a FULL JOIN (SELECT ciclo, sum(tallos_day) AS o FROM dy GROUP BY 1) b ON a.ciclo = b.ciclo)::DOUBLE
UNION ALL SELECT 'AU3_coverage', 'gold', (SELECT avg((ciclo NOT IN (SELECT ciclo FROM gd))::INT) FROM cy) UNION ALL SELECT 'AU7_dates', 'gold', (SELECT count(*) FILTER (m < start) FROM (SELECT gd.ciclo, min(day) AS m, any_value(start) AS start FROM gd JOIN cy ON gd.ciclo = cy.ciclo GROUP BY 1))::DOUBLE)
SELECT check_id, source, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status, round(v, 6) AS value FROM ck"""


@query("audit_mass_balance_oferta", "WITH " + STEMS + ", gd AS (SELECT ciclo, CASE WHEN ciclo % 11 = 0 THEN day - 2 ELSE day END AS day, grado, CASE WHEN ciclo % 13 = 0 AND grado = 2 THEN tallos * 0.9 ELSE tallos END AS tallos FROM st WHERE ciclo % 17 > 0 UNION ALL SELECT ciclo, day, grado, 0 FROM st WHERE grado = 1)" + AUDITED)
def audit_offer(spark, sf):
    """The grade table is spoilt on purpose, so that checks fail: moved days, lost stems, lost cycles, repeated rows."""
    stems = _stems(spark, sf).select("ciclo", "day", "grado", "tallos")
    spoilt = stems.where("ciclo % 17 > 0").select("ciclo", F.when(F.col("ciclo") % 11 == 0, F.date_sub("day", 2)).otherwise(F.col("day")).alias("day"), "grado", F.when((F.col("ciclo") % 13 == 0) & (F.col("grado") == 2), F.col("tallos") * 0.9).otherwise(F.col("tallos")).alias("tallos"))
    gold = spoilt.unionAll(stems.where("grado = 1").select("ciclo", "day", "grado", F.lit(0.0)))
    return planning.offer_audit(_days(spark, sf), gold, _cycles(spark, sf)).select("check_id", "source", "status", r6("value"))


@query("audit_peso_tallo_worst", "WITH " + LINES + ', e AS (SELECT pedido, grado::BIGINT AS grado, parte, abs(peso * sqrt(1.01 - "desc") - peso) AS e FROM l) SELECT pedido, grado, parte, round(e, 4) AS abs_error FROM e ORDER BY e DESC, pedido, grado, parte LIMIT 30')
def audit_worst(spark, sf):
    e = lines(spark, sf).withColumn("pa", F.col("peso") * F.sqrt(1.01 - F.col("desc")))
    return planning.worst_rows(e, "peso", "pa", ["pedido", "grado", "parte"], 30).select("pedido", long("grado"), "parte", F.round("abs_error", 4).alias("abs_error"))
