"""Queries of the capacity plans; lines and orders stand in for shifts, stems, weather and demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import capacity
from .base import long, r6, table
from .registry import query

SHIFTS = """s AS (SELECT l_shipdate::DATE AS fecha, l_suppkey::VARCHAR AS persona, ['CBX', 'CXLTA1', 'CXLTARH', 'PSMC', 'CXLTA', 'CXLTAR', 'ZZZ'][l_linenumber] AS codigo, CASE WHEN l_returnflag = 'R' THEN 'TALLOS' ELSE 'KILOS' END AS unidad, l_tax * 100 AS horas, l_quantity AS cantidad FROM lineitem),
p AS (SELECT fecha, persona, CASE codigo WHEN 'CBX' THEN 'BLANCO' WHEN 'CXLTA1' THEN 'TINTURADO' WHEN 'CXLTARH' THEN 'ARCOIRIS' WHEN 'ZZZ' THEN NULL ELSE 'OTROS_RESERVADOS' END AS proceso, sum(horas) AS horas, sum(cantidad) AS kg FROM s WHERE unidad = 'KILOS' AND codigo <> 'ZZZ' AND horas > 0 AND cantidad > 0 GROUP BY 1, 2, 3),
q AS (SELECT proceso, quantile_cont(kg / horas, 0.01) AS lo, quantile_cont(kg / horas, 0.99) AS hi FROM p GROUP BY 1), r AS (SELECT p.*, greatest(least(kg / horas, hi), lo) AS kg_h FROM p JOIN q ON p.proceso = q.proceso)"""
HOURS = """l AS (SELECT *, l_shipdate::DATE AS fecha, CASE WHEN l_suppkey % 4 = 0 THEN 'A4' ELSE 'MAIN' END AS station, CASE WHEN l_suppkey % 10 = 0 THEN ' ' ELSE 'S' || (l_suppkey % 10) END AS area, CASE WHEN l_linestatus = 'O' THEN 'XL' ELSE 'CLO' END AS variedad FROM lineitem),
fr AS (SELECT station, variedad, CASE WHEN l_tax > 0.06 THEN 'LLUVIA' WHEN l_returnflag = 'A' THEN 'SECO' WHEN l_returnflag = 'N' THEN 'HUMEDO' ELSE 'MOJADO' END AS state, l_linenumber % 2 AS pelado, 0.4 + l_discount * 5 * (l_linenumber % 3) AS factor, l_quantity AS n FROM l WHERE NOT (l_linenumber % 2 = 1 AND l_tax > 0.06)),
f AS (SELECT station, variedad, state, pelado, least(greatest(sum(factor * n) / sum(n), 0.3), 1.2) AS factor FROM fr GROUP BY 1, 2, 3, 4),
h AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'A4' ELSE 'MAIN' END AS station, o_orderdate + to_hours(o_custkey % 24) AS ts, CASE WHEN o_orderkey % 7 > 4 THEN 'LLUVIA' WHEN o_orderpriority < '2' THEN 'SECO' WHEN o_orderpriority < '4' THEN 'HUMEDO' ELSE 'OTRO' END AS state FROM orders),
o AS (SELECT station, ts, state FROM h WHERE hour(ts) BETWEEN 6 AND 14 QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY (state <> 'LLUVIA')::INT, state) = 1),
fd AS (SELECT o.ts::DATE AS fecha, o.station, v.variedad, median(coalesce(f1.factor, f0.factor, 1.0)) AS factor_dia, count(*) AS n_horas FROM o CROSS JOIN (SELECT unnest(['XL', 'CLO']) AS variedad) v LEFT JOIN f f1 ON f1.station = o.station AND f1.variedad = v.variedad AND f1.state = o.state AND f1.pelado = 1
  LEFT JOIN f f0 ON f0.station = o.station AND f0.variedad = v.variedad AND f0.state = o.state AND f0.pelado = 0 GROUP BY 1, 2, 3),
b AS (SELECT station, variedad, median(l_quantity) * 10 AS base, count(*) AS n_base FROM l GROUP BY 1, 2), st AS (SELECT fecha, station, area, variedad, sum(l_quantity) AS tallos FROM l GROUP BY 1, 2, 3, 4),
hh AS (SELECT st.*, base, n_base, coalesce(factor_dia, 1.0) AS factor_dia, coalesce(n_horas, 0) AS n_horas, base * coalesce(factor_dia, 1.0) AS rate_eff, tallos / (base * coalesce(factor_dia, 1.0)) AS hours FROM st JOIN b ON st.station = b.station AND st.variedad = b.variedad
  LEFT JOIN fd ON st.fecha = fd.fecha AND st.station = fd.station AND st.variedad = fd.variedad)"""
POST = """dm AS (SELECT l_shipdate::DATE AS fecha_post, sum(l_extendedprice) / 1000 AS kg FROM lineitem GROUP BY 1), dw AS (SELECT *, (year(fecha_post + 2) % 100) * 100 + strftime(fecha_post + 2, '%U')::INT AS week FROM dm),
mx AS (SELECT (year(o_orderdate::DATE + 2) % 100) * 100 + strftime(o_orderdate::DATE + 2, '%U')::INT AS week, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS b, sum(o_totalprice) FILTER (o_orderstatus = 'O') AS a, sum(o_totalprice) FILTER (o_orderstatus = 'P') AS t FROM orders GROUP BY 1),
md AS (SELECT median(b) AS b, median(a) AS a, median(t) AS t FROM mx), sw AS (SELECT o_orderdate::DATE AS fecha, avg(o_totalprice) / 5000 AS stem_g FROM orders GROUP BY 1),
rt AS (SELECT median(l_quantity) FILTER (l_returnflag = 'A') * 10 AS b, median(l_quantity) FILTER (l_returnflag = 'N') * 10 AS t, median(l_quantity) FILTER (l_returnflag = 'R') * 10 AS a FROM lineitem),
w AS (SELECT fecha_post, dw.week, kg, coalesce(mx.b, md.b) AS b, coalesce(mx.a, md.a) AS a, coalesce(mx.t, md.t) AS t, coalesce(stem_g, (SELECT median(stem_g) FROM sw)) AS stem_g FROM dw LEFT JOIN mx ON dw.week = mx.week LEFT JOIN sw ON fecha_post = sw.fecha, md),
ph AS (SELECT w.*, w.b / (w.b + w.a + w.t) AS wb, w.a / (w.b + w.a + w.t) AS wa, w.t / (w.b + w.a + w.t) AS wt, kg * wb / (rt.b * stem_g / 1000) AS hb, kg * wa / (rt.a * stem_g / 1000) AS ha, kg * wt / (rt.t * stem_g / 1000) AS ht FROM w, rt)"""


def _rates(spark, sf):
    codes = F.element_at(F.array(*map(F.lit, ("CBX", "CXLTA1", "CXLTARH", "PSMC", "CXLTA", "CXLTAR", "ZZZ"))), F.col("l_linenumber"))
    shifts = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("fecha"), F.col("l_suppkey").cast("string").alias("persona"), codes.alias("codigo"), F.when(F.col("l_returnflag") == "R", "TALLOS").otherwise(" kilos").alias("unidad"), (F.col("l_tax") * 100).alias("horas"), F.col("l_quantity").alias("cantidad")
    )
    return capacity.process_rates(shifts)


def _placed(spark, sf):
    area = F.when(F.col("l_suppkey") % 10 == 0, " ").otherwise(F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")))
    return table(spark, sf, "lineitem").withColumns({"fecha": F.to_date("l_shipdate"), "station": F.when(F.col("l_suppkey") % 4 == 0, "A4").otherwise("MAIN"), "area": area, "variedad": F.when(F.col("l_linestatus") == "O", "XL").otherwise("CLO")})


def _harvest(spark, sf):
    lines = _placed(spark, sf)
    state = F.when(F.col("l_tax") > 0.06, "LLUVIA").when(F.col("l_returnflag") == "A", "SECO").when(F.col("l_returnflag") == "N", "HUMEDO").otherwise("MOJADO")
    factors = lines.where(~((F.col("l_linenumber") % 2 == 1) & (F.col("l_tax") > 0.06))).select("station", "variedad", state.alias("state"), (F.col("l_linenumber") % 2).alias("pelado"), (0.4 + F.col("l_discount") * 5 * (F.col("l_linenumber") % 3)).alias("factor"), F.col("l_quantity").alias("n"))
    hours = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "A4").otherwise("MAIN").alias("station"), (F.col("o_orderdate") + F.make_interval(hours=(F.col("o_custkey") % 24).cast("int"))).alias("ts"),
        F.when(F.col("o_orderpriority") < "2", "seco").when(F.col("o_orderpriority") < "4", "humedo").otherwise("otro").alias("state"), (F.col("o_orderkey") % 7 > 4).alias("is_rain"),
    )
    base = lines.groupBy("station", "variedad").agg((F.median("l_quantity") * 10).alias("rate"), F.count(F.lit(1)).alias("n"))
    return capacity.harvest_hours(lines.select("fecha", "station", "area", "variedad", F.col("l_quantity").alias("tallos")), capacity.daily_factor(hours, factors), base)


def _post(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    demand = lines.select(F.to_date("l_shipdate").alias("fecha_post"), F.col("l_extendedprice").alias("peso_g"))
    of = {"BLANCO": "F", "ARCOIRIS": "O", "TINTURADO": "P"}
    mix = orders.groupBy(capacity.sales_week(F.to_date("o_orderdate")).alias("week")).agg(*(F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(f) for f, s in of.items()))
    weight = orders.groupBy(F.to_date("o_orderdate").alias("fecha")).agg((F.avg("o_totalprice") / 5000).alias("stem_g"))
    process = F.when(F.col("l_returnflag") == "A", "BLANCO").when(F.col("l_returnflag") == "N", "TINTURADO").otherwise("OTROS")
    return capacity.post_harvest_hours(demand, mix, weight, lines.groupBy(process.alias("proceso")).agg((F.median("l_quantity") * 10).alias("rate")))


@query("silver_capacidad_proceso_hist", "WITH " + SHIFTS + " SELECT fecha, proceso, persona, round(horas, 4) AS horas, kg, round(kg_h, 5) AS kg_h FROM r")
def capacity_history(spark, sf):
    return _rates(spark, sf).select("fecha", "proceso", "persona", F.round("horas", 4).alias("horas"), "kg", F.round("kg_h", 5).alias("kg_h"))


@query("silver_capacidad_baseline", "WITH " + SHIFTS + " SELECT proceso, round(median(kg_h), 6) AS mediana, round(quantile_cont(kg_h, 0.25), 6) AS p25, round(quantile_cont(kg_h, 0.75), 6) AS p75, count(*) AS n FROM r GROUP BY 1")
def capacity_baseline(spark, sf):
    return capacity.process_baseline(_rates(spark, sf)).select("proceso", r6("mediana"), r6("p25"), r6("p75"), "n")


@query("pred_capacidad_cosecha_dia", "WITH " + HOURS + " SELECT fecha, station, area, variedad, tallos, base, n_base, n_horas, round(factor_dia, 6) AS factor_dia, round(rate_eff, 5) AS rate_eff, round(hours, 6) AS hours, round(hours / 9.5, 6) AS people FROM hh")
def harvest_capacity(spark, sf):
    return _harvest(spark, sf).select("fecha", "station", "area", "variedad", "tallos", "base", "n_base", long("n_horas"), r6("factor_dia"), F.round("rate_eff", 5).alias("rate_eff"), r6("hours"), r6("people"))


@query("pred_horas_poscosecha_dia", "WITH " + POST + " SELECT fecha_post, week::BIGINT AS week, round(kg, 6) AS kg, round(kg / 10, 7) AS cajas, round(wb, 6) AS wb, round(wa, 6) AS wa, round(wt, 6) AS wt, round(hb, 5) AS hb, round(ha, 5) AS ha, round(ht, 5) AS ht, round(hb + ha + ht, 4) AS hours, round((hb + ha + ht) / 8, 4) AS people FROM ph")
def post_hours(spark, sf):
    short = {"BLANCO": "b", "ARCOIRIS": "a", "TINTURADO": "t"}
    r4 = lambda c: F.round(c, 4).alias(c)
    return _post(spark, sf).select("fecha_post", long("week"), r6("kg"), F.round("cajas", 7).alias("cajas"), *(r6(f"w_{f}", f"w{s}") for f, s in short.items()), *(F.round(f"hours_{f}", 5).alias(f"h{s}") for f, s in short.items()), r4("hours"), r4("people"))


@query("pred_plan_horas_dia", "WITH " + HOURS + ", " + POST + """, g AS (SELECT fecha, station, CASE area WHEN ' ' THEN 'ALL' ELSE area END AS area, variedad, sum(l_quantity) AS tallos_grado, sum(l_quantity * (l_extendedprice / 1009)) / sum(l_quantity) AS stem_g, count(*) AS n_grados FROM l GROUP BY 1, 2, 3, 4)
SELECT hh.fecha, hh.station, g.area, hh.variedad, 'COSECHA' AS flow, tallos, tallos_grado, round(stem_g, 5) AS stem_g, n_grados, round(rate_eff, 5) AS rate_eff, NULL::DOUBLE AS kg, round(hours, 4) AS hours, round(hours / 9.5, 4) AS people FROM hh JOIN g ON hh.fecha = g.fecha AND hh.station = g.station AND CASE hh.area WHEN ' ' THEN 'ALL' ELSE hh.area END = g.area AND hh.variedad = g.variedad
UNION ALL SELECT fecha_post, 'PLANTA', 'ALL', 'ALL', 'POSCOSECHA', NULL, NULL, NULL, NULL, NULL, round(kg, 6), round(hb + ha + ht, 4), round((hb + ha + ht) / 8, 4) FROM ph""")
def plan_hours(spark, sf):
    grades = _placed(spark, sf).select("fecha", "station", "area", "variedad", F.col("l_quantity").alias("tallos"), (F.col("l_extendedprice") / 1009).alias("peso_g"))
    out = capacity.hours_plan(_harvest(spark, sf), _post(spark, sf), grades)
    return out.select("fecha", "station", "area", "variedad", "flow", "tallos", "tallos_grado", F.round("stem_g", 5).alias("stem_g"), "n_grados", F.round("rate_eff", 5).alias("rate_eff"), r6("kg"), *(F.round(c, 4).alias(c) for c in ("hours", "people")))
