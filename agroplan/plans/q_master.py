"""Queries of the cycle master, block weather and harvest progress; orders and lines stand in for the sheets and weighings."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import harvest, master
from .base import long, r6, table
from .registry import query

TODAY, SINCE = "2001-07-25", "1999-06-01"

SHEETS = """sheet AS (SELECT (o_custkey % 100)::VARCHAR || CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE '' END AS bloque, o_orderstatus AS tipo_sp, CASE WHEN o_orderpriority < '3' THEN 'XL' ELSE 'CLO' END AS variedad,
  CASE o_custkey % 5 WHEN 0 THEN 'SSJ' WHEN 1 THEN 'MM1' WHEN 2 THEN 'mh2 ' WHEN 3 THEN '0' ELSE 'SJP' END AS area, o_orderdate::DATE - ((o_custkey % 100) % 9)::INT * 100 AS fecha_sp, o_totalprice AS tallos FROM orders),
wg AS (SELECT DISTINCT (l_suppkey % 100)::VARCHAR || CASE WHEN l_linenumber % 3 = 0 THEN 'A' ELSE '' END AS bloque, l_shipdate::DATE - ((l_suppkey % 100) % 7)::INT * 60 AS f FROM lineitem),
hs AS (SELECT bloque, tipo_sp, variedad, area, max(fecha_sp) AS fecha_sp, avg(tallos) AS tallos_proy, count(*)::INT AS n FROM sheet GROUP BY ALL)"""
MASTER = SHEETS + f""", ta AS (SELECT bloque, tipo_sp, variedad, area, max(fecha_sp) AS fecha_sp, sum(tallos) AS tallos_proy FROM sheet WHERE area <> '0' GROUP BY ALL),
ac AS (SELECT ta.bloque, tipo_sp, variedad, area, fecha_sp, tallos_proy, min(f) AS inicio, max(f) AS fin FROM ta LEFT JOIN wg ON ta.bloque = wg.bloque AND f - fecha_sp > 30 WHERE fecha_sp < DATE '{TODAY}' GROUP BY ALL),
cy AS (SELECT bloque, tipo_sp, variedad, area, fecha_sp, tallos_proy, inicio, CASE WHEN fin > inicio AND fin < DATE '{TODAY}' - 4 THEN fin END AS fin, 'ACTIVO' AS estado FROM ac
  UNION ALL SELECT regexp_replace(bloque, '[^0-9]', '', 'g'), tipo_sp, variedad, area, fecha_sp, tallos_proy, fecha_sp + 70, fecha_sp + 70 + n % 40, 'CERRADO' FROM hs WHERE n % 4 > 0 AND fecha_sp >= DATE '{SINCE}'),
cn AS (SELECT * REPLACE (trim(upper(CASE area WHEN 'SSJ' THEN 'A-4' WHEN 'MM1' THEN 'MH1' WHEN 'MM2' THEN 'MH2' ELSE area END)) AS area), regexp_replace(bloque, '[^0-9]', '', 'g') AS bloque_base FROM cy),
pf AS (SELECT *, bool_or(bloque <> bloque_base) OVER (PARTITION BY bloque_base, tipo_sp, fecha_sp, variedad, area) AS lettered FROM cn),
id AS (SELECT * EXCLUDE (lettered), sha1(bloque || '|' || variedad || '|' || tipo_sp || '|' || strftime(fecha_sp, '%Y-%m-%d')) AS ciclo_id FROM pf WHERE NOT lettered OR bloque <> bloque_base),
cm AS (SELECT * FROM id QUALIFY row_number() OVER (PARTITION BY ciclo_id ORDER BY estado, tallos_proy DESC, area, inicio NULLS FIRST, fin NULLS FIRST) = 1)"""
GRID = MASTER + ", gr AS (SELECT ciclo_id, bloque_base, fecha_sp, fecha_sp + unnest(range(0, 181))::INT AS fecha FROM cm)"
WEATHER = """, hw AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'A4' ELSE 'MAIN' END AS station, o_orderdate::DATE AS fecha, (o_orderkey % 7)::DOUBLE AS rain, o_totalprice / 25013 AS temp, o_totalprice AS solar, o_orderkey % 7 > 4 AS wet FROM orders),
da AS (SELECT station, fecha, sum(rain) AS rainfall_mm, count(*) FILTER (wet) AS horas_lluvia, avg(temp) AS temp, sum(solar) AS solar_j FROM hw GROUP BY 1, 2),
bm AS (SELECT bloque_base, area, CASE WHEN area IN ('A-4', 'A4', 'SJP', 'SAN JUAN') THEN 'A4' ELSE 'MAIN' END AS station FROM (SELECT bloque_base, area, row_number() OVER (PARTITION BY bloque_base ORDER BY count(*) DESC, area) AS r FROM cm GROUP BY 1, 2) WHERE r = 1),
cl AS (SELECT bloque_base, area, bm.station, fecha, rainfall_mm, horas_lluvia, temp, solar_j, greatest(temp - 7.1, 0) AS gdc FROM bm JOIN da ON bm.station = da.station)"""
REAL = """, rl AS (SELECT l_shipdate::DATE - ((l_suppkey % 100) % 7)::INT * 60 AS fecha, (l_suppkey % 100)::VARCHAR AS bloque_base, CASE WHEN l_linestatus = 'O' THEN 'XL' ELSE 'CLO' END AS variedad, sum(l_quantity) AS tallos FROM lineitem GROUP BY 1, 2, 3)"""


def _shifted(day, number, step, modulus):
    return F.date_sub(F.to_date(day), ((F.col(number) % 100) % modulus).cast("int") * step)


def _lettered(number, letter):
    return F.concat((F.col(number) % 100).cast("string"), F.when(F.col(letter) % 3 == 0, "A").otherwise(""))


def _sheet(spark, sf):
    area = F.element_at(F.array(*map(F.lit, ("SSJ", "MM1", "mh2 ", "0", "SJP"))), (F.col("o_custkey") % 5 + 1).cast("int"))
    return table(spark, sf, "orders").select(
        _lettered("o_custkey", "o_orderkey").alias("bloque"), F.col("o_orderstatus").alias("tipo_sp"), F.when(F.col("o_orderpriority") < "3", "XL").otherwise("CLO").alias("variedad"), area.alias("area"),
        _shifted("o_orderdate", "o_custkey", 100, 9).alias("fecha_sp"), F.col("o_totalprice").alias("tallos"),
    )


def _master(spark, sf):
    sheet = _sheet(spark, sf)
    weighings = table(spark, sf, "lineitem").select(_lettered("l_suppkey", "l_linenumber").alias("bloque"), _shifted("l_shipdate", "l_suppkey", 60, 7).alias("fecha"))
    history = sheet.groupBy("bloque", "tipo_sp", "variedad", "area").agg(F.max("fecha_sp").alias("fecha_sp"), F.avg("tallos").alias("tallos_proy"), F.count(F.lit(1)).cast("int").alias("n"))
    start = F.date_add("fecha_sp", 70)
    whole = history.withColumns({"bloque": F.regexp_replace("bloque", "[^0-9]", ""), "inicio": start, "fin": F.when(F.col("n") % 4 > 0, F.date_add(start, F.col("n") % 40))})
    return master.cycle_master([master.active_cycles(sheet, weighings, F.lit(TODAY).cast("date")), master.closed_cycles(whole, F.lit(SINCE).cast("date"))])


def _weather(spark, sf):
    hours = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "A4").otherwise("MAIN").alias("station"), (F.col("o_orderdate") + F.make_interval(hours=(F.col("o_custkey") % 24).cast("int"))).alias("ts"),
        (F.col("o_orderkey") % 7).cast("double").alias("rainfall_mm"), (F.col("o_totalprice") / 25013).alias("temp"), F.col("o_totalprice").alias("solar_j"), (F.col("o_orderkey") % 7 > 4).alias("is_rain"),
    )
    return master.block_weather(hours, _master(spark, sf), harvest.station_of)


def _real(spark, sf):
    return table(spark, sf, "lineitem").select(
        _shifted("l_shipdate", "l_suppkey", 60, 7).alias("fecha"), (F.col("l_suppkey") % 100).cast("string").alias("bloque_base"), F.when(F.col("l_linestatus") == "O", "XL").otherwise("CLO").alias("variedad"), F.col("l_quantity").alias("tallos")
    )


@query("silver_ciclo_maestro", "WITH " + MASTER + " SELECT ciclo_id, bloque, bloque_base, variedad, tipo_sp, area, fecha_sp, inicio, fin, estado, round(tallos_proy, 3) AS tallos_proy FROM cm")
def ciclo_maestro(spark, sf):
    return _master(spark, sf).select("ciclo_id", "bloque", "bloque_base", "variedad", "tipo_sp", "area", "fecha_sp", "inicio", "fin", "estado", F.round("tallos_proy", 3).alias("tallos_proy"))


@query("silver_grid_ciclo_fecha", "WITH " + GRID + " SELECT ciclo_id, fecha, isoyear(fecha) AS anio, week(fecha) AS semana_iso, month(fecha) AS mes FROM gr")
def grid_ciclo_fecha(spark, sf):
    return master.cycle_grid(_master(spark, sf)).select("ciclo_id", "fecha", long("anio"), long("semana_iso"), long("mes"))


@query("silver_clima_bloque_dia", "WITH " + MASTER + WEATHER + " SELECT bloque_base, area, station, fecha, rainfall_mm, horas_lluvia, round(temp, 6) AS temp, round(solar_j, 2) AS solar_j, round(gdc, 6) AS gdc FROM cl")
def clima_bloque_dia(spark, sf):
    return _weather(spark, sf).select("bloque_base", "area", "station", "fecha", "rainfall_mm", "horas_lluvia", r6("temp"), F.round("solar_j", 2).alias("solar_j"), r6("gdc"))


@query("silver_estado_termico", "WITH " + GRID + WEATHER + """ SELECT ciclo_id, gr.fecha, gr.fecha - fecha_sp AS dias_desde_sp, round(coalesce(gdc, 0), 5) AS gdc, round(sum(coalesce(gdc, 0)) OVER (PARTITION BY ciclo_id ORDER BY gr.fecha), 4) AS gdc_acum
FROM gr LEFT JOIN cl ON gr.bloque_base = cl.bloque_base AND gr.fecha = cl.fecha""")
def estado_termico(spark, sf):
    out = master.thermal_state(master.cycle_grid(_master(spark, sf)), _weather(spark, sf))
    return out.select("ciclo_id", "fecha", long("dias_desde_sp"), F.round("gdc", 5).alias("gdc"), F.round("gdc_acum", 4).alias("gdc_acum"))


@query("silver_cosecha_progress", "WITH " + GRID + WEATHER + REAL + """, j AS (SELECT ciclo_id, rl.*, coalesce(gdc, 0) AS gdc FROM rl JOIN gr ON rl.fecha = gr.fecha AND rl.bloque_base = gr.bloque_base LEFT JOIN cl ON rl.fecha = cl.fecha AND rl.bloque_base = cl.bloque_base),
k AS (SELECT *, min(fecha) OVER w AS inicio_real, max(fecha) OVER w AS fin_real, sum(tallos) OVER w AS total, sum(tallos) OVER (w ORDER BY fecha) AS acum, sum(gdc) OVER (w ORDER BY fecha) AS gdc_acum FROM j WINDOW w AS (PARTITION BY ciclo_id, bloque_base, variedad))
SELECT ciclo_id, bloque_base, variedad, fecha, inicio_real, fin_real, tallos, acum, total, acum / total AS pct, fecha - inicio_real AS dia_rel, 1::BIGINT AS en_ventana, round(gdc_acum, 4) AS gdc_acum FROM k""")
def cosecha_progress(spark, sf):
    """All lines carry stems, so that each listed day lies in the harvest (``tests/test_master.py`` has days without)."""
    out = master.harvest_progress(_real(spark, sf), master.cycle_grid(_master(spark, sf)), _weather(spark, sf))
    return out.select("ciclo_id", "bloque_base", "variedad", "fecha", "inicio_real", "fin_real", "tallos", "acum", "total", "pct", long("dia_rel"), long("en_ventana"), F.round("gdc_acum", 4).alias("gdc_acum"))


@query("audit_match_real_maestro", "WITH " + GRID + REAL + ", d AS (SELECT fecha, bloque_base, sum(tallos) AS tallos FROM rl GROUP BY 1, 2) SELECT bloque_base, count(*) AS n_days, sum(tallos) AS tallos FROM d WHERE NOT EXISTS (SELECT 1 FROM gr WHERE gr.fecha = d.fecha AND gr.bloque_base = d.bloque_base) GROUP BY 1")
def audit_match(spark, sf):
    return master.unmatched_harvest(_real(spark, sf), master.cycle_grid(_master(spark, sf)))


@query("audit_harvest_windows", "WITH " + MASTER + """, s AS (SELECT *, inicio - fecha_sp AS d, fin - inicio + 1 AS n FROM cm), v AS (SELECT unnest([{'rule': 'missing_bloque_base', 'v': avg((bloque_base IS NULL)::INT)}, {'rule': 'missing_variedad', 'v': avg((variedad IS NULL)::INT)}, {'rule': 'missing_tipo_sp', 'v': avg((tipo_sp IS NULL)::INT)},
{'rule': 'missing_area', 'v': avg((area IS NULL)::INT)}, {'rule': 'missing_fecha_sp', 'v': avg((fecha_sp IS NULL)::INT)}, {'rule': 'missing_inicio', 'v': avg((inicio IS NULL)::INT)}, {'rule': 'missing_fin', 'v': avg((fin IS NULL)::INT)}, {'rule': 'start_before_planting', 'v': avg((d < 0)::INT)},
{'rule': 'start_after_a_year', 'v': avg((d > 365)::INT)}, {'rule': 'end_before_start', 'v': avg((n <= 0)::INT)}, {'rule': 'longer_than_120', 'v': avg((n > 120)::INT)}, {'rule': 'not_trainable', 'v': avg((inicio IS NULL OR fin IS NULL OR fecha_sp IS NULL)::INT)}]) AS x FROM s)
SELECT x.rule AS rule, CASE WHEN x.v > 0 THEN 'FAIL' ELSE 'PASS' END AS status, round(x.v, 6) AS value FROM v""")
def audit_windows(spark, sf):
    return master.audit_windows(_master(spark, sf)).select("rule", "status", r6("value"))


@query("audit_harvest_windows_segments", "WITH " + MASTER + """ SELECT area, variedad, tipo_sp, quantile_cont(inicio - fecha_sp, 0.25) AS start_p25, quantile_cont(inicio - fecha_sp, 0.5) AS start_p50, quantile_cont(inicio - fecha_sp, 0.75) AS start_p75, count(inicio - fecha_sp) AS n_start,
quantile_cont(fin - inicio + 1, 0.25) AS days_p25, quantile_cont(fin - inicio + 1, 0.5) AS days_p50, quantile_cont(fin - inicio + 1, 0.75) AS days_p75, count(fin - inicio) AS n_days FROM cm GROUP BY 1, 2, 3""")
def audit_segments(spark, sf):
    return master.window_segments(_master(spark, sf), ["area", "variedad", "tipo_sp"])
