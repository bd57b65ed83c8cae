"""Cycle master, harvest progress and capacity plans on small fixtures with nulls, ties, empty tables and letters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroplan.plans import capacity, harvest, master

D = dt.date
SHEET = "bloque string, tipo_sp string, variedad string, area string, fecha_sp date, tallos double, nota string"
HISTORY = "bloque string, tipo_sp string, variedad string, area string, fecha_sp date, tallos_proy double, inicio date, fin date"


def cycles(spark, sheet, weighings=(), history=(), today=D(2024, 6, 1)):
    active = master.active_cycles(spark.createDataFrame(list(sheet), SHEET), spark.createDataFrame(list(weighings), "bloque string, fecha date"), F.lit(today))
    closed = master.closed_cycles(spark.createDataFrame(list(history), HISTORY), F.lit(D(2023, 1, 1)))
    return master.cycle_master([active, closed])


def test_master_from_sheets(spark):
    sp = D(2024, 1, 1)
    sheet = [("321A", "P", "xl", "SSJ", sp, 100.0, None), ("321A", "P", "xl", "SSJ", sp, 50.0, None), ("321B", "P", "xl", "A-4", sp, None, None), ("7", "S", "CLO", "MM1", sp, 10.0, None), ("8", "S", "CLO", None, sp, 1.0, None),
             ("9", "S", "CLO", "0", sp, 1.0, None), ("10", "S", "CLO", "MH1", D(2024, 6, 1), 1.0, None), (None, "S", "CLO", "MH1", sp, 1.0, None), ("11", "S", "CLO", "MH1", None, 1.0, None)]
    weighings = [("321A", D(2024, 1, 20)), ("321A", D(2024, 3, 1)), ("321A", D(2024, 4, 1)), ("321A", D(2024, 3, 1)), ("321A", None), ("321B", D(2024, 3, 5)), ("7", D(2024, 3, 1)), ("7", D(2024, 5, 28))]
    history = [("321", "P", "XL", "SSJ", sp, 999.0, sp, D(2024, 4, 4)), ("7", "S", "clo ", "MH1", sp, 5000.0, sp, D(2024, 4, 4)), ("50", "S", "CLO", "X", sp, 3.0, None, None), ("51", "S", "CLO", "X", D(2022, 1, 1), 3.0, sp, sp), ("52", "S", "CLO", "MM2", sp, 3.0, sp, sp)]
    got = {r.bloque: r for r in cycles(spark, sheet, weighings, history).collect()}
    assert set(got) == {"321A", "321B", "7", "52"}  # the whole block 321 yields to its parts
    a = got["321A"]
    assert (a.tallos_proy, a.area, a.variedad, a.bloque_base, a.inicio, a.fin, a.estado) == (150.0, "A-4", "XL", "321", D(2024, 3, 1), D(2024, 4, 1), "ACTIVO")
    assert (got["321B"].tallos_proy, got["321B"].inicio, got["321B"].fin) == (0.0, D(2024, 3, 5), None)  # one weighing only
    assert (got["7"].estado, got["7"].tallos_proy, got["7"].fin) == ("ACTIVO", 10.0, None)  # still weighed, and before the closed row of the same id
    assert (got["52"].estado, got["52"].area) == ("CERRADO", "MH2")
    assert cycles(spark, []).count() == 0 and master.cycle_grid(cycles(spark, [])).count() == 0


def test_master_needs_dates(spark):
    bad = spark.createDataFrame([("1", None, "S", "CLO", "MH1", 1.0, None, None, "ACTIVO")], "bloque string, fecha_sp date, tipo_sp string, variedad string, area string, tallos_proy double, inicio date, fin date, estado string")
    with pytest.raises(Exception, match="cycle without planting date"):
        master.cycle_master([bad]).collect()


def test_grid_weather_and_progress(spark):
    one = cycles(spark, [("5", "S", "CLO", "SSJ", D(2024, 1, 1), 10.0, None), ("5A", "P", "CLO", "SSJ", D(2024, 2, 1), 10.0, None)])
    grid = master.cycle_grid(one)
    assert grid.count() == 2 * 181 and grid.where("fecha = date'2024-01-01'").first()[-3:] == (2024, 1, 1)
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    hours = spark.createDataFrame([("A4", t(2, 0), 1.0, 10.1, 5.0, True), ("A4", t(2, 1), None, 12.1, 5.0, None), ("A4", t(3, 0), 0.0, 5.0, 5.0, False), ("MAIN", t(2, 0), 9.0, 30.0, 9.0, True)], "station string, ts timestamp, rainfall_mm double, temp double, solar_j double, is_rain boolean")
    weather = master.block_weather(hours, one, harvest.station_of)
    assert {(r.bloque_base, r.fecha.day): (r.rainfall_mm, r.horas_lluvia, round(r.gdc, 6)) for r in weather.collect()} == {("5", 2): (1.0, 1, 4.0), ("5", 3): (0.0, 0, 0.0)}
    thermal = {(r.dias_desde_sp): round(r.gdc_acum, 6) for r in master.thermal_state(grid, weather).where("fecha < date'2024-01-05'").collect()}
    assert thermal == {0: 0.0, 1: 4.0, 2: 4.0, 3: 4.0}
    real = spark.createDataFrame([(D(2024, 1, 1), "5", "CLO", 0.0), (D(2024, 1, 2), "5", "CLO", 30.0), (D(2024, 1, 2), "5", "CLO", 10.0), (D(2024, 1, 3), "5", "CLO", None), (D(2024, 1, 4), "5", "CLO", 60.0), (D(2020, 1, 4), "5", "CLO", 7.0), (D(2024, 1, 4), "6", "CLO", 7.0)], "fecha date, bloque_base string, variedad string, tallos double")
    got = {r.fecha.day: (r.tallos, r.acum, r.total, r.pct, r.dia_rel, r.en_ventana, round(r.gdc_acum, 6)) for r in master.harvest_progress(real, grid, weather).collect()}
    assert got == {1: (0.0, 0.0, 100.0, 0.0, -1, 0, 0.0), 2: (40.0, 40.0, 100.0, 0.4, 0, 1, 4.0), 3: (None, 40.0, 100.0, 0.4, 1, 1, 4.0), 4: (60.0, 100.0, 100.0, 1.0, 2, 1, 4.0)}
    assert {r.bloque_base: (r.n_days, r.tallos) for r in master.unmatched_harvest(real, grid).collect()} == {"5": (1, 7.0), "6": (1, 7.0)}


def test_window_audit(spark):
    rows = [("a", "1", D(2024, 1, 1), D(2024, 3, 1), D(2024, 3, 30)), ("b", "1", D(2024, 1, 1), D(2023, 12, 1), None), ("c", None, D(2024, 1, 1), D(2024, 3, 1), D(2024, 2, 1)), ("d", "1", D(2024, 1, 1), None, None)]
    df = spark.createDataFrame(rows, "ciclo_id string, bloque_base string, fecha_sp date, inicio date, fin date").withColumns({c: F.lit("x") for c in ("variedad", "tipo_sp", "area")})
    got = {r.rule: (r.status, r.value) for r in master.audit_windows(df).collect()}
    assert got["missing_bloque_base"] == ("FAIL", 0.25) and got["not_trainable"] == ("FAIL", 0.5) and got["end_before_start"] == ("FAIL", 0.5)
    assert got["start_before_planting"] == ("FAIL", pytest.approx(1 / 3)) and got["missing_area"] == ("PASS", 0.0)
    assert {r.status for r in master.audit_windows(df.limit(0)).collect()} == {"PASS"}


def test_process_rates(spark):
    rows = [(D(2024, 1, 1), "p1", "cbx", "kilos", 2.0, 10.0), (D(2024, 1, 1), "p1", "CBX", "KILOS", 2.0, 30.0), (D(2024, 1, 1), "p2", "CXLTA1", "KILOS", 1.0, 7.0), (D(2024, 1, 1), "p3", "NONE", "KILOS", 1.0, 7.0), (D(2024, 1, 1), "p3", "CBX", "TALLOS", 1.0, 7.0),
            (D(2024, 1, 1), "p3", "CBX", "KILOS", 0.0, 7.0), (D(2024, 1, 1), None, "CBX", "KILOS", 1.0, 7.0), (D(2024, 1, 2), "p1", "PSMC", "KILOS", 1.0, 3.0), (D(2024, 1, 2), "p1", "CXLTAR", "KILOS", 1.0, 5.0)]
    rates = capacity.process_rates(spark.createDataFrame(rows, "fecha date, persona string, codigo string, unidad string, horas double, cantidad double"))
    assert {(r.proceso, r.persona): (r.horas, r.kg, r.kg_h) for r in rates.collect()} == {("BLANCO", "P1"): (4.0, 40.0, 10.0), ("TINTURADO", "P2"): (1.0, 7.0, 7.0), ("OTROS_RESERVADOS", "P1"): (2.0, 8.0, 4.0)}
    assert capacity.process_baseline(rates.limit(0)).count() == 0


def test_harvest_hours(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    hours = spark.createDataFrame([("MAIN", t(5), "MOJADO", False), ("MAIN", t(6), "SECO", False), ("MAIN", t(6), "SECO", True), ("MAIN", t(7), "HUMEDO", None), ("MAIN", t(8), "RARO", False)], "station string, ts timestamp, state string, is_rain boolean")
    factors = spark.createDataFrame([("MAIN", "XL", "LLUVIA", 0, 0.5, 3), ("MAIN", "XL", "HUMEDO", 1, 0.8, 1), ("MAIN", "XL", "HUMEDO", 1, None, 3), ("MAIN", "XL", "HUMEDO", 0, 0.1, 1), ("MAIN", "CLO", "HUMEDO", 1, 9.0, 0)], "station string, variedad string, state string, pelado int, factor double, n int")
    daily = capacity.daily_factor(hours, factors)
    assert {r.variedad: (round(r.factor_dia, 6), r.n_horas) for r in daily.collect()} == {"XL": (0.95, 3), "CLO": (1.0, 3)}  # of 0.5, 0.95 and 1; of 1, 1.2 and 1
    stems = spark.createDataFrame([(D(2024, 1, 1), "MAIN", "a", "XL", 95.0), (D(2024, 1, 1), "MAIN", "a", "XL", None), (D(2024, 1, 2), "MAIN", None, "XL", 95.0)], "fecha date, station string, area string, variedad string, tallos double")
    base = spark.createDataFrame([("MAIN", "XL", 10.0, 4)], "station string, variedad string, rate double, n long")
    got = {r.fecha.day: (r.n_horas, round(r.hours, 6), round(r.people, 6)) for r in capacity.harvest_hours(stems, daily, base).collect()}
    assert got == {1: (3, 10.0, round(10 / 9.5, 6)), 2: (0, 9.5, 1.0)}
    with pytest.raises(Exception, match="stems without a base rate"):
        capacity.harvest_hours(stems, daily, base.where("variedad = 'CLO'")).collect()


def test_post_harvest_and_plan(spark):
    demand = spark.createDataFrame([(D(2024, 1, 3), 6e5), (D(2024, 1, 3), 4e5), (D(2024, 1, 3), None), (None, 1e9), (D(2024, 5, 1), 2e5)], "fecha_post date, peso_g double")
    assert [r[0] for r in spark.createDataFrame([(D(2024, 1, 3),), (D(2022, 12, 30),), (D(2024, 12, 30),)], "d date").select(capacity.sales_week("d")).collect()] == [2400, 2301, 2500]
    mix = spark.createDataFrame([(2400, 6.0, 2.0, 2.0), (2401, 1.0, 1.0, None)], "week int, BLANCO double, ARCOIRIS double, TINTURADO double")
    weight = spark.createDataFrame([(D(2024, 1, 3), 20.0), (D(2024, 1, 9), 30.0)], "fecha date, stem_g double")
    rates = spark.createDataFrame([("BLANCO", 500.0), ("OTROS", 250.0), ("TINTURADO", 100.0)], "proceso string, rate double")
    got = {r.fecha_post: r for r in capacity.post_harvest_hours(demand, mix, weight, rates).collect()}
    a = got[D(2024, 1, 3)]
    assert (a.kg, a.cajas, a.kg_BLANCO, a.stem_g) == (1000.0, 100.0, 600.0, 20.0)
    assert (a.hours_BLANCO, a.hours_ARCOIRIS, a.hours_TINTURADO) == pytest.approx((60.0, 40.0, 100.0)) and a.people == pytest.approx(25.0)
    b = got[D(2024, 5, 1)]  # neither a mix nor a weight of its own: medians 3.5, 1.5, 2 and 25 g
    assert b.w_BLANCO == pytest.approx(0.5) and b.stem_g == 25.0 and len(got) == 2
    direct = capacity.post_harvest_hours(demand, mix, weight, rates, spark.createDataFrame([("BLANCO", 60.0)], "proceso string, rate double"))
    assert direct.where("fecha_post = date'2024-01-03'").first().hours_BLANCO == pytest.approx(10.0)
    field = spark.createDataFrame([(D(2024, 1, 3), "MAIN", " ", "XL", 30.0, 10.0, 3.0, 1.0), (D(2024, 1, 3), "MAIN", None, "XL", 10.0, 2.0, 5.0, 1.0)], "fecha date, station string, area string, variedad string, tallos double, rate_eff double, hours double, people double")
    grades = spark.createDataFrame([(D(2024, 1, 3), "MAIN", "", "XL", 30.0, 20.0), (D(2024, 1, 3), "MAIN", "ALL", "XL", 10.0, 40.0)], "fecha date, station string, area string, variedad string, tallos double, peso_g double")
    plan = capacity.hours_plan(field, direct, grades)
    assert [(r.area, r.tallos, r.hours, r.rate_eff, r.stem_g, r.n_grados) for r in plan.where("flow = 'COSECHA'").collect()] == [("ALL", 40.0, 8.0, 8.0, 25.0, 2)]
    assert plan.where("flow = 'POSCOSECHA' and station = 'PLANTA'").count() == 2
