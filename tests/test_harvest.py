"""The planning tables on small domain fixtures: totals are kept from cycle to boxes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroplan.plans import harvest

D = dt.date


def total(df, col, where="true"):
    return df.where(where).agg(F.sum(col)).first()[0]


def test_weather_and_labour(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 31, h, m)
    hourly = spark.createDataFrame([("A4", t(6, 10), 2.0, 0.1), ("A4", t(6, 40), 0.1, 0.1), ("A4", t(7), 5.0, 0.0), ("A4", t(8), 0.0, 0.5), ("A4", t(9), None, None)], "station string, fecha timestamp, rainfall_mm double, et double")
    states = harvest.weather_states(hourly)
    got = {r.ts.hour: (round(r.balance_before, 6), round(r.balance, 6), r.state, r.is_rain) for r in states.collect()}
    assert got == {6: (0.0, 1.9, "SECO", True), 7: (1.9, 3.0, "HUMEDO", True), 8: (3.0, 2.5, "MOJADO", False), 9: (2.5, 2.5, "MOJADO", False)}
    shifts = spark.createDataFrame([(1, "SJP", "c", t(6, 30), t(9), 500.0), (2, "MH1", "c", t(6), t(6), 3.0)], "rec int, area string, code string, start timestamp, end timestamp, units double")
    hours = harvest.shift_hours(shifts, states)
    assert {r.rec: r.u for r in hours.groupBy("rec").agg(F.sum("units_hour").alias("u")).collect()} == pytest.approx({1: 500.0, 2: 3.0})
    base, factor = harvest.weather_productivity(hours, 1)
    assert {r.factor for r in factor.where("state = 'SECO'").collect()} <= {1.0} and base.count() <= 2


def test_from_cycle_to_boxes(spark):
    cycles = spark.createDataFrame([("c1", "XL", D(2024, 3, 1), D(2024, 3, 7), 1000.0), ("c2", "CLO", D(2024, 3, 4), D(2024, 3, 6), 100.0), ("c3", "CLO", D(2024, 3, 4), None, 50.0)], "ciclo_id string, variedad string, fecha_inicio date, fecha_fin date, tallos_proy double")
    offer = harvest.daily_offer(cycles)
    assert total(offer, "tallos") == 1100.0 and offer.count() == 10
    shares = spark.createDataFrame([("XL", 25, 0.5), ("XL", 40, 1.5), ("CLO", 25, 0.0), ("CLO", 40, 0.0)], "variedad string, grado int, share double")
    weights = spark.createDataFrame([("XL", 25, 20.0), ("XL", 40, 30.0)], "variedad string, grado int, peso_g double")
    chain = harvest.grade_chain(offer, shares, weights)
    assert total(chain, "tallos_grado") == pytest.approx(1100.0)
    assert total(chain, "kg") == pytest.approx((250 * 20 + 750 * 30 + 50 * 20 + 50 * 30) / 1000) and total(chain, "cajas") == pytest.approx(total(chain, "kg") / 10)
    sales = spark.createDataFrame([(D(2024, 3, 6), "BLANCO", 3.0), (D(2024, 3, 6), "TINTURADO", 1.0)], "fecha date, destino string, cajas double")
    mix = harvest.weekly_mix(sales)
    assert {r.week for r in mix.collect()} == {"2410", "DEFAULT"}
    dims = spark.createDataFrame([(25, "BLANCO", 5.0, 1.2, 0.9, 1.0)], "grado int, destino string, dh double, hidr double, desp double, ajuste double")
    seed = harvest.post_harvest_seed(chain.select("day", "grado", "kg"), mix, dims)
    assert total(seed, "kg_verde") == pytest.approx(total(chain, "kg"))
    views = harvest.post_harvest_views(seed)
    assert len({round(total(views, "cajas_post", f"level = {i}"), 6) for i in range(3)}) == 1


def test_real_against_plan_and_patch(spark):
    cycles = spark.createDataFrame([("b", D(2024, 1, 1), "c1", D(2024, 1, 5)), ("b", D(2024, 2, 1), "c2", None)], "bloque string, fecha_inicio date, ciclo_id string, fecha_fin date")
    real = spark.createDataFrame([("b", D(2024, 1, 1), 5.0), ("b", D(2024, 1, 5), 5.0), ("b", D(2024, 1, 9), 7.0), ("b", D(2024, 2, 2), 1.0)], "bloque string, fecha date, tallos double")
    plan = spark.createDataFrame([("c1", D(2024, 1, 1), 10.0), ("c1", D(2024, 1, 5), 0.0)], "ciclo_id string, fecha date, tallos_plan double")
    got = {(r.ciclo_id, r.fecha.day): r.state for r in harvest.real_against_plan(real, plan, cycles).collect()}
    assert got == {("c1", 1): "BEHIND", ("c1", 5): "IN_RANGE", ("c2", 2): "NO_PLAN"}
    master = cycles.withColumn("tallos_proy", F.lit(1.0))
    new, changes = harvest.patch_cycles(master, spark.createDataFrame([("c1", 9.0), ("c2", 8.0)], "ciclo_id string, tallos_proy double"), "2024-01-20")
    assert {r.ciclo_id: r.tallos_proy for r in new.collect()} == {"c1": 1.0, "c2": 8.0} and changes.count() == 1
    stages = {(r.ciclo_id, r.stage): (r.start, r.end) for r in harvest.cycle_windows(cycles.withColumn("fecha_sp", F.date_sub("fecha_inicio", 90))).collect()}
    assert stages[("c1", "HARVEST")] == (D(2024, 1, 1), D(2024, 1, 5)) and stages[("c2", "HARVEST")] == (D(2024, 2, 1), None) and stages[("c1", "POST")] == (D(2024, 1, 8), D(2024, 1, 14))
