"""Planning tables as compositions of the operators: weather and labour, planning curves, post-harvest.

Every function is lazy and takes and returns DataFrames; "today" is an argument, never the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggs, alloc, grain, grids, joins, windows

#: Fixed values of the domain.
STATE_FACTOR = {"SECO": 1.00, "HUMEDO": 0.88, "MOJADO": 0.80}
RAIN_FACTOR, RAIN_MM, WETNESS_CAP = 0.72, 0.3, 3.0
DEFAULT_MIX = {"BLANCO": 0.80, "ARCOIRIS": 0.10, "TINTURADO": 0.10}


def station_of(area: Column | str) -> Column:
    """Weather station of an area."""
    return F.when(C.canon_str(area).isin("A-4", "A4", "SJP", "SAN JUAN"), "A4").otherwise("MAIN")


def weather_states(hourly: DataFrame) -> DataFrame:
    """Station-hour with wetness balance and state; of repeated hours the wettest row counts.

    ``hourly``: station, fecha (timestamp), rainfall_mm, et.
    """
    one = grain.dedup(hourly.withColumn("ts", C.trunc_ts("fecha")).drop("fecha"), ["station", "ts"], [-F.coalesce("rainfall_mm", F.lit(0.0)), F.coalesce("et", F.lit(0.0))])
    rain = F.when(F.col("rainfall_mm") >= RAIN_MM, F.col("rainfall_mm")).otherwise(0.0)
    kardex = windows.clamped_balance(one.withColumn("__d", rain - F.coalesce("et", F.lit(0.0))), ["station"], "ts", "__d", 0.0, WETNESS_CAP).drop("__d")
    return kardex.withColumns({"is_rain": F.coalesce(F.col("rainfall_mm") >= RAIN_MM, F.lit(False)), "state": windows.wetness_state(F.col("balance_before"))})


def shift_hours(shifts: DataFrame, states: DataFrame) -> DataFrame:
    """Shifts split over clock hours: units in proportion to overlap times the hour's state factor.

    ``shifts``: rec, area, code, start, end, units. Ends that are not after the start become start + 1 min.
    """
    end = F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.col("start") + F.expr("INTERVAL 1 MINUTE"))
    hours = joins.overlap_hours(shifts.withColumns({"end": end, "station": station_of("area")}), "start", "end")
    known = states.select("station", F.col("ts").alias("hour"), "state", "is_rain")
    joined = hours.join(known, ["station", "hour"], "left").fillna("SECO", ["state"]).fillna(False, ["is_rain"])
    factor = F.when(F.col("is_rain"), RAIN_FACTOR).otherwise(C.map_values("state", {k: str(v) for k, v in STATE_FACTOR.items()}).cast("double"))
    return alloc.split_by_effort(joined.withColumn("effort", F.col("overlap_h") * factor), ["rec"], "units", "effort", "units_hour")


def weather_productivity(hours: DataFrame, min_n: int = 500) -> tuple[DataFrame, DataFrame]:
    """Dry baseline per station (q75 of area medians) and relative factor per state, clipped to [0.30, 1.20]."""
    rated = grain.exclude_implausible(hours.withColumn("rate", C.safe_div("units_hour", "overlap_h")), "rate", 10, 2000)
    base = aggs.quantile_of_medians(rated.where("state = 'SECO' and not is_rain"), ["station"], ["area"], "rate", min_n, 0.75)
    return base, aggs.relative_factor(rated, ["station"], "state", "SECO", "rate", 1, (0.30, 1.20))


def cycle_windows(cycles: DataFrame, dh: int = 7, post: int = 2) -> DataFrame:
    """Stage intervals VEG, HARVEST and POST of ``(ciclo_id, fecha_sp, fecha_inicio, fecha_fin)``."""
    marks = grids.milestones(cycles, ["ciclo_id"], {"SP": F.col("fecha_sp"), "START": F.col("fecha_inicio"), "END": F.col("fecha_fin"), "POST": F.date_add("fecha_inicio", dh)}, "REAL")
    return grids.stage_windows(marks, ["ciclo_id"], {"VEG": ("SP", "START", -1), "HARVEST": ("START", "END", 0), "POST": ("POST", "END", dh + post)})


def daily_offer(cycles: DataFrame) -> DataFrame:
    """The projected stems of each cycle spread over its harvest days; the last day takes the rounding.

    ``cycles``: ciclo_id, variedad, fecha_inicio, fecha_fin, tallos_proy.
    """
    days = grids.explode_dates(cycles.withColumn("n_days", C.days_between("fecha_inicio", "fecha_fin", True)), "fecha_inicio", "fecha_fin")
    spread = alloc.spread_uniform(days, "tallos_proy", "n_days", "tallos").withColumn("tallos", F.rint("tallos"))
    return windows.absorb_residual(spread, ["ciclo_id"], "day", "tallos", "tallos_proy")


def grade_chain(offer: DataFrame, shares: DataFrame, weights: DataFrame) -> DataFrame:
    """Stems by grade, green kg and boxes.

    ``shares``: variedad, grado, share; ``weights``: variedad, grado, peso_g (grade and table medians fill gaps).
    """
    even = windows.share_within(shares, ["variedad"], "share", "uniform")
    by_grade = alloc.split_by_share(offer, even, ["variedad"], "tallos", "share", "tallos_grado")
    by_level = weights.groupBy("grado").agg(F.median("peso_g").alias("peso_g"))
    whole = weights.agg(F.median("peso_g").alias("peso_g"))
    known = joins.lookup_cascade(by_grade, [(weights, ["variedad", "grado"], "peso_g"), (by_level, ["grado"], "peso_g"), (whole, [], "peso_g")], "peso_tallo_g")
    kg = known.withColumn("kg", C.grams_to_kg(F.col("tallos_grado") * F.col("peso_tallo_g")))
    return kg.withColumn("cajas", C.to_boxes("kg"))


def weekly_mix(sales: DataFrame) -> DataFrame:
    """Finish shares per business week as columns, with the row ``DEFAULT`` (normalised medians, else fixed).

    ``sales``: fecha (date), destino, cajas. The week is that of two days before.
    """
    names = list(DEFAULT_MIX)
    sums = sales.withColumn("week", C.week_key("fecha", "iso", -2).cast("string")).groupBy("week", "destino").agg(F.sum("cajas").alias("cajas"))
    wide = aggs.pivot_wide(windows.share_within(sums, ["week"], "cajas"), ["week"], "destino", "share", names).fillna(0.0, names)
    medians = wide.agg(*(F.median(n).alias(n) for n in names))
    total = sum((F.coalesce(n, F.lit(0.0)) for n in names[1:]), F.coalesce(names[0], F.lit(0.0)))
    default = medians.select(F.lit("DEFAULT").alias("week"), *(F.when(total > 0, F.coalesce(n, F.lit(0.0)) / total).otherwise(F.lit(v)).alias(n) for n, v in DEFAULT_MIX.items()))
    return wide.select("week", *names).unionByName(default)


def post_harvest_seed(kg: DataFrame, mix: DataFrame, dims: DataFrame) -> DataFrame:
    """Boxes by day, grade and finish: split by the week's mix, then hydration, waste and adjustment.

    ``kg``: day, grado, kg; ``dims``: grado, destino, dh, hidr, desp, ajuste (medians fill gaps, then
    the fixed values 7, 1.45, 0.70 and 1.0).
    """
    weekly = kg.withColumn("week", C.week_key("day", "iso", -2).cast("string"))
    split = alloc.split_wide(weekly, mix, ["week"], list(DEFAULT_MIX), "kg", {"week": "DEFAULT"}, "destino")
    out = split.withColumn("kg_verde", F.col("value")).drop("value", "weight")
    for col, default, bounds in (("dh", 7.0, (0.0, 30.0)), ("hidr", 1.45, (0.6, 3.0)), ("desp", 0.70, (0.05, 1.0)), ("ajuste", 1.0, (0.5, 2.0))):
        by_finish = dims.groupBy("destino").agg(F.median(col).alias(col))
        out = joins.lookup_cascade(out, [(dims, ["grado", "destino"], col), (by_finish, ["destino"], col)], f"{col}_x", default, bounds)
    final = alloc.factor_chain(out, "kg_verde", ["hidr_x", "desp_x"], ["ajuste_x"], "kg_post")
    return final.withColumns({"fecha_post": F.date_add("day", F.rint("dh_x").cast("int")), "cajas_post": C.to_boxes("kg_post")})


def post_harvest_views(seed: DataFrame) -> DataFrame:
    """Boxes by day, grade and finish, by day and finish, and by day, in one table with ``level`` 0 to 2."""
    return aggs.rollup_levels(seed, [["fecha_post", "destino", "grado"], ["fecha_post", "destino"], ["fecha_post"]], ["kg_verde", "kg_post", "cajas_post"])


def real_against_plan(real: DataFrame, plan: DataFrame, cycles: DataFrame) -> DataFrame:
    """Harvest records on their cycle (latest start, void after its end), cumulated against the plan.

    ``real``: bloque, fecha, tallos; ``plan``: ciclo_id, fecha, tallos_plan; ``cycles``: bloque, fecha_inicio, ciclo_id, fecha_fin.
    """
    placed = joins.asof_backward(real, cycles, ["bloque"], "fecha", "fecha_inicio", ["ciclo_id", "fecha_fin"], "fecha_fin").where("ciclo_id is not null")
    daily = placed.groupBy("ciclo_id", "fecha").agg(F.sum("tallos").alias("tallos"))
    both = joins.full_outer(daily, plan, ["ciclo_id", "fecha"]).fillna(0.0, ["tallos", "tallos_plan"])
    run = windows.progress(both, ["ciclo_id"], ["fecha"], "tallos").withColumnRenamed("cum", "real_cum").drop("pct")
    run = windows.progress(run, ["ciclo_id"], ["fecha"], "tallos_plan").withColumnRenamed("cum", "plan_cum").drop("pct")
    ratio = C.safe_div("real_cum", "plan_cum")
    state = C.classify([(ratio.isNull(), "NO_PLAN"), (ratio < 0.8, "BEHIND"), (ratio <= 1.05, "IN_RANGE")], "AHEAD")
    return run.withColumns({"ratio": ratio, "state": state})


def patch_cycles(master: DataFrame, forecast: DataFrame, asof: str) -> tuple[DataFrame, DataFrame]:
    """A new version of the cycle master with the forecast's stems where the cycle is open, and the changes."""
    open_ = F.col("fecha_fin").isNull() | (F.col("fecha_fin") > F.lit(asof).cast("date"))
    return grain.patch_column(master, forecast, ["ciclo_id"], "tallos_proy", open_ & (F.col("new_value") > 0))
