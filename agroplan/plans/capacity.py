"""Capacity plans: rates of people by process, hours of harvest and post-harvest, and the plan of both flows.

"People" are hours over the length of a shift, not rounded: rows are added up later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggs, alloc, grain, joins
from ..operators.order import quantiles

#: Fixed values of the domain.
PROCESS_OF_CODE = {"CBX": "BLANCO", "CXLTA1": "TINTURADO", "CXLTARH": "ARCOIRIS", "PSMC": "OTROS_RESERVADOS", "CXLTA": "OTROS_RESERVADOS", "CXLTAR": "OTROS_RESERVADOS"}
FINISHES = ["BLANCO", "ARCOIRIS", "TINTURADO"]
VARIETIES = ["XL", "CLO"]
HARVEST_SHIFT, POST_SHIFT, FIRST_HOUR, LAST_HOUR = 9.5, 8.0, 6, 14
FACTOR_BOUNDS = (0.30, 1.20)


def sales_week(day: Column | str) -> Column:
    """YYWW of two days later, in weeks that start on Sunday (0 before the first one)."""
    d = F.date_add(day, 2)
    return ((F.year(d) % 100) * 100 + F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7)).cast("int")


def process_rates(shifts: DataFrame, units: str = "KILOS") -> DataFrame:
    """Kilograms an hour by day, process and person, held to the 1 and 99 % quantiles of the process.

    ``shifts``: fecha, persona, codigo, unidad, horas, cantidad; only known codes, the given unit and
    positive hours and amounts count. A process may hold a third of all rows: its quantiles are found by
    ranges of values, not in one task.
    """
    coded = shifts.withColumns({"proceso": C.map_values(C.canon_str("codigo"), PROCESS_OF_CODE, False), "persona": C.canon_str("persona")})
    known = grain.filter_valid(coded.where(C.canon_str("unidad") == units), ["fecha", "persona", "proceso"], ["horas", "cantidad"])
    daily = known.groupBy("fecha", "proceso", "persona").agg(F.sum("horas").alias("horas"), F.sum("cantidad").alias("kg")).withColumn("__rate", F.col("kg") / F.col("horas"))
    bounds = quantiles(daily, ["proceso"], "__rate", (0.01, 0.99)).select("proceso", F.col("q").alias("__q"))
    return joins.enrich(daily, bounds, ["proceso"]).withColumn("kg_h", C.clip("__rate", F.col("__q")[0], F.col("__q")[1])).drop("__rate", "__q")


def process_baseline(rates: DataFrame, rate: str = "kg_h") -> DataFrame:
    """Median, quartiles and rows of each process, by ranges of values."""
    q = quantiles(rates, ["proceso"], rate, (0.5, 0.25, 0.75))
    return q.select("proceso", F.col("q")[0].alias("mediana"), F.col("q")[1].alias("p25"), F.col("q")[2].alias("p75"), "n")


def one_factor(factors: DataFrame) -> DataFrame:
    """Wide factors by station, variety and state: ``p1`` with and ``p0`` without peeling.

    ``factors``: station, variedad, state, pelado (0 or 1), factor, n. Repeated rows become their mean
    weighted by n (a missing factor counts as 1), without weights their median; held to 0.30 .. 1.20.
    """
    def side(flag: int) -> Column:
        here = F.col("pelado") == flag
        w = F.when(here, F.coalesce("n", F.lit(0)))
        mean = F.sum(w * F.coalesce("factor", F.lit(1.0))) / F.sum(w)
        value = F.when(F.sum(w) > 0, mean).otherwise(F.median(F.when(here, F.col("factor"))))
        return F.when(F.count_if(here) > 0, C.clip(F.coalesce(value, F.lit(1.0)), *FACTOR_BOUNDS))

    return factors.groupBy("station", "variedad", "state").agg(side(1).alias("p1"), side(0).alias("p0"))


def daily_factor(hours: DataFrame, factors: DataFrame) -> DataFrame:
    """Median factor of the shift's hours by day, station and variety, and how many hours there were.

    ``hours``: station, ts, state, is_rain; of repeated hours the first state in order counts, rain before
    the others. Without a factor for peeled stems that for others is used, then 1.
    """
    final = F.when(F.coalesce("is_rain", F.lit(False)), "LLUVIA").otherwise(C.canon_str("state"))
    shift = hours.where(F.hour("ts").between(FIRST_HOUR, LAST_HOUR)).select("station", F.date_trunc("hour", "ts").alias("ts"), final.alias("state"))
    one = grain.dedup(shift, ["station", "ts"], [F.when(F.col("state") == "LLUVIA", 0).otherwise(1), F.col("state")])
    each = one.withColumn("variedad", F.explode(F.array(*map(F.lit, VARIETIES))))
    known = joins.enrich(each, one_factor(factors), ["station", "variedad", "state"]).withColumn("factor", F.coalesce("p1", "p0", F.lit(1.0)))
    return known.groupBy(F.to_date("ts").alias("fecha"), "station", "variedad").agg(F.median("factor").alias("factor_dia"), F.count(F.lit(1)).alias("n_horas"))


def harvest_hours(stems: DataFrame, factor: DataFrame, base: DataFrame, shift_h: float = HARVEST_SHIFT) -> DataFrame:
    """Hours and people that a day's stems need by station, area and variety.

    ``stems``: fecha, station, area, variedad, tallos (added up); ``factor``: from :func:`daily_factor`,
    1 where it lacks a day; ``base``: station, variedad, rate, n (unique). Raises on stems without a base rate.
    """
    sums = stems.groupBy("fecha", "station", "area", "variedad").agg(F.sum(F.coalesce("tallos", F.lit(0.0))).alias("tallos"))
    known = joins.enrich(sums, factor, ["fecha", "station", "variedad"]).fillna({"factor_dia": 1.0, "n_horas": 0})
    rated = joins.enrich(known, grain.assert_unique(base, ["station", "variedad"]).select("station", "variedad", F.col("rate").alias("base"), F.col("n").alias("n_base")), ["station", "variedad"])
    sure = rated.withColumn("base", F.coalesce("base", F.raise_error(F.lit("stems without a base rate")).cast("double"))).withColumn("rate_eff", F.col("base") * F.col("factor_dia"))
    return alloc.required_hours(sure, "tallos", "rate_eff", shift_h).withColumn("people", F.col("hours") / shift_h)


def post_harvest_hours(demand: DataFrame, mix: DataFrame, stem_weight: DataFrame, stems_h: DataFrame, kg_h_white: DataFrame | None = None, shift_h: float = POST_SHIFT) -> DataFrame:
    """Kilograms, boxes, hours and people of each post-harvest day by finish.

    ``demand``: fecha_post, peso_g; ``mix``: week (see :func:`sales_week`) and a weight for each finish,
    whose medians stand in for missing weeks; ``stem_weight``: fecha, stem_g (unique; median for other
    days); ``stems_h``: proceso, rate in stems an hour, where OTROS, then the median, stands in;
    ``kg_h_white``: proceso, rate in kg an hour, which counts before stems times weight for BLANCO.
    """
    day = demand.where("fecha_post is not null").groupBy("fecha_post").agg((F.sum(F.coalesce("peso_g", F.lit(0.0))) / 1000).alias("kg"))
    medians = mix.agg(*(F.median(f).alias(f"__m_{f}") for f in FINISHES)).crossJoin(stem_weight.agg(F.median("stem_g").alias("__m_g")))
    rates = stems_h.agg(
        F.max(F.when(F.col("proceso") == "OTROS", F.col("rate"))).alias("__others"), F.median("rate").alias("__median"), *(F.max(F.when(F.col("proceso") == f, F.col("rate"))).alias(f"__s_{f}") for f in FINISHES)
    )
    white = kg_h_white.where("proceso = 'BLANCO'").agg(F.max("rate").alias("__white")) if kg_h_white is not None else rates.select(F.lit(None).cast("double").alias("__white"))
    single = F.broadcast(medians.crossJoin(rates).crossJoin(white))  # one row
    weekly = joins.enrich(day.withColumn("week", sales_week("fecha_post")), mix.select("week", *FINISHES), ["week"])
    weighed = joins.enrich(weekly, grain.assert_unique(stem_weight, ["fecha"]).select(F.col("fecha").alias("fecha_post"), "stem_g"), ["fecha_post"]).crossJoin(single)
    weights = {f: F.coalesce(F.col(f), F.col(f"__m_{f}")) for f in FINISHES}
    total = reduce(lambda a, b: a + b, weights.values())
    known = weighed.withColumn("stem_g", F.coalesce("stem_g", "__m_g")).withColumns({f"w_{f}": C.safe_div(w, total) for f, w in weights.items()})
    out = known.withColumns({f"kg_{f}": F.col("kg") * F.col(f"w_{f}") for f in FINISHES})
    from_stems = {f: F.coalesce(f"__s_{f}", "__others", "__median") * F.col("stem_g") / 1000 for f in FINISHES}
    kg_h = from_stems | {"BLANCO": F.coalesce(F.col("__white"), from_stems["BLANCO"])}
    out = out.withColumns({f"hours_{f}": C.safe_div(F.col(f"kg_{f}"), kg_h[f]) for f in FINISHES} | {"cajas": C.to_boxes("kg")})
    hours = reduce(lambda a, b: a + b, (F.col(f"hours_{f}") for f in FINISHES))
    return out.withColumns({"hours": hours, "people": hours / shift_h}).select("fecha_post", "week", "kg", "cajas", "stem_g", *(f"{p}_{f}" for p in ("w", "kg", "hours") for f in FINISHES), "hours", "people")


def hours_plan(harvest: DataFrame, post: DataFrame, grades: DataFrame) -> DataFrame:
    """Both flows in one table by day, station, area, variety and ``flow``; blank areas and varieties are ALL.

    ``harvest``: from :func:`harvest_hours`, repeated keys are added up and their rates weighted by stems;
    ``post``: from :func:`post_harvest_hours`, as station PLANTA; ``grades``: fecha, station, area,
    variedad, tallos, peso_g of predicted grades, for the mean stem weight beside the harvest.
    """
    keys = ["fecha", "station", "area", "variedad"]
    named = lambda df: df.withColumns({"area": C.canon_str("area", "ALL"), "variedad": C.canon_str("variedad", "ALL")})
    field = named(harvest.where("fecha is not null")).groupBy(*keys).agg(F.sum("tallos").alias("tallos"), F.sum("hours").alias("hours"), F.sum("people").alias("people"), aggs.weighted_mean("rate_eff", "tallos").alias("rate_eff"))
    weights = named(grades).groupBy(*keys).agg(F.sum("tallos").alias("tallos_grado"), C.safe_div(F.sum(F.col("tallos") * F.col("peso_g")), F.sum("tallos")).alias("stem_g"), F.count(F.lit(1)).alias("n_grados"))
    left = joins.enrich(field, weights, keys).withColumn("flow", F.lit("COSECHA"))
    plant = {"station": "PLANTA", "area": "ALL", "variedad": "ALL", "flow": "POSCOSECHA"}
    right = post.select(F.col("fecha_post").alias("fecha"), *(F.lit(v).alias(k) for k, v in plant.items()), "kg", "cajas", "hours", "people")
    return grain.union_all([left, right])
