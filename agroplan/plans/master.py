"""Cycle master from its sheets, its day grid, block weather, thermal state and harvest progress.

Every function is lazy; "today" is an argument. Cycles: bloque, bloque_base, variedad, tipo_sp, area,
fecha_sp (planting), tallos_proy, inicio and fin (harvest), estado, ciclo_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggs, grain, grids, joins

#: Fixed values of the domain.
AREA_NAMES = {"SSJ": "A-4", "MM1": "MH1", "MM2": "MH2"}
VEGETATIVE_DAYS, OPEN_DAYS, HORIZON_DAYS, BASE_TEMP = 30, 4, 180, 7.1

SHAPE = ["bloque", "fecha_sp", "tipo_sp", "variedad", "area", "tallos_proy", "inicio", "fin", "estado"]


def active_cycles(sheet: DataFrame, weighings: DataFrame, today: Column) -> DataFrame:
    """Cycles of the current sheet: its lines summed up, harvest days from the weighings of the block.

    ``sheet``: bloque, tipo_sp, variedad, area, fecha_sp, tallos; lines without block or area do not
    count, of several planting dates the last does. ``weighings``: bloque, fecha. The harvest starts at
    the first weighing more than 30 days after planting and ends at the last, but is open (null) if
    there is only one or if it is later than 4 days before ``today``. Cycles planted from today on do
    not count. Weighings are reduced to one array of days per block (at most the days of history), so
    that no block's weighings meet all of its cycles as rows.
    """
    lines = sheet.where("bloque is not null and area is not null and area <> '0'")
    total = lines.groupBy("bloque", "tipo_sp", "variedad", "area").agg(F.max("fecha_sp").alias("fecha_sp"), F.sum(F.coalesce("tallos", F.lit(0.0))).alias("tallos_proy"))
    days = weighings.where("fecha is not null").groupBy("bloque").agg(F.collect_set("fecha").alias("__days"))
    late = F.filter("__days", lambda d: F.datediff(d, F.col("fecha_sp")) > VEGETATIVE_DAYS)
    placed = joins.enrich(total.where(F.col("fecha_sp") < today), days, ["bloque"]).withColumns({"inicio": F.array_min(late), "__last": F.array_max(late)})
    closed = (F.col("__last") > F.col("inicio")) & (F.col("__last") < F.date_sub(today, OPEN_DAYS))
    done = placed.withColumns({"fin": F.when(closed, F.col("__last")), "area": C.map_values("area", AREA_NAMES), "estado": F.lit("ACTIVO")})
    return done.select(SHAPE)


def closed_cycles(history: DataFrame, since: Column) -> DataFrame:
    """Cycles of a history sheet that have an end and were planted from ``since`` on; ``history`` has all columns but estado."""
    known = history.where(F.col("fin").isNotNull() & (F.col("fecha_sp") >= since))
    return known.withColumns({"area": C.map_values("area", AREA_NAMES), "estado": F.lit("CERRADO")}).select(SHAPE)


def cycle_master(frames: list[DataFrame]) -> DataFrame:
    """One row per cycle of all sheets; raises on a cycle without planting date.

    Lettered parts of a block (321A) replace the whole block (321) where both are listed for the same
    planting. Of rows with one id the active one counts, then the one of more stems, earlier area,
    start and end.
    """
    rows = grain.union_all(frames).withColumns({c: C.canon_str(c) for c in ("bloque", "variedad", "tipo_sp", "area")})
    dated = rows.withColumns({"fecha_sp": F.coalesce("fecha_sp", F.raise_error(F.lit("cycle without planting date")).cast("date")), "bloque_base": F.regexp_replace("bloque", "[^0-9]", "")})
    parts = grain.prefer_in_group(dated, ["bloque_base", "tipo_sp", "fecha_sp", "variedad", "area"], F.col("bloque") != F.col("bloque_base"))
    keyed = parts.withColumn("ciclo_id", C.content_id("bloque", "variedad", "tipo_sp", F.date_format("fecha_sp", "yyyy-MM-dd")))
    return grain.dedup(keyed, ["ciclo_id"], [F.when(F.col("estado") == "ACTIVO", 0).otherwise(1), -F.coalesce("tallos_proy", F.lit(0.0)), F.col("area"), F.col("inicio"), F.col("fin")])


def cycle_grid(master: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """A row per cycle and day from planting to ``horizon`` days later, with ISO year, ISO week and month; other columns stay."""
    days = grids.explode_dates(master.withColumn("__end", F.date_add("fecha_sp", horizon)), "fecha_sp", "__end", "fecha").drop("__end")
    return days.withColumns({"anio": F.extract(F.lit("YEAROFWEEK"), F.col("fecha")), "semana_iso": F.weekofyear("fecha"), "mes": F.month("fecha")})


def block_weather(hours: DataFrame, master: DataFrame, station_of, base: float = BASE_TEMP) -> DataFrame:
    """Daily weather of each block, by the station of its most frequent area (of equal ones the first).

    ``hours``: station, ts, rainfall_mm, temp, solar_j, is_rain; ``station_of``: a column of an area.
    The days of a station are few, so that the planner ships them whole by their measured size.
    """
    daily = hours.groupBy("station", F.to_date("ts").alias("fecha")).agg(
        F.sum("rainfall_mm").alias("rainfall_mm"), F.count_if(F.coalesce("is_rain", F.lit(False))).alias("horas_lluvia"), F.avg("temp").alias("temp"), F.sum("solar_j").alias("solar_j")
    )
    blocks = joins.attach_mode(master.select("bloque_base").distinct(), master.select("bloque_base", "area"), ["bloque_base"], "area")
    placed = joins.enrich(blocks.withColumn("station", station_of("area")), daily, ["station"], "inner")
    return placed.withColumn("gdc", C.degree_day("temp", base))


def thermal_state(grid: DataFrame, weather: DataFrame) -> DataFrame:
    """Degree-days of each cycle and day since its planting; days without weather add nothing. ``grid``: from :func:`cycle_grid`."""
    days = joins.enrich(grid.select("ciclo_id", "bloque_base", "fecha_sp", "fecha"), weather.select("bloque_base", "fecha", "gdc"), ["bloque_base", "fecha"])
    upto = W.partitionBy("ciclo_id").orderBy("fecha").rowsBetween(W.unboundedPreceding, 0)
    return days.withColumns({"gdc": F.coalesce("gdc", F.lit(0.0)), "dias_desde_sp": F.datediff("fecha", "fecha_sp")}).withColumn("gdc_acum", F.sum("gdc").over(upto))


def harvest_progress(real: DataFrame, grid: DataFrame, weather: DataFrame) -> DataFrame:
    """Harvested stems of a cycle, block and variety by day: running sum, part of the total, day of the harvest, degree-days since its start.

    ``real``: fecha, bloque_base, variedad, tallos. A day belongs to each cycle of its block whose grid
    holds it; days outside every cycle are left to :func:`unmatched_harvest`. The harvest runs from the
    first to the last day with stems.
    """
    daily = real.groupBy("fecha", "bloque_base", "variedad").agg(F.sum("tallos").alias("tallos"))
    placed = joins.enrich(daily, grid.select("ciclo_id", "bloque_base", "fecha"), ["fecha", "bloque_base"], "inner")
    known = joins.enrich(placed, weather.select("bloque_base", "fecha", "gdc"), ["bloque_base", "fecha"])
    whole = W.partitionBy("ciclo_id", "bloque_base", "variedad")
    upto = whole.orderBy("fecha").rowsBetween(W.unboundedPreceding, 0)
    day = F.when(F.col("tallos") > 0, F.col("fecha"))
    out = known.withColumns({"inicio_real": F.min(day).over(whole), "fin_real": F.max(day).over(whole), "total": F.sum(F.greatest("tallos", F.lit(0.0))).over(whole), "acum": F.sum("tallos").over(upto)})
    begun = F.when(F.col("fecha") >= F.col("inicio_real"), F.coalesce("gdc", F.lit(0.0))).otherwise(0.0)
    return out.withColumns({
        "pct": C.safe_div("acum", "total"), "dia_rel": F.datediff("fecha", "inicio_real"), "en_ventana": F.coalesce(F.col("fecha").between(F.col("inicio_real"), F.col("fin_real")), F.lit(False)).cast("int"),
        "gdc_acum": F.sum(begun).over(upto),
    })


def unmatched_harvest(real: DataFrame, grid: DataFrame) -> DataFrame:
    """Blocks with harvest days outside every cycle: how many days and stems."""
    daily = real.groupBy("fecha", "bloque_base").agg(F.sum("tallos").alias("tallos"))
    return joins.anti_join(daily, grid.select("fecha", "bloque_base"), ["fecha", "bloque_base"]).groupBy("bloque_base").agg(F.count(F.lit(1)).alias("n_days"), F.sum("tallos").alias("tallos"))


def audit_windows(master: DataFrame, source: str = "maestro") -> DataFrame:
    """Check rows of the real harvest windows, all from one scan: filled columns, order of dates, implausible lengths.

    ``value`` is the part of the rows that breaks the rule (of those with both dates); null if there are none.
    """
    start, n = F.datediff("inicio", "fecha_sp"), F.datediff("fin", "inicio") + 1
    part = lambda c: F.avg(c.cast("double"))
    rules = {f"missing_{c}": part(F.col(c).isNull()) for c in ("bloque_base", "variedad", "tipo_sp", "area", "fecha_sp", "inicio", "fin")} | {
        "start_before_planting": part(start < 0), "start_after_a_year": part(start > 365), "end_before_start": part(n <= 0), "longer_than_120": part(n > 120),
        "not_trainable": part(F.col("inicio").isNull() | F.col("fin").isNull() | F.col("fecha_sp").isNull()),
    }
    one = master.agg(*(c.alias(k) for k, c in rules.items())).unpivot([], list(rules), "rule", "value")
    return one.select(F.lit(source).alias("source"), "rule", F.when(F.col("value") > 0, "FAIL").otherwise("PASS").alias("status"), "value")


def window_segments(master: DataFrame, segment: list[str]) -> DataFrame:
    """Quartiles of the days to the start and of the harvest's length by segment (null segments count as one).

    Both are whole days, so that a segment's buffer holds a count for each of few values, however many its cycles.
    """
    days = master.withColumns({"__start": F.datediff("inicio", "fecha_sp").cast("double"), "__n": (F.datediff("fin", "inicio") + 1).cast("double")})
    starts = aggs.quantile_baseline(days, segment, "__start").withColumnsRenamed({"p25": "start_p25", "p50": "start_p50", "p75": "start_p75", "n": "n_start"})
    lengths = aggs.quantile_baseline(days, segment, "__n").withColumnsRenamed({"p25": "days_p25", "p50": "days_p50", "p75": "days_p75", "n": "n_days"})
    return joins.enrich_null_safe(starts, lengths, segment, "inner")
