"""Calendars, expansions, milestones and event rows (GR1-GR8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, encode_corr
from .joins import lookup_cascade
from .order import quantiles


def explode_dates(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day of [start, end]; none where the end is before the start or missing."""
    return df.where(F.col(end) >= F.col(start)).withColumn(out, F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))))


def explode_n_days(df: DataFrame, start: str, n: str) -> DataFrame:
    """n days (rounded half to even) from the start: ``day``, ``day_index`` from 1 and ``rel`` = index / n."""
    days = F.rint(F.col(n)).cast("int")
    out = df.where(days >= 1).withColumn("__n", days).withColumn("day_index", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return out.withColumns({"day": F.date_add(F.col(start).cast("date"), F.col("day_index") - 1), "rel": F.col("day_index") / F.col("__n")}).drop("__n")


def asof_dates(df: DataFrame, start: str, end: str, step: int = 7, lead: int = 14, keep: int = 10) -> DataFrame:
    """Dates every ``step`` days from start + lead to end - 1, that last day included; the last ``keep`` of them."""
    first, last = F.date_add(F.col(start).cast("date"), lead), F.date_sub(F.col(end).cast("date"), 1)
    days = F.array_sort(F.array_union(F.sequence(first, last, F.expr(f"INTERVAL {step} DAYS")), F.array(last)))
    return df.where(first <= last).withColumn("asof", F.explode(F.slice(days, F.greatest(F.size(days) - keep + 1, F.lit(1)), keep)))


def milestones(df: DataFrame, keys: list[str], rules: dict[str, Column], source: str) -> DataFrame:
    """Wide dates to long rows ``(keys, milestone, day, source)``; missing dates give none."""
    rows = F.array(*(F.struct(F.lit(code).alias("milestone"), day.cast("date").alias("day")) for code, day in rules.items()))
    return df.select(*keys, F.inline(rows), F.lit(source).alias("source")).where("day is not null")


def stage_windows(long: DataFrame, keys: list[str], stages: dict[str, tuple[str, str, int]]) -> DataFrame:
    """``stages``: name -> (start milestone, end milestone, days added to the end). An end before the start is open (null)."""
    codes = sorted({c for a, b, _ in stages.values() for c in (a, b)})
    wide = long.groupBy(*keys).pivot("milestone", codes).agg(F.min("day"))
    rows = F.array(*(F.struct(F.lit(name).alias("stage"), F.col(a).alias("start"), F.date_add(F.col(b), plus).alias("end")) for name, (a, b, plus) in stages.items()))
    return wide.select(*keys, F.inline(rows)).where("start is not null").withColumn("end", F.when(F.col("end") >= F.col("start"), F.col("end")))


def infer_milestones(df: DataFrame, history: DataFrame, segment: list[str], start: str, lengths: dict[str, str], min_n: int = 5) -> DataFrame:
    """Adds ``milestone -> start + median length`` by segment with ``min_n`` histories, else over all; ``lengths``: milestone -> length column of the history."""
    out = df
    for code, col in lengths.items():
        own = history.groupBy(*segment).agg(F.median(col).alias("m"), F.count(col).alias("n")).where(F.col("n") >= min_n).select(*segment, "m")
        whole = quantiles(history, [], col, (0.5,)).select(F.col("q")[0].alias("m"))
        out = lookup_cascade(out, [(own, segment, "m"), (whole, [], "m")], "__days")
        out = out.withColumns({code: F.date_add(start, F.rint("__days").cast("int")), f"{code}_level": F.col("__days_level")}).drop("__days", "__days_level")
    return out


def event_rows(df: DataFrame, stage: str, keys: list[str], targets: dict[str, tuple[Column, float, float]], weight: Column) -> DataFrame:
    """Rows of one stage in the common shape: clipped ``target_*`` and ``mask_*`` weights (0 without a target)."""
    cols = {}
    for name, (value, lo, hi) in targets.items():
        cols[f"target_{name}"] = clip(value.cast("double"), lo, hi)
        cols[f"mask_{name}"] = F.when(value.isNotNull(), weight).otherwise(0.0).cast("float")
    return df.select(F.lit(stage).alias("stage"), *keys, *(v.alias(k) for k, v in cols.items()))


def residual_dataset(pred: DataFrame, real: DataFrame, on: list[str], p: str, y: str, mode: str, bound: tuple[float, float], day: str, asof: str) -> DataFrame:
    """Predictions with actuals up to ``asof``: the clipped correction ``target`` and ``in_real``."""
    joined = pred.where(F.col(day) <= F.lit(asof).cast("date")).join(real.select(*on, F.col(y).alias("__y")), on, "left")
    target = clip(encode_corr("__y", p, mode), *bound)
    return joined.withColumns({"target": target, "in_real": F.col("__y").isNotNull()}).withColumnRenamed("__y", y)


def expand_horizon(df: DataFrame, plan: DataFrame, keys: list[str], day: str, start: str, n: str) -> DataFrame:
    """Rows for every day 1..n of each planned group: those there are, and the absent ones with null values; with ``day_index``."""
    grid = explode_n_days(plan.select(*keys, start, n), start, n).select(*keys, F.col("day").alias(day), "day_index")
    return grid.join(df, [*keys, day], "left")
