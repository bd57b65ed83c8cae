"""Joins beyond equality: as-of, nearest, interval, overlap, cascades (JN1-JN16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .order import sliced, slices


def enrich(df: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on key columns; null keys do not match. Small dimensions are broadcast by their size."""
    return df.join(dim, on, how)


def enrich_null_safe(df: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Left or inner join in which null keys match each other."""
    renamed = dim.withColumnsRenamed({k: f"__{k}" for k in on})
    return df.join(renamed, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on)), how).drop(*(f"__{k}" for k in on))


def full_outer(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """All keys of both sides; the key columns are coalesced."""
    return a.join(b, on, "full")


#: Rows of a list of levels that a grid may broadcast.
SHORT_LIST = 10_000


def complete_grid(keys: DataFrame, values: DataFrame) -> DataFrame:
    """Every key with every value of a list; a short one (by its counted rows) is broadcast."""
    short = values.limit(SHORT_LIST + 1).count() <= SHORT_LIST
    return keys.crossJoin(F.broadcast(values) if short else values)


def key_overlap(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """One row: distinct keys of a, of b, and of both."""
    both = a.select(*on).distinct().withColumn("ia", F.lit(1)).join(b.select(*on).distinct().withColumn("ib", F.lit(1)), on, "full")
    return both.agg(F.count("ia").alias("n_a"), F.count("ib").alias("n_b"), F.count_if(F.col("ia").isNotNull() & F.col("ib").isNotNull()).alias("n_both"))


def anti_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_anti")


def _with_neighbours(both: DataFrame, by: list[str], ahead: bool) -> DataFrame:
    """Tagged rows ``(by, __ts, __side, __r, __l)`` with their slice, and right rows carried into it.

    ``__part`` orders a slice: 0 is the last right row of the slices before, 1 the slice's own rows, 2
    the first right row of those behind. A key has at most as many carried rows as slices; where all keys
    are short there is one slice and nothing to carry.
    """
    n = slices(both, by)
    cut = sliced(both, "__ts", n=n)
    if n == 1:
        return cut.withColumn("__part", F.lit(1))
    # the right rows' edges by slice, and the slices that have left rows: the left side only counts
    at = F.struct("__ts", "__r")
    edges = cut.where("__side = 0").groupBy(*by, "__slice").agg(F.max(at).alias("__last"), *([F.min(at).alias("__first")] if ahead else []))
    places = edges.unionByName(cut.where("__side = 1").select(*by, "__slice").distinct(), allowMissingColumns=True)
    order = W.partitionBy(*by).orderBy("__slice")  # two rows for each slice
    carried = [places.select(*by, "__slice", F.last("__last", ignorenulls=True).over(order.rangeBetween(W.unboundedPreceding, -1)).alias("__c"), F.lit(0).alias("__part"))]
    if ahead:
        carried.append(places.select(*by, "__slice", F.last("__first", ignorenulls=True).over(W.partitionBy(*by).orderBy(F.desc("__slice")).rangeBetween(W.unboundedPreceding, -1)).alias("__c"), F.lit(2).alias("__part")))
    rows = reduce(DataFrame.unionByName, carried).where("__c is not null").select(*by, "__slice", "__part", "__c.*", F.lit(0).alias("__side"))
    return cut.withColumn("__part", F.lit(1)).unionByName(rows, allowMissingColumns=True)


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], valid_until: str | None = None) -> DataFrame:
    """Each left row with the values of the latest right row at or before it, by key.

    Both sides go through one window by key and slice of time (no inequality join), so that a key's rows
    use many tasks; the latest right row of the slices before enters a slice as a row of its own. Right
    rows at one time are ordered by their values. ``valid_until`` (one of the values) voids a match that
    ended before.
    """
    payload = F.struct(F.col(right_ts).alias("__at"), *(F.col(v) for v in values))
    tagged_r = right.select(*by, F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"), payload.alias("__r"))
    tagged_l = left.select(*by, F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"))
    both = _with_neighbours(tagged_l.unionByName(tagged_r, allowMissingColumns=True), by, ahead=False)
    w = W.partitionBy(*by, "__slice").orderBy("__part", "__ts", "__side", "__r").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).where("__side = 1")
    if valid_until:
        ended = F.col(f"__m.{valid_until}") < F.col("__ts")
        found = found.withColumn("__m", F.when(F.coalesce(ended, F.lit(False)), None).otherwise(F.col("__m")))
    return found.select("__l.*", F.col("__m.__at").alias(f"{right_ts}_matched"), *(F.col(f"__m.{v}").alias(v) for v in values))


def nearest_join(left: DataFrame, right: DataFrame, by: list[str], left_x: str, right_x: str, values: list[str]) -> DataFrame:
    """Each left row with the closest right row by key; equal distances go to the smaller x.

    By key and slice of x, with the last right row before a slice and the first one behind it as rows of its own.
    """
    payload = F.struct(F.col(right_x).alias("x"), *(F.col(v) for v in values))
    tagged_r = right.select(*by, F.col(right_x).alias("__ts"), F.lit(0).alias("__side"), payload.alias("__r"))
    tagged_l = left.select(*by, F.col(left_x).alias("__ts"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"))
    both = _with_neighbours(tagged_l.unionByName(tagged_r, allowMissingColumns=True), by, ahead=True)
    place, group = ("__part", "__ts", "__side", "__r"), W.partitionBy(*by, "__slice")
    upto = lambda order: F.last("__r", ignorenulls=True).over(group.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    # the rows ahead are met by walking back: a frame to the group's end would be read anew for each row
    back, ahead = upto(place), upto([F.desc(c) for c in place])
    both = both.withColumns({"__b": back, "__f": ahead}).where("__side = 1").withColumn("__x", F.col("__ts"))
    to_back, to_ahead = F.col("__x") - F.col("__b.x"), F.col("__f.x") - F.col("__x")
    best = F.when(F.col("__f").isNull() | (to_back <= to_ahead), F.col("__b")).otherwise(F.col("__f"))
    return both.withColumn("__m", best).select("__l.*", F.col("__m.x").alias(f"{right_x}_matched"), *(F.col(f"__m.{v}").alias(v) for v in values))


def assign_interval(df: DataFrame, windows: DataFrame, on: list[str], ts: str, start: str, end: str, label: str, priority: str) -> DataFrame:
    """The label of the interval [start, end] that holds ``ts``; the highest priority wins; null end is open.

    A key's intervals are few (a cycle's stages) and travel as one array, so that rows need no key of their own.
    """
    packed = windows.groupBy(*on).agg(F.collect_list(F.struct(F.col(priority).alias("p"), F.col(label).alias("l"), F.col(start).alias("a"), F.col(end).alias("z"))).alias("__w"))
    holds = F.filter("__w", lambda w: (F.col(ts) >= w["a"]) & (w["z"].isNull() | (F.col(ts) <= w["z"])))
    return df.join(packed, on, "left").withColumn(label, F.array_max(holds)["l"]).drop("__w")


def overlap_hours(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per clock hour that a shift touches: ``hour`` (timestamp) and ``overlap_h`` > 0."""
    a, z = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    hours = F.explode(F.sequence(F.date_trunc("hour", a), F.date_trunc("hour", z), F.expr("INTERVAL 1 HOUR")))
    out = df.where(z > a).withColumn("hour", hours)
    seconds = F.least(F.unix_micros(z), F.unix_micros("hour") + 3_600_000_000) - F.greatest(F.unix_micros(a), F.unix_micros("hour"))
    return out.withColumn("overlap_h", seconds / 3.6e9).where("overlap_h > 0")


def lookup_cascade(df: DataFrame, levels: list[tuple[DataFrame, list[str], str]], out: str, default: float | None = None, bounds: tuple | None = None) -> DataFrame:
    """The value of the first level (dimension, keys, column) that has one, else ``default``; ``{out}_level`` counts from 1, 0 is the default."""
    found, parts = df, []
    for i, (dim, on, col) in enumerate(levels):
        name = f"__v{i}"
        side = dim.select(*on, F.col(col).alias(name))
        found = found.join(side, on, "left") if on else found.crossJoin(F.broadcast(side))  # a keyless level is one row
        parts.append(F.col(name))
    value = F.coalesce(*parts, F.lit(default))
    if bounds:
        value = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), value))
    level = F.lit(0)
    for i in reversed(range(len(parts))):
        level = F.when(parts[i].isNotNull(), i + 1).otherwise(level)
    return found.withColumns({out: value, f"{out}_level": level}).drop(*(f"__v{i}" for i in range(len(parts))))


def bridge_join(df: DataFrame, a: DataFrame, b: DataFrame, on_a: list[str], on_b: list[str]) -> DataFrame:
    """Rows that mapping ``a`` assigns and mapping ``b`` confirms (``on_b`` includes the assigned id)."""
    return df.join(a, on_a).join(b.select(*on_b).distinct(), on_b, "left_semi")


def attach_mode(df: DataFrame, ref: DataFrame, on: list[str], col: str, out: str | None = None) -> DataFrame:
    """The most frequent value per key; of equally frequent ones the smallest."""
    return df.join(ref.groupBy(*on).agg(F.mode(col, True).alias(out or col)), on, "left")


def best_offset(a: DataFrame, b: DataFrame, keys: list[str], ts: str, offsets: list[int]) -> DataFrame:
    """One row per day shift of ``a``: how many distinct (key, day) of it ``b`` has; ``best`` marks the largest (first, on ties)."""
    moved = a.select(*keys, F.col(ts).alias("__d")).distinct().withColumn("offset", F.explode(F.array(*map(F.lit, offsets))))
    moved = moved.withColumn(ts, F.date_add("__d", F.col("offset")))
    met = moved.join(b.select(*keys, ts).distinct(), [*keys, ts], "left_semi").groupBy("offset").agg(F.count(F.lit(1)).alias("n"))
    all_ = a.sparkSession.createDataFrame([(o,) for o in offsets], "offset int").join(met, "offset", "left").fillna(0, ["n"])
    top = all_.agg(F.max_by("offset", F.struct("n", -F.col("offset"))).alias("top"))
    return all_.crossJoin(F.broadcast(top)).select("offset", "n", (F.col("offset") == F.col("top")).alias("best"))  # one row
