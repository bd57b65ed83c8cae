"""Per-group sequences (WN1-WN15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _upto(keys: list[str], order: list[str]):
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def share_within(df: DataFrame, keys: list[str], x: str, on_zero: str = "null", out: str = "share") -> DataFrame:
    """x over the group's sum; groups without a sum give ``null``, ``zero`` or ``uniform`` shares."""
    w = W.partitionBy(*keys)
    total = F.sum(x).over(w)
    other = {"null": F.lit(None).cast("double"), "zero": F.lit(0.0), "uniform": 1.0 / F.count(F.lit(1)).over(w)}[on_zero]
    return df.withColumn(out, F.when(total > 0, F.coalesce(F.col(x), F.lit(0.0)) / total).otherwise(other))


def progress(df: DataFrame, keys: list[str], order: list[str], x: str) -> DataFrame:
    """Running sum ``cum`` and its part of the group's total ``pct`` (null without one)."""
    total = F.sum(x).over(W.partitionBy(*keys))
    out = df.withColumns({"cum": F.coalesce(F.sum(x).over(_upto(keys, order)), F.lit(0.0)), "__t": total})
    return out.withColumn("pct", F.when(F.col("__t") > 0, F.col("cum") / F.col("__t"))).drop("__t")


def monotone(df: DataFrame, keys: list[str], order: list[str], x: str, out: str = "monotone") -> DataFrame:
    return df.withColumn(out, F.max(x).over(_upto(keys, order)))


def increments(df: DataFrame, keys: list[str], order: list[str], x: str, out: str = "increment") -> DataFrame:
    """Difference to the row before; the first row's own value."""
    return df.withColumn(out, F.col(x) - F.coalesce(F.lag(x).over(W.partitionBy(*keys).orderBy(*order)), F.lit(0.0)))


def lag_rolling_mean(df: DataFrame, keys: list[str], order: list[str], x: str, n: int, out: str = "lag_mean") -> DataFrame:
    """Mean of the n rows before the current one."""
    return df.withColumn(out, F.avg(x).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)))


def rolling(df: DataFrame, keys: list[str], order: list[str], x: str, n: int, fn: str = "sum", out: str = "rolling") -> DataFrame:
    """Sum, mean.. of the last n rows, the current one included."""
    return df.withColumn(out, getattr(F, fn)(x).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)))


def smooth_share(df: DataFrame, keys: list[str], order: list[str], x: str, n: int, out: str = "smooth") -> DataFrame:
    """Centred mean of n rows (n odd), scaled to sum to 1 in the group."""
    mean = F.avg(x).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(-(n // 2), n // 2))
    return share_within(df.withColumn("__m", mean), keys, "__m", "null", out).drop("__m")


def edge_values(df: DataFrame, keys: list[str], order: list[str], x: str) -> DataFrame:
    """First and last non-null value of the group."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns({"first_value": F.first(x, ignorenulls=True).over(w), "last_value": F.last(x, ignorenulls=True).over(w)})


def absorb_residual(df: DataFrame, keys: list[str], order: str, x: str, target: str) -> DataFrame:
    """What the group's sum lacks to its target goes to its last row."""
    w = W.partitionBy(*keys)
    return df.withColumn(x, F.when(F.col(order) == F.max(order).over(w), F.col(x) + F.col(target) - F.sum(x).over(w)).otherwise(F.col(x)))


def asof_snapshot(series: DataFrame, entities: DataFrame, by: list[str], ts: str, start: str, asof: str, xs: list[str], spans: tuple[int, ...] = (7, 14)) -> DataFrame:
    """Per entity (key, start, as-of): sums of the series since the start and over its last rows.

    ``spans`` count rows, not days, and never reach before the start. One pass gives running sums and
    row numbers by key and slice of time; an entity then needs two point look-ups (as-of joins) per span, never the
    range of days itself.
    """
    from .joins import asof_backward
    from .order import running_sums

    sums = {f"__c_{x}": F.col(x) for x in xs}
    run = running_sums(series, by, ts, {"__rn": F.lit(1), **sums}).select(*by, ts, "__rn", *sums)
    names = ["__rn", *sums]

    def point(left: DataFrame, at: str, tag: str, right: DataFrame, right_at: str) -> DataFrame:
        found = asof_backward(left, right.withColumnsRenamed({n: f"{tag}{n}" for n in names}), by, at, right_at, [f"{tag}{n}" for n in names])
        return found.drop(f"{right_at}_matched").fillna(0, [f"{tag}__rn"]).fillna(0.0, [f"{tag}{n}" for n in sums])

    out = point(entities, asof, "last", run, ts)
    out = point(out.withColumn("__before", F.date_sub(start, 1)), "__before", "base", run, ts).drop("__before")
    result = out.withColumns({"n_rows": F.greatest(F.col("last__rn") - F.col("base__rn"), F.lit(0)), **{f"{x}_since": F.when(F.col("last__rn") > F.col("base__rn"), F.col(f"last__c_{x}") - F.col(f"base__c_{x}")).otherwise(0.0) for x in xs}})
    for n in spans:
        result = result.withColumn("__at", F.greatest(F.col("last__rn") - n, F.col("base__rn")))
        look = run.drop(ts).withColumnsRenamed({"__rn": "__at", **{s: f"p{n}{s}" for s in sums}})
        result = result.join(look, [*by, "__at"], "left").fillna(0.0, [f"p{n}{s}" for s in sums])
        result = result.withColumns({f"{x}_last{n}": F.when(F.col("last__rn") > F.col("base__rn"), F.col(f"last__c_{x}") - F.col(f"p{n}__c_{x}")).otherwise(0.0) for x in xs}).drop("__at", *(f"p{n}{s}" for s in sums))
    return result.drop(*(f"{t}{n}" for t in ("last", "base") for n in names))


#: Rows of a day that are replayed together.
BLOCK = 64


def clamped_balance(df: DataFrame, keys: list[str], ts: str, delta: str, lo: float, hi: float, start: float = 0.0) -> DataFrame:
    """Running balance ``clip(previous + delta, lo, hi)`` and the balance before it, by key.

    A step is the map x -> min(hi, max(lo, x + s)), and such maps are closed under composition. The rows
    of a (key, day) are cut into blocks of ``BLOCK``, each of which folds its steps into one map; blocks
    fold into days, days into months. A scan over each level's few maps carries the balance down again,
    and each block replays its rows from there. Two stations with long series thus use many tasks, and
    however dense a day is, no list holds more than a block's rows, a day's blocks, a month's days or a
    series' months. Null deltas count as 0; equal times go by delta.
    """
    from .joins import enrich_null_safe

    clip = lambda x, a, b: F.least(b, F.greatest(a, x))
    none = F.struct(F.lit(0.0).alias("s"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"))

    def then(f: Column, g: Column) -> Column:
        return F.struct((f["s"] + g["s"]).alias("s"), clip(f["lo"] + g["s"], g["lo"], g["hi"]).alias("lo"), clip(f["hi"] + g["s"], g["lo"], g["hi"]).alias("hi"))

    def apply(f: Column, x: Column) -> Column:
        return clip(x + f["s"], f["lo"], f["hi"])

    def folded(rows: DataFrame, by: list[str], place: str) -> DataFrame:
        """One map for each group: its rows' maps in order of ``place``."""
        packed = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(place, "__f"))).alias("__l"))
        return packed.withColumn("__f", F.aggregate("__l", none, lambda acc, r: then(acc, r["__f"]))).drop("__l")

    def carried(rows: DataFrame, by: list[str], place: str, x0: Column) -> DataFrame:
        """``__x``: the balance at the start of each row of a level, from ``x0`` at the start of its group."""
        before = F.collect_list("__f").over(W.partitionBy(*by).orderBy(place).rowsBetween(W.unboundedPreceding, -1))
        return rows.withColumn("__x", F.aggregate(before, x0, lambda x, f: apply(f, x)))

    step = F.coalesce(F.col(delta), F.lit(0.0)).cast("double")
    L, H = F.lit(float(lo)), F.lit(float(hi))
    by_day, by_block = [*keys, "__m", "__d"], [*keys, "__m", "__d", "__b"]
    d = df.withColumns({"__m": F.date_trunc("month", ts), "__d": F.date_trunc("day", ts), "__s": step})
    d = d.withColumn("__b", F.floor((F.row_number().over(W.partitionBy(*by_day).orderBy(ts, "__s")) - 1) / BLOCK))
    blocks = d.groupBy(*by_block).agg(F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), F.col("__s").alias("s"), F.struct(*df.columns).alias("row")))).alias("__rows"))
    blocks = blocks.withColumn("__f", F.aggregate("__rows", none, lambda acc, r: then(acc, F.struct(r["s"].alias("s"), L.alias("lo"), H.alias("hi")))))
    days = folded(blocks, by_day, "__b")
    months = carried(folded(days, [*keys, "__m"], "__d"), keys, "__m", F.lit(float(start))).select(*keys, "__m", F.col("__x").alias("__x0"))
    days = carried(enrich_null_safe(days, months, [*keys, "__m"]), [*keys, "__m"], "__d", F.col("__x0")).select(*by_day, F.col("__x").alias("__x0"))
    blocks = carried(enrich_null_safe(blocks, days, by_day), by_day, "__b", F.col("__x0"))
    first = F.array(F.struct(F.lit(None).cast("int").alias("i"), F.col("__x").alias("prev"), F.col("__x").alias("bal")))
    walked = F.aggregate(F.sequence(F.lit(0), F.size("__rows") - 1), first, lambda acc, i: F.concat(acc, F.array(F.struct(i.alias("i"), F.element_at(acc, -1)["bal"].alias("prev"), clip(F.element_at(acc, -1)["bal"] + F.get("__rows", i)["s"], L, H).alias("bal")))))
    out = blocks.select("__rows", F.explode(F.slice(walked, 2, F.size("__rows"))).alias("w"))
    return out.select(F.get("__rows", F.col("w.i")).alias("r"), "w").select("r.row.*", F.col("w.prev").alias("balance_before"), F.col("w.bal").alias("balance"))


def wetness_state(balance: Column) -> Column:
    """SECO up to 0.3, HUMEDO up to 2.0, MOJADO beyond."""
    return F.when(balance <= 0.3, "SECO").when(balance <= 2.0, "HUMEDO").otherwise("MOJADO")
