"""Error metrics and data audits (EV1-EV6, AU1-AU11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _metrics(y: Column, p: Column, w: Column) -> list[Column]:
    e = p - y
    total, mean = F.sum(w), F.sum(w * y) / F.sum(w)
    sse = F.sum(w * e * e)
    spread = F.sum(w * y * y) - total * mean * mean
    return [
        F.count(F.lit(1)).alias("n"), (F.sum(w * F.abs(e)) / total).alias("mae"), (F.sum(w * e) / total).alias("bias"), F.sqrt(sse / total).alias("rmse"),
        F.when(spread > 0, 1 - sse / spread).alias("r2"), F.when(F.sum(w * F.abs(y)) > 0, F.sum(w * F.abs(e)) / F.sum(w * F.abs(y))).alias("wape"),
        (F.sum(w * F.when(F.abs(y) + F.abs(p) > 0, 2 * F.abs(e) / (F.abs(y) + F.abs(p))).otherwise(0.0)) / total).alias("smape"),
    ]


def error_metrics(df: DataFrame, y: str, p: str, w: str | None = None, by: list[str] = ()) -> DataFrame:
    """n, MAE, bias, RMSE, R2, WAPE and sMAPE of labelled rows, weighted or not."""
    ok = df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & (F.col(w) > 0 if w else F.lit(True)))
    return ok.groupBy(*by).agg(*_metrics(F.col(y), F.col(p), F.col(w) if w else F.lit(1.0)))


def log_ratio_mae(df: DataFrame, y: str, p: str, w: str, by: list[str] = ()) -> DataFrame:
    """Weighted mean absolute log ratio of positive factors."""
    ok = df.where((F.col(y) > 0) & (F.col(p) > 0) & (F.col(w) > 0))
    return ok.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.sum(F.col(w) * F.abs(F.log(F.col(p) / F.col(y)))) / F.sum(w)).alias("log_mae"))


def compare_models(df: DataFrame, y: str, a: str, b: str, segments: list[str]) -> DataFrame:
    """MAE of two models over all rows and by each segment, and the improvement; ``segment`` names the column."""
    ea, eb = F.abs(F.col(a) - F.col(y)), F.abs(F.col(b) - F.col(y))
    ok = df.where(F.col(y).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull())
    out = ok.groupingSets([[], *([F.col(s)] for s in segments)], *segments).agg(F.count(F.lit(1)).alias("n"), F.avg(ea).alias("mae_a"), F.avg(eb).alias("mae_b"), F.grouping_id().alias("__g"))
    full = (1 << len(segments)) - 1
    name = F.when(F.col("__g") == full, F.lit("ALL"))
    for i, s in enumerate(segments):
        name = name.when(F.col("__g") == full - (1 << (len(segments) - 1 - i)), F.lit(s))
    value = F.coalesce(*(F.col(s).cast("string") for s in segments), F.lit("ALL"))
    return out.select(name.alias("segment"), value.alias("value"), "n", "mae_a", "mae_b", F.when(F.col("mae_a") > 0, 1 - F.col("mae_b") / F.col("mae_a")).alias("improvement"))


def describe_dist(df: DataFrame, x: str, by: list[str] = ()) -> DataFrame:
    qs = (0.05, 0.25, 0.5, 0.75, 0.95)
    out = df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.percentile(x, F.array(*map(F.lit, qs))).alias("__q"))
    return out.select(*by, "n", "mean", *(F.col("__q")[i].alias(f"p{round(q * 100):02d}") for i, q in enumerate(qs)))


def zero_rates(df: DataFrame, keys: list[str], y: str, p: str, w: str, zero: float = 0.03, low: float = 0.05) -> DataFrame:
    """Day level: weighted part of non-zero days predicted as zero, and of zero days predicted as not."""
    day = df.groupBy(*keys).agg(F.sum(y).alias("y"), F.sum(p).alias("p"), F.sum(w).alias("w"))
    rate = lambda of, hit: F.when(F.sum(F.when(of, F.col("w"))) > 0, F.sum(F.when(of & hit, F.col("w")).otherwise(0.0)) / F.sum(F.when(of, F.col("w"))))
    is_zero, predicted = F.col("y") <= zero, F.col("p") <= low
    return day.agg(F.count(F.lit(1)).alias("n_days"), rate(~is_zero, predicted).alias("nonzero_as_zero"), rate(is_zero, ~predicted).alias("zero_as_nonzero"))


CHECK_COLUMNS = ["check_id", "source", "key", "status", "value", "expected", "tolerance", "details"]


def _row(df: DataFrame, check_id: str, source: str, value: Column, expected: float, tolerance: float, key: Column | None = None, details: Column | None = None) -> DataFrame:
    v = value.cast("double")
    status = F.when(F.abs(v - expected) <= tolerance, "PASS").otherwise("FAIL")
    key, details = (F.lit("") if key is None else key), (F.lit("") if details is None else details)
    return df.select(F.lit(check_id).alias("check_id"), F.lit(source).alias("source"), key.alias("key"), status.alias("status"), v.alias("value"), F.lit(float(expected)).alias("expected"), F.lit(float(tolerance)).alias("tolerance"), details.alias("details"))


def check_unique(df: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Part of the rows that repeat a key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _row(per.agg((F.sum(F.col("n") - 1) / F.sum("n")).alias("v")), "AU1_unique", source, F.coalesce("v", F.lit(0.0)), 0, 0)


def check_share_sum(df: DataFrame, keys: list[str], share: str, source: str, tol: float = 1e-6) -> DataFrame:
    """Part of the groups whose shares do not sum to 1."""
    sums = df.groupBy(*keys).agg(F.sum(share).alias("s"))
    return _row(sums.agg(F.avg((F.abs(F.coalesce("s", F.lit(0.0)) - 1) > tol).cast("double")).alias("v")), "AU2_share_sum", source, F.coalesce("v", F.lit(0.0)), 0, 0)


def check_coverage(universe: DataFrame, df: DataFrame, on: list[str], source: str) -> DataFrame:
    """Part of the universe's keys that the table lacks."""
    all_ = universe.select(*on).distinct().join(df.select(*on).distinct().withColumn("__in", F.lit(1)), on, "left")
    return _row(all_.agg(F.avg(F.col("__in").isNull().cast("double")).alias("v")), "AU3_coverage", source, F.coalesce("v", F.lit(0.0)), 0, 0)


def check_mass_balance(child: DataFrame, parent: DataFrame, on: list[str], child_value: str, parent_value: str, source: str) -> DataFrame:
    """Groups whose child sum misses the parent by more than max(1e-3, 1e-5 x)."""
    sums = child.groupBy(*on).agg(F.sum(child_value).alias("c")).join(parent.groupBy(*on).agg(F.sum(parent_value).alias("p")), on, "full").fillna(0.0, ["c", "p"])
    bad = F.abs(F.col("c") - F.col("p")) > F.greatest(F.lit(1e-3), 1e-5 * F.abs("p"))
    return _row(sums.agg(F.count_if(bad).alias("v"), F.max(F.abs(F.col("c") - F.col("p"))).alias("d")), "AU4_mass_balance", source, F.col("v"), 0, 0, details=F.coalesce(F.round("d", 6).cast("string"), F.lit("")))


def check_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]], source: str) -> DataFrame:
    """Per column, the part of its values outside [lo, hi]."""
    one = df.agg(*(F.coalesce(F.avg((~F.col(c).between(lo, hi)).cast("double")), F.lit(0.0)).alias(c) for c, (lo, hi) in ranges.items()))
    return _row(one.unpivot([], list(ranges), "k", "v"), "AU5_range", source, F.col("v"), 0, 0, key=F.col("k"))


def check_constant(df: DataFrame, keys: list[str], attribute: str, source: str) -> DataFrame:
    """Number of keys within which the attribute varies."""
    per = df.groupBy(*keys).agg(F.count_distinct(attribute).alias("d"))
    return _row(per.agg(F.count_if(F.col("d") > 1).alias("v")), "AU6_constant", source, F.col("v"), 0, 0, key=F.lit(attribute))


def check_dates(model: DataFrame, real: DataFrame, on: list[str], model_start: str, real_start: str, source: str, slack: int = 3) -> DataFrame:
    """Number of keys whose modelled start is more than ``slack`` days before the real one."""
    both = model.groupBy(*on).agg(F.min(model_start).alias("m")).join(real.groupBy(*on).agg(F.min(real_start).alias("r")), on)
    return _row(both.agg(F.count_if(F.datediff("m", "r") < -slack).alias("v")), "AU7_dates", source, F.col("v"), 0, 0)


def check_identity(df: DataFrame, left: Column, right: Column, source: str, name: str, tol: float = 1e-6) -> DataFrame:
    """Part of the rows in which two expressions differ; both null is equal."""
    bad = F.when(left.isNull() & right.isNull(), F.lit(False)).otherwise(F.coalesce(F.abs(left - right) > tol, F.lit(True)))
    return _row(df.agg(F.avg(bad.cast("double")).alias("v")), "AU8_identity", source, F.coalesce("v", F.lit(0.0)), 0, 0, key=F.lit(name))


def clip_impact(df: DataFrame, keys: list[str], rel: str, raw: str, clipped: str, bins: int = 10) -> DataFrame:
    """Per bin of the relative position: rows, part that a bound changed, and the mass it took."""
    hit = F.abs(F.col(raw) - F.col(clipped)) > 1e-12
    place = F.least(F.floor(F.col(rel) * bins), F.lit(bins - 1))
    return df.withColumn("bin", place).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("hit_rate"), F.sum(F.col(raw) - F.col(clipped)).alias("mass_cut"))


def check_nonempty(df: DataFrame) -> bool:
    return not df.isEmpty()


def output_contract(outputs: dict[str, DataFrame]) -> DataFrame:
    """``(output, filled)``: whether each of the listed outputs has a row."""
    return reduce(DataFrame.unionByName, (df.limit(1).agg(F.lit(name).alias("output"), (F.count(F.lit(1)) > 0).alias("filled")) for name, df in outputs.items()))


def all_checks(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
