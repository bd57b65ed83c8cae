"""Aggregations: robust baselines, weighted statistics, mixes, distances (AG1-AG21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .order import average_ranks, quantiles


def rollup_by(df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """``aggs``: name -> (function, column)."""
    return df.groupBy(*keys).agg(*(getattr(F, f)(c).alias(n) for n, (f, c) in aggs.items()))


def quantile_baseline(df: DataFrame, keys: list[str], col: str, qs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact interpolated quantiles ``p25``.. and ``n`` by segment."""
    q = F.percentile(col, F.array(*map(F.lit, qs)))
    names = [f"p{round(x * 100):02d}" for x in qs]
    return df.groupBy(*keys).agg(q.alias("__q"), F.count(col).alias("n")).select(*keys, *(F.col("__q")[i].alias(n) for i, n in enumerate(names)), "n")


def weighted_mean(x: str, w: str) -> Column:
    """Sum of w x over sum of w; rows with a null in either do not count; null without weight."""
    ok = F.col(x).isNotNull() & F.col(w).isNotNull()
    total = F.sum(F.when(ok, F.col(w)))
    return F.when(total > 0, F.sum(F.when(ok, F.col(x) * F.col(w))) / total)


def weighted_mean_or_median(df: DataFrame, keys: list[str], x: str, w: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(weighted_mean(x, w), F.median(x)).alias(x))


def _by_value(df: DataFrame, keys: list[str], x: str, w: str) -> DataFrame:
    """One row per distinct value: its weight, cumulated weight and the group's weight."""
    kept = df.where(F.col(x).isNotNull() & (F.col(w) > 0)).groupBy(*keys, x).agg(F.sum(w).alias("w"))
    by = W.partitionBy(*keys)
    return kept.withColumns({"cw": F.sum("w").over(by.orderBy(x).rowsBetween(W.unboundedPreceding, 0)), "total": F.sum("w").over(by)})


def weighted_median(df: DataFrame, keys: list[str], x: str, w: str) -> DataFrame:
    """The first value whose cumulated weight reaches half."""
    return _by_value(df, keys, x, w).where(F.col("cw") >= F.col("total") / 2).groupBy(*keys).agg(F.min(x).alias("weighted_median"))


def weighted_quantile(df: DataFrame, keys: list[str], x: str, w: str, q: float) -> DataFrame:
    """Value at q times the weight, linear between the cumulated weights; constant beyond the ends."""
    by = W.partitionBy(*keys).orderBy(x)
    cut = _by_value(df, keys, x, w).withColumns({"target": q * F.col("total"), "px": F.lag(x).over(by), "pc": F.lag("cw").over(by)})
    at = F.when(F.col("px").isNull(), F.col(x)).otherwise(F.col("px") + (F.col(x) - F.col("px")) * (F.col("target") - F.col("pc")) / (F.col("cw") - F.col("pc")))
    return cut.where("cw >= target").groupBy(*keys).agg(F.min_by(at, x).alias("weighted_quantile"))


def quantile_of_medians(df: DataFrame, outer: list[str], inner: list[str], x: str, min_n: int, q: float) -> DataFrame:
    """q-quantile over the inner groups' medians, of those with ``min_n`` rows (of all, if none has)."""
    medians = df.groupBy(*outer, *inner).agg(F.median(x).alias("m"), (F.count(x) >= min_n).alias("ok"))
    kept = medians.withColumn("any_ok", F.max("ok").over(W.partitionBy(*outer))).where("ok or not any_ok")
    return kept.groupBy(*outer).agg(F.percentile("m", q).alias("value"), F.count("m").alias("n_groups"))


def rollup_levels(df: DataFrame, levels: list[list[str]], measures: list[str]) -> DataFrame:
    """Sums at several grains in one pass; ``level`` is the grain's place in the list."""
    keys = list(dict.fromkeys(k for level in levels for k in level))
    sets = [[F.col(k) for k in level] for level in levels]
    out = df.groupingSets(sets, *keys).agg(*(F.sum(m).alias(m) for m in measures), F.grouping_id().alias("__g"))
    codes = {sum(1 << (len(keys) - 1 - keys.index(k)) for k in keys if k not in level): i for i, level in enumerate(levels)}
    level = F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))[F.col("__g").cast("int")]
    return out.withColumn("level", level).drop("__g")


def pivot_wide(df: DataFrame, keys: list[str], name: str, value: str, values: list, agg: str = "sum", prefix: str = "") -> DataFrame:
    """Long to wide with the column values given, so that no extra pass collects them."""
    wide = df.groupBy(*keys).pivot(name, values).agg(getattr(F, agg)(value))
    return wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def mix_features(df: DataFrame, keys: list[str], level: str, share: str, bands: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Entropy, largest share, sum of the three largest (null with fewer), mean level and banded shares."""
    p, x = F.col(share), F.col(level).cast("double")
    top = F.slice(F.sort_array(F.collect_list(p), asc=False), 1, 3)
    parts = [F.sum(F.when((x >= lo) & (x <= hi), p).otherwise(0.0)).alias(f"share_{name}") for name, (lo, hi) in (bands or {}).items()]
    return df.where(p.isNotNull()).groupBy(*keys).agg(
        F.sum(F.when(p > 0, -p * F.log(p)).otherwise(0.0)).alias("entropy"), F.max(p).alias("top1"), F.when(F.count(p) >= 3, F.aggregate(top, F.lit(0.0), lambda a, b: a + b)).alias("top3"),
        (F.sum(p * x) / F.sum(p)).alias("mean_level"), *parts,
    )


def hist_share(df: DataFrame, keys: list[str], x: str, w: str, step: float) -> DataFrame:
    """Weight share per bin of width ``step`` between the table's 1 % and 99 % quantiles."""
    edge = quantiles(df, [], x, (0.01, 0.99)).select(F.col("q").alias("e"))
    inside = df.crossJoin(F.broadcast(edge)).where(F.col(x).between(F.col("e")[0], F.col("e")[1]))  # one row
    binned = inside.withColumn("bin", F.floor((F.col(x) - F.col("e")[0]) / step)).groupBy(*keys, "bin").agg(F.sum(w).alias("weight"))
    return binned.withColumn("share", F.col("weight") / F.sum("weight").over(W.partitionBy(*keys)))


def compare_dist(p: DataFrame, q: DataFrame, keys: list[str], level: str, share: str = "share", step: float = 1.0) -> DataFrame:
    """L1, L2, cosine, shift of the mean, mass moved up and down, and earth mover's distance by key."""
    both = p.select(*keys, level, F.col(share).alias("p")).join(q.select(*keys, level, F.col(share).alias("q")), [*keys, level], "full").fillna(0.0, ["p", "q"])
    run = W.partitionBy(*keys).orderBy(level).rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("gap", F.abs(F.sum(F.col("p") - F.col("q")).over(run)))
    d = F.col("q") - F.col("p")
    return both.groupBy(*keys).agg(
        F.sum(F.abs(d)).alias("l1"), F.sqrt(F.sum(d * d)).alias("l2"), (F.sum(F.col("p") * F.col("q")) / F.sqrt(F.sum(F.col("p") * F.col("p")) * F.sum(F.col("q") * F.col("q")))).alias("cosine"),
        F.sum(d * F.col(level)).alias("mean_shift"), F.sum(F.greatest(d, F.lit(0.0))).alias("mass_up"), F.sum(F.greatest(-d, F.lit(0.0))).alias("mass_down"), (F.sum("gap") * step).alias("emd"),
    )


def corr_table(df: DataFrame, y: str, xs: list[str], min_n: int = 20) -> DataFrame:
    """``(feature, n, pearson, spearman)``; null with fewer than ``min_n`` pairs."""
    long = df.unpivot([y], [F.col(x).cast("double").alias(x) for x in xs], "feature", "x").where(F.col("x").isNotNull() & F.col(y).isNotNull())

    ranked = long
    for c, rank in (("x", "rx"), (y, "ry")):
        ranked = ranked.join(average_ranks(long, ["feature"], c, rank), ["feature", c])
    n = F.count(F.lit(1))
    corr = lambda a, b: F.when(n >= min_n, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))  # noqa: E731  null for a constant
    return ranked.groupBy("feature").agg(n.alias("n"), corr("x", y).alias("pearson"), corr("rx", "ry").alias("spearman"))


def decile_profile(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """Quantile bins (closed on the right, equal edges merged): ``bin, n, mean_x, mean_y``."""
    edges = quantiles(df, [], x, tuple(i / bins for i in range(bins + 1))).select(F.array_distinct("q").alias("e"))
    placed = df.where(F.col(x).isNotNull()).crossJoin(F.broadcast(edges))  # one row
    number = F.greatest(F.size(F.filter("e", lambda v: v < F.col(x))), F.lit(1))
    return placed.withColumn("bin", number).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"))


def winsorize(df: DataFrame, keys: list[str], x: str, lo: float = 0.01, hi: float = 0.99, min_n: int = 1) -> DataFrame:
    """Clip to the group's quantiles, in groups of ``min_n`` values."""
    bounds = df.groupBy(*keys).agg(F.percentile(x, F.array(F.lit(lo), F.lit(hi))).alias("__b"), F.count(x).alias("__n"))
    clipped = F.when((F.col("__n") >= min_n) & F.col(x).isNotNull(), F.greatest(F.col("__b")[0], F.least(F.col("__b")[1], F.col(x)))).otherwise(F.col(x))
    return df.join(bounds, keys).withColumn(x, clipped).drop("__b", "__n")


def relative_factor(df: DataFrame, keys: list[str], code: str, ref: str, x: str, min_n: int, bounds: tuple[float, float]) -> DataFrame:
    """Median by code over the median of the reference code; 1 for it and for small codes; clipped."""
    medians = df.groupBy(*keys, code).agg(F.median(x).alias("m"), F.count(x).alias("n"))
    base = medians.where(F.col(code) == ref).select(*keys, F.col("m").alias("base"))
    factor = F.when((F.col("n") < min_n) | (F.col(code) == ref) | F.col("base").isNull() | (F.col("base") <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), F.col("m") / F.col("base"))))
    joined = medians.join(base, keys, "left") if keys else medians.crossJoin(F.broadcast(base.agg(F.max("base").alias("base"))))  # one row
    return joined.select(*keys, code, "n", factor.alias("factor"))


def segment_caps(df: DataFrame, segment: list[str], x: str, qs: tuple[float, float], min_n: int = 1) -> DataFrame:
    """Low and high quantile by segment; the table's own for segments with fewer than ``min_n`` values."""
    from .joins import enrich_null_safe

    whole = quantiles(df, [], x, qs).select(F.col("q").alias("g"))
    own = quantiles(df, segment, x, qs).withColumnsRenamed({"q": "s", "n": "__n"})
    segments = enrich_null_safe(df.select(*segment).distinct(), own, segment).withColumn("n", F.coalesce("__n", F.lit(0)))
    caps = segments.crossJoin(F.broadcast(whole))  # one row
    pick = lambda i: F.when(F.col("n") >= min_n, F.col("s")[i]).otherwise(F.col("g")[i])
    return caps.select(*segment, "n", pick(0).alias("lo"), pick(1).alias("hi"))


def share_by(df: DataFrame, period: list[str], level: str, value: str) -> DataFrame:
    """Each level's share of its period's total."""
    sums = df.groupBy(*period, level).agg(F.sum(value).alias("value"))
    return sums.withColumn("share", F.col("value") / F.sum("value").over(W.partitionBy(*period)))


def top_n_other(df: DataFrame, keys: list[str], level: str, value: str, w: str, n: int, other: str = "OTHER") -> DataFrame:
    """The n levels with the most mass (value times weight) keep their name, the rest is summed up."""
    top = df.groupBy(level).agg(F.sum(F.col(value) * F.col(w)).alias("mass")).orderBy(F.desc("mass"), level).limit(n).select(level, F.lit(True).alias("__top"))
    named = df.join(F.broadcast(top), level, "left").withColumn(level, F.when(F.col("__top"), F.col(level)).otherwise(F.lit(other)))  # n rows
    return named.groupBy(*keys, level).agg(F.sum(value).alias(value))


def pick_feature(df: DataFrame, candidates: list[str], min_coverage: float) -> DataFrame:
    """``(feature, coverage, variance, score, best)``: coverage times variance, where covered enough."""
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in candidates], "feature", "x")
    stats = long.groupBy("feature").agg(F.avg(F.col("x").isNotNull().cast("double")).alias("coverage"), F.coalesce(F.var_samp("x"), F.lit(0.0)).alias("variance"))
    stats = stats.withColumn("score", F.when(F.col("coverage") >= min_coverage, F.col("coverage") * F.col("variance")).otherwise(F.lit(-1.0)))
    top = stats.agg(F.max_by("feature", F.struct("score", "feature")).alias("t"))
    return stats.crossJoin(F.broadcast(top)).withColumn("best", F.col("feature") == F.col("t")).drop("t")  # one row
