"""Curve fitting and shape (CV1-CV8)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .alloc import cap_redistribute
from .windows import increments, monotone, share_within, smooth_share


def beta_share(df: DataFrame, keys: list[str], rel: str, a: str, b: str, out: str = "beta_share") -> DataFrame:
    """Shares in proportion to the Beta density at the relative positions; its constant cancels."""
    x = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), F.col(rel)))
    w = W.partitionBy(*keys)
    d = df.withColumn("__l", (F.col(a) - 1) * F.log(x) + (F.col(b) - 1) * F.log(1 - x))
    d = d.withColumn("__e", F.exp(F.col("__l") - F.max("__l").over(w)))
    return d.withColumn(out, F.col("__e") / F.sum("__e").over(w)).drop("__l", "__e")


def fit_beta(df: DataFrame, keys: list[str], rel: str, share: str, steps: int = 7, width: float = 0.12) -> DataFrame:
    """Per key the (alpha, beta) of least cross entropy on a log grid around the moment estimate.

    The grid's (2 steps + 1)^2 candidates are priced in 2 steps + 1 sums of as many copies of a row, an
    exponential each; what is linear in the row's logarithms is summed once by key. The moment estimate
    itself wins ties, then the smaller grid indices.
    """
    x = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), F.col(rel)))
    pos = F.when(F.col(share) > 0, F.col(share))
    rows = df.select(*keys, F.col(share).alias("__s"), x.alias("__x"), F.log(x).alias("__lx"), F.log(1 - x).alias("__ly"), pos.alias("__pos"))
    m = rows.groupBy(*keys).agg(
        (F.sum(F.col("__x") * F.col("__pos")) / F.sum("__pos")).alias("mu"), (F.sum(F.col("__x") * F.col("__x") * F.col("__pos")) / F.sum("__pos")).alias("m2"), F.sum("__s").alias("__total"),
        F.sum(F.when(F.col("__x").isNotNull(), F.col("__s"))).alias("__w"), F.sum(F.col("__s") * F.col("__lx")).alias("__wx"), F.sum(F.col("__s") * F.col("__ly")).alias("__wy"),
    ).where("mu is not null")
    var = F.greatest(F.col("m2") - F.col("mu") * F.col("mu"), F.lit(1e-4))
    k = F.greatest(F.col("mu") * (1 - F.col("mu")) / var - 1, F.lit(2.05))
    start = m.withColumns({"a0": F.greatest(F.col("mu") * k, F.lit(1.01)), "b0": F.greatest((1 - F.col("mu")) * k, F.lit(1.01))}).select(*keys, "a0", "b0", "__total", "__w", "__wx", "__wy")
    grid = range(-steps, steps + 1)
    cells = start.withColumn("ia", F.explode(F.array(*map(F.lit, grid)))).withColumn("al", F.greatest(F.col("a0") * F.exp(F.col("ia") * F.lit(width)), F.lit(1.0001)))
    beta = lambda j: F.greatest(F.col("b0") * F.exp(F.lit(j) * F.lit(width)), F.lit(1.0001))
    cells = cells.withColumns({f"be{n}": beta(j) for n, j in enumerate(grid)})

    def top(n: int) -> Column:
        """The density's value at its mode, from which it is taken so that e^l stays in range."""
        be = F.col(f"be{n}")
        mode = (F.col("al") - 1) / (F.col("al") + be - 2)
        return (F.col("al") - 1) * F.log(mode) + (be - 1) * F.log(1 - mode)

    cells = cells.withColumns({f"top{n}": top(n) for n in range(len(grid))})
    # -sum(w ln p) with p = e^l / sum(e^l)
    l = lambda n: (F.col("al") - 1) * F.col("__lx") + (F.col(f"be{n}") - 1) * F.col("__ly") - F.col(f"top{n}")  # noqa: E731, E741
    own = [f"{c}{n}" for c in ("be", "top") for n in range(len(grid))]
    sums = rows.select(*keys, "__lx", "__ly").join(cells.select(*keys, "ia", "al", *own), keys).groupBy(*keys, "ia").agg(*(F.sum(F.exp(l(n))).alias(f"z{n}") for n in range(len(grid))))
    part = lambda n: ((F.col("al") - 1) * F.col("__wx") + (F.col(f"be{n}") - 1) * F.col("__wy") - F.col(f"top{n}") * F.col("__w")) / F.col("__total")
    # a candidate whose density is 0 at every row has no logarithm: it is the worst
    price = [F.struct(F.coalesce(F.log(f"z{n}") - part(n), F.lit(math.inf)).alias("nll"), ((F.col("ia") != 0) | F.lit(j != 0)).alias("off"), F.col("ia"), F.lit(j).alias("ib"), F.col("al"), F.col(f"be{n}").alias("be")) for n, j in enumerate(grid)]
    fit = cells.join(sums, [*keys, "ia"]).select(*keys, F.array_min(F.array(*price)).alias("b"))
    return fit.groupBy(*keys).agg(F.min("b").alias("b")).select(*keys, F.col("b.al").alias("alpha"), F.col("b.be").alias("beta"), F.col("b.nll").alias("nll"))


def log_multiplier(df: DataFrame, keys: list[str], real: str, base: str, bound: float = 4.0, eps: float = 1e-6, out: str = "log_mult") -> DataFrame:
    """ln of the real share over the curve's, clipped."""
    d = share_within(df, keys, real, "zero", "__r")
    ratio = F.log((F.col("__r") + eps) / (F.col(base) + eps))
    return d.withColumn(out, F.greatest(F.lit(-bound), F.least(F.lit(bound), ratio))).drop("__r")


def apply_curve(df: DataFrame, keys: list[str], order: str, total: str, base: str, mult: str, cap: str, floor: float = 0.05, window: int = 5) -> DataFrame:
    """Curve times multiplier, with 5 % of the uniform one, smoothed, times the total, capped by day."""
    d = share_within(df.withColumn("__c", F.col(base) * F.exp(F.col(mult))), keys, "__c", "uniform", "__c")
    flat = 1.0 / F.count(F.lit(1)).over(W.partitionBy(*keys))
    d = smooth_share(d.withColumn("__c", (1 - floor) * F.col("__c") + floor * flat), keys, [order], "__c", window, "curve_share")
    return cap_redistribute(d.withColumn("__x", F.col("curve_share") * F.col(total)), keys, "__x", cap, "value").drop("__c", "__x")


def cdf_to_share(df: DataFrame, keys: list[str], order: str, cdf: str, base: str, window: int = 3) -> DataFrame:
    """Clipped, monotone, rescaled CDF to smoothed daily shares; where it does not rise, the base's."""
    w = W.partitionBy(*keys)
    d = monotone(df.withColumn("__c", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(cdf)))), keys, [order], "__c", "__m")
    d = d.withColumns({"__lo": F.min("__m").over(w), "__hi": F.max("__m").over(w)})
    d = d.withColumn("__z", F.when(F.col("__hi") > F.col("__lo"), (F.col("__m") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))))
    d = increments(d, keys, [order], "__z", "__s")
    d = share_within(d.withColumn("__s", F.coalesce("__s", base)), keys, "__s", "uniform", "__s")
    return smooth_share(d, keys, [order], "__s", window, "cdf_share").drop("__c", "__m", "__lo", "__hi", "__z", "__s")


def share_curve(df: DataFrame, keys: list[str], order: str, share: str, cap: str, window: int = 3) -> DataFrame:
    """Bounded and smoothed share curve."""
    from .alloc import bound_share

    d = bound_share(df.withColumns({"__lo": F.lit(0.0), "__s": F.col(share)}), keys, "__s", "__lo", cap)
    return smooth_share(d, keys, [order], "__s", window, "curve_share").drop("__lo", "__s")


def summarise_cycle(df: DataFrame, keys: list[str], order: str, means: list[str] = (), sums: list[str] = (), lasts: list[str] = ()) -> DataFrame:
    """Means, sums and last values of daily features by cycle."""
    return df.groupBy(*keys).agg(*(F.avg(c).alias(f"{c}_mean") for c in means), *(F.sum(c).alias(f"{c}_sum") for c in sums), *(F.max_by(c, order).alias(f"{c}_last") for c in lasts))


def curve_metrics(df: DataFrame, keys: list[str], order: str, p: str, q: str, rel: str) -> DataFrame:
    """L1, KS distance, distance of the first peaks, and mass at relative positions up to 0.2 and from 0.8."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    d = df.withColumn("__g", F.abs(F.sum(F.col(p) - F.col(q)).over(w)))
    mass = lambda c, cond: F.sum(F.when(cond, F.col(c)).otherwise(0.0))
    peak = lambda c: F.min_by(order, F.struct(-F.col(c), F.col(order)))
    early, late = F.col(rel) <= 0.2, F.col(rel) >= 0.8
    return d.groupBy(*keys).agg(
        F.sum(F.abs(F.col(p) - F.col(q))).alias("l1"), F.max("__g").alias("ks"), (peak(p) - peak(q)).cast("long").alias("peak_offset"), mass(p, early).alias("early_p"), mass(q, early).alias("early_q"), mass(p, late).alias("late_p"), mass(q, late).alias("late_q"),
    )
