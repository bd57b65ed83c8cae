"""Allocation and mass balance (AL1-AL28)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .windows import share_within


def _sum(c: Column | str, keys: list[str]) -> Column:
    return F.sum(c).over(W.partitionBy(*keys))


def spread_uniform(df: DataFrame, total: str, n: str, out: str = "value") -> DataFrame:
    """total / n on each of the n rows of a window (expanded before); null where n <= 0."""
    return df.withColumn(out, F.when(F.col(n) > 0, F.col(total) / F.col(n)))


def spread_weighted(df: DataFrame, keys: list[str], total: str, w: str, out: str = "value") -> DataFrame:
    """total times w over the group's sum of w; groups without weight get null (see checks.check_mass_balance)."""
    return share_within(df, keys, w, "null", "__s").withColumn(out, F.col(total) * F.col("__s")).drop("__s")


def split_by_share(df: DataFrame, shares: DataFrame, on: list[str], total: str, share: str, out: str = "value") -> DataFrame:
    """Each row times each of its key's level shares."""
    return df.join(shares, on).withColumn(out, F.col(total) * F.col(share))


def split_wide(df: DataFrame, weights: DataFrame, on: list[str], names: list[str], total: str, default_key: dict, label: str = "finish") -> DataFrame:
    """One row to one per name by wide weights, scaled to 1; keys without weights use the default row."""
    base = weights.where(" and ".join(f"{k} = '{v}'" for k, v in default_key.items())).select(*(F.col(n).alias(f"__d_{n}") for n in names)).limit(1)
    wide = df.join(weights.select(*on, *names), on, "left").crossJoin(F.broadcast(base))  # one row
    wide = wide.withColumns({n: F.coalesce(n, f"__d_{n}") for n in names})
    whole = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    parts = F.inline(F.array(*(F.struct(F.lit(n).alias(label), (F.col(n) / whole).alias("weight")) for n in names)))
    return wide.select(*df.columns, parts).withColumn("value", F.col(total) * F.col("weight"))


def override_share(df: DataFrame, real: DataFrame, on: list[str], keys: list[str], share: str = "share") -> DataFrame:
    """The observed share where there is one, else the planned; its source; scaled to 1 per group."""
    joined = df.join(real.select(*on, F.col(share).alias("__real")), on, "left")
    mixed = joined.withColumns({"source": F.when(F.col("__real").isNotNull(), "REAL").otherwise("PLAN"), share: F.coalesce("__real", share)}).drop("__real")
    return share_within(mixed, keys, share, "null", share)


def week_to_day(df: DataFrame, calendar: DataFrame, week: str, value: str) -> DataFrame:
    """A week's value as seven daily ones."""
    return df.join(calendar.select(week, "day"), week).withColumn(value, F.col(value) / 7.0)


def split_by_effort(df: DataFrame, keys: list[str], total: str, effort: str, out: str = "units") -> DataFrame:
    """Units over a shift's hours in proportion to effort (overlap times state factor); the sum is kept."""
    return spread_weighted(df, keys, total, effort, out)


def cap_redistribute(df: DataFrame, keys: list[str], x: str, cap: Column | str, out: str = "capped") -> DataFrame:
    """Cap each row and move the excess to rows with slack, in proportion to it; ``uncovered`` is what finds no slack.

    The usual loop has a closed form: with b = min(x, cap), E the excess and S the slack of the group,
    the result is b + (cap - b) min(1, E / S).
    """
    cap = F.col(cap) if isinstance(cap, str) else cap
    d = df.withColumns({"__cap": cap, "__b": F.least(F.col(x), cap)})
    d = d.withColumns({"__e": _sum(F.col(x) - F.col("__b"), keys), "__s": _sum(F.col("__cap") - F.col("__b"), keys)})
    part = F.when(F.col("__s") > 0, F.least(F.lit(1.0), F.col("__e") / F.col("__s"))).otherwise(0.0)
    return d.withColumns({out: F.col("__b") + (F.col("__cap") - F.col("__b")) * part, "uncovered": F.greatest(F.col("__e") - F.col("__s"), F.lit(0.0))}).drop("__cap", "__b", "__e", "__s")


def bound_share(df: DataFrame, keys: list[str], share: str, lo: str, hi: str) -> DataFrame:
    """Bound by per-row limits (null: none), then scale to 1."""
    bounded = F.least(F.greatest(F.col(share), F.coalesce(F.col(lo), F.col(share))), F.coalesce(F.col(hi), F.col(share)))
    return share_within(df.withColumn(share, bounded), keys, share, "null", share)


def factor_chain(df: DataFrame, base: str, factors: list[str], divide: list[str] = (), out: str = "final") -> DataFrame:
    """base times the factors, over the ``divide`` ones (adjustment as ideal / actual); null where one is 0."""
    value = F.col(base)
    for f in factors:
        value = value * F.col(f)
    for f in divide:
        value = F.when(F.col(f) != 0, value / F.col(f))
    return df.withColumn(out, value)


def anchor_to_actual(df: DataFrame, keys: list[str], ts: str, pred: str, real: str, asof: Column, closed: str, out: str = "anchored") -> DataFrame:
    """Observed days as they were; later days scaled so that the predicted total is kept; closed groups all real."""
    seen = F.col(ts) <= asof
    actual = F.coalesce(F.col(real), F.lit(0.0))
    left = _sum(F.col(pred), keys) - _sum(F.when(seen, actual).otherwise(0.0), keys)
    ahead = _sum(F.when(~seen, F.col(pred)).otherwise(0.0), keys)
    scaled = F.when(ahead > 0, F.col(pred) * F.greatest(left, F.lit(0.0)) / ahead).otherwise(0.0)
    return df.withColumn(out, F.when(F.col(closed) | seen, actual).otherwise(scaled))


def select_by_state(df: DataFrame, closed: Column, real: str, first: str, second: str, out: str = "value") -> DataFrame:
    """Real values where there are any, else the baseline for closed and the corrected model for active rows; with the source's name."""
    has = F.col(real).isNotNull()
    source = F.when(closed & has, "REAL_CLOSED").when(closed, "ML1_CLOSED").when(has, "REAL_ACTIVE").otherwise("ML2_ACTIVE")
    return df.withColumns({out: F.when(has, F.col(real)).when(closed, F.col(first)).otherwise(F.col(second)), f"{out}_source": source})


def extend_horizon(df: DataFrame, elapsed: str, horizon: str, done: str, expected: str, lag: float = 0.98, most: int = 120) -> DataFrame:
    """Where progress lags behind the expected, the horizon becomes ceil(elapsed / progress), never shorter, bounded."""
    late = (F.col(done) > 0) & (F.col(done) < lag * F.col(expected))
    longer = F.least(F.ceil(F.col(elapsed) / F.col(done)), F.lit(most))
    return df.withColumns({"is_late": F.coalesce(late, F.lit(False)), f"{horizon}_new": F.when(late, F.greatest(longer, F.col(horizon))).otherwise(F.col(horizon))})


def rescale_to_target(df: DataFrame, keys: list[str], x: str, target: str, fixed: Column, out: str = "rescaled") -> DataFrame:
    """Scale the rows that are not fixed so that the group meets its target (at least the fixed sum)."""
    kept, free = _sum(F.when(fixed, F.col(x)).otherwise(0.0), keys), _sum(F.when(~fixed, F.col(x)).otherwise(0.0), keys)
    goal = F.greatest(F.col(target), kept)
    return df.withColumn(out, F.when(fixed, F.col(x)).when(free > 0, F.col(x) * (goal - kept) / free).otherwise(F.col(x)))


def scale_to_floor(df: DataFrame, keys: list[str], x: str, projected: str, observed: str, out: str = "scaled") -> DataFrame:
    """Scale all rows to the larger of the projected and the observed total."""
    total = _sum(F.col(x), keys)
    return df.withColumn(out, F.when(total > 0, F.col(x) * F.greatest(F.col(projected), F.coalesce(F.col(observed), F.lit(0.0))) / total).otherwise(F.col(x)))


def reconcile_children(child: DataFrame, parent: DataFrame, on: list[str], mix: str, parent_value: str, out: str = "value") -> DataFrame:
    """Children become the parent's value times their mix scaled to 1."""
    return share_within(child, on, mix, "uniform", "__m").join(parent.select(*on, parent_value), on).withColumn(out, F.col(parent_value) * F.col("__m")).drop("__m")


def fill_residual(df: DataFrame, keys: list[str], real: str, mix: str, total: str, out: str = "filled") -> DataFrame:
    """Observed children stay; what the parent has left goes to the missing ones by mix; then all are scaled to the parent."""
    has = F.col(real).isNotNull()
    left = F.greatest(F.col(total) - _sum(F.when(has, F.col(real)).otherwise(0.0), keys), F.lit(0.0))
    weight = _sum(F.when(~has, F.col(mix)).otherwise(0.0), keys)
    first = F.when(has, F.col(real)).when(weight > 0, left * F.col(mix) / weight).otherwise(0.0)
    d = df.withColumn("__f", first).withColumn("__t", _sum("__f", keys))
    return d.withColumn(out, F.when(F.col("__t") > 0, F.col("__f") * F.col(total) / F.col("__t")).otherwise(F.col("__f"))).drop("__f", "__t")


def observed_zero_fill(df: DataFrame, keys: list[str], ts: str, x: str) -> DataFrame:
    """Missing values up to the group's last observed day are zeros."""
    last = F.max(F.when(F.col(x).isNotNull(), F.col(ts))).over(W.partitionBy(*keys))
    return df.withColumn(x, F.when(F.col(x).isNull() & (F.col(ts) <= last), F.lit(0.0)).otherwise(F.col(x)))


def complete_horizon(df: DataFrame, keys: list[str], day: str, n: str, measures: list[str]) -> DataFrame:
    """Adds the absent days 1..n as copies of the group's last row with null measures."""
    rest = [c for c in df.columns if c not in (*keys, day)]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), day).alias("__r"), F.max(n).alias("__n"), F.collect_set(day).alias("__have"))
    days = F.explode(F.array_except(F.sequence(F.lit(1), F.greatest("__n", F.lit(1)).cast("int")), F.col("__have").cast("array<int>")))
    added = last.where("__n >= 1").select(*keys, days.alias(day), "__r.*").withColumn(day, F.col(day).cast(dict(df.dtypes)[day]))
    return df.unionByName(added.withColumns({m: F.lit(None).cast(dict(df.dtypes)[m]) for m in measures}))


def shrink_to_prior(df: DataFrame, keys: list[str], p: str, prior: str, y: str, w: str, group: str, min_n: int = 120, steps: int = 19, out: str = "shrunk") -> DataFrame:
    """(1 - l) p + l prior with the l in [0, 0.9] of least weighted absolute error, per level with ``min_n`` labelled rows, else over all; scaled to 1."""
    grid = F.explode(F.array(*(F.lit(i * 0.9 / (steps - 1)) for i in range(steps)))).alias("l")
    seen = df.where(F.col(y).isNotNull()).select(group, p, prior, y, w, grid)
    error = F.sum(F.col(w) * F.abs((1 - F.col("l")) * F.col(p) + F.col("l") * F.col(prior) - F.col(y))) / F.sum(w)
    one = seen.groupBy(group, "l").agg(error.alias("e"), F.count(F.lit(1)).alias("n"))
    level = one.groupBy(group).agg(F.min(F.struct("e", "l")).alias("b"), F.max("n").alias("n")).where(F.col("n") >= min_n).select(group, F.col("b.l").alias("__own"))
    whole = seen.groupBy("l").agg(error.alias("e")).agg(F.min(F.struct("e", "l")).alias("b")).select(F.col("b.l").alias("__all"))
    joined = df.join(level, group, "left").crossJoin(F.broadcast(whole)).withColumn("lambda", F.coalesce("__own", "__all", F.lit(0.0)))  # one row
    mixed = joined.withColumn(out, (1 - F.col("lambda")) * F.col(p) + F.col("lambda") * F.col(prior)).drop("__own", "__all")
    return share_within(mixed, keys, out, "null", out)


def bound_by_caps(df: DataFrame, levels: list[tuple[DataFrame, list[str]]], x: str, fallback: tuple[float, float], out: str = "bounded") -> DataFrame:
    """Clip to the (lo, hi) of the finest level that has caps, else the fallback."""
    from .joins import lookup_cascade

    d = lookup_cascade(df, [(c, on, "lo") for c, on in levels], "__lo", fallback[0])
    d = lookup_cascade(d, [(c, on, "hi") for c, on in levels], "__hi", fallback[1])
    return d.withColumn(out, F.when(F.col(x).isNotNull(), F.greatest("__lo", F.least("__hi", F.col(x))))).drop("__lo", "__hi", "__lo_level", "__hi_level")


def harvest_chain(daily: DataFrame, grades: DataFrame, weights: DataFrame, keys: list[str], order: str, model: str, base: str, total: str) -> DataFrame:
    """Daily curve (blended, smoothed, scaled to the total), grade shares, stems and kg (AL21)."""
    curve = adaptive_blend(daily, keys, order, model, base, "__c")
    stems = spread_weighted(curve, keys, total, "__c", "stems_day").drop("__c")
    by_grade = split_by_share(stems, share_within(grades, keys, "share", "uniform", "share"), keys, "stems_day", "share", "stems")
    return by_grade.join(weights, "grade", "left").withColumn("kg", F.col("stems") * F.col("stem_g") / 1000.0)


def propagate_ratio(df: DataFrame, new: str, old: str, value: str, out: str = "propagated") -> DataFrame:
    """value times new / old; value itself where old is not positive."""
    return df.withColumn(out, F.when(F.col(old) > 0, F.col(value) * F.col(new) / F.col(old)).otherwise(F.col(value)))


def required_hours(df: DataFrame, units: str, rate: str, shift_h: float = 9.5) -> DataFrame:
    """Hours at the effective rate, and people for a shift (rounded up)."""
    hours = F.when(F.col(rate) > 0, F.col(units) / F.col(rate))
    return df.withColumns({"hours": hours, "people": F.ceil(hours / shift_h)})


def adaptive_blend(df: DataFrame, keys: list[str], order: str, model: str, base: str, out: str = "blended") -> DataFrame:
    """All model where the base is flat (cv < 0.08); else 0.8 or 0.7 model (its cv at least the base's, or not) and the scaled base; then 10 or 20 % of the centred mean of 3."""
    w = W.partitionBy(*keys)
    cv = lambda c: F.when(F.avg(c).over(w) > 0, F.stddev_pop(c).over(w) / F.avg(c).over(w)).otherwise(0.0)
    total_m, total_b = F.sum(model).over(w), F.sum(base).over(w)
    d = df.withColumns({"__cm": cv(model), "__cb": cv(base), "__sb": F.when(total_b > 0, F.col(base) * total_m / total_b).otherwise(F.col(base))})
    strong = F.col("__cm") >= F.col("__cb")
    share = F.when(F.col("__cb") < 0.08, 1.0).when(strong, 0.8).otherwise(0.7)
    d = d.withColumn("__x", share * F.col(model) + (1 - share) * F.col("__sb"))
    mean = F.avg("__x").over(w.orderBy(order).rowsBetween(-1, 1))
    part = F.when(strong, 0.1).otherwise(0.2)
    return d.withColumn(out, (1 - part) * F.col("__x") + part * mean).drop("__cm", "__cb", "__sb", "__x")


def cap_spikes(df: DataFrame, keys: list[str], day: str, x: str, out: str = "despiked", min_n: int = 10) -> DataFrame:
    """Cap by the day index's 80 % quantile (of ``min_n`` groups), twice the centred median of 3 and, on days 1-2, 2.25 times the median of the next 4.

    What is cut goes to uncut days at relative positions 0.25 to 0.80, in proportion to their value.
    """
    profile = df.groupBy(day).agg(F.percentile(x, 0.8).alias("__q"), F.count(x).alias("__n"))
    w = W.partitionBy(*keys).orderBy(day)
    near = F.array_sort(F.filter(F.array(F.lag(x).over(w), F.col(x), F.lead(x).over(w)), lambda v: v.isNotNull()))
    middle = F.get(near, F.floor(F.size(near) / 2).cast("int"))
    d = df.join(profile, day, "left").withColumns({"__m": middle, "__f": F.percentile(x, 0.5).over(w.rowsBetween(1, 4)), "__rel": F.col(day) / F.max(day).over(W.partitionBy(*keys))})
    caps = [F.when(F.col("__n") >= min_n, F.col("__q")), 2 * F.col("__m"), F.when(F.col(day) <= 2, 2.25 * F.col("__f"))]
    d = d.withColumn("__b", F.least(F.col(x), *caps))
    d = d.withColumn("__cut", F.col(x) - F.col("__b"))
    takes = (F.col("__cut") <= 0) & F.col("__rel").between(0.25, 0.80)
    base = _sum(F.when(takes, F.col(x)).otherwise(0.0), keys)
    added = F.when(takes & (base > 0), _sum("__cut", keys) * F.col(x) / base).otherwise(0.0)
    return d.withColumn(out, F.col("__b") + added).drop("__q", "__n", "__m", "__f", "__rel", "__b", "__cut")


def decay_flat_tail(df: DataFrame, keys: list[str], order: str, x: str, to: float = 0.92, tail: int = 6, out: str = "decayed") -> DataFrame:
    """Where the last rows (up to ``tail``) vary by less than 1 %, they fall linearly from 1 to ``to``; the total is kept."""
    w = W.partitionBy(*keys)
    d = df.withColumns({"__r": F.row_number().over(w.orderBy(F.desc(order))), "__k": F.least(F.count(F.lit(1)).over(w), F.lit(tail))})
    inside = F.when(F.col("__r") <= F.col("__k"), F.col(x))
    mean, sd = F.avg(inside).over(w), F.stddev_pop(inside).over(w)
    place = (F.col("__k") - F.col("__r")) / F.greatest(F.col("__k") - 1, F.lit(1))
    factor = F.when((mean > 0) & (sd / mean < 0.01) & (F.col("__r") <= F.col("__k")), 1 - (1 - to) * place).otherwise(1.0)
    d = d.withColumns({"__y": F.col(x) * factor, "__t": F.sum(x).over(w)})
    return d.withColumn(out, F.when(_sum("__y", keys) > 0, F.col("__y") * F.col("__t") / _sum("__y", keys)).otherwise(F.col("__y"))).drop("__r", "__k", "__y", "__t")


def check_level_constant(df: DataFrame, keys: list[str], x: str, limit: float = 0.01) -> DataFrame:
    """One row: part of the groups (of two rows or more) in which x is the same everywhere, and whether that is too often."""
    per = df.groupBy(*keys).agg(F.count_distinct(x).alias("d"), F.count(x).alias("n")).where("n > 1")
    return per.agg(F.avg((F.col("d") == 1).cast("double")).alias("constant_rate"), F.count(F.lit(1)).alias("n_groups")).withColumn("not_at_this_grain", F.col("constant_rate") > limit)
