"""Order statistics, ranks, running sums and slices of a long key, with no task that holds all of a column.

Values are cut into ranges at approximate quantiles (a mergeable sketch, so that one task sees the
sketches only). A count index, one row for each range, says how many rows lie before it: a quantile
then sorts the one range that holds it, a rank is its place in a range plus the range's offset, and a
running sum starts from the sum of the ranges before. Rows are reduced to distinct values first, so that
a frequent value is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import small

#: Ranges of a column, and the accuracy of the sketch that finds them.
RANGES, ACCURACY = 256, 10_000
#: How far around a wanted quantile its range is cut: some times the sketch's error.
NEAR = 4 / ACCURACY

#: Rows of a key that one task sorts; only keys of more rows are cut into slices.
KEY_ROWS = 500_000


def cut_points(x: Column, ranges: int = RANGES) -> Column:
    """Aggregate: approximate quantiles of ``x`` that part it into so many ranges (equal ones merged)."""
    return F.array_distinct(F.percentile_approx(x, F.array(*(F.lit(i / ranges) for i in range(1, ranges))), F.lit(ACCURACY)))


def range_of(x: Column, cuts: Column, ranges: int = RANGES) -> Column:
    """How many of the sorted ``cuts`` are below ``x`` (0 for null); of many cuts first by every w-th one, then between two of them."""
    if ranges <= 64:  # compiled comparisons are cheaper than a walk through the array
        return F.coalesce(sum((F.coalesce(F.get(cuts, F.lit(i)) < x, F.lit(False)).cast("int") for i in range(ranges - 1)), F.lit(0)), F.lit(0))
    w = max(1, int(ranges**0.5))
    heads = F.filter(cuts, lambda c, i: i % w == 0)
    block = F.size(F.filter(heads, lambda c: c < x))
    inside = F.filter(F.slice(cuts, (block - 1) * w + 1, w), lambda c: c < x)
    return F.when(block > 0, (block - 1) * w + F.size(inside)).otherwise(0)


def _counted(df: DataFrame, by: list[str], x: str, ranges: int) -> DataFrame:
    """``(by, x, __n, __range)``: the distinct values with their counts and ranges; ``x`` is not null."""
    counts = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count(F.lit(1)).alias("__n"))
    cuts = counts.groupBy(*by).agg(cut_points(F.col(x), ranges).alias("__cuts"))
    return _null_safe(counts, cuts, by).withColumn("__range", range_of(F.col(x), F.col("__cuts"), ranges)).drop("__cuts")


def _null_safe(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    from .joins import enrich_null_safe

    return enrich_null_safe(df, other, on, "inner") if on else df.crossJoin(F.broadcast(other))  # one row


def count_index(counted: DataFrame, by: list[str]) -> DataFrame:
    """``(by, __range, __size, __before, __total)``: rows of each range, before it, and of its group."""
    sizes = counted.groupBy(*by, "__range").agg(F.sum("__n").alias("__size"))
    group = W.partitionBy(*by)  # a row for each range
    before = F.coalesce(F.sum("__size").over(group.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return sizes.withColumns({"__before": before, "__total": F.sum("__size").over(group)})


def quantiles(df: DataFrame, by: list[str], x: str, qs: tuple[float, ...], ranges: int = 8) -> DataFrame:
    """``(by, q, n)``: exact quantiles (array, linear between neighbours) and the number of values.

    The same numbers as ``percentile``. Groups without a value are not returned; without ``by`` there
    is always one row, of nulls and 0 if there is no value. Ranges are cut close around the sketched
    quantiles, and evenly into ``ranges`` besides; rows are only counted by range, and those of the ranges
    that hold a quantile's places are sorted. ``df`` is read three times.
    """
    keys = by or ["__all"]
    base = df.select(*by, F.col(x).cast("double").alias("__x")) if by else df.select(F.lit(0).alias("__all"), F.col(x).cast("double").alias("__x"))
    base = base.where("__x is not null")
    at = sorted({min(max(q + d, 0.0), 1.0) for q in qs for d in (-NEAR, NEAR)} | {i / ranges for i in range(1, ranges)})
    cuts = F.array_distinct(F.percentile_approx("__x", F.array(*map(F.lit, at)), F.lit(ACCURACY)))
    cuts = small(base.groupBy(*keys).agg(cuts.alias("__cuts")), "cuts")
    ranged = _null_safe(base, cuts, keys).withColumn("__range", range_of(F.col("__x"), F.col("__cuts"), len(at) + 1)).drop("__cuts")
    index = count_index(ranged.withColumn("__n", F.lit(1)), keys)
    place = lambda q: (F.col("__total") - 1) * F.lit(float(q))
    wanted = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(place(q)), F.ceil(place(q))) for q in qs))))
    here = F.filter(wanted, lambda k: (k >= F.col("__before")) & (k < F.col("__before") + F.col("__size")))
    asked = small(index.withColumn("__ks", here).where(F.size("__ks") > 0).select(*keys, "__range", "__before", "__total", "__ks"), "asked")
    # the ranges that hold a wanted place; what is told of a range is the same for all its rows
    read = _null_safe(ranged, asked, [*keys, "__range"]).groupBy(*keys, "__range", "__x").agg(F.count(F.lit(1)).alias("__n"), *(F.any_value(c).alias(c) for c in ("__before", "__total", "__ks")))
    upto = F.col("__before") + F.sum("__n").over(W.partitionBy(*keys, "__range").orderBy("__x").rowsBetween(W.unboundedPreceding, 0))
    found = read.withColumn("__upto", upto).withColumn("__ks", F.filter("__ks", lambda k: (k < F.col("__upto")) & (k >= F.col("__upto") - F.col("__n")))).where(F.size("__ks") > 0)
    at = F.map_from_entries(F.flatten(F.collect_list(F.transform("__ks", lambda k: F.struct(k.alias("k"), F.col("__x").alias("x"))))))
    packed = found.groupBy(*keys).agg(at.alias("__at"), F.max("__total").alias("__total"))  # two places for each quantile

    def value(q: float) -> Column:
        low, high = F.element_at("__at", F.floor(place(q))), F.element_at("__at", F.ceil(place(q)))
        between = (F.ceil(place(q)) - place(q)) * low + (place(q) - F.floor(place(q))) * high
        return F.when(low == high, low).otherwise(between)

    out = packed.select(*by, F.array(*map(value, qs)).alias("q"), F.col("__total").alias("n"))
    # one row even for an empty table
    return out if by else out.agg(F.coalesce(F.first("q"), F.array(*(F.lit(None).cast("double") for _ in qs))).alias("q"), F.coalesce(F.first("n"), F.lit(0)).cast("long").alias("n"))


def average_ranks(df: DataFrame, by: list[str], x: str, out: str = "rank", ranges: int = RANGES) -> DataFrame:
    """``(by, x, out)``: the rank from 1 of each distinct value; equal values share the mean of theirs."""
    counted = _counted(df.select(*by, x), by, x, ranges)
    placed = _null_safe(counted, count_index(counted, by).select(*by, "__range", "__before"), [*by, "__range"])
    upto = F.col("__before") + F.sum("__n").over(W.partitionBy(*by, "__range").orderBy(x).rowsBetween(W.unboundedPreceding, 0))
    return placed.select(*by, x, (upto - (F.col("__n") - 1) / 2).alias(out))


# --- a key's rows over many tasks ---------------------------------------------------------------


def slices(df: DataFrame, by: list[str]) -> int:
    """Slices of time that the longest key's rows need: one for each ``KEY_ROWS`` of them.

    The number follows from the keys, not from the cluster: a slice costs each key a carried row, and
    with more slices for more input these would grow faster than it does.
    """
    longest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return -(-longest // KEY_ROWS) or 1


def sliced(df: DataFrame, ts: str, out: str = "__slice", n: int = 1) -> DataFrame:
    """``df`` with the slice of its ``ts`` (null: the first). Slices hold about equally many rows of the table, in order."""
    if n <= 1:
        return df.withColumn(out, F.lit(0))
    cuts = df.agg(cut_points(F.col(ts), n).alias("__cuts"))
    return df.crossJoin(F.broadcast(cuts)).withColumn(out, F.coalesce(range_of(F.col(ts), F.col("__cuts"), n), F.lit(0))).drop("__cuts")  # one row


def running_sums(df: DataFrame, by: list[str], ts: str, sums: dict[str, Column], maxima: dict[str, Column] | None = None, ties: list[str] = ()) -> DataFrame:
    """``df`` with running sums and maxima (``name``: expression) by key in order of ``ts``, then of ``ties``.

    A long key's slices are summed apart; what went before a slice enters it as a row of its own. Null values
    add nothing to a sum; a maximum is null until there is a value.
    """
    maxima = maxima or {}
    fold = {n: F.sum for n in sums} | {n: F.max for n in maxima}
    n = slices(df, by)
    if n == 1:
        w = W.partitionBy(*by).orderBy(ts, *ties).rowsBetween(W.unboundedPreceding, 0)
        return df.select("*", *(F.sum(F.coalesce(c, F.lit(0))).over(w).alias(k) for k, c in sums.items()), *(F.max(c).over(w).alias(k) for k, c in maxima.items()))
    cut = sliced(df, ts, n=n).withColumns({f"__v_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()} | {f"__v_{n}": c for n, c in maxima.items()})
    totals = cut.groupBy(*by, "__slice").agg(*(f(f"__v_{n}").alias(f"__v_{n}") for n, f in fold.items()))
    earlier = W.partitionBy(*by).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)  # a row for each slice
    carried = totals.select(*by, "__slice", *(f(f"__v_{n}").over(earlier).alias(f"__v_{n}") for n, f in fold.items()), F.lit(0).alias("__own"))
    both = cut.withColumn("__own", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    w = W.partitionBy(*by, "__slice").orderBy("__own", ts, *ties).rowsBetween(W.unboundedPreceding, 0)
    return both.withColumns({n: f(f"__v_{n}").over(w) for n, f in fold.items()}).where("__own = 1").select(*df.columns, *fold)
