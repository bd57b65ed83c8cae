"""Grain, filters, deduplication and patches (FL1-FL3, AG8, WN10-WN12, WN14, JN14, SO1-SO5, ST1-ST3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def filter_valid(df: DataFrame, not_null: list[str] = (), positive: list[str] = (), since: tuple[str, str] | None = None, between: dict | None = None, isin: dict | None = None, contains: dict | None = None) -> DataFrame:
    """Domain filters in one predicate, which reaches the scan."""
    tests = [F.col(c).isNotNull() for c in not_null] + [F.col(c) > 0 for c in positive]
    tests += [F.col(since[0]) >= F.lit(since[1]).cast("timestamp")] if since else []
    tests += [F.col(c).between(lo, hi) for c, (lo, hi) in (between or {}).items()]
    tests += [F.col(c).isin(list(v)) for c, v in (isin or {}).items()] + [F.col(c).contains(v) for c, v in (contains or {}).items()]
    return df.where(reduce(Column.__and__, tests)) if tests else df


def exclude_implausible(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows whose value lies strictly inside (lo, hi)."""
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def prefer_in_group(df: DataFrame, keys: list[str], predicate: Column) -> DataFrame:
    """In groups where any row satisfies the predicate, only those rows; all rows of the others."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumn("__hit", hit).withColumn("__any", F.max("__hit").over(W.partitionBy(*keys))).where("__hit or not __any").drop("__hit", "__any")


def dedup(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a total order. Aggregates before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    parts = [F.col(o) if isinstance(o, str) else o for o in order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*(p.alias(f"o{i}") for i, p in enumerate(parts)))).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def last_row(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest order value of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str = "occurrence") -> DataFrame:
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def flag_any(df: DataFrame, keys: list[str], predicate: Column, out: str = "any_flag") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.max(predicate).over(W.partitionBy(*keys)), F.lit(False)))


def collapse(df: DataFrame, keys: list[str], how: dict[str, str]) -> DataFrame:
    """Restore the grain: ``sum``, ``avg``, ``median``, ``min`` or ``max`` by column."""
    return df.groupBy(*keys).agg(*(getattr(F, f)(c).alias(c) for c, f in how.items()))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, if its keys are unique; raises otherwise."""
    bad = duplicate_keys(df, keys).limit(3).collect()
    if bad:
        raise ValueError(f"keys {keys} repeat: {bad}")
    return df


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Stack by name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def missing_keys(want: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    """Keys of ``want`` that ``have`` lacks."""
    return want.select(*on).distinct().join(have.select(*on).distinct(), on, "left_anti")


def shared_keys(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.select(*on).intersect(b.select(*on))


def patch_column(master: DataFrame, patch: DataFrame, on: list[str], col: str, condition: Column) -> tuple[DataFrame, DataFrame]:
    """A new version of ``master`` with ``col`` replaced where the condition holds, and the change report.

    ``patch`` is unique by ``on``; the condition may use master's columns and ``new_value``.
    """
    joined = master.join(patch.select(*on, F.col(col).alias("new_value")), on, "left").withColumn("__change", F.coalesce(condition & F.col("new_value").isNotNull(), F.lit(False)))
    report = joined.where("__change").select(*on, F.col(col).alias("old_value"), "new_value")
    return joined.withColumn(col, F.when(F.col("__change"), F.col("new_value")).otherwise(F.col(col))).select(*master.columns), report


def sorted_output(df: DataFrame, keys: list[str]) -> DataFrame:
    """Order inside each written file; no global sort."""
    return df.sortWithinPartitions(*keys)


def top_k(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first n rows in an order, for a diagnostic."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """About ``share`` of the keys, the same in every run and on every partitioning; all rows of a key or none."""
    digest = F.substring(F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))), 1, 8)
    return df if share >= 1 else df.where(digest < f"{-int(-share * 2**32 // 1):08x}")
