"""Top-down reconciliation of a hierarchy with observed cells (total, day, grade, finish)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import written

#: Rows of a level that one task groups or shares out.
TASK_ROWS = 250_000


def _typed(other: DataFrame, like: DataFrame, keys: list[str]) -> list[Column]:
    """The keys of ``other`` in the types of ``like``."""
    return [F.col(k).cast(like.schema[k].dataType).alias(k) for k in keys]


def _handed_down(rows: DataFrame, parents: DataFrame, keys: list[str], x: str, n: int) -> DataFrame:
    """``rows``, in ``n`` partitions by ``keys``, with ``x`` of the parents' row of the same keys (unique; null keys are equal)."""
    both = rows.withColumn("__own", F.lit(True)).unionByName(parents.select(*_typed(parents, rows, keys), x), allowMissingColumns=True)
    dealt = both.repartition(n, *keys) if keys else both
    return dealt.withColumn(x, F.max(x).over(W.partitionBy(*keys))).where("__own").drop("__own")


def reconcile_hierarchy(leaves: DataFrame, levels: list[list[str]], plan: str, observed: list[tuple[DataFrame, str] | None], out: str = "value") -> DataFrame:
    """The finest level's rows with ``out``, which adds up at every level and keeps what was observed.

    ``levels``: keys from the coarsest to the finest, each with those before it; ``leaves``: the finest
    level with the column ``plan``; ``observed``: for each level None, or a table with the level's keys
    (unique) and the column of observed values, null where there is none.

    From below, every cell gets a floor: what was observed of it, else its children's floors. From
    above, a cell's amount (the coarsest: observed, else the plan, at least the floor) goes first to the
    observed children and to the floors of the others, and what remains to those others by plan (evenly
    where they have none). Where the observed children exceed or are all of the cell, they are scaled to
    it. Each level is grouped by its own keys, so that no group is larger than a cell's children, and
    written once; the partitions follow the number of leaves.
    """
    spark = leaves.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // TASK_ROWS))
    # plan and floor of every level, from below
    tables: list[DataFrame] = []
    below: DataFrame | None = None
    for keys, seen in reversed([*zip(levels, observed, strict=True)]):
        source = leaves.withColumn("__floor", F.lit(0.0)).withColumn("__plan", F.coalesce(F.col(plan), F.lit(0.0))) if below is None else below
        # observed cells enter as rows of their own, so that cells and observations take one shuffle
        cells = source.select(*keys, "__plan", "__floor", F.lit(True).alias("__own"))
        if seen is not None:
            own = seen[0].select(*_typed(seen[0], cells, keys), F.col(seen[1]).cast("double").alias("__seen"))
            cells = cells.unionByName(own, allowMissingColumns=True)
        else:
            cells = cells.withColumn("__seen", F.lit(None).cast("double"))
        dealt = cells.repartition(n, *keys) if keys else cells
        level = dealt.groupBy(*keys).agg(F.sum("__plan").alias("__plan"), F.sum("__floor").alias("__floor"), F.max("__seen").alias("__seen"), F.max("__own").alias("__own")).where("__own").drop("__own")
        below = written(level.withColumn("__floor", F.coalesce("__seen", "__floor")), "level")
        tables.append(below)
    tables.reverse()
    now = tables[0].withColumn("__value", F.coalesce("__seen", F.greatest("__plan", "__floor")))
    for parent, keys, table in zip(levels[:-1], levels[1:], tables[1:], strict=True):
        w = W.partitionBy(*parent)
        d = _handed_down(table, now.select(*parent, F.col("__value").alias("__total")), parent, "__total", n)
        free = F.col("__seen").isNull()
        left = F.col("__total") - F.sum("__floor").over(w)
        mass, places = F.sum(F.when(free, F.col("__plan")).otherwise(0.0)).over(w), F.sum(free.cast("double")).over(w)
        share = F.when(mass > 0, F.col("__plan") / mass).otherwise(1 / places)
        first = F.col("__floor") + F.when(free, F.greatest(left, F.lit(0.0)) * share).otherwise(0.0)
        d = d.withColumn("__first", first).withColumn("__sum", F.sum("__first").over(w)).withColumn("__places", F.count(F.lit(1)).over(w))
        # nothing to scale: the amount is shared evenly, so that the level still adds up
        now = d.withColumn("__value", F.when(F.col("__sum") > 0, F.col("__first") * F.col("__total") / F.col("__sum")).otherwise(F.col("__total") / F.col("__places"))).select(*keys, "__value")
        now = written(now, "amounts")
    return _handed_down(leaves, now.select(*levels[-1], F.col("__value").alias(out)), levels[-1], out, n)
