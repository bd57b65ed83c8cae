"""Audits that are taken while a table is written, in the same job (AU1, AU5, AU11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .checks import CHECK_COLUMNS


def write_audited(df: DataFrame, path: str, source: str, keys: list[str], ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Write ``df`` and return its checks (the rows of ``check_unique``, ``check_ranges`` and a filled check).

    Rows are dealt by key (which also clusters the files); repeats of a key are numbered there and counted
    with all else by ``observe`` in the stage that writes, so that the table is scanned once. A task that
    fails adds nothing: only the partitions that were written count.
    """
    ranges = ranges or {}
    seen = Observation()
    number = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(0)))
    outside = {f"out_{i}": F.coalesce((~F.col(c).between(lo, hi)).cast("long"), F.lit(0)) for i, (c, (lo, hi)) in enumerate(ranges.items())}
    metrics = [F.count(F.lit(1)).alias("n"), F.sum((F.col("__number") > 1).cast("long")).alias("repeats")]
    metrics += [F.sum(e).alias(name) for name, e in outside.items()] + [F.count(c).alias(f"known_{i}") for i, c in enumerate(ranges)]
    df.withColumn("__number", number).observe(seen, *metrics).drop("__number").write.parquet(path)
    got = seen.get
    part = lambda a, b: (a or 0) / b if b else 0.0
    rows = [("AU1_unique", "", part(got["repeats"], got["n"]), 0.0)]
    rows += [("AU5_range", c, part(got[f"out_{i}"], got[f"known_{i}"]), 0.0) for i, c in enumerate(ranges)]
    rows += [("AU11_filled", "", float(got["n"] > 0), 1.0)]
    out = [(check, source, key, "PASS" if value == expected else "FAIL", float(value), expected, 0.0, "") for check, key, value, expected in rows]
    return df.sparkSession.createDataFrame(out, ", ".join(f"{c} {'double' if c in ('value', 'expected', 'tolerance') else 'string'}" for c in CHECK_COLUMNS))
