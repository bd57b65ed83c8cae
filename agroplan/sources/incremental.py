"""Incremental extracts of relational tables: high-water marks, partitioned reads, merges by key (SC3).

The state of a source is a folder of versions. A run reads the rows since the mark (less the lateness
allowed for), merges them with the last version by key and writes a new version, then a mark that names
it. A run that dies before its mark leaves the state as it was; the mark with the largest number counts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "number long, mark timestamp, version string"


def jdbc_source(spark: SparkSession, options: dict, table: str, partition_col: str | None = None, readers: int = 8) -> Callable[[Column], DataFrame]:
    """A reader ``read(condition)`` of a relational table; the condition goes to the source.

    With a numeric ``partition_col`` so many tasks read ranges of it; its bounds come from one query that
    the source answers.
    """

    def reader(source: str):
        return spark.read.format("jdbc").options(**options).option("dbtable", source)

    def read(condition: Column) -> DataFrame:
        one = reader(table)
        if partition_col:
            low, high = reader(f"(SELECT MIN({partition_col}) AS lo, MAX({partition_col}) AS hi FROM {table}) bounds").load().first()
            if low is not None and high > low:
                one = one.option("partitionColumn", partition_col).option("lowerBound", int(low)).option("upperBound", int(high) + 1).option("numPartitions", readers)
        return one.load().where(condition)

    return read


def last_mark(spark: SparkSession, state: str) -> tuple[int, dt.datetime | None, str | None]:
    """Number, high-water mark and version path of the last run that ended; (0, None, None) before the first."""
    try:
        row = spark.read.schema(MARKS).parquet(f"{state}/marks").orderBy(F.desc("number")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    return (row["number"], row["mark"], row["version"]) if row else (0, None, None)


def merge_latest(old: DataFrame | None, new: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """One row for each key: the one of the latest ``ts_col``, of equal ones the newly read; null keys are keys."""
    rows = new.withColumn("__new", F.lit(1))
    if old is not None:
        rows = rows.unionByName(old.withColumn("__new", F.lit(0)))
    best = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.max_by(F.struct(*new.columns), F.struct(F.col(ts_col), F.col("__new"))).alias("__r"))
    return best.select("__r.*")


def extract_increment(spark: SparkSession, read: Callable[[Column], DataFrame], state: str, keys: list[str], ts_col: str, since: str, lateness_days: int = 7) -> DataFrame:
    """The whole table after one more run: what was known, with the rows of the source since the mark.

    ``ts_col`` is when a row was made or changed. Rows that reach the source up to ``lateness_days`` after
    their time are found by reading that far back; reading a row again changes nothing. Rows without a
    time are not read. An empty increment keeps the version and the mark.
    """
    number, mark, version = last_mark(spark, state)
    start = F.lit(since).cast("timestamp") if mark is None else F.lit(mark) - F.expr(f"INTERVAL {int(lateness_days)} DAYS")
    new = read(F.col(ts_col).cast("timestamp") >= start)
    old = spark.read.parquet(version) if version else None
    path = f"{state}/version-{uuid.uuid4().hex}"
    merge_latest(old, new, keys, ts_col).write.parquet(path)
    merged = spark.read.parquet(path)
    top = merged.agg(F.max(F.col(ts_col).cast("timestamp"))).first()[0]
    if top is not None:
        spark.createDataFrame([(number + 1, top, path)], MARKS).write.mode("append").parquet(f"{state}/marks")
    return merged
