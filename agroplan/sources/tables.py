"""Reading and writing tables (SC1-SC10)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import week_key


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a table; with partitions, only those that occur in ``df``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_jdbc_since(spark: SparkSession, options: dict, table: str, ts_col: str, since: str, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Rows of a relational table from ``since`` on; the bound is pushed to the source.

    ``partition``: (numeric column, lower, upper, number of readers).
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition:
        col, lower, upper, n = partition
        reader = reader.option("partitionColumn", col).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", n)
    return reader.load().where(F.col(ts_col) >= F.lit(since).cast("timestamp"))


def select_existing(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """The wanted columns with their types; missing ones are null; names match case-insensitively."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*((F.col(f"`{have[c.lower()]}`").try_cast(t) if c.lower() in have else F.lit(None).cast(t)).alias(c) for c, t in wanted.items()))


def semi_filter(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def stamp(df: DataFrame, source: str, time_col: str = "extracted_at") -> DataFrame:
    return df.withColumns({"source_name": F.lit(source), time_col: F.current_timestamp()})


def latest_version(df: DataFrame, version_col: str) -> DataFrame:
    """The rows of the largest version; on a partition column this prunes to one partition."""
    top = df.agg(F.max(version_col).alias(version_col))
    return df.join(F.broadcast(top), version_col, "left_semi")  # one row


def first_available(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of the candidate tables that exists."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {paths}")


def calendar_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day: names, ISO week, Sunday-0 weekday, YYWW keys."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS day")
    return days.select(
        "day", F.year("day").alias("year"), F.month("day").alias("month"), F.date_format("day", "MMMM").alias("month_name"), F.date_format("day", "EEEE").alias("day_name"),
        F.weekofyear("day").alias("iso_week"), (F.dayofweek("day") - 1).alias("weekday_sunday0"), week_key("day", "iso").alias("yyww"), week_key("day", "yyww_mixed").alias("yyww_mixed"),
    )


def literal_dim(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant dimension; its few rows are given in code."""
    return F.broadcast(spark.createDataFrame(rows, schema))
