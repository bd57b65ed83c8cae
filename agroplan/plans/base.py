"""Shared frames of the registered queries: the driver's tables in the roles of the domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str, name: str | None = None) -> Column:
    """Rounded to 6 places, under its own or a new name."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), 6)
    return out.alias(name or c)


def long(c: Column | str, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("long").alias(name or c)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycle, day, grade, finish, variety, stems and weight of every line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ciclo"), F.to_date("l_shipdate").alias("fecha"), F.col("l_linenumber").alias("grado"), F.col("l_returnflag").alias("destino"), F.col("l_linestatus").alias("variedad"),
        F.col("l_quantity").alias("tallos"), F.col("l_extendedprice").alias("peso"), F.col("l_discount").alias("desc"), F.col("l_orderkey").alias("pedido"), F.col("l_partkey").alias("parte"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).groupBy("ciclo", "fecha").agg(F.sum("tallos").alias("x"), F.sum("peso").alias("w"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station, hour and the mean value of the hour."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("station"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value"))


LINES = """l AS (SELECT l_suppkey AS ciclo, CAST(l_shipdate AS DATE) AS fecha, l_linenumber AS grado, l_returnflag AS destino, l_linestatus AS variedad,
  l_quantity AS tallos, l_extendedprice AS peso, l_discount AS "desc", l_orderkey AS pedido, l_partkey AS parte FROM lineitem)"""
DAILY = LINES + ", d AS (SELECT ciclo, fecha, sum(tallos) AS x, sum(peso) AS w FROM l GROUP BY ciclo, fecha)"
HOURLY = "h AS (SELECT event_type AS station, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"
