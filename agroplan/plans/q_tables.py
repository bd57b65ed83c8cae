"""Queries for sources, sheets, key operations, event rows and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggs, checks, grain, grids, joins, windows
from ..sources import sheets, tables
from .base import DAILY, LINES, daily, lines, long, r6, table
from .registry import query


@query("sc1_read_table", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def sc1(spark, sf):
    return tables.read_table(spark, f"{sf}/nation.parquet").select(long("n_nationkey"), "n_name", long("n_regionkey"))


@query("sc2_write_table", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def sc2(spark, sf):
    """Written by segment to the folder that all machines share, and read back."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{where.rstrip('/')}/customers-{uuid.uuid4().hex}"
    tables.write_table(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), path, ["c_mktsegment"])
    return tables.read_table(spark, path)


@query("sc6_stamp", "SELECT s_suppkey, 'supplier' AS source_name, true AS stamped FROM supplier")
def sc6(spark, sf):
    return tables.stamp(table(spark, sf, "supplier"), "supplier").select("s_suppkey", "source_name", F.col("extracted_at").isNotNull().alias("stamped"))


@query("sc8_first_available", "SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def sc8(spark, sf):
    return tables.first_available(spark, [f"{sf}/missing.parquet", f"{sf}/region.parquet", f"{sf}/nation.parquet"]).select(long("r_regionkey"), "r_name")


@query("sc10_literal_dim", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 END::BIGINT AS rank FROM orders")
def sc10(spark, sf):
    dim = tables.literal_dim(spark, [("1-URGENT", 3), ("2-HIGH", 2)], "o_orderpriority string, rank long")
    return joins.enrich(table(spark, sf, "orders"), dim, ["o_orderpriority"]).select("o_orderkey", "rank")


@query("sh1_sh2_sh4_sheet", "SELECT s_suppkey::DOUBLE AS code, s_name AS name, s_nationkey::DOUBLE AS name__2, round(s_acctbal, 2) AS col FROM supplier")
def sh124(spark, sf):
    """The suppliers as a sheet of text cells: a title, a header row, then the rows."""
    s = table(spark, sf, "supplier")
    rows = s.select((F.col("s_suppkey") + 100).alias("row"), F.col("s_suppkey").cast("string").alias("a"), F.col("s_name").alias("b"), F.col("s_nationkey").cast("string").alias("c"), F.round("s_acctbal", 2).cast("decimal(20,2)").cast("string").alias("d"))
    top = spark.createDataFrame([(1, "Suppliers", None, None, None), (2, " code ", "name", "name", " ")], "row long, a string, b string, c string, d string")
    sheet = sheets.promote_header(top.unionByName(rows), "row", ["code", "name"])
    return sheets.coerce_columns(sheet.drop("row"), ["name"]).select("code", "name", "name__2", "col")


@query("pj8_coalesce_cols", "SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, c_nationkey)::DOUBLE AS v FROM customer")
def pj8(spark, sf):
    c = table(spark, sf, "customer").withColumn("Balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return C.coalesce_cols(c, "v", ["nowhere", "BALANCE", "c_nationkey"]).select("c_custkey", F.col("v").cast("double").alias("v"))


@query("jn1_left_enrich", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000")
def jn1(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.enrich(table(spark, sf, "orders"), c, ["o_custkey"]).select("o_orderkey", "c_name")


@query("jn2_inner_enrich", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def jn2(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.enrich(table(spark, sf, "orders"), c, ["o_custkey"], "inner").select("o_orderkey", "c_name")


@query("jn10_asof_climate", """WITH h AS (SELECT event_type AS station, ts::DATE AS day, sum(abs(value)) AS rain FROM events GROUP BY 1, 2), b AS (SELECT station, min(day) + 3 AS a FROM h GROUP BY 1), e AS (SELECT station, a, a + o AS "asof" FROM b, (SELECT unnest([0, 5, 12, 30]) AS o)),
j AS (SELECT e.station, e."asof", rain, row_number() OVER (PARTITION BY e.station, e."asof" ORDER BY day DESC) AS n FROM e LEFT JOIN h ON e.station = h.station AND day BETWEEN a AND e."asof")
SELECT station, "asof", count(rain) AS n_rows, round(coalesce(sum(rain), 0), 4) AS rain_since, round(coalesce(sum(rain) FILTER (n <= 7), 0), 4) AS rain_last7 FROM j GROUP BY 1, 2""")
def jn10(spark, sf):
    h = table(spark, sf, "events").groupBy(F.col("event_type").alias("station"), F.to_date("ts").alias("day")).agg(F.sum(F.abs("value")).alias("rain"))
    e = h.groupBy("station").agg(F.date_add(F.min("day"), 3).alias("a")).withColumn("asof", F.explode(F.array(*(F.date_add("a", o) for o in (0, 5, 12, 30)))))
    out = windows.asof_snapshot(h, e, ["station"], "day", "a", "asof", ["rain"])
    return out.select("station", "asof", long("n_rows"), F.round("rain_since", 4).alias("rain_since"), F.round("rain_last7", 4).alias("rain_last7"))


@query("ag7_distinct_count", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def ag7(spark, sf):
    return aggs.rollup_by(table(spark, sf, "lineitem"), ["l_returnflag"], {"suppliers": ("count_distinct", "l_suppkey"), "parts": ("count_distinct", "l_partkey")})


@query("st1_sorted_output", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders")
def st1(spark, sf):
    return grain.sorted_output(table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey", "o_orderdate"])


@query("st3_limit", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 40")
def st3a(spark, sf):
    """A diagnostic of the 40 dearest lines: the limit is the feature."""
    return grain.first_rows(table(spark, sf, "lineitem"), [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 40).select("l_orderkey", long("l_linenumber"), "l_extendedprice")


@query("st3_sample", "SELECT o_orderkey, o_custkey FROM orders WHERE substr(md5(o_orderkey::VARCHAR), 1, 8) < '1999999a'")
def st3b(spark, sf):
    """A repeatable sample of a tenth of the orders: sampling is the feature."""
    return grain.sample_rows(table(spark, sf, "orders"), ["o_orderkey"], 0.1).select("o_orderkey", "o_custkey")


@query("so2_distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def so2(spark, sf):
    return grain.distinct_keys(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query("gr7_event_rows", """SELECT 'ORDER' AS stage, o_orderkey AS k, round(greatest(1000, least(200000, o_totalprice)), 4) AS target_price, 2.0::DOUBLE AS mask_price, CASE WHEN o_orderstatus = 'F' THEN 1.0 END::DOUBLE AS target_done, CASE WHEN o_orderstatus = 'F' THEN 2.0 ELSE 0 END::DOUBLE AS mask_done FROM orders
UNION ALL SELECT 'CUSTOMER', c_custkey, round(greatest(0, least(5000, c_acctbal)), 4), 1.0, NULL, NULL FROM customer""")
def gr7(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.when(F.col("o_orderstatus") == "F", 1.0).alias("done"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    parts = [grids.event_rows(o, "ORDER", ["k"], {"price": (F.col("o_totalprice"), 1000, 200000), "done": (F.col("done"), 0, 1)}, F.lit(2.0)), grids.event_rows(c, "CUSTOMER", ["k"], {"price": (F.col("c_acctbal"), 0, 5000)}, F.lit(1.0))]
    out = grain.union_all(parts)
    return out.select("stage", "k", *(F.round(F.col(x).cast("double"), 4).alias(x) for x in ("target_price", "mask_price", "target_done", "mask_done")))


AUDIT = """'{0}' AS check_id, '{1}' AS source, '{2}' AS key, CASE WHEN abs(v) <= 0 THEN 'PASS' ELSE 'FAIL' END AS status, round(v, 6) AS value, 0.0::DOUBLE AS expected, 0.0::DOUBLE AS tolerance, '' AS details"""


def _rounded(df):
    return df.withColumn("value", r6("value"))


@query("au7_dates", "WITH " + LINES + ", m AS (SELECT ciclo, min(fecha) - (ciclo % 7)::INT AS m, min(fecha) AS r FROM l GROUP BY 1) SELECT " + AUDIT.format("AU7_dates", "cycles", "") + " FROM (SELECT (count(*) FILTER (m - r < -3))::DOUBLE AS v FROM m)")
def au7(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    model = l.groupBy("ciclo").agg(F.min("fecha").alias("m")).withColumn("m", F.date_sub("m", (F.col("ciclo") % 7).cast("int")))
    return _rounded(checks.check_dates(model, l, ["ciclo"], "m", "fecha", "cycles"))


@query("au8_identity", "WITH " + LINES + ", i AS (SELECT CASE WHEN a IS NULL AND b IS NULL THEN false ELSE coalesce(abs(a - b) > 1e-6, true) END AS bad FROM (SELECT CASE WHEN grado < 7 THEN peso / tallos END AS a, CASE WHEN grado < 6 THEN peso / tallos + CASE WHEN parte % 5 = 0 THEN 0.5 ELSE 0 END END AS b FROM l)) SELECT " + AUDIT.format("AU8_identity", "lineitem", "price") + " FROM (SELECT avg(bad::INT) AS v FROM i)")
def au8(spark, sf):
    price = F.col("peso") / F.col("tallos")
    other = F.when(F.col("grado") < 6, price + F.when(F.col("parte") % 5 == 0, 0.5).otherwise(0.0))
    return _rounded(checks.check_identity(lines(spark, sf), F.when(F.col("grado") < 7, price), other, "lineitem", "price"))


@query("au11_output_contract", " UNION ALL ".join(f"SELECT '{t}' AS output, count(*) > 0 AS filled FROM {t}" for t in ("orders", "lineitem", "events")) + " UNION ALL SELECT 'none', count(*) > 0 FROM orders WHERE o_totalprice < 0")
def au11(spark, sf):
    outputs = {t: table(spark, sf, t) for t in ("orders", "lineitem", "events")} | {"none": table(spark, sf, "orders").where("o_totalprice < 0")}
    return checks.output_contract(outputs)


@query("au2_au4_audits", "WITH " + DAILY + """, s AS (SELECT ciclo, round(x / sum(x) OVER (PARTITION BY ciclo), 3) AS share FROM d), a AS (SELECT avg((abs(t - 1) > 0.002)::INT) AS v FROM (SELECT sum(share) AS t FROM s GROUP BY ciclo)),
c AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders), h AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS c FROM lineitem GROUP BY 1), j AS (SELECT coalesce(c, 0) AS c, coalesce(p, 0) AS p FROM h FULL JOIN c ON h.k = c.k), b AS (SELECT (count(*) FILTER (abs(c - p) > greatest(1e-3, 1e-5 * abs(p))))::DOUBLE AS v FROM j)
SELECT """ + AUDIT.format("AU2_share_sum", "daily", "") + " FROM a UNION ALL SELECT " + AUDIT.format("AU4_mass_balance", "lineitem", "") + " FROM b")
def au24(spark, sf):
    shares = windows.share_within(daily(spark, sf), ["ciclo"], "x").withColumn("share", F.round("share", 3))
    child = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k")
    parent = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    parts = [checks.check_share_sum(shares, ["ciclo"], "share", "daily", 0.002), checks.check_mass_balance(child, parent, ["k"], "l_extendedprice", "o_totalprice", "lineitem")]
    return _rounded(checks.all_checks(parts)).withColumn("details", F.lit(""))
