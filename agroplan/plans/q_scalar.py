"""Queries for sources, scalar expressions, filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import grain
from ..sources import sheets, tables
from .base import LINES, lines, long, r6, table
from .registry import query


@query("sc4_select_existing", "SELECT n_nationkey::BIGINT AS N_NATIONKEY, n_name AS N_NAME, CAST(NULL AS DOUBLE) AS area FROM nation")
def sc4(spark, sf):
    return tables.select_existing(table(spark, sf, "nation"), {"N_NATIONKEY": "long", "N_NAME": "string", "area": "double"})


@query("sc5_semi_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def sc5(spark, sf):
    keys = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return tables.semi_filter(table(spark, sf, "orders"), keys, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("sc7_latest_version", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def sc7(spark, sf):
    return tables.latest_version(table(spark, sf, "lineitem"), "l_shipdate").select("l_orderkey", long("l_linenumber"))


@query("sc9_order_calendar", """
WITH b AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS z FROM orders),
d AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS day FROM b),
o AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT d.day, year(d.day)::BIGINT AS year, dayname(d.day) AS day_name, week(d.day)::BIGINT AS iso_week, dayofweek(d.day)::BIGINT AS weekday_sunday0,
  ((isoyear(d.day) % 100) * 100 + week(d.day))::BIGINT AS yyww, ((year(d.day) % 100) * 100 + week(d.day))::BIGINT AS yyww_mixed, coalesce(n, 0) AS n
FROM d LEFT JOIN o ON d.day = o.day""")
def sc9(spark, sf):
    orders = table(spark, sf, "orders")
    a, z = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    n = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    cal = tables.calendar_dim(spark, str(a), str(z)).join(n, "day", "left").fillna(0, ["n"])
    return cal.select("day", long("year"), "day_name", long("iso_week"), long("weekday_sunday0"), long("yyww"), long("yyww_mixed"), "n")


@query("sh3_unpivot_dates", """
SELECT o_orderpriority AS id, make_date(year(o_orderdate)::INT, month(o_orderdate)::INT, 1) AS day, round(sum(o_totalprice), 2) AS value
FROM orders GROUP BY 1, 2""")
def sh3(spark, sf):
    o = table(spark, sf, "orders").withColumn("m", F.date_format("o_orderdate", "yyyy-MM-'01'"))
    a, z = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    months = [f"{k // 12}-{k % 12 + 1:02d}-01" for k in range(a.year * 12 + a.month - 1, z.year * 12 + z.month)]  # one column per month of the table
    wide = o.groupBy(F.col("o_orderpriority").alias("id")).pivot("m", months).agg(F.sum("o_totalprice").cast("decimal(20,2)").cast("string"))
    return sheets.unpivot_dates(wide, ["id"]).where("value is not null").select("id", "day", F.round("value", 2).alias("value"))


@query("sh5_exclude_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def sh5(spark, sf):
    return sheets.exclude_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("pj1_canon_str", "SELECT p_partkey, upper(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS name FROM part")
def pj1(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.canon_str("p_name").alias("name"))


@query("pj2_to_num", "SELECT c_custkey, round(c_acctbal, 2) AS v FROM customer")
def pj2(spark, sf):
    text = F.regexp_replace(F.format_string(" %s ", F.round("c_acctbal", 2).cast("decimal(20,2)").cast("string")), r"\.", ",")
    return table(spark, sf, "customer").select("c_custkey", F.round(C.to_num(text), 2).alias("v"))


@query("pj3_extract_int", "SELECT c_custkey, TRY_CAST(nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS BIGINT) AS first_int, TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT) AS all_digits FROM customer")
def pj3(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", C.extract_int("c_name").alias("first_int"), C.extract_int("c_name", "all").alias("all_digits"))


@query("pj4_map_values", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE l_returnflag WHEN 'A' THEN 'BLANCO' WHEN 'R' THEN 'TINTURADO' ELSE l_returnflag END AS destino FROM lineitem")
def pj4(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", long("l_linenumber"), C.map_values("l_returnflag", {"A": "BLANCO", "R": "TINTURADO"}).alias("destino"))


@query("pj5_classify", "SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice <= 200000 THEN 'mid' ELSE 'high' END AS class FROM orders")
def pj5(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.classify([(F.col("o_totalprice") < 50000, "low"), (F.col("o_totalprice") <= 200000, "mid")], "high").alias("class"))


@query("pj6_pj7_ratio_clip", "SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN round(least(greatest(1000 / s_acctbal, 0.1), 2.0), 6) END AS v FROM supplier")
def pj67(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", r6(C.clip(C.safe_div(F.lit(1000.0), "s_acctbal"), 0.1, 2.0), "v"))


@query("pj9_pj10_calendar_keys", """
SELECT o_orderkey, (isodow(o_orderdate) - 1)::BIGINT AS dow, month(o_orderdate)::BIGINT AS month, week(o_orderdate)::BIGINT AS week, dayofyear(o_orderdate)::BIGINT AS doy,
  ((isoyear(o_orderdate) % 100) * 100 + week(o_orderdate))::BIGINT AS iso_key, greatest(strftime(o_orderdate, '%U')::BIGINT, 1) AS sunday_week,
  ((year(o_orderdate - INTERVAL 2 DAY) % 100) * 100 + week(o_orderdate - INTERVAL 2 DAY))::BIGINT AS shifted FROM orders""")
def pj910(spark, sf):
    o = C.add_calendar(table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate")), "d")
    return o.select("o_orderkey", long("dow"), long("month"), long("week"), long("doy"), long(C.week_key("d"), "iso_key"), long(C.week_key("d", "sunday"), "sunday_week"), long(C.week_key("d", "yyww_mixed", -2), "shifted"))


@query("pj11_pj12_days", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) + 1 AS days, date_trunc('hour', l_shipdate) AS h FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def pj1112(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", long("l_linenumber"), long(C.days_between("o_orderdate", "l_shipdate", True), "days"), C.trunc_ts("l_shipdate").alias("h"))


@query("pj13_pj16_units", "SELECT event_id, round(abs(value) / 10, 6) AS boxes, round(greatest(value - 7.1, 0), 6) AS gdc, round(ln((abs(value) + 1 + 1e-6) / (2 + 1e-6)), 6) AS log_corr, round(1 + CASE WHEN abs(value) > 3.5 THEN value / 100 ELSE value END, 6) AS factor FROM events")
def pj1316(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select("event_id", r6(C.to_boxes(F.abs(v)), "boxes"), r6(C.degree_day(v), "gdc"), r6(C.encode_corr(F.abs(v) + 1, F.lit(2.0)), "log_corr"), r6(C.factor_from_pct(v), "factor"))


@query("pj17_content_id", "SELECT c_custkey, sha1(c_name || '|' || c_mktsegment || '|' || c_nationkey) AS id FROM customer")
def pj17(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", C.content_id("c_name", "c_mktsegment", "c_nationkey").alias("id"))


@query("pj18_infer_unit", "SELECT p_partkey, round(p_retailprice * CASE WHEN (SELECT median(p_retailprice) FROM part) > 500 THEN 0.001 ELSE 1 END, 6) AS kg FROM part")
def pj18(spark, sf):
    return C.infer_unit(table(spark, sf, "part"), "p_retailprice", 500.0).select("p_partkey", r6("p_retailprice", "kg"))


@query("fl1_filter_valid", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_quantity BETWEEN 5 AND 20 AND l_returnflag IN ('A', 'N') AND l_discount > 0")
def fl1(spark, sf):
    kept = grain.filter_valid(table(spark, sf, "lineitem"), ["l_shipdate"], ["l_discount"], ("l_shipdate", "1995-01-01"), {"l_quantity": (5, 20)}, {"l_returnflag": ["A", "N"]})
    return kept.select("l_orderkey", long("l_linenumber"))


@query("fl2_prefer_in_group", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag FROM (SELECT *, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS a FROM lineitem) WHERE l_returnflag = 'R' OR NOT a")
def fl2(spark, sf):
    return grain.prefer_in_group(table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R").select("l_orderkey", long("l_linenumber"), "l_returnflag")


@query("fl3_exclude_implausible", "SELECT event_id FROM events WHERE value > 10 AND value < 100")
def fl3(spark, sf):
    return grain.exclude_implausible(table(spark, sf, "events"), "value", 10, 100).select("event_id")


@query("wn11_dedup", "SELECT ciclo, fecha, grado::BIGINT AS grado, pedido FROM (WITH " + LINES + " SELECT *, row_number() OVER (PARTITION BY ciclo, fecha ORDER BY peso DESC, pedido, grado) AS n FROM l) WHERE n = 1")
def wn11(spark, sf):
    return grain.dedup(lines(spark, sf), ["ciclo", "fecha"], [-F.col("peso"), "pedido", "grado"]).select("ciclo", "fecha", long("grado"), "pedido")


@query("wn12_last_row", "SELECT o_custkey, max(o_orderdate) AS o_orderdate, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def wn12(spark, sf):
    o = table(spark, sf, "orders").withColumn("o", F.struct("o_orderdate", "o_orderkey"))
    return grain.last_row(o, ["o_custkey"], "o").select("o_custkey", "o_orderdate", "o_orderkey")


@query("wn10_wn14_numbers", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS occurrence, bool_or(o_orderpriority = '1-URGENT') OVER (PARTITION BY o_custkey) AS any_flag FROM orders")
def wn1014(spark, sf):
    o = grain.number_rows(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return grain.flag_any(o, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", long("occurrence"), "any_flag")


@query("ag8_collapse", "SELECT l_orderkey, sum(l_quantity) AS l_quantity, round(avg(l_extendedprice), 6) AS l_extendedprice, median(l_discount) AS l_discount FROM lineitem GROUP BY l_orderkey")
def ag8(spark, sf):
    c = grain.collapse(table(spark, sf, "lineitem"), ["l_orderkey"], {"l_quantity": "sum", "l_extendedprice": "avg", "l_discount": "median"})
    return c.select("l_orderkey", "l_quantity", r6("l_extendedprice"), "l_discount")


@query("so1_union_all", "SELECT n_name AS name, n_regionkey::BIGINT AS region FROM nation UNION ALL SELECT r_name, NULL FROM region")
def so1(spark, sf):
    return grain.union_all([table(spark, sf, "nation").select(F.col("n_name").alias("name"), long("n_regionkey", "region")), table(spark, sf, "region").select(F.col("r_name").alias("name"))])


@query("so3_missing_keys", "SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def so3(spark, sf):
    return grain.missing_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("so4_shared_keys", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def so4(spark, sf):
    return grain.shared_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("so5_patch_column", """
WITH p AS (SELECT o_custkey AS c_custkey, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1)
SELECT c.c_custkey, CASE WHEN c_acctbal < 0 AND v > 0 THEN v ELSE c_acctbal END AS c_acctbal FROM customer c LEFT JOIN p ON c.c_custkey = p.c_custkey""")
def so5(spark, sf):
    patch = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"))
    new, _ = grain.patch_column(table(spark, sf, "customer"), patch, ["c_custkey"], "c_acctbal", (F.col("c_acctbal") < 0) & (F.col("new_value") > 0))
    return new.select("c_custkey", "c_acctbal")


@query("st2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def st2(spark, sf):
    return grain.top_k(table(spark, sf, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 25).select("o_orderkey", "o_totalprice")
