"""Queries for the coupled tier, panels, reconciliation, linear models from sums, and observed or bucketed writes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import linear, observed, panel, reconcile, windows
from ..sources import incremental, shared
from . import coupled
from .base import DAILY, LINES, daily, lines, long, r6, table
from .coupled import HG, POST, VEG, Target
from .registry import query

# --- coupled scoring ---------------------------------------------------------------------------------

EVENTS = LINES + """, hg AS (SELECT ciclo, fecha, grado, sum(tallos) AS t, avg(peso / tallos) / 50 AS peso_g, avg("desc") AS ds FROM l GROUP BY 1, 2, 3), dd AS (SELECT ciclo, fecha, sum(t) AS t FROM hg GROUP BY 1, 2),
po AS (SELECT ciclo, fecha, grado, destino, sum(tallos) AS t FROM l GROUP BY 1, 2, 3, 4),
s0 AS (SELECT 'VEG' AS stage, ciclo, min(fecha) - 60 AS fecha, NULL::INT AS grado, NULL::VARCHAR AS destino, 60.0 + ciclo % 5 AS p_start, 400.0 + ciclo % 11 AS p_days, NULL::DOUBLE AS p_factor, NULL::DOUBLE AS p_share, NULL::DOUBLE AS p_peso, NULL::DOUBLE AS p_dh, NULL::DOUBLE AS dref, NULL::DOUBLE AS fref, NULL::DOUBLE AS peso_g, NULL::DOUBLE AS gref, NULL::DOUBLE AS kref, NULL::DOUBLE AS tpref, NULL::DOUBLE AS kpref, NULL::DOUBLE AS real_share, NULL::DOUBLE AS real_dh, NULL::DOUBLE AS rel, NULL::DOUBLE AS td, NULL::DOUBLE AS tg, NULL::DOUBLE AS kg, NULL::DOUBLE AS tp, NULL::DATE AS fp FROM l GROUP BY ciclo
UNION ALL SELECT 'HARVEST_GRADE', hg.ciclo, hg.fecha, hg.grado, NULL, NULL, NULL, 1 + ds, hg.t / dd.t, 1.0, NULL, dd.t, 1 + ds, peso_g, hg.t, hg.t * peso_g / 1000, NULL, NULL, hg.t / dd.t * exp(0.03 * (hg.grado - 4)), NULL, 0.5, dd.t, hg.t, hg.t * peso_g / 1000, NULL, NULL FROM hg JOIN dd ON hg.ciclo = dd.ciclo AND hg.fecha = dd.fecha
UNION ALL SELECT 'POST', po.ciclo, po.fecha, po.grado, destino, NULL, NULL, NULL, NULL, NULL, 5.0 + po.grado, NULL, NULL, NULL, NULL, NULL, po.t, po.t * peso_g / 1000, NULL, CASE WHEN destino = 'R' THEN 7.0 END, 0.5, NULL, po.t, po.t * peso_g / 1000, po.t, NULL FROM po JOIN hg ON po.ciclo = hg.ciclo AND po.fecha = hg.fecha AND po.grado = hg.grado)"""
ROUND = """, q{r} AS (SELECT s.*, CASE WHEN stage = 'VEG' THEN greatest(0, least(200, p_start + greatest(-10, least(10, 0.4 * (ciclo % 3 - 1))))) END AS n_start, CASE WHEN stage = 'VEG' THEN greatest(1, p_days + greatest(-10, least(10, 0.3 * (ciclo % 7 - 3)))) END AS n_days,
CASE WHEN stage = 'HARVEST_GRADE' THEN greatest(0.2, least(5, (p_factor + 1e-6) * exp(greatest(-0.3, least(0.3, 0.2 * (rel - 0.5)))) - 1e-6)) END AS n_factor, CASE WHEN stage = 'HARVEST_GRADE' THEN greatest(0, (p_share + 1e-6) * exp(greatest(-1, least(1, 0.05 * (grado - 4) * rel))) - 1e-6) END AS n_share0,
CASE WHEN stage = 'HARVEST_GRADE' THEN greatest(0.5, least(2, (p_peso + 1e-6) * exp(greatest(-0.1, least(0.1, td / 1000 - 0.05))) - 1e-6)) END AS n_peso, CASE WHEN stage = 'POST' THEN coalesce(real_dh, greatest(0, least(30, p_dh + greatest(-2, least(2, 0.31 * rel + kg / 100))))) END AS n_dh FROM s{p} s),
g{r} AS (SELECT coalesce(avg(abs(n_share0 - real_share)) > avg(abs(p_share - real_share)), false) AS worse FROM q{r} WHERE stage = 'HARVEST_GRADE'),
c{r} AS (SELECT ciclo, fecha + round_even(n_start, 0)::INT AS start, greatest(round_even(n_days, 0), 1) AS n FROM q{r} WHERE stage = 'VEG'),
u{r} AS (SELECT q.* EXCLUDE (rel), CASE WHEN worse THEN p_share ELSE n_share0 END AS n_share, CASE WHEN stage <> 'VEG' THEN greatest(0, least(1, (date_diff('day', start, fecha) + 1) / n)) END AS rel, CASE WHEN stage = 'HARVEST_GRADE' THEN dref * n_factor / fref END AS td1 FROM q{r} q JOIN c{r} c ON q.ciclo = c.ciclo, g{r}),
v{r} AS (SELECT *, CASE WHEN stage = 'HARVEST_GRADE' THEN CASE WHEN sum(n_share) OVER d > 0 THEN n_share / sum(n_share) OVER d ELSE 1.0 / count(n_share) OVER d END END AS sh1 FROM u{r} WINDOW d AS (PARTITION BY ciclo, fecha)),
w{r} AS (SELECT *, td1 * sh1 AS tg1, td1 * sh1 * peso_g * n_peso / 1000 AS kg1 FROM v{r}),
x{r} AS (SELECT *, avg(tg1) OVER g / avg(gref) OVER g AS rt, avg(kg1) OVER g / avg(kref) OVER g AS rk, avg(td1) OVER d AS dn, avg(tg1) OVER g AS gn FROM w{r} WINDOW d AS (PARTITION BY ciclo, fecha), g AS (PARTITION BY ciclo, fecha, grado)),
s{r} AS (SELECT stage, ciclo, fecha, grado, destino, n_start AS p_start, n_days AS p_days, n_factor AS p_factor, sh1 AS p_share, n_peso AS p_peso, n_dh AS p_dh, dref, fref, peso_g, gref, kref, tpref, kpref, real_share, real_dh, rel, CASE WHEN stage = 'POST' THEN dn ELSE td1 END AS td, CASE WHEN stage = 'POST' THEN gn ELSE tg1 END AS tg,
CASE WHEN stage = 'POST' THEN kpref * rk ELSE kg1 END AS kg, tpref * rt AS tp, CASE WHEN stage = 'POST' THEN fecha + round_even(n_dh, 0)::INT END AS fp FROM x{r})"""


#: Lines of a bucket of cycles, which one task sorts.
BUCKET_LINES = 250_000


def _planned(spark, sf):
    """Cycles, their days by grade, and what of a grade goes to each finish, as a baseline plans them, without :func:`_references`; and their buckets.

    Lines are dealt by cycle once, and sorted; all sums here are windows over them, and a line that is the first
    of a finish, a grade or a cycle makes the row of it.
    """
    lots = lines(spark, sf).select("ciclo", "fecha", "grado", "destino", "tallos", "peso", "desc").where("ciclo IS NOT NULL")
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lots.count() // BUCKET_LINES))
    keys = ["ciclo", "fecha", "grado", "destino"]
    cycle, day, grade, finish = (W.partitionBy(*keys[:n]) for n in (1, 2, 3, 4))
    nth = F.row_number().over(grade.orderBy("destino"))
    l = lots.repartition(buckets, "ciclo").sortWithinPartitions(*keys).withColumns({  # noqa: E741
        "nth": nth, "first_of_finish": nth == F.rank().over(grade.orderBy("destino")), "finish_t": F.sum("tallos").over(finish), "grade_t": F.sum("tallos").over(grade), "peso_g": F.avg(F.col("peso") / F.col("tallos")).over(grade) / 50, "factor": 1 + F.avg("desc").over(grade), "day_t": F.sum("tallos").over(day),
        "first_of_cycle": F.row_number().over(cycle.orderBy("fecha", "grado", "destino")) == 1, "start": F.date_sub(F.min("fecha").over(cycle), 60),
    })
    kinds = {"stage": "string", "fecha": "date", "grado": "int", "destino": "string"} | dict.fromkeys(("pred_d_start", "pred_n_days", "pred_factor", "pred_share", "pred_peso", "pred_dh", "tallos", "peso_tallo", "tallos_dia_ref", "factor_ref"), "double")
    row = lambda **of: F.struct(*(of.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()))
    fecha, grado = F.col("fecha"), F.col("grado")
    veg = row(stage=F.lit(VEG), fecha=F.col("start"), pred_d_start=60.0 + F.col("ciclo") % 5, pred_n_days=400.0 + F.col("ciclo") % 11)
    grades = row(stage=F.lit(HG), fecha=fecha, grado=grado, pred_factor=F.col("factor"), pred_share=F.col("grade_t") / F.col("day_t"), pred_peso=F.lit(1.0), tallos=F.col("grade_t"), peso_tallo=F.col("peso_g"), tallos_dia_ref=F.col("day_t"), factor_ref=F.col("factor"))
    post = row(stage=F.lit(POST), fecha=fecha, grado=grado, destino=F.col("destino"), pred_dh=5.0 + grado, tallos=F.col("finish_t"), peso_tallo=F.col("peso_g"))
    dated = fecha.isNotNull()
    rows = F.array(F.when(F.col("first_of_cycle"), veg), F.when((F.col("nth") == 1) & dated, grades), F.when(F.col("first_of_finish") & dated & grado.isNotNull(), post))
    return l.select("ciclo", F.inline(rows)).where("stage IS NOT NULL"), buckets


def _references():
    """What follows from a row of :func:`_planned`: the references of its stage and the values that the links begin with."""
    is_hg, is_post, null = F.col("stage") == HG, F.col("stage") == POST, lambda kind: F.lit(None).cast(kind)
    share, kg = F.col("tallos") / F.col("tallos_dia_ref"), F.col("tallos") * F.col("peso_tallo") / 1000
    hg, post = lambda c: F.when(is_hg, c), lambda c: F.when(is_post, c)
    return {
        "peso_g": hg(F.col("peso_tallo")), "share_base": hg(share), "tallos_grado_ref": hg(F.col("tallos")), "kg_ref": hg(kg), "real_share": hg(share * F.exp(0.03 * (F.col("grado") - 4))), "tallos_post_ref": post(F.col("tallos")), "kg_post_ref": post(kg), "cajas_ref": post(kg / 10),
        "real_dh": post(F.when(F.col("destino") == "R", 7.0)), "rel_pos": F.when(is_hg | is_post, 0.5), "tallos_dia": F.col("tallos_dia_ref"), "tallos_grado": F.col("tallos"), "kg": kg, "tallos_post": post(F.col("tallos")), "cajas": post(kg / 10),
        "harvest_start": null("date"), "day_in_harvest": null("double"), "fecha_post": null("date"),
    }


def _events(spark, sf):
    """The planned rows with their references."""
    return _planned(spark, sf)[0].withColumns(_references()).drop("tallos", "peso_tallo")


def coupled_targets():
    return [
        Target("d_start", VEG, (F.col("ciclo") % 3 - 1) * 0.5, 0.8, "add", (-10.0, 10.0), (0.0, 200.0)), Target("n_days", VEG, (F.col("ciclo") % 7 - 3) * 0.3, 1.0, "add", (-10.0, 10.0), (1.0, float("inf"))),
        Target("factor", HG, 0.2 * (F.col("rel_pos") - 0.5), 1.0, "log", (-0.3, 0.3), (0.2, 5.0)), Target("share", HG, 0.05 * (F.col("grado") - 4) * F.col("rel_pos"), label="real_share"),
        Target("peso", HG, F.col("tallos_dia") / 1000 - 0.05, 1.0, "log", (-0.1, 0.1), (0.5, 2.0)), Target("dh", POST, 0.31 * F.col("rel_pos") + F.col("kg") / 100, 1.0, "add", (-2.0, 2.0), (0.0, 30.0), real="real_dh"),
    ]


@query("ml2_coupled_scoring", "WITH " + EVENTS + "".join(ROUND.format(r=r, p=r - 1) for r in (1, 2, 3)) + " SELECT stage, ciclo, fecha, grado::BIGINT AS grado, destino, round(p_start, 5) AS d_start, round(p_factor, 5) AS factor, round(p_share, 5) AS share, round(p_peso, 5) AS peso, round(p_dh, 5) AS dh, round(rel, 5) AS rel_pos, round(td, 4) AS tallos_dia, round(tg, 4) AS tallos_grado, round(kg, 5) AS kg, round(tp, 4) AS tallos_post, fp AS fecha_post FROM s3")
def coupled_scoring(spark, sf):
    planned, buckets = _planned(spark, sf)
    done = coupled.score_coupled(planned, coupled_targets(), 3, 0.0, _references(), buckets)
    r5 = lambda c, n: F.round(c, 5).alias(n)
    return done.state.select(
        "stage", "ciclo", "fecha", long("grado"), "destino", r5("pred_d_start", "d_start"), r5("pred_factor", "factor"), r5("pred_share", "share"), r5("pred_peso", "peso"), r5("pred_dh", "dh"), r5("rel_pos", "rel_pos"),
        F.round("tallos_dia", 4).alias("tallos_dia"), F.round("tallos_grado", 4).alias("tallos_grado"), r5("kg", "kg"), F.round("tallos_post", 4).alias("tallos_post"), "fecha_post",
    )


# --- panel ------------------------------------------------------------------------------------------

PANEL = DAILY + """, o AS (SELECT l_suppkey AS ciclo, l_shipdate::DATE + (l_orderkey % 30)::INT AS d, sum(l_tax) AS tax FROM lineitem GROUP BY 1, 2), c AS (SELECT ciclo, min(fecha) + 30 AS a, max(fecha) AS z FROM d GROUP BY 1),
e AS (SELECT ciclo, a, z, a + o::INT AS t FROM c, (SELECT unnest(range(14, 900, 90)) AS o) WHERE a + o::INT < z)
SELECT ciclo, t AS "asof", """ + ", ".join(f"(SELECT round(coalesce(sum({x}), 0), 4) FROM {s} WHERE {s}.ciclo = e.ciclo AND {day} <= t AND {day} >= greatest({lo}, a)) AS {n}" for x, s, day, lo, n in (
    ("x", "d", "fecha", "a", "x_since"), ("x", "d", "fecha", "t - 6", "x_last7"), ("x", "d", "fecha", "t - 13", "x_last14"), ("tax", "o", "d", "a", "tax_since"), ("tax", "o", "d", "t - 6", "tax_last7"))) + """,
(SELECT count(*) FROM d WHERE d.ciclo = e.ciclo AND fecha BETWEEN a AND t) AS stems_rows, (SELECT max(d) FROM o WHERE o.ciclo = e.ciclo AND d <= t) AS taxes_seen, date_diff('day', t, z) AS days_left FROM e"""


def _asof_panel(spark, sf):
    d = daily(spark, sf).select("ciclo", "fecha", "x")
    taxes = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("ciclo"), F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 30).cast("int")).alias("d")).agg(F.sum("l_tax").alias("tax"))
    cycles = d.groupBy("ciclo").agg(F.date_add(F.min("fecha"), 30).alias("a"), F.max("fecha").alias("z"))
    entities = cycles.withColumn("asof", F.explode(F.transform(F.sequence(F.lit(14), F.lit(899), F.lit(90)), lambda o: F.date_add("a", o)))).where("asof < z")
    known = panel.asof_panel(entities.select("ciclo", "a", "asof"), ["ciclo", "asof"], ["ciclo"], "a", "asof", {"stems": (d, "fecha", ["x"]), "taxes": (taxes, "d", ["tax"])})
    return panel.attach_labels(known, cycles.withColumn("z_label", F.col("z")), ["ciclo"], "asof", "z", ["z_label"])


@query("ml2_asof_panel", "WITH " + PANEL)
def asof_panel(spark, sf):
    p = _asof_panel(spark, sf)
    r4 = lambda c: F.round(c, 4).alias(c)
    return p.select("ciclo", "asof", *(r4(c) for c in ("x_since", "x_last7", "x_last14", "tax_since", "tax_last7")), "stems_rows", "taxes_seen", long(F.datediff("z_label", "asof"), "days_left"))


@query("ml2_panel_leakage", "WITH " + PANEL.split("\nSELECT ciclo, t")[0] + " SELECT count(*) AS n, 0::BIGINT AS n_late FROM e")
def panel_leakage(spark, sf):
    return panel.leakage(_asof_panel(spark, sf), "asof", ["stems_seen", "taxes_seen"])


# --- reconciliation ----------------------------------------------------------------------------------

TREE = LINES + """, f AS (SELECT ciclo, fecha, grado, destino, sum(tallos) AS plan, sum(tallos * (1.2 - "desc")) AS act FROM l GROUP BY ALL), b4 AS (SELECT ciclo, fecha, grado, destino, plan, CASE WHEN act > 30 THEN act / 2 END AS seen, coalesce(CASE WHEN act > 30 THEN act / 2 END, 0) AS fl FROM f)"""
LEVELS = (("ciclo",), ("ciclo", "fecha"), ("ciclo", "fecha", "grado"), ("ciclo", "fecha", "grado", "destino"))


def _tree_sql():
    seen = {3: "CASE WHEN plan > 60 THEN 0.9 * plan END", 2: "CASE WHEN fecha < DATE '1994-01-01' THEN plan * 1.05 END", 1: "NULL::DOUBLE"}
    up = "".join(f", a{n} AS (SELECT {', '.join(k)}, sum(plan) AS plan, sum(fl) AS fl0 FROM b{n + 1} GROUP BY ALL), b{n} AS (SELECT *, {seen[n]} AS seen, coalesce({seen[n]}, fl0) AS fl FROM a{n})" for n, k in ((3, LEVELS[2]), (2, LEVELS[1]), (1, LEVELS[0])))
    down = ", t1 AS (SELECT ciclo, coalesce(seen, greatest(plan, fl)) AS v FROM b1)"
    for n in (2, 3, 4):
        keys, parent = ", ".join(LEVELS[n - 1]), ", ".join(LEVELS[n - 2])
        down += f""", h{n} AS (SELECT b.*, v AS total, sum(fl) OVER p AS fs, sum(CASE WHEN seen IS NULL THEN plan ELSE 0 END) OVER p AS mass, count(*) FILTER (seen IS NULL) OVER p AS pl, count(*) OVER p AS al FROM b{n} b JOIN t{n - 1} USING ({parent}) WINDOW p AS (PARTITION BY {parent})),
i{n} AS (SELECT *, fl + CASE WHEN seen IS NULL THEN greatest(total - fs, 0) * CASE WHEN mass > 0 THEN plan / mass ELSE 1.0 / pl END ELSE 0 END AS f1 FROM h{n}), t{n} AS (SELECT {keys}, CASE WHEN sum(f1) OVER p > 0 THEN f1 * total / sum(f1) OVER p ELSE total / al END AS v FROM i{n} WINDOW p AS (PARTITION BY {parent}))"""
    return "WITH " + TREE + up + down + " SELECT ciclo, fecha, grado::BIGINT AS grado, destino, round(v, 4) AS value FROM t4"


@query("gold_reconciled_hierarchy", _tree_sql())
def reconciled(spark, sf):
    """Stems planned by cycle, day, grade and finish; days before 1994, large grades and large finishes are observed."""
    leaves = shared.written(lines(spark, sf).groupBy(*LEVELS[3]).agg(F.sum("tallos").alias("plan"), F.sum(F.col("tallos") * (1.2 - F.col("desc"))).alias("act")), "leaves")
    by = lambda n: leaves.groupBy(*LEVELS[n]).agg(F.sum("plan").alias("plan"))
    days = by(1).withColumn("seen", F.when(F.col("fecha") < "1994-01-01", F.col("plan") * 1.05))
    grades = by(2).withColumn("seen", F.when(F.col("plan") > 60, 0.9 * F.col("plan")))
    finishes = leaves.withColumn("seen", F.when(F.col("act") > 30, F.col("act") / 2))
    out = reconcile.reconcile_hierarchy(leaves.select(*LEVELS[3], "plan"), [[*k] for k in LEVELS], "plan", [None, (days, "seen"), (grades, "seen"), (finishes, "seen")])
    return out.select("ciclo", "fecha", long("grado"), "destino", F.round("value", 4).alias("value"))


# --- linear models from sums ---------------------------------------------------------------------------

MASKED = LINES + ", y AS (SELECT pedido, grado, parte, tallos, \"desc\" AS d, k, CASE WHEN tallos > 4 * k THEN peso * (1 + k * \"desc\") / 1000 + k * tallos END AS y, grado + k AS w FROM l, (SELECT unnest(range(1, 10)) AS k))"
SOLVED = MASKED + """, m AS (SELECT k, count(*) AS n, sum(w * tallos) / sum(w) AS m1, sum(w * d) / sum(w) AS m2, sum(w * y) / sum(w) AS my, sum(w) AS sw FROM y WHERE y IS NOT NULL GROUP BY k),
s AS (SELECT k, any_value(n) AS n, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my, sum(w * (tallos - m1) * (tallos - m1)) AS s11, sum(w * (d - m2) * (d - m2)) AS s22, sum(w * (tallos - m1) * (d - m2)) AS s12, sum(w * (tallos - m1) * (y - my)) AS s1y, sum(w * (d - m2) * (y - my)) AS s2y FROM y JOIN m USING (k) WHERE y IS NOT NULL GROUP BY k),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)"""


def _masked(spark, sf):
    l = lines(spark, sf)  # noqa: E741
    y = lambda k: F.when(F.col("tallos") > 4 * k, F.col("peso") * (1 + k * F.col("desc")) / 1000 + k * F.col("tallos"))
    return l.withColumns({f"t{k}": y(k) for k in range(1, 10)} | {f"w{k}": F.col("grado") + k for k in range(1, 10)})


@query("md13_fit_targets", "WITH " + SOLVED + " SELECT 't' || k AS target, n, round(my - b1 * m1 - b2 * m2, 4) AS intercept, round(b1, 5) AS tallos, round(b2, 4) AS \"desc\" FROM b")
def fit_targets(spark, sf):
    """Nine targets, each with rows of its own and weights, from one scan."""
    fits = linear.fit_targets(_masked(spark, sf), {f"t{k}": f"w{k}" for k in range(1, 10)}, ["tallos", "desc"])
    rows = [(t, f.n, round(f.coefficients[0], 4), round(f.coefficients[1], 5), round(f.coefficients[2], 4)) for t, f in fits.items()]
    return spark.createDataFrame(rows, "target string, n long, intercept double, tallos double, desc double")


@query("md13_predict_targets", "WITH " + SOLVED + " SELECT pedido, y.grado::BIGINT AS grado, parte, " + ", ".join(f"round(max(my + b1 * (tallos - m1) + b2 * (d - m2)) FILTER (k = {k}), 3) AS pred_t{k}" for k in range(1, 10)) + " FROM y JOIN b USING (k) GROUP BY ALL")
def predict_targets(spark, sf):
    rows = _masked(spark, sf)
    fits = linear.fit_targets(rows, {f"t{k}": f"w{k}" for k in range(1, 10)}, ["tallos", "desc"])
    return linear.predict_targets(rows, fits, ["tallos", "desc"]).groupBy("pedido", long("grado"), "parte").agg(*(F.round(F.max(f"pred_t{k}"), 3).alias(f"pred_t{k}") for k in range(1, 10)))


CELLS = LINES + """, z AS (SELECT ("desc" > 0.05)::INT AS a, (tallos > 25)::INT AS b, peso / 1000 AS y FROM l), m AS (SELECT a, b, avg(y) AS m, count(*) AS n FROM z GROUP BY 1, 2), v AS (SELECT a, b, any_value(m) AS m, sum(((y - m) / (1 - 1.0 / n)) ^ 2) / any_value(n) ^ 2 AS v FROM z JOIN m USING (a, b) GROUP BY 1, 2),
p AS (SELECT max(m) FILTER (a = 0 AND b = 0) AS m00, max(m) FILTER (a = 1 AND b = 0) AS m10, max(m) FILTER (a = 0 AND b = 1) AS m01, max(m) FILTER (a = 1 AND b = 1) AS m11, max(v) FILTER (a = 0 AND b = 0) AS v00, max(v) FILTER (a = 1 AND b = 0) AS v10, max(v) FILTER (a = 0 AND b = 1) AS v01, max(v) FILTER (a = 1 AND b = 1) AS v11 FROM v)"""


def _interacted(spark, sf):
    z = lines(spark, sf).select((F.col("desc") > 0.05).cast("int").alias("a"), (F.col("tallos") > 25).cast("int").alias("b"), (F.col("peso") / 1000).alias("y"))
    z, names = linear.interactions(z, ["a"], ["b"])
    return z, names, linear.ols(z, "y", ["a", "b", *names.values()])


@query("md20_interactions", "WITH " + CELLS + " SELECT 'intercept' AS term, round(m00, 4) AS coefficient, round(sqrt(v00), 4) AS error FROM p UNION ALL SELECT 'a', round(m10 - m00, 4), round(sqrt(v10 + v00), 4) FROM p UNION ALL SELECT 'b', round(m01 - m00, 4), round(sqrt(v01 + v00), 4) FROM p UNION ALL SELECT 'int__a__x__b', round(m11 - m10 - m01 + m00, 4), round(sqrt(v11 + v10 + v01 + v00), 4) FROM p")
def md20_interactions(spark, sf):
    """A 2 x 2 design, in which the coefficients are differences of cell means."""
    _, _, fit = _interacted(spark, sf)
    return spark.createDataFrame([(t, round(b, 4), round(e, 4)) for t, b, e, _, _ in fit.table()], "term string, coefficient double, error double")


@query("md20_scenario_marginals", "WITH " + CELLS + """, c AS (SELECT 'mean' AS scenario, avg(b) AS s FROM z UNION ALL SELECT 'low', 0.2 UNION ALL SELECT 'high', 0.9)
SELECT 'a' AS "column", scenario, round((m10 - m00) * (1 - s) + (m11 - m01) * s, 4) AS marginal, round(sqrt((1 - s) ^ 2 * (v10 + v00) + s ^ 2 * (v11 + v01)), 4) AS error FROM p, c""")
def md20_marginals(spark, sf):
    z, names, fit = _interacted(spark, sf)
    mixes = {"mean": linear.mean_mix(z, ["b"]), "low": {"b": 0.2}, "high": {"b": 0.9}}
    return spark.createDataFrame([(a, s, round(m, 4), round(e, 4)) for a, s, m, e in linear.marginals(fit, ["a"], names, mixes)], "column string, scenario string, marginal double, error double")


# --- sources and sinks -----------------------------------------------------------------------------------


@query("sc3_incremental", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, o_orderdate::TIMESTAMP AS o_orderdate FROM orders")
def sc3(spark, sf):
    """Three runs over a source that grows by day; the last finds rows that came late, and the result is the whole table."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    late = (F.col("o_orderkey") % 7 == 0) & F.col("o_orderdate").between("1996-12-01", "1996-12-31")
    state = shared.new_path(spark, "orders-state")
    for until in ("1995-01-01", "1997-01-01", None):
        there = orders.where((F.col("o_orderdate") < until) & ~late) if until else orders
        merged = incremental.extract_increment(spark, there.where, state, ["o_orderkey"], "o_orderdate", "1990-01-01", 40)
    return merged


@query("au_observed", "WITH " + LINES + """, u AS (SELECT (sum(n - 1) / sum(n))::DOUBLE AS v FROM (SELECT count(*) AS n FROM l GROUP BY pedido, grado)), r AS (SELECT avg((NOT "desc" BETWEEN 0 AND 0.09)::INT) AS d, avg((NOT tallos BETWEEN 1 AND 50)::INT) AS t FROM l),
c AS (SELECT 'AU1_unique' AS check_id, '' AS key, v, 0.0 AS expected FROM u UNION ALL SELECT 'AU5_range', 'desc', d, 0.0 FROM r UNION ALL SELECT 'AU5_range', 'tallos', t, 0.0 FROM r UNION ALL SELECT 'AU11_filled', '', 1.0, 1.0) SELECT check_id, 'lines' AS source, key, CASE WHEN v = expected THEN 'PASS' ELSE 'FAIL' END AS status, round(v, 6) AS value, expected::DOUBLE AS expected FROM c""")
def au_observed(spark, sf):
    checks = observed.write_audited(lines(spark, sf), shared.new_path(spark, "audited"), "lines", ["pedido", "grado"], {"desc": (0, 0.09), "tallos": (1, 50)})
    return checks.select("check_id", "source", "key", "status", r6("value"), "expected")


@query("st1_bucketed_windows", "WITH " + DAILY + " SELECT ciclo, fecha, round(sum(x) OVER (PARTITION BY ciclo ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS last7, round(x / sum(x) OVER (PARTITION BY ciclo), 8) AS share FROM d")
def st1_bucketed(spark, sf):
    """Trailing sums and shares read from a table that is bucketed and sorted by them: one shuffle, when it was written."""
    b = shared.write_bucketed(daily(spark, sf).select("ciclo", "fecha", "x"), ["ciclo"], ["fecha"], 8)
    out = windows.rolling(windows.share_within(b, ["ciclo"], "x"), ["ciclo"], ["fecha"], "x", 7, "sum", "last7")
    return out.select("ciclo", "fecha", F.round("last7", 4).alias("last7"), F.round("share", 8).alias("share"))
