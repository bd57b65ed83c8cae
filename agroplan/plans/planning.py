"""Model tiers, comparisons and audits as compositions of the operators (see ``harvest`` for labour and post-harvest)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggs, alloc, checks, curves, grain, grids, joins, windows
from ..sources.shared import small, written


def universe_grid(cycles: DataFrame) -> DataFrame:
    """One row per cycle and harvest day: ``day``, ``day_index``, ``rel``; cycles are unique.

    ``cycles``: ciclo, start, n, total.
    """
    return grids.explode_n_days(grain.assert_unique(cycles, ["ciclo"]), "start", "n")


def beta_curve(grid: DataFrame, a: float, b: float) -> DataFrame:
    """The cycle's total over its days by a Beta curve: ``tallos_day``."""
    placed = grid.withColumns({"a": F.lit(a), "b": F.lit(b), "x": F.col("rel") - 0.5 / F.col("n")})
    shares = curves.beta_share(placed, ["ciclo"], "x", "a", "b")
    return alloc.spread_weighted(shares, ["ciclo"], "total", "beta_share", "tallos_day").drop("a", "b", "x")


def stems_by_grade(days: DataFrame, shares: DataFrame, min_n: int = 0) -> DataFrame:
    """``tallos`` by cycle, day and grade; cycles with fewer than ``min_n`` rows behind their shares get those of all cycles.

    ``shares``: ciclo, grado, share, n.
    """
    known = shares.withColumn("__n", F.sum("n").over(W.partitionBy("ciclo"))).where(F.col("__n") >= min_n)
    own = windows.share_within(known, ["ciclo"], "share", "null")
    whole = windows.share_within(shares.groupBy("grado").agg(F.sum("share").alias("share")), [], "share", "null")
    lacking = joins.anti_join(days.select("ciclo").distinct(), own, ["ciclo"]).crossJoin(whole)  # few grades
    return alloc.split_by_share(days, own.select("ciclo", "grado", "share").unionByName(lacking.select("ciclo", "grado", "share")), ["ciclo"], "tallos_day", "share", "tallos")


def kg_and_boxes(stems: DataFrame, weights: DataFrame) -> DataFrame:
    """kg and boxes by cycle, day and grade (level 0), cycle and day (1), and cycle (2). ``weights``: grado, stem_g (unique)."""
    kg = joins.enrich(stems, grain.assert_unique(weights, ["grado"]), ["grado"]).withColumn("kg", C.grams_to_kg(F.col("tallos") * F.coalesce("stem_g", F.lit(25.0))))
    return aggs.rollup_levels(kg.withColumn("cajas", C.to_boxes("kg")), [["ciclo", "day", "grado"], ["ciclo", "day"], ["ciclo"]], ["tallos", "kg", "cajas"])


def smoothed_curve(curve: DataFrame, min_n: int = 20, window: int = 5) -> DataFrame:
    """Daily shares bounded by the 5 and 95 % quantiles of their position's tenth, then smoothed. ``curve``: ciclo, order, rel, share."""
    # the quantiles read the curve several times
    binned = written(curve.withColumn("bin", F.least(F.floor(F.col("rel") * 10), F.lit(9))), "curve")
    caps = small(aggs.segment_caps(binned, ["bin"], "share", (0.05, 0.95), min_n).select("bin", "lo", "hi"), "caps")
    bounded = alloc.bound_share(joins.enrich(binned, caps, ["bin"]), ["ciclo"], "share", "lo", "hi")
    return windows.smooth_share(bounded, ["ciclo"], ["order"], "share", window)


def field_views(stems: DataFrame, blocks: DataFrame) -> DataFrame:
    """Stems by day, area and grade (0), day and area (1), week and area (2), day (3); a cycle's area is its modal one. ``blocks``: ciclo, area."""
    placed = joins.attach_mode(stems, blocks, ["ciclo"], "area").withColumn("week", C.week_key("day"))
    return aggs.rollup_levels(placed, [["day", "area", "grado"], ["day", "area"], ["week", "area"], ["day"]], ["tallos"])


def _long(df: DataFrame, y: str, models: dict[str, str], weight: str | None, segments: list[str]) -> tuple[DataFrame, list]:
    """Labelled rows, once for each model ``(model, y, p, w, segments)``, and the grouping sets of a KPI table."""
    cells = F.array(*(F.struct(F.lit(m).alias("model"), F.col(p).cast("double").alias("p")) for m, p in models.items()))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(y).cast("double").alias("y"), w.alias("w"), *(F.col(s).cast("string").alias(s) for s in segments), F.inline(cells)).where("y is not null and p is not null and w > 0")
    return rows, [["model"], *(["model", s] for s in segments)]


def _by_segment(rows: DataFrame, sets: list, segments: list[str], measures: dict) -> DataFrame:
    """``(segment, value, model, measures..)``; the grouping id tells which segment a row is of."""
    keys = ["model", *segments]
    out = rows.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(*(c.alias(n) for n, c in measures.items()), F.grouping_id().alias("__g"))
    code = lambda s: sum(1 << (len(keys) - 1 - keys.index(k)) for k in keys if k not in s)
    name, value = F.when(F.col("__g") == code(["model"]), F.lit("ALL")), F.when(F.col("__g") == code(["model"]), F.lit("ALL"))
    for s in segments:
        name, value = name.when(F.col("__g") == code(["model", s]), F.lit(s)), value.when(F.col("__g") == code(["model", s]), F.col(s))
    return out.select(name.alias("segment"), value.alias("value"), "model", *measures)


def kpi_table(df: DataFrame, y: str, a: str, b: str, weight: str, segments: list[str]) -> DataFrame:
    """``(segment, value, metric, model, amount)``: weighted error measures of two models over all and by segment, in one pass."""
    rows, sets = _long(df, y, {"a": a, "b": b}, weight, segments)
    e, w, positive = F.col("p") - F.col("y"), F.col("w"), (F.col("y") > 0) & (F.col("p") > 0)
    measures = {
        "mae": F.sum(w * F.abs(e)) / F.sum(w), "bias": F.sum(w * e) / F.sum(w), "wape": F.when(F.sum(w * F.abs("y")) > 0, F.sum(w * F.abs(e)) / F.sum(w * F.abs("y"))),
        "log_mae": F.sum(F.when(positive, w * F.abs(F.log(F.col("p") / F.col("y"))))) / F.sum(F.when(positive, w)),
    }
    return _by_segment(rows, sets, segments, measures).unpivot(["segment", "value", "model"], [*measures], "metric", "amount")


def kpi_days(df: DataFrame, y: str, a: str, b: str, segments: list[str]) -> DataFrame:
    """Starts, horizons and hydration days: MAE, bias, exact hits, within 3 days, and the error's quartiles of two models."""
    rows, sets = _long(df, y, {"a": a, "b": b}, None, segments)
    e = F.col("p") - F.col("y")
    quartiles = {f"p{round(100 * q)}": F.percentile(F.abs(e), q) for q in (0.25, 0.5, 0.75, 0.95)}  # errors in days: few distinct values
    measures = {"n": F.count(F.lit(1)), "mae": F.avg(F.abs(e)), "bias": F.avg(e), "exact": F.avg((F.rint(F.col("p")) == F.col("y")).cast("double")), "within_3": F.avg((F.abs(e) <= 3).cast("double")), **quartiles}
    return _by_segment(rows, sets, segments, measures)


def kpi_shares(df: DataFrame, groups: list[str], y: str, a: str, b: str, weight: str, segments: list[str]) -> DataFrame:
    """Shares of two models, each scaled to 1 in its group first: weighted MAE and WAPE, and the part of groups whose raw shares miss 1.

    ``weight``: the group's amount behind its shares.
    """
    w = W.partitionBy(*groups)
    scaled = df
    for p in (a, b):
        total = F.sum(p).over(w)
        scaled = scaled.withColumns({f"__off_{p}": (F.abs(total - 1) > 1e-6).cast("double"), f"__s_{p}": F.when(total > 0, F.col(p) / total)})
    cells = F.array(*(F.struct(F.lit(m).alias("model"), F.col(f"__s_{p}").alias("p"), F.col(f"__off_{p}").alias("off")) for m, p in (("a", a), ("b", b))))
    first = (F.row_number().over(w.orderBy(F.lit(0))) == 1).cast("double")
    rows = scaled.withColumn("__first", first).select(F.col(y).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), "__first", *(F.col(s).cast("string").alias(s) for s in segments), F.inline(cells)).where("y is not null and p is not null and w > 0")
    e = F.abs(F.col("p") - F.col("y"))
    measures = {"mae": F.sum(F.col("w") * e) / F.sum("w"), "wape": F.when(F.sum(F.col("w") * F.abs("y")) > 0, F.sum(F.col("w") * e) / F.sum(F.col("w") * F.abs("y"))), "off_rate": F.sum(F.col("off") * F.col("__first")) / F.sum("__first")}
    return _by_segment(rows, [["model"], *(["model", s] for s in segments)], segments, measures)


def offer_audit(offer: DataFrame, gold: DataFrame, cycles: DataFrame) -> DataFrame:
    """Uniqueness of both grains, their mass balance by cycle, coverage of the cycles, and days before the start."""
    parts = [
        checks.check_unique(offer, ["ciclo", "day"], "offer"), checks.check_unique(gold, ["ciclo", "day", "grado"], "gold"), checks.check_mass_balance(gold, offer, ["ciclo"], "tallos", "tallos_day", "gold"),
        checks.check_coverage(cycles, gold, ["ciclo"], "gold"), checks.check_dates(gold, cycles, ["ciclo"], "day", "start", "gold", 0),
    ]
    return checks.all_checks(parts)


def worst_rows(df: DataFrame, y: str, p: str, keys: list[str], n: int) -> DataFrame:
    """The n rows of the largest absolute error: the limit is the feature."""
    return grain.top_k(df.withColumn("abs_error", F.abs(F.col(p) - F.col(y))), [F.desc("abs_error"), *keys], n)
