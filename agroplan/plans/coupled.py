"""Coupled scoring of the event table: predict, anchor, inject, recompute the links, until nothing changes.

Events have a ``stage``: VEG (a cycle), HARVEST_GRADE (cycle, day, grade) or POST (also a finish). A
target belongs to a stage; its column ``pred_<target>`` starts as the baseline's prediction, and each
round corrects it by a function of the whole state. The links carry a stage's predictions to the others:
the harvest calendar from VEG, stems by day and grade, kg, and the ratios to what POST was planned with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import apply_corr, clip
from ..sources import shared

VEG, HG, POST = "VEG", "HARVEST_GRADE", "POST"


@dataclass(frozen=True)
class Target:
    """One predicted quantity: its correction (an expression of the state's columns), how and within what it is applied.

    ``real``: a column of actual values that replace the prediction; ``label``: one that only guards it
    (the round keeps the prediction before, where the labelled rows' error would grow).
    """

    name: str
    stage: str
    correction: Column
    gamma: float = 1.0
    mode: str = "log"
    bounds: tuple[float, float] = (-1.0, 1.0)
    final: tuple[float, float] = (0.0, float("inf"))
    real: str | None = None
    label: str | None = None

    @property
    def column(self) -> str:
        return f"pred_{self.name}"


def predict_round(state: DataFrame, targets: list[Target]) -> DataFrame:
    """All targets' predictions from the state as it is; nothing sees another's new value."""
    new, guards = {}, {}
    for t in targets:
        corrected = clip(apply_corr(t.column, clip(t.gamma * t.correction, *t.bounds), t.mode), *t.final)
        new[t.column] = F.when(F.col("stage") == t.stage, corrected).otherwise(F.col(t.column))
        if t.label:
            error = lambda p, t=t: F.avg(F.when((F.col("stage") == t.stage) & F.col(t.label).isNotNull(), F.abs(p - F.col(t.label))))
            guards[t.column] = F.coalesce(error(new[t.column]) > error(F.col(t.column)), F.lit(False)).alias(t.column)
    worse = shared.one_row(state.agg(*guards.values())).asDict() if guards else {}
    for t in targets:
        if worse.get(t.column):
            new[t.column] = F.col(t.column)
        if t.real:
            new[t.column] = F.when(F.col("stage") == t.stage, F.coalesce(F.col(t.real), new[t.column])).otherwise(F.col(t.column))
    return state.withColumns(new)


def _share_dealt(state: DataFrame) -> DataFrame:
    """The grade shares of a day add up to 1."""
    is_hg, of_day = F.col("stage") == HG, W.partitionBy("ciclo", "fecha")
    share = F.when(is_hg, F.coalesce("pred_share", "share_base", F.lit(0.0)))
    total, grades = F.sum(share).over(of_day), F.count(F.when(is_hg, 1)).over(of_day)
    return state.withColumn("pred_share", F.when(is_hg, F.when(total > 0, share / total).otherwise(1 / F.greatest(grades, F.lit(1)))).otherwise(F.col("pred_share")))


def _with_calendar(state: DataFrame) -> DataFrame:
    """The state with ``__start`` and ``__n``, first day and days of its cycle's harvest by the last VEG row; null without one."""
    veg, of_cycle = F.when((F.col("stage") == VEG) & F.col("ciclo").isNotNull(), F.col("fecha")), W.partitionBy("ciclo")
    d = state.withColumns({"__sp": F.max(veg).over(of_cycle), "__p": F.max_by(F.struct("pred_d_start", "pred_n_days"), veg).over(of_cycle)})
    start = F.date_add("__sp", F.rint(F.coalesce("__p.pred_d_start", F.lit(0.0))).cast("int"))
    return d.withColumns({"__start": start, "__n": F.greatest(F.rint(F.coalesce("__p.pred_n_days", F.lit(1.0))), F.lit(1.0))}).drop("__sp", "__p")


def _linked(state: DataFrame) -> DataFrame:
    """All links but the shares, from ``__start``, ``__n`` and the references; what a row's own links do not reach keeps its value."""
    is_hg, is_post = F.col("stage") == HG, F.col("stage") == POST
    day = F.datediff("fecha", "__start") + 1
    placed = (is_hg | is_post) & F.col("__start").isNotNull()
    d = state.withColumns({"harvest_start": F.coalesce("__start", "harvest_start"), "day_in_harvest": F.when(placed, day.cast("double")).otherwise(F.col("day_in_harvest")), "rel_pos": F.when(placed, clip(day / F.col("__n"), 0.0, 1.0)).otherwise(F.col("rel_pos"))}).drop("__start", "__n")
    # stems of the day, by how much the factor moved from where it was
    ratio = F.coalesce(F.coalesce("pred_factor", F.lit(1.0)) / F.when(F.coalesce("factor_ref", F.lit(1.0)) != 0, F.coalesce("factor_ref", F.lit(1.0))), F.lit(1.0))
    d = d.withColumn("tallos_dia", F.when(is_hg, F.greatest(F.coalesce("tallos_dia_ref", F.lit(0.0)) * F.greatest(ratio, F.lit(0.0)), F.lit(0.0))).otherwise(F.col("tallos_dia")))
    d = d.withColumn("tallos_grado", F.when(is_hg, F.col("tallos_dia") * F.col("pred_share")).otherwise(F.col("tallos_grado")))
    kg = F.col("tallos_grado") * F.greatest(F.coalesce("peso_g", F.lit(0.0)), F.lit(0.0)) * F.greatest(F.coalesce("pred_peso", F.lit(1.0)), F.lit(0.0)) / 1000
    d = d.withColumn("kg", F.when(is_hg, kg).otherwise(F.col("kg")))
    of_day, of_grade = W.partitionBy("ciclo", "fecha"), W.partitionBy("ciclo", "fecha", "grado")
    of = lambda c, w: F.avg(F.when(is_hg, F.col(c))).over(w)
    moved = lambda c, ref: F.greatest(F.coalesce(of(c, of_grade) / F.when(of(ref, of_grade) != 0, of(ref, of_grade)), F.lit(1.0)), F.lit(0.0))
    d = d.withColumns({"__t": moved("tallos_grado", "tallos_grado_ref"), "__k": moved("kg", "kg_ref"), "__day": of("tallos_dia", of_day), "__grade": of("tallos_grado", of_grade)})
    post = {"tallos_post": F.col("tallos_post_ref") * F.col("__t"), "kg": F.col("kg_post_ref") * F.col("__k"), "cajas": F.col("cajas_ref") * F.col("__k"), "tallos_grado": F.coalesce("__grade", "tallos_grado"), "tallos_dia": F.coalesce("__day", "tallos_dia")}
    post["fecha_post"] = F.date_add("fecha", F.rint(F.coalesce("pred_dh", F.lit(0.0))).cast("int"))
    return d.withColumns({c: F.when(is_post, v).otherwise(F.col(c)) for c, v in post.items()}).drop("__t", "__k", "__day", "__grade")


def recompute_links(state: DataFrame) -> DataFrame:
    """The state with all that depends on other stages' predictions computed anew.

    Reads ``pred_d_start``, ``pred_n_days`` (VEG), ``pred_factor``, ``pred_share``, ``pred_peso`` (grade)
    and ``pred_dh`` (POST), and the references ``tallos_dia_ref``, ``factor_ref``, ``share_base``,
    ``peso_g``, ``tallos_grado_ref``, ``kg_ref``, ``tallos_post_ref``, ``kg_post_ref``, ``cajas_ref``.
    """
    return _linked(_share_dealt(_with_calendar(state)))


@dataclass(frozen=True)
class Rounds:
    state: DataFrame
    rounds: int
    converged: bool
    changes: tuple[float, ...]


#: What a round is sorted by, so that rows that share a weight or a day lie together; cycles, days and grades are prefixes.
_SORTED = ("ciclo", "fecha", "grado")


def score_coupled(events: DataFrame, targets: list[Target], max_rounds: int = 3, tol: float = 1e-3, derived: dict[str, Column] | None = None, buckets: int | None = None) -> Rounds:
    """Rounds of predictions and links, until no prediction changes by more than ``tol``, relatively.

    Each round is a written table: its plan does not grow with the rounds, and a lost executor costs one
    round at most. It holds the events as they came and the predictions, nothing else: the links follow
    from both, and are computed where a round is read. ``derived``: columns that follow from others of
    the same row (references, values to begin with); they are not written either. The table is in
    ``buckets`` by cycle (the shuffle partitions, if not given), so that the links read it without a
    shuffle; the round before goes once it is there. The change is observed while the round is written.
    """
    spark = events.sparkSession
    buckets, changes, last = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), [], None
    kept, predicted = events.columns, [t.column for t in targets]
    state = events.sortWithinPartitions(*_SORTED).withColumns(derived or {})
    for _ in range(max(1, max_rounds)):
        before = {f"__{c}": F.col(c) for c in predicted}
        moved = [F.max(F.abs(F.col(c) - F.col(f"__{c}")) / F.greatest(F.abs(F.col(f"__{c}")), F.lit(1e-6))).alias(c) for c in predicted]
        seen = Observation()
        new = _share_dealt(predict_round(state.withColumns(before), targets)).observe(seen, *moved).select(kept)
        table = shared.write_dealt(new, ["ciclo"], buckets, "round")
        change = max([0.0, *(v for v in seen.get.values() if v is not None)])
        if last is not None:
            shared.discard(last)
        last = table
        state = _linked(_with_calendar(table.sortWithinPartitions(*_SORTED)).withColumns(derived or {}))
        changes.append(float(change))
        if change <= tol:
            break
    return Rounds(state, len(changes), changes[-1] <= tol, tuple(changes))
