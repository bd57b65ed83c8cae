"""Point-in-time panels: features of several series at every as-of date, with labels that lie ahead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import running_sums


def asof_panel(entities: DataFrame, on: list[str], by: list[str], start: str, asof: str, series: dict[str, tuple[DataFrame, str, list[str]]], spans: tuple[int, ...] = (7, 14)) -> DataFrame:
    """Each entity row with sums of every series since its start and over its last days, as of its date.

    ``entities``: rows unique in ``on``, with ``by``, ``start`` and ``asof``; ``series``: name -> (table,
    day column, value columns), keyed by ``by`` too; value columns have names of their own. A row asks at
    a few dates (the as-of date, the day before the start, and those days before the as-of date, no
    earlier than the start). All questions and all series are one union and one running sum by key and
    slice of time; no entity ever meets the range of days itself.

    Adds, for each value x, ``x_since`` and ``x_last<n>``; for each series s, ``s_rows`` (rows since the
    start) and ``s_seen`` (the day of the last row known at the as-of date). Null values count as 0.
    """
    before, points = F.date_sub(F.col(start), 1), {"asof": F.col(asof).cast("date")}
    points["base"] = before
    points |= {f"p{n}": F.greatest(F.date_sub(F.col(asof), n), before) for n in spans}
    asked = entities.select(*by, F.struct(*on).alias("__id"), F.explode(F.array(*(F.struct(F.lit(k).alias("k"), d.alias("d")) for k, d in points.items()))).alias("__p"))
    asked = asked.select(*by, "__id", F.col("__p.k").alias("__k"), F.col("__p.d").alias("__day"), F.lit(1).alias("__side"))
    parts, sums, latest = [], {}, {}
    for name, (df, day, xs) in series.items():
        parts.append(df.select(*by, F.col(day).cast("date").alias("__day"), F.lit(0).alias("__side"), F.lit(1).alias(f"__n_{name}"), F.unix_date(F.col(day).cast("date")).alias(f"__t_{name}"), *(F.col(x).cast("double").alias(f"__x_{x}") for x in xs)))
        sums |= {f"__c_{name}": F.col(f"__n_{name}").cast("long")} | {f"__s_{x}": F.col(f"__x_{x}") for x in xs}
        latest[f"__l_{name}"] = F.col(f"__t_{name}")
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [asked, *parts])
    known = running_sums(both, by, "__day", sums, latest, ["__side"]).where("__side = 1")
    at = lambda c, k: F.max(F.when(F.col("__k") == k, F.col(c)))
    cols = {}
    for name, (_, _, xs) in series.items():
        cols[f"{name}_rows"] = F.greatest(at(f"__c_{name}", "asof") - at(f"__c_{name}", "base"), F.lit(0))
        cols[f"{name}_seen"] = F.date_from_unix_date(at(f"__l_{name}", "asof").cast("int"))
        for x in xs:
            cols[f"{x}_since"] = at(f"__s_{x}", "asof") - at(f"__s_{x}", "base")
            cols |= {f"{x}_last{n}": at(f"__s_{x}", "asof") - at(f"__s_{x}", f"p{n}") for n in spans}
    found = known.groupBy("__id").agg(*(c.alias(n) for n, c in cols.items())).select(*(F.col(f"__id.{k}").alias(k) for k in on), *cols)
    from .joins import enrich_null_safe

    return enrich_null_safe(entities, found, on)


def attach_labels(panel: DataFrame, labels: DataFrame, on: list[str], asof: str, known_on: str, values: list[str]) -> DataFrame:
    """The panel's rows with the label values of their key, only where these became known after the as-of date."""
    joined = panel.join(labels.select(*on, known_on, *values), on, "left")
    ahead = F.col(known_on) > F.col(asof)
    return joined.withColumns({v: F.when(ahead, F.col(v)) for v in values}).withColumn("labelled", F.coalesce(ahead, F.lit(False)))


def leakage(panel: DataFrame, asof: str, seen: list[str]) -> DataFrame:
    """One row: rows, and how many of them know a day later than their as-of date."""
    late = reduce(lambda a, b: a | b, (F.coalesce(F.col(c) > F.col(asof), F.lit(False)) for c in seen))
    return panel.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("n_late"))
