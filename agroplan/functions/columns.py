"""Scalar expressions: text and number cleaning, calendar keys, units, corrections (PJ1-PJ18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canon_str(c: Column | str, default: str | None = None) -> Column:
    """Trimmed, upper-cased text with single spaces; non-breaking spaces count; blank is ``default``."""
    clean = F.upper(F.trim(F.regexp_replace(_c(c), r"[\s\x{00A0}]+", " ")))
    clean = F.when(clean == "", None).otherwise(clean)
    return clean if default is None else F.coalesce(clean, F.lit(default))


def to_num(c: Column | str) -> Column:
    """Double from text with spaces and a decimal comma; null where it is none."""
    return F.regexp_replace(F.regexp_replace(_c(c).cast("string"), r"[\s\x{00A0}]+", ""), ",", ".").try_cast("double")


def extract_int(c: Column | str, mode: str = "first") -> Column:
    """First integer, ``all`` digits joined, or ``leading`` digits of mixed text."""
    text = _c(c).cast("string")
    if mode == "all":
        digits = F.regexp_replace(text, r"[^0-9]", "")
    else:
        digits = F.regexp_extract(text, r"^\s*([0-9]+)" if mode == "leading" else r"([0-9]+)", 1)
    return digits.try_cast("long")


def map_values(c: Column | str, mapping: dict, keep_others: bool = True) -> Column:
    """Dictionary lookup; other values pass through or become null."""
    c = _c(c)
    if not mapping:
        return c if keep_others else F.lit(None).cast("string")
    found = F.try_element_at(F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv)), c)
    return F.coalesce(found, c) if keep_others else found


def classify(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds."""
    out = None
    for condition, label in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def safe_div(a: Column | str, b: Column | str, default: float | None = None) -> Column:
    """a / b where b > 0, else ``default``."""
    return F.when(_c(b) > 0, _c(a) / _c(b)).otherwise(F.lit(default))


def clip(c: Column | str, lo=None, hi=None) -> Column:
    """Hard bounds; null stays null."""
    c = out = _c(c)
    if hi is not None:
        out = F.least(out, F.lit(hi) if not isinstance(hi, Column) else hi)
    if lo is not None:
        out = F.greatest(out, F.lit(lo) if not isinstance(lo, Column) else lo)
    return F.when(c.isNotNull(), out)


def coalesce_cols(df: DataFrame, out: str, candidates: list[str], kind: str = "double") -> DataFrame:
    """First non-null of the candidates that exist (case-insensitive names); null if none does."""
    have = {name.lower(): name for name in df.columns}
    found = [F.col(have[c.lower()]) for c in candidates if c.lower() in have]
    return df.withColumn(out, F.coalesce(*found) if found else F.lit(None).cast(kind))


def add_calendar(df: DataFrame, col: str) -> DataFrame:
    """``dow`` (Monday 0), ``month``, ISO ``week``, ``doy`` and ``year`` of a date column."""
    d = F.col(col)
    return df.withColumns({"dow": F.weekday(d), "month": F.month(d), "week": F.weekofyear(d), "doy": F.dayofyear(d), "year": F.year(d)})


def week_key(c: Column | str, kind: str = "iso", shift: int = 0) -> Column:
    """``iso``: YYWW of the ISO year; ``yyww_mixed``: calendar year with ISO week; ``sunday``: week 1.. from the first Sunday (0 counts as 1)."""
    d = F.date_add(_c(c).cast("date"), shift)
    if kind == "sunday":
        return F.greatest(F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7), F.lit(1)).cast("int")
    year = F.extract(F.lit("YEAROFWEEK"), d) if kind == "iso" else F.year(d)
    return ((year % 100) * 100 + F.weekofyear(d)).cast("int")


def trunc_ts(c: Column | str, unit: str = "hour") -> Column:
    return F.to_date(_c(c)) if unit == "day" else F.date_trunc(unit, _c(c))


def days_between(a: Column | str, b: Column | str, inclusive: bool = False) -> Column:
    """Days from a to b."""
    return F.datediff(_c(b), _c(a)) + (1 if inclusive else 0)


def to_boxes(kg: Column | str, kg_per_box: float = 10.0) -> Column:
    return _c(kg) / kg_per_box


def grams_to_kg(g: Column | str) -> Column:
    return _c(g) / 1000.0


def watt_hours_to_joules(mean_watt: Column | str) -> Column:
    """J/m2 of an hour from its mean W/m2."""
    return _c(mean_watt) * 3600.0


def degree_day(temp: Column | str, base: float = 7.1) -> Column:
    return F.when(_c(temp).isNotNull(), F.greatest(_c(temp) - base, F.lit(0.0)))


def encode_corr(y: Column | str, p: Column | str, mode: str = "log", eps: float = 1e-6) -> Column:
    """Correction that turns a prediction p into y: log-ratio, or difference for ``add``."""
    return _c(y) - _c(p) if mode == "add" else F.log((_c(y) + eps) / (_c(p) + eps))


def apply_corr(p: Column | str, corr: Column | str, mode: str = "log", eps: float = 1e-6) -> Column:
    """Inverse of :func:`encode_corr`."""
    return _c(p) + _c(corr) if mode == "add" else (_c(p) + eps) * F.exp(_c(corr)) - eps


def factor_from_pct(c: Column | str, limit: float = 3.5) -> Column:
    """1 + x; values beyond ``limit`` are percent."""
    x = _c(c)
    return F.lit(1.0) + F.when(F.abs(x) > limit, x / 100.0).otherwise(x)


def content_id(*cols: Column | str, sep: str = "|") -> Column:
    """SHA-1 of the columns' texts; null counts as empty."""
    return F.sha1(F.concat_ws(sep, *(F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols)))


def row_key(*cols: Column | str) -> Column:
    """64-bit hash of key columns."""
    return F.xxhash64(*(_c(c) for c in cols))


def infer_unit(df: DataFrame, col: str, plausible: float, ratio: float = 1000.0) -> DataFrame:
    """Rescale a column by ``ratio`` if the whole table's median lies beyond ``plausible`` (grams given for kg)."""
    from ..operators.order import quantiles

    scale = quantiles(df, [], col, (0.5,)).select((F.when(F.col("q")[0] > plausible, F.lit(1.0 / ratio)).otherwise(F.lit(1.0))).alias("__scale"))
    return df.crossJoin(F.broadcast(scale)).withColumn(col, F.col(col) * F.col("__scale")).drop("__scale")  # one row


def nan_to_null(c: Column | str) -> Column:
    """NaN as null."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))
