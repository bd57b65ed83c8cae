"""Sheet-shaped grids of text columns (SH1-SH5)."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_num

DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MMM-yy")


def dedup_columns(names: list[str | None]) -> list[str]:
    """Single spaces, stripped; blank names become ``col``; repeats get ``__2``, ``__3``.."""
    seen: Counter = Counter()
    out = []
    for name in names:
        clean = re.sub(r"\s+", " ", (name or "").replace("\xa0", " ")).strip() or "col"
        seen[clean] += 1
        out.append(clean if seen[clean] == 1 else f"{clean}__{seen[clean]}")
    return out


def promote_header(df: DataFrame, row_id: str, markers: list[str], within: int = 50) -> DataFrame:
    """The rows below the first row (of the first ``within``) that holds all markers, named by that row.

    Only that one header row comes to the driver.
    """
    cells = [c for c in df.columns if c != row_id]
    trimmed = F.array(*(F.trim(F.col(c)) for c in cells))
    first = df.agg(F.min(row_id)).first()[0]
    head = df.where(F.col(row_id) < (first or 0) + within)
    for marker in markers:
        head = head.where(F.array_contains(trimmed, marker))
    row = head.orderBy(row_id).limit(1).collect()
    if not row:
        raise ValueError(f"no header row with {markers}")
    names = dedup_columns([row[0][c] for c in cells])
    return df.where(F.col(row_id) > row[0][row_id]).select(row_id, *(F.col(c).alias(n) for c, n in zip(cells, names, strict=True)))


def parse_date(text):
    """The first of the four date formats that fits."""
    return F.coalesce(*(F.try_to_date(text, fmt) for fmt in DATE_FORMATS))


def unpivot_dates(df: DataFrame, id_cols: list[str]) -> DataFrame:
    """Melt the columns whose names are dates: ``id_cols, day, value`` (unreadable values are null)."""
    dated = [c for c in df.columns if c not in id_cols and re.match(r"\s*(\d{4}-\d\d?-\d\d?|\d\d?/\d\d?/\d{4}|\d\d?-[A-Za-z]{3}-\d\d)", c)]
    long = df.unpivot([F.col(f"`{c}`") for c in id_cols], [F.col(f"`{c}`") for c in dated], "__name", "__value")
    return long.select(*id_cols, parse_date(F.regexp_extract(F.trim("__name"), r"^(\S+)", 1)).alias("day"), to_num("__value").alias("value"))


def coerce_columns(df: DataFrame, prefer_text: list[str] = ()) -> DataFrame:
    """Text columns become numbers if each of their non-blank values is one."""
    texts = [c for c, t in df.dtypes if t == "string" and c not in prefer_text]
    if not texts:
        return df
    bad = df.agg(*(F.count_if(F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "") & to_num(F.col(f"`{c}`")).isNull()).alias(f"b{i}") for i, c in enumerate(texts))).first()
    return df.withColumns({c: to_num(F.col(f"`{c}`")) for i, c in enumerate(texts) if bad[i] == 0})


def exclude_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Without footer and label rows; null stays."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(values))
