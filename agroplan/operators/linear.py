"""Linear models from sums: masked targets in one scan (MD13), interactions and scenario marginals (MD20).

Only p x p sums leave the executors, whatever the rows: each fit is a small solve on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct values that a column of dummies may have.
MOST_LEVELS = 200


# --- many targets, each with a mask --------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """Coefficients (the first is the intercept) of a target, and the rows and weight behind it."""

    coefficients: tuple[float, ...]
    n: int
    weight: float


def fit_targets(df: DataFrame, targets: dict[str, str], xs: list[str], ridge: float = 0.0) -> dict[str, Fit]:
    """Weighted least squares of every target (name -> weight column) on the same features, from one scan.

    A row counts for the targets that it has, with a weight above 0: the sums of features are taken per
    target's mask. Rows that lack a feature count for none. ``ridge`` is added to the features' sums of
    squares about their means, in parts of them. A target without rows is not returned; a feature that
    is constant, or the same as others, gets the smallest solution.
    """
    known = df.na.drop(subset=xs)
    x = [F.col(c).cast("double") for c in xs]
    cells = F.array(*(F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y"), F.col(w).cast("double").alias("w")) for t, w in targets.items()))
    long = known.select(*(c.alias(f"__x{i}") for i, c in enumerate(x)), F.inline(cells)).where("y is not null and w > 0")
    v = [F.lit(1.0), *(F.col(f"__x{i}") for i in range(len(xs))), F.col("y")]
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v)) if i < len(v) - 1]
    sums = long.groupBy("target").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("w") * v[i] * v[j]).alias(f"s{i}_{j}") for i, j in pairs)).collect()  # a row for each target
    out = {}
    for r in sums:
        gram = np.zeros((len(v), len(v)))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = r[f"s{i}_{j}"]
        weight, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
        about = gram[1:, 1:] - weight * np.outer(mean, mean)
        a = about[:-1, :-1] + ridge * np.diag(np.diag(about)[:-1])
        b = np.linalg.lstsq(a, about[:-1, -1], rcond=1e-12)[0] if xs else np.zeros(0)
        out[r["target"]] = Fit((float(mean[-1] - b @ mean[:-1]), *map(float, b)), r["n"], float(weight))
    return out


def predict_targets(df: DataFrame, fits: dict[str, Fit], xs: list[str], prefix: str = "pred_") -> DataFrame:
    """``pred_<target>`` of every fit, in one projection."""
    return df.withColumns({f"{prefix}{t}": sum((F.lit(b) * F.col(c) for b, c in zip(f.coefficients[1:], xs, strict=True)), F.lit(f.coefficients[0])) for t, f in fits.items()})


# --- ordinary least squares with robust errors -----------------------------------------------------


@dataclass(frozen=True)
class Ols:
    """Names, coefficients and their HC3 covariance; rows and the fit's R2 (plain and adjusted)."""

    names: tuple[str, ...]
    beta: np.ndarray
    covariance: np.ndarray
    n: int
    r2: float
    r2_adj: float

    def table(self) -> list[tuple[str, float, float, float, float]]:
        """``(term, coefficient, error, z, p)``; p is two-sided and normal."""
        errors = np.sqrt(np.diag(self.covariance))
        z = [b / e if e > 0 else math.nan for b, e in zip(self.beta, errors, strict=True)]
        return [(n, float(b), float(e), float(t), math.erfc(abs(t) / math.sqrt(2))) for n, b, e, t in zip(self.names, self.beta, errors, z, strict=True)]


def dummies(df: DataFrame, col: str, prefix: str) -> tuple[DataFrame, list[str]]:
    """Indicator columns of all levels but the first (by name); null is the level UNKNOWN."""
    level = F.coalesce(F.col(col).cast("string"), F.lit("UNKNOWN"))
    levels = sorted(r[0] for r in df.select(level.alias("l")).distinct().limit(MOST_LEVELS + 1).collect())
    if len(levels) > MOST_LEVELS:
        raise ValueError(f"{col} has more than {MOST_LEVELS} levels")
    names = [f"{prefix}_{v}" for v in levels[1:]]
    return df.withColumns({n: (level == v).cast("double") for n, v in zip(names, levels[1:], strict=True)}), names


def interactions(df: DataFrame, left: list[str], right: list[str]) -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """Products of every left with every right column; ``{(left, right): name}``."""
    names = {(a, b): f"int__{a}__x__{b}" for a in left for b in right}
    return df.withColumns({n: F.col(a).cast("double") * F.col(b).cast("double") for (a, b), n in names.items()}), names


def ols(df: DataFrame, y: str, xs: list[str]) -> Ols:
    """Least squares with an intercept and HC3 errors, in two passes over the whole rows."""
    names = ["intercept", *xs]
    ok = df.select(F.lit(1.0).alias("intercept"), *(F.col(f"`{x}`").cast("double").alias(x) for x in xs), F.col(y).cast("double").alias("__y")).na.drop()
    col = [F.col(f"`{n}`") for n in names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]

    def gram(row, at: int) -> np.ndarray:
        m = np.zeros((len(names), len(names)))
        for k, (i, j) in enumerate(pairs):
            m[i, j] = m[j, i] = row[at + k] or 0.0
        return m

    def products(weight: Column) -> list[Column]:
        return [F.sum(col[i] * col[j] * weight) for i, j in pairs]

    first = ok.agg(*products(F.lit(1.0)), *(F.sum(c * F.col("__y")) for c in col), F.count(F.lit(1)), F.var_pop("__y")).first()
    p, n = len(pairs), first[-2]
    inverse = np.linalg.pinv(gram(first, 0))
    beta = inverse @ np.array([first[p + k] or 0.0 for k in range(len(names))])
    fitted = sum((F.lit(float(b)) * c for b, c in zip(beta, col, strict=True)), F.lit(0.0))
    leverage = sum((F.lit(float(inverse[i, j]) * (1 if i == j else 2)) * col[i] * col[j] for i, j in pairs), F.lit(0.0))
    residual = F.col("__y") - fitted
    scaled = residual / F.greatest(1 - leverage, F.lit(1e-9))
    second = ok.agg(*products(scaled * scaled), F.sum(residual * residual)).first()
    spread, left = n * (first[-1] or 0.0), second[-1] or 0.0
    r2 = 1 - left / spread if spread > 0 else math.nan
    adjusted = 1 - (1 - r2) * (n - 1) / (n - len(names)) if n > len(names) else math.nan
    return Ols(tuple(names), beta, inverse @ gram(second, 0) @ inverse, n, r2, adjusted)


def marginals(fit: Ols, left: list[str], names: dict[tuple[str, str], str], mixes: dict[str, dict[str, float]]) -> list[tuple[str, str, float, float]]:
    """``(left, scenario, marginal, error)``: the effect of a left column where the right ones have a scenario's values.

    The effect is its own coefficient plus those of its interactions times the values; its error is that
    of the same combination of coefficients (delta method, exact for a linear one).
    """
    at = {n: i for i, n in enumerate(fit.names)}
    out = []
    for a in left:
        for scenario, mix in mixes.items():
            g = np.zeros(len(fit.names))
            g[at[a]] = 1.0
            for (x, b), name in names.items():
                if x == a:
                    g[at[name]] += mix.get(b, 0.0)
            out.append((a, scenario, float(g @ fit.beta), float(np.sqrt(g @ fit.covariance @ g))))
    return out


def mean_mix(df: DataFrame, cols: list[str], weight: str | None = None) -> dict[str, float]:
    """The columns' (weighted) means, missing values as 0: the average scenario."""
    w = F.col(weight) if weight else F.lit(1.0)
    row = df.agg(*(F.try_divide(F.sum(w * F.coalesce(F.col(c).cast("double"), F.lit(0.0))), F.sum(w)) for c in cols)).first()
    return {c: float(v or 0.0) for c, v in zip(cols, row, strict=True)}
