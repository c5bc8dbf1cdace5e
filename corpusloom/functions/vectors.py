"""Vector arithmetic in columns. Double precision; scores are rounded once and ranked as rounded."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def doubles(v) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """Null for a zero vector."""
    return F.round(dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0)), DIGITS)


# ---- The same over batches in NumPy -----------------------------------------------------------------


def whole(v: str) -> Column:
    """v; or an empty vector, whose scores are null as well, where v or one of its elements is null."""
    return F.when(F.forall(v, lambda x: x.isNotNull()), F.col(v)).otherwise(F.array().cast("array<double>"))


def norms(x: np.ndarray) -> np.ndarray:
    """``norm`` of each row, with the sums in the same order."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * x[:, k]
    return np.sqrt(total)


def cosines(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``cosine`` of the rows of x and y by pairs, to the last bit; and which of them are null."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    null = nx * ny == 0
    score = total / np.where(null, 1.0, nx * ny)
    scaled = score * 10.0**DIGITS
    rounded = np.rint(scaled) / 10.0**DIGITS + 0.0
    for i in np.flatnonzero(np.abs(np.abs(scaled - np.floor(scaled)) - 0.5) < 1e-5):
        rounded[i] = float(Decimal(repr(float(score[i]))).quantize(Decimal(1).scaleb(-DIGITS), ROUND_HALF_UP)) + 0.0
    return rounded, null
