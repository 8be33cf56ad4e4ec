"""Integer vectors from doubles, for exact scores."""

from __future__ import annotations

import numpy as np

#: The last value of a 64-bit integer; the first is ``-LAST - 1``.
LAST = (1 << 63) - 1


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit integers, or Python's where these are too small."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if np.abs(scaled).max(initial=0.0) < float(1 << 63):
        return scaled.astype(np.int64)
    exact = [int(s) if np.isfinite(s) else int(v) * scale for s, v in zip(scaled.ravel(), x.ravel())]
    return np.array(exact, object).reshape(x.shape)


def stored(matrix: np.ndarray, x: np.ndarray) -> tuple[str, bytes]:
    """The smallest form that holds the integers; doubles as they were, if none does."""
    if matrix.dtype == object:
        return "x", x.astype("<f8").tobytes()
    top = max(abs(int(matrix.max(initial=0))), abs(int(matrix.min(initial=0))))
    kind = next((k for k in ("<i2", "<i4") if top <= np.iinfo(k).max), "<i8")
    return kind, matrix.astype(kind).tobytes()


def loaded(kind: str, raw: bytes, scale: int) -> np.ndarray:
    return whole(np.frombuffer(raw, "<f8"), scale) if kind == "x" else np.frombuffer(raw, kind).astype(np.int64)


def top_of(matrix: np.ndarray) -> int:
    """The largest size of a component."""
    return max((abs(int(v)) for v in (matrix.max(initial=0), matrix.min(initial=0))), default=0) if matrix.size else 0


def clamped(scores: np.ndarray) -> np.ndarray:
    """Python integers cut to 64 bits; others as they are."""
    if scores.dtype != object:
        return scores
    cut = [min(max(s, -LAST - 1), LAST) for s in scores.ravel()]
    return np.array(cut, np.int64).reshape(scores.shape)
