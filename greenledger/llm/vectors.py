"""Integer vectors of an embedding column, for the operators that compare them exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Largest integer component: squared distances of 512 components then fit a long.
LIMIT = 1 << 26


def usable(vector) -> F.Column:
    """True for a vector without null or non-finite components (an empty or null one isn't usable)."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & (F.size(vector) > 0), F.lit(False))


def as_integers(values, scale: int) -> np.ndarray:
    """floor(scale * x) of each x, as int64."""
    x = np.floor(scale * np.asarray(values, np.float64))
    if x.size and np.abs(x).max() > LIMIT:
        raise ValueError(f"a component times {scale} is beyond {LIMIT}: squared distances would not fit a long")
    return x.astype(np.int64)


def integer_rows(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are kept, their integer vectors): rows of ``dims`` finite components."""
    kept = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False).to_numpy(zero_copy_only=False).copy()
    flat = column.filter(pa.array(kept)).flatten()
    if flat.null_count:
        flat = pc.fill_null(flat, float("nan"))
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    sound = np.isfinite(x).all(1)
    kept[kept] = sound
    return kept, as_integers(x[sound], scale)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, exact."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)
