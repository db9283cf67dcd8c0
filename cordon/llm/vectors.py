"""Exact integer arithmetic on vectors (numpy inside tasks).

Integer matrices are multiplied by float64 BLAS without rounding: integers are
broken into limbs small enough that no sum of limb products reaches 2^53, the
limb products are recombined in int64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components at or beyond this size could overflow 64-bit squared distances.
LIMIT = 1 << 27


def finite(vector: str) -> Column:
    """The vector is not null, and neither null nor infinite nor NaN anywhere."""
    inside = F.forall(F.col(vector), lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & inside


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors of ``width`` finite components, as int64."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    x = np.floor(flat * scale)
    if x.size and np.abs(x).max() >= LIMIT:
        raise ValueError(f"a component is {LIMIT // scale} or more in size: its squared distances do not fit 64 bits")
    return x.astype(np.int64)


def limb_bits(inner: int) -> int:
    """Bits of a limb such that ``inner`` products of two limbs add up to at most 2^53."""
    return (53 - max(inner - 1, 0).bit_length()) // 2


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """``a`` as a sum of limbs[i] << (bits * i), as float64; all but the last are
    in [0, 2^bits), the last one is signed and smaller in size than 2^bits."""
    out = []
    while a.size and max(int(a.max()), -int(a.min())) >= 1 << bits:
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a = a >> bits
    return [*out, a.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact."""
    bits = limb_bits(a.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of every row to every entry, int64."""
    return (x * x).sum(1)[:, None] - 2 * exact_dot(x, entries) + (entries * entries).sum(1)[None, :]
