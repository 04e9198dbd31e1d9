"""Integer vectors from a table of embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def integer_vectors(vectors: DataFrame, scale: int, bound: int, width: int | None = None) -> DataFrame:
    """(vec_id, values): every vector without NULL or non-finite components, each component x turned into
    floor(scale * x) and held within ``bound`` both ways; with ``width``, vectors of that length only."""
    x = F.col("embedding")
    whole = x.isNotNull() & F.forall(x, _finite)
    if width is not None:
        whole &= F.size(x) == width
    scaled = F.transform(x, lambda v: _held(F.floor(v.cast("double") * scale), bound))
    return vectors.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("values"))


def _finite(v: Column) -> Column:
    infinite = F.lit(float("inf"))
    return F.coalesce((F.abs(v.cast("double")) < infinite) & ~F.isnan(v.cast("double")), F.lit(False))


def _held(v: Column, bound: int) -> Column:
    return F.least(F.greatest(v, F.lit(-bound)), F.lit(bound)).cast("int")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of integer lists; shorter ones are filled with zeros."""
    lengths = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are not NULL) of a column of longs."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
