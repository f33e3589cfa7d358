"""Vectors as integer coordinates, shared by the operators on embeddings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship

SCALE = 256


def usable(vector: Column) -> Column:
    """Not null, and all entries finite numbers."""
    odd = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vector.isNotNull() & ~odd


def dimension(rows: DataFrame) -> int:
    """The length of most vectors ``x`` (of equally many, the longer); 0 if there are none."""
    sizes = rows.groupBy(F.size("x").alias("d")).count().where("d > 0")
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def coordinate_limit(d: int) -> int:
    """Coordinates up to this size have squared distances that fit 64 bits in ``d`` dimensions."""
    return math.isqrt((1 << 61) // max(d, 1))


def scaled(df: DataFrame, *others: str) -> tuple[DataFrame, int]:
    """(others, x) of the rows with a usable vector ``embedding``, and its dimension.

    ``x`` holds ``floor(256 * c)`` as long numbers, limited to ``coordinate_limit``. Vectors of another length
    than ``dimension`` names are no part of the table and are left out.
    """
    vector = F.transform("embedding", lambda e: e.cast("double"))
    rows = pick(df, *others, "embedding").withColumn("embedding", vector).where(usable(F.col("embedding")))
    rows = rows.select(*others, F.transform("embedding", lambda c: F.floor(c * SCALE)).alias("x"))
    d = dimension(rows)
    most = coordinate_limit(d)
    limited = F.transform("x", lambda v: F.greatest(F.least(v, F.lit(most)), F.lit(-most)))
    return rows.where(F.size("x") == d).withColumn("x", limited), d


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of a matrix of 64-bit numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


ship(__name__)
