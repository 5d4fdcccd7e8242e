"""Cutting rows into pieces by the order of their ids, so that no task holds them all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_points(docs: DataFrame, column: str = "doc_id") -> np.ndarray:
    """Ids at which pieces begin: about as many equal pieces as there are shuffle partitions."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if n == 1:
        return np.zeros(0, dtype=np.int64)
    shares = [k / n for k in range(1, n)]
    row = docs.agg(F.percentile_approx(column, shares, 100 * n).alias("p")).first()
    return np.unique(np.array(row.p or [], dtype=np.int64))


def pieces_of(ids: pa.Array, points: np.ndarray) -> np.ndarray:
    """The piece of each id; rows without an id are in the first."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    found = np.searchsorted(points, values, side="right").astype(np.int32)
    found[ids.is_null().to_numpy(zero_copy_only=False)] = 0
    return found
