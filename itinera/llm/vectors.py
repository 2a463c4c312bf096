"""Vectors in tasks: which of them take part, and equal vectors taken together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, label: str | None = None) -> DataFrame:
    """(vec_id, label, vec): the components as little-endian doubles; null if the vector takes no part (null, empty, zero,
    or holding null or non-finite components)."""
    chosen = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col(label) if label else F.lit(None)).cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            out = []
            for x in lists:
                values = x.values
                if values is None or not len(values) or values.null_count:
                    out.append(None)
                    continue
                v = values.to_numpy(zero_copy_only=False)
                v = v + 0.0  # one zero
                out.append(v.astype("<f8").tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "vec"])

    return chosen.mapInArrow(run, "vec_id long, label string, vec binary")


def matrix(vecs: list[bytes]) -> np.ndarray:
    """Rows of equally long vectors."""
    if not vecs:
        return np.zeros((0, 0))
    if len({len(v) for v in vecs}) > 1:
        raise ValueError("vectors of different lengths cannot be compared")
    return np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), -1)
