"""Vectors as the operators of this subpackage carry them: eight-byte numbers in one binary value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` with the list column ``vector`` as binary; null where the list is null, empty, holds a
    null or a number that is not finite, or only zeros. Other columns stay."""
    kept = [c for c in rows.columns if c != vector]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(vector)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            ends = np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
            out, begin = [], 0
            for end in ends.tolist():
                v, begin = values[begin:end], end
                out.append(v.tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.binary())], [*kept, vector])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != vector)
    return rows.select(*[F.col(f"`{c}`") for c in [*kept, vector]]).mapInArrow(pack, f"{ddl}, `{vector}` binary")


def matrix(values) -> np.ndarray:
    """Packed vectors of one width as rows."""
    values = list(values)
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large or small numbers do no harm."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
