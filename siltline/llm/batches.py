"""Arrow batches in Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType

ROWS = 512  # that a worker holds at a time


def mapped(
    df: DataFrame, column: str, more: dict[str, DataType], make: Callable[[pa.Array], list[pa.Array]], rows: int = ROWS
) -> DataFrame:
    """``df`` with the arrays that ``make`` derives from ``column`` in its place, in small batches.

    Columns of ``df`` that have the name of a new one are replaced by it.
    """
    names = [c for c in df.columns if c != column and c not in more]
    df = df.select(*[F.col(f"`{c}`") for c in [*names, column]])
    schema = StructType([df.schema[c] for c in names] + [StructField(n, t, False) for n, t in more.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                some = batch.slice(start, rows)
                arrays = [some.column(some.schema.get_field_index(c)) for c in names]
                arrays += make(some.column(some.schema.get_field_index(column)))
                yield pa.RecordBatch.from_arrays(arrays, [*names, *more])

    return df.mapInArrow(run, schema)


def lists(packed: list[bytes]) -> pa.Array:
    """Lists of the 32-bit numbers that each element holds."""
    ends = np.zeros(len(packed) + 1, np.int64)
    np.cumsum([len(p) for p in packed], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array((ends >> 2).astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), "<i4")))
