"""Concatenation of frames with the same columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def concat(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name; differing columns are an error."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def concat_filtered(frames: Sequence[DataFrame], keep: Column) -> DataFrame:
    """Filter every frame, then concatenate; the filter reaches each scan."""
    return concat([frame.filter(keep) for frame in frames])
