"""A layout in which lookups on each of several columns skip most of a table.

Sorting by (a, b) lets statistics prune on a alone.  Here each column is cut into ranges of equal
numbers of rows, the bits of the range numbers are interleaved, and the table is sorted by that: a
row group has narrow ranges of all the columns.  Columns without an order worth keeping get Bloom
filters, one for each row group.  Both are plain Parquet, and any reader may use them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from siltline.sinks import layouts

BITS = 8  # of the range number of a column
# Values that are looked up by equality at the scan; more of them are joined.
MOST_VALUES = 256

_INTERLEAVED = "_interleaved"


def range_borders(df: DataFrame, by: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Borders between ranges of about equal numbers of rows: 2^bits - 1 values at most a column.

    One pass that is aggregated before the shuffle.  Borders need not be exact: they decide where a
    row is, not what it says.
    """
    for c in by:
        kind = df.schema[c].dataType
        if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
            raise ValueError(f"{c} is {kind.simpleString()}; only numbers, dates and times have ranges")
    shares = [k / 2**bits for k in range(1, 2**bits)]

    def ordered(c: str) -> Column:
        kind = df.schema[c].dataType
        return F.col(c).cast("timestamp") if isinstance(kind, TimestampNTZType) else F.col(c)

    found = df.agg(*[F.percentile_approx(ordered(c), shares).alias(c) for c in by]).first()
    return {c: sorted({x for x in found[c] or [] if x == x}) for c in by}


def range_number(column: Column, borders: list, bits: int = BITS) -> Column:
    """How many of the sorted borders are less than the value, by bisection; 0 for NULL."""
    if not borders:
        return F.lit(0)
    values = F.array(*[F.lit(x) for x in borders])

    def step(at: Column, k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), k)
        return at + F.when(F.get(values, at + size - 1) < column, size).otherwise(0)

    steps = F.array(*[F.lit(k) for k in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), step)


def interleave(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the numbers in turn, the highest first, as one number."""
    if len(numbers) * bits > 63:
        raise ValueError(f"{len(numbers)} columns of {bits} bits do not fit into a number")
    taken = [F.shiftright(n, k).bitwiseAND(F.lit(1)).cast("bigint") for k in reversed(range(bits)) for n in numbers]
    return reduce(lambda z, bit: z * 2 + bit, taken)


def write_interleaved(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    unique: Sequence[str] = (),
    bloom: Mapping[str, int] | None = None,
    row_group_bytes: int | None = None,
    source_bytes: int = 0,
    bits: int = BITS,
) -> None:
    """Overwrite ``path`` with files whose row groups are narrow in all the columns ``by``.

    ``unique`` breaks ties, so that a frequent value can span several files.  ``bloom`` names columns
    with the number of distinct values that a row group is expected to have.  NULLs go to the first
    range; rows and columns are as before.  ``df`` is read twice.
    """
    if _INTERLEAVED in df.columns:
        raise ValueError(f"a column is named {_INTERLEAVED}")
    borders = range_borders(df, by, bits)
    place = interleave([range_number(F.col(c), borders[c], bits) for c in by], bits)
    order = [_INTERLEAVED, *by, *[c for c in unique if c not in by]]
    placed = df.withColumn(_INTERLEAVED, place)
    wanted = -(-source_bytes // layouts.RANGE_BYTES)
    if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ranged = placed.repartitionByRange(wanted, *order)
    else:
        ranged = placed.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).drop(_INTERLEAVED).write.mode("overwrite")
    for column, distinct in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def rows_with_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The rows that have one of the values, NULL never being one.

    Up to ``MOST_VALUES`` are compared one by one, as only equality is checked with dictionaries and
    Bloom filters, and row groups without them are not read.  More are joined.
    """
    values = sorted({v for v in values if v is not None})
    if not values:
        return df.filter(F.lit(False))
    if len(values) > MOST_VALUES:
        kind = df.schema[column].dataType
        keys = df.sparkSession.createDataFrame([(v,) for v in values], [column]).select(F.col(column).cast(kind))
        return df.join(keys, column, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])

    def either(some: list) -> Column:  # balanced, so that many values do not nest deeply
        half = len(some) // 2
        return F.col(column) == F.lit(some[0]) if len(some) == 1 else either(some[:half]) | either(some[half:])

    return df.filter(either(values))
