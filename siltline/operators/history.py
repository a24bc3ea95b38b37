"""Time series of entities.

A history row is one notification: ``tenant, entity_id, …, time_index`` and a column
per attribute, NULL where the notification did not carry it.  ``seq`` orders the
rows of an entity without ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltline import scratch
from siltline.operators.keys import number_by_key

# Rows of one entity that may be sorted in one task.
ROWS_PER_CHUNK = 4_000_000
# Rows of the sample that the borders of chunks are taken from, for each chunk.
CUT_SAMPLE = 200
# Up to this many chunks borders are taken from a sample; for more the rows are numbered.
MOST_CUTS = 1_000
# Up to this n, the rows kept per entity and scan task can be ranked in one round.
SINGLE_ROUND_N = 32
# The borders of entities are broadcast up to this size; one takes BORDER_BYTES and the text of its keys.
BROADCAST_BYTES = 64 * 1024 * 1024
BORDER_BYTES = 128


def in_range(
    history: DataFrame, time: str, from_time: Column | None = None, to_time: Column | None = None
) -> DataFrame:
    """Rows within a closed time range; either end may be open."""
    if from_time is not None:
        history = history.filter(F.col(time) >= from_time)
    if to_time is not None:
        history = history.filter(F.col(time) <= to_time)
    return history


def latest_page(history: DataFrame, time: str, seq: str, size: int = 20) -> DataFrame:
    """The newest rows of all entities."""
    return history.orderBy(F.desc(time), F.desc(seq)).limit(size)


def attribute_series(
    history: DataFrame, entity: Column, time: str, seq: str, attribute: Column, name: str
) -> DataFrame:
    """(time, value) of one attribute of the entity selected, oldest first."""
    rows = history.filter(entity).select(
        F.col(time).alias("time"), attribute.alias(name), F.col(seq).alias("_seq")
    )
    return rows.orderBy("time", "_seq").drop("_seq")


def last_n(
    history: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int | None = None
) -> DataFrame:
    """The n newest rows of every entity by ``order`` (latest first, no ties).

    Every scan task keeps n rows per entity before anything is shuffled, so the last
    step meets at most n rows per scan task, however many the entity has.  For a larger
    n that is still too much for one task: then a first round ranks groups of scan
    tasks, and the last one meets ``n * salts`` rows.  The salt decides only where a
    row is ranked, never whether it is kept.
    """
    newest = [F.desc(c) for c in order]
    if salts is None:
        salts = 1 if n <= SINGLE_ROUND_N else 256
    if salts == 1:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        return history.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    salted = history.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    per_salt = Window.partitionBy(*keys, "_salt").orderBy(*newest)
    per_key = Window.partitionBy(*keys).orderBy(*newest)
    return (
        salted.withColumn("_rank", F.row_number().over(per_salt))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(per_key))
        .filter(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def last_n_by_bucket(
    history: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, bucket: Column
) -> DataFrame:
    """The n newest rows of every entity by ``order`` (latest first, no ties), for a large n.

    ``bucket`` never falls as ``order[0]`` grows: the hour of a time, say, and NULL where that is.
    Rows are counted per entity and bucket; running sums, newest first, give the bucket that the
    n-th row is in.  Newer buckets are kept as they are, without a shuffle, and only the rows of that
    one bucket are ranked.  A task meets the rows of one entity and bucket, and a count for each
    bucket of an entity, whatever n is.  The borders are written when this is called.
    """
    if n < 1:
        return history.filter(F.lit(False))
    spark, rows = history.sparkSession, history.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_bucket"))
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = F.col("_so_far") - F.col("_n")
    path = scratch.new_path(spark, "borders")
    counts.withColumn("_so_far", F.sum("_n").over(so_far)).filter((above < n) & (F.col("_so_far") >= n)).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_bucket").alias("_border"), (n - above).alias("_need")
    ).write.parquet(path)
    borders = spark.read.parquet(path)

    text = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"_of_{k}").cast("string")), F.lit(0)) for k in keys])
    size = borders.agg(F.coalesce(F.sum(text + BORDER_BYTES), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        borders = F.broadcast(borders)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    joined = rows.join(borders, same, "left")
    at, border, need = F.col("_bucket"), F.col("_border"), F.col("_need")
    newer = need.isNull() | F.coalesce(at > border, at.isNotNull() & border.isNull())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    ranked = joined.filter(need.isNotNull() & at.eqNullSafe(border)).withColumn("_rank", rank)
    return joined.filter(newer).select(*history.columns).unionByName(
        ranked.filter(F.col("_rank") <= need).select(*history.columns)
    )


def entity_history(
    history: DataFrame,
    entity: Column,
    time: str,
    seq: str,
    from_time: Column | None = None,
    to_time: Column | None = None,
    last: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """History of one entity: time range, newest ``last`` rows, row limit, oldest first."""
    rows = in_range(history.filter(entity), time, from_time, to_time)
    bounds = [b for b in (last, limit) if b is not None]
    if bounds:
        rows = latest_page(rows, time, seq, min(bounds))
    return rows.orderBy(time, seq)


def _with_rank_chunk(history: DataFrame, keys: Sequence[str], seq: str, rows_per_chunk: int) -> DataFrame:
    """Add ``_chunk``, a number that grows with seq, of ``rows_per_chunk`` rows each.

    The rows are written once in the order of seq and numbered by file, so nothing that grows with
    the number of chunks meets in one task or the driver.
    """
    short = {c: f"_{i}" for i, c in enumerate(history.columns)}
    rows = history.withColumnsRenamed(short)
    rows = number_by_key(history.sparkSession, rows, [short[c] for c in (seq, *keys)], "_rank", first=0)
    chunk = F.floor(F.col("_rank") / rows_per_chunk).alias("_chunk")
    return rows.select(*[F.col(new).alias(c) for c, new in short.items()], chunk)


def _with_chunk(history: DataFrame, seq: str, n_rows: int, chunks: int) -> DataFrame:
    """Add ``_chunk``, a number that grows with seq and splits the rows about evenly.

    The cuts come from a sample by hash of about ``CUT_SAMPLE`` rows for each chunk, so
    they are the same on every run and the sketch stays small however many tasks scan.
    """
    every = max(1, n_rows // (CUT_SAMPLE * chunks))
    sample = history.filter(F.pmod(F.xxhash64(seq), F.lit(every)) == 0)
    points = [i / chunks for i in range(1, chunks)]
    cuts = sample.agg(F.percentile_approx(seq, points, 10 * chunks)).first()[0] or []
    if not cuts:  # the sample met no row: one chunk
        return history.withColumn("_chunk", F.lit(0.0))
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    return Bucketizer(splits=splits, inputCol=seq, outputCol="_chunk").transform(history)


def forward_fill(
    history: DataFrame,
    keys: Sequence[str],
    seq: str,
    columns: Sequence[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Fill NULLs with the entity's last known value, giving the full row at each seq.

    Where no entity has more rows than a chunk, the table is filled entity by entity.
    Otherwise the rows are cut into chunks of seq; the last values of each chunk are
    aggregated, carried over the chunks and put before the first row of the next one;
    each chunk is then filled on its own.  No task sorts more than a chunk of an
    entity.  ``seq`` must be a number and not NULL.  Counts the rows when called; for more than
    ``MOST_CUTS`` chunks it writes them as well, in the order of seq, as a sketch of that many
    borders would no longer be small.
    """

    def filled(rows: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
        so_far = (
            Window.partitionBy(*groups)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})

    sizes = history.groupBy(*keys).agg(F.count("*").alias("n"))
    n_rows, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    if not n_rows or largest <= rows_per_chunk:
        return filled(history, keys, [F.asc(seq)])

    chunks = -(-n_rows // rows_per_chunk)
    if chunks > MOST_CUTS:
        rows = _with_rank_chunk(history, keys, seq, rows_per_chunk)
    else:
        rows = _with_chunk(history, seq, n_rows, chunks)
    ends = rows.groupBy(*keys, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys,
        "_chunk",
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in columns],
        F.lit(True).alias("_carried"),
    )
    both = rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    done = filled(both, [*keys, "_chunk"], [F.desc("_carried"), F.asc(seq)])
    return done.filter(~F.col("_carried")).select(*history.columns)
