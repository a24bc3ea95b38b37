"""Statistics over repeated runs: rows of (analysis, method, seconds), NULL when a run failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def run_stats(runs: DataFrame, digits: int = 6) -> DataFrame:
    """Mean and sample deviation per analysis and method; deviation 0 for a single run."""
    spread = F.when(F.count("seconds") > 0, F.coalesce(F.stddev_samp("seconds"), F.lit(0.0)))
    return runs.groupBy("analysis", "method").agg(
        F.round(F.avg("seconds"), digits).alias("avg_time_seconds"),
        F.round(spread, digits).alias("std_dev_seconds"),
        F.count("*").alias("n_runs"),
    )


def fastest(stats: DataFrame) -> DataFrame:
    """The method with the lowest mean per analysis; equal means by name."""
    done = stats.filter(F.col("avg_time_seconds").isNotNull())
    rank = F.struct("avg_time_seconds", "method")
    return done.groupBy("analysis").agg(
        F.min_by("method", rank).alias("fastest_method"),
        F.min("avg_time_seconds").alias("best_time_seconds"),
    )


def method_totals(stats: DataFrame, digits: int = 6) -> DataFrame:
    """Mean and total over the analyses per method, failed ones left out."""
    done = stats.filter(F.col("avg_time_seconds").isNotNull())
    return done.groupBy("method").agg(
        F.round(F.avg("avg_time_seconds"), digits).alias("mean_seconds"),
        F.round(F.sum("avg_time_seconds"), digits).alias("total_seconds"),
    )


def pivot_methods(stats: DataFrame, methods: Sequence[str] | None = None) -> DataFrame:
    """One row per analysis, one column per method; NULL where it did not finish.

    The methods are those that occur; a list gives their order and must have them all.
    """
    if methods is not None:
        others = stats.where(~F.col("method").isin(list(methods))).select("method").distinct()
        missing = sorted(row.method for row in others.limit(10).collect())
        if missing:
            raise ValueError(f"methods that are not listed: {missing}")
    grouped = stats.groupBy("analysis")
    pivoted = grouped.pivot("method") if methods is None else grouped.pivot("method", list(methods))
    return pivoted.agg(F.max("avg_time_seconds"))
