"""Dimension checks and fact-to-dimension revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltline.functions.numeric import money_of, money_units, not_finite


# Facts by key and time are nearly as many groups as rows; of these (by Spark's estimate) a task groups so much.
GROUPED_BYTES = 1024 * 1024
MOST_TASKS = 20_000
UNKNOWN_BYTES = 2**62  # Spark estimates at least so much where it does not know the size


def constraint_violations(dim: DataFrame, key: str, not_null: Sequence[str] = ()) -> DataFrame:
    """One row: number of rows, duplicate keys, NULL keys and NULLs per required column."""
    per_key = dim.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
    )
    present = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(present & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_keys"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null],
    )


def require_valid(dim: DataFrame, key: str, not_null: Sequence[str] = ()) -> DataFrame:
    """Run the check and raise if the dimension would multiply or lose facts."""
    found = constraint_violations(dim, key, not_null).first().asDict()
    bad = {name: n for name, n in found.items() if name != "n_rows" and n}
    if bad:
        raise ValueError(f"dimension key {key}: {bad}")
    return dim


def _dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows dealt by their group to tasks of about ``GROUPED_BYTES``, if there are more than run at once."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(MOST_TASKS, -(-size // GROUPED_BYTES))
    few = tasks <= rows.sparkSession.sparkContext.defaultParallelism
    return rows if few or size >= UNKNOWN_BYTES else rows.repartition(tasks, *by)


def revenue_by_attributes(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    attributes: dict[str, str],
    amount: str,
    time_key: Column | None = None,
    revenue: str = "total_revenue",
) -> DataFrame:
    """Revenue per dimension attributes (and time), facts without a dimension row dropped.

    The facts are added up per key before the join: the join then sees each key once
    (once per time key), however many facts it has.  Grouping is by the attributes, so
    keys that share them are merged.  With a time key adding up before the shuffle saves little and
    holds the groups of a whole split of the scan; so larger facts are dealt by key and time first,
    to tasks whose number grows with the facts.  The facts of one key and time meet in one task.
    """
    by = [fact_key]
    if time_key is not None:
        by = ["time_key", fact_key]
        fact = _dealt(fact.select(time_key.alias("time_key"), fact_key, amount), by)
    partial = fact.groupBy(*by).agg(
        F.sum(money_units(F.col(amount))).alias("amount"), F.sum(not_finite(F.col(amount))).alias("not_finite")
    )
    names = dim.select(
        F.col(dim_key).alias("dim_key"), *[F.col(c).alias(n) for c, n in attributes.items()]
    )
    joined = partial.join(names, F.col(fact_key) == F.col("dim_key"))
    group = [*([] if time_key is None else ["time_key"]), *attributes.values()]
    total = F.coalesce(F.sum("not_finite"), money_of(F.sum("amount")))
    return joined.groupBy(*group).agg(total.alias(revenue))
