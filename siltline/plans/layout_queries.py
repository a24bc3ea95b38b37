"""Registry: scans, layouts, compaction, conversion, concatenation, run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import scratch
from siltline.functions import calendar as C
from siltline.operators import combine, keys, runstats
from siltline.plans.inputs import monthly_orders, table
from siltline.sinks import interleaved, layouts
from siltline.sinks.convert import conversion_report, convert_monthly
from siltline.sources import files


def scan_single_file(spark, sf):
    return files.scan_file(spark, f"{sf}/orders.parquet")


def scan_file_list(spark, sf):
    paths = files.scan_tree(spark, monthly_orders(spark, sf)).inputFiles()
    return files.scan_files(spark, sorted(paths))


def scan_glob(spark, sf):
    return files.scan_monthly(spark, monthly_orders(spark, sf), "orders")


def scan_recursive(spark, sf):
    return files.scan_tree(spark, monthly_orders(spark, sf), "*.parquet")


def month_from_path(spark, sf):
    scan = files.scan_tree(spark, monthly_orders(spark, sf))
    month = files.month_in_path(files.file_path())
    return scan.groupBy(month.alias("month")).agg(F.count("*").alias("n_orders"))


def compact_files(spark, sf):
    root = monthly_orders(spark, sf)
    path = scratch.new_path(spark, "compacted")
    scan = files.scan_tree(spark, root)
    return layouts.compact(spark, scan, files.total_bytes(spark, root), path)


def compact_by_size(spark, sf):
    """Two runs over the monthly files; the second one has nothing to write."""
    root, path = monthly_orders(spark, sf), scratch.new_path(spark, "packed")
    target = max(1, files.total_bytes(spark, root) // 3)
    layouts.compact_small(spark, root, path, target)
    return layouts.compact_small(spark, root, path, target)


def compaction_report(spark, sf):
    """Rows of each month's files that are compacted, and of all under a NULL month."""
    report = layouts.compaction_report(files.scan_tree(spark, monthly_orders(spark, sf)))
    month = F.regexp_extract("path", r"_tripdata_(\d{4}-\d{2})", 1)
    rows = report.select(F.when(F.col("path").isNotNull(), month).alias("month"), "n_rows")
    return rows.groupBy("month").agg(F.sum("n_rows").alias("n_rows"))


def _two_layouts(spark, sf):
    """Orders in two folders, of which one lacks the priority."""
    root, orders = scratch.new_path(spark, "two-layouts"), table(spark, sf, "orders")
    early = F.col("o_orderkey") % 2 == 0
    orders.filter(early).drop("o_orderpriority").write.parquet(f"{root}/old")
    orders.filter(~early).write.parquet(f"{root}/new")
    return root


def compact_merged(spark, sf):
    root = _two_layouts(spark, sf)
    scan = files.scan_tree(spark, root, merge=True)
    path = scratch.new_path(spark, "compacted")
    return layouts.compact(spark, scan, files.total_bytes(spark, root), path)


def convert_format(spark, sf):
    return convert_monthly(spark, monthly_orders(spark, sf), scratch.new_path(spark, "converted"))


def conversion_status(spark, sf):
    """What a conversion of the first half of each year has done, and one of the rest would do."""
    root, target = monthly_orders(spark, sf), scratch.new_path(spark, "converted")
    half = scratch.new_path(spark, "half")
    orders = table(spark, sf, "orders").filter(F.month("o_orderdate") <= 6)
    month = C.month_label(C.month_start(F.col("o_orderdate")))
    name = F.concat(F.lit("orders_tripdata_"), month, F.lit(".parquet"))
    layouts.write_partitioned(orders.withColumn("file", name), half, ["file"])
    convert_monthly(spark, half, target)
    return conversion_report(spark, root, target).select("kind", "year", "month", "status")


def write_if_absent(spark, sf):
    """The second write, of no rows, must not change the first."""
    orders, path = table(spark, sf, "orders"), scratch.new_path(spark, "absent")
    layouts.write_if_absent(orders, path)
    layouts.write_if_absent(orders.filter(F.lit(False)), path)
    return spark.read.parquet(path)


def raw_landing(spark, sf):
    raw = scratch.new_path(spark, "raw")
    path = layouts.land_raw(spark, monthly_orders(spark, sf), raw, "orders")
    return spark.read.parquet(path)


def clustered_fact(spark, sf):
    """Orders clustered by (date, customer); read back whole."""
    path = scratch.new_path(spark, "clustered")
    orders = table(spark, sf, "orders")
    layouts.write_clustered(orders, path, ["o_orderdate", "o_custkey"], unique=["o_orderkey"])
    return spark.read.parquet(path)


def lookup_interleaved(spark, sf):
    """Lines of sampled parts, ship days and orders, from a layout that skips by each of the three."""
    lines, path = table(spark, sf, "lineitem"), scratch.new_path(spark, "interleaved")
    unique = ["l_orderkey", "l_linenumber"]
    size = files.total_bytes(spark, f"{sf}/lineitem.parquet")
    interleaved.write_interleaved(
        lines, path, ["l_partkey", "l_shipdate"], unique, {"l_orderkey": 100_000}, source_bytes=size
    )
    laid = spark.read.parquet(path)
    counts = []
    for column in ("l_partkey", "l_shipdate", "l_orderkey"):
        values = [row[0] for row in keys.sample_keys(lines, column, 20).collect()]
        found = interleaved.rows_with_values(laid, column, values).groupBy(F.col(column).cast("string").alias("key"))
        counts.append(found.agg(F.count("*").alias("n_lines")).select(F.lit(column).alias("by"), "key", "n_lines"))
    return combine.concat(counts)


def _yearly_frames(spark, sf):
    root = monthly_orders(spark, sf)
    dates = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    years = sorted(row.year for row in dates.collect())  # a row per year of data
    return [files.scan_monthly(spark, root, "orders", year) for year in years]


def concat_frames(spark, sf):
    return combine.concat(_yearly_frames(spark, sf))


def concat_filtered(spark, sf):
    frames = _yearly_frames(spark, sf)
    sample = keys.sample_keys(table(spark, sf, "orders"), "o_custkey", 50).collect()
    wanted = F.col("o_custkey").isin([row.o_custkey for row in sample])
    return combine.concat_filtered(frames, wanted).groupBy("o_custkey").agg(
        F.count("*").alias("n_orders")
    )


def _runs(spark, sf):
    """Quantities stand for seconds; a run with the highest discount failed."""
    failed = F.col("l_discount") >= 0.095
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("analysis"),
        F.col("l_linestatus").alias("method"),
        F.when(~failed, F.col("l_quantity")).alias("seconds"),
    )


def run_stats(spark, sf):
    return runstats.run_stats(_runs(spark, sf))


def argmin_per_group(spark, sf):
    return runstats.fastest(run_stats(spark, sf))


def method_totals(spark, sf):
    return runstats.method_totals(run_stats(spark, sf))


def pivot_matrix(spark, sf):
    return runstats.pivot_methods(run_stats(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        scan_single_file,
        scan_file_list,
        scan_glob,
        scan_recursive,
        month_from_path,
        compact_files,
        compact_merged,
        compact_by_size,
        compaction_report,
        convert_format,
        conversion_status,
        write_if_absent,
        raw_landing,
        clustered_fact,
        lookup_interleaved,
        concat_frames,
        concat_filtered,
        run_stats,
        argmin_per_group,
        method_totals,
        pivot_matrix,
    )
}

_RUNS = """
    SELECT l_returnflag AS analysis, l_linestatus AS method,
           round(avg(CASE WHEN l_discount < 0.095 THEN l_quantity END), 6) AS avg_time_seconds,
           round(coalesce(stddev_samp(CASE WHEN l_discount < 0.095 THEN l_quantity END), 0.0), 6)
               AS std_dev_seconds,
           count(*) AS n_runs
    FROM lineitem GROUP BY 1, 2"""

ORACLES = {
    **{
        name: "SELECT * FROM orders"
        for name in (
            "scan_single_file", "scan_file_list", "scan_glob", "scan_recursive", "compact_files",
            "write_if_absent", "raw_landing", "concat_frames", "compact_by_size",
        )
    },
    "compact_merged": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS o_orderpriority)
        FROM orders""",
    "compaction_report": """
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows
        FROM orders GROUP BY ROLLUP (1)""",
    "convert_format": """
        SELECT *, 'orders' AS file_kind, cast(year(o_orderdate) AS integer) AS file_year,
               cast(month(o_orderdate) AS integer) AS file_month
        FROM orders""",
    "conversion_status": """
        WITH years AS (SELECT DISTINCT cast(year(o_orderdate) AS integer) AS year FROM orders),
        done AS (
            SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders
            WHERE month(o_orderdate) <= 6)
        SELECT 'orders' AS kind, years.year, m.month::INTEGER AS month,
               CASE WHEN done.year IS NULL THEN 'missing' ELSE 'converted' END AS status
        FROM years CROSS JOIN range(1, 13) m(month)
        LEFT JOIN done ON done.year = years.year AND done.month = m.month""",
    "month_from_path": """
        SELECT cast(month(o_orderdate) AS integer) AS month, count(*) AS n_orders
        FROM orders GROUP BY 1""",
    "clustered_fact": "SELECT * FROM orders",
    "lookup_interleaved": " UNION ALL ".join(
        f"""
        SELECT '{column}' AS by, cast({column} AS varchar) AS key, count(*) AS n_lines
        FROM lineitem WHERE {column} IN (
            SELECT {column} FROM (SELECT DISTINCT {column} FROM lineitem)
            ORDER BY md5(cast({column} AS varchar)), {column} LIMIT 20)
        GROUP BY 2"""
        for column in ("l_partkey", "l_shipdate", "l_orderkey")
    ),
    "concat_filtered": """
        SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_custkey IN (
            SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
            ORDER BY md5(cast(o_custkey AS varchar)), o_custkey LIMIT 50)
        GROUP BY 1""",
    "run_stats": _RUNS,
    "argmin_per_group": f"""
        SELECT analysis, arg_min(method, (avg_time_seconds, method)) AS fastest_method,
               min(avg_time_seconds) AS best_time_seconds
        FROM ({_RUNS}) WHERE avg_time_seconds IS NOT NULL GROUP BY 1""",
    "method_totals": f"""
        SELECT method, round(avg(avg_time_seconds), 6) AS mean_seconds,
               round(sum(avg_time_seconds), 6) AS total_seconds
        FROM ({_RUNS}) WHERE avg_time_seconds IS NOT NULL GROUP BY 1""",
    "pivot_matrix": f"""
        SELECT analysis, max(avg_time_seconds) FILTER (WHERE method = 'F') AS "F",
               max(avg_time_seconds) FILTER (WHERE method = 'O') AS "O"
        FROM ({_RUNS}) GROUP BY 1""",
}
