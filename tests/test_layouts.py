import os

import pytest
from pyspark.sql import functions as F

from siltline.operators import combine
from siltline.plans.inputs import monthly_orders, table
from siltline.sinks import layouts
from siltline.sinks.convert import conversion_report, convert_monthly
from siltline.sources import catalogs, dims, files
from siltline.plans import lake
from tests.plan import plan


def content(orders):
    """Rows and a checksum that does not depend on their order."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return tuple(orders.agg(F.count("*"), F.bit_xor(F.xxhash64(*cols))).first())


@pytest.fixture(scope="module")
def expected(spark, sf):
    return content(table(spark, sf, "orders"))


@pytest.fixture(scope="module")
def monthly(spark, sf):
    return monthly_orders(spark, sf)


def test_every_layout_holds_the_same_rows(spark, sf, path, monthly, expected):
    paths = files.scan_tree(spark, monthly).inputFiles()
    assert len(paths) > 12
    assert content(files.scan_files(spark, paths)) == expected
    assert content(files.scan_monthly(spark, monthly, "orders")) == expected
    assert content(convert_monthly(spark, monthly, path + "/orc")) == expected
    layouts.write_partitioned(table(spark, sf, "orders"), path + "/parts", ["o_orderstatus"])
    assert content(spark.read.parquet(path + "/parts")) == expected
    landed = layouts.land_raw(spark, monthly, path + "/raw", "orders")
    assert content(spark.read.parquet(landed)) == expected


def test_one_year_of_monthly_files(spark, sf, monthly):
    orders = table(spark, sf, "orders").filter(F.year("o_orderdate") == 1997)
    assert content(files.scan_monthly(spark, monthly, "orders", 1997)) == content(orders)


def test_name_glob_selects_files(spark, path):
    spark.range(3).write.parquet(path + "/in/a")
    spark.range(5).write.orc(path + "/in/b")
    assert files.scan_tree(spark, path + "/in", "*.parquet").count() == 3


def test_empty_file_list_is_an_error(spark):
    with pytest.raises(ValueError):
        files.scan_files(spark, [])
    with pytest.raises(ValueError):
        combine.concat([])


def test_month_only_from_monthly_names(spark):
    names = [("x/orders_tripdata_2025-03.parquet/part-00000-ab-12.parquet",), ("x/part-01.parquet",)]
    df = spark.createDataFrame(names, "path string").select(files.month_in_path(F.col("path")))
    assert [r[0] for r in df.collect()] == [3, None]


def test_compaction(spark, path, monthly, expected):
    scan = files.scan_tree(spark, monthly)
    size = files.total_bytes(spark, monthly)
    assert content(layouts.compact(spark, scan, size, path + "/one")) == expected
    assert files.file_sizes(spark, path + "/one").count() == 1
    several = layouts.compact(spark, scan, size, path + "/few", target_bytes=-(-size // 3))
    assert content(several) == expected
    assert files.file_sizes(spark, path + "/few").count() <= 3
    report = layouts.compaction_report(scan).collect()
    total = [r.n_rows for r in report if r.path is None]
    assert total == [expected[0]] and sum(r.n_rows for r in report if r.path) == expected[0]


def test_compaction_keeps_an_existing_output(spark, path):
    layouts.compact(spark, spark.range(5), 1, path + "/c")
    assert layouts.compact(spark, spark.range(9), 1, path + "/c").count() == 5
    assert layouts.compact(spark, spark.range(9), 1, path + "/c", overwrite=True).count() == 9


def test_conversion_report_names_missing_months(spark, path):
    rows = spark.range(100).withColumn(
        "file", F.concat(F.lit("yellow_tripdata_2025-0"), F.col("id") % 3 + 1, F.lit(".parquet"))
    )
    rows.write.partitionBy("file").parquet(path + "/in")
    converted = convert_monthly(spark, path + "/in", path + "/out")
    assert converted.groupBy("file_month").count().count() == 3
    report = conversion_report(spark, path + "/in", path + "/out").orderBy("month").collect()
    assert [r.status for r in report] == ["converted"] * 3 + ["missing"] * 9
    assert all(r.ratio == r.target_bytes / r.source_bytes for r in report[:3])


def months(spark, path, *names):
    for name in names:
        spark.range(10).withColumn("file", F.lit(name)).write.mode("append").partitionBy("file").parquet(path)


def test_later_months_are_converted_and_years_kept_apart(spark, path):
    months(spark, path + "/in", "cab_tripdata_2024-01.parquet")
    assert convert_monthly(spark, path + "/in", path + "/out").count() == 10
    months(spark, path + "/in", "cab_tripdata_2024-02.parquet", "cab_tripdata_2025-01.parquet", "nightcab_tripdata_2024-01.parquet")
    rows = convert_monthly(spark, path + "/in", path + "/out")
    assert rows.groupBy("file_kind", "file_year", "file_month").count().count() == 4 and rows.count() == 40
    assert files.scan_monthly(spark, path + "/in", "cab").count() == 30
    months(spark, path + "/in", "no-month.parquet")
    with pytest.raises(ValueError):
        convert_monthly(spark, path + "/in", path + "/out")


def test_an_unfinished_month_is_converted_again(spark, path):
    months(spark, path + "/in", "cab_tripdata_2024-01.parquet")
    half = spark.range(3).selectExpr("id", "'cab' file_kind", "2024 file_year", "1 file_month")
    half.write.partitionBy("file_kind", "file_year", "file_month").orc(path + "/out")
    assert [r.status for r in conversion_report(spark, path + "/in", path + "/out").collect()] == ["missing"] * 12
    assert convert_monthly(spark, path + "/in", path + "/out").count() == 10


def test_unfinished_outputs_are_written_anew(spark, path):
    for name in ("a", "b"):
        spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/{name}")
    layouts.write_if_absent(spark.range(7), path + "/a")
    assert spark.read.parquet(path + "/a").count() == 7
    assert layouts.compact(spark, spark.range(9), 1, path + "/b").count() == 9


def test_files_of_differing_columns(spark, path):
    spark.range(3).write.parquet(path + "/in/a")
    spark.range(5).selectExpr("id", "id * 2 AS tip").write.parquet(path + "/in/b")
    with pytest.raises(ValueError, match="tip"):
        scan = files.scan_tree(spark, path + "/in")
        if "tip" in scan.columns:  # the file that Spark looked at had it
            raise ValueError("tip")
    scan = files.scan_tree(spark, path + "/in", merge=True)
    assert scan.columns == ["id", "tip"] and scan.where("tip is null").count() == 3
    landed = layouts.land_raw(spark, path + "/in", path + "/raw", "t", merge=True)
    assert spark.read.parquet(landed).where("tip is not null").count() == 5


def test_write_if_absent(spark, path):
    layouts.write_if_absent(spark.range(3), path + "/t")
    layouts.write_if_absent(spark.range(7), path + "/t")
    assert spark.read.parquet(path + "/t").count() == 3


def test_append_in_chunks(spark, path):
    layouts.append_chunked(spark.range(0, 25, 1, 1), path + "/t", 10)
    layouts.append_chunked(spark.range(0, 25, 1, 1), path + "/t", 10)
    sizes = files.rows_per_file(spark.read.parquet(path + "/t")).collect()
    assert sorted(r.n_rows for r in sizes) == [5, 5, 10, 10, 10, 10]


def test_clustered_files_do_not_overlap(spark, sf, path):
    orders = table(spark, sf, "orders").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layouts.write_clustered(orders, path + "/c", ["o_orderdate"], unique=["o_orderkey"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    read = spark.read.parquet(path + "/c")
    ranges = read.groupBy(files.file_path().alias("f")).agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    ).orderBy("f").collect()
    assert len(ranges) == 8
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    for part in spark.read.parquet(path + "/c").inputFiles():
        dates = [r.o_orderdate for r in spark.read.parquet(part).collect()]
        assert dates == sorted(dates)


def test_large_inputs_get_more_ranges_than_the_session_setting(spark, path, monkeypatch):
    rows = spark.range(0, 20_000, 1, 4)
    rows.write.parquet(path + "/in")
    scan = spark.read.parquet(path + "/in")
    size = files.scan_bytes(scan)
    assert size == files.total_bytes(spark, path + "/in")
    monkeypatch.setattr(layouts, "RANGE_BYTES", -(-size // 20))
    layouts.write_clustered(scan, path + "/c", ["id"], source_bytes=size)
    assert files.file_sizes(spark, path + "/c").count() == 20


def test_one_frequent_cluster_value_spans_several_files(spark, path):
    hot = spark.range(0, 80_000, 1, 8).select(F.lit(1).alias("day"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layouts.write_clustered(hot, path + "/c", ["day"], unique=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r.n_rows for r in files.rows_per_file(spark.read.parquet(path + "/c")).collect()]
    assert len(sizes) == 8 and max(sizes) < 20_000


def test_one_frequent_partition_value_is_split(spark, path):
    rows = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("client"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    size, name = "512KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        layouts.write_partitioned(rows, path + "/p", ["client"])
    finally:
        spark.conf.set(name, before)
    read = spark.read.parquet(path + "/p")
    per_client = {
        r.client: r.n for r in read.select("client", files.file_path().alias("f")).distinct()
        .groupBy("client").agg(F.count("*").alias("n")).collect()
    }
    assert read.count() == 400_000
    assert per_client[0] > 3


def test_partition_filter_prunes_directories(spark, path):
    layouts.write_partitioned(spark.range(20).selectExpr("id", "id % 4 as client_id"), path + "/u", ["client_id"])
    hit = spark.read.parquet(path + "/u").filter(F.col("client_id") == 1)
    assert "PartitionFilters: [isnotnull(client_id" in plan(hit)
    assert sorted(r.id for r in hit.collect()) == [1, 5, 9, 13, 17]


def test_strict_and_lenient_concat(spark):
    a = spark.range(2).select("id")
    b = a.withColumn("x", F.lit(1))
    with pytest.raises(Exception):
        combine.concat([a, b]).collect()
    assert combine.concat([a, b], allow_missing=True).count() == 4


def test_concat_filter_reaches_each_scan(spark, monthly):
    frames = [files.scan_monthly(spark, monthly, "orders", y) for y in (1996, 1997)]
    text = plan(combine.concat_filtered(frames, F.col("o_custkey").isin(1, 2)))
    assert text.count("In(o_custkey, [1,2])") == 2


def test_zone_csv_keeps_na_quotes_and_commas(spark, path):
    with open(path + "/zones.csv", "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n')
        f.write('1,"EWR","Newark, ""A""","EWR"\n264,"Unknown","N/A","N/A"\n')
    got = [tuple(r) for r in dims.zones_from_csv(spark, path + "/zones.csv").collect()]
    assert got == [(1, "EWR", 'Newark, "A"', "EWR"), (264, "Unknown", "N/A", "N/A")]


def test_bad_zone_csv_fails(spark, path):
    with open(path + "/zones.csv", "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\none,a,b,c\n")
    with pytest.raises(Exception):
        dims.zones_from_csv(spark, path + "/zones.csv").collect()


def test_lookup_rows(spark):
    assert dims.rate_codes(spark).filter("id = 99").first().description == "Null/unknown"
    assert dims.payment_types(spark).count() == 6 and dims.vendors(spark).count() == 2


def test_silver_with_a_row_cap(spark, sf, path):
    raw = layouts.land_raw(spark, f"{sf}/orders.parquet", path, "orders")
    columns = "o_orderkey bigint, o_totalprice double"
    silver = lake.raw_to_silver(spark, lake.new_schema(spark), raw, columns, "orders", limit=1234)
    assert silver.columns == ["o_orderkey", "o_totalprice"]
    assert silver.agg(F.count("*"), F.max("o_orderkey")).first()[:] == (1234, 1233)


def test_jdbc_catalog_settings(spark):
    catalogs.mount_jdbc_catalog(spark, "pgtest", "jdbc:x://db/dim", "org.x.Driver", {"user": "u"})
    assert spark.conf.get("spark.sql.catalog.pgtest.url") == "jdbc:x://db/dim"
    assert spark.conf.get("spark.sql.catalog.pgtest.driver") == "org.x.Driver"
    assert spark.conf.get("spark.sql.catalog.pgtest.user") == "u"
    assert spark.conf.get("spark.sql.catalog.pgtest") == catalogs.JDBC_CATALOG


def file_lengths(spark, root):
    return {r.path: r.length for r in files.file_sizes(spark, root).collect()}


def test_compaction_by_size(spark, path):
    root, out = path + "/in", path + "/out"
    for k in range(24):
        spark.range(1000 * k, 1000 * k + 50 * (k + 1), 1, 1).write.parquet(f"{root}/{k}")
    spark.range(10**6, 10**6 + 40_000, 1, 1).write.parquet(root + "/large")
    want = sorted(r.id for r in files.scan_tree(spark, root).collect())
    sources = file_lengths(spark, root)
    target = 2 * sorted(sources.values())[-2] + 1000
    small = [n for n in sources.values() if 2 * n < target]
    assert len(small) == 24 and sum(small) > 4 * target

    def run():
        got = layouts.compact_small(spark, root, out, target)
        assert sorted(r.id for r in got.collect()) == want
        return got.inputFiles()

    read = run()
    written = file_lengths(spark, out)
    n_new = len([p for p in written if layouts.COMPACTED not in p])
    # All but one new file have more than half the target of sources, and none more than the target.
    assert sum(small) / target <= n_new <= 2 * sum(small) / target + 1
    assert len(read) == n_new + 1 and file_lengths(spark, root) == sources
    groups = spark.read.parquet(f"{out}/{layouts.COMPACTED}").collect()
    assert {g.path for g in groups} == {p for p, n in sources.items() if 2 * n < target}
    assert run() == read and file_lengths(spark, out) == written

    spark.range(5000, 5003, 1, 1).write.parquet(root + "/late")  # too little for a file
    want = sorted([*want, 5000, 5001, 5002])
    assert len(run()) == len(read) + 1 and file_lengths(spark, out) == written
    spark.range(7).write.parquet(out + "/died-half-way")
    run()
    spark.range(9000, 9000 + 11 * 900, 1, 11).write.parquet(root + "/later")
    want = sorted([*want, *range(9000, 9000 + 11 * 900)])
    assert len(run()) < len(read) + 12


def test_compaction_refuses_what_it_cannot_tell(spark, path):
    root, out = path + "/in", path + "/out"
    spark.range(0, 4000, 1, 8).write.parquet(root)
    size = sum(file_lengths(spark, root).values())
    with pytest.raises(ValueError):
        layouts.compact_small(spark, root, root + "/out", size)
    assert layouts.compact_small(spark, root, out, size).count() == 4000
    name = next(iter(file_lengths(spark, root))).removeprefix("file:")
    name = "/" + name.lstrip("/")
    spark.range(9, 30, 1, 1).write.parquet(path + "/other")
    other = next(p for p in os.listdir(path + "/other") if p.endswith(".parquet"))
    with open(f"{path}/other/{other}", "rb") as new, open(name, "wb") as old:
        old.write(new.read())
    crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ValueError):
        layouts.compact_small(spark, root, out, size)
