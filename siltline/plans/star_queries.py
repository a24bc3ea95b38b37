"""Registry: star schema, federation, lake load, dimensions, clients and users."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline import scratch
from siltline.functions.numeric import money_sum
from siltline.operators import dimensions, keys
from siltline.plans import lake, star, synthetic
from siltline.plans.inputs import table
from siltline.sinks import upsert
from siltline.sinks.layouts import land_raw, write_clustered, write_partitioned
from siltline.sources import catalogs, dims, files

# The payment dimension of the mix query; flag N has no row in it.
MIX_DIM = [("A", "Accepted"), ("R", "Returned")]
CAP = 1_000  # of the capped load
UNTIL = "2025-01-01 00:00:00"


def star_daily_revenue(spark, sf):
    return star.daily_revenue(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier"),
        "l_suppkey", "s_suppkey", "s_name", "l_shipdate", "l_extendedprice",
    )


def star_zone_revenue(spark, sf):
    return star.zone_revenue(
        table(spark, sf, "orders"), table(spark, sf, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment", "c_nationkey", "o_totalprice",
    )


def _mix_dim(spark):
    return dims.lookup(spark, MIX_DIM)


def star_payment_mix(spark, sf):
    return star.payment_mix(
        table(spark, sf, "lineitem"), _mix_dim(spark),
        "l_returnflag", "id", "description", "l_extendedprice",
    )


def _registered(spark, sf, schema, name):
    """A given table under its three-part name."""
    catalogs.register_existing(spark, f"spark_catalog.{schema}.{name}", f"{sf}/{name}.parquet")
    return catalogs.table(spark, f"spark_catalog.{schema}.{name}")


def federated_daily_revenue(spark, sf):
    """The lookup has an int key, as lookups do; it is widened to the fact's bigint."""
    facts, lookups = lake.new_schema(spark, "lake"), lake.new_schema(spark, "dim")
    name = f"spark_catalog.{lookups}.vendor"
    catalogs.create_managed(spark, name, "id int, description string")
    suppliers = table(spark, sf, "supplier")
    suppliers.select(F.col("s_suppkey").cast("int"), "s_name").write.insertInto(name)
    return star.daily_revenue(
        _registered(spark, sf, facts, "lineitem"), catalogs.table(spark, name),
        "l_suppkey", "id", "description", "l_shipdate", "l_extendedprice",
    )


def federated_zone_revenue(spark, sf):
    facts, lookups = lake.new_schema(spark, "lake"), lake.new_schema(spark, "dim")
    return star.zone_revenue(
        _registered(spark, sf, facts, "orders"), _registered(spark, sf, lookups, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment", "c_nationkey", "o_totalprice",
    )


def federated_payment_mix(spark, sf):
    facts, lookups = lake.new_schema(spark, "lake"), lake.new_schema(spark, "dim")
    name = f"spark_catalog.{lookups}.payment_type"
    catalogs.create_managed(spark, name, "id string, description string")
    _mix_dim(spark).write.insertInto(name)
    return star.payment_mix(
        _registered(spark, sf, facts, "lineitem"), catalogs.table(spark, name),
        "l_returnflag", "id", "description", "l_extendedprice",
    )


def star_fact_build(spark, sf):
    names = {
        "o_custkey": "vendor_id",
        "o_orderdate": "pickup_datetime",
        "o_orderstatus": "payment_type",
        "o_totalprice": "total_amount",
        "o_dropoff": "dropoff_datetime",  # not in the files, left out
    }
    orders = table(spark, sf, "orders")
    fact = star.star_fact(orders, names, ints=("vendor_id",), limit=None)
    path, size = scratch.new_path(spark, "star-fact"), files.scan_bytes(orders)
    return star.load_star_fact(spark, fact, path, ("pickup_datetime", "vendor_id"), size)


def star_fact_layouts(spark, sf):
    """Orders in three layouts, of which the second has none of the wanted columns and the third lacks one."""
    names = {"o_custkey": "vendor_id", "o_orderstatus": "payment_type", "o_totalprice": "total_amount"}
    root, orders = scratch.new_path(spark, "layouts"), table(spark, sf, "orders")
    kept = (["o_orderkey", *names], ["o_orderkey", "o_orderpriority"], ["o_orderkey", "o_custkey", "o_totalprice"])
    for k, columns in enumerate(kept):
        rows = orders.filter(F.col("o_orderkey") % 3 == k).select(columns)
        write_clustered(rows, f"{root}/layout-{k}", ["o_orderkey"])
    paths = sorted(r.path for r in files.file_sizes(spark, root).collect())
    fact = star.star_fact_of_files(spark, paths, names, ints=("vendor_id",))
    return fact.select("trip_id", *names.values())


def star_dim_load(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("description")
    )
    path = scratch.new_path(spark, "star-dim")
    return star.load_star_dimension(spark, customers, path, "id", ("description",))


def capped_load(spark, sf):
    path = scratch.new_path(spark, "capped")
    rows = star.load_capped(spark, table(spark, sf, "orders"), path, CAP, CAP // 4)
    return rows.select("trip_id", "o_orderkey", "o_totalprice")


def second_load(spark, sf):
    """Two loads of the orders: the numbers of the second go on from those of the first."""
    path, orders = scratch.new_path(spark, "loads"), table(spark, sf, "orders")
    star.load_capped(spark, orders, path, CAP)
    return star.load_capped(spark, orders, path).select("trip_id", "o_orderkey")


def repeated_load(spark, sf):
    """Three loads of the orders, of which the second one runs twice."""
    path, orders = scratch.new_path(spark, "loads"), table(spark, sf, "orders")
    for load, limit in (("a", CAP), ("b", CAP // 2), ("c", None)):
        star.load_batch(spark, orders, path, load, limit)
    return star.load_batch(spark, orders, path, "b", CAP // 2).select("load", "trip_id", "o_orderkey")


def dense_surrogate_key(spark, sf):
    orders = table(spark, sf, "orders")
    size = files.scan_bytes(orders)
    rows = orders.select("o_orderkey", "o_orderdate")
    return keys.number_by_key(spark, rows, ["o_orderdate", "o_orderkey"], source_bytes=size)


def raw_to_silver(spark, sf):
    raw = land_raw(spark, f"{sf}/orders.parquet", scratch.new_path(spark, "raw"), "orders")
    columns = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    )
    return lake.raw_to_silver(spark, lake.new_schema(spark), raw, columns, "orders")


def zone_dim_load(spark, sf):
    """Customers as a quoted zone CSV, read back."""
    customers = table(spark, sf, "customer")
    zone = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    service = F.when(F.col("c_acctbal") < 0, "N/A").otherwise(F.col("c_mktsegment"))
    path = scratch.new_path(spark, "zones")
    (
        customers.select(
            F.col("c_custkey").alias("LocationID"),
            F.col("c_mktsegment").alias("Borough"),
            zone.alias("Zone"),
            service.alias("service_zone"),
        )
        .write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    )
    schema = dims.ZONE_FILE_SCHEMA.replace("LocationID int", "LocationID bigint")
    return dims.zones_from_csv(spark, path, schema)


def dim_upsert(spark, sf):
    """Suppliers as a dimension, updated from the orders; the last order of a key wins."""
    name = f"{lake.new_schema(spark)}.dim"
    catalogs.create_managed(spark, name, "id bigint, description string")
    target = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    target.write.insertInto(name)
    source = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderkey").alias("seq"),
    )
    return upsert.upsert_table(spark, name, source, ["id"], "seq")


def partitioned_upsert(spark, sf):
    """Customers by nation, updated from the orders of the first nations; the last order wins."""
    name = f"{lake.new_schema(spark)}.customers"
    catalogs.register_existing(spark, name, _partitioned_users(spark, sf), partitioned=True)
    nations = _users(spark, sf).filter("client_id < 5").select("id", "client_id")
    source = table(spark, sf, "orders").join(nations, F.col("o_custkey") == F.col("id")).select(
        "id", F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("salary"),
        "client_id", F.col("o_orderkey").alias("seq"),
    )
    rows = upsert.upsert_table(spark, name, source, ["client_id", "id"], "seq")
    return rows.select("id", "name", "salary", "client_id")


def null_partition_upsert(spark, sf):
    """Customers by a nation that may be NULL, updated from the orders of the first nations and of none."""
    name, root = f"{lake.new_schema(spark)}.customers", scratch.new_path(spark, "null-partitions")
    nation = F.when(F.col("client_id") != 2, F.col("client_id")).alias("client_id")
    users = _users(spark, sf).select("id", "name", "salary", nation)
    write_partitioned(users, root, ["client_id"])
    catalogs.register_existing(spark, name, root, partitioned=True)
    few = users.filter("client_id < 5 OR client_id IS NULL").select("id", "client_id")
    source = table(spark, sf, "orders").join(few, F.col("o_custkey") == F.col("id")).select(
        "id", F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("salary"),
        "client_id", F.col("o_orderkey").alias("seq"),
    )
    rows = upsert.upsert_table(spark, name, source, ["client_id", "id"], "seq")
    return rows.select("id", "name", "salary", "client_id")


def dim_constraint_check(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.nullif("o_custkey", F.lit(1)).alias("id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("description"),
    )
    return dimensions.constraint_violations(rows, "id", ["description"])


def _users(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("salary"),
        F.col("c_nationkey").alias("client_id"),
    )


def users_preview(spark, sf):
    return _users(spark, sf).orderBy("id").limit(10)


def user_company_join(spark, sf):
    users, clients = _users(spark, sf), table(spark, sf, "nation")
    return (
        users.join(clients, F.col("client_id") == F.col("n_nationkey"))
        .orderBy("id")
        .select(F.col("name").alias("user_name"), F.col("n_name").alias("company_name"), "salary")
        .limit(10)
    )


def _partitioned_users(spark, sf):
    path = scratch.new_path(spark, "users")
    write_partitioned(_users(spark, sf), path, ["client_id"])
    return path


def partitioned_write(spark, sf):
    users = spark.read.parquet(_partitioned_users(spark, sf))
    return users.groupBy("client_id").agg(
        F.count("*").alias("n_users"), money_sum(F.col("salary")).alias("salaries")
    )


def partition_lookup(spark, sf):
    return spark.read.parquet(_partitioned_users(spark, sf)).filter(F.col("client_id") == 1)


def register_table(spark, sf):
    name = f"{lake.new_schema(spark)}.users"
    users = catalogs.register_existing(spark, name, _partitioned_users(spark, sf), partitioned=True)
    return users.select("id", "name", "salary", "client_id")


def synthetic_users(spark, sf):
    return synthetic.users(table(spark, sf, "orders"), "o_orderkey", UNTIL)


def synthetic_clients(spark, sf):
    return synthetic.clients(table(spark, sf, "customer"), "c_custkey", UNTIL)


QUERIES = {
    f.__name__: f
    for f in (
        star_daily_revenue,
        star_zone_revenue,
        star_payment_mix,
        federated_daily_revenue,
        federated_zone_revenue,
        federated_payment_mix,
        star_fact_build,
        star_fact_layouts,
        star_dim_load,
        capped_load,
        repeated_load,
        second_load,
        dense_surrogate_key,
        raw_to_silver,
        zone_dim_load,
        dim_upsert,
        partitioned_upsert,
        null_partition_upsert,
        dim_constraint_check,
        users_preview,
        user_company_join,
        partitioned_write,
        partition_lookup,
        register_table,
        synthetic_users,
        synthetic_clients,
    )
}

_DAILY = """
    SELECT cast(date_trunc('day', l_shipdate) AS date) AS pickup_day, s_name AS vendor,
           round(sum(l_extendedprice), 2) AS total_revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100"""
_ZONES = """
    SELECT c_mktsegment AS borough, c_nationkey AS zone,
           round(sum(o_totalprice), 2) AS total_revenue
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50"""
_MIX = """
    SELECT d.description AS payment_type, round(sum(l_extendedprice), 2) AS total_revenue
    FROM lineitem
    JOIN (VALUES ('A', 'Accepted'), ('R', 'Returned')) AS d(id, description) ON l_returnflag = d.id
    GROUP BY 1 ORDER BY 2 DESC, 1"""


def _hashed(salt: str, low: int, high: int) -> str:
    """The oracle's form of hashed_between, over the number i."""
    return (
        f"(cast('0x' || substr(md5(cast(i AS varchar) || ':{salt}'), 1, 12) AS bigint)"
        f" % {high - low + 1} + {low})"
    )


_YEAR = synthetic.YEAR_SECONDS

ORACLES = {
    "star_daily_revenue": _DAILY,
    "star_zone_revenue": _ZONES,
    "star_payment_mix": _MIX,
    "federated_daily_revenue": _DAILY,
    "federated_zone_revenue": _ZONES,
    "federated_payment_mix": _MIX,
    "star_fact_build": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS trip_id,
               cast(o_custkey AS integer) AS vendor_id, o_orderdate AS pickup_datetime,
               o_orderstatus AS payment_type, o_totalprice AS total_amount
        FROM orders""",
    "star_dim_load": "SELECT c_custkey AS id, c_name AS description FROM customer",
    "capped_load": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS trip_id, o_orderkey, o_totalprice
        FROM orders ORDER BY 1 LIMIT 1000""",
    "second_load": """
        WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS n, o_orderkey FROM orders)
        SELECT n AS trip_id, o_orderkey FROM o WHERE n <= 1000
        UNION ALL
        SELECT n + least(1000, (SELECT count(*) FROM o)) AS trip_id, o_orderkey FROM o""",
    "repeated_load": """
        WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS n, o_orderkey FROM orders),
        size AS (SELECT least(1000, count(*)) AS a, least(500, count(*)) AS b FROM o)
        SELECT 'a' AS load, n AS trip_id, o_orderkey FROM o WHERE n <= 1000
        UNION ALL SELECT 'b', n + a, o_orderkey FROM o, size WHERE n <= 500
        UNION ALL SELECT 'c', n + a + b, o_orderkey FROM o, size""",
    "dense_surrogate_key": """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS trip_id,
               o_orderkey, o_orderdate
        FROM orders""",
    "raw_to_silver": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders""",
    "zone_dim_load": """
        SELECT c_custkey AS location_id, c_mktsegment AS borough,
               c_name || ', "' || c_mktsegment || '"' AS zone,
               CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE c_mktsegment END AS service_zone
        FROM customer""",
    "dim_upsert": """
        WITH s AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS description
                   FROM orders GROUP BY 1)
        SELECT coalesce(s.id, t.s_suppkey) AS id,
               CASE WHEN s.id IS NULL THEN t.s_name ELSE s.description END AS description
        FROM supplier t FULL OUTER JOIN s ON s.id = t.s_suppkey""",
    "partitioned_upsert": """
        WITH s AS (
            SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS name,
                   arg_max(o_totalprice, o_orderkey) AS salary
            FROM orders GROUP BY 1)
        SELECT c_custkey AS id, CASE WHEN c_nationkey < 5 THEN coalesce(s.name, c_name) ELSE c_name END AS name,
               CASE WHEN c_nationkey < 5 THEN coalesce(s.salary, c_acctbal) ELSE c_acctbal END AS salary,
               c_nationkey AS client_id
        FROM customer LEFT JOIN s ON s.id = c_custkey""",
    "null_partition_upsert": """
        WITH s AS (
            SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS name,
                   arg_max(o_totalprice, o_orderkey) AS salary
            FROM orders GROUP BY 1)
        SELECT c_custkey AS id, CASE WHEN c_nationkey < 5 THEN coalesce(s.name, c_name) ELSE c_name END AS name,
               CASE WHEN c_nationkey < 5 THEN coalesce(s.salary, c_acctbal) ELSE c_acctbal END AS salary,
               nullif(c_nationkey, 2) AS client_id
        FROM customer LEFT JOIN s ON s.id = c_custkey""",
    "star_fact_layouts": """
        SELECT row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) AS trip_id,
               cast(o_custkey AS integer) AS vendor_id,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS payment_type,
               o_totalprice AS total_amount
        FROM orders WHERE o_orderkey % 3 <> 1""",
    "dim_constraint_check": """
        WITH r AS (SELECT nullif(o_custkey, 1) AS id, nullif(o_orderstatus, 'P') AS description
                   FROM orders)
        SELECT (SELECT count(*) FROM r) AS n_rows,
               (SELECT count(*) FROM (SELECT id FROM r WHERE id IS NOT NULL
                                      GROUP BY id HAVING count(*) > 1)) AS duplicate_keys,
               (SELECT count(*) FROM r WHERE id IS NULL) AS null_keys,
               (SELECT count(*) FROM r WHERE description IS NULL) AS null_description""",
    "users_preview": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary, c_nationkey AS client_id
        FROM customer ORDER BY 1 LIMIT 10""",
    "user_company_join": """
        SELECT c_name AS user_name, n_name AS company_name, c_acctbal AS salary
        FROM customer JOIN nation ON c_nationkey = n_nationkey ORDER BY c_custkey LIMIT 10""",
    "partitioned_write": """
        SELECT c_nationkey AS client_id, count(*) AS n_users, round(sum(c_acctbal), 2) AS salaries
        FROM customer GROUP BY 1""",
    "partition_lookup": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary, c_nationkey AS client_id
        FROM customer WHERE c_nationkey = 1""",
    "register_table": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary, c_nationkey AS client_id
        FROM customer""",
    "synthetic_users": f"""
        WITH d AS (
            SELECT i, {_hashed('user created', 0, 2 * _YEAR)} AS age_s FROM
                (SELECT o_orderkey AS i FROM orders))
        SELECT i + 1 AS id, 'User ' || (i + 1) AS name,
               {_hashed('age', *synthetic.AGES)} AS age, i % 1000 + 1 AS client_id,
               round({_hashed('salary', synthetic.SALARY[0] * 100, synthetic.SALARY[1] * 100)}
                     / 100.0::double, 2) AS salary,
               TIMESTAMP '{UNTIL}' - to_seconds(age_s) AS created_at,
               TIMESTAMP '{UNTIL}'
                   - to_seconds(age_s - {_hashed('user updated', 0, 2 * _YEAR)} % (age_s + 1))
                   AS updated_at
        FROM d""",
    "synthetic_clients": f"""
        SELECT i + 1 AS id, 'Company ' || (i + 1) AS name,
               {_hashed('employees', *synthetic.EMPLOYEES)} AS number_employments,
               TIMESTAMP '{UNTIL}' - to_seconds({_hashed('client created', 0, 2 * _YEAR)})
                   AS created_at,
               TIMESTAMP '{UNTIL}' - to_seconds({_hashed('client updated', 0, _YEAR)})
                   AS updated_at
        FROM (SELECT c_custkey AS i FROM customer)""",
}
