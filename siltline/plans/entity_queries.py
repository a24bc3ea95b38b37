"""Registry: entity documents, state, history and streams over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline import scratch
from siltline.functions import attributes as A
from siltline.functions import calendar as C
from siltline.operators import history as H
from siltline.operators import state as S
from siltline.operators.subscriptions import Subscription, full_notifications, notifications, notified_subscriptions
from siltline.plans import inputs
from siltline.plans.inputs import ENTITY_TYPE, EVENT_TYPES, table
from siltline.sinks.layouts import write_partitioned
from siltline.sources import patches as P
from siltline.streaming import entities, feeds, merges

FROM, TO = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
SERIES_USER, SERIES_ENTITY, SERIES_TENANT = 7, "user-7", "t1"
TENANT, PAGE = "t0", 20
WATCH = Subscription(
    entity_type=ENTITY_TYPE,
    id_pattern="user-[0-9]+",
    condition_attrs=("click", "purchase", "view"),
    notify_attrs=(*EVENT_TYPES, "dateObserved"),
)


def _numbers(rows):
    """Notified values are text; show the Number attributes as numbers."""
    return rows.withColumns({n: F.col(n).try_cast("double") for n in EVENT_TYPES})


def patch_explode(spark, sf):
    rows = P.typed(P.explode_attrs(inputs.patches(spark, sf).withColumn("op", F.lit("patch"))))
    return rows.select("tenant", "patch_id", "entity_id", "attr", "attr_type", "number", "time", "text")


def geo_point_access(spark, sf):
    """Location and address documents built from each event, and read back."""
    events = table(spark, sf, "events")
    point = A.geo_point(F.lit(-99.133167) + F.col("value") / 1000, F.lit(19.434072))
    where = F.struct(
        F.lit("MX").alias("addressCountry"),
        F.col("event_type").alias("addressLocality"),
        F.concat(F.lit("Calle "), F.col("user_id")).alias("streetAddress"),
    )
    body = A.document(
        {"location": A.attribute(A.GEO_JSON, point), "address": A.attribute(A.STRUCTURED, where)}
    )
    parsed = P.with_attrs(events.select("event_id", body.alias("body")))
    place, street = F.col("attrs")["location"]["value"], A.address(F.col("attrs")["address"]["value"])
    return parsed.select(
        "event_id",
        A.point_longitude(place).alias("longitude"),
        A.point_latitude(place).alias("latitude"),
        street.addressCountry.alias("country"),
        street.addressLocality.alias("locality"),
        street.streetAddress.alias("street"),
    )


def iso_timestamp(spark, sf):
    text = table(spark, sf, "events").select("event_id", C.iso_utc_text(F.col("ts")).alias("iso"))
    return text.withColumn("parsed", C.iso_to_utc(F.col("iso")))


def current_state_long(spark, sf):
    events = inputs.attr_events(spark, sf)
    return S.latest_values(events, [*P.ENTITY, "attr"], ["number", "ts"], "patch_id")


def current_state_wide(spark, sf):
    events = inputs.attr_events(spark, sf)
    return S.latest_numbers(events, P.ENTITY, "attr", "number", "patch_id", EVENT_TYPES)


def entity_delete(spark, sf):
    """State after creates, patches and deletes; an error event deletes its entity."""
    rows = S.current_state(P.explode_attrs(inputs.patches(spark, sf)))
    return rows.select("tenant", "entity_id", "attr", "value", "patch_id")


def entity_list(spark, sf):
    state = S.current_state(inputs.attr_events(spark, sf))
    return S.list_entities(state, ENTITY_TYPE)


def entity_page(spark, sf):
    """The second page of one tenant's entities."""
    state = S.current_state(inputs.attr_events(spark, sf))
    return S.list_entities(state, ENTITY_TYPE, TENANT, after="user-2", limit=PAGE)


def get_entity(spark, sf):
    """The attributes of one entity of one tenant, by id and type."""
    state = S.current_state(inputs.attr_events(spark, sf, SERIES_USER))
    rows = S.get_entity(state, SERIES_ENTITY, ENTITY_TYPE, SERIES_TENANT)
    return rows.select("tenant", "entity_id", "attr", "value", "patch_id")


def entity_history(spark, sf):
    """The newest rows of one entity of one tenant within a range, oldest first."""
    entity = (F.col("entity_id") == SERIES_ENTITY) & (F.col("tenant") == SERIES_TENANT)
    rows = H.entity_history(
        inputs.history(spark, sf, SERIES_USER), entity, "time_index", "patch_id",
        F.expr(f"TIMESTAMP_NTZ'{FROM}'"), F.expr(f"TIMESTAMP_NTZ'{TO}'"), last=5,
    )
    return rows.select("tenant", "entity_id", "patch_id", "time_index", *EVENT_TYPES)


def history_forward_fill(spark, sf):
    return H.forward_fill(inputs.history(spark, sf), P.ENTITY, "patch_id", EVENT_TYPES)


def last_n_per_entity(spark, sf):
    rows = H.last_n(inputs.history(spark, sf), P.ENTITY, ["time_index", "patch_id"], 10)
    return rows.select("tenant", "entity_id", "patch_id", "time_index")


def last_n_bucketed(spark, sf):
    """The newest 25 events of each tenant and type, by hour."""
    events = inputs.table(spark, sf, "events").select(
        inputs.tenant().alias("tenant"), "event_type", "ts", "event_id"
    )
    return H.last_n_by_bucket(events, ["tenant", "event_type"], ["ts", "event_id"], 25, F.date_trunc("hour", "ts"))


def history_range(spark, sf):
    rows = H.in_range(
        inputs.history(spark, sf), "time_index",
        F.expr(f"TIMESTAMP_NTZ'{FROM}'"), F.expr(f"TIMESTAMP_NTZ'{TO}'"),
    )
    return rows.select("tenant", "entity_id", "patch_id", "time_index")


def history_page(spark, sf):
    return H.latest_page(inputs.history(spark, sf), "time_index", "patch_id", 20)


def entity_series(spark, sf):
    return H.attribute_series(
        inputs.history(spark, sf, SERIES_USER),
        (F.col("entity_id") == SERIES_ENTITY) & (F.col("tenant") == SERIES_TENANT),
        "time_index", "patch_id", F.col("click"), "click",
    )


def subscription_filter(spark, sf):
    return _numbers(notifications(inputs.patches(spark, sf), WATCH))


def _subscriptions(spark, sf):
    """A subscription for each customer: two event types, one for each nation but the first."""
    names = F.array(*[F.lit(n) for n in EVENT_TYPES])
    first, second = (F.element_at(names, (F.pmod(F.col("c_nationkey") + k, F.lit(5)) + 1).cast("int")) for k in (0, 1))
    every = F.when(F.col("c_nationkey") == 0, F.array(F.lit("source"))).otherwise(F.array().cast("array<string>"))
    ending = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sub_id"), F.lit(ENTITY_TYPE).alias("entity_type"),
        F.concat(F.lit("user-[0-9]*"), ending).alias("id_pattern"),
        F.concat(F.array(first, second), every).alias("condition_attrs"),
        F.array(first, F.lit("source")).alias("notify_attrs"),
    )


def subscription_table(spark, sf):
    """Notifications of as many subscriptions as there are customers, in one plan."""
    subs = _subscriptions(spark, sf)
    number = F.coalesce(*[F.col("attrs")[n] for n in EVENT_TYPES]).try_cast("double")
    shown = {"n_attrs": F.size("attrs"), "number": number}
    rows = notified_subscriptions(inputs.patches(spark, sf), subs, shown=shown)
    return rows.select("sub_id", "tenant", "entity_id", "patch_id", *shown)


def notified_full_rows(spark, sf):
    """Notifications with all attributes, after un-notified signups and deletes by errors."""
    return _numbers(full_notifications(inputs.patches(spark, sf), WATCH))


def history_chunked_fill(spark, sf):
    """As history_forward_fill, with the entities cut into small chunks."""
    rows = inputs.history(spark, sf)
    return H.forward_fill(rows, P.ENTITY, "patch_id", EVENT_TYPES, rows_per_chunk=20)


def tenant_partition(spark, sf):
    """Rows per tenant and history table, from a table partitioned by tenant."""
    path = scratch.new_path(spark, "tenants")
    write_partitioned(inputs.attr_events(spark, sf), path, ["tenant"])
    name = A.history_table_name(F.col("tenant"), F.col("entity_type"))
    rows = spark.read.parquet(path).groupBy("tenant", "entity_type").agg(F.count("*").alias("n_rows"))
    return rows.select("tenant", name.alias("table_name"), "n_rows")


def _stream(spark, sf):
    folder, files_per_batch = inputs.patch_folder(spark, sf)
    return feeds.patch_stream(spark, folder, files_per_batch=files_per_batch)


def stream_current_state(spark, sf):
    path, checkpoint = scratch.new_path(spark, "state"), scratch.new_path(spark, "state-checkpoint")
    feeds.start_state(_stream(spark, sf), path, checkpoint).awaitTermination()
    rows = feeds.read_state(spark, path)
    return rows.select("tenant", "entity_id", "attr", "value", "patch_id")


def stream_update_count(spark, sf):
    path, checkpoint = scratch.new_path(spark, "counts"), scratch.new_path(spark, "counts-checkpoint")
    feeds.start_update_count(_stream(spark, sf), path, checkpoint).awaitTermination()
    return feeds.read_update_count(spark, path)


def history_append(spark, sf):
    path, checkpoint = scratch.new_path(spark, "history"), scratch.new_path(spark, "history-checkpoint")
    feeds.start_history(_stream(spark, sf), WATCH, path, checkpoint).awaitTermination()
    return _numbers(spark.read.parquet(path)).drop("entity_type")


def stream_full_rows(spark, sf):
    """As notified_full_rows, from a stream that holds the last values of each entity."""
    path, checkpoint = scratch.new_path(spark, "full-rows"), scratch.new_path(spark, "full-rows-checkpoint")
    entities.start_notifications(_stream(spark, sf), WATCH, path, checkpoint).awaitTermination()
    return _numbers(spark.read.parquet(path)).drop("batch_id")


def stream_merged_rows(spark, sf):
    """As stream_full_rows; closed batches are merged beside the stream, and those merged are deleted."""
    path, merged = scratch.new_path(spark, "told"), scratch.new_path(spark, "told-merged")
    checkpoint = scratch.new_path(spark, "told-checkpoint")
    stream = entities.start_notifications(_stream(spark, sf), WATCH, path, checkpoint)
    while not stream.awaitTermination(1):
        merges.merge_closed(spark, path, merged)
    merges.merge_closed(spark, path, merged)
    merges.discard_merged(spark, path, merged)
    return _numbers(merges.read_merged(spark, path, merged)).drop("batch_id")


def stream_live_state(spark, sf):
    """As stream_current_state, with a state that ends when its entity is deleted."""
    path, checkpoint = scratch.new_path(spark, "live"), scratch.new_path(spark, "live-checkpoint")
    entities.start_live_state(_stream(spark, sf), path, checkpoint).awaitTermination()
    rows = feeds.read_state(spark, path)
    return rows.select("tenant", "entity_id", "attr", "value", "patch_id")


QUERIES = {
    f.__name__: f
    for f in (
        patch_explode,
        geo_point_access,
        iso_timestamp,
        current_state_long,
        current_state_wide,
        entity_delete,
        entity_list,
        entity_page,
        get_entity,
        entity_history,
        history_forward_fill,
        last_n_per_entity,
        history_range,
        last_n_bucketed,
        history_page,
        entity_series,
        subscription_filter,
        notified_full_rows,
        history_chunked_fill,
        tenant_partition,
        stream_current_state,
        stream_update_count,
        history_append,
        stream_full_rows,
        stream_merged_rows,
        subscription_table,
        stream_live_state,
    )
}

_WHO = "'t' || (user_id % 3) AS tenant, 'user-' || user_id AS entity_id"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0000'"
_CELLS = ", ".join(f"CASE WHEN event_type = '{n}' THEN value END AS \"{n}\"" for n in EVENT_TYPES)
_HISTORY = f"SELECT {_WHO}, event_id AS patch_id, ts AS time_index, {_CELLS} FROM events"
_FILLED = (
    "SELECT tenant, entity_id, patch_id, time_index, "
    + ", ".join(
        f'last_value("{n}" IGNORE NULLS) OVER (PARTITION BY tenant, entity_id ORDER BY patch_id '
        f'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "{n}"'
        for n in EVENT_TYPES
    )
    + f" FROM ({_HISTORY})"
)
_NOTIFIED = f"""
    SELECT {_WHO}, event_id AS patch_id, ts AS time_index, {_CELLS}, {_ISO} AS "dateObserved"
    FROM events WHERE event_type IN ('click', 'purchase', 'view')"""
# Numbers compare as text only where both engines print them alike, hence the cast.
_STATE_AFTER_DELETES = f"""
    WITH gone AS (SELECT user_id, max(event_id) AS at FROM events
                  WHERE event_type = 'error' GROUP BY 1),
    cells AS (
        SELECT user_id, event_type AS attr, cast(value AS varchar) AS value, event_id
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT user_id, 'dateObserved', {_ISO}, event_id FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT user_id, 'source', props, event_id FROM events WHERE event_type <> 'error')
    SELECT 't' || (c.user_id % 3) AS tenant, 'user-' || c.user_id AS entity_id, attr,
           arg_max(value, event_id) AS value, max(event_id) AS patch_id
    FROM cells c LEFT JOIN gone g ON g.user_id = c.user_id
    WHERE g.at IS NULL OR c.event_id > g.at
    GROUP BY c.user_id, attr"""

ORACLES = {
    "patch_explode": f"""
        SELECT {_WHO}, event_id AS patch_id, event_type AS attr, 'Number' AS attr_type,
               value AS number, cast(NULL AS timestamp) AS time, cast(NULL AS varchar) AS text
        FROM events
        UNION ALL
        SELECT {_WHO}, event_id, 'dateObserved', 'DateTime', NULL, date_trunc('second', ts), NULL
        FROM events
        UNION ALL
        SELECT {_WHO}, event_id, 'source', 'Text', NULL, NULL, props FROM events""",
    "geo_point_access": """
        SELECT event_id, -99.133167::double + value / 1000 AS longitude,
               19.434072::double AS latitude, 'MX' AS country, event_type AS locality,
               'Calle ' || user_id AS street
        FROM events""",
    "iso_timestamp": f"""
        SELECT event_id, {_ISO} AS iso, date_trunc('second', ts) AS parsed FROM events""",
    "current_state_long": f"""
        SELECT tenant, entity_id, event_type AS attr, arg_max(value, event_id) AS number,
               arg_max(ts, event_id) AS ts, max(event_id) AS patch_id
        FROM (SELECT *, {_WHO} FROM events) GROUP BY 1, 2, 3""",
    "current_state_wide": "SELECT tenant, entity_id, "
    + ", ".join(
        f"arg_max(value, event_id) FILTER (WHERE event_type = '{n}') AS \"{n}\"" for n in EVENT_TYPES
    )
    + f" FROM (SELECT *, {_WHO} FROM events) GROUP BY 1, 2",
    "entity_delete": _STATE_AFTER_DELETES,
    "entity_list": f"""
        SELECT tenant, entity_id, count(DISTINCT event_type) AS n_attrs
        FROM (SELECT *, {_WHO} FROM events) GROUP BY 1, 2""",
    "entity_page": f"""
        SELECT tenant, entity_id, count(DISTINCT event_type) AS n_attrs
        FROM (SELECT *, {_WHO} FROM events) WHERE tenant = '{TENANT}' AND entity_id > 'user-2'
        GROUP BY 1, 2 ORDER BY 1, 2 LIMIT {PAGE}""",
    "get_entity": f"""
        SELECT tenant, entity_id, event_type AS attr, cast(arg_max(value, event_id) AS varchar) AS value,
               max(event_id) AS patch_id
        FROM (SELECT *, {_WHO} FROM events)
        WHERE entity_id = '{SERIES_ENTITY}' AND tenant = '{SERIES_TENANT}' GROUP BY 1, 2, 3""",
    "entity_history": f"""
        SELECT tenant, entity_id, patch_id, time_index, {', '.join(f'"{n}"' for n in EVENT_TYPES)}
        FROM ({_HISTORY}) WHERE entity_id = '{SERIES_ENTITY}' AND tenant = '{SERIES_TENANT}'
            AND time_index BETWEEN '{FROM}' AND '{TO}'
        ORDER BY time_index DESC, patch_id DESC LIMIT 5""",
    "history_forward_fill": _FILLED,
    "history_chunked_fill": _FILLED,
    "last_n_per_entity": f"""
        SELECT tenant, entity_id, patch_id, time_index FROM ({_HISTORY})
        QUALIFY row_number() OVER (PARTITION BY tenant, entity_id
                                   ORDER BY time_index DESC, patch_id DESC) <= 10""",
    "last_n_bucketed": """
        SELECT 't' || (user_id % 3) AS tenant, event_type, ts, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id % 3, event_type ORDER BY ts DESC, event_id DESC) <= 25""",
    "history_range": f"""
        SELECT tenant, entity_id, patch_id, time_index FROM ({_HISTORY})
        WHERE time_index BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'""",
    "history_page": f"{_HISTORY} ORDER BY ts DESC, event_id DESC LIMIT 20",
    "entity_series": f"""
        SELECT time_index AS time, click FROM ({_HISTORY})
        WHERE entity_id = '{SERIES_ENTITY}' AND tenant = '{SERIES_TENANT}' ORDER BY time_index, patch_id""",
    "subscription_filter": f"SELECT *, '{ENTITY_TYPE}' AS entity_type FROM ({_NOTIFIED})",
    "notified_full_rows": f"""
        WITH lives AS (
            SELECT *, max(CASE WHEN event_type = 'error' THEN event_id END) OVER (
                PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS life
            FROM events),
        cells AS (
            SELECT {_WHO}, event_id AS patch_id, ts AS time_index, '{ENTITY_TYPE}' AS entity_type, event_type AS kind,
                   {", ".join(f"""last_value(CASE WHEN event_type = '{n}' AND event_type <> 'error' THEN value END IGNORE NULLS) OVER w AS "{n}" """ for n in EVENT_TYPES)},
                   last_value(CASE WHEN event_type <> 'error' THEN {_ISO} END IGNORE NULLS) OVER w AS "dateObserved",
                   last_value(CASE WHEN event_type = 'signup' THEN ts END IGNORE NULLS) OVER w AS date_created,
                   ts AS date_modified
            FROM lives
            WINDOW w AS (PARTITION BY user_id, life ORDER BY event_id ROWS UNBOUNDED PRECEDING))
        SELECT * EXCLUDE (kind) FROM cells WHERE kind IN ('click', 'purchase', 'view')""",
    "subscription_table": f"""
        WITH subs AS (
            SELECT c_custkey AS sub_id, {list(EVENT_TYPES)}[c_nationkey % 5 + 1] AS a,
                   {list(EVENT_TYPES)}[(c_nationkey + 1) % 5 + 1] AS b, c_nationkey = 0 AS every,
                   lpad(cast(c_custkey % 100 AS varchar), 2, '0') AS ending
            FROM customer)
        SELECT sub_id, tenant, entity_id, event_id AS patch_id,
               cast(CASE WHEN event_type = a THEN 2 ELSE 1 END AS integer) AS n_attrs,
               CASE WHEN event_type = a THEN value END AS number
        FROM subs JOIN (SELECT *, {_WHO} FROM events WHERE event_type <> 'error') e
            ON regexp_full_match(entity_id, 'user-[0-9]*' || ending) AND (every OR event_type IN (a, b))""",
    "tenant_partition": f"""
        SELECT tenant, 'mt' || tenant || '.et{ENTITY_TYPE.lower()}' AS table_name,
               count(*) AS n_rows
        FROM (SELECT {_WHO} FROM events) GROUP BY 1""",
    "stream_current_state": _STATE_AFTER_DELETES,
    "stream_live_state": _STATE_AFTER_DELETES,
    "stream_update_count": f"""
        SELECT tenant, entity_id, count(*) AS n_updates FROM (SELECT {_WHO} FROM events)
        GROUP BY 1, 2""",
    "history_append": _NOTIFIED,
}
ORACLES["stream_full_rows"] = ORACLES["stream_merged_rows"] = ORACLES["notified_full_rows"]
