"""Streams that hold the state of an entity as long as it lives.

The state of an entity is a map of its last values, cleared when the entity is deleted; what then
remains is the number of the delete, and that for a limited time.  Patches of a micro-batch are
applied in the order of ``patch_id``, whatever order they arrive in.  Patches that come in a later
batch than newer ones of their entity:

* older than its last delete: dropped, and so is a notification of theirs;
* otherwise they set the attributes that no newer patch has set, and notify with what is known;
* a late delete removes what was set before it and nothing newer;
* once the time to live of a delete is over, an older patch is taken for one of a new entity.

Where patches come in order the notifications are those of ``subscriptions.full_notifications`` and
the state is that of ``state.current_state``.  The rows of an entity in one micro-batch meet in one
task, so ``files_per_batch`` bounds what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siltline.operators.subscriptions import Subscription
from siltline.sources.patches import ENTITY, TOMBSTONE, with_attrs
from siltline.streaming.feeds import start_changes

# Milliseconds after which a deleted entity is forgotten.
TOMBSTONE_TTL_MS = 7 * 24 * 3600 * 1000

_CELL = "patch_id bigint, entity_type string, attr_type string, value string, at string"


class LiveEntity(StatefulProcessor):
    """Applies patches to the state of their entity; subclasses say what is told of it."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getMapState("values", "attr string", _CELL)
        self.created = handle.getValueState("created", "patch_id bigint, at string")
        self.deleted = handle.getValueState("deleted", "patch_id bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Each use of the state is a message to the executor, so none is asked or cleared twice.
        before = {k[0]: tuple(v) for k, v in self.values.iterator()}
        born, gone = self.created.get(), self.deleted.get()
        born, gone = born and tuple(born), gone and gone[0]
        cells, created, deleted = dict(before), born, gone
        told = []
        for row in sorted(rows, key=lambda r: r.patch_id):
            if deleted is not None and row.patch_id <= deleted:
                continue
            if row.op == "delete":
                deleted = row.patch_id
                cells = {a: c for a, c in cells.items() if c[0] > deleted}
                created = created if created and created[0] > deleted else None
                continue
            if row.op == "create" and (created is None or created[0] < row.patch_id):
                created = (row.patch_id, row.at)
            for attr, cell in dict(row.attrs or ()).items():
                if attr not in cells or cells[attr][0] < row.patch_id:
                    cells[attr] = (row.patch_id, row.entity_type, cell["type"], cell["value"], row.at)
            told += self.after_patch(key, row, cells, created)
        told += self.after_batch(key, before, cells, deleted if deleted != gone else None)
        self._keep(before, cells, born, created, gone, deleted)
        return iter(told)

    def _keep(self, before, cells, born, created, gone, deleted) -> None:
        if not cells:
            if before:
                self.values.clear()
        else:
            for attr in before.keys() - cells.keys():
                self.values.removeKey((attr,))
            for attr, cell in cells.items():
                if before.get(attr) != cell:
                    self.values.updateValue((attr,), cell)
        if created is None:
            if born is not None:
                self.created.clear()
        elif created != born:
            self.created.update(created)
        if deleted != gone:
            self.deleted.update((deleted,))

    def after_patch(self, key, row, cells, created) -> list[Row]:
        return []

    def after_batch(self, key, before, cells, deleted) -> list[Row]:
        return []

    def close(self) -> None:
        pass


class Notifier(LiveEntity):
    """Tells all notified attributes at every patch that notifies."""

    def __init__(self, names: list[str], ttl_ms: int):
        super().__init__(ttl_ms)
        self.names = names
        self.row = Row("tenant", "entity_id", "entity_type", "patch_id", "at", "created", *names)

    def after_patch(self, key, row, cells, created) -> list[Row]:
        if not row.notifies:
            return []
        values = [cells[n][3] if n in cells else None for n in self.names]
        return [self.row(*key, row.entity_type, row.patch_id, row.at, created[1] if created else None, *values)]


class Reporter(LiveEntity):
    """Tells the attributes that a batch has set, and deletes."""

    row = Row("tenant", "entity_id", "attr", "entity_type", "attr_type", "value", "at", "patch_id")

    def after_batch(self, key, before, cells, deleted) -> list[Row]:
        told = [self.row(*key, attr, *c[1:], c[0]) for attr, c in cells.items() if before.get(attr) != c]
        return told if deleted is None else [*told, self.row(*key, TOMBSTONE, None, None, None, None, deleted)]


def _at() -> Column:
    """Times travel as text, which no time zone changes."""
    return F.col("ts").cast("string").alias("at")


def _stateful(rows: DataFrame, processor: LiveEntity, schema: str) -> DataFrame:
    return rows.groupBy(*ENTITY).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Update", timeMode="ProcessingTime"
    )


def notified_rows(
    patches: DataFrame, subscription: Subscription, ttl_ms: int = TOMBSTONE_TTL_MS
) -> DataFrame:
    """Stream of notifications with all notified attributes and the times of creation and change."""
    notify = list(dict.fromkeys(subscription.notify_attrs))
    wanted = list(dict.fromkeys([*subscription.condition_attrs, *notify]))
    documents = {name: f"_{name}" for name in wanted}
    rows = patches.filter(subscription.watches()).select(
        *ENTITY, "entity_type", "patch_id", "op", _at(), F.json_tuple("body", *wanted).alias(*documents.values())
    )
    touched = F.coalesce(*[F.col(documents[a]) for a in subscription.condition_attrs]).isNotNull()
    cells = [
        F.struct(
            F.lit(a).alias("attr"),
            F.struct(
                F.lit(None).cast("string").alias("type"), F.get_json_object(documents[a], "$.value").alias("value")
            ).alias("cell"),
        )
        for a in notify
    ]
    known = F.filter(F.array(*cells), lambda c: c["cell"]["value"].isNotNull())
    rows = rows.select(
        *ENTITY, "entity_type", "patch_id", "op", "at",
        (touched & (F.col("op") != "delete")).alias("notifies"), F.map_from_entries(known).alias("attrs"),
    )
    rows = rows.filter(F.col("notifies") | (F.size("attrs") > 0) | F.col("op").isin("create", "delete"))
    columns = ", ".join(f"`{n}` string" for n in notify)
    schema = f"tenant string, entity_id string, entity_type string, patch_id bigint, at string, created string, {columns}"
    told = _stateful(rows, Notifier(notify, ttl_ms), schema)
    time = F.col("at").cast("timestamp_ntz")
    return told.select(
        *ENTITY, "entity_type", "patch_id", time.alias("time_index"),
        F.col("created").cast("timestamp_ntz").alias("date_created"), time.alias("date_modified"),
        *[F.col(f"`{n}`") for n in notify],
    )


def changed_attrs(patches: DataFrame, ttl_ms: int = TOMBSTONE_TTL_MS) -> DataFrame:
    """Stream of the attributes that each batch has set, and of deletes, as ``feeds.read_state`` reads them."""
    rows = with_attrs(patches).select(*ENTITY, "entity_type", "patch_id", "op", _at(), "attrs")
    schema = (
        "tenant string, entity_id string, attr string, entity_type string, attr_type string, "
        "value string, at string, patch_id bigint"
    )
    told = _stateful(rows, Reporter(ttl_ms), schema)
    return told.withColumn("at", F.col("at").cast("timestamp_ntz")).withColumnRenamed("at", "ts")


def start_notifications(
    patches: DataFrame, subscription: Subscription, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write full notification rows, each batch to a partition of its own that a replay overwrites."""
    return start_changes(notified_rows(patches, subscription), path, checkpoint, every)


def start_live_state(
    patches: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """As ``feeds.start_state``, with a state that ends with the entity."""
    return start_changes(changed_attrs(patches), path, checkpoint, every)
