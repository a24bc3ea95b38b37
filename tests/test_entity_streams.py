"""Streams whose state ends with the entity: equal to the batch, after restarts and replays."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from siltline.operators import state as S
from siltline.operators.subscriptions import Subscription, full_notifications
from siltline.plans import inputs
from siltline.sources import patches as P
from siltline.streaming import entities, feeds
from tests.test_entities import LIVE, LOG, T0, cells, feed, number, patch

WATCH = Subscription("AirQualityObserved", condition_attrs=("CO", "O3"), notify_attrs=("CO", "O3", "address"))


def made_log(n=300, seed=1):
    r = random.Random(seed)
    log = []
    for i in range(n):
        op = r.choices(["patch", "create", "delete"], [8, 2, 1])[0]
        attrs = {a: number(i) for a in ("CO", "O3") if r.random() < 0.4}
        if r.random() < 0.3:
            attrs["address"] = {"type": "Text", "value": f"street {i}"}
        log.append(patch(i, f"u{r.choice([0, 0, 0, 1, 2, 3, 4])}", op, tenant=r.choice(["a", "b"]), **attrs))
    return log


def run(spark, folder, out, check, start, *args):
    query = start(feeds.patch_stream(spark, folder, files_per_batch=1), *args, out, check)
    query.awaitTermination()
    return query


def rows_of(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_stream_equals_full_notifications_after_restarts(spark, path):
    log = made_log()
    folder, out, check = path + "/in", path + "/out", path + "/check"
    for i in range(0, len(log), 75):
        part = log[i : i + 75]
        random.Random(i).shuffle(part)
        feed(spark, folder, part)
        for _ in range(2):
            run(spark, folder, out, check, entities.start_notifications, WATCH)
    want = full_notifications(spark.createDataFrame(log, P.PATCH_SCHEMA), WATCH)
    got = spark.read.parquet(out)
    assert set(got.columns) == {*want.columns, "batch_id"}
    assert rows_of(got, want.columns) == rows_of(want, want.columns) and got.count() > 50
    # A batch whose output was written but not committed is written again, to the same place.
    before = rows_of(got, want.columns)
    run(spark, folder, out, path + "/check2", entities.start_notifications, WATCH)
    assert rows_of(spark.read.parquet(out), want.columns) == before


def test_live_state_equals_batch(spark, path):
    folder, out, check = path + "/in", path + "/out", path + "/check"
    for part in (LOG[:3], LOG[3:6], LOG[6:]):
        feed(spark, folder, part)
        run(spark, folder, out, check, entities.start_live_state)
    assert cells(feeds.read_state(spark, out)) == LIVE
    log = made_log(seed=2)
    feed(spark, path + "/in2", log)
    run(spark, path + "/in2", path + "/out2", path + "/check2", entities.start_live_state)
    batch = S.current_state(P.explode_attrs(spark.createDataFrame(log, P.PATCH_SCHEMA)))
    assert cells(feeds.read_state(spark, path + "/out2")) == cells(batch)


def state_rows(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_state_falls_after_deletes(spark, path):
    folder, out, check = path + "/in", path + "/out", path + "/check"
    feed(spark, folder, [patch(i, f"u{i}", "create", CO=number(i), O3=number(i), note=number(1)) for i in range(40)])
    before = state_rows(run(spark, folder, out, check, entities.start_live_state))
    feed(spark, folder, [patch(100 + i, f"u{i}", "delete") for i in range(30)])
    after = state_rows(run(spark, folder, out, check, entities.start_live_state))
    assert after < before / 2
    assert {r.entity_id for r in feeds.read_state(spark, out).collect()} == {f"u{i}" for i in range(30, 40)}


def test_late_patches(spark, path):
    folder, out, check = path + "/in", path + "/out", path + "/check"
    late = {"type": "Text", "value": "late"}
    for part in (
        [patch(10, "u1", "create", CO=number(10)), patch(20, "u2", "create", CO=number(20)), patch(30, "u3", CO=number(30))],
        [patch(15, "u1", "delete"), patch(19, "u2", O3=number(19), CO=number(19))],
        [patch(12, "u1", CO=number(12)), patch(18, "u2", "delete"), patch(25, "u3", "delete", CO=number(1)), patch(17, "u1", address=late, O3=number(17))],
    ):
        feed(spark, folder, part)
        run(spark, folder, out, check, entities.start_notifications, WATCH)
    got = {(r.entity_id, r.patch_id): (r.CO, r.O3, r.address) for r in spark.read.parquet(out).collect()}
    assert got == {
        ("u1", 10): ("10", None, None), ("u2", 20): ("20", None, None), ("u3", 30): ("30", None, None),
        ("u2", 19): ("20", "19", None),  # a newer patch has set CO
        ("u1", 17): (None, "17", "late"),  # 12 is of the life that 15 has ended
    }


def test_deletes_are_forgotten_in_time(spark, path):
    folder, check = path + "/in", path + "/check"
    feed(spark, folder, [patch(1, "u1", "create", CO=number(1)), patch(5, "u1", "delete")])

    def go(out):
        changes = entities.changed_attrs(feeds.patch_stream(spark, folder, files_per_batch=1), ttl_ms=1)
        query = feeds.start_changes(changes, out, check)
        query.awaitTermination()
        return query

    go(path + "/out")
    feed(spark, folder, [patch(3, "u1", CO=number(3))])
    go(path + "/out")
    told = spark.read.parquet(path + "/out").filter("batch_id = 1").collect()
    assert [(r.attr, r.value) for r in told] == [("CO", "3")]


@pytest.mark.parametrize("zone", ["America/New_York"])
def test_times_in_another_zone(spark, path, zone):
    feed(spark, path + "/in", [patch(1, "u1", "create", CO=number(1)), patch(2, "u1", CO=number(2))])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        run(spark, path + "/in", path + "/out", path + "/check", entities.start_notifications, WATCH)
        got = {r.patch_id: (r.date_created, r.time_index) for r in spark.read.parquet(path + "/out").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {1: (T0 + dt.timedelta(minutes=1),) * 2, 2: (T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(minutes=2))}
    assert spark.read.parquet(path + "/out").select(F.count("*")).first()[0] == 2


def test_patch_files_share_the_work_of_a_batch(spark, path, monkeypatch):
    """24 MB of events are several files in each micro-batch; batches follow each other, NULL first."""
    events = spark.range(4000).select(
        F.when(F.col("id") > 0, F.col("id")).alias("event_id"), F.lit(T0).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("click").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit("x").alias("props"),
    )
    events.write.parquet(f"{path}/events.parquet")
    monkeypatch.setattr(inputs.files, "total_bytes", lambda *_: 24 * 1024 * 1024)
    folder, per_batch = inputs.patch_folder(spark, path)
    assert per_batch == 3
    files = [(p.stat().st_mtime_ns, str(p)) for p in pathlib.Path(folder.removeprefix("file://")).glob("*.parquet")]
    assert len(files) == 4 * per_batch
    read = lambda some: {r[0] for r in spark.read.parquet(*[f for _, f in some]).select("patch_id").collect()}
    files.sort()
    batches = [read(files[i : i + per_batch]) for i in range(0, len(files), per_batch)]
    assert None in batches[0] and sum(map(len, batches)) == 4000
    known = [{n for n in b if n is not None} for b in batches]
    assert all(max(a) < min(b) for a, b in zip(known, known[1:]))
