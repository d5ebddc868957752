"""EXT-16 as a stream: keyed state, redeliveries, replays, folded change tables."""

import os
import shutil

from ledgerlens.operators import extensions as X
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.streaming.notional import CHANGES, EVENT_SCHEMA, current_notional, start_notional_stream
from tests.conftest import rows

COLUMNS = ("arrangement_key", "notional_outstanding", "events", "last_event_date")


def _run(spark, src, wh, folder, **options):
    q = start_notional_stream(spark, src + "/*", wh, os.path.join(folder, "ckpt"), max_files_per_trigger=1, **options)
    assert q.awaitTermination(300) and q.exception() is None
    return q


def _batch(ev):
    return rows(X.notional_as_of(ev, "9999-12-31"), "arrangement_key", "notional_outstanding", "events")


def test_notional_stream_equals_batch(spark, small_pipeline, tmpdir_path):
    ev = small_pipeline.canon["trade_event"].select(*EVENT_SCHEMA.names)
    src = os.path.join(tmpdir_path, "events")
    # two deliveries; the second repeats part of the first (a redelivery)
    ev.where("event_type = 'INCEPTION'").write.parquet(os.path.join(src, "b1"))
    ev.write.mode("overwrite").parquet(os.path.join(src, "b2"))
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"))
    _run(spark, src, wh, tmpdir_path)
    assert rows(current_notional(wh), "arrangement_key", "notional_outstanding", "events") == _batch(ev)


def _deliver(spark, src, name, *events):
    spark.createDataFrame([(k, a, "CHANGE", None, None) for k, a, *_ in events], EVENT_SCHEMA).drop(
        "economic_event_date", "notional_delta").join(
        spark.createDataFrame([(k, d, v) for k, _, d, v in events], "event_key string, d string, v int"), "event_key").selectExpr(
        "event_key", "arrangement_key", "event_type", "cast(d as date) as economic_event_date",
        "cast(v as decimal(20,2)) as notional_delta").coalesce(1).write.parquet(os.path.join(src, name))


def _plain(df):
    return [(a, int(n), e, str(d)) for a, n, e, d in rows(df, *COLUMNS)]


def test_late_redeliveries_replays_and_folds(spark, tmpdir_path):
    src, wh = os.path.join(tmpdir_path, "events"), Warehouse(spark, os.path.join(tmpdir_path, "wh"))
    first = ("e1", "A", "2020-01-31", 100)
    _deliver(spark, src, "b1", first, ("e2", "B", "2020-01-31", 50))
    _run(spark, src, wh, tmpdir_path)
    assert _plain(current_notional(wh)) == [("A", 100, 1, "2020-01-31"), ("B", 50, 1, "2020-01-31")]
    # years later the first event comes again, with a new one of the same arrangement
    _deliver(spark, src, "b2", first, ("e3", "A", "2026-01-31", -30))
    q = _run(spark, src, wh, tmpdir_path)
    want = [("A", 70, 2, "2026-01-31"), ("B", 50, 1, "2020-01-31")]
    assert _plain(current_notional(wh)) == want
    # the batch read the rows that came, and wrote the arrangement it changed
    assert sum(p.numInputRows for p in q.recentProgress) == 2
    last = wh.read(CHANGES).agg({"batch": "max"}).collect()[0][0]
    assert rows(wh.read(CHANGES).where(f"batch = {last}"), "arrangement_key") == [("A",)]
    # the batch is replayed after a failure before its commit, its predecessors folded
    lost = os.path.join(tmpdir_path, "ckpt", "commits")
    number = max(int(n) for n in os.listdir(lost) if n.isdigit())
    again = os.path.join(tmpdir_path, "again")
    shutil.copytree(os.path.join(tmpdir_path, "ckpt"), os.path.join(again, "ckpt"), ignore=lambda folder, names: [
        n for n in names if folder == lost and n in (f"{number}", f".{number}.crc")])
    _run(spark, src, wh, again, most_folders=0)
    tmpdir_path = again
    assert _plain(current_notional(wh)) == want
    # many small batches: folders are folded, the figures stay
    for i in range(4):
        _deliver(spark, src, f"c{i}", (f"n{i}", "B" if i % 2 else "C", "2026-02-28", 1))
        _run(spark, src, wh, tmpdir_path, most_folders=2)
    assert _plain(current_notional(wh)) == [("A", 70, 2, "2026-01-31"), ("B", 52, 3, "2026-02-28"), ("C", 2, 2, "2026-02-28")]
    assert len(wh._state(CHANGES)["segments"]) <= 4
