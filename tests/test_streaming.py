"""Incremental ingest with Structured Streaming (availableNow trigger)."""

import os

from donorlens.plans.pipeline import current_marts
from donorlens.sources import versions
from donorlens.streaming.landing import start_ingest
from tests.test_ingest import EVENTS_HEADER, _orders_csv, _write


def test_stream_loads_only_new_files_once(spark, tmpdir_run):
    land, out, ck = (os.path.join(tmpdir_run, d) for d in ("landing", "out", "ck"))
    os.makedirs(land)
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid"),
                                                           (2, 8, "06.01.2024 10:11", 30, "Paid")]))
    _write(os.path.join(land, "events_1.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n")
    q = start_ingest(spark, land, out, ck, as_of="2024-01-31")
    q.awaitTermination(300)
    orders = versions.read(spark, os.path.join(out, "_state", "orders"))
    assert orders.count() == 2
    snap = current_marts(spark, out, "2024-01-31")
    assert spark.read.parquet(f"{snap}/rfm").count() == 2

    # a second trigger picks up only the new events file
    _write(os.path.join(land, "events_2.csv"), EVENTS_HEADER + "2;8;02.01.2024 09:00\n3;9;03.01.2024 09:00\n")
    q = start_ingest(spark, land, out, ck, as_of="2024-01-31")
    q.awaitTermination(300)
    events = versions.read(spark, os.path.join(out, "_state", "events"))
    assert events.count() == 3
    assert versions.read(spark, os.path.join(out, "_state", "orders")).count() == 2
    manifest = versions.read(spark, os.path.join(out, "_state", "manifest"))
    assert sorted(r["file_name"] for r in manifest.collect()) == ["events_1.csv", "events_2.csv", "orders.csv"]
