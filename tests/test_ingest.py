"""Ingest and table maintenance (D-01..D-10)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlens.functions.timecols import parse_text_ts
from donorlens.operators import base, merge, quality
from donorlens.plans.pipeline import current_marts, read_mart, run_pipeline
from donorlens.sources import exports, versions
from donorlens.sources.tables import orders_from_export


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_short_rows_padded_long_rows_dropped_quotes_kept(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "e.csv")
    _write(p, 'A;B;C\n1;2\n1;2;3\n1;2;3;4\n"x;y";2;3\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ABC"])
    rows = sorted((tuple(r)[:3] for r in exports.read_export(spark, [p], schema).collect()), key=repr)
    assert rows == sorted([("1", "2", None), ("1", "2", "3"), ("x;y", "2", "3")], key=repr)


def test_text_timestamps_both_formats_and_bad(spark):
    df = spark.createDataFrame([("05.03.2024 10:11",), ("05.03.2024 10:11:12",), ("bad",)], "t string")
    got = [r[0] for r in df.select(parse_text_ts("t")).collect()]
    assert str(got[0]) == "2024-03-05 10:11:00" and str(got[1]) == "2024-03-05 10:11:12" and got[2] is None


def test_null_customer_and_bad_time_are_quarantined(orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-01-01 10:00", 5), (None, 2, "Paid", "2024-01-01 10:00", 5),
                        (3, 3, "Paid", None, 5)])
    assert base.valid_orders(orders).count() == 1
    reasons = sorted(r["reject_reason"] for r in base.rejected_orders(orders).collect())
    assert reasons == ["bad_timestamp", "null_customer"]
    assert base.paid_orders(orders).count() == 1


def test_keyed_loads(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, merge.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, merge.insert_ignore(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "C")]


def test_key_assertion(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k long")
    quality.assert_unique(ok, ["k"], "t")
    dup = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    with pytest.raises(quality.KeyViolation):
        quality.assert_unique(dup, ["k"], "t")
    row = quality.key_violations(dup, ["k"], "t").first()
    assert (row["duplicate_keys"], row["duplicate_rows"], row["null_keys"]) == (1, 2, 1)


ORDERS_HEADER = ("OrderIdsMindboxId;OrderFirstActionIdsMindboxId;OrderCustomerIdsMindboxId;"
                 "OrderFirstActionDateTimeUtc;OrderTotalPrice;OrderLineStatusIdsExternalId\n")
EVENTS_HEADER = "CustomerActionIdsMindboxId;CustomerActionCustomerIdsMindboxId;CustomerActionDateTimeUtc\n"


def _orders_csv(rows):
    return ORDERS_HEADER + "".join(f"{k};{k + 1000};{c};{t};{p};{s}\n" for k, c, t, p, s in rows)


def test_pipeline_reload_is_keyed_and_idempotent(spark, tmpdir_run):
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    orders = [(1, 7, "05.01.2024 10:11", 100, "Paid"), (2, 7, "07.02.2024 11:00:05", 50, "Paid"),
              (3, 8, "09.02.2024 12:00", 70, "Paid"), (4, 9, "10.02.2024 12:00", 20, "Cancelled"),
              (5, 9, "bad time", 20, "Paid")]
    _write(os.path.join(land, "orders.csv"), _orders_csv(orders))
    _write(os.path.join(land, "events_1.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n2;8;02.02.2024 10:00\n")
    _write(os.path.join(land, "events_2.csv"), EVENTS_HEADER + "3;9;03.01.2024 09:00\n")

    r1 = run_pipeline(spark, out_dir=out, as_of="2024-02-29", source="exports", landing_dir=land)
    assert sorted(r1["files"]) == ["events_1.csv", "events_2.csv", "orders.csv"]
    assert r1["rows_per_file"] == {"orders.csv": 5, "events_1.csv": 2, "events_2.csv": 1}
    assert r1["rejected_orders"] == 1 and r1["rejected_events"] == 0  # the unparsable time
    assert spark.read.parquet(r1["rejected_orders_path"]).first()["reject_reason"] == "bad_timestamp"
    rfm = {r["customer_id"]: r for r in spark.read.parquet(f"{r1['marts']}/rfm").collect()}
    assert set(rfm) == {7, 8} and rfm[7]["frequency"] == 2
    assert spark.read.parquet(f"{r1['marts']}/cohorts_all").count() == 3   # users 7, 8, 9 from events

    r2 = run_pipeline(spark, out_dir=out, as_of="2024-02-29", source="exports", landing_dir=land)
    assert r2.get("skipped")

    orders[1] = (2, 7, "07.02.2024 11:00:05", 55, "Paid")               # one row changed
    _write(os.path.join(land, "orders.csv"), _orders_csv(orders))
    r3 = run_pipeline(spark, out_dir=out, as_of="2024-02-29", source="exports", landing_dir=land)
    assert r3["files"] == ["orders.csv"] and r3["rows_per_file"] == {"orders.csv": 5}
    state = versions.read(spark, os.path.join(out, "_state", "orders"))
    assert state.count() == 5 and state.select("OrderIdsMindboxId").distinct().count() == 5
    assert float(state.where(F.col("OrderIdsMindboxId") == 2).first()["OrderTotalPrice"]) == 55.0
    assert current_marts(spark, out, "2024-02-29") == r3["marts"]
    paid = read_mart(spark, r3["marts"], "paid_only")
    assert paid.count() == 3 and paid.where(F.col("order_date").isNull()).count() == 0   # bad time quarantined
    manifest = versions.read(spark, os.path.join(out, "_state", "manifest"))
    assert manifest.count() == 3


def test_changed_files_by_md5(spark, tmpdir_run):
    _write(os.path.join(tmpdir_run, "a.csv"), "x\n1\n")
    _write(os.path.join(tmpdir_run, "b.csv"), "x\n2\n")
    _write(os.path.join(tmpdir_run, "c.txt"), "not a csv\n")
    d = exports.file_digests(spark, tmpdir_run)
    assert sorted(r["file_name"] for r in exports.list_csv(spark, tmpdir_run).collect()) == ["a.csv", "b.csv"]
    seen = spark.createDataFrame([(r["file_name"], r["md5"]) for r in d.collect()], "file_name string, md5 string")
    manifest = exports.updated_manifest(None, seen)
    assert exports.changed_files(d, manifest).count() == 0
    _write(os.path.join(tmpdir_run, "b.csv"), "x\n3\n")
    changed = exports.changed_files(exports.file_digests(spark, tmpdir_run), manifest).collect()
    assert [r["file_name"] for r in changed] == ["b.csv"]


def test_pipeline_marts_equal_the_lazy_plan(spark, tmpdir_run):
    """Materialised intermediates and concurrent writes change nothing in the 18 marts."""
    from donorlens.plans.catalog import ORDERS_AS_OF, _plan
    sf = "/root/testdata/sf0.001"
    r = run_pipeline(spark, out_dir=tmpdir_run, as_of=ORDERS_AS_OF, source="tpch", orders_dir=sf)
    assert r["intermediates"] and not any(os.path.exists(p.replace("file:", "")) for p in r["intermediates"])
    lazy = _plan(spark, sf)
    for name, df in lazy.marts().items():
        written = spark.read.parquet(f"{r['marts']}/{name}")
        assert written.columns == df.columns, name
        assert written.exceptAll(df).count() == 0 and df.exceptAll(written).count() == 0, name


def test_insert_ignore_keeps_stored_rows(spark, tmpdir_run):
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    kw = dict(as_of="2024-01-31", source="exports", landing_dir=land, mode="insert_ignore")
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid")]))
    run_pipeline(spark, out_dir=out, **kw)
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 999, "Paid"),
                                                         (2, 8, "06.01.2024 10:11", 30, "Paid")]))
    r = run_pipeline(spark, out_dir=out, **kw)
    assert r["rows_per_file"] == {"orders.csv": 1}                    # only the new key
    state = versions.read(spark, os.path.join(out, "_state", "orders"))
    assert sorted((r[0], float(r[1])) for r in state.select("OrderIdsMindboxId", "OrderTotalPrice").collect()) == \
        [(1, 100.0), (2, 30.0)]                                       # stored row kept


def _rows(spark, *keys):
    return spark.createDataFrame([(k, "x", "a.csv") for k in keys], "k long, v string, _source_file string")


def _keys(spark, table):
    return sorted(r["k"] for r in versions.read(spark, table).collect())


def test_two_writers_keep_all_rows(spark, tmpdir_run, monkeypatch):
    """Two loads that start from one version: the second is refused and, run again, keeps the first one's rows."""
    from donorlens.plans.pipeline import load_table
    t = os.path.join(tmpdir_run, "t")
    load_table(spark, "t", _rows(spark, 1, 2), t, ["k"], "a")
    publish = versions.publish

    def overtaken(*args):
        monkeypatch.setattr(versions, "publish", publish)
        load_table(spark, "t", _rows(spark, 3), t, ["k"], "b")       # another writer comes first
        return publish(*args)

    monkeypatch.setattr(versions, "publish", overtaken)
    with pytest.raises(versions.StaleVersion):
        load_table(spark, "t", _rows(spark, 4), t, ["k"], "c")
    assert _keys(spark, t) == [1, 2, 3] and not versions.loaded(spark, t, "c")
    load_table(spark, "t", _rows(spark, 4), t, ["k"], "c")
    assert _keys(spark, t) == [1, 2, 3, 4] and versions.newest(spark, t) == (3, "run=c")
    assert load_table(spark, "t", _rows(spark, 4), t, ["k"], "b") == {}  # a replay of an older load does nothing
    assert _keys(spark, t) == [1, 2, 3, 4]


def test_lost_versions_stop_the_load(spark, tmpdir_run):
    import shutil

    from donorlens.plans.pipeline import load_table
    t = os.path.join(tmpdir_run, "t")
    load_table(spark, "t", _rows(spark, 1, 2), t, ["k"], "a")
    shutil.move(os.path.join(t, "versions"), os.path.join(tmpdir_run, "kept"))
    with pytest.raises(versions.LostVersions):
        load_table(spark, "t", _rows(spark, 3), t, ["k"], "b")
    shutil.move(os.path.join(tmpdir_run, "kept"), os.path.join(t, "versions"))
    load_table(spark, "t", _rows(spark, 3), t, ["k"], "b")
    assert _keys(spark, t) == [1, 2, 3]


def test_failed_first_load_is_repeated_and_old_versions_expire(spark, tmpdir_run, monkeypatch):
    from donorlens.plans.pipeline import load_table
    t = os.path.join(tmpdir_run, "t")
    with monkeypatch.context() as m:
        m.setattr(versions, "advance", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            load_table(spark, "t", _rows(spark, 1), t, ["k"], "a")
    assert versions.read(spark, t) is None                             # data, but not published
    for run, key in (("a", 1), ("b", 2), ("c", 3)):
        load_table(spark, "t", _rows(spark, key), t, ["k"], run)
    assert versions.expire(spark, t, keep=2) == ["run=a"] and _keys(spark, t) == [1, 2, 3]
    assert sorted(os.listdir(os.path.join(t, "data"))) == ["run=b", "run=c"]


def test_append_refuses_stored_keys(spark, tmpdir_run):
    from donorlens.plans.pipeline import load_table
    t = os.path.join(tmpdir_run, "t")
    load_table(spark, "t", _rows(spark, 1), t, ["k"], "a", "append")
    with pytest.raises(quality.KeyViolation, match="1 appended rows"):
        load_table(spark, "t", _rows(spark, 1, 2), t, ["k"], "b", "append")
    load_table(spark, "t", _rows(spark, 2), t, ["k"], "c", "append")
    assert _keys(spark, t) == [1, 2]


def test_ordered_digest_does_not_depend_on_splits(spark, tmpdir_run):
    lines = [f"{i};{'x' * (i % 50)}" for i in range(4000)]
    for name, text in (("a", lines), ("b", lines), ("c", [lines[1], lines[0], *lines[2:]]), ("d", lines[:-1])):
        _write(os.path.join(tmpdir_run, f"{name}.csv"), "\n".join(text) + "\n")

    def digests(method):
        return {r["file_name"][0]: r["md5"] for r in exports.file_digests(spark, tmpdir_run, method).collect()}

    whole, lines_only = digests("ordered"), digests("lines")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "4096")
        assert spark.read.option("pathGlobFilter", "*.csv").text(tmpdir_run).rdd.getNumPartitions() > 20  # one file is many tasks
        assert digests("ordered") == whole and digests("lines") == lines_only
    finally:
        for k in keys:
            spark.conf.set(k, old[k])
    assert whole["a"] == whole["b"] and len({whole[k] for k in "acd"}) == 3
    assert lines_only["a"] == lines_only["c"] != lines_only["d"]


def test_manifest_round_trip_and_quoted_line_breaks_in_the_pipeline(spark, tmpdir_run):
    from donorlens.plans.pipeline import export_manifest, import_manifest
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    text = _ORDERS_HEADER + ';note\n1;1;7;05.01.2024 10:11;100;Paid;"two\nlines; ""quoted"""\n2;2;8;06.01.2024 10:11;50;Paid;plain\n'
    _write(os.path.join(land, "orders.csv"), text)
    kw = dict(landing_dir=land, as_of="2024-01-31", names=("paid_only",))
    with pytest.raises(Exception, match="multiline=True"):
        run_pipeline(spark, out_dir=out, **kw)
    r = run_pipeline(spark, out_dir=out, multiline=True, **kw)
    assert r["rows_per_file"] == {"orders.csv": 2} and r["cohorts_from"] == "events (none loaded)"
    notes = {x["OrderIdsMindboxId"]: x["note"] for x in versions.read(spark, os.path.join(out, "_state", "orders")).collect()}
    assert notes == {1: 'two\nlines; "quoted"', 2: "plain"}
    path = os.path.join(tmpdir_run, "manifest.json")
    export_manifest(spark, out, path)
    with pytest.raises(FileExistsError):
        export_manifest(spark, out, path)
    other = os.path.join(tmpdir_run, "other")
    import_manifest(spark, path, other)
    _write(os.path.join(land, "ev_1.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n")
    assert run_pipeline(spark, out_dir=other, **kw)["files"] == ["ev_1.csv"]  # orders.csv is known there


def test_cohorts_come_from_events_unless_asked_otherwise(spark, tmpdir_run):
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid")]))
    kw = dict(out_dir=out, landing_dir=land, as_of="2024-01-31", names=("cohorts_all",))
    r = run_pipeline(spark, **kw)
    assert read_mart(spark, r["marts"], "cohorts_all").count() == 0
    r = run_pipeline(spark, cohorts_from="orders", **kw)
    assert r["cohorts_from"] == "orders" and read_mart(spark, r["marts"], "cohorts_all").count() == 1
    with pytest.raises(ValueError):
        run_pipeline(spark, cohorts_from="clicks", **kw)


def test_scopes_are_separate(spark):
    from donorlens.session import materialize, scratch_scope, written
    frame = spark.range(3)
    with scratch_scope(spark) as outer:
        kept = written(spark, lambda: materialize(frame, "inside").where("id > 0"), "result")
        with scratch_scope(spark) as inner:
            materialize(frame, "other")
            assert len(inner) == 1 and len(outer) == 1
        assert kept.count() == 2 and not os.path.exists(inner[0])
    assert not os.path.exists(outer[0])


def test_line_digest_detects_changed_added_and_removed_lines(spark, tmpdir_run):
    def digests():
        return {r["file_name"]: r["md5"] for r in exports.file_digests(spark, tmpdir_run).collect()}
    _write(os.path.join(tmpdir_run, "a.csv"), "h\n1\n2\n")
    d0 = digests()
    _write(os.path.join(tmpdir_run, "a.csv"), "h\n2\n1\n")          # reordered: same rows
    assert digests() == d0
    for text in ("h\n1\n3\n", "h\n1\n2\n2\n", "h\n1\n"):
        _write(os.path.join(tmpdir_run, "a.csv"), text)
        assert digests() != d0
    md5 = exports.file_digests(spark, tmpdir_run, method="md5").first()
    import hashlib
    assert md5["md5"] == hashlib.md5(b"h\n1\n").hexdigest()


def test_route_union_and_rows_per_file(spark, tmpdir_run):
    orders, events = exports.route(["/x/orders.csv", "/x/ev_1.csv", "/y/ev_2.csv"])
    assert orders == ["/x/orders.csv"] and events == ["/x/ev_1.csv", "/y/ev_2.csv"]
    a = spark.createDataFrame([(1, "u")], "id long, user string")
    b = spark.createDataFrame([(2.5, 2)], "value double, id long")
    u = exports.union_by_name([a, b])
    assert u.columns == ["id", "user", "value"]
    assert sorted(map(tuple, u.collect()), key=repr) == sorted([(1, "u", None), (2, None, 2.5)], key=repr)
    _write(os.path.join(tmpdir_run, "e1.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n2;8;02.01.2024 09:00\n")
    _write(os.path.join(tmpdir_run, "e2.csv"), EVENTS_HEADER + "3;9;03.01.2024 09:00\n")
    df = exports.read_events_export(spark, [os.path.join(tmpdir_run, f) for f in ("e1.csv", "e2.csv")])
    assert {r["_source_file"]: r["rows"] for r in exports.rows_per_file(df).collect()} == {"e1.csv": 2, "e2.csv": 1}


def test_export_columns_are_taken_by_header_name(spark, tmpdir_run):
    # reordered columns, an extra column, a BOM, and a file without the price column
    a = os.path.join(tmpdir_run, "orders.csv")
    _write(a, "﻿OrderTotalPrice;Extra;OrderIdsMindboxId;OrderFirstActionIdsMindboxId;OrderCustomerIdsMindboxId;"
              "OrderFirstActionDateTimeUtc;OrderLineStatusIdsExternalId\n"
              "12.50;zz;1;1001;7;05.01.2024 10:11;Paid\n"
              "oops;zz;2;1002;7;05.01.2024 10:12;Paid\n"
              "1;zz;3;1003;7;05.01.2024 10:12;Paid;too;many\n")
    b = os.path.join(tmpdir_run, "orders_old.csv")
    _write(b, "OrderIdsMindboxId;OrderCustomerIdsMindboxId;OrderFirstActionDateTimeUtc\n4;8;06.01.2024 10:00\n")
    df = exports.read_orders_export(spark, [a, b])
    rows = {r["OrderIdsMindboxId"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 4}                                     # the long row is skipped
    assert float(rows[1]["OrderTotalPrice"]) == 12.5 and rows[1]["Extra"] == "zz"
    assert rows[1]["OrderCustomerIdsMindboxId"] == 7
    assert rows[2]["OrderTotalPrice"] is None                         # unparsable -> NULL
    assert rows[4]["OrderTotalPrice"] is None and rows[4]["Extra"] is None
    assert rows[4]["_source_file"] == "orders_old.csv"


def test_incremental_grid_equals_full_recompute(spark, tmpdir_run):
    """Two loads fold the changed customers into the stored grid; the marts equal a pipeline that loads everything at once."""
    inc_land, full_land = os.path.join(tmpdir_run, "inc"), os.path.join(tmpdir_run, "full")
    os.makedirs(inc_land)
    os.makedirs(full_land)
    batch1 = [(1, 7, "05.01.2024 10:11", 100, "Paid"), (2, 7, "07.02.2024 11:00:05", 50, "Paid"),
              (3, 8, "09.02.2024 12:00", 70, "Paid")]
    batch2 = [(4, 7, "08.02.2024 10:00", 20, "Paid"), (5, 9, "01.03.2024 12:00", 30, "Paid"),
              (6, 8, "02.03.2024 12:00", 15, "Cancelled")]
    ev1, ev2 = "1;7;01.01.2024 09:00\n2;8;02.02.2024 10:00\n", "3;9;03.01.2024 09:00\n4;7;31.12.2023 23:00\n"
    _write(os.path.join(inc_land, "orders.csv"), _orders_csv(batch1))
    _write(os.path.join(inc_land, "ev_1.csv"), EVENTS_HEADER + ev1)
    kw = dict(as_of="2024-03-31", source="exports", mode="insert_ignore")
    run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "out_inc"), landing_dir=inc_land, **kw)
    # the second batch arrives as a new version of orders.csv holding both batches (insert-ignore
    # keeps stored keys, adds new ones) plus a new events file
    _write(os.path.join(inc_land, "orders.csv"), _orders_csv(batch1 + batch2))
    _write(os.path.join(inc_land, "ev_2.csv"), EVENTS_HEADER + ev2)
    r_inc = run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "out_inc"), landing_dir=inc_land, **kw)
    state = os.path.join(tmpdir_run, "out_inc", "_state")
    assert versions.newest(spark, os.path.join(state, "grid"))[0] == 2
    run = versions.newest(spark, os.path.join(state, "orders"))[1]
    changed = spark.read.parquet(os.path.join(state, "changed", run))
    assert sorted(r[0] for r in changed.collect()) == [7, 8, 9]

    _write(os.path.join(full_land, "orders.csv"), _orders_csv(batch1 + batch2))
    _write(os.path.join(full_land, "ev_1.csv"), EVENTS_HEADER + ev1)
    _write(os.path.join(full_land, "ev_2.csv"), EVENTS_HEADER + ev2)
    r_full = run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "out_full"), landing_dir=full_land, **kw)
    for name in ("rfm", "cohorts_all", "cohorts_paid", "ltv_cohorts", "rr_cohorts", "ac_cohort", "cdr", "paid_only"):
        a = read_mart(spark, r_inc["marts"], name)
        b = read_mart(spark, r_full["marts"], name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_command_line_runs_the_pipeline(spark, tmpdir_run, capsys):
    import json

    from donorlens.__main__ import main
    main(["--out", tmpdir_run, "--source", "tpch", "--orders-dir", "/root/testdata/sf0.001", "--as-of", "2001-08-01"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["as_of"] == "2001-08-01" and report["rejected_orders"] == 0
    assert spark.read.parquet(f"{report['marts']}/cdr").count() > 0


def test_replayed_load_and_repeated_refresh_do_not_double_count(spark, tmpdir_run):
    from donorlens.plans.pipeline import load_files, refresh_marts
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid"),
                                                           (2, 7, "06.01.2024 10:11", 50, "Paid")]))
    state = os.path.join(out, "_state")
    files = [(r["path"], r["file_name"], r["md5"]) for r in exports.file_digests(spark, land).collect()]
    load_files(spark, files, state, "r1", mode="insert_ignore")
    load_files(spark, files, state, "r1", mode="insert_ignore")          # the same micro-batch again
    assert versions.read(spark, os.path.join(state, "orders")).count() == 2
    for run in ("r1", "r2", "r3"):
        refresh_marts(spark, out, dt_date("2024-01-31"), run, ("rfm",))
    grid = versions.read(spark, os.path.join(state, "grid")).collect()
    assert len(grid) == 1 and grid[0]["n_orders"] == 2                  # 2 orders in the one cell
    assert versions.newest(spark, os.path.join(state, "grid"))[0] == 1  # nothing new: not made again


def dt_date(s):
    import datetime
    return datetime.date.fromisoformat(s)


def test_upserts_fold_into_the_grid_without_shuffling_it(spark, tmpdir_run):
    from donorlens.plans import pipeline
    land, out, full = (os.path.join(tmpdir_run, d) for d in ("landing", "out", "full"))
    os.makedirs(land)
    os.makedirs(full)
    a = [(1, 7, "05.01.2024 10:11", 100, "Paid"), (2, 7, "07.02.2024 11:00", 50, "Paid"),
         (3, 8, "09.02.2024 12:00", 70, "Paid"), (6, 9, "11.01.2024 12:00", 5, "Paid")]
    b = [(2, 8, "07.02.2024 11:00", 55, "Paid"), (4, 9, "10.02.2024 12:00", 20, "Paid")]   # 2 goes to another customer, 4 new
    c = [(5, 8, "01.03.2024 12:00", 30, "Paid")]                                         # only new keys
    kw = dict(as_of="2024-03-31", source="exports", mode="upsert")
    for batch in (a, b, c):
        _write(os.path.join(land, "orders.csv"), _orders_csv(batch))
        r = run_pipeline(spark, out_dir=out, landing_dir=land, **kw)
    state = os.path.join(out, "_state")
    grid = versions.read(spark, os.path.join(state, "grid"))
    orders = orders_from_export(versions.read(spark, os.path.join(state, "orders")))
    changed = spark.read.parquet(os.path.join(state, "changed", versions.newest(spark, os.path.join(state, "orders"))[1]))
    folded = pipeline.folded_grid(grid, orders, changed.withColumnRenamed("OrderCustomerIdsMindboxId", "customer_id"))
    folded.collect()
    plan = folded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    kept = plan[plan.index("Union"):].split("Window")[0]
    assert "LeftAnti" in kept and "hashpartitioning(customer_id" not in kept.split("month")[0]

    _write(os.path.join(full, "orders.csv"), _orders_csv([a[0], a[2], a[3]] + b + c))
    r_full = run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "out_full"), landing_dir=full, **kw)
    for name in ("rfm", "cohorts_paid", "cohorts_revenue_arppu_data", "ltv_cohorts", "rr_cohorts", "ac_cohort",
                 "cdr", "paid_only", "arppu_t"):
        x, y = read_mart(spark, r["marts"], name), read_mart(spark, r_full["marts"], name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_exports_pipeline_equals_tpch_pipeline(spark, tmpdir_run):
    """The driver's orders written as a ';' export (text times, status Paid) and run through
    the export path give the same 18 marts as the Parquet path."""
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.001"
    land = os.path.join(tmpdir_run, "landing")
    os.makedirs(land)
    t = pq.read_table(os.path.join(sf, "orders.parquet")).to_pylist()
    rows = [(r["o_orderkey"], r["o_custkey"], r["o_orderdate"].strftime("%d.%m.%Y %H:%M:%S"),
             f"{r['o_totalprice']:.2f}", "Paid" if r["o_orderstatus"] == "F" else r["o_orderstatus"]) for r in t]
    _write(os.path.join(land, "orders.csv"), _orders_csv(rows))
    ex = run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "ex"), landing_dir=land, as_of="2001-08-01", cohorts_from="orders")
    tp = run_pipeline(spark, out_dir=os.path.join(tmpdir_run, "tp"), source="tpch", orders_dir=sf, as_of="2001-08-01")
    from donorlens.plans.marts import MartPlan
    for name in MartPlan.MART_NAMES:
        a, b = read_mart(spark, ex["marts"], name), read_mart(spark, tp["marts"], name)
        if name == "paid_only":  # the export's order id is the first-action id column (= o_orderkey + 1000 here)
            a = a.withColumn("order_id", F.col("order_id") - 1000)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_imported_json_manifest_skips_files_already_loaded(spark, tmpdir_run):
    import hashlib
    import json
    from donorlens.plans.pipeline import import_manifest
    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    text = _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid")])
    _write(os.path.join(land, "orders.csv"), text)
    _write(os.path.join(land, "ev_1.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n")
    manifest = os.path.join(tmpdir_run, "hashes.json")
    _write(manifest, json.dumps({"orders.csv": hashlib.md5(text.encode()).hexdigest()}))
    import_manifest(spark, manifest, out)
    r = run_pipeline(spark, out_dir=out, landing_dir=land, as_of="2024-01-31", digest="md5")
    assert r["files"] == ["ev_1.csv"]                                   # orders.csv is known already


def test_failed_or_stale_refresh_is_redone(spark, tmpdir_run, monkeypatch):
    from donorlens.plans import pipeline

    land, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "out")
    os.makedirs(land)
    _write(os.path.join(land, "orders.csv"), _orders_csv([(1, 7, "05.01.2024 10:11", 100, "Paid")]))
    _write(os.path.join(land, "events.csv"), EVENTS_HEADER + "1;7;01.01.2024 09:00\n")

    def run(as_of):
        return run_pipeline(spark, out_dir=out, as_of=as_of, source="exports", landing_dir=land, names=("rfm",))

    def broken(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "refresh_marts", broken)
        with pytest.raises(RuntimeError, match="stopped"):
            run("2024-02-29")
    assert "marts" in run("2024-02-29")          # the files are loaded, the refresh is redone
    assert run("2024-02-29").get("skipped")
    assert "marts" in run("2024-03-31")          # another as-of date


_ORDERS_HEADER = ("OrderIdsMindboxId;OrderFirstActionIdsMindboxId;OrderCustomerIdsMindboxId;"
                  "OrderFirstActionDateTimeUtc;OrderTotalPrice;OrderLineStatusIdsExternalId")


def test_price_that_does_not_parse_is_quarantined(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "orders.csv")
    _write(p, _ORDERS_HEADER + "\n1;1;7;01.01.2001 10:00;1 200,50;Paid\n2;2;7;02.01.2001 10:00;50.00;Paid\n"
           "3;3;8;02.01.2001 10:00;;Paid\n")
    orders = orders_from_export(exports.read_orders_export(spark, [p]))
    assert sorted(r["order_id"] for r in base.valid_orders(orders).collect()) == [2, 3]  # a missing price stays
    bad = base.rejected_orders(orders).collect()
    assert [(r["order_id"], r["reject_reason"]) for r in bad] == [(1, "bad_value:OrderTotalPrice")]
    assert base.paid_only(orders).count() == 2


_NOTES = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])


def test_quotes_and_backslashes_in_quoted_text(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "a.csv")
    _write(p, 'id;note\n1;"say ""hi""; twice"\n2;"ends with \\"\n3;"""quoted"""\n4;5" pipe\n')
    rows = {r["id"]: r["note"] for r in exports.read_export(spark, [p], _NOTES).collect()}
    assert rows == {1: 'say "hi"; twice', 2: "ends with \\", 3: '"quoted"', 4: '5" pipe'}


def test_quoted_line_break_stops_the_load_or_is_read_whole(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "a.csv")
    _write(p, 'id;note\n1;"two\nlines"\n2;plain\n')
    with pytest.raises(Exception, match="multiline=True"):
        exports.read_export(spark, [p], _NOTES).collect()
    rows = {r["id"]: r["note"] for r in exports.read_export(spark, [p], _NOTES, multiline=True).collect()}
    assert rows == {1: "two\nlines", 2: "plain"}


def test_file_names_with_spaces_and_signs(spark, tmpdir_run):
    names = ["my events.csv", "a+b 100%.csv", "заказы.csv"]
    for n in names:
        _write(os.path.join(tmpdir_run, n), "id;note\n1;x\n")
    found = {r["file_name"]: r["path"] for r in exports.file_digests(spark, tmpdir_run).collect()}
    assert sorted(found) == sorted(names)
    df = exports.read_export(spark, list(found.values()), _NOTES)
    assert df.count() == 3


def test_session_check_takes_sparks_own_defaults(spark):
    from donorlens.session import check_session
    session = spark.newSession()
    session.conf.unset("spark.sql.ansi.enabled")  # as in a session that never named it: on by default
    check_session(session)
    session.conf.set("spark.sql.ansi.enabled", "false")
    with pytest.raises(RuntimeError, match="spark.sql.ansi.enabled=true, session has 'false'"):
        check_session(session)
