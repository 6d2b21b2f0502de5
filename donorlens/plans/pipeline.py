"""D-08: the refresh - ingest changed exports, keyed load, then the 18 marts.

Layout under ``out_dir`` (any Hadoop-compatible path):

    _state/orders, _state/events, _state/manifest     versioned tables (``sources.versions``)
    _state/grid                                       the donor x month grid with cohorts, versioned
    _state/changed/run=<id>                           the customers whose orders the load changed
    marts/as_of=<date>/run=<id>/<mart>/               one Parquet table per mart
    marts/as_of=<date>/versions/v<n>                  one line: the snapshot in use

A load parses the changed files once into a written batch, checks its keys, and publishes the next version of the table;
the manifest is published after the tables it describes, so a failed run is simply retried. The grid is brought up to date
from the customers that the loads since its version changed: their rows are made anew from their orders, all others are
kept, without a shuffle of the grid. Every mart reads the grid.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from donorlens.functions.timecols import as_of_date
from donorlens.operators import base, merge, quality
from donorlens.plans.marts import MartPlan
from donorlens.schemas import EVENTS_KEY, ORDERS_CUSTOMER, ORDERS_KEY
from donorlens.session import check_session, materialize, scratch_scope
from donorlens.sources import exports, versions
from donorlens.sources.tables import (PAID_STATUS, TPCH_PAID_STATUS, activity_from_export, activity_from_orders,
                                      orders_from_export, orders_from_tpch, read_table)

#: Loads since the grid's version that are folded into it; after more the grid is made anew.
FOLDED_LOADS = 50


# ---- ingest ----------------------------------------------------------------------------------

def load_table(spark: SparkSession, name: str, rows: DataFrame, table_dir: str, key: list[str], run_id: str,
               mode: str = "upsert", owner: str | None = None, changed_dir: str | None = None) -> dict[str, int]:
    """Keyed load of export rows into one stored table (see ``load_files``); rows loaded per file.

    The rows are parsed once, into a written batch: what is checked is what is loaded. With ``owner`` (a column) and
    ``changed_dir``, the owners of rows that the load adds or replaces are written beside the version.
    """
    if versions.loaded(spark, table_dir, run_id):
        return {}  # loaded by an earlier attempt of this run (a replayed micro-batch)
    number, line = versions.newest(spark, table_dir)
    old = spark.read.parquet(f"{table_dir}/data/{line}") if line else None
    # rows keep their lineage: _source_file (export file) and _load_run (this load)
    batch = materialize(rows.withColumn("_load_run", F.lit(run_id)), f"{name}-batch")
    # D-07: the batch's keys are unique and not NULL; with the stored keys unique, every
    # mode below keeps the table unique by construction (anti-join before union)
    quality.assert_unique(batch, key, f"{name} batch")
    if mode == "insert_ignore" and old is not None:
        batch = materialize(merge.new_rows(old, batch, key), f"{name}-new")
    replaced = old.join(batch.select(*key), key, "left_semi") if old is not None and mode != "insert_ignore" else None
    if mode == "append" and replaced is not None and (clash := replaced.count()):
        raise quality.KeyViolation(f"{name}: {clash} appended rows repeat a stored key")
    if old is None:
        table = batch
    elif mode == "upsert":
        table = merge.upsert(old, batch, key)
    else:
        table = old.unionByName(batch, allowMissingColumns=True)
    if owner and changed_dir:
        owners = batch.select(owner)
        if replaced is not None and mode == "upsert":
            owners = owners.unionByName(replaced.select(owner))
        owners.where(F.col(owner).isNotNull()).distinct().write.mode("overwrite").parquet(f"{changed_dir}/run={run_id}")
    versions.publish(spark, table_dir, table, run_id, number)
    counts = exports.rows_per_file(batch).collect()  # rows loaded, one row per file
    return {r["_source_file"]: r["rows"] for r in counts}


def load_files(spark: SparkSession, files: list[tuple[str, str, str]], state_dir: str, run_id: str,
               mode: str = "upsert", multiline: bool = False) -> dict:
    """Keyed load of the given export files (path, file_name, md5) into the state tables,
    then the manifest. D-03..D-07.

    ``mode``: ``upsert`` (a changed row replaces the stored one), ``insert_ignore`` (the stored
    row is kept, the reference's ON CONFLICT DO NOTHING) or ``append`` (the reference's load).
    ``multiline``: quoted text in the files may hold line breaks (see ``exports.read_export``).
    """
    order_paths, event_paths = exports.route([p for p, _, _ in files])
    key_of = {"orders": ORDERS_KEY, "events": EVENTS_KEY}
    rows_per_file: dict[str, int] = {}
    for name, paths, reader in (("orders", order_paths, exports.read_orders_export),
                                ("events", event_paths, exports.read_events_export)):
        if paths:
            owner = {"owner": ORDERS_CUSTOMER, "changed_dir": f"{state_dir}/changed"} if name == "orders" else {}
            rows_per_file.update(load_table(spark, name, reader(spark, paths, multiline), f"{state_dir}/{name}",
                                            [key_of[name]], run_id, mode, **owner))
    # the digests taken before the load, not a re-evaluation of the listing after it: a file
    # rewritten meanwhile must show up as changed on the next run
    seen = spark.createDataFrame([(f, m) for _, f, m in files], "file_name string, md5 string")
    manifest_dir = f"{state_dir}/manifest"
    versions.replace(spark, manifest_dir, exports.updated_manifest(versions.read(spark, manifest_dir), seen), run_id)
    return {"files": [f for _, f, _ in files], "rows_per_file": rows_per_file}


def import_manifest(spark: SparkSession, json_path: str, out_dir: str) -> DataFrame:
    """Seed the state manifest from a ``{file_name: md5}`` JSON file, so a landing folder that
    was already loaded elsewhere is not loaded again (run with ``digest="md5"``)."""
    state = f"{out_dir.rstrip('/')}/_state/manifest"
    versions.replace(spark, state, exports.manifest_from_json(spark, json_path), "imported")
    return versions.read(spark, state)


def export_manifest(spark: SparkSession, out_dir: str, json_path: str) -> None:
    """The state manifest as a new ``{file_name: md5}`` JSON file, as ``import_manifest`` reads it."""
    exports.write_manifest(spark, versions.read(spark, f"{out_dir.rstrip('/')}/_state/manifest"), json_path)


def ingest_exports(spark: SparkSession, landing_dir: str, state_dir: str, run_id: str,
                   mode: str = "upsert", digest: str = "lines", multiline: bool = False) -> dict | None:
    """D-01..D-07 for one landing folder. Returns None when no file is new or changed."""
    manifest = versions.read(spark, f"{state_dir}/manifest")
    changed = exports.changed_files(exports.file_digests(spark, landing_dir, digest), manifest)
    # one row per changed file: a file listing, bounded by the number of files
    files = [(r["path"], r["file_name"], r["md5"]) for r in changed.select("path", "file_name", "md5").collect()]
    return load_files(spark, files, state_dir, run_id, mode, multiline) if files else None


def _whole_grid(orders: DataFrame) -> DataFrame:
    return base.with_cohort(base.donor_month_grid(base.paid_orders(orders, PAID_STATUS)))


def by_month(grid: DataFrame) -> DataFrame:
    """The grid as it is stored: sorted by month within each file, so that readers of some months skip the other row groups
    by their statistics. No shuffle, and no more files than tasks."""
    return grid.sortWithinPartitions("month")


def folded_grid(grid: DataFrame, orders: DataFrame, changed: DataFrame) -> DataFrame:
    """``grid`` with the rows of the ``changed`` customers made anew from all their orders."""
    return grid.join(changed, "customer_id", "left_anti").unionByName(_whole_grid(orders.join(changed, "customer_id", "left_semi")))


def current_grid(spark: SparkSession, state: str, run_id: str) -> DataFrame:
    """The donor x month grid with cohorts of the stored orders, brought up to date and published.

    Rows of customers that no load since the grid's version changed are kept as they are: a filter by the changed
    customers (broadcast by Spark where they are few), no shuffle of the grid. The others' rows are made from their orders.
    """
    number, _ = versions.newest(spark, f"{state}/orders")
    grid_dir = f"{state}/grid"
    made, line = versions.newest(spark, grid_dir)
    of = int(line.rsplit("-orders-", 1)[1]) if line else 0
    if line and of == number:
        return spark.read.parquet(f"{grid_dir}/data/{line}")
    orders = orders_from_export(versions.read(spark, f"{state}/orders"))
    grid = None
    if line and number - of <= FOLDED_LOADS:
        try:
            loads = [versions.line_of(spark, f"{state}/orders", k) for k in range(of + 1, number + 1)]
            changed = spark.read.parquet(*[f"{state}/changed/{load}" for load in loads])
        except AnalysisException:  # a load whose changes weren't noted
            changed = None
        if changed is not None:
            changed = materialize(changed.select(F.col(ORDERS_CUSTOMER).alias("customer_id")).distinct(), "changed")
            grid = folded_grid(spark.read.parquet(f"{grid_dir}/data/{line}"), orders, changed)
    versions.publish(spark, grid_dir, by_month(_whole_grid(orders) if grid is None else grid), f"{run_id}-orders-{number}", made)
    return versions.read(spark, grid_dir)


def refresh_marts(spark: SparkSession, out_dir: str, as_of, run_id: str, names: tuple[str, ...] | None = None,
                  cohorts_from: str = "events") -> dict:
    """Marts from the export state tables (paid status ``Paid``).

    ``cohorts_from``: the all-user cohorts start with a user's first event (``events``; there are none while no events
    are loaded) or with the first order of any status (``orders``).
    """
    state = f"{out_dir.rstrip('/')}/_state"
    stored, events = versions.read(spark, f"{state}/orders"), versions.read(spark, f"{state}/events")
    if stored is None:
        return {"skipped": "no orders loaded yet"}
    orders = orders_from_export(stored)
    rejected = {"orders": base.rejected_orders(orders)}
    if events is not None:
        rejected["events"] = base.rejected_activity(activity_from_export(events))
    if cohorts_from == "orders":
        activity = activity_from_orders(base.valid_orders(orders))
    elif cohorts_from != "events":
        raise ValueError(f"unknown source of cohorts {cohorts_from!r}")
    elif events is not None:
        activity = activity_from_export(events)
    else:
        activity = activity_from_orders(orders).where("false")
    report = {"cohorts_from": cohorts_from if events is not None or cohorts_from == "orders" else "events (none loaded)"}
    report.update(_write_rejected(spark, rejected, out_dir, run_id))
    plan = build_plan(spark, base.valid_orders(orders), as_of, PAID_STATUS, activity, current_grid(spark, state, run_id))
    report["marts"] = write_marts(spark, plan, out_dir, run_id, names)
    return report


def read_mart(spark: SparkSession, snapshot: str, name: str) -> DataFrame:
    """A mart of a published snapshot."""
    return spark.read.parquet(f"{snapshot.rstrip('/')}/{name}")


def current_marts(spark: SparkSession, out_dir: str, as_of) -> str:
    """The published snapshot of an as-of date."""
    return versions.newest(spark, _snapshot_dir(out_dir, as_of_date(as_of)))[1]


def _write_rejected(spark: SparkSession, rejected: dict[str, DataFrame], out_dir: str, run_id: str) -> dict:
    """Unattributable rows, written and counted while they are written."""
    report = {}
    for name, df in rejected.items():
        path = f"{out_dir.rstrip('/')}/rejected/{name}/run={run_id}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        report[f"rejected_{name}"] = seen.get["rows"]
        report[f"rejected_{name}_path"] = path
    return report


# ---- marts ------------------------------------------------------------------------------------

def build_plan(spark: SparkSession, orders: DataFrame, as_of, paid_value: str,
               activity: DataFrame | None, grid: DataFrame | None = None) -> MartPlan:
    """MartPlan over intermediates materialised in the shared checkpoint folder.

    The windowed grid (customer x month) is the one large intermediate (built from ``grid``
    when the caller maintains one); the cohort slot table and the all-user cohort sizes have one
    row per cohort month and feed 12 and 4 marts.
    """
    plan = MartPlan(orders, as_of=as_of, paid_value=paid_value, activity=activity, grid=grid)
    # a stored grid has its cohort columns already
    gwc = plan.grid_with_cohort if grid is not None and "cohort_month" in grid.columns else materialize(by_month(plan.grid_with_cohort), "grid")
    sizes = materialize(base.cohort_sizes(base.paid_cohorts(gwc)), "paid_sizes")
    plan = MartPlan(orders, as_of=as_of, paid_value=paid_value, activity=plan.activity, grid=gwc, paid_sizes=sizes)
    return MartPlan(orders, as_of=as_of, paid_value=paid_value, activity=plan.activity, grid=gwc,
                    slot_table=materialize(plan.slots, "slots"),
                    user_sizes=materialize(plan.all_user_sizes, "user_sizes"))


def _snapshot_dir(out_dir: str, as_of) -> str:
    return f"{out_dir.rstrip('/')}/marts/as_of={as_of.isoformat()}"


def write_marts(spark: SparkSession, plan: MartPlan, out_dir: str, run_id: str,
                names: tuple[str, ...] | None = None, parallel: int = 8) -> str:
    """One Parquet table per mart under a new run directory, then publish it as the date's newest snapshot.

    The marts are independent jobs; ``parallel`` of them are submitted at once from driver
    threads so the small ones fill executors the large ones leave idle. ``overwrite`` inside
    the run directory makes a replayed run (same id) idempotent.
    """
    snap = _snapshot_dir(out_dir, plan.as_of)
    target = f"{snap}/run={run_id}"

    def write(name: str) -> None:
        getattr(plan, name)().write.mode("overwrite").parquet(f"{target}/{name}")

    todo = list(names or MartPlan.MART_NAMES)
    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for f in [pool.submit(write, n) for n in todo]:
                f.result()
    else:
        for n in todo:
            write(n)
    versions.advance(spark, snap, versions.newest(spark, snap)[0], target)
    return target


def new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def _refreshed_from(spark: SparkSession, state: str, as_of: dt.date, names: tuple[str, ...] | None, cohorts_from: str) -> str:
    """What a refresh depends on: the as-of date, the marts asked for and the versions of the stored tables."""
    numbers = [f"{table}={versions.newest(spark, f'{state}/{table}')[0]}" for table in ("orders", "events")]
    return " ".join([f"as_of={as_of.isoformat()}", f"names={','.join(names or ('all',))}", f"cohorts={cohorts_from}", *numbers])


def run_pipeline(spark: SparkSession, *, out_dir: str, as_of: dt.date | str | None = None,
                 source: str = "exports", landing_dir: str | None = None, orders_dir: str | None = None,
                 mode: str = "upsert", names: tuple[str, ...] | None = None, keep_intermediates: bool = False,
                 digest: str = "lines", multiline: bool = False, cohorts_from: str = "events") -> dict:
    """The whole refresh.

    ``source="exports"``: CSV exports in ``landing_dir`` (paid status ``Paid``, first-action
    cohorts by ``cohorts_from``, see ``refresh_marts``). Nothing is recomputed when no file changed and the last refresh
    succeeded with the same as-of date, marts and cohorts.
    ``source="tpch"``: the driver's Parquet ``orders`` in ``orders_dir`` (paid status ``F``,
    first-action cohorts from orders of any status).
    The intermediates this run writes to the checkpoint folder are deleted once the marts are
    written, unless ``keep_intermediates``. ``digest``: see ``exports.file_digests`` (``md5`` is
    comparable with an imported manifest, see ``import_manifest``); ``multiline``: see ``load_files``.
    """
    check_session(spark)
    run_id = new_run_id()
    as_of = as_of_date(as_of)
    report: dict = {"run_id": run_id, "as_of": as_of.isoformat()}
    with scratch_scope(spark, cleanup=not keep_intermediates) as scratch:
        if source == "exports":
            state = f"{out_dir.rstrip('/')}/_state"
            ingested = ingest_exports(spark, landing_dir, state, run_id, mode, digest, multiline)
            made_from = _refreshed_from(spark, state, as_of, names, cohorts_from)
            refreshed, line = versions.newest(spark, f"{state}/refreshed")
            if ingested is None and line == made_from:
                report["skipped"] = "no new or changed file"
                return report
            report.update(ingested or {})
            report.update(refresh_marts(spark, out_dir, as_of, run_id, names, cohorts_from))
            versions.advance(spark, f"{state}/refreshed", refreshed, made_from)
        elif source == "tpch":
            orders = orders_from_tpch(read_table(spark, orders_dir, "orders"))
            report.update(_write_rejected(spark, {"orders": base.rejected_orders(orders)}, out_dir, run_id))
            plan = build_plan(spark, base.valid_orders(orders), as_of, TPCH_PAID_STATUS, None)
            report["marts"] = write_marts(spark, plan, out_dir, run_id, names)
        else:
            raise ValueError(f"unknown source {source!r}")
        report["intermediates"] = list(scratch)
    return report
