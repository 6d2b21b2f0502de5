"""Registered queries over the driver tables: one per operator of the inventory.

Each entry is ``f(spark, sf_dir) -> DataFrame`` and reads whole tables. Orders use the status
``F`` as the paid status and the as-of date 2001-08-01 (the last order date); the events
purchases use 2024-02-01. Results pass through ``comparable`` (decimal -> double, integers ->
bigint) so they can be compared value by value with the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlens.functions.timecols import format_text_ts, parse_text_ts
from donorlens.operators import base, churn, merge, quality, reshape, rfm
from donorlens.plans import pipeline
from donorlens.plans.marts import MartPlan
from donorlens.schemas import ORDERS_CSV, ORDERS_KEY
from donorlens.session import materialize, scratch_path, scratch_scope
from donorlens.sources import exports, versions
from donorlens.sources.tables import (PAID_STATUS, TPCH_PAID_STATUS, orders_from_export, purchases_from_events,
                                      read_table, tpch_orders)

ORDERS_AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 2, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Decimal -> double, small integers -> bigint, timestamp -> timestamp_ntz."""
    cols = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            cols.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(f"CAST({name} AS TIMESTAMP_NTZ) AS {name}")
        else:
            cols.append(name)
    return df.selectExpr(*cols)


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return tpch_orders(spark, d)


def _plan(spark: SparkSession, d: str) -> MartPlan:
    return MartPlan(_orders(spark, d), as_of=ORDERS_AS_OF, paid_value=TPCH_PAID_STATUS)


def _events_plan(spark: SparkSession, d: str) -> MartPlan:
    return MartPlan(purchases_from_events(read_table(spark, d, "events")), as_of=EVENTS_AS_OF,
                    paid_value=TPCH_PAID_STATUS)


# ---- ingest and maintenance ------------------------------------------------------------------

def q_paid_orders_extract(spark, d):
    return _plan(spark, d).paid_only()


def q_parse_event_times(spark, d):
    """P-60: events times written in both text formats and parsed back with one pattern."""
    ev = read_table(spark, d, "events")
    return ev.select("event_id",
                     parse_text_ts(format_text_ts("ts", with_seconds=False)).alias("ts_minute"),
                     parse_text_ts(format_text_ts("ts", with_seconds=True)).alias("ts_second"))


def q_parse_order_times(spark, d):
    """P-60 on orders: the order date written as text without and with seconds, parsed back."""
    o = read_table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"),
                    parse_text_ts(format_text_ts("o_orderdate", with_seconds=False)).alias("ts_minute"),
                    parse_text_ts(format_text_ts("o_orderdate", with_seconds=True)).alias("ts_second"))


def export_orders_csv(spark: SparkSession, d: str) -> list[str]:
    return _export_csv(spark, read_table(spark, d, "orders"))


def _export_rows(o: DataFrame, *more) -> DataFrame:
    """The driver's ``orders`` in the source layout (text times, status ``Paid`` for ``F``)."""
    key, first_action, customer, ts, price, status = ORDERS_CSV.fieldNames()
    return o.select(F.col("o_orderkey").alias(key),
                    F.col("o_orderkey").alias(first_action),
                    F.col("o_custkey").alias(customer),
                    format_text_ts("o_orderdate").alias(ts),
                    F.col("o_totalprice").cast("decimal(18,2)").alias(price),
                    F.when(F.col("o_orderstatus") == TPCH_PAID_STATUS, F.lit(PAID_STATUS))
                     .otherwise(F.col("o_orderstatus")).alias(status), *more)


def _export_csv(spark: SparkSession, o: DataFrame, *more) -> list[str]:
    """The orders written as a ``;`` export to a fresh folder under the shared checkpoint folder; returns
    the file paths (a listing: one entry per file)."""
    path = scratch_path(spark, "orders-export")
    _export_rows(o, *more).write.option("sep", ";").option("header", True).option("escape", '"').csv(path)
    return [r["path"] for r in exports.list_csv(spark, path).select("path").collect()]


def q_csv_ingest(spark, d):
    """D-01, D-03: the export read back by header name and parsed into canonical orders."""
    return orders_from_export(exports.read_orders_export(spark, export_orders_csv(spark, d))).drop("bad_value")


def q_csv_ingest_quoted(spark, d):
    """D-03, P-01: an export with a quoted column that holds line breaks, separators and quotes, read as multi-line text."""
    note = F.concat(F.lit('order "'), F.col("o_orderkey").cast("string"), F.lit('"\n a;b\\'), F.col("o_orderpriority"))
    paths = _export_csv(spark, read_table(spark, d, "orders"), note.alias("note"))
    return exports.read_orders_export(spark, paths, multiline=True).select(
        F.col("OrderIdsMindboxId").alias("order_id"), F.col("OrderTotalPrice").alias("amount"), "note")


def _yearly_exports(spark: SparkSession, d: str) -> str:
    """The driver's ``orders`` as a landing folder of one export file per order year, ``orders_<year>.csv``, by order id."""
    parts, folder = scratch_path(spark, "orders-parts"), scratch_path(spark, "orders-yearly")
    year = F.year("o_orderdate").alias("year")
    rows = _export_rows(read_table(spark, d, "orders"), year).repartition("year").sortWithinPartitions("year", ORDERS_KEY)
    rows.write.partitionBy("year").option("sep", ";").option("header", True).csv(parts)
    for r in exports.list_csv(spark, f"{parts}/year=*").select("path").collect():  # a listing: one file per year
        versions.move(spark, r["path"], f"{folder}/orders_{r['path'].split('year=')[1].split('/')[0]}.csv")
    return folder


def q_changed_files(spark, d):
    """D-01, D-02, P-02: yearly export files against the manifest of an earlier load, read from its JSON file: the files from
    1999 on were not there yet, those of 1997 and 1998 have changed since, the others haven't. The load's manifest is
    then written back as JSON and read again."""
    folder = _yearly_exports(spark, d)
    now = exports.file_digests(spark, folder)
    known = now.where("file_name < 'orders_1999'").withColumn("md5", F.when(F.col("file_name") < "orders_1997", F.col("md5")).otherwise(F.reverse("md5")))
    before, after = f"{folder}-before.json", f"{folder}-after.json"
    exports.write_manifest(spark, known, before)
    old = exports.manifest_from_json(spark, before)
    changed = exports.changed_files(now, old)
    exports.write_manifest(spark, exports.updated_manifest(old, changed), after)
    status = F.when(F.col("old_md5").isNull(), "new").when(F.col("old_md5") == F.col("md5"), "unchanged").otherwise("changed")
    return exports.manifest_from_json(spark, after).select("file_name", "md5").join(
        old.select("file_name", F.col("md5").alias("old_md5")), "file_name", "left").select("file_name", "md5", status.alias("status"))


def q_ordered_digests(spark, d):
    """P-74: digests of the yearly export files over lines with their number in the file."""
    return exports.file_digests(spark, _yearly_exports(spark, d), "ordered").select("file_name", "md5")


def q_mart_schemas(spark, d):
    """D-10, P-05: the 18 marts published by the pipeline: each column's type, the rows and the values that aren't null."""
    out = scratch_path(spark, "marts")
    report = pipeline.run_pipeline(spark, out_dir=out, as_of=ORDERS_AS_OF, source="tpch", orders_dir=d)
    frames = []
    for name in MartPlan.MART_NAMES:
        mart = pipeline.read_mart(spark, report["marts"], name)
        entry = lambda f: F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.count(f"`{f.name}`").alias("n_values"))
        counts = mart.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[entry(f) for f in mart.schema.fields]).alias("x"))
        frames.append(counts.select(F.lit(name).alias("mart"), "n_rows", F.explode("x").alias("x")).select("mart", "n_rows", "x.*"))
    return exports.union_by_name(frames)


def q_rfm_segments_from_export(spark, d):
    """The whole source path: CSV text -> parse -> paid orders (``Paid``) -> RFM mart."""
    orders = orders_from_export(exports.read_orders_export(spark, export_orders_csv(spark, d)))
    return MartPlan(orders, as_of=ORDERS_AS_OF, paid_value=PAID_STATUS).rfm()


def q_duplicate_keys_lineitem(spark, d):
    return quality.duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_unique_key_assertion(spark, d):
    """D-07 summary rows for the natural keys of orders, events and lineitem."""
    o = quality.key_violations(read_table(spark, d, "orders"), ["o_orderkey"], "orders")
    e = quality.key_violations(read_table(spark, d, "events"), ["event_id"], "events")
    li = quality.key_violations(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    return o.unionByName(e).unionByName(li)


# Two overlapping loads of the orders table: the snapshot up to 1999 and a later batch that
# re-sends 1999 with a corrected price. The boundaries are part of the test data, not a cap.
def _loads(spark, d):
    o = _orders(spark, d)
    existing = o.where(F.col("order_ts") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    incoming = (o.where(F.col("order_ts") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
                .withColumn("amount", (F.col("amount") + F.lit(1)).cast("decimal(18,2)")))
    return existing, incoming


def q_upsert_by_key(spark, d):
    existing, incoming = _loads(spark, d)
    return merge.upsert(existing, incoming, ["order_id"])


def q_insert_ignore_by_key(spark, d):
    existing, incoming = _loads(spark, d)
    return merge.insert_ignore(existing, incoming, ["order_id"])


def _stored(spark, d, mode: str, first, second, raised: bool = False) -> DataFrame:
    """D-05: two batches of orders exported, loaded one after the other and the table read back."""
    o, state = read_table(spark, d, "orders"), scratch_path(spark, "stored-orders")
    later = o.where(second)
    if raised:
        later = later.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)") + F.lit(1))
    with scratch_scope(spark):
        for run_id, batch in (("1", o.where(first)), ("2", later)):
            rows = exports.read_orders_export(spark, _export_csv(spark, batch))
            pipeline.load_table(spark, "orders", rows, state, [ORDERS_KEY], run_id, mode)
    out = orders_from_export(versions.read(spark, state)).drop("bad_value")
    return out.withColumn("status", F.when(F.col("status") == PAID_STATUS, TPCH_PAID_STATUS).otherwise(F.col("status")))


def _overlap():
    day = F.col("o_orderdate")
    return day < F.lit("2000-01-01").cast("date"), day >= F.lit("1999-01-01").cast("date")


def q_stored_upsert(spark, d):
    return _stored(spark, d, "upsert", *_overlap(), raised=True)


def q_stored_insert_ignore(spark, d):
    return _stored(spark, d, "insert_ignore", *_overlap(), raised=True)


def q_stored_append(spark, d):
    even = F.col("o_orderkey") % 2 == 0
    return _stored(spark, d, "append", even, ~even)


def q_union_by_name_missing_columns(spark, d):
    """D-04: event files with different column sets concatenated by name."""
    ev = read_table(spark, d, "events")
    a = ev.where(F.col("event_type").isin("click", "view")).select("event_id", "user_id", "ts")
    b = ev.where(~F.col("event_type").isin("click", "view")).select("ts", "event_id", "value", "user_id")
    return a.unionByName(b, allowMissingColumns=True)


# ---- RFM ---------------------------------------------------------------------------------------

def q_rfm_base(spark, d):
    p = _plan(spark, d)
    return rfm.rfm_base(p.rfm_rows, p.as_of)


def q_rfm_base_events(spark, d):
    p = _events_plan(spark, d)
    return rfm.rfm_base(p.rfm_rows, p.as_of)


def q_rfm_scores(spark, d):
    p = _plan(spark, d)
    return rfm.rfm_scored(p.rfm_rows, p.as_of).drop("rfm_group")


def q_rfm_group_share(spark, d):
    p = _plan(spark, d)
    return rfm.rfm_group_shares(rfm.rfm_scored(p.rfm_rows, p.as_of))


def q_rfm_segments(spark, d):
    return _plan(spark, d).rfm()


def q_rfm_segments_events(spark, d):
    return _events_plan(spark, d).rfm()


# ---- cohorts -----------------------------------------------------------------------------------

def q_cohorts_all(spark, d):
    return _plan(spark, d).cohorts_all()


def q_cohorts_paid(spark, d):
    return _plan(spark, d).cohorts_paid()


def q_cohort_sizes(spark, d):
    p = _plan(spark, d)
    return base.cohort_sizes(base.paid_cohorts(p.donor_grid))


def q_cohort_month_revenue(spark, d):
    from donorlens.operators.cohorts import cohort_month_revenue
    return cohort_month_revenue(_plan(spark, d).matrix)


def q_cohort_revenue_arppu(spark, d):
    return _plan(spark, d).cohorts_revenue_arppu_data()


def q_cohort_revenue_slots(spark, d):
    """M-09 alone: revenue per paid cohort in the 12 as-of slots, from a stored grid of which the slots' months are read."""
    p = _plan(spark, d)
    grid = materialize(pipeline.by_month(p.grid_with_cohort), "month-grid")
    sizes = base.cohort_sizes(base.paid_cohorts(grid))
    stored = MartPlan(p.orders, as_of=p.as_of, paid_value=p.paid_value, grid=grid, paid_sizes=sizes)
    return stored.cohorts_revenue_arppu_data().select(
        "cohort_month", "total_users", *[f"revenue_month_{k}" for k in range(12, 0, -1)])


def q_cohort_arppu(spark, d):
    """M-10 alone: unrounded ARPPU per paid cohort in the 12 as-of slots."""
    return _plan(spark, d).cohorts_revenue_arppu_data().select(
        "cohort_month", "total_users", *[f"arppu_month_{k}" for k in range(12, 0, -1)])


def q_arppu_cumulative(spark, d):
    return _plan(spark, d).arppu_cumulative()


def q_ltv_cohorts(spark, d):
    return _plan(spark, d).ltv_cohorts()


def q_ltv_cumulative(spark, d):
    return _plan(spark, d).cumulative_ltv()


def q_retention_rate(spark, d):
    return _plan(spark, d).rr_cohorts()


def q_average_check(spark, d):
    return _plan(spark, d).ac_cohort()


def q_donor_month_grid(spark, d):
    g = _plan(spark, d).donor_grid
    return g.select("customer_id", "month", "n_orders", "revenue_cents")


def q_churn_rate(spark, d):
    return churn.churn_rate(_plan(spark, d).grid_with_cohort)


def q_new_donor_ratio(spark, d):
    return churn.new_donor_ratio(_plan(spark, d).grid_with_cohort)


def q_donation_span(spark, d):
    return churn.donation_span(_plan(spark, d).donor_grid)


def q_donation_span_next3(spark, d):
    return churn.donation_span_next(churn.donation_span(_plan(spark, d).donor_grid))


def q_cdr(spark, d):
    return _plan(spark, d).cdr()


# ---- unpivots (applied to the wide marts, as the reference does) -------------------------------

def q_ltv_long(spark, d):
    return reshape.ltv_t(_plan(spark, d).ltv_cohorts())


def q_revenue_long(spark, d):
    return reshape.revenue_t(_plan(spark, d).ltv_cohorts())


def q_ltv_cum_long(spark, d):
    return reshape.ltv_cum_t(_plan(spark, d).cumulative_ltv())


def q_arppu_long(spark, d):
    return reshape.arppu_t(_plan(spark, d).cohorts_revenue_arppu_data())


def q_arppu_cum_long(spark, d):
    return reshape.arppu_cum_t(_plan(spark, d).arppu_cumulative())


def q_rr_long(spark, d):
    return reshape.rr_t(_plan(spark, d).rr_cohorts())


def q_ac_long(spark, d):
    return reshape.ac_t(_plan(spark, d).ac_cohort())


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "paid_orders_extract": q_paid_orders_extract,
    "parse_event_times": q_parse_event_times,
    "parse_order_times": q_parse_order_times,
    "csv_ingest": q_csv_ingest,
    "csv_ingest_quoted": q_csv_ingest_quoted,
    "changed_files": q_changed_files,
    "ordered_digests": q_ordered_digests,
    "mart_schemas": q_mart_schemas,
    "rfm_segments_from_export": q_rfm_segments_from_export,
    "duplicate_keys_lineitem": q_duplicate_keys_lineitem,
    "unique_key_assertion": q_unique_key_assertion,
    "upsert_by_key": q_upsert_by_key,
    "insert_ignore_by_key": q_insert_ignore_by_key,
    "stored_upsert": q_stored_upsert,
    "stored_insert_ignore": q_stored_insert_ignore,
    "stored_append": q_stored_append,
    "union_by_name_missing_columns": q_union_by_name_missing_columns,
    "rfm_base": q_rfm_base,
    "rfm_base_events": q_rfm_base_events,
    "rfm_scores": q_rfm_scores,
    "rfm_group_share": q_rfm_group_share,
    "rfm_segments": q_rfm_segments,
    "rfm_segments_events": q_rfm_segments_events,
    "cohorts_all": q_cohorts_all,
    "cohorts_paid": q_cohorts_paid,
    "cohort_sizes": q_cohort_sizes,
    "cohort_month_revenue": q_cohort_month_revenue,
    "cohort_revenue_arppu": q_cohort_revenue_arppu,
    "cohort_revenue_slots": q_cohort_revenue_slots,
    "cohort_arppu": q_cohort_arppu,
    "arppu_cumulative": q_arppu_cumulative,
    "ltv_cohorts": q_ltv_cohorts,
    "ltv_cumulative": q_ltv_cumulative,
    "retention_rate": q_retention_rate,
    "average_check": q_average_check,
    "donor_month_grid": q_donor_month_grid,
    "churn_rate": q_churn_rate,
    "new_donor_ratio": q_new_donor_ratio,
    "donation_span": q_donation_span,
    "donation_span_next3": q_donation_span_next3,
    "cdr": q_cdr,
    "ltv_long": q_ltv_long,
    "revenue_long": q_revenue_long,
    "ltv_cum_long": q_ltv_cum_long,
    "arppu_long": q_arppu_long,
    "arppu_cum_long": q_arppu_cum_long,
    "rr_long": q_rr_long,
    "ac_long": q_ac_long,
}


def _wrap(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(f(spark, sf_dir))
    run.__name__ = f.__name__
    run.__doc__ = f.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _wrap(v) for k, v in RAW.items()}
