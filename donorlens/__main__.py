"""Command line for spark-submit: ``python -m donorlens --out DIR --landing DIR [--as-of DATE]``."""

from __future__ import annotations

import argparse
import json

from donorlens.plans.pipeline import export_manifest, import_manifest, run_pipeline
from donorlens.session import apply_cluster_conf, build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="donorlens")
    ap.add_argument("--out", required=True, help="output root (marts, state, rejected rows)")
    ap.add_argument("--landing", help="folder with the CSV exports (source=exports)")
    ap.add_argument("--orders-dir", help="folder with orders.parquet (source=tpch)")
    ap.add_argument("--source", choices=["exports", "tpch"], default="exports")
    ap.add_argument("--as-of", help="as-of date YYYY-MM-DD (default: today)")
    ap.add_argument("--mode", choices=["upsert", "insert_ignore", "append"], default="upsert")
    ap.add_argument("--digest", choices=["lines", "ordered", "md5"], default="lines", help="change-detection digest")
    ap.add_argument("--multiline", action="store_true", help="quoted text in the exports may hold line breaks")
    ap.add_argument("--cohorts-from", choices=["events", "orders"], default="events", help="first actions of the all-user cohorts")
    ap.add_argument("--export-manifest", help="write the state manifest to this new JSON file afterwards")
    ap.add_argument("--import-manifest", help="seed the state manifest from a {file_name: md5} JSON file first")
    ap.add_argument("--master", help="Spark master (default: from spark-submit)")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    if not spark.sparkContext.master.startswith("local"):
        apply_cluster_conf(spark)
    if a.import_manifest:
        import_manifest(spark, a.import_manifest, a.out)
    report = run_pipeline(spark, out_dir=a.out, as_of=a.as_of, source=a.source, landing_dir=a.landing,
                          orders_dir=a.orders_dir, mode=a.mode, digest=a.digest,
                          multiline=a.multiline, cohorts_from=a.cohorts_from)
    if a.export_manifest:
        export_manifest(spark, a.out, a.export_manifest)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
