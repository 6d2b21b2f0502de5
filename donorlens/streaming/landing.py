"""Incremental ingest of a landing folder with Structured Streaming.

The file source keeps, in its checkpoint, the set of files it has already handed over, so
each ``availableNow`` (or periodic) trigger sees only new files. Each micro-batch carries one
row per new file (its path; the content column is never read by the stream) and
``foreachBatch`` runs the same keyed load and mart refresh as the batch pipeline, with the
micro-batch id as the run id: a replayed batch finds its own committed tables and does not
load twice.

The file source tracks paths, not contents. Files rewritten under an old name are found by ``recheck``: each trigger then
also compares the whole folder's digests with the manifest, as the batch ``run_pipeline`` does, and loads what changed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from donorlens.functions.timecols import as_of_date
from donorlens.plans import pipeline
from donorlens.session import check_session, scratch_scope
from donorlens.sources import exports, versions

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def new_files_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame: path of each new ``*.csv`` file (the content column is not read)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir).select("path")


def start_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_location: str,
                 as_of: dt.date | str | None = None, mode: str = "upsert", refresh: bool = True,
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None, multiline: bool = False, cohorts_from: str = "events",
                 recheck: bool = False) -> StreamingQuery:
    """Start the incremental load. ``checkpoint_location`` must be on shared storage. ``multiline``, ``cohorts_from``: see
    ``pipeline.run_pipeline``. ``recheck``: load rewritten files too; a scan of the folder per trigger with new files."""
    check_session(spark)
    state = f"{out_dir.rstrip('/')}/_state"

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # one row per new file: bounded by maxFilesPerTrigger / the files that arrived
        paths = [r["path"] for r in batch.collect()]
        if not paths:
            return
        # content digests for the manifest: a distributed line scan, not one task per file
        digests = exports.digests_of(spark, paths)
        if recheck:
            known = versions.read(spark, f"{state}/manifest")
            digests = digests.unionByName(exports.changed_files(exports.file_digests(spark, landing_dir), known)).distinct()
        files = [(r["path"], r["file_name"], r["md5"]) for r in digests.collect()]
        run_id = f"epoch-{epoch_id:010d}"
        with scratch_scope(spark):
            pipeline.load_files(spark, files, state, run_id, mode, multiline)
            if refresh:
                pipeline.refresh_marts(spark, out_dir, as_of_date(as_of), run_id, cohorts_from=cohorts_from)

    writer = (new_files_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(handle).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()
