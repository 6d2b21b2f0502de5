"""Session helpers.

The library never creates its own session inside an operator; these helpers are for the
command line, the benchmark and the tests. Settings every mart relies on are asserted by
``check_session``.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    # month grids and the as-of midnight are calendar values in UTC
    "spark.sql.session.timeZone": "UTC",
    # an overflowing decimal or long operation must fail, not turn into NULL
    "spark.sql.ansi.enabled": "true",
}

# Settings for a large cluster (applied by the command line unless spark-submit already set
# them). The heavy shuffle is the donor x month grid: start with many partitions and let AQE
# coalesce them to ~256 MiB each; split skewed join partitions; read ~256 MiB per scan task.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # coalesce to the advisory size, not to the default parallelism (busy shared cluster)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4096",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "donorlens", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/dev session. On a cluster, pass the master from spark-submit instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_cluster_conf(spark: SparkSession) -> None:
    """Set ``CLUSTER_CONF`` values the session does not set already (runtime SQL settings)."""
    for k, v in CLUSTER_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def check_session(spark: SparkSession) -> None:
    for k, v in REQUIRED.items():
        got = spark.conf.get(k)  # Spark's own default where the session doesn't set it
        if got != v:
            raise RuntimeError(f"donorlens needs {k}={v}, session has {got!r}")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a fresh scratch folder is
    created and registered, never on a cluster that names one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="donorlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    # only the folder name is needed: intermediates are written as Parquet tables under it
    # (no RDD checkpoint, so no setCheckpointDir, which would add a directory per call)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for a materialised intermediate table."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "donorlens", f"{name}-{os.getpid()}-{os.urandom(4).hex()}")


_SCOPE: ContextVar[list[str] | None] = ContextVar("donorlens_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession, cleanup: bool = True) -> Iterator[list[str]]:
    """Record the paths ``materialize`` writes inside the block and, with ``cleanup``, delete exactly those paths from the
    shared folder when the block ends. A block sees what is written in its own thread of control (threads that it starts
    with a copied context included), not what other runs of the session write; an inner block's paths are its own. Use it
    around work whose outputs no longer read the intermediates (the pipeline's mart writes)."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        if cleanup:
            delete_paths(spark, paths)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh path in the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches of a plan (Spark does not reuse the
    shuffles when the branches prune different columns) and to cut lineage: a lost executor
    costs a re-read of the files, not a recomputation from the sources.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return spark.read.parquet(path)


def written(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` returns, written and read back; the intermediates that it wrote on the way are deleted."""
    with scratch_scope(spark) as paths:
        out = materialize(build(), name)
        kept = paths.pop()  # written last
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(kept)
    return out
