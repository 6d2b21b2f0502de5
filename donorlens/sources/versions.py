"""Stored tables as numbered versions, for file systems without a table format.

    <table>/data/run=<id>/     one load's Parquet directory: the whole table as of that version
    <table>/versions/v<n>      one line: the run directory of version n

A load reads the newest version, writes the next one whole and publishes it by creating the file of the next number.
Creating refuses if the file exists, so of two loads that started from one version the second fails and keeps
the first one's rows; it is run again on the newer version. Version 0, without data, is created before any data, so a
table with data but without versions is known to have lost them, and isn't taken for a new one. Nothing is ever rewritten.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class StaleVersion(Exception):
    """Another load published the next version first."""


class LostVersions(Exception):
    """There is data, but no version says which of it is the table."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_file(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Creates the file with the text; False if it exists."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def move(spark: SparkSession, path: str, target: str) -> None:
    """Moves a file; its new folder is created."""
    fs, p = _fs(spark, path)
    _, q = _fs(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"{path} can't be moved to {target}")


def newest(spark: SparkSession, table_dir: str) -> tuple[int, str]:
    """The newest version's number and line; (-1, "") for a table that doesn't exist."""
    found = [n for n in _names(spark, f"{table_dir}/versions") if n.startswith("v") and n[1:].isdigit()]
    if found:
        return int(found[-1][1:]), read_file(spark, f"{table_dir}/versions/{found[-1]}").strip()
    if _names(spark, f"{table_dir}/data"):
        raise LostVersions(f"{table_dir} holds data but no version; restore versions/ or move the data away")
    return -1, ""


def line_of(spark: SparkSession, table_dir: str, number: int) -> str:
    return read_file(spark, f"{table_dir}/versions/v{number:010d}").strip()


def advance(spark: SparkSession, table_dir: str, base: int, line: str) -> int:
    """Creates version ``base + 1`` with the line."""
    if not create_file(spark, f"{table_dir}/versions/v{base + 1:010d}", line + "\n"):
        raise StaleVersion(f"{table_dir}: version {base + 1} was published by another load; load again")
    return base + 1


def read(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The newest version's rows; None if nothing was loaded yet."""
    _, line = newest(spark, table_dir)
    return spark.read.parquet(f"{table_dir}/data/{line}") if line else None


def loaded(spark: SparkSession, table_dir: str, run_id: str) -> bool:
    """Whether a version of this run was published (its data directory alone may be left over from a failed attempt)."""
    fs, p = _fs(spark, f"{table_dir}/data/run={run_id}")
    return bool(fs.exists(p)) and spark.read.text(f"{table_dir}/versions").where(f"value = 'run={run_id}'").limit(1).count() > 0


def publish(spark: SparkSession, table_dir: str, df: DataFrame, run_id: str, base: int) -> int:
    """Writes ``df`` as the version after ``base`` and publishes it; returns its number."""
    if base < 0:
        create_file(spark, f"{table_dir}/versions/v{0:010d}", "")
        base = 0
    df.write.mode("overwrite").parquet(f"{table_dir}/data/run={run_id}")
    return advance(spark, table_dir, base, f"run={run_id}")


def replace(spark: SparkSession, table_dir: str, df: DataFrame, run_id: str) -> int:
    """Publishes ``df`` as the next version, whatever the newest is, unless the run was published before."""
    if loaded(spark, table_dir, run_id):
        return newest(spark, table_dir)[0]
    return publish(spark, table_dir, df, run_id, newest(spark, table_dir)[0])


def expire(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Deletes the data of all but the newest ``keep`` versions and what failed loads left before them; returns the names."""
    held = [read_file(spark, f"{table_dir}/versions/{n}").strip() for n in _names(spark, f"{table_dir}/versions")]
    gone = [line for line in held[:-keep] if line and line not in held[-keep:]]
    for line in gone:
        fs, p = _fs(spark, f"{table_dir}/data/{line}")
        fs.delete(p, True)
    return gone
