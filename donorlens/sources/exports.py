"""CSV exports: listing, change detection, lenient reading, routing (D-01..D-04).

Files are ``;``-separated with a header row. ``orders.csv`` holds orders; every other
``*.csv`` holds events. A row with more fields than the header is skipped and a short row is
padded with NULLs - read with one sentinel column ``_extra`` appended to the schema and keep
the rows where it is NULL (Spark's DROPMALFORMED would also drop the short rows). Quotes within
quoted text are doubled; a backslash is text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlens.schemas import EVENTS_CSV, ORDERS_CSV
from donorlens.sources import versions

ORDERS_FILE = "orders.csv"
MANIFEST_SCHEMA = T.StructType([T.StructField("file_name", T.StringType()),
                                T.StructField("md5", T.StringType()),
                                T.StructField("loaded_at", T.TimestampType())])


def _file_name(path_col: str = "path"):
    return F.element_at(F.split(F.col(path_col), "/"), -1)


def _plain_path(uri: Column) -> Column:
    """A path as the file system names it: ``_metadata.file_path`` escapes spaces and percent signs."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def list_csv(spark: SparkSession, landing_dir: str) -> DataFrame:
    """D-01: path, file_name, length, modificationTime of the ``*.csv`` files (no content read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(landing_dir)
            .select("path", _file_name().alias("file_name"), "length", "modificationTime"))


def file_digests(spark: SparkSession, landing_dir: str, method: str = "lines") -> DataFrame:
    """D-02: path, file_name, md5 (a content digest) of every ``*.csv`` file.

    ``method="lines"`` (default): digest of the file's multiset of lines (``line_digests``). The text scan splits large
    files into many tasks and the per-file sums are partial aggregates, so one huge export file is not one task.
    Any changed, added or removed line changes the digest (with overwhelming probability); a
    reordering of lines does not, which is right for a keyed table.
    ``method="ordered"``: the same over lines with their number in the file, so that a reordering changes it
    (``ordered_digests``); a second scan, as parallel as the first.
    ``method="md5"``: md5 of the whole content, one task per file (binaryFile reads each file
    whole, at most 2 GiB) - for small files when the exact file md5 is wanted.
    """
    if method == "md5":
        return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(landing_dir)
                .select("path", _file_name().alias("file_name"), F.md5("content").alias("md5")))
    if method not in ("lines", "ordered"):
        raise ValueError(f"unknown digest method {method!r}")
    text = spark.read.option("pathGlobFilter", "*.csv").text(landing_dir)
    return line_digests(text) if method == "lines" else ordered_digests(text)


def digests_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Line digests (see ``file_digests``) of the given files."""
    return line_digests(spark.read.text(list(paths)))


def _folded(lines: DataFrame) -> DataFrame:
    """path, file_name, md5 from rows of (path, md5 of a line): the number of lines and the sums of the first and the next
    15 hexadecimal digits of their hashes, hashed in turn. Any SQL engine with md5 gives the same."""
    part = lambda at: F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")
    per_file = lines.select("path", part(1).alias("x"), part(16).alias("y")).groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    return per_file.select("path", _file_name().alias("file_name"),
                           F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ("n", "x", "y")])).alias("md5"))


def line_digests(text: DataFrame) -> DataFrame:
    """path, file_name, md5 from a text scan (one row per line): partial per-file sums over the lines, whatever their order."""
    return _folded(text.select(_plain_path(F.col("_metadata.file_path")).alias("path"), F.md5("value").alias("h")))


def ordered_digests(text: DataFrame) -> DataFrame:
    """path, file_name, md5 from a text scan, each line hashed with its number in the file.

    A line's number is the lines in the splits before its own (a count per split, summed up along the file) and its place
    in the split (rows of a split keep their order). Both scans plan the same splits, as they read the same listing;
    the digest doesn't depend on where files are split, so equal files have equal digests under any settings.
    """
    rows = text.select(_plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("row"), "value")
    splits = rows.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    along = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split (a split is a few hundred MB): small enough to send along for any landing folder
    splits = splits.select("path", "start", "first", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("row") - F.col("first")
    return _folded(rows.join(splits, ["path", "start"]).select("path", F.md5(F.concat(number.cast("string"), F.lit(":"), "value")).alias("h")))


def manifest_from_json(spark: SparkSession, path: str) -> DataFrame:
    """A ``{file_name: md5}`` JSON object (the manifest format of the original tool) as manifest
    rows. Its hashes are md5 of the file bytes, so use ``method="md5"`` digests with it."""
    text = spark.read.option("wholetext", True).text(path)
    entries = F.explode(F.from_json("value", "map<string,string>"))
    return text.select(entries.alias("file_name", "md5")).select(
        "file_name", "md5", F.lit(None).cast("timestamp").alias("loaded_at"))


def write_manifest(spark: SparkSession, manifest: DataFrame, path: str) -> None:
    """A manifest as a new ``{file_name: md5}`` JSON file, as ``manifest_from_json`` reads it (an entry per export file).
    Refuses to replace a file."""
    entries = {r["file_name"]: r["md5"] for r in manifest.select("file_name", "md5").collect()}
    if not versions.create_file(spark, path, json.dumps(entries, ensure_ascii=False)):
        raise FileExistsError(path)


def changed_files(digests: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """D-02: files that are new or whose md5 differs from the manifest (anti-join)."""
    if manifest is None:
        return digests
    return digests.join(manifest.select("file_name", "md5"), ["file_name", "md5"], "left_anti")


def updated_manifest(manifest: DataFrame | None, changed: DataFrame) -> DataFrame:
    """New manifest: the changed files' digests replace the old entries by file name."""
    new = changed.select("file_name", "md5", F.current_timestamp().alias("loaded_at"))
    if manifest is None:
        return new
    return manifest.join(new.select("file_name"), "file_name", "left_anti").unionByName(new)


def read_header(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names from the first line of one file (read through the cluster file system;
    only that line is read). A UTF-8 byte-order mark and surrounding quotes are dropped."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return [c.strip().strip('"') for c in line.lstrip("\ufeff").split(sep)]


def _open_quote(line: str, sep: str) -> Column:
    """The line ends within a quoted value (loops are possessive, so a line is read once)."""
    text, other = r'"[^"]*+(?:""[^"]*+)*+', rf"[^{re.escape(sep)}]*+"
    field = rf"""(?:{text}"{other}|[^"{re.escape(sep)}]{other}|)"""
    return F.contains(line, F.lit('"')) & F.col(line).rlike(rf"^(?:{field}{re.escape(sep)})*+{text}$")


def read_export(spark: SparkSession, paths: Sequence[str], schema: T.StructType, sep: str = ";",
                multiline: bool = False) -> DataFrame:
    """D-03: lenient ``;`` CSV read by header name.

    Files are grouped by their header line and each group is read in one scan with an all-string
    schema taken from that header plus a sentinel column ``_extra``: a row with more fields than
    the header fills the sentinel and is skipped, a short row is padded with NULLs. The columns
    of ``schema`` are then taken by name and cast with ``try_cast``; a column missing from a file is
    NULL; any other column is carried along as text. Adds ``_source_file`` and ``_bad_value``, the
    first column whose value is present but doesn't parse (such rows are quarantined downstream).

    ``multiline``: quoted text may hold line breaks; each file is then read by one task. Without it
    files are split among tasks, and a quote left open at the end of a line stops the load.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:  # one header line per file
        groups.setdefault(tuple(read_header(spark, path, sep)), []).append(path)
    known = {f.name: f.dataType for f in schema.fields}
    frames = []
    for header, files in groups.items():
        # every row that fits is short of the sentinel, so Spark gives its line in _line
        raw = T.StructType([T.StructField(c, T.StringType()) for c in (*header, "_extra", "_line")])
        df = (spark.read.schema(raw).option("sep", sep).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_line").option("escape", '"').option("multiLine", multiline).csv(files))
        fits = F.col("_extra").isNull()
        if not multiline:
            stop = F.raise_error(F.lit("a quoted value goes on over a line break: read with multiline=True"))
            fits = F.when(_open_quote("_line", sep), stop.cast("boolean")).otherwise(fits)
        df = df.where(fits)
        cols = [F.expr(f"try_cast(`{n}` AS {t.simpleString()})").alias(n) if n in header
                else F.lit(None).cast(t).alias(n) for n, t in known.items()]
        bad = [F.when((F.trim(f"`{n}`") != "") & F.expr(f"try_cast(`{n}` AS {t.simpleString()})").isNull(), F.lit(n))
               for n, t in known.items() if n in header and not isinstance(t, T.StringType)]
        cols += [F.col(f"`{c}`") for c in header if c not in known]
        cols.append(F.coalesce(*bad, F.lit(None).cast("string")).alias("_bad_value"))
        frames.append(df.select(*cols, F.col("_metadata.file_name").alias("_source_file")))
    return union_by_name(frames)


def route(paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """D-04: split file paths into (orders files, events files) by name."""
    orders = [p for p in paths if p.rsplit("/", 1)[-1] == ORDERS_FILE]
    events = [p for p in paths if p.rsplit("/", 1)[-1] != ORDERS_FILE]
    return orders, events


def read_orders_export(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> DataFrame:
    return read_export(spark, paths, ORDERS_CSV, multiline=multiline)


def read_events_export(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> DataFrame:
    """All event files in one scan (same export layout)."""
    return read_export(spark, paths, EVENTS_CSV, multiline=multiline)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """D-04 for files whose column sets differ: concatenate by column name, NULL-filling."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def rows_per_file(df: DataFrame) -> DataFrame:
    """D-04 load report: _source_file, rows."""
    return df.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))
