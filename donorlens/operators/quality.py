"""Key checks (D-06, D-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D-06: every key value that occurs more than once, with its count (``dup_count``).

    A hash aggregate with map-side partial counts: a hot key costs one partial row per task.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .where(F.col("dup_count") > 1))


def key_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row: table_name, key_columns, duplicate_keys, duplicate_rows, null_keys.

    ``null_keys`` counts rows with a NULL in a key column (a unique NOT NULL key allows none).
    """
    null_any = None
    for k in keys:
        c = F.col(k).isNull()
        null_any = c if null_any is None else (null_any | c)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.max(F.when(null_any, 1).otherwise(0)).alias("has_null"))
    return per_key.agg(
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("long").alias("duplicate_keys"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("long").alias("duplicate_rows"),
        F.sum(F.when(F.col("has_null") == 1, F.col("n")).otherwise(0)).cast("long").alias("null_keys"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
             F.coalesce("duplicate_keys", F.lit(0).cast("long")).alias("duplicate_keys"),
             F.coalesce("duplicate_rows", F.lit(0).cast("long")).alias("duplicate_rows"),
             F.coalesce("null_keys", F.lit(0).cast("long")).alias("null_keys"))


class KeyViolation(Exception):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """D-07: fail the load when the natural key is not unique and not null.

    Only the one-row summary reaches the driver.
    """
    row = key_violations(df, keys, table).first()
    if row and (row["duplicate_keys"] or row["null_keys"]):
        raise KeyViolation(f"{table}: {row['duplicate_keys']} duplicated keys, "
                           f"{row['null_keys']} rows with NULL key on ({', '.join(keys)})")
