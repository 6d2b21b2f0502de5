"""Keyed loads (D-05): append, insert-if-absent, upsert, as DataFrame expressions.

Without a table format that has MERGE, a keyed load is an anti-join plus a union. The stored
table is never overwritten in place (that would delete the input before it is read): the
pipeline writes the next version and publishes its number (``sources.versions``). The joins shuffle on the key only (or
broadcast the batch's keys when AQE measures them small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing`` (reads only its key columns)."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` plus the rows of ``incoming`` whose key is not there yet
    (``ON CONFLICT DO NOTHING``)."""
    return existing.unionByName(new_rows(existing, incoming, keys), allowMissingColumns=True)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``incoming`` wins on key conflicts (``ON CONFLICT DO UPDATE``). Columns are matched by
    name; a column only one side has is NULL on the other (export layouts may grow)."""
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)
