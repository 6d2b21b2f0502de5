"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of a prime number of slots (from an offset and a step, both hashed from its name).
The shards take turns: each claims the first slot of its permutation that is still free, until none is. A key's slot
is its hash modulo the prime, so placement is one lookup. Shards get shares of slots that differ by one at most (by
weight: a shard of weight w takes w turns a round), and when a shard goes, few slots of the others change hands.

The table has ``slots`` entries whatever the number of documents, is built by the driver and broadcast.

Defined cases: the key is the id's text, and a null id is the empty text; rows that repeat a key share a shard; an
empty table gives an empty table. Only the key column is read to place rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """The number of the shard (its place in ``shards``) that holds each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    turns = [(weights or {}).get(name, 1) for name in shards]
    if sum(turns) < 1 or min(turns) < 0:
        raise ValueError("weights must be whole numbers from 0, and not all 0")
    at = [_hash(name, "offset") % slots for name in shards]
    step = [_hash(name, "step") % (slots - 1) + 1 for name in shards]
    table, left = [-1] * slots, slots
    while True:
        for s, n in enumerate(turns):
            for _ in range(n):
                while table[at[s]] >= 0:
                    at[s] = (at[s] + step[s]) % slots
                table[at[s]] = s
                left -= 1
                if not left:
                    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 15 hex digits of the MD5 of its text, modulo the number of slots."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(rows: DataFrame, key_col: str, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` (columns of these names are replaced)."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(lookup_table(shards, slots, weights))], "slot int, shard string")
    keep = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("slot", "shard")]
    rows = rows.select(*keep, slot_of(F.col(f"`{key_col}`"), slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select(*[c for c in rows.columns if c != "slot"], "slot", "shard")


def write_shards(rows: DataFrame, path: str, key_col: str, shards: list[str], files_per_shard: int = 8, **kw) -> None:
    """Writes a folder per shard. A shard's rows are dealt by their slot to ``files_per_shard`` tasks, so that no task holds
    a whole shard."""
    placed = place(rows, key_col, shards, **kw)
    (placed.repartition(len(shards) * files_per_shard, "shard", F.pmod(F.hash("slot"), F.lit(files_per_shard)))
     .write.partitionBy("shard").parquet(path))
