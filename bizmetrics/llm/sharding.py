"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: it starts at an offset and steps by a skip, both hashed
from its name. The shards take turns, each claiming the next slot of its order that is still free, until the table is full. So every
shard holds an equal part of the slots (within one), and when a shard comes or goes few other slots change hands. A row's key is hashed to
a slot, and the table, of fixed size, is broadcast: placing a row takes one look-up, whatever the number of shards.

The table is filled on the driver because turns follow each other; its size is a parameter of at most ``MAX_SLOTS``, not of the data.

Edge cases: a null key is placed as the empty string; equal keys share a shard; an empty table stays empty; columns that are called as the
operator's own (``slot``, ``shard``) are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = 64
MAX_SLOTS = 1 << 20


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and skip of a shard's order: its j-th choice is slot ``(offset + j * skip) % slots``."""
    return _hash(f"offset:{shard}") % slots, _hash(f"skip:{shard}") % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> list[int]:
    """For each slot, the position of its shard in ``shards``. A shard of weight w makes w claims a turn."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be some different names")
    if slots > MAX_SLOTS or slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime between the number of shards and {MAX_SLOTS}")
    turns = [max(0, (weights or {}).get(s, 1)) for s in shards]
    if not any(turns):
        raise ValueError("some shard must have a positive weight")
    orders = [preference(s, slots) for s in shards]
    at = [offset for offset, _ in orders]
    table, free = [-1] * slots, slots
    while True:
        for shard, (_, skip) in enumerate(orders):
            for _ in range(turns[shard]):
                slot = at[shard]
                while table[slot] >= 0:
                    slot = (slot + skip) % slots
                table[slot] = shard
                at[shard] = (slot + skip) % slots
                free -= 1
                if not free:
                    return table


def lookup_table(spark: SparkSession, columns: Mapping[str, Sequence[int]]) -> DataFrame:
    """A row per slot: slot, and the shard in each of the filled tables."""
    made = None
    for name, table in columns.items():
        csv = F.split(F.lit(",".join(map(str, table))), ",")
        one = spark.range(1).select(F.posexplode(csv).alias("slot", name)).select("slot", F.col(name).cast("int").alias(name))
        made = one if made is None else made.join(F.broadcast(one), "slot")  # MAX_SLOTS rows at most
    return made


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key, from 60 bits of the MD5 of its text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.lit(slots)).cast("int")


def place(rows: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``, the shard's position in ``shards``."""
    return place_in(rows, key, {"shard": fill(shards, slots, weights)}, slots)


def place_in(rows: DataFrame, key: str, tables: Mapping[str, Sequence[int]], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and a column for each filled table."""
    table = lookup_table(rows.sparkSession, tables)
    own = {"slot", *(name.lower() for name in tables)}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in own]
    # The table has MAX_SLOTS rows at most, so it may be broadcast whatever the data are.
    placed = rows.select(*kept, slot_of(F.col(f"`{key}`"), slots).alias("slot")).join(F.broadcast(table), "slot", "left")
    return placed.select(*(f"`{c}`" for c in rows.columns if c.lower() not in own), "slot", *tables)


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def document_shards(documents: DataFrame) -> DataFrame:
    """Every document's shard among ``SHARDS``, and the one it gets when a shard is added."""
    tables = {"shard": fill(shard_names(SHARDS)), "next_shard": fill(shard_names(SHARDS + 1))}
    return place_in(documents.select("doc_id"), "doc_id", tables).select("doc_id", "slot", "shard", "next_shard")
