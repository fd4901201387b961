"""Sharding by a permutation-filled lookup table (operator 9).

Each shard has an order of preference over the slots of a prime-sized table: an
offset and a stride from its name's hash.  Shards take turns, each claiming the first
slot of its order that is still free, until the table is full; so every shard gets
the same number of slots, give or take one, and a shard that joins or leaves moves
few others.  A row's key hashes to a slot, and a broadcast join with the table of
``slots`` rows finds the shard.  The table's size does not depend on the data.

Defined results: a null key has the hash of the empty string; equal keys share a shard;
the shard names must be distinct and at most as many as slots; other columns pass through,
and existing columns called ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, over a hundred times the number of shards for a balance within one per cent.
SLOTS = 65_537


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that owns each slot."""
    if len(set(names)) != len(names) or not 0 < len(names) <= slots:
        raise ValueError("shard names must be distinct, at least one and at most one for each slot")
    if slots < 3 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be an odd prime")
    place = [_hash(f"offset {name}") % slots for name in names]
    stride = [_hash(f"stride {name}") % (slots - 1) + 1 for name in names]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(min(len(names), free)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + stride[shard]) % slots
            owner[place[shard]] = shard
            free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def assign(df: DataFrame, names: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, the number of the shard that owns the key's slot."""
    owners = df.sparkSession.createDataFrame(list(enumerate(lookup_table(names, slots))), "_slot long, _shard int")
    placed = df.withColumn("slot", slot_of(F.col(key), slots)).drop("shard")
    return (placed.join(F.broadcast(owners), F.col("slot") == F.col("_slot"))
            .withColumnRenamed("_shard", "shard").drop("_slot"))


def write_shards(df: DataFrame, path: str, names: list[str], key: str = "doc_id", files: int = 1, slots: int = SLOTS) -> None:
    """Parquet under ``shard=<number>``, each shard in about ``files`` files, dealt by slot so no task holds a whole shard."""
    placed = assign(df, names, key, slots)
    (placed.repartition(len(names) * files, "shard", F.pmod(F.xxhash64(key), F.lit(files)))
     .write.partitionBy("shard").parquet(path))
