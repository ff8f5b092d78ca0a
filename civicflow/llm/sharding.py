"""Sharding by a permutation-filled lookup table.

Each shard walks a permutation of the slots of a prime-sized table (offset + k * skip modulo
the size).  The shards take turns; in its turn a shard claims the first slot of its walk that is
still free.  Every shard ends up with the same number of slots to within one, and
adding or removing a shard moves few slots between the others.  A row's key hashes to a
slot, and the table, broadcast, names the shard: one look-up per row and no shuffle of rows.

The table's size is a parameter; it does not grow with the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(16))


def walk(shard: str, slots: int) -> tuple[int, int]:
    """(offset, skip) of a shard's permutation, from its name."""
    number = lambda salt: int(hashlib.md5(f"{salt}:{shard}".encode()).hexdigest()[:8], 16)
    return number("offset") % slots, number("skip") % (slots - 1) + 1


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[str]:
    """The shard of every slot."""
    if not shards or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime number, not less than the number of shards")
    walks = {s: walk(s, slots) for s in shards}
    if len(walks) < len(shards):
        raise ValueError("shards must differ")
    table: list[str | None] = [None] * slots
    steps = dict.fromkeys(shards, 0)
    free = slots
    while free:
        for shard in shards:
            offset, skip = walks[shard]
            while table[slot := (offset + steps[shard] * skip) % slots] is not None:
                steps[shard] += 1
            table[slot] = shard
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 32 bits of its MD5 modulo the size; NULL has the empty key's slot."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slots).cast("int")


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(fill(shards, slots))), "slot int, shard string")


def place(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with two more columns, ``slot`` and ``shard`` (columns of these names are replaced).

    Rows of equal key, NULL keys among them, go to the same shard.  An empty table gives no rows.
    """
    table = lookup_table(docs.sparkSession, shards, slots).withColumnRenamed("slot", "of")
    rows = docs.drop("slot", "shard").select(F.struct("*").alias("row"), slot_of(F.col(key), slots).alias("slot"))
    return rows.join(F.broadcast(table), F.col("slot") == F.col("of")).select("row.*", "slot", "shard")
