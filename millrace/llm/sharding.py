"""Sharding by a permutation-filled lookup table.

Each shard ranks the slots of a prime-sized table by its own permutation; shards take turns, each
claiming its best free slot, until the table is full. Slots differ by at most one between shards,
and adding or removing a shard moves little beyond its own share. The table is of fixed size
(`slots`), whatever the data, so it is broadcast; a document is placed by one hash and one lookup.

Defined results: a null id is placed as the empty key; repeated ids share a shard; the empty table
gives no rows; other columns are ignored. Texts aren't read, so their length doesn't matter. Shards
that prefer the same slot take it in the order they are listed. A shard count outside 1..slots, repeated
names, a table size that is not prime, or an id column called slot or shard is a ValueError.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table

SHARDS, SLOTS = 64, 65_537


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number in each slot."""
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table's size must be prime")
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, and 1 to as many as there are slots")
    prefer = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        prefer.append((int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1))
    owner, step, filled = [-1] * slots, [0] * len(shards), 0
    while True:
        for shard, (offset, skip) in enumerate(prefer):
            slot = (offset + step[shard] * skip) % slots
            while owner[slot] >= 0:
                step[shard] += 1
                slot = (offset + step[shard] * skip) % slots
            owner[slot] = shard
            step[shard] += 1
            filled += 1
            if filled == slots:
                return owner


def default_shards() -> list[str]:
    return [f"shard-{i:05d}" for i in range(SHARDS)]


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of its md5, modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(docs: DataFrame, id_col: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """(doc_id, slot, shard) of each row."""
    if id_col in ("slot", "shard"):
        raise ValueError("the id column may not be called slot or shard")
    owner = lookup_table(shards if shards is not None else default_shards(), slots)
    lookup = docs.sparkSession.createDataFrame(list(enumerate(owner)), "slot int, shard int")
    keyed = docs.select(F.col(id_col), slot_of(F.col(id_col), slots).alias("slot"))
    return keyed.join(F.broadcast(lookup), "slot").select(id_col, "slot", "shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The table is a string of two digits a slot; the slot is 60 bits of the id's md5, modulo the table's size."""
    table_text = "".join(f"{shard:02d}" for shard in lookup_table(default_shards()))
    return f"""
WITH placed AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::UBIGINT % {SLOTS} AS INTEGER) AS slot FROM documents)
SELECT doc_id, slot, CAST(substr('{table_text}', 2 * slot + 1, 2) AS INTEGER) AS shard FROM placed
"""


QUERIES = {"op8_sharding": op8_sharding}
ORACLE = {"op8_sharding": _sql()}
