"""Sharding by a permutation-filled lookup table (Maglev hashing).

Every shard orders the slots of a table of prime size by its own permutation
(offset and skip from its name); in turn, each shard claims its next free
slot, until the table is full.  Shards get almost equal numbers of slots, and
a changed list of shards moves few slots.  The table has a fixed size whatever
the data, so it is broadcast, and a row finds its shard by one hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # prime


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Shard number (in sorted order of names) of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if len(shards) > slots or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table needs a prime size of at least the number of shards")
    names = sorted(shards)
    steps = [1 + _number(n, "skip") % (slots - 1) for n in names]
    at = [_number(n, "offset") % slots for n in names]
    table = np.full(slots, -1, np.int32)
    claimed = 0
    while True:
        for i in range(len(names)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + steps[i]) % slots
            table[at[i]] = i
            claimed += 1
            if claimed == slots:
                return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key (its text); null has a slot too.  60 bits of MD5, so that SQL elsewhere can repeat it."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (columns of those names are replaced).

    Equal keys share a shard; a null key counts as the empty text.  Every row
    is placed, repeated ones alike; an empty table stays empty.
    """
    names = sorted(shards)
    table = docs.sparkSession.createDataFrame(
        [(i, names[s]) for i, s in enumerate(lookup_table(shards, slots).tolist())], "slot int, shard string"
    )
    placed = docs.drop("slot", "shard").withColumn("slot", slot(F.col(key_col), slots))
    return placed.join(F.broadcast(table), "slot").select(*placed.columns, "shard")
