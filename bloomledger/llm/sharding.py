"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size,
(offset + j * skip) mod size.  The shards take turns; at its turn a shard claims the
first slot of its order that is still free.  Slot counts of shards differ by one at
most, and adding or removing a shard moves few slots of the others.  A row's slot is
its key's hash modulo the size, and the filled table of fixed length is broadcast, so
placement is one hash and one look-up, without a shuffle, however hot a source is.

Nulls: a null key has a slot of its own like any key.  Repeated rows and equal keys go
to the same shard.  An empty table stays empty.  Other columns pass unchanged; one that
has the name of the shard column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm.common import table

TABLE_SIZE = 65_537  # prime, and over 100 slots for each of up to 655 shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))

_SLOT = "__slot_of_key"


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard number that holds each slot, shards being numbered as given."""
    if not _is_prime(size):
        raise ValueError(f"the table size must be prime: {size}")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must have distinct names, at least one and no more than slots")
    at, skip = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        at.append(int.from_bytes(digest[:8], "big") % size)
        skip.append(int.from_bytes(digest[8:16], "big") % (size - 1) + 1)
    owner = [-1] * size
    filled = 0
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % size
            owner[at[shard]] = shard
            filled += 1
            if filled == size:
                return owner


def place(
    docs: DataFrame,
    shards: Sequence[str] = SHARDS,
    key: str = "doc_id",
    size: int = TABLE_SIZE,
    shard_column: str = "shard",
) -> DataFrame:
    """The rows with the name of their shard."""
    owners = fill_table(shards, size)
    slots = docs.sparkSession.createDataFrame(
        pa.table({_SLOT: pa.array(range(size), pa.int64()), shard_column: [shards[i] for i in owners]})
    )
    keyed = docs.drop(shard_column).withColumn(_SLOT, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(size)))
    return keyed.join(F.broadcast(slots), _SLOT, "left").drop(_SLOT)


def op4_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id"))
