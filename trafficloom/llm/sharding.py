"""Placing records on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, from
two digests of its name: it starts at an offset and goes on in equal steps, which meet every
slot. The shards take turns, each claiming the first free slot in its order, until no slot is
free; a shard of weight w takes w turns a round. A record's place is the shard in the slot of
its key's digest: one look, whatever the number of shards, and a changed list of shards
moves little more than the records that have to move.

The table has ``SLOTS`` entries at any data size and goes to the executors as a constant; the
records are not shuffled to be placed. A hot shard can only come from a hot key. ``write_shards``
therefore spreads each shard over several files, by a digest of the whole record's key columns.

Defined cases: a null key is digested as a text of its own, so all null keys share a shard.
Rows that repeat a key share its shard. No shards, repeated names, or weights below one are
errors, as is a table smaller than the number of turns in a round.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import md5

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime; shards' shares differ by about their number over this.
SLOTS = 65537
#: What a null key is digested as; no text of an id is like it.
NULL_KEY = "\x00null"


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def filled_table(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> np.ndarray:
    """The place in the list of shards that each slot belongs to."""
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    if not weights or len(weights) != len(shards) or min(weights.values()) < 1:
        raise ValueError("shards need distinct names and weights of at least one")
    if not is_prime(slots) or sum(weights.values()) > slots:
        raise ValueError("the table needs a prime number of slots, and one for each turn of a round")
    orders = []
    for name in weights:
        digest = md5(name.encode()).digest()
        start = int.from_bytes(digest[:8], "big") % slots
        step = int.from_bytes(digest[8:], "big") % (slots - 1) + 1
        orders.append((start + np.arange(slots, dtype=np.int64) * step) % slots)
    table = np.full(slots, -1, np.int64)
    nth = [0] * len(orders)
    free = slots
    while free:
        for shard, weight in enumerate(weights.values()):
            for _ in range(min(weight, free)):
                order, at = orders[shard], nth[shard]
                while table[order[at]] >= 0:
                    at += 1
                table[order[at]] = shard
                nth[shard] = at + 1
                free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its digest, modulo the size of the table."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit(NULL_KEY)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(slots)


def placed(rows: DataFrame, key_col: str, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> DataFrame:
    """The rows with their ``slot`` and ``shard``; columns of these names are replaced."""
    names = list(shards)
    table = filled_table(shards, slots)
    # One byte string of fixed size, two bytes a slot, rather than a literal per slot.
    width = 2 if len(names) < 1 << 16 else 4
    packed = F.lit(bytearray(table.astype(f">u{width}").tobytes()))
    found = F.conv(F.hex(F.substring(packed, (F.col("slot") * width + 1).cast("int"), width)), 16, 10).cast("int")
    listed = F.array(*(F.lit(n) for n in names))
    return rows.withColumn("slot", slot_of(F.col(key_col), slots)).withColumn("shard", F.get(listed, found))


def moved(
    rows: DataFrame,
    key_col: str,
    before: Sequence[str] | Mapping[str, int],
    after: Sequence[str] | Mapping[str, int],
    slots: int = SLOTS,
) -> DataFrame:
    """Rows whose shard changes with the list of shards, with ``shard`` and ``new_shard``."""
    old = placed(rows, key_col, before, slots)
    new = placed(old.withColumnRenamed("shard", "old_shard"), key_col, after, slots)
    changed = new.filter("old_shard <> shard").withColumnRenamed("shard", "new_shard")
    return changed.withColumnRenamed("old_shard", "shard")


def write_shards(
    rows: DataFrame, key_col: str, shards: Sequence[str] | Mapping[str, int], path: str, files: int = 1, slots: int = SLOTS
) -> None:
    """Writes the rows as Parquet in a folder per shard, each in about ``files`` files.

    All columns take part in the choice of the file, so a key that holds a third of the
    rows fills its shard's files evenly unless whole rows repeat.
    """
    spread = placed(rows, key_col, shards, slots).withColumn("file", F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
    # The number is given, as adaptive execution would merge small partitions again.
    dealt = spread.repartition(len(shards) * files, "shard", "file").drop("file")
    dealt.write.partitionBy("shard").parquet(path)
