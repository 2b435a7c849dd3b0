"""Sharding by a lookup table that the shards fill in turns."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime; the table has that many slots whatever the data.
SLOTS = 65537


def _hash(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot.

    A shard prefers the slots in the order offset, offset + skip, ... (mod slots),
    offset and skip hashed from its name; as the number of slots is prime, that is
    a permutation. The shards take turns, each claiming the first slot of its order
    that is still free, so their shares differ by one slot at most, and a shard that
    joins or leaves moves little else. The table depends on names alone; it is
    settings, not data, and bounded by ``slots``.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if slots < len(shards) or slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, no less than the number of shards")
    at = [_hash(f"{name}:offset") % slots for name in shards]
    skip = [_hash(f"{name}:skip") % (slots - 1) + 1 for name in shards]
    table: list[int] = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + skip[shard]) % slots
        table[at[shard]] = shard
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; null counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def assign(docs: DataFrame, shards: list[str], key: str = "doc_id", into: str = "shard", slots: int = SLOTS) -> DataFrame:
    """``docs`` with the name of the shard of each row in column ``into``.

    The table travels with the plan as one constant array, so a row costs one hash and
    one lookup, and nothing is shuffled; rows of one key go to one shard. A column
    ``into`` that ``docs`` has already, in any case, is replaced. No rows give none.
    """
    table = F.split(F.lit(",".join(map(str, fill_table(shards, slots)))), ",").cast("array<int>")
    names = F.array(*[F.lit(name) for name in shards])
    shard = F.get(names, F.get(table, slot_of(docs[f"`{key}`"], slots)))
    kept = [docs[f"`{c}`"] for c in docs.columns if c.lower() != into.lower()]
    return docs.select(*kept, shard.alias(into))
