"""Rows of a batch that are stored already, and rows that are not.

Stored keys are made distinct, or counted, before the join, so no pairs are formed. Nothing is measured beforehand:
adaptive execution sees how large both sides really are when they are shuffled, and broadcasts the smaller one if it
fits. The batch is read once, but for loads of wide rows: there the new keys are told from narrow rows first, and most
rows that are stored go before they are moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import named
from tallyhouse.operators.joins import join_on_keys, key_digest


# Bits that keys are hashed to, and of one row of them: 32 MB in all, however many keys there are.
_SIFT_BITS, _PAGE_BITS = 1 << 28, 1 << 15


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def sifted(batch: DataFrame, wanted: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Batch rows whose key may be among the wanted ones, and rows with a null key, without moving them.

    A bit is set for the hash of each wanted key, and rows whose bit is not set go. Some others pass by chance, the more
    the more keys are wanted, so a join has to follow. `wanted` holds keys of the batch, in its types.
    """
    keys = _keys(key)
    bit = F.pmod(key_digest(keys), F.lit(_SIFT_BITS))
    page, place = F.shiftright(bit, _PAGE_BITS.bit_length() - 1).cast("int"), bit.bitwiseAND(F.lit(_PAGE_BITS - 1))
    pages = wanted.select(page.alias("_page"), place.alias("_place")).groupBy("_page").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1
    no_key = reduce(Column.__or__, [named(k).isNull() for k in keys])
    joined = batch.withColumn("_page", page).join(F.broadcast(pages), "_page", "left")
    return joined.filter(no_key | F.coalesce(is_set, F.lit(False))).select(*[named(c) for c in batch.columns])


def new_rows(batch: DataFrame, stored: DataFrame, key: str | Sequence[str], hot: Sequence[int] = (), sift: bool = False) -> DataFrame:
    """Batch rows whose key is not stored. Rows repeated inside the batch all stay; so do rows with a null key.

    `sift` reads the keys of the batch first, so that few of the stored rows are moved: for wide rows.
    """
    keys = _keys(key)
    known = stored.select(*keys).distinct()
    if sift:
        batch = sifted(batch, batch.select(*keys).distinct().join(known, keys, "left_anti"), keys)
    return join_on_keys(batch, known, keys, "left_anti", hot)


def stored_rows(batch: DataFrame, stored: DataFrame, key: str | Sequence[str], hot: Sequence[int] = ()) -> DataFrame:
    """Batch rows whose key is stored, once each."""
    keys = _keys(key)
    return join_on_keys(batch, stored.select(*keys).distinct(), keys, "left_semi", hot)


def new_beside_buckets(batch: DataFrame, stored: DataFrame, key: str, hot: Sequence[int] = (), buckets: int | None = None) -> DataFrame:
    """`new_rows` for stored rows that are bucketed by the key: they are not moved, hot keys or not.

    With the number of `buckets`, the rows come dealt to them, so they can be written to the table without another
    exchange; those of hot keys over tasks of like size.

    Rows of the batch with a hot key stay where they are; the stored keys among the hot ones, as many at most as `hot`
    names, go to all of them.
    """
    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets, key) if buckets else rows

    if not hot:
        return new_rows(dealt(batch), stored, key)
    is_hot = key_digest([key]).isin(*hot)
    few = F.broadcast(stored.filter(is_hot).select(key).distinct())
    of_hot = batch.filter(is_hot).hint("rebalance") if buckets else batch.filter(is_hot)
    return new_rows(dealt(batch.filter(~is_hot)), stored, key).unionByName(of_hot.join(few, [key], "left_anti"))


def paired_rows(batch: DataFrame, stored: DataFrame, key: str, other: str, how: str) -> DataFrame:
    """Batch rows whose `key` and `other` are stored in one row (`left_semi`) or are not (`left_anti`).

    The stored values of `other` are gathered by key, so either side that is bucketed by the key alone is not moved. A
    key should have few of them.
    """
    gathered = stored.groupBy(F.col(key).alias("_key")).agg(F.collect_set(other).alias("_others"))
    return batch.join(gathered, (F.col(key) == F.col("_key")) & F.array_contains("_others", F.col(other)), how)


def find_duplicates(batch: DataFrame, stored: DataFrame, key: str | Sequence[str], hot: Sequence[int] = ()) -> DataFrame:
    """Batch rows whose key is stored, with `storedCopies`, the number of stored rows they match."""
    keys = _keys(key)
    counted = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("storedCopies"))
    return join_on_keys(batch, counted, keys, "inner", hot)
