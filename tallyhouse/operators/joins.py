"""Equi-joins that hold up when a few keys own a large share of the rows.

A mapping is broadcast only after its bytes were measured. Two large sides meet in one shuffle join; rows of keys known
to be hot are dealt to several tasks by a salt, and the few matching rows of the other side are copied to each of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import named, row_bytes

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with this many rows is hot, whatever its share of all rows.
HOT_ROWS = 1_000_000
# Tasks that the rows of a hot key are dealt to.
SALTS = 64
_TOP_KEYS = 500
_TRACKED_KEYS = 5_000
_SALT = "_salt"


def small_sides(sides: Mapping[str, DataFrame], max_bytes: int = BROADCAST_BYTES) -> frozenset[str]:
    """Names of the sides whose measured bytes fit a broadcast. One job over all of them."""
    sizes = [df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).select(F.lit(name).alias("side"), "bytes")
             for name, df in sides.items()]
    return frozenset(row.side for row in reduce(DataFrame.unionAll, sizes).collect() if row.bytes <= max_bytes)


def key_digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[named(k) for k in keys])


def top_keys(keys: Sequence[str]) -> Column:
    """Aggregate: digests of the join keys with the most rows, by a mergeable frequent-items sketch; `hot_of` reads it."""
    digest = "xxhash64(" + ", ".join("`" + k.replace("`", "``") + "`" for k in keys) + ")"
    return F.expr(f"approx_top_k({digest}, {_TOP_KEYS}, {_TRACKED_KEYS})")


def hot_of(top, min_rows: int = HOT_ROWS) -> tuple[int, ...]:
    """The hot ones among `top_keys`: those with at least `min_rows` rows."""
    return tuple(entry["item"] for entry in top or () if entry["count"] >= min_rows)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> tuple[int, ...]:
    """Digests of the join keys that own at least `min_rows` rows; the largest of them, where there are very many.

    A mergeable frequent-items sketch finds them in one scan without a shuffle by key. The answer only picks how rows
    are dealt, so an estimate is enough: results are the same for any answer.
    """
    return hot_of(df.agg(top_keys(keys).alias("top")).first().top, min_rows)


def join_on_keys(facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
                 hot: Sequence[int] = (), salts: int = SALTS) -> DataFrame:
    """Join two large sides on equal-named, equal-typed keys; `how` keeps or drops rows of `facts` only.

    `hot` comes from `hot_keys`. Each side is read once. Rows of `facts` with a hot key are dealt to `salts` tasks;
    other rows with that key are copied to all of them, so `other` should hold few rows for each key.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = on
    if hot:
        for key in on:
            if facts.schema[key].dataType != other.schema[key].dataType:
                raise TypeError(f"join key {key!r} differs in type between the sides")
        is_hot = key_digest(on).isin(*hot)
        # Rows alike in all columns differ by the task that read them. A retried task deals its rows the same way.
        spread = F.pmod(F.xxhash64(*[named(c) for c in facts.columns]) + F.spark_partition_id(), F.lit(salts)).cast("int")
        every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        joined = facts.withColumn(_SALT, F.when(is_hot, spread).otherwise(F.lit(0))).join(
            other.withColumn(_SALT, F.explode(every)), [*on, _SALT], how).drop(_SALT)
    else:
        joined = facts.join(other, keys, how)
    # The types that keep no column of `other` also keep the column order of `facts`.
    return joined.select(*[named(name) for name in facts.columns]) if how in ("left_semi", "left_anti") else joined


def join_dimension(facts: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner",
                   small: bool = False) -> DataFrame:
    """Join facts to a mapping. `small` says the mapping was measured and fits; else both sides shuffle."""
    if small:
        return facts.join(F.broadcast(dimension), list(on), how)
    return join_on_keys(facts, dimension, on, how, hot_keys(facts, on))
