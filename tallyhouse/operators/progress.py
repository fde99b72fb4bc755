"""Progress flags and pending work.

Files have no UPDATE, so a flag change is a new DataFrame to be written as a new snapshot. Where no flag column is
needed, `pending` derives the open work from what was written, which also makes reruns safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedupe import new_rows
from tallyhouse.operators.joins import join_on_keys


def not_done(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(~F.col(flag))


def pending(source: DataFrame, target: DataFrame, key: str | Sequence[str], hot: Sequence[int] = ()) -> DataFrame:
    """Source rows whose key has no row in the target table."""
    return new_rows(source, target, key, hot)


def mark_done(df: DataFrame, done: DataFrame, key: str, flag: str, hot: Sequence[int] = ()) -> DataFrame:
    """Set `flag` on rows whose key is in `done`; other rows keep their value. Column order is kept."""
    keys = done.select(key).distinct().withColumn("_done", F.lit(True))
    marked = join_on_keys(df, keys, [key], "left", hot)
    return marked.withColumn(flag, F.coalesce(F.col("_done"), F.col(flag))).select(*df.columns)


def mark_fetched(header: DataFrame, requested: DataFrame, loaded: DataFrame, flag: str, key: str = "uniqueOrderId",
                 scope: str = "requested") -> DataFrame:
    """Flag orders after a payment or sales fetch.

    `requested`: every order that was asked for is flagged, provided at least one row was loaded.
    `returned`: only orders that came back are flagged, so the others are asked for again.
    """
    if scope == "returned":
        return mark_done(header, loaded, key, flag)
    if scope != "requested":
        raise ValueError(f"unknown scope {scope!r}")
    return header if loaded.isEmpty() else mark_done(header, requested, key, flag)
