"""Writers of raw tables, enriched tables, duplicate lists and extract files. Columns are matched by name."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import join_dimension, small_sides
from tallyhouse.sources.readers import CSV, escape_lines
from tallyhouse.sources.scratch import freed_shuffles


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `df` in the order and types of `schema`. A missing column is an error."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table.

    With `partition_by`, rows are first rebalanced on those columns: small partitions share a task and a file, and a
    partition that holds most of the rows is split over many.
    """
    rows = df if schema is None else conform(df, schema)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    with freed_shuffles(rows.sparkSession):
        rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a table state to a path that must not exist yet, so it cannot replace what it was read from."""
    df.write.mode("errorifexists").parquet(path)


def write_duplicates(duplicates: DataFrame, path: str) -> None:
    escape_lines(duplicates).write.mode("errorifexists").options(**CSV).csv(path)


def named_extracts(rows: DataFrame, stores: DataFrame, first: date, last: date, prefix: str = "PaymentEntry",
                   store: str = "storeID", concept: str = "conception") -> DataFrame:
    """Rows with their `Folder` and `Extract` name, `prefix_store_code_concept_from_to`.

    `stores` holds StoreId, StoreCode, Concept and Folder. Rows of a store and concept not listed go nowhere.
    """
    listed = stores.select(F.col("StoreId").alias(store), F.col("Concept").alias(concept), "StoreCode", "Folder").distinct()
    small = "stores" in small_sides({"stores": listed})
    named = join_dimension(rows, listed, [store, concept], "inner", small)
    name = F.concat_ws("_", F.lit(prefix), store, "StoreCode", concept, F.lit(first.isoformat()), F.lit(last.isoformat()))
    return named.withColumn("Extract", name).select(*rows.columns, "Folder", "Extract")


def write_extracts(extracts: DataFrame, path: str, form: str) -> None:
    """Write extract rows as `csv` or `json` files, one directory per folder and extract."""
    if form not in ("csv", "json"):
        raise ValueError(f"extract form {form!r}")
    rows = escape_lines(extracts) if form == "csv" else extracts
    writer = rows.hint("rebalance", "Folder", "Extract").write.mode("errorifexists").partitionBy("Folder", "Extract")
    writer.options(**CSV).csv(path) if form == "csv" else writer.json(path)
