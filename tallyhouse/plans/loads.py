"""Report rows to raw tables: rename and type, add constants, fill nulls, drop what is stored."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import as_date, blank_nulls, named, row_key
from tallyhouse.operators.dedupe import find_duplicates, new_rows
from tallyhouse.operators.joins import small_sides
from tallyhouse.operators.windows import rows_inside, rows_to_backfill
from tallyhouse.schemas import (
    CURRENCY, CURRENCY_FIELDS, HEADER_FIELDS, PAYMENT_ENTRY, PAYMENT_ENTRY_FIELDS, PAYMENT_FIELDS, RAW_HEADER,
    RAW_PAYMENT, RAW_SALES, SALES_FIELDS)


def typed(rows: DataFrame, fields, *more: Column, strict: bool = False) -> DataFrame:
    """Report fields under their stored names and types.

    A value that does not fit its type becomes null (`metrics.misfits` counts them), or is an error if `strict`.
    """
    def cast(column: Column, kind: str) -> Column:
        return column.cast(kind) if strict else column.try_cast(kind)

    return rows.select(*[cast(named(field), kind).alias(stored) for field, stored, kind in fields], *more)


def _shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    return blank_nulls(df.select(*schema.names))


def shape_header(rows: DataFrame, store_id: Column) -> DataFrame:
    flags = [F.lit(False).alias(flag) for flag in ("transformFlag", "fetchSales", "fetchPayment")]
    return _shaped(typed(rows, HEADER_FIELDS, store_id.cast("string").alias("storeID"), *flags), RAW_HEADER)


def shape_payment(rows: DataFrame) -> DataFrame:
    renamed = typed(rows, PAYMENT_FIELDS)
    return _shaped(renamed.withColumn("uid", row_key(F.col("uniqueOrderId"), F.col("paymentType"))), RAW_PAYMENT)


def shape_sales(rows: DataFrame) -> DataFrame:
    return _shaped(typed(rows, SALES_FIELDS), RAW_SALES)


def shape_payment_entry(rows: DataFrame, store_id: Column) -> DataFrame:
    renamed = typed(rows, PAYMENT_ENTRY_FIELDS, store_id.cast("string").alias("storeID"))
    return _shaped(renamed.withColumn("uid", row_key(F.col("uniqOrderId"), F.col("payTypes"))), PAYMENT_ENTRY)


def load_header(rows: DataFrame, stored: DataFrame, store_id: Column, untransformed_only: bool = False,
                once: bool = False) -> DataFrame:
    """Header rows not stored yet for their store.

    `untransformed_only` compares with stored rows that still wait for enrichment, so an order that was enriched
    lands again. By default every stored row counts. `once` keeps one row of an order repeated inside the batch.
    """
    key = ["storeID", "uniqueOrderId"]
    known = stored.filter(~F.col("transformFlag")) if untransformed_only else stored
    batch = shape_header(rows, store_id)
    return new_rows(batch.dropDuplicates(key) if once else batch, known, key)


def _new_by_uid(batch: DataFrame, stored: DataFrame, hot: Sequence[int], blank_is_new: bool) -> DataFrame:
    """Rows whose `uid` is not stored. A blank one says nothing about its row: it is new unless asked otherwise."""
    if not blank_is_new:
        return new_rows(batch, stored, "uid", hot)
    key = F.nullif(F.col("uid"), F.lit(""))  # a null never matches
    return new_rows(batch.withColumn("_key", key), stored.select(key.alias("_key")), "_key", hot).drop("_key")


def load_payment(rows: DataFrame, stored: DataFrame, hot: Sequence[int] = (), blank_is_new: bool = True) -> DataFrame:
    return _new_by_uid(shape_payment(rows), stored, hot, blank_is_new)


def load_sales(rows: DataFrame, stored: DataFrame, hot: Sequence[int] = (), sift: bool = True) -> DataFrame:
    """Sales lines of orders not stored yet. Lines that arrive late for a stored order are dropped with it.

    `sift` is of no use for rows that were joined by order before, as they have been moved already.
    """
    return new_rows(shape_sales(rows), stored, "uniqueOrderId", hot, sift)


class EntryLoad(NamedTuple):
    new: DataFrame
    duplicates: DataFrame


def load_payment_entry(rows: DataFrame, stored: DataFrame, store_id: Column, hot: Sequence[int] = ()) -> EntryLoad:
    """New rows of the older payment table, and the rows that were stored before."""
    batch = shape_payment_entry(rows, store_id)
    known = stored.filter(F.col("uid") != "")
    return EntryLoad(_new_by_uid(batch, stored, hot, True), find_duplicates(batch, known, "uid", hot))


def load_all_stores(rows: DataFrame, stored: DataFrame, marks: DataFrame, run_date: date, max_days: int,
                    store_id: Column, start_date: date | None = None) -> DataFrame:
    """The header load of every store at once: rows inside their store's open windows that are not stored."""
    batch = shape_header(rows, store_id)
    return new_rows(rows_to_backfill(batch, marks, run_date, max_days, start_date), stored, ["storeID", "uniqueOrderId"])


class StoresLoad(NamedTuple):
    headers: DataFrame
    payments: DataFrame
    sales: DataFrame


def load_all_tables(headers: DataFrame, payments: DataFrame, sales: DataFrame, stored: StoresLoad, spans: DataFrame, store_id: Column,
                    payment_store: Column, sales_store: Column, hot: Sequence[int] = ()) -> StoresLoad:
    """The loads of header, payments and sales of every store, over the open spans of the stores (see `backfill_spans`).

    Payments and sales rows carry no store, so `payment_store` and `sales_store` say which it is. The spans are
    read several times, so give a stored table.
    """
    small = "spans" in small_sides({"spans": spans})
    # Days of no span go by a plain filter, which Spark puts before joins that placed the rows in their stores.
    first, last = spans.agg(F.min("_from"), F.max("_to")).first()

    def inside(rows: DataFrame, store: Column, day: str) -> DataFrame:
        asked = rows.filter(as_date(named(day)).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        marked = asked.withColumns({"_store": store.cast("string"), "_day": named(day)})
        return rows_inside(marked, spans.withColumnRenamed("storeID", "_store"), small, "_store", "_day").drop("_store", "_day")

    batch = rows_inside(shape_header(headers, store_id), spans, small)
    return StoresLoad(
        new_rows(batch, stored.headers, ["storeID", "uniqueOrderId"]),
        load_payment(inside(payments, payment_store, "OpenDate.Typed"), stored.payments),
        load_sales(inside(sales, sales_store, "OpenDate.Typed"), stored.sales, hot, sift=False))


def load_currency(sheet: DataFrame) -> DataFrame:
    """Currency sheet rows under their stored names."""
    return _shaped(typed(sheet, CURRENCY_FIELDS), CURRENCY)
