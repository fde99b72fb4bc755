"""The registered queries. Each runs one operator or one composed job over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.catalogue.standins import Tables
from tallyhouse.functions.columns import named
from tallyhouse.operators.dedupe import find_duplicates, stored_rows
from tallyhouse.operators.metrics import counted, misfits
from tallyhouse.operators.progress import mark_done, mark_fetched, not_done
from tallyhouse.operators.reports import (
    DateRange, ReportSpec, ValueList, olap_report, report_over_states, report_states, store_states, stored_states)
from tallyhouse.operators.together import together
from tallyhouse.operators.windows import (
    backfill_spans, backfill_windows, custom_dates, high_water_marks, pending_window, previous_day)
from tallyhouse.plans import report_specs
from tallyhouse.plans.flags import flagged_headers, fold_flags, set_returned
from tallyhouse.plans.jobs import Warehouse, enrich, load, open_orders, store_marks, unmapped
from tallyhouse.plans.loads import (
    StoresLoad, load_all_tables, load_currency, load_header, load_payment, load_payment_entry, load_sales, shape_header,
    shape_payment_entry)
from tallyhouse.plans.transforms import Mappings, transform_header, transform_payment, transform_sales, unmapped_headers
from tallyhouse.sources.answers import Answers, read_answers, stored_names
from tallyhouse.sources.extract_files import read_extract_files, write_extract_files
from tallyhouse.sources.readers import (
    query_table, read_currency_sheet, read_envelopes, read_store_master, read_table, read_text_rows, scan_envelopes)
from tallyhouse.sources.scratch import freed_shuffles, scratch_path
from tallyhouse.sources.writers import append, named_extracts, write_duplicates, write_extracts, write_snapshot

STORED_BEFORE = date(1998, 1, 1)
RUN_DATE = date(2000, 12, 31)
MAX_DAYS = 5
_ROW_GROUP = 16 << 20
# Named in extracts; nothing is cut by it.
WHOLE_SPAN = (date(1995, 1, 1), date(2001, 12, 31))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, the two types every client reads alike."""
    columns = []
    for f in df.schema.fields:
        kind = {T.DecimalType: "double", T.DateType: "string"}.get(type(f.dataType))
        columns.append(named(f.name).cast(kind).alias(f.name) if kind else named(f.name))
    return df.select(*columns)


def query(name: str):
    """Register the decorated function under `name`."""
    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: plain(function(Tables(spark, folder)))
        return function
    return register


def report_rows(raw: DataFrame, fields) -> DataFrame:
    """Raw rows under their report fields, as the service would send them; dates as text."""
    return raw.select(*[
        (F.col(stored).cast("string") if kind == "date" else F.col(stored)).alias(field) for field, stored, kind in fields])


def stored(raw: DataFrame, day: str = "accountingDay") -> DataFrame:
    return raw.filter(F.col(day) < F.lit(STORED_BEFORE))


# Enrichment


@query("transform_header")
def transform_header_full(t: Tables) -> DataFrame:
    return transform_header(t.raw_header(), t.mappings(), full_refresh=True)


@query("transform_header_incremental")
def transform_header_incremental(t: Tables) -> DataFrame:
    return transform_header(t.raw_header(), t.mappings())


def _partly_done(header: DataFrame, flag: str) -> DataFrame:
    """An enriched header whose older orders carry the flag."""
    return header.withColumn(flag, F.to_date("accountingDate", "dd/MM/yyyy") < F.lit(STORED_BEFORE))


def _enriched_payments(t: Tables, mappings) -> DataFrame:
    header = _partly_done(transform_header(t.raw_header(), mappings, full_refresh=True), "paymentTransformed")
    return transform_payment(t.raw_payment(), header, mappings, t.hot_orders())


def _enriched_sales(t: Tables, mappings) -> DataFrame:
    header = _partly_done(transform_header(t.raw_header(), mappings, full_refresh=True), "salesTransformed")
    return transform_sales(t.raw_sales(), header, mappings, t.hot_orders())


@query("transform_payment")
def transform_payments(t: Tables) -> DataFrame:
    return _enriched_payments(t, t.mappings())


@query("transform_sales")
def transform_sales_lines(t: Tables) -> DataFrame:
    return _enriched_sales(t, t.mappings())


@query("unmapped_orders")
def unmapped_orders(t: Tables) -> DataFrame:
    return unmapped_headers(t.raw_header(), t.mappings()).select("uniqueOrderId", "store", "conception", "delivery", "lacks")


# Loads


@query("load_header")
def load_headers(t: Tables) -> DataFrame:
    raw = t.raw_header()
    rows = report_rows(raw, schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum"))
    return load_header(rows, stored(raw), F.col("StoreId"))


@query("load_headers_untransformed_only")
def load_headers_untransformed_only(t: Tables) -> DataFrame:
    raw = t.raw_header()
    # Of the stored rows, those of the second half of 1997 still wait for enrichment.
    landed = stored(raw).withColumn("transformFlag", F.col("accountingDay") < F.lit(date(1997, 7, 1)))
    rows = report_rows(raw, schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum"))
    return load_header(rows, landed, F.col("StoreId"), untransformed_only=True)


@query("load_payment")
def load_payments(t: Tables) -> DataFrame:
    raw = t.raw_payment()
    return load_payment(report_rows(raw, schemas.PAYMENT_FIELDS), stored(raw))


@query("load_sales")
def load_sales_lines(t: Tables) -> DataFrame:
    raw = t.raw_sales()
    return load_sales(report_rows(raw, schemas.SALES_FIELDS), stored(raw), t.hot_orders())


def _entry_rows(t: Tables) -> DataFrame:
    return olap_report(t.report_lines(), report_specs.OLDER_PAYMENT)


def _landed(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """The rows, written once and read from there: they are used more than once."""
    path = scratch_path(t.spark, name)
    with freed_shuffles(t.spark):
        # Row groups are kept small, so that readers can split the files of few tasks.
        df.write.option("compression", "zstd").option("parquet.block.size", _ROW_GROUP).parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


def _entry_load(t: Tables):
    rows = _landed(t, _entry_rows(t), "entry-rows")
    landed = stored(shape_payment_entry(rows, named("Department")), "openDate")
    return load_payment_entry(rows, landed, named("Department"))


@query("load_payment_entry")
def load_payment_entries(t: Tables) -> DataFrame:
    return _entry_load(t).new


@query("payment_entry_duplicates")
def payment_entry_duplicates(t: Tables) -> DataFrame:
    """Duplicates of the older payment load, written as CSV and read back."""
    duplicates = _entry_load(t).duplicates
    path = scratch_path(t.spark, "duplicates")
    write_duplicates(duplicates, path)
    return read_text_rows(t.spark, path, duplicates.schema)


@query("find_duplicates")
def find_stored_lines(t: Tables) -> DataFrame:
    raw = t.raw_sales()
    return find_duplicates(raw, stored(raw), "uniqueOrderId", t.hot_orders())


def _multi_store(t: Tables, hot: Sequence[int] = ()) -> StoresLoad:
    """The three loads of all stores, over their open windows. The store of a line or payment is that of its order."""
    raw = _landed(t, t.raw_header(), "header")
    landed = StoresLoad(stored(raw), stored(t.raw_payment()), stored(t.raw_sales()))
    stores = raw.select("uniqueOrderId", F.col("storeID").alias("StoreId"))

    def rows(table: DataFrame, fields) -> DataFrame:
        placed = table.join(stores, "uniqueOrderId")
        return report_rows(placed, [*fields, ("StoreId", "StoreId", "string")])

    headers = report_rows(raw, schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum"))
    store = F.col("StoreId")
    spans = _landed(t, backfill_spans(high_water_marks(landed.headers), RUN_DATE, MAX_DAYS), "spans")
    return load_all_tables(headers, rows(t.raw_payment(), schemas.PAYMENT_FIELDS), rows(t.raw_sales(), schemas.SALES_FIELDS),
                           landed, spans, store, store, store, hot)


@query("multi_store_load")
def multi_store_load(t: Tables) -> DataFrame:
    return _multi_store(t).headers


@query("multi_store_load_payment")
def multi_store_load_payment(t: Tables) -> DataFrame:
    return _multi_store(t).payments


@query("multi_store_load_sales")
def multi_store_load_sales(t: Tables) -> DataFrame:
    return _multi_store(t, t.hot_orders()).sales


# The daily job


class _Delivery(NamedTuple):
    headers: DataFrame
    payments: DataFrame
    sales: DataFrame


def _deliveries(t: Tables) -> tuple[_Delivery, _Delivery]:
    """The reports of two days.

    The first brings older headers, card payments of all orders, and lines of every second order: payments and lines of
    later orders wait for their header. The second brings all rows; payments of the other kind come late for orders
    enriched on the first.
    """
    raw = ((t.raw_header(), "header"), (t.raw_payment(), "payments"), (t.raw_sales(), "sales"))
    landed = together(t.spark, [partial(_landed, t, rows, name) for rows, name in raw])
    headers, payments, sales = (report_rows(rows, fields) for rows, fields in zip(
        landed, (schemas.HEADER_FIELDS, schemas.PAYMENT_FIELDS, schemas.SALES_FIELDS)))
    headers = headers.withColumn("StoreId", F.col("TableNum"))
    old = F.to_date("`OpenDate.Typed`") < F.lit(STORED_BEFORE)
    first = _Delivery(headers.filter(old), payments.filter(named("PayTypes") == "Card"), sales.filter(F.col("OrderNum") % 2 == 0))
    return first, _Delivery(headers, payments, sales)


def _daily_job(t: Tables, *days: str) -> Warehouse:
    """Loads and enrichment of some days. The third brings the rows of the second again and finds nothing to do."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    mappings = Mappings.measured(*together(t.spark, [partial(_landed, t, side, name) for side, name in t.mapping_tables()]))
    first, second = _deliveries(t)
    for day in days:
        load(warehouse, *(first if day == "day 1" else second), F.col("StoreId"), day)
        enrich(warehouse, mappings, day)
    return warehouse


DAYS = ("day 1", "day 2", "day 3")


@query("daily_job")
def daily_job(t: Tables) -> DataFrame:
    """The enriched headers of the job; row ids are this library's own."""
    return _daily_job(t, *DAYS).read("transformHeader").select(*schemas.ENRICHED_HEADER_COLUMNS).drop("fk_rawHeader")


@query("daily_job_payment")
def daily_job_payment(t: Tables) -> DataFrame:
    return _daily_job(t, *DAYS).read("transformPayment").select(*schemas.ENRICHED_PAYMENT_COLUMNS)


@query("daily_job_sales")
def daily_job_sales(t: Tables) -> DataFrame:
    return _daily_job(t, *DAYS).read("transformSales").select(*schemas.ENRICHED_SALES_COLUMNS)


@query("daily_job_payment_entry")
def daily_job_payment_entry(t: Tables) -> DataFrame:
    """The older payment table after two deliveries, of which the second holds the first."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    rows = _landed(t, _entry_rows(t), "entry-rows")
    for label, entries in (("day 1", rows.filter(F.to_date("`OpenDate.Typed`") < F.lit(STORED_BEFORE))), ("day 2", rows)):
        load(warehouse, None, None, None, F.lit(None), label, entries, named("Department"))
    return warehouse.read("paymentEntry").select(*schemas.PAYMENT_ENTRY.names)


@query("first_load")
def first_load(t: Tables) -> DataFrame:
    """The headers in a raw table that was not there before."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    load(warehouse, report_rows(t.raw_header(), schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum")), None, None, F.col("StoreId"), "first")
    return warehouse.read("rawHeader").select(*schemas.RAW_HEADER.names)


@query("marks_by_load")
def marks_by_load(t: Tables) -> DataFrame:
    """High-water marks folded from those that two loads left."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    headers = report_rows(_landed(t, t.raw_header(), "header"), schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum"))
    for label, rows in (("day 1", headers.filter(F.to_date("`OpenDate.Typed`") < F.lit(STORED_BEFORE))), ("day 2", headers)):
        load(warehouse, rows, None, None, F.col("StoreId"), label)
    return store_marks(warehouse)


@query("load_history")
def load_history(t: Tables) -> DataFrame:
    """Rows that each delivery brought to the raw tables, from the ledger."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    for label, delivery in zip(("day 1", "day 2"), _deliveries(t)):
        load(warehouse, *delivery, F.col("StoreId"), label)
    return warehouse.history().filter(F.col("table").startswith("raw")).select("label", "table", "rows")


@query("open_payment_orders")
def open_payment_orders(t: Tables) -> DataFrame:
    """Orders whose payments wait for their header after the first day."""
    return open_orders(_daily_job(t, "day 1"), "payment").select("uniqueOrderId")


@query("unmapped_waiting")
def unmapped_waiting(t: Tables) -> DataFrame:
    """Orders that wait for a mapping after the second day."""
    return unmapped(_daily_job(t, "day 1", "day 2")).select("uniqueOrderId", "lacks", "run")


# Reports


def _stored_names(df: DataFrame, *tables) -> DataFrame:
    names = {field: name for table in tables for field, name, _ in table}
    plain_names = {c: names.get(c, c.replace(".", "_")) for c in df.columns}
    return df.withColumnsRenamed(plain_names)


@query("report_header")
def report_header(t: Tables) -> DataFrame:
    return _stored_names(olap_report(t.report_lines(), report_specs.HEADER), schemas.HEADER_FIELDS)


@query("report_header_template")
def report_header_template(t: Tables) -> DataFrame:
    return _stored_names(olap_report(t.report_lines(), report_specs.HEADER_TEMPLATE), schemas.HEADER_FIELDS)


def _pending(t: Tables, flag: str):
    """The pending orders as report filters: their window and their ids."""
    header = t.raw_header()
    span = pending_window(header, flag).first()
    ids = ValueList("UniqOrderId.Id", not_done(header, flag).select("uniqueOrderId"), hot=t.hot_orders())
    if span is None:  # nothing is pending, so no id is either
        return (ids,)
    return DateRange("OpenDate.Typed", *(date.fromisoformat(text[:10]) for text in span)), ids


@query("report_payment")
def report_payment(t: Tables) -> DataFrame:
    spec = report_specs.PAYMENT.filtered(*_pending(t, "fetchPayment"))
    return _stored_names(olap_report(t.report_lines(), spec), schemas.PAYMENT_FIELDS)


@query("report_sales")
def report_sales(t: Tables) -> DataFrame:
    spec = report_specs.SALES.filtered(*_pending(t, "fetchSales"))
    return _stored_names(olap_report(t.report_lines(), spec), schemas.SALES_FIELDS)


@query("report_sales_template")
def report_sales_template(t: Tables) -> DataFrame:
    return _stored_names(olap_report(t.report_lines(), report_specs.SALES_TEMPLATE), schemas.SALES_FIELDS)


@query("report_payment_brands")
def report_payment_brands(t: Tables) -> DataFrame:
    """The payment request of the template, for some brands."""
    spec = report_specs.PAYMENT.filtered(ValueList("Conception", ("FURNITURE", "BUILDING")))
    return _stored_names(olap_report(t.report_lines(), spec), schemas.PAYMENT_FIELDS)


@query("report_payment_v2")
def report_payment_v2(t: Tables) -> DataFrame:
    spec = report_specs.OLDER_PAYMENT.filtered(
        ValueList("Conception", ("FURNITURE", "MACHINERY")))
    return _stored_names(olap_report(t.report_lines(), spec))


@query("report_sales_v2")
def report_sales_v2(t: Tables) -> DataFrame:
    spec = report_specs.OLDER_SALES.filtered(
        ValueList("Conception", ("FURNITURE",)))
    return _stored_names(olap_report(t.report_lines(), spec))


@query("report_sales_fixed")
def report_sales_fixed(t: Tables) -> DataFrame:
    spec = report_specs.NAMED_SALES.filtered(
        DateRange("OpenDate.Typed", date(1998, 6, 20), date(1998, 7, 20), include_right=False))
    return _stored_names(olap_report(t.report_lines(), spec))


DAILY = ReportSpec(
    ("Department", "OpenDate.Typed"),
    ("DishSumInt", "DishDiscountSumInt", "GuestNum", "DishDiscountSumInt.averageByGuest", "DishAmountInt"))


@query("report_daily_guests")
def report_daily_guests(t: Tables) -> DataFrame:
    """A report without the order id: guests are counted once per order."""
    return _stored_names(olap_report(t.report_lines(), DAILY))


@query("report_filter_ids")
def report_filter_ids(t: Tables) -> DataFrame:
    ids = not_done(t.raw_header(), "fetchSales").select("uniqueOrderId")
    return _stored_names(olap_report(t.report_lines(), DAILY.filtered(ValueList("UniqOrderId.Id", ids, hot=t.hot_orders()))))


@query("report_filter_ids_excluded")
def report_filter_ids_excluded(t: Tables) -> DataFrame:
    ids = not_done(t.raw_header(), "fetchSales").select("uniqueOrderId")
    spec = DAILY.filtered(ValueList("UniqOrderId.Id", ids, inclusive=False, hot=t.hot_orders()))
    return _stored_names(olap_report(t.report_lines(), spec))


@query("report_filter_brand")
def report_filter_brand(t: Tables) -> DataFrame:
    spec = DAILY.filtered(ValueList("Conception", ("FURNITURE", "BUILDING"), inclusive=False))
    return _stored_names(olap_report(t.report_lines(), spec))


@query("report_filter_dates")
def report_filter_dates(t: Tables) -> DataFrame:
    spec = DAILY.filtered(
        DateRange("OpenDate.Typed", date(1996, 1, 1), date(2000, 1, 1), include_left=False, include_right=False))
    return _stored_names(olap_report(t.report_lines(), spec))


@query("report_with_void")
def report_with_void(t: Tables) -> DataFrame:
    spec = ReportSpec(DAILY.group_fields, DAILY.data_fields, include_void=True, include_non_business=False)
    return _stored_names(olap_report(t.report_lines(), spec))


DAYS_REPORTED = DateRange("OpenDate.Typed", date(1996, 2, 10), date(1998, 3, 20))


@query("report_over_states")
def report_of_states(t: Tables) -> DataFrame:
    """Sales per store over a range of days, from states that were stored by day."""
    path = scratch_path(t.spark, "states")
    store_states(report_states(t.report_lines(), DAILY), path, "OpenDate.Typed")
    spec = ReportSpec(("Department",), DAILY.data_fields, (DAYS_REPORTED,))
    return _stored_names(report_over_states(stored_states(t.spark, path, DAYS_REPORTED.first, DAYS_REPORTED.last), spec))


# Windows and progress


@query("pending_payment_window")
def pending_payment_window(t: Tables) -> DataFrame:
    return pending_window(t.raw_header(), "fetchPayment")


@query("pending_sales_window")
def pending_sales_window(t: Tables) -> DataFrame:
    return pending_window(t.raw_header(), "fetchSales")


@query("store_high_water_mark")
def store_high_water_mark(t: Tables) -> DataFrame:
    return high_water_marks(t.raw_header())


@query("backfill_windows")
def windows_to_load(t: Tables) -> DataFrame:
    return backfill_windows(high_water_marks(stored(t.raw_header())), RUN_DATE, MAX_DAYS)


@query("previous_day_orders")
def previous_day_orders(t: Tables) -> DataFrame:
    return previous_day(t.raw_header(), "accountingDay", date(1998, 10, 4)).select("uniqueOrderId", "store", "accountingDay")


@query("custom_date_orders")
def custom_date_orders(t: Tables) -> DataFrame:
    rows = custom_dates(t.raw_header(), "accountingDay", date(1996, 1, 1), date(1999, 12, 31))
    return rows.select("uniqueOrderId", "store", "accountingDay")


@query("mark_payment_fetched")
def mark_payment_fetched(t: Tables) -> DataFrame:
    header = t.raw_header().select("uniqueOrderId", "accountingDay", "fetchPayment")
    requested = not_done(header, "fetchPayment")
    loaded = stored_rows(t.raw_payment().select("uniqueOrderId"), requested, "uniqueOrderId")
    return mark_fetched(header, requested, loaded, "fetchPayment")


@query("mark_payment_returned")
def mark_payment_returned(t: Tables) -> DataFrame:
    header = t.raw_header().select("uniqueOrderId", "accountingDay", "fetchPayment")
    loaded = stored_rows(t.raw_payment().select("uniqueOrderId"), not_done(header, "fetchPayment"), "uniqueOrderId")
    return mark_fetched(header, header, loaded, "fetchPayment", scope="returned")


@query("mark_sales_fetched")
def mark_sales_fetched(t: Tables) -> DataFrame:
    header = t.raw_header().select("uniqueOrderId", "accountingDay", "fetchSales")
    requested = not_done(header, "fetchSales")
    loaded = stored_rows(t.raw_sales().select("uniqueOrderId"), requested, "uniqueOrderId", t.hot_orders())
    return mark_fetched(header, requested, loaded, "fetchSales")


@query("mark_header_transformed")
def mark_header_transformed(t: Tables) -> DataFrame:
    raw = t.raw_header()
    done = transform_header(raw, t.mappings())
    return mark_done(raw.select("uniqueOrderId", "accountingDay", "transformFlag"), done, "uniqueOrderId", "transformFlag")


@query("mark_payment_transformed")
def mark_payment_transformed(t: Tables) -> DataFrame:
    mappings = t.mappings()
    header = _partly_done(transform_header(t.raw_header(), mappings, full_refresh=True), "paymentTransformed")
    header = _landed(t, header.select("uniqueOrderId", "storeNo", "region", "receiptNo", "RefinedOrderSource", "paymentTransformed"), "enriched")
    done = transform_payment(t.raw_payment(), header, mappings)
    return mark_done(header, done, "uniqueOrderId", "paymentTransformed")


@query("mark_sales_transformed")
def mark_sales_transformed(t: Tables) -> DataFrame:
    mappings = t.mappings()
    header = _partly_done(transform_header(t.raw_header(), mappings, full_refresh=True), "salesTransformed")
    header = _landed(t, header.select("uniqueOrderId", "storeNo", "brand", "region", "salesTransformed"), "enriched")
    done = transform_sales(t.raw_sales(), header, mappings, t.hot_orders())
    return mark_done(header, done, "uniqueOrderId", "salesTransformed")


@query("flags_as_rows")
def flags_as_rows(t: Tables) -> DataFrame:
    """Stored headers whose flags were set by rows: payments that came back, then all sales that were asked for."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    load(warehouse, report_rows(t.raw_header(), schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum")), None, None, F.col("StoreId"), "first")
    cards = t.raw_payment().filter(F.col("paymentType") == "Card")
    for label in ("day 1", "day 2"):  # the second brings nothing new
        set_returned(warehouse, "fetchPayment", flagged_headers(warehouse), cards, label, scope="returned")
    asked = flagged_headers(warehouse).filter(F.col("accountingDay") < F.lit(STORED_BEFORE))
    set_returned(warehouse, "fetchSales", asked, t.raw_sales(), "day 2")
    fold_flags(warehouse, "fold")
    return flagged_headers(warehouse).select("uniqueOrderId", "accountingDay", "transformFlag", "fetchSales", "fetchPayment")


# Dimensions, stored tables, sinks and metrics


@query("store_existing_header")
def store_existing_header(t: Tables) -> DataFrame:
    return query_table(
        t.spark, t.raw_header(),
        "SELECT uniqueOrderId, storeID, accountingDay, GrossSalesBD FROM {table} "
        "WHERE storeID = :store AND NOT transformFlag", store="7")


@query("store_orders")
def store_orders(t: Tables) -> DataFrame:
    """Orders of the stores of a store master, which is written as CSV and read."""
    path = scratch_path(t.spark, "stores")
    t.store_master().select(*schemas.STORE_MASTER_CONCEPTS.names).write.option("header", True).csv(path)
    stores = read_store_master(t.spark, path, schemas.STORE_MASTER_CONCEPTS).filter(F.col("Concept") != "MACHINERY")
    listed = stores.select(F.col("StoreId").alias("storeID"), F.col("Concept").alias("conception"))
    orders = t.raw_header().select("uniqueOrderId", "storeID", "conception", "accountingDay")
    return stored_rows(orders, listed, ["storeID", "conception"])


@query("currency_dimension")
def currency_dimension(t: Tables) -> DataFrame:
    headings = {name: heading for heading, name, _ in schemas.CURRENCY_FIELDS}
    path = scratch_path(t.spark, "currency")
    t.currency_rates().withColumnsRenamed(headings).write.option("header", True).csv(path)
    return load_currency(read_currency_sheet(t.spark, path))


@query("load_metrics")
def header_load_metrics(t: Tables) -> DataFrame:
    raw = t.raw_header()
    landed = stored(raw)
    rows = report_rows(raw, schemas.HEADER_FIELDS).withColumn("StoreId", F.col("TableNum"))
    batch = shape_header(rows, F.col("StoreId"))
    # Counted while they are written; what is not new of the batch was stored.
    batch, all_rows = counted(batch, "batch")
    landed_batch = _landed(t, batch, "batch")
    new, new_rows = counted(load_header(landed_batch.withColumnsRenamed({n: f for f, n, _ in schemas.HEADER_FIELDS}), landed, F.col("storeID")), "new")
    _landed(t, new, "new")
    total, fresh = all_rows.get["rows"], new_rows.get["rows"]
    width = len(schemas.RAW_HEADER.names)
    return t.spark.createDataFrame([("batch", total, width), ("duplicates", total - fresh, width), ("new", fresh, width)], "step string, rows long, columns long")


@query("load_misfits")
def header_load_misfits(t: Tables) -> DataFrame:
    """Values of a header report that do not fit their stored type, by field: an order priority is no number."""
    rows = report_rows(t.raw_header(), schemas.HEADER_FIELDS).withColumns({
        "GuestNum": F.when(F.col("OrderNum") % 3 == 0, "many").otherwise(F.col("GuestNum").cast("string")),
        "OpenDate.Typed": F.when(F.col("OrderNum") % 5 == 0, "soon").otherwise(named("OpenDate.Typed"))})
    return misfits(rows, schemas.HEADER_FIELDS).filter("rows > 0")


def _extract_roundtrip(t: Tables, form: str) -> DataFrame:
    entries = shape_payment_entry(_entry_rows(t), named("Department"))
    stores = t.store_master().withColumn("StoreId", F.col("StoreCode"))
    extracts = named_extracts(entries, stores, *WHOLE_SPAN)
    path = scratch_path(t.spark, f"extracts-{form}")
    write_extracts(extracts, path, form)
    if form == "csv":
        return read_text_rows(t.spark, path, extracts.schema)
    return t.spark.read.schema(extracts.schema).json(path)


@query("sink_roundtrip_csv")
def sink_roundtrip_csv(t: Tables) -> DataFrame:
    return _extract_roundtrip(t, "csv")


@query("sink_roundtrip_json")
def sink_roundtrip_json(t: Tables) -> DataFrame:
    return _extract_roundtrip(t, "json")


@query("sink_named_files")
def sink_named_files(t: Tables) -> DataFrame:
    """Extracts as CSV files under their names, read back with folder and file."""
    entries = shape_payment_entry(_entry_rows(t), named("Department"))
    stores = t.store_master().withColumn("StoreId", F.col("StoreCode"))
    path = scratch_path(t.spark, "extract-files")
    write_extract_files(named_extracts(entries, stores, *WHOLE_SPAN), path, "csv")
    back = read_extract_files(t.spark, path, entries.schema, "csv")
    return back.withColumn("File", F.regexp_replace("File", r"(_\d+)?\.csv$", ".csv"))


@query("sink_roundtrip_table")
def sink_roundtrip_table(t: Tables) -> DataFrame:
    """Two header batches appended to one stored table, read back with two columns of it."""
    raw = t.raw_header()
    path = scratch_path(t.spark, "raw-header")
    for batch in (stored(raw), raw.filter(F.col("accountingDay") >= F.lit(STORED_BEFORE))):
        append(batch, path, schemas.RAW_HEADER, ["storeID"])
    return read_table(t.spark, path, schemas.RAW_HEADER).select(*schemas.RAW_HEADER.names)


def _appended(t: Tables, batches, schema: T.StructType, name: str, partition_by=()) -> DataFrame:
    path = scratch_path(t.spark, name)
    for batch in batches:
        append(batch, path, schema, partition_by)
    return read_table(t.spark, path, schema).select(*schema.names)


@query("append_payment")
def append_payment(t: Tables) -> DataFrame:
    raw = t.raw_payment()
    return _appended(t, (stored(raw), load_payment(report_rows(raw, schemas.PAYMENT_FIELDS), stored(raw))), schemas.RAW_PAYMENT, "raw-payment")


@query("append_sales")
def append_sales(t: Tables) -> DataFrame:
    raw = t.raw_sales()
    return _appended(t, (stored(raw), load_sales(report_rows(raw, schemas.SALES_FIELDS), stored(raw), t.hot_orders())), schemas.RAW_SALES, "raw-sales")


@query("append_payment_entry")
def append_payment_entry(t: Tables) -> DataFrame:
    return _appended(t, (_entry_load(t).new,), schemas.PAYMENT_ENTRY, "payment-entry", ["storeID"])


@query("append_currency")
def append_currency(t: Tables) -> DataFrame:
    return _appended(t, (t.currency_rates(),), schemas.CURRENCY, "currency-table")


@query("snapshot_flags")
def snapshot_flags(t: Tables) -> DataFrame:
    """The header with its new flags, written as the next snapshot and read back."""
    header = t.raw_header().select("uniqueOrderId", "accountingDay", "fetchSales")
    path = scratch_path(t.spark, "snapshot")
    write_snapshot(mark_done(header, t.raw_sales().select("uniqueOrderId"), "uniqueOrderId", "fetchSales", t.hot_orders()), path)
    return read_table(t.spark, path, header.schema)


@query("sink_roundtrip_text")
def sink_roundtrip_text(t: Tables) -> DataFrame:
    """Text with padding, quotes, separators, backslashes and line breaks, through the CSV sink and back."""
    orders = t.read("orders")
    text = F.concat(F.lit("  "), "o_orderpriority", F.lit('\\\n "q", \\\r\n\\n'), "o_orderstatus", F.lit(" \t"))
    rows = orders.select("o_orderkey", text.alias("note"), F.lit("").alias("blank"))
    path = scratch_path(t.spark, "text")
    write_duplicates(rows, path)
    return read_text_rows(t.spark, path, rows.schema)


def _envelopes(t: Tables) -> tuple[DataFrame, T.StructType]:
    """Orders as report answers, one each: two rows at most, none for an order without lines."""
    paid = t.read("lineitem").groupBy("l_orderkey").agg(*[
        F.expr(f"sum(CASE WHEN l_linestatus = '{status}' THEN CAST(l_extendedprice AS DECIMAL(18,4)) END)").alias(status)
        for status in ("O", "F")])
    fields = schemas.PAYMENT_ENTRY_FIELDS
    row_type = schemas.report_rows(fields)
    orders = t.raw_header().join(paid, F.expr("receiptNo = l_orderkey"), "left")
    values = {
        "Conception": "conception", "CreditUser": "''", "Delivery.IsDelivery": "delivery",
        "Delivery.SourceKey": "deliverySource", "Department": "store", "ExternalNumber": "externalOrderNo",
        "OpenDate.Typed": "CAST(accountingDay AS STRING)", "OrderNum": "receiptNo", "OrderType": "orderType",
        "UniqOrderId.Id": "uniqueOrderId",
    }

    def row(status: str, pay_type: str):
        columns = {**values, "DishDiscountSumInt": f"CAST({status} AS DECIMAL(18,4))", "PayTypes": f"'{pay_type}'"}
        cells = F.struct(*[F.expr(columns[field]).alias(field) for field, _, _ in fields])
        return F.when(F.col(status).isNotNull(), cells)

    rows = F.array_compact(F.array(row("O", "Aggregator Payment"), row("F", "Card")))
    envelopes = orders.select("receiptNo", F.to_json(F.struct(
        (F.col("delivery") == "P").alias("error"), F.lit(False).alias("warning"),
        F.struct(rows.alias("rawData"), F.lit(0).alias("totalDaysInPeriod")).alias("result"),
    )).alias("value"))
    return envelopes, row_type


@query("envelope_scan")
def envelope_scan(t: Tables) -> DataFrame:
    envelopes, row_type = _envelopes(t)
    path = scratch_path(t.spark, "envelopes")
    envelopes.select("value").write.text(path)
    scanned = read_envelopes(t.spark, path, row_type, one_per_line=True)
    return scanned.select(*[named(field).alias(name) for field, name, _ in schemas.PAYMENT_ENTRY_FIELDS])


@query("envelope_rejects")
def envelope_rejects(t: Tables) -> DataFrame:
    """Answers that gave no rows, counted by reason: every seventh is cut off, every eleventh says nothing of an error."""
    envelopes, row_type = _envelopes(t)
    cut, mistaken = F.col("receiptNo") % 7 == 0, F.col("receiptNo") % 11 == 0
    damaged = F.when(cut, F.substring("value", 1, 40)).when(mistaken, F.replace("value", F.lit('"error"'), F.lit('"mistake"')))
    path = scratch_path(t.spark, "damaged")
    envelopes.select(damaged.otherwise(F.col("value")).alias("value")).write.text(path)
    rejects = scan_envelopes(t.spark, path, row_type, one_per_line=True).rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _documents(t: Tables) -> Answers:
    """One answer per store and year, as a file each, and what is read of them.

    Some are cut off, in error or without a result. In rows of good ones, some have a field that was not asked for, lack
    one, or hold a text where a number belongs.
    """
    fields = schemas.PAYMENT_ENTRY_FIELDS
    orders = t.raw_header()
    number = F.col("receiptNo")
    row = F.to_json(F.struct(
        F.col("conception").alias("Conception"), F.when(number % 5 != 0, F.lit("")).alias("CreditUser"),
        F.col("delivery").alias("Delivery.IsDelivery"), F.coalesce("deliverySource", F.lit("")).alias("Delivery.SourceKey"),
        F.col("store").alias("Department"), F.col("grossSalesAD").alias("DishDiscountSumInt"), F.col("externalOrderNo").alias("ExternalNumber"),
        F.col("accountingDay").cast("string").alias("OpenDate.Typed"), F.when(number % 7 == 0, "soon").otherwise(number.cast("string")).alias("OrderNum"),
        F.col("orderType").alias("OrderType"), F.lit("Card").alias("PayTypes"), F.col("uniqueOrderId").alias("UniqOrderId.Id"),
        F.when(number % 3 == 0, F.lit(True)).alias("Loyalty")))
    year = F.year("accountingDay")
    # A store's year is one document, as the service sends it.
    listed = orders.select("tableNo", year.alias("year"), row.alias("row")).groupBy("tableNo", "year").agg(F.concat_ws(",", F.collect_list("row")).alias("rows"))
    kind = (F.col("tableNo") + F.col("year")) % 11
    result = F.when(kind == 3, "").otherwise(F.concat(F.lit(', "result": {"rawData": ['), "rows", F.lit("]}")))
    text = F.concat(F.lit('{"error": '), F.when(kind == 2, "true").otherwise("false"), result, F.when(kind == 1, "").otherwise("}"))
    path = scratch_path(t.spark, "documents")
    listed.select("tableNo", "year", text.alias("value")).write.partitionBy("tableNo", "year").text(path)
    return read_answers(t.spark, path, fields)


@query("answer_documents")
def answer_documents(t: Tables) -> DataFrame:
    return stored_names(_documents(t).rows, schemas.PAYMENT_ENTRY_FIELDS)


@query("answer_rejects")
def answer_rejects(t: Tables) -> DataFrame:
    return _documents(t).rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("answer_drift")
def answer_drift(t: Tables) -> DataFrame:
    return _documents(t).drift
