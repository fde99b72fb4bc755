"""Column expressions shared by the loads and the enrichment. All of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.schemas import MONEY

# Fixed values.
CALL_CENTRE = "CloudCallCenter"
NOT_DELETED = "NOT_DELETED"
TEST_STORE = "Test Lab"
AGGREGATOR_PAYMENTS = ("Aggregator Payment", "Aggregator Payment old")
DISPLAY_DATE = "dd/MM/yyyy"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def named(field: str) -> Column:
    """A column whose name may hold dots."""
    return F.col("`" + field.replace("`", "``") + "`")


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row."""
    widths = [F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) + 8 for c in df.columns]
    return reduce(lambda a, b: a + b, widths, F.lit(16)).cast("bigint")


def as_date(value: Column) -> Column:
    """Date of a date, timestamp or ISO text; text that is no date gives null."""
    return value.try_cast("date")


def display_date(value: Column) -> Column:
    return F.date_format(as_date(value), DISPLAY_DATE)


def iso_time(day: Column) -> Column:
    return F.date_format(day, ISO_TIME)


def time_part(value: Column) -> Column:
    """Text after the last `T`; the whole text when there is none."""
    return F.substring_index(value, "T", -1)


def item_name(item: Column) -> Column:
    return F.trim(F.substring_index(item, "/", 1))


def row_key(order_id: Column, payment_type: Column) -> Column:
    """`order-payment`; null when either part is null."""
    return F.concat(order_id, F.lit("-"), payment_type)


def order_source(delivery_source: Column, order_type: Column) -> Column:
    """The delivery source, or the order type where the source is empty, null or the call centre."""
    usable = (delivery_source != "") & (delivery_source != CALL_CENTRE)
    return F.when(usable, delivery_source).otherwise(order_type)


def call_centre_mark(delivery_source: Column) -> Column:
    return F.when(delivery_source == CALL_CENTRE, "CC").otherwise("NO")


def credited_to(stored: Column, payment_type: Column, source: Column) -> Column:
    """Aggregator payments with an empty value are credited to the order source; null stays null."""
    derived = F.when(payment_type.isin(*AGGREGATOR_PAYMENTS), source).otherwise("")
    return F.when(stored == "", derived).otherwise(stored)


def base_currency(amounts: dict[str, str], factor: Column) -> dict[str, Column]:
    """Output name -> amount in base currency, for `{output name: amount column}`."""
    return {out: (F.col(amount) * factor).cast(MONEY) for out, amount in amounts.items()}


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null text becomes empty text. Numbers, dates and flags keep their nulls."""
    return df.fillna("")
