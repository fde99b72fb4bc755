"""Business-date windows: what is pending, how far each store got, and which spans to ask for next."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import as_date, iso_time, named
from tallyhouse.operators.joins import join_dimension, small_sides
from tallyhouse.operators.progress import not_done


def pending_window(header: DataFrame, flag: str, day: str = "accountingDay") -> DataFrame:
    """First and last business date of the orders still open, as ISO text. No row when nothing is open."""
    span = not_done(header, flag).agg(F.min(as_date(F.col(day))).alias("first"), F.max(as_date(F.col(day))).alias("last"))
    return span.filter(F.col("first").isNotNull()).select(
        iso_time(F.col("first")).alias("dateFrom"), iso_time(F.col("last")).alias("dateTo"))


def high_water_marks(header: DataFrame, store: str = "storeID", day: str = "accountingDay") -> DataFrame:
    """Last stored business date of every store, in one pass."""
    return header.groupBy(store).agg(F.max(as_date(F.col(day))).alias("maxDate"))


def backfill_windows(marks: DataFrame, run_date: date, max_days: int, start_date: date | None = None,
                     store: str = "storeID") -> DataFrame:
    """Spans to load per store, from its mark to `run_date`.

    A gap above `max_days` is cut into `max_days` steps that begin the day after the mark. A smaller gap is one span
    that begins on the mark itself, so that day is read again. No gap, no span. A store without a mark begins on
    `start_date`, or is left out when none is given.
    """
    today = F.lit(run_date).cast("date")
    mark = F.coalesce(F.col("maxDate"), F.date_sub(F.lit(start_date).cast("date"), 1))
    gap = F.col("gap")
    stepped = gap > max_days
    offsets = F.when(stepped, F.sequence(F.lit(1), gap, F.lit(max_days))).otherwise(F.array(F.lit(0)))
    starts = (marks.select(store, mark.alias("mark"))
              .withColumn("gap", F.date_diff(today, F.col("mark")))
              .filter(gap > 0)
              .select(store, "mark", "gap", F.explode(offsets).alias("offset")))
    return starts.select(
        store,
        F.date_add("mark", F.col("offset")).alias("dateFrom"),
        F.when(stepped, F.least(F.date_add("mark", F.col("offset") + (max_days - 1)), today)).otherwise(today).alias("dateTo"))


def backfill_spans(marks: DataFrame, run_date: date, max_days: int, start_date: date | None = None, store: str = "storeID") -> DataFrame:
    """First and last day to load per store, `_from` and `_to`: its windows touch, so together they are one span."""
    return backfill_windows(marks, run_date, max_days, start_date, store).groupBy(store).agg(
        F.min("dateFrom").alias("_from"), F.max("dateTo").alias("_to"))


def rows_inside(rows: DataFrame, spans: DataFrame, small: bool, store: str = "storeID", day: str = "accountingDay") -> DataFrame:
    """Rows inside the span of their store. `small` says the spans were measured and fit a broadcast."""
    joined = join_dimension(rows, spans, [store], "inner", small)
    return joined.filter(as_date(F.col(day)).between(F.col("_from"), F.col("_to"))).select(*[named(c) for c in rows.columns])


def rows_to_backfill(rows: DataFrame, marks: DataFrame, run_date: date, max_days: int, start_date: date | None = None,
                     store: str = "storeID", day: str = "accountingDay") -> DataFrame:
    """Rows inside the backfill windows of their store; one span per store is joined, never one per window."""
    spans = backfill_spans(marks, run_date, max_days, start_date, store)
    return rows_inside(rows, spans, "spans" in small_sides({"spans": spans}), store, day)


def previous_day(df: DataFrame, day: str, run_date: date) -> DataFrame:
    """Rows of the day before `run_date`."""
    return df.filter(as_date(F.col(day)) == F.date_sub(F.lit(run_date).cast("date"), 1))


def custom_dates(df: DataFrame, day: str, first: date, last: date) -> DataFrame:
    """Rows from `first` to `last`, both included."""
    return df.filter((as_date(F.col(day)) >= F.lit(first)) & (as_date(F.col(day)) <= F.lit(last)))
