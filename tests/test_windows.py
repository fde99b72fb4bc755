from datetime import date

import pytest
from pyspark.sql import functions as F
from row_helpers import rows

from tallyhouse.operators.windows import (
    backfill_windows, custom_dates, high_water_marks, pending_window, previous_day, rows_to_backfill)

RUN = date(2022, 9, 20)


def stepwise(mark, run, days):
    """The windows of one store by day counting, the long way."""
    gap = (run - mark).days
    if gap <= 0:
        return []
    if gap <= days:
        return [(mark, run)]
    found, first = [], date.fromordinal(mark.toordinal() + 1)
    while first <= run:
        last = min(date.fromordinal(first.toordinal() + days - 1), run)
        found.append((first, last))
        first = date.fromordinal(last.toordinal() + 1)
    return found


@pytest.mark.parametrize("gap", [-2, 0, 1, 4, 5, 6, 10, 11, 37])
def test_backfill_windows(spark, gap):
    mark = date.fromordinal(RUN.toordinal() - gap)
    marks = spark.createDataFrame([("1", mark)], "storeID string, maxDate date")
    got = backfill_windows(marks, RUN, 5).select("dateFrom", "dateTo").collect()
    assert sorted(map(tuple, got)) == stepwise(mark, RUN, 5)


def test_store_without_a_mark_needs_a_start_date(spark):
    marks = spark.createDataFrame([("1", None)], "storeID string, maxDate date")
    assert rows(backfill_windows(marks, RUN, 5)) == []
    got = rows(backfill_windows(marks, RUN, 5, start_date=date(2022, 9, 10)).select("dateFrom", "dateTo"))
    assert got == [(date(2022, 9, 10), date(2022, 9, 14)), (date(2022, 9, 15), date(2022, 9, 19)), (RUN, RUN)]


def test_rows_to_backfill_reads_the_mark_day_again_only_on_a_small_gap(spark):
    marks = spark.createDataFrame([("far", date(2022, 9, 1)), ("near", date(2022, 9, 18))], "storeID string, maxDate date")
    days = [date(2022, 9, d) for d in (1, 2, 17, 18, 20, 21)]
    data = spark.createDataFrame([(s, d) for s in ("far", "near", "other") for d in days], "storeID string, accountingDay date")
    got = rows(rows_to_backfill(data, marks, RUN, 5))
    assert got == [("far", d) for d in days[1:5]] + [("near", d) for d in days[3:5]]


def test_pending_window(spark):
    header = spark.createDataFrame(
        [("2022-01-03", False), ("2022-01-01", False), ("2021-01-01", True), ("bad", False)], "accountingDay string, done boolean")
    assert rows(pending_window(header, "done")) == [("2022-01-01T00:00:00", "2022-01-03T00:00:00")]
    assert rows(pending_window(header.filter("done"), "done")) == []


def test_marks_and_date_filters(spark):
    header = spark.createDataFrame([("1", "2022-01-03"), ("1", "2022-01-05"), ("2", "2021-12-31")], "storeID string, accountingDay string")
    typed = header.withColumn("accountingDay", F.to_date("accountingDay"))
    assert rows(high_water_marks(header)) == [("1", date(2022, 1, 5)), ("2", date(2021, 12, 31))]
    assert rows(previous_day(typed, "accountingDay", date(2022, 1, 4))) == [("1", date(2022, 1, 3))]
    assert len(rows(custom_dates(header, "accountingDay", date(2021, 12, 31), date(2022, 1, 3)))) == 2
