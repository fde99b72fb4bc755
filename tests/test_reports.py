import contextlib
import io
import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from row_helpers import rows

from tallyhouse.operators.reports import (
    DateRange, ReportSpec, ValueList, olap_report, report_over_states, report_states, store_states, stored_states)
from tallyhouse.plans import report_specs

SCHEMA = ("`UniqOrderId.Id` string, Department string, `OpenDate.Typed` string, Conception string, DishSumInt decimal(18,4), "
          "DishDiscountSumInt decimal(18,4), `VAT.Sum` decimal(18,4), DishAmountInt decimal(18,4), GuestNum bigint, "
          "`Cooking.ServeTime` double, IsVoid boolean, IsNonBusinessPayment boolean")


@pytest.fixture(scope="module")
def lines(spark):
    d = Decimal
    return spark.createDataFrame([
        ("1", "s", "2022-06-20", "A", d(10), d(8), d(1), d(2), 3, 4.0, False, False),
        ("1", "s", "2022-06-20", "A", d(20), d(20), d(2), d(1), 3, 8.0, None, True),
        ("2", "s", "2022-06-21", "B", d(5), d(5), d(0), d(0), 2, None, False, False),
        ("3", "t", "2022-06-22", None, d(7), d(7), d(1), d(1), None, 1.0, True, False),
    ], SCHEMA)


def test_guests_are_counted_once_per_order(lines):
    fields = ("DishSumInt", "GuestNum", "DishDiscountSumInt.averageByGuest", "Cooking.ServeTime.Avg", "DishDiscountSumInt.withoutVAT")
    by_store = ReportSpec(("Department",), fields, include_void=True)
    assert rows(olap_report(lines, by_store)) == [
        ("s", Decimal("35.0000"), 5, 6.6, 6.0, Decimal("30.0000")), ("t", Decimal("7.0000"), None, None, 1.0, Decimal("6.0000"))]
    by_order = ReportSpec(("UniqOrderId.Id",), ("GuestNum", "DishDiscountSumInt.averageByGuest"))
    assert rows(olap_report(lines, by_order)) == [("1", 3, 28 / 3), ("2", 2, 2.5)]


def test_average_price_without_units_is_null(lines):
    spec = ReportSpec(("UniqOrderId.Id",), ("DishSumInt.averagePriceWithVAT",))
    assert rows(olap_report(lines, spec)) == [("1", 10.0), ("2", None)]


def orders(lines, *filters, **switches):
    spec = ReportSpec(("UniqOrderId.Id",), ("DishSumInt",), filters, **switches)
    return [r[0] for r in rows(olap_report(lines, spec))]


def test_date_range_ends(lines):
    first, last = date(2022, 6, 20), date(2022, 6, 22)

    def got(**ends):
        return orders(lines, DateRange("OpenDate.Typed", first, last, **ends), include_void=True)

    assert got() == ["1", "2", "3"]
    assert got(include_right=False) == ["1", "2"]
    assert got(include_left=False) == ["2", "3"]
    assert orders(lines, DateRange("OpenDate.Typed", first, first, include_right=False)) == ["1"]


@pytest.mark.parametrize("as_join", [False, True])
def test_value_list(spark, lines, as_join):
    values = spark.createDataFrame([("A",), ("A",), ("Z",)], "v string") if as_join else ["A", "Z"]
    assert orders(lines, ValueList("Conception", values), include_void=True) == ["1"]
    assert orders(lines, ValueList("Conception", values, inclusive=False), include_void=True) == ["2", "3"]


def test_row_class_switches(lines):
    assert orders(lines) == ["1", "2"]
    assert orders(lines, include_void=True) == ["1", "2", "3"]
    spec = ReportSpec(("UniqOrderId.Id",), ("DishSumInt",), include_non_business=False)
    assert rows(olap_report(lines, spec)) == [("1", Decimal("10.0000")), ("2", Decimal("5.0000"))]


def test_request_in_service_form(lines):
    request = {
        "olapType": "SALES", "categoryFields": [], "groupFields": ["UniqOrderId.Id"], "stackByDataFields": False,
        "dataFields": ["DishSumInt"], "calculatedFields": [],
        "filters": [
            {"field": "OpenDate.Typed", "filterType": "date_range", "dateFrom": "2022-06-20T00:00:00",
             "dateTo": "2022-06-21T00:00:00", "valueMin": None, "valueMax": None, "valueList": [], "includeLeft": True,
             "includeRight": False, "inclusiveList": True},
            {"field": "UniqOrderId.Id", "filterType": "value_list", "valueList": ["1", "2"], "inclusiveList": True}],
        "includeVoidTransactions": False, "includeNonBusinessPaymentTypes": True}
    spec = ReportSpec.from_request(json.dumps(request))
    assert [r[0] for r in rows(olap_report(lines, spec))] == ["1"]
    request["filters"][0]["filterType"] = "other"
    with pytest.raises(ValueError):
        ReportSpec.from_request(json.dumps(request))


def test_report_sizes():
    sizes = {name: (len(spec.group_fields), len(spec.data_fields)) for name, spec in vars(report_specs).items()
             if isinstance(spec, ReportSpec)}
    assert sizes == {
        "HEADER": (30, 21), "PAYMENT": (16, 4), "SALES": (28, 18), "HEADER_TEMPLATE": (30, 12), "SALES_TEMPLATE": (28, 14),
        "OLDER_PAYMENT": (11, 1), "OLDER_SALES": (10, 6), "NAMED_SALES": (11, 5)}


def test_last_print_time_comes_back_as_it_was_sent(spark):
    lines = spark.createDataFrame([
        ("time only", "12:30:00"), ("time only", "09:00:00"), ("fraction", "2022-06-20T10:00:00.500"), ("fraction", "2022-06-20T10:00:00.4999"),
        ("offset", "2022-06-20T10:00:00+04:00"), ("offset", "2022-06-20T07:00:00Z"), ("odd", "late"), ("odd", None), ("none", None)],
        "Department string, DishServicePrintTime string")
    spec = ReportSpec(("Department",), ("DishServicePrintTime.Max",))
    assert rows(olap_report(lines, spec)) == [
        ("fraction", "2022-06-20T10:00:00.500"), ("none", None), ("odd", "late"), ("offset", "2022-06-20T07:00:00Z"), ("time only", "12:30:00")]


@pytest.mark.parametrize("change", [{"calculatedFields": ["x"]}, {"stackByDataFields": True},
                                    {"filters": [{"field": "a", "filterType": "value_list", "valueList": [], "valueMin": 1}]},
                                    {"filters": [{"field": "a", "filterType": "date_range", "dateFrom": "2022-06-20T10:00:00", "dateTo": "2022-06-21T00:00:00"}]}])
def test_requests_that_cannot_be_honoured_are_refused(change):
    with pytest.raises(ValueError):
        ReportSpec.from_request(json.dumps({"groupFields": ["a"], "dataFields": ["DishSumInt"], **change}))


def test_reports_over_states_equal_those_over_lines(spark, lines, tmp_path):
    times = lines.withColumn("DishServicePrintTime", F.concat("`OpenDate.Typed`", F.lit("T10:0"), "GuestNum", F.lit(":00")))
    fields = ("DishSumInt", "GuestNum", "DishDiscountSumInt.averageByGuest", "Cooking.ServeTime.Avg", "DishServicePrintTime.Max",
              "DishSumInt.averagePriceWithVAT")
    by_day = ReportSpec(("Department", "Conception", "OpenDate.Typed"), fields)
    path = str(tmp_path / "states")
    store_states(report_states(times, by_day), path, "OpenDate.Typed")
    late = times.withColumn("OpenDate.Typed", F.lit("2022-07-01"))
    store_states(report_states(late, by_day), path, "OpenDate.Typed")
    twice = late.withColumn("DishSumInt", F.col("DishSumInt") * 2)
    store_states(report_states(twice, by_day), path, "OpenDate.Typed")  # July again; June stays
    all_lines = times.unionByName(twice.withColumn("DishSumInt", F.col("DishSumInt").cast("decimal(18,4)")))
    june = DateRange("OpenDate.Typed", date(2022, 6, 20), date(2022, 6, 21))
    for groups in (("Department", "Conception", "OpenDate.Typed"), ("Conception", "OpenDate.Typed"), ("OpenDate.Typed",)):
        spec = ReportSpec(groups, fields)
        assert rows(report_over_states(stored_states(spark, path), spec)) == rows(olap_report(all_lines, spec))
    for groups in (("Department",), ("Conception",)):
        spec = ReportSpec(groups, fields, (june,))
        assert rows(report_over_states(stored_states(spark, path, june.first, june.last), spec)) == rows(olap_report(times, spec))
    # A range reads the files of its months only.
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        stored_states(spark, path, june.first, june.last).explain()
    assert "PartitionFilters: [isnotnull(_month" in out.getvalue()
