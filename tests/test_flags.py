import contextlib
import io

import pytest
from pyspark.sql import functions as F
from row_helpers import rows
from test_jobs import DAY, delivery, headers

from tallyhouse.plans.flags import flagged_headers, fold_flags, set_flag, set_returned
from tallyhouse.plans.jobs import Warehouse, load


def flags(warehouse):
    return rows(flagged_headers(warehouse).select("uniqueOrderId", "transformFlag", "fetchSales", "fetchPayment"))


def orders(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "uniqueOrderId string")


def test_flags_are_rows_beside_the_headers(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, headers(spark, *((f"o{k}", "S", DAY) for k in range(5))), None, None, F.lit("9"), "a")
    assert flags(warehouse) == [(f"o{k}", False, False, False) for k in range(5)]
    set_flag(warehouse, "fetchSales", orders(spark, "o1", "o1", "o3", None, "unknown"), "b")
    set_flag(warehouse, "fetchSales", orders(spark, "o1", "o3", "o4"), "c")
    set_flag(warehouse, "transformFlag", orders(spark, "o1"), "c")
    expected = [(f"o{k}", k == 1, k in (1, 3, 4), False) for k in range(5)]
    assert flags(warehouse) == expected
    # A mark writes its own rows and no others.
    assert rows(warehouse.history().filter("table = 'headerFlags'").select("label", "rows")) == [("b", 3), ("c", 1), ("c", 1)]
    assert len(warehouse.of_table("rawHeader")) == 1
    fold_flags(warehouse, "fold")
    for folded in (warehouse, Warehouse(spark, str(tmp_path))):
        assert len(folded.of_table("headerFlags")) == 1 and flags(folded) == expected
    set_flag(warehouse, "fetchPayment", orders(spark, "o0"), "d")
    assert flags(warehouse)[0] == ("o0", False, False, True) and flags(warehouse)[1:] == expected[1:]
    fold_flags(warehouse, "fold again")
    assert flags(warehouse)[0] == ("o0", False, False, True)
    with pytest.raises(ValueError):
        set_flag(warehouse, "storeID", orders(spark, "o1"), "e")
    with pytest.raises(ValueError):
        warehouse.fold("x", "rawHeader")


def test_a_fetch_flags_what_was_requested_or_returned(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, *delivery(spark, "o1", "o2"), F.lit("9"), "a")
    nothing = orders(spark).select("uniqueOrderId")
    set_returned(warehouse, "fetchPayment", orders(spark, "o1", "o2"), nothing, "b")
    assert [r[3] for r in flags(warehouse)] == [False, False]
    set_returned(warehouse, "fetchPayment", orders(spark, "o1", "o2"), orders(spark, "o2"), "b", scope="returned")
    assert [r[3] for r in flags(warehouse)] == [False, True]
    set_returned(warehouse, "fetchPayment", orders(spark, "o1", "o2"), orders(spark, "o2"), "b")
    assert [r[3] for r in flags(warehouse)] == [True, True]
    with pytest.raises(ValueError):
        set_returned(warehouse, "fetchPayment", nothing, nothing, "b", scope="some")


def test_headers_and_flags_stay_in_their_buckets(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=3)
    load(warehouse, headers(spark, ("o1", "S", DAY)), None, None, F.lit("9"), "a")
    set_flag(warehouse, "fetchSales", orders(spark, "o1"), "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            flagged_headers(warehouse).explain()
        assert "Exchange" not in out.getvalue() and out.getvalue().count("Bucketed: true") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
