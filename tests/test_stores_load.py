from datetime import date

from pyspark.sql import functions as F
from row_helpers import rows
from test_jobs import headers, payments, sales

from tallyhouse import schemas
from tallyhouse.plans.loads import StoresLoad, load_all_tables
from tallyhouse.sources.readers import empty


def loaded(spark, spans):
    """The loads of two stores over their spans; the store of a line or payment is that of its order."""
    head = headers(spark, ("o1", "S", "2022-06-20"), ("o2", "S", "2022-06-09"), ("o3", "T", "2022-06-20"))
    stores = spark.createDataFrame([("o1", "1"), ("o2", "1"), ("o3", "2")], "`UniqOrderId.Id` string, StoreId string")
    sold = sales(spark, ("o1", "tea", "2022-06-20"), ("o2", "tea", "2022-06-09"), ("o3", "tea", "2022-06-20"), ("o1", "cake", "soon"), ("o1", "pie", None))
    stored = StoresLoad(*(empty(spark, kind) for kind in (schemas.RAW_HEADER, schemas.RAW_PAYMENT, schemas.RAW_SALES)))
    spans = spark.createDataFrame(spans, "storeID string, _from date, _to date")
    store = F.col("StoreId")
    on = "UniqOrderId.Id"

    def placed(df):
        return df.join(stores, on)

    return load_all_tables(placed(head), placed(payments(spark, ("o1", "Card"), ("o3", "Card"))), placed(sold), stored, spans, store, store, store)


def test_days_of_no_span_go_before_rows_are_placed_in_stores(spark):
    load = loaded(spark, [("1", date(2022, 6, 10), date(2022, 6, 30)), ("2", date(2022, 6, 25), date(2022, 6, 26))])
    assert rows(load.sales.select("uniqueOrderId", "item")) == [("o1", "tea")]
    assert rows(load.payments.select("uid")) == [("o1-Card",)] and rows(load.headers.select("uniqueOrderId")) == [("o1",)]
    lines = load.sales._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joined = next(i for i, line in enumerate(lines) if "Join Inner, (UniqOrderId.Id" in line)
    assert any("Filter" in line and "2022-06-10" in line and "2022-06-30" in line for line in lines[joined:])


def test_no_span_brings_no_row(spark):
    assert [df.count() for df in loaded(spark, [])] == [0, 0, 0]
