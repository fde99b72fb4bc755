from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from row_helpers import rows

from tallyhouse import schemas
from tallyhouse.plans.transforms import Mappings, transform_header, transform_payment, transform_sales, unmapped_headers


def table(spark, schema, *answers):
    return spark.createDataFrame([tuple(a.get(n) for n in schema.names) for a in answers], schema)


ORDER = {
    "store": "S", "conception": "A", "accountingDay": date(2022, 6, 20), "receiptNo": 1, "orderDeleted": "NOT_DELETED",
    "delivery": "YES", "deliverySource": "", "orderType": "Dine", "openingTime": "2022-06-20T10:15:00",
    "GrossSalesBD": Decimal(10), "grossSalesAD": Decimal(8), "VATByBillAmount": Decimal(1), "transformFlag": False,
}
CASES = {
    "plain": {}, "deleted": {"orderDeleted": "DELETED"}, "trial": {"store": "Test Lab"}, "no store": {"store": "X"},
    "no delivery": {"delivery": "MAYBE"}, "no factor": {"conception": "NF"}, "done": {"transformFlag": True},
    "null source": {"deliverySource": None}, "call centre": {"deliverySource": "CloudCallCenter"},
    "mapped": {"deliverySource": "W"}, "unmapped": {"deliverySource": "Q"},
}


@pytest.fixture(scope="module")
def raw(spark):
    orders = [{**ORDER, **case, "uniqueOrderId": name} for name, case in CASES.items()]
    return table(spark, schemas.RAW_HEADER, *orders).withColumn("pk_rawHeader", F.lit(7))


def mapping_tables(spark):
    return dict(
        virtual_stores=spark.createDataFrame(
            [(s, c, "B" + c, "no" + s, "v", "vn", "f", r) for s, c, r in
             [("S", "A", "R"), ("S", "NF", "R0"), ("Test Lab", "A", "R")]], schemas.VIRTUAL_STORES),
        delivery=spark.createDataFrame([("YES", "Y")], schemas.DELIVERY_MAP),
        order_sources=spark.createDataFrame([("W", "Web"), ("Dine", "Dine in")], schemas.ORDER_SOURCE_MAP),
        currency=spark.createDataFrame([("R", Decimal("2.5"))], schemas.CURRENCY))


@pytest.fixture(scope="module", params=[0, 1 << 20], ids=["shuffled", "broadcast"])
def mappings(spark, request):
    return Mappings.measured(**mapping_tables(spark), max_bytes=request.param)


def test_header_cases(raw, mappings):
    out = transform_header(raw, mappings, data_source="X")
    assert tuple(out.columns) == schemas.ENRICHED_HEADER_COLUMNS and len(out.columns) == 70
    got = {r.uniqueOrderId: r for r in out.collect()}
    assert {k: (r.RefinedOrderSource, r.OriginatedCCYN) for k, r in got.items()} == {
        "plain": ("Dine in", "NO"), "null source": ("Dine in", "NO"), "call centre": ("Dine in", "CC"),
        "mapped": ("Web", "NO"), "unmapped": ("Q", "NO")}
    r = got["plain"]
    assert (r.fk_rawHeader, r.accountingDate, r.OpeningTimeFormated, r.DataSource, r.storeNo, r.brand, r.region, r.DeliveryYN) == (
        7, "20/06/2022", "10:15:00", "X", "noS", "BA", "R", "Y")
    assert (r.effectiveDiscount, r.GGGross, r.GrossSalesBD_BC, r.effectiveDiscount_BC, r.GGGross_BC, r.NetSales_BC) == (
        Decimal(2), Decimal(9), Decimal(25), Decimal(5), Decimal("22.5"), None)
    assert (r.salesTransformed, r.paymentTransformed) == (False, False)


def test_full_refresh_and_rejects(raw, mappings):
    assert transform_header(raw, mappings, full_refresh=True).count() == 6
    assert rows(unmapped_headers(raw, mappings).select("uniqueOrderId", "lacks")) == [
        ("no delivery", "delivery"), ("no factor", "currency"), ("no store", "store")]


def test_repeated_mapping_keys_are_refused(spark):
    tables = mapping_tables(spark)
    tables["delivery"] = tables["delivery"].unionAll(tables["delivery"])
    with pytest.raises(ValueError, match="delivery"):
        Mappings.measured(**tables)


def test_payments_and_sales(spark, raw, mappings):
    header = transform_header(raw, mappings).withColumn("paymentTransformed", F.col("uniqueOrderId") == "mapped").withColumn(
        "salesTransformed", F.col("uniqueOrderId") == "plain")
    payments = table(spark, schemas.RAW_PAYMENT, *[
        {"uniqueOrderId": o, "paymentType": p, "creditedTo": c, "grossSalesAD": Decimal(4), "accountingDay": date(2022, 6, 20)}
        for o, p, c in [("plain", "Aggregator Payment", ""), ("plain", "Card", ""), ("unmapped", "Card", "house"),
                        ("mapped", "Card", ""), ("gone", "Card", "")]])
    paid = transform_payment(payments, header, mappings)
    assert tuple(paid.columns) == schemas.ENRICHED_PAYMENT_COLUMNS and len(paid.columns) == 23
    assert rows(paid.select("uniqueOrderId", "paymentType", "creditedTo", "storeNo", "receiptNo", "grossSalesAD_BC")) == [
        ("plain", "Aggregator Payment", "Dine in", "noS", 1, Decimal("10.0000")), ("plain", "Card", "", "noS", 1, Decimal("10.0000")),
        ("unmapped", "Card", "house", "noS", 1, Decimal("10.0000"))]
    lines = table(spark, schemas.RAW_SALES, *[
        {"uniqueOrderId": o, "item": i, "itemDeleted": d, "grossSalesBD": Decimal(4), "grossSalesAD": Decimal(3), "accountingDay": date(2022, 6, 20)}
        for o, i, d in [("mapped", " roll / a", "NOT_DELETED"), ("mapped", "tea", "DELETED"), ("mapped", "tea", None),
                        ("plain", "x", "NOT_DELETED"), ("unmapped", None, "NOT_DELETED")]])
    sold = transform_sales(lines, header, mappings)
    assert tuple(sold.columns) == schemas.ENRICHED_SALES_COLUMNS and len(sold.columns) == 49
    assert rows(sold.select("uniqueOrderId", "itemName", "accountingDate", "brand", "GrossSalesBD_BC", "effectiveDiscount_BC")) == [
        ("mapped", "roll", "20/06/2022", "BA", Decimal("10.0000"), Decimal("2.5000")),
        ("unmapped", None, "20/06/2022", "BA", Decimal("10.0000"), Decimal("2.5000"))]
