"""Raw and mapping tables shaped from the order tables.

Each column is one expression that Spark and DuckDB read alike. The Spark side joins with DataFrame code below; the
checking side joins in SQL (`checks.py`). Only the expressions are shared, so both see the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import hot_keys, join_on_keys
from tallyhouse.plans.transforms import Mappings

_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

# Money of a line in ten-thousandths, so that sums are whole-number sums.
_CENTS = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
_GROSS = f"({_CENTS} * 100)"
_AFTER_DISCOUNT = f"({_CENTS} * (100 - CAST(floor(l_discount * 100 + 0.5) AS BIGINT)))"
_PRICE_CENTS = "CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)"
_VAT = f"({_CENTS} * CAST(floor(l_tax * 100 + 0.5) AS BIGINT))"


def _money(ten_thousandths: str) -> str:
    return f"CAST(CAST({ten_thousandths} AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))"


# Order totals folded from the lines of one order.
ORDER_TOTALS = {
    "gross_bd": f"sum({_GROSS})",
    "gross_ad": f"sum({_AFTER_DISCOUNT})",
    "vat": f"sum({_VAT})",
    "units": "sum(CAST(l_quantity AS BIGINT))",
    "discounted": "count(CASE WHEN l_discount > 0 THEN 1 END)",
    "combos": "count(CASE WHEN l_linenumber = 1 THEN 1 END)",
    "last_print": "max(l_shipdate)",
    "cooking": "avg(l_quantity)",
    "late": "avg(CAST(l_linenumber AS DOUBLE))",
}

HEADER = {
    "pk_rawHeader": "o_orderkey",
    "uniqueOrderId": "CAST(o_orderkey AS STRING)",
    "store": "CASE WHEN n_name = 'NATION_0' THEN 'Test Lab' ELSE n_name END",
    "conception": "c_mktsegment",
    "accountingDay": "CAST(o_orderdate AS DATE)",
    "receiptNo": "o_orderkey",
    "tableNo": "CAST(n_nationkey AS BIGINT)",
    "shiftNo": "CAST(extract(day FROM o_orderdate) AS BIGINT)",
    "orderDeleted": "CASE WHEN c_acctbal < 0 THEN 'DELETED' ELSE 'NOT_DELETED' END",
    "delivery": "o_orderstatus",
    "deliveryType": "CASE o_orderstatus WHEN 'F' THEN 'COURIER' WHEN 'O' THEN 'PICKUP' ELSE '' END",
    "section": "o_orderpriority",
    "deliverySource": "CASE o_orderpriority WHEN '1-URGENT' THEN 'CloudCallCenter' WHEN '5-LOW' THEN '' "
                      "WHEN '4-NOT SPECIFIED' THEN NULL ELSE substr(o_orderpriority, 3) END",
    "orderType": "c_mktsegment",
    "externalOrderNo": "'X' || CAST(o_orderkey AS STRING)",
    "customerPhoneNumber": "CAST(c_custkey AS STRING)",
    "customerFullName": "c_name",
    "deliveryComment": "CAST(NULL AS STRING)",
    "waiterForTheOrder": "'W' || CAST(n_nationkey AS STRING)",
    "openingTime": f"{_DAY} || 'T10:15:00'",
    "deliveryPrintTime": "'T10:20:00'",
    "plannedDeliveryTime": "CASE WHEN o_orderstatus = 'F' THEN '11:00:00' END",
    "deliveryDispatchTime": "CASE WHEN o_orderstatus = 'F' THEN '10:40:00' END",
    "actualDeliveryTime": "CASE WHEN o_orderstatus = 'F' THEN '11:05:00' END",
    "deliveryClosingTime": "CASE WHEN o_orderstatus = 'F' THEN '11:10:00' END",
    "guestBillTime": f"CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN {_DAY} || 'T12:30:00' ELSE '12:30:00' END",
    "deliveryInvoicePrintTime": "CASE WHEN o_orderstatus = 'F' THEN '10:35:00' END",
    "closingTime": f"CASE WHEN o_orderstatus <> 'O' THEN {_DAY} || 'T13:45:00' END",
    "deliveryCancellationReason": "CASE WHEN c_acctbal < 0 THEN 'Guest cancelled' END",
    "deliveryCancellationComment": "CAST(NULL AS STRING)",
    "customerPriceCategory": "CASE WHEN c_acctbal >= 5000 THEN 'VIP' ELSE 'BASE' END",
    "GrossSalesBD": _money("coalesce(gross_bd, 0)"),
    "discountAmount": _money("coalesce(gross_bd - gross_ad, 0)"),
    "surchargeAmount": _money("coalesce(units, 0)"),
    "grossSalesAD": _money("coalesce(gross_ad, 0)"),
    "VATByBillAmount": _money("coalesce(vat, 0)"),
    "NetSalesAD": _money("coalesce(gross_ad - vat, 0)"),
    "numberOfGuests": "CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4 "
                      "WHEN '5-LOW' THEN 5 ELSE 10 END AS BIGINT)",
    "numberOfIitems": "CAST(coalesce(units, 0) AS DECIMAL(18,4))",
    "numberOfDiscountedItems": "CAST(coalesce(discounted, 0) AS BIGINT)",
    "numberOfComboDiscounts": "CAST(coalesce(combos, 0) AS BIGINT)",
    # Times one over the guests, the latter in hundredths.
    "averageRevenuePerGuest": _money("CAST(floor(coalesce(gross_ad, 0) * CASE o_orderpriority WHEN '1-URGENT' THEN 100 "
                                     "WHEN '2-HIGH' THEN 50 WHEN '3-MEDIUM' THEN 25 WHEN '5-LOW' THEN 20 ELSE 10 END "
                                     "/ 100) AS BIGINT)"),
    "lastServPrintTime": "CAST(CAST(last_print AS DATE) AS STRING) || 'T12:00:00'",
    "AvgCookingTime": "cooking",
    "AvgCookingTime1": "cooking",
    "AvgCookingTime2": "late",
    "AvgCookingTime3": "CAST(NULL AS DOUBLE)",
    "AvgCookingTime4": "late",
    "AverageCookingDelay": "late",
    "AverageServingTime": "cooking",
    "AverageWaitingTimeToBeServed": "cooking",
    "AverageServingDelay": "late",
    "transformFlag": "CAST(o_orderdate AS DATE) < DATE '1998-01-01'",
    "storeID": "CAST(n_nationkey AS STRING)",
    "fetchSales": "CAST(o_orderdate AS DATE) < DATE '1998-07-01'",
    "fetchPayment": "CAST(o_orderdate AS DATE) < DATE '1999-01-01'",
}

_LINE_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"

SALES = {
    "uniqueOrderId": "CAST(l_orderkey AS STRING)",
    "store": "'S' || CAST(l_suppkey AS STRING)",
    "concept": "p_brand",
    "accountingDay": "CAST(l_shipdate AS DATE)",
    "receiptNo": "l_orderkey",
    "tableNo": "CAST(l_linenumber AS BIGINT)",
    "itemDeleted": "CASE WHEN l_returnflag = 'R' THEN 'DELETED' ELSE 'NOT_DELETED' END",
    "itemDeletionReason": "CASE WHEN l_returnflag = 'R' THEN 'Returned' END",
    "itemDeletionComment": "CAST(NULL AS STRING)",
    "itemCode": "CAST(l_partkey AS STRING)",
    "itemId": "'P' || CAST(l_partkey AS STRING)",
    "item": "CASE WHEN p_size > 40 THEN p_name WHEN p_size > 20 THEN p_name || ' / ' || p_type "
            "ELSE '  ' || p_name || ' /' || p_type || '/ x' END",
    "itemFullName": "p_name || ' ' || p_type",
    "itemAccountingCategory": "p_type",
    "itemCategory": "p_type",
    "itemGroup": "p_brand",
    "level1_itemGroup": "p_brand",
    "level2_itemGroup": "p_type",
    "level3_itemGroup": "CAST(p_size AS STRING)",
    "courseNo": "CAST(l_linenumber AS BIGINT)",
    "itemWaiter": "'W' || CAST(l_suppkey AS STRING)",
    "itemServicePrinting": f"{_LINE_DAY} || 'T12:00:00'",
    "itemComment": "CAST(NULL AS STRING)",
    "soldWithItem": "CASE WHEN l_linenumber > 1 THEN 'menu' END",
    "discountType": "CASE WHEN l_discount > 0 THEN 'D' || CAST(l_linenumber AS STRING) END",
    "surchargeType": "CASE WHEN l_tax > 0 THEN 'tax' END",
    "nameOfDiscountOrSurcharge": "CASE WHEN l_discount > 0 THEN 'happy hour' ELSE '' END",
    "cookingFinishedAt": "'11:5' || CAST(l_linenumber AS STRING)",
    "numberOfItems": "CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(18,4))",
    "averagePriceBeforeDiscount": _money(f"{_PRICE_CENTS} * 100"),
    "averagePrice": _money(f"{_PRICE_CENTS} * (100 - CAST(floor(l_discount * 100 + 0.5) AS BIGINT))"),
    "grossSalesBD": _money(_GROSS),
    "discountAmount": _money(f"{_GROSS} - {_AFTER_DISCOUNT}"),
    "surchargeAmountAED": "CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(18,4))",
    "grossSalesAD": _money(_AFTER_DISCOUNT),
    "VATByBillAmount": _money(_VAT),
    "netSalesAD": _money(f"{_AFTER_DISCOUNT} - {_VAT}"),
    "cookingTimeAverage": "l_quantity",
    "cookingTimeAverage1": "l_quantity",
    "cookingTimeAverage2": "CAST(l_linenumber AS DOUBLE)",
    "cookingTimeAverage3": "CAST(NULL AS DOUBLE)",
    "cookingTimeAverage4": "CAST(l_linenumber AS DOUBLE)",
    "AverageCookingDelay": "CAST(l_linenumber AS DOUBLE)",
    "AverageServingTime": "l_quantity",
    "AverageWaitingTimeToBeServed": "l_quantity",
    "AverageServingDelay": "CAST(l_linenumber AS DOUBLE)",
}

# One payment per order and line status, folded from the lines.
PAYMENT_TOTALS = {
    "paid": f"sum({_AFTER_DISCOUNT})",
    "paid_vat": f"sum({_VAT})",
    "vouchers": "count(CASE WHEN l_discount > 0 THEN 1 END)",
    "returned": "max(ascii(l_returnflag))",
    "first_day": "min(l_shipdate)",
}
_PAY_TYPE = "CASE l_linestatus WHEN 'O' THEN 'Aggregator Payment' WHEN 'F' THEN 'Card' END"
PAYMENT = {
    "uid": f"CAST(l_orderkey AS STRING) || '-' || {_PAY_TYPE}",
    "uniqueOrderId": "CAST(l_orderkey AS STRING)",
    "paymentType": _PAY_TYPE,
    "accountingDay": "CAST(first_day AS DATE)",
    "receiptNo": "l_orderkey",
    "paymentTypeSplit": "l_linestatus",
    "paymentCardNo": "CASE WHEN l_linestatus = 'F' THEN 'card' END",
    "paymentCurrency": "'AED'",
    "nonCashPaymentType": _PAY_TYPE,
    "creditedTo": "CASE returned WHEN 82 THEN '' WHEN 78 THEN 'house' END",
    "paymentExchangeRateAED": "CAST(1 AS DECIMAL(18,8))",
    "authorisedBy": "CAST(returned AS STRING)",
    "authorisedByID": "CAST(returned AS STRING) || '1'",
    "cashier": "l_linestatus",
    "cashierID": "l_linestatus || '1'",
    "grossSalesAD": _money("paid"),
    "VATByBillAmount": _money("paid_vat"),
    "netSalesAD": _money("paid - paid_vat"),
    "numberOfVouchers": "CAST(vouchers AS BIGINT)",
}

VIRTUAL_STORE_FILTER = "n_name <> 'NATION_24'"
VIRTUAL_STORES = {
    "storeName": HEADER["store"],
    "conceptionName": "c_mktsegment",
    "conceptionNo": "'B-' || c_mktsegment",
    "storeNo": "'ST' || CAST(n_nationkey AS STRING)",
    "virtualStoreNo": "'V' || CAST(n_nationkey AS STRING) || c_mktsegment",
    "virtualStoreName": "n_name || ' ' || c_mktsegment",
    "financeStoreNo": "'F' || CAST(n_nationkey AS STRING)",
    "regionCode": "r_name",
}
STORE_MASTER = {
    "StoreId": "CAST(n_nationkey AS STRING)",
    "StoreCode": "n_name",
    "Concept": "c_mktsegment",
    "Folder": "r_name",
}
# Four of the five regions; the fifth has no factor.
CURRENCY_FILTER = "r_name <> 'MIDDLE EAST'"
CURRENCY = {
    "region": "r_name",
    "factor": "CAST((1000 + n_suppliers % 500) * 0.001 AS DECIMAL(18,8))",
}
DELIVERY_ROWS = "(VALUES ('F', 'Y'), ('O', 'N')) AS t(deliveryName, deliveryNo)"
ORDER_SOURCE_ROWS = "(VALUES ('HIGH', 'Web'), ('FURNITURE', 'Dine in')) AS t(SourceKey, RefinedOrderSource)"

# Columns of a report line, by report field: those of its order, and its own. `IsVoid` and `IsNonBusinessPayment` are
# row classes.
REPORT_ORDER = {
    "UniqOrderId.Id": HEADER["uniqueOrderId"],
    "Department": HEADER["store"],
    "Conception": "c_mktsegment",
    "OpenDate.Typed": HEADER["accountingDay"],
    "OrderNum": "o_orderkey",
    "TableNum": HEADER["tableNo"],
    "SessionNum": HEADER["shiftNo"],
    "OrderDeleted": HEADER["orderDeleted"],
    "Delivery.IsDelivery": HEADER["delivery"],
    "Delivery.ServiceType": HEADER["deliveryType"],
    "RestaurantSection": HEADER["section"],
    "Delivery.SourceKey": HEADER["deliverySource"],
    "OrderType": HEADER["orderType"],
    "ExternalNumber": HEADER["externalOrderNo"],
    "Delivery.CustomerPhone": HEADER["customerPhoneNumber"],
    "Delivery.CustomerName": HEADER["customerFullName"],
    "Delivery.DeliveryComment": HEADER["deliveryComment"],
    "OrderWaiter.Name": HEADER["waiterForTheOrder"],
    "OpenTime": HEADER["openingTime"],
    "Delivery.PrintTime": HEADER["deliveryPrintTime"],
    "Delivery.ExpectedTime": HEADER["plannedDeliveryTime"],
    "Delivery.SendTime": HEADER["deliveryDispatchTime"],
    "Delivery.ActualTime": HEADER["actualDeliveryTime"],
    "Delivery.CloseTime": HEADER["deliveryClosingTime"],
    "PrechequeTime": HEADER["guestBillTime"],
    "Delivery.BillTime": HEADER["deliveryInvoicePrintTime"],
    "CloseTime": HEADER["closingTime"],
    "Delivery.CancelCause": HEADER["deliveryCancellationReason"],
    "Delivery.CancelComment": HEADER["deliveryCancellationComment"],
    "PriceCategory": HEADER["customerPriceCategory"],
    "GuestNum": HEADER["numberOfGuests"],
}
REPORT_LINE = {
    "PayTypes": _PAY_TYPE,
    "PayTypes.Combo": "l_linestatus",
    "CardNumber": "CASE WHEN l_linestatus = 'F' THEN 'card' END",
    "Currencies.Currency": "'AED'",
    "NonCashPaymentType": _PAY_TYPE,
    "CreditUser": "CASE l_returnflag WHEN 'R' THEN '' WHEN 'N' THEN 'house' END",
    "Currencies.CurrencyRate": "CAST(1 AS DECIMAL(18,8))",
    "AuthUser": "l_returnflag",
    "AuthUser.Id": "l_returnflag || '1'",
    "Cashier": "l_linestatus",
    "Cashier.Id": "l_linestatus || '1'",
    "DeletedWithWriteoff": SALES["itemDeleted"],
    "RemovalType": SALES["itemDeletionReason"],
    "DeletionComment": SALES["itemDeletionComment"],
    "DishCode": SALES["itemCode"],
    "DishId": SALES["itemId"],
    "DishName": SALES["item"],
    "DishFullName": SALES["itemFullName"],
    "DishCategory.Accounting": SALES["itemAccountingCategory"],
    "DishCategory": SALES["itemCategory"],
    "DishGroup": SALES["itemGroup"],
    "DishGroup.TopParent": SALES["level1_itemGroup"],
    "DishGroup.SecondParent": SALES["level2_itemGroup"],
    "DishGroup.ThirdParent": SALES["level3_itemGroup"],
    "Cooking.ServeNumber": SALES["courseNo"],
    "WaiterName": SALES["itemWaiter"],
    "DishServicePrintTime": SALES["itemServicePrinting"],
    "Comment": SALES["itemComment"],
    "SoldWithDish": SALES["soldWithItem"],
    "OrderDiscount.Type": SALES["discountType"],
    "OrderIncrease.Type": SALES["surchargeType"],
    "ItemSaleEventDiscountType": SALES["nameOfDiscountOrSurcharge"],
    "Delivery.CookingFinishTime": SALES["cookingFinishedAt"],
    "DishSumInt": SALES["grossSalesBD"],
    "DiscountSum": SALES["discountAmount"],
    "IncreaseSum": SALES["surchargeAmountAED"],
    "DishDiscountSumInt": SALES["grossSalesAD"],
    "VAT.Sum": SALES["VATByBillAmount"],
    "DishAmountInt": SALES["numberOfItems"],
    "ItemSaleEventDiscountType.DiscountAmount": "CAST(CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS BIGINT)",
    "ItemSaleEventDiscountType.ComboAmount": "CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS BIGINT)",
    "Cooking.CookingDuration": "l_quantity",
    "Cooking.Cooking1Duration": "l_quantity",
    "Cooking.Cooking2Duration": "CAST(l_linenumber AS DOUBLE)",
    "Cooking.Cooking3Duration": "CAST(NULL AS DOUBLE)",
    "Cooking.Cooking4Duration": "CAST(l_linenumber AS DOUBLE)",
    "Cooking.CookingLateTime": "CAST(l_linenumber AS DOUBLE)",
    "Cooking.ServeTime": "l_quantity",
    "Cooking.GuestWaitTime": "l_quantity",
    "Cooking.FeedLateTime": "CAST(l_linenumber AS DOUBLE)",
    "PayTypes.VoucherNum": "CAST(CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS BIGINT)",
    "IsVoid": "l_returnflag = 'R' AND l_linestatus = 'F'",
    "IsNonBusinessPayment": "l_linestatus = 'F' AND l_tax = 0",
}


def shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()])


# Given, so that opening a table needs no job to read its footer.
TABLES = {name: T.StructType([T.StructField(column, kind) for column, kind in columns.items()]) for name, columns in {
    "region": {"r_regionkey": T.IntegerType(), "r_name": T.StringType()},
    "nation": {"n_nationkey": T.IntegerType(), "n_name": T.StringType(), "n_regionkey": T.IntegerType()},
    "customer": {"c_custkey": T.LongType(), "c_name": T.StringType(), "c_nationkey": T.IntegerType(),
                 "c_acctbal": T.DoubleType(), "c_mktsegment": T.StringType()},
    "supplier": {"s_suppkey": T.LongType(), "s_name": T.StringType(), "s_nationkey": T.IntegerType(),
                 "s_acctbal": T.DoubleType()},
    "part": {"p_partkey": T.LongType(), "p_name": T.StringType(), "p_brand": T.StringType(), "p_type": T.StringType(),
             "p_size": T.IntegerType(), "p_retailprice": T.DoubleType()},
    "orders": {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_orderstatus": T.StringType(),
               "o_totalprice": T.DoubleType(), "o_orderdate": T.TimestampNTZType(), "o_orderpriority": T.StringType()},
    "lineitem": {"l_orderkey": T.LongType(), "l_partkey": T.LongType(), "l_suppkey": T.LongType(),
                 "l_linenumber": T.IntegerType(), "l_quantity": T.DoubleType(), "l_extendedprice": T.DoubleType(),
                 "l_discount": T.DoubleType(), "l_tax": T.DoubleType(), "l_returnflag": T.StringType(),
                 "l_linestatus": T.StringType(), "l_shipdate": T.TimestampNTZType()},
}.items()}


class Tables:
    """The order tables of one folder, and the raw and mapping tables shaped from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def hot_orders(self) -> tuple[int, ...]:
        """Hot order ids among the lines, from one scan of the key column."""
        return hot_keys(self.read("lineitem").selectExpr("CAST(l_orderkey AS STRING) AS uniqueOrderId"), ["uniqueOrderId"])

    def _places(self) -> DataFrame:
        """The nations with their regions: 25 rows by definition of the tables."""
        return self.read("nation").join(self.read("region"), F.expr("n_regionkey = r_regionkey"))

    def _orders(self) -> DataFrame:
        customers = self.read("customer").join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
        return self.read("orders").join(customers, F.expr("o_custkey = c_custkey"))

    def raw_header(self) -> DataFrame:
        totals = self.read("lineitem").groupBy("l_orderkey").agg(
            *[F.expr(text).alias(name) for name, text in ORDER_TOTALS.items()])
        # One row per order on either side: never a broadcast, whatever the estimate says.
        return shaped(self._orders().join(totals.hint("merge"), F.expr("o_orderkey = l_orderkey"), "left"), HEADER)

    def _items(self) -> DataFrame:
        return self.read("lineitem").join(self.read("part"), F.expr("l_partkey = p_partkey"))

    def raw_sales(self) -> DataFrame:
        return shaped(self._items(), SALES)

    def raw_payment(self) -> DataFrame:
        totals = self.read("lineitem").groupBy("l_orderkey", "l_linestatus").agg(
            *[F.expr(text).alias(name) for name, text in PAYMENT_TOTALS.items()])
        return shaped(totals, PAYMENT)

    def report_lines(self) -> DataFrame:
        """Sales lines with the columns of their order. Lines of one hot order stay spread."""
        orders = shaped(self._orders(), REPORT_ORDER)
        lines = shaped(self._items(), {"UniqOrderId.Id": SALES["uniqueOrderId"], **REPORT_LINE})
        hot = hot_keys(shaped(self.read("lineitem"), {"UniqOrderId.Id": SALES["uniqueOrderId"]}), ["UniqOrderId.Id"])
        return join_on_keys(lines, orders, ["UniqOrderId.Id"], "inner", hot)

    def stores_with_concepts(self) -> DataFrame:
        sold = self.read("customer").select("c_nationkey", "c_mktsegment").distinct()
        return sold.join(self._places(), F.expr("c_nationkey = n_nationkey"))

    def store_master(self) -> DataFrame:
        return shaped(self.stores_with_concepts(), STORE_MASTER)

    def virtual_stores(self) -> DataFrame:
        return shaped(self.stores_with_concepts().filter(VIRTUAL_STORE_FILTER), VIRTUAL_STORES)

    def currency_rates(self) -> DataFrame:
        suppliers = self.read("supplier").join(self._places(), F.expr("s_nationkey = n_nationkey"))
        counted = suppliers.groupBy("r_name").agg(F.count(F.lit(1)).alias("n_suppliers"))
        return shaped(counted.filter(CURRENCY_FILTER), CURRENCY)

    def mapping_tables(self) -> list[tuple[DataFrame, str]]:
        """Virtual stores, delivery, order sources and currency, with their names."""
        return [(self.virtual_stores(), "virtual-stores"),
                (self.spark.sql(f"SELECT * FROM {DELIVERY_ROWS}"), "delivery"),
                (self.spark.sql(f"SELECT * FROM {ORDER_SOURCE_ROWS}"), "order-sources"),
                (self.currency_rates(), "currency")]

    def mappings(self) -> Mappings:
        return Mappings.measured(*(side for side, _ in self.mapping_tables()))
