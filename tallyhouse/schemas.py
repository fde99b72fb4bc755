"""Column catalogue of every layer: report field, stored name and stored type.

All names below are fixed values: they are the contract with the report service and with the stored tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,4)"
RATE = "decimal(18,8)"

# Fixed values: (report field, stored column, type), in stored order.
HEADER_GROUPS = (
    ("UniqOrderId.Id", "uniqueOrderId", "string"),
    ("Department", "store", "string"),
    ("Conception", "conception", "string"),
    ("OpenDate.Typed", "accountingDay", "date"),
    ("OrderNum", "receiptNo", "bigint"),
    ("TableNum", "tableNo", "bigint"),
    ("SessionNum", "shiftNo", "bigint"),
    ("OrderDeleted", "orderDeleted", "string"),
    ("Delivery.IsDelivery", "delivery", "string"),
    ("Delivery.ServiceType", "deliveryType", "string"),
    ("RestaurantSection", "section", "string"),
    ("Delivery.SourceKey", "deliverySource", "string"),
    ("OrderType", "orderType", "string"),
    ("ExternalNumber", "externalOrderNo", "string"),
    ("Delivery.CustomerPhone", "customerPhoneNumber", "string"),
    ("Delivery.CustomerName", "customerFullName", "string"),
    ("Delivery.DeliveryComment", "deliveryComment", "string"),
    ("OrderWaiter.Name", "waiterForTheOrder", "string"),
    ("OpenTime", "openingTime", "string"),
    ("Delivery.PrintTime", "deliveryPrintTime", "string"),
    ("Delivery.ExpectedTime", "plannedDeliveryTime", "string"),
    ("Delivery.SendTime", "deliveryDispatchTime", "string"),
    ("Delivery.ActualTime", "actualDeliveryTime", "string"),
    ("Delivery.CloseTime", "deliveryClosingTime", "string"),
    ("PrechequeTime", "guestBillTime", "string"),
    ("Delivery.BillTime", "deliveryInvoicePrintTime", "string"),
    ("CloseTime", "closingTime", "string"),
    ("Delivery.CancelCause", "deliveryCancellationReason", "string"),
    ("Delivery.CancelComment", "deliveryCancellationComment", "string"),
    ("PriceCategory", "customerPriceCategory", "string"),
)
HEADER_MEASURES = (
    ("DishSumInt", "GrossSalesBD", MONEY),
    ("DiscountSum", "discountAmount", MONEY),
    ("IncreaseSum", "surchargeAmount", MONEY),
    ("DishDiscountSumInt", "grossSalesAD", MONEY),
    ("VAT.Sum", "VATByBillAmount", MONEY),
    ("DishDiscountSumInt.withoutVAT", "NetSalesAD", MONEY),
    ("GuestNum", "numberOfGuests", "bigint"),
    ("DishAmountInt", "numberOfIitems", MONEY),
    ("ItemSaleEventDiscountType.DiscountAmount", "numberOfDiscountedItems", "bigint"),
    ("ItemSaleEventDiscountType.ComboAmount", "numberOfComboDiscounts", "bigint"),
    ("DishDiscountSumInt.averageByGuest", "averageRevenuePerGuest", MONEY),
    ("DishServicePrintTime.Max", "lastServPrintTime", "string"),
)
HEADER_TIMINGS = (
    ("Cooking.CookingDuration.Avg", "AvgCookingTime", "double"),
    ("Cooking.Cooking1Duration.Avg", "AvgCookingTime1", "double"),
    ("Cooking.Cooking2Duration.Avg", "AvgCookingTime2", "double"),
    ("Cooking.Cooking3Duration.Avg", "AvgCookingTime3", "double"),
    ("Cooking.Cooking4Duration.Avg", "AvgCookingTime4", "double"),
    ("Cooking.CookingLateTime.Avg", "AverageCookingDelay", "double"),
    ("Cooking.ServeTime.Avg", "AverageServingTime", "double"),
    ("Cooking.GuestWaitTime.Avg", "AverageWaitingTimeToBeServed", "double"),
    ("Cooking.FeedLateTime.Avg", "AverageServingDelay", "double"),
)
HEADER_FLAGS = (
    ("transformFlag", "boolean"),
    ("storeID", "string"),
    ("fetchSales", "boolean"),
    ("fetchPayment", "boolean"),
)

PAYMENT_GROUPS = (
    ("UniqOrderId.Id", "uniqueOrderId", "string"),
    ("PayTypes", "paymentType", "string"),
    ("OpenDate.Typed", "accountingDay", "date"),
    ("OrderNum", "receiptNo", "bigint"),
    ("PayTypes.Combo", "paymentTypeSplit", "string"),
    ("CardNumber", "paymentCardNo", "string"),
    ("Currencies.Currency", "paymentCurrency", "string"),
    ("NonCashPaymentType", "nonCashPaymentType", "string"),
    ("CreditUser", "creditedTo", "string"),
    ("Currencies.CurrencyRate", "paymentExchangeRateAED", RATE),
    ("AuthUser", "authorisedBy", "string"),
    ("AuthUser.Id", "authorisedByID", "string"),
    ("Cashier", "cashier", "string"),
    ("Cashier.Id", "cashierID", "string"),
)
# Asked for in the payment report, not stored.
PAYMENT_UNSTORED = ("TableNum", "SessionNum")
PAYMENT_MEASURES = (
    ("DishDiscountSumInt", "grossSalesAD", MONEY),
    ("VAT.Sum", "VATByBillAmount", MONEY),
    ("DishDiscountSumInt.withoutVAT", "netSalesAD", MONEY),
    ("PayTypes.VoucherNum", "numberOfVouchers", "bigint"),
)

SALES_GROUPS = (
    ("UniqOrderId.Id", "uniqueOrderId", "string"),
    ("Department", "store", "string"),
    ("Conception", "concept", "string"),
    ("OpenDate.Typed", "accountingDay", "date"),
    ("OrderNum", "receiptNo", "bigint"),
    ("TableNum", "tableNo", "bigint"),
    ("DeletedWithWriteoff", "itemDeleted", "string"),
    ("RemovalType", "itemDeletionReason", "string"),
    ("DeletionComment", "itemDeletionComment", "string"),
    ("DishCode", "itemCode", "string"),
    ("DishId", "itemId", "string"),
    ("DishName", "item", "string"),
    ("DishFullName", "itemFullName", "string"),
    ("DishCategory.Accounting", "itemAccountingCategory", "string"),
    ("DishCategory", "itemCategory", "string"),
    ("DishGroup", "itemGroup", "string"),
    ("DishGroup.TopParent", "level1_itemGroup", "string"),
    ("DishGroup.SecondParent", "level2_itemGroup", "string"),
    ("DishGroup.ThirdParent", "level3_itemGroup", "string"),
    ("Cooking.ServeNumber", "courseNo", "bigint"),
    ("WaiterName", "itemWaiter", "string"),
    ("DishServicePrintTime", "itemServicePrinting", "string"),
    ("Comment", "itemComment", "string"),
    ("SoldWithDish", "soldWithItem", "string"),
    ("OrderDiscount.Type", "discountType", "string"),
    ("OrderIncrease.Type", "surchargeType", "string"),
    ("ItemSaleEventDiscountType", "nameOfDiscountOrSurcharge", "string"),
    ("Delivery.CookingFinishTime", "cookingFinishedAt", "string"),
)
SALES_MEASURES = (
    ("DishAmountInt", "numberOfItems", MONEY),
    ("DishSumInt.averagePriceWithVAT", "averagePriceBeforeDiscount", MONEY),
    ("DishDiscountSumInt.averagePriceWithVAT", "averagePrice", MONEY),
    ("DishSumInt", "grossSalesBD", MONEY),
    ("DiscountSum", "discountAmount", MONEY),
    ("IncreaseSum", "surchargeAmountAED", MONEY),
    ("DishDiscountSumInt", "grossSalesAD", MONEY),
    ("VAT.Sum", "VATByBillAmount", MONEY),
    ("DishDiscountSumInt.withoutVAT", "netSalesAD", MONEY),
)
SALES_TIMINGS = (
    ("Cooking.CookingDuration.Avg", "cookingTimeAverage", "double"),
    ("Cooking.Cooking1Duration.Avg", "cookingTimeAverage1", "double"),
    ("Cooking.Cooking2Duration.Avg", "cookingTimeAverage2", "double"),
    ("Cooking.Cooking3Duration.Avg", "cookingTimeAverage3", "double"),
    ("Cooking.Cooking4Duration.Avg", "cookingTimeAverage4", "double"),
    ("Cooking.CookingLateTime.Avg", "AverageCookingDelay", "double"),
    ("Cooking.ServeTime.Avg", "AverageServingTime", "double"),
    ("Cooking.GuestWaitTime.Avg", "AverageWaitingTimeToBeServed", "double"),
    ("Cooking.FeedLateTime.Avg", "AverageServingDelay", "double"),
)

# The older payment table: (report field, stored column, type).
PAYMENT_ENTRY_FIELDS = (
    ("Conception", "conception", "string"),
    ("CreditUser", "creditUser", "string"),
    ("Delivery.IsDelivery", "isDelivery", "string"),
    ("Delivery.SourceKey", "sourceKey", "string"),
    ("Department", "department", "string"),
    ("DishDiscountSumInt", "dishDiscountSumInt", MONEY),
    ("ExternalNumber", "externalNumber", "string"),
    ("OpenDate.Typed", "openDate", "date"),
    ("OrderNum", "orderNum", "bigint"),
    ("OrderType", "orderType", "string"),
    ("PayTypes", "payTypes", "string"),
    ("UniqOrderId.Id", "uniqOrderId", "string"),
)

# Currency sheet: (sheet heading, stored column, type).
CURRENCY_FIELDS = (
    ("transHeader Value (Region)", "region", "string"),
    ("CurrencyConvFactor", "factor", RATE),
)

# Enriched tables as (stored column, type), in stored order.
ENRICHED_HEADER_FIELDS = (
    ("fk_rawHeader", "bigint"),
    ("uniqueOrderId", "string"),
    ("storeNo", "string"),
    ("brand", "string"),
    ("virtualStoreNo", "string"),
    ("virtualStoreName", "string"),
    ("financeStoreNo", "string"),
    ("accountingDate", "string"),
    ("receiptNo", "bigint"),
    ("DeliveryYN", "string"),
    ("RefinedOrderSource", "string"),
    ("OriginatedCCYN", "string"),
    ("GrossSalesBD", MONEY),
    ("discountAmount", MONEY),
    ("surchargeAmount", MONEY),
    ("grossSalesAD", MONEY),
    ("effectiveDiscount", MONEY),
    ("VAT", MONEY),
    ("NetSales", MONEY),
    ("NoOfCovers", "bigint"),
    ("GGGross", MONEY),
    ("region", "string"),
    ("OpeningTimeFormated", "string"),
    ("openingTime", "string"),
    ("tableNo", "bigint"),
    ("shiftNo", "bigint"),
    ("deliveryType", "string"),
    ("section", "string"),
    ("externalOrderNo", "string"),
    ("customerPhoneNumber", "string"),
    ("customerFullName", "string"),
    ("deliveryComment", "string"),
    ("orderWaiter", "string"),
    ("deliveryPrintTime", "string"),
    ("plannedDeliveryTime", "string"),
    ("deliveryDispatchTime", "string"),
    ("actualDeliveryTime", "string"),
    ("deliveryClosingTime", "string"),
    ("GuestBillTimeFormated", "string"),
    ("guestBillTime", "string"),
    ("deliveryInvoicePrintTime", "string"),
    ("ClosingTimeFormated", "string"),
    ("closingTime", "string"),
    ("customerPriceCategory", "string"),
    ("numberOfIitems", MONEY),
    ("numberOfDiscountedItems", "bigint"),
    ("numberOfComboDiscounts", "bigint"),
    ("averageRevenuePerGuest", MONEY),
    ("lastServPrintTime", "string"),
    ("DataSource", "string"),
    ("AvgCookingTime", "double"),
    ("AvgCookingTime1", "double"),
    ("AvgCookingTime2", "double"),
    ("AvgCookingTime3", "double"),
    ("AvgCookingTime4", "double"),
    ("AverageCookingDelay", "double"),
    ("AverageServingTime", "double"),
    ("AverageWaitingTimeToBeServed", "double"),
    ("AverageServingDelay", "double"),
    ("GrossSalesBD_BC", MONEY),
    ("discountAmount_BC", MONEY),
    ("surchargeAmount_BC", MONEY),
    ("grossSalesAD_BC", MONEY),
    ("effectiveDiscount_BC", MONEY),
    ("VAT_BC", MONEY),
    ("NetSales_BC", MONEY),
    ("GGGross_BC", MONEY),
    ("averageRevenuePerGuest_BC", MONEY),
    ("salesTransformed", "boolean"),
    ("paymentTransformed", "boolean"),
)
ENRICHED_PAYMENT_FIELDS = (
    ("uniqueOrderId", "string"),
    ("paymentType", "string"),
    ("accountingDate", "string"),
    ("paymentTypeSplit", "string"),
    ("paymentCardNo", "string"),
    ("paymentCurrency", "string"),
    ("nonCashPaymentType", "string"),
    ("creditedTo", "string"),
    ("exchangeRateAED", RATE),
    ("authorisedBy", "string"),
    ("authorisedByID", "string"),
    ("cashier", "string"),
    ("cashierID", "string"),
    ("grossSalesAD", MONEY),
    ("VAT", MONEY),
    ("netSales", MONEY),
    ("numberOfVouchers", "bigint"),
    ("storeNo", "string"),
    ("receiptNo", "bigint"),
    ("region", "string"),
    ("grossSalesAD_BC", MONEY),
    ("VAT_BC", MONEY),
    ("netSales_BC", MONEY),
)
ENRICHED_SALES_FIELDS = (
    ("uniqueOrderId", "string"),
    ("accountingDate", "string"),
    ("receiptNo", "bigint"),
    ("itemCode", "string"),
    ("itemId", "string"),
    ("itemName", "string"),
    ("itemFullName", "string"),
    ("itemAccountingCategory", "string"),
    ("itemCategory", "string"),
    ("itemGroup", "string"),
    ("level1_itemGroup", "string"),
    ("level2_itemGroup", "string"),
    ("level3_itemGroup", "string"),
    ("courseNo", "bigint"),
    ("itemWaiter", "string"),
    ("itemServicePrinting", "string"),
    ("itemComment", "string"),
    ("soldWithItem", "string"),
    ("discountType", "string"),
    ("surchargeType", "string"),
    ("nameOfDiscountOrSurcharge", "string"),
    ("cookingFinishedAt", "string"),
    ("numberOfItems", MONEY),
    ("averagePriceBeforeDiscount", MONEY),
    ("averagePrice", MONEY),
    ("grossSalesBD", MONEY),
    ("discountAmount", MONEY),
    ("surchargeAmountAED", MONEY),
    ("grossSalesAD", MONEY),
    ("effectiveDiscount", MONEY),
    ("VAT", MONEY),
    ("netSales", MONEY),
    ("cookingTimeAverage", "double"),
    ("cookingTimeAverage1", "double"),
    ("cookingTimeAverage2", "double"),
    ("cookingTimeAverage3", "double"),
    ("cookingTimeAverage4", "double"),
    ("storeNo", "string"),
    ("brand", "string"),
    ("region", "string"),
    ("averagePriceBeforeDiscount_BC", MONEY),
    ("averagePrice_BC", MONEY),
    ("GrossSalesBD_BC", MONEY),
    ("discountAmount_BC", MONEY),
    ("surchargeAmountAED_BC", MONEY),
    ("grossSalesAD_BC", MONEY),
    ("effectiveDiscount_BC", MONEY),
    ("VAT_BC", MONEY),
    ("netSales_BC", MONEY),
)

HEADER_FIELDS = HEADER_GROUPS + HEADER_MEASURES + HEADER_TIMINGS
PAYMENT_FIELDS = PAYMENT_GROUPS + PAYMENT_MEASURES
SALES_FIELDS = SALES_GROUPS + SALES_MEASURES + SALES_TIMINGS


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
    "boolean": T.BooleanType(), MONEY: T.DecimalType(18, 4), RATE: T.DecimalType(18, 8),
}


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _stored(fields):
    return [(stored, kind) for _, stored, kind in fields]


RAW_HEADER = _struct(_stored(HEADER_GROUPS + HEADER_MEASURES) + list(HEADER_FLAGS) + _stored(HEADER_TIMINGS))
RAW_PAYMENT = _struct([("uid", "string")] + _stored(PAYMENT_FIELDS))
RAW_SALES = _struct(_stored(SALES_FIELDS))
PAYMENT_ENTRY = _struct([("uid", "string")] + _stored(PAYMENT_ENTRY_FIELDS) + [("storeID", "string")])
CURRENCY = _struct(_stored(CURRENCY_FIELDS))
VIRTUAL_STORES = _struct([(name, "string") for name in (
    "storeName", "conceptionName", "conceptionNo", "storeNo", "virtualStoreNo", "virtualStoreName", "financeStoreNo",
    "regionCode")])
DELIVERY_MAP = _struct([("deliveryName", "string"), ("deliveryNo", "string")])
ORDER_SOURCE_MAP = _struct([("SourceKey", "string"), ("RefinedOrderSource", "string")])
STORE_MASTER = _struct([("StoreId", "string"), ("StoreCode", "string"), ("Folder", "string")])
STORE_MASTER_CONCEPTS = _struct([("StoreId", "string"), ("StoreCode", "string"), ("Concept", "string"),
                                 ("Folder", "string")])

ENRICHED_HEADER = _struct(ENRICHED_HEADER_FIELDS)
ENRICHED_PAYMENT = _struct(ENRICHED_PAYMENT_FIELDS)
ENRICHED_SALES = _struct(ENRICHED_SALES_FIELDS)
ENRICHED_HEADER_COLUMNS = tuple(ENRICHED_HEADER.names)
ENRICHED_PAYMENT_COLUMNS = tuple(ENRICHED_PAYMENT.names)
ENRICHED_SALES_COLUMNS = tuple(ENRICHED_SALES.names)


def report_rows(fields) -> T.StructType:
    """Schema of report rows as the service sends them; business dates arrive as text."""
    return _struct([(field, "string" if kind == "date" else kind) for field, _, kind in fields])
