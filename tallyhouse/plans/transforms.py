"""Raw tables to reporting tables: mappings, derived columns and base-currency money."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.columns import (
    NOT_DELETED, TEST_STORE, base_currency, call_centre_mark, credited_to, display_date, item_name, order_source,
    time_part)
from tallyhouse.operators.joins import BROADCAST_BYTES, join_dimension, join_on_keys
from tallyhouse.operators.progress import not_done
from tallyhouse.sources.readers import measured
from tallyhouse.schemas import ENRICHED_HEADER_COLUMNS, ENRICHED_PAYMENT_COLUMNS, ENRICHED_SALES_COLUMNS


# What a row of each mapping is found by.
_MAPPING_KEYS = {
    "virtual_stores": ("storeName", "conceptionName"), "delivery": ("deliveryName",), "order_sources": ("SourceKey",),
    "currency": ("region",),
}


# What is read of each mapping.
_MAPPING_READ = {
    "virtual_stores": tuple(schemas.VIRTUAL_STORES.names), "delivery": tuple(schemas.DELIVERY_MAP.names),
    "order_sources": tuple(schemas.ORDER_SOURCE_MAP.names), "currency": tuple(schemas.CURRENCY.names),
}


@dataclass(frozen=True)
class Mappings:
    """The mapping tables and which of them were measured small enough to broadcast."""

    virtual_stores: DataFrame
    delivery: DataFrame
    order_sources: DataFrame
    currency: DataFrame
    small: frozenset[str] = frozenset()

    @classmethod
    def measured(cls, virtual_stores: DataFrame, delivery: DataFrame, order_sources: DataFrame, currency: DataFrame,
                 max_bytes: int = BROADCAST_BYTES) -> Mappings:
        """The mappings, measured and checked: a repeated key would multiply orders, so it is an error."""
        sides = dict(virtual_stores=virtual_stores, delivery=delivery, order_sources=order_sources, currency=currency)
        sizes = measured({name: (side, _MAPPING_KEYS[name]) for name, side in sides.items()})
        return cls(**sides, small=frozenset(name for name, size in sizes.items() if size <= max_bytes))

    def digest(self) -> str:
        """Counts and digests of the mappings' rows, in any order: the same text as long as they hold the same rows."""
        sides = [getattr(self, name).select(*_MAPPING_READ[name]).agg(
            F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*_MAPPING_READ[name])).alias("digest")).select(F.lit(name).alias("name"), "rows", "digest")
            for name in _MAPPING_KEYS]
        return " ".join(f"{row['name']}:{row['rows']}:{row['digest']}" for row in sorted(reduce(DataFrame.unionAll, sides).collect()))

    def join(self, facts: DataFrame, name: str, columns: dict[str, str], on: Sequence[str], how: str = "inner") -> DataFrame:
        """Join one mapping, its columns renamed by `columns` first."""
        side = getattr(self, name).select(*[F.col(old).alias(new) for old, new in columns.items()])
        return join_dimension(facts, side, on, how, name in self.small)


_VIRTUAL_STORE = {
    "storeName": "store", "conceptionName": "conception", "conceptionNo": "brand", "storeNo": "storeNo",
    "virtualStoreNo": "virtualStoreNo", "virtualStoreName": "virtualStoreName", "financeStoreNo": "financeStoreNo",
    "regionCode": "region",
}
_DELIVERY = {"deliveryName": "delivery", "deliveryNo": "DeliveryYN"}
_ORDER_SOURCE = {"SourceKey": "unmappedSource", "RefinedOrderSource": "mappedSource"}
_CURRENCY = {"region": "region", "factor": "factor"}

# Columns that get a base-currency twin, as {twin: amount}.
HEADER_MONEY = {name + "_BC": name for name in (
    "GrossSalesBD", "discountAmount", "surchargeAmount", "grossSalesAD", "effectiveDiscount", "VAT", "NetSales",
    "GGGross", "averageRevenuePerGuest")}
PAYMENT_MONEY = {name + "_BC": name for name in ("grossSalesAD", "VAT", "netSales")}
SALES_MONEY = {name + "_BC": name for name in (
    "averagePriceBeforeDiscount", "averagePrice", "discountAmount", "surchargeAmountAED", "grossSalesAD",
    "effectiveDiscount", "VAT", "netSales")} | {"GrossSalesBD_BC": "grossSalesBD"}


def live_headers(raw: DataFrame, full_refresh: bool = False) -> DataFrame:
    """Orders that are not deleted and not of the test store; without `full_refresh`, only those not enriched yet."""
    live = raw.filter((F.col("orderDeleted") == NOT_DELETED) & (F.col("store") != TEST_STORE))
    return live if full_refresh else not_done(live, "transformFlag")


def _derived(**columns: Column) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def transform_header(raw: DataFrame, mappings: Mappings, full_refresh: bool = False, data_source: str = "POS",
                     keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Enriched order headers.

    Orders without a store, delivery or currency mapping are left out; `unmapped_headers` lists them. A raw table
    without a `pk_rawHeader` column gets row ids from its key, the same on every run. `keep` adds columns of the raw
    row to the enriched one.
    """
    row_id = F.col("pk_rawHeader") if "pk_rawHeader" in raw.columns else F.xxhash64("storeID", "uniqueOrderId")
    live = live_headers(raw, full_refresh)
    c = F.col
    live = live.withColumns(dict(keep or {}))
    orders = live.withColumn("unmappedSource", order_source(c("deliverySource"), c("orderType")))
    placed = mappings.join(orders, "virtual_stores", _VIRTUAL_STORE, ["store", "conception"])
    placed = mappings.join(placed, "delivery", _DELIVERY, ["delivery"])
    placed = mappings.join(placed, "order_sources", _ORDER_SOURCE, ["unmappedSource"], "left")
    placed = mappings.join(placed, "currency", _CURRENCY, ["region"])
    # Derived columns come after the joins, so that no join carries them.
    derived = {
        "fk_rawHeader": row_id,
        "accountingDate": display_date(c("accountingDay")),
        "effectiveDiscount": c("GrossSalesBD") - c("grossSalesAD"),
        "VAT": c("VATByBillAmount"),
        "NetSales": c("NetSalesAD"),
        "NoOfCovers": c("numberOfGuests"),
        "GGGross": c("GrossSalesBD") - c("VATByBillAmount"),
        "OpeningTimeFormated": time_part(c("openingTime")),
        "GuestBillTimeFormated": time_part(c("guestBillTime")),
        "ClosingTimeFormated": time_part(c("closingTime")),
        "orderWaiter": c("waiterForTheOrder"),
        "DataSource": F.lit(data_source),
        "RefinedOrderSource": F.coalesce(c("mappedSource"), c("unmappedSource")),
        "OriginatedCCYN": call_centre_mark(c("deliverySource")),
        "salesTransformed": F.lit(False),
        "paymentTransformed": F.lit(False),
    }
    return placed.withColumns(derived).withColumns(base_currency(HEADER_MONEY, c("factor"))).select(*ENRICHED_HEADER_COLUMNS, *(keep or ()))


def _open_orders(header: DataFrame, mappings: Mappings, flag: str, *columns: str) -> DataFrame:
    """Enriched orders whose lines or payments still wait, with their currency factor.

    The factor is joined here, once per order, and not on the far more numerous lines.
    """
    waiting = not_done(header, flag).select("uniqueOrderId", "region", *columns)
    return mappings.join(waiting, "currency", _CURRENCY, ["region"])


def transform_payment(raw: DataFrame, header: DataFrame, mappings: Mappings, hot: Sequence[int] = (),
                      keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Enriched payments of the enriched orders. `hot`: hot order ids of `raw`, see `hot_keys`; `keep`: raw columns."""
    c = F.col
    payments = raw.select(
        "uniqueOrderId", "paymentType", "paymentTypeSplit", "paymentCardNo", "paymentCurrency", "nonCashPaymentType",
        "authorisedBy", "authorisedByID", "cashier", "cashierID", "grossSalesAD", "numberOfVouchers",
        *_derived(storedCredit=c("creditedTo"), accountingDate=display_date(c("accountingDay")),
                  exchangeRateAED=c("paymentExchangeRateAED"), VAT=c("VATByBillAmount"), netSales=c("netSalesAD"), **(keep or {})))
    orders = _open_orders(header, mappings, "paymentTransformed", "storeNo", "receiptNo", "RefinedOrderSource")
    return join_on_keys(payments, orders, ["uniqueOrderId"], "inner", hot).withColumns({
        "creditedTo": credited_to(c("storedCredit"), c("paymentType"), c("RefinedOrderSource")),
        **base_currency(PAYMENT_MONEY, c("factor")),
    }).select(*ENRICHED_PAYMENT_COLUMNS, *(keep or ()))


def transform_sales(raw: DataFrame, header: DataFrame, mappings: Mappings, hot: Sequence[int] = (),
                    keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Enriched sales lines that are not deleted. `hot`: hot order ids of `raw`, see `hot_keys`; `keep`: raw columns."""
    c = F.col
    lines = raw.filter(c("itemDeleted") == NOT_DELETED).withColumns({
        "accountingDate": display_date(c("accountingDay")),
        "itemName": item_name(c("item")),
        "effectiveDiscount": c("grossSalesBD") - c("grossSalesAD"),
        "VAT": c("VATByBillAmount"),
        "netSales": c("netSalesAD"),
        **(keep or {}),
    }).drop("store")
    orders = _open_orders(header, mappings, "salesTransformed", "storeNo", "brand")
    joined = join_on_keys(lines, orders, ["uniqueOrderId"], "inner", hot)
    return joined.withColumns(base_currency(SALES_MONEY, c("factor"))).select(*ENRICHED_SALES_COLUMNS, *(keep or ()))


def unmapped_headers(raw: DataFrame, mappings: Mappings, full_refresh: bool = False) -> DataFrame:
    """Live orders the enrichment leaves out, with the mapping they lack. They stay open until it is added."""
    c = F.col
    live = live_headers(raw, full_refresh)
    looked_up = mappings.join(live, "virtual_stores", {
        "storeName": "store", "conceptionName": "conception", "regionCode": "region"}, ["store", "conception"], "left")
    looked_up = mappings.join(looked_up, "delivery", _DELIVERY, ["delivery"], "left")
    looked_up = mappings.join(looked_up, "currency", _CURRENCY, ["region"], "left")
    lacks = (F.when(c("region").isNull(), "store").when(c("DeliveryYN").isNull(), "delivery")
             .when(c("factor").isNull(), "currency"))
    return looked_up.withColumn("lacks", lacks).filter(c("lacks").isNotNull()).select(*raw.columns, "lacks")
