"""The reports the loads and the older extracts are built on."""

from __future__ import annotations

from tallyhouse.operators.reports import ReportSpec
from tallyhouse.schemas import (
    HEADER_GROUPS, HEADER_MEASURES, HEADER_TIMINGS, PAYMENT_GROUPS, PAYMENT_MEASURES, PAYMENT_UNSTORED, SALES_GROUPS,
    SALES_MEASURES, SALES_TIMINGS)


def _fields(*tables) -> tuple[str, ...]:
    return tuple(row[0] for table in tables for row in table)


HEADER = ReportSpec(_fields(HEADER_GROUPS), _fields(HEADER_MEASURES, HEADER_TIMINGS))
PAYMENT = ReportSpec(_fields(PAYMENT_GROUPS) + PAYMENT_UNSTORED, _fields(PAYMENT_MEASURES))
SALES = ReportSpec(_fields(SALES_GROUPS), _fields(SALES_MEASURES, SALES_TIMINGS))

# Template revisions: the first header and sales requests ask for no late times, the header for no times at all.
HEADER_TEMPLATE = ReportSpec(_fields(HEADER_GROUPS), _fields(HEADER_MEASURES))
SALES_TEMPLATE = ReportSpec(_fields(SALES_GROUPS), _fields(SALES_MEASURES, SALES_TIMINGS[:5]))

# Fields of the older reports.
_ORDER_FIELDS = ("UniqOrderId.Id", "Department", "Conception", "OpenDate.Typed", "OrderNum", "Delivery.IsDelivery")
OLDER_PAYMENT = ReportSpec(
    _ORDER_FIELDS + ("PayTypes", "Delivery.SourceKey", "OrderType", "ExternalNumber", "CreditUser"),
    ("DishDiscountSumInt",))
OLDER_SALES = ReportSpec(
    _ORDER_FIELDS + ("OrderType", "DishCategory.Accounting", "DishCode", "ItemSaleEventDiscountType"),
    ("DishSumInt", "DiscountSum", "IncreaseSum", "DishDiscountSumInt", "VAT.Sum", "DishDiscountSumInt.withoutVAT"))
NAMED_SALES = ReportSpec(
    _ORDER_FIELDS + ("OrderType", "DishCategory.Accounting", "DishCode", "DishName", "ItemSaleEventDiscountType"),
    ("DishSumInt", "IncreaseSum", "DiscountSum", "DishDiscountSumInt", "VAT.Sum"))
