"""SQL that DuckDB answers over the same tables, one statement per registered query.

The joins, filters and CASE logic are written here on their own; only the column expressions of the stand-in tables
are shared with the Spark side.
"""

from __future__ import annotations

from tallyhouse import schemas
from tallyhouse.catalogue import standins as s
from tallyhouse.plans import report_specs

_DATES = {"accountingDay", "openDate", "maxDate"}
_MONEY = {name for schema in (
    schemas.RAW_HEADER, schemas.RAW_PAYMENT, schemas.RAW_SALES, schemas.PAYMENT_ENTRY, schemas.CURRENCY)
    for name, kind in zip(schema.names, (f.dataType.typeName() for f in schema.fields)) if kind == "decimal"
} | {"effectiveDiscount", "VAT", "NetSales", "netSales", "GGGross", "exchangeRateAED"}
_TEXT = {f.name for schema in (schemas.RAW_HEADER, schemas.RAW_PAYMENT, schemas.RAW_SALES, schemas.PAYMENT_ENTRY)
         for f in schema.fields if f.dataType.typeName() == "string"}


def _plain(name: str, value: str | None = None) -> str:
    value = value or name
    if name in _MONEY or name.endswith("_BC"):
        return f"CAST({value} AS DOUBLE) AS {name}"
    if name in _DATES:
        return f"CAST({value} AS VARCHAR) AS {name}"
    return f"{value} AS {name}"


def _blanked(names) -> str:
    """Stored columns with null text as empty text."""
    return ", ".join(_plain(n, f"coalesce({n}, '')" if n in _TEXT else n) for n in names)


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f'{text} AS "{name}"' for name, text in expressions.items())


_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_RAW_HEADER = f"""
totals AS (SELECT l_orderkey, {_columns(s.ORDER_TOTALS)} FROM lineitem GROUP BY l_orderkey),
raw_header AS (SELECT {_columns(s.HEADER)} FROM {_ORDERS} LEFT JOIN totals ON o_orderkey = l_orderkey)"""
_RAW_SALES = f"raw_sales AS (SELECT {_columns(s.SALES)} FROM lineitem JOIN part ON l_partkey = p_partkey)"
_RAW_PAYMENT = f"""
pay_totals AS (SELECT l_orderkey, l_linestatus, {_columns(s.PAYMENT_TOTALS)} FROM lineitem GROUP BY l_orderkey, l_linestatus),
raw_payment AS (SELECT {_columns(s.PAYMENT)} FROM pay_totals)"""
_REPORT_LINES = f"""
report_lines AS (
  SELECT {_columns(s.REPORT_ORDER)}, {_columns(s.REPORT_LINE)} FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_SOLD = "(SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_MAPPINGS = f"""
virtual_stores AS (SELECT {_columns(s.VIRTUAL_STORES)} FROM {_SOLD} WHERE {s.VIRTUAL_STORE_FILTER}),
delivery_map AS (SELECT * FROM {s.DELIVERY_ROWS}),
order_source_map AS (SELECT * FROM {s.ORDER_SOURCE_ROWS}),
currency AS (
  SELECT {_columns(s.CURRENCY)} FROM (
    SELECT r_name, count(*) AS n_suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) WHERE {s.CURRENCY_FILTER})"""
_STORES = f"stores AS (SELECT {_columns(s.STORE_MASTER)} FROM {_SOLD})"


def _money(amount: str, factor: str = "factor") -> str:
    # The wider type keeps DuckDB from multiplying in 64 bits, which large orders overflow.
    return f"CAST(CAST({amount} AS DECIMAL(28,4)) * {factor} AS DECIMAL(18,4))"


def _enriched(live: str) -> str:
    """The enriched header over the orders of the `live` subquery."""
    source = ("CASE WHEN deliverySource <> '' AND deliverySource <> 'CloudCallCenter' THEN deliverySource "
              "ELSE orderType END")
    bc = {
        "GrossSalesBD_BC": "GrossSalesBD", "discountAmount_BC": "discountAmount", "surchargeAmount_BC": "surchargeAmount",
        "grossSalesAD_BC": "grossSalesAD", "effectiveDiscount_BC": "(GrossSalesBD - grossSalesAD)",
        "VAT_BC": "VATByBillAmount", "NetSales_BC": "NetSalesAD", "GGGross_BC": "(GrossSalesBD - VATByBillAmount)",
        "averageRevenuePerGuest_BC": "averageRevenuePerGuest",
    }
    return f"""
enriched AS (
  SELECT h.*, pk_rawHeader AS fk_rawHeader, v.storeNo, v.conceptionNo AS brand, v.virtualStoreNo, v.virtualStoreName,
    v.financeStoreNo, strftime(accountingDay, '%d/%m/%Y') AS accountingDate, d.deliveryNo AS DeliveryYN,
    CASE WHEN m.RefinedOrderSource IS NULL THEN h.source_before ELSE m.RefinedOrderSource END AS RefinedOrderSource,
    CASE WHEN deliverySource = 'CloudCallCenter' THEN 'CC' ELSE 'NO' END AS OriginatedCCYN,
    GrossSalesBD - grossSalesAD AS effectiveDiscount, VATByBillAmount AS VAT, NetSalesAD AS NetSales,
    numberOfGuests AS NoOfCovers, GrossSalesBD - VATByBillAmount AS GGGross, v.regionCode AS region,
    list_extract(string_split(openingTime, 'T'), -1) AS OpeningTimeFormated,
    list_extract(string_split(guestBillTime, 'T'), -1) AS GuestBillTimeFormated,
    list_extract(string_split(closingTime, 'T'), -1) AS ClosingTimeFormated,
    waiterForTheOrder AS orderWaiter, 'POS' AS DataSource,
    {", ".join(f"{_money(amount)} AS {name}" for name, amount in bc.items())},
    FALSE AS salesTransformed, FALSE AS paymentTransformed
  FROM (SELECT *, {source} AS source_before FROM {live}) h
  JOIN virtual_stores v ON h.store = v.storeName AND h.conception = v.conceptionName
  JOIN delivery_map d ON h.delivery = d.deliveryName
  LEFT JOIN order_source_map m ON h.source_before = m.SourceKey
  JOIN currency c ON v.regionCode = c.region)"""


_LIVE = "(SELECT * FROM raw_header WHERE orderDeleted = 'NOT_DELETED' AND store <> 'Test Lab')"
_LIVE_NEW = "(SELECT * FROM raw_header WHERE orderDeleted = 'NOT_DELETED' AND store <> 'Test Lab' AND NOT transformFlag)"
_FULL = f"{_RAW_HEADER}, {_MAPPINGS}, {_enriched(_LIVE)}"
_OLD = "accountingDay < DATE '1998-01-01'"
_OPEN = f"NOT (e.{_OLD})"

_PAID = f"""
paid AS (
  SELECT p.uniqueOrderId, p.paymentType, strftime(p.accountingDay, '%d/%m/%Y') AS accountingDate, p.paymentTypeSplit,
    p.paymentCardNo, p.paymentCurrency, p.nonCashPaymentType,
    CASE WHEN p.creditedTo = '' THEN CASE WHEN p.paymentType IN ('Aggregator Payment', 'Aggregator Payment old')
      THEN e.RefinedOrderSource ELSE '' END ELSE p.creditedTo END AS creditedTo,
    p.paymentExchangeRateAED AS exchangeRateAED, p.authorisedBy, p.authorisedByID, p.cashier, p.cashierID,
    p.grossSalesAD, p.VATByBillAmount AS VAT, p.netSalesAD AS netSales, p.numberOfVouchers, e.storeNo, e.receiptNo,
    e.region, {_money('p.grossSalesAD')} AS grossSalesAD_BC, {_money('p.VATByBillAmount')} AS VAT_BC,
    {_money('p.netSalesAD')} AS netSales_BC
  FROM raw_payment p JOIN enriched e ON p.uniqueOrderId = e.uniqueOrderId JOIN currency c ON e.region = c.region
  WHERE {_OPEN})"""
_SALES_KEPT = [n for n in schemas.ENRICHED_SALES_COLUMNS if n in schemas.RAW_SALES.names]
_SOLD_LINES = f"""
sold AS (
  SELECT {", ".join("r." + n for n in _SALES_KEPT)}, strftime(r.accountingDay, '%d/%m/%Y') AS accountingDate,
    trim(string_split(r.item, '/')[1]) AS itemName, r.grossSalesBD - r.grossSalesAD AS effectiveDiscount,
    r.VATByBillAmount AS VAT, r.netSalesAD AS netSales, e.storeNo, e.brand, e.region,
    {_money('r.averagePriceBeforeDiscount')} AS averagePriceBeforeDiscount_BC, {_money('r.averagePrice')} AS averagePrice_BC,
    {_money('r.grossSalesBD')} AS GrossSalesBD_BC, {_money('r.discountAmount')} AS discountAmount_BC,
    {_money('r.surchargeAmountAED')} AS surchargeAmountAED_BC, {_money('r.grossSalesAD')} AS grossSalesAD_BC,
    {_money('(r.grossSalesBD - r.grossSalesAD)')} AS effectiveDiscount_BC, {_money('r.VATByBillAmount')} AS VAT_BC,
    {_money('r.netSalesAD')} AS netSales_BC
  FROM raw_sales r JOIN enriched e ON r.uniqueOrderId = e.uniqueOrderId JOIN currency c ON e.region = c.region
  WHERE r.itemDeleted = 'NOT_DELETED' AND {_OPEN})"""


def _loaded(cte: str, table: str, schema) -> str:
    """A raw table as it is after its load: null text is empty text."""
    blank = ", ".join(f"coalesce({n}, '') AS {n}" for n in schema.names if n in _TEXT)
    return f"""{cte.replace(f"{table} AS (", f"{table}_sent AS (")},
{table} AS (SELECT * REPLACE ({blank}) FROM {table}_sent)"""


_JOB_HEADER = f"{_loaded(_RAW_HEADER, 'raw_header', schemas.RAW_HEADER)}, {_MAPPINGS}, {_enriched(_LIVE)}"


def _all(names) -> str:
    return ", ".join(_plain(n) for n in names)


# Measures of a report line group, by report field.
def _ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"


def _sum(field: str) -> str:
    return f'sum("{field}")'


_MEASURES = {
    **{f: f"CAST(CAST({_sum(f)} AS DECIMAL(18,4)) AS DOUBLE)" for f in (
        "DishSumInt", "DiscountSum", "IncreaseSum", "DishDiscountSumInt", "VAT.Sum", "DishAmountInt")},
    "DishDiscountSumInt.withoutVAT":
        f"CAST(CAST({_sum('DishDiscountSumInt')} - {_sum('VAT.Sum')} AS DECIMAL(18,4)) AS DOUBLE)",
    "GuestNum": 'max("GuestNum")',
    **{f: f"CAST({_sum(f)} AS BIGINT)" for f in (
        "ItemSaleEventDiscountType.DiscountAmount", "ItemSaleEventDiscountType.ComboAmount", "PayTypes.VoucherNum")},
    "DishDiscountSumInt.averageByGuest": _ratio(_sum("DishDiscountSumInt"), 'max("GuestNum")'),
    "DishSumInt.averagePriceWithVAT": _ratio(_sum("DishSumInt"), _sum("DishAmountInt")),
    "DishDiscountSumInt.averagePriceWithVAT": _ratio(_sum("DishDiscountSumInt"), _sum("DishAmountInt")),
    "DishServicePrintTime.Max": 'max("DishServicePrintTime")',
    **{f"Cooking.{f}.Avg": f'avg("Cooking.{f}")' for f in (
        "CookingDuration", "Cooking1Duration", "Cooking2Duration", "Cooking3Duration", "Cooking4Duration",
        "CookingLateTime", "ServeTime", "GuestWaitTime", "FeedLateTime")},
}
_NO_VOID = 'NOT coalesce("IsVoid", FALSE)'


def _out_names(fields, tables) -> dict[str, str]:
    names = {field: name for table in tables for field, name, _ in table}
    return {f: names.get(f, f.replace(".", "_")) for f in fields}


def _report(spec, tables=(), where: str = _NO_VOID, ctes: str = "") -> str:
    names = _out_names(spec.group_fields + spec.data_fields, tables)
    groups = [f'CAST("{f}" AS VARCHAR) AS "{names[f]}"' if f == "OpenDate.Typed" else
              f'CAST("{f}" AS DOUBLE) AS "{names[f]}"' if f == "Currencies.CurrencyRate" else
              f'"{f}" AS "{names[f]}"' for f in spec.group_fields]
    measures = [f'{_MEASURES[f]} AS "{names[f]}"' for f in spec.data_fields]
    keys = ", ".join(f'"{f}"' for f in spec.group_fields)
    return f"WITH {ctes}{_REPORT_LINES} SELECT {', '.join(groups + measures)} FROM report_lines WHERE {where} GROUP BY {keys}"


def _daily(where: str, ctes: str = "") -> str:
    """Sales per store and day, guests once per order."""
    return f"""WITH {ctes}{_REPORT_LINES},
lines AS (SELECT * FROM report_lines WHERE {where}),
guests AS (SELECT "Department", "OpenDate.Typed", sum(g) AS g FROM (
  SELECT DISTINCT "Department", "OpenDate.Typed", "UniqOrderId.Id", "GuestNum" AS g FROM lines) GROUP BY ALL),
sales AS (SELECT "Department", "OpenDate.Typed", sum("DishSumInt") AS bd, sum("DishDiscountSumInt") AS ad,
  sum("DishAmountInt") AS n FROM lines GROUP BY ALL)
SELECT sales."Department" AS Department, CAST(sales."OpenDate.Typed" AS VARCHAR) AS OpenDate_Typed,
  CAST(CAST(bd AS DECIMAL(18,4)) AS DOUBLE) AS DishSumInt, CAST(CAST(ad AS DECIMAL(18,4)) AS DOUBLE) AS DishDiscountSumInt,
  CAST(g AS BIGINT) AS GuestNum, {_ratio('ad', 'g')} AS DishDiscountSumInt_averageByGuest,
  CAST(CAST(n AS DECIMAL(18,4)) AS DOUBLE) AS DishAmountInt
FROM sales JOIN guests ON sales."Department" = guests."Department" AND sales."OpenDate.Typed" = guests."OpenDate.Typed" """


def _pending_report(spec, tables, flag: str) -> str:
    where = f"""{_NO_VOID} AND "UniqOrderId.Id" IN (SELECT uniqueOrderId FROM raw_header WHERE NOT {flag})
  AND "OpenDate.Typed" BETWEEN (SELECT min(accountingDay) FROM raw_header WHERE NOT {flag})
  AND (SELECT max(accountingDay) FROM raw_header WHERE NOT {flag})"""
    return _report(spec, tables, where, f"{_RAW_HEADER}, ")


def _window(flag: str) -> str:
    return f"""WITH {_RAW_HEADER}
SELECT strftime(min(accountingDay), '%Y-%m-%dT%H:%M:%S') AS dateFrom, strftime(max(accountingDay), '%Y-%m-%dT%H:%M:%S') AS dateTo
FROM raw_header WHERE NOT {flag} HAVING count(*) > 0"""


_SHAPED_HEADER = f"""{_RAW_HEADER},
batch AS (SELECT * REPLACE (FALSE AS transformFlag, FALSE AS fetchSales, FALSE AS fetchPayment) FROM raw_header)"""
_ENTRIES = f"""{_REPORT_LINES},
entries AS (
  SELECT coalesce("UniqOrderId.Id" || '-' || "PayTypes", '') AS uid, coalesce("Conception", '') AS conception,
    coalesce("CreditUser", '') AS creditUser, coalesce("Delivery.IsDelivery", '') AS isDelivery,
    coalesce("Delivery.SourceKey", '') AS sourceKey, coalesce("Department", '') AS department,
    CAST(sum("DishDiscountSumInt") AS DECIMAL(18,4)) AS dishDiscountSumInt,
    coalesce("ExternalNumber", '') AS externalNumber, "OpenDate.Typed" AS openDate, "OrderNum" AS orderNum,
    coalesce("OrderType", '') AS orderType, coalesce("PayTypes", '') AS payTypes, "UniqOrderId.Id" AS uniqOrderId,
    "Department" AS storeID
  FROM report_lines WHERE {_NO_VOID}
  GROUP BY "UniqOrderId.Id", "PayTypes", "Conception", "CreditUser", "Delivery.IsDelivery", "Delivery.SourceKey",
    "Department", "ExternalNumber", "OpenDate.Typed", "OrderNum", "OrderType")"""
_ENTRY_NAMES = schemas.PAYMENT_ENTRY.names
_EXTRACTS = f"""WITH {_ENTRIES}, {_STORES}
SELECT {", ".join(_plain(n, "e." + n) for n in _ENTRY_NAMES)}, s.Folder AS Folder,
  'PaymentEntry_' || e.storeID || '_' || s.StoreCode || '_' || e.conception || '_1995-01-01_2001-12-31' AS Extract
FROM entries e JOIN stores s ON e.storeID = s.StoreCode AND e.conception = s.Concept"""
_MARKS = f"marks AS (SELECT storeID, max(accountingDay) AS mark FROM raw_header WHERE {_OLD} GROUP BY storeID)"
_RUN = "DATE '2000-12-31'"
_STORE_OPEN = f"""EXISTS (SELECT 1 FROM raw_header h JOIN marks m ON m.storeID = h.storeID
  WHERE h.uniqueOrderId = b.uniqueOrderId AND b.accountingDay <= {_RUN} AND m.mark < {_RUN}
    AND b.accountingDay >= CASE WHEN date_diff('day', m.mark, {_RUN}) > 5 THEN m.mark + 1 ELSE m.mark END)"""

_ANSWERS = f"""{_RAW_HEADER},
kinds AS (SELECT *, (tableNo + year(accountingDay)) % 11 AS kind FROM raw_header),
good AS (SELECT * FROM kinds WHERE kind NOT IN (1, 2, 3))"""

CHECKS: dict[str, str] = {
    "transform_header": f"WITH {_FULL} SELECT {_all(schemas.ENRICHED_HEADER_COLUMNS)} FROM enriched",
    "transform_header_incremental": f"""WITH {_RAW_HEADER}, {_MAPPINGS}, {_enriched(_LIVE_NEW)}
SELECT {_all(schemas.ENRICHED_HEADER_COLUMNS)} FROM enriched""",
    "transform_payment": f"WITH {_FULL}, {_RAW_PAYMENT}, {_PAID} SELECT {_all(schemas.ENRICHED_PAYMENT_COLUMNS)} FROM paid",
    "transform_sales": f"WITH {_FULL}, {_RAW_SALES}, {_SOLD_LINES} SELECT {_all(schemas.ENRICHED_SALES_COLUMNS)} FROM sold",
    "unmapped_orders": f"""WITH {_RAW_HEADER}, {_MAPPINGS}
SELECT uniqueOrderId, store, conception, delivery, CASE
    WHEN NOT EXISTS (SELECT 1 FROM virtual_stores WHERE storeName = store AND conceptionName = conception) THEN 'store'
    WHEN delivery NOT IN ('F', 'O') THEN 'delivery' ELSE 'currency' END AS lacks
FROM {_LIVE_NEW} h WHERE NOT EXISTS (
  SELECT 1 FROM virtual_stores JOIN currency ON regionCode = region
  WHERE storeName = h.store AND conceptionName = h.conception AND h.delivery IN ('F', 'O'))""",
    "load_header": f"""WITH {_SHAPED_HEADER} SELECT {_blanked(schemas.RAW_HEADER.names)} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM raw_header o WHERE {_OLD} AND o.uniqueOrderId = b.uniqueOrderId AND o.storeID = b.storeID)""",
    "load_headers_untransformed_only": f"""WITH {_SHAPED_HEADER} SELECT {_blanked(schemas.RAW_HEADER.names)} FROM batch
WHERE NOT (accountingDay >= DATE '1997-07-01' AND {_OLD})""",
    "load_payment": f"""WITH {_RAW_PAYMENT} SELECT {_blanked(schemas.RAW_PAYMENT.names)} FROM raw_payment b
WHERE NOT EXISTS (SELECT 1 FROM raw_payment o WHERE o.{_OLD} AND o.uid = b.uid)""",
    "load_sales": f"""WITH {_RAW_SALES} SELECT {_blanked(schemas.RAW_SALES.names)} FROM raw_sales b
WHERE NOT EXISTS (SELECT 1 FROM raw_sales o WHERE o.{_OLD} AND o.uniqueOrderId = b.uniqueOrderId)""",
    "load_payment_entry": f"""WITH {_ENTRIES} SELECT {_all(_ENTRY_NAMES)} FROM entries b
WHERE NOT EXISTS (SELECT 1 FROM entries o WHERE o.openDate < DATE '1998-01-01' AND o.uid = b.uid)""",
    "payment_entry_duplicates": f"""WITH {_ENTRIES},
copies AS (SELECT uid, count(*) AS storedCopies FROM entries WHERE openDate < DATE '1998-01-01' GROUP BY uid)
SELECT {", ".join(_plain(n, "b." + n) for n in _ENTRY_NAMES)}, storedCopies FROM entries b JOIN copies ON b.uid = copies.uid""",
    "find_duplicates": f"""WITH {_RAW_SALES},
copies AS (SELECT uniqueOrderId, count(*) AS storedCopies FROM raw_sales WHERE {_OLD} GROUP BY uniqueOrderId)
SELECT {", ".join(_plain(n, "b." + n) for n in schemas.RAW_SALES.names)}, storedCopies FROM raw_sales b JOIN copies ON b.uniqueOrderId = copies.uniqueOrderId""",
    "multi_store_load": f"""WITH {_SHAPED_HEADER}, {_MARKS}
SELECT {_blanked(schemas.RAW_HEADER.names)} FROM batch b
WHERE EXISTS (SELECT 1 FROM marks m WHERE m.storeID = b.storeID AND b.accountingDay <= {_RUN} AND m.mark < {_RUN}
    AND b.accountingDay >= CASE WHEN date_diff('day', m.mark, {_RUN}) > 5 THEN m.mark + 1 ELSE m.mark END)
  AND NOT EXISTS (SELECT 1 FROM raw_header o WHERE o.{_OLD} AND o.uniqueOrderId = b.uniqueOrderId)""",
    "multi_store_load_payment": f"""WITH {_RAW_HEADER}, {_RAW_PAYMENT}, {_MARKS}
SELECT {_blanked(schemas.RAW_PAYMENT.names)} FROM raw_payment b
WHERE {_STORE_OPEN} AND NOT EXISTS (SELECT 1 FROM raw_payment o WHERE o.{_OLD} AND o.uid = b.uid)""",
    "multi_store_load_sales": f"""WITH {_RAW_HEADER}, {_RAW_SALES}, {_MARKS}
SELECT {_blanked(schemas.RAW_SALES.names)} FROM raw_sales b
WHERE {_STORE_OPEN} AND NOT EXISTS (SELECT 1 FROM raw_sales o WHERE o.{_OLD} AND o.uniqueOrderId = b.uniqueOrderId)""",
    "daily_job": f"WITH {_JOB_HEADER} SELECT {_all([n for n in schemas.ENRICHED_HEADER_COLUMNS if n != 'fk_rawHeader'])} FROM enriched",
    "daily_job_payment": f"""WITH {_JOB_HEADER}, {_loaded(_RAW_PAYMENT, 'raw_payment', schemas.RAW_PAYMENT)}, {_PAID.replace(_OPEN, "TRUE")}
SELECT {_all(schemas.ENRICHED_PAYMENT_COLUMNS)} FROM paid""",
    "daily_job_sales": f"""WITH {_JOB_HEADER}, {_loaded(_RAW_SALES, 'raw_sales', schemas.RAW_SALES)}, {_SOLD_LINES.replace(_OPEN, "TRUE")}
SELECT {_all(schemas.ENRICHED_SALES_COLUMNS)} FROM sold""",
    "daily_job_payment_entry": f"WITH {_ENTRIES} SELECT {_all(_ENTRY_NAMES)} FROM entries",
    "first_load": f"WITH {_SHAPED_HEADER} SELECT {_blanked(schemas.RAW_HEADER.names)} FROM batch",
    "marks_by_load": f"""WITH {_RAW_HEADER}
SELECT storeID, CAST(max(accountingDay) AS VARCHAR) AS maxDate FROM raw_header GROUP BY storeID""",
    "answer_documents": f"""WITH {_ANSWERS}
SELECT conception, CASE WHEN receiptNo % 5 <> 0 THEN '' END AS creditUser, delivery AS isDelivery, coalesce(deliverySource, '') AS sourceKey,
  store AS department, CAST(grossSalesAD AS DOUBLE) AS dishDiscountSumInt, externalOrderNo AS externalNumber,
  CAST(accountingDay AS VARCHAR) AS openDate, CASE WHEN receiptNo % 7 <> 0 THEN receiptNo END AS orderNum, orderType, 'Card' AS payTypes,
  uniqueOrderId AS uniqOrderId FROM good""",
    "answer_rejects": f"""WITH {_ANSWERS}
SELECT CASE kind WHEN 1 THEN 'broken' WHEN 2 THEN 'error' ELSE 'empty' END AS reason, count(DISTINCT (tableNo, year(accountingDay))) AS n
FROM kinds WHERE kind IN (1, 2, 3) GROUP BY 1""",
    "answer_drift": f"""WITH {_ANSWERS}
SELECT 'Loyalty' AS field, 'unknown' AS change, count(*) AS rows FROM good WHERE receiptNo % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'CreditUser', 'missing', count(*) FROM good WHERE receiptNo % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'OrderNum', 'misfit', count(*) FROM good WHERE receiptNo % 7 = 0 HAVING count(*) > 0""",
    "load_history": f"""WITH {_RAW_HEADER}, {_RAW_PAYMENT}, {_RAW_SALES}, brought AS (
  SELECT CASE WHEN {_OLD} THEN 'day 1' ELSE 'day 2' END AS label, 'rawHeader' AS "table" FROM raw_header
  UNION ALL SELECT CASE WHEN paymentType = 'Card' THEN 'day 1' ELSE 'day 2' END, 'rawPayment' FROM raw_payment
  UNION ALL SELECT CASE WHEN receiptNo % 2 = 0 THEN 'day 1' ELSE 'day 2' END, 'rawSales' FROM raw_sales)
SELECT label, "table", count(*) AS rows FROM brought GROUP BY ALL""",
    "open_payment_orders": f"""WITH {_JOB_HEADER}, {_RAW_PAYMENT}
SELECT DISTINCT uniqueOrderId FROM raw_payment WHERE paymentType = 'Card'
  AND uniqueOrderId NOT IN (SELECT uniqueOrderId FROM enriched WHERE {_OLD})""",
    "unmapped_waiting": f"""WITH {_RAW_HEADER}, {_MAPPINGS}
SELECT uniqueOrderId, CASE
    WHEN NOT EXISTS (SELECT 1 FROM virtual_stores WHERE storeName = store AND conceptionName = conception) THEN 'store'
    WHEN delivery NOT IN ('F', 'O') THEN 'delivery' ELSE 'currency' END AS lacks,
  CASE WHEN {_OLD} THEN 'day 1' ELSE 'day 2' END AS run
FROM {_LIVE} h WHERE NOT EXISTS (
  SELECT 1 FROM virtual_stores JOIN currency ON regionCode = region
  WHERE storeName = h.store AND conceptionName = h.conception AND h.delivery IN ('F', 'O'))""",
    "report_sales_template": _report(report_specs.SALES_TEMPLATE, [schemas.SALES_FIELDS]),
    "report_payment_brands": _report(
        report_specs.PAYMENT, [schemas.PAYMENT_FIELDS], f"{_NO_VOID} AND \"Conception\" IN ('FURNITURE', 'BUILDING')"),
    "append_payment": f"""WITH {_RAW_PAYMENT} SELECT {_all(schemas.RAW_PAYMENT.names)} FROM raw_payment WHERE {_OLD}
UNION ALL SELECT {_blanked(schemas.RAW_PAYMENT.names)} FROM raw_payment b
WHERE NOT EXISTS (SELECT 1 FROM raw_payment o WHERE o.{_OLD} AND o.uid = b.uid)""",
    "append_sales": f"""WITH {_RAW_SALES} SELECT {_all(schemas.RAW_SALES.names)} FROM raw_sales WHERE {_OLD}
UNION ALL SELECT {_blanked(schemas.RAW_SALES.names)} FROM raw_sales b
WHERE NOT EXISTS (SELECT 1 FROM raw_sales o WHERE o.{_OLD} AND o.uniqueOrderId = b.uniqueOrderId)""",
    "append_payment_entry": f"""WITH {_ENTRIES} SELECT {_all(_ENTRY_NAMES)} FROM entries b
WHERE NOT EXISTS (SELECT 1 FROM entries o WHERE o.openDate < DATE '1998-01-01' AND o.uid = b.uid)""",
    "append_currency": f"WITH {_MAPPINGS} SELECT region, {_plain('factor')} FROM currency",
    "snapshot_flags": f"""WITH {_RAW_HEADER}, {_RAW_SALES}
SELECT uniqueOrderId, {_plain('accountingDay')}, fetchSales OR uniqueOrderId IN (SELECT uniqueOrderId FROM raw_sales) AS fetchSales
FROM raw_header""",
    "load_misfits": f"""WITH {_RAW_HEADER}
SELECT 'GuestNum' AS field, count(*) AS rows FROM raw_header WHERE receiptNo % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'OpenDate.Typed', count(*) FROM raw_header WHERE receiptNo % 5 = 0 HAVING count(*) > 0""",
    "sink_roundtrip_text": r"""SELECT o_orderkey, '  ' || o_orderpriority || chr(92) || chr(10) || ' "q", ' || chr(92) || chr(13) || chr(10)
  || chr(92) || 'n' || o_orderstatus || ' ' || chr(9) AS note, '' AS blank FROM orders""",
    "envelope_rejects": f"""WITH {_RAW_HEADER}, why AS (
  SELECT CASE WHEN receiptNo % 7 = 0 THEN 'broken' WHEN receiptNo % 11 = 0 THEN 'neither' WHEN delivery = 'P' THEN 'error' END AS reason
  FROM raw_header)
SELECT reason, count(*) AS n FROM why WHERE reason IS NOT NULL GROUP BY reason""",
    "report_header": _report(report_specs.HEADER, [schemas.HEADER_FIELDS]),
    "report_header_template": _report(report_specs.HEADER_TEMPLATE, [schemas.HEADER_FIELDS]),
    "report_payment": _pending_report(report_specs.PAYMENT, [schemas.PAYMENT_FIELDS], "fetchPayment"),
    "report_sales": _pending_report(report_specs.SALES, [schemas.SALES_FIELDS], "fetchSales"),
    "report_payment_v2": _report(
        report_specs.OLDER_PAYMENT, (), f"{_NO_VOID} AND \"Conception\" IN ('FURNITURE', 'MACHINERY')"),
    "report_sales_v2": _report(
        report_specs.OLDER_SALES, (), f"{_NO_VOID} AND \"Conception\" = 'FURNITURE'"),
    "report_sales_fixed": _report(
        report_specs.NAMED_SALES, (),
        f"{_NO_VOID} AND \"OpenDate.Typed\" >= DATE '1998-06-20' AND \"OpenDate.Typed\" < DATE '1998-07-20'"),
    "report_daily_guests": _daily(_NO_VOID),
    "report_over_states": f"""WITH {_REPORT_LINES},
lines AS (SELECT * FROM report_lines WHERE {_NO_VOID} AND "OpenDate.Typed" BETWEEN DATE '1996-02-10' AND DATE '1998-03-20'),
guests AS (SELECT "Department", sum(g) AS g FROM (SELECT DISTINCT "Department", "UniqOrderId.Id", "GuestNum" AS g FROM lines) GROUP BY ALL),
sales AS (SELECT "Department", sum("DishSumInt") AS bd, sum("DishDiscountSumInt") AS ad, sum("DishAmountInt") AS n FROM lines GROUP BY ALL)
SELECT sales."Department" AS Department, CAST(CAST(bd AS DECIMAL(18,4)) AS DOUBLE) AS DishSumInt,
  CAST(CAST(ad AS DECIMAL(18,4)) AS DOUBLE) AS DishDiscountSumInt, CAST(g AS BIGINT) AS GuestNum,
  {_ratio('ad', 'g')} AS DishDiscountSumInt_averageByGuest, CAST(CAST(n AS DECIMAL(18,4)) AS DOUBLE) AS DishAmountInt
FROM sales JOIN guests ON sales."Department" = guests."Department" """,
    "flags_as_rows": f"""WITH {_RAW_HEADER}, {_RAW_PAYMENT}
SELECT uniqueOrderId, {_plain('accountingDay')}, FALSE AS transformFlag, {_OLD} AS fetchSales,
  uniqueOrderId IN (SELECT uniqueOrderId FROM raw_payment WHERE paymentType = 'Card') AS fetchPayment FROM raw_header""",
    "report_filter_ids": _daily(
        f'{_NO_VOID} AND "UniqOrderId.Id" IN (SELECT uniqueOrderId FROM raw_header WHERE NOT fetchSales)', f"{_RAW_HEADER}, "),
    "report_filter_ids_excluded": _daily(
        f'{_NO_VOID} AND "UniqOrderId.Id" NOT IN (SELECT uniqueOrderId FROM raw_header WHERE NOT fetchSales)',
        f"{_RAW_HEADER}, "),
    "report_filter_brand": _daily(f"{_NO_VOID} AND \"Conception\" NOT IN ('FURNITURE', 'BUILDING')"),
    "report_filter_dates": _daily(
        f"{_NO_VOID} AND \"OpenDate.Typed\" > DATE '1996-01-01' AND \"OpenDate.Typed\" < DATE '2000-01-01'"),
    "report_with_void": _daily('NOT "IsNonBusinessPayment"'),
    "pending_payment_window": _window("fetchPayment"),
    "pending_sales_window": _window("fetchSales"),
    "store_high_water_mark": f"""WITH {_RAW_HEADER}
SELECT storeID, CAST(max(accountingDay) AS VARCHAR) AS maxDate FROM raw_header GROUP BY storeID""",
    "backfill_windows": f"""WITH {_RAW_HEADER}, {_MARKS},
gaps AS (SELECT storeID, mark, date_diff('day', mark, {_RUN}) AS gap FROM marks),
steps AS (SELECT storeID, mark, gap, unnest(generate_series(1, gap, 5)) AS step FROM gaps WHERE gap > 5)
SELECT storeID, CAST(mark + CAST(step AS INTEGER) AS VARCHAR) AS dateFrom,
  CAST(least(mark + CAST(step + 4 AS INTEGER), {_RUN}) AS VARCHAR) AS dateTo FROM steps
UNION ALL SELECT storeID, CAST(mark AS VARCHAR), CAST({_RUN} AS VARCHAR) FROM gaps WHERE gap BETWEEN 1 AND 5""",
    "previous_day_orders": f"""WITH {_RAW_HEADER}
SELECT uniqueOrderId, store, {_plain('accountingDay')} FROM raw_header WHERE accountingDay = DATE '1998-10-03'""",
    "custom_date_orders": f"""WITH {_RAW_HEADER}
SELECT uniqueOrderId, store, {_plain('accountingDay')} FROM raw_header
WHERE accountingDay BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    "mark_payment_fetched": f"""WITH {_RAW_HEADER}, {_RAW_PAYMENT}
SELECT uniqueOrderId, {_plain('accountingDay')}, fetchPayment OR EXISTS (
  SELECT 1 FROM raw_payment p JOIN raw_header r ON p.uniqueOrderId = r.uniqueOrderId WHERE NOT r.fetchPayment) AS fetchPayment
FROM raw_header""",
    "mark_payment_returned": f"""WITH {_RAW_HEADER}, {_RAW_PAYMENT}
SELECT uniqueOrderId, {_plain('accountingDay')}, CASE WHEN EXISTS (
  SELECT 1 FROM raw_payment p WHERE p.uniqueOrderId = h.uniqueOrderId) THEN TRUE ELSE fetchPayment END AS fetchPayment
FROM raw_header h""",
    "mark_sales_fetched": f"""WITH {_RAW_HEADER}, {_RAW_SALES}
SELECT uniqueOrderId, {_plain('accountingDay')}, fetchSales OR EXISTS (
  SELECT 1 FROM raw_sales p JOIN raw_header r ON p.uniqueOrderId = r.uniqueOrderId WHERE NOT r.fetchSales) AS fetchSales
FROM raw_header""",
    "mark_header_transformed": f"""WITH {_RAW_HEADER}, {_MAPPINGS}, {_enriched(_LIVE_NEW)}
SELECT uniqueOrderId, {_plain('accountingDay')}, CASE WHEN EXISTS (
  SELECT 1 FROM enriched e WHERE e.uniqueOrderId = h.uniqueOrderId) THEN TRUE ELSE transformFlag END AS transformFlag
FROM raw_header h""",
    "mark_payment_transformed": f"""WITH {_FULL}, {_RAW_PAYMENT}, {_PAID}
SELECT uniqueOrderId, storeNo, region, receiptNo, RefinedOrderSource, CASE WHEN EXISTS (
  SELECT 1 FROM paid p WHERE p.uniqueOrderId = e.uniqueOrderId) THEN TRUE ELSE e.{_OLD} END AS paymentTransformed
FROM enriched e""",
    "mark_sales_transformed": f"""WITH {_FULL}, {_RAW_SALES}, {_SOLD_LINES}
SELECT uniqueOrderId, storeNo, brand, region, CASE WHEN EXISTS (
  SELECT 1 FROM sold p WHERE p.uniqueOrderId = e.uniqueOrderId) THEN TRUE ELSE e.{_OLD} END AS salesTransformed
FROM enriched e""",
    "store_existing_header": f"""WITH {_RAW_HEADER}
SELECT uniqueOrderId, storeID, {_plain('accountingDay')}, {_plain('GrossSalesBD')} FROM raw_header
WHERE storeID = '7' AND NOT transformFlag""",
    "store_orders": f"""WITH {_RAW_HEADER}, {_STORES}
SELECT uniqueOrderId, storeID, conception, {_plain('accountingDay')} FROM raw_header h
WHERE EXISTS (SELECT 1 FROM stores WHERE StoreId = h.storeID AND Concept = h.conception AND Concept <> 'MACHINERY')""",
    "currency_dimension": f"WITH {_MAPPINGS} SELECT region, {_plain('factor')} FROM currency",
    "load_metrics": f"""WITH {_RAW_HEADER}
SELECT 'batch' AS step, count(*) AS rows, CAST({len(schemas.RAW_HEADER.names)} AS BIGINT) AS columns FROM raw_header
UNION ALL SELECT 'duplicates', count(*), {len(schemas.RAW_HEADER.names)} FROM raw_header WHERE {_OLD}
UNION ALL SELECT 'new', count(*), {len(schemas.RAW_HEADER.names)} FROM raw_header WHERE NOT ({_OLD})""",
    "sink_roundtrip_csv": _EXTRACTS,
    "sink_roundtrip_json": _EXTRACTS,
    "sink_named_files": f"SELECT * EXCLUDE (Extract), Extract || '.csv' AS File FROM ({_EXTRACTS})",
    "sink_roundtrip_table": f"WITH {_RAW_HEADER} SELECT {_all(schemas.RAW_HEADER.names)} FROM raw_header",
    "envelope_scan": f"""WITH {_RAW_HEADER},
paid AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, l_linestatus, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS amount
  FROM lineitem GROUP BY l_orderkey, l_linestatus)
SELECT conception, '' AS creditUser, delivery AS isDelivery, deliverySource AS sourceKey, store AS department,
  CAST(CAST(amount AS DECIMAL(18,4)) AS DOUBLE) AS dishDiscountSumInt, externalOrderNo AS externalNumber,
  CAST(accountingDay AS VARCHAR) AS openDate, receiptNo AS orderNum, orderType,
  CASE l_linestatus WHEN 'O' THEN 'Aggregator Payment' ELSE 'Card' END AS payTypes, uniqueOrderId AS uniqOrderId
FROM raw_header JOIN paid ON uniqueOrderId = id WHERE delivery <> 'P'""",
}
