"""Grouped sales reports: filter, group, aggregate.

The input is one row per sale line whose columns carry report field names (dots included). All measures fold on the
map side, so a group of any size costs one small row per task. Values that belong to the order and repeat on its
lines (guests) are folded per order first.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import as_date, named
from tallyhouse.operators.joins import join_on_keys
from tallyhouse.schemas import MONEY

ORDER_ID = "UniqOrderId.Id"
_LITERALS = 500


@dataclass(frozen=True)
class Part:
    """A value that can be folded: `kind` is sum, count, latest (a time text) or once (one value per order).

    The latest time is the greatest text by its instant, and comes back as it was sent: with its fraction, its offset
    or without a day. Text without a day, or that is no time, counts as earlier than any that has one.
    """

    kind: str
    source: str

    @property
    def name(self) -> str:
        return f"{self.kind}({self.source})"

    def over_lines(self) -> Column:
        value = named(self.source)
        if self.kind == "latest":
            text = value.cast("string")
            # A struct is greater by its first field, then by the next one. Text without an offset is in UTC here.
            value = F.when(text.isNotNull(), F.struct(F.when(text.rlike("^[0-9]{4}-"), text.try_cast("timestamp")).alias("at"), text.alias("text")))
        folded = {"sum": F.sum, "count": F.count, "latest": F.max, "once": F.max}[self.kind](value)
        return folded.alias(self.name)

    def over_orders(self) -> Column:
        value = named(self.name)
        return (F.max(value) if self.kind == "latest" else F.sum(value)).alias(self.name)


@dataclass(frozen=True)
class Measure:
    parts: tuple[Part, ...]
    finish: Callable[..., Column]


def _money(value: Column) -> Column:
    return value.cast(MONEY)


def _quotient(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def _time_text(value: Column) -> Column:
    return value.getField("text")


def total(source: str, money: bool = True) -> Measure:
    return Measure((Part("sum", source),), _money if money else lambda v: v.cast("bigint"))


def average(source: str) -> Measure:
    return Measure((Part("sum", source), Part("count", source)), _quotient)


def per_unit(amount: str, units: str, kind: str = "sum") -> Measure:
    return Measure((Part("sum", amount), Part(kind, units)), _quotient)


# Measure fields of the report service. `X.Avg` fields average the line column `X`.
MEASURES: dict[str, Measure] = {
    "DishSumInt": total("DishSumInt"),
    "DiscountSum": total("DiscountSum"),
    "IncreaseSum": total("IncreaseSum"),
    "DishDiscountSumInt": total("DishDiscountSumInt"),
    "VAT.Sum": total("VAT.Sum"),
    "DishDiscountSumInt.withoutVAT": Measure(
        (Part("sum", "DishDiscountSumInt"), Part("sum", "VAT.Sum")), lambda gross, vat: _money(gross - vat)),
    "GuestNum": Measure((Part("once", "GuestNum"),), lambda v: v.cast("bigint")),
    "DishAmountInt": total("DishAmountInt"),
    "ItemSaleEventDiscountType.DiscountAmount": total("ItemSaleEventDiscountType.DiscountAmount", money=False),
    "ItemSaleEventDiscountType.ComboAmount": total("ItemSaleEventDiscountType.ComboAmount", money=False),
    "DishDiscountSumInt.averageByGuest": per_unit("DishDiscountSumInt", "GuestNum", "once"),
    "DishSumInt.averagePriceWithVAT": per_unit("DishSumInt", "DishAmountInt"),
    "DishDiscountSumInt.averagePriceWithVAT": per_unit("DishDiscountSumInt", "DishAmountInt"),
    "DishServicePrintTime.Max": Measure((Part("latest", "DishServicePrintTime"),), _time_text),
    "Cooking.CookingDuration.Avg": average("Cooking.CookingDuration"),
    "Cooking.Cooking1Duration.Avg": average("Cooking.Cooking1Duration"),
    "Cooking.Cooking2Duration.Avg": average("Cooking.Cooking2Duration"),
    "Cooking.Cooking3Duration.Avg": average("Cooking.Cooking3Duration"),
    "Cooking.Cooking4Duration.Avg": average("Cooking.Cooking4Duration"),
    "Cooking.CookingLateTime.Avg": average("Cooking.CookingLateTime"),
    "Cooking.ServeTime.Avg": average("Cooking.ServeTime"),
    "Cooking.GuestWaitTime.Avg": average("Cooking.GuestWaitTime"),
    "Cooking.FeedLateTime.Avg": average("Cooking.FeedLateTime"),
    "PayTypes.VoucherNum": total("PayTypes.VoucherNum", money=False),
}


@dataclass(frozen=True)
class DateRange:
    """Days from `first` to `last`. Equal bounds mean that one day, whichever ends are included."""

    field: str
    first: date
    last: date
    include_left: bool = True
    include_right: bool = True

    def apply(self, df: DataFrame) -> DataFrame:
        day = as_date(named(self.field))
        if self.first == self.last:
            return df.filter(day == F.lit(self.first))
        low = day >= F.lit(self.first) if self.include_left else day > F.lit(self.first)
        high = day <= F.lit(self.last) if self.include_right else day < F.lit(self.last)
        return df.filter(low & high)


@dataclass(frozen=True)
class ValueList:
    """Keep (`inclusive`) or drop rows whose field is in `values`.

    A short list is a plain sequence; one of more than `_LITERALS` values, like a one-column DataFrame, becomes a join.
    `hot` are the hot keys of the reported rows, as found by `hot_keys`.
    """

    field: str
    values: Sequence | DataFrame
    inclusive: bool = True
    hot: tuple[int, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        values = self.values
        if not isinstance(values, DataFrame) and len(values) > _LITERALS:
            values = df.sparkSession.createDataFrame([(str(v),) for v in values], "value string")
        if not isinstance(values, DataFrame):
            listed = F.coalesce(named(self.field).isin(list(self.values)), F.lit(False))
            return df.filter(listed if self.inclusive else ~listed)
        keys = values.select(named(values.columns[0]).cast("string").alias("_key")).distinct()
        keyed = df.withColumn("_key", named(self.field).cast("string"))
        how = "left_semi" if self.inclusive else "left_anti"
        return join_on_keys(keyed, keys, ["_key"], how, self.hot).drop("_key")


@dataclass(frozen=True)
class ReportSpec:
    group_fields: tuple[str, ...]
    data_fields: tuple[str, ...]
    filters: tuple[DateRange | ValueList, ...] = ()
    include_void: bool = False
    include_non_business: bool = True
    measures: Mapping[str, Measure] = field(default_factory=lambda: MEASURES)

    def filtered(self, *filters: DateRange | ValueList) -> ReportSpec:
        return replace(self, filters=self.filters + filters)

    @classmethod
    def from_request(cls, text: str) -> ReportSpec:
        """Read a report request in the JSON form the service takes.

        What a report here has no way to honour is an error: value ranges, calculated fields, stacked columns, and
        date bounds inside a day, as the report's dates are days.
        """
        request = json.loads(text)
        for name in ("calculatedFields", "stackByDataFields"):
            if request.get(name):
                raise ValueError(f"report request with {name}")
        filters = []
        for item in request.get("filters", []):
            if item.get("valueMin") is not None or item.get("valueMax") is not None:
                raise ValueError(f"value range on {item['field']!r}")
            if item["filterType"] == "date_range":
                filters.append(DateRange(item["field"], _day(item["dateFrom"]), _day(item["dateTo"]),
                                         item.get("includeLeft", True), item.get("includeRight", False)))
            elif item["filterType"] == "value_list":
                filters.append(ValueList(item["field"], tuple(item["valueList"]), item.get("inclusiveList", True)))
            else:
                raise ValueError(f"unknown filter type {item['filterType']!r}")
        return cls(tuple(request["groupFields"]), tuple(request["dataFields"]), tuple(filters),
                   request.get("includeVoidTransactions", False), request.get("includeNonBusinessPaymentTypes", True))


def _day(text: str) -> date:
    at = datetime.fromisoformat(text)
    if at.time() != time():
        raise ValueError(f"date bound inside a day: {text!r}")
    return at.date()


def _chosen(lines: DataFrame, spec: ReportSpec, void: str, non_business: str) -> DataFrame:
    rows = reduce(lambda df, condition: condition.apply(df), spec.filters, lines)
    for column, included in ((void, spec.include_void), (non_business, spec.include_non_business)):
        if not included and column in lines.columns:
            rows = rows.filter(~F.coalesce(named(column), F.lit(False)))
    return rows


def _parts(spec: ReportSpec) -> list[Part]:
    return list(dict.fromkeys(part for name in spec.data_fields for part in spec.measures[name].parts))


def _folded(rows: DataFrame, spec: ReportSpec) -> DataFrame:
    """Group fields and folded parts."""
    groups, parts = [named(name) for name in spec.group_fields], _parts(spec)
    by_order = any(part.kind == "once" for part in parts) and ORDER_ID not in spec.group_fields
    folded = rows.groupBy(*groups, *([named(ORDER_ID)] if by_order else [])).agg(*[p.over_lines() for p in parts])
    return folded.groupBy(*groups).agg(*[part.over_orders() for part in parts]) if by_order else folded


def _finished(folded: DataFrame, spec: ReportSpec) -> DataFrame:
    measures = {name: spec.measures[name] for name in spec.data_fields}
    return folded.select(*[named(name) for name in spec.group_fields], *[
        measure.finish(*[named(part.name) for part in measure.parts]).alias(name) for name, measure in measures.items()])


def olap_report(lines: DataFrame, spec: ReportSpec, void: str = "IsVoid", non_business: str = "IsNonBusinessPayment") -> DataFrame:
    """Run a report over sale lines. Output columns are the group fields, then the data fields.

    `void` and `non_business` name boolean line columns; a missing column means no such rows.
    """
    return _finished(_folded(_chosen(lines, spec, void, non_business), spec), spec)


def report_states(lines: DataFrame, spec: ReportSpec, void: str = "IsVoid", non_business: str = "IsNonBusinessPayment") -> DataFrame:
    """Partial results of a report: its group fields and, unfinished, the parts of its measures.

    States of any lines can be put together and merged by `report_over_states`, for all or some of the groups. Lines of
    one order have to share its group fields, such as the business day, as a once-per-order value is counted in each group.
    """
    return _folded(_chosen(lines, spec, void, non_business), spec)


def report_over_states(states: DataFrame, spec: ReportSpec) -> DataFrame:
    """A report over states, the same as over their lines.

    Its groups and measures are among those of the states. Filters are on group fields of the states; rows of void and
    non-business payments are in or out as they were for the states.
    """
    rows = reduce(lambda df, condition: condition.apply(df), spec.filters, states)
    merged = rows.groupBy(*[named(name) for name in spec.group_fields]).agg(*[part.over_orders() for part in _parts(spec)])
    return _finished(merged, spec)


_MONTH = "_month"


def store_states(states: DataFrame, path: str, day: str) -> None:
    """Write states by month of their `day`, in place of what is stored of those months; others stay as they are.

    So a delivery of whole months brings its months up to date.
    """
    dated = states.withColumn(_MONTH, F.coalesce(F.date_format(as_date(named(day)), "yyyy-MM"), F.lit("none")))
    dated.hint("rebalance", _MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_MONTH).parquet(path)


def stored_states(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored states, of the months from `first` to `last` if given; only these months' files are read."""
    states = spark.read.parquet(path)
    if first is not None:
        states = states.filter(F.col(_MONTH) >= f"{first:%Y-%m}")
    if last is not None:
        states = states.filter(F.col(_MONTH) <= f"{last:%Y-%m}")
    return states.drop(_MONTH)
