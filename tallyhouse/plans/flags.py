"""Progress flags of stored headers as rows beside them.

Setting a flag writes a row for each order that does not carry it yet, and nothing of the header. Both are bucketed by
order, so the header with its flags is a join that moves neither. `fold_flags` merges the rows of many commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators.dedupe import new_rows
from tallyhouse.plans.jobs import ORDER, Warehouse
from tallyhouse.sources.ledger import COMMIT

FLAGS = tuple(name for name, kind in schemas.HEADER_FLAGS if kind == "boolean")
_STEP = "flags"


def _checked(flag: str) -> str:
    if flag not in FLAGS:
        raise ValueError(f"unknown flag {flag!r}")
    return flag


def set_flag(warehouse: Warehouse, flag: str, orders: DataFrame, label: str) -> None:
    """Flag the orders of a fetch or a transform; those that carry the flag as a row already are left alone."""
    known = warehouse.read("headerFlags").filter(F.col("flag") == _checked(flag))
    new = new_rows(orders.select(F.col(ORDER).cast("string")).filter(F.col(ORDER).isNotNull()).distinct(), known, ORDER)
    warehouse.add(label, _STEP, {"headerFlags": new.withColumn("flag", F.lit(flag))})


def set_returned(warehouse: Warehouse, flag: str, requested: DataFrame, loaded: DataFrame, label: str, scope: str = "requested") -> None:
    """Flag orders after a fetch: all that were `requested` if any row was loaded, or only those that were `returned`."""
    if scope == "returned":
        set_flag(warehouse, flag, loaded, label)
    elif scope != "requested":
        raise ValueError(f"unknown scope {scope!r}")
    elif not loaded.isEmpty():
        set_flag(warehouse, flag, requested, label)


def flagged_headers(warehouse: Warehouse) -> DataFrame:
    """The raw headers with their flags as they stand: set when they were stored, or by a row."""
    marks = warehouse.read("headerFlags").groupBy(ORDER).agg(*[F.bool_or(F.col("flag") == flag).alias(f"_{flag}") for flag in FLAGS])
    joined = warehouse.read("rawHeader").drop(COMMIT).join(marks, ORDER, "left")
    set_now = {flag: F.col(flag) | F.coalesce(F.col(f"_{flag}"), F.lit(False)) for flag in FLAGS}
    return joined.withColumns(set_now).select(*schemas.RAW_HEADER.names)


def fold_flags(warehouse: Warehouse, label: str) -> None:
    """One commit in place of all that hold flags; readers see the old ones or the new one."""
    warehouse.fold(label, "headerFlags")
