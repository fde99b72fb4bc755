"""Row and column counts of the steps of a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.functions.columns import named


def load_metrics(steps: Mapping[str, DataFrame]) -> DataFrame:
    """One row per step: `step`, `rows`, `columns`."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(step).alias("step"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for step, df in steps.items()]
    return reduce(DataFrame.unionAll, counts)


def misfits(rows: DataFrame, fields) -> DataFrame:
    """Per report field the number of values that do not fit their stored type: `field`, `rows`. One scan."""
    counts = [F.count_if(named(field).isNotNull() & named(field).try_cast(kind).isNull()).alias(f"_{i}") for i, (field, _, kind) in enumerate(fields)]
    each = F.array(*[F.struct(F.lit(field).alias("field"), F.col(f"_{i}").alias("rows")) for i, (field, _, _) in enumerate(fields)])
    return rows.agg(*counts).select(F.inline(each))


def counted(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written: `observation.get["rows"]` after the write."""
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
