"""Report answers as VARIANT: whole documents are parsed once, and types are checked after that.

A field whose value does not fit its type costs that value only, not its row or document, and fields that appear or go
missing on arrival are counted by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import named


class Answers(NamedTuple):
    """What report answers hold.

    `rows`: the report rows, a column for each field asked for. `rejects`: answers that gave no rows, as `file`, `reason`
    and `text`. `drift`: `field`, `change` and the number of `rows` with it: `unknown` fields that were not asked for,
    `missing` ones that a row lacks, and `misfit` values that are there but do not fit their type.
    """

    rows: DataFrame
    rejects: DataFrame
    drift: DataFrame


def _typed(field: str, kind: str) -> Column:
    return F.try_variant_get("_row", f"$['{field}']", kind)


def _fields_of(row: Column) -> Column:
    """Names of a row's fields; none of what is no object."""
    return F.coalesce(F.json_object_keys(F.to_json(row)), F.array().cast("array<string>"))


def read_answers(spark: SparkSession, path: str | Sequence[str], fields: Sequence[tuple[str, str, str]], one_per_line: bool = False) -> Answers:
    """Report answers under `path`, one document per file or one per line; `fields` holds (field, stored name, type).

    Business dates stay text. An answer is rejected as `broken` if it does not parse, `neither` if it does not say
    whether it is in error, `error` if it is, and `empty` if it holds no list of rows; a list without rows is none of these.
    """
    paths = path if isinstance(path, str) else list(path)
    text = spark.read.text(paths, wholetext=not one_per_line).select("value", F.col("_metadata.file_name").alias("file"))
    answers = text.filter(F.trim("value") != "").withColumn("_answer", F.try_parse_json("value"))
    in_error = F.try_variant_get("_answer", "$.error", "boolean")
    rows = F.try_variant_get("_answer", "$.result.rawData", "array<variant>")
    reason = (F.when(F.col("_answer").isNull(), "broken").when(in_error.isNull(), "neither").when(in_error, "error").when(rows.isNull(), "empty"))
    marked = answers.select("file", F.col("value").alias("text"), reason.alias("reason"), rows.alias("_rows"))
    each = marked.filter(F.col("reason").isNull()).select(F.explode("_rows").alias("_row"))
    kinds = [(field, "string" if kind == "date" else kind) for field, _, kind in fields]
    return Answers(
        each.select(*[_typed(field, kind).alias(field) for field, kind in kinds]),
        marked.filter(F.col("reason").isNotNull()).select("file", "reason", "text"),
        _drift(each, kinds))


def _drift(each: DataFrame, kinds: Sequence[tuple[str, str]]) -> DataFrame:
    asked = F.array(*[F.lit(field) for field, _ in kinds])
    there = _fields_of(F.col("_row"))

    def misfit(field: str, kind: str) -> Column:
        value = F.try_variant_get("_row", f"$['{field}']", "variant")
        return F.when(value.isNotNull() & ~F.is_variant_null(value) & _typed(field, kind).isNull(), F.lit(field))

    changes = {
        "unknown": F.array_except(there, asked),
        "missing": F.array_except(asked, there),
        "misfit": F.array_compact(F.array(*[misfit(field, kind) for field, kind in kinds])),
    }

    def marked(names: Column, change: str) -> Column:
        return F.transform(names, lambda name: F.struct(name.alias("field"), F.lit(change).alias("change")))

    found = each.select(F.explode(F.concat(*[marked(names, change) for change, names in changes.items()])).alias("_found")).select("_found.*")
    return found.groupBy("field", "change").agg(F.count(F.lit(1)).alias("rows"))


def stored_names(rows: DataFrame, fields: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Report rows under their stored names."""
    return rows.select(*[named(field).alias(name) for field, name, _ in fields])
