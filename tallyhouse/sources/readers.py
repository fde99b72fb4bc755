"""Readers of report envelopes, dimension files and stored tables. Every schema is given, nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import blank_nulls, named, row_bytes
from tallyhouse.schemas import CURRENCY_FIELDS, STORE_MASTER


_BROKEN = "_broken"


def envelope_schema(rows: T.StructType) -> T.StructType:
    """Schema of a report answer; its totals are not read. A document that does not parse is kept as text."""
    return T.StructType([
        T.StructField("error", T.BooleanType()),
        T.StructField("result", T.StructType([T.StructField("rawData", T.ArrayType(rows))])),
        T.StructField(_BROKEN, T.StringType()),
    ])


class Envelopes(NamedTuple):
    """Rows of the answers, and answers that gave none because they are `broken`, in `error` or say `neither`."""

    rows: DataFrame
    rejects: DataFrame


def split_envelopes(envelopes: DataFrame) -> Envelopes:
    """One row per element of `result.rawData`, and the rejected answers with their file and reason."""
    reason = (F.when(F.col(_BROKEN).isNotNull(), "broken").when(F.col("error").isNull(), "neither").when(F.col("error"), "error"))
    good = envelopes.filter(reason.isNull())
    rejects = envelopes.filter(reason.isNotNull()).select(
        F.element_at(F.split(F.col("_file"), "/"), -1).alias("file"), reason.alias("reason"), F.col(_BROKEN).alias("text"))
    return Envelopes(good.select(F.explode("result.rawData").alias("row")).select("row.*"), rejects)


def scan_envelopes(spark: SparkSession, path: str | Sequence[str], rows: T.StructType, one_per_line: bool = False) -> Envelopes:
    """Report answers under `path`, one document per file or one per line, with the rejected ones beside the rows."""
    paths = path if isinstance(path, str) else list(path)
    read = spark.read.schema(envelope_schema(rows)).option("columnNameOfCorruptRecord", _BROKEN).option("mode", "PERMISSIVE")
    return split_envelopes(read.json(paths, multiLine=not one_per_line).withColumn("_file", F.col("_metadata.file_path")))


def read_envelopes(spark: SparkSession, path: str | Sequence[str], rows: T.StructType, one_per_line: bool = False) -> DataFrame:
    """The rows of report answers. Take `scan_envelopes` to see which answers gave none."""
    return scan_envelopes(spark, path, rows, one_per_line).rows


def read_store_master(spark: SparkSession, path: str, schema: T.StructType = STORE_MASTER) -> DataFrame:
    """Store list with a heading line; ids stay text, a byte-order mark is skipped."""
    return spark.read.schema(schema).csv(path, header=True)


# How this library writes and reads CSV: text comes back as it was, with its padding, quotes and backslashes. Line
# breaks and backslashes inside text are written as escapes, so that files stay splittable.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def escape_lines(df: DataFrame) -> DataFrame:
    """Text columns with backslash, line feed and carriage return as two characters each."""
    def escaped(c: Column) -> Column:
        return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))

    return df.select(*[escaped(named(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else named(f.name) for f in df.schema])


def unescape_lines(df: DataFrame) -> DataFrame:
    """The reverse of `escape_lines`."""
    def plain(c: Column) -> Column:
        # Between escaped backslashes, read from the left, no backslash is left but those of line breaks.
        parts = F.split(c, r"\\\\")
        lines = F.transform(parts, lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.array_join(lines, "\\")

    return df.select(*[plain(named(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else named(f.name) for f in df.schema])


def read_text_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV rows this library wrote. The format has no null text, so empty text is read for both."""
    return blank_nulls(unescape_lines(spark.read.schema(schema).options(**CSV).csv(path)))


def read_currency_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The currency tab of the mapping workbook, saved as CSV, under its own headings."""
    schema = T.StructType([T.StructField(heading, T.StringType()) for heading, _, _ in CURRENCY_FIELDS])
    return spark.read.schema(schema).csv(path, header=True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored Parquet table. Give a path that exists: a mistyped one is an error, not an empty table."""
    return spark.read.schema(schema).parquet(path)


def query_table(spark: SparkSession, table: DataFrame, sql: str, **values) -> DataFrame:
    """Read a stored table through SQL that names it `{table}` and binds `:name` values."""
    return spark.sql(sql, args=values, table=table)


def measured(dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, int]:
    """Bytes of mappings, given as (rows, key) by name, in one job that also checks them: a repeated key is an error."""
    checks = []
    for name, (rows, keys) in dimensions.items():
        by_key = rows.withColumn("_bytes", row_bytes(rows)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), F.sum("_bytes").alias("_bytes"))
        repeated = F.col("_copies") > 1
        checks.append(by_key.agg(
            F.count_if(repeated).alias("keys"), F.first(F.when(repeated, F.concat_ws(", ", *keys)), ignorenulls=True).alias("one"),
            F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes")).select(F.lit(name).alias("name"), "keys", "one", "bytes"))
    found = reduce(DataFrame.unionAll, checks).collect()
    for row in found:
        if row["keys"]:
            raise ValueError(f"mapping {row['name']}: {row['keys']} keys occur more than once, such as {row['one']!r}")
    return {row["name"]: row["bytes"] for row in found}


def require_unique(dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Check mappings, given as (rows, key) by name, in one job: a repeated key is an error."""
    measured(dimensions)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
