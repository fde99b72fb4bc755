"""What the text operators share: tables, row keys, result fields."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import freed_shuffles, scratch_path

KEY = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: Sequence[str]) -> str:
    """`name`, with as many underscores as set it apart from the columns there are; letters count alike in both cases."""
    there = {c.lower() for c in taken}
    while name.lower() in there:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage ends here, and a lost executor does not repeat what came before."""
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, id_col: str, text_col: str, others: str | None = None) -> tuple[DataFrame, bool]:
    """Columns `_row` (a distinct long per row), `id_col` and `text_col`; and whether the rows were numbered anew.

    The key is the id itself where ids are whole numbers, present and distinct. Else rows are numbered by id and text,
    nulls first, and kept as a table, so that every row, also a repeated one, is a document of its own and equal ids
    are ordered by text. Only ids are read to find out. With `others`, the other columns come along as a struct of that
    name, if there are any.
    """
    carried = [c for c in df.columns if c not in (id_col, text_col)] if others else []
    names = [id_col, text_col, *([others] if carried else [])]
    rows = df.select(id_col, text_col, *([F.struct(*(df[f"`{c}`"] for c in carried)).alias(others)] if carried else []))
    if dict(rows.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        odd = rows.groupBy(id_col).count().filter((F.col("count") > 1) | F.col(id_col).isNull())
        if odd.isEmpty():
            return rows.select(F.col(id_col).cast("bigint").alias(KEY), *names), False
    # The range exchange splits by id and text, so one hot id is spread as far as its texts differ.
    ordered = rows.repartitionByRange(F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first())
    return written(ordered.select(F.monotonically_increasing_id().alias(KEY), *names), "keyed"), True


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows again, in pieces whose text column holds about `limit` bytes; a longer text is a piece of its own."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def record(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
