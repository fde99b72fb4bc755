"""Extract files under their own names: `folder/extract.csv`, as people and other programs look for them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import blank_nulls
from tallyhouse.sources.readers import CSV, escape_lines, unescape_lines

# Rows of a file; a larger extract goes to several, the further ones numbered from 2.
FILE_ROWS = 1_000_000


def _files(spark: SparkSession, path: str):
    """The file system of a path, the path, and the class of its paths."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = paths(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place, paths


def write_extract_files(extracts: DataFrame, path: str, form: str, file_rows: int = FILE_ROWS) -> list[str]:
    """Write extract rows (see `named_extracts`) as `Folder/Extract.form` under `path`, which must not exist yet.

    Rows are written as parts by many tasks, and a hot extract by several of them; the driver then moves the parts to
    their names, so a name appears with all its rows. The second and further files of an extract end in `_2`, `_3`.
    Returns the names, in order.
    """
    if form not in ("csv", "json"):
        raise ValueError(f"extract form {form!r}")
    spark = extracts.sparkSession
    files, root, paths = _files(spark, path)
    if files.exists(root):
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    rows = (escape_lines(extracts) if form == "csv" else extracts).hint("rebalance", "Folder", "Extract")
    # Names go into folders as they are, so that they need no decoding.
    keyed = rows.withColumns({"_folder": F.hex("Folder"), "_extract": F.hex("Extract")}).drop("Folder", "Extract")
    writer = keyed.write.mode("errorifexists").partitionBy("_folder", "_extract").option("maxRecordsPerFile", file_rows)
    writer.options(**CSV).csv(staged) if form == "csv" else writer.json(staged)
    files.mkdirs(root)
    names = [name for folder in _folders(files, paths(staged)) for name in _moved(files, paths, folder, root, form)]
    files.delete(paths(staged), True)  # nothing but emptied folders of its own
    return sorted(names)


def _folders(files, place) -> list:
    return sorted((s.getPath() for s in files.listStatus(place) if s.isDirectory()), key=lambda p: p.getName())


def _plain(folder) -> str:
    return bytes.fromhex(folder.getName().split("=", 1)[1]).decode()


def _moved(files, paths, folder, root, form: str) -> list[str]:
    target = paths(root, _plain(folder))
    files.mkdirs(target)
    names = []
    for extract in _folders(files, folder):
        parts = sorted((s.getPath() for s in files.listStatus(extract)), key=lambda p: p.getName())
        for number, part in enumerate(parts, 1):
            name = f"{_plain(extract)}{f'_{number}' if number > 1 else ''}.{form}"
            if not files.rename(part, paths(target, name)):
                raise OSError(f"cannot move {part} to {name}")
            names.append(f"{_plain(folder)}/{name}")
    return names


def read_extract_files(spark: SparkSession, path: str, schema: T.StructType, form: str) -> DataFrame:
    """Rows of extract files, with the `Folder` and `File` they come from. `schema` is that of the rows."""
    read = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{form}")
    rows = read.options(**CSV).csv(path) if form == "csv" else read.json(path)
    place = F.split(F.col("_metadata.file_path"), "/")

    def name(at: int) -> Column:
        return F.url_decode(F.replace(F.element_at(place, at), F.lit("+"), F.lit("%2B")))

    marked = rows.withColumns({"Folder": name(-2), "File": name(-1)})
    return blank_nulls(unescape_lines(marked)) if form == "csv" else marked
