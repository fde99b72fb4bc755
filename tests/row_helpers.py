"""What the tests compare rows with."""

import time


def ordered(tuples):
    return sorted(tuples, key=lambda row: [(value is None, str(value)) for value in row])


def rows(df):
    """All rows as sorted tuples."""
    return ordered(tuple(row) for row in df.collect())


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def left_by(spark, step):
    """Shuffle files that a step leaves; they go shortly after it."""
    before = shuffle_files(spark)
    step()
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left
