import pytest
from row_helpers import ordered, rows

from tallyhouse.operators.dedupe import find_duplicates, new_rows, sifted, stored_rows


@pytest.fixture(scope="module")
def tables(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5), ("", 6)], "k string, n int")
    stored = spark.createDataFrame([("a",), ("a",), ("a",), ("c",), ("z",), (None,)], "k string")
    return batch, stored


def test_new_and_stored_rows_split_the_batch(tables):
    batch, stored = tables
    new = rows(new_rows(batch, stored, "k"))
    old = rows(stored_rows(batch, stored, "k"))
    assert ordered(new + old) == rows(batch)
    assert old == [("a", 1), ("a", 2), ("c", 4)]


def test_duplicates_count_stored_copies(tables):
    batch, stored = tables
    assert rows(find_duplicates(batch, stored, "k")) == [("a", 1, 3), ("a", 2, 3), ("c", 4, 1)]


def test_two_keys(spark):
    batch = spark.createDataFrame([("s", "a"), ("t", "a")], "store string, k string")
    assert rows(new_rows(batch, batch.filter("store = 's'"), ["store", "k"])) == [("t", "a")]


def test_sifted_rows_hold_all_that_are_wanted(spark, tables):
    batch = spark.range(3000).selectExpr("CAST(id AS STRING) AS k", "id % 3 AS n").unionByName(tables[0].selectExpr("k", "CAST(n AS BIGINT) AS n"))
    wanted = batch.filter("n = 1").select("k")
    passed = sifted(batch, wanted, "k")
    assert passed.columns == ["k", "n"]
    assert set(rows(batch.filter("n = 1 OR k IS NULL"))) <= set(rows(passed)) and passed.count() < 1020
    # No key is wanted: only rows without one stay.
    assert rows(sifted(batch, wanted.limit(0), "k")) == [(None, 5)]


def test_stored_rows_go_before_they_are_moved(spark, tables):
    batch, stored = tables
    assert rows(new_rows(batch, stored, "k", sift=True)) == rows(new_rows(batch, stored, "k"))
    many = spark.range(4000).selectExpr("CAST(id AS STRING) AS k", "id AS n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = []
        for sift in (False, True):
            new = new_rows(many, many.filter("n >= 40"), "k", sift=sift)
            assert rows(new) == ordered((str(k), k) for k in range(40))
            # Rows that reach the join with the stored keys, in its exchange.
            moved.append(wide_rows(new))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved[0] == 4000 and moved[1] < 60


def wide_rows(df):
    """Rows written by the exchange of both columns of `df`, as its plan counted them."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name == "Exchange" and node.output().size() == 2:
            found.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}.get(name)
        children = [getattr(node, inner)()] if inner else [node.children().apply(i) for i in range(node.children().size())]
        for child in children:
            walk(child)

    walk(plan)
    return max(found)
