import pytest
from row_helpers import rows

from tallyhouse.operators.metrics import counted, load_metrics, misfits
from tallyhouse.operators.progress import mark_done, mark_fetched, not_done, pending


@pytest.fixture(scope="module")
def header(spark):
    return spark.createDataFrame([("a", False), ("b", True), ("c", False)], "uniqueOrderId string, fetchSales boolean")


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "uniqueOrderId string")


def test_mark_done_keeps_other_flags_and_row_count(spark, header):
    marked = mark_done(header, ids(spark, "a", "a", "x"), "uniqueOrderId", "fetchSales")
    assert rows(marked) == [("a", True), ("b", True), ("c", False)]
    assert marked.columns == header.columns


def test_mark_fetched_scopes(spark, header):
    requested, loaded = not_done(header, "fetchSales"), ids(spark, "a")
    assert rows(mark_fetched(header, requested, loaded, "fetchSales")) == [("a", True), ("b", True), ("c", True)]
    assert rows(mark_fetched(header, requested, loaded.limit(0), "fetchSales")) == rows(header)
    assert rows(mark_fetched(header, requested, loaded, "fetchSales", scope="returned")) == [
        ("a", True), ("b", True), ("c", False)]
    with pytest.raises(ValueError):
        mark_fetched(header, requested, loaded, "fetchSales", scope="some")


def test_pending_is_derived_from_the_target(spark, header):
    assert [r[0] for r in rows(pending(header, ids(spark, "b", "b"), "uniqueOrderId"))] == ["a", "c"]


def test_metrics(spark, header):
    assert rows(load_metrics({"batch": header, "none": header.limit(0)})) == [("batch", 3, 2), ("none", 0, 2)]
    df, observation = counted(header, "batch")
    df.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 3


def test_misfits_are_counted_by_field(spark):
    df = spark.createDataFrame([("1", "2022-06-20"), ("x", "soon"), (None, "later")], "`a.b` string, day string")
    fields = [("a.b", "n", "bigint"), ("day", "day", "date")]
    assert rows(misfits(df, fields)) == [("a.b", 1), ("day", 2)]
