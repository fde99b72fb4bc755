from datetime import date, datetime

from pyspark.sql import functions as F

from tallyhouse.functions import columns as c


def values(spark, kind, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_time_part(spark):
    data = ["2022-06-20T10:15:00", "10:15", "", None, "aTbTc"]
    assert values(spark, "string", data, c.time_part(F.col("v"))) == ["10:15:00", "10:15", "", None, "c"]


def test_item_name(spark):
    data = ["  roll / hot / x", "roll", " /x", "", None]
    assert values(spark, "string", data, c.item_name(F.col("v"))) == ["roll", "roll", "", "", None]


def test_display_date_of_text_dates_and_bad_text(spark):
    data = ["2022-06-20", "2022-06-20T00:00:00", "20 June", "", None]
    assert values(spark, "string", data, c.display_date(F.col("v"))) == ["20/06/2022", "20/06/2022", None, None, None]
    assert values(spark, "date", [date(2022, 1, 2)], c.display_date(F.col("v"))) == ["02/01/2022"]
    assert values(spark, "timestamp", [datetime(2022, 1, 2, 23)], c.display_date(F.col("v"))) == ["02/01/2022"]


def test_row_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "o string, p string")
    assert [r[0] for r in df.select(c.row_key(F.col("o"), F.col("p"))).collect()] == ["a-x", None, None]


def test_order_source_and_mark(spark):
    data = [None, "", "CloudCallCenter", "Web", "cloudcallcenter"]
    assert values(spark, "string", data, c.order_source(F.col("v"), F.lit("type"))) == [
        "type", "type", "type", "Web", "cloudcallcenter"]
    assert values(spark, "string", data, c.call_centre_mark(F.col("v"))) == ["NO", "NO", "CC", "NO", "NO"]


def test_credited_to(spark):
    df = spark.createDataFrame([
        (1, "", "Aggregator Payment"), (2, "", "Aggregator Payment old"), (3, "", "Card"), (4, "", None),
        (5, "house", "Aggregator Payment"), (6, None, "Aggregator Payment")], "i int, credit string, kind string")
    got = df.orderBy("i").select(c.credited_to(F.col("credit"), F.col("kind"), F.lit("Web"))).collect()
    assert [r[0] for r in got] == ["Web", "Web", "", "", "house", None]


def test_blank_nulls_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None, None)], "t string, n double, f boolean")
    assert tuple(c.blank_nulls(df).first()) == ("", None, None)
