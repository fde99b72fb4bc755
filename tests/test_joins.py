import pytest
from row_helpers import rows

from tallyhouse.operators.joins import hot_keys, join_dimension, join_on_keys, small_sides


@pytest.fixture(scope="module")
def sides(spark):
    facts = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(60)] + [(None, -1), ("gone", -2)],
        "k string, n int")
    other = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 60, 2)] + [(None, "N")],
                                  "k string, v string")
    return facts, other


def test_hot_keys_finds_the_heavy_key_only(sides):
    facts, _ = sides
    assert len(hot_keys(facts, ["k"], min_rows=100)) == 1
    assert hot_keys(facts, ["k"]) == ()
    assert hot_keys(facts.filter("n > 1000"), ["k"], min_rows=1) == ()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("salts", [1, 7])
@pytest.mark.parametrize("min_rows", [1, 100])
def test_salting_hot_keys_changes_no_row(sides, how, salts, min_rows):
    facts, other = sides
    hot = hot_keys(facts, ["k"], min_rows=min_rows)
    joined = join_on_keys(facts, other, ["k"], how, hot, salts)
    plain = facts.join(other, ["k"], how)
    assert joined.columns == plain.columns and rows(joined) == rows(plain)


def test_a_salted_join_reads_each_side_once(sides, capsys):
    facts, other = sides
    join_on_keys(facts, other, ["k"], "inner", hot_keys(facts, ["k"], min_rows=100)).explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 2


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_dimension_join_is_the_same_broadcast_or_not(sides, small, how):
    facts, other = sides
    assert rows(join_dimension(facts, other, ["k"], how, small)) == rows(facts.join(other, ["k"], how))


def test_small_sides_measures_bytes(spark):
    wide = spark.range(50).selectExpr("repeat('x', 1000) AS t")
    assert small_sides({"wide": wide, "tiny": spark.range(2), "none": spark.range(0)}, 10_000) == {"tiny", "none"}


def test_keys_of_different_type_are_refused(spark):
    with pytest.raises(TypeError):
        join_on_keys(spark.createDataFrame([("1",)], "k string"), spark.range(3).toDF("k"), ["k"], "inner", (1,))
    with pytest.raises(ValueError):
        join_on_keys(spark.range(1), spark.range(1), ["id"], "full")
