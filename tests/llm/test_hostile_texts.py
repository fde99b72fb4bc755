"""Texts and tables made to mislead: words whose sums of powers collide, clashing columns, large items and headers."""

import io

import plain
import pytest

from tallyhouse.llm import decontaminate, ngram_join, passages, warc
from tallyhouse.llm.common import free_name


def doubling(first, second, times):
    """A word that is doubled with its two letters swapped each time."""
    word, twin = first, second
    for _ in range(times):
        word, twin = word + twin, twin + word
    return word, twin


@pytest.mark.parametrize("times", [5, 6, 10, 13])
@pytest.mark.parametrize("letters", ["ab", "09", "éü"])
def test_doubling_words_are_told_apart(documents, times, letters):
    word, twin = doubling(*letters, times)
    rows = [(1, word), (2, twin), (3, word)]
    got = {r.doc_id: r.component_id for r in ngram_join.report(documents(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    tail = " ".join(f"w{k}" for k in range(34))
    rows = [(1, f"{word} {tail}"), (2, f"{twin} {tail}")]
    assert {r.doc_id: r.n_removed for r in passages.report(documents(rows)).collect()} == {1: 0, 2: 0}
    rows.append((3, f"{twin} {tail}"))
    assert {r.doc_id: r.n_removed for r in passages.report(documents(rows)).collect()} == {1: 0, 2: 35, 3: 35}


ITEMS = [(1, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11")]


@pytest.mark.parametrize("shard_words", [200_000, 3])
def test_clean_keeps_columns_that_look_like_its_own(spark, shard_words):
    kind = "doc_id long, text string, _n_words string, _spans string, _ITEMS int, _n_words_ int"
    table = spark.createDataFrame([(1, f"x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12. {ITEMS[0][1]}! end", "n", "s", 7, 8), (2, None, None, None, None, None)], kind)
    items = spark.createDataFrame([*ITEMS, (2, "z1 z2 z3 z4")], "item_id long, text string")
    kept = decontaminate.clean(table, items, shard_words=shard_words)
    assert kept.schema == table.schema
    assert {tuple(r) for r in kept.collect()} == {(1, "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12. ! end", "n", "s", 7, 8), (2, None, None, None, None, None)}


def test_any_number_of_items(spark, documents):
    items = [(k, " ".join(f"i{k}x{j}" for j in range(4))) for k in range(70)]
    rows = [(k, f"start {text} end") for k, text in items[:3]] + [(99, "none of them")]
    got = decontaminate.report(documents(rows), spark.createDataFrame(items, "item_id long, text string"), shard_words=4).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain.contamination(rows, items, 10)))


def test_free_names():
    assert free_name("_a", ["b"]) == "_a"
    assert free_name("_a", ["_A", "_a_"]) == "_a__"


def test_long_addresses_come_back(spark):
    url = "http://example.org/" + "p" * (3 << 20)
    pages = spark.createDataFrame([(1, url, "<p>" + "x" * 200)], "page_id long, url string, html string")
    assert [(r.page_id, r.payload_bytes, r.record_type) for r in warc.roundtrip(pages).collect()] == [(1, 203, "response")]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(b"no archive")))
