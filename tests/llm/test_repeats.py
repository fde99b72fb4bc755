import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from llm_helpers import ODD, TEXT

from tallyhouse.llm import bytespans, passages, repeats
from tallyhouse.llm.repeats import Piece
from tallyhouse.llm.suffixes import sorted_suffixes


def made(seed, words=6, count=14):
    """Texts that share passages in many ways: copies, cut-outs, repeats within a text, runs of one word."""
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("ab cd ef gh ij".split()[:words]) for _ in range(rnd.randint(3, 30))) for _ in range(4)]
    return [(k * 3, " ".join(rnd.choice(pool) if rnd.random() < 0.6 else f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(0, 8)))) for k in range(count)]


@pytest.mark.parametrize("hot", [2_000, 0])
def test_passages_equal_the_plain_version(spark, documents, hot):
    rows = [r for seed in range(3) for r in ((i + 100 * seed, t) for i, t in made(seed))] + ODD
    got = passages.report(documents(rows), window=6, hot=hot).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain.passages(rows, 6)))


@pytest.mark.parametrize("hot", [2_000, 0])
def test_bytes_equal_the_plain_version(spark, documents, hot):
    rows = [r for seed in range(3) for r in ((i + 100 * seed, t) for i, t in made(seed))] + [(i, t if t is None else t[:4000]) for i, t in ODD]
    got = bytespans.report(documents(rows), window=20, hot=hot, shard_bytes=500, queue_bytes=64).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain.bytespans(rows, 20)))


def shared(count):
    """Documents that hold one passage between otherwise different text, some of them twice."""
    rnd = random.Random(3)
    passage = " ".join(f"p{rnd.randint(0, 99)}" for _ in range(30))
    own = lambda: " ".join(f"w{rnd.randint(0, 9999)}" for _ in range(12))
    return [(k, f"{own()} {passage} {own()}" + (f" {passage}" if k % 5 == 0 else "")) for k in range(count)]


def test_a_hot_window_costs_a_task_one_row():
    count, text, window = 50, b"a passage that all of these documents hold, and nothing else", 20
    asked = [[{"anchor": 1, "first": 0, "windows": len(text) - window + 1, "copies": 1, "verdict": repeats.SINGLES}]] * count
    batch = pa.RecordBatch.from_arrays([pa.array(range(count)), pa.array(range(count)), pa.array([text] * count), pa.array(asked)], names=["k", "id", "t", "a"])
    for spare_first in (True, False):
        spec = repeats.Windows(repeats.Bytes, window, 8, spare_first)
        rows = [r for b in repeats._fetch(spec)(iter([batch])) for r in b.to_pylist()]
        windows = [r for r in rows if r["copies"]]
        assert len(windows) == len({r["shard"] for r in windows}) == len(text) - window + 1
        assert {r["copies"] for r in windows} == {count} and {r["_row"] for r in windows} == {0}
        assert [(r["_row"], r["first"], r["windows"]) for r in rows if not r["copies"]] == [(k, 0, len(windows)) for k in range(1, count)]


@pytest.mark.parametrize("spare_first", [True, False])
@pytest.mark.parametrize("size", [1, 3, 100])
def test_rows_of_one_window_are_merged_across_batches(size, spare_first):
    spec = repeats.Windows(repeats.Bytes, 20, 8, spare_first)
    #       shard, mark, key, first, windows, copies
    rows = [(1, 1, 5, 0, 1, 1), (1, 1, 6, 0, 1, 1), (1, 1, 7, 0, 1, 1), (1, 2, 5, 9, 1, 1), (2, 2, 5, 3, 1, 1), (2, 2, 5, 4, 1, 2),
            (3, 0, 8, 2, 4, 0), (4, 1, 6, 6, 1, 2), (5, 1, 6, 7, 1, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*((*r, None) for r in rows[at:at + size])), repeats._PIECE)], schema=repeats._PIECE)
               for at in range(0, len(rows), size)]
    got = sorted(tuple(r.values()) for b in repeats._compare(spec, lambda pieces: [], 100)(iter(batches)) for r in b.to_pylist())
    firsts = [] if spare_first else [(5, 0, 1), (5, 3, 1), (6, 6, 1)]
    assert got == sorted([(6, 0, 1), (7, 0, 1), (5, 4, 1), (8, 2, 4), *firsts])


@pytest.mark.parametrize("hot", [2_000, 3])
def test_a_passage_in_many_documents(spark, documents, hot):
    rows, held = shared(40), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = passages.report(documents(rows).repartition(3), window=6, hot=hot).collect()
        assert sorted(map(tuple, got)) == plain.passages(rows, 6)
        got = bytespans.report(documents(rows).repartition(3), window=20, hot=hot).collect()
        assert sorted(map(tuple, got)) == plain.bytespans(rows, 20)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)


def test_production_windows(spark, documents):
    rows = [(1, TEXT * 4), (2, "start " + TEXT * 2 + "end"), (3, TEXT), (4, "nothing of it")]
    assert sorted(map(tuple, passages.report(documents(rows)).collect())) == plain.passages(rows, 35)
    assert sorted(map(tuple, bytespans.report(documents(rows)).collect())) == plain.bytespans(rows, 100)


def test_empty_table(spark, documents):
    assert passages.report(documents([])).collect() == []
    assert bytespans.report(documents([])).collect() == []


def test_matches_counts_copies():
    once = Piece(b"a b c d", 1, 0, 2, 1)
    assert [x.tolist() for x in passages.matches([once], 3)] == [[False, False]]
    assert [x.tolist() for x in passages.matches([Piece(b"a b c d", 1, 0, 2, 2)], 3)] == [[True, True]]
    assert [x.tolist() for x in passages.matches([once, Piece(b"x b c d", 2, 0, 2, 1)], 3)] == [[False, True], [False, True]]


@pytest.mark.parametrize("queue_bytes", [1, 1 << 20])
def test_suffixes_are_sorted_and_prefixes_counted(queue_bytes):
    rnd = random.Random(5)
    for _ in range(150):
        text = [rnd.randint(1, rnd.choice([1, 2, 4])) for _ in range(rnd.randint(0, 50))] + [0]
        order, common = sorted_suffixes(np.array(text, np.int32), 9, queue_bytes)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [text[i:i + 9] for i in order]
        assert keys == sorted(keys)
        for k in range(1, len(order)):
            shared = next((n for n, (x, y) in enumerate(zip(keys[k - 1], keys[k])) if x != y), min(len(keys[k - 1]), len(keys[k])))
            assert common[k] == shared


@pytest.mark.parametrize("size", [5, 10, 11, 12, 40])
def test_neighbouring_hot_anchors_stay_hot_across_batches(size):
    spec = repeats.Windows(repeats.Bytes, 20, 8, spare_first=True, hot=1)
    rows = [(anchor, stretch, 10 * stretch, 0, 3, 1) for anchor in (1, 2, 3) for stretch in range(11)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + size]), repeats._ANCHOR)], schema=repeats._ANCHOR)
               for at in range(0, len(rows), size)]
    got = [r for b in repeats._settle(spec)(iter(batches)) for r in b.to_pylist()]
    assert len(got) == len(rows)
    assert {r["verdict"] for r in got} == {repeats.SINGLES}
