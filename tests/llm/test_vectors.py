import hashlib
import random
from math import floor, isfinite

import numpy as np
import pytest

from tallyhouse.llm import centroids, hard_negatives
from tallyhouse.llm.vectors import whole

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def ends(value):
    return min(max(value, LEAST), MOST)


def quantised(vector, scale):
    return [ends(floor(scale * float(np.float32(x)))) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and isfinite(x) for x in vector)


@pytest.fixture
def embeddings(spark):
    """A function from (vec_id, vector, label) rows to a table with further, clashing columns."""
    def make(rows):
        wide = [(i, v, label, 1, 2, "x", 3.0) for i, v, label in rows]
        kind = "vec_id long, embedding array<float>, label int, rank int, _id long, cluster string, _score double"
        return spark.createDataFrame(wide, kind).repartition(3)
    return make


def table(n, width, seed, spread=1.0):
    draw = random.Random(seed)
    return [(k, [draw.gauss(0, spread) for _ in range(width)], draw.randrange(4)) for k in range(n)]


ODD = [(1000, None, 1), (1001, [1.0, None, 2.0, 0.0], 1), (1002, [1.0, float("nan"), 2.0, 0.0], 1), (1003, [float("inf"), 1.0, 2.0, 0.0], 1),
       (1004, [0.5, 0.5, 0.5, 0.5], None), (None, [0.5, 0.5, 0.5, 0.5], 1), (1006, [], 1), (1007, [0.5], 1), (1050, [0.25] * 5, 2)]


# ---- hard negatives ----

def plain_negatives(rows):
    kept = [(i, quantised(v, 256), (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows
            if i is not None and label is not None and usable(v)]
    out = []
    for at, (anchor, x, label) in enumerate(kept):
        if anchor % 50:
            continue
        scored = sorted(((-ends(sum(a * b for a, b in zip(x, y))), i, other) for k, (i, y, other) in enumerate(kept) if k != at and len(y) == len(x)))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            band = [s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score][:3]
            out += [(anchor, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(band, 1)]
    return sorted(out)


@pytest.mark.parametrize("rows", [
    pytest.param([*table(400, 4, 1), *ODD], id="odd rows"),
    pytest.param([*table(150, 4, 2), *table(60, 4, 2)], id="repeated rows"),
    pytest.param([(k % 150, [0.5, 0.25, 0.5, 0.125], k % 3) for k in range(300)], id="ties"),
    pytest.param([*table(120, 4, 3), *((i + 200, v, c) for i, v, c in table(120, 4, 4, 3e6)), *((i + 400, v, c) for i, v, c in table(120, 4, 5, 1e30))], id="large"),
    pytest.param([(i, v[:k], c) for k in (2, 4) for i, v, c in table(101, 4, 6)], id="widths"),
    pytest.param([], id="none"),
])
def test_negatives_equal_brute_force(embeddings, rows):
    got = hard_negatives.report(embeddings(rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_negatives_in_many_groups_and_tiles(embeddings, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_TILE_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "_TILE_ANCHORS", 3)
    rows = table(600, 4, 7)
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    from pyspark.sql import functions as F
    got = hard_negatives.mine(embeddings(moved), F.col("vec_id") % 50 == 0, "vec_id", "embedding", "label", group_components=20)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


@pytest.mark.parametrize("top", [0, 1, 300, 1 << 20, 1 << 33, 1 << 62])
def test_products_are_exact(top):
    draw = random.Random(top)
    for q, n, d in ((1, 1, 1), (5, 7, 3), (17, 33, 64), (3, 2, 1)):
        a, x = ([[draw.randint(-top, top) for _ in range(d)] for _ in range(rows)] for rows in (q, n))
        if top > 300:  # some vectors are small
            x[0] = [draw.randint(-3, 3) for _ in range(d)]
        want = [[ends(sum(map(int.__mul__, one, other))) for other in x] for one in a]
        assert hard_negatives.products(np.array(a, np.int64), np.array(x, np.int64)).tolist() == want


def test_best_keeps_the_first_of_many_ties():
    best = hard_negatives.Best(2, 3)
    ids = np.arange(1000)
    scores = np.tile(np.array([[7], [-(1 << 60)]]), (1, 1000))
    for _ in range(2):
        best.add(0, scores, np.ones_like(scores, bool), ids + 5)
    best.add(0, scores + 1, np.ones_like(scores, bool) & (ids == 999), ids)
    for places, found, numbers in best.rows():
        assert list(zip(places.tolist(), numbers.tolist())) == [(0, 999), (0, 5), (0, 5), (1, 999), (1, 5), (1, 5)]


# ---- clusters ----

def plain_clusters(rows, width, k=16, rounds=3):
    kept = [(i, quantised(v, 64)) for i, v, _ in rows if usable(v) and len(v) == width]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in first[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[0], []).append(v)
        centers = [[sum(x) // len(own[c]) for x in zip(*own[c])] if c in own else old for c, old in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    total = ends(sum(inertia.values()))
    return sorted((str(i), c, ends(d), ends(inertia[c]), total, digests[c]) for i, c, d in found)


@pytest.mark.parametrize("rows, width", [
    pytest.param([*table(700, 4, 1), *ODD], 4, id="odd rows"),
    pytest.param([*table(100, 3, 2), *table(100, 3, 2), *((7, [0.5, 0.5, 0.25], 1) for _ in range(300))], 3, id="repeated rows"),
    pytest.param([(k, [float(k % 3), 1.0], 0) for k in range(100)], 2, id="ties"),
    pytest.param([*table(60, 4, 3), *((i + 100, v, c) for i, v, c in table(60, 4, 4, 1e6)), *((i + 200, v, c) for i, v, c in table(40, 4, 5, 1e30))], 4, id="large"),
    pytest.param(table(9, 5, 6), 5, id="few"),
    pytest.param([(None, v, c) for _, v, c in table(30, 2, 7)], 2, id="no ids"),
    pytest.param([], 4, id="none"),
])
def test_clusters_equal_brute_force(embeddings, rows, width):
    got = centroids.cluster(embeddings(rows), width=width, block_rows=16)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == plain_clusters(rows, width)


def test_neighbours_on_the_curve_are_neighbours_in_space():
    bits, width = 3, 2
    cells = np.array([(a, b) for a in range(1 << bits) for b in range(1 << bits)])
    keys = centroids.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array(keys, dtype=object), kind="stable")]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all() and width == path.shape[1]


def test_no_candidate_is_lost_and_far_ones_are_dropped():
    draw = np.random.default_rng(5)
    dropped = 0
    for _ in range(300):
        sides = draw.integers(-20, 20, (8, 3)).astype(float)
        sides[5] = sides[2]  # a tie everywhere: the smaller number wins
        x = draw.integers(-20, 20, 3) + draw.integers(-3, 4, (40, 3))
        near = centroids.candidates(x.min(axis=0).astype(float), x.max(axis=0).astype(float), sides, (sides ** 2).sum(axis=1))
        far = ((x[:, None, :] - sides) ** 2).sum(axis=2)
        assert set(far.argmin(axis=1)) <= set(near.tolist())
        dropped += 8 - len(near)
    assert dropped > 300


def test_whole_numbers_of_components(spark):
    row = spark.createDataFrame([([0.999, -0.001, 3e38, -3e38],)], "v array<float>").select(whole("v", 64).alias("v")).first()
    assert row.v == [63, -1, MOST, LEAST]
