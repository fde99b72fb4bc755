"""Hard negatives by exact inner products: rows of other labels that come close to an anchor's positives.

All anchors are compared with all rows, in blocks. Products are packed: the components of several candidates, biased so
that none is negative, stand in separate fields of one wide integer; multiplied by an anchor's component and summed over
the components, each field holds a candidate's score, because it is wide enough for the largest sum. A wide integer of
at most 53 bits is kept as a double, in which sums and products of such numbers are exact, so a matrix product does the
multiplying; where the numbers at hand need wider fields, the integers are Python's, of any width.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import record, written
from tallyhouse.llm.vectors import is_finite, matrices, whole
from tallyhouse.sources.scratch import scratch_path

# Components of the anchors that are compared in one pass over the rows; bounds what is broadcast (8 bytes each).
GROUP_COMPONENTS = 1 << 20
# Rows and anchors whose scores are held at once.
_TILE_ROWS, _TILE_ANCHORS = 4096, 512
# Whole numbers that a double holds exactly.
_EXACT_BITS = 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
# Vectors with larger components are multiplied apart from the others.
_LARGE = 1 << 20
# Scores below this can carry a tile's column number along in a long.
_NARROW = 1 << 50


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows, whole numbers of equal width; beyond a long: the end of its range."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    large = [((side > _LARGE) | (side < -_LARGE)).any(axis=1) for side in (anchors, rows)]
    if not large[0].any() and not large[1].any():
        found = _packed(anchors, rows)
        return _wide(anchors, rows) if found is None else found
    out = np.empty((len(anchors), len(rows)), np.int64)
    for apart in (large[0], ~large[0]):
        for others in (large[1], ~large[1]):
            if apart.any() and others.any():
                both_small = not large[0][apart].any() and not large[1][others].any()
                out[np.ix_(apart, others)] = (products if both_small else _wide)(anchors[apart], rows[others])
    return out


def _packed(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray | None:
    """Products by packed doubles, or none if a field does not fit."""
    low = int(rows.min())
    most = int(np.abs(anchors).sum(axis=1).max()) * (int(rows.max()) - low)
    width = (2 * most + 1).bit_length()
    fields = _EXACT_BITS // width
    if not fields:
        return None
    places = -(-len(rows) // fields)
    biased = np.zeros((places * fields, rows.shape[1]), np.int64)
    biased[:len(rows)] = rows - low
    packed = sum(biased[f * places:(f + 1) * places] << (width * f) for f in range(fields))
    sums = (anchors.astype(np.float64) @ packed.T.astype(np.float64)).astype(np.int64)
    middle = 1 << (width - 1)
    sums += sum(middle << (width * f) for f in range(fields))  # now no field is negative
    mask = (1 << width) - 1
    scores = np.concatenate([((sums >> (width * f)) & mask) for f in range(fields)], axis=1)[:, :len(rows)]
    scores += (low * anchors.sum(axis=1) - middle)[:, None]
    return scores


def _wide(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Products by one integer per component that holds all rows, in fields of whole bytes."""
    signed, others = anchors.tolist(), rows.tolist()
    low, high = min(map(min, others)), max(map(max, others))
    size = ((2 * max(sum(map(abs, a)) for a in signed) * (high - low) + 1).bit_length() + 7) // 8
    middle, n = 1 << (8 * size - 1), len(others)
    packed = [int.from_bytes(b"".join((v - low).to_bytes(size, "little") for v in column), "little") for column in zip(*others)]
    middles = int.from_bytes(middle.to_bytes(size, "little") * n, "little")
    out = np.empty((len(signed), n), np.int64)
    for k, anchor in enumerate(signed):
        sums = (middles + sum(a * p for a, p in zip(anchor, packed))).to_bytes(size * n, "little")
        shift = low * sum(anchor) - middle
        out[k] = [min(max(int.from_bytes(sums[j:j + size], "little") + shift, _LEAST), _MOST) for j in range(0, size * n, size)]
    return out


class Best:
    """The best `k` (score, id) for every place of a list, higher scores and then smaller ids first."""

    def __init__(self, places: int, k: int):
        self.k = k
        self.scores = np.zeros((places, k), np.int64)
        self.ids = np.zeros((places, k), np.int64)
        self.filled = np.zeros(places, np.int64)

    def add(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Take the allowed (place, row) scores of a tile whose places start at `first`; `ids` of its rows ascend."""
        n, span = len(scores), slice(first, first + len(scores))
        full = self.filled[span] == self.k
        last = np.where(full, self.scores[span, -1], _LEAST)
        allowed = allowed & (scores >= last[:, None])
        place, row = np.nonzero(allowed)
        if len(place) > 16 * self.k * n:
            place, row = self._few(scores, allowed)
        if not len(place):
            return
        held = np.arange(self.k) < self.filled[span][:, None]
        at = np.concatenate([np.nonzero(held)[0], place])
        all_scores = np.concatenate([self.scores[span][held], scores[place, row]])
        all_ids = np.concatenate([self.ids[span][held], ids[row]])
        # The bits of a score turned over order it from high to low without leaving the range.
        order = np.lexsort((all_ids, ~all_scores, at))
        at, all_scores, all_ids = at[order], all_scores[order], all_ids[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        best = rank < self.k
        self.scores[span][at[best], rank[best]] = all_scores[best]
        self.ids[span][at[best], rank[best]] = all_ids[best]
        self.filled[span] = np.bincount(at[best], minlength=n)

    def _few(self, scores: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The allowed pairs without those that `k` others of the tile are ahead of."""
        columns = scores.shape[1]
        if scores.max() >= _NARROW or scores.min() <= -_NARROW:
            scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
        keys = np.where(allowed, scores * columns + np.arange(columns - 1, -1, -1), _LEAST)
        top = np.argpartition(keys, columns - self.k, axis=1)[:, -self.k:] if columns > self.k else np.tile(np.arange(columns), (len(keys), 1))
        place = np.repeat(np.arange(len(keys)), top.shape[1])
        row = top.ravel()
        there = allowed[place, row]
        return place[there], row[there]

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places, scores and ids of all that is held."""
        held = np.arange(self.k) < self.filled[:, None]
        yield np.nonzero(held)[0], self.scores[held], self.ids[held]


class Anchors:
    """Anchors of one pass, by width: their numbers in the group, components and labels."""

    def __init__(self, numbers: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.numbers, self.vectors, self.labels = numbers, vectors, labels

    def tiles(self) -> Iterator[tuple[int, Anchors]]:
        for first in range(0, len(self.numbers), _TILE_ANCHORS):
            part = slice(first, first + _TILE_ANCHORS)
            yield first, Anchors(self.numbers[part], self.vectors[part], self.labels[part])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids in ascending order, labels and vectors of equal width, of at most a tile's rows."""
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        for rows, vectors in matrices(batch, 2):
            for first in range(0, len(rows), _TILE_ROWS):
                part = rows[first:first + _TILE_ROWS]
                order = np.argsort(ids[part], kind="stable")
                yield ids[part][order], labels[part][order], vectors[first:first + _TILE_ROWS][order]


_FOUND = pa.schema([("_place", pa.int64()), ("_score", pa.int64()), ("_found", pa.int64())])
_FOUND_AS = "_place long, _score long, _found long"


def _best_rows(places: DataFrame, k: int) -> DataFrame:
    """The best `k` rows of each place, of those that the tasks found; each task's rows are cut to `k` before they move."""
    order = Window.partitionBy("_place").orderBy(F.col("_score").desc(), F.col("_found").asc())
    return places.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def _search(rows: DataFrame, anchors: list[Anchors], k: int, slots: int, wanted) -> DataFrame:
    """The best `k` rows for each anchor and slot; `wanted(anchors, scores, labels)` says which, slot by slot.

    A place is an anchor's number times `slots`, plus the slot.
    """
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width = {side.vectors.shape[1]: side for side in shared.value}
        best = {width: [Best(len(side.numbers), k) for _ in range(slots)] for width, side in by_width.items()}
        for ids, labels, vectors in _tiles(batches):
            width = vectors.shape[1]
            for first, tile in by_width[width].tiles() if width in by_width else ():
                scores = products(tile.vectors, vectors)
                for slot, allowed in enumerate(wanted(tile, scores, labels)):
                    best[width][slot].add(first, scores, allowed, ids)
        for width, each in best.items():
            for slot, one in enumerate(each):
                for place, score, found in one.rows():
                    yield record(_FOUND, [pa.array(by_width[width].numbers[place] * slots + slot), pa.array(score), pa.array(found)])

    return _best_rows(rows.mapInArrow(search, _FOUND_AS), k)


def _by_width(table: pa.Table) -> tuple[list[Anchors], np.ndarray]:
    """Anchors by width, and each one's product with itself."""
    batch = table.combine_chunks().to_batches()[0]
    labels, sides, own = batch.column(1).to_numpy(), [], np.zeros(batch.num_rows, np.int64)
    for numbers, vectors in matrices(batch, 2):
        sides.append(Anchors(numbers, vectors, labels[numbers]))
        for first in range(0, len(numbers), 64):
            part = slice(first, first + 64)
            own[numbers[part]] = np.diagonal(products(vectors[part], vectors[part]))
    return sides, own


def _positives(found: pa.Table, ids: np.ndarray, own: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """The first `k` other rows of each anchor, as (score, id): one row with its own id and score is the anchor itself."""
    lists: list[list[tuple[int, int]]] = [[] for _ in ids]
    for place, score, other in sorted(zip(*(found.column(n).to_pylist() for n in ("_place", "_score", "_found"))), key=lambda r: (r[0], -r[1], r[2])):
        lists[place].append((score, other))
    for rows, self_id, self_score in zip(lists, ids.tolist(), own.tolist()):
        if (self_score, self_id) in rows:
            rows.remove((self_score, self_id))
        del rows[k:]
    return lists


def mine(vectors: DataFrame, is_anchor: Column, id_col: str, vec_col: str, label_col: str, scale: int = 256, n_positives: int = 5,
         n_negatives: int = 3, low: int = 50, high: int = 95, group_components: int = GROUP_COMPONENTS) -> DataFrame:
    """For each anchor and each of its first `n_positives` rows, the first `n_negatives` rows of other labels in the band.

    Components become floor(scale * x). Scores are inner products; higher ones come first, then smaller ids. An anchor's
    positives are other rows of its label. A negative's score, in percent of the positive's, is at least `low` and at
    most `high`: low * positive <= 100 * negative <= high * positive, so a negative positive score has none.

    Rows with a null label, a null vector, or a null or non-finite component take no part, and neither do rows without
    an id, which no result could name. Repeated rows are rows of their own: a copy of an anchor is an anchor and another row.
    Vectors of different widths have no score. Scores and components beyond a long are the end of its range. Other
    columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(is_finite(F.col(vec_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marked = kept.select(
        F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("bigint").alias("_label"), whole(F.col(vec_col), scale).alias("_vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("_anchor"))
    rows = written(marked, "vectors")
    # Equal anchors are compared once.
    anchors = rows.filter("_anchor").groupBy("_id", "_label", "_vector").agg(F.count(F.lit(1)).alias("_copies"))
    anchors = written(anchors, "anchors")
    size = anchors.agg(F.sum(F.size("_vector") + 1)).first()[0] or 0
    groups = -(-size // group_components)
    grouped = scratch_path(spark, "anchor-groups")
    dealt = anchors.withColumn("_group", F.pmod(F.xxhash64("_id", "_label", "_vector"), F.lit(max(groups, 1))))
    dealt.repartition("_group").write.partitionBy("_group").parquet(grouped)
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not groups:
        return spark.createDataFrame([], columns)
    candidates, out = rows.select("_id", "_label", "_vector"), scratch_path(spark, "negatives")
    for number in range(groups):
        group = spark.read.schema(dealt.schema).parquet(grouped).filter(F.col("_group") == number).select("_id", "_label", "_vector", "_copies").toArrow()
        if group.num_rows:
            _mine_group(candidates, group, n_positives, n_negatives, low, high).write.mode("append").parquet(out)
    return spark.read.schema(columns).parquet(out)


def _mine_group(rows: DataFrame, group: pa.Table, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame:
    """The negatives of one bounded group of anchors, in two passes over the rows."""
    ids, copies = (group.column(n).to_numpy() for n in ("_id", "_copies"))
    anchors, own = _by_width(group)

    def same_label(tile: Anchors, scores: np.ndarray, labels: np.ndarray) -> Iterator[np.ndarray]:
        yield tile.labels[:, None] == labels

    # The anchor itself may be among its first rows.
    found = _search(rows, anchors, n_positives + 1, 1, same_label).select("_place", "_score", "_found").toArrow()
    positives = _positives(found, ids, own, n_positives)
    least, most = (np.zeros((len(ids), n_positives), np.int64) for _ in range(2))
    least += 1  # from 1 to 0: an empty band
    for k, each in enumerate(positives):
        for slot, (score, _) in enumerate(each):
            bounds = -(-low * score // 100), high * score // 100
            if bounds[0] <= bounds[1]:
                least[k, slot], most[k, slot] = (min(max(b, _LEAST), _MOST) for b in bounds)

    def in_band(tile: Anchors, scores: np.ndarray, labels: np.ndarray) -> Iterator[np.ndarray]:
        other = tile.labels[:, None] != labels
        for slot in range(n_positives):
            bottom, top = (side[tile.numbers, slot][:, None] for side in (least, most))
            yield other & (scores >= bottom) & (scores <= top)

    negatives = _search(rows, anchors, n_negatives, n_positives, in_band)
    # Bounded by the group: what each place stands for.
    places = [(k * n_positives + slot, int(ids[k]), other, score, int(copies[k])) for k, each in enumerate(positives) for slot, (score, other) in enumerate(each)]
    names = rows.sparkSession.createDataFrame(places, "_place long, anchor_id long, positive_id long, positive_score long, _copies long")
    return negatives.join(F.broadcast(names), "_place").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(
        "anchor_id", "positive_id", F.col("_rank").cast("int").alias("rank"), F.col("_found").alias("negative_id"), "positive_score",
        F.col("_score").alias("negative_score"))


def report(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", every: int = 50) -> DataFrame:
    """Hard negatives for the rows whose id is divisible by `every`; labels of ids divisible by 7 are moved to the next of ten."""
    label = F.col(label_col).cast("bigint")
    moved = embeddings.select(id_col, vec_col, F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label).alias(label_col))
    return mine(moved, F.col(id_col) % every == 0, id_col, vec_col, label_col)
