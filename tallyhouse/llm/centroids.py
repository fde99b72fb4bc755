"""Exact k-means over whole-number vectors, with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve and cut into blocks; a block keeps the least and the greatest value of
each component. From this box follows the least difference between a vector's distances to two centroids that any
vector inside can have, so a block drops every centroid that some other one beats for all of its vectors, and compares
its vectors with the candidates left, all at once. Blocks are made once and read in each round; a round returns counts
and sums of its clusters only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import record, written
from tallyhouse.llm.vectors import is_finite, whole

# Vectors of a block.
BLOCK_ROWS = 256
# Bits of each component along the curve.
CURVE_BITS = 2
# Up to these components, distances and bounds are exact as doubles.
_EXACT = 1 << 21
_MOST = (1 << 63) - 1
_BLOCK = pa.schema([(name, pa.list_(pa.int64())) for name in ("_ids", "_vectors", "_low", "_high")])
_BLOCK_AS = "_ids array<bigint>, _vectors array<bigint>, _low array<bigint>, _high array<bigint>"

Centroids = list[list[int]]


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of cells along a Hilbert curve, as byte strings in curve order; `cells` holds `bits` bits a component."""
    x = cells.T.astype(np.int64).copy()
    top = 1 << (bits - 1)
    step = top
    while step > 1:  # undo the turns of each level
        low = step - 1
        for k in range(len(x)):
            turned = (x[k] & step) != 0
            swap = np.where(turned, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[k] ^= swap
        step >>= 1
    for k in range(1, len(x)):  # Gray code
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    step = top
    while step > 1:
        turn ^= np.where((x[-1] & step) != 0, step - 1, 0)
        step >>= 1
    x ^= turn
    planes = np.concatenate([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


class Curve:
    """Cells of vectors: components in order of the centroids' spread, each cut over the centroids' range."""

    def __init__(self, centroids: Centroids, bits: int = CURVE_BITS):
        sides = np.array(centroids, np.float64)
        self.low, high = sides.min(axis=0), sides.max(axis=0)
        self.width = np.maximum(high - self.low, 1.0)
        self.order = np.argsort(-sides.var(axis=0), kind="stable")
        self.bits = bits

    def keys(self, vectors: np.ndarray) -> list[bytes]:
        cells = np.floor((vectors - self.low) / self.width * (1 << self.bits))
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1)[:, self.order], self.bits)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be the nearest of some vector in the box; whole numbers as doubles.

    Against the centroid nearest to the box's middle: the difference of the two distances is linear in the vector, so
    its least value over the box is taken component by component.
    """
    middle = (low + high) / 2
    best = int(np.argmin(squares - 2 * (centroids @ middle)))
    slopes = 2 * (centroids[best] - centroids)
    least = squares - squares[best] + np.minimum(slopes * low, slopes * high).sum(axis=1)
    # With equal distances the smaller number wins.
    numbers = np.arange(len(centroids))
    return np.flatnonzero((least < 0) | ((least == 0) & (numbers <= best)))


class Assigner:
    """Nearest centroids of blocks."""

    def __init__(self, centroids: Centroids):
        self.exact = centroids
        self.small = all(abs(v) <= _EXACT for c in centroids for v in c)
        if self.small:
            self.sides = np.array(centroids, np.float64)
            self.squares = (self.sides ** 2).sum(axis=1)

    def block(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of every vector, the latter as far as a long holds it. Ties go to the smaller number."""
        if not self.small or low.min() < -_EXACT or high.max() > _EXACT:
            return self._large(vectors)
        near = candidates(low.astype(np.float64), high.astype(np.float64), self.sides, self.squares)
        x = vectors.astype(np.float64)
        if len(near) == 1:
            chosen, part = np.full(len(x), near[0]), ((x - self.sides[near[0]]) ** 2).sum(axis=1)
            return chosen, part.astype(np.int64)
        far = self.squares[near] - 2 * (x @ self.sides[near].T)
        at = far.argmin(axis=1)
        return near[at], (far[np.arange(len(x)), at] + (x ** 2).sum(axis=1)).astype(np.int64)

    def _large(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen, distances = [], []
        for x in vectors.tolist():
            each = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in self.exact]
            least = min(each)
            distances.append(min(least, _MOST))
            chosen.append(each.index(least))
        return np.array(chosen), np.array(distances, np.int64)


def _blocks_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for k in range(batch.num_rows):
        ids, vectors, low, high = (batch.column(c)[k].values for c in range(4))
        yield ids, vectors.to_numpy().reshape(-1, width), low.to_numpy(), high.to_numpy()


def in_blocks(kept: DataFrame, centroids: Centroids, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The vectors (`_id`, `_vector`) in blocks along the curve, as a table."""
    curve, width = Curve(centroids), len(centroids[0])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).flatten().to_numpy().reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve.keys(vectors), pa.binary())], names=[*batch.schema.names, "_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                vectors = part.column(1).flatten().to_numpy().reshape(-1, width)
                out.append((part.column(0), vectors.ravel(), vectors.min(axis=0), vectors.max(axis=0)))
            yield record(_BLOCK, [pa.array([v.to_pylist() if isinstance(v, pa.Array) else v for v in column], f.type) for column, f in zip(zip(*out), _BLOCK)])

    # Rows of one place on the curve, also equal ones, differ by id and by where they were read.
    marked = kept.withColumn("_deal", F.monotonically_increasing_id())
    schema = T.StructType([*marked.schema.fields, T.StructField("_key", T.BinaryType())])
    order = ["_key", "_id", "_deal"]
    sorted_rows = marked.mapInArrow(keys, schema).repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_vector")
    return written(sorted_rows.mapInArrow(cut, _BLOCK_AS), "blocks")


def _totals(blocks: DataFrame, centroids: Centroids, of_block, parts: int) -> dict[int, list[int]]:
    """Per cluster the sums of what `of_block(vectors, distances)` returns, added up in tasks and then by Spark."""
    width = len(centroids[0])
    schema = pa.schema([("_cluster", pa.int32()), ("_part", pa.int32()), ("_sum", pa.decimal128(38, 0))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner, sums = Assigner(centroids), {}
        for batch in batches:
            for _, vectors, low, high in _blocks_of(batch, width):
                clusters, distances = assigner.block(vectors, low, high)
                for cluster in np.unique(clusters).tolist():
                    own = clusters == cluster
                    old = sums.get(cluster, [0] * parts)
                    sums[cluster] = [a + b for a, b in zip(old, of_block(vectors[own], distances[own]))]
        rows = [(c, part, Decimal(v)) for c, each in sums.items() for part, v in enumerate(each)]
        if rows:
            yield record(schema, list(zip(*rows)))

    found = blocks.mapInArrow(add, "_cluster int, _part int, _sum decimal(38,0)").groupBy("_cluster", "_part").agg(F.sum("_sum").alias("_sum"))
    out: dict[int, list[int]] = {}
    for row in found.collect():  # clusters times parts, whatever the input
        out.setdefault(row["_cluster"], [0] * parts)[row["_part"]] = int(row["_sum"])
    return out


def _column_sums(values: np.ndarray) -> list[int]:
    """Sums of the columns; beyond what a long holds as well."""
    if max(abs(int(values.min())), abs(int(values.max()))) < 1 << 40:
        return values.sum(axis=0).tolist()
    return [sum(column) for column in values.T.tolist()]


def _count_and_sums(vectors: np.ndarray, distances: np.ndarray) -> list[int]:
    return [len(vectors), *_column_sums(vectors)]


def _inertia(vectors: np.ndarray, distances: np.ndarray) -> list[int]:
    return _column_sums(distances[:, None])


def first_centroids(kept: DataFrame, k: int) -> Centroids:
    """The vectors with the smallest digests of `1:id`; rows without an id come last, equal ids by their vector."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("_id").cast("string")), 256)
    rows = kept.select(digest.alias("_digest"), "_vector").orderBy(F.col("_digest").asc_nulls_last(), "_vector").limit(k).collect()
    return [list(row["_vector"]) for row in rows]


def moved(centroids: Centroids, totals: dict[int, list[int]]) -> Centroids:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    return [[s // totals[c][0] for s in totals[c][1:]] if c in totals else old for c, old in enumerate(centroids)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", width: int = 64, scale: int = 64, k: int = 16, rounds: int = 3,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Clusters of the vectors with `width` components, after `rounds` of moving `k` centroids.

    Components become floor(scale * x). Returns per vector its id, `cluster`, `distance` (squared), `cluster_inertia`,
    `inertia` and `centroid_sha256`. Null vectors, other widths, and vectors with a null or non-finite component are left
    out. Rows with null or repeated ids are vectors of their own. With fewer than `k` vectors there are as many centroids
    as vectors. Components, distances and sums of distances beyond a long are the end of its range. Other columns are not read.
    An empty table gives no rows.
    """
    kept = vectors.filter(is_finite(F.col(vec_col)) & (F.size(vec_col) == width)).select(
        F.col(id_col).cast("bigint").alias("_id"), whole(F.col(vec_col), scale).alias("_vector"))
    centroids = first_centroids(kept, k)
    columns = f"`{id_col}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], columns)
    blocks = in_blocks(kept, centroids, block_rows)
    for _ in range(rounds):
        centroids = moved(centroids, _totals(blocks, centroids, _count_and_sums, width + 1))
    inertia = {c: sums[0] for c, sums in _totals(blocks, centroids, _inertia, 1).items()}
    return _assigned(blocks, centroids, inertia, id_col, columns)


def _assigned(blocks: DataFrame, centroids: Centroids, inertia: dict[int, int], id_col: str, columns: str) -> DataFrame:
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = min(sum(inertia.values()), _MOST)
    own: Sequence[int] = [min(inertia.get(c, 0), _MOST) for c in range(len(centroids))]
    width = len(centroids[0])
    schema = pa.schema([(id_col, pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("cluster_inertia", pa.int64()),
                        ("inertia", pa.int64()), ("centroid_sha256", pa.string())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(centroids)
        for batch in batches:
            for ids, vectors, low, high in _blocks_of(batch, width):
                clusters, distances = assigner.block(vectors, low, high)
                numbers = clusters.tolist()
                yield record(schema, [ids, numbers, distances, [own[c] for c in numbers], [total] * len(numbers), [digests[c] for c in numbers]])

    return blocks.mapInArrow(assign, columns)
