"""Document likelihood over a subword lattice: all ways to cut a text into pieces of a vocabulary count.

The vocabulary and its scores are given; scores are merge ranks, so a piece starts with the weight that its rank has
under Zipf's law. Expectation maximisation over all training words turns them into probabilities. A text's
probability is the sum over all its segmentations, by a forward recursion in log space. Pieces never cross the start
of a word, so the sum over a text is the product of the sums over its words, and a word is worked out once for all its
places. Words of like length are worked out side by side, as columns of arrays. Characters that no piece covers are
spelled in byte pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import KEY, keyed, written

# Share of documents that are held out, by remainder of the id's checksum.
FOLDS, HELD_OUT = 5, 1
# Rank weights count as so many observed pieces.
PRIOR_PIECES = 10_000.0
_ZIPF_SHIFT = 2.7
_END = "</s>"
_START = "▁"
_BYTE = re.compile("<0x[0-9A-F]{2}>")
_LN10 = math.log(10)
# Text of a block of documents, which shares one table of its words; and the least worth a block of its own.
BLOCK_BYTES = 24 << 20
_LEAST_BLOCK = 2 << 20
_FOLD_WORDS = 400_000
# Words of at most so many characters are summed side by side, without a scale, unless they are less probable than
# that; so many words are laid out, and so many characters summed, at once.
_SIDE = 64
_LEAST = 1e-200
_LAID_OUT = 1 << 16
_AT_ONCE = 1 << 16
# What stands behind the end of a word: no code point.
_PAD = 0x110000
# Characters of a word whose edges are held at once.
_PART = 4096
STEPS = 2


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def read_pieces(path: str) -> dict[str, float]:
    """Start weights of a piece vocabulary: pieces in order of their scores, weighted by rank; they sum to one."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not model.is_unknown(i) and not model.is_control(i)]
    # Pieces of several start marks never stand in a word; equal scores, as of byte pieces, keep the order of ids.
    pieces = {model.id_to_piece(i): model.get_score(i) for i in ids if _START not in model.id_to_piece(i)[1:]}
    spelled = {p for i in ids if model.is_byte(i) for p in [model.id_to_piece(i)]}
    ranked = [_END, *sorted((p for p in pieces if p not in spelled), key=lambda p: -pieces[p]), *sorted(spelled)]
    raw = {p: 1 / (rank + _ZIPF_SHIFT) for rank, p in enumerate(ranked)}
    total = sum(raw.values())
    return {p: w / total for p, w in raw.items()}


class Lattice:
    """Piece probabilities, and sums over the segmentations of a word.

    The forward recursion keeps its sums as numbers times a power of e, which grows as they shrink: log space, without
    a logarithm at each step, and without underflow however long a word is.
    """

    def __init__(self, weights: Mapping[str, float]):
        self.weights = dict(weights)
        # The end and byte pieces are no text, also where a text writes their names.
        pieces = {p: w for p, w in weights.items() if p != _END and not _BYTE.fullmatch(p)}
        self.longest = max(map(len, pieces))
        # Weights of pieces, and 0 for what only starts one: what is in neither starts no piece, however it goes on.
        self.starts = {p[:k]: 0.0 for p in pieces for k in range(1, len(p))} | pieces
        self.end = math.log(weights[_END])

    def spelled(self, char: str) -> tuple[float, list[str]]:
        pieces = [f"<0x{b:02X}>" for b in char.encode("utf-8", "replace")]
        return math.prod(self.weights[p] for p in pieces), pieces

    def word(self, word: bytes) -> float:
        """Natural log of the probability of a word, over all segmentations."""
        text = _START + word.decode("utf-8", "replace")
        get, longest, n = self.starts.get, self.longest, len(text)
        forward, shift = [1.0] + [0.0] * n, 0.0
        for i in range(n):
            here = forward[i]
            if here < 1e-100:
                # Sums that later pieces reach stay in step.
                for k in range(i, min(i + longest, n + 1)):
                    forward[k] *= 1e100
                here, shift = forward[i], shift + 100 * _LN10
            j = i + 1
            weight = get(text[i:j])
            if not weight:  # the character by itself is no piece
                forward[j] += here * self.spelled(text[i])[0]
            while weight is not None:
                forward[j] += here * weight
                j += 1
                if j > n:
                    break
                weight = get(text[i:j])
        return math.log(forward[n]) - shift

    def expected(self, word: bytes, times: float, into: dict[str, float]) -> None:
        """Add the expected number of uses of each piece, over all segmentations, `times` the word.

        From the end, each position hands its share on to those that its last pieces start at, as the forward sums
        divide it; so only ratios of sums of one scale are needed. Edges are held for a part of a long word at a time.
        """
        text = _START + word.decode("utf-8", "replace")
        n = len(text)
        starts = [[1.0]]
        for at in range(0, n - _PART, _PART):
            starts.append(self._edges(text, at, at + _PART, starts[-1])[0])
        share = [0.0] * n + [float(times)]
        for at, before in zip(range((len(starts) - 1) * _PART, -1, -_PART), reversed(starts)):
            _, edges, totals = self._edges(text, at, min(n, at + _PART), before)
            for i, j, part, piece in reversed(edges):
                part *= share[j] / totals[j - at - 1]
                share[i] += part
                for p in (piece,) if piece is not None else self.spelled(text[i])[1]:
                    into[p] = into.get(p, 0.0) + part

    def _edges(self, text: str, at: int, end: int, before: list[float]) -> tuple[list[float], list[tuple], list[float]]:
        """Forward sums from `at` on, given those up to it: the last ones, all edges with their part, and each sum in
        the scale of its edges."""
        get, longest = self.starts.get, self.longest
        forward, off, edges, totals = list(before), at + 1 - len(before), [], []
        for j in range(at + 1, end + 1):
            total = 0.0
            for i in range(j - longest if j > longest else 0, j):
                weight = get(piece := text[i:j])
                if weight:
                    part = forward[i - off] * weight
                    total += part
                    edges.append((i, j, part, piece))
            if not weight:
                part = forward[j - 1 - off] * self.spelled(text[j - 1])[0]
                total += part
                edges.append((j - 1, j, part, None))
            forward.append(total)
            totals.append(total)
            if total < 1e-100:
                for k in range(max(len(forward) - longest - 1, 0), len(forward)):
                    forward[k] *= 1e100
        return forward[-longest:], edges, totals


class SideBySide:
    """The sums of a lattice for many words at once: character i of word k is at place i * words + k of flat arrays, so
    that a step of the recursion is one operation on the places of a character. Starts of pieces are numbered from 1."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        starts = sorted(lattice.starts, key=len)
        number = {piece: k for k, piece in enumerate(starts, 1)}
        self.ones = sum(len(piece) == 1 for piece in starts)
        self.names = ["", *starts]
        self.weights = np.array([0.0, *(lattice.starts[piece] for piece in starts)])
        self.first = np.zeros(_PAD + 1, np.int32)
        for piece in starts[:self.ones]:
            self.first[ord(piece)] = number[piece]
        # The start that a start and one more character make; those of several characters stand in this order.
        self.longer = pd.Index(np.array([number[piece[:-1]] * (_PAD + 1) + ord(piece[-1]) for piece in starts[self.ones:]], np.int64))
        self.goes_on = np.zeros(len(self.names), bool)
        self.goes_on[self.longer.to_numpy() // (_PAD + 1)] = True

    def _parts(self, words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of words of like length, their lengths and the code points at their places; not those of words that
        are too long."""
        short = np.array([k for k, word in enumerate(words) if len(word) <= 4 * _SIDE], np.int64)
        for run in (short[at:at + _LAID_OUT] for at in range(0, len(short), _LAID_OUT)):
            text = "\n" + b"\n".join([words[k] for k in run.tolist()]).decode("utf-8", "replace")  # no word holds a line break
            points = np.frombuffer(text.replace("\n", f"\n{_START}")[1:].encode("utf-32-le"), np.uint32)
            ends = np.append(np.flatnonzero(points == ord("\n")), len(points))
            begins = np.append(0, ends[:-1] + 1)
            order = np.argsort(ends - begins, kind="stable")
            lengths = (ends - begins)[order]
            at, fit = 0, int(np.searchsorted(lengths, _SIDE, "right"))
            while at < fit:
                # The longest word of a part is a quarter longer than its shortest at most, or one character.
                most = max(lengths[at] + 1, lengths[at] * 5 // 4)
                end = min(fit, at + _AT_ONCE // int(lengths[at]), int(np.searchsorted(lengths, most, "right")))
                end = max(end, at + 1)
                own, n = order[at:end], lengths[at:end]
                row = np.arange(n[-1])[:, None]
                yield run[own], n, np.where(row < n, points[np.minimum(begins[own] + row, len(points) - 1)], _PAD).ravel()
                at = end

    def _edges(self, points: np.ndarray, words: int) -> tuple[list[tuple], tuple]:
        """Edges by length, as places they begin at, starts and weights; and of those that are spelled, places, code
        points, each once, and the numbers of these."""
        state = self.first[points]
        weight = self.weights[state]
        spelled = np.flatnonzero((weight == 0) & (points != _PAD))
        chars, which = np.unique(points[spelled], return_inverse=True)
        weight[spelled] = np.array([self.lattice.spelled(chr(c))[0] for c in chars])[which] if len(chars) else 0.0
        edges, place = [(np.arange(len(points)), state, weight)], np.arange(len(points))
        while True:
            step = len(edges) * words
            on = self.goes_on[state] & (place < len(points) - step)
            place, state = place[on], state[on]
            found = self.longer.get_indexer(state.astype(np.int64) * (_PAD + 1) + points[place + step])
            place, state = place[found >= 0], found[found >= 0] + self.ones + 1
            if not len(place):
                return edges, (spelled, chars, which)
            edges.append((place, state, self.weights[state]))

    @staticmethod
    def _by_row(edges: list[tuple], rows: int, words: int) -> list[list[tuple[int, np.ndarray]]]:
        """By the character they begin at: lengths and weights of the edges of all words."""
        out: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(rows)]
        for k, (place, _, weight) in enumerate(edges, 1):
            table = np.zeros(rows * words)
            table[place] = weight
            table = table.reshape(rows, words)
            for i in np.unique(place // words) if k > 1 else range(rows):
                out[i].append((k, table[i]))
        return out

    def _forward(self, by_row: list, words: int) -> np.ndarray:
        forward = np.zeros((len(by_row) + 1, words))
        forward[0] = 1.0
        for i, row in enumerate(by_row):
            for k, weight in row:
                forward[i + k] += forward[i] * weight
        return forward

    def logs(self, words: Sequence[bytes]) -> np.ndarray:
        """`Lattice.word` of each."""
        out, left = np.zeros(len(words)), np.ones(len(words), bool)
        for own, lengths, points in self._parts(words):
            edges, _ = self._edges(points, len(own))
            sums = self._forward(self._by_row(edges, lengths[-1], len(own)), len(own))[lengths, np.arange(len(own))]
            own, sums = own[sums >= _LEAST], sums[sums >= _LEAST]
            out[own], left[own] = np.log(sums), False
        for k in np.flatnonzero(left):
            out[k] = self.lattice.word(words[k])
        return out

    def expected(self, words: Sequence[bytes], times: Sequence[float]) -> dict[str, float]:
        """Expected numbers of uses of pieces, over all segmentations, each word as often as `times` says."""
        sums, into, left = np.zeros(len(self.names)), {}, np.ones(len(words), bool)
        times = np.asarray(times, float)
        for own, lengths, points in self._parts(words):
            size, rows = len(own), int(lengths[-1])
            edges, (spelled, chars, which) = self._edges(points, size)
            by_row = self._by_row(edges, rows, size)
            forward = self._forward(by_row, size)
            total = forward[lengths, np.arange(size)]
            sure = total >= _LEAST
            left[own[sure]] = False
            backward = np.zeros((rows + 1, size))
            backward[lengths[sure], np.flatnonzero(sure)] = times[own[sure]] / total[sure]
            for i in range(rows - 1, -1, -1):
                for k, weight in by_row[i]:
                    backward[i] += weight * backward[i + k]
            forward, backward = forward.ravel(), backward.ravel()
            for k, (place, state, weight) in enumerate(edges, 1):
                uses = forward[place] * weight * backward[place + k * size]
                if k == 1:
                    for c, n in zip(chars, np.bincount(which, uses[spelled], len(chars))):
                        for p in self.lattice.spelled(chr(c))[1]:
                            into[p] = into.get(p, 0.0) + n
                    uses[spelled] = 0.0
                sums += np.bincount(state, uses, len(sums))
        for k in np.flatnonzero(sums):
            into[self.names[k]] = into.get(self.names[k], 0.0) + sums[k]
        for k in np.flatnonzero(left):
            self.lattice.expected(words[k], times[k], into)
        return into


def fold(id_col: str, folds: int = FOLDS) -> Column:
    """Checksum remainder of an id's text form; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def count_words(texts: DataFrame) -> DataFrame:
    """`word` and `c` of the rows marked `_train`; each task folds its own words before they are dealt out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) > _FOLD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
                    held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

    counted = texts.filter("_train").select("_text").mapInArrow(count, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


@lru_cache(maxsize=1)
def _lattice(items: tuple) -> SideBySide:
    return SideBySide(Lattice(dict(items)))


def learn(words: DataFrame, ends: int, start: Mapping[str, float], steps: int = STEPS) -> dict[str, float]:
    """Piece probabilities after steps of expectation maximisation over all words; rank weights are the prior.

    Every word with its count goes through the lattice; only sums by piece, as many as the vocabulary has, are gathered.
    """
    weights = dict(start)
    for _ in range(steps):
        weights = _step(words, ends, weights, start)
    return weights


def _step(words: DataFrame, ends: int, now: Mapping[str, float], start: Mapping[str, float]) -> dict[str, float]:
    given = words.sparkSession.sparkContext.broadcast(tuple(now.items()))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = _lattice(given.value), Counter()
        for batch in batches:
            sums.update(lattice.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.float64())], names=["piece", "n"])

    sums = words.select("word", "c").mapInArrow(expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    # Summed in a fixed order of pieces, so that the result does not hang on the order of tasks any more than sums do.
    seen = {r.piece: r.n for r in sums.orderBy("piece").collect()}
    seen[_END] = float(ends)
    total = sum(seen.values()) + PRIOR_PIECES
    return {p: (seen.get(p, 0.0) + PRIOR_PIECES * w) / total for p, w in start.items()}


_SCORED = "n_tokens long, n_known long, base_score double, score double"


def report(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score, both log10 probabilities.

    Learned from documents whose fold is not `HELD_OUT`; all are scored. Null and empty texts are one end token. Null
    and repeated ids: each row is a document. Without training documents all counts are zero and pieces keep their rank
    weights. Other columns are not read.
    """
    spark = documents.sparkSession
    rows, _ = keyed(documents, id_col, text_col)
    texts = rows.select(KEY, F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"), (fold(id_col) != HELD_OUT).alias("_train"))
    totals = texts.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("size"), F.count(F.when(F.col("_train"), 1)).alias("ends")).first()
    words = written(count_words(texts), "words")
    known = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = totals.ends
    n, v = known.n + ends, known.v + (ends > 0)
    weights = learn(words, ends, read_pieces(path))
    given = spark.sparkContext.broadcast(tuple(weights.items()))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-totals.size // BLOCK_BYTES), min(partitions, -(-totals.size // _LEAST_BLOCK)))
    dealt = texts.select(F.pmod(F.xxhash64(KEY), F.lit(blocks)).alias("_block"), "_id", "_text", "_train")

    def distinct(group: pa.Table) -> pa.Table:
        seen: set[bytes] = set()
        for text in group.column("_text"):
            seen.update(words_of(text.as_py()))
        return pa.table({"_block": pa.array([group.column("_block")[0].as_py()] * len(seen), pa.int64()), "word": pa.array(list(seen), pa.binary())})

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(given.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lattice.logs(batch.column(0).to_pylist()))], names=["word", "c", "p"])

    # Words of training documents are worked out once each, others in their block.
    rated = words.select("word", "c").mapInArrow(rate, "word binary, c long, p double")
    listed = dealt.groupBy("_block").applyInArrow(distinct, "_block long, word binary")
    tables = listed.join(rated, "word", "left").select("_block", "word", F.coalesce("c", F.lit(0)).alias("c"), "p")
    floor = math.log10(n + 0.5 * (v + 1))

    def score(group: pa.Table, table: pa.Table) -> pa.Table:
        lattice = _lattice(given.value)
        new = table.filter(pc.is_null(table.column("p"))).column("word").to_pylist()
        logs = dict(zip(new, lattice.logs(new).tolist()))
        listed = zip(*(table.column(x).to_pylist() for x in ("word", "c", "p")))
        at = {word: (math.log10(c + 0.5), c > 0, logs[word] if p is None else p) for word, c, p in listed}
        out = []
        for text in group.column("_text"):
            found = [at[w] for w in words_of(text.as_py())]
            tokens = len(found) + 1
            base = sum([x[0] for x in found]) + math.log10(ends + 0.5) - tokens * floor
            out.append((tokens, sum([x[1] for x in found]) + (ends > 0), base, (sum([x[2] for x in found]) + lattice.lattice.end) / _LN10))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.table([group.column("_id"), group.column("_train"), *columns], names=["_id", "_train", "n_tokens", "n_known", "base_score", "score"])

    schema = T.StructType([dealt.schema["_id"], dealt.schema["_train"], *T._parse_datatype_string(_SCORED).fields])
    scored = dealt.groupBy("_block").cogroup(tables.groupBy("_block")).applyInArrow(score, schema)
    return scored.select(F.col("_id").alias(id_col), (~F.col("_train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
