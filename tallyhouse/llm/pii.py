"""Personal data: fixed patterns, and a semi-Markov conditional random field that finds what they miss.

The field scores whole segments of a few words: features look at the segment as one thing (how many digits, their
check sum, how groups are divided, marks of a written-out address, the words before it). Dynamic programming over all
segmentations of a stretch of text picks boundaries and kinds together. It is trained by maximum likelihood on
stretches where the patterns give the labels, and on the same stretches with the labelled text rewritten in ways
the patterns do not know. Spans of the patterns stay as they are; the field only adds spans beside them.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import record

KINDS = ("email", "ip", "card", "phone")
# Rows that labels for training are taken from: those with the smallest text hashes among rows that hold a sign of
# personal data. A fixed bound; all other steps read all rows.
TRAIN_ROWS = 300
TRAIN_STRETCHES = 700
EPOCHS = 5
MAX_TOKENS = 8
MAX_CHARS = 64
# Words of a run above which its segments are not held.
LONG_RUN = 1000
# A segment is added when its marginal probability is at least this.
LEAST_PROBABILITY = 0.6

_EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match cannot begin inside a run of digits: if it fails at the start of the run it fails further on, too.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end in code points


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    """The check digit rule of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Hosts first, then back over what can stand before the @: time in proportion to the text, however long its runs."""
    done = 0
    for host in _EMAIL_HOST.finditer(text):
        start = host.start()
        while start > done and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        if start < host.start():
            done = host.end()
            yield start, done


_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start."""
    spans: list[Span] = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                spans.append((3, *m.span()))
    return spans


# ---- the field -----------------------------------------------------------------------------------------------------

_SIGN = re.compile(r"[0-9@]+|[(\[{<]\s?(?:at|AT)\s?[)\]}>]")
_SPOKEN = re.compile(r"(?<=\s)(?:at|AT)(?=\s+\S+\s+(?:dot|DOT)\s)")
_TOKEN = re.compile(r"\S+")
_OUTER = " \t\r\n\"'`,;:!?#$%&*|<>_=~"
_AT = re.compile(r"[(\[{<]\s?at\s?[)\]}>]|\sat\s", re.I)
_DOT = re.compile(r"[(\[{<]\s?dot\s?[)\]}>]|\sdot\s", re.I)
_WRITTEN = re.compile(r"[A-Za-z0-9._%+-]+\s?(?:[(\[{<]\s?at\s?[)\]}>]|\sat\s|@)\s?[A-Za-z0-9-]+(?:\s?(?:[(\[{<]\s?dot\s?[)\]}>]|\sdot\s|\.)\s?[A-Za-z0-9-]+)+", re.I)
_QUAD = re.compile(r"[0-9]{1,3}(?:\s?[\[(]?\.[\])]?\s?[0-9]{1,3}){3}")
_CUES = {
    "mail": 0, "email": 0, "e-mail": 0, "contact": 0, "ip": 1, "host": 1, "server": 1, "address": 1,
    "card": 2, "visa": 2, "credit": 2, "debit": 2, "phone": 3, "tel": 3, "call": 3, "mobile": 3, "fax": 3,
}
_FEATURES = (
    ["one", "words2", "words3", "words4+", "at", "at-written", "dot-written", "written-whole", "quad-whole", "letters",
     "plus", "bracket", "dot", "hyphen", "space", "odd", "hex", "luhn", "leading-zero", "decimal", "long-group"]
    + [f"digits{n}" for n in ("0", "1-4", "5-7", "8-9", "10-12", "13-15", "16-19", "20+")]
    + [f"groups{n}" for n in ("1", "2", "3", "4", "5+")] + [f"cue-{k}" for k in KINDS])
_PLACE = {name: i for i, name in enumerate(_FEATURES)}


def features(segment: str, before: Sequence[str]) -> list[int]:
    """Numbers of the features that a whole segment has; `before` are the words that lead up to it."""
    digits = digits_of(segment)
    groups = re.findall(r"[0-9]+", segment)
    letters = any(c.isalpha() for c in segment)
    n, words = len(digits), len(segment.split())
    on = ["one", f"digits{'0' if n == 0 else '1-4' if n < 5 else '5-7' if n < 8 else '8-9' if n < 10 else '10-12' if n < 13 else '13-15' if n < 16 else '16-19' if n < 20 else '20+'}"]
    if groups:
        on.append(f"groups{len(groups) if len(groups) < 5 else '5+'}")
    if words > 1:
        on.append(f"words{words if words < 4 else '4+'}")
    tests = {
        "at": "@" in segment, "at-written": _AT.search(segment) is not None, "dot-written": _DOT.search(segment) is not None,
        "written-whole": _WRITTEN.fullmatch(segment) is not None,
        "quad-whole": _QUAD.fullmatch(segment) is not None and all(int(g) < 256 for g in groups),
        "letters": letters, "plus": "+" in segment, "bracket": "(" in segment or "[" in segment, "dot": "." in segment,
        "hyphen": "-" in segment, "space": " " in segment, "odd": re.search(r"[^0-9 ().+-]", segment) is not None,
        "hex": letters and n >= 4 and not segment.strip('"').isalpha() and re.fullmatch(r'"?[0-9A-Za-z]+"?', segment) is not None,
        "luhn": 13 <= n <= 19 and luhn(digits), "leading-zero": digits.startswith("0"),
        "decimal": re.fullmatch(r"[0-9]+[.,][0-9]+", segment) is not None, "long-group": any(len(g) > 8 for g in groups),
    }
    on += [name for name, holds in tests.items() if holds]
    on += {f"cue-{KINDS[_CUES[w]]}" for w in (x.lower().strip(".,:;()") for x in before) if w in _CUES}
    return [_PLACE[x] for x in on]


@dataclass
class Stretch:
    """Neighbouring words around signs of personal data; segments are (first word, words, start, end, features)."""

    words: int
    segments: list[tuple[int, int, int, int, list[int]]]


@dataclass
class _Run:
    """Neighbouring words around signs that are closer to each other than a longest segment: none can leave it."""

    text: str
    words: list[tuple[int, int]]
    free: list[bool]
    marked: list[bool]

    def segments(self, first: int, end: int) -> Iterator[tuple[int, int, int, int, list[int]]]:
        """The segments that begin with the words from `first` to before `end`."""
        text, words = self.text, self.words
        for i in range(first, end):
            for j in range(i, min(i + MAX_TOKENS, len(words))):
                if not self.free[j]:
                    break
                if not any(self.marked[i:j + 1]):
                    continue
                start, stop = words[i][0], words[j][1]
                while start < stop and text[start] in _OUTER:
                    start += 1
                while stop > start and text[stop - 1] in _OUTER + ".":
                    stop -= 1
                if not 6 <= stop - start <= MAX_CHARS or start >= words[i][1] or stop <= words[j][0]:
                    continue
                before = [text[a:b] for a, b in words[max(0, i - 2):i]]
                yield i, j - i + 1, start, stop, features(text[start:stop], before)


def _overlapped(words: Sequence[tuple[int, int]], spans: Sequence[tuple[int, int]]) -> list[bool]:
    """Which of the words, in order, overlap one of the spans, sorted by start."""
    out, at, reach = [], 0, -1
    for start, end in words:
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][1])
            at += 1
        out.append(reach > start)
    return out


def _runs(text: str, taken: Sequence[Span], longest: int | None) -> Iterator[_Run]:
    signs = [m.span() for m in _SIGN.finditer(text)]
    if " dot " in text or " DOT " in text:
        signs = sorted(signs + [m.span() for m in _SPOKEN.finditer(text)])
    if not signs:
        return
    spans = sorted((a, b) for _, a, b in taken)
    reach = list(accumulate((b for _, b in spans), max))
    at = 0
    while at < len(signs):
        last = at
        while last + 1 < len(signs) and signs[last + 1][0] - signs[last][1] <= 2 * MAX_CHARS and (
                longest is None or signs[last + 1][0] - signs[at][0] <= longest):
            last += 1
        lo, hi = max(0, signs[at][0] - MAX_CHARS), min(len(text), signs[last][1] + MAX_CHARS)
        own = signs[at:last + 1]
        at = last + 1
        here = spans[bisect.bisect_right(reach, lo):bisect.bisect_left(spans, (hi, 0))]
        if here and len(own) <= 64 and all(any(a <= s and e <= b for a, b in here) for s, e in own):
            continue
        # The cut-off words at both ends only serve as context.
        words = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
        words = [w for w in words if (w[0] > lo or lo == 0) and (w[1] < hi or hi == len(text))]
        yield _Run(text, words, [not x for x in _overlapped(words, here)], _overlapped(words, own))


def stretches(text: str, taken: Sequence[Span] = (), longest: int = 16 * MAX_CHARS) -> Iterator[Stretch]:
    """What to learn from: the parts of a text in which anything can be found, cut after about `longest` characters.

    Words that overlap `taken` are left out of segments.
    """
    for run in _runs(text, taken, longest):
        if segments := list(run.segments(0, len(run.words))):
            yield Stretch(len(run.words), segments)


class Field:
    """Weights per kind and feature; a word outside any segment scores 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros((len(KINDS), len(_FEATURES))) if weights is None else weights

    def marginals(self, stretch: Stretch) -> tuple[np.ndarray, float]:
        """Probability of each (segment, kind), and the log of the sum over all segmentations."""
        scores = np.array([self.weights[:, f].sum(axis=1) for *_, f in stretch.segments])
        inner = np.logaddexp.reduce(scores, axis=1)
        n = stretch.words
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for s, (first, size, *_rest) in enumerate(stretch.segments):
            ending[first + size].append(s)
            starting[first].append(s)
        left, right = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            left[j] = np.logaddexp.reduce([left[j - 1], *(left[stretch.segments[s][0]] + inner[s] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            right[i] = np.logaddexp.reduce([right[i + 1], *(right[i + stretch.segments[s][1]] + inner[s] for s in starting[i])])
        outside = np.array([left[first] + right[first + size] for first, size, *_rest in stretch.segments])
        return np.exp(scores + outside[:, None] - left[n]), left[n]

    def best(self, stretch: Stretch) -> list[Span]:
        """The highest-scoring segmentation, as spans."""
        scores = np.array([self.weights[:, f].sum(axis=1) for *_, f in stretch.segments])
        kinds = scores.argmax(axis=1)
        top, back = [0.0] * (stretch.words + 1), [-1] * (stretch.words + 1)
        ending: list[list[int]] = [[] for _ in range(stretch.words + 1)]
        for s, (first, size, *_rest) in enumerate(stretch.segments):
            ending[first + size].append(s)
        for j in range(1, stretch.words + 1):
            top[j] = top[j - 1]
            for s in ending[j]:
                value = top[stretch.segments[s][0]] + scores[s, kinds[s]]
                if value > top[j]:
                    top[j], back[j] = value, s
        spans, j = [], stretch.words
        while j > 0:
            if back[j] < 0:
                j -= 1
                continue
            first, _, start, end, _ = stretch.segments[back[j]]
            spans.append((int(kinds[back[j]]), start, end, back[j]))
            j = first
        sure, _ = self.marginals(stretch)
        return [(kind, start, end) for kind, start, end, s in reversed(spans) if sure[s, kind] >= LEAST_PROBABILITY]

    def joint(self, run: _Run) -> list[Span]:
        """`best` over a run of any length: segments are made twice, from left and from right, and not held."""
        n, chosen = len(run.words), {}
        left, right = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        top, back = [-math.inf] * (n + 1), [None] * (n + 1)
        left[0] = right[n] = top[0] = 0.0
        for i in range(n):
            for first, size, start, end, on in run.segments(i, i + 1):
                scores = self.weights[:, on].sum(axis=1)
                kind, j = int(scores.argmax()), first + size
                left[j] = np.logaddexp(left[j], left[i] + np.logaddexp.reduce(scores))
                if top[i] + scores[kind] > top[j]:
                    top[j], back[j] = top[i] + scores[kind], (first, kind, start, end, scores[kind])
            left[i + 1] = np.logaddexp(left[i + 1], left[i])
            if top[i] >= top[i + 1]:
                top[i + 1], back[i + 1] = top[i], None
        j = n
        while j > 0:
            if back[j] is not None:
                chosen[back[j][0]] = (j, *back[j][1:])
            j = back[j][0] if back[j] is not None else j - 1
        spans = []
        for i in range(n - 1, -1, -1):
            right[i] = right[i + 1]
            for first, size, _, _, on in run.segments(i, i + 1):
                right[i] = np.logaddexp(right[i], right[i + size] + np.logaddexp.reduce(self.weights[:, on].sum(axis=1)))
            if i in chosen:
                end_word, kind, start, end, score = chosen[i]
                if math.exp(score + left[i] + right[end_word] - left[n]) >= LEAST_PROBABILITY:
                    spans.append((kind, start, end))
        return spans[::-1]

    def fit(self, labelled: Sequence[tuple[Stretch, Sequence[Span]]], epochs: int = EPOCHS, rate: float = 0.5, decay: float = 1e-3) -> Field:
        """Maximum likelihood by adaptive gradient steps, in the given order; a label that no segment has is passed over."""
        squares = np.full_like(self.weights, 1e-6)
        for _ in range(epochs):
            for stretch, spans in labelled:
                gold = {(start, end): kind for kind, start, end in spans}
                sure, _ = self.marginals(stretch)
                slope = np.zeros_like(self.weights)
                for (first, size, start, end, on), p in zip(stretch.segments, sure):
                    want = np.zeros(len(KINDS))
                    if (start, end) in gold:
                        want[gold.pop((start, end))] = 1
                    slope[:, on] += (want - p)[:, None]
                slope -= decay * self.weights
                squares += slope * slope
                self.weights += rate * slope / np.sqrt(squares)
        return self


def rewritten(text: str, kind: int, turn: int) -> str:
    """The same personal data in a form that the patterns do not match."""
    if kind == 0:
        at, dot = ((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."))[turn % 4]
        name, _, host = text.partition("@")
        return name + at + host.replace(".", dot)
    if kind == 1:
        return text.replace(".", ("[.]", " . ", "(.)")[turn % 3])
    if kind == 2:
        digits = digits_of(text)
        mark = (".", " - ", "  ")[turn % 3]
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    groups = re.findall(r"[0-9]+", text)
    return ("-".join(groups[1:]), f"({groups[1]}) " + "-".join(groups[2:]), "00" + " ".join(groups), ".".join(groups[1:]))[turn % 4] if len(groups) > 2 else text[1:]


def examples(text: str) -> list[tuple[Stretch, list[Span]]]:
    """Labelled stretches of one text: as it is, and with what the patterns found rewritten one at a time."""
    found = base_spans(text)
    out = [(s, [x for x in found if s.segments[0][2] - 200 <= x[1] <= s.segments[-1][3] + 200]) for s in stretches(text)]
    for turn, (kind, a, b) in enumerate(found[:8]):
        if any(k != kind and s < b and a < e for k, s, e in found):
            continue
        new = rewritten(text[a:b], kind, turn + zlib.crc32(text[a:b].encode()))
        lo, hi = max(0, a - 80), min(len(text), b + 80)
        near = text[lo:a] + new + text[b:hi]
        label = (kind, a - lo, a - lo + len(new))
        rest = [x for x in base_spans(near) if not (x[1] < label[2] and label[1] < x[2])]
        out += [(s, [label, *rest]) for s in stretches(near)]
    return out


def train(documents: DataFrame, text_col: str = "text", rows: int = TRAIN_ROWS, limit: int = TRAIN_STRETCHES) -> Field:
    """A field fitted to a bounded sample: `rows` texts, `limit` stretches. Without any, a field that adds nothing."""
    text = F.col(text_col).cast("string")
    signs = documents.select(text.alias("_text")).filter(F.col("_text").contains("@") | F.col("_text").rlike(r"\+[0-9]|[0-9]\.[0-9]|[0-9]{8}"))
    signs = signs.withColumn("_hash", F.xxhash64("_text"))
    number = signs.count()
    if number > rows:
        # Only about as many texts as needed leave their tasks, however many tasks there are.
        signs = signs.filter(F.col("_hash") <= F.lit(min(int(2 ** 64 * (1.2 * rows + 50) / number) - 2 ** 63, 2 ** 63 - 1)))
    texts = [r._text for r in signs.orderBy("_hash", "_text").limit(rows).collect()]
    labelled = [x for t in dict.fromkeys(texts) for x in examples(t)]
    labelled.sort(key=lambda x: hashlib.sha256(repr((x[0].words, x[0].segments[0], x[1])).encode()).digest())
    labelled = labelled[:limit]
    field = Field()
    field.weights[:, _PLACE["one"]] = -4.0
    return field.fit(labelled) if labelled else field


def _added(run: _Run, field: Field) -> list[Span]:
    if len(run.words) > LONG_RUN:
        return field.joint(run)
    segments = list(run.segments(0, len(run.words)))
    return field.best(Stretch(len(run.words), segments)) if segments else []


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and pattern spans with those the field adds beside them, by kind, then start."""
    base = base_spans(text)
    added = [x for run in _runs(text, base, None) for x in _added(run, field)]
    return base, sorted({*base, *(x for x in added if not any(x[1] < b and a < x[2] for _, a, b in base))})


def _join(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_REPORT = pa.schema([*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def _field(documents: DataFrame, text_col: str, field: Field | None) -> Broadcast:
    return documents.sparkSession.sparkContext.broadcast((field or train(documents, text_col)).weights)


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: pattern spans by kind and their digest, and all spans in text form.

    Null text: as empty, no spans. Each row, also a repeated one, is searched by itself; whole texts are searched, no
    matter how long. Without `field`, one is trained on the documents. Other columns are not read.
    """
    weights = _field(documents, text_col, field)
    rows = documents.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights.value)
        for batch in batches:
            out = []
            for text in batch.column(1):
                base, spans = all_spans(text.as_py(), own)
                counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                out.append((*counts, hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)))
            found = record(_REPORT, list(zip(*out)) or [[] for _ in _REPORT])
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], names=[id_col, *_REPORT.names])

    schema = ", ".join([*(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return rows.mapInArrow(find, T.StructType([rows.schema[0], *T._parse_datatype_string(schema).fields]))


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first one names the kind."""
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def mask(documents: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """`documents` with personal data in `text_col` replaced by its kind. Null texts stay null; columns stay."""
    weights = _field(documents, text_col, field)
    place, names = documents.columns.index(text_col), documents.columns

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights.value)
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([None if t is None else masked(t, all_spans(t, own)[1]) for t in (x.as_py() for x in batch.column(place))], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.mapInArrow(hide, documents.schema)
