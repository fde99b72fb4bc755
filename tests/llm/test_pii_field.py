"""The field against an enumeration of all segmentations, and texts that are long or dense."""

import itertools
import math
import re
import time

import numpy as np
import pytest
from test_text_operators import PERSONAL, base_plain

from tallyhouse.llm import pii


@pytest.fixture(scope="module")
def field():
    field = pii.Field()
    field.weights[:, 0] = -4.0
    return field.fit([x for t in PERSONAL for x in pii.examples(t)])


def segmentations(stretch, at=0):
    """All ways to cover the words: lists of (segment, kind)."""
    if at >= stretch.words:
        yield []
        return
    yield from segmentations(stretch, at + 1)
    for s, (first, size, *_rest) in enumerate(stretch.segments):
        if first == at:
            for rest in segmentations(stretch, at + size):
                for kind in range(len(pii.KINDS)):
                    yield [(s, kind), *rest]


@pytest.mark.parametrize("text", ["ring 555 01 or a@b.co", "10[.]0[.]0[.]9 4.5", "see 4111 1111 1111"])
def test_marginals_and_best_equal_an_enumeration(field, text):
    stretch = next(pii.stretches(text))
    scores = [field.weights[:, on].sum(axis=1) for *_, on in stretch.segments]
    ways = list(segmentations(stretch))
    weights = [math.exp(sum(scores[s][k] for s, k in way)) for way in ways]
    sure, log_total = field.marginals(stretch)
    assert math.isclose(math.exp(log_total), sum(weights), rel_tol=1e-9)
    for s, k in itertools.product(range(len(stretch.segments)), range(len(pii.KINDS))):
        share = sum(w for way, w in zip(ways, weights) if (s, k) in way) / sum(weights)
        assert math.isclose(sure[s, k], share, rel_tol=1e-6, abs_tol=1e-12)
    top = ways[int(np.argmax(weights))]
    want = [(k, *stretch.segments[s][2:4]) for s, k in top if sure[s, k] >= pii.LEAST_PROBABILITY]
    assert field.best(stretch) == want


def dense(seed, words=900):
    draw = np.random.default_rng(seed)
    forms = ["10[.]0[.]0[.]9", "555-0199-221", "tom at mail dot org", "4111.1111.1111.1111", "+1 555 0100 222", "x", "a@b.example.com", "12", "(555) 01-99-22", "0044 20 79"]
    return " ".join(draw.choice(forms) for _ in range(words))


@pytest.mark.parametrize("seed", range(6))
def test_spans_over_a_whole_run_equal_those_in_one_piece(field, monkeypatch, seed):
    text = dense(seed, 120)
    whole = pii.all_spans(text, field)
    monkeypatch.setattr(pii, "LONG_RUN", 0)
    assert pii.all_spans(text, field) == whole


@pytest.mark.parametrize("seed", range(10))
def test_added_spans_of_dense_texts_do_not_overlap(field, seed):
    base, spans = pii.all_spans(dense(seed), field)
    added = sorted((a, b) for k, a, b in set(spans) - set(base))
    assert len(added) > 20 and all(b <= c for (_, b), (c, _) in zip(added, added[1:]))


def test_planted_forms_are_found_and_numbers_left(field):
    planted = ["write to tom.fox (at) mail (dot) example please", "server 10[.]1[.]2[.]3 is down", "pay card 4111 - 1111 - 1111 - 1111 today",
               "mail ann [at] host [dot] example now", "host 192 . 168 . 1 . 9 fails", "card 5500.0000.0000.0004 expired"]
    clean = ["chapter 12 of 300 pages, 3.5 points in 2019", "from 1990 to 2005 some 45,000 people", "version 2.0.1 of part 17", "at 10:30 in room 204"]
    found = [bool(set(pii.all_spans(t, field)[1]) - set(pii.base_spans(t))) for t in planted]
    wrong = [t for t in clean if pii.all_spans(t, field)[1]]
    assert sum(found) >= 5 and not wrong


def test_patterns_take_time_in_proportion_to_the_text(field):
    for text in ("a" * 1_000_000 + "@", "a.a" * 300_000 + "@", "a" * 500_000 + "@x", ("a" * 40 + "@") * 20_000, "1" * 500_000, "@" * 500_000, "a@b." * 200_000):
        began = time.perf_counter()
        list(pii._emails(text))
        assert time.perf_counter() - began < 1.5, text[:20]


def test_base_spans_of_tangled_addresses():
    for text in ("a@b.c@d.e", "@b.c@d.e", "a@b@c.d", "x@y.z.w@q.r", "a@b..c@d.e", "é@b.co a@-.-", "a@b.c.@d.e", "%@a.b", "a@b.c a@b"):
        assert [f"email:{a}:{b}" for a, b in pii._emails(text)] == [x for x in base_plain(text) if x.startswith("email")], text
    draw = np.random.default_rng(9)
    for _ in range(3000):
        text = "".join(draw.choice(list("ab@.-+ é"), 14))
        assert [f"email:{a}:{b}" for a, b in pii._emails(text)] == [x for x in base_plain(text) if re.match("email", x)], text
