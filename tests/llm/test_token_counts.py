import random

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import ODD, TEXT

from tallyhouse.llm import token_counts
from tallyhouse.llm.queries import PIECES
from tallyhouse.llm.token_counts import Transducer, chunks, spaced

SIGNS = "aab bct hein \n\t1299<s></s>▁  ..éß漢字あい\U0001f600<0x0A>ing"
LONG = ["the cat sat on the mat " * 400, "a" * 5000, "=" * 3000 + "x" * 3000, "ab" * 4000 + " end", "  \t\n" * 2000, "漢字あい" * 1500, "9" * 4000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def machine():
    with open(PIECES, "rb") as file:
        return Transducer.of_model(file.read())


def texts(n, longest=60):
    draw = random.Random(11)
    return ["".join(draw.choices(SIGNS, k=draw.randint(0, longest))) for _ in range(n)]


def test_counts_equal_the_library(library, machine):
    for text in [*texts(3000), *LONG, TEXT * 5, "", "▁", " ", "<unk>", "<s> </s>", "\0", "Ünïcode ſtraße"]:
        assert machine.count(text) == len(library.encode(text)), text[:50]


def test_every_prefix_has_the_count_of_its_state(library, machine):
    text = "understanding  representations 漢字 of includegraphics====ok"
    state, total = machine.start, 0
    for k, char in enumerate(spaced(text)):
        state, more = state[char]
        total += more
        if k:
            assert total == len(library.encode(text[:k])), text[:k]


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_maps_compose_in_any_grouping(library, machine, size):
    draw = random.Random(size)
    for text in [*texts(150, 40), "a" * 70, "abab" * 20]:
        maps = [machine.map_of(chunk, previous) for _, previous, chunk in chunks(spaced(text), size)]
        if not maps:
            continue
        done = machine.scan(maps)
        assert (done[-1].head, done[-1].count) == ("", len(library.encode(text)))
        while len(maps) > 1:  # any two neighbours
            k = draw.randrange(len(maps) - 1)
            maps[k:k + 2] = [machine.compose(maps[k], maps[k + 1])]
        assert maps[0].count == done[-1].count


def test_a_state_is_read_back_as_it_was(machine):
    state, _ = machine.run(machine.start, "▁representat")
    assert machine.read(state.text()) is state


def test_the_number_of_kept_transitions_is_bounded(library):
    with open(PIECES, "rb") as file:
        model = file.read()
    scores = Transducer.of_model(model)._scores
    small = Transducer(scores, kept=100)
    for text in texts(300):
        assert small.count(text) == len(library.encode(text))
    assert small._transitions < 1000


@pytest.mark.parametrize("options", [{}, {"long_chars": 100, "size": 7, "span": 3}, {"long_chars": 0, "size": 64, "span": 2}])
def test_counts_over_a_table(documents, library, options):
    rows = [*ODD, *((100 + k, text) for k, text in enumerate(LONG)), (200, "x " * 3000)]
    got = token_counts.counts(documents(rows), PIECES, limit=1000, **options)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 1000) for i, t in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_offsets_are_the_counts_of_prefixes(documents, library):
    text = "the cat sat on the mat, understanding representations " * 3
    got = token_counts.offsets(documents([(1, text), (2, None), (3, ""), (4, "aaaa" * 30)]), PIECES, size=10, span=2)
    by_id = {}
    for row in got.orderBy("doc_id", "chunk").collect():
        by_id.setdefault(row.doc_id, []).append((row.tokens_before, row.tokens_after))
    assert set(by_id) == {1, 4}
    for number, whole in ((1, text), (4, "aaaa" * 30)):
        ends = [len(library.encode(whole[:10 * k - 1])) for k in range(1, len(by_id[number]) + 1)]
        assert [after for _, after in by_id[number]] == ends
        assert [before for before, _ in by_id[number]] == [0, *ends[:-1]]


def test_an_empty_table(documents):
    assert token_counts.counts(documents([]), PIECES).collect() == []


def test_a_vocabulary_of_ones_own():
    # Merges in order of score, not longest match: "ab" is made before "bc".
    own = Transducer({"a": -9.0, "b": -9.0, "c": -9.0, "ab": -1.0, "bc": -2.0, "abc": -3.0, "ca": -4.0})
    assert [own.count(t) for t in ("abc", "bca", "cabc", "z", "é")] == [4, 5, 5, 4, 5]
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES
