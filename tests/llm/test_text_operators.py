import hashlib
import io
import math
import re
import zlib

import numpy as np
import plain
import public_tokenizers
import pytest
import tiktoken
from llm_helpers import ODD, TEXT

from tallyhouse.llm import bpe, decontaminate, fingerprint, lattice_lm, pii, toxicity, warc
from tallyhouse.llm.queries import PATTERN, PIECES, RANKS

ROWS = [*ODD, (20, TEXT), (21, TEXT + TEXT), (22, "Ünïcode ſtraße 漢字 " * 20)]


# ---- benchmark decontamination ---------------------------------------------------------------------------------------

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs far away"), (2, "One, two: THREE"), (3, ""), (4, None), (5, "lazy dog"),
         (6, "straße"), (5, "lazy dog"), (None, "noise of the town"), (10, "word word word word word word word word word word")]


@pytest.mark.parametrize("shard_words", [200_000, 5])
def test_decontamination_equals_the_plain_version(spark, documents, shard_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    named = [(n, t) for n, t in ITEMS if n is not None]
    rows = [(i, t if t is None else t[:3000]) for i, t in ROWS]
    want = plain.contamination(rows, named, 10)
    got = decontaminate.report(documents(rows), items.filter("item_id IS NOT NULL"), shard_words=shard_words).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    # Items without an id are looked for, but not named.
    hit = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.report(documents([(1, "the noise of the town")]), items).collect()}
    assert hit == {1: (4, 0)}


def test_clean_cuts_spans_and_drops_covered_documents(spark, documents):
    items = spark.createDataFrame([(1, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11")], "item_id long, text string")
    passage = "A1, a2 a3 a4 a5 a6 a7 a8 a9 a10 a11"
    table = documents([(1, f"x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12. {passage}! end"), (2, passage), (3, "clean text é"), (4, None), (5, "")])
    kept = decontaminate.clean(table, items)
    assert kept.columns == table.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {
        1: "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12. ! end", 3: "clean text é", 4: None, 5: ""}


def test_clean_finds_and_cuts_in_one_worker(spark, documents, capsys, monkeypatch):
    # Two Python steps in a row hold two workers for each task, and idle workers stay beside those of later stages.
    items = spark.createDataFrame([(1, "the noise of the town where the road ends by old mill"), (2, "short one")], "item_id long, text string")
    rows = [(k, f"lead {k} the noise of the town where the road ends by old mill and then a tail that goes on for some more words") for k in range(30)]
    table = documents([*rows, (98, "short one"), (99, None)])
    kept = decontaminate.clean(table, items)
    kept.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    whole = sorted(map(str, kept.collect()))
    assert len(whole) == 31 and not any("noise" in x for x in whole)
    # Text by text, and by several automata one after the other, the same comes out.
    monkeypatch.setattr(decontaminate, "_TEXT_BYTES", 1)
    assert sorted(map(str, decontaminate.clean(table, items).collect())) == whole
    assert sorted(map(str, decontaminate.clean(table, items, shard_words=4).collect())) == whole


def test_no_items_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.report(documents([(1, TEXT)]), none).collect()] == [0]
    assert decontaminate.report(documents([]), none).collect() == []


# ---- byte-level BPE --------------------------------------------------------------------------------------------------

def test_bpe_equals_the_library_and_decodes(documents):
    rows = [*ROWS, (30, "<|endoftext|> it's  two   spaces\n\n\nlines " * 9000), (31, "9" * 150_000 + " x" * 80_000)]
    coder = bpe.Coder(bpe.read_ranks(RANKS), PATTERN)
    got = bpe.digests(documents(rows), RANKS, PATTERN).collect()
    want = []
    for i, t in rows:
        ids = coder._encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert isinstance(coder._encoding, tiktoken.Encoding)


def test_bpe_roundtrip_columns(documents):
    table = documents([(1, TEXT), (2, None), (3, "漢字")])
    back = bpe.decode(bpe.encode(table, RANKS, PATTERN), RANKS, PATTERN)
    assert back.columns == [*table.columns, "token_ids", "decoded"]
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {1: TEXT, 2: "", 3: "漢字"}
    assert bpe.digests(documents([]), RANKS, PATTERN).collect() == []


def test_pieces_end_where_no_match_crosses():
    text = "word's  and   more\n\n text!? 12 " * 50
    for size in (1, 7, 40):
        parts = list(bpe.pieces(text, size))
        assert "".join(parts) == text
        assert [m for p in parts for m in re.findall(r"'s| ?[a-z]+| ?[0-9]+| ?[^\sa-z0-9]+|\s+(?!\S)|\s+", p)] == re.findall(r"'s| ?[a-z]+| ?[0-9]+| ?[^\sa-z0-9]+|\s+(?!\S)|\s+", text)


# ---- fingerprints ----------------------------------------------------------------------------------------------------

def test_fingerprints(documents):
    rows = [r for r in ODD if r[0] is not None and r[0] not in (12, 14)] + [(k, f"{TEXT}{k} " * 4) for k in range(50, 70)] + [(90, TEXT * 9)]
    got = {r.doc_id: r for r in fingerprint.report(documents(rows)).collect()}
    order = sorted(rows)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for value, other in ((row.near_edited, edited), (row.near_next, after)):
            a, b = (({tuple(w[x:x + 5]) for x in range(max(len(w) - 4, 1))} if w else set()) for w in (plain.SPLIT.findall(x) for x in (t, other)))
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(value - true) < 0.17 and 0 <= value <= 1
    assert got[5].fingerprint == got[6].fingerprint == got[7].fingerprint == ""
    assert fingerprint.report(documents([])).collect() == []


def test_fingerprints_of_odd_ids(documents):
    got = fingerprint.report(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert len({r.fingerprint for r in got if r.doc_id == 12}) == 1
    alone = fingerprint.report(documents([(1, TEXT)])).collect()[0]
    assert alone.near_next == 1.0 and len(alone.fingerprint) == fingerprint.BINS * fingerprint.BITS // 4


# ---- personal data ---------------------------------------------------------------------------------------------------

def base_plain(text):
    out = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0:
            out.append(f"card:{m.start()}:{m.end()}")
    return out + [f"phone:{m.start()}:{m.end()}" for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


PERSONAL = [f"call +1 (8{k}3) 555-76{k}2 or write to ann{k}.lee@mail{k}.example.com from 10.0.{k}.{3 * k} and pay 4111111111111111 in 20{k} now" for k in range(10, 40)]


def test_pii_base_spans_and_additions(documents):
    rnd = np.random.default_rng(3)
    noise = ["".join(rnd.choice(list("01.2@a+- ()9b%"), 60)) for _ in range(300)]
    rows = [*ODD, *enumerate(PERSONAL, 100), *enumerate(noise, 200), (900, "please mail bob.ray [at] host [dot] example now"), (901, "4.5 of 120 in 1999")]
    got = {(r.doc_id, r.spans, r.base_sha256): r for r in pii.report(documents(rows)).collect()}
    assert len({k[0] for k in got}) == len({i for i, _ in rows})
    texts = dict(rows)
    for (i, spans, digest), row in got.items():
        base = base_plain(texts[i] or "") if i not in (14,) else []
        assert digest == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(spans.split(",")) | {""}
        assert row.n_email + row.n_ip + row.n_card + row.n_phone == len(base)
    assert [k[1] for k in got if k[0] == 901] == [""]
    masked = {r.doc_id: r.text for r in pii.mask(documents([(1, PERSONAL[0]), (2, None), (3, "nothing here")]), field=pii.Field()).collect()}
    assert masked == {1: "call [PHONE] or write to [EMAIL] from [IP] and pay [CARD] in 2010 now", 2: None, 3: "nothing here"}
    assert pii.report(documents([])).collect() == []


def test_field_learns_whole_segments():
    field = pii.Field()
    field.weights[:, 0] = -4.0
    field.fit([x for t in PERSONAL for x in pii.examples(t)])
    def found(text):
        return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.all_spans(text, field)[1]]
    assert found("write to tom.fox (at) mail (dot) example please") == [("email", "tom.fox (at) mail (dot) example")]
    assert found("chapter 12 of 300 pages, 3.5 points in 2019") == []
    stretch = next(pii.stretches("at 10[.]0[.]0[.]9 ok"))
    sure, _ = field.marginals(stretch)
    assert ((sure >= 0) & (sure <= 1 + 1e-9)).all()


# ---- language model --------------------------------------------------------------------------------------------------

def test_lattice_equals_all_segmentations():
    weights = {"</s>": 0.1, "▁": 0.1, "▁a": 0.15, "a": 0.1, "b": 0.1, "ab": 0.2, "▁ab": 0.2, "<0xC3>": 0.02, "<0xA9>": 0.03}
    lattice = lattice_lm.Lattice(weights)

    def every(text):
        return 1.0 if not text else sum(weights[text[:k]] * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in weights)

    for word in ("a", "ab", "abab", "baab"):
        assert math.isclose(lattice.word(word.encode()), math.log(every("▁" + word)))
    assert math.isclose(lattice.word("é".encode()), math.log(0.1 * 0.02 * 0.03))
    assert math.isclose(lattice.word(b"a" * 5000) / 5000, lattice.word(b"a" * 10_000) / 10_000, rel_tol=1e-2)
    sums = {}
    lattice.expected(b"abab", 3, sums)
    assert math.isclose(sum(len(p.encode()) * n for p, n in sums.items()), 3 * len("▁abab".encode()))


@pytest.mark.parametrize("part", [4096, 5])
def test_expectation_goes_over_whole_long_words(monkeypatch, part):
    monkeypatch.setattr(lattice_lm, "_PART", part, raising=False)
    weights = {"</s>": 0.1, "▁": 0.1, "▁a": 0.15, "a": 0.1, "b": 0.1, "ab": 0.2, "bab": 0.3, "▁ab": 0.2, "<0xC3>": 0.02, "<0xA9>": 0.03}
    lattice = lattice_lm.Lattice(weights)

    def every(text):
        if not text:
            yield 1.0, ()
        for k in range(1, min(len(text), 3) + 1):
            if text[:k] in weights:
                yield from ((weights[text[:k]] * w, (text[:k], *rest)) for w, rest in every(text[k:]))

    word, expected = "ab" * 9, {}
    ways = list(every("▁" + word))
    for w, pieces in ways:
        for p in pieces:
            expected[p] = expected.get(p, 0.0) + 3 * w / sum(x for x, _ in ways)
    sums = {}
    lattice.expected(word.encode(), 3, sums)
    assert sums.keys() == expected.keys()
    assert all(math.isclose(sums[p], n) for p, n in expected.items())
    # No underflow, and letters without a piece are spelled.
    sums = {}
    lattice.expected("é".encode() * 9000 + b"ab", 2, sums)
    assert math.isclose(sums["<0xC3>"], 18_000) and math.isclose(sums["<0xA9>"], 18_000)


@pytest.mark.parametrize("at_once, laid_out", [(1 << 16, 1 << 16), (40, 3)])
def test_words_side_by_side_equal_words_by_themselves(monkeypatch, at_once, laid_out):
    monkeypatch.setattr(lattice_lm, "_AT_ONCE", at_once)
    monkeypatch.setattr(lattice_lm, "_LAID_OUT", laid_out)
    lattice = lattice_lm.Lattice(lattice_lm.read_pieces(PIECES))
    texts = ["the", "a", "straße", "漢字" * 9, "a\x00b", "x" * 63, "y" * 64, "z" * 5000, "é\U0001F600" * 30, "unbelievable", "thé", "quickly", "▁▁a", "\U000E0041" * 15]
    words, times = [*(t.encode() for t in texts), b"\xff\xfe", b"a\xf0\x9f"], [k + 1.0 for k in range(len(texts) + 2)]
    side = lattice_lm.SideBySide(lattice)
    assert np.allclose(side.logs(words), [lattice.word(w) for w in words], rtol=1e-12)
    want: dict = {}
    for w, n in zip(words, times):
        lattice.expected(w, n, want)
    got = side.expected(words, times)
    assert all(math.isclose(got.get(p, 0.0), n, rel_tol=1e-9, abs_tol=1e-100) for p, n in want.items()) and got.keys() <= want.keys()
    assert len(side.logs([])) == 0 and side.expected([], []) == {}


def test_improbable_short_words_are_counted_whole(documents):
    """Fifteen letters of four byte pieces each: less likely than the least double."""
    lattice = lattice_lm.Lattice(lattice_lm.read_pieces(PIECES))
    word, sums = "\U000E0041" * 15, {}
    lattice.expected(word.encode(), 3, sums)
    assert math.isclose(sum(n for p, n in sums.items() if p.startswith("<0x")), 3 * 15 * 4)
    rows = lattice_lm.report(documents([(k, f"{word} and more") for k in range(9)]), PIECES).collect()
    assert len(rows) == 9 and all(math.isfinite(r.score) for r in rows)


def test_names_of_the_end_and_of_byte_pieces_are_plain_text():
    weights = {"</s>": 0.3, "▁": 0.1, "<": 0.1, "/": 0.1, "s": 0.1, ">": 0.1, "0": 0.1, "x": 0.05, "1": 0.05, "<0x11>": 0.2}
    lattice = lattice_lm.Lattice(weights)
    for word in ("</s>", "<0x11>"):
        want = math.prod(weights[c] for c in "▁" + word)
        assert math.isclose(lattice.word(word.encode()), math.log(want))
        assert math.isclose(lattice_lm.SideBySide(lattice).logs([word.encode()])[0], math.log(want))
        sums = {}
        lattice.expected(word.encode(), 1, sums)
        assert word not in sums


def test_language_model_report(documents):
    rows = [(k, f"{TEXT}{k} new{k % 7} words") for k in range(60)] + [(100, None), (101, ""), (102, "x" * 5000), (103, "漢字 " * 10)]
    got = {r.doc_id: r for r in lattice_lm.report(documents(rows), PIECES).collect()}
    words = {i: [w.encode() for w in plain.SPLIT.findall(plain.ascii_lower(t or ""))] for i, t in rows}
    train = [i for i in words if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = {}
    for i in train:
        for w in words[i]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for i, own in words.items():
        row = got[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (i not in train, len(own) + 1, n)
        assert row.n_known == sum(w in counts for w in own) + 1
        want = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts.get(w, 0) for w in own), len(train)])
        assert math.isclose(row.base_score, want, rel_tol=1e-9)
        assert row.score < 0 and math.isfinite(row.score)
    assert len(lattice_lm.report(documents(ODD), PIECES).collect()) == len(ODD)
    assert lattice_lm.report(documents([]), PIECES).collect() == []


# ---- toxicity --------------------------------------------------------------------------------------------------------

def test_toxicity_generalises_and_ignores_held_out_labels(spark, documents):
    rng = np.random.default_rng(1)
    calm, harsh = [f"calm{k}" for k in range(300)], [f"harsh{k}" for k in range(12)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        text = list(rng.choice(calm, 40)) + (list(rng.choice(harsh, 4)) if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        held = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, 1, int(bad) if not held else 1 - int(bad)))  # wrong on purpose where they must not be read
    rows += [(2000, None), (2001, ""), (2002, "z " * 20_000)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.report(documents(rows), table).collect()}
    assert len(got) == len(rows)
    right = [got[i].predicted == int(i % 5 == 0) for i in range(900) if got[i].held_out]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[2000].score == got[2001].score and got[2000].predicted == 0
    kept = toxicity.keep_clean(documents(rows), table)
    assert kept.columns == documents([]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_toxicity_sample_has_one_row_of_an_id(spark, documents):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT][:6]
    rows = [(ids[0], f"text {k}") for k in range(50)] + [(ids[0], None)] + [(i, f"of {i}") for i in ids[1:]]
    table = spark.createDataFrame([(i, int(i == ids[0])) for i in ids], "doc_id long, toxic int")
    for bound in (100, 4):
        got = toxicity.labelled_sample(documents(rows).repartition(3), table, "doc_id", "text", "toxic", bound).collect()
        assert len(got) == len({r._id for r in got}) == min(bound, len(ids))
        assert {(r._id, r._text) for r in got} <= set(rows)


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.report(documents(ODD), none).collect()} == {0.0}
    assert toxicity.report(documents([]), none).collect() == []


def test_label_model_shares_the_weight_of_copied_voters():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.3
    def voter(right):
        return np.where(rng.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    one, two, weak = voter(0.9), voter(0.85), voter(0.7)
    votes = np.stack([one, two, weak, weak, weak], axis=1)
    model = toxicity.LabelModel.fitted(votes, np.where(rng.random(4000) < 0.9, truth, ~truth))
    assert model.weight[2:].max() < 0.7 * model.weight[0]
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.8


# ---- web archives ----------------------------------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string")


def test_warc_roundtrip(spark):
    long, short = "<p>é</p>" * 30, "<p>x</p>"
    rows = [(5, "http://a\r\nWARC-Type: evil", long, "", ""), (3, "http://b", long, "", ""), (9, None, long, "", ""), (1, "u", short, "", ""), (2, "u", short, "", ""),
            (7, "u", None, "", ""), (8, "u", "", "", ""), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 9000, "", "")]
    got = {r.page_id: r for r in warc.roundtrip(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        first = 3 if html == long and i != 3 else None
        assert (got[i].record_type, got[i].refers_to) == ("revisit" if first else "response", first)
    assert warc.roundtrip(pages(spark, [])).collect() == []


def test_warc_odd_ids(spark):
    long = "y" * 200
    got = warc.roundtrip(pages(spark, [(None, "a", long, "", ""), (4, "b", long, "", ""), (4, "c", long, "", ""), (6, "d", long, "", "")])).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in got) == [
        ("4", "revisit", "None"), ("4", "revisit", "None"), ("6", "revisit", "None"), ("None", "response", "None")]


def test_reader_rejects_damaged_archives():
    body = b"payload " * 40
    digest = hashlib.sha256(body).hexdigest()
    good = warc.write_record(1, "u", body, digest, None) + warc.write_record(2, "u", body, digest, 1)
    read = list(warc.read_records(io.BytesIO(good)))
    assert [f["warc-type"] for f, _ in read] == ["response", "revisit"] and read[0][1] == body and read[1][1] == b""
    plainly = zlib.decompress(warc.write_record(1, "u", body, digest, None), 31)

    def member(data):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()

    for bad in (good[:-5], member(plainly.replace(b"payload payload", b"payload Payload")), member(plainly[:-4]), member(b"no header"),
                member(plainly.replace(b"Content-Length: ", b"Content-Lengths: ")), b"not gzip at all"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


def test_tokenizer_files_are_not_in_the_package():
    assert public_tokenizers.path("byte_bpe_multi_50k.tiktoken") == RANKS
