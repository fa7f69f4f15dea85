"""Encoding, record files and packing against the tokenizers library."""

import random
import tempfile

import numpy as np
import plain
import pytest
from test_dedup import LONG, collected, corpus, frame

from tidewatch.llm import lexicon, packing, records, wordbpe
from tidewatch.llm.frames import scratch

PATH = wordbpe.public_tokenizers.path(wordbpe.VOCABULARY)
ODD = ["a", "B", "'", "s", "T", "é", "É", "́", "1", "²", " ", "\n", " ", "<|endoftext|>", "<|", "|>", "ß", "日", "😀", "‍", "\x1c",
       "!", ".", "İ", "ſ", "K", " ", "﻿", "\x00", "<|startoftext|>", "the", "ing", "'re"]


def odd_texts(n=3000):
    rnd = random.Random(n)
    return ["".join(rnd.choices(ODD, k=rnd.randrange(1, 30))) for _ in range(n)] + [None, "", LONG, "ab" * 2000, "x" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus(3))


@pytest.fixture(scope="module")
def rows():
    return corpus(3)


def test_word_encoder():
    encoder = wordbpe.Encoder()
    encoder.parts.size = 50  # generations pass
    for text in odd_texts():
        assert np.frombuffer(encoder.text(text), "<u4").tolist() == plain.ids(text), ascii(text)


@pytest.mark.parametrize("words", [[], ["the", "th", "thing", "things", "sing", "ing", "Ã©", "!", "'s", "a" * 40]])
def test_codec_with_any_lexicon(words):
    merges = lexicon.Merges(PATH)
    with tempfile.NamedTemporaryFile(suffix=".lexicon") as file:
        file.write(lexicon.compiled({w.encode(): merges(w) for w in words}))
        file.flush()
        codec = lexicon.Codec(file.name, PATH)
        for w in words:
            assert np.frombuffer(codec.lexicon(w.encode()), "<u4").tolist() == merges(w)
        assert codec.lexicon(b"thin") is None and codec.lexicon(b"zz") is None and codec.lexicon(b"") is None
        for text in odd_texts(800):
            ids = codec.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == plain.ids(text), ascii(text)
            assert codec.decode(ids) == plain.LIBRARY.decode(plain.ids(text), skip_special_tokens=False)


def test_lexicon_is_minimal():
    """States are as many as there are different sets of endings."""
    words = sorted({a + b + c for a in ("re", "un", "in") for b in ("do", "tell", "act") for c in ("", "s", "ing")})
    states = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    data = np.frombuffer(lexicon.compiled({w.encode(): [1] for w in words})[:28], "<u4")
    assert data[3] == len(states)


def test_lexicon_over_the_corpus(spark, rows, docs):
    got = lexicon.encode(docs, most=20)
    assert collected(got, "id", "ids") == sorted(((i, plain.binary(plain.ids(t))) for i, t in rows), key=repr)
    assert collected(lexicon.decode(got), "id", "text") == sorted(((i, plain.LIBRARY.decode(plain.ids(t), skip_special_tokens=False)) for i, t in rows), key=repr)
    assert lexicon.encode(frame(spark, [])).collect() == []


def test_records(spark, rows, docs):
    folder = scratch(spark)
    manifest = records.write_records(docs, folder)
    got = records.read_records(manifest, folder).collect()
    want = {(i, t): [*plain.ids(t), wordbpe.END] for i, t in rows}
    assert sorted((r["id"] is None, r["id"], bytes(r["ids"])) for r in got if r["id"] is not None) == sorted(
        (False, i, plain.binary(want[i, t])) for i, t in rows if i is not None)
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    assert [r["id"] is None for r in got] == sorted(r["id"] is None for r in got)
    named = [r["id"] for r in got if r["id"] is not None]
    assert named == sorted(named)
    assert [r["start"] for r in got] == np.cumsum([0, *(len(r["ids"]) // 4 for r in got)])[:-1].tolist()
    mixed = records.read_records(manifest, folder, seed=7).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, got)) and [r["start"] for r in mixed] != [r["start"] for r in got]
    assert records.read_records(records.write_records(frame(spark, []), scratch(spark)), folder).collect() == []


def test_damage_is_seen():
    whole = records.framed(b"abc") + records.framed(b"")
    assert list(records.unframed(whole)) == [b"abc", b""]
    for at in range(len(whole)):
        with pytest.raises((ValueError, Exception)):
            list(records.unframed(whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1:]))


def test_pieces_cover_every_id(spark, rows, docs):
    got = packing.pack(docs).collect()
    known = [(i, [*plain.ids(t), wordbpe.END]) for i, t in rows]
    found = sorted((repr(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    want = sorted((repr(i), at, len(own[at:at + 4096]), plain.crc(own[at:at + 4096]), len(own)) for i, own in known for at in range(0, len(own), 4096))
    assert found == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist()
        assert sum(n for _, n in own) <= 4096
    assert packing.pack(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_cutting_stock_is_near_the_bound(seed):
    rnd = random.Random(seed)
    counts = {s: rnd.choice([1, 7, 300, 90_000]) for s in rnd.sample(range(1, 257), [1, 5, 60, 120, 30, 2][seed])}
    plan = packing.cutting_stock(counts, 256)
    placed = {}
    for sizes, times in plan:
        assert sum(sizes) <= 256 and times > 0
        for s in sizes:
            placed[s] = placed.get(s, 0) + times
    assert placed == counts
    used = sum(times for _, times in plan)
    sizes = np.array(sorted(counts))
    demand = np.array([counts[s] for s in sizes.tolist()])
    _, amounts = packing.relaxed(sizes, demand, 256)
    assert used <= amounts.sum() + len(counts) + 1
    # No packing is better than the dual bound of the relaxed one.
    assert amounts.sum() >= (sizes * demand).sum() / 256 - 1e-6


def test_dearest_pattern_by_trying_all():
    sizes, prices = np.array([3, 5, 7]), np.array([0.31, 0.52, 0.75])
    best = max(a * 0.31 + b * 0.52 + c * 0.75 for a in range(7) for b in range(5) for c in range(4) if 3 * a + 5 * b + 7 * c <= 20)
    pattern = packing.dearest(prices, sizes, 20)
    assert pattern @ sizes <= 20 and abs(pattern @ prices - best) < 1e-9


def test_hot_class_over_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 5)
    rows = [(i, "same words here") for i in range(200)] + [(1000 + i, f"own {i} " * (i + 1)) for i in range(40)]
    got = packing.pack(frame(spark, rows)).collect()
    assert len(got) == len({(r["sequence_id"], r["offset"]) for r in got}) == 240


def test_short_texts_leave_little_padding(spark):
    """Empty texts are one token each, so thousands share a sequence; every piece is placed once, none over another."""
    rows = [(i, None if i % 2 else "") for i in range(5000)] + [(5000 + i, f"the tide of {i}") for i in range(1500)] + [(7000, "word " * 9000)]
    got = packing.pack(frame(spark, rows)).collect()
    assert len({(r["doc_id"], r["start"]) for r in got}) == len(got) and {r["doc_id"] for r in got} == {i for i, _ in rows}
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= packing.ROOM
    assert len(ends) <= 1 + -(-1.02 * sum(ends.values()) // packing.ROOM)
