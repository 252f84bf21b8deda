"""Packing: ids against the tokenizer itself, pieces and places against the contract, counts against bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telemill.llm import packing

TEXT = ["", " ", "  ", "\n", "\t", "a", "é", "'s", "1", "中", "!", " ", "　", "\x1c", " ", "<|endoftext|>", "foo", "\r", "\u0085", "​", "²", "ª", "'", "S"]


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.TOKENIZER)


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_of_whole_texts(encoder, documents, monkeypatch):
    texts = [r.text or "" for r in documents.collect()]
    rng = random.Random(1)
    texts += ["".join(rng.choices(TEXT, k=rng.randint(0, 30))) for _ in range(5_000)]
    want = [np.array(plain(encoder, t)[:-1], "<u4").tobytes() for t in texts]
    assert [encoder(t) for t in texts] == want
    monkeypatch.setattr(packing, "STEP", 7)
    monkeypatch.setattr(packing, "CACHED", 50)
    assert [encoder(t) for t in texts] == want


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_of_any_text(text):
    if "e" not in CACHE:
        CACHE["e"] = packing.Encoder(packing.TOKENIZER)
    assert CACHE["e"](text) == CACHE["e"].encode(text)


CACHE = {}


def check(rows, docs, encoder, capacity=2048):
    """Pieces, lengths and checksums of every document; no gap and no overflow in any sequence."""
    want, got, places = [], [], defaultdict(list)
    for doc_id, text in docs:
        ids = plain(encoder, text)
        cut = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    for r in rows:
        got.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_documents(spark, documents, encoder):
    rows = packing.pack_documents(documents).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    n = check(rows, docs, encoder)
    lengths = np.array([r.length for r in rows])
    assert packing.lower_bound(lengths, 2048) <= n <= packing.lower_bound(lengths, 2048) + 1
    assert n == len(packing.best_fit(sorted(lengths.tolist(), reverse=True), 2048)[2])


def test_parts_exchange_pieces(spark, monkeypatch, encoder):
    """Many small parts leave gaps; what they exchange brings the count near that of one part."""
    docs = [(i, " ".join(["word"] * (100 + i * 7919 % 1500))) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(packing, "PART", 10)
    pieces = packing.tokenized_pieces(frame)
    alone = packing.pack_pieces(pieces, part=10, most=10).select("sequence_id").distinct().count()
    n = check(packing.pack_pieces(pieces, part=10, most=1_000).collect(), docs, encoder)
    lengths = [r.length for r in pieces.collect()]
    whole = len(packing.best_fit(sorted(lengths, reverse=True), 2048)[2])
    assert packing.lower_bound(np.array(lengths), 2048) <= n <= whole + 2 and n < alone


def exact(lengths, capacity):
    """Fewest bins, by trying everything."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i] and rooms[j] not in rooms[:j]:
                go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_bound_is_never_above_the_fewest():
    rng = random.Random(2)
    met = 0
    for _ in range(400):
        capacity = rng.choice([10, 12, 30, 64])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        fewest, bound = exact(lengths, capacity), packing.lower_bound(np.array(lengths), capacity)
        bins, offsets, left = packing.best_fit(lengths, capacity)
        assert bound <= fewest <= len(left)
        met += bound == fewest
    assert met > 350 and packing.lower_bound(np.zeros(0, np.int64), 10) == 0
    # two of three do not fit together, though their sum would need only two sequences
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3


def test_best_fit_takes_the_tightest():
    assert packing.best_fit([6, 5, 4, 4, 1], 10)[:2] == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 9])


def test_odd_rows(spark, odd_documents, encoder):
    rows = packing.pack_documents(odd_documents).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_documents.collect()], encoder)
    assert packing.pack_documents(odd_documents.limit(0)).count() == 0
    big = "x" * 30_000 + " " + " ".join(f"w{i}" for i in range(60_000))
    same = spark.createDataFrame([(1, big), (1, big), (2, None), (2, "")] + [(3, "one row")] * 50, "doc_id long, text string")
    check(packing.pack_documents(same).collect(), [(r.doc_id, r.text) for r in same.collect()], encoder)
    assert set(packing.pack_documents(same.withColumn("row", same["text"])).columns) >= {"doc_id", "sequence_id", "offset"}


def test_other_sequences_and_tokenizers(spark, documents, tmp_path):
    """A file by its path, and one that isn't byte-level, which gets whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = documents.limit(20)
    word = packing.Encoder("word_bpe_49k.json")
    assert not word.by_words
    text = docs.first().text
    assert word(text) == np.array(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 100).collect()
    assert max(r.length for r in got) == 100 and max(r.offset + r.length for r in got) <= 100
