from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventmart.llm import packing
from tests.llm.rows import documents, documents_df

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "", " ", "\n\n", "a\x1cb  c", "x y z\x85w", "I'LL  don't\t<|endoftext|>foo", "ΑΣ ΣΑΣ İ", "é ́a", "12 a1b2",
    "漢字 テスト 😀!!??", "Über!! ÇÀ. ÿ ß ª µ", "a" * 3000,
])
def test_words_encode_like_the_text(tokenizer, text):
    ids = np.frombuffer(packing.encoder(PATH)(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "_KEPT_WORDS", 5)
    encode = packing.WordEncoder(PATH)
    for text in ("a b c d", "e f g h", "a b c d e f g h i j"):
        assert encode(text) == packing.encoder(PATH)(text)


def test_fullest_is_the_best_subset():
    r = random.Random(5)
    for _ in range(200):
        lengths = [r.randint(1, 40) for _ in range(r.randint(0, 9))]
        room = r.randint(0, 80)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= room)
        found = packing.fullest(sorted(Counter(lengths).items(), reverse=True), room)
        assert sum(found) == best
        assert not Counter(found) - Counter(lengths)


def test_a_plan_uses_every_piece_once():
    r = random.Random(6)
    numbers = Counter(r.randint(1, 64) for _ in range(500))
    found = packing.plan(dict(numbers), 64)
    used = Counter()
    for combination, times in found:
        assert sum(l * n for l, n in combination.items()) <= 64
        used.update({l: n * times for l, n in combination.items()})
    assert used == numbers
    assert sum(t for _, t in found) <= 1.02 * sum(l * n for l, n in numbers.items()) / 64


def test_pieces_and_places(spark, tokenizer):
    capacity = 64
    packed = packing.pack_documents(documents_df(spark), PATH, capacity, with_ids=True)
    rows = packed.collect()
    expected = Counter()
    for doc_id, text, *_ in documents():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[(doc_id, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.02 * total / capacity + 1
    assert sum(len(r["ids"]) for r in packing.sequences(packed).collect()) == total


def test_empty(spark):
    assert packing.pack_documents(documents_df(spark, []), PATH).collect() == []


def test_what_is_in_use_is_not_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "_KEPT_WORDS", 20)
    encode, learned = packing.WordEncoder(PATH), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda words: (learned.extend(words), learn(words)))
    letters = "abcdefghijklmnop"
    for first, second in itertools.product(letters, letters):
        text = f"always there, {first}x{second}"
        assert encode(text) == packing.encoder(PATH)(text)
    assert learned.count("always") == learned.count("there,") == 1
    assert len(learned) == 2 + len(letters) ** 2
    assert len(encode.kept) + len(encode.kept_before) <= 2 * 20 + 3
