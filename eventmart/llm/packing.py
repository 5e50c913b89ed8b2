"""Best-fit packing of token pieces into sequences of a fixed capacity, by minimum bin slack.

Each text becomes token ids and an end id; only what is longer than the capacity is cut. A bin starts with the
longest piece left; a bitset subset-sum program over the lengths still available finds the fullest combination that
fits beside it, and the combination is removed. Which pieces of a length are taken makes no difference, so the
program runs on the number of pieces per length (at most ``capacity`` numbers), and a combination is taken as
often as its lengths last: it is what the rule would find again. The plan's size thus depends on the capacity and
not on the number of documents. Spark makes and counts the pieces, numbers those of a length without gaps (a frequent
length in many parts), and each piece finds its place in the plan by its length and number.

Null and empty texts are one end id. Repeated rows are packed once each. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import gapless, stored

# Words, and their letters alone, that a worker has encoded or used since it last forgot some; as many are kept from before that.
# At most about 60 MB together.
_KEPT_WORDS = 50_000
_KEPT_STEMS = 90_000
_KEPT_MARKS = 10_000
_TEXTS = 256  # texts that are Python objects at a time
_KEPT_LENGTH = 40  # longer words are encoded each time
_RANK_BITS = 48
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&|]*)")
_PROBES = ["the", "The,", "été", "Über!!", "ÇÀ.", "straße", "x?", "ñ$$$", "QUE!!", "ÿ", "anhation"]


class WordEncoder:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit numbers, from those of their words.

    For tokenizers that drop white space and never merge across it: a text cut at spaces and line feeds has the
    ids of its parts, in order. Other white space stays within the parts, for the tokenizer. Words of Latin
    letters and punctuation have the ids of their letters in lower case and of their marks, which go straight to the
    tokenizer's model; that is tried out on a few words first. What was not used for long is forgotten, so
    frequent words are learned once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x80, 0x100) if _PLAIN.fullmatch(chr(c))]
        self.bytes = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in letters}
        self.marks: dict[str, bytes] = {"": b""}
        self.kept: dict[str, bytes] = {}
        self.kept_before: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.stems_before: dict[str, bytes] = {}
        if self._by_tokenizer(["to be"]) != [b"".join(self._by_tokenizer(["to", "be"]))]:
            raise ValueError(f"the tokenizer of {path} does not drop white space")
        self.direct = self._by_tokenizer(_PROBES) == [self._by_model(*_PLAIN.fullmatch(p).groups()) for p in _PROBES]

    def _by_tokenizer(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _modelled(self, token: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(token)]).tobytes()

    def _by_model(self, letters: str, marks: str) -> bytes:
        stem = letters.lower()
        ids = self.stems.get(stem)
        if ids is None:
            ids = self.stems_before.get(stem) or self._modelled(stem if stem.isascii() else stem.translate(self.bytes))
            if len(stem) <= _KEPT_LENGTH:
                self.stems[stem] = ids
        if marks not in self.marks:
            if len(marks) > _KEPT_LENGTH or len(self.marks) > _KEPT_MARKS:
                return ids + self._modelled(marks)
            self.marks[marks] = self._modelled(marks)
        return ids + self.marks[marks]

    def _learn(self, words: set[str]) -> None:
        rest = []
        for word in words:
            if self.direct and (plain := _PLAIN.fullmatch(word)):
                self.kept[word] = self._by_model(*plain.groups())
            else:
                rest.append(word)
        if rest:
            self.kept.update(zip(rest, self._by_tokenizer(rest), strict=True))
        if len(self.stems) > _KEPT_STEMS:
            self.stems_before, self.stems = self.stems, {}

    def __call__(self, text: str) -> bytes:
        parts = text.replace("\n", " ").split(" ")
        if missing := set(parts).difference(self.kept):
            known = {word: self.kept_before[word] for word in missing if word in self.kept_before}
            self.kept.update(known)
            self._learn(missing.difference(known))
        ids = b"".join(map(self.kept.__getitem__, parts))
        for word in missing:
            if len(word) > _KEPT_LENGTH:
                self.kept.pop(word)
        if len(self.kept) > _KEPT_WORDS:
            self.kept_before, self.kept = self.kept, {}
        return ids


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder; what it remembers serves all tasks of the worker."""
    return WordEncoder(path)


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32, and the ids where asked for."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())][: len(names)]
        for batch in batches:
            for first in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(first, _TEXTS)
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    ids = encode(text.as_py() or "") + end
                    for i, at in enumerate(range(0, len(ids) // 4, capacity)):
                        piece = ids[4 * at : 4 * (at + capacity)]
                        row = (doc_id, i, at, len(piece) // 4, zlib.crc32(piece))
                        rows.append(row + (np.frombuffer(piece, "<u4").astype(np.int64),) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def fullest(available: list[tuple[int, int]], room: int) -> list[int]:
    """Lengths with the largest sum up to ``room``; ``available`` holds (length, number), longest first."""
    reached, steps = 1, []
    mask = (1 << (room + 1)) - 1
    full = 1 << room
    for length, number in available:
        for _ in range(min(number, room // length)):
            more = (reached | (reached << length)) & mask
            if more == reached:
                break
            steps.append((length, reached))
            reached = more
        if reached & full:
            break
    target, taken = reached.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> target & 1:
            taken.append(length)
            target -= length
    return taken


def plan(numbers: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Combinations of lengths, each with the number of sequences it fills."""
    left = {length: n for length, n in sorted(numbers.items(), reverse=True) if n}
    found = []
    while left:
        longest = next(iter(left))
        room = capacity - longest
        rest = [(length, n - (length == longest)) for length, n in left.items() if length <= room]
        combination = Counter([longest, *fullest(rest, room)])
        times = min(left[length] // n for length, n in combination.items())
        found.append((combination, times))
        for length, n in combination.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return found


def places(combinations: list[tuple[Counter, int]]) -> np.ndarray:
    """Per length and run of piece numbers: key of the first, first sequence, pieces a sequence, first offset."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for combination, times in combinations:
        offset = 0
        for length, n in combination.items():
            rows.append(((length << _RANK_BITS) + used[length], sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces; ``cut`` is read several times, so it should be stored."""
    numbers = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(places(plan(numbers, capacity)))  # bounded by the capacity
    numbered = gapless(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts, sequences, group, offsets = table.value.T
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch.pop("_rank").to_numpy()
            key = (length << _RANK_BITS) + rank
            at = np.searchsorted(firsts, key, side="right") - 1
            nth = key - firsts[at]
            batch["sequence_id"] = sequences[at] + nth // group[at]
            batch["offset"] = offsets[at] + nth % group[at] * length
            yield batch

    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes) + ", sequence_id long, offset long"
    return numbered.mapInPandas(place, schema)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Documents cut into pieces and packed: one row per piece with its sequence and its place there."""
    return pack(stored(pieces(documents, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces packed with their ids; a sequence holds at most ``capacity``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
