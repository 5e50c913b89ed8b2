"""Phrase collocations by double-array tries.

The texts are read twice, whatever there is in them. First words are counted. Those that are frequent are numbered and put into
double-array tries over the bytes of language and word; these are broadcast, every task advances the states of all its text
positions together, byte level by byte level, and notes the word of the states that accept. No phrase can be frequent whose
words are not, so runs of frequent words are all there is to look at. Of these a task takes the phrases of all lengths, adds up
equal ones and deals them by their hash to parts, of which there are as many as words ask for.

A part first bins its phrases by hash; no phrase can be frequent whose bin is not. The others are candidates and put into
double-array tries over the bytes of their words' numbers. All that was dealt to the part is advanced together, the states that
accept are binned, and the counts reported are those. Phrases remain numbers until the best are known.

A trie of words is built from about ``TRIE_BYTES`` of them and never has more than ``TRIE_SLOTS`` slots (else its words are
halved). Tries of ``SCAN_SLOTS`` slots together are broadcast for one scan; more words take more scans, each of which goes on
where the one before stored its texts. Texts are read in blocks of about ``BLOCK`` bytes whatever their length, and a
task keeps a bounded number of words before it passes them on.

Null texts are empty, a null language is ``und``. Repeated rows count each. Words separated by blanks or tabs are one blank apart
in a phrase. Ties are broken as the query says, so results do not depend on the order of rows. Empty tables give empty
results. Of the documents only ``lang`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
#: A candidate inside a longer one that occurs this many hundredths as often is dropped.
INSIDE = 50

TRIE_BYTES = 1 << 23
TRIE_SLOTS = 1 << 25
SCAN_SLOTS = 1 << 24
BLOCK = 1 << 20
_KEPT = 100_000
#: Words after which a task passes on its phrases; words of a language for which there is a part.
_HELD = 1 << 21
_PART = 1 << 20
_CUTS = 64

_WORDS = "lang string, phrase string, n long"
_READ = "lang string, text binary, own int, numbers binary"
_DEALT = "lang string, size int, part int, phrases binary, counts binary"
_FOUND = "lang string, size int, phrase binary, n long"
_BLANK, _BREAK = 0x20, 0x0A
# A-Z to lower case, tab to blank, and what ends a piece to a line feed.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")


class Trie:
    """Double-array trie: ``base[state] + code`` is the next state if its ``check`` is the state.

    Bytes are renamed to codes, frequent ones first. Nodes with several children get spans of slots side by side, from their
    smallest to their largest code; the only children of the others fill what these leave free, then slots behind.
    """

    def __init__(self, keys: pa.Array):
        self.keys = keys = keys.take(pc.sort_indices(keys))
        lengths = pc.binary_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.frombuffer(keys.buffers()[2], np.uint8)[: lengths.sum()]
        frequency = np.bincount(text, minlength=256)
        used = int((frequency > 0).sum())
        self.codes = np.zeros(256, np.int32)  # 0: in no key
        self.codes[np.argsort(-frequency, kind="stable")[:used]] = np.arange(1, used + 1)
        parent, code, node_of = self._nodes(text, lengths)
        slot = self._place(parent, code)
        self.accepting = np.full(self.base.size, -1, np.int32)
        self.accepting[slot[node_of]] = np.arange(len(keys))

    def _nodes(self, text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parent and code of every node, the root first, and the node where each of the sorted keys ends."""
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        at = np.zeros(lengths.size, np.int32)
        parents, codes, count, depth = [np.zeros(1, np.int32)], [np.zeros(1, np.int32)], 1, 0
        live = np.flatnonzero(lengths > 0)
        while live.size:
            letters = self.codes[text[begin[live] + depth]]
            new = np.ones(live.size, bool)
            new[1:] = (at[live[1:]] != at[live[:-1]]) | (letters[1:] != letters[:-1])
            parents.append(at[live[new]])
            codes.append(letters[new])
            at[live] = count + np.cumsum(new) - 1
            count += int(new.sum())
            depth += 1
            live = live[lengths[live] > depth]
        return np.concatenate(parents), np.concatenate(codes), at

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots of all nodes; sets base and check."""
        n = parent.size
        children = np.bincount(parent[1:], minlength=n)
        branching = np.flatnonzero(children > 1)
        low, high = np.full(n, 256, np.int32), np.zeros(n, np.int32)
        np.minimum.at(low, parent[1:], code[1:])
        np.maximum.at(high, parent[1:], code[1:])
        low, high = low[branching], high[branching]
        spans = (high - low + 1).astype(np.int64)
        starts = 1 + np.concatenate([[0], np.cumsum(spans)])
        base = np.zeros(n, np.int64)
        base[branching] = starts[:-1] - low
        slot = np.zeros(n, np.int64)
        shared = np.flatnonzero(children[parent[1:]] > 1) + 1
        slot[shared] = base[parent[shared]] + code[shared]
        free = np.ones(int(starts[-1]), bool)
        free[0] = False
        free[slot[shared]] = False
        lone = np.flatnonzero(children[parent[1:]] == 1) + 1
        holes = np.flatnonzero(free)[: lone.size]
        slot[lone] = np.concatenate([holes, starts[-1] + np.arange(lone.size - holes.size)])
        base[parent[lone]] = slot[lone] - code[lone]

        # 256 unused slots at the end take what leads beyond the last one, and below the first.
        size = int(max(starts[-1], slot.max() + 1)) + 257
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent[1:]]
        return slot

    def after(self, prefix: bytes) -> int:
        """The state after a prefix; -1 if no key has it."""
        state = 0
        for byte in prefix:
            onward = int(self.base[state]) + int(self.codes[byte])
            if self.check[onward] != state:
                return -1
            state = onward
        return state

    def accepted(self, state: int, text: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of positions in a text: those at which a key ends with a word, and the key's number; byte level by byte level.

        All positions begin in ``state``; the last byte of the text is a blank or break.
        """
        letters = self.codes[text]
        which = np.arange(starts.size)
        place, states = starts, np.full(starts.size, state, np.int32)
        while which.size:
            onward = self.base[states] + letters[place]
            lives = self.check[onward] == states
            which, place, states = which[lives], place[lives] + 1, onward[lives]
            ahead = text[place]
            ends = np.flatnonzero((ahead == _BLANK) | (ahead == _BREAK))
            keys = self.accepting[states[ends]]
            yield which[ends[keys >= 0]], keys[keys >= 0]
            inside = ahead != _BREAK
            which, place, states = which[inside], place[inside], states[inside]

    def found(self, levels: np.ndarray) -> np.ndarray:
        """Of the columns of bytes: the number of the key that each is, -1 for none. All advance together, row by row."""
        which, states = np.arange(levels.shape[1]), np.zeros(levels.shape[1], np.int32)
        for letters in self.codes[levels]:
            onward = self.base[states] + letters[which]
            lives = self.check[onward] == states
            which, states = which[lives], onward[lives]
        numbers = np.full(levels.shape[1], -1, np.int64)
        numbers[which] = self.accepting[states]
        return numbers


def tries(keys: pa.Array, slots: int = TRIE_SLOTS) -> Iterator[Trie]:
    """Tries of at most so many slots over all keys (binary); one key alone has as many as it has bytes."""
    trie = Trie(keys)
    if trie.base.size <= slots or len(keys) == 1:
        yield trie
    else:
        half = len(keys) // 2
        yield from tries(trie.keys[:half], slots)
        yield from tries(trie.keys[half:], slots)


def _blocks(rows: Iterable[pa.RecordBatch], size: int, further: int) -> Iterator[tuple[str, bytes, int]]:
    """Texts of a language, gathered or cut to about ``size`` bytes: (lang, text, bytes that are its own).

    What follows in a text that was cut, ``further`` words of it, is there to read on but belongs to the next block.
    """
    ahead = re.compile(rb"(?:[ \n]*[^ \n]+){0,%d}" % further)
    edge = re.compile(rb"[ \n]")
    gathered: dict[str, list[bytes]] = {}
    held = 0
    for batch in rows:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            plain = text.as_buffer().to_pybytes().translate(_PLAIN) if text.is_valid else b""
            begin = 0
            while len(plain) - begin > size and (cut := edge.search(plain, begin + size)):
                reach = ahead.match(plain, cut.start()).end()
                yield lang, plain[begin:reach] + b"\n", cut.start() - begin
                begin = cut.start()
            gathered.setdefault(lang, []).append(plain[begin:] if begin else plain)
            held += len(plain) - begin
            if held > size:
                for of, texts in gathered.items():
                    joined = b"\n".join(texts) + b"\n"
                    yield of, joined, len(joined)
                gathered, held = {}, 0
    for of, texts in gathered.items():
        joined = b"\n".join(texts) + b"\n"
        yield of, joined, len(joined)


def _spaced(text: bytes, own: int) -> tuple[bytes, int]:
    """The text with one blank between the words of a piece and one break between pieces, and how many words are its own."""
    own_words = len(text[:own].split()) if own < len(text) else -1
    for many, one in ((b"  ", b" "), (b" \n", b"\n"), (b"\n ", b"\n"), (b"\n\n", b"\n")):
        while many in text:
            text = text.replace(many, one)
    return text.lstrip(b" \n"), own_words


def _word_counter(block: int, kept: int):
    """What a task does with its texts first: count words. The empty word stands for all words of a language."""

    def passed_on(counted: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in counted.items():
            langs = pa.repeat(pa.scalar(lang, pa.string()), len(counts))
            found = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs, found, pa.array(counts.values(), pa.int64())], ["lang", "phrase", "n"])

    def count(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, Counter] = defaultdict(Counter)
        for lang, raw, own in _blocks(rows, block, 0):
            text, own_words = _spaced(raw, own)
            if text:
                found = text[:-1].replace(b"\n", b" ").split(b" ")
                found = found if own_words < 0 else found[:own_words]
                counted[lang].update(found)
                counted[lang][b""] += len(found)
            if sum(map(len, counted.values())) > kept:
                yield from passed_on(counted)
                counted.clear()
        yield from passed_on(counted)

    return count


def _prefix(lang: str) -> bytes:
    return lang.encode() + b"\n"


def _read(
    rows: Iterable[pa.RecordBatch], first: bool, block: int, further: int
) -> Iterator[tuple[str, bytes, int, np.ndarray | None]]:
    """Blocks with one blank or break between words, how many words are their own (-1: all), and their numbers after the first scan."""
    if first:
        for lang, raw, own in _blocks(rows, block, further):
            yield lang, *_spaced(raw, own), None
        return
    for batch in rows:
        for row in zip(*batch.columns):
            lang, text, own, numbers = (value.as_py() for value in row)
            yield lang, text, own, np.frombuffer(numbers, np.int32).copy()


def _scanner(sent: list, first: bool, last: bool, longest: int, width: int, parts: dict[str, int], block: int, held: int):
    """What a task does with its texts then: number the words that tries know, (number of the first key, trie) each.

    After the last scan it deals out the phrases of up to ``longest`` words with a number each, else the texts to go on with.
    """

    def scan(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(number, trie.value) for number, trie in sent]
        runs: dict[str, list[tuple[np.ndarray, int]]] = defaultdict(list)
        words = 0
        for lang, text, own, numbers in _read(rows, first, block, longest - 1):
            letters = np.frombuffer(text, np.uint8)
            ends = np.flatnonzero((letters == _BLANK) | (letters == _BREAK))
            if not ends.size:
                continue
            starts = np.concatenate([[0], ends[:-1] + 1])
            numbers = np.zeros(ends.size, np.int32) if numbers is None else numbers
            for number, trie in known:
                if (state := trie.after(_prefix(lang))) >= 0:
                    left = np.flatnonzero(numbers == 0)
                    for which, keys in trie.accepted(state, letters, starts[left]):
                        numbers[left[which]] = number + keys
            if not last:
                yield pa.RecordBatch.from_pylist([{"lang": lang, "text": text, "own": own, "numbers": numbers.tobytes()}], _schema(_READ))
                continue
            runs[lang].append(_run(numbers, letters[ends] == _BREAK, own))
            words += ends.size
            if words > held:
                for of, gathered in runs.items():
                    yield from _dealt(of, gathered, longest, width, parts.get(of, 1))
                runs.clear()
                words = 0
        for of, gathered in runs.items():
            yield from _dealt(of, gathered, longest, width, parts.get(of, 1))

    return scan


def _schema(fields: str) -> pa.Schema:
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in fields.split(", "))])


def _run(numbers: np.ndarray, breaks: np.ndarray, own: int) -> tuple[np.ndarray, int]:
    """Numbers of words with a 0 at breaks, where phrases end as at words without a number, and how many of them are its own."""
    place = np.arange(numbers.size) + np.cumsum(breaks) - breaks
    run = np.zeros(numbers.size + int(breaks.sum()), np.int32)
    run[place] = numbers
    return run, run.size if own < 0 or own >= place.size else int(place[own])


def _dealt(lang: str, runs: list[tuple[np.ndarray, int]], longest: int, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The distinct phrases of the runs and how often they are there, grown word by word and dealt by their hash to parts."""
    numbers = np.concatenate([run for run, _ in runs] + [np.zeros(longest, np.int32)])
    own = np.concatenate([np.arange(run.size) < n for run, n in runs])
    at = np.flatnonzero((numbers[: own.size] > 0) & own)
    state = numbers[at].astype(np.int64)
    for size in range(1, longest + 1):
        if size > 1:
            ahead = numbers[at + size - 1]
            at, state = at[ahead > 0], (state[ahead > 0] << 32) | ahead[ahead > 0]
        if not at.size:
            break
        order = np.argsort(state)
        ordered = state[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        firsts = np.flatnonzero(new)
        counts = np.diff(firsts, append=at.size)
        state[order] = np.cumsum(new) - 1
        distinct = at[order[firsts]]
        levels = np.concatenate([_levels(numbers[distinct + k], width) for k in range(size)])
        part = (_mixed(levels) % np.uint64(parts)).astype(np.min_scalar_type(parts))
        order = np.argsort(part, kind="stable")
        levels, counts, part = levels[:, order], counts[order], part[order]
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        slices = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        most = np.maximum.reduceat(counts, edges[:-1])
        yield pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(lang, pa.string()), len(slices)), pa.repeat(pa.scalar(size, pa.int32()), len(slices)),
            pa.array(part[edges[:-1]].astype(np.int32)), pa.array([levels[:, a:b].tobytes() for a, b in slices], pa.binary()),
            pa.array([counts[a:b].astype(np.min_scalar_type(top)).tobytes() for (a, b), top in zip(slices, most)], pa.binary()),
        ], _schema(_DEALT).names)


def _levels(numbers: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of the numbers, a row for each, highest first."""
    return np.ascontiguousarray(numbers.astype(">u4").view(np.uint8).reshape(-1, 4).T[4 - width:])


def _mixed(levels: np.ndarray) -> np.ndarray:
    """A hash of each column of bytes."""
    mixed = np.full(levels.shape[1], 0xCBF29CE484222325, np.uint64)
    for letters in levels:
        mixed ^= letters
        mixed *= np.uint64(0x100000001B3)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _adder(width: int, parts: dict[str, int], min_count: int, slots: int):
    """What a part does with the phrases of a language and length dealt to it: count those that are frequent by tries."""

    def add(dealt: pa.Table) -> pa.Table:
        lang, size = dealt.column("lang")[0], dealt.column("size")[0]
        rows = size.as_py() * width
        phrases, counts = dealt.column("phrases").to_pylist(), dealt.column("counts").to_pylist()
        counts = np.concatenate([np.frombuffer(c, f"u{len(c) * rows // len(p)}").astype(np.int64) for p, c in zip(phrases, counts)])
        levels = np.concatenate([np.frombuffer(p, np.uint8).reshape(rows, -1) for p in phrases], axis=1)
        # Other digits of the hash than those that dealt the phrases.
        bins = 1 << int(2 * counts.size).bit_length()
        bin_of = (_mixed(levels) // np.uint64(parts.get(lang.as_py(), 1)) % np.uint64(bins)).astype(np.int64)
        lives = np.bincount(bin_of, counts, bins)[bin_of] >= min_count
        levels, counts = levels[:, lives], counts[lives]
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows), counts.size, [None, pa.py_buffer(levels.T.tobytes())])
        found, sums = [pa.array([], pa.binary())], [np.zeros(0, np.int64)]
        for trie in tries(keys.unique().cast(pa.binary()), slots) if counts.size else ():
            number = trie.found(levels)
            known = number >= 0
            n = np.bincount(number[known], counts[known], len(trie.keys)).astype(np.int64)
            found.append(trie.keys.take(pa.array(np.flatnonzero(n >= min_count))))
            sums.append(n[n >= min_count])
        found, sums = pa.concat_arrays(found), np.concatenate(sums)
        return pa.table([pa.repeat(lang, len(found)), pa.repeat(size, len(found)), found, pa.array(sums)], _schema(_FOUND))

    return add


def _placed(candidates: DataFrame, total: int) -> tuple[DataFrame, list[tuple[int, int, int, int]]]:
    """Words (lang, phrase, key, part, row), parts and rows in order of keys; of each part: (part, number of words, bytes, number of
    the first), which is 1 for the first of all."""
    key = F.concat("lang", F.lit("\n"), "phrase").cast("binary")
    dealt = candidates.select("lang", "phrase", key.alias("key")).repartitionByRange(max(1, -(-total // TRIE_BYTES)), "key")
    placed = dealt.sortWithinPartitions("key").select("*", F.monotonically_increasing_id().alias("row"))
    placed = stored(placed.withColumns({"part": F.shiftright("row", 33), "row": F.col("row").bitwiseAND((1 << 33) - 1)}), "phrases-words")
    sizes, first = [], 1
    for part, n, size in placed.groupBy("part").agg(F.count(F.lit(1)), F.sum(F.octet_length("key"))).sort("part").collect():
        sizes.append((part, n, size, first))
        first += n
    return placed, sizes


def _numbered(placed: DataFrame, sizes: list[tuple[int, int, int, int]]) -> DataFrame:
    """Words with their numbers (number, phrase)."""
    starts = pa.table({"part": pa.array([s[0] for s in sizes], pa.int64()), "start": pa.array([s[3] for s in sizes], pa.int64())})
    starts = F.broadcast(placed.sparkSession.createDataFrame(starts))
    return placed.join(starts, "part").select((F.col("row") + F.col("start")).alias("number"), "phrase")


def _tries_of(placed: DataFrame, sizes: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, Trie]]:
    """Tries over all words, each from a bounded part of them, with the number of their first word."""
    while sizes:
        n, held = 1, sizes[0][2]
        while n < len(sizes) and held + sizes[n][2] <= TRIE_BYTES:
            held += sizes[n][2]
            n += 1
        first = sizes[0][3]
        keys = placed.where(F.col("part").between(sizes[0][0], sizes[n - 1][0])).select("key").toArrow().column("key").combine_chunks()
        for trie in tries(keys, TRIE_SLOTS):
            yield first, trie
            first += len(trie.keys)
        sizes = sizes[n:]


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT
) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Phrases of up to ``longest`` words and how often they occur (lang, size, phrase, n), where a phrase is the numbers of its
    words; words (number, phrase), all words by language (lang, n), and the bytes that a number has in a phrase."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_word_counter(BLOCK, _KEPT), _WORDS)
    counted = stored(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "phrases-counted")
    totals, candidates = counted.where("phrase = ''").select("lang", "n"), counted.where("phrase != ''")
    parts = {lang: -(-n // _PART) for lang, n in totals.where(F.col("n") > _PART).collect()}
    total = candidates.agg(F.sum(F.octet_length("lang") + 1 + F.octet_length("phrase"))).head()[0] or 0
    placed, sizes = _placed(candidates, total)
    n_words = sum(n for _, n, _, _ in sizes)
    width = max(1, -(-n_words.bit_length() // 8))

    scans, slots = [[]], 0
    for first, trie in _tries_of(placed, sizes):
        if scans[-1] and slots + trie.base.size > SCAN_SLOTS:
            scans.append([])
            slots = 0
        scans[-1].append((first, spark.sparkContext.broadcast(trie)))
        slots += trie.base.size
    for k, sent in enumerate(scans, 1):
        last = k == len(scans)
        texts = texts.mapInArrow(_scanner(sent, k == 1, last, longest, width, parts, BLOCK, _HELD), _DEALT if last else _READ)
        if last:
            texts = texts.groupBy("lang", "size", "part").applyInArrow(_adder(width, parts, min_count, TRIE_SLOTS), _FOUND)
        texts = stored(texts, f"phrases-scan-{k}")
        for _, trie in sent:
            trie.unpersist()
    return texts, _numbered(placed, sizes), totals, width


def _part(phrase: str, width: int, start: Column, length: Column) -> Column:
    """So many words from one on, counted from 0, of a phrase of numbers."""
    return F.substring(F.col(phrase), start * width + 1, length * width)


def _scored(candidates: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """Candidates (lang, phrase, size, a) with l, r and score of their lowest cut."""
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "*", _part("phrase", width, F.lit(0), F.col("k")).alias("first"),
        _part("phrase", width, F.col("k"), F.col("size") - F.col("k")).alias("rest"),
    )
    firsts = counts.select(F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = counts.select(F.col("phrase").alias("rest"), F.col("n").alias("r"))
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in "alr")
    cut = cut.join(firsts, "first").join(rests, "rest")
    cut = cut.withColumns({"_above": (a * a).cast("decimal(31,0)") * F.lit(1_000_000), "_below": l * r})
    # No part is rarer than the phrase, so scores are at most a million.
    cut = cut.withColumn("score", F.expr("_above div _below").cast("long"))
    return cut.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low")).select(
        "lang", "phrase", "size", "a", "low.l", "low.r", "low.score"
    )


def _outside(candidates: DataFrame, longest: int, inside: int, width: int) -> DataFrame:
    """Candidates that no longer one with ``inside`` hundredths of their occurrences holds."""
    if longest < 3:
        return candidates
    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    held = (
        candidates.where("size > 2").withColumn("part", F.explode(sizes))
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("part"))))
        .groupBy(_part("phrase", width, F.col("place"), F.col("part")).alias("phrase"))
        .agg(F.max("a").alias("_longer"))
    )
    return candidates.join(held, "phrase", "left").where(
        F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * inside)
    ).drop("_longer")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each language with all that share the last place, as ties are broken by the letters.

    A language is first cut into ``_CUTS`` parts by hash, so no task sorts more than such a part or the best of all parts.
    """
    cut = scored.withColumn("_cut", F.pmod(F.xxhash64("phrase"), F.lit(_CUTS)))
    for by in (["lang", "_cut"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
        cut = cut.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= top).drop("_rank")
    return cut.drop("_cut")


def _spelled(phrases: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """Phrases with their words in place of numbers."""
    place = F.explode(F.sequence(F.lit(0), F.col("size") - 1))
    places = phrases.select("phrase", "size", place.alias("place"))
    number = F.conv(F.hex(_part("phrase", width, F.col("place"), F.lit(1))), 16, 10).cast("long")
    spelled = (
        places.select("phrase", "place", number.alias("number"))
        .join(words.withColumnRenamed("phrase", "word"), "number")
        .groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    )
    spelled = spelled.select("phrase", F.array_join("words.word", " ").alias("spelled"))
    return phrases.join(spelled, "phrase").drop("phrase").withColumnRenamed("spelled", "phrase")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, words, totals, width = frequent_phrases(docs, longest, min_count)
    candidates = counts.where("size > 1").withColumnRenamed("n", "a")
    scored = _outside(_scored(candidates, counts, width), longest, inside, width)
    shared = stored(_best(scored, top), "collocations")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = _spelled(shared, words, width).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
