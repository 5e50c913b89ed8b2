"""Personal data: e-mail addresses, IP addresses, payment cards and phone numbers.

Fixed patterns find the base spans. A linear-chain conditional random field over word shapes adds spans that the patterns
miss, such as phone numbers without a country code: it is trained by gradient on a small labelled table (lines written
here with their labels, and at most ``sample`` lines of the documents labelled by the base patterns) and decoded by
Viterbi in numpy batches. A token of letters alone is no personal data, so a line falls into runs of other tokens, which
are decoded apart from each other, with the words around them as features; a run without digit or @ holds none. What the
field adds must be plausible for its kind and must not touch a base span.

Texts are read where they lie, without a shuffle, in time linear in their length. Null texts are empty. Repeated rows get a
row each. Empty tables give empty results; without documents to label, the field learns from the written lines.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import fresh

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 1500  # lines of documents in the labelled table, at most

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]")

#: Labelled lines: personal data stands between a kind's sign and the closing sign.
_SIGNS = {"email": "⟦e:", "ip": "⟦i:", "card": "⟦c:", "phone": "⟦p:"}
_LABELLED = """
Call ⟦p:(212) 555-0147⟧ or ⟦p:415-555-0132⟧ before noon.
My number is ⟦p:555-867-5309⟧, ask for Sam.
Phone: ⟦p:(020) 7946 0958⟧ fax: ⟦p:(020) 7946 0999⟧
Tel. ⟦p:030 12345678⟧ oder mobil ⟦p:0171 2345678⟧
Téléphone ⟦p:01 42 68 53 00⟧ le matin
Llame al ⟦p:912-345-678⟧ por la tarde
Reach me at ⟦p:+44 20 7946 0018⟧ tomorrow
Contact ⟦e:ann.lee@example.org⟧ with questions.
Write to ⟦e:sales-team@mail.example.com⟧, please.
Host ⟦i:10.0.12.7⟧ is down, use ⟦i:192.168.4.20⟧ instead.
Card ⟦c:4111 1111 1111 1111⟧ was charged.
Pay with ⟦c:5500-0000-0000-0004⟧ today
Version 3.11.4 was released on 2021-10-04.
This work is licensed under version 2.0 of the terms.
The table has 120 rows, 14 columns and 3 keys.
In 1998 and 2004 the prices rose by 3.5 and 12.75 percent.
token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0" is secret
password=41aa0bc92d77fe10c2 must not be shared
Order 20210304-17 holds 250 items at 19.99 each.
See pages 100-120 and section 4.2.1 of volume 12.
The ratio was 16:9 at 1920x1080 and 60 frames.
Serial 4408041234567893210445 was printed on the box.
""".strip().splitlines()


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _is_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in text.split(".")))


def _emails(text: str) -> Iterator[Span]:
    """Each @ looks back over the local part, no further than the match before, and ahead over the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", domain.end() if domain else at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    found: list[Span] = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
        found += [
            ("card", *m.span()) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)
        ]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


# --- the field -----------------------------------------------------------------------------------

_TOKEN = re.compile(r"[\w.%+@-]+|[^\w\s]")
_STATES = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
_FEATURES = 2048
_STEPS = 16  # a training run is cut after so many tokens


def _shape(token: str) -> str:
    """Digits as their number, letters as x or X once a run, other characters as they are."""
    shape = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", token[:80])
    return re.sub(r"(?<![a-z])[A-Z]+", "X", re.sub(r"(?<!d)[^\W\d_A-Zd]+", "x", shape))


def _features(tokens: list[re.Match], i: int, first: int, last: int) -> list[int]:
    token = tokens[i][0]

    def near(k: int) -> str:
        if not 0 <= k < len(tokens):
            return "none"
        other = tokens[k][0]
        return other.lower()[:12] if other.isalpha() else _shape(other)

    def gap(k: int) -> str:
        return "-" if not 0 < k < len(tokens) else str(min(tokens[k].start() - tokens[k - 1].end(), 2))

    n = len(_digits(token))
    shape = _shape(token)
    named = [
        "one", f"s:{shape}", f"n:{min(n, 24)}", f"l:{min(len(token) // 2, 16)}", f"p:{near(i - 1)}", f"q:{near(i + 1)}",
        f"ps:{near(i - 1)}|{shape}", f"sq:{shape}|{near(i + 1)}", f"g:{gap(i)}{gap(i + 1)}", f"pp:{near(i - 2)}",
        f"@:{token.count('@')}|{min(token.count('.'), 5)}", f"a:{any(map(str.isalpha, token))}|{n > 0}",
        f"f:{i == first}|{i == last}",
    ]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % _FEATURES for f in named]


def _runs(line: str) -> Iterator[tuple[list[re.Match], list[int]]]:
    """Runs of a line's tokens that may hold personal data."""
    tokens = list(_TOKEN.finditer(line))
    run: list[int] = []
    for i in range(len(tokens) + 1):
        if i < len(tokens) and not tokens[i][0].isalpha():
            run.append(i)
            continue
        if any(_HINT.search(tokens[k][0]) for k in run):
            yield tokens, run
        run = []


def _label(tokens: list[re.Match], run: list[int], spans: list[Span]) -> list[int]:
    states, before = [], None
    for i in run:
        begin, end = tokens[i].span()
        inside = next((s for s in spans if s[1] < end and begin < s[2]), None)
        states.append(0 if inside is None else _STATES.index(f"{'I' if inside == before else 'B'}-{inside[0]}"))
        before = inside
    return states


def written_lines() -> list[tuple[str, list[Span]]]:
    """The labelled lines above: text and spans."""
    out = []
    for line in _LABELLED:
        text, spans, at = "", [], 0
        for m in re.finditer("(" + "|".join(map(re.escape, _SIGNS.values())) + ")(.*?)⟧", line):
            text += line[at : m.start()]
            kind = next(k for k, sign in _SIGNS.items() if sign == m[1])
            spans.append((kind, len(text), len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        out.append((text + line[at:], spans))
    return out


class Field:
    """A linear-chain conditional random field: scores of features per state, and of state after state."""

    def __init__(self):
        k = len(_STATES)
        self.weights = np.zeros((_FEATURES, k))
        self.steps = np.zeros((k, k))
        self.allowed = np.zeros((k, k))
        for j, state in enumerate(_STATES):  # I follows B or I of its kind only
            if state[0] == "I":
                self.allowed[:, j] = -1e9
                self.allowed[[j - 1, j], j] = 0
        self.first = np.array([-1e9 if s[0] == "I" else 0.0 for s in _STATES])

    def emissions(self, runs: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each run's tokens, padded, and the runs' lengths."""
        length = np.array([len(r) for r in runs])
        out = np.zeros((len(runs), length.max(), len(_STATES)))
        flat = self.weights[np.array([f for r in runs for f in r])].sum(axis=1)
        out[np.arange(length.max()) < length[:, None]] = flat
        return out, length

    def decode(self, runs: list[list[list[int]]]) -> list[np.ndarray]:
        """The likeliest states of each run, by Viterbi; runs of like length share a batch."""
        order = sorted(range(len(runs)), key=lambda r: len(runs[r]))
        found: list = [None] * len(runs)
        at = 0
        while at < len(order):
            size = max(1, min(1024, 100_000 // len(runs[order[at]])))
            batch = [r for r in order[at : at + size] if len(runs[r]) <= 2 * len(runs[order[at]])]
            at += len(batch)
            scores, length = self.emissions([runs[r] for r in batch])
            step = self.steps + self.allowed
            best, back = scores[:, 0] + self.first, np.zeros(scores.shape, np.int8)
            back[:, 0] = np.arange(len(_STATES))
            for t in range(1, scores.shape[1]):
                ways = best[:, :, None] + step
                go = t < length
                back[:, t] = np.where(go[:, None], ways.argmax(axis=1), np.arange(len(_STATES)))
                best = np.where(go[:, None], ways.max(axis=1) + scores[:, t], best)
            states = np.zeros(scores.shape[:2], np.int64)
            states[:, -1] = best.argmax(axis=1)
            for t in range(scores.shape[1] - 1, 0, -1):
                states[:, t - 1] = back[np.arange(len(batch)), t, states[:, t]]
            for k, r in enumerate(batch):
                found[r] = states[k, : length[k]]
        return found

    def train(self, runs: list[list[list[int]]], labels: list[list[int]], rounds: int = 100, decay: float = 1e-3) -> None:
        """Maximise the labels' likelihood by Adam over all runs at once."""
        runs, labels = [r[:_STEPS] for r in runs], [y[:_STEPS] for y in labels]
        length = np.array([len(r) for r in runs])
        n, T, k = len(runs), length.max(), len(_STATES)
        real = np.arange(T) < length[:, None]
        x = np.zeros((real.sum(), _FEATURES), np.float32)
        for row, features in zip(x, (f for r in runs for f in r), strict=True):
            np.add.at(row, features, 1)
        y = np.zeros((n, T), np.int64)
        y[real] = [s for label in labels for s in label]
        gold = np.eye(k)[y] * real[:, :, None]
        gold_steps = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.weights, self.steps)]

        def lse(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

        for i in range(1, rounds + 1):
            e = np.zeros((n, T, k))
            e[real] = x @ self.weights.astype(np.float32)
            step = self.steps + self.allowed
            ahead, behind = np.zeros((n, T, k)), np.zeros((n, T, k))
            ahead[:, 0] = e[:, 0] + self.first
            for t in range(1, T):
                new = lse(ahead[:, t - 1, :, None] + step, 1) + e[:, t]
                ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
            for t in range(T - 2, -1, -1):
                new = lse(step + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where(real[:, t + 1, None], new, 0)
            z = lse(ahead[:, -1], 1)[:, None, None]
            expected = np.exp(ahead + behind - z) * real[:, :, None]
            both = ahead[:, :-1, :, None] + step + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - z[..., None]
            pairs = (np.exp(np.minimum(both, 0)) * real[:, 1:, None, None]).sum(axis=(0, 1))
            slopes = (x.T @ (gold - expected)[real].astype(np.float32) / n - decay * self.weights, (gold_steps - pairs) / n - decay * self.steps)
            for p, g, m in zip((self.weights, self.steps), slopes, moments, strict=True):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                p += 0.1 * (m[0] / (1 - 0.9**i)) / (np.sqrt(m[1] / (1 - 0.99**i)) + 1e-8)


def _plausible(kind: str, text: str) -> bool:
    n = len(_digits(text))
    if kind == "email":
        return "@" in text and "." in text.rpartition("@")[2].strip(".")
    if kind == "ip":
        return len(text.split(".")) == 4 and all(p.isdecimal() for p in text.split(".")) and _is_ip(text)
    if kind == "card":
        return 13 <= n <= 19 and luhn(_digits(text))
    return 7 <= n <= 15 and not any(map(str.isalpha, text))


def added_spans(field: Field, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """What the field finds beyond the base spans, per text."""
    places, runs = [], []
    for which, text in enumerate(texts):
        if not _HINT.search(text):
            continue
        at = 0
        for line in text.split("\n"):
            if _HINT.search(line):
                for tokens, run in _runs(line):
                    places.append((which, at, [tokens[i].span() for i in run]))
                    runs.append([_features(tokens, i, run[0], run[-1]) for i in run])
            at += len(line) + 1
    added: list[list[Span]] = [[] for _ in texts]
    for (which, at, spans), states in zip(places, field.decode(runs), strict=True):
        i = 0
        while i < len(states):
            begin, i = i, i + 1
            if _STATES[states[begin]][0] != "B":
                continue
            while i < len(states) and _STATES[states[i]] == "I" + _STATES[states[begin]][1:]:
                i += 1
            kind, start, end = _STATES[states[begin]][2:], at + spans[begin][0], at + spans[i - 1][1]
            found = texts[which][start:end].rstrip(".,")
            if _plausible(kind, found) and not _touches(base[which], start, start + len(found)):
                added[which].append((kind, start, start + len(found)))
    return added


def _touches(spans: list[Span], start: int, end: int) -> bool:
    """Whether a span overlaps one of ``spans``, which are ordered by start and overlap little."""
    k = bisect_left(spans, end, key=lambda s: s[1])
    return any(s[2] > start for s in spans[max(0, k - 8) : k])


# --- on Spark ------------------------------------------------------------------------------------


def learn(documents: DataFrame, sample: int = SAMPLE) -> Field:
    """A field trained on the written lines and on lines of the documents that hold a digit or @."""
    lines = (
        documents.select(F.explode(F.split("text", "\n")).alias("line"))
        .where(F.col("line").rlike("[0-9@]") & (F.length("line") < 4000))
        .distinct()
        .orderBy(F.xxhash64("line"), "line").limit(sample)
    )
    table = written_lines() * 5 + [(r["line"], base_spans(r["line"])) for r in lines.collect()]
    runs, labels = [], []
    for line, spans in table:
        for tokens, run in _runs(line):
            runs.append([_features(tokens, i, run[0], run[-1]) for i in run])
            labels.append(_label(tokens, run, spans))
    field = Field()
    field.train(runs, labels)
    return field


def find(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with ``base_spans`` and ``spans`` (base and added), arrays of (kind, start, end) in code points."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    found = fresh(documents, "found")[0]
    span = "array<struct<kind: string, start: int, end: int>>"

    @F.pandas_udf(f"struct<base: {span}, spans: {span}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in texts]
        base = [base_spans(t) for t in texts]
        added = added_spans(shared.value, texts, base)
        every = [sorted(b + a, key=_order) for b, a in zip(base, added, strict=True)]
        as_rows = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]
        return pd.DataFrame({"base": list(map(as_rows, base)), "spans": list(map(as_rows, every))})

    return (
        documents.withColumn(found, run("text"))
        .withColumn("base_spans", F.col(found)["base"])
        .withColumn("spans", F.col(found)["spans"])
        .drop(found)
    )


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=_order):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def report(documents: DataFrame, field: Field) -> DataFrame:
    """Per document: doc_id, base spans by kind and as a digest, and all spans."""

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find(documents, field).select(
        "doc_id", *map(count, KINDS), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
