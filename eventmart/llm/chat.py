r"""Chat formatting whose result is parsed again and must give back what went in.

Grammar of a rendered conversation, a sequence of turns:

    user       <s>[INST] TEXT [/INST]
    assistant   TEXT </s>                           (it begins with a space)
    any other  <s>[ROLE] TEXT [/ROLE] TEXT </s>

TEXT holds no control string (<s> </s> [INST] [/INST] [ROLE] [/ROLE]). A control string with one or more backslashes after
its bracket is an escaped one; the parser takes one backslash away. A turn is rendered as it is, parsed, and compared; if
it does not come back, its control strings get a backslash, those that have some one more, until it does. A turn begins
only where the one before has ended, so that a conversation parses to the turns of its parts.

Turns are rendered and parsed where they lie. What needs a conversation's order (its digests) is read back from the
rendered turns, sorted by conversation and turn, as a stream that keeps running digests but no texts: a conversation of any
length takes little memory, though its digest, one number over all of its text, is computed by one task.

Null texts and roles are empty. Rows of the same turn are ordered by role, then text. A null conv_id is a conversation.
Repeated rows are turns each. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CONTROL = re.compile(r"</?s>|\[/?(?:INST|ROLE)\]")
_ESCAPE = re.compile(r"<(?=\\*/?s>)|\[(?=\\*/?(?:INST|ROLE)\])")
_ESCAPED = re.compile(r"(<)\\(?=\\*/?s>)|(\[)\\(?=\\*/?(?:INST|ROLE)\])")


class NotParsable(ValueError):
    """The text is no sequence of turns."""


def escape(text: str) -> str:
    """One backslash into every control string, escaped ones too."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """The reverse."""
    return _ESCAPED.sub(lambda m: m[1] or m[2], text)


def template(role: str, text: str) -> str:
    """A turn with its marks."""
    if role == "user":
        return f"<s>[INST] {text} [/INST]"
    if role == "assistant":
        return f" {text} </s>"
    return f"<s>[ROLE] {role} [/ROLE] {text} </s>"


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns of a rendered conversation: role, text, and the span of the text as it stands there."""
    turns, at = [], 0

    def text_until(mark: str) -> tuple[int, int]:
        nonlocal at
        found = _CONTROL.search(rendered, at)
        if not found or found[0] != mark or found.start() <= at or rendered[found.start() - 1] != " ":
            raise NotParsable(f"no {mark} at {at}")
        span, at = (at, found.start() - 1), found.end()
        return span

    while at < len(rendered):
        if rendered.startswith("<s>[INST] ", at):
            role, at = "user", at + 10
            span = text_until("[/INST]")
        elif rendered.startswith("<s>[ROLE] ", at):
            at += 10
            begin, end = text_until("[/ROLE]")
            role = unescape(rendered[begin:end])
            if not rendered.startswith(" ", at):
                raise NotParsable(f"no text at {at}")
            at += 1
            span = text_until("</s>")
        elif rendered.startswith(" ", at):
            role, at = "assistant", at + 1
            span = text_until("</s>")
        else:
            raise NotParsable(f"no turn at {at}")
        turns.append((role, unescape(rendered[span[0] : span[1]]), *span))
    return turns


def render(role: str, text: str) -> str:
    """A turn that parses to exactly this role and text."""
    as_role, as_text = role, text
    for _ in range(3):
        rendered = template(as_role, as_text)
        try:
            if [turn[:2] for turn in parse(rendered)] == [(role, text)]:
                return rendered
        except NotParsable:
            pass
        as_role, as_text = (role if role in ("user", "assistant") else escape(as_role)), escape(as_text)
    raise NotParsable(f"a turn of {role!r} does not come back")


def render_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, role, text (null: empty), rendered, and the span of its text if it is trained on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [render(r, t) for r, t in zip(batch["role"], batch["text"], strict=True)]
            spans = [parse(m)[0] for m in made]
            batch["rendered"] = made
            for name, i in (("loss_start", 2), ("loss_end", 3)):
                batch[name] = pd.array([s[i] if s[0] == "assistant" else None for s in spans], dtype="Int64")
            yield batch

    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    nullable = "conv_id long, turn long, role string, text string, rendered string, loss_start long, loss_end long"
    return turns.mapInPandas(run, nullable)


def conversation_texts(turns: DataFrame) -> DataFrame:
    """Whole rendered conversations, one row each: for conversations that fit into a row."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    return turns.groupBy("conv_id").agg(F.concat_ws("", F.transform(ordered, lambda t: t["rendered"])).alias("rendered"))


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self, conv_id) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from its rendered turns: digests of its turns and of what is trained on."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _DIGEST.split(", ")]
        missing = object()
        current, digest = missing, _Digest()
        for batch in batches:
            rows = []
            for conv_id, rendered in zip(batch["conv_id"], batch["rendered"], strict=True):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if conv_id != current:
                    if current is not missing:
                        rows.append(digest.row(current))
                    current, digest = conv_id, _Digest()
                digest.add(rendered)
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
        if current is not missing:
            yield pd.DataFrame([digest.row(current)], columns=names).astype({"conv_id": "Int64"})

    return ordered.select("conv_id", "rendered").mapInPandas(run, _DIGEST)
