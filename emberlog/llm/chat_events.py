"""Chat formatting from an event log.

A log row is one event of a message: ``start`` (role and first text), ``delta`` (text to append),
``edit`` (text that replaces all before) or ``regenerate`` (forget the text so far; deltas follow).
Logs are partitioned by conversation and message, sorted by sequence, folded into final messages, and
rendered with a template whose control strings cannot occur inside texts.

The rendered output is a table of segments, one per message: conv_id, place (order in the
conversation), segment, and loss_from / loss_to, the half-open range of code points of the segment
that a model is trained on (the text of assistant messages). A conversation's formatted text is its
segments in order. One conversation may hold a third of all messages, so no step needs a whole
conversation in memory: folding groups single messages, and reading back streams over sorted rows
with a running hash.

Escaping: a backslash becomes two; a backslash is put after the first character of every control
string. Unescaping drops a backslash and keeps the character behind it. A role is escaped the same
way, and a line feed in it also gets a backslash before it.

Defined cases: null texts and roles are empty; null conv_ids are one conversation; events with equal
sequence numbers are applied in the order of kind, then text; events of an unknown kind are refused;
a message without ``start`` has an empty role; an empty log gives an empty result; extra columns are
not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

# control strings of this template and of the common instruction templates
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = [OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
KINDS = ("start", "delta", "edit", "regenerate")
LEARNED_ROLE = "assistant"
_CONTROL = "|".join(re.escape(c[0]) + "(?=" + re.escape(c[1:]) + ")" for c in CONTROLS)


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_CONTROL})", "$1\\\\")


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def fold(events: DataFrame) -> DataFrame:
    """Final messages of a log (conv_id, message, seq, kind, role, text): conv_id, message, place, role, text.

    ``message`` names a message inside its conversation; ``seq`` may be of any type that sorts. ``place``
    is the message's smallest seq. Events of one message meet in one group, never those of a conversation.
    """
    known = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(F.col("kind"), F.lit("null"))))
    )
    rows = events.select(
        "conv_id", "message", F.struct("seq", known.alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e")
    )
    grouped = rows.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("e")).alias("log"))

    def step(text: Column, e: Column) -> Column:
        return F.when(e["kind"] == "regenerate", F.lit("")).when(e["kind"] == "delta", F.concat(text, e["text"])).otherwise(e["text"])

    role = F.get(F.filter("log", lambda e: e["kind"] == "start"), F.lit(0))["role"]
    return grouped.select(
        "conv_id", "message", F.get("log", F.lit(0))["seq"].alias("place"), F.coalesce(role, F.lit("")).alias("role"),
        F.aggregate("log", F.lit(""), step).alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """Segments of messages (conv_id, message, place, role, text)."""
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    body = escaped(F.col("text"))
    learned = F.col("role") == LEARNED_ROLE
    return messages.select("conv_id", "message", "place", head.alias("head"), body.alias("body"), learned.alias("learned")).select(
        "conv_id", "message", "place", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("segment"),
        F.length("head").cast("bigint").alias("loss_from"),
        F.when(F.col("learned"), F.length("head") + F.length("body")).otherwise(F.length("head")).cast("bigint").alias("loss_to"),
    )


def formatted(events: DataFrame) -> DataFrame:
    """The stored segment table of a log."""
    return stored(render(fold(events)), "chat-segments")


_HEAD = re.compile(re.escape(OPEN) + r"((?:[^\\\n]|\\.)*)\n", re.S)
_END = CLOSE + "\n"


def parsed(segment: str) -> tuple[str, int]:
    """Role of a segment and where its escaped text starts; it ends before the closing mark."""
    head = _HEAD.match(segment)
    if head is None or not segment.endswith(_END):
        raise ValueError("not a segment of this template")
    return unescape(head[1]), head.end()


class _Conversation:
    """Running hashes and counts of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.chars, self.total = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, end: int) -> None:
        role, begin = parsed(segment)
        stop = len(segment) - len(_END)
        text = unescape(segment[begin:stop])
        loss = text if (start, end) == (begin, stop) else unescape(segment[start:end])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.n, self.chars, self.total = self.n + 1, self.chars + len(loss), self.total + len(segment)

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.chars, self.loss.hexdigest(), self.total


def _digest_rows(done: list[_Conversation]) -> pd.DataFrame:
    frame = pd.DataFrame([c.row() for c in done], columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return frame.assign(conv_id=pd.array([c.conv_id for c in done], dtype="Int64"))


def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from segments sorted by conversation; of the open one only the running hashes are kept."""
    now: _Conversation | None = None
    for batch in batches:
        done = []
        convs = [None if pd.isna(c) else int(c) for c in batch["conv_id"]]
        for conv, segment, start, end in zip(convs, batch["segment"], batch["loss_from"].tolist(), batch["loss_to"].tolist(), strict=True):
            if now is None or conv != now.conv_id:
                if now is not None:
                    done.append(now)
                now = _Conversation(conv)
            now.add(segment, start, end)
        if done:
            yield _digest_rows(done)
    if now is not None:
        yield _digest_rows([now])


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(segments: DataFrame) -> DataFrame:
    """Roles, texts and loss text parsed from the segments again, as one digest row per conversation."""
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "place", "message").select(
        "conv_id", "segment", "loss_from", "loss_to"
    ).mapInPandas(digests, DIGESTS)


def log_of(conversations: DataFrame) -> DataFrame:
    """An event log for finished conversations (conv_id, turn, role, text), as a chat service would keep it.

    Every message starts with its first third and gets the rest as two deltas. Before that, an assistant
    message was answered once in reverse and regenerated, and a user message was typed without its end
    and edited. Rows equal in all columns are separate messages, numbered by ``copy``.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select(
        "conv_id", "turn", "role", "text", F.struct("turn", F.md5(F.concat_ws("\n", "role", "text").cast("binary")).alias("digest"), "copy").alias("message"),
        F.floor(F.length("text") / 3).cast("int").alias("third"),
    )

    def event(kind: str, text: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.expr(text).alias("text"))

    first, second, third = "substring(text, 1, third)", "substring(text, third + 1, third)", "substring(text, 2 * third + 1)"
    drafts = F.array(event("start", "''"), event("delta", "reverse(text)"), event("regenerate", "cast(null as string)"), event("delta", first))
    typed = F.array(event("start", first), event("edit", second), event("edit", first))
    plain = F.array(event("start", first))
    begin = F.when(F.col("role") == "assistant", drafts).when(F.col("role") == "user", typed).otherwise(plain)
    events = F.concat(begin, F.array(event("delta", second), event("delta", third)))
    return rows.select("conv_id", "message", "role", F.posexplode(events).alias("step", "event")).select(
        "conv_id", "message", F.struct("message", "step").alias("seq"), F.col("event.kind").alias("kind"), "role", F.col("event.text").alias("text")
    )
