"""Chat formatting in windows of a token budget.

Turns are rendered between markers; a ``<`` of a text is written as backslash and
``l``, a backslash twice, so no marker and no other string in angle brackets occurs
in a text and reading is exact. The sums of turn tokens, each turn encoded by
itself, choose spans of whole turns that fit the budget. Each later window begins
with the latest system turn before it, in whatever place that stood, and, as far as they fit ``history`` tokens,
the turns before its span; these are repeats and not under the loss mask, so
every assistant text is a target once.

Rows are dealt by conversation and sorted by turn. A task keeps the system turn,
the history and the turns of one window, never a whole conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tokens import encoder

OPEN, CLOSE = "<turn>", "</turn>\n"
BUDGET, HISTORY = 1024, 256
_CODED = {"n": "\n", "l": "<"}
_TURN = re.compile(r"<turn>((?:[^\\<\n]|\\.)*)\n((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _CODED.get(m[1], m[1]), text, flags=re.DOTALL)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its escaped text begins and ends."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parsed(text: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a window."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Conversation:
    """The windows of one conversation, made while its turns come in."""

    def __init__(self, key, budget: int, history: int):
        self.key, self.budget, self.limit = key, budget, history
        self.system: tuple | None = None
        self.past: deque[tuple] = deque()
        self.span: list[tuple] = []
        self.lead: list[tuple] = []
        self.used = self.window = 0

    def add(self, role: str, text: str, count) -> Iterator[tuple]:
        turn, start, end = rendered(role, text)
        item = (turn, start, end, role == "assistant", count(turn))
        if not self.span or self.used + item[4] > self.budget:
            if self.span:
                yield self.close()
            self.open(item[4])
        self.span.append(item)
        self.used += item[4]
        if role == "system":
            self.system = item

    def open(self, first: int) -> None:
        """Begin a window: the system turn and as much history as leaves room for the first turn."""
        self.lead = [self.system] if self.system else []
        self.used = self.system[4] if self.system else 0
        room = min(self.limit, self.budget - self.used - first)
        taken, total = [], 0
        for item in reversed(self.past):
            if total + item[4] > room:
                break
            total += item[4]
            taken.append(item)
        self.lead += taken[::-1]
        self.used += total

    def close(self) -> tuple:
        """The window's row: key, number, text, loss spans, repeated turns, tokens, whether it is over budget."""
        spans, at = [], sum(len(x[0]) for x in self.lead)
        for turn, start, end, target, _ in self.span:
            if target:
                spans.append({"start": at + start, "end": at + end})
            at += len(turn)
        row = (self.key, self.window, "".join(x[0] for x in self.lead + self.span), spans, len(self.lead), self.used, self.used > self.budget)
        for item in self.span:
            if item is not self.system:
                self.past.append(item)
        held = sum(x[4] for x in self.past)
        while self.past and held > self.limit:
            held -= self.past.popleft()[4]
        self.window, self.span = self.window + 1, []
        return row


WINDOWS = "conv_id long, window long, text string, loss array<struct<start:long,end:long>>, repeated int, tokens long, over_budget boolean"
_TYPES = [
    pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int32(), pa.int64(), pa.bool_(),
]
_NAMES = ["conv_id", "window", "text", "loss", "repeated", "tokens", "over_budget"]


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _formatted(path: str, budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        count = lambda text: len(tokens.ids(text)) // 2
        now, rows, size = None, [], 0
        for batch in batches:
            for i in range(len(batch)):
                key, role, text = (c[i].as_py() for c in batch.columns)
                if now is None or key != now.key:
                    if now is not None:
                        rows.append(now.close())
                    now = Conversation(key, budget, history)
                rows += now.add(role or "", text or "", count)
                size += len(text or "")
                if size > 1 << 20 and rows:
                    yield _batch(rows, _TYPES, _NAMES)
                    rows, size = [], 0
        if now is not None:
            rows.append(now.close())
        yield _batch(rows, _TYPES, _NAMES)

    return run


def chat_windows(
    turns: DataFrame,
    tokenizer: str,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """Rows of ``WINDOWS``: formatted windows, in order within their conversation.

    ``loss`` spans count code points of ``text`` and cover the escaped assistant
    texts of the window's own turns; its first ``repeated`` turns are repeats. A
    turn that alone exceeds what the budget leaves gets a window of its own, whole
    and marked ``over_budget``. Null roles and texts are empty; null turns come
    first; equal turn numbers go by role and text; repeated rows are repeated
    turns; null conversations are one conversation. No rows give no windows.
    """
    rows = turns.select(*(F.col(f"`{c}`").alias(name) for c, name in ((key, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))))
    rows = rows.withColumn("conv_id", F.col("conv_id").cast("long"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_formatted(tokenizer, budget, history), WINDOWS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, windows long"
_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_DIGEST_NAMES = [c.split()[0] for c in DIGESTS.split(", ")]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None

    def done() -> list[tuple]:
        return [(key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])] if state else []

    for batch in batches:
        rows: list[tuple] = []
        for i in range(len(batch)):
            conv, window, text, loss, repeated = (batch.column(c)[i].as_py() for c in range(5))
            if state is None or window == 0:
                rows += done()
                key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, said in parsed(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for span in loss:
                said = unescape(text[span["start"] : span["end"]])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
            state[5] += 1
        yield _batch(rows, _DIGEST_TYPES, _DIGEST_NAMES)
    yield _batch(done(), _DIGEST_TYPES, _DIGEST_NAMES)


def read_back(windows: DataFrame) -> DataFrame:
    """Rows of ``DIGESTS`` per conversation, from windows that lie in order, as ``chat_windows`` leaves them."""
    return windows.mapInArrow(_read, DIGESTS)
