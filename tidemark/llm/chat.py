"""Chat formatting with loss masks that are aligned by offsets.

A conversation is rendered whole, ``<|im_start|>role<|im_sep|>text<|im_end|>`` for every turn, and encoded once with
offsets. The three marks are special tokens added to the tokenizer file's own, so no token reaches over a mark. The
character spans of the assistant's texts and the tokens' spans are both sorted; binary searches of one in the other give
the runs of tokens under the loss mask.

Inside texts and roles a ``<|`` is written ``<\\|``, and a ``<`` with k backslashes and a bar with one backslash more, so
no control string (the file's own ones included) can occur there, and reading takes one backslash away again.

Rows are dealt by ranges of (conversation, turn, role, hash of the text), so a conversation of any length is spread over
tasks. A task renders what it has of a conversation in segments of whole turns, ``SEGMENT`` characters or one turn long;
marks are special tokens, so the segments' ids are those of the whole conversation. Texts of more than ``WINDOW``
characters are encoded in windows that end where the tokenizer splits whatever stands there.

Defined results: turns go by turn number (null first), then role, hash of the text and text; repeated rows are turns of
their own; null role and null text are empty; a null conv_id is a conversation of its own; only the role ``assistant``
(exactly) is under the mask, and an empty text of it leaves an empty run; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
SEGMENT = 1 << 20  # characters of a segment, or one turn
WINDOW = 1 << 20  # characters encoded at a time
BATCH = 1 << 20  # characters of the texts encoded together
SCHEMA = (
    "conv_id long, whole boolean, at struct<turn:long,role:string,h:long,seq:long>, n_turns int, formatted string, ids array<int>, "
    "loss array<struct<start:int,end:int>>"
)
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted turns, character spans of the assistant's texts)."""
    out, spans, n = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((n + len(head), n + len(head) + len(body)))
        out += [head, body, END]
        n += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that :func:`render` was given."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def windows(text: str, limit: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of at most about ``limit`` characters, cut where the tokenizer splits anyway: between a word and a single space."""
    at = 0
    while at < len(text):
        stop = at + limit
        cut = _SAFE_CUT.search(text, stop) if stop < len(text) else None
        stop = cut.start() if cut else len(text)
        yield at, stop
        at = stop


def token_runs(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The run of tokens that lie in each character span; an empty span has the empty run at its place.

    Parts of one character carry the span of that character, so both arrays are sorted.
    """
    if not spans:
        return []
    lo, hi = np.array(spans, np.int64).T
    first = np.searchsorted(starts, lo, "left")
    last = np.where(hi > lo, np.searchsorted(ends, hi, "right"), first)
    return list(zip(first.tolist(), last.tolist(), strict=True))


class ChatTokenizer:
    """The tokenizer file with the three marks as special tokens behind its own."""

    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer, processors

        self.library = Tokenizer.from_file(path)
        self.library.add_special_tokens([AddedToken(t, normalized=False) for t in (START, SEP, END)])
        self.library.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep a token's leading space
        from tidemark.llm.token_encoder import _byte_alphabet

        of_char = {c: b for b, c in _byte_alphabet().items()} | {chr(b): b for b in range(256) if b not in _byte_alphabet()}
        added = {i: t.content.encode() for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes = {i: added[i] if i in added else bytes(of_char[c] for c in t) for t, i in self.library.get_vocab(with_added_tokens=True).items()}

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first characters, last characters) of every text."""
        cuts = [list(windows(t)) or [(0, 0)] for t in texts]
        found = iter(self.library.encode_batch([t[a:b] for t, cut in zip(texts, cuts, strict=True) for a, b in cut], add_special_tokens=False))
        out = []
        for cut in cuts:
            parts = []
            for (at, _), e in zip(cut, found, strict=False):
                spans = np.fromiter(itertools.chain.from_iterable(e.offsets), np.int64, 2 * len(e.ids)).reshape(-1, 2) + at
                parts.append((np.array(e.ids, np.int32), spans[:, 0], spans[:, 1]))
            out.append(tuple(np.concatenate([p[i] for p in parts]) for i in range(3)))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()


_LOADED: dict[str, ChatTokenizer] = {}


def tokenizer(path: str) -> ChatTokenizer:
    """A worker keeps one of each file."""
    if path not in _LOADED:
        _LOADED[path] = ChatTokenizer(path)
    return _LOADED[path]


def _segments(batches) -> Iterator[tuple]:
    """(conv_id, whole, place of the first turn, turns) of sorted rows."""
    now, turns, size, place, seq, opened = None, [], 0, None, 0, True
    for batch in batches:
        for conv, turn, role, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if turns and (conv != now or size + len(text) > SEGMENT):
                yield now, conv != now and not opened, place, turns
                # the task's first conversation may have begun in another task
                opened, turns, size = conv == now, [], 0
            if not turns:
                now, place, seq = conv, {"turn": turn, "role": role, "h": h, "seq": seq}, seq + 1
            turns.append((role, text))
            size += len(text)
    if turns:
        yield now, False, place, turns


def format_conversations(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Segments (conv_id, whole, at, n_turns, formatted, ids, loss): ``loss`` are runs of tokens under the loss mask.

    ``whole``: the segment is its whole conversation. Other segments are ordered within theirs by ``at``.
    """

    def run(batches):
        import os

        import pyarrow as pa

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        t = tokenizer(tokenizer_path)

        def send(held):
            drawn = [render(turns) for *_, turns in held]
            coded = t.encode([text for text, _ in drawn])
            loss = [[{"start": a, "end": b} for a, b in token_runs(spans, starts, ends)] for (_, spans), (_, starts, ends) in zip(drawn, coded, strict=True)]
            ends = np.cumsum([0, *(len(ids) for ids, *_ in coded)]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, *_ in held], pa.int64()), pa.array([w for _, w, *_ in held], pa.bool_()),
                    pa.array([p for _, _, p, _ in held], pa.struct([("turn", pa.int64()), ("role", pa.string()), ("h", pa.int64()), ("seq", pa.int64())])),
                    pa.array([len(x) for *_, x in held], pa.int32()), pa.array([text for text, _ in drawn], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([ids for ids, *_ in coded]))),
                    pa.array(loss, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["conv_id", "whole", "at", "n_turns", "formatted", "ids", "loss"],
            )

        held, size = [], 0
        for segment in _segments(batches):
            held.append(segment)
            size += sum(len(text) for _, text in segment[3])
            if size > BATCH:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).select("conv_id", "turn", "role", F.xxhash64("text").alias("h"), "text")
    return rows.repartitionByRange("conv_id", "turn", "role", "h").sortWithinPartitions("conv_id", "turn", "role", "h", "text").mapInArrow(run, SCHEMA)


def read_back(segments: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of every conversation, from its formatted text (turns) and from its ids under the loss mask.

    Segments that are whole conversations are read where they are; the others move to one task a conversation, which
    holds one segment at a time (a hash over a conversation's turns in their order cannot be split).
    """

    def run(batches):
        import pyarrow as pa

        t = tokenizer(tokenizer_path)

        def send(conv, n, turns, chars, loss, length):
            row = [[conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [length]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                conv, whole, formatted, ids, runs = (c[i].as_py() for c in batch.columns)
                if now is not None and (whole or now[0] != conv):
                    yield send(*now)
                    now = None
                if now is None:
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for r in runs:
                    text = unescape(t.decode(ids[r["start"] : r["end"]]))
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(formatted)
        if now is not None:
            yield send(*now)

    columns = ["conv_id", "whole", "formatted", "ids", "loss"]
    parted = segments.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "at").select(columns)
    return segments.where("whole").select(columns).mapInArrow(run, DIGEST).union(parted.mapInArrow(run, DIGEST))


def formatted_digests(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Format, write, and read back."""
    return read_back(materialize(format_conversations(conversations, tokenizer_path), "chat"), tokenizer_path)
