"""Conversations as training texts, put together from columns of bytes.

A turn is ``### role: text`` and, on a line of its own, ``</turn>``.  Control
strings inside a text get a backslash before them, so the end of a turn is
the only ``</turn>`` without one; in a role backslashes, colons and line ends
are escaped.  Both are undone exactly by ``read_back``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.llm.terms import text_bytes
from codeset.llm.tokens import positions

HEAD, COLON, END = b"### ", b": ", b"\n</turn>\n"
CONTROLS = (b"### ", b"</turn>")
ASSISTANT = "assistant"
PIECE_BYTES = 4 << 20  # of texts that are put together at a time

_BACKSLASH = ord("\\")
_ROLE_ESCAPES = {_BACKSLASH: _BACKSLASH, ord(":"): ord(":"), ord("\n"): ord("n")}


def found_in(data: np.ndarray, bounds: np.ndarray, wanted: bytes) -> np.ndarray:
    """Where ``wanted`` begins inside one of the texts."""
    at = np.flatnonzero(data == wanted[0])
    for step, byte in enumerate(wanted[1:], 1):
        at = at[at + step < len(data)]
        at = at[data[at + step] == byte]
    text = np.searchsorted(bounds, at, "right") - 1
    return at[at + len(wanted) <= bounds[text + 1]]


def escapes_of_texts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, which of them get a backslash before them)."""
    marked = np.zeros(len(data), bool)
    for control in CONTROLS:
        marked[found_in(data, bounds, control)] = True
    return data, marked


def escapes_of_roles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    marked = np.isin(data, list(_ROLE_ESCAPES))
    table = np.arange(256, dtype=np.uint8)
    table[list(_ROLE_ESCAPES)] = list(_ROLE_ESCAPES.values())
    return table[data], marked


def characters(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Code points between neighbouring ``cuts`` of UTF-8 bytes."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.diff(before[cuts])


class Assembly:
    """The turns of a batch in one buffer, each made of five segments."""

    def __init__(self, roles: pa.Array, texts: pa.Array):
        size = len(texts)
        parts, lengths = [], np.zeros((size, 5), np.int64)
        lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(HEAD), len(COLON), len(END)
        for column, values, escapes in ((1, roles, escapes_of_roles), (3, texts, escapes_of_texts)):
            data, bounds = text_bytes(values)
            data, marked = escapes(data, bounds)
            extra = np.concatenate([[0], np.cumsum(marked)])
            lengths[:, column] = np.diff(bounds) + np.diff(extra[bounds])
            parts.append((column, data, bounds, marked, extra))
        ends = np.cumsum(lengths.ravel())
        starts = (ends - lengths.ravel()).reshape(size, 5)
        self.buffer = pa.allocate_buffer(int(ends[-1]) if size else 0)
        out = np.frombuffer(self.buffer, np.uint8)
        for column, segment in ((0, HEAD), (2, COLON), (4, END)):
            held = np.frombuffer(segment, np.uint8)
            out[(starts[:, column, None] + np.arange(len(held))).ravel()] = np.tile(held, size)
        for column, data, bounds, marked, extra in parts:
            # A byte moves by its text's start and by the backslashes up to it.
            sizes = np.diff(bounds)
            shift = np.repeat(starts[:, column] - bounds[:-1] - extra[bounds[:-1]], sizes)
            place = np.arange(len(data)) + shift + extra[1:]
            out[place] = data
            out[place[marked] - 1] = _BACKSLASH
        self.bounds = np.append(starts[:, 0], ends[-1] if size else 0)
        cuts = np.concatenate([starts[:, [0, 3, 4]].ravel(), self.bounds[-1:]])
        counted = characters(out, cuts).reshape(size, 3)
        self.chars = counted.sum(1)
        self.loss = np.stack([counted[:, 0], counted[:, 0] + counted[:, 1]], 1)

    def pieces(self, firsts: np.ndarray) -> pa.Array:
        """The turns from each of ``firsts`` to the next, as slices of the buffer."""
        bounds = self.bounds[np.append(firsts, len(self.bounds) - 1)]
        if bounds[-1] >= 1 << 31:
            raise ValueError("the texts of a batch exceed one Arrow array")
        return pa.Array.from_buffers(
            pa.string(), len(firsts), [None, pa.py_buffer(bounds.astype(np.int32)), self.buffer]
        )


def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, piece, n_turns, formatted, loss) of turns that come in order.

    A piece ends where the conversation or the batch does.
    """
    number, last = 0, None
    for batch in by_bytes(batches, "_text", PIECE_BYTES):
        held = Assembly(batch.column("_role"), batch.column("_text"))
        ids = batch.column("conv_id").to_pylist()
        firsts = np.array([i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]])
        sizes = np.diff(np.append(firsts, len(ids)))
        before = np.cumsum(held.chars) - held.chars
        shift = before - np.repeat(before[firsts], sizes)
        learnt = np.array(batch.column("_learnt"))
        spans = (held.loss + shift[:, None])[learnt]
        counts = np.add.reduceat(learnt.astype(np.int64), firsts)
        inner = pa.StructArray.from_arrays(
            [pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["begin", "end"]
        )
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        numbers = []
        for first in firsts.tolist():
            number = number + 1 if last is not None and last == (ids[first],) else 0
            last = (ids[first],)
            numbers.append(number)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id").take(pa.array(firsts)), pa.array(numbers, pa.int64()),
                pa.array(sizes), held.pieces(firsts), pa.ListArray.from_arrays(offsets, inner),
            ],
            ["conv_id", "piece", "n_turns", "formatted", "loss"],
        )


PIECES = (
    "conv_id long, piece long, n_turns long, formatted string, "
    "loss array<struct<begin: long, end: long>>"
)


def prepared(turns: DataFrame) -> DataFrame:
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"),
        role.alias("_role"), text.alias("_text"), (role == ASSISTANT).alias("_learnt"),
    )


_ORDER = ["conv_id", "_turn", "_role", "_text"]


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, n_turns, formatted, loss) of every conversation.

    Turns follow each other by number, then role, then text; null roles and
    texts count as empty, null turns come first, null conversations are one;
    repeated rows are turns each; other columns are left out.  ``loss`` has
    the spans, in code points of ``formatted``, of the assistant's texts.
    Rows come in order within a partition; all of a conversation's pieces are
    in one partition, one piece unless its texts exceed a batch.
    """
    dealt = prepared(turns).repartition("conv_id").sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(assembled, PIECES)


def unescaped_role(role: str) -> str:
    out, at = [], 0
    while at < len(role):
        if role[at] == "\\":
            at += 1
            out.append("\n" if role[at] == "n" else role[at])
        else:
            out.append(role[at])
        at += 1
    return "".join(out)


def unescaped(text: str) -> str:
    for control in CONTROLS:
        text = text.replace("\\" + control.decode(), control.decode())
    return text


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted piece."""
    at, end = 0, END.decode()
    while at < len(formatted):
        stop = formatted.index(end, at)
        head = at + len(HEAD)
        colon = head
        while formatted[colon] != ":":
            colon += 2 if formatted[colon] == "\\" else 1
        yield unescaped_role(formatted[head:colon]), unescaped(formatted[colon + len(COLON) : stop])
        at = stop + len(end)


class Digest:
    """What a conversation's pieces say, read one after the other."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in turns_of(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for span in spans:
            text = unescaped(formatted[span["begin"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in DIGEST.split(", ")]
    kinds = [pa.string() if "string" in part else pa.int64() for part in DIGEST.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    open_: Digest | None = None
    for batch in by_bytes(batches, "formatted", PIECE_BYTES):
        done = []
        for row in batch.to_pylist():
            if open_ is None or row["piece"] == 0:
                if open_ is not None:
                    done.append(open_.row())
                open_ = Digest(row["conv_id"])
            open_.add(row["formatted"], row["loss"])
        yield made(done)
    if open_ is not None:
        yield made([open_.row()])


def read_back(pieces: DataFrame) -> DataFrame:
    """A row per conversation, from its pieces in order, as they lie in their partitions.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars): turns are parsed and unescaped from the formatted text,
    the loss from its spans.
    """
    return pieces.mapInArrow(digests, DIGEST)
