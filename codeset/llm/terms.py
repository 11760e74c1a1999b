"""Terms of texts as runs of bytes, counted by packed words.

Terms are maximal runs of certain ASCII characters and of all characters
beyond ASCII, with A-Z in lower case.  In UTF-8 all bytes of such characters
lie above 0x7F, so runs of bytes are runs of characters.

Short terms become one or two unsigned words of eight bytes, padded with
zeros, which no term holds; numpy sorts them by radix and counts runs.  Longer
ones lie in buckets of padded rows, one per power of two, sorted by bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from codeset.llm.tokens import positions

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTERS = np.zeros(256, bool)  # and all characters beyond ASCII
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LETTERS_AND_DIGITS = LETTERS.copy()
LETTERS_AND_DIGITS[48:58] = True

WORD = 8  # bytes


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bounds) of a string or binary array without nulls."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def runs(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray):
    """(first byte, length, text number) of each term, in order of the texts."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kinds[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = inside[heads]
    last = np.zeros(len(data) + 1, bool)
    last[heads] = True
    last[-1] = True
    ends = inside[:-1] & (~inside[1:] | last[1:])
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    return starts, lengths, np.searchsorted(bounds, starts, "right") - 1


def radix_order(words: np.ndarray) -> np.ndarray:
    """A stable order of rows of unsigned words, 16 bits at a time from the last.

    numpy sorts 16-bit numbers by radix when the sort has to be stable.
    """
    order = np.arange(len(words))
    for column in range(words.shape[1] - 1, -1, -1):
        for shift in (0, 16, 32, 48):
            digit = (words[:, column] >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


@dataclass
class Counted:
    """Each (term, owner) once: the owner, its occurrences, and the term's bytes."""

    owner: np.ndarray
    times: np.ndarray
    lengths: np.ndarray
    data: np.ndarray

    def terms(self) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(self.lengths)])
        if ends[-1] >= 1 << 31:
            raise ValueError("the terms of a batch exceed one Arrow array")
        return pa.Array.from_buffers(
            pa.string(), len(self.lengths),
            [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(self.data)],
        )


def padded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """One row of ``width`` bytes per term, with zeros behind it."""
    rows = np.zeros((len(starts), width), np.uint8)
    rows.ravel()[positions(np.arange(len(starts)) * width, lengths)] = data[positions(starts, lengths)]
    return rows


def run_counts(rows: np.ndarray, order: np.ndarray, owner: np.ndarray) -> Counted:
    """Runs of equal (row, owner), of rows that ``order`` sorts."""
    rows, owner = rows[order], owner[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(rows)))
    held = rows[first].view(np.uint8)
    lengths = (held != 0).sum(1)
    return Counted(owner[first], times, lengths, held[held != 0])


def count_terms(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owner: np.ndarray
) -> list[Counted]:
    """Occurrences of each (term, owner), by buckets of the terms' lengths.

    ``owner`` ascends; within a bucket the result is sorted by term, then
    owner.  ``data`` has the bytes in lower case.
    """
    found = []
    for width in (WORD, 2 * WORD):
        low = width - WORD
        of = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(of):
            packed = padded(data, starts[of], lengths[of], width).view(">u8")
            order = radix_order(packed.astype(np.uint64))
            found.append(run_counts(packed, order, owner[of]))
    longest = int(lengths.max(initial=0))
    width = 2 * WORD
    while width < longest:
        low, width = width, 2 * width
        of = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(of):
            rows = padded(data, starts[of], lengths[of], width)
            order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
            found.append(run_counts(rows, order, owner[of]))
    return found
