"""Token ids of whole texts by the tokenizers library, from Arrow columns."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1  # closes each document
MAX_CHUNKS = 400_000  # remembered; later ones are encoded in each batch anew


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    return _encoder(path).tokenizer.get_vocab_size(with_added_tokens=True)


@lru_cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return _encoder(path)


def positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each (start, length) in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


# Words of letters that NFC leaves alone and that have one lower-case letter
# each, then ASCII signs other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, int]:
    """The characters that stand for bytes in the vocabulary (a fixed rule).

    Printable bytes of Latin-1 stand for themselves, the others count on from 256.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(others)}


class Encoder:
    """Encodes texts chunk by chunk, where a chunk ends at a space or line end.

    The vocabulary's normaliser makes one space of all white space and its
    patterns never match across it, nor from a letter to a sign, so the ids
    of a text are those of its chunks in order.  Only chunks not seen before
    reach the tokenizer; plain ones go to its merges at once, as normaliser
    and patterns would only put them into lower case.  They are remembered in
    Arrow and numpy arrays, which take a quarter of a dictionary's memory: a
    worker keeps them while it waits for its next task.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share cores
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.letters = byte_letters()
        self.known = pa.array([], pa.large_string())  # a chunk's place is its slot
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.used = 0

    def ids_of(self, chunk: str) -> list[int]:
        plain = _PLAIN.fullmatch(chunk)
        if not plain:
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        ids = []
        for part in plain.groups():
            if not part.isascii():
                shown = part.lower().encode().decode("latin-1").translate(self.letters)
                ids += [token.id for token in self.merges.tokenize(shown)]
            elif part:
                ids += [token.id for token in self.merges.tokenize(part.lower())]
        return ids

    def add(self, chunks: list[str]) -> None:
        ids = [self.ids_of(chunk) for chunk in chunks]
        sizes = np.array([len(x) for x in ids], np.int64)
        first, total = len(self.known), int(sizes.sum())
        while len(self.starts) < first + len(chunks):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.starts[first : first + len(chunks)] = self.used + np.cumsum(sizes) - sizes
        self.lengths[first : first + len(chunks)] = sizes
        self.flat[self.used : self.used + total] = np.fromiter(
            (i for x in ids for i in x), np.uint32, total
        )
        self.used += total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and the last ones end).

        A null text counts as empty; each text is closed by ``END_ID``.
        """
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        texts = pc.replace_substring_regex(texts, "([A-Za-z])([.,])", r"\1 \2")
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        chunks = coded.dictionary.cast(pa.large_string())
        used, remembers = self.used, len(self.known) < MAX_CHUNKS
        found = pc.index_in(chunks, value_set=self.known)
        new = chunks.filter(found.is_null())
        self.add(new.to_pylist())
        slots = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        slots[slots < 0] = len(self.known) + np.arange(len(new))
        each = slots[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.lengths[each]
        ids = self.flat[positions(self.starts[each], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = words.offsets.to_numpy().astype(np.int64)
        cuts = ends[bounds - bounds[0]]
        ids = np.insert(ids, cuts[1:], END_ID)
        if remembers:
            self.known = pa.concat_arrays([self.known, new])
        else:
            self.used = used
        return ids.astype("<u4"), cuts + np.arange(len(cuts))
