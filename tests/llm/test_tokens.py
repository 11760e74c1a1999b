"""Token ids, files and packing against the tokenizers library."""

import os
import random
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from codeset.llm import bitfile, cutting_stock, packing, token_files, tokens
from codeset.llm.tokens import encoder, vocabulary_path

PIECES = [
    "É", "ç", "ß", ".", ",", "|", "!!", ".,", "J̌", "word", "Word", "a", "B", "é", "́", " ",
    "\n", "\t", "\r", "\xa0", " ", "<|endoftext|>", "<|start", "'s", "'", "1", "２", "Σ",
    "İ", "🙂", "\x00", "\x85", "한", "µ", "ÿ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_library(library, texts):
    random.seed(3)
    made = ["".join(random.choices(PIECES, k=random.randint(0, 30))) for _ in range(3000)]
    made += list(texts.values())[:40] + ["", None]
    ids, bounds = encoder(vocabulary_path()).encode(pa.array(made))
    for i, text in enumerate(made):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(library, text)


def test_encoder_forgets(library, monkeypatch):
    """Ids are the same where chunks are no longer remembered, also as large strings."""
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 40)
    random.seed(4)
    coder = tokens.Encoder(vocabulary_path())
    for kind in [pa.string(), pa.large_string()] * 4:
        made = ["".join(random.choices(PIECES, k=random.randint(0, 30))) for _ in range(20)] + [None]
        ids, bounds = coder.encode(pa.array(made, kind))
        for i, text in enumerate(made):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(library, text)
    assert 40 <= len(coder.known) < 400


WAITING = """
import re
import numpy as np, pyarrow as pa
from codeset.llm.arrow import by_bytes
from codeset.llm.tokens import encoder, vocabulary_path

def used():
    sizes = re.findall(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())
    return int(sizes[0]) / 1024

def batches():
    rng = np.random.default_rng(5)
    for _ in range(4):
        yield pa.RecordBatch.from_pydict({"text": [
            " ".join(f"x{n}" for n in rng.integers(0, 500_000, 1000).tolist()) for _ in range(1500)
        ]})

def task():
    for batch in by_bytes(batches(), "text"):
        encoder(vocabulary_path()).encode(batch.column("text"))

encoder(vocabulary_path()).encode(pa.array(["a b"]))
before = used()
task()
print(used() - before)
"""


def test_waiting_worker_is_small():
    """After a task a worker keeps its chunks, but not the memory of its batches."""
    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("memory can't be read here")
    said = subprocess.run([sys.executable, "-c", WAITING], capture_output=True, text=True, check=True,
                          env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    assert float(said.stdout) < 100  # MB


@pytest.mark.parametrize("width", [1, 5, 8, 11, 16, 17, 32])
def test_files_round_trip(tmp_path, width):
    rng = np.random.default_rng(width)
    sizes = rng.integers(0, 40_000, 12)
    ids = rng.integers(0, 1 << width, sizes.sum(), dtype=np.uint64).astype("<u4")
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    path = str(tmp_path / "ids.bits")
    writer = bitfile.Writer(path, width)
    half = int(bounds[6])
    writer.add(ids[:half], bounds[:7], range(6), [0] * 6)
    writer.add(ids[half:], bounds[6:] - half, range(6, 12), [0] * 6)
    writer.close()
    reader = bitfile.Reader(path)
    assert reader.keys.tolist() == list(range(12)) and reader.count == len(ids)
    for i in range(12):
        assert np.array_equal(reader.document(i), ids[bounds[i] : bounds[i + 1]])
    for _ in range(20):
        begin, end = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert np.array_equal(reader.ids(begin, end), ids[begin:end])
    assert (tmp_path / "ids.bits").stat().st_size < len(ids) * width / 8 + 1000


def test_too_large_ids(tmp_path):
    writer = bitfile.Writer(str(tmp_path / "ids.bits"), 4)
    with pytest.raises(ValueError):
        writer.add(np.array([16], "<u4"), np.array([0, 1]), [1], [0])


def test_token_files_query(documents, texts, library):
    rows = token_files.read_token_files(
        token_files.write_token_files(documents, vocabulary_path())
    ).collect()
    before = 0
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        ids = ids_of(library, texts[row["doc_id"]])
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (before, len(ids), crc)
        before += len(ids)
    assert len(rows) == len(texts)


def padding(fill, sequence):
    return 0 if fill & (fill - 1) == 0 else sequence - fill


def test_packing_query(documents, texts, library):
    rows = packing.pack_documents(documents, vocabulary_path()).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert pieces.keys() == texts.keys()
    for key, own in pieces.items():
        ids, at = ids_of(library, texts[key]), 0
        for row in sorted(own, key=lambda r: r["start"]):
            part = ids[row["start"] : row["start"] + row["length"]]
            assert row["start"] == at and len(part) == row["length"] > 0
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert row["doc_tokens"] == len(ids)
            at += row["length"]
        assert at == len(ids)
    padded = total = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
        padded, total = padded + padding(at, 2048), total + at
    assert padded < 0.05 * total  # a few sequences only, so the last ones weigh


@pytest.mark.parametrize("count", [1, 7, 300, 5000])
def test_patterns_hold_every_piece(count):
    rng = np.random.default_rng(count)
    lengths = np.minimum(64, rng.geometric(0.06, count))
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    patterns = cutting_stock.patterns_for(histogram, 64)
    held = defaultdict(int)
    for pattern, uses in patterns.items():
        assert sum(length * times for length, times in pattern) <= 64
        for length, times in pattern:
            held[length] += times * uses
    assert held == histogram
    least = -(-int(lengths.sum()) // 64)
    assert sum(patterns.values()) <= least * 1.02 + 3


def test_linear_program_is_optimal():
    """Two thirds and one third of the room: three of a size in two sequences."""
    columns, use = cutting_stock.solve(np.array([4, 6]), np.array([30.0, 30.0]), 10)
    assert abs(use.sum() - 30) < 1e-3
