"""Secret scans: all rules as one automaton, run once over the bytes of each text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.llm import automaton
from codeset.llm.arrow import by_bytes


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail``; matches with fewer bytes than asked for are dropped."""

    kind: str
    head: str
    tail: str
    ignore_case: bool = False
    min_tail: int = 0
    min_total: int = 0


# Fixed patterns and lengths; the first three are the base kinds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        ignore_case=True,
        min_tail=6,
    ),
    Rule("access", "AKIA", "[A-Z0-9]+", min_total=20),
    Rule("hex", "", "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", min_tail=36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", min_tail=10),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", min_tail=35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", min_tail=16),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", ""),
)
RULES = BASE_RULES + MORE_RULES


@lru_cache
def compiled(rules: tuple[Rule, ...]):
    """The combined automaton, and per rule those of a match and of its head."""
    whole = [(rule.head + rule.tail, rule.ignore_case) for rule in rules]
    heads = [(rule.head, rule.ignore_case) for rule in rules]
    return (
        automaton.compile_rules(whole),
        [automaton.compile_rules([x], anchored=True) for x in whole],
        [automaton.compile_rules([x], anchored=True) for x in heads],
    )


def spans_of_text(
    rules: Sequence[Rule], machines, states: np.ndarray, text: bytes
) -> list[tuple[int, int, int]]:
    """(first byte, rule, end byte) of each match, in order."""
    combined, whole, heads = machines
    found = []
    for i, rule in enumerate(rules):
        for run in automaton.candidate_runs(combined, states, i):
            for begin, end in automaton.matches(whole[i], text, *run):
                tail = max(begin, heads[i].longest(text, begin, end))
                if end - begin >= rule.min_total and end - tail >= rule.min_tail:
                    found.append((begin, i, end))
    return sorted(found)


def spans_of_texts(
    rules: Sequence[Rule], machines, texts: list[bytes]
) -> dict[int, list[tuple[int, int, int]]]:
    """The matches of the texts that have any, from one scan of all bytes."""
    separator = bytes([automaton.SEPARATOR])
    data = np.frombuffer(separator.join(texts), np.uint8)
    starts = np.cumsum([0, *(len(text) + 1 for text in texts)])
    states = automaton.scan(machines[0], data)
    hits = automaton.accepting_bytes(machines[0], states)
    found = {}
    for i in np.unique(np.searchsorted(starts, hits, "right") - 1).tolist():
        begin = int(starts[i])
        own = automaton.states_between(states, begin, begin + len(texts[i]))
        if spans := spans_of_text(rules, machines, own, texts[i]):
            found[i] = spans
    return found


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]):
    """The same spans counted in characters."""
    leads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(leads)])
    return [(int(before[a]), i, int(before[b])) for a, i, b in spans]


def joined(rules: Sequence[Rule], spans) -> str:
    return ",".join(f"{rules[i].kind}:{a}:{b}" for a, i, b in spans)


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    base: int = len(BASE_RULES),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_<kind> of the base rules, base_sha256, spans) of each row.

    ``spans`` lists kind:start:end of all matches by start, then by the order
    of the rules; positions count code points.  ``base_sha256`` is the hash of
    the spans of the first ``base`` rules alone.  A null or empty text has no
    match; repeated rows are scanned each; other columns are left out.  Text
    is read whole in one pass, a few megabytes at a time, and nothing is
    shuffled.
    """
    rules = tuple(rules)
    machines = compiled(rules)
    kinds = [rule.kind for rule in rules[:base]]
    source = docs.select(key, F.coalesce(text, F.lit("")).cast("binary").alias("_text"))
    schema = ", ".join(
        [f"`{key}` {docs.schema[key].dataType.simpleString()}"]
        + [f"n_{kind} long" for kind in kinds]
        + ["base_sha256 string", "spans string"]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            counts = np.zeros((base, len(texts)), np.int64)
            hashes = [hashlib.sha256(b"").hexdigest()] * len(texts)
            listed = [""] * len(texts)
            for row, spans in spans_of_texts(rules, machines, texts).items():
                spans = in_code_points(texts[row], spans)
                first = [span for span in spans if span[1] < base]
                for _, i, _ in first:
                    counts[i, row] += 1
                hashes[row] = hashlib.sha256(joined(rules, first).encode()).hexdigest()
                listed[row] = joined(rules, spans)
            columns = [batch.column(key), *map(pa.array, counts)]
            columns += [pa.array(hashes, pa.string()), pa.array(listed, pa.string())]
            names = [key, *(f"n_{kind}" for kind in kinds), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(scan, schema)
