"""SimHash fingerprints, and links between near ones by deletion variants."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.session import land

SEED = 42  # fixed with the hash, XXH64
SHINGLE = 4
MAX_BITS = 4
POINTER_STEPS = 3  # each doubles the way that is looked ahead

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
_HASHES = 1 << 16  # hashes whose bits are counted at a time


def normalised(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    words = text.translate(_LOWER).translate(_SPACES).split(b" ")
    return [word for word in words if word]


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The hashes of all word shingles, repeats included, some at a time."""
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    count = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: count - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _HASHES):
        spans = zip(starts[at : at + _HASHES], stops[at : at + _HASHES])
        yield np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)


def voted(hashes: Iterable[np.ndarray]) -> int:
    """64 bits, each set if it is set in over half of the hashes."""
    set_bits, count = np.zeros(64, np.int64), 0
    for part in hashes:
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(0, dtype=np.int64)
        count += len(part)
    return int.from_bytes(np.packbits(set_bits * 2 > count).tobytes(), "big") if count else 0


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    return voted(shingle_hashes(normalised(text), shingle))


def with_fingerprint(
    docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text",
    **more: Column,
) -> DataFrame:
    """(key, fp, more columns) of each row; fp is the fingerprint as a signed long."""
    source = docs.select(
        key, F.coalesce(text, F.lit("")).cast("binary").alias("_text"),
        *(column.alias(name) for name, column in more.items()),
    )
    names = list(more)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(prints.view(np.int64)), *map(batch.column, names)],
                [key, "fp", *names],
            )

    kinds = {name: source.schema[name].dataType.simpleString() for name in (key, *names)}
    added = "".join(f", `{name}` {kinds[name]}" for name in names)
    return source.mapInArrow(compute, f"`{key}` {kinds[key]}, fp long{added}")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of segments so many that one differs by a bit at most."""
    count = max(2, max_bits // 2 + 1)
    cuts = [64 * i // count for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def variants(fp: Column, max_bits: int) -> Column:
    """For each of the 64 bits a key: the bit, and its segment without that bit."""
    return F.array(
        *(
            F.shiftrightunsigned(fp, low)
            .bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << bit)))
            .bitwiseOR(F.lit((low + bit) << 32))
            for low, bits in segments(max_bits)
            for bit in range(bits)
        )
    )


def whole_segments(fp: Column, max_bits: int) -> Column:
    """A key for each segment as it is."""
    return F.array(
        *(
            F.shiftrightunsigned(fp, low)
            .bitwiseAND(F.lit((1 << bits) - 1))
            .bitwiseOR(F.lit(low << 32))
            for low, bits in segments(max_bits)
        )
    )


def first_shared(difference: Column, max_bits: int) -> Column:
    """The wildcard bit of the first variant that two fingerprints share."""
    found = F.lit(None).cast("int")
    for low, bits in reversed(segments(max_bits)):
        part = F.shiftrightunsigned(difference, low).bitwiseAND(F.lit((1 << bits) - 1))
        place = F.bit_count(part.bitwiseXOR(part - 1)) - 1 + low  # of its lowest bit
        found = (
            F.when(part == 0, F.lit(low))
            .when(F.bit_count(part) == 1, place)
            .otherwise(found)
        )
    return found


def hub_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: fingerprints near the smallest one that shares a segment.

    By these few links most of a large group of near copies comes together
    before all its pairs are looked at.
    """
    rows = prints.select("fp", F.explode(whole_segments(F.col("fp"), max_bits)).alias("key"))
    hubs = rows.groupBy("key").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("_n"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_bits
    return (
        rows.join(hubs.where("_n > 1").drop("_n"), "key")
        .where((F.col("a") < F.col("fp")) & near)
        .select("a", F.col("fp").alias("b"))
        .distinct()
    )


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(_a, a, _b, b): fingerprints that differ by few bits and their roots, each pair once.

    ``prints`` has distinct ``fp`` and their ``root`` so far; pairs of one
    root are left out.  Cut into ``max_bits // 2 + 1`` segments, two near
    fingerprints have one that differs by a bit at most, so they share the
    variant that leaves this bit out.  The join on variants checks the
    distance of each pair and keeps it at the first variant it shares.
    """
    rows = prints.select("fp", "root", F.explode(variants(F.col("fp"), max_bits)).alias("key"))
    left = rows.select(F.col("fp").alias("_a"), F.col("root").alias("a"), "key")
    right = rows.select(
        F.col("fp").alias("_b"), F.col("root").alias("b"), F.col("key").alias("_key")
    )
    difference = F.col("_a").bitwiseXOR(F.col("_b"))
    return left.hint("merge").join(
        right,
        (F.col("key") == F.col("_key"))
        & (F.col("_a") < F.col("_b"))
        & (F.col("a") != F.col("b"))
        & (F.bit_count(difference) <= max_bits)
        & (F.shiftright("key", 32) == first_shared(difference, max_bits)),
    ).select("_a", "a", "_b", "b")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): the roots of fingerprints that differ by few bits, once for each pair."""
    return near_pairs(prints, max_bits).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(fp, root): one root for all fingerprints that ``links`` (a, b) connect.

    Each round every node points to its smallest neighbour, pointers are
    followed a few times, and links are drawn between the ends: links inside a
    group vanish, and copies of a link become one.  Fingerprints are hashes,
    so pointers form short paths and few rounds are needed.  Links and
    pointers are written to the shared folder after each round, until no link
    is left.
    """
    links = land(links.select("a", "b"), "links")
    ends = F.explode(F.array("a", "b")).alias("fp")
    roots = land(links.select(ends).distinct().withColumn("root", F.col("fp")), "roots")
    while not links.isEmpty():
        ways = F.explode(
            F.array(F.struct(F.col("a").alias("fp"), F.col("b").alias("to")),
                    F.struct(F.col("b").alias("fp"), F.col("a").alias("to")))
        ).alias("way")
        pointers = (
            links.select(ways).groupBy("way.fp").agg(F.min("way.to").alias("to"))
            .withColumn("to", F.least("fp", "to"))
        )
        for _ in range(POINTER_STEPS):
            pointers = land(pointers, "pointers")
            ahead = pointers.select(F.col("fp").alias("to"), F.col("to").alias("_next"))
            pointers = pointers.join(ahead, "to").select("fp", F.col("_next").alias("to"))
        pointers = land(pointers, "pointers")

        def moved(name: str) -> DataFrame:
            return pointers.select(F.col("fp").alias(name), F.col("to").alias(f"_{name}"))

        roots = land(
            roots.join(moved("root"), "root", "left").select(
                "fp", F.coalesce("_root", "root").alias("root")
            ),
            "roots",
        )
        drawn = links.join(moved("a"), "a").join(moved("b"), "b").where("_a <> _b")
        links = land(
            drawn.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "links",
        )
    return roots


def with_roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` (fp, least, root) after their roots are linked, landed."""
    found = components(links).select(F.col("fp").alias("root"), F.col("root").alias("_new"))
    return land(
        nodes.join(found, "root", "left").select(
            "fp", "least", F.coalesce("_new", "root").alias("root")
        ),
        "groups",
    )


def with_groups(prints: DataFrame, max_bits: int, key: str) -> DataFrame:
    """``prints`` with the ``root`` of each fingerprint and the ``component_id``.

    Equal fingerprints are one node, so copies cost no pairs; links to the
    smallest sharer of each segment are drawn first, and then those of all
    pairs that are still apart.
    """
    nodes = land(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    grouped = with_roots(nodes.withColumn("root", F.col("fp")), hub_links(nodes, max_bits))
    grouped = with_roots(grouped, near_links(grouped, max_bits))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    found = grouped.join(named, "root").select("fp", "root", "component_id")
    return prints.join(found, "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, fingerprint, component_id) of each row.

    Words are runs without ASCII white space, A-Z in lower case; the hashes
    of all word shingles, repeats included, vote on each bit.  Texts without
    words have fingerprint zero and are linked like any other; null texts
    count as empty.  ``component_id`` is the smallest key that can be reached;
    rows with a null key take their component's, which is null if no key is
    known.  Repeated rows are kept; other columns are left out.
    """
    prints = land(with_fingerprint(docs, shingle, key, text), "fingerprints")
    return with_groups(prints, max_bits, key).select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row of each component, with the input's columns.

    It is a row with the component's smallest key, or without one if no key
    is known; of several such rows the one whose text, then whose columns have
    the smallest hash, so exactly one row stays even if keys or rows repeat.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    tag = F.xxhash64(F.col(key).isNull(), F.col(key), F.coalesce(text, F.lit("")))
    prints = land(with_fingerprint(docs, shingle, key, text, _tag=tag), "fingerprints")
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "_tag"))
    chosen = with_groups(prints, max_bits, key).groupBy("root").agg(first.alias("_first"))
    wanted = chosen.select(
        F.coalesce(F.hash("_first.key"), F.lit(0)).alias("_key"), F.col("_first._tag").alias("_tag")
    )
    rows = docs.select(
        whole.alias("_row"), F.coalesce(F.hash(key), F.lit(0)).alias("_key"), tag.alias("_tag")
    )
    of_key = Window.partitionBy("_key", "_tag").orderBy(F.xxhash64("_row"))
    return (
        rows.join(wanted, ["_key", "_tag"])
        .withColumn("_place", F.row_number().over(of_key)).where(F.col("_place") == 1)
        .select("_row.*")
    )
