"""Fingerprints, links and groups against brute force."""

import random
import re

import pytest
import xxhash

from codeset.llm import simhash


def brute_fingerprint(text, size=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, max_bits):
    """Smallest reachable key, by trying all pairs."""
    root = {key: key for key in prints}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: find(key) for key in keys}


def test_query(documents, texts):
    prints = {key: brute_fingerprint(text) for key, text in texts.items()}
    groups = brute_groups(prints, 4)
    rows = simhash.near_duplicates(documents).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == groups[row["doc_id"]]


@pytest.mark.parametrize("text", ["", " \t\x0b", "One", "a b c", "Ä b C d", "x y z w v u", "\x1c a\x85b c"])
@pytest.mark.parametrize("size", [1, 4, 5])
def test_small_texts(text, size):
    assert simhash.fingerprint(text.encode(), size) == brute_fingerprint(text, size)


def test_long_text():
    random.seed(1)
    text = " ".join(random.choices("abcdefgh", k=70_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("max_bits", [0, 1, 4, 5, 7])
def test_links_of_all_distances(spark, max_bits):
    """Chains of flips around a few centres, and the extreme values."""
    random.seed(max_bits)
    values = {0, (1 << 64) - 1, 1 << 63, 1}
    for _ in range(12):
        center = random.getrandbits(64)
        for bits in range(10):
            flips = random.sample(range(64), bits)
            values.add(center ^ sum(1 << b for b in flips))
    values = sorted(values)
    want = {
        frozenset((a, b)) for i, a in enumerate(values) for b in values[i + 1 :]
        if (a ^ b).bit_count() <= max_bits
    }
    prints = spark.createDataFrame([(signed(v), signed(v)) for v in values], "fp long, root long")
    rows = simhash.near_links(prints, max_bits).collect()
    found = [frozenset(x % (1 << 64) for x in row) for row in rows]
    assert len(found) == len(set(found)) and set(found) == want
    hubs = {frozenset(x % (1 << 64) for x in r) for r in simhash.hub_links(prints, max_bits).collect()}
    assert hubs <= want
    one = prints.withColumn("root", prints.fp % 3)
    assert all(a != b for a, b in simhash.near_links(one, max_bits).collect())


@pytest.mark.parametrize("order", ["sorted", "mixed"])
def test_long_chain(spark, order):
    """Groups are followed over many links."""
    names = [100 + i if order == "sorted" else hash((i, 7)) % (1 << 40) for i in range(60)]
    links = [tuple(sorted((names[i], names[i + 1]))) for i in range(59) if i != 20]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert set(found) == set(names)
    for part in (names[:21], names[21:]):
        assert len({found[name] for name in part}) == 1
    assert found[names[0]] != found[names[-1]]
