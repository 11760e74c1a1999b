"""The automaton against backtracking expressions."""

import hashlib
import random
import re

import pytest

from codeset.llm import secrets


def brute_force(text, rules=secrets.RULES):
    found = []
    for i, rule in enumerate(rules):
        flags = re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)
        for match in re.finditer(f"(?:{rule.head})({rule.tail})", text, flags):
            tail = match.groups()[-1]
            if len(match[0]) >= rule.min_total and len(tail) >= rule.min_tail:
                found.append((match.start(), i, match.end()))
    return sorted(found)


PIECES = [
    "password", "PassWd", "secret", "token", "api_key", "APIKEY", ":", "=", " ", '"', "'",
    "abc", "abcdef", "0123456789abcdef", "f" * 30, "AKIA", "ABCDEFGH1234", "\n", "é", "🙂",
    "ghp_", "x" * 36, ".", "-", "eyJ", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "xoxb-",
]


def test_random_texts():
    random.seed(5)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 40))) for _ in range(4000)]
    machines = secrets.compiled(secrets.RULES)
    coded = [text.encode() for text in texts]
    found = secrets.spans_of_texts(secrets.RULES, machines, coded)
    for i, text in enumerate(texts):
        spans = secrets.in_code_points(coded[i], found.get(i, []))
        assert spans == brute_force(text), text


def test_chunks_continue_each_other():
    machines = secrets.compiled(secrets.RULES)
    text = b"a" * 5000 + b' token = "abcdefg" ' + b"AKIA" * 2000
    (spans,) = secrets.spans_of_texts(secrets.RULES, machines, [text]).values()
    assert spans == [(0, 2, 5000), (5001, 0, 5017), (5019, 1, 5019 + 8000)]


def test_query_equals_brute_force(documents, texts):
    for row in secrets.find_secrets(documents).collect():
        spans = brute_force(texts[row["doc_id"]])
        base = [span for span in spans if span[1] < 3]
        joined = ",".join(f"{secrets.RULES[i].kind}:{a}:{b}" for a, i, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert row["spans"] == secrets.joined(secrets.RULES, spans)
        for i, kind in enumerate(("assign", "access", "hex")):
            assert row[f"n_{kind}"] == sum(span[1] == i for span in base)


@pytest.mark.parametrize("pattern", ["(a", "a)", "*a"])
def test_bad_patterns(pattern):
    from codeset.llm.automaton import compile_rules

    with pytest.raises((ValueError, IndexError)):
        compile_rules([(pattern, False)])
