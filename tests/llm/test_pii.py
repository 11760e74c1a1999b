"""Pseudonyms are permutations inside their formats, against plain Python."""

import datetime
import hashlib
import re

import pytest

from codeset.llm import pii

KEY = "k"


def noise(kind, round_, half):
    return hashlib.sha512(f"{KEY}|{kind}|{round_}|{half}".encode()).hexdigest()


def brute_text(kind, value):
    plain = re.sub("[^A-Za-z0-9]", "", value)
    left, right = plain[: len(plain) // 2], plain[len(plain) // 2 :]
    for round_ in range(1, 9):
        hexes, out = noise(kind, round_, right), ""
        for i, char in enumerate(left):
            first, size = (48, 10) if char.isdigit() else (65, 26) if char.isupper() else (97, 26)
            shift = int(hexes[i % 64 * 2 : i % 64 * 2 + 2], 16)
            out += chr((ord(char) - first + shift) % size + first)
        left, right = right, out
    return left + right


def brute_pair(kind, left, right, sizes):
    (m, n) = sizes
    for round_ in range(1, 9):
        shift = int(noise(kind, round_, right)[:12], 16)
        left, right, m, n = right, (left + shift) % m, n, m
    return left, right


def fill(value, plain):
    chars = iter(plain)
    return re.sub("[A-Za-z0-9]", lambda _: next(chars), value)


def luhn(digits):
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
    return str(-total % 10)


def brute(kind, value):
    if kind == "email":
        front, end = re.fullmatch(r"(.*)(\.[^.]+)", value).groups()
        return fill(front, brute_text(kind, front)) + end
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        left, right = brute_pair(kind, a * 256 + b, c * 256 + d, (65536, 65536))
        return ".".join(map(str, (*divmod(left, 256), *divmod(right, 256))))
    if kind == "card":
        payload = brute_text(kind, re.sub("[^0-9]", "", value)[:-1])
        return fill(value, payload + luhn(payload))
    if kind == "phone":
        code = (re.match(r"\+[0-9]{1,3}(?=[ .(-])", value) or [""])[0]
        return code + fill(value[len(code) :], brute_text(kind, value[len(code) :]))
    if kind == "ssn":
        return fill(value, brute_text(kind, value))
    base = datetime.date(1900, 1, 1)
    form = "%Y-%m-%d" if "-" in value else f"%d{value[2]}%m{value[2]}%Y"
    day = (datetime.datetime.strptime(value, form).date() - base).days
    left, right = brute_pair(kind, day // 292, day % 292, (250, 292))
    return (base + datetime.timedelta(left * 292 + right)).strftime(form)


VALUES = [
    ("email", "bosbt.42@mail8.example.com"), ("email", "a@b.co"), ("email", "Ann_Lee+x%1@sub-host.org"),
    ("ip", "42.144.35.254"), ("ip", "255.255.255.255"), ("ip", "0.0.0.0"),
    ("card", "4041894974608795"), ("card", "4041 8949 7460 8795"), ("card", "378282246310005"),
    ("phone", "+1 (988) 555-2485"), ("phone", "+49 30 901820"), ("phone", "(988) 555-2485"),
    ("phone", "988-555-2485"), ("ssn", "078-05-1120"),
    ("date", "2024-02-29"), ("date", "29.02.2024"), ("date", "31/12/1999"), ("date", "1900-01-01"),
]
OTHERS = [
    "4041894974608796", "1234567890123", "2023-02-29", "31.04.2020", "256.1.1.1", "1.2.3", "4.0.",
    "12/34/5678", "user@", "@host.com", "v1.2.3.4.5", "1850-01-01", "5551234", "1.5", "a1b2",
]


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {row["doc_id"]: row for row in pii.pseudonymise(docs, KEY).collect()}


def test_values_in_texts(spark):
    texts = [f"Äb, {value} und {value}." for _, value in VALUES]
    found = run(spark, texts)
    for i, (kind, value) in enumerate(VALUES):
        new = brute(kind, value)
        assert found[i]["text"] == f"Äb, {new} und {new}.", value
        assert new != value
        assert {k: found[i][f"n_{k}"] for k in pii.KINDS} == {
            k: 2 * (k == kind) for k in pii.KINDS
        }


def test_other_texts_stay(spark):
    texts = [f"x {value} y" for value in OTHERS] + [None, "", "no numbers", "é" * 1000, "9" * 5000]
    found = run(spark, texts)
    for i, text in enumerate(texts):
        assert found[i]["text"] == text
        assert sum(found[i][f"n_{k}"] for k in pii.KINDS) == 0, text


def test_iban(spark):
    value = "DE89 3704 0044 0532 0130 00"
    row = run(spark, [f"an {value} ab", "an DE88 3704 0044 0532 0130 00 ab"])
    new = re.fullmatch(r"an (DE\d\d(?: \d{4}){4} \d\d) ab", row[0]["text"])[1]
    digits = "".join(str(int(c, 36)) for c in new.replace(" ", "")[4:] + new[:4])
    assert int(digits) % 97 == 1 and new != value and row[0]["n_iban"] == 1
    assert row[1]["text"] == "an DE88 3704 0044 0532 0130 00 ab"


@pytest.mark.parametrize("value", [
    "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332",
    "SE45 5000 0000 0583 9825 7466", "CZ65 0800 0000 1920 0014 5399",
    "RO49 AAAA 1B31 0075 9384 0000", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00",
])
def test_iban_before_another_token(spark, value):
    """The country's length ends the number, whatever stands behind it."""
    behind = [" BIC: GKCCBEBB", " 1234", " AB12", " EUR 50", " 4111 1111 1111 1111", ", x", ""]
    texts = [f"IBAN {value}{end}" for end in behind]
    texts += [f"IBAN {value.replace(' ', '')} BIC", f"REF XX12 3456 7890 {value} BIC"]
    for row in run(spark, texts).values():
        assert row["n_iban"] == 1 and value not in row["text"]
        assert value.replace(" ", "") not in row["text"]
        assert "4111 1111" not in row["text"]


@pytest.mark.parametrize("kind, values", [
    ("ssn", [f"{i:03d}-12-3456" for i in range(1000)]),
    ("date", [str(datetime.date(1900, 1, 1) + datetime.timedelta(73 * i)) for i in range(1000)]),
    ("ip", [f"10.0.{i // 256}.{i % 256}" for i in range(1000)]),
])
def test_different_values_stay_different(spark, kind, values):
    texts = [row["text"] for row in run(spark, values).values()]
    assert len(set(texts)) == len(values)


def test_query(documents, texts):
    """Nothing personal is left, and all else stays as it was."""
    rows = pii.pseudonymise(documents.select("doc_id", "text"), KEY).collect()
    whole = re.compile(pii.ANY)
    changed = 0
    for row in rows:
        text, found = texts[row["doc_id"]], []
        for match in whole.finditer(text):
            kind = next(k for k, p in pii.PATTERNS.items() if re.fullmatch(p.replace(r"\2", r"\1"), match[0]))
            digits = re.sub("[^0-9]", "", match[0])
            if kind != "card" or luhn(digits[:-1]) == digits[-1]:
                found.append((kind, match))
        want, at = "", 0
        for kind, match in found:
            want += text[at : match.start()] + brute(kind, match[0])
            at = match.end()
        assert row["text"] == want + text[at:]
        assert {k: row[f"n_{k}"] for k in pii.KINDS} == {
            k: sum(kind == k for kind, _ in found) for k in pii.KINDS
        }
        changed += bool(found)
    assert changed > 5


def test_no_python(documents):
    plan = pii.pseudonymise(documents, KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "Exchange" not in plan
