from codeset.functions.text import decode_files, detect_encoding, flag_files, is_utf8
from helpers import rows

NOISE = bytes.fromhex(
    "8f00c1fe93a7b201d9e4aa90f7c8bb9d8105eecad0f39be2a4c6fda1b8e7"
)


def decode(spark, *contents, **options):
    df = spark.createDataFrame(
        [(str(i), c) for i, c in enumerate(contents)], "name string, content binary"
    )
    found = decode_files(df, **options).cache()
    flagged = flag_files(df, **options)
    assert rows(flagged) == rows(found, "name", "encoding", "ok")
    assert found.columns == ["name", "text", "encoding", "ok"]
    return [r[1:] for r in rows(found)]


def test_kinds_of_content(spark):
    assert decode(
        spark,
        "déjà vu".encode(),
        "﻿mark".encode(),
        "wide £".encode("utf-16"),
        "wider £".encode("utf-32"),
        "déjà vu".encode("latin-1"),
        NOISE,
        b"text \xff with \x00",
        None,
        b"",
    ) == [
        ("déjà vu", "utf-8", True),
        ("﻿mark", "utf-8", True),
        ("wide £", "utf-16", True),
        ("wider £", "utf-32", True),
        ("déjà vu", "cp1252", True),
        (None, None, False),
        (None, None, False),
        (None, None, False),
        ("", "utf-8", True),
    ]


def test_detection():
    assert detect_encoding(b"plain \x81 text here")[1] < 0.5
    assert detect_encoding(b"a\x01\x02\x03\xff")[0] is None
    assert detect_encoding(b"\xe9" * 10)[1] < 0.5
    assert detect_encoding("\x1b[1mcolour\x1b[0m é".encode("latin-1"))[0] == "cp1252"


def test_broken_utf16_is_rejected(spark):
    assert decode(spark, b"\xff\xfe\x00\xd8") == [(None, None, False)]


def test_own_detector(spark):
    def detector(content):
        return ("koi8-r", 0.6) if content.startswith(b"\xc1") else ("no-such", 1.0)

    contents = ["а text".encode("koi8-r"), b"\xff?"]
    assert decode(spark, *contents, detector=detector) == [
        ("а text", "koi8-r", True),
        (None, None, False),
    ]
    assert decode(spark, *contents, detector=detector, min_confidence=0.7) == [
        (None, None, False),
        (None, None, False),
    ]


def test_is_utf8(spark):
    df = spark.createDataFrame([(b"ok",), (b"\xff",), (None,)], "content binary")
    assert rows(df.select(is_utf8("content"))) == [(False,), (None,), (True,)]
