import hashlib
import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from codeset.functions import naming
from codeset.operators import files as ops
from codeset.plans.dataset import Settings, unique_files
from codeset.sources import readers
from helpers import rows

FILES = (
    "repository_dirname string, repository_language string, "
    "filename string, dedup_key string"
)


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("a/b/foo.tar.GZ", "gz"),
        (".env", ""),
        ("x/..env", "env"),
        ("foo.", ""),
        ("Makefile", ""),
        ("a.b/c", ""),
        ("c.C++", "c++"),
        ("d.hs-boot", "hs-boot"),
        ("line\nbreak.PY", "py"),
    ],
)
def test_extension(spark, name, wanted):
    df = spark.createDataFrame([(name,)], "filename string")
    assert rows(df.select(naming.extension("filename"))) == [(wanted,)]


def test_content_key(spark):
    df = spark.createDataFrame([(b"",), (b"x\n\xff",)], "content binary")
    wanted = hashlib.sha1(b"blob 3\0x\n\xff").hexdigest()
    assert rows(df.select(naming.content_key("content"))) == sorted(
        [(naming.EMPTY_BLOB,), (wanted,)]
    )


def test_parse_listing(spark):
    lines = spark.createDataFrame(
        [
            ("r", "100644 blob abc\tsrc/a.py"),
            ("r", "100644 blob def\tsrc/with some  space.py "),
            ("r", "100644 blob ghi"),
            ("r", ""),
            ("r", "  100755 blob jkl\té.c"),
        ],
        "repository_dirname string, line string",
    )
    assert rows(ops.parse_file_listing(lines), "filename", "dedup_key") == [
        ("src/a.py", "abc"),
        ("src/with some  space.py", "def"),
        ("é.c", "jkl"),
    ]


@pytest.mark.parametrize(
    "filename, repository_language, wanted",
    [
        ("x.h", "C", "C"),
        ("x.h", "C++", "C++"),
        ("x.h", "Objective-C", "Objective-C"),
        ("x.h", "Python", None),
        ("x.h", None, None),
        ("x.pl", "Perl", "Perl"),
        ("x.pl", "Prolog", "Prolog"),
        ("x.pl", "Ruby", None),
        ("Makefile", "C", "Makefile"),
        ("makefile", "C", None),
        ("a/Makefile.PL", "C", "Perl"),
        ("mix.lock", "C", "Elixir"),
        ("x.PY", "C", "Python"),
        ("x.txt", "C", None),
    ],
)
def test_resolve_language(spark, dictionary, filename, repository_language, wanted):
    df = spark.createDataFrame(
        [("r", repository_language, filename, "k")], FILES
    )
    found = ops.resolve_language(df, dictionary)
    assert rows(found, "language") == [(wanted,)]


def listing(spark, *triples):
    return spark.createDataFrame([(r, "C", f, k) for r, f, k in triples], FILES)


def test_usable_files(spark, dictionary):
    df = listing(
        spark,
        ("r", "a.py", "k1"),
        ("r", "b.py", naming.EMPTY_BLOB),
        ("r", "c.py/", "k2"),
        ("r", "d.txt", "k3"),
    )
    assert rows(ops.usable_files(df, dictionary), "filename") == [("a.py",)]


def test_rank_counts_from_one_and_caps(spark, dictionary):
    names = [("big", f"f{i}.py", f"k{i}") for i in range(300)]
    names += [("big", f"f{i}.go", f"g{i}") for i in range(3)]
    names += [("small", "only.py", "s")]
    df = listing(spark, *names)
    ranked = ops.rank_files(df, dictionary, cap=100)
    found = {}
    for repo, language, rank in rows(ranked, "repository_dirname", "language", "rank"):
        found.setdefault((repo, language), []).append(rank)
    assert {k: sorted(v) for k, v in found.items()} == {
        ("big", "Python"): list(range(1, 101)),
        ("big", "Go"): [1, 2, 3],
        ("small", "Python"): [1],
    }
    again = ops.rank_files(df.repartition(13), dictionary, cap=100)
    assert rows(again) == rows(ranked)
    suffixes = ranked.where("not endswith(extract_to, if(language = 'Go', '.go', '.py'))")
    assert suffixes.isEmpty()


def test_dedup_keeps_the_first(spark, dictionary):
    df = listing(
        spark, ("r2", "a.py", "same"), ("r1", "b.py", "same"), ("r1", "c.py", "other")
    )
    kept = ops.dedup_files(ops.rank_files(df, dictionary))
    assert rows(kept, "repository_dirname", "filename") == [
        ("r1", "b.py"),
        ("r1", "c.py"),
    ]


def test_available_counts_in_dictionary_order(spark, dictionary):
    df = ops.rank_files(listing(spark, ("r", "a.py", "k")), dictionary)
    found = [tuple(r) for r in ops.available_by_language(df, dictionary).collect()]
    assert [language for language, _ in found] == dictionary.languages
    assert dict(found)["Python"] == 1 and sum(n for _, n in found) == 1


def test_incremental_listing(spark):
    repos = spark.createDataFrame([("new",), ("old",)], "repository_dirname string")
    ledger = spark.createDataFrame([("old",), ("gone",)], "repository_dirname string")
    assert rows(ops.new_repositories(repos, ledger)) == [("new",)]
    files = listing(spark, ("old", "a.py", "1"), ("gone", "b.py", "2"))
    assert rows(ops.surviving_files(files, repos), "filename") == [("a.py",)]
    assert rows(ops.removal_report(files, repos)) == [(2, 1, 1)]


def test_batches_are_bounded(spark):
    df = spark.range(1, 26).select(
        F.lit("r").alias("repository_dirname"),
        F.concat(F.lit("f"), "id").alias("filename"),
        F.concat(F.lit("x"), "id").alias("extract_to"),
        F.lit("C").alias("language"),
        F.lit("train").alias("usage"),
        F.col("id").cast("int").alias("rank"),
    )
    found = ops.files_by_repository(df, batch_size=10)
    assert rows(found, "batch", "n_files") == [(0, 10), (1, 10), (2, 5)]
    whole = ops.files_by_repository(df).collect()
    assert len(whole) == 1 and len(whole[0].files) == 25


def test_listing_files_and_contents(spark, tmp_path):
    listings = tmp_path / "listings"
    listings.mkdir()
    (listings / "a___b.txt").write_text("100644 blob k1\tsrc/x.py\n")
    lines = readers.read_file_listings(spark, str(listings))
    parsed = ops.parse_file_listing(lines)
    assert rows(parsed) == [("a___b", "src/x.py", "k1")]

    root = tmp_path / "repositories"
    (root / "a___b" / "src").mkdir(parents=True)
    (root / "a___b" / "src" / "x.py").write_bytes(b"\xff1")
    contents = readers.read_contents(spark, str(root))
    assert rows(contents) == [("a___b", "src/x.py", bytearray(b"\xff1"))]
    missing = spark.createDataFrame(
        [("a___b", "src/x.py"), ("a___b", "gone.py")],
        "repository_dirname string, filename string",
    )
    found = {r.filename: r.content for r in readers.with_content(missing, contents).collect()}
    assert found == {"src/x.py": b"\xff1", "gone.py": None}


def test_unusual_file_names(spark, tmp_path, dictionary):
    names = ["with space.py", "100%25.py", "é#1.py", "a+b=c.py"]
    source = tmp_path / "repositories" / "a___b" / "src dir"
    source.mkdir(parents=True)
    for name in names:
        (source / name).write_text(name)
    contents = readers.read_contents(spark, str(tmp_path / "repositories"))
    found = {r.filename: r.content.decode() for r in contents.collect()}
    assert found == {f"src dir/{name}": name for name in names}
    scanned = readers.scan_directory(spark, str(source))
    assert rows(scanned, "name") == sorted([(n,) for n in names], key=repr)
    listings = tmp_path / "listings"
    listings.mkdir()
    for name in names:
        (listings / f"{name}.txt").write_text("line")
    lines = readers.read_file_listings(spark, str(listings))
    assert rows(lines, "repository_dirname") == sorted([(n,) for n in names], key=repr)
    tests = readers.scan_test_files(spark, str(source), dictionary)
    assert rows(tests, "name", "text") == sorted([(n, n) for n in names], key=repr)


def test_scan_directory(spark, tmp_path):
    for name in ("1.py", "2.go", "plain"):
        (tmp_path / name).write_text("text of " + name)
    assert rows(readers.scan_directory(spark, str(tmp_path))) == [
        ("1.py", ".py"),
        ("2.go", ".go"),
        ("plain", ""),
    ]
    assert rows(readers.scan_directory(spark, str(tmp_path), "*.py"), "name") == [
        ("1.py",)
    ]


def test_scan_test_files(spark, tmp_path, dictionary):
    for name in ("1.py", "2.hpp", "3.txt"):
        (tmp_path / name).write_text("text of " + name)
    found = rows(readers.scan_test_files(spark, str(tmp_path), dictionary))
    assert found == [("1.py", "Python", "text of 1.py")]


def test_rank_equals_a_plain_loop(spark, dictionary):
    """The two-pass top-n gives the ranks of one sort per group."""
    draw = random.Random(3)
    triples = [
        (f"r{draw.choice([0, 0, 0, 1, 2])}", f"d{i}/f.{draw.choice(['py', 'go'])}", f"k{i}")
        for i in range(400)
    ]
    ranked = ops.rank_files(
        listing(spark, *triples).repartition(11), dictionary, cap=40
    )
    groups = {}
    for repo, name, _ in triples:
        groups.setdefault((repo, name.rsplit(".", 1)[1]), []).append(name)
    wanted = []
    for (repo, _), names in groups.items():
        names.sort(key=lambda n: hashlib.md5(f"0:{repo}:{n}".encode()).hexdigest())
        wanted += [(repo, n, i) for i, n in enumerate(names[:40], 1)]
    assert rows(ranked, "repository_dirname", "filename", "rank") == sorted(
        wanted, key=repr
    )


def test_names_equal_pathlib(spark):
    draw = random.Random(1)
    names = {"".join(draw.choices("aB./_ é", k=draw.randint(1, 12))) for _ in range(800)}
    # paths as a listing has them: no empty, "." or ".." part
    names = sorted(
        n for n in names if not {"", ".", ".."} & set(n.split("/"))
    )
    assert len(names) > 300
    df = spark.createDataFrame([(n,) for n in names], "filename string")
    found = df.select(
        "filename", naming.basename("filename"), naming.extension("filename")
    )
    wanted = [
        (n, PurePosixPath(n).name, PurePosixPath(n).suffix.lstrip(".").lower())
        for n in names
    ]
    assert rows(found) == sorted(wanted, key=repr)


def test_listing_lines_equal_a_split(spark):
    draw = random.Random(2)
    lines = ["".join(draw.choices("ab \t", k=draw.randint(0, 14))) for _ in range(500)]
    df = spark.createDataFrame(
        [("r", l) for l in lines], "repository_dirname string, line string"
    )
    parts = [l.split(maxsplit=3) for l in (l.strip() for l in lines)]
    wanted = [(p[3], p[2]) for p in parts if len(p) == 4]
    assert len(wanted) > 50
    found = rows(ops.parse_file_listing(df), "filename", "dedup_key")
    assert found == sorted(wanted, key=repr)


def test_hot_repository_and_content(spark, dictionary):
    """Half of the files in one repository, a third with one content."""
    draw = random.Random(4)
    triples = []
    for i in range(2400):
        repo = "hot" if draw.random() < 0.5 else f"r{draw.randint(0, 60)}"
        key = "copy" if draw.random() < 0.33 else f"k{draw.randint(0, 900)}"
        triples.append((repo, f"d{i}/f.{draw.choice(['py', 'c', 'txt'])}", key))
    found = unique_files(listing(spark, *triples).repartition(17), Settings())
    groups = {}
    for repo, name, key in triples:
        if not name.endswith("txt"):
            groups.setdefault((repo, name[-2:]), []).append((name, key))
    kept = {}
    for (repo, _), files in groups.items():
        files.sort(key=lambda f: hashlib.md5(f"0:{repo}:{f[0]}".encode()).hexdigest())
        for rank, (name, key) in enumerate(files[: ops.FILES_PER_REPOSITORY], 1):
            kept[key] = min(kept.get(key, (repo, name, rank)), (repo, name, rank))
    wanted = [(key, *file) for key, file in kept.items()]
    columns = ["dedup_key", "repository_dirname", "filename", "rank"]
    assert rows(found, *columns) == sorted(wanted, key=repr)
