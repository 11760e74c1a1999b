import json

import pytest

from codeset.dictionary import (
    Dictionary,
    default_dictionary,
    dict_conflicts,
    load_dictionary,
    one_of,
)
from helpers import rows


def test_sizes(dictionary):
    assert len(dictionary.languages) == 54
    values = [e for v in dictionary.extensions.values() for e in v]
    assert len(values) == 221 and len(set(values)) == 216
    assert sum(map(len, dictionary.file_names.values())) == 80
    assert sum(map(len, dictionary.aliases.values())) == 9


def test_conflicts(spark, dictionary):
    found = rows(dict_conflicts(dictionary.extensions_df(spark)))
    assert found == [
        ("h", ["C", "C++", "Objective-C"], 3),
        ("hh", ["C++", "PHP"], 2),
        ("m", ["Matlab", "Objective-C"], 2),
        ("pl", ["Perl", "Prolog"], 2),
    ]
    assert rows(dict_conflicts(dictionary.file_names_df(spark))) == []
    assert rows(dict_conflicts(dictionary.aliases_df(spark))) == []


def test_ambiguous_primary_extension_is_an_error():
    with pytest.raises(ValueError, match="primary extension"):
        Dictionary({"A": "x", "B": "x"}, {"A": ["x"], "B": ["x"]}, {}, {})


def test_ambiguous_alias_is_an_error():
    with pytest.raises(ValueError, match="alias"):
        Dictionary(
            {"A": "a", "B": "b"}, {"A": ["a"], "B": ["b"]}, {}, {"A": ["z"], "B": ["z"]}
        )


def test_load(tmp_path):
    path = tmp_path / "languages.json"
    path.write_text(
        json.dumps({"Zig": {"aliases": ["zig"], "extensions": ["zig", "zon"], "files": []}})
    )
    loaded = load_dictionary(str(path))
    assert loaded.primary == {"Zig": "zig"}
    assert loaded.extensions == {"Zig": ["zig", "zon"]}
    assert loaded.aliases == {"Zig": ["zig"]}


def test_one_of_quotes(spark):
    df = spark.createDataFrame([("a'b",), ("c\\d",), ("e",)], "v string")
    assert rows(df.where(one_of("v", ["a'b", "c\\d"]))) == [("a'b",), ("c\\d",)]


def test_frames(spark):
    d = default_dictionary()
    assert d.languages_df(spark).count() == 54
    assert d.extension_owners_df(spark).count() == 216
    assert d.file_name_owners_df(spark).count() == 80
