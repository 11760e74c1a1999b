"""The language dictionary: names, aliases, extensions and exact file names.

The four tables below are the default.  Every operator takes a
:class:`Dictionary`, so another one can be passed instead; see
:func:`load_dictionary`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeset.session import small_frame

# ---------------------------------------------------------------------------
# The results depend on exactly these names.

# language -> extension of the files written for it
PRIMARY_EXTENSIONS = {
    "Assembly": "asm",
    "Batchfile": "bat",
    "C": "c",
    "C#": "cs",
    "C++": "cpp",
    "Clojure": "clj",
    "CMake": "cmake",
    "COBOL": "cbl",
    "CoffeeScript": "coffee",
    "CSS": "css",
    "CSV": "csv",
    "Dart": "dart",
    "DM": "dm",
    "Dockerfile": "dockerfile",
    "Elixir": "ex",
    "Erlang": "erl",
    "Fortran": "f90",
    "Go": "go",
    "Groovy": "groovy",
    "Haskell": "hs",
    "HTML": "html",
    "INI": "ini",
    "Java": "java",
    "JavaScript": "js",
    "JSON": "json",
    "Julia": "jl",
    "Kotlin": "kt",
    "Lisp": "lisp",
    "Lua": "lua",
    "Makefile": "makefile",
    "Markdown": "md",
    "Matlab": "matlab",
    "Objective-C": "mm",
    "OCaml": "ml",
    "Pascal": "pas",
    "Perl": "pm",
    "PHP": "php",
    "PowerShell": "ps1",
    "Prolog": "prolog",
    "Python": "py",
    "R": "r",
    "Ruby": "rb",
    "Rust": "rs",
    "Scala": "scala",
    "Shell": "sh",
    "SQL": "sql",
    "Swift": "swift",
    "TeX": "tex",
    "TOML": "toml",
    "TypeScript": "ts",
    "Verilog": "v",
    "Visual Basic": "vba",
    "XML": "xml",
    "YAML": "yaml",
}

# language -> further extensions that name it
OTHER_EXTENSIONS = {
    "Assembly": ["s", "nasm", "a51", "agc"],
    "Batchfile": ["cmd", "btm"],
    "C": ["h"],
    "C++": ["c++", "cxx", "cc", "tcc", "tpp", "hpp", "hh", "hxx", "h"],
    "Clojure": ["cljs", "cljc", "cljx"],
    "COBOL": ["cobol", "cob", "cpy"],
    "CoffeeScript": ["iced", "_coffee", "cson", "cjsx"],
    "Elixir": ["exs"],
    "Erlang": ["hrl", "escript"],
    "Fortran": ["f95", "f77", "f03", "f08", "fpp", "f"],
    "Groovy": ["gvy", "jenkinsfile", "jenkins", "nf", "gradle"],
    "Haskell": ["hsc", "hs-boot"],
    "HTML": ["xhtml", "htm", "xht"],
    "INI": ["properties", "lektorproject", "dof", "prefs"],
    "JavaScript": ["es6", "javascript", "jsx"],
    "JSON": [
        "avsc", "geojson", "gltf", "har", "jsonl", "mcmeta", "tfstate",
        "topojson", "webmanifest", "yy", "yyp",
    ],
    "Kotlin": ["kts"],
    "Lisp": ["lsp", "el", "asd", "sexp"],
    "Lua": ["pd_lua", "wlua", "nse", "p8"],
    "Makefile": ["mkfile", "mk"],
    "Markdown": ["markdown", "mdown", "mkd", "mdx", "mkdn", "ronn"],
    "Matlab": ["m"],
    "Objective-C": ["m", "h"],
    "OCaml": ["mli", "ml4", "eliom", "sml"],
    "Pascal": ["pp", "dfm", "dpr", "pascal"],
    "Perl": ["pl", "p6", "raku", "pl6", "rakumod", "psgi", "perl"],
    "PHP": ["php3", "php4", "php5", "phpt", "hh", "hhi"],
    "PowerShell": ["psm1"],
    "Prolog": ["pl"],
    "Python": ["gyp", "py3", "gypi", "pyde", "pyi", "pyw"],
    "Ruby": [
        "ruby", "builder", "gemspec", "god", "jbuilder", "podspec", "prawn",
        "rabl", "rake", "rbi", "rbw", "rbx", "ru", "thor", "watchr",
    ],
    "Scala": ["kojo", "sbt"],
    "Shell": [
        "bash", "bats", "command", "env", "ksh", "zsh", "tmux", "tool",
    ],
    "SQL": ["tsql", "hql", "mysql"],
    "TeX": [
        "aux", "bbx", "cbx", "dtx", "lbx", "mkii", "mkiv", "mkvi", "sty",
    ],
    "TypeScript": ["tsx"],
    "Verilog": ["veo", "sv", "svh", "vh"],
    "Visual Basic": ["vb", "bas", "vbs"],
    "XML": ["adml", "admx", "xul", "xsd", "fxml", "glade"],
    "YAML": ["yml", "reek", "mir", "rviz"],
}

# language -> exact file names that name it
FILE_NAMES = {
    "CMake": ["CMakeLists.txt"],
    "CoffeeScript": ["Cakefile"],
    "Dockerfile": ["Dockerfile"],
    "Elixir": ["mix.lock"],
    "Erlang": ["Emakefile", "rebar.config", "rebar.lock"],
    "Groovy": ["Jenkinsfile"],
    "INI": ["buildozer.spec"],
    "JavaScript": ["Jakefile"],
    "JSON": [
        ".arcconfig", ".htmlhintrc", ".tern-project", "Pipfile.lock",
        "composer.lock", "mcmod.info", "manifest.webapp",
    ],
    "Lua": [".luacheckrc"],
    "Makefile": [
        "Makefile", "Makefile.am", "Makefile.in", "Makefile.boot",
        "Makefile.frag", "Makefile.inc", "Makefile.wat", "Makefile.sco",
        "GNUmakefile", "GNUmakefile.am", "GNUmakefile.in", "BSDmakefile",
        "Kbuild", "mkfile",
    ],
    "Perl": ["Makefile.PL", "cpanfile"],
    "Python": ["wscript", "SConscript", "SConstruct"],
    "Ruby": [
        "Rakefile", "Appraisals", "Berksfile", "Brewfile", "Capfile",
        "Dangerfile", "Deliverfile", "Fastfile", "Gemfile", "Guardfile",
        "Podfile", "Puppetfile", "Snapfile", "Thorfile", "Vagrantfile",
    ],
    "Shell": [
        ".bash_aliases", ".bash_history", ".bash_logout", ".bash_profile",
        ".bahrc", ".env", ".env.example", ".flaskenv", ".zlogin", ".zlogout",
        ".zprofile", ".zshenv", ".zshrc", "PKGBUILD", "gradlew",
    ],
    "TOML": ["Cargo.lock", "Gopkg.lock", "Pipfile", "poetry.lock"],
    "XML": [
        ".classpath", ".cproject", "App.config", "NuGet.config",
        "Settings.StyleCop", "Web.Debug.config", "Web.Release.config",
        "Web.config", "packages.config",
    ],
}

# language -> other names of the language in repository catalogues
ALIASES = {
    "Fortran": ["FORTRAN"],
    "Lisp": ["Common Lisp", "Emacs Lisp"],
    "Pascal": ["Delphi"],
    "Perl": ["Perl6", "Perl 6"],
    "PHP": ["Hack"],
    "SQL": ["HiveQL"],
    "Verilog": ["SystemVerilog"],
}

# End of the fixed values.
# ---------------------------------------------------------------------------

# Dictionaries of up to this many entries are broadcast.
MAX_BROADCAST_ENTRIES = 100_000


@dataclass(frozen=True, eq=False)
class Dictionary:
    """Languages in order, each with its primary extension and its names."""

    primary: dict[str, str]
    extensions: dict[str, list[str]]
    file_names: dict[str, list[str]]
    aliases: dict[str, list[str]]

    def __post_init__(self):
        for alias, owners in _owners(self.aliases).items():
            if len(owners) > 1:
                raise ValueError(f"alias {alias!r} belongs to {owners}")
        by_extension = _owners(self.extensions)
        for language, extension in self.primary.items():
            if by_extension.get(extension) != [language]:
                raise ValueError(
                    f"primary extension {extension!r} of {language} must "
                    f"belong to it alone, not to {by_extension.get(extension)}"
                )

    @property
    def languages(self) -> list[str]:
        return list(self.primary)

    def small(self, df: DataFrame) -> DataFrame:
        """Mark a frame of this dictionary for broadcast if its size allows."""
        sizes = [len(self.primary)] + [
            sum(map(len, table.values()))
            for table in (self.extensions, self.file_names, self.aliases)
        ]
        return F.broadcast(df) if sum(sizes) <= MAX_BROADCAST_ENTRIES else df

    # The frames below are made once per session.

    @cache
    def languages_df(self, spark: SparkSession) -> DataFrame:
        """(language, position, primary_ext), one row per language."""
        rows = [(l, i, e) for i, (l, e) in enumerate(self.primary.items())]
        return small_frame(
            spark, rows, "language string, position int, primary_ext string"
        )

    @cache
    def aliases_df(self, spark: SparkSession) -> DataFrame:
        """(value, language) of every alias."""
        return _pairs(spark, self.aliases)

    @cache
    def extensions_df(self, spark: SparkSession) -> DataFrame:
        """(value, language) of every extension, ambiguous ones repeated."""
        return _pairs(spark, self.extensions)

    @cache
    def file_names_df(self, spark: SparkSession) -> DataFrame:
        """(value, language) of every exact file name."""
        return _pairs(spark, self.file_names)

    @cache
    def extension_owners_df(self, spark: SparkSession) -> DataFrame:
        """(value, owners array), one row per extension."""
        return _owner_rows(spark, self.extensions)

    @cache
    def file_name_owners_df(self, spark: SparkSession) -> DataFrame:
        """(value, owners array), one row per exact file name."""
        return _owner_rows(spark, self.file_names)


def _owners(table: dict[str, list[str]]) -> dict[str, list[str]]:
    owners: dict[str, list[str]] = {}
    for language, values in table.items():
        for value in values:
            owners.setdefault(value, []).append(language)
    return owners


def _pairs(spark: SparkSession, table: dict[str, list[str]]) -> DataFrame:
    rows = [(v, l) for l, values in table.items() for v in values]
    return small_frame(spark, rows, "value string, language string")


def _owner_rows(spark: SparkSession, table: dict[str, list[str]]) -> DataFrame:
    rows = list(_owners(table).items())
    return small_frame(spark, rows, "value string, owners array<string>")


def default_dictionary() -> Dictionary:
    """The dictionary of the tables above."""
    extensions = {
        language: [primary, *OTHER_EXTENSIONS.get(language, [])]
        for language, primary in PRIMARY_EXTENSIONS.items()
    }
    return Dictionary(PRIMARY_EXTENSIONS, extensions, FILE_NAMES, ALIASES)


def load_dictionary(path: str) -> Dictionary:
    """Read ``{language: {aliases, extensions, files}}`` from JSON or YAML.

    The first extension of a language is its primary one.
    """
    with open(path, encoding="utf-8") as source:
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional: JSON needs nothing beyond the library

            content = yaml.safe_load(source)
        else:
            content = json.load(source)
    extensions = {l: info["extensions"] for l, info in content.items()}
    return Dictionary(
        primary={l: values[0] for l, values in extensions.items()},
        extensions=extensions,
        file_names={l: info.get("files", []) for l, info in content.items()},
        aliases={l: info.get("aliases", []) for l, info in content.items()},
    )


def dict_conflicts(pairs: DataFrame, value: str = "value") -> DataFrame:
    """Values owned by more than one language: (value, owners, n_owners)."""
    return (
        pairs.groupBy(F.col(value).alias("value"))
        .agg(F.array_sort(F.collect_set("language")).alias("owners"))
        .withColumn("n_owners", F.size("owners").cast("bigint"))
        .where("n_owners > 1")
    )


def one_of(column: str, values: Sequence[str]) -> Column:
    """True where the column holds one of the values.

    As SQL text: ``isin`` costs a JVM call per value.
    """
    if not values:
        return F.lit(False)
    escaped = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    literals = ", ".join(f"'{v}'" for v in escaped)
    return F.expr(f"{column} IN ({literals})")


def known_language(column: str, dictionary: Dictionary) -> Column:
    """True where the column holds a language of the dictionary."""
    return one_of(column, dictionary.languages)
