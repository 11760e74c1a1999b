"""Personal data replaced by format-preserving Feistel pseudonyms.

DataFrame functions only.  A keyed Feistel network permutes the values of a
format, so a value has one pseudonym in all documents and the format stays
valid.  Only who knows the key can link pseudonyms with values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8  # even, so that halves end where they began

# Fixed patterns of the formats, in the order in which they are tried.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"[A-Za-z0-9_]"
# Characters of the account numbers of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR DZ",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


# The length is the country's, so that a word behind the number is not taken
# with it.  Other codes take what looks like a number, up to a country's number.
_KNOWN_IBAN = rf"(?:{'|'.join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())})(?!{_WORD})"
_IBAN = (
    rf"(?<!{_WORD})(?=[A-Z]{{2}}[0-9]{{2}})(?:{_KNOWN_IBAN}"
    rf"|[A-Z]{{2}}[0-9]{{2}}(?:(?! {_KNOWN_IBAN}) ?[A-Z0-9]{{4}}){{2,7}}"
    rf"(?:(?! {_KNOWN_IBAN}) ?[A-Z0-9]{{1,3}})?(?!{_WORD}))"
)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
    r"|(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": _IBAN,
    "card": rf"(?<!{_WORD})(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}})(?!{_WORD})",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
    r"|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}([.-])[0-9]{3}\2[0-9]{4}(?![0-9])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())

FIRST_DAY = "1900-01-01"
DAYS = (250, 292)  # their product are the days from the first one on


def _hash(key: str, kind: str, round_: Column, half: Column) -> Column:
    """64 bytes in hex from the key, the round and one half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), half.cast("string")), 512)


def permuted_pair(key: str, kind: str, left: Column, right: Column, sizes: tuple[int, int]):
    """Permute (left, right) with left < sizes[0] and right < sizes[1]."""

    def turn(s: Column, i: Column) -> Column:
        noise = F.conv(F.substring(_hash(key, kind, i, s["r"]), 1, 12), 16, 10).cast("long")
        return F.struct(
            s["r"].alias("l"), ((s["l"] + noise) % s["m"]).alias("r"),
            s["n"].alias("m"), s["m"].alias("n"),
        )

    start = F.struct(
        left.cast("long").alias("l"), right.cast("long").alias("r"),
        F.lit(sizes[0]).cast("long").alias("m"), F.lit(sizes[1]).cast("long").alias("n"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _shifted(char: Column, noise: Column) -> Column:
    """A digit or letter moved inside its class."""
    code = F.ascii(char)

    def moved(first: int, size: int) -> Column:
        return F.char((code - first + noise) % size + first)

    return (
        F.when(code <= 57, moved(48, 10)).when(code <= 90, moved(65, 26)).otherwise(moved(97, 26))
    )


def permuted_text(key: str, kind: str, value: Column) -> Column:
    """Permute the ASCII digits and letters of a value, each inside its class.

    Other characters are left out.  Both halves take turns in shifting each
    other's characters; after 64 characters the noise repeats.
    """

    def turn(s: Column, i: Column) -> Column:
        noise = _hash(key, kind, i, s["r"])
        shifted = F.transform(
            _chars(s["l"]),
            lambda c, at: _shifted(
                c, F.conv(F.substr(noise, at % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
            ),
        )
        return F.struct(s["r"].alias("l"), F.array_join(shifted, "").alias("r"))

    plain = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    half = F.floor(F.length(plain) / 2).cast("int")
    start = F.struct(
        F.substr(plain, F.lit(1), half).alias("l"), F.substr(plain, half + 1).alias("r")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"])
    )


def in_format(value: Column, plain: Column) -> Column:
    """``value`` with its digits and letters replaced by those of ``plain`` in turn."""
    filled = F.aggregate(
        _chars(value),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda s, c: F.when(
            c.rlike("[A-Za-z0-9]"),
            F.struct(
                F.concat(s["out"], F.substr(plain, s["next"], F.lit(1))).alias("out"),
                (s["next"] + 1).alias("next"),
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["next"].alias("next"))),
    )
    return filled["out"]


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes a card number valid."""
    doubled = F.transform(
        F.reverse(_chars(payload)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
        .otherwise(c.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda n, d: n + d)
    return ((10 - total % 10) % 10).cast("string")


def iban_remainder(value: Column) -> Column:
    """The number behind an account number, modulo 97; 1 if it is valid."""
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    return F.aggregate(
        _chars(turned),
        F.lit(0),
        lambda n, c: F.when(c.rlike("[0-9]"), (n * 10 + F.ascii(c) - 48) % 97)
        .otherwise((n * 100 + F.ascii(c) - 55) % 97),
    )


def _email(key: str, value: Column) -> Column:
    """All but the last part of the domain is permuted."""
    end = F.regexp_extract(value, r"\.[A-Za-z0-9-]+$", 0)
    front = F.substr(value, F.lit(1), F.length(value) - F.length(end))
    return F.concat(in_format(front, permuted_text(key, "email", front)), end)


def _ip(key: str, value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("int"))
    pair = permuted_pair(
        key, "ip",
        F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)),
        F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)),
        (65536, 65536),
    )
    return F.aggregate(  # one evaluation of the pair
        F.array(pair), F.lit(""),
        lambda _, p: F.concat_ws(
            ".", *((F.shiftright(p[half], shift) % 256).cast("string")
                   for half in "lr" for shift in (8, 0))
        ),
    )


def _date(key: str, value: Column) -> Column:
    """The day is permuted, so one day has one pseudonym in both formats."""
    dashed = value.contains("-")
    sign = F.substr(value, F.lit(3), F.lit(1))
    iso = F.when(dashed, value).otherwise(
        F.concat_ws("-", F.substr(value, F.lit(7)), F.substr(value, F.lit(4), F.lit(2)), F.substr(value, F.lit(1), F.lit(2)))
    )
    day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.to_date(F.lit(FIRST_DAY)))
    pair = permuted_pair(key, "date", F.floor(day / DAYS[1]), day % DAYS[1], DAYS)
    moved = F.aggregate(
        F.array(pair), F.lit(""),
        lambda _, p: F.date_add(F.to_date(F.lit(FIRST_DAY)), (p["l"] * DAYS[1] + p["r"]).cast("int")).cast("string"),
    )
    known = (day >= 0) & (day < DAYS[0] * DAYS[1])
    written = F.aggregate(
        F.array(moved), F.lit(""),
        lambda _, d: F.when(dashed, d).otherwise(
            F.concat(F.substr(d, F.lit(9)), sign, F.substr(d, F.lit(6), F.lit(2)), sign, F.substr(d, F.lit(1), F.lit(4)))
        ),
    )
    return F.when(known, written)


def _card(key: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    valid = luhn_digit(payload) == F.substr(digits, F.length(digits))
    moved = F.transform(
        F.array(permuted_text(key, "card", payload)),
        lambda p: in_format(value, F.concat(p, luhn_digit(p))),
    )
    return F.when(valid, F.get(moved, F.lit(0)))


def _iban(key: str, value: Column) -> Column:
    """Country and form stay, the check digits are made anew."""
    plain = F.regexp_replace(value, " ", "")
    country, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    moved = F.transform(
        F.array(permuted_text(key, "iban", rest)),
        lambda r: in_format(
            value,
            F.concat(
                country,
                F.lpad((98 - iban_remainder(F.concat(country, F.lit("00"), r))).cast("string"), 2, "0"),
                r,
            ),
        ),
    )
    return F.when(iban_remainder(plain) == 1, F.get(moved, F.lit(0)))


def _phone(key: str, value: Column) -> Column:
    """A country code stays."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    number = F.substr(value, F.length(code) + 1)
    return F.concat(code, in_format(number, permuted_text(key, "phone", number)))


def pseudonym(key: str, value: Column) -> Column:
    """(kind, text): the pseudonym of a match, or kind null and the match itself."""

    def is_like(kind: str) -> Column:
        return value.rlike(f"^(?:{PATTERNS[kind].replace(chr(92) + '2', chr(92) + '1')})$")

    made = {
        "email": _email, "ip": _ip, "date": _date,
        "ssn": lambda k, v: in_format(v, permuted_text(k, "ssn", v)),
        "iban": _iban, "card": _card, "phone": _phone,
    }
    chosen = F.lit(None).cast("string")
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        chosen = F.when(is_like(name), made[name](key, value)).otherwise(chosen)
        kind = F.when(is_like(name), F.lit(name)).otherwise(kind)
    return F.struct(
        F.when(chosen.isNotNull(), kind).alias("kind"), F.coalesce(chosen, value).alias("text")
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows with their personal data replaced, and n_<kind> of each kind.

    Kinds: e-mail and IPv4 addresses, calendar days (1900 to 2099), social
    security and phone numbers by form; bank accounts and cards if their check
    digits are right, with right ones afterwards.  What fails its check stays.
    Null and empty texts and other columns stay, but for columns with the
    names of the counts, which are replaced.  ``key`` is the secret.  Texts without a digit or @ are not searched further, and
    nothing is shuffled.
    """
    source = F.col(text)
    found = F.when(source.rlike("[0-9@]"), F.regexp_extract_all(source, F.lit(ANY), F.lit(0)))
    gaps = F.when(F.size("_found") > 0, F.split(source, ANY, -1))
    made = F.when(F.size("_found") > 0, F.transform("_found", lambda m: pseudonym(key, m)))
    joined = F.array_join(
        F.zip_with("_gaps", "_made", lambda gap, m: F.concat(gap, F.coalesce(m["text"], F.lit("")))), ""
    )
    counts = {
        f"n_{kind}": F.coalesce(
            F.size(F.filter("_made", lambda m: m["kind"] == F.lit(kind))), F.lit(0)
        ).cast("long")
        for kind in KINDS
    }
    return (
        docs.withColumn("_found", found)
        .withColumns({"_gaps": gaps, "_made": made})
        .withColumns({text: F.when(F.size("_made") > 0, joined).otherwise(source)} | counts)
        .drop("_found", "_gaps", "_made")
    )
