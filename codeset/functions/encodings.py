"""Guess the encoding of bytes that are not UTF-8.

Each candidate decodes the bytes strictly: its codec is the state machine
that rules most wrong ones out.  The text it gives is then scored by what a
reader would look at: how common its letters are in the languages that use
the encoding, whether letters of two scripts meet inside a word, whether
capitals stand inside words, and whether signs stand where letters should.
The best score is the confidence.
"""

from __future__ import annotations

import codecs
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

MARKS = [  # longest first: the UTF-32 mark starts like the UTF-16 one
    (codecs.BOM_UTF32_LE, "utf-32"),
    (codecs.BOM_UTF32_BE, "utf-32"),
    (codecs.BOM_UTF16_LE, "utf-16"),
    (codecs.BOM_UTF16_BE, "utf-16"),
]
TEXT_CONTROLS = b"\t\n\x0b\x0c\r\x1b"
CONTROLS = bytes(set(range(32)) - set(TEXT_CONTROLS)) + b"\x7f"
MAX_CONTROLS = 0.02
MIN_WIDE_NULS = 0.3  # of every second byte, in UTF-16 without a mark
PRIOR_CHARS = 2.0  # a family's prior counts like so many characters

COMMON, USUAL, RARE, UNKNOWN = 1.0, 0.6, 0.25, 0.1
FOREIGN = -1.0  # a letter beside one of another script, or a capital inside a word
SIGN, ODD_SIGN, SIGN_INSIDE = 0.6, -0.3, -0.7
CONTROL = -2.0

# Characters by how common they are, beyond ASCII.
SIGNS = "«»“”„‘’–—…•§©®°±²³·€£´¿¡º½×→µ"
WORDS_OF_ONE = "àèéóíáåöÀÉÓÅÖ"  # letters that are words in languages of Latin script
LETTERS = {
    "western": ("éèàêçùôîûâëïäöüßñóáíúãõåæøœ", "ò"),
    "central": ("ąćęłńóśźżáčďéěíňřšťúůýžőűöüäç", "ôßşţăâî"),
    "turkish": ("çğıöşüİ", "âîû"),
    "russian": ("оеаинтсрвл", "кмдпуяыьгзбчйхжшю"),
    "greek": ("αοιετσνρςίόάέή", "υηπκλμύώγδωθχφβ"),
    "hebrew": ("יוהלארתבמ", "שנםעדקחפכ"),
}
HANZI = (
    "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生自会那后能对着"
    "事其里所去行过家十用发天如然作方成者多日都三小军二无同么经法当起与好看学进种将还分此心前面又定"
    "见只主没公从文件数据字符本使程序函接返回值代码请注意设置用户"
)
HANZI_TRADITIONAL = (
    "的一是不了人我在有他這為之大來以個中上們到說國和地也子時道出而要於就下得可你年生自會那後能對著"
    "事其裡所去行過家十用發天如然作方成者多日都三小軍二無同麼經法當起與好看學進種將還分此心前面又定"
    "見只主沒公從文件數據字符本使程式函接返回值代碼請注意設置用戶"
)
HANGUL = (
    "이다는에의을가고하지한은로기사리도를어인시자서해나대아그들수정일과보스있전부라장만면국으상여"
    "었동주제선원구습니세요되된할것음용문파입출력함값모든경우"
)
CJK_SIGNS = "、。，！？；：（）「」『』《》【】・ー　～"


@dataclass(frozen=True)
class Family:
    """Encodings of the same languages, with the prior of their scores."""

    name: str
    encodings: tuple[str, ...]
    prior: float


FAMILIES = (
    Family("western", ("cp1252", "latin-1"), 0.8),
    Family("central", ("cp1250", "iso8859-2"), 0.5),
    Family("turkish", ("cp1254",), 0.5),
    Family("russian", ("cp1251", "koi8-r", "iso8859-5", "cp866"), 0.4),
    Family("greek", ("cp1253", "iso8859-7"), 0.4),
    Family("hebrew", ("cp1255",), 0.4),
    Family("japanese", ("cp932", "euc_jp"), 0.4),
    Family("chinese", ("gb18030",), 0.4),
    Family("taiwanese", ("big5",), 0.4),
    Family("korean", ("cp949",), 0.4),
)

_POINTS = 0x10000
_LATIN, _GREEK, _CYRILLIC, _HEBREW, _EASTERN = 1, 2, 3, 4, 5
_SCRIPTS = (
    (_LATIN, (0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F)),
    (_GREEK, (0x370, 0x3FF)),
    (_CYRILLIC, (0x400, 0x4FF)),
    (_HEBREW, (0x5D0, 0x5EA)),
    (_EASTERN, (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3), (0xFF66, 0xFF9D)),
)
_TABLES: dict[str, np.ndarray] = {}


def points(text: str) -> np.ndarray:
    """The code points of a text, those beyond the first plane as U+FFFF."""
    wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(wide, _POINTS - 1)


def rows_of(codec: str, first: int, last: int) -> str:
    """The characters in some rows of a 94 x 94 set."""
    cells = (bytes([row, cell]) for row in range(first, last + 1) for cell in range(0xA1, 0xFF))
    return b"".join(cells).decode(codec, "ignore")


def eastern_weights(name: str) -> np.ndarray:
    """Frequent characters, then the first level of the set, then its others."""
    weights = np.full(_POINTS, ODD_SIGN)
    weights[0x4E00:0xA000] = RARE if name == "japanese" else -0.2
    if name == "japanese":
        weights[points(rows_of("euc_jp", 0xB0, 0xCF))] = USUAL
        weights[0x30A1:0x30FB] = USUAL + 0.2
        weights[0x3041:0x3094] = COMMON
        weights[0xFF61:0xFFA0] = -0.2  # half-width signs: single bytes of many other encodings
    elif name == "chinese":
        weights[points(rows_of("gb2312", 0xB0, 0xD7))] = 0.45
        weights[points(rows_of("gb2312", 0xD8, 0xF7))] = 0.0
        weights[points(HANZI)] = COMMON
    elif name == "taiwanese":
        cells = (bytes([a, b]) for a in range(0xA4, 0xC7) for b in (*range(0x40, 0x7F), *range(0xA1, 0xFF)))
        weights[points(b"".join(cells).decode("big5", "ignore"))] = 0.45
        weights[points(HANZI_TRADITIONAL)] = COMMON
    else:
        weights[0xAC00:0xD7A4] = -0.2
        weights[points(rows_of("euc_kr", 0xB0, 0xC8))] = 0.5
        weights[points(HANGUL)] = COMMON
    weights[points(CJK_SIGNS)] = SIGN
    weights[0xFF10:0xFF5B] = RARE
    return weights


def letter_weights(name: str) -> np.ndarray:
    """Letters of a family by how common they are; other characters are not letters."""
    weights = np.full(_POINTS, ODD_SIGN)
    common, usual = LETTERS[name]
    scripts = {"russian": (0x410, 0x450), "greek": (0x386, 0x3CF), "hebrew": (0x5D0, 0x5EB)}
    low, high = scripts.get(name, (0xC0, 0x180))
    weights[low:high] = RARE if name in scripts else UNKNOWN
    for letters, weight in ((usual, USUAL), (common, COMMON)):
        both = {x for letter in letters for x in (letter, letter.upper()) if len(x) == 1}
        weights[points("".join(both))] = weight
    weights[points(SIGNS)] = SIGN
    weights[0x80:0xA0] = CONTROL
    return weights


def table(name: str) -> np.ndarray:
    """A lookup table by code point, made once in each worker."""
    if name not in _TABLES:
        if name == "script":
            made = np.zeros(_POINTS, np.int8)
            for script, *ranges in _SCRIPTS:
                for low, high in ranges:
                    made[low : high + 1] = script
            made[[0xD7, 0xF7]] = 0
        elif name == "case":
            made = np.zeros(_POINTS, np.int8)
            for point in range(0x500):
                made[point] = 1 if chr(point).isupper() else -1 if chr(point).islower() else 0
        elif name in LETTERS:
            made = letter_weights(name)
        else:
            made = eastern_weights(name)
        _TABLES[name] = made
    return _TABLES[name]


def plausibility(text: str, family: Family) -> float:
    """The mean weight of the characters beyond ASCII, with the family's prior."""
    at = points(text)
    high = np.flatnonzero(at > 0x7F)
    weights = table(family.name)[at[high]]
    if family.name in LETTERS:
        script, case = table("script"), table("case")
        padded = np.concatenate([[0x20], at, [0x20]])
        own, left, right = script[at[high]], script[padded[high]], script[padded[high + 2]]
        letter = own > 0
        strange = letter & (((left > 0) & (left != own)) | ((right > 0) & (right != own)))
        capital = letter & (case[at[high]] > 0)
        before = case[padded[high]]
        strange |= capital & (before < 0) & (left == own)
        weights = np.where(capital & (before > 0) & (left == own), weights * 0.7, weights)
        if family.name in ("russian", "greek", "hebrew"):  # single letters are no words of these
            lonely = letter & (left != own) & (right != own)
            weights = np.where(lonely, np.minimum(weights, UNKNOWN), weights)
            if 4 * len(np.unique(at[high])) < min(len(high), 40):  # no text has so few letters
                weights = np.minimum(weights, ODD_SIGN)
        else:  # neighbours of an accented letter are mostly plain ones
            lonely = letter & (left == 0) & (right == 0) & ~np.isin(at[high], points(WORDS_OF_ONE))
            weights = np.where(lonely, weights * 0.5, weights)
            crowd = sum(((side > 0x7F) & (table("script")[side] == own)).astype(int)
                        for side in (padded[high], padded[high + 2]))
            weights = np.where(letter, np.choose(crowd, [weights, weights * 0.7, -0.5]), weights)
        weights = np.where(strange, FOREIGN, weights)
        inside = ~letter & (left > 0) & (right > 0) & ~np.isin(at[high], points("’·‘"))
        weights = np.where(inside, np.minimum(weights, SIGN_INSIDE), weights)
    return float((weights.sum() + PRIOR_CHARS * family.prior) / (len(high) + PRIOR_CHARS))


def wide_encoding(content: bytes) -> str | None:
    """UTF-16 without a mark: every second byte is often NUL, the others never."""
    if len(content) % 2 or len(content) < 4:
        return None
    even, odd = content[::2].count(0), content[1::2].count(0)
    half = len(content) // 2
    if odd >= MIN_WIDE_NULS * half and not even:
        return "utf-16-le"
    if even >= MIN_WIDE_NULS * half and not odd:
        return "utf-16-be"
    return None


def detect_encoding(content: bytes) -> tuple[str | None, float]:
    """(encoding, confidence) of bytes that are not UTF-8; None of binary data.

    A byte order mark decides; NULs in every second byte alone are UTF-16.
    Other NULs or many control bytes mean binary data.  Else the encoding
    whose text is the most plausible is taken, the first of equals.
    """
    for mark, encoding in MARKS:
        if content.startswith(mark):
            return encoding, 1.0
    controls = len(content) - len(content.translate(None, CONTROLS))
    if b"\0" in content or controls > MAX_CONTROLS * len(content):
        wide = wide_encoding(content)
        return (wide, 0.9) if wide else (None, 0.0)
    best, confidence = None, -np.inf
    for family in FAMILIES:
        for encoding in family.encodings:
            try:
                text = content.decode(encoding)
            except UnicodeDecodeError:
                continue
            score = plausibility(text, family)
            if score > confidence:
                best, confidence = encoding, score
    return best, max(0.0, min(1.0, confidence))


# Tasks get these functions by value, so workers need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
