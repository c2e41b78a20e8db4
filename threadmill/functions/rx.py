"""Regular-expression building blocks that mean the same in Java (Spark) and RE2 (DuckDB).

``\\w``, ``\\s``, ``\\d`` and ``\\b`` are ASCII or half-Unicode in one engine or the other, so patterns spell out
their classes. All helpers return ``Column`` expressions; a NULL input gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word characters: letters, numbers, underscore of any script.
W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
#: Inside of a class: white space as the Unicode-aware string methods see it.
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S = f"[{SPACES}]"
NOT_S = f"[^{SPACES}]"
#: Line boundaries.
NL = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Word boundary (Java only: RE2 has no lookaround).
B = f"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
#: Characters for which "is a digit" holds: decimal digits, superscripts, circled digits; not fractions.
DIGITS = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)

#: One character that ends a line.
NL_CHAR = r"[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Costly patterns that only match texts with such a character are tried on those alone.
NON_ASCII = r"[^\x00-\x7f]"

STRIP = f"\\A{S}+|{S}+\\z"

_PICTURE = (
    r"[\x{1f000}-\x{1f1e5}\x{1f200}-\x{1f3fa}\x{1f400}-\x{1faff}\x{2600}-\x{27bf}\x{231a}\x{231b}\x{2328}\x{23cf}"
    r"\x{23e9}-\x{23f3}\x{23f8}-\x{23fa}\x{24c2}\x{25aa}\x{25ab}\x{25b6}\x{25c0}\x{25fb}-\x{25fe}\x{2934}\x{2935}"
    r"\x{2b05}-\x{2b07}\x{2b1b}\x{2b1c}\x{2b50}\x{2b55}\x{3030}\x{303d}\x{3297}\x{3299}\x{203c}\x{2049}\x{2122}"
    r"\x{2139}\x{2194}-\x{2199}\x{21a9}\x{21aa}\x{a9}\x{ae}]"
)
_PICTURE_MOD = r"(?:\x{fe0f}|[\x{1f3fb}-\x{1f3ff}])?"
#: One emoji with its modifiers: flag pair, keycap, or pictures joined by zero-width joiners. A range approximation
#: of the emoji tables, not a copy of them.
EMOJI = (
    r"(?:[\x{1f1e6}-\x{1f1ff}]{2}|[0-9#*]\x{fe0f}?\x{20e3}|"
    f"{_PICTURE}{_PICTURE_MOD}(?:\\x{{200d}}{_PICTURE}{_PICTURE_MOD})*)"
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sub(c: str | Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(col(c), F.lit(pattern), F.lit(replacement))


def found(c: str | Column, pattern: str) -> Column:
    return col(c).rlike(pattern)


def strip(c: str | Column) -> Column:
    """Both ends without white space of any kind (``trim`` would only know U+0020)."""
    return sub(c, STRIP)


def all_of(c: str | Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))


def lines(c: str | Column) -> Column:
    """Lines of the stripped text, as they are."""
    return F.split(strip(c), NL)


def solid_lines(c: str | Column) -> Column:
    """Stripped lines without the empty ones."""
    return F.filter(F.transform(lines(c), strip), lambda x: x != "")


def literal(text: str) -> str:
    """Text with every character that has a meaning in a pattern escaped, for Java and RE2 alike."""
    return "".join("\\" + ch if ch.isascii() and not ch.isalnum() and ch not in " _" else ch for ch in text)
