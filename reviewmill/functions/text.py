"""Text canonicalisation as Column expressions; Arrow UDFs only where Spark has no function."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space as the source defines it, invisible characters, named entities, truncation markers.
SPACE = r"[\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
NO_SPACE = "[^" + SPACE[1:]
INLINE_SPACE = r"[\t\x0B\f \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
INVISIBLE = r"[\u0000-\u0008\u000B\u000C\u000E-\u001F\u007F-\u009F\u00AD\u200B\u200C\u202A-\u202E\u2060-\u2064\u2066-\u2069\uFEFF]"
NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'", "nbsp": " ", "ndash": "–", "mdash": "—", "hellip": "…", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "eacute": "é", "copy": "©", "reg": "®", "trade": "™", "deg": "°", "euro": "€", "pound": "£"}
MARKER = r"(?i)(…|\.\.\.)\s*((read|show|see)?\s*more)?\s*$"
MAX_GRAPHEMES = 5000
PASSES = 5

# Code points of pictographs, as ranges.
PICTOGRAPHS = """
00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 2388 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE
2600-2605 2607-2612 2614-2685 2690-2705 2708-2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2767
2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299
1F000-1F0FF 1F10D-1F10F 1F12F 1F16C-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F1AD-1F1E5 1F201-1F20F 1F21A 1F22F 1F232-1F23A 1F23C-1F23F
1F249-1F3FA 1F400-1F53D 1F546-1F64F 1F680-1F6FF 1F774-1F77F 1F7D5-1F7FF 1F80C-1F80F 1F848-1F84F 1F85A-1F85F 1F888-1F88F 1F8AE-1F8FF
1F90C-1F93A 1F93C-1F945 1F947-1FAFF 1FC00-1FFFD
"""
_PICTOGRAPH = "[" + "".join("-".join(rf"\x{{{x}}}" for x in r.split("-")) for r in PICTOGRAPHS.split()) + "]"
_entity = re.compile(r"&(?:#(\d+)|#[xX]([0-9a-fA-F]+)|(\w+));")
_markup = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(?=[!?/A-Za-z])[^>]*(?:>|$)", re.S)


def trim(c: Column) -> Column:
    """From the first to the last character that is no white space, in one pass."""
    return F.regexp_extract(c, rf"(?s)\A{SPACE}*+(.*{NO_SPACE})?", 1)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def strip_markup(c: Column) -> Column:
    """Comments, CDATA, then tags up to > or the end of the text."""
    c = F.regexp_replace(c, r"(?s)<!--.*?(-->|$)", "")
    c = F.regexp_replace(c, r"(?s)<!\[CDATA\[.*?(\]\]>|$)", "")
    return F.regexp_replace(c, r"(?s)<[!?/A-Za-z][^>]*(>|$)", "")


def has_markup(c: Column) -> Column:
    return c.rlike(r"<[!?/A-Za-z]")


def canonical_space(c: Column) -> Column:
    """CRLF to LF, other runs to a blank, none around LF, at most one empty line, trimmed."""
    c = F.regexp_replace(c, r"\r\n?", "\n")
    c = F.regexp_replace(c, f"{INLINE_SPACE}+", " ")
    c = F.regexp_replace(c, " ?\n ?", "\n")
    return trim(F.regexp_replace(c, "\n{3,}", "\n\n"))


def is_truncated(c: Column) -> Column:
    return c.rlike(MARKER)


def strip_marker(c: Column) -> Column:
    return trim(F.regexp_replace(c, MARKER, ""))


def graphemes(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\X"))


def bound(c: Column, most: int = MAX_GRAPHEMES) -> Column:
    """The first graphemes of a text; short texts are recognised by their code points alone."""
    cut = F.regexp_extract(c, rf"\A(\X{{0,{most}}}+)", 1)
    return F.when(F.length(c) <= most, c).otherwise(F.regexp_replace(cut, f"{SPACE}+$", ""))


def initials(c: Column) -> Column:
    words = F.filter(F.split(trim(c), f"{SPACE}+"), lambda w: w != "")
    return F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))


def blank_to_null(c: Column) -> Column:
    return F.when(trim(c) != "", c)


def truncate(c: Column, most: int = 120) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("…"))).otherwise(c)


def extract_text(c: Column, markers: list[str]) -> tuple[Column, Column]:
    """Collapsed text without the first declared marker that ends it, and whether one did."""
    c = collapse(c)
    text, cut = c, F.lit(False)
    for m in reversed(markers):
        ends = F.endswith(c, F.lit(m))
        text = F.when(ends, trim(F.left(c, F.length(c) - len(m)))).otherwise(text)
        cut = ends | cut
    return text, cut


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def nfd(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFD", t))


def _decode(t: str) -> str:
    def one(m: re.Match) -> str:
        number = int(m[1]) if m[1] else int(m[2], 16) if m[2] else None
        if number is None:
            return NAMED.get(m[3].lower(), m[0])
        return chr(number) if 0 < number <= 0x10FFFF and not 0xD800 <= number <= 0xDFFF else m[0]

    for _ in range(PASSES):
        new = _entity.sub(one, t)
        if new == t:
            break
        t = new
    return t


@F.pandas_udf(StringType())
def decode_entities(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or "&" not in t else _decode(t))


@F.pandas_udf(StringType())
def decode_and_strip(s: pd.Series) -> pd.Series:
    """Entities decoded and markup stripped in turn until nothing changes."""

    def run(t: str) -> str:
        for _ in range(PASSES):
            new = _markup.sub("", _decode(t))
            if new == t:
                break
            t = new
        return t

    return s.map(lambda t: t if t is None or not ("&" in t or "<" in t) else run(t))


def strip_joiners(c: Column) -> Column:
    """Zero-width joiners stay only between two pictographs."""
    return F.regexp_replace(c, rf"({_PICTOGRAPH}\x{{200D}}(?={_PICTOGRAPH}))|\x{{200D}}", "$1")


def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, INVISIBLE, "")


def normalize(c: Column) -> Column:
    """The native part of the canonical order: markup, invisible characters, white space, truncation marker, bound."""
    return bound(strip_marker(canonical_space(strip_controls(strip_markup(c)))))


def fold(c: Column) -> Column:
    """Lower-case, punctuation and symbols to blanks, collapsed; for comparison of texts that are NFC."""
    return F.trim(F.regexp_replace(F.lower(c), rf"[\p{{P}}\p{{S}}{SPACE[1:]}+", " "))


