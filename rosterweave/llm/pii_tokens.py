"""Tokens of a text for finding personal information: words, marks, and whole stretches that
have the form of a contact, a number or an address."""

from __future__ import annotations

import re
import zlib

# Words of streets and units.
STREET = r"(?:Street|St\.|St|Avenue|Ave\.|Ave|Road|Rd\.|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Terrace|Close|Way|Court|Ct|Place|Square)"
UNIT = r"(?:(?:,\s(?:Apt|Unit|Flat|Suite|Apartment)\.?\s\d+[A-Za-z]?)|(?:,?\s#\d+))?"
FLAT = r"(?:(?:Flat|Apt|Unit|Apartment|Suite)\s\d+[A-Za-z]?,\s)?"
NAME_WORD = r"[^\W\d_a-zà-öø-ÿ][^\W\d_]+(?:['’-][^\W\d_]+)*"

KINDS = ("email", "address", "id_four", "id_pan", "id_nino", "id_passport", "id_ssn", "phone_wide", "phone", "phone_bare", "number", "initial", "word", "mark")
# plain words first, unless an address may go on behind them
_LOWER = r"(?P<lower>[a-zà-öø-ÿ]{2,}(?=[ ,;:]\s?(?![@\[(]|at\s))(?![ ]?[@\[(]))"
_CAPITAL = r"(?P<capital>(?!(?:Calle|Flat|Apt|Unit|Suite|Apartment)\b)[A-ZÀ-ÖØ-Ý][a-zà-öø-ÿ]+(?=[ ,;:]\s?(?![@\[(\d]|at\s))(?![ ]?[@\[(]))"
_EMAIL = r"(?P<email>(?<![\w.+'-])[\w.+'-]*\w(?:\s?@\s?|\s?\[at\]\s?|\s?\(at\)\s?)[\w-]+(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?|\sdot\s)[\w-]+)+|(?<![\w.+'-])[\w.+'-]*\w\sat\s[\w-]+(?:\sdot\s[\w-]+)+)"
_ADDRESS = rf"(?P<address>(?<!\w){FLAT}(?:\d+[a-z]?\s(?:rue\s{NAME_WORD}|(?:{NAME_WORD}\s){{1,3}}{STREET}(?!\w))|Calle\s{NAME_WORD}\s\d+[a-z]?|[^\W\d_a-zà-öø-ÿ](?=\w+\s\d)\w+?(?:straße|strasse|gasse|weg|allee|platz)\s\d+[a-z]?)(?!\d){UNIT})"
_IDS = (
    r"(?P<id_four>(?<![\w+-])\d{4}\s\d{4}\s\d{4}(?![\w-]))"
    r"|(?P<id_pan>(?<!\w)[A-Z]{5}\d{4}[A-Z](?!\w))"
    r"|(?P<id_nino>(?<!\w)[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D](?!\w))"
    r"|(?P<id_passport>(?<![\w-])[A-Z]{1,2}\d{7,8}(?!\w))"
    r"|(?P<id_ssn>(?<![\w+-])\d{3}(?P<sep>[- ])\d{2}(?P=sep)\d{4}(?![\w-]))"
)
_PHONES = (
    r"(?P<phone_wide>(?:(?<!\w)00(?=\d)|\(?\+)\d{1,4}\)?(?:[\s.-]?\(0\))?(?:[\s.-]?\(?\d{2,6}\)?){1,4}(?:\s?(?:x|ext\.?)\s?\d{1,5})?(?!\d))"
    r"|(?P<phone>(?<![\w+-])(?:1[\s.-]?)?(?:\([2-9]\d\d\)\s?|[2-9]\d\d[\s.-])\d{3}[\s.-]?\d{4}(?:\s?(?:x|ext\.?)\s?\d{1,5})?(?![\w-]))"
    r"|(?P<phone_bare>(?<![\w+-])1?[2-9]\d{9}(?:\s(?:x|ext\.?)\s?\d{1,5})?(?![\w-]))"
)
_REST = r"(?P<number>\d+(?:[.,:/-]\d+)*)|(?P<initial>(?<!\w)[^\W\d_a-z]\.(?![^\W\d_]\.))|(?P<word>[^\W\d_]+(?:['’-][^\W\d_]+)*)|(?P<line>[^\S\n]*\n\s*)|(?P<mark>[^\s])"
TOKEN_PLAIN = re.compile("|".join((_LOWER, _CAPITAL, _ADDRESS, _IDS, _PHONES, _REST)))
TOKEN = re.compile("|".join((_LOWER, _CAPITAL, _EMAIL, _ADDRESS, _IDS, _PHONES, _REST)))
SHAPES = ("lower", "capital", "capitals", "one")


def shape(word: str) -> str:
    if len(word) == 1:
        return "one"
    if word.isupper():
        return "capitals"
    return "capital" if word[0].isupper() else "lower"


def tokens_of(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, word)``; blanks are left out but for line ends."""
    out = []
    # only a text with one of these can have an address
    pattern = TOKEN if "@" in text or "at]" in text or "at)" in text or " dot " in text else TOKEN_PLAIN
    for m in pattern.finditer(text):
        kind = m.lastgroup
        a, b = m.span()
        if kind == "word":
            word = text[a:b]
            out.append((shape(word), a, b, word))
        elif kind == "lower" or kind == "capital" or kind == "mark":
            out.append((kind, a, b, text[a:b]))
        else:
            out.append((kind, a, b, kind))
    return out


def hashed(word: str) -> int:
    return zlib.crc32(word.lower().encode())
