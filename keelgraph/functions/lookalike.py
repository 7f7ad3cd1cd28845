"""One form for strings that look the same in print.

`look` keeps what a reader can see (letter case, accents, raised figures, visible spaces) and levels the rest: character
width, invisible characters, kinds of space, composed or combining accents, radicals and compatibility ideographs, and
letters of other scripts that are drawn alike.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters drawn alike, each group in the order of the code points it names.
ALIKE = {
    # Greek capitals and small letters, then lunate sigma and yot
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ν": "v", "ο": "o", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Cyrillic capitals, then small letters
    "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Һ": "H", "Ӏ": "I", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ү": "y",
    "һ": "h", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    # Armenian and Latin extensions
    "Օ": "O", "օ": "o", "ո": "n", "ս": "u", "ɑ": "a", "ɡ": "g",
    # Katakana drawn like ideographs, and like hiragana
    "エ": "工", "カ": "力", "タ": "夕", "ト": "卜", "ニ": "二", "ハ": "八", "ロ": "口", "ー": "一", "ヘ": "へ",
    # Hyphens and minus, dots and colons
    "‐": "-", "‑": "-", "−": "-", "・": "·", "‧": "·", "∙": "·", "⋅": "·", "∶": ":",
}

# Ranges of default-ignorable code points besides the format characters (general category Cf).
IGNORABLE = ((0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164),
             (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF))

#: Compatibility forms that a reader can tell from the plain ones.
_SEEN = {"<super>", "<sub>", "<fraction>", "<circle>"}


def _decomposed(ch: str) -> str:
    parts = unicodedata.decomposition(ch).split()
    if not parts or parts[0] in _SEEN:
        return ch
    if parts[0][0] == "<":
        parts = parts[1:]
    return "".join(_decomposed(chr(int(p, 16))) for p in parts)


class _Table(dict):
    """Filled as characters come; maps a code point to what stands for it."""

    def __missing__(self, cp: int) -> str:
        ch, kind = chr(cp), unicodedata.category(chr(cp))
        if ch.isspace() or kind[0] == "Z":
            out = " "
        elif kind in ("Cf", "Cc") or any(a <= cp <= b for a, b in IGNORABLE):
            out = ""
        else:
            out = "".join(ALIKE.get(c, c) if not c.isspace() else " " for c in _decomposed(ch))
        self[cp] = out
        return out


_TABLE = _Table()


def look(s: str) -> str:
    if s.isascii() and s.isprintable():
        return s.strip()
    return unicodedata.normalize("NFC", s.translate(_TABLE)).strip()


@F.pandas_udf(T.StringType())
def look_key(values: pd.Series) -> pd.Series:
    """`look` of each string, of every distinct value of a batch once; null gives null, a string of nothing visible the empty one."""
    return values.map({v: look(v) for v in values.dropna().unique()}).astype(object)
