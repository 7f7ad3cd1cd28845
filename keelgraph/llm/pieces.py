"""Splitting oversized texts at natural boundaries of Markdown, by recursive bisection."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keelgraph.session import spread

LIMIT, OVERLAP = 512, 50

#: An image of any length; neither part is sought past the next one's beginning, so that images left open cost no more.
_IMAGE = r"!\[[^\[\]\n]*+\]\([^()\n]*+(?:\([^()\n]*+\)[^()\n]*+)*+\)"
#: What should stay in one piece: display and inline formulas, tables, images.
_WHOLE = regex.compile(rf"\$\$.*?\$\$|\$[^$\n]+\$|<table\b.*?</table>|{_IMAGE}", regex.DOTALL | regex.IGNORECASE)
_NO_TABLE = regex.compile(rf"\$\$.*?\$\$|\$[^$\n]+\$|{_IMAGE}", regex.DOTALL)
_TABLE_END = regex.compile("</table>", regex.IGNORECASE)
#: Boundaries, each after the match; the group that matched gives the strength.
_BOUNDARY = regex.compile(
    r"(?P<s7>\n\s*(?=#{1,6}\s))"  # before a heading
    r"|(?P<s6>(?:\r?\n[^\S\n]*){2,})"  # blank line
    r"|(?P<s5>\n(?=\s*(?:[-*+]|\d+[.)、])\s)|</table>\s*)"  # before a list item, after a table
    r"|(?P<s4>\r?\n)"
    r"|(?P<s3>[。！？!?…]+[”’」』）)\"']*\s?|\.(?=\s)\s?)"  # sentence
    r"|(?P<s2>[；;：:，,、]\s?)"  # clause
    r"|(?P<s1>[^\S\n]+)"  # space
)


def _whole(text: str) -> list[tuple[int, int]]:
    """The spans that should stay in one piece. Past the last end of a table none is sought, however many are left open."""
    spans, start, last = [], 0, -1
    for m in _TABLE_END.finditer(text):
        last = m.end()
    if last > 0:
        for m in _WHOLE.finditer(text, 0, last):
            spans.append(m.span())
        start = spans[-1][1] if spans else 0
    return spans + [m.span() for m in _NO_TABLE.finditer(text, start)]


def _boundaries(text: str) -> tuple[list[int], list[int]]:
    """Positions of the boundaries and their strengths, in order; none inside what should stay whole."""
    spans = _whole(text)
    starts = [a for a, _ in spans]
    found = {k: 2 for span in spans for k in span if 0 < k < len(text)}
    for m in _BOUNDARY.finditer(text):
        k = m.end()
        i = bisect_left(starts, k) - 1
        if i < 0 or k >= spans[i][1]:
            found[k] = max(found.get(k, 0), int(m.lastgroup[1]))
    at = sorted(found)
    return at, [found[k] for k in at]


def _joined(text: str, k: int) -> bool:
    """Whether a cut at k would part a character from its marks, or CR from LF."""
    return unicodedata.combining(text[k]) > 0 or text[k] in "‍︎️" or text[k - 1] == "‍" or text[k - 1 : k + 1] == "\r\n"


def _bare(text: str, a: int, b: int, middle: int) -> int:
    """The place nearest to the middle where a cut parts no character from its marks; the middle where there is none at all."""
    for away in range(b - a):
        for k in (middle + away, middle - away):
            if a < k < b and not _joined(text, k):
                return k
    return middle


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, repeated, end) of each piece: text[start - repeated : end] is the piece, text[start:end] what it adds."""
    if len(text) <= limit:
        return [(0, 0, len(text))]
    at, strength = _boundaries(text)
    room, ends, stack = limit - overlap, [], [(0, len(text))]
    while stack:
        a, b = stack.pop()
        if b - a <= room:
            ends.append(b)
            continue
        middle, reach = (a + b) // 2, (b - a) // 4
        near = range(bisect_left(at, max(a + 1, middle - reach)), bisect_right(at, min(b - 1, middle + reach)))
        if near:
            k = at[max(near, key=lambda i: (strength[i], -abs(at[i] - middle)))]
        elif beyond := [i for i in (bisect_left(at, middle) - 1, bisect_left(at, middle)) if 0 <= i < len(at) and a < at[i] < b]:
            k = at[min(beyond, key=lambda i: (abs(at[i] - middle), -strength[i]))]
        else:
            k = _bare(text, a, b, middle)
        stack += [(k, b), (a, k)]
    pieces, start = [], 0
    for end in ends:
        repeated = 0
        if start:
            low = max(pieces[-1][0], start - overlap)
            near = bisect_left(at, low)
            repeated = start - (at[near] if near < len(at) and at[near] < start else low)
        pieces.append((start, repeated, end))
        start = end
    return pieces


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, piece, pieces, start, repeated, text): the pieces of every text, at most `limit` code points each, in order.

    A text within the limit is one piece. A longer one is cut at the strongest boundary near its middle, or else the
    nearest anywhere in it, at a bare character only where it has none, and each half again while it exceeds
    limit - overlap; then each piece but the first is given up to `overlap` characters of the end of the one before it, from a
    natural boundary if one lies there. Without the repeated characters the pieces are the
    text. A null text gives no row, an empty one an empty piece; repeated rows are split each. Other columns aren't read.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *(T.StructField(c, T.IntegerType()) for c in ("piece", "pieces", "start", "repeated")),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, whole in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                found = cuts(whole, limit, overlap)
                rows += [(k, i, len(found), a, r, whole[a - r : b]) for i, (a, r, b) in enumerate(found)]
            yield pd.DataFrame(rows, columns=schema.names)

    return spread(df.select(key, text).where(df[text].isNotNull())).mapInPandas(run, schema)
