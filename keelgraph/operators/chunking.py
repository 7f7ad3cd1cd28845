"""Chunks of Markdown that cut no formula and no table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.operators.ordinals import ordinal
from keelgraph.session import spread

SIZE, OVERLAP = 512, 50
# Where to split, strongest first.
SEPARATORS = ["\n\n", "\n# ", "\n## ", "\n### ", "\n####", "\n", "。", "！", "？", "；", " ", ""]

# Formulas and tables, in the order in which they are protected.
DISPLAY, INLINE, TABLE = r"(?s)\$\$(.*?)\$\$", r"\$([^\n]*?)\$", r"(?is)<table\b[^>]*>.*?</table>"


def protected_counts(text: Column) -> Column:
    """Struct (display, inline, tables): how many spans of a text are protected; each is sought in what the one before left."""
    rest = F.regexp_replace(text, DISPLAY, "")
    rest2 = F.regexp_replace(rest, r"(?d)\$(.*?)\$", "")
    return F.struct(
        F.regexp_count(text, F.lit(DISPLAY)).alias("display"),
        F.regexp_count(rest, F.lit(r"(?d)\$(.*?)\$")).alias("inline"),
        F.regexp_count(rest2, F.lit(TABLE)).alias("tables"),
    )


def _found(kind: str, pattern: str, text: str) -> list[tuple[int, int]]:
    # past the last end of a table none can be, however many are left open
    end = max((m.end() for m in regex.finditer("(?i)</table>", text)), default=0) if kind == "TABLE" else len(text)
    return [m.span() for m in regex.finditer(pattern, text, endpos=end)]


def protect(text: str, formulas: bool = True, tables: bool = True) -> tuple[str, list[tuple[str, str]]]:
    """The text with placeholders for formulas and tables, and (placeholder, span) in order."""
    held: list[tuple[str, str]] = []
    for kind, pattern in [("FORMULA", DISPLAY), ("FORMULA", INLINE)] * formulas + [("TABLE", TABLE)] * tables:
        spliced, last = [], 0
        for start, end in _found(kind, pattern, text):
            held.append((f"__{kind}_{len(held)}__", text[start:end]))
            spliced += [text[last:start], held[-1][0]]
            last = end
        text = "".join(spliced) + text[last:]
    return text, held


def restore(text: str, spans: list[tuple[str, str]]) -> str:
    """Spans put back, the last one hidden first, so that formulas within tables come back as well."""
    for placeholder, span in reversed(spans):
        text = text.replace(placeholder, span)
    return text


def _merged(parts: list[str], size: int, overlap: int) -> list[str]:
    """Neighbouring parts joined while they fit; each chunk begins with a tail of the one before of at most `overlap`."""
    chunks, held, length = [], [], 0
    for part in parts:
        if held and length + len(part) > size:
            chunks.append("".join(held))
            while held and (length > overlap or length + len(part) > size):
                length -= len(held.pop(0))
        held.append(part)
        length += len(part)
    if held:
        chunks.append("".join(held))
    return chunks


def split(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: list[str] | None = None) -> list[str]:
    """Chunks by the first separator that occurs, kept at the head of what follows; parts too long go to the next ones."""
    separators = SEPARATORS if separators is None else separators
    k = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    separator, finer = separators[k], separators[k + 1 :]
    if separator:
        cut = text.split(separator)
        parts = [p for p in [cut[0], *(separator + c for c in cut[1:])] if p]
    else:
        parts = list(text)
    chunks, short = [], []
    for part in parts:
        if len(part) < size:
            short.append(part)
            continue
        chunks += _merged(short, size, overlap)
        short = []
        chunks += split(part, size, overlap, finer) if finer else [part]
    chunks += _merged(short, size, overlap)
    return [c for c in (c.strip() for c in chunks) if c]


def split_protected(text: str, size: int = SIZE, overlap: int = OVERLAP, formulas: bool = True, tables: bool = True) -> list[str]:
    hidden, spans = protect(text, formulas, tables)
    return [restore(c, spans) for c in split(hidden, size, overlap)]


def chunk_texts(texts: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP, formulas: bool = True, tables: bool = True, keep: str | None = None) -> DataFrame:
    """(key, pos, chunk_content): the chunks of every text, in order, with the text's own column `keep`, such as its source.

    Sizes are measured with placeholders for formulas and tables, so a chunk that holds one may be longer. Null, empty and
    blank texts give no chunk.
    """
    own = [key, *([keep] if keep else [])]
    kept = [T.StructField(c, texts.schema[c].dataType) for c in own]
    schema = T.StructType([*kept, T.StructField("pos", T.IntegerType()), T.StructField("chunk_content", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = zip(*[batch[c] for c in own])
            rows = [(*v, i, c) for v, t in zip(values, batch[text]) for i, c in enumerate(split_protected(t, size, overlap, formulas, tables))]
            yield pd.DataFrame(rows, columns=schema.names)

    return spread(texts.select(*own, text).where(F.col(text).isNotNull())).mapInPandas(run, schema)


def number_chunks(chunks: DataFrame, order: list[str], source: str) -> DataFrame:
    """(chunk_content, source, metadata): metadata is the chunk's 0-based place in the whole corpus."""
    numbered = ordinal(chunks, order, "metadata")
    return numbered.select("chunk_content", F.coalesce(F.col(source), F.lit("")).alias("source"), "metadata")
