"""Known names in texts: a substring join without comparing every text with every name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.functions.bloom import MAX_BITS
from keelgraph.functions.text import NO_MATCH
from keelgraph.session import durable, spread

#: Length of the character sequences that texts and names are joined on.
GRAM = 6


def dictionary(kb: DataFrame, order: str, payload: list[str]) -> DataFrame:
    """One row per non-empty name with the payload of its last record."""
    return kb.where("entity_name <> ''").groupBy("entity_name").agg(F.max_by(F.struct(*payload), order).alias("p")).select("entity_name", "p.*")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts after each other, and the number of the text that each belongs to."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _sequences(codes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every sequence of n characters within a text."""
    if len(codes) < n:
        return owner[:0], codes[:0]
    h = np.full(len(codes) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    inside = owner[: len(h)] == owner[n - 1 :]
    return owner[: len(h)][inside], h[inside]


def _of_names(n: int):
    """(entity_name, gram): every sequence of n characters of a name, or a shorter name itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            size = np.array([len(x) for x in names], np.int64)
            for k in range(1, n + 1):
                mine = np.flatnonzero(size >= n if k == n else size == k)
                owner, h = _sequences(*_codes([names[i] for i in mine]), k)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(mine[owner])), pa.array(h.view(np.int64))], ["entity_name", "gram"])

    return run


def _of_texts(n: int, shared, bits: int):
    """(key, gram): the distinct sequences of a text that may anchor a name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, low = shared.value, np.uint64(bits - 1)
        for batch in batches:
            codes, owner = _codes(batch.column(1).to_pylist())
            for k in range(1, n + 1):
                text, h = _sequences(codes, owner, k)
                ok = np.ones(len(h), bool)
                for at in (h & low, (h >> np.uint64(36)) & low):
                    ok &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                text, h = text[ok], h[ok]
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[new])), pa.array(h[new].view(np.int64))], ["key", "gram"])

    return run


def _anchored(anchors: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of the anchors, of two bits each, combined on the executors; at most MAX_BITS, whatever their number."""
    count, bits = anchors.agg(F.approx_count_distinct("gram")).first()[0], 1 << 16
    while bits < 16 * count and bits < MAX_BITS:
        bits *= 2
    low = F.lit(bits - 1)
    at = anchors.select(F.explode(F.array(F.col("gram").bitwiseAND(low), F.shiftrightunsigned("gram", 36).bitwiseAND(low))).alias("at"))
    set_ = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
    words = np.zeros(bits // 64, np.int64)
    words[set_["word"].to_numpy(np.int64)] = set_["bits"].to_numpy(np.int64)
    return words.view(np.uint64), bits


def matches(texts: DataFrame, names: DataFrame, key: str, text: str, n: int = GRAM) -> DataFrame:
    """(key, entity_name, place): every name that occurs in a text as it is written, once, 1-based in order of the place
    where its first occurrence ends, the longest first.

    A name is anchored at the one of its n-character sequences that the fewest names share, a shorter name at itself. Texts
    are read once: of their sequences those go on that a broadcast bitmap of all anchors, bounded in size, lets pass. They
    are joined with the anchors, and each candidate is verified in the text. So the work follows the texts' size and the
    hits, not texts times names. Null texts and empty names match nothing; what several texts of one key match is united.
    """
    names = names.select("entity_name").where("entity_name <> ''").distinct()
    grams = names.mapInArrow(_of_names(n), "entity_name string, gram long")
    shared = grams.groupBy("gram").agg(F.count("*").alias("names"))
    anchors = durable(grams.join(shared, "gram").groupBy("entity_name").agg(F.min_by("gram", F.struct("names", "gram")).alias("gram")))
    words, bits = _anchored(anchors)
    source = spread(texts.select(key, text).where(F.col(text).isNotNull()))
    kind = T.StructType([T.StructField("key", texts.schema[key].dataType), T.StructField("gram", T.LongType())])
    may = source.mapInArrow(_of_texts(n, names.sparkSession.sparkContext.broadcast(words), bits), kind)
    candidates = may.join(anchors, "gram").select("key", "entity_name")
    found = source.join(candidates, F.col(key) == F.col("key")).select(key, "entity_name", F.instr(F.col(text), F.col("entity_name")).alias("at")).where("at > 0")
    once = found.groupBy(key, "entity_name").agg(F.min(F.col("at") + F.length("entity_name")).alias("end"))
    place = Window.partitionBy(key).orderBy("end", F.length("entity_name").desc())
    return once.select(key, "entity_name", F.row_number().over(place).alias("place"))


def context(texts: DataFrame, matched: DataFrame, names: DataFrame, key: str, most: int = 15) -> DataFrame:
    """(key, context): the first matches of every text as lines `- name (types): summary...` for a prompt.

    Up to three types and 100 characters of the summary; a text without matches says so. `most` limits the lines, as the
    feature is.
    """
    line = F.concat(F.lit("- "), F.col("entity_name"), F.lit(" ("), F.array_join(F.slice(F.coalesce("type", F.array().cast("array<string>")), 1, 3), ", "), F.lit("): "),
                    F.substr(F.coalesce("summary", F.lit("")), F.lit(1), F.lit(100)), F.lit("..."))
    listed = matched.where(F.col("place") <= most).join(names, "entity_name").groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda x: x["line"]), "\n").alias("context"))
    return texts.select(key).join(listed, key, "left").select(key, F.coalesce("context", F.lit(NO_MATCH)).alias("context"))


def known_entities(texts: DataFrame, matched: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """(key, entities): all matches of every text, in order, as one JSON list of their records; `[]` without matches."""
    record = F.struct("place", F.struct(*names.columns).alias("record"))
    listed = matched.join(names, "entity_name").groupBy(key).agg(F.to_json(F.transform(F.array_sort(F.collect_list(record)), lambda x: x["record"])).alias("entities"))
    return texts.select(key).join(listed, key, "left").select(key, F.coalesce("entities", F.lit("[]")).alias("entities"))
