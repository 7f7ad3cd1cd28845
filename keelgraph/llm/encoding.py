"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

Texts are cut by the tokenizer's pattern into pieces. Each distinct piece is merged once per Python worker, over a segment
tree whose leaves are byte positions: a leaf holds the rank of the pair that begins at the position (with the position, so
that the leftmost of equal ranks is the least), the root the next pair to merge, and each merge updates the leaves of the
live neighbours in logarithmic time. A piece is first cut where no vocabulary entry has its two neighbouring bytes side by
side, since no merge can cross such a place; that leaves few distinct parts, most of them short.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.session import spread

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern of the byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces remembered by a worker before it forgets them, and characters encoded at a time.
REMEMBERED, AT_A_TIME = 200_000, 500_000

_NONE = 1 << 62


class ByteBpe:
    """The ids of byte strings under the merge ranks that a .tiktoken file holds."""

    def __init__(self, content: bytes) -> None:
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.byte = [self.ranks[bytes([b])] for b in range(256)]
        self.side_by_side = {t[i : i + 2] for t in self.ranks for i in range(len(t) - 1)}
        self.touching = {t[0] << 8 | t[1] for t in self.side_by_side}
        self._parts: dict[bytes, list[int]] = {}
        self._characters: dict[str, tuple[int, int, list[int]]] = {}

    def forget(self) -> None:
        self._parts.clear()

    def merged(self, part: bytes) -> list[int]:
        """The ids of a part, by a segment tree of the leftmost minimum pair rank."""
        n = len(part)
        ids = [self.byte[b] for b in part]
        if n == 1:
            return ids
        token, ranks = self.token, self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = 1 << (n - 1).bit_length()

        def pair(i: int) -> int:
            j = after[i]
            rank = ranks.get(token[ids[i]] + token[ids[j]]) if j < n else None
            return _NONE if rank is None else rank << 32 | i

        tree = [_NONE] * (2 * size)
        tree[size : size + n] = [pair(i) for i in range(n)]
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                k >>= 1
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    break
                tree[k] = least

        while tree[1] != _NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            ids[i] = tree[1] >> 32
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, _NONE)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def piece(self, piece: str) -> list[int]:
        """The ids of a piece. Neighbouring characters that no entry joins are taken apart; a character's ids are kept."""
        out: list[int] = []
        known, touching, last, start = self._characters, self.touching, -1, 0
        ids: list[int] = []
        for i, c in enumerate(piece):
            found = known.get(c)
            if found is None:
                b = c.encode()
                found = known[c] = (b[0], b[-1], self.part(b))
            if last >= 0 and last << 8 | found[0] not in touching:
                out += ids if i - start == 1 else self.part(piece[start:i].encode())
                start = i
            ids, last = found[2], found[1]
        return out + (ids if len(piece) - start == 1 else self.part(piece[start:].encode()))

    def part(self, part: bytes) -> list[int]:
        known = self._parts.get(part)
        if known is None:
            known, start = [], 0
            for i in range(1, len(part) + 1):
                if i == len(part) or part[i - 1 : i + 1] not in self.side_by_side:
                    known += self.merged(part[start:i])
                    start = i
            if len(part) < 64:
                self._parts[part] = known
        return known


class Encoder:
    """Encodes lists of texts; keeps the ids of the pieces it has met in one growing array."""

    def __init__(self, content: bytes) -> None:
        self.bpe, self.find = ByteBpe(content), regex.compile(PATTERN).findall
        self._forget()

    def _forget(self) -> None:
        self.bpe.forget()
        self.at: dict[str, int] = {}
        self.ids: list[int] = []
        self.starts: list[int] = [0]
        self.frozen = (0, np.zeros(0, np.int32), np.zeros(1, np.int64))

    def _pieces(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Index of every piece of the texts, and how many pieces each text has."""
        if len(self.at) > REMEMBERED:
            self._forget()
        at, index, counts = self.at, [], []
        for text in texts:
            pieces = self.find(text) if text else ()
            counts.append(len(pieces))
            for p in pieces:
                k = at.get(p)
                if k is None:
                    k = at[p] = len(at)
                    self.ids += self.bpe.piece(p)
                    self.starts.append(len(self.ids))
                index.append(k)
        if self.frozen[0] != len(at):
            self.frozen = (len(at), np.array(self.ids, np.int32), np.array(self.starts, np.int64))
        return np.array(index, np.int64), np.array(counts, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids after each other, and the offsets of the texts in them."""
        index, counts = self._pieces(texts)
        _, ids, starts = self.frozen
        first, size = starts[index], starts[index + 1] - starts[index]
        ends = np.cumsum(size)
        flat = ids[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(counts)]])

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        index, counts = self._pieces(texts)
        _, _, starts = self.frozen
        ends = np.concatenate([[0], np.cumsum(starts[index + 1] - starts[index])])
        return np.diff(np.concatenate([[0], ends[np.cumsum(counts)]]))


#: The encoders of a Python worker by their vocabulary's digest.
_encoders: dict[str, Encoder] = {}


def encoder(shipped: tuple[str, bytes]) -> Encoder:
    """One per Python worker and vocabulary."""
    digest, content = shipped
    if digest not in _encoders:
        _encoders.clear()
        _encoders[digest] = Encoder(content)
    return _encoders[digest]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(start, texts) of at most AT_A_TIME characters, or of one text."""
    start, size, held = 0, 0, []
    for i, text in enumerate(texts):
        text = text.as_py()
        if held and size + len(text or "") > AT_A_TIME:
            yield start, held
            start, size, held = i, 0, []
        held.append(text)
        size += len(text or "")
    if held:
        yield start, held


def ship(spark: SparkSession, path: str | None = None) -> Broadcast:
    """A vocabulary file, read on the driver alone and sent to the executors, with its digest; some 0.6 MB."""
    with open(path or vocabulary(), "rb") as file:
        content = file.read()
    return spark.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))


def vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    return f"{folder}/{name}.tiktoken"


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of every text, without special tokens.

    Null and empty texts give the empty list, strings that look like special tokens are ordinary text. Repeated rows are
    encoded each; other columns are not read. Texts of any length are encoded whole.
    """
    shipped = ship(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                ids, offsets = encoder(shipped.value).encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), lists], ["key", "ids"])

    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return spread(df.select(key, text)).mapInArrow(run, schema).withColumnRenamed("key", key)


def token_length(spark: SparkSession, path: str | None = None):
    """A function Column -> Column: the number of tokens of a text, 0 for null and empty ones."""
    shipped = ship(spark, path)

    @F.pandas_udf(T.LongType())
    def lengths(texts: pd.Series) -> pd.Series:
        out = [encoder(shipped.value).lengths(held) for _, held in _slices(pa.array(texts, pa.string(), from_pandas=True))]
        return pd.Series(np.concatenate(out) if out else np.zeros(0, np.int64))

    return lengths
