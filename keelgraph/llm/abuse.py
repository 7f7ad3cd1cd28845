"""Scores for abusive, hateful or sexual passages: a noisy channel restores disguised words, then a trained score reads them.

Restoring: spans that may be disguised (figures and signs among letters, letters or ideographs parted by signs, letters
repeated) become lattices of characters; Viterbi decoding takes the path most likely under a character trigram model counted
over all documents. Scoring: a linear model over hashed character n-grams of each passage of the restored text, trained on
passages of a bounded sample of labelled documents, which are restored and first weighed on the executors; a document's
score is that of its worst passage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelgraph.llm.forms import fold
from keelgraph.session import durable, spread

#: Buckets of the n-gram weights, and of the bigram and trigram counts of the language model.
BUCKETS, BIGRAMS, TRIGRAMS = 1 << 20, 1 << 18, 1 << 20
#: Most labelled documents of either kind that the score is trained on.
POSITIVES, NEGATIVES = 2_500, 8_000
#: Most passages of those documents that reach the driver; none is longer than LONGEST, so they have 130 MB at the very most.
PASSAGES = 80_000
#: Of a marked document the worst passages that are trained on; of the unmarked ones' passages the share that looks best and
#: is left out, but for this share of all.
WORST, PLAIN, ANYWAY = 5, 0.8, 0.15
#: Most weight of a bad passage in training, a good one having 1.
BAD_WEIGHT = 12.0
#: Logits, to the model of the other half, below which a marked passage and above which an unmarked document count as wrong marks.
SUSPECT, SURE = -1.5, 3.0
#: Passages whose n-grams are held at a time.
BLOCK = 4_000
#: Longest passage in characters; a longer one is cut with some overlap.
LONGEST, SHARED = 400, 60

# Letters that figures and signs stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}

#: The signs of _SIGN and the figures and signs among letters, as code points.
_SIGNS, _FIGURES = [ord(c) for c in " \t*·.-_/~○|+^=•"], [ord(c) for c in "0123456789@$!|+"]
_END = regex.compile(r"(?:[\n\r。！？?]|!(?![A-Za-z]))+|(?<=[a-z\)\"])[.](?=\s|[A-Z]|$)|(?<=\D)\.\s")
_SIGN = r"[\s*·.\-_/~○|+^=•]"
#: Spans that may be disguised.
_DISGUISED = regex.compile(
    rf"(?<![a-z])(?:[a-z]{_SIGN}{{1,2}}){{2,}}[a-z](?![a-z])"  # letters parted by signs
    rf"|\p{{Han}}(?:{_SIGN}{{1,2}}\p{{Han}})+"  # ideographs parted by signs
    r"|(?<![a-z0-9])(?=[a-z0-9@$!|+]*[a-z])(?:[a-z]+[0-9@$!|+]+(?=[a-z])|[$@](?=[a-z0-9])|[0-9](?=[a-z]+[0-9@$!]+[a-z]))[a-z0-9@$!|+]*"  # figures among letters
    r"|[a-z]*([a-z])\1{2,}[a-z]*"  # letters repeated
    r"|(\p{Han})\2{2,}"
)


#: Letters parted by sentence ends, and lines of one ideograph each: a disguise that runs over the ends of passages.
_PARTED = regex.compile(r"(?<![A-Za-z])(?:[A-Za-z][.!?]\s?){2,}[A-Za-z](?![A-Za-z])|^[^\S\n]*\p{Han}[^\S\n]*(?:\r?\n[^\S\n]*\p{Han}[^\S\n]*)+$", regex.MULTILINE)
_PARTING = regex.compile(r"[.!?\s]+")


def _may_be_parted(texts: list[str]) -> np.ndarray:
    """Whether a text can hold anything that _PARTED finds; told for all texts at once, and never wrongly denied."""
    c = np.frombuffer(("\0" * 3 + "\0".join(texts) + "\0" * 6).encode("utf-32-le", "replace"), np.uint32)

    def at(x: np.ndarray, k: int) -> np.ndarray:
        return x[3 + k : len(x) - 5 + k]

    letter, end, space = ((c | 32) >= 97) & ((c | 32) <= 122), np.isin(c, (33, 46, 63)), (c == 32) | ((c >= 9) & (c <= 13)) | (c >= 0x85) & (c < 0x2E80)
    parted = at(letter, 0) & ~at(letter, -1) & at(end, 1) & ((at(letter, 2) & at(end, 3)) | (at(space, 2) & at(letter, 3) & at(end, 4)))
    # an ideograph with nothing but space or an edge on both sides, and a line end there
    han, edge = (c >= 0x2E80) & (c <= 0x3FFFF), space | (c == 0) | (c == 0x3000)
    parted |= at(han, 0) & at(edge, -1) & at(edge, 1)
    text = np.cumsum(at(c, 0) == 0)
    return np.bincount(text, weights=parted, minlength=len(texts))[: len(texts)] > 0


def passages(text: str, parted: bool = True) -> list[str]:
    if parted:
        text = _PARTED.sub(lambda m: _PARTING.sub("·", m[0].strip()), text)
    out = []
    for p in _END.split(text):
        p = p and p.strip()
        while p:
            out.append(p[:LONGEST])
            p = p[LONGEST - SHARED :] if len(p) > LONGEST else ""
    return out


def _codes(texts: list[str]) -> np.ndarray:
    """The code points of the texts with a line feed after each."""
    return np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "replace"), np.uint32)


def _hashed(codes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each position."""
    h = np.full(len(codes) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ codes[i : len(codes) - n + 1 + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h & np.uint64(buckets - 1)).astype(np.int32)


class CharacterModel:
    """Log probability of a character after two others, from hashed counts."""

    def __init__(self, bigrams: np.ndarray, trigrams: np.ndarray) -> None:
        self.bigrams, self.trigrams = bigrams, trigrams
        self.total = float(bigrams.sum()) + 1.0
        self.known: dict[str, float] = {}
        self.restored: dict[tuple[str, str, str], str] = {}

    def log(self, before: str, c: str) -> float:
        key = before + c
        p = self.known.get(key)
        if p is None:
            codes = np.array([ord(x) for x in key], np.uint32)
            bi = [float(self.bigrams[b]) for b in _hashed(codes, 2, BIGRAMS)] if len(key) > 1 else [0.0]
            tri = float(self.trigrams[_hashed(codes, 3, TRIGRAMS)[0]]) if len(key) > 2 else 0.0
            low = (bi[-1] + 0.02) / (self.total / 50 + 1)
            p = math.log((tri + 5 * low) / ((bi[0] if len(key) > 2 else self.total / 50) + 5))
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[key] = p
        return p


def _lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each place of a span what may stand there, with the log of how likely it was disguised so."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(span):
        c, j = span[i], i
        while j < len(span) and span[j] == c:
            j += 1
        if c.isalpha() and j - i > 2:
            out.append([(c, -1.0), (c + c, -1.5)])
        elif c.isalpha() and j - i == 2:
            out.append([(c + c, 0.0), (c, -2.5)])
        elif c in STANDS_FOR:
            for _ in range(i, j):
                out.append([(c, 0.0), *((x, -1.5) for x in STANDS_FOR[c])])
        elif not c.isalnum():
            out.append([(span[i:j], 0.0), ("", -1.5)])
        else:
            out += [[(c, 0.0)]] * (j - i)
        i = j
    return out


def _decode(lattice: list[list[tuple[str, float]]], left: str, right: str, model: CharacterModel) -> tuple[float, str]:
    """The most likely path and its log probability, by Viterbi decoding; the state is the last two characters."""
    best = {left[-2:]: (0.0, "")}
    for place in [*lattice, *([(c, 0.0)] for c in right[:2])]:
        step: dict[str, tuple[float, str]] = {}
        for state, (total, text) in best.items():
            for output, cost in place:
                now, t = state, total + cost
                for c in output:
                    t += model.log(now, c)
                    now = (now + c)[-2:]
                if now not in step or t > step[now][0]:
                    step[now] = (t, text + output)
        best = step
    total, text = max(best.values())
    return total, text[: len(text) - len(right[:2])]


def restore_span(span: str, left: str, right: str, model: CharacterModel) -> str:
    """The most likely text for a span between its neighbours; signs that part it may all be left out together."""
    key = (left[-2:], span, right[:2])
    if key in model.restored:
        return model.restored[key]
    paths = [_decode(_lattice(span), left, right, model)]
    joined = "".join(c for c in span if c.isalnum() or c in "@$!")
    if len(joined) < len(span):
        total, text = _decode(_lattice(joined), left, right, model)
        paths.append((total - 2.5, text))
    if len(model.restored) > 200_000:
        model.restored.clear()
    model.restored[key] = max(paths)[1]
    return model.restored[key]


def restore(text: str, model: CharacterModel) -> str:
    return _DISGUISED.sub(lambda m: restore_span(m[0], text[max(0, m.start() - 2) : m.start()], text[m.end() : m.end() + 2], model), text)


def _suspicious(texts: list[str]) -> np.ndarray:
    """Whether a text can hold anything that _DISGUISED finds; told for all texts at once, and never wrongly denied."""
    c = np.concatenate([np.full(1, 10, np.uint32), _codes(texts), np.full(4, 10, np.uint32)])
    ends = c[1:-4] == 10
    latin, han = (c >= 97) & (c <= 122), (c >= 0x2E80) & (c <= 0x3FFFF)
    sign, figure = np.isin(c, _SIGNS), np.isin(c, _FIGURES)

    def at(x: np.ndarray, k: int) -> np.ndarray:
        return x[1 + k : len(x) - 4 + k]

    parted = at(sign, -1) & at(latin, 0) & at(sign, 1) & ((at(latin, 2) & ~at(latin, 3)) | (at(sign, 2) & at(latin, 3) & ~at(latin, 4)))
    parted |= at(han, 0) & at(sign, 1) & (at(han, 2) | (at(sign, 2) & at(han, 3)))
    before = np.maximum.accumulate(np.where(figure, 0, np.arange(len(c))))  # the last place that is no figure
    among = at(figure, 0) & at(latin, 1) & at(latin[before], 0)
    among |= np.isin(at(c, 0), (36, 64)) & (at(latin, 1) | at(figure, 1))
    repeated = (at(latin, 0) | at(han, 0)) & (at(c, 0) == at(c, 1)) & (at(c, 0) == at(c, 2))
    text = np.cumsum(ends) - ends
    return np.bincount(text, weights=parted | among | repeated, minlength=len(texts))[: len(texts)] > 0


def _read(texts: list[str | None], model: CharacterModel) -> tuple[list[str], np.ndarray]:
    """The restored passages of all texts, folded, and how many each text has."""
    flat, counts = [], []
    for text, parted in zip(texts, _may_be_parted([t or "" for t in texts])):
        found = [p for p in map(fold, passages(text, parted)) if p] if text else []
        flat += found
        counts.append(len(found))
    for i in np.flatnonzero(_suspicious(flat)) if flat else ():
        flat[i] = restore(flat[i], model)
    return flat, np.array(counts, np.int64)


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of two to four characters within a text, and the number of its text."""
    codes = _codes(texts)
    digits = (codes >= 48) & (codes <= 57)
    codes = np.where(digits, 48, codes).astype(np.uint32)
    ends = codes == 10
    text = np.cumsum(ends) - ends
    found, owner = [], []
    for n in (2, 3, 4):
        if len(codes) < n:
            continue
        inside = text[: len(codes) - n + 1] == text[n - 1 :]
        inside &= ~ends[n - 1 :]
        found.append(_hashed(codes, n, BUCKETS)[inside])
        owner.append(text[: len(codes) - n + 1][inside])
    return np.concatenate(found or [np.zeros(0, np.int32)]), np.concatenate(owner or [np.zeros(0, np.int64)])


def _scores(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    found, owner = _features(texts)
    return np.bincount(owner, weights=weights[found], minlength=len(texts))[: len(texts)] + bias


def character_model(documents: DataFrame, text: str) -> CharacterModel:
    """Bigram and trigram counts over all texts, combined by bucket; at most BIGRAMS + TRIGRAMS sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bi, tri = np.zeros(BIGRAMS, np.int64), np.zeros(TRIGRAMS, np.int64)
        for batch in batches:
            held = batch.column(0).to_pylist()
            for i in range(0, len(held), 500):
                codes = _codes([t.lower() for t in held[i : i + 500]])
                if len(codes) > 2:
                    bi += np.bincount(_hashed(codes, 2, BIGRAMS), minlength=BIGRAMS)
                    tri += np.bincount(_hashed(codes, 3, TRIGRAMS), minlength=TRIGRAMS)
        both = np.concatenate([bi, tri])
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(both[at], pa.int64())], ["bucket", "n"])

    sums = spread(documents.select(text).where(f"{text} <> ''")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros(BIGRAMS + TRIGRAMS, np.float32)
    both[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.float32)
    return CharacterModel(both[:BIGRAMS], both[BIGRAMS:])


def labelled_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of at most POSITIVES and NEGATIVES labelled documents, by hash of the id; contested ones are left out."""
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.avg("toxic").alias("toxic")).where("toxic IN (0, 1)")
    chosen = [
        marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for kind, most in ((1, POSITIVES), (0, NEGATIVES))
    ]
    # at most POSITIVES + NEGATIVES ids
    return documents.select("doc_id", "text").where("text <> ''").join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")


def _restored(sample: DataFrame, model: CharacterModel) -> DataFrame:
    """(doc_id, toxic, passages): the restored passages of every document, read on the executors."""
    shared = sample.sparkSession.sparkContext.broadcast((model.bigrams, model.trigrams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = CharacterModel(*shared.value)
        for batch in batches:
            held = [_read([t], model)[0] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.list_(pa.string()))], ["doc_id", "toxic", "passages"])

    parts = sample.sparkSession.sparkContext.defaultParallelism
    return sample.select("doc_id", "toxic", "text").repartition(parts).mapInArrow(run, "doc_id long, toxic double, passages array<string>")


def _likelier(restored: DataFrame) -> np.ndarray:
    """How much likelier each n-gram is in marked documents, from the numbers of documents with it; 0 for those of fewer than two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(1).to_pylist()
            f, o = _features([p for x in held for p in x])
            doc = np.repeat(np.arange(len(held)), [len(x) for x in held])
            once = np.unique(doc[o].astype(np.int64) * BUCKETS + f)
            toxic = batch.column(0).to_numpy()[once // BUCKETS] == 1
            p, n = (np.bincount((once % BUCKETS)[which], minlength=BUCKETS) for which in (toxic, ~toxic))
            at = np.flatnonzero(p + n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(p[at], pa.int64()), pa.array(n[at], pa.int64())], ["bucket", "p", "n"])

    counted = restored.select("toxic", "passages").mapInArrow(count, "bucket int, p long, n long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    of = counted.where("p >= 2").toPandas()  # at most BUCKETS rows
    bad, good = restored.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    weights = np.zeros(BUCKETS, np.float32)
    weights[of["bucket"].to_numpy(np.int64)] = np.clip(np.log((of["p"] + 0.5) / (bad + 1)) - np.log((of["n"] + 0.5) / (good + 1)), 0, 4)
    return weights


def training_passages(documents: DataFrame, labels: DataFrame, model: CharacterModel) -> pd.DataFrame:
    """(doc_id, toxic, passage, score) of at most PASSAGES passages of the labelled sample: of every marked document the WORST,
    of the unmarked ones those that look worse than the share PLAIN of theirs, and the share ANYWAY of all.

    How bad a passage looks is how much likelier its n-grams are in marked documents. Restoring, counting and weighing run on
    the executors, a document in one row.
    """
    restored = durable(_restored(labelled_sample(documents, labels), model))
    shared = documents.sparkSession.sparkContext.broadcast(_likelier(restored))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(2).to_pylist()
            flat, sizes = [p for x in held for p in x], np.array([len(x) for x in held], np.int64)
            f, o = _features(flat)
            size = np.maximum(np.bincount(o, minlength=len(flat)), 8)
            score = np.bincount(o, weights=shared.value[f], minlength=len(flat)) / np.sqrt(size)
            doc = np.repeat(np.arange(len(held)), sizes)
            place = np.empty(len(flat), np.int32)
            place[np.lexsort((-score, doc))] = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)), pa.array(flat, pa.string()), pa.array(score, pa.float64()), pa.array(place, pa.int32())],
                                             ["doc_id", "toxic", "passage", "score", "place"])

    weighed = durable(restored.mapInArrow(weigh, "doc_id long, toxic double, passage string, score double, place int"))
    floor = weighed.where("toxic = 0").agg(F.percentile_approx("score", PLAIN)).first()[0] or 0.0
    drawn = F.pmod(F.xxhash64("doc_id", "place"), F.lit(1000)) < ANYWAY * 1000
    kept = weighed.where(F.when(F.col("toxic") == 1, F.col("place") < WORST).otherwise((F.col("score") > floor) | drawn))
    return kept.orderBy(F.xxhash64("doc_id"), "doc_id", "place").limit(PASSAGES).select("doc_id", "toxic", "passage", "score").toPandas()


def _fit(found: np.ndarray, start: np.ndarray, rows: np.ndarray, y: np.ndarray, epochs: int = 5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic weights and bias for the texts `rows`, whose n-grams are found[start[i]:start[i + 1]], by AdaGrad."""
    weights, bias = np.zeros(BUCKETS, np.float32), -1.0
    grown, grown_bias = np.full(BUCKETS, 1e-2, np.float32), 1.0
    heavy = np.where(y == 1, min(BAD_WEIGHT, max(1.0, (y == 0).sum() / max(1, y.sum()))), 1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = rng.permutation(len(rows))
        for i in range(0, len(rows), 256):
            pick = shuffled[i : i + 256]
            sizes = start[rows[pick] + 1] - start[rows[pick]]
            ends = np.cumsum(sizes)
            f = found[np.repeat(start[rows[pick]] - ends + sizes, sizes) + np.arange(ends[-1])]
            own = np.repeat(np.arange(len(pick)), sizes)
            z = np.bincount(own, weights=weights[f], minlength=len(pick)) + bias
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * heavy[pick]
            u, inverse = np.unique(f, return_inverse=True)
            g = np.bincount(inverse, weights=err[own]).astype(np.float32) + 1e-3 * weights[u]
            grown[u] += g * g
            weights[u] -= 0.1 * g / np.sqrt(grown[u])
            grown_bias += err.sum() ** 2
            bias -= 0.1 * err.sum() / math.sqrt(grown_bias)
    return weights, float(bias)


def train(sample: pd.DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias of the passage score, from `training_passages`.

    A marked document has at least one bad passage, an unmarked one none. Of every marked document the passage is taken that
    looks worst, first by the score it comes with, then to a model fitted on the other half of the sample; marked documents
    of which that model suspects nothing, and unmarked ones it is sure of, are taken for wrong marks and left out of the
    final fit. Without marks of both kinds all weights are 0.
    """
    doc = pd.factorize(sample["doc_id"])[0]
    bad = sample["toxic"].to_numpy() == 1
    if not 0 < bad.sum() < len(bad):
        return np.zeros(BUCKETS, np.float32), -5.0
    texts, score = list(sample["passage"]), sample["score"].to_numpy(float).copy()
    toxic = np.zeros(doc.max() + 1, bool)
    toxic[doc[bad]] = True
    parts = []
    for i in range(0, len(texts), BLOCK):
        f, o = _features(texts[i : i + BLOCK])
        order = np.argsort(o, kind="stable")
        parts.append((f[order], (o[order] + i).astype(np.int32)))
    found, owner = (np.concatenate(x) for x in zip(*parts))
    start = np.searchsorted(owner, np.arange(len(texts) + 1))

    def worst_of_each() -> np.ndarray:
        most = np.full(len(toxic), -np.inf)
        np.maximum.at(most, doc, score)
        return bad & (score >= most[doc])

    def fit(rows: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, float]:
        return _fit(found, start, rows, top[rows].astype(float))

    half = doc % 2
    for _ in range(2):
        top, fresh = worst_of_each(), score.copy()
        for side in (0, 1):
            rows = np.flatnonzero((half != side) & (top | ~bad))
            if top[rows].any() and len(rows) > 1:
                weights, bias = fit(rows, top)
                mine = half[owner] == side
                fresh[half == side] = (np.bincount(owner[mine], weights=weights[found[mine]], minlength=len(texts)) + bias)[half == side]
        score = fresh
    top = worst_of_each()
    suspected = top & (score > SUSPECT)
    if not suspected.any():
        suspected = top
    sure = np.zeros(len(toxic), bool)
    sure[doc[~bad & (score > SURE)]] = True
    rows = np.flatnonzero(suspected | (~bad & ~sure[doc]))
    return fit(rows, suspected)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, passage): for every document the score of its worst passage, from 0 to 1, and that passage.

    Null, empty and blank texts score 0 with a null passage. Repeated rows are scored each; the whole text is read. Labels
    may be null, wrong, repeated or contested; without any, all scores are the same.
    """
    model = character_model(documents, "text")
    weights, bias = train(training_passages(documents, labels, model))
    shared = documents.sparkSession.sparkContext.broadcast((model.bigrams, model.trigrams, weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bigrams, trigrams, weights, bias = shared.value
        model = CharacterModel(bigrams, trigrams)
        for batch in batches:
            held = batch.column(2).to_pylist()
            for i in range(0, len(held), 500):
                flat, counts = _read(held[i : i + 500], model)
                logits = _scores(flat, weights, bias) if flat else np.zeros(0)
                scores, worst, k = [], [], 0
                for n in counts:
                    j = k + int(np.argmax(logits[k : k + n])) if n else -1
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logits[j])))) if n else 0.0)
                    worst.append(flat[j] if n else None)
                    k += n
                ids, sources = batch.column(0).slice(i, len(counts)), batch.column(1).slice(i, len(counts))
                yield pa.RecordBatch.from_arrays([ids, sources, pa.array(scores, pa.float64()), pa.array(worst, pa.string())],
                                                 ["doc_id", "source", "score", "passage"])

    return spread(documents.select("doc_id", "source", "text")).mapInArrow(run, "doc_id long, source string, score double, passage string")


#: Documents with this score or more are found.
THRESHOLD = 0.5


def source_rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(source, documents, found, rate, mean_score) per source, null included."""
    hit = F.col("score") >= threshold
    return scored.groupBy("source").agg(F.count("*").alias("documents"), F.sum(hit.cast("long")).alias("found"),
                                        F.avg(hit.cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
