"""Records of one thing, and the best representative of each such group.

Records are grouped by name: ways of writing one name have one key, and a key that differs from another by a single slip
leads to it. Whether a difference is a slip or meant is read from the whole table: a slip makes pairs of characters, or
words, that are rare beside those it spoils, while words that names differ in by intent are as common as each other.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.functions.lookalike import look_key
from keelgraph.llm.forms import fold
from keelgraph.session import durable, spread

# Units and letters written in several ways.
UNITS = {"毫米": "mm", "微米": "μm", "um": "μm", "厘米": "cm", "千欧": "kω", "kohm": "kω", "平方米": "m2", "㎡": "m2",
         "摄氏度": "°c", "度": "°c", "千牛": "kn", "千瓦": "kw", "兆帕": "mpa", "吨": "t"}
BARE = {"ł": "l", "ø": "o", "đ": "d", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ħ": "h"}
QUOTES = {"「": "」", "『": "』", "《": "》", "〈": "〉", "【": "】", "“": "”", "‘": "’", '"': '"', "'": "'", "[": "]", "<": ">"}

#: How many times rarer what a slip makes must be than what it spoils.
RARER = 3
#: Names of no more characters than this, without a number, count as short.
SHORT = 5
#: In how many longer names a mistaken character must be seen before it is believed in a short one.
SEEN = 2

_NUMBER = regex.compile(r"^(?:no\.?|nr\.?|第)\s*(\d+)\s*(?:号|#)?")
_MARKED = regex.compile(r"^(\d+)\s*(?:#|号)")
_UNIT = regex.compile(r"(\d)\s*(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![a-z])")
_ABBREVIATION = regex.compile(r"\s*[(（\[【〔]\s*\p{L}[a-z.]{1,7}\s*[)）\]】〕]\s*$")
_TOKEN = regex.compile(r"\p{N}+|\p{Han}|[^\W\p{N}\p{Han}_]+|[°%‰±+]")
_NUMBERS, _WORDS = regex.compile(r"\p{N}+"), regex.compile(r"[^\W\p{N}\p{Han}_]+")
_ROMAN = regex.compile(r"[ivx]+$")


def name_key(name: str) -> str:
    """The same for all ways of writing a name.

    Digits stay; codes, units and grades come in capitals, other letters in small ones; Latin words are parted by a space.
    """
    x = unicodedata.normalize("NFD", fold(name))
    x = "".join(BARE.get(c, c) for c in x if not unicodedata.combining(c) or c in "゙゚")
    x = unicodedata.normalize("NFC", x).strip()
    while len(x) > 2 and QUOTES.get(x[0]) == x[-1]:
        x = x[1:-1].strip()
    found = _ABBREVIATION.search(x) if x[-1:] in ")）]】〕" else None
    if found and found.start():
        inner = found.group().strip(" ()（）[]【】〔〕")
        if inner.isascii():
            x = x[: found.start()]
    x = _MARKED.sub(r"\1号", _NUMBER.sub(r"\1号", x))
    x = _UNIT.sub(lambda m: m[1] + UNITS[m[2]], x)
    tokens = _TOKEN.findall(x)
    out, word_before = [], False
    for i, t in enumerate(tokens):
        letters = _kind(t[0]) == "letter"
        if letters:
            beside = any(_kind(n[0]) == "number" for n in tokens[max(0, i - 1) : i] + tokens[i + 1 : i + 2])
            if len(t) <= 3 and (beside or _ROMAN.match(t) or (i and tokens[i - 1] == "°")):
                t = t.upper()
        word = letters and not t.isupper()
        if word and word_before:
            out.append(" ")
        out.append(t)
        word_before = word
    return "".join(out) or x


@lru_cache(maxsize=1 << 16)
def _kind(c: str) -> str:
    """`number`, `han`, `letter` or `other`."""
    if regex.match(r"\p{N}", c):
        return "number"
    if regex.match(r"\p{Han}", c):
        return "han"
    return "letter" if c.isalpha() else "other"


@F.pandas_udf(T.StringType())
def name_keys(names: pd.Series) -> pd.Series:
    return names.map({v: name_key(v) for v in names.dropna().unique()}).astype(object)


def units(key: str) -> set[str]:
    """The words of Latin letters, and the pairs of neighbours elsewhere, numbers being alike."""
    shape = _NUMBERS.sub("0", key)
    marked = "^" + _WORDS.sub("~", shape).replace("~ ~", "~").replace(" ", "") + "$"
    return set(_WORDS.findall(shape)) | {marked[i : i + 2] for i in range(len(marked) - 1)}


def _change(a: str, b: str) -> tuple[str, int] | None:
    """(kind, position) of the one slip by which a and b differ: `swap`, `double`, `drop`, `other` or `space`."""
    if a.replace(" ", "") == b.replace(" ", ""):
        return "space", 0
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        if a[i + 1 :] == b[i + 1 :]:
            return None if " " in (a[i], b[i]) else ("other", i)
        return ("swap", i) if a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1] else None
    long, short = (a, b) if len(a) > len(b) else (b, a)
    if long[i + 1 :] != short[i:]:
        return None
    return "double" if long[i] in (long[i - 1 : i], long[i + 1 : i + 2]) else "drop", i


def slips(a: str, b: str) -> list[tuple[str, str, str, list[tuple[str, str]]]]:
    """(slipped, meant, kind, units): how one of two keys may be a slip of the other.

    Each of `units` is what the slip makes with what it spoils; the first must be rare beside the second. The kind of a
    mistaken character is the one meant followed by the one written.
    """
    change = _change(a, b)
    if change is None:
        return []
    kind, i = change
    if kind == "space":
        return [(max(a, b), min(a, b), kind, [])]
    out = []
    for x, y in ((a, b), (b, a)):  # x meant, y slipped
        long = x if len(x) > len(y) else y
        letters = _kind(long[i]) == "letter"
        if letters:
            u, v = x.split(" "), y.split(" ")
            different = [(n, m) for m, n in zip(map(_word, u), map(_word, v)) if m != n] if len(u) == len(v) else []
            if different and all(m and n for n, m in different):
                out.append((y, x, "letter", different))
            continue
        p, q = "^" + x + "$", "^" + y + "$"  # position i is i + 1 here
        if kind == "other":
            out.append((y, x, x[i] + y[i], [(_pair(q, i), _pair(p, i)), (_pair(q, i + 1), _pair(p, i + 1))]))
        elif kind == "swap":
            out.append((y, x, kind, [(_pair(q, i + 1), _pair(p, i + 1))]))
        elif kind == "double" and len(y) > len(x):
            k = i + 1 if q[i + 1] == q[i + 2] else i
            out += [(y, x, kind, [(_pair(q, k), _pair(q, k - 1))]), (y, x, kind, [(_pair(q, k), _pair(q, k + 1))])]
        elif kind == "drop" and len(y) < len(x):
            out.append((y, x, kind, [(_pair(q, i), _pair(p, i)), (_pair(q, i), _pair(p, i + 1))]))
        elif kind == "drop":
            out.append((y, x, kind, [(_pair(q, i), _pair(p, i)), (_pair(q, i + 1), _pair(p, i))]))
    return out


def _pair(marked: str, i: int) -> str:
    """Two neighbours as `units` writes them: numbers alike, and Latin letters alike."""
    return "".join("0" if _kind(c) == "number" else "~" if _kind(c) == "letter" else c for c in marked[i : i + 2])


def _word(w: str) -> str:
    return "".join(_WORDS.findall(w))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rest) of keys (id, key): hashes of a key and of what is left of it without one character that is no number or code.

    The hash is the sum of each character times the base to the power of its place, so that all are had from one running sum
    over a batch. Doubled characters leave the same rest and are told once.
    """
    for batch in batches:
        ids = batch.column(0)
        texts = batch.column(1).to_pylist()
        if not texts:
            continue
        length = np.array([len(t) for t in texts], np.int64)
        owner, start = np.repeat(np.arange(len(texts)), length), np.cumsum(length) - length
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, int(length.max()) - 1), _BASE, np.uint64)]))
        term = codes * powers[np.arange(len(codes)) - start[owner]]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)])
        total = running[start + length] - running[start]
        sums = running[1:] - running[start][owner]
        without = (sums - term) + (total[owner] - sums) * _INVERSE
        different, place = np.unique(codes, return_inverse=True)
        free = np.array([not chr(c).isupper() and _kind(chr(c)) != "number" for c in different.tolist()], bool)[place]
        free[1:] &= ~((without[1:] == without[:-1]) & (owner[1:] == owner[:-1]))
        index = np.concatenate([owner[free], np.arange(len(texts))])
        rests = np.concatenate([without[free], total]).view(np.int64)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(index)), pa.array(rests)], ["id", "rest"])


#: Keys of one rest that one task pairs with the others of the rest; more are cut into parts.
REST_PART = 200


def _pairs(keys: DataFrame) -> DataFrame:
    """(a, b): keys that are equal after at most one deletion each, of a character that is no number or code, each pair once.

    Only hashes travel until the pairs are known. Keys that share a rest may be as many as the alphabet has letters for
    every place; a rest of many keys is cut into parts, each of which meets all of them.
    """
    hashed = keys.select(F.xxhash64("key").alias("id"), "key")
    n = F.count("*").over(Window.partitionBy("rest"))
    near = hashed.mapInArrow(_rests, "id long, rest long").withColumn("n", n).where("n > 1")
    near = durable(near.select("id", "rest", F.ceil(F.col("n") / REST_PART).cast("int").alias("parts")))
    one = near.select("rest", F.col("id").alias("a"), F.pmod(F.hash("id"), "parts").alias("part"))
    other = near.select("rest", F.col("id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = one.join(other, ["rest", "part"]).where("a < b").select("a", "b").distinct()
    text = lambda c: hashed.select(F.col("id").alias(c), F.col("key").alias(f"key_{c}"))
    return pairs.join(text("a"), "a").join(text("b"), "b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


_TOLD = "key string, parent string, kind string, short boolean, way int, made string, spoilt string"


def _told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for a, b in zip(batch["a"], batch["b"]):
            short = max(len(a), len(b)) <= SHORT and not regex.search(r"\p{N}", a)
            for way, (slipped, meant, kind, compared) in enumerate(slips(a, b)):
                rows += [(slipped, meant, kind, short, way, made, spoilt) for made, spoilt in compared or [(None, None)]]
        yield pd.DataFrame(rows, columns=["key", "parent", "kind", "short", "way", "made", "spoilt"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _units(keys: pd.Series) -> pd.Series:
    return keys.map(lambda k: sorted(units(k)))


def _leading(keys: DataFrame) -> DataFrame:
    """(key, root): every key that is a slip of another, with the key meant."""
    # By number, so that Python's share isn't merged into a few tasks for its few bytes.
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = durable(keys.repartition(parts, "key"))
    counts = durable(keys.select(F.explode(_units("key")).alias("unit")).groupBy("unit").agg(F.count("*").alias("n")))
    of = lambda column, n: counts.select(F.col("unit").alias(column), F.col("n").alias(n))
    told = _pairs(keys).repartition(parts).mapInPandas(_told, _TOLD).join(of("made", "n_made"), "made", "left").join(of("spoilt", "n_spoilt"), "spoilt", "left")
    odds = F.when(F.col("kind") == "space", F.lit(1e9)).otherwise(F.coalesce("n_spoilt", F.lit(0)) / F.greatest(F.coalesce("n_made", F.lit(0)), F.lit(1)))
    judged = durable(told.groupBy("key", "parent", "kind", "short", "way").agg(F.min(odds).alias("odds")))
    # A character mistaken for another in several names is believed in any other name, too.
    mistaken = durable(judged.where((F.col("odds") >= RARER) & ~F.col("short") & (F.length("kind") == 2)).groupBy("kind").agg(
        F.countDistinct("key").alias("seen")).where(F.col("seen") >= SEEN))
    known = judged.join(mistaken, "kind", "left").withColumn("known", F.col("seen").isNotNull())
    # Nobody means a character twice where another name has it once, however common the pair is.
    known = known.withColumn("odds", F.when(F.col("kind") == "double", F.greatest("odds", F.lit(float(RARER)))).otherwise(F.col("odds")))
    believed = F.expr(f"(odds >= {RARER} AND (known OR NOT short OR kind IN ('space', 'swap', 'double', 'letter'))) OR (known AND odds >= 1)")
    slips = known.where(believed)
    best = durable(slips.groupBy("key").agg(F.max_by("parent", F.struct("odds", "parent")).alias("root")))
    kinds = [r.kind for r in mistaken.select("kind").collect()]  # bounded by the characters mistaken for each other
    restored = keys.join(best, "key", "left_anti").repartition(parts).mapInPandas(lambda batches: _restored(batches, kinds), "key string, parent string")
    together = restored.withColumn("n", F.count("*").over(Window.partitionBy("parent"))).where("n > 1").drop("n")
    pairs = durable(together.join(keys.withColumnRenamed("key", "parent"), "parent", "left_anti").select(F.col("key").alias("a"), F.col("parent").alias("b")))
    told = pairs.mapInPandas(_told, _TOLD).join(pairs.select(F.col("a").alias("key"), F.col("b").alias("parent")), ["key", "parent"], "left_semi")
    told = told.join(of("made", "n_made"), "made", "left").join(of("spoilt", "n_spoilt"), "spoilt", "left")
    judged = told.groupBy("key", "parent", "kind", "way").agg(F.min(odds).alias("odds"))
    believed = durable(judged.where((F.col("kind") == "double") | (F.col("kind").isin(kinds) & (F.col("odds") >= 1))).select("key", "parent").distinct())
    size = believed.groupBy("parent").agg(F.count("*").alias("n"))
    chosen = believed.join(size.where("n > 1"), "parent").groupBy("key").agg(F.max_by("parent", F.struct("n", "parent")).alias("root"))
    return _roots(best.unionByName(chosen))


def _restored(batches: Iterator[pd.DataFrame], kinds: list[str]) -> Iterator[pd.DataFrame]:
    """(key, parent): every key without one of its doubled characters, and with one known mistaken character put right."""
    meant: dict[str, list[str]] = {}
    for right, wrong in kinds:
        meant.setdefault(wrong, []).append(right)
    for batch in batches:
        rows = set()
        for key in batch["key"]:
            for i, c in enumerate(key):
                if i and c == key[i - 1] and c != " " and not c.isupper() and _kind(c) != "number":
                    rows.add((key, key[:i] + key[i + 1 :]))
                rows.update((key, key[:i] + right + key[i + 1 :]) for right in meant.get(c, ()))
        yield pd.DataFrame(sorted(rows), columns=["key", "parent"])


def _roots(best: DataFrame) -> DataFrame:
    """(key, root): every key with the end of its chain of roots; a circle's root is its smallest key."""
    back = best.where("root > key").join(best.select(F.col("key").alias("root"), F.col("root").alias("key")), ["key", "root"], "left_semi")
    best = durable(best.join(back.select("key"), "key", "left_anti").withColumn("low", F.least("key", "root")))
    # Steps double in length, so that after these any key that still moves has come into a circle, and round it.
    for _ in range(best.count().bit_length() + 1):
        further = best.select(F.col("key").alias("root"), F.col("root").alias("next"), F.col("low").alias("low_next"))
        if best.join(further, "root", "left_semi").isEmpty():
            break
        stepped = best.join(further, "root", "left")
        best = durable(stepped.select("key", F.coalesce("next", "root").alias("root"), F.least("low", F.coalesce("low_next", "low")).alias("low")))
    ends = best.select(F.col("key").alias("root"), F.col("low").alias("end"))
    return best.join(ends, "root", "left").select("key", F.coalesce("end", "root").alias("root"))


#: Columns of a record that the choice of a survivor reads, with those of its name and key.
READ = ("type", "domain_relevance", "summary", "chunk_ids", "origin", "deleted_at", "extracted_at")


def rooted_records(records: DataFrame, key: str, name: str) -> DataFrame:
    """records (key, name and those columns of READ that it has) with the key of its thing, `root`, and whether its name is a
    slip of the thing's, `slipped`.

    A record with a null or empty name is a thing of its own. Repeated names are compared once, so a name that holds a third
    of the rows costs no more than another; names are compared only with those one deletion away, and with those that
    become the same, unstored name when a doubled or known mistaken character is put right in each.
    """
    own = [c for c in (key, name, *READ) if c in records.columns]
    keyed = durable(spread(records.select(*own)).select(*own, name_keys(F.when(F.col(name) != "", F.col(name))).alias("name_key")))
    leading = durable(_leading(keyed.select(F.col("name_key").alias("key")).where("key <> ''").distinct()))
    return keyed.join(leading.withColumnRenamed("key", "name_key"), "name_key", "left").select(
        *own, F.coalesce("root", "name_key", F.concat(F.lit("\u0000"), F.col(key).cast("string"))).alias("root"), (F.coalesce("root", "name_key") != F.col("name_key")).alias("slipped"))


# --- the survivor -----------------------------------------------------------------------------------------------------

# Texts that stand for none.
PLACEHOLDERS = ("", "信息待补充", "待补充", "暂无", "无", "未知", "unknown", "n/a", "none", "null", "tbd", "-", "?")
#: The share of its trust that is left to a deleted record, to a slip of a name, and to a summary that was cut.
DELETED, SLIPPED, CUT = 0.25, 0.1, 0.5
#: Characters from which on a summary counts as complete.
COMPLETE = 40

_BUNDLES = ("name", "class", "passage")
_VALUES = ("name", "type", "relevance", "summary", "chunks")


def _language(text):
    return F.when(text.rlike(r"\p{IsHan}"), "zh").when(text.rlike(r"\p{IsLatin}"), "en")


def _clean(rooted: DataFrame) -> DataFrame:
    """Records with placeholders as nothing, and lists as sorted sets."""
    text = lambda c: F.when(~F.lower(F.trim(c)).isin(*PLACEHOLDERS), F.col(c))
    items = lambda c: F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull() & ~F.lower(F.trim(x.cast("string"))).isin(*PLACEHOLDERS))))
    filled = lambda c: F.when(F.size(c) > 0, c)
    return rooted.select(
        "entity_id", "root", "slipped", "origin", "deleted_at", "extracted_at", F.when(F.col("entity_name") != "", F.col("entity_name")).alias("name"), text("summary").alias("summary"),
        filled(items("type")).alias("type"), filled(items("domain_relevance")).alias("relevance"), filled(items("chunk_ids")).alias("chunks"))


def origin_trust(clean: DataFrame) -> DataFrame:
    """(origin, trust): of the bundles that records of an origin fill, the share that another record of the thing has, too.

    What several records say independently is likelier right, so an origin is trusted as its values are confirmed. Only
    hashes of things and values travel.
    """
    value = lambda *c: F.when(F.coalesce(*[F.col(x).isNotNull() for x in c[:1]]), F.xxhash64("root", F.lit(c[0]), *c))
    held = clean.select("origin", F.explode(F.array(value("name"), value("type", "relevance"), value("summary", "chunks"))).alias("value")).where("value IS NOT NULL")
    counted = held.groupBy("value", "origin").agg(F.count("*").alias("n"))
    together = counted.groupBy("value").agg(F.sum("n").alias("all"), F.collect_list(F.struct("origin", "n")).alias("of"))
    each = together.select("all", F.inline("of"))
    return each.groupBy("origin").agg(((F.sum(F.when(F.col("all") > 1, F.col("n")).otherwise(0)) + 1) / (F.sum("n") + 2)).alias("trust"))


def _votes(clean: DataFrame) -> DataFrame:
    """(root, bundle, values, score, at): every bundle that some record of a thing holds, with the trust in all that hold it.

    A bundle's score is the trust of its records' origins, weighed by completeness: a cut summary, a short one, one without
    chunks, and one that stands with several things and so tells little of either, count less; so do chunks without a
    summary, a relevance without a type, a name that is a slip or written with look-alike characters, and deleted records.
    """
    # kept, so that their sizes are known when they are joined: small ones are broadcast by Spark, and no origin is a partition's key
    shared = durable(clean.where("summary IS NOT NULL").groupBy(F.xxhash64("summary").alias("said")).agg(F.approx_count_distinct("root").alias("things")).where("things > 1"))
    trusted = durable(origin_trust(clean)).select(F.col("origin").alias("o"), "trust")
    known = clean.join(trusted, F.col("origin").eqNullSafe(F.col("o"))).withColumn("said", F.xxhash64("summary")).join(shared, "said", "left")
    trust = F.col("trust") * F.when(F.col("deleted_at").isNull(), 1.0).otherwise(DELETED)
    plain = F.when(look_key("name") == F.col("name"), 1.0).otherwise(0.8) * F.when(F.col("slipped"), SLIPPED).otherwise(1.0)
    whole = F.log2(F.least(F.length("summary"), F.lit(COMPLETE)) + 2) * F.when(F.col("summary").rlike(r"(\.\.\.|…)$"), CUT).otherwise(1.0) / F.coalesce("things", F.lit(1))
    passage = F.when(F.col("summary").isNotNull(), whole).otherwise(1.0) * F.when(F.col("chunks").isNotNull(), 1.0).otherwise(0.5)
    kinds = {"name": "string", "type": "array<string>", "relevance": "array<string>", "summary": "string", "chunks": "array<bigint>"}

    def bundle(kind: str, score, *has: str):
        values = [(F.col(c) if c in has else F.lit(None).cast(kinds[c])).alias(c) for c in _VALUES]
        return F.when(F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in (has[:1] if kind == "name" else has)]), F.struct(F.lit(kind).alias("bundle"), *values, (trust * score).alias("score")))

    held = F.array_compact(F.array(bundle("name", plain, "name", "type"), bundle("class", F.when(F.col("type").isNotNull(), 1.0).otherwise(0.3), "type", "relevance"), bundle("passage", passage, "summary", "chunks")))
    cast = known.select("root", F.col("extracted_at").alias("at"), F.explode(held).alias("b")).select("root", "at", "b.*")
    return cast.groupBy("root", "bundle", *_VALUES).agg(F.sum("score").alias("score"), F.max("at").alias("at"))


def _consistent(votes: DataFrame) -> DataFrame:
    """(root, bundle, values, score): the bundles that the dependencies within them leave.

    Functional dependencies: a type determines the relevance, a summary its chunks, a name the type of the thing it names.
    Of a determinant's values the most trusted stands, the latest of equals. The score of a name is that of all records with it.
    """
    determinant = [F.when(F.col("bundle") == b, F.col(c)).alias(f"by_{c}") for b, c in zip(_BUNDLES, ("name", "type", "summary"))]
    # a name's own type is sought among the records that have one
    order = F.struct(F.when((F.col("bundle") == "name") & F.col("type").isNull(), 0).otherwise(1), F.col("score"), F.col("at"), F.to_json(F.struct("relevance", "chunks", "type")))
    best = votes.groupBy("root", "bundle", *determinant).agg(F.max_by(F.struct(*_VALUES), order).alias("v"), F.sum("score").alias("all"), F.max("score").alias("most"))
    return best.select("root", "bundle", "v.*", F.when(F.col("bundle") == "name", F.col("all")).otherwise(F.col("most")).alias("score"))


def _candidates(consistent: DataFrame) -> DataFrame:
    """(root, names, classes, passages): of the bundles that the dependencies between bundles treat alike the most trusted.

    Those are names with one language and one type, and passages with one language; a class has a type of its own. So
    however many records a thing has, what is gathered of it is bounded by the languages and the sets of types.
    """
    language = F.when(F.col("bundle") == "name", _language(F.col("name"))).when(F.col("bundle") == "passage", _language(F.col("summary")))
    signed = consistent.withColumn("language", language).withColumn("sign", F.when(F.col("bundle") != "passage", F.col("type")))
    best = signed.groupBy("root", "bundle", "language", "sign").agg(F.max_by(F.struct("score", "language", *_VALUES), F.struct(F.col("score"), F.to_json(F.struct(*_VALUES)))).alias("best"))
    of = lambda b: F.collect_list(F.when(F.col("bundle") == b, F.col("best")))
    return best.groupBy("root").agg(of("name").alias("names"), of("class").alias("classes"), of("passage").alias("passages"))


_CHOSEN = "entity_name string, type array<string>, domain_relevance array<string>, summary string, chunk_ids array<long>, trust double"


def survivors(rooted: DataFrame, least: int = 1) -> DataFrame:
    """One record per thing of at least so many records: (root, entity_id, records, entity_name, type, domain_relevance, summary, chunk_ids, trust).

    `entity_id` is the smallest of the thing. Dependent fields are bundles that are taken whole: the name; type with
    domain_relevance; summary with chunk_ids, the chunks it was written from. Branch and bound chooses the bundles of most
    trust together under the dependencies between them: the name determines the type, and the language of the summary. If
    no choice meets both, the first gives way, then the second. Lists come as sorted sets without placeholders; a record
    without a name is a thing of its own; fields that no record fills are null. Repeated rows count as records each.
    """
    things = rooted.groupBy("root").agg(F.min("entity_id").alias("entity_id"), F.count("*").alias("records")).where(F.col("records") >= least)
    things = durable(things) if least > 1 else things
    clean = durable(_clean(rooted if least < 2 else rooted.join(things.select("root"), "root", "left_semi")))
    whole = durable(things.join(_candidates(_consistent(_votes(clean))), "root", "left").select("root", "entity_id", "records", "names", "classes", "passages"))
    # where each bundle has one candidate, as with most single records, there is nothing to choose
    plain = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in ("names", "classes", "passages")]) <= 1
    name, cls, passage = F.get("names", F.lit(0)), F.get("classes", F.lit(0)), F.get("passages", F.lit(0))
    trust = sum((F.coalesce(x["score"], F.lit(0.0)) for x in (name, cls, passage)), F.lit(0.0))
    alone = whole.where(plain).select("root", "entity_id", "records", name["name"].alias("entity_name"), cls["type"].alias("type"), cls["relevance"].alias("domain_relevance"),
                                      passage["summary"].alias("summary"), passage["chunks"].alias("chunk_ids"), trust.alias("trust"))
    chosen = whole.where(~plain).mapInPandas(_choose, f"root string, entity_id long, records long, {_CHOSEN}")
    return alone.unionAll(chosen)


def duplicate_pairs(rooted: DataFrame, chosen: DataFrame) -> DataFrame:
    """(entity_id_a, entity_id_b): each surviving record's thing, by its smallest entity_id, with every other record of it."""
    things = chosen.select("root", F.col("entity_id").alias("entity_id_a"))
    return rooted.select("root", F.col("entity_id").alias("entity_id_b")).join(things, "root").where("entity_id_a <> entity_id_b").select("entity_id_a", "entity_id_b")


def best_choice(names: list[dict], classes: list[dict], passages: list[dict]) -> tuple[dict, dict, dict, float]:
    """The bundles of most trust together that meet the dependencies between them, by branch and bound."""

    def fits(name: dict, other: dict, field: str) -> bool:
        return not name.get(field) or not other.get(field) or _same(name[field], other[field])

    order = [sorted(x or [{}], key=lambda c: -_score(c)) for x in (names, passages, classes)]
    rest = [sum(_score(x[0]) for x in order[i:]) for i in range(4)]
    for kept in (("language", "type"), ("language",), ()):
        best, most = None, -math.inf

        def branch(chosen: list[dict], total: float) -> None:
            nonlocal best, most
            k = len(chosen)
            if k == 3:
                if total > most:
                    best, most = list(chosen), total
                return
            for c in order[k]:
                if total + _score(c) + rest[k + 1] <= most:
                    break  # the bound: candidates come by falling trust
                if k == 0 or (field := ("language", "type")[k - 1]) not in kept or fits(chosen[0], c, field):
                    branch([*chosen, c], total + _score(c))

        branch([], 0.0)
        if best:
            return best[0], best[2], best[1], most
    raise AssertionError("without dependencies any choice is allowed")


def _same(a, b) -> bool:
    return a == b if isinstance(a, str) else list(a) == list(b)


def _score(candidate: dict) -> float:
    return candidate["score"] if candidate else 0.0


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    plain = lambda x: None if x is None else list(x)
    bundles = lambda x: [{k: (list(v) if isinstance(v, np.ndarray) else v) for k, v in c.items()} for c in x] if x is not None else []
    for batch in batches:
        rows = []
        for root, entity_id, records, *held in batch.itertuples(index=False):
            name, cls, passage, trust = best_choice(*[bundles(b) for b in held])
            rows.append((root, entity_id, records, name.get("name"), plain(cls.get("type")), plain(cls.get("relevance")), passage.get("summary"), plain(passage.get("chunks")), trust))
        yield pd.DataFrame(rows, columns=["root", "entity_id", "records", "entity_name", "type", "domain_relevance", "summary", "chunk_ids", "trust"])
