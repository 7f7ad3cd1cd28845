"""Mapping freely entered relations to the canonical list by a prefix-filter set-similarity join."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.llm.forms import fold_key
from keelgraph.session import durable

UNMATCHED = "unmatched"

# Other ways of saying each relation, besides its name and its label. Which words mean the same can't be read
# from the tables; a vocabulary that has a table of its own gives it as `ways`.
SAID_AS = {
    "contains": "includes; comprises; consists of; made up of; is made up of; is composed of; 包括; 涵盖; 内含; 含有部分; 由…组成; 含有",
    "part_of": "component of; is part of; is a part of; is included in; is contained in; is a component of; 构成部分; 为…的组成部分; 是…的一部分; 是…的组成部分",
    "belongs_to": "subclass of; is a kind of; is a; is a type of; type of; kind of; is classified as; 归类为; 属于类别; 是一种; 隶属于",
    "precedes": "happens before; is done before; comes before; predecessor of; is before; 早于; 先行于; 在…之前; 前置于",
    "inputs": "takes as input; input is; has input; 以…为输入; 输入条件为; 输入依据; 输入为",
    "outputs": "gives as output; output is; has output; 设计成果为; 给出成果; 输出成果; 输出为",
    "refines": "makes more detailed; details; elaborates; 深化; 进一步细化; 细化为",
    "uses": "employs tool; makes use of; utilizes; employs; 用到; 采用; 借助; 利用; 运用",
    "applied_to": "is applied in; is applied to; used for; applicable to; 用于; 应用在; 适用于; 运用于",
    "acts_on": "performed on; operates on; works on; 作用在; 施加于; 对…进行操作",
    "improves": "increases quality of; makes better; enhances; 优化; 提升; 提高; 改善",
    "replaces": "substitutes for; supersedes; takes the place of; 代替; 替换; 取代",
    "enables": "allows for; makes feasible; makes possible; 使…成为可能; 使得可行; 支持实现",
    "has": "owns attribute; possesses; has property; has attribute; 拥有; 具备; 带有属性",
    "affects": "influences; impacts; has an effect on; 产生影响; 对…有影响; 波及",
    "determines": "sets the value of; dictates; decides; 确定; 起决定作用",
    "constrained_by": "restricted by; limited by; is bounded by; 受…限制; 受制于; 受约束于",
    "connects_to": "is linked with; attached to; joined to; is connected to; 与…相连; 接合于; 连接到; 相接",
    "supports": "holds up; bears; carries load of; 撑住; 托起; 承托; 支承",
    "produces": "results in; generates; yields; 得到产品; 产出; 生成; 制成",
    "located_at": "placed at; is situated in; found at; is located in; 处于; 坐落于; 设在; 布置在",
    "assembles_into": "built up into; is assembled to form; 拼装成; 合拢成; 组合为; 装配成",
    "prepares_for": "gets ready for; is preparation for; 预备; 为…做准备; 做好前期准备",
    "tests_with": "is tested by; verified with; checked using; 试验手段为; 通过…检验; 用…测试; 验证方法为",
}

#: Least Jaccard similarity of the token sets of a value and an entry. One slip in a word of three letters or more leaves as much.
LEAST = 0.4
#: What the bounds of the filters give way, so that none loses a pair of exactly LEAST.
_ROUNDING = 1e-9
#: Characters from which on a value with ideographs may have a slip; in shorter ones every character tells meanings apart.
LONG_HAN = 4

# What denies a relation, in front of it.
_DENIED = r"^(?:not\b|never\b|no\b|cannot\b|(?:does|do|did|is|are|was|can|has|have)\s*(?:not|n't)\b|isn't\b|doesn't\b|不|未|无法|从不|没有|没|非|并不|并未)"


def _plain(folded: Column) -> Column:
    """Words parted by single spaces, without a `rel:` in front and without punctuation around."""
    words = F.regexp_replace(folded, r"^[\s\p{P}]*(?:rel|relation|关系)\s*[::：]\s*", "")
    return F.btrim(F.regexp_replace(words, r"[^\p{L}\p{N}']+", " "), F.lit(" '"))


def _script(plain: Column, letters: str) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(plain, f"[^{letters}]+", " "), " +", " "))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(compact: pd.Series) -> pd.Series:
    """Pairs of neighbouring characters, the ends marked, and every character with the number of its occurrence."""

    def of(c: str) -> list[str]:
        marked, seen = f"^{c}$", Counter()
        tokens = {marked[i : i + 2] for i in range(len(marked) - 1)}
        for x in c:
            seen[x] += 1
            tokens.add(f"{x}{seen[x]}.")
        return sorted(tokens)

    return compact.map(of)


def known_ways(spark: SparkSession) -> DataFrame:
    """(relation, said): the ways of SAID_AS, for vocabularies that have no such table of their own."""
    return spark.createDataFrame([(r, s) for r, ways in SAID_AS.items() for s in ways.split("; ")], "relation string, said string")


def entries(vocab: DataFrame, ways: DataFrame | None = None) -> DataFrame:
    """(entry, relation, tokens): each relation's name, label, other ways of saying it, and the verb of its definition.

    `ways` (relation, said) is the table of other ways, SAID_AS if there is none; ways of relations that aren't in the
    vocabulary take no part. A definition `subject VERB object` gives the verb. Of relations that share an entry the last
    by name has it.
    """
    verb = F.regexp_extract("definition", "主语(.{2,4})宾语", 1)
    own = vocab.select("relation", F.explode(F.array(F.col("relation"), F.translate("relation", "_", " "), F.col("label_zh"), verb)).alias("said"))
    other = (known_ways(vocab.sparkSession) if ways is None else ways.select("relation", "said")).join(vocab.select("relation"), "relation", "left_semi")
    rows = own.unionByName(other).where("said <> ''").withColumn("entry", F.translate(_plain(fold_key("said")), " ", ""))
    return rows.where("entry <> ''").groupBy("entry").agg(F.max("relation").alias("relation")).withColumn("tokens", _tokens("entry"))


def _prefixes(sets: DataFrame, key: str, rarity: DataFrame) -> DataFrame:
    """(key, size, i, token): of each set, in order of rarity, the tokens of which a similar set must share one.

    `rarity` has the tokens that both sides have. Any other token of a set is of no use and comes first, as the rarest.
    """
    shared = sets.select(key, F.size("tokens").alias("size"), F.explode("tokens").alias("token")).join(rarity, "token")
    listed = shared.groupBy(key, "size").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("known"))
    before = F.col("size") - F.size("known")
    keep = F.greatest(F.lit(0), F.col("size") - F.ceil(F.col("size") * LEAST - _ROUNDING).cast("int") + 1 - before)
    placed = listed.select(key, "size", before.alias("before"), F.posexplode(F.slice("known", F.lit(1), keep)).alias("p", "t"))
    return placed.select(key, "size", (F.col("p") + F.col("before")).alias("i"), F.col("t.token").alias("token"))


def similar(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """(compact, entry, relation, jaccard): every value (compact, tokens) with every entry at least LEAST similar to it.

    A prefix-filter join: tokens in order of their rarity in the whole table, the prefixes joined on their tokens, pairs of
    unlike lengths or with too little left behind the shared token dropped, and Jaccard worked out for the rest.
    """
    everywhere = asked.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarity = everywhere.join(listed.select(F.explode("tokens").alias("token")).distinct(), "token", "left_semi")
    a = _prefixes(asked, "compact", rarity)
    b = _prefixes(listed, "entry", rarity).select("entry", F.col("size").alias("size_b"), F.col("i").alias("j"), "token")
    behind = 1 + F.least(F.col("size") - F.col("i") - 1, F.col("size_b") - F.col("j") - 1)
    pairs = (
        a.join(b, "token")
        .where((F.col("size_b") >= F.col("size") * LEAST - _ROUNDING) & (F.col("size_b") * LEAST - _ROUNDING <= F.col("size")))
        .where(behind >= LEAST / (1 + LEAST) * (F.col("size") + F.col("size_b")) - _ROUNDING)
        .select("compact", "entry").distinct()
    )
    both = pairs.join(asked.select("compact", F.col("tokens").alias("mine")), "compact").join(listed, "entry")
    common = F.size(F.array_intersect("mine", "tokens"))
    measured = both.withColumn("jaccard", common / (F.size("mine") + F.size("tokens") - common))
    return measured.where(F.col("jaccard") >= LEAST).select("compact", "entry", "relation", "jaccard")


def _slips() -> Column:
    """How many slips part value and entry, a swap of neighbours being half of two; null beyond what their length allows."""
    letters = lambda c: F.array_join(F.array_sort(F.split(c, "")), "")
    edits = F.levenshtein("compact", "entry").cast("double")
    swapped = F.when((F.length("compact") == F.length("entry")) & (letters("compact") == letters("entry")) & (edits <= 2), edits / 2)
    away = F.coalesce(swapped, edits)
    size, han = F.least(F.length("compact"), F.length("entry")), F.col("compact").rlike(r"\p{IsHan}")
    allowed = F.when(han, F.when(size >= LONG_HAN, 1).otherwise(0)).when(size <= 2, 0).when(size <= 11, 1).otherwise(2)
    begins = F.substring("compact", 1, 1) == F.substring("entry", 1, 1)
    return F.when((away <= allowed) & begins, away)


def map_values(values: DataFrame, column: str, vocab: DataFrame, ways: DataFrame | None = None) -> DataFrame:
    """(column, relation): for each distinct non-null value the canonical relation of the same meaning, or `unmatched`.

    A value is folded to one form, freed of punctuation and of a `rel:` in front, and parted into its Latin and its
    Chinese words, which must agree where both are there. Each part is joined with the `entries` by `similar`. An exact
    check follows: the first character must stand and no more than a slip part them (two in a long value, none in a short
    one), since words as like as `uses` and `sues` mean different things. The nearest entry is kept, then the most similar,
    then the first relation by name. Denials and values of no meaning are `unmatched`.

    Values without letters, or with digits, are `unmatched`; an empty vocabulary leaves every value so. Each distinct value is
    worked on once, however many rows hold it, and kept for the steps that read it.
    """
    distinct = values.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    spaced = F.regexp_replace("value", r"(?<=\p{Ll})(?=\p{Lu})", " ")
    plain = durable(distinct.select("value", _plain(fold_key(spaced)).alias("plain")))
    latin, chinese = _script(F.col("plain"), r"\p{IsLatin}'"), _script(F.col("plain"), r"\p{IsHan}")
    chinese = F.regexp_replace(F.translate(chinese, " ", ""), "了$", "")
    parts = (
        plain.select("value", F.explode(F.array(F.struct(F.lit("latin").alias("script"), latin.alias("part")),
                                                 F.struct(F.lit("han").alias("script"), chinese.alias("part")))).alias("p"), "plain")
        .select("value", "plain", "p.*").where("part <> ''").where(~F.col("plain").rlike(r"\p{N}"))
        .withColumn("denied", F.col("part").rlike(_DENIED))
        .withColumn("compact", F.translate("part", " '", ""))
        .where("compact <> ''")
    )
    # A particle after a word of the other script, as in `contains了`, says nothing.
    parts = parts.where(~((F.col("script") == "han") & F.col("compact").isin("了", "于", "着", "的") & F.col("plain").rlike(r"\p{IsLatin}")))
    asked = durable(parts.where("NOT denied").select("compact").distinct().withColumn("tokens", _tokens("compact")))
    near = similar(asked, durable(entries(vocab, ways))).withColumn("away", _slips()).where("away IS NOT NULL")
    best = near.groupBy(F.col("compact").alias("c")).agg(F.min(F.struct("away", -F.col("jaccard"), "relation")).getField("relation").alias("relation"))
    found = parts.join(best, F.col("compact") == F.col("c"), "left").withColumn(
        "relation", F.when(F.col("denied") | F.col("relation").isNull(), UNMATCHED).otherwise(F.col("relation")))
    agreed = found.groupBy("value").agg(F.min("relation").alias("low"), F.max("relation").alias("high"))
    return plain.join(agreed, "value", "left").select(
        F.col("value").alias(column), F.expr(f"CASE WHEN low = high THEN low ELSE '{UNMATCHED}' END").alias("relation"))


def map_relations(triples: DataFrame, vocab: DataFrame, ways: DataFrame | None = None) -> DataFrame:
    """(triple_id, relation): every triple whose relation is not null and not literally in the vocabulary."""
    free = triples.select("triple_id", F.col("relation").alias("value")).where(F.col("relation").isNotNull()).join(
        vocab.select(F.col("relation").alias("value")), "value", "left_anti")
    return free.join(map_values(free, "value", vocab, ways), "value").select("triple_id", "relation")


def relation_report(triples: DataFrame, vocab: DataFrame) -> DataFrame:
    """(value, relation, n): each freely entered relation, what it was mapped to, and in how many triples it stands."""
    counted = triples.where(F.col("relation").isNotNull()).groupBy(F.col("relation").alias("value")).agg(F.count("*").alias("n"))
    free = durable(counted.join(vocab.select(F.col("relation").alias("value")), "value", "left_anti"))
    return free.join(map_values(free, "value", vocab), "value").select("value", "relation", "n")
