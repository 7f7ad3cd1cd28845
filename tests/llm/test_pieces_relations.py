import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelgraph.llm.pieces import cuts, split_oversized
from keelgraph.llm.relations import LEAST, SAID_AS, _tokens, entries, map_relations, map_values, relation_report, similar


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab 。，\n#-$😀é́"), max_size=900), st.integers(20, 80), st.integers(0, 15))
def test_cuts(text, limit, overlap):
    pieces = cuts(text, limit, overlap)
    assert "".join(text[a:b] for a, _, b in pieces) == text
    assert all(b - a + r <= limit and r <= overlap and r <= a for a, r, b in pieces)
    assert pieces[0][1] == 0 and (len(pieces) == 1) == (len(text) <= limit)
    assert all(p[0] - p[1] >= before[0] for before, p in zip(pieces, pieces[1:]))


def test_natural_boundaries():
    text = "x" * 300 + "\n\n## Title\n" + "y" * 300
    assert [a for a, _, _ in cuts(text)] == [0, 302]
    formula = "a" * 250 + "$$" + "b, " * 20 + "$$" + "c" * 250
    assert all(not 250 < a < 314 for a, _, _ in cuts(formula))
    assert all(b - a <= 462 for a, _, b in cuts("z" * 100_000))


def test_long_texts_with_spans_left_open():
    for text in ("<table " * 20_000, "![ " * 20_000, "$$ " * 20_001, "$ " * 20_001, "<table>x</table>" * 5_000):
        pieces = cuts(text)
        assert "".join(text[a:b] for a, _, b in pieces) == text and all(b - a + r <= 512 for a, r, b in pieces)


def test_long_images_stay_whole():
    text = "a" * 100 + "![" + "b" * 250 + "](" + "c" * 90 + ")" + "d" * 150
    assert [a for a, _, _ in cuts(text)] == [0, 445]
    held = "x" * 50 + "![](" + "c, " * 130 + "y(1).png)" + "z" * 200
    assert [a for a, _, _ in cuts(held)] == [0, 453]
    for text in ("![a](" * 20_000, "![a](b(" * 10_000, "![" * 30_000):
        assert "".join(text[a:b] for a, _, b in cuts(text)) == text


def test_marks_stay_with_their_character():
    text = "e" + "\u0301" * 280 + "e" + "\u0301" * 300
    assert [a for a, _, _ in cuts(text)] == [0, 281, *[a for a, _, _ in cuts(text)][2:]]


def test_split_table(spark):
    rows = [(1, "s" * 513, "x"), (2, None, "x"), (3, "", "x"), (4, "k" * 512, "x"), (1, "s" * 513, "x")]
    df = spark.createDataFrame(rows, "metadata long, chunk_content string, pieces string")
    got = split_oversized(df, "metadata", "chunk_content").collect()
    assert sorted((r.metadata, r.piece, r.pieces) for r in got) == [(1, 0, 2), (1, 0, 2), (1, 1, 2), (1, 1, 2), (3, 0, 1), (4, 0, 1)]
    assert split_oversized(df.limit(0), "metadata", "chunk_content").count() == 0


@pytest.fixture(scope="module")
def vocab(spark):
    labels = {"contains": "包含", "part_of": "组成部分", "uses": "使用", "acts_on": "作用于", "has": "具有", "inputs": "输入", "outputs": "输出", "belongs_to": "属于"}
    return spark.createDataFrame([(r, labels.get(r, "标签" + r), "d") for r in SAID_AS], "relation string, label_zh string, definition string")


def test_relations(spark, vocab):
    expected = {
        "Contains": "contains", "cotnains": "contains", "包含（contains）": "contains", " rel:Comprises.": "contains", "由…组成": "contains", "ｕｓｅｓ": "uses", "partOf": "part_of",
        "is a prat of": "part_of", "is_a": "belongs_to", "acts_no": "acts_on", "iputs": "inputs", "has output": "outputs", "包含了": "contains", "contains于": "contains",
        "not_contains": "unmatched", "不包含": "unmatched", "never uses": "unmatched", "does not contain": "unmatched", "sues": "unmatched", "R042": "unmatched", "type21": "unmatched",
        "": "unmatched", "?": "unmatched", "关系": "unmatched", "颁布": "unmatched", "使用 contains": "unmatched", "x" * 300_000: "unmatched", "isn't part of": "unmatched",
    }
    values = spark.createDataFrame([(v, "clash") for v in [*expected, "Contains", None]], "value string, relation string")
    got = {r.value: r.relation for r in map_values(values, "value", vocab).collect()}
    assert got == expected


def test_map_relations(spark, vocab):
    df = spark.createDataFrame([(1, "contains", "x"), (2, None, "x"), (3, "Uses", "x"), (4, "Uses", "x"), (5, "pays", "x")], "triple_id long, relation string, value string")
    assert sorted(tuple(r) for r in map_relations(df, vocab).collect()) == [(3, "uses"), (4, "uses"), (5, "unmatched")]
    assert {tuple(r) for r in relation_report(df, vocab).collect()} == {("Uses", "uses", 2), ("pays", "unmatched", 1)}
    assert map_relations(df.limit(0), vocab).count() == 0
    assert {r.relation for r in map_relations(df, vocab.limit(0)).collect()} == {"unmatched"}


def test_join_is_every_pair(spark, vocab):
    """The filters lose no pair of at least LEAST: against Jaccard of every value with every entry."""
    rng = random.Random(7)
    listed = entries(vocab).cache()
    said = [r.entry for r in listed.collect()]
    values = {"".join(rng.sample(w, len(w)) if rng.random() < 0.2 else w[: rng.randint(1, len(w))] + rng.choice(said)[: rng.randint(0, 4)]) for w in said for _ in range(3)}
    asked = spark.createDataFrame([(v,) for v in values], "compact string").withColumn("tokens", _tokens("compact")).cache()
    tokens, known = {r.compact: set(r.tokens) for r in asked.collect()}, {r.entry: set(r.tokens) for r in listed.collect()}
    expected = {(v, e) for v, a in tokens.items() for e, b in known.items() if len(a & b) / len(a | b) >= LEAST}
    assert {(r.compact, r.entry) for r in similar(asked, listed).collect()} == expected and len(expected) > len(said)


def test_ways_and_definitions(spark):
    vocab = spark.createDataFrame([("replaces", "替代", "主语取代宾语"), ("has", None, None)], "relation string, label_zh string, definition string")
    ways = spark.createDataFrame([("has", "comes with", 1), ("other", "costs", 1)], "relation string, said string, n int")
    values = spark.createDataFrame([(v,) for v in ("取代", "Comes With", "comes wiht", "costs", "possesses", "has")], "value string")
    got = {r.value: r.relation for r in map_values(values, "value", vocab, ways).collect()}
    assert got == {"取代": "replaces", "Comes With": "has", "comes wiht": "has", "costs": "unmatched", "possesses": "unmatched", "has": "has"}
    assert {r.relation for r in map_values(values, "value", vocab).where("value = 'possesses'").collect()} == {"has"}


def test_prefixes_lose_nothing(spark, vocab):
    """The join finds what comparing every value with every entry by one edit finds."""
    random.seed(1)
    said = [s for v in SAID_AS.values() for s in v.split("; ") if s.isascii() and len(s) > 5]
    cases = {}
    for s in said:
        i = random.randrange(1, len(s))
        cases[s[:i] + random.choice("abcdefgh") + s[i:]] = next(r for r, v in SAID_AS.items() if s in v.split("; "))
    got = {r.value: r.relation for r in map_values(spark.createDataFrame([(c,) for c in cases], "value string"), "value", vocab).collect()}
    wrong = {c for c, r in cases.items() if got[c] != r}
    assert len(wrong) <= len(cases) // 50, wrong
