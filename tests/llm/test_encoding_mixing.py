import base64
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelgraph.llm.encoding import PATTERN, encode, encoder, token_length, vocabulary
from keelgraph.llm.mixing import fit_budget, mix, mix_report, plan, seeded_rank, sized

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary()), reason="no vocabulary")


def local():
    with open(vocabulary(), "rb") as file:
        return encoder(("test", file.read()))


def test_seeded_ranks(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") > 4, F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7))))
    ranks = {}
    for r in seeded_rank(df, ["g"], "id", 1).collect():
        ranks.setdefault(r.g, []).append(r["rank"])
    assert all(sorted(x) == list(range(len(x))) for x in ranks.values()) and len(ranks[None]) == 5
    assert seeded_rank(df.limit(0), ["g"], "id", 1).count() == 0


def test_budget_beyond_the_window():
    used = fit_budget(np.array([1_000_000, 5_000_000]), np.array([0, 3]), 4_000_000, window=100)
    assert used.tolist() == [0, 0]


@pytest.fixture(scope="module")
def peer():
    tiktoken = pytest.importorskip("tiktoken")
    with open(vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("peer", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=200))
def test_any_text(text, peer):
    ids, offsets = local().encode([text, None, "", text])
    assert offsets.tolist() == [0, len(ids) // 2, len(ids) // 2, len(ids) // 2, len(ids)]
    assert ids[: offsets[1]].tolist() == peer.encode_ordinary(text)
    assert peer.decode(ids[: offsets[1]].tolist()) == text


def test_long_pieces(peer):
    random.seed(0)
    for text in ("a" * 30_000, "".join(random.choice("abcdefghij") for _ in range(20_000)), "船体" * 5_000, "<|endoftext|>", "é" * 999):
        ids, _ = local().encode([text])
        assert ids.tolist() == peer.encode_ordinary(text)


def test_table(spark, peer):
    rows = [(1, "船体 hull", 9), (2, None, 9), (3, "", 9), (1, "船体 hull", 9), (4, "x" * 5000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = encode(df, "doc_id", "text").collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((k, peer.encode_ordinary(t or "")) for k, t, _ in rows)
    assert encode(df.limit(0), "doc_id", "text").count() == 0
    assert {r.doc_id: r.n for r in df.select("doc_id", token_length(spark)("text").alias("n")).collect()} == {k: len(peer.encode_ordinary(t or "")) for k, t, _ in rows}


def test_fit_budget():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 8), False))
        supply, budget = rng.integers(0, 6, len(lengths)), int(rng.integers(0, 300))
        used = fit_budget(lengths, supply, budget)
        assert (used >= 0).all() and (used <= supply).all() and (lengths * used).sum() <= budget
        reach = {0}
        for n, c in zip(lengths, supply):
            reach = {r + int(n) * k for r in reach for k in range(c + 1)}
        # the search is exact over what the first pass leaves open, so it may stay below the best by little
        assert (lengths * used).sum() >= max(r for r in reach if r <= budget) - lengths.max()
    lengths = np.arange(10, 400)
    assert (lengths * fit_budget(lengths, np.full(390, 50), 1_234_567, window=500)).sum() == 1_234_567


def test_mix(spark):
    texts = [(i, " ".join(["word"] * (i % 9 + 1)), "abc"[min(i % 6, 2)]) for i in range(300)] + [(1000, None, "a"), (1001, "", "b"), (1002, "word", None), (1003, "word", "other")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumn("uses", F.lit("clash"))
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.3, 2), ("c", 0.1, 1), ("none", 0.1, 1)], "source string, target_share double, max_repeats int")
    sizes = sized(docs)
    planned = plan(sizes, targets)
    got = mix(sizes, planned).collect()
    repeats = {"a": 3, "b": 2, "c": 1}
    assert all(0 < r.uses <= repeats[r.source] for r in got) and len({r.doc_id for r in got}) == len(got)
    total = sum(r.tokens * r.uses for r in got)
    shares = {s: sum(r.tokens * r.uses for r in got if r.source == s) / total for s in repeats}
    assert all(abs(shares[s] - w / 0.9) < 0.02 for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.1)))
    report = {r.source: r for r in mix_report(sizes, planned, targets).collect()}
    assert report["none"].tokens == 0 and abs(report["a"].actual_share - shares["a"]) < 1e-9
    assert sorted(map(tuple, mix(sizes, planned).collect())) == sorted(map(tuple, got))
    empty = sized(docs.limit(0))
    assert mix(empty, plan(empty, targets)).count() == 0
    assert {r.actual_share for r in mix_report(empty, plan(empty, targets), targets).collect()} == {0.0}
