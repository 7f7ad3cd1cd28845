import numpy as np

from keelgraph.llm import abuse
from keelgraph.llm.abuse import BIGRAMS, TRIGRAMS, CharacterModel, passages, restore, score_documents, source_rates

TEXTS = ["what a moron and scumbag he is, retard", "你真是个傻逼蠢货王八蛋", "the hull plate is 12 mm thick and welded", "外板厚度为十二毫米，焊缝合格。"] * 50


def model():
    bi, tri = np.zeros(BIGRAMS, np.float32), np.zeros(TRIGRAMS, np.float32)
    codes = abuse._codes(TEXTS)
    np.add.at(bi, abuse._hashed(codes, 2, BIGRAMS), 1)
    np.add.at(tri, abuse._hashed(codes, 3, TRIGRAMS), 1)
    return CharacterModel(bi, tri)


def test_restore():
    m = model()
    for disguised, plain in (("m0r0n", "moron"), ("moooron", "moron"), ("s-c-u-m-b-a-g", "scumbag"), ("r e t a r d", "retard"), ("傻*逼", "傻逼"), ("王·八·蛋", "王八蛋")):
        assert restore(disguised, m) == plain
    for parted, plain in (("他是\n傻\n逼\n吧", "傻逼"), ("so s. c. u. m. b. a. g here", "scumbag"), ("m!o!r!o!n", "moron"), ("m0roon", "moron")):
        assert any(plain in restore(p, m) for p in passages(parted)), parted
    assert restore("12 mm thick", m) == "12 mm thick" and restore("", m) == ""


def test_gate_denies_nothing():
    import random

    random.seed(4)
    texts = ["".join(random.choice("abc01@$ .-*·船体") for _ in range(random.randint(0, 30))) for _ in range(3000)]
    told = abuse._suspicious(texts)
    assert all(t for t, text in zip(told, texts) if abuse._DISGUISED.search(text))
    texts = ["".join(random.choice("abC.!? \n\t船体\u3000\r。") for _ in range(random.randint(0, 30))) for _ in range(5000)]
    told = abuse._may_be_parted(texts)
    assert all(t for t, text in zip(told, texts) if abuse._PARTED.search(text)) and not told.all()


def test_passages():
    assert passages("") == [] and passages(" \n ") == []
    long = "x" * 1000
    assert "".join([p[: abuse.LONGEST - abuse.SHARED] for p in passages(long)])[:1000].startswith("x" * 900) and max(map(len, passages(long))) == abuse.LONGEST


def documents(n):
    good = ["外板厚度为{}毫米，焊缝合格。", "the hull plate is {} mm thick.", "第{}号分段完成打磨。", "this weld {} is rubbish, grind it out again."]
    bad = ["你真是个傻逼，滚出第{}车间。", "you moron {}, shut your mouth.", "第{}车间那帮蠢货，就该打死。"]
    rows = []
    for i in range(n):
        lines = [good[(i + k) % 4].format(i + k) for k in range(5)]
        if i % 6 == 0:
            lines.insert(i % 5, bad[i // 6 % 3].format(i))
        rows.append((i, "\n".join(lines), f"s{i % 3}", int(i % 6 == 0)))
    return rows


def test_held_out_accuracy(spark):
    rows = documents(600)
    docs = spark.createDataFrame([(i, t, s) for i, t, s, _ in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(r[0], r[3] if i % 40 else 1 - r[3]) for i, r in enumerate(rows[:400])], "doc_id long, toxic int")
    got = {r.doc_id: r.score >= 0.5 for r in score_documents(docs, labels).collect()}
    assert sum(got[r[0]] == (r[3] == 1) for r in rows[400:]) > 190


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(abuse, "PASSAGES", 50)
    rows = documents(120)
    docs = spark.createDataFrame([(i, t, s) for i, t, s, _ in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    got = abuse.training_passages(docs, labels, model())
    assert len(got) == 50 and set(got["toxic"]) == {0.0, 1.0} and got["passage"].str.len().max() <= abuse.LONGEST
    assert len(abuse.training_passages(docs, labels.limit(0), model())) == 0


def test_tables(spark):
    rows = documents(240)
    docs = spark.createDataFrame([(i, t, s, "clash") for i, t, s, _ in rows] + [(1000, None, "s0", "x"), (1001, "", None, "x"), (1002, " \n", None, "x")], "doc_id long, text string, source string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows] + [(0, 0), (5, None), (9999, 1)], "doc_id long, toxic int")
    scored = score_documents(docs, labels).cache()
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == 243 and got[1000].score == got[1001].score == got[1002].score == 0.0 and got[1000].passage is None
    right = sum((got[i].score >= 0.5) == (y == 1) for i, _, _, y in rows)
    assert right >= 225
    rates = {r.source: r for r in source_rates(scored).collect()}
    assert rates["s0"].documents == 81 and rates[None].found == 0
    assert score_documents(docs, labels.limit(0)).where("score >= 0.5").count() == 0
    assert score_documents(docs.limit(0), labels).count() == 0
