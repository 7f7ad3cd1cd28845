import random
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelgraph.functions.lookalike import look
from keelgraph.functions.text import clean_label, fold_summaries, strip
from keelgraph.operators import chunking, extract, markdown


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


def test_look():
    assert look("ＡＢ​１") == "AB1" and look("Ѕеñаr") == "Señar" and look("加エ坡ロ") == "加工坡口"
    assert look("Réstal") == "Réstal" and look("672㎜") == "672mm" and look("Ⅳ") == "IV" and look("ﬂange") == "flange"
    assert look("m²") != look("m2") and look("㎡") == "m²" and look("A") != look("a") and look("e") != look("é")
    assert look("a b") == look("a b") == look("a　b") != look("ab")
    assert look("") == "" and look("​") == ""


def test_headings(spark):
    level = lambda v: one(spark, markdown.level_headings, v)
    assert level("# 1.1 A") == "## 1.1 A" and level("# 1.1.5 B") == "### 1.1.5 B" and level("# 1.2\n\nC") == "## 1.2 C"
    assert level("# 1 A\ntext # 1.1 B") == "# 1 A\ntext # 1.1 B" and level(None) is None and level("") == ""
    demote = lambda v: one(spark, markdown.demote_headings, v)
    assert demote("  # X\n# 第1章 X\n## X\n#X") == "#### X\n# 第1章 X\n## X\n#X"
    df = spark.createDataFrame([(1, "# 修改\n# 第二章 保留\ntext"), (2, None), (3, "")], "k long, t string")
    assert {(r.action, r.headings) for r in markdown.demotion_counts(df, "k", "t").collect()} == {("modify", 1), ("retain", 1)}
    assert markdown.heading_preview(df.limit(0), "k", "t").count() == 0


def test_images(spark):
    df = spark.createDataFrame([(1, "![](images/9fe0.jpg)\n图1.3-2 a b\nsee images/9fe0.jpg"), (2, "![](images/aa.png)\nno caption"), (3, None)], "k long, t string")
    pairs = markdown.image_captions(df, "k", "t")
    assert [(r.old_name, r.new_name) for r in pairs.collect()] == [("9fe0.jpg", "a_b.jpg")]
    new = {r.k: (r.new_text, r.renamed) for r in markdown.rewrite_images(df, pairs, "k", "t").collect()}
    assert new[1] == ("![](images/a_b.jpg)\n图1.3-2 a b\nsee images/a_b.jpg", 1) and new[2][1] == 0 and new[3] == (None, 0)
    none = spark.createDataFrame([], "old_name string")
    assert markdown.rewrite_images(df, pairs, "k", "t", none).where("renamed > 0").count() == 0
    twice = spark.createDataFrame([(1, "a.jpg", "x.jpg"), (2, "b.jpg", "x.jpg")], "k long, old_name string, new_name string")
    assert [(r.new_name, r.images) for r in markdown.caption_collisions(twice).collect()] == [("x.jpg", 2)]
    assert one(spark, markdown.is_hash_name, "A" * 64 + ".jpg") and not one(spark, markdown.is_hash_name, "a" * 63 + ".jpg")


def test_strip_and_labels(spark):
    assert one(spark, strip, "　 a b\xa0\n") == "a b"
    assert one(spark, clean_label, None) == "Unknown" and one(spark, clean_label, "Entity;焊接 A|部件") == "焊接" and one(spark, clean_label, "Entity;a-b é") == "abé"


def test_summary_fold(spark):
    fold_ = lambda v: spark.createDataFrame([(v,)], "v array<string>").select(fold_summaries(F.col("v"))).first()[0]
    assert fold_(["A", "A", "B", "B", "A"]) == "A | B | B | A"
    assert fold_(["A", "A", "B", "A"]) == "A | B | A" and fold_(["A | B", "A | B"]) == "A | B" and fold_(["A"]) == "A"


text = st.text(st.sampled_from("ab$ \n#。，表<table>/字{}"), max_size=300)


@settings(max_examples=200, deadline=None)
@given(text)
def test_protection_is_undone(t):
    assert chunking.restore(*chunking.protect(t)) == t


@settings(max_examples=200, deadline=None)
@given(text, st.integers(5, 40), st.integers(0, 4))
def test_chunks_keep_the_text(t, size, overlap):
    chunks = chunking.split(t, size, overlap)
    assert all(c and len(c) <= size for c in chunks)
    assert "".join(sorted(set("".join(chunks)))) == "".join(sorted({c for c in t if not c.isspace()} | {c for c in "".join(chunks) if c.isspace()}))


def test_chunking(spark):
    for long in ("<table " * 20_000, "$ " * 20_001, "</table>" * 5_000):
        assert chunking.restore(*chunking.protect(long)) == long
    assert chunking.restore(*chunking.protect("x <table><td>$a$</td></table> y $b$")) == "x <table><td>$a$</td></table> y $b$"
    assert chunking.split("a" * 30 + "\n\n" + "b" * 30, 40, 5) == ["a" * 30, "b" * 30]
    df = spark.createDataFrame([(2, "第一段\n\n" + "句" * 600), (1, "$" + "x" * 600 + "$"), (3, None), (4, " \n")], "k long, t string")
    pieces = chunking.chunk_texts(df, "k", "t").collect()
    assert {p.k for p in pieces} == {1, 2} and [len(p.chunk_content) for p in pieces if p.k == 1] == [602]
    numbered = chunking.number_chunks(chunking.chunk_texts(df, "k", "t").withColumn("source", F.lit(None).cast("string")), ["k", "pos"], "source").collect()
    assert sorted(r.metadata for r in numbered) == list(range(len(numbered))) and {r.source for r in numbered} == {""}


def test_chinese_sentences():
    sentences = ["船体外板厚度检验"] * 200
    chunks = chunking.split("。".join(sentences))
    assert len(chunks) > 3 and all(len(c) <= 512 and c.lstrip("。").split("。")[0] == sentences[0] and c.endswith(sentences[0]) for c in chunks)
    mixed = chunking.split("甲" * 300 + "！" + "乙" * 300 + "？" + "丙" * 300 + "；" + "丁" * 300)
    assert mixed == ["甲" * 300, "！" + "乙" * 300, "？" + "丙" * 300, "；" + "丁" * 300]
    # each mark is a separator of its own: the one that comes first in the list is used, a finer one only within its parts
    assert chunking.split("a；b。c" * 10, 12, 0)[0] == "a；b。ca；b"


def test_separators_one_by_one():
    """Against a plain re-statement of splitting by the first separator that occurs."""

    def plain(text, size, separators):
        first = next(i for i, s in enumerate(separators) if not s or s in text)
        mark = separators[first]
        parts = [p for p in ([text.split(mark)[0]] + [mark + p for p in text.split(mark)[1:]] if mark else list(text)) if p]
        out, held = [], ""
        for p in parts:
            if len(p) >= size:
                out, held = out + [held], ""
                out += plain(p, size, separators[first + 1 :]) if separators[first + 1 :] else [p]
            elif len(held) + len(p) > size:
                out, held = out + [held], p
            else:
                held += p
        return [c.strip() for c in [*out, held] if c.strip()]

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("船体板。！？；\n# ab") for _ in range(rng.randint(0, 120)))
        assert chunking.split(text, 15, 0) == plain(text, 15, chunking.SEPARATORS)


def test_batches_and_prompts(spark):
    total = spark.createDataFrame([(45,)], "total long")
    assert [(r.first, r.end) for r in extract.batches(total, 20).orderBy("first").collect()] == [(0, 20), (20, 40), (40, 45)]
    assert extract.batches(spark.createDataFrame([(0,)], "total long"), 20).count() == 0
    prompt = spark.range(1).select(extract.render("{a}-{b}", a=F.lit("x"), b=F.lit(None).cast("string"))).first()[0]
    assert prompt == "x-"
    chunks = spark.createDataFrame([(" 　", "s", 0), (None, None, 1), (" x ", None, 2)], "chunk_content string, source string, metadata long")
    assert [(r.chunk_id, r.source, r.text) for r in extract.extractable(chunks).collect()] == [(2, "", "x")]
    assert extract.chunk_range(chunks, 1, 2).count() == 1


def test_extractors(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "q")], "chunk_id long, prompt string")
    stored = spark.createDataFrame([(1, "raw")], "chunk_id long, raw string")
    assert {tuple(r) for r in extract.Replay(stored).extract(prompts).collect()} == {(1, "p", "raw", None), (2, "q", None, "no stored output")}
    assert {(r.prompt, r.error) for r in extract.Http("", retries=0).extract(prompts).collect()} == {("p", "no endpoint"), ("q", "no endpoint")}


def test_rule_reads_the_prompt(spark):
    known = '[{"entity_name":"a"},{"entity_name":"b"},{"entity_name":"c"}]'
    prompt = extract.render(extract.RELATION_PROMPT, entities=F.col("known"), chunk_id=F.col("chunk_id"), text=F.lit("t"))
    asked = spark.createDataFrame([(1, known), (2, "[]"), (3, "none")], "chunk_id long, known string").select("chunk_id", prompt.alias("prompt"))
    got = {r.chunk_id: (r.raw, r.error) for r in extract.Rule().extract(asked).collect()}
    pair = '{"subject":"%s","relation":"co_occurs_with","object":"%s"}'
    assert got[1] == ('{"triples":[' + pair % ("a", "b") + "," + pair % ("b", "c") + "]}", None)
    assert got[2] == ('{"triples":[]}', None) and got[3] == (None, "no known entities")


def test_http_asks_several_at_once(spark):
    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(500 if body == b"bad" else 200)
            self.end_headers()
            self.wfile.write(b"re: " + body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    prompts = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}") for i in range(12)], "chunk_id long, prompt string")
    got = {r.chunk_id: (r.raw, r.error) for r in extract.Http(f"http://127.0.0.1:{server.server_port}", retries=2, at_once=4).extract(prompts).collect()}
    server.shutdown()
    assert got[0] == ("re: p0", None) and got[11] == ("re: p11", None) and got[3][0] is None and "500" in got[3][1]


def test_missing_ordinals(spark):
    chunks = spark.createDataFrame([("a", 0, 5), ("b", 1, None), ("c", 2, None)], "chunk_content string, line long, metadata long")
    assert {(r.chunk_content, r.metadata) for r in extract.with_ordinals(chunks, ["line"]).collect()} == {("a", 5), ("b", 1), ("c", 2)}


def test_history(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", None)], "c long, turn long, role string, content string")
    assert extract.history(turns, "c", "turn").first().shown == "1. user: hi\n" + "-" * 20 + "\n2. assistant: "
    assert extract.cleared(turns).count() == 1
