import random

from pyspark.sql import functions as F

from keelgraph.operators import graph, kb, match, parse, repair, triples
from keelgraph.operators.ordinals import ordinal

MENTION = "entity_name string, type string, domain_relevance string, summary string, chunk_id long, ord long, rng long"
RECORD = "entity_name string, type array<string>, domain_relevance array<string>, summary string, chunk_ids array<long>, ord long"
TRIPLE = "subject string, relation string, object string, chunk_id string, n long"


def test_build_and_two_levels(spark):
    rows = [("e", t, "general", s, c, i, r) for i, (t, s, c, r) in enumerate([("x", "A", 1, 0), ("y", "B", 2, 0), ("x", "A", 1, 1), (None, "B", None, 1)])]
    df = spark.createDataFrame([*rows, (None, "x", "g", "s", 1, 9, 0)], MENTION)
    flat = kb.build(df, ["ord"]).collect()
    assert len(flat) == 1 and flat[0].type == ["x", "y"] and flat[0].chunk_ids == [1, 2] and flat[0].summary == "A | B | A | B"
    ranged = kb.merge(kb.build(df.repartition(3), ["ord"], ["rng"]), ["rng"]).first()
    assert ranged.summary == "A | B" and ranged.type == ["x", "y"]
    assert kb.build(df.limit(0), ["ord"]).count() == 0


def test_merge_load_lookup_statistics(spark):
    df = spark.createDataFrame([("a", ["x", "x"], None, "S", [1], 0), ("b", [], ["g"], None, None, 1), ("a", ["y"], ["g"], "T", [1, 2], 2)], RECORD)
    a = kb.lookup(kb.merge(df, ["ord"]), "a").first()
    assert (a.type, a.domain_relevance, a.summary, a.chunk_ids) == (["x", "y"], ["g"], "S | T", [1, 2])
    assert kb.lookup(df, "none").count() == 0
    loaded = {r.entity_name: (r.ord, r.summary) for r in kb.load(df, "ord").collect()}
    assert loaded == {"a": (0, "T"), "b": (1, None)}
    s = kb.statistics(df).first()
    assert (s.entities, s.chunk_references) == (3, 3)
    assert {(r.type, r.entities) for r in kb.type_histogram(df).collect()} == {("x", 2), ("y", 1)}
    assert tuple(kb.statistics(df.limit(0)).first()) == (0, 0)


def matched(df):
    return sorted((r.k, r.place, r.entity_name) for r in df.collect())


def test_match_order(spark):
    texts = spark.createDataFrame([(1, "she sells"), (2, None), (3, "")], "k long, t string")
    names = spark.createDataFrame([(n,) for n in ("he", "she", "sell", "ells", "s", "", "she")], "entity_name string")
    assert [n for _, _, n in matched(match.matches(texts, names, "k", "t"))] == ["s", "she", "he", "sell", "ells"]
    assert [n for _, _, n in matched(match.matches(texts, names, "k", "t", n=1))] == ["s", "she", "he", "sell", "ells"]
    assert match.matches(texts, names.limit(0), "k", "t").count() == 0
    assert match.matches(texts.limit(0), names, "k", "t").count() == 0


def by_nested_loop(texts, names):
    """(key, place, name) by looking for every name in every text."""
    out = []
    for r in texts.collect():
        found = {n.entity_name for n in names.collect() if n.entity_name and n.entity_name in r.t}
        out += [(r.k, i + 1, n) for i, n in enumerate(sorted(found, key=lambda n: (r.t.index(n) + len(n), -len(n))))]
    return sorted(out)


def test_match_is_the_nested_loop(spark):
    random.seed(3)
    word = lambda n: "".join(random.choice("ab船体😀") for _ in range(n))
    texts = spark.createDataFrame([(i, word(random.randint(0, 40))) for i in range(60)], "k long, t string")
    names = spark.createDataFrame([(word(random.randint(1, 6)),) for _ in range(80)], "entity_name string")
    expected = by_nested_loop(texts, names)
    assert matched(match.matches(texts, names, "k", "t")) == expected
    for n in (1, 2, 3):
        assert matched(match.matches(texts, names, "k", "t", n=n)) == expected


def test_match_of_texts_with_one_key(spark):
    texts = spark.createDataFrame([(1, "xx ab"), (1, "ab"), (None, "ab")], "k long, t string")
    names = spark.createDataFrame([("ab",), ("b",), ("xx a",)], "entity_name string")
    assert matched(match.matches(texts.where("k IS NOT NULL"), names, "k", "t")) == [(1, 1, "ab"), (1, 2, "b"), (1, 3, "xx a")]


def test_context(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, "zz")], "k long, t string")
    names = spark.createDataFrame([("a", ["p", "q", "r", "s"], "x" * 120), ("b", None, None)], "entity_name string, type array<string>, summary string")
    got = {r.k: r.context for r in match.context(texts, match.matches(texts, names, "k", "t"), names, "k").collect()}
    assert got == {1: "- a (p, q, r): " + "x" * 100 + "...\n- b (): ...", 2: "未找到相关实体"}
    only = match.context(texts, match.matches(texts, names, "k", "t"), names, "k", most=1).where("k = 1").first().context
    assert only.startswith("- a") and "\n" not in only


def parsed(spark, raw, kind, **options):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "chunk_id long, raw string")
    return {int(r.chunk_id): r for r in parse.parse_output(df, kind, **options).collect()}


def test_parse_entities(spark):
    item = '{"entity_name":"a","type":"t","domain_relevance":"g","summary":"s","chunk_id":99,"more":1}'
    got = parsed(spark, [f"<think>\nno [\n</think>\n```json\n[{item}]\n```", "[1] x", "", None, "{}", f'[{item}, 5, {item.replace(chr(34) + "t" + chr(34), "5")}]',
                         '[{"entity_name":"a"}]', item.join(["[", "]"]).replace('"s"', r'"\xe9 \q \u12"'), '[{"entity_name":"八"字"}]'], "entities")
    assert got[0].status == "ok" and [tuple(e) for e in got[0].entities] == [("a", "t", "g", "s", "0")]
    assert [got[i].status for i in range(1, 9)] == ["rejected", "empty", "empty", "rejected", "ok", "ok", "repaired", "rejected"]
    assert len(got[5].entities) == 1 and got[6].entities == [] and got[7].entities[0].summary == "é q \\u12"


def test_repair_paths_and_observation(spark):
    item = '[{"entity_name":"a","type":"t","domain_relevance":"g","summary":"%s","chunk_id":"9"}]'
    raw = [item % x for x in (r"\xE9\x41", r"1\.5 \d", r"\u12", r"\uZZ", "fine")] + ["<think>x</think>", item[:-3]]
    df = spark.createDataFrame(list(enumerate(raw)), "chunk_id long, raw string").withColumn("more", F.concat(F.lit("m"), "chunk_id"))
    rows, seen = parse.observed(parse.parse_output(df, "entities", keep=["more"]))
    got = {int(r.chunk_id): r for r in rows.collect()}
    assert [got[i].status for i in range(7)] == ["repaired"] * 4 + ["ok", "empty", "rejected"] and got[3].more == "m3"
    assert [got[i].entities[0].summary for i in range(5)] == ["éA", "1.5 d", "\\u12", "\\uZZ", "fine"]
    assert seen.get == {"ok": 1, "repaired": 4, "empty": 1, "rejected": 1}
    assert {r.more for r in parse.parsed_entities(parse.parse_output(df, "entities", keep=["more"])).collect()} == {f"m{i}" for i in range(5)}


def test_parse_triples(spark):
    raw = ['{"triples":[{"subject":"a","relation":"r","object":"b","chunk_id":"x"},{"subject":5,"relation":"r","object":"b"}]}', "{}", "[]",
           '{"triples":[{"subject":"a","predicate":"r","object":"b"}],"entities":[]}', '{"triples":[],"triples":[{"subject":"z","relation":"r","object":"b"}]}']
    got = parsed(spark, raw, "triples")
    assert [tuple(t) for t in got[0].triples] == [("a", "r", "b", "0")] and got[1].status == "ok" and got[2].status == "rejected" and got[3].triples == []
    assert got[4].triples[0].subject == "z"
    joint = parsed(spark, raw, "joint", accept_predicate=True)
    assert [tuple(t) for t in joint[3].triples] == [("a", "r", "b", "3")]
    df = spark.createDataFrame([(0, raw[0]), (1, "x")], "chunk_id long, raw string")
    out = parse.parse_output(df, "triples")
    assert parse.parsed_triples(out).count() == 1 and parse.parsed_entities(out).count() == 0
    assert [r.chunk_id for r in parse.rejects(out).collect()] == ["1"]


def test_union_and_vocabulary(spark):
    t = spark.createDataFrame([("a", "r", "b", "1", 0), ("a", "r", "b", "1", 1), ("a", None, "b", None, 2)], TRIPLE)
    assert triples.union(t, t.limit(0), t).count() == 6
    report = {r.relation: (r.in_vocabulary, r.triples, r.subjects) for r in triples.vocabulary_report(t, spark.createDataFrame([("r",), ("q",)], "relation string")).collect()}
    assert report == {"r": (True, 2, 1), None: (False, 1, 1)}
    assert [(r.triples, r.distinct_triples) for r in triples.counts_by(t, "object").collect()] == [(3, 2)]


def test_enrich_nodes_edges(spark):
    known = spark.createDataFrame([(n, ["t"], ["g"], "s", [1], i) for i, n in enumerate("AB")], RECORD)
    t = spark.createDataFrame([("C", "has", "A", "7", 0), ("A", "has", "C", "7", 1), ("D", "has", "A", "9", 2), ("A", "x", None, "1", 3), ("D", "x", "A", None, 4)], TRIPLE)
    enriched = graph.enrich(known, t.repartition(3), "ord", "n")
    node = {r["name"]: r for r in graph.nodes(enriched).collect()}
    assert {n: r["id:ID"] for n, r in node.items()} == {"A": "entity_1", "B": "entity_2", "C": "entity_3", "D": "entity_4"}
    assert [node[n].relation_chunk_id for n in "ABCD"] == ["7|9|1|unknown", "unknown", "7", "9|unknown"]
    assert node["C"][":LABEL"] == "Entity;Unknown" and node["C"].summary == "信息待补充" and node["C"].entity_chunk_id == "unknown" and node["A"].entity_chunk_id == "1"
    edges = graph.edges(t, graph.nodes(enriched)).collect()
    assert len(edges) == 4 and (edges[0][":START_ID"] is not None)
    assert {(r.label, r.nodes) for r in graph.label_distribution(graph.clean_labels(graph.nodes(enriched))).collect()} == {("t", 2), ("Unknown", 2)}
    assert graph.nodes(graph.enrich(known.limit(0), t.limit(0), "ord", "n")).count() == 0


def test_upserts(spark):
    schema = "id string, labels array<string>, props map<string,string>"
    old = spark.createDataFrame([("1", ["E"], {"a": "x", "b": "y"}), ("2", ["E"], {})], schema)
    new = spark.createDataFrame([("1", ["F"], {"a": "z"}, 1), ("1", ["G"], {"a": "w"}, 2), ("3", [], {"c": "q"}, 3), (None, [], {}, 4)], schema + ", o long")
    got = {r.id: (r.labels, r.props) for r in graph.upsert_nodes(old, new, "o").collect()}
    assert got == {"1": (["E", "F", "G"], {"a": "w", "b": "y"}), "2": (["E"], {}), "3": ([], {"c": "q"})}
    edge = "start string, end string, type string"
    have, more = spark.createDataFrame([("1", "2", "r")], edge), spark.createDataFrame([("1", "2", "r"), ("1", "3", "r"), ("1", "3", "r"), ("9", "1", "r")], edge)
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    assert sorted(tuple(r) for r in graph.upsert_edges(have, more, ids).collect()) == [("1", "2", "r"), ("1", "3", "r")]
    assert tuple(graph.import_counts(new, more, ids).first()) == (3, 3)
    props = graph.properties(spark.createDataFrame([("1", "n", None, "Entity;A; ")], "`id:ID` string, name string, summary string, `:LABEL` string")).first()
    assert props.props == {"name": "n"} and props.labels == ["Entity", "A"]


def test_fixes(spark):
    edges = spark.createDataFrame([(i, "s", f"r{i}", "o") for i in range(3)], "ordinal long, subject string, relation string, object string")
    fixes = spark.createDataFrame([(0, "s", "zero", "o", 0), (1, "s", "first", "o", 1), (1, "t", "last", "o", 2), (4, "s", "beyond", "o", 3)], "index long, subject string, relation string, object string, n long")
    got = {r.ordinal: (r.relation, r.fixed) for r in repair.apply_fixes(edges, fixes, "ordinal", "n").collect()}
    assert got == {0: ("last", True), 1: ("r1", False), 2: ("r2", False)}
    assert sorted(r["index"] for r in repair.fixes_out_of_range(edges, fixes, "ordinal").collect()) == [0, 4]
    assert [r.fix_subject for r in repair.fix_mismatches(edges, fixes, "ordinal").collect()] == ["t"]
    lines = spark.createDataFrame([("﻿\"index,subject,relation,object\"",), ('"7,a,r,x,y"',), ('  "8,"b", r ,c"  ',), ('"bad"',), ("",), (None,), ('"x,a,b,c"',)], "value string")
    assert sorted(tuple(r) for r in repair.text_to_fixes(lines).collect()) == [(7, "a", "r", "x,y"), (8, "b", "r", "c")]
    quoted = spark.createDataFrame([('"9,a,r,x,y"',), ('"10,"a,b",r,"c ""d"""',), ("11,a,r," + ",".join(map(str, range(43))),), ("12,a,r",), ("13,,r,",)], "value string")
    got = {r["index"]: (r.subject, r.relation, r.object) for r in repair.csv_to_fixes(quoted).collect()}
    assert got[9] == ("a", "r", "x,y") and got[10] == ("a,b", "r", 'c "d') and got[11][2] == ",".join(map(str, range(43)))
    assert 12 not in got and got[13] == ("", "r", "")


def test_ordinals(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)))
    placed = ordinal(df, ["g", "id"]).orderBy("ordinal").collect()
    assert [r.ordinal for r in placed] == list(range(500)) and [(r.g, r.id) for r in placed] == sorted((r.g, r.id) for r in placed)
    assert ordinal(df.limit(0), ["id"]).count() == 0
