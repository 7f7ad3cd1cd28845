from datetime import datetime as dt
from itertools import product

from keelgraph.llm.duplicates import _score, best_choice, duplicate_pairs, name_key, origin_trust, rooted_records, slips, survivors
from keelgraph.llm.forms import fold
from keelgraph.llm.spellings import consistent_forms, same_looking


def test_name_keys():
    same = [("28号船坞检验", "28 号 船坞检验", "28#船坞检验", "第28号船坞检验", "No.28船坞检验", "「28号船坞检验」", "２８号船坞检验（AB）"), ("23kΩ围阱", "23千欧围阱", "23 kΩ 围阱"),
            ("LS42-IV型段", "LS42-Ⅳ型段", "ls42 iv型段", "LЅ42−IV型段"), ("Châvel-37座", "Chavel-37座", "CHÂVEL-37座"), ("bolted liner 146", "Bolted-Liner-146")]
    for group in same:
        assert len({name_key(n) for n in group}) == 1, group
    other = ["28号船坞检验", "29号船坞检验", "LS42-IV型段", "LS42-III型段", "LT42-IV型段", "座(PV-970)", "座(PV-971)", "座(PX-970)"]
    assert len({name_key(n) for n in other}) == len(other)
    assert name_key("") == "" and name_key("(AB)")


def test_slips():
    assert [(s, m, k) for s, m, k, _ in slips("轴承甲", "承轴甲")] == [("承轴甲", "轴承甲", "swap"), ("轴承甲", "承轴甲", "swap")]
    assert slips("甲乙丙", "丁戊己") == [] and slips("a b", "ab") == [("ab", "a b", "space", [])]
    assert {k for *_, k, _ in slips("舱盖座", "舱益座")} == {"盖益", "益盖"} or slips("舱盖座", "舱益座")


SCHEMA = "entity_id long, entity_name string, type array<string>, domain_relevance array<string>, summary string, chunk_ids array<long>, origin string, extracted_at timestamp, deleted_at timestamp, root string"


def records(spark, names, **extra):
    at = dt(2024, 1, 1)
    return spark.createDataFrame([(i, n, ["t"], ["g"], "s", [i], "manual", at, None, "clash") for i, n in enumerate(names)], SCHEMA)


def found(df):
    rooted = rooted_records(df, "entity_id", "entity_name")
    return {(r.entity_id_a, r.entity_id_b) for r in duplicate_pairs(rooted, survivors(rooted, least=2)).collect()}


def test_groups(spark):
    things = [f"{i}号{p}{c}检验" for i in range(12) for p in ("左舷", "右舷", "上层", "下层") for c in ("舱盖", "轴承", "底板")]
    slipped = {"3号左舷舱益检验": "3号左舷舱盖检验", "4号右舷舱益检验": "4号右舷舱盖检验", "5号上层承轴检验": "5号上层轴承检验", "6号下层底底板检验": "6号下层底板检验", "7 号 左舷轴承检验": "7号左舷轴承检验"}
    names = [*things, *slipped, None, "", things[0]]
    assert found(records(spark, names)) == {(names.index(m), names.index(s)) for s, m in slipped.items()} | {(0, len(names) - 1)}


def test_empty_and_hot(spark):
    assert rooted_records(records(spark, []).limit(0), "entity_id", "entity_name").count() == 0
    long = rooted_records(records(spark, ["长" * 50_000 + "名", "长" * 50_000 + "名甲", "x" * 100_000, "舵"]), "entity_id", "entity_name")
    assert long.count() == 4
    assert len(found(records(spark, ["船体"] * 300 + ["舵"]))) == 299


def test_many_keys_of_one_rest(spark):
    names = [f"检{chr(0x4E00 + i)}" for i in range(450)]
    assert rooted_records(records(spark, names), "entity_id", "entity_name").count() == 450


def test_best_choice_is_the_best():
    import random

    random.seed(2)
    score = lambda **more: {"score": random.choice([1.0, 2.0, 3.0, 5.0]), **more}
    for _ in range(300):
        names = [score(language=x, type=t) for x, t in random.sample(list(product(["zh", "en", None], [["a"], ["b"], None])), random.randint(0, 5))]
        classes = [score(type=t) for t in random.sample([["a"], ["b"], ["c"], None], random.randint(0, 4))]
        passages = [score(language=x) for x in random.sample(["zh", "en", None], random.randint(0, 3))]
        n, c, p, total = best_choice(names, classes, passages)
        assert abs(_score(n) + _score(c) + _score(p) - total) < 1e-9

        def fits(n, c, p, kept):
            either = lambda a, b, f: not a.get(f) or not b.get(f) or a[f] == b[f]
            return all(either(n, other, f) for f, other in (("language", p), ("type", c)) if f in kept)

        for kept in (("language", "type"), ("language",), ()):
            allowed = [_score(a) + _score(b) + _score(d) for a in names or [{}] for b in classes or [{}] for d in passages or [{}] if fits(a, b, d, kept)]
            if allowed:
                assert abs(max(allowed) - total) < 1e-9 and fits(n, c, p, kept)
                break


def chosen(df, **options):
    return {r.entity_id: r for r in survivors(rooted_records(df, "entity_id", "entity_name"), **options).collect()}


def test_survivors(spark):
    at = dt(2024, 1, 1)
    rows = [
        (1, "28号船坞检验", ["t"], ["general"], "信息待补充", None, "model_b", at, None, "x"),
        (2, "28#船坞检验", ["unknown", "u", "u"], ["general"], "一段完整的说明", [4, 3, 4], "manual", at, None, "x"),
        (3, "28 号船坞检验", [], [], "别的说明", [9], "model_a", at, dt(2024, 2, 1), "x"),
        (5, "28#船坞检验", ["u"], ["general"], "一段完整的说明", [3, 4], "rule", at, None, "x"),
        (4, None, None, None, None, None, None, None, None, "x"),
    ]
    got = chosen(spark.createDataFrame(rows, SCHEMA))
    assert set(got) == {1, 4} and got[1].records == 4
    assert (got[1].entity_name, got[1].summary, got[1].chunk_ids, got[1].type, got[1].domain_relevance) == ("28#船坞检验", "一段完整的说明", [3, 4], ["u"], ["general"])
    assert got[4].entity_name is None and got[4].summary is None and got[4].records == 1
    assert set(chosen(spark.createDataFrame(rows, SCHEMA), least=2)) == {1}
    assert chosen(spark.createDataFrame([], SCHEMA)) == {}


def test_dependencies(spark):
    at = dt(2024, 1, 1)
    row = lambda i, name, t, d, s, c: (i, name, t, d, s, c, "rule", at, None, "x")
    full = "该构件按图样要求完成检验并由工艺员在现场签字确认后方可进入下一道工序"
    # of the relevances beside one type, and the chunks beside one summary, the more trusted stands; the other type of one record is not mixed in
    rows = [row(1, "左舷底板检验", ["a"], ["g"], full, [1]), row(2, "左舷底板检验", ["a"], ["g"], full, [1]), row(3, "左舷底板检验", ["a"], ["h"], full, [2, 3]), row(4, "左舷底板检验", ["b"], ["k"], full[:9] + "…", [5])]
    got = chosen(spark.createDataFrame(rows, SCHEMA))[1]
    assert (got.type, got.domain_relevance, got.summary, got.chunk_ids) == (["a"], ["g"], full, [1])
    # the name's language decides that of the summary, though the other has more records
    rows = [row(1, "左舷底板检验", None, None, full, [1]), *[row(i, "左舷底板检验", None, None, "plate of the port side, welded and inspected on site", [2]) for i in (2, 3, 4)]]
    assert chosen(spark.createDataFrame(rows, SCHEMA))[1].summary == full


def test_survivors_of_planted_groups(spark):
    """Damaged copies of known records: the survivor has the values of the record they were made from."""
    import random

    rng, at = random.Random(11), dt(2024, 1, 1)
    rows, truth = [], {}
    for i in range(150):
        name, kind, chunks = f"{i}号{rng.choice('甲乙丙丁')}段{rng.choice(['舱盖', '轴承', '底板'])}检验", [rng.choice("pqrs")], [i, i + 1]
        said = f"第{i}号构件的说明" + "".join(rng.choice("焊接安装检验测量记录图样") for _ in range(40))
        truth[len(rows)] = (name, kind, said, chunks)
        for k in range(4):
            hurt = rng.random() if k else 1.0
            rows.append((len(rows), name if hurt > 0.2 else name.replace("号", " 号"), kind if hurt > 0.3 else [f"wrong {len(rows)}"], ["g"], said if hurt > 0.4 else rng.choice([said[:15] + "…", "信息待补充", None]), chunks if hurt > 0.4 else chunks[:1], rng.choice(["manual", "rule"]), at, None, "x"))
    got = chosen(spark.createDataFrame(rows, SCHEMA))
    right = [(got[i].entity_name, got[i].type, got[i].summary, got[i].chunk_ids) == v for i, v in truth.items()]
    assert len(got) == 150 and sum(right) >= 140


def test_trust_is_what_others_confirm(spark):
    rows = [(f"t{i}", o, f"n{i}", None, None, f"s{i}" if o != "c" else f"wrong {i}", None) for i in range(20) for o in "abc"]
    clean = spark.createDataFrame(rows, "root string, origin string, name string, type array<string>, relevance array<string>, summary string, chunks array<long>")
    got = {r.origin: r.trust for r in origin_trust(clean).collect()}
    assert got["a"] == got["b"] > 0.9 and 0.4 < got["c"] < 0.6


def test_same_looking(spark):
    names = ["AB1", "ＡＢ１", "A​B1", "АB1", "ab1", "m²", "m2", "加工", "加エ", "", None, "AB1", "x" * 5000]
    df = spark.createDataFrame([(n, "clash") for n in names], "name string, form string")
    pairs = {(r.name_a, r.name_b) for r in same_looking(df, "name").collect()}
    looks = [n for n in ("AB1", "ＡＢ１", "A​B1", "АB1")]
    assert pairs == {(a, b) for a in looks for b in looks if a < b} | {tuple(sorted(("加工", "加エ")))}
    assert same_looking(df.limit(0), "name").count() == 0
    hidden = ["\u200b" * (i + 1) for i in range(1201)]  # nothing visible: one class, cut into parts
    assert same_looking(spark.createDataFrame([(h,) for h in hidden], "name string"), "name").count() == 1201 * 1200 // 2
    assert fold("ＡⅣ²") == "aiv2" and fold("Straße  X") == "strasse x"
    forms = {r.name: (r.form, r.shown) for r in consistent_forms(df, "name").collect()}
    assert forms["ＡＢ１"] == ("ab1", "AB1") and forms["m²"] == ("m2", "m²") and forms[""] == ("", "") and None not in forms
