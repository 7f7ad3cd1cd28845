from datetime import datetime as dt

from keelgraph.functions.bloom import bloom_filter
from keelgraph.operators.orphans import orphan_references, orphan_report

FIELDS = ["subject", "object"]
TRIPLES = "triple_id long, subject string, object string, loaded_at timestamp, deleted_at timestamp, key string"
ENTITIES = "entity_id long, entity_name string, loaded_at timestamp, deleted_at timestamp, id long"


def day(d, m=1):
    return dt(2024, m, d)


def found(spark, triples, entities):
    t = spark.createDataFrame([(i, s, o, at, None, "x") for i, (s, o, at) in enumerate(triples)], TRIPLES)
    e = spark.createDataFrame([(i, n, a, b, 1) for i, (n, a, b) in enumerate(entities)], ENTITIES)
    return t, orphan_references(t, e, "triple_id", FIELDS, "entity_name")


def rows(df):
    return {(r.triple_id, r.endpoint, r.reason) for r in df.collect()}


def test_reasons(spark):
    entities = [
        ("a", day(1), None),
        ("gone", day(1), day(5)), ("gone", day(8), day(10)),
        ("later", day(20), None),
        ("back", day(1), day(3)), ("back", day(15), None),
        ("never", day(9), day(9)),
        (None, day(1), None), ("", day(1), None),
    ]
    triples = [
        ("a", "gone", day(2)), ("a", "gone", day(5)), ("a", "gone", day(9)), ("a", "gone", day(30)), ("a", "later", day(19)),
        ("nobody", "later", day(20)), ("back", "back", day(4)), (None, "", day(4)), ("never", "a", day(12)), ("ａ", "а", day(3)),
        ("a", "gone", None), ("gone", "gone", dt(2024, 2, 1)),
    ]
    _, df = found(spark, triples, entities)
    assert rows(df) == {
        (1, "object", "late"), (3, "object", "deleted"), (4, "object", "late"), (5, "subject", "missing"), (6, "subject", "late"),
        (6, "object", "late"), (8, "subject", "deleted"), (10, "subject", "deleted"), (10, "object", "deleted"),
        (11, "subject", "deleted"), (11, "object", "deleted"),
    }


def test_against_nested_loops(spark):
    import random

    random.seed(5)
    names = [f"n{i}" for i in range(12)]
    entities = [(random.choice(names), day(random.randint(1, 25), random.randint(1, 3)), random.choice([None, day(random.randint(1, 25), random.randint(1, 4))])) for _ in range(60)]
    # one name holds a third of the triples
    triples = [(random.choice(names + ["x"]) if random.random() > 0.33 else "n0", random.choice(names), day(random.randint(1, 28), random.randint(1, 4))) for _ in range(400)]
    expected = set()
    for i, (s, o, at) in enumerate(triples):
        for endpoint, name in (("subject", s), ("object", o)):
            match = [(a, b) for n, a, b in entities if n == name]
            if not any(a <= at and (b is None or b > at) for a, b in match):
                expected.add((i, endpoint, "missing" if not match else "late" if any(a > at for a, _ in match) else "deleted"))
    t, df = found(spark, triples, entities)
    assert rows(df) == expected
    report = orphan_report(df, t, "triples", FIELDS).collect()
    assert sum(r.n for r in report) == len(expected)
    assert {r.table for r in report} == {"triples"}


def test_empty_tables(spark):
    t, df = found(spark, [("a", "b", day(1))], [])
    assert rows(df) == {(0, "subject", "missing"), (0, "object", "missing")}
    t, df = found(spark, [], [("a", day(1), None)])
    assert rows(df) == set() and orphan_report(df, t, "triples", FIELDS).count() == 0


def test_bloom_never_denies_a_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    passes = bloom_filter(keys, "k", max_bits=1 << 16)
    from pyspark.sql import functions as F

    assert keys.where(passes(F.col("k"))).count() == 3000
    others = spark.range(3000).selectExpr("concat('o', id) AS k")
    assert others.where(passes(F.col("k"))).count() < 300
