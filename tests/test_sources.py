import json
import os

from pyspark.sql import functions as F

from keelgraph import session
from keelgraph.schemas import ENTITY, FIX, TRIPLE
from keelgraph.sources import files
from keelgraph.streaming import incremental


def test_markdown_and_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_bytes("# T\r\nbody\r\n".encode())
    (tmp_path / "y.txt").write_text("no")
    got = files.read_markdown(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].text == "# T\nbody\n" and got[0].source.endswith("a/x.md")
    assert [(r.line_no, r.line) for r in files.read_lines(spark, str(tmp_path / "a" / "x.md")).orderBy("line_no").collect()] == [(0, "# T"), (1, "body")]
    assert {(r.name, r.length) for r in files.list_files(spark, str(tmp_path), "*.md").collect()} == {("x.md", 11)}


def test_json_arrays_and_rejects(spark, tmp_path):
    (tmp_path / "entities_0_1.json").write_text(json.dumps([{"entity_name": "a", "type": ["t"], "chunk_ids": [1]}]))
    (tmp_path / "entities_1_2.json").write_text("[{")
    (tmp_path / "other.json").write_text("[]")
    rows = files.read_entities(spark, str(tmp_path)).cache()
    assert [r.entity_name for r in files.good(rows).collect()] == ["a"] and [r.file for r in files.corrupt(rows).collect()] == ["entities_1_2.json"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "triples_1_1.json").write_text(json.dumps([{"subject": "a", "relation": "r", "object": "b", "chunk_id": "1"}] * 2))
    assert files.good(files.read_triples(spark, str(tmp_path / "t")).cache()).count() == 2


def test_chunks_and_csv(spark, tmp_path):
    chunks = spark.createDataFrame([("中文", "s", i) for i in range(5)], "chunk_content string, source string, metadata long")
    files.write_json_lines(chunks, str(tmp_path / "c"))
    assert sorted(r.metadata for r in files.read_chunks(spark, str(tmp_path / "c"), 1, 3).collect()) == [1, 2]
    assert files.read_chunks(spark, str(tmp_path / "c")).count() == 5
    fixes = spark.createDataFrame([(1, 'a "b", c', "NA", None)], FIX)
    files.write_csv(fixes, str(tmp_path / "f"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "f"), FIX).collect()] == [(1, 'a "b", c', "NA", None)]


def test_ranges_replace_themselves(spark, tmp_path):
    rows = lambda n, r: spark.createDataFrame([(n, r)], "n long, range_start long")
    path = str(tmp_path / "r")
    files.write_range(rows(1, 0), path)
    files.write_range(rows(2, 20), path)
    files.write_range(rows(3, 0), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [2, 3]


def test_json_arrays_by_range(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0), ("b", 0), ("c", 20)], "name string, range_start long")
    for _ in range(2):
        files.write_json_arrays(rows, str(tmp_path / "j"))
    got = {p.parent.name: sorted(x["name"] for x in json.loads(p.read_text())) for p in (tmp_path / "j").glob("*/*.txt")}
    assert got == {"range_start=0": ["a", "b"], "range_start=20": ["c"]}


def test_durable_tables_are_released(spark):
    kept = session.durable(spark.range(3))
    assert kept.count() == 3
    path = session._made[-1]
    session.release(spark)
    assert not os.path.exists(path) and session._made == []


def test_streams(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    triple = lambda s: spark.createDataFrame([(s, "r", "o", "1")], TRIPLE)
    triple("a").write.mode("append").parquet(source)
    incremental.append_triples(incremental.stream(spark, source, TRIPLE), str(tmp_path / "c1"), target)
    triple("b").write.mode("append").parquet(source)
    incremental.append_triples(incremental.stream(spark, source, TRIPLE), str(tmp_path / "c1"), target)
    incremental.append_triples(incremental.stream(spark, source, TRIPLE), str(tmp_path / "c1"), target)
    assert sorted(r.subject for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_streamed_merge(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "kb")
    schema = ENTITY.add("position", "long")
    for i, (summary, types) in enumerate([("A", ["x"]), ("B", ["y", "x"])]):
        spark.createDataFrame([("e", types, ["g"], summary, [i], i)], schema).write.mode("append").parquet(source)
        incremental.merge_knowledge(incremental.stream(spark, source, schema), str(tmp_path / "c"), target)
    last = incremental.knowledge(spark, target).collect()
    assert len(last) == 1 and last[0].summary == "A | B" and last[0].type == ["x", "y"] and last[0].chunk_ids == [0, 1]
    written = spark.read.parquet(target)
    assert written.where("batch = 1").count() == 1 and written.where("batch = 1").first().summary == "B"  # a batch holds only its own names


def test_windows_with_late_rows(spark, tmp_path):
    rows = spark.createDataFrame([("r", "2024-03-01 10:00:00"), ("r", "2024-03-01 11:00:00"), ("q", "2024-03-02 01:00:00")], "relation string, t string")
    rows = rows.select("relation", F.to_timestamp("t").alias("loaded_at"))
    rows.write.parquet(str(tmp_path / "in"))
    run = lambda: incremental.counted(incremental.windowed_counts(incremental.stream(spark, str(tmp_path / "in"), rows.schema)), str(tmp_path / "c"), str(tmp_path / "out"))
    now = lambda: {(r.relation, str(r.window.start)[:10], r.triples) for r in incremental.latest(spark, str(tmp_path / "out")).collect()}
    run()
    assert now() == {("r", "2024-03-01", 2), ("q", "2024-03-02", 1)}
    late = spark.createDataFrame([("r", "2024-03-01 12:00:00"), ("s", "2025-01-01 00:00:00")], "relation string, t string")
    late.select("relation", F.to_timestamp("t").alias("loaded_at")).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert now() == {("r", "2024-03-01", 3), ("q", "2024-03-02", 1), ("s", "2025-01-01", 1)}
    later = spark.createDataFrame([("r", "2024-03-01 13:00:00")], "relation string, t string")  # behind the watermark by now
    later.select("relation", F.to_timestamp("t").alias("loaded_at")).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert ("r", "2024-03-01", 3) in now()


def test_graph_tables(spark, tmp_path):
    nodes = spark.createDataFrame([("entity_1", "a"), ("entity_2", "b")], "`id:ID` string, name string")
    edges = spark.createDataFrame([("entity_1", "entity_2", "has")], "`:START_ID` string, `:END_ID` string, `:TYPE` string")
    for _ in range(2):
        files.write_graph(nodes, edges, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g" / "nodes")).count() == 2 and spark.read.parquet(str(tmp_path / "g" / "edges")).count() == 1
