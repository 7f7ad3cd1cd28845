import datetime
import hashlib

import pytest

from keelgraph.operators import extract
from keelgraph.plans import knowledge

ENTITY = ("entity_id long, entity_name string, type array<string>, domain_relevance array<string>, summary string, chunk_ids array<long>, "
          "origin string, extracted_at timestamp")  # fmt: skip


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, at = str(tmp_path_factory.mktemp("records")), datetime.datetime(2024, 1, 1)
    rows = [(1, "a", ["x", "y"], ["g"], "S", [3, 25, 4], "rule", at), (2, "a", ["z"], ["g", "h"], "T", [4], "rule", at), (3, "b", None, ["g"], "U", [25], "rule", at), (4, "c", ["x"], ["g"], "V", None, "rule", at)]
    spark.createDataFrame(rows, ENTITY).write.parquet(f"{path}/entities.parquet")
    spark.createDataFrame([(f"text {i}", "s", i) for i in range(30)], "chunk_content string, source string, metadata long").write.parquet(f"{path}/chunks.parquet")
    spark.createDataFrame([("a", "r", "b", "4")], "subject string, relation string, object string, chunk_id string").write.parquet(f"{path}/triples.parquet")
    return path


def test_build_reads_every_chunk_and_type(spark, folder):
    got = {r.entity_name: r for r in knowledge.entity_kb_build(spark, folder).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].type, got["a"].domain_relevance, got["a"].chunk_ids) == ("x|y|z", "g|h", "3|4|25")
    assert got["a"].summary == "S | T | T | S" and got["b"].type == "" and got["b"].chunk_ids == "25"


def test_pipeline_reads_every_chunk_and_type(spark, folder):
    got = {r.entity_name: r for r in knowledge.entity_pipeline(spark, folder).collect()}
    prompt = extract.ENTITY_PROMPT.replace("{chunk_id}", "3").replace("{text}", "text 3")
    assert set(got) == {"a"} and got["a"].first_prompt == hashlib.md5(prompt.encode()).hexdigest() and (got["a"].type, got["a"].domain_relevance, got["a"].chunk_ids) == ("x|y|z", "g|h", "3|4|25")


def test_outputs_hold_every_mention(spark, folder):
    assert {(r.chunk_id, r.entities, r.triples) for r in knowledge.joint_pipeline(spark, folder).collect()} == {("3", 2, 0), ("4", 4, 1), ("25", 2, 0)}
    assert sorted((r.chunk_id, r.type, r.domain_relevance) for r in knowledge.llm_parse_entities(spark, folder).collect()) == [
        ("1", "x", "g"), ("1", "y", "g"), ("2", "z", "g"), ("2", "z", "h"), ("4", "x", "g")]
