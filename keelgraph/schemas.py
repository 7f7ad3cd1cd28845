"""Row types of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CHUNK = T.StructType([T.StructField("chunk_content", T.StringType()), T.StructField("source", T.StringType()), T.StructField("metadata", T.LongType())])
MENTION = _strings("entity_name", "type", "domain_relevance", "summary", "chunk_id")
ENTITY = T.StructType([
    T.StructField("entity_name", T.StringType()),
    T.StructField("type", T.ArrayType(T.StringType())),
    T.StructField("domain_relevance", T.ArrayType(T.StringType())),
    T.StructField("summary", T.StringType()),
    T.StructField("chunk_ids", T.ArrayType(T.LongType())),
])
TRIPLE = _strings("subject", "relation", "object", "chunk_id")
NODE_COLUMNS = ["id:ID", "name", "summary", "type", "domain_relevance", "entity_chunk_id", "relation_chunk_id", ":LABEL"]
EDGE_COLUMNS = [":START_ID", ":END_ID", ":TYPE"]
NODE, EDGE = _strings(*NODE_COLUMNS), _strings(*EDGE_COLUMNS)
FIX = T.StructType([T.StructField("index", T.LongType()), *_strings("subject", "relation", "object").fields])
