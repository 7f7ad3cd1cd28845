"""The boundary to an extractor: prompts, replayed and rule-made outputs, batches of chunks, chat histories."""

from __future__ import annotations

import os
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelgraph.functions.text import strip
from keelgraph.operators.ordinals import ordinal

ENTITY_PROMPT = """Read the text and list the entities of shipbuilding in it.
Answer with a JSON list of objects with entity_name, type, domain_relevance, summary and chunk_id.
Chunk: {chunk_id}
Text:
{text}"""
RELATION_PROMPT = """Read the text and list the relations between the known entities.
Answer with a JSON object {"triples": [...]} of objects with subject, relation, object and chunk_id.
Known entities:
{entities}
Chunk: {chunk_id}
Text:
{text}"""
JOINT_PROMPT = """Read the text and list its entities and the relations between them.
Answer with a JSON object {"entities": [...], "triples": [...]}.
Chunk: {chunk_id}
Text:
{text}"""


def render(template: str, **values: Column) -> Column:
    """A template with its {names} replaced, in the order given; values are put in as they are, null as nothing."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def extractable(chunks: DataFrame) -> DataFrame:
    """(chunk_id, source, text) of the chunks that are not blank, stripped; a null source is empty."""
    text = strip(F.col("chunk_content"))
    return chunks.select(F.col("metadata").alias("chunk_id"), F.coalesce("source", F.lit("")).alias("source"), text.alias("text")).where("text <> ''")


def with_ordinals(chunks: DataFrame, order: list[str]) -> DataFrame:
    """chunks with a null ordinal (metadata) replaced by the row's place in the whole table by `order`."""
    placed = ordinal(chunks, order, "_place")
    return placed.withColumn("metadata", F.coalesce("metadata", "_place")).drop("_place")


def chunk_range(chunks: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """The chunks whose ordinal is in [start, end); pushed down to the scan."""
    chunks = chunks.where(F.col("metadata") >= start)
    return chunks if end is None else chunks.where(F.col("metadata") < end)


class Extractor(ABC):
    """Turns prompts (chunk_id, prompt) into raw outputs (chunk_id, prompt, raw, error), the prompt kept as a record of what was asked."""

    @abstractmethod
    def extract(self, prompts: DataFrame) -> DataFrame: ...


class Replay(Extractor):
    """Outputs that were stored before; a prompt without one has an error."""

    def __init__(self, stored: DataFrame) -> None:
        self.stored = stored

    def extract(self, prompts: DataFrame) -> DataFrame:
        found = prompts.select("chunk_id", "prompt").join(self.stored.select("chunk_id", "raw"), "chunk_id", "left")
        return found.select("chunk_id", "prompt", "raw", F.when(F.col("raw").isNull(), "no stored output").alias("error"))


class Rule(Extractor):
    """A stand-in for a model, for demonstrations and tests: reads the known entities out of a relation prompt and relates
    each to the next one in the text. A prompt without a list of known entities gives an error.
    """

    RELATION = "co_occurs_with"

    def extract(self, prompts: DataFrame) -> DataFrame:
        listed = F.from_json(F.regexp_extract("prompt", r"(?s)\nKnown entities:\n(\[.*?\])\nChunk: ", 1), "array<struct<entity_name:string>>")
        # generated, so that the list isn't read out of the prompt again for each of its names
        asked = prompts.select("chunk_id", "prompt", F.explode(F.array(listed)).alias("known"))
        pair = lambda x, i: F.struct(x["entity_name"].alias("subject"), F.lit(self.RELATION).alias("relation"), F.get("known", i + 1)["entity_name"].alias("object"))
        said = F.to_json(F.struct(F.filter(F.transform("known", pair), lambda t: t["object"].isNotNull()).alias("triples")))
        return asked.select("chunk_id", "prompt", F.when(F.col("known").isNotNull(), said).alias("raw"), F.when(F.col("known").isNull(), "no known entities").alias("error"))


class Http(Extractor):
    """A service of the user's own at KEELGRAPH_ENDPOINT that answers a posted prompt with text; errors stay with the chunk.

    A task has at most `at_once` requests under way.
    """

    def __init__(self, endpoint: str | None = None, timeout: float = 180.0, retries: int = 3, at_once: int = 8) -> None:
        self.endpoint, self.timeout, self.retries, self.at_once = endpoint or os.environ.get("KEELGRAPH_ENDPOINT", ""), timeout, retries, at_once

    def extract(self, prompts: DataFrame) -> DataFrame:
        endpoint, timeout, retries, at_once = self.endpoint, self.timeout, self.retries, self.at_once

        def ask(prompt: str) -> tuple[str | None, str | None]:
            error = "no endpoint"
            for _ in range(retries if endpoint else 0):
                try:
                    with urllib.request.urlopen(urllib.request.Request(endpoint, prompt.encode()), timeout=timeout) as answer:
                        return answer.read().decode(), None
                except OSError as e:
                    error = str(e)
            return None, error

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            with ThreadPoolExecutor(at_once) as pool:
                for batch in batches:
                    answers = list(pool.map(ask, batch["prompt"]))
                    yield batch.assign(raw=[a for a, _ in answers], error=[e for _, e in answers])

        return prompts.select("chunk_id", "prompt").mapInPandas(run, "chunk_id long, prompt string, raw string, error string")


def batches(total: DataFrame, size: int, start: int = 0) -> DataFrame:
    """(batch, first, end) of the ranges [first, end) that cover `total` (one row, column total) chunks from `start` on."""
    ranges = total.where(F.col("total") > start).select("total", F.explode(F.sequence(F.lit(start), F.col("total") - 1, F.lit(size))).alias("first"))
    return ranges.select(F.floor((F.col("first") - start) / size).alias("batch"), "first", F.least(F.col("first") + size, F.col("total")).alias("end"))


def history(turns: DataFrame, conversation: str, turn: str) -> DataFrame:
    """(conversation, shown): each conversation's turns without the system's, numbered, with dashed lines between."""
    said = turns.where("role <> 'system'")
    number = F.row_number().over(Window.partitionBy(conversation).orderBy(turn))
    line = F.concat(number.cast("string"), F.lit(". "), F.col("role"), F.lit(": "), F.coalesce("content", F.lit("")))
    shown = said.withColumn("n", number).withColumn("line", line)
    return shown.groupBy(conversation).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n" + "-" * 20 + "\n").alias("shown"))


def cleared(turns: DataFrame) -> DataFrame:
    """What is left of a history when it is cleared: the system's turns."""
    return turns.where("role = 'system'")
