"""Raw extractor output: cleaning, JSON repair, strict validation, dead letters."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keelgraph.functions.text import strip
from keelgraph.schemas import MENTION, TRIPLE

ENTITY_FIELDS, TRIPLE_FIELDS = MENTION.names, TRIPLE.names


# What is cut from an output.
_THINKING, _FENCE = r"(?s)<think>.*?</think>", r"```(?:json)?\s*"


def clean_output(raw: Column) -> Column:
    """Without reasoning, code fences and white space around."""
    return strip(F.regexp_replace(F.regexp_replace(raw, _THINKING, ""), _FENCE, ""))


def repair_json(text: Column) -> Column:
    """The three repairs, in order: `\\xHH`, stray backslashes, broken `\\u`."""
    text = F.regexp_replace(text, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    text = F.regexp_replace(text, r'\\([^"\\/bfnrtu])', "$1")
    return F.regexp_replace(text, r"\\u([0-9a-fA-F]{0,3}(?:[^0-9a-fA-F]|\z))", r"\\\\u$1")


def _valid(items: object, fields: list[str], chunk_id: str, aliases: dict[str, str]) -> list[tuple]:
    """Rows with all fields as strings, the chunk's own id in place of any the extractor wrote."""
    rows = []
    for item in items if isinstance(items, list) else []:
        if not isinstance(item, dict):
            continue
        item = {**{aliases.get(k, k): v for k, v in item.items()}, "chunk_id": chunk_id}
        if all(isinstance(item.get(f), str) for f in fields):
            rows.append(tuple(item[f] for f in fields))
    return rows


def _rows(parsed: object, kind: str, chunk_id: str, aliases: dict[str, str]) -> tuple[list[tuple], list[tuple]]:
    if kind == "entities":
        if not isinstance(parsed, list):
            raise ValueError("the top is no list")
        return _valid(parsed, ENTITY_FIELDS, chunk_id, {}), []
    if not isinstance(parsed, dict):
        raise ValueError("the top is no object")
    triples = _valid(parsed.get("triples", []), TRIPLE_FIELDS, chunk_id, aliases)
    return _valid(parsed.get("entities", []), ENTITY_FIELDS, chunk_id, {}) if kind == "joint" else [], triples


_OWN = ("chunk_id", "status", "error", "cleaned", "entities", "triples")
_PARSED = (
    f"chunk_id string, status string, error string, cleaned string, "
    f"entities array<struct<{','.join(f + ':string' for f in ENTITY_FIELDS)}>>, triples array<struct<{','.join(f + ':string' for f in TRIPLE_FIELDS)}>>"
)


def parse_output(outputs: DataFrame, kind: str, accept_predicate: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(chunk_id, status, error, cleaned, entities, triples) for outputs (chunk_id, raw), and the text columns `keep` of theirs.

    `kind` is `entities` (a list on top), `triples` or `joint` (an object with `triples`, and `entities`). Status: `ok`,
    `repaired`, `empty` for nothing after cleaning, `rejected` for what stays no JSON or has another top. Items that are no
    objects, lack a field or hold another type than a string are dropped, other keys ignored. JSON is read strictly: text
    after the value rejects it, of a repeated key the last counts. With `accept_predicate` a triple may call its relation
    so. A null output is empty.
    """
    aliases = {"predicate": "relation"} if accept_predicate else {}
    keep = keep or []
    cleaned = outputs.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.coalesce(clean_output(F.col("raw")), F.lit("")).alias("cleaned"), *keep)
    both = cleaned.withColumn("repaired", repair_json(F.col("cleaned")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for chunk_id, text, fixed in zip(batch["chunk_id"], batch["cleaned"], batch["repaired"]):
                status, error, found = "empty", None, ([], [])
                for status_if, candidate in (("ok", text), ("repaired", fixed)) if text else ():
                    try:
                        parsed = json.loads(candidate)
                    except (ValueError, RecursionError) as e:
                        status, error = "rejected", str(e)
                        continue
                    try:
                        found, status, error = _rows(parsed, kind, chunk_id, aliases), status_if, None
                    except ValueError as e:
                        status, error = "rejected", str(e)
                    break
                rows.append((chunk_id, status, error, text, *found))
            out = pd.DataFrame(rows, columns=["chunk_id", "status", "error", "cleaned", "entities", "triples"])
            yield out.assign(**{c: batch[c].to_numpy() for c in keep})

    return both.mapInPandas(run, ", ".join([_PARSED, *(f"{c} string" for c in keep)]))


def observed(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """parsed, and an observation that holds the number of outputs of each status once the rows have been written."""
    seen = Observation("parsed")
    return parsed.observe(seen, *[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "repaired", "empty", "rejected")]), seen


def parsed_entities(parsed: DataFrame) -> DataFrame:
    """The entities with their place `pos` in their chunk's output, and the columns that were kept."""
    kept = [c for c in parsed.columns if c not in _OWN]
    return parsed.select(F.posexplode("entities").alias("pos", "e"), *kept).select("e.*", "pos", *kept)


def parsed_triples(parsed: DataFrame) -> DataFrame:
    kept = [c for c in parsed.columns if c not in _OWN]
    return parsed.select(F.explode("triples").alias("t"), *kept).select("t.*", *kept)


def rejects(parsed: DataFrame) -> DataFrame:
    """(chunk_id, cleaned, error): the dead letters."""
    return parsed.where("status = 'rejected'").select("chunk_id", "cleaned", "error")
