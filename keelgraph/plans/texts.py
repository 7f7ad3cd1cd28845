"""Queries on Markdown texts, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelgraph.functions.text import newlines, strip
from keelgraph.operators import chunking, extract, markdown
from keelgraph.operators.ordinals import ordinal
from keelgraph.session import table

WS = r"[\t-\r\x{85}\p{Z}]"
STRIP = rf"'^{WS}+|{WS}+$', '', 'g'"


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("metadata", "source", newlines(F.col("chunk_content")).alias("text"))


def heading_levels(spark: SparkSession, folder: str) -> DataFrame:
    return chunks(spark, folder).select("metadata", "text", markdown.level_headings(F.col("text")).alias("new_text")).where("text <> new_text").select("metadata", "new_text")


def heading_preview(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.heading_preview(chunks(spark, folder), "metadata", "text")


def heading_demote(spark: SparkSession, folder: str) -> DataFrame:
    return chunks(spark, folder).select("metadata", "text", markdown.demote_headings(F.col("text")).alias("new_text")).where("text <> new_text").select("metadata", "new_text")


def heading_demotion_log(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.demotion_log(chunks(spark, folder), "metadata", "text")


def heading_change_counts(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.demotion_counts(chunks(spark, folder), "metadata", "text")


def image_caption_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.image_captions(chunks(spark, folder), "metadata", "text")


def image_ref_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    texts = chunks(spark, folder)
    return markdown.rewrite_images(texts, markdown.image_captions(texts, "metadata", "text"), "metadata", "text").where("renamed > 0").select("metadata", "new_text", "renamed")


def image_ref_rewrite_existing(spark: SparkSession, folder: str) -> DataFrame:
    """As `image_ref_rewrite`, for the images that exist: those that a chunk of a known source file refers to."""
    texts = chunks(spark, folder)
    known = markdown.image_diagnosis(texts.where("source IS NOT NULL"), "metadata", "text").where("old_name <> ''").select("old_name")
    return markdown.rewrite_images(texts, markdown.image_captions(texts, "metadata", "text"), "metadata", "text", known).where("renamed > 0").select("metadata", "new_text", "renamed")


def image_name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.caption_collisions(markdown.image_captions(chunks(spark, folder), "metadata", "text"))


def image_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    return markdown.image_diagnosis(chunks(spark, folder), "metadata", "text")


def hash_filename_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text IS NOT NULL")
    hashed = docs.select(F.concat(F.sha2("text", 256), F.lit(".jpg")).alias("name"))
    named = docs.where("title IS NOT NULL").select(F.concat("title", F.lit(".jpg")).alias("name"))
    return markdown.delete_plan(hashed.unionAll(named))


def protect_span_counts(spark: SparkSession, folder: str) -> DataFrame:
    return chunks(spark, folder).where("text IS NOT NULL").select("metadata", chunking.protected_counts(F.col("text")).alias("n")).select("metadata", "n.*")


def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    pieces = chunking.chunk_texts(docs.select("doc_id", "source", newlines(F.col("text")).alias("text")), "doc_id", "text", keep="source")
    return chunking.number_chunks(pieces, ["doc_id", "pos"], "source")


def chunk_checks(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, first_fits, last_fits, oversized): whether a text begins and ends as its first and last chunk do, and how many
    chunks are longer than the size though they hold no formula and no table.
    """
    docs = table(spark, folder, "documents").select("doc_id", newlines(F.col("text")).alias("text"))
    ends = chunking.chunk_texts(docs, "doc_id", "text").groupBy("doc_id").agg(
        F.min_by("chunk_content", "pos").alias("first"), F.max_by("chunk_content", "pos").alias("last"),
        F.count_if((F.length("chunk_content") > chunking.SIZE) & ~F.col("chunk_content").rlike(r"(?i)\$|</table>")).alias("oversized"))
    both = docs.select("doc_id", strip(F.col("text")).alias("bare")).join(ends, "doc_id")
    return both.select("doc_id", F.startswith("bare", "first").alias("first_fits"), F.endswith("bare", "last").alias("last_fits"), "oversized")


def chunk_ordinals(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal(table(spark, folder, "chunks").select("source", "metadata"), ["source", "metadata"])


def batch_plan(spark: SparkSession, folder: str) -> DataFrame:
    total = table(spark, folder, "chunks").agg(F.count("*").alias("total"))
    entity = extract.batches(total, 20).select(F.lit("entities").alias("kind"), "*")
    return entity.unionAll(extract.batches(total, 50).select(F.lit("relations").alias("kind"), "*"))


def prompt_render(spark: SparkSession, folder: str) -> DataFrame:
    todo = extract.extractable(table(spark, folder, "chunks"))
    return todo.select("chunk_id", extract.render(extract.ENTITY_PROMPT, chunk_id=F.col("chunk_id"), text=F.col("text")).alias("prompt"))


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("source = 'shift_chat'").select("doc_id", newlines(F.col("text")).alias("text"))
    line = markdown.lines(docs, "doc_id", "text").where("line <> ''")
    said = F.instr("line", "：") > 1
    return line.select("doc_id", F.col("line_no").alias("turn"), F.when(said, F.substring_index("line", "：", 1)).otherwise("system").alias("role"),
                       F.when(said, F.expr("substr(line, instr(line, '：') + 1)")).otherwise(F.col("line")).alias("content"))


def chat_history(spark: SparkSession, folder: str) -> DataFrame:
    return extract.history(_turns(spark, folder), "doc_id", "turn")


def chat_cleared(spark: SparkSession, folder: str) -> DataFrame:
    return extract.cleared(_turns(spark, folder))


QUERIES = {q.__name__: q for q in (
    heading_levels, heading_preview, heading_demote, heading_demotion_log, heading_change_counts, image_caption_pairs, image_ref_rewrite, image_ref_rewrite_existing,
    image_name_collisions, image_diagnosis, hash_filename_filter, protect_span_counts, chunk_documents, chunk_checks, chunk_ordinals, batch_plan,
    prompt_render, chat_history, chat_cleared)}

_TEXTS = r"c AS (SELECT metadata, regexp_replace(chunk_content, '\r\n?', chr(10), 'g') AS text FROM chunks)"
_LINES = f"{_TEXTS}, l AS (SELECT metadata, string_split(text, chr(10)) AS l FROM c WHERE text IS NOT NULL), lines AS (SELECT metadata, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM l)"


def _level(text: str) -> str:
    for level, number in markdown._NUMBERED.items():
        text = rf"regexp_replace({text}, '(?m)^#{WS}+({number}){WS}+(.+)$', '{'#' * level} \1 \2', 'g')"
    return text


_CHAPTER = markdown._CHAPTER
_SINGLE = f"regexp_matches(regexp_replace(line, '{WS}+$', ''), '^{WS}*#{WS}+') AND NOT regexp_matches(line, '^{WS}*##')"
_DEMOTED = f"CASE WHEN {_SINGLE} AND NOT regexp_matches(line, '{_CHAPTER}') THEN regexp_replace(line, '^{WS}*#{WS}+', '#### ') ELSE line END"
_IMAGES = rf"""{_LINES}, w AS (SELECT metadata, line_no, line, regexp_replace(lead(line) OVER (PARTITION BY metadata ORDER BY line_no), {STRIP}) AS next FROM lines),
  i AS (SELECT metadata, line_no, regexp_extract(line, '{markdown._IMAGE}', 1) AS old_name,
        coalesce(regexp_extract(next, '^图[\p{{Nd}}.\-]+{WS}+([^\n]+)', 1), '') AS caption, next FROM w WHERE contains(line, '![](') AND contains(line, 'images/')),
  pairs AS (SELECT metadata, line_no, old_name, replace(regexp_replace(regexp_replace(caption, {STRIP}), '[<>:"/\\|?*]', '', 'g'), ' ', '_') || '.jpg' AS new_name, caption
        FROM i WHERE old_name <> '' AND caption <> '')"""
_TURNS = r"""t AS (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS l FROM documents WHERE source = 'shift_chat' AND text IS NOT NULL),
  u AS (SELECT doc_id, unnest(range(len(l))) AS turn, unnest(l) AS line FROM t), turns AS (SELECT doc_id, turn,
    CASE WHEN instr(line, '：') > 1 THEN split_part(line, '：', 1) ELSE 'system' END AS role,
    CASE WHEN instr(line, '：') > 1 THEN substr(line, instr(line, '：') + 1) ELSE line END AS content FROM u WHERE line <> '')"""

ORACLE = {
    "heading_levels": f"WITH {_TEXTS}, n AS (SELECT metadata, text, {_level('text')} AS new_text FROM c) SELECT metadata, new_text FROM n WHERE text <> new_text",
    "heading_preview": f"WITH {_LINES}, n AS (SELECT *, {_level('line')} AS new FROM lines) SELECT metadata, line_no, line AS old, new FROM n WHERE line <> new",
    "heading_demote": f"""WITH {_LINES}, n AS (SELECT metadata, string_agg(line, chr(10) ORDER BY line_no) AS text, string_agg({_DEMOTED}, chr(10) ORDER BY line_no) AS new_text FROM lines GROUP BY metadata)
        SELECT metadata, new_text FROM n WHERE text <> new_text""",
    "heading_demotion_log": f"WITH {_LINES} SELECT metadata, line_no, CASE WHEN regexp_matches(line, '{_CHAPTER}') THEN 'retain' ELSE 'modify' END AS action, line AS old, {_DEMOTED} AS new FROM lines WHERE {_SINGLE}",
    "heading_change_counts": f"WITH {_LINES} SELECT CASE WHEN regexp_matches(line, '{_CHAPTER}') THEN 'retain' ELSE 'modify' END AS action, count(*) AS headings FROM lines WHERE {_SINGLE} GROUP BY 1",
    "image_caption_pairs": f"WITH {_IMAGES} SELECT * FROM pairs",
    "image_ref_rewrite": f"""WITH {_IMAGES}, p AS (SELECT metadata, list('images/' || old_name || chr(9) || 'images/' || new_name ORDER BY line_no) AS p FROM pairs GROUP BY metadata)
        SELECT metadata, list_reduce(list_prepend(text, p), lambda acc, x: replace(acc, split_part(x, chr(9), 1), split_part(x, chr(9), 2))) AS new_text, len(p) AS renamed FROM c JOIN p USING (metadata)""",
    "image_ref_rewrite_existing": f"""WITH {_IMAGES}, x AS (SELECT DISTINCT old_name FROM i JOIN chunks USING (metadata) WHERE old_name <> '' AND source IS NOT NULL),
        p AS (SELECT metadata, list('images/' || old_name || chr(9) || 'images/' || new_name ORDER BY line_no) AS p FROM pairs WHERE old_name IN (FROM x) GROUP BY metadata)
        SELECT metadata, list_reduce(list_prepend(text, p), lambda acc, x: replace(acc, split_part(x, chr(9), 1), split_part(x, chr(9), 2))) AS new_text, len(p) AS renamed FROM c JOIN p USING (metadata)""",
    "chunk_checks": f"SELECT doc_id, TRUE AS first_fits, TRUE AS last_fits, 0 AS oversized FROM documents WHERE regexp_replace(text, {STRIP}) <> ''",
    "image_name_collisions": f"WITH {_IMAGES} SELECT new_name, count(DISTINCT old_name) AS images FROM pairs GROUP BY 1 HAVING count(DISTINCT old_name) > 1",
    "image_diagnosis": rf"WITH {_IMAGES} SELECT metadata, line_no, old_name, regexp_extract(next, '^图[\p{{Nd}}.\-]+{WS}+([^\n]+)', 1) AS caption, regexp_extract(next, '^图([^ ]+){WS}+([^\n]+)', 2) AS loose_caption FROM i",
    "hash_filename_filter": r"WITH n AS (SELECT sha256(text) || '.jpg' AS name FROM documents WHERE text IS NOT NULL UNION ALL SELECT title || '.jpg' FROM documents WHERE text IS NOT NULL AND title IS NOT NULL) SELECT name FROM n WHERE regexp_matches(name, '(?i)^[a-f0-9]{64}\.\w+$')",
    "protect_span_counts": rf"""WITH {_TEXTS}, r AS (SELECT metadata, text, regexp_replace(text, '(?s)\$\$.*?\$\$', '', 'g') AS a FROM c WHERE text IS NOT NULL), s AS (SELECT *, regexp_replace(a, '\$[^\n]*?\$', '', 'g') AS b FROM r)
        SELECT metadata, len(regexp_extract_all(text, '(?s)\$\$.*?\$\$')) AS display, len(regexp_extract_all(a, '\$[^\n]*?\$')) AS inline, len(regexp_extract_all(b, '(?is)<table\b[^>]*>.*?</table>')) AS tables FROM s""",
    "chunk_ordinals": "SELECT source, metadata, row_number() OVER (ORDER BY source NULLS FIRST, metadata) - 1 AS ordinal FROM chunks",
    "batch_plan": """WITH t AS (SELECT count(*) AS total FROM chunks)
        SELECT 'entities' AS kind, i AS batch, i * 20 AS first, least(i * 20 + 20, total) AS "end" FROM t, unnest(range(0, CAST(ceil(total / 20.0) AS BIGINT))) AS u(i)
        UNION ALL SELECT 'relations', i, i * 50, least(i * 50 + 50, total) FROM t, unnest(range(0, CAST(ceil(total / 50.0) AS BIGINT))) AS u(i)""",
    "prompt_render": f"""WITH c AS (SELECT metadata, regexp_replace(chunk_content, {STRIP}) AS text FROM chunks)
        SELECT metadata AS chunk_id, replace(replace('{extract.ENTITY_PROMPT}', '{{chunk_id}}', CAST(metadata AS VARCHAR)), '{{text}}', text) AS prompt FROM c WHERE text <> ''""",
    "chat_history": f"""WITH {_TURNS}, n AS (SELECT doc_id, turn, row_number() OVER (PARTITION BY doc_id ORDER BY turn) || '. ' || role || ': ' || content AS line FROM turns WHERE role <> 'system')
        SELECT doc_id, string_agg(line, chr(10) || repeat('-', 20) || chr(10) ORDER BY turn) AS shown FROM n GROUP BY doc_id""",
    "chat_cleared": f"WITH {_TURNS} SELECT * FROM turns WHERE role = 'system'",
}
