"""Queries on the knowledge base and the graph, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelgraph.functions.text import joined
from keelgraph.operators import extract, graph, kb, match, parse, repair, triples
from keelgraph.operators.ordinals import ordinal
from keelgraph.plans.texts import STRIP
from keelgraph.session import shared_path, table
from keelgraph.streaming import incremental

FIELDS = ["type", "domain_relevance", "summary", "chunk_ids"]


def entities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entities")


def _flat(records: DataFrame) -> DataFrame:
    return records.select("entity_name", *[joined(F.col(c)).alias(c) if c != "summary" else F.col(c) for c in FIELDS])


def _classed() -> Column:
    """A record's types with its relevances, by place; the last of the shorter list stands beside what is left of the longer."""
    lists = [F.array_compact(c) for c in ("type", "domain_relevance")]
    places = F.sequence(F.lit(0), F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in lists], F.lit(1)) - 1)
    value = lambda c, i: F.get(c, F.least(i, F.size(c) - 1))
    return F.transform(places, lambda i: F.named_struct(F.lit("class_place"), i, F.lit("type"), value(lists[0], i), F.lit("domain_relevance"), value(lists[1], i)))


def _mentions(spark: SparkSession, folder: str) -> DataFrame:
    """A mention per record, chunk of it and type with relevance of it, with their places in the record's lists."""
    rows = entities(spark, folder).select("entity_name", "summary", "extracted_at", "entity_id", _classed().alias("classes"), F.posexplode("chunk_ids").alias("chunk_place", "chunk_id"))
    return rows.select("*", F.inline("classes")).drop("classes")


def entity_kb_build(spark: SparkSession, folder: str) -> DataFrame:
    mentions = _mentions(spark, folder).where("chunk_id IS NOT NULL").withColumn("range", kb.range_of(F.col("chunk_id"), 20))
    per_range = kb.build(mentions, ["extracted_at", "entity_id", "chunk_place", "class_place"], ["range"])
    return _flat(kb.merge(per_range, ["range"]))


def entity_kb_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(kb.merge(entities(spark, folder), ["origin", "entity_id"]))


def entity_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(kb.lookup(kb.merge(entities(spark, folder), ["origin", "entity_id"]), "船体"))


def _loaded(spark: SparkSession, folder: str) -> DataFrame:
    return kb.load(entities(spark, folder).where("entity_name IS NOT NULL").select("entity_name", "entity_id", "type", "chunk_ids"), "entity_id")


def entity_stats(spark: SparkSession, folder: str) -> DataFrame:
    return kb.statistics(_loaded(spark, folder))


def entity_type_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return kb.type_histogram(_loaded(spark, folder))


def _named_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("metadata", "chunk_content")


def dictionary_match(spark: SparkSession, folder: str) -> DataFrame:
    return match.matches(_named_chunks(spark, folder), entities(spark, folder), "metadata", "chunk_content")


def match_topk_context(spark: SparkSession, folder: str) -> DataFrame:
    texts, names = _named_chunks(spark, folder), match.dictionary(entities(spark, folder), "entity_id", ["type", "summary"])
    return match.context(texts, match.matches(texts, names, "metadata", "chunk_content"), names, "metadata")


def match_all_json(spark: SparkSession, folder: str) -> DataFrame:
    names = match.dictionary(entities(spark, folder).select("entity_id", "entity_name", F.coalesce("summary", F.lit("")).alias("summary")), "entity_id", ["summary"])
    texts = _named_chunks(spark, folder)
    return match.known_entities(texts, match.matches(texts, names, "metadata", "chunk_content"), names, "metadata")


def _entity_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """What an extractor would have said of each record; those of model_b go on after the JSON."""
    name, summary = F.col("entity_name"), F.col("summary")
    fields = lambda x: {"entity_name": name, "type": x["type"], "domain_relevance": x["domain_relevance"], "summary": summary, "chunk_id": F.lit("0")}
    item = lambda x: F.named_struct(*[c for k, v in fields(x).items() for c in (F.lit(k), v)])
    items = F.to_json(F.transform(_classed(), item))
    said = F.concat(F.lit("<think>a list</think>\n```json\n"), items, F.when(F.col("origin") == "model_b", "\nand so on").otherwise(""), F.lit("\n```"))
    return entities(spark, folder).select(F.col("entity_id").alias("chunk_id"), said.alias("raw"))


def llm_parse_entities(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parsed_entities(parse.parse_output(_entity_outputs(spark, folder), "entities")).drop("pos")


def llm_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return parse.rejects(parse.parse_output(_entity_outputs(spark, folder), "entities")).select("chunk_id")


def _broken_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """An output of one mention for each record: well formed, with one of the defects that are repaired, empty, or cut off."""
    item = F.to_json(F.struct("entity_name", F.lit("t").alias("type"), F.lit("g").alias("domain_relevance")))
    with_summary = lambda text: F.concat(F.lit("["), F.expr("left(item, length(item) - 1)"), F.lit(f',"summary":"{text}"}}]'))
    kind = F.col("entity_id") % 6
    raw = (F.when(kind == 1, with_summary(r"\x41\xe9")).when(kind == 2, with_summary(r"a\qb")).when(kind == 3, with_summary(r"\u12"))
           .when(kind == 4, F.lit("<think>nothing found</think>\n```json\n```")).when(kind == 5, F.concat(F.lit("["), "item")).otherwise(with_summary("plain")))
    return entities(spark, folder).select("entity_id", item.alias("item")).select(F.col("entity_id").alias("chunk_id"), raw.alias("raw"))


def llm_repairs(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse.parse_output(_broken_outputs(spark, folder), "entities")
    return parsed.select("chunk_id", "status", F.explode_outer("entities").alias("e")).select("chunk_id", "status", "e.entity_name", "e.summary")


def _triple_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """What an extractor would have said of each chunk, as its triples have it."""
    rows = table(spark, folder, "triples").where("chunk_id RLIKE '^[0-9]+$'")
    said = F.to_json(F.struct(F.collect_list(F.struct("subject", "relation", "object")).alias("triples")))
    return rows.groupBy(F.col("chunk_id").cast("long").alias("chunk_id")).agg(F.concat(F.lit("```json\n"), said, F.lit("\n```")).alias("raw"))


def llm_parse_triples(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parsed_triples(parse.parse_output(_triple_outputs(spark, folder), "triples"))


def _said_of_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(chunk_id, items): each chunk's mentions as an extractor would list them."""
    item = F.struct("entity_name", "type", "domain_relevance", "summary", F.lit("?").alias("chunk_id"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("entity_id", "class_place", item.alias("item")))), lambda x: x["item"])
    return _mentions(spark, folder).where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(listed.alias("items"))


def _answered(stored: DataFrame, prompts: DataFrame) -> DataFrame:
    """Stored outputs of the prompts, with each prompt's digest in `asked`."""
    return extract.Replay(stored).extract(prompts).where("raw IS NOT NULL").withColumn("asked", F.md5("prompt"))


def entity_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks and prompts to the knowledge base, with the stored outputs replayed, in ranges of 20 chunks.

    Beside each name stands the digest of the prompt that named it first.
    """
    todo = extract.extractable(table(spark, folder, "chunks"))
    prompts = todo.select("chunk_id", extract.render(extract.ENTITY_PROMPT, chunk_id=F.col("chunk_id"), text=F.col("text")).alias("prompt"))
    stored = _said_of_chunks(spark, folder).select("chunk_id", F.concat(F.lit("```json\n"), F.to_json("items"), F.lit("\n```")).alias("raw"))
    mentions = parse.parsed_entities(parse.parse_output(_answered(stored, prompts), "entities", keep=["asked"])).withColumn("chunk_id", F.col("chunk_id").cast("long"))
    mentions = mentions.withColumn("range", kb.range_of(F.col("chunk_id"), 20))
    merged = _flat(kb.merge(kb.build(mentions, ["chunk_id", "pos"], ["range"]), ["range"]))
    return merged.join(mentions.groupBy("entity_name").agg(F.min_by("asked", "chunk_id").alias("first_prompt")), "entity_name")


def joint_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """(chunk_id, asked, entities, triples): the digest of a chunk's prompt, and how many of each one output for both gives."""
    todo = extract.extractable(table(spark, folder, "chunks"))
    prompts = todo.select("chunk_id", extract.render(extract.JOINT_PROMPT, chunk_id=F.col("chunk_id"), text=F.col("text")).alias("prompt"))
    rows = table(spark, folder, "triples").where("chunk_id RLIKE '^[0-9]+$'").withColumn("chunk_id", F.col("chunk_id").cast("long"))
    said = rows.groupBy("chunk_id").agg(F.collect_list(F.struct("subject", F.col("relation").alias("predicate"), "object")).alias("triples"))
    both = said.join(_said_of_chunks(spark, folder), "chunk_id", "full").select("chunk_id", F.to_json(F.struct(F.col("items").alias("entities"), "triples")).alias("raw"))
    parsed = parse.parse_output(_answered(both, prompts), "joint", accept_predicate=True, keep=["asked"])
    return parsed.select("chunk_id", "asked", F.size("entities").alias("entities"), F.size("triples").alias("triples"))


def _relation_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """A prompt for every chunk, with the names it mentions and what is known of them."""
    todo = extract.extractable(table(spark, folder, "chunks"))
    filled = entities(spark, folder).select("entity_id", "entity_name", F.coalesce("type", F.array().cast("array<string>")).alias("type"), F.coalesce("summary", F.lit("")).alias("summary"))
    names = match.dictionary(filled, "entity_id", ["type", "summary"])
    known = match.known_entities(todo, match.matches(todo, names, "chunk_id", "text"), names, "chunk_id")
    return todo.join(known, "chunk_id").select("chunk_id", extract.render(extract.RELATION_PROMPT, entities=F.col("entities"), chunk_id=F.col("chunk_id"), text=F.col("text")).alias("prompt"))


def relation_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """(chunk_id, asked, triples): the digest of the prompt with the chunk's known names, and how many triples its stored output gives."""
    answered = _answered(_triple_outputs(spark, folder), _relation_prompts(spark, folder))
    return parse.parse_output(answered, "triples", keep=["asked"]).select("chunk_id", "asked", F.size("triples").alias("triples"))


def relation_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The triples that a rule reads out of the same prompts: each known name with the next one of its chunk."""
    raw = extract.Rule().extract(_relation_prompts(spark, folder)).where("raw IS NOT NULL")
    return parse.parsed_triples(parse.parse_output(raw, "triples"))


def triples_union(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "triples")
    typed = entities(spark, folder).select(F.col("entity_name").alias("subject"), F.lit("belongs_to").alias("relation"), F.explode("type").alias("object"), F.lit(None).cast("string").alias("chunk_id"))
    return triples.union(own, typed)


def triples_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return triples.counts_by(table(spark, folder, "triples").withColumn("month", F.date_format("loaded_at", "yyyy-MM")), "month")


def triples_streamed_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Triples per day of load and relation, counted by a stream that reads the table file by file."""
    path = f"{folder}/triples.parquet"
    # as a pattern, the path may be a single file as well as a folder
    rows = incremental.stream(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema, files_per_batch=4)
    rows = rows.select("relation", F.col("loaded_at").cast("timestamp").alias("loaded_at"))
    target = shared_path(spark, "counts")
    # the table's files are in no order of time, so that any of its rows may come last
    incremental.counted(incremental.windowed_counts(rows, late="3650 days"), shared_path(spark, "stream"), target)
    return incremental.latest(spark, target).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "relation", "triples")


def triples_vocab_report(spark: SparkSession, folder: str) -> DataFrame:
    return triples.vocabulary_report(table(spark, folder, "triples"), table(spark, folder, "relation_vocab"))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    known = kb.load(entities(spark, folder).select("entity_name", "entity_id", *FIELDS), "entity_id")
    return graph.enrich(known, table(spark, folder, "triples"), "entity_id", "triple_id")


def enrich_entities(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("entity_name", *[joined(F.col(c)).alias(c) for c in ("type", "domain_relevance", "entity_chunk_id", "relation_chunk_id")], "summary")


def nodes_csv(spark: SparkSession, folder: str) -> DataFrame:
    return graph.nodes(_enriched(spark, folder))


def edges_csv(spark: SparkSession, folder: str) -> DataFrame:
    return graph.edges(table(spark, folder, "triples"), graph.nodes(_enriched(spark, folder)))


def label_clean(spark: SparkSession, folder: str) -> DataFrame:
    return graph.clean_labels(graph.nodes(_enriched(spark, folder))).select("id:ID", ":LABEL")


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return graph.label_distribution(graph.clean_labels(graph.nodes(_enriched(spark, folder))))


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal(table(spark, folder, "triples").select("triple_id", "subject", "relation", "object"), ["triple_id"])


def _fixes(spark: SparkSession, folder: str, placed: DataFrame) -> DataFrame:
    """Relations written as the vocabulary's Chinese labels, to be fixed by place."""
    vocab = table(spark, folder, "relation_vocab").select(F.col("relation").alias("canonical"), "label_zh")
    return placed.join(vocab, F.col("relation") == F.col("label_zh")).select((F.col("ordinal") + 1).alias("index"), "subject", F.col("canonical").alias("relation"), "object")


def relation_fix(spark: SparkSession, folder: str) -> DataFrame:
    placed = _placed(spark, folder)
    return repair.apply_fixes(placed, _fixes(spark, folder, placed), "ordinal", "index").select("ordinal", "subject", "relation", "object", "fixed")


def chinese_relation_rows(spark: SparkSession, folder: str) -> DataFrame:
    return triples.chinese_relations(_placed(spark, folder), "ordinal", "relation").select("index", "subject", "relation", "object")


def _fix_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _fixes(spark, folder, _placed(spark, folder)).select(F.concat(F.lit('"'), F.col("index").cast("string"), F.lit(","), F.coalesce("subject", F.lit("")), F.lit(","), "relation", F.lit(","), F.coalesce("object", F.lit("")), F.lit('"')).alias("value"))


def txt_to_csv(spark: SparkSession, folder: str) -> DataFrame:
    return repair.text_to_fixes(_fix_lines(spark, folder))


def quoted_txt_to_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The same fixes with a quoted subject that holds a comma and quotes, and forty objects each, so that fields are left over."""
    subject = F.concat(F.lit('"'), F.replace(F.coalesce("subject", F.lit("")), F.lit('"'), F.lit('""')), F.lit(', ""x"""'))
    objects = F.array_join(F.array_repeat(F.coalesce("object", F.lit("")), 40), ",")
    fixes = _fixes(spark, folder, _placed(spark, folder))
    return repair.csv_to_fixes(fixes.select(F.concat_ws(",", F.col("index").cast("string"), subject, "relation", objects).alias("value")))


def _graph_nodes(records: DataFrame) -> DataFrame:
    props = F.map_filter(F.map_from_arrays(F.array(F.lit("summary"), F.lit("origin")), F.array("summary", "origin")), lambda _, v: v.isNotNull())
    return records.select(F.col("entity_name").alias("id"), F.coalesce("type", F.array().cast("array<string>")).alias("labels"), props.alias("props"), "entity_id")


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Records loaded up to the end of 2024's first half, one per name, and later ones."""
    rows = entities(spark, folder)
    early = kb.load(rows.where("loaded_at < '2024-07-01'").select("entity_name", "entity_id", "type", "summary", "origin"), "entity_id")
    return _graph_nodes(early).drop("entity_id"), _graph_nodes(rows.where("loaded_at >= '2024-07-01'"))


def node_upsert(spark: SparkSession, folder: str) -> DataFrame:
    merged = graph.upsert_nodes(*_halves(spark, folder), "entity_id")
    return merged.select("id", joined(F.array_distinct("labels")).alias("labels"), F.element_at("props", "summary").alias("summary"), F.element_at("props", "origin").alias("origin"))


def edge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "triples").select(F.col("subject").alias("start"), F.col("object").alias("end"), F.col("relation").alias("type"), "loaded_at")
    ids = entities(spark, folder).select(F.col("entity_name").alias("id"))
    valid = rows.join(ids.distinct().toDF("start"), "start", "left_semi").join(ids.distinct().toDF("end"), "end", "left_semi")
    return graph.upsert_edges(valid.where("loaded_at < '2024-07-01'").drop("loaded_at").distinct(), rows.where("loaded_at >= '2024-07-01'").drop("loaded_at"), ids)


def import_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "triples").select(F.col("subject").alias("start"), F.col("object").alias("end"))
    ids = entities(spark, folder).select(F.col("entity_name").alias("id"))
    return graph.import_counts(ids, rows, ids)


QUERIES = {q.__name__: q for q in (
    entity_kb_build, entity_kb_merge, entity_lookup, entity_stats, entity_type_histogram, dictionary_match, match_topk_context, match_all_json, llm_parse_entities,
    llm_rejects, llm_repairs, llm_parse_triples, relation_pipeline, relation_rules, entity_pipeline, joint_pipeline, quoted_txt_to_csv, triples_union, triples_by_month, triples_streamed_by_day, triples_vocab_report, enrich_entities, nodes_csv, edges_csv,
    label_clean, label_distribution, relation_fix, chinese_relation_rows, txt_to_csv, node_upsert, edge_upsert, import_counts)}


def _first(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def _fold(items: str) -> str:
    return f"list_reduce({items}, lambda a, b: CASE WHEN a = b THEN a ELSE regexp_replace(a || ' | ' || b, {STRIP}) END)"


def _list(values: str, empty: str = "''") -> str:
    return f"coalesce(nullif(array_to_string({values}, '|'), ''), {empty})"


def _merged(rows: str, order: str) -> str:
    united = ", ".join(f"list_filter(flatten(list(coalesce({c}, []) ORDER BY {order})), lambda x: x IS NOT NULL) AS {c}" for c in ("type", "domain_relevance", "chunk_ids"))
    lists = ", ".join(f"{_list(_first(c))} AS {c}" for c in ("type", "domain_relevance", "chunk_ids"))
    return f"""u AS (SELECT entity_name, {united}, list(coalesce(summary, '') ORDER BY {order}) AS s FROM {rows} WHERE entity_name IS NOT NULL GROUP BY entity_name),
        m AS (SELECT entity_name, {lists}, {_fold('s')} AS summary FROM u)"""


_ENRICHED = f"""kb AS (SELECT entity_name, min(entity_id) AS ord, arg_max(coalesce(type, []), entity_id) AS type, arg_max(coalesce(domain_relevance, []), entity_id) AS domain_relevance,
            arg_max(coalesce(summary, ''), entity_id) AS summary, arg_max(coalesce(chunk_ids, []), entity_id) AS chunk_ids FROM entities GROUP BY entity_name),
        ep AS (SELECT triple_id AS t, 0 AS side, coalesce(chunk_id, 'unknown') AS chunk, subject AS name FROM triples WHERE subject IS NOT NULL
            UNION ALL SELECT triple_id, 1, coalesce(chunk_id, 'unknown'), object FROM triples WHERE object IS NOT NULL),
        f AS (SELECT name, chunk, min(t * 2 + side) AS o FROM ep GROUP BY 1, 2),
        s AS (SELECT name, min(o) AS o, string_agg(chunk, '|' ORDER BY o) AS chunks FROM f GROUP BY 1),
        e AS (SELECT coalesce(kb.entity_name, s.name) AS entity_name, CASE WHEN kb.entity_name IS NULL THEN 'Unknown' ELSE {_list('type')} END AS type,
            CASE WHEN kb.entity_name IS NULL THEN 'unknown' ELSE {_list('domain_relevance')} END AS domain_relevance,
            CASE WHEN kb.entity_name IS NULL THEN '信息待补充' ELSE summary END AS summary, {_list('chunk_ids')} AS entity_chunk_id, coalesce(chunks, '') AS relation_chunk_id,
            kb.entity_name IS NULL AS new, coalesce(kb.ord * 2, s.o) AS o FROM kb FULL JOIN s ON kb.entity_name = s.name),
        nodes AS (SELECT 'entity_' || row_number() OVER (ORDER BY new, o) AS id, * FROM e)"""
_LABEL = f"""regexp_replace(split_part(type, '|', 1), {STRIP})"""
_CLEAN = rf"CASE WHEN regexp_extract({_LABEL}, '[\x{{4E00}}-\x{{9FFF}}]+') <> '' THEN regexp_extract({_LABEL}, '[\x{{4E00}}-\x{{9FFF}}]+') ELSE regexp_replace({_LABEL}, '[^\p{{L}}\p{{N}}_]', '', 'g') END"
_MATCHES = """k AS (SELECT entity_name, arg_max(coalesce(type, []), entity_id) AS type, arg_max(coalesce(summary, ''), entity_id) AS summary FROM entities WHERE entity_name <> '' GROUP BY 1),
        m AS (SELECT metadata, entity_name, type, summary, row_number() OVER (PARTITION BY metadata ORDER BY instr(chunk_content, entity_name) + length(entity_name), length(entity_name) DESC) AS place
            FROM chunks, k WHERE contains(chunk_content, entity_name))"""
_MENTIONS = """m0 AS (SELECT entity_name, summary, origin, extracted_at, entity_id, chunk_ids, list_filter(coalesce(type, []), lambda x: x IS NOT NULL) AS t, list_filter(coalesce(domain_relevance, []), lambda x: x IS NOT NULL) AS d FROM entities),
        m1 AS (SELECT *, unnest(range(greatest(len(t), len(d), 1))) AS class_place FROM m0),
        classed AS (SELECT entity_name, summary, origin, extracted_at, entity_id, chunk_ids, class_place, t[least(class_place + 1, len(t))] AS type, d[least(class_place + 1, len(d))] AS dr FROM m1),
        m2 AS (SELECT *, unnest(chunk_ids) AS chunk_id, unnest(range(len(chunk_ids))) AS chunk_place FROM classed),
        mentions AS (SELECT * FROM m2 WHERE chunk_id IS NOT NULL)"""
_WHOLE_MENTION = "entity_name IS NOT NULL AND type IS NOT NULL AND dr IS NOT NULL AND summary IS NOT NULL"
_BARE_CHUNKS = f"bare AS (SELECT metadata, regexp_replace(chunk_content, {STRIP}) AS text FROM chunks), todo AS (SELECT * FROM bare WHERE text <> '')"


def _asked(template: str, **values: str) -> str:
    """The digest of a rendered prompt."""
    out = f"'{template}'"
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return f"md5({out})"


def _built(order: str) -> str:
    """Ranges of mentions n, merged."""
    return f"""g AS (SELECT range, entity_name, list_filter(list(type ORDER BY {order}), lambda x: x IS NOT NULL) AS t, list_filter(list(dr ORDER BY {order}), lambda x: x IS NOT NULL) AS d,
            list(coalesce(summary, '') ORDER BY {order}) AS s, list(chunk_id ORDER BY {order}) AS c FROM n GROUP BY 1, 2),
        r AS (SELECT range, entity_name, {_first('t')} AS type, {_first('d')} AS domain_relevance, {_fold('s')} AS summary, {_first('c')} AS chunk_ids FROM g),
        {_merged('r', 'range')}"""


_KNOWN = f"""{_BARE_CHUNKS}, k AS (SELECT entity_name, arg_max(coalesce(type, []), entity_id) AS type, arg_max(coalesce(summary, ''), entity_id) AS summary FROM entities WHERE entity_name <> '' GROUP BY 1),
        hits AS (SELECT metadata, entity_name, type, summary, row_number() OVER (PARTITION BY metadata ORDER BY instr(text, entity_name) + length(entity_name), length(entity_name) DESC) AS place FROM todo, k WHERE contains(text, entity_name))"""
_PLACED = "p AS (SELECT triple_id, subject, relation, object, row_number() OVER (ORDER BY triple_id) - 1 AS ordinal FROM triples)"
_STANDING = "(SELECT DISTINCT entity_name FROM entities)"

ORACLE = {
    "entity_kb_build": f"""WITH {_MENTIONS}, n AS (SELECT *, chunk_id // 20 AS range FROM mentions WHERE entity_name IS NOT NULL),
        {_built('extracted_at NULLS FIRST, entity_id, chunk_place, class_place')} SELECT * FROM m""",
    "entity_kb_merge": f"WITH {_merged('entities', 'origin NULLS FIRST, entity_id')} SELECT * FROM m",
    "entity_lookup": f"WITH {_merged('entities', 'origin NULLS FIRST, entity_id')} SELECT * FROM m WHERE entity_name = '船体'",
    "entity_stats": "WITH k AS (SELECT entity_name, arg_max(coalesce(chunk_ids, []), entity_id) AS c FROM entities WHERE entity_name IS NOT NULL GROUP BY 1) SELECT count(*) AS entities, CAST(coalesce(sum(len(c)), 0) AS BIGINT) AS chunk_references FROM k",
    "entity_type_histogram": "WITH k AS (SELECT entity_name, arg_max(coalesce(type, []), entity_id) AS t FROM entities WHERE entity_name IS NOT NULL GROUP BY 1) SELECT type, count(*) AS entities FROM (SELECT unnest(t) AS type FROM k) GROUP BY 1",
    "dictionary_match": f"WITH {_MATCHES} SELECT metadata, entity_name, place FROM m",
    "match_topk_context": f"""WITH {_MATCHES}, l AS (SELECT metadata, string_agg('- ' || entity_name || ' (' || array_to_string(type[1:3], ', ') || '): ' || substr(summary, 1, 100) || '...', chr(10) ORDER BY place) AS context FROM m WHERE place <= 15 GROUP BY 1)
        SELECT metadata, coalesce(context, '未找到相关实体') AS context FROM chunks LEFT JOIN l USING (metadata)""",
    "match_all_json": f"""WITH {_MATCHES}, l AS (SELECT metadata, '[' || string_agg('{{"entity_name":' || to_json(entity_name) || ',"summary":' || to_json(summary) || '}}', ',' ORDER BY place) || ']' AS entities FROM m GROUP BY 1)
        SELECT metadata, coalesce(entities, '[]') AS entities FROM chunks LEFT JOIN l USING (metadata)""",
    "triples_streamed_by_day": "SELECT strftime(loaded_at, '%Y-%m-%d') AS day, relation, count(*) AS triples FROM triples GROUP BY 1, 2",
    "llm_parse_entities": f"WITH {_MENTIONS} SELECT entity_name, type, dr AS domain_relevance, summary, CAST(entity_id AS VARCHAR) AS chunk_id FROM classed WHERE origin IS DISTINCT FROM 'model_b' AND {_WHOLE_MENTION}",
    "llm_repairs": r"""WITH r AS (SELECT entity_id, entity_name, ['ok', 'repaired', 'repaired', 'repaired', 'empty', 'rejected'][entity_id % 6 + 1] AS status, ['plain', 'Aé', 'aqb', '\u12', NULL, NULL][entity_id % 6 + 1] AS summary FROM entities)
        SELECT CAST(entity_id AS VARCHAR) AS chunk_id, status, CASE WHEN summary IS NOT NULL THEN entity_name END AS entity_name, CASE WHEN entity_name IS NOT NULL THEN summary END AS summary FROM r""",
    "llm_rejects": "SELECT CAST(entity_id AS VARCHAR) AS chunk_id FROM entities WHERE origin = 'model_b'",
    "llm_parse_triples": "SELECT subject, relation, object, CAST(CAST(chunk_id AS BIGINT) AS VARCHAR) AS chunk_id FROM triples WHERE regexp_matches(chunk_id, '^[0-9]+$') AND subject IS NOT NULL AND relation IS NOT NULL AND object IS NOT NULL",
    "relation_pipeline": f"""WITH {_KNOWN}, l AS (SELECT metadata, '[' || string_agg('{{"entity_name":' || to_json(entity_name) || ',"type":' || to_json(type) || ',"summary":' || to_json(summary) || '}}', ',' ORDER BY place) || ']' AS entities FROM hits GROUP BY 1),
        t AS (SELECT CAST(chunk_id AS BIGINT) AS c, count(*) FILTER (subject IS NOT NULL AND relation IS NOT NULL AND object IS NOT NULL) AS n FROM triples WHERE regexp_matches(chunk_id, '^[0-9]+$') GROUP BY 1)
        SELECT CAST(metadata AS VARCHAR) AS chunk_id, {_asked(extract.RELATION_PROMPT, entities="coalesce(entities, '[]')", chunk_id="CAST(metadata AS VARCHAR)", text="text")} AS asked, n AS triples
        FROM todo LEFT JOIN l USING (metadata) JOIN t ON c = metadata""",
    "relation_rules": f"""WITH {_KNOWN} SELECT a.entity_name AS subject, '{extract.Rule.RELATION}' AS relation, b.entity_name AS object, CAST(a.metadata AS VARCHAR) AS chunk_id
        FROM hits a JOIN hits b ON a.metadata = b.metadata AND b.place = a.place + 1""",
    "triples_union": "SELECT subject, relation, object, chunk_id FROM triples UNION ALL SELECT entity_name, 'belongs_to', unnest(type), NULL FROM entities",
    "triples_by_month": "SELECT strftime(loaded_at, '%Y-%m') AS month, count(*) AS triples, count(DISTINCT struct_pack(s := subject, r := relation, o := object)) AS distinct_triples FROM triples GROUP BY 1",
    "triples_vocab_report": "SELECT relation, relation IS NOT NULL AND relation IN (SELECT relation FROM relation_vocab) AS in_vocabulary, count(*) AS triples, count(DISTINCT subject) AS subjects FROM triples GROUP BY 1",
    "enrich_entities": f"WITH {_ENRICHED} SELECT entity_name, type, domain_relevance, entity_chunk_id, relation_chunk_id, summary FROM e",
    "nodes_csv": f"""WITH {_ENRICHED} SELECT id AS "id:ID", entity_name AS name, summary, type, domain_relevance, coalesce(nullif(entity_chunk_id, ''), 'unknown') AS entity_chunk_id, coalesce(nullif(relation_chunk_id, ''), 'unknown') AS relation_chunk_id, 'Entity;' || type AS ":LABEL" FROM nodes""",
    "edges_csv": f"""WITH {_ENRICHED} SELECT a.id AS ":START_ID", b.id AS ":END_ID", t.relation AS ":TYPE" FROM triples t JOIN nodes a ON t.subject = a.entity_name JOIN nodes b ON t.object = b.entity_name""",
    "label_clean": f"""WITH {_ENRICHED} SELECT id AS "id:ID", {_CLEAN} AS ":LABEL" FROM nodes""",
    "label_distribution": f"WITH {_ENRICHED} SELECT {_CLEAN} AS label, count(*) AS nodes FROM nodes GROUP BY 1",
    "relation_fix": f"WITH {_PLACED} SELECT ordinal, subject, coalesce(v.relation, p.relation) AS relation, object, v.relation IS NOT NULL AS fixed FROM p LEFT JOIN relation_vocab v ON p.relation = v.label_zh",
    "chinese_relation_rows": rf"WITH {_PLACED} SELECT ordinal + 1 AS index, subject, relation, object FROM p WHERE regexp_matches(relation, '[\x{{4E00}}-\x{{9FFF}}]')",
    "txt_to_csv": f"""WITH {_PLACED}, l AS (SELECT string_split((ordinal + 1)::VARCHAR || ',' || coalesce(subject, '') || ',' || v.relation || ',' || coalesce(object, ''), ',') AS f FROM p JOIN relation_vocab v ON p.relation = v.label_zh)
        SELECT CAST(f[1] AS BIGINT) AS index, trim(trim(f[2], ' '), '"') AS subject, trim(trim(f[3], ' '), '"') AS relation, trim(trim(array_to_string(f[4:], ','), ' '), '"') AS object FROM l""",
    "entity_pipeline": f"""WITH {_MENTIONS}, {_BARE_CHUNKS}, n AS (SELECT *, chunk_id // 20 AS range FROM mentions WHERE chunk_id IN (SELECT metadata FROM todo) AND {_WHOLE_MENTION}),
        {_built('chunk_id, entity_id, class_place')}, f AS (SELECT entity_name, min(chunk_id) AS c FROM n GROUP BY 1)
        SELECT m.*, {_asked(extract.ENTITY_PROMPT, chunk_id="CAST(c AS VARCHAR)", text="text")} AS first_prompt FROM m JOIN f USING (entity_name) JOIN todo ON c = metadata""",
    "joint_pipeline": f"""WITH {_MENTIONS}, {_BARE_CHUNKS}, e AS (SELECT chunk_id AS c, count(*) FILTER ({_WHOLE_MENTION}) AS n FROM mentions GROUP BY 1),
        t AS (SELECT CAST(chunk_id AS BIGINT) AS c, count(*) FILTER (subject IS NOT NULL AND relation IS NOT NULL AND object IS NOT NULL) AS n FROM triples WHERE regexp_matches(chunk_id, '^[0-9]+$') GROUP BY 1)
        SELECT CAST(metadata AS VARCHAR) AS chunk_id, {_asked(extract.JOINT_PROMPT, chunk_id="CAST(metadata AS VARCHAR)", text="text")} AS asked, coalesce(e.n, 0) AS entities, coalesce(t.n, 0) AS triples
        FROM todo LEFT JOIN e ON e.c = metadata LEFT JOIN t ON t.c = metadata WHERE e.c IS NOT NULL OR t.c IS NOT NULL""",
    "quoted_txt_to_csv": f"""WITH {_PLACED} SELECT ordinal + 1 AS index, trim(coalesce(subject, '') || ', "x"') AS subject, v.relation, ltrim(rtrim(coalesce(object, ''))) || repeat(',' || coalesce(object, ''), 39) AS object FROM p JOIN relation_vocab v ON p.relation = v.label_zh""",
    "node_upsert": f"""WITH o AS (SELECT entity_name AS id, arg_max(coalesce(type, []), entity_id) AS type, arg_max(struct_pack(s := summary, o := origin), entity_id) AS v FROM entities WHERE loaded_at < '2024-07-01' GROUP BY 1),
        n AS (SELECT entity_name AS id, flatten(list(coalesce(type, []) ORDER BY entity_id)) AS type, arg_max(summary, entity_id) FILTER (summary IS NOT NULL) AS s, arg_max(origin, entity_id) FILTER (origin IS NOT NULL) AS og FROM entities WHERE loaded_at >= '2024-07-01' GROUP BY 1),
        j AS (SELECT coalesce(o.id, n.id) AS id, list_concat(coalesce(o.type, []), coalesce(n.type, [])) AS l, coalesce(n.s, o.v.s) AS summary, coalesce(n.og, o.v.o) AS origin FROM o FULL JOIN n ON o.id = n.id)
        SELECT id, {_list(_first('l'))} AS labels, summary, origin FROM j""",
    "edge_upsert": f'SELECT DISTINCT subject AS start, object AS "end", relation AS type FROM triples WHERE loaded_at IS NOT NULL AND subject IN {_STANDING} AND object IN {_STANDING}',
    "import_counts": f"SELECT (SELECT count(*) FROM entities WHERE entity_name IS NOT NULL) AS entities_imported, (SELECT count(*) FROM triples WHERE subject IN {_STANDING} AND object IN {_STANDING}) AS relations_imported",
}
