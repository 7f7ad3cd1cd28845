"""Relation fixes by place in the edge table, and the quoted text files they come in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_fixes(edges: DataFrame, fixes: DataFrame, ordinal: str, fix_order: str, relation: str = "relation") -> DataFrame:
    """edges with the relation of those replaced that a fix names by 1-based place, and a column `fixed`.

    Of several fixes of one place the last by `fix_order` counts; a fix changes nothing but the relation.
    """
    last = fixes.groupBy("index").agg(F.max_by("relation", fix_order).alias("_new"))
    placed = edges.join(last, F.col(ordinal) + 1 == F.col("index"), "left")
    return placed.select(*[F.coalesce("_new", relation).alias(c) if c == relation else c for c in edges.columns], F.col("index").isNotNull().alias("fixed"))


def fixes_out_of_range(edges: DataFrame, fixes: DataFrame, ordinal: str) -> DataFrame:
    """The fixes whose place no edge has."""
    return fixes.join(edges.select((F.col(ordinal) + 1).alias("index")), "index", "left_anti")


def fix_mismatches(edges: DataFrame, fixes: DataFrame, ordinal: str) -> DataFrame:
    """(index, subject, object, fix_subject, fix_object): fixes that name other ends than the edge they change."""
    own = edges.select((F.col(ordinal) + 1).alias("index"), "subject", "object")
    named = fixes.select("index", F.col("subject").alias("fix_subject"), F.col("object").alias("fix_object"))
    return own.join(named, "index").where("NOT (subject <=> fix_subject AND object <=> fix_object)").select("index", "subject", "object", "fix_subject", "fix_object")


_HEADER = ("index,subject,relation,object",)


def _unquoted(value):
    return F.btrim(F.trim(F.regexp_replace(value, "^\ufeff", "")), F.lit('"'))


def text_to_fixes(lines: DataFrame, value: str = "value") -> DataFrame:
    """(index, subject, relation, object) of lines `"1,subject,relation,object"`, split at the first three commas.

    A byte order mark, quotes around, blanks and the header are dropped; lines with fewer parts, or no number first, too.
    """
    bare = lines.select(_unquoted(F.col(value)).alias("v")).where(~F.col("v").isin(*_HEADER) & (F.col("v") != ""))
    part = F.split("v", ",", 4)
    clean = lambda i: F.btrim(F.trim(F.get(part, i)), F.lit('"'))
    rows = bare.where(F.size(part) == 4).select(F.expr("try_cast(trim(split(v, ',', 4)[0]) AS BIGINT)").alias("index"), clean(1).alias("subject"), clean(2).alias("relation"), clean(3).alias("object"))
    return rows.where("index IS NOT NULL")


def csv_to_fixes(lines: DataFrame, value: str = "value") -> DataFrame:
    """As `text_to_fixes`, but fields may be quoted with doubled quotes inside; fields beyond the fourth, however many, belong
    to the object. Lines of fewer than four fields are dropped.
    """
    bare = lines.select(_unquoted(F.col(value)).alias("v")).where(~F.col("v").isin(*_HEADER) & (F.col("v") != ""))
    # with a comma in front every field has one, so that an empty first field is found as well
    found = F.regexp_extract_all(F.concat(F.lit(","), "v"), F.lit(r',("(?:[^"]|"")*"[^,]*|[^,]*)'), F.lit(1))
    plain = lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, '^"((?:[^"]|"")*)"', "$1"), F.lit('""'), F.lit('"'))).otherwise(x)
    fields = bare.select(F.transform(found, plain).alias("f")).where(F.size("f") >= 4)
    rest = F.concat(F.array(F.trim(F.col("f")[3])), F.slice("f", F.lit(5), F.greatest(F.size("f") - 4, F.lit(0))))
    rows = fields.select(F.expr("try_cast(trim(f[0]) AS BIGINT)").alias("index"), F.trim(F.col("f")[1]).alias("subject"), F.trim(F.col("f")[2]).alias("relation"), F.array_join(rest, ",").alias("object"))
    return rows.where("index IS NOT NULL")
