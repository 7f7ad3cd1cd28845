"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, for Java patterns.
SPACE = r"[\t-\r\x{85}\p{Z}]"

# What stands for missing parts of the graph.
NO_SUMMARY, NO_TYPE, NO_RELEVANCE, NO_CHUNK, NO_MATCH = "信息待补充", "Unknown", "unknown", "unknown", "未找到相关实体"


def strip(text: Column) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", "")


def newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def fold_summaries(summaries: Column) -> Column:
    """One summary out of a list in order: each one is added after a bar unless it equals what is there already.

    The comparison is with the whole summary so far, so a list A, B, A gives `A | B | A`.
    """
    return F.aggregate(
        F.slice(summaries, F.lit(2), F.greatest(F.size(summaries) - 1, F.lit(0))),
        F.element_at(summaries, F.lit(1)),
        lambda acc, x: F.when(acc == x, acc).otherwise(strip(F.concat(acc, F.lit(" | "), x))),
    )


def ordered(order: list[Column], value: Column) -> Column:
    """Aggregate: the values of a group in order."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*keys, value.alias("value")))), lambda x: x["value"])


def clean_label(label: Column) -> Column:
    """The first run of ideographs of the first part of a node label, or its word characters; null gives `Unknown`."""
    part = strip(F.substring_index(F.regexp_replace(label, r"^Entity;", ""), "|", 1))
    chinese = F.regexp_extract(part, r"([\x{4E00}-\x{9FFF}]+)", 1)
    bare = F.regexp_replace(part, r"[^\p{L}\p{N}_]", "")
    return F.when(label.isNull(), NO_TYPE).when(chinese != "", chinese).otherwise(bare)


def joined(items: Column, empty: str | None = None) -> Column:
    """List items joined by a bar; an empty or null list gives `empty`, or the empty string."""
    text = F.array_join(F.transform(items, lambda x: x.cast("string")), "|")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(empty or ""))
