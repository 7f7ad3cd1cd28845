"""Repair of Markdown: headings, and images named after their captions.

Texts are DataFrames with a key and a text column; a null text stays null. Nothing is changed in place: every operator gives
the new text beside the old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelgraph.functions.text import SPACE, strip

# Numbered headings by level, chapters that keep their level, images named by a hash.
_NUMBERED = {2: r"\p{Nd}+\.\p{Nd}+", 3: r"\p{Nd}+\.\p{Nd}+\.\p{Nd}+"}
_CHAPTER = r"第[零一二三四五六七八九十百千\p{Nd}]+章"
_IMAGE = r"!\[\]\(images/([a-f0-9]+\.(?:jpg|png|jpeg|gif))\)"


def level_headings(text: Column) -> Column:
    """`# 1.2 Title` becomes a heading of level 2, `# 1.2.3 Title` one of level 3; also when the title is on a later line."""
    for level, number in _NUMBERED.items():
        text = F.regexp_replace(text, rf"(?md)^#{SPACE}+({number}){SPACE}+(.+)$", f"{'#' * level} $1 $2")
    return text


def lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line), 0-based; the lines of a text are those between line feeds."""
    return texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def heading_preview(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, old, new): the lines that `level_headings` would change, looked at line by line."""
    found = lines(texts, key, text).withColumn("new", level_headings(F.col("line")))
    return found.where("line <> new").select(key, "line_no", F.col("line").alias("old"), "new")


def demoted_line(line: Column) -> Column:
    """A line with a heading of level 1 that is no chapter becomes one of level 4, without indent."""
    right = F.regexp_replace(line, f"{SPACE}+\\z", "")
    single = right.rlike(f"^{SPACE}*#{SPACE}+") & ~right.rlike(f"^{SPACE}*##")
    return F.when(single & ~right.rlike(_CHAPTER), F.regexp_replace(line, f"^{SPACE}*#{SPACE}+", "#### ")).otherwise(line)


def _single(line: Column) -> Column:
    return F.regexp_replace(line, f"{SPACE}+\\z", "").rlike(f"^{SPACE}*#{SPACE}+")


def demote_headings(text: Column) -> Column:
    """`demoted_line` on every line of a text, within the row."""
    return F.array_join(F.transform(F.split(text, "\n"), demoted_line), "\n")


def demotion_log(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, action, old, new): `modify` or `retain` for every heading of level 1."""
    found = lines(texts, key, text).where(_single(F.col("line")) & ~F.col("line").rlike(f"^{SPACE}*##"))
    new = demoted_line(F.col("line"))
    return found.select(key, "line_no", F.when(F.col("line").rlike(_CHAPTER), "retain").otherwise("modify").alias("action"),
                        F.col("line").alias("old"), new.alias("new"))


def demotion_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(action, headings)."""
    return demotion_log(texts, key, text).groupBy("action").agg(F.count("*").alias("headings"))


def image_captions(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, old_name, new_name, caption): images whose next line is a caption `图1.2 description`.

    The new name is the description without characters that file names can't hold, blanks as underscores, always `.jpg`.
    The next line is taken by a window over each text's lines, so a text of any length is split over no task boundary.
    """
    following = F.lead("line").over(Window.partitionBy(key).orderBy("line_no"))
    found = lines(texts, key, text).withColumn("next", strip(following))
    found = found.where(F.col("line").contains("![](") & F.col("line").contains("images/")).select(
        key, "line_no", F.regexp_extract("line", _IMAGE, 1).alias("old_name"),
        F.regexp_extract("next", rf"^图[\p{{Nd}}.\-]+{SPACE}+([^\n]+)", 1).alias("caption"))
    named = F.replace(F.regexp_replace(strip(F.col("caption")), r'[<>:"/\\|?*]', ""), F.lit(" "), F.lit("_"))
    return found.where("old_name <> '' AND caption <> ''").select(key, "line_no", "old_name", F.concat(named, F.lit(".jpg")).alias("new_name"), "caption")


def rewrite_images(texts: DataFrame, captions: DataFrame, key: str, text: str, existing: DataFrame | None = None) -> DataFrame:
    """(key, text, new_text, renamed): all references to captioned images under their new names, in the order of the lines.

    With `existing` (old_name) only images that exist are renamed.
    """
    if existing is not None:
        captions = captions.join(existing.select("old_name").distinct(), "old_name", "left_semi")
    pairs = captions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", "old_name", "new_name"))).alias("pairs"))
    new = F.aggregate("pairs", F.col(text), lambda t, p: F.replace(t, F.concat(F.lit("images/"), p["old_name"]), F.concat(F.lit("images/"), p["new_name"])))
    rows = texts.select(key, text).join(pairs, key, "left")
    return rows.select(key, F.col(text).alias("text"), F.coalesce(new, F.col(text)).alias("new_text"), F.coalesce(F.size("pairs"), F.lit(0)).alias("renamed"))


def caption_collisions(captions: DataFrame) -> DataFrame:
    """(new_name, images): new names that several different images would share."""
    return captions.groupBy("new_name").agg(F.countDistinct("old_name").alias("images")).where("images > 1")


def image_diagnosis(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, old_name, caption, loose_caption): what is found for every image line, with a looser caption pattern."""
    following = F.lead("line").over(Window.partitionBy(key).orderBy("line_no"))
    found = lines(texts, key, text).withColumn("next", strip(following))
    return found.where(F.col("line").contains("![](") & F.col("line").contains("images/")).select(
        key, "line_no", F.regexp_extract("line", _IMAGE, 1).alias("old_name"),
        F.regexp_extract("next", rf"^图[\p{{Nd}}.\-]+{SPACE}+([^\n]+)", 1).alias("caption"),
        F.regexp_extract("next", rf"^图([^ ]+){SPACE}+([^\n]+)", 2).alias("loose_caption"))


def is_hash_name(name: Column) -> Column:
    """Whether a file still has the name of its content's SHA-256."""
    return name.rlike(r"(?iU)^[a-f0-9]{64}\.\w+\z")


def delete_plan(listing: DataFrame, name: str = "name") -> DataFrame:
    """The listed files that nobody has named yet; deleting them is left to the caller."""
    return listing.where(is_hash_name(F.col(name)))
