"""Visually identical text with different characters: one consistent form per value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelgraph.functions.lookalike import look_key
from keelgraph.llm.forms import fold_key
from keelgraph.session import durable


def consistent_forms(values: DataFrame, column: str) -> DataFrame:
    """One row (column, form, shown) per distinct value.

    `form` is the comparison form: composed compatibility normalisation, full case folding, mapped white space, no
    default-ignorable characters, look-alike letters brought to one script. `shown` is the form to store: the same, but
    keeping what a reader can see (case, accents, raised figures). Each distinct value is worked on once.

    A null value gives no row; an empty one, or one of nothing visible, the empty forms.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return distinct.withColumn("form", fold_key(column)).withColumn("shown", look_key(column))


#: Spellings of one class that one task pairs with the others of the class; a larger class is cut into parts.
CLASS_PART = 500


def same_looking(values: DataFrame, column: str) -> DataFrame:
    """(name_a, name_b): every pair of different non-empty values that look the same, name_a < name_b by code points.

    Values that look the same share the comparison form, so the form is worked out for each distinct value and those that
    share it with no other leave; of the rest the stored form is worked out, and equal ones prove a pair. A class of many
    spellings, such as all values of nothing visible, is cut into parts, each of which meets the whole class, so that no
    task has more than its part. Empty values take no part; a table without pairs gives no rows.
    """
    distinct = values.select(column).where(F.col(column) != "").distinct()
    forms = durable(distinct.select(column, fold_key(column).alias("form")))
    shared = forms.groupBy("form").agg(F.count("*").alias("n")).where("n > 1").select("form")
    spelt = durable(forms.join(shared, "form", "left_semi").select(column, look_key(column).alias("shown")))
    classes = spelt.groupBy("shown").agg(F.ceil(F.count("*") / CLASS_PART).cast("int").alias("parts"), F.count("*").alias("n")).where("n > 1").drop("n")
    sized = spelt.join(classes, "shown")
    one = sized.select(F.col(column).alias("name_a"), "shown", F.pmod(F.hash(column), "parts").alias("part"))
    other = sized.select(F.col(column).alias("name_b"), "shown", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return one.join(other, ["shown", "part"]).where("name_a < name_b").select("name_a", "name_b")
