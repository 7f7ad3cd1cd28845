"""The comparison form of a text: what looks the same, and letter case and raised figures besides, is one."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.functions.lookalike import look


def fold(s: str) -> str:
    """Composed compatibility form, full case folding, one kind of space and nothing invisible."""
    folded = unicodedata.normalize("NFKC", look(s)).casefold()
    return " ".join(unicodedata.normalize("NFKC", folded).split())


@F.pandas_udf(T.StringType())
def fold_key(values: pd.Series) -> pd.Series:
    """`fold` of each string, of every distinct value of a batch once; null gives null."""
    return values.map({v: fold(v) for v in values.dropna().unique()}).astype(object)
