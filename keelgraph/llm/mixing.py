"""Mixing sources to target shares of all tokens, by fitting budgets to counts of documents by length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelgraph.llm.encoding import token_length
from keelgraph.session import durable, spread

#: The part of a budget, in tokens, that the subset-sum search decides exactly.
WINDOW = 20_000


def fit_budget(lengths: np.ndarray, supply: np.ndarray, budget: int, seed: int = 0, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to use, at most `supply` of each, so that the tokens come nearest below budget.

    Every length first gives the same fraction of its supply; single documents follow in seeded order until less than the
    window is left; that rest is filled by a bounded knapsack over the remaining counts.
    """
    total = int((lengths * supply).sum())
    if budget >= total:
        return supply.copy()
    # whole numbers, since products of large supplies and budgets aren't exact as floats
    used = np.array([int(n) * budget // total for n in supply], np.int64) if total else np.zeros_like(supply)
    rest = budget - int((lengths * used).sum())
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        if rest < window:
            break
        if used[i] < supply[i] and lengths[i] <= rest:
            used[i] += 1
            rest -= int(lengths[i])
    # A rest above the window is left when every length has given one more: then the largest steps go on.
    for i in np.argsort(-lengths, kind="stable"):
        if rest < window:
            break
        more = min(int(supply[i] - used[i]), (rest - window) // int(lengths[i]) + 1, rest // int(lengths[i]))
        used[i] += more
        rest -= more * int(lengths[i])
    if rest >= window:
        return used  # no length that still has documents fits in what is left
    reached, item = np.zeros(rest + 1, bool), np.full(rest + 1, -1, np.int64)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        left, part = min(int(supply[i] - used[i]), rest // int(lengths[i])), 1
        while left > 0 and not reached[rest]:
            part = min(part, left)
            weight = part * int(lengths[i])
            new = np.zeros_like(reached)
            new[weight:] = reached[: rest + 1 - weight]
            new &= ~reached
            item[new] = len(items)
            items.append((int(i), part))
            reached |= new
            left, part = left - part, part * 2
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, part = items[item[at]]
        used[i] += part
        at -= part * int(lengths[i])
    return used


def seeded_rank(df: DataFrame, group: list[str], unique: str, seed: int, rank: str = "rank") -> DataFrame:
    """df with the 0-based rank of each row within its group, in an order drawn from the seed.

    The hashed order is cut into as many parts as shuffles have partitions, so that a group holding a third of all rows is
    ranked by all tasks. `unique` tells the rows of a group apart; rows equal in it too are ranked in any order.
    """
    bits = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    df = df.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(unique)))
    df = df.withColumn("_part", F.shiftrightunsigned("_hash", 64 - bits).cast("int"))
    sizes = df.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_hash", unique)) - 1
    same = F.col("_part") == F.col("_p")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    numbered = df.withColumn("_own", own).join(offsets, same)
    return numbered.withColumn(rank, (F.col("_own") + F.col("_offset")).cast("long")).drop("_hash", "_part", "_own", "_offset", "_p", *[f"_g_{c}" for c in group])


def sized(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, tokens) of the documents with any token, kept so that no text is encoded twice."""
    # Filtered only after it is kept: else the filter would have every text encoded a second time.
    return durable(spread(documents.select("doc_id", "source", "text")).select("doc_id", "source", token_length(documents.sparkSession, path)("text").alias("tokens"))).where("tokens > 0")


def plan(sizes: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 0) -> DataFrame:
    """(source, tokens, documents, uses): how often documents of each source and length are used in all.

    Without a total the mix is as large as the scarcest source allows. Sources of the list that have no documents can't be
    in the mix; the others keep the proportions of their shares.
    """
    listed = _listed(targets)
    counts = sizes.groupBy("source", "tokens").agg(F.count("*").alias("documents")).join(listed, "source")
    supply = counts.groupBy("source", "target_share").agg(F.sum(F.col("tokens") * F.col("documents") * F.col("max_repeats")).alias("supply"))
    # one row per source of the list
    ends = supply.agg(F.sum("target_share").alias("shares"), F.min(F.col("supply") / F.col("target_share")).alias("most")).first()
    shares = ends["shares"] or 1.0
    size = total if total is not None else int((ends["most"] or 0) * shares)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("tokens")
        budget = int(round(size * rows["target_share"].iloc[0] / shares))
        available = rows["documents"].to_numpy(np.int64) * rows["max_repeats"].to_numpy(np.int64)
        rows["uses"] = fit_budget(rows["tokens"].to_numpy(np.int64), available, budget, seed)
        rows["budget"] = budget
        return rows[["source", "tokens", "documents", "uses", "budget"]]

    return durable(counts.groupBy("source").applyInPandas(fit, "source string, tokens long, documents long, uses long, budget long"))


def _listed(targets: DataFrame) -> DataFrame:
    return targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def mix(sizes: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, uses): the documents of the mix and how often each is used, at most its source's repeats.

    Of one source and length all documents are used equally often, or once more for those first by the seed. Documents
    with null or empty text, and of sources that aren't listed, take no part. Repeated rows count as documents each.
    """
    ranked = seeded_rank(sizes.join(planned, ["source", "tokens"]).where("uses > 0"), ["source", "tokens"], "doc_id", seed)
    uses = F.floor(F.col("uses") / F.col("documents")) + F.when(F.col("rank") < F.col("uses") % F.col("documents"), 1).otherwise(0)
    return ranked.select("doc_id", "source", "tokens", uses.cast("long").alias("n")).where("n > 0").withColumnRenamed("n", "uses")


def mix_report(sizes: DataFrame, planned: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source: target_share, documents and tokens it has, its budget, tokens and share in the mix."""
    has = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available_tokens"))
    got = planned.groupBy("source").agg(F.max("budget").alias("budget"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens"))
    whole = got.agg(F.sum("tokens")).first()[0]
    rows = _listed(targets).join(has, "source", "left").join(got, "source", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    share = F.coalesce(F.col("tokens") / F.lit(whole), F.lit(0.0))
    return rows.select("source", "target_share", "max_repeats", number("documents"), number("available_tokens"), number("budget"), number("tokens"), share.alias("actual_share"))
