"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is
bisected: the largest at which the weights reach the target entropy, but not so small
that a source is repeated more often than the limit. The weights are realised as
passes over each source: whole passes, and part of one that takes blocks in a fixed
random order until its budget of tokens is used. Every pass permutes the blocks anew.
Only DataFrame functions run; the table of sources stays a table, and each step of the
bisection folds it to one row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import carried, running, staged, text_of

MADE = ("source_weight", "mix_copy", "mix_block", "mix_at")
STEPS = 24


def source_tokens(docs: DataFrame, source: str, tokens) -> DataFrame:
    """(source, docs, tokens): folded before the shuffle, so that a hot source is a few rows."""
    return docs.groupBy(source).agg(F.count("*").alias("docs"), F.sum(tokens).alias("tokens"))


def bisect(holds, low: float = 0.0, high: float = 1.0, largest: bool = True) -> float:
    """The largest (or smallest) exponent found at which holds(exponent), monotone in it."""
    if holds(high if largest else low):
        return high if largest else low
    for _ in range(STEPS):
        middle = (low + high) / 2
        if holds(middle) == largest:
            low = middle
        else:
            high = middle
    return low if largest else high


def exponent(stats: DataFrame, target_entropy: float | None, max_passes: float | None) -> float:
    """The exponent for the shares in stats (tokens > 0).

    target_entropy is a part (0 to 1) of the logarithm of the number of sources.
    """
    raised = lambda a: F.pow(F.col("share"), F.lit(a))

    def even_enough(a: float) -> bool:
        # Entropy of w = s**a / z is ln z - a * sum(s**a ln s) / z.
        row = stats.agg(F.sum(raised(a)).alias("z"), F.sum(raised(a) * F.ln("share")).alias("t"),
                        F.count("*").alias("n")).first()
        entropy = math.log(row.z) - a * row.t / row.z
        return entropy >= target_entropy * math.log(row.n) - 1e-12

    ends = stats.agg(F.max("share").alias("top"), F.min("share").alias("least")).first()
    if ends.top is None:
        return 1.0

    def few_passes(a: float) -> bool:
        # Passes of a source against the one with fewest: (s / s_max) ** (a - 1).
        return (ends.least / ends.top) ** (a - 1) <= max_passes + 1e-12

    a = 1.0 if target_entropy is None else bisect(even_enough, largest=True)
    return a if max_passes is None else max(a, bisect(few_passes, largest=False))


def plan(stats: DataFrame, target_entropy: float | None, max_passes: float | None, budget: float | None) -> DataFrame:
    """(source, tokens, weight, goal): goal is the source's tokens in the mixture.

    Without a budget it is the smallest at which no source falls short of one pass.
    """
    total = stats.agg(F.sum("tokens").alias("t")).first().t or 1
    stats = staged(stats.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(total))), "sources")
    a = exponent(stats, target_entropy, max_passes)
    sums = stats.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.max(F.pow("share", F.lit(1 - a))).alias("r")).first()
    z = sums.z or 1.0
    # Without a budget the source with fewest passes, the largest, has exactly one: z * max(share ** (1 - a)) shares.
    amount = float(budget) if budget is not None else total * z * (sums.r or 1.0)
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    # Floating point must not turn one whole pass into slightly less.
    return stats.withColumn("weight", weight).withColumn("goal", F.floor(F.col("weight") * F.lit(amount) + F.lit(1e-6)))


def mix_sources(docs: DataFrame, target_entropy: float | None = 0.95, max_passes: float | None = 4.0,
                budget: float | None = None, source_col: str = "source", id_col: str = "doc_id",
                text_col: str = "text", block_tokens: int = 1 << 16, block_share: float = 0.01,
                seed: int = 17) -> DataFrame:
    """docs, each row as often as its source's weight asks, with source_weight, mix_copy, mix_block, mix_at.

    Tokens of a text are its words plus one. mix_copy counts a row's copies from 0;
    mix_block is its block in the source; mix_at in [0, 1) orders the mixture: at any
    point of it the sources are present by their weights, and blocks stay together.
    Without a budget (in tokens), every row occurs at least once. With one, a source
    whose goal is less than its tokens gives only its first blocks: blocks are
    taken as long as fewer than goal tokens came before them, so a goal is
    exceeded by less than one block. A block has about block_tokens tokens, at most about
    the share block_share of its source, so that small sources meet their weights too (one
    text is never cut, so a block is at least a text). A null source is one source of its own; null or
    empty texts count one token; repeated rows are rows of their own. Columns named
    like the results are replaced. An empty table gives an empty table.
    """
    tokens = (F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")
    work = docs.select(carried(docs, *MADE), F.col(f"`{source_col}`").isNull().alias("__none"),
                       F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("__source"),
                       tokens.alias("__tokens"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text_of(text_col)).alias("__key"))
    keys = ["__none", "__source"]
    sources = plan(staged(work.groupBy(*keys).agg(F.sum("__tokens").alias("tokens")), "source-tokens"),
                   target_entropy, max_passes, budget)
    sources = staged(sources.withColumn("blocks", F.ceil(F.col("tokens") / F.least(
        F.lit(float(block_tokens)), F.greatest(F.lit(1.0), F.col("tokens") * block_share))))
                            .withColumn("whole", F.floor(F.col("goal") / F.col("tokens")))
                            .withColumn("part", F.col("goal") % F.col("tokens")), "source-plan")
    # One row for each source: far below the limit of broadcasting unless there are millions; Spark decides by size.
    blocked = work.join(sources, keys).withColumn("mix_block", F.pmod("__key", F.col("blocks")))
    last = staged(blocked.groupBy(*keys, "mix_block").agg(
        F.sum("__tokens").alias("size"), F.first("part").alias("part"), F.first("whole").alias("whole")), "blocks")
    # The part pass takes blocks by the order of a hash, while fewer tokens than its budget came before.
    turn = last.withColumn("turn", F.xxhash64(F.lit(seed), "whole", *keys, "mix_block"))
    # Staged, so that its size is known before the documents would be shuffled for the join.
    taken = staged(running(turn, keys, ["turn", "mix_block"], "before", F.col("size"))
                   .select(*keys, "mix_block", (F.col("before") < F.col("part")).cast("int").alias("extra")), "taken")
    copies = (blocked.join(taken, [*keys, "mix_block"])
              .withColumn("__copies", (F.col("whole") + F.col("extra")).cast("int")).where("__copies > 0")
              .withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1))))
    # Each pass permutes its blocks: a block's place in the pass is uniform, the pass's place in the mixture in order.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "mix_copy", *keys, "mix_block"), 11) / F.lit(float(1 << 53))
    span = F.greatest(F.col("goal") / F.col("tokens"), F.col("mix_copy") + 1)
    return copies.select("__doc.*", F.col("weight").alias("source_weight"), "mix_copy",
                         F.col("mix_block").cast("long"), ((F.col("mix_copy") + place) / span).alias("mix_at"))
