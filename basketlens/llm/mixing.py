"""Mixing sources to target weights by temperature (operator 1).

A source with the share p of all tokens gets a weight in proportion to p ** a. The
exponent a is found by bisection on a grid of millionths: the largest that still
reaches the wanted entropy, raised where sources would be repeated too often. The
weights become token quotas. A source is drawn in passes; each pass is a new random
permutation of the source's documents, held in blocks, and the last pass stops at the
block and the document where the quota is used up.

Every sum over a source is made of block sums, and a source of n documents has about
sqrt(n) blocks, so no task meets more than about sqrt(n) rows of one source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, word_count

SLACK = 1e-12
GRID = 1_000_000
SLOTS = 1000


def _hash32(*parts: Column) -> Column:
    """A number below 2 ** 32 that SQL engines agree on."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def _largest(holds, low: int, high: int) -> int | None:
    """Bisect for the largest grid point of [low, high] where a falling condition holds."""
    if not holds(low):
        return None
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if holds(middle) else (low, middle - 1)
    return low


def mix_exponent(
    shares: DataFrame, entropy_share: float | None, max_repeats: float, budget_tokens: int | None
) -> tuple[int, float]:
    """The exponent in millionths, and ln of the sum of powers at it.

    ``shares`` has one row per source with a positive ``p``. Each step of the bisection
    is one small aggregate over it; only sums reach the driver.
    """
    shares = shares.select(F.log("p").alias("ln_p"), F.col("tokens"))
    n, total, low, high = shares.agg(
        F.count(F.lit(1)), F.sum("tokens"), F.min("ln_p"), F.max("ln_p")
    ).first()
    sums: dict[int, tuple[float, float]] = {}

    def at(point: int) -> tuple[float, float]:
        if point not in sums:
            power = F.exp(F.col("ln_p") * (point / GRID))
            z, moment = shares.agg(F.sum(power), F.sum(power * F.col("ln_p"))).first()
            sums[point] = (math.log(z), math.log(z) - point / GRID * moment / z)
        return sums[point]

    def often(point: int) -> float:
        """Passes over the source that is repeated most."""
        exponent = point / GRID
        if budget_tokens is None:
            return math.exp((1 - exponent) * (high - low))
        return budget_tokens / total * math.exp((exponent - 1) * low - at(point)[0])

    point = GRID
    if entropy_share is not None:
        wanted = entropy_share * math.log(n)
        found = _largest(lambda x: at(x)[1] >= wanted - 1e-12, 0, GRID)
        point = 0 if found is None else found
    if often(point) > max_repeats * (1 + 1e-12):
        above = _largest(lambda x: often(x) > max_repeats * (1 + 1e-12), point, GRID)
        point = min(GRID, above + 1)
    return point, at(point)[0]


def mix_sources(
    docs: DataFrame,
    entropy_share: float | None = 0.95,
    max_repeats: float = 4.0,
    budget_tokens: int | str | None = "corpus",
    seed: int = 42,
) -> DataFrame:
    """One row per drawn document and pass: doc_id, source, epoch, slot, n_tokens, weight.

    ``entropy_share`` is the wanted entropy of the weights as a share of the largest
    possible one; ``max_repeats`` bounds the passes over any source and wins where both
    cannot hold. ``budget_tokens`` is the number of tokens to draw, "corpus" for as many
    as there are, or None for the smallest number that draws every document at least
    once. A budget above ``max_repeats`` times the corpus gives quotas of that many
    passes. ``slot`` orders the mix: any prefix of slots has the target weights.

    Tokens are words. A null source counts as the source named by the empty text.
    Documents without words carry no tokens and are never drawn. Repeated rows are drawn
    as often as they occur. Other columns are ignored; an empty table gives no rows.
    """
    rows = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            word_count(F.col("text")).alias("n_tokens"),
        ).where("n_tokens > 0")
    )
    sources = materialise(
        rows.groupBy("source").agg(
            F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")
        )
    )
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if total == 0:
        return rows.select(
            "doc_id", "source", F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("slot"), "n_tokens", F.lit(0.0).alias("weight")
        )
    budget = total if budget_tokens == "corpus" else budget_tokens
    shares = materialise(sources.withColumn("p", F.col("tokens") / F.lit(total)))
    point, ln_z = mix_exponent(shares, entropy_share, max_repeats, budget)

    # Only the reported weight is rounded: a source of a few words in a large corpus has one
    # near the last decimal. The slack keeps whole numbers whole whatever the last bits say.
    share = F.exp(F.log("p") * F.lit(point / GRID) - F.lit(ln_z))
    weighted = shares.withColumn("share", share).withColumn("weight", F.round("share", 9))
    if budget is None:
        budget = weighted.agg(F.max(F.ceil(F.col("tokens") / F.col("share") * F.lit(1 - SLACK)))).first()[0]
    limit = F.floor(F.col("tokens") * F.lit(float(max_repeats)))
    quotas = weighted.select(
        "source",
        "weight",
        "tokens",
        F.least(F.floor(F.lit(budget) * F.col("share") * F.lit(1 + SLACK)), limit).alias("quota"),
        F.ceil(F.sqrt("n_docs")).cast("long").alias("n_blocks"),
    ).where("quota > 0")

    last = F.ceil(F.col("quota") / F.col("tokens")).cast("long") - 1
    drawn = (
        rows.join(quotas, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("key", _hash32(F.lit(seed), F.col("epoch"), F.col("doc_id")))
        .withColumn("block", F.col("key") % F.col("n_blocks"))
    )
    drawn = materialise(drawn)
    block = Window.partitionBy("source", "epoch").orderBy("block")
    before = (
        drawn.groupBy("source", "epoch", "block")
        .agg(F.sum("n_tokens").alias("block_tokens"))
        .withColumn("before_block", F.sum("block_tokens").over(block) - F.col("block_tokens"))
        .drop("block_tokens")
    )
    inside = (
        Window.partitionBy("source", "epoch", "block")
        .orderBy("key", F.col("doc_id").asc_nulls_first(), "n_tokens")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = (
        F.col("epoch") * F.col("tokens")
        + F.col("before_block")
        + F.sum("n_tokens").over(inside)
        - F.col("n_tokens")
    )
    return (
        drawn.join(before, ["source", "epoch", "block"])
        .withColumn("start", start)
        .where("start < quota")
        .select(
            "doc_id",
            "source",
            "epoch",
            F.floor(F.col("start") * SLOTS / F.col("quota")).cast("long").alias("slot"),
            "n_tokens",
            "weight",
        )
    )
