"""Exact dedup by deterministic block naming (operator 7).

Every text, without its space characters, is cut into blocks of a fixed size. Distinct
blocks are sorted and numbered; the number is the block's name. Adjacent names form
pairs, distinct pairs are sorted and numbered in turn, and so on until each document
has one name. Equal names of one level mean equal texts, because every name stands for
exactly one text: nothing rests on the absence of hash collisions.

The text moves through one shuffle, in the step that finds the distinct blocks. An
occurrence finds its name by the block's 64-bit hash; blocks that share their hash with
a different block ("twins") are matched by text instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, text_or_empty, without_spaces

BLOCK_CHARS = 4096


def _blocks(text: Column, size: int) -> Column:
    """Consecutive blocks of ``size`` code points; an empty text is one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(found)


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Number distinct rows: sorted in each partition, so a repeated task numbers alike."""
    return distinct.sortWithinPartitions(*keys).withColumn(
        "name", F.monotonically_increasing_id()
    )


def _block_names(rows: DataFrame, blocks: Column, fingerprint) -> DataFrame:
    """(row, at, name) of every block of every row."""
    texts = rows.select(F.explode(blocks).alias("block"))
    distinct = texts.select(fingerprint(F.col("block")).alias("print"), "block").distinct()
    names = materialise(_numbered(distinct, "print", "block").select("print", "name"))
    twins = materialise(names.groupBy("print").count().where("count > 1").select("print"))
    places = rows.select("row", F.posexplode(F.transform(blocks, lambda b: fingerprint(b))).alias("at", "print"))
    found = places.join(names.join(twins, "print", "left_anti"), "print").select("row", "at", "name")
    if twins.isEmpty():
        return found
    # Twins are named once more, by their text; only their blocks move for that. Their
    # names are below -1, so that they differ from all others.
    again = (
        rows.select("row", F.posexplode(blocks).alias("at", "block"))
        .withColumn("print", fingerprint(F.col("block")))
        .join(twins, "print", "left_semi")
        .drop("print")
    )
    again = materialise(again)
    named = materialise(_numbered(again.select("block").distinct(), "block"))
    by_text = again.join(named, "block").select("row", "at", (-2 - F.col("name")).alias("name"))
    return found.unionByName(by_text)


def _pair_names(names: DataFrame) -> DataFrame:
    """Name the adjacent pairs of every row's names; a last odd name is paired with -1."""
    at = F.sequence(F.lit(0), F.expr("cast((size(names) - 1) div 2 as int)"))
    pair = F.transform(
        at,
        lambda i: F.struct(
            F.get("names", i * 2).alias("left"),
            F.coalesce(F.get("names", i * 2 + 1), F.lit(-1).cast("long")).alias("right"),
        ),
    )
    places = materialise(names.select("row", F.posexplode(pair).alias("at", "pair")).select("row", "at", "pair.*"))
    distinct = materialise(_numbered(places.select("left", "right").distinct(), "left", "right"))
    return _gather(places.join(distinct, ["left", "right"]).select("row", "at", "name"))


def _gather(named: DataFrame) -> DataFrame:
    """(row, names): the names of a row in order; no longer than the row's text."""
    return materialise(
        named.groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("pairs"))
        .select("row", F.col("pairs.name").alias("names"))
    )


def exact_duplicates(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, fingerprint=F.xxhash64
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting space characters; null counts as
    empty, and empty texts are equal to each other. Of equal texts the row with the most
    code points stays, then the smallest doc_id (null last). Rows with the same doc_id
    are separate rows, of which exactly one stays. Other columns of ``docs`` are ignored;
    an empty table gives an empty result.
    """
    bare = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text_or_empty("text")).cast("long").alias("n_points"),
        without_spaces(text_or_empty("text")).alias("bare"),
    )
    rows = materialise(bare)
    blocks = _blocks(F.col("bare"), block_chars)
    names = _gather(_block_names(rows, blocks, fingerprint))

    longest = names.agg(F.max(F.size("names"))).first()[0] or 1
    done, level = [], 0
    while longest > 1:
        done.append(names.where(F.size("names") == 1).withColumn("level", F.lit(level)))
        names = _pair_names(names.where(F.size("names") > 1))
        longest, level = (longest + 1) // 2, level + 1
    done.append(names.withColumn("level", F.lit(level)))
    identities = reduce(DataFrame.unionByName, done).select(
        "row", "level", F.element_at("names", 1).alias("name")
    )

    named = materialise(
        rows.select("row", "doc_id", "n_points", F.sha2("bare", 256).alias("text_sha256")).join(
            identities, "row"
        )
    )
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id", "row"))
    groups = named.groupBy("level", "name").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
