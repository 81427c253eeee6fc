"""Merkle manifest of a dataset by nested-struct rollup (operator 13).

Every row is a leaf. The leaves of a tree are ranked; the base-8 digits of a rank say
where a leaf stands in its run, its run in the next, and so on. Blocks of ``fan ** LEVELS``
consecutive leaves are rolled up by grouping away one digit column after the other: each
grouping nests the child structs of a run in order and adds their digest. All groupings of
a block use one shuffle, by tree and block. The digests of the blocks are the leaves of the
next round, until one block is left per tree; the trees' roots are rolled up alike.

Proofs go the other way: a block's nested structs are exploded digit by digit, and every
explosion notes the digests to the left and to the right. Leaves are never joined; one row
per block meets what its round above found for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import broadcast_if_small, lower_ascii, materialise, remainder

FAN = 8
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row; ``text`` stands in for its text."""
    return digest(*(field(text if name == "text" and text is not None else F.col(name)) for name in FIELDS))


def _ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """Add ``rank`` from 0 within ``tree`` and the tree's size ``n``.

    The rows are sorted over all partitions. A rank is the place in its partition plus the
    rows of the tree in earlier partitions, of which there is one number per partition.
    """
    keys = [F.col(name).asc_nulls_first() for name in ("tree", *order)]
    placed = materialise(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", 33).alias("part")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("tree", part)
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("rows").over(Window.partitionBy("tree")))
    )
    starts = broadcast_if_small(materialise(starts.drop("rows")))
    return (
        placed.withColumn("part", part)
        .join(starts, ["tree", "part"])
        .withColumn("rank", F.col("before") + F.col("place") - F.col("first"))
        .drop("part", "place", "first", "before")
    )


def _blocks(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """(tree, n, block, digest, nodes): the nested nodes of every block.

    ``nodes`` has tree, n, rank and digest; what else it has stays in the innermost structs.
    A level above the only node of a tree passes its digest on.
    """
    digits = [f"digit{level}" for level in range(levels)]
    kept = [name for name in nodes.columns if name not in ("tree", "n", "rank")]
    rows = nodes.select(
        "tree",
        "n",
        F.expr(f"rank div {fan**levels}").alias("block"),
        *(F.expr(f"cast(rank div {fan**level} % {fan} as int)").alias(name) for level, name in enumerate(digits)),
        *kept,
    ).repartition("tree", "block")
    for level, name in enumerate(digits):
        run = F.sort_array(F.collect_list(F.struct(F.col(name).alias("digit"), *kept)))
        rows = rows.groupBy("tree", "n", "block", *digits[level + 1 :]).agg(run.alias("nodes"))
        joined = F.sha2(F.array_join("nodes.digest", ""), 256)
        lone = F.col("n") <= fan**level
        rows = rows.withColumn("digest", F.when(lone, F.get("nodes.digest", F.lit(0))).otherwise(joined))
        kept = ["digest", "nodes"]
    return rows


def _opened(blocks: DataFrame, fan: int, levels: int) -> DataFrame:
    """One row per leaf of every block: tree, rank, the leaf's columns, ``proof`` and what is above.

    ``blocks`` carries ``above``, the proof of the block itself, ``subroot`` and ``root``.
    """
    rows = blocks.withColumns({"proof": F.col("above"), "rank": F.col("block")})
    for level in reversed(range(levels)):
        siblings = F.col("nodes.digest")
        others = F.struct(
            F.array_join(F.slice(siblings, F.lit(1), F.col("at")), "").alias("left"),
            F.array_join(F.slice(siblings, F.col("at") + 2, F.lit(fan)), "").alias("right"),
        )
        step = F.when(F.col("n") > fan**level, F.array(others)).otherwise(F.slice(F.array(others), 1, 0))
        rows = rows.select("*", F.posexplode("nodes").alias("at", "node")).withColumns(
            {"proof": F.concat(step, "proof"), "rank": F.col("rank") * fan + F.col("at")}
        )
        if level:
            rows = rows.withColumn("nodes", F.col("node.nodes")).drop("at", "node")
    return rows.select("tree", "rank", "node.*", "proof", "subroot", "root").drop("digit")


def _proofs(nodes: DataFrame, roots, fan: int, levels: int) -> DataFrame:
    """The proofs of ranked nodes; ``roots`` gives each tree's ``above``, subroot and root."""
    size, most = fan**levels, nodes.agg(F.max("n")).first()[0] or 0
    rounds = [materialise(_blocks(nodes, fan, levels))]
    while most > size:
        most = -(-most // size)
        upper = rounds[-1].select("tree", F.col("block").alias("rank"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), "digest")
        rounds.append(materialise(_blocks(upper, fan, levels)))
    opened = rounds[-1].join(roots(rounds[-1].select("tree", "digest")), "tree")
    for below in reversed(rounds[:-1]):
        above = _opened(opened, fan, levels).select(
            "tree", F.col("rank").alias("block"), F.col("proof").alias("above"), "subroot", "root"
        )
        opened = below.join(above, ["tree", "block"])
    return _opened(opened, fan, levels)


def _no_proof() -> Column:
    return F.expr("cast(array() as array<struct<left: string, right: string>>)")


def merkle_proofs(leaves: DataFrame, tree: Column, order: tuple[str, ...], fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Every leaf with its proof: the columns of ``leaves`` and proof, subroot, root.

    ``leaves`` has a column ``digest`` and none of tree, n, rank, proof, subroot, root, digit. The
    leaves of a tree ascend by ``order`` (null first), equal ones by digest. The roots of the
    trees, ascending by ``tree`` (null first), have a tree of their own. ``proof`` has one
    struct per level with the digests to the left and to the right, each concatenated; a
    level whose run is one node alone has two empty strings. No leaves give no rows.
    """
    # An empty string before all names keeps a null apart and first.
    named = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("")))
    columns = leaves.columns

    def whole(tops: DataFrame) -> DataFrame:
        return tops.select("tree", _no_proof().alias("above"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))

    def trees(tops: DataFrame) -> DataFrame:
        subroots = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
        found = _proofs(_ranked(subroots, "name"), whole, fan, levels)
        return found.select(F.col("name").alias("tree"), F.col("proof").alias("above"), F.col("digest").alias("subroot"), "root")

    ranked = _ranked(named, *order, "digest")
    return _proofs(ranked, trees, fan, levels).select(*columns, "proof", "subroot", "root")


def proof_digest(proof: Column) -> Column:
    """All siblings of a proof, level by level, as one digest."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, start, lambda so_far, s: F.sha2(F.concat(s["left"], so_far, s["right"]), 256))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with A-Z in lower case where 3 divides the crc32 of the id, else the text."""
    return F.when(remainder(doc_id, 3) == 0, lower_ascii(text)).otherwise(text)


def dataset_manifest(docs: DataFrame, changed=tampered, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, presented, proof, subroot, root, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text, each ``-`` if null, else
    its byte count, a colon and the value; an empty text is ``0:``. There is one tree per
    lang, null being a lang of its own. ``presented`` is the leaf of the text that
    ``changed(doc_id, text)`` gives, ``folded_root`` what follows from it and the proof.

    Leaves ascend by doc_id, null first; rows of one doc_id ascend by their leaf, and exactly
    repeated rows are leaves of their own with equal digests. Other columns of ``docs`` are
    ignored; an empty table gives an empty result.
    """
    leaves = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("lang").alias("lang"),
            leaf().alias("digest"),
            leaf(changed(F.col("doc_id"), F.col("text"))).alias("presented"),
        )
    )
    proofs = merkle_proofs(leaves, F.col("lang"), ("doc_id",), fan, levels)
    return (
        proofs.withColumnRenamed("digest", "leaf")
        .withColumn("folded_root", fold(F.col("presented"), F.col("proof")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .drop("lang")
    )
