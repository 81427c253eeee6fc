"""MinHash near-dedup with HyperMinHash sketches (operator 9).

A document is the set of its distinct shingles of ``k`` words. One 64-bit hash of every
shingle names a bucket by its upper bits; of the smallest hash in a bucket the sketch
keeps the number of leading zeros and ten mantissa bits. Empty buckets borrow from
random full ones for banding. Documents that agree in all registers of a band are
candidates; the Jaccard similarity estimated from the registers, corrected for chance
collisions, rules out those that are clearly too far apart, and the rest are compared by
their full sets.

Sets that are equal are one class. No step lists all pairs of a bucket:

1. Every class is compared with its bucket's hub, the member that shares most buckets with
   others; copies of a common original thus meet the original.
2. Two members x, y of a bucket that the hub c does not link can only be similar if they
   share enough of what sets them apart from c. With R the symmetric difference to c,
   similarity 0.8 needs |R_x & R_y| >= (|R_x| + |R_y| - (|x| + |y|) / 9) / 2, which is
   above zero if x is not linked with c. So such pairs meet in a join on the rarest
   elements of R, as many as that bound asks for, in which no pair is lost.

With 48 bands of 8 registers a pair of similarity 0.8 shares a band with probability
0.9998, one of 0.9 practically always.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import broadcast_if_small, materialise
from basketlens.llm.components import connected_components
from basketlens.llm.wordhash import U, batches, mix, runs, words

SIMILARITY = 80
BUCKET_BITS, MANTISSA_BITS = 9, 10
BANDS, BAND_ROWS = 48, 8
#: Registers kept for the estimate; the first of the sketch.
KEPT = 128
EMPTY = np.uint16(0xFFFF)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than ``k`` words are one shingle."""
    hashes, _, _, first, _ = words(column)
    shingles = runs(hashes, k)
    for start, stop in zip(first[:-1], first[1:]):
        if stop - start >= k:
            yield np.unique(shingles[start : stop - k + 1])
        elif stop > start:
            yield mix(runs(hashes[start:stop], int(stop - start)) + U(stop - start))
        else:
            yield hashes[:0]


def registers(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets are full, and their registers."""
    value_bits = 64 - BUCKET_BITS
    bucket = (shingles >> U(value_bits)).astype(np.int64)
    smallest = np.flatnonzero(np.diff(bucket, prepend=-1))
    value = (shingles[smallest] & U((1 << value_bits) - 1)) | U(1)
    top = np.frexp(value.astype(np.float64))[1].astype(np.int64) - 1
    mantissa = np.where(
        top >= MANTISSA_BITS,
        value >> np.maximum(top - MANTISSA_BITS, 0).astype(U),
        value << np.maximum(MANTISSA_BITS - top, 0).astype(U),
    ) & U((1 << MANTISSA_BITS) - 1)
    zeros = (value_bits - 1 - np.minimum(top, value_bits - 1)).astype(np.uint16)
    return bucket[smallest], (zeros << np.uint16(MANTISSA_BITS)) | mantissa.astype(np.uint16)


def _probes() -> np.ndarray:
    """For each register of the bands, the buckets it asks in turn, its own first."""
    n, rows = 1 << BUCKET_BITS, BANDS * BAND_ROWS
    with np.errstate(over="ignore"):
        order = np.argsort(mix(np.arange(1, rows * n + 1, dtype=U)).reshape(rows, n), axis=1)
    own = np.arange(rows)
    place = np.argmax(order == own[:, None], axis=1)
    order[own, place] = order[:, 0]
    order[:, 0] = own
    return order.astype(np.int16)


PROBES = _probes()


def band_keys(buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The key of each band; an empty bucket takes the register of a random full one.

    Each register asks the buckets in an order of its own, which is the same for all
    documents. Neighbours thus borrow from different buckets, and a band of a short text
    rests on as many shingles as one of a long text.
    """
    full = np.zeros(1 << BUCKET_BITS, dtype=bool)
    full[buckets] = True
    every = np.zeros(1 << BUCKET_BITS, dtype=np.uint16)
    every[buckets] = values
    source, open_, start, width = PROBES[:, 0].astype(np.int64), np.flatnonzero(~full[: BANDS * BAND_ROWS]), 1, 16
    while len(open_):
        asked = PROBES[open_, start : start + width]
        answers = full[asked]
        first = answers.argmax(axis=1)
        found = answers[np.arange(len(open_)), first]
        source[open_[found]] = asked[found, first[found]]
        open_, start, width = open_[~found], start + width, width * 4
    rows = every[source].reshape(BANDS, BAND_ROWS).view(U).reshape(BANDS, -1)
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15)
        for column in rows.T:
            key = mix(key ^ column)
    return key.view(np.int64)


def _sketches(k: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("kept", pa.binary()), ("bands", pa.list_(pa.int64()))]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch in batches(part):
                n, digest, kept, bands = [], [], [], []
                for shingles in shingle_sets(batch.column("text"), k):
                    n.append(len(shingles))
                    digest.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                    sketch = np.full(KEPT, EMPTY)
                    if len(shingles):
                        buckets, values = registers(shingles)
                        inside = buckets < KEPT
                        sketch[buckets[inside]] = values[inside]
                        bands.append(band_keys(buckets, values))
                    else:
                        bands.append([])
                    kept.append(sketch.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest), pa.array(kept), pa.array(bands, pa.list_(pa.int64()))],
                    schema=schema,
                )

    return run


def _sets(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch in batches(part):
                sets = [s.tobytes() for s in shingle_sets(batch.column("text"), k)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return run


def estimated_similarity(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of sketch pairs, one per row, and the registers each rests on.

    Two different smallest values agree by chance if they have the same leading zeros and
    mantissa. Per number of zeros that chance follows from how full the buckets are, and
    the mantissa matches once in 2 ** MANTISSA_BITS.
    """
    full_a, full_b = a != EMPTY, b != EMPTY
    used = (full_a | full_b).sum(axis=1)
    equal = ((a == b) & full_a).sum(axis=1) / np.maximum(used, 1)
    level = np.arange(24)

    def by_level(full: np.ndarray) -> np.ndarray:
        share = np.minimum(full.mean(axis=1), 1 - 1e-3)[:, None]
        load = -np.log1p(-share)
        return np.exp(-load * 2.0 ** -(level + 1)) - np.exp(-load * 2.0**-level)

    chance = (by_level(full_a) * by_level(full_b)).sum(axis=1) / (1 << MANTISSA_BITS)
    return (equal - chance) / (1 - chance), used


def _stack(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def _plausible(similarity: int):
    """Leaves out pairs whose estimate is five standard deviations below the threshold."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = similarity / 100
        for batch in parts:
            if batch.num_rows == 0:
                continue
            a, b = (_stack(batch.column(name), np.uint16, KEPT) for name in ("kept_a", "kept_b"))
            found, used = estimated_similarity(a, b)
            slack = 5 * np.sqrt(wanted * (1 - wanted) / np.maximum(used, 1))
            keep = pa.array(found >= wanted - slack)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _against_hub(similarity: int):
    """For each pair (a, b): the sizes, whether it is a link, and what sets b apart from a."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            n_a, n_b, linked, apart = [], [], [], []
            for one, two in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=U) for v in (one, two))
                differ = np.setxor1d(x, y, assume_unique=True)
                common = (len(x) + len(y) - len(differ)) // 2
                n_a.append(len(x))
                n_b.append(len(y))
                linked.append(100 * common >= similarity * (len(x) + len(y) - common))
                apart.append(differ.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["a", "b"]).columns,
                    pa.array(n_a, pa.int64()),
                    pa.array(n_b, pa.int64()),
                    pa.array(linked, pa.bool_()),
                    pa.array(apart, pa.list_(pa.int64())),
                ],
                names=["a", "b", "n_a", "n_b", "linked", "apart"],
            )

    return run


def _pairs_with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("shingles").alias(f"set_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")


def _hub_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): every class b that shares a band with others, and the hub a of that bucket."""
    bands = classes.select("id", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialise(bands.join(sizes, "key"), "snappy")
    met = shared.groupBy("id").agg(F.sum("size").alias("met"))
    ranked = shared.select("key", "id").join(met, "id")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("least"))).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.least")).alias("a"))
    return shared.join(hubs, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def _pairs_apart(compared: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of one hub, not both linked with it, that may still be similar."""
    unlinked = compared.where("NOT linked")
    open_ = compared.join(unlinked.select("a").distinct(), "a", "left_semi").withColumn("r", F.size("apart"))
    # Half the overlap that the bound asks for, with the least the partner can have.
    slack = (100 - similarity) / (100 + similarity)
    n_a, n_b, r = F.col("n_a"), F.col("n_b"), F.col("r")
    with_unlinked = (r + (n_a - n_b) * slack) / 2
    as_unlinked = (r - (n_a + n_b) * slack) / 2
    needed = F.when(F.col("linked"), with_unlinked).otherwise(F.least(with_unlinked, as_unlinked))
    reach = r - F.greatest(F.ceil(needed - 1e-6), F.lit(1)) + 1
    elements = materialise(
        open_.select("a", "b", "linked", r.alias("r"), n_b.alias("n"), reach.alias("reach"), F.explode("apart").alias("element")), "snappy"
    )
    known = elements.groupBy("a", "element").agg(F.count(F.lit(1)).alias("known")).where("known > 1")
    # Elements that one member alone has match nothing, but they fill its first places.
    rarest = Window.partitionBy("a", "b").orderBy("known", "element")
    alone = elements.join(known, ["a", "element"], "left").withColumn("known", F.coalesce("known", F.lit(1)))
    first = materialise(alone.withColumn("place", F.row_number().over(rarest)).where("place <= reach AND known > 1").drop("reach", "known"))

    def side(name: str) -> DataFrame:
        return first.select("a", "element", *(F.col(c).alias(f"{c}_{name}") for c in ("b", "linked", "r", "n", "place")))

    # The same bound with the sizes of both, which are known here.
    overlap = (F.col("r_x") + F.col("r_y") - (F.col("n_x") + F.col("n_y")) * slack) / 2 - 1e-6
    both = (
        (F.col("place_x") <= F.col("r_x") - overlap + 1)
        & (F.col("place_y") <= F.col("r_y") - overlap + 1)
        & (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * similarity)
        & ((F.col("linked_y") & (F.col("b_x") != F.col("b_y"))) | (~F.col("linked_y") & (F.col("b_x") < F.col("b_y"))))
    )
    x, y = side("x").where("NOT linked_x").alias("x"), side("y").alias("y")
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.element") == F.col("y.element"))
    return (
        x.join(y, same & both)
        .select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b"))
        .distinct()
    )


def _links(classes: DataFrame, docs: DataFrame, k: int, similarity: int) -> DataFrame:
    """The links (a, b) between classes, as many as connect them."""
    pairs = materialise(_hub_pairs(classes))
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = docs.select("doc_id", "text").join(broadcast_if_small(ids), "doc_id", "left_semi")
    sets = materialise(texts.mapInArrow(_sets(k), "id long, shingles binary").dropDuplicates(["id"]), "snappy")
    compared = materialise(
        _pairs_with_sets(pairs, sets).mapInArrow(
            _against_hub(similarity), "a long, b long, n_a long, n_b long, linked boolean, apart array<long>"
        ),
        "snappy",
    )

    def sketch(name: str) -> DataFrame:
        return classes.select(F.col("id").alias(name), F.col("kept").alias(f"kept_{name}"), F.col("n").alias(f"n_{name}"))

    close = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    apart = materialise(_pairs_apart(compared, similarity))
    likely = (
        apart.join(sketch("a"), "a").join(sketch("b"), "b").where(close).select("a", "b", "kept_a", "kept_b").mapInArrow(_plausible(similarity), "a long, b long")
    )
    more = _pairs_with_sets(materialise(likely), sets).mapInArrow(
        _against_hub(similarity), "a long, b long, n_a long, n_b long, linked boolean, apart array<long>"
    )
    return compared.unionByName(more).where("linked").select("a", "b")


def with_nodes(docs: DataFrame, null_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows with ``node``, which tells different texts of one doc_id apart, and those ids.

    The node of a row is its doc_id where no other row has it. Rows that share an id, and with
    ``null_ids`` those without one, get a negative number of id and text; equal ones the same.
    The second table has (node, doc_id) of the rows with such numbers. Ids are counted from
    the ids alone, and the texts are only looked at where ids repeat.
    """
    id_ = F.col("doc_id").cast("long")
    counted = docs.groupBy(id_.alias("shared_id")).agg(F.count(F.lit(1)).alias("rows"))
    wanted = (F.col("shared_id").isNotNull() & (F.col("rows") > 1)) | (F.col("shared_id").isNull() & F.lit(null_ids))
    shared = materialise(counted.where(wanted).select("shared_id"))
    own = id_ if shared.isEmpty() else F.when(F.col("is_shared"), _text_node()).otherwise(id_)
    rows = docs
    if not shared.isEmpty():
        marked = broadcast_if_small(materialise(shared.withColumn("is_shared", F.lit(True))))
        rows = docs.join(marked, id_.eqNullSafe(F.col("shared_id")), "left")
    noded = rows.withColumn("node", own)
    again = noded.where("is_shared") if "is_shared" in noded.columns else noded.where(F.lit(False))
    return noded.drop("shared_id", "is_shared"), materialise(again.select("node", id_.alias("doc_id")).distinct())


def _text_node():
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.lit(-2).cast("long") - F.abs(hashed.bitwiseAND((1 << 62) - 1))


def _linked_nodes(nodes: DataFrame, k: int, similarity: int, same: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n) of all rows, and (doc_id, component) of those with shingles.

    ``doc_id`` is a node here, ``component`` the least node that links reach. ``same`` holds
    further links as rows (node, doc_id): nodes with one doc_id belong together.
    """
    sketches = materialise(
        nodes.mapInArrow(_sketches(k), "doc_id long, n long, digest binary, kept binary, bands array<long>"), "snappy"
    )
    some = sketches.where("n > 0 AND doc_id IS NOT NULL")
    first = some.groupBy("digest", "n").agg(F.min("doc_id").alias("id"))
    members = materialise(some.select("doc_id", "n", "digest").join(first, ["digest", "n"]).select("doc_id", "digest", "id"))
    chosen = members.where("doc_id = id").select("doc_id", "digest").distinct()
    classes = materialise(
        some.join(chosen, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "n", "kept", "bands"), "snappy"
    )
    links = _links(classes, nodes, k, similarity)
    if same is not None and not same.isEmpty():
        of_id = same.withColumnRenamed("doc_id", "real").join(members.select(F.col("doc_id").alias("node"), "id"), "node")
        least = of_id.groupBy("real").agg(F.min("id").alias("a"))
        links = links.unionByName(of_id.join(least, "real").where("a <> id").select("a", F.col("id").alias("b")))
    parts = connected_components(links)
    found = members.select("doc_id", "id").distinct().join(parts, "id", "left")
    return sketches.select("doc_id", "n"), found.select("doc_id", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= ``similarity`` * union of their sets
    of distinct ``k``-word shingles. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower
    case. A text of fewer than ``k`` words is one shingle, its whole sequence; a null text
    and one without words have no shingle and are linked with nothing. ``component_id`` is
    the smallest doc_id that links reach, and ``kept`` says that it is the row's own.

    Rows of one doc_id are one document, whose texts all link it; they share component_id
    and kept, and n_shingles is each row's own. A row without doc_id is linked with nothing,
    has no component_id and is kept. Other columns are ignored; an empty table gives an
    empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    noded, shared = with_nodes(docs)
    sizes, found = _linked_nodes(noded.select(F.col("node").alias("doc_id"), "text"), k, similarity, shared)
    if not shared.isEmpty():
        found = materialise(_with_ids(found, shared))
        least = found.groupBy("component").agg(F.min("real").alias("least"))
        found = found.join(least, "component").select("doc_id", F.col("least").alias("component"))
        sizes = sizes.join(shared.withColumnsRenamed({"doc_id": "real", "node": "doc_id"}), "doc_id", "left")
    else:
        sizes = sizes.withColumn("real", F.col("doc_id"))
    return (
        sizes.join(found.withColumnRenamed("component", "component_id"), "doc_id", "left")
        .select(F.coalesce("real", "doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _with_ids(found: DataFrame, shared: DataFrame) -> DataFrame:
    """``found`` with the doc_id of each node as ``real``."""
    ids = shared.select(F.col("node").alias("doc_id"), F.col("doc_id").alias("real"), F.lit(True).alias("renamed"))
    joined = found.join(ids, "doc_id", "left")
    real = F.when(F.col("renamed"), F.col("real")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "component", real.alias("real"))


def keep_one_of_each(docs: DataFrame, k: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``.

    Texts are what is grouped: rows of one doc_id with different texts are different
    documents, of exactly repeated rows one stays, and rows without doc_id are grouped as
    others. The smallest doc_id of a group stays, null last. A row without words stays.
    """
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "doc_id", "text")
    noded, shared = with_nodes(rows, null_ids=True)
    nodes = noded.select(F.col("node").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, found = _linked_nodes(nodes, k, similarity, None)
    if shared.isEmpty():
        gone = materialise(found.where("doc_id <> component").select(F.col("doc_id").alias("node")).distinct())
    else:
        found = materialise(_with_ids(found, shared))
        best = found.groupBy("component").agg(F.min(F.struct(F.col("real").isNull(), "real", "doc_id")).alias("best"))
        others = found.join(best, "component").where(F.col("doc_id") != F.col("best.doc_id"))
        gone = materialise(others.select(F.col("doc_id").alias("node")).distinct())
    left = noded.join(gone, "node", "left_anti")
    if not shared.isEmpty():
        again = left.join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
        left = left.join(shared.select("node").distinct(), "node", "left_anti").unionByName(again)
    return left.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
