"""Benchmark decontamination by greedy string tiling (operator 5).

Every run of ``k`` tokens is a seed, known by its rolling hash. Seeds of the documents
are joined with those of the benchmark items. For each document and item that meet, the
longest run of matching tokens that no tile covers yet becomes the next tile, until no run
of ``k`` tokens is left. The share of the item that tiles cover does not depend on their
order in the document, so passages that were cut up and reordered are found.

Runs of ``k`` or more tokens are chains of consecutive seeds, so tiling needs the seeds
alone; texts do not move. Seeds of documents pass a bit table of fixed size first, which
holds the benchmark's seeds and lets only few others through; what passes is joined
exactly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, text_or_empty
from basketlens.llm.wordhash import U, batches, runs, words

MIN_TILE = 5
COVERAGE = 0.5
#: Bits of the table of benchmark seeds: 512 KB, whatever the benchmark's size.
TABLE_BITS = 22

Seed = tuple[list[int], list[int]]


def _seeds(k: int, key: list[str], table: np.ndarray | None):
    """(key, n_tokens, seed, places) of the distinct seeds of each text that pass the table."""
    mask = U((1 << TABLE_BITS) - 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch in batches(part):
                hashes, _, _, first, _ = words(batch.column("text"))
                seeds = runs(hashes, k)
                text = np.searchsorted(first, np.arange(len(seeds)), "right") - 1
                place = np.arange(len(seeds)) - first[text]
                # A text's last k - 1 positions begin runs that leave it.
                passed = place <= np.diff(first)[text] - k if len(seeds) else np.zeros(0, bool)
                if table is not None and len(seeds):
                    slot = (seeds & mask).astype(np.int64)
                    passed &= (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                seeds, text, place = seeds[passed], text[passed], place[passed]
                order = np.lexsort((place, seeds, text))
                seeds, text, place = seeds[order], text[order], place[order]
                new = np.flatnonzero(np.r_[True, (seeds[1:] != seeds[:-1]) | (text[1:] != text[:-1])]) if len(seeds) else order
                places = pa.ListArray.from_arrays(
                    pa.array(np.r_[new, len(seeds)] if len(seeds) else [0], pa.int32()), pa.array(place, pa.int32())
                )
                owner = pa.array(text[new])
                columns = [batch.column(name).take(owner) for name in key]
                columns += [pa.array(np.diff(first)[text[new]], pa.int64()), pa.array(seeds[new].view(np.int64)), places]
                yield pa.RecordBatch.from_arrays(columns, names=[*key, "n_tokens", "seed", "places"])

    return run


def greedy_tiles(seeds: list[Seed], k: int) -> list[int]:
    """Lengths of the tiles, longest first; ties go to the earliest place of the document."""
    at: dict[int, list[int]] = defaultdict(list)
    for in_doc, in_item in seeds:
        for place in in_doc:
            at[place].extend(in_item)
    tiles: list[int] = []
    doc_used: set[int] = set()
    item_used: set[int] = set()
    while True:
        best, last, ending = (0, 0, 0), -2, {}
        for place in sorted(at):
            before, ending = ending if place == last + 1 else {}, {}
            last = place
            if place in doc_used or place + k - 1 in doc_used:
                continue
            for other in at[place]:
                if other in item_used or other + k - 1 in item_used:
                    continue
                length = before.get(other - 1, 0) + 1
                ending[other] = length
                if length > best[0]:
                    best = (length, place, other)
        length, place, other = best
        if not length:
            return tiles
        size = length + k - 1
        # Tiles are k tokens or longer, so a run is free if its first and last token are.
        doc_used.update(range(place - length + 1, place + k))
        item_used.update(range(other - length + 1, other + k))
        tiles.append(size)


def _tiled(k: int, coverage: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows, n_tiles, matched = [], [], []
            for i in range(batch.num_rows):
                n = batch.column("n_tokens")[i].as_py()
                seeds = [(s["places"], s["item_places"]) for s in batch.column("seeds")[i].as_py()]
                reach = {j + x for _, places in seeds for j in places for x in range(k)}
                if len(reach) < coverage * n:
                    continue
                tiles = greedy_tiles(seeds, k)
                if sum(tiles) >= coverage * n:
                    rows.append(i)
                    n_tiles.append(len(tiles))
                    matched.append(sum(tiles))
            kept = batch.select(["doc_id", "text_hash", "item_id", "n_tokens"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(n_tiles, pa.int64()), pa.array(matched, pa.int64())], names=[*kept.schema.names, "n_tiles", "matched"])

    return run


def _bit_table(items: DataFrame) -> np.ndarray:
    """At most 2 ** TABLE_BITS slots come to the driver, however large the benchmark is."""
    slots = items.select((F.col("seed").bitwiseAND((1 << TABLE_BITS) - 1)).cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy()
    table = np.zeros(1 << TABLE_BITS - 3, dtype=np.uint8)
    np.bitwise_or.at(table, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))
    return table


def contaminated_rows(
    docs: DataFrame, benchmark: DataFrame, k: int = MIN_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """One row per document row and item found in it, with the hash of the row's text.

    Columns: doc_id, text_hash, item_id, item_tokens, n_tiles, matched_tokens, coverage.
    """
    items = materialise(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty("text").alias("text"))
        .withColumn("item_hash", F.xxhash64("text"))
        .mapInArrow(_seeds(k, ["item_id", "item_hash"], None), "item_id long, item_hash long, n_tokens long, seed long, places array<int>")
        .dropDuplicates(["item_id", "item_hash", "seed"])
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty("text")).alias("text_hash"),
        text_or_empty("text").alias("text"),
    )
    seeds = materialise(
        rows.mapInArrow(
            _seeds(k, ["doc_id", "text_hash"], _bit_table(items)),
            "doc_id long, text_hash long, n_tokens long, seed long, places array<int>",
        ).select("doc_id", "text_hash", "seed", "places")
    )
    met = (
        seeds.join(items.withColumnRenamed("places", "item_places"), "seed")
        .groupBy("doc_id", "text_hash", "item_id", "item_hash", "n_tokens")
        .agg(F.collect_set(F.struct("places", "item_places")).alias("seeds"))
        .select("doc_id", "text_hash", "item_id", "n_tokens", "seeds")
    )
    return (
        met.mapInArrow(_tiled(k, coverage), "doc_id long, text_hash long, item_id long, n_tokens long, n_tiles long, matched long")
        .select(
            "doc_id", "text_hash", "item_id",
            F.col("n_tokens").alias("item_tokens"), "n_tiles", F.col("matched").alias("matched_tokens"),
            (F.col("matched") / F.col("n_tokens")).alias("coverage"),
        )
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, k: int = MIN_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """One row per document and benchmark item found in it.

    Columns: doc_id, item_id, item_tokens, n_tiles, matched_tokens, coverage. Tokens are
    words with A-Z in lower case. An item is found if tiles of at least ``k`` tokens cover
    the share ``coverage`` of its tokens; an item of fewer than ``k`` tokens, null or empty
    is never found. Rows that agree in doc_id and text are one document; items that share
    an id but not the text are tiled apart. Other columns are ignored; empty tables give
    an empty result.
    """
    return contaminated_rows(docs, benchmark, k, coverage).drop("text_hash")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = MIN_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    found = materialise(
        contaminated_rows(docs, benchmark, k, coverage)
        .select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
        .distinct()
    )
    # The row is one struct beside the columns used here, so no name of it can clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text_or_empty("text")).alias("hash"),
    )
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("hash") == F.col("found_hash"))
    clean = rows.join(found, same, "left_anti")
    return clean.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
