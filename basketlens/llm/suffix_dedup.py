"""Repeated byte strings by distributed prefix doubling (operator 11).

A position stands for the string of ``length`` bytes that begins there. Positions get ranks
of growing prefixes: Spark sorts them by the pair (rank of the first h bytes, rank of the h
bytes that follow), a task streams through its sorted rows and gives every distinct pair a
new rank, and a pair that stands alone leaves with all strings that contain it. Doubling ends
at ``length``; of each rank left then, all positions but the first are repeats.

Two exact steps keep most positions out of the doubling:

* Each string is known by its *anchor*, the seed of ``0.64 * length`` bytes inside it that
  hashes lowest; equal strings have equal anchors at equal offsets. Consecutive strings with
  one anchor form a *run*. Strings of a seed that occurs in one run alone are not repeated.
* Runs with equal seeds and equal bytes altogether are copies: what is in all but the first
  of them is repeated. Only where a seed occurs in runs that differ, the first run of each
  kind goes on to the doubling, position by position.

Seeds, runs and the first prefixes are named by 64-bit fingerprints of their bytes, all later
ones by rank. The tasks that stream sorted rows hold a few rows of the batch before, however
large a group is; before the shuffle, copies of a run inside one batch are taken out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import broadcast_if_small, materialise, text_or_empty
from basketlens.llm.wordhash import BASE, INVERSE, U, batches, mix, powers, text_bytes

LENGTH = 100
SLICE_BYTES = 1 << 17
#: Positions of a slice and the margin of its last strings fit into so many bits.
PLACE_BITS = U(18)
PLACES = (U(1) << PLACE_BITS) - U(1)
LAST_ID = (1 << 63) - 1

CLEANS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
KEY = "id long, tie long, at int"

BYTE_NAMES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BASE_POWERS, INVERSE_POWERS = (powers(base, 1 << int(PLACE_BITS)) for base in (BASE, INVERSE))
ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


@contextmanager
def shuffles_cleaned(spark: SparkSession):
    """Shuffle files of a query are deleted when it ends; here each one writes its result."""
    before = spark.conf.get(CLEANS, None)
    spark.conf.set(CLEANS, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANS) if before is None else spark.conf.set(CLEANS, before)


class Names:
    """Fingerprints of any strings inside one slice of bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(BYTE_NAMES[data] * BASE_POWERS[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * INVERSE_POWERS[starts])

    def all(self, size: int) -> np.ndarray:
        """Those of all strings of ``size`` bytes."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size : size + n] - self.sums[:n]) * INVERSE_POWERS[:n])


def lowest(values: np.ndarray, window: int) -> np.ndarray:
    """The least value of every ``window`` consecutive ones."""
    span = 1
    while span * 2 <= window:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = window - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def seed_size(length: int) -> int:
    return max(1, length * 16 // 25)


def _slice_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Start, last string, seed and fingerprint of the runs of a slice; texts end at ``ends``."""
    k, n = seed_size(length), len(data) - length + 1
    names = Names(data)
    seeds = names.all(k)
    # The place in the low bits makes the first of equal seeds the lowest.
    anchors = (lowest((seeds & ~PLACES) | np.arange(len(seeds), dtype=U), length - k + 1) & PLACES).astype(np.int64)
    crossing = np.zeros(n + length + 1, dtype=np.int32)
    np.add.at(crossing, np.maximum(ends - length + 1, 0), 1)
    np.add.at(crossing, np.minimum(ends, n + length), -1)
    inside = np.cumsum(crossing[:n]) == 0
    first, last = inside.copy(), inside.copy()
    turn = anchors[1:] != anchors[:-1]
    first[1:] &= turn | ~inside[:-1]
    last[:-1] &= turn | ~inside[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    place = anchors[start]
    shape = mix(((place - start) * length + stop - start).astype(U))
    return start, stop, seeds[place], mix(names.of(start, stop + length) + shape)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def _batch(ddl: str, columns) -> pa.RecordBatch:
    fields = [field.split() for field in ddl.split(", ")]
    arrays = [pa.array(c, ARROW[kind]) for (_, kind), c in zip(fields, columns, strict=True)]
    return pa.record_batch(arrays, names=[name for name, _ in fields])


RUNS = f"seed long, run long, {KEY}, n int, repeat boolean"


def _runs(length: int) -> Callable:
    """Runs of every text; ``repeat`` marks copies of an earlier run of the same batch."""

    def of_batch(batch: pa.RecordBatch) -> list[np.ndarray]:
        data, offsets = text_bytes(batch.column("text"))
        parts = []
        for at in range(0, len(data), SLICE_BYTES):
            stop = min(len(data), at + SLICE_BYTES + length - 1)
            if stop - at < length:
                break
            ends = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "right")] - at
            start, end, seed, run = _slice_runs(data[at:stop], ends, length)
            parts.append((start + at, end - start + 1, seed, run))
        if not parts:
            return []
        start, n, seed, run = (np.concatenate(x) for x in zip(*parts))
        text = np.searchsorted(offsets, start, "right") - 1
        id_, tie = (c[text] for c in _columns(batch, "id", "tie"))
        place, repeat = start - offsets[text], np.zeros(len(start), dtype=bool)
        order = np.argsort(run, kind="stable")
        twin = np.zeros(len(order) + 1, dtype=bool)
        twin[1:-1] = run[order[1:]] == run[order[:-1]]
        copies = order[twin[1:] | twin[:-1]]
        if len(copies):
            copies = copies[np.lexsort([x[copies] for x in (place, tie, id_, run)])]
            repeat[copies[1:]] = run[copies[1:]] == run[copies[:-1]]
            # Repeats only pass by, so their seed merely spreads them.
            seed[repeat] = mix(id_[repeat].astype(U) * U(1 << 20) + place[repeat].astype(U))
        return [seed.view(np.int64), run.view(np.int64), id_, tie, place, n, repeat]

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for whole in source:
                for batch in batches(whole):
                    if columns := of_batch(batch):
                        yield _batch(RUNS, columns)

    return find


SETTLED = f"{KEY}, n int, open boolean"


def _settle(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by seed, run and place: repeats, and the first runs of open seeds.

    Of a seed's first run it is unknown whether others differ until one does, so it waits.
    """
    seed_before, run_before, waiting = None, None, None
    for batch in source:
        seed, run, *place, repeat = _columns(batch, "seed", "run", "id", "tie", "at", "n", "repeat")
        found = [[x[repeat] for x in place]]
        keep = ~repeat
        seed, run, place = seed[keep], run[keep], [x[keep] for x in place]
        if len(seed):
            same_seed, same_run = np.zeros(len(seed), dtype=bool), np.zeros(len(seed), dtype=bool)
            same_seed[1:], same_run[1:] = seed[1:] == seed[:-1], run[1:] == run[:-1]
            same_seed[0], same_run[0] = seed[0] == seed_before, run[0] == run_before
            same_run &= same_seed
            found.append([x[same_run] for x in place])
            other = same_seed & ~same_run
            group = np.cumsum(~same_seed)
            differs = np.zeros(group[-1] + 1, dtype=bool)
            differs[group[other]] = True
            opened = other | (~same_seed & differs[group])
            opens = [[x[opened] for x in place]]
            if waiting is not None and (differs[0] or group[-1] > 0):
                if differs[0]:
                    opens.append(waiting)
                waiting = None
            if not differs[-1] and not same_seed.all():
                first = np.flatnonzero(~same_seed)[-1]
                waiting = [x[first : first + 1] for x in place]
            seed_before, run_before = seed[-1], run[-1]
        else:
            opens = []
        for rows, is_open in ((found, False), (opens, True)):
            columns = [np.concatenate(x) for x in zip(*rows)] if rows else []
            if columns and len(columns[0]):
                yield _batch(SETTLED, [*columns, np.full(len(columns[0]), is_open)])


def prefixes(length: int) -> tuple[int, list[int], list[int]]:
    """The first prefix's half, the offsets of the later rounds, and where strings need ranks."""
    half = max(1, length // 4)
    size, steps = 2 * half, []
    while size < length:
        steps.append(min(size, length - size))
        size += steps[-1]
    needed = [0]
    for step in reversed(steps):
        needed = sorted({o + more for o in needed for more in (0, step)})
    return half, steps, needed


def _flat(runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places and sizes of all lists of (at, n), and where each list begins; null is empty."""
    sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
    flat = runs.flatten()
    at, n = (flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("at", "n"))
    return at, n, np.append(0, np.cumsum(sizes))


PAIRS = f"left long, right long, {KEY}, own boolean"


def _first_pairs(length: int) -> Callable:
    """(fingerprint of h bytes, that of the next h) for open positions and those they lean on."""
    half, _, needed = prefixes(length)

    def of_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = text_bytes(batch.column("text"))
        id_, tie = _columns(batch, "id", "tie")
        start, n, borders = _flat(batch.column("runs"))
        start = start + np.repeat(offsets[:-1], np.diff(borders))
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = np.unique(np.repeat(start, n) + within)
        places = np.unique(np.concatenate([own + more for more in needed]))
        is_own = np.zeros(len(places), dtype=bool)
        is_own[np.searchsorted(places, own)] = True
        for at in range(0, len(data), SLICE_BYTES):
            lo, hi = np.searchsorted(places, (at, at + SLICE_BYTES))
            if lo == hi:
                continue
            here, names = places[lo:hi] - at, Names(data[at : at + SLICE_BYTES + 2 * half])
            text = np.searchsorted(offsets, places[lo:hi], "right") - 1
            pair = (names.of(here + shift, here + shift + half).view(np.int64) for shift in (0, half))
            yield _batch(PAIRS, [*pair, id_[text], tie[text], places[lo:hi] - offsets[text], is_own[lo:hi]])

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for whole in source:
                for batch in batches(whole):
                    yield from of_batch(batch)

    return find


RANKED = f"{KEY}, own boolean, rank long"


def _rerank(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From positions sorted by pair: one rank per pair; a pair that stands alone is left out."""
    rank, held, held_new = TaskContext.get().partitionId() << 40, None, True
    for batch in source:
        columns = _columns(batch, "left", "right", "id", "tie", "at", "own")
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns)]
        left, right = columns[:2]
        new = np.ones(len(left), dtype=bool)
        new[0], new[1:] = held_new, (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        ranks = rank + np.cumsum(new)
        shared = ~(new[:-1] & new[1:])
        if shared.any():
            yield _batch(RANKED, [*(x[:-1][shared] for x in columns[2:]), ranks[:-1][shared]])
        # Of the last row it is not known whether another follows it; its number is given anew.
        held, held_new = [x[-1:] for x in columns], bool(new[-1])
        rank = int(ranks[-1]) - held_new
    if held is not None and not held_new:
        yield _batch(RANKED, [*held[2:], np.array([rank])])


def _pairs(step: int, last: bool) -> Callable:
    """From ranked positions sorted by text and place: each with the rank ``step`` bytes on."""

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            columns = _columns(batch, "id", "tie", "at", "own", "rank")
            if not len(columns[0]):
                continue
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            id_, tie, at, own, rank = columns
            text = np.zeros(len(at), dtype=np.int64)
            text[1:] = np.cumsum((id_[1:] != id_[:-1]) | (tie[1:] != tie[:-1]))
            key = (text << 32) + at
            partner = np.minimum(np.searchsorted(key, key + step), len(key) - 1)
            met = key[partner] == key + step
            waits = (text == text[-1]) & (at + step > at[-1])
            if last:
                met &= own
            if met.any():
                yield _batch(PAIRS, [rank[met], rank[partner[met]], id_[met], tie[met], at[met], own[met]])
            held = [x[waits] for x in columns]

    return find


def _later(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From positions sorted by pair and place: all but the first of each pair."""
    before = None
    for batch in source:
        left, right, *place = _columns(batch, "left", "right", "id", "tie", "at")
        if not len(left):
            continue
        same = np.zeros(len(left), dtype=bool)
        same[1:] = (left[1:] == left[:-1]) & (right[1:] == right[:-1])
        same[0] = before == (left[0], right[0])
        before = (left[-1], right[-1])
        if same.any():
            yield _batch(SETTLED, [*(x[same] for x in place), np.ones(same.sum(), np.int32), np.zeros(same.sum(), bool)])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and (id, tie), which tell different documents apart and order them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID)))
    shared = materialise(rows.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("shared")))
    if shared.isEmpty():
        return rows.withColumn("tie", F.lit(0).cast("long"))
    tie = F.when(F.col("shared"), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0)).cast("long")
    return rows.join(broadcast_if_small(shared), "id", "left").withColumn("tie", tie).drop("shared")


def _once(keyed: DataFrame) -> DataFrame:
    """One row per (id, tie); only rows that share their id are compared."""
    texts = keyed.select("id", "tie", "text")
    return texts.where("tie = 0").unionByName(texts.where("tie <> 0").dropDuplicates(["id", "tie"]))


def _of_texts(found: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """Texts with the list of (at, n) found in each; no longer than the text."""
    lists = found.groupBy("id", "tie").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    return texts.join(lists, ["id", "tie"], how)


def repeated_strings(texts: DataFrame, length: int = LENGTH) -> list[DataFrame]:
    """Stored tables of (id, tie, at, n): ``n`` positions from ``at`` whose strings start earlier.

    ``texts`` has id, tie and text, one row per different (id, tie), in whose order "earlier" is meant.
    """
    half, steps, _ = prefixes(length)
    runs = texts.select("id", "tie", "text").mapInArrow(_runs(length), RUNS)
    settled = materialise(
        runs.repartition("seed").sortWithinPartitions("seed", "run", "id", "tie", "at").mapInArrow(_settle, SETTLED)
    )
    is_open = _of_texts(settled.where("open"), texts, "inner").select("id", "tie", "text", "runs")
    pairs, found = is_open.mapInArrow(_first_pairs(length), PAIRS), [settled.where("NOT open").drop("open")]
    for i, step in enumerate(steps):
        ranked = pairs.repartition("left", "right").sortWithinPartitions("left", "right").mapInArrow(_rerank, RANKED)
        sorted_ = materialise(ranked).repartition("id", "tie").sortWithinPartitions("id", "tie", "at")
        pairs = sorted_.mapInArrow(_pairs(step, last=i == len(steps) - 1), PAIRS)
    order = ("left", "right", "id", "tie", "at")
    later = pairs.where("own").repartition("left", "right").sortWithinPartitions(*order).mapInArrow(_later, SETTLED)
    return [*found, materialise(later.drop("open"))]


KEPT = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"


def _remove(length: int) -> Callable:
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def cover(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[list[dict], bytes]:
        if not len(at):
            return [], data.tobytes()
        order = np.argsort(at)
        at, stop = at[order], np.maximum.accumulate((at + n)[order]) + length - 1
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] > stop[:-1]
        starts, stops = at[first].tolist(), stop[np.append(first[1:], True)].tolist()
        kept = b"".join(data[a:b].tobytes() for a, b in zip([0, *stops], [*starts, len(data)]))
        return [{"start": a, "stop": b} for a, b in zip(starts, stops)], kept

    def remove(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for batch in batches(whole):
                data, offsets = text_bytes(batch.column("text"))
                at, n, borders = _flat(batch.column("runs"))
                out = [
                    cover(data[offsets[i] : offsets[i + 1]], at[borders[i] : borders[i + 1]], n[borders[i] : borders[i + 1]])
                    for i in range(batch.num_rows)
                ]
                found = [pa.array([o[0] for o in out], span), pa.array([o[1] for o in out], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), *found], schema=schema)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start, stop of removed bytes), kept (bytes).

    Removed is each byte that a string of ``length`` bytes covers which also starts earlier: in
    a document of a smaller doc_id, or before in the same one. Strings do not cross documents and
    may cut a character. Null counts as empty; such texts and those shorter than ``length`` keep all.

    A null doc_id is the largest. Rows of one doc_id with different texts are different documents,
    in the order of a hash of their texts; exactly repeated rows are one document and get the same
    result. Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    if length < 4:
        raise ValueError("length must be 4 or more")
    with shuffles_cleaned(docs.sparkSession):
        keyed = _keyed(docs)
        found = repeated_strings(_once(keyed), length)
    repeats = found[0].unionByName(found[1])
    return _of_texts(repeats, keyed, "left").select("doc_id", "text", "runs").mapInArrow(_remove(length), KEPT)
