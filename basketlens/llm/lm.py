"""LM scoring with a causal self-attention model on subword ids (operator 10).

Texts become the subword ids of a public tokenizer, word by word. A one-layer causal
self-attention model over the ids gives p(id | ids before) of every id of the vocabulary: a
softmax gives the id's class, and the decisions along its path in the class's Huffman tree,
which read the same context, the id. A word's probability is the product over its ids. The
model's probability of a word mixes that with the word's smoothed share of the corpus.

Counts of words and ids come from all training documents. The model learns in parallel:
each task takes Adam steps on its own windows, and the weights are averaged by Spark after
each round. The windows cover every training document with its end, and the rounds deal
them out among themselves, so each is learnt from once while the driver only sees one set
of weights.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.attention import NODE, TABLES, WINDOW, Adam, Tree, from_rows, new_model, new_tree, score_places, table_gradients, to_rows
from basketlens.llm.common import materialise, remainder, text_or_empty
from basketlens.llm.wordhash import batches, words

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the tokenizer's vocabulary cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
IDS = 50_256
CLASSES = 64
#: Weight of the counts in the mixture with the attention model.
COUNTED = 0.2
ROUNDS, BATCH, RATE = 2, 128, 0.02
#: Counts of so many words at most are broadcast (4 MB); the others are joined.
BROADCAST_WORDS = 1 << 18
LONG_WORD = 256
#: A task keeps the ids of so many distinct words at most (about 30 MB); beyond, it begins anew.
KEPT_WORDS = 1 << 20
END_HASH = np.int64(-0x5DEECE66D)


@lru_cache(maxsize=1)
def _encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines())}
    return tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _opens(encoder) -> np.ndarray:
    """1 for ids that open a word, those that begin with a space, and for the end."""
    return np.array([float(encoder.decode_single_token_bytes(i).startswith(b" ")) for i in range(IDS)] + [1.0])


def _odd_spaces(data: np.ndarray) -> np.ndarray:
    """Bytes at which a space outside ASCII may begin; the pattern does not cut only before it."""
    lead, after = data[:-1], data[1:]
    at = np.flatnonzero((lead == 0xC2) | ((lead >= 0xE1) & (lead <= 0xE3)))
    lead, after = lead[at], after[at]
    return at[
        ((lead == 0xC2) & ((after == 0x85) | (after == 0xA0)))
        | ((lead == 0xE1) & (after == 0x9A))
        | ((lead == 0xE2) & ((after == 0x80) | (after == 0x81)))
        | ((lead == 0xE3) & (after == 0x80))
    ]


class Encoded:
    """The subword ids of the distinct words that a task has met, by hash."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.offset, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def add(self, hashes: np.ndarray, size: np.ndarray, offset: np.ndarray, flat: np.ndarray) -> None:
        """New words in the order of their hashes."""
        at = np.searchsorted(self.hashes, hashes)
        self.offset = np.insert(self.offset, at, offset + len(self.flat))
        self.size = np.insert(self.size, at, size)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.flat = np.concatenate([self.flat, flat])


    def ids(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by their places, one after the other, and how many each word has."""
        counts = self.size[word]
        stops = np.cumsum(counts)
        return self.flat[np.arange(stops[-1] if len(stops) else 0) + np.repeat(self.offset[word] - stops + counts, counts)], counts


def _places(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, encoder, known: Encoded) -> np.ndarray:
    """The place of each word in ``known``; each distinct word that it lacks is encoded, once, and kept there."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    distinct, example = ordered[first], order[first]
    if len(known.hashes) + len(distinct) > KEPT_WORDS:
        known.clear()
    at = np.searchsorted(known.hashes, distinct)
    new = np.flatnonzero(known.hashes[np.minimum(at, len(known.hashes) - 1)] != distinct) if len(known.hashes) else np.arange(len(distinct))
    if len(new):
        known.add(distinct[new], *_encoded(starts[example[new]], ends[example[new]], data, encoder))
        at = np.searchsorted(known.hashes, distinct)
    word = np.empty(len(hashes), np.int64)
    word[order] = np.repeat(at, np.diff(np.r_[np.flatnonzero(first), len(hashes)]))
    return word


def subwords(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, encoder, known: Encoded | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The subword ids of all words, one after the other, and how many each word has."""
    known = known or Encoded()
    return known.ids(_places(hashes, starts, ends, data, encoder, known))


def _encoded(first: np.ndarray, ends: np.ndarray, data: np.ndarray, encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many ids each word has, where they begin, and the ids of all words.

    Words are taken with A-Z in lower case and a space before them. The pattern cuts before
    each space, so words are encoded together and told apart by the ids that open one; those
    with other spaces in them and long ones are encoded alone.
    """
    size = ends - first
    lower = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    odd = _odd_spaces(data)
    alone = (np.searchsorted(odd, first) < np.searchsorted(odd, first + size)) | (size > LONG_WORD)
    plain = np.flatnonzero(~alone)
    joined = np.full(int(size[plain].sum()) + len(plain), 32, dtype=np.uint8)
    before = np.cumsum(size[plain]) - size[plain]
    letter = np.arange(len(joined) - len(plain))
    joined[letter + np.repeat(np.arange(1, len(plain) + 1), size[plain])] = lower[letter + np.repeat(first[plain] - before, size[plain])]
    together = encoder.encode_to_numpy(joined.tobytes().decode("utf-8", "replace"), disallowed_special=()).astype(np.int64)
    encoded = []
    for a, n in zip(first[alone].tolist(), size[alone].tolist()):
        ids: list[int] = []
        for low in range(a, a + n, LONG_WORD):
            piece = lower[low : min(a + n, low + LONG_WORD)].tobytes().decode("utf-8", "replace")
            ids += encoder.encode_ordinary((" " if low == a else "") + piece)
        encoded.append(ids)
    at = np.flatnonzero(_opens(encoder)[together])
    sizes = np.zeros(len(first), dtype=np.int64)
    sizes[plain] = np.diff(np.r_[at, len(together)])
    sizes[alone] = [len(ids) for ids in encoded]
    offset = np.zeros(len(first), dtype=np.int64)
    offset[plain] = at
    offset[alone] = len(together) + np.cumsum(sizes[alone]) - sizes[alone]
    return sizes, offset, np.concatenate([together, *encoded]).astype(np.uint16)


GATHERED = "hashes array<long>, counts array<long>, ids array<long>, id_counts array<long>, windows binary"


def _windows(ids: np.ndarray) -> np.ndarray:
    """All windows of a text and its end, each after the id before its first prediction."""
    n = len(ids) + 1
    out = np.full((-(-n // WINDOW), WINDOW + 1), IDS + 2, dtype=np.uint16)
    own = np.full(len(out) * WINDOW, IDS + 2, dtype=np.uint16)
    own[: n - 1], own[n - 1] = ids, IDS
    out[:, 1:] = own.reshape(-1, WINDOW)
    out[0, 0], out[1:, 0] = IDS + 1, out[:-1, -1]
    return out


def _gather(vocabulary):
    """Per batch of training texts: counts of words and ids, and the windows to learn from."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, met = _encoder(vocabulary.value), Encoded()
        for part in parts:
            for batch in batches(part):
                n = batch.num_rows
                hashes, starts, ends, first, data = words(batch.column("text"))
                ids, sizes = subwords(hashes, starts, ends, data, encoder, met)
                start = np.r_[0, np.cumsum(sizes)][first]
                known, counts = np.unique(hashes, return_counts=True)
                tokens = np.bincount(ids, minlength=IDS)
                used = np.flatnonzero(tokens)
                windows = np.concatenate([_windows(ids[a:b]) for a, b in zip(start[:-1], start[1:])])
                columns = (np.r_[known.view(np.int64), END_HASH], np.r_[counts, n], np.r_[used, IDS], np.r_[tokens[used], n])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([c], pa.list_(pa.int64())) for c in columns), pa.array([windows.tobytes()], pa.binary())],
                    names=["hashes", "counts", "ids", "id_counts", "windows"],
                )

    return run


def _summed(gathered: DataFrame, key: str, count: str) -> DataFrame:
    pairs = gathered.select(F.explode(F.arrays_zip(F.col(key).alias("key"), F.col(count).alias("n"))).alias("pair"))
    return pairs.groupBy(F.col("pair.key").alias("hash")).agg(F.sum("pair.n").alias("count"))


def _classes(counts: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Class of every id and of the end, of at most CLASSES.

    The end is a class of its own. The ids that open words and the others fill theirs by
    falling frequency, with about equal mass, so that frequent ids have their own.
    """
    weight = counts + 0.5
    kind = np.full(IDS + 1, -1, dtype=np.int64)
    groups = [np.flatnonzero(opens[:IDS] == side) for side in (1, 0)]
    shares = [weight[ids].sum() / weight[:IDS].sum() for ids in groups]
    used = 0
    for ids, share in zip(groups, shares):
        ids = ids[np.lexsort((ids, -counts[ids]))]
        slots = min(max(1, round((CLASSES - 1) * share)), CLASSES - 2)
        mass = np.cumsum(weight[ids])
        at = np.minimum((mass - weight[ids]) / mass[-1] * slots, slots - 1).astype(np.int64)
        kind[ids] = used + np.unique(at, return_inverse=True)[1]
        used = kind.max() + 1
    kind[IDS] = used
    return kind


def _learnt(windows: DataFrame, tree: Tree, counts: np.ndarray, rounds: int) -> dict[str, np.ndarray]:
    """Averages, over tasks, of models trained on each task's windows.

    A round takes every ``rounds``-th window, so that all rounds together take each once.
    Weights that every step moves are averaged by windows, rows of tables by their uses.
    """
    spark = windows.sparkSession
    model = new_model(np.bincount(tree.kind, counts), inputs=IDS + 2, tree=tree)
    model["embed"][:IDS][counts[:IDS] == 0] = 0
    own_tree = spark.sparkContext.broadcast(tree)
    columns = [f"w{i}" for i in range(NODE)]
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        rate = RATE / (1 + number)

        def train(parts: Iterator[pa.RecordBatch], sent=sent, rate=rate, number=number) -> Iterator[pa.RecordBatch]:
            tree, own, adam = own_tree.value, {name: value.copy() for name, value in sent.value.items()}, None
            seen, passed, uses = 0, 0, {name: np.zeros(len(own[name])) for name in TABLES}
            for part in parts:
                for value in part.column("windows"):
                    found = np.frombuffer(value.as_buffer(), dtype=np.uint16).reshape(-1, WINDOW + 1)
                    mine = found[(number - passed) % rounds :: rounds].astype(np.int64)
                    mine[mine == IDS + 2] = -1
                    passed += len(found)
                    for low in range(0, len(mine), BATCH):
                        step = mine[low : low + BATCH]
                        inputs, targets = step[:, :-1], step[:, 1:]
                        valid = (inputs >= 0) & (inputs != IDS)
                        inputs = np.where(valid, inputs, IDS + 1)
                        slopes = table_gradients(own, inputs, valid, targets, tree)
                        slopes["nodes"], nodes, times = slopes["nodes"]
                        slopes["embed"], ids, often = slopes["embed"]
                        adam = adam or Adam(own, rate)
                        adam.update(own, slopes, {"embed": ids, "nodes": nodes})
                        uses["embed"][ids] += often
                        uses["nodes"][nodes] += times
                    seen += len(mine)
            if seen:
                weights = to_rows(own)
                times = np.concatenate([uses[name] for name in TABLES])
                times = np.r_[np.full(len(weights) - len(times), float(seen)), times]
                moved = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(moved, pa.int32()), pa.array(times[moved]), *(pa.array(np.ascontiguousarray(w)) for w in weights[moved].T)],
                    names=["at", "uses", *columns],
                )

        trained = windows.mapInArrow(train, f"at int, uses double, {', '.join(f'{c} float' for c in columns)}")
        found = trained.groupBy("at").agg(*((F.sum(F.col(c) * F.col("uses")) / F.sum("uses")).alias(c) for c in columns)).toArrow()
        weights = to_rows(model)
        weights[found["at"].to_numpy()] = np.stack([found[c].to_numpy() for c in columns], 1)
        model = from_rows(weights, model)
    return model


def _word_table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the words of the smallest count that BROADCAST_WORDS words reach."""
    steps = counts.groupBy("count").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("count"))
    least, held = 1 << 62, 0
    for step in steps.toLocalIterator():
        if held + step["words"] > BROADCAST_WORDS:
            break
        least, held = step["count"], held + step["words"]
    frequent = counts.where(F.col("count") >= least).toPandas().sort_values("hash")
    return frequent["hash"].to_numpy(np.int64), frequent["count"].to_numpy(np.int64)


def score_documents(docs: DataFrame, tokenizer: str = TOKENIZER, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(doc_id as text) mod 5 is 1 are held out; all others, and those
    without doc_id, are learnt from. A null text is empty: it consists of the end alone.
    ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the words, A-Z in lower
    case, and the end; ``score`` is the model's log10 probability of the same words, as
    subwords, and the end. Repeated rows are counted and scored as often as they occur.
    Other columns are ignored; an empty table gives an empty result. Without training
    documents nothing is known and the model is the untrained one.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    vocabulary = context.broadcast(Path(tokenizer).read_bytes())
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder(F.col("doc_id"), 5) == 1, F.lit(False)).alias("held_out"),
        text_or_empty("text").alias("text"),
    )
    gathered = materialise(texts.where("NOT held_out").select("text").mapInArrow(_gather(vocabulary), GATHERED))
    counts = materialise(_summed(gathered, "hashes", "counts"))
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    floor = total + 0.5 * (distinct + 1)
    seen = np.zeros(IDS + 1)
    found = _summed(gathered, "ids", "id_counts").toPandas()
    seen[found["hash"].to_numpy(np.int64)] = found["count"].to_numpy(float)
    opens = _opens(_encoder(vocabulary.value))
    kind = _classes(seen, opens)
    tree = new_tree(kind, seen + 0.5)
    model = _learnt(gathered.select("windows"), tree, seen, rounds)
    # The ids of a class either all open words or none does.
    opening = np.zeros(len(model["bias"]), np.float32)
    opening[kind] = opens
    sent = context.broadcast((model, tree, opening, *_word_table(counts)))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, met = _encoder(vocabulary.value), Encoded()
        own, tree, opening, known, times = sent.value
        shares = (times + 0.5) / floor
        for part in parts:
            for batch in batches(part, most_bytes=4 << 20):
                n = batch.num_rows
                hashes, starts, ends, first, data = words(batch.column("text"))
                met_at = _places(hashes, starts, ends, data, encoder, met)
                ids, sizes = met.ids(met_at)
                # Every text's end is one more word, of one id.
                end_at = first[1:]
                found = np.insert(hashes.view(np.int64), end_at, END_HASH)
                sizes = np.insert(sizes, end_at, 1)
                ids = np.insert(ids.astype(np.int64), np.r_[0, np.cumsum(sizes)][end_at + np.arange(n)] - np.arange(n), IDS)
                word_at = np.cumsum(sizes) - sizes
                begin = first + np.arange(n + 1)
                text = np.repeat(np.arange(n), np.diff(begin))
                logs, opened = score_places(own, ids, np.r_[word_at, len(ids)][begin], IDS + 1, opening, tree=tree)
                # A word's ids, given that a word opens, and that after them another opens.
                before = opened[word_at]
                after = np.where(found == END_HASH, 0.0, np.r_[before[1:], 0.0])
                parts_log = (np.add.reduceat(logs, word_at) + after - before) / math.log(10)
                # Of the distinct words and the end, the place in the table, or -1.
                distinct = np.append(met.hashes.view(np.int64), END_HASH)
                place = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
                place = np.where(known[place] == distinct, place, -1) if len(known) else np.full(len(distinct), -1)
                place = place[np.insert(met_at, end_at, len(distinct) - 1)]
                hit = place >= 0
                p = shares[place[hit]]
                mixed = np.log10(COUNTED * p + (1 - COUNTED) * 10.0 ** parts_log[hit])
                edges = pa.array(np.searchsorted(text[~hit], np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("row", "doc_id", "held_out")),
                        pa.array(np.diff(begin), pa.int64()),
                        pa.array(np.bincount(text[hit], minlength=n), pa.int64()),
                        pa.array(np.bincount(text[hit], np.log10(p), n), pa.float64()),
                        pa.array(np.bincount(text[hit], mixed, n), pa.float64()),
                        pa.ListArray.from_arrays(edges, pa.array(found[~hit], pa.int64())),
                        pa.ListArray.from_arrays(edges, pa.array(parts_log[~hit], pa.float64())),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "mixed", "rare", "rare_logs"],
                )

    scored = materialise(
        texts.mapInArrow(
            score,
            "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, mixed double,"
            " rare array<long>, rare_logs array<double>",
        )
    )
    rare = scored.select("row", F.explode(F.arrays_zip(F.col("rare").alias("hash"), F.col("rare_logs").alias("log"))).alias("word")).select("row", "word.*")
    times = F.coalesce("count", F.lit(0))
    share_ = (times + 0.5) / F.lit(float(floor))
    others = (
        rare.join(counts, "hash", "left")
        .groupBy("row")
        .agg(
            F.count_if(times > 0).alias("known_rare"),
            F.sum(F.log10(share_)).alias("base_rare"),
            F.sum(F.log10(share_ * COUNTED + F.pow(F.lit(10.0), "log") * (1 - COUNTED))).alias("mixed_rare"),
        )
    )
    zero = F.lit(0.0)
    return (
        scored.drop("rare", "rare_logs")
        .join(others, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
            F.lit(int(total)).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("base_rare", zero)).alias("base_score"),
            (F.col("mixed") + F.coalesce("mixed_rare", zero)).alias("score"),
        )
    )
