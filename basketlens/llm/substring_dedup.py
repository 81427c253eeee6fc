"""Substring dedup by collinear chaining of shared seeds (operator 4).

Seeds are ``K``-word runs chosen by winnowing: the smallest hash of every window of
``WINDOW`` runs, so any 11 equal words share a seed, and any piece of 20 equal words has two
places of seeds in each text, without which a pair is not compared. A seed that stands in several
documents ties each of them to the first document that has it, never all of them to each
other. So does a shared seed with either of the two shared seeds that follow it, at their
distance: documents that share a run of words whose parts stand in several earlier documents meet through the seams between
them. Exact copies are one text until the end. All places of a seed in one text are matched
with all its places in the other; matches that are one run of equal words become one run,
and runs are chained in text order with gap costs, the best predecessor coming from a
Fenwick tree of prefix maxima. Every chain, of one seed too, is aligned on the words of both
texts: gaps between seeds by longest common subsequence, ends by extension until mismatches
outweigh matches; a chain with too few equal words gives its longest part with enough. Where
texts repeat themselves so much that their runs exceed MATCHES for each place, or their
matches ENUMERATED, seeds with many matches give way to the longest equal runs of all words
of both texts, from a suffix array of the pair. Aligned pieces of a document that touch make its passages, so a passage whose
parts have different first documents is whole again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import broadcast_if_small, discard, materialise, text_or_empty, word_count
from basketlens.llm.wordhash import U, batches, runs, words

K, WINDOW = 4, 8
MIN_WORDS = 50
#: A chain breaks where more words lie between two seeds in either text.
MAX_GAP = 64
#: Cost of a word between two seeds; a seed is worth its K words.
GAP_COST = 0.1
#: Pieces are kept from this length on and with this share of equal words.
MIN_PIECE, MIN_EQUAL = 20, 0.8
#: A pair chains so many runs for each place of its seeds, and LEAST_MATCHES, at most.
MATCHES, LEAST_MATCHES = 4, 4096
#: So many matches of a pair are listed to find its runs (16 MB).
ENUMERATED = 1 << 20
#: Partners of a first document that meet its words in one key.
PARTNERS = 256
#: Ends of many runs are followed over so many words at once; those that go on further alone.
EXTENDED = 24
#: Passages of a document join if so few words lie between them.
JOIN_GAP = 3


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best(values[i : i + width]) for every i; past the end the window is cut."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        best(out[:-step], out[step:], out=out[:-step]) if len(out) > step else None
        done += step
    return out


SEEDS = "doc_id long, text_hash long, second_id long, seed long, places binary"


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Runs of four-byte values as binary."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    n = len(keys[0])
    new = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.r_[np.flatnonzero(np.r_[True, new][:n]), n]


def _seeds(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Winnowed seeds with all their places in a text."""
    for part in parts:
        for batch in batches(part):
            hashes, _, _, first, _ = words(batch.column("text"))
            found = runs(hashes, K)
            text = np.searchsorted(first, np.arange(len(found)), "right") - 1
            place = np.arange(len(found)) - first[text]
            count = np.diff(first)[text] if len(found) else place
            inside = place <= count - K
            # Windows lie within one text; those that leave it count as nothing.
            least = _sliding(np.where(inside, found, U(2**64 - 1)), WINDOW, np.minimum)
            least[place > count - K - WINDOW + 1] = 0
            covered = _sliding(least[::-1], WINDOW, np.maximum)[::-1]
            chosen = np.flatnonzero(inside & (covered == found) & (count >= MIN_WORDS))
            chosen = chosen[np.lexsort((place[chosen], found[chosen], text[chosen]))]
            seed, owner = found[chosen], text[chosen]
            edges = _edges(seed, owner)
            rows = pa.array(owner[edges[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in ("doc_id", "text_hash", "second_id")),
                    pa.array(seed[edges[:-1]].view(np.int64)),
                    _cut(place[chosen].astype(np.int32), edges),
                ],
                names=["doc_id", "text_hash", "second_id", "seed", "places"],
            )


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All four-byte values of a binary column, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, kind, count=int(offsets[-1] - offsets[0]) // 4, offset=int(offsets[0])) if data and len(column) else np.zeros(0, kind)
    return values, np.diff(offsets) // 4


def _each_place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of a seed in a text."""
    for batch in parts:
        place, counts = _flat(batch.column("places"), np.int32)
        kept = batch.select(["doc_id", "text_hash", "second_id", "first_id", "seed"]).take(pa.array(np.repeat(np.arange(batch.num_rows), counts)))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(place)], names=[*kept.schema.names, "place"])


def _as_binary(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column of lists of places as binary."""
    for batch in parts:
        at = batch.schema.get_field_index("places")
        lists = batch.column(at)
        edges = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())] if len(lists) else np.zeros(1, np.int64)
        columns = list(batch.columns)
        columns[at] = _cut(lists.flatten().to_numpy().astype(np.int32), edges)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _word_arrays(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for batch in batches(part):
            hashes, _, _, first, _ = words(batch.column("text"))
            short = (hashes >> U(32)).astype(np.uint32)
            arrays = [short[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(arrays, pa.binary())], names=["doc_id", "text_hash", "words"]
            )


class _PrefixBest:
    """A Fenwick tree of the best (value, item) among keys up to a given one."""

    def __init__(self, size: int):
        self.best = [(-1e18, -1)] * (size + 1)

    def put(self, key: int, value: float, item: int) -> None:
        key += 1
        while key < len(self.best):
            if value > self.best[key][0]:
                self.best[key] = (value, item)
            key += key & -key

    def up_to(self, key: int) -> tuple[float, int]:
        key, best = key + 1, (-1e18, -1)
        while key > 0:
            if self.best[key][0] > best[0]:
                best = self.best[key]
            key -= key & -key
        return best


def chains_of_runs(found: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Chains of runs (place, other place, length) that rise in both, best first, each run in one.

    A chain's score is the words of its runs less GAP_COST for every word between the last
    seed of a run and the first of the next in either text; a run starts a chain of its own
    where no predecessor helps.
    """
    found = sorted(found)
    last = [(place + n - K, other + n - K) for place, other, n in found]
    keys = sorted({other for _, other in last})
    ended = sorted(range(len(found)), key=lambda i: last[i][0])
    tree = _PrefixBest(len(keys))
    score, before, at = [0.0] * len(found), [-1] * len(found), 0
    for i, (place, other, n) in enumerate(found):
        while last[ended[at]][0] < place:
            done = ended[at]
            tree.put(bisect_left(keys, last[done][1]), score[done] + GAP_COST * sum(last[done]), done)
            at += 1
        value, item = tree.up_to(bisect_left(keys, other) - 1)
        value -= GAP_COST * (place + other)
        score[i] = n + max(0.0, value)
        before[i] = item if value > 0 else -1
    used, chains = [False] * len(found), []
    for i in sorted(range(len(found)), key=lambda i: (-score[i], i)):
        chain: list[tuple[int, int, int]] = []
        while i >= 0 and not used[i]:
            used[i] = True
            if chain and max(chain[-1][0] - last[i][0], chain[-1][1] - last[i][1]) > MAX_GAP:
                chains.append(chain[::-1])
                chain = []
            chain.append(found[i])
            i = before[i]
        if chain:
            chains.append(chain[::-1])
    return chains


def collinear_chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Chains of single matches (place, other place), each a run of K words."""
    return [[run[:2] for run in chain] for chain in chains_of_runs([(*match, K) for match in matches])]


def _matches(own: np.ndarray, own_counts: np.ndarray, other: np.ndarray, other_counts: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of a seed with every other place; with a gap, also the seeds so far behind.

    Each match once, by diagonal (place less other place) and then by place.
    """
    own, other = own.astype(np.int64), other.astype(np.int64)
    sizes = own_counts * other_counts
    if (sizes == 1).all():
        # The usual case: a seed stands once in either text.
        a, b, gap = own, other, gaps
    else:
        row = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        a = own[(np.cumsum(own_counts) - own_counts)[row] + within // other_counts[row]]
        b = other[(np.cumsum(other_counts) - other_counts)[row] + within % other_counts[row]]
        gap = gaps[row]
    more = gap > 0
    both = ((a - b) << 32) + a
    if more.any():
        both = np.concatenate([both, (both + gap)[more]])
    both.sort()
    different = np.ones(len(both), bool)
    np.not_equal(both[1:], both[:-1], out=different[1:])
    both = both[different]
    a = both & 0xFFFFFFFF
    return a, a - (both >> 32)


def _equal_runs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Matches on one diagonal, at most WINDOW apart and with equal words between, as runs."""
    if not len(a):
        return []
    # Those of _matches are in this order, which a stable sort passes over once.
    order = np.argsort(((a - b) << 32) + a, kind="stable")
    a, b = a[order], b[order]
    step = a[1:] - a[:-1]
    whole = (step == b[1:] - b[:-1]) & (step <= WINDOW)
    for t in range(K, WINDOW):
        open_ = np.flatnonzero(whole & (step > t))
        whole[open_] = x[a[open_] + t] == y[b[open_] + t]
    stop = np.flatnonzero(np.concatenate([~whole, [True]]))
    first = np.concatenate([[0], stop[:-1] + 1])
    return list(zip(a[first].tolist(), b[first].tolist(), (a[stop] - a[first] + K).tolist()))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short word runs."""
    n = min(len(a), len(b))
    if not n or a.tobytes() == b.tobytes():
        return n
    if n > MAX_GAP:
        differ = np.flatnonzero(a[:n] != b[:n])
        head = int(differ[0]) if len(differ) else n
        differ = np.flatnonzero(a[::-1][: n - head] != b[::-1][: n - head])
        tail = int(differ[0]) if len(differ) else n - head
        a, b = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    else:
        a, b = a.tolist(), b.tolist()
        head = tail = 0
        while head < n and a[head] == b[head]:
            head += 1
        while tail < n - head and a[-1 - tail] == b[-1 - tail]:
            tail += 1
        a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b:
        return head + tail
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return head + tail + row[-1]


def _extend(a: np.ndarray, b: np.ndarray, cost: int = 2) -> tuple[int, int]:
    """How far two runs go on together, and the equal words: matches 1, mismatches -cost."""
    n, step = min(len(a), len(b)), 8
    a, b = a[:n], b[:n]
    best = at = score = top = equal = equal_at_best = 0
    while at < n:
        for same in (a[at : at + step] == b[at : at + step]).tolist():
            at += 1
            score += 1 if same else -cost
            equal += same
            if score > top:
                top, best, equal_at_best = score, at, equal
            elif score < top - 3 * cost:
                return best, equal_at_best
        step = 64
    return best, equal_at_best


def _side(x: np.ndarray, y: np.ndarray, at: np.ndarray, other: np.ndarray, way: np.ndarray, room: np.ndarray, width: int) -> np.ndarray:
    """Whether the words from a place and another on are equal, a row per place; none is beyond ``room``."""
    t = np.arange(width)
    inside = t < room[:, None]
    move = way[:, None] * t * inside
    place = np.where(room > 0, at, 0)[:, None] + move
    mate = np.where(room > 0, other, 0)[:, None] + move
    return (x[place] == y[mate]) & inside


def _both_ways(ends: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places before (start, stop, other, other stop) going back, then those behind going on, and the words left there."""
    start, stop, other, other_stop = ends
    back = np.minimum(start, other)
    on = np.minimum(len(x) - stop, len(y) - other_stop)
    way = np.repeat([-1, 1], len(start))
    return np.concatenate([start - 1, stop]), np.concatenate([other - 1, other_stop]), way, np.concatenate([back, on])


def _extended(ends: np.ndarray, x: np.ndarray, y: np.ndarray, cost: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_extend` before and behind of many at once: words and equal words, by side."""
    at, other, way, room = _both_ways(ends, x, y)
    same = _side(x, y, at, other, way, room, EXTENDED)
    score = np.cumsum(np.where(same, 1, -cost), axis=1)
    top = np.maximum(np.maximum.accumulate(score, axis=1), 0)
    over = np.logical_or.accumulate(score < top - 3 * cost, axis=1)
    score[over] = -1
    best = score.argmax(axis=1)
    row = np.arange(len(best))
    found = score[row, best] > 0
    words = np.where(found, best + 1, 0)
    equal = np.where(found, np.cumsum(same, axis=1)[row, best], 0)
    for i in np.flatnonzero(~over[:, -1] & (room > EXTENDED)).tolist():
        a, b = int(at[i]), int(other[i])
        sides = (x[a:], y[b:]) if way[i] > 0 else (x[: a + 1][::-1], y[: b + 1][::-1])
        words[i], equal[i] = _extend(*sides, cost)
    return words.reshape(2, -1), equal.reshape(2, -1)


def _first_pieces(chains: list[list[tuple[int, int, int]]], x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """:func:`align_chain` of many chains of runs, whose words are equal."""
    if not chains:
        return []
    rows = []
    for chain in chains:
        a, b, n = chain[0]
        equal, at, other_at = n, a + n, b + n
        for place, mate, n in chain[1:]:
            between = _common(x[at:place], y[other_at:mate]) if at < place and other_at < mate else 0
            equal += between + n - max(0, at - place, other_at - mate)
            at, other_at = place + n, mate + n
        rows.append((a, at, b, other_at, equal))
    table = np.array(rows).T
    words, equal = _extended(table[:4], x, y)
    moved = (table[0] - words[0], table[1] + words[1], table[2] - words[0], table[3] + words[1], table[4] + equal.sum(axis=0))
    return list(zip(*(column.tolist() for column in moved)))


def _can_widen(pieces: list[tuple[int, int, int, int, int]], x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Pieces with so many equal words within MAX_GAP words that :func:`_widened` may move them."""
    if not pieces:
        return []
    table = np.array(pieces).T
    at, other, way, room = _both_ways(table[:4], x, y)
    most = table[4] + np.minimum(room, MAX_GAP).reshape(2, -1).sum(axis=0)
    kept = np.flatnonzero(most >= MIN_EQUAL * MIN_WORDS)
    both = np.concatenate([kept, kept + len(pieces)])
    same = _side(x, y, at[both], other[both], way[both], room[both], MAX_GAP).sum(axis=1).reshape(2, -1).sum(axis=0)
    return [pieces[i] for i in kept[table[4][kept] + same >= MIN_EQUAL * MIN_WORDS].tolist()]


def align_chain(chain: list[tuple[int, int]], x: np.ndarray, y: np.ndarray, cost: int = 2) -> tuple[int, int, int, int, int]:
    """start and stop in both texts, and the equal words between them."""
    (start, other), (stop, other_stop) = chain[0], chain[-1]
    stop, other_stop = stop + K, other_stop + K
    equal, at, other_at = 0, start, other
    for place, mate in chain:
        overlap = max(0, at - place, other_at - mate)
        if overlap < K:
            equal += _common(x[at:place], y[other_at:mate]) + K - overlap
            at, other_at = place + K, mate + K
    left, left_equal = _extend(x[:start][::-1], y[:other][::-1], cost)
    right, right_equal = _extend(x[stop:], y[other_stop:], cost)
    return start - left, stop + right, other - left, other_stop + right, equal + left_equal + right_equal


def _longest_part(chain: list[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """First and last match of the longest part of a chain with MIN_EQUAL equal words."""
    excess = [0.0]
    for (a, b), (c, d) in zip(chain, chain[1:]):
        equal = _common(x[a + K : c], y[b + K : d]) + K if min(c - a, d - b) >= K else min(c - a, d - b)
        excess.append(excess[-1] + equal - MIN_EQUAL * max(c - a, d - b))
    excess = np.array(excess)
    # The first match is K equal words of its own.
    least = np.minimum.accumulate(excess)
    first = np.searchsorted(-least, -(excess + K * (1 - MIN_EQUAL) + 1e-9))
    place = np.array([a for a, _ in chain])
    last = int(np.argmax(place - place[first]))
    return int(first[last]), last


def _widened(piece: tuple[int, int, int, int, int], x: np.ndarray, y: np.ndarray) -> tuple[int, int, int, int, int]:
    """A piece of under MIN_WORDS, moved out on both sides to where it has them, if it can.

    Of the ends within MAX_GAP words that leave MIN_EQUAL equal words, those whose matches
    less twice the mismatches are most.
    """
    start, stop, other, other_stop, equal = piece
    left, right = min(start, other, MAX_GAP), min(len(x) - stop, len(y) - other_stop, MAX_GAP)
    if equal + left + right < MIN_EQUAL * MIN_WORDS:
        return piece
    same_before, same_after = x[start - left : start] == y[other - left : other], x[stop : stop + right] == y[other_stop : other_stop + right]
    if equal + np.count_nonzero(same_before) + np.count_nonzero(same_after) < MIN_EQUAL * MIN_WORDS:
        return piece
    before, after = np.zeros(left + 1, np.int64), np.zeros(right + 1, np.int64)
    same_before[::-1].cumsum(out=before[1:])
    same_after.cumsum(out=after[1:])
    more = np.arange(left + 1)[:, None] + np.arange(right + 1)[None, :]
    same = before[:, None] + after[None, :]
    length = max(stop - start, other_stop - other) + more
    fit = (equal + same >= MIN_EQUAL * length) & (stop - start + more >= MIN_WORDS)
    if not fit.any():
        return piece
    i, j = np.unravel_index(np.argmax(np.where(fit, 3 * same - 2 * more, -(1 << 30))), fit.shape)
    return start - int(i), stop + int(j), other - int(i), other_stop + int(j), equal + int(same[i, j])


def _enough(p: tuple[int, int, int, int, int]) -> bool:
    return p[4] >= MIN_EQUAL * max(p[1] - p[0], p[3] - p[2])


def _piece_of(chain: list[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """The chain's alignment, or those of its longest parts with enough equal words."""
    chains = [chain]
    while chains:
        chain = chains.pop()
        piece = align_chain(chain, x, y)
        if not _enough(piece):
            first, last = _longest_part(chain, x, y)
            chains += [part for part in (chain[:first], chain[last + 1 :]) if part]
            # Ends of this cost have enough equal words by themselves.
            piece = align_chain(chain[first : last + 1], x, y, 4)
        if _enough(piece):
            yield piece


def _longest_runs(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, other place, length) of equal runs that cover all of MIN_PIECE or more words.

    The longest run of y that stands at each place of x comes from suffixes sorted by
    doubling; of the runs, as few are kept as cover the same places.
    """
    m, n = len(x), len(x) + len(y) + 2
    _, start = np.unique(np.r_[x, y], return_inverse=True)
    levels = [np.r_[start[:m], n, start[m:], n + 1].astype(np.int64)]
    while (1 << (len(levels) - 1)) < min(m, len(y)):
        step = 1 << (len(levels) - 1)
        after = np.zeros(n, np.int64)
        after[:-step] = levels[-1][step:] + 1
        _, rank = np.unique(levels[-1] * (n + 3) + after, return_inverse=True)
        levels.append(rank)
    order = np.argsort(levels[-1], kind="stable")
    is_other = order > m
    before = np.maximum.accumulate(np.where(is_other, np.arange(n), -1))
    behind = np.minimum.accumulate(np.where(is_other, np.arange(n), n)[::-1])[::-1]
    own = np.flatnonzero(order < m)
    place = order[own]
    best, mate = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for near in (before[own], behind[own]):
        known = (near >= 0) & (near < n)
        other = np.where(known, order[np.clip(near, 0, n - 1)], n - 1)
        run = np.zeros(len(place), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            # No run is longer than the last level, so each level is added once.
            i, j = np.minimum(place + run, n - 1), np.minimum(other + run, n - 1)
            run += (levels[level][i] == levels[level][j]) * (1 << level)
        better = known & (run > best[place])
        best[place[better]], mate[place[better]] = run[better], other[better] - m - 1
    out, reached, held = [], 0, None
    for at in np.flatnonzero(best >= MIN_PIECE).tolist():
        if held and at > reached:
            out.append(held)
            reached, held = held[0] + held[2], None
        stop = at + int(best[at])
        if stop > max(reached, held[0] + held[2] if held else 0):
            held = (at, int(mate[at]), int(best[at]))
    return out + [held] * bool(held)


def pieces_of_pair(seeds: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Aligned pieces of two texts whose common seeds stand at these places of each."""
    own, other = (np.concatenate([pair[side] for pair in seeds]) for side in (0, 1))
    own_counts, other_counts = (np.array([len(pair[side]) for pair in seeds], np.int64) for side in (0, 1))
    return _pieces(own, own_counts, other, other_counts, np.zeros(len(seeds), np.int64), x, y)


def _pieces(
    own: np.ndarray, own_counts: np.ndarray, other: np.ndarray, other_counts: np.ndarray, gaps: np.ndarray, x: np.ndarray, y: np.ndarray
) -> list[tuple[int, int, int, int, int]]:
    """The pieces, from the places of all seeds in a row and how many each seed has."""
    matched: list[tuple[int, int, int]] = []
    longest: list[tuple[int, int, int]] = []
    sizes, places = own_counts * other_counts, own_counts + other_counts
    most = LEAST_MATCHES + MATCHES * int(places.sum())
    listed = int(sizes.sum()) <= max(ENUMERATED, most)
    if listed:
        matched = _equal_runs(*_matches(own, own_counts, other, other_counts, gaps), x, y)
    if not listed or len(matched) > most:
        few = sizes <= MATCHES * places
        matched = _equal_runs(*_matches(own[np.repeat(few, own_counts)], own_counts[few], other[np.repeat(few, other_counts)], other_counts[few], gaps[few]), x, y)
        longest = _longest_runs(x, y) + [(b, a, n) for a, b, n in _longest_runs(y, x)]
    chains = [[run] for run in longest] + chains_of_runs(matched)
    ends = lambda a, b, n: [(a, b), (a + n - K, b + n - K)] if n > K else [(a, b)]
    found = set()
    for chain, piece in zip(chains, _first_pieces(chains, x, y)):
        if _enough(piece):
            found.add(piece)
        else:
            found.update(_piece_of([match for run in chain for match in ends(*run)], x, y))
    long = [piece for piece in found if piece[1] - piece[0] >= MIN_WORDS]
    within = lambda p, at: any(q[at] <= p[at] and p[at + 1] <= q[at + 1] for q in long)
    # A piece whose words all stand in long enough ones needs no more words.
    short = [piece for piece in found.difference(long) if not (within(piece, 0) and within(piece, 2))]
    found |= {_widened(piece, x, y) for piece in _can_widen(short, x, y)}
    return sorted(piece for piece in found if piece[1] - piece[0] >= MIN_PIECE)


def _aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        rows, found = [], []
        matches = batch.column("matches")
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint32) for c in ("words", "first_words"))
            common = matches[i].values
            (own, own_counts), (other, other_counts) = (_flat(common.field(c), np.int32) for c in ("places", "first_places"))
            gaps = common.field("gap").to_numpy().astype(np.int64)
            pieces = _pieces(own, own_counts.astype(np.int64), other, other_counts.astype(np.int64), gaps, x, y)
            rows += [i] * len(pieces)
            found += pieces
        kept = batch.select(["doc_id", "text_hash", "second_id", "first_id", "first_hash", "first_second"]).take(pa.array(rows, pa.int64()))
        columns = [pa.array(c, pa.int32()) for c in zip(*found)] if found else [pa.array([], pa.int32())] * 5
        yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, "start", "stop", "first_start", "first_stop", "equal"])


def _held(side: str) -> Column:
    """Whether seeds of a pair stand at two places or more of one side."""
    return F.aggregate("matches", F.lit(0), lambda n, m: n + F.octet_length(m[side]) * F.when(m["gap"] > 0, 2).otherwise(1)) >= 8


def _ties(shared: DataFrame, keys: list[str], gap: Column) -> DataFrame:
    """Rows of a text and a text of the first document that has its key, with the places of both.

    Texts of one document only meet where another document has one of them too.
    """
    firsts = shared.where("doc_id = first_id").select(
        *keys, F.col("text_hash").alias("first_hash"), F.col("second_id").alias("first_second"), F.col("places").alias("first_places")
    )
    other = "doc_id <> first_id OR (text_hash < first_hash AND coalesce(second_id, first_second) IS NOT NULL)"
    match = F.struct("places", "first_places", gap.cast("int").alias("gap"))
    return shared.join(firsts, keys).where(other).select("doc_id", "text_hash", "second_id", "first_id", "first_hash", "first_second", match.alias("match"))


LAST = "max(coalesce(second_id, doc_id)) AS last_id"
PAIR = ["doc_id", "text_hash", "second_id", "first_id", "first_hash", "first_second"]


def _seams(shared: DataFrame) -> DataFrame:
    """Shared seeds with one of the two that follow in their text, and the first document of both.

    A row per text, seed, next seed and distance (MAX_GAP at most), with the places of the
    seed. Where the seed's first document has both, there is none: they tie to it already.
    """
    order = Window.partitionBy("doc_id", "text_hash").orderBy("place", "seed")
    after = [F.struct(F.lead("seed", n).over(order).alias("next"), (F.lead("place", n).over(order) - F.col("place")).alias("gap")) for n in (1, 2)]
    placed = shared.mapInArrow(_each_place, "doc_id long, text_hash long, second_id long, first_id long, seed long, place int")
    # One shuffle by text serves repeated rows and the order of places.
    placed = placed.repartition("doc_id", "text_hash")
    follows = materialise(placed.dropDuplicates(["doc_id", "text_hash", "place"]).withColumn("after", F.array(*after)))
    follows_each = follows.withColumn("after", F.explode("after")).select("*", "after.*").drop("after").where(F.col("gap").between(1, MAX_GAP))
    key = ["seed", "next", "gap"]
    seams = (
        follows_each.groupBy(*key)
        .agg(F.min("doc_id").alias("seam_id"), F.expr(LAST), F.min("first_id").alias("first_id"))
        .where("seam_id < last_id AND seam_id <> first_id")
        .select(*key, F.col("seam_id").alias("first_id"))
    )
    names = ["doc_id", "text_hash", "second_id", "first_id", *key]
    places = follows_each.drop("first_id").join(seams, key).groupBy(*names).agg(F.sort_array(F.collect_list("place")).alias("places"))
    types = ", ".join(f"{name} {'int' if name == 'gap' else 'long'}" for name in names)
    between = materialise(places.mapInArrow(_as_binary, f"{types}, places binary"))
    discard(follows)
    return between


def matching_pieces(rows: DataFrame) -> DataFrame:
    """Aligned pieces of texts and the texts of first documents that share their seeds.

    ``rows`` has doc_id, text_hash, text and second_id, the next document with that very text.
    """
    seeds = materialise(rows.mapInArrow(_seeds, SEEDS))
    spread = seeds.groupBy("seed").agg(F.min("doc_id").alias("first_id"), F.expr(LAST)).where("first_id < last_id").drop("last_id")
    shared = materialise(seeds.join(spread, "seed"))
    discard(seeds)
    between = _seams(shared)
    ties = _ties(shared, ["seed"], F.lit(0)).unionByName(_ties(between, ["seed", "next", "gap"], F.col("gap")))
    pairs = materialise(
        ties.groupBy(*PAIR).agg(F.collect_set("match").alias("matches")).where(_held("places") & _held("first_places"))
    )
    discard(shared)
    discard(between)
    wanted = pairs.select("doc_id", "text_hash").unionByName(
        pairs.select(F.col("first_id").alias("doc_id"), F.col("first_hash").alias("text_hash"))
    )
    arrays = materialise(
        rows.join(broadcast_if_small(materialise(wanted.distinct())), ["doc_id", "text_hash"], "left_semi")
        .select("doc_id", "text_hash", "text")
        .mapInArrow(_word_arrays, "doc_id long, text_hash long, words binary")
        .dropDuplicates(["doc_id", "text_hash"]),
        "snappy",
    )
    # A text with many partners has its words sent once for each PARTNERS of them.
    many = pairs.groupBy("first_id", "first_hash").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts")).where("parts > 1")
    many = broadcast_if_small(materialise(many))
    parts = F.coalesce("parts", F.lit(1))
    first_arrays = (
        arrays.select(F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash"), F.col("words").alias("first_words"))
        .join(many, ["first_id", "first_hash"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("parts")
    )
    dealt = pairs.join(many, ["first_id", "first_hash"], "left").withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash"), parts).cast("int"))
    both = dealt.join(arrays, ["doc_id", "text_hash"]).join(first_arrays, ["first_id", "first_hash", "part"])
    return both.select(*PAIR, "matches", "words", "first_words").mapInArrow(
        _aligned, ", ".join(f"{c} long" for c in PAIR) + ", start int, stop int, first_start int, first_stop int, equal int"
    )


def _with_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per text, under its first document, and exact copies with the name of that text.

    A text is named by its document, and a hash where that document has several. Texts are
    equal if two hashes of 96 bits in all and their length are. Texts too short for a passage
    are left out.
    """
    text = text_or_empty("text")
    same = ["text_hash", "check", "length"]
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.hash(text).alias("check"),
        F.octet_length(text).alias("length"),
        text.alias("text"),
    )
    rows = rows.where(F.col("length") >= 2 * MIN_WORDS - 1)
    members = materialise(rows.drop("text").distinct())
    several = members.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("several")).where("several")
    firsts = members.groupBy(*same).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    copies = materialise(members.join(firsts.drop("last_id"), same))
    seconds = copies.where("doc_id <> first_id").groupBy("first_id", *same).agg(F.min("doc_id").alias("second_id"))
    copied = copies.join(seconds, ["first_id", *same]).select("doc_id", *same, "first_id", "second_id")
    marked = materialise(
        members.join(copied, ["doc_id", *same], "left").join(several, "doc_id", "left").where("first_id IS NOT NULL OR several")
    )
    kept = rows.join(broadcast_if_small(marked), ["doc_id", *same], "left").where("first_id IS NULL OR first_id = doc_id")
    # A document of one text needs no hash to name it.
    hashed = F.when(F.col("several"), F.col("text_hash")).otherwise(F.lit(0)).alias("text_hash")
    of_first = marked.where("first_id = doc_id").select("first_id", *same, hashed.alias("first_hash"))
    others = copies.where("doc_id <> first_id").join(of_first, ["first_id", *same]).select("doc_id", "first_id", "first_hash")
    return kept.select("doc_id", hashed, "second_id", "text"), others


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per passage of a document that repeats in another document.

    Columns: doc_id, start_word, stop_word (exclusive), n_words and other_id, the smallest
    doc_id that shares a piece of it. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower
    case, numbered from 0. A passage has at least ``min_words`` words (50 or more), and
    at least 0.8 of the words of each of its pieces are equal in order. Both sides of
    a match are reported, the first document too. Shorter, empty and null texts and rows
    without doc_id have no passages; rows that agree in doc_id and text are one document,
    and documents that share a doc_id are not compared with each other. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows, copies = _with_copies(docs)
    pieces = materialise(matching_pieces(rows))
    # The other document is the first with that text, or the second where that is the same one.
    other = lambda a, b, second: F.when(F.col(a) == F.col(b), F.col(second)).otherwise(F.col(b))
    whole = rows.where("second_id IS NOT NULL").select(
        "doc_id", "text_hash", F.lit(0).alias("start"), word_count(F.col("text")).cast("int").alias("stop"), F.col("second_id").alias("other_id")
    )
    sides = (
        pieces.select("doc_id", "text_hash", "start", "stop", other("doc_id", "first_id", "first_second").alias("other_id"))
        .unionByName(
            pieces.select(
                F.col("first_id").alias("doc_id"),
                F.col("first_hash").alias("text_hash"),
                F.col("first_start").alias("start"),
                F.col("first_stop").alias("stop"),
                other("first_id", "doc_id", "second_id").alias("other_id"),
            )
        )
        .unionByName(whole)
    )
    # No more rows per document than it has words, however many others share a piece.
    starts = sides.groupBy("doc_id", "text_hash", "start").agg(F.max("stop").alias("stop"), F.min("other_id").alias("other_id"))
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    reached: Column = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    passages = (
        starts.withColumn("new", (F.col("start") > F.coalesce(reached, F.lit(-JOIN_GAP - 1)) + JOIN_GAP).cast("int"))
        .withColumn("passage", F.sum("new").over(order))
        .groupBy("doc_id", "text_hash", "passage")
        .agg(F.min("start").alias("start_word"), F.max("stop").alias("stop_word"), F.min("other_id").alias("other_id"))
        .withColumn("n_words", F.col("stop_word") - F.col("start_word"))
        .where(F.col("n_words") >= min_words)
    )
    found = materialise(passages.select("doc_id", "text_hash", "start_word", "stop_word", "n_words", "other_id"))
    # Copies have the one passage of their first document, which is all of the text.
    of_first = found.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"})
    of_copies = copies.join(of_first, ["first_id", "first_hash"]).withColumn("other_id", F.least("other_id", "first_id"))
    names = ["doc_id", "start_word", "stop_word", "n_words", "other_id"]
    return found.select(*names).unionByName(of_copies.select(*names))
