"""A one-layer causal self-attention model in numpy: training steps and scoring.

Each output belongs to a class. A softmax over the classes and, in classes of several outputs,
one decision per step of the output's path in a Huffman tree give its probability; both read
the same input and what attention mixed for it, so every output depends on its context.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Inputs per window, and how many of them at its end are scored.
WINDOW, STRIDE = 48, 32
DIM = 16
SHAPES = ("embed", "query", "key", "value", "direct", "mixed", "bias", "distance")
#: Numbers per decision of the trees: as many as are read, of which the last is 1.
NODE = 2 * DIM + 1
#: So many outputs, neighbours in their trees, meet the decisions on their paths in one product;
#: blocks with up to so many decisions are filled up to that number and multiplied together.
BLOCK, FILLED = 32, (8, 24, 64, 192)


@dataclass(frozen=True)
class Tree:
    """The class of each output and its decisions in the tree of its class.

    ``steps[:length[i], i]`` has, from the root, twice the number of each decision, plus 1 for
    its first side; in the order of ``rank`` the outputs below a decision are neighbours.
    ``odds`` has the decisions' log odds by the weights alone.
    """

    kind: np.ndarray
    length: np.ndarray
    steps: np.ndarray
    rank: np.ndarray
    odds: np.ndarray


def new_tree(kind: np.ndarray, weights: np.ndarray) -> Tree:
    """Huffman trees over the outputs of each class."""
    leaves = len(kind)
    parent, side = np.full(2 * leaves, -1), np.zeros(2 * leaves, np.int64)
    order = np.argsort(kind, kind="stable")
    odds: list[float] = []
    for members in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        heap = list(zip(weights[members].tolist(), members.tolist()))
        heapq.heapify(heap)
        while len(heap) > 1:
            (low, first), (high, second) = heapq.heappop(heap), heapq.heappop(heap)
            node = leaves + len(odds)
            parent[first] = parent[second] = node
            side[first] = 1
            odds.append(float(np.log(low / high)))
            heapq.heappush(heap, (low + high, node))
    length, levels, at = np.zeros(leaves, np.uint8), [], np.arange(leaves)
    while (found := parent[at] >= 0).any():
        levels.append(np.where(found, 2 * (parent[at] - leaves) + side[at], 0).astype(np.int32))
        length += found
        at = np.where(found, parent[at], at)
    steps = np.zeros((len(levels), leaves), np.int32)
    for up, level in enumerate(levels):
        below = np.flatnonzero(length > up)
        steps[length[below] - 1 - up, below] = level[below]
    rank = np.empty(leaves, np.int32)
    rank[np.lexsort((*steps[::-1], kind))] = np.arange(leaves)
    return Tree(kind, length, steps, rank, np.array(odds, np.float32))


def new_model(counts: np.ndarray, seed: int = 7, inputs: int | None = None, tree: Tree | None = None) -> dict[str, np.ndarray]:
    """Small random weights, and the classes' shares of the corpus as bias.

    Without ``inputs`` the inputs are the classes, and one after the last that marks the
    beginning of a text.
    """
    classes = len(counts)
    random = np.random.default_rng(seed)
    sizes = ((inputs or classes + 1, DIM), (DIM, DIM), (DIM, DIM), (DIM, DIM), (DIM, classes), (DIM, classes), (classes,), (WINDOW,))
    model = {name: (random.standard_normal(size) * 0.3 / np.sqrt(size[0] if len(size) > 1 else 1e9)).astype(np.float32) for name, size in zip(SHAPES, sizes)} | {
        "embed": (random.standard_normal(sizes[0]) * 0.5).astype(np.float32),
        "bias": np.log((counts + 1) / (counts.sum() + classes)).astype(np.float32),
    }
    if tree is not None:
        model["nodes"] = np.zeros((len(tree.odds), NODE), np.float32)
        model["nodes"][:, -1] = tree.odds
    return model


#: Weights that every step moves; of the others, tables, a step moves the rows it uses.
DENSE = SHAPES[1:]
TABLES = ("embed", "nodes")


def to_rows(model: dict[str, np.ndarray]) -> np.ndarray:
    """All weights in rows of NODE numbers: those of DENSE together, then the rows of the tables."""
    dense = np.concatenate([model[name].ravel() for name in DENSE])
    dense = np.pad(dense, (0, -len(dense) % NODE)).reshape(-1, NODE)
    return np.concatenate([dense, *(np.pad(model[name], ((0, 0), (0, NODE - model[name].shape[1]))) for name in TABLES)])


def from_rows(rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    flat = rows.ravel()
    for name in DENSE:
        size = like[name].size
        out[name] = flat[at : at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    at = -(-at // NODE)
    for name in TABLES:
        count, width = like[name].shape
        out[name] = rows[at : at + count, :width].astype(np.float32)
        at += count
    return out


def _flat(a: np.ndarray) -> np.ndarray:
    return a.reshape(-1, a.shape[-1])


def _times(a: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One product of matrices for all windows."""
    return (_flat(a) @ weights).reshape(*a.shape[:-1], weights.shape[1])


def _exp(logs: np.ndarray) -> np.ndarray:
    """exp in place, of 60 at most."""
    if logs.size and logs.max() > 60:
        np.minimum(logs, 60, out=logs)
    return np.exp(logs, out=logs)


def _totals(a: np.ndarray, width: int = 1) -> np.ndarray:
    """Sums along the last axis, each ``width`` times."""
    return _times(a, np.ones((a.shape[-1], width), a.dtype))


def _crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of the transposed ``a`` with ``b``, both in rows, window by window."""
    a, b = (c.reshape(-1, WINDOW, c.shape[-1]) for c in (a, b))
    return (a.transpose(0, 2, 1) @ b).sum(axis=0)


def _sides(model) -> np.ndarray:
    """What makes an input's query, key and value, next to each other."""
    embed = model["embed"]
    return np.concatenate([model["query"] / np.sqrt(DIM, dtype=embed.dtype), model["key"], model["value"]], 1)


def _attend(model, inputs: np.ndarray, valid: np.ndarray, scored: int, sides: np.ndarray | None = None, read: np.ndarray | None = None):
    """Attention of the last ``scored`` positions over all positions up to their own.

    ``weights`` add up to ``total``, as often as there are DIM, at each position. ``read``, from which outputs follow, has
    each position's input, what attention mixed, and 1. ``sides`` has the query, key and value
    of every input if they are known; ``read`` is filled if it is given.
    """
    x = np.take(model["embed"], inputs, axis=0)
    both = _times(x, _sides(model)) if sides is None else np.take(sides, inputs, axis=0)
    q, k, v = both[:, -scored:, :DIM], both[:, :, DIM : 2 * DIM], both[:, :, 2 * DIM :]
    gap = np.arange(WINDOW - scored, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
    weights = q @ k.transpose(0, 2, 1)
    weights += np.where(gap >= 0, model["distance"][np.maximum(gap, 0)], -np.inf).astype(x.dtype)
    _exp(weights)
    partly = np.flatnonzero(~valid.all(axis=1))
    weights[partly] *= valid[partly, None, :]
    total = _totals(weights, DIM)
    total += x.dtype.type(1e-30)
    mixed = weights @ v
    mixed /= total
    read = np.empty((*weights.shape[:2], NODE), x.dtype) if read is None else read
    read[:, :, -1] = 1
    read[:, :, :DIM] = x[:, -scored:]
    read[:, :, DIM:-1] = mixed
    logits = _times(read, np.concatenate([model["direct"], model["mixed"], model["bias"][None]]))
    return x, q, k, v, gap, weights, total, read, logits


class _Paths:
    """The decisions of many outputs, blocks of neighbours in the trees at a time.

    ``odds`` has the signed log odds of each output's decisions, level by level, ``at`` the
    output of each, in the order of ``order``, and ``place`` where it stands among all products
    of a block's outputs with its decisions. The outputs and decisions of a block stand at
    ``own`` and ``slot`` in ``read`` and ``weights``; ``groups`` cuts these into blocks of one
    size.
    """

    def __init__(self, model, tree: Tree, read: np.ndarray, ids: np.ndarray, length: np.ndarray):
        some = np.flatnonzero(length)
        self.order = order = some[np.argsort(tree.rank[ids[some]].astype(np.uint16 if len(tree.rank) <= 1 << 16 else np.int32), kind="stable")]
        ids, length, n, blocks = ids[order], length[order], len(order), -(-len(order) // BLOCK)
        levels = np.arange(int(length.max(initial=0)))
        found = np.flatnonzero(length > levels.astype(np.uint8)[:, None])
        reach = n - np.cumsum(np.bincount(length))[: len(levels)]
        self.at = at = found - np.repeat(levels * n, reach)
        step = np.take(tree.steps.ravel(), np.take(ids, at) + np.repeat(levels * len(tree.rank), reach))
        node, block = step >> 1, at // BLOCK
        self.sign = (2 * (step & 1) - 1).astype(read.dtype)
        # Outputs below a decision are neighbours, so each block has it in one run.
        heads = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (block[1:] != block[:-1])][: len(node)])
        self.runs, self.nodes, block = np.diff(np.r_[heads, len(node)]), node[heads], block[heads]
        counts = np.bincount(block, minlength=blocks)
        limits = np.array([m for m in FILLED if m < counts.max(initial=0)] + [counts.max(initial=0)])
        kind = np.searchsorted(limits, counts)
        size, by_size = limits[kind], np.argsort(kind, kind="stable")
        begin, place = np.empty(blocks, np.int64), np.empty(blocks, np.int64)
        begin[by_size] = np.cumsum(size[by_size]) - size[by_size]
        place[by_size] = np.arange(blocks)
        by_block = np.argsort(block, kind="stable")
        self.slot = np.empty(len(heads), np.int64)
        self.slot[by_block] = np.arange(len(heads)) - np.repeat(np.cumsum(counts) - counts, counts)
        # Of an output with the first decision of its block, less the output's place in the block.
        self.place = np.repeat(begin[block] * BLOCK + self.slot, self.runs) + at % BLOCK * np.repeat(size[block], self.runs)
        self.slot += begin[block]
        self.own = (place[:, None] * BLOCK + np.arange(BLOCK)).ravel()[:n]
        self.weights = np.zeros((int(size.sum()), NODE), read.dtype)
        self.weights[self.slot] = np.take(model["nodes"], self.nodes, axis=0)
        source = np.zeros(blocks * BLOCK, np.int64)
        source[self.own] = order
        self.read = np.take(read, source, axis=0)
        each = np.bincount(kind, minlength=len(limits))
        ends, filled = np.cumsum(each), np.cumsum(each * limits)
        self.groups = [(slice((e - c) * BLOCK, e * BLOCK), slice(f - c * m, f), c, m) for c, m, e, f in zip(each.tolist(), limits.tolist(), ends.tolist(), filled.tolist()) if c]
        odds = np.empty(len(self.weights) * BLOCK, read.dtype)
        for outputs, decisions, products in self.parts(odds):
            np.matmul(outputs(self.read), decisions(self.weights).transpose(0, 2, 1), out=products)
        self.odds = np.take(odds, self.place) * self.sign
        np.clip(self.odds, -60, 60, out=self.odds)

    def parts(self, products: np.ndarray):
        """Per group: how its blocks lie in rows of outputs, in rows of decisions, and their part of ``products``."""
        for own, slots, c, m in self.groups:
            yield (
                lambda a, own=own, c=c: a[own].reshape(c, BLOCK, -1),
                lambda a, slots=slots, c=c, m=m: a[slots].reshape(c, m, -1),
                products[slots.start * BLOCK : slots.stop * BLOCK].reshape(c, BLOCK, m),
            )


def within_class(model, tree: Tree, read: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logs of the probability of each output given its class and what was read."""
    paths = _Paths(model, tree, read, ids, tree.length[ids])
    out = np.zeros(len(ids))
    out[paths.order] = -np.bincount(paths.at, np.log1p(np.exp(-paths.odds)), len(paths.order))
    return out


def _within_slopes(model, tree: Tree, read: np.ndarray, ids: np.ndarray, share):
    """Slopes of -share * within_class: of what was read, and of the decisions used, with their numbers and uses.

    Ids below 0 have none.
    """
    paths = _Paths(model, tree, read, ids, np.where(ids >= 0, tree.length[ids], 0).astype(np.uint8))
    slopes = np.zeros(len(paths.weights) * BLOCK, read.dtype)
    slopes[paths.place] = paths.sign * (-share / (1 + np.exp(paths.odds)))
    # The last row is that of outputs without decisions.
    last = len(paths.read)
    found, sums = np.zeros((last + 1, NODE), read.dtype), np.empty_like(paths.weights)
    for outputs, decisions, products in paths.parts(slopes):
        np.matmul(products, decisions(paths.weights), out=outputs(found))
        np.matmul(products.transpose(0, 2, 1), outputs(paths.read), out=decisions(sums))
    source = np.full(len(read), last)
    source[paths.order] = paths.own
    return np.take(found, source, axis=0)[:, :-1], _summed_rows(paths.nodes, np.take(sums, paths.slot, axis=0), paths.runs)


def _summed_rows(rows: np.ndarray, slopes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of the slopes of each row, the rows, and how often each occurs."""
    order = np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]][: len(rows)])
    if not len(rows):
        return slopes, rows, rows
    uses = np.diff(np.r_[first, len(rows)]) if times is None else np.add.reduceat(times[order], first)
    return np.add.reduceat(np.take(slopes, order, axis=0), first, axis=0), rows[first], uses


def log_probabilities(
    model, inputs: np.ndarray, valid: np.ndarray, targets: np.ndarray, opens: np.ndarray, tree: Tree | None = None, sides: np.ndarray | None = None, at_once: int = 128
) -> tuple[np.ndarray, np.ndarray]:
    """Natural logs of the probability of each target, and of opening a new word there.

    ``opens`` is the share of each class that opens words. With ``tree`` targets are its
    outputs, otherwise classes. Attention takes ``at_once`` windows at a time.
    """
    classes = targets if tree is None else tree.kind[targets]
    logs, opening = (np.empty(targets.shape, model["bias"].dtype) for _ in range(2))
    reads = np.empty((*targets.shape, NODE), logs.dtype)
    for low in range(0, len(inputs), at_once):
        some = slice(low, low + at_once)
        logits = _attend(model, inputs[some], valid[some], targets.shape[1], sides, reads[some])[-1]
        # Logits of these small models are far from the range in which exp overflows.
        chosen = np.clip(np.take_along_axis(logits, classes[some, :, None], axis=2)[:, :, 0], -80, 60)
        sums = np.log(_times(_exp(logits), np.stack([np.ones_like(opens), opens], 1)))
        logs[some], opening[some] = chosen - sums[:, :, 0], sums[:, :, 1] - sums[:, :, 0]
    if tree is not None:
        logs = logs + within_class(model, tree, _flat(reads), targets.ravel()).reshape(targets.shape)
    return logs, opening


def gradients(model, inputs: np.ndarray, valid: np.ndarray, targets: np.ndarray, tree: Tree | None = None) -> dict[str, np.ndarray]:
    """Of the mean negative log probability over positions whose target is not -1.

    With ``tree`` targets are its outputs, and ``nodes`` has the slopes of the decisions used,
    their numbers and how often each was; otherwise targets are classes.
    """
    out = table_gradients(model, inputs, valid, targets, tree)
    embed, (sums, rows, _) = np.zeros_like(model["embed"]), out["embed"]
    embed[rows] = sums
    return out | {"embed": embed}


def table_gradients(model, inputs: np.ndarray, valid: np.ndarray, targets: np.ndarray, tree: Tree | None = None) -> dict:
    """As ``gradients``, where ``embed``, as ``nodes``, has the rows used, their numbers and uses."""
    x, q, k, v, gap, weights, total, read, logits = _attend(model, inputs, valid, WINDOW)
    logits, read, ids = _flat(_exp(logits)), _flat(read), targets.ravel()
    at = np.flatnonzero(ids >= 0)
    share = x.dtype.type(1 / max(1, len(at)))
    scale = np.zeros((len(logits), 1), x.dtype)
    scale[at] = share / _totals(logits)[at]
    logits *= scale
    logits.ravel()[at * logits.shape[1] + (ids[at] if tree is None else tree.kind[ids[at]])] -= share
    head = _crossed(read, logits)
    d_read = logits @ np.concatenate([model["direct"], model["mixed"]]).T
    out = {}
    if tree is not None:
        d_within, out["nodes"] = _within_slopes(model, tree, read, ids, share)
        d_read += d_within
    # Weights stay as they are: what they add up to divides the slopes of what they mix.
    d_mixed = d_read[:, DIM:] / _flat(total)
    own = np.einsum("ij,ij->i", d_mixed, read[:, DIM:-1])
    d_mixed = d_mixed.reshape(x.shape)
    d_weights = d_mixed @ v.transpose(0, 2, 1)
    d_weights -= own.reshape(*x.shape[:2], 1)
    d_weights *= weights
    d_both = np.empty((*x.shape[:2], 3 * DIM), x.dtype)
    np.matmul(d_weights, k, out=d_both[:, :, :DIM])
    np.matmul(d_weights.transpose(0, 2, 1), q, out=d_both[:, :, DIM : 2 * DIM])
    np.matmul(weights.transpose(0, 2, 1), d_mixed, out=d_both[:, :, 2 * DIM :])
    d_both = _flat(d_both)
    d_x = d_both @ _sides(model).T
    d_x += d_read[:, :DIM]
    d_three = _crossed(x, d_both)
    near = d_weights.reshape(len(x), -1)
    distance = np.bincount(np.maximum(gap, 0).ravel(), (np.ones((1, len(x)), x.dtype) @ near)[0], WINDOW)
    return out | {
        "embed": _summed_rows(inputs.ravel(), d_x),
        "query": d_three[:, :DIM] / np.sqrt(DIM, dtype=x.dtype),
        "key": d_three[:, DIM : 2 * DIM],
        "value": d_three[:, 2 * DIM :],
        "direct": head[:DIM],
        "mixed": head[DIM:-1],
        "bias": head[-1],
        "distance": distance.astype(x.dtype),
    }


class Adam:
    """Steps of Adam; of a table only the rows that a step uses are moved."""

    def __init__(self, model, rate: float):
        self.rate, self.step = rate, 0
        self.first = {name: np.zeros_like(value) for name, value in model.items()}
        self.second = {name: np.zeros_like(value) for name, value in model.items()}

    def update(self, model, slopes, rows) -> None:
        """``rows`` names, for each table, the rows of the model that ``slopes`` has."""
        self.step += 1
        fast, slow = np.float32(self.rate / (1 - 0.9**self.step)), np.float32(1 / (1 - 0.99**self.step))
        for name, slope in slopes.items():
            at = rows.get(name)
            first, second, own = (a[name] if at is None else np.take(a[name], at, axis=0) for a in (self.first, self.second, model))
            first *= np.float32(0.9)
            first += np.float32(0.1) * slope
            second *= np.float32(0.99)
            second += np.float32(0.01) * slope * slope
            spread = np.sqrt(slow * second)
            spread += np.float32(1e-7)
            own -= fast * first / spread
            if at is not None:
                self.first[name][at], self.second[name][at], model[name][at] = first, second, own


def window_places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts with so many predictions each: text and first prediction of each window."""
    count = -(-lengths // STRIDE)
    text = np.repeat(np.arange(len(lengths)), count)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return text, first


def score_places(
    model, sequences: np.ndarray, starts: np.ndarray, begin: int, opens: np.ndarray, at_once: int = 1024, tree: Tree | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """ln p(id | ids before it in its text) of every id in ``sequences``.

    The second result is ln of the probability that a word opens at that place.

    ``sequences`` holds the ids of all texts, each with its end: outputs of ``tree``, or classes
    without it. Text i stands at ``starts[i] : starts[i + 1]``. Windows overlap by WINDOW - STRIDE
    inputs of context, and each id is scored once, in the window whose last STRIDE places it
    falls in.
    """
    lengths = np.diff(starts)
    text, first = window_places(lengths)
    out, opening, sides = np.zeros(len(sequences)), np.zeros(len(sequences)), model["embed"] @ _sides(model)
    for low in range(0, len(text), at_once):
        t, f = text[low : low + at_once], first[low : low + at_once]
        place = f[:, None] + np.arange(STRIDE - WINDOW, STRIDE)
        inside = place < lengths[t][:, None]
        # The input at a place is the id before it; before the first stands the begin mark.
        at = starts[t][:, None] + place
        inputs = np.where((place > 0) & inside, sequences[np.clip(at - 1, 0, len(sequences) - 1)], begin)
        scored, counted = at[:, WINDOW - STRIDE :], inside[:, WINDOW - STRIDE :]
        targets = np.where(counted, sequences[np.minimum(scored, len(sequences) - 1)], 0)
        logs, open_logs = log_probabilities(model, inputs, place >= 0, targets, opens, tree, sides)
        out[scored[counted]] = logs[counted]
        opening[scored[counted]] = open_logs[counted]
    return out, opening
