from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import attention, lm, quality, wordhash
from basketlens.llm.chat import rotate_perspectives
from basketlens.llm.decontaminate import drop_contaminated, find_contamination, greedy_tiles
from basketlens.llm.licenses import scan_licenses
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.lm import TOKENIZER, score_documents
from basketlens.llm.mixing import mix_sources
from basketlens.llm.quality import classify_quality
from tests.llm import brute
from tests.llm.conftest import sentence


@pytest.mark.parametrize("size", [3, 7, 64, 1 << 17])
def test_word_hashes_do_not_depend_on_slices(monkeypatch, size):
    texts = ["Ab cd", "", "  ", "abé ÀB x" * 3, None, "x" * 500, "end", "a", "b\x0bc\n", "ab"] * 2
    monkeypatch.setattr(wordhash, "SLICE_BYTES", size)
    hashes, starts, ends, first, data = wordhash.words(pa.array(texts))
    known = {}
    for i, text in enumerate(texts):
        own = [bytes(data[starts[j] : ends[j]]).decode().translate(brute.LOWER) for j in range(first[i], first[i + 1])]
        assert own == brute.words(text)
        for j, word in enumerate(own):
            assert known.setdefault(word, hashes[first[i] + j]) == hashes[first[i] + j]
    assert len(set(known.values())) == len(known)


def test_mixing_meets_entropy_repeats_and_budget(spark):
    rows = [(i, "a b c d e", "big") for i in range(1000)] + [(2000 + i, "a b c", "small") for i in range(60)] + [(3000, "", "none"), (3001, None, None), (3002, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {"big": 5000, "small": 180, "": 2}
    drawn = mix_sources(docs, entropy_share=0.6, max_repeats=4.0).toPandas()
    weight = drawn.groupby("source").weight.first()
    assert max(drawn.groupby("source").epoch.max()) <= 3
    assert {3000, 3001}.isdisjoint(drawn.doc_id)
    for source, group in drawn.groupby("source"):
        quota = min(math.floor(sum(tokens.values()) * weight[source]), 4 * tokens[source])
        assert quota <= group.n_tokens.sum() < quota + 5
        assert not group.duplicated(["doc_id", "epoch"]).any()
        whole = group[group.epoch < group.epoch.max()]
        assert all(n == (whole.epoch.nunique()) for n in whole.groupby("doc_id").size())
    every = mix_sources(docs, budget_tokens=None).toPandas()
    assert set(every.doc_id) == {r[0] for r in rows if r[1]}
    assert mix_sources(docs.limit(0)).count() == 0 == mix_sources(docs.where("doc_id = 3000")).count()


def test_mixing_without_limits_keeps_the_shares(spark):
    rows = [(i, "a b", "x") for i in range(90)] + [(100 + i, "a b", "y") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix_sources(docs, entropy_share=None, max_repeats=2.0).toPandas()
    assert dict(found.groupby("source").weight.first().round(6)) == {"x": 0.9, "y": 0.1}
    flat = mix_sources(docs, entropy_share=1.0, max_repeats=100.0).toPandas()
    assert dict(flat.groupby("source").weight.first().round(3)) == {"x": 0.5, "y": 0.5}


def test_quality_learns_from_text_alone(spark):
    rows, labels = [], []
    for i in range(400):
        good = i % 2
        own = sentence(i, 40)
        rows.append((i, " ".join(own) if good else " ".join(w.upper() + "$$$" for w in own)))
        labels.append((i, good))
    rows += [(900, None), (901, ""), (None, "no id"), (902, "y" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = classify_quality(docs, spark.createDataFrame(labels + [(None, 1), (901, None)], "doc_id long, quality int")).toPandas().set_index("doc_id")
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert list(found.index[found.held_out & (found.index < 400)].sort_values()) == held
    assert np.mean([found.predicted[i] == i % 2 for i in held]) > 0.98
    assert found.score.between(0, 1).all() and found.score[900] == found.score[901]
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    none = classify_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in none.collect()} == {0.5}
    assert classify_quality(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_forest_walks_like_its_trees():
    random_ = np.random.default_rng(0)
    x = random_.standard_normal((500, len(quality.FEATURES)))
    y = (x[:, 3] * x[:, 5] > 0).astype(float)
    forest = quality.fit_forest(x, y)
    assert np.mean((forest.score(x) >= 0.5) == y) > 0.95
    for row in (0, 17):
        total = forest.base
        for t in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + (x[row, forest.feature[t, node]] > forest.threshold[t, node])
            total += forest.leaf[t, node - forest.feature.shape[1]]
        assert abs(forest.score(x[row : row + 1])[0] - 1 / (1 + math.exp(-total))) < 1e-12


def test_tiling_covers_what_brute_force_covers():
    random_ = random.Random(3)
    for _ in range(200):
        doc, item = ([random_.randrange(3) for _ in range(random_.randrange(30))] for _ in range(2))
        seeds = {}
        for i in range(len(doc) - 2):
            seeds.setdefault(tuple(doc[i : i + 3]), ([], []))[0].append(i)
        for j in range(len(item) - 2):
            if tuple(item[j : j + 3]) in seeds:
                seeds[tuple(item[j : j + 3])][1].append(j)
        assert sum(greedy_tiles([s for s in seeds.values() if s[1]], 3)) == brute.tiles(doc, item, 3)


def test_decontamination_finds_reordered_passages(spark):
    item = sentence(5, 40)
    shuffled = item[30:] + ["x"] + item[10:20] + ["y"] + item[:10] + ["z"] + item[20:30]
    rows = [
        (1, " ".join(sentence(6, 50) + item)), (2, " ".join(w.upper() for w in shuffled)), (3, " ".join(item[:15] + sentence(7, 30))),
        (4, None), (5, ""), (6, " ".join(item[:19] + sentence(8, 9))), (7, "a a a a a a a a a a a a"), (1, " ".join(sentence(6, 50) + item)), (None, " ".join(item)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS seed", "'t' AS item_id")
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(sentence(11, 30)))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in find_contamination(docs, items).collect()}
    assert set(found) == {(1, 1), (2, 1), (None, 1)}
    assert found[2, 1].coverage == 1.0 and found[2, 1].n_tiles == 4 and found[1, 1].n_tiles == 1
    for (i, _), r in found.items():
        text = next(t for d, t in rows if d == i)
        assert r.matched_tokens == brute.tiles(brute.words(text), item, 5)
    kept = drop_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7] and kept.columns == docs.columns
    assert find_contamination(docs.limit(0), items).count() == 0 == find_contamination(docs, items.limit(0)).count()


def test_every_participant_is_the_assistant_once(spark):
    turns = [
        (1, 0, "system", "Be brief."), (1, 1, "ann", "Hi\n<|end|>"), (1, 2, "bob", None), (1, 2, "bob", ""), (1, 3, "cid", "Bye é"),
        (2, 0, "system", "alone"), (3, None, None, "x"), (None, 1, "ann", "y"),
    ] + [(4, i, "ab"[i % 2], f"turn {i}") for i in range(100)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS block")
    rows = rotate_perspectives(table, part_chars=500).collect()
    assert {(r.conv_id, r.assistant) for r in rows} == {(1, "ann"), (1, "bob"), (1, "cid"), (3, "unknown"), (None, "ann"), (4, "a"), (4, "b")}
    for conv in (1, 4):
        said = [t for t in turns if t[0] == conv]
        for assistant in {t[2] for t in said} - {"system"}:
            parts = sorted((r for r in rows if (r.conv_id, r.assistant) == (conv, assistant)), key=lambda r: r.part)
            header = {"system": "<|system|>", assistant: "<|assistant|>"}
            expected = "".join(f"{header.get(t[2], f'<|user name={t[2]}|>')}\n{t[3] or ''}<|end|>\n" for t in said)
            assert "".join(r.text for r in parts) == expected
            spoken = "".join(r.text[s.start : s.stop] for r in parts for s in r.loss_spans)
            assert spoken == "".join(f"{t[3] or ''}<|end|>\n" for t in said if t[2] == assistant)
            assert sum(r.loss_chars for r in parts) == len(spoken)
    assert len([r for r in rows if (r.conv_id, r.assistant) == (4, "a")]) > 5
    assert rotate_perspectives(table.limit(0)).count() == 0


def test_licenses(documents, spark):
    found = {(r.doc_id, r.license): r.containment for r in scan_licenses(documents).collect()}
    assert found == {(83, "mit"): 1.0}
    random_ = random.Random(2)
    template = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = []
    for i in range(120):
        words = template.split()
        for j in random_.sample(range(16), i % 4):
            words[j] = "changed"
        rows.append((i, " ".join(sentence(i, random_.randrange(40)) + words + sentence(i + 500, 20))))
    got = {r.doc_id: r.containment for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), {"t": template}).collect()}
    known = brute.shingles(template, 2)
    expected = {i: len(known & brute.shingles(t, 2)) / 15 for i, t in rows}
    assert got == {i: share for i, share in expected.items() if share >= 0.8}
    assert scan_licenses(documents.limit(0)).count() == 0


def test_license_bands_hash_only_blocks_with_a_template_shingle(spark):
    """All bands are hashed for blocks that a template can retrieve, wherever in a block its words begin."""
    notice = "Released under the MIT License."
    rows = [(i, " ".join(sentence(i, i) + notice.split() + sentence(i + 90, 30))) for i in range(14)]
    rows += [(14, "Released under the"), (15, "the MIT"), (16, None), (17, "the MIT License. Released under"), (18, "x")]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.license, r.containment, r.near_word <= r.doc_id + 4) for r in found.collect()} == {(i, "mit", 1.0, True) for i in range(14)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(array_distinct(" in plan and "transform(sequence(0" not in plan


def test_attention_gradients_match_differences():
    random_ = np.random.default_rng(1)
    model = {k: v.astype(np.float64) for k, v in attention.new_model(np.arange(1, 8)).items()}
    inputs = random_.integers(0, 8, (2, attention.WINDOW))
    targets = random_.integers(-1, 7, (2, attention.WINDOW))
    valid = np.ones_like(inputs, bool)
    valid[1, 30:] = False

    def loss(m):
        logits = attention._attend(m, inputs, valid, attention.WINDOW)[-1]
        logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        rows = np.nonzero(targets >= 0)
        return -logs[rows[0], rows[1], targets[rows]].mean()

    slopes = attention.gradients(model, inputs, valid, targets)
    for name in attention.SHAPES:
        at = tuple(random_.integers(0, n) for n in model[name].shape)
        high, low = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        high[name][at] += 1e-3
        low[name][at] -= 1e-3
        assert abs((loss(high) - loss(low)) / 2e-3 - slopes[name][at]) < 1e-4, name


def test_each_token_is_scored_once_with_its_context():
    """Windows give what one window over the whole text gives, as far as context reaches."""
    model = attention.new_model(np.arange(1, 8))
    random_ = np.random.default_rng(0)
    sequences = random_.integers(0, 7, 200)
    starts = np.array([0, 1, 41, 200])
    opens = np.ones(7, np.float32)
    logs, opening = attention.score_places(model, sequences, starts, 7, opens)
    assert np.abs(opening).max() < 1e-5 and (logs < 0).all()
    for start, stop in zip(starts[:-1], starts[1:]):
        for place in range(start, min(stop, start + attention.STRIDE)):
            inputs = np.full((1, attention.WINDOW), 7)
            valid = np.zeros((1, attention.WINDOW), bool)
            before = np.r_[7, sequences[start:place]]
            inputs[0, -len(before) :], valid[0, -len(before) :] = before, True
            one = attention.log_probabilities(model, inputs, valid, sequences[None, place : place + 1], opens)[0]
            assert abs(one[0, 0] - logs[place]) < 1e-4


def test_lm_scores(documents):
    rows = documents.select("doc_id", "text").collect()
    counts = Counter()
    for r in rows:
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update([*brute.words(r.text), None])
    total, distinct = sum(counts.values()), len(counts)
    found = score_documents(documents, TOKENIZER).collect()
    assert len(found) == len(rows)
    texts = {r.doc_id: r.text for r in rows}
    for r in found:
        tokens = [*brute.words(texts[r.doc_id]), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        assert abs(base - r.base_score) < 1e-6 * len(tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert r.score < 0 and math.isfinite(r.score)
    assert score_documents(documents.limit(0), TOKENIZER).count() == 0




def test_attention_learns_from_every_window():
    """Each subword id of each text and its end is predicted once, after the id before it."""
    texts = [" ".join(sentence(i, n)) for i, n in enumerate((0, 1, 20, 300, 2000))]
    vocabulary = SimpleNamespace(value=Path(TOKENIZER).read_bytes())
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (found,) = lm._gather(vocabulary)([batch])
    windows = np.frombuffer(found.column("windows")[0].as_py(), np.uint16).reshape(-1, attention.WINDOW + 1)
    expected = []
    for text in texts:
        hashes, starts, ends, _, data = wordhash.words(pa.array([text]))
        ids = lm.subwords(hashes, starts, ends, data, lm._encoder(vocabulary.value))[0].tolist()
        expected += zip([lm.IDS + 1, *ids], [*ids, lm.IDS])
    inputs, targets = windows[:, :-1], windows[:, 1:]
    learnt = targets < lm.IDS + 2
    assert list(zip(inputs[learnt].tolist(), targets[learnt].tolist())) == expected


def test_subwords_of_words_encoded_together_are_those_of_each_alone():
    texts = ["Don't 's 'S ab\u00a0 \u00a0 c\u2003d \u2003\u2003 “q” x\x85y é漢字、かな\u3000カ " + "w" * 700, "", None, "a\tb 12ab3!? \x1c 🙂🙂 ...--", "Don't é" * 3]
    hashes, starts, ends, _, data = wordhash.words(pa.array(texts))
    encoder = lm._encoder(Path(TOKENIZER).read_bytes())
    ids, sizes = lm.subwords(hashes, starts, ends, data, encoder)
    expected = []
    for a, b in zip(starts, ends):
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in data[a:b].tobytes())
        pieces = [raw[i : i + lm.LONG_WORD].decode("utf-8", "replace") for i in range(0, len(raw), lm.LONG_WORD)]
        expected.append([i for n, piece in enumerate(pieces) for i in encoder.encode_ordinary((" " if n == 0 else "") + piece)])
    assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_words_met_before_are_not_encoded_again():
    """A task encodes each distinct word once, not once per batch; ids do not change by that."""
    encoder = lm._encoder(Path(TOKENIZER).read_bytes())
    taken = []

    class Counting:
        encode_ordinary, decode_single_token_bytes = encoder.encode_ordinary, encoder.decode_single_token_bytes

        def encode_to_numpy(self, text, **more):
            taken.append(text)
            return encoder.encode_to_numpy(text, **more)

    counting = Counting()
    met = lm.Encoded()
    for text in ("one two Two " + "w" * 700 + " a\u00a0b", "", "two three ONE a\u00a0b zwei 1", "three " + "w" * 700):
        hashes, starts, ends, _, data = wordhash.words(pa.array([text]))
        alone = lm.subwords(hashes, starts, ends, data, encoder)
        found = lm.subwords(hashes, starts, ends, data, counting, met)
        assert all((a == b).all() for a, b in zip(alone, found))
    assert sorted("".join(taken).split()) == ["1", "one", "three", "two", "zwei"]


def test_decisions_of_neighbours_are_multiplied_once():
    """Blocks of outputs hold each decision on their paths once and give the odds of single steps."""
    random_ = np.random.default_rng(2)
    kind = np.r_[np.zeros(900, int), np.ones(60, int), 2]
    tree = attention.new_tree(kind, random_.pareto(1.0, len(kind)) + 0.01)
    model = attention.new_model(np.bincount(kind), inputs=len(kind) + 1, tree=tree)
    model["nodes"] += random_.standard_normal(model["nodes"].shape).astype(np.float32)
    ids = random_.choice(len(kind), 5000, p=random_.dirichlet(np.full(len(kind), 0.05)))
    read = random_.standard_normal((len(ids), attention.NODE)).astype(np.float32)
    paths = attention._Paths(model, tree, read, ids, tree.length[ids])
    assert len(paths.at) == tree.length[ids].sum() > 4 * len(paths.nodes)
    expected = np.zeros(len(ids))
    for i, (row, one) in enumerate(zip(read, ids)):
        steps = tree.steps[: tree.length[one], one]
        odds = (model["nodes"][steps >> 1] @ row) * (2 * (steps & 1) - 1.0)
        expected[i] = -np.log1p(np.exp(-odds)).sum()
    assert np.abs(attention.within_class(model, tree, read, ids) - expected).max() < 1e-3
    assert (attention.within_class(model, tree, read[:3], np.full(3, len(kind) - 1)) == 0).all()


def test_every_id_depends_on_its_context():
    """Ids that share a class have probabilities of their own at each place, which add up to one."""
    random_ = np.random.default_rng(4)
    opens = lm._opens(lm._encoder(Path(TOKENIZER).read_bytes()))
    words = np.flatnonzero(opens[: lm.IDS])[2000:2400]
    counts = np.zeros(lm.IDS + 1)
    counts[words] = 500
    kind = lm._classes(counts, opens)
    tree = attention.new_tree(kind, counts + 0.5)
    assert all(len(set(opens[kind == k])) == 1 for k in range(kind.max() + 1))
    model = attention.new_model(np.bincount(kind, counts), inputs=lm.IDS + 2, tree=tree)
    adam = attention.Adam(model, 0.02)
    for _ in range(150):
        first = random_.integers(0, 200, (64, attention.WINDOW // 2 + 1))
        rows = words[np.stack([first, first + 200], 2).reshape(64, -1)][:, : attention.WINDOW + 1]
        inputs, targets = rows[:, :-1], rows[:, 1:]
        slopes = attention.gradients(model, inputs, np.ones_like(inputs, bool), targets, tree)
        slopes["nodes"], nodes, _ = slopes["nodes"]
        adam.update(model, slopes, {"nodes": nodes})
    seconds = [i for i in range(200, 400) if (kind[words[200:400]] == kind[words[i]]).sum() > 1]
    assert len(seconds) > 100
    gains = []
    for i in seconds:
        other = next(j for j in seconds if j != i and kind[words[j]] == kind[words[i]])
        inputs = np.full((2, attention.WINDOW), lm.IDS + 1)
        inputs[:, -1] = words[i - 200]
        valid = inputs <= lm.IDS
        logs = attention.log_probabilities(model, inputs, valid, words[[[i], [other]]], np.ones(len(model["bias"]), np.float32), tree)[0]
        gains.append(logs[0, 0] - logs[1, 0])
    assert np.mean(np.array(gains) > 1) > 0.8
    inputs = np.full((1, attention.WINDOW), words[0])
    read, logits = attention._attend(model, inputs, inputs >= 0, 1)[-2:]
    share = np.exp(logits[0, 0] - np.log(np.exp(logits[0, 0]).sum()))
    ids = np.arange(lm.IDS + 1)
    every = share[kind] * np.exp(attention.within_class(model, tree, np.repeat(read[0], len(ids), 0), ids))
    assert abs(every.sum() - 1) < 1e-4


def test_slopes_of_decisions_match_differences():
    random_ = np.random.default_rng(1)
    kind = np.array([0, 1, 1, 1, 2, 2, 1, 0, 1])
    tree = attention.new_tree(kind, np.arange(1, 10) + 0.5)
    model = {k: v.astype(np.float64) for k, v in attention.new_model(np.arange(1, 4), inputs=10, tree=tree).items()}
    model["nodes"] += random_.standard_normal(model["nodes"].shape)
    inputs = random_.integers(0, 10, (2, attention.WINDOW))
    targets = random_.integers(-1, 9, (2, attention.WINDOW))
    valid = np.ones_like(inputs, bool)

    def loss(m):
        read, logits = attention._attend(m, inputs, valid, attention.WINDOW)[-2:]
        logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        at = np.nonzero(targets >= 0)
        ids = targets[at]
        return -(logs[at[0], at[1], kind[ids]] + attention.within_class(m, tree, read[at], ids)).mean()

    slopes = attention.gradients(model, inputs, valid, targets, tree)
    sums, nodes, times = slopes["nodes"]
    slopes["nodes"] = np.zeros_like(model["nodes"])
    slopes["nodes"][nodes] = sums
    assert times.sum() == tree.length[targets[targets >= 0]].sum()
    for name in (*attention.SHAPES, "nodes"):
        at = tuple(random_.integers(0, n) for n in model[name].shape)
        high, low = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        high[name][at] += 1e-2
        low[name][at] -= 1e-2
        assert abs((loss(high) - loss(low)) / 2e-2 - slopes[name][at]) < 2e-4, name
    assert all((attention.from_rows(attention.to_rows(model), model)[name] == model[name].astype(np.float32)).all() for name in model)


def test_lm_scores_tell_word_order(spark):
    """Words in the order of the training text score higher than the same words in another."""
    random_ = random.Random(5)
    pairs = [sentence(i, 2) for i in range(3000)]
    pairs = list({a: (a, b) for a, b in pairs}.values())[:200]
    learnt = " ".join(" ".join(random_.choice(pairs)) for _ in range(100_000))
    right = " ".join(" ".join(pair) for pair in pairs)
    swapped = " ".join(f"{a} {pairs[i - 1][1]}" for i, (a, _) in enumerate(pairs))
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(None, learnt), (held[0], right), (held[1], swapped)]
    found = {r.doc_id: r for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    one, other = found[held[0]], found[held[1]]
    assert abs(one.base_score - other.base_score) < 1e-6
    assert one.score - other.score > 0.1 * one.n_tokens


def test_no_column_name_clashes_with_inner_ones(spark, documents):
    """Rows keep columns of any name, and results do not change by them."""
    inner = ("__id", "__hash", "__removed", "__lines", "__text", "row", "id", "hash", "lines", "removed", "whole", "site", "found_id", "share", "quota", "with.dot")
    extra = documents.withColumns({name: F.lit("mine") for name in inner})
    items = spark.createDataFrame([(1, " ".join(sentence(9, 30_000)[50:90]))], "item_id long, text string")
    for operator in (lambda d: dedup_lines(d, 3), lambda d: drop_contaminated(d, items)):
        plain, more = operator(documents), operator(extra)
        assert set(inner) < set(more.columns)
        assert sorted(map(str, plain.collect())) == sorted(map(str, more.select(*plain.columns).collect()))
        assert more.where("__id = 'mine' AND `with.dot` = 'mine'").count() == plain.count() > 20
    assert sorted(map(str, mix_sources(extra).collect())) == sorted(map(str, mix_sources(documents).collect()))


def test_a_tiny_source_is_drawn(spark):
    """A source of one word among millions has a weight below the last reported decimal."""
    rows = [(1, "w " * 400_000, "big")] * 1 + [(2, "one", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for budget in ("corpus", None):
        found = mix_sources(docs, entropy_share=0.0, max_repeats=1.0, budget_tokens=budget).collect()
        assert {r.source for r in found} == {"big", "tiny"}
