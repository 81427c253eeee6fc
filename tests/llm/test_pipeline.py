"""The pipeline's stages on a small corpus, each against what plain Python gives."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm.quality import classify_quality
from tests.llm import brute
from tests.llm.conftest import sentence


def corpus(spark, folder):
    """Good and bad texts, near copies, a footer on many sites, leaks; as Parquet tables."""
    rows, labels = [], []
    item = sentence(77, 40)

    def add(doc_id, text, source, quality=None):
        rows.append((doc_id, text, "en", source, len(text)))
        if quality is not None:
            labels.append((doc_id, quality, 0))

    for i in range(200):
        words = sentence(1000 + i, 60)
        good = i % 4 > 0
        text = " ".join(words) + ".\nAll rights reserved here." if good else " ".join(f"{w.upper()}%%%" for w in words)
        add(i, text, f"s{i % 15}", int(good))
    base = sentence(5, 200)
    for i in range(12):
        copy = list(base)
        copy[10 * i] = f"changed{i}"
        add(300 + i, " ".join(copy) + ".\nAll rights reserved here.", "s0" if i else "s1")
    add(400, " ".join(sentence(8, 50) + item) + ".\nAll rights reserved here.", "s2")
    add(401, " ".join(item[20:] + sentence(9, 30) + item[:20]) + ".\nAll rights reserved here.", "s3")
    rows.append((500, None, "en", None, None))
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_each_stage_takes_effect(spark, tmp_path):
    folder = str(tmp_path)
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before, kept = docs, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, folder)
        if name != names[-1]:
            assert after.columns == columns and after.schema == before.schema
        after.write.parquet(f"{folder}/stage{number}")
        before = kept[name] = spark.read.parquet(f"{folder}/stage{number}")

    def ids(name):
        return {r.doc_id for r in kept[name].select("doc_id").distinct().collect()}

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = classify_quality(docs, labels).where("predicted = 1")
    assert ids("quality") == {r.doc_id for r in good.collect()}
    assert {i for i in range(200) if i % 4} <= ids("quality") and not {i for i in range(200) if i % 4 == 0} & ids("quality")

    texts = {r.doc_id: r for r in kept["lines"].collect()}
    assert sum("All rights reserved" in (r.text or "") for r in texts.values()) == 1
    assert all(r.n_chars == len(r.text) for r in texts.values() if r.text is not None)
    assert ids("lines") == ids("quality")

    parts = brute.components({i: r.text for i, r in texts.items()}, 5)
    assert ids("near_copies") == {i for i in parts if parts[i] == i}
    assert len(ids("near_copies") & set(range(300, 312))) == 1
    assert ids("near_copies") - ids("benchmark") == {400, 401}

    drawn = kept["mix"].groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    with_words = {r.doc_id for r in kept["benchmark"].collect() if r.text}
    assert {r.doc_id for r in drawn} == with_words
    assert max(r.n for r in drawn) <= 4

    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, kept["mix"].select(whole.columns).collect()))


def test_stages_take_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
