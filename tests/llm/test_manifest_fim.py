from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from basketlens.llm.fim import SLICE_BYTES, draws, fim_digests, fim_texts
from basketlens.llm.manifest import dataset_manifest, proof_digest
from tests.llm.brute import LOWER


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def cut(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of one text, in plain Python."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h1, h2, h3, h4 = draws(doc_id)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts(spark, documents):
    """The common edge cases, and texts that hold marks, letters of several bytes or one huge unit."""
    more = ["a <P> b", "<M>", "< P>", "Grüße, 世界! 𝒳y\n\n", "é", "<", "P>x<S", "Z" * (SLICE_BYTES + 7) + " ü", "1" * 9001]
    rows = [(1000 + i, text, "en", "a", 1) for i, text in enumerate(more * 12)]
    return documents.unionByName(spark.createDataFrame(rows, documents.schema))


@pytest.mark.parametrize("piece_units", [7, 4096])
def test_fim_rows_equal_plain_python(texts, piece_units):
    small = texts if piece_units > 7 else texts.where("length(text) < 4000 OR text IS NULL")
    expected = sorted(
        (str((r.doc_id, *facts, sha(output), sha(r.text or ""))))
        for r in small.collect()
        for *facts, output in [cut(r.doc_id, r.text)]
    )
    found = fim_digests(small, piece_units).collect()
    assert sorted(str(tuple(r)) for r in found) == expected
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_fim_texts(texts):
    rows = texts.where("doc_id >= 1000")
    expected = {r.doc_id: cut(r.doc_id, r.text) for r in rows.collect()}
    found = {r.doc_id: tuple(r)[1:] for r in fim_texts(rows, 100).collect()}
    assert found == expected


def tree(digests: list[str], fan: int) -> list[list[str]]:
    """The levels of a tree, from the leaves to the one node on top."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[at : at + fan])) for at in range(0, len(below), fan)])
    return levels


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def manifest(rows, fan: int = 8) -> list[str]:
    """The query's rows in plain Python."""
    def leaf(r, text):
        return sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))

    langs: dict = {}
    for r in rows:
        langs.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(langs[lang], key=lambda x: x[:3])], fan) for lang in order}
    top = tree([trees[lang][-1][0] for lang in order], fan)
    out = []
    for lang in order:
        for at, (*_, own, r) in enumerate(sorted(langs[lang], key=lambda x: x[:3])):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            node, siblings = leaf(r, r.text.translate(LOWER)) if hit else own, ""
            for levels, place in ((trees[lang], at), (top, order.index(lang))):
                for level in levels[:-1]:
                    start = place // fan * fan
                    left, right = "".join(level[start:place]), "".join(level[place + 1 : start + fan])
                    siblings, node, place = siblings + left + right, sha(left + node + right), place // fan
            root = top[-1][0]
            out.append(str((r.doc_id, own, trees[lang][-1][0], root, sha(siblings), node, node == root)))
    return sorted(out)


def shown(df) -> list[str]:
    digest = proof_digest(F.col("proof")).alias("proof_sha256")
    return sorted(str(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", "verified").collect())


@pytest.mark.parametrize("fan, levels", [(8, 3), (2, 1), (3, 2)])
def test_manifest_equals_plain_python(spark, documents, fan, levels):
    """Blocks of 2 and 9 leaves need several rounds; langs of one leaf and null are trees too."""
    lang = F.expr("CASE WHEN doc_id < 2 THEN NULL WHEN doc_id = 2 THEN '' WHEN doc_id < 60 THEN 'en' WHEN doc_id = 80 THEN 'ß' ELSE 'zz' END")
    docs = documents.withColumn("lang", lang)
    assert shown(dataset_manifest(docs, fan=fan, levels=levels)) == manifest(docs.collect(), fan)


def test_manifest_of_one_row_and_of_many_langs(documents):
    one = documents.where("doc_id = 3")
    assert shown(dataset_manifest(one)) == manifest(one.collect())
    many = documents.withColumn("lang", F.concat(F.lit("l"), "doc_id"))
    assert shown(dataset_manifest(many)) == manifest(many.collect())


def test_new_operators_ignore_other_columns_and_take_empty_tables(documents, clashing):
    for operator in (fim_digests, dataset_manifest):
        extra = clashing.withColumns({name: F.lit(1) for name in ("tree", "rank", "digest", "proof", "root", "nodes", "at", "data", "form", "part")})
        plain, more = (sorted(map(str, operator(d.where("doc_id < 50")).collect())) for d in (documents, extra))
        assert plain == more
        assert operator(documents.limit(0)).count() == 0
