"""Fill-in-middle by secondary-sort assembly (operator 12).

A text is cut into units, the units into prefix, middle and suffix, and these into pieces of
at most ``PIECE_UNITS`` units. Every piece is a row keyed by its document and its position
in the output. One shuffle by document with a sort inside partitions (what
``repartitionAndSortWithinPartitions`` is to an RDD, with Spark's own spilling sort) brings
the pieces of an output next to each other, and a task streams them into a digest that it
holds one of at a time. The streamed output is read back by its marks and form alone; its
pieces get their position in the text and are sorted once more, inside the same
partitions, for the digest of the restored text. No step holds more of a text than a piece
once the pieces are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import text_or_empty
from basketlens.llm.wordhash import batches, text_bytes

#: The marks before prefix, suffix and middle, and the order of the parts.
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
ORDERS = {"psm": "PSM", "spm": "SPM"}
PLACE_IN_TEXT = {"P": 0, "M": 1, "S": 2}

PIECE_UNITS = 4096
SLICE_BYTES = 1 << 20
PLAIN_PERCENT, SPM_PERCENT = 10, 20

PIECES = "row long, at int, data binary, doc_id long, n long, form string, prefix_chars long, middle_chars long"
SORTED = PIECES.replace("at int", "part int, at int")
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def draws(doc_id: int | None, seed: int = 1) -> list[int]:
    """Four numbers of 32 bits that depend on the id; a null id counts as no digits."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[at : at + 8], 16) for at in range(0, 32, 8)]


def unit_starts(data: np.ndarray, at: int, stop: int) -> np.ndarray:
    """Where units begin in ``data[at:stop]``: runs of A-Z and a-z, other code points alone."""
    piece = data[at:stop]
    letter = IS_LETTER[piece]
    follows = np.empty(len(piece), dtype=bool)
    follows[:1] = at > 0 and IS_LETTER[data[at - 1]]
    follows[1:] = letter[:-1]
    return np.flatnonzero(np.where(letter, ~follows, (piece & 0xC0) != 0x80)) + at


class Units:
    """The units of one text, found in slices; every ``step``-th start is kept."""

    def __init__(self, data: np.ndarray, step: int):
        self.data, self.step, self.n = data, step, 0
        kept = []
        for at in range(0, len(data), SLICE_BYTES):
            starts = unit_starts(data, at, at + SLICE_BYTES)
            kept.append(starts[-self.n % step :: step])
            self.n += len(starts)
        self.starts = np.concatenate(kept) if kept else np.zeros(0, np.int64)

    def byte(self, unit: int) -> int:
        """Where a unit begins; the end of the text for the unit after the last."""
        if unit >= self.n:
            return len(self.data)
        at, left = int(self.starts[unit // self.step]), unit % self.step
        while True:
            found = unit_starts(self.data, at, at + SLICE_BYTES)
            if left < len(found):
                return int(found[left])
            left, at = left - len(found), at + SLICE_BYTES

    def pieces(self, first: int, stop: int) -> Iterator[bytes]:
        """The bytes of units ``first`` to ``stop``, cut at every ``step``-th unit of the text."""
        at, end = self.byte(first), self.byte(stop)
        for border in self.starts[np.searchsorted(self.starts, at, "right") : np.searchsorted(self.starts, end)]:
            yield self.data[at:border].tobytes()
            at = int(border)
        if end > at:
            yield self.data[at:end].tobytes()


def points(data: np.ndarray) -> int:
    """How many code points UTF-8 bytes have."""
    return int(sum(np.count_nonzero((data[at : at + SLICE_BYTES] & 0xC0) != 0x80) for at in range(0, len(data), SLICE_BYTES)))


def output_pieces(doc_id: int | None, data: np.ndarray, step: int, seed: int) -> tuple[tuple, Iterator[bytes]]:
    """(n, form, prefix_chars, middle_chars) of one text, and its output piece by piece."""
    units, (h1, h2, h3, h4) = Units(data, step), draws(doc_id, seed)
    raw = memoryview(data).tobytes()
    if not raw or any(mark in raw for mark in MARKS.values()) or h3 % 100 >= 100 - PLAIN_PERCENT:
        return (units.n, "plain", None, None), units.pieces(0, units.n)
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    borders = {"P": (0, first), "M": (first, second), "S": (second, units.n)}
    chars = [points(data[units.byte(start) : units.byte(stop)]) for start, stop in (borders["P"], borders["M"])]

    def pieces():
        for part in ORDERS[form]:
            yield MARKS[part]
            yield from units.pieces(*borders[part])

    return (units.n, form, *chars), pieces()


def _cut(step: int, seed: int) -> Callable:
    schema = arrow_schema(PIECES)

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for batch in batches(whole):
                data, offsets = text_bytes(batch.column("text"))
                rows, held = [], 0
                for i, (row, doc_id) in enumerate(zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist())):
                    facts, pieces = output_pieces(doc_id, data[offsets[i] : offsets[i + 1]], step, seed)
                    rows.append((row, -1, b"", doc_id, *facts))
                    for at, piece in enumerate(pieces):
                        rows.append((row, at, piece, None, None, None, None, None))
                        held += len(piece)
                        if held > SLICE_BYTES:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                yield _batch(rows, schema)

    return cut


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(list(c), kind) for c, kind in zip(columns, schema.types)], schema=schema)


def _streamed(source: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    for batch in source:
        yield list(zip(*(batch.column(name).to_pylist() for name in names)))


def _read_back(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest the outputs, and give every piece of text its position in the original.

    The row of facts comes first in a document and goes out last, with the output's digest
    in ``data``. In a plain output everything is text; otherwise the marks say what follows.
    """
    schema = arrow_schema(SORTED)
    parts = {mark: PLACE_IN_TEXT[name] for name, mark in MARKS.items()}
    names = tuple(arrow_schema(PIECES).names)
    facts, running, part, out = None, None, 0, []

    def closed():
        return (facts[0], 3, 0, running.digest(), *facts[3:])

    for rows in _streamed(source, names):
        for row in rows:
            if row[1] < 0:
                if facts is not None:
                    out.append(closed())
                facts, running, part = row, hashlib.sha256(), 0
                continue
            running.update(row[2])
            if facts[5] != "plain" and row[2] in parts:
                part = parts[row[2]]
            else:
                out.append((row[0], part, row[1], row[2], None, None, None, None, None))
        yield _batch(out, schema)
        out = []
    if facts is not None:
        yield _batch([closed()], schema)


def _restored(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest the pieces in their restored order; the facts come last in a document."""
    schema, running = arrow_schema(DIGESTS), hashlib.sha256()
    for rows in _streamed(source, tuple(arrow_schema(SORTED).names)):
        out = []
        for _, part, _, data, *facts in rows:
            if part < 3:
                running.update(data)
            else:
                out.append((*facts, data.hex(), running.hexdigest()))
                running = hashlib.sha256()
        yield _batch(out, schema)


def assembled_pieces(docs: DataFrame, piece_units: int = PIECE_UNITS, seed: int = 1) -> DataFrame:
    """The outputs as rows (row, at, data, ...), those of a document together and in order.

    A document's first row, at -1, has no data but its doc_id, n, form, prefix_chars and
    middle_chars; ``row`` tells documents apart.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty("text").alias("text"),
    )
    return rows.mapInArrow(_cut(piece_units, seed), PIECES).repartition("row").sortWithinPartitions("row", "at")


def fim_texts(docs: DataFrame, piece_units: int = PIECE_UNITS, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars and ``output``.

    For consumers that want an output in one string; null and repeated ids are treated as by
    ``fim_digests``.
    """
    pieces = assembled_pieces(docs, piece_units, seed)
    found = F.sort_array(F.collect_list(F.struct("at", F.col("data").cast("string").alias("data"))))
    facts = [F.max(name).alias(name) for name in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
    return pieces.groupBy("row").agg(*facts, found.alias("pieces")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.array_join("pieces.data", "").alias("output")
    )


def fim_digests(docs: DataFrame, piece_units: int = PIECE_UNITS, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    A null text counts as empty and has the form plain, n 0 and null lengths. The cut depends
    on the id alone (a null id has no digits), so rows of one id are cut by the same numbers and
    stay rows of their own. Other columns of ``docs`` are ignored; an empty table gives no rows.
    """
    read = assembled_pieces(docs, piece_units, seed).mapInArrow(_read_back, SORTED)
    return read.sortWithinPartitions("row", "part", "at").mapInArrow(_restored, DIGESTS)
