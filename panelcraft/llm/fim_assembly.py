"""Fill-in-the-middle transformation, assembled by a secondary sort.

A text is cut into units (a word with the blanks before it; blanks at the end are a unit).  Two
positions between units, drawn from a hash of the row's key, part it into prefix, middle and
suffix; a third draw leaves the text plain, a fourth picks the form: suffix-prefix-middle or
prefix-suffix-middle, each part behind its marker.  A text that has a marker itself, and an empty
one, stays plain, so that markers in an output are never ambiguous.

The parts of a text are not put together in memory.  Chunks of at most ``UNITS`` units and
``CHARS`` characters are emitted, keyed by row and by their position in the output;
``repartition`` by row and ``sortWithinPartitions`` by row and position (the DataFrame form of
``repartitionAndSortWithinPartitions``: one shuffle, sorted on disk where memory ends) bring them
back in order, and a task reads them as a stream into an incremental digest.  Restoration reads the
same stream: it finds the markers in the output, gives every piece its place in the original, and a
second sort within the partitions, without a shuffle, hands them in that order to a second digest.
What a task holds is a batch of chunks, however long a text is.

Rows are told apart by a number taken where the input is read, so equal rows are no group: give a
table as it is read or checkpointed, whose partitions come out alike when a task runs again.

Defined cases: a null text counts as empty; a null key counts as an empty string in the draws;
repeated rows are transformed row by row; an empty table gives no rows; other columns of the
input don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS, CHARS = 256, 4096
#: rows and bytes of a batch that a task hands on
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20
MARK = re.compile(rb"<[PSM]>")
PREFIX, MIDDLE, SUFFIX = b"<P>", b"<M>", b"<S>"
#: place of a part in the original, by its marker
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


@dataclass(frozen=True)
class Rates:
    """Percent of texts that are transformed, percent of these in suffix-prefix-middle form, seed."""
    fim: int = 50
    spm: int = 80
    seed: int = 42


def unit_ends(text: str) -> np.ndarray:
    """Positions (code points) after each unit."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    return np.append(ends, len(a)) if len(a) and blank[-1] else ends


def draws(key: str | None, seed: int) -> list[int]:
    h = hashlib.sha256(f"{seed}:{key or ''}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def plan(text: str, key: str | None, rates: Rates) -> tuple[np.ndarray, str, int, int]:
    """Unit ends, form, and the positions where the prefix and the middle end."""
    ends = unit_ends(text)
    n, (h1, h2, h3, h4) = len(ends), draws(key, rates.seed)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = lambda u: int(ends[u - 1]) if u else 0
    if not text or h3 % 100 >= rates.fim or any(m.decode() in text for m in PLACE):
        return ends, "plain", 0, 0
    return ends, "spm" if h4 % 100 < rates.spm else "psm", at(a), at(b)


def chunks(text: str, ends: np.ndarray, start: int, stop: int) -> Iterator[bytes]:
    """text[start:stop] in pieces of bounded size."""
    inner = ends[UNITS - 1::UNITS]
    bounds = [start, *inner[(inner > start) & (inner < stop)].tolist(), stop]
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b, CHARS):
            yield text[i:min(i + CHARS, b)].encode()


def pieces(text: str, ends: np.ndarray, form: str, a: int, b: int) -> Iterator[bytes]:
    """The output in order, piece by piece; at least one."""
    parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
    order = {"plain": [], "psm": [PREFIX, SUFFIX, MIDDLE], "spm": [SUFFIX, PREFIX, MIDDLE]}[form]
    if not order:
        yield b""
        yield from chunks(text, ends, 0, len(text))
    for mark in order:
        yield mark
        yield from chunks(text, ends, *parts[mark])


_NOTES = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()),
          ("sha", T.StringType())]


def _schema(key: T.DataType) -> T.StructType:
    """Pieces: row, place in the original, position, bytes; the first one of a row has its notes."""
    return T.StructType([T.StructField("row", T.LongType()), T.StructField("place", T.IntegerType()),
                         T.StructField("pos", T.LongType()), T.StructField("piece", T.BinaryType()),
                         T.StructField("key", key), *[T.StructField(n, t) for n, t in _NOTES]])


class _Out:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= BATCH_ROWS or self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _cut(schema: pa.Schema, rates: Rates) -> Callable:
    def run(batches):
        out = _Out(schema)
        for row, key, name, text in _records(batches):
            text = text or ""
            ends, form, a, b = plan(text, name, rates)
            notes = (key, len(ends), form, *((None, None) if form == "plain" else (a, b - a)), None)
            for pos, piece in enumerate(pieces(text, ends, form, a, b)):
                yield from out.add((row, 0, pos, piece, *(notes if pos == 0 else (None,) * 6)), len(piece))
        yield from out.flush()
    return run


class _Parser:
    """Splits a streamed output into its parts at the markers."""

    def __init__(self, form: str):
        self.marked, self.place, self.rest = form != "plain", 0, b""

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        if not self.marked:
            yield 0, piece
            return
        data = self.rest + piece
        # a marker may go on in the next piece
        hold = 0 if last else next((k for k in (2, 1) if data[-k:] in {m[:k] for m in PLACE}), 0)
        data, self.rest = data[:len(data) - hold], data[len(data) - hold:]
        at = 0
        for m in MARK.finditer(data):
            if m.start() > at:
                yield self.place, data[at:m.start()]
            self.place, at = PLACE[m.group()], m.end()
        if at < len(data):
            yield self.place, data[at:]


def _digest(schema: pa.Schema) -> Callable:
    """Pieces in output order: digest of the output; the pieces with their place in the original."""
    def run(batches):
        out, now = _Out(schema), None

        def close():
            for place, part in parser.feed(b"", last=True):
                yield from out.add((now, place, pos, part, *(None,) * 6), len(part))
            yield from out.add((now, -1, 0, b"", *notes, sha.hexdigest()))

        for row, _, _, piece, *note in _records(batches):
            if row != now:
                if now is not None:
                    yield from close()
                now, notes, sha, pos = row, note[:5], hashlib.sha256(), 0
                parser = _Parser(notes[2])
            sha.update(piece)
            for place, part in parser.feed(piece):
                yield from out.add((row, place, pos, part, *(None,) * 6), len(part))
                pos += 1
        if now is not None:
            yield from close()
        yield from out.flush()
    return run


def _restore(schema: pa.Schema) -> Callable:
    """Pieces in original order, each row's notes first: digest of the original."""
    def run(batches):
        out, now = _Out(schema), None
        for row, place, _, piece, *note in _records(batches):
            if row != now:
                if now is not None:
                    yield from out.add((*notes, sha.hexdigest()))
                now, notes, sha = row, note, hashlib.sha256()
            sha.update(piece)
        if now is not None:
            yield from out.add((*notes, sha.hexdigest()))
        yield from out.flush()
    return run


def _join(schema: pa.Schema) -> Callable:
    """Pieces in output order: the output as one text."""
    def run(batches):
        out, now = _Out(schema), None
        for row, _, _, piece, *note in _records(batches):
            if row != now:
                if now is not None:
                    text = b"".join(parts)
                    yield from out.add((*notes, text.decode()), len(text))
                now, notes, parts = row, note[:5], []
            parts.append(piece)
        if now is not None:
            yield from out.add((*notes, b"".join(parts).decode()))
        yield from out.flush()
    return run


def assembled(docs: DataFrame, rates: Rates = Rates(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all outputs, a row's together and in order; the first has its key and notes."""
    schema = _schema(docs.schema[key].dataType)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                       F.col(key).cast("string").alias("name"), F.col(text).alias("text"))
    return (rows.mapInArrow(_cut(_arrow(schema), rates), schema)
            .repartition("row").sortWithinPartitions("row", "pos"))


def _results(keys: T.StructType, last: list[str]) -> T.StructType:
    return T.StructType([keys["key"], *[keys[n] for n, _ in _NOTES[:4]], *[T.StructField(n, T.StringType()) for n in last]])


def transformed(docs: DataFrame, rates: Rates = Rates(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The outputs as whole texts (each must fit in memory; ``assembled`` has them in pieces)."""
    p = assembled(docs, rates, key, text)
    schema = _results(p.schema, ["output"])
    return p.mapInArrow(_join(_arrow(schema)), schema).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, rates: Rates = Rates(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of every output and of the text restored from it."""
    p = assembled(docs, rates, key, text)
    schema = _results(p.schema, ["output_sha256", "restored_sha256"])
    placed = p.mapInArrow(_digest(_arrow(p.schema)), p.schema).sortWithinPartitions("row", "place", "pos")
    return placed.mapInArrow(_restore(_arrow(schema)), schema).withColumnRenamed("key", key)
