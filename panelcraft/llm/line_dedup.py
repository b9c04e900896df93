"""Substring dedup by hashes of lines and of pieces of the sentences inside them.

A text's units are its lines, cut after sentence ends, and sentences of ``LONG`` words or more
once more before each word whose hash is least among the ``SIDE`` words on either side in the
sentence: such cuts move with the text, so a passage that was pasted inside a sentence has whole
units in common with its source.  Each unit is normalised (case folded, white space collapsed)
and hashed to 96 bits.  Digests are grouped over the whole corpus; of equal units the earliest
in the order (doc_id, content, position) stays.  A later one is removed if the run of later units
around it has at least ``MIN_WORDS`` words: a repeated passage goes as a whole, while a
short sentence that other documents happen to have stays.  With ``whole_lines`` (the queries) every
later one of equal whole lines goes as well, however short.
Words are parted by blanks; in scripts without them every character counts as one.
Spans are code point offsets into the original text.

A first pass counts the first 64 bits of every digest, in plain columns that are summed up before they
are shuffled; those that occur twice set a bit in a map of fixed size (``BITS``).  Only units whose bit is
set, that is, repeated ones and few others, are then shuffled with their documents, grouped by the
whole digest and joined to the first document that has it.  Digests of which there are many are resolved by
broadcast (there can be few such), all others by shuffle.  A unit that repeats one of its own text is a
later one in any case, and known without a shuffle.  The texts travel once, to meet their spans.
What a task holds of a text are some arrays of its length (up to 50 bytes a code point).

Defined cases: units without a word are never removed; null texts have no units and stay null;
empty texts stay empty; equal rows (id and text) count as one document and have the same
outcome; a null id comes first; an empty table gives no rows; columns beside doc_id and
text pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.llm.common import keyed_join, unused
from panelcraft.llm.memo import begin
from panelcraft.operators.ordered import ordered_row_number
from panelcraft.session import dropped, written

MIN_WORDS, LONG, SIDE = 20, 8, 3
#: size of the map of repeated digests, and of the parts it is made in
BITS, PART = 1 << 27, 1 << 20
#: what a digest stands for: a unit, a whole line, or both
AS_UNIT, AS_LINE = 1, 2
#: a sentence with what parts it from the next: up to a line end, to blanks after a sentence end, or to a full-width one
UNIT = re.compile(r"(?:[^.!?。！？｡\n]++|[.!?]++(?![ \t]))*+(?:[.!?]+[ \t]+|[。！？｡]+[ \t]*|\n|\Z)")
#: scripts that part no words
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF),
            (0x20000, 0x3FFFF)]
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_LONGEST = 1 << 12
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_LONGEST, 0x9E3779B97F4A7C15, dtype=np.uint64))


@cache
def _kinds() -> np.ndarray:
    """For each code point: 0 white space, 2 a word by itself, 1 any other."""
    kinds = np.ones(0x110000, dtype=np.uint8)
    kinds[[c for c in range(0x3100) if chr(c).isspace()]] = 0
    for a, b in UNSPACED:
        kinds[a:b + 1] = np.where(kinds[a:b + 1], 2, 0)
    return kinds


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start, the code points and their kinds."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[points]
    before = np.concatenate([[np.uint8(0)], kinds[:-1]])
    return np.flatnonzero((kinds > 0) & ((before != 1) | (kinds == 2))), points, kinds


_UNSPACED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED) + "]")


def n_words(content: str) -> int:
    """How many words a normalised content has."""
    return content.count(" ") + 1 if not _UNSPACED.search(content) else len(_words(content)[0])


def _cuts(text: str, folded: str, starts: np.ndarray) -> np.ndarray:
    """Where sentences (which begin at ``starts``) are cut by their content."""
    at, points, kinds = _words(folded)
    first = at if len(folded) == len(text) else _words(text)[0]
    if len(first) < LONG:
        return first[:0]
    if len(at) != len(first):
        at, points, kinds = _words(text)
    points, kinds, at = points[at[0]:], kinds[at[0]:], at - at[0]
    place = np.arange(len(points)) - np.repeat(at, np.diff(at, append=len(points))) & _LONGEST - 1
    h = np.add.reduceat(np.where(kinds > 0, _POWERS[place] * (points.astype(np.uint64) + np.uint64(1)), np.uint64(0)), at)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    of = np.searchsorted(starts, first, "right")
    least = np.bincount(of, minlength=len(starts) + 1)[of] >= LONG
    least[0], least[1:] = False, least[1:] & (of[1:] == of[:-1])
    for d in range(1, min(SIDE, len(h) - 1) + 1):
        apart = of[d:] != of[:-d]
        least[d:] &= apart | (h[d:] <= h[:-d])
        least[:-d] &= apart | (h[:-d] <= h[d:])
    return first[least]


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised content) of all units of a text, which they cover."""
    starts = [m.start() for m in UNIT.finditer(text) if m.end() > m.start()]
    if not starts:
        return []
    folded = text.casefold()
    edges = sorted([*starts, *_cuts(text, folded, np.array(starts)).tolist(), len(text)])
    if len(folded) == len(text):
        return [(a, b, " ".join(folded[a:b].split())) for a, b in zip(edges, edges[1:])]
    return [(a, b, " ".join(text[a:b].casefold().split())) for a, b in zip(edges, edges[1:])]


def lines(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(first, last) units of each line."""
    out, a = [], 0
    for k, (_, end, _) in enumerate(found):
        if k == len(found) - 1 or text[end - 1] == "\n":
            out.append((a, k))
            a = k + 1
    return out


def repeated_spans(ends: np.ndarray, sizes: np.ndarray, later: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """The spans of runs of later units with enough words, and of later lines.  ``ends`` of all units, ``sizes``: twice
    the words of each, plus one if it ends its line; ``later``: places, as ``_marks`` numbers them."""
    last = np.flatnonzero(sizes & 1)
    words, marks, whole = sizes >> 1, np.zeros(len(ends), dtype=bool), np.zeros(len(ends), dtype=bool)
    marks[later[later % 2 == 0] // 2] = True
    begun = later[later % 2 == 1] // 2
    for a, b in zip(begun.tolist(), last[np.searchsorted(last, begun)].tolist() if len(begun) else []):
        whole[a:b + 1] = True
    marks |= whole
    joins = marks | (words == 0)                       # blank units join runs
    spans, start, i, n = [], np.concatenate([[0], ends[:-1]]), 0, len(ends)
    breaks, at = np.append(np.flatnonzero(~joins), n), np.flatnonzero(marks)
    filled = np.flatnonzero(words > 0)
    total = np.concatenate([[0], np.cumsum(words)])
    while (k := np.searchsorted(at, i)) < len(at):
        i = int(at[k])
        stop = int(breaks[np.searchsorted(breaks, i)])
        f = np.searchsorted(filled, stop) - 1          # the run's last unit with a word
        end = max(i, int(filled[f])) if f >= 0 else i
        if total[stop] - total[i] >= min_words:
            spans.append((int(start[i]), int(ends[end])))
        else:
            for u in range(i, end + 1):
                if whole[u]:
                    joined = spans and spans[-1][1] == start[u]
                    spans.append((spans.pop()[0] if joined else int(start[u]), int(ends[u])))
        i = end + 1
    return spans


def _marks(text: str, whole_lines: bool) -> tuple[list[int], list[int], list[bytes], list[int], list[int], list[int]]:
    """Of the contents of a text (units, and whole lines): the place of the first that has it, its kinds and
    digest; and the places of all others.  A place is twice a unit's number, plus one for the line it begins.
    Also the ends and sizes of all units (see ``repeated_spans``)."""
    found, alone = units(text), set()
    units_seen, lines_seen = set(), set()
    places, kinds, digests, own = [], [], [], []
    count = n_words if _UNSPACED.search(text) else lambda c: c.count(" ") + 1
    sizes = [2 * count(c) if c else 0 for _, _, c in found]
    for a, b in lines(text, found):
        sizes[b] += 1
        if not whole_lines:
            continue
        if a == b:
            alone.add(a)                                    # a unit that is a line
            continue
        content = " ".join(c for _, _, c in found[a:b + 1] if c)
        if content in lines_seen:
            own.append(2 * a + 1)
        elif content:
            lines_seen.add(content)
            places.append(2 * a + 1)
            kinds.append(AS_LINE)
            digests.append(xxhash.xxh3_128_digest(content))
    for k, (_, _, content) in enumerate(found):
        if not content:
            continue
        kind = 0
        if content in units_seen:
            own.append(2 * k)
        else:
            units_seen.add(content)
            kind = AS_UNIT
        if k in alone:
            if content in lines_seen:
                own.append(2 * k + 1)
            else:
                lines_seen.add(content)
                kind |= AS_LINE
        if kind:
            places.append(2 * k)
            kinds.append(kind)
            digests.append(xxhash.xxh3_128_digest(content))
    return places, kinds, digests, own, [end for _, end, _ in found], sizes


def _digests(docs: DataFrame, whole_lines: bool) -> DataFrame:
    """A row for each text with a word: digests (h, g) of its contents with their kinds and places (see
    ``_marks``), its own repeats, the ends and sizes of its units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("line_dedup")
        for batch in batches:
            for i, t, value in zip(*batch.columns, strict=True):
                places, kinds, digests, own, ends, sizes = _marks(value.as_py() or "", whole_lines)
                if not places:
                    continue
                d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                lists = [pa.array(d[:, 0]), pa.array(d[:, 1].astype(np.int32)), pa.array(kinds, pa.int8()), pa.array(places, pa.int32()),
                         pa.array(own, pa.int32()), pa.array(ends, pa.int32()), pa.array(sizes, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(i, 1), pa.repeat(t, 1), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]],
                    names=["doc_id", "t", "h", "g", "kind", "at", "own", "ends", "sizes"])

    return docs.mapInArrow(run, "doc_id long, t int, h array<long>, g array<int>, kind array<tinyint>, at array<int>, own array<int>, "
                                "ends array<int>, sizes array<int>")


def _ranked(digests: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The digests with the ``rank`` of their document, and (rank, doc_id, t) where the rank isn't the id itself:
    if an id is null, or has several texts."""
    ids = digests.select("doc_id", "t").distinct()
    n = ids.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if n["n"] == n["ids"]:
        return digests.withColumnRenamed("doc_id", "rank").drop("t"), None
    names = written(ordered_row_number(ids, ["doc_id", "t"], (), "rank"), "ranks")
    same = digests["doc_id"].eqNullSafe(names["doc_id"]) & (digests["t"] == names["t"])
    return digests.join(names, same).drop("doc_id", "t"), names


def repeated_map(digests: DataFrame) -> np.ndarray:
    """Bits, as bytes, of which those of all first halves that occur twice or more are set."""
    counts = digests.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    slot = F.col("h").bitwiseAND(F.lit(BITS - 1))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = (np.asarray(c) for c in batch.columns)
            for p in np.unique(part):
                bits = parts.setdefault(int(p), np.zeros(PART, dtype=bool))
                bits[at[part == p]] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in parts.values()], pa.binary())],
                                         names=["part", "bits"])

    spread = counts.select(F.floor(slot / PART).cast("int").alias("part"), (slot % PART).cast("int").alias("at")).repartition("part")
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for r in spread.mapInArrow(fill, "part int, bits binary").collect():       # BITS / 8 bytes in all
        a = r["part"] * PART // 8
        bits[a:a + PART // 8] |= np.frombuffer(r["bits"], np.uint8)
    return bits


def _perhaps_repeated(digests: DataFrame, bits: np.ndarray) -> DataFrame:
    """A row (h, g, rank, at, kind) for each content whose bit is set."""
    shared = digests.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            h, g, kind, at = (batch.column(c).flatten().to_numpy() for c in ("h", "g", "kind", "at"))
            rank = np.repeat(batch.column("rank").to_numpy(), np.diff(batch.column("h").offsets.to_numpy()))
            slot = h & (BITS - 1)
            on = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (h, g, rank, at, kind)], names=["h", "g", "rank", "at", "kind"])

    return digests.select("rank", "h", "g", "kind", "at").mapInArrow(run, "h long, g int, rank long, at int, kind tinyint")


def spans_of_repeats(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = False) -> DataFrame:
    """(doc_id, t, spans): what is removed from each text that loses something; ``t`` is null where the id alone
    names the text."""
    d = docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("t"), "text")
    raw = written(_digests(d, whole_lines), "unit-digests")
    digests, names = _ranked(raw)
    few = written(_perhaps_repeated(digests, repeated_map(digests)), "repeated-digests")
    is_unit, is_line = (F.col("kind").bitwiseAND(F.lit(k).cast("tinyint")) > 0 for k in (AS_UNIT, AS_LINE))
    first = written(few.groupBy("h", "g").agg(F.min(F.when(is_unit, F.col("rank"))).alias("unit"), F.min(F.when(is_line, F.col("rank"))).alias("line"),
                                              F.count("*").alias("n")).filter("n > 1")
                    .select(F.struct("h", "g").alias("key"), "unit", "line", "n"), "first-documents")    # joined in two parts, hot and other
    met = keyed_join(few.withColumn("key", F.struct("h", "g")).drop("h", "g"), first, "key", few.count())
    at = F.filter(F.array(F.when(is_unit & (F.col("rank") > F.col("unit")), F.col("at")),
                          F.when(is_line & (F.col("rank") > F.col("line")), F.col("at").bitwiseOR(F.lit(1)))), lambda x: x.isNotNull())
    every = met.select("rank", F.explode(at).alias("at")).unionByName(digests.select("rank", F.explode("own").alias("at")))
    later = every.groupBy("rank").agg(F.sort_array(F.collect_set("at")).alias("later"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("line_dedup")
        for batch in batches:
            ends, sizes, at = ([np.asarray(x) for x in _pieces(batch.column(c))] for c in ("ends", "sizes", "later"))
            cuts = [repeated_spans(*x, min_words) for x in zip(ends, sizes, at, strict=True)]
            some = [k for k, c in enumerate(cuts) if c]
            yield pa.RecordBatch.from_arrays([batch.column("rank").take(pa.array(some, pa.int64())),
                                              pa.array([[{"start": a, "end": b} for a, b in cuts[k]] for k in some], _SPANS)], names=["rank", "spans"])

    found = written(later.join(digests.select("rank", "ends", "sizes").dropDuplicates(["rank"]) if names is not None or _several(digests)
                               else digests.select("rank", "ends", "sizes"), "rank")
                    .mapInArrow(run, "rank long, spans array<struct<start:int,end:int>>"), "repeated-spans")
    for done in (raw, few, first):
        dropped(done)
    if names is None:
        return found.select(F.col("rank").alias("doc_id"), F.lit(None).cast("int").alias("t"), "spans")
    return found.join(names, "rank").select("doc_id", "t", "spans")


def _pieces(lists: pa.ListArray) -> Iterator[np.ndarray]:
    values, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    at = at - at[0]
    return (values[a:b] for a, b in zip(at, at[1:]))


def _several(digests: DataFrame) -> bool:
    """Whether a text (a rank) stands in several rows."""
    n = digests.agg(F.count("*").alias("n"), F.count_distinct("rank").alias("ranks")).first()
    return n["n"] != n["ranks"]


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "kept_text",
                    spans: str = "removed", whole_lines: bool = False) -> DataFrame:
    """``docs`` with two more columns: the text that stays, and the removed spans of the original."""
    found = spans_of_repeats(docs, min_words, whole_lines)
    cut = unused([*docs.columns, text, spans], "_spans")
    same = docs["doc_id"].cast("long").eqNullSafe(found["doc_id"]) & (F.hash(docs["text"]) == F.coalesce(found["t"], F.hash(docs["text"])))
    met = (docs.join(found, same, "left")
           .select(*[docs[c] for c in docs.columns], found["spans"].alias(cut)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("line_dedup")
        for batch in batches:
            texts, cuts = [], []
            for value, gone in zip(batch.column("text"), batch.column(cut), strict=True):
                whole, removed = value.as_py(), []
                if gone.is_valid:
                    removed = gone.as_py()
                    edges = [0, *(x for g in removed for x in (g["start"], g["end"])), len(whole)]
                    whole = "".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                texts.append(whole)
                cuts.append(removed)
            own = [c for c in batch.schema.names if c != cut]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(texts, pa.string()), pa.array(cuts, _SPANS)],
                                             names=[*own, text, spans])

    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType()), T.StructField(
        spans, T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    return met.mapInArrow(run, schema)


def report(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = False) -> DataFrame:
    """(doc_id, text that stays, removed spans, their number and code points) of every document."""
    r = without_repeats(docs.select("doc_id", "text"), min_words, whole_lines=whole_lines)
    return r.select("doc_id", F.col("kept_text").alias("text"), "removed", F.size("removed").alias("n_spans"),
                    F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"))


def strip(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = False) -> DataFrame:
    """``docs`` with its own columns, ``text`` (and ``n_chars``, if there) of what stays."""
    kept = unused(docs.columns, "_kept")
    r = without_repeats(docs, min_words, kept, unused([*docs.columns, kept], "_removed"), whole_lines)
    new = {"text": F.col(kept), "n_chars": F.length(kept)}
    return r.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
