"""Best-fit packing by minimum bin slack.

Only the histogram of piece lengths (at most ``capacity`` rows) decides which lengths share a
sequence.  For each sequence the longest length left is fixed, and a bitset subset-sum over
the lengths that are left finds the fullest feasible rest; the combination is then removed.
As the search depends on nothing else, it is removed as often as the counts allow, so
there are about as many searches as distinct lengths, however many documents.

Pieces are matched with places by their rank among the pieces of their length.  Ranks come
from counts per (length, shard of ids) and a window inside each, so that a length that a third of
all pieces have is still spread over many tasks.

Defined cases: a null text has no ids but the end id, like an empty one; ties in a length
are ranked by id and piece; repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelcraft.llm.memo import begin
from panelcraft.llm.word_ids import encoder
from panelcraft.session import shuffle_partitions, written

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document (ids, then the end id)."""
    end = np.array([end_id], dtype="<u2").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(encode(text.as_py()) + end, dtype="<u2").astype("<u4")
                i = doc_id.as_py()
                rows += [(i, k, k * capacity, len(p := ids[k * capacity:(k + 1) * capacity]), zlib.crc32(p.tobytes()))
                         for k in range(-(-len(ids) // capacity))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum of at most ``room``
    (longer lengths first among equals)."""
    bits, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            more = bits | (bits << (k * length)) & mask
            if more != bits:
                steps.append((length, k, bits))
                bits = more
            left -= k
            k *= 2
        if bits >> room:
            break
    total, used = bits.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= k * length
            used[length] = used.get(length, 0) + k
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(lengths of a sequence with their multiplicity, number of such sequences)."""
    left, out = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        use = fullest({x: n for x, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        use[longest] = use.get(longest, 0) + 1
        times = min(left[x] // n for x, n in use.items())
        for x, n in use.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
        out.append((use, times))
    return out


def places(plan_: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces of the length in a sequence, offset)
    sorted by length and rank; a row holds until the next one of its length."""
    rows, ranks, sequence = [], {}, 0
    for use, times in plan_:
        offset = 0
        for length in sorted(use, reverse=True):
            rows.append((length, ranks.get(length, 0), sequence, use[length], offset))
            ranks[length] = ranks.get(length, 0) + times * use[length]
            offset += use[length] * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces_`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``pieces_`` must be a table that reads alike each time (a written one): it is read
    for the histogram and again for the places.
    """
    spark = pieces_.sparkSession
    counts = {r["length"]: r["n"] for r in pieces_.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    table = places(plan(counts, capacity))      # at most a few rows for each distinct length
    shared = spark.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")                         # what the ids were made with is not needed any more
        t = shared.value
        big = np.int64(1) << 44                  # above any rank of a length
        keys = t[:, 0] * big + t[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            _, first, sequence, per, offset = t[np.searchsorted(keys, length * big + rank, side="right") - 1].T
            sequence = sequence + (rank - first) // per
            offset = offset + (rank - first) % per * length
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    shards = shuffle_partitions(spark)
    p = pieces_.withColumn("_shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    before = (p.groupBy("length", "_shard").agg(F.count("*").alias("n"))
              .select("length", "_shard", (F.sum("n").over(
                  Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1))).alias("_before")))
    local = F.row_number().over(Window.partitionBy("length", "_shard").orderBy("doc_id", "piece"))
    ranked = (p.withColumn("_local", local).join(before, ["length", "_shard"])
              .select(*[p[c] for c in pieces_.columns],
                      (F.coalesce("_before", F.lit(0)) + F.col("_local") - 1).cast("long").alias("_rank")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces_.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return pack(written(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
