"""Token files: a static range asymmetric numeral system over shared frequencies.

Every id's frequency in the whole table, scaled to a sum of 2**``SCALE``, is the one table
that all blocks share and that is stored with them.  Documents are in ascending id order:
shard by shard (ranges of ids), block by block inside a shard.  A block holds whole documents
of about ``BLOCK`` ids (a longer one alone) and depends on no other block.

Inside a block ``LANES`` coders take turns (id i belongs to lane i mod LANES) and share one
stream of 32-bit words.  A checkpoint every ``SPAN`` rounds holds all lane states and the place in
the stream, so that each span can be decoded on its own; the first one starts the block.
CRC-32 sums guard the stream and the ids.

A block's payload, little-endian: ``HEADER`` (magic, version, scale, lanes, rounds
between checkpoints, ids, checkpoints, words, sum of the ids as unsigned 32-bit integers, sum of
what follows), then for each checkpoint its place (unsigned 32-bit), the checkpoints' states
(unsigned 64-bit, LANES each), the words.  Files are Parquet rows, as executors share
no other kind of file: ``blocks`` (shard, block, start, n_tokens, doc_ids, lengths, payload)
and ``table`` (id, frequency).

Defined cases: null texts are empty, and have the end id alone; rows of one id are ordered by
length and content; a null id comes first; an empty table gives no blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelcraft.llm.memo import begin
from panelcraft.llm.word_ids import encoder
from panelcraft.session import dropped, shuffle_partitions, work_dir

SCALE, LANES, SPAN, BLOCK = 20, 4096, 64, 1 << 20
LOW = np.uint64(1 << 31)                     # states are from LOW to LOW << 32
HEADER = struct.Struct("<4sBBIIQIIII")
MAGIC, VERSION = b"rANS", 1
END_ID = 2


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2**scale, at least 1 for every id that occurs."""
    seen = counts > 0
    total, size = int(counts.sum()), 1 << scale
    if int(seen.sum()) > size:
        raise ValueError("more ids than frequencies")
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    freq = np.where(seen, np.maximum(1, counts.astype(object) * size // total), 0).astype(np.int64)
    order = np.lexsort((np.arange(len(freq)), -freq))
    gap = size - int(freq.sum())
    if gap > 0:
        freq[order[0]] += gap
    for i in order:                           # ids held at 1 are paid for by the most frequent
        if gap >= 0:
            break
        take = min(int(freq[i]) - max(1, int(freq[i]) // 2), -gap)
        freq[i] -= take
        gap += take
    return freq


class Coder:
    """Encodes and decodes blocks by one table of frequencies."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.freq = freq.astype(np.uint64)
        self.first = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, span: int = SPAN) -> bytes:
        rounds = -(-len(ids) // lanes)
        x = np.full(lanes, LOW, dtype=np.uint64)
        index = ids.astype(np.intp)
        freq, first = self.freq[index], self.first[index]
        if len(ids) and not freq.all():
            raise ValueError("an id without a frequency")
        limit = freq << np.uint64(63 - int(self.scale))
        out: list[np.ndarray] = []
        spans: list[tuple[int, np.ndarray]] = []      # words of later rounds, states
        words = 0
        for r in range(rounds - 1, -1, -1):
            a, b = r * lanes, min((r + 1) * lanes, len(ids))
            y = x[:b - a]
            full = y >= limit[a:b]
            if full.any():
                out.append((w := y[full]).astype(np.uint32))
                words += len(w)
                y[full] = w >> np.uint64(32)
            q = y // freq[a:b]
            y += first[a:b] - q * freq[a:b]
            y += q << self.scale                       # (q << scale) + (y mod freq) + first
            if r % span == 0:
                spans.append((words, x.copy()))
        stream = np.concatenate([*out[::-1], np.empty(0, np.uint32)]).astype("<u4").tobytes()
        spans.reverse()
        body = (np.array([words - w for w, _ in spans], dtype="<u4").tobytes()
                + b"".join(s.astype("<u8").tobytes() for _, s in spans) + stream)
        head = HEADER.pack(MAGIC, VERSION, int(self.scale), lanes, span, len(ids), len(spans), words,
                           zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body))
        return head + body

    def decode(self, payload: bytes, only: int | None = None) -> np.ndarray:
        """The ids of a block, or of one span of it."""
        magic, version, scale, lanes, span, n, n_spans, n_words, sum_ids, sum_body = HEADER.unpack_from(payload)
        body = memoryview(payload)[HEADER.size:]
        if magic != MAGIC or version != VERSION or scale != int(self.scale) or zlib.crc32(body) != sum_body:
            raise ValueError("a damaged block, or one of another table")
        at = np.frombuffer(body, "<u4", n_spans)
        states = np.frombuffer(body, "<u8", n_spans * lanes, 4 * n_spans).reshape(n_spans, lanes)
        words = np.frombuffer(body, "<u4", n_words, 4 * n_spans + 8 * n_spans * lanes)
        ids = np.empty(n, dtype=self.symbol.dtype)
        for s in range(n_spans) if only is None else (only,):
            self._span(ids[s * span * lanes:(s + 1) * span * lanes], states[s].astype(np.uint64), words[at[s]:])
        if only is not None:
            return ids[only * span * lanes:(only + 1) * span * lanes]
        if zlib.crc32(ids.astype("<u4").tobytes()) != sum_ids:
            raise ValueError("a block's ids differ from their checksum")
        return ids

    def _span(self, ids: np.ndarray, x: np.ndarray, words: np.ndarray) -> None:
        lanes, mask, at = len(x), np.uint64((1 << int(self.scale)) - 1), 0
        for a in range(0, len(ids), lanes):
            out = ids[a:a + lanes]
            y = x[:len(out)]
            slot = y & mask
            sym = self.symbol[slot]
            out[:] = sym
            y >>= self.scale
            y *= self.freq[sym]
            y += slot - self.first[sym]
            low = y < LOW
            n = np.count_nonzero(low)
            if n:
                y[low] = (y[low] << np.uint64(32)) | words[at:at + n]
                at += n


def token_table(docs: DataFrame, tokenizer: str, vocab: int, end_id: int = END_ID) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_tokens, ids): little-endian 16-bit ids, the end id included; and the scaled frequencies of
    all ids.  Each task counts the ids that it writes, in the same pass, and writes the counts beside them; at most
    ``vocab`` sums reach the driver."""
    end = np.array([end_id], dtype="<u2").tobytes()
    names = ["doc_id", "n_tokens", "ids", "counts"]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = encoder(tokenizer).encode, np.zeros(vocab, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                ids = [encode(text.as_py()) + end for text in part.column(1)]
                total += np.bincount(np.frombuffer(b"".join(ids), dtype="<u2"), minlength=vocab)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(b) // 2 for b in ids], pa.int64()), pa.array(ids, pa.binary()),
                                                  pa.nulls(len(ids), pa.binary())], names=names)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, dtype=np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_py(), "<i8")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "tokens") + "/t"
    kinds = "doc_id long, n_tokens long, ids binary, counts binary"
    (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenise, kinds).write.option("compression", "zstd").parquet(path))
    both = spark.read.schema(kinds).parquet(path)
    counts = np.zeros(vocab, dtype=np.int64)
    for r in both.where("counts is not null").select("counts").mapInArrow(unpack, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return both.where("counts is null").drop("counts"), scaled(counts)


BLOCKS = "shard int, block int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"


def write_blocks(tokens: DataFrame, freq: np.ndarray, path: str, block: int = BLOCK) -> None:
    """Write ``blocks`` and ``table`` below ``path``; ``start``: ids before, in the shard."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(freq)          # one entry for each id of the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("token files")                 # what the ids were made with is not needed any more
        coder, shard = Coder(shared.value), TaskContext.get().partitionId()
        held: list[tuple[int | None, np.ndarray]] = []
        number = start = size = 0

        def close() -> pa.RecordBatch:
            payload = coder.encode(np.concatenate([x for _, x in held]))
            cols = [shard], [number], [start], [size], [[i for i, _ in held]], [[len(x) for _, x in held]], [payload]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                              names=[f.split()[0] for f in BLOCKS.split(", ")])

        for batch in batches:
            for i, packed in zip(*batch.columns, strict=True):
                ids = np.frombuffer(packed.as_py(), dtype="<u2")
                held.append((i.as_py(), ids))
                size += len(ids)
                if size >= block:
                    yield close()
                    number, start, size, held = number + 1, start + size, 0, []
        if held:
            yield close()

    (tokens.repartitionByRange(shuffle_partitions(spark), "doc_id")
     .sortWithinPartitions("doc_id", "n_tokens", "ids").select("doc_id", "ids")
     .mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks"))
    seen = np.flatnonzero(freq)
    table = pa.table({"id": seen, "frequency": freq[seen]})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/table")


def read_blocks(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    freq = np.zeros(vocab, dtype=np.int64)
    for r in spark.read.parquet(f"{path}/table").collect():   # at most vocab rows
        freq[r["id"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for shard, start, doc_ids, lengths, payload in zip(*batch.columns, strict=True):
                ids = coder.decode(payload.as_py()).astype("<u4")
                n = np.array(lengths.as_py(), dtype=np.int64)
                ends = np.cumsum(n)
                sums = [zlib.crc32(ids[e - k:e].tobytes()) for e, k in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * len(n), pa.int32()), pa.array(doc_ids.as_py(), pa.int64()),
                     pa.array(ends - n + start.as_py()), pa.array(n), pa.array(sums, pa.int64())],
                    names=["shard", "doc_id", "_start", "n_tokens", "ids_crc32"])

    docs = (blocks.select("shard", "start", "doc_ids", "lengths", "payload")
            .mapInArrow(decode, "shard int, doc_id long, _start long, n_tokens long, ids_crc32 long"))
    # one row for each shard, of which there are no more than shuffle partitions
    before = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return docs.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("_before") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str, vocab: int, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all documents as token files in the shared folder, and read them back."""
    spark = docs.sparkSession
    tokens, freq = token_table(docs, tokenizer, vocab, end_id)
    path = work_dir(spark, "token-files")
    write_blocks(tokens, freq, path)
    dropped(tokens)
    return read_blocks(spark, path, vocab)
