"""Incremental, resumable ingestion with Structured Streaming.

The reference downloads one payload per key, appends rows and records the
finished keys in a progress file.  Here payload files land in a folder; a file
stream picks up only files it has not seen (the checkpoint is the progress
record), cleans them and appends to a Parquet sink the rows whose keys it does not
hold yet.  A key whose whole date range arrives after other keys' loses nothing: no watermark
clears the keys that are known.  They are known in one of two ways:

* ``known="state"`` (default): a keyed state store (RocksDB, changes alone are uploaded) holds every key
  taken.  A batch looks up its own keys, so what it reads does not grow with the sink, and the file
  sink's log makes a re-run batch replace itself.  Progress is the checkpoint: it belongs to its sink.
* ``known="sink"``: the sink's own rows, read by buckets of a key hash.  It needs no state and survives a
  lost checkpoint, but each batch reads the keys of the buckets that it touches.

``availableNow`` processes everything present and stops, so the same job serves
batch catch-up and continuous running.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from panelcraft.sources.tables import path_exists


#: settings under which a stream with keyed state starts: keys on local disk instead of the heap
STATE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
#: partition column of the sinks: rows of a key are in one of a fixed number of buckets
BUCKET, BUCKETS = "key_bucket", 64


def start_ingest(spark: SparkSession, source: str, schema: StructType | str, sink: str,
                 checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                 keys: Sequence[str], event_time: str | None = None,
                 delay: str | None = None, fmt: str = "parquet", source_glob: str | None = None,
                 max_files: int | None = None, available_now: bool = True,
                 known: str = "state") -> StreamingQuery:
    """Start the stream ``source -> transform -> rows with new keys -> sink``.

    Every row whose ``keys`` were not taken before is appended; ``known`` says where the taken keys are
    looked up (see the module).  Of rows with equal keys in one batch, the state takes one, which the
    committed batch keeps; ``known="sink"`` takes the least by all columns.
    With ``event_time`` and ``delay`` repeats are found in a state bounded by a watermark
    instead, which DROPS rows that come later than ``delay`` after newer ones; it is only
    for sources in time order, so both must be given.
    """
    if (event_time is None) != (delay is None):
        raise ValueError("event_time and delay go together: rows later than delay are dropped")
    if known not in ("state", "sink"):
        raise ValueError(f"known is 'state' or 'sink', not {known!r}")
    r = spark.readStream.schema(schema).format(fmt)
    if source_glob:
        r = r.option("pathGlobFilter", source_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    rows = transform(r.load(source))
    if event_time:
        rows = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
        w = rows.writeStream.format("parquet").option("path", sink).outputMode("append")
    elif known == "state":
        w = rows.dropDuplicates(list(keys)).writeStream.format("parquet").option("path", sink).outputMode("append")
    else:
        w = rows.writeStream.foreachBatch(idempotent_append(sink, keys))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return _started(spark, w, STATE if known == "state" else {})


def _started(spark: SparkSession, writer, settings: dict[str, str]) -> StreamingQuery:
    """A query keeps the settings of its start; the session's own are put back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_ingest(spark: SparkSession, *args, **kw) -> DataFrame:
    """Run ``start_ingest`` to completion (availableNow) and return the sink."""
    q = start_ingest(spark, *args, **kw)
    q.awaitTermination()
    sink = args[2] if len(args) > 2 else kw["sink"]
    return read_sink(spark, sink)


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop(BUCKET)


def idempotent_append(sink: str, keys: Sequence[str]):
    """A ``foreachBatch`` writer that appends only rows whose keys the sink does
    not hold yet.

    "Done" is read from the sink's committed files, never from a side file, so a batch
    that is re-run after a failure adds nothing twice.  The sink is partitioned by a hash
    of the first key, and only the buckets that the batch touches are read.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # of equal keys the least row, so that a batch that is re-run takes the same one
        others = [c for c in batch.columns if c not in keys]
        least = batch.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least")) if others else batch.distinct()
        rows = least.select(*[c if c in keys else F.col("_least")[c].alias(c) for c in batch.columns]).withColumn(
            BUCKET, F.pmod(F.xxhash64(keys[0]), F.lit(BUCKETS)).cast("int"))
        rows.persist()                       # read for its buckets, and to be appended
        try:
            if path_exists(spark, sink):
                touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]   # <= BUCKETS
                held = (spark.read.schema(rows.schema).parquet(sink)
                        .where(F.col(BUCKET).isin(touched)).select(BUCKET, *keys))
                # null keys are equal to null keys, as in the batch's own grouping
                same = [rows[c].eqNullSafe(held[c]) for c in (BUCKET, *keys)]
                new = rows.join(held, same, "left_anti")
            else:
                new = rows
            new.write.mode("append").partitionBy(BUCKET).parquet(sink)
        finally:
            rows.unpersist()
    return write


def start_payload_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                         transform: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                         fmt: str = "text", schema: StructType | str = "value string",
                         max_files: int | None = None, known: str = "state") -> StreamingQuery:
    """Landed payload files -> ``transform`` (parse, flatten, clean) -> append of rows with new
    keys to a Parquet sink; runs what is present and stops (``availableNow``)."""
    return start_ingest(spark, landing, schema, sink, checkpoint, transform, keys, fmt=fmt,
                        max_files=max_files, known=known)
