"""Sources, sinks and the stream: typed round trips, fallback, resumable ingestion."""

import pytest
from pyspark.sql import functions as F

from panelcraft.session import work_dir
from panelcraft.sources import tables as tb
from panelcraft.sources.payload import daily_series_rows
from panelcraft.streaming.ingest import run_ingest

SF = "/root/testdata/sf0.001"


def test_fallback_reader_one_schema(spark):
    schema = spark.read.parquet(f"{SF}/region.parquet").schema
    missing = work_dir(spark, "absent") + "/t"
    df = tb.read_with_fallback(spark, missing, schema,
                               lambda: spark.read.parquet(f"{SF}/region.parquet"))
    assert df.schema == schema and df.count() == 5
    df2 = tb.read_with_fallback(spark, f"{SF}/region.parquet", schema, lambda: None)
    assert df2.count() == 5


def test_reference_payload_shape(spark):
    doc = '{"properties":{"parameter":{"PRECTOTCORR":{"20100101":1.5,"20100102":-999,"20100103":-0.2}}}}'
    df = spark.createDataFrame([("d1", doc)], "district string, payload string")
    got = {r["date"]: r["value"] for r in daily_series_rows(
        df, "payload", ["district"], ("properties", "parameter", "PRECTOTCORR")).collect()}
    assert got == {"20100101": 1.5, "20100102": 0.0, "20100103": 0.0}


def test_pending_keys_and_stream_resume(spark):
    """Second run of the stream over the same files adds nothing (checkpointed progress)."""
    base = work_dir(spark, "stream-test")
    src = f"{base}/landing"
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.where(F.col("event_id") < 100).write.parquet(f"{src}/part1")

    args = (spark, f"{src}/*", ev.schema, f"{base}/sink", f"{base}/ck", lambda df: df, ["event_id"])
    first = run_ingest(*args).count()
    ev.where(F.col("event_id") >= 100).write.parquet(f"{src}/part2")
    second = run_ingest(*args).count()
    third = run_ingest(*args).count()
    assert first == 100 and second == ev.count() and third == second
    done = spark.read.parquet(f"{base}/sink").select("event_id")
    pend = tb.pending_keys(ev.select("event_id"), done, ["event_id"])
    assert pend.count() == 0


@pytest.mark.parametrize("known", ["state", "sink"])
def test_repeats_in_later_files_add_nothing(spark, known):
    """Files that repeat earlier rows, within and between batches; the state's settings don't stay behind."""
    base = work_dir(spark, "repeats")
    args = (spark, f"{base}/landing/*", "k long, v string", f"{base}/sink", f"{base}/ck", lambda df: df, ["k"])
    row = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    row(0, 100, "a").unionByName(row(0, 50, "a")).write.parquet(f"{base}/landing/1")
    assert run_ingest(*args, known=known).count() == 100
    row(50, 200, "b").write.parquet(f"{base}/landing/2")
    got = {r["k"]: r["v"] for r in run_ingest(*args, known=known).collect()}
    assert got == {k: "a" if k < 100 else "b" for k in range(200)}
    assert run_ingest(*args, known=known).count() == 200
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_batch_with_known_keys_in_a_state_does_not_read_the_sink(spark):
    """What a later batch reads is its own files: the plan scans nothing else, the state holds all keys."""
    from panelcraft.streaming.ingest import start_ingest
    base = work_dir(spark, "state-reads")
    args = (spark, f"{base}/landing/*", "k long", f"{base}/sink", f"{base}/ck", lambda df: df, ["k"])
    for i, (lo, hi) in enumerate([(0, 5000), (4990, 5010)]):
        spark.range(lo, hi).select(F.col("id").alias("k")).write.parquet(f"{base}/landing/{i}")
        q = start_ingest(*args)
        q.awaitTermination()
    done = [p for p in q.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in done) == 20
    state = done[-1]["stateOperators"][0]
    assert (state["numRowsTotal"], state["numRowsUpdated"]) == (5010, 10)
    assert "RocksDB" in " ".join(state["customMetrics"]) or any(m.startswith("rocksdb") for m in state["customMetrics"])
    assert spark.read.parquet(f"{base}/sink").count() == 5010


def test_least_of_equal_keys_is_appended(spark):
    from panelcraft.streaming.ingest import idempotent_append, read_sink
    sink = work_dir(spark, "least") + "/sink"
    write = idempotent_append(sink, ["k"])
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, "a", 3), (None, "x", 1), (None, None, 1)], "k int, v string, n int")
    write(df, 0)
    write(df.repartition(5), 1)
    got = {(r["k"], r["v"], r["n"]) for r in read_sink(spark, sink).select("k", "v", "n").collect()}
    assert got == {(1, "a", 3), (None, None, 1)} and read_sink(spark, sink).count() == 2


def test_second_key_with_the_same_dates_loses_nothing(spark):
    """Key after key, each with the full date range: the later key's rows are all kept."""
    base = work_dir(spark, "two-keys")
    days = spark.sql("SELECT explode(sequence(DATE'2010-01-01', DATE'2011-12-31')) AS day")
    args = (spark, f"{base}/landing/*", "key string, day date", f"{base}/sink", f"{base}/ck", lambda df: df, ["key", "day"])
    days.select(F.lit("A").alias("key"), "day").write.parquet(f"{base}/landing/a")
    run_ingest(*args)
    days.select(F.lit("B").alias("key"), "day").write.parquet(f"{base}/landing/b")
    got = {r["key"]: r["n"] for r in run_ingest(*args).groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert got == {"A": 730, "B": 730}


def test_watermark_needs_a_stated_delay(spark):
    with pytest.raises(ValueError):
        run_ingest(spark, "/x", "k int", "/y", "/z", lambda df: df, ["k"], event_time="ts")


def test_shared_folder(spark):
    from panelcraft.session import checkpoint_root, written
    assert work_dir(spark, "x").startswith(checkpoint_root(spark).rstrip("/"))
    assert work_dir(spark, "x") != work_dir(spark, "x")
    df = spark.createDataFrame([(1, None)], "a int not null, b string")
    assert written(df, "x").collect() == df.collect()


def test_idempotent_append_survives_batch_retry(spark):
    from panelcraft.streaming.ingest import idempotent_append
    sink = work_dir(spark, "idem") + "/sink"
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", "value", F.lit(2024).alias("year"))
    write = idempotent_append(sink, ["event_id"])
    write(ev.where("event_id < 50"), 0)
    write(ev.where("event_id < 50"), 0)           # the same batch again (a retry)
    write(ev.where("event_id < 80"), 1)           # overlaps the first batch
    got = spark.read.parquet(sink)
    assert got.count() == 80 and got.select("event_id").distinct().count() == 80


def test_shuffle_partition_sizing(spark):
    from panelcraft.session import input_bytes, size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert input_bytes(spark, [f"{SF}/lineitem.parquet"]) > 0
        assert size_shuffle_partitions(spark, [f"{SF}/lineitem.parquet"]) == 8     # tiny input
        assert size_shuffle_partitions(spark, [f"{SF}/lineitem.parquet"], target_bytes=1024) > 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
