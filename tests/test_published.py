"""Sorted sinks and published folders."""

import glob

import pytest
from pyspark.sql import functions as F

from panelcraft.session import work_dir
from panelcraft.sources import published
from panelcraft.sources.tables import read_table, write_sorted


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_rows_in_key_order_across_files(spark, fmt):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(700))).cast("int").alias("k"), F.col("id").alias("v")).repartition(7)
    path = write_sorted(df, work_dir(spark, "test-sorted") + "/t", ["k", "v"], fmt, partitions=5)
    files = sorted(glob.glob(path.removeprefix("file:") + "/part-*"))
    assert len(files) == 5
    rows = [tuple(r) for f in files for r in read_table(spark, f, "k int, v long", fmt).collect()]
    assert rows == sorted(rows) and len(rows) == 5000


def test_readers_see_the_old_version_until_the_switch(spark):
    root = work_dir(spark, "test-published")
    with pytest.raises(FileNotFoundError):
        published.current(spark, root)
    rows = lambda: spark.read.parquet(published.current(spark, root) + "/t").count()
    published.publish(spark, root, lambda p: spark.range(3).write.parquet(p + "/t"))
    assert rows() == 3

    def crash(path):
        spark.range(9).write.parquet(path + "/t")
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        published.publish(spark, root, crash)
    assert rows() == 3                                              # the half-made version isn't seen
    staged = published.current(spark, root).rsplit("/", 1)[0] + "/later"
    spark.range(5).write.parquet(staged + "/t")
    with pytest.raises(ValueError):
        published.switch(spark, root, "later")                      # nor can it be made current
    assert rows() == 3
    published.publish(spark, root, lambda p: spark.range(4).write.parquet(p + "/t"))
    assert rows() == 4


def test_a_version_with_a_lost_file_is_refused(spark):
    root = work_dir(spark, "test-published")
    first = published.publish(spark, root, lambda p: spark.range(3).write.parquet(p + "/t"))
    second = published.publish(spark, root, lambda p: spark.range(4).write.parquet(p + "/t"))
    hadoop, p, fs = published._hadoop(spark, first + "/t/_SUCCESS")
    fs.delete(p, False)
    with pytest.raises(ValueError):
        published.switch(spark, root, first.rsplit("/", 1)[1])
    assert published.current(spark, root) == second
