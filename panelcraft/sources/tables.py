"""Typed table scans, literal tables, CSV/Parquet sinks, resumable appends."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "csv") -> DataFrame:
    """Scan CSV (header row) or Parquet.  CSV should get a declared schema:
    inference costs an extra pass and re-types columns between runs."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """CSV (header, no index) or Parquet sink, optionally partitioned (e.g. by year)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet", mode: str = "overwrite",
                 partitions: int | None = None) -> str:
    """A sink whose rows are in order of the keys, within its files and from file to file: a range
    of keys for each file, sorted inside.  Equal keys stay in one file; ``partitions`` bounds the files."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return write_table(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), path, fmt, mode)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small reference table given inline (code lists, lookups): literals in the plan, so
    the optimizer knows its size, which a frame made of a driver's list hides."""
    fields = StructType.fromDDL(schema).fields
    literals = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields, strict=True)])
                for r in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def lookup_map(small: DataFrame, key: str, value: str | Column) -> Column:
    """A scalar subquery that holds ``small`` (one row per key, few keys) as a map, to be read
    with ``try_element_at``: no join, so no exchange of the large side on a few values."""
    entry = F.struct(F.col(key), (F.col(value) if isinstance(value, str) else value).alias("v"))
    return small.where(F.col(key).isNotNull()).agg(F.map_from_entries(F.collect_list(entry))).scalar()


def union_counts(a: DataFrame, b: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Set union of the key columns with the number of rows in the bag union: one grouping."""
    return (append_rows(a.select(*keys), b.select(*keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias(name)))


def explode_keyed_lists(df: DataFrame, map_col: str, keep: Sequence[str] = (),
                        key_name: str = "key", item_name: str = "item") -> DataFrame:
    """``map<k, array<v>>`` -> one (k, v) row per list element."""
    return (df.select(*keep, F.explode(map_col).alias(key_name, "_items"))
              .select(*keep, key_name, F.explode("_items").alias(item_name)))


def pending_keys(dim: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``dim`` that are not yet present in the sink ``done`` (anti join).

    "Done" is derived from committed sink rows, never from a separate progress
    file, so a crash between writing rows and recording progress cannot lose
    or duplicate a key.
    """
    return dim.join(done.select(*keys).distinct(), list(keys), "left_anti")


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union by column name (append)."""
    return existing.unionByName(new)


def union_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set union of the key columns."""
    return a.select(*keys).union(b.select(*keys)).distinct()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (works for any Hadoop URI)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_with_fallback(spark: SparkSession, path: str, schema: StructType,
                       fallback, fmt: str = "parquet") -> DataFrame:
    """Read ``path`` if it exists, else build the frame with ``fallback()``.

    Both branches are projected onto ``schema`` (names and types), so callers
    always see one schema whichever source was used.
    """
    df = read_table(spark, path, schema if fmt == "csv" else None, fmt) \
        if path_exists(spark, path) else fallback()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
