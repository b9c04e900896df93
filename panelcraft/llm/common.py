"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.session import written

#: words are runs of anything but ASCII white space
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a lambda variable, so it is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of a text (null text: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def code_points(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("long")


def keyed_join(big: DataFrame, small: DataFrame, key: str, total: int, heavy: int = 1024) -> DataFrame:
    """Inner join on ``key`` where one key may hold a large part of ``big``.

    ``small`` has one row for each key, and in ``n`` how many rows of ``big`` have it; ``total``
    is the number of rows of ``big``.  Fewer than ``heavy`` keys can hold more than one in
    ``heavy`` of the rows: these are joined by broadcast, the others by shuffle.
    """
    hot = written(small.filter(F.col("n") * heavy > total).drop("n"), "hot-keys")
    if hot.isEmpty():
        return big.join(small.drop("n"), key)
    cold = small.filter(F.col("n") * heavy <= total).drop("n")
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return big.join(F.broadcast(hot), key).unionByName(rest)


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_sample(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the least hashes of ``column`` (all, if there are no more).

    Only rows whose hash is below a bound that about ``1.2 * rows`` of them keep are put in order,
    so what is gathered doesn't grow with the table."""
    n, h = df.count(), F.xxhash64(column)
    if n > rows:
        df = df.filter(h < F.lit(int(min(1.0, (1.2 * rows + 200) / n) * (1 << 64)) - (1 << 63) - 1))
    return df.orderBy(h, column).limit(rows)
