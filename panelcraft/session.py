"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of slices no longer referenced are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "panelcraft",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (a URI is kept as it is).

    Every checkpoint and every written table of the library goes through here.  A
    session without that setting is an error, since executors on other machines would
    each write to their own disk; only a ``local[...]`` master, where there is one
    machine, gets a folder of its own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        base = tempfile.mkdtemp(prefix="panelcraft-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder: for a frame with several consumers."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root, removed when the application ends."""
    path = "/".join([checkpoint_root(spark).rstrip("/"), "panelcraft", name, uuid.uuid4().hex])
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (cuts the lineage,
    and keeps column pruning, which a checkpoint does not)."""
    path = work_dir(df.sparkSession, name) + "/t"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more (its successor is written)."""
    root = "/".join([checkpoint_root(df.sparkSession).rstrip("/"), "panelcraft"])
    for folder in {f.rsplit("/t/", 1)[0] for f in df.inputFiles()}:
        if "/panelcraft/" not in folder:
            raise ValueError(f"{folder} is not below {root}")
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the given inputs, read from the (cluster) file system."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = 256 << 20, lo: int = 8) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about one partition per ``target_bytes``
    of input (at least ``lo``).  AQE coalesces partitions that come out small,
    so erring high is cheap, while too few partitions would spill at 100 TB."""
    n = max(lo, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes // 2))
    return n
