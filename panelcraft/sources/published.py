"""Publishing a folder so that readers see the old one or the new one, never a part.

A version is written to a staging folder of its own and checked off by a manifest in it that lists
its files; then one small file, which names the current version, is replaced in a single rename.  A
writer that ends before that leaves the old version current, and its staging folder unread.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

CURRENT, MANIFEST = "CURRENT", "MANIFEST.json"


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return hadoop, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    _, p, fs = _hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _get(spark: SparkSession, path: str) -> str | None:
    _, p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def files_of(spark: SparkSession, path: str) -> dict[str, int]:
    """Name below ``path`` and length of every file (but the manifest)."""
    _, p, fs = _hadoop(spark, path)
    root, out, found = fs.makeQualified(p).toString().rstrip("/") + "/", {}, fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString().removeprefix(root)
        if name != MANIFEST:
            out[name] = f.getLen()
    return out


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """``write(folder)`` fills a new version, which then becomes the current one; its folder."""
    version = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/versions/{version}"
    write(folder)
    _put(spark, f"{folder}/{MANIFEST}", json.dumps(files_of(spark, folder), sort_keys=True))
    switch(spark, root, version)
    return folder


def switch(spark: SparkSession, root: str, version: str) -> None:
    """Makes a complete version current, by one rename."""
    root = root.rstrip("/")
    folder = f"{root}/versions/{version}"
    listed = _get(spark, f"{folder}/{MANIFEST}")
    if listed is None or json.loads(listed) != files_of(spark, folder):
        raise ValueError(f"{folder} is not complete")
    _put(spark, f"{root}/{CURRENT}.{version}", version)
    hadoop, src, fs = _hadoop(spark, f"{root}/{CURRENT}.{version}")
    dst = hadoop.Path(f"{root}/{CURRENT}")
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(src), fs.makeQualified(dst), options)


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current version."""
    version = _get(spark, f"{root.rstrip('/')}/{CURRENT}")
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return f"{root.rstrip('/')}/versions/{version}"
