"""Publishing of a set of tables in one step (SNK3).

A run writes its tables into a fresh folder below ``root/versions``, checks them, and then replaces the file
``root/CURRENT``, which names the folder that readers see, by one atomic rename. A run that is killed at any
time before leaves the last good version as it was; its own folder is never seen and is removed by a later
``prune``. Old versions stay until then, so readers that opened them can finish.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


class Store:
    """The few file operations that publishing needs, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.files = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.files.exists(self.path(name)):
            return None
        stream = self.files.open(self.path(name))
        try:
            return str(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside the file, then rename over it: readers see the old text or the new."""
        fresh = self.path(f".{name}.{uuid.uuid4().hex}")
        stream = self.files.create(fresh, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = SparkContext._gateway.new_array(kind, 1)
        overwrite[0] = kind.OVERWRITE
        context.rename(self.files.makeQualified(fresh), self.files.makeQualified(self.path(name)), overwrite)

    def folders(self, name: str) -> list[str]:
        if not self.files.exists(self.path(name)):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(self.path(name)) if s.isDirectory())

    def remove(self, name: str) -> None:
        self.files.delete(self.path(name), True)


def publish(spark: SparkSession, root: str, write: Callable[[str], None], check: Callable[[Callable[[str], DataFrame]], None] | None = None) -> str:
    """``write(folder)`` writes tables into a fresh folder, ``check(table)`` may raise over what was written
    (``table(name)`` reads it back), then the folder becomes the current version. Returns its name."""
    store = Store(spark, root)
    now = time.time_ns()  # names follow the order of publishing also within a second
    version = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime(now // 10**9))}.{now % 10**9:09d}-{uuid.uuid4().hex[:8]}"
    folder = f"{store.root}/versions/{version}"
    write(folder)
    if check is not None:
        check(lambda name: spark.read.parquet(f"{folder}/{name}"))
    store.replace(POINTER, json.dumps({"version": version}))
    return version


def current(spark: SparkSession, root: str) -> str | None:
    """The folder that readers see; None before the first publication."""
    store = Store(spark, root)
    text = store.read(POINTER)
    return f"{store.root}/versions/{json.loads(text)['version']}" if text else None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    folder = current(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    return spark.read.parquet(f"{folder}/{name}")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all versions but the current one and the ``keep`` - 1 latest before it. A folder newer
    than the current version belongs to a run that may still write, and stays."""
    store = Store(spark, root)
    folder = current(spark, root)
    if folder is None:
        return []
    name = folder.rpartition("/")[2]
    older = [v for v in store.folders("versions") if v < name]
    gone = older[:len(older) - (keep - 1)] if keep > 1 else older
    for v in gone:
        store.remove(f"versions/{v}")
    return gone
