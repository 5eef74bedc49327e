"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "barloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else the warehouse folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir")


def stream_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with one state partition per core.

    A stream keeps the number of its state partitions for life and visits all
    of them in every batch, so it follows the cores, not the batch default.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    cores = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(cores))
    # state on the executors' disks with a bounded cache, instead of all keys in the heap
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    return session


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def clear_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Removes the scratch folders made by this session (or those given), once nothing reads them any more.

    Jobs and reports run inside ``scratch_cleared`` and leave none; who keeps a lazy frame
    that reads a scratch folder holds it by ``Held`` or calls this afterwards.
    """
    for path in list(_SCRATCH.get(id(spark), ()) if paths is None else paths):
        if path in _TABLES:
            spark.sql(f"drop table if exists {_TABLES.pop(path)}")
        remove_path(spark, path)
        _SCRATCH.get(id(spark), set()).discard(path)


#: Scratch folders by session; only names, to be able to remove them.
_SCRATCH: dict[int, set[str]] = {}
#: Catalog names of the scratch folders that are tables.
_TABLES: dict[str, str] = {}


@contextmanager
def scratch_cleared(spark: SparkSession):
    """Removes the scratch folders that were made inside the block."""
    before = set(_SCRATCH.get(id(spark), ()))
    try:
        yield
    finally:
        clear_scratch(spark, [p for p in _SCRATCH.get(id(spark), ()) if p not in before])


class Held:
    """A lazy frame together with the scratch folders that it reads.

    ``with Held.of(spark, lambda: sequential_values(df, "id")) as failing: ...`` or ``close()``
    removes the folders once the frame is no longer needed.
    """

    def __init__(self, spark: SparkSession, frame: DataFrame, paths: list[str]):
        self.frame, self._spark, self._paths = frame, spark, paths

    @classmethod
    def of(cls, spark: SparkSession, make: Callable[[], DataFrame]) -> Held:
        before = set(_SCRATCH.get(id(spark), ()))
        frame = make()
        return cls(spark, frame, [p for p in _SCRATCH.get(id(spark), ()) if p not in before])

    def close(self) -> None:
        clear_scratch(self._spark, self._paths)
        self._paths = []

    def __enter__(self) -> DataFrame:
        return self.frame

    def __exit__(self, *error) -> None:
        self.close()


def scratch_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """(name, path) for a table whose files are scratch: both go when the scratch is cleared."""
    path = scratch_path(spark, label)
    name = f"scratch_{label}_{path.rpartition('-')[2]}"
    _TABLES[path] = name
    return name, path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(id(spark), set()).add(path)
    return path
