"""Session defaults, and tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Used only where the session names no folder, as in tests on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def session(app: str = "pyrelith", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that every query here expects."""
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only on one machine, where that is unset."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if not named and not is_one_machine(spark.sparkContext.master):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that the driver and all executors share")
    return named or LOCAL_CHECKPOINTS


def is_one_machine(master: str) -> bool:
    """Whether driver and executors are one process: ``local``, ``local[8]``, but not ``local-cluster``."""
    return master == "local" or master.startswith("local[")


#: Folders of this process's tables, and what deletes each.
_FOLDERS: dict[str, tuple] = {}


@atexit.register
def sweep() -> None:
    """Remove the tables that this driver wrote; whatever it returned has been read by then."""
    while _FOLDERS:
        _, (path, conf) = _FOLDERS.popitem()
        try:
            path.getFileSystem(conf).delete(path, True)
        except Exception:  # noqa: BLE001 - the JVM may have ended first
            return


class Scratch:
    """Tables that cut a lineage: Parquet in the shared folder, so that losing an executor loses nothing.

    A returned DataFrame may still read such a table, so it stays until ``drop`` removes it or the driver ends.
    Operators drop what their result doesn't read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        app = f"{shared_folder(spark).rstrip('/')}/pyrelith/{spark.sparkContext.applicationId}"
        self.root = f"{app}/{label}-{uuid.uuid4().hex[:12]}"
        if app not in _FOLDERS:
            _FOLDERS[app] = (spark._jvm.org.apache.hadoop.fs.Path(app), spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bytes(self, name: str) -> int:
        """Size of a written table in its file system."""
        return self._fs(name).getContentSummary(self._hadoop_path(name)).getLength()

    def drop(self, *names: str) -> None:
        """Remove tables that nothing will read again."""
        for name in names:
            self._fs(name).delete(self._hadoop_path(name), True)

    def _hadoop_path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def _fs(self, name: str):
        return self._hadoop_path(name).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by ``keys`` to three tasks a core at least: a small file is one task, however much work its rows make."""
    return df.repartition(max(3 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()), *keys)


def column(name: str):
    """A column by its whole name, dots included."""
    from pyspark.sql import functions as F

    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """A name that none of the table's columns has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


BATCH_KEYS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 10_000, "spark.sql.execution.arrow.maxBytesPerBatch": 64 << 20}


def text_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> None:
    """Rows and bytes that go to a Python worker at once, for tables of long texts; smaller settings of the session stay.

    The settings are the session's, as a plan reads them only when it runs; results don't depend on them.
    """
    for (key, default), most in zip(BATCH_KEYS.items(), (rows, size), strict=True):
        now = spark.conf.get(key, str(default))
        if not now.isdigit() or int(now) == 0 or int(now) > most:
            spark.conf.set(key, str(most))


def release_memory() -> None:
    """Give what a Python worker has freed back to the system, as idle workers stay alive for the next stage."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
