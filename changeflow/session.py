"""Session settings, the shared folder, and tables written on the way."""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Adaptive execution splits hot keys of shuffle joins. Without the last setting it leaves them alone
# where several joins on one key share a shuffle, as in a collection sheet's lines.
# The folders of a table are listed in so many tasks, not one task for each folder, of which an inbox has thousands.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# The library states times as TIMESTAMP_NTZ, so no result depends on these; they ease reading results.
RECOMMENDED = {**ADAPTIVE, "spark.sql.timestampType": "TIMESTAMP_NTZ", "spark.sql.session.timeZone": "UTC"}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the adaptive settings on a session that somebody else made; call it once before using the operators."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("changeflow")
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach: ``spark.checkpoint.dir``.

    Only a local session, whose executors are the driver, may do without it: it uses the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] == "local":
        return spark.conf.get("spark.sql.warehouse.dir")
    raise ValueError("set spark.checkpoint.dir to a folder that every node can reach")


# What each thread has made, as a stream's callbacks run beside the driver's main thread.
_threads = threading.local()


def _made() -> list[tuple[SparkSession, str]]:
    if not hasattr(_threads, "made"):
        _threads.made = []
        atexit.register(_remove_from, _threads.made, 0)
    return _threads.made


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, removed by ``scratch`` or at the end of the driver."""
    path = f"{shared_folder(spark).rstrip('/')}/changeflow-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"
    _made().append((spark, path))
    return path


def _remove_from(made: list[tuple[SparkSession, str]], first: int) -> None:
    while len(made) > first:
        spark, path = made.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = where.getFileSystem(spark._jsc.hadoopConfiguration())
            files.delete(where, True)
            files.delete(where.getParent(), False)  # only goes when it is empty
        except Exception:  # noqa: BLE001  the session or its process has ended, or others still use the parent
            pass


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Removes the folders made inside. Use it around work that is complete when the block ends, such as a write."""
    made = _made()
    first = len(made)
    try:
        yield
    finally:
        _remove_from(made, first)


def settle(df: DataFrame) -> DataFrame:
    """Write a derived table once and read it back, mostly one of a row per branch or file.

    Spark plans joins from file sizes, and a table derived from the log looks as large as the log
    until it is stored. Once stored, its true size is known: below
    ``spark.sql.autoBroadcastJoinThreshold`` the join broadcasts it and the log is not shuffled,
    above it Spark keeps the shuffle join with skew handling. It also cuts the lineage, so losing
    an executor does not repeat the log scan.
    """
    spark = df.sparkSession
    path = new_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty table that the planner knows to be empty; one made of a Python list starts a Python worker on every core."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).limit(0)
