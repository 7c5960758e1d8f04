"""State tables in partitions that are copied on write: an update rewrites the partitions that it touches, no others.

A row's partition goes by a hash of its key. Each update writes new folders for the partitions whose keys occur among its events,
and last a pointer with the folder of every partition, old or new; a version counts once that is there. Nothing that is
being read is overwritten, and an update that runs again replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .runs import steps_in

POINTER = "part int, folder string"


class Partitions:
    """A table of ``schema`` below ``root`` in ``parts`` partitions by its ``keys``, which may be null."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], parts: int = 256):
        self.spark, self.root, self.schema, self.keys, self.parts = spark, root, schema, keys, parts

    def part(self) -> Column:
        texts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast(self.schema[k].dataType).cast("string")), F.lit("")) for k in self.keys]
        return F.pmod(F.xxhash64(*texts), F.lit(self.parts)).cast("int")

    def version(self) -> int | None:
        done = steps_in(self.spark, f"{self.root}/pointer")
        return done[-1] if done else None

    def pointer(self, version: int | None = None) -> DataFrame:
        """part and folder of every partition with rows, of the newest version or a given one."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], POINTER)
        return self.spark.read.schema(POINTER).parquet(f"{self.root}/pointer/step={version}")

    def _read(self, pointer: DataFrame) -> DataFrame:
        folders = [r.folder for r in pointer.select("folder").collect()]  # one for each partition at most
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def rows(self, version: int | None = None) -> DataFrame:
        """The whole table."""
        return self._read(self.pointer(version))

    def _write(self, rows: DataFrame, version: int) -> DataFrame:
        """Write rows into new folders; part and folder of those that have any."""
        path = f"{self.root}/rows/version={version}"
        placed = rows.select(*self.schema.names, self.part().alias("_part"))
        # Partitions are of a size, as they go by a hash; the hint joins small ones in a task and splits what a hot key makes large.
        placed.hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(path)
        written = settle(placed.select("_part").distinct())
        return written.select(F.col("_part").alias("part"), F.concat(F.lit(f"{path}/_part="), F.col("_part").cast("string")).alias("folder"))

    def _point(self, pointer: DataFrame, version: int) -> None:
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointer/step={version}")

    def create(self, rows: DataFrame) -> None:
        """The first version."""
        self._point(self._write(settle(rows), 0), 0)

    def update(self, events: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """A new version: of the partitions that hold an event's key, what ``change`` makes of their rows and the events.

        ``change`` may alter, drop and add rows with keys of the events; those of other keys it leaves as they are. The number
        of the version comes back; without events it is the present one.
        """
        version = self.version()
        touched = settle(events.select(self.part().alias("part")).distinct())
        if touched.isEmpty():
            return version
        pointer = self.pointer(version)
        old = self._read(pointer.join(touched, "part", "left_semi"))
        fresh = self._write(settle(change(old, events).select(*self.schema.names)), version + 1)
        self._point(pointer.join(touched, "part", "left_anti").unionByName(fresh), version + 1)
        return version + 1
