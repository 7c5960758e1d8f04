"""A growing table in sorted runs, with a zone map: the lowest and highest key of every file.

Every step appends a run, sorted by key and cut into files by ranges of it. The zone map, one row per file and branch, says which
files can hold a key, so a comparison with the table reads those and no others. Runs of one level are merged into one of
the next as soon as there are ``width`` of them: a row is rewritten once per level, the number of runs grows with the
logarithm of the steps, and a step reads few files however many steps went before.

A step writes its rows, then what it merges, and last its zone map; it counts once that is there. It reads the map of the
step before, so running a step again overwrites its own folders and gives the same. The files that the last maps name
are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import branch_of
from ..session import no_rows, settle

# One row per file and branch in it: the run and its level, bounds and number of the keys, and the bounds of dModified (of a table
# that has it; a row without one counts as modified at the end of time).
ZONES = (
    "run string, level int, path string, branch string, sLowKeyxx string, sHighKeyx string, nRowsxxxx bigint, "
    "dOldestxx timestamp_ntz, dLatestxx timestamp_ntz"
)
UNDATED = "9999-12-31 00:00:00"
# A level is rewritten in so many parts at most. A part is a job of many tasks, with a fixed cost of its own.
PARTS = 16


def steps_in(spark: SparkSession, folder: str) -> list[int]:
    """The complete steps of a folder of ``step=N`` folders, in order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    names = [(s.getPath(), s.getPath().getName()) for s in files.listStatus(where)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(name.removeprefix("step=")) for path, name in names if name.startswith("step=") and files.exists(done(path, "_SUCCESS")))


def remove(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Runs:
    """A table of ``schema`` below ``root``, in runs sorted by ``key``; the first four characters of a key are its branch.

    ``width`` runs make one of the next level; ``kept`` zone maps and their files stay for steps that run again and for readers.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, width: int = 8, rows_per_file: int = 5_000_000, kept: int = 3):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key
        self.width, self.rows_per_file, self.kept = width, rows_per_file, kept

    def _maps(self) -> str:
        return f"{self.root}/zones"

    def zones(self, before: int | None = None) -> DataFrame:
        """The zone map of the last step, or of the last one before a step."""
        steps = [s for s in steps_in(self.spark, self._maps()) if before is None or s < before]
        if not steps:
            return no_rows(self.spark, ZONES)
        return self.spark.read.schema(ZONES).parquet(f"{self._maps()}/step={steps[-1]}")

    def read(self, zones: DataFrame) -> DataFrame:
        """The rows of the files that the zones name. Their names are what the driver would list for any table."""
        paths = [r.path for r in zones.select("path").distinct().collect()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else no_rows(self.spark, self.schema)

    def rows(self, before: int | None = None) -> DataFrame:
        """The whole table."""
        return self.read(self.zones(before))

    def holding(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The rows of all files that can hold one of the keys (a column named like the table's).

        Keys meet the zones of their branch in a join; runs do not overlap in themselves, so a key has one file per run at most.
        """
        wanted = keys.select(branch_of(self.key).alias("branch"), F.col(self.key).alias("_key"))
        zones = settle(self.zones(before))
        inside = (wanted.branch == zones.branch) & wanted["_key"].between(zones.sLowKeyxx, zones.sHighKeyx)
        return self.read(wanted.join(zones, inside).select("path"))

    def _write(self, rows: DataFrame, run: str, level: int) -> DataFrame:
        """Write a run; its zones. Ranges, not hashes of branches, so that files of a large branch do not overlap."""
        path = f"{self.root}/rows/{run}"
        in_order = rows.select(*self.schema.names).repartitionByRange(self.key).sortWithinPartitions(self.key)
        in_order.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file).parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        stamp = F.lit(None).cast("timestamp_ntz")
        if "dModified" in self.schema.names:
            stamp = F.coalesce("dModified", F.lit(UNDATED).cast("timestamp_ntz"))
        zones = written.groupBy(F.col("_metadata.file_path").alias("path"), branch_of(self.key).alias("branch")).agg(
            F.min(self.key).alias("sLowKeyxx"), F.max(self.key).alias("sHighKeyx"), F.count("*").alias("nRowsxxxx"),
            F.min(stamp).alias("dOldestxx"), F.max(stamp).alias("dLatestxx"),
        )
        return zones.select(F.lit(run).alias("run"), F.lit(level).alias("level"), *zones.columns)

    def append(self, rows: DataFrame, step: int) -> None:
        """Add the rows of a step, merge levels that are full, and write the new zone map. Keys are not null."""
        live = self.zones(step).unionByName(settle(self._write(rows, f"step={step}", 0)))
        level = 0
        while live.filter(F.col("level") == level).select("run").distinct().count() >= self.width:
            full = self.read(live.filter(F.col("level") == level))
            merged = settle(self._write(full, f"step={step}-level={level + 1}", level + 1))
            live = live.filter(F.col("level") != level).unionByName(merged)
            level += 1
        self._complete(live, step)

    def _complete(self, live: DataFrame, step: int) -> None:
        live.hint("rebalance").write.mode("overwrite").parquet(f"{self._maps()}/step={step}")
        self._forget(step)

    def rewrite(self, plan: DataFrame, keep: Callable[[DataFrame], DataFrame], step: int, files_per_part: int = 100) -> None:
        """A step that takes files away (``plan``: path, and ``whole`` where all rows go) and writes the rows that ``keep`` leaves of the others.

        Files are rewritten in parts of ``files_per_part`` files, or as many more as keep the parts few, and a ledger has the new files' zones for each part that is done. A step that was stopped
        goes on with the parts that are not; what readers see changes at the end, with the new zone map.
        """
        ledger = f"{self.root}/ledger/step={step}"
        plan = settle(plan.select("path", "whole"))
        live = settle(self.zones(step))
        mixed = live.join(plan.filter("not whole"), "path", "left_semi")
        for level in sorted(r.level for r in mixed.select("level").distinct().collect()):
            own = mixed.filter(F.col("level") == level)
            parts = min(PARTS, -(-own.select("path").distinct().count() // files_per_part))
            done = steps_in(self.spark, f"{ledger}/level={level}")
            for part in [x for x in range(parts) if x not in done]:
                rows = keep(self.read(own.filter(F.pmod(F.xxhash64("path"), F.lit(parts)) == part)))
                zones = self._write(rows, f"step={step}-level={level}-part={part}", level)
                zones.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/level={level}/step={part}")
        live = live.join(plan, "path", "left_anti")
        if not mixed.isEmpty():
            live = live.unionByName(self.spark.read.schema(ZONES).option("recursiveFileLookup", "true").parquet(ledger))
        self._complete(live, step)
        remove(self.spark, ledger)

    def _forget(self, step: int) -> None:
        """Remove older zone maps, and runs up to this step that no map names any more."""
        steps = steps_in(self.spark, self._maps())
        for old in [s for s in steps if s <= step][: -self.kept]:
            remove(self.spark, f"{self._maps()}/step={old}")
        named = {r.run for r in self.spark.read.schema(ZONES).parquet(*[f"{self._maps()}/step={s}" for s in steps_in(self.spark, self._maps())]).select("run").distinct().collect()}
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/rows")
        for status in where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where):
            run = status.getPath().getName()
            if run not in named and int(run.removeprefix("step=").split("-")[0]) <= step:
                remove(self.spark, f"{self.root}/rows/{run}")
