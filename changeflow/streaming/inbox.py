"""Continuous import of change batches as they are received.

A stream of notices says which batches have been received whole; the batches themselves lie in the
inbox, as ``write_change_batch`` writes them. A batch is always read whole, so what is logged does not
depend on how its rows are spread over files or notices over micro-batches. A batch that stops at an
error stays open at its durable position and is read again from there by the next run, as errors may
have been lifted by then.

The log and the names of known batches are kept in runs with zone maps (``sources.runs``), so a step reads the files
that can hold its own keys and names, and what a step costs does not grow with the steps before it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import moment
from ..operators import ingest
from ..schemas import CHANGE
from ..session import no_rows, scratch, settle
from ..sources import batches
from ..sources.runs import Runs, remove, steps_in

# A notice: a batch that is in the inbox with all its files.
NOTICE = "sFileName string, dReceived timestamp_ntz"
# A batch that a step has begun or closed.
KNOWN = T.StructType().add("sFileName", "string").add("bOpenxxxx", "boolean")
# A batch that a step has left open.
OPEN = f"{NOTICE}, nDurablex bigint"
ERRORS = "sFileName string, pos bigint, nErrorNox int"
# Steps are numbered: so many for each micro-batch, the first its own, the others for runs that try again.
STEPS = 1_000_000


class Import:
    """Where a stream's folders lie, and one step of importing into the log.

    ``inbox``: batches in the line layout. ``errors``: Parquet of ERRORS, what applying the rows gave, read
    anew in each step; a row without one was applied. ``log`` and ``state`` are written; a step that runs
    again overwrites its own folders and looks only at earlier ones. ``width`` runs of the log are merged into one.
    """

    def __init__(
        self, spark: SparkSession, inbox: str, errors: str, log: str, state: str, imported: datetime, chunk: int = ingest.DEFAULT_CHUNK, width: int = 8
    ):
        self.spark, self.inbox, self.errors, self.open = spark, inbox, errors, f"{state}/open"
        self.log = Runs(spark, log, CHANGE, "sTransNox", width)
        self.known = Runs(spark, f"{state}/known", KNOWN, "sFileName", width)
        self.imported, self.chunk = imported, chunk

    def last_step(self, before: int | None = None) -> int | None:
        """The last complete step: one whose open batches are written."""
        steps = [s for s in steps_in(self.spark, self.open) if before is None or s < before]
        return steps[-1] if steps else None

    def open_batches(self, step: int) -> DataFrame:
        """Batches that the last step before this one has left open."""
        last = self.last_step(step)
        if last is None:
            return no_rows(self.spark, OPEN)
        return self.spark.read.schema(OPEN).parquet(f"{self.open}/step={last}")

    def logged(self) -> DataFrame:
        """The log after the last complete step."""
        last = self.last_step()
        return self.log.rows(before=0 if last is None else last + 1)

    def run(self, step: int, notices: DataFrame) -> None:
        """Import the open batches and those of the notices as far as they go."""
        with scratch():
            waiting = settle(self.open_batches(step))
            new = settle(notices.groupBy("sFileName").agg(F.min("dReceived").alias("dReceived")).withColumn("nDurablex", F.lit(0).cast("long")))
            known = self.known.holding(new, step).select("sFileName")
            todo = settle(waiting.withColumn("_new", F.lit(False)).unionByName(new.join(known, "sFileName", "left_anti").withColumn("_new", F.lit(True))))

            # Read once for the positions of the rows that stop a batch, and once for the rows that go on: storing all rows on the way is dearer.
            lines = batches.read_change_lines(self.spark, self.inbox)
            codes = self.spark.read.schema(ERRORS).parquet(self.errors).withColumn("nErrorNox", F.coalesce("nErrorNox", F.lit(0)))
            told = codes.join(todo.select("sFileName", "nDurablex"), "sFileName").filter(F.col("pos") > F.col("nDurablex")).drop("nDurablex")
            reported = settle(ingest.classify_errors(told).filter("sOutcomex = 'report'").distinct())
            failed = lines.select("sFileName", "pos").join(reported.filter(F.col("sFileName") >= ""), ["sFileName", "pos"])
            stops = settle(ingest.import_progress(failed, self.chunk).select("sFileName", "nStopPosx", F.col("nDurablex").alias("_kept")))

            # Of a batch that stops its kept rows go on, of any other all rows; one without kept rows is not read.
            going = settle(todo.drop("_new").join(stops, "sFileName", "left").filter("_kept is null or _kept > nDurablex"))
            rows = lines.join(going.filter(F.col("sFileName") >= ""), "sFileName")
            rows = rows.filter((F.col("pos") > F.col("nDurablex")) & (F.col("_kept").isNull() | (F.col("pos") <= F.col("_kept"))))
            rows = rows.drop("nDurablex", "nStopPosx", "_kept").join(codes, ["sFileName", "pos"], "left")
            accepted = ingest.classify_errors(rows.withColumn("nErrorNox", F.coalesce("nErrorNox", F.lit(0))))
            fresh = ingest.drop_seen_by_zones(settle(ingest.drop_repeats_in_batch(accepted)), self.log, step)
            self.log.append(fresh.select(*CHANGE.names).withColumn("dModified", moment(self.imported)), step)

            durable = F.greatest("nDurablex", F.coalesce("_kept", F.col("nDurablex")))
            after = todo.join(stops, "sFileName", "left").select(
                "sFileName", "dReceived", durable.alias("nDurablex"), F.col("nStopPosx").isNotNull().alias("bOpenxxxx"), "_new"
            )
            self.known.append(after.filter("_new or not bOpenxxxx"), step)
            # Written last: a step counts once its open batches are there.
            after.filter("bOpenxxxx").select("sFileName", "dReceived", "nDurablex").write.mode("overwrite").parquet(f"{self.open}/step={step}")
        for old in [s for s in steps_in(self.spark, self.open) if s <= step][: -self.log.kept]:
            remove(self.spark, f"{self.open}/step={old}")

    def try_again(self) -> None:
        """One step for the open batches alone, after the last one."""
        last = self.last_step()
        if last is not None and not self.open_batches(last + 1).isEmpty():
            self.run(last + 1, no_rows(self.spark, NOTICE))


def stream_import(job: Import, notices: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Try the open batches again, then import the batches of all new notices (JSON lines of NOTICE), and stop.

    Duplicates are found by comparing with all files of the log that can hold them, not by a watermark,
    which would forget old changes. A new checkpoint needs new log and state folders.
    """
    job.try_again()
    stream = job.spark.readStream.schema(NOTICE).option("maxFilesPerTrigger", files_per_batch).json(notices)
    return (
        stream.writeStream.foreachBatch(lambda df, n: job.run(n * STEPS, df))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_batches(job: Import, at: datetime) -> DataFrame:
    """Events for ``advance_incoming``: batches that were imported to their end."""
    closed = job.known.rows(before=(job.last_step() or 0) + 1).filter(~F.col("bOpenxxxx")).select("sFileName").distinct()
    return closed.select("sFileName", F.lit("imported").alias("sEvent"), moment(at).alias("dEventxxx"))
