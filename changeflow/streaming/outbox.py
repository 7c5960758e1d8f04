"""Continuous delivery of the send queue, in order per branch and once each.

Queue rows arrive as files. A step tries all rows that wait: those new to the ledger of what was sent, and those that the last step
has left. A branch's rows go out in key order up to its first failure; that row and all behind it wait, and are
tried again by the next step, as the failure may have been lifted by then. The ledger is kept in runs with zone maps, so finding
out whether a row was sent before reads the files that can hold it.

A row that arrives after later ones of its branch have gone out cannot be put before them any more; it goes out when it comes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import moment
from ..operators import outbox
from ..session import scratch, settle
from ..sources.runs import Runs, remove, steps_in
from .inbox import STEPS

QUEUE = T.StructType([T.StructField(n, T.StringType()) for n in ("sTransNox", "sSourceNo", "sSourceCD", "cTranStat", "cSendStat")])
LEDGER = T.StructType(
    [T.StructField("sTransNox", T.StringType()), T.StructField("sSourceNo", T.StringType()), T.StructField("dSentDate", T.TimestampNTZType()),
     T.StructField("nStepxxxx", T.LongType())]
)


class Delivery:
    """Where the ledger and the waiting rows lie, and one step of delivering.

    ``attempt`` turns dispatched queue rows into outcomes, as ``outbox.delivery_outcomes`` does with headers and replies; it is called
    once for each step with all rows that wait. A step that runs again overwrites its own folders and looks only at earlier ones.
    """

    def __init__(self, spark: SparkSession, state: str, attempt: Callable[[DataFrame], DataFrame], sent: datetime, width: int = 8):
        self.spark, self.waits, self.attempt, self.sent = spark, f"{state}/waiting", attempt, sent
        self.ledger = Runs(spark, f"{state}/ledger", LEDGER, "sTransNox", width)

    def last_step(self, before: int | None = None) -> int | None:
        """The last complete step: one whose waiting rows are written."""
        steps = [s for s in steps_in(self.spark, self.waits) if before is None or s < before]
        return steps[-1] if steps else None

    def waiting(self, before: int | None = None) -> DataFrame:
        """Rows that the last step has left, with fate and message."""
        schema = T.StructType([*QUEUE.fields, T.StructField("sFatexxxx", T.StringType()), T.StructField("sMessagex", T.StringType())])
        last = self.last_step(before)
        return self.spark.createDataFrame([], schema) if last is None else self.spark.read.schema(schema).parquet(f"{self.waits}/step={last}")

    def delivered(self) -> DataFrame:
        """The ledger after the last complete step."""
        last = self.last_step()
        return self.ledger.rows(before=0 if last is None else last + 1)

    def run(self, step: int, arrived: DataFrame) -> None:
        """Try the rows that wait and those that have arrived."""
        with scratch():
            left = self.waiting(step).select(*QUEUE.names)
            unsent = settle(arrived.select(*QUEUE.names).filter("cSendStat = '0'").dropDuplicates(["sTransNox"]))
            new = unsent.join(self.ledger.holding(unsent, step).select("sTransNox"), "sTransNox", "left_anti").join(left.select("sTransNox"), "sTransNox", "left_anti")
            todo = settle(left.unionByName(new))
            told = settle(outbox.deliver_in_order(self.attempt(outbox.dispatch_by_source(todo))).select("sTransNox", "sFatexxxx", "sMessagex"))
            tried = todo.join(told, "sTransNox")
            gone = tried.filter("sFatexxxx = 'sent'").select("sTransNox", "sSourceNo", moment(self.sent).alias("dSentDate"), F.lit(step).cast("long").alias("nStepxxxx"))
            self.ledger.append(gone, step)
            # Written last: a step counts once its waiting rows are there.
            tried.filter("sFatexxxx <> 'sent'").write.mode("overwrite").parquet(f"{self.waits}/step={step}")
        for old in [s for s in steps_in(self.spark, self.waits) if s <= step][: -self.ledger.kept]:
            remove(self.spark, f"{self.waits}/step={old}")

    def try_again(self) -> None:
        """One step for the waiting rows alone, after the last one."""
        last = self.last_step()
        if last is not None and not self.waiting().isEmpty():
            self.run(last + 1, self.spark.createDataFrame([], QUEUE))


def stream_outbox(job: Delivery, queue: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Try the waiting rows again, then deliver all new queue files (Parquet of QUEUE), and stop."""
    job.try_again()
    stream = job.spark.readStream.schema(QUEUE).option("maxFilesPerTrigger", files_per_batch).parquet(queue)
    return (
        stream.writeStream.foreachBatch(lambda df, n: job.run(n * STEPS, df))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
