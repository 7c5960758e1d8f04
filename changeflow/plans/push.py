"""Sending side: cut the windows, write the batches, announce them, archive old ones."""

from __future__ import annotations

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import moment
from ..operators import ingest, windows
from ..session import settle
from ..sources import batches


class Pushed(NamedTuple):
    outgoing: DataFrame
    announce: DataFrame
    send: DataFrame


def push(log: DataFrame, outgoing: DataFrame, clients: DataFrame, created: datetime, path: str) -> Pushed:
    """Write the pending batches of all branches below ``path``; the new outgoing manifest and what to do next.

    A branch whose newest batch is unfinished gets no new window, or the same rows would be cut again: its
    batch is announced (state 0) or sent and verified (state 1) first, as are the new ones. Keys come
    from the numbered rows, which are stored, size and MD5 from the written files, so the log is
    read once after its windows are known.
    """
    spark = log.sparkSession
    unfinished = settle(windows.unfinished_batches(outgoing))
    due = windows.export_window(log, outgoing, clients).join(unfinished, "branch", "left_anti")
    rows, summary = windows.create_batches(log, due, created)
    batches.write_change_batch(rows, path)
    made = settle(windows.manifest_of(summary, batches.batch_files(spark, path), created))
    waiting = unfinished.select(*outgoing.columns)
    return Pushed(
        outgoing.unionByName(made.select(*outgoing.columns)),
        waiting.filter(F.col("cTranStat") == windows.MADE).unionByName(made.select(*outgoing.columns)),
        waiting.filter(F.col("cTranStat") == windows.ANNOUNCED),
    )


def confirm(outgoing: DataFrame, peer: DataFrame, checked: datetime) -> DataFrame:
    """New outgoing manifest after the peer reported its hashes: equal ones are verified."""
    matched = ingest.hash_reconcile(outgoing, peer).filter("sStatusxx = 'match'")
    acks = matched.select(
        "sFileName", F.lit("verified").alias("sEvent"), moment(checked).alias("dEventxxx")
    )
    return windows.advance_outgoing(outgoing, acks)


def archive(
    log: DataFrame, outgoing: DataFrame, as_of: date, last_runs: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows to archive of every branch that is due, and the new outgoing manifest."""
    due = settle(windows.archive_window(outgoing, as_of, last_runs))
    rows = windows.branch_window_scan(log, due.withColumnRenamed("sFileThru", "sFileName").drop("sFileFrom"))
    return rows, windows.mark_archived(outgoing, due)
