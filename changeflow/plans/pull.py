"""Receiving side: from announced batches to the new log, the progress of every file, and error reports."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import moment
from ..operators import ingest, windows
from ..session import settle


class Imported(NamedTuple):
    log: DataFrame
    progress: DataFrame
    errors: DataFrame


def pull(
    rows: DataFrame, log: DataFrame, imported: datetime, chunk: int = ingest.DEFAULT_CHUNK,
    verdicts: DataFrame | None = None,
) -> Imported:
    """Import all files at once. Repeats go before the comparison with the log, so fewer rows are compared."""
    classified = ingest.classify_errors(rows, verdicts=verdicts)
    kept = ingest.accepted_prefix(classified, chunk).filter("bDurablex")
    fresh = ingest.drop_seen_changes(settle(ingest.drop_repeats_in_batch(kept)), log)
    return Imported(
        ingest.append_change_log(log, fresh, imported),
        ingest.import_progress(classified, chunk),
        ingest.error_report(classified),
    )


def receive(incoming: DataFrame, announced: DataFrame, files: DataFrame, received: datetime) -> DataFrame:
    """New inbox: announced batches are registered, and those whose file has the announced hash count as received.

    ``files`` (sFileName, sMD5Hashx) is what has arrived.
    """
    known = settle(ingest.register_incoming(incoming, announced))
    matched = ingest.hash_reconcile(known, files).filter("sStatusxx = 'match'")
    acks = matched.select("sFileName", F.lit("received").alias("sEvent"), moment(received).alias("dEventxxx"))
    return windows.advance_incoming(known, acks)


class Pulled(NamedTuple):
    incoming: DataFrame
    log: DataFrame
    errors: DataFrame


def pull_received(
    incoming: DataFrame, batch_rows: DataFrame, errors: DataFrame, log: DataFrame, imported: datetime, chunk: int = ingest.DEFAULT_CHUNK
) -> Pulled:
    """Import every received batch: rows of batch files with the errors that applying them gave.

    ``batch_rows`` is what ``read_change_lines`` or ``read_change_batch`` returns, ``errors`` has
    sFileName, pos and nErrorNox. A batch read to its end becomes imported; one that stopped stays
    received and is read again by the next pull.
    """
    waiting = settle(ingest.pending_imports(incoming).select("sFileName", "dReceived"))
    rows = batch_rows.join(waiting, "sFileName").join(errors, ["sFileName", "pos"], "left")
    rows = settle(rows.withColumn("nErrorNox", F.coalesce("nErrorNox", F.lit(0))))
    done = pull(rows, log, imported, chunk)
    whole = done.progress.filter("nStopPosx IS NULL")
    acks = whole.select("sFileName", F.lit("imported").alias("sEvent"), moment(imported).alias("dEventxxx"))
    return Pulled(windows.advance_incoming(incoming, acks), done.log, done.errors)
