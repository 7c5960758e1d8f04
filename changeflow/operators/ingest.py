"""Receiving changes: inbox, duplicate removal, error triage, applying and logging.

Incoming rows have sFileName, pos (1-based in the file), dReceived, the change columns, and
nErrorNox (0 when the change was applied).
"""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import branch_of, first_row, moment
from ..functions.statement_text import HEAD, bare_name
from ..session import settle
from ..sources.runs import Runs
from .windows import KNOWN, RECEIVED, with_branch

IDENTITY = ["sTransNox", "sModified"]

# Error codes that do not stop an import.
IGNORED_ERRORS = (1022, 1062, 1690, 1264, 1406, 1064, 1072, 1060)

# Rows per commit of the default and of the resumable reader.
DEFAULT_CHUNK, RESUMABLE_CHUNK = 10_000, 1_000


def pending_imports(incoming: DataFrame) -> DataFrame:
    """Received batches, the one received first at the top."""
    return incoming.filter(F.col("cTranStat") == RECEIVED).orderBy("dReceived", "sFileName")


def register_incoming(incoming: DataFrame, announced: DataFrame) -> DataFrame:
    """New inbox: announced batches whose name is unknown are added in state 0, each once."""
    once = announced.groupBy("sFileName").agg(F.min(F.struct("dCreatedx", "sMD5Hashx", "sFileSize")).alias("m"))
    fresh = once.join(incoming.select("sFileName"), "sFileName", "left_anti").select(
        "sFileName", "m.sMD5Hashx", "m.sFileSize", "m.dCreatedx", F.lit(KNOWN).alias("cTranStat")
    )
    return incoming.unionByName(fresh, allowMissingColumns=True)


def hash_reconcile(own: DataFrame, peer: DataFrame) -> DataFrame:
    """Both sides' hash per file, compared case-blind: match, mismatch, missing on one side, or no hash.

    A file that is there without a hash, or with an empty one, cannot be verified: 'no hash'. One listed several times
    on a side is compared as often, but goes through the join once, with the number of times.
    """

    def once(side: DataFrame, name: str) -> DataFrame:
        counted = side.groupBy("sFileName", F.lower("sMD5Hashx").alias("hash")).agg(F.count("*").alias("times"))
        return counted.select("sFileName", F.struct("hash", "times").alias(name))

    def as_often(rows: DataFrame, name: str) -> DataFrame:
        times = F.coalesce(F.col(f"{name}.times"), F.lit(1)).cast("int")
        return rows.select("sFileName", "own", "peer", "sStatusxx", F.explode(F.sequence(F.lit(1), times)).alias("_time"))

    unhashed = [F.coalesce(F.col(f"{side}.hash"), F.lit("")) == "" for side in ("own", "peer")]
    status = (
        F.when(F.col("own").isNull(), "missing here")
        .when(F.col("peer").isNull(), "missing there")
        .when(unhashed[0] | unhashed[1], "no hash")
        .when(F.col("own.hash") == F.col("peer.hash"), "match")
        .otherwise("mismatch")
    )
    compared = once(own, "own").join(once(peer, "peer"), "sFileName", "full").withColumn("sStatusxx", status)
    return as_often(as_often(compared, "own"), "peer").select("sFileName", "sStatusxx")


def drop_seen_changes(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows whose (key, modifier) the log does not hold.

    The log is narrowed to what the rows hold, not the other way round: the rows' keys are stored, so
    the semi-join broadcasts them when they are small and shuffles two columns of the log only
    when they are not. The branch is a further key, so of a log stored by branch only the folders
    that occur are read; the bound on it is true of every code and lets Spark prune them at run time.
    The rows are read twice: pass stored ones if they are dear.
    """
    wanted = settle(with_branch(rows).select("branch", *IDENTITY)).filter(F.col("branch") >= "")
    seen = settle(with_branch(log).select("branch", *IDENTITY).join(wanted, ["branch", *IDENTITY], "left_semi"))
    return rows.join(seen.select(*IDENTITY), IDENTITY, "left_anti")


def drop_seen_by_zones(rows: DataFrame, log: Runs, before: int | None = None) -> DataFrame:
    """As ``drop_seen_changes``, for a log kept in runs: only the files are read whose range of keys can hold one of the rows'.

    The rows are read three times: pass stored ones if they are dear.
    """
    return drop_seen_changes(rows, log.holding(rows, before))


def drop_repeats_in_batch(rows: DataFrame) -> DataFrame:
    """The first applied row of each (key, modifier); failed rows are not logged, so they are set aside.

    Rows are taken in the order in which they are read: file received first, file name, position.
    """
    applied = rows.filter(F.col("nErrorNox") == 0)
    return first_row(applied, IDENTITY, [F.col("dReceived"), F.col("sFileName"), F.col("pos")])


def classify_errors(
    rows: DataFrame, ignored: tuple[int, ...] = IGNORED_ERRORS, verdicts: DataFrame | None = None
) -> DataFrame:
    """Adds sOutcomex: 'ok', 'ignore' for a listed code or a verdict that says so, else 'report'.

    Codes are compared whole. ``verdicts`` (sFileName, sRefernox, nErrorNox, sResponse) holds the
    answers to reported errors.
    """
    listed = F.col("nErrorNox").isin(*ignored)
    outcome = F.when(F.col("nErrorNox") == 0, "ok").when(listed, "ignore")
    if verdicts is None:
        return rows.withColumn("sOutcomex", outcome.otherwise("report"))
    keys = ["sFileName", "sTransNox", "nErrorNox"]
    answers = (
        verdicts.filter(F.lower("sResponse") == "ignore")
        .select("sFileName", F.col("sRefernox").alias("sTransNox"), "nErrorNox", F.lit(True).alias("_pass"))
        .distinct()
    )
    return (
        rows.join(answers, keys, "left")
        .withColumn("sOutcomex", outcome.when(F.col("_pass"), "ignore").otherwise("report"))
        .select(*rows.columns, "sOutcomex")
    )


def error_report(classified: DataFrame, branch: str | None = None) -> DataFrame:
    """The failed rows as sent to the watchers: branch, file, reference, code, text and outcome.

    The text is the column sDescript of the rows; rows that come without it have none.
    """
    owner = branch_of("sFileName") if branch is None else F.lit(branch)
    text = F.col("sDescript") if "sDescript" in classified.columns else F.lit(None).cast("string").alias("sDescript")
    return classified.filter(F.col("sOutcomex") != "ok").select(
        owner.alias("sBranchCD"), "sFileName", F.col("sTransNox").alias("sRefernox"), "nErrorNox", text, "sOutcomex"
    )


def error_summary(classified: DataFrame) -> DataFrame:
    """Failed rows counted by file, branch of the key, code and outcome."""
    failed = classified.filter(F.col("sOutcomex") != "ok")
    return failed.groupBy("sFileName", branch_of("sTransNox").alias("branch"), "nErrorNox", "sOutcomex").agg(
        F.count("*").alias("nRowsxxxx")
    )


def import_progress(classified: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Per file: where it stopped (null when it did not), the last durable position, and the resume point.

    Commits come after each full chunk of rows read, so an abort keeps full chunks only.
    """
    stops = classified.groupBy("sFileName").agg(
        F.min(F.when(F.col("sOutcomex") == "report", F.col("pos"))).alias("nStopPosx"), F.max("pos").alias("nLastPosx")
    )
    full_chunks = F.floor((F.col("nStopPosx") - 1) / chunk) * chunk
    return stops.withColumn("nDurablex", F.coalesce(full_chunks, F.col("nLastPosx"))).withColumn(
        "nResumexx", F.col("nDurablex") + 1
    )


def accepted_prefix(classified: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Rows before their file's first blocking error, with bDurablex: kept although the file aborts.

    The stops are one row per file, found by a partial aggregate and joined back, so a large file
    is never gathered in one task.
    """
    progress = settle(import_progress(classified, chunk).select("sFileName", "nStopPosx", "nDurablex"))
    before = F.col("nStopPosx").isNull() | (F.col("pos") < F.col("nStopPosx"))
    return (
        classified.join(progress, "sFileName")
        .filter(before)
        .withColumn("bDurablex", F.col("pos") <= F.col("nDurablex"))
        .drop("nStopPosx", "nDurablex")
    )


def append_change_log(log: DataFrame, accepted: DataFrame, imported: datetime) -> DataFrame:
    """New log: the old rows and the accepted ones, whose dModified becomes the time of import."""
    if "branch" in log.columns:
        accepted = with_branch(accepted)
    stamped = accepted.withColumn("dModified", moment(imported))
    return log.unionByName(stamped.select(*log.columns))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """New target: per key the newest change by (dModified, sTransNox) wins and a delete removes the row.

    ``changes`` has the target's columns, sActionxx ('upsert' or 'delete'), dModified and sTransNox.
    The newest changes are stored, so the target, which may be far larger, is only filtered by their
    keys and not shuffled while these are small enough to broadcast. Keys may be null.
    """
    newest = first_row(changes, keys, [F.col("dModified").desc(), F.col("sTransNox").desc()])
    latest = settle(newest.select(*target.columns, "sActionxx"))
    touched = latest.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = functools.reduce(Column.__and__, [target[k].eqNullSafe(touched[f"_{k}"]) for k in keys])
    untouched = target.join(touched, same, "left_anti")
    return untouched.unionByName(latest.filter(F.col("sActionxx") != "delete").drop("sActionxx"))


def statement_parts(log: DataFrame) -> DataFrame:
    """Adds sVerbxxxx, sTargetTb and whether the statement names the row's own table; modifiers and a schema may stand before it."""
    return (
        log.withColumn("sVerbxxxx", F.upper(F.regexp_extract("sStatemnt", HEAD, 1)))
        .withColumn("sTargetTb", bare_name(F.regexp_extract("sStatemnt", HEAD, 3)))
        .withColumn("bSameTabl", F.lower("sTargetTb") == F.lower("sTableNme"))
    )


def statement_profile(log: DataFrame) -> DataFrame:
    """Statements counted by branch, day, verb, and whether they name the row's own table."""
    parts = statement_parts(log.select("sTransNox", "sStatemnt", "sTableNme", "dEntryDte"))
    return parts.groupBy(
        branch_of("sTransNox").alias("branch"), F.col("dEntryDte").cast("date").alias("dEntryDay"), "sVerbxxxx", "bSameTabl"
    ).agg(F.count("*").alias("nRowsxxxx"))
