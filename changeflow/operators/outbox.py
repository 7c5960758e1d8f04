"""The send queue that mirrors master/detail documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import branch_of, dense_position, moment
from ..session import settle

# Source code and state of a document that can be uploaded, and the reason texts.
SHEET_SOURCE, CLOSED = "DCPx", "1"
NOT_FOR_UPLOAD = "Transaction status is not for upload."
UNKNOWN_SOURCE = "Source code has no handler."
EMPTY_KEY = "Transaction number must not be empty."
NO_SUCH_DOCUMENT = "Transaction given does not exist."
UPLOADED = "uploaded successfully."

# Lines in one part of a document.
LINES_PER_PART = 100_000


def pending_outbox(queue: DataFrame, branch: str) -> DataFrame:
    """Unsent queue rows of one branch in key order."""
    rows = queue.filter(F.col("sTransNox").startswith(branch) & (F.col("cSendStat") == "0"))
    return rows.select("sTransNox", "sSourceNo", "sSourceCD", "cTranStat").orderBy("sTransNox")


def dispatch_by_source(queue: DataFrame) -> DataFrame:
    """Adds sReasonxx: null when the row can be uploaded, else why not."""
    reason = (
        F.when(F.coalesce("sSourceCD", F.lit("")) != SHEET_SOURCE, UNKNOWN_SOURCE)
        .when(F.trim(F.coalesce("sSourceNo", F.lit(""))) == "", EMPTY_KEY)
        .when(F.coalesce("cTranStat", F.lit("")) != CLOSED, NOT_FOR_UPLOAD)
    )
    return queue.withColumn("sReasonxx", reason)


def delivery_outcomes(dispatched: DataFrame, masters: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """One row per queue row: delivered or not, and the message that is logged.

    A row is delivered when it could be uploaded, its document exists, and the receiver's reply
    (``replies``: sTransNox, sResultxx, sMessagex) is a success; without ``replies`` the receiver is
    taken to accept.
    """
    known = masters.select(F.col("sTransNox").alias("sSourceNo"), F.lit(True).alias("_known")).distinct()
    rows = dispatched.join(known, "sSourceNo", "left")
    problem = F.coalesce("sReasonxx", F.when(F.col("_known").isNull(), NO_SUCH_DOCUMENT))
    if replies is not None:
        answers = replies.groupBy("sTransNox").agg(
            F.max(F.struct("sResultxx", "sMessagex")).alias("_reply")
        )
        rows = rows.join(answers, "sTransNox", "left")
        refused = F.when(
            F.coalesce(F.col("_reply.sResultxx"), F.lit("")) != "success",
            F.coalesce(F.col("_reply.sMessagex"), F.lit("no reply")),
        )
        problem = F.coalesce(problem, refused)
    return rows.select(
        "sTransNox", "sSourceNo", "cTranStat", problem.isNull().alias("bSentxxxx"),
        F.coalesce(problem, F.lit(UPLOADED)).alias("sMessagex"),
    )


def deliver_in_order(outcomes: DataFrame) -> DataFrame:
    """Outcomes with sFatexxxx: a branch's rows go out in key order up to its first failure.

    'sent' before it, 'failed' for it, 'held' for all behind it, whatever became of them by themselves. The first failure is one row
    per branch, found by a partial aggregate and joined back, so a branch with most of the rows is no single task's.
    """
    stops = outcomes.filter(~F.col("bSentxxxx")).groupBy(branch_of("sTransNox").alias("_branch")).agg(F.min("sTransNox").alias("_stop"))
    rows = outcomes.withColumn("_branch", branch_of("sTransNox")).join(settle(stops), "_branch", "left")
    fate = F.when(F.col("_stop").isNull() | (F.col("sTransNox") < F.col("_stop")), "sent").when(F.col("sTransNox") > F.col("_stop"), "held").otherwise("failed")
    return rows.withColumn("sFatexxxx", fate).select(*outcomes.columns, "sFatexxxx")


def mark_sent(queue: DataFrame, outcomes: DataFrame, sent: datetime) -> DataFrame:
    """New queue: delivered rows get cSendStat '1' and dSentDate."""
    done = outcomes.filter("bSentxxxx").select("sTransNox", F.lit(True).alias("_done")).distinct()
    return (
        queue.join(done, "sTransNox", "left")
        .withColumns(
            {
                "cSendStat": F.when(F.col("_done"), "1").otherwise(F.col("cSendStat")),
                "dSentDate": F.when(F.col("_done"), moment(sent)).otherwise(F.col("dSentDate")),
            }
        )
        .select(*queue.columns)
    )


def upload_master(masters: DataFrame) -> DataFrame:
    """Headers as they are uploaded, with the reset columns."""
    return masters.select(
        "sTransNox", "dTransact", "sReferNox", "dReferDte", F.lit("1").alias("cTranStat"),
        F.lit("1").alias("cDCPTypex"), "sCollctID", F.lit(0).alias("nEntryNox"), "sModified", "dModified",
    )


def upload_projection(details: DataFrame) -> DataFrame:
    """Lines as they are uploaded: payment references and remarks emptied, flags reset."""
    none = F.lit(None).cast("string")
    return details.select(
        "sTransNox", "nEntryNox", "sAcctNmbr", F.lit("").alias("sReferNox"), "cPaymForm",
        none.alias("dPromised"), none.alias("sRemCodex"), F.lit("").alias("sRemarksx"),
        F.lit("1").alias("cIsDCPxxx"), F.lit("0").alias("cIsNwNmbr"), F.lit("0").alias("cIsNwAddx"),
        F.lit("0").alias("cIsNwCltx"), "dModified",
    )


def listed_parts(lines: DataFrame, ties: list[str], per_part: int) -> DataFrame:
    """sTransNox, nPartxxxx (from 0) and ``lines``: the part's lines (nEntryNox and ``ties``) in entry order.

    Transactions of up to LINES_PER_PART lines are listed whole and cut, so that their lines are shuffled once; only longer ones,
    known by a count, are numbered across tasks first. Lines without a transaction are in no part.
    """
    lines = lines.filter(F.col("sTransNox").isNotNull())
    line = F.struct("nEntryNox", *ties)
    long = settle(lines.groupBy("sTransNox").count().filter(F.col("count") > LINES_PER_PART).select("sTransNox"))
    some_long = not long.isEmpty()
    short = lines.join(long, "sTransNox", "left_anti") if some_long else lines
    whole = short.groupBy("sTransNox").agg(F.sort_array(F.collect_list(line)).alias("_lines"))
    last = F.floor((F.size("_lines") - 1) / per_part).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_lines", i * per_part + 1, per_part))
    parts = whole.select("sTransNox", F.posexplode(cut).alias("nPartxxxx", "lines"))
    if not some_long:
        return parts
    placed = dense_position(lines.join(long, "sTransNox", "left_semi"), ["sTransNox"], "nEntryNox", ties, name="_at")
    listed = placed.groupBy("sTransNox", F.floor((F.col("_at") - 1) / per_part).cast("int").alias("nPartxxxx")).agg(
        F.sort_array(F.collect_list(F.struct("_at", line.alias("line")))).alias("_lines")
    )
    return parts.unionByName(listed.select("sTransNox", "nPartxxxx", F.transform("_lines", lambda x: x["line"]).alias("lines")))


def nest_master_detail(
    masters: DataFrame, details: DataFrame, keep_without_lines: bool = True, per_part: int = LINES_PER_PART
) -> DataFrame:
    """One row per part of a transaction: sTransNox, nPartxxxx, master and the lines in entry order.

    Lines without a header are left out; a header without lines has an empty list, or no row when
    ``keep_without_lines`` is off. Parts are cut by the number of lines, whatever their entry numbers,
    so no list holds more than ``per_part`` and no line is dropped.
    """
    others = [c for c in details.columns if c not in ("sTransNox", "nEntryNox")]
    lists = listed_parts(details, others, per_part).withColumnRenamed("lines", "detail")
    heads = masters.select("sTransNox", F.struct(*masters.columns).alias("master"))
    nested = heads.join(lists, "sTransNox", "left" if keep_without_lines else "inner")
    return nested.select(
        "sTransNox",
        F.coalesce("nPartxxxx", F.lit(0)).alias("nPartxxxx"),
        "master",
        F.coalesce("detail", F.array().cast(lists.schema["detail"].dataType)).alias("detail"),
    )
