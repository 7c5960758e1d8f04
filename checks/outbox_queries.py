"""Send queue, documents, retention."""

from pyspark.sql import functions as F

from changeflow.operators import documents, outbox, retention
from changeflow.schemas import CHANGE as CHANGE_SCHEMA
from changeflow.session import new_folder, settle
from changeflow.sources import batches
from changeflow.sources import documents as document_source
from changeflow.sources.runs import Runs
from changeflow.streaming import outbox as outbox_stream_job

from .registry import AS_OF, NOW, query

QUEUE = "sTransNox, sSourceNo, sSourceCD, cTranStat, cSendStat, dSentDate"
CHANGE = "sTransNox, sBranchCd, sStatemnt, sTableNme, sDestinat, sModified, dEntryDte, dModified"

OWN = "M001"


@query(
    "pending_outbox",
    """select sTransNox, sSourceNo, sSourceCD, cTranStat from v_queue
        where sTransNox like 'M001%' and cSendStat = '0' order by sTransNox""",
)
def pending_outbox(t):
    return outbox.pending_outbox(t.queue, OWN)


REASON = """case when sSourceCD <> 'DCPx' then 'Source code has no handler.'
                 when cTranStat <> '1' then 'Transaction status is not for upload.' end"""


@query("dispatch_by_source", f"select {QUEUE}, {REASON} as sReasonxx from v_queue")
def dispatch_by_source(t):
    return outbox.dispatch_by_source(t.queue)


OUTCOMES = f"""
    select sTransNox, sSourceNo, cTranStat, problem is null as bSentxxxx, coalesce(problem, 'uploaded successfully.') as sMessagex
      from (select q.*, coalesce({REASON},
                   case when not exists (select 1 from v_sheet s where s.sTransNox = q.sSourceNo and s.sModified <> 'U3')
                        then 'Transaction given does not exist.' end,
                   case when sTransNox like 'C%' then 'no reply' when cast(right(sTransNox, 2) as int) % 10 = 3 then 'refused' end) as problem
              from v_queue q where cSendStat = '0') x"""


def outcomes(t):
    waiting = outbox.dispatch_by_source(t.queue.filter("cSendStat = '0'"))
    # The receiver does not answer for one area, and refuses a tenth of the rest, once and in vain.
    refused = F.col("sTransNox").substr(-2, 2).cast("int") % 10 == 3
    replies = waiting.filter(~F.col("sTransNox").startswith("C")).select(
        "sTransNox", F.when(refused, "error").otherwise("success").alias("sResultxx"), F.when(refused, "refused").alias("sMessagex")
    )
    return outbox.delivery_outcomes(waiting, t.sheet.filter("sModified <> 'U3'"), replies.unionByName(replies))


@query("delivery_outcomes", OUTCOMES)
def delivery_outcomes(t):
    return outcomes(t)


@query(
    "ordered_delivery",
    f"""with told as ({OUTCOMES}), stops as (select left(sTransNox, 4) as branch, min(sTransNox) as stop from told where not bSentxxxx group by 1)
        select t.*, case when stop is null or sTransNox < stop then 'sent' when sTransNox = stop then 'failed' else 'held' end as sFatexxxx
          from told t left join stops s on left(t.sTransNox, 4) = s.branch""",
)
def ordered_delivery(t):
    return outbox.deliver_in_order(outcomes(t))


# A branch's rows before the first that fails for good; the refusals of the first run are lifted in the second one.
@query(
    "outbox_stream",
    """with told as (select q.sTransNox, q.sSourceNo, s.sTransNox is null or q.sTransNox like 'C%' as fails
                       from (select * from v_queue where cSendStat = '0' and sSourceCD = 'DCPx' and cTranStat = '1') q
                       left join (select * from v_sheet where sModified <> 'U3') s on s.sTransNox = q.sSourceNo),
             stops as (select left(sTransNox, 4) as branch, min(sTransNox) as stop from told where fails group by 1)
        select sTransNox, sSourceNo from told t left join stops s on left(t.sTransNox, 4) = s.branch where stop is null or sTransNox < stop""",
)
def outbox_stream(t):
    """Rows that can be uploaded, in four files, a branch in one; two runs, with refusals in the first that are lifted in the second."""
    spark, masters = t.spark, settle(t.sheet.filter("sModified <> 'U3'"))
    folders = {name: new_folder(spark, name) for name in ("queue", "state", "stream")}
    able = t.queue.filter("cSendStat = '0' AND sSourceCD = 'DCPx' AND cTranStat = '1'").select(*outbox_stream_job.QUEUE.names)
    able.repartition(4, F.substring("sTransNox", 1, 4)).write.parquet(folders["queue"])
    for refusing in (True, False):

        def attempt(rows, refusing=refusing):
            refused = F.lit(refusing) & (F.col("sTransNox").substr(-2, 2).cast("int") % 10 == 3)
            replies = rows.filter(~F.col("sTransNox").startswith("C")).select(
                "sTransNox", F.when(refused, "error").otherwise("success").alias("sResultxx"), F.when(refused, "refused").alias("sMessagex")
            )
            return outbox.delivery_outcomes(rows, masters, replies)

        job = outbox_stream_job.Delivery(spark, folders["state"], attempt, NOW)
        outbox_stream_job.stream_outbox(job, folders["queue"], folders["stream"], files_per_batch=2).awaitTermination()
    return job.delivered().select("sTransNox", "sSourceNo")


@query(
    "mark_sent",
    f"""select q.sTransNox, q.sSourceNo, sSourceCD, q.cTranStat, case when bSentxxxx then '1' else cSendStat end as cSendStat,
               case when bSentxxxx then timestamp '2001-06-01 12:30:00' else dSentDate end as dSentDate
          from v_queue q left join ({OUTCOMES}) o on q.sTransNox = o.sTransNox""",
)
def mark_sent(t):
    return outbox.mark_sent(t.queue, outcomes(t), NOW)


@query(
    "upload_projection",
    """select sTransNox, nEntryNox, sAcctNmbr, '' as sReferNox, cPaymForm, cast(null as varchar) as dPromised,
              cast(null as varchar) as sRemCodex, '' as sRemarksx, '1' as cIsDCPxxx, '0' as cIsNwNmbr, '0' as cIsNwAddx,
              '0' as cIsNwCltx, dModified from v_line""",
)
def upload_projection(t):
    return outbox.upload_projection(t.line)


@query(
    "upload_master",
    """select sTransNox, dTransact, sReferNox, dReferDte, '1' as cTranStat, '1' as cDCPTypex, sCollctID, 0 as nEntryNox,
              sModified, dModified from v_sheet""",
)
def upload_master(t):
    return outbox.upload_master(t.sheet)


@query(
    "nest_master_detail",
    """select s.sTransNox, coalesce(part, 0) as nPartxxxx, s.sReferNox, coalesce(n, 0) as nLinesxxx,
              coalesce(lines, '[]') as sDetailxx
         from v_sheet s left join (
              select sTransNox, cast((place - 1) // 4 as integer) as part, cast(count(*) as integer) as n,
                     concat('[', string_agg(concat('{"nEntryNox":', nEntryNox, ',"sAcctNmbr":"', sAcctNmbr, '","cPaymForm":"',
                            cPaymForm, '"}'), ',' order by nEntryNox, sAcctNmbr, cPaymForm), ']') as lines
                from (select *, row_number() over (partition by sTransNox order by nEntryNox, sAcctNmbr, cPaymForm) as place from v_line) l
               group by 1, 2) d on s.sTransNox = d.sTransNox""",
)
def nest_master_detail(t):
    lines = t.line.select("sTransNox", "nEntryNox", "sAcctNmbr", "cPaymForm")
    # Short parts, so that documents of several parts occur.
    nested = outbox.nest_master_detail(outbox.upload_master(t.sheet), lines, per_part=4)
    return nested.select(
        "sTransNox", "nPartxxxx", "master.sReferNox", F.size("detail").alias("nLinesxxx"), F.to_json("detail").alias("sDetailxx")
    )


IMAGE = "sClientID, sImageNme, sMD5Hashx, dImgeDate, sImagePth, cImgeStat, sScanndID"


@query("pending_documents", f"select {IMAGE}, body from v_image where cImgeStat = '0' order by dImgeDate")
def pending_documents(t):
    return documents.pending_documents(t.image)


FILED = """
    select cast(floor(doc_id / 100) as bigint) as nFilexxxx, string_agg(text, chr(10) order by doc_id) || chr(10) as body
      from documents group by 1"""


def write_files(t):
    """A hundred documents to a file."""
    path = new_folder(t.spark, "scans")
    texts = t.sql("select cast(floor(doc_id / 100) as bigint) as nFilexxxx, doc_id, text from documents")
    filed = texts.repartition("nFilexxxx").sortWithinPartitions("nFilexxxx", "doc_id")
    filed.select("nFilexxxx", "text").write.partitionBy("nFilexxxx").text(path)
    return path


@query(
    "file_summary",
    f"""select printf('%.2f', floor(strlen(body) / 1024 * 100 + 0.5) / 100) as sFileSize, md5(body) as sMD5Hashx from ({FILED}) f""",
)
def file_summary(t):
    return batches.file_summary(t.spark, write_files(t)).select("sFileSize", "sMD5Hashx")


@query("read_documents", f"select nFilexxxx, strlen(body) as nBytesxxx, md5(body) as sMD5Hashx from ({FILED}) f where nFilexxxx % 3 <> 1")
def read_documents(t):
    # The manifest gets the names that Spark gave the files; of every third it names one that is not there.
    path = write_files(t)
    listed = t.spark.read.format("binaryFile").load(path).select("path", "nFilexxxx")
    bare = F.regexp_replace("path", "^file:(//)?", "")
    images = listed.select(
        F.col("nFilexxxx").cast("long"), F.regexp_extract(bare, "^(.*)/[^/]*$", 1).alias("sImagePth"),
        F.concat(F.regexp_extract(bare, "([^/]*)$", 1), F.when(F.col("nFilexxxx") % 3 == 1, ".gone").otherwise("")).alias("sImageNme"),
    )
    found = document_source.read_documents(t.spark, path, images)
    return found.select("nFilexxxx", F.octet_length("content").cast("long").alias("nBytesxxx"), F.md5("content").alias("sMD5Hashx"))


def payloads(t):
    pending = documents.pending_documents(t.image, ordered=False).withColumn("content", F.encode("body", "UTF-8"))
    return documents.document_payload(pending)


@query(
    "document_payload",
    """select '0002' as "g_edoc_type", sClientID as "g_edoc_ownr", '' as "g_edoc_srcd", '' as "g_edoc_srno",
              sImageNme as "g_edoc_file", sScanndID as "g_edoc_scnr", base64(encode(body)) as "g_edoc_imge",
              case when coalesce(sMD5Hashx, '') = '' then md5(body) else sMD5Hashx end as "g_edoc_hash"
         from v_image where cImgeStat = '0'""",
)
def document_payload(t):
    rows = payloads(t)
    return rows.toDF(*[c.replace("-", "_") for c in rows.columns])


@query("decode_payload", """select sImageNme, strlen(body) as nBytesxxx, md5(body) as sMD5Hashx from v_image where cImgeStat = '0'""")
def decode_payload(t):
    data = F.struct(F.col("`g-edoc-file`").alias("filename"), F.col("`g-edoc-imge`").alias("data"))
    good = payloads(t).select(F.to_json(F.struct(F.lit("success").alias("result"), data.alias("payload"))).alias("value"))
    bad = t.image.filter("cImgeStat = '1'").select(
        F.to_json(
            F.struct(F.lit("error").alias("result"), F.struct(F.lit("9").alias("code"), F.lit("gone").alias("message")).alias("error"))
        ).alias("value")
    )
    decoded = documents.decode_payload(good.unionByName(bad))
    return decoded.select("sImageNme", F.octet_length("content").cast("long").alias("nBytesxxx"), F.md5("content").alias("sMD5Hashx"))


@query(
    "mark_documents_sent",
    f"""select {IMAGE.replace("cImgeStat", "case when sImagePth in ('src1', 'src2') then '1' else cImgeStat end as cImgeStat")}, body
          from v_image""",
)
def mark_documents_sent(t):
    pending = documents.pending_documents(t.image, ordered=False)
    return documents.mark_documents_sent(t.image, pending.filter(F.col("sImagePth").isin("src1", "src2")))


KEPT = """left(sTransNox, 4) = 'M001' or dModified > timestamp '2000-12-01 00:00:00'
          or left(sTransNox, 4) not in (select sBranchCd from v_branch)"""


@query("retain_log", f"select {CHANGE} from v_log where {KEPT}")
def retain_log(t):
    return retention.retain_log(t.log, OWN, AS_OF, t.branch)


@query("purge_log", f"select {CHANGE} from v_log where not ({KEPT})")
def purge_log(t):
    return retention.purge_log(t.log, OWN, AS_OF, t.branch)


@query("purge_files", f"select {CHANGE} from v_log where {KEPT}")
def purge_files(t):
    """The stored log after a purge, in files of one quarter's changes each, some of which go as a whole."""
    log = Runs(t.spark, new_folder(t.spark, "log"), CHANGE_SCHEMA, "sTransNox", rows_per_file=2_000)
    rows = settle(t.log)
    for quarter in range(1, 5):
        log.append(rows.filter(F.quarter("dEntryDte") == quarter), quarter)
    retention.purge_files(log, OWN, AS_OF, step=5, branches=t.branch, files_per_part=8)
    return log.rows()


@query("trim_by_branch", f"select {CHANGE} from v_log where sBranchCd = 'M001' or sBranchCd not in (select sBranchCd from v_branch)")
def trim_by_branch(t):
    return retention.trim_by_branch(t.log, t.branch, OWN)


@query(
    "trim_by_key_prefix",
    f"""select {CHANGE} from v_log where left(sTransNox, 4) = 'M001'
        or left(sTransNox, 4) not in (select sBranchCd from v_branch where cRecdStat = '1')""",
)
def trim_by_key_prefix(t):
    return retention.trim_by_key_prefix(t.log, t.branch.filter("cRecdStat = '1'"), OWN)


@query(
    "trim_plan",
    """select sTableNme, case when bool_or(sGroupxxx in ('common', 'mc')) then 'truncate' when bool_or(sGroupxxx = 'mp_branch') then 'branch'
              when bool_or(sGroupxxx = 'mp_prefix') then 'prefix' else 'keep' end as sActionxx from v_action group by 1""",
)
def trim_plan(t):
    return retention.trim_plan(t.action, "0")
