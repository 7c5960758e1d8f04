"""Scans, windows, manifests."""

from pyspark.sql import functions as F

from changeflow.functions import branch_of, client_prefix, dense_position
from changeflow.operators import windows
from changeflow.plans import push
from changeflow.schemas import CHANGE as CHANGE_SCHEMA
from changeflow.session import new_folder, settle
from changeflow.sources import batches, tables
from changeflow.sources.runs import Runs

from .registry import AS_OF, NOW, query

CHANGE = "sTransNox, sBranchCd, sStatemnt, sTableNme, sDestinat, sModified, dEntryDte, dModified"

BATCH_SQL = f"""
    select concat(substring(sTransNox, 1, 4), '20010601123000') as sFileName,
           row_number() over (partition by substring(sTransNox, 1, 4) order by sTransNox, sModified) as pos, {CHANGE}
      from v_log"""


def numbered_batches(t):
    rows = t.log.withColumn("sFileName", F.concat(branch_of("sTransNox"), F.lit("20010601123000")))
    return dense_position(rows, ["sFileName"], "sTransNox", ["sModified"])


@query("read_change_batch", BATCH_SQL)
def read_change_batch(t):
    path = new_folder(t.spark, "batch")
    batches.write_change_batch(numbered_batches(t), path, layout="array")
    return batches.read_change_batch(t.spark, path)


@query("write_change_batch", BATCH_SQL)
def write_change_batch(t):
    path = new_folder(t.spark, "batch")
    batches.write_change_batch(numbered_batches(t), path)
    return batches.read_change_lines(t.spark, path)


@query("scan_change_log", f"select {CHANGE} from v_log")
def scan_change_log(t):
    path = new_folder(t.spark, "log")
    tables.store_change_log(t.log, path)
    return tables.scan_change_log(t.spark, path, CHANGE.split(", "))


OUT = "sFileName, sLogFromx, sLogThrux, sFileSize, sMD5Hashx, cTranStat, dCreatedx, dExported"


@query(
    "branch_window_scan",
    f"""select {CHANGE} from v_log l where exists (
            select 1 from v_outgoing o where o.cTranStat = '2' and substring(o.sFileName, 1, 4) = substring(l.sTransNox, 1, 4)
               and l.sTransNox between o.sLogFromx and o.sLogThrux)""",
)
def branch_window_scan(t):
    sent = t.outgoing.filter("cTranStat = '2'").select(branch_of("sFileName").alias("branch"), "sLogFromx", "sLogThrux")
    return windows.branch_window_scan(t.log, sent).drop("branch")


@query(
    "branch_scan",
    f"select {CHANGE} from v_log where sTransNox like 'M001%' and sTransNox between 'M001000000000100' and 'M001000000009000'",
)
def branch_scan(t):
    return windows.branch_scan(t.log, "M001", "M001000000000100", "M001000000009000")


@query("hosted_branches", "select sBranchCD from v_branch_others where xBranchCD = 'M001' order by 1")
def hosted_branches(t):
    return windows.hosted_branches(t.branch_others, "M001")


@query(
    "client_prefix",
    """select c.sClientID, right(c.sClientID, 4) as sPrefixxx, left(l.sTransNox, 4) as branch, left(l.sTransNox, 1) as sAreaxxxx,
              count(*) as nRowsxxxx
         from v_client c join v_log l on right(c.sClientID, 4) = left(l.sTransNox, 4) group by 1, 2, 3, 4""",
)
def client_prefix_query(t):
    clients = t.client.select("sClientID", client_prefix("sClientID").alias("sPrefixxx"))
    keys = t.log.select(branch_of("sTransNox").alias("branch"), F.substring("sTransNox", 1, 1).alias("sAreaxxxx"))
    counts = keys.groupBy("branch", "sAreaxxxx").agg(F.count("*").alias("nRowsxxxx"))
    return clients.join(counts, F.col("sPrefixxx") == F.col("branch"))


@query("last_key_per_branch", "select substring(sTransNox, 1, 4) as branch, max(sTransNox) as sLastKey from v_log group by 1")
def last_key_per_branch(t):
    return windows.last_key_per_branch(t.log)


LAST_SENT = """
    select * from (select *, substring(sFileName, 1, 4) as branch,
                          row_number() over (partition by substring(sFileName, 1, 4) order by dCreatedx desc, sFileName desc) as rn
                     from v_outgoing where cTranStat in ('2', '4')) x where rn = 1"""

TOUCHED = """
    select b.branch, min(l.sTransNox) as sTouched from last_sent b
      join v_log l on l.sTransNox between b.sLogFromx and b.sLogThrux and l.dModified >= b.dCreatedx group by 1"""


@query("first_touched_key", f"with last_sent as ({LAST_SENT}) {TOUCHED}")
def first_touched_key(t):
    return windows.first_touched_key(t.log, windows.latest_batch_in_states(t.outgoing, ["2", "4"], "dCreatedx"))


@query(
    "latest_batch",
    f"""select branch, {OUT} from (select *, substring(sFileName, 1, 4) as branch,
               row_number() over (partition by substring(sFileName, 1, 4) order by sFileName desc) as rn
          from v_outgoing where sMD5Hashx <> '') x where rn = 1""",
)
def latest_batch(t):
    return windows.latest_batch(t.outgoing)


@query("latest_batch_in_states", f"select branch, {OUT} from ({LAST_SENT}) y")
def latest_batch_in_states(t):
    return windows.latest_batch_in_states(t.outgoing, ["2", "4"], "dCreatedx")


WINDOW_SQL = f"""
    with last_sent as ({LAST_SENT}), touched as ({TOUCHED}),
    last_key as (select substring(sTransNox, 1, 4) as branch, max(sTransNox) as thru from v_log group by 1),
    start_key as (select sBranchCd as branch, min(sExportNo) as start from v_client group by 1),
    known as (select branch from last_key union select branch from start_key union select branch from last_sent),
    bounds as (
      select k.branch, coalesce(t.sTouched, s.sLogThrux, c.start, '') as sLogFromx, coalesce(l.thru, '') as sLogThrux
        from known k left join last_sent s on k.branch = s.branch left join touched t on k.branch = t.branch
        left join start_key c on k.branch = c.branch left join last_key l on k.branch = l.branch),
    export_windows as (
      select branch, sLogFromx, sLogThrux, sLogFromx <> '' and sLogThrux <> '' and sLogFromx < sLogThrux as is_pending
        from bounds)"""


@query("export_window", f"{WINDOW_SQL} select * from export_windows")
def export_window(t):
    return windows.export_window(t.log, t.outgoing, t.client)


@query("export_window_kept", f"{WINDOW_SQL} select * from export_windows")
def export_window_kept(t):
    """The log in a run for each quarter, whose zones tell the last keys and where changes since the last batch are."""
    log = Runs(t.spark, new_folder(t.spark, "log"), CHANGE_SCHEMA, "sTransNox", rows_per_file=2_000)
    rows = settle(t.log)
    for quarter in range(1, 5):
        log.append(rows.filter(F.quarter("dEntryDte") == quarter), quarter)
    return windows.export_window_kept(log, t.outgoing, t.client)


BATCHES_SQL = f"""{WINDOW_SQL}, rows_out as (
      select concat(w.branch, '20010601123000') as sFileName, l.*
        from v_log l join export_windows w on substring(l.sTransNox, 1, 4) = w.branch
         and l.sTransNox between w.sLogFromx and w.sLogThrux where w.is_pending)"""

CHECKSUM = "'0x' || substring(md5(concat_ws(chr(31), {}))::varchar, 1, 15)".format(
    ", ".join(f"coalesce(cast({c} as varchar), chr(0))" for c in CHANGE.split(", "))
)


@query(
    "create_batches",
    f"""{BATCHES_SQL} select sFileName, row_number() over (partition by sFileName order by sTransNox, sModified) as pos,
        {CHANGE} from rows_out""",
)
def create_batches(t):
    rows, _ = windows.create_batches(t.log, windows.export_window(t.log, t.outgoing, t.client), NOW)
    return rows.drop("branch")


@query(
    "create_batches_manifest",
    f"""{BATCHES_SQL} select sFileName, min(sTransNox) as sLogFromx, max(sTransNox) as sLogThrux, count(*) as nRowsxxxx,
        cast(sum(cast({CHECKSUM} as bigint)) as varchar) as sCheckSum from rows_out group by 1""",
)
def create_batches_manifest(t):
    _, summary = windows.create_batches(t.log, windows.export_window(t.log, t.outgoing, t.client), NOW)
    return summary


UNFINISHED = """
    select * from (select *, row_number() over (partition by substring(sFileName, 1, 4) order by sFileName desc) as rn
                     from v_outgoing where sMD5Hashx <> '') x where rn = 1 and cTranStat in ('0', '1')"""


@query(
    "push_manifest",
    f"""{BATCHES_SQL}, open_batches as ({UNFINISHED})
        select sFileName, sLogFromx, sLogThrux, sMD5Hashx <> '' as bHashedxx, cTranStat, dCreatedx, dExported, 'known' as sTodoxxxx
          from v_outgoing where sFileName not in (select sFileName from open_batches)
        union all
        select sFileName, sLogFromx, sLogThrux, true, cTranStat, dCreatedx, dExported,
               case cTranStat when '0' then 'announce' else 'send' end from open_batches
        union all
        select sFileName, min(sTransNox), max(sTransNox), true, '0', timestamp '2001-06-01 12:30:00', cast(null as timestamp), 'announce'
          from rows_out where substring(sFileName, 1, 4) not in (select substring(sFileName, 1, 4) from open_batches) group by 1""",
)
def push_manifest(t):
    """The manifest after a push, and what each batch needs next. Hashes depend on the bytes of gzip, so only their presence is held."""
    pushed = push.push(t.log, t.outgoing, t.client, NOW, new_folder(t.spark, "push"))
    todo = pushed.announce.select("sFileName", F.lit("announce").alias("_todo")).unionByName(
        pushed.send.select("sFileName", F.lit("send").alias("_todo"))
    )
    hashed = F.when(F.col("cTranStat") != "0", F.col("sMD5Hashx") != "").otherwise(F.col("sMD5Hashx").rlike("^[0-9a-f]{32}$") & (F.col("sFileSize").cast("double") > 0))
    return pushed.outgoing.join(todo, "sFileName", "left").select(
        "sFileName", "sLogFromx", "sLogThrux", hashed.alias("bHashedxx"), "cTranStat", "dCreatedx", "dExported",
        F.coalesce("_todo", F.lit("known")).alias("sTodoxxxx"),
    )


@query(
    "batch_summary",
    f"""select concat(substring(sTransNox, 1, 4), '20010601123000') as sFileName, min(sTransNox) as sLogFromx,
        max(sTransNox) as sLogThrux, count(*) as nRowsxxxx,
        cast(sum(cast({CHECKSUM} as bigint)) as varchar) as sCheckSum from v_log group by 1""",
)
def batch_summary(t):
    return windows.batch_summary(t.log.withColumn("sFileName", F.concat(branch_of("sTransNox"), F.lit("20010601123000"))))


@query(
    "advance_outgoing",
    """select sFileName, sLogFromx, sLogThrux, sFileSize, sMD5Hashx,
              case cTranStat when '0' then '1' when '1' then '2' when '2' then '2' else cTranStat end as cTranStat, dCreatedx,
              case when cTranStat = '1' then dCreatedx + interval '2' day else dExported end as dExported
         from v_outgoing""",
)
def advance_outgoing(t):
    # State 0 is announced, 1 verified; 2 and 4 get an announcement they must refuse.
    event = F.when(F.col("cTranStat") == "1", "verified").otherwise("announced")
    given = t.outgoing.select(
        "sFileName", event.alias("sEvent"), (F.col("dCreatedx") + F.expr("interval '2' day")).alias("dEventxxx")
    )
    return windows.advance_outgoing(t.outgoing, given)


@query(
    "advance_incoming",
    """select sFileName, sMD5Hashx, sFileSize, dCreatedx, case cTranStat when '0' then '1' when '1' then '2' end as cTranStat,
              case when cTranStat = '0' then dCreatedx + interval '1' day else dReceived end as dReceived,
              case when cTranStat = '1' then dCreatedx + interval '1' day else dImported end as dImported
         from v_inbox""",
)
def advance_incoming(t):
    event = F.when(F.col("cTranStat") == "0", "received").otherwise("imported")
    given = t.inbox.select(
        "sFileName", event.alias("sEvent"), (F.col("dCreatedx") + F.expr("interval '1' day")).alias("dEventxxx")
    )
    return windows.advance_incoming(t.inbox, given)


ARCHIVE = """
    with ends as (select substring(sFileName, 1, 4) as branch,
              max(case when cTranStat = '4' then sFileName end) as f4,
              max(case when cTranStat = '2' and dExported < timestamp '2001-06-01 00:00:00' then sFileName end) as f2
         from v_outgoing group by 1),
    archive_windows as (
       select e.branch, coalesce(f4, e.branch) as sFileFrom, f2 as sFileThru, coalesce(a.sLogThrux, e.branch) as sLogFromx, b.sLogThrux
         from ends e left join v_outgoing a on a.sFileName = f4 join v_outgoing b on b.sFileName = f2
        where coalesce(f4, e.branch) < f2)"""

# A branch of the area C was archived four days ago, the others nine days ago.
DUE = "substring(branch, 1, 1) <> 'C'"


@query("archive_window", f"{ARCHIVE} select * from archive_windows where {DUE}")
def archive_window(t):
    last = t.outgoing.select(branch_of("sFileName").alias("branch")).distinct()
    days = F.when(F.col("branch").startswith("C"), F.date_sub(F.lit(AS_OF), 4)).otherwise(F.date_sub(F.lit(AS_OF), 9))
    return windows.archive_window(t.outgoing, AS_OF, last.withColumn("dLastRunx", days))


@query(
    "mark_archived",
    f"""{ARCHIVE} select sFileName, o.sLogFromx, o.sLogThrux, sFileSize, sMD5Hashx,
        case when cTranStat = '2' and sFileName between a.sFileFrom and a.sFileThru then '4' else cTranStat end as cTranStat,
        dCreatedx, dExported from v_outgoing o left join archive_windows a on substring(sFileName, 1, 4) = a.branch""",
)
def mark_archived(t):
    return windows.mark_archived(t.outgoing, windows.archive_window(t.outgoing, AS_OF))


@query(
    "delete_chunks",
    """select branch, nChunkxxx, min(sTransNox) as sStartKey, max(sTransNox) as sStopKeyx, count(*) as nKeysxxxx
         from (select substring(sTransNox, 1, 4) as branch, sTransNox,
                      (row_number() over (partition by substring(sTransNox, 1, 4) order by sTransNox) - 1) // 50 as nChunkxxx
                 from v_log) x group by 1, 2""",
)
def delete_chunks(t):
    return windows.delete_chunks(t.log, 50)
