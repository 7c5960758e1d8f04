"""Inbox, duplicates, errors, applying."""

from pyspark.sql import functions as F

from changeflow.functions import branch_of, dense_position, statement_text
from changeflow.operators import ingest, statements
from changeflow.plans import pull
from changeflow.schemas import CHANGE as CHANGE_SCHEMA
from changeflow.session import new_folder, settle
from changeflow.sources import batches
from changeflow.sources.partitions import Partitions
from changeflow.sources.runs import Runs
from changeflow.streaming import inbox

from .registry import NOW, query

ROW = "sFileName, pos, dReceived, sTransNox, sBranchCd, sStatemnt, sTableNme, sDestinat, sModified, dEntryDte, dModified, nErrorNox"
CHANGE = "sTransNox, sBranchCd, sStatemnt, sTableNme, sDestinat, sModified, dEntryDte, dModified"
OUTCOME = """case when nErrorNox = 0 then 'ok'
                  when nErrorNox in (1022, 1062, 1690, 1264, 1406, 1064, 1072, 1060) then 'ignore' else 'report' end"""
SEEN = "exists (select 1 from v_seen s where s.sTransNox = i.sTransNox and s.sModified = i.sModified)"

# Rows per commit; positions in the files have gaps, so a file of a few hundred rows spans many commits.
CHUNK = 10_000


@query("pending_imports", "select * from v_inbox where cTranStat = '1' order by dReceived")
def pending_imports(t):
    return ingest.pending_imports(t.inbox)


@query(
    "register_incoming",
    """select sFileName, sMD5Hashx, sFileSize, dCreatedx, cTranStat, dReceived, dImported from v_inbox where cTranStat = '1'
       union all select sFileName, sMD5Hashx, sFileSize, dCreatedx, '0', null, null from v_inbox where cTranStat = '0'""",
)
def register_incoming(t):
    announced = t.inbox.select("sFileName", "sMD5Hashx", "sFileSize", "dCreatedx")
    return ingest.register_incoming(t.inbox.filter("cTranStat = '1'"), announced.unionByName(announced))


@query(
    "hash_reconcile",
    """select coalesce(a.sFileName, b.sFileName) as sFileName,
              case when a.sFileName is null then 'missing here' when b.sFileName is null then 'missing there'
                   when coalesce(a.sMD5Hashx, '') = '' or coalesce(b.h, '') = '' then 'no hash'
                   when lower(a.sMD5Hashx) = lower(b.h) then 'match' else 'mismatch' end as sStatusxx
         from (select * from v_outgoing where cTranStat <> '0') a
         full join (select sFileName, case when cTranStat = '1' then 'x' when cTranStat = '4' then null else upper(sMD5Hashx) end as h
                      from v_outgoing where left(sFileName, 1) = 'M') b on a.sFileName = b.sFileName""",
)
def hash_reconcile(t):
    told = F.when(F.col("cTranStat") == "1", "x").when(F.col("cTranStat") != "4", F.upper("sMD5Hashx"))
    peer = t.outgoing.filter(F.col("sFileName").startswith("M")).withColumn("sMD5Hashx", told)
    return ingest.hash_reconcile(t.outgoing.filter("cTranStat <> '0'"), peer)


@query("drop_seen_changes", f"select {ROW} from v_incoming i where not {SEEN}")
def drop_seen_changes(t):
    return ingest.drop_seen_changes(t.incoming, t.seen).select(*ROW.split(", "))


@query("seen_by_zones", f"select {ROW} from v_incoming i where not {SEEN}")
def seen_by_zones(t):
    """The log in four runs of small files, one for each quarter."""
    log = Runs(t.spark, new_folder(t.spark, "log"), CHANGE_SCHEMA, "sTransNox", rows_per_file=2_000)
    seen = settle(t.seen)
    for quarter in range(1, 5):
        log.append(seen.filter(F.quarter("dEntryDte") == quarter), quarter)
    return ingest.drop_seen_by_zones(t.incoming, log).select(*ROW.split(", "))


FIRST = """select *, row_number() over (partition by sTransNox, sModified order by dReceived, sFileName, pos) as rn
             from v_incoming where nErrorNox = 0"""


@query("drop_repeats_in_batch", f"select {ROW} from ({FIRST}) x where rn = 1")
def drop_repeats_in_batch(t):
    return ingest.drop_repeats_in_batch(t.incoming)


@query("classify_errors", f"select {ROW}, {OUTCOME} as sOutcomex from v_incoming")
def classify_errors(t):
    return ingest.classify_errors(t.incoming)


@query(
    "error_report",
    f"""select substring(sFileName, 1, 4) as sBranchCD, sFileName, sTransNox as sRefernox, nErrorNox,
               concat('error ', nErrorNox, ' at ', sTransNox) as sDescript,
               case when {OUTCOME} = 'report' and pos % 2 = 0 then 'ignore' else {OUTCOME} end as sOutcomex
          from v_incoming where nErrorNox <> 0""",
)
def error_report(t):
    rows = t.incoming.withColumn("sDescript", F.format_string("error %d at %s", "nErrorNox", "sTransNox"))
    # The watchers let every other reported row pass.
    answered = rows.filter("nErrorNox <> 0").select(
        "sFileName", F.col("sTransNox").alias("sRefernox"), "nErrorNox", F.when(F.col("pos") % 2 == 0, "Ignore").otherwise("Hold").alias("sResponse")
    )
    return ingest.error_report(ingest.classify_errors(rows, verdicts=answered))


@query(
    "error_summary",
    f"""select sFileName, left(sTransNox, 4) as branch, nErrorNox, {OUTCOME} as sOutcomex, count(*) as nRowsxxxx
          from v_incoming where nErrorNox <> 0 group by all""",
)
def error_summary(t):
    return ingest.error_summary(ingest.classify_errors(t.incoming))


STOPS = f"""select sFileName, min(case when {OUTCOME} = 'report' then pos end) as stop, max(pos) as last_pos
              from v_incoming group by 1"""


@query(
    "import_progress",
    f"""select sFileName, stop as nStopPosx, last_pos as nLastPosx, coalesce((stop - 1) // {CHUNK} * {CHUNK}, last_pos) as nDurablex,
               coalesce((stop - 1) // {CHUNK} * {CHUNK}, last_pos) + 1 as nResumexx from ({STOPS}) s""",
)
def import_progress(t):
    return ingest.import_progress(ingest.classify_errors(t.incoming), CHUNK)


PREFIX = f"""
    select i.*, {OUTCOME} as sOutcomex, s.stop is null or i.pos <= (s.stop - 1) // {CHUNK} * {CHUNK} as bDurablex
      from v_incoming i join ({STOPS}) s on i.sFileName = s.sFileName where s.stop is null or i.pos < s.stop"""


@query("accepted_prefix", f"select {ROW}, sOutcomex, bDurablex from ({PREFIX}) p")
def accepted_prefix(t):
    return ingest.accepted_prefix(ingest.classify_errors(t.incoming), CHUNK)


@query(
    "append_change_log",
    f"""select {CHANGE} from v_seen union all
        select {CHANGE.replace("dModified", "timestamp '2001-06-01 12:30:00'")} from ({FIRST}) i where rn = 1 and not {SEEN}""",
)
def append_change_log(t):
    fresh = ingest.drop_seen_changes(ingest.drop_repeats_in_batch(t.incoming), t.seen)
    return ingest.append_change_log(t.seen, fresh, NOW)


PULLED = f"""
    select *, row_number() over (partition by sTransNox, sModified order by dReceived, sFileName, pos) as rn
      from ({PREFIX}) p where bDurablex and nErrorNox = 0"""


@query(
    "import_batches",
    f"""select {CHANGE} from v_seen union all
        select {CHANGE.replace("dModified", "timestamp '2001-06-01 12:30:00'")} from ({PULLED}) i where rn = 1 and not {SEEN}""",
)
def import_batches(t):
    return pull.pull(t.incoming, t.seen, NOW, CHUNK).log


APPLIED = """with latest as (select * from (select *, row_number() over (partition by sTableNme, sRecordKy
                              order by dModified desc, sTransNox desc) as rn from v_change) x where rn = 1)
       select coalesce(l.sTableNme, r.sTableNme) as sTableNme, coalesce(l.sRecordKy, r.sRecordKy) as sRecordKy,
              case when l.sRecordKy is null then r.nValuexxx else l.nValuexxx end as nValuexxx
         from v_record r full join latest l on r.sTableNme = l.sTableNme and r.sRecordKy = l.sRecordKy
        where coalesce(l.sActionxx, '') <> 'delete'"""


@query("apply_changes", APPLIED)
def apply_changes(t):
    return ingest.apply_changes(t.record, t.change, ["sTableNme", "sRecordKy"])


@query("apply_to_partitions", APPLIED)
def apply_to_partitions(t):
    """The changes of one table after the other, each an update of the partitions that they touch."""
    keys = ["sTableNme", "sRecordKy"]
    records, changes = settle(t.record), settle(t.change)
    table = Partitions(t.spark, new_folder(t.spark, "records"), records.schema, keys, parts=16)
    table.create(records)
    for name in sorted(r.sTableNme for r in changes.select("sTableNme").distinct().collect()):
        table.update(changes.filter(F.col("sTableNme") == name), lambda rows, events: ingest.apply_changes(rows, events, keys))
    return table.rows()


# The oracle takes verb and table from what the log was made of, not from the text.
@query(
    "statement_profile",
    """select left(sTransNox, 4) as branch, cast(dEntryDte as date) as dEntryDay,
              case o_orderstatus when 'F' then 'INSERT' when 'O' then 'UPDATE' else 'DELETE' end as sVerbxxxx,
              o_orderstatus in ('F', 'O') as bSameTabl, count(*) as nRowsxxxx
         from v_log join orders on cast(substring(sTransNox, 5, 12) as bigint) = o_orderkey group by all""",
)
def statement_profile(t):
    return ingest.statement_profile(t.log)


# Likewise: what each form of statement says, from the columns that it was written from.
FORMS = """
    select *, 1 as part, case when form <= 2 then 'set' when form <= 4 then 'alter' when form <= 5 then 'drop' end as kind,
           case form when 0 then concat('dTransact=', day, '|nAmountxx=', amount, '|sAcctNmbr=', acct, '|sRemarksx=', remark)
                     when 1 then concat('nAmountxx=-', amount, '.5e0|sAcctNmbr=', acct, '|sRemarksx=', remark)
                     when 2 then concat('nAmountxx=', amount, '|sAcctNmbr=', acct, '|sRemarksx')
                     when 3 then concat('nAmountxx|sRemarksx=', remark) when 4 then concat('NAMOUNTXX=', amount)
                     when 5 then '' when 6 then '' end as said,
           case when form in (3, 4, 5) then concat('sAcctNmbr=', acct) when form = 6 then concat('dTransact=', day, '|sAcctNmbr=', acct)
                when form <= 2 then '' end as held,
           case form when 7 then 'value' when 8 then 'no key' when 9 then 'verb' when 10 then 'open quote' when 11 then 'columns' when 12 then 'condition'
                     when 13 then 'several statements' end as problem
      from v_written
    union all
    select *, 2, 'set', concat('nAmountxx=', amount, '|sAcctNmbr=', next_acct, '|sRemarksx=', remark), '', null from v_written where form = 2"""


@query(
    "parse_statements",
    f"""select sTransNox, part as nPartxxxx, case when form = 9 then '' when form in (0, 1, 10, 11) then 'INSERT' when form = 2 then 'REPLACE'
                                                   when form in (5, 6, 13) then 'DELETE' else 'UPDATE' end as sVerbxxxx,
               case when form between 1 and 3 then 'node' end as sSchemaxx,
               case when form = 4 then 'account_note' when form <> 9 then 'Account_Note' end as sTargetTb, said as sValuesxx, held as sKeyxxxxx, problem as sProblemx
          from ({FORMS}) f""",
)
def parse_statements(t):
    parsed = statements.parse_statements(t.statement)
    texts = [statement_text.map_text(F.col(m)).alias(n) for m, n in (("mValuesxx", "sValuesxx"), ("mKeyxxxxx", "sKeyxxxxx"))]
    return parsed.select("sTransNox", "nPartxxxx", "sVerbxxxx", "sSchemaxx", "sTargetTb", *texts, "sProblemx")


@query(
    "apply_statements",
    f"""with made as (
          select case when part = 2 then next_acct else acct end as sAcctNmbr, kind, [strftime(dModified, '%Y-%m-%d %H:%M:%S'), sTransNox, part::varchar] as o,
                 case when form = 2 and part = 1 then null else remark end as r,
                 case form when 1 then -cast(concat(amount, '.5') as double) when 3 then null else cast(amount as double) end as a,
                 case form when 0 then cast(day as date) end as d, form from ({FORMS}) f where form <= 5),
        whole as (select sAcctNmbr, max(o) as made_at from made where kind <> 'alter' group by 1),
        base as (select m.sAcctNmbr, r as sRemarksx, a as nAmountxx, d as dTransact, w.made_at, kind from made m join whole w on m.sAcctNmbr = w.sAcctNmbr and m.o = w.made_at
                 union all select n.*, [''] as made_at, 'set' from v_note n where not exists (select 1 from whole w where w.sAcctNmbr = n.sAcctNmbr)),
        later as (select m.*, max(case when form = 3 then o end) over (partition by m.sAcctNmbr) as last_remark,
                         max(o) over (partition by m.sAcctNmbr) as last_amount
                    from made m join base b on m.sAcctNmbr = b.sAcctNmbr and m.o > b.made_at and m.kind = 'alter'),
        remarks as (select sAcctNmbr, r from later where o = last_remark), amounts as (select sAcctNmbr, a from later where o = last_amount)
        select b.sAcctNmbr, case when r.sAcctNmbr is null then b.sRemarksx else r.r end as sRemarksx,
               case when a.sAcctNmbr is null then b.nAmountxx else a.a end as nAmountxx, b.dTransact
          from base b left join remarks r on r.sAcctNmbr = b.sAcctNmbr left join amounts a on a.sAcctNmbr = b.sAcctNmbr where kind = 'set'""",
)
def apply_statements(t):
    return statements.apply_statements(t.note, statements.parse_statements(t.statement), "Account_Note", ["sAcctNmbr"])


# Once the errors that stopped batches are lifted, every row arrives but those with an ignored code.
STREAMED = f"""
    select distinct sTransNox, sModified, sTableNme, left(sTransNox, 4) as branch from v_incoming where {OUTCOME} <> 'ignore'"""


@query("stream_import", STREAMED)
def stream_import(t):
    """Two runs: the first stops batches at their errors, the second finds these lifted and no new notice."""
    spark = t.spark
    folders = {name: new_folder(spark, name) for name in ("inbox", "errors", "lifted", "notices", "log", "state", "stream")}
    numbered = dense_position(t.incoming.drop("pos").withColumnRenamed("nErrorNox", "_code"), ["sFileName"], "sTransNox", ["sModified", "_code"])
    batches.write_change_batch(numbered, folders["inbox"], gathered=True, level="BEST_SPEED")
    codes = numbered.select("sFileName", "pos", F.col("_code").cast("int").alias("nErrorNox")).filter("nErrorNox <> 0")
    codes.write.parquet(folders["errors"])
    codes = spark.read.schema(inbox.ERRORS).parquet(folders["errors"])
    codes.filter(F.col("nErrorNox").isin(*ingest.IGNORED_ERRORS)).write.parquet(folders["lifted"])
    notices = numbered.groupBy("sFileName").agg(F.min("dReceived").cast("timestamp_ntz").alias("dReceived"))
    notices.repartition(4, "sFileName").write.json(folders["notices"])
    for errors in ("errors", "lifted"):
        job = inbox.Import(spark, folders["inbox"], folders[errors], folders["log"], folders["state"], NOW, chunk=100)
        inbox.stream_import(job, folders["notices"], folders["stream"], files_per_batch=2).awaitTermination()
    return job.logged().select("sTransNox", "sModified", "sTableNme", branch_of("sTransNox").alias("branch"))


WHOLE_FILES = f"""
    select sFileName, min(case when {OUTCOME} = 'report' then pos end) is null as whole from v_incoming group by 1"""


@query(
    "pull_manifest",
    f"""select m.sFileName, m.sMD5Hashx, m.sFileSize, m.dCreatedx,
               case when m.cTranStat = '1' and f.whole then '2' when m.cTranStat = '1' or hashed then '1' else '0' end as cTranStat,
               case when m.cTranStat = '1' then m.dReceived when hashed then timestamp '2001-06-01 12:30:00' end as dReceived,
               case when m.cTranStat = '1' and f.whole then timestamp '2001-06-01 12:30:00' end as dImported
          from (select *, left(sFileName, 1) = 'M' as hashed from v_inbox) m join ({WHOLE_FILES}) f on m.sFileName = f.sFileName""",
)
def pull_manifest(t):
    """Announced batches are registered, those of one area arrive; the ones received before are imported."""
    announced = t.inbox.select("sFileName", "sMD5Hashx", "sFileSize", "dCreatedx")
    arrived = announced.filter(F.col("sFileName").startswith("M")).select("sFileName", F.upper("sMD5Hashx").alias("sMD5Hashx"))
    known = t.inbox.filter("cTranStat = '1'")
    rows = t.incoming.drop("nErrorNox", "dReceived")
    errors = t.incoming.select("sFileName", "pos", "nErrorNox").filter("nErrorNox <> 0")
    imported = pull.pull_received(known, rows, errors, t.seen, NOW, CHUNK).incoming
    return pull.receive(imported, announced, arrived, NOW)
