"""Re-sync requests, matching and routing."""

from pyspark.sql import functions as F

from changeflow.operators import sync
from changeflow.plans import resync
from changeflow.session import new_folder
from changeflow.sources import requests

from .registry import query

CHANGE = "l.sTransNox, l.sBranchCd, l.sStatemnt, l.sTableNme, l.sDestinat, l.sModified, l.dEntryDte, l.dModified"
SELF, TARGET = "NODE_M001", "M001"

LAST = "(select substring(sTransNox, 1, 4) as branch, max(sTransNox) as k from v_log group by 1)"
ASKED = f"""
    select 'M00120010601' as sExportCd, c.sClientID, coalesce(k.k, '') as sExportFr
      from v_client c join v_branch b on c.sBranchCd = b.sBranchCd and b.cRecdStat = '1'
      left join {LAST} k on right(c.sClientID, 4) = k.branch where c.sClientID <> '{SELF}'"""


@query(
    "active_clients",
    f"""select c.* from v_client c where sClientID <> '{SELF}'
        and exists (select 1 from v_branch b where b.sBranchCd = c.sBranchCd and cRecdStat = '1')""",
)
def active_clients(t):
    return sync.active_clients(t.client, t.branch, SELF)


def asked(t):
    return sync.build_sync_request(t.log, t.client, t.branch, SELF, "M00120010601")


@query("build_sync_request", ASKED)
def build_sync_request(t):
    return asked(t)


@query("read_sync_request", f"select sExportCd, sClientID, sExportFr, cast(null as varchar) as sExportTr from ({ASKED}) x")
def read_sync_request(t):
    path = new_folder(t.spark, "request")
    requests.write_sync_request(asked(t), path)
    return requests.read_sync_request(t.spark, path)


@query("read_sync_request_array", "select sExportCd, sClientID, sExportFr, sExportTr from v_request")
def read_sync_request_array(t):
    path = new_folder(t.spark, "request")
    requests.write_sync_request(t.request, path, array=True, per_array=40)
    return requests.read_sync_request(t.spark, path, array=True)


@query(
    "write_sync_request",
    """select concat('{"sExportCd":"', sExportCd, '","sClientID":"', sClientID, '","sExportFr":"', sExportFr,
                     '","sExportTr":"', sExportTr, '"}') as value from v_request""",
)
def write_sync_request(t):
    path = new_folder(t.spark, "request")
    requests.write_sync_request(t.request, path)
    return t.spark.read.text(path)


@query(
    "bound_sync_request",
    f"""select r.sExportCd, r.sClientID, r.sExportFr, coalesce(k.k, '') as sExportTr
          from v_request r left join {LAST} k on right(r.sClientID, 4) = k.branch""",
)
def bound_sync_request(t):
    return sync.bound_sync_request(t.request.drop("sExportTr"), t.log)


MATCH = """exists (select 1 from v_request r where right(r.sClientID, 4) = substring(l.sTransNox, 1, 4)
                      and l.sTransNox between r.sExportFr and r.sExportTr)"""


@query("request_range_match", f"select {CHANGE} from v_log l where {MATCH}")
def request_range_match(t):
    return sync.request_range_match(t.log, t.request)


# A range begins a stretch where no other one of its client covers its first key and begins before it, or is alike and comes first.
@query(
    "merged_ranges",
    """with asked as (select distinct right(sClientID, 4) as branch, sExportFr as f, sExportTr as t from v_request_all where sExportFr <= sExportTr),
            heads as (select branch, f from asked a where not exists (select 1 from asked b where b.branch = a.branch and b.f < a.f and b.t >= a.f) group by 1, 2),
            stretches as (select branch, f, lead(f) over (partition by branch order by f) as next_f from heads)
       select s.branch, s.f as sExportFr, max(a.t) as sExportTr from stretches s join asked a
           on a.branch = s.branch and a.f >= s.f and (s.next_f is null or a.f < s.next_f) group by 1, 2""",
)
def merged_ranges(t):
    return sync.requested_ranges(t.request_all)


MATCH_ALL = MATCH.replace("v_request r", "v_request_all r")


@query("merged_range_match", f"select {CHANGE} from v_log l where {MATCH_ALL}")
def merged_range_match(t):
    return sync.merged_range_match(t.log, t.request_all)


# Who gets a change by the type of its table, and, whatever that is, an owner about whom another branch has written.
RECIPIENTS = f"""[case typ.cTableTyp when '0' then '{TARGET}' when '1' then l.sBranchCd when '2' then l.sDestinat
                      when '3' then case left(l.sBranchCd, 1) when '{TARGET[0]}' then '{TARGET}' end end,
                 case when left(l.sTransNox, 4) <> l.sBranchCd then l.sBranchCd end]"""
ROUTED = f"v_log l join v_systable typ using (sTableNme) where list_contains({RECIPIENTS}, '{TARGET}')"


@query("route_changes", f"select {CHANGE} from {ROUTED}")
def route_changes(t):
    return sync.route_changes(t.log, t.systable, TARGET)


@query("route_changes_main_office", f"select {CHANGE} from v_log l")
def route_changes_main_office(t):
    return sync.route_changes(t.log, t.systable, TARGET, main_office=True)


@query(
    "route_changes_all",
    f"""with typed as (select {CHANGE}, b.cTableTyp from v_log l join v_systable b on l.sTableNme = b.sTableNme),
        branch_routes as (
          select l.*, l.sBranchCd as sTargetxx from typed l where cTableTyp = '1' and sBranchCd is not null
          union select l.*, l.sDestinat from typed l where cTableTyp = '2' and sDestinat is not null
          union select l.*, l.sBranchCd from typed l where cTableTyp not in ('0', '3') and not starts_with(sTransNox, sBranchCd))
        select 'all' as sScopexxx, '*' as sTargetxx, {CHANGE} from typed l where cTableTyp = '0'
        union all select 'area', substring(sBranchCd, 1, 1), {CHANGE} from typed l where cTableTyp = '3' and sBranchCd is not null
        union all select 'branch', sTargetxx, {CHANGE} from branch_routes l""",
)
def route_changes_all(t):
    return sync.route_changes_all(t.log, t.systable)


@query(
    "route_summary",
    """with typed as (select sTransNox, sModified, sBranchCd, sDestinat, cTableTyp from v_log join v_systable using (sTableNme)),
       heard as (
         select c.sBranchCd as target, sTransNox, sModified from typed join v_client c on cTableTyp = '0'
         union select sBranchCd, sTransNox, sModified from typed where cTableTyp = '1' or left(sTransNox, 4) <> sBranchCd
         union select sDestinat, sTransNox, sModified from typed where cTableTyp = '2'
         union select c.sBranchCd, sTransNox, sModified from typed t join v_client c on left(t.sBranchCd, 1) = left(c.sBranchCd, 1)
                where cTableTyp = '3')
       select target, count(*) as nRowsxxxx, min(sTransNox) as sFirstKey, max(sTransNox) as sLastKey
         from heard where target in (select sBranchCd from v_client) group by target""",
)
def route_summary(t):
    targets = t.client.select(F.col("sBranchCd").alias("target")).distinct()
    return sync.route_summary(sync.route_changes_all(t.log, t.systable), targets)


@query("apply_order", f"select {CHANGE} from v_log l order by dModified, sTransNox")
def apply_order(t):
    return sync.apply_order(t.log)


@query(
    "advance_client_watermark",
    """select c.sClientID, c.sClientNm, c.sBranchCd,
              case when lower(r.sExportTr) > lower(coalesce(c.sExportNo, '')) then r.sExportTr else c.sExportNo end as sExportNo
         from v_client c left join v_request r on c.sClientID = r.sClientID""",
)
def advance_client_watermark(t):
    return sync.advance_client_watermark(t.client, t.request)


FLAGSHIP = f"""
    with bounded as (select r.sClientID, r.sExportFr, coalesce(k.k, '') as sExportTr
                       from v_request r left join {LAST} k on right(r.sClientID, 4) = k.branch)
    select {CHANGE} from {ROUTED}
       and exists (select 1 from bounded r where right(r.sClientID, 4) = substring(l.sTransNox, 1, 4)
                      and l.sTransNox between r.sExportFr and r.sExportTr)
     order by dModified, sTransNox"""


@query("resync_answer", FLAGSHIP)
def resync_answer(t):
    return resync.answer(t.log, t.request.drop("sExportTr"), t.systable, TARGET)


# Addresses of every change, worked out from the rules, and kept where some requester behind the address asked for its key.
ANSWERS = f"""
    with bounded as (select left(sExportCd, 4) as target, right(r.sClientID, 4) as branch, sExportFr, coalesce(k.k, '') as sExportTr
                       from v_request_all r left join {LAST} k on right(r.sClientID, 4) = k.branch),
    typed as (select {CHANGE}, b.cTableTyp, left(l.sTransNox, 4) as branch from v_log l join v_systable b on l.sTableNme = b.sTableNme),
    routed as (
      select 'all' as sScopexxx, '*' as sTargetxx, * from typed where cTableTyp = '0'
      union all select 'area', left(sBranchCd, 1), * from typed where cTableTyp = '3' and sBranchCd is not null
      union all select 'branch', * from (select sBranchCd, * from typed where cTableTyp = '1' and sBranchCd is not null
                                         union select sDestinat, * from typed where cTableTyp = '2' and sDestinat is not null
                                         union select sBranchCd, * from typed where cTableTyp not in ('0', '3') and branch <> sBranchCd) x),
    heard as (
      select l.* from routed l where exists (
        select 1 from bounded r where r.branch = l.branch and l.sTransNox between r.sExportFr and r.sExportTr
           and (sScopexxx = 'all' or sScopexxx = 'area' and left(r.target, 1) = sTargetxx or sScopexxx = 'branch' and r.target = sTargetxx)))
    select sScopexxx, sTargetxx, {CHANGE}, row_number() over (partition by sScopexxx, sTargetxx order by dModified, sTransNox, sModified) as nPlacexxx
      from heard l"""


@query("resync_answers", ANSWERS)
def resync_answers(t):
    return resync.answers(t.log, t.request_all.drop("sExportTr"), t.systable).changes
