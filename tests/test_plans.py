"""The plans that the operators get over stored tables."""

import contextlib
import random
from datetime import date

import pytest

from changeflow.operators import ageing, collections, ingest, outbox, retention, sync, windows
from changeflow.sources import tables
from checks.views import Tables

TABLES = "systable client branch outgoing incoming request sheet line account".split()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    given = Tables(spark, "/root/testdata/sf0.001")
    tables.store_change_log(given.log, f"{folder}/log")
    found = {"log": tables.scan_change_log(spark, f"{folder}/log")}
    for name in TABLES:
        getattr(given, name).write.parquet(f"{folder}/{name}")
        found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops(stored):
    window = stored["outgoing"].selectExpr("left(sFileName, 4) as branch", "sLogFromx", "sLogThrux")
    for df in (
        windows.branch_window_scan(stored["log"], window),
        sync.request_range_match(stored["log"], stored["request"]),
        sync.route_changes(stored["log"], stored["systable"], "M001"),
        sync.route_changes_all(stored["log"], stored["systable"]),
        windows.export_window(stored["log"], stored["outgoing"], stored["client"]),
        windows.mark_archived(stored["outgoing"], windows.archive_window(stored["outgoing"], date(2001, 6, 1))),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_wise_operators_do_not_shuffle(stored):
    for df in (
        sync.route_changes_all(stored["log"], stored["systable"]),
        sync.request_range_match(stored["log"], stored["request"]),
        ingest.accepted_prefix(ingest.classify_errors(stored["incoming"])),
        ageing.account_ageing(ageing.open_accounts(stored["account"]), date(2001, 6, 1)),
        retention.trim_by_key_prefix(stored["log"], stored["branch"], "M001"),
    ):
        text = plan(df)
        assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
        assert "Python" not in text


def test_filters_reach_the_scan(stored):
    text = plan(windows.branch_scan(stored["log"], "M001", "M001000000000000", "M001000000000900"))
    assert "PartitionFilters: [isnotnull(branch" in text
    assert "StringStartsWith(sTransNox,M001)" in text and "GreaterThanOrEqual(sTransNox" in text


def test_narrow_reads(stored):
    text = plan(windows.last_key_per_branch(stored["log"]))
    assert "ReadSchema: struct<sTransNox:string>" in text


@contextlib.contextmanager
def settings(spark, **values):
    values = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_the_log_is_only_filtered_by_what_an_import_holds(spark, stored, monkeypatch):
    """The threshold lies under the log's size and over that of the incoming keys."""
    seen = []
    keep = ingest.settle
    monkeypatch.setattr(ingest, "settle", lambda df: seen.append(plan(df)) or keep(df))
    few = stored["incoming"].filter("sTransNox LIKE 'M00%'").limit(50)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="30000"):
        ingest.drop_seen_changes(few, stored["log"]).collect()
    narrowed = next(text for text in seen if "LeftSemi" in text)
    assert "BroadcastHashJoin" in narrowed and "Exchange hashpartitioning" not in narrowed
    assert "ReadSchema: struct<sTransNox:string,sModified:string>" in narrowed
    assert "dynamicpruning" in narrowed


def test_few_changes_do_not_shuffle_a_large_target(spark, tmp_path):
    spark.range(200_000).selectExpr("id as k", "id * 2 as v").write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    changes = spark.createDataFrame(
        [(i, 0, "upsert" if i % 2 else "delete", "2001-01-01", f"T{i}") for i in range(10)],
        "k bigint, v bigint, sActionxx string, dModified string, sTransNox string",
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="20000"):
        new = ingest.apply_changes(target, changes, ["k"])
        text = plan(new)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
        assert new.count() == 199_995


def test_purging_prunes_folders_and_row_groups(stored):
    text = plan(retention.purge_log(stored["log"], "M001", date(2001, 6, 1), stored["branch"]))
    scan = text[text.index("sTransNox"):]
    assert "NOT (branch" in scan and "LessThanOrEqual(dModified" in scan


def test_requests_read_only_the_branches_asked_for(spark, stored):
    text = plan(windows.last_key_per_branch(stored["log"], stored["branch"].withColumnRenamed("sBranchCd", "branch")))
    assert "dynamicpruning" in text


def test_repeats_are_cut_before_the_shuffle(stored):
    text = plan(ingest.drop_repeats_in_batch(stored["incoming"]))
    before_shuffle = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_a_hot_branch_is_numbered_and_cut_in_many_groups(spark):
    """Two thirds of the keys belong to one branch; the result equals plain sorting."""
    rng = random.Random(5)
    keys = sorted({f"{'HOT1' if rng.random() < 0.67 else 'B%03d' % rng.randint(1, 9)}{rng.randint(0, 10**12 - 1):012d}" for _ in range(3000)})
    log = spark.createDataFrame([(k,) for k in keys], "sTransNox string")
    expected = []
    for branch in sorted({k[:4] for k in keys}):
        own = [k for k in keys if k[:4] == branch]
        expected += [(branch, i // 100, own[i], own[min(i + 99, len(own) - 1)], len(own[i : i + 100])) for i in range(0, len(own), 100)]
    assert sorted(tuple(r) for r in windows.delete_chunks(log, 100).collect()) == expected


@pytest.mark.parametrize("number", ["cast(id as int)", "cast(null as int)", "cast(id % 3 as int)", "-1"])
def test_a_hot_document_is_split_and_whole(spark, number):
    """Whatever the entry numbers are."""
    lines = spark.range(1, 5001).selectExpr("'S1' as sTransNox", f"{number} as nEntryNox", "cast(id as string) as sAcctNmbr")
    masters = spark.createDataFrame([("S1",)], "sTransNox string")
    nested = sorted(outbox.nest_master_detail(masters, lines, per_part=1000).collect(), key=lambda r: r.nPartxxxx)
    assert [len(r.detail) for r in nested] == [1000] * 5
    assert {d.sAcctNmbr for r in nested for d in r.detail} == {str(i) for i in range(1, 5001)}
    in_order = [d.nEntryNox for r in nested for d in r.detail if d.nEntryNox is not None]
    assert in_order == sorted(in_order)


def test_a_hot_account_is_split_in_both_joins(spark):
    """A third of all lines belong to one account, and two joins on the account share a shuffle."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        lines = spark.range(150_000).selectExpr(
            "concat('S', id div 10) as sTransNox", "cast(id % 10 as int) as nEntryNox",
            "concat('A', if(id % 3 = 0, 1, id % 2000)) as sAcctNmbr", "cast(rand(1) as string) as cIsDCPxxx",
        )
        sheets = spark.range(15_000).selectExpr("concat('S', id) as sTransNox", "date'2001-01-01' as dTransact")
        money = [f"cast(1 as double) as {c}" for c in ("nAmtDuexx", "nMonAmort", "nABalance", "nDelayAvg", "nLastPaym")]
        accounts = spark.range(2000).selectExpr(
            "concat('A', id) as sAcctNmbr", "concat('K', id) as sClientID", "concat('E', id) as sSerialID",
            "date'2001-01-01' as dDueDatex", "date'2001-01-01' as dLastPaym", *money,
        )
        clients = spark.range(2000).selectExpr(
            "concat('K', id) as sClientID", "'n' as sCompnyNm", "'h' as sHouseNox", "'a' as sAddressx", "'b' as sBrgyIDxx",
            "'t' as sTownIDxx", "'m' as sMobileNo",
        )
        units = spark.range(2000).selectExpr(
            "concat('A', id) as sAcctNmbr", "concat('u', id) as cApntUnit", "date'2001-02-01' as dAppointx", "date'2001-02-01' as dDueUntil"
        )
        places = spark.createDataFrame([("b", "Brgy")], "sBrgyIDxx string, sBrgyName string")
        towns = spark.createDataFrame([("t", "Town")], "sTownIDxx string, sTownName string")
        spots = spark.range(2000).selectExpr("concat('K', id) as sClientID", "1D as nLongitud", "1D as nLatitude")
        serials = spark.range(2000).selectExpr("concat('E', id) as sSerialID", "'e' as sEngineNo")
        df = collections.collection_detail(lines, sheets, accounts, clients, places, towns, units, spots, serials)
        summed = df.selectExpr("count(*)", "max(cIsDCPxxx)", "count(sSerialNo)", "max(cApntUnit)")
        assert summed.collect()[0][0] == 150_000
        final = plan(summed).split("Initial Plan")[0]
        assert final.count("skew=true") >= 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
