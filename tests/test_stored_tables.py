"""Tables that are changed where they lie: partitions copied on write, windows from the zone map, purged files."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators import ingest, retention, windows
from changeflow.schemas import CHANGE
from changeflow.sources.partitions import Partitions
from changeflow.sources.runs import Runs
from helpers import CLIENT, LOG, OUTGOING, batch, change, day, rows

RECORD = "sTableNme string, sRecordKy string, nValuexxx double"
KEYS = ["sTableNme", "sRecordKy"]
CHANGES = f"{RECORD}, sActionxx string, dModified timestamp_ntz, sTransNox string"


def files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("*.parquet") if "pointer" not in str(p)}


def apply(rows_, events):
    return ingest.apply_changes(rows_, events, KEYS)


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    data = [("T", f"k{i}", float(i)) for i in range(400)] + [("T", None, -1.0)]
    table = Partitions(spark, str(tmp_path), spark.createDataFrame(data, RECORD).schema, KEYS, parts=32)
    table.create(spark.createDataFrame(data, RECORD))
    before, folders = files(tmp_path), {r.part: r.folder for r in table.pointer().collect()}
    events = [("T", "k7", 70.0, "upsert", day(1), "1"), ("T", "k8", 0.0, "delete", day(1), "2"), ("T", None, 5.0, "upsert", day(1), "3"), ("T", "new", 9.0, "upsert", day(1), "4")]
    assert table.update(spark.createDataFrame(events, CHANGES), apply) == 1
    want = {**{k: v for _, k, v in data}, "k7": 70.0, None: 5.0, "new": 9.0}
    del want["k8"]
    assert {r.sRecordKy: r.nValuexxx for r in table.rows().collect()} == want
    after = files(tmp_path)
    assert {k: after[k] for k in before} == before  # nothing old has another time, or is gone
    moved = {r.part for r in table.pointer().collect() if folders.get(r.part) != r.folder}
    assert 1 <= len(moved) <= 4 and {r.part: r.folder for r in table.pointer(0).collect()} == folders
    assert {r.sRecordKy: r.nValuexxx for r in table.rows(0).collect()} == {k: v for _, k, v in data}


def test_updates_equal_changing_the_whole_table(spark, tmp_path):
    rng = random.Random(1)
    whole = spark.createDataFrame([("T", f"k{i}", 0.0) for i in range(60)], RECORD)
    table = Partitions(spark, str(tmp_path), whole.schema, KEYS, parts=8)
    table.create(whole)
    for n in range(4):
        events = spark.createDataFrame(
            [("T", f"k{rng.randrange(90)}", float(rng.randrange(99)), rng.choice(["upsert", "upsert", "delete"]), day(1 + i), f"{n}{i:02d}") for i in range(rng.randrange(20))], CHANGES
        )
        whole = spark.createDataFrame(apply(whole, events).collect(), whole.schema)
        table.update(events, apply)
        assert rows(table.rows()) == rows(whole)
    last = table.version()
    assert table.update(events.limit(0), apply) == last == table.version()
    # A version that was not completed is written again.
    whole.withColumn("_part", F.lit(0)).write.partitionBy("_part").parquet(f"{tmp_path}/rows/version={last + 1}")
    assert rows(table.rows()) == rows(whole)
    table.update(spark.createDataFrame([("T", "k1", 1.5, "upsert", day(9), "x")], CHANGES), apply)
    assert table.rows().filter("sRecordKy = 'k1'").first().nValuexxx == 1.5 and table.version() == last + 1


def test_a_partition_that_becomes_empty_and_an_empty_table(spark, tmp_path):
    one = spark.createDataFrame([("T", "a", 1.0)], RECORD)
    table = Partitions(spark, str(tmp_path), one.schema, KEYS, parts=4)
    assert table.rows().count() == 0
    table.create(one)
    table.update(spark.createDataFrame([("T", "a", None, "delete", day(1), "1")], CHANGES), apply)
    assert table.rows().count() == 0 and table.pointer().count() == 0
    table.update(spark.createDataFrame([("T", "b", 2.0, "upsert", day(1), "1")], CHANGES), apply)
    assert rows(table.rows()) == [("T", "b", 2.0)]


def test_a_manifest_in_partitions(spark, tmp_path):
    """Acknowledgements touch the partitions of their batches alone."""
    made = [batch(f"A{i:03d}20010101", "a", "b", "0", day(1)) for i in range(50)]
    table = Partitions(spark, str(tmp_path), spark.createDataFrame(made, OUTGOING).schema, ["sFileName"], parts=16)
    table.create(spark.createDataFrame(made, OUTGOING))
    acks = spark.createDataFrame([("A00720010101", "announced", day(2))], "sFileName string, sEvent string, dEventxxx timestamp_ntz")
    table.update(acks, windows.advance_outgoing)
    assert rows(table.rows().filter("cTranStat = '1'"), "sFileName") == [("A00720010101",)] and table.rows().count() == 50
    assert table.pointer().filter(F.col("folder").contains("version=1")).count() == 1


def read_files(df):
    return {p.rsplit("/", 1)[1] for p in df.inputFiles()}


@pytest.fixture
def log(spark, tmp_path):
    """Three branches in runs of small files, one quarter a run; some rows were changed later."""
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", rows_per_file=25)
    for step in range(4):
        made = [change(f"{b}{i:05d}", modified=datetime(2000, 1 + 3 * step, 1 + i % 28)) for b in ("A001", "B001", "C001") for i in range(step * 100, step * 100 + 100)]
        log.append(spark.createDataFrame(made, LOG), step)
    log.append(spark.createDataFrame([change("A00100150", modified=datetime(2001, 3, 1), by="U9"), ("C00100500", "C001", "x", "T", None, "U1", day(1), None)], LOG), 4)
    return log


def test_windows_from_the_zone_map(spark, log):
    outgoing = spark.createDataFrame(
        [
            batch("A00120010101", "A00100100", "A00100250", "2", datetime(2001, 1, 1)), batch("B00120010101", "B00100000", "B00100399", "4", datetime(2001, 1, 1)),
            batch("C00120010101", "C00100000", "C00100100", "1", datetime(2001, 1, 1)), batch("D00120010101", "D00100000", "D00100100", "2", datetime(2001, 1, 1)),
        ],
        OUTGOING,
    )
    clients = spark.createDataFrame([("N1", "c", "C001", "C00100050"), ("N2", "e", "E001", None), ("N3", "c", "C001", "C00100040")], CLIENT)
    want = rows(windows.export_window(log.rows(), outgoing, clients))
    assert rows(windows.export_window_kept(log, outgoing, clients)) == want
    assert ("A001", "A00100150", "A00100399", True) in want
    empty = Runs(spark, log.root + "-none", CHANGE, "sTransNox")
    assert rows(windows.export_window_kept(empty, outgoing, clients)) == rows(windows.export_window(spark.createDataFrame([], LOG), outgoing, clients))


def test_windows_read_only_files_with_changes_since(spark, log, monkeypatch):
    outgoing = spark.createDataFrame([batch(f"{b}20010101", f"{b}00000", f"{b}00399", "2", datetime(2001, 1, 1)) for b in ("A001", "B001", "C001")], OUTGOING)
    clients = spark.createDataFrame([], CLIENT)
    seen = []
    plain = Runs.read
    monkeypatch.setattr(Runs, "read", lambda self, zones: seen.append(plain(self, zones)) or seen[-1])
    windows.export_window_kept(log, outgoing, clients).collect()
    assert len(read_files(log.rows())) > 40 and sum(len(read_files(df)) for df in seen[:1]) == 1


def test_purging_takes_whole_files_and_rewrites_mixed_ones(spark, log, tmp_path):
    before = read_files(log.rows())
    plan = retention.purge_plan(log, "B001", date(2001, 1, 15))
    whole, mixed = ({r.path.rsplit("/", 1)[1] for r in plan.filter(f).collect()} for f in ("whole", "not whole"))
    assert whole and mixed
    want = rows(retention.retain_log(log.rows(), "B001", date(2001, 1, 15)))
    retention.purge_files(log, "B001", date(2001, 1, 15), step=5, files_per_part=3)
    assert rows(log.rows()) == want
    after = read_files(log.rows())
    assert before - after == whole | mixed
    assert rows(log.rows().filter("sTransNox like 'B001%'"), "sTransNox") == [(f"B001{i:05d}",) for i in range(400)]
    assert rows(log.rows().filter("dModified is null"), "sTransNox") == [("C00100500",)]
    # There is nothing left to purge, and later steps go on from here.
    assert retention.purge_plan(log, "B001", date(2001, 1, 15)).count() == 0
    log.append(spark.createDataFrame([change("A00100999")], LOG), 6)
    assert log.rows().count() == len(want) + 1


def test_a_purge_stopped_half_way_goes_on(spark, log, monkeypatch):
    want = rows(retention.retain_log(log.rows(), "B001", date(2001, 1, 15)))
    everything = rows(log.rows())
    written = []
    plain = Runs._write

    def fails(self, rows_, run, level):
        if len(written) == 2:
            raise RuntimeError("stopped")
        written.append(run)
        return plain(self, rows_, run, level)

    monkeypatch.setattr(Runs, "_write", fails)
    with pytest.raises(RuntimeError):
        retention.purge_files(log, "B001", date(2001, 1, 15), step=5, files_per_part=1)
    assert rows(log.rows()) == everything  # readers still see the log as it was
    first = list(written)
    written.clear()
    monkeypatch.setattr(Runs, "_write", lambda self, *a: written.append(a[1]) or plain(self, *a))
    retention.purge_files(log, "B001", date(2001, 1, 15), step=5, files_per_part=1)
    assert rows(log.rows()) == want and written and not set(first) & set(written)


def test_only_registered_branches_are_purged(spark, log):
    branches = spark.createDataFrame([("A001", "a", "1"), ("B001", "b", "1")], "sBranchCd string, sBranchNm string, cRecdStat string")
    want = rows(retention.retain_log(log.rows(), "B001", date(2001, 1, 15), branches))
    retention.purge_files(log, "B001", date(2001, 1, 15), 5, branches)
    assert rows(log.rows()) == want and log.rows().filter("sTransNox like 'C001%'").count() == 401
