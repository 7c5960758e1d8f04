import gzip
import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.functions import dense_position, read_time
from changeflow.plans import push
from changeflow.sources import batches, requests, tables
from helpers import CLIENT, LOG, OUTGOING, batch, change, day, rows


def test_read_change_batch_as_others_write_it(spark, tmp_path):
    objects = [
        {"STRANSNOX": "A1", "sbranchcd": "A001", "sStatemnt": "x", "sTableNme": "T", "sDestinat": None, "sModified": "U",
         "dEntryDte": "Mar 7, 2001 3:7:9", "dModified": "2001-03-07 15:07:09", "extra": {"deep": [1]}},
        {"sTransNox": "A2", "sTransnox": "A3", "dEntryDte": "no time"},
    ]
    (tmp_path / "A00120010307150709.json").write_text(json.dumps(objects, indent=2))
    (tmp_path / "empty.json").write_text("[]")
    with gzip.open(tmp_path / "B00120010307150709.jbr.gz", "wt") as f:
        f.write(json.dumps(objects[:1]))
    got = batches.read_change_batch(spark, str(tmp_path))
    assert rows(got, "sFileName", "pos", "sTransNox", "sBranchCd", "sDestinat", "dEntryDte", "dModified") == [
        ("A00120010307150709", 1, "A1", "A001", None, datetime(2001, 3, 7, 3, 7, 9), datetime(2001, 3, 7, 15, 7, 9)),
        ("A00120010307150709", 2, "A3", None, None, None, None),
        ("B00120010307150709", 1, "A1", "A001", None, datetime(2001, 3, 7, 3, 7, 9), datetime(2001, 3, 7, 15, 7, 9)),
    ]


def test_a_broken_batch_fails_the_job(spark, tmp_path):
    (tmp_path / "broken.json").write_text('[{"sTransNox":"A1"},')
    with pytest.raises(Exception, match="(?i)malformed"):
        batches.read_change_batch(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    texts = {
        "2001-04-01 02:30:00": datetime(2001, 4, 1, 2, 30), "Apr 1, 2001 2:30:0": datetime(2001, 4, 1, 2, 30),
        "Feb 30, 2001 1:1:1": None, "Foo 1, 2001 1:1:1": None, "": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        data = spark.createDataFrame([(t,) for t in texts], "t string")
        assert {r.t: r.at for r in data.select("t", read_time(F.col("t")).alias("at")).collect()} == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_batches_survive_the_round_trip(spark, tmp_path, layout):
    log = spark.createDataFrame(
        [change(f"{b}{i:05d}", dest=None if i % 2 else "B001", modified=day(1, 15)) for b in ("A001", "B001") for i in range(25)]
        + [("A00199999", "A001", 'text "with" quotes\nand lines', "T", "é", "U", day(1), day(2))],
        LOG,
    )
    data = dense_position(log.withColumn("sFileName", F.concat(F.substring("sTransNox", 1, 4), F.lit("2001"))), ["sFileName"], "sTransNox")
    batches.write_change_batch(data, str(tmp_path / "out"), layout, rows_per_file=10)
    read = batches.read_change_lines if layout == "lines" else batches.read_change_batch
    back = read(spark, str(tmp_path / "out"))
    assert rows(back, *data.columns) == rows(data)
    sizes = [r.sFileSize for r in batches.file_summary(spark, str(tmp_path / "out")).collect()]
    assert len(sizes) >= 6 and all(float(s) > 0 for s in sizes)


def test_gathered_rows_are_written_without_a_shuffle(spark, tmp_path):
    log = spark.createDataFrame([change(f"{b}{i:05d}") for b in ("A001", "B001") for i in range(200)], LOG)
    data = dense_position(log.withColumn("sFileName", F.concat(F.substring("sTransNox", 1, 4), F.lit("2001"))), ["sFileName"], "sTransNox")
    found = {}
    for name, how in {"gathered": {"gathered": True}, "fast": {"gathered": True, "level": "BEST_SPEED"}, "plain": {}}.items():
        batches.write_change_batch(data, str(tmp_path / name), **how)
        assert rows(batches.read_change_lines(spark, str(tmp_path / name)), *data.columns) == rows(data)
        found[name] = sum(float(r.sFileSize) for r in batches.file_summary(spark, str(tmp_path / name)).collect())
    assert found["gathered"] < found["fast"]


def test_requests_round_trip(spark, tmp_path):
    data = [("X", "NODE_A001", "", "A00107"), ("X", "NODE_B001", "B001", None)]
    schema = "sExportCd string, sClientID string, sExportFr string, sExportTr string"
    requests.write_sync_request(spark.createDataFrame(data, schema), str(tmp_path / "r"))
    assert rows(requests.read_sync_request(spark, str(tmp_path / "r"))) == data
    requests.write_sync_request(spark.createDataFrame(data * 3, schema).coalesce(1), str(tmp_path / "a"), array=True, per_array=4)
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "a").rglob("part-*")]
    assert sorted(map(len, arrays)) == [2, 4] and list(arrays[0][0]) == ["sExportCd", "sClientID", "sExportFr", "sExportTr"]
    assert rows(requests.read_sync_request(spark, str(tmp_path / "a"), array=True)) == sorted(data * 3, key=str)
    (tmp_path / "x.jbx").write_text('[{"sExportCd":"X","sClientID":"NODE_A001","sExportFr":""},{"sExportCd":"Y"}]')
    got = requests.read_sync_request(spark, str(tmp_path / "x.jbx"), array=True)
    assert rows(got) == [("X", "NODE_A001", "", None), ("Y", None, None, None)]


def test_stored_log_keeps_numeric_branch_codes_and_prunes(spark, tmp_path):
    log = spark.createDataFrame([change("001200001"), change("A00100001"), change("A00100002")], LOG)
    tables.store_change_log(log, str(tmp_path / "log"))
    stored = tables.scan_change_log(spark, str(tmp_path / "log"))
    assert rows(stored, "branch") == [("0012",), ("A001",), ("A001",)]
    assert rows(stored, *log.columns) == rows(log)


def test_versions_switch_when_complete(spark, tmp_path):
    root = str(tmp_path / "state")
    tables.save_version(spark.range(3), root, 1)
    tables.save_version(tables.current_version(spark, root).filter("id > 0"), root, 2)
    assert rows(tables.current_version(spark, root)) == [(1,), (2,)]
    # A version that was written but not announced does not count.
    spark.range(9).write.parquet(f"{root}/version=3")
    assert tables.current_version(spark, root).count() == 2


def test_push_confirm_archive(spark, tmp_path):
    log = spark.createDataFrame([change(f"A0010000{i}") for i in range(1, 6)] + [change("B00100001")], LOG)
    outgoing = spark.createDataFrame([batch("A00120010101000000", "A00100001", "A00100002", "2", day(9), day(9))], OUTGOING)
    clients = spark.createDataFrame([("NODE_B001", "b", "B001", "B00100000")], CLIENT)
    made = datetime(2001, 6, 1, 10)
    pushed = push.push(log, outgoing, clients, made, str(tmp_path / "out"))
    manifest = pushed.outgoing
    assert manifest.columns == outgoing.columns
    assert rows(manifest, "sFileName", "sLogFromx", "sLogThrux", "cTranStat") == [
        ("A00120010101000000", "A00100001", "A00100002", "2"),
        ("A00120010601100000", "A00100002", "A00100005", "0"), ("B00120010601100000", "B00100001", "B00100001", "0"),
    ]
    assert rows(pushed.announce, "sFileName") == [("A00120010601100000",), ("B00120010601100000",)] and pushed.send.isEmpty()
    # The hash is that of the file's bytes, so a peer that has the file can verify it.
    [written] = (tmp_path / "out" / "sFileName=A00120010601100000").glob("*.gz")
    hashes = dict(rows(manifest, "sFileName", "sMD5Hashx"))
    assert hashes["A00120010601100000"] == hashlib.md5(written.read_bytes()).hexdigest()
    sizes = dict(rows(manifest, "sFileName", "sFileSize"))
    assert sizes["A00120010601100000"] == f"{written.stat().st_size / 1024:.2f}"
    # Until it is verified, no new window is cut; it is to be announced, then to be sent.
    again = push.push(log, manifest, clients, datetime(2001, 6, 1, 11), str(tmp_path / "again"))
    assert rows(again.outgoing) == rows(manifest) and again.announce.count() == 2
    announced = manifest.withColumn("cTranStat", F.when(F.col("cTranStat") == "0", "1").otherwise(F.col("cTranStat")))
    waiting = push.push(log, announced, clients, datetime(2001, 6, 1, 12), str(tmp_path / "waiting"))
    assert rows(waiting.outgoing) == rows(announced) and waiting.announce.isEmpty() and waiting.send.count() == 2
    peer = announced.select("sFileName", F.upper("sMD5Hashx").alias("sMD5Hashx")).filter("sFileName not like 'B%'")
    checked = push.confirm(announced, peer, datetime(2001, 6, 2))
    assert rows(checked, "sFileName", "cTranStat") == [
        ("A00120010101000000", "2"), ("A00120010601100000", "2"), ("B00120010601100000", "1"),
    ]
    data, marked = push.archive(log, checked, datetime(2001, 7, 1).date())
    assert rows(data, "sTransNox") == [(f"A0010000{i}",) for i in range(1, 6)]
    assert {r.cTranStat for r in marked.filter("sFileName like 'A%'").collect()} == {"4"}
