import random

from pyspark.sql import functions as F

from changeflow.operators import ingest
from changeflow.schemas import CHANGE
from changeflow.sources.runs import Runs, steps_in
from changeflow.streaming import inbox
from helpers import LOG, change, day, rows
from test_ingest import NOW, Arrivals

INCOMING = f"n int, {LOG}"


def changes(spark, keys):
    return spark.createDataFrame([change(k) for k in keys], LOG)


def files_read(df):
    return {p.rsplit("/", 1)[1] for p in df.inputFiles()}


def test_only_files_that_can_hold_a_key_are_read(spark, tmp_path):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", rows_per_file=50)
    for step in range(3):
        log.append(changes(spark, [f"A{b:03d}{i:05d}" for b in range(4) for i in range(step, 900, 3)]), step)
    everything = files_read(log.rows())
    assert len(everything) >= 24 and log.rows().count() == 3600
    keys = spark.createDataFrame([("A00200500",), ("A00299999",), ("ZZZZ00001",)], "sTransNox string")
    few = log.holding(keys)
    assert 1 <= len(files_read(few)) <= 3  # one a run
    assert few.filter("sTransNox = 'A00200500'").count() == 1
    assert log.holding(keys.limit(0)).count() == 0 and log.holding(keys.filter("sTransNox > 'Z'")).count() == 0


def test_runs_of_a_level_do_not_overlap(spark, tmp_path):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", rows_per_file=20)
    log.append(changes(spark, [f"A001{i:05d}" for i in range(500)] + [f"B00{i}00001" for i in range(9)]).repartition(5), 0)
    zones = sorted((r.sLowKeyxx, r.sHighKeyx) for r in log.zones().collect())
    assert all(a[1] < b[0] for a, b in zip(zones, zones[1:])) and len(zones) > 25


def test_seen_by_zones_equals_the_whole_comparison(spark, tmp_path):
    rng = random.Random(1)
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", width=2, rows_per_file=10)
    seen = []
    for step in range(5):
        made = [change(f"A00{rng.randrange(3)}{rng.randrange(300):05d}", by=f"U{rng.randrange(3)}") for _ in range(60)]
        seen += made
        log.append(spark.createDataFrame(made, LOG), step)
    incoming = spark.createDataFrame([(i, *change(f"A00{rng.randrange(4)}{rng.randrange(300):05d}", by=f"U{rng.randrange(3)}")) for i in range(200)], INCOMING)
    want = rows(ingest.drop_seen_changes(incoming, spark.createDataFrame(seen, LOG)), "n")
    assert rows(ingest.drop_seen_by_zones(incoming, log), "n") == want and 0 < len(want) < 200
    # As it was before the last step.
    want = rows(ingest.drop_seen_changes(incoming, spark.createDataFrame(seen[:240], LOG)), "n")
    assert rows(ingest.drop_seen_by_zones(incoming, log, before=4), "n") == want


def test_a_step_again_gives_the_same(spark, tmp_path):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", width=2)
    for step in (0, 10, 20, 30):
        for _ in range(1 + step // 20):
            log.append(changes(spark, [f"A001{step:05d}"]), step)
        assert [r[0] for r in rows(log.rows(), "sTransNox")] == [f"A001{s:05d}" for s in range(0, step + 1, 10)]
    assert steps_in(spark, f"{log.root}/zones") == [10, 20, 30]
    # A step that was lost before its zone map was written: its rows are not seen, and written anew.
    changes(spark, ["A00199999"]).write.parquet(f"{log.root}/rows/step=40")
    assert log.rows().count() == 4
    log.append(changes(spark, ["A00100040"]), 40)
    assert rows(log.rows().filter("sTransNox > 'A00100030'"), "sTransNox") == [("A00100040",)]


def test_runs_and_rewritten_rows_stay_few(spark, tmp_path):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", width=3)
    for step in range(20):
        log.append(changes(spark, [f"A001{step:05d}"]), step)
        assert log.zones().select("run").distinct().count() <= 2 * 3  # at most two of each of three levels
    assert log.rows().count() == 20
    assert len(list((tmp_path / "log" / "rows").iterdir())) < 15  # older runs have gone


def test_an_empty_table(spark, tmp_path):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox")
    assert log.rows().count() == 0 and log.holding(changes(spark, ["A1"])).count() == 0
    log.append(changes(spark, []), 0)
    log.append(changes(spark, ["A00100001"]), 1)
    assert log.rows().count() == 1


def test_a_micro_batch_costs_the_same_after_many(spark, tmp_path):
    """Files of the log and of the known names that a step reads, first and after many steps."""
    stream = Arrivals(spark, tmp_path, chunk=100)
    job = inbox.Import(spark, stream.path("inbox"), stream.path("errors"), stream.path("log"), stream.path("state"), NOW, 100, width=2)
    read = []
    for step in range(9):
        stream.arrive(1, [(f"A{step:03d}", i, f"A{step:03d}{i:03d}") for i in range(1, 4)] + [(f"A{step:03d}", 4, "B001001")])
        notice = spark.createDataFrame([(f"A{step:03d}", day(1))], inbox.NOTICE)
        keys = spark.createDataFrame([(f"A{step:03d}001",)], "sTransNox string")
        read.append((len(files_read(job.log.holding(keys, step))), len(files_read(job.known.holding(notice, step)))))
        job.run(step, notice)
    assert read == [(0, 0)] * 9  # new keys and names lie in no file's range
    assert job.logged().count() == 9 * 3 + 1
    again = job.log.holding(spark.createDataFrame([("B001001",)], "sTransNox string"), 9)
    assert len(files_read(again)) == 1 and job.log.zones().select("run").distinct().count() <= 4
    assert job.logged().filter(F.col("sTransNox").startswith("A004")).count() == 3


def test_a_purge_of_many_files_has_few_parts(spark, tmp_path, monkeypatch):
    log = Runs(spark, str(tmp_path / "log"), CHANGE, "sTransNox", rows_per_file=5)
    log.append(changes(spark, [f"A001{i:05d}" for i in range(200)]), 0)
    assert log.zones().select("path").distinct().count() >= 40
    runs, write = [], log._write
    monkeypatch.setattr(log, "_write", lambda rows_, run, level: runs.append(run) or write(rows_, run, level))
    log.rewrite(log.zones().select("path", F.lit(False).alias("whole")), lambda r: r.filter("sTransNox like '%7'"), 1, files_per_part=1)
    assert 1 < len(runs) <= 16
    assert [r[0] for r in rows(log.rows(), "sTransNox")] == [f"A001{i:05d}" for i in range(7, 200, 10)]
