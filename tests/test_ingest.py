import random
from datetime import datetime
from pathlib import Path

from changeflow.operators import ingest
from changeflow.plans import pull
from changeflow.schemas import CHANGE
from changeflow.session import shared_folder
from changeflow.sources import batches
from changeflow.sources.runs import ZONES
from changeflow.streaming import inbox
from helpers import LOG, change, day, rows

INCOMING = f"sFileName string, pos bigint, dReceived timestamp_ntz, {LOG}, nErrorNox int"
NOW = datetime(2001, 6, 1, 12)


def row(file, pos, key, by="U1", error=0, received=1):
    return (file, pos, day(received), *change(key, by=by), error)


def test_a_repeat_after_a_failed_row_is_tried_again(spark):
    data = spark.createDataFrame(
        [row("f", 1, "A1", error=1062), row("f", 2, "A1"), row("f", 3, "A1"), row("f", 4, "A1", by="U2"),
         # File g was received before f, so its row is the first one.
         row("f", 5, "A2", received=2), row("g", 9, "A2", received=1)],
        INCOMING,
    )
    assert rows(ingest.drop_repeats_in_batch(data), "sFileName", "pos") == [("f", 2), ("f", 4), ("g", 9)]


def test_seen_changes_go_by_key_and_modifier(spark):
    log = spark.createDataFrame([change("A1", by="U1")], LOG)
    data = spark.createDataFrame([row("f", 1, "A1", by="U1"), row("f", 2, "A1", by="U2"), row("f", 3, "A2")], INCOMING)
    assert rows(ingest.drop_seen_changes(data, log), "pos") == [(2,), (3,)]


def test_error_codes_are_compared_whole(spark):
    data = spark.createDataFrame([row("f", i, "A1", error=e) for i, e in enumerate((0, 1062, 106, 1451))], INCOMING)
    assert [r[1] for r in rows(ingest.classify_errors(data), "pos", "sOutcomex")] == ["ok", "ignore", "report", "report"]


def test_verdict_lets_a_reported_row_pass(spark):
    data = spark.createDataFrame([row("f", 1, "A1", error=1451), row("f", 2, "A2", error=1451)], INCOMING)
    verdicts = spark.createDataFrame(
        [("f", "A1", 1451, "IGNORE"), ("f", "A1", 1451, "ignore"), ("f", "A2", 1451, "")],
        "sFileName string, sRefernox string, nErrorNox int, sResponse string",
    )
    assert rows(ingest.classify_errors(data, verdicts=verdicts), "pos", "sOutcomex") == [(1, "ignore"), (2, "report")]


def test_only_full_chunks_stay_after_a_blocking_error(spark):
    data = [row("f", i, f"A{i}", error=1451 if i in (8, 9) else 1062 if i == 2 else 0) for i in range(1, 13)]
    data += [row("g", i, f"B{i}") for i in range(1, 5)]
    classified = ingest.classify_errors(spark.createDataFrame(data, INCOMING))
    assert rows(ingest.import_progress(classified, 3)) == [("f", 8, 12, 6, 7), ("g", None, 4, 4, 5)]
    kept = ingest.accepted_prefix(classified, 3)
    assert rows(kept.filter("bDurablex"), "sFileName", "pos") == [("f", i) for i in range(1, 7)] + [("g", i) for i in range(1, 5)]
    assert rows(kept.filter("not bDurablex"), "sFileName", "pos") == [("f", 7)]


def test_error_on_the_first_row_keeps_nothing(spark):
    classified = ingest.classify_errors(spark.createDataFrame([row("f", 1, "A1", error=9), row("f", 2, "A2")], INCOMING))
    assert ingest.accepted_prefix(classified).count() == 0
    assert rows(ingest.import_progress(classified), "nDurablex", "nResumexx") == [(0, 1)]


def test_register_incoming_adds_unknown_names_once(spark):
    schema = (
        "sFileName string, sMD5Hashx string, sFileSize string, dCreatedx timestamp_ntz, cTranStat string, "
        "dReceived timestamp_ntz, dImported timestamp_ntz"
    )
    known = spark.createDataFrame([("f1", "h", "1", day(1), "2", day(2), day(3))], schema)
    announced = spark.createDataFrame(
        [("f1", "x", "9", day(9)), ("f2", "h2", "2", day(4)), ("f2", "h2", "2", day(4))],
        "sFileName string, sMD5Hashx string, sFileSize string, dCreatedx timestamp_ntz",
    )
    assert rows(ingest.register_incoming(known, announced), "sFileName", "sMD5Hashx", "cTranStat", "dReceived") == [
        ("f1", "h", "2", day(2)), ("f2", "h2", "0", None),
    ]


def test_hash_reconcile_ignores_case(spark):
    schema = "sFileName string, sMD5Hashx string"
    own = spark.createDataFrame([("a", "FF"), ("b", "11"), ("c", "22"), ("e", None), ("f", "")], schema)
    peer = spark.createDataFrame([("a", "ff"), ("b", "12"), ("d", "33"), ("e", "y"), ("f", "z")], schema)
    assert rows(ingest.hash_reconcile(own, peer)) == [
        ("a", "match"), ("b", "mismatch"), ("c", "missing there"), ("d", "missing here"), ("e", "no hash"), ("f", "no hash"),
    ]


def test_apply_changes_takes_the_newest_and_deletes(spark):
    target = spark.createDataFrame([("k1", 1, None), ("k2", 2, "x"), ("k3", 3, "y")], "k string, n int, s string")
    changes = spark.createDataFrame(
        [
            ("k1", 10, None, "upsert", day(2), "T2"), ("k1", 11, "old", "upsert", day(1), "T9"),
            ("k2", 0, None, "delete", day(2), "T2"), ("k2", 5, "z", "upsert", day(2), "T1"),
            ("k4", 4, None, "upsert", day(1), "T1"), ("k5", 0, None, "delete", day(1), "T1"),
        ],
        "k string, n int, s string, sActionxx string, dModified timestamp_ntz, sTransNox string",
    )
    # A change to null stays null, and k2's delete is newer by key at the same time.
    assert rows(ingest.apply_changes(target, changes, ["k"])) == [("k1", 10, None), ("k3", 3, "y"), ("k4", 4, None)]


def test_statement_profile_reads_verbs_and_tables(spark):
    texts = [
        "INSERT INTO T1 SET a=1", "insert ignore into `T1` set a=1", "UPDATE `t1` SET a=1", "DELETE FROM T2 WHERE a=1",
        "REPLACE INTO T1 VALUES (1)", "ALTER TABLE T1", None,
    ]
    log = spark.createDataFrame([("A0011", t, "T1") for t in texts], "sTransNox string, sStatemnt string, sTableNme string")
    got = [tuple(r) for r in ingest.statement_parts(log).select("sVerbxxxx", "sTargetTb", "bSameTabl").collect()]
    assert got == [
        ("INSERT", "T1", True), ("INSERT", "T1", True), ("UPDATE", "t1", True), ("DELETE", "T2", False),
        ("REPLACE", "T1", True), ("", "", False), (None, None, None),
    ]


def brute_force(files, logged, chunk):
    """One row after the other, as a single reader would."""
    logged = set(logged)
    for _, _, data in sorted(files):
        waiting, durable = set(), set()
        for pos, key, by, error in data:
            if (key, by) not in logged | waiting | durable:
                if error == 0:
                    waiting.add((key, by))
                elif error not in ingest.IGNORED_ERRORS:
                    waiting = set()
                    break
            if pos % chunk == 0:
                durable |= waiting
                waiting = set()
        logged |= durable | waiting
    return logged


def test_import_equals_a_single_reader(spark):
    rng = random.Random(3)
    for _ in range(3):
        files, data = [], []
        for n in range(6):
            # Keys that fail do so in every file, and no key that fails was logged before: its change cannot be applied.
            content = []
            for pos in range(1, rng.randint(20, 40)):
                key = rng.randint(1, 60)
                error = 1451 if key == 60 and rng.random() < 0.5 else 1062 if key > 55 else 0
                key = f"A{key}" if error == 0 else f"E{key}"
                content.append((pos, key, rng.choice(["U1", "U2"]), error))
            files.append((day(n + 1), f"f{n}", content))
            data += [(f"f{n}", p, day(n + 1), *change(k, by=b), e) for p, k, b, e in content]
        seen = [("A1", "U1"), ("A2", "U2"), ("A99", "U1")]
        log = spark.createDataFrame([change(k, by=b) for k, b in seen], LOG)
        result = pull.pull(spark.createDataFrame(data, INCOMING), log, NOW, chunk=7)
        got = [tuple(r) for r in result.log.select("sTransNox", "sModified").collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute_force(files, seen, 7)


def test_importing_twice_is_importing_once(spark):
    data = spark.createDataFrame([row("f", i, f"A{i % 7}", by=f"U{i % 3}") for i in range(1, 50)], INCOMING)
    log = spark.createDataFrame([change("A1")], LOG)
    once = pull.pull(data, log, NOW).log
    twice = pull.pull(data, once, NOW).log
    assert rows(once) == rows(twice)
    assert {r.dModified for r in once.filter("sTransNox <> 'A1'").collect()} == {NOW}


class Arrivals:
    """An inbox, its notices, the errors of its rows, and runs of the stream over it."""

    def __init__(self, spark, folder, files_per_batch=1, chunk=2):
        self.spark, self.folder, self.files, self.chunk = spark, folder, files_per_batch, chunk
        self.errors([])

    def path(self, name):
        return str(self.folder / name)

    def arrive(self, received, *parts):
        """A batch in one file for each part; its rows are (file, pos, key)."""
        for part in parts:
            data = [(f, p, *change(k)) for f, p, k in part]
            batch = self.spark.createDataFrame(data, f"sFileName string, pos bigint, {LOG}").coalesce(1)
            texts = batch.select("sFileName", "pos", *batches._texts(batch))
            texts.write.mode("append").partitionBy("sFileName").json(self.path("inbox"), compression="gzip")
        self.spark.createDataFrame([(parts[0][0][0], day(received))], inbox.NOTICE).coalesce(1).write.mode("append").json(self.path("notices"))

    def errors(self, codes):
        self.spark.createDataFrame(codes, inbox.ERRORS).write.mode("overwrite").parquet(self.path("errors"))

    def job(self):
        return inbox.Import(self.spark, self.path("inbox"), self.path("errors"), self.path("log"), self.path("state"), NOW, self.chunk)

    def logged(self):
        return rows(self.job().logged(), "sTransNox")

    def run(self):
        inbox.stream_import(self.job(), self.path("notices"), self.path("checkpoint"), self.files).awaitTermination()
        return self.logged()


def test_stream_duplicates_and_replay(spark, tmp_path):
    stream = Arrivals(spark, tmp_path)
    stream.arrive(1, [("f", 1, "A1"), ("f", 2, "A2"), ("f", 3, "A1")])
    assert stream.run() == [("A1",), ("A2",)]
    stream.arrive(2, [("g", 1, "A2"), ("g", 2, "A3")])
    assert stream.run() == [("A1",), ("A2",), ("A3",)]
    # The same step again, as after a lost driver: it overwrites its folders with the same rows.
    stream.job().run(inbox.STEPS, spark.createDataFrame([("g", day(2))], inbox.NOTICE))
    assert stream.logged() == [("A1",), ("A2",), ("A3",)]
    assert rows(inbox.closed_batches(stream.job(), NOW), "sFileName") == [("f",), ("g",)]


def test_a_blocked_batch_is_taken_up_again(spark, tmp_path):
    """The rows after an error wait; they come when it is lifted, without a new file."""
    stream = Arrivals(spark, tmp_path)
    stream.arrive(1, [("f", i, f"A{i}") for i in range(1, 7)])
    stream.errors([("f", 4, 1451)])
    assert stream.run() == [("A1",), ("A2",)]  # one full chunk of two rows
    assert stream.run() == [("A1",), ("A2",)]
    stream.arrive(2, [("g", 1, "B1")])
    assert stream.run() == [("A1",), ("A2",), ("B1",)]
    assert rows(stream.job().open_batches(9 * inbox.STEPS), "sFileName", "nDurablex") == [("f", 2)]
    stream.errors([])
    assert stream.run() == [*[(f"A{i}",) for i in range(1, 7)], ("B1",)]
    assert stream.job().open_batches(9 * inbox.STEPS).isEmpty()


def test_what_is_logged_does_not_depend_on_files(spark, tmp_path):
    """A batch over two files with its error in the first, read with one or a hundred notices at a time."""
    found = []
    for files in (1, 100):
        folder = tmp_path / str(files)
        folder.mkdir()
        stream = Arrivals(spark, folder, files)
        stream.arrive(1, [("f", 1, "A1"), ("f", 2, "A2")], [("f", 3, "A3"), ("f", 4, "A4")])
        stream.arrive(2, [("g", 1, "B1")])
        stream.errors([("f", 2, 1451)])
        found.append(stream.run())
    assert found == [[("B1",)], [("B1",)]]


def test_rows_behind_a_stop_are_not_stored(spark, tmp_path, monkeypatch):
    """A batch is read for its stop by position; only kept rows are taken whole. What names no row, or no error, stops nothing."""
    stored, settle = [], inbox.settle

    def counted(df):
        out = settle(df)
        if "sStatemnt" in df.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(inbox, "settle", counted)
    stream = Arrivals(spark, tmp_path, files_per_batch=3)
    stream.arrive(1, [("f", i, f"A{i}") for i in range(1, 7)])
    stream.arrive(2, [("g", 1, "B1"), ("g", 2, "B2"), ("g", 3, "B3")])
    stream.arrive(3, [("h", 1, "C1"), ("h", 2, "C2")])
    codes = [("f", 4, 1451), ("f", 4, 1451), ("f", 6, 9), ("g", 2, 1062), ("g", 7, 1451), ("g", 1, None), ("g", 3, 0), ("h", 1, 5), ("x", 1, 5), (None, 1, 5)]
    stream.errors(codes)
    assert stream.run() == [("A1",), ("A2",), ("B1",), ("B3",)]
    assert stored == [4]
    assert rows(stream.job().open_batches(inbox.STEPS), "sFileName", "nDurablex") == [("f", 2), ("h", 0)]
    stream.errors([c for c in codes if c[0] != "f"])
    assert stream.run() == [*[(f"A{i}",) for i in range(1, 7)], ("B1",), ("B3",)]
    assert stored == [4, 4]


def test_a_new_stream_needs_no_python_worker(spark, tmp_path):
    job = Arrivals(spark, tmp_path).job()
    for table, schema in ((job.open_batches(0), inbox.OPEN), (job.log.zones(), ZONES), (job.log.rows(), CHANGE.simpleString())):
        assert table.isEmpty() and table.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        assert "RDD" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_the_stream_leaves_no_settled_folder(spark, tmp_path):
    stream = Arrivals(spark, tmp_path)
    stream.arrive(1, [("f", 1, "A1")])
    shared = Path(shared_folder(spark).removeprefix("file://"))
    before = {p for p in shared.rglob("settled-*")}
    stream.run()
    assert {p for p in shared.rglob("settled-*")} <= before


def test_a_pull_from_the_manifest(spark):
    schema = (
        "sFileName string, sMD5Hashx string, sFileSize string, dCreatedx timestamp_ntz, cTranStat string, "
        "dReceived timestamp_ntz, dImported timestamp_ntz"
    )
    incoming = spark.createDataFrame([], schema)
    announced = spark.createDataFrame(
        [("f", "AA", "1", day(1)), ("g", "BB", "1", day(1)), ("h", "CC", "1", day(1))],
        "sFileName string, sMD5Hashx string, sFileSize string, dCreatedx timestamp_ntz",
    )
    files = spark.createDataFrame([("f", "aa"), ("g", "bb"), ("h", "xx")], "sFileName string, sMD5Hashx string")
    incoming = pull.receive(incoming, announced, files, day(2))
    assert rows(incoming, "sFileName", "cTranStat") == [("f", "1"), ("g", "1"), ("h", "0")]
    batch = spark.createDataFrame([("f", 1, *change("A1")), ("g", 1, *change("A2")), ("g", 2, *change("A3")), ("h", 1, *change("A4"))], f"sFileName string, pos bigint, {LOG}")
    errors = spark.createDataFrame([("g", 2, 1451)], inbox.ERRORS)
    log = spark.createDataFrame([], LOG)
    done = pull.pull_received(incoming, batch, errors, log, NOW, chunk=1)
    assert rows(done.incoming, "sFileName", "cTranStat") == [("f", "2"), ("g", "1"), ("h", "0")]
    assert rows(done.log, "sTransNox") == [("A1",), ("A2",)]
    assert rows(done.errors, "sFileName", "sRefernox", "nErrorNox", "sDescript") == [("g", "A3", 1451, None)]


def test_a_file_listed_often_is_joined_once(spark):
    schema = "sFileName string, sMD5Hashx string"
    own = spark.createDataFrame([("A", "x")] * 3 + [("A", "X"), ("B", None), ("B", None), (None, "n"), (None, "n"), ("D", "")], schema)
    peer = spark.createDataFrame([("A", "X")] * 2 + [("A", "y"), ("C", "c"), ("C", "c"), (None, "n"), ("D", "d")], schema)
    got = ingest.hash_reconcile(own, peer)
    want = [("A", "match")] * 8 + [("A", "mismatch")] * 4 + [("B", "missing there")] * 2 + [("C", "missing here")] * 2
    want += [("D", "no hash")] + [(None, "missing there")] * 2 + [(None, "missing here")]
    assert sorted(map(str, rows(got))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join FullOuter") < plan.index("Aggregate")
