from datetime import datetime

from pyspark.sql import functions as F

from changeflow.operators import outbox
from changeflow.streaming import outbox as delivery
from helpers import day, rows

QUEUE = "sTransNox string, sSourceNo string, sSourceCD string, cTranStat string, cSendStat string, dSentDate timestamp_ntz"
MASTER = (
    "sTransNox string, dTransact date, sReferNox string, dReferDte date, cTranStat string, cDCPTypex string, "
    "nEntryNox int, sCollctID string, sModified string, dModified timestamp_ntz"
)
LINE = "sTransNox string, nEntryNox int, sAcctNmbr string, cPaymForm string, dModified timestamp_ntz"


def master(key):
    return (key, day(1).date(), "r", None, "0", "2", 9, "C1", "U1", day(1))


def queue(spark):
    return spark.createDataFrame(
        [
            ("A0011", "S1", "DCPx", "1", "0", None), ("A0012", "S2", "DCPx", "0", "0", None),
            ("A0013", "S3", "Othr", "1", "0", None), ("A0014", "S9", "DCPx", "1", "0", None),
            ("A0015", " ", "DCPx", "1", "0", None), ("A0016", "S1", "DCPx", "1", "1", day(2)), ("B0011", "S1", "DCPx", "1", "0", None),
        ],
        QUEUE,
    )


def test_pending_outbox_is_the_branch_in_key_order(spark):
    assert [r.sTransNox for r in outbox.pending_outbox(queue(spark), "A001").collect()] == [f"A001{i}" for i in range(1, 6)]


def test_outcomes_and_marks(spark):
    masters = spark.createDataFrame([master("S1"), master("S2"), master("S3")], MASTER)
    waiting = outbox.dispatch_by_source(queue(spark).filter("cSendStat = '0'"))
    outcomes = outbox.delivery_outcomes(waiting, masters)
    assert rows(outcomes, "sTransNox", "sMessagex") == [
        ("A0011", outbox.UPLOADED), ("A0012", outbox.NOT_FOR_UPLOAD), ("A0013", outbox.UNKNOWN_SOURCE),
        ("A0014", outbox.NO_SUCH_DOCUMENT), ("A0015", outbox.EMPTY_KEY), ("B0011", outbox.UPLOADED),
    ]
    now = datetime(2001, 6, 1, 12)
    marked = outbox.mark_sent(queue(spark), outcomes, now)
    assert rows(marked.filter("cSendStat = '1'"), "sTransNox", "dSentDate") == [("A0011", now), ("A0016", day(2)), ("B0011", now)]


def test_a_refusal_is_not_a_delivery(spark):
    masters = spark.createDataFrame([master("S1")], MASTER)
    replies = spark.createDataFrame(
        [("A0011", "error", "no space"), ("A0016", "success", None)], "sTransNox string, sResultxx string, sMessagex string"
    )
    rows_in = outbox.dispatch_by_source(queue(spark).filter("sSourceNo = 'S1'"))
    assert rows(outbox.delivery_outcomes(rows_in, masters, replies), "sTransNox", "bSentxxxx", "sMessagex") == [
        ("A0011", False, "no space"), ("A0016", True, outbox.UPLOADED), ("B0011", False, "no reply"),
    ]


def test_projections_reset_columns(spark):
    lines = spark.createDataFrame([("S1", 1, "a", "C", day(1))], LINE)
    assert outbox.upload_projection(lines).first().asDict() == {
        "sTransNox": "S1", "nEntryNox": 1, "sAcctNmbr": "a", "sReferNox": "", "cPaymForm": "C", "dPromised": None,
        "sRemCodex": None, "sRemarksx": "", "cIsDCPxxx": "1", "cIsNwNmbr": "0", "cIsNwAddx": "0", "cIsNwCltx": "0",
        "dModified": day(1),
    }
    head = outbox.upload_master(spark.createDataFrame([master("S1")], MASTER)).first()
    assert (head.cTranStat, head.cDCPTypex, head.nEntryNox, head.sReferNox) == ("1", "1", 0, "r")


def test_nesting_orders_lines_and_splits_long_documents(spark):
    masters = spark.createDataFrame([master("S1"), master("S2")], MASTER)
    lines = spark.createDataFrame([("S1", i, f"a{i}", "C", day(1)) for i in (5, 3, 1, 4, 2)] + [("S9", 1, "x", "C", day(1))], LINE)
    nested = outbox.nest_master_detail(masters, lines, per_part=2)
    got = {(r.sTransNox, r.nPartxxxx): [x.nEntryNox for x in r.detail] for r in nested.collect()}
    assert got == {("S1", 0): [1, 2], ("S1", 1): [3, 4], ("S1", 2): [5], ("S2", 0): []}
    assert {r.master.sReferNox for r in nested.collect()} == {"r"}
    whole = outbox.nest_master_detail(masters, lines, keep_without_lines=False)
    assert [(r.sTransNox, len(r.detail)) for r in whole.collect()] == [("S1", 5)]


def test_a_branch_stops_at_its_first_failure(spark):
    told = [("A0011", True), ("A0012", True), ("A0013", False), ("A0014", True), ("A0015", False), ("B0011", False), ("B0012", True), ("C0011", True)]
    outcomes = spark.createDataFrame([(k, "S", "1", ok, "") for k, ok in told], "sTransNox string, sSourceNo string, cTranStat string, bSentxxxx boolean, sMessagex string")
    fates = {r.sTransNox: r.sFatexxxx for r in outbox.deliver_in_order(outcomes).collect()}
    assert fates == {
        "A0011": "sent", "A0012": "sent", "A0013": "failed", "A0014": "held", "A0015": "held", "B0011": "failed", "B0012": "held", "C0011": "sent",
    }
    assert outbox.deliver_in_order(outcomes.limit(0)).count() == 0


class Sending:
    """A queue that arrives in files, a receiver that refuses some rows, and what it was sent, step by step."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.refused = spark, folder, set()

    def arrive(self, *keys, state="0"):
        rows_ = [(k, "S1", "DCPx", "1", state) for k in keys]
        self.spark.createDataFrame(rows_, delivery.QUEUE).coalesce(1).write.mode("append").parquet(f"{self.folder}/queue")

    def attempt(self, rows_):
        masters = self.spark.createDataFrame([("S1",)], "sTransNox string")
        bad = F.col("sTransNox").isin(*self.refused) if self.refused else F.lit(False)
        replies = rows_.select("sTransNox", F.when(bad, "error").otherwise("success").alias("sResultxx"), F.lit("no").alias("sMessagex"))
        return outbox.delivery_outcomes(rows_, masters, replies)

    def job(self):
        return delivery.Delivery(self.spark, f"{self.folder}/state", self.attempt, day(3), width=2)

    def run(self):
        delivery.stream_outbox(self.job(), f"{self.folder}/queue", f"{self.folder}/checkpoint", 1).awaitTermination()
        return [(r.sTransNox, r.nStepxxxx) for r in self.job().delivered().orderBy("nStepxxxx", "sTransNox").collect()]


def in_order_and_once(sent):
    keys = [k for k, _ in sent]
    assert len(keys) == len(set(keys))
    for branch in {k[:4] for k in keys}:
        own = [k for k in keys if k[:4] == branch]
        assert own == sorted(own)


def test_two_runs_with_a_failure_between(spark, tmp_path):
    """Nothing is sent twice or out of order; what was held goes out once the failure is lifted."""
    sending = Sending(spark, tmp_path)
    sending.refused = {"A00103"}
    sending.arrive(*[f"A0010{i}" for i in range(1, 6)], "B00101", "B00102")
    first = sending.run()
    assert [k for k, _ in first] == ["A00101", "A00102", "B00101", "B00102"]
    assert rows(sending.job().waiting(), "sTransNox", "sFatexxxx") == [("A00103", "failed"), ("A00104", "held"), ("A00105", "held")]
    # More rows come while the branch is held back; one of them is there already, one was sent before, one is marked as sent.
    sending.arrive("A00106", "A00104", "A00101", "B00103")
    sending.arrive("B00109", state="1")
    second = sending.run()
    assert [k for k, _ in second] == ["A00101", "A00102", "B00101", "B00102", "B00103"]
    sending.refused = set()
    third = sending.run()
    assert sorted(k for k, _ in third) == [*[f"A0010{i}" for i in range(1, 7)], "B00101", "B00102", "B00103"]
    in_order_and_once(third)
    assert sending.job().waiting().isEmpty() and sending.run() == third


def test_a_delivery_step_again_gives_the_same(spark, tmp_path):
    sending = Sending(spark, tmp_path)
    sending.refused = {"A00102"}
    sending.arrive("A00101", "A00102", "A00103")
    sent = sending.run()
    again = spark.createDataFrame([(k, "S1", "DCPx", "1", "0") for k in ("A00101", "A00102", "A00103")], delivery.QUEUE)
    sending.job().run(0, again)
    assert [(r.sTransNox, r.nStepxxxx) for r in sending.job().delivered().collect()] == sent == [("A00101", 0)]
    # A step that was lost after its ledger and before its waiting rows: the ledger is not seen, and written anew.
    sending.refused = set()
    spark.createDataFrame([("A00199", "x", day(3), 1)], delivery.LEDGER).write.parquet(f"{tmp_path}/state/ledger/rows/step=1")
    assert [k for k, _ in sending.run()] == ["A00101", "A00102", "A00103"]


def test_only_long_documents_are_numbered_across_tasks(spark, monkeypatch):
    """Short ones are listed whole and cut; the result is the same either way."""
    masters = spark.createDataFrame([master("S1"), master("S2")], MASTER)
    lines = spark.createDataFrame(
        [("S1", i, f"a{i}", "C", day(1)) for i in (5, 3, None, 4, 2, 3)] + [("S2", 1, "x", "C", day(1)), (None, 1, "x", "C", day(1))], LINE
    )
    numbered, dense = [], outbox.dense_position

    def counted(df, *args, **named):
        numbered.append(df.count())
        return dense(df, *args, **named)

    monkeypatch.setattr(outbox, "dense_position", counted)
    want = {("S1", 0): [None, 2, 3, 3], ("S1", 1): [4, 5], ("S2", 0): [1]}
    for limit, long_lines in ((100_000, []), (5, [6])):
        monkeypatch.setattr(outbox, "LINES_PER_PART", limit)
        nested = outbox.nest_master_detail(masters, lines, per_part=4)
        assert {(r.sTransNox, r.nPartxxxx): [x.nEntryNox for x in r.detail] for r in nested.collect()} == want
        assert numbered == long_lines
