import random

import pytest

from changeflow.operators import sync
from changeflow.plans import resync
from helpers import LOG, change, day, rows

REQUEST = "sExportCd string, sClientID string, sExportFr string, sExportTr string"


def covered(ranges):
    """Disjoint ranges by going over them one by one."""
    out = []
    for first, last in sorted(r for r in ranges if None not in r and r[0] <= r[1]):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def test_merging_equals_going_over_the_ranges(spark):
    rng = random.Random(1)
    made = [("g" if rng.random() < 0.6 else rng.choice(["h", "i", None]), *(f"{rng.randrange(3000):04d}" for _ in range(2))) for _ in range(400)]
    made += [("h", "5000", "5000"), ("h", "5000", "5000"), ("h", "5001", "5002"), ("h", "5002", "6000"), ("h", None, "9"), ("h", "1", None)]
    made = [(g, a, a and b and f"{int(a) + rng.randrange(15):04d}" if g in ("g", "i") else b) for g, a, b in made]
    df = spark.createDataFrame(made, "g string, f string, t string").repartition(7)
    for tasks in (1, 3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = [tuple(r) for r in sync.merge_ranges(df, ["g"], "f", "t").collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for group in ("g", "h", "i", None):
            assert sorted(r[1:] for r in got if r[0] == group) == covered([r[1:] for r in made if r[0] == group])
    assert sync.merge_ranges(df.limit(0), ["g"], "f", "t").count() == 0


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(2)
    made = []
    for i in range(1500):
        branch = "A001" if i % 3 else rng.choice(["A002", "B001", "B002"])
        owner, dest = rng.choice(["A001", "A002", "B001", None]), rng.choice(["A001", "A002", "B002", None])
        made.append(change(f"{branch}{i:05d}", owner=owner or "", table=f"T{rng.randrange(6)}", dest=dest, by=f"U{i % 4}", modified=day(1 + rng.randrange(5))))
    made = [m[:1] + (m[1] or None,) + m[2:] for m in made]
    return spark.createDataFrame(made, LOG)


def test_thousands_of_overlapping_ranges_on_one_prefix(spark, log):
    rng = random.Random(3)
    asked = []
    for i in range(3000):
        first = rng.randrange(1400)
        asked.append(("x", "NODE_A001", f"A001{first:05d}", f"A001{first + rng.randrange(6):05d}"))
    asked += [("x", "NODE_B001", "", "B00100700"), ("x", "NODE_B002", "B00200100", "B00200050"), ("x", "NODE_A002", "", "")]
    requests = spark.createDataFrame(asked, REQUEST)
    merged = sync.requested_ranges(requests)
    assert merged.count() < 1000
    got = sync.merged_range_match(log, requests)
    assert rows(got) == rows(sync.request_range_match(log, requests))
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def registry(spark):
    # T5 is not registered, so it never leaves; type 4 has no rule of its own.
    return spark.createDataFrame([("T0", "0"), ("T1", "1"), ("T2", "2"), ("T3", "3"), ("T4", "4")], "sTableNme string, cTableTyp string")


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(
        [
            ("A0012001", "NODE_A002", "A00200300", None), ("A0012001", "NODE_B001", "", None), ("A0012001", "NODE_B001", "B00100900", None),
            ("A0022001", "NODE_A001", "A00100200", None), ("A0022001", "NODE_B001", "B00100600", None), ("B0012001", "NODE_A001", "A00100800", None),
            ("B0012001", "NODE_B002", "B00299999", None), ("B0032001", "NODE_A001", "A00101000", None), ("C0012001", "NODE_D001", "", None),
        ],
        REQUEST,
    ).drop("sExportTr")


def test_every_requester_gets_its_own_answer(spark, log, registry, requests):
    answers = resync.answers(log, requests, registry)
    seen = 0
    for target in ("A001", "A002", "B001", "B003", "C001", "Z001"):
        mine = requests.filter(requests.sExportCd.startswith(target))
        want = [tuple(r) for r in resync.answer(log, mine, registry, target).collect()]
        got = [tuple(r) for r in answers.of(target).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert [(r[7], r[0]) for r in got] == [(r[7], r[0]) for r in want]  # in the order of applying
        seen += len(got)
    assert seen > 700


def test_shared_changes_are_stored_once(spark, log, registry, requests):
    """Ten times the requesters make no more rows of changes for all."""
    more = requests
    for i in range(10):
        more = more.unionByName(requests.selectExpr(f"concat('A9{i:02d}', substring(sExportCd, 5, 4)) as sExportCd", "sClientID", "sExportFr"))
    once, many = (resync.answers(log, r, registry).changes.filter("sScopexxx = 'all'") for r in (requests, more))
    assert once.count() == many.count() == once.select("sTransNox", "sModified").distinct().count() > 100


def test_places_are_numbered_in_the_order_of_applying(spark, log, registry, requests):
    changes = resync.answers(log, requests, registry).changes
    by_address = {}
    for r in changes.collect():
        by_address.setdefault((r.sScopexxx, r.sTargetxx), []).append(r)
    for found in by_address.values():
        found.sort(key=lambda r: r.nPlacexxx)
        assert [r.nPlacexxx for r in found] == list(range(1, len(found) + 1))
        assert found == sorted(found, key=lambda r: (r.dModified, r.sTransNox, r.sModified))
    nothing = resync.answers(log.limit(0), requests, registry)
    assert nothing.changes.count() == 0 and nothing.of("A001").count() == 0
