import json
from datetime import date

from pyspark.sql import functions as F

from changeflow.functions import address_line, default_fill, full_name, short_name
from changeflow.operators import collections
from changeflow.sources import collection_files
from helpers import rows


def test_names_and_addresses(spark):
    data = spark.createDataFrame(
        [("D", "J", "Jr", "M"), ("D", "J", "", "M"), ("D", "J", None, "M"), ("D", "J", "Jr", None)],
        "l string, f string, s string, m string",
    )
    l, f, s, m = (F.col(c) for c in "lfsm")
    names = [r[0] for r in data.select(full_name(l, f, s, m)).collect()]
    assert names == ["D, J Jr M", "D, J M", "D, J M", None]
    assert data.select(short_name(l, f, m)).first()[0] == "D, J M"
    assert data.select(address_line(l, f, s, m)).first()[0] == "D, J, Jr M"


def test_default_fill_touches_only_named_columns(spark):
    data = spark.createDataFrame([(None, None, None, None)], "a string, b string, n int, x double")
    assert default_fill(data, ["a"], ["n", "x"]).first() == ("", None, 0, 0.0)


def people(spark):
    return spark.createDataFrame(
        [("P1", "One Co", None, "St 1", "B1", "T1", "0900"), ("P2", "Two Co", "7", "St 2", "BX", "TX", None)],
        "sClientID string, sCompnyNm string, sHouseNox string, sAddressx string, sBrgyIDxx string, sTownIDxx string, sMobileNo string",
    )


def test_master_has_one_row_per_sheet(spark):
    sheets = spark.createDataFrame(
        [("A0011", date(2001, 1, 2), "R", None, "0", "1", 3, "P1"), ("X0011", date(2001, 1, 2), "R", None, "0", "1", 3, None)],
        "sTransNox string, dTransact date, sReferNox string, dReferDte date, cTranStat string, cDCPTypex string, nEntryNox int, sCollctID string",
    )
    routes = spark.createDataFrame([("P1", "north"), ("P1", "east")], "sCollctID string, sRouteNme string")
    branches = spark.createDataFrame([("A001", "Main")], "sBranchCd string, sBranchNm string")
    got = collections.collection_master(sheets, people(spark), routes, branches)
    assert rows(got, "sTransNox", "xCollName", "sRouteNme", "sBranchNm") == [
        ("A0011", "One Co", "east", "Main"), ("X0011", None, None, None),
    ]


def test_detail_appointments_and_defaults(spark):
    lines = spark.createDataFrame(
        [("A0011", i, a, "0") for i, a in enumerate(("later", "earlier", "due", "past", "unknown", None), 1)],
        "sTransNox string, nEntryNox int, sAcctNmbr string, cIsDCPxxx string",
    )
    sheets = spark.createDataFrame([("A0011", date(2001, 3, 1))], "sTransNox string, dTransact date")
    account = "sAcctNmbr string, sClientID string, sSerialID string"
    accounts = spark.createDataFrame(
        [("later", "P1", "S1"), ("earlier", "P2", "S9"), ("due", "P1", None), ("past", "P1", "S1")], account
    )
    for name, kind in {
        "nAmtDuexx": "double", "dDueDatex": "date", "nMonAmort": "double", "nABalance": "double", "nDelayAvg": "double",
        "nLastPaym": "double", "dLastPaym": "date",
    }.items():
        accounts = accounts.withColumn(name, F.lit(None).cast(kind))
    units = spark.createDataFrame(
        [
            ("later", "u1", date(2001, 3, 1), None), ("earlier", "u2", date(2001, 2, 28), date(2001, 12, 1)),
            ("due", "u3", None, date(2001, 3, 1)), ("past", "u4", None, date(2001, 2, 28)),
        ],
        "sAcctNmbr string, cApntUnit string, dAppointx date, dDueUntil date",
    )
    coordinates = spark.createDataFrame([("P1", 1.0, 2.0), ("P1", 3.0, 4.0)], "sClientID string, nLongitud double, nLatitude double")
    serials = spark.createDataFrame([("S1", "E1")], "sSerialID string, sEngineNo string")
    barangays = spark.createDataFrame([("B1", "Brgy")], "sBrgyIDxx string, sBrgyName string")
    towns = spark.createDataFrame([("T1", "Town")], "sTownIDxx string, sTownName string")
    got = collections.collection_detail(lines, sheets, accounts, people(spark), barangays, towns, units, coordinates, serials)
    # Two coordinates of client P1 give two rows each; every line is kept.
    assert rows(got, "nEntryNox", "cApntUnit", "sHouseNox", "sTownName", "nLongitud", "sSerialID", "sSerialNo") == [
        (1, "u1", "", "Town", 1.0, "S1", "E1"), (1, "u1", "", "Town", 3.0, "S1", "E1"),
        (2, "", "7", None, 0.0, None, None),
        (3, "u3", "", "Town", 1.0, None, None), (3, "u3", "", "Town", 3.0, None, None),
        (4, "", "", "Town", 1.0, "S1", "E1"), (4, "", "", "Town", 3.0, "S1", "E1"),
        (5, "", "", None, 0.0, None, None), (6, "", "", None, 0.0, None, None),
    ]


def entry(n, key="S1", text='{"a":"b"}'):
    return {
        "sTransNox": key, "nEntryNox": n, "sAcctNmbr": "x", "sRemCodex": "r", "sJsonData": text, "dReceived": "d",
        "sUserIDxx": "u", "sDeviceID": "v", "dModified": "m", "dTimeStmp": None,
    }


def test_field_entries_round_trip_and_rejection(spark, tmp_path):
    files = {
        "good.txt": {"android": [entry("1"), entry("2", text="it's \"quoted\"")]},
        "bad.txt": {"android": [entry("1"), entry("one")]},
        "null.txt": {"android": [entry(None)]},
        "empty.txt": {"android": []},
        "other.txt": {"detail": [entry("1")]},
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content, indent=1))
    (tmp_path / "broken.txt").write_text("{")
    got = collection_files.read_field_entries(spark, str(tmp_path))
    assert rows(got, "sFileName", "nEntryNox", "sJsonData") == [
        ("good.txt", 1, '{"a":"b"}'), ("good.txt", 2, "it's \"quoted\""),
    ]
    texts = collection_files.read_texts(spark, str(tmp_path))
    assert [r[0] for r in rows(collection_files.rejected_field_files(texts))] == ["bad.txt", "broken.txt", "null.txt", "other.txt"]

    masters = spark.createDataFrame([("S1",), ("S2",)], "sTransNox string")
    [out] = collection_files.export_field_entries(got.drop("sFileName"), masters).collect()
    assert json.loads(out.value) == files["good.txt"]
    parts = collection_files.export_field_entries(got.drop("sFileName"), masters, per_part=1)
    assert rows(parts, "nPartxxxx") == [(0,), (1,)]
    assert collection_files.export_field_entries(got.drop("sFileName"), masters.filter("sTransNox = 'S2'")).count() == 0


def test_service_replies_carry_entries_too(spark):
    texts = [{"result": "success", "detail": [entry("4")]}, {"result": "error", "detail": [entry("5")]}]
    replies = spark.createDataFrame([(str(i), json.dumps(t)) for i, t in enumerate(texts)], "sFileName string, value string")
    assert rows(collection_files.parse_field_entries(replies, "detail"), "nEntryNox") == [(4,)]


def plan_without_broadcast(spark, df_of):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return df_of()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_a_branch_with_several_names_gives_as_many_sheets_after_the_joins(spark):
    sheet = "sTransNox string, dTransact date, sReferNox string, dReferDte date, cTranStat string, cDCPTypex string, nEntryNox int, sCollctID string"
    sheets = spark.createDataFrame([(f"{b}1", date(2001, 1, 2), "R", None, "0", "1", 3, "P1") for b in ("A001", "B001", "C001")], sheet)
    routes = spark.createDataFrame([("P1", "north")], "sCollctID string, sRouteNme string")
    branches = spark.createDataFrame([("A001", "Main"), ("A001", "Old"), ("A001", "Main"), ("B001", None), (None, "x")], "sBranchCd string, sBranchNm string")
    got = collections.collection_master(sheets, people(spark), routes, branches)
    assert rows(got, "sTransNox", "sBranchNm") == [("A0011", "Main"), ("A0011", "Main"), ("A0011", "Old"), ("B0011", None), ("C0011", None)]
    plan = plan_without_broadcast(spark, lambda: collections.collection_master(sheets, people(spark), routes, branches))
    assert plan.index("Generate") < plan.index("Join")  # the top of the plan comes first


def test_branch_names_come_last_to_a_profile(spark):
    """A code with several names multiplies accounts only when they have been shuffled for all else."""
    from checks.views import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    routes, employees, listed, people_, branches = t.route, t.employee, t.named_employee, t.person, t.branch
    twice = branches.unionByName(branches.withColumn("sBranchNm", F.concat(F.lit("Old "), "sBranchNm")))
    rest = (t.account, people_, t.town, t.province, t.serial, t.model, t.brand, t.color, t.application, t.coordinate)

    def late():
        return collections.account_profile(*rest, collections.route_profile(routes, employees, listed, people_), twice)

    early = collections.account_profile(*rest, collections.route_profile(routes, employees, listed, people_, twice))
    assert rows(late()) == rows(early) and late().count() > 0
    plan = plan_without_broadcast(spark, late)
    assert plan.split("SortMergeJoin")[1].lstrip().startswith("[sBranchCd")


def test_an_account_meets_its_branch_once_and_has_a_row_for_each_name(spark):
    """The names of a code come as one list, after the texts of client and route, which no other join shuffles."""

    def table(columns, *data):
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns.split()))

    accounts = table(
        "sAcctNmbr sClientID sApplicNo sSerialID sRouteIDx sCoCltID1 sCoCltID2 cLoanType cAcctStat",
        *((f"a{i}", "P1", "L1", "S1", r, "P2", None, "1", "0") for i, r in enumerate(("R1", "R2", "R3", "R4", "R9", None))),
        ("a6", "P9", "L1", "S1", "R1", "P2", None, "1", "0"), ("a7", "P1", "L1", "S1", "R1", "P2", None, "4", "0"),
    )
    clients = table(
        "sClientID sLastName sFrstName sSuffixNm sMiddName sAddressx sTownIDxx sBrgyIDxx",
        ("P1", "D", "J", None, "M", "St", "T1", "B1"), ("P2", "E", "K", "Jr", "N", "St", "T1", "B1"),
    )
    towns, provinces = table("sTownIDxx sTownName sZippCode sProvIDxx", ("T1", "Town", "1", "V1")), table("sProvIDxx sProvName", ("V1", "Prov"))
    serials, models = table("sSerialID sEngineNo sFrameNox sModelIDx sColorIDx", ("S1", "E", "F", "M1", "C1")), table("sModelIDx sModelNme sBrandIDx", ("M1", "Mod", "B1"))
    brands, colors = table("sBrandIDx sBrandNme", ("B1", "Make")), table("sColorIDx sColorNme", ("C1", "Red"))
    spots = spark.createDataFrame([("P1", 1.0, 2.0)], "sClientID string, nLatitude double, nLongitud double")
    routes = table(
        "sRouteIDx sRouteNme xCollectr xManagerx zCollectr zManagerx sBranchCd",
        *((f"R{i}", f"north {i}", None, None, None, None, b) for i, b in enumerate(("A001", "B001", "X001", None), 1)),
    )
    branches = table("sBranchCd sBranchNm", ("A001", "Main"), ("A001", "Old"), ("A001", "Main"), ("A001", None), ("B001", None), (None, "x"))

    def profile():
        return collections.account_profile(
            accounts, clients, towns, provinces, serials, models, brands, colors, table("sTransNox", ("L1",)), spots, routes, branches
        )

    assert rows(profile(), "sAcctNmbr", "sRouteNme", "xCBranchx", "xFullName", "xCoCltNm1", "xModelNme", "nLatitude") == [
        (a, r, b, "D, J M", "E, K Jr N", "Make Mod", 1.0)
        for a, r, b in (
            ("a0", "north 1", None), ("a0", "north 1", "Main"), ("a0", "north 1", "Main"), ("a0", "north 1", "Old"),
            ("a1", "north 2", None), ("a2", "north 3", None), ("a3", "north 4", None), ("a4", None, None), ("a5", None, None),
        )
    ]
    first, *joins = plan_without_broadcast(spark, profile).split("SortMergeJoin [")  # the top of the plan comes first
    assert "Generate" in first
    assert [j.split("#")[0] for j in joins[:5]] == ["sBranchCd", "sRouteIDx", "sClientID", "sClientID", "sSerialID"]
