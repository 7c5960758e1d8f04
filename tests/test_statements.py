import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators import ingest, statements
from helpers import LOG, change, day, rows

NOTE = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("at", T.DateType()), T.StructField("x", T.DoubleType())])


def logged(spark, *texts):
    made = [(*change(f"A001{i:02d}", modified=day(1, i % 24))[:2], text, *change("A00100", modified=day(1 + i // 24, i % 24))[3:]) for i, text in enumerate(texts)]
    return spark.createDataFrame(made, LOG)


def parsed(spark, text):
    return [
        (r.sVerbxxxx, r.sSchemaxx, r.sTargetTb, r.mValuesxx, r.mKeyxxxxx) if r.sProblemx is None else r.sProblemx
        for r in statements.parse_statements(logged(spark, text)).orderBy("nPartxxxx").collect()
    ]


CASES = {
    "INSERT INTO t SET a='x', b=1": [("INSERT", None, "t", {"a": "x", "b": "1"}, {})],
    "  insert\n into t set a = 'x' ;  ": [("INSERT", None, "t", {"a": "x"}, {})],
    "INSERT t (a) VALUE ('x')": [("INSERT", None, "t", {"a": "x"}, {})],
    "INSERT LOW_PRIORITY IGNORE INTO `d b`.`t``1` (`a``b`, t.c) VALUES (1, NULL), (-2.5E-3, TRUE)": [
        ("INSERT", "d b", "t`1", {"a`b": "1", "c": None}, {}), ("INSERT", "d b", "t`1", {"a`b": "-2.5E-3", "c": "1"}, {}),
    ],
    "REPLACE DELAYED d . t SET a='it''s; \"y\", (z) WHERE b=1', c=\"say \"\"so\"\"\"": [
        ("REPLACE", "d", "t", {"a": "it's; \"y\", (z) WHERE b=1", "c": 'say "so"'}, {}),
    ],
    r"UPDATE t SET a='\\', b='\'', c='a\\\'b\n\t\0', d='\%\_\q', e='' WHERE k=''''": [
        ("UPDATE", None, "t", {"a": "\\", "b": "'", "c": "a\\'b\n\t\0", "d": "\\%\\_q", "e": ""}, {"k": "'"}),
    ],
    "UPDATE d.t SET t.a=+5 WHERE (d.t.k = 'x') AND `j`=.5 LIMIT 1": [("UPDATE", "d", "t", {"a": "5"}, {"k": "x", "j": ".5"})],
    "DELETE QUICK FROM where_it WHERE a=1 and b='AND'": [("DELETE", None, "where_it", {}, {"a": "1", "b": "AND"})],
    "INSERT INTO größe SET höhe='é🙂'": [("INSERT", None, "größe", {"höhe": "é🙂"}, {})],
    "INSERT INTO t(a)VALUES('x')ON DUPLICATE KEY UPDATE a='y'": ["on duplicate"],
    "INSERT INTO t SET a='ON DUPLICATE; `'": [("INSERT", None, "t", {"a": "ON DUPLICATE; `"}, {})],
    "INSERT INTO t VALUES (1)": ["columns"],
    "INSERT INTO t (a, b) VALUES (1, 2), (3)": [("INSERT", None, "t", {"a": "1", "b": "2"}, {}), "columns"],
    "INSERT INTO t (a, A) VALUES (1, 2)": ["columns"],
    "INSERT INTO t SET a=NOW()": ["value"],
    "INSERT INTO t (a) SELECT a FROM u": ["value"],
    "INSERT INTO t SET a=1 WHERE b=2": ["value"],
    "UPDATE t SET a=a+1 WHERE k=1": ["value"],
    "UPDATE t SET a=1+1 WHERE k=1": ["value"],
    "UPDATE t SET a=1": ["no key"],
    "DELETE FROM t": ["no key"],
    "DELETE FROM t WHERE a>1": ["condition"],
    "DELETE FROM t WHERE a=1 OR b=2": ["condition"],
    "DELETE FROM t WHERE a=NULL": ["condition"],
    "DELETE FROM t WHERE a=1 AND A=2": ["condition"],
    "UPDATE t SET a=1 WHERE k IN ('x')": ["condition"],
    "INSERT INTO t SET a='open": ["open quote"],
    "INSERT INTO t SET a='open\\'": ["open quote"],
    "INSERT INTO t SET a=1; DROP TABLE t": ["several statements"],
    "DROP TABLE t": ["verb"], "": ["verb"], "INSERTED INTO t SET a=1": ["verb"], "INSERT INTO ''": ["table"],
}


def test_forms_of_statements(spark):
    texts = list(CASES)
    got = {}
    for r in statements.parse_statements(logged(spark, *texts)).orderBy("sTransNox", "nPartxxxx").collect():
        told = (r.sVerbxxxx, r.sSchemaxx, r.sTargetTb, r.mValuesxx, r.mKeyxxxxx) if r.sProblemx is None else r.sProblemx
        got.setdefault(r.sStatemnt, []).append(told)
    assert got == CASES


def test_values_of_any_text_come_back(spark):
    """Random texts, written in each of the three ways of quoting."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab'\"\\`,;()=é\n\0% WHERE") for _ in range(rng.randrange(30))) for _ in range(300)]
    quoted = []
    for text in texts:
        slashed = text.replace("\\", "\\\\")
        quoted += [(text, "'" + slashed.replace("'", "''") + "'"), (text, '"' + slashed.replace('"', '""') + '"')]
        quoted += [(text, "'" + slashed.replace("'", "\\'").replace("\n", "\\n").replace("\0", "\\0") + "'")]
    made = [f"UPDATE t SET a={v}, b = 1 WHERE k={v}" for _, v in quoted] + [f"INSERT INTO t (a, b) VALUES ({v},{v}) , (1, {v})" for _, v in quoted]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(made)], "i int, sStatemnt string")
    told = {(r.i, r.nPartxxxx): r for r in statements.parse_statements(df).collect()}
    for i, (text, _) in enumerate(quoted):
        assert told[i, 1].mValuesxx == {"a": text, "b": "1"} and told[i, 1].mKeyxxxxx == {"k": text}
        assert told[i + len(quoted), 1].mValuesxx == {"a": text, "b": text} and told[i + len(quoted), 2].mValuesxx == {"a": "1", "b": text}


def test_long_texts_take_no_stack(spark):
    value = "x''\\'" * 100_000
    many = ",".join(f"({i},'{i}')" for i in range(20_000))
    got = statements.parse_statements(logged(spark, f"INSERT INTO t SET a='{value}'", f"INSERT INTO t (a,b) VALUES {many}", "INSERT INTO t SET a='" + value))
    told = got.groupBy("sTransNox").agg(F.count("*").alias("n"), F.max(F.length(F.col("mValuesxx.a"))).alias("size"), F.max("sProblemx").alias("p"))
    assert [tuple(r)[1:] for r in told.orderBy("sTransNox").collect()] == [(1, 300_000, None), (20_000, 5, None), (1, None, "open quote")]


def test_verb_and_table_of_the_profile(spark):
    texts = ["UPDATE `db`.`T1` SET a=1", "INSERT LOW_PRIORITY INTO T1 SET a=1", "DELETE FROM db.T1 WHERE a=1", "REPLACE T2 SET a=1", "x"]
    got = ingest.statement_parts(logged(spark, *texts)).select("sVerbxxxx", "sTargetTb", "bSameTabl").collect()
    assert [tuple(r) for r in got] == [("UPDATE", "T1", True), ("INSERT", "T1", True), ("DELETE", "T1", True), ("REPLACE", "T2", False), ("", "", False)]


def notes(spark, *rows_):
    return spark.createDataFrame([(r[0], r[1], None, r[2]) for r in rows_], NOTE)


def applied(spark, target, *texts):
    df = statements.apply_statements(target, statements.parse_statements(logged(spark, *texts)), "Note", ["id"])
    return [(r.id, r.n, r["at"] and str(r["at"]), r.x) for r in df.orderBy("id").collect()]


def test_changes_of_a_key_are_folded_in_order(spark):
    target = notes(spark, ("a", 1, 1.0), ("b", 2, 2.0), ("c", 3, 3.0), ("d", 4, 4.0))
    got = applied(
        spark, target,
        "UPDATE note SET n=10 WHERE id='a'", "UPDATE note SET n=11, x=NULL WHERE id='a'",  # the last of each column
        "DELETE FROM note WHERE id='b'", "UPDATE note SET n=5 WHERE id='b'",  # altering what is gone does nothing
        "UPDATE note SET n=9 WHERE id='c'", "REPLACE note SET id='c', x=7", "UPDATE note SET at='2001-02-03' WHERE id='c'",
        "UPDATE note SET n=1 WHERE id='zz'",  # no such row
        "INSERT note (id, n) VALUES ('e', 1), ('f', 2), ('e', 3)",  # the later part of a statement wins
        "UPDATE other SET n=0 WHERE id='d'",
    )
    assert got == [("a", 11, None, None), ("c", None, "2001-02-03", 7.0), ("d", 4, None, 4.0), ("e", 3, None, None), ("f", 2, None, None)]


def test_problems_of_typed_changes(spark):
    texts = {
        "INSERT note SET id='a', nope=1": "unknown column", "INSERT note SET n=1": "key", "INSERT note SET id=NULL": "key",
        "UPDATE note SET id='b' WHERE id='a'": "key", "UPDATE note SET n=1 WHERE n=2": "key", "DELETE FROM note WHERE id='a' AND n=1": "key",
        "UPDATE note SET n='many' WHERE id='a'": "type", "UPDATE note SET n=1": "no key", "UPDATE NOTE SET N=1 WHERE ID='a'": None,
    }
    parsed_rows = statements.parse_statements(logged(spark, *texts))
    got = statements.table_changes(parsed_rows, "Note", NOTE, ["id"]).orderBy("sTransNox").select("sProblemx").collect()
    assert [r[0] for r in got] == list(texts.values())
    target = notes(spark, ("a", 7, 0.0))
    assert applied(spark, target, *texts) == [("a", 1, None, 0.0)]


def test_folding_equals_applying_one_by_one(spark):
    rng = random.Random(7)
    state = {k: {"n": i, "x": float(i)} for i, k in enumerate("abcd")}
    target = notes(spark, *[(k, v["n"], v["x"]) for k, v in state.items()])
    texts = []
    for _ in range(60):
        k, n = rng.choice("abcdef"), rng.randrange(100)
        kind = rng.randrange(4)
        if kind == 0:
            texts.append(f"REPLACE INTO note SET id='{k}', n={n}")
            state[k] = {"n": n, "x": None}
        elif kind == 1:
            texts.append(f"DELETE FROM note WHERE id='{k}'")
            state.pop(k, None)
        else:
            column, value = rng.choice([("n", n), ("x", n), ("x", None)])
            texts.append(f"UPDATE note SET {column}={'NULL' if value is None else value} WHERE id='{k}'")
            if k in state:
                state[k][column] = value
    got = applied(spark, target, *texts)
    assert got == [(k, v["n"], None, v["x"] if v["x"] is None else float(v["x"])) for k, v in sorted(state.items())]


@pytest.mark.parametrize("log", ["", "where false"])
def test_other_columns_stay_and_empty_logs(spark, log):
    df = logged(spark, "DELETE FROM t WHERE a=1").withColumn("a.b", F.lit(1)).filter("true" if not log else "false")
    got = statements.parse_statements(df)
    assert got.columns == [*df.columns, "nPartxxxx", "sVerbxxxx", "sSchemaxx", "sTargetTb", "mValuesxx", "mKeyxxxxx", "sProblemx"]
    assert got.count() == (0 if log else 1)
    null = spark.createDataFrame([(None,)], "sStatemnt string")
    assert rows(statements.parse_statements(null), "sProblemx") == [("verb",)]
