import collections

import pytest

from changeflow.llm import line_dedup
from llm_helpers import DOCUMENTS, awkward

SPACES = " \t\n\v\f\r"


def cleaned(rows, ratio, least):
    pages, holding = collections.Counter(), collections.Counter()
    for host, text in rows:
        pages[host] += 1
        holding.update({(host, line.strip(SPACES)) for line in (text or "").split("\n") if line.strip(SPACES)})
    drop = {k for k, n in holding.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for host, text in rows:
        lines = text.split("\n") if text is not None else []
        kept = [line for line in lines if (host, line.strip(SPACES)) not in drop]
        out.append((host, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def held(documents, ratio=0.2, least=3):
    out = line_dedup.drop_boilerplate(documents, ratio=ratio, least_pages=least)
    got = collections.Counter((r.source, r.text, r.n_lines, r.n_dropped) for r in out.collect())
    assert got == collections.Counter(cleaned([(r.source, r.text) for r in documents.collect()], ratio, least))
    return got


def test_equals_brute_force(spark):
    rows = []
    for i in range(60):
        lines = [f"own line {i}", "  menu\t" if i % 2 else "menu", "", f"tens {i // 10}", "menu" if i % 3 else "x"]
        rows.append((i, "\n".join(lines), "en", "hot" if i % 3 else f"h{i % 4}", 1))
    got = held(spark.createDataFrame(rows, DOCUMENTS))
    assert any(n for *_, n in got)


@pytest.mark.parametrize("ratio", [0.0, 0.3])
def test_awkward_rows(spark, ratio):
    documents = awkward(spark)
    held(documents, ratio, 2)
    assert line_dedup.drop_boilerplate(documents.limit(0)).count() == 0


def test_clashing_columns_pass_or_are_replaced(spark):
    documents = spark.createDataFrame([(1, "a\nb", "s", 7, 8)], "doc_id int, text string, source string, n_lines int, pages int")
    assert [tuple(r) for r in line_dedup.drop_boilerplate(documents).select("pages", "n_lines", "n_dropped").collect()] == [(8, 2, 0)]


def test_is_native(spark):
    plan = line_dedup.drop_boilerplate(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
