import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
import test_jaccard_join
import test_line_dedup
import test_packing
import test_quality
from changeflow.llm import langid, line_dedup, pipeline, quality
from llm_helpers import DOCUMENTS, VOCABULARY, awkward, prose


def corpus(spark):
    rows = [(i, prose(lang, 60 + i % 40, i), lang, f"s{i % 2}", 1) for i in range(120) for lang in [sorted(VOCABULARY)[i % 2]]]
    menu = "Read the whole story of the day on our pages."
    rows = [(i, f"{menu}\n{t}" if i % 4 == 0 else t, *rest) for i, t, *rest in rows]
    rows += [(200 + i, rows[i][1] + "\nAnd this was the end.", *rows[i][2:]) for i in range(10)]
    rows += [(300, "1 2 3 " * 40, "en", "s0", 1), (301, "a | b | c | d\n" * 30, "en", "s0", 1)]
    return spark.createDataFrame(rows, DOCUMENTS), menu


def test_stages_take_effect(spark):
    documents, menu = corpus(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "language ID", "line dedup", "n-gram Jaccard join", "packing"]
    kept = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, "").collect(), DOCUMENTS)
        assert tuple(kept.columns) == pipeline.COLUMNS
        if name == "quality rules":
            assert {r.doc_id for r in documents.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()} == {300, 301}
        if name == "line dedup":
            assert not any(menu in r.text for r in kept.collect())
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & set(range(200, 210)) and set(range(120)) <= ids
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, "").collect()
    assert {r.doc_id for r in pieces} == ids


def without_failed_lines(text):
    lines = text.split("\n")
    judged = [(line, len(test_quality.WORD.findall(line))) for line in lines]
    kept = [line for line, n in judged if n == 0 or quality.failed_rule(line, n) is None]
    lost = sum(n for line, n in judged if n and quality.failed_rule(line, n))
    return "\n".join(kept), lost


def brute_force(spark, rows):
    """What run() packs: texts by id, worked out one after the other. Rows are (doc_id, text, lang, source)."""
    out = []
    for i, text, lang, source in rows:
        n_words, *_, base_failed = test_quality.brute_force(text)
        cleaned, lost = without_failed_lines(text or "")
        if not base_failed and 100 * lost <= quality.MOST_LOST * n_words:
            out.append((i, cleaned, lang, source))
    model = langid.fit(langid.learnable(spark.createDataFrame([(*r, 1) for r in out], DOCUMENTS)))
    told = [(r, *model.predict(r[1])) for r in out]
    out = [r for r, lang, score in told if lang != langid.UNKNOWN and score >= pipeline.LEAST_SCORE]
    cleaned = test_line_dedup.cleaned([(r[3], r[1]) for r in out], line_dedup.RATIO, line_dedup.LEAST_PAGES)
    out = [(r[0], text) for r, (_, text, _, dropped) in zip(out, cleaned) if not dropped or test_quality.WORD.search(text)]
    groups = test_jaccard_join.brute_force(out, 5, 80)
    return {i: text for i, text in out if groups[i][1] == i}


def test_run_equals_brute_force(spark, tmp_path):
    documents, _ = corpus(spark)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r)[:4] for r in documents.collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    lengths = test_packing.held(corpus_pipeline.run(spark, str(tmp_path)).collect(), brute_force(spark, rows), tokenizer, 1024, 64)
    assert test_packing.padding(lengths, 1024) == 0


def test_run_reads_documents_and_writes_stages(spark, tmp_path):
    documents, _ = corpus(spark)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert "sequence_id" in out.columns and out.select("doc_id").distinct().count() == 120


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() >= 0
    awkward(spark).limit(0).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0


def shuffled_prose(seed, n=14):
    return [f"{line[:-1]} number{seed}x{i}." for i, line in enumerate(prose("en", 9 * n, seed).split("\n"))]


def test_line_stage_leaves_copies_to_the_near_copy_stage(spark):
    menu = "Read the whole story of the day on our pages."
    alone = [(i, "\n".join([menu] * (i % 2) + shuffled_prose(i)), "en", "s", 1) for i in range(60)]
    exact = [(100 + i, "\n".join([menu, *shuffled_prose(100)]), "en", "s", 1) for i in range(20)]
    near = [(200 + i, "\n".join([menu, *shuffled_prose(200), f"And this was end{i}."]), "en", "s", 1) for i in range(20)]
    only = [(300 + i, menu, "en", "s", 1) for i in range(8)]
    documents = spark.createDataFrame(alone + exact + near + only, DOCUMENTS)
    cleaned = spark.createDataFrame(pipeline.line_stage(spark, documents, "").collect(), DOCUMENTS)
    told = {r.doc_id: r.text for r in cleaned.collect()}
    # The menu goes on account of the pages that stand alone, from copies too; a document of nothing else stays.
    expected = {i: t if t == menu else t.removeprefix(menu + "\n") for i, t, *_ in alone + exact + near + only}
    assert told == expected
    chosen = {r.doc_id: r.text for r in pipeline.near_copy_stage(spark, cleaned, "").collect()}
    assert chosen == {i: expected[i] for i in [*range(60), 100, 200, 300]}


def test_line_stage_keeps_the_smallest_group_of_copies(spark):
    text = "\n".join(shuffled_prose(7))
    rows = [(i, text if i < 5 else "\n".join(shuffled_prose(i + 10)), "en", "s", 1) for i in range(99)]
    cleaned = pipeline.line_stage(spark, spark.createDataFrame(rows, DOCUMENTS), "")
    assert [r.text for r in cleaned.orderBy("doc_id").collect()] == [t for _, t, *_ in rows]


def test_near_copy_stage_keeps_different_texts_of_one_id(spark):
    a, b, c = ("\n".join(shuffled_prose(i)) for i in range(3))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "t", 1), (1, a, "en", "s", 1), (2, b + "\nEnd.", "en", "s", 1), (3, c, "en", "s", 1), (3, c + "\nEnd.", "en", "s", 1),
            (0, c + "\nStop.", "en", "s", 1), (None, a, "en", "s", 1), (None, a, "en", "s", 1), (4, None, "en", "s", 1), (4, "", "en", "s", 1)]
    kept = pipeline.near_copy_stage(spark, spark.createDataFrame(rows, DOCUMENTS), "").collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == sorted([(1, a), (1, b), (-1, c + "\nStop."), (-1, a), (-1, a), (4, "")])
