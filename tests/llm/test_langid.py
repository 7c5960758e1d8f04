import numpy as np
from pyspark.sql import functions as F

from changeflow.llm import langid
from llm_helpers import DOCUMENTS, VOCABULARY, awkward, prose


def corpus(spark, n=160):
    rows = [(i, prose(lang, 20 + i % 50, 1000 + i), lang, "s", 1) for i in range(n) for lang in [sorted(VOCABULARY)[i % 2]]]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_held_out_accuracy_and_range(spark):
    documents = corpus(spark)
    model = langid.fit(langid.learnable(documents))
    assert model.languages == ["en", "fr"] and (model.weights != 0).mean() < 0.5
    out = langid.predict(documents, model).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    tested = [r for r in out if r.out]
    assert len(tested) > 20 and np.mean([r.lang == r.lang_pred for r in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_held_out_rows_teach_nothing(spark):
    documents = corpus(spark)
    spoilt = documents.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    spoilt = spoilt.withColumn("text", F.when(F.col("lang") == "xx", "zzz").otherwise(F.col("text")))
    one, other = (langid.fit(langid.learnable(d)) for d in (documents, spoilt))
    assert one.languages == other.languages and np.array_equal(one.weights, other.weights) and np.array_equal(one.idf, other.idf)


def test_sample_is_bounded_and_deterministic(spark):
    documents = langid.learnable(corpus(spark))
    one, other = langid.fit(documents, sample=40), langid.fit(documents.repartition(7), sample=40)
    assert np.array_equal(one.weights, other.weights) and one.temperature == other.temperature


def test_penalty_keeps_weights_at_zero(monkeypatch):
    monkeypatch.setattr(langid, "L1", 0.1)
    rng = np.random.default_rng(0)
    rows = [(np.array([label, 100 + rng.integers(50)]), np.array([1.0, 0.01]), label) for label in rng.integers(0, 2, 200).tolist()]
    weights = langid.follow_the_leader(rows, 2)
    assert weights[0, 0] > 0 > weights[0, 1] and not weights[100:150].any()


def test_temperature_fits_overconfident_scores():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 4000)
    right = rng.random(4000) < 0.8
    scores = np.where((labels == 1) == right, 1.0, -1.0)[:, None] * np.array([-8.0, 8.0])
    temperature = langid.calibrated(scores, labels)
    assert abs(langid.probabilities(scores, temperature).max(1).mean() - 0.8) < 0.03


def test_unknown_and_awkward_rows(spark):
    documents = awkward(spark)
    model = langid.fit(langid.learnable(documents.unionByName(corpus(spark))))
    out = langid.predict(documents.withColumnRenamed("n_chars", "score"), model).collect()
    assert len(out) == documents.count()
    for r in out:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == langid.UNKNOWN) == (not letters) and (letters or r.score == 0)
    empty = langid.fit(langid.learnable(documents.limit(0)))
    assert empty.languages == [] and langid.predict(documents, empty).filter("lang_pred <> 'und'").isEmpty()
    assert langid.predict(documents.limit(0), model).count() == 0


def plain_leader(rows, buckets, classes):
    """Follow the regularised leader one weight at a time, from its definition."""
    import math

    z = {(b, c): 0.0 for b in buckets for c in range(classes)}
    n = dict(z)

    def weight(key):
        if abs(z[key]) <= langid.L1:
            return 0.0
        return (math.copysign(langid.L1, z[key]) - z[key]) / ((langid.OFFSET + math.sqrt(n[key])) / langid.RATE + langid.L2)

    for _ in range(langid.PASSES):
        for at, value, label in rows:
            w = {(b, c): weight((b, c)) for b in at for c in range(classes)}
            scores = [sum(v * w[b, c] for b, v in zip(at, value)) for c in range(classes)]
            top = [math.exp(s - max(scores)) for s in scores]
            for c in range(classes):
                error = top[c] / sum(top) - (c == label)
                for b, v in zip(at, value):
                    g = v * error
                    rate = (math.sqrt(n[b, c] + g * g) - math.sqrt(n[b, c])) / langid.RATE
                    z[b, c] += g - rate * w[b, c]
                    n[b, c] += g * g
    return {key: weight(key) for key in z}


def test_training_equals_the_definition(monkeypatch):
    monkeypatch.setattr(langid, "L1", 0.3)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(30):
        at = np.sort(rng.choice(12, 4, replace=False))
        rows.append((at, rng.random(4), i % 3))
    weights = langid.follow_the_leader(rows, 3)
    plain = plain_leader([(a.tolist(), v.tolist(), y) for a, v, y in rows], range(12), 3)
    assert all(abs(weights[b, c] - w) < 1e-9 for (b, c), w in plain.items())
    assert (weights[:12] != 0).any() and (weights[:12] == 0).any() and not weights[12:].any()


def test_more_labels_than_the_sample_and_hot_rows(spark):
    """Every label keeps a row of the sample, and rows alike count once."""
    texts = [(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)} and more", f"l{i:03d}") for i in range(40)]
    hot = [(1000, "the same text again and again", "l000")] * 300
    model = langid.fit(spark.createDataFrame(texts + hot, "id bigint, text string, lang string"), sample=20)
    assert len(model.languages) == 40 and np.abs(model.weights).sum() > 0
