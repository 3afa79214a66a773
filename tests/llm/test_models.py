from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import language, toxicity
from tripflow.llm.common import even_sample, read
from tripflow.llm.workload import op8_toxicity, op10_language

FOLDER = "/root/testdata/sf0.01"


def plain_grams(text):
    text = text.lower()
    return {text[i : i + n] for n in range(1, language.LONGEST + 1) for i in range(len(text) - n + 1)}


def test_grams_are_those_of_the_whole_text():
    seen = np.zeros(language.BUCKETS, dtype=bool)
    for text in ("a", "Äpfel und Birnen", "ab" * 50, "", "🙂🙂"):
        found = language.grams(text, seen)
        wanted = plain_grams(text)
        assert len(wanted) - 1 <= len(found) <= len(wanted) and not seen.any()
    text = "".join(random.Random(1).choices("abcdefghij ", k=5000))
    whole = language.grams(text, seen)
    stretch, language._STRETCH = language._STRETCH, 64
    try:
        assert (language.grams(text, seen) == whole).all()
    finally:
        language._STRETCH = stretch


def test_kernel_is_the_normalized_overlap():
    seen = np.zeros(language.BUCKETS, dtype=bool)
    texts = ["the cat sat", "le chat assis", "die Katze", "the dog sat there"]
    values = language.Kernel([language.grams(t, seen) for t in texts[:3]]).rows(texts)
    for i, x in enumerate(texts):
        for j, z in enumerate(texts[:3]):
            a, b = plain_grams(x), plain_grams(z)
            assert values[i, j] == pytest.approx(len(a & b) / (len(a) * len(b)) ** 0.5, rel=0.02)


def test_regression_with_all_landmarks_is_kernel_ridge():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(30, 40))
    kernel = points @ points.T
    labels = rng.integers(0, 3, 30)
    weights = language.solve(kernel, [(kernel[:17], labels[:17]), (kernel[17:], labels[17:])], np.bincount(labels), 1e-9)
    assert ((np.column_stack([kernel, np.ones(30)]) @ weights).argmax(axis=1) == labels).all()


def test_languages_held_out(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    found = op10_language(spark, "/root/testdata/sf0.1")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.99 * len(held)


def test_held_out_labels_are_not_learned_from(spark):
    docs = read(spark, FOLDER, "documents").select("doc_id", "text", "lang")
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    one, two = language.fit(docs), language.fit(wrong)
    assert one.languages == two.languages and np.array_equal(one.weights, two.weights)


def test_odd_language_rows(spark):
    docs = read(spark, FOLDER, "documents")
    model = language.fit(docs)
    rows = [(1, None, "e"), (None, "the and of them", "e"), (3, "", "e"), (4, "123 --", None), (5, "the one and " * 200_000, "e"), (5, "x", "e"), (5, "x", "e")]
    odd = spark.createDataFrame(rows, "doc_id int, text string, score string")
    got = [tuple(r) for r in language.predict(odd, model).collect()]
    assert len(got) == 7
    by = {g[0]: g for g in got}
    assert by[1][2:] == ("und", 0.0) and by[3][2:] == ("und", 0.0) and by[4][2:] == ("und", 0.0)
    assert by[None][1:3] == (False, "en") and by[5][2] in model.languages
    kept = language.keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.count() == 4
    assert language.fit(docs.limit(0)) is None
    assert language.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert language.fit(docs.withColumn("text", F.lit(""))) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    lone = language.fit(docs.withColumn("lang", F.lit("aa")))
    assert {r.lang_pred for r in language.predict(docs, lone).collect()} <= {"aa", "und"}


def test_even_sample_is_bounded(spark):
    rows = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, 'b', 'a') AS k", "xxhash64(id) AS h")
    got = {r.k: r["count"] for r in even_sample(rows, "k", "h", 500, 5).groupBy("k").count().collect()}
    assert got == {"a": 500, "b": 500}


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    chain = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    found = toxicity.predict(docs, chain).select("doc_id", F.col("toxic").alias("found"))
    counts = {
        (r.toxic, r.found): r.n
        for r in found.join(labels.filter("doc_id % 2 = 1"), "doc_id").groupBy("toxic", "found").agg(F.count("*").alias("n")).collect()
    }
    assert counts[1, True] > 0.8 * (counts[1, True] + counts[1, False])
    assert counts.get((0, True), 0) < 0.005 * counts[0, False]


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(3)
    rows = [sorted(set(rng.integers(0, 50, 8).tolist())) for _ in range(400)]
    first = np.array([0 in r or 1 in r for r in rows]).astype(int)
    labels = np.column_stack([first, first * rng.integers(0, 2, 400)])
    data = toxicity._sparse(rows, np.ones(50))
    models = toxicity.fit_chain(data, labels, np.arange(400) % 4)
    assert [len(rest) for _, rest in models] == [1, 2]
    assert models[1][1][0] > 0  # the second model leans on the first's probability
    chain = toxicity.Chain(["a", "b"], [""] * 50, np.ones(50), models)
    found = chain.probabilities(data)
    assert ((found[:, 0] > 0.5) == first).mean() > 0.98


def test_odd_toxicity_rows(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    chain = toxicity.fit(docs, labels)
    rows = [(1, None, 0), (None, "stupid idiot scum trash loser", 0), (2, "", 0), (3, "12 -", 0), (4, "the and of", 0), (4, "the and of", 0), (5, "thon of " * 100_000, 1)]
    odd = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    got = toxicity.predict(odd, chain).collect()
    assert len(got) == 7
    assert [r.p_toxic for r in got if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert [r.toxic for r in got if r.doc_id in (None, 4, 5)] == [True, False, False, False]
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert not any(r.toxic for r in toxicity.predict(docs, None).collect())
    clean = toxicity.fit(docs, labels.withColumn("toxic", F.lit(0)))
    assert not any(r.toxic for r in toxicity.predict(docs, clean).collect())
    assert toxicity.fit(odd.select("doc_id", "text"), odd.select("doc_id", "toxic", F.lit(None).cast("int").alias("quality"))) is not None
    assert toxicity.predict(docs.limit(0), chain).count() == 0


def test_toxicity_query_has_all_rows(spark):
    found = op8_toxicity(spark, FOLDER)
    assert found.count() == read(spark, FOLDER, "documents").count()
    assert found.columns == ["doc_id", "p_toxic", "p_toxic_prose", "p_toxic_junk", "toxic", "toxic_prose", "toxic_junk"]


def test_language_prediction_is_that_of_plain_kernel_and_ridge(spark):
    """Row by row against the same sums in plain loops over sets of n-gram buckets."""
    docs = read(spark, FOLDER, "documents")
    model = language.fit(docs)
    seen = np.zeros(language.BUCKETS, dtype=bool)
    marks = [set(m.tolist()) for m in model.landmarks]
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    for row in docs.limit(150).collect():
        own = set(language.grams(row.text or "", seen).tolist())
        values = [len(own & m) / max((len(own) * len(m)) ** 0.5, 1) for m in marks]
        scores = [sum(v * w for v, w in zip([*values, 1.0], model.weights[:, c], strict=True)) for c in range(len(model.languages))]
        best = max(range(len(scores)), key=lambda c: scores[c])
        if language.has_letter(row.text):
            assert found[row.doc_id].lang_pred == model.languages[best]
            assert found[row.doc_id].score == pytest.approx(min(max((scores[best] + 1) / 2, 0), 1), abs=1e-6)
        else:
            assert (found[row.doc_id].lang_pred, found[row.doc_id].score) == (language.UNDETERMINED, 0)


def test_toxicity_prediction_is_that_of_a_plain_chain(spark):
    """Row by row: each model's sum over the text's words and the probabilities before it."""
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    chain = toxicity.fit(docs, labels)
    number = {w: i for i, w in enumerate(chain.vocabulary)}
    names = list(toxicity.CATEGORIES)
    found = {r.doc_id: r for r in toxicity.predict(docs, chain).collect()}
    for row in docs.limit(150).collect():
        own, earlier = [number[w] for w in toxicity.words(row.text) if w in number], []
        for weights, rest in chain.models:
            total = sum(weights[p] * chain.scale[p] for p in own)
            total += sum(p * w for p, w in zip([*earlier, 1.0], rest, strict=True))
            earlier.append(1 / (1 + math.exp(-min(max(total, -35), 35))))
        wanted = earlier if toxicity.words(row.text) else [0.0] * len(names)
        assert [found[row.doc_id][f"p_{n}"] for n in names] == pytest.approx(wanted, abs=1e-9)
