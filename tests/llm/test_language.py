from __future__ import annotations

import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import language
from tripflow.llm.common import read

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def vocabularies(count, words=60):
    """Made-up languages: words of two to four syllables, each language with syllables of its own."""
    rng = random.Random(count)
    every = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiouy"]
    rng.shuffle(every)
    own = [every[i::count][:12] for i in range(count)]
    return [["".join(rng.choices(s, k=rng.randint(2, 4))) for _ in range(words)] for s in own]


@pytest.mark.parametrize("count", [2, 4, 10])
def test_gibberish_goes_and_short_texts_stay_with_any_number_of_languages(spark, count):
    rng = random.Random(1)
    words = vocabularies(count)
    rows = [(n, " ".join(rng.choices(words[n % count], k=rng.randint(20, 80))), f"l{n % count:02}") for n in range(40 * count)]
    model = language.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    clean = [" ".join(rng.choices(words[n % count], k=1 + n // count % 3)) for n in range(60)] + ["a"]
    junk = ["".join(rng.choices(LETTERS + "   ", k=k)) for k in (40, 200, 5_000) for _ in range(20)]
    junk += ["Привет, как твои дела сегодня", "ასე ლაპარაკობენ აქ ყოველდღე"]
    texts = [(i, t) for i, t in enumerate(clean + junk)]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    kept = {r.doc_id for r in language.keep_identified(docs, model, min_familiar=pipeline.MIN_FAMILIAR).collect()}
    assert kept == set(range(len(clean)))


@pytest.mark.parametrize("size", [100, 500, 2000])
def test_gibberish_goes_however_rich_the_training_texts(spark, size):
    """Texts over a vocabulary of 20,000 words, and copies of them with other letters as further languages."""
    rng = random.Random(size)
    syllables = [a + b + c for a in "bcdfghlmnprst" for b in "aeiou" for c in ("", "", "n", "r", "s", "t")]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(20_000)]
    weights = [1 / (n + 10) for n in range(20_000)]
    turned = lambda text, by: text.translate(str.maketrans(LETTERS, LETTERS[by:] + LETTERS[:by]))
    text = lambda: " ".join(rng.choices(words, weights, k=size))
    rows = [(4 * n + by, turned(t, 5 * by), f"l{by}") for n, t in enumerate(text() for _ in range(200)) for by in range(4)]
    model = language.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    junk = ["".join(rng.choices(LETTERS + "    ", k=k)) for k in (200, 1000) for _ in range(100)]
    clean = [turned(" ".join(rng.choices(words, weights, k=rng.randint(5, 200))), 5 * (n % 4)) for n in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(junk + clean)], "doc_id int, text string")
    kept = {r.doc_id for r in language.keep_identified(docs, model, min_familiar=pipeline.MIN_FAMILIAR).collect()}
    assert len(kept & set(range(200))) <= 0.05 * 200
    assert kept >= set(range(200, 400))


def test_clean_held_out_rows_stay(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    held = docs.filter(language.held_out(F.col("doc_id")) & F.col("text").rlike("\\p{L}"))
    assert language.keep_identified(held, language.fit(docs), min_familiar=pipeline.MIN_FAMILIAR).count() == held.count()


def test_a_language_of_few_texts_keeps_them(spark):
    words = vocabularies(3)
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choices(words[n], k=30))
    rows = [(n, text(0), "aa") for n in range(60)] + [(100 + n, text(1), "bb") for n in range(4)] + [(200, text(2), "cc")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").filter(~language.held_out(F.col("doc_id")))
    model = language.fit(docs)
    kept = language.keep_identified(docs, model, min_familiar=pipeline.MIN_FAMILIAR)
    assert kept.count() == docs.count()


def test_every_one_of_many_languages_is_learned(spark):
    rng = random.Random(4)
    syllables = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiouy"]
    words = []
    for _ in range(150):
        own = rng.sample(syllables, 10)
        words.append(["".join(rng.choices(own, k=rng.randint(2, 4))) for _ in range(40)])
    rows = [(n, " ".join(rng.choices(words[n % 150], k=40)), f"l{n % 150:03}") for n in range(150 * 12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language.fit(docs)
    assert model.languages == [f"l{n:03}" for n in range(150)]
    assert len(model.landmarks) >= 2 * 150
    found = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert sum(found[n] == lang for n, _, lang in rows) > 0.98 * len(rows)
    assert set(found.values()) == set(model.languages)


def test_thousands_of_labels_are_fitted_in_bounded_memory(spark):
    rng = random.Random(5)
    syllables = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiouy"]
    rows = []
    for n in range(3000):
        own = rng.sample(syllables, 8)
        rows += [(16 * n + i, " ".join("".join(rng.choices(own, k=3)) for _ in range(12)), f"l{n:04}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language.fit(docs)
    assert len(model.languages) > 2900 and len(model.landmarks) == language.MOST_LANDMARKS
    assert model.weights.shape == (language.MOST_LANDMARKS + 1, len(model.languages))
    some = docs.filter("doc_id % 320 < 6")
    found = {r.doc_id: r.lang_pred for r in language.predict(some, model).collect()}
    right = sum(found[r.doc_id] == r.lang for r in some.collect())
    assert right > 0.8 * len(found)


def test_kernel_of_many_landmarks_is_that_of_few():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 5_000, 300)).astype(np.int32) for _ in range(40)] + [np.array([], dtype=np.int32)]
    few = language.Kernel(sets).of_grams(sets)
    dense, language._DENSE = language._DENSE, 1
    try:
        many = language.Kernel(sets).of_grams(sets)
    finally:
        language._DENSE = dense
    assert np.array_equal(few, many)
