from __future__ import annotations

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from test_simhash import plain_components, plain_fingerprint

from tripflow.llm.common import read
from tripflow.llm.simhash import keep_one


def test_one_row_of_each_component_whatever_the_ids(spark):
    other = " ".join(f"w{i}" for i in range(300))
    rows = (
        [(None, "lone text here", i) for i in range(5)]  # many rows without an id
        + [(9, "ÀB one", 1), (9, "Àb ONE", 2), (9, "ÀB one", 1)]  # copies under one id
        + [(3, other, 1), (3, "quite another thing", 1), (2, "quite another thing", 1)]  # an id kept for another text
        + [(None, "", 1), (4, None, 1), (None, " \t", 1)]
        + [(7, other + " x", 1)] * 4
    )
    docs = spark.createDataFrame(rows, "doc_id int, text string, _number int")
    named = plain_components([(n, plain_fingerprint(t)) for n, (_, t, _) in enumerate(rows)])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(set(named.values()))
    assert {named[plain_fingerprint(t)] for _, t, _ in got} == set(named.values())
    by_component = {named[plain_fingerprint(t)]: i for i, t, _ in got}
    for n, (_, t, _) in enumerate(rows):
        ids = [i for i, u, _ in rows if named[plain_fingerprint(u)] == named[plain_fingerprint(t)] and i is not None]
        assert by_component[named[plain_fingerprint(t)]] == min(ids, default=None)
    assert keep_one(docs.limit(0)).count() == 0
    stage = dict(pipeline.STAGES)["simhash_near_dedup"]
    assert stage(spark, docs, "").count() == len(got)


def test_the_same_row_whatever_the_order(spark):
    rows = [(None if i % 2 else 5, "one text for all " + "!" * (i % 3), str(i)) for i in range(30)]
    one = spark.createDataFrame(rows, "doc_id int, text string, source string")
    two = spark.createDataFrame(rows[::-1], one.schema).repartition(3)
    first = sorted(map(tuple, keep_one(one).collect()), key=str)
    assert first == sorted(map(tuple, keep_one(two).collect()), key=str)
    named = plain_components([(n, plain_fingerprint(t)) for n, (_, t, _) in enumerate(rows)])
    assert len(first) == len(set(named.values()))


def test_a_third_of_all_rows_under_one_id(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    hot = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    named = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    kept = [plain_fingerprint(r.text) for r in keep_one(hot).collect()]
    assert sorted(named[p] for p in kept) == sorted(set(named.values()))
