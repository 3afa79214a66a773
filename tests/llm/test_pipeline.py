from __future__ import annotations

import corpus_pipeline as pipeline
from test_lines import plain
from test_simhash import plain_components, plain_fingerprint

from tripflow.llm.common import read
from tripflow.llm.secrets import Scanner

FOLDER = "/root/testdata/sf0.01"


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "secret_scan", "best_fit_packing",
    ]


def test_each_stage_against_its_plain_version(spark, tmp_path):
    documents = read(spark, FOLDER, "documents")
    columns, seen = documents.columns, [documents]
    for name, stage in pipeline.STAGES:
        result = stage(spark, seen[-1], FOLDER)
        result.write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    raw, known, cut, single, clean, packed = [f.collect() for f in seen]
    assert all(f.columns == columns for f in seen[1:5])
    texts = [{r.doc_id: r.text for r in rows} for rows in (raw, known, cut, single, clean)]

    assert set(texts[0]) - set(texts[1]) <= {i for i, t in texts[0].items() if len(t or "") < 3 or not any(map(str.isalpha, t))}
    assert texts[2] == dict(plain(sorted(texts[1].items())))
    prints = {i: plain_fingerprint(t) for i, t in texts[2].items()}
    named = plain_components(list(prints.items()))
    assert texts[3] == {i: t for i, t in texts[2].items() if named[prints[i]] == i}
    assert set(texts[4]) == set(texts[3])
    for i, text in texts[3].items():
        if texts[4][i] != text:
            assert Scanner().scan(text)[1] and "[SECRET]" in texts[4][i]
    assert any(texts[4][i] != t for i, t in texts[3].items())
    assert all(r.n_chars == len(r.text) for r in clean)
    assert {r.doc_id for r in packed} == set(texts[4])
    whole = pipeline.run(spark, FOLDER).select(*seen[-1].columns).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


LONG = "a b c " * 50_000
ODD = [(1, None), (None, "the one"), (2, ""), (3, LONG), (3, "token=abcdef"), (3, "token=abcdef")]
BY_STAGE = {
    "language_id": [(None, "the one"), (3, LONG), (3, "token=abcdef"), (3, "token=abcdef")],
    "line_dedup": ODD,
    "simhash_near_dedup": [(1, None), (None, "the one"), (3, LONG), (3, "token=abcdef")],
    "secret_scan": [(1, None), (None, "the one"), (2, ""), (3, LONG), (3, "[SECRET]"), (3, "[SECRET]")],
}


def test_odd_documents(spark):
    """Each stage by itself over odd rows with clashing column names, and over none."""
    rows = [(i, t, None, "s", len(t or ""), 1, 2, "x", 3) for i, t in ODD]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, number int, block int, print string, n_chunks int"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES[:-1]:
        result = stage(spark, docs, FOLDER)
        assert result.columns == docs.columns, name
        found = result.collect()
        assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(BY_STAGE[name], key=str), name
        assert all((r.number, r.block, r.print, r.n_chunks) == (1, 2, "x", 3) for r in found)
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
    pieces = pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert [r.length for r in pieces if r.doc_id in (1, 2)] == [1, 1]  # the end id alone
    assert sum(r.piece == 0 for r in pieces) == len(ODD) and max(r.length for r in pieces) == 1024
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).collect() == []


def test_unlabelled_gibberish_goes(spark):
    prose = [(n, "the quick brown fox jumps over the lazy dog and runs away " * 3, "en") for n in range(60)]
    docs = spark.createDataFrame([*prose, (1000, "xqzjv kwpqx zzvjq qxwkz vjxqz " * 4, None)], "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in pipeline.STAGES[0][1](spark, docs, FOLDER).collect()}
    assert kept == set(range(60))
