from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripflow.llm.common import read
from tripflow.llm.exact import drop_copies, find_copies, golomb, ungolomb


def plain(rows):
    """(id, keep id, size, digest) of every row, and the ids kept, by dictionaries."""
    groups = defaultdict(list)
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for key, text in rows:
        groups[lower(text)].append(key)
    least = -(2**63)
    kept = {text: max(ids, key=lambda i: least if i is None else i) for text, ids in groups.items()}
    found = [
        (key, kept[lower(text)], len(groups[lower(text)]), hashlib.sha256(lower(text).encode()).hexdigest())
        for key, text in rows
    ]
    return found, sorted(kept.items(), key=str)


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted, kept = plain(rows)
    got = find_copies(docs, **options).collect()
    digest = [bytes(r.digest).hex() for r in got]
    if not options:
        assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.keep_id, r.group_size, d)) for r, d in zip(got, digest, strict=True))
    assert sorted(str(w[:3]) for w in wanted) == sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got)
    assert sorted(str(k) for _, k in kept) == sorted(str(r.doc_id) for r in got if r.kept)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=60), st.integers(0, 1000))
def test_code_round_trip(values, base):
    values = np.sort(np.array(values, dtype=np.uint64)) + np.uint64(base)
    shift, code = golomb(values, base)
    assert ungolomb(code, len(values), shift, base).tolist() == values.tolist()


def test_code_is_short():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 50_000, dtype=np.uint64))
    assert len(golomb(values, 0)[1]) * 8 / 50_000 < np.log2((1 << 30) / 50_000) + 1.7


def test_matches_plain_version(spark):
    check(read(spark, "/root/testdata/sf0.01", "documents"))


ODD = [
    (1, None), (2, ""), (None, ""), (3, "One"), (3, "oNE"), (3, "one"), (None, "ONE"), (7, "Àb"), (8, "àb"),
    (None, "alone"), (None, "pair"), (None, "PAIR"), (9, "x" * 3_000_000), (4, "X" * 3_000_000), (5, "x" * 2_999_999),
    (6, "a\0b"), (10, "a"),
]


def odd(spark):
    return spark.createDataFrame([(i, t, n, "b") for n, (i, t) in enumerate(ODD)], "doc_id int, text string, number int, block string")


def test_odd_rows(spark):
    docs = odd(spark)
    check(docs)
    check(docs.unionAll(docs).repartition(5, "number"))
    assert find_copies(docs.limit(0)).collect() == []
    carried = find_copies(docs, carry=["number", "block"])
    assert carried.columns == ["doc_id", "keep_id", "group_size", "kept", "digest", "number", "block"]
    assert sorted(r.number for r in carried.collect()) == list(range(len(ODD)))


@pytest.mark.parametrize("length", [1, 0])
def test_texts_that_share_a_digest_are_told_apart(spark, length):
    docs = odd(spark).unionByName(odd(spark))
    check(docs, digest=lambda text: len(text[:length]).to_bytes(8, "big"))


def test_blocks_of_few_rows_and_a_hot_text(spark):
    rows = [(i, f"text {i % 700}" if i % 3 else "the same") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(23)
    check(docs)
    copies = find_copies(docs)
    plan = copies._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan  # the rows themselves are not shuffled to meet their bitmaps
    assert plan.count("hashpartitioning(block") <= 2 and "block#" in plan


def test_drop_copies_keeps_one_whole_row(spark):
    docs = odd(spark)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(k) for _, k in plain(ODD)[1])
    assert all(ODD[r.number] == (r.doc_id, r.text) for r in rows)
    assert drop_copies(docs.limit(0)).collect() == []
    clash = docs.withColumnsRenamed({"number": "_number", "block": "digest"})
    assert drop_copies(clash).columns == clash.columns and drop_copies(clash).count() == len(rows)
