from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripflow.llm import merkle
from tripflow.llm.common import read


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    fields = [row[0], row[1], row[2], row[3], row[4]]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def plain_tree(leaves):
    """Root, and per leaf its siblings as (left, right) lists, level by level."""
    proofs = [[] for _ in leaves]
    members = [[i] for i in range(len(leaves))]
    line = list(leaves)
    while len(line) > 1:
        runs = [range(i, min(i + 3, len(line))) for i in range(0, len(line), 3)]
        for run in runs:
            for at in run:
                for leaf in members[at]:
                    proofs[leaf].append(([line[j] for j in run if j < at], [line[j] for j in run if j > at]))
        members = [[leaf for at in run for leaf in members[at]] for run in runs]
        line = [digest(*[line[at] for at in run]) for run in runs]
    return line[0], proofs


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the contract's rows."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(sources[name], key=lambda m: m[:3])
        trees.append((members, *plain_tree([m[2] for m in members])))
    root, over = plain_tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (members, subroot, proofs), upper in zip(trees, over, strict=True):
        for (_, _, leaf, row), own in zip(members, proofs, strict=True):
            proof = [*own, *upper]
            at = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                at = plain_leaf((*row[:4], row[4].replace("\n", "")))
            for left, right in proof:
                at = digest(*left, at, *right)
            siblings = digest(*[x for left, right in proof for x in left + right])
            out.append((row[0], leaf, subroot, root, siblings, at, at == root))
    return sorted(out, key=str)


def check(docs):
    rows = [tuple(r[c] for c in merkle.LEAF_COLUMNS) for r in docs.collect()]
    got = merkle.manifest(docs)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == plain(rows)
    return found


def test_matches_plain_version(spark):
    found = check(read(spark, "/root/testdata/sf0.01", "documents"))
    assert 0 < sum(not r[6] for r in found) < len(found)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, hash string"


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (None, None, "en", 3, "a\nb"), (None, "s", "en", 0, ""), (2, "", "en", 0, "\n"),
        (3, "é", "en", 4, "\n\nxy"), (4, "z", "fr", 1, "q\n" * 500_000), (5, "s", "en", 1, "a"), (5, "s", "en", 1, "b"),
        (5, "s", "en", 1, "b"), (6, "s", "en", 1, "c\nd"), (-7, "s", "en", 1, "c\nd"), (8, "=", "en", 1, "e"),
        (9, "/", "en", 1, "f"), (2**62, "s", "en", 1, "a\n"),
    ]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    check(docs)
    check(docs.repartition(7))
    for one in (docs.filter("doc_id = 1"), docs.filter("source = 's'"), docs.filter("doc_id = 6"), docs.limit(0)):
        check(one)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_every_size(spark, count):
    docs = spark.range(count).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("bigint").alias("n_chars"), F.concat(F.col("id").cast("string"), F.lit("\n")).alias("text"),
    )
    check(docs)


def test_several_passes_and_many_sources(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 400).cast("string")).alias("source"),
        F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.concat_ws("\n", "id", F.lit("x")).alias("text"),
    ).repartition(13)
    check(docs)


def test_proofs_lead_any_hash_function_of_the_row_to_the_root(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    proved = merkle.prove(docs, "doc_id", "source", ["doc_id", "text"], carry=["lang"])
    folded = proved.select("lang", (merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("same"))
    assert folded.filter("same").count() == docs.count() and folded.filter("lang IS NOT NULL").count()
