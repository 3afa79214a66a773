from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tripflow.llm.common import read
from tripflow.llm.components import components
from tripflow.llm.simhash import GrayIndex, fingerprint, gray_rank, links, near_duplicates


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """Smallest id reachable, by trying all pairs."""
    least = {}
    for key, bits in prints:
        if key is not None:
            least[bits] = min(key, least.get(bits, key))
        else:
            least.setdefault(bits, None)
    todo, named = set(least), {}
    while todo:
        part, edge = set(), [todo.pop()]
        while edge:
            one = edge.pop()
            part.add(one)
            near = {x for x in todo if (x ^ one).bit_count() <= 2}
            todo -= near
            edge += near
        ids = [least[x] for x in part if least[x] is not None]
        named |= {x: min(ids, default=None) for x in part}
    return named


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    named = plain_components(prints)
    wanted = sorted((str(k), f"{p:016x}", str(named[p])) for k, p in prints)
    got = sorted((str(r[0]), r[1], str(r[2])) for r in near_duplicates(docs).collect())
    assert got == wanted
    return named


def test_matches_all_pairs(spark):
    check(read(spark, "/root/testdata/sf0.01", "documents"))


def test_near_copies_of_a_text_meet(spark):
    rng = random.Random(8)
    rows = []
    for base in range(4):
        words = [f"w{rng.randrange(5000)}" for _ in range(1500)]
        for copy in range(12):
            changed = list(words)
            for _ in range(copy % 4):
                changed[rng.randrange(1500)] = "changed"
            rows.append((base * 100 + copy, " ".join(changed)))
    named = check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert 4 <= len(set(named.values())) < len(named)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(100_000))
    rows = [(5, None, "p"), (3, "", "p"), (None, " \t", "p"), (9, "ÀB one", "q"), (9, "Àb ONE", "q"), (1, long, None), (None, "lone text here", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, print string")
    check(docs)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_native_hash_agrees(spark):
    text = "one two three"
    row = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()
    assert row.h % 2**64 == fingerprint(text)


def test_index_finds_all_links():
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    bits = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(60)}
    bits = np.array(sorted(bits), dtype=np.uint64)
    groups = [bits[:1], bits[1:400], bits[400:]]
    groups = [g[np.argsort(gray_rank(g))] for g in groups]
    starts = np.array([0, 1, 400])
    index = GrayIndex(np.concatenate(groups), starts)
    number = np.repeat(np.arange(3), [len(g) for g in groups])
    every = np.concatenate(groups)
    query, node = index.links(every, number, 2)
    found = set(zip(query.tolist(), node.tolist(), strict=True))
    wanted = {
        (i, j)
        for i in range(len(every))
        for j in range(len(every))
        if number[i] == number[j] and int(every[i] ^ every[j]).bit_count() <= 2
    }
    assert found == wanted and len(found) > len(every)


@pytest.mark.parametrize("group_words", [1 << 14, 64, 2])
def test_links_of_close_prints_span_their_groups(spark, group_words):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    bits = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(150)}
    named = plain_components([(i, b) for i, b in enumerate(sorted(bits))])
    signed = [b - (1 << 64) if b >> 63 else b for b in sorted(bits)]
    frame = spark.createDataFrame([(b,) for b in signed], "print bigint")
    got = {r.node % 2**64: r.root for r in components(links(frame, group_words=group_words)).collect()}
    parts = {}
    for b in sorted(bits):
        parts.setdefault(named[b], set()).add(b)
    for part in parts.values():
        if len(part) == 1:
            assert not part & set(got)
        else:
            assert len({got[b] for b in part}) == 1
    assert len({got[b] for b in got}) == sum(len(p) > 1 for p in parts.values())


def test_upper_nodes_are_given_up_unopened():
    """Of a million random words, a search opens few nodes of the tree."""
    bits = np.unique(np.random.default_rng(5).integers(0, 1 << 64, 1_000_000, dtype=np.uint64))
    bits = bits[np.argsort(gray_rank(bits))]
    index = GrayIndex(bits, np.array([0]))
    queries = bits[:: 1000].copy() ^ np.uint64(1 << 40)
    query, node = index.links(queries, np.zeros(len(queries), dtype=int), 2)
    assert set(range(len(queries))) == set(query.tolist())
    levels = len(index.pattern)
    assert levels == 6 and sum(index.given_up[1:]) > 100 * len(queries)
    assert index.given_up[0] < 0.01 * len(bits) * len(queries)  # leaves looked at


def test_dense_words_are_dealt_until_bounded(spark):
    """Words that differ in their last bits only: no choice of leading bits parts them."""
    low = list(range(3000))
    frame = spark.createDataFrame([(b,) for b in low], "print bigint")
    got = {r.node: r.root for r in components(links(frame, group_words=16)).collect()}
    assert set(got) == set(low) and len(set(got.values())) == 1


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
