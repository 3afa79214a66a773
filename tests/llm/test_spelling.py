from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from os.path import commonprefix

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripflow.llm import spelling
from tripflow.llm.common import read


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    at = len(commonprefix([a, b]))  # what the edit leaves in place before it
    return b[at + 1 :] == (a[at + 1 :] if len(a) == len(b) else a[at:])


def plain_counts(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain(n):
    """(word, form, root, n, near words, form's n) by the words with one code point deleted."""
    cuts = lambda w: [w, *[w[:i] + w[i + 1 :] for i in range(len(w))]] if len(w) < 100 else ["long"]
    holes = defaultdict(set)
    for w in n:
        for h in cuts(w):
            holes[h].add(w)
    near = {w: {v for h in cuts(w) for v in holes[h] if one_edit(w, v)} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def check(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert sorted(map(tuple, spelling.variants(words).collect())) == plain(n)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_matches_plain_version(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = spelling.find_variants(docs)
    assert got.columns == COLUMNS
    wanted = plain(plain_counts([(r.doc_id, r.text) for r in docs.collect()]))
    found = sorted(map(tuple, got.collect()))
    assert found == wanted
    assert sum(r[1] is not None for r in found) > 20


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé\U0001f600", min_size=6, max_size=8), min_size=1, max_size=40), st.data())
def test_pairs_are_those_of_one_edit(words, data):
    for kind in (6, 7):
        some = [w for w in dict.fromkeys(words) if len(w) in (kind, kind + 1)]
        group = np.sort(np.array(data.draw(st.lists(st.integers(0, 2), min_size=len(some), max_size=len(some))), dtype=int))
        found = set()
        for i, j, prefix in spelling.near_pairs(some, group, kind) if some else []:
            for a, b, p in zip(i.tolist(), j.tolist(), prefix.tolist(), strict=True):
                assert (a, b) not in found and some[a][:p] == some[b][:p] and some[a][: p + 1] != some[b][: p + 1]
                found.add((a, b))
        assert found == {
            (a, b)
            for b in range(len(some))
            for a in range(b)
            if group[a] == group[b] and one_edit(some[a], some[b]) and min(len(some[a]), len(some[b])) == kind
        }


@pytest.mark.parametrize("limit", [2, 40, 4096])
def test_large_groups_are_dealt_again(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "GROUP_WORDS", limit)
    rng = random.Random(2)
    n = {}
    for base in ("aaaaaaaaaa", "abcdefghijkl", "abcdefz"):
        n[base] = 100_000
        for _ in range(150):
            w = list(base)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
            if len(w) >= 7:
                n.setdefault("".join(w), rng.choice([2, 3, 20, 300, 3000]))
    check(spark, n)


def test_long_words_and_chains(spark):
    long = "ab" * 100_000
    n = {long: 1000, long[:-1] + "c": 100, long[1:]: 9, "x" + long: 3, "q" * 60_000: 2, "q" * 60_001: 25}
    n |= {"chainab": 10**7, "chainabc": 10**6, "chainabcd": 10**5, "chainabcde": 10**4, "chainabcdef": 10**3, "chainabcdefg": 99}
    n |= {"tiestie": 20, "tiestia": 200, "tiestib": 200, "lonelyword": 5, "ßßßßßßß": 2, "ßßßßßß×": 21}
    check(spark, n)
    assert dict((r.word, r.root) for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n bigint")).collect())["chainabcdefg"] == "chainab"


def test_odd_rows(spark):
    text = "Ärgerlich ärgerlich ARGERLICH argerlich, sévérité sévérite sévérité! " + "z" * 300_000
    rows = [(1, text), (1, text), (None, text), (None, None), (2, ""), (3, "short words only"), (4, text * 3)]
    docs = spark.createDataFrame([(*r, "w", 1, "f") for r in rows], "doc_id int, text string, word string, n int, form string")
    wanted = plain(plain_counts(rows))
    assert sorted(map(tuple, spelling.find_variants(docs).collect())) == wanted and len(wanted) > 4
    assert spelling.find_variants(docs.limit(0)).collect() == []
    assert spelling.find_variants(docs.filter("doc_id = 3")).columns == COLUMNS
