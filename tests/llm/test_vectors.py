from __future__ import annotations

import heapq
import math

import numpy as np
import pytest

from tripflow.llm import ball_tree, multi_index
from tripflow.llm.ball_tree import BallTree, Cells, products, top_products
from tripflow.llm.common import read
from tripflow.llm.multi_index import MultiIndex, nearest

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def usable(rows, zero):
    out = {}
    for key, vec in rows:
        good = key is not None and vec and all(x is not None and math.isfinite(x) for x in vec)
        if good and (zero or any(vec)):
            out[key] = [float(x) for x in vec]
    return out


def plain(rows, kind, k=10):
    vecs = usable(rows, kind == "product")
    out = {}
    for q in vecs:
        if q % 100:
            continue
        scored = []
        for i, v in vecs.items():
            if i == q:
                continue
            if kind == "product":
                score = sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(vecs[q], v, strict=True))
                scored.append((-score, i))
            else:
                scored.append((math.dist(vecs[q], v), i))
        out[q] = heapq.nsmallest(k, scored)
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


@pytest.fixture(scope="module")
def table(spark):
    return read(spark, "/root/testdata/sf0.1", "embeddings")


@pytest.fixture(scope="module")
def rows(table):
    return [(r.vec_id, r.embedding) for r in table.collect()]


def test_products_are_exact(table, rows):
    got = collected(top_products(table))
    assert got == {q: [(i, -s) for s, i in best] for q, best in plain(rows, "product").items()}


def test_visiting_all_is_exact(table, rows):
    got = collected(nearest(table, share=1.0))
    for q, best in plain(rows, "distance").items():
        assert [i for i, _ in got[q]] == [i for _, i in best]
        np.testing.assert_allclose([s for _, s in got[q]], [s for s, _ in best], rtol=1e-12)


def test_recall(table, rows):
    got = collected(nearest(table))
    wanted = plain(rows, "distance")
    hits = sum(len({i for i, _ in got[q]} & {i for _, i in best}) for q, best in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    assert all(len(got[q]) == 10 for q in wanted)


@pytest.mark.parametrize("size", [2000, 10_000])
def test_few_distances_are_computed(size):
    """Recall and distances a query, over even vectors on a sphere, the hardest case there is."""
    rng = np.random.default_rng(size)
    points = rng.normal(size=(size, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    index = MultiIndex(points, multi_index.centroids_for(size))
    cells = index.cell(points)
    counts = np.bincount(cells, minlength=index.cells)
    shards = [multi_index.Shard(part, points[part], cells[part]) for part in np.array_split(np.argsort(cells, kind="stable"), 7)]
    hits, queries = 0, range(0, size, size // 40)
    wanted = multi_index.visited_for(size, multi_index.VISITED_SHARE)
    for q in queries:
        asked = np.array(index.visit(points[q], counts, wanted))
        found = [shard.nearest(points[q], asked, q, 10) for shard in shards]
        ids, apart = (np.concatenate(x) for x in zip(*found, strict=True))
        apart_of_all = np.linalg.norm(points - points[q], axis=1)
        apart_of_all[q] = np.inf
        np.testing.assert_allclose(apart, apart_of_all[ids])
        hits += len(set(ids[np.argsort(apart)[:10]].tolist()) & set(np.argsort(apart_of_all)[:10].tolist()))
    measured = sum(shard.measured for shard in shards) / len(queries) / size
    assert hits >= 9 * len(queries)
    assert measured < (0.31 if size == 2000 else 0.26)


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(400, 6))
    index = MultiIndex(points, 8)
    counts = np.bincount(index.cell(points), minlength=index.cells)
    for point in points[:20]:
        seen = index.visit(point, counts, len(points))
        assert sorted(seen) == np.flatnonzero(counts).tolist()
        a = ((index.left - point[:3]) ** 2).sum(axis=1)
        b = ((index.right - point[3:]) ** 2).sum(axis=1)
        sums = [a[c // len(b)] + b[c % len(b)] for c in seen]
        assert sums == sorted(sums)


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(size=(2000, 5)) * 1000 + rng.integers(0, 4, size=(2000, 1)) * 9000)
    tree = BallTree(np.arange(2000), points)
    for query in points[:30]:
        ids, scores = tree.best(query, 5, 10, -np.inf)
        every = products(points, query)
        order = [i for i in np.lexsort((np.arange(2000), -every)) if i != 5][:10]
        best = sorted(zip((-scores).tolist(), ids.tolist(), strict=True))
        assert best == [(-int(every[i]), int(i)) for i in order]


def test_products_beyond_doubles():
    big = np.array([[2.0**40, 1.0, 0.0], [2.0**62, 2.0**10, 0.0]])
    assert products(big, np.array([2.0**20, 3.0, 1.0])).tolist() == [2**60 + 3, 2**63 - 1]


def odd(spark):
    same = [0.25, -0.5, 0.125]
    rows = [(0, same), (None, same), (100, [0.0, 0.0, 0.0]), (200, None), (300, [float("nan"), 1.0, 1.0])]
    rows += [(400, [1.0, None, 1.0]), (500, [float("inf"), 1.0, 1.0]), (600, [1.0, 2.0]), (700, [])]
    rows += [(i, same) for i in range(1, 60)] + [(1, same), (1, same), (0, same)]
    rows += [(800, [1.5, 1.0, 1.0]), (801, [-1.5, -1.0, 3.0])]
    return rows, spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def test_odd_rows(spark):
    rows, table = odd(spark)
    rows = [r for r in rows if r[0] != 600]  # its length is not the common one
    got = collected(top_products(table))
    assert got == {q: [(i, -s) for s, i in best] for q, best in plain(rows, "product").items()}
    got = collected(nearest(table, share=1.0))
    wanted = plain(rows, "distance")
    assert {q: [i for i, _ in found] for q, found in got.items()} == {q: [i for _, i in best] for q, best in wanted.items()}


@pytest.mark.parametrize("search", [nearest, top_products])
def test_few_rows(spark, search):
    empty = spark.createDataFrame([], SCHEMA)
    assert search(empty).count() == 0
    one = spark.createDataFrame([(100, [1.0, 2.0], 0)], SCHEMA)
    assert search(one).count() == 0
    three = spark.createDataFrame([(100, [1.0], 0), (1, [2.0], 0), (2, [-1.0], 0)], SCHEMA)
    assert [(i) for i, _ in collected(search(three))[100]] == [1, 2]


def test_large_clusters_are_cut_and_shards_pruned(spark, monkeypatch):
    """A third of all rows lie in one cluster, which becomes many shards, few of which a query enters."""
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(4000, 4)) * [6.0, 4.0, 2.0, 0.5]
    points = np.concatenate([spread, rng.normal(size=(2000, 4)) * [3.0, 3.0, 0.1, 0.1] + 5.0]).astype(np.float32)
    rows = [(i, [float(x) for x in p], 0) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, SCHEMA)
    probed, shards = [], []
    search = ball_tree.search_shards

    def counted(entries, probes, *rest):
        probed.append(probes.count())
        shards.append(entries.select("shard").distinct().count())
        return search(entries, probes, *rest)

    monkeypatch.setattr(ball_tree, "search_shards", counted)
    got = collected(top_products(table, clusters=2))
    assert got == {q: [(i, -s) for s, i in best] for q, best in plain([r[:2] for r in rows], "product").items()}
    assert shards[0] >= 20 and probed[0] == 60 * ball_tree.SEEDS
    assert sum(probed) < 0.5 * 60 * shards[0]


def test_cells_hold_all_rows_in_balance():
    rng = np.random.default_rng(6)
    points = np.floor(rng.normal(size=(3000, 3)) * 50)
    points[:1000] = points[0]  # alike, so they cannot be cut
    points[1000:1800, 0] = points[1000:1800, 0].max()  # ties at a median
    cells = Cells(points, ball_tree.centres(points[:500], 4), 60)
    found = cells.find(points)
    assert found.min() >= 0 and found.max() < len(cells.centre)
    sizes = np.bincount(found, minlength=len(cells.centre))
    whole = found[0]
    assert sizes.sum() == 3000 and (sizes[np.arange(len(sizes)) != whole] <= 60).all()
