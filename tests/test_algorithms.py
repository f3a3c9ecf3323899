"""Iterative graph algorithms and blocked co-occurrence against brute force."""

import heapq
import itertools
import random
from collections import Counter, deque

import pytest
from pyspark.sql import Row

from triad.operators import algorithms as A
from triad.operators import derive as DV


def test_co_occurrence_matches_pairs_with_hot_group(spark):
    rows = [(0, i) for i in range(40)]  # one group holding most rows
    rows += [(g, i) for g in range(1, 30) for i in range(g % 7, g % 7 + 4)]
    df = spark.createDataFrame([Row(g=g, i=i) for g, i in rows])
    want = {}
    by_g = {}
    for g, i in rows:
        by_g.setdefault(g, set()).add(i)
    for items in by_g.values():
        for a, b in itertools.combinations(sorted(items), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    for light in (0, 3, 39, 100, None):  # all groups in blocks, some, the hot one only, none
        got = DV.co_occurrence(df, "g", "i", 1, block_items=8, group_chunk=4, light=light)
        assert {(r.i1, r.i2): r.weight for r in got.collect()} == want, light


def test_strongest_pairs_survive_the_threshold(spark):
    rng = random.Random(3)
    rows = {(g, int(rng.paretovariate(0.7)) % 300) for g in range(200) for _ in range(12)}
    df = spark.createDataFrame([Row(g=g, i=i) for g, i in rows])
    weight = Counter()
    for g in range(200):
        for a, b in itertools.combinations(sorted(i for h, i in rows if h == g), 2):
            weight[a, b] += 1
    for k in (1, 10, 60, 10_000):
        want = sorted(weight.items(), key=lambda x: (-x[1], x[0]))[:k]
        pairs = DV.co_occurrence(df, "g", "i", 1, distinct_rows=True, top=k)
        got = DV.strongest_edges(pairs, "i1", "i2", k).collect()
        assert [((r.i1, r.i2), r.weight) for r in got] == want
    bound = DV.weight_bound(df, 10)
    assert 1 < bound <= sorted(weight.values())[-10]


def brute_pagerank(edges, nodes, d=0.85, iters=20):
    out = {n: 0.0 for n in nodes}
    adj = {n: [] for n in nodes}
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            adj[x].append((y, w))
            out[x] += w
    r = {n: 1 - d for n in nodes}
    for _ in range(iters):
        s = {n: 0.0 for n in nodes}
        for x in nodes:
            for y, w in adj[x]:
                s[y] += r[x] * w / out[x]
        r = {n: (1 - d) + d * s[n] for n in nodes}
    return r


def test_pagerank_matches_power_iteration(spark):
    edges = [(1, 2, 3.0), (2, 3, 1.0), (3, 1, 2.0), (3, 4, 1.0), (5, 6, 1.0)]
    nodes = [1, 2, 3, 4, 5, 6, 7]
    e = spark.createDataFrame([Row(src=a, dst=b, weight=w) for a, b, w in edges])
    v = spark.createDataFrame([Row(id=n) for n in nodes])
    got = {r.id: r.score for r in A.pagerank(e, v, tol=0.0).collect()}
    want = brute_pagerank(edges, nodes)
    for n in nodes:
        assert got[n] == pytest.approx(want[n], abs=1e-9)
    assert got[7] == pytest.approx(0.15)  # isolated vertex


def test_louvain_two_cliques(spark):
    edges = [Row(src=b + i, dst=b + j, weight=1.0) for b in (0, 10) for i in range(5) for j in range(i + 1, 5)]
    edges.append(Row(src=4, dst=10, weight=1.0))
    e = spark.createDataFrame(edges)
    v = spark.createDataFrame([Row(id=i) for i in list(range(5)) + list(range(10, 15)) + [99]])
    lab = A.louvain(e, v)
    got = {r.id: r.community for r in lab.collect()}
    assert {got[i] for i in range(5)} == {0} and {got[i] for i in range(10, 15)} == {10} and got[99] == 99
    singletons = v.selectExpr("id", "id AS community")
    assert A.modularity(e, lab) > A.modularity(e, singletons)
    sizes = [(r.community, r.clusterSize) for r in A.community_sizes(lab).collect()]
    assert sizes[:2] == [(0, 5), (10, 5)]


def bfs(adj, s, t, max_hops=6):
    prev = {s: [s]}
    q = deque([s])
    while q:
        x = q.popleft()
        if len(prev[x]) - 1 >= max_hops:
            continue
        for y in sorted(adj.get(x, ())):
            if y not in prev:
                prev[y] = prev[x] + [y]
                q.append(y)
    return prev.get(t)


def test_hop_paths_match_bfs(spark):
    pairs_e = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "x"), ("x", "d"), ("d", "e"), ("f", "g")]
    e = spark.createDataFrame([Row(src=a, dst=b) for a, b in pairs_e])
    adj = {}
    for a, b in pairs_e:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    pairs = spark.createDataFrame([Row(source="a", target=t) for t in ("d", "e", "g", "a")])
    got = {r.target: (r.path, r.length) for r in A.hop_paths(e, pairs).collect()}
    assert got["d"] == (["a", "x", "d"], 2)  # two equal paths: the smaller one
    assert got["e"][1] == len(bfs(adj, "a", "e")) - 1
    assert "g" not in got and got["a"] == (["a"], 0)
    assert A.hop_path(e, "a", "e", max_hops=2).count() == 0


def dijkstra(edges, s, t):
    adj = {}
    for a, b, c in edges:
        adj.setdefault(a, []).append((b, c))
        adj.setdefault(b, []).append((a, c))
    best = {s: 0.0}
    h = [(0.0, s)]
    while h:
        d, x = heapq.heappop(h)
        if d > best.get(x, 1e18):
            continue
        for y, c in adj.get(x, ()):
            if d + c < best.get(y, 1e18):
                best[y] = d + c
                heapq.heappush(h, (d + c, y))
    return best.get(t)


def test_weighted_path_matches_dijkstra(spark):
    edges = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 2.5), (3, 4, 0.5), (1, 4, 4.0), (4, 5, 1.0)]
    e = spark.createDataFrame([Row(u1=a, u2=b, distance=c) for a, b, c in edges])
    r = A.weighted_path(e, 1, 5).collect()[0]
    assert r.totalCost == pytest.approx(dijkstra(edges, 1, 5))
    assert r.nodeIds == [1, 2, 3, 4, 5] and r.hops == 4
    assert r.costs == pytest.approx([0.0, 1.0, 2.0, 2.5, 3.5])
    assert all(a <= b for a, b in zip(r.costs, r.costs[1:]))
    one = A.weighted_path(spark.createDataFrame([Row(u1=4169, u2=4277, distance=1 / 734)]), 4169, 4277).collect()[0]
    assert one.totalCost == 0.0013623978201634877 and one.hops == 1


def test_similar_edges_key_order(spark):
    from triad.operators.graph import PropertyGraph

    rated = spark.createDataFrame([Row(user_id=u, movie_id=m, rating=5, timestamp=0)
                                   for u in range(1, 6) for m in range(u, u + 25)])
    g = PropertyGraph(None, None, None, rated, None)
    e = DV.similar_edges(g, 4, 20, 2).collect()
    assert all(r.u1 < r.u2 for r in e)
    sym = DV.similar_edges(g, 4, 20, 2, symmetric=True).collect()
    assert len(sym) > len(e)


def test_weighted_path_of_more_than_fifty_edges(spark):
    rows = [Row(u1=i, u2=i + 1, distance=1.0) for i in range(54)] + [Row(u1=0, u2=54, distance=100.0)]
    r = A.weighted_path(spark.createDataFrame(rows), 0, 54).collect()[0]
    assert r.totalCost == 54.0 and r.nodeIds == list(range(55)) and r.hops == 54


def test_weighted_paths_match_dijkstra_on_random_graphs(spark):
    rng = random.Random(8)
    edges = [(a, b, float(rng.choice([0, 1, 2, 3, 7]))) for a, b in {tuple(sorted(rng.sample(range(40), 2))) for _ in range(90)}]
    e = spark.createDataFrame([Row(u1=a, u2=b, distance=c) for a, b, c in edges])
    cost = {(a, b): c for a, b, c in edges} | {(b, a): c for a, b, c in edges}
    for t, width in ((39, None), (17, 0.5), (5, 100.0)):
        want = dijkstra(edges, 0, t)
        got = A.weighted_path(e, 0, t, width=width).collect()
        assert (want is None) == (not got)
        if got:
            r = got[0]
            assert r.totalCost == want and r.costs[-1] == want and (r.nodeIds[0], r.nodeIds[-1]) == (0, t) and r.hops == len(r.nodeIds) - 1
            assert [y - x for x, y in zip(r.costs, r.costs[1:])] == [cost[x] for x in zip(r.nodeIds, r.nodeIds[1:])]
    assert A.weighted_path(e, 0, 999).count() == 0 and A.weighted_path(e, None, 3).count() == 0


def test_weighted_path_along_a_chain(spark):
    n = 40
    e = spark.createDataFrame([Row(u1=i, u2=i + 1, distance=1.0) for i in range(n)] + [Row(u1=0, u2=n, distance=n + 1.0)])
    r = A.weighted_path(e, 0, n, width=8.0).collect()[0]
    assert r.nodeIds == list(range(n + 1)) and r.costs == [float(i) for i in range(n + 1)] and r.hops == n


def test_hop_paths_of_every_length_are_the_smallest(spark):
    rng = random.Random(4)
    names = [f"n{i:02d}" for i in range(40)]
    links = {tuple(sorted(rng.sample(names, 2))) for _ in range(52)}
    adj = {}
    for a, b in links:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)

    def smallest(s, t, most):
        layer = [[s]]
        for _ in range(most + 1):
            hits = sorted(p for p in layer if p[-1] == t)
            if hits:
                return hits[0]
            layer = [p + [y] for p in layer for y in adj.get(p[-1], ()) if y not in p]
        return None

    e = spark.createDataFrame([Row(src=a, dst=b) for a, b in links])
    pairs = [(s, t) for s in names[:3] for t in names[::4]]
    for most in (6, 3):
        got = {(r.source, r.target): (r.path, r.length) for r in A.hop_paths(e, spark.createDataFrame(pairs, "source string, target string"), most).collect()}
        want = {(s, t): smallest(s, t, most) for s, t in pairs}
        assert got == {k: (p, len(p) - 1) for k, p in want.items() if p}
    assert max(n for _, n in got.values()) == 3


def test_louvain_finds_planted_communities(spark):
    rng = random.Random(12)
    group = {i: i % 4 for i in range(64)}
    edges = [(a, b, 1.0 + rng.random()) for a in range(64) for b in range(a + 1, 64) if rng.random() < (0.55 if group[a] == group[b] else 0.06)]
    e = spark.createDataFrame([Row(src=a, dst=b, weight=w) for a, b, w in edges])
    v = spark.createDataFrame([Row(id=i) for i in range(70)])
    labels = A.louvain(e, v)
    planted = spark.createDataFrame([Row(id=i, community=group.get(i, i)) for i in range(70)])
    assert A.modularity(e, labels) >= 0.99 * A.modularity(e, planted)
    got = {r.id: r.community for r in labels.collect()}
    assert len(got) == 70 and all(got[i] == i for i in range(64, 70)) and all(got[c] == c for c in got.values())
    genres = A.community_top_genres(labels, spark.createDataFrame([Row(user_id=i, movie_id=group[i], rating=5) for i in range(64)]),
                                    spark.createDataFrame([Row(movie_id=m, genre=f"g{m}") for m in range(4)])).collect()
    assert len(genres) >= 4


def test_hop_paths_with_layers_too_large_to_broadcast(spark, monkeypatch):
    rows = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "c"), ("c", "d"), ("a", "x"), ("x", "c"), ("d", "e"), (None, "e"), ("a", None), ("a", "b")]
    e = spark.createDataFrame(rows, "src string, dst string")
    pairs = spark.createDataFrame([("a", "e"), ("a", "d"), ("e", "x"), ("b", "b"), ("a", None), ("a", "nowhere")], "source string, target string")
    want = {("a", "e"): ["a", "b", "c", "d", "e"], ("a", "d"): ["a", "b", "c", "d"], ("e", "x"): ["e", "d", "c", "x"], ("b", "b"): ["b"]}
    for rows_at_most in (A.LIGHT_ROWS, 0):
        monkeypatch.setattr(A, "LIGHT_ROWS", rows_at_most)
        assert {(r.source, r.target): r.path for r in A.hop_paths(e, pairs).collect()} == want


def test_ratings_are_written_once_for_queries_that_repeat_them(spark):
    from triad.plans import algorithms as P

    g = P._stored_graph(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in g.rated._jdf.queryExecution().executedPlan().toString()
    assert g.rated.count() == P.graph(spark, "/root/testdata/sf0.001").rated.count()
