"""Graph load and pattern queries on hand-made ratings (FIXTURES.md A5 edge rows)."""

import pytest
from pyspark.sql import Row

from triad.operators import graph as G
from triad.sources.files import read_delimited


@pytest.fixture(scope="module")
def g(spark):
    users = spark.createDataFrame([Row(user_id=u, gender="M" if u % 2 else "F", age=20 + u, occupation=u % 3)
                                   for u in range(1, 8)])
    movies = spark.createDataFrame([
        Row(movie_id=10, title="Alpha", genres="Drama|Thriller"),
        Row(movie_id=11, title="Beta", genres="Thriller"),
        Row(movie_id=12, title="Gamma", genres="Comedy| Drama "),
        Row(movie_id=13, title="Delta", genres="Comedy"),
        Row(movie_id=14, title="Eps", genres=None),
    ])
    r = [  # (user, movie, rating, ts)
        (1, 10, 5, 1), (1, 11, 4, 1), (1, 12, 2, 1),
        (2, 10, 5, 1), (2, 11, 5, 1), (2, 13, 4, 1), (2, 14, 5, 1),
        (3, 10, 4, 1), (3, 11, 4, 1), (3, 13, 5, 1), (3, 14, 4, 1),
        (4, 12, 1, 1), (4, 13, 2, 1),
        (5, 10, 1, 1), (5, 10, 5, 2),  # repeat pair: the later one wins
        (99, 10, 5, 1),  # unknown user
        (6, 77, 5, 1),  # unknown movie
    ]
    ratings = spark.createDataFrame([Row(user_id=a, movie_id=b, rating=c, timestamp=d, seq=d) for a, b, c, d in r])
    return G.build_graph(users, movies, ratings, ["seq"])


def test_load_counts_and_merge(g):
    counts = {r.item: r.n for r in G.graph_counts(g).collect()}
    assert counts == {"users": 7, "movies": 5, "genres": 3, "ratings": 14, "has_genre": 6}
    r5 = [r.rating for r in g.rated.where("user_id = 5").collect()]
    assert r5 == [5]
    assert {r.name for r in g.genres.collect()} == {"Drama", "Thriller", "Comedy"}
    types = {r.relationshipType: r.relationshipCount for r in G.edge_types(g).collect()}
    assert types == {"RATED": 14, "HAS_GENRE": 6}


def test_patterns(g):
    thr = G.genre_top_rated(g, "Thriller", 4.0).collect()
    assert [(r.movieId, r.avgRating, r.ratingsCount) for r in thr] == [(10, 4.75, 4), (11, 4.33, 3)]
    five = G.heavy_fivestar_users(g, 5, 1).collect()
    assert [(r.userId, r.fiveStarCount) for r in five] == [(2, 3)]
    both = G.both_rated_high(g, 2, 3).collect()
    assert [r.movieId for r in both] == [10, 11, 13, 14]
    gq = {r.genre: (r.avgRating, r.ratingsCount) for r in G.genre_quality(g, 1).collect()}
    assert gq["Thriller"] == (4.57, 7)


def test_recommend_matches_brute_force(g):
    rated = [(r.user_id, r.movie_id, r.rating) for r in g.rated.collect()]
    target, min_overlap = 1, 1
    mine = {m: r for u, m, r in rated if u == target}
    likes = [(u, m, r) for u, m, r in rated if r >= 4]
    stats = {}
    for u, m, r in likes:
        if u != target and m in mine and mine[m] >= 4:
            stats.setdefault(u, []).append(abs(mine[m] - r))
    nb = {u for u, d in stats.items() if len(d) >= min_overlap and sum(d) / len(d) <= 1.0}
    rec = {}
    for u, m, r in likes:
        if u in nb and m not in mine:
            rec.setdefault(m, []).append((u, r))
    want = sorted(((m, len({u for u, _ in v}), sum(r for _, r in v) / len(v)) for m, v in rec.items()),
                  key=lambda x: (-x[1], -x[2], x[0]))
    got = G.recommend(g, target, min_overlap=min_overlap).collect()
    assert [(r.movieId, r.similarUsersCount) for r in got] == [(m, c) for m, c, _ in want]

    simple = {r.title: r.score for r in G.recommend_simple(g, 1).collect()}
    titles = {10: "Alpha", 11: "Beta", 12: "Gamma", 13: "Delta", 14: "Eps"}
    paths = {}
    for u1, m1, _ in rated:
        if u1 != 1:
            continue
        for u2, m2, _ in rated:
            if m2 != m1 or u2 == 1:
                continue
            for u3, m3, _ in rated:
                if u3 == u2 and m3 not in mine:
                    paths[titles[m3]] = paths.get(titles[m3], 0) + 1
    assert simple == paths


def test_degrees_and_supernodes(g):
    ud = G.user_degree(g, 3).collect()
    assert [(r.userId, r.degree) for r in ud] == [(2, 4), (3, 4), (1, 3)]
    sn = G.supernodes(g, 3).collect()
    assert (sn[0].nodeLabels, sn[0].identifier, sn[0].degree) == ("Movie", "10", 6)
    band = G.degree_band(g, 2, 2).collect()
    assert [(r.movieId, r.ratingCount) for r in band] == [(12, 2), (14, 2)]
    nd = {(r.nodeLabels, r.identifier): r.degree for r in G.node_degrees(g).collect()}
    assert nd[("User", "7")] == 0  # isolated vertex kept


def test_key_violations(spark):
    rows = spark.createDataFrame([Row(k=1), Row(k=1), Row(k=2)])
    assert [(r.k, r.n) for r in G.key_violations(rows, ["k"]).collect()] == [(1, 2)]


def test_read_delimited_latin1(spark, tmp_path):
    p = tmp_path / "movies.dat"
    p.write_bytes("1::Amélie (2001)::Comedy|Romance\n2::Two fields only\n3::Heat, \"The\"::\n".encode("latin-1"))
    rows = read_delimited(spark, str(p), 3, ["movieId", "title", "genres"]).collect()
    assert [(r.movieId, r.title, r.genres) for r in rows] == [
        ("1", "Amélie (2001)", "Comedy|Romance"), ("3", 'Heat, "The"', "")]


def test_merge_nodes_without_order_keeps_the_last_row_read(spark):
    from triad.operators.graph import merge_nodes

    rows = spark.createDataFrame([(1, "M", 50), (2, "F", 30), (1, "F", 18)], "user_id long, gender string, age int").coalesce(1)
    got = {r.user_id: (r.gender, r.age) for r in merge_nodes(rows, "user_id", ["gender", "age"]).collect()}
    assert got == {1: ("F", 18), 2: ("F", 30)}


def test_ratings_of_a_genre_are_enough_for_its_result(spark):
    movies = spark.createDataFrame([(1, "a", "X| Y"), (2, "b", "Y"), (3, "c", None), (None, "d", "X"), (1, "a", "X")], "movie_id long, title string, genres string")
    rows = spark.createDataFrame([(1, 1, 5, 1), (1, 1, 4, 2), (2, 1, 5, 1), (1, 2, 5, 1), (2, 3, 5, 1), (1, None, 5, 1), (9, 1, 1, 1)],
                                 "user_id long, movie_id long, rating int, timestamp long")
    users = spark.createDataFrame([(1, "f", 1, 1), (2, "m", 1, 1)], "user_id long, gender string, age int, occupation int")
    few = rows.join(G.movies_of_genre(movies, "X"), "movie_id", "left_semi")
    assert few.count() == 4
    want = G.genre_top_rated(G.build_graph(users, movies, rows, ["timestamp"]), "X", 1.0).collect()
    assert G.genre_top_rated(G.build_graph(users, movies, few, ["timestamp"]), "X", 1.0).collect() == want and len(want) == 1


def test_genre_query_joins_only_its_ratings_with_orders(spark):
    from triad.plans import graph as P
    from triad.sources import testviews as V

    small = "/root/testdata/sf0.001"
    movies = G.movies_of_genre(V.movies(spark, small), P.GENRE)
    whole = V.ratings_raw(spark, small).join(movies, "movie_id", "left_semi")
    few = V.ratings_raw(spark, small, movies)
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.select(few.columns).collect()))
    plan = P.q_genre_top_rated(spark, small)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    orders = next(i for i, line in enumerate(plan) if "l_orderkey" in line and "Join Inner" in line)
    assert any("Join LeftSemi, (l_partkey" in line and depth(line) > depth(plan[orders]) for line in plan[orders:])
