"""Loads from files in source order, keyed upserts, and the check that rows and vectors match."""

import pytest

from triad.operators import graph as G
from triad.operators.sinks import UnequalCounts, aligned_load, upsert_by_key
from triad.sources.files import in_file_order, read_csv_rows


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_graph_from_files_with_repeated_keys_over_files(spark, tmp_path):
    u, m, r = tmp_path / "users", tmp_path / "movies", tmp_path / "ratings"
    write(u, "part-0.csv", "userId,gender,age,occupation\n1,M,50,3\n2,F,30,\n,M,1,1\nabc,M,1,1\n1,F,51.9,x\n")
    write(u, "part-1.csv", "userId,gender,age,occupation\n2,M,31,7\n3,F,18,2\n")
    write(m, "part-0.csv", 'movieId,title,genres\n10,"Heat, ""The""",Drama| Thriller \n11,Old,Comedy\n,Lost,Western\n')
    write(m, "part-1.csv", "movieId,title,genres\n11,New,Comedy\n12,Bare,\n")
    write(r, "part-0.csv", "userId,movieId,rating,timestamp\n" + "1,10,5,100\n2,11,3,7\n9,10,4,1\n" * 400 + "1,10,3,200\n")
    write(r, "part-1.csv", "userId,movieId,rating,timestamp\n2,11,1,9\n2,11,4.8,8\n3,99,5,1\n,10,5,1\n3,12,bad,5\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # several blocks a file
    try:
        ratings = read_csv_rows(spark, str(r))
        assert ratings.rdd.getNumPartitions() > 2
        g = G.load_graph(read_csv_rows(spark, str(u)), read_csv_rows(spark, str(m)), ratings)
        assert sorted(map(tuple, g.users.collect())) == [(1, "F", 51, None), (2, "M", 31, 7), (3, "F", 18, 2)]
        assert sorted(map(tuple, g.movies.collect())) == [(10, 'Heat, "The"'), (11, "New"), (12, "Bare")]
        assert {x.name for x in g.genres.collect()} == {"Drama", "Thriller", "Comedy", "Western"}
        assert sorted(map(tuple, g.has_genre.collect())) == [(10, "Drama"), (10, "Thriller"), (11, "Comedy")]
        assert sorted(map(tuple, g.rated.collect())) == [(1, 10, 3, 200), (2, 11, 4, 8), (3, 12, None, 5)]
        # a shuffle before the merge does not change which row is last
        mixed = G.load_graph(read_csv_rows(spark, str(u)), read_csv_rows(spark, str(m)), ratings.repartition(7, "timestamp"))
        assert sorted(map(tuple, mixed.rated.collect())) == sorted(map(tuple, g.rated.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_edges_without_an_order_keep_the_last_row_read(spark):
    ids = spark.createDataFrame([(5,)], "user_id int"), spark.createDataFrame([(9,)], "movie_id int")
    rows = spark.createDataFrame([(5, 9, 5, 100), (5, 9, 3, 200), (5, 9, 4, 50)], "user_id int, movie_id int, rating int, timestamp int").coalesce(1)
    got = G.merge_edges(rows, "user_id", ids[0], "movie_id", ids[1], ["rating", "timestamp"]).collect()
    assert [(r.rating, r.timestamp) for r in got] == [(4, 50)]


def test_upsert_keeps_the_last_row_of_a_batch(spark):
    base = spark.createDataFrame([(1, "old", [1.0]), (2, "old", [2.0])], "id int, t string, v array<double>")
    batch = spark.createDataFrame([(1, "z", [9.0]), (3, "c", [3.0]), (1, "b", [8.0]), (4, "x", None), (4, "a", None)], base.schema).coalesce(1)
    got = {r.id: (r.t, r.v) for r in upsert_by_key(base, batch, ["id"], ["t", "v"]).collect()}
    assert got == {1: ("b", [8.0]), 2: ("old", [2.0]), 3: ("c", [3.0]), 4: ("a", None)}
    plan = upsert_by_key(base, batch, ["id"], ["t", "v"])._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate" in line and "v#" in line]


def test_upsert_by_order_columns(spark):
    base = spark.createDataFrame([(1, "base", 10), (2, "base", 1), (3, "base", 5)], "id int, t string, at int")
    batch = spark.createDataFrame([(1, "late", 3), (2, "x", 4), (2, "w", 3), (3, "equal", 5), (9, "new", 0)], base.schema).coalesce(1)
    got = {r.id: (r.t, r.at) for r in upsert_by_key(base, batch, ["id"], ["t", "at"], ["at"]).collect()}
    assert got == {1: ("base", 10), 2: ("x", 4), 3: ("equal", 5), 9: ("new", 0)}


def test_aligned_load_fails_on_unequal_sides(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "id int, t string")
    vectors = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "id int, v array<double>")
    found = aligned_load(rows, vectors, "id", lambda df: df.write.parquet(str(tmp_path / "a")))
    assert found == {"rows": 5, "vectors": 5, "rows_alone": 0, "vectors_alone": 0}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 5
    for less, more in ((rows.where("id > 1"), vectors), (rows, vectors.where("id <> 3"))):
        with pytest.raises(UnequalCounts, match="_alone"):
            aligned_load(less, more, "id", lambda df: df.write.mode("overwrite").parquet(str(tmp_path / "b")))


def test_in_file_order_names_path_block_and_row(spark, tmp_path):
    write(tmp_path / "f", "a.csv", "x\n1\n2\n")
    write(tmp_path / "f", "b.csv", "x\n3\n")
    rows = in_file_order(spark.read.option("header", True).csv(str(tmp_path / "f"))).orderBy("_order").collect()
    assert [r.x for r in rows] == ["1", "2", "3"] and rows[0]["_order"]["block"] == 0
