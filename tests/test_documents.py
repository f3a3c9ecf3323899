"""Document operators on hand-made track rows (edge rows from FIXTURES.md A1)."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from triad.operators import documents as D
from triad.sources.files import read_tracks_csv

COLS = ["track_id", "track_name", "album_name", "artists", "track_genre", "explicit", "popularity",
        "duration_ms", "danceability", "energy", "loudness", "speechiness", "acousticness",
        "instrumentalness", "liveness", "valence", "tempo", "key", "mode", "time_signature"]


def raw_row(i, **kw):
    base = dict(track_id=f"t{i}", track_name=f"name{i}", album_name="alb", artists="A; B ;",
                track_genre="pop", explicit=False, popularity=50, duration_ms=200000,
                danceability=0.8, energy=0.8, loudness=-5.0, speechiness=0.05, acousticness=0.1,
                instrumentalness=0.1, liveness=0.1, valence=0.6, tempo=120.0, key=1, mode=1,
                time_signature=4)
    base.update(kw)
    return base


def make_raw(spark, rows):
    schema = ("track_id string, track_name string, album_name string, artists string, track_genre string, "
              "explicit boolean, popularity int, duration_ms int, danceability double, energy double, "
              "loudness double, speechiness double, acousticness double, instrumentalness double, "
              "liveness double, valence double, tempo double, key int, mode int, time_signature int")
    return spark.createDataFrame([Row(**r) for r in rows], schema)


def test_read_tracks_csv_coerces(spark, tmp_path):
    p = tmp_path / "tracks.csv"
    p.write_text(
        ",".join(COLS) + "\n"
        "1,n1,a,\"A; B ;\",pop,True,12.9,1000,0.5,x,-1,0,0,0,0,0,100,1,0,4\n"
        "2,n2,a,NA,pop,False,bad,1000,0.5,0.5,-1,0,0,0,0,0,100,1,0,4\n"
        "3,,a,C,pop,,70,,0.5,0.5,-1,0,0,0,0,0,100,1,0,4\n"
        "4,n4,a,D,pop,,70,,0.5,0.5,-1,0,0,0,0,0,100,1,0,4\n")
    rows = {r.track_id: r for r in read_tracks_csv(spark, str(p)).collect()}
    assert set(rows) == {"1", "4"}  # NA artists and missing name are dropped
    assert rows["1"].popularity == 12 and rows["1"].energy == 0.0 and rows["1"].explicit is True
    assert rows["4"].explicit is True and rows["4"].duration_ms == 0  # missing bool -> true, int -> 0


def test_nest_tracks_shapes_and_rounding(spark):
    raw = make_raw(spark, [raw_row(1, artists="A; B ;", duration_ms=250, popularity=39),
                           raw_row(2, artists=";", duration_ms=230650, popularity=40),
                           raw_row(3, artists="Solo", duration_ms=1000, popularity=69),
                           raw_row(4, artists=None, duration_ms=0, popularity=70)])
    out = {r.track_id: r for r in D.nest_tracks(raw).collect()}
    assert out["t1"].artists == ["A", "B"] and out["t2"].artists == [] and out["t4"].artists == []
    assert out["t1"].duration_sec == 0.2  # half to even
    assert out["t2"].duration_sec == 230.6
    assert [out[k].popularity_tier for k in ("t1", "t2", "t3", "t4")] == ["low", "medium", "medium", "high"]
    assert out["t1"].audio_features.tempo == 120.0
    assert "danceability" not in D.nest_tracks(raw).columns


def test_filters_boundaries(spark):
    raw = make_raw(spark, [raw_row(1, danceability=0.7), raw_row(2, duration_ms=180000),
                           raw_row(3, duration_ms=300000), raw_row(4, duration_ms=300001),
                           raw_row(5, danceability=0.71, popularity=90)])
    t = D.nest_tracks(raw)
    party = [r.track_name for r in D.party_tracks(t).collect()]
    assert party == ["name5", "name2", "name3"]
    dance = {r.track_id for r in D.genre_danceable(t).collect()}
    assert "t1" in dance  # >= in the genre query


def test_background_and_work_music(spark):
    raw = make_raw(spark, [raw_row(1, loudness=-12.0, instrumentalness=0.6),
                           raw_row(2, loudness=-12.0, instrumentalness=0.6, explicit=True),
                           raw_row(3, loudness=-8.0, instrumentalness=0.6)])
    t = D.nest_tracks(raw)
    assert [r.track_name for r in D.background_tracks(t).collect()] == ["name1"]
    assert {r.track_id for r in D.work_music(t).collect()} == {"t1", "t3"}


def test_artist_aggregations(spark):
    rows = [raw_row(i, artists="X; Y", popularity=60 + i) for i in range(5)]
    rows += [raw_row(10 + i, artists="Z", popularity=100) for i in range(2)]
    t = D.nest_tracks(make_raw(spark, rows))
    pa = D.popular_artists(t).collect()
    assert [(r.artist, r.track_count, r.min_popularity, r.avg_popularity) for r in pa] == \
        [("X", 5, 60, 62.0), ("Y", 5, 60, 62.0)]
    ta = D.top_artists(t, min_tracks=2).collect()
    assert [r.artist for r in ta] == ["Z", "X", "Y"]


def test_tempo_outliers_one_genre_only(spark):
    rows = [raw_row(i, track_genre="g1", tempo=100.0) for i in range(20)] + [raw_row(99, track_genre="g1", tempo=300.0)]
    rows += [raw_row(100 + i, track_genre="g2", tempo=100.0 + i) for i in range(3)]
    t = D.nest_tracks(make_raw(spark, rows))
    flat = D.tempo_outliers(t).collect()
    assert [(r.genre, r._id) for r in flat] == [("g1", "t99")]
    nested = D.tempo_outliers(t, nested=True).collect()
    assert len(nested) == 1 and nested[0].outlier_tracks[0]["_id"] == "t99"


def test_mood_boundaries(spark):
    rows = [raw_row(1, valence=0.5, energy=0.5), raw_row(2, valence=0.49, energy=0.5),
            raw_row(3, valence=0.5, energy=0.49), raw_row(4, valence=0.1, energy=0.1)]
    m = {r.mood: r.track_count for r in D.mood_distribution(D.nest_tracks(make_raw(spark, rows))).collect()}
    assert m == {"happy": 1, "angry": 1, "calm": 1, "sad": 1}


def test_danceable_genres_sort(spark):
    rows = [raw_row(i, track_genre="a", danceability=0.5) for i in range(3)]
    rows += [raw_row(10 + i, track_genre="b", danceability=0.9) for i in range(3)]
    out = D.danceable_genres(D.nest_tracks(make_raw(spark, rows)), min_tracks=3).collect()
    assert [r.genre for r in out] == ["b", "a"]
    assert out[0].avg_danceability == 0.9


def test_collection_count(spark):
    t = D.nest_tracks(make_raw(spark, [raw_row(i) for i in range(7)]))
    assert D.collection_count(t, "tracks").collect()[0].n == 7


def test_nested_filter_pushed_to_scan(spark, tmp_path):
    t = D.nest_tracks(make_raw(spark, [raw_row(i) for i in range(4)]))
    path = str(tmp_path / "tracks")
    t.write.parquet(path)
    q = D.party_tracks(spark.read.parquet(path))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "audio_features.danceability" in plan.split("PushedFilters")[1].split("]")[0]


def test_clustered_layout_same_rows(spark, tmp_path):
    from triad.operators.layout import read_clustered, write_clustered

    rows = [raw_row(i, track_genre="pop" if i % 2 else "rock", popularity=i % 50, danceability=(i % 10) / 10)
            for i in range(60)]
    t = D.nest_tracks(make_raw(spark, rows))
    path = write_clustered(t, str(tmp_path / "c"), ["track_genre"], [F.desc("popularity")],
                           ["audio_features.danceability"], num_partitions=3)
    a = sorted(D.genre_danceable(t).collect())
    b = sorted(D.genre_danceable(read_clustered(spark, path)).collect())
    assert a == b and len(a) > 0


def test_csv_quotes_and_backslashes(spark, tmp_path):
    from triad.sources.files import read_csv_text

    p = tmp_path / "q.csv"
    p.write_text('id,name,n\n1,"""Heroes"" - 2017 Remaster",3\n2,"Say ""Hi"", now",4\n3,"C\\",5\n4,plain,6\n')
    assert [tuple(r) for r in read_csv_text(spark, str(p)).orderBy("id").collect()] == [
        ("1", '"Heroes" - 2017 Remaster', "3"), ("2", 'Say "Hi", now', "4"), ("3", "C\\", "5"), ("4", "plain", "6")]


def test_clustered_layout_has_more_tasks_for_more_rows(spark, tmp_path, monkeypatch):
    from triad.operators import layout

    monkeypatch.setattr(layout, "ROWS_PER_TASK", 10, raising=False)
    t = spark.range(200).select((F.col("id") % 3).alias("g"), "id")
    path = layout.write_clustered(t, str(tmp_path / "c"), ["g"], ["id"])
    back = layout.read_clustered(spark, path)
    files = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(files) >= 16 and max(files) <= 40 and back.count() == 200
