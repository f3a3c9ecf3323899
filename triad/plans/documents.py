"""Registered document queries: Spark plan + equivalent SQL for the oracle.

Thresholds differ from the reference's literals only where the driver's
tables have other value ranges (see FIXTURES.md, "Thresholds").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.operators import documents as D
from triad.plans.common import flatten
from triad.plans.views_sql import with_views
from triad.sources import testviews as V

GENRE = "ECONOMY"          # a track_genre (p_type) value present at every scale
POPULAR_ARTIST_MIN = 50    # minimum popularity for popular_artists on these tables


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.nest_tracks(V.tracks_raw(spark, sf_dir))


def q_nest_tracks(spark, sf_dir):
    return flatten(tracks(spark, sf_dir))


def q_coerce_tracks(spark, sf_dir):
    return D.coerce_tracks(V.tracks_text(spark, sf_dir))


def q_party_tracks(spark, sf_dir):
    return flatten(D.party_tracks(tracks(spark, sf_dir)))


def q_background_tracks(spark, sf_dir):
    return flatten(D.background_tracks(tracks(spark, sf_dir)))


def q_genre_danceable(spark, sf_dir):
    return flatten(D.genre_danceable(tracks(spark, sf_dir), genre=GENRE))


def q_work_music(spark, sf_dir):
    return flatten(D.work_music(tracks(spark, sf_dir)))


def q_genre_popular(spark, sf_dir):
    return flatten(D.genre_popular(tracks(spark, sf_dir), genre=GENRE))


def q_popular_artists(spark, sf_dir):
    return D.popular_artists(tracks(spark, sf_dir), min_popularity=POPULAR_ARTIST_MIN)


def q_tempo_outliers(spark, sf_dir):
    return flatten(D.tempo_outliers(tracks(spark, sf_dir)))


def q_tempo_outlier_docs(spark, sf_dir):
    """The document form: one row per genre, its outliers in an array (here joined to text)."""
    docs = D.tempo_outliers(tracks(spark, sf_dir), nested=True)
    return docs.select("genre", "avg_tempo", "outlier_threshold", F.size("outlier_tracks").alias("n_outliers"),
                       F.array_join(F.transform("outlier_tracks", lambda t: F.concat_ws(
                           ":", t["_id"].cast("string"), t["track_name"], t["popularity"].cast("string"), F.array_join(t["artists"], "|"),
                           F.floor(t["audio_features"]["tempo"]).cast("string"))), ";").alias("outliers"))


def q_top_artists(spark, sf_dir):
    return D.top_artists(tracks(spark, sf_dir))


def q_mood_distribution(spark, sf_dir):
    return D.mood_distribution(tracks(spark, sf_dir))


def q_danceable_genres(spark, sf_dir):
    return D.danceable_genres(tracks(spark, sf_dir))


def q_clustered_read(spark, sf_dir):
    """The genre/danceability query on a table laid out for it (equality: genre,
    sort: popularity desc, range: danceability), written under the checkpoint folder."""
    from triad.operators.layout import read_clustered, write_clustered
    from triad.session import scratch_path

    path = write_clustered(tracks(spark, sf_dir), scratch_path(spark, "clustered-tracks"),
                           ["track_genre"], [F.desc("popularity")], ["audio_features.danceability"])
    return flatten(D.genre_danceable(read_clustered(spark, path), genre=GENRE))


def q_track_count(spark, sf_dir):
    return D.collection_count(tracks(spark, sf_dir), "tracks")


QUERIES = {
    "nest_tracks": q_nest_tracks,
    "coerce_tracks": q_coerce_tracks,
    "party_tracks": q_party_tracks,
    "background_tracks": q_background_tracks,
    "genre_danceable": q_genre_danceable,
    "work_music": q_work_music,
    "genre_popular": q_genre_popular,
    "popular_artists": q_popular_artists,
    "tempo_outliers": q_tempo_outliers,
    "tempo_outlier_docs": q_tempo_outlier_docs,
    "top_artists": q_top_artists,
    "mood_distribution": q_mood_distribution,
    "danceable_genres": q_danceable_genres,
    "track_count": q_track_count,
    "clustered_read": q_clustered_read,
}

_ARTISTS = "array_to_string(artists, '|') AS artists"

ORACLE = {
    "nest_tracks": with_views(f"""
SELECT track_id, track_name, album_name, explicit, popularity, duration_ms, track_genre, {_ARTISTS},
       danceability, energy, loudness, speechiness, acousticness, instrumentalness, liveness,
       valence, tempo, "key", "mode", time_signature, duration_sec, popularity_tier
FROM tracks""", "tracks"),

    "coerce_tracks": with_views("""
SELECT CAST(track_id AS VARCHAR) AS track_id, track_name, album_name, artists, track_genre, explicit,
       popularity, duration_ms, danceability, energy, loudness, speechiness, acousticness,
       instrumentalness, liveness, valence, tempo, "key", "mode", time_signature
FROM tracks_raw""", "tracks_raw"),

    "party_tracks": with_views(f"""
SELECT track_name, {_ARTISTS}, track_genre, duration_ms, popularity, danceability, energy
FROM tracks
WHERE danceability > 0.7 AND energy > 0.7 AND duration_ms BETWEEN 180000 AND 300000
ORDER BY popularity DESC, track_name, tracks.artists, track_genre, duration_ms, danceability, energy
LIMIT 20""", "tracks"),

    "background_tracks": with_views(f"""
SELECT track_name, {_ARTISTS}, track_genre, explicit, popularity, loudness, speechiness, instrumentalness
FROM tracks
WHERE loudness < -10 AND speechiness < 0.1 AND instrumentalness > 0.5 AND NOT explicit
ORDER BY popularity DESC, track_name, tracks.artists, track_genre, loudness, speechiness, instrumentalness
LIMIT 20""", "tracks"),

    "genre_danceable": with_views(f"""
SELECT track_id, track_name, popularity, track_genre, danceability
FROM tracks WHERE track_genre = '{GENRE}' AND danceability >= 0.7""", "tracks"),

    "work_music": with_views(f"""
SELECT track_id, track_name, {_ARTISTS}, explicit, instrumentalness, speechiness
FROM tracks WHERE NOT explicit AND instrumentalness > 0.5 AND speechiness < 0.1""", "tracks"),

    "genre_popular": with_views(f"""
SELECT track_id, track_name, album_name, explicit, popularity, duration_ms, track_genre, {_ARTISTS},
       danceability, energy, loudness, speechiness, acousticness, instrumentalness, liveness,
       valence, tempo, "key", "mode", time_signature, duration_sec, popularity_tier
FROM tracks WHERE track_genre = '{GENRE}' AND popularity >= 70""", "tracks"),

    "popular_artists": with_views(f"""
SELECT artist, count(*) AS track_count, min(popularity) AS min_popularity,
       round_even(avg(popularity), 1) AS avg_popularity
FROM (SELECT unnest(artists) AS artist, popularity FROM tracks)
GROUP BY artist
HAVING count(*) >= 3 AND min(popularity) >= {POPULAR_ARTIST_MIN}
ORDER BY avg_popularity DESC, track_count DESC, artist ASC
LIMIT 20""", "tracks"),

    "tempo_outliers": with_views(f"""
SELECT t.track_genre AS genre, round_even(s.avg_tempo, 1) AS avg_tempo,
       round_even(s.threshold, 1) AS outlier_threshold, t.track_id AS _id, t.track_name,
       t.popularity, array_to_string(t.artists, '|') AS artists, t.tempo
FROM tracks t JOIN (
    SELECT track_genre, avg(tempo) AS avg_tempo, avg(tempo) + 2.0 * stddev_pop(tempo) AS threshold
    FROM tracks GROUP BY track_genre) s ON t.track_genre = s.track_genre
WHERE t.tempo > s.threshold""", "tracks"),

    "tempo_outlier_docs": with_views("""
SELECT t.track_genre AS genre, round_even(s.avg_tempo, 1) AS avg_tempo, round_even(s.threshold, 1) AS outlier_threshold,
       CAST(count(*) AS INTEGER) AS n_outliers,
       string_agg(concat_ws(':', CAST(t.track_id AS VARCHAR), t.track_name, CAST(t.popularity AS VARCHAR), array_to_string(t.artists, '|'),
                            CAST(CAST(floor(t.tempo) AS BIGINT) AS VARCHAR)), ';' ORDER BY t.track_id, t.track_name) AS outliers
FROM tracks t JOIN (
    SELECT track_genre, avg(tempo) AS avg_tempo, avg(tempo) + 2.0 * stddev_pop(tempo) AS threshold
    FROM tracks GROUP BY track_genre) s ON t.track_genre = s.track_genre
WHERE t.tempo > s.threshold GROUP BY ALL""", "tracks"),

    "top_artists": with_views("""
SELECT artist, count(*) AS track_count, round_even(avg(popularity), 1) AS avg_popularity
FROM (SELECT unnest(artists) AS artist, popularity FROM tracks)
GROUP BY artist HAVING count(*) >= 5
ORDER BY avg_popularity DESC, track_count DESC, artist ASC
LIMIT 10""", "tracks"),

    "mood_distribution": with_views("""
SELECT CASE WHEN valence >= 0.5 AND energy >= 0.5 THEN 'happy'
            WHEN valence < 0.5 AND energy >= 0.5 THEN 'angry'
            WHEN valence >= 0.5 AND energy < 0.5 THEN 'calm'
            ELSE 'sad' END AS mood,
       count(*) AS track_count
FROM tracks GROUP BY 1 ORDER BY 1""", "tracks"),

    "danceable_genres": with_views("""
SELECT track_genre AS genre, count(*) AS track_count,
       round_even(avg(danceability), 3) AS avg_danceability,
       round_even(avg(energy), 3) AS avg_energy,
       round_even(avg(valence), 3) AS avg_valence
FROM tracks GROUP BY track_genre HAVING count(*) >= 100
ORDER BY avg_danceability DESC, avg_energy DESC, avg_valence DESC, track_count DESC, genre ASC""",
                                   "tracks"),

    "track_count": with_views("SELECT 'tracks' AS collection, count(*) AS n FROM tracks", "tracks"),
}
ORACLE["clustered_read"] = ORACLE["genre_danceable"]
