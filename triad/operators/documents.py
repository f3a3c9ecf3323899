"""Document operators on track records: reshape, filter, unwind, group, rank.

Every function takes and returns a DataFrame; thresholds are parameters whose
defaults are the reference's literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.functions.numeric import lenient_bool, lenient_double, lenient_int, round_half_even
from triad.functions.text import strip_ws

AUDIO_FEATURES = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                  "instrumentalness", "liveness", "valence", "tempo", "key", "mode",
                  "time_signature"]
INT_COLUMNS = ["popularity", "duration_ms", "key", "mode", "time_signature"]
DOUBLE_COLUMNS = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                  "instrumentalness", "liveness", "valence", "tempo"]


def _af(name: str):
    return F.col(f"audio_features.{name}")


# ------------------------------------------------------------- cleaning

def coerce_tracks(raw: DataFrame, explicit_null_as: bool = True,
                  required=("artists", "track_name")) -> DataFrame:
    """Type the text columns of a track file: bool, lenient ints and doubles, and
    drop rows missing a required column."""
    cols = []
    for c in raw.columns:
        if c == "explicit":
            cols.append(lenient_bool(c, explicit_null_as).alias(c))
        elif c in INT_COLUMNS:
            cols.append(lenient_int(c).alias(c))
        elif c in DOUBLE_COLUMNS:
            cols.append(lenient_double(c).alias(c))
        else:
            cols.append(F.col(c))
    out = raw.select(*cols)
    present = [c for c in required if c in raw.columns]
    return out.na.drop(subset=present) if present else out


# ------------------------------------------------------------- reshape

def split_artists(col, sep: str = ";"):
    """'A; B ;' -> ['A', 'B']: split, strip each part, drop empty parts."""
    parts = F.split(F.coalesce(col, F.lit("")), sep if sep != "|" else r"\|")
    return F.filter(F.transform(parts, lambda a: strip_ws(a)), lambda a: a != "")


def popularity_tier(col, high: int = 70, medium: int = 40):
    return (F.when(col >= high, "high")
            .when((col >= medium) & (col < high), "medium")
            .otherwise("low"))


def nest_tracks(raw: DataFrame) -> DataFrame:
    """Flat track rows to documents: artists array, audio_features struct,
    duration in seconds and a popularity tier; raw columns dropped."""
    return raw.select(
        "track_id", "track_name", "album_name", "explicit", "popularity", "duration_ms",
        "track_genre",
        split_artists(F.col("artists")).alias("artists"),
        F.struct(*[F.col(c) for c in AUDIO_FEATURES]).alias("audio_features"),
        round_half_even(F.col("duration_ms").cast("double") / F.lit(1000.0), 1).alias("duration_sec"),
        popularity_tier(F.col("popularity")).alias("popularity_tier"),
    )


# ------------------------------------------------------------- filters

def party_tracks(tracks: DataFrame, dance_min: float = 0.7, energy_min: float = 0.7,
                 duration_lo: int = 180000, duration_hi: int = 300000, k: int = 20) -> DataFrame:
    out = tracks.where((_af("danceability") > dance_min) & (_af("energy") > energy_min)
                       & F.col("duration_ms").between(duration_lo, duration_hi)).select(
        "track_name", "artists", "track_genre", "duration_ms", "popularity",
        F.struct(_af("danceability").alias("danceability"),
                 _af("energy").alias("energy")).alias("audio_features"))
    return out.orderBy(F.desc("popularity"), "track_name", "artists", "track_genre", "duration_ms",
                       "audio_features.danceability", "audio_features.energy").limit(k)


def background_tracks(tracks: DataFrame, loudness_max: float = -10.0, speech_max: float = 0.1,
                      instrumental_min: float = 0.5, k: int = 20) -> DataFrame:
    out = tracks.where((_af("loudness") < loudness_max) & (_af("speechiness") < speech_max)
                       & (_af("instrumentalness") > instrumental_min) & (~F.col("explicit"))).select(
        "track_name", "artists", "track_genre", "explicit", "popularity",
        F.struct(_af("loudness").alias("loudness"), _af("speechiness").alias("speechiness"),
                 _af("instrumentalness").alias("instrumentalness")).alias("audio_features"))
    return out.orderBy(F.desc("popularity"), "track_name", "artists", "track_genre",
                       "audio_features.loudness", "audio_features.speechiness",
                       "audio_features.instrumentalness").limit(k)


def genre_danceable(tracks: DataFrame, genre: str = "pop", dance_min: float = 0.7) -> DataFrame:
    """Equality on genre, range on danceability, sorted by popularity (no limit)."""
    return tracks.where((F.col("track_genre") == genre) & (_af("danceability") >= dance_min)).select(
        "track_id", "track_name", "popularity", "track_genre",
        F.struct(_af("danceability").alias("danceability")).alias("audio_features"),
    ).orderBy(F.desc("popularity"))


def work_music(tracks: DataFrame, instrumental_min: float = 0.5, speech_max: float = 0.1) -> DataFrame:
    return tracks.where((~F.col("explicit")) & (_af("instrumentalness") > instrumental_min)
                        & (_af("speechiness") < speech_max)).select(
        "track_id", "track_name", "artists", "explicit",
        F.struct(_af("instrumentalness").alias("instrumentalness"),
                 _af("speechiness").alias("speechiness")).alias("audio_features"))


def genre_popular(tracks: DataFrame, genre: str = "pop", popularity_min: int = 70,
                  columns: list[str] | None = None) -> DataFrame:
    """Whole documents (or only ``columns``) of one genre above a popularity."""
    out = tracks.where((F.col("track_genre") == genre) & (F.col("popularity") >= popularity_min))
    return out.select(*columns) if columns else out


# ------------------------------------------------------------- aggregations (A1-A5)

def _artist_stats(tracks: DataFrame) -> DataFrame:
    return tracks.select(F.explode("artists").alias("artist"), "popularity")


def popular_artists(tracks: DataFrame, min_tracks: int = 3, min_popularity: int = 60,
                    k: int = 20) -> DataFrame:
    """Artists whose every track is popular: unwind, count/min/avg, having, top k."""
    g = _artist_stats(tracks).groupBy("artist").agg(
        F.count(F.lit(1)).alias("track_count"),
        F.min("popularity").alias("min_popularity"),
        F.avg("popularity").alias("avg_popularity"))
    g = g.where((F.col("track_count") >= min_tracks) & (F.col("min_popularity") >= min_popularity))
    out = g.select("artist", "track_count", "min_popularity",
                   round_half_even(F.col("avg_popularity"), 1).alias("avg_popularity"))
    return out.orderBy(F.desc("avg_popularity"), F.desc("track_count"), F.asc("artist")).limit(k)


def top_artists(tracks: DataFrame, min_tracks: int = 5, k: int = 10) -> DataFrame:
    """Top artists by average popularity among those with enough tracks."""
    g = _artist_stats(tracks).groupBy("artist").agg(
        F.count(F.lit(1)).alias("track_count"),
        F.avg("popularity").alias("avg_popularity"))
    out = g.where(F.col("track_count") >= min_tracks).select(
        "artist", "track_count", round_half_even(F.col("avg_popularity"), 1).alias("avg_popularity"))
    return out.orderBy(F.desc("avg_popularity"), F.desc("track_count"), F.asc("artist")).limit(k)


def tempo_outliers(tracks: DataFrame, n_std: float = 2.0, nested: bool = False) -> DataFrame:
    """Tracks whose tempo is above their genre's mean + n_std * population std.

    The per-genre statistics are one small aggregate joined back to the
    tracks (no window holding a whole genre in one task). The default result
    is one row per outlier track with its genre's figures; ``nested=True``
    gives the document form, one row per genre with the outliers in an array
    (only when the number of outliers per genre is known to be small).
    """
    stats = tracks.groupBy("track_genre").agg(
        F.avg(_af("tempo")).alias("avg_tempo"),
        F.stddev_pop(_af("tempo")).alias("std_tempo"))
    stats = stats.select("track_genre", "avg_tempo",
                         (F.col("avg_tempo") + F.lit(float(n_std)) * F.col("std_tempo")).alias("threshold"))
    flat = tracks.select("track_id", "track_name", "popularity", "artists", "track_genre",
                         _af("tempo").alias("tempo")).join(stats, "track_genre", "inner") \
        .where(F.col("tempo") > F.col("threshold"))
    flat = flat.select(
        F.col("track_genre").alias("genre"),
        round_half_even(F.col("avg_tempo"), 1).alias("avg_tempo"),
        round_half_even(F.col("threshold"), 1).alias("outlier_threshold"),
        F.col("track_id").alias("_id"), "track_name", "popularity", "artists", "tempo")
    if not nested:
        return flat
    track = F.struct(F.col("_id"), "track_name", "popularity", "artists",
                     F.struct(F.col("tempo").alias("tempo")).alias("audio_features"))
    return flat.groupBy("genre", "avg_tempo", "outlier_threshold").agg(
        F.sort_array(F.collect_list(track)).alias("outlier_tracks")) \
        .where(F.size("outlier_tracks") > 0).orderBy("genre")


def mood_of(valence, energy, cut: float = 0.5):
    return (F.when((valence >= cut) & (energy >= cut), "happy")
            .when((valence < cut) & (energy >= cut), "angry")
            .when((valence >= cut) & (energy < cut), "calm")
            .otherwise("sad"))


def mood_distribution(tracks: DataFrame, cut: float = 0.5) -> DataFrame:
    m = tracks.select(mood_of(_af("valence"), _af("energy"), cut).alias("mood"))
    return m.groupBy("mood").agg(F.count(F.lit(1)).alias("track_count")).orderBy("mood")


def danceable_genres(tracks: DataFrame, min_tracks: int = 100) -> DataFrame:
    g = tracks.groupBy("track_genre").agg(
        F.count(F.lit(1)).alias("track_count"),
        F.avg(_af("danceability")).alias("avg_danceability"),
        F.avg(_af("energy")).alias("avg_energy"),
        F.avg(_af("valence")).alias("avg_valence"))
    out = g.where(F.col("track_count") >= min_tracks).select(
        F.col("track_genre").alias("genre"), "track_count",
        round_half_even("avg_danceability", 3).alias("avg_danceability"),
        round_half_even("avg_energy", 3).alias("avg_energy"),
        round_half_even("avg_valence", 3).alias("avg_valence"))
    return out.orderBy(F.desc("avg_danceability"), F.desc("avg_energy"), F.desc("avg_valence"),
                       F.desc("track_count"), F.asc("genre"))


def collection_count(df: DataFrame, name: str = "documents") -> DataFrame:
    """Whole-collection count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), "n")
