"""The test views of ``triad.sources.testviews`` stated in SQL, for the oracles.

``with_views(body, "tracks", ...)`` puts the needed views (and the views they
read) in front of an oracle query as CTEs. The driver tables are views already.
"""

from __future__ import annotations

# name -> (sql body, names of views it reads); listed in dependency order.
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = (sql.strip(), deps)


_view("tracks_raw", """
SELECT l.l_orderkey * 10 + l.l_linenumber AS track_id,
       p.p_name AS track_name,
       p.p_brand AS album_name,
       'S' || CAST(l.l_suppkey AS VARCHAR) || '; ' || p.p_brand || ' ;' AS artists,
       p.p_type AS track_genre,
       l.l_returnflag = 'R' AS explicit,
       CAST(floor(l.l_suppkey % 61 + l.l_quantity * 0.8) AS INTEGER) AS popularity,
       CAST(floor(l.l_extendedprice * 5.0) AS INTEGER) AS duration_ms,
       l.l_discount * 10.0 AS danceability,
       1.0 - l.l_tax * 10.0 AS energy,
       -0.6 * CAST(p.p_size AS DOUBLE) AS loudness,
       l.l_tax AS speechiness,
       l.l_discount AS acousticness,
       l.l_discount * 10.0 AS instrumentalness,
       l.l_tax AS liveness,
       CAST(p.p_size AS DOUBLE) / 50.0 AS valence,
       l.l_extendedprice * l.l_extendedprice / 5e7 AS tempo,
       CAST(l.l_linenumber AS INTEGER) AS "key",
       CAST(l.l_linenumber % 2 AS INTEGER) AS "mode",
       4 AS time_signature
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""")

# Nested track documents, kept flat here: struct fields are plain columns
# (``audio_features.x`` in Spark is ``x`` in these oracles).
_view("tracks", """
SELECT track_id, track_name, album_name, explicit, popularity, duration_ms, track_genre,
       list_filter(list_transform(string_split(coalesce(artists, ''), ';'), lambda a: trim(a)), lambda a: a <> '') AS artists,
       danceability, energy, loudness, speechiness, acousticness, instrumentalness, liveness,
       valence, tempo, "key", "mode", time_signature,
       round_even(CAST(duration_ms AS DOUBLE) / 1000.0, 1) AS duration_sec,
       CASE WHEN popularity >= 70 THEN 'high'
            WHEN popularity >= 40 AND popularity < 70 THEN 'medium'
            ELSE 'low' END AS popularity_tier
FROM tracks_raw
""", ("tracks_raw",))

_view("movies", """
SELECT p_partkey AS movie_id, p_name AS title, p_type || '|' || replace(p_name, ' ', '|') AS genres
FROM part
""")

_view("users", """
SELECT c_custkey AS user_id, c_mktsegment AS gender, CAST(c_nationkey AS INTEGER) AS age,
       CAST(c_custkey % 21 AS INTEGER) AS occupation
FROM customer
""")

_view("ratings_raw", """
SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id,
       CAST(least(5.0, 1.0 + floor((l.l_quantity - 1) / 10)) AS INTEGER) AS rating,
       CAST(epoch(l.l_shipdate) AS BIGINT) AS "timestamp",
       l.l_shipdate, l.l_orderkey, l.l_linenumber
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

_view("ratings", """
SELECT user_id, movie_id, rating, "timestamp" FROM ratings_raw
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id
                           ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1
""", ("ratings_raw",))

_view("genres_of", """
SELECT DISTINCT movie_id, trim(g) AS genre
FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS g FROM movies WHERE genres IS NOT NULL)
""", ("movies",))

_view("papers", """
SELECT doc_id AS id,
       array_to_string(list_slice(CASE WHEN trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN []
                                       ELSE regexp_split_to_array(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s+') END, 1, 8), ' ') AS title,
       text AS abstract,
       source AS authors,
       CAST(2010 + doc_id % 15 AS INTEGER) AS "year",
       lang AS category
FROM documents
""")

_view("vectors", """
SELECT vec_id AS id, embedding AS "values", label AS category FROM embeddings
""")

_view("search_queries", """
SELECT d.doc_id AS query_id,
       array_to_string(list_slice(regexp_split_to_array(trim(d.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s+'), 1, 5), ' ') AS query_text,
       e.embedding AS query_vec
FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id
WHERE d.doc_id IN (1, 7, 42)
""")


def _closure(names) -> list[str]:
    need: set[str] = set()

    def visit(n):
        if n in need:
            return
        for d in VIEWS[n][1]:
            visit(d)
        need.add(n)

    for n in names:
        visit(n)
    return [n for n in VIEWS if n in need]


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <views>, <extra ctes> <body>``."""
    ctes = [f"{n} AS (\n{VIEWS[n][0]}\n)" for n in _closure(names)]
    ctes += [f"{n} AS (\n{sql.strip()}\n)" for n, sql in (extra or [])]
    body = body.strip()
    if not ctes:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":  # the body's own CTEs follow the views
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
