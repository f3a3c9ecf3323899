"""DuckDB SQL for the queries that SQL can express; written from the definitions, by other means than the operators."""

WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH words AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
"""


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s AS "start", s + len(m) AS "end" FROM (
    SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest(list_transform(range(1, len(ms) + 1), lambda i:
      coalesce(list_sum(list_transform(ps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0))) AS s
    FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {group}) AS vs,
                 regexp_split_to_array(t, '{p}') AS ps FROM texts WHERE regexp_matches(t, '{p}'))
  ) WHERE len(v) >= {least}"""


_ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_BASE = " UNION ALL ".join([_spans("assign", 0, _ASSIGN, 1, 8), _spans("access", 1, "AKIA[A-Z0-9]+", 0, 16), _spans("hex", 2, "[0-9a-f]+", 0, 32)])
_EXTRA = " UNION ALL ".join([
    _spans("pem", 3, "-----BEGIN (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----", 0, 1), _spans("forge", 4, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    _spans("jwt", 5, "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1)])

OP6 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_BASE} UNION ALL {_EXTRA}),
named AS (SELECT *, kind || ':' || CAST("start" AS BIGINT) || ':' || CAST("end" AS BIGINT) AS label FROM spans)
SELECT d.doc_id, count(s.doc_id) FILTER (s.rank = 0) AS n_assign, count(s.doc_id) FILTER (s.rank = 1) AS n_access,
       count(s.doc_id) FILTER (s.rank = 2) AS n_hex,
       sha256(coalesce(string_agg(s.label, ',' ORDER BY s."start", s.rank) FILTER (s.rank < 3), '')) AS base_sha256,
       coalesce(string_agg(s.label, ',' ORDER BY s."start", s.rank), '') AS spans
FROM documents d LEFT JOIN named s USING (doc_id) GROUP BY d.doc_id
"""

OP7 = f"""
WITH cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM cut
), sets AS (
  SELECT doc_id, i, list_sort(list_distinct({WORDS.replace("coalesce(text, '')", LOWER.format("line"))})) AS w FROM lines
), judged AS (
  SELECT row_number() OVER (ORDER BY doc_id, i) AS p, doc_id, i, w FROM sets WHERE len(w) >= 1
), firsts AS (
  SELECT w, min(p) AS p FROM judged GROUP BY w
), tokens AS (
  SELECT p, len(w) AS n, unnest(w) AS t FROM firsts
), ranked AS (
  SELECT p, n, t, row_number() OVER (PARTITION BY p ORDER BY df, t) AS r
  FROM tokens JOIN (SELECT t, count(*) AS df FROM tokens GROUP BY t) USING (t)
), prefix AS (
  SELECT p, n, t FROM ranked WHERE r <= n - ceil(0.8 * n) + 1
), pairs AS (
  SELECT DISTINCT a.p AS a, b.p AS b FROM prefix a JOIN prefix b ON a.t = b.t AND a.p < b.p AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), near AS (
  SELECT a, b FROM (SELECT a, b, len(x.w) + len(y.w) AS n, len(list_intersect(x.w, y.w)) AS s
                    FROM pairs JOIN firsts x ON x.p = a JOIN firsts y ON y.p = b) WHERE 100 * s >= 80 * (n - s)
), bound AS (
  SELECT f.w, least(f.p, coalesce(m.p, f.p)) AS p
  FROM firsts f LEFT JOIN (SELECT x, min(y) AS p FROM (SELECT a AS x, b AS y FROM near UNION ALL SELECT b, a FROM near) GROUP BY x) m ON m.x = f.p
), gone AS (
  SELECT j.doc_id, j.i FROM judged j JOIN bound b ON j.w = b.w WHERE b.p < j.p
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT c.doc_id, CAST(coalesce(len(c.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(c.ls), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k USING (doc_id)
"""

def _jaccard_sql(k: int, percent: int) -> str:
    """Components of documents whose sets of k-word shingles have this similarity."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER.format("coalesce(text, '')"))} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < {k} THEN array_to_string(w, ' ') ELSE array_to_string(w[s:s + {k - 1}], ' ') END AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS s FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s >= {percent} * (x.n + y.n - s)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)"""


OP9 = f"""{_jaccard_sql(3, 90)}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

OP13 = f"""{_jaccard_sql(4, 80)}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id, d.doc_id = coalesce(c.m, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

_MARKS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ{}', 'abcdefghijklmnopqrstuvwxyz{}')".format(_MARKS.replace("'", "''"), " " * len(_MARKS))


def _five(key: str, source: str) -> str:
    words = WORDS.replace("coalesce(text, '')", _NORMAL)
    return f"""SELECT DISTINCT {key}, array_to_string(w[s:s + 4], ' ') AS x
  FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS s FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) >= 5)"""


OP10 = f"""
WITH items AS ({_five("item_id", "benchmark")}),
docs AS ({_five("doc_id", "documents")}),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS s FROM docs JOIN items USING (x) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item, s AS n_shared, CAST(s AS DOUBLE) / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * s >= 80 * n
"""



def _round(r: int) -> str:
    mean = ", ".join(f"CAST(floor(CAST(sum(v[{d}]) AS DOUBLE) / count(*)) AS BIGINT)" for d in range(1, 5))
    return f"""{_assigned(r)}, book{r + 1} AS (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v
  FROM book{r} b LEFT JOIN (SELECT p, e, [{mean}] AS v FROM near{r} JOIN parts USING (vec_id, p) GROUP BY p, e) m USING (p, e)
)"""


def _assigned(r: int) -> str:
    distance = " + ".join(f"(x.v[{d}] - b.v[{d}]) * (x.v[{d}] - b.v[{d}])" for d in range(1, 5))
    return f"""near{r} AS (
  SELECT vec_id, p, best % 64 AS e, best // 64 AS d
  FROM (SELECT x.vec_id, x.p, min(({distance}) * 64 + b.e) AS best FROM parts x JOIN book{r} b ON x.p = b.p GROUP BY ALL)
)"""


OP11 = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT vec_id, p, q[4 * p + 1:4 * p + 4] AS v FROM kept, (SELECT unnest(range(16)) AS p)
), book0 AS (
  SELECT p, e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) WHERE e < 64
), {_round(0)}, {_round(1)}, {_assigned(2)}, coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 JOIN kept USING (vec_id) GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""

ORACLE = {
    "op3_substring_dedup": OP3, "op6_secret_scan": OP6, "op7_line_dedup": OP7, "op9_jaccard_join": OP9, "op10_decontamination": OP10,
    "op11_vector_codes": OP11, "op13_near_dedup": OP13,
}
