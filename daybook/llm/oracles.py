"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents)
, w AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM d))
, later AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) > 1)
, gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later)
, each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d)
, kept AS (
  SELECT e.doc_id, count(*) AS n_words, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY e.p) FILTER (g.p IS NULL) AS text
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

MIX = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size, md5(coalesce(text, '')) AS tie,
         ('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS key
  FROM documents)
, s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source)
, level AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(2 * source_size) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS used
  FROM s WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
, full_ AS (
  SELECT *, 2 * source_size * 2 * (weights - used) <= weight * (3 * total - 2 * caps) AS is_full FROM level)
, open_ AS (
  SELECT max(3 * total) - 2 * coalesce(sum(2 * source_size) FILTER (is_full), 0) AS up,
         2 * sum(weight) FILTER (NOT is_full) AS down FROM full_)
, t AS (
  SELECT source, source_size, CASE WHEN total = 0 THEN 0.0::DOUBLE
           ELSE least((2 * source_size)::DOUBLE, (weight * up)::DOUBLE / down::DOUBLE) END AS target
  FROM full_, open_)
, cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS passes,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) % source_size ELSE 0 END AS rest FROM t)
, run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, tie ROWS UNBOUNDED PRECEDING) - size AS before FROM d)
SELECT run.doc_id, run.size, cut.source_size, cut.target,
       CAST(passes * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM run JOIN cut ON cut.source IS NOT DISTINCT FROM run.source"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
, link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93)
, reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE x = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(y) FROM reach WHERE x = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce((SELECT min(y) FROM reach WHERE x = e.vec_id), e.vec_id)) AS kept
FROM embeddings e"""

LINES = """
WITH each AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
, keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each)
, often AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT k.*, o.key IS NOT NULL AND o.top <> k.doc_id AS gone FROM keyed k LEFT JOIN often o ON o.key = k.key)
GROUP BY doc_id"""


RUNS = f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS words,
         xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))),
           4294967295)) AS h
  FROM documents)
, g AS (SELECT *, len(words) AS n, h // 10 AS g FROM d)
, a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g)
, p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a)
, w AS (
  SELECT doc_id, n, i, CASE WHEN i < a OR a IS NULL THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END AS word
  FROM (SELECT *, unnest(range(0, n)) AS i FROM p))
, same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n)
, stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island)
, run AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length)
, text AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM run GROUP BY doc_id)
, top AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1)
, gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run)
, kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS kept FROM w ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN text ON text.doc_id = d.doc_id LEFT JOIN top ON top.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
, s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0)
, pos AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
, neg AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank
  FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT * FROM neg WHERE rank <= 10"""


def all_oracles() -> dict[str, str]:
    return {"op2_substrings": SUBSTRINGS, "op6_mix": MIX, "op9_pivots": VECTORS, "op10_lines": LINES,
            "op11_runs": RUNS, "op13_negatives": NEGATIVES}
