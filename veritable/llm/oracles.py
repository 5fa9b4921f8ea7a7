"""DuckDB SQL for the operators whose whole result SQL can express, by the plainest way there is."""

from __future__ import annotations

from veritable.llm.words import BREAKS, LOWER, UPPER


def _words(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            f"'{BREAKS}'), lambda w: w <> '')")


# Every run of words of a document that is as long as some window is compared with all windows.
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS words FROM documents),
b AS (SELECT item_id, {_words('text')} AS words FROM benchmark),
starts AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
  FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, list_slice(words, i, i + 9) AS run FROM starts),
widths AS (SELECT DISTINCT len(run) AS k FROM windows),
places AS (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, widths),
runs AS (SELECT doc_id, i, k, list_slice(words, i, i + k - 1) AS run FROM places),
hits AS (SELECT doc_id, i, k, item_id FROM runs JOIN windows USING (run)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) h GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) h GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(
    list_zip(q.z, c.z), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

#: Five hex digits are twenty bits, which are four letters.
_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"(CAST('0x' || substr(digest, {1 + 5 * group}, 5) AS INTEGER) >> {shift}) % 32 + 1, 1)"
    for group in range(8) for shift in (15, 10, 5, 0))
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS digest,
    max(page_id) OVER (PARTITION BY payload) AS kept FROM p)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM d"""


# --- CRC-32, a byte at a time, from a table that its polynomial makes ------------------

_TABLE = """
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1
    THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)) b) r)"""


def _crc(code_bytes: str) -> str:
    """Over a list of bytes; ``t`` is the table."""
    return (f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {code_bytes}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


_SPACED = (r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')")
_ID_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"

# Every period of every document: stretches in which words so far apart are equal.
PERIODIC_RUNS = f"""
WITH {_TABLE},
plain AS (SELECT doc_id, {_SPACED.format(text="coalesce(text, '')")} AS w,
  {_crc(_ID_BYTES)} AS h FROM documents, crc_table),
sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM plain),
planted AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized WHERE h % 10 = 0 AND n > 0),
d AS (SELECT doc_id, w, n FROM sized WHERE h % 10 <> 0 OR n = 0
  UNION ALL SELECT doc_id, list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1]
    ELSE w[a + (i - a) % p + 1] END), n FROM planted),
periods AS (SELECT doc_id, w, n, unnest(range(1, n // 4 + 1)) AS q FROM d),
places AS (SELECT doc_id, w, q, unnest(range(1, n - q + 1)) AS j FROM periods),
same AS (SELECT doc_id, q, j FROM places WHERE w[j] = w[j + q]),
stretches AS (SELECT doc_id, q, min(j) - 1 AS start, count(*) + q AS length FROM (
  SELECT *, j - row_number() OVER (PARTITION BY doc_id, q ORDER BY j) AS island FROM same) s
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
  ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id
  ORDER BY length / period DESC, start, period) = 1),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period + 1, start + length + 1)) AS i FROM runs),
gone AS (SELECT doc_id, list(i) AS i FROM dropped GROUP BY doc_id),
kept AS (SELECT d.doc_id, array_to_string(list_transform(list_filter(range(1, n + 1),
  lambda k: NOT list_contains(coalesce(gone.i, []), k)), lambda k: w[k]), ' ') AS words
  FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
  1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(words) AS collapsed_sha256
FROM kept LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id)"""

# All pairs of documents that share a shingle; then whatever links reach.
JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format(
    text=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x FROM d),
e AS (SELECT doc_id, len(x) AS n, unnest(x) AS x FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (SELECT doc_id, doc_id AS least FROM s
  UNION SELECT b, least FROM reached JOIN links ON doc_id = a)
SELECT s.doc_id, CAST(len(x) AS BIGINT) AS n_shingles, min(least) AS component_id
FROM s JOIN reached USING (doc_id) GROUP BY s.doc_id, x"""

_RUN_BYTES = ("list_transform(range(1, 2 * strlen(key), 2), lambda i: "
              "CAST('0x' || substr(hex(encode(key)), i, 2) AS BIGINT))")
# Words that agree without one letter at the same place, and words that others become without one.
VARIANTS = f"""
WITH RECURSIVE {_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
lowered AS (SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run FROM runs),
each AS (SELECT run, CAST(doc_id AS VARCHAR) || ':' || run AS key, count(*) AS c
  FROM lowered WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, c, {_crc(_RUN_BYTES)} AS h FROM each, crc_table),
spoilt AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) ||
  substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 6
  GROUP BY word HAVING sum(c) >= 5),
without AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v) u),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM without a JOIN without b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM without a JOIN v ON a.rest = v.word
  UNION SELECT v.word, a.word, a.n FROM without a JOIN v ON a.rest = v.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m
  FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN other END AS form,
  CASE WHEN m >= 5 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
path AS (SELECT word, word AS at FROM formed
  UNION SELECT path.word, form FROM path JOIN formed ON formed.word = path.at WHERE form IS NOT NULL),
ends AS (SELECT path.word, path.at AS root FROM path JOIN formed ON formed.word = path.at WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""
