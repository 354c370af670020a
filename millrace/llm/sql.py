"""The contracts that SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM starts),
docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, i, n FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM places)
    JOIN windows USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS win
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS k FROM windows JOIN firsts USING (win) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)"""

SUFFIXES = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (SELECT doc_id, i, hash(substr(h, 2 * i - 1, 100)) AS a, md5_number_lower(substr(h, 2 * i - 1, 100)) AS b
    FROM (SELECT doc_id, h, unnest(generate_series(1, n - 49)) AS i FROM docs WHERE n >= 50)),
firsts AS (SELECT a, b, min(doc_id) AS first, max(doc_id) AS last FROM windows GROUP BY a, b HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS k FROM windows JOIN firsts USING (a, b) WHERE doc_id > first),
spans AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (k <> before + 1 OR before IS NULL) AS n_spans
    FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, substr(h, 2 * k - 1, 2) AS x, k FROM (SELECT doc_id, h, unnest(generate_series(1, n)) AS k FROM docs JOIN spans USING (doc_id))),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY k) AS h FROM bytes ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN n_removed IS NULL THEN docs.h ELSE coalesce(kept.h, '') END)) AS kept_sha256
FROM docs LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _kind(rank: int, name: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS kind, '{name}' AS name, "end" - size AS start, "end" FROM (
    SELECT doc_id, k, size, part, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY k) AS "end" FROM (
    SELECT doc_id, k, length(gaps[k]) AS gap, length(wholes[k]) AS size, length(parts[k]) AS part FROM (
    SELECT *, unnest(generate_series(1, len(wholes))) AS k FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps,
    regexp_extract_all(text, '{pattern}') AS wholes, regexp_extract_all(text, '{pattern}', {group}) AS parts FROM docs)))) WHERE part >= {least}"""


def secrets_sql(rules) -> str:
    """For rules in their order, of which the first three are the base."""
    spans = " UNION ALL ".join(_kind(k, r.name, r.pattern, r.group, r.least) for k, r in enumerate(rules))
    item = "name || ':' || start || ':' || \"end\""
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{r.name}" for k, r in enumerate(rules[:3]))
    shown = ", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in rules[:3])
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), spans AS ({spans}),
    found AS (SELECT doc_id, {counts}, string_agg({item}, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg({item}, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY doc_id)
    SELECT doc_id, {shown}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN found USING (doc_id)"""


LINES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT r, k, lines[k] AS line, translate(trim(lines[k], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM (SELECT r, lines, unnest(generate_series(1, len(lines))) AS k FROM docs)),
found AS (SELECT key FROM each WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY k) AS text FROM each ANTI JOIN found USING (key) GROUP BY r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

RESAMPLING = f"""
WITH crcs AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
    FROM (SELECT CAST(unnest(range(256)) AS UBIGINT) AS n)),
docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
source AS (SELECT doc_id, unnest(w) AS word FROM docs),
target AS (SELECT unnest({_ITEM_WORDS}) AS word FROM benchmark),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM source UNION SELECT word FROM target)),
buckets AS (SELECT word, CAST(xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)],
    list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS UBIGINT))),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INT) + 1])), 4294967295) % 10000 AS INT) AS bucket FROM hexed, crcs),
s AS (SELECT bucket, count(*) AS s FROM source JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT sum(s) FROM s)::DOUBLE + 10000)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * (coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
weights AS (SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM source JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT)::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""


def _round(k: int) -> str:
    """Nearest centroid of c{k}, then the floors of the means as c{k + 1}."""
    return f"""n{k} AS (SELECT vec_id, v, number AS cluster, d FROM (SELECT vec_id, v, number, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d,
    row_number() OVER (PARTITION BY vec_id ORDER BY d, number) AS place FROM vectors, c{k}) WHERE place = 1),
m{k} AS (SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS total, count(*) AS n
    FROM n{k}, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY cluster, i) GROUP BY cluster),
c{k + 1} AS (SELECT number, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} ON number = cluster)"""


CLUSTERING = f"""
WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS number, v AS c FROM vectors QUALIFY number < 16),
{_round(0)}, {_round(1)}, {_round(2)}, {_round(3)},
sums AS (SELECT cluster, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM n3 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia, CAST((SELECT sum(d) FROM n3) AS BIGINT) AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256 FROM n3 JOIN sums USING (cluster) JOIN c3 ON number = cluster"""
