"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from lexispark.llm.quality_rules import STOP_WORDS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP9 = rf"""
WITH rows AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM rows),
keyed AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM cut),
common AS (SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
flagged AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id <> c.last_doc, false) AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_RULE = """NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 14 * n_words AND 100 * n_symbols <= 6 * word_chars
       AND 100 * n_stop_words >= 4 * n_words AND 100 * n_dup_lines <= 30 * n_lines AND 100 * n_loud_words <= 30 * n_words"""

OP1 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(0, 8) r(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(words, lambda x: ends_with(x, '!!'))) AS BIGINT) AS n_loud_words
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, {_RULE} AS kept FROM b
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
item AS (SELECT item_id, words, least(len(words), 10) AS width FROM b WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, width, array_to_string(words[i:i + width - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS i FROM item)),
widths AS (SELECT DISTINCT width FROM item),
cut AS (SELECT doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') AS win
        FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM d, widths WHERE len(words) >= width)),
hit AS (SELECT doc_id, item_id, width, i FROM cut JOIN win USING (width, win)),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, range(0, 10) r(k) WHERE k < width GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id),
tok AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
df AS (SELECT word, count(*) AS df FROM tok GROUP BY word),
one AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT item_id, words, width FROM item)),
place AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS place FROM one),
start AS (SELECT k, item_id, width, unnest(range(len(words) - width + 1)) AS start FROM one),
rated AS (SELECT s.k, item_id, start, place, word, coalesce(df, 0) AS df FROM start s JOIN place p ON s.k = p.k AND place >= start AND place < start + width LEFT JOIN df USING (word)),
two AS (SELECT *, row_number() OVER (PARTITION BY k, start ORDER BY df, place) AS rank FROM rated QUALIFY rank <= 2),
pair AS (SELECT DISTINCT a.item_id, a.word AS w1, b.word AS w2, b.place - a.place AS gap FROM two a JOIN two b USING (k, start) WHERE a.rank = 1 AND b.rank = 2 AND a.df > 0),
near AS (SELECT x.doc_id, count(DISTINCT item_id) AS n_near FROM pair JOIN tok x ON x.word = w1 JOIN tok y ON y.word = w2 AND y.doc_id = x.doc_id WHERE abs(y.pos - x.pos - gap) <= 3 GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN near USING (doc_id)
"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _clusters(rounds: int) -> str:
    """The rounds one after the other: ``a`` assigns each vector, ``c`` moves the centroids, floors of sums that may be negative."""
    step = """a{i} AS MATERIALIZED (SELECT row, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT row, c.k, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS d FROM v, c{i} c) GROUP BY row)"""
    move = """m{i} AS MATERIALIZED (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS v FROM (SELECT k, p, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS p FROM a{i} JOIN v USING (row)) GROUP BY k, p) GROUP BY k),
c{j} AS MATERIALIZED (SELECT k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k))"""
    parts = [step.format(i=0)]
    for i in range(rounds):
        parts += [move.format(i=i, j=i + 1), step.format(i=i + 1)]
    return ",\n".join(parts)


OP11 = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM v QUALIFY k < 8),
{_clusters(10)},
t AS (SELECT k, sum(d) AS cluster_inertia, (SELECT sum(d) FROM a10) AS inertia FROM a10 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia, CAST(inertia AS BIGINT) AS inertia,
       sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN v USING (row) JOIN t USING (k) JOIN c10 USING (k)
"""

OP12 = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 5
"""

OP13 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
u AS (SELECT lang, id, unnest(w) AS x, unnest(range(len(w))) AS i FROM w),
n AS (SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM u WINDOW p AS (PARTITION BY id ORDER BY i)),
g AS (SELECT lang, 1 AS size, x AS phrase FROM n UNION ALL SELECT lang, 2, x || ' ' || y FROM n WHERE y IS NOT NULL UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM n WHERE z IS NOT NULL),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
h AS MATERIALIZED (SELECT k.*, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail FROM k),
hl AS MATERIALIZED (SELECT h.*, f.f AS l FROM h JOIN f ON f.lang = h.lang AND f.phrase = h.head),
s AS (SELECT hl.*, f.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f.f) AS score FROM hl JOIN f ON f.lang = hl.lang AND f.phrase = hl.tail),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE size = 3) GROUP BY ALL),
d AS (SELECT m.* FROM m LEFT JOIN i USING (lang, phrase) WHERE coalesce(100 * i.a < 50 * m.a, true)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_quality_rules": OP1,
    "op5_decontamination": OP5,
    "op9_line_dedup": OP9,
    "op11_centroid_clustering": OP11,
    "op12_topk_search": OP12,
    "op13_collocations": OP13,
}
