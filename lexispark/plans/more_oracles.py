"""DuckDB SQL for the further queries."""

from __future__ import annotations

from lexispark.functions import values as V
from lexispark.operators.generation import NEEDLES, NOT_FOUND, PARAPHRASES, UNKNOWABLE
from lexispark.plans.more_queries import PLANTED
from lexispark.plans.oracles import BASE, FACTS, JUDGED, LINES, TEMPLATE, listed, normalised, quoted, strip, truncated
from lexispark.sources.corpus import SAMPLES


def planted(sql: str) -> str:
    said = "[" + ", ".join(quoted(p) for p in PLANTED) + "][doc_id % 5 + 1]"
    return sql.replace("FROM documents)", f"FROM (SELECT * REPLACE ({said} || chr(10) || coalesce(text, '') AS text) FROM documents))")


LISTS = ("numbers", "money", "dates", "emails", "phones", "urls", "terms")
_DIGESTS = ", ".join(f"md5(array_to_string({c}, '|')) AS {c}" for c in LISTS)
_FACTUAL = " + ".join(f"len({c})" for c in LISTS[:-1])

_NOUNS = r"""tok AS (SELECT doc_id, unnest(x) AS w, unnest(range(len(x))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS x FROM s)),
flag AS (SELECT *, regexp_matches(w, '^[A-ZÀ-ɏ][a-zÀ-ɏ]{2,}$') AS noun, regexp_matches(w, '^\s+$') AS gap FROM tok),
begun AS (SELECT *, noun AND NOT coalesce(lag(gap) OVER o AND lag(noun, 2) OVER o, false) AS first FROM flag WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT *, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r, last_value(CASE WHEN NOT noun AND NOT gap THEN i END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS broken FROM begun),
inside AS (SELECT *, min(i) FILTER (first) OVER (PARTITION BY doc_id, r) AS start, max(i) FILTER (noun) OVER (PARTITION BY doc_id, r) AS stop FROM run WHERE r > 0),
phrase AS (SELECT doc_id, r, string_agg(w, '' ORDER BY i) AS p FROM inside WHERE i BETWEEN start AND stop GROUP BY ALL),
kept AS (SELECT DISTINCT doc_id, p FROM phrase WHERE length(p) > 3)"""

_LINES_OF = "src AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), ln0 AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS x FROM src)"

_PAGED = rf"""{_LINES_OF},
ln AS (SELECT doc_id, i, i // 4 + 1 AS page_no, CASE WHEN doc_id % 3 = 0 AND i % 4 = 0 THEN (i // 4 + 1) || '. Chapter ' || left(x, 20) WHEN doc_id % 3 = 0 AND i % 4 = 2 THEN (i // 4 + 1) || '.1 Part ' || left(x, 20)
       WHEN doc_id % 3 = 1 AND i % 8 = 0 THEN 'Heading of this Page' ELSE x END AS line FROM ln0),
placed AS (SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - length(line) - 1 AS b FROM ln),
doc AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS raw FROM placed GROUP BY doc_id),
pend AS (SELECT doc_id, page_no, max(b + length(line) + 1) AS e FROM placed GROUP BY ALL),
lev AS (SELECT *, CASE WHEN regexp_matches(line, {quoted(V.CHAPTER)}) THEN 0 WHEN regexp_matches(line, {quoted(V.SUBSECTION)}) THEN 1 END AS nl FROM placed),
mode AS (SELECT *, max(nl IS NOT NULL) OVER (PARTITION BY doc_id) AS numbered FROM lev),
head AS (SELECT *, CASE WHEN numbered THEN nl WHEN regexp_matches(line, {quoted(V.TITLE_LINE)}) AND len(regexp_extract_all(line, '\S+')) >= 2 THEN 0 END AS level FROM mode),
nxt AS (SELECT *, lead(b) OVER (PARTITION BY doc_id ORDER BY b) AS next FROM head WHERE level IS NOT NULL),
body AS (SELECT n.*, raw, {strip("substring(raw, b + length(line) + 1, coalesce(next, length(raw)) - b - length(line))")} AS content FROM nxt n JOIN doc USING (doc_id)),
par AS (SELECT *, CASE WHEN level = 1 THEN last_value(CASE WHEN level = 0 THEN b END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY b) END AS parent_b FROM body WHERE length(content) >= 20 OR next IS NULL),
sec AS (SELECT doc_id, b AS pos, line, content, b AS char_start, coalesce(next, length(raw)) AS char_end, CASE WHEN parent_b IS NULL THEN 0 ELSE level END AS level, parent_b FROM par),
paged AS (SELECT s.*, least((SELECT count(*) FROM pend p WHERE p.doc_id = s.doc_id AND p.e <= char_start) + 1, (SELECT count(*) FROM pend p WHERE p.doc_id = s.doc_id)) AS page_start,
          least((SELECT count(*) FROM pend p WHERE p.doc_id = s.doc_id AND p.e <= char_end - 1) + 1, (SELECT count(*) FROM pend p WHERE p.doc_id = s.doc_id)) AS page_end FROM sec s),
enough AS (SELECT doc_id FROM sec WHERE level = 0 GROUP BY doc_id HAVING count(*) >= 2),
pg AS (SELECT doc_id, page_no, list_filter(list_transform(list(line ORDER BY i), lambda x: {strip('x')}), lambda x: x <> '') AS f, {strip("string_agg(line, chr(10) ORDER BY i)")} AS body FROM ln WHERE doc_id NOT IN (SELECT doc_id FROM enough) GROUP BY ALL HAVING length({strip("string_agg(line, chr(10) ORDER BY i)")}) >= 30),
every AS (SELECT doc_id, pos, line, content, char_start, char_end, level, parent_b, page_start, page_end FROM paged WHERE doc_id IN (SELECT doc_id FROM enough)
          UNION ALL SELECT doc_id, page_no, f[1], array_to_string(f[2:], chr(10)), NULL, NULL, 0, NULL, page_no, page_no FROM pg),
num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS sec_ord, {strip(r"regexp_replace(regexp_replace(line, '^\s*\d+\s*\n', ''), '\s{2,}', ' ', 'g')")} AS heading FROM every),
done AS (SELECT *, CASE WHEN parent_b IS NOT NULL THEN last_value(CASE WHEN level = 0 THEN sec_ord END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) END AS parent_sec_ord FROM num)"""

_DRAW = "CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 7) AS BIGINT)"


def chosen(texts) -> str:
    return f"[{listed(texts)}][{_DRAW} % {len(texts)} + 1]"


_MEASURES = {"avg_seconds": "avg", "min_seconds": "min", "max_seconds": "max", "total_seconds": "sum"}

MORE_ORACLES = {
    "planted_facts": f"WITH {planted(FACTS)} SELECT doc_id, {_DIGESTS}, entity_count, {_FACTUAL} > 0 AS has_factual_content FROM f",
    "planted_tags": f"WITH {planted(FACTS)} SELECT doc_id, has_list, has_dates, has_numbers, has_contact, has_definition, has_table FROM f",
    "planted_lists_topk": f"""WITH {planted(FACTS)}, e AS (SELECT * FROM f WHERE n_words >= 15 AND has_list),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_words DESC, doc_id) AS own, (SELECT count(DISTINCT source) FROM e) AS n FROM e)
SELECT row_number() OVER (ORDER BY own > greatest(1, ceil(25 / n)), n_words DESC, source, doc_id) AS rank, source, doc_id, n_words, length({truncated('t', V.LIST_PASSAGE)}) AS passage_len FROM l ORDER BY rank LIMIT 25""",
    "key_noun_phrases": f"WITH {BASE}, {_NOUNS} SELECT s.doc_id, count(p) AS n_nouns, md5(coalesce(string_agg(p, '|' ORDER BY p), '')) AS nouns FROM s LEFT JOIN kept USING (doc_id) GROUP BY s.doc_id",
    "markdown_parse": rf"""WITH {_LINES_OF},
ln AS (SELECT doc_id, i, CASE WHEN doc_id % 2 = 0 AND i % 8 = 4 THEN '# ' || chr(10) || x WHEN doc_id % 2 = 0 AND i % 4 = 0 THEN '# ' || x WHEN doc_id % 2 = 0 AND i % 4 = 2 THEN '## ' || x ELSE x END AS line FROM ln0),
placed AS (SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - length(line) - 1 AS b, regexp_matches(line, {quoted(V.MARKDOWN_HEADING)}) AS h FROM ln),
sec AS (SELECT *, count_if(h) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM placed),
md0 AS (SELECT doc_id, n, min(i) AS pos, min_by(line, i) AS head, min(b) AS char_start, max(b + length(line)) AS stop, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT h), '') AS body FROM sec WHERE n > 0 GROUP BY ALL),
md AS (SELECT *, coalesce(lead(char_start) OVER (PARTITION BY doc_id ORDER BY n), stop) AS char_end FROM md0),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM ln GROUP BY doc_id HAVING doc_id NOT IN (SELECT doc_id FROM md)),
p AS (SELECT doc_id, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM (SELECT doc_id, regexp_split_to_array(text, '\n\s*\n') AS parts FROM t)),
q AS (SELECT doc_id, pos, {strip('raw')} AS part FROM p),
o AS (SELECT *, CAST(coalesce(sum(length(part) + 2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cs FROM q),
a AS (SELECT doc_id, pos, {strip(f"regexp_extract(head, {quoted(V.MARKDOWN_HEADING)}, 2)")} AS heading, length(regexp_extract(head, {quoted(V.MARKDOWN_HEADING)}, 1)) - 1 AS level, {strip('body')} AS content, char_start, char_end FROM md
      UNION ALL SELECT doc_id, pos, left({strip("split_part(part, chr(10), 1)")}, 80), 0, {strip("CASE WHEN contains(part, chr(10)) THEN substring(part, instr(part, chr(10)) + 1) ELSE part END")}, cs, cs + length(part) FROM o WHERE length(part) >= 20)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS sec_ord, heading, level, md5(content) AS content, char_start, char_end FROM a""",
    "paged_parse": f"WITH {_PAGED} SELECT doc_id, sec_ord, parent_sec_ord, level, char_start, char_end, page_start, page_end, heading, md5(content) AS content FROM done",
    "section_all_text": f"""WITH {_PAGED}, full_ AS (SELECT doc_id, sec_ord, coalesce(parent_sec_ord, sec_ord) AS top, CASE WHEN length(heading) > 0 THEN heading || chr(10) || content ELSE content END AS t FROM done)
SELECT doc_id, top AS sec_ord, md5(string_agg(t, chr(10) || chr(10) ORDER BY sec_ord)) AS all_text FROM full_ GROUP BY doc_id, top""",
    "text_slices": "SELECT doc_id, substring(coalesce(text, ''), 11, 50) AS slice FROM documents",
    "truncate_sentence": f"""WITH {BASE} SELECT doc_id, md5(CASE WHEN length(t) <= {V.LIST_PASSAGE} THEN t WHEN instr(reverse(left(t, {V.LIST_PASSAGE})), '.') > 0 AND {V.LIST_PASSAGE} - instr(reverse(left(t, {V.LIST_PASSAGE})), '.') > {V.LIST_PASSAGE // 2}
        THEN left(t, {V.LIST_PASSAGE} - instr(reverse(left(t, {V.LIST_PASSAGE})), '.') + 1) ELSE left(t, {V.LIST_PASSAGE}) END) AS digest FROM s""",
    "names_and_titles": f"WITH {BASE} SELECT doc_id, lower(source) || '.txt' AS name, upper(left(source, 1)) || lower(substring(source, 2)) || ' Of All' AS title, CASE WHEN length(t) > 120 THEN left(t, 120) || '…' ELSE t END AS short FROM s",
    "named_passages": f"""WITH b AS (SELECT item_id, {strip('text')} AS t FROM benchmark), l AS (SELECT *, {LINES} AS lines FROM b),
k AS (SELECT DISTINCT source FROM documents)
SELECT item_id AS row_id, source AS sources, md5(CASE WHEN length(t) <= 1500 THEN t WHEN instr(reverse(left(t, 1500)), '.') > 0 AND 1500 - instr(reverse(left(t, 1500)), '.') > 750 THEN left(t, 1501 - instr(reverse(left(t, 1500)), '.')) ELSE left(t, 1500) END) AS passage, 'N/A' AS chapter
FROM l JOIN k ON lower(source) = 'src' || item_id % 20
WHERE length(t) >= 80 AND NOT (len(lines) >= 2 AND len(list_filter(lines, lambda x: regexp_matches(x, '\\d+$'))) / len(lines) > 0.3 AND len(list_filter(lines, lambda x: length(x) < 80)) / len(lines) > 0.6)""",
    "question_sources": "WITH k AS (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source), q AS (SELECT item_id, 'src' || item_id % 20 AS name, 0 AS pos FROM benchmark UNION ALL SELECT item_id, 'src3', 1 FROM benchmark) SELECT item_id AS id, doc_id, pos FROM q JOIN k ON lower(source) = name",
    "source_match_ratio": f"""WITH d AS (SELECT source, doc_id, {normalised("coalesce(text, '')")} AS d FROM documents), w AS (SELECT source, string_agg(d, ' ' ORDER BY doc_id) FILTER (d <> '') AS d FROM d GROUP BY source),
b0 AS (SELECT item_id, {normalised("coalesce(text, '')")} AS c FROM benchmark), b1 AS (SELECT item_id, c, list_filter(string_split(c, ' '), lambda x: x <> '') AS w FROM b0),
b AS (SELECT item_id, CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2, 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) WHEN c <> '' THEN [c] ELSE [] END AS parts FROM b1),
x AS (SELECT item_id, unnest(range(len(parts))) AS pos, unnest(parts) AS part, len(parts) AS n FROM b),
h AS (SELECT DISTINCT item_id, pos FROM x JOIN w ON (source = 'src' || item_id % 20 OR source = 'src3') AND contains(d, part)),
c AS (SELECT item_id, count(*) AS held FROM h GROUP BY item_id)
SELECT b.item_id, round(coalesce(held / len(parts), 0), 6) AS ratio FROM b LEFT JOIN c USING (item_id)""",
    "context_rows": "SELECT CASE WHEN turn % 2 = 0 THEN 'conv' || conv_id ELSE 'unknown' END AS filename, coalesce(role, 'text') AS type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations WHERE text IS NOT NULL GROUP BY 1, 2",
    "run_totals": f"WITH {BASE} SELECT count(DISTINCT doc_id) AS n_documents, count(*) AS n_sections, CAST(sum(n_words) AS BIGINT) AS n_words FROM s",
    "clean_metrics": "SELECT count(*) AS n_questions, count_if(doc_id % 7 = 0) AS n_hallucinated, round((count(*) - count_if(doc_id % 7 = 0)) / count(*), 6) AS clean_ratio FROM documents",
    "first_seen_sources": f"WITH {JUDGED} SELECT source, min(doc_id) AS first, count(*) AS n FROM a GROUP BY source",
    "type_count_metrics": f"WITH {JUDGED} SELECT 'count_' || type AS metric, CAST(count(*) AS DOUBLE) AS value FROM a GROUP BY type",
    "least_used_source": "SELECT source, count_if(doc_id % 11 = 0) AS n_used FROM documents GROUP BY source ORDER BY n_used, source LIMIT 1",
    "timing_stats": "SELECT count(value) AS n, " + ", ".join(f"round({f}(value), 4) AS {c}" for c, f in _MEASURES.items()) + " FROM events",
    "answer_code": r"SELECT item_id AS row_id, 'print(' || item_id || ');x = 1' AS blocks, regexp_replace(regexp_replace(text, '[\n()`]', ' ', 'g'), '^\s+|\s+$', '', 'g') AS final_answer FROM benchmark",
    "fetch_document": "SELECT doc_id, source, md5(text) AS digest FROM documents WHERE doc_id = 5",
    "offline_generators": f"""WITH {TEMPLATE}
SELECT doc_id, 'paraphrase' AS generator, replace({chosen(PARAPHRASES)}, '{{}}', left(answer, 30)) AS question, answer FROM g UNION ALL
SELECT doc_id, 'joined', 'How do these go together: ' || left(x, 30) || '...?', x FROM (SELECT doc_id, array_to_string(list_slice(regexp_extract_all(passage, '\\S+'), 1, 8), ' ') AS x FROM g) UNION ALL
SELECT doc_id, 'needle', 'What is said of ' || string_split(n, ' ')[3] || '?', n FROM (SELECT doc_id, {chosen(NEEDLES)} AS n FROM g) UNION ALL
SELECT doc_id, 'unknowable', {chosen(UNKNOWABLE)}, {quoted(NOT_FOUND)} FROM g""",
    "excerpt_regions": f"""WITH d AS (SELECT source, doc_id, lower(text) AS low, length(text) AS size FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, list_distinct(list_filter(string_split({normalised("coalesce(text, '')")}, ' '), lambda x: length(x) >= 4)) AS words FROM benchmark),
p AS (SELECT item_id, words, doc_id, low, size, unnest(range(0, greatest(size - 800, 0) + 1, 200)) AS b FROM i JOIN d ON source = 'src' || item_id % 20 OR source = 'src3'),
h AS (SELECT item_id, doc_id, size, len(words) AS n, b, len(list_filter(words, lambda x: contains(substring(low, b + 1, 800), x))) AS hits FROM p),
t AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE (b + least(b + 800, size)) // 2 END AS mid FROM h QUALIFY row_number() OVER (PARTITION BY item_id, doc_id ORDER BY hits DESC, b) = 1),
e AS (SELECT *, least(greatest(mid - 2000, 0) + 4000, size) AS region_end FROM t)
SELECT item_id, doc_id, b AS best_start, round(hits / greatest(n, 1), 6) AS score, greatest(region_end - 4000, 0) AS region_start, region_end FROM e""",
    "sample_corpus": "SELECT title, md5(content) AS content, type FROM (SELECT 'doc_' || doc_id AS title, text AS content, lang AS type FROM documents WHERE text IS NOT NULL UNION ALL SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(quoted(x) for x in r) + ")" for r in SAMPLES) + ") v(title, content, type))",
}
