"""DuckDB SQL with the same rows as the queries, written from the operators' definitions."""

from __future__ import annotations

from lexispark.functions import values as V
from lexispark.operators.generation import FIELDS, HINTS, TEMPLATES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(quoted(w) for w in dict.fromkeys(words))


def found(pattern: str, group: int = 0, text: str = "t") -> str:
    return f"regexp_extract_all({text}, {quoted(pattern)}, {group})"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def normalised(x: str) -> str:
    flat = rf"regexp_replace(regexp_replace(lower({x}), '[\n\r\t]+', ' ', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return strip(rf"regexp_replace({flat}, '\s+', ' ', 'g')")


def truncated(x: str, n: int) -> str:
    cut = f"left({x}, {n})"
    last = "greatest(" + ", ".join(f"CASE WHEN instr(reverse({cut}), '{m}') > 0 THEN length({cut}) - instr(reverse({cut}), '{m}') + 1 ELSE 0 END" for m in ".!?") + ")"
    return f"(CASE WHEN length({x}) <= {n} THEN {x} WHEN {last} - 1 > {n // 2} THEN left({x}, {last}) ELSE {cut} END)"


def hits(x: str) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({x}), {quoted(m)}) AS BIGINT)" for m in V.BOILERPLATE) + ")"


BOILERPLATE = f"({hits('t')} >= 2 OR (n_words < 20 AND {hits('t')} >= 1))"
TOKENS = f"list_filter({found(V.TOKEN, text='lower(t)')}, lambda x: length(x) >= 2 AND x NOT IN ({listed(V.SEARCH_STOP_WORDS)}))"
NOUNS = rf"list_distinct(list_filter({found(V.WORD)}, lambda x: regexp_matches(x, {quoted(V.PLAIN_NOUN)})))"
TERMS = f"list_concat(list_filter(list_transform({found(V.DEFINED_TERM, 1)}, lambda x: {strip('x')}), lambda x: length(x) > 2), {found(V.ABBREVIATION, 1)})"
HAS_TABLE = "(" + "greatest(" + ", ".join(f"len(list_filter(string_split(t, chr(10)), lambda x: length(x) - length(replace(x, {m}, '')) >= 2))" for m in ("chr(9)", "'|'")) + ") >= 2)"

BASE = rf"""
s AS (SELECT source, doc_id, lang, coalesce(text, '') AS t, left({strip("split_part(coalesce(text, ''), chr(10), 1)")}, 80) AS heading,
             len(regexp_extract_all(coalesce(text, ''), '\S+')) AS n_words FROM documents)"""

FACTS = BASE + rf""",
f0 AS (SELECT *, {found(V.DATE)} AS dates, {found(V.MONEY)} AS money, {found(V.EMAIL)} AS emails, {found(V.PHONE)} AS phones, {found(V.URL)} AS urls, {TERMS} AS terms, {NOUNS} AS nouns,
        (regexp_matches(t, {quoted(V.BULLET)}) OR regexp_matches(t, {quoted(V.NUMBERED)})) AS has_list, regexp_matches(t, {quoted(V.TAG_DATE)}) AS has_dates,
        regexp_matches(t, {quoted(V.TAG_NUMBER)}) AS has_numbers, (regexp_matches(t, {quoted(V.TAG_EMAIL)}) OR regexp_matches(t, {quoted(V.TAG_PHONE)}) OR regexp_matches(t, {quoted(V.URL)})) AS has_contact,
        regexp_matches(t, {quoted(V.TAG_DEFINITION)}) AS has_definition, {HAS_TABLE} AS has_table FROM s),
f1 AS (SELECT *, list_concat({found(V.PERCENTAGE)}, list_filter({found(V.NUMBER)}, lambda n: NOT list_contains(list_transform(dates, lambda d: replace(replace(d, '-', ''), '/', '')), n))) AS numbers FROM f0),
f AS (SELECT *, len(numbers) + len(money) + len(dates) + len(emails) + len(phones) + len(urls) + len(terms) AS entity_count FROM f1)"""

INDEX = BASE + f""",
tok AS (SELECT source, doc_id, {TOKENS} AS tokens FROM s WHERE n_words >= {V.INDEX_MIN_WORDS}),
len AS (SELECT source, doc_id, len(tokens) AS dl FROM tok),
post AS (SELECT source, doc_id, term, count(*) AS tf FROM (SELECT source, doc_id, unnest(tokens) AS term FROM tok) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
st AS (SELECT count(*) AS n_docs, avg(dl) AS avg_dl FROM len)"""

ITEM_TERMS = f"item AS (SELECT item_id AS query_id, list_distinct_ordered AS terms FROM (SELECT item_id, list_reduce(list_concat([[]::VARCHAR[]], list_transform({TOKENS}, lambda x: [x])), lambda acc, x: CASE WHEN list_contains(acc, x[1]) THEN acc ELSE list_concat(acc, x) END) AS list_distinct_ordered FROM (SELECT item_id, coalesce(text, '') AS t FROM benchmark)))"


def bm25(terms: str, k: int | None, where: str = "") -> str:
    rank = f"QUALIFY rank <= {k}" if k else ""
    return INDEX + f""",
{ITEM_TERMS},
q AS (SELECT query_id, term, count(*) AS weight FROM (SELECT query_id, unnest({terms}) AS term FROM item) GROUP BY ALL),
sc AS (SELECT query_id, source, doc_id, round(sum(weight * ln((n_docs - df + 0.5) / (df + 0.5) + 1) * tf * ({V.K1} + 1) / (tf + {V.K1} * (1 - {V.B} + {V.B} * dl / avg_dl))), 6) AS score
       FROM q JOIN df USING (term) JOIN post USING (term) JOIN len USING (source, doc_id), st {where} GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source, doc_id) AS rank FROM sc WHERE score > 0 {rank})"""


def top(score: str, where: str = "true", positive: bool = True, k: int = 5) -> str:
    return f"""WITH {FACTS},
sc AS (SELECT source, doc_id, t, round(CAST({score} AS DOUBLE), 6) AS score FROM f WHERE n_words >= {V.MIN_WORDS} AND {where})
SELECT row_number() OVER (ORDER BY score DESC, source, doc_id) AS rank, source, doc_id, score, length({truncated('t', V.PASSAGE)}) AS passage_len
FROM sc WHERE {'score > 0' if positive else 'true'} ORDER BY score DESC, source, doc_id LIMIT {k}"""


GENERIC = "least(n_words, 200) / 50 + 0.5 * entity_count"


def pair_sql(within: bool) -> str:
    common = listed(n.lower() for n in V.COMMON_NAMES)
    keep = f"lambda x: lower(substring(x, 3)) NOT IN ({common})"
    names = f"list_filter(list_concat(list_transform({NOUNS}, lambda x: 'n:' || x), list_distinct(list_transform({TERMS}, lambda x: 't:' || lower(x)))), {keep})"
    place = "a.source = b.source AND a.doc_id < b.doc_id AND a.heading <> b.heading" if within else "a.source < b.source"
    return f"""WITH {BASE},
n AS (SELECT source, doc_id, heading, unnest({names}) AS name FROM s WHERE n_words >= {V.MIN_WORDS}),
p AS (SELECT a.source AS sa, b.source AS sb, a.doc_id AS doc_a, b.doc_id AS doc_b, count(DISTINCT substring(name, 3)) AS n_shared FROM n a JOIN n b USING (name) WHERE {place} GROUP BY ALL)
SELECT row_number() OVER (ORDER BY n_shared DESC, sa, doc_a, sb, doc_b) AS rank, doc_a, doc_b, n_shared FROM p ORDER BY n_shared DESC, sa, doc_a, sb, doc_b LIMIT 10"""


CHUNKS = "CASE WHEN len(w) < 4 THEN []::VARCHAR[] ELSE list_transform(range(1, len(w) - 2, 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END"

TEMPLATE = BASE + f""",
g0 AS (SELECT source, doc_id, {truncated('t', V.PASSAGE)} AS passage, CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 7) AS BIGINT) AS draw FROM s WHERE n_words >= {V.MIN_WORDS}),
g1 AS (SELECT *, regexp_extract_all(passage, '\\S+') AS w FROM g0),
g2 AS (SELECT *, CAST(draw % greatest(len(w) - 14, 1) AS BIGINT) + 1 AS b FROM g1),
g AS (SELECT source, doc_id, passage, array_to_string(list_slice(w, b, b + 14), ' ') AS answer,
             replace([{listed(TEMPLATES)}][draw % {len(TEMPLATES)} + 1], '{{}}', array_to_string(list_slice(w, b, b + 2), ' ')) AS question,
             [{listed(V.QUESTION_TYPES)}][doc_id % {len(V.QUESTION_TYPES)} + 1] AS type, ['easy', 'medium', 'hard'][doc_id % 3 + 1] AS difficulty FROM g2)"""


def grounding(answer: str, passage: str) -> str:
    words = f"list_filter(string_split({normalised(answer)}, ' '), lambda x: length(x) >= 4)"
    whole = f"CASE WHEN {normalised(answer)} <> '' AND contains({normalised(passage)}, {normalised(answer)}) THEN 1.0 ELSE 0.0 END"
    return f"(CASE WHEN len({words}) = 0 THEN {whole} ELSE len(list_filter({words}, lambda x: contains({normalised(passage)}, x))) / len({words}) END)"


LINES = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: length(x) > 0)"
DIGITS = "(CASE WHEN len(lines) = 0 THEN 0 ELSE len(list_filter(lines, lambda x: regexp_matches(x, '\\d+$'))) / len(lines) END)"
SHORT = "(CASE WHEN len(lines) = 0 THEN 0 ELSE len(list_filter(lines, lambda x: length(x) < 80)) / len(lines) END)"

JUDGED = TEMPLATE + f""",
j0 AS (SELECT * REPLACE (CASE WHEN doc_id % 4 = 1 THEN 'zzzz qqqq xxxx' ELSE answer END AS answer), CASE WHEN doc_id % 4 = 3 THEN left(passage, 25) ELSE passage END AS context, CASE WHEN doc_id % 4 = 2 THEN 0.1 ELSE 1.0 END AS match_ratio FROM g),
j1 AS (SELECT *, {LINES.replace('string_split(t,', 'string_split(context,')} AS lines, type IN ({listed(V.UNGROUNDED)}) OR {grounding('answer', 'context')} >= {V.MIN_KEYWORDS} AS answer_grounded FROM j0),
j AS (SELECT *, CASE WHEN match_ratio < {V.MIN_MATCH} THEN 'context_not_found' WHEN len(lines) >= 2 AND {DIGITS} > 0.3 AND {SHORT} > 0.6 THEN 'contents_table'
        WHEN NOT answer_grounded THEN 'answer_not_grounded' WHEN length({strip('context')}) < {V.MIN_CONTEXT} THEN 'context_too_short'
        WHEN type = 'multi_hop_between_documents' THEN 'same_document' ELSE 'passed' END AS reason FROM j1),
a AS (SELECT * FROM j WHERE reason = 'passed')"""


def distribution(column: str) -> str:
    return f"WITH {JUDGED}, c AS (SELECT {column} AS value, count(*) AS n FROM a GROUP BY 1) SELECT value, n, round(n / sum(n) OVER (), 6) AS share FROM c"


_METRICS = {
    "n_questions": "count(*)", "n_duplicates": "count(*) - count(DISTINCT question)", "yield_ratio": "round(count(*) / 1000, 6)", "efficiency": "round(count(*) / 2000, 6)",
    "avg_context": "round(avg(length(context)), 6)", "min_context": "min(length(context))", "max_context": "max(length(context))",
    "avg_answer": "round(avg(length(answer)), 6)", "min_answer": "min(length(answer))", "max_answer": "max(length(answer))",
    "avg_match": "round(avg(match_ratio), 6)", "min_match": "min(match_ratio)", "grounded_ratio": "round(count(*) FILTER (answer_grounded) / count(*), 6)", "n_multi_source": "0",
}

_FORM = {m: "{" + ", ".join(f'"{f}": "..."' for f in FIELDS[m]) + "}" for m in (False, True)}
_HINT = "CASE type " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in HINTS.items() if k != "default") + f" ELSE {quoted(HINTS['default'])} END"
_USER = f"concat_ws(chr(10), 'Type: ' || type, 'Difficulty: ' || difficulty, 'Task: ' || {_HINT}, 'Sources: ' || source, 'Passage:' || chr(10) || passage, 'Answer as JSON: ' || CASE WHEN type = 'multi_turn_followup' THEN {quoted(_FORM[True])} ELSE {quoted(_FORM[False])} END)"

_TOPIC = rf"list_filter(regexp_extract_all(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\S+'), lambda w: length(w) >= 6 AND w NOT IN ({listed(V.TOPIC_STOP_WORDS)}))"

ORACLES = {
    "sections_parse": rf"""WITH p AS (SELECT doc_id, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM (SELECT doc_id, regexp_split_to_array(text, '\n\s*\n') AS parts FROM documents WHERE text IS NOT NULL)),
q AS (SELECT doc_id, pos, {strip('raw')} AS part FROM p),
o AS (SELECT *, CAST(coalesce(sum(length(part) + 2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start FROM q),
k AS (SELECT *, left({strip("split_part(part, chr(10), 1)")}, 80) AS heading, {strip("CASE WHEN contains(part, chr(10)) THEN substring(part, instr(part, chr(10)) + 1) ELSE part END")} AS content FROM o WHERE length(part) >= 20)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS sec_ord, heading, len(regexp_extract_all(content, '\S+')) AS wc, length(content) AS n_chars, char_start, char_start + length(part) AS char_end FROM k""",
    "section_tags": f"WITH {FACTS} SELECT doc_id, has_list, has_dates, has_numbers, has_contact, has_definition, has_table FROM f",
    "section_entities_counts": f"WITH {FACTS} SELECT doc_id, len(numbers) AS n_numbers, len(money) AS n_money, len(dates) AS n_dates, len(emails) AS n_emails, len(phones) AS n_phones, len(urls) AS n_urls, len(terms) AS n_terms, entity_count FROM f",
    "key_nouns": f"WITH {BASE} SELECT doc_id, len({NOUNS}) AS n_nouns FROM s",
    "tokens_top_terms": f"WITH {INDEX} SELECT term, CAST(sum(tf) AS BIGINT) AS tf FROM post GROUP BY term ORDER BY tf DESC, term LIMIT 20",
    "term_df": f"WITH {INDEX} SELECT term, df FROM df",
    "corpus_stats": f"WITH {INDEX} SELECT n_docs, round(avg_dl, 6) AS avg_dl FROM st",
    "bm25_topk": f"WITH {bm25('terms', 10)} SELECT query_id, rank, doc_id, score FROM top",
    "bm25_repeated_term": f"WITH {bm25('list_concat(terms, list_slice(terms, 1, 1))', 5)} SELECT query_id, rank, doc_id, score FROM top",
    "bm25_source_filter": "WITH " + bm25("terms", None, "WHERE source = 'src3'") + " SELECT query_id, doc_id, score FROM top",
    "direct_lookup_topk": top("2 * len(numbers) + 3 * len(money) + 2 * len(dates) + 2 * len(emails) + 3 * len(phones) + CAST(has_list AS INTEGER)"),
    "paraphrase_topk": top("least(n_words, 200) / 50 + entity_count + 2 * CAST(has_definition AS INTEGER)", f"NOT {BOILERPLATE}", False),
    "jargon_topk": top("3 * len(terms) + 2 * CAST(has_definition AS INTEGER) + 0.5 * len(nouns)"),
    "needle_topk": top("(1 - entity_count / n_words) * n_words", "n_words > 50 AND entity_count BETWEEN 1 AND 4", False),
    "tables_topk": top("CASE WHEN has_table THEN n_words + 100 WHEN len(numbers) + len(money) >= 2 THEN 10 * (len(numbers) + len(money)) END"),
    "generic_topk": top(GENERIC, f"NOT {BOILERPLATE}", False),
    "pinpoint_topk": top("4 * len(emails) + 4 * len(phones) + 3 * len(urls) + 2 * len(terms) + 2 * len(money) + len(numbers)", f"NOT {BOILERPLATE}"),
    "temporal_single_doc_topk": top("3 * len(dates) + CAST(has_dates AS INTEGER)"),
    "within_pairs_topk": pair_sql(True),
    "between_pairs_topk": pair_sql(False),
    "lists_capped_topk": f"""WITH {BASE}, l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_words DESC, doc_id) AS own, (SELECT count(DISTINCT source) FROM s WHERE n_words >= 15 AND len(string_split(t, chr(10))) >= 10) AS n FROM s WHERE n_words >= 15 AND len(string_split(t, chr(10))) >= 10)
SELECT row_number() OVER (ORDER BY own > greatest(1, ceil(25 / n)), n_words DESC, source, doc_id) AS rank, source, doc_id, n_words, length({truncated('t', V.LIST_PASSAGE)}) AS passage_len FROM l ORDER BY rank LIMIT 25""",
    "long_context_spans": f"""WITH {BASE}, p AS (SELECT source, doc_id, length(t) AS l, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM s),
r AS (SELECT *, pos // least(4, n) * least(4, n) AS start_idx FROM p WHERE n >= 3),
c AS (SELECT *, CAST(sum(l + 2) OVER (PARTITION BY source, start_idx ORDER BY pos) - 2 AS BIGINT) AS total FROM r WHERE start_idx < n - 2),
m AS (SELECT source, start_idx, count(*) AS n_included, max(total) AS total_chars, min(doc_id) AS first_doc_id FROM c WHERE total <= {V.LONG_CONTEXT} OR pos = start_idx GROUP BY ALL HAVING count(*) >= 2)
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY start_idx ORDER BY source) = 1""",
    "hallucination_sample": f"""WITH {BASE}, d AS (SELECT *, md5('42:' || source || ':' || CAST(doc_id AS VARCHAR)) AS draw FROM s WHERE n_words >= 15)
SELECT row_number() OVER (ORDER BY draw, doc_id) AS rank, doc_id, draw, length({truncated('t', V.HALLUCINATION_PASSAGE)}) AS passage_len FROM d ORDER BY draw, doc_id LIMIT 8""",
    "unused_sections_anti": f"WITH {FACTS}, u AS (SELECT doc_id FROM f WHERE n_words >= 15 AND NOT {BOILERPLATE} ORDER BY round(CAST({GENERIC} AS DOUBLE), 6) DESC, source, doc_id LIMIT 50) SELECT doc_id FROM f WHERE n_words >= 15 AND doc_id NOT IN (SELECT doc_id FROM u)",
    "boilerplate_flags": f"WITH {BASE} SELECT doc_id, {hits('t')} AS hits, {BOILERPLATE} AS boilerplate FROM s",
    "toc_flags": f"WITH {BASE}, l AS (SELECT doc_id, {LINES} AS lines FROM s) SELECT doc_id, len(lines) AS n_lines, round({DIGITS}, 6) AS digit_share, round({SHORT}, 6) AS short_share, len(lines) >= 2 AND {DIGITS} > 0.3 AND {SHORT} > 0.6 AS toc FROM l",
    "truncate_passage": f"WITH {BASE} SELECT doc_id, length({truncated('t', V.PASSAGE)}) AS passage_len, md5({truncated('t', V.PASSAGE)}) AS digest FROM s",
    "normalised_text": f"WITH {BASE} SELECT doc_id, md5({normalised('t')}) AS digest FROM s",
    "context_match_ratio": f"""WITH d AS (SELECT doc_id, {normalised("coalesce(text, '')")} AS d FROM documents), b0 AS (SELECT item_id, {normalised("coalesce(text, '')")} AS c FROM benchmark),
b1 AS (SELECT item_id, c, list_filter(string_split(c, ' '), lambda x: x <> '') AS w FROM b0), b AS (SELECT item_id, c, {CHUNKS} AS chunks FROM b1),
r AS (SELECT item_id, doc_id, round(CASE WHEN len(chunks) = 0 THEN CAST(c <> '' AND contains(d, c) AS INTEGER) ELSE len(list_filter(chunks, lambda x: contains(d, x))) / len(chunks) END, 6) AS ratio FROM b, d)
SELECT * FROM r WHERE ratio >= {V.MIN_MATCH}""",
    "qa_template_generate": f"WITH {TEMPLATE} SELECT doc_id, question, answer FROM g",
    "answer_grounding": f"""WITH {TEMPLATE}, h AS (SELECT *, coalesce(lag(answer) OVER (PARTITION BY source ORDER BY doc_id), '') AS other FROM g),
r AS (SELECT doc_id, round({grounding('answer', 'passage')}, 6) AS own_ratio, round({grounding('other', 'passage')}, 6) AS foreign_ratio FROM h) SELECT *, foreign_ratio >= {V.MIN_KEYWORDS} AS foreign_grounded FROM r""",
    "best_matching_doc": f"""WITH d AS (SELECT source, {normalised("coalesce(text, '')")} AS d FROM documents),
b AS (SELECT item_id, list_distinct(list_filter(string_split({normalised("text")}, ' '), lambda x: length(x) >= 4)) AS w FROM benchmark),
x AS (SELECT item_id, len(w) AS n, unnest(w) AS word FROM b), h AS (SELECT item_id, source, n, count(DISTINCT word) AS hits FROM x JOIN d ON contains(d, word) GROUP BY ALL)
SELECT item_id, source, round(hits / n, 6) AS score FROM h QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(hits / n, 6) DESC, source) = 1""",
    "hallucination_topic_check": "WITH " + INDEX + f""",
q0 AS (SELECT item_id, {_TOPIC} AS topic FROM (SELECT item_id, text AS t FROM benchmark)),
q1 AS (SELECT item_id, topic, {TOKENS} AS terms FROM (SELECT *, array_to_string(list_slice(topic, 1, 5), ' ') AS t FROM q0 WHERE len(topic) >= 2)),
q AS (SELECT item_id, term, count(*) AS weight FROM (SELECT item_id, unnest(terms) AS term FROM q1) GROUP BY ALL),
sc AS (SELECT item_id, source, doc_id, round(sum(weight * ln((n_docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg_dl))), 6) AS score FROM q JOIN df USING (term) JOIN post USING (term) JOIN len USING (source, doc_id), st GROUP BY ALL),
t3 AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, source, doc_id) <= 3),
y AS (SELECT DISTINCT item_id FROM t3 JOIN q1 USING (item_id) JOIN s USING (doc_id) WHERE score >= {V.TOPIC_SCORE} AND len(list_filter(topic, lambda w: contains(lower(t), w))) >= 2)
SELECT item_id, item_id IN (SELECT item_id FROM y) AS exists FROM benchmark""",
    "validation_reasons": f"WITH {JUDGED} SELECT type, reason, count(*) AS n FROM j GROUP BY ALL",
    "llm_json_parse": f"SELECT item_id AS row_id, {strip('reverse(text)')} AS question, {strip('text')} AS answer FROM benchmark WHERE item_id % 6 < 4",
    "prompt_messages": f"""WITH {TEMPLATE} SELECT 'q' || doc_id AS id, 'user' AS role, md5({_USER}) AS digest FROM g UNION ALL SELECT 'q' || doc_id, 'system', md5('You write test questions. Use the passage only.') FROM g""",
    "summary_metrics": f"WITH {JUDGED}, m AS (SELECT {', '.join(f'CAST({v} AS DOUBLE) AS {k}' for k, v in _METRICS.items())} FROM a) UNPIVOT m ON COLUMNS(*) INTO NAME metric VALUE value",
    "difficulty_distribution": distribution("difficulty"),
    "type_distribution": distribution("type"),
    "source_distribution": distribution("source"),
    "duplicate_questions": f"WITH {JUDGED} SELECT count(*) - count(DISTINCT question) AS n_duplicates FROM a",
    "viewer_filter": f"WITH {JUDGED} SELECT doc_id AS id FROM a WHERE difficulty = 'medium' AND contains(lower(concat_ws(' ', question, answer, context, CAST(doc_id AS VARCHAR))), 'the')",
    "keyword_snippets": r"""WITH p AS (SELECT doc_id, text, instr(lower(text), 'license') AS pos FROM documents), q AS (SELECT *, greatest(pos - 100, 1) AS b FROM p WHERE pos > 0)
SELECT doc_id, pos, regexp_replace(substring(text, b, pos + 7 + 100 - b), '[\n\r]', ' ', 'g') AS snippet FROM q""",
    "doc_listing": "SELECT doc_id, source, lang, length(coalesce(text, '')) AS size FROM documents",
    "keyword_prefilter": """WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS low, ['license', 'that', 'with', 'which', 'nicht', 'para', 'dans'] AS words FROM documents),
w AS (SELECT doc_id, low, words, unnest(range(0, greatest(length(low) - 800, 0) + 1, 200)) AS b FROM d),
h AS (SELECT doc_id, b, len(list_filter(words, lambda x: contains(substring(low, b + 1, 800), x))) AS hits FROM w)
SELECT doc_id, b AS best_start, round(hits / 7, 6) AS score, greatest(b + 400 - 2000, 0) AS region_start FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, b) = 1""",
    "multi_turn_pairs": """WITH c AS (SELECT conv_id, turn, role, text AS q1, lead(role, 1) OVER w AS r1, lead(role, 2) OVER w AS r2, lead(role, 3) OVER w AS r3, lead(text, 1) OVER w AS a1, lead(text, 2) OVER w AS q2, lead(text, 3) OVER w AS a2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, length(q1) AS q1_len, length(a1) AS a1_len, length(q2) AS q2_len, length(a2) AS a2_len FROM c WHERE role = 'user' AND r1 = 'assistant' AND r2 = 'user' AND r3 = 'assistant'""",
    "question_type_dim": "SELECT strategy, count(*) AS n_types, sum(CASE WHEN ord < 15 THEN 3 ELSE 0 END)::BIGINT AS requested FROM (VALUES " + ", ".join(f"({i}, {quoted(s)})" for i, s in enumerate(V.QUESTION_TYPES.values())) + ") v(ord, strategy) GROUP BY strategy",
}
