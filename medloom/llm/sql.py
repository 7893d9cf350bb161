"""SQL of those queries that SQL can express over whole tables."""

from __future__ import annotations

from medloom.llm import setjoin
from medloom.llm.textkind import FUNCTION_WORDS
from medloom.queries.curation import _WS, sql_number_key, sql_squeezed

_TOKEN = r"\x22[^\x22]*\x22|“[^”]*”|''[^'']*''|\([^()]*\)|\[[^\[\]]*\]|[^\s\x{85}\x{a0}+＋&/|;,\x22“(\[]+|[+＋&/|;,\t\n\r\x22“(\[]"


def _letters(c: str) -> str:
    return rf"regexp_replace(lower({c}), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')"


def _blank(c: str) -> str:
    return f"regexp_full_match({c}, '{_WS}*')"


def _name(c: str) -> str:
    parts = rf"list_transform(regexp_extract_all({c}, '{_TOKEN}'), lambda p: CASE WHEN regexp_full_match(p, '[+＋&/|;,\t\n\r]') OR lower(p) IN ('and', 'with', 'plus') THEN chr(1) ELSE {_letters('p')} END)"
    return f"CASE WHEN NOT {_blank(c)} THEN array_to_string(list_sort(list_filter(string_split(array_to_string({parts}, ''), chr(1)), lambda p: p <> '')), '+') END"


def _strength(c: str) -> str:
    thousands = lambda t: rf"regexp_replace({t}, '(^|[^0-9.,])([1-9][0-9]{{0,2}}),([0-9]{{3}})($|[^0-9])', '\1\2\3\4', 'g')"
    t = thousands(thousands(f"lower({c})"))
    for _ in range(2):
        t = rf"regexp_replace({t}, '[.,]([^0-9]|$)', ' \1', 'g')"
    t = rf"regexp_replace({t}, '(^|[^0-9]),', '\1 ', 'g')"
    t = rf"trim(regexp_replace({t}, '[^\p{{L}}\p{{M}}\p{{N}}%.,]+', ' ', 'g'), ' ')"
    t = rf"regexp_replace(regexp_replace({t}, '([^0-9]) ', '\1', 'g'), ' ([^0-9.])', '\1', 'g')"
    return f"CASE WHEN NOT {_blank(c)} THEN {t} END"


def _text(c: str) -> str:
    return f"CASE WHEN NOT {_blank(c)} THEN {_letters(c)} END"


def _keys(table: str) -> str:
    number = f"coalesce({sql_number_key('notification_number')}, {_text('notification_number')})"
    parts = ", ".join(f"coalesce('=' || {p}, '')" for p in (_name("generic_name"), _text("dosage_form"), _strength("strength"), number))
    return f"SELECT id, concat_ws(chr(1), {parts}) AS key FROM {table}"


def _copies(table: str) -> str:
    return f"SELECT first_id, id FROM (SELECT id, min(id) OVER (PARTITION BY key) AS first_id FROM ({_keys(table)})) WHERE id <> first_id"


def _normal(c: str) -> str:
    t = rf"regexp_replace(lower({c}), '\b(?:i\.m|i\.v)\b\.?', ' ', 'g')"
    t = rf"regexp_replace({t}, '[^\p{{L}}\p{{M}}]+', ' ', 'g')"
    return sql_squeezed(rf"regexp_replace({t}, '\b(?:{'|'.join(setjoin.MODIFIERS)})\b', ' ', 'g')")


def _tokens(c: str) -> str:
    pairs = f"flatten(list_transform(list_filter(string_split({c}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('^' || w || '$', i, 2))))"
    every = f"list_sort(list_concat(list_filter(string_split(replace({c}, ' ', ''), ''), lambda x: x <> ''), {pairs}))"
    return every


_SHORTS = f"""list_filter(list_distinct(list_concat([w, CASE WHEN w LIKE '%s' THEN w[:-2] ELSE w || 's' END, w[1] || regexp_replace(w[2:], '[aeiou]', '', 'g')],
      list_transform(range({setjoin.SHORTEST}, greatest(length(w), {setjoin.SHORTEST})), lambda i: w[1:i]),
      CASE {' '.join(f"WHEN w = '{w}' THEN [{', '.join(repr(x) for x in names)}]" for w, names in setjoin.SYNONYMS.items())} ELSE [] END)), lambda x: length(x) >= least({setjoin.SHORTEST}, length(w)))"""
_P5 = f"""
    WITH f AS (SELECT form_id AS ref_id, {_normal('form_name')} AS name FROM dosage_forms),
    w AS (SELECT ref_id, unnest(string_split(name, ' ')) AS w, generate_subscripts(string_split(name, ' '), 1) AS p, len(string_split(name, ' ')) AS n FROM f),
    o AS (SELECT ref_id, w, p, n, unnest({_SHORTS}) AS o FROM w),
    g AS (SELECT ref_id, o AS name FROM o WHERE n = 1 UNION ALL SELECT a.ref_id, a.o || ' ' || b.o FROM o a JOIN o b ON a.ref_id = b.ref_id AND a.n = 2 AND a.p = 1 AND b.p = 2
      UNION ALL SELECT ref_id, o FROM o WHERE w IN (SELECT w FROM w GROUP BY w HAVING count(DISTINCT ref_id) = 1)),
    n AS (SELECT ref_id, name FROM f UNION ALL SELECT min(ref_id), name FROM g WHERE name NOT IN (SELECT name FROM f) GROUP BY name HAVING count(DISTINCT ref_id) = 1),
    r AS (SELECT 'banned_medicines' AS table_name, id, dosage_form FROM banned_medicines UNION ALL SELECT 'unofficial_medicines', id, dosage_form FROM unofficial_medicines),
    t AS (SELECT table_name, id, {_normal('dosage_form')} AS v FROM r WHERE dosage_form IS NOT NULL AND NOT {_blank('dosage_form')} AND dosage_form NOT IN (SELECT form_name FROM dosage_forms)),
    a AS (SELECT v, list_transform(s, lambda x, i: x || '#' || (i - list_position(s, x))) AS ta FROM (SELECT v, {_tokens('v')} AS s FROM (SELECT DISTINCT v FROM t WHERE v <> ''))),
    b AS (SELECT ref_id, list_transform(s, lambda x, i: x || '#' || (i - list_position(s, x))) AS tb FROM (SELECT ref_id, {_tokens('name')} AS s FROM n)),
    j AS (SELECT v, ref_id, len(list_intersect(ta, tb)) AS c, len(ta) + len(tb) AS l FROM a, b),
    m AS (SELECT v, ref_id FROM j WHERE c / (l - c) >= {setjoin.THRESHOLD} - 1e-12 QUALIFY row_number() OVER (PARTITION BY v ORDER BY c / (l - c) DESC, ref_id) = 1)
    SELECT table_name, id, coalesce(ref_id, 0) AS form_id FROM t LEFT JOIN m USING (v)"""

_COMMON = ", ".join(f"'{w}'" for w in sorted(FUNCTION_WORDS))
_STATS = rf"""
    w AS (SELECT doc_id, text, {sql_squeezed('text')} AS flat, coalesce(nullif(lower(regexp_extract(lang, '([A-Za-z]+)', 1)), ''), 'und') AS lang FROM documents WHERE text IS NOT NULL),
    x AS (SELECT *, list_filter(string_split(flat, ' '), lambda v: v <> '') AS words FROM w),
    y AS (SELECT *, len(words) AS n, length(flat) - greatest(len(words) - 1, 0) AS ink, length(regexp_replace(flat, '[\p{{L}}\p{{M}}\p{{N}} ]+', '', 'g')) AS symbols,
      len(regexp_extract_all(text, '(?m)^.*\S.*$')) AS lines, len(regexp_extract_all(text, '(?m)[.!?।…;:][\x22\x27)\]”’]*[ \t\r]*$')) AS ended, len(list_filter(words, lambda v: lower(v) IN ({_COMMON}))) AS common FROM x),
    s AS (SELECT doc_id, lang, CAST(n AS DOUBLE) AS n_words, CASE WHEN n > 0 THEN round(ink / n, 4) ELSE 0.0 END AS mean_word_length, CASE WHEN ink > 0 THEN round(symbols / ink, 4) ELSE 0.0 END AS symbol_ratio,
      CASE WHEN lines > 0 THEN round(ended / lines, 4) ELSE 0.0 END AS ended_lines, CASE WHEN n > 0 THEN round(common / n, 4) ELSE 0.0 END AS common_words FROM y)"""
_P10 = f"""
    WITH {_STATS},
    l AS (SELECT doc_id, lang, stat, value FROM s UNPIVOT (value FOR stat IN (n_words, mean_word_length, symbol_ratio, ended_lines, common_words))),
    r AS (SELECT doc_id, least(1.0, 2 * least(count(*) OVER (PARTITION BY lang, stat ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      count(*) OVER (PARTITION BY lang, stat ORDER BY value RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) / count(*) OVER (PARTITION BY lang, stat)) AS tail FROM l),
    o AS (SELECT doc_id, round(sum(-ln(tail)), 6) AS outlier_score FROM r GROUP BY 1)
    SELECT s.*, outlier_score FROM s JOIN o USING (doc_id)"""

SQL: dict[str, str] = {
    "p1_found": f"SELECT 'banned_medicines' AS table_name, * FROM ({_copies('banned_medicines')}) UNION ALL SELECT 'unofficial_medicines', * FROM ({_copies('unofficial_medicines')})",
    "p1_copy_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, first_id, n_copies, generic_name, notification_number FROM (SELECT min(id) AS first_id, count(*) AS n_copies FROM ({_keys(t)}) GROUP BY key) JOIN {t} ON first_id = id"
        for t in ("banned_medicines", "unofficial_medicines")
    ),
    "p5_found": _P5,
    "p10_statistics": _P10,
}
