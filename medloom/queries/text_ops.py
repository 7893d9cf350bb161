"""Queries of the scalar operators, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions import text as T
from medloom.operators import extract
from medloom.tables import table


def _select(name: str, *columns, where=None):  # noqa: ANN001, ANN002, ANN202
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = table(spark, folder, name)
        return (rows.filter(where) if where is not None else rows).select(*[c() if callable(c) else c for c in columns])

    return query


#: DuckDB's form of the whitespace class, of strip and of squeeze.
WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def sql_strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sql_squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '{WS}+', ' ', 'g'), ' ')"


def sql_capital(w: str) -> str:
    return f"upper({w}[1]) || lower({w}[2:])"


def sql_name(c: str) -> str:
    words = rf"string_split(regexp_replace({sql_squeeze(c)}, '[.,;:]+$', ''), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: CASE WHEN regexp_full_match(upper(w), '[IVXLCDM]{{1,5}}') THEN upper(w) ELSE {sql_capital('w')} END), ' ')"


def sql_title(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: {sql_capital('w')}), '')"


def sql_form(c: str) -> str:
    pairs = ", ".join(f"'{k}'" for k in lexicon.FORMS), ", ".join(f"'{v}'" for v in lexicon.FORMS.values())
    known = f"map([{pairs[0]}], [{pairs[1]}])"
    key = rf"regexp_replace(lower({sql_strip(c)}), '[s.]+$', '')"
    return f"CASE WHEN {sql_strip(c)} <> '' THEN coalesce({known}[{key}], {known}[{key} || 's'], {sql_title(sql_strip(c))}) END"


def sql_strength(c: str) -> str:
    return rf"regexp_replace(nullif({sql_squeeze(c)}, ''), '([0-9])(mg|ml|g|mcg|iu|%)', '\1 \2', 'gi')"


def sql_number(c: str) -> str:
    return rf"regexp_replace(nullif({sql_squeeze(c)}, ''), ' *\( *E *\)', '(E)', 'g')"


def sql_extract(c: str, pattern: str, group: int = 0, flags: str = "i") -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', {group}, '{flags}'), '')"


_GSR, _SO = r"G\.?\s*S\.?\s*R\.?\s*(\d+)\s*\(?\s*E\s*\)?", r"S\.?\s*O\.?\s*(\d+)\s*\(?\s*E\s*\)?"


def sql_extract_number(c: str) -> str:
    return f"coalesce('G.S.R. ' || {sql_extract(c, _GSR, 1)} || '(E)', 'S.O. ' || {sql_extract(c, _SO, 1)} || '(E)')"


_MONTH = "(" + "|".join(m.capitalize() for m in lexicon.MONTHS) + ")"
_DATES = [
    (r"(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})", 1, 2, 3, "%d/%m/%Y"),
    (r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 1, 2, 3, "%d/%m/%Y"),
    (rf"{_MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}})", 2, 1, 3, "%d/%B/%Y"),
    (rf"(\d{{1,2}})\s+{_MONTH},?\s+(\d{{4}})", 1, 2, 3, "%d/%B/%Y"),
    (rf"(\d{{1,2}})(?:st|nd|rd|th)\s+{_MONTH},?\s+(\d{{4}})", 1, 2, 3, "%d/%B/%Y"),
]


def sql_extract_date(c: str, any_ordinal: bool = True) -> str:
    fits = lambda p: "TRUE" if any_ordinal or "st|nd" not in p else f"regexp_matches(regexp_extract({c}, '{p}', 0, 'i'), '[0-9](?:st|nd|rd|th)')"
    one = lambda p, d, m, y, f: f"CAST(try_strptime({sql_extract(c, p, d)} || '/' || {sql_extract(c, p, m)} || '/' || {sql_extract(c, p, y)}, '{f}') AS DATE)"
    return "coalesce(" + ", ".join(f"CASE WHEN {fits(x[0])} THEN {one(*x)} END" for x in _DATES) + ")"


_DATE_FORMS = ["yyyy-MM-dd", "dd-MM-yyyy", "dd.MM.yyyy", "dd/MM/yyyy", "MMMM dd, yyyy", "dd MMMM yyyy", "MMM dd, yyyy", "dd MMM yyyy"]
_SQL_DATE_FORMS = ["%Y-%m-%d", "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y", "%B %d, %Y", "%d %B %Y", "%b %d, %Y", "%d %b %Y"]


def ref_x3_parse_date(spark: SparkSession, folder: str) -> DataFrame:
    """Dates written in eight formats by id, every 9th inside other text."""
    rows = table(spark, folder, "banned_medicines").filter(F.col("notification_date").isNotNull())
    turn = F.pmod(F.col("id"), F.lit(9))
    written = F.coalesce(*[F.when(turn == i, F.date_format("notification_date", f)) for i, f in enumerate(_DATE_FORMS)], F.concat(F.lit("vide order of "), F.date_format("notification_date", "dd/MM/yyyy")))
    return rows.select("id", T.parse_date(written).alias("parsed"))


def ref_x4_number_and_date(spark: SparkSession, folder: str) -> DataFrame:
    note = T.parse_number_and_date(F.concat(F.lit("vide "), F.col("notification_number"), F.lit(" Dated "), F.date_format("notification_date", "dd.MM.yyyy")))
    return table(spark, folder, "banned_medicines").select("id", note["number"].alias("number"), note["date"].alias("dated"))


def ref_x8_split_combination(spark: SparkSession, folder: str) -> DataFrame:
    parts = T.split_combination(F.col("generic_name"))
    return table(spark, folder, "banned_medicines").select("id", parts["is_fdc"].alias("is_fdc"), F.array_join(parts["ingredients"], " | ").alias("ingredients"))


def _entries(kind):  # noqa: ANN001, ANN202
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = table(spark, folder, "documents").filter("text is not null").select("doc_id", F.posexplode(kind(F.col("text"))).alias("pos", "e"))
        return rows.select("doc_id", "pos", "e.generic_name", "e.dosage_form", "e.strength", "e.raw_text")

    return query


def ref_t4_entries(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return extract.entries(documents)


def ref_t6_routes(spark: SparkSession, folder: str) -> DataFrame:
    parsed = extract.routed_entries(ref_t4_entries(spark, folder))
    return parsed.groupBy("route", "is_fdc").agg(F.count("*").alias("n_entries"), F.countDistinct("doc_id").alias("n_documents"))


b, d = "banned_medicines", "documents"
QUERIES = {
    "ref_f1_normalize_name": _select(b, "id", lambda: T.normalize_name(F.col("generic_name")).alias("name")),
    "ref_f2_normalize_form": _select(b, "id", lambda: T.normalize_form(F.col("dosage_form")).alias("form")),
    "ref_f3_normalize_strength": _select(b, "id", lambda: T.normalize_strength(F.col("strength")).alias("strength")),
    "ref_f4_normalize_number": _select(b, "id", lambda: T.normalize_number(F.col("notification_number")).alias("number")),
    "ref_f5_normalize_row": _select(
        b, "id", lambda: T.normalize_name(F.col("generic_name")).alias("name"), lambda: T.normalize_form(F.col("dosage_form")).alias("form"), lambda: T.normalize_strength(F.col("strength")).alias("strength"),
        lambda: T.normalize_number(F.col("notification_number")).alias("number"), lambda: F.array_join(T.normalize_brands(F.col("brand_names")), " | ").alias("brands"),
    ),
    "ref_f6_file_name": _select(b, "id", lambda: T.file_name(F.col("notification_number")).alias("file_name")),
    "ref_f7_safe_file_name": _select(b, "id", lambda: T.safe_file_name(F.col("source_pdf")).alias("file_name")),
    "ref_f8_comparable_url": _select(b, "id", lambda: T.comparable_url(F.col("source_pdf")).alias("url")),
    "ref_f9_url_host": _select(b, "id", lambda: T.url_host(F.col("source_url")).alias("host")),
    "ref_f10_split_sources": _select(d, "doc_id", lambda: F.array_join(T.split_sources(F.concat_ws(", ", "source", "lang", F.lit(" "), "source")), "|").alias("parts")),
    "ref_f11_merge_sources": _select(d, "doc_id", lambda: T.merge_sources(F.array(F.concat_ws(",", "source", "lang"), F.upper("source"), F.lit("archive"))).alias("merged")),
    "ref_f12_truncate": _select(d, "doc_id", lambda: F.substring("text", 1, 500).alias("head")),
    "ref_f14_iso_date": _select(b, "id", lambda: F.date_format("notification_date", "yyyy-MM-dd").alias("iso")),
    "ref_x1_extract_number": _select(d, "doc_id", lambda: T.extract_number(F.col("text")).alias("number")),
    "ref_x2_extract_date": _select(d, "doc_id", lambda: T.extract_date(F.col("text")).alias("dated")),
    "ref_x3_parse_date": ref_x3_parse_date,
    "ref_x4_number_and_date": ref_x4_number_and_date,
    "ref_x5_extract_form": _select(d, "doc_id", lambda: T.extract_form(F.col("text")).alias("form")),
    "ref_x6_extract_strength": _select(b, "id", lambda: T.extract_strength(F.col("strength")).alias("amount")),
    "ref_x7_extract_reason": _select(d, "doc_id", lambda: T.extract_reason(F.col("text")).alias("reason")),
    "ref_x8_split_combination": ref_x8_split_combination,
    "ref_x9_number_of_file": _select("notifications_processed", "id", lambda: T.number_of_file(F.col("pdf_path")).alias("number")),
    "ref_t1_numbered_rows": _entries(extract.numbered_rows),
    "ref_t2_combination_lines": _entries(extract.combination_lines),
    "ref_t3_paragraph_names": _entries(extract.paragraph_names),
    "ref_t4_entries": ref_t4_entries,
    "ref_t6_routes": ref_t6_routes,
}

_FORM = (
    r"\b(tablet|capsule|syrup|suspension|injection|cream|ointment|gel|drops?|lotion|powder|solution|inhaler|spray|patch|suppository|respules|oral\s+liquid|"
    r"dry\s+syrup|infusion|emulsion|eye\s+drops?|ear\s+drops?|nasal\s+drops?)\b"
)
_AMOUNT = r"\d+(?:\.\d+)?\s*(?:mg|g|mcg|ml|iu)\b"
_STRENGTH = rf"({_AMOUNT}(?:\s*/\s*{_AMOUNT})?)|(\d+(?:\.\d+)?\s*%)"
_REASONS = [
    r"(?:reason|ground|basis|because|whereas|in\s+the\s+interest\s+of\s+public\s+health)[:\s]+(.{20,500}?)(?:\.\s|$)",
    r"(?:no\s+therapeutic\s+justification|risk\s+to\s+human|irrational|unsafe|hazardous|likely\s+to\s+involve\s+risk).{0,300}?(?:\.\s|$)",
]


def sql_extract_form(c: str) -> str:
    return sql_title(sql_strip(sql_extract(c, _FORM)))


def sql_extract_strength(c: str) -> str:
    return sql_strip(sql_extract(c, _STRENGTH))


def _sql_without(text: str, part: str) -> str:
    """All occurrences of a part gone, whatever their case; the part is quoted for the pattern."""
    quoted = rf"regexp_replace({part}, '([.+*?()\[\]{{}}|^$\\])', '\\\1', 'g')"
    return f"CASE WHEN {part} IS NULL THEN {text} ELSE {sql_strip(f'regexp_replace({text}, {quoted}, {chr(39)}{chr(39)}, {chr(39)}gi{chr(39)})')} END"


def _sql_entries(pattern: str, group: int, least: int, serial: bool, keep: str) -> str:
    name = rf"regexp_replace(b, '^\d+\s*[.\)]\s*', '')" if serial else "b"
    return rf"""
        WITH lines AS (
          SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '(?m){pattern}', {group}), lambda x: {sql_strip('x')}), lambda x: length(x) >= {least}) AS l
          FROM documents WHERE text IS NOT NULL),
        rows AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS raw_text FROM lines),
        parts AS (SELECT *, {sql_extract_form('raw_text')} AS dosage_form, {sql_extract_strength('raw_text')} AS strength FROM rows),
        one AS (SELECT *, {_sql_without('raw_text', 'dosage_form')} AS a FROM parts),
        two AS (SELECT *, {sql_strip(rf"regexp_replace({_sql_without('a', 'strength')}, '[()\[\]{{}}]', '', 'g')")} AS b FROM one),
        named AS (SELECT doc_id, i, regexp_replace({sql_squeeze(name)}, '[.,;:-]+$', '') AS generic_name, dosage_form, strength, raw_text FROM two)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, generic_name, dosage_form, strength, raw_text FROM named WHERE {keep}"""


_SQL_WRITTEN = "CASE id % 9 " + " ".join(f"WHEN {i} THEN strftime(notification_date, '{f}')" for i, f in enumerate(_SQL_DATE_FORMS)) + " ELSE 'vide order of ' || strftime(notification_date, '%d/%m/%Y') END"

SQL = {
    "ref_f1_normalize_name": f"SELECT id, {sql_name('generic_name')} AS name FROM banned_medicines",
    "ref_f2_normalize_form": f"SELECT id, {sql_form('dosage_form')} AS form FROM banned_medicines",
    "ref_f3_normalize_strength": f"SELECT id, {sql_strength('strength')} AS strength FROM banned_medicines",
    "ref_f4_normalize_number": f"SELECT id, {sql_number('notification_number')} AS number FROM banned_medicines",
    "ref_f5_normalize_row": f"""
        SELECT id, {sql_name('generic_name')} AS name, {sql_form('dosage_form')} AS form, {sql_strength('strength')} AS strength, {sql_number('notification_number')} AS number,
          array_to_string(list_transform(list_filter(brand_names, lambda b: {sql_strip('b')} <> ''), lambda b: {sql_name('b')}), ' | ') AS brands FROM banned_medicines""",
    "ref_f6_file_name": "SELECT id, regexp_replace(regexp_replace(regexp_replace(notification_number, '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS file_name FROM banned_medicines",
    "ref_f7_safe_file_name": rf"SELECT id, substring(regexp_replace(regexp_replace(source_pdf, '[<>:\x22/\\|?*]', '_', 'g'), '{WS}+', '_', 'g'), 1, 200) AS file_name FROM banned_medicines",
    "ref_f8_comparable_url": """
        SELECT id, lower(nullif(regexp_extract(source_pdf, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '')) || '://' || lower(nullif(regexp_extract(source_pdf, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), ''))
          || regexp_replace(coalesce(regexp_extract(source_pdf, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/+$', '') AS url FROM banned_medicines""",
    "ref_f9_url_host": "SELECT id, nullif(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') AS host FROM banned_medicines",
    "ref_f10_split_sources": f"""
        SELECT doc_id, array_to_string(list_filter(list_transform(string_split(concat_ws(', ', source, lang, ' ', source), ','), lambda s: {sql_strip('s')}), lambda s: s <> ''), '|') AS parts FROM documents""",
    "ref_f11_merge_sources": f"""
        WITH p AS (SELECT doc_id, list_filter(list_transform(list_concat(string_split(concat_ws(',', source, lang), ','), coalesce([upper(source)], []), ['archive']), lambda s: {sql_strip('s')}), lambda s: s <> '') AS l FROM documents)
        SELECT doc_id, CASE WHEN doc_id IS NOT NULL THEN array_to_string(list_filter(l, lambda s, i: list_position(list_transform(l, lambda x: lower(x)), lower(s)) = i), ', ') END AS merged FROM p""",
    "ref_f12_truncate": "SELECT doc_id, substring(text, 1, 500) AS head FROM documents",
    "ref_f14_iso_date": "SELECT id, strftime(notification_date, '%Y-%m-%d') AS iso FROM banned_medicines",
    "ref_x1_extract_number": f"SELECT doc_id, {sql_extract_number('text')} AS number FROM documents",
    "ref_x2_extract_date": f"SELECT doc_id, {sql_extract_date('text', False)} AS dated FROM documents",
    "ref_x3_parse_date": f"""
        WITH w AS (SELECT id, {_SQL_WRITTEN} AS t FROM banned_medicines WHERE notification_date IS NOT NULL)
        SELECT id, CAST(coalesce({', '.join(f"try_strptime(t, '{f}')" for f in _SQL_DATE_FORMS)}, try_strptime(nullif(regexp_extract(t, '\\d{{1,2}}[-./]\\d{{1,2}}[-./]\\d{{4}}'), ''), '%d/%m/%Y')) AS DATE) AS parsed FROM w""",
    "ref_x4_number_and_date": f"""
        WITH t AS (SELECT id, {sql_squeeze("'vide ' || notification_number || ' Dated ' || strftime(notification_date, '%d.%m.%Y')")} AS t FROM banned_medicines)
        SELECT id, coalesce('G.S.R. ' || {sql_extract('t', _GSR.replace('(' + chr(92) + 'd+)', '(?:NO' + chr(92) + '.?)?' + chr(92) + 's*(' + chr(92) + 'd+)'), 1)} || '(E)',
          'S.O. ' || {sql_extract('t', _SO.replace('(' + chr(92) + 'd+)', '(?:NO' + chr(92) + '.?)?' + chr(92) + 's*(' + chr(92) + 'd+)'), 1)} || '(E)') AS number, {sql_extract_date('t')} AS dated FROM t""",
    "ref_x5_extract_form": f"SELECT doc_id, {sql_extract_form('text')} AS form FROM documents",
    "ref_x6_extract_strength": f"SELECT id, {sql_extract_strength('strength')} AS amount FROM banned_medicines",
    "ref_x7_extract_reason": f"SELECT doc_id, substring({sql_squeeze('coalesce(' + ', '.join(sql_extract('text', p, 0, 'is') for p in _REASONS) + ')')}, 1, 500) AS reason FROM documents",
    "ref_x8_split_combination": rf"""
        WITH p AS (SELECT id, generic_name, list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(generic_name, '({WS})(?:and|AND|And)({WS})', '\1+\2', 'g'), '&', '+', 'g'), '\+'),
          lambda x: regexp_replace({sql_strip('x')}, '^[,.-]+|[,.-]+$', '', 'g')), lambda x: {sql_strip('x')} <> '') AS l FROM banned_medicines)
        SELECT id, coalesce(len(l) > 1, false) AS is_fdc, CASE WHEN len(l) > 1 THEN array_to_string(l, ' | ') WHEN {sql_strip('generic_name')} <> '' THEN {sql_strip('generic_name')} ELSE '' END AS ingredients FROM p""",
    "ref_x9_number_of_file": r"""
        WITH s AS (SELECT id, regexp_replace(regexp_replace(pdf_path, '^.*/', ''), '\.[^.]*$', '') AS s FROM notifications_processed)
        SELECT id, coalesce('G.S.R. ' || nullif(regexp_extract(s, '^G_?S_?R_(?:No_)?(\d+)', 1, 'i'), '') || '(E)', 'S.O. ' || nullif(regexp_extract(s, '^S_?O_(?:No_)?(\d+)', 1, 'i'), '') || '(E)') AS number FROM s""",
    "ref_t1_numbered_rows": _sql_entries(r"^\s*(\d{1,4})\s*[.\)]\s*(.+)", 2, 3, False, "generic_name <> ''"),
    "ref_t2_combination_lines": _sql_entries(r"^.*?\b\w+\s*\+\s*\w+.*$", 0, 5, True, "contains(generic_name, '+')"),
}

#: letters outside ASCII count as parts of words, as they do for Spark's patterns
_PLAIN_LETTERS = r"regexp_replace(s, '[\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2c1}\p{Lo}\p{M}]', '_', 'g')"
_CAPITALS = ", ".join(f"'{w}'" for w in lexicon.PLAIN_CAPITALS)
SQL["ref_t3_paragraph_names"] = rf"""
    WITH l AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.;\n]'), lambda x: {sql_strip('x')}), lambda x: length(x) >= 10) AS l FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS s FROM l),
    n AS (SELECT *, list_filter(regexp_extract_all({_PLAIN_LETTERS}, '\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b', 1), lambda x: length(x) >= 4 AND x NOT IN ({_CAPITALS})) AS names FROM s),
    e AS (SELECT doc_id, i, generate_subscripts(names, 1) AS j, unnest(names) AS generic_name, {sql_extract_form('s')} AS dosage_form, {sql_extract_strength('s')} AS strength, substring(s, 1, 500) AS raw_text FROM n WHERE len(names) > 0)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS INTEGER) AS pos, generic_name, dosage_form, strength, raw_text FROM e"""
SQL["ref_t4_entries"] = f"""
    WITH t1 AS ({SQL['ref_t1_numbered_rows']}), t2 AS ({SQL['ref_t2_combination_lines']}), t3 AS ({SQL['ref_t3_paragraph_names']}),
    s AS (SELECT *, 0 AS k FROM t1 UNION ALL SELECT *, 1 FROM t2 WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.doc_id = t2.doc_id AND lower(t1.generic_name) = lower(t2.generic_name))),
    g AS (SELECT * FROM s UNION ALL SELECT *, 2 FROM t3 WHERE doc_id NOT IN (SELECT doc_id FROM s)),
    a AS (SELECT * FROM g UNION ALL SELECT doc_id, 0, CASE WHEN text IS NULL THEN '{extract.UNREADABLE}' ELSE '{extract.NO_ENTRIES}' END, NULL, NULL, substring(text, 1, 2000), 3 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM g)),
    x1 AS ({SQL['ref_x1_extract_number']}), x2 AS ({SQL['ref_x2_extract_date']}), x7 AS ({SQL['ref_x7_extract_reason']})
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k, pos) - 1 AS INTEGER) AS pos, generic_name, dosage_form, strength, raw_text, CASE WHEN k < 2 THEN 'ok' ELSE 'needs_review' END AS parsing_status,
      number AS notification_number, dated AS notification_date, CASE WHEN k < 3 THEN reason END AS ban_reason
    FROM a JOIN x1 USING (doc_id) JOIN x2 USING (doc_id) JOIN x7 USING (doc_id)"""
SQL["ref_t6_routes"] = f"""
    WITH e AS ({SQL['ref_t4_entries']}), banned_medicines AS (SELECT row_number() OVER () AS id, * FROM e), x AS ({SQL['ref_x8_split_combination']})
    SELECT CASE WHEN generic_name IN ('{extract.NO_ENTRIES}', '{extract.UNREADABLE}') THEN 'failed' WHEN parsing_status = 'needs_review' THEN 'review' ELSE 'keep' END AS route, is_fdc,
      count(*) AS n_entries, count(DISTINCT doc_id) AS n_documents FROM banned_medicines JOIN x USING (id) GROUP BY 1, 2"""
