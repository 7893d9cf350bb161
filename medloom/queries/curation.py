"""Queries of the general data problems: orphan references, units, packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.numbers import sortable_key
from medloom.operators import multivalue, orphans, units
from medloom.tables import table

#: Tables that refer to notifications, and the time a row of each is dated by.
REFERRING = {"unofficial_medicines": "date_added", "ayush_fssai_medicines": "date_added", "notifications_processed": "last_attempt"}


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    refs = None
    for name, time in REFERRING.items():
        rows = table(spark, folder, name).select(
            F.lit(name).alias("table_name"), "id", sortable_key(F.col("notification_number")).alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("time"), F.date_format(time, "yyyy-MM").alias("period_ym")
        )
        refs = rows if refs is None else refs.unionAll(rows)
    live = table(spark, folder, "banned_medicines").select(sortable_key(F.col("notification_number")).alias("key"), F.unix_micros(F.col("date_added").cast("timestamp")).alias("since"), F.lit(True).alias("live"))
    removed = table(spark, folder, "removed_medicines").select(sortable_key(F.col("notification_number")).alias("key"), F.lit(None).cast("bigint").alias("since"), F.lit(False).alias("live"))
    return orphans.orphans(refs, live.unionAll(removed))


def p3_orphans_by_period(spark: SparkSession, folder: str) -> DataFrame:
    return p3_found(spark, folder).groupBy("table_name", "period_ym", "orphan_state").agg(F.count("*").alias("n_rows"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = None
    for name in ("banned_medicines", "ayush_fssai_medicines"):
        part = table(spark, folder, name).select(F.lit(name).alias("table_name"), "id", "strength", "ban_reason")
        rows = part if rows is None else rows.unionAll(part)
    return units.quantities(rows, ["table_name", "id"], F.col("strength"), F.col("ban_reason"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select("id", "generic_name", "ingredients", "brand_names")
    return multivalue.split_fields(rows, "id", ["generic_name", "ingredients", "brand_names"])


_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
_BL = r"[ \x{0b}\x{0c}\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def sql_squeezed(c: str) -> str:
    return rf"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'), ' ')"


def sql_number_key(c: str) -> str:
    packed = f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"
    digits = f"regexp_extract({packed}, '^(gsr|so|circular|circ|cir)(?:no)?0*([0-9]+)e?$', 2)"
    return f"CASE WHEN {digits} <> '' THEN upper({packed}[1]) || ':' || {digits} END"


def _sql_orphans() -> str:
    asked = " UNION ALL ".join(f"SELECT '{t}' AS table_name, id, {sql_number_key('notification_number')} AS k, {c} AS t FROM {t}" for t, c in REFERRING.items())
    return f"""
        WITH r AS ({asked}), live AS (SELECT {sql_number_key('notification_number')} AS k, min(date_added) AS since FROM banned_medicines GROUP BY 1 HAVING k IS NOT NULL),
        gone AS (SELECT DISTINCT {sql_number_key('notification_number')} AS k FROM removed_medicines),
        s AS (SELECT table_name, id, strftime(t, '%Y-%m') AS period_ym, CASE WHEN live.k IS NOT NULL THEN CASE WHEN since > t THEN 'late' END WHEN r.k IN (SELECT k FROM gone WHERE k IS NOT NULL) THEN 'deleted' ELSE 'missing' END AS orphan_state
          FROM r LEFT JOIN live ON r.k = live.k WHERE r.k IS NOT NULL)
        SELECT * FROM s WHERE orphan_state IS NOT NULL"""


def _sql_quantities() -> str:
    thousands = lambda t: rf"regexp_replace({t}, '(^|[^0-9.,])([1-9][0-9]{{0,2}}),([0-9]{{3}})($|[^0-9])', '\1\2\3\4', 'g')"
    plain = rf"translate(lower({sql_squeezed('strength')}), 'µμ', 'uu')"
    for a, b in ((r"(^|[^a-z])i\. ?u\.?", r"\1iu"), ("international units?", "iu"), ("parts per million", "ppm"), (r"per ?cent\b", "%")):
        plain = f"regexp_replace({plain}, '{a}', '{b}', 'g')"
    plain = rf"regexp_replace({thousands(thousands(plain))}, '([0-9]),([0-9])', '\1.\2', 'g')"
    q = units.QUANTITY
    part = lambda x, i: f"nullif(regexp_extract({x}, '{q}', {i}), '')"
    values = ", ".join(f"('{a}', '{d}', {f}, {o})" for a, (d, f, o) in units.UNITS.items())
    case = lambda x, names: "CASE " + x + " " + " ".join(f"WHEN '{a}' THEN {v}" for a, v in names.items()) + " END"
    named = "lower(translate(ban_reason, 'µμ', 'uu'))"
    text_unit = f"regexp_replace(coalesce(nullif(regexp_extract({named}, '{units.TEXT_UNIT}', 1), ''), nullif(regexp_extract({named}, '{units.TEXT_UNIT}', 2), '')), 'international units', 'iu')"
    return f"""
        WITH b AS (SELECT 'banned_medicines' AS table_name, id, strength, ban_reason FROM banned_medicines UNION ALL SELECT 'ayush_fssai_medicines', id, strength, ban_reason FROM ayush_fssai_medicines),
        p AS (SELECT table_name, id, {plain} AS s, {text_unit} AS tu FROM b WHERE regexp_matches(strength, '[0-9]')),
        l AS (SELECT table_name, id, s, tu, regexp_extract_all(s, '{q}') AS qs FROM p),
        x AS (SELECT table_name, id, generate_subscripts(qs, 1) - 1 AS pos, unnest(qs) AS q, coalesce({part('qs[-1]', 4)}, {part('qs[-1]', 1)}, CASE WHEN regexp_matches(s, '^[0-9.,/+& -]+$') THEN tu END) AS spare FROM l),
        a AS (SELECT *, coalesce({part('q', 4)}, {part('q', 1)}, spare) AS alias FROM x),
        u(alias, dimension, factor, plus) AS (VALUES {values}),
        r AS (SELECT table_name, id, pos, dimension, CAST({part('q', 2)} AS DOUBLE) * coalesce({case(part('q', 3), units.SCALES)}, 1.0) * factor + plus AS base, replace({part('q', 5)}, ' ', '') AS basis,
          coalesce(CAST({part('q', 6)} AS DOUBLE), 1.0) AS per, {case(part('q', 7), units.VOLUMES)} AS ml, {case(part('q', 8), units.WEIGHTS)} AS g FROM a JOIN u USING (alias)),
        o AS (SELECT *, CASE WHEN dimension = 'percent' THEN CASE coalesce(basis, 'w/v') WHEN 'w/v' THEN 'mcg/ml' WHEN 'w/w' THEN 'mcg/g' END WHEN dimension = 'fraction' THEN 'mcg/g'
          WHEN dimension = 'mass' THEN CASE WHEN ml IS NOT NULL THEN 'mcg/ml' WHEN g IS NOT NULL THEN 'mcg/g' ELSE 'mcg' END WHEN ml IS NOT NULL THEN 'iu/ml' WHEN g IS NULL THEN 'iu' END AS unit FROM r)
        SELECT table_name, id, CAST(pos AS INTEGER) AS pos, CAST(round(CASE WHEN dimension IN ('mass', 'iu') THEN base / coalesce(per * ml, g, 1.0) ELSE base END) AS BIGINT) AS amount, unit
        FROM o WHERE unit IS NOT NULL AND (per > 0 OR ml IS NULL)"""


def _sql_packed() -> str:
    tokens = rf"regexp_extract_all(e, '\x22[^\x22]*\x22|“[^”]*”|''[^'']*''|\([^()]*\)|\[[^\[\]]*\]|{_BL}+|[^\s\x{{0b}}\x{{85}}\x{{a0}}+＋&/|;,\x22“(\[]+|[+＋&/|;,\t\n\r\x22“(\[]')"
    space = lambda x: f"regexp_full_match({x}, '{_WS}+')"
    mark = f"CASE WHEN regexp_full_match(x, '[+＋&/|;,\\t\\n\\r]') OR (lower(x) IN ('and', 'with', 'plus') AND i > 1 AND coalesce({space('t[i - 1]')}, false) AND coalesce({space('t[i + 1]')}, false)) THEN chr(1) ELSE x END"
    edge = r"^[\x22“”''.,;:\s\x{a0}]+|[\x22“”''.,;:\s\x{a0}]+$"
    clean = f"list_filter(list_transform(string_split(array_to_string(list_transform(t, lambda x, i: {mark}), ''), chr(1)), lambda v: regexp_replace({sql_squeezed('v')}, '{edge}', '', 'g')), lambda v: v <> '')"
    return f"""
        WITH f AS (SELECT id, 'generic_name' AS field_name, [generic_name] AS l FROM banned_medicines UNION ALL SELECT id, 'ingredients', ingredients FROM banned_medicines UNION ALL SELECT id, 'brand_names', brand_names FROM banned_medicines),
        e AS (SELECT id, field_name, generate_subscripts(l, 1) AS o, unnest(l) AS e FROM f),
        t AS (SELECT id, field_name, o, {tokens} AS t FROM e WHERE e IS NOT NULL),
        v AS (SELECT id, field_name, o, {clean} AS vs FROM t),
        g AS (SELECT id, field_name, flatten(list(vs ORDER BY o)) AS vs FROM v GROUP BY ALL HAVING max(len(vs)) > 1)
        SELECT id, field_name, CAST(generate_subscripts(vs, 1) - 1 AS INTEGER) AS pos, unnest(vs) AS val FROM g"""


SQL = {
    "p3_found": _sql_orphans(),
    "p3_orphans_by_period": f"SELECT table_name, period_ym, orphan_state, count(*) AS n_rows FROM ({_sql_orphans()}) GROUP BY ALL",
    "p4_found": _sql_quantities(),
    "p6_found": _sql_packed(),
}
QUERIES = {"p3_found": p3_found, "p3_orphans_by_period": p3_orphans_by_period, "p4_found": p4_found, "p6_found": p6_found}
