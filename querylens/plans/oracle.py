"""The registered queries as SQL for another engine.

Word lists, patterns and rules are the library's, as they are fixed values;
what is done with them is stated here in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from querylens.functions import text
from querylens.functions.brands import EXCLUSIONS, GENERIC_QUERIES, OVERRIDES, Rule
from querylens.operators.quality import CHECKS
from querylens.plans.shapes import DIRTY_DOCUMENTS, DIRTY_LABELS, ORDERS_PER_DOCUMENT, RULE_CASES, SET_DATES


def _pct(part: str, whole: str) -> str:
    """100 * part / whole to two places, half up, in whole numbers."""
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * nullif({whole}, 0)) AS DOUBLE) / 100"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Sequence[str]) -> str:
    return "[" + ", ".join(map(_quoted, values)) + "]"


def _removed(column: str, *steps: tuple[str, str]) -> str:
    """Every match of each pattern replaced, one pattern after the other."""
    for pattern, replacement in steps:
        column = f"regexp_replace({column}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
    return column


def _any_rule(rules: Sequence[Rule]) -> str:
    def test(rule: Rule) -> str:
        column = {"query": "q", "raw": "query_raw"}[rule.field]
        pattern = _quoted(rule.pattern)
        found = f"regexp_matches({column}, {pattern})" if rule.regex else f"{column} LIKE {pattern}"
        return f"(b LIKE {_quoted(rule.brand)} AND {found})"

    return "(" + "\n  OR ".join(map(test, rules)) + ")"


_MEASURES = """
    CAST(floor(l_quantity * l_tax) AS BIGINT) AS clicks,
    l_tax AS ctr,
    CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(floor(l_quantity) AS BIGINT) END AS impressions,
    CAST(1 + round(l_discount * 100) AS DOUBLE) AS position"""

_BRANDS = """
brands AS (
  SELECT s_suppkey AS restaurant_id,
         CASE s_suppkey % 5 WHEN 0 THEN adj || '-' || noun WHEN 1 THEN noun || adj || 'ok' ELSE adj || noun END
           || CASE WHEN s_suppkey % 2 = 0 THEN '.com' ELSE '.net' END AS domain,
         noun, kind
  FROM (SELECT s_suppkey, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun, lower(p_type) AS kind
        FROM supplier JOIN part ON p_partkey = s_suppkey))"""

_FLAT = f"""{_BRANDS},
flat AS (
  SELECT l_suppkey AS restaurant_id, domain, l_orderkey, l_orderkey // {ORDERS_PER_DOCUMENT} AS chunk,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS reported, {_MEASURES},
         CASE l_linenumber
           WHEN 1 THEN p_name WHEN 2 THEN p_name || ' near me' WHEN 3 THEN p_name || ' menu' WHEN 4 THEN p_name || ' $20'
           WHEN 5 THEN split_part(p_name, ' ', 2) || 's'
           WHEN 6 THEN split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) || 's & grill'
           ELSE split_part(p_name, ' ', 1) END AS query
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN brands ON restaurant_id = l_suppkey)"""

_LABELS = """
labels AS (
  SELECT restaurant_id, noun AS cuisine FROM brands WHERE restaurant_id % 10 <> 0
  UNION ALL SELECT restaurant_id, kind FROM brands WHERE restaurant_id % 10 <> 0
  UNION ALL SELECT restaurant_id, noun FROM brands WHERE restaurant_id % 10 <> 0 AND restaurant_id % 7 = 0)"""

_CASE = f"(l_partkey + l_linenumber) % {len(RULE_CASES)} + 1"
_RULES = f"""
ruled AS (
  SELECT l_suppkey AS restaurant_id, ({_list([d for _, d in RULE_CASES])})[{_CASE}] AS domain, {_MEASURES},
         ({_list([q for q, _ in RULE_CASES])})[{_CASE}]
           || CASE WHEN l_linenumber % 3 = 0 THEN ' ' || (l_orderkey % 100) ELSE '' END AS query
  FROM lineitem)"""

_ALL_NAMES = """
names AS (
  SELECT cuisine FROM labels UNION SELECT unnest(['thai', 'indian', 'pizza', 'mediterranean']))"""

_KEPT_CHARACTERS = _removed(
    "query",
    (rf"\b{text.EXTRANEOUS_TERMS}\b", ""),
    (text.PRICES_AND_AMPERSAND, ""),
    (text.OTHER_CHARACTERS, ""),
    (text.SPACES, " "),
)
_CLEANED = f"trim({_removed(f'lower({_KEPT_CHARACTERS})', (text.TRAILING_S, ''))})"
_BRAND = _removed("domain", (text.DOMAIN_SUFFIX, ""), (text.DOMAIN_SEPARATORS, " "))

_PAIRS = f"""
pairs AS (
  SELECT query AS query_raw, domain, n_rows, {_CLEANED} AS q, {_BRAND} AS b
  FROM (SELECT query, domain, count(*) AS n_rows
        FROM (SELECT query, domain FROM flat UNION ALL SELECT query, domain FROM ruled) GROUP BY ALL))"""

_FUZZY = "jaro_winkler_similarity(q, b) >= 0.78"
_SUBSTRING = "(contains(replace(q, ' ', ''), b) OR contains(b, replace(q, ' ', '')))"
_TOKENS = """(len(list_filter(string_split(q, ' ')[1:3], lambda w: length(w) > 1 AND contains(b, w))) >= 2
  AND NOT contains(query_raw, 'near me') AND NOT (query_raw LIKE '%india% in%' AND query_raw LIKE '%in% india%'))"""
_PREFIX = "starts_with(lower(b), lower(string_split(q, ' ')[1]))"
_GENERAL = f"""(length(q) <= 1 OR q IN (SELECT cuisine FROM names) OR list_contains({_list(GENERIC_QUERIES)}, q)
  OR {_any_rule(EXCLUSIONS)})"""
_OVERRIDE = _any_rule(OVERRIDES)
_TYPE = f"""CASE WHEN (NOT {_GENERAL} AND ({_FUZZY} OR {_SUBSTRING} OR {_TOKENS} OR {_PREFIX})) OR {_OVERRIDE}
  THEN 'Branded' ELSE 'Unbranded' END"""

_CLASSIFIED = f"""
names AS (SELECT DISTINCT cuisine FROM labels),
classified AS (
  SELECT restaurant_id, domain, reported, clicks, ctr, impressions, position, query_raw, q AS query_cleaned,
         b AS domain_name_cleaned, round(100 * jaro_winkler_similarity(q, b), 6) AS jarrow_similarity,
         {_TYPE} AS search_type
  FROM (SELECT *, query AS query_raw, {_CLEANED} AS q, {_BRAND} AS b FROM flat))"""

_SHARES = {
    "pct_unique_search_queries": "search_query_count",
    "pct_clicks": "total_clicks",
    "pct_impressions": "total_impressions",
}


def _rates(group: str) -> str:
    """The published columns of rows with sums ``n_queries, c, n, w``; shares within ``group``."""
    shares = ", ".join(f"{_pct(of, f'sum({of}) OVER (PARTITION BY {group})')} AS {name}" for name, of in _SHARES.items())
    return f"""* EXCLUDE (n_queries, c, n, w), CAST(n_queries AS BIGINT) AS search_query_count,
         CAST(c AS BIGINT) AS total_clicks, CAST(n AS BIGINT) AS total_impressions, {_pct("c", "n")} AS ctr,
         round(w / nullif(n, 0), 6) AS avg_position, {shares}"""


def _unified(n_queries: str) -> str:
    """All grains from one list: each query of a restaurant, once for itself, once per cuisine, once overall."""
    return f"""WITH {_FLAT}, {_LABELS}, {_CLASSIFIED},
per_query AS (
  SELECT restaurant_id, domain, search_type, query_raw, sum(clicks) AS c, sum(impressions) AS n,
         sum(position * impressions) AS w
  FROM classified GROUP BY ALL),
placed AS (
  SELECT 'restaurant' AS grain, CAST(restaurant_id AS VARCHAR) AS restaurant_id, NULL AS cuisine, domain,
         search_type, query_raw, c, n, w FROM per_query
  UNION ALL SELECT 'cuisine', NULL, cuisine, NULL, search_type, query_raw, c, n, w
  FROM labels JOIN per_query USING (restaurant_id)
  UNION ALL SELECT 'global', NULL, NULL, NULL, search_type, query_raw, c, n, w FROM per_query),
sums AS (
  SELECT grain, restaurant_id, cuisine, domain, search_type, {n_queries} AS n_queries,
         sum(c) AS c, sum(n) AS n, sum(w) AS w
  FROM placed GROUP BY ALL),
unified AS (SELECT {_rates("grain, restaurant_id, cuisine")} FROM sums)"""


_UNIFIED = _unified("count(query_raw)")
_EXACT = _unified("count(DISTINCT query_raw)")

# Of each restaurant the third of the orders that the last load with it brought.
_LOADED = _UNIFIED.replace(
    "FROM flat))",
    """FROM flat
  WHERE l_orderkey % 3 = CASE WHEN restaurant_id % 3 = 0 THEN 2 WHEN restaurant_id % 2 = 0 THEN 1 ELSE 0 END))""",
)

# The cuisines of a restaurant as they were stored on several dates, and the month's set that was the last by then.
_SET_DATES = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(SET_DATES))
_ASOF = f"""WITH {_FLAT}, {_LABELS}, {_CLASSIFIED},
stored(i, snapshot_date) AS (VALUES {_SET_DATES}),
dated AS (
  SELECT snapshot_date, restaurant_id, CASE WHEN (restaurant_id + i) % 3 = 0 THEN 'fusion' ELSE cuisine END AS cuisine
  FROM labels CROSS JOIN stored WHERE (restaurant_id + i) % 4 <> 0),
in_effect AS (
  SELECT reported, snapshot_date
  FROM (SELECT DISTINCT reported FROM classified) months ASOF JOIN stored ON months.reported >= stored.snapshot_date),
per_query AS (
  SELECT reported, restaurant_id, domain, search_type, query_raw, sum(clicks) AS c, sum(impressions) AS n,
         sum(position * impressions) AS w
  FROM classified GROUP BY ALL),
sums AS (
  SELECT CAST(reported AS VARCHAR) AS reported, CAST(snapshot_date AS VARCHAR) AS snapshot_date, cuisine, search_type,
         count(query_raw) AS n_queries, sum(c) AS c, sum(n) AS n, sum(w) AS w
  FROM per_query JOIN in_effect USING (reported) JOIN dated USING (snapshot_date, restaurant_id) GROUP BY ALL)
SELECT {_rates("reported, cuisine")} FROM sums"""

_METRICS = """search_query_count, total_clicks, total_impressions, ctr, avg_position,
  pct_unique_search_queries, pct_clicks, pct_impressions"""


_RESIDUAL = """SELECT * FROM (WITH
entity AS (
  SELECT restaurant_id, round(w / n) AS bin, w / n AS exact_position, u.ctr, n, c
  FROM unified u JOIN sums USING (grain, restaurant_id, domain, search_type)
  WHERE grain = 'restaurant' AND search_type = 'Unbranded' AND n > 0),
expected AS (
  SELECT *, 100.0 * CAST(sum(c) OVER (PARTITION BY bin) - c AS DOUBLE)
            / nullif(CAST(sum(n) OVER (PARTITION BY bin) - n AS DOUBLE), 0) AS e FROM entity)
SELECT restaurant_id, CAST(bin AS BIGINT) AS pos_bin, round(exact_position, 6) AS avg_position, ctr,
       round(e, 6) AS expected_ctr, round(ctr - e, 6) + 0.0 AS position_ctr_residual,
       round(greatest(0, e - ctr), 6) AS nboi_click_gap_pct,
       round(greatest(0, e - ctr) / 100 * n, 6) AS nboi_click_opportunity,
       CAST(n AS BIGINT) AS total_impressions, CAST(c AS BIGINT) AS total_clicks,
       CASE WHEN n * (e / 100) * (1 - e / 100) > 0
            THEN round((c - n * (e / 100)) / sqrt(n * (e / 100) * (1 - e / 100)), 6) + 0.0 END AS residual_z_score
FROM expected WHERE e IS NOT NULL)"""


def _flag(name: str, test: str) -> str:
    return (
        f"WITH {_FLAT}, {_LABELS}, {_RULES}, {_ALL_NAMES}, {_PAIRS} "
        f"SELECT query_raw, domain, n_rows, {test} AS {name} FROM pairs"
    )


_LATEST = """
  SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1"""


def _intervals(source: str) -> str:
    return f"""
observed AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE {source}),
intervals AS (
  SELECT user_id, event_type, ts AS start_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts
  FROM observed WHERE before IS DISTINCT FROM event_type)"""


_TEXT_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _check(table: str, column: str, check: str, count: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST({count} AS BIGINT) AS failing_rows FROM {source}"
    )


def _null_check(table: str, column: str, source: str) -> str:
    return _check(table, column, "not_null", f"count(*) FILTER ({column} IS NULL)", source)


def _quality() -> str:
    repeated = "(SELECT cuisine FROM {0} WHERE cuisine IS NOT NULL GROUP BY cuisine HAVING count(*) > 1)"
    columns = ("restaurant_id", "domain", "clicks", "ctr", "impressions", "position", "query")
    parts = [_null_check("queries", c, "flat") for c in columns]
    parts += [
        _null_check("label_names", "cuisine", "names"),
        _check("label_names", "cuisine", "unique", "count(*)", repeated.format("names")),
        _null_check("broken_queries", "clicks", "broken_queries"),
        _null_check("broken_queries", "query", "broken_queries"),
        _check(
            "broken_queries",
            "query",
            "not_null where impressions > 0",
            "count(*) FILTER (impressions > 0 AND query IS NULL)",
            "broken_queries",
        ),
        _null_check("broken_label_names", "cuisine", "broken_names"),
        _check("broken_label_names", "cuisine", "unique", "count(*)", repeated.format("broken_names")),
        _null_check("broken_classified", "domain", "broken_classified"),
        _check(
            "broken_classified",
            "search_type",
            "accepted_values",
            "count(*) FILTER (search_type NOT IN ('Branded', 'Unbranded'))",
            "broken_classified",
        ),
    ]
    return f"""WITH {_FLAT}, {_LABELS}, {_RULES},
names AS (SELECT DISTINCT cuisine FROM labels),
broken_queries AS (SELECT * REPLACE (CASE WHEN clicks > 0 THEN query END AS query) FROM flat),
broken_names AS (SELECT CASE WHEN cuisine <> 'ring' THEN cuisine END AS cuisine FROM labels),
broken_classified AS (
  SELECT CASE WHEN impressions > 40 THEN domain END AS domain,
         CASE WHEN clicks > 2 THEN 'Other' ELSE 'Branded' END AS search_type FROM ruled)
{" UNION ALL ".join(parts)}"""


def _declared() -> str:
    """The declared checks, counted over this file's versions of the tables."""
    sources = {
        "search_export": "documents_packed",
        "label_export": "lists_packed",
        "queries": "flat",
        "label_names": "names",
        "classified_queries": "classified",
        "restaurant_metrics": "(SELECT * FROM unified WHERE grain = 'restaurant')",
        "cuisine_metrics": "(SELECT * FROM unified WHERE grain = 'cuisine')",
        "unified_metrics": "unified",
        "ctr_residual": "residual",
    }
    parts = []
    for check in CHECKS:
        source, column = sources[check.table], check.column
        if check.kind == "unique":
            source = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            count = "count(*)"
        elif check.kind == "not_null":
            count = f"count(*) FILTER ({column} IS NULL AND {check.where or 'true'})"
        else:
            count = f"count(*) FILTER (NOT list_contains({_list(check.values)}, {column}))"
        name = check.kind + (f" where {check.where}" if check.where else "")
        parts.append(_check(check.table, column, name.replace("'", "''"), count, source))
    return f"""{_UNIFIED}, residual AS ({_RESIDUAL}),
documents_packed AS (SELECT DISTINCT restaurant_id, domain, chunk AS data, chunk AS _updated_at FROM flat),
lists_packed AS (SELECT restaurant_id, list(cuisine) AS cuisines FROM labels GROUP BY ALL)
{" UNION ALL ".join(parts)}"""


# What each dirty document is to give, written down case by case instead of parsed: (case, clicks, ctr, position, query).
_DIRTY_DOCUMENTS = f"""WITH lines AS (
  SELECT l_suppkey AS restaurant_id, l_orderkey || '-' || l_linenumber AS domain,
         CAST(floor(l_quantity) AS BIGINT) AS v, (l_orderkey + l_linenumber) % {len(DIRTY_DOCUMENTS)} AS k FROM lineitem),
found AS (
  SELECT restaurant_id, domain, v AS clicks, 0.5 AS ctr, NULL AS position, 'first ' || v AS query FROM lines WHERE k = 0
  UNION ALL SELECT restaurant_id, domain, 1, NULL, 2, 'second' FROM lines WHERE k = 0
  UNION ALL SELECT restaurant_id, domain, v, NULL, NULL, NULL FROM lines WHERE k IN (7, 9, 11, 12, 17)
  UNION ALL SELECT restaurant_id, domain, v + 1, NULL, NULL, NULL FROM lines WHERE k = 8
  UNION ALL SELECT restaurant_id, domain, NULL, NULL, NULL, NULL FROM lines WHERE k = 10
  UNION ALL SELECT restaurant_id, domain, NULL, NULL, NULL, 'a ' || v FROM lines WHERE k = 13
  UNION ALL SELECT restaurant_id, domain, NULL, NULL, NULL, NULL FROM lines, range(2) WHERE k = 19)
SELECT restaurant_id, domain, CAST(clicks AS BIGINT) AS clicks, CAST(ctr AS DOUBLE) AS ctr,
       CAST(NULL AS BIGINT) AS impressions, CAST(position AS DOUBLE) AS position, query FROM found"""
_DIRTY_LABELS = f"""WITH lists AS (SELECT p_partkey AS restaurant_id, p_name, p_partkey % {len(DIRTY_LABELS)} AS k FROM part)
SELECT restaurant_id, p_name AS cuisine FROM lists WHERE k IN (0, 1, 4, 6)
UNION ALL SELECT restaurant_id, p_name FROM lists WHERE k = 1
UNION ALL SELECT restaurant_id, NULL FROM lists WHERE k = 4
UNION ALL SELECT restaurant_id, '' FROM lists WHERE k = 7
UNION ALL SELECT restaurant_id, '5' FROM lists WHERE k = 8"""


def _interval_join(join: str) -> str:
    return f"""WITH {_intervals("event_type <> 'purchase'")}
SELECT e.user_id, e.event_id, {_TEXT_TIME.format("e.ts")} AS ts, e.value, i.event_type,
       {_TEXT_TIME.format("i.start_ts")} AS effective_start_date,
       {_TEXT_TIME.format("i.end_ts")} AS effective_end_date
FROM (SELECT * FROM events WHERE event_type = 'purchase') e {join} intervals i
  ON e.user_id = i.user_id AND e.ts >= i.start_ts AND (i.end_ts IS NULL OR e.ts < i.end_ts)"""


_FLAT_COLUMNS = "restaurant_id, domain, clicks, ctr, impressions, position, query"

ORACLE_SQL: dict[str, str] = {
    "flatten_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "flatten_search_export": f"WITH {_FLAT} SELECT {_FLAT_COLUMNS} FROM flat",
    "flatten_dirty_export": _DIRTY_DOCUMENTS,
    "flatten_dirty_labels": _DIRTY_LABELS,
    "flatten_labels": f"WITH {_BRANDS}, {_LABELS} SELECT restaurant_id, cuisine FROM labels",
    "label_names": f"WITH {_BRANDS}, {_LABELS} SELECT DISTINCT cuisine FROM labels",
    "normalize_query": f"""WITH {_FLAT}, {_RULES}
SELECT query, n_rows, {_CLEANED} AS query_cleaned
FROM (SELECT query, count(*) AS n_rows FROM (SELECT query FROM flat UNION ALL SELECT query FROM ruled) GROUP BY query)""",
    "brand_name": f"""WITH {_FLAT}, {_RULES}
SELECT domain, n_rows, {_BRAND} AS domain_name_cleaned
FROM (SELECT domain, count(*) AS n_rows FROM (SELECT domain FROM flat UNION ALL SELECT domain FROM ruled) GROUP BY domain)""",
    "jaro_winkler_score": f"""WITH {_FLAT}, {_RULES}, {_PAIRS}
SELECT DISTINCT q AS query_cleaned, b AS domain_name_cleaned, round(jaro_winkler_similarity(q, b), 6) AS score FROM pairs""",
    "match_fuzzy": _flag("matched", _FUZZY),
    "match_substring": _flag("matched", _SUBSTRING),
    "match_tokens": _flag("matched", _TOKENS),
    "match_prefix": _flag("matched", _PREFIX),
    "exclude_false_positives": _flag("excluded", _GENERAL),
    "brand_overrides": _flag("overridden", _OVERRIDE),
    "indexed_rules": f"""WITH {_FLAT}, {_RULES}, {_PAIRS},
rules AS (
  SELECT DISTINCT p_partkey % 4 = 1 AND p_partkey % 5 = 0 AS regex, p_partkey % 3 = 2 AS of_raw,
         CASE p_partkey % 4 WHEN 0 THEN adj || '%' WHEN 1 THEN '%' || noun || '%' WHEN 2 THEN '%' || substr(noun, 2, 3) || '%ok'
           ELSE '%' END AS brand,
         CASE WHEN p_partkey % 4 = 1 AND p_partkey % 5 = 0 THEN '^' || adj || '.*(menu|near)'
           WHEN p_partkey % 3 = 0 THEN '%' || noun || 's%' WHEN p_partkey % 3 = 1 THEN adj || ' ' || noun || '_%'
           ELSE '_%' || substr(noun, 2, 3) || '% near%' END AS pattern
  FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun FROM part)),
fitting AS (
  SELECT DISTINCT query_raw, domain FROM pairs JOIN rules ON b LIKE brand AND CASE
    WHEN regex THEN regexp_matches(query_raw, pattern) WHEN of_raw THEN query_raw LIKE pattern ELSE q LIKE pattern END)
SELECT p.query_raw, p.domain, p.n_rows, f.domain IS NOT NULL AS ruled
FROM pairs p LEFT JOIN fitting f ON f.query_raw = p.query_raw AND f.domain = p.domain""",
    "classify_queries": f"WITH {_FLAT}, {_LABELS}, {_CLASSIFIED} SELECT * EXCLUDE (reported) FROM classified",
    "classify_rules": f"""WITH {_BRANDS}, {_LABELS}, {_RULES}, {_ALL_NAMES}
SELECT query_raw, domain, n_rows, clicks, q AS query_cleaned, b AS domain_name_cleaned, {_TYPE} AS search_type
FROM (SELECT query AS query_raw, domain, count(*) AS n_rows, CAST(sum(clicks) AS BIGINT) AS clicks,
             {_CLEANED} AS q, {_BRAND} AS b FROM ruled GROUP BY query, domain)""",
    "entity_metrics": f"{_UNIFIED} SELECT * FROM unified WHERE grain = 'restaurant'",
    "attributed_metrics": f"{_UNIFIED} SELECT * FROM unified WHERE grain = 'cuisine'",
    "global_metrics": f"{_UNIFIED} SELECT * FROM unified WHERE grain = 'global'",
    "unified_metrics": f"{_UNIFIED} SELECT * FROM unified",
    "exact_distinct_metrics": f"{_EXACT} SELECT * FROM unified WHERE grain <> 'restaurant'",
    "asof_metrics": _ASOF,
    "maintained_metrics": f"{_LOADED} SELECT * FROM unified",
    "sketched_distinct_metrics": f"{_EXACT} SELECT * FROM unified WHERE grain <> 'restaurant'",
    "restaurant_metrics": f"""{_UNIFIED}
SELECT restaurant_id, domain, search_type, {_METRICS},
       row_number() OVER (ORDER BY restaurant_id NULLS LAST, search_type NULLS LAST, domain NULLS LAST) AS place FROM unified WHERE grain = 'restaurant'""",
    "cuisine_metrics": f"""{_UNIFIED}
SELECT cuisine, search_type, {_METRICS}, row_number() OVER (ORDER BY cuisine NULLS LAST, search_type NULLS LAST) AS place
FROM unified WHERE grain = 'cuisine'""",
    "ctr_residual": f"{_UNIFIED} {_RESIDUAL}",
    "build_from_exports": f"{_UNIFIED} SELECT * FROM unified",
    "full_build": f"""{_UNIFIED}
SELECT restaurant_id, domain, search_type, {_METRICS} FROM unified WHERE grain = 'restaurant'""",
    "declared_checks": _declared(),
    "clustered_table": f"{_UNIFIED} SELECT * FROM unified WHERE grain = 'restaurant' AND search_type = 'Branded'",
    "share_of_total": f"""WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, CAST(floor(l_quantity) AS BIGINT) AS quantity FROM lineitem)
SELECT *, {_pct("quantity", "sum(quantity) OVER (PARTITION BY l_suppkey)")} AS pct_of_supplier,
       {_pct("quantity", "sum(quantity) OVER (PARTITION BY l_returnflag)")} AS pct_of_flag
FROM lines""",
    "incremental_read": """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value
FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')""",
    "late_arrivals": """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value, 1 AS load
FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' OR event_id % 7 = 0""",
    "latest_upsert": _LATEST,
    "merge_loads": _LATEST,
    "compact_loads": _LATEST,
    "mixed_loads": _LATEST,
    "load_search_export": f"""WITH {_FLAT}
SELECT {_FLAT_COLUMNS} FROM flat QUALIFY chunk = max(chunk) OVER (PARTITION BY restaurant_id)""",
    "refresh_labels": f"WITH {_BRANDS}, {_LABELS} SELECT restaurant_id, cuisine FROM labels",
    "stream_upsert": _LATEST,
    "snapshot_in_effect": """
WITH state AS (
  SELECT user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'),
facts AS (SELECT user_id, count(*) AS n_events, max(event_id) AS last_id FROM events GROUP BY user_id)
SELECT user_id, n_events, last_id, event_type, '2024-01-15' AS snapshot_date
FROM facts JOIN state USING (user_id) WHERE rn = 1""",
    "scd2_intervals": f"""WITH {_intervals("true")}
SELECT user_id, event_type, {_TEXT_TIME.format("start_ts")} AS effective_start_date,
       {_TEXT_TIME.format("end_ts")} AS effective_end_date FROM intervals""",
    "scd2_join": _interval_join("JOIN"),
    "scd2_join_slices": _interval_join("JOIN"),
    "scd2_join_left": _interval_join("LEFT JOIN"),
    "quality_report": _quality(),
}
