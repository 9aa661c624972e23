"""ANSI SQL with the same results as ``plans.queries``, for DuckDB."""

from __future__ import annotations

# The daily security feed of plans.feeds, and what the merges make of it.
_FEED = """
last_events AS (
  SELECT user_id, {date} AS d, max(event_id) AS event_id, arg_max(value, event_id) AS value
  FROM events GROUP BY 1, 2),
feed AS (
  SELECT 'S' || user_id AS security_id,
         'Holding ' || event_id AS security_name,
         CASE WHEN value >= 10.0 THEN 'BBG' || user_id END AS id_bb_global,
         CASE WHEN event_id % 7 <> 0 THEN 'C' || event_id END AS cusip,
         CAST(d AS VARCHAR) AS business_date
  FROM last_events),
identified AS (SELECT * FROM feed WHERE id_bb_global IS NOT NULL),
history AS (
  SELECT security_id, security_name, id_bb_global, cusip,
         business_date AS effective_business_date,
         coalesce(lead(business_date) OVER w, '9999-12-31') AS end_date,
         lead(business_date) OVER w IS NULL AS latest
  FROM identified
  WINDOW w AS (PARTITION BY security_id ORDER BY business_date))
"""
_DAILY = _FEED.format(date="CAST(ts AS DATE)")
_BY_THIRDS = _FEED.format(
    date="CAST(date_trunc('month', ts) AS DATE) "
    "+ CAST(CASE WHEN day(ts) <= 20 THEN 0 ELSE 20 END AS INTEGER)"
)

_HISTORY = f"WITH {_DAILY} SELECT * FROM history"

_CONSTITUENT = """
  event_type AS index_name,
  CAST(event_id AS VARCHAR) AS constituent_id,
  event_type || '-' || user_id AS ticker,
  CASE WHEN event_type <> 'signup' THEN 'BBG' || user_id END AS figi,
  CAST(CAST(value AS VARCHAR) AS FLOAT) AS index_weight,
  CAST(json_extract_string(props, '$.k') AS FLOAT) AS market_cap"""

_TEXT = (
    "trim(replace(replace(replace(replace(regexp_replace("
    "{0}, '<[^>]*>', '', 'g'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), "
    "'&amp;', '&'))"
)

_WORDS = """
  SELECT regexp_extract(lower(token), '[a-z'']+', 0) AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '[ \\r\\n]')) AS token FROM documents)"""

_WORD_COUNT = f"""
SELECT word, count(*) AS count FROM ({_WORDS}) WHERE word <> '' GROUP BY word"""

ORACLES: dict[str, str] = {
    "fare_totals": """
SELECT l_returnflag, l_linestatus, l_linenumber,
       round(sum(l_extendedprice), 2) AS total_fare_amount
FROM lineitem GROUP BY 1, 2, 3""",
    "word_count": _WORD_COUNT,
    "word_count_top10": f"{_WORD_COUNT} ORDER BY count DESC, word LIMIT 10",
    "index_silver": """
SELECT o_orderpriority AS index_name, o_orderkey AS constituent_id,
       o_orderstatus AS ticker, o_custkey AS figi, o_totalprice AS index_weight,
       o_totalprice * 2 AS market_cap,
       strftime(o_orderdate, '%Y-%m-%d') AS effective_business_date
FROM orders WHERE o_orderstatus <> 'P'""",
    "business_date_from_path": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS file_date,
       strftime(o_orderdate, '%Y-%m-%d') AS business_date
FROM orders""",
    "dynamic_filter": """
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7""",
    "typed_mapping": """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line,
       CAST(trunc(l_quantity) AS BIGINT) AS quantity, l_extendedprice AS price,
       l_returnflag AS flag, TRY_CAST(l_linestatus AS BIGINT) AS status_code
FROM lineitem""",
    "resolve_choice": """
SELECT p_partkey,
       CASE WHEN p_size <= 15 THEN CAST(p_size AS BIGINT) END AS code_long,
       CASE WHEN p_size > 15 AND p_size <= 30 THEN p_retailprice END AS code_double,
       CASE WHEN p_size > 30 THEN p_type END AS code_string,
       p_brand AS brand
FROM part""",
    "nested_choices": """
SELECT p_partkey, p_brand AS brand,
       CASE WHEN p_size <= 15 THEN CAST(p_size AS BIGINT) END AS code_long,
       CASE WHEN p_size > 15 AND p_size <= 30 THEN p_type END AS code_string,
       p_retailprice AS first_tag, p_brand AS second_tag, CAST(2 AS INTEGER) AS n_tags
FROM part""",
    "silver_loads": """
SELECT p_partkey,
       CASE WHEN p_size <= 15 THEN CAST(p_size AS BIGINT) END AS code_long,
       CASE WHEN p_size > 15 AND p_size <= 30 THEN p_retailprice END AS code_double,
       CASE WHEN p_size > 30 AND p_size <= 45 THEN p_type END AS code_string,
       CASE WHEN p_size <= 15 THEN p_size END AS size
FROM part""",
    "drop_null_columns": """
SELECT *, CASE WHEN c_custkey = 0 THEN c_name END AS c_vip FROM customer""",
    "row_update": """
SELECT CASE WHEN o_orderkey % 2 = 0 AND o_orderkey <> 2
            THEN o_orderkey + 100 ELSE o_orderkey END AS o_orderkey,
       o_custkey, o_orderstatus
FROM orders""",
    "row_delete": """
SELECT o_orderkey, o_orderstatus, o_totalprice
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""",
    "merge_upsert": """
SELECT coalesce(c_custkey, p_partkey) AS c_custkey,
       CASE WHEN c_custkey IS NULL THEN p_name ELSE c_name END AS c_name,
       c_mktsegment,
       CASE WHEN p_partkey IS NULL THEN c_acctbal ELSE p_retailprice END AS c_acctbal
FROM customer FULL JOIN part ON c_custkey = p_partkey""",
    "scd1_latest": f"WITH {_DAILY} SELECT * FROM history WHERE latest",
    "scd2_history": _HISTORY,
    "scd2_backfill": _HISTORY,
    "scd2_late_files": _HISTORY,
    "streamed_history": _HISTORY,
    "time_travel": """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal
FROM customer""",
    "dml_walkthrough": """
WITH v1 AS (
  SELECT CASE WHEN c_custkey % 2 = 0 AND c_custkey <> 2
              THEN c_custkey + 100 ELSE c_custkey END AS id FROM customer),
v2 AS (SELECT id FROM v1 WHERE id % 2 = 0)
SELECT CAST(0 AS BIGINT) AS version, c_custkey AS id FROM customer
UNION ALL SELECT 1, id FROM v1
UNION ALL SELECT 2, id FROM v2
UNION ALL SELECT 3, id FROM v2
UNION ALL SELECT 3, p_partkey FROM part WHERE p_partkey NOT IN (SELECT id FROM v2)""",
    "index_gold": f"""
WITH {_DAILY},
constituents AS (
  SELECT {_CONSTITUENT}, strftime(ts, '%Y-%m-%d') AS effective_business_date FROM events)
SELECT c.*, h.security_id, h.cusip
FROM constituents c LEFT JOIN history h ON h.latest AND h.id_bb_global = c.figi""",
    "medallion_replay": f"""
WITH {_BY_THIRDS},
constituents AS (
  SELECT {_CONSTITUENT},
         CAST(CAST(date_trunc('month', ts) AS DATE) + CAST(
           CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 10 ELSE 20 END
           AS INTEGER) AS VARCHAR) AS effective_business_date
  FROM events)
SELECT c.*, h.security_id, h.cusip
FROM constituents c LEFT JOIN history h
  ON h.id_bb_global = c.figi
 AND h.effective_business_date <= c.effective_business_date
 AND c.effective_business_date < h.end_date""",
    "page_links": """
SELECT DISTINCT url AS source_url,
       regexp_extract(url, '^https?://[^/?#]*') || link AS parsed_url
FROM (SELECT url, unnest(regexp_extract_all(html, 'href="([^"\\n]*)"', 1)) AS link FROM pages)""",
    "html_elements": f"""
SELECT page_id,
       {_TEXT.format("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS title,
       {_TEXT.format("regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 's')")} AS ad,
       {_TEXT.format("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")} AS footer
FROM pages""",
    "html_cards": """
SELECT page_id, CAST(i - 1 AS BIGINT) AS card_no,
       replace(regexp_extract(item, '>(.*?)</a>', 1, 's'), '&amp;', '&') AS label,
       replace(regexp_extract(item, 'href="([^"]*)"', 1), '&amp;', '&') AS links
FROM (SELECT page_id, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1, 's') AS items
            FROM pages))""",
    "html_keyword_links": """
SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"\\n]*)"', 1)) AS link
FROM pages
WHERE contains(lower(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')), 'the')""",
    "html_keyword_cards": """
SELECT page_id, title, unnest(links) AS link
FROM (SELECT page_id, replace(unnest(titles), '&amp;', '&') AS title, links
      FROM (SELECT page_id, regexp_extract_all(nav, '<a [^>]*>(.*?)</a>', 1, 's') AS titles,
                   regexp_extract_all(nav, 'href="([^"]*)"', 1) AS links
            FROM (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages)))
WHERE contains(lower(title), 'the')""",
    "surrogate_keys": """
SELECT s_suppkey, s_name,
       CAST(1000 + row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS security_id,
       CAST(1000 + count(*) OVER () AS BIGINT) AS last_id
FROM supplier""",
    "nest_positions": """
SELECT c_custkey AS account_id, c_name AS name, CAST(0 AS BIGINT) AS page,
       CAST(count(o_orderkey) AS INTEGER) AS n_positions,
       coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '')
         AS position_ids
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
    "paged_positions": """
SELECT o_custkey AS account_id, page,
       string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY day, o_orderkey) AS position_ids
FROM (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
             CAST((row_number() OVER (PARTITION BY o_custkey
                   ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) - 1) // 4 AS BIGINT) AS page
      FROM orders)
GROUP BY 1, 2""",
    "flatten_positions": """
SELECT o_custkey AS account_id, o_orderkey AS position_id,
       o_totalprice AS market_value, o_orderpriority AS exposure
FROM orders""",
    "incremental_files": "SELECT * FROM events",
}
