"""The registered queries as SQL over the same tables, for comparison on another engine."""

from __future__ import annotations

_K = "cast(json_extract_string(props, '$.k') as integer)"

# Rounding of a double mean half up on its shortest decimal, as Spark does.
_ROUNDED = "cast(round(cast(cast(avg({0}) as varchar) as decimal(38, 16)), 2) as double)"

_EVENT_STATS = f"""
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
       event_type, count(*) AS value_count, {_ROUNDED.format("value")} AS avg_value,
       max(value) AS max_value, min(value) AS min_value
FROM events GROUP BY ALL
"""

_RATINGS = f"""
ratings AS (
  SELECT cast(user_id AS integer) AS "userId", {_K} AS "movieId", value AS rating,
         cast(epoch(date_trunc('second', ts)) AS bigint) AS event_time,
         date_trunc('second', ts) AS event_timestamp
  FROM events)
"""

_TEXTS = f"""
{_RATINGS},
texts AS (
  SELECT "movieId" AS k,
    CASE "movieId"
      WHEN 2 THEN 'x' || "userId" WHEN 3 THEN "userId" || '_0' WHEN 4 THEN ' ' || "userId" || '  '
      WHEN 9 THEN '99999999999999999999' || "userId" WHEN 10 THEN '+' || "userId"
      ELSE cast("userId" AS varchar) END AS u,
    cast("movieId" AS varchar) AS m,
    CASE "movieId"
      WHEN 6 THEN 'nan' WHEN 7 THEN '-inf' WHEN 8 THEN rating || 'e0' WHEN 12 THEN ''
      WHEN 13 THEN rating || 'd' WHEN 15 THEN '4'
      ELSE cast(rating AS varchar) END AS r,
    CASE "movieId" WHEN 5 THEN event_time || '.0' ELSE cast(event_time AS varchar) END AS t
  FROM ratings),
typed AS (
  SELECT *,
    CASE WHEN regexp_matches(u, '^\\s*[+-]?[0-9]+\\s*$') THEN try_cast(u AS bigint) END AS tu,
    CASE WHEN regexp_matches(m, '^\\s*[+-]?[0-9]+\\s*$') THEN try_cast(m AS bigint) END AS tm,
    CASE WHEN regexp_matches(r, '(?i)^\\s*([+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?|nan|[+-]?inf(inity)?)\\s*$')
         THEN try_cast(r AS double) END AS tr,
    CASE WHEN regexp_matches(t, '^\\s*[+-]?[0-9]+\\s*$') THEN try_cast(t AS bigint) END AS tt
  FROM texts)
"""


def _checked(lo: float, hi: float, ragged: bool) -> str:
    arity = "WHEN k IN (0, 1) THEN 'arity'" if ragged else ""
    return f"""{_TEXTS},
checked AS (
  SELECT *, CASE {arity}
    WHEN tu IS NULL OR tm IS NULL OR tr IS NULL OR tt IS NULL THEN 'type'
    WHEN NOT (tr BETWEEN {lo} AND {hi}) THEN 'range' END AS reject_reason
  FROM typed)
"""


def _valid(lo: float = 0.5, hi: float = 5.0, ragged: bool = True) -> str:
    return f"""
WITH {_checked(lo, hi, ragged)}
SELECT tu AS "userId", tm AS "movieId", tr AS rating, tt AS "timestamp"
FROM checked WHERE reject_reason IS NULL
"""


_CHECKED = _checked(0.5, 5.0, ragged=True)


def _cents(column: str) -> str:
    return f"cast(round({column} * 100) AS bigint)"


def _mean(column: str) -> str:
    return f"cast(sum({_cents(column)}) AS double) / (count({column}) * 100)"


_ORACLE = {
    "tumbling_stats_1m": _EVENT_STATS,
    "stream_tumbling_stats": _EVENT_STATS,
    "stream_multibatch_latest": _EVENT_STATS,
    "stream_compacted": _EVENT_STATS,
    "stream_new_checkpoint": _EVENT_STATS,
    "stream_late_rows": f"""
WITH span AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events),
parted AS (
  SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
         least((epoch_us(ts) - a) * 4 // (b - a + 1) + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END, 3) AS part
  FROM events, span WHERE ts IS NOT NULL),
tops AS (SELECT part, max(ts) AS top FROM parted GROUP BY part),
bars AS (SELECT a.part, max(b.top) - INTERVAL 1 MINUTE AS bar FROM tops a JOIN tops b ON b.part < a.part GROUP BY a.part)
SELECT window_start, window_end, event_type, count(*) AS value_count,
       cast(round(cast(cast({_mean("value")} AS varchar) AS decimal(38, 16)), 2) AS double) AS avg_value,
       max(value) AS max_value, min(value) AS min_value,
       cast(count(*) FILTER (WHERE window_end <= bar) AS bigint) AS late_count
FROM parted LEFT JOIN bars USING (part) GROUP BY ALL
""",
    "stream_rating_stats": f"""
WITH {_RATINGS}
SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end,
       "movieId", count(*) AS rating_count, {_ROUNDED.format("rating")} AS avg_rating,
       max(rating) AS max_rating, min(rating) AS min_rating
FROM ratings GROUP BY ALL
""",
    "stream_land_raw": f"WITH {_RATINGS} SELECT * FROM ratings",
    "json_parse_filter": f"SELECT {_K} AS k FROM events WHERE {_K} IS NOT NULL",
    "json_roundtrip_malformed": f"""
WITH {_RATINGS} SELECT * FROM ratings WHERE "movieId" > 8
""",
    "epoch_to_timestamps": """
SELECT event_id, cast(epoch(date_trunc('second', ts)) AS bigint) AS event_time,
       date_trunc('second', ts) AS event_timestamp
FROM events
""",
    "clean_valid": _valid(),
    "clean_valid_wide_range": _valid(10.0, 100.0),
    "csv_scan_clean": _valid(ragged=False),
    "clean_rejects": f"""
WITH {_CHECKED}
SELECT m AS "movieId", nullif(r, '') AS rating, reject_reason
FROM checked WHERE reject_reason IS NOT NULL
""",
    "clean_metrics": f"""
WITH {_CHECKED}
SELECT count(*) AS total_rows, count(*) FILTER (reject_reason IS NULL) AS valid_rows,
       count(reject_reason) AS skipped_rows
FROM checked
""",
    "clean_reject_reasons": f"""
WITH {_CHECKED}
SELECT reject_reason, count(*) AS row_count
FROM checked WHERE reject_reason IS NOT NULL GROUP BY ALL
""",
    "csv_quoted_breaks": r"""
SELECT doc_id, source, md5(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g')) AS text_md5, n_chars, false AS damaged
FROM documents
""",
    "range_filter_rows": """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity
FROM lineitem WHERE l_quantity BETWEEN 10 AND 20
""",
    "validate_orders": """
WITH checked AS (
  SELECT CASE WHEN NOT (o_totalprice BETWEEN 1000 AND 400000) THEN 'price'
              WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status'
              WHEN o_orderpriority = '5-LOW' THEN 'priority' END AS reject_reason
  FROM orders)
SELECT reject_reason, count(*) AS row_count
FROM checked WHERE reject_reason IS NOT NULL GROUP BY ALL
""",
    "validate_references": """
WITH checked AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CASE WHEN l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') THEN 'order'
              WHEN NOT coalesce(l_quantity <= 49, false) THEN 'quantity'
              WHEN rank() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey) > 1 THEN 'supplier' END AS reject_reason
  FROM lineitem)
SELECT * FROM checked WHERE reject_reason IS NOT NULL
""",
    "key_averages": f"""
SELECT l_partkey, {_mean("l_quantity")} AS avg_l_quantity FROM lineitem GROUP BY ALL
""",
    "key_summary": f"""
SELECT l_suppkey, count(*) AS l_extendedprice_count,
       {_mean("l_extendedprice")} AS avg_l_extendedprice,
       max(l_extendedprice) AS max_l_extendedprice, min(l_extendedprice) AS min_l_extendedprice
FROM lineitem GROUP BY ALL
""",
    "key_quantiles": """
WITH ranked AS (
  SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS place,
         count(*) OVER (PARTITION BY l_returnflag) AS total
  FROM lineitem)
SELECT l_returnflag, share, l_extendedprice AS quantile
FROM ranked JOIN (VALUES (1), (10), (250), (500), (900), (999), (1000)) AS shares (share) ON place = (total * share + 999) // 1000
""",
    "value_histogram": """
SELECT l_quantity, count(*) AS row_count,
       count(*) / (SELECT count(l_quantity) FROM lineitem) AS share
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity
""",
    "top_k_keys": f"""
SELECT l_partkey, count(*) AS l_quantity_count, {_mean("l_quantity")} AS avg_l_quantity,
       max(l_quantity) AS max_l_quantity, min(l_quantity) AS min_l_quantity
FROM lineitem GROUP BY l_partkey HAVING count(*) >= 5
ORDER BY avg_l_quantity DESC, l_partkey LIMIT 20
""",
    "genre_stats": f"""
WITH listed AS (
  SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS category FROM part)
SELECT category, count(*) AS row_count, count(DISTINCT p_partkey) AS item_count,
       {_mean("l_quantity")} AS avg_value
FROM lineitem JOIN listed ON l_partkey = p_partkey GROUP BY category
""",
    "time_by_month": f"""
SELECT cast(date_trunc('month', l_shipdate) AS timestamp) AS "month", count(*) AS row_count,
       {_mean("l_extendedprice")} AS avg_value
FROM lineitem GROUP BY ALL
""",
    "time_by_hour": f"""
SELECT cast(extract(hour FROM ts) AS bigint) AS "hour", count(*) AS row_count,
       {_mean("value")} AS avg_value
FROM events GROUP BY ALL
""",
    "user_behaviour": f"""
SELECT user_id, count(*) AS row_count, count(DISTINCT event_type) AS item_count,
       {_mean("value")} AS avg_value, round(stddev_pop(value), 6) AS stddev_value,
       min(ts) AS first_seen, max(ts) AS last_seen,
       count(DISTINCT cast(ts AS date)) AS active_days
FROM events GROUP BY user_id
""",
    "user_behaviour_incremental": f"""
SELECT l_suppkey, count(*) AS row_count, count(DISTINCT l_partkey) AS item_count,
       {_mean("l_quantity")} AS avg_value, round(stddev_pop(l_quantity), 6) AS stddev_value,
       min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen,
       count(DISTINCT cast(l_shipdate AS date)) AS active_days
FROM lineitem GROUP BY l_suppkey
""",
    "incremental_delta": """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')
""",
    "latest_versions": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
""",
    "merge_upsert": """
SELECT o_orderkey,
       o_totalprice + CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 2.0
                           WHEN o_orderdate >= DATE '1995-01-01' THEN 1.0 ELSE 0.0 END AS price,
       cast(CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 3
                 WHEN o_orderdate >= DATE '1995-01-01' THEN 2 ELSE 1 END AS bigint) AS version
FROM orders
""",
    "merge_out_of_order": """
SELECT o_orderkey, o_totalprice + CASE WHEN o_orderdate >= DATE '1996-01-01' THEN 2.0 ELSE 0.0 END AS price,
       cast(CASE WHEN o_orderdate >= DATE '1996-01-01' THEN 3 ELSE 2 END AS bigint) AS version
FROM orders
""",
    "file_prefix": r"""
WITH lines AS (
  SELECT doc_id, source, cast(doc_id % 4 AS integer) AS part,
         doc_id || ' ' || regexp_replace(coalesce(text, ''), '[\r\n]', '¶', 'g') AS line
  FROM documents),
spent AS (
  SELECT *, sum(strlen(line) + 1) OVER in_file AS bytes, row_number() OVER in_file = 1 AS is_header
  FROM lines WINDOW in_file AS (PARTITION BY source, part ORDER BY doc_id ROWS UNBOUNDED PRECEDING))
SELECT source, part, md5(line) AS line_md5, is_header FROM spent WHERE bytes <= 50000 OR is_header
""",
    "batch_job_counters": f"""
WITH {_checked(0.5, 5.0, ragged=False)}
SELECT with_budget, count(*) AS total_rows, count(*) FILTER (reject_reason IS NULL) AS valid_rows,
       count(*) FILTER (reject_reason IS NOT NULL) AS skipped_rows, cast(0 AS bigint) AS skipped_items
FROM checked CROSS JOIN (VALUES (true), (false)) AS forms (with_budget) GROUP BY with_budget
""",
    "batch_job_results": f"""
WITH {_checked(0.5, 5.0, ragged=False)},
valid AS (
  SELECT tu, tm, tr, make_timestamp(tt * 1000000) AS ts FROM checked WHERE reject_reason IS NULL),
movies AS (SELECT tm AS key, count(*) AS n, {_mean("tr")} AS measure FROM valid GROUP BY tm)
SELECT 'movie_stats' AS result, * FROM movies
UNION ALL
SELECT * FROM (SELECT 'top_movies', * FROM movies WHERE n >= 2 ORDER BY measure DESC, key LIMIT 5)
UNION ALL
SELECT 'rating_histogram', {_cents("tr")}, count(*), cast(count(*) AS double) / (SELECT count(*) FROM valid)
FROM valid GROUP BY tr
UNION ALL
SELECT 'month_stats', year(ts) * 100 + month(ts), count(*), {_mean("tr")} FROM valid GROUP BY 2
UNION ALL
SELECT 'hour_stats', hour(ts), count(*), {_mean("tr")} FROM valid GROUP BY 2
UNION ALL
SELECT 'user_stats', tu, count(*), {_mean("tr")} FROM valid GROUP BY tu
""",
    "apply_changes": """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'R' WHEN o_orderstatus = 'P' THEN 'O'
            ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority
FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus <> 'F'
""",
    "apply_changes_files": """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'R' WHEN o_orderstatus = 'P' THEN 'O'
            ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority
FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus <> 'F'
""",
    "incremental_late": """
SELECT event_id, ts, user_id, event_type, value FROM events
""",
    "merge_stats": f"""
SELECT event_type, user_id, count(*) AS n, cast(sum({_cents("value")}) AS bigint) AS total,
       max({_cents("value")}) AS highest, min({_cents("value")}) AS lowest
FROM events GROUP BY ALL
""",
    "byte_prefix_rows": """
SELECT doc_id, source, n_chars FROM (
  SELECT *, sum(strlen(text) + 1) OVER (ORDER BY doc_id) AS spent FROM documents)
WHERE 12 + spent <= 1000000
""",
    "byte_prefix_by_group": """
SELECT doc_id, source, n_chars FROM (
  SELECT *, sum(strlen(text) + 1) OVER (PARTITION BY source ORDER BY doc_id) AS spent
  FROM documents)
WHERE spent <= 50000
""",
    "table_profiles": """
SELECT source, count(*) AS row_count, cast(sum(strlen(text) + 1) AS bigint) AS text_bytes
FROM documents GROUP BY source
""",
    "file_line_profile": r"""
SELECT lang, cast(sum(len(regexp_extract_all(text, '\r\n|\r|\n')) + 1) AS bigint) AS line_count
FROM documents GROUP BY lang
""",
    "read_formats": f"""
SELECT fmt, count(*) AS row_count, cast(sum({_cents("o_totalprice")}) AS bigint) AS total_cents,
       min(o_orderdate) AS first_date, count(DISTINCT o_orderpriority) AS priorities
FROM orders, (SELECT unnest(['csv', 'json', 'parquet']) AS fmt) GROUP BY fmt
""",
    "batch_job_genres": f"""
WITH {_checked(0.5, 5.0, ragged=False)},
listed AS (
  SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS category FROM part)
SELECT category, count(*) AS row_count, count(DISTINCT p_partkey) AS item_count,
       {_mean("tr")} AS avg_value
FROM checked JOIN listed ON tm = p_partkey
WHERE reject_reason IS NULL GROUP BY category
""",
    "register_folder": """
SELECT 'orders' AS table_name, count(*) AS row_count, cast(sum(o_orderkey) AS bigint) AS keys,
       cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS cents, count(DISTINCT o_orderstatus) AS texts
FROM orders
UNION ALL
SELECT 'part', count(*), cast(sum(p_partkey) AS bigint), cast(sum(cast(round(p_retailprice * 100) AS bigint)) AS bigint), count(DISTINCT p_name)
FROM part
""",
    "publish_tables": f"""
WITH {_CHECKED}
SELECT 'ratings_raw' AS table_name, count(*) AS row_count FROM checked
UNION ALL
SELECT 'ratings_clean', count(*) FROM checked WHERE reject_reason IS NULL
""",
}


def oracle() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _ORACLE.items()}
