"""Independent SQL (DuckDB dialect) for every registered query.

The fixture adapter and the transform are written again here as CTEs over
the driver's views (``events``, ``part``, ``pages``, ...), then each query
selects from them. Nothing here is generated from the Spark plans; it is the
same specification written a second time.
"""

from __future__ import annotations

TS_FMT = "%Y-%m-%dT%H:%M:%S.%gZ"


def _p(s: str) -> str:
    return f"try_strptime({s}, '{TS_FMT}')"


def _exact(c: str) -> str:
    """Sum of the values as decimals, which no order of summing changes."""
    return f"CAST(SUM(CAST({c} AS DECIMAL(28,12))) AS DOUBLE)"


def _mean(c: str) -> str:
    return f"({_exact(c)} / COUNT({c}))"


def _round2(x: str) -> str:
    """Half up on the shortest decimal text of a double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


ADAPTER = f"""
pages_b AS (
  SELECT page_id, min(url) AS media_url FROM pages GROUP BY page_id),
geo AS (
  SELECT c.c_custkey, n.n_name AS country, r.r_name AS region, c.c_mktsegment AS city
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
ev_k AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k FROM events e),
src_events AS (
  SELECT 'ev-' || CAST(x.event_id AS VARCHAR) AS event_key,
         CASE WHEN x.event_type = 'error' AND x.value >= 150 THEN NULL
              ELSE CASE WHEN x.value >= 150 THEN 'x' ELSE 'm' END || CAST(x.k AS VARCHAR) END AS media_id,
         p.media_url,
         CASE WHEN x.event_type = 'error' THEN NULL ELSE 'u' || CAST(x.user_id AS VARCHAR) END AS visitor_key,
         strftime(x.ts, '{TS_FMT}') AS received_at,
         CAST(least(x.value / 100.0, 1.0) AS DOUBLE) AS percent_viewed,
         '10.0.' || CAST(x.user_id // 256 AS VARCHAR) || '.' || CAST(x.user_id % 256 AS VARCHAR) AS ip,
         g.country, g.region, g.city,
         x.event_type AS browser, x.event_type AS platform, (x.k % 2 = 0) AS mobile
  FROM ev_k x
  LEFT JOIN pages_b p ON p.page_id = x.event_id % (SELECT max(page_id) + 1 FROM pages)
  LEFT JOIN geo g ON g.c_custkey = x.user_id),
src_ts AS (SELECT s.*, {_p('s.received_at')} AS __ts FROM src_events s),
raw_events AS (
  SELECT * EXCLUDE (__ts),
         'raw/run_date=2024-01-20/run_id=20240120T060000Z/events/media_id=' || coalesce(media_id, '__HIVE_DEFAULT_PARTITION__') || '/page_001.json' AS _source_file
  FROM src_ts WHERE __ts < TIMESTAMP '2024-01-20 00:00:00'
  UNION ALL
  SELECT * EXCLUDE (__ts),
         'raw/run_date=2024-01-31/run_id=20240131T060000Z/events/media_id=' || coalesce(media_id, '__HIVE_DEFAULT_PARTITION__') || '/page_001.json' AS _source_file
  FROM src_ts WHERE __ts >= TIMESTAMP '2024-01-15 00:00:00'),
raw_events_r AS (
  SELECT *, regexp_extract(_source_file, 'run_id=([^/]+)', 1) AS run_id,
            regexp_extract(_source_file, 'run_date=([^/]+)', 1) AS run_date
  FROM raw_events),
raw_events_ts AS (SELECT *, {_p('received_at')} AS __ts FROM raw_events_r),
events_dedup AS (
  SELECT * FROM raw_events_ts
  QUALIFY row_number() OVER (PARTITION BY event_key
                             ORDER BY __ts DESC NULLS LAST, received_at DESC NULLS LAST, run_id DESC NULLS LAST) = 1),
raw_metadata AS (
  SELECT 'm' || CAST(p_partkey AS VARCHAR) AS hashed_id, p_name AS name,
         '2024-01-01T00:00:00.000Z' AS created, '2024-01-10T00:00:00.000Z' AS updated,
         CAST(p_size AS DOUBLE) * 60.0 AS duration, 'ready' AS status,
         'raw/run_date=2024-01-20/run_id=20240120T060000Z/media_metadata.json' AS _source_file
  FROM part
  UNION ALL
  SELECT 'm' || CAST(p_partkey AS VARCHAR), p_name || ' v2',
         '2024-01-01T00:00:00.000Z',
         CASE WHEN p_type = 'PROMO' THEN '2024-01-10T00:00:00.000Z' ELSE '2024-01-25T00:00:00.000Z' END,
         CAST(p_size AS DOUBLE) * 60.0 + 1.0, 'ready',
         'raw/run_date=2024-01-31/run_id=20240131T060000Z/media_metadata.json'
  FROM part WHERE p_size >= 25),
meta_r AS (
  SELECT *, hashed_id AS media_id,
            regexp_extract(_source_file, 'run_id=([^/]+)', 1) AS run_id,
            regexp_extract(_source_file, 'run_date=([^/]+)', 1) AS run_date,
            {_p('updated')} AS __upd
  FROM raw_metadata),
latest_metadata AS (
  SELECT * EXCLUDE (__upd) FROM meta_r
  QUALIFY row_number() OVER (PARTITION BY media_id
                             ORDER BY __upd DESC NULLS LAST, updated DESC NULLS LAST, run_id DESC NULLS LAST) = 1),
raw_stats AS (
  SELECT CAST(p_size AS DOUBLE) / 100.0 AS play_rate,
         'raw/run_date=2024-01-20/run_id=20240120T060000Z/media_stats/m' || CAST(p_partkey AS VARCHAR) || '.json' AS _source_file
  FROM part
  UNION ALL
  SELECT CAST(p_size AS DOUBLE) / 50.0,
         'raw/run_date=2024-01-31/run_id=20240131T060000Z/media_stats/m' || CAST(p_partkey AS VARCHAR) || '.json'
  FROM part WHERE p_size >= 10),
stats_r AS (
  SELECT *,
         CASE WHEN regexp_extract(_source_file, '/media_stats/([^/]+)\\.json$', 1) <> ''
              THEN regexp_extract(_source_file, '/media_stats/([^/]+)\\.json$', 1)
              ELSE regexp_extract(_source_file, 'media_id=([^/]+)', 1) END AS media_id,
         regexp_extract(_source_file, 'run_id=([^/]+)', 1) AS run_id,
         regexp_extract(_source_file, 'run_date=([^/]+)', 1) AS run_date
  FROM raw_stats),
latest_stats AS (
  SELECT * FROM stats_r
  QUALIFY row_number() OVER (PARTITION BY media_id ORDER BY run_id DESC NULLS LAST) = 1),
latest_media_url AS (
  SELECT media_id, media_url FROM events_dedup WHERE media_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY media_id
                             ORDER BY __ts DESC NULLS LAST, received_at DESC NULLS LAST, event_key DESC NULLS LAST) = 1),
latest_visitor AS (
  SELECT * FROM events_dedup WHERE visitor_key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY visitor_key
                             ORDER BY __ts DESC NULLS LAST, received_at DESC NULLS LAST, event_key DESC NULLS LAST) = 1),
dim_media AS (
  SELECT m.media_id, m.name AS title, u.media_url AS url,
         CASE WHEN contains(lower(u.media_url), 'youtube') THEN 'YouTube'
              WHEN contains(lower(u.media_url), 'facebook') THEN 'Facebook'
              WHEN contains(lower(u.media_url), 'blog.') THEN 'Blog'
              WHEN contains(lower(u.media_url), '//m.') THEN 'Mobile'
              ELSE NULL END AS channel,
         {_p('m.created')} AS created_at, {_p('m.updated')} AS updated_at,
         CAST(m.duration AS DOUBLE) AS duration_seconds, m.status
  FROM latest_metadata m LEFT JOIN latest_media_url u ON m.media_id = u.media_id),
dim_visitor AS (
  SELECT sha256(visitor_key) AS visitor_id, ip AS ip_address, country, region, city, browser, platform, mobile
  FROM latest_visitor),
fact AS (
  SELECT e.event_key AS engagement_id, e.media_id, sha256(e.visitor_key) AS visitor_id,
         e.__ts AS received_at, CAST(e.__ts AS DATE) AS date, CAST(1 AS BIGINT) AS play_count,
         CAST(s.play_rate AS DOUBLE) AS play_rate,
         CAST(m.duration AS DOUBLE) * e.percent_viewed AS total_watch_time,
         CAST(e.percent_viewed AS DOUBLE) * 100.0 AS watched_percent
  FROM events_dedup e
  LEFT JOIN latest_metadata m ON e.media_id = m.media_id
  LEFT JOIN latest_stats s ON e.media_id = s.media_id),
landing_state AS (
  SELECT 'm' || CAST(p_partkey AS VARCHAR) AS media_id, CASE p_type WHEN 'ECONOMY' THEN 'unknown' WHEN 'PROMO' THEN '2024-01-12T00:00:00.000Z'
              ELSE '2024-01-20T12:00:00.000Z' END AS last_received_at
  FROM part UNION ALL SELECT NULL, '2024-01-12T00:00:00.000Z'),
configured_media AS (SELECT 'm' || CAST(p_partkey AS VARCHAR) AS media_id FROM part UNION ALL SELECT NULL)
"""


def landing_ctes(lookback_seconds: int = 0) -> str:
    cutoff = "__mark_ts" if not lookback_seconds else f"(__mark_ts - INTERVAL {int(lookback_seconds)} SECOND)"
    fetch_from = "date_trunc('day', __mark_ts)"
    if lookback_seconds:
        fetch_from = f"least({fetch_from}, date_trunc('day', {cutoff}))"
    return f""",
land_ev AS (
  SELECT s.*, st.last_received_at AS __mark,
         {_p('s.received_at')} AS __ts, {_p('st.last_received_at')} AS __mark_ts
  FROM src_events s LEFT JOIN landing_state st ON s.media_id IS NOT DISTINCT FROM st.media_id
  WHERE EXISTS (SELECT 1 FROM configured_media c WHERE c.media_id IS NOT DISTINCT FROM s.media_id)),
land_fetched AS (
  SELECT *, (received_at IS NOT NULL AND received_at <> '' AND __ts IS NOT NULL
             AND (__mark_ts IS NULL OR __ts > {cutoff})) AS __saved
  FROM land_ev
  WHERE __mark_ts IS NULL OR __ts IS NULL OR __ts >= {fetch_from}),
land_agg AS (
  SELECT media_id, COUNT(*) AS events_fetched,
         COUNT(*) FILTER (WHERE __saved) AS events_saved,
         COUNT(*) FILTER (WHERE received_at IS NOT NULL AND received_at <> '' AND __ts IS NULL) AS events_rejected,
         arg_max(received_at, __ts) FILTER (WHERE __ts IS NOT NULL) AS __newest
  FROM land_fetched GROUP BY media_id),
run_manifest AS (
  SELECT '20240201T060000Z' AS run_id, '2024-02-01' AS run_date, c.media_id,
         CASE WHEN {_p('st.last_received_at')} IS NOT NULL THEN 'incremental' ELSE 'full' END AS mode,
         st.last_received_at AS checkpoint_before,
         CASE WHEN a.__newest IS NULL THEN st.last_received_at
              WHEN {_p('st.last_received_at')} IS NULL THEN a.__newest
              WHEN {_p('a.__newest')} > {_p('st.last_received_at')} THEN a.__newest
              ELSE st.last_received_at END AS checkpoint_after,
         CAST(ceil(COALESCE(a.events_fetched, 0) / 100.0) AS BIGINT) AS pages_fetched,
         CAST(COALESCE(a.events_fetched, 0) AS BIGINT) AS events_fetched,
         CAST(COALESCE(a.events_saved, 0) AS BIGINT) AS events_saved,
         CAST(COALESCE(a.events_rejected, 0) AS BIGINT) AS events_rejected,
         'success' AS status, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT DISTINCT media_id FROM configured_media) c
  LEFT JOIN landing_state st ON c.media_id IS NOT DISTINCT FROM st.media_id
  LEFT JOIN land_agg a ON c.media_id IS NOT DISTINCT FROM a.media_id),
new_state AS (
  SELECT media_id, checkpoint_after AS last_received_at FROM run_manifest WHERE checkpoint_after IS NOT NULL
  UNION ALL
  SELECT s.media_id, s.last_received_at FROM landing_state s
  WHERE NOT EXISTS (SELECT 1 FROM run_manifest m WHERE m.media_id IS NOT DISTINCT FROM s.media_id))
"""


def _q(body: str, *, landing: int | None = None) -> str:
    ctes = ADAPTER + (landing_ctes(landing) if landing is not None else "")
    return f"WITH {ctes}\n{body}"


EVENT_COLS = "event_key, media_id, media_url, visitor_key, received_at, percent_viewed, ip, country, region, city, browser, platform, mobile"

_JSON_TYPE = """CASE json_type(j, '$."' || field || '"')
    WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
    WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END"""

_RECORDS = """recs AS (
  SELECT to_json({'event_key': event_key, 'media_id': media_id, 'media_url': media_url,
                  'visitor_key': visitor_key, 'received_at': received_at, 'percent_viewed': percent_viewed,
                  'ip': ip, 'country': country, 'region': region, 'city': city,
                  'user_agent_details': {'browser': browser, 'platform': platform, 'mobile': mobile}}) AS j
  FROM src_events WHERE media_id IS NOT NULL),
kv AS (SELECT j, unnest(json_keys(j)) AS field FROM recs)"""

ORACLE: dict[str, str] = {
    "scan_events": _q(
        f"""SELECT {EVENT_COLS}, replace(_source_file, 'page_001', 'page_' || CAST(CAST(substr(event_key, 4) AS BIGINT) // 5000 AS VARCHAR)) AS _source_file,
                   run_id, run_date FROM raw_events_r"""
    ),
    "scan_metadata": _q(
        """SELECT * EXCLUDE (_source_file), _source_file || '/part-' || CAST(CAST(substr(hashed_id, 2) AS BIGINT) // 5000 AS VARCHAR) AS _source_file,
                  regexp_extract(_source_file, 'run_id=([^/]+)', 1) AS run_id,
                  regexp_extract(_source_file, 'run_date=([^/]+)', 1) AS run_date FROM raw_metadata"""
    ),
    "scan_stats": _q("SELECT play_rate, _source_file, run_id, run_date, media_id FROM stats_r"),
    "scan_quarantine": _q(
        """, found AS (
             SELECT 'events' AS kind, run_id, COUNT(*) AS good,
                    COUNT(DISTINCT coalesce(media_id, '-') || '/' || CAST(CAST(substr(event_key, 4) AS BIGINT) // 5000 AS VARCHAR)) AS files
             FROM raw_events_r GROUP BY run_id
             UNION ALL
             SELECT 'media_metadata', run_id, COUNT(*), COUNT(DISTINCT CAST(substr(hashed_id, 2) AS BIGINT) // 5000) FROM meta_r GROUP BY run_id
             UNION ALL
             SELECT 'media_stats', run_id, COUNT(*), (SELECT COUNT(*) FROM part WHERE p_size < 10) FROM stats_r GROUP BY run_id)
           SELECT kind, run_id, good + CASE WHEN run_id = '20240131T060000Z' THEN files ELSE 0 END AS records,
                  CASE WHEN run_id = '20240131T060000Z' THEN files ELSE 0 END AS malformed FROM found"""
    ),
    "source_files": """SELECT 'events.parquet' AS source_table, COUNT(*) AS rows FROM events
        UNION ALL SELECT 'part.parquet', COUNT(*) FROM part UNION ALL SELECT 'pages.parquet', COUNT(*) FROM pages""",
    "path_provenance": _q(
        """SELECT kind, _source_file, media_id,
                  regexp_extract(_source_file, 'run_id=([^/]+)', 1) AS run_id,
                  regexp_extract(_source_file, 'run_date=([^/]+)', 1) AS run_date
           FROM (SELECT 'events' AS kind, _source_file,
                        nullif(regexp_extract(_source_file, 'media_id=([^/]+)', 1), '__HIVE_DEFAULT_PARTITION__') AS media_id FROM raw_events
                 UNION ALL
                 SELECT 'media_stats', _source_file,
                        regexp_extract(_source_file, '/media_stats/([^/]+)\\.json$', 1) FROM raw_stats)"""
    ),
    "sample_events": _q(
        """SELECT media_id, event_key, received_at FROM src_ts
           QUALIFY row_number() OVER (PARTITION BY media_id ORDER BY __ts ASC NULLS LAST, event_key ASC NULLS LAST) <= 5"""
    ),
    "dedup_events": _q(f"SELECT {EVENT_COLS}, run_id, run_date FROM events_dedup"),
    "dedup_lineitem": _q(
        """SELECT * FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST,
                      l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST,
                      l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1"""
    ),
    "latest_metadata": _q("SELECT hashed_id, name, created, updated, duration, status, run_id, media_id FROM latest_metadata"),
    "latest_stats": _q("SELECT media_id, play_rate, run_id FROM latest_stats"),
    "latest_media_url": _q("SELECT media_id, media_url FROM latest_media_url"),
    "latest_visitor": _q(f"SELECT {EVENT_COLS}, run_id FROM latest_visitor"),
    "latest_order_per_customer": _q(
        """SELECT * FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1"""
    ),
    "dim_media": _q("SELECT * FROM dim_media"),
    "dim_visitor": _q("SELECT * FROM dim_visitor"),
    "fact_engagement": _q("SELECT * FROM fact"),
    "stage_counts": _q(
        """SELECT 'raw_events' AS stage, COUNT(*) AS row_count FROM raw_events
           UNION ALL SELECT 'unique_events', COUNT(*) FROM events_dedup
           UNION ALL SELECT 'dim_media', COUNT(*) FROM dim_media
           UNION ALL SELECT 'dim_visitor', COUNT(*) FROM dim_visitor
           UNION ALL SELECT 'fact_media_engagement', COUNT(*) FROM fact"""
    ),
    "channel": _q(
        """SELECT page_id, url,
                  CASE WHEN contains(lower(url), 'youtube') THEN 'YouTube'
                       WHEN contains(lower(url), 'facebook') THEN 'Facebook'
                       WHEN contains(lower(url), 'blog.') THEN 'Blog'
                       WHEN contains(lower(url), '//m.') THEN 'Mobile'
                       ELSE NULL END AS channel
           FROM pages"""
    ),
    "visitor_hash": _q("SELECT event_key, visitor_key, sha256(visitor_key) AS visitor_id FROM src_events"),
    "parse_timestamps": _q(
        f"""SELECT event_key, received_at, {_p('received_at')} AS received_ts,
                   CAST({_p('received_at')} AS DATE) AS received_date,
                   (received_at IS NOT NULL AND received_at <> '' AND {_p('received_at')} IS NULL) AS rejected
            FROM src_events"""
    ),
    "nested_fields": _q("SELECT event_key, browser, platform, mobile FROM src_events"),
    "run_ids": _q(
        "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id, strftime(ts, '%Y-%m-%d') AS run_date FROM events"
    ),
    "json_roundtrip": _q(f"SELECT {EVENT_COLS} FROM src_events"),
    "media_allow_list": _q(
        """SELECT event_key, media_id, received_at FROM src_events
           WHERE media_id IN (SELECT media_id FROM latest_metadata WHERE status = 'ready')"""
    ),
    "incremental_events": _q("SELECT event_key, media_id, received_at FROM land_fetched WHERE __saved", landing=0),
    "incremental_pruned": _q("SELECT event_key, media_id, received_at FROM land_fetched", landing=0),
    "incremental_lookback": _q("SELECT event_key, media_id, received_at FROM land_fetched WHERE __saved", landing=3600),
    "checkpoint_advance": _q("SELECT * FROM new_state", landing=0),
    "run_manifest": _q(
        """SELECT *, 'media' AS record, CAST(NULL AS VARCHAR) AS started_at_utc, CAST(NULL AS VARCHAR) AS finished_at_utc,
                  CAST(NULL AS BIGINT) AS media_count FROM run_manifest
           UNION ALL
           SELECT '20240201T060000Z', '2024-02-01', NULL, NULL, NULL, NULL, CAST(SUM(pages_fetched) AS BIGINT),
                  CAST(SUM(events_fetched) AS BIGINT), CAST(SUM(events_saved) AS BIGINT), CAST(SUM(events_rejected) AS BIGINT),
                  'success', NULL, 'run', '2024-02-01T06:00:00+00:00', '2024-02-01T06:04:30+00:00', COUNT(*) FROM run_manifest""",
        landing=0,
    ),
    "sql_row_counts": _q(
        """SELECT 'dim_media' AS table_name, COUNT(*) AS row_count FROM dim_media
           UNION ALL SELECT 'dim_visitor', COUNT(*) FROM dim_visitor
           UNION ALL SELECT 'fact_media_engagement', COUNT(*) FROM fact"""
    ),
    "sql_counts_one_row": _q(
        """SELECT (SELECT COUNT(*) FROM dim_media) AS media_count,
                  (SELECT COUNT(*) FROM dim_visitor) AS visitor_count,
                  (SELECT COUNT(*) FROM fact) AS engagement_count"""
    ),
    "sql_by_media": _q(
        f"""SELECT media_id, COUNT(*) AS engagement_events,
                  {_round2(_mean('watched_percent'))} AS avg_watched_percent,
                  {_round2(_exact('total_watch_time'))} AS estimated_watch_seconds
           FROM fact GROUP BY media_id ORDER BY engagement_events DESC, media_id"""
    ),
    "sql_by_title": _q(
        f"""SELECT m.title, COUNT(*) AS engagement_events, {_round2(_mean('f.watched_percent'))} AS avg_watched_percent
           FROM fact f JOIN dim_media m ON f.media_id = m.media_id
           GROUP BY m.title ORDER BY engagement_events DESC, m.title"""
    ),
    "sql_watch_minutes": _q(
        f"""SELECT m.title, COUNT(*) AS engagement_events,
                  {_round2(_mean('f.watched_percent'))} AS avg_watched_percent,
                  {_round2(_exact('f.total_watch_time') + ' / 60.0')} AS estimated_watch_minutes
           FROM fact f JOIN dim_media m ON f.media_id = m.media_id
           GROUP BY m.title ORDER BY engagement_events DESC, m.title"""
    ),
    "sql_uniqueness": _q(
        "SELECT COUNT(*) AS fact_rows, COUNT(DISTINCT engagement_id) AS distinct_engagement_ids FROM fact"
    ),
    "sql_visitors_by_country": _q("SELECT country, COUNT(*) AS visitors FROM dim_visitor GROUP BY country"),
    "dq_duplicates": _q(
        """SELECT COUNT(*) AS rows, COUNT(DISTINCT event_key) AS distinct_keys,
                  COUNT(*) - COUNT(DISTINCT event_key) - COUNT(*) FILTER (WHERE event_key IS NULL) AS duplicate_rows,
                  COUNT(*) FILTER (WHERE event_key IS NULL) AS missing_keys
           FROM raw_events"""
    ),
    "dq_percent_range": _q(
        """SELECT MIN(percent_viewed) AS min_value, MAX(percent_viewed) AS max_value,
                  COUNT(*) FILTER (WHERE percent_viewed IS NOT NULL AND NOT (percent_viewed BETWEEN 0.0 AND 1.0)) AS out_of_range,
                  COUNT(*) FILTER (WHERE percent_viewed IS NULL) AS null_values
           FROM raw_events"""
    ),
    "dq_orphans": _q(
        """SELECT 'fact_media_engagement.media_id' AS relation, COUNT(*) AS orphan_rows FROM fact f
           WHERE f.media_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_media m WHERE m.media_id = f.media_id)
           UNION ALL
           SELECT 'fact_media_engagement.visitor_id', COUNT(*) FROM fact f
           WHERE f.visitor_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_visitor v WHERE v.visitor_id = f.visitor_id)"""
    ),
    "dq_report": _q(
        """, r AS (
             SELECT COUNT(*) AS fact_rows, COUNT(DISTINCT engagement_id) AS distinct_engagement_ids,
                    COUNT(*) - COUNT(DISTINCT engagement_id) - COUNT(*) FILTER (WHERE engagement_id IS NULL) AS duplicate_engagement_ids,
                    COUNT(*) FILTER (WHERE engagement_id IS NULL) AS missing_engagement_ids,
                    COUNT(*) FILTER (WHERE watched_percent IS NOT NULL AND NOT (watched_percent BETWEEN 0.0 AND 100.0)) AS watched_percent_out_of_range,
                    (SELECT COUNT(*) FROM fact f WHERE f.media_id IS NOT NULL
                       AND NOT EXISTS (SELECT 1 FROM dim_media m WHERE m.media_id = f.media_id)) AS orphan_media_rows,
                    (SELECT COUNT(*) FROM fact f WHERE f.visitor_id IS NOT NULL
                       AND NOT EXISTS (SELECT 1 FROM dim_visitor v WHERE v.visitor_id = f.visitor_id)) AS orphan_visitor_rows
             FROM fact)
           SELECT *, (duplicate_engagement_ids = 0 AND missing_engagement_ids = 0 AND watched_percent_out_of_range = 0
                      AND orphan_media_rows = 0 AND orphan_visitor_rows = 0) AS passed
           FROM r"""
    ),
    "profile_fields": _q(
        f""", {_RECORDS}
           SELECT field, {_JSON_TYPE} AS json_type, COUNT(*) AS records FROM kv GROUP BY 1, 2
           UNION ALL SELECT '$', 'record', COUNT(*) FROM src_events
           UNION ALL SELECT '$', 'object', COUNT(*) FROM recs
           UNION ALL SELECT '$', 'rejected', COUNT(*) FROM src_events WHERE media_id IS NULL HAVING COUNT(*) > 0"""
    ),
    "profile_nested": _q(
        """, nested AS (
             SELECT to_json({'user_agent_details': {'browser': browser, 'platform': platform, 'mobile': mobile},
                             'context': {'page': {'url': media_url, 'place': {'country': country, 'city': city}}},
                             'steps': list_transform(range(CAST(substr(event_key, 4) AS BIGINT) % 3), lambda i:
                               {'played': true, 'mark': {'share': percent_viewed,
                                'tags': CASE WHEN visitor_key IS NULL THEN []::VARCHAR[] ELSE [region, 'seen'] END}})}) AS j
             FROM src_events WHERE media_id IS NOT NULL),
           walked AS (
             SELECT regexp_replace(substr(t.fullkey, 3), '\\[[0-9]+\\]', '[]', 'g') AS field,
                    regexp_replace(substr(t.path, 3), '\\[[0-9]+\\]', '[]', 'g') AS parent, t.type, t.value, p.n
             FROM nested, json_tree(nested.j) t
             LEFT JOIN LATERAL (SELECT json_array_length(nested.j, t.path) AS n) p ON true)
           SELECT parent, field,
                  CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
                    WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS json_type,
                  COUNT(*) AS records,
                  CAST(MIN(CASE WHEN field LIKE '%[]' THEN n END) AS BIGINT) AS min_array_length,
                  CAST(MAX(CASE WHEN field LIKE '%[]' THEN n END) AS BIGINT) AS max_array_length
           FROM walked WHERE parent <> '' GROUP BY 1, 2, 3
           UNION ALL
           SELECT field, field || '[]', 'empty', COUNT(*), 0, 0 FROM walked WHERE type = 'ARRAY' AND json_array_length(value) = 0 GROUP BY 1"""
    ),
    "profile_snapshots": _q(
        f""", recs_m AS (
             SELECT to_json({{'hashed_id': hashed_id, 'name': name, 'created': created, 'updated': updated,
                              'duration': duration, 'status': status}}) AS j FROM raw_metadata),
           kv_m AS (SELECT j, unnest(json_keys(j)) AS field FROM recs_m),
           recs_s AS (SELECT to_json({{'play_rate': play_rate}}) AS j FROM raw_stats),
           kv_s AS (SELECT j, unnest(json_keys(j)) AS field FROM recs_s)
           SELECT field, {_JSON_TYPE} AS json_type, COUNT(*) AS records, 'media_metadata' AS source FROM kv_m GROUP BY 1, 2
           UNION ALL
           SELECT field, {_JSON_TYPE} AS json_type, COUNT(*) AS records, 'media_stats' AS source FROM kv_s GROUP BY 1, 2"""
    ),
    "visitor_last_event": _q(
        """SELECT v.visitor_key, v.event_key AS last_event_key, e.media_id AS last_media_id,
                  e.received_at AS last_received_at
           FROM latest_visitor v LEFT JOIN events_dedup e ON e.event_key = v.event_key"""
    ),
}
