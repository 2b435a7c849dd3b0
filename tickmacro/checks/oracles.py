"""The same results in plain SQL, written from the definitions, not from the plans."""

from __future__ import annotations

_TICKS = """
ticks AS (
  SELECT event_id, event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size,
         epoch_us(ts) // 1000 AS event_ts_ms,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time
  FROM events
)"""

_RELEASES = """
releases AS (
  SELECT event_id, event_type AS series_id, value AS macro_value,
         epoch_us(ts) // 1000 AS release_ts_ms,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS release_ts_utc,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events
)"""


def _bars(width: str = "1 minute") -> str:
    return f"""
bars AS (
  SELECT symbol,
         time_bucket(INTERVAL '{width}', event_time) AS window_start,
         time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end,
         min(price) AS open_price, max(price) AS high_price,
         min(price) AS low_price, max(price) AS close_price,
         CAST(sum(size) AS BIGINT) AS volume, count(*) AS tick_count
  FROM ticks GROUP BY ALL
)"""


_STATE = """
state AS (
  SELECT series_id, macro_value, release_ts_ms FROM releases
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY event_id DESC) = 1
)"""

_ENRICHED = """
SELECT b.symbol, b.window_start, b.close_price, b.volume, b.tick_count, s.series_id,
       s.macro_value, s.release_ts_ms,
       CAST(trunc((epoch_ms(b.window_start) - s.release_ts_ms) / 60000.0) AS BIGINT)
         AS macro_age_minutes
FROM bars b JOIN state s ON s.series_id = 'error'"""

_SILVER = """
silver AS (
  SELECT CAST(window_start AS DATE) AS dt, window_start AS bucket_1m_utc, symbol,
         open_price, high_price, low_price, close_price, volume, tick_count
  FROM bars
)"""

_SILVER_RELEASE = """
SELECT CAST(release_ts_utc AS DATE) AS dt, series_id, CAST(day AS DATE) AS observation_date,
       macro_value, release_ts_utc, CAST(day AS DATE) AS realtime_start,
       CAST(day AS DATE) AS realtime_end
FROM releases"""

_DAILY = """
daily AS (
  SELECT dt, symbol, arg_max(close_price, bucket_1m_utc) AS close_price,
         CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(tick_count) AS BIGINT) AS tick_count
  FROM silver GROUP BY dt, symbol
)"""

_ORDER_DAILY = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS dt, o_orderpriority AS symbol,
         max(o_totalprice) AS close_price, count(*) AS volume, count(*) AS tick_count
  FROM orders GROUP BY ALL
)"""

_ORDER_RELEASES = """
releases AS (
  SELECT l_returnflag AS series_id, l_extendedprice AS macro_value,
         l_shipdate AS release_ts_utc
  FROM lineitem
)"""


def _aligned(series: str) -> str:
    return f"""
aligned AS (
  SELECT m.symbol, m.close_price, m.volume, m.tick_count,
         max(CASE WHEN r.release_ts_utc = m.newest THEN r.macro_value END) AS macro_value,
         m.newest AS macro_release_ts_utc, m.dt
  FROM (
    SELECT d.*, (
      SELECT max(r.release_ts_utc) FROM releases r
      WHERE r.series_id = '{series}'
        AND r.release_ts_utc < CAST(d.dt AS TIMESTAMP) + INTERVAL 1 DAY
    ) AS newest
    FROM daily d
  ) m
  LEFT JOIN releases r ON r.series_id = '{series}' AND r.release_ts_utc = m.newest
  GROUP BY m.symbol, m.close_price, m.volume, m.tick_count, m.newest, m.dt
)"""


_CORRELATION = """
correlation AS (
  SELECT symbol, dt,
         CASE WHEN isnan(c) OR low = high OR mlow = mhigh THEN NULL ELSE c END
           AS rolling_corr_30d
  FROM (
    SELECT symbol, dt, corr(close_price, macro_value) OVER w AS c,
           min(close_price) OVER w AS low, max(close_price) OVER w AS high,
           min(macro_value) OVER w AS mlow, max(macro_value) OVER w AS mhigh
    FROM aligned
    WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
  )
)"""

_SERVING = """
serving AS (
  SELECT date_trunc('minute', window_start) AS time, symbol, close_price AS close_price_sum,
         volume AS volume_proxy_sum, tick_count AS tick_count_sum,
         strftime(window_start, '%Y-%m-%d-%H') AS hour, window_start
  FROM bars
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_EVENT_BARS = (_TICKS, _bars())
_EVENT_GOLD = (_TICKS, _RELEASES, _bars(), _SILVER, _DAILY, _aligned("error"))
_ORDER_GOLD = (_ORDER_RELEASES, _ORDER_DAILY, _aligned("N"))
_ROUNDED_CORR = "SELECT symbol, round(rolling_corr_30d, 9) AS rolling_corr_30d, dt FROM correlation"

_TICK_FIELDS = """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'events' AS source, symbol AS entity_key,
       event_ts_ms, event_ts_ms AS ingest_ts_ms, 'v1' AS schema_version"""
_RELEASE_FIELDS = """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'events' AS source, series_id AS entity_key,
       release_ts_ms AS event_ts_ms, release_ts_ms AS ingest_ts_ms, 'v1' AS schema_version"""

_OBSERVATIONS = """
texts AS (
  SELECT event_type AS series_id, strftime(ts, '%Y-%m-%d') AS date,
         strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS later,
         CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS number
  FROM events
), listed AS (
  SELECT series_id, date, number AS value, later AS realtime_start, later AS realtime_end
  FROM texts
  UNION ALL SELECT series_id, date, '.', later, later FROM texts
  UNION ALL SELECT series_id, date, NULL, later, later FROM texts
  UNION ALL SELECT series_id, date, number, '', NULL FROM texts
)"""
_OBSERVED = """
SELECT series_id, date AS observation_date, CAST(value AS DOUBLE) AS value,
       CAST(date_diff('day', DATE '1970-01-01', CAST(
         CASE WHEN realtime_start IS NULL OR realtime_start = '' THEN date
              ELSE realtime_start END AS DATE)) AS BIGINT) * 86400000 AS release_ts_ms,
       coalesce(realtime_start, date) AS realtime_start,
       coalesce(realtime_end, date) AS realtime_end"""

_MIDDLE = """
middle AS (
  SELECT date_trunc('minute', make_timestamp((min(event_ts_ms) + max(event_ts_ms)) // 2 * 1000)) AS moment FROM ticks
)"""

_BROKEN = "event_type IN ('signup', 'error') OR event_id % 10 IN (3, 7)"

ORACLES: dict[str, str] = {
    "raw_tick_decode": f"""{_with(_TICKS)} {_TICK_FIELDS}, event_time, symbol,
       round(price, 4) AS price, size FROM ticks""",
    "raw_macro_decode": f"""{_with(_RELEASES)} {_RELEASE_FIELDS}, release_ts_utc AS event_time,
       series_id, day AS observation_date, macro_value AS value, release_ts_ms,
       day AS realtime_start, day AS realtime_end FROM releases""",
    "market_envelope": f"""{_with(_TICKS)} {_TICK_FIELDS},
       'raw.market.finnhub.tick.v1' AS topic, symbol AS key, symbol AS payload_symbol,
       round(price, 4) AS payload_price, size AS payload_size FROM ticks""",
    "macro_envelope": f"""{_with(_RELEASES)} {_RELEASE_FIELDS},
       'raw.macro.fred.release.v1' AS topic, series_id AS key, series_id AS payload_series_id,
       day AS payload_observation_date, macro_value AS payload_value,
       release_ts_ms AS payload_release_ts_ms, day AS payload_realtime_start,
       day AS payload_realtime_end FROM releases""",
    "raw_tick_sample": f"""{_with(_TICKS)} {_TICK_FIELDS}, symbol, round(price, 4) AS price, size
       FROM ticks ORDER BY event_ts_ms, CAST(event_id AS VARCHAR) LIMIT 3""",
    "dead_letter_split": f"""
SELECT CAST(event_id AS VARCHAR) AS key,
       CASE WHEN {_BROKEN} THEN 'dlq.raw.market.finnhub.tick.v1'
            ELSE 'raw.market.finnhub.tick.v1' END AS topic,
       CASE WHEN NOT ({_BROKEN}) THEN value END AS price
FROM events""",
    "release_dead_letter_split": f"""
SELECT CAST(event_id AS VARCHAR) AS key,
       CASE WHEN {_BROKEN} THEN 'dlq.raw.macro.fred.release.v1'
            ELSE 'raw.macro.fred.release.v1' END AS topic,
       CASE WHEN NOT ({_BROKEN}) THEN value END AS value
FROM events""",
    "response_dead_letters": f"""
SELECT CAST(event_id AS VARCHAR) AS key, kind, ({_BROKEN}) AS dead,
       CASE WHEN {_BROKEN} THEN NULL WHEN kind = 'quote' THEN value
            ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) END AS price
FROM events, (VALUES ('quote'), ('observations')) k(kind)""",
    "dry_run": f"""{_with(_TICKS)}
SELECT 'raw.market.finnhub.tick.v1' AS topic, symbol AS key, CAST(event_id AS VARCHAR) AS event_id,
       round(price, 4) AS price FROM ticks""",
    "fred_observations": f"""{_with(_OBSERVATIONS)} {_OBSERVED}
FROM listed WHERE value <> '.' AND series_id IN ('error', 'signup', 'view')""",
    "fred_observations_latest": f"""{_with(_OBSERVATIONS)} {_OBSERVED}
FROM (
  SELECT * FROM listed
  QUALIFY row_number() OVER (
    PARTITION BY series_id ORDER BY date DESC, realtime_start DESC NULLS LAST,
      realtime_end DESC NULLS LAST, value DESC NULLS LAST) <= 200
) WHERE value <> '.'""",
    "finnhub_quotes": """
SELECT event_type AS symbol, value AS price,
       (epoch_us(ts) // 1000000) * 1000 AS event_ts_ms, CAST(1 AS BIGINT) AS size
FROM events""",
    "market_bar_1m": f"{_with(*_EVENT_BARS)} SELECT * FROM bars",
    "market_bar_1h": f"{_with(_TICKS, _bars('1 hour'))} SELECT * FROM bars",
    "market_bar_true_ohlc": f"""{_with(_TICKS)}
SELECT symbol, date_trunc('hour', event_time) AS window_start,
       date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
       arg_min(price, {{'t': event_time, 'i': CAST(event_id AS VARCHAR)}}) AS open_price,
       max(price) AS high_price, min(price) AS low_price,
       arg_max(price, {{'t': event_time, 'i': CAST(event_id AS VARCHAR)}}) AS close_price,
       CAST(sum(size) AS BIGINT) AS volume, count(*) AS tick_count
FROM ticks GROUP BY ALL""",
    "macro_latest_state": f"{_with(_RELEASES, _STATE)} SELECT * FROM state",
    "enriched_market_macro_1m": f"{_with(_TICKS, _RELEASES, _bars(), _STATE)} {_ENRICHED}",
    "silver_market_bar_1m": f"{_with(*_EVENT_BARS, _SILVER)} SELECT * FROM silver",
    "silver_macro_release": f"{_with(_RELEASES)} {_SILVER_RELEASE}",
    "market_daily": f"{_with(*_EVENT_BARS, _SILVER, _DAILY)} SELECT * FROM daily",
    "market_daily_multiyear": f"{_with(_ORDER_DAILY)} SELECT * FROM daily",
    "market_macro_aligned_daily": f"{_with(*_EVENT_GOLD)} SELECT * FROM aligned",
    "market_macro_aligned_daily_multiyear": f"{_with(*_ORDER_GOLD)} SELECT * FROM aligned",
    "market_macro_correlation_daily": f"{_with(*_EVENT_GOLD, _CORRELATION)} {_ROUNDED_CORR}",
    "market_macro_correlation_daily_multiyear": (
        f"{_with(*_ORDER_GOLD, _CORRELATION)} {_ROUNDED_CORR}"
    ),
    "correlation_latest": f"""{_with(*_ORDER_GOLD, _CORRELATION)} {_ROUNDED_CORR}
WHERE symbol = '1-URGENT' ORDER BY dt DESC LIMIT 50""",
    "avg_corr_by_symbol": f"""{_with(*_ORDER_GOLD, _CORRELATION)}
SELECT symbol, round(avg(rolling_corr_30d), 9) AS avg_corr_30d FROM correlation GROUP BY symbol
ORDER BY avg_corr_30d DESC NULLS LAST, symbol""",
    "table_row_counts": f"""{_with(*_EVENT_GOLD)}
SELECT 'market_bar_1m' AS table_name, count(*) AS row_count FROM bars
UNION ALL SELECT 'macro_release', count(*) FROM releases
UNION ALL SELECT 'market_macro_aligned_daily', count(*) FROM aligned
UNION ALL SELECT 'market_macro_correlation_daily', count(*) FROM aligned""",
    "gold_refresh_incremental": f"""{_with(*_EVENT_GOLD, _CORRELATION)}
SELECT a.*, round(c.rolling_corr_30d, 9) AS rolling_corr_30d
FROM aligned a JOIN correlation c ON c.symbol = a.symbol AND c.dt = a.dt""",
    "monitor_recent_bars": f"""{_with(*_EVENT_BARS)}
SELECT window_start AS bucket_1m_utc, symbol, open_price, close_price, volume, tick_count
FROM bars ORDER BY window_start DESC, symbol LIMIT 50""",
    "monitor_close_timeseries": f"""{_with(*_EVENT_BARS, _MIDDLE)}
SELECT window_start AS bucket_1m_utc, symbol, round(avg(close_price), 9) AS avg_close_price
FROM bars
WHERE window_start BETWEEN (SELECT moment FROM middle) - INTERVAL 1 HOUR AND (SELECT moment FROM middle)
GROUP BY ALL ORDER BY avg_close_price DESC, bucket_1m_utc, symbol LIMIT 1000""",
    "serving_bar_minute": f"""{_with(*_EVENT_BARS, _SERVING)}
SELECT * EXCLUDE (window_start) FROM serving""",
    "serving_bar_rollup": f"""{_with(_TICKS, _bars('10 seconds'), _SERVING)}
SELECT time, symbol, round(sum(close_price_sum), 9) AS close_price_sum,
       CAST(sum(volume_proxy_sum) AS BIGINT) AS volume_proxy_sum,
       CAST(sum(tick_count_sum) AS BIGINT) AS tick_count_sum
FROM serving GROUP BY ALL""",
    "serving_late_reject": f"""{_with(*_EVENT_BARS, _SERVING)}
SELECT * EXCLUDE (window_start, hour) FROM serving
WHERE window_start >= (SELECT date_trunc('hour', max(event_time)) FROM ticks) - INTERVAL 2 HOUR""",
    "retention_keep": f"""{_with(*_EVENT_BARS, _SERVING)}
SELECT * EXCLUDE (window_start, hour) FROM serving
WHERE time >= (SELECT max(event_time) FROM ticks) - INTERVAL 7 DAY""",
    "retention_keep_days": f"""{_with(*_EVENT_BARS, _SILVER)}
SELECT * FROM silver WHERE dt >= (SELECT CAST(max(event_time) AS DATE) FROM ticks) - 7""",
    "changelog_compact": """
SELECT user_id, event_type, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "market_bar_1m_stream": f"{_with(*_EVENT_BARS)} SELECT * FROM bars",
    "silver_market_bar_1m_stream": f"{_with(*_EVENT_BARS, _SILVER)} SELECT * FROM silver",
    "silver_macro_release_stream": f"{_with(_RELEASES)} {_SILVER_RELEASE}",
    "macro_latest_state_stream": f"{_with(_RELEASES, _STATE)} SELECT * FROM state",
    "enriched_market_macro_1m_stream": f"{_with(_TICKS, _RELEASES, _bars(), _STATE)} {_ENRICHED}",
    "serving_bar_minute_stream": f"""{_with(*_EVENT_BARS, _SERVING)}
SELECT * EXCLUDE (window_start) FROM serving""",
}
ORACLES["monitor_recent_bars_stored"] = ORACLES["monitor_recent_bars"]
ORACLES["dead_letter_split_stream"] = ORACLES["dead_letter_split"]
ORACLES["curated_bar_events"] = ORACLES["market_bar_1m"]
ORACLES["state_events"] = ORACLES["macro_latest_state"]
ORACLES["enriched_events"] = ORACLES["enriched_market_macro_1m"]
ORACLES["enriched_proc_time"] = ORACLES["enriched_market_macro_1m"]
ORACLES["external_stream_scan"] = ORACLES["silver_market_bar_1m"]
ORACLES["external_release_scan"] = ORACLES["silver_macro_release"]
ORACLES["restart_stream"] = ORACLES["market_bar_1m"]
ORACLES["segments_merged"] = ORACLES["serving_bar_minute"].replace("(window_start)", "(window_start, hour)")
ORACLES["retention_drop"] = f"""
{_with(_TICKS, _RELEASES, _bars(), _STATE)},
events_of AS (
  SELECT kind || topic AS topic, days, event_id, CAST(ts AS DATE) AS dt, dead = ({_BROKEN}) AS its
  FROM events, (VALUES ('', 'raw.market.finnhub.tick.v1', 7, false), ('dlq.', 'raw.market.finnhub.tick.v1', 14, true),
                       ('', 'raw.macro.fred.release.v1', 365, false), ('dlq.', 'raw.macro.fred.release.v1', 14, true)) k(kind, topic, days, dead)
),
left_over AS (
  SELECT topic, days, dt, event_id AS size FROM events_of WHERE its
  UNION ALL SELECT 'curated.market.bar.1m.v1', 30, CAST(window_start AS DATE), tick_count FROM bars
  UNION ALL SELECT 'analytics.market_macro.1m.v1', 30, CAST(window_start AS DATE), volume FROM ({_ENRICHED})
)
SELECT topic, dt, count(*) AS n, CAST(sum(size) AS BIGINT) AS total FROM left_over
WHERE dt >= (SELECT CAST(max(ts) AS DATE) FROM events) - days GROUP BY topic, dt"""
# A part comes with each batch; a fifth of the ticks come one part late or two. What is late
# in a batch is decided by the watermark that the batch before it began with.
ORACLES["late_tick_stream"] = f"""
{_with(_TICKS)},
spans AS (SELECT min(event_ts_ms) AS low, max(event_ts_ms) AS high FROM ticks),
arrived AS (
  SELECT t.*, least(least(5, (event_ts_ms - low) * 6 // greatest(high - low, 1))
                    + CASE event_id % 10 WHEN 4 THEN 1 WHEN 8 THEN 2 ELSE 0 END, 6) AS batch,
         time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end
  FROM ticks t, spans
),
told AS (SELECT b AS batch, max(event_time) - INTERVAL 10 SECOND AS mark FROM range(7) r(b) JOIN arrived a ON a.batch <= b - 2 GROUP BY b),
judged AS (SELECT a.*, coalesce(a.window_end <= w.mark, false) AS late FROM arrived a LEFT JOIN told w ON w.batch = a.batch)
SELECT symbol, window_end - INTERVAL '1 minute' AS window_start, window_end, min(price) AS open_price, max(price) AS high_price,
       min(price) AS low_price, max(price) AS close_price, CAST(sum(size) AS BIGINT) AS volume, count(*) AS tick_count,
       (SELECT count(*) FROM judged) AS ticks, (SELECT count(*) FROM judged WHERE late) AS ticks_dropped
FROM judged WHERE NOT late GROUP BY symbol, window_end"""
