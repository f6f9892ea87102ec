"""The same queries as SQL over the raw test tables, written independently of the
operators, for comparison in another engine."""

from __future__ import annotations

TIME = "'%Y-%m-%d %H:%M:%S.%f'"

_TXN = """
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         event_id,
         printf('user_%04d', user_id) AS user_id,
         user_id AS user_no,
         value AS amount,
         printf('merchant_%04d', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS merchant_id,
         CASE WHEN event_id % 50 <> 0
              THEN ((event_id * 7919) % 18000) / CAST(100.0 AS DOUBLE) - 90 END AS merchant_lat,
         CASE WHEN event_id % 50 <> 0
              THEN ((event_id * 104729) % 36000) / CAST(100.0 AS DOUBLE) - 180 END AS merchant_lon,
         event_type AS status,
         ts AS event_time,
         ts + INTERVAL 2 SECOND AS ingest_time,
         'transactions-raw' AS k_topic,
         event_id % 6 AS k_partition,
         event_id // 6 AS k_offset
  FROM events
)"""

_CUST = """
cust AS (
  SELECT user_id,
         CASE (user_no + 1) % 3 WHEN 0 THEN 'PREMIUM' WHEN 1 THEN 'BASIC' ELSE 'PREPAID' END AS plan,
         avg(amount) AS avg_amount_30d
  FROM txn WHERE (user_no + 1) % 25 <> 0
  GROUP BY user_id, user_no
)"""

_RISK = """
risk AS (
  SELECT user_id, merchant_lat AS last_merchant_lat, merchant_lon AS last_merchant_lon,
         event_time AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                     ORDER BY event_time DESC, transaction_id) AS rn
        FROM txn WHERE event_time < TIMESTAMP '2024-01-20 00:00:00')
  WHERE rn = 1
)"""


def _snapshot(seconds: int, valid: str = "amount IS NOT NULL") -> str:
    return f"""
velocity AS (
  SELECT user_id, count(*) AS velocity_5min
  FROM (SELECT user_id, event_time, max(event_time) OVER (PARTITION BY user_id) AS newest
        FROM txn WHERE {valid})
  WHERE event_time >= newest - INTERVAL {seconds} SECOND
  GROUP BY user_id
)"""


_DISTANCE = """
distance AS (
  SELECT t.*, r.updated_at, r.last_merchant_lat, r.last_merchant_lon,
         coalesce(pow(sin(radians(merchant_lat - last_merchant_lat) / 2), 2)
           + cos(radians(last_merchant_lat)) * cos(radians(merchant_lat))
             * pow(sin(radians(merchant_lon - last_merchant_lon) / 2), 2), 0) AS chord,
         (epoch_us(event_time) - epoch_us(updated_at)) / CAST(3600000000.0 AS DOUBLE) AS hours
  FROM txn t LEFT JOIN risk r USING (user_id)
),
speed AS (
  SELECT *, 2 * 6371.0 * atan2(sqrt(least(chord, 1)), sqrt(1 - least(chord, 1))) AS km,
         CASE WHEN hours > 0
              THEN 2 * 6371.0 * atan2(sqrt(least(chord, 1)), sqrt(1 - least(chord, 1))) / hours
              ELSE 0 END AS geo_speed_kmh
  FROM distance
)"""

_PRICED = """
priced AS (
  SELECT t.*, coalesce(c.plan, 'unknown') AS plan,
         coalesce(c.avg_amount_30d, 0) AS avg_amount_30d,
         CASE WHEN c.avg_amount_30d > 0
              THEN (amount - c.avg_amount_30d) / (c.avg_amount_30d * CAST(0.3 AS DOUBLE)) ELSE 0
         END AS amount_zscore
  FROM txn t LEFT JOIN cust c USING (user_id)
)"""


def _scored(seconds: int = 300, valid: str = "amount IS NOT NULL") -> str:
    return ",".join([_TXN, _CUST, _RISK, _snapshot(seconds, valid), _DISTANCE, _PRICED]) + f""",
points AS (
  SELECT p.*, v.velocity_5min, s.geo_speed_kmh,
         CASE WHEN v.velocity_5min > 5 THEN 40 ELSE 0 END AS score_velocity,
         CASE WHEN p.amount_zscore > 3 THEN 30 ELSE 0 END AS score_zscore,
         CASE WHEN s.geo_speed_kmh > 500 THEN 30 ELSE 0 END AS score_geo
  FROM priced p JOIN velocity v USING (user_id) JOIN speed s USING (transaction_id)
  WHERE p.{valid}
),
scored AS (
  SELECT *, score_velocity + score_zscore + score_geo AS fraud_score,
         score_velocity + score_zscore + score_geo >= 60 AS is_flagged,
         concat_ws(',', CASE WHEN score_velocity > 0 THEN 'HIGH_VELOCITY' END,
                        CASE WHEN score_zscore > 0 THEN 'AMOUNT_ANOMALY' END,
                        CASE WHEN score_geo > 0 THEN 'GEO_IMPOSSIBLE' END) AS reasons
  FROM points
),
alerts AS (
  SELECT transaction_id, user_id, fraud_score, reasons, ingest_time AS flagged_at
  FROM scored WHERE is_flagged
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _time(column: str) -> str:
    return f"strftime({column}, {TIME}) AS {column}"


def _json_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ') AS {column}"


def _six(column: str) -> str:
    return f"round({column}, 6) AS {column}"


TXN = _with(_TXN)
LOCATED = _with(_TXN, _RISK, _DISTANCE)
SCORED = "WITH " + _scored()
SCORED_DAY = "WITH " + _scored(86_400)

# A stream rejects amounts that are not positive before it counts and scores.
STREAMED = "WITH " + _scored(300, "amount > 0")
STREAMED_DAY = "WITH " + _scored(86_400, "amount > 0")

_KIND = """
CASE event_id % 101
  WHEN 0 THEN 'missing_transaction_id' WHEN 1 THEN 'missing_user_id'
  WHEN 2 THEN 'non_positive_amount' WHEN 3 THEN 'non_positive_amount'
  WHEN 6 THEN 'schema_parse_error' WHEN 7 THEN 'missing_transaction_id'
  WHEN 8 THEN 'missing_amount'
  ELSE CASE WHEN amount <= 0 THEN 'non_positive_amount'
            WHEN event_id % 101 = 4 THEN 'missing_merchant_id'
            WHEN event_id % 101 = 5 THEN 'bad_timestamp' ELSE 'ok' END
END"""

_RAW = """
CASE WHEN event_id % 101 = 7 THEN '' WHEN event_id % 101 NOT IN (0, 6) THEN transaction_id
END AS raw_transaction_id,
CASE WHEN event_id % 101 NOT IN (0, 1, 6) THEN user_id END AS raw_user_id,
CASE WHEN event_id % 101 = 4 THEN '' WHEN event_id % 101 NOT IN (0, 6) THEN merchant_id
END AS raw_merchant_id,
CASE WHEN event_id % 101 NOT IN (0, 6) THEN status END AS raw_status,
CASE WHEN event_id % 101 = 5 THEN 'nope' WHEN event_id % 101 NOT IN (0, 6)
     THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS raw_timestamp,
CASE event_id % 101 WHEN 2 THEN 0.0 WHEN 3 THEN -1.0 WHEN 0 THEN NULL WHEN 6 THEN NULL
     WHEN 8 THEN NULL ELSE amount END AS raw_amount,
CASE WHEN event_id % 101 = 0 THEN '{bad' END AS raw_text"""

_PROFILES = """
profiles AS (
  SELECT user_id, avg(amount) AS avg_amount_30d, stddev_pop(amount) AS stddev_amount,
         count(*) / CAST(24.0 AS DOUBLE) AS avg_velocity_1h,
         max(merchant_lat) AS last_merchant_lat, max(merchant_lon) AS last_merchant_lon
  FROM txn WHERE event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY
  GROUP BY user_id
)"""

_LAKE = """
lake AS (
  SELECT transaction_id, user_id, amount, ingest_time, k_topic, k_partition, k_offset
  FROM txn WHERE event_time < TIMESTAMP '2024-01-20 00:00:00'
),
fresh AS (
  SELECT transaction_id, user_id, amount, ingest_time, k_topic, k_partition, k_offset
  FROM txn WHERE event_time >= TIMESTAMP '2024-01-20 00:00:00'
)"""

_NEWEST = """
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                   ORDER BY event_time DESC, k_partition DESC, k_offset DESC) AS rn FROM txn)
  WHERE rn = 1
)"""

_LAKE_COLUMNS = f"transaction_id, user_id, {_six('amount')}, {_time('ingest_time')}, k_topic, k_partition, k_offset"


def _trailing(seconds: int) -> str:
    return (
        "count(*) OVER (PARTITION BY user_id ORDER BY event_time "
        f"RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)"
    )


def _totals(column: str) -> str:
    return f"CAST(sum({column}) OVER (ORDER BY batch_id) AS BIGINT) AS acc_{column}"


def _streamed_velocity(seconds: int) -> str:
    """The rule per micro-batch: a user's events so far, cut to the span before the newest."""
    return f"""{TXN},
batches AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-11 00:00:00' THEN 0
                 WHEN event_time < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END AS batch
  FROM txn WHERE amount > 0
),
present AS (SELECT user_id, batch, max(event_time) AS newest FROM batches GROUP BY user_id, batch),
velocity AS (
  SELECT p.user_id, p.batch, count(*) AS velocity_5min
  FROM present p JOIN batches b ON b.user_id = p.user_id AND b.batch <= p.batch
  WHERE b.event_time >= p.newest - INTERVAL {seconds} SECOND
  GROUP BY p.user_id, p.batch
)
SELECT transaction_id, user_id, velocity_5min FROM batches JOIN velocity USING (user_id, batch)"""


ORACLES: dict[str, str] = {
    "project_kafka_meta": f"""{TXN}
SELECT k_topic, CAST(k_partition AS INTEGER) AS k_partition, k_offset, transaction_id FROM txn""",
    "expand_txn": f"""{TXN}
SELECT k_topic, CAST(k_partition AS INTEGER) AS k_partition, k_offset, transaction_id, user_id,
       {_six('amount')}, merchant_id, {_six('merchant_lat')}, {_six('merchant_lon')}, status,
       {_time('event_time')}, '2024-01-31 00:00:00.000000' AS ingest_time
FROM txn""",
    "validate_dlq_reason": f"""{TXN}
SELECT k_topic, CAST(k_partition AS INTEGER) AS k_partition, k_offset, {_KIND} AS reason
FROM txn""",
    "split_good_bad": f"""{TXN}
SELECT side, CAST(k_partition AS INTEGER) AS k_partition, count(*) AS n
FROM (SELECT CASE WHEN {_KIND} = 'ok' THEN 'good' ELSE 'bad' END AS side, k_partition FROM txn)
GROUP BY side, k_partition""",
    "emit_dlq": f"""{TXN}
SELECT * FROM (
  SELECT {_KIND} AS reason, k_topic AS topic, k_partition AS "partition", k_offset AS "offset",
         '2024-01-31 00:00:00' AS ingest_time, {_RAW} FROM txn)
WHERE reason <> 'ok'""",
    "ingest_normalize": f"""{TXN}
SELECT 'accepted' AS side, CAST(36 AS INTEGER) AS id_length, user_id, merchant_id,
       CASE WHEN status = 'view' THEN 'pending' ELSE status END AS status,
       '2024-01-31T00:00:00.000000Z' AS "timestamp", round(amount - 1.0, 6) AS amount,
       {_six('merchant_lat')}, {_six('merchant_lon')}
FROM txn WHERE amount - 1.0 > 0
UNION ALL
SELECT 'rejected', 0, user_id, merchant_id, CASE WHEN status <> 'view' THEN status END, NULL,
       round(amount - 1.0, 6), {_six('merchant_lat')}, {_six('merchant_lon')}
FROM txn WHERE amount - 1.0 <= 0""",
    "load_customers_dim": f"""{_with(_TXN, _CUST)}
SELECT user_id, plan, {_six('avg_amount_30d')} FROM cust""",
    "load_risk_profiles": f"""{_with(_TXN, _RISK)}
SELECT user_id, {_six('last_merchant_lat')}, {_six('last_merchant_lon')}, {_time('updated_at')}
FROM risk""",
    "enrich_customers": f"""{_with(_TXN, _CUST)}
SELECT transaction_id, user_id, {_six('amount')}, plan, {_six('avg_amount_30d')}
FROM txn LEFT JOIN cust USING (user_id)""",
    "enrich_risk": f"""{_with(_TXN, _RISK)}
SELECT transaction_id, user_id, {_six('last_merchant_lat')}, {_six('last_merchant_lon')},
       {_time('updated_at')}
FROM txn LEFT JOIN risk USING (user_id)""",
    "fill_enrichment_defaults": f"""{_with(_TXN, _CUST, _PRICED)}
SELECT transaction_id, plan, {_six('avg_amount_30d')} FROM priced""",
    "velocity_trailing": f"""{TXN}
SELECT transaction_id, user_id, {_trailing(300)} AS velocity_5min FROM txn""",
    "velocity_trailing_24h": f"""{TXN}
SELECT transaction_id, user_id, {_trailing(86400)} AS velocity_5min FROM txn""",
    "velocity_snapshot": f"""{_with(_TXN, _snapshot(300))}
SELECT transaction_id, user_id, velocity_5min FROM txn JOIN velocity USING (user_id)""",
    "velocity_snapshot_24h": f"""{_with(_TXN, _snapshot(86400))}
SELECT transaction_id, user_id, velocity_5min FROM txn JOIN velocity USING (user_id)""",
    "haversine_km": f"{LOCATED} SELECT transaction_id, {_six('km')} FROM speed",
    "geo_speed_kmh": f"""{LOCATED}
SELECT transaction_id, round(geo_speed_kmh, 3) AS geo_speed_kmh FROM speed""",
    "amount_zscore": f"""{_with(_TXN, _CUST, _PRICED)}
SELECT transaction_id, {_six('amount_zscore')} FROM priced""",
    "score_velocity": f"""{TXN}
SELECT transaction_id, CAST(CASE WHEN v > 5 THEN 40 ELSE 0 END AS INTEGER) AS score_velocity
FROM (SELECT transaction_id, {_trailing(86400)} AS v FROM txn)""",
    "score_zscore": f"""{_with(_TXN, _CUST, _PRICED)}
SELECT transaction_id, CASE WHEN amount_zscore > 3 THEN 30 ELSE 0 END AS score_zscore
FROM priced""",
    "score_geo": f"""{LOCATED}
SELECT transaction_id, CASE WHEN geo_speed_kmh > 500 THEN 30 ELSE 0 END AS score_geo FROM speed""",
    "fraud_score": f"""{SCORED}
SELECT transaction_id, score_velocity, score_zscore, score_geo, fraud_score FROM scored""",
    "fraud_score_24h": f"""{SCORED_DAY}
SELECT transaction_id, velocity_5min, fraud_score, is_flagged, reasons FROM scored""",
    "is_flagged": f"{SCORED} SELECT transaction_id, fraud_score, is_flagged FROM scored",
    "reasons": f"{SCORED} SELECT transaction_id, reasons FROM scored",
    "flagged_only": f"""{SCORED}
SELECT transaction_id, user_id, fraud_score, reasons FROM scored WHERE is_flagged""",
    "sink_transactions": f"""{SCORED}
SELECT transaction_id, user_id, {_six('amount')}, merchant_id, {_six('merchant_lat')},
       {_six('merchant_lon')}, status, {_time('event_time')}, {_time('ingest_time')}, plan,
       velocity_5min, {_six('amount_zscore')},
       round(round(geo_speed_kmh, 3), 6) AS geo_speed_kmh, fraud_score, is_flagged
FROM scored""",
    "sink_fraud_scores": f"""{SCORED}
SELECT transaction_id, user_id, fraud_score, reasons, {_time('flagged_at')},
       CAST(NULL AS BOOLEAN) AS reviewed
FROM alerts""",
    "sink_last_location": f"""{_with(_TXN, _NEWEST)}
SELECT user_id, round(merchant_lat, 6) AS last_merchant_lat,
       round(merchant_lon, 6) AS last_merchant_lon, strftime(event_time, {TIME}) AS updated_at
FROM newest""",
    "merge_profiles": f"""{TXN},
daily AS (
  SELECT user_id, avg(amount) AS a, stddev_pop(amount) AS s, count(*) / CAST(24.0 AS DOUBLE) AS v,
         max(merchant_lat) AS lat, max(merchant_lon) AS lon,
         TIMESTAMP '2024-01-20 00:00:00' AS built
  FROM txn WHERE event_time < TIMESTAMP '2024-01-20 00:00:00'
             AND event_time >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 30 DAY
  GROUP BY user_id
),
late AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
             ORDER BY event_time DESC, k_partition DESC, k_offset DESC) AS rn
    FROM txn WHERE event_time >= TIMESTAMP '2024-01-20 00:00:00') WHERE rn = 1
)
SELECT coalesce(d.user_id, l.user_id) AS user_id, round(a, 6) AS avg_amount_30d,
       round(s, 6) AS stddev_amount, round(v, 6) AS avg_velocity_1h,
       round(CASE WHEN l.user_id IS NULL THEN lat ELSE merchant_lat END, 6) AS last_merchant_lat,
       round(CASE WHEN l.user_id IS NULL THEN lon ELSE merchant_lon END, 6) AS last_merchant_lon,
       strftime(CASE WHEN l.user_id IS NULL THEN built ELSE event_time END, {TIME}) AS updated_at
FROM daily d FULL JOIN late l ON d.user_id = l.user_id""",
    "emit_alerts": f"""{SCORED}
SELECT user_id AS "key", transaction_id, user_id, reasons,
       rtrim(rtrim(strftime(ingest_time, {TIME}), '0'), '.') AS flagged_at, amount,
       CAST(fraud_score AS DOUBLE) AS fraud_score
FROM scored WHERE is_flagged""",
    "emit_clean": f"""{SCORED}
SELECT user_id AS "key", transaction_id, user_id, merchant_id, status, plan,
       CASE WHEN is_flagged THEN 'true' ELSE 'false' END AS is_flagged, {_json_time('event_time')},
       amount, CAST(fraud_score AS DOUBLE) AS fraud_score
FROM scored""",
    "emit_scored": f"""{SCORED}
SELECT transaction_id AS "key", transaction_id, user_id, merchant_id, status, reasons,
       CASE WHEN is_flagged THEN 'true' ELSE 'false' END AS is_flagged, k_topic,
       {_json_time('event_time')}, {_json_time('ingest_time')}, amount,
       merchant_lat, merchant_lon, CAST(fraud_score AS DOUBLE) AS fraud_score,
       CAST(k_partition AS DOUBLE) AS k_partition, CAST(k_offset AS DOUBLE) AS k_offset
FROM scored""",
    "parse_scored": f"""{SCORED}
SELECT transaction_id, user_id, {_six('amount')}, merchant_id, {_six('merchant_lat')},
       {_six('merchant_lon')}, status,
       {_time('event_time')}, {_time('ingest_time')},
       fraud_score, is_flagged, reasons, k_topic, k_partition, k_offset
FROM scored""",
    "latest_per_user": f"""{_with(_TXN, _NEWEST)}
SELECT user_id, transaction_id, {_six('amount')}, {_time('event_time')} FROM newest""",
    "latest_by_key": f"""{TXN}
SELECT transaction_id, user_id,
       CASE WHEN event_time >= TIMESTAMP '2024-01-20 00:00:00' THEN 'final_' ELSE '' END || status
         AS status,
       {_time('event_time')},
       CAST(CASE WHEN event_time >= TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 0 END AS BIGINT)
         AS batch_id
FROM txn""",
    "merge_anti": f"{_with(_TXN, _LAKE)} SELECT {_LAKE_COLUMNS} FROM fresh",
    "lake_merge_insert": f"""{_with(_TXN, _LAKE)}
SELECT {_LAKE_COLUMNS} FROM (SELECT * FROM lake UNION ALL SELECT * FROM fresh)""",
    "batch_stats": f"""{SCORED}
SELECT count(*) AS total, count(*) FILTER (is_flagged) AS flagged,
       count(*) FILTER (score_geo > 0) AS geo_hits
FROM scored""",
    "running_totals": f"""{SCORED},
ledger AS (
  SELECT CAST(floor(epoch_us(event_time) / 3600000000.0) AS BIGINT) AS batch_id, count(*) AS total,
         count(*) FILTER (is_flagged) AS flagged, count(*) FILTER (score_geo > 0) AS geo_hits
  FROM scored GROUP BY 1
)
SELECT '' AS query_id, batch_id, total, flagged, geo_hits, {_totals('total')}, {_totals('flagged')},
       {_totals('geo_hits')}
FROM ledger""",
    "running_totals_in_blocks": f"""{SCORED},
ledger AS (
  SELECT CASE WHEN CAST(split_part(user_id, '_', 2) AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END AS query_id,
         epoch_us(event_time) // 60000000 AS batch_id, count(*) AS total,
         count(*) FILTER (is_flagged) AS flagged, count(*) FILTER (score_geo > 0) AS geo_hits
  FROM scored GROUP BY 1, 2
)
SELECT query_id, batch_id, total, flagged, geo_hits,
       CAST(sum(total) OVER q AS BIGINT) AS acc_total, CAST(sum(flagged) OVER q AS BIGINT) AS acc_flagged,
       CAST(sum(geo_hits) OVER q AS BIGINT) AS acc_geo_hits
FROM ledger WINDOW q AS (PARTITION BY query_id ORDER BY batch_id)""",
    "recent_window_filter": f"""{TXN}
SELECT transaction_id, user_id, {_time('event_time')} FROM txn
WHERE event_time >= TIMESTAMP '2024-01-30 23:57:13' - INTERVAL 24 HOUR""",
    "dashboard_stats": f"""{SCORED}
SELECT count(*) AS total_transactions,
       CAST(sum(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count,
       round(avg(fraud_score), 6) AS avg_fraud_score,
       strftime(max(ingest_time), {TIME}) AS last_ingest
FROM scored WHERE event_time >= TIMESTAMP '2024-01-30 23:57:13' - INTERVAL 1 HOUR""",
    "flag_rate": f"""{SCORED_DAY},
day AS (
  SELECT count(*) AS total_transactions,
         CAST(sum(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count
  FROM scored WHERE event_time >= TIMESTAMP '2024-01-21 00:30:00' - INTERVAL 1 HOUR
)
SELECT *, round(flagged_count / CAST(nullif(total_transactions, 0) AS DOUBLE) * 100, 1) AS flag_rate
FROM day""",
    "stat_cards": f"""{SCORED},
hour AS (
  SELECT count(*) AS n, count(*) FILTER (is_flagged) AS f, avg(fraud_score) AS a
  FROM scored WHERE event_time >= TIMESTAMP '2024-01-30 23:57:13' - INTERVAL 1 HOUR
)
SELECT CAST(n AS VARCHAR) AS total_transactions,
       CASE WHEN n = 0 THEN '—' ELSE CAST(f AS VARCHAR) END AS flagged_count,
       CASE WHEN n = 0 THEN '—' ELSE printf('%.1f', a) END AS avg_fraud_score,
       CASE WHEN n = 0 THEN '—' ELSE printf('%.1f', round(100.0 * f / n, 1)) || '%' END AS flag_rate
FROM hour""",
    "top_risky_users": f"""{SCORED}
SELECT user_id, count(*) AS flagged_count, max(fraud_score) AS max_score
FROM alerts WHERE flagged_at >= TIMESTAMP '2024-01-21 00:00:00' - INTERVAL 24 HOUR
GROUP BY user_id ORDER BY flagged_count DESC, user_id LIMIT 10""",
    "folded_transactions": f"""{SCORED}
SELECT transaction_id,
       CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN 'later'
            WHEN CAST(transaction_id AS BIGINT) % 11 = 0 THEN 'again' ELSE status END AS status,
       strftime(CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN ingest_time + INTERVAL 1 DAY
                     ELSE ingest_time END, {TIME}) AS ingest_time,
       CAST(velocity_5min AS INTEGER) AS velocity_5min, fraud_score, is_flagged
FROM scored""",
    "folded_newest_alerts": f"""{SCORED}
SELECT transaction_id, user_id, fraud_score, reasons, strftime(flagged_at, {TIME}) AS flagged_at
FROM (SELECT transaction_id, user_id, fraud_score,
             CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 'AGAIN' ELSE reasons END AS reasons,
             CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN flagged_at + INTERVAL 1 DAY
                  ELSE flagged_at END AS flagged_at
      FROM alerts ORDER BY 5 DESC, transaction_id LIMIT 20)""",
    "recent_fraud_scores": f"""{SCORED}
SELECT transaction_id, user_id, fraud_score, reasons, strftime(flagged_at, {TIME}) AS flagged_at
FROM (SELECT * FROM alerts ORDER BY flagged_at DESC, transaction_id LIMIT 20)""",
    "scores_timeline": f"""{SCORED}
SELECT strftime(flagged_at, '%H:%M:%S') AS "time", fraud_score AS score, user_id AS "user",
       CAST(60 AS INTEGER) AS threshold
FROM (SELECT * FROM alerts ORDER BY flagged_at DESC, transaction_id LIMIT 20)""",
    "presentation_columns": f"""{SCORED}
SELECT transaction_id, left(transaction_id, 8) AS short_id,
       strftime(flagged_at, '%Y-%m-%d %H:%M:%S') AS display_time,
       strftime(flagged_at, '%H:%M:%S') AS chart_time
FROM alerts""",
    "score_band": f"""{SCORED_DAY}
SELECT transaction_id, fraud_score,
       CASE WHEN fraud_score >= 80 THEN 'critical' WHEN fraud_score >= 60 THEN 'high'
            ELSE 'medium' END AS band
FROM scored""",
    "risk_profile_features": f"""{_with(_TXN, _PROFILES)}
SELECT user_id, {_six('avg_amount_30d')}, {_six('stddev_amount')}, {_six('avg_velocity_1h')},
       {_six('last_merchant_lat')}, {_six('last_merchant_lon')},
       '2024-01-31 00:00:00.000000' AS updated_at
FROM profiles""",
    "freshness_lag": f"""{TXN}
SELECT (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_time))) // 1000000
         AS lag_seconds
FROM txn""",
    "recent_ingest_count": f"""{TXN}
SELECT count(*) AS recent_rows FROM txn
WHERE ingest_time >= TIMESTAMP '2024-01-30 23:57:13' - INTERVAL 1 HOUR""",
    "profile_min_count": f"{_with(_TXN, _PROFILES)} SELECT count(*) AS profiles FROM profiles",
    "profile_stale_count": f"""{_with(_TXN, _RISK)}
SELECT count(*) AS stale FROM risk WHERE CAST(updated_at AS DATE) < DATE '2024-01-19'""",
    "load_count": f"""{_with(_TXN, _CUST)}
SELECT count(*) FILTER (right(user_id, 1) NOT IN ('3', '7')) AS rows,
       count(*) FILTER (right(user_id, 1) IN ('3', '7')) AS rejected
FROM cust""",
    "customer_loads": f"""{_with(_TXN, _CUST)}
SELECT user_id, plan, {_six('avg_amount_30d')} FROM cust WHERE right(user_id, 1) NOT IN ('3', '7')""",
    "profile_loads": f"""{_with(_TXN, _PROFILES)}
SELECT user_id, CAST(round(avg_amount_30d, 2) AS DOUBLE) AS avg_amount_30d,
       CAST(round(stddev_amount, 2) AS DOUBLE) AS stddev_amount, {_six('avg_velocity_1h')},
       {_six('last_merchant_lat')}, {_six('last_merchant_lon')},
       '2024-01-31 00:00:00.000000' AS updated_at
FROM profiles""",
    "quality_gate": f"""{_with(_TXN, _PROFILES)},
seen AS (SELECT user_id, max(event_time) AS seen_at FROM txn GROUP BY user_id),
merged AS (
  SELECT greatest(coalesce(seen_at, TIMESTAMP '2024-01-29 12:00:00'),
                  CASE WHEN p.user_id IS NOT NULL THEN TIMESTAMP '2024-01-29 12:00:00'
                       ELSE seen_at END) AS updated_at
  FROM profiles p FULL JOIN seen s ON s.user_id = p.user_id
),
verdicts AS (
  SELECT 'freshness_lag' AS "check",
         (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_time))) // 1000000 AS value,
         600 AS threshold FROM txn
  UNION ALL
  SELECT 'recent_ingest_count', count(*), 1 FROM txn
  WHERE ingest_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 HOUR
  UNION ALL SELECT 'profile_min_count', count(*), 45 FROM merged
  UNION ALL SELECT 'profile_stale_count', count(*), 0 FROM merged
            WHERE updated_at < TIMESTAMP '2024-01-30 00:00:00'
)
SELECT "check", CAST(value AS BIGINT) AS value, CAST(threshold AS BIGINT) AS threshold,
       CASE WHEN "check" IN ('freshness_lag', 'profile_stale_count') THEN value <= threshold
            ELSE value >= threshold END AS passed
FROM verdicts""",
    "velocity_5min": _streamed_velocity(300),
    "velocity_5min_24h": _streamed_velocity(86400),
    "late_data_policy": f"""{TXN},
batches AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-11 00:00:00' THEN 0
                 WHEN event_time < TIMESTAMP '2024-01-11 12:00:00' THEN 1 ELSE 2 END
            + CASE WHEN CAST(transaction_id AS BIGINT) % 31 = 5 THEN 2
                   WHEN CAST(transaction_id AS BIGINT) % 7 = 3 THEN 1 ELSE 0 END AS arrived
  FROM txn WHERE amount > 0
),
spans AS (
  SELECT user_id, arrived,
         max(max(event_time)) OVER (PARTITION BY user_id ORDER BY arrived) - INTERVAL 1 DAY AS counted_from
  FROM batches GROUP BY user_id, arrived
),
velocity AS (
  SELECT s.user_id, s.arrived, s.counted_from, count(*) AS velocity_5min
  FROM spans s JOIN batches b
    ON b.user_id = s.user_id AND b.arrived <= s.arrived AND b.event_time >= s.counted_from
  GROUP BY ALL
)
SELECT transaction_id, user_id, arrived, velocity_5min, event_time < counted_from AS is_late
FROM batches JOIN velocity USING (user_id, arrived)""",
    "hot_fanout": f"""{STREAMED_DAY}
SELECT transaction_id, user_id, fraud_score, is_flagged, reasons, k_topic, k_partition, k_offset
FROM scored""",
    "hot_ledger": f"""{STREAMED}
SELECT count(*) AS acc_total, count(*) FILTER (is_flagged) AS acc_flagged,
       count(*) FILTER (score_geo > 0) AS acc_geo_hits
FROM scored""",
    "dlq_stream": f"""{TXN}
SELECT * FROM (
  SELECT {_KIND} AS reason, k_partition AS "partition", k_offset AS "offset", {_RAW} FROM txn)
WHERE reason <> 'ok'""",
    "lake_stream": f"""{STREAMED}
SELECT strftime(event_time, '%Y-%m-%d') AS event_date, transaction_id, {_six('amount')},
       {_time('event_time')}, {_time('ingest_time')}, fraud_score, k_topic, k_partition, k_offset
FROM scored""",
    "stored_dashboard": f"""{STREAMED}
SELECT count(*) AS total_transactions,
       CAST(sum(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count,
       round(avg(fraud_score), 6) AS avg_fraud_score,
       strftime(max(ingest_time), {TIME}) AS last_ingest
FROM scored WHERE event_time >= TIMESTAMP '2024-01-30 23:57:13' - INTERVAL 1 HOUR""",
    "stored_fraud_scores": f"""{STREAMED}
SELECT transaction_id, user_id, fraud_score, reasons, strftime(flagged_at, {TIME}) AS flagged_at
FROM (SELECT * FROM alerts ORDER BY flagged_at DESC, transaction_id LIMIT 20)""",
    "stored_risky_users": f"""{STREAMED}
SELECT user_id, count(*) AS flagged_count, max(fraud_score) AS max_score
FROM alerts WHERE flagged_at >= TIMESTAMP '2024-01-21 00:00:00' - INTERVAL 24 HOUR
GROUP BY user_id ORDER BY flagged_count DESC, user_id LIMIT 10""",
}
