"""Each result stated a second time, as SQL over the same tables for another engine."""

from __future__ import annotations

import re

TX = """
WITH base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), labelled AS (
  SELECT *, CASE WHEN k + (event_id * 7919) % 31 < 30 THEN 1 ELSE 0 END AS is_fraud FROM base
), tx AS (
  SELECT e.event_id AS transaction_id,
         CAST(e.user_id // 15 AS BIGINT) AS client_id,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS "timestamp",
         CAST(e.ts AS DATE) AS transaction_date,
         CAST(extract(hour FROM e.ts) AS INTEGER) AS hour,
         e.value AS amount,
         e.event_type AS merchant_category,
         e.k AS merchant_id,
         e.is_fraud,
         (CAST(e.k AS DOUBLE) - 50.0::DOUBLE) / 10.0::DOUBLE AS V14,
         CAST((e.event_id * 104729) % 1000 AS DOUBLE) / 500.0::DOUBLE - 1.0::DOUBLE
           - CAST(e.is_fraud AS DOUBLE) AS V17,
         n.n_name AS country,
         10.0::DOUBLE * CAST(v.embedding[4] AS DOUBLE) AS V4,
         10.0::DOUBLE * CAST(v.embedding[11] AS DOUBLE) AS V11,
         10.0::DOUBLE * CAST(v.embedding[12] AS DOUBLE) AS V12,
         e.user_id
  FROM labelled e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN embeddings v ON v.vec_id = e.event_id % (SELECT count(*) FROM embeddings)
)"""


def _r(expression: str, digits: int = 6) -> str:
    """Half-up on the decimal value, after rounding off what the order of a sum leaves."""
    return f"CAST(round(CAST({expression} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def _frame(seconds: int) -> str:
    return (
        '(PARTITION BY client_id ORDER BY "timestamp" '
        f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    )


GOLD = (
    TX
    + f"""
, framed AS (
  SELECT *,
         count(transaction_id) OVER {_frame(3600)} AS velocity_1h_calc,
         count(transaction_id) OVER {_frame(600)} AS velocity_10min_calc,
         avg(amount) OVER {_frame(604800)} AS avg_amount_7d_calc,
         stddev_samp(amount) OVER {_frame(604800)} AS std7,
         avg(CASE WHEN hour < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
           OVER {_frame(2592000)} AS night_tx_ratio
  FROM tx
), gold AS (
  SELECT *,
         coalesce((amount - avg_amount_7d_calc) / (std7 + 1e-6::DOUBLE), 0.0::DOUBLE)
           AS zscore_amount_calc,
         CASE WHEN velocity_1h_calc > 5 AND V14 < -3.0 THEN 0.9::DOUBLE
              WHEN night_tx_ratio > 0.4 THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END AS risk_score
  FROM framed
)"""
)

REQUESTS = (
    TX
    + """
, requests AS (
  SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
         CASE WHEN transaction_id % 11 = 0 THEN -amount
              WHEN transaction_id % 13 = 0 THEN 0.0::DOUBLE
              WHEN transaction_id % 17 = 0 THEN 60000.0::DOUBLE ELSE amount END AS amount,
         CAST(merchant_id % 53 AS DOUBLE) AS velocity_1h,
         CAST(merchant_id % 22 AS DOUBLE) / 20.0::DOUBLE AS night_tx_ratio,
         CASE WHEN transaction_id % 97 <> 0 THEN V14 END AS V14,
         V17,
         CASE WHEN transaction_id % 3 <> 0 THEN V14 / 2.0::DOUBLE END AS zscore_amount,
         CASE WHEN transaction_id % 5 = 1 THEN 0.0::DOUBLE
              WHEN transaction_id % 5 > 1 THEN V17 / 2.0::DOUBLE END AS zscore_amount_calc,
         CASE WHEN transaction_id % 5 = 1 THEN 0.0::DOUBLE
              WHEN transaction_id % 5 > 1 THEN CAST(merchant_id % 52 AS DOUBLE)
         END AS velocity_1h_calc,
         CASE WHEN transaction_id % 7 = 1 THEN 0.0::DOUBLE
              WHEN transaction_id % 7 > 1 THEN CAST(transaction_id % 7 AS DOUBLE) / 5.0::DOUBLE
         END AS risk_score,
         CASE WHEN transaction_id % 2 = 0 THEN V14 / 10.0::DOUBLE END AS V4,
         CASE WHEN transaction_id % 4 = 0 THEN V17 / 10.0::DOUBLE END AS V11,
         CASE WHEN transaction_id % 8 = 0 THEN 0.25::DOUBLE END AS V12,
         CASE WHEN transaction_id % 9 <> 0 THEN merchant_category END AS merchant_category
  FROM tx
), checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN transaction_id IS NULL THEN 'transaction_id_missing' END,
    CASE WHEN amount IS NULL THEN 'amount_missing' END,
    CASE WHEN velocity_1h IS NULL THEN 'velocity_1h_missing' END,
    CASE WHEN night_tx_ratio IS NULL THEN 'night_tx_ratio_missing' END,
    CASE WHEN V14 IS NULL THEN 'V14_missing' END,
    CASE WHEN V17 IS NULL THEN 'V17_missing' END,
    CASE WHEN amount <= 0 OR amount >= 50000 THEN 'amount_range' END,
    CASE WHEN velocity_1h < 0 OR velocity_1h > 50 THEN 'velocity_1h_range' END,
    CASE WHEN night_tx_ratio < 0 OR night_tx_ratio > 1 THEN 'night_tx_ratio_range' END,
    CASE WHEN velocity_1h_calc < 0 OR velocity_1h_calc > 50 THEN 'velocity_1h_calc_range' END,
    CASE WHEN risk_score < 0 OR risk_score > 1 THEN 'risk_score_range' END) AS violations
  FROM requests
), filled AS (
  SELECT * REPLACE (coalesce(zscore_amount, 0.0::DOUBLE) AS zscore_amount,
                    coalesce(zscore_amount_calc, 0.0::DOUBLE) AS zscore_amount_calc,
                    coalesce(velocity_1h_calc, 0.0::DOUBLE) AS velocity_1h_calc,
                    coalesce(risk_score, 0.1::DOUBLE) AS risk_score,
                    coalesce(V4, 0.0::DOUBLE) AS V4,
                    coalesce(V11, 0.0::DOUBLE) AS V11,
                    coalesce(V12, 0.0::DOUBLE) AS V12,
                    coalesce(merchant_category, 'unknown') AS merchant_category)
  FROM checked
), resolved AS (
  SELECT * REPLACE (coalesce(nullif(velocity_1h_calc, 0.0), velocity_1h) AS velocity_1h_calc,
                    coalesce(nullif(zscore_amount_calc, 0.0), nullif(zscore_amount, 0.0),
                             0.0::DOUBLE) AS zscore_amount_calc,
                    coalesce(nullif(risk_score, 0.0), 0.1::DOUBLE) AS risk_score)
  FROM filled
)"""
)

LOG = (
    TX
    + """
, raw_log AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(V17 * 3.0::DOUBLE)) AS p FROM tx
), log AS (
  SELECT transaction_id, "timestamp", round(p, 4) AS fraud_probability, p >= 0.5 AS is_fraud,
         CAST(5 + transaction_id % 90 AS DOUBLE) AS latency_ms,
         merchant_category = 'error' AS failed
  FROM raw_log
), stats AS (
  SELECT count(*) AS total_predictions,
         count(*) FILTER (is_fraud) AS fraud_count,
         count(*) FILTER (NOT is_fraud) AS legit_count,
         round(avg(latency_ms), 1) AS avg_latency_ms,
         round(100.0::DOUBLE * count(*) FILTER (is_fraud) / count(*), 2) AS fraud_rate_pct
  FROM log
)"""
)

ROC = (
    TX
    + """
, hist AS (
  SELECT -V17 AS threshold,
         count(*) FILTER (is_fraud = 1) AS pos, count(*) FILTER (is_fraud = 0) AS neg
  FROM tx GROUP BY 1
), ranked AS (
  SELECT *,
         sum(pos) OVER (ORDER BY threshold DESC) AS cp,
         sum(neg) OVER (ORDER BY threshold DESC) AS cn,
         sum(pos) OVER () AS np, sum(neg) OVER () AS nn,
         lead(pos) OVER (ORDER BY threshold DESC) AS next_pos,
         lead(neg) OVER (ORDER BY threshold DESC) AS next_neg,
         row_number() OVER (ORDER BY threshold DESC) AS place
  FROM hist
), curve AS (
  SELECT *, cp::DOUBLE / np AS tpr, cn::DOUBLE / nn AS fpr FROM ranked
), tuned AS (
  SELECT CASE WHEN max(threshold) >= 1.0 THEN 0.5::DOUBLE ELSE max(threshold) END AS threshold,
         min(tpr) AS tpr, min(fpr) AS fpr
  FROM curve WHERE tpr >= 0.9
), area AS (
  SELECT sum(neg * (cp - pos / 2.0::DOUBLE)) / (any_value(np)::DOUBLE * any_value(nn)) AS auc_roc
  FROM ranked
), cuts AS (
  SELECT 'default' AS cut, 0.5::DOUBLE AS threshold
  UNION ALL SELECT 'calibrated', threshold FROM tuned
), cells AS (
  SELECT cut, c.threshold,
         count(*) FILTER (-V17 >= c.threshold AND is_fraud = 1)::DOUBLE AS tp,
         count(*) FILTER (-V17 >= c.threshold AND is_fraud = 0)::DOUBLE AS fp,
         count(*) FILTER (-V17 < c.threshold AND is_fraud = 1)::DOUBLE AS fn
  FROM tx, cuts c GROUP BY 1, 2
), rates AS (
  SELECT *, tp / (tp + fp) AS "precision", tp / (tp + fn) AS recall,
         2 * tp / (2 * tp + fp + fn) AS f1
  FROM cells
), matrix AS (
  SELECT count(*) FILTER (-V17 < 0.2 AND is_fraud = 0) AS tn,
         count(*) FILTER (-V17 >= 0.2 AND is_fraud = 0) AS fp,
         count(*) FILTER (-V17 < 0.2 AND is_fraud = 1) AS fn,
         count(*) FILTER (-V17 >= 0.2 AND is_fraud = 1) AS tp
  FROM tx
), report AS (
  SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,
         2 * tn / (2 * tn + fp + fn) AS f0, 2 * tp / (2 * tp + fp + fn) AS f1,
         tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n, (tn + tp) / (tn + fp + fn + tp) AS acc
  FROM (SELECT tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp FROM matrix)
)"""
)

MERCHANTS = """
, merchants AS (
  SELECT * FROM (VALUES ('purchase', 'alimentation', 0.02::DOUBLE),
                        ('click', 'high-tech', 0.08::DOUBLE))
  AS m(merchant_category, sector, base_fraud_rate)
)
SELECT t.merchant_category, t.transaction_id, t.amount, m.sector, m.base_fraud_rate
FROM tx t LEFT JOIN merchants m USING (merchant_category)"""

# The numeric feature columns of the gold table that are ranked.
FEATURES = (
    "amount V14 V17 V4 V11 V12 night_tx_ratio velocity_1h_calc velocity_10min_calc "
    "avg_amount_7d_calc zscore_amount_calc risk_score"
).split()

_HASH = "('0x' || substr(md5('{seed}:' || transaction_id), 1, 15))::BIGINT"
# The rank of a row in its class, and the number of training rows of the class.
_RANKED = f"""
, ranked AS (
  SELECT transaction_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY {_HASH.format(seed=43)}, transaction_id) AS place,
         round(count(*) OVER (PARTITION BY is_fraud) * 0.8::DOUBLE) AS n_train
  FROM tx
)"""

_VARIANCES = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}::DOUBLE) AS variance FROM gold" for c in FEATURES
)
_CLASSES = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, is_fraud, count({c}) AS n, avg({c}::DOUBLE) AS m, "
    f"var_samp({c}::DOUBLE) AS s2 FROM gold GROUP BY is_fraud"
    for c in FEATURES
)

_GOLD_ROWS = (
    GOLD
    + f"""
SELECT transaction_id, client_id, transaction_date, is_fraud, velocity_1h_calc,
       velocity_10min_calc, {_r('avg_amount_7d_calc')} AS avg_amount_7d_calc,
       {_r('zscore_amount_calc')} AS zscore_amount_calc,
       {_r('night_tx_ratio')} AS night_tx_ratio, risk_score
FROM gold"""
)

_DISTINCT = (
    TX
    + f"""
SELECT transaction_id,
       CAST(len(list_distinct(list(merchant_id) OVER {_frame(604800)})) AS BIGINT)
         AS distinct_merchants_7d,
       CAST(len(list_distinct(list(country) OVER {_frame(2592000)})) AS BIGINT)
         AS distinct_countries_30d
FROM tx"""
)

_RUNNING_SCORE = (
    "coalesce((amount - avg(amount) OVER w) / (stddev_samp(amount) OVER w + 1e-6::DOUBLE), "
    "0.0::DOUBLE)"
)
_RUNNING = (
    TX
    + f"""
SELECT transaction_id, {_r(_RUNNING_SCORE)} AS zscore_running
FROM tx
WINDOW w AS (PARTITION BY client_id ORDER BY "timestamp", transaction_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)

_PIVOT = """
SELECT country, legit, fraude,
       round(fraude::DOUBLE / (legit + fraude) * 100, 1) AS taux_fraude
FROM (SELECT country, nullif(count(*) FILTER (is_fraud = 0), 0) AS legit,
             nullif(count(*) FILTER (is_fraud = 1), 0) AS fraude
      FROM tx GROUP BY country)"""

#: Repeats within an hour, found row by row along each key.
_REUSE = (
    """
WITH RECURSIVE seen AS (
  SELECT {key}, CAST(floor(epoch(ts)) AS BIGINT) AS t, min(event_id) AS id
  FROM events GROUP BY ALL
), kept AS (
  SELECT {key}, min(t) AS t FROM seen GROUP BY ALL
  UNION ALL
  SELECT {key}, min(s.t) AS t
  FROM kept r JOIN seen s USING ({key})
  WHERE s.t >= r.t + 3600 GROUP BY {key}, r.t
)"""
)

def _one_hot(sql: str) -> str:
    """The same text over transactions of which a third are one client's."""
    usual = "CAST(e.user_id // 15 AS BIGINT) AS client_id"
    assert usual in sql
    return sql.replace(usual, "CASE WHEN e.event_id % 3 = 0 THEN 0 ELSE CAST(e.user_id // 15 AS BIGINT) END AS client_id")


BATCH: dict[str, str] = {
    "scan_transactions": TX
    + """
SELECT transaction_id, client_id, "timestamp", transaction_date, amount, merchant_category,
       is_fraud, round(V14, 6) AS V14, round(V17, 6) AS V17, country, round(V4, 6) AS V4,
       round(V11, 6) AS V11, round(V12, 6) AS V12
FROM tx""",
    "daily_slice_count": "SELECT count(*) AS n FROM events "
    "WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "gold_roundtrip": GOLD
    + """
SELECT transaction_date, count(*) AS n, CAST(sum(velocity_1h_calc) AS BIGINT) AS sum_velocity_1h,
       round(sum(risk_score), 6) AS sum_risk
FROM gold GROUP BY transaction_date""",
    "gold_day_slice": GOLD
    + """
SELECT transaction_id, client_id, velocity_1h_calc, risk_score
FROM gold WHERE transaction_date = DATE '2024-01-15'""",
    "bronze_append": TX
    + """
SELECT transaction_date, 2 * count(*) AS n, count(DISTINCT transaction_id) AS n_ids
FROM tx GROUP BY transaction_date""",
    "table_shape": "SELECT count(*) AS n_rows, (SELECT CAST(count(*) AS INTEGER) FROM "
    "(DESCRIBE events)) AS n_columns FROM events",
    "table_preview": TX
    + """
SELECT transaction_id, client_id, amount, is_fraud FROM tx ORDER BY transaction_id LIMIT 3""",
    "project_core": TX
    + """
SELECT transaction_id, is_fraud, round(V14, 6) AS V14, round(V17, 6) AS V17, amount FROM tx""",
    "positive_amount_count": TX + "\nSELECT count(*) AS n FROM tx WHERE amount > 0",
    "iqr_outliers": TX
    + """
, q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM tx),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
       round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound,
       count(*) FILTER (amount < lo OR amount > hi) AS n_outliers, count(*) AS n_rows,
       round(100.0::DOUBLE * count(*) FILTER (amount < lo OR amount > hi) / count(*), 6)
         AS outlier_pct
FROM tx, b""",
    "amount_quartiles": TX
    + """
SELECT round(quantile_cont(amount, 0.25), 6) AS q1, round(quantile_cont(amount, 0.75), 6) AS q3
FROM tx""",
    "amount_quartiles_approx": "SELECT true AS q1_within_one_percent, true AS q3_within_one_percent",
    "validate_transactions": REQUESTS
    + "\nSELECT transaction_id, violations, violations = '' AS valid FROM checked",
    "rejects_by_rule": REQUESTS
    + """
SELECT rule, count(*) AS n_rejected
FROM (SELECT unnest(string_split(violations, ',')) AS rule FROM checked WHERE violations <> '')
GROUP BY rule""",
    "apply_defaults": REQUESTS
    + """
SELECT transaction_id, round(zscore_amount, 6) AS zscore_amount,
       round(zscore_amount_calc, 6) AS zscore_amount_calc,
       round(velocity_1h_calc, 6) AS velocity_1h_calc, round(risk_score, 6) AS risk_score,
       round(V4, 6) AS V4, round(V11, 6) AS V11, round(V12, 6) AS V12, merchant_category
FROM filled""",
    "resolve_features": REQUESTS
    + """
SELECT transaction_id, round(velocity_1h_calc, 6) AS velocity_1h_calc,
       round(zscore_amount_calc, 6) AS zscore_amount_calc, round(risk_score, 6) AS risk_score,
       round(V4, 6) AS V4, round(V11, 6) AS V11, round(V12, 6) AS V12
FROM resolved""",
    "decode_requests": REQUESTS
    + """
SELECT transaction_id, amount, velocity_1h, round(V14, 6) AS V14, merchant_category
FROM requests""",
    "ingest_requests": REQUESTS
    + """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN transaction_id::BIGINT % 19 = 0 THEN 'malformed' WHEN transaction_id::BIGINT % 23 = 0 AND amount IS NOT NULL THEN 'wrong_type'
              WHEN violations = '' THEN 'accepted' ELSE rule END AS reason
  FROM checked, unnest(string_split(violations, ',')) AS u(rule)
  QUALIFY row_number() OVER (PARTITION BY transaction_id, reason) = 1
) GROUP BY reason""",
    "gold_incremental": _GOLD_ROWS,
    "distinct_daily_sketch": TX
    + """
, days AS (SELECT DISTINCT client_id, "timestamp" // 86400 AS day FROM tx WHERE merchant_id IS NOT NULL)
SELECT d.client_id, d.day, count(DISTINCT t.merchant_id) AS distinct_merchants_7d
FROM days d JOIN tx t ON t.client_id = d.client_id AND t."timestamp" // 86400 BETWEEN d.day - 6 AND d.day
GROUP BY ALL""",
    "latency_rollup": LOG
    + """
SELECT CAST("timestamp" // 86400 AS VARCHAR) AS day, count(*) AS n, true AS p50_ok, true AS p95_ok FROM log GROUP BY 1
UNION ALL SELECT 'all', count(*), true, true FROM log""",
    "hash_sample": TX
    + f"""
SELECT transaction_id, is_fraud FROM tx WHERE {_HASH.format(seed=42)} / pow(16, 15) < 0.2""",
    "stratified_split_counts": TX
    + f"""
SELECT is_fraud, CASE WHEN {_HASH.format(seed=43)} / pow(16, 15) < 0.8 THEN 'train' ELSE 'test' END
         AS split, count(*) AS n
FROM tx GROUP BY 1, 2""",
    "stratified_split_exact": TX
    + _RANKED
    + """
SELECT transaction_id, is_fraud, CASE WHEN place <= n_train THEN 'train' ELSE 'test' END AS split FROM ranked""",
    "silver_clean": TX
    + """
SELECT transaction_id, "timestamp", amount, upper(trim(country)) AS country, is_fraud
FROM tx WHERE transaction_id % 97 <> 0 AND country IS NOT NULL AND amount IS NOT NULL""",
    "merchant_enrich": TX + MERCHANTS,
    "merchant_enrich_broadcast": TX + MERCHANTS,
    "feature_asof": TX
    + f"""
, snaps AS (
  SELECT client_id, (("timestamp" // 86400) + 1) * 86400 AS valid_from,
         avg(amount) AS avg_amount_day, count(*) AS tx_count_day
  FROM tx GROUP BY 1, 2
)
SELECT t.transaction_id, t.client_id, t."timestamp",
       {_r('s.avg_amount_day')} AS avg_amount_day, s.tx_count_day
FROM tx t ASOF LEFT JOIN snaps s
  ON t.client_id = s.client_id AND t."timestamp" >= s.valid_from""",
    "feedback_relabel": TX
    + """
SELECT transaction_id,
       CASE WHEN merchant_category = 'error' AND hour >= 12 THEN 1 - is_fraud ELSE is_fraud END
         AS is_fraud,
       merchant_category = 'error' AS relabelled
FROM tx""",
    "class_distribution": TX
    + """
SELECT is_fraud, count(*) AS count,
       round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 2) AS pct
FROM tx GROUP BY is_fraud""",
    "vfeature_profile": TX
    + """
SELECT is_fraud, round(avg(V14), 3) AS "V14_moy", round(avg(V17), 3) AS "V17_moy",
       round(stddev_samp(V14), 3) AS "V14_std"
FROM tx GROUP BY is_fraud""",
    "behaviour_profile": GOLD
    + """
SELECT is_fraud, round(avg(velocity_1h_calc), 2) AS vel_1h_moy,
       round(avg(velocity_10min_calc), 2) AS vel_10min_moy,
       round(avg(night_tx_ratio), 3) AS night_ratio, round(avg(amount), 2) AS montant_moy,
       round(stddev_samp(amount), 2) AS montant_std
FROM gold GROUP BY is_fraud""",
    "feature_means": GOLD
    + "\nSELECT is_fraud, "
    + ", ".join(f"round(avg({c}), 3) AS {c}" for c in FEATURES)
    + " FROM gold GROUP BY is_fraud",
    "country_fraud_pivot": TX + _PIVOT,
    "top_countries": TX + _PIVOT + "\nORDER BY taux_fraude DESC NULLS LAST, country LIMIT 12",
    "null_counts": REQUESTS
    + "\nSELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("amount", "V14", "V17", "zscore_amount", "velocity_1h_calc", "merchant_category")
    )
    + " FROM requests",
    "gold_validation": GOLD
    + """
SELECT is_fraud, round(avg(velocity_1h_calc), 2) AS vel_1h, round(avg(V14), 3) AS "V14_mean",
       round(avg(risk_score), 3) AS risk
FROM gold GROUP BY is_fraud""",
    "class_weights": TX
    + """
SELECT count(*) AS n, round(avg(is_fraud), 6) AS fraud_rate,
       round(sum(1 - is_fraud)::DOUBLE / sum(is_fraud), 6) AS scale_pos_weight,
       round(count(*)::DOUBLE / (2 * sum(is_fraud)), 6) AS weight_pos,
       round(count(*)::DOUBLE / (2 * sum(1 - is_fraud)), 6) AS weight_neg
FROM tx""",
    "class_weight_column": TX
    + """
, w AS (SELECT count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS p FROM tx)
SELECT transaction_id, is_fraud,
       round(CASE WHEN is_fraud = 1 THEN n / (2 * p) ELSE n / (2 * (n - p)) END, 6) AS class_weight,
       round(CASE WHEN is_fraud = 1 THEN (n - p) / p ELSE 1 END, 6) AS positive_weight
FROM tx, w""",
    "velocity_1h": TX
    + f"""
SELECT transaction_id, client_id, "timestamp",
       count(transaction_id) OVER {_frame(3600)} AS velocity_1h_calc
FROM tx""",
    "velocity_10min": TX
    + f"""
SELECT transaction_id, client_id, "timestamp",
       count(transaction_id) OVER {_frame(600)} AS velocity_10min_calc
FROM tx""",
    "avg_amount_7d": GOLD
    + f"\nSELECT transaction_id, {_r('avg_amount_7d_calc')} AS avg_amount_7d_calc FROM gold",
    "zscore_amount": GOLD
    + f"\nSELECT transaction_id, {_r('zscore_amount_calc')} AS zscore_amount_calc FROM gold",
    "risk_score": GOLD + "\nSELECT transaction_id, risk_score FROM gold",
    "gold_features": _GOLD_ROWS,
    "gold_features_hot": _one_hot(_GOLD_ROWS),
    "night_ratio": GOLD
    + f"\nSELECT transaction_id, {_r('night_tx_ratio')} AS night_tx_ratio FROM gold",
    "distinct_trailing": _DISTINCT,
    "distinct_trailing_hot": _one_hot(_DISTINCT),
    "zscore_running": _RUNNING,
    "zscore_running_hot": _one_hot(_RUNNING),
    "trailing_volume": TX
    + f"""
SELECT transaction_id, count(transaction_id) OVER {_frame(604800)} AS tx_count_7d,
       {_r('avg(amount) OVER ' + _frame(2592000))} AS avg_amount_30d
FROM tx""",
    "ttl_dedup": _REUSE.format(key="user_id, event_type")
    + """
SELECT s.id AS transaction_id, s.user_id, s.event_type AS merchant_category, s.t AS "timestamp"
FROM seen s JOIN kept USING (user_id, event_type, t)""",
    "confusion_matrix": ROC + "\nSELECT * FROM matrix",
    "binary_metrics": ROC
    + """
SELECT cut, round(threshold, 6) AS threshold, round("precision", 6) AS "precision",
       round(recall, 6) AS recall, round(f1, 6) AS f1
FROM rates""",
    "classification_report": ROC
    + """
, lines AS (
  SELECT 'Légitimes' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM report
  UNION ALL SELECT 'Fraudes', p1, r1, f1, s1 FROM report
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM report
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM report
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                   (f0 * s0 + f1 * s1) / n, n FROM report
)
SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1,
       CAST(s AS BIGINT) AS support
FROM lines""",
    "roc_curve": ROC
    + """
SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve""",
    "roc_corners": ROC
    + """
SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr
FROM curve
WHERE place = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg""",
    "auc_roc": ROC + "\nSELECT round(auc_roc, 6) AS auc_roc FROM area",
    "calibrated_threshold": ROC
    + """
SELECT round(threshold, 6) AS threshold, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM tuned""",
    "kpi_gate": ROC
    + """
, lines AS (
  SELECT 'precision' AS kpi, "precision" AS value, 0.95::DOUBLE AS target
  FROM rates WHERE cut = 'calibrated'
  UNION ALL SELECT 'recall', recall, 0.90 FROM rates WHERE cut = 'calibrated'
  UNION ALL SELECT 'f1', f1, 0.92 FROM rates WHERE cut = 'calibrated'
  UNION ALL SELECT 'auc_roc', auc_roc, 0.98 FROM area
)
SELECT kpi, round(value, 6) AS value, target, value > target AS pass FROM lines""",
    "prediction_stats": LOG + "\nSELECT * FROM stats",
    "metric_rows": LOG
    + """
SELECT 'fraud_predictions_total' AS metric, 'counter' AS type,
       total_predictions::DOUBLE AS value FROM stats
UNION ALL SELECT 'fraud_detected_total', 'counter', fraud_count::DOUBLE FROM stats
UNION ALL SELECT 'fraud_rate_percent', 'gauge', fraud_rate_pct FROM stats
UNION ALL SELECT 'predict_latency_ms_avg', 'gauge', avg_latency_ms FROM stats""",
    "probability_histogram": LOG
    + """
SELECT CAST(least(floor(fraud_probability * 20), 19) AS INTEGER) AS bin, is_fraud, count(*) AS n,
       least(floor(fraud_probability * 20), 19) / 20.0::DOUBLE AS bin_start
FROM log GROUP BY ALL""",
    "recent_predictions": LOG
    + """
SELECT transaction_id, "timestamp", fraud_probability, is_fraud, latency_ms
FROM log ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 50""",
    "display_rows": LOG
    + """
, ids AS (SELECT *, 1000000000000 + transaction_id AS shown FROM log)
SELECT shown AS transaction_id, right(shown::VARCHAR, 8) AS id_label,
       printf('%.1f%%', CAST(round(CAST(fraud_probability * 100 AS DECIMAL(38, 15)), 1) AS DOUBLE)) AS probability_text,
       CASE WHEN is_fraud THEN 'FRAUDE' ELSE 'LÉGIT' END AS decision_text,
       CASE WHEN fraud_probability > 0.7 THEN 'HIGH'
            WHEN fraud_probability > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       CASE WHEN fraud_probability > 0.7 THEN 'high'
            WHEN fraud_probability > 0.3 THEN 'medium' ELSE 'low' END AS level_class,
       printf('%.1f ms', latency_ms) AS latency_text
FROM ids ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 50""",
    "latency_summary": LOG
    + """
SELECT count(*) AS n_requests, round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
       round(count(*)::DOUBLE / (max("timestamp") - min("timestamp")), 6) AS requests_per_s,
       round(avg(failed::INTEGER), 6) AS failure_rate
FROM log""",
    "risk_level": LOG
    + """
SELECT transaction_id,
       CASE WHEN fraud_probability > 0.7 THEN 'HIGH'
            WHEN fraud_probability > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM log""",
    "score_batch": REQUESTS
    + """
, scored AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(-1.0::DOUBLE - 0.6::DOUBLE * V14
           - 1.5::DOUBLE * V17 + 0.05::DOUBLE * velocity_1h_calc
           + 0.4::DOUBLE * zscore_amount_calc - 0.002::DOUBLE * amount + 0.3::DOUBLE * V4
           - 0.2::DOUBLE * V11 + 0.1::DOUBLE * V12))) AS p
  FROM resolved WHERE violations = ''
)
SELECT transaction_id, p >= 0.5 AS is_fraud, round(p, 4) AS fraud_probability,
       CASE WHEN p > 0.7 THEN 'HIGH' WHEN p > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       'p1-fraud-model/1' AS model_version
FROM scored""",
    "variance_filter": GOLD
    + f"""
, v AS ({_VARIANCES})
SELECT feature, round(variance, 6) AS variance, variance > 0.01 AS kept FROM v""",
    "anova_topk": GOLD
    + f"""
, v AS ({_VARIANCES}), c AS ({_CLASSES}),
g AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS gm,
             sum(n) OVER (PARTITION BY feature) AS total,
             count(*) OVER (PARTITION BY feature) AS k FROM c),
f AS (SELECT feature, (sum(n * (m - gm) * (m - gm)) / (any_value(k) - 1))
             / (sum((n - 1) * s2) / (any_value(total) - any_value(k))) AS f_score
      FROM g GROUP BY feature)
SELECT feature, round(f_score, 4) AS f_score
FROM f WHERE feature IN (SELECT feature FROM v WHERE variance > 0.01)
ORDER BY f_score DESC LIMIT 8""",
}

LEARNED: dict[str, str] = {}
_AREAS = """
, plain AS (
  SELECT 0 AS seq, 'v17' AS name, -V17 AS s, is_fraud FROM tx
  UNION ALL SELECT 1, 'v14', -V14, is_fraud FROM tx
  UNION ALL SELECT 2, 'both', -(V14 + V17), is_fraud FROM tx
), bins AS (
  SELECT seq, name, s, count(*) FILTER (is_fraud = 1) AS pos,
         count(*) FILTER (is_fraud = 0) AS neg
  FROM plain GROUP BY ALL
), cum AS (
  SELECT *, sum(pos) OVER (PARTITION BY seq ORDER BY s DESC) AS cp FROM bins
), areas AS (
  SELECT seq, name,
         sum(neg * (cp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc_roc
  FROM cum GROUP BY ALL
)"""
LEARNED["best_model"] = (
    TX
    + _AREAS
    + """
SELECT name AS run_name, round(auc_roc, 6) AS auc_roc
FROM areas ORDER BY areas.auc_roc DESC, seq LIMIT 1"""
)
LEARNED["latest_run"] = (
    TX
    + _AREAS
    + """
, begun AS (
  SELECT transaction_id % 3 AS seq, max("timestamp") AS last_seen FROM tx GROUP BY 1
)
SELECT 'run-' || name AS run_id FROM areas JOIN begun USING (seq) ORDER BY last_seen DESC, seq DESC LIMIT 1"""
)
LEARNED["promote"] = (
    TX
    + _AREAS
    + """
, better AS (
  SELECT name AS run, seq FROM areas a
  WHERE NOT EXISTS (SELECT 1 FROM areas b WHERE b.seq < a.seq AND b.auc_roc >= a.auc_roc)
)
SELECT 'p1-fraud-model' AS name, CAST(row_number() OVER (ORDER BY seq) AS INTEGER) AS version,
       CASE WHEN seq = max(seq) OVER () THEN 'Production' ELSE 'Archived' END AS stage, 'run-' || run AS run_id
FROM better"""
)
_SPLIT = TX + _RANKED + """
, split AS (
  SELECT count(*) FILTER (place <= n_train) AS n_train, count(*) FILTER (place > n_train) AS n_test FROM ranked
)"""
LEARNED["model_comparison"] = (
    _SPLIT
    + """
SELECT run_name, CAST(seq AS INTEGER) AS seq, n_train AS train_size, n_test AS test_size, CAST(8 AS BIGINT) AS n_features,
       true AS above_floor
FROM split, (VALUES ('GBT', 0), ('RF', 1), ('LR', 2)) m(run_name, seq)"""
)
LEARNED["feature_importance"] = """
SELECT run_name, 'V11,V12,V14,V17,V4,amount,velocity_1h_calc,zscore_amount_calc' AS features,
       true AS non_negative, CASE WHEN run_name <> 'LR' THEN 1.0::DOUBLE END AS total
FROM (VALUES ('GBT'), ('RF'), ('LR')) m(run_name)"""
LEARNED["training_chain"] = (
    _SPLIT
    + """
SELECT n_train, n_test, CAST(0 AS BIGINT) AS n_changed, true AS recall_reached, CAST(5 AS BIGINT) AS n_report,
       'auc_roc,f1,precision,recall' AS gates, CAST(1 AS BIGINT) AS n_versions, 'Production' AS stage
FROM split"""
)
LEARNED["boosted_trees"] = (
    TX
    + _RANKED
    + """
SELECT CAST(100 AS INTEGER) AS n_trees, count(*) AS n_test, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, true AS in_range,
       true AS above_floor
FROM ranked WHERE place > n_train"""
)
LEARNED["boosted_root_gains"] = (
    TX
    + """
, long AS (
  SELECT f.feature, CAST(f.x AS DOUBLE) AS x, is_fraud FROM (
    SELECT is_fraud, unnest([{'feature': 'amount', 'x': CAST(amount AS DOUBLE)}, {'feature': 'V14', 'x': CAST(V14 AS DOUBLE)},
                             {'feature': 'V17', 'x': CAST(V17 AS DOUBLE)}]) AS f FROM tx WHERE is_fraud IS NOT NULL)
), spans AS (
  SELECT feature, min(x) AS low, max(x) AS high FROM long GROUP BY feature
), weights AS (
  SELECT count(*) FILTER (is_fraud = 0) / CAST(count(*) FILTER (is_fraud = 1) AS DOUBLE) AS positive FROM tx
), binned AS (
  SELECT feature, len(list_filter(range(1, 64), lambda k: low + (high - low) * k / 64 < x)) AS bin,
         CASE WHEN is_fraud = 1 THEN positive ELSE 1 END AS w, 0.5::DOUBLE - is_fraud AS g
  FROM long JOIN spans USING (feature), weights
), sums AS (
  SELECT feature, bin, sum(w * g) AS g, sum(w * 0.25::DOUBLE) AS h FROM binned GROUP BY ALL
), sides AS (
  SELECT feature, bin, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh, sum(g) OVER whole AS ag, sum(h) OVER whole AS ah
  FROM sums WINDOW upto AS (PARTITION BY feature ORDER BY bin), whole AS (PARTITION BY feature)
), gains AS (
  SELECT feature, bin, (pow(greatest(abs(lg) - 0.1, 0), 2) / (lh + 1) + pow(greatest(abs(ag - lg) - 0.1, 0), 2) / (ah - lh + 1)
                        - pow(greatest(abs(ag) - 0.1, 0), 2) / (ah + 1)) / 2 AS gain
  FROM sides WHERE lh >= 1 AND ah - lh >= 1
)
SELECT feature, CAST(bin AS INTEGER) AS cut, round(gain, 6) AS gain FROM gains
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 6) DESC, bin) = 1"""
)
LEARNED["score_fitted"] = (
    REQUESTS
    + """
SELECT transaction_id, true AS in_range, true AS consistent, 'p1-fraud-model/1' AS model_version
FROM checked WHERE violations = ''"""
)
LEARNED["combined_score"] = TX + "\nSELECT transaction_id, true AS in_range, true AS is_mean FROM tx"

_WINDOW_STATS = (
    TX
    + """
, slid AS (
  SELECT client_id, transaction_id, ("timestamp" // 600 - i) * 600 AS window_start
  FROM tx, range(6) r(i)
), weeks AS (
  SELECT client_id, ("timestamp" // 604800) * 604800 AS window_start, merchant_id FROM tx
), months AS (
  SELECT client_id, ("timestamp" // 2592000) * 2592000 AS window_start, hour FROM tx
)"""
)
STREAMS: dict[str, str] = {
    "stream_velocity": _WINDOW_STATS
    + """
SELECT client_id, window_start, window_start + 3600 AS window_end,
       count(transaction_id) AS velocity
FROM slid GROUP BY ALL""",
    "stream_trailing_velocity": BATCH["velocity_1h"],
    "stream_distinct_merchants": _WINDOW_STATS
    + """
SELECT client_id, window_start, window_start + 604800 AS window_end,
       count(DISTINCT merchant_id) AS distinct_merchants
FROM weeks
GROUP BY ALL""",
    "stream_distinct_merchants_closed": _WINDOW_STATS
    + """
SELECT client_id, window_start, window_start + 604800 AS window_end,
       count(DISTINCT merchant_id) AS distinct_merchants
FROM weeks
WHERE window_start + 604800 <= (SELECT max(epoch(ts)) - 600 FROM events)
GROUP BY ALL""",
    "stream_velocity_10min": BATCH["velocity_10min"],
    "stream_night_ratio": _WINDOW_STATS
    + f"""
SELECT client_id, window_start, window_start + 2592000 AS window_end,
       {_r('avg(CASE WHEN hour < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS night_tx_ratio
FROM months GROUP BY ALL""",
    "stream_running_zscore": BATCH["zscore_running"],
    "stream_reuse": _REUSE.format(key="user_id, event_type")
    + """
SELECT s.user_id, s.event_type AS merchant_category, s.id AS transaction_id, s.t AS "timestamp"
FROM seen s JOIN kept USING (user_id, event_type, t)""",
    "stream_scoring": BATCH["score_batch"],
    "stream_stats": BATCH["prediction_stats"],
    "stream_late_rows": TX
    + """
, span AS (
  SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM tx
), parts AS (
  SELECT transaction_id, "timestamp", ("timestamp" - lo) * 4 // (hi - lo + 1) AS part FROM tx, span
), arrived AS (
  SELECT transaction_id, "timestamp", CASE WHEN transaction_id % 10 = 0 THEN least(part + 1, 3) ELSE part END AS batch FROM parts
)
SELECT a.transaction_id, CAST(a.batch AS BIGINT) AS batch FROM arrived a
WHERE a."timestamp" < (SELECT max("timestamp") FROM arrived l WHERE l.batch < a.batch) - 600""",
    "stream_feature_store": TX
    + """
SELECT client_id, max("timestamp") AS updated_at,
       arg_max(amount, "timestamp" * 1000000000 + transaction_id) AS last_amount,
       arg_max(transaction_id, "timestamp" * 1000000000 + transaction_id) AS last_id
FROM tx GROUP BY client_id""",
    "stream_feature_lookup": BATCH["feature_asof"],
    "stream_feature_upsert": TX
    + """
SELECT client_id, max("timestamp") AS updated_at,
       arg_max(amount, "timestamp" * 1000000000 + transaction_id) AS last_amount,
       count(*) AS n_seen
FROM tx GROUP BY client_id""",
}


def _stable(sql: str) -> str:
    """Give every plain rounding to 6 digits the two steps that the queries take."""
    return re.sub(r"\bround\((\"?\w+\"?), 6\)", lambda m: _r(m[1]), sql)


BATCH["gold_bucketed"] = BATCH["gold_features"]
BATCH["asof_bucketed"] = BATCH["feature_asof"]
BATCH = {name: _stable(sql) for name, sql in BATCH.items()}
LEARNED = {name: _stable(sql) for name, sql in LEARNED.items()}
STREAMS = {name: _stable(sql) for name, sql in STREAMS.items()}
for _name in ("trailing_velocity", "running_zscore", "reuse"):
    STREAMS[f"stream_{_name}_state"] = STREAMS[f"stream_{_name}"]
