"""Independent SQL for the registered queries, over the plain test tables."""

from __future__ import annotations

TX = """tx AS (
  SELECT event_id + 1 AS transaction_id, CAST(user_id AS VARCHAR) AS card_id, value AS amount,
         CAST(value AS DECIMAL(18,4)) AS money, ts AS event_time,
         CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS transaction_dt, event_type AS product_cd,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS c2,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS addr1,
         CAST((event_id + 1) % 7 AS DOUBLE) AS d4,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
  FROM events)"""

DIRTY = TX + """, dirty AS (
  SELECT * REPLACE (
    CASE WHEN transaction_id % 50 = 0 THEN -999.0 ELSE amount END AS amount,
    CASE WHEN transaction_id % 50 = 0 THEN -999.0 ELSE money END AS money,
    CASE transaction_id % 50 WHEN 1 THEN 'unknown_card' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE card_id END AS card_id)
  FROM tx)"""


def batch(rows: str, run_time: str = "2024-02-01") -> str:
    return f"""SELECT card_id, TIMESTAMP '{run_time} 00:00:00' AS event_timestamp,
      COUNT(CASE WHEN transaction_dt >= (SELECT MAX(transaction_dt) FROM {rows} WHERE card_id IS NOT NULL) - 604800 THEN 1 END) AS trans_count_7d,
      COUNT(transaction_id) AS trans_count_30d,
      CAST(SUM(money) AS DOUBLE) / COUNT(money) AS avg_amount_30d, MAX(amount) AS max_amount_30d,
      COUNT(DISTINCT addr1) AS distinct_addr_7d, COALESCE(AVG(d4), 0.0) AS days_since_last_trans
    FROM {rows} WHERE card_id IS NOT NULL GROUP BY card_id"""


def rolling(rows: str = "tx") -> str:
    """No card of the test tables has two events at one time, so plain RANGE frames suffice."""

    def window(seconds: int) -> str:
        return (
            "(PARTITION BY card_id ORDER BY event_time "
            f"RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)"
        )

    units = "CAST(ROUND(amount * 10000) AS HUGEINT)"
    return f"""SELECT transaction_id, card_id,
      COUNT(*) OVER m1 AS trans_count_1m, COUNT(*) OVER m5 AS trans_count_5m, COUNT(*) OVER h1 AS trans_count_1h,
      CAST(SUM(money) OVER h1 AS DOUBLE) AS total_amount_1h,
      CAST(SUM(money) OVER h1 AS DOUBLE) / COUNT(*) OVER h1 AS avg_amount_1h,
      CAST(SUM(money) OVER h24 AS DOUBLE) / COUNT(*) OVER h24 AS avg_amount_24h,
      CASE WHEN COUNT(*) OVER h24 > 1 THEN
        SQRT(CAST(COUNT(*) OVER h24 * SUM({units} * {units}) OVER h24
                  - SUM({units}) OVER h24 * SUM({units}) OVER h24 AS DOUBLE)) / (COUNT(*) OVER h24 * CAST(10000 AS DOUBLE))
      ELSE 0.0 END AS stddev_amount_24h,
      MAX(amount) OVER h24 AS max_amount_24h, SUM(c2) OVER h1 AS c2_count_sum_1h, event_time AS last_updated
    FROM {rows}
    WINDOW m1 AS {window(60)}, m5 AS {window(300)}, h1 AS {window(3600)}, h24 AS {window(86400)}"""


def latest(rows: str, key: str, order: str) -> str:
    return f"SELECT * FROM {rows} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


DAILY = """daily AS (
  SELECT card_id, date_trunc('day', event_time) + INTERVAL 1 DAY AS known_at, COUNT(*) AS day_count,
         CAST(SUM(money) AS DOUBLE) / COUNT(*) AS day_avg_amount, MAX(amount) AS day_max_amount
  FROM tx GROUP BY 1, 2)"""

LOOKUP = {
    "trans_count_7d": 1.0,
    "trans_count_30d": 5.0,
    "avg_amount_30d": 150.0,
    "max_amount_30d": 500.0,
    "distinct_addr_7d": 1.0,
    "days_since_last_trans": 2.0,
}

EVENT_CHECKS = {
    "transaction_id:not_null": "transaction_id IS NULL",
    "transaction_id:positive": "transaction_id <= 0",
    "card_id:not_null": "card_id IS NULL",
    "card_id:non_empty_card_id": "LENGTH(TRIM(card_id)) = 0",
    "card_id:valid_card_id": "card_id = 'unknown_card'",
    "amount:not_null": "amount IS NULL",
    "amount:positive": "amount <= 0",
    "amount:at_most_500000": "amount > 500000",
}
BAD_EVENT = " OR ".join(f"COALESCE({rule}, FALSE)" for rule in EVENT_CHECKS.values())
REASONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {rule} THEN '{name}' END" for name, rule in EVENT_CHECKS.items()
) + ")"
BAD_BATCH = """card_id IS NULL OR LENGTH(TRIM(card_id)) = 0 OR card_id = 'unknown_card'
  OR trans_count_7d < 0 OR trans_count_30d < 0 OR NOT (avg_amount_30d > 0 AND avg_amount_30d <= 500000)
  OR NOT (max_amount_30d > 0 AND max_amount_30d <= 500000) OR distinct_addr_7d < 0 OR days_since_last_trans < 0"""

DRIFT = TX + """, halves AS (
  SELECT event_time < TIMESTAMP '2024-01-16 00:00:00' AS is_ref, amount, c2, d4, CAST(is_fraud AS DOUBLE) AS is_fraud
  FROM tx),
 long_rows AS (
  SELECT 'amount' AS column_name, amount AS v, is_ref FROM halves UNION ALL SELECT 'c2', c2, is_ref FROM halves
  UNION ALL SELECT 'd4', d4, is_ref FROM halves UNION ALL SELECT 'is_fraud', is_fraud, is_ref FROM halves),
 counted AS (
  SELECT column_name, v, COUNT(*) FILTER (is_ref) AS r, COUNT(*) FILTER (NOT is_ref) AS c FROM long_rows GROUP BY 1, 2),
 shares AS (
  SELECT column_name,
    CAST(SUM(r) OVER (PARTITION BY column_name ORDER BY v) AS DOUBLE) / CAST(SUM(r) OVER (PARTITION BY column_name) AS DOUBLE)
    - CAST(SUM(c) OVER (PARTITION BY column_name ORDER BY v) AS DOUBLE) / CAST(SUM(c) OVER (PARTITION BY column_name) AS DOUBLE) AS gap
  FROM counted),
 drift AS (
  SELECT column_name, MAX(ABS(gap)) AS drift_score, MAX(ABS(gap)) > 0.10 AS drift_detected FROM shares GROUP BY 1)"""
VERDICT = """verdict AS (
  SELECT CAST(COUNT(*) FILTER (drift_detected) AS DOUBLE) / COUNT(*) >= 0.5 AS dataset_drift,
         CAST(COUNT(*) FILTER (drift_detected) AS DOUBLE) / COUNT(*) AS drift_share,
         COUNT(*) FILTER (drift_detected) AS drifted_features_count
  FROM drift)"""

SCORED = TX + """, scored AS (
  SELECT 'a' AS model, is_fraud, amount, money, CAST(((transaction_id - 1) * 7919) % 1000 AS DOUBLE) / 1000.0 AS score FROM tx
  UNION ALL
  SELECT 'b', is_fraud, amount, money, CAST(((transaction_id - 1) * 104729) % 997 AS DOUBLE) / 997.0 FROM tx)"""

# Every threshold against every distinct score, not against bucketed scores.
CURVE = SCORED + """, thresholds AS (
  SELECT i AS threshold_index, CAST(0.01 AS DOUBLE) + i * (CAST(0.89 AS DOUBLE) / CAST(89 AS DOUBLE)) AS threshold
  FROM range(90) r(i)),
 by_score AS (
  SELECT model, score, COUNT(*) FILTER (is_fraud = 1) AS pos, COUNT(*) FILTER (is_fraud = 0) AS neg,
         COALESCE(SUM(money) FILTER (is_fraud = 1), 0) AS loss
  FROM scored GROUP BY 1, 2),
 counts AS (
  SELECT model, CAST(threshold_index AS INTEGER) AS threshold_index, threshold,
    CAST(SUM(CASE WHEN score >= threshold THEN pos ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN score >= threshold THEN neg ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN score < threshold THEN pos ELSE 0 END) AS BIGINT) AS fn,
    CAST(SUM(CASE WHEN score < threshold THEN neg ELSE 0 END) AS BIGINT) AS tn,
    CAST(SUM(CASE WHEN score < threshold THEN loss ELSE 0 END) AS DOUBLE) AS fn_cost
  FROM by_score, thresholds GROUP BY 1, 2, 3),
 rates AS (
  SELECT *, fp * CAST(2.0 AS DOUBLE) AS fp_cost, fn_cost + fp * CAST(2.0 AS DOUBLE) AS total_cost,
    tp / (CAST(tp + fp AS DOUBLE) + 1e-9) AS precision, tp / (CAST(tp + fn AS DOUBLE) + 1e-9) AS recall
  FROM counts),
 curve AS (
  SELECT *, (CAST(2.0 AS DOUBLE) * precision * recall) / (precision + recall + 1e-9) AS f1,
    (CAST(5.0 AS DOUBLE) * precision * recall) / (CAST(4.0 AS DOUBLE) * precision + recall + 1e-9) AS f2
  FROM rates)"""

STEPS = SCORED + """, by_score AS (
  SELECT model, score, COUNT(*) FILTER (is_fraud = 1) AS pos, COUNT(*) FILTER (is_fraud = 0) AS neg
  FROM scored GROUP BY 1, 2),
 steps AS (
  SELECT model, score, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
    SUM(pos) OVER (PARTITION BY model) AS p, SUM(neg) OVER (PARTITION BY model) AS n
  FROM by_score WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
 areas AS (
  SELECT model,
    ROUND(SUM(CAST(pos AS DOUBLE) / CAST(p AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)
      + CASE WHEN tp + fp > pos + neg THEN CAST(tp - pos AS DOUBLE) / CAST(tp + fp - pos - neg AS DOUBLE) ELSE 1.0 END) / 2.0), 9) AS pr_auc,
    CAST(SUM(neg * (2 * tp - pos)) AS DOUBLE) / (CAST(2.0 AS DOUBLE) * CAST(MAX(p) AS DOUBLE) * CAST(MAX(n) AS DOUBLE)) AS roc_auc
  FROM steps GROUP BY 1)"""


def confusion(cut: str, name: str = "conf") -> str:
    return f"""{name} AS (
  SELECT model, {cut} AS threshold, COUNT(*) FILTER (is_fraud = 0 AND score < {cut}) AS tn,
    COUNT(*) FILTER (is_fraud = 0 AND score >= {cut}) AS fp, COUNT(*) FILTER (is_fraud = 1 AND score < {cut}) AS fn,
    COUNT(*) FILTER (is_fraud = 1 AND score >= {cut}) AS tp
  FROM scored GROUP BY ALL)"""


F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) END"


def _class(name: str, hit: str, wrong: str, missed: str) -> str:
    return f"""SELECT model, '{name}' AS class_name, {_ratio(hit, f'({hit} + {wrong})')} AS precision,
      {_ratio(hit, f'({hit} + {missed})')} AS recall,
      {_ratio(f'(2 * {hit})', f'(2 * {hit} + {wrong} + {missed})')} AS f1_score, {hit} + {missed} AS support FROM conf"""


CLASS_REPORT = f"""classes AS ({_class('Legitimate', 'tn', 'fn', 'fp')} UNION ALL {_class('Fraud', 'tp', 'fp', 'fn')}),
 pairs AS (
  SELECT a.model, a.precision AS ap, b.precision AS bp, a.recall AS ar, b.recall AS br, a.f1_score AS af, b.f1_score AS bf,
    a.support AS an, b.support AS bn
  FROM classes a JOIN classes b ON a.model = b.model AND a.class_name = 'Legitimate' AND b.class_name = 'Fraud')
SELECT * FROM classes
UNION ALL SELECT model, 'accuracy', (ar * an + br * bn) / (an + bn), (ar * an + br * bn) / (an + bn), (ar * an + br * bn) / (an + bn), an + bn FROM pairs
UNION ALL SELECT model, 'macro avg', (ap + bp) / 2.0, (ar + br) / 2.0, (af + bf) / 2.0, an + bn FROM pairs
UNION ALL SELECT model, 'weighted avg', (ap * an + bp * bn) / (an + bn), (ar * an + br * bn) / (an + bn), (af * an + bf * bn) / (an + bn), an + bn FROM pairs"""

_HASH = "substr(md5('{seed}:' || transaction_id), 1, 15)"
_GAPPY = SCORED.replace("scored AS (", "all_scores AS (") + """, scored AS (
  SELECT * REPLACE (CASE WHEN CAST(FLOOR(score * 1000) AS BIGINT) % 20 IN (3, 4) THEN -1e300::DOUBLE ELSE score END AS score)
  FROM all_scores)"""


def equal_times() -> str:
    """Events of a card at one time count in the order of their ids; as a join of pairs."""

    def over(seconds: int, value: str) -> str:
        return f"{value} FILTER (b.event_time >= a.event_time - INTERVAL {seconds} SECOND)"

    return f"""days AS (SELECT * REPLACE (date_trunc('day', event_time) AS event_time) FROM tx)
      SELECT a.transaction_id, {over(3600, 'COUNT(*)')} AS trans_count_1h,
        CAST({over(3600, 'SUM(b.money)')} AS DOUBLE) AS total_amount_1h,
        CAST({over(86400, 'SUM(b.money)')} AS DOUBLE) / {over(86400, 'COUNT(*)')} AS avg_amount_24h,
        {over(86400, 'MAX(b.amount)')} AS max_amount_24h
      FROM days a JOIN days b ON a.card_id = b.card_id AND b.event_time >= a.event_time - INTERVAL 1 DAY
        AND (b.event_time < a.event_time OR (b.event_time = a.event_time AND b.transaction_id <= a.transaction_id))
      GROUP BY a.transaction_id"""


_W = f"WITH {TX}, w AS ({rolling()})"
_STREAM_COUNTS = "transaction_id, card_id, trans_count_1m, trans_count_5m, trans_count_1h"
_REPLAYED = "make_timestamp(CAST(ROUND((1704067200.0::DOUBLE + transaction_dt % 86400.0::DOUBLE) * 1000000.0::DOUBLE) AS BIGINT))"
_TWO_VIEWS = f"""WITH {TX}, early AS (SELECT * FROM tx WHERE event_time < TIMESTAMP '2024-01-16 00:00:00'),
  b AS ({batch('early', '2024-01-16')} UNION ALL {batch('tx')}), s AS ({rolling()}),
  e AS (SELECT transaction_id, card_id,
          event_time + CASE WHEN transaction_id % 3 = 0 THEN INTERVAL 10 DAY ELSE INTERVAL 1 HOUR END AS event_timestamp FROM tx)
  SELECT e.transaction_id, e.card_id, e.event_timestamp,
    CASE WHEN s.last_updated >= e.event_timestamp - INTERVAL 7 DAY THEN s.trans_count_1h END AS card_stream_features__trans_count_1h,
    CASE WHEN s.last_updated >= e.event_timestamp - INTERVAL 7 DAY THEN s.max_amount_24h END AS card_stream_features__max_amount_24h,
    b.trans_count_30d AS card_batch_features__trans_count_30d, b.max_amount_30d AS card_batch_features__max_amount_30d
  FROM e ASOF LEFT JOIN s ON e.card_id = s.card_id AND e.event_timestamp >= s.last_updated
  ASOF LEFT JOIN b ON e.card_id = b.card_id AND e.event_timestamp >= b.event_timestamp"""


def fixed_trees(a: str, c: str) -> tuple[str, str, str]:
    """The three small trees of ``queries.FIXED_TREES`` with the values that are known."""

    def when(condition: str, yes: str, no: str) -> str:
        return f"(CASE WHEN {condition} THEN {yes} ELSE {no} END)"

    inner = when(f"{c} <= 50", "2.0::DOUBLE", "-1.0::DOUBLE") if c else "1.25::DOUBLE"
    one = when(f"{a} <= 100", "1.0::DOUBLE", inner) if a else f"(0.5::DOUBLE + 0.5::DOUBLE * {inner})"
    high = when(f"{a} <= 300", "-0.25::DOUBLE", "4.0::DOUBLE") if a else "1.875::DOUBLE"
    two = when(f"{c} <= 20", "0.5::DOUBLE", high) if c else f"(0.125::DOUBLE + 0.75::DOUBLE * {high})"
    three = when(f"{a} <= 50", "0.5::DOUBLE", when(f"{a} <= 200", "1.5::DOUBLE", "3.0::DOUBLE")) if a else "2.0::DOUBLE"
    return one, two, three


def fixed_score(a: str = "", c: str = "") -> str:
    one, two, three = fixed_trees(a, c)
    return f"(0.5::DOUBLE * {one} + {two} + 0.25::DOUBLE * {three})"


_FOREST = "({1} + 0.25::DOUBLE * {2})".format(*fixed_trees("current_amount", "trans_count_7d"))

#: Gradients p - y at p = 1/2, hessians p (1 - p), in 2**-20ths and weighted 3.5 for positives.
_FIRST_ROUND = f"""WITH {TX}, e AS (SELECT 'amount' AS feature, 0 AS place, CAST(UNNEST(range(5, 250, 5)) AS DOUBLE) AS threshold
      UNION ALL SELECT 'c2', 1, CAST(UNNEST(range(4, 100, 4)) AS DOUBLE) UNION ALL SELECT 'd4', 2, CAST(UNNEST(range(0, 6)) AS DOUBLE)),
      f AS (SELECT transaction_id, UNNEST(['amount', 'c2', 'd4']) AS feature, UNNEST([amount, c2, d4]) AS x,
        CASE WHEN is_fraud = 1 THEN -1835008 ELSE 524288 END AS g, CASE WHEN is_fraud = 1 THEN 917504 ELSE 262144 END AS h FROM tx),
      cells AS (SELECT feature, x, COUNT(*) AS n, SUM(g) AS g, SUM(h) AS h FROM f GROUP BY feature, x),
      total AS (SELECT COUNT(*) AS n, SUM(g) / 1048576.0::DOUBLE AS g, SUM(h) / 1048576.0::DOUBLE AS h FROM f WHERE feature = 'amount'),
      cuts AS (SELECT e.feature, place, threshold, CAST(SUM(cells.n) AS BIGINT) AS n_left,
        CAST(SUM(cells.g) AS DOUBLE) / 1048576.0::DOUBLE AS gl, CAST(SUM(cells.h) AS DOUBLE) / 1048576.0::DOUBLE AS hl
        FROM e JOIN cells ON e.feature = cells.feature AND x <= threshold GROUP BY ALL),
      gains AS (SELECT cuts.*, g, h, (gl * gl / (hl + 1.0::DOUBLE) + (g - gl) * (g - gl) / (h - hl + 1.0::DOUBLE)
        - g * g / (h + 1.0::DOUBLE)) / 2.0::DOUBLE AS gain
        FROM cuts, total WHERE n_left >= 20 AND n - n_left >= 20)"""

ORACLE: dict[str, str] = {
    "s1_typed_scan": f"""WITH {DIRTY} SELECT transaction_id, is_fraud, transaction_dt, amount, card_id, addr1, d4
      FROM dirty WHERE TRY_CAST(card_id AS BIGINT) IS NOT NULL""",
    "s2_first_rows": f"""WITH {TX} SELECT transaction_id, is_fraud, amount, card_id FROM tx
      ORDER BY transaction_id LIMIT 50000""",
    "s2_binding_limit": f"""WITH {TX} SELECT transaction_id, is_fraud, amount, card_id FROM tx
      ORDER BY transaction_id LIMIT 1000""",
    "p2_sanitized": f"""WITH {DIRTY} SELECT transaction_id, card_id, amount, d4 AS c1, c2, product_cd,
        product_cd AS p_emaildomain, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, event_time
      FROM dirty WHERE NOT ({BAD_EVENT})""",
    "s12_messages": f"""WITH {DIRTY} SELECT COALESCE(card_id, 'bad_event') AS message_key, transaction_id, card_id, amount,
        {REASONS} AS reasons FROM dirty WHERE {BAD_EVENT}""",
    "s3_replay": f"""WITH {TX} SELECT transaction_id AS "TransactionID", transaction_dt AS "TransactionDT",
      CAST(card_id AS BIGINT) AS card1 FROM tx ORDER BY 2, 1""",
    "s7_lakehouse": f"""WITH {TX}, b AS ({batch('tx')})
      SELECT * EXCLUDE (event_timestamp), 2024 AS year, 2 AS month, 1 AS day FROM b""",
    "s11_batch_quarantine": f"""WITH {DIRTY}, b AS ({batch('dirty')})
      SELECT card_id, trans_count_30d,
        concat_ws(',', CASE WHEN LENGTH(TRIM(card_id)) = 0 THEN 'card_id:non_empty_card_id' END,
          CASE WHEN card_id = 'unknown_card' THEN 'card_id:valid_card_id' END,
          CASE WHEN avg_amount_30d <= 0 THEN 'avg_amount_30d:positive' END,
          CASE WHEN max_amount_30d <= 0 THEN 'max_amount_30d:positive' END) AS reasons
      FROM b WHERE {BAD_BATCH}""",
    "s13_online_upsert": f"{_W} {latest('w', 'card_id', 'last_updated DESC')}",
    "s15_latest_partition": f"""WITH {TX}, b AS ({batch('tx')})
      SELECT card_id, trans_count_30d, 2 AS month, 1 AS day FROM b""",
    "p3_valid_events": f"""WITH {DIRTY} SELECT transaction_id, card_id, amount, event_time FROM dirty
      WHERE NOT ({BAD_EVENT})""",
    "p4_normalized": f"""WITH {DIRTY} SELECT transaction_id, is_fraud, transaction_dt,
        strftime({_REPLAYED}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
        COALESCE(CAST(TRY_CAST(card_id AS BIGINT) AS VARCHAR), 'unknown_card') AS card_id, amount, product_cd,
        'unknown' AS card_type, 'unknown' AS card_category, 'unknown' AS p_emaildomain,
        COALESCE(addr1, 0.0) AS addr1, CAST(0.0 AS DOUBLE) AS c1, COALESCE(c2, 0.0) AS c2 FROM dirty""",
    "p12_card": f"WITH {TX} SELECT transaction_id, card_id, amount FROM tx WHERE card_id = '8'",
    "p12_online": f"""{_W}, l AS ({latest('w', 'card_id', 'last_updated DESC')})
      SELECT * FROM l WHERE card_id IN ('8', '15', '21', 'no such card')""",
    "p12_keyed": f"""WITH {TX} SELECT transaction_id, card_id, amount, event_time FROM tx
      WHERE card_id IN ('8', '15', '21', 'no such card')""",
    "j2_training": f"""WITH {TX}, b AS ({batch('tx')})
      SELECT tx.card_id, transaction_id AS "TransactionID", is_fraud,
        CAST(trans_count_7d AS DOUBLE) AS trans_count_7d, CAST(trans_count_30d AS DOUBLE) AS trans_count_30d,
        avg_amount_30d, max_amount_30d, CAST(distinct_addr_7d AS DOUBLE) AS distinct_addr_7d, days_since_last_trans,
        amount AS "TransactionAmt", amount / (avg_amount_30d + 1.0) AS amount_ratio_30d,
        CASE WHEN amount > max_amount_30d THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS is_amount_gt_30d_max
      FROM tx JOIN b USING (card_id)""",
    "m1_point_in_time": f"""WITH {TX}, early AS (SELECT * FROM tx WHERE event_time < TIMESTAMP '2024-01-16 00:00:00'),
      b AS ({batch('early', '2024-01-16')})
      SELECT tx.card_id, transaction_id AS "TransactionID", is_fraud,
        CAST(trans_count_7d AS DOUBLE) AS trans_count_7d, CAST(trans_count_30d AS DOUBLE) AS trans_count_30d,
        avg_amount_30d, max_amount_30d, CAST(distinct_addr_7d AS DOUBLE) AS distinct_addr_7d, days_since_last_trans,
        amount AS "TransactionAmt", amount / (avg_amount_30d + 1.0) AS amount_ratio_30d,
        CASE WHEN amount > max_amount_30d THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS is_amount_gt_30d_max
      FROM tx JOIN b ON tx.card_id = b.card_id AND b.event_timestamp <= tx.event_time""",
    "j3_point_in_time": f"""WITH {TX}, {DAILY}
      SELECT transaction_id, tx.card_id, event_time,
        CASE WHEN fresh THEN day_count END AS day_count, CASE WHEN fresh THEN day_avg_amount END AS day_avg_amount,
        CASE WHEN fresh THEN day_max_amount END AS day_max_amount
      FROM (SELECT tx.*, d.*  EXCLUDE (card_id), d.known_at >= tx.event_time - INTERVAL 7 DAY AS fresh
            FROM tx ASOF LEFT JOIN daily d ON tx.card_id = d.card_id AND tx.event_time >= d.known_at) tx""",
    "j4_lookup": f"""WITH {DIRTY}, b AS ({batch('tx')})
      SELECT transaction_id, dirty.card_id, ABS(amount) AS current_amount, """
    + ", ".join(f"COALESCE(CAST({n} AS DOUBLE), {v}) AS {n}" for n, v in LOOKUP.items())
    + " FROM dirty LEFT JOIN b ON dirty.card_id = b.card_id",
    "e8_historical": f"""WITH {TX}, early AS (SELECT * FROM tx WHERE event_time < TIMESTAMP '2024-01-16 00:00:00'),
      b AS ({batch('early', '2024-01-16')})
      SELECT transaction_id, tx.card_id, event_time AS event_timestamp, trans_count_7d, max_amount_30d
      FROM tx LEFT JOIN b ON tx.card_id = b.card_id AND b.event_timestamp <= tx.event_time""",
    "e8_views": _TWO_VIEWS,
    "e8_views_hot": _TWO_VIEWS,
    "e9_on_demand": f"""WITH {DIRTY}, b AS ({batch('tx')}), w AS ({rolling()}), s AS ({latest('w', 'card_id', 'last_updated DESC')}),
      r AS (SELECT d.transaction_id, d.card_id, ABS(d.amount) AS current_amount, avg_amount_30d, max_amount_30d, trans_count_5m,
              avg_amount_24h, COALESCE(avg_amount_24h, 0.0) AS a24, COALESCE(avg_amount_30d, 0.0) AS a30,
              COALESCE(stddev_amount_24h, 0.0) AS s24, COALESCE(max_amount_30d, 0.0) AS m30, COALESCE(trans_count_5m, 0) AS c5
            FROM dirty d LEFT JOIN b ON d.card_id = b.card_id LEFT JOIN s ON d.card_id = s.card_id)
      SELECT transaction_id, card_id, current_amount, avg_amount_30d, max_amount_30d, trans_count_5m, avg_amount_24h,
        current_amount / (a24 + 1.0) AS amount_ratio_24h, current_amount / (a30 + 1.0) AS amount_ratio_30d,
        (current_amount - a24) / (s24 + CAST(0.01 AS DOUBLE)) AS amount_zscore_24h,
        CASE WHEN current_amount > m30 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_amount_gt_30d_max,
        CASE WHEN c5 >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_high_velocity_5m
      FROM r""",
    "e2_materialize": f"""WITH {TX}, {DAILY}
      SELECT card_id, MAX(known_at) AS known_at, arg_max(day_count, known_at) AS day_count,
        arg_max(day_max_amount, known_at) AS day_max_amount
      FROM daily WHERE known_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1""",
    "a1_batch_features": f"WITH {TX} {batch('tx')}",
    "a1_wide_amounts": f"""WITH {TX}, wide AS (
        SELECT * REPLACE (CASE CAST(card_id AS BIGINT) % 3 WHEN 0 THEN amount * 1e12::DOUBLE WHEN 1 THEN amount / 1e5::DOUBLE
                          ELSE amount END AS amount) FROM tx)
      SELECT card_id, COUNT(*) AS trans_count_30d, MAX(amount) AS max_amount_30d,
        ROUND(AVG(amount) / MAX(amount), 9) AS mean_share FROM wide GROUP BY 1""",
    "a1_windowed": f"""WITH {TX}, top AS (SELECT MAX(transaction_dt) AS t FROM tx)
      SELECT card_id, TIMESTAMP '2024-02-01 00:00:00' AS event_timestamp,
        COUNT(*) FILTER (transaction_dt >= t - 604800) AS trans_count_7d,
        COUNT(*) FILTER (transaction_dt >= t - 2592000) AS trans_count_30d,
        COALESCE(CAST(SUM(money) FILTER (transaction_dt >= t - 2592000) AS DOUBLE)
                 / COUNT(money) FILTER (transaction_dt >= t - 2592000), 0.0) AS avg_amount_30d,
        COALESCE(MAX(amount) FILTER (transaction_dt >= t - 2592000), 0.0) AS max_amount_30d,
        COUNT(DISTINCT addr1) FILTER (transaction_dt >= t - 604800) AS distinct_addr_7d,
        (MAX(t) - MAX(transaction_dt)) / 86400 AS days_since_last_trans
      FROM tx, top GROUP BY card_id""",
    "a2_balance": f"""WITH {TX} SELECT COUNT(*) FILTER (is_fraud = 0) AS negatives, COUNT(*) FILTER (is_fraud = 1) AS positives,
      CAST(COUNT(*) FILTER (is_fraud = 0) AS DOUBLE) / GREATEST(1, COUNT(*) FILTER (is_fraud = 1)) AS positive_weight FROM tx""",
    "a3_labels": f"""WITH {TX} SELECT COUNT(*) AS total_rows, CAST(SUM(is_fraud) AS BIGINT) AS fraud_rows,
      CAST(SUM(is_fraud) AS DOUBLE) * 100.0 / COUNT(*) AS fraud_percent FROM tx""",
    "a4_null_ratio": f"""WITH {DIRTY}, r AS (SELECT CAST(COUNT(*) FILTER (card_id IS NULL) AS DOUBLE) / COUNT(*) AS max_null_ratio FROM dirty)
      SELECT max_null_ratio, max_null_ratio > 0.001 AS is_warning FROM r""",
    "a5_counts": f"""WITH {DIRTY} SELECT COUNT(*) FILTER (NOT ({BAD_EVENT})) AS valid_rows,
      COUNT(*) FILTER ({BAD_EVENT}) AS corrupt_rows FROM dirty""",
    "a6_dedup": f"WITH {TX} SELECT transaction_id, card_id, amount FROM tx",
    "w1_counts": f"{_W} SELECT {_STREAM_COUNTS} FROM w",
    "w2_hour": f"{_W} SELECT transaction_id, total_amount_1h, avg_amount_1h, c2_count_sum_1h FROM w",
    "w4_day": f"{_W} SELECT transaction_id, avg_amount_24h, max_amount_24h, stddev_amount_24h FROM w",
    "w4_day_divided": f"{_W} SELECT * FROM w",
    "w6_equal_times": f"WITH {TX}, {equal_times()}",
    "w7_rounded": f"""{_W} SELECT transaction_id, ROUND(total_amount_1h, 2) AS total_amount_1h,
        ROUND(max_amount_24h, 2) AS max_amount_24h, ROUND(c2_count_sum_1h, 2) AS c2_count_sum_1h FROM w""",
    "w8_latest": f"{_W} {latest('w', 'card_id', 'last_updated DESC')}",
    "l3_sample": f"""WITH {TX} SELECT transaction_id, card_id, amount FROM tx
      ORDER BY {_HASH.format(seed=42)}, transaction_id LIMIT 2000""",
    "l4_split": f"""WITH {TX}, c AS (SELECT is_fraud, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM tx GROUP BY 1),
      e AS (SELECT *, CEIL(total * 0.2) AS quota, CEIL(total * 0.2) * n / total AS exact FROM c),
      q AS (SELECT *, FLOOR(exact) + CASE WHEN ROW_NUMBER() OVER (ORDER BY exact - FLOOR(exact) DESC, is_fraud)
              <= quota - SUM(FLOOR(exact)) OVER () THEN 1 ELSE 0 END AS k FROM e)
      SELECT transaction_id, tx.is_fraud,
        ROW_NUMBER() OVER (PARTITION BY tx.is_fraud ORDER BY {_HASH.format(seed=42)}, transaction_id) <= k AS is_test
      FROM tx JOIN q ON tx.is_fraud = q.is_fraud""",
    "l4_split_sizes": f"""WITH {TX}, c AS (SELECT is_fraud, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM tx GROUP BY 1),
      e AS (SELECT *, CEIL(total * 0.2) AS quota, CEIL(total * 0.2) * n / total AS exact FROM c),
      q AS (SELECT *, FLOOR(exact) + CASE WHEN ROW_NUMBER() OVER (ORDER BY exact - FLOOR(exact) DESC, is_fraud)
              <= quota - SUM(FLOOR(exact)) OVER () THEN 1 ELSE 0 END AS k FROM e)
      SELECT is_fraud, TRUE AS is_test, CAST(k AS BIGINT) AS n_rows FROM q
      UNION ALL SELECT is_fraud, FALSE, CAST(n - k AS BIGINT) FROM q""",
    "l5_union": f"WITH {TX} SELECT transaction_id, card_id, amount, event_time FROM tx",
    "q1_gate_clean": f"WITH {DIRTY}, b AS ({batch('dirty')}) SELECT * FROM b WHERE NOT ({BAD_BATCH})",
    "q3_failures": f"WITH {DIRTY}, f AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, COUNT(*) FILTER ({rule}) AS failed_rows FROM dirty"
        for name, rule in EVENT_CHECKS.items()
    )
    + ") SELECT * FROM f WHERE failed_rows > 0",
    "t3_quarantine": f"WITH {DIRTY} SELECT transaction_id, card_id, amount, {REASONS} AS reasons FROM dirty WHERE {BAD_EVENT}",
    "q7_drift": f"WITH {DRIFT} SELECT * FROM drift",
    "q7_distance": f"""WITH {DRIFT}, spread AS (SELECT column_name, STDDEV_POP(v) AS s FROM long_rows WHERE is_ref GROUP BY 1),
      steps AS (SELECT column_name, v, LEAD(v) OVER (PARTITION BY column_name ORDER BY v) - v AS step,
          CAST(SUM(r) OVER (PARTITION BY column_name ORDER BY v) AS DOUBLE) / CAST(SUM(r) OVER (PARTITION BY column_name) AS DOUBLE)
          - CAST(SUM(c) OVER (PARTITION BY column_name ORDER BY v) AS DOUBLE) / CAST(SUM(c) OVER (PARTITION BY column_name) AS DOUBLE) AS gap
        FROM counted),
      d AS (SELECT column_name, SUM(ABS(gap) * step) / GREATEST(ANY_VALUE(s), 0.001::DOUBLE) AS x FROM steps JOIN spread USING (column_name) GROUP BY 1)
      SELECT column_name, ROUND(x, 9) AS drift_score, x >= 0.1 AS drift_detected FROM d""",
    "q8_verdict": f"WITH {DRIFT}, {VERDICT} SELECT * FROM verdict",
    "m7_sweep": f"WITH {CURVE} SELECT model, threshold_index, threshold, fn_cost, fp_cost, total_cost FROM curve",
    "m8_best_f": f"""WITH {CURVE}, best AS (
      SELECT model, FIRST(threshold ORDER BY total_cost, threshold_index) AS optimal_threshold, MIN(total_cost) AS min_cost,
        CASE WHEN MAX(total_cost) FILTER (threshold_index = 49) = 0 THEN MIN(total_cost)
             ELSE MAX(total_cost) FILTER (threshold_index = 49) END AS cost_at_05,
        FIRST(threshold ORDER BY f1 DESC, threshold_index) AS f1_optimal_threshold,
        FIRST(threshold ORDER BY f2 DESC, threshold_index) AS f2_optimal_threshold,
        MAX(f1) AS best_f1_score, MAX(f2) AS best_f2_score
      FROM curve GROUP BY 1)
      SELECT *, GREATEST(0.0, cost_at_05 - min_cost) AS savings_amount,
        GREATEST(0.0, cost_at_05 - min_cost) / (cost_at_05 + 1e-9) * 100.0 AS savings_pct FROM best""",
    "m10_pr_auc": f"WITH {STEPS} SELECT model, pr_auc FROM areas",
    "m11_roc_auc": f"WITH {STEPS} SELECT model, roc_auc FROM areas",
    "m12_confusion": f"WITH {SCORED}, {confusion('CAST(0.37 AS DOUBLE)')} SELECT *, {F1} AS f1_score FROM conf",
    "m12_missing_scores": f"""WITH {STEPS.replace(SCORED, _GAPPY)}, {confusion('CAST(0.37 AS DOUBLE)')},
      cut AS (SELECT CAST(0.01 AS DOUBLE) + 36 * (CAST(0.89 AS DOUBLE) / CAST(89 AS DOUBLE)) AS c)
      SELECT conf.*, {F1} AS f1_score, sweep_tp, sweep_fp, sweep_rows, roc_auc FROM conf JOIN areas USING (model) JOIN (
        SELECT model, COUNT(*) FILTER (is_fraud = 1 AND score >= c) AS sweep_tp,
          COUNT(*) FILTER (is_fraud = 0 AND score >= c) AS sweep_fp, COUNT(*) AS sweep_rows
        FROM scored, cut GROUP BY 1) USING (model)""",
    "m2_split_gains": f"""{_FIRST_ROUND}
      SELECT feature, threshold, n_left, ROUND(gain, 6) AS gain FROM gains""",
    "m2_first_split": f"""{_FIRST_ROUND}, best AS (SELECT * FROM gains ORDER BY gain DESC, place, threshold LIMIT 1)
      SELECT f.transaction_id, ROUND(1.0::DOUBLE / (1.0::DOUBLE + EXP(-CASE WHEN x <= threshold
        THEN -0.5::DOUBLE * gl / (hl + 1.0::DOUBLE) ELSE -0.5::DOUBLE * (best.g - gl) / (best.h - hl + 1.0::DOUBLE) END)), 9) AS score
      FROM f JOIN best USING (feature)""",
    "m2_learned": f"""WITH {TX}, r AS (SELECT CAST(COALESCE(amount > 40 AND amount <= 120 AND c2 > 24 AND d4 > 1, FALSE) AS INTEGER) AS rule FROM tx)
      SELECT rule, rule AS predicted, COUNT(*) AS n FROM r GROUP BY rule""",
    "m2_train_report": f"""WITH {TX} SELECT COUNT(*) AS dataset_size, COUNT(*) - CAST(CEIL(COUNT(*) * 0.2) AS BIGINT) AS train_size,
        CAST(CEIL(COUNT(*) * 0.2) AS BIGINT) AS val_size, CAST(9 AS BIGINT) AS feature_count,
        'trans_count_7d,trans_count_30d,avg_amount_30d,max_amount_30d,distinct_addr_7d,days_since_last_trans,'
        || 'TransactionAmt,amount_ratio_30d,is_amount_gt_30d_max' AS features, TRUE AS whole FROM tx""",
    "m5_rejected": f"""WITH {DIRTY} SELECT transaction_id, card_id, amount AS current_amount,
        concat_ws(',', CASE WHEN COALESCE(LENGTH(TRIM(card_id)), 0) = 0 THEN 'card_id:required' END,
                  CASE WHEN amount <= 0 THEN 'current_amount:positive' END) AS errors
      FROM dirty WHERE COALESCE(LENGTH(TRIM(card_id)), 0) = 0 OR amount <= 0""",
    "m5_score": f"""WITH {DIRTY}, b AS ({batch('tx')}), r AS (
        SELECT transaction_id, dirty.card_id, amount AS current_amount, COALESCE(CAST(trans_count_7d AS DOUBLE), 1.0) AS trans_count_7d,
          COALESCE(max_amount_30d, 500.0) AS top,
          CAST(0.5 AS DOUBLE) * (CAST(((transaction_id - 1) * 7919) % 1000 AS DOUBLE) / 1000.0::DOUBLE)
          + CAST(0.5 AS DOUBLE) * (CAST(((transaction_id - 1) * 104729) % 997 AS DOUBLE) / 997.0::DOUBLE) AS score
        FROM dirty LEFT JOIN b ON dirty.card_id = b.card_id WHERE LENGTH(TRIM(dirty.card_id)) > 0 AND amount > 0)
      SELECT transaction_id, card_id, current_amount, CAST(score >= 0.37::DOUBLE AS INTEGER) AS is_fraud,
        CASE WHEN score >= 0.37::DOUBLE THEN 'ALERT: FRAUD DETECTED' ELSE 'APPROVED' END AS decision,
        CAST(0.37 AS DOUBLE) AS decision_threshold, trans_count_7d, ROUND(top, 2) AS max_amount_30d,
        CAST(CASE WHEN current_amount > top THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_amount_gt_30d_max FROM r""",
    "m5_compiled": f"""WITH {DIRTY}, b AS ({batch('tx')}), r AS (
        SELECT transaction_id, dirty.card_id, amount AS current_amount, COALESCE(CAST(trans_count_7d AS DOUBLE), 1.0) AS trans_count_7d
        FROM dirty LEFT JOIN b ON dirty.card_id = b.card_id WHERE LENGTH(TRIM(dirty.card_id)) > 0 AND amount > 0),
      m AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + EXP(-2.0::DOUBLE * {fixed_score('current_amount', 'trans_count_7d')})) AS x, {_FOREST} AS y FROM r),
      s AS (SELECT *, 0.5::DOUBLE * x + 0.125::DOUBLE * y AS score FROM m)
      SELECT transaction_id, card_id, CAST(score >= 0.6::DOUBLE AS INTEGER) AS is_fraud, ROUND(score, 4) AS fraud_score,
        ROUND(x, 4) AS boosted_score, ROUND(y, 4) AS forest_score,
        CASE WHEN score >= 0.6::DOUBLE THEN 'ALERT: FRAUD DETECTED' ELSE 'APPROVED' END AS decision FROM s""",
    "m6_shap": f"""WITH {TX}, f AS (SELECT transaction_id, {fixed_score('amount', 'c2')} AS every, {fixed_score('amount')} AS a,
        {fixed_score('', 'c2')} AS c, {fixed_score()} AS none FROM tx)
      SELECT transaction_id, every AS raw_score, none AS base_value, 0.5::DOUBLE * ((a - none) + (every - c)) AS shap_amount,
        0.5::DOUBLE * ((c - none) + (every - a)) AS shap_c2 FROM f""",
    "m6_permuted": f"""WITH {TX}, s AS (SELECT transaction_id, amount, c2, amount * 2.0::DOUBLE AS ratio FROM tx
        ORDER BY {_HASH.format(seed=42)}, transaction_id LIMIT 500),
      o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {_HASH.format(seed=43)}, transaction_id) AS i, COUNT(*) OVER () AS n FROM s),
      p AS (SELECT o.transaction_id, o.amount, o.c2, o.ratio, q.amount AS pa, q.c2 AS pc, q.ratio AS pr
            FROM o JOIN o q ON q.i = o.i % o.n + 1)
      SELECT transaction_id, permuted, CASE WHEN permuted = 'amount' THEN pa ELSE amount END AS amount,
        CASE WHEN permuted = 'c2' THEN pc ELSE c2 END AS c2, CASE WHEN permuted = 'ratio' THEN pr ELSE ratio END AS ratio
      FROM p, (VALUES (''), ('amount'), ('c2'), ('ratio')) f(permuted)""",
    "m13_points": f"""WITH {STEPS} SELECT DISTINCT model, NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr,
      1.0::DOUBLE AS precision, 0.0::DOUBLE AS recall FROM steps UNION ALL SELECT model, score AS threshold, CAST(fp AS DOUBLE) / CAST(n AS DOUBLE) AS fpr,
      CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS tpr, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
      CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS recall FROM steps""",
    "m14_curve": f"WITH {CURVE} SELECT model, threshold_index, tp, fp, fn, tn, precision, recall, f1, f2 FROM curve",
    "m15_report": f"WITH {SCORED}, {confusion('CAST(0.5 AS DOUBLE)')}, {CLASS_REPORT}",
    "m16_comparison": f"""WITH {STEPS}, {confusion("CASE WHEN model = 'b' THEN CAST(0.37 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END")}
      SELECT areas.*, conf.* EXCLUDE (model), {F1} AS f1_score FROM areas JOIN conf USING (model)""",
    "t2_stream": f"""WITH {TX}, good AS (SELECT * FROM tx WHERE NOT ({BAD_EVENT})), w AS ({rolling('good')})
      SELECT {_STREAM_COUNTS} FROM w""",
    "t1_card_minutes": f"""WITH {TX}, m AS (SELECT card_id, DATE_TRUNC('minute', event_time) AS minute, COUNT(*) AS events,
        CAST(SUM(CAST(ROUND(amount * 10000.0::DOUBLE) AS BIGINT)) AS DOUBLE) / 10000.0::DOUBLE AS amount FROM tx GROUP BY 1, 2)
      SELECT * FROM m WHERE minute + INTERVAL 1 MINUTE <= (SELECT MAX(event_time) FROM tx) - INTERVAL 10 MINUTE""",
    "t2_stream_batches": f"{_W} SELECT * FROM w",
    "t2_stateful": f"{_W} SELECT * FROM w",
    "a6_stream_once": f"{_W} SELECT * FROM w",
    "t3_stream_quarantine": f"WITH {DIRTY} SELECT transaction_id, card_id, amount, {REASONS} AS reasons FROM dirty WHERE {BAD_EVENT}",
    "t4_archive": f"""WITH {DIRTY} SELECT transaction_id, card_id, amount, c2, product_cd, event_time AS event_timestamp,
      FALSE AS late FROM dirty WHERE NOT ({BAD_EVENT})""",
    "o1_audit": f"""WITH {DIRTY} SELECT
      CASE WHEN COUNT(*) FILTER (card_id = '8' AND NOT ({BAD_EVENT})) > 0 THEN 'PASSED' ELSE 'READY' END AS online_store,
      CASE WHEN COUNT(*) FILTER (NOT ({BAD_EVENT})) > 0 THEN 'PASSED' ELSE 'FAILED' END AS lakehouse_partition,
      'PASSED (' || COUNT(*) FILTER ({BAD_EVENT}) || ' isolated records)' AS quarantine_store FROM dirty""",
    "o2_retrain": f"""WITH {DRIFT}, {VERDICT}
      SELECT dataset_drift, s AS scheduled_run, f AS force_retrain, TRUE AS should_retrain,
        CASE WHEN s OR f THEN 'SCHEDULED_TIME_BASED_CRON' WHEN dataset_drift THEN 'EVENT_DRIVEN_DATA_DRIFT_DETECTED'
             ELSE 'BASELINE_PIPELINE_VERIFICATION' END AS trigger_reason
      FROM verdict, (VALUES (FALSE), (TRUE)) a(s), (VALUES (FALSE), (TRUE)) b(f)""",
    "o3_flow": f"""WITH {DIRTY}, b AS ({batch('dirty')})
      SELECT (SELECT COUNT(*) FROM b WHERE NOT ({BAD_BATCH})) AS online_cards,
      CASE WHEN COUNT(*) FILTER (card_id = '8' AND NOT ({BAD_EVENT})) > 0 THEN 'PASSED' ELSE 'READY' END AS online_store,
      'PASSED' AS lakehouse_partition,
      'PASSED (' || COUNT(*) FILTER ({BAD_EVENT}) || ' isolated records)' AS quarantine_store,
      'SKIPPED' AS drift_status, 'BASELINE_PIPELINE_VERIFICATION' AS trigger_reason FROM dirty""",
}

# Few addresses per card: the sketch counts them exactly here.
ORACLE["a1_incremental"] = ORACLE["a1_windowed"]
# The same results, whatever the bound above which a card counts as hot.
for _name in ("j3_point_in_time", "j4_lookup", "e9_on_demand"):
    ORACLE[f"{_name}_hot"] = ORACLE[_name]
