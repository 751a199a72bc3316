"""The SQL each registered query is checked against."""

from __future__ import annotations

import re

# Views shared by the statements; a statement carries those that it needs.
VIEWS = r"""
WITH inter AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS timestamp,
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pairs AS (
  SELECT user_id, item_id, rating, timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY timestamp DESC,
      l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, rating DESC) AS rn
    FROM inter) WHERE rn = 1),
often AS (
  SELECT * FROM pairs WHERE user_id IN (
    SELECT user_id FROM pairs GROUP BY user_id HAVING count(*) >= 10)),
clean AS (
  SELECT * FROM often WHERE item_id IN (
    SELECT item_id FROM often GROUP BY item_id HAVING count(*) >= 10)),
split AS MATERIALIZED (
  SELECT user_id, item_id, rating, timestamp,
    CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY timestamp, item_id)
      <= greatest(1, floor(count(*) OVER (PARTITION BY user_id) * (1::DOUBLE - 0.2::DOUBLE)))
      THEN 'train' ELSE 'test' END AS split
  FROM clean),
train AS (SELECT user_id, item_id, rating, timestamp FROM split WHERE split = 'train'),
test AS (SELECT user_id, item_id, rating, timestamp FROM split WHERE split = 'test'),
mixed AS (
  SELECT *, CASE WHEN (user_id + item_id) % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM clean),
meta AS (
  SELECT p_partkey AS item_id, p_name AS title, [p_type, p_brand] AS description,
    [p_brand] AS features,
    CASE WHEN p_partkey % 17 = 0 THEN 'N/A' ELSE CAST(p_retailprice AS VARCHAR) END AS price,
    p_type AS main_category FROM part),
holed AS (
  SELECT CASE WHEN item_id % 11 <> 0 THEN item_id END AS item_id,
    CASE WHEN item_id % 5 = 0 THEN '  ' ELSE title END AS title,
    CASE WHEN item_id % 13 <> 0 THEN main_category END AS main_category FROM meta),
vectors AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings),
popular AS (
  SELECT item_id, count(*) AS interactions,
    row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
  FROM train GROUP BY item_id),
poplists AS (
  SELECT user_id, item_id, rank FROM (SELECT DISTINCT user_id FROM test), popular WHERE rank <= 20),
permetrics AS (
  SELECT t.user_id, t.n, count(h.rank) FILTER (h.rank <= 1) AS h1,
    count(h.rank) FILTER (h.rank <= 5) AS h5, count(h.rank) FILTER (h.rank <= 10) AS h10,
    count(h.rank) AS h20, min(h.rank) AS first,
    coalesce(sum(1 / log2(h.rank + 1)) FILTER (h.rank <= 1), 0) AS g1,
    coalesce(sum(1 / log2(h.rank + 1)) FILTER (h.rank <= 5), 0) AS g5,
    coalesce(sum(1 / log2(h.rank + 1)) FILTER (h.rank <= 10), 0) AS g10,
    coalesce(sum(1 / log2(h.rank + 1)), 0) AS g20
  FROM (SELECT user_id, count(*) AS n FROM test GROUP BY user_id) t
  LEFT JOIN (SELECT p.user_id, p.rank FROM poplists p JOIN test USING (user_id, item_id)) h
    USING (user_id)
  GROUP BY t.user_id, t.n),
ideal AS (
  SELECT n, sum(1 / log2(n + 1)) OVER (ORDER BY n) AS best FROM range(1, 21) r(n)),
scores AS (
  SELECT p.*, h1 / 1.0::DOUBLE AS p1, h5 / 5.0::DOUBLE AS p5, h10 / 10.0::DOUBLE AS p10,
    h20 / 20.0::DOUBLE AS p20, h1 / p.n::DOUBLE AS r1, h5 / p.n::DOUBLE AS r5,
    h10 / p.n::DOUBLE AS r10, h20 / p.n::DOUBLE AS r20,
    g1 / i1.best AS n1, g5 / i5.best AS n5, g10 / i10.best AS n10, g20 / i20.best AS n20,
    coalesce(1.0::DOUBLE / first, 0) AS rr
  FROM permetrics p JOIN ideal i1 ON i1.n = least(p.n, 1) JOIN ideal i5 ON i5.n = least(p.n, 5)
  JOIN ideal i10 ON i10.n = least(p.n, 10) JOIN ideal i20 ON i20.n = least(p.n, 20)),
wideset AS (
  UNPIVOT (SELECT avg(p5) AS precision_at_5, avg(p10) AS precision_at_10,
    avg(p20) AS precision_at_20, avg(r5) AS recall_at_5, avg(r10) AS recall_at_10,
    avg(r20) AS recall_at_20, avg(n5) AS ndcg_at_5, avg(n10) AS ndcg_at_10,
    avg(n20) AS ndcg_at_20 FROM scores) ON COLUMNS(*) INTO NAME metric VALUE value),
shortset AS (
  UNPIVOT (SELECT avg(p1) AS precision_at_1, avg(p5) AS precision_at_5,
    avg(h5 / 10.0::DOUBLE) AS precision_at_10, avg(r1) AS recall_at_1, avg(r5) AS recall_at_5,
    avg(h5 / n::DOUBLE) AS recall_at_10, avg(n1) AS ndcg_at_1, avg(n5) AS ndcg_at_5,
    avg(g5 / (SELECT best FROM ideal WHERE ideal.n = least(scores.n, 10))) AS ndcg_at_10
    FROM scores) ON COLUMNS(*) INTO NAME metric VALUE value),
liked AS (
  SELECT * FROM (
    SELECT *, max(rating) OVER (PARTITION BY user_id) AS best FROM train)
  WHERE rating >= 4 OR best < 4),
products AS (
  SELECT a.item_id, b.item_id AS neighbour_id,
    round(list_inner_product(a.embedding, b.embedding), 9) AS similarity
  FROM vectors a JOIN vectors b ON a.item_id <> b.item_id),
nearest AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY item_id ORDER BY similarity DESC, neighbour_id) AS rank FROM products)
  WHERE rank <= 20),
semantic AS (
  SELECT user_id, item_id, score, row_number() OVER (
    PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
  FROM (
    SELECT l.user_id, n.neighbour_id AS item_id, round(avg(n.similarity), 9) AS score
    FROM liked l JOIN nearest n ON n.item_id = l.item_id
    WHERE NOT EXISTS (SELECT 1 FROM train t
      WHERE t.user_id = l.user_id AND t.item_id = n.neighbour_id)
    GROUP BY ALL)),
ulong AS (
  SELECT user_id, count(rating) AS num_ratings, avg(rating) AS avg_rating,
    coalesce(stddev_samp(rating), 0) AS rating_std,
    (max(timestamp) - min(timestamp)) / 86400.0::DOUBLE AS days_active
  FROM train GROUP BY user_id),
ev AS (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS uid FROM events),
preds AS (
  SELECT event_id, ts AS timestamp, uid AS user_id,
    CASE WHEN CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 50 THEN 'B' ELSE 'A' END AS variant,
    list_transform(range(k, k + CAST(event_id % 10 AS INTEGER) + 1), lambda i: CAST(i % 100 AS VARCHAR)) AS items,
    value AS latency_ms, hour(ts) AS request_hour, isodow(ts) - 1 AS request_dayofweek
  FROM ev WHERE event_type = 'view'),
fb AS (
  SELECT event_id, ts AS timestamp, ts AS logged_at, uid AS user_id, CAST(k AS VARCHAR) AS item_id,
    CASE WHEN event_type = 'signup' THEN 'ignore' ELSE event_type END AS action
  FROM ev WHERE event_type IN ('click', 'purchase', 'signup')),
attributed AS (
  SELECT f.event_id, f.action, coalesce(p.variant, 'none') AS variant,
    coalesce(epoch_us(p.timestamp), 0) AS predicted_at
  FROM fb f ASOF LEFT JOIN preds p ON f.user_id = p.user_id AND f.timestamp >= p.timestamp),
attributed_table AS (
  SELECT variant, CAST(coalesce(n, 0) AS BIGINT) AS n, CAST(coalesce(clicks, 0) AS BIGINT) AS clicks
  FROM (SELECT variant, count(*) AS n FROM preds GROUP BY variant)
  FULL JOIN (SELECT variant, count(*) AS clicks FROM attributed WHERE action = 'click'
    GROUP BY variant) USING (variant)),
user_table AS (
  SELECT variant, n, CAST(coalesce(clicks, 0) AS BIGINT) AS clicks
  FROM (SELECT variant, count(*) AS n FROM preds GROUP BY variant)
  LEFT JOIN (SELECT p.variant, count(*) AS clicks FROM fb JOIN preds p USING (user_id)
    WHERE action = 'click' GROUP BY p.variant) USING (variant)),
segments AS (
  SELECT k % 10 AS segment,
    CASE WHEN CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 50 THEN 'B' ELSE 'A' END AS variant,
    count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks
  FROM ev GROUP BY ALL),
sides AS (
  SELECT segment, CAST(sum(clicks) FILTER (variant = 'A') AS BIGINT) AS clicks_a,
    CAST(sum(n) FILTER (variant = 'A') AS BIGINT) AS n_a,
    CAST(sum(clicks) FILTER (variant = 'B') AS BIGINT) AS clicks_b,
    CAST(sum(n) FILTER (variant = 'B') AS BIGINT) AS n_b
  FROM segments GROUP BY segment),
log AS (
  SELECT event_id, ts, value AS latency_ms, k AS num_items, event_type AS variant,
    hour(ts) AS request_hour, isodow(ts) - 1 AS request_dayofweek FROM ev),
flagged AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY ts, event_id)
    <= least(greatest(floor(count(*) OVER () * 0.5::DOUBLE), 20), count(*) OVER () - 20)
    THEN 'reference' ELSE 'current' END AS part FROM log),
longlog AS (
  UNPIVOT (SELECT part, latency_ms::DOUBLE AS latency_ms, num_items::DOUBLE AS num_items,
    request_hour::DOUBLE AS request_hour, request_dayofweek::DOUBLE AS request_dayofweek FROM flagged)
  ON latency_ms, num_items, request_hour, request_dayofweek INTO NAME "column" VALUE value),
shift AS (
  SELECT "column", abs(avg(value) FILTER (part = 'current') - avg(value) FILTER (part = 'reference'))
    / greatest(stddev_pop(value) FILTER (part = 'reference'), 1.0) AS score
  FROM longlog GROUP BY "column"),
textlog AS (
  UNPIVOT (SELECT part, variant, CAST(request_dayofweek AS VARCHAR) AS request_dayofweek FROM flagged)
  ON variant, request_dayofweek INTO NAME "column" VALUE value),
parts AS (
  SELECT count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM flagged),
textcounts AS (
  SELECT "column", value, count(*) FILTER (part = 'reference') AS o,
    count(*) FILTER (part = 'current') AS n FROM textlog GROUP BY "column", value),
variation AS (
  SELECT "column", 0.5 * sum(abs(o / r::DOUBLE - n / c::DOUBLE)) AS score
  FROM textcounts, parts GROUP BY "column"),
reportrows AS (
  SELECT "column", round(score, 4) AS drift_score, score > 0.5 AS drift_detected,
    'normalized_mean_shift' AS method FROM shift
  UNION ALL
  SELECT "column", round(score, 4), score > 0.1, 'total_variation_distance'
  FROM variation WHERE "column" = 'variant'),
steps AS (
  SELECT "column", value,
    abs(sum(o) OVER w / sum(o) OVER a::DOUBLE - sum(n) OVER w / sum(n) OVER a::DOUBLE) AS gap,
    lead(value) OVER w - value AS step, sum(o) OVER a AS r, sum(n) OVER a AS c
  FROM (SELECT "column", value, count(*) FILTER (part = 'reference') AS o,
    count(*) FILTER (part = 'current') AS n FROM longlog GROUP BY "column", value)
  WINDOW w AS (PARTITION BY "column" ORDER BY value), a AS (PARTITION BY "column")),
canary AS (
  SELECT user_id % 5 AS experiment, count(*) FILTER (event_id % 2 = 0) AS samples,
    count(*) FILTER (event_id % 2 = 0 AND event_type = 'error') AS errors
  FROM events GROUP BY user_id % 5),
metrictable AS (
  UNPIVOT (SELECT o_orderpriority AS experiment, o_orderstatus AS run_id,
    avg(o_totalprice) AS mean_price, count(*)::DOUBLE AS orders,
    stddev_samp(o_totalprice) AS spread FROM orders GROUP BY ALL)
  ON mean_price, orders, spread INTO NAME metric VALUE value),
compared AS (
  SELECT experiment, metric, c.value AS candidate, p.value AS production,
    c.value - p.value AS absolute_diff,
    CASE WHEN p.value = 0 THEN 0 ELSE (c.value - p.value) / p.value END AS relative_diff,
    c.value > p.value AS improved,
    c.value > p.value AND (c.value - p.value) / p.value >= 0.01 AS significant
  FROM (SELECT * FROM metrictable WHERE run_id = 'O') c
  JOIN (SELECT * FROM metrictable WHERE run_id = 'F') p USING (experiment, metric)),
scored AS (
  SELECT t.user_id, t.item_id, t.rating, m.score, m.score / 5.0::DOUBLE AS probability,
    CAST(t.rating >= 4 AS INTEGER) AS label
  FROM test t JOIN (SELECT user_id, round(avg(rating), 6) AS score FROM train GROUP BY user_id) m
    USING (user_id)),
closing AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events),
catalogue AS (
  SELECT item_id, row_number() OVER (ORDER BY md5(CAST(item_id AS VARCHAR)), item_id) - 1 AS idx
  FROM (SELECT DISTINCT item_id FROM train)),
unseen AS (
  SELECT u.user_id, c.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY c.idx) - 1 AS place,
    count(*) OVER (PARTITION BY u.user_id) AS free
  FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN catalogue c
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = c.item_id)),
asked AS (
  SELECT t.user_id, t.item_id AS positive_id, f.free, [
    CAST('0x' || substr(md5(concat_ws('|', t.user_id, t.item_id, 0, 42)), 1, 15) AS BIGINT) % greatest(f.free, 1),
    CAST('0x' || substr(md5(concat_ws('|', t.user_id, t.item_id, 1, 42)), 1, 15) AS BIGINT) % greatest(f.free - 1, 1),
    CAST('0x' || substr(md5(concat_ws('|', t.user_id, t.item_id, 2, 42)), 1, 15) AS BIGINT) % greatest(f.free - 2, 1),
    CAST('0x' || substr(md5(concat_ws('|', t.user_id, t.item_id, 3, 42)), 1, 15) AS BIGINT) % greatest(f.free - 3, 1)] AS h
  FROM train t JOIN (SELECT DISTINCT user_id, free FROM unseen) f USING (user_id) WHERE t.rating >= 4),
drawn1 AS (SELECT *, h[1] AS r0, h[2] + CAST(h[2] >= h[1] AS INTEGER) AS r1 FROM asked),
drawn2 AS (SELECT *, h[3] + CAST(h[3] >= least(r0, r1) AS INTEGER) AS x2 FROM drawn1),
drawn3 AS (SELECT *, x2 + CAST(x2 >= greatest(r0, r1) AS INTEGER) AS r2 FROM drawn2),
drawn4 AS (SELECT *, list_sort([r0, r1, r2]) AS s FROM drawn3),
drawn5 AS (SELECT *, h[4] + CAST(h[4] >= s[1] AS INTEGER) AS x3 FROM drawn4),
drawn6 AS (SELECT *, x3 + CAST(x3 >= s[2] AS INTEGER) AS y3 FROM drawn5),
drawn7 AS (SELECT *, y3 + CAST(y3 >= s[3] AS INTEGER) AS r3 FROM drawn6),
negatives AS (
  SELECT d.user_id, d.positive_id, d.slot, u.item_id
  FROM (SELECT user_id, positive_id, free, unnest([0, 1, 2, 3]) AS slot, unnest([r0, r1, r2, r3]) AS place
    FROM drawn7) d
  JOIN unseen u ON u.user_id = d.user_id AND u.place = d.place WHERE d.slot < d.free)
"""

_TEST = """
  CASE WHEN pooled > 1 THEN NULL WHEN pooled IS NULL OR pooled * (1 - pooled) = 0 THEN 0
    ELSE (clicks_b / n_b::DOUBLE - clicks_a / n_a::DOUBLE)
      / sqrt(pooled * (1 - pooled) * (1 / n_a::DOUBLE + 1 / n_b::DOUBLE)) END"""
# Two-sided normal p by the series erf(x) = exp(-x^2) * sum x^(2n+1) / gamma(n + 3/2).
_P = """
  2 * (1 - 0.5 * (1 + exp(-x * x) * (
    SELECT sum(x ** (2 * n + 1) / gamma(n + 1.5::DOUBLE)) FROM range(0, 150) s(n))))"""


def _tested(source: str) -> str:
    return f"""
    SELECT *, {_P} AS p FROM (
      SELECT *, CASE WHEN z IS NOT NULL THEN least(abs(z) / sqrt(2.0::DOUBLE), 6) END AS x FROM (
        SELECT *, {_TEST} AS z FROM (
          SELECT *, (clicks_a + clicks_b) / (n_a + n_b)::DOUBLE AS pooled FROM {source})))"""


def _sides(source: str) -> str:
    return f"""(
      SELECT CAST(sum(clicks) FILTER (variant = 'A') AS BIGINT) AS clicks_a,
        CAST(sum(n) FILTER (variant = 'A') AS BIGINT) AS n_a,
        CAST(sum(clicks) FILTER (variant = 'B') AS BIGINT) AS clicks_b,
        CAST(sum(n) FILTER (variant = 'B') AS BIGINT) AS n_b FROM {source})"""


def _readout(source: str) -> str:
    return f"""
    SELECT clicks_a, n_a, clicks_b, n_b, round(z, 4) AS z, round(p, 4) AS p, round(p, 4) < 0.05 AS significant,
      round((clicks_b / n_b::DOUBLE - clicks_a / n_a::DOUBLE)
        / greatest(clicks_a / n_a::DOUBLE, 1e-9), 6) AS lift
    FROM ({_tested(_sides(source))})"""


def _list_metrics(lists: str, truth: str, ks: tuple[int, ...]) -> str:
    """Mean metrics of ``lists`` (user_id, item_id, rank) over the users of ``truth``."""
    columns = []
    for k in ks:
        gain = f"coalesce(sum(1 / log2(h.rank + 1)) FILTER (h.rank <= {k}), 0)"
        best = f"(SELECT best FROM ideal WHERE ideal.n = least(t.n, {k}))"
        hits = f"count(h.rank) FILTER (h.rank <= {k})"
        columns += [
            f"{hits} / {k}::DOUBLE AS precision_at_{k}",
            f"{hits} / t.n::DOUBLE AS recall_at_{k}",
            f"{gain} / {best} AS ndcg_at_{k}",
        ]
    names = [f"{m}_at_{k}" for k in ks for m in ("precision", "recall", "ndcg")]
    return f"""
    SELECT {', '.join(f'round(avg({n}), 6) AS {n}' for n in names)} FROM (
      SELECT t.user_id, {', '.join(columns)}
      FROM (SELECT user_id, count(*) AS n FROM {truth} GROUP BY user_id) t
      LEFT JOIN (SELECT l.user_id, l.rank FROM {lists} l
        JOIN (SELECT DISTINCT user_id, item_id FROM {truth}) USING (user_id, item_id)) h
        ON h.user_id = t.user_id
      GROUP BY t.user_id, t.n)"""


_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def _histogram(source: str, value: str, keys: str, bounds: list[float], last: str = "") -> str:
    cells = " UNION ALL ".join(
        f"SELECT {keys}, '{b}' AS le, count(*) FILTER ({value} <= {b}) AS observations, "
        f"round(sum({value}), 6) AS total, count({value}) AS samples FROM {source} GROUP BY {last or keys}"
        for b in bounds
    )
    return f"""{cells} UNION ALL SELECT {keys}, '+Inf', count({value}), round(sum({value}), 6),
      count({value}) FROM {source} GROUP BY {last or keys}"""


_LATENCY = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
_SCORE = [i / 2 for i in range(11)]


def _item_table(train: str) -> str:
    return f"""(
      SELECT r.item_id, r.avg_rating_received, r.num_ratings_received, r.rating_std_received,
        coalesce(m.price, median(m.price) OVER (), 0) AS price,
        coalesce(m.description_length, 0) AS description_length
      FROM (SELECT item_id, avg(rating) AS avg_rating_received, count(rating) AS num_ratings_received,
          coalesce(stddev_samp(rating), 0) AS rating_std_received FROM {train} GROUP BY item_id) r
      LEFT JOIN (SELECT item_id, TRY_CAST(price AS DOUBLE) AS price,
          length(array_to_string(description, ' ')) AS description_length FROM meta) m USING (item_id))"""


_CANDIDATES = """(
  SELECT user_id, item_id, arg_min(score, source) AS score FROM (
    SELECT user_id, item_id, (SELECT avg(rating) FROM train) AS score, 0 AS source
    FROM (SELECT DISTINCT user_id FROM train), (
      SELECT item_id FROM train GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 100)
    UNION ALL
    SELECT user_id, item_id, score, 1 FROM semantic WHERE rank <= 100)
  GROUP BY user_id, item_id)"""

_PAIRS = """(
  SELECT user_id, item_id, 1 AS label FROM train WHERE rating >= 4 UNION ALL
  SELECT user_id, item_id, 0 FROM negatives)"""

_LISTS = """
  SELECT user_id, least(10, (SELECT count(DISTINCT item_id) FROM train) - count(*)) AS rows,
    true AS ranked, true AS sorted, true AS unseen
  FROM train GROUP BY user_id
  HAVING count(*) < (SELECT count(DISTINCT item_id) FROM train)"""


# Test pairs beside what the training part knows, from one scan of the split.
_KNOWN_TEST = """(SELECT user_id, item_id, known_user, known_item, mean FROM (
      SELECT user_id, item_id, split, bool_or(split = 'train') OVER (PARTITION BY user_id) AS known_user,
        bool_or(split = 'train') OVER (PARTITION BY item_id) AS known_item,
        avg(rating) FILTER (split = 'train') OVER () AS mean FROM split) WHERE split = 'test')"""


_COLD = """
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
      SELECT l.user_id, n.neighbour_id AS item_id, round(avg(n.similarity), 9) AS score
      FROM (SELECT * FROM (SELECT *, max(rating) OVER (PARTITION BY user_id) AS best
        FROM train WHERE item_id % 7 <> 0) WHERE rating >= 4 OR best < 4) l
      JOIN nearest n ON n.item_id = l.item_id
      WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.item_id % 7 <> 0
        AND t.user_id = l.user_id AND t.item_id = n.neighbour_id)
      GROUP BY ALL))"""

_KNOWN = "(SELECT item_id FROM train WHERE item_id % 7 <> 0)"
_WARM = f"(SELECT * FROM test WHERE item_id IN {_KNOWN})"
_CHILLED = f"(SELECT * FROM test WHERE item_id NOT IN {_KNOWN})"


def _check(data: str, check: str, violations: str, source: str, passed: str | None = None) -> str:
    label = f"'{data}' AS data, " if data else ""
    count = f"CAST({violations} AS BIGINT)"
    return (
        f"SELECT {label}'{check}' AS \"check\", {count} AS violations, "
        f"{passed or count + ' = 0'} AS passed FROM {source}"
    )


def _late(source: str) -> str:
    return f"""(SELECT a.user_id FROM
      (SELECT user_id, max(timestamp) AS hi FROM {source} WHERE split = 'train' GROUP BY 1) a
      JOIN (SELECT user_id, min(timestamp) AS lo FROM {source} WHERE split = 'test' GROUP BY 1) b
      USING (user_id) WHERE hi > lo)"""


def _range_check(data: str, value: str) -> str:
    n = f"""CASE WHEN max({value}) < 1000000000 THEN 0
      WHEN max({value}) > 1000000000000 THEN count(*) FILTER ({value} < 820454400000 OR {value} > 1798761599000)
      ELSE count(*) FILTER ({value} < 820454400 OR {value} > 1798761599) END"""
    return _check(data, "timestamp_range", n, "inter")


BODIES: dict[str, str] = {
    # sources and sinks
    "scan_reviews": """SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS rows,
        round(sum(rating), 6) AS ratings, max(timestamp) AS latest FROM inter GROUP BY user_id""",
    "scan_metadata": """SELECT CAST(item_id AS VARCHAR) AS item_id, title, price, main_category,
        len(features) AS n FROM meta""",
    "write_splits": """SELECT 'train' AS name, count(*) AS rows FROM train UNION ALL
        SELECT 'test', count(*) FROM test UNION ALL SELECT 'metadata', count(*) FROM meta""",
    "scan_splits": "SELECT user_id, item_id, rating, timestamp, split FROM split",
    "scan_prediction_log": f"""SELECT strftime(timestamp, {_STAMP}) AS timestamp, user_id, variant,
        array_to_string(items, ',') AS items, round(latency_ms, 2) AS latency_ms, len(items) AS num_items,
        items[1] AS top_item, request_hour, request_dayofweek FROM preds""",
    "scan_feedback_log": f"""SELECT strftime(timestamp, {_STAMP}) AS timestamp,
        strftime(logged_at, {_STAMP}) AS logged_at, user_id, item_id, action FROM fb""",
    "append_logs": """SELECT variant, 2 * count(*) AS rows, round(2 * sum(round(latency_ms, 2)), 6) AS latency_ms
        FROM preds GROUP BY variant""",
    "write_metric_comparison": """SELECT metric, round(a.value, 6) AS model_a, round(b.value, 6) AS model_b,
        round(b.value - a.value, 6) AS diff_b_minus_a
        FROM wideset a FULL JOIN shortset b USING (metric)""",
    "write_drift_summary": """SELECT 'fallback' AS status,
        (SELECT avg(drift_detected::INT::DOUBLE) FROM reportrows) > 0.3 AS drift_detected,
        round((SELECT avg(drift_detected::INT::DOUBLE) FROM reportrows), 4) AS drift_share,
        r AS reference_rows, c AS current_rows, "column", drift_score,
        reportrows.drift_detected AS column_drift, method FROM reportrows, parts""",
    "persist_neighbours": """SELECT item_id, neighbour_id, round(similarity, 6) AS similarity, rank
        FROM nearest WHERE rank <= 10""",
    # projections and scalar functions
    "project_core": "SELECT user_id, item_id, rating, timestamp FROM inter",
    "liked_items": "SELECT user_id, item_id, rating FROM liked",
    "drop_null_ratings": """SELECT user_id, count(*) AS rows, round(sum(rating), 6) AS ratings
        FROM inter WHERE item_id % 7 <> 0 GROUP BY user_id""",
    "select_feature_columns": """SELECT user_id, round(avg_rating, 6) AS avg_rating, num_ratings,
        0.0::DOUBLE AS price FROM ulong""",
    "fill_missing": """SELECT user_id, round(sum(CASE WHEN rating > 2 THEN rating ELSE 0 END), 6) AS score,
        count(*) AS rows FROM inter GROUP BY user_id""",
    "log_derived_columns": """SELECT event_id, variant, len(items) AS num_items, items[1] AS top_item,
        request_hour, request_dayofweek, round(latency_ms, 6) AS latency_ms FROM preds""",
    "drift_dataset": """SELECT event_id, round(latency_ms, 6) AS latency_ms, len(items)::DOUBLE AS num_items,
        variant, request_hour::DOUBLE AS request_hour, request_dayofweek::DOUBLE AS request_dayofweek
        FROM preds""",
    "price_coerce": "SELECT item_id, round(coalesce(TRY_CAST(price AS DOUBLE), -1), 6) AS price FROM meta",
    "description_length": """SELECT item_id, length(array_to_string(description, ' '))
        AS description_length FROM meta""",
    "product_text": """SELECT item_id, coalesce(nullif(concat_ws(' ', nullif(trim(title), ''),
        nullif(array_to_string(description, ' '), ''), nullif(array_to_string(features, ' '), '')), ''),
        'unknown product') AS text FROM meta""",
    "recent_items_text": "SELECT event_id, array_to_string(items[1:5], ', ') AS items FROM preds",
    # interaction preparation
    "align_catalog": """SELECT 'reviews' AS name, count(*) AS rows FROM inter
        WHERE item_id IN (SELECT item_id FROM vectors) UNION ALL
        SELECT 'items', count(*) FROM vectors WHERE item_id IN (SELECT item_id FROM inter)""",
    "dedupe_last": "SELECT user_id, item_id, rating, timestamp FROM pairs",
    "filter_min_users": """SELECT user_id, item_id, rating, timestamp FROM pairs WHERE user_id IN (
        SELECT user_id FROM pairs GROUP BY 1 HAVING count(*) >= 40)""",
    "filter_min_items": """SELECT user_id, item_id, rating, timestamp FROM pairs WHERE item_id IN (
        SELECT item_id FROM pairs GROUP BY 1 HAVING count(*) >= 30)""",
    "preprocess": """SELECT user_id, item_id, rating, timestamp FROM (
        SELECT *, count(*) OVER (PARTITION BY item_id) AS c FROM pairs WHERE user_id IN (
          SELECT user_id FROM pairs GROUP BY 1 HAVING count(*) >= 30)) WHERE c >= 30""",
    "temporal_split": "SELECT user_id, item_id, rating, timestamp, split FROM split",
    "split_integrity": " UNION ALL ".join(
        f"""SELECT '{name}' AS data, (SELECT count(*) FROM {_late(source)}) AS violations,
        coalesce((SELECT string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) FROM (
          SELECT user_id FROM {_late(source)} ORDER BY user_id LIMIT 5)), '') AS examples"""
        for name, source in (("temporal", "split"), ("mixed", "mixed"))
    ),
    "distinct_counts_sketched": """SELECT 'user_id' AS "column", count(*) AS rows,
        count(DISTINCT user_id) AS exact, true AS near FROM clean
        UNION ALL SELECT 'item_id', count(*), count(DISTINCT item_id), true FROM clean""",
    "dataset_summary": """SELECT count(*) AS interactions, count(DISTINCT user_id) AS users,
        count(DISTINCT item_id) AS items, count(*) FILTER (split = 'train') AS train_rows,
        count(*) FILTER (split = 'test') AS test_rows FROM split""",
    "prepare_interactions": """SELECT user_id, split, count(*) AS rows, max(timestamp) AS latest
        FROM split GROUP BY user_id, split""",
    # data-quality checks
    "check_required_columns": f"""{_check('raw', 'required_columns', '0', '(SELECT 1)')} UNION ALL
        {_check('clean', 'required_columns', '0', '(SELECT 1)')}""",
    "check_nulls": " UNION ALL ".join(
        _check("", f"null_{c}", "count(*) FILTER (item_id % 7 = 0)" if c == "rating" else
               f"count(*) FILTER ({c} IS NULL)", "inter")
        for c in ("user_id", "item_id", "rating", "timestamp")
    ),
    "check_rating_range": _check(
        "", "rating_range", "count(*) FILTER (rating + 1 < 1 OR rating + 1 > 5)", "inter"
    ),
    "check_duplicate_pairs": " UNION ALL ".join(
        _check(d, "duplicate_pairs", "count(*) - count(DISTINCT (user_id, item_id))", s)
        for d, s in (("raw", "inter"), ("clean", "clean"))
    ),
    "check_timestamp_range": " UNION ALL ".join(
        _range_check(d, v)
        for d, v in (
            ("seconds", "timestamp"),
            ("milliseconds", "(timestamp * 1000)"),
            ("future", "(timestamp + 900000000)"),
            ("synthetic", "item_id"),
        )
    ),
    "check_pair_overlap": " UNION ALL ".join(
        _check(d, "pair_overlap", "count(*)", f"""(SELECT user_id, item_id FROM {s} INTERSECT
            SELECT user_id, item_id FROM test)""")
        for d, s in (("train", "train"), ("clean", "clean"))
    ),
    "check_time_leakage": " UNION ALL ".join(
        _check(d, "time_leakage", "count(*)", _late(s)) for d, s in (("temporal", "split"), ("mixed", "mixed"))
    ),
    "check_item_key": " UNION ALL ".join(
        _check(d, "item_key", "count(*) FILTER (item_id IS NULL)", s)
        for d, s in (("given", "meta"), ("holed", "holed"))
    ),
    "check_empty_titles": " UNION ALL ".join(
        _check(d, "empty_titles", "count(*) FILTER (trim(coalesce(title, '')) = '')", s, "TRUE")
        for d, s in (("given", "meta"), ("holed", "holed"))
    ),
    "check_category": " UNION ALL ".join(
        _check(d, "category", "count(*) FILTER (trim(coalesce(main_category, '')) = '')", s)
        for d, s in (("given", "meta"), ("holed", "holed"))
    ),
    "category_cardinality": "SELECT count(DISTINCT main_category) AS categories FROM meta",
    # features
    "user_features": """SELECT user_id, num_ratings, round(avg_rating, 6) AS avg_rating,
        round(rating_std, 6) AS rating_std, round(days_active, 6) AS days_active FROM ulong""",
    "item_features": f"""SELECT item_id, round(avg_rating_received, 6) AS avg_rating_received,
        num_ratings_received, round(rating_std_received, 6) AS rating_std_received,
        round(price, 6) AS price, description_length FROM {_item_table('train')}""",
    "global_mean": "SELECT round(avg(rating), 6) AS global_mean FROM train",
    "popular_items": "SELECT item_id, interactions, rank FROM popular WHERE rank <= 100",
    "id_maps": """SELECT 'item' AS kind, item_id AS id, idx AS index FROM catalogue UNION ALL
        SELECT 'user', user_id, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR)), user_id) - 1
        FROM (SELECT DISTINCT user_id FROM train)""",
    "confidence_matrix": """SELECT user_id, item_id, round(sum(rating) * 40, 6) AS confidence
        FROM inter GROUP BY user_id, item_id""",
    "score_feature_semantic": """SELECT user_id, item_id, round(coalesce(max(score), 0), 6) AS model_b_score FROM (
          SELECT user_id, item_id, NULL::DOUBLE AS score, 1 AS asked FROM split WHERE split = 'test' UNION ALL
          SELECT l.user_id, n.neighbour_id, avg(n.similarity), 0
          FROM liked l JOIN nearest n ON n.item_id = l.item_id GROUP BY l.user_id, n.neighbour_id)
        GROUP BY user_id, item_id HAVING max(asked) = 1""",
    "negative_samples": "SELECT user_id, positive_id, slot, item_id FROM negatives",
    "sample_users": """SELECT user_id FROM (SELECT DISTINCT user_id FROM train)
        ORDER BY md5(concat_ws('|', user_id, 42)), user_id LIMIT 100""",
    "class_balance": """SELECT (SELECT count(*) FROM train WHERE rating >= 4) AS positives,
        (SELECT count(*) FROM negatives) AS negatives,
        round((SELECT count(*) FROM negatives) / (SELECT count(*) FROM train WHERE rating >= 4)::DOUBLE, 6)
        AS ratio""",
    "stratified_split": """SELECT user_id, item_id, label, CASE WHEN row_number() OVER (
          PARTITION BY label ORDER BY md5(concat_ws('|', user_id, item_id, 42)), user_id, item_id)
          <= ceil(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE)
        THEN 'validation' ELSE 'train' END AS split FROM scored""",
    # retrieval
    "cold_start_fallback": """SELECT c_custkey AS user_id, p.item_id, round(m.mean, 6) AS score, p.rank
        FROM customer, (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
          FROM train WHERE user_id % 3 <> 0 GROUP BY item_id) p,
          (SELECT avg(rating) AS mean FROM train WHERE user_id % 3 <> 0) m
        WHERE p.rank <= 10 AND c_custkey NOT IN (SELECT user_id FROM train WHERE user_id % 3 <> 0)""",
    "l2_normalise": """SELECT item_id, round(sqrt(list_inner_product(u, u)), 4) AS norm,
        round(list_inner_product(u, embedding) / sqrt(list_inner_product(embedding, embedding)), 4) AS cosine
        FROM (SELECT *, list_transform(embedding, lambda x: x / sqrt(list_inner_product(embedding, embedding))) AS u
          FROM vectors)""",
    "item_neighbours": """SELECT item_id, neighbour_id, round(similarity, 6) AS similarity, rank
        FROM nearest WHERE rank <= 10""",
    "item_products_bounded": """SELECT asked_id, item_id, round(score, 6) AS score, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY asked_id ORDER BY score DESC, item_id) AS rank FROM (
          SELECT q.item_id AS asked_id, s.item_id,
            round(list_inner_product(q.embedding::DOUBLE[], s.long_vector), 9) AS score
          FROM vectors q, (
            SELECT v.item_id, list_transform(embedding::DOUBLE[], lambda x: x * ln(1 + coalesce(n, 0))) AS long_vector
            FROM vectors v LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY ALL) USING (item_id)) s))
        WHERE rank <= 10""",
    "neighbour_table": """SELECT item_id, neighbour_id, round(similarity, 6) AS similarity, rank
        FROM nearest WHERE item_id IN (SELECT item_id FROM liked)""",
    "semantic_top_n": """SELECT user_id, item_id, round(score, 6) AS score, rank
        FROM semantic WHERE rank <= 10""",
    "item_neighbours_lsh": """SELECT count(*) > 1 AS few_pairs, count(*) > 1 AS found FROM vectors""",
    "restrict_to_train_items": """SELECT item_id, title FROM meta WHERE item_id IN (
        SELECT item_id FROM train WHERE rating >= 5 GROUP BY item_id HAVING count(*) >= 5)""",
    "candidate_union": f"SELECT user_id, item_id, round(score, 6) AS score FROM {_CANDIDATES}",
    "candidate_features": f"""SELECT c.user_id, c.item_id, round(c.score, 6) AS model_a_score,
        0.0::DOUBLE AS model_b_score, coalesce(num_ratings, 0) AS num_ratings,
        round(coalesce(avg_rating, 0), 6) AS avg_rating, round(coalesce(rating_std, 0), 6) AS rating_std,
        round(coalesce(days_active, 0), 6) AS days_active,
        round(coalesce(avg_rating_received, 0), 6) AS avg_rating_received,
        coalesce(num_ratings_received, 0) AS num_ratings_received,
        round(coalesce(rating_std_received, 0), 6) AS rating_std_received,
        round(coalesce(price, 0), 6) AS price, coalesce(description_length, 0) AS description_length
        FROM {_CANDIDATES} c LEFT JOIN (
          SELECT user_id, count(rating) AS num_ratings, avg(rating) AS avg_rating,
            coalesce(stddev_samp(rating), 0) AS rating_std,
            (max(timestamp) - min(timestamp)) / 86400.0::DOUBLE AS days_active
          FROM train GROUP BY user_id) u ON u.user_id = c.user_id
        LEFT JOIN {_item_table('train')} i ON i.item_id = c.item_id""",
    # learned models: properties that any right model has
    "als_fit": """SELECT 'user' AS kind, user_id AS id, 100 AS rank, true AS sound
        FROM (SELECT DISTINCT user_id FROM train) UNION ALL
        SELECT 'item', item_id, 100, true FROM (SELECT DISTINCT item_id FROM train)""",
    "als_score_pairs": f"""SELECT user_id, CASE WHEN item_id % 2 = 0 THEN -item_id - 1 ELSE item_id END AS item_id,
        known_user AND known_item AND item_id % 2 <> 0 AS known,
        CASE WHEN NOT (known_user AND known_item AND item_id % 2 <> 0) THEN round(mean, 6) END AS mean,
        true AS fits FROM {_KNOWN_TEST}""",
    "score_feature_als": f"""SELECT user_id, item_id, known_user AND known_item AS known,
        CASE WHEN NOT (known_user AND known_item) THEN round(mean, 6) END AS mean, true AS fits
        FROM {_KNOWN_TEST}""",
    "als_top_n": f"SELECT *, true AS fits FROM ({_LISTS})",
    "rerank": _LISTS,
    "two_stage_top_n": _LISTS,
    "variant_recommendations": f"""SELECT c_custkey AS user_id, CASE WHEN
          CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50
          THEN 'B' ELSE 'A' END AS variant,
        least(10, (SELECT count(DISTINCT item_id) FROM train)) AS rows, true AS ranked, true AS sorted,
        true AS unseen FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ({_LISTS}))
        UNION ALL
        SELECT user_id, CASE WHEN
          CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50
          THEN 'B' ELSE 'A' END, rows, true, true, true FROM ({_LISTS})""",
    "text_vectors": """SELECT doc_id, 384 AS dimensions, true AS finite, true AS unit FROM documents""",
    "text_neighbours": """SELECT DISTINCT item_id, CAST(least(10, (SELECT count(*) - 1 FROM meta)) AS INTEGER)
        AS neighbours, true AS ranked, true AS sorted, true AS cosines, true AS others FROM liked""",
    "ctr_dataset": f"""SELECT p.user_id, p.item_id, p.label, true AS scored,
        round(coalesce(s.score, 0), 6) AS model_b_score, coalesce(num_ratings, 0) AS num_ratings,
        round(coalesce(avg_rating, 0), 6) AS avg_rating, round(coalesce(rating_std, 0), 6) AS rating_std,
        round(coalesce(days_active, 0), 6) AS days_active,
        round(coalesce(avg_rating_received, 0), 6) AS avg_rating_received,
        coalesce(num_ratings_received, 0) AS num_ratings_received,
        round(coalesce(rating_std_received, 0), 6) AS rating_std_received,
        round(coalesce(price, 0), 6) AS price, coalesce(description_length, 0) AS description_length
        FROM {_PAIRS} p LEFT JOIN (
          SELECT l.user_id, n.neighbour_id AS item_id, avg(n.similarity) AS score
          FROM liked l JOIN nearest n ON n.item_id = l.item_id GROUP BY ALL) s
          ON s.user_id = p.user_id AND s.item_id = p.item_id
        LEFT JOIN ulong u ON u.user_id = p.user_id
        LEFT JOIN {_item_table('train')} i ON i.item_id = p.item_id""",
    "ctr_fit": f"""SELECT CAST(sum(held) AS BIGINT) AS rows, true AS chances, 200 AS trees, true AS better
        FROM (SELECT ceil(count(*) * 0.2::DOUBLE) AS held FROM {_PAIRS} GROUP BY label)""",
    "ctr_predict": f"SELECT user_id, item_id, label, true AS chance FROM {_PAIRS}",
    "feature_importance": """SELECT unnest(['model_a_score', 'model_b_score', 'num_ratings', 'avg_rating',
        'rating_std', 'days_active', 'avg_rating_received', 'num_ratings_received',
        'rating_std_received', 'price', 'description_length']) AS feature, true AS sound""",
    "als_grid_search": """SELECT printf('als-%02d', n) AS run_id, metric, true AS sound, true AS best_wins
        FROM range(36) r(n), (SELECT metric FROM wideset UNION ALL SELECT 'rmse')""",
    "training_job": """SELECT run AS run_id, metric, true AS sound FROM (
          SELECT unnest(['model_a', 'model_b', 'model_b_minus_a']) AS run), wideset UNION ALL
        SELECT 'model_a', 'rmse', true UNION ALL
        SELECT 'cold_start', unnest(['total_test_items', 'cold_start_items', 'warm_items',
          'cold_start_interactions', 'warm_interactions', 'cold_start_ratio']), true UNION ALL
        SELECT 'pipeline', 'pipeline_' || metric, true FROM wideset UNION ALL
        SELECT 'model_c', unnest(['auc_roc', 'log_loss']), true""",
    "evaluate_two_stage": "SELECT 'pipeline' AS run_id, 'pipeline_' || metric AS metric, true AS sound FROM wideset",
    "save_models": """SELECT 'user_factors' AS part, count(DISTINCT user_id) AS rows, 100 AS least, 100 AS most,
        200 AS trees FROM train UNION ALL
        SELECT 'item_factors', count(DISTINCT item_id), 100, 100, 200 FROM train""",
    # ranking evaluation
    "precision_at_k": "SELECT user_id, round(p10, 6) AS precision_at_10 FROM scores",
    "recall_at_k": "SELECT user_id, round(r10, 6) AS recall_at_10 FROM scores",
    "ndcg_at_k": "SELECT user_id, round(n10, 6) AS ndcg_at_10 FROM scores",
    "mrr": "SELECT round(avg(rr), 6) AS mrr FROM scores",
    "evaluate_topn": "SELECT * FROM (PIVOT (SELECT metric, round(value, 6) AS value FROM wideset) "
    "ON metric IN (precision_at_5, precision_at_10, precision_at_20, recall_at_5, recall_at_10, "
    "recall_at_20, ndcg_at_5, ndcg_at_10, ndcg_at_20) USING first(value))",
    "evaluate_semantic": _list_metrics(
        "(SELECT * FROM semantic WHERE rank <= 20)", "test", (5, 10, 20)
    ),
    "rmse": "SELECT round(sqrt(avg((score - rating) ** 2)), 6) AS rmse FROM scored",
    "auc_roc": """SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * n::DOUBLE), 6) AS auc_roc
        FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r
          FROM scored), (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scored)
        GROUP BY p, n""",
    "log_loss": """SELECT round(avg(-CASE WHEN label = 1 THEN ln(q) ELSE ln(1 - q) END), 6) AS log_loss
        FROM (SELECT label, least(greatest(probability, 1e-15), 1 - 1e-15) AS q FROM scored)""",
    "compare_metric_sets": """SELECT metric, round(a.value, 6) AS model_a, round(b.value, 6) AS model_b,
        round(b.value - a.value, 6) AS diff_b_minus_a
        FROM wideset a FULL JOIN shortset b USING (metric)""",
    "cold_start_segments": f"""SELECT count(DISTINCT item_id) AS total_test_items,
        count(DISTINCT item_id) FILTER (item_id NOT IN {_KNOWN}) AS cold_start_items,
        count(DISTINCT item_id) FILTER (item_id IN {_KNOWN}) AS warm_items,
        count(*) FILTER (item_id NOT IN {_KNOWN}) AS cold_start_interactions,
        count(*) FILTER (item_id IN {_KNOWN}) AS warm_interactions,
        round(count(DISTINCT item_id) FILTER (item_id NOT IN {_KNOWN}) / count(DISTINCT item_id)::DOUBLE, 6)
        AS cold_start_ratio FROM test""",
    "cold_start_metrics": f"""SELECT 'warm' AS segment, * FROM ({_list_metrics(f'({_COLD})', _WARM, (10,))})
        UNION ALL SELECT 'cold', * FROM ({_list_metrics(f'({_COLD})', _CHILLED, (10,))})""",
    # experimentation
    "assign_variant": """SELECT c_custkey AS user_id, CASE WHEN
        CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 28
        THEN 'B' ELSE 'A' END AS variant FROM customer""",
    "route_traffic": """
        SELECT 'shadow' AS mode, c_custkey AS user_id, 'A' AS serving_variant, unnest(['A', 'B']) AS variant
        FROM customer UNION ALL
        SELECT mode, user_id, v, v FROM (
          SELECT mode, c_custkey AS user_id, CASE WHEN
            CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < share
            THEN 'B' ELSE 'A' END AS v
          FROM customer, (SELECT 'canary' AS mode, 5 AS share UNION ALL SELECT 'ab_test', 50))""",
    "variant_share": """SELECT variant, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share
        FROM preds GROUP BY variant""",
    "ab_conversion": """SELECT variant, n, clicks, round(clicks / n::DOUBLE, 6) AS conversion_rate
        FROM user_table""",
    "ab_conversion_attributed": """SELECT variant, n, clicks,
        CASE WHEN n = 0 THEN -1 ELSE round(clicks / n::DOUBLE, 6) END AS conversion_rate FROM attributed_table""",
    "attributed_feedback": "SELECT event_id, action, variant, predicted_at FROM attributed",
    "two_proportion_z": f"""SELECT segment, clicks_a, n_a, clicks_b, n_b, round(z, 4) AS z, round(p, 4) AS p
        FROM ({_tested('sides')})""",
    "experiment_readout": f"{_readout('attributed_table')} UNION ALL {_readout('user_table')}",
    "sample_size": """SELECT segment, round(b, 6) AS base_rate, 0.01::DOUBLE AS effect,
        CAST(ceil((za * sqrt(2 * b * (1 - b)) + zb * sqrt(b * (1 - b) + m * (1 - m))) ** 2 / 0.01::DOUBLE ** 2)
          AS BIGINT) AS needed_per_variant
        FROM (SELECT segment, b, least(b + 0.01::DOUBLE, 0.9999::DOUBLE) AS m FROM (
            SELECT segment, sum(clicks) / sum(n)::DOUBLE AS b FROM segments GROUP BY segment)),
          (SELECT max(z) FILTER (k = 'a') AS za, max(z) FILTER (k = 'b') AS zb FROM (
            SELECT k, t - (2.515517 + 0.802853 * t + 0.010328 * t ** 2)
              / (1 + 1.432788 * t + 0.189269 * t ** 2 + 0.001308 * t ** 3) AS z
            FROM (SELECT k, sqrt(-2 * ln(1 - p)) AS t FROM (
              SELECT 'a' AS k, 1::DOUBLE - 0.05::DOUBLE / 2 AS p UNION ALL SELECT 'b', 0.80::DOUBLE))))""",
    # monitoring
    "kpis": """SELECT (SELECT count(*) FROM preds) AS predictions,
        (SELECT round(avg(latency_ms), 6) FROM preds) AS avg_latency_ms, count(*) AS feedback_events,
        count(*) FILTER (action = 'click') AS clicks, count(*) FILTER (action = 'purchase') AS purchases,
        round(count(*) FILTER (action = 'click') / (SELECT count(*) FROM preds)::DOUBLE, 6) AS click_rate
        FROM fb""",
    "requests_per_minute": f"""SELECT strftime(date_trunc('minute', timestamp), {_STAMP}) AS minute,
        count(*) AS requests FROM preds GROUP BY 1""",
    "variant_counts": "SELECT variant, count(*) AS events FROM preds GROUP BY variant",
    "action_counts": "SELECT action, count(*) AS events FROM fb GROUP BY action",
    "feedback_hourly": f"""SELECT strftime(date_trunc('hour', logged_at), {_STAMP}) AS hour,
        action, count(*) AS events FROM fb GROUP BY ALL""",
    "feedback_hourly_wide": f"""SELECT strftime(date_trunc('hour', logged_at), {_STAMP}) AS hour,
        count(*) FILTER (action = 'click') AS click, count(*) FILTER (action = 'purchase') AS purchase,
        count(*) FILTER (action = 'ignore') AS ignore, count(*) FILTER (action = 'rate') AS rate,
        count(*) FILTER (action NOT IN ('click', 'purchase', 'ignore', 'rate') OR action IS NULL) AS other
        FROM fb GROUP BY ALL""",
    "recent_predictions": f"""SELECT strftime(timestamp, {_STAMP}) AS timestamp, user_id, variant,
        round(latency_ms, 6) AS latency_ms, array_to_string(items[1:5], ', ') AS items
        FROM preds ORDER BY preds.timestamp DESC, event_id DESC LIMIT 10""",
    "recent_feedback": f"""SELECT strftime(logged_at, {_STAMP}) AS logged_at,
        strftime(timestamp, {_STAMP}) AS timestamp, user_id, item_id, action
        FROM fb ORDER BY fb.logged_at DESC, event_id DESC LIMIT 10""",
    "event_counters": """SELECT 'recommend_total' AS counter, CASE WHEN
          CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 50 THEN 'B' ELSE 'A' END AS variant,
          CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, '' AS action, '' AS endpoint,
          count(*) AS value FROM ev GROUP BY ALL
        UNION ALL SELECT 'feedback_total', '', '', action, '', count(*) FROM fb GROUP BY ALL
        UNION ALL SELECT 'errors_total', '', '', '', '/recommend', count(*) FROM ev
          WHERE event_type = 'error' GROUP BY ALL""",
    "shared_event_counters": """SELECT 'recommend_total' AS counter, CASE WHEN
          CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 50 THEN 'B' ELSE 'A' END AS variant,
          CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, '' AS action, '' AS endpoint,
          count(*) AS value FROM ev GROUP BY ALL
        UNION ALL SELECT 'feedback_total', '', '', action, '', count(*) FROM fb GROUP BY ALL
        UNION ALL SELECT 'errors_total', '', '', '', '/recommend', count(*) FROM ev
          WHERE event_type = 'error' GROUP BY ALL""",
    "latency_histogram": _histogram("preds", "(latency_ms / 1000.0::DOUBLE)", "variant", _LATENCY),
    "score_histogram": _histogram(
        "(SELECT variant, CAST(unnest(items) AS DOUBLE) / 20.0::DOUBLE AS score FROM preds)",
        "score", "variant", _SCORE,
    ),
    # drift, alerts, promotion
    "reference_current_split": "SELECT event_id, part FROM flagged",
    "drift_numeric": """SELECT "column", round(score, 6) AS drift_score, score > 0.5 AS drift_detected,
        'normalized_mean_shift' AS method FROM shift""",
    "drift_categorical": """SELECT "column", round(score, 6) AS drift_score, score > 0.1 AS drift_detected,
        'total_variation_distance' AS method FROM variation""",
    "drift_report": """SELECT "column", drift_score, drift_detected, method,
        (SELECT avg(drift_detected::INT::DOUBLE) FROM reportrows) > 0.3 AS dataset_drift,
        round((SELECT avg(drift_detected::INT::DOUBLE) FROM reportrows), 4) AS drift_share,
        r AS reference_rows, c AS current_rows FROM reportrows, parts""",
    "drift_ks": """SELECT "column", round(distance, 6) AS distance,
        round(CASE WHEN reach < 0.04 THEN 1 ELSE least(greatest((
          SELECT sum(CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0::DOUBLE * j * j * reach))
          FROM range(1, 101) s(j)), 0), 1) END, 6) AS p_value
        FROM (SELECT "column", max(gap) AS distance,
          max(r)::DOUBLE * max(c) / (max(r) + max(c)) * max(gap) ** 2 AS reach FROM steps GROUP BY "column")""",
    "drift_chi2": """SELECT "column", round(sum(
          (o - (o + n) * r / (r + c)::DOUBLE) ** 2 / ((o + n) * r / (r + c)::DOUBLE)
          + (n - (o + n) * c / (r + c)::DOUBLE) ** 2 / ((o + n) * c / (r + c)::DOUBLE)), 6) AS statistic,
        count(*) - 1 AS degrees FROM textcounts, parts GROUP BY "column" """,
    "drift_wasserstein": """SELECT "column", round(area / greatest(spread, 0.001), 6) AS distance
        FROM (SELECT "column", sum(gap * coalesce(step, 0)) AS area FROM steps GROUP BY "column")
        JOIN (SELECT "column", stddev_pop(value) AS spread FROM longlog WHERE part = 'reference'
          GROUP BY "column") USING ("column")""",
    "drift_result_rows": """SELECT event_type, 'hour_' || h AS "column", m AS drift_score,
        m > 200 AS drift_detected, 'peak' AS method,
        count(*) FILTER (m > 200) OVER w > 12 AS dataset_drift,
        round(count(*) FILTER (m > 200) OVER w / count(*) OVER w::DOUBLE, 6) AS drift_share
        FROM (SELECT event_type, hour(ts) AS h, max(value) AS m FROM events GROUP BY ALL)
        WINDOW w AS (PARTITION BY event_type)""",
    "alert_drift": """SELECT 'drift' AS name, s > 0.3 AS triggered, round(s, 4) AS observed,
        0.3::DOUBLE AS threshold, 'share' AS unit
        FROM (SELECT avg(drift_detected::INT::DOUBLE) AS s FROM reportrows)""",
    "alert_latency": """SELECT l AS threshold, 'ms' AS unit, 'latency' AS name, m > l AS triggered,
        round(m, 6) AS observed
        FROM (SELECT avg(latency_ms) AS m FROM preds), (SELECT unnest([5.0::DOUBLE, 500.0::DOUBLE]) AS l)""",
    "alert_error_rate": """SELECT 'error_rate' AS name, m > 0.05 AS triggered, round(m, 6) AS observed,
        0.05::DOUBLE AS threshold, 'share' AS unit
        FROM (SELECT count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS m FROM events)""",
    "alerts_all": """SELECT 'drift' AS name, s > 0.3 AS triggered, round(s, 4) AS observed,
        0.3::DOUBLE AS threshold, 'share' AS unit
        FROM (SELECT avg(drift_detected::INT::DOUBLE) AS s FROM reportrows) UNION ALL
        SELECT 'latency', m > 500, round(m, 6), 500, 'ms' FROM (SELECT avg(value) AS m FROM events) UNION ALL
        SELECT 'error_rate', m > 0.05, round(m, 6), 0.05, 'share'
        FROM (SELECT count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS m FROM events)""",
    "run_metrics": """SELECT experiment, run_id, metric, round(value, 6) AS value FROM metrictable
        WHERE metric IN ('mean_price', 'spread')""",
    "metric_improvements": """SELECT experiment, metric, round(candidate, 6) AS candidate,
        round(production, 6) AS production, round(absolute_diff, 6) AS absolute_diff,
        round(relative_diff, 6) AS relative_diff, improved, significant FROM compared""",
    "promotion_decision": """SELECT experiment, common, improved, degraded, significant,
        significant > 0 AND degraded < common / 2.0::DOUBLE AS should_promote,
        CASE WHEN NOT live THEN 'promoted_to_staging'
          WHEN NOT (significant > 0 AND degraded < common / 2.0::DOUBLE) THEN 'rejected'
          WHEN significant >= 2 THEN 'promoted_to_canary' ELSE 'promoted_to_staging' END AS action,
        CASE WHEN NOT live THEN 'no_production_model'
          WHEN NOT (significant > 0 AND degraded < common / 2.0::DOUBLE) THEN 'no_significant_improvement'
          WHEN significant >= 2 THEN 'significant_improvement' ELSE 'moderate_improvement' END AS reason
        FROM (SELECT experiment, NOT starts_with(experiment, '5') AS live,
            count(*) FILTER (NOT starts_with(experiment, '5')) AS common,
            count(*) FILTER (improved AND NOT starts_with(experiment, '5')) AS improved,
            count(*) FILTER (NOT improved AND NOT starts_with(experiment, '5')) AS degraded,
            count(*) FILTER (significant AND NOT starts_with(experiment, '5')) AS significant
          FROM compared GROUP BY experiment)""",
    "canary_health": """SELECT rule, experiment,
        CASE WHEN samples < least_rows THEN 'insufficient_data'
          WHEN errors / samples::DOUBLE > limit_rate THEN 'high_error_rate' ELSE 'healthy' END AS status,
        samples, CASE WHEN samples < least_rows THEN -1 ELSE round(errors / samples::DOUBLE, 6) END AS error_rate,
        samples >= least_rows AND errors / samples::DOUBLE <= limit_rate AS proceed
        FROM canary, (SELECT 'default' AS rule, 100 AS least_rows, 0.05::DOUBLE AS limit_rate UNION ALL
          SELECT 'lenient', 100, 0.5 UNION ALL SELECT 'large', 1000000000, 0.05)""",
    "latest_deployment_state": """SELECT o_orderpriority AS experiment, o_orderstatus AS stage,
        o_orderkey AS version, CAST(epoch(o_orderdate) AS BIGINT) AS updated_at
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
          ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    "latest_version_per_stage": """SELECT o_orderpriority AS model, o_orderstatus AS stage,
        o_orderkey AS version, CAST(epoch(o_orderdate) AS BIGINT) AS updated_at
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
          ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    # streaming: every window, also those the watermark has not closed
    "stream_requests_per_minute": f"""SELECT strftime(minute, {_STAMP}) AS minute, requests FROM (
        SELECT date_trunc('minute', timestamp) AS minute, count(*) AS requests FROM preds GROUP BY 1)""",
    "stream_feedback_hourly": f"""SELECT strftime(hour, {_STAMP}) AS hour, action, events FROM (
        SELECT date_trunc('hour', logged_at) AS hour, action, count(*) AS events FROM fb GROUP BY ALL)""",
    "stream_counters": """SELECT CASE WHEN CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 50
          THEN 'B' ELSE 'A' END AS variant,
        CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, count(*) AS value
        FROM ev GROUP BY ALL""",
    "stream_latency_histogram": f"""SELECT strftime(start, {_STAMP}) AS start, * EXCLUDE (start) FROM ({
        _histogram(
            "(SELECT *, date_trunc('day', timestamp) AS start FROM preds)",
            "(latency_ms / 1000.0::DOUBLE)", "start, variant", _LATENCY,
        )})""",
    "stream_route": """SELECT event_id, CASE WHEN
        CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 100 < 5 THEN 'B' ELSE 'A' END AS serving_variant
        FROM ev""",
    "stream_attribution": "SELECT event_id, variant, predicted_at FROM attributed WHERE action = 'click'",
    "stream_alerts": f"""SELECT strftime(start, {_STAMP}) AS start, round(m, 6) AS mean_latency_ms,
        round(e, 6) AS error_rate, m > 60 AS latency_alert, e > 0.25 AS error_alert FROM (
          SELECT date_trunc('hour', ts) AS start, avg(value) AS m,
            count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS e FROM events GROUP BY 1)
        WHERE m > 60 OR e > 0.25""",
    "stream_dedup": f"""SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS rows,
        strftime(max(ts), {_STAMP}) AS latest
        FROM (SELECT DISTINCT user_id, ts FROM events) GROUP BY user_id""",
}



def _round_as_text(sql: str) -> str:
    """Round results by their decimal digits, half up, as Spark does, not by their binary value."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 0, start + len("round(") - 1
        for end in range(end, len(sql)):
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if depth == 0:
                break
        inner = sql[start + len("round("):end]
        value, digits = inner.rsplit(",", 1)
        value = _round_as_text(value)
        if digits.strip() in ("4", "5", "6"):
            call = f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {digits.strip()}) AS DOUBLE)"
        else:
            call = f"round({value},{digits})"
        out, at = out + sql[at:start] + call, end + 1
    return out + sql[at:]


def _split_views(text: str) -> dict[str, str]:
    """The shared views by name, in order."""
    text = text.strip().removeprefix("WITH")
    found, depth, quoted, start = [], 0, False, 0
    for at, sign in enumerate(text):
        quoted ^= sign == "'"
        depth += 0 if quoted else {"(": 1, ")": -1, "[": 1, "]": -1}.get(sign, 0)
        if sign == "," and not depth and not quoted:
            found.append(text[start:at].strip())
            start = at + 1
    found.append(text[start:].strip())
    return {view.split()[0]: view for view in found}


_BY_NAME = _split_views(VIEWS)


def _statement(body: str) -> str:
    """The body after the views it names, and those that they name."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        new = [name for name in _BY_NAME if name in words and name not in needed]
        needed.update(new)
        open_texts += [_BY_NAME[name] for name in new]
    views = ",\n".join(view for name, view in _BY_NAME.items() if name in needed)
    return f"WITH {views}\n{body}" if views else body


ORACLES: dict[str, str] = {name: _round_as_text(_statement(body)) for name, body in BODIES.items()}
