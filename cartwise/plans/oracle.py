"""Plain SQL for the registered queries, to check them on the same tables in another engine."""
from ..operators import boosting
from ..schemas import (EXCLUDED_CODES, FEATURE_COLUMNS, FEATURE_LABELS, METRIC_LABELS, MODEL_LABELS,
                       RFM_COLUMNS, RISK_LEVELS, SEGMENTS, SPANISH)
from . import frozen
from .registry import HOME, OVERLAP_END, OVERLAP_START


def text(value):
    return "'" + value.replace("'", "''") + "'"


def case(column, labels):
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in labels.items())
    return f"CASE {column} {whens} ELSE {column} END"


def order(column, values):
    whens = " ".join(f"WHEN {text(v)} THEN {i}" for i, v in enumerate(values, start=1))
    return f"CAST(CASE {column} {whens} ELSE 0 END AS BIGINT)"


RAW = """raw_transactions AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN l_partkey % 50 = 0 THEN 'POST' WHEN l_partkey % 50 = 1 THEN 'M'
              ELSE CAST(l_partkey AS VARCHAR) END AS stock_code,
         p_name AS description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
         CAST(o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS TIMESTAMP) AS invoice_date,
         CASE WHEN l_partkey % 50 = 2 THEN 0.0 ELSE l_extendedprice / l_quantity END AS price,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS customer_id,
         n_name AS country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""

CLEAN = f"""clean_transactions AS (
  SELECT invoice, stock_code, description, quantity, invoice_date, price,
         quantity * price AS line_total, customer_id, country
  FROM raw_transactions
  WHERE customer_id IS NOT NULL AND invoice NOT LIKE 'C%' AND quantity > 0 AND price > 0
    AND stock_code NOT IN ({", ".join(text(c) for c in EXCLUDED_CODES)}))"""

CANCELLED = """cancellations AS (
  SELECT invoice, stock_code, quantity, invoice_date, price, customer_id
  FROM raw_transactions WHERE customer_id IS NOT NULL AND invoice LIKE 'C%')"""

DATES = """reference_dates AS (
  SELECT CAST(CAST(max(invoice_date) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS data_end,
         CAST(CAST(max(invoice_date) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 90 DAY AS cutoff
  FROM clean_transactions)"""

PARTS = f"""parts AS (
  SELECT * FROM raw_transactions WHERE invoice_date < TIMESTAMP '{OVERLAP_END}'
  UNION ALL
  SELECT * FROM raw_transactions WHERE invoice_date >= TIMESTAMP '{OVERLAP_START}')"""


def features_ctes(column):
    """Features as of one of the reference dates, for all customers with a past purchase."""
    return f"""as_of AS (SELECT {column} AS moment FROM reference_dates),
past AS (SELECT c.* FROM clean_transactions c, as_of WHERE invoice_date < moment),
orders_of AS (
  SELECT customer_id, invoice, min(invoice_date) AS order_date, sum(line_total) AS order_total
  FROM past GROUP BY customer_id, invoice),
customers AS (
  SELECT customer_id, min(order_date) AS first_order, max(order_date) AS last_order,
         count(*) AS frequency, sum(order_total) AS monetary,
         count(*) FILTER (WHERE order_date >= moment - INTERVAL 90 DAY) AS recent
  FROM orders_of, as_of GROUP BY customer_id),
products AS (SELECT customer_id, count(DISTINCT stock_code) AS n FROM past GROUP BY customer_id),
cancels AS (
  SELECT customer_id, count(DISTINCT invoice) AS n
  FROM cancellations, as_of WHERE invoice_date < moment GROUP BY customer_id),
country_places AS (
  SELECT customer_id, country,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, country) AS place
  FROM past GROUP BY customer_id, country),
main_country AS (SELECT customer_id, country FROM country_places WHERE place = 1),
features AS (
  SELECT c.customer_id,
         CAST(datesub('day', last_order, moment) AS BIGINT) AS recency_days,
         frequency, monetary, monetary / frequency AS avg_order_value,
         CAST(datesub('day', first_order, moment) AS BIGINT) AS tenure_days,
         p.n AS distinct_products, CAST(recent AS DOUBLE) AS orders_last_90d,
         coalesce(x.n, 0) / CAST(frequency AS DOUBLE) AS cancel_rate,
         CAST(CASE WHEN m.country = '{HOME}' THEN 1 ELSE 0 END AS INTEGER) AS is_uk
  FROM customers c CROSS JOIN as_of
  JOIN products p ON p.customer_id = c.customer_id
  LEFT JOIN cancels x ON x.customer_id = c.customer_id
  LEFT JOIN main_country m ON m.customer_id = c.customer_id)"""


LABELLED = """later AS (
  SELECT DISTINCT customer_id FROM clean_transactions, as_of
  WHERE invoice_date >= moment AND invoice_date < moment + INTERVAL 90 DAY),
training_set AS (
  SELECT f.*, CAST(CASE WHEN l.customer_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churned
  FROM features f LEFT JOIN later l ON l.customer_id = f.customer_id
  WHERE recency_days <= 365)"""

RFM = """rfm AS (
  SELECT customer_id,
         CAST((SELECT max(CAST(invoice_date AS DATE)) FROM clean_transactions) + 1
              - max(CAST(invoice_date AS DATE)) AS INTEGER) AS recency_days,
         count(DISTINCT invoice) AS frequency, sum(line_total) AS monetary
  FROM clean_transactions GROUP BY customer_id)"""


def _z(c, means, stds):
    return f"((ln(1 + {c}) - {means[c]!r}) / {stds[c]!r})"


def _distance(centre):
    return " + ".join(f"power({_z(c, frozen.RFM_MEANS, frozen.RFM_STDS)} - ({x!r}), 2)"
                      for c, x in zip(RFM_COLUMNS, centre))


CLUSTERED = f"""distances AS (
  SELECT *, {", ".join(f"{_distance(c)} AS d{i}" for i, c in enumerate(frozen.CENTRES))} FROM rfm),
clustered AS (
  SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0
                 WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS cluster
  FROM distances),
profile AS (
  SELECT cluster, row_number() OVER (ORDER BY avg(recency_days), cluster) AS place,
         avg(monetary) AS spend FROM clustered GROUP BY cluster),
halves AS (
  SELECT cluster, place <= 2 AS active,
         row_number() OVER (PARTITION BY place <= 2 ORDER BY spend DESC, cluster) AS rank FROM profile),
names AS (
  SELECT CAST(cluster AS INTEGER) AS cluster,
         CASE WHEN active AND rank = 1 THEN 'Champions' WHEN active THEN 'Promising'
              WHEN rank = 1 THEN 'At risk' ELSE 'Lost' END AS segment FROM halves),
customer_segments AS (
  SELECT customer_id, recency_days, frequency, monetary, segment
  FROM clustered JOIN names USING (cluster))"""


def _margin(intercept, weights):
    parts = [f"({weights[c]!r}) * {_z(c, frozen.FEATURE_MEANS, frozen.FEATURE_STDS)}"
             for c in FEATURE_COLUMNS]
    return " + ".join([f"({intercept!r})", *parts])


PROBABILITY = f"1 / (1 + exp(-({_margin(frozen.INTERCEPT, frozen.WEIGHTS)})))"
SECOND = f"1 / (1 + exp(-({_margin(frozen.SECOND_INTERCEPT, frozen.SECOND_WEIGHTS)})))"

SCORED = f"scored AS (SELECT *, {PROBABILITY} AS churn_probability FROM training_set)"

SCORES = f"""banded AS (
  SELECT *, {PROBABILITY} AS churn_probability FROM features WHERE recency_days <= 365),
customer_scores AS (
  SELECT b.*, CASE WHEN churn_probability >= 0.7 THEN 'High'
                   WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level, s.segment
  FROM banded b LEFT JOIN customer_segments s ON s.customer_id = b.customer_id)"""

FOLDED = f"""folded AS (
  SELECT *, row_number() OVER (
           PARTITION BY churned ORDER BY md5('fold-42:' || CAST(customer_id AS VARCHAR))) % 5 AS fold
  FROM training_set),
both_models AS (
  SELECT 'logistic_regression' AS model, 1 AS model_order, fold, churned, {PROBABILITY} AS p FROM folded
  UNION ALL
  SELECT 'boosted_trees', 2, fold, churned, {SECOND} FROM folded),
fold_ranks AS (
  SELECT model, fold, churned, rank() OVER (PARTITION BY model, fold ORDER BY p)
         + (count(*) OVER (PARTITION BY model, fold, p) - 1) / 2.0 AS r FROM both_models),
fold_auc AS (
  SELECT model, fold,
         (sum(r) FILTER (WHERE churned = 1) - sum(churned) * (sum(churned) + 1) / 2.0)
         / (sum(churned) * sum(1 - churned)) AS auc FROM fold_ranks GROUP BY model, fold),
ranks AS (
  SELECT model, churned, p, rank() OVER (PARTITION BY model ORDER BY p)
         + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0 AS r FROM both_models),
model_auc AS (
  SELECT model, (sum(r) FILTER (WHERE churned = 1) - sum(churned) * (sum(churned) + 1) / 2.0)
         / (sum(churned) * sum(1 - churned)) AS auc FROM ranks GROUP BY model),
model_curve AS (
  SELECT model, sum(churned) AS pos, sum(sum(churned)) OVER w AS tp, sum(count(*)) OVER w AS called
  FROM both_models GROUP BY model, p
  WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
model_ap AS (SELECT model, sum(pos * tp / CAST(called AS DOUBLE)) / sum(pos) AS ap
             FROM model_curve GROUP BY model),
decisions AS (
  SELECT model, model_order,
         count(*) FILTER (WHERE p >= 0.5 AND churned = 1) AS tp,
         count(*) FILTER (WHERE p >= 0.5 AND churned = 0) AS fp,
         count(*) FILTER (WHERE p < 0.5 AND churned = 1) AS fn
  FROM both_models GROUP BY model, model_order),
wide AS (
  SELECT d.model, model_order,
         (SELECT avg(auc) FROM fold_auc f WHERE f.model = d.model) AS cv_roc_auc,
         (SELECT auc FROM model_auc a WHERE a.model = d.model) AS test_roc_auc,
         (SELECT ap FROM model_ap a WHERE a.model = d.model) AS test_pr_auc,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS test_precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS test_recall,
         CASE WHEN tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS test_f1
  FROM decisions d),
best AS (SELECT model FROM wide ORDER BY cv_roc_auc DESC, model_order LIMIT 1),
metrics_long AS (
  {" UNION ALL ".join(
      f"SELECT {case('model', MODEL_LABELS)} AS model, {text(label)} AS metric, "
      f"CAST({i} AS INTEGER) AS metric_order, {key} AS value, "
      f"CAST(model = (SELECT model FROM best) AS INTEGER) AS is_selected FROM wide"
      for i, (key, label) in enumerate(METRIC_LABELS.items(), start=1))})"""

CONFUSION = """confusion AS (
  SELECT CASE WHEN churned = 0 THEN 'Stayed' ELSE 'Churned' END AS actual,
         CASE WHEN churn_probability >= 0.5 THEN 'Predicted churn' ELSE 'Predicted stay' END AS predicted,
         count(*) AS customers, CAST(churned + 1 AS INTEGER) AS actual_order,
         CAST(CASE WHEN churn_probability >= 0.5 THEN 2 ELSE 1 END AS INTEGER) AS predicted_order
  FROM scored GROUP BY ALL)"""


def _phi(c):
    return f"({frozen.WEIGHTS[c]!r}) * {_z(c, frozen.FEATURE_MEANS, frozen.FEATURE_STDS)}"


ATTRIBUTION = "attribution AS (" + " UNION ALL ".join(
    f"SELECT customer_id, {text(c)} AS feature, CAST({c} AS DOUBLE) AS value, {_phi(c)} AS phi "
    f"FROM features WHERE recency_days <= 365" for c in FEATURE_COLUMNS) + ")"


def _tree_phi(feature):
    """Two-feature leaves: value * (own outcome - own share) * mean of the other's share and outcome."""
    def inside(c, low, high):
        tests = ([f"{c} > {low!r}"] if low is not None else []) + (
            [f"{c} <= {high!r}"] if high is not None else [])
        return f"(CASE WHEN {' AND '.join(tests)} THEN 1.0 ELSE 0.0 END)"

    terms = ["0.0"]
    for value, path in frozen.TREE_LEAVES:
        if feature in path:
            (other, (low, high, share)), = [(c, w) for c, w in path.items() if c != feature]
            own_low, own_high, own_share = path[feature]
            terms.append(f"CAST({value!r} AS DOUBLE) * ({inside(feature, own_low, own_high)} - {own_share!r})"
                         f" * ({share!r} + {inside(other, low, high)}) / 2")
    return " + ".join(terms)


TREE_ATTRIBUTION = " UNION ALL ".join(
    f"SELECT customer_id, {text(c)} AS feature, round(CAST({c} AS DOUBLE), 6) AS value, "
    f"round(CAST({_tree_phi(c)} AS DOUBLE), 6) AS phi FROM features WHERE recency_days <= 365"
    for c in FEATURE_COLUMNS)

REQUESTS = """requests AS (
  SELECT customer_id,
         CASE WHEN customer_id % 7 = 0 THEN -1.0 ELSE CAST(recency_days AS DOUBLE) END AS recency_days,
         CASE WHEN customer_id % 11 = 0 THEN NULL ELSE CAST(frequency AS DOUBLE) END AS frequency,
         monetary, avg_order_value, tenure_days, distinct_products, orders_last_90d, cancel_rate, is_uk
  FROM features),
valid AS (SELECT * FROM requests WHERE recency_days >= 0 AND frequency >= 1)"""

_FEATURES_OUT = """customer_id, recency_days, frequency, round(monetary, 2) AS monetary,
  round(avg_order_value, 6) AS avg_order_value, tenure_days, distinct_products, orders_last_90d,
  round(cancel_rate, 6) AS cancel_rate, is_uk"""

_DIGITS = {"monetary": 2, "avg_order_value": 6, "cancel_rate": 6}
_DOUBLES_OUT = "customer_id, " + ", ".join(
    f"round(CAST({c} AS DOUBLE), {_DIGITS[c]}) AS {c}" if c in _DIGITS else f"CAST({c} AS DOUBLE) AS {c}"
    for c in FEATURE_COLUMNS)

BASE = [RAW, CLEAN, CANCELLED]
AT_CUTOFF = [*BASE, DATES, features_ctes("cutoff")]
AT_END = [*BASE, DATES, features_ctes("data_end")]
SEGMENTED = [*BASE, RFM, CLUSTERED]
TRAINING = [*AT_CUTOFF, LABELLED]
SCORED_TRAINING = [*TRAINING, SCORED]
CURRENT_SCORES = [*AT_END, RFM, CLUSTERED, SCORES]
COMPARED = [*TRAINING, FOLDED]

_REPORTED = f"""reported AS (
  SELECT *, {order('segment', SEGMENTS)} AS segment_order, {order('risk_level', RISK_LEVELS)} AS risk_order,
         floor(churn_probability * 10) / 10.0 AS probability_band,
         {case('segment', SPANISH['segment'])} AS segment_es,
         {case('risk_level', SPANISH['risk_level'])} AS risk_level_es
  FROM customer_scores)"""
_REPORTED_SEGMENTS = (f"reported AS (SELECT *, {order('segment', SEGMENTS)} AS segment_order "
                      "FROM customer_segments)")
_ROC = """SELECT round((sum(r) FILTER (WHERE churned = 1) - sum(churned) * (sum(churned) + 1) / 2.0)
  / (sum(churned) * sum(1 - churned)), 6) AS roc_auc
FROM (SELECT churned, rank() OVER (ORDER BY churn_probability)
        + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2.0 AS r FROM scored)"""
_AP = """SELECT round(sum(pos * tp / CAST(called AS DOUBLE)) / sum(pos), 6) AS average_precision
FROM (SELECT sum(churned) AS pos, sum(sum(churned)) OVER w AS tp, sum(count(*)) OVER w AS called
      FROM scored GROUP BY churn_probability
      WINDOW w AS (ORDER BY churn_probability DESC ROWS UNBOUNDED PRECEDING))"""
SPLIT = """classes AS (
  SELECT churned, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM training_set GROUP BY churned),
shared AS (
  SELECT *, total - CAST(ceil(0.2 * total) AS BIGINT) AS train FROM classes),
whole AS (
  SELECT *, train * n // total AS floor_size,
         row_number() OVER (ORDER BY train * n % total DESC, churned) AS rank FROM shared),
split AS (
  SELECT churned, n - floor_size - CASE WHEN rank <= train - sum(floor_size) OVER () THEN 1 ELSE 0 END AS test_size
  FROM whole),
placed AS (
  SELECT t.customer_id, t.churned, test_size, row_number() OVER (
           PARTITION BY t.churned ORDER BY md5('42:' || CAST(customer_id AS VARCHAR))) AS place
  FROM training_set t JOIN split s ON s.churned = t.churned)"""
_PREDICT = f"""SELECT customer_id, round_even(p, 4) AS churn_probability, p >= 0.5 AS will_churn
FROM (SELECT customer_id, {PROBABILITY} AS p FROM valid)"""
_PHI_OUT = "customer_id, feature, round(value, 6) AS value, round(phi, 6) AS phi"
_IMPORTANCE = "SELECT feature, avg(abs(phi)) AS m FROM attribution GROUP BY feature"
_SEGMENT_TOTALS = "(SELECT count(*) FROM customer_segments)", "(SELECT sum(monetary) FROM customer_segments)"


_POINTS = (f"points AS (SELECT customer_id, " + ", ".join(
    f"{_z(c, frozen.RFM_MEANS, frozen.RFM_STDS)} AS {c}" for c in RFM_COLUMNS) + " FROM rfm)")


def _squared(a, b):
    return " + ".join(f"power({a}.{c} - {b}.{c}, 2)" for c in RFM_COLUMNS)


ASSIGNED = """centres AS (SELECT * FROM (VALUES {values}) v(k, cluster, {columns})),
assigned AS (
  SELECT c.k, c.cluster, p.*, {squared} AS near FROM points p CROSS JOIN centres c
  QUALIFY row_number() OVER (PARTITION BY c.k, p.customer_id ORDER BY near, c.cluster) = 1)""".format(
    values=", ".join(f"({k}, {i}, {', '.join(f'{x!r}::DOUBLE' for x in frozen.CENTRES[i])})"
                     for k in (2, 3, 4) for i in range(k)),
    columns=", ".join(RFM_COLUMNS), squared=_squared("p", "c"))

_STEP = """SELECT c.k, c.cluster, count(a.customer_id) AS customers, {means},
  (SELECT round(sum(near), 3) FROM assigned b WHERE b.k = c.k) AS cost
FROM centres c LEFT JOIN assigned a ON a.k = c.k AND a.cluster = c.cluster
GROUP BY c.k, c.cluster""".format(means=", ".join(
    f"round(coalesce(avg(a.{c}), any_value(c.{c})), 5) AS {c}" for c in RFM_COLUMNS))

_SILHOUETTE = f"""SELECT k, round(avg(CASE WHEN inside IS NULL OR outside IS NULL THEN 0
    WHEN greatest(inside, outside) = 0 THEN 0 ELSE (outside - inside) / greatest(inside, outside) END), 2)
  AS silhouette, true AS close
FROM (
  SELECT k, customer_id, max(total / nullif(n - 1, 0)) FILTER (own) AS inside, min(total / n) FILTER (NOT own) AS outside
  FROM (SELECT a.k, a.customer_id, a.cluster = b.cluster AS own, count(*) AS n,
               sum(sqrt({_squared("a", "b")})) AS total
        FROM assigned a JOIN assigned b ON a.k = b.k GROUP BY a.k, a.customer_id, a.cluster, b.cluster)
  GROUP BY k, customer_id)
GROUP BY k"""


def boosting_round():
    """(ctes, body): one tree over training_set with the draws of the first round, level by level."""
    settings = boosting.Settings(rounds=1)
    draws = boosting.Draws(settings, len(FEATURE_COLUMNS))
    (chosen, a, b), = draws.rounds
    columns = [FEATURE_COLUMNS[i] for i in chosen]
    steps = ", ".join(repr(i / settings.bins) for i in range(1, settings.bins))
    unit = f"{1 << boosting.UNIT_BITS}.0::DOUBLE"
    ctes = [
        "edges AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS cut FROM ("
        + " UNION ".join(f"SELECT {text(c)} AS feature, {i} AS place, "
                         f"unnest(quantile_disc({c}::DOUBLE, [{steps}])) AS edge FROM training_set"
                         for i, c in enumerate(columns)) + "))",
        "share AS (SELECT 1 / (1 + exp(-ln(sum(churned) / (count(*) - sum(churned))))) AS p FROM training_set)",
        f"""n0 AS (SELECT t.*, 0 AS node, round((p - churned) * {unit})::BIGINT AS g,
          round(p * (1 - p) * {unit})::BIGINT AS h FROM training_set t, share
          WHERE ({a} * (('0x' || substr(md5(customer_id::VARCHAR), 1, 8))::BIGINT % {boosting.PRIME}) + {b})
                % {boosting.PRIME} < {draws.below})"""]
    out = []
    for level in range(settings.depth + 1):
        ctes.append(f"t{level} AS (SELECT node, sum(g) AS g, sum(h) AS h FROM n{level} GROUP BY node)")
        out.append(f"SELECT t.node, b.feature, b.edge, b.gain, t.g / {unit} AS g, t.h / {unit} AS h FROM t{level} t "
                   + (f"LEFT JOIN b{level} b ON b.node = t.node" if level < settings.depth else
                      "LEFT JOIN (SELECT NULL::VARCHAR AS feature, NULL::DOUBLE AS edge, NULL::DOUBLE AS gain) b ON true"))
        if level == settings.depth:
            break
        values = " UNION ALL ".join(f"SELECT node, {text(c)} AS feature, {c}::DOUBLE AS x, g, h FROM n{level}"
                                    for c in columns)
        ctes += [
            f"""c{level} AS (SELECT node, feature, place, cut, edge,
                sum(CASE WHEN x <= edge THEN g ELSE 0 END) AS gl, sum(CASE WHEN x <= edge THEN h ELSE 0 END) AS hl
                FROM ({values}) JOIN edges USING (feature) GROUP BY ALL)""",
            f"""s{level} AS (SELECT c.node, feature, place, cut, edge, gl / {unit} AS gl, hl / {unit} AS hl,
                (t.g - gl) / {unit} AS gr, (t.h - hl) / {unit} AS hr, t.g / {unit} AS g, t.h / {unit} AS h
                FROM c{level} c JOIN t{level} t ON t.node = c.node)""",
            f"""b{level} AS (SELECT * FROM (
                  SELECT *, gl * gl / (hl + {settings.penalty}) + gr * gr / (hr + {settings.penalty})
                            - g * g / (h + {settings.penalty}) AS gain
                  FROM s{level} WHERE hl >= {settings.least_weight} AND hr >= {settings.least_weight}
                  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, cut) = 1)
                WHERE gain > 1e-6)""",
            f"""n{level + 1} AS (SELECT n.* REPLACE (2 * n.node + 1 + CASE WHEN CASE b.feature
                {" ".join(f"WHEN {text(c)} THEN n.{c}::DOUBLE" for c in columns)} END <= b.edge THEN 0 ELSE 1 END
                AS node) FROM n{level} n JOIN b{level} b ON b.node = n.node)"""]
    body = f"""SELECT node::INTEGER AS node, feature, round(edge, 4) AS threshold,
      round(-g / (h + {settings.penalty}) * {settings.rate}, 7) AS value, round(h, 4) AS cover,
      round(coalesce(gain, 0), 4) AS gain FROM ({" UNION ALL ".join(out)})"""
    return [*TRAINING, *ctes], body


_EXACT = "round(CAST(sum(CAST({} AS DECIMAL(28,6))) AS DOUBLE), 2)"


def _tenths(value):
    """Half-even rounding to one digit in decimal arithmetic: 0.25 -> 0.2, 0.35 -> 0.4.

    round_even works on the binary value, where 0.55 need not be a half.
    """
    x = f"{value} * 10"
    return (f"CAST(CASE WHEN {x} - floor({x}) = 0.5 THEN (CAST(floor({x}) AS BIGINT) + 1) // 2 * 2 "
            f"ELSE CAST(round({x}, 0) AS BIGINT) END AS DOUBLE) / 10")


def _query(ctes, body):
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _scaled(c):
    return (f"round((ln(1 + {c}) - avg(ln(1 + {c})) OVER ()) / stddev_pop(ln(1 + {c})) OVER (), 6) "
            f"AS {c}_scaled")


ORACLE = {name: _query(ctes, body) for name, (ctes, body) in {
    "raw_transactions": ([RAW], "SELECT * FROM raw_transactions"),
    "clean_transactions": (BASE, "SELECT * FROM clean_transactions"),
    "cancellations": (BASE, "SELECT * FROM cancellations"),
    "read_transactions_csv": ([RAW], "SELECT * FROM raw_transactions"),
    "read_quoted_breaks": ([RAW], """SELECT * REPLACE ('a "b",' || chr(10) || description || chr(10) || chr(10) || ',"'
      AS description) FROM raw_transactions"""),
    "read_parts": ([RAW, PARTS], "SELECT DISTINCT * FROM parts"),
    "base_table": ([RAW], "SELECT * FROM raw_transactions"),
    "two_way_table": ([RAW], "SELECT * FROM raw_transactions"),
    "append_base_table": ([RAW, PARTS], "SELECT * FROM parts"),
    "published_table": (TRAINING, f"SELECT {_FEATURES_OUT}, churned FROM training_set"),
    "read_features": (AT_END, f"SELECT {_DOUBLES_OUT} FROM features"),
    "sql_views": (BASE, """SELECT country, count(*) AS lines, count(DISTINCT customer_id) AS customers
      FROM clean_transactions WHERE customer_id IN (SELECT customer_id FROM cancellations)
      GROUP BY country"""),
    "merge_parts": ([RAW, PARTS], "SELECT DISTINCT * FROM parts"),
    "append_overlapping": ([RAW, PARTS], "SELECT DISTINCT * FROM parts"),
    "duplicates_removed": ([RAW, PARTS], """SELECT (SELECT count(*) FROM parts) AS rows_before,
      (SELECT count(*) FROM (SELECT DISTINCT * FROM parts)) AS rows_after,
      (SELECT count(*) FROM parts) - (SELECT count(*) FROM (SELECT DISTINCT * FROM parts)) AS rows_removed"""),
    "fractional_ids": ([RAW], """SELECT invoice, customer_id / 2.0::DOUBLE AS customer_id
      FROM raw_transactions WHERE customer_id % 2 = 1"""),
    "clean_row_count": (BASE, "SELECT count(*) AS rows FROM clean_transactions"),
    "cleaning_summary": (BASE, """SELECT (SELECT count(*) FROM raw_transactions) AS raw_rows,
      (SELECT count(*) FROM clean_transactions) AS clean_rows,
      (SELECT count(*) FROM raw_transactions WHERE customer_id IS NULL) AS rows_without_customer,
      (SELECT count(DISTINCT customer_id) FROM clean_transactions) AS customers"""),
    "cancelled_invoice_share": ([RAW], """SELECT round(100.0::DOUBLE * count(DISTINCT invoice)
      FILTER (WHERE invoice LIKE 'C%') / count(DISTINCT invoice), 2) AS pct_cancelled_invoices
      FROM raw_transactions"""),
    "monthly_revenue": (BASE, """SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
      CAST(round(sum(CAST(line_total AS DECIMAL(28,6))), 0) AS DOUBLE) AS revenue,
      count(DISTINCT customer_id) AS active_customers, count(DISTINCT invoice) AS orders
      FROM clean_transactions GROUP BY 1 ORDER BY 1"""),
    "sales_rollup": (BASE, f"""SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, country,
      count(DISTINCT customer_id) AS customers, count(DISTINCT invoice) AS orders, {_EXACT.format("line_total")} AS revenue
      FROM clean_transactions GROUP BY 1, 2"""),
    "rolling_sales": (BASE, f"""SELECT CAST(date_trunc('month', invoice_date) + to_months(later) AS DATE) AS until,
      count(DISTINCT customer_id) AS customers, count(DISTINCT invoice) AS orders, {_EXACT.format("line_total")} AS revenue
      FROM clean_transactions, (VALUES (0), (1), (2)) l(later)
      WHERE date_trunc('month', invoice_date) + to_months(later)
            <= (SELECT date_trunc('month', max(invoice_date)) FROM clean_transactions) GROUP BY 1"""),
    "monthly_revenue_exact": (BASE, """SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month,
      CAST(sum(CAST(line_total AS DECIMAL(28,6))) AS DOUBLE) AS revenue,
      count(DISTINCT customer_id) AS active_customers, count(DISTINCT invoice) AS orders
      FROM clean_transactions GROUP BY 1"""),
    "no_leakage": (AT_CUTOFF, f"SELECT {_FEATURES_OUT} FROM features WHERE false"),
    "top_countries": (BASE, """SELECT country, count(DISTINCT customer_id) AS customers,
      CAST(round(sum(CAST(line_total AS DECIMAL(28,6))), 0) AS DOUBLE) AS revenue
      FROM clean_transactions GROUP BY country ORDER BY revenue DESC, country LIMIT 10"""),
    "country_revenue_share": (BASE, """SELECT country, count(DISTINCT customer_id) AS customers,
      round(sum(line_total), 2) AS revenue,
      round(sum(line_total) / (SELECT sum(line_total) FROM clean_transactions), 6) AS revenue_share
      FROM clean_transactions GROUP BY country ORDER BY sum(line_total) DESC, country LIMIT 10"""),
    "top_products": (BASE, """SELECT stock_code, max(description) AS description,
      CAST(sum(quantity) AS BIGINT) AS units
      FROM clean_transactions GROUP BY stock_code ORDER BY units DESC, stock_code LIMIT 10"""),
    "order_count_distribution": (BASE, """SELECT orders, count(*) AS customers
      FROM (SELECT customer_id, count(DISTINCT invoice) AS orders FROM clean_transactions GROUP BY 1)
      GROUP BY orders ORDER BY orders LIMIT 15"""),
    "order_count_clipped": (BASE, """SELECT orders, count(*) AS customers,
      CASE WHEN orders < 10 THEN CAST(orders AS VARCHAR) ELSE '10+' END AS label
      FROM (SELECT customer_id, least(count(DISTINCT invoice), 10) AS orders
            FROM clean_transactions GROUP BY 1) GROUP BY orders ORDER BY orders"""),
    "single_order_share": (BASE, """SELECT round(avg(CASE WHEN orders = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
      AS single_order_share
      FROM (SELECT customer_id, count(DISTINCT invoice) AS orders FROM clean_transactions GROUP BY 1)"""),
    "reference_dates": ([*BASE, DATES], "SELECT data_end, cutoff FROM reference_dates"),
    "order_rollup": (AT_CUTOFF, """SELECT customer_id, invoice, order_date,
      round(order_total, 2) AS order_total FROM orders_of"""),
    "main_country": (AT_CUTOFF, "SELECT customer_id, country FROM main_country"),
    "distinct_products": (AT_CUTOFF, "SELECT customer_id, n AS distinct_products FROM products"),
    "cancelled_orders": (AT_CUTOFF, "SELECT customer_id, n AS cancelled_orders FROM cancels"),
    "customer_features": (AT_CUTOFF, f"SELECT {_FEATURES_OUT} FROM features"),
    "features_by_batch": (AT_CUTOFF, f"SELECT {_FEATURES_OUT} FROM features"),
    "churn_labels": ([*AT_CUTOFF, LABELLED], """SELECT f.customer_id,
      CAST(CASE WHEN l.customer_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churned
      FROM features f LEFT JOIN later l ON l.customer_id = f.customer_id"""),
    "kmeans_step": ([*BASE, RFM, _POINTS, ASSIGNED], _STEP),
    "silhouette": ([*BASE, RFM, _POINTS, ASSIGNED], _SILHOUETTE),
    "boosting_round": boosting_round(),
    "training_set": (TRAINING, f"SELECT {_FEATURES_OUT}, churned FROM training_set"),
    "churn_rate": (TRAINING, """SELECT count(*) AS customers, round(avg(churned), 6) AS churn_rate
      FROM training_set"""),
    "rfm": ([*BASE, RFM], """SELECT customer_id, recency_days, frequency, round(monetary, 2) AS monetary
      FROM rfm"""),
    "scaled_rfm": ([*BASE, RFM], f"""SELECT customer_id, {", ".join(_scaled(c) for c in RFM_COLUMNS)}
      FROM rfm"""),
    "segment_assignment_frozen": (SEGMENTED, """SELECT customer_id, recency_days, frequency,
      round(monetary, 2) AS monetary, segment FROM customer_segments"""),
    "name_segments": (SEGMENTED, "SELECT cluster, segment FROM names"),
    "segment_summary": (SEGMENTED, f"""SELECT *, round_even(total_revenue / sum(total_revenue) OVER (), 3)
      AS revenue_share
      FROM (SELECT segment, count(*) AS customers,
                   round_even(avg(recency_days), 1) AS avg_recency_days,
                   round_even(avg(frequency), 1) AS avg_frequency,
                   round_even(avg(monetary), 1) AS avg_monetary,
                   {_tenths('sum(CAST(monetary AS DECIMAL(28,6)))')} AS total_revenue
            FROM customer_segments GROUP BY segment) ORDER BY avg_monetary DESC"""),
    "segment_shares": (SEGMENTED, """SELECT segment, customers, round(revenue, 2) AS revenue,
      round(customers / CAST(sum(customers) OVER () AS DOUBLE), 6) AS customer_share,
      round(revenue / sum(revenue) OVER (), 6) AS revenue_share
      FROM (SELECT segment, count(*) AS customers, sum(monetary) AS revenue
            FROM customer_segments GROUP BY segment)"""),
    "duplicated_customers": (SEGMENTED, """SELECT customer_id, count(*) AS count FROM customer_segments
      GROUP BY customer_id HAVING count(*) > 1"""),
    "repeated_customers": (SEGMENTED, """SELECT customer_id, CAST(2 AS BIGINT) AS count
      FROM customer_segments WHERE segment = 'Champions'"""),
    "stratified_split": ([*TRAINING, SPLIT], """SELECT customer_id, churned FROM placed
      WHERE place <= test_size"""),
    "split_sizes": ([*TRAINING, SPLIT], """SELECT CASE WHEN place <= test_size THEN 'test' ELSE 'train' END AS part,
      churned, count(*) AS customers FROM placed GROUP BY ALL"""),
    "stratified_folds": (COMPARED, "SELECT customer_id, churned, CAST(fold AS INTEGER) AS fold FROM folded"),
    "frozen_scores": (SCORED_TRAINING, """SELECT customer_id, churned,
      round(churn_probability, 6) AS churn_probability FROM scored"""),
    "roc_auc": (SCORED_TRAINING, _ROC),
    "average_precision": (SCORED_TRAINING, _AP),
    "threshold_metrics": (SCORED_TRAINING, """SELECT round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
      round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
      round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1
      FROM (SELECT count(*) FILTER (WHERE churn_probability >= 0.5 AND churned = 1) AS tp,
                   count(*) FILTER (WHERE churn_probability >= 0.5 AND churned = 0) AS fp,
                   count(*) FILTER (WHERE churn_probability < 0.5 AND churned = 1) AS fn FROM scored)"""),
    "confusion_matrix": ([*SCORED_TRAINING, CONFUSION], "SELECT * FROM confusion"),
    "metrics_long": (COMPARED, """SELECT model, metric, metric_order, round(value, 6) AS value, is_selected
      FROM metrics_long"""),
    "best_model": (COMPARED, "SELECT model FROM best"),
    "linear_attribution": ([*AT_END, ATTRIBUTION], f"SELECT {_PHI_OUT} FROM attribution"),
    "feature_importance": ([*AT_END, ATTRIBUTION], f"""SELECT feature, round(m, 6) AS mean_abs_shap,
      {case('feature', FEATURE_LABELS)} AS feature_label FROM ({_IMPORTANCE})"""),
    "riskiest_customer": (CURRENT_SCORES, """SELECT customer_id, round(churn_probability, 6) AS churn_probability,
      risk_level, segment FROM customer_scores
      ORDER BY churn_probability DESC, customer_id LIMIT 1"""),
    "riskiest_explained": ([*CURRENT_SCORES, ATTRIBUTION], """SELECT t.customer_id,
      round(t.churn_probability, 6) AS churn_probability, feature, round(value, 6) AS value, round(phi, 6) AS phi
      FROM (SELECT * FROM customer_scores ORDER BY churn_probability DESC, customer_id LIMIT 1) t
      JOIN attribution a ON a.customer_id = t.customer_id"""),
    "frozen_tree_attribution": (AT_END, TREE_ATTRIBUTION),
    "score_customers": (CURRENT_SCORES, f"""SELECT {_FEATURES_OUT},
      round(churn_probability, 6) AS churn_probability, risk_level, segment FROM customer_scores"""),
    "segment_risk_matrix": (CURRENT_SCORES, """SELECT segment,
      count(*) FILTER (WHERE risk_level = 'High') AS "High",
      count(*) FILTER (WHERE risk_level = 'Medium') AS "Medium",
      count(*) FILTER (WHERE risk_level = 'Low') AS "Low"
      FROM customer_scores WHERE segment IS NOT NULL GROUP BY segment"""),
    "validated_features": ([*AT_END, REQUESTS], f"SELECT {_DOUBLES_OUT} FROM valid"),
    "rejected_features": ([*AT_END, REQUESTS], """SELECT customer_id, concat_ws(',',
      CASE WHEN recency_days < 0 THEN 'recency_days' END, CASE WHEN frequency IS NULL THEN 'frequency' END)
      AS violations FROM requests WHERE recency_days < 0 OR frequency IS NULL"""),
    "predict_batch": ([*AT_END, REQUESTS], _PREDICT),
    "predict_stream": ([*AT_END, REQUESTS], _PREDICT),
    "stream_both": ([*AT_END, REQUESTS], f"""SELECT *, NULL::VARCHAR AS violations FROM ({_PREDICT})
      UNION ALL SELECT customer_id, NULL::DOUBLE, NULL::BOOLEAN, concat_ws(',',
      CASE WHEN recency_days < 0 THEN 'recency_days' END, CASE WHEN frequency IS NULL THEN 'frequency' END)
      FROM requests WHERE recency_days < 0 OR frequency IS NULL"""),
    "segment_kpis": (SEGMENTED, """SELECT count(*) AS customers, round(sum(monetary), 2) AS revenue,
      round(avg(monetary), 4) AS avg_spend, round(avg(frequency), 4) AS avg_orders FROM customer_segments"""),
    "shares_by_segment": ([*SEGMENTED, _REPORTED_SEGMENTS], f"""SELECT segment_order, segment,
      round(count(*) / CAST({_SEGMENT_TOTALS[0]} AS DOUBLE), 6) AS customer_share,
      round(sum(monetary) / {_SEGMENT_TOTALS[1]}, 6) AS revenue_share FROM reported GROUP BY ALL"""),
    "segment_profile": ([*SEGMENTED, _REPORTED_SEGMENTS], f"""SELECT segment_order, segment,
      count(*) AS customers, round(avg(recency_days), 4) AS avg_days_since_last_order,
      round(avg(frequency), 4) AS avg_orders, round(avg(monetary), 4) AS avg_spend,
      round(sum(monetary) / {_SEGMENT_TOTALS[1]}, 4) AS revenue_share FROM reported GROUP BY ALL"""),
    "sliced_segment_measures": (SEGMENTED, f"""SELECT count(*) AS customers,
      round(count(*) / CAST({_SEGMENT_TOTALS[0]} AS DOUBLE), 6) AS customer_share,
      round(sum(monetary) / {_SEGMENT_TOTALS[1]}, 6) AS revenue_share
      FROM customer_segments WHERE segment IN ('Champions', 'Lost')"""),
    "spend_scatter": (SEGMENTED, """SELECT customer_id, segment, CAST(sum(recency_days) AS BIGINT) AS recency_days,
      round(sum(monetary), 2) AS monetary, round(log10(sum(monetary)), 6) AS log_monetary
      FROM customer_segments GROUP BY customer_id, segment"""),
    "risk_kpis": (CURRENT_SCORES, """SELECT count(*) AS customers_scored,
      count(*) FILTER (WHERE risk_level = 'High') AS high_risk_customers,
      round(count(*) FILTER (WHERE risk_level = 'High') / CAST(count(*) AS DOUBLE), 6) AS high_risk_share,
      round(sum(monetary) FILTER (WHERE risk_level = 'High'), 2) AS revenue_at_risk FROM customer_scores"""),
    "risk_cube": (CURRENT_SCORES, f"""SELECT segment, risk_level, probability_band,
      GROUPING(segment, risk_level, probability_band) AS level, count(*) AS customers,
      {_EXACT.format("monetary")} AS revenue, round(avg(churn_probability), 6) AS avg_churn_probability
      FROM (SELECT *, floor(churn_probability * 10) / 10.0 AS probability_band FROM customer_scores)
      GROUP BY CUBE (segment, risk_level, probability_band)"""),
    "cube_slices": (CURRENT_SCORES, f"""SELECT segment,
      count(*) FILTER (WHERE risk_level IN ('Low', 'High')) AS customers_scored,
      count(*) FILTER (WHERE risk_level = 'High') AS high_risk_customers,
      round(count(*) FILTER (WHERE risk_level = 'High')
        / CAST(count(*) FILTER (WHERE risk_level IN ('Low', 'High')) AS DOUBLE), 6) AS high_risk_share,
      {_EXACT.format("CASE WHEN risk_level = 'High' THEN monetary END")} AS revenue_at_risk,
      round(avg(churn_probability) FILTER (WHERE risk_level IN ('Low', 'High')), 6) AS avg_churn_probability
      FROM customer_scores WHERE segment IN ('Champions', 'Promising', 'Lost') GROUP BY segment"""),
    "sliced_risk_kpis": (CURRENT_SCORES, """SELECT
      count(*) FILTER (WHERE risk_level IN ('Low', 'Medium')) AS customers_scored,
      count(*) FILTER (WHERE risk_level = 'High') AS high_risk_customers,
      round(count(*) FILTER (WHERE risk_level = 'High')
        / CAST(count(*) FILTER (WHERE risk_level IN ('Low', 'Medium')) AS DOUBLE), 6) AS high_risk_share,
      round(sum(monetary) FILTER (WHERE risk_level = 'High'), 2) AS revenue_at_risk,
      round(avg(churn_probability) FILTER (WHERE risk_level IN ('Low', 'Medium')), 6) AS avg_churn_probability
      FROM customer_scores WHERE segment IN ('Champions', 'Promising')"""),
    "customers_by_segment_and_risk": ([*CURRENT_SCORES, _REPORTED], """SELECT segment_order, risk_order,
      segment, risk_level, count(*) AS customers FROM reported GROUP BY ALL"""),
    "avg_probability_by_segment": ([*CURRENT_SCORES, _REPORTED], """SELECT segment_order, segment,
      round(avg(churn_probability), 6) AS avg_churn_probability FROM reported GROUP BY ALL"""),
    "probability_bands": ([*CURRENT_SCORES, _REPORTED], """SELECT probability_band, risk_order, risk_level,
      count(*) AS customers FROM reported GROUP BY ALL"""),
    "action_list": (CURRENT_SCORES, """SELECT customer_id, segment,
      round(churn_probability, 6) AS churn_probability, recency_days, frequency,
      round(monetary, 2) AS monetary, round(avg_order_value, 6) AS avg_order_value, tenure_days,
      orders_last_90d, distinct_products FROM customer_scores WHERE risk_level = 'High'"""),
    "action_kpis": (CURRENT_SCORES, """SELECT count(*) FILTER (WHERE risk_level = 'High') AS high_risk_customers,
      round(sum(monetary) FILTER (WHERE risk_level = 'High'), 2) AS revenue_at_risk FROM customer_scores"""),
    "model_kpis": (COMPARED, """SELECT
      round(sum(value) FILTER (WHERE metric = 'Test ROC-AUC' AND is_selected = 1), 6) AS selected_test_roc_auc,
      round(sum(value) FILTER (WHERE metric = 'Recall' AND is_selected = 1), 6) AS selected_recall,
      round(sum(value) FILTER (WHERE metric = 'Precision' AND is_selected = 1), 6) AS selected_precision,
      round(sum(value) FILTER (WHERE metric = 'CV ROC-AUC' AND is_selected = 1)
        - sum(value) FILTER (WHERE metric = 'CV ROC-AUC' AND is_selected = 0), 6) AS cv_roc_auc_gain
      FROM metrics_long"""),
    "metrics_by_model": (COMPARED, f"""SELECT metric_order, {case('metric', SPANISH['metric'])} AS metric_es,
      {case('model', SPANISH['model'])} AS model_es, round(sum(value), 6) AS value
      FROM metrics_long GROUP BY ALL"""),
    "confusion_pivot": ([*SCORED_TRAINING, CONFUSION], """SELECT actual_order, actual,
      CAST(sum(customers) FILTER (WHERE predicted = 'Predicted stay') AS BIGINT) AS "Predicted stay",
      CAST(sum(customers) FILTER (WHERE predicted = 'Predicted churn') AS BIGINT) AS "Predicted churn"
      FROM confusion GROUP BY actual_order, actual"""),
    "confusion_total": ([*SCORED_TRAINING, CONFUSION],
                        "SELECT CAST(sum(customers) AS BIGINT) AS test_customers FROM confusion"),
    "importance_chart": ([*AT_END, ATTRIBUTION], f"""SELECT {case('feature', SPANISH['feature'])}
      AS feature_label_es, round(m, 6) AS mean_abs_shap FROM ({_IMPORTANCE})"""),
    "localized_segments": ([*CURRENT_SCORES, _REPORTED], """SELECT customer_id, segment_es, segment_order,
      risk_level_es, risk_order, probability_band FROM reported"""),
    "localized_profile": ([*CURRENT_SCORES, _REPORTED], """SELECT segment_order, risk_order, segment_es,
      risk_level_es, count(*) AS customers FROM reported GROUP BY ALL"""),
    "untranslated_labels": (SEGMENTED, f"""SELECT DISTINCT 'country' AS label_column, country AS label
      FROM raw_transactions WHERE customer_id IN (SELECT customer_id FROM customer_segments)
        AND country <> '{HOME}'"""),
    "slicer_values": (CURRENT_SCORES, "SELECT DISTINCT segment FROM customer_scores"),
}.items()}
