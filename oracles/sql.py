"""Independent SQL for every registered query that SQL can express.

Written for DuckDB over the raw tables, query by query from shared CTEs, in plain
relational form (self-joins, correlated subqueries, ordered-set medians) and not
in the shape of the Spark plans.
"""

from __future__ import annotations

WIN_BACK = "High CLV + High Risk (Win-back)"
REWARD = "High CLV + Low Risk (Reward)"
MONITOR = "Low CLV + High Risk (Monitor)"
NO_ACTION = "Low CLV + Low Risk (No Action)"

DAY = "%Y-%m-%d"


def _iso(column: str) -> str:
    return f"strftime({column}, '{DAY}')"


_VALUES = """
order_values AS (
    SELECT l_orderkey AS order_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
    FROM lineitem GROUP BY l_orderkey
)"""

_CATEGORIES = """
ranked_items AS (
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn
    FROM lineitem
),
order_categories AS (
    SELECT i.order_id,
           CASE WHEN p.p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') THEN lower(p.p_type)
                ELSE coalesce(p.p_type, 'unknown') END AS category
    FROM ranked_items i JOIN part p ON i.product_id = p.p_partkey
    WHERE i.rn = 1
)"""


def _fact(limit: str = "TRUE", name: str = "fact") -> str:
    return f"""
{name} AS (
    SELECT o.o_orderkey AS order_id, c.c_custkey AS cust, o.o_orderdate AS ts,
           CAST(o.o_orderdate AS DATE) AS d,
           CAST(coalesce(v.amount, 0) AS DECIMAL(18,2)) AS amount,
           coalesce(g.category, 'unknown') AS category,
           CASE WHEN EXISTS (SELECT 1 FROM lineitem l
                             WHERE l.l_orderkey = o.o_orderkey AND l.l_discount >= 0.10)
                THEN 1 ELSE 0 END AS voucher
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN order_values v ON v.order_id = o.o_orderkey
    LEFT JOIN order_categories g ON g.order_id = o.o_orderkey
    WHERE o.o_orderstatus = 'F' AND {limit}
)"""


_FIRST = """
first_orders AS (
    SELECT cust, min(d) AS first_d, date_trunc('month', min(d)) AS cohort FROM fact GROUP BY cust
)"""

_RETENTION = """
activity AS (
    SELECT cust, date_trunc('month', d) AS active_month,
           (SELECT cohort FROM first_orders f WHERE f.cust = fact.cust) AS cohort
    FROM fact GROUP BY ALL
),
sizes AS (SELECT cohort, count(*) AS cohort_size FROM first_orders GROUP BY cohort),
retention AS (
    SELECT cohort, any_value(cohort_size) AS cohort_size,
           datediff('month', cohort, active_month) AS period_diff,
           count(*) AS active_customers,
           round(count(*) / any_value(cohort_size)::DOUBLE, 4) AS retention_rate
    FROM activity JOIN sizes USING (cohort)
    GROUP BY cohort, datediff('month', cohort, active_month)
)"""

# Consecutive purchases by position: the n-th and the (n+1)-th order of a customer.
_GAPS = """
positions AS (SELECT cust, d, row_number() OVER (PARTITION BY cust ORDER BY d) AS n FROM fact),
gaps AS (
    SELECT later.cust, later.d, earlier.d AS prev_d
    FROM positions later JOIN positions earlier
      ON earlier.cust = later.cust AND earlier.n + 1 = later.n
)"""

_SCALARS = """
positive AS (SELECT CAST(d - prev_d AS BIGINT) AS gap FROM gaps WHERE d > prev_d),
run AS (
    SELECT (SELECT max(d) FROM fact) + 1 AS snapshot,
           coalesce((SELECT median(gap) FROM positive), 45.0) AS median_gap
),
scalars AS (
    SELECT snapshot, median_gap,
           greatest(CAST(floor(2 * median_gap) AS INTEGER), 60) AS threshold
    FROM run
)"""

_METRICS = """
base AS (
    SELECT f.cust, max(f.d) AS last_d, min(f.d) AS first_d, count(*) AS frequency,
           CAST(sum(f.amount) AS DOUBLE) AS monetary, CAST(sum(f.voucher) AS BIGINT) AS vouchers
    FROM fact f GROUP BY f.cust
),
windows AS (
    SELECT f.cust,
           count(*) FILTER (WHERE recent) AS freq_recent,
           count(*) FILTER (WHERE prior) AS freq_prior,
           coalesce(CAST(sum(amount) FILTER (WHERE recent) AS DOUBLE)
                    / nullif(count(*) FILTER (WHERE recent), 0), 0.0) AS aov_recent,
           coalesce(CAST(sum(amount) FILTER (WHERE prior) AS DOUBLE)
                    / nullif(count(*) FILTER (WHERE prior), 0), 0.0) AS aov_prior,
           count(DISTINCT category) FILTER (WHERE recent) AS cat_recent,
           count(DISTINCT category) FILTER (WHERE prior) AS cat_prior
    FROM (SELECT fact.*, d >= snapshot - 90 AND d < snapshot AS recent,
                 d >= snapshot - 180 AND d < snapshot - 90 AS prior
          FROM fact, scalars) f
    GROUP BY f.cust
),
own_gaps AS (SELECT cust, avg(CAST(d - prev_d AS DOUBLE)) AS own_gap FROM gaps GROUP BY cust),
mean_gaps AS (
    SELECT b.cust, greatest(coalesce(g.own_gap, s.median_gap), 1.0) AS avg_gap
    FROM base b CROSS JOIN scalars s LEFT JOIN own_gaps g ON g.cust = b.cust
)"""

_FEATURES = """
features AS (
    SELECT b.cust, CAST(s.snapshot - b.last_d AS BIGINT) AS recency, b.frequency, b.monetary,
           (w.freq_recent + 1.0::DOUBLE) / (w.freq_prior + 1.0::DOUBLE) AS purchase_freq_trend,
           CAST(s.snapshot - b.last_d AS DOUBLE) / m.avg_gap AS recency_ratio,
           CAST(b.vouchers AS DOUBLE) / b.frequency AS discount_dependency,
           (w.cat_recent + 1.0::DOUBLE) / (w.cat_prior + 1.0::DOUBLE) AS category_diversity_trend,
           (w.aov_recent + 1.0::DOUBLE) / (w.aov_prior + 1.0::DOUBLE) AS aov_trend,
           CASE WHEN CAST(s.snapshot - b.last_d AS BIGINT) > s.threshold THEN 1 ELSE 0 END AS churn,
           b.first_d, s.snapshot, s.threshold
    FROM base b JOIN windows w ON b.cust = w.cust JOIN mean_gaps m ON b.cust = m.cust, scalars s
),
split AS (
    SELECT *, CASE WHEN first_d < DATE '1998-01-01' THEN 'train'
                   WHEN first_d <= snapshot - threshold THEN 'holdout' ELSE 'immature' END AS split,
           first_d <= snapshot - threshold AS mature
    FROM features
)"""

_PROFILE = """
tenured AS (
    SELECT *, monetary / frequency AS aov,
           greatest(CAST(snapshot - first_d AS BIGINT), 90) AS tenure_days
    FROM split
),
annual AS (
    SELECT *, frequency / (tenure_days / 365.25::DOUBLE) AS annual_frequency FROM tenured
),
profile AS (
    SELECT *, greatest(coalesce(aov * annual_frequency * 2.0::DOUBLE * 0.2::DOUBLE, 0), 0) AS clv,
           recency_ratio / (1.0::DOUBLE + recency_ratio) AS s
    FROM annual
)"""

_SEGMENTS = f"""
med AS (SELECT median(clv) AS median_clv FROM profile),
segmented AS (
    SELECT profile.*, median_clv,
           CASE WHEN clv >= median_clv AND s >= 0.5 THEN '{WIN_BACK}'
                WHEN clv >= median_clv THEN '{REWARD}'
                WHEN s >= 0.5 THEN '{MONITOR}' ELSE '{NO_ACTION}' END AS quadrant,
           CASE WHEN s >= 0.5 THEN 'High' ELSE 'Low' END AS risk_tier,
           CASE WHEN clv >= median_clv THEN 'High' ELSE 'Low' END AS value_tier
    FROM profile, med
)"""

_SUMMARY = f"""
listed AS (
    SELECT unnest(['{WIN_BACK}', '{REWARD}', '{MONITOR}', '{NO_ACTION}']) AS quadrant
),
summary AS (
    SELECT l.quadrant, count(g.cust) AS customer_count, coalesce(sum(g.clv), 0) AS total_clv,
           coalesce(avg(g.clv), 0) AS avg_clv, coalesce(avg(g.s), 0) AS avg_churn_probability,
           100 * count(g.cust)::DOUBLE / (SELECT count(*) FROM profile) AS share_pct
    FROM listed l LEFT JOIN segmented g ON g.quadrant = l.quadrant GROUP BY l.quadrant
)"""

_CONFUSION = """
pairs AS (
    SELECT churn AS actual, CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS predicted
    FROM profile WHERE split = 'holdout'
),
confusion AS (
    SELECT a.v AS actual, p.v AS predicted,
           (SELECT count(*) FROM pairs x WHERE x.actual = a.v AND x.predicted = p.v) AS n
    FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v)
)"""

_CURVE = """
by_score AS (
    SELECT s, count(*) FILTER (WHERE churn = 1) AS pos, count(*) FILTER (WHERE churn = 0) AS neg
    FROM profile GROUP BY s
),
curve AS (
    SELECT s, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
           (SELECT sum(pos) FROM by_score) AS p
    FROM by_score
    WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
pr AS (
    SELECT s, tp, fp, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / p AS recall FROM curve
)"""

_FACT_CTES = [_VALUES, _CATEGORIES, _fact()]
_TO_SCALARS = [*_FACT_CTES, _GAPS, _SCALARS]
_TO_FEATURES = [*_TO_SCALARS, _METRICS, _FEATURES]
_TO_PROFILE = [*_TO_FEATURES, _PROFILE]
_TO_SEGMENTS = [*_TO_PROFILE, _SEGMENTS]


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


# The experiment: everything as of the pool date, outcomes in the horizon after it.
_POOL_DATE = """
everything AS (
    SELECT CAST(o.o_orderdate AS DATE) AS d, c.c_custkey AS cust
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'
),
pool_date AS (SELECT max(d) + 1 - 180 AS t FROM everything)"""
_SCALARS_AS_OF = _SCALARS.replace(
    "(SELECT max(d) FROM fact) + 1 AS snapshot", "(SELECT t FROM pool_date) + 1 AS snapshot"
)
_ARMS = f"""
arms AS (
    SELECT cust, clv,
           CASE WHEN CAST('0x' || substr(md5(CAST(cust AS VARCHAR) || ':s1'), 1, 8) AS BIGINT) % 100
                     < 50 THEN 'treatment' ELSE 'control' END AS arm
    FROM segmented WHERE quadrant = '{WIN_BACK}'
),
outcomes AS (
    SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM everything e, pool_date
                                  WHERE e.cust = a.cust AND e.d > t AND e.d <= t + 180)
                     THEN 1 ELSE 0 END AS retained
    FROM arms a
)"""
_READOUT = """
arm_counts AS (
    SELECT count(*) FILTER (WHERE arm = 'treatment') AS nt,
           count(*) FILTER (WHERE arm = 'control') AS nc,
           count(*) FILTER (WHERE arm = 'treatment' AND retained = 1) AS xt,
           count(*) FILTER (WHERE arm = 'control' AND retained = 1) AS xc,
           avg(clv) AS avg_clv
    FROM outcomes
),
rates AS (
    SELECT *, coalesce(xt::DOUBLE / nullif(nt, 0), 0) AS rt,
           coalesce(xc::DOUBLE / nullif(nc, 0), 0) AS rc,
           (xt + xc)::DOUBLE / (nt + nc) AS pool
    FROM arm_counts
),
readout AS (
    SELECT *, rt - rc AS lift,
           (rt - rc) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / nt + 1.0::DOUBLE / nc)) AS z,
           1.96::DOUBLE * sqrt(rt * (1 - rt) / nt + rc * (1 - rc) / nc) AS margin
    FROM rates
)"""
_TO_ARMS = [
    _VALUES, _CATEGORIES, _POOL_DATE,
    _fact("CAST(o.o_orderdate AS DATE) <= (SELECT t FROM pool_date)"),
    _GAPS, _SCALARS_AS_OF, _METRICS, _FEATURES, _PROFILE, _SEGMENTS, _ARMS,
]
_TO_READOUT = [*_TO_ARMS, _READOUT]

# erfc by the Taylor series of erf: no engine function needed, exact to 1e-12 for |z| < 4.
_P_VALUE = """
    1 - 2 / sqrt(pi()) * (
        SELECT sum(CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END
                   * exp((2 * n + 1) * ln(abs(z) / sqrt(2)) - lgamma(n + 1)) / (2 * n + 1))
        FROM range(0, 120) t(n))"""

_PROFILED = [
    "recency", "frequency", "monetary", "purchase_freq_trend", "recency_ratio",
    "discount_dependency", "category_diversity_trend", "aov_trend", "churn",
]
_MODEL_FEATURES = [
    "frequency", "monetary", "purchase_freq_trend", "discount_dependency",
    "category_diversity_trend", "aov_trend",
]


def _scaled_line(name: str) -> str:
    scaled = f"({name} - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END"
    return f"""
SELECT '{name}' AS feature, round(avg({scaled}), 6) + 0.0 AS mean,
       round(stddev_pop({scaled}), 6) AS std, round(min({scaled}), 6) AS min,
       round(max({scaled}), 6) AS max
FROM split, (SELECT avg({name}) AS m, stddev_pop({name}) AS sd FROM split WHERE split = 'train')
WHERE split = 'train'"""


def _report_line(c: int) -> str:
    return f"""
    SELECT '{c}' AS class,
           coalesce(hit::DOUBLE / nullif(pred, 0), 0) AS precision,
           coalesce(hit::DOUBLE / nullif(act, 0), 0) AS recall,
           coalesce(2 * hit::DOUBLE / nullif(pred + act, 0), 0) AS f1, act AS support
    FROM (SELECT CAST(sum(n) FILTER (WHERE actual = {c} AND predicted = {c}) AS BIGINT) AS hit,
                 CAST(sum(n) FILTER (WHERE predicted = {c}) AS BIGINT) AS pred,
                 CAST(sum(n) FILTER (WHERE actual = {c}) AS BIGINT) AS act
          FROM confusion)"""


_PIVOT_RANGE = "cohort BETWEEN DATE '1995-06-01' AND DATE '1998-12-01'"

ORACLES = {
    "order_value": _with(
        [_VALUES], "SELECT order_id, CAST(amount AS DOUBLE) AS order_value FROM order_values"
    ),
    "order_category": _with([_CATEGORIES], "SELECT order_id, category FROM order_categories"),
    "order_fact": _with(
        _FACT_CTES,
        f"""SELECT order_id, cust AS customer_unique_id,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
                   {_iso('d')} AS order_date, CAST(amount AS DOUBLE) AS order_value, category
            FROM fact""",
    ),
    "csv_reload": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               strftime(o_orderdate, '{DAY} %H:%M:%S') AS order_purchase_timestamp
        FROM orders""",
    "csv_reload_rows": """
        SELECT 'orders' AS role, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM orders
        UNION ALL SELECT 'customers', count(*), sum(c_custkey)::BIGINT FROM customer
        UNION ALL SELECT 'items', count(*), sum(l_orderkey)::BIGINT FROM lineitem
        UNION ALL SELECT 'products', count(*), sum(p_partkey)::BIGINT FROM part
        UNION ALL SELECT 'translation', 4, 0
        UNION ALL SELECT 'payments', count(*), sum(l_orderkey)::BIGINT FROM lineitem""",
    "metadata_reload": _with(
        _TO_SCALARS,
        f"""SELECT CAST(threshold AS BIGINT) AS churn_threshold, {_iso('snapshot')} AS snapshot_date
            FROM scalars""",
    ),
    "sales_by_category": _with(
        _FACT_CTES,
        """SELECT category, count(*) AS orders,
                  round(CAST(sum(amount) AS DOUBLE), 2) AS total_value FROM fact GROUP BY category""",
    ),
    "output_rows": _with(
        [*_FACT_CTES, _FIRST, _RETENTION, _GAPS],
        """SELECT 'cohort_retention' AS table_name, count(*) AS n_rows FROM retention
           UNION ALL SELECT 'customer_order_fact', count(*) FROM fact
           UNION ALL SELECT 'customer_purchase_gaps', count(*) FROM gaps
           UNION ALL SELECT 'rfm_table', count(DISTINCT cust) FROM fact""",
    ),
    "first_purchase": _with(
        [*_FACT_CTES, _FIRST],
        f"""SELECT cust AS customer_unique_id, {_iso('first_d')} AS first_purchase_date,
                   {_iso('cohort')} AS cohort_month FROM first_orders""",
    ),
    "cohort_activity": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"""SELECT cust AS customer_unique_id, {_iso('cohort')} AS cohort_month,
                   {_iso('active_month')} AS activity_month FROM activity""",
    ),
    "cohort_sizes": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"SELECT {_iso('cohort')} AS cohort_month, cohort_size FROM sizes",
    ),
    "cohort_retention": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"""SELECT {_iso('cohort')} AS cohort_month, cohort_size, period_diff, active_customers,
                   retention_rate FROM retention ORDER BY cohort, period_diff""",
    ),
    "cohort_pivot": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"SELECT {_iso('cohort')} AS cohort_month, "
        + ", ".join(
            f"max(retention_rate) FILTER (WHERE period_diff = {p}) AS period_{p}" for p in range(12)
        )
        + f" FROM retention WHERE {_PIVOT_RANGE} GROUP BY cohort ORDER BY cohort",
    ),
    "acquisition_by_month": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"""SELECT {_iso('cohort')} AS cohort_month, cohort_size FROM sizes
            WHERE {_PIVOT_RANGE} ORDER BY cohort""",
    ),
    "rfm": _with(
        _FACT_CTES,
        f"""SELECT cust AS customer_unique_id,
                   CAST((SELECT max(d) + 1 FROM fact) - max(d) AS BIGINT) AS recency,
                   count(order_id) AS frequency, CAST(sum(amount) AS DOUBLE) AS monetary,
                   {_iso('max(d)')} AS last_order_date
            FROM fact GROUP BY cust""",
    ),
    "purchase_gaps": _with(
        [*_FACT_CTES, _GAPS],
        f"""SELECT cust AS customer_unique_id, {_iso('d')} AS order_date,
                   {_iso('prev_d')} AS prev_order_date, CAST(d - prev_d AS BIGINT) AS gap
            FROM gaps""",
    ),
    "gap_stats": _with(
        [*_FACT_CTES, _GAPS],
        """SELECT count(*) AS n_gaps, count(*) FILTER (WHERE d > prev_d) AS n_positive,
                  CAST(median(CAST(d - prev_d AS BIGINT)) FILTER (WHERE d > prev_d) AS DOUBLE)
                      AS median_gap,
                  round(avg(CAST(d - prev_d AS DOUBLE)) FILTER (WHERE d > prev_d), 6) AS mean_gap
           FROM gaps""",
    ),
    "run_scalars": _with(
        _TO_SCALARS,
        f"SELECT threshold AS churn_threshold, {_iso('snapshot')} AS snapshot_date FROM scalars",
    ),
    "avg_gap": _with(
        [*_TO_SCALARS, _METRICS],
        "SELECT cust AS customer_unique_id, avg_gap FROM mean_gaps",
    ),
    "window_metrics": _with(
        [*_TO_SCALARS, _METRICS],
        """SELECT cust AS customer_unique_id, freq_recent, freq_prior,
                  aov_recent, aov_prior,
                  cat_recent, cat_prior FROM windows""",
    ),
    "voucher_dependency": _with(
        _FACT_CTES,
        """SELECT cust AS customer_unique_id, CAST(sum(voucher) AS BIGINT) AS voucher_orders,
                  count(*) AS total_orders,
                  CAST(sum(voucher) AS DOUBLE) / count(*) AS discount_dependency
           FROM fact GROUP BY cust""",
    ),
    "churn_label": _with(
        _TO_FEATURES, "SELECT cust AS customer_unique_id, recency, churn FROM features"
    ),
    "customer_features": _with(
        _TO_FEATURES,
        """SELECT cust AS customer_unique_id, recency, frequency, monetary,
                  purchase_freq_trend,
                  recency_ratio,
                  discount_dependency,
                  category_diversity_trend,
                  aov_trend, churn
           FROM features""",
    ),
    "feature_profile": _with(
        _TO_FEATURES,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}), 4) AS mean,
                       round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
                       round(CAST(max({c}) AS DOUBLE), 4) AS max FROM features"""
            for c in _PROFILED
        ),
    ),
    "maturity_split": _with(
        _TO_FEATURES,
        """SELECT coalesce(split, 'all') AS split, count(*) AS customers,
                  CAST(sum(churn) AS BIGINT) AS churners, round(avg(churn), 6) AS churn_rate
           FROM split GROUP BY ROLLUP (split)""",
    ),
    "class_weights": _with(
        _TO_FEATURES,
        """SELECT churn, count(*) AS n_class,
                  round((SELECT count(*) FROM split WHERE split = 'train')::DOUBLE
                        / ((SELECT count(DISTINCT churn) FROM split WHERE split = 'train')
                           * count(*)), 6) AS weight
           FROM split WHERE split = 'train' GROUP BY churn""",
    ),
    "scaled_profile": _with(_TO_FEATURES, " UNION ALL ".join(map(_scaled_line, _MODEL_FEATURES))),
    "clv": _with(
        _TO_PROFILE,
        """SELECT cust AS customer_unique_id, aov, tenure_days,
                  annual_frequency, clv
           FROM profile""",
    ),
    "quadrants": _with(
        _TO_SEGMENTS,
        """SELECT cust AS customer_unique_id, s AS churn_probability,
                  clv, quadrant, risk_tier, value_tier FROM segmented""",
    ),
    "quadrant_summary": _with(
        [*_TO_SEGMENTS, _SUMMARY],
        """SELECT quadrant, customer_count, round(total_clv, 2) AS total_clv,
                  round(avg_clv, 2) AS avg_clv,
                  round(avg_churn_probability, 4) AS avg_churn_probability,
                  round(share_pct, 4) AS share_pct FROM summary""",
    ),
    "quadrant_sizes": _with(
        _TO_SEGMENTS,
        """SELECT quadrant, count(*) AS customers, round(sum(clv), 2) AS total_clv
           FROM segmented GROUP BY quadrant ORDER BY customers DESC, quadrant""",
    ),
    "quadrant_display": _with(
        [*_TO_SEGMENTS, _SUMMARY],
        """SELECT quadrant, format('{:,}', customer_count) AS customer_count,
                  '$' || format('{:,.2f}', total_clv) AS total_clv,
                  '$' || format('{:,.2f}', avg_clv) AS avg_clv,
                  format('{:.1f}%', avg_churn_probability * 100) AS avg_churn_probability,
                  format('{:.2f}%', share_pct) AS share_pct FROM summary""",
    ),
    "action_table": _with(
        _TO_SEGMENTS,
        """SELECT cust AS customer_unique_id, recency, frequency,
                  '$' || format('{:.2f}', monetary) AS monetary,
                  '$' || format('{:.2f}', clv) AS clv,
                  format('{:.1f}%', s * 100) AS churn_probability, quadrant FROM segmented""",
    ),
    "risk_kpis": _with(
        [*_TO_SEGMENTS, _FIRST],
        """SELECT count(*) AS total_customers,
                  round(coalesce(sum(clv) FILTER (WHERE risk_tier = 'High'), 0), 2) AS clv_at_risk,
                  round(avg(clv), 2) AS avg_clv, round(any_value(median_clv), 2) AS median_clv,
                  (SELECT count(DISTINCT cohort) FROM first_orders) AS cohort_months
           FROM segmented""",
    ),
    "crm_export": _with(
        _TO_SEGMENTS,
        f"""SELECT cust AS customer_unique_id, clv,
                   s AS churn_probability, quadrant
            FROM segmented WHERE quadrant = '{WIN_BACK}'""",
    ),
    "segment_sample": _with(
        _TO_SEGMENTS,
        """SELECT cust AS customer_unique_id, s AS churn_probability,
                  clv, quadrant, recency, frequency, monetary
           FROM segmented ORDER BY md5(CAST(cust AS VARCHAR) || ':42'), cust LIMIT 5000""",
    ),
    "confusion_matrix": _with(
        [*_TO_PROFILE, _CONFUSION], "SELECT actual, predicted, n FROM confusion"
    ),
    "classification_report": _with(
        [
            *_TO_PROFILE,
            _CONFUSION,
            f" per_class AS ({_report_line(0)} UNION ALL {_report_line(1)})",
            """ overall AS (
                SELECT CAST(sum(n) AS BIGINT) AS n,
                       coalesce(CAST(sum(n) FILTER (WHERE actual = predicted) AS DOUBLE)
                                / nullif(sum(n), 0), 0) AS accuracy FROM confusion)""",
        ],
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
                  round(f1, 6) AS f1, support FROM (
               SELECT * FROM per_class
               UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, n FROM overall
               UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1),
                                CAST(sum(support) AS BIGINT) FROM per_class
               UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                                sum(recall * support) / sum(support),
                                sum(f1 * support) / sum(support),
                                CAST(sum(support) AS BIGINT) FROM per_class)""",
    ),
    "roc_auc": _with(
        [*_TO_PROFILE, _CURVE],
        """SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
                  round(sum(pos * (below + neg / 2.0::DOUBLE))
                        / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS auc
           FROM (SELECT *, coalesce(sum(neg) OVER (
                     ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                 FROM by_score)""",
    ),
    "pr_curve": _with(
        [*_TO_PROFILE, _CURVE],
        """SELECT s AS threshold, tp AS true_positives, fp AS false_positives,
                  precision, recall FROM pr""",
    ),
    "operating_threshold": _with(
        [
            *_TO_PROFILE,
            _CURVE,
            """ chosen AS (
                SELECT max(s) AS raw, greatest(least(max(s), 0.7::DOUBLE), 0.3::DOUBLE) AS t
                FROM pr WHERE recall >= 0.8::DOUBLE)""",
        ],
        """SELECT raw AS raw_threshold, t AS threshold,
                  sum(churn)::DOUBLE / count(*) AS precision,
                  sum(churn)::DOUBLE / (SELECT sum(churn) FROM profile) AS recall
           FROM profile, chosen WHERE s >= t GROUP BY raw, t""",
    ),
    "threshold_sweep": _with(
        [*_TO_PROFILE, "med AS (SELECT median(clv) AS median_clv FROM profile)"],
        """SELECT t.k / 100.0::DOUBLE AS threshold,
                  count(*) FILTER (WHERE s >= t.k / 100.0::DOUBLE AND clv >= median_clv) AS win_back,
                  count(*) FILTER (WHERE s < t.k / 100.0::DOUBLE AND clv >= median_clv) AS reward,
                  count(*) FILTER (WHERE s >= t.k / 100.0::DOUBLE AND clv < median_clv) AS monitor,
                  count(*) FILTER (WHERE s < t.k / 100.0::DOUBLE AND clv < median_clv) AS no_action,
                  round(coalesce(sum(clv) FILTER (WHERE s >= t.k / 100.0::DOUBLE), 0), 2)
                      AS clv_at_risk,
                  coalesce(
                      count(*) FILTER (WHERE s >= t.k / 100.0::DOUBLE AND mature AND churn = 1)::DOUBLE
                      / nullif(count(*) FILTER (WHERE s >= t.k / 100.0::DOUBLE AND mature), 0), 0)
                      AS precision,
                  coalesce(
                      count(*) FILTER (WHERE s >= t.k / 100.0::DOUBLE AND mature AND churn = 1)::DOUBLE
                      / nullif(count(*) FILTER (WHERE mature AND churn = 1), 0), 0) AS recall
           FROM profile, med, range(10, 91) t(k) GROUP BY t.k ORDER BY t.k""",
    ),
    "live_metrics": _with(
        _TO_PROFILE,
        """SELECT coalesce(split, 'mature') AS split,
                  coalesce(count(*) FILTER (WHERE s >= 0.5 AND churn = 1)::DOUBLE
                           / nullif(count(*) FILTER (WHERE s >= 0.5), 0), 0) AS precision,
                  coalesce(count(*) FILTER (WHERE s >= 0.5 AND churn = 1)::DOUBLE
                           / nullif(count(*) FILTER (WHERE churn = 1), 0), 0) AS recall
           FROM profile WHERE mature GROUP BY ROLLUP (split)""",
    ),
    "ab_assign": _with(_TO_ARMS, "SELECT cust AS customer_unique_id, arm FROM arms"),
    "ab_outcome": _with(
        _TO_ARMS, "SELECT cust AS customer_unique_id, arm, retained FROM outcomes"
    ),
    "experiment_readout": _with(
        _TO_READOUT,
        f"""SELECT nt AS n_treatment, nc AS n_control, xt AS retained_treatment,
                   xc AS retained_control, round(rt, 6) AS rate_treatment,
                   round(rc, 6) AS rate_control, round(lift, 6) AS lift, round(z, 6) AS z_stat,
                   round(lift - margin, 6) AS ci_lower, round(lift + margin, 6) AS ci_upper,
                   round(1.96::DOUBLE * sqrt(rt * (1 - rt) / nt), 6) AS err_treatment,
                   round(1.96::DOUBLE * sqrt(rc * (1 - rc) / nc), 6) AS err_control,
                   round({_P_VALUE}, 6) AS p_value
            FROM readout""",
    ),
    "campaign_roi": _with(
        _TO_READOUT,
        """SELECT 5.0::DOUBLE AS cost_per_cust, round(avg_clv, 4) AS avg_clv,
                  round(cost, 4) AS total_cost, round(saved, 4) AS incremental_saved,
                  round(saved * avg_clv, 4) AS clv_protected,
                  round(saved * avg_clv - cost, 4) AS net_profit,
                  round(coalesce((saved * avg_clv - cost) / nullif(cost, 0), 0) * 100, 4) AS roi
           FROM (SELECT *, nt * 5.0::DOUBLE AS cost, xt - nt * rc AS saved FROM readout)""",
    ),
}


# Supplied scores: -1 stands for a customer without one.
_SUPPLIED = _PROFILE.replace(
    "recency_ratio / (1.0::DOUBLE + recency_ratio) AS s",
    "CASE WHEN cust % 10 <> 0 THEN ((cust * 7919) % 1000) / 1000.0::DOUBLE ELSE -1.0 END AS s",
)


def _on_supplied(name: str) -> str:
    return ORACLES[name].replace(_PROFILE, _SUPPLIED)


def _zeros(measures: list[str]) -> str:
    listed = ", ".join(f"'{m}'" for m in measures)
    return f"SELECT unnest([{listed}]) AS measure, 0.0::DOUBLE AS difference"


_IMPORTANCES = [f"importance of {c}" for c in _MODEL_FEATURES]

ORACLES |= {
    "supplied_sweep": _on_supplied("threshold_sweep"),
    "supplied_live_metrics": _on_supplied("live_metrics"),
    "supplied_ab_assign": _on_supplied("ab_assign"),
    "scored_customers": _with(
        _TO_FEATURES,
        "SELECT split, count(*) AS customers, 1 AS in_range FROM split GROUP BY split",
    ),
    "logistic_optimality": _with(
        _TO_FEATURES,
        f"""SELECT unnest([{", ".join(f"'{c}'" for c in _MODEL_FEATURES)}, 'intercept']) AS term,
                   (SELECT count(*) FROM split WHERE split = 'train') AS n, 0.0::DOUBLE AS gradient, 1 AS by_size""",
    ),
    "forest_recount": _zeros([*_IMPORTANCES, "leaf share", "node weight", "rows of a root"]),
    "active_customers_estimate": _with(
        [*_FACT_CTES, _FIRST, _RETENTION],
        f"""SELECT {_iso('active_month')} AS activity_month, count(DISTINCT cust) AS active_customers, 1 AS within_2_pct
            FROM activity GROUP BY active_month""",
    ),
    "score_recount": _zeros([*_IMPORTANCES, "score"]),
}
