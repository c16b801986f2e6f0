"""Oracle SQL (DuckDB dialect) for the registered queries; column names and
types match the Spark results. Views: the driver tables by name."""

from __future__ import annotations

# ---------------------------------------------------------------- drift

_EVENTS_SIDES = """
ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15'),
cur AS (SELECT * REPLACE (CASE WHEN event_type = 'error' THEN 'purchase' ELSE event_type END AS event_type)
        FROM events WHERE ts >= TIMESTAMP '2024-01-15')
"""

_JS_FROM_LONG = """
counts AS (SELECT "column", value, CAST(sum(is_ref) AS BIGINT) AS n_ref,
                  CAST(sum(1 - is_ref) AS BIGINT) AS n_cur
           FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT "column", CAST(sum(n_ref) AS BIGINT) AS tr, CAST(sum(n_cur) AS BIGINT) AS tc
        FROM counts GROUP BY 1),
shares AS (SELECT c."column",
                  greatest(coalesce(CASE WHEN t.tr > 0 THEN c.n_ref * 1.0e0 / t.tr END, 0.0), 1e-10) AS p,
                  greatest(coalesce(CASE WHEN t.tc > 0 THEN c.n_cur * 1.0e0 / t.tc END, 0.0), 1e-10) AS q
           FROM counts c JOIN tot t USING ("column")),
js AS (SELECT "column", sum(0.5 * (p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q)))) AS js
       FROM shares GROUP BY 1)
"""

DRIFT_CATEGORICAL = f"""
WITH {_EVENTS_SIDES},
long AS (
  SELECT 'event_type' AS "column", event_type AS value, 1 AS is_ref FROM ref
  UNION ALL SELECT 'props', props, 1 FROM ref
  UNION ALL SELECT 'event_type', event_type, 0 FROM cur
  UNION ALL SELECT 'props', props, 0 FROM cur),
{_JS_FROM_LONG}
SELECT t."column", 'js_divergence' AS method, round(coalesce(js.js, 0.0), 9) AS js_divergence,
       t.tr AS n_reference, t.tc AS n_current, coalesce(js.js, 0.0) > 0.1 AS drift_detected
FROM tot t LEFT JOIN js USING ("column")
"""

_LINEITEM_LONG = """
ref AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_discount AS l_discount_shift
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
cur AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_discount + 0.01 AS l_discount_shift
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
long AS (
  SELECT "column", value, 1 AS is_ref FROM (UNPIVOT ref ON l_quantity, l_extendedprice, l_discount, l_tax, l_discount_shift INTO NAME "column" VALUE value)
  UNION ALL
  SELECT "column", value, 0 AS is_ref FROM (UNPIVOT cur ON l_quantity, l_extendedprice, l_discount, l_tax, l_discount_shift INTO NAME "column" VALUE value))
"""

_KS_FROM_LONG = """
counts AS (SELECT "column", value, CAST(sum(is_ref) AS BIGINT) AS n_ref,
                  CAST(sum(1 - is_ref) AS BIGINT) AS n_cur
           FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
run AS (SELECT "column", value,
               sum(n_ref) OVER (PARTITION BY "column" ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
               sum(n_cur) OVER (PARTITION BY "column" ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc,
               sum(n_ref) OVER (PARTITION BY "column") AS nr,
               sum(n_cur) OVER (PARTITION BY "column") AS nc
        FROM counts),
ks AS (SELECT "column", max(abs(cr * 1.0e0 / nr - cc * 1.0e0 / nc)) AS d,
              CAST(max(nr) AS BIGINT) AS n, CAST(max(nc) AS BIGINT) AS m
       FROM run GROUP BY 1),
lam AS (SELECT "column", d, n, m, d * sqrt(n * 1.0e0 * m / (n + m)) AS lam FROM ks),
series AS (SELECT "column", sum(power(-1.0e0, k - 1) * exp(-2.0e0 * k * k * lam * lam)) AS s
           FROM lam, range(1, 101) r(k) GROUP BY 1),
pv AS (SELECT l."column", l.d, l.n, l.m,
              CASE WHEN l.lam < 0.2 THEN 1.0e0 ELSE least(greatest(2.0e0 * s.s, 0.0), 1.0) END AS p
       FROM lam l JOIN series s USING ("column"))
"""



def _ks_ctes(src: str, prefix: str) -> str:
    """KS CTEs over a long table ``src`` with the names prefixed."""
    text = _KS_FROM_LONG.replace("FROM long", f"FROM {src}")
    for name in ("counts", "run", "ks", "lam", "series", "pv"):
        text = text.replace(f"{name} AS (", f"{prefix}{name} AS (").replace(
            f"FROM {name} ", f"FROM {prefix}{name} ").replace(f"FROM {name})", f"FROM {prefix}{name})").replace(
            f"FROM {name},", f"FROM {prefix}{name},").replace(f"JOIN {name} ", f"JOIN {prefix}{name} ")
    return text


DRIFT_NUMERIC_KS = f"""
WITH {_LINEITEM_LONG}, {_KS_FROM_LONG}
SELECT "column", round(d, 9) AS statistic, n AS n_reference, m AS n_current FROM pv
"""

DRIFT_NUMERIC_PVALUE = f"""
WITH {_LINEITEM_LONG}, {_KS_FROM_LONG}
SELECT "column", round(d, 9) AS statistic, round(p, 9) AS p_value, p < 0.05 AS drift_detected FROM pv
"""

_DRIFT_TABLES = f"""
{_EVENTS_SIDES},
r AS (SELECT ts, event_type, user_id, props,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM ref),
c AS (SELECT ts, event_type, user_id,
             (CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END) * 1.2 AS value FROM cur)
"""

# Chi-square columns have five values here: four degrees of freedom, a closed tail.
_DRIFT_PRESET = f"""
WITH {_DRIFT_TABLES},
u AS (SELECT 1 AS r, event_type, user_id, value FROM r UNION ALL SELECT 0, event_type, user_id, value FROM c),
v AS (SELECT r, 'event_type' AS "column", event_type AS t, CAST(NULL AS DOUBLE) AS x FROM u
      UNION ALL SELECT r, 'flag', CASE WHEN event_type = 'signup' THEN 'yes' ELSE 'no' END, NULL FROM u
      UNION ALL SELECT r, 'few', CAST(user_id % 5 AS VARCHAR), CAST(user_id % 5 AS DOUBLE) FROM u
      UNION ALL SELECT r, 'user_id', CAST(user_id AS VARCHAR), CAST(user_id AS DOUBLE) FROM u
      UNION ALL SELECT r, 'value', CAST(value AS VARCHAR), value FROM u),
k AS (SELECT "column", t, x, sum(r) * 1.0e0 AS a, sum(1 - r) * 1.0e0 AS b FROM v WHERE t IS NOT NULL GROUP BY 1, 2, 3),
f AS (SELECT "column", sum(a) AS n, sum(b) AS m, count(*) AS nv FROM k GROUP BY 1),
o AS (SELECT "column", CASE WHEN "column" IN ('event_type', 'flag') OR nv <= 5
             THEN CASE WHEN n > 1000 THEN 'jensen_shannon' WHEN nv <= 2 THEN 'z_test' ELSE 'chi_square' END
             WHEN n > 1000 THEN 'wasserstein' ELSE 'ks_test' END AS method, n, m, nv FROM f),
w AS (SELECT "column", t, x, a, b, n, m, sum(a) OVER o AS ca, sum(b) OVER o AS cb, lead(x) OVER o AS nx, min(t) OVER (PARTITION BY "column") AS t0
      FROM k JOIN f USING ("column") WINDOW o AS (PARTITION BY "column" ORDER BY x)),
sd AS (SELECT "column", stddev_pop(x) AS sd FROM v WHERE r = 1 AND t IS NOT NULL GROUP BY 1),
g AS (SELECT "column", max(abs(ca / n - cb / m)) AS ks, sum(abs(ca / n - cb / m) * coalesce(nx - x, 0)) AS wd,
             sum((b - a * m / n) * (b - a * m / n) / (a * m / n)) AS chi,
             sum(CASE WHEN t = t0 THEN a END) AS a0, sum(CASE WHEN t = t0 THEN b END) AS b0, any_value(n) AS n, any_value(m) AS m,
             sum(0.5 * (greatest(a / n, 1e-10) * log2(2 * greatest(a / n, 1e-10) / (greatest(a / n, 1e-10) + greatest(b / m, 1e-10)))
                      + greatest(b / m, 1e-10) * log2(2 * greatest(b / m, 1e-10) / (greatest(a / n, 1e-10) + greatest(b / m, 1e-10))))) AS js
      FROM w GROUP BY 1),
s AS (SELECT "column", o.method, o.n, o.m, o.nv, CASE o.method WHEN 'ks_test' THEN ks WHEN 'wasserstein' THEN wd / greatest(sd, 0.001) WHEN 'chi_square' THEN chi
             WHEN 'z_test' THEN (a0 / g.n - b0 / g.m) / sqrt((a0 + b0) / (g.n + g.m) * (1 - (a0 + b0) / (g.n + g.m)) * (1 / g.n + 1 / g.m))
             ELSE sqrt(js) END AS st
      FROM o JOIN g USING ("column") JOIN sd USING ("column")),
p1 AS (SELECT "column", sum(power(-1.0e0, i - 1) * exp(-2.0e0 * i * i * st * st * n * m / (n + m))) AS ksum,
              sum(CASE WHEN i <= 60 THEN power(-1.0e0, i - 1) * power(least(abs(st), 5) / sqrt(2.0e0), 2 * i - 1) / (gamma(i * 1.0e0) * (2 * i - 1)) END) AS zsum
       FROM s, range(1, 101) q(i) GROUP BY 1),
p AS (SELECT s.*, CASE method WHEN 'ks_test' THEN CASE WHEN st * sqrt(n * m / (n + m)) < 0.2 THEN 1 ELSE least(greatest(2 * ksum, 0), 1) END
             WHEN 'chi_square' THEN exp(-st / 2) * (1 + st / 2) WHEN 'z_test' THEN 1 - 2 / sqrt(pi()) * zsum END AS pv
      FROM s JOIN p1 USING ("column")),
d AS (SELECT "column", method, round(st, 9) AS statistic, round(pv, 9) AS p_value, CAST(n AS BIGINT) AS n_reference, CAST(m AS BIGINT) AS n_current, nv AS n_values,
             CASE WHEN method IN ('wasserstein', 'jensen_shannon') THEN st >= 0.1 ELSE pv < 0.05 END AS drift_detected FROM p)
"""
DRIFT_PRESET = _DRIFT_PRESET + "SELECT * FROM d"
DRIFT_PRESET_SHARE = _DRIFT_PRESET + """
SELECT count(*) FILTER (drift_detected) AS columns_drifted, count(*) AS tested_columns, count(*) AS total_columns,
       round(avg(CASE WHEN drift_detected THEN 1.0e0 ELSE 0 END), 9) AS drift_score, avg(CASE WHEN drift_detected THEN 1.0e0 ELSE 0 END) >= 0.5 AS data_drift_detected FROM d
"""

_DRIFT_COLUMNS = f"""
WITH {_DRIFT_TABLES},
long AS (
  SELECT 'event_type' AS "column", event_type AS value, 1 AS is_ref FROM r
  UNION ALL SELECT 'event_type', event_type, 0 FROM c),
{_JS_FROM_LONG},
cat AS (SELECT t."column", 'categorical' AS kind, 'js_divergence' AS method,
               CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS DOUBLE) AS p_value,
               round(coalesce(js.js, 0.0), 9) AS js_divergence, t.tr AS n_reference, t.tc AS n_current,
               coalesce(js.js, 0.0) > 0.1 AS drift_detected, CAST(NULL AS VARCHAR) AS error
        FROM tot t LEFT JOIN js USING ("column")),
nlong AS (
  SELECT 'user_id' AS "column", CAST(user_id AS DOUBLE) AS value, 1 AS is_ref FROM r
  UNION ALL SELECT 'value', value, 1 FROM r
  UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), 0 FROM c
  UNION ALL SELECT 'value', value, 0 FROM c),
{_ks_ctes("nlong", "k_")},
num AS (SELECT "column", 'numeric' AS kind, 'ks_test' AS method, round(d, 9) AS statistic,
               round(p, 9) AS p_value, CAST(NULL AS DOUBLE) AS js_divergence, n AS n_reference,
               m AS n_current, p < 0.05 AS drift_detected, CAST(NULL AS VARCHAR) AS error FROM k_pv),
allc AS (SELECT * FROM cat UNION ALL SELECT * FROM num)
"""

DRIFT_COLUMNS = _DRIFT_COLUMNS + "SELECT * FROM allc"

DRIFT_SUMMARY = _DRIFT_COLUMNS + """
SELECT CAST(count_if(drift_detected) AS BIGINT) AS columns_drifted,
       CAST(count(*) AS BIGINT) AS tested_columns,
       CAST(4 AS BIGINT) AS total_columns,
       round(count_if(drift_detected) / 4.0, 9) AS drift_score,
       count_if(drift_detected) / 4.0 >= 0.3 AS data_drift_detected
FROM allc
"""

DRIFT_RETRAIN_SIGNAL = _DRIFT_COLUMNS + "SELECT \"column\" FROM allc WHERE drift_detected"

DRIFT_COLUMN_MISMATCH = f"""
WITH {_EVENTS_SIDES}
SELECT 'props' AS "column", 'missing_in_current' AS side, CAST(count(props) AS BIGINT) AS n_values FROM ref
"""

# ---------------------------------------------------------------- quality

_LI_NULLS = """
t AS (SELECT l_orderkey, l_partkey,
             CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
             CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
             CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
             l_shipdate
      FROM lineitem)
"""

QUALITY_NULL_COUNTS = f"""
WITH {_LI_NULLS},
w AS (SELECT CAST(count(*) - count(l_orderkey) AS BIGINT) AS l_orderkey,
             CAST(count(*) - count(l_partkey) AS BIGINT) AS l_partkey,
             CAST(count(*) - count(l_quantity) AS BIGINT) AS l_quantity,
             CAST(count(*) - count(l_extendedprice) AS BIGINT) AS l_extendedprice,
             CAST(count(*) - count(l_returnflag) AS BIGINT) AS l_returnflag,
             CAST(count(*) - count(l_shipdate) AS BIGINT) AS l_shipdate FROM t)
SELECT "column", null_count FROM (UNPIVOT w ON COLUMNS(*) INTO NAME "column" VALUE null_count)
"""

QUALITY_DUPLICATES = """
WITH t AS (SELECT l_returnflag, l_linestatus, l_quantity,
                  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM t)) AS distinct_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS BIGINT) AS duplicate_rows
FROM t
"""

QUALITY_VALIDATE = """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(6 AS BIGINT) AS n_cols,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS BIGINT) AS duplicate_rows,
       count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS is_valid
FROM events
"""

QUALITY_TYPES = """
SELECT * FROM (VALUES
  ('o_orderkey', 'int64', 'int64', true,
   (SELECT CAST(count_if(o_orderkey IS NOT NULL AND try_cast(o_orderkey AS BIGINT) IS NULL) AS BIGINT) FROM orders)),
  ('o_totalprice', 'float64', 'float64', true,
   (SELECT CAST(count_if(o_totalprice IS NOT NULL AND try_cast(o_totalprice AS DOUBLE) IS NULL) AS BIGINT) FROM orders)),
  ('o_orderstatus', 'int64', 'object', false,
   (SELECT CAST(count_if(o_orderstatus IS NOT NULL AND try_cast(o_orderstatus AS BIGINT) IS NULL) AS BIGINT) FROM orders))
) v("column", expected, actual, matches, n_nonconforming)
"""

# ---------------------------------------------------------------- prep

PREP_DROP_DUPLICATES = "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem"

PREP_DROP_COLUMNS = "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part"

PREP_LABEL_ENCODE = """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
d AS (SELECT DISTINCT p FROM t WHERE p IS NOT NULL),
codes AS (SELECT p, CAST(row_number() OVER (ORDER BY p) - 1 AS DOUBLE) AS code FROM d),
k AS (SELECT CAST(count(*) AS DOUBLE) AS k FROM d)
SELECT t.o_orderkey, CASE WHEN t.p IS NULL THEN k.k ELSE codes.code END AS o_orderpriority
FROM t LEFT JOIN codes ON t.p = codes.p CROSS JOIN k
"""

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _one_hot_sql(cats):
    cols = ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS \"c_mktsegment_{v}\"" for v in cats)
    return f"SELECT c_custkey, {cols} FROM customer"


PREP_ONE_HOT = _one_hot_sql(_SEGMENTS)
PREP_ONE_HOT_DROP_FIRST = _one_hot_sql(_SEGMENTS[1:])

PREP_SCALE = """
WITH p AS (SELECT p_partkey, p_retailprice, p_size, 1.0e0 AS p_const FROM part),
s AS (SELECT avg(p_retailprice) AS m1, stddev_samp(p_retailprice) AS s1,
             avg(p_size) AS m2, stddev_samp(p_size) AS s2,
             avg(p_const) AS m3, stddev_samp(p_const) AS s3 FROM p)
SELECT p_partkey,
       round(CASE WHEN s1 <> 0 THEN (p_retailprice - m1) / s1 END, 9) AS p_retailprice,
       round(CASE WHEN s2 <> 0 THEN (p_size - m2) / s2 END, 9) AS p_size,
       round(CASE WHEN s3 <> 0 THEN (p_const - m3) / s3 END, 9) AS p_const
FROM p, s
"""

_FILL_BASE = f"WITH {_LI_NULLS}, f AS (SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM t)"

PREP_FILL_MEAN = _FILL_BASE + """,
s AS (SELECT avg(l_quantity) AS q, avg(l_extendedprice) AS e FROM f)
SELECT l_orderkey, l_partkey, round(coalesce(l_quantity, q), 9) AS l_quantity,
       round(coalesce(l_extendedprice, e), 9) AS l_extendedprice, l_returnflag FROM f, s
"""

PREP_FILL_MEDIAN = _FILL_BASE + """,
s AS (SELECT median(l_quantity) AS q, median(l_extendedprice) AS e FROM f)
SELECT l_orderkey, l_partkey, round(coalesce(l_quantity, q), 9) AS l_quantity,
       round(coalesce(l_extendedprice, e), 9) AS l_extendedprice, l_returnflag FROM f, s
"""

PREP_FILL_MODE = _FILL_BASE + """,
mq AS (SELECT l_quantity AS q FROM f WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
mr AS (SELECT l_returnflag AS r FROM f WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT l_orderkey, l_partkey, round(coalesce(l_quantity, q), 9) AS l_quantity,
       round(l_extendedprice, 9) AS l_extendedprice, coalesce(l_returnflag, r) AS l_returnflag FROM f, mq, mr
"""

PREP_FILL_CONSTANT = _FILL_BASE + """
SELECT l_orderkey, l_partkey, round(coalesce(l_quantity, 0.0), 9) AS l_quantity,
       round(coalesce(l_extendedprice, 0.0), 9) AS l_extendedprice, coalesce(l_returnflag, '0') AS l_returnflag FROM f
"""

PREP_FIT_THEN_TRANSFORM = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
                  o_orderpriority, o_orderdate FROM orders),
tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01'),
nw AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
med AS (SELECT median(o_totalprice) AS m FROM tr),
trf AS (SELECT coalesce(o_totalprice, m) AS p FROM tr, med),
st AS (SELECT avg(p) AS mu, stddev_samp(p) AS sd FROM trf),
codes AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS code
          FROM (SELECT DISTINCT o_orderpriority FROM tr WHERE o_orderpriority IS NOT NULL))
SELECT nw.o_orderkey, round((coalesce(nw.o_totalprice, m) - mu) / sd, 9) AS o_totalprice,
       codes.code AS o_orderpriority
FROM nw JOIN codes USING (o_orderpriority), med, st
"""

PREP_CHAIN = """
WITH e AS (SELECT DISTINCT event_id, user_id, event_type,
                  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events),
m AS (SELECT avg(value) AS mv FROM e),
f AS (SELECT event_id, user_id, event_type, coalesce(value, mv) AS value FROM e, m),
codes AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS code
          FROM (SELECT DISTINCT event_type FROM f WHERE event_type IS NOT NULL)),
c AS (SELECT f.event_id, f.user_id, codes.code AS event_type, f.value FROM f JOIN codes USING (event_type)),
s AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(user_id) AS mu, stddev_samp(user_id) AS su FROM c)
SELECT event_id, round(CASE WHEN su <> 0 THEN (user_id - mu) / su END, 9) AS user_id, event_type,
       round(CASE WHEN sv <> 0 THEN (value - mv) / sv END, 9) AS value
FROM c, s
"""

# ---------------------------------------------------------------- evaluation

_DOC_PRED = """
p AS (SELECT quality AS label, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS prediction
      FROM labels JOIN documents USING (doc_id)),
cm AS (SELECT label, prediction, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY 1, 2)
"""

EVAL_CONFUSION = f"WITH {_DOC_PRED} SELECT * FROM cm"

EVAL_CLASSIFICATION = f"""
WITH {_DOC_PRED},
cls AS (SELECT label AS cls FROM cm UNION SELECT prediction FROM cm),
per AS (SELECT c.cls,
               coalesce((SELECT sum(n) FROM cm WHERE label = c.cls), 0) * 1.0e0 AS support,
               coalesce((SELECT sum(n) FROM cm WHERE prediction = c.cls), 0) * 1.0e0 AS predicted,
               coalesce((SELECT sum(n) FROM cm WHERE label = c.cls AND prediction = c.cls), 0) * 1.0e0 AS tp
        FROM cls c),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
                CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM per),
m2 AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM m),
a AS (SELECT sum(support) AS n, sum(tp) AS tp, sum(support * pr) AS wp, sum(support * rc) AS wr,
             sum(support * f1) AS wf FROM m2)
SELECT 'accuracy' AS metric, round(tp / n, 9) AS value FROM a
UNION ALL SELECT 'precision', round(wp / n, 9) FROM a
UNION ALL SELECT 'recall', round(wr / n, 9) FROM a
UNION ALL SELECT 'f1', round(wf / n, 9) FROM a
"""

EVAL_REGRESSION = """
WITH t AS (SELECT l_extendedprice AS y, l_quantity * 1500.0e0 AS yh FROM lineitem),
a AS (SELECT avg((y - yh) * (y - yh)) AS mse, avg(abs(y - yh)) AS mae, sum((y - yh) * (y - yh)) AS sse,
             var_pop(y) * count(y) AS sst FROM t)
SELECT 'mse' AS metric, round(mse, 9) AS value FROM a
UNION ALL SELECT 'rmse', round(sqrt(mse), 9) FROM a
UNION ALL SELECT 'mae', round(mae, 9) FROM a
UNION ALL SELECT 'r2', round(CASE WHEN sst <> 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0e0 ELSE 0.0e0 END, 9) FROM a
"""

# ---------------------------------------------------------------- performance


def _period_sql(src: str, with_signup: bool) -> str:
    parts = [
        f"SELECT 'mean_value' AS metric, avg(value) AS value FROM {src}",
        f"SELECT 'purchase_share', avg(CASE WHEN event_type = 'purchase' THEN 1.0e0 ELSE 0.0e0 END) FROM {src}",
        f"SELECT 'error_share', avg(CASE WHEN event_type = 'error' THEN 1.0e0 ELSE 0.0e0 END) FROM {src}",
        f"SELECT 'late_share', avg(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 1.0e0 ELSE 0.0e0 END) FROM {src}",
    ]
    if with_signup:
        parts.append(f"SELECT 'signup_share', avg(CASE WHEN event_type = 'signup' THEN 1.0e0 ELSE 0.0e0 END) FROM {src}")
    return " UNION ALL ".join(parts)


_PERF_BASE = f"""
WITH {_EVENTS_SIDES},
cur2 AS (SELECT ts, event_type, value * 0.8e0 AS value FROM cur),
b AS ({_period_sql("ref", False)}),
c AS ({_period_sql("cur2", True)}),
j AS (SELECT c.metric, b.value AS baseline_value, c.value AS current_value FROM c JOIN b USING (metric)),
ch AS (SELECT *,
              CASE WHEN baseline_value <> 0 THEN (current_value - baseline_value) / abs(baseline_value)
                   WHEN current_value <> 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0e0 END AS relative_change,
              CASE WHEN baseline_value <> 0 THEN (current_value - baseline_value) / abs(baseline_value) * 100.0e0
                   WHEN current_value <> 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0e0 END AS change_pct,
              metric IN ('error_share', 'late_share') AS lower
       FROM j),
d AS (SELECT *, CASE WHEN lower THEN relative_change > 0.1 ELSE relative_change < -0.1 END AS degraded FROM ch)
"""

PERF_CHANGES = _PERF_BASE + """
SELECT metric, round(baseline_value, 9) AS baseline_value, round(current_value, 9) AS current_value,
       round(relative_change, 9) AS relative_change, degraded FROM d
"""

PERF_SUMMARY = _PERF_BASE + """
SELECT CAST((SELECT count_if(degraded) FROM d) AS BIGINT) AS degraded_metrics,
       CAST((SELECT count(*) FROM c) AS BIGINT) AS total_metrics,
       round((SELECT count_if(degraded) FROM d) * 1.0e0 / (SELECT count(*) FROM c), 9) AS degradation_score,
       (SELECT count_if(degraded) FROM d) * 1.0e0 / (SELECT count(*) FROM c) >= 0.3 AS performance_degradation_detected
"""

PERF_REPORT = _PERF_BASE + """
SELECT metric, round(baseline_value, 9) AS baseline_value, round(current_value, 9) AS current_value,
       round(change_pct, 9) AS change_pct,
       CASE WHEN (lower AND change_pct > 10.0) OR (NOT lower AND change_pct < -10.0) THEN 'degraded'
            WHEN (lower AND change_pct < -10.0) OR (NOT lower AND change_pct > 10.0) THEN 'improved'
            ELSE 'unchanged' END AS status
FROM d ORDER BY abs(change_pct) DESC, metric
"""

PERF_REPORT_COUNTS = _PERF_BASE + """,
st AS (SELECT CASE WHEN (lower AND change_pct > 10.0) OR (NOT lower AND change_pct < -10.0) THEN 'degraded'
                   WHEN (lower AND change_pct < -10.0) OR (NOT lower AND change_pct > 10.0) THEN 'improved'
                   ELSE 'unchanged' END AS status FROM d)
SELECT status, CAST(count(*) AS BIGINT) AS n FROM st GROUP BY 1
"""

PERF_REPORT_LONG = _PERF_BASE + """,
w AS (SELECT metric, baseline_value AS "Baseline", current_value AS "Current" FROM d)
SELECT metric, variable, round(value, 9) AS value
FROM (UNPIVOT w ON "Baseline", "Current" INTO NAME variable VALUE value)
"""

# ---------------------------------------------------------------- split

SPLIT_THREE_WAY = """
WITH o AS (SELECT o_orderkey, o_custkey, md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))) AS h FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY h, o_orderkey) - 1 AS rk, count(*) OVER () AS n FROM o),
s AS (SELECT *, CAST(ceil(n * 0.2e0) AS BIGINT) AS hold FROM r),
s2 AS (SELECT *, hold - CAST(ceil(hold * 0.5e0) AS BIGINT) AS nval FROM s)
SELECT o_orderkey, o_custkey,
       CASE WHEN rk < nval THEN 'validation' WHEN rk < hold THEN 'test' ELSE 'train' END AS split
FROM s2
"""

# ---------------------------------------------------------------- history

RUNS_LATEST_METRIC = """
WITH d AS (SELECT 'model_' || CAST(user_id AS VARCHAR) AS model,
                  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS step,
                  avg(value) AS mean_value, CAST(count(*) AS DOUBLE) AS n_events
           FROM events GROUP BY 1, 2),
l AS (UNPIVOT d ON mean_value, n_events INTO NAME metric VALUE value)
SELECT model, metric, max(step) AS last_step, round(arg_max(value, step), 9) AS last_value,
       CAST(count(*) AS BIGINT) AS n_points
FROM l GROUP BY 1, 2
"""

MODELS_LATEST_VERSION = """
WITH v AS (SELECT 'model_' || CAST(user_id AS VARCHAR) AS name,
                  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) + 1 AS version,
                  CASE WHEN event_type = 'purchase' THEN 'Production'
                       WHEN event_type = 'signup' THEN 'Staging' ELSE 'None' END AS stage,
                  CAST(max(event_id) AS VARCHAR) AS run_id
           FROM events GROUP BY 1, 2, 3)
SELECT name, stage, max(version) AS version, arg_max(run_id, version) AS run_id FROM v GROUP BY 1, 2
"""

# ---------------------------------------------------------------- training

TRAIN_LINEAR_ONE_FEATURE = """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM lineitem
"""

# ---------------------------------------------------------------- io

IO_CSV_ROUNDTRIP = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_price_gaps FROM orders
"""

IO_JSON_ROUNDTRIP = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
"""

# ---------------------------------------------------------------- streaming

STREAM_DAILY_DRIFT = """
WITH rc AS (SELECT 'event_type' AS "column", event_type AS value, count(*) AS n_ref FROM events
            WHERE ts < TIMESTAMP '2024-01-15' AND event_type IS NOT NULL GROUP BY 1, 2),
rt AS (SELECT "column", sum(n_ref) AS tot_ref FROM rc GROUP BY 1),
cc AS (SELECT CAST(ts AS DATE) AS day, 'event_type' AS "column", event_type AS value, count(*) AS n
       FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2, 3),
ct AS (SELECT day, "column", sum(n) AS tot_cur FROM cc GROUP BY 1, 2),
b AS (SELECT day, "column", value, sum(n_ref) AS n_ref, sum(n) AS n FROM (
        SELECT ct.day, rc."column", rc.value, rc.n_ref, 0 AS n FROM rc JOIN ct USING ("column")
        UNION ALL SELECT day, "column", value, 0, n FROM cc) GROUP BY 1, 2, 3),
j AS (SELECT b.day, b."column",
             greatest(coalesce(b.n_ref * 1.0e0 / rt.tot_ref, 0.0), 1e-10) AS p,
             greatest(coalesce(b.n * 1.0e0 / ct.tot_cur, 0.0), 1e-10) AS q, rt.tot_ref, ct.tot_cur
      FROM b LEFT JOIN rt USING ("column") JOIN ct USING (day, "column")),
s AS (SELECT day, "column", sum(0.5 * (p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q)))) AS js,
             CAST(max(tot_ref) AS BIGINT) AS n_reference, CAST(max(tot_cur) AS BIGINT) AS n_current
      FROM j GROUP BY 1, 2)
SELECT day, "column", round(js, 9) AS js_divergence, n_reference, n_current, js > 0.1 AS drift_detected FROM s
"""

STREAM_DAILY_NUMERIC = """
WITH e AS (SELECT CAST(ts AS DATE) AS day, ts < TIMESTAMP '2024-01-15' AS is_ref, 'user_id' AS "column", CAST(user_id AS DOUBLE) AS value FROM events
           UNION ALL SELECT CAST(ts AS DATE), ts < TIMESTAMP '2024-01-15', 'value', CAST(value AS DOUBLE) FROM events),
v AS (SELECT * FROM e WHERE day IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
rv AS (SELECT "column", value, count(*) AS n FROM v WHERE is_ref GROUP BY 1, 2),
ru AS (SELECT "column", value, n, sum(n) OVER (PARTITION BY "column" ORDER BY value) AS up, sum(n) OVER (PARTITION BY "column") AS total FROM rv),
cuts AS (SELECT "column", value AS cut, row_number() OVER (PARTITION BY "column" ORDER BY value) AS i
         FROM ru WHERE (up * 256) // total > ((up - n) * 256) // total),
p AS (SELECT v.day, v.is_ref, v."column", coalesce(2 * c.i - CASE WHEN v.value = c.cut THEN 1 ELSE 0 END, 0) AS place
      FROM v ASOF LEFT JOIN cuts c ON v."column" = c."column" AND v.value >= c.cut),
rp AS (SELECT "column", place, count(*) AS n_ref FROM p WHERE is_ref GROUP BY 1, 2),
dp AS (SELECT day, "column", place, count(*) AS n FROM p GROUP BY 1, 2, 3),
g AS (SELECT day, "column", place, sum(n_ref) AS n_ref, sum(n) AS n FROM (
        SELECT d.day, rp."column", rp.place, rp.n_ref, 0 AS n FROM rp JOIN (SELECT DISTINCT day, "column" FROM dp) d USING ("column")
        UNION ALL SELECT day, "column", place, 0, n FROM dp) GROUP BY 1, 2, 3),
w AS (SELECT *, sum(n_ref) OVER o AS ur, sum(n) OVER o AS uc, sum(n_ref) OVER (PARTITION BY day, "column") AS tr, sum(n) OVER (PARTITION BY day, "column") AS tc
      FROM g WINDOW o AS (PARTITION BY day, "column" ORDER BY place)),
b AS (SELECT day, "column", abs(ur * 1.0e0 / tr - uc * 1.0e0 / tc) AS lo,
             CASE WHEN place % 2 = 0 THEN greatest(abs(ur * 1.0e0 / tr - (uc - n) * 1.0e0 / tc), abs(uc * 1.0e0 / tc - (ur - n_ref) * 1.0e0 / tr)) ELSE 0 END AS hi, tr, tc FROM w),
s AS (SELECT day, "column", max(lo) AS lo, greatest(max(lo), max(hi)) AS hi, CAST(max(tr) AS BIGINT) AS n, CAST(max(tc) AS BIGINT) AS m FROM b GROUP BY 1, 2),
l AS (SELECT *, lo * sqrt(n * 1.0e0 * m / (n + m)) AS ll, hi * sqrt(n * 1.0e0 * m / (n + m)) AS lh FROM s),
q AS (SELECT day, "column", sum(power(-1.0e0, k - 1) * exp(-2.0e0 * k * k * ll * ll)) AS sl, sum(power(-1.0e0, k - 1) * exp(-2.0e0 * k * k * lh * lh)) AS sh
      FROM l, range(1, 101) r(k) GROUP BY 1, 2),
t AS (SELECT l.*, CASE WHEN ll < 0.2 THEN 1.0e0 ELSE least(greatest(2.0e0 * sl, 0.0), 1.0) END AS pl,
             CASE WHEN lh < 0.2 THEN 1.0e0 ELSE least(greatest(2.0e0 * sh, 0.0), 1.0) END AS ph FROM l JOIN q USING (day, "column"))
SELECT day, "column", round(lo, 9) AS statistic, round(hi, 9) AS statistic_max, round(pl, 9) AS p_value, n AS n_reference, m AS n_current,
       pl < 0.05 AS drift_detected, (pl < 0.05) = (ph < 0.05) AS decided FROM t
"""

# ---------------------------------------------------------------- declared checks

QUALITY_MISSING_SHARE = f"""
WITH {_LI_NULLS},
w AS (SELECT count(*) AS n,
             CAST(count(*) - count(l_orderkey) AS BIGINT) AS l_orderkey,
             CAST(count(*) - count(l_partkey) AS BIGINT) AS l_partkey,
             CAST(count(*) - count(l_quantity) AS BIGINT) AS l_quantity,
             CAST(count(*) - count(l_extendedprice) AS BIGINT) AS l_extendedprice,
             CAST(count(*) - count(l_returnflag) AS BIGINT) AS l_returnflag,
             CAST(count(*) - count(l_shipdate) AS BIGINT) AS l_shipdate FROM t),
l AS (UNPIVOT w ON l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate
      INTO NAME "column" VALUE null_count)
SELECT "column", null_count, CAST(n AS BIGINT) AS n_rows, round(null_count * 1.0e0 / n, 9) AS missing_share,
       null_count * 1.0e0 / n > 0.1 AS above_threshold FROM l
"""

QUALITY_OUTLIERS = """
WITH so AS (SELECT avg(o_totalprice) AS m1, stddev_samp(o_totalprice) AS s1,
                   avg(o_custkey) AS m2, stddev_samp(o_custkey) AS s2 FROM orders),
se AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
SELECT 'o_totalprice' AS "column", CAST(count_if(abs((o_totalprice - m1) / s1) > 3.0) AS BIGINT) AS n_outliers FROM orders, so
UNION ALL SELECT 'o_custkey', CAST(count_if(abs((o_custkey - m2) / s2) > 3.0) AS BIGINT) FROM orders, so
UNION ALL SELECT 'value', CAST(count_if(abs((value - m) / s) > 3.0) AS BIGINT) FROM events, se
"""

EVAL_ROC_AUC = """
WITH j AS (SELECT quality AS label, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS rk FROM j),
a AS (SELECT sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rs, count_if(label = 1) AS p, count_if(label <> 1) AS n FROM r)
SELECT round((rs - p * (p + 1) / 2.0e0) / (p * n * 1.0e0), 9) AS auc, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg FROM a
"""

PERF_BELOW_FLOOR = EVAL_CLASSIFICATION.replace(
    "SELECT 'accuracy' AS metric", "SELECT metric, value, 0.9e0 AS floor FROM (SELECT 'accuracy' AS metric", 1) + """
) m WHERE value < 0.9
"""

DRIFT_WASSERSTEIN = f"""
WITH {_LINEITEM_LONG},
counts AS (SELECT "column", value, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur
           FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
run AS (SELECT "column", value,
               sum(n_ref) OVER (PARTITION BY "column" ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
               sum(n_cur) OVER (PARTITION BY "column" ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc,
               sum(n_ref) OVER (PARTITION BY "column") AS nr,
               sum(n_cur) OVER (PARTITION BY "column") AS nc,
               lead(value) OVER (PARTITION BY "column" ORDER BY value) AS nxt
        FROM counts),
w AS (SELECT "column", sum(abs(cr * 1.0e0 / nr - cc * 1.0e0 / nc) * coalesce(nxt - value, 0.0)) AS wd
      FROM run GROUP BY 1),
sd AS (SELECT "column", stddev_pop(value) AS sd FROM long WHERE is_ref = 1 GROUP BY 1)
SELECT "column", round(wd, 9) AS wasserstein, round(sd, 9) AS reference_std,
       round(CASE WHEN sd <> 0 THEN wd / sd END, 9) AS wasserstein_norm,
       coalesce(CASE WHEN sd <> 0 THEN wd / sd END > 0.1, false) AS drift_detected
FROM w JOIN sd USING ("column")
"""

SPLIT_KFOLD = """
SELECT o_orderkey, o_orderpriority,
       CAST((row_number() OVER (PARTITION BY o_orderpriority
                                ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 5
            AS BIGINT) AS fold
FROM orders
"""

SPLIT_STRATIFIED = """
WITH r AS (SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n,
                  row_number() OVER (PARTITION BY o_orderpriority
                                     ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1 AS rk
           FROM orders),
s AS (SELECT *, CAST(ceil(n * 0.2e0) AS BIGINT) AS hold FROM r)
SELECT o_orderkey, o_orderpriority,
       CASE WHEN rk < hold - CAST(ceil(hold * 0.5e0) AS BIGINT) THEN 'validation' WHEN rk < hold THEN 'test' ELSE 'train' END AS split
FROM s
"""

_LINES_OF_PARTS = """
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_partkey END AS l_partkey, l_returnflag FROM lineitem)
"""
PREP_ONE_HOT_VECTOR = _LINES_OF_PARTS + """,
c AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS code, count(*) OVER () AS n FROM (SELECT DISTINCT l_partkey FROM t WHERE l_partkey IS NOT NULL))
SELECT l_orderkey, l_linenumber, '(' || (SELECT max(n) FROM c) || ',[' || coalesce(CAST(code AS VARCHAR), '') || '],['
       || CASE WHEN code IS NULL THEN '' ELSE '1.0' END || '])' AS part FROM t LEFT JOIN c USING (l_partkey)
"""
PREP_ONE_HOT_LONG = _LINES_OF_PARTS + """
SELECT l_orderkey, l_linenumber, 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS category FROM t WHERE l_partkey IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag FROM t WHERE l_returnflag IS NOT NULL
"""

MODEL_NEWEST_SAVED = """
SELECT l_returnflag, 'sizes' AS model_name, '2' AS model_version, count(*) AS n_right FROM lineitem GROUP BY 1
"""

TRAIN_CV = """
WITH r AS (SELECT l_quantity > 25 AS yes, (row_number() OVER (PARTITION BY l_quantity > 25) - 1) % 3 AS fold FROM lineitem)
SELECT CAST(fold AS BIGINT) AS fold, count(*) AS n_scored, count(*) FILTER (yes) AS n_yes, CAST(4 AS BIGINT) AS n_metrics, true AS beats_rival
FROM r GROUP BY 1
"""

MODELS_LATEST_PRODUCTION = MODELS_LATEST_VERSION.replace(
    "FROM v GROUP BY 1, 2", "FROM v WHERE stage = 'Production' GROUP BY 1, 2")

RUNS_LATEST_BASELINE = """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS as_of, avg(value) AS mean_value,
                  CAST(count(*) AS DOUBLE) AS n_events,
                  avg(CASE WHEN event_type = 'error' THEN 1.0e0 ELSE 0.0e0 END) AS error_share
           FROM events GROUP BY 1),
l AS (UNPIVOT d ON mean_value, n_events, error_share INTO NAME metric VALUE value)
SELECT metric, round(value, 9) AS value FROM l WHERE as_of = (SELECT max(as_of) FROM l)
"""

# ---------------------------------------------------------------- models: facts of the held-out splits


def _split_sql(table: str, keys: str) -> str:
    """CTEs ending in ``tagged`` (with ``split``) for the split of ``table`` by ``keys``."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys.split(", "))
    return f"""
WITH o AS (SELECT *, md5(concat_ws('|', '42', {text})) AS h FROM {table}),
r AS (SELECT *, row_number() OVER (ORDER BY h, {keys}) - 1 AS rk, count(*) OVER () AS n FROM o),
s AS (SELECT *, CAST(ceil(n * 0.2e0) AS BIGINT) AS hold FROM r),
s2 AS (SELECT *, hold - CAST(ceil(hold * 0.5e0) AS BIGINT) AS nval FROM s),
tagged AS (SELECT *, CASE WHEN rk < nval THEN 'validation' WHEN rk < hold THEN 'test' ELSE 'train' END AS split FROM s2)
"""


def _model_facts(table: str, keys: str, floor: bool = True) -> str:
    return _split_sql(table, keys) + f"""
SELECT split, count(*) AS n_rows, count(*) AS n_scored, true AS predictions_known,
       true AS probabilities_sum_to_one, true AS metrics_in_range{", true AS beats_rival" if floor else ""}
FROM tagged WHERE split <> 'train' GROUP BY 1
"""


_LI_KEYS = "l_orderkey, l_linenumber"
_TIER = "CASE WHEN l_discount < 0.035 THEN 'low' WHEN l_discount < 0.075 THEN 'mid' ELSE 'high' END"
MODEL_ORACLES = {
    "train_rf_cls": _model_facts("lineitem", _LI_KEYS),
    "train_rf_reg": _model_facts("lineitem", _LI_KEYS),
    "train_gbt_cls": _model_facts("lineitem", _LI_KEYS),
    "train_gbt_multi": _model_facts("lineitem", _LI_KEYS),
    "train_gbt_reg": _model_facts("lineitem", _LI_KEYS),
    "train_logreg": _model_facts("lineitem", _LI_KEYS),
    "train_rf_embeddings": _model_facts("embeddings", "vec_id", floor=False),
    "train_feature_importance": """
WITH t AS (SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS l_ship_days,
                  CASE WHEN l_discount >= 0.05 THEN 4 ELSE 0 END + CASE WHEN l_tax >= 0.035 THEN 1 ELSE 0 END AS steps FROM lineitem),
c AS (SELECT corr(steps, l_quantity) AS l_quantity, corr(steps, l_extendedprice) AS l_extendedprice, corr(steps, l_discount) AS l_discount,
             corr(steps, l_tax) AS l_tax, corr(steps, l_ship_days) AS l_ship_days FROM t),
l AS (UNPIVOT c ON l_quantity, l_extendedprice, l_discount, l_tax, l_ship_days INTO NAME feature VALUE r)
SELECT feature, CASE WHEN r * r > 0.01 THEN rank() OVER (ORDER BY r * r DESC) ELSE 0 END AS place FROM l
""",
    "score_batch": f"""
SELECT l_orderkey, l_linenumber, {_TIER} AS prediction, 1.0e0 AS confidence, count(*) OVER () AS batch_size,
       'tier_rf' AS model_name, '1' AS model_version FROM lineitem
""",
    "stream_score": f"""
SELECT l_orderkey, l_linenumber, {_TIER} AS prediction, 1.0e0 AS confidence, 'tier_rf' AS model_name, '1' AS model_version FROM lineitem
""",
    "model_registry": """
SELECT c_mktsegment, 'balance' AS model_name, '2' AS model_version, (SELECT count(*) FROM customer) AS batch_size, count(*) AS n_scored
FROM customer GROUP BY 1
""",
}

# ---------------------------------------------------------------- NaN, odd names, mixed types

_LI_NANS = """
t AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS q,
             CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_tax END AS x FROM lineitem)
"""

NAN_ORACLES = {
    "quality_nan_counts": f"""
WITH {_LI_NANS}
SELECT 'l_orderkey' AS "column", count(*) - count(l_orderkey) AS null_count FROM t
UNION ALL SELECT 'l_linenumber', count(*) - count(l_linenumber) FROM t
UNION ALL SELECT 'l.quantity', count(*) - count(q) FROM t
UNION ALL SELECT 'l_tax', count(*) - count(x) FROM t
""",
    "prep_nan_fill_scale": f"""
WITH {_LI_NANS},
f AS (SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT avg(q) FROM t)) AS q, x FROM t)
SELECT l_orderkey, l_linenumber, round((q - (SELECT avg(q) FROM f)) / (SELECT stddev_samp(q) FROM f), 9) AS l_quantity,
       round((x - (SELECT avg(x) FROM f)) / (SELECT stddev_samp(x) FROM f), 9) AS l_tax FROM f
""",
    "prep_nan_one_hot": f"""
WITH {_LI_NANS},
f AS (SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT median(q) FROM t)) AS q, x,
             CASE WHEN x = 0.04 THEN 1 ELSE 0 END AS four FROM t)
SELECT l_orderkey, l_linenumber, q AS l_quantity, CASE WHEN x = 0.0 THEN 1 ELSE 0 END AS tax_0,
       round((four - (SELECT avg(four) FROM f)) / (SELECT stddev_samp(four) FROM f), 9) AS tax_4,
       CASE WHEN x = 0.08 THEN 1 ELSE 0 END AS tax_8, 3 + (SELECT count(DISTINCT x) FROM t) AS n_columns
FROM f
""",
    "prep_polynomial": """
WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS qq, l_quantity * l_discount AS qd, l_discount * l_discount AS dd FROM lineitem)
SELECT l_orderkey, l_linenumber, round(qq, 9) AS qq, round((qd - (SELECT avg(qd) FROM t)) / (SELECT stddev_samp(qd) FROM t), 9) AS qd,
       round(dd, 9) AS dd FROM t
""",
    "drift_nan_ks": f"""
WITH {_LI_NANS},
long AS (SELECT 'l.quantity' AS "column", q AS value, CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS is_ref FROM t),
{_KS_FROM_LONG}
SELECT "column", round(d, 9) AS statistic, n AS n_reference, m AS n_current FROM pv
""",
    "eval_mixed_types": EVAL_CLASSIFICATION,
    "io_csv_text_roundtrip": """
SELECT doc_id, md5(' "' || text || '", said ') AS quoted_md5, CAST(doc_id % 10 AS VARCHAR) || 'D' AS code FROM documents
""",
    "runs_latest_without_steps": """
SELECT event_type AS model, 'value' AS metric, CAST(NULL AS BIGINT) AS last_step,
       round(arg_max(value, struct_pack(t := ts, v := value)), 9) AS last_value, count(*) AS n_points
FROM events GROUP BY 1
""",
    "drift_chi_square": f"""
WITH {_EVENTS_SIDES},
c AS (SELECT event_type, sum(r) AS n_ref, sum(1 - r) AS n_cur
      FROM (SELECT event_type, 1 AS r FROM ref UNION ALL SELECT event_type, 0 FROM cur) GROUP BY 1),
e AS (SELECT n_cur, n_ref * 1.0e0 * (SELECT sum(n_cur) FROM c) / (SELECT sum(n_ref) FROM c) AS x FROM c),
x AS (SELECT sum((n_cur - x) * (n_cur - x) / x) AS stat, count(*) - 1 AS dof FROM e)
SELECT 'event_type' AS "column", round(stat, 9) AS statistic, dof AS degrees_of_freedom,
       round(exp(-stat / 2) * (1 + stat / 2), 9) AS p_value, exp(-stat / 2) * (1 + stat / 2) < 0.05 AS drift_detected FROM x
""",
    "drift_proportions": f"""
WITH {_EVENTS_SIDES},
u AS (SELECT 1 AS r, * FROM ref UNION ALL SELECT 0, * FROM cur),
v AS (SELECT 'parity' AS "column", r, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS hit FROM u
      UNION ALL SELECT 'signup', r, CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END FROM u),
a AS (SELECT "column", sum(r) * 1.0e0 AS n, sum(1 - r) * 1.0e0 AS m, sum(r * hit) * 1.0e0 AS k, sum((1 - r) * hit) * 1.0e0 AS l FROM v GROUP BY 1),
z AS (SELECT "column", (k / n - l / m) / sqrt((k + l) / (n + m) * (1 - (k + l) / (n + m)) * (1 / n + 1 / m)) AS z FROM a),
p AS (SELECT "column", any_value(z) AS z,
             1 - 2 / sqrt(pi()) * sum(power(-1.0e0, i) * power(abs(z) / sqrt(2.0e0), 2 * i + 1) / (gamma(i + 1.0e0) * (2 * i + 1))) AS p
      FROM z, range(0, 60) g(i) GROUP BY 1)
SELECT "column", round(z, 9) AS statistic, round(p, 9) AS p_value, p < 0.05 AS drift_detected FROM p
""",
}

JOB_ORACLES = {
    "job_data": PREP_LABEL_ENCODE,
    "job_data_gate": """
SELECT true AS refused, false AS recorded_valid, count(*) AS raw_rows, CAST(2 AS BIGINT) AS raw_columns,
       count(*) - count(DISTINCT (l_returnflag, l_linestatus)) AS duplicates FROM lineitem
""",
    "job_monitoring": DRIFT_COLUMNS,
    "sink_metrics": _PERF_BASE[:_PERF_BASE.index("j AS (")].rstrip().rstrip(",") + """
SELECT 'active' AS source, metric, round(value, 9) AS value FROM c UNION ALL SELECT 'object', metric, round(value, 9) FROM b
""",
    "job_all": """
SELECT 'sides' AS model, unnest(['accuracy', 'f1', 'test_accuracy', 'test_f1']) AS metric, true AS in_range,
       (SELECT count(*) FROM customer) AS processed_rows, CAST(1 AS BIGINT) AS params_logged
""",
}

ORACLE_SQL: dict[str, str] = {
    **MODEL_ORACLES,
    **JOB_ORACLES,
    **NAN_ORACLES,
    "stream_daily_drift_windowed": STREAM_DAILY_DRIFT,
    "models_latest_production": MODELS_LATEST_PRODUCTION,
    "runs_latest_baseline": RUNS_LATEST_BASELINE,
    "perf_report_counts": PERF_REPORT_COUNTS,
    "perf_report_long": PERF_REPORT_LONG,
    "split_kfold": SPLIT_KFOLD,
    "split_stratified": SPLIT_STRATIFIED,
    "prep_one_hot_vector": PREP_ONE_HOT_VECTOR,
    "prep_one_hot_long": PREP_ONE_HOT_LONG,
    "drift_preset": DRIFT_PRESET,
    "drift_preset_share": DRIFT_PRESET_SHARE,
    "model_newest_saved": MODEL_NEWEST_SAVED,
    "train_cv": TRAIN_CV,
    "stream_daily_numeric": STREAM_DAILY_NUMERIC,
    "drift_wasserstein": DRIFT_WASSERSTEIN,
    "quality_missing_share": QUALITY_MISSING_SHARE,
    "quality_outliers": QUALITY_OUTLIERS,
    "eval_roc_auc": EVAL_ROC_AUC,
    "perf_below_floor": PERF_BELOW_FLOOR,
    "stream_daily_drift": STREAM_DAILY_DRIFT,
    "io_csv_roundtrip": IO_CSV_ROUNDTRIP,
    "io_json_roundtrip": IO_JSON_ROUNDTRIP,
    "io_json_columns": "SELECT *, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_gaps FROM customer",
    "train_linear_one_feature": TRAIN_LINEAR_ONE_FEATURE,
    "eval_confusion": EVAL_CONFUSION,
    "eval_classification": EVAL_CLASSIFICATION,
    "eval_regression": EVAL_REGRESSION,
    "perf_changes": PERF_CHANGES,
    "perf_summary": PERF_SUMMARY,
    "perf_report": PERF_REPORT,
    "split_three_way": SPLIT_THREE_WAY,
    "runs_latest_metric": RUNS_LATEST_METRIC,
    "models_latest_version": MODELS_LATEST_VERSION,
    "quality_null_counts": QUALITY_NULL_COUNTS,
    "quality_duplicates": QUALITY_DUPLICATES,
    "quality_validate": QUALITY_VALIDATE,
    "quality_types": QUALITY_TYPES,
    "prep_drop_duplicates": PREP_DROP_DUPLICATES,
    "prep_drop_columns": PREP_DROP_COLUMNS,
    "prep_label_encode": PREP_LABEL_ENCODE,
    "prep_one_hot": PREP_ONE_HOT,
    "prep_one_hot_drop_first": PREP_ONE_HOT_DROP_FIRST,
    "prep_scale": PREP_SCALE,
    "prep_fill_mean": PREP_FILL_MEAN,
    "prep_fill_median": PREP_FILL_MEDIAN,
    "prep_fill_mode": PREP_FILL_MODE,
    "prep_fill_constant": PREP_FILL_CONSTANT,
    "prep_fit_then_transform": PREP_FIT_THEN_TRANSFORM,
    "prep_chain": PREP_CHAIN,
    "drift_categorical": DRIFT_CATEGORICAL,
    "drift_numeric_ks": DRIFT_NUMERIC_KS,
    "drift_numeric_pvalue": DRIFT_NUMERIC_PVALUE,
    "drift_columns": DRIFT_COLUMNS,
    "drift_summary": DRIFT_SUMMARY,
    "drift_retrain_signal": DRIFT_RETRAIN_SIGNAL,
    "drift_column_mismatch": DRIFT_COLUMN_MISMATCH,
}


def _positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB keeps the
    sign of a rounded tiny negative (-0.0) where Spark returns 0.0."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("(round(" + _positive_zero_rounds(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1


ORACLE_SQL = {k: _positive_zero_rounds(v) for k, v in ORACLE_SQL.items()}
