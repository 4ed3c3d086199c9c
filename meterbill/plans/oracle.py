"""Oracle SQL (DuckDB dialect) for every registered query.

The fixtures are re-derived in SQL from the driver's tables, and each
metric is written the plain relational way (per-city COUNT(DISTINCT ...)
and regrouping, fan-out joins, window functions), independent of the
Spark plan shapes, so a match checks the rewrite as well as the arithmetic.
"""

from __future__ import annotations

from meterbill.functions.regions import region_sql
from meterbill.sources import fixtures as FX


def _values(rows, types):
    def lit(v, t):
        if v is None:
            return "NULL"
        if t == "str":
            return "'" + str(v).replace("'", "''") + "'"
        if t == "dbl":
            return f"CAST({v!r} AS DOUBLE)"
        return f"CAST({int(v)} AS INTEGER)"
    return ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)


REGION = region_sql

CTE = {}

CTE["customers"] = """SELECT concat('2126', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS customer_id,
  c_name AS customer_name, 'postpaid' AS subscription_type,
  CASE WHEN c_custkey % 17 = 4 THEN 'RP_NORATE' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'RP_STUDENT'
       WHEN c_mktsegment = 'MACHINERY' THEN 'RP_PREMIUM' ELSE 'RP_BASIC' END AS rate_plan_id,
  CAST(DATE '2018-01-15' + CAST((c_custkey * 37) % 2200 AS INTEGER) AS DATE) AS activation_date,
  CASE WHEN c_custkey % 10 = 3 THEN 'suspended' WHEN c_custkey % 10 = 7 THEN 'terminated' ELSE 'active' END AS status,
  CASE c_nationkey % 14 WHEN 0 THEN 'CASABLANCA' WHEN 1 THEN 'RABAT' WHEN 2 THEN 'Salé' WHEN 3 THEN 'marrakech'
       WHEN 4 THEN ' TANGER ' WHEN 5 THEN 'OUJDA' WHEN 6 THEN 'PARIS' WHEN 7 THEN 'AGADIR' WHEN 8 THEN 'FES'
       WHEN 9 THEN 'KENITRA' WHEN 10 THEN 'Casablanca' WHEN 11 THEN 'MEKNES' WHEN 12 THEN 'TETOUAN'
       ELSE NULL END AS region,
  c_mktsegment = 'HOUSEHOLD' AS is_student
FROM customer"""

CTE["product_rates"] = ("SELECT * FROM (VALUES " + _values(FX.RATE_ROWS, ["str", "str", "dbl", "int"])
                        + ") t(rate_plan_id, service_type, unit_price, free_units)")
CTE["rate_plans"] = ("SELECT * FROM (VALUES " + _values(FX.PLAN_ROWS, ["str", "str"])
                     + ") t(rate_plan_id, plan_name)")
CTE["product_catalog"] = ("SELECT * FROM (VALUES " + _values(FX.CATALOG_ROWS, ["str"] * 4)
                          + ") t(product_code, service_type, unit, rate_type)")
CTE["active"] = "SELECT customer_id, rate_plan_id, activation_date, is_student FROM customers WHERE status = 'active'"

CTE["ev"] = "SELECT e.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events e"
CTE["ev2"] = "SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 50 = 0"
CTE["usage_src"] = """SELECT event_id AS "offset",
  CASE event_type WHEN 'click' THEN 'voice' WHEN 'signup' THEN 'voice' WHEN 'view' THEN 'data'
       WHEN 'purchase' THEN 'sms' ELSE 'ping' END AS record_type,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
  ts AS event_ts,
  CASE WHEN k % 25 = 0 THEN NULL WHEN k % 25 = 1 THEN '999000000000' WHEN k % 25 = 2 THEN '33612345678'
       WHEN k % 25 = 3 THEN concat('2129', lpad(CAST(user_id AS VARCHAR), 8, '0'))
       ELSE concat('2126', lpad(CAST(user_id AS VARCHAR), 8, '0')) END AS msisdn,
  CASE WHEN event_type = 'view' THEN NULL WHEN k % 3 = 0 THEN concat('+33', lpad(CAST(k AS VARCHAR), 9, '0'))
       ELSE concat('2126', lpad(CAST(k AS VARCHAR), 8, '0')) END AS peer_id,
  CASE WHEN event_type IN ('click', 'signup') THEN CASE WHEN k % 20 = 5 THEN -1
       ELSE CAST(floor(value) AS INTEGER) + 10 END END AS duration_sec,
  CASE WHEN event_type = 'view' THEN value END AS data_volume_mb,
  CASE WHEN event_type = 'view' THEN CAST(floor(value) AS INTEGER) * 10 + 30 END AS session_duration_sec,
  concat(CASE k % 6 WHEN 0 THEN 'CASABLANCA' WHEN 1 THEN 'RABAT' WHEN 2 THEN 'AGADIR' WHEN 3 THEN 'MARRAKECH'
         WHEN 4 THEN 'TANGER' ELSE 'OUJDA' END, '_', lpad(CAST(k % 50 + 1 AS VARCHAR), 2, '0')) AS cell_id,
  CASE k % 4 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' ELSE '5G' END AS technology
FROM ev2"""
CTE["raw_fields"] = """SELECT "offset", record_type, "timestamp",
  CASE WHEN record_type NOT IN ('sms', 'data') THEN msisdn END AS caller_id,
  CASE WHEN record_type NOT IN ('sms', 'data') THEN peer_id END AS callee_id,
  CASE WHEN record_type = 'sms' THEN msisdn END AS sender_id,
  CASE WHEN record_type = 'sms' THEN peer_id END AS receiver_id,
  CASE WHEN record_type = 'data' THEN msisdn END AS user_id,
  duration_sec, session_duration_sec, data_volume_mb, cell_id, technology, event_ts
FROM usage_src"""
CTE["validated"] = """SELECT *, CASE WHEN reason IS NULL THEN 'ok' ELSE 'error' END AS status,
  sha256(concat_ws('|', "timestamp", msisdn, record_type)) AS record_hash
FROM (SELECT *, CASE WHEN msisdn IS NULL THEN 'null_msisdn'
        WHEN NOT regexp_matches(msisdn, '^212[0-9]+') THEN 'bad_prefix'
        WHEN starts_with(msisdn, '999') THEN 'blocked_prefix'
        WHEN duration_sec < 0 OR data_volume_mb < 0 OR session_duration_sec < 0 THEN 'negative_measure'
        END AS reason FROM usage_src)"""
CTE["mediated_all"] = """SELECT * FROM validated QUALIFY row_number() OVER (PARTITION BY record_hash ORDER BY
  CASE WHEN status = 'ok' THEN 0 ELSE 1 END, record_type NULLS FIRST, "timestamp" NULLS FIRST,
  msisdn NULLS FIRST, peer_id NULLS FIRST, duration_sec NULLS FIRST, data_volume_mb NULLS FIRST,
  session_duration_sec NULLS FIRST, cell_id NULLS FIRST, technology NULLS FIRST, status NULLS FIRST,
  "offset" NULLS FIRST) = 1"""
NORM_SELECT = """record_type, CAST(event_ts AS TIMESTAMP) AS "timestamp", msisdn, peer_id, duration_sec,
  data_volume_mb, session_duration_sec, cell_id, technology, status, record_hash"""
CTE["normalized"] = f"SELECT {NORM_SELECT} FROM mediated_all WHERE status = 'ok'"

CTE["joined"] = """SELECT n.*, a.customer_id, a.rate_plan_id, a.activation_date, a.is_student, r.unit_price
FROM normalized n LEFT JOIN active a ON n.msisdn = a.customer_id
LEFT JOIN product_rates r ON a.rate_plan_id = r.rate_plan_id AND n.record_type = r.service_type"""
CTE["matched"] = """SELECT *, hour("timestamp") AS hr, dayofweek("timestamp") AS wd FROM joined
WHERE customer_id IS NOT NULL AND unit_price IS NOT NULL"""
VOICE_COST = """CAST(COALESCE(CAST(duration_sec AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(10,4))
  * (CASE WHEN coalesce(hr >= 8 AND hr < 20, false) THEN 1.20 ELSE 1.00 END)
  * (CASE WHEN coalesce(wd IN (5, 6), false) THEN 0.90 ELSE 1.00 END)
  * (CASE WHEN coalesce(NOT starts_with(peer_id, '212'), false) THEN 2.00 ELSE 1.00 END), 0) AS DECIMAL(18,6))"""
DATA_COST = ("CAST(COALESCE(CAST(data_volume_mb AS DECIMAL(24,6)) * CAST(unit_price AS DECIMAL(10,4)), 0) "
             "AS DECIMAL(18,6))")
SMS_COST = "CAST(COALESCE(CAST(unit_price AS DECIMAL(10,4)), 0) AS DECIMAL(18,6))"
CTE["priced"] = f"""SELECT *, CASE record_type WHEN 'voice' THEN {VOICE_COST} WHEN 'data' THEN {DATA_COST}
  WHEN 'sms' THEN {SMS_COST} ELSE CAST(0 AS DECIMAL(18,6)) END AS base_cost,
  coalesce(activation_date <= DATE '2023-01-31', false) AS loyal, coalesce(is_student, false) AS student
FROM matched"""
CTE["rated"] = """SELECT record_hash, record_type, "timestamp", msisdn, peer_id, duration_sec, data_volume_mb,
  session_duration_sec, cell_id, technology, status, customer_id, rate_plan_id,
  CAST(unit_price AS DECIMAL(10,4)) AS unit_price, base_cost,
  CAST(base_cost * (CASE WHEN loyal THEN 0.95 ELSE 1.00 END) * (CASE WHEN student THEN 0.90 ELSE 1.00 END)
       AS DECIMAL(18,6)) AS final_cost,
  NULLIF(concat_ws(',', CASE WHEN loyal THEN 'loyalty_5%' END, CASE WHEN student THEN 'student_10%' END), '')
    AS discount_applied,
  'rated' AS rating_status
FROM priced
UNION ALL
SELECT record_hash, NULL, CAST(NULL AS TIMESTAMP), msisdn, NULL, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE),
  CAST(NULL AS INTEGER), NULL, NULL, NULL, NULL, NULL, CAST(NULL AS DECIMAL(10,4)), CAST(NULL AS DECIMAL(18,6)),
  CAST(NULL AS DECIMAL(18,6)), NULL, 'unmatched'
FROM joined WHERE customer_id IS NULL OR unit_price IS NULL"""

CTE["invoices_hist"] = """SELECT invoice_id, concat('2126', lpad(CAST(o_custkey AS VARCHAR), 8, '0')) AS customer_id,
  billing_period, total_base_cost, total_discount, tax_applied,
  CAST(round(total_base_cost - total_discount + tax_applied + CAST(1 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
    AS total_final_cost
FROM (SELECT *, CAST(round((total_base_cost - total_discount) * CAST(0.20 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
        AS tax_applied
      FROM (SELECT *, CAST(round(total_base_cost * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS total_discount
            FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_period,
                         min(o_orderkey) AS invoice_id,
                         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_base_cost
                  FROM orders GROUP BY 1, 2)))"""
CTE["rated_hist"] = """SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS record_hash,
  CASE l_returnflag WHEN 'A' THEN 'voice' WHEN 'R' THEN 'data' ELSE 'sms' END AS record_type,
  CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
  concat('2126', lpad(CAST(o_custkey AS VARCHAR), 8, '0')) AS customer_id,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INTEGER) * 6 END AS duration_sec,
  CASE WHEN l_returnflag = 'R' THEN l_quantity END AS data_volume_mb,
  CAST(l_tax AS DECIMAL(10,4)) AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,6)) AS base_cost,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3))
       * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,6)) AS final_cost,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'unmatched' ELSE 'rated' END AS rating_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTE["enriched"] = f"""SELECT i.invoice_id, i.customer_id, c.customer_name, i.billing_period,
  CAST(i.total_base_cost AS DOUBLE) AS total_base_cost, CAST(i.total_discount AS DOUBLE) AS total_discount,
  CAST(i.tax_applied AS DOUBLE) AS tax_applied, CAST(i.total_final_cost AS DOUBLE) AS total_final_cost,
  c.rate_plan_id, c.region, c.is_student, c.activation_date, {REGION('c.region')} AS region_mapped
FROM invoices_hist i LEFT JOIN customers c ON i.customer_id = c.customer_id"""

# ---- billing for 2024-01 (as_of 2024-01-31) ------------------------------
PERIOD_RANGE = """"timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-02-01'"""
CTE["b_usage"] = f"""SELECT customer_id, count(*) AS usage_records,
  CAST(sum(final_cost) AS DECIMAL(24,6)) AS usage_cost,
  CAST(coalesce(sum(CASE WHEN record_type = 'voice' THEN CAST(duration_sec AS BIGINT) END), 0) AS DECIMAL(24,6))
    AS voice_usage,
  CAST(count(CASE WHEN record_type = 'sms' THEN 1 END) AS DECIMAL(24,6)) AS sms_usage,
  CAST(coalesce(sum(CASE WHEN record_type = 'data' THEN CAST(data_volume_mb AS DECIMAL(24,6)) END), 0)
       AS DECIMAL(24,6)) AS data_usage
FROM rated WHERE rating_status = 'rated' AND {PERIOD_RANGE} GROUP BY customer_id"""
CTE["billable"] = """SELECT c.customer_id, c.rate_plan_id, c.activation_date, c.is_student, u.usage_records,
  u.usage_cost, u.voice_usage, u.sms_usage, u.data_usage
FROM customers c JOIN b_usage u ON c.customer_id = u.customer_id
WHERE c.status = 'active' AND NOT EXISTS (SELECT 1 FROM invoices_hist h
  WHERE h.customer_id = c.customer_id AND h.billing_period = DATE '2024-01-01')"""
CTE["fu_lines"] = """SELECT b.customer_id, r.service_type AS service,
  CAST(coalesce(CASE r.service_type WHEN 'voice' THEN b.voice_usage WHEN 'sms' THEN b.sms_usage
       WHEN 'data' THEN b.data_usage ELSE 0 END, 0) AS DECIMAL(24,6)) AS total_usage,
  CAST(r.free_units * CASE r.service_type WHEN 'voice' THEN 60 ELSE 1 END AS DECIMAL(24,6)) AS free_allowance,
  r.unit_price
FROM billable b JOIN product_rates r ON r.rate_plan_id = b.rate_plan_id WHERE r.free_units > 0"""
CTE["fu"] = """SELECT *, least(total_usage, free_allowance) AS free_used,
  CAST(least(total_usage, free_allowance) * CAST(unit_price AS DECIMAL(10,4)) AS DECIMAL(24,6)) AS credit
FROM fu_lines"""
CTE["terms"] = """SELECT *, taxable + tax + 1.00 AS total_due FROM (
 SELECT *, taxable * 0.20 AS tax FROM (
  SELECT *, greatest(0, adjusted - discount) AS taxable FROM (
   SELECT *, loyalty_discount + student_discount AS discount FROM (
    SELECT *, CASE WHEN is_loyal THEN adjusted * 0.05 ELSE 0 END AS loyalty_discount,
              CASE WHEN student THEN adjusted * 0.10 ELSE 0 END AS student_discount FROM (
     SELECT b.*, coalesce(f.credit, CAST(0 AS DECIMAL(24,6))) AS credit, coalesce(f.n_lines, 0) AS n_lines,
       CAST(greatest(CAST(0 AS DECIMAL(24,6)), b.usage_cost - coalesce(f.credit, 0)) AS DECIMAL(24,6)) AS adjusted,
       coalesce((2024 - year(b.activation_date)) * 12 + (1 - month(b.activation_date)) > 12, false) AS is_loyal,
       coalesce(b.is_student, false) AS student
     FROM billable b LEFT JOIN (SELECT customer_id, CAST(sum(credit) AS DECIMAL(24,6)) AS credit, count(*) AS n_lines
                                FROM fu GROUP BY customer_id) f ON b.customer_id = f.customer_id)))))"""
CTE["new_invoices"] = """SELECT 1 AS invoice_id, customer_id, DATE '2024-01-01' AS billing_period,
  CAST(round(usage_cost, 2) AS DECIMAL(18,2)) AS total_base_cost,
  CAST(round(discount + credit, 2) AS DECIMAL(18,2)) AS total_discount,
  CAST(round(tax, 2) AS DECIMAL(18,2)) AS tax_applied,
  CAST(round(total_due, 2) AS DECIMAL(18,2)) AS total_final_cost
FROM terms"""

# ---- invoice-history analytics (as_of 2001-08-01) ------------------------
CTE["monthly"] = """SELECT CAST(date_trunc('month', billing_period) AS DATE) AS month,
  CAST(round(sum(total_final_cost), 2) AS DOUBLE) AS total_revenue, count(*) AS total_invoices,
  round(CAST(sum(total_final_cost) AS DOUBLE) / count(*), 4) AS avg_invoice
FROM invoices_hist WHERE billing_period >= DATE '2000-08-01' GROUP BY 1"""
CTE["metrics"] = """SELECT count(*) AS total_customers,
  count(CASE WHEN status = 'active' THEN 1 END) AS active_customers,
  count(CASE WHEN is_student THEN 1 END) AS student_customers,
  round(CAST(sum(yrs) AS DOUBLE) / count(yrs), 4) AS avg_customer_age_years
FROM (SELECT *, date_part('year', age(DATE '2024-01-31', activation_date)) AS yrs FROM customers)"""


def _region_city(invoices: str, since: str) -> str:
    return f"""SELECT c.region AS city, COUNT(DISTINCT i.customer_id) AS customer_count,
  COUNT(i.invoice_id) AS invoice_count, SUM(i.total_final_cost) AS total_revenue,
  SUM(i.total_base_cost) AS total_base_cost, SUM(i.total_discount) AS total_discount, SUM(i.tax_applied) AS total_tax
FROM {invoices} i JOIN customers c ON i.customer_id = c.customer_id
WHERE i.billing_period >= DATE '{since}' GROUP BY c.region"""


def _region_regroup(city_cte: str) -> str:
    return f"""SELECT {REGION('city')} AS region, CAST(sum(customer_count) AS BIGINT) AS customer_count,
  CAST(sum(invoice_count) AS BIGINT) AS invoice_count, CAST(round(sum(total_revenue), 2) AS DOUBLE) AS total_revenue,
  CAST(round(sum(total_base_cost), 2) AS DOUBLE) AS total_base_cost,
  CAST(round(sum(total_discount), 2) AS DOUBLE) AS total_discount,
  CAST(round(sum(total_tax), 2) AS DOUBLE) AS total_tax
FROM {city_cte} GROUP BY 1"""


CTE["rr_city"] = _region_city("invoices_hist", "2000-08-01")
CTE["region_rev"] = _region_regroup("rr_city")
CTE["e2e_city"] = _region_city("(SELECT * FROM invoices_hist UNION ALL SELECT * FROM new_invoices)", "2023-01-31")
CTE["e2e_region"] = _region_regroup("e2e_city")
CTE["rm_city"] = """SELECT date_trunc('month', i.billing_period) AS month, c.region AS city,
  SUM(i.total_final_cost) AS monthly_revenue, COUNT(i.invoice_id) AS monthly_invoices,
  COUNT(DISTINCT i.customer_id) AS active_customers
FROM invoices_hist i JOIN customers c ON i.customer_id = c.customer_id
WHERE i.billing_period >= DATE '2000-08-01' GROUP BY 1, 2"""
CTE["region_monthly"] = f"""SELECT CAST(month AS DATE) AS month, {REGION('city')} AS region,
  CAST(round(sum(monthly_revenue), 2) AS DOUBLE) AS monthly_revenue,
  CAST(sum(monthly_invoices) AS BIGINT) AS monthly_invoices, CAST(sum(active_customers) AS BIGINT) AS active_customers
FROM rm_city GROUP BY 1, 2"""

_PERF_SUMS = """COUNT(DISTINCT i.customer_id) AS total_customers, SUM(i.total_final_cost) AS total_revenue,
  SUM(CASE WHEN r.record_type = 'voice' THEN r.final_cost ELSE 0 END) AS voice_revenue,
  SUM(CASE WHEN r.record_type = 'sms' THEN r.final_cost ELSE 0 END) AS sms_revenue,
  SUM(CASE WHEN r.record_type = 'data' THEN r.final_cost ELSE 0 END) AS data_revenue,
  SUM(CASE WHEN r.record_type = 'voice' THEN r.duration_sec ELSE 0 END) AS voice_seconds,
  COUNT(CASE WHEN r.record_type = 'sms' THEN 1 END) AS sms_count,
  SUM(CASE WHEN r.record_type = 'data' THEN CAST(r.data_volume_mb AS DECIMAL(24,6)) ELSE 0 END) AS data_mb"""
# the original shape: invoices fanned out over the usage rows of their month
CTE["perf_fanout_city"] = f"""SELECT c.region AS city, {_PERF_SUMS}
FROM invoices_hist i JOIN customers c ON i.customer_id = c.customer_id
LEFT JOIN rated_hist r ON r.customer_id = i.customer_id
  AND date_trunc('month', r."timestamp") = i.billing_period AND r.rating_status = 'rated'
WHERE i.billing_period >= DATE '2001-02-01'
GROUP BY c.region HAVING SUM(i.total_final_cost) > 0"""
# corrected: usage summed per customer-month before meeting the invoice
CTE["perf_usage"] = """SELECT customer_id, CAST(date_trunc('month', "timestamp") AS DATE) AS billing_period,
  sum(CASE WHEN record_type = 'voice' THEN final_cost END) AS vrev,
  sum(CASE WHEN record_type = 'sms' THEN final_cost END) AS srev,
  sum(CASE WHEN record_type = 'data' THEN final_cost END) AS drev,
  sum(CASE WHEN record_type = 'voice' THEN duration_sec END) AS vsec,
  count(CASE WHEN record_type = 'sms' THEN 1 END) AS sms,
  sum(CASE WHEN record_type = 'data' THEN CAST(data_volume_mb AS DECIMAL(24,6)) END) AS mb
FROM rated_hist WHERE rating_status = 'rated' GROUP BY 1, 2"""
CTE["perf_city"] = """SELECT c.region AS city, COUNT(DISTINCT i.customer_id) AS total_customers,
  SUM(i.total_final_cost) AS total_revenue, coalesce(SUM(u.vrev), 0) AS voice_revenue,
  coalesce(SUM(u.srev), 0) AS sms_revenue, coalesce(SUM(u.drev), 0) AS data_revenue,
  coalesce(SUM(u.vsec), 0) AS voice_seconds, coalesce(SUM(u.sms), 0) AS sms_count, coalesce(SUM(u.mb), 0) AS data_mb
FROM invoices_hist i JOIN customers c ON i.customer_id = c.customer_id
LEFT JOIN perf_usage u ON u.customer_id = i.customer_id AND u.billing_period = i.billing_period
WHERE i.billing_period >= DATE '2001-02-01'
GROUP BY c.region HAVING SUM(i.total_final_cost) > 0"""


def _perf_region(city_cte: str) -> str:
    return f"""SELECT {REGION('city')} AS region, CAST(sum(total_customers) AS BIGINT) AS total_customers,
  CAST(round(sum(total_revenue), 2) AS DOUBLE) AS total_revenue,
  CAST(round(sum(voice_revenue), 4) AS DOUBLE) AS voice_revenue,
  CAST(round(sum(sms_revenue), 4) AS DOUBLE) AS sms_revenue,
  CAST(round(sum(data_revenue), 4) AS DOUBLE) AS data_revenue,
  round(CAST(sum(voice_seconds) AS DOUBLE) / 60.0, 4) AS voice_minutes,
  CAST(sum(sms_count) AS BIGINT) AS sms_count, CAST(round(sum(data_mb), 4) AS DOUBLE) AS data_mb
FROM {city_cte} GROUP BY 1"""


CTE["perf"] = _perf_region("perf_city")
CTE["perf_parity"] = _perf_region("perf_fanout_city")
CTE["population"] = """SELECT c.customer_id, CAST(round(SUM(i.total_final_cost), 2) AS DOUBLE) AS total_spent,
  COUNT(i.invoice_id) AS total_invoices,
  round(CAST(SUM(i.total_final_cost) AS DOUBLE) / COUNT(i.invoice_id), 4) AS avg_invoice
FROM customers c JOIN invoices_hist i ON c.customer_id = i.customer_id
WHERE i.billing_period >= DATE '2001-02-01' AND c.status = 'active'
GROUP BY c.customer_id HAVING SUM(i.total_final_cost) > 0"""
CTE["top20"] = "SELECT * FROM population ORDER BY total_spent DESC, customer_id LIMIT 20"
CTE["rfm_edges"] = """SELECT quantile_cont(CAST(total_invoices AS DOUBLE), [0.0, 1.0/3.0, 2.0/3.0, 1.0]) AS fe,
  quantile_cont(CAST(total_spent AS DOUBLE), [0.0, 1.0/3.0, 2.0/3.0, 1.0]) AS me, count(*) AS n FROM population"""
CTE["rfm_scores"] = """SELECT customer_id, total_spent, total_invoices, avg_invoice, frequency_score, monetary_score,
  frequency_score + monetary_score AS rfm_score FROM (
 SELECT t.*,
  CAST(CASE WHEN e.n <= 3 THEN NULL WHEN len(list_distinct(e.fe)) < 4 OR t.total_invoices IS NULL THEN 2
       WHEN t.total_invoices <= e.fe[2] THEN 1 WHEN t.total_invoices <= e.fe[3] THEN 2 ELSE 3 END AS INTEGER)
    AS frequency_score,
  CAST(CASE WHEN e.n <= 3 THEN NULL WHEN len(list_distinct(e.me)) < 4 OR t.total_spent IS NULL THEN 2
       WHEN t.total_spent <= e.me[2] THEN 1 WHEN t.total_spent <= e.me[3] THEN 2 ELSE 3 END AS INTEGER)
    AS monetary_score
 FROM population t CROSS JOIN rfm_edges e)"""
CTE["rfm"] = """SELECT *, CASE WHEN rfm_score IS NULL THEN NULL WHEN rfm_score >= 5 THEN '🌟 Champions'
  WHEN rfm_score >= 4 THEN '💎 Loyaux' WHEN rfm_score >= 3 THEN '📈 Potentiel' ELSE '🚨 À risque' END AS segment
FROM rfm_scores"""
CTE["iu"] = """SELECT customer_id, CAST(date_trunc('month', "timestamp") AS DATE) AS billing_period, record_type,
  count(*) AS usage_count, CAST(sum(duration_sec) AS BIGINT) AS total_duration_sec,
  CAST(round(sum(CAST(data_volume_mb AS DECIMAL(24,6))), 4) AS DOUBLE) AS total_data_mb,
  CAST(round(sum(base_cost), 4) AS DOUBLE) AS total_base_cost,
  CAST(round(sum(final_cost), 4) AS DOUBLE) AS total_final_cost,
  round(CAST(sum(unit_price) AS DOUBLE) / count(unit_price), 4) AS avg_unit_price
FROM rated_hist WHERE rating_status = 'rated' GROUP BY 1, 2, 3"""

ORDER = list(CTE)  # insertion order is dependency order


def _with(body: str) -> str:
    """Prefix the body with every fixture CTE (DuckDB evaluates only the
    ones the body references)."""
    return "WITH " + ",\n".join(f"{name} AS (\n{CTE[name]}\n)" for name in ORDER) + "\n" + body


NORMALIZED = "SELECT * FROM normalized"
RAW = ("SELECT record_type, \"timestamp\", caller_id, callee_id, sender_id, receiver_id, user_id, duration_sec, "
       "session_duration_sec, data_volume_mb, cell_id, technology FROM raw_fields")
RAW_OFFSET = RAW.replace("SELECT ", "SELECT \"offset\", ", 1)
MED = ("SELECT record_hash, status, record_type, \"timestamp\", msisdn, peer_id, duration_sec, data_volume_mb, "
       "session_duration_sec, cell_id, technology, \"offset\" FROM mediated_all")
INVOICE_ROWS = """SELECT customer_id, DATE '2024-01-01' AS billing_period,
  CAST(round(usage_cost, 2) AS DOUBLE) AS total_base_cost, CAST(round(discount + credit, 2) AS DOUBLE) AS total_discount,
  CAST(round(tax, 2) AS DOUBLE) AS tax_applied, CAST(round(total_due, 2) AS DOUBLE) AS total_final_cost FROM terms"""
DOCS = """SELECT customer_id, rate_plan_id, '2024-01' AS billing_period,
  CAST(round(usage_cost, 2) AS DOUBLE) AS total_base_cost, CAST(round(credit, 2) AS DOUBLE) AS free_units_credit,
  CAST(round(adjusted, 2) AS DOUBLE) AS adjusted_usage_cost, CAST(n_lines AS INTEGER) AS free_unit_services,
  CAST(round(loyalty_discount, 2) AS DOUBLE) AS loyalty_discount,
  CAST(round(student_discount, 2) AS DOUBLE) AS student_discount,
  CAST(round(discount, 2) AS DOUBLE) AS total_discounts, CAST(round(taxable, 2) AS DOUBLE) AS subtotal_after_discounts,
  CAST(round(tax, 2) AS DOUBLE) AS vat, CAST(1.0 AS DOUBLE) AS regulatory_fee,
  CAST(round(total_due, 2) AS DOUBLE) AS total_due FROM terms"""
ENRICHED_ORDER = "ORDER BY billing_period DESC, customer_id, invoice_id"


def _ratio(num: str, den: str, digits: int = 4, pct: bool = False) -> str:
    n = f"CAST({num} AS DOUBLE)" + (" * 100.0" if pct else "")
    return f"round({n} / NULLIF(CAST({den} AS DOUBLE), 0), {digits})"


BODIES = {
    # 2.1
    "src_cdr_stream": RAW,
    "src_decode_json": RAW_OFFSET,
    "src_table": "SELECT * FROM customers",
    "src_table_where": ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders "
                        "WHERE o_orderdate >= TIMESTAMP '2001-02-01'"),
    "src_or_empty": "SELECT * FROM customer",
    "sink_append": NORMALIZED,
    "sink_foreach_batch": NORMALIZED,
    "sink_invoice_json": DOCS,
    "sink_export": """SELECT invoice_id AS ID_Facture, customer_id AS ID_Client, customer_name AS Nom_Client,
  billing_period AS Periode_Facturation, total_base_cost AS Cout_Base, total_discount AS Reductions,
  tax_applied AS TVA, total_final_cost AS Montant_Total, rate_plan_id AS Plan_Tarifaire, region AS city,
  is_student, activation_date, region_mapped AS Region FROM enriched""",
    "sink_cdr_records": RAW_OFFSET,
    "sql_param": """SELECT customer_id, count(*) AS invoices, CAST(sum(total_final_cost) AS DOUBLE) AS revenue
FROM invoices_hist WHERE billing_period >= DATE '2001-02-01' GROUP BY customer_id""",
    "cache_table": "SELECT * FROM customers WHERE status = 'active'",
    # 2.2
    "med_msisdn": 'SELECT "offset", record_type, msisdn FROM usage_src',
    "med_peer": 'SELECT "offset", record_type, peer_id FROM usage_src',
    "med_status": 'SELECT "offset", record_type, msisdn, status FROM validated',
    "med_hash": 'SELECT "offset", record_type, record_hash FROM validated',
    "med_dedup": MED,
    "med_clean": MED + " WHERE status = 'ok'",
    "med_project": f"SELECT {NORM_SELECT} FROM validated WHERE status = 'ok'",
    "med_pipeline": NORMALIZED,
    "med_reject_profile": """SELECT status, coalesce(reason, 'none') AS reason, count(*) AS records
FROM validated GROUP BY 1, 2""",
    "med_anomaly_profile": r"""SELECT
 (SELECT count(*) FROM raw_fields) AS total_records,
 (SELECT count(*) FROM raw_fields WHERE record_type IS NULL OR "timestamp" IS NULL OR (CASE
    WHEN record_type = 'sms' THEN sender_id IS NULL OR receiver_id IS NULL OR cell_id IS NULL OR technology IS NULL
    WHEN record_type = 'data' THEN user_id IS NULL OR data_volume_mb IS NULL OR session_duration_sec IS NULL
                                   OR cell_id IS NULL OR technology IS NULL
    ELSE caller_id IS NULL OR callee_id IS NULL OR duration_sec IS NULL OR cell_id IS NULL OR technology IS NULL
    END)) AS missing_fields,
 (SELECT count(*) FROM raw_fields WHERE coalesce(duration_sec < 0 OR data_volume_mb < 0 OR session_duration_sec < 0,
    false) OR coalesce(NOT regexp_matches(coalesce(caller_id, sender_id, user_id), '^\+?[0-9]+$'), false))
    AS corrupted_values,
 (SELECT count(*) FROM raw_fields WHERE record_type IS NOT NULL AND record_type NOT IN ('voice', 'sms', 'data'))
    AS unknown_types,
 (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT record_hash, count(*) AS n FROM validated
    GROUP BY record_hash)) AS duplicates,
 (SELECT count(*) FROM (SELECT event_ts, lag(event_ts) OVER (ORDER BY "offset", event_ts) AS prev FROM usage_src)
    WHERE event_ts < prev) AS out_of_order""",
    "dq_checks": """SELECT 'normalized_cdr' AS table_name, 'primary_key' AS check_name,
   CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT) AS violations
   FROM (SELECT record_hash AS k, count(*) AS n FROM normalized GROUP BY 1)
 UNION ALL SELECT 'customers', 'primary_key', CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT customer_id AS k, count(*) AS n FROM customers GROUP BY 1)
 UNION ALL SELECT 'rate_plans', 'primary_key', CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT rate_plan_id AS k, count(*) AS n FROM rate_plans GROUP BY 1)
 UNION ALL SELECT 'product_catalog', 'primary_key',
   CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT product_code AS k, count(*) AS n FROM product_catalog GROUP BY 1)
 UNION ALL SELECT 'product_rates', 'primary_key',
   CAST(coalesce(sum(CASE WHEN a IS NULL OR b IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT rate_plan_id AS a, service_type AS b, count(*) AS n FROM product_rates GROUP BY 1, 2)
 UNION ALL SELECT 'rated_cdr', 'primary_key', CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT record_hash AS k, count(*) AS n FROM rated GROUP BY 1)
 UNION ALL SELECT 'invoices', 'primary_key', CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT)
   FROM (SELECT invoice_id AS k, count(*) AS n FROM invoices_hist GROUP BY 1)
 UNION ALL SELECT 'product_rates', 'foreign_key_rate_plan', count(*) FROM product_rates r
   WHERE NOT EXISTS (SELECT 1 FROM rate_plans p WHERE p.rate_plan_id = r.rate_plan_id)
 UNION ALL SELECT 'customers', 'check_subscription_type', count(*) FROM customers
   WHERE NOT (subscription_type IN ('postpaid'))
 UNION ALL SELECT 'customers', 'check_status', count(*) FROM customers
   WHERE NOT (status IN ('active', 'suspended', 'terminated'))
 UNION ALL SELECT 'product_catalog', 'check_service_type', count(*) FROM product_catalog
   WHERE NOT (service_type IN ('voice', 'sms', 'data'))""",
    # 2.3
    "rate_time_parts": """SELECT record_hash, CAST(hour("timestamp") AS INTEGER) AS hour,
  CAST(dayofweek("timestamp") AS INTEGER) AS weekday FROM normalized""",
    "is_peak_hour": """SELECT record_hash, coalesce(hour("timestamp") >= 8 AND hour("timestamp") < 20, false) AS is_peak
FROM normalized""",
    "is_weekend": 'SELECT record_hash, coalesce(dayofweek("timestamp") IN (5, 6), false) AS is_weekend FROM normalized',
    "is_international": ("SELECT record_hash, coalesce(NOT starts_with(peer_id, '212'), false) AS is_international "
                         "FROM normalized"),
    "cost_voice": f"SELECT record_hash, CAST({VOICE_COST} AS DOUBLE) AS cost FROM matched WHERE record_type = 'voice'",
    "cost_data": f"SELECT record_hash, CAST({DATA_COST} AS DOUBLE) AS cost FROM matched WHERE record_type = 'data'",
    "cost_sms": f"SELECT record_hash, CAST({SMS_COST} AS DOUBLE) AS cost FROM matched WHERE record_type = 'sms'",
    "rate_base_cost": ("SELECT record_hash, record_type, CAST(base_cost AS DOUBLE) AS base_cost FROM rated "
                       "WHERE rating_status = 'rated'"),
    "rate_discounts": ("SELECT record_hash, CAST(final_cost AS DOUBLE) AS final_cost, discount_applied FROM rated "
                       "WHERE rating_status = 'rated'"),
    "udf_surface": """SELECT record_hash, coalesce(hour("timestamp") >= 8 AND hour("timestamp") < 20, false) AS is_peak,
  coalesce(dayofweek("timestamp") IN (5, 6), false) AS is_weekend,
  coalesce(NOT starts_with(peer_id, '212'), false) AS is_international FROM normalized""",
    # 2.4
    "join_unprocessed": """SELECT n.* FROM normalized n WHERE n.status = 'ok' AND NOT EXISTS (
  SELECT 1 FROM normalized p WHERE p."timestamp" < TIMESTAMP '2024-01-16' AND p.record_hash = n.record_hash)""",
    "join_customers": """SELECT n.record_hash, n.msisdn, a.customer_id, a.rate_plan_id
FROM normalized n LEFT JOIN active a ON n.msisdn = a.customer_id""",
    "join_rates": "SELECT record_hash, record_type, rate_plan_id, unit_price FROM joined",
    "split_matched": ("SELECT record_hash, (customer_id IS NOT NULL AND unit_price IS NOT NULL) AS matched "
                      "FROM joined"),
    "join_invoiced": """SELECT customer_id, rate_plan_id FROM customers c WHERE status = 'active' AND NOT EXISTS (
  SELECT 1 FROM invoices_hist h WHERE h.customer_id = c.customer_id AND h.billing_period = DATE '2001-07-01')""",
    "join_customer_usage": """SELECT a.customer_id, a.rate_plan_id, u.usage_records, CAST(u.usage_cost AS DOUBLE) AS usage_cost
FROM active a JOIN b_usage u ON a.customer_id = u.customer_id""",
    "join_free_units": """SELECT customer_id, service, CAST(total_usage AS DOUBLE) AS total_usage,
  CAST(free_allowance AS DOUBLE) AS free_allowance FROM fu_lines""",
    "join_invoice_customer": """SELECT i.invoice_id, i.customer_id, i.billing_period,
  CAST(i.total_final_cost AS DOUBLE) AS total_final_cost, c.customer_name, c.region, c.status
FROM invoices_hist i JOIN customers c ON i.customer_id = c.customer_id""",
    "join_invoice_enriched": "SELECT * FROM enriched",
    "join_invoice_usage": """SELECT i.invoice_id, i.customer_id, i.billing_period, r.record_hash, r.record_type,
  CAST(r.final_cost AS DOUBLE) AS final_cost
FROM invoices_hist i LEFT JOIN (SELECT * FROM rated_hist WHERE rating_status = 'rated') r
  ON r.customer_id = i.customer_id AND CAST(date_trunc('month', r."timestamp") AS DATE) = i.billing_period""",
    "join_region_map": f"SELECT customer_id, region, {REGION('region')} AS region_mapped FROM customers",
    "semi_top_regions": """SELECT * FROM region_monthly WHERE region IN (
  SELECT region FROM region_rev ORDER BY total_revenue DESC, region LIMIT 5)""",
    # 2.5
    "bill_period": """SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS billing_period, count(*) AS records
FROM rated WHERE "timestamp" IS NOT NULL GROUP BY 1""",
    "bill_usage_total": "SELECT customer_id, usage_records, CAST(usage_cost AS DOUBLE) AS usage_cost FROM b_usage",
    "bill_service_usage": f"""SELECT customer_id, record_type, count(*) AS records,
  CAST(coalesce(sum(CASE WHEN record_type = 'voice' THEN CAST(duration_sec AS DECIMAL(24,6))
       WHEN record_type = 'data' THEN CAST(data_volume_mb AS DECIMAL(24,6)) ELSE 1 END), 0) AS DOUBLE) AS total_usage
FROM rated WHERE rating_status = 'rated' AND {PERIOD_RANGE} AND record_type IN ('voice', 'sms', 'data')
GROUP BY 1, 2""",
    "bill_free_units": """SELECT customer_id, service, CAST(total_usage AS DOUBLE) AS total_usage,
  CAST(free_allowance AS DOUBLE) AS free_allowance, CAST(free_used AS DOUBLE) AS free_used,
  CAST(credit AS DOUBLE) AS credit FROM fu""",
    "bill_adjusted": """SELECT customer_id, CAST(usage_cost AS DOUBLE) AS usage_cost, CAST(credit AS DOUBLE) AS credit,
  CAST(adjusted AS DOUBLE) AS adjusted FROM terms""",
    "bill_loyalty": ("SELECT customer_id, is_loyal, CAST(round(loyalty_discount, 6) AS DOUBLE) AS loyalty_discount "
                     "FROM terms"),
    "bill_student": ("SELECT customer_id, student, CAST(round(student_discount, 6) AS DOUBLE) AS student_discount "
                     "FROM terms"),
    "bill_tax": """SELECT customer_id, CAST(round(taxable, 6) AS DOUBLE) AS taxable, CAST(round(tax, 6) AS DOUBLE) AS tax,
  CAST(round(total_due, 6) AS DOUBLE) AS total_due FROM terms""",
    "bill_invoices": INVOICE_ROWS,
    "bill_documents": DOCS,
    "bill_document_lines": """SELECT customer_id, record_type, strftime(billing_period, '%B %Y') AS period_label,
  CASE upper(record_type) WHEN 'VOICE' THEN printf('%d minutes', CAST(floor(coalesce(total_duration_sec, 0) / 60) AS BIGINT))
       WHEN 'DATA' THEN CAST(round(CAST(total_data_mb AS DECIMAL(24,4)), 1) AS VARCHAR) || ' MB'
       ELSE printf('%d messages', usage_count) END AS quantity,
  CAST(round(CAST(total_base_cost AS DECIMAL(24,4)), 2) AS VARCHAR) || ' MAD' AS base_amount,
  CAST(round(CAST(total_final_cost AS DECIMAL(24,4)), 2) AS VARCHAR) || ' MAD' AS final_amount FROM iu""",
    # 2.6
    "agg_revenue_monthly": "SELECT * FROM monthly",
    "agg_customer_metrics": "SELECT * FROM metrics",
    "agg_usage_by_service": f"""SELECT record_type, count(*) AS total_records,
  CAST(round(sum(final_cost), 4) AS DOUBLE) AS total_cost, {_ratio('sum(final_cost)', 'count(*)', 6)} AS avg_cost
FROM rated_hist WHERE rating_status = 'rated' AND "timestamp" >= TIMESTAMP '2001-07-02' GROUP BY record_type""",
    "agg_processing_by_day": """SELECT CAST(event_ts AS DATE) AS "date", status, count(*) AS "count"
FROM mediated_all WHERE event_ts >= TIMESTAMP '2024-01-24' GROUP BY 1, 2""",
    "agg_top_customers": "SELECT * FROM top20 ORDER BY total_spent DESC, customer_id LIMIT 10",
    "agg_revenue_daily": """SELECT CAST(billing_period AS DATE) AS "date",
  CAST(round(sum(total_final_cost), 2) AS DOUBLE) AS daily_revenue, count(*) AS daily_invoices
FROM invoices_hist WHERE billing_period >= DATE '2001-07-02' GROUP BY 1""",
    "agg_service_breakdown": f"""SELECT record_type, count(*) AS call_count,
  CAST(round(sum(final_cost), 4) AS DOUBLE) AS total_revenue, {_ratio('sum(final_cost)', 'count(*)', 6)} AS avg_cost,
  CAST(sum(CASE WHEN record_type = 'voice' THEN duration_sec ELSE 0 END) AS BIGINT) AS total_duration,
  CAST(round(sum(CASE WHEN record_type = 'data' THEN CAST(data_volume_mb AS DECIMAL(24,6)) ELSE 0 END), 4) AS DOUBLE)
    AS total_data_mb
FROM rated_hist WHERE rating_status = 'rated' AND "timestamp" >= TIMESTAMP '2001-07-02' GROUP BY record_type""",
    "agg_region_revenue": "SELECT * FROM region_rev",
    "agg_region_derived": f"""SELECT *, {_ratio('total_revenue', 'customer_count')} AS avg_revenue_per_customer,
  {_ratio('total_revenue', 'sum(total_revenue) OVER ()', 4, True)} AS revenue_share,
  {_ratio('total_discount', 'total_base_cost', 4, True)} AS discount_rate FROM region_rev""",
    "agg_region_monthly": "SELECT * FROM region_monthly",
    "agg_region_performance": "SELECT * FROM perf",
    "agg_region_performance_parity": "SELECT * FROM perf_parity",
    "agg_region_perf_derived": f"""SELECT *, {_ratio('total_revenue', 'total_customers')} AS arpu,
  {_ratio('voice_revenue', 'total_revenue', 4, True)} AS voice_share,
  {_ratio('sms_revenue', 'total_revenue', 4, True)} AS sms_share,
  {_ratio('data_revenue', 'total_revenue', 4, True)} AS data_share FROM perf""",
    "agg_invoice_usage": "SELECT * FROM iu",
    "agg_billing_stats": f"""SELECT count(*) AS total_invoices, count(DISTINCT customer_id) AS unique_customers,
  CAST(round(sum(total_final_cost), 2) AS DOUBLE) AS total_revenue,
  {_ratio('sum(total_final_cost)', 'count(*)')} AS avg_invoice_amount,
  max(billing_period) AS latest_period, min(billing_period) AS earliest_period FROM invoices_hist""",
    "agg_billing_monthly": f"""SELECT billing_period, count(*) AS invoice_count,
  CAST(round(sum(total_final_cost), 2) AS DOUBLE) AS monthly_revenue,
  {_ratio('sum(total_final_cost)', 'count(*)')} AS avg_amount
FROM invoices_hist GROUP BY billing_period ORDER BY billing_period DESC LIMIT 12""",
    "agg_rating_stats": """SELECT count(*) AS total_processed,
  count(*) FILTER (WHERE rating_status = 'rated') AS rated_count,
  count(*) FILTER (WHERE rating_status = 'unmatched') AS unmatched_count FROM rated""",
    "agg_overview": f"""SELECT round(sum(total_revenue), 2) AS total_revenue,
  CAST(coalesce(sum(total_invoices), 0) AS BIGINT) AS total_invoices,
  coalesce({_ratio('sum(total_revenue)', 'sum(total_invoices)')}, 0.0) AS avg_invoice,
  (SELECT active_customers FROM metrics) AS active_customers FROM monthly""",
    "agg_customer_rates": f"""SELECT *, coalesce({_ratio('active_customers', 'total_customers', 4, True)}, 0.0) AS active_rate,
  coalesce({_ratio('student_customers', 'total_customers', 4, True)}, 0.0) AS student_rate,
  coalesce(avg_customer_age_years, 0.0) AS avg_tenure_years FROM metrics""",
    "agg_filtered_billing": f"""SELECT filtered_invoices, filtered_invoices - all_invoices AS invoice_delta,
  CAST(round(revf, 2) AS DOUBLE) AS filtered_revenue, {_ratio('revf', 'rev', 4, True)} AS revenue_pct_of_total,
  coalesce({_ratio('revf', 'filtered_invoices')}, 0.0) AS filtered_mean, {_ratio('rev', 'all_invoices')} AS overall_mean,
  filtered_customers, {_ratio('filtered_customers', 'all_customers', 4, True)} AS customers_pct_of_total
FROM (SELECT count(*) FILTER (WHERE sel) AS filtered_invoices, count(*) AS all_invoices,
        coalesce(sum(amt) FILTER (WHERE sel), 0) AS revf, sum(amt) AS rev,
        count(DISTINCT customer_id) FILTER (WHERE sel) AS filtered_customers,
        count(DISTINCT customer_id) AS all_customers
      FROM (SELECT *, CAST(total_final_cost AS DECIMAL(18,2)) AS amt,
              (strftime(billing_period, '%Y-%m') = '2001-07' AND region_mapped = 'Casablanca-Settat') AS sel
            FROM enriched))""",
    "agg_segment_counts": 'SELECT segment, count(*) AS "count" FROM rfm WHERE segment IS NOT NULL GROUP BY 1',
    "agg_segment_stats": """SELECT segment, count(customer_id) AS customers, round(avg(total_spent), 2) AS mean_spent,
  round(sum(total_spent), 2) AS total_spent, round(avg(total_invoices), 2) AS mean_invoices
FROM rfm WHERE segment IS NOT NULL GROUP BY 1""",
    "agg_histogram": """SELECT bucket, round(lo + (bucket - 1) * w, 4) AS lower, round(lo + bucket * w, 4) AS upper,
  count(*) AS "count"
FROM (SELECT CASE WHEN h.hi > h.lo THEN least(CAST(floor((t.total_spent - h.lo) / (h.hi - h.lo) * 10) AS INTEGER) + 1, 10)
             ELSE 1 END AS bucket, h.lo, CASE WHEN h.hi > h.lo THEN (h.hi - h.lo) / 10 ELSE 0.0 END AS w
      FROM population t CROSS JOIN (SELECT min(total_spent) AS lo, max(total_spent) AS hi FROM population) h)
GROUP BY bucket, lo, w""",
    # 2.7
    "win_ma7": """SELECT "date", daily_revenue,
  CASE WHEN count(daily_revenue) OVER w = 7 THEN round(avg(daily_revenue) OVER w, 4) END AS ma7
FROM (SELECT CAST("timestamp" AS DATE) AS "date", CAST(round(sum(final_cost), 4) AS DOUBLE) AS daily_revenue
      FROM rated WHERE rating_status = 'rated' AND "timestamp" >= TIMESTAMP '2024-01-01' GROUP BY 1)
WINDOW w AS (ORDER BY "date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "win_growth": f"""SELECT month, total_revenue, total_invoices,
  coalesce({_ratio('total_revenue - lag(total_revenue) OVER w', 'lag(total_revenue) OVER w', 4, True)}, 0.0)
    AS revenue_growth,
  coalesce({_ratio('total_invoices - lag(total_invoices) OVER w', 'lag(total_invoices) OVER w', 4, True)}, 0.0)
    AS invoice_growth
FROM monthly WINDOW w AS (ORDER BY month)""",
    "win_arpu": f"""SELECT max(month) AS month, max_by(total_revenue, month) AS total_revenue,
  (SELECT active_customers FROM metrics) AS active_customers,
  coalesce({_ratio('max_by(total_revenue, month)', '(SELECT active_customers FROM metrics)')}, 0.0) AS arpu
FROM monthly""",
    "win_cumulative_total": """SELECT round(sum(total_revenue), 2) AS window_revenue,
  CAST(sum(total_invoices) AS BIGINT) AS window_invoices FROM monthly""",
    "win_target": """SELECT month, total_revenue, CASE WHEN count(*) OVER () > 1 THEN round(
  first_value(total_revenue) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  * pow(1.1, row_number() OVER (ORDER BY month) - 1), 4) END AS target FROM monthly""",
    "win_page": f"SELECT * FROM enriched {ENRICHED_ORDER} LIMIT 5 OFFSET 5",
    "win_others": """SELECT region, total_revenue, CAST("rank" AS INTEGER) AS "rank" FROM (
  SELECT region, total_revenue, row_number() OVER (ORDER BY total_revenue DESC, region) AS "rank" FROM region_rev)
WHERE "rank" <= 6
UNION ALL
SELECT 'Autres', round(sum(total_revenue), 2), 7 FROM (
  SELECT total_revenue, row_number() OVER (ORDER BY total_revenue DESC, region) AS "rank" FROM region_rev)
WHERE "rank" > 6 HAVING round(sum(total_revenue), 2) > 0""",
    # 2.8
    "topk_customers": "SELECT * FROM top20 ORDER BY total_spent DESC, customer_id LIMIT 10",
    "topk_regions": "SELECT * FROM region_rev ORDER BY total_revenue DESC, region LIMIT 8",
    "topk_arpu": f"""SELECT region, {_ratio('total_revenue', 'customer_count')} AS arpu FROM region_rev
ORDER BY arpu DESC, region LIMIT 8""",
    "sort_invoices": "SELECT * FROM enriched",
    "limit_sample": f"SELECT * FROM enriched {ENRICHED_ORDER} LIMIT 50",
    # 2.9
    "set_union_rated": "SELECT record_hash, msisdn, record_type, customer_id, rating_status FROM rated",
    "set_distinct_periods": "SELECT DISTINCT strftime(billing_period, '%Y-%m') AS period FROM enriched",
    "set_distinct_regions": """SELECT DISTINCT region_mapped FROM enriched
WHERE region_mapped IS NOT NULL AND region_mapped <> 'Autres'""",
    "filter_period_region": """SELECT * FROM enriched
WHERE strftime(billing_period, '%Y-%m') = '2001-07' AND region_mapped = 'Casablanca-Settat'""",
    # 2.10
    "rfm_scores": "SELECT * FROM rfm_scores",
    "rfm_segments": "SELECT * FROM rfm",
    # 2.11
    "stream_mediation": NORMALIZED,
    "stream_dedup": ("SELECT record_hash, status, record_type, \"timestamp\", msisdn, peer_id, duration_sec, "
                     "data_volume_mb, session_duration_sec, cell_id, technology FROM mediated_all"),
    "stream_trigger": NORMALIZED,
    "stream_anti_join": NORMALIZED,
    "stream_recovery": NORMALIZED,
    "stream_graceful_stop": NORMALIZED,
    # 2.12
    "job_mediation": NORMALIZED,
    "job_rating": """SELECT record_hash, record_type, "timestamp", msisdn, peer_id, duration_sec, data_volume_mb,
  session_duration_sec, cell_id, technology, status, customer_id, rate_plan_id,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(base_cost AS DOUBLE) AS base_cost,
  CAST(final_cost AS DOUBLE) AS final_cost, discount_applied, rating_status FROM rated
WHERE record_hash NOT IN (SELECT record_hash FROM normalized WHERE "timestamp" < TIMESTAMP '2024-01-16')""",
    "job_billing": f"""SELECT i.*, d.free_units_credit AS document_credit, d.free_unit_services AS document_services,
  d.total_due AS document_total FROM ({INVOICE_ROWS}) i JOIN ({DOCS}) d USING (customer_id)""",
    "job_end_to_end": "SELECT * FROM e2e_region",
    "win_page_count": """SELECT count(*) AS total_items, CAST(ceil(count(*) / 5.0) AS BIGINT) AS total_pages
FROM enriched""",
    "sink_cdr_csv": RAW_OFFSET,
    "invoice_detail": """SELECT e.invoice_id, e.customer_id, e.customer_name, e.billing_period, e.total_base_cost,
  e.total_discount, e.tax_applied, e.total_final_cost, e.rate_plan_id, u.record_type, u.usage_count,
  u.total_duration_sec, u.total_data_mb, u.total_base_cost AS usage_base_cost,
  u.total_final_cost AS usage_final_cost, u.avg_unit_price
FROM enriched e LEFT JOIN iu u ON u.customer_id = e.customer_id AND u.billing_period = e.billing_period""",
}


BODIES["sink_export_json"] = BODIES["sink_export"]
BODIES["sink_append_once"] = NORMALIZED
for _name, _same in (("dq_quarantine", "dq_checks"), ("med_anomaly_profile_stream", "med_anomaly_profile"),
                     ("cache_result", "cache_table"), ("win_page_seek", "win_page"),
                     ("agg_processing_by_day_stream", "agg_processing_by_day"), ("agg_revenue_monthly_stored", "agg_revenue_monthly"),
                     ("agg_region_revenue_stored", "agg_region_revenue"), ("agg_region_performance_stored", "agg_region_performance")):
    BODIES[_name] = BODIES[_same]
BODIES["sql_rating"] = BODIES["job_rating"]
BODIES["udf_pricing"] = ("SELECT record_hash, CAST(base_cost AS DOUBLE) AS base_cost, CAST(final_cost AS DOUBLE) AS final_cost, "
                         "discount_applied AS discounts FROM rated WHERE rating_status = 'rated'")
BODIES["join_unprocessed_bucketed"] = BODIES["join_unprocessed"]
BODIES["stream_winner"] = NORMALIZED
BODIES["stream_dedup_bounded"] = NORMALIZED
BODIES["stream_accounting"] = """SELECT count(*) AS decoded, count(*) FILTER (WHERE status <> 'ok') AS rejected,
  count(*) FILTER (WHERE status = 'ok') - count(DISTINCT CASE WHEN status = 'ok' THEN record_hash END) AS duplicates,
  count(DISTINCT CASE WHEN status = 'ok' THEN record_hash END) AS records,
  count(*) FILTER (WHERE event_ts IS NULL) AS untimed FROM validated"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in BODIES.items()}
