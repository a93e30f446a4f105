"""Independent DuckDB SQL answers for every registered job.

Identifiers and labels in them are fixed values.  Each text runs on the driver's pre-registered views (orders, customer, ...).
The mapped tables are re-derived here in SQL, independently of the Spark code
in ``admitlab.sources``.
"""

from __future__ import annotations

ENC_CTE = """enc AS (
  SELECT
    o.o_orderkey AS id,
    o.o_custkey AS patient_key,
    'PAT' || repeat('0', 7 - length(CAST(o.o_custkey AS VARCHAR))) || o.o_custkey AS patient_id,
    CAST(CASE WHEN o.o_orderkey % 997 = 0 THEN 105 ELSE 18 + (c.c_custkey * 7) % 78 END AS INTEGER) AS age,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(o.o_orderdate AS DATE) AS admission_date,
    CAST(CAST(o.o_orderdate AS DATE) + CAST(1 + (o.o_orderkey * 3) % 10 AS INTEGER) AS DATE) AS discharge_date,
    CASE WHEN c.c_custkey % 20 = 3 THEN NULL ELSE CAST(c.c_acctbal * 8 + 30000 AS DECIMAL(12,2)) END AS household_income,
    CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'Medicare' WHEN 'MACHINERY' THEN 'Private'
      WHEN 'BUILDING' THEN 'Private' WHEN 'AUTOMOBILE' THEN 'Medicaid' ELSE 'Self-Pay' END AS insurance_type,
    CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'Medicare' WHEN 'MACHINERY' THEN 'Private'
      WHEN 'BUILDING' THEN '  PRIVATE ' WHEN 'AUTOMOBILE' THEN 'medicaid' ELSE 'self-PAY' END AS insurance_raw,
    CASE (o.o_orderkey * 11) % 8 WHEN 0 THEN 'Heart Failure' WHEN 1 THEN 'Diabetes' WHEN 2 THEN 'Pneumonia'
      WHEN 3 THEN 'COPD' WHEN 4 THEN 'Stroke' WHEN 5 THEN 'Sepsis' WHEN 6 THEN 'MI' ELSE 'Hypertension' END AS primary_diagnosis,
    CAST(CASE WHEN o.o_orderkey % 33 = 7 THEN NULL ELSE (o.o_orderkey * 13) % 25 END AS INTEGER) AS comorbidity_score,
    CAST(((o.o_orderkey * 37) % 8001) / 10000.0 AS DECIMAL(5,4)) AS icu_utilization_ratio,
    CAST((o.o_orderkey * 5) % 8 AS INTEGER) AS missed_medications,
    CASE WHEN o.o_orderkey % 50 = 9 THEN NULL
         WHEN o.o_orderkey % 1999 = 5 THEN CAST(500000 AS DECIMAL(12,2))
         ELSE CAST(o.o_totalprice / 5 AS DECIMAL(12,2)) END AS total_bill_amount,
    CAST(((o.o_orderkey * 53) % 5001) / 10000.0 AS DECIMAL(5,4)) AS out_of_pocket_ratio,
    CAST(CASE WHEN (o.o_orderkey * 29) % 100 < 20 THEN 1 ELSE 0 END AS INTEGER) AS readmitted_30_days,
    r.r_name AS hospital_region,
    CASE WHEN o.o_orderkey % 20 < 12 THEN 'General' WHEN o.o_orderkey % 20 < 18 THEN 'Academic'
      ELSE 'Critical Access' END AS hospital_type,
    CASE (o.o_orderkey * 7) % 10 WHEN 0 THEN 'AMA' WHEN 1 THEN 'SNF' WHEN 2 THEN 'Home Health'
      ELSE 'Home' END AS discharge_disposition,
    CASE WHEN substr(o.o_orderpriority, 1, 1) IN ('1', '2') THEN 'Emergency'
         WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN 'Urgent' ELSE 'Elective' END AS admission_type,
    CAST((o.o_orderkey * 17) % 5 AS INTEGER) AS previous_admissions_12m
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

GAPS_CTE = """gaps AS (
  SELECT *, datediff('day', prev_discharge_date, admission_date) AS days_gap FROM (
    SELECT enc.*, LAG(discharge_date) OVER (PARTITION BY patient_id ORDER BY admission_date, id) AS prev_discharge_date
    FROM enc) t
)"""

DELINQ_CTE = """delinq AS (
  SELECT 'PAT' || repeat('0', 7 - length(CAST(c_custkey AS VARCHAR))) || c_custkey AS customer_id, 1 AS delinquent_account
  FROM customer WHERE c_acctbal < 0
)"""

TREE_CTE = """doctors AS (
  SELECT p_partkey AS doctor_id, p_name AS name, p_type AS specialty,
         CASE WHEN p_partkey = 0 THEN NULL ELSE CAST(floor(p_partkey / 2) AS BIGINT) END AS referred_by_id
  FROM part
)"""

LOGS_CTE = """logs AS (
  SELECT event_id AS id, 'PAT' || repeat('0', 7 - length(CAST(user_id AS VARCHAR))) || user_id AS patient_id,
         props AS vitals, ts AS created_at
  FROM events
)"""

SURVEYS_CTE = """surveys AS (
  SELECT p_partkey AS id, 'PAT' || repeat('0', 7 - length(CAST(p_partkey AS VARCHAR))) || p_partkey AS patient_id,
         replace(p_name, ' ', ',') AS diagnosis_list
  FROM part
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rdiv(num: str, den: str, digits: int) -> str:
    """num/den rounded half away from zero, exact in integers; NULL if den = 0."""
    s = 10 ** digits
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    return (f"(CAST(SIGN({n}) * ((2 * ABS({n}) * {s} + {d}) // (2 * {d})) AS DOUBLE) / {s})")


def ravg(col: str, scale: int, digits: int) -> str:
    """AVG(col) rounded, for a column with ``scale`` decimal places."""
    m = 10 ** scale
    return rdiv(f"SUM(CAST({col} * {m} AS HUGEINT))", f"COUNT({col}) * {m}", digits)


def cents(col: str) -> str:
    return f"CAST({col} * 100 AS BIGINT)"
