"""Oracle SQL for SURVEY 2.4 (window analytics): plain SQL windows."""

from . import ENC_CTE, rdiv, with_ctes

H = with_ctes(ENC_CTE)
LOS = "datediff('day', admission_date, discharge_date)"
C = "CAST(total_bill_amount * 100 AS BIGINT)"
WP = "PARTITION BY patient_id ORDER BY admission_date, id"
MOV = f"""SELECT *, SUM({C}) OVER w AS s, COUNT(total_bill_amount) OVER w AS n, {C} AS c
  FROM enc WINDOW w AS (ORDER BY id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""
SPEND = """SELECT patient_key, patient_id, SUM(total_bill_amount) AS total_spend FROM enc
  GROUP BY patient_key, patient_id HAVING SUM(total_bill_amount) IS NOT NULL"""
TOPB = f"""SELECT *, NTILE(100) OVER (ORDER BY total_spend DESC, patient_key) AS percentile FROM ({SPEND}) s"""

ORACLE = {
    "bill_rank": H + """SELECT patient_id, total_bill_amount, spending_rank, dense_rank FROM (
  SELECT id, patient_id, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
    RANK() OVER (ORDER BY total_bill_amount DESC) AS spending_rank,
    DENSE_RANK() OVER (ORDER BY total_bill_amount DESC) AS dense_rank
  FROM enc WHERE total_bill_amount IS NOT NULL) t ORDER BY total_bill_amount DESC, id LIMIT 20""",
    "top_bills_per_diagnosis": H + """SELECT patient_id, primary_diagnosis, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount, bill_rank
FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY primary_diagnosis ORDER BY total_bill_amount DESC) AS bill_rank
      FROM enc WHERE total_bill_amount IS NOT NULL) t WHERE bill_rank <= 3""",
    "los_outliers": H + f"""SELECT patient_id, primary_diagnosis, admission_date, discharge_date, length_of_stay,
  {rdiv('s', 'c', 1)} AS avg_benchmark, {rdiv('length_of_stay * c', 's', 2)} AS stay_ratio,
  CASE WHEN length_of_stay * c >= 2 * s THEN 'Outlier (2x+)' WHEN 2 * length_of_stay * c >= 3 * s THEN 'Extended Stay (1.5x+)'
       ELSE 'Normal' END AS stay_status
FROM (SELECT *, {LOS} AS length_of_stay, SUM({LOS}) OVER (PARTITION BY primary_diagnosis) AS s,
        COUNT({LOS}) OVER (PARTITION BY primary_diagnosis) AS c
      FROM enc WHERE discharge_date IS NOT NULL AND admission_date IS NOT NULL) t
ORDER BY stay_ratio DESC, id LIMIT 20""",
    "moving_avg_bill": H + f"""SELECT id, admission_type, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  {rdiv('s', 'n * 100', 2)} AS moving_avg_10 FROM ({MOV}) t""",
    "bill_deviation": H + f"""SELECT id, admission_date, admission_type, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  {rdiv('s', 'n * 100', 2)} AS moving_avg_10, {rdiv('c * n - s', 'n * 100', 2)} AS deviation_from_avg,
  {rdiv('(c * n - s) * 100', 's', 2)} AS pct_diff,
  CASE WHEN 2 * c * n > 3 * s THEN 'HIGH' WHEN 2 * c * n < s THEN 'LOW' ELSE 'Normal' END AS bill_status
FROM ({MOV}) t""",
    "bill_deviation_first": H + f"""SELECT id, admission_date, admission_type, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  {rdiv('s', 'n * 100', 2)} AS moving_avg_10, {rdiv('c * n - s', 'n * 100', 2)} AS deviation_from_avg,
  {rdiv('(c * n - s) * 100', 's', 2)} AS pct_diff,
  CASE WHEN 2 * c * n > 3 * s THEN 'HIGH' WHEN 2 * c * n < s THEN 'LOW' ELSE 'Normal' END AS bill_status
FROM ({MOV}) t ORDER BY id LIMIT 50""",
    "bill_delta": H + f"""SELECT patient_id, admission_date, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(LAG(total_bill_amount) OVER ({WP}) AS DOUBLE) AS previous_bill,
  CAST(total_bill_amount - LAG(total_bill_amount) OVER ({WP}) AS DOUBLE) AS bill_change FROM enc""",
    "bill_trends": H + f"""SELECT * FROM (SELECT patient_id, admission_date, CAST(b AS DOUBLE) AS total_bill_amount,
  CAST(p AS DOUBLE) AS previous_bill, CAST(b - p AS DOUBLE) AS bill_change,
  {rdiv('(CAST(b * 100 AS BIGINT) - CAST(p * 100 AS BIGINT)) * 100', 'CAST(p * 100 AS BIGINT)', 2)} AS pct_change,
  CASE WHEN p IS NULL THEN 'First Visit' WHEN b > p THEN 'Increasing' WHEN b < p THEN 'Decreasing' ELSE 'Same' END AS trend,
  visit_number
FROM (SELECT patient_id, admission_date, total_bill_amount AS b, LAG(total_bill_amount) OVER ({WP}) AS p,
        ROW_NUMBER() OVER ({WP}) AS visit_number FROM enc) a) t WHERE trend = 'First Visit'""",
    "monthly_cumulative": H + """SELECT admission_date, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(SUM(total_bill_amount) OVER (PARTITION BY date_trunc('month', admission_date) ORDER BY admission_date) AS DOUBLE)
    AS monthly_cumulative_revenue FROM enc""",
    "running_total": H + """SELECT admission_date, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(SUM(total_bill_amount) OVER (ORDER BY admission_date, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    AS running_total FROM enc""",
    "running_total_range": H + """SELECT admission_date, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(SUM(total_bill_amount) OVER (ORDER BY admission_date) AS DOUBLE) AS running_total FROM enc""",
    "top_cost_percentiles": H + """SELECT * FROM (SELECT patient_id, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  primary_diagnosis, CAST(NTILE(100) OVER (ORDER BY total_bill_amount DESC, id) AS INTEGER) AS cost_percentile
  FROM enc WHERE total_bill_amount IS NOT NULL) t WHERE cost_percentile <= 5 ORDER BY total_bill_amount DESC""",
    "cost_ntiles": H + """SELECT patient_id, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(NTILE(4) OVER w AS INTEGER) AS quartile, CAST(NTILE(10) OVER w AS INTEGER) AS decile,
  CAST(NTILE(100) OVER w AS INTEGER) AS percentile
FROM enc WHERE total_bill_amount IS NOT NULL WINDOW w AS (ORDER BY total_bill_amount, id)""",
    "quartile_summary": H + f"""SELECT quartile, CAST(MIN(total_bill_amount) AS DOUBLE) AS min_cost,
  CAST(MAX(total_bill_amount) AS DOUBLE) AS max_cost, {rdiv(f'SUM({C})', 'COUNT(total_bill_amount) * 100', 2)} AS avg_cost
FROM (SELECT *, CAST(NTILE(4) OVER (ORDER BY total_bill_amount ASC NULLS LAST, id) AS INTEGER) AS quartile FROM enc) t
GROUP BY quartile""",
    "spend_cdf": H + """SELECT patient_id, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount,
  CUME_DIST() OVER (ORDER BY total_bill_amount ASC NULLS LAST) AS cdf FROM enc""",
    "cdf_threshold": H + """SELECT MAX(CASE WHEN cdf <= 0.8 THEN b END) AS bill_at_or_below_p,
  MIN(CASE WHEN cdf >= 0.8 THEN b END) AS bill_at_or_above_p, COUNT(*) FILTER (WHERE cdf > 0.9) AS rows_above_top
FROM (SELECT CAST(total_bill_amount AS DOUBLE) AS b,
        CUME_DIST() OVER (ORDER BY total_bill_amount ASC NULLS LAST) AS cdf FROM enc) t""",
    "visit_sequence": H + f"""SELECT patient_id, admission_date, ROW_NUMBER() OVER ({WP}) AS visit_number,
  LAG(admission_date) OVER ({WP}) AS prev_visit, LEAD(admission_date) OVER ({WP}) AS next_visit FROM enc""",
    "pareto_top1": H + f"""SELECT CAST(SUM(total_spend) FILTER (WHERE percentile = 1) AS DOUBLE) AS top_1_percent_cost,
  CAST(SUM(total_spend) AS DOUBLE) AS total_hospital_revenue FROM ({TOPB}) t""",
    "top1_patients": H + f"""SELECT patient_id, CAST(total_spend AS DOUBLE) AS total_spend FROM ({TOPB}) t
WHERE percentile = 1 ORDER BY total_spend DESC""",
    "bill_zscore": H + f""", st AS (
  SELECT COUNT(*) AS n, SUM(CAST({C} AS HUGEINT)) AS s, SUM(CAST({C} AS HUGEINT) * CAST({C} AS HUGEINT)) AS q
  FROM enc WHERE total_bill_amount IS NOT NULL),
st2 AS (SELECT n, s, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mean_c,
  NULLIF(sqrt(greatest(CASE WHEN n > 1 THEN (CAST(q AS DOUBLE) - CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / CAST(n AS DOUBLE))
    / (CAST(n AS DOUBLE) - 1) END, 0.0)), 0.0) AS sd_c FROM st),
z AS (SELECT e.patient_id, e.total_bill_amount, st2.*, ({C} - mean_c) / sd_c AS z FROM enc e CROSS JOIN st2
      WHERE e.total_bill_amount IS NOT NULL)
SELECT patient_id, CAST(total_bill_amount AS DOUBLE) AS total_bill_amount, {rdiv('s', 'n * 100', 2)} AS population_mean,
  ROUND(sd_c / 100, 2) + 0.0 AS standard_deviation, ROUND(z, 2) + 0.0 AS z_score,
  CASE WHEN z > 3 THEN 'Extreme Outlier (3σ+)' WHEN z > 2 THEN 'Moderate Outlier (2σ+)' WHEN z > 1 THEN 'Above Average (1σ+)'
       WHEN z < -1 THEN 'Below Average (-1σ)' ELSE 'Normal Range' END AS outlier_status
FROM z ORDER BY z_score DESC""",
    "bill_spread": H + f"""SELECT primary_diagnosis, COUNT(total_bill_amount) AS bills,
  {rdiv(f'SUM({C})', 'COUNT(total_bill_amount) * 100', 2)} AS avg_bill,
  ROUND(stddev_samp(CAST(total_bill_amount AS DOUBLE)), 2) AS bill_stddev FROM enc GROUP BY 1""",
    "patient_bill_share": H + f"""SELECT e.id, e.patient_id, CAST(e.total_bill_amount AS DOUBLE) AS total_bill_amount,
  CAST(t.total AS DOUBLE) AS patient_total, t.visits AS patient_visits,
  {rdiv('CAST(e.total_bill_amount * 100 AS BIGINT) * 100', 't.total * 100', 2)} AS pct_of_patient
FROM enc e JOIN (SELECT patient_id, SUM(total_bill_amount) AS total, COUNT(*) AS visits FROM enc GROUP BY 1) t USING (patient_id)""",
}
