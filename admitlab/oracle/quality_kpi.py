"""Oracle SQL for SURVEY 2.1 (quality) and 2.2 (KPIs)."""

from . import ENC_CTE, rdiv, ravg, with_ctes

H = with_ctes(ENC_CTE)
BILLD = "CAST(total_bill_amount AS DOUBLE)"
LOS = "datediff('day', admission_date, discharge_date)"


def rate(d):
    return rdiv("SUM(readmitted_30_days) * 100", "COUNT(readmitted_30_days)", d)


# Column order, Spark type names and nullability of the encounter table
# (its schema as Spark declares it: CASE expressions over literals only are
# NOT NULL, everything read from Parquet is nullable).
ENC_SCHEMA = [
    ("id", "bigint", "YES"), ("patient_key", "bigint", "YES"), ("patient_id", "string", "YES"),
    ("age", "int", "YES"), ("gender", "string", "NO"), ("admission_date", "date", "YES"),
    ("discharge_date", "date", "YES"), ("household_income", "decimal(12,2)", "YES"),
    ("insurance_type", "string", "NO"), ("insurance_raw", "string", "NO"),
    ("primary_diagnosis", "string", "YES"), ("comorbidity_score", "int", "YES"),
    ("icu_utilization_ratio", "decimal(5,4)", "YES"), ("missed_medications", "int", "YES"),
    ("total_bill_amount", "decimal(12,2)", "YES"), ("out_of_pocket_ratio", "decimal(5,4)", "YES"),
    ("readmitted_30_days", "int", "NO"), ("hospital_region", "string", "YES"),
    ("hospital_type", "string", "NO"), ("discharge_disposition", "string", "NO"),
    ("admission_type", "string", "NO"), ("previous_admissions_12m", "int", "YES"),
]


def _profile_sql() -> str:
    parts = []
    for i, (c, t, nullable) in enumerate(ENC_SCHEMA):
        parts.append(f"SELECT CAST({i + 1} AS INTEGER) AS ordinal_position, '{c}' AS column_name, '{t}' AS data_type, "
                     f"'{nullable}' AS is_nullable, "
                     f"COUNT(*) AS row_count, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count, "
                     f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_count FROM enc")
    return H + "\nUNION ALL\n".join(parts)


def _initcap(x: str) -> str:
    """PostgreSQL INITCAP in DuckDB: upper a letter at the start or after a
    non-alphanumeric character, lower the rest."""
    s = f"lower({x})"
    return (f"array_to_string(list_transform(range(length({s})), lambda i: CASE WHEN i = 0 "
            f"OR NOT regexp_matches(substr({s}, i, 1), '[a-z0-9]') THEN upper(substr({s}, i + 1, 1)) "
            f"ELSE substr({s}, i + 1, 1) END), '')")


AGE_BRACKET = """CASE WHEN age < 30 THEN '{young}' WHEN age BETWEEN 30 AND 60 THEN 'Middle Age'
  WHEN age > 60 THEN 'Senior' ELSE 'Unknown' END"""

ORACLE = {
    # ---- 2.1
    "column_profile": _profile_sql(),
    "orphan_encounters": "SELECT COUNT(*) AS encounters, COUNT(*) FILTER (WHERE o_custkey IS NULL OR o_custkey NOT IN"
                         " (SELECT c_custkey FROM customer)) AS orphans FROM orders",
    "table_scan": H + "SELECT * FROM enc",
    "table_sample": H + "SELECT * FROM enc ORDER BY id LIMIT 10",
    "row_count": H + "SELECT COUNT(*) AS total_rows FROM enc",
    "impute_income": H + """SELECT patient_id, insurance_type, CAST(household_income AS DOUBLE) AS raw_income,
  CAST(COALESCE(household_income, 55000) AS DOUBLE) AS cleaned_income FROM enc WHERE household_income IS NULL""",
    "standardize_labels": H + f"""SELECT raw_input, {_initcap('trim(raw_input)')} AS standardized_insurance
FROM (SELECT DISTINCT insurance_raw AS raw_input FROM enc) t""",
    "age_brackets": H + f"""SELECT DISTINCT patient_id, age, {AGE_BRACKET.format(young='Young Age')} AS age_bracket
FROM enc ORDER BY age DESC""",
    "age_brackets_rows": H + f"""SELECT patient_id, age, {AGE_BRACKET.format(young='Young Age')} AS age_bracket FROM enc""",
    "age_brackets_young_adult": H + f"""SELECT DISTINCT patient_id, age, {AGE_BRACKET.format(young='Young Adult')} AS age_bracket
FROM enc ORDER BY age""",
    "length_of_stay": H + f"SELECT patient_id, admission_date, discharge_date, {LOS} AS length_of_stay FROM enc",
    "impute_multi": H + """SELECT patient_id, CAST(COALESCE(household_income, 55000) AS DOUBLE) AS income,
  COALESCE(comorbidity_score, 0) AS comorbidity, CAST(COALESCE(total_bill_amount, 20000) AS DOUBLE) AS bill_amount,
  CASE WHEN household_income IS NULL OR comorbidity_score IS NULL OR total_bill_amount IS NULL
       THEN 'Imputed' ELSE 'Complete' END AS data_quality_flag,
  CASE WHEN COALESCE(household_income, 55000) IS NOT NULL THEN 'Complete' ELSE 'Imputed' END AS data_quality_flag_literal
FROM enc""",
    "threshold_outliers": H + f"""SELECT patient_id, age, {BILLD} AS total_bill_amount FROM enc
WHERE age > 100 OR total_bill_amount > 100000 ORDER BY total_bill_amount DESC NULLS FIRST""",
    "duplicate_encounters": H + """SELECT patient_id, admission_date, COUNT(*) AS duplicate_count FROM enc
GROUP BY patient_id, admission_date HAVING COUNT(*) > 1""",
    "drop_duplicate_encounters": H + """SELECT * FROM enc WHERE id IN (
  SELECT MIN(id) FROM enc GROUP BY patient_id, admission_date)""",
    "delete_duplicate_encounters": H + """SELECT * FROM enc e WHERE NOT EXISTS (
  SELECT 1 FROM enc f WHERE f.patient_id = e.patient_id AND f.admission_date = e.admission_date AND f.id < e.id)""",
    "missing_counts": H + """SELECT COUNT(*) FILTER (WHERE household_income IS NULL) AS missing_income,
  COUNT(*) FILTER (WHERE comorbidity_score IS NULL) AS missing_comorbidity,
  COUNT(*) FILTER (WHERE total_bill_amount IS NULL) AS missing_bill FROM enc""",
    "category_profile": H + """SELECT 'insurance_type' AS column_name, COUNT(DISTINCT insurance_type) AS distinct_count,
  string_agg(DISTINCT insurance_type, ', ' ORDER BY insurance_type) AS distinct_values FROM enc
UNION ALL
SELECT 'primary_diagnosis', COUNT(DISTINCT primary_diagnosis),
  string_agg(DISTINCT primary_diagnosis, ', ' ORDER BY primary_diagnosis) FROM enc""",
    "date_range": H + "SELECT MIN(admission_date) AS first_admission, MAX(admission_date) AS last_admission FROM enc",
    "numeric_ranges": H + f"""SELECT MIN(age) AS min_age, MAX(age) AS max_age, {rdiv('SUM(age)', 'COUNT(age)', 1)} AS avg_age,
  CAST(MIN(household_income) AS DOUBLE) AS min_income, CAST(MAX(household_income) AS DOUBLE) AS max_income FROM enc""",
    # ---- 2.2
    "readmission_rate": H + f"""SELECT COUNT(*) AS total_patients, CAST(SUM(readmitted_30_days) AS BIGINT) AS total_readmissions,
  {rate(2)} AS readmission_rate FROM enc""",
    "payer_mix": H + f"""SELECT insurance_type, total_patients,
  {rdiv('total_patients * 100', 'SUM(total_patients) OVER ()', 2)} AS pct_share
FROM (SELECT insurance_type, COUNT(*) AS total_patients FROM enc GROUP BY insurance_type) t ORDER BY pct_share DESC""",
    "payer_market_share": H + f"""SELECT insurance_type, total_patients,
  {rdiv('total_patients * 100', 'SUM(total_patients) OVER ()', 1)} AS market_share
FROM (SELECT insurance_type, COUNT(*) AS total_patients FROM enc GROUP BY insurance_type) t ORDER BY total_patients DESC""",
    "gender_distribution": H + f"""SELECT gender, total_patients,
  {rdiv('total_patients * 100', 'SUM(total_patients) OVER ()', 2)} AS pct_share
FROM (SELECT gender, COUNT(*) AS total_patients FROM enc GROUP BY gender) t""",
    "los_distribution": H + f"SELECT {LOS} AS los, COUNT(*) AS admissions FROM enc GROUP BY 1 ORDER BY 1",
    "top_diagnoses": H + "SELECT primary_diagnosis, COUNT(*) AS admissions FROM enc GROUP BY 1 ORDER BY 2 DESC",
    "rate_by_income_tier": H + f"""SELECT CASE WHEN household_income < 40000 THEN 'Low Income'
  WHEN household_income < 80000 THEN 'Middle Income' ELSE 'High Income' END AS income_tier,
  COUNT(*) AS total_patients, CAST(SUM(readmitted_30_days) AS BIGINT) AS readmitted_count, {rate(2)} AS readmission_rate
FROM enc GROUP BY 1 ORDER BY readmission_rate DESC""",
    "insured_vs_uninsured": H + f"""SELECT CASE WHEN insurance_type IN ('Medicare', 'Private', 'Medicaid') THEN 'Insured'
  ELSE 'Uninsured' END AS coverage_status, COUNT(*) AS patients, {ravg('total_bill_amount', 2, 0)} AS avg_bill
FROM enc GROUP BY 1""",
    "payer_price_gap": H + f"""SELECT primary_diagnosis,
  {ravg("CASE WHEN insurance_type = 'Medicare' THEN total_bill_amount END", 2, 0)} AS medicare_avg,
  {ravg("CASE WHEN insurance_type = 'Private' THEN total_bill_amount END", 2, 0)} AS private_avg,
  {rdiv("SUM(CAST(total_bill_amount * 100 AS HUGEINT)) FILTER (WHERE insurance_type = 'Medicare') * COUNT(total_bill_amount) FILTER (WHERE insurance_type = 'Private')"
        " - SUM(CAST(total_bill_amount * 100 AS HUGEINT)) FILTER (WHERE insurance_type = 'Private') * COUNT(total_bill_amount) FILTER (WHERE insurance_type = 'Medicare')",
        "COUNT(total_bill_amount) FILTER (WHERE insurance_type = 'Medicare') * COUNT(total_bill_amount) FILTER (WHERE insurance_type = 'Private') * 100", 0)} AS price_gap
FROM enc WHERE insurance_type IN ('Medicare', 'Private') AND primary_diagnosis = 'Heart Failure'
GROUP BY primary_diagnosis""",
    "rate_by_diagnosis": H + f"""SELECT primary_diagnosis, COUNT(*) AS total_cases,
  CAST(SUM(readmitted_30_days) AS BIGINT) AS readmissions, {rate(1)} AS readmission_rate
FROM enc GROUP BY 1 ORDER BY readmission_rate DESC""",
    "revenue_by_region": H + f"""SELECT hospital_region, COUNT(*) AS patient_volume,
  CAST(SUM(total_bill_amount) AS DOUBLE) AS total_revenue, {ravg('total_bill_amount', 2, 2)} AS avg_revenue_per_patient
FROM enc GROUP BY 1 ORDER BY total_revenue DESC""",
    "regional_stats": H + f"""SELECT hospital_region, COUNT(*) AS total_patients, {ravg('total_bill_amount', 2, 2)} AS avg_cost
FROM enc GROUP BY 1""",
    "los_by_hospital_type": H + f"""SELECT hospital_type, COUNT(*) AS admissions, {rdiv(f'SUM({LOS})', f'COUNT({LOS})', 1)} AS avg_los,
  MIN({LOS}) AS min_los, MAX({LOS}) AS max_los FROM enc GROUP BY 1""",
    "comorbidity_impact": H + f"""SELECT comorbidity_score, COUNT(*) AS patient_count, {rate(1)} AS readmission_rate,
  {ravg('total_bill_amount', 2, 0)} AS avg_cost, {rdiv(f'SUM({LOS})', f'COUNT({LOS})', 1)} AS avg_los
FROM enc WHERE comorbidity_score IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "adherence_impact": H + f"""SELECT CASE WHEN missed_medications = 0 THEN 'Perfect Adherence'
  WHEN missed_medications <= 2 THEN 'Good Adherence' WHEN missed_medications <= 4 THEN 'Poor Adherence'
  ELSE 'Critical Non-Adherence' END AS adherence_level, COUNT(*) AS patients, {rate(1)} AS readmission_rate
FROM enc GROUP BY 1 ORDER BY 1""",
    "icu_impact": H + f"""SELECT CASE WHEN icu_utilization_ratio > 0.5 THEN 'High ICU Use'
  WHEN icu_utilization_ratio > 0.2 THEN 'Moderate ICU Use' WHEN icu_utilization_ratio > 0 THEN 'Low ICU Use'
  ELSE 'No ICU' END AS icu_category, COUNT(*) AS patient_count, {rate(1)} AS readmission_rate,
  {ravg('total_bill_amount', 2, 0)} AS avg_cost
FROM enc GROUP BY 1 ORDER BY 1""",
    "payer_profitability": H + f"""SELECT insurance_type, COUNT(*) AS patients, {ravg('total_bill_amount', 2, 0)} AS avg_bill,
  {ravg('out_of_pocket_ratio', 4, 3)} AS avg_oop_ratio,
  {ravg('total_bill_amount * out_of_pocket_ratio', 6, 0)} AS avg_patient_payment,
  {ravg('total_bill_amount * (1 - out_of_pocket_ratio)', 6, 0)} AS avg_insurance_payment
FROM enc WHERE total_bill_amount IS NOT NULL GROUP BY 1 ORDER BY avg_insurance_payment DESC""",
    "age_income_crosstab": H + f"""SELECT CASE WHEN age < 40 THEN 'Under 40' WHEN age BETWEEN 40 AND 64 THEN '40-64 (Working Age)'
  ELSE '65+ (Medicare Age)' END AS age_group,
  CASE WHEN household_income < 30000 THEN 'Low Income' WHEN household_income BETWEEN 30000 AND 75000 THEN 'Middle Income'
  ELSE 'High Income' END AS income_level, COUNT(*) AS patient_count, {rate(1)} AS readmission_rate
FROM enc WHERE household_income IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
    "diagnosis_by_region": H + f"""SELECT hospital_region, primary_diagnosis, COUNT(*) AS case_count,
  {ravg('total_bill_amount', 2, 0)} AS avg_cost FROM enc GROUP BY 1, 2 ORDER BY 1, 3 DESC""",
    "revenue_pivot_by_month": H + """SELECT insurance_type,
  CAST(SUM(total_bill_amount) FILTER (WHERE month(admission_date) = 1) AS DOUBLE) AS jan_revenue,
  CAST(SUM(total_bill_amount) FILTER (WHERE month(admission_date) = 2) AS DOUBLE) AS feb_revenue,
  CAST(SUM(total_bill_amount) FILTER (WHERE month(admission_date) = 3) AS DOUBLE) AS mar_revenue
FROM enc GROUP BY insurance_type""",
    "wealth_health": H + f"""SELECT CASE WHEN household_income > 100000 THEN 'Wealthy' WHEN household_income < 30000 THEN 'Low Income'
  ELSE 'Middle Class' END AS income_class, {rdiv('SUM(comorbidity_score)', 'COUNT(comorbidity_score)', 2)} AS avg_sickness_score,
  {rdiv('SUM(age)', 'COUNT(age)', 0)} AS avg_age FROM enc GROUP BY 1 ORDER BY avg_sickness_score DESC""",
    "complex_chronic": H + f"""SELECT COUNT(*) AS complex_patients, {ravg('total_bill_amount', 2, 0)} AS avg_cost FROM enc
WHERE primary_diagnosis LIKE '%Hypertension%' AND comorbidity_score >= 3""",
    "multi_diagnosis_patients": H + """SELECT patient_id, COUNT(DISTINCT primary_diagnosis) AS unique_conditions FROM enc
GROUP BY patient_id HAVING COUNT(DISTINCT primary_diagnosis) > 1 ORDER BY unique_conditions DESC""",
    "revenue_per_day": H + f"""SELECT primary_diagnosis, {ravg('total_bill_amount', 2, 0)} AS revenue,
  {rdiv(f'SUM({LOS})', f'COUNT({LOS})', 1)} AS days,
  {rdiv(f'SUM(CAST(total_bill_amount * 100 AS HUGEINT)) * COUNT({LOS})', f'COUNT(total_bill_amount) * SUM({LOS}) * 100', 0)} AS rev_per_day
FROM enc GROUP BY 1 ORDER BY rev_per_day DESC""",
    "revenue_by_diagnosis": H + f"""SELECT primary_diagnosis, case_count, CAST(rev AS DOUBLE) AS total_revenue, avg_revenue_per_case,
  {rdiv('rev * 100 * 10000', 'SUM(rev * 100) OVER ()', 0)} / 100 AS pct_of_total_revenue
FROM (SELECT primary_diagnosis, COUNT(*) AS case_count, SUM(total_bill_amount) AS rev,
        {ravg('total_bill_amount', 2, 0)} AS avg_revenue_per_case
      FROM enc WHERE total_bill_amount IS NOT NULL GROUP BY 1) t ORDER BY total_revenue DESC""",
    "revenue_pareto": H + f"""SELECT * FROM (
  SELECT primary_diagnosis, case_count, CAST(rev AS DOUBLE) AS total_revenue, avg_revenue_per_case,
    pct_h / 100 AS pct_of_total_revenue, SUM(pct_h) OVER (ORDER BY rev DESC) / 100 AS cumulative_pct
  FROM (SELECT *, {rdiv('rev * 100 * 10000', 'SUM(rev * 100) OVER ()', 0)} AS pct_h
        FROM (SELECT primary_diagnosis, COUNT(*) AS case_count, SUM(total_bill_amount) AS rev,
                {ravg('total_bill_amount', 2, 0)} AS avg_revenue_per_case
              FROM enc WHERE total_bill_amount IS NOT NULL GROUP BY 1) a) b) c
WHERE cumulative_pct <= 80""",
    "executive_dashboard": H + f"""SELECT * FROM
  (SELECT CAST(SUM(total_bill_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS total_patients,
          {rate(2)} AS readmission_pct FROM enc) s,
  (SELECT primary_diagnosis AS top_driver FROM enc GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) t""",
    "executive_dashboard_wide": H + f"""SELECT * FROM
  (SELECT CAST(SUM(total_bill_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS total_patients,
          {rate(2)} AS readmission_pct,
          {rdiv('SUM(CAST(icu_utilization_ratio * 10000 AS HUGEINT)) * 100', 'COUNT(icu_utilization_ratio) * 10000', 2)} AS icu_utilization_pct,
          {rdiv(f'SUM({LOS})', f'COUNT({LOS})', 1)} AS avg_los FROM enc) s,
  (SELECT primary_diagnosis AS top_driver FROM enc GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) t""",
}
