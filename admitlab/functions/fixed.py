"""Labels, cut points and weights of the reference's CASE
rules, which results must reproduce exactly.  Each ladder lists its branches
in the order the rule tests them: (upper or lower bound, label), then the
label of the ELSE branch."""

# Fixed values ---------------------------------------------------------------

# age bracket: age < 30, age BETWEEN 30 AND 60, age > 60, else
AGE_YOUNG_LABELS = ("Young Age", "Young Adult")
AGE_MIDDLE, AGE_SENIOR, AGE_UNKNOWN = "Middle Age", "Senior", "Unknown"

# income tier: income < bound
INCOME_TIERS = [(40000, "Low Income"), (80000, "Middle Income")]
INCOME_TIER_ELSE = "High Income"

# LACE risk: score > bound
LACE_RISK = [(10, "High"), (5, "Medium")]
LACE_RISK_ELSE = "Low"

# readmission gap tiers: gap <= bound
GAP_TIERS_4 = [(7, "≤7 days (Critical)"), (14, "8-14 days (High Risk)"), (30, "15-30 days (Moderate)")]
GAP_TIERS_4_OVER = ">30 days (Low Risk)"
GAP_TIERS_5 = [(7, "≤7 days"), (14, "8-14 days"), (30, "15-30 days"), (60, "31-60 days")]
GAP_TIERS_5_ELSE = ">60 days"
GAP_RISK = [(7, "🚨 CRITICAL (≤7 days)"), (14, "🔴 HIGH RISK (8-14 days)"), (30, "🟡 MODERATE RISK (15-30 days)")]
GAP_FIRST_VISIT = "🆕 First Visit"
GAP_RISK_ELSE = "🟢 LOW RISK (30+ days)"

# medication adherence: missed = 0, missed <= bound
ADHERENCE_PERFECT = "Perfect Adherence"
ADHERENCE = [(2, "Good Adherence"), (4, "Poor Adherence")]
ADHERENCE_ELSE = "Critical Non-Adherence"

# ICU use: ratio > bound
ICU_USE = [(0.5, "High ICU Use"), (0.2, "Moderate ICU Use"), (0, "Low ICU Use")]
ICU_USE_ELSE = "No ICU"

# age x income cross table: age < 40, age BETWEEN 40 AND 64, else;
# income < 30000, income BETWEEN 30000 AND 75000, else
CROSS_AGE = ("Under 40", "40-64 (Working Age)", "65+ (Medicare Age)")
CROSS_AGE_BOUNDS = (40, 64)
CROSS_INCOME = ("Low Income", "Middle Income", "High Income")
CROSS_INCOME_BOUNDS = (30000, 75000)

# wealth class: income > 100000, income < 30000, else
WEALTH = ("Wealthy", "Low Income", "Middle Class")
WEALTH_BOUNDS = (100000, 30000)

# payers counted as insured
INSURED = ("Medicare", "Private", "Medicaid")
COVERAGE = ("Insured", "Uninsured")

# weighted risk score: age > 70, 'Heart Failure', Emergency, LACE > 10,
# 5 per comorbidity point; tiers score >= bound
RISK_WEIGHTS = {"age_over_70": 20, "heart_failure": 30, "emergency": 10, "lace_over_10": 40,
                "per_comorbidity": 5}
RISK_TIERS = [(80, "High Risk"), (50, "Medium Risk")]
RISK_TIERS_ELSE = "Low Risk"

# clinical risk ladder for readmitted patients
RISK_LADDER = ("Critical Risk", "High Risk", "Moderate Risk", "Low Risk")

# stay against the diagnosis average: >= 2x, >= 1.5x, else
STAY_STATUS = ("Outlier (2x+)", "Extended Stay (1.5x+)", "Normal")

# bill against its moving average: > 1.5x, < 0.5x, else
BILL_STATUS = ("HIGH", "LOW", "Normal")

# bill against the previous visit
TRENDS = ("First Visit", "Increasing", "Decreasing", "Same")

# z-score bands: z > 3, z > 2, z > 1, z < -1, else
Z_BANDS = ("Extreme Outlier (3σ+)", "Moderate Outlier (2σ+)", "Above Average (1σ+)",
           "Below Average (-1σ)", "Normal Range")

# weekend: ISO day of week
WEEKEND_ISO_DAYS = (6, 7)
DAY_TYPES = ("Weekend", "Weekday")

# default fill values for missing data
FILL_INCOME, FILL_COMORBIDITY, FILL_BILL = 55000, 0, 20000
