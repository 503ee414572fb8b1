"""Patient-shaped fixture derived from ``orders``: one SQL text for Spark and for the oracle.

Deterministic integer arithmetic on the order key, so the rows scale with the table. It contains
missing values, zero denominators, recodable categories and leakage columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PATIENTS_SQL = """
SELECT
  o_orderkey AS patient_id,
  o_orderdate AS encounter_ts,
  CAST(18 + (o_orderkey * 7) % 75 AS BIGINT) AS age,
  CASE WHEN o_orderkey % 20 = 0 THEN 'Other' WHEN o_orderkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE o_orderkey % 5 WHEN 0 THEN 'Retired' WHEN 1 THEN 'Unemployed' WHEN 2 THEN 'Student' ELSE 'Employed' END AS employment_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'Never' WHEN 1 THEN 'Former' ELSE 'Current' END AS smoking_status,
  CASE o_orderkey % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Lower-Middle' WHEN 2 THEN 'Middle' ELSE 'High' END AS income_level,
  CASE o_orderkey % 7 WHEN 0 THEN 'No formal' WHEN 1 THEN 'Highschool' WHEN 2 THEN 'Graduate' ELSE 'Postgraduate' END AS education_level,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(60 + (o_orderkey * 37) % 160 AS DOUBLE) END AS glucose_fasting,
  CAST(80 + (o_orderkey * 41) % 220 AS DOUBLE) AS glucose_postprandial,
  CAST(40 + (o_orderkey * 13) % 60 AS DOUBLE) / 10 AS hba1c,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST(150 + (o_orderkey * 11) % 300 AS DOUBLE) / 10 END AS bmi,
  CAST(95 + (o_orderkey * 17) % 85 AS DOUBLE) AS systolic_bp,
  CASE WHEN o_orderkey % 997 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(55 + (o_orderkey * 19) % 55 AS DOUBLE) END AS diastolic_bp,
  CASE WHEN o_orderkey % 503 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(60 + (o_orderkey * 23) % 240 AS DOUBLE) END AS triglycerides,
  CASE WHEN o_orderkey % 499 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(25 + (o_orderkey * 29) % 60 AS DOUBLE) END AS hdl_cholesterol,
  CAST(50 + (o_orderkey * 31) % 150 AS DOUBLE) AS ldl_cholesterol,
  CAST(120 + (o_orderkey * 43) % 180 AS DOUBLE) AS cholesterol_total,
  CAST(2 + (o_orderkey * 47) % 30 AS DOUBLE) AS insulin_level,
  CAST((o_orderkey * 53) % 600 AS DOUBLE) AS physical_activity_minutes_per_week,
  CAST((o_orderkey * 59) % 25 AS DOUBLE) / 2 AS screen_time_hours_per_day,
  CASE WHEN o_orderkey % 307 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(8 + (o_orderkey * 61) % 13 AS DOUBLE) / 2 END AS sleep_hours_per_day,
  CAST((o_orderkey * 67) % 11 AS DOUBLE) AS diet_score,
  CAST((o_orderkey * 71) % 9 AS DOUBLE) AS alcohol_consumption_per_week,
  CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS BIGINT) AS family_history_diabetes,
  CAST(CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END AS BIGINT) AS hypertension_history,
  CAST(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS cardiovascular_history,
  CAST((o_orderkey * 13) % 100 AS DOUBLE) / 100 AS diabetes_risk_score,
  CASE WHEN 40 + (o_orderkey * 13) % 60 >= 65 THEN 'Type 2' ELSE 'No Diabetes' END AS diabetes_stage,
  CAST(CASE WHEN 40 + (o_orderkey * 13) % 60 >= 65 OR (o_orderkey * 3) % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS diagnosed_diabetes
FROM orders
"""

# score with ties, used where metrics are checked without a trained model
SCORE_SQL = (
    "CAST(round((patient_id * 7919 % 1000) / 1000.0 * 0.6 + 0.4 * diagnosed_diabetes, 6) AS DOUBLE)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients as a lazy projection over the orders scan."""
    orders = table(spark, sf_dir, "orders")
    return spark.sql(PATIENTS_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, gender, label, score) with the fixed score."""
    return patients(spark, sf_dir).selectExpr(
        "patient_id", "gender", "age", "diagnosed_diabetes AS label", f"{SCORE_SQL} AS score"
    )


def with_patients(body: str) -> str:
    """Oracle SQL with ``patients`` as a CTE."""
    return f"WITH patients AS ({PATIENTS_SQL}) {body}"
