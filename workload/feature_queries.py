"""Features F1-F35 and the generic primitives G1-G9."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import build_features
from riskframe.functions import (
    bin_column,
    clip,
    count_flags,
    flag,
    guarded_log,
    recode,
    row_sum,
    safe_ratio,
    select_label,
)
from riskframe.operators import features as blocks
from riskframe.operators.features import FeatureTransformer
from workload.catalog import comparable, r, register
from workload.fixtures import patients, table, with_patients

INF = float("inf")


def _bins(column: str, edges: list, labels: list[str], right: bool) -> str:
    cases = []
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        if right:
            upper = "" if high is None else f" AND {column} <= {high}"
            cases.append(f"WHEN {column} > {low}{upper} THEN '{label}'")
        else:
            upper = "" if high is None else f" AND {column} < {high}"
            cases.append(f"WHEN {column} >= {low}{upper} THEN '{label}'")
    return f"CASE {' '.join(cases)} END"


def _flag(predicate: str) -> str:
    return f"CAST(CASE WHEN {predicate} THEN 1 ELSE 0 END AS BIGINT)"


SYNDROME = ["bmi >= 30", "systolic_bp >= 130", "triglycerides >= 150", "hdl_cholesterol < 40", "glucose_fasting >= 110"]
BURDEN = " + ".join(_flag(p) for p in SYNDROME)
TYG = "CASE WHEN glucose_fasting * triglycerides > 0 THEN ln(glucose_fasting * triglycerides / 2) END"
HOMA = "glucose_fasting * insulin_level / 405"
LIFESTYLE = [
    "diet_score >= 6", "physical_activity_minutes_per_week >= 150", "sleep_hours_per_day BETWEEN 7 AND 9",
    "alcohol_consumption_per_week <= 2", "smoking_status = 'Never'",
]
IMBALANCE = (
    "CASE WHEN sleep_hours_per_day = 0 AND screen_time_hours_per_day > 0 THEN 5.0 WHEN sleep_hours_per_day = 0 THEN NULL "
    "WHEN screen_time_hours_per_day / nullif(sleep_hours_per_day, 0) > 5 THEN 5.0 "
    "ELSE screen_time_hours_per_day / nullif(sleep_hours_per_day, 0) END"
)
EFFICIENCY = (
    "CASE WHEN sleep_hours_per_day / nullif(screen_time_hours_per_day + 1, 0) > 2 THEN 2.0 "
    "ELSE sleep_hours_per_day / nullif(screen_time_hours_per_day + 1, 0) END"
)
ADEQUATE = (
    "CASE WHEN physical_activity_minutes_per_week / 150 > 3 THEN 3.0 ELSE physical_activity_minutes_per_week / 150 END"
)
DEFICIT = (
    "CASE WHEN (150 - physical_activity_minutes_per_week) / 150 > 1 THEN 1.0 "
    "WHEN (150 - physical_activity_minutes_per_week) / 150 < 0 THEN 0.0 "
    "ELSE (150 - physical_activity_minutes_per_week) / 150 END"
)

# inventory id -> (block, output column, oracle expression)
FEATURES: dict[str, tuple[str, str, str]] = {
    "f02": ("demographics", "age_group", _bins("age", [0, 30, 40, 50, 60, 70, 80, None],
            ["<30", "30–39", "40–49", "50–59", "60–69", "70–79", "80+"], False)),
    "f03": ("coarse", "age_group", _bins("age", [0, 30, 60, None], ["Young", "Adult", "Senior"], False)),
    "f04": ("demographics", "age_squared", "age * age"),
    "f05": ("demographics", "socioeconomic_vulnerability_flag",
            _flag("income_level IN ('Low', 'Lower-Middle') AND education_level IN ('No formal', 'Highschool')")),
    "f06": ("medical", "glucose_category", _bins("glucose_fasting", [0, 99, 125, None], ["Normal", "Pre-Diabetes", "Diabetes"], True)),
    "f07": ("medical", "hba1c_category", _bins("hba1c", [0, "CAST(5.7 AS DOUBLE)", "CAST(6.4 AS DOUBLE)", None],
            ["Normal", "Pre-Diabetes", "Diabetes"], True)),
    "f08": ("medical", "homa_ir", r(HOMA)),
    "f09": ("medical", "insulin_resistance_flag", _flag(f"{HOMA} > 2.5")),
    "f10": ("medical", "bmi_category", _bins("bmi", [0, 18.5, 25, 30, None], ["Underweight", "Normal", "Overweight", "Obese"], False)),
    "f11": ("medical", "bp_category",
            "CASE WHEN systolic_bp <= 119 AND diastolic_bp <= 79 THEN 'Normal' "
            "WHEN systolic_bp <= 139 AND diastolic_bp <= 89 THEN 'Pre-Hypertension' ELSE 'Hypertension' END"),
    "f12": ("medical", "metabolic_syndrome_flag", _flag(f"({BURDEN}) >= 3")),
    "f13": ("clinical", "lipid_ratio_hdl_ldl", r("hdl_cholesterol / nullif(ldl_cholesterol, 0)")),
    "f14": ("clinical", "cholesterol_hdl_ratio", r("cholesterol_total / nullif(hdl_cholesterol, 0)")),
    "f15": ("clinical", "non_hdl_cholesterol",
            r("CASE WHEN cholesterol_total - hdl_cholesterol < 0 THEN 0 ELSE cholesterol_total - hdl_cholesterol END")),
    "f16": ("clinical", "bmi_glucose_interaction", r("bmi * glucose_fasting")),
    "f17": ("clinical", "glucose_variability", r("glucose_postprandial - glucose_fasting")),
    "f18": ("clinical", "glycemic_excursion_ratio", r("glucose_postprandial / nullif(glucose_fasting, 0)")),
    "f19": ("clinical", "pulse_pressure",
            r("CASE WHEN systolic_bp - diastolic_bp < 0 THEN 0 ELSE systolic_bp - diastolic_bp END")),
    "f20": ("clinical", "mean_arterial_pressure", r("(systolic_bp + diastolic_bp * 2) / 3")),
    "f21": ("clinical", "triglyceride_hdl_ratio", r("triglycerides / nullif(hdl_cholesterol, 0)")),
    "f22": ("metabolic", "tyg_index", r(TYG)),
    "f23": ("metabolic", "tyg_bmi_index", r(f"({TYG}) * bmi")),
    "f24": ("metabolic", "dyslipidemia_flag", _flag("triglycerides >= 150 OR hdl_cholesterol < 40")),
    "f25": ("metabolic", "cardiometabolic_burden", BURDEN),
    "f26": ("metabolic", "blood_pressure_ratio", r("systolic_bp / nullif(diastolic_bp, 0)")),
    "f27": ("metabolic", "medical_history_burden",
            "coalesce(family_history_diabetes, 0) + coalesce(hypertension_history, 0) + coalesce(cardiovascular_history, 0)"),
    "f28": ("behavioral", "physical_activity_adequate", r(ADEQUATE)),
    "f29": ("behavioral", "activity_deficit_ratio", r(DEFICIT)),
    "f30": ("behavioral", "screen_sleep_imbalance", r(IMBALANCE)),
    "f31": ("behavioral", "sleep_deviation_hours", r("abs(sleep_hours_per_day - 8)")),
    "f32": ("behavioral", "sedentary_risk", _flag("screen_time_hours_per_day >= 6 AND physical_activity_minutes_per_week < 150")),
    "f33": ("lifestyle", "lifestyle_score", f"({' + '.join(_flag(p) for p in LIFESTYLE)}) * 2"),
    "f34": ("lifestyle", "sleep_efficiency", r(EFFICIENCY)),
}

BLOCKS = {
    "demographics": blocks.DemographicsFeatureEngineer(),
    "coarse": blocks.DemographicsFeatureEngineer("coarse"),
    "medical": blocks.MedicalFeatureEngineer(),
    "clinical": blocks.ClinicalFeatureEngineer(),
    "metabolic": blocks.MetabolicFeatureEngineer(),
    "behavioral": blocks.BehavioralFeatureEngineer(),
    "lifestyle": blocks.LifestyleFeatureEngineer(),
}


def _register_feature(key: str, block: str, column: str, expression: str) -> None:
    sql = with_patients(f"SELECT patient_id, {expression} AS {column} FROM patients")
    suffix = f"{column}_coarse" if block == "coarse" else column

    @register(f"{key}_{suffix}", sql)
    def query(spark, sf_dir):
        return comparable(BLOCKS[block].transform(patients(spark, sf_dir)).select("patient_id", column))


for _key, (_block, _column, _expression) in FEATURES.items():
    _register_feature(_key, _block, _column, _expression)

_ALL = {c: e for k, (b, c, e) in FEATURES.items() if b != "coarse"}
_KEPT = (
    "patient_id, diagnosed_diabetes, age, income_level, education_level, "
    "CASE gender WHEN 'Other' THEN 'Unknown' ELSE gender END AS gender, "
    "CASE employment_status WHEN 'Retired' THEN 'Inactive' WHEN 'Unemployed' THEN 'Inactive' ELSE employment_status END AS employment_status, "
    "CASE smoking_status WHEN 'Former' THEN 'Ex-Smoker' ELSE smoking_status END AS smoking_status, "
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in ("glucose_fasting", "glucose_postprandial", "hba1c", "bmi", "systolic_bp", "diastolic_bp",
                  "triglycerides", "hdl_cholesterol", "ldl_cholesterol", "cholesterol_total", "insulin_level",
                  "physical_activity_minutes_per_week", "screen_time_hours_per_day", "sleep_hours_per_day",
                  "diet_score", "alcohol_consumption_per_week")
    )
    + ", family_history_diabetes, hypertension_history, cardiovascular_history"
)
FULL_SQL = with_patients(f"SELECT {_KEPT}, {', '.join(f'{e} AS {c}' for c, e in _ALL.items())} FROM patients")


@register("f35_full_features", FULL_SQL)
def f35(spark, sf_dir):
    rows = patients(spark, sf_dir).drop("encounter_ts")
    return comparable(build_features(rows, target_column="diagnosed_diabetes", id_columns=["patient_id"]))


@register("f35_feature_stage", FULL_SQL)
def f35_stage(spark, sf_dir):
    stage = FeatureTransformer(targetColumn="diagnosed_diabetes", idColumns=["patient_id"])
    return comparable(stage.transform(patients(spark, sf_dir).drop("encounter_ts")))


@register(
    "f01_age_source_column",
    with_patients(f"SELECT patient_id, {FEATURES['f02'][2]} AS age_group, age * age AS age_squared FROM patients"),
)
def f01(spark, sf_dir):
    """The capitalized spelling is used when present."""
    df = patients(spark, sf_dir).withColumnRenamed("age", "Age")
    return comparable(BLOCKS["demographics"].transform(df).select("patient_id", "age_group", "age_squared"))


@register(
    "risk_summary_by_bmi",
    with_patients(
        f"SELECT {FEATURES['f10'][2]} AS bmi_category, count(*) AS patients, "
        f"CAST(sum({FEATURES['f12'][2]}) AS BIGINT) AS with_syndrome, {r('avg(' + FEATURES['f12'][2] + ')')} AS syndrome_rate "
        "FROM patients GROUP BY 1"
    ),
)
def risk_summary(spark, sf_dir):
    features = BLOCKS["medical"].transform(patients(spark, sf_dir))
    return comparable(
        features.groupBy("bmi_category").agg(
            F.count("*").alias("patients"),
            F.sum("metabolic_syndrome_flag").alias("with_syndrome"),
            F.avg("metabolic_syndrome_flag").alias("syndrome_rate"),
        )
    )


# ---- generic primitives on the native tables ---------------------------------------------

@register(
    "g1_bin_right",
    f"SELECT {_bins('l_quantity', [0, 10, 25, None], ['small', 'medium', 'large'], True)} AS size, count(*) AS lines "
    "FROM lineitem GROUP BY 1",
)
def g1_right(spark, sf_dir):
    size = bin_column(F.col("l_quantity"), [0, 10, 25, INF], ["small", "medium", "large"], right=True)
    return table(spark, sf_dir, "lineitem").groupBy(size.alias("size")).agg(F.count("*").alias("lines"))


@register(
    "g1_bin_left",
    f"SELECT {_bins('value', [0, 1, 5, 50], ['low', 'mid', 'high'], False)} AS band, count(*) AS events FROM events GROUP BY 1",
)
def g1_left(spark, sf_dir):
    band = bin_column(F.col("value"), [0, 1, 5, 50], ["low", "mid", "high"], right=False)
    return table(spark, sf_dir, "events").groupBy(band.alias("band")).agg(F.count("*").alias("events"))


@register(
    "g2_safe_ratio",
    f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice / nullif(l_quantity - 10, 0)', 9)} AS ratio FROM lineitem",
)
def g2(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ratio = safe_ratio(F.col("l_extendedprice"), F.col("l_quantity") - 10)
    return comparable(lines.select("l_orderkey", "l_linenumber", ratio.alias("ratio")), 9)


@register(
    "g3_clip",
    f"SELECT event_id, {r('CASE WHEN value > 20 THEN 20 WHEN value < 2 THEN 2 ELSE value END')} AS clipped FROM events",
)
def g3(spark, sf_dir):
    return comparable(table(spark, sf_dir, "events").select("event_id", clip(F.col("value"), 2.0, 20.0).alias("clipped")))


@register(
    "g4_flag",
    with_patients(f"SELECT patient_id, {_flag('glucose_fasting > 125')} AS high, {_flag('bmi < 20')} AS thin FROM patients"),
)
def g4(spark, sf_dir):
    df = patients(spark, sf_dir)
    return df.select("patient_id", flag(F.col("glucose_fasting") > 125).alias("high"), flag(F.col("bmi") < 20).alias("thin"))


@register(
    "g5_count_flags",
    f"SELECT l_orderkey, l_linenumber, ({_flag('l_quantity > 30')} + {_flag('l_discount > CAST(0.05 AS DOUBLE)')} + "
    f"{_flag('l_tax = 0')}) * 2 AS score FROM lineitem",
)
def g5(spark, sf_dir):
    score = count_flags([F.col("l_quantity") > 30, F.col("l_discount") > 0.05, F.col("l_tax") == 0], weight=2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score"))


@register(
    "g6_select_label",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'good' END AS standing FROM customer",
)
def g6(spark, sf_dir):
    balance = F.col("c_acctbal")
    label = select_label([balance < 0, balance < 1000], ["debt", "low"], "good")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), label.alias("standing"))


@register(
    "g7_recode",
    "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Industry' "
    "ELSE c_mktsegment END AS segment FROM customer",
)
def g7(spark, sf_dir):
    segment = recode(F.col("c_mktsegment"), {"BUILDING": "Construction", "MACHINERY": "Industry"})
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), segment.alias("segment"))


@register(
    "g8_row_sum",
    with_patients(f"SELECT patient_id, {r('coalesce(glucose_fasting, 0) + coalesce(bmi, 0) + coalesce(hba1c, 0)')} AS total FROM patients"),
)
def g8(spark, sf_dir):
    df = patients(spark, sf_dir)
    total = row_sum([F.col("glucose_fasting"), F.col("bmi"), F.col("hba1c")])
    return comparable(df.select("patient_id", total.alias("total")))


@register(
    "g9_guarded_log",
    f"SELECT c_custkey, {r('CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END')} AS log_balance FROM customer",
)
def g9(spark, sf_dir):
    return comparable(table(spark, sf_dir, "customer").select("c_custkey", guarded_log(F.col("c_acctbal")).alias("log_balance")))
