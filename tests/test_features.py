import pytest
from conftest import values

from riskframe import FeatureEngineeringPipeline, FeatureTransformer, build_features
from riskframe.errors import MissingRequiredColumnError
from riskframe.operators.features import (
    BehavioralFeatureEngineer,
    ClinicalFeatureEngineer,
    DemographicsFeatureEngineer,
    LifestyleFeatureEngineer,
    MedicalFeatureEngineer,
    MetabolicFeatureEngineer,
)

ALL_FEATURES = {
    "age_group", "age_squared", "socioeconomic_vulnerability_flag", "glucose_category", "hba1c_category", "homa_ir",
    "insulin_resistance_flag", "bmi_category", "bp_category", "metabolic_syndrome_flag", "lipid_ratio_hdl_ldl",
    "cholesterol_hdl_ratio", "non_hdl_cholesterol", "bmi_glucose_interaction", "glucose_variability",
    "glycemic_excursion_ratio", "pulse_pressure", "mean_arterial_pressure", "triglyceride_hdl_ratio", "tyg_index",
    "tyg_bmi_index", "dyslipidemia_flag", "cardiometabolic_burden", "blood_pressure_ratio",
    "physical_activity_adequate", "activity_deficit_ratio", "screen_sleep_imbalance", "sleep_deviation_hours",
    "sedentary_risk", "lifestyle_score", "sleep_efficiency",
}


def test_all_features_created_and_rows_kept(full_df):
    out = build_features(full_df)
    assert ALL_FEATURES <= set(out.columns)
    assert out.count() == 2


def test_minimal_input_skips_optional_features(minimal_df):
    out = FeatureEngineeringPipeline().transform(minimal_df)
    assert {"age_group", "glucose_category", "bmi_category"} <= set(out.columns)
    assert not {"tyg_index", "dyslipidemia_flag", "lifestyle_score", "bp_category"} & set(out.columns)


def test_glucose_and_hba1c_bin_edges(spark):
    rows = [(0.0, 5.7), (99.0, 5.71), (99.5, 6.4), (100.0, 6.45), (125.0, 0.0), (125.01, None), (None, 5.0)]
    df = spark.createDataFrame(rows, "glucose_fasting double, hba1c double").selectExpr("*", "25.0D AS bmi")
    out = MedicalFeatureEngineer().transform(df)
    assert values(out, "glucose_category") == [
        None, "Normal", "Pre-Diabetes", "Pre-Diabetes", "Pre-Diabetes", "Diabetes", None,
    ]
    assert values(out, "hba1c_category") == [
        "Normal", "Pre-Diabetes", "Pre-Diabetes", "Diabetes", None, None, "Normal",
    ]


def test_bmi_and_age_bin_edges(spark):
    df = spark.createDataFrame(
        [(18.4999, 0), (18.5, 29), (25.0, 30), (30.0, 79), (-1.0, 80), (None, -1), (0.0, None), (float("inf"), 60)],
        "bmi double, age long",
    ).selectExpr("*", "100.0D AS glucose_fasting")
    assert values(MedicalFeatureEngineer().transform(df), "bmi_category") == [
        "Underweight", "Normal", "Overweight", "Obese", None, None, "Underweight", None,
    ]
    assert values(DemographicsFeatureEngineer().transform(df), "age_group") == [
        "<30", "<30", "30–39", "70–79", "80+", None, None, "60–69",
    ]
    assert values(DemographicsFeatureEngineer("coarse").transform(df), "age_group") == [
        "Young", "Young", "Adult", "Senior", "Senior", None, None, "Senior",
    ]


def test_unknown_age_strategy_and_missing_age(spark, minimal_df):
    with pytest.raises(ValueError):
        DemographicsFeatureEngineer("weekly").transform(minimal_df)
    with pytest.raises(KeyError):
        DemographicsFeatureEngineer().transform(spark.createDataFrame([(1.0,)], "bmi double"))


def test_mandatory_medical_inputs(spark):
    with pytest.raises(MissingRequiredColumnError):
        MedicalFeatureEngineer().transform(spark.createDataFrame([(1.0,)], "bmi double"))


def test_blood_pressure_categories_and_missing(spark):
    rows = [(110.0, 70.0), (130.0, 85.0), (180.0, 70.0), (130.0, 95.0), (119.0, 79.0), (120.0, 79.0), (139.0, 89.0),
            (139.0, 90.0), (None, 70.0)]
    df = spark.createDataFrame(rows, "systolic_bp double, diastolic_bp double").selectExpr(
        "*", "25.0D AS bmi", "100.0D AS glucose_fasting"
    )
    assert values(MedicalFeatureEngineer().transform(df), "bp_category") == [
        "Normal", "Pre-Hypertension", "Hypertension", "Hypertension", "Normal", "Pre-Hypertension",
        "Pre-Hypertension", "Hypertension", "Hypertension",
    ]


def test_flags_are_zero_for_missing_inputs(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)],
        "bmi double, systolic_bp double, triglycerides double, hdl_cholesterol double, glucose_fasting double",
    )
    medical, metabolic = MedicalFeatureEngineer().transform(df), MetabolicFeatureEngineer().transform(df)
    assert values(medical, "metabolic_syndrome_flag") == [0]
    assert values(metabolic, "cardiometabolic_burden") == [0]
    assert values(metabolic, "dyslipidemia_flag") == [0]
    assert values(metabolic, "tyg_index") == [None]


def test_homa_ir_and_resistance(spark):
    df = spark.createDataFrame([(81.0, 12.5), (81.0, 12.6)], "glucose_fasting double, insulin_level double").selectExpr(
        "*", "25.0D AS bmi"
    )
    out = MedicalFeatureEngineer().transform(df)
    assert values(out, "homa_ir")[0] == pytest.approx(2.5)
    assert values(out, "insulin_resistance_flag") == [0, 1]


def test_ratios_are_missing_on_zero(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 100.0, 0.0, 150.0, 120.0, 0.0)],
        "hdl_cholesterol double, ldl_cholesterol double, glucose_fasting double, cholesterol_total double, bmi double, "
        "glucose_postprandial double, systolic_bp double, diastolic_bp double",
    )
    clinical = ClinicalFeatureEngineer().transform(df).first()
    assert clinical.lipid_ratio_hdl_ldl is None
    assert clinical.cholesterol_hdl_ratio is None
    assert clinical.glycemic_excursion_ratio is None
    assert clinical.pulse_pressure == 120.0
    assert MetabolicFeatureEngineer().transform(df).first().blood_pressure_ratio is None


def test_non_negative_differences(spark):
    df = spark.createDataFrame(
        [(100.0, 120.0, 70.0, 90.0), (None, 50.0, 120.0, None)],
        "cholesterol_total double, hdl_cholesterol double, systolic_bp double, diastolic_bp double",
    )
    out = ClinicalFeatureEngineer().transform(df)
    assert values(out, "non_hdl_cholesterol") == [0.0, None]
    assert values(out, "pulse_pressure") == [0.0, None]


def test_activity_and_screen_boundaries(spark):
    rows = [(300.0, 3.0, 0.0), (150.0, 0.0, 0.0), (0.0, 30.0, 2.0), (9999.0, None, 8.0), (None, 6.0, 7.0)]
    df = spark.createDataFrame(
        rows,
        "physical_activity_minutes_per_week double, screen_time_hours_per_day double, sleep_hours_per_day double",
    )
    out = BehavioralFeatureEngineer().transform(df)
    assert values(out, "physical_activity_adequate") == [2.0, 1.0, 0.0, 3.0, None]
    assert values(out, "activity_deficit_ratio") == [0.0, 0.0, 1.0, 0.0, None]
    assert values(out, "screen_sleep_imbalance") == [5.0, None, 5.0, None, pytest.approx(6 / 7)]
    assert values(out, "sleep_deviation_hours") == [8.0, 8.0, 6.0, 0.0, 1.0]
    assert values(out, "sedentary_risk") == [0, 0, 1, 0, 0]


def test_lifestyle_scores(spark):
    rows = [(8.0, 200.0, 8.0, 1.0, "Never", 2.0), (2.0, 10.0, 4.0, 10.0, "Current", 12.0), (None, None, None, None, None, None)]
    df = spark.createDataFrame(
        rows,
        "diet_score double, physical_activity_minutes_per_week double, sleep_hours_per_day double, "
        "alcohol_consumption_per_week double, smoking_status string, screen_time_hours_per_day double",
    )
    out = LifestyleFeatureEngineer().transform(df)
    assert values(out, "lifestyle_score") == [10, 0, 0]
    assert values(out, "sleep_efficiency") == [2.0, pytest.approx(4 / 13), None]


def test_history_burden_counts_missing_as_zero(spark):
    df = spark.createDataFrame(
        [(None, None, None), (1, None, 1), (1, 1, 1)],
        "family_history_diabetes long, hypertension_history long, cardiovascular_history long",
    )
    assert values(MetabolicFeatureEngineer().transform(df), "medical_history_burden") == [0, 2, 3]


def test_nan_is_treated_as_missing(spark):
    df = spark.createDataFrame([(40, float("nan"), 100.0)], "age long, bmi double, glucose_fasting double")
    row = build_features(df, pipeline=FeatureEngineeringPipeline(validate_schema=False)).first()
    assert row.bmi is None and row.bmi_category is None


def test_protected_columns_come_first_and_survive(spark, full_df):
    df = full_df.selectExpr("*", "1 AS patient_id", "0 AS diagnosed_diabetes", "'x' AS diabetes_stage")
    out = build_features(df, target_column="diagnosed_diabetes", id_columns=["patient_id"])
    assert out.columns[:2] == ["patient_id", "diagnosed_diabetes"]
    assert "diabetes_stage" not in out.columns
    assert "diagnosed_diabetes" not in build_features(df).columns
    with pytest.raises(ValueError):
        build_features(df, id_columns=["absent"])


def test_rerun_replaces_features(full_df):
    once = build_features(full_df)
    twice = build_features(once)
    assert twice.columns == once.columns
    assert twice.collect() == once.collect()


def test_upper_case_age_wins(spark):
    df = spark.createDataFrame([(70, 20, 100.0, 25.0)], "Age long, age2 long, glucose_fasting double, bmi double")
    both = df.toDF("Age", "age", "glucose_fasting", "bmi")
    out = build_features(both, pipeline=FeatureEngineeringPipeline(validate_schema=False))
    assert out.first().age_group == "70–79"


def test_features_need_no_shuffle(full_df):
    plan = build_features(full_df, pipeline=FeatureEngineeringPipeline(validate_schema=False))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stage_can_be_saved(spark, full_df, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    model = Pipeline(stages=[FeatureTransformer(ageGroupStrategy="coarse")]).fit(full_df)
    model.write().overwrite().save(str(tmp_path / "stage"))
    loaded = PipelineModel.load(str(tmp_path / "stage"))
    assert values(loaded.transform(full_df), "age_group") == ["Adult", "Adult"]
