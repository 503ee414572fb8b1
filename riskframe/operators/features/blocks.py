"""The six feature blocks as dictionaries of column expressions.

A block maps an output name to an expression over *input* columns only, so every block (or all
six together) is one projection that Catalyst folds into the scan stage: no shuffle, no job.
An expression whose inputs are absent is left out; what was skipped is reported by name.
"""

from __future__ import annotations

import logging
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.errors import MissingRequiredColumnError
from riskframe.functions.columns import (
    bin_column,
    clip,
    count_flags,
    flag,
    guarded_log,
    row_sum,
    safe_ratio,
    select_label,
)
from riskframe.operators.features import thresholds as T

LOGGER = logging.getLogger(__name__)

Builder = Callable[..., Column]
# (output column, input columns, expression over those inputs in that order)
Spec = tuple[str, tuple[str, ...], Builder]

GLUCOSE, BMI = "glucose_fasting", "bmi"
SBP, DBP = "systolic_bp", "diastolic_bp"
HDL, LDL, TRIG, CHOL = "hdl_cholesterol", "ldl_cholesterol", "triglycerides", "cholesterol_total"
POSTPRANDIAL, INSULIN = "glucose_postprandial", "insulin_level"
ACTIVITY = "physical_activity_minutes_per_week"
SCREEN, SLEEP = "screen_time_hours_per_day", "sleep_hours_per_day"
SYNDROME_INPUTS = (BMI, SBP, TRIG, HDL, GLUCOSE)


def resolve_age_column(columns: Sequence[str]) -> str:
    """``Age`` wins over ``age``; one of them must exist."""
    for name in ("Age", "age"):
        if name in columns:
            return name
    raise KeyError("an 'Age' or 'age' column is required")


def _syndrome_criteria(bmi: Column, sbp: Column, trig: Column, hdl: Column, glucose: Column) -> list[Column]:
    return [
        bmi >= T.SYNDROME_BMI,
        sbp >= T.SYNDROME_SBP,
        trig >= T.SYNDROME_TRIGLYCERIDES,
        hdl < T.SYNDROME_HDL,
        glucose >= T.SYNDROME_GLUCOSE,
    ]


def _homa_ir(glucose: Column, insulin: Column) -> Column:
    return glucose * insulin / T.HOMA_IR_DIVISOR


def _triglyceride_glucose(glucose: Column, trig: Column) -> Column:
    return guarded_log(glucose * trig / 2)


def _screen_sleep(screen: Column, sleep: Column) -> Column:
    # dividing by zero hours of sleep reaches the cap, 0/0 is unknown
    ratio = clip(safe_ratio(screen, sleep), high=float(T.SCREEN_SLEEP_CAP))
    return F.when((sleep == 0) & (screen > 0), F.lit(float(T.SCREEN_SLEEP_CAP))).otherwise(ratio)


def _lifestyle(diet: Column, activity: Column, sleep: Column, alcohol: Column, smoking: Column) -> Column:
    return count_flags(
        [
            diet >= T.LIFESTYLE_DIET_MIN,
            activity >= T.ACTIVITY_TARGET_MINUTES,
            sleep.between(*T.LIFESTYLE_SLEEP_RANGE),
            alcohol <= T.LIFESTYLE_ALCOHOL_MAX,
            smoking.cast("string") == T.NEVER_SMOKER,  # a coded column matches no label
        ],
        weight=T.LIFESTYLE_POINTS,
    )


def demographics_specs(columns: Sequence[str], age_group_strategy: str = "detailed") -> list[Spec]:
    groupings = {
        "detailed": (T.AGE_DETAILED_EDGES, T.AGE_DETAILED_LABELS),
        "coarse": (T.AGE_COARSE_EDGES, T.AGE_COARSE_LABELS),
    }
    if age_group_strategy not in groupings:
        raise ValueError(f"age_group_strategy must be one of {sorted(groupings)}, got {age_group_strategy!r}")
    edges, labels = groupings[age_group_strategy]
    age = resolve_age_column(columns)
    return [
        ("age_group", (age,), lambda a: bin_column(a, edges, labels, right=False)),
        ("age_squared", (age,), lambda a: a * a),
        (
            "socioeconomic_vulnerability_flag",
            ("income_level", "education_level"),
            lambda income, education: flag(
                income.cast("string").isin(T.LOW_INCOME) & education.cast("string").isin(T.LOW_EDUCATION)
            ),
        ),
    ]


def medical_specs(columns: Sequence[str]) -> list[Spec]:
    missing = [name for name in (GLUCOSE, BMI) if name not in columns]
    if missing:
        raise MissingRequiredColumnError(missing)
    glucose_edges = [0, T.GLUCOSE_NORMAL_MAX, T.GLUCOSE_PREDIABETES_MAX, T.INFINITY]
    hba1c_edges = [0, T.HBA1C_NORMAL_MAX, T.HBA1C_PREDIABETES_MAX, T.INFINITY]
    bmi_edges = [0, T.BMI_UNDERWEIGHT_MAX, T.BMI_NORMAL_MAX, T.BMI_OVERWEIGHT_MAX, T.INFINITY]
    return [
        ("glucose_category", (GLUCOSE,), lambda g: bin_column(g, glucose_edges, T.GLYCEMIC_LABELS, right=True)),
        ("hba1c_category", ("hba1c",), lambda h: bin_column(h, hba1c_edges, T.GLYCEMIC_LABELS, right=True)),
        ("homa_ir", (GLUCOSE, INSULIN), _homa_ir),
        (
            "insulin_resistance_flag",
            (GLUCOSE, INSULIN),
            lambda g, i: flag(_homa_ir(g, i) > T.HOMA_IR_RESISTANCE),
        ),
        ("bmi_category", (BMI,), lambda b: bin_column(b, bmi_edges, T.BMI_LABELS, right=False)),
        (
            "bp_category",
            (SBP, DBP),
            lambda s, d: select_label(
                [
                    (s <= T.SBP_NORMAL_MAX) & (d <= T.DBP_NORMAL_MAX),
                    (s <= T.SBP_PREHYPERTENSION_MAX) & (d <= T.DBP_PREHYPERTENSION_MAX),
                ],
                T.BP_LABELS,
                T.BP_DEFAULT,
            ),
        ),
        (
            "metabolic_syndrome_flag",
            SYNDROME_INPUTS,
            lambda *inputs: flag(count_flags(_syndrome_criteria(*inputs)) >= T.SYNDROME_MIN_CRITERIA),
        ),
    ]


def clinical_specs(columns: Sequence[str]) -> list[Spec]:
    return [
        ("lipid_ratio_hdl_ldl", (HDL, LDL), safe_ratio),
        ("cholesterol_hdl_ratio", (CHOL, HDL), safe_ratio),
        ("non_hdl_cholesterol", (CHOL, HDL), lambda total, hdl: clip(total - hdl, low=0)),
        ("bmi_glucose_interaction", (BMI, GLUCOSE), lambda b, g: b * g),
        ("glucose_variability", (POSTPRANDIAL, GLUCOSE), lambda after, fasting: after - fasting),
        ("glycemic_excursion_ratio", (POSTPRANDIAL, GLUCOSE), safe_ratio),
        ("pulse_pressure", (SBP, DBP), lambda s, d: clip(s - d, low=0)),
        ("mean_arterial_pressure", (SBP, DBP), lambda s, d: (s + d * 2) / 3),
        ("triglyceride_hdl_ratio", (TRIG, HDL), safe_ratio),
    ]


def metabolic_specs(columns: Sequence[str]) -> list[Spec]:
    history = ("family_history_diabetes", "hypertension_history", "cardiovascular_history")
    return [
        ("tyg_index", (GLUCOSE, TRIG), _triglyceride_glucose),
        ("tyg_bmi_index", (GLUCOSE, TRIG, BMI), lambda g, t, b: _triglyceride_glucose(g, t) * b),
        (
            "dyslipidemia_flag",
            (TRIG, HDL),
            lambda t, h: flag((t >= T.SYNDROME_TRIGLYCERIDES) | (h < T.SYNDROME_HDL)),
        ),
        ("cardiometabolic_burden", SYNDROME_INPUTS, lambda *inputs: count_flags(_syndrome_criteria(*inputs))),
        ("blood_pressure_ratio", (SBP, DBP), safe_ratio),
        ("medical_history_burden", history, lambda *flags: row_sum(flags)),
    ]


def behavioral_specs(columns: Sequence[str]) -> list[Spec]:
    target = T.ACTIVITY_TARGET_MINUTES
    return [
        (
            "physical_activity_adequate",
            (ACTIVITY,),
            lambda minutes: clip(minutes / target, high=float(T.ACTIVITY_RATIO_CAP)),
        ),
        (
            "activity_deficit_ratio",
            (ACTIVITY,),
            lambda minutes: clip((F.lit(target) - minutes) / target, low=0.0, high=1.0),
        ),
        ("screen_sleep_imbalance", (SCREEN, SLEEP), _screen_sleep),
        ("sleep_deviation_hours", (SCREEN, SLEEP), lambda _, sleep: F.abs(sleep - T.IDEAL_SLEEP_HOURS)),
        (
            "sedentary_risk",
            (SCREEN, ACTIVITY),
            lambda screen, minutes: flag((screen >= T.SEDENTARY_SCREEN_HOURS) & (minutes < target)),
        ),
    ]


def lifestyle_specs(columns: Sequence[str]) -> list[Spec]:
    return [
        (
            "lifestyle_score",
            ("diet_score", ACTIVITY, SLEEP, "alcohol_consumption_per_week", "smoking_status"),
            _lifestyle,
        ),
        (
            "sleep_efficiency",
            (SLEEP, SCREEN),
            lambda sleep, screen: clip(safe_ratio(sleep, screen + 1), high=float(T.SLEEP_EFFICIENCY_CAP)),
        ),
    ]


def build_columns(specs: Sequence[Spec], available: Sequence[str]) -> dict[str, Column]:
    """Expressions whose inputs all exist; the rest is logged and left out."""
    present = set(available)
    built: dict[str, Column] = {}
    for name, inputs, builder in specs:
        absent = [column for column in inputs if column not in present]
        if absent:
            LOGGER.warning("feature %s skipped, missing inputs %s", name, absent)
            continue
        built[name] = builder(*(F.col(f"`{column}`") for column in inputs))
    return built


class _FeatureBlock:
    """One block with a ``transform(df)`` face."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        raise NotImplementedError

    def columns(self, available: Sequence[str]) -> Mapping[str, Column]:
        return build_columns(self._specs(available), available)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(self.columns(df.columns)))


class DemographicsFeatureEngineer(_FeatureBlock):
    """Age group, squared age, socio-economic vulnerability."""

    def __init__(self, age_group_strategy: str = "detailed") -> None:
        self.age_group_strategy = age_group_strategy

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return demographics_specs(columns, self.age_group_strategy)


class MedicalFeatureEngineer(_FeatureBlock):
    """Glucose, HbA1c, insulin resistance, BMI, blood pressure, metabolic syndrome."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return medical_specs(columns)


class ClinicalFeatureEngineer(_FeatureBlock):
    """Lipid ratios, glycemic excursion, pressure derivatives."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return clinical_specs(columns)


class MetabolicFeatureEngineer(_FeatureBlock):
    """Triglyceride-glucose index, dyslipidemia, burden scores."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return metabolic_specs(columns)


class BehavioralFeatureEngineer(_FeatureBlock):
    """Activity, screen time and sleep balance."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return behavioral_specs(columns)


class LifestyleFeatureEngineer(_FeatureBlock):
    """Lifestyle score and sleep efficiency."""

    def _specs(self, columns: Sequence[str]) -> list[Spec]:
        return lifestyle_specs(columns)
