"""One local session for all tests and small frames mirroring the documented fixtures."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not present")
    return SF_DIR


@pytest.fixture()
def minimal_df(spark):
    return spark.createDataFrame([(40, 110, 27), (60, 150, 32)], "Age long, glucose_fasting long, bmi long")


@pytest.fixture()
def full_df(spark):
    names = (
        "Age long, gender string, income_level string, education_level string, glucose_fasting double, hba1c double, "
        "bmi double, systolic_bp double, diastolic_bp double, triglycerides double, hdl_cholesterol double, "
        "ldl_cholesterol double, cholesterol_total double, insulin_level double, glucose_postprandial double, "
        "physical_activity_minutes_per_week double, screen_time_hours_per_day double, sleep_hours_per_day double, "
        "diet_score double, alcohol_consumption_per_week double, smoking_status string"
    )
    rows = [
        (45, "Male", "Low", "Highschool", 110.0, 6.0, 28.0, 130.0, 85.0, 160.0, 38.0, 120.0, 200.0, 15.0, 150.0,
         100.0, 7.0, 6.0, 5.0, 3.0, "Never"),
        (30, "Female", "High", "Graduate", 90.0, 5.2, 22.0, 115.0, 75.0, 90.0, 60.0, 100.0, 180.0, 5.0, 110.0,
         200.0, 2.0, 8.0, 8.0, 1.0, "Never"),
    ]
    return spark.createDataFrame(rows, names)


def values(df, column):
    return [row[column] for row in df.select(column).collect()]
