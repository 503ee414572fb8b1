import pytest

from riskframe import (
    DataQualityValidator,
    DataSchemaValidator,
    analyze_dataset,
    auto_detect_column_types,
    clean_categorical_variables,
    drop_leakage_columns,
    load_dataset,
    preprocess_dataset,
    to_spark,
)
from riskframe.errors import MissingRequiredColumnError, SchemaValidationError
from riskframe.operators import duplicates
from riskframe.sources import append_history, read_history, upsert, write_merge, write_table


def test_profile(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (1, 3.0)], "target long, value double")
    analysis = analyze_dataset(df, target_column="target")
    assert (analysis.rows, analysis.columns, analysis.duplicate_rows) == (3, 2, 0)
    assert analysis.missing_values == {"target": 0, "value": 1}
    assert analysis.target_distribution == {0: 1, 1: 2}
    row = analysis.numeric_summary.filter("column_name = 'value'").first()
    assert (row["count"], row["mean"], row["p50"], row["std"]) == (2, 2.0, 2.0, pytest.approx(2**0.5))
    with pytest.raises(ValueError):
        analyze_dataset(df, target_column="absent")
    with pytest.raises(TypeError):
        analyze_dataset([1])


def test_preprocess(spark):
    df = spark.createDataFrame(
        [(1.0, "Former"), (float("inf"), "Never"), (1.0, "Former")], "value double, smoking_status string"
    ).toDF(" value ", "smoking_status")
    rows = {(r.value, r.smoking_status) for r in preprocess_dataset(df).collect()}
    assert rows == {(1.0, "Ex-Smoker"), (None, "Never")}
    assert preprocess_dataset(df, drop_duplicates=False).count() == 3
    with pytest.raises(ValueError):
        preprocess_dataset(spark.createDataFrame([(1, 2)], "a long, b long").toDF("a", "a "))


def test_recodes_and_leakage(spark):
    df = spark.createDataFrame(
        [("Other", "Retired", "Former", "x", 1), ("Male", "Unemployed", "Never", "y", 0)],
        "gender string, employment_status string, smoking_status string, diabetes_stage string, diagnosed_diabetes long",
    )
    cleaned = drop_leakage_columns(clean_categorical_variables(df))
    assert [tuple(r) for r in cleaned.collect()] == [("Unknown", "Inactive", "Ex-Smoker"), ("Male", "Inactive", "Never")]


def test_column_kinds(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True, 0)], "id long, x double, c string, b boolean, y long")
    assert auto_detect_column_types(df, target="y", id_columns=["id"]) == (["x"], ["c", "b"])


def test_schema_validation(spark, minimal_df):
    DataSchemaValidator().validate(minimal_df)
    with pytest.raises(MissingRequiredColumnError) as error:
        DataSchemaValidator().validate(spark.createDataFrame([(1,)], "bmi long"))
    assert error.value.columns == ["Age/age", "glucose_fasting"]
    with pytest.raises(SchemaValidationError, match="duplicate"):
        DataSchemaValidator().validate(minimal_df.toDF("bmi", "bmi", "age"))
    text = spark.createDataFrame([("x", 100.0, 30)], "bmi string, glucose_fasting double, age long")
    with pytest.raises(SchemaValidationError, match="numeric"):
        DataSchemaValidator().validate(text)
    infinite = spark.createDataFrame([(float("inf"), 100.0, 30)], "bmi double, glucose_fasting double, age long")
    with pytest.raises(SchemaValidationError, match="infinite"):
        DataSchemaValidator().validate(infinite)
    implausible = spark.createDataFrame([(25.0, 10.0, 30)], "bmi double, glucose_fasting double, age long")
    DataSchemaValidator().validate(implausible)
    with pytest.raises(SchemaValidationError, match="outside"):
        DataSchemaValidator(strict_ranges=True).validate(implausible)


def test_contract_pass_and_fail(spark):
    good = spark.createDataFrame([(1, 40.0, 0), (2, 60.0, 1)], "patient_id long, age double, target long")
    options = dict(required_columns=["age"], target_column="target", id_columns=["patient_id"])
    assert DataQualityValidator(**options).validate(good).passed
    bad = spark.createDataFrame([(1, float("inf"), 1)] * 2, "patient_id long, age double, target long")
    report = DataQualityValidator(**{**options, "required_columns": ["age", "missing"]}).validate(bad)
    text = "; ".join(report.violations)
    for part in ("required_column of missing is 0, allowed is 1", "duplicate_rows is 1", "non_finite is 2",
                 "duplicate_ids of patient_id is 1", "target_classes of target"):
        assert part in text
    with pytest.raises(ValueError):
        report.raise_for_failure()
    assert report.to_dataframe(spark).filter("NOT passed").count() == 5


def test_contract_limits(spark):
    df = spark.createDataFrame([(i, None if i < 5 else 1.0) for i in range(100)], "id long, x double")
    assert DataQualityValidator(required_columns=[], max_missing_ratio=0.05).validate(df).passed
    assert not DataQualityValidator(required_columns=[], max_missing_ratio=0.049).validate(df).passed
    empty = df.filter("id < 0")
    assert DataQualityValidator(required_columns=[]).validate(empty).violations == ("rows is 0, allowed is 1",)
    nulls = spark.createDataFrame([(None, 1), (None, 1), (3, 1)], "id long, x long")
    report = DataQualityValidator(required_columns=[], id_columns=["id"], max_missing_ratio=1.0, allow_duplicate_rows=True).validate(nulls)
    assert report.violations == ("null_ids of id is 2, allowed is 0", "duplicate_ids of id is 1, allowed is 0")
    with pytest.raises(ValueError):
        DataQualityValidator(required_columns=[], max_missing_ratio=2)


def test_contract_reports_repeated_names(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long").toDF("a", "a")
    assert "duplicate_columns is 1, allowed is 0" in DataQualityValidator(required_columns=["a"]).validate(df).violations


def test_duplicate_counts_agree(spark, monkeypatch):
    rows = [(i % 7, str(i % 3), None if i % 2 else 1.5, i % 5, 0.0 if i % 2 else -0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string, c double, d long, e double")
    expected = 300 - df.distinct().count()
    kept = duplicates.drop_duplicate_rows(df.unionByName(df.limit(1).selectExpr("a + 100 AS a", "b", "c", "d", "e")))
    assert kept.count() == 301 - expected and kept.distinct().count() == 301 - expected
    assert duplicates.duplicate_row_count(df) == duplicates.duplicate_row_count(df, direct=True) == expected
    monkeypatch.setattr(duplicates, "MAX_BROADCAST_HASHES", 1)
    assert duplicates.duplicate_row_count(df) == expected
    assert duplicates.drop_duplicate_rows(df).count() == 300 - expected
    assert duplicates.duplicate_row_count(df.distinct()) == 0


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    df.write.parquet(str(tmp_path / "t.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "t.csv"))
    df.write.json(str(tmp_path / "t.jsonl"))
    (tmp_path / "t.json").write_text('[{"id": 1, "name": "a"},\n {"id": 2, "name": null}]')
    for suffix in ("parquet", "csv", "jsonl", "json"):
        loaded = load_dataset(str(tmp_path / f"t.{suffix}"), spark=spark).select("id", "name")
        assert {(int(r.id), r.name) for r in loaded.collect()} == {(1, "a"), (2, None)}
    assert load_dataset(df) is df
    df.createOrReplaceTempView("source_table")
    assert load_dataset("source_table", spark=spark).count() == 2
    with pytest.raises(ValueError):
        load_dataset("/data/file.xlsx", spark=spark)
    assert to_spark([(1, "x")], "id long, name string").count() == 1


def test_history_and_upsert(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(spark.createDataFrame([(1,)], "a long"), path)
    append_history(spark.createDataFrame([(2, "x")], "a long, b string"), path)
    assert {tuple(r) for r in read_history(spark, path).select("a", "b").collect()} == {(1, None), (2, "x")}
    old = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "id long, v string")
    new = spark.createDataFrame([(2, "new"), (2, "again"), (None, "new")], "id long, v string")
    expected = {(1, "old"), (2, "new"), (2, "again"), (None, "new")}
    assert {tuple(r) for r in upsert(old, new, ["id"]).collect()} == expected
    write_table(old, str(tmp_path / "old"))
    write_merge(spark, new, str(tmp_path / "old"), str(tmp_path / "out"), ["id"])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == expected
