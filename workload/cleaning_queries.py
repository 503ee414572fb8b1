"""Sources S, projections P, set operations U, schema and quality contract V, joins J."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import DataQualityValidator, preprocess_dataset
from riskframe.operators import cleaning
from riskframe.operators.contract import non_finite_values
from riskframe.operators.duplicates import drop_duplicate_rows, duplicate_id_counts, duplicate_row_count
from riskframe.operators.profile import missing_values
from riskframe.operators.schema import range_checks
from riskframe.plans.scoring import join_truth, select_scoring_columns
from riskframe.session import local_frame, scratch_path
from riskframe.sources import (
    append_history,
    load_dataset,
    read_history,
    read_table,
    sampled_read,
    scoring_table,
    upsert,
    write_merge,
    write_table,
)
from workload.catalog import comparable, r, register
from workload.fixtures import patients, table, with_patients

SOURCE_COLUMNS = ["patient_id", "age", "gender", "glucose_fasting", "bmi", "diagnosed_diabetes"]
SOURCE_SQL = with_patients(
    f"SELECT patient_id, age, gender, {r('glucose_fasting')} AS glucose_fasting, {r('bmi')} AS bmi, diagnosed_diabetes FROM patients"
)


def _source(spark, sf_dir):
    return patients(spark, sf_dir).select(*SOURCE_COLUMNS)


def _round_trip(key: str, suffix: str, save, **options) -> None:
    @register(key, SOURCE_SQL)
    def query(spark, sf_dir):
        path = f"{scratch_path(spark, key)}.{suffix}"
        save(_source(spark, sf_dir).write, path)
        return comparable(load_dataset(path, spark=spark, **options).select(*SOURCE_COLUMNS))


_round_trip("s2_csv_scan", "csv", lambda w, p: w.option("header", True).csv(p))
_round_trip("s3_parquet_scan", "parquet", lambda w, p: w.parquet(p))
_round_trip("s5_jsonl_scan", "jsonl", lambda w, p: w.json(p))


@register("s1_dispatch_by_format", SOURCE_SQL)
def s1(spark, sf_dir):
    """An explicit format wins over the suffix; a schema avoids the inference pass."""
    path = scratch_path(spark, "s1")
    rows = _source(spark, sf_dir)
    rows.write.option("header", True).csv(path)
    return comparable(load_dataset(path, spark=spark, file_format="csv", schema=rows.schema))


@register(
    "s4_json_documents",
    f"SELECT c_custkey, {r('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer",
)
def s4(spark, sf_dir):
    """Whole-document JSON: one array of up to 500 customers per file."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    documents = customers.groupBy((F.col("c_custkey") / 500).cast("long").alias("doc")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value")
    )
    path = f"{scratch_path(spark, 's4')}.json"
    documents.write.partitionBy("doc").option("maxRecordsPerFile", 1).text(path)
    loaded = load_dataset(path, spark=spark, schema=customers.schema, recursiveFileLookup="true")
    return comparable(loaded)


@register("s6_catalog_table", SOURCE_SQL)
def s6(spark, sf_dir):
    path = scratch_path(spark, "s6")
    name = "patients_" + path.rsplit("-", 1)[1]
    _source(spark, sf_dir).write.option("path", path).saveAsTable(name)
    return comparable(load_dataset(name, spark=spark))


@register("s7_dataframe_passthrough", SOURCE_SQL)
def s7(spark, sf_dir):
    return comparable(load_dataset(_source(spark, sf_dir)))


@register(
    "s9_write_modes",
    with_patients("SELECT gender, 2 * count(*) AS patients FROM patients GROUP BY 1"),
)
def s9(spark, sf_dir):
    path = scratch_path(spark, "s9")
    rows = _source(spark, sf_dir)
    write_table(rows.select("patient_id"), path, mode="overwrite")
    write_table(rows, path, mode="overwrite")
    write_table(rows, path, mode="append")
    return read_table(spark, path).groupBy("gender").agg(F.count("*").alias("patients"))


@register(
    "s10_append_new_columns",
    with_patients(
        "SELECT patient_id, CAST(NULL AS BIGINT) AS age FROM patients UNION ALL SELECT patient_id, age FROM patients"
    ),
)
def s10(spark, sf_dir):
    path = scratch_path(spark, "s10")
    rows = _source(spark, sf_dir)
    append_history(rows.select("patient_id"), path)
    append_history(rows.select("patient_id", "age"), path)
    return read_history(spark, path).select("patient_id", "age")


UPSERT_SQL = (
    "SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders WHERE NOT (o_orderstatus = 'F') "
    "UNION ALL SELECT o_orderkey, o_orderpriority, 'closed' AS note FROM orders WHERE o_orderstatus = 'F'"
)


def _upsert_sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.select("o_orderkey", "o_orderpriority")
    new = orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderpriority", F.lit("closed").alias("note")
    )
    return old, new


@register("j5_upsert", UPSERT_SQL)
def j5(spark, sf_dir):
    old, new = _upsert_sides(spark, sf_dir)
    return upsert(old, new, ["o_orderkey"])


@register("s11_merge_write", UPSERT_SQL)
def s11(spark, sf_dir):
    old, new = _upsert_sides(spark, sf_dir)
    base = scratch_path(spark, "s11")
    write_table(old, f"{base}/old")
    write_merge(spark, new, f"{base}/old", f"{base}/merged", ["o_orderkey"])
    return read_table(spark, f"{base}/merged")


@register("s12_unlabelled_table", with_patients(f"SELECT patient_id, age, gender, {r('glucose_fasting')} AS glucose_fasting, {r('bmi')} AS bmi FROM patients"))
def s12(spark, sf_dir):
    return comparable(scoring_table(_source(spark, sf_dir), "diagnosed_diabetes"))


@register("s13_sampled_read")
def s13(spark, sf_dir):
    return sampled_read(table(spark, sf_dir, "lineitem"), fraction=0.01, seed=42)


# ---- projections ---------------------------------------------------------------------------

@register("p1_normalize_names", "SELECT c_custkey, c_mktsegment FROM customer")
def p1(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias(" c_custkey "), F.col("c_mktsegment").alias("c_mktsegment ")
    )
    return cleaning.normalize_column_names(padded)


@register(
    "p2_infinities_to_missing",
    f"SELECT event_id, {r('CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE value END')} AS value FROM events",
)
def p2(spark, sf_dir):
    key = F.col("event_id")
    dirty = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 7 == 0, F.lit(float("inf"))).when(key % 11 == 0, F.lit(float("-inf")))
        .when(key % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    return comparable(cleaning.infinities_to_missing(dirty))


@register(
    "p3_clean_categories",
    with_patients(
        "SELECT patient_id, CASE gender WHEN 'Other' THEN 'Unknown' ELSE gender END AS gender, "
        "CASE employment_status WHEN 'Retired' THEN 'Inactive' WHEN 'Unemployed' THEN 'Inactive' ELSE employment_status END AS employment_status, "
        "CASE smoking_status WHEN 'Former' THEN 'Ex-Smoker' ELSE smoking_status END AS smoking_status FROM patients"
    ),
)
def p3(spark, sf_dir):
    columns = ["patient_id", "gender", "employment_status", "smoking_status"]
    return cleaning.clean_categorical_variables(patients(spark, sf_dir)).select(*columns)


@register("p4_drop_leakage", with_patients("SELECT patient_id, age FROM patients"))
def p4(spark, sf_dir):
    columns = ["patient_id", "age", "diabetes_stage", "diabetes_risk_score", "diagnosed_diabetes"]
    return cleaning.drop_leakage_columns(patients(spark, sf_dir).select(*columns))


@register(
    "p5_preprocess",
    with_patients(
        f"SELECT DISTINCT age, CASE gender WHEN 'Other' THEN 'Unknown' ELSE gender END AS gender, {r('bmi')} AS bmi, "
        "CASE smoking_status WHEN 'Former' THEN 'Ex-Smoker' ELSE smoking_status END AS smoking_status FROM patients"
    ),
)
def p5(spark, sf_dir):
    rows = patients(spark, sf_dir).select(F.col("age").alias(" age"), "gender", "bmi", "smoking_status")
    return comparable(preprocess_dataset(rows))


@register(
    "u1_distinct_by_hash",
    "SELECT DISTINCT l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, l_linestatus FROM lineitem",
)
def u1_hash(spark, sf_dir):
    """Distinct rows when only rows with a repeated hash are moved."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_returnflag", "l_linestatus"
    )
    return drop_duplicate_rows(lines)


@register("p7_integers_to_double", with_patients("SELECT CAST(patient_id AS DOUBLE) AS patient_id, CAST(age AS DOUBLE) AS age, gender FROM patients"))
def p7(spark, sf_dir):
    return cleaning.integers_to_double(patients(spark, sf_dir).select("patient_id", "age", "gender"))


@register("p8_feature_types")
def p8(spark, sf_dir):
    """Column kinds of the patient table, attached to their non-missing counts."""
    df = patients(spark, sf_dir)
    numeric, _ = cleaning.auto_detect_column_types(df, ["encounter_ts"], "diagnosed_diabetes", ["patient_id"])
    kind = F.when(F.col("column_name").isin(numeric), "numeric").otherwise("categorical")
    return missing_values(df.drop("encounter_ts", "diagnosed_diabetes", "patient_id")).withColumn("kind", kind)


@register("p10_scoring_projection", with_patients(f"SELECT patient_id, {r('bmi')} AS bmi, age FROM patients"))
def p10(spark, sf_dir):
    return comparable(select_scoring_columns(patients(spark, sf_dir), ["bmi", "age"], ["patient_id", "absent_id"]))


@register("p11_drop_incomplete", with_patients("SELECT patient_id FROM patients WHERE glucose_fasting IS NOT NULL AND bmi IS NOT NULL"))
def p11(spark, sf_dir):
    return cleaning.drop_incomplete_rows(patients(spark, sf_dir), ["glucose_fasting", "bmi"]).select("patient_id")


@register("u1_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem")
def u1(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("long").alias("l_linenumber"))
    return lines.dropDuplicates()


@register(
    "j6_predictions_with_truth",
    "SELECT d.doc_id, CAST(CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS BIGINT) AS predicted, CAST(l.quality AS BIGINT) AS quality "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def j6(spark, sf_dir):
    predictions = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") >= 500).cast("long").alias("predicted"))
    truth = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return join_truth(predictions, truth, ["doc_id"])


# ---- schema and contract -------------------------------------------------------------------

RANGES = {"age": (0, 120), "bmi": (10, 80), "glucose_fasting": (40, 600), "hba1c": (2, 25), "systolic_bp": (50, 300), "diastolic_bp": (30, 200)}


@register(
    "v4_plausible_ranges",
    with_patients(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS minimum, CAST({hi} AS DOUBLE) AS maximum, "
            f"CAST(0 AS BIGINT) AS infinite_values, CAST(count(*) FILTER (WHERE {c} NOT BETWEEN {lo} AND {hi}) AS BIGINT) AS out_of_range FROM patients"
            for c, (lo, hi) in RANGES.items()
        )
    ),
)
def v4(spark, sf_dir):
    return comparable(range_checks(patients(spark, sf_dir)))


@register(
    "v3_infinite_values",
    with_patients(
        "SELECT 'bmi' AS column_name, CAST(count(*) FILTER (WHERE patient_id % 17 = 0) AS BIGINT) AS infinite_values, "
        "CAST(count(*) FILTER (WHERE patient_id % 17 = 0) AS BIGINT) AS out_of_range FROM patients"
    ),
)
def v3(spark, sf_dir):
    dirty = patients(spark, sf_dir).select(
        F.when(F.col("patient_id") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("bmi")).alias("bmi")
    )
    return range_checks(dirty).select("column_name", "infinite_values", "out_of_range")


@register(
    "v7_duplicate_rows",
    with_patients("SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT age, gender, bmi FROM patients)) AS BIGINT) AS duplicate_rows FROM patients"),
)
def v7(spark, sf_dir):
    count = duplicate_row_count(patients(spark, sf_dir).select("age", "gender", "bmi"))
    return local_frame(spark, [(count,)], "duplicate_rows long")


@register(
    "v8_missing_ratio",
    with_patients(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 1.0 / count(*)')} AS ratio FROM patients"
            for c in ("glucose_fasting", "bmi", "gender", "diastolic_bp")
        )
    ),
)
def v8(spark, sf_dir):
    counted = missing_values(patients(spark, sf_dir).select("glucose_fasting", "bmi", "gender", "diastolic_bp"))
    return comparable(counted.select("column_name", (F.col("missing") / F.col("rows")).alias("ratio")))


@register(
    "v9_non_finite",
    "SELECT 'l_tax' AS column_name, CAST(count(*) FILTER (WHERE l_orderkey % 19 = 0) AS BIGINT) AS non_finite FROM lineitem "
    "UNION ALL SELECT 'l_quantity', CAST(0 AS BIGINT)",
)
def v9(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    tax = F.when(F.col("l_orderkey") % 19 == 0, F.lit(float("-inf"))).otherwise(F.col("l_tax"))
    return non_finite_values(lines.select(tax.alias("l_tax"), "l_quantity", "l_returnflag"))


@register(
    "v10_identifiers",
    "SELECT 'l_orderkey' AS column_name, CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT) AS duplicate_ids FROM lineitem "
    "UNION ALL SELECT 'l_partkey', CAST(count(*) - count(DISTINCT l_partkey) AS BIGINT) FROM lineitem",
)
def v10(spark, sf_dir):
    found = duplicate_id_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])
    return local_frame(spark, list(found.items()), "column_name string, duplicate_ids long")


def _check(name: str, column: str, value: str, limit: str, passed: str) -> str:
    column_sql = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{name}' AS \"check\", {column_sql} AS column_name, {r(value)} AS value, CAST({limit} AS DOUBLE) AS limit_value, "
        f"{passed} AS passed FROM p"
    )


_CONTRACT_COLUMNS = ["patient_id", "age", "glucose_fasting", "bmi", "diagnosed_diabetes"]
_NULLS = "count(*) FILTER (WHERE {c} IS NULL)"
CONTRACT_SQL = (
    with_patients("")
    + f", p AS (SELECT {', '.join(_CONTRACT_COLUMNS)} FROM patients) "
    + " UNION ALL ".join(
        [_check("required_column", c, "1", "1", "count(*) > 0") for c in ("bmi", "glucose_fasting")]
        + [_check("required_column", "insulin", "0", "1", "count(*) < 0")]
        + [_check("rows", "", "count(*)", "1", "count(*) > 0")]
        + [_check("duplicate_rows", "", "0", "0", "count(*) > 0")]
        + [
            _check("missing_ratio", c, f"{_NULLS.format(c=c)} * 1.0 / count(*)", "0.005", f"{_NULLS.format(c=c)} * 1.0 / count(*) <= 0.005")
            for c in _CONTRACT_COLUMNS
        ]
        + [_check("non_finite", "", "0", "0", "count(*) > 0"), _check("duplicate_columns", "", "0", "0", "count(*) > 0")]
        + [_check("null_ids", "patient_id", "count(*) - count(patient_id)", "0", "count(*) = count(patient_id)")]
        + [_check("duplicate_ids", "patient_id", "count(*) - count(DISTINCT patient_id)", "0", "count(*) = count(DISTINCT patient_id)")]
        + [
            _check("target_classes", "diagnosed_diabetes", "count(*) FILTER (WHERE diagnosed_diabetes NOT IN (0, 1))", "0",
                   "count(DISTINCT diagnosed_diabetes) = 2 AND count(*) FILTER (WHERE diagnosed_diabetes NOT IN (0, 1)) = 0")
        ]
    )
)


@register("v12_contract_report", CONTRACT_SQL)
def v12(spark, sf_dir):
    """All checks of the contract in long form (V5-V11)."""
    validator = DataQualityValidator(
        required_columns=["glucose_fasting", "bmi", "insulin"],
        target_column="diagnosed_diabetes",
        id_columns=["patient_id"],
        max_missing_ratio=0.005,
    )
    return comparable(validator.validate(patients(spark, sf_dir).select(*_CONTRACT_COLUMNS)).to_dataframe(spark))


@register("v12_lineitem_contract")
def v12_lineitem(spark, sf_dir):
    validator = DataQualityValidator(required_columns=["l_orderkey", "l_quantity"], id_columns=["l_orderkey"])
    return validator.validate(table(spark, sf_dir, "lineitem")).to_dataframe(spark)
