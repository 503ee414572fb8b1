"""Histories of micro-batches: what is replayed replaces, it does not add."""

from riskframe import DataDriftMonitor, DataQualityValidator
from riskframe.sources import read_history, write_batch
from riskframe.streaming import contract_per_batch, drift_per_batch


def _run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_replayed_batches_replace(spark, tmp_path):
    rows = spark.range(200).selectExpr("id", "cast(id % 17 as double) AS bmi", "cast(id % 2 as int) AS label")
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    validator = DataQualityValidator(required_columns=["bmi"], target_column="label", id_columns=["id"])
    for turn in range(2):  # the second run has lost its checkpoint and starts with batch 0 again
        _run(contract_per_batch(stream, validator, f"{out}/contract", f"{tmp_path}/c{turn}"))
        _run(drift_per_batch(stream.select("bmi"), rows.select("bmi"), DataDriftMonitor(), f"{out}/drift", f"{tmp_path}/d{turn}"))
        got = {n: sorted(map(str, read_history(spark, f"{out}/{n}").collect())) for n in ("contract", "drift")}
        assert got["contract"] and len(got["drift"]) == 1
        assert turn == 0 or got == before
        before = got
    assert {r["batch_id"] for r in read_history(spark, f"{out}/drift").collect()} == {0}


def test_batches_may_bring_columns(spark, tmp_path):
    write_batch(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "h"), 0)
    write_batch(spark.createDataFrame([(2, "x")], "a int, b string"), str(tmp_path / "h"), 1)
    write_batch(spark.createDataFrame([(3, "y")], "a int, b string"), str(tmp_path / "h"), 1)
    got = sorted((r["batch_id"], r["a"], r["b"]) for r in read_history(spark, str(tmp_path / "h")).collect())
    assert got == [(0, 1, None), (1, 3, "y")]
