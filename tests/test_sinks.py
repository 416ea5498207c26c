"""Writers on small tables."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.fingerprint import fingerprint
from cohortlens.functions.staging import new_path, small_side, stage_root
from cohortlens.plans.pipeline import CohortRun
from cohortlens.sources import sinks

T1, T2 = "timestamp_ntz'2026-01-01 00:00:00'", "timestamp_ntz'2026-01-02 00:00:00'"


def segments(spark, *pairs):
    return spark.createDataFrame(list(pairs), "customer_id bigint, segment string")


def test_upsert_twice(spark):
    path = new_path(spark, "upsert")
    sinks.upsert_parquet(path, sinks.segment_rows(
        segments(spark, (1, "High Risk"), (2, "High Risk")), T1))
    state = sinks.upsert_parquet(path, sinks.segment_rows(
        segments(spark, (2, "Low Risk - Low Value"), (3, "High Risk")), T2))
    rows = {r["customer_id"]: r for r in state.collect()}
    assert {k: r["segment_assigned"] for k, r in rows.items()} == {
        "1": "High Risk", "2": "Low Risk - Low Value", "3": "High Risk"}
    assert rows["2"]["recommendation"] == "Grow value"
    assert rows["1"]["updated_at"] < rows["2"]["updated_at"]
    counts = [(r["segment_assigned"], r["customer_count"])
              for r in sinks.segment_counts(state).collect()]
    assert counts == [("High Risk", 2), ("Low Risk - Low Value", 1)]


def test_duplicate_source_keys_leave_one_row(spark):
    changes = sinks.segment_rows(segments(spark, (1, "High Risk"), (1, "High Risk")), T1)
    assert sinks.upsert_parquet(new_path(spark, "upsert"), changes).count() == 1


def test_unfinished_version_is_ignored(spark):
    path = new_path(spark, "upsert")
    rows = sinks.segment_rows(segments(spark, (1, "High Risk")), T1)
    sinks.upsert_parquet(path, rows)
    # A version without _SUCCESS is what a killed job leaves behind.
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{path}/version=000007")
    spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert sinks._versions(spark, path) == ["000001"]
    sinks.upsert_parquet(path, rows)
    assert sinks._versions(spark, path) == ["000001", "000008"]


def test_versions_are_ordered_as_numbers(spark):
    path = new_path(spark, "versions")
    for version in ("999999", "1000000"):
        spark.range(1).write.parquet(f"{path}/version={version}")
    assert sinks.current_version(spark, path).endswith("version=1000000")
    sinks.publish(spark.range(2), path)
    assert sinks.current_version(spark, path).endswith("version=1000001")


def test_replace_leaves_only_the_new_row(spark):
    path = new_path(spark, "replace")
    sinks.replace_table(spark.range(3), path)
    assert [r["id"] for r in sinks.replace_table(spark.range(7, 8), path).collect()] == [7]


def test_latest_run(spark):
    path = new_path(spark, "runs")
    sinks.append_run(spark.range(3), path, "20260101_000000")
    sinks.append_run(spark.range(5), path, "20260103_000000")
    sinks.append_run(spark.range(0), path, "20260102_000000")
    latest = sinks.latest_run(sinks.read_table(spark, path))
    assert latest.count() == 5
    assert {r["run_id"] for r in latest.collect()} == {"20260103_000000"}


def test_run_without_rows_keeps_its_schema(spark):
    path = new_path(spark, "runs")
    sinks.append_run(spark.range(0), path, "20260101_000000")
    assert sinks.read_table(spark, path).columns == ["id", "run_id"]


def test_csv_keeps_blanks_and_nulls(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, ' a,"b" '), (4, "x\\")], "i int, s string")
    assert sorted(sinks.round_trip(df, "csv", "csv").collect()) == sorted(df.collect())


def test_failed_replace_leaves_the_old_rows(spark):
    path = new_path(spark, "replace")
    sinks.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(1).selectExpr("raise_error('stop') AS id"), path)
    assert spark.read.parquet(sinks.current_version(spark, path)).count() == 3


def test_csv_run_holds_nested_columns_as_json(spark):
    path = new_path(spark, "runs")
    df = spark.range(1).selectExpr("id", "array('a', 'b') AS names", "map('k', 2) AS sizes")
    sinks.append_run(df, path, "20260101_000000", "csv")
    row = sinks.read_table(spark, path, fmt="csv").first()
    assert (row["id"], row["names"], row["sizes"]) == ("0", '["a","b"]', '{"k":2}')


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), f"/tmp/{uuid.uuid4().hex}", "xml")


def test_stage_root_is_the_checkpoint_folder(spark):
    assert stage_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_small_side_hints_only_measured_bytes(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    wide = spark.range(3).selectExpr("id", "repeat('x', 1000) AS label")
    assert hinted(small_side(wide, 4000))
    assert not hinted(small_side(wide, 3000))
    assert hinted(small_side(wide.limit(0), 0))


def files_of(df):
    return set(df.inputFiles())


def test_upsert_rewrites_only_the_buckets_of_changed_keys(spark):
    path = new_path(spark, "upsert")
    names = ["High Risk", "Low Risk - Low Value"]
    before = sinks.upsert_parquet(path, sinks.segment_rows(
        segments(spark, *[(i, names[i % 2]) for i in range(400)]), T1), buckets=16)
    old = files_of(before)
    assert len(old) >= 16
    after = sinks.upsert_parquet(path, sinks.segment_rows(segments(spark, (7, "Low Risk - High Value")), T2))
    new = files_of(after)
    assert len(new - old) == 1 and len(old - new) == 1        # one bucket of one file
    rows = {r["customer_id"]: r["segment_assigned"] for r in after.collect()}
    assert rows == {str(i): names[i % 2] for i in range(400)} | {"7": "Low Risk - High Value"}
    assert sinks.read_upserted(spark, path, after.schema).count() == 400
    # The state before stays readable until its files are dropped.
    assert {r["customer_id"] for r in before.where("segment_assigned = 'Low Risk - High Value'").collect()} == set()


def test_failed_upsert_leaves_the_old_rows(spark):
    path = new_path(spark, "upsert")
    rows = sinks.segment_rows(segments(spark, (1, "High Risk")), T1)
    sinks.upsert_parquet(path, rows)
    with pytest.raises(Exception):
        sinks.upsert_parquet(path, rows.withColumn("recommendation", F.expr("raise_error('stop')")))
    assert [r["customer_id"] for r in sinks.read_upserted(spark, path, rows.schema).collect()] == ["1"]
    assert sinks.upsert_parquet(path, rows.limit(0)).count() == 1


def test_newest_change_of_a_key_wins_whatever_the_layout(spark):
    rows = [("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", "u", 5), ("b", "v", 5), ("b", "v", 5), (None, "n", 1), (None, "m", None)]
    df = spark.createDataFrame(rows, "customer_id string, segment_assigned string, day int").selectExpr(
        "customer_id", "segment_assigned", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(day) AS updated_at")
    picked = sinks.last_per_key(df.repartition(4))
    got = {r["customer_id"]: r["segment_assigned"] for r in picked.collect()}
    assert len(got) == picked.count() == 3
    assert got["a"] == "y" and got["b"] in ("u", "v") and got[None] == "n"
    again = {r["customer_id"]: r["segment_assigned"] for r in sinks.last_per_key(df.coalesce(1)).collect()}
    assert again == got
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_figures_come_from_the_write(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 1), (2, None, "a", 0), (3, 0.0, None, 0)],
                               "customer_id bigint, income double, state string, has_14plus_dpd int")
    raw, figures = sinks.observed(df)
    written = sinks.round_trip(raw, "raw")
    row = sinks.metadata(written, figures.get, "here", T1, "q").first()
    assert (row["record_count"], row["missing_values"], row["min_customer_id"], row["max_customer_id"]) == (3, 2, 1, 3)
    assert (row["default_count"], row["non_default_count"]) == (1, 2)
    assert row["column_types"] == "customer_id:bigint, income:double, state:string, has_14plus_dpd:int"
    summary = {s["column_name"]: s for s in row["summary"]}
    assert (summary["income"]["median"], summary["income"]["zeros"], summary["income"]["missing"]) == (1.0, 1, 1)
    assert (summary["state"]["top_value"], summary["state"]["top_count"], summary["state"]["min"]) == ("a", 2, None)


def test_summary_of_an_empty_extract(spark):
    raw, figures = sinks.observed(spark.createDataFrame([], "customer_id bigint, state string"))
    row = sinks.metadata(sinks.round_trip(raw, "raw"), figures.get, "here", T1, "q").first()
    assert row["record_count"] == 0 and [s["missing"] for s in row["summary"]] == [0, 0]


def test_fingerprint_sees_values_not_order(spark):
    df = spark.createDataFrame([(1, 0.1, "a"), (2, None, None), (2, None, None)], "i int, x double, s string")
    same = fingerprint(df).first()
    assert fingerprint(df.orderBy("i", ascending=False).select("s", "x", "i").repartition(3)).first() == same
    for other in (df.withColumn("x", F.lit(0.1)), df.limit(2), df.withColumn("s", F.coalesce("s", F.lit("-")))):
        assert fingerprint(other).first()["fingerprint"] != same["fingerprint"]
    assert tuple(fingerprint(df.limit(0)).first()) == (0, "0")


def test_infinite_features_become_the_median_in_the_full_run(spark):
    rows = [(i, 1, 0.0, 0, 0, 0, 0, 2.0, 50.0, 30, "Male", float(100 * i) if i < 5 else math.inf, 10.0) for i in range(1, 6)]
    columns = ("customer_id bigint, loan_count bigint, total_amount_overdue double, maturity_dpd bigint, "
               "total_missed_installment bigint, has_14plus_dpd int, count_14plus_dpd bigint, tenor_in_months double, "
               "ontime_repayment_rate double, age int, gender string, total_loan_amount double, income double")
    run = CohortRun(None)
    run.__dict__["processed"] = spark.createDataFrame(rows, columns)
    volumes = {r["customer_id"]: r["monthly_loan_volume"] for r in run.featured.collect()}
    assert volumes[5] == pytest.approx(125.0, rel=1e-4)       # between 200 / 2 and 300 / 2
    assert volumes[4] == pytest.approx(200.0, rel=1e-4)
