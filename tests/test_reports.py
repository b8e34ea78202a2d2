import datetime as dt

from pyspark.sql import functions as F

from sensorflow.operators import monitoring as MO
from sensorflow.operators import reports as R

T0 = dt.datetime(2024, 1, 1, 12)
MEAS = "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string, created_at timestamp_ntz"
SENS = ("sensor_id string, location string, sensor_type string, unit string, min_value double, max_value double, "
        "created_at timestamp_ntz")


def _s(spark, ids):
    return spark.createDataFrame([(i, f"L{i}", "t", "C", 0.0, 50.0, None) for i in ids], SENS)


def test_completeness_grades_on_unrounded_ratio(spark):
    # expected 20: 19 -> 95 % Good, 16 -> 80 % Warning, 15 -> Poor, silent -> 0 Poor
    rows, i = [], 0
    for sid, n in (("a", 19), ("b", 16), ("c", 15)):
        for k in range(n):
            rows.append((i, sid, T0 - dt.timedelta(minutes=k), 1.0, "valid", T0))
            i += 1
    m = spark.createDataFrame(rows, MEAS)
    got = {r.sensor_id: (r.actual_readings, r.completeness_pct, r.status)
           for r in R.completeness(_s(spark, ["a", "b", "c", "d"]), m, T0, "1 hour", expected=20).collect()}
    assert got == {"a": (19, 95.0, "Good"), "b": (16, 80.0, "Warning"), "c": (15, 75.0, "Poor"), "d": (0, 0.0, "Poor")}


def test_readings_per_sensor_keeps_silent(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0)], MEAS)
    got = {r.sensor_id: r.total_measurements for r in R.readings_per_sensor(_s(spark, ["a", "b"]), m).collect()}
    assert got == {"a": 1, "b": 0}


def test_quality_overview_sums_to_100(spark):
    flags = ["valid"] * 5 + ["out_of_range"] * 2 + ["unknown_sensor"]
    m = spark.createDataFrame([(i, "a", T0, 1.0, f, T0) for i, f in enumerate(flags)], MEAS)
    got = {r.quality_flag: r.percentage for r in R.quality_overview(m).collect()}
    assert got == {"valid": 62.5, "out_of_range": 25.0, "unknown_sensor": 12.5}


def test_current_vs_history_drops_sensors_without_recent_data(spark):
    m = spark.createDataFrame([(1, "a", T0, 10.0, "valid", T0), (2, "a", T0 - dt.timedelta(hours=5), 20.0, "valid", T0),
                               (3, "b", T0 - dt.timedelta(hours=5), 5.0, "valid", T0)], MEAS)
    out = R.current_vs_history(m, _s(spark, ["a", "b"]), T0, "10 minutes", "24 hours").collect()
    assert [(r.sensor_id, r.current_temp, r.day_avg, r.difference) for r in out] == [("a", 10.0, 15.0, -5.0)]


def test_health_report_statuses(spark):
    m = spark.createDataFrame([(i, f"s{i % 3}", T0 - dt.timedelta(seconds=i), 1.0, "valid", T0) for i in range(50)], MEAS)
    got = {r.check_name: r.status for r in MO.health_report(_s(spark, list("abcdef")), m, T0).collect()}
    assert got == {"sensors": "PASS", "measurements": "PASS", "freshness_seconds": "PASS", "active_sensors": "WARNING"}


def test_summary_stats(spark):
    m = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 9, 8, 7), 1.0, "valid", T0)], MEAS)
    got = {r.metric: r.value for r in MO.summary_stats(_s(spark, ["a", "b"]), m).collect()}
    assert got == {"Sensors": "2", "Measurements": "1", "Latest Reading": "09:08:07"}


def test_catalog_one_pass(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0), (2, None, T0, 3.0, "valid", T0)], MEAS)
    got = {r.column_name: r for r in MO.catalog(m, "m").collect()}
    assert got["sensor_id"].null_count == 1 and got["sensor_id"].null_pct == 50.0
    assert got["value"].min_value == "1.0" and got["value"].max_value == "3.0"
    assert got["id"].distinct_count == 2 and got["timestamp"].data_type == "timestamp_ntz"


def test_hourly_by_location_pre_aggregates(spark):
    m = spark.createDataFrame([(i, s, T0 - dt.timedelta(minutes=10 - i), float(i), "valid", T0)
                               for i, s in enumerate(["a", "b", "a", "b"])], MEAS)
    s = _s(spark, ["a", "b"]).withColumn("location", F.lit("same"))
    r = R.hourly_by_location(m, s, T0, "24 hours").collect()
    assert [(x.location, x.sample_count, x.avg_temp, x.min_temp, x.max_temp) for x in r] == [("same", 4, 1.5, 0.0, 3.0)]


def test_tables_check(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0)], MEAS)
    s = _s(spark, ["a"])
    s.createOrReplaceTempView("sensors_t")
    m.createOrReplaceTempView("measurements_t")
    present = {r.table_name: r.present for r in MO.tables_present(spark, ["sensors_t", "measurements_t", "nope"]).collect()}
    assert present == {"sensors_t": True, "measurements_t": True, "nope": False}
    rep = {r.check_name: (r.value, r.status) for r in
           MO.health_report(s, m, T0, tables=["sensors_t", "measurements_t"]).collect()}
    assert rep["tables"] == (2.0, "PASS")


def test_hourly_by_location_is_the_same_at_any_size(spark, monkeypatch):
    import sensorflow.operators.joins as J
    import sensorflow.operators.reports as RR
    m = spark.createDataFrame([(i, f"s{i % 4}", T0 - dt.timedelta(minutes=7 * i), float(i % 13) if i % 5 else None, "valid", T0)
                               for i in range(200)], MEAS)
    s = _s(spark, ["s0", "s1", "s2", "s3"]).withColumn("location", F.when(F.col("sensor_id") < "s2", "x")
                                                       .otherwise("y"))
    a = sorted(RR.hourly_by_location(m, s, T0, "24 hours").collect())
    monkeypatch.setattr(J, "fits_broadcast", lambda df, max_bytes: False)
    b = sorted(RR.hourly_by_location(m, s, T0, "24 hours").collect())
    assert a == b and len(a) > 0
    one = RR.hourly_by_location(m.limit(0).unionByName(spark.createDataFrame(
        [(1, "s0", T0, 10.0, "valid", T0), (2, "s0", T0, None, "valid", T0)], MEAS)), s, T0, "24 hours").first()
    assert (one.avg_temp, one.sample_count) == (10.0, 2)  # a NULL value counts, but not in the mean


def test_views_for_sql_users(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0), (2, "a", T0 + dt.timedelta(minutes=5), 3.0,
                                                                 "out_of_range", T0)], MEAS)
    names = R.register_views(_s(spark, ["a", "b"]), m, prefix="t_")
    assert names == ["t_sensors", "t_measurements", "t_latest_readings", "t_hourly_aggregates"]
    r = spark.sql("SELECT sensor_id, value FROM t_latest_readings").collect()
    assert [(x.sensor_id, x.value) for x in r] == [("a", 3.0)]
    h = spark.sql("SELECT sample_count, valid_percentage FROM t_hourly_aggregates").first()
    assert (h.sample_count, h.valid_percentage) == (2, 50.0)


def test_hourly_aggregates_quality_parameter(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0), (2, "a", T0, 99.0, "out_of_range", T0)], MEAS)
    s = _s(spark, ["a"])
    every = R.hourly_aggregates(s, m).first()
    valid = R.hourly_aggregates(s, m, quality="valid").first()
    assert (every.sample_count, every.max_value, every.valid_percentage) == (2, 99.0, 50.0)
    assert (valid.sample_count, valid.max_value, valid.valid_percentage) == (1, 1.0, 100.0)
