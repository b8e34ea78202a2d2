import datetime as dt

from sensorflow.operators.quality import (check_keys, check_not_null, check_orphans, clamp_to_range, dedupe,
                                          find_duplicates, flag_quality)

T0 = dt.datetime(2024, 1, 1)
SENSORS = "sensor_id string, location string, sensor_type string, unit string, min_value double, max_value double"
MEAS = "id long, sensor_id string, timestamp timestamp_ntz, value double, created_at timestamp_ntz"


def _sensors(spark):
    return spark.createDataFrame([("a", "L1", "t", "C", 0.0, 50.0), ("b", "L2", "t", "C", 0.0, 50.0)], SENSORS)


def test_flag_bounds_nan_inf_unknown(spark):
    vals = [(1, "a", 0.0), (2, "a", 50.0), (3, "a", -0.01), (4, "a", 50.01), (5, "a", float("nan")),
            (6, "a", float("inf")), (7, "a", float("-inf")), (8, "zz", 10.0), (9, "b", 25.0)]
    m = spark.createDataFrame([(i, s, T0, v, T0) for i, s, v in vals], MEAS)
    got = {r.id: r.quality_flag for r in flag_quality(m, _sensors(spark)).collect()}
    assert got == {1: "valid", 2: "valid", 3: "out_of_range", 4: "out_of_range", 5: "out_of_range",
                   6: "out_of_range", 7: "out_of_range", 8: "unknown_sensor", 9: "valid"}


def test_flag_keeps_all_rows_and_columns(spark):
    m = spark.createDataFrame([(i, "zz", T0, 1.0, T0) for i in range(5)], MEAS)
    out = flag_quality(m, _sensors(spark))
    assert out.count() == 5
    assert out.columns == ["id", "sensor_id", "timestamp", "value", "quality_flag", "created_at"]


def test_dedupe_keeps_first_landing(spark):
    rows = [(1, "a", T0, 1.0, T0), (2, "a", T0, 2.0, T0 + dt.timedelta(hours=1)),
            (3, "a", T0 + dt.timedelta(seconds=1), 3.0, T0), (4, "b", T0, 4.0, T0)]
    m = spark.createDataFrame(rows, MEAS)
    got = sorted(r.id for r in dedupe(m).collect())
    assert got == [1, 3, 4]
    d = find_duplicates(m).collect()
    assert [(r.sensor_id, r.copies, r.first_id, r.last_id) for r in d] == [("a", 2, 1, 2)]


def test_key_and_orphan_checks(spark):
    s = _sensors(spark)
    assert check_keys(s.unionByName(s.limit(1)), "sensor_id").collect()[0].copies == 2
    m = spark.createDataFrame([(1, "a", T0, 1.0, T0), (2, "x", T0, 1.0, T0), (3, "x", T0, 1.0, T0)], MEAS)
    assert [(r.sensor_id, r.orphan_rows) for r in check_orphans(m, s).collect()] == [("x", 2)]


def test_not_null_single_pass(spark):
    m = spark.createDataFrame([(1, None, T0, 1.0, None), (2, "a", T0, 2.0, T0)], MEAS)
    got = {r.column_name: (r.null_count, r.status) for r in check_not_null(m, ["sensor_id", "value", "created_at"]).collect()}
    assert got == {"sensor_id": (1, "FAIL"), "value": (0, "PASS"), "created_at": (1, "FAIL")}


def test_clamp(spark):
    m = spark.createDataFrame([(1, "a", T0, 60.123, T0), (2, "a", T0, -3.0, T0), (3, "a", T0, 12.345, T0),
                               (4, "zz", T0, 99.0, T0), (5, "a", T0, float("nan"), T0)], MEAS)
    got = {r.id: (r.value, r.clamped) for r in clamp_to_range(m, _sensors(spark)).collect()}
    assert got[1] == (50.0, True) and got[2] == (0.0, True) and got[3] == (12.35, False)
    assert got[4] == (99.0, False) and got[5][1] is False
