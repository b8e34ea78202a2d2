"""Edge rows for the reading validator (FIXTURES §3)."""

import datetime as dt
import math

import pytest

from sensorflow.operators.quality import parse_readings, split_valid

UTC_T = dt.datetime(2024, 1, 1, 10, 0, 0)
EPOCH = 1704103200  # 2024-01-01 10:00:00 UTC

CASES = [
    # body, expected error_class, error_field, sensor_id, timestamp, value, unit
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":1.5,"unit":"C"}}', None, None, "s1", UTC_T, 1.5, "C"),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH * 1000},"value":1.5,"unit":"C"}}', None, None, "s1", UTC_T, 1.5, "C"),
    ('{"sensor_id":"s1","timestamp":"2024-01-01T10:00:00Z","value":1.5,"unit":"C"}', None, None, "s1", UTC_T, 1.5, "C"),
    ('{"sensor_id":"s1","timestamp":"2024-01-01T12:00:00+02:00","value":1.5,"unit":"C"}', None, None, "s1", UTC_T, 1.5, "C"),
    ('{"sensor_id":"s1","timestamp":"2024-01-01T10:00:00","value":1.5,"unit":"C"}', None, None, "s1", UTC_T, 1.5, "C"),
    (f'{{"sensor_id":"s1","timestamp":"{EPOCH}","value":1.5,"unit":"C"}}', "bad_schema", "timestamp", None, None, None, None),
    ('{"sensor_id":"s1","timestamp":"yesterday","value":1.5,"unit":"C"}', "bad_schema", "timestamp", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":"12.5","unit":"C"}}', None, None, "s1", UTC_T, 12.5, "C"),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":true,"unit":"C"}}', None, None, "s1", UTC_T, 1.0, "C"),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"unit":"C"}}', "bad_schema", "value", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":null,"unit":"C"}}', "bad_schema", "value", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":"warm","unit":"C"}}', "bad_schema", "value", None, None, None, None),
    (f'{{"sensor_id":5,"timestamp":{EPOCH},"value":1.5,"unit":"C"}}', "bad_schema", "sensor_id", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":1.5}}', "bad_schema", "unit", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":1.5,"unit":"C","location":{{"lat":1,"lng":2}},"x":[1]}}',
     None, None, "s1", UTC_T, 1.5, "C"),
    (f'[{{"sensor_id":"s1","timestamp":{EPOCH},"value":1.5,"unit":"C"}}]', "other", None, None, None, None, None),
    ("null", "other", None, None, None, None, None),
    ("this is not json", "bad_json", None, None, None, None, None),
    ('{"sensor_id":"s1","timestamp":', "bad_json", None, None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":NaN,"unit":"C"}}', None, None, "s1", UTC_T, float("nan"), "C"),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":-Infinity,"unit":"C"}}', None, None, "s1", UTC_T, float("-inf"), "C"),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":[NaN, Infinity],"unit":"C"}}', "bad_schema", "value",
     None, None, None, None),
    (f'{{"sensor_id":NaN,"timestamp":{EPOCH},"value":1.5,"unit":"C"}}', "bad_schema", "sensor_id", None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":"{EPOCH}","value":NaN,"unit":"C"}}', "bad_schema", "timestamp",
     None, None, None, None),
    (f'{{"sensor_id":"s1","timestamp":{EPOCH},"value":Infinity,"unit":NaN}}', "bad_schema", "unit", None, None, None, None),
    (f'{{"sensor_id":"NaN","timestamp":{EPOCH},"value":"NaN","unit":"C"}}', None, None, "NaN", UTC_T, float("nan"), "C"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, body string")
    return {r.i: r for r in parse_readings(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(parsed, i):
    body, ec, ef, sid, ts, val, unit = CASES[i]
    r = parsed[i]
    assert (r.error_class, r.error_field) == (ec, ef), body
    assert r.sensor_id == sid
    assert r.timestamp == ts
    assert r.unit == unit
    if isinstance(val, float) and math.isnan(val):
        assert math.isnan(r.value)
    else:
        assert r.value == val


def test_split_keeps_every_row(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)]
    p = parse_readings(spark.createDataFrame(rows, "i int, body string"))
    valid, rejected = split_valid(p)
    assert valid.count() + rejected.count() == len(rows)
    assert valid.join(rejected, "i").count() == 0


def test_numbers_and_times_that_only_look_right_are_rejected(spark):
    ok = '{"sensor_id": "s", "unit": "C", "value": %s, "timestamp": %s}'
    t = '"2024-01-02T03:04:05Z"'
    values = {'"12.5f"': False, '"1d"': False, '"0x10"': False, '""': False, '"12.5"': True, '" -1e3 "': True, '".5"': True, '"nan"': True,
              '"-Infinity"': True, '"1_000"': True}
    times = {'"2024"': False, '"2024-03"': False, '"12:30"': False, '"2024-1-1"': False, '"2024-01-02T03:04:05+02"': False,
             '"2024-01-02T03:04:05 Europe/Paris"': False, '"2024-01-02"': True, '"2024-01-02 03:04"': True,
             '"2024-01-02T03:04:05.123456+02:00"': True}
    bodies = [ok % (v, t) for v in values] + [ok % ("1", x) for x in times]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = {r.i: r.error_class for r in parse_readings(df).collect()}
    for i, (text, good) in enumerate([*values.items(), *times.items()]):
        assert (got[i] is None) == good, text


def test_correlation_of_constant_and_offset_series(spark):
    import datetime as dt

    from sensorflow.operators.timeseries import sensor_correlation
    t0 = dt.datetime(2024, 1, 1)
    noise = [((i * 7919) % 101) / 101 for i in range(300)]
    rows = [(k, t0 + dt.timedelta(seconds=i), v, "valid") for i, x in enumerate(noise)
            for k, v in (("a", 21.7), ("b", x), ("c", 1e8 + x), ("d", 1e8 + x))]
    m = spark.createDataFrame(rows, "sensor_id string, timestamp timestamp_ntz, value double, quality_flag string")
    got = {(r.sensor_1, r.sensor_2): r.correlation for r in sensor_correlation(m, None, "1 day", None, 100).collect()}
    assert got["a", "b"] is None and got["a", "c"] is None
    assert abs(got["c", "d"] - 1) < 1e-9 and abs(got["b", "c"] - 1) < 1e-6


# Forms of an ISO time: text -> UTC wall clock, None where it is no event time.
ISO_CASES = [
    ("2024-01-01", dt.datetime(2024, 1, 1)), ("2024-01-01T12", dt.datetime(2024, 1, 1, 12)), ("2024-01-01_12:30", dt.datetime(2024, 1, 1, 12, 30)),
    ("2024-01-01T12:30:00+02:00:30", dt.datetime(2024, 1, 1, 10, 29, 30)), ("2024-01-01T12+02:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T12:30:00.123-00:30", dt.datetime(2024, 1, 1, 13, 0, 0, 123000)), ("2024-01-01 12:30:00.123456Z", dt.datetime(2024, 1, 1, 12, 30, 0, 123456)),
    ("2024-01-01T12:30:00+00:00:00.000001", dt.datetime(2024, 1, 1, 12, 29, 59, 999999)), ("2024-01-01Z", dt.datetime(2024, 1, 1)),
    ("2024-01-01T12Z", dt.datetime(2024, 1, 1, 12)), ("2024-12-31T23:59:59-23:59", dt.datetime(2025, 1, 1, 23, 58, 59)),
    ("2024-01-01é12:00", dt.datetime(2024, 1, 1, 12)),
    ("2024-01-01T", None), ("2024-01-01T1", None), ("2024-01-01T12:3", None), ("2024-01-01T12:30:00.1", None), ("2024-01-01T12:30:00.12345", None),
    ("2024-01-01T24:00", None), ("2024-01-01T12:60", None), ("2024-01-01T12:30:60", None), ("2024-02-30", None), ("0000-01-01", None),
    ("0000-01-01T10:00:00Z", None), ("2024-01-01T12:30+24:00", None), ("2024-01-01T12:30+2", None), ("2024-1-1", None), ("20240101", None),
    ("2024-01-01T12:30:00 UTC", None), ("12:30", None), ("", None), (" 2024-01-01", None),
]


def test_iso_forms(spark):
    from pyspark.sql import functions as F
    from sensorflow.functions.time import parse_event_time
    df = spark.createDataFrame([(t,) for t, _ in ISO_CASES], "t string")
    got = {r.t: r.p for r in df.select("t", parse_event_time(F.lit(None).cast("double"), F.col("t")).alias("p")).collect()}
    assert got == dict(ISO_CASES)
