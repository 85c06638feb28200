"""Edge values of the column helpers."""

import datetime as dt

from pyspark.sql import functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators import joins


def values(spark, rows, schema, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_hour_of_clock(spark):
    rows = [(2400,), (5,), (None,), (959,), (0,)]
    assert values(spark, rows, "t int", C.hhmm_hour("t")) == [24, 0, None, 9, 0]
    assert values(spark, rows, "t int", C.hhmm_hour("t", clip=True)) == [23, 0, 0, 9, 0]
    assert values(spark, rows, "t int", C.hhmm_text("t")) == [
        "24:00", "00:05", None, "09:59", "00:00"]


def test_date_and_clock(spark):
    rows = [("2024-01-31", 2400), ("2024-01-31", 1430)]
    got = values(spark, rows, "d string, t int",
                 F.date_format(C.hhmm_timestamp("d", "t"), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-02-01 00:00", "2024-01-31 14:30"]


def test_weekday_codings(spark):
    day = dt.date(2024, 1, 7)  # a Sunday
    assert values(spark, [(day,)], "d date", C.weekday_number("d")) == [1]
    assert values(spark, [(day,)], "d date", C.weekday_name("d")) == ["Sunday"]
    # 0 = Monday ... 6 = Sunday
    got = values(spark, [(i,) for i in range(7)], "n int", C.weekday_from_monday_zero("n"))
    assert got == [2, 3, 4, 5, 6, 7, 1]
    assert values(spark, [(1,), (2,)], "n int", C.weekday_label("n")) == ["Sun", "Mon"]


def test_key_is_null_when_a_part_is_null(spark):
    rows = [("a", 1), (None, 1), ("a", None)]
    assert values(spark, rows, "a string, b int", C.joined_key(["a", "b"], "_")) == [
        "a_1", None, None]


def test_group_token_keeps_null_apart(spark):
    got = values(spark, [(None,), ("-",), ("",)], "a string", C.group_token("a"))
    assert len(set(got)) == 3 and None not in got


def test_cancelled_flag_has_three_states(spark):
    rows = [(1.0,), (0.0,), (None,), (2.0,)]
    assert values(spark, rows, "c double", C.cancelled_flag("c")) == [True, False, None, None]


def test_clamp(spark):
    rows = [(3777.0,), (-800.0,), (None,), (15.0,)]
    assert values(spark, rows, "d double", C.clamp("d", -720, 720)) == [720, -720, None, 15]
    assert values(spark, rows, "d double", C.clamp("d", -720, 720, 0)) == [720, -720, 0, 15]


def test_delayed_is_above_fifteen(spark):
    assert values(spark, [(15.0,), (15.1,), (None,)], "d double", C.is_delayed("d")) == [0, 1, 0]


def test_risk_edges(spark):
    rows = [(0.0,), (0.3,), (0.6,), (1.0,), (0.300001,), (None,)]
    assert values(spark, rows, "s double", C.risk_label("s")) == [
        None, "Low", "Medium", "High", "Medium", None]
    assert values(spark, rows, "s double", C.risk_band("s")) == [
        "Low", "Medium", "High", "High", "Medium", None]


def test_cut_is_right_closed_with_lowest_included(spark):
    rows = [(0.0,), (3.0,), (3.1,), (60.0,), (60.1,), (-1.0,), (None,)]
    got = values(spark, rows, "w double", C.cut_index("w", S.BIN_EDGES["wind_speed_knots"]))
    assert got == [0, 0, 1, 10, None, None, None]


def test_histogram_closes_the_last_bin(spark):
    rows = [(-60.0,), (179.9,), (180.0,), (181.0,), (-57.0,)]
    assert values(spark, rows, "d double", C.histogram_bin("d", -60, 180, 80)) == [
        0, 79, 79, None, 1]


def test_haversine(spark):
    rows = [(33.6407, -84.4277, 33.9416, -118.4085), (None, None, 33.9, -118.4)]
    got = values(spark, rows, "a double, b double, c double, d double",
                 C.haversine_miles("a", "b", "c", "d"))
    assert abs(got[0] - 1943) < 6 and got[1] == S.DEFAULT_DISTANCE_MILES


def test_label_falls_back_to_the_code_or_drops(spark):
    names = joins.code_table(spark, {"DL": "Delta Air Lines", "AA": "American Airlines"})
    df = spark.createDataFrame([("DL",), ("??",)], "c string")
    kept = {r["c"]: r["name"] for r in joins.with_label(df, "c", names, "name").collect()}
    assert kept == {"DL": "Delta Air Lines", "??": "??"}
    assert joins.with_label(df, "c", names, "name", keep_unknown=False).count() == 1


def test_display_time_of_unreadable_text(spark):
    got = values(spark, [("2024-01-02T03:04:05",), ("soon",)], "t string", C.display_time("t"))
    assert got == ["2024-01-02  03:04 UTC", None]


def test_hash_bucket_is_stable(spark):
    import hashlib
    got = values(spark, [("abc",), ("x_1",)], "k string", C.hash_bucket("k"))
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 100 for k in ("abc", "x_1")]
