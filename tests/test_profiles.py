"""Monthly sketches against full scans."""

import os
import random

from pyspark.sql import functions as F

from delaylens.session import scratch
from delaylens.sources import profiles


def rows(seed, months=((2024, 1), (2024, 2), (2024, 3)), n=900):
    rng = random.Random(seed)
    return [(y, m, rng.choice([None, rng.gauss(10 * m, 30)]) if rng.random() < 0.5 else float(k % 97),
             f"N{rng.randint(0, 400)}" if rng.random() < 0.9 else None, rng.choice("AB"))
            for y, m in months for k in range(n)]


SCHEMA = "year int, month int, delay double, tail string, carrier string"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_profiles_merge_over_any_range(spark):
    data, path = rows(1), scratch(spark, "profiles")
    df = spark.createDataFrame(data, SCHEMA)
    profiles.update(df, path, ["delay"], ["tail", "carrier"])
    for first, last in ((None, None), ((2024, 2), (2024, 3)), ((2024, 2), (2024, 2))):
        part = [r for r in data if (first or (0, 0)) <= r[:2] <= (last or (9999, 1))]
        got = {r.column_name: r for r in profiles.summary(spark, path, first, last).collect()}
        for name, at in (("delay", 2), ("tail", 3), ("carrier", 4)):
            known = [r[at] for r in part if r[at] is not None]
            assert (got[name].row_count, got[name].missing) == (len(part), len(part) - len(known))
            assert got[name].distinct_values == len(set(known))
        delays = sorted(r[2] for r in part if r[2] is not None)
        mean = sum(delays) / len(delays)
        assert (got["delay"].low, got["delay"].high) == (delays[0], delays[-1])
        assert abs(got["delay"].mean - mean) < 1e-9
        std = (sum((x - mean) ** 2 for x in delays) / (len(delays) - 1)) ** 0.5
        assert abs(got["delay"].std - std) < 1e-6
        for r in profiles.quantiles(spark, path, [0.1, 0.5, 0.9], first, last).collect():
            below = sum(x <= r.value for x in delays) / len(delays)
            assert abs(below - r.p) < 0.02
        asked = spark.createDataFrame([("carrier", "A"), ("tail", "N7"), ("tail", "none")],
                                      "column_name string, value string")
        n = {(r.column_name, r.value): r.n
             for r in profiles.frequencies(spark, path, asked, first, last).collect()}
        assert n == {("carrier", "A"): sum(r[4] == "A" for r in part),
                     ("tail", "N7"): sum(r[3] == "N7" for r in part), ("tail", "none"): 0}


def test_a_corrected_month_leaves_the_others(spark):
    data, path = rows(2), scratch(spark, "profiles")
    profiles.update(spark.createDataFrame(data, SCHEMA), path, ["delay"], ["tail"])
    before = files(path)
    fixed = [(*r[:2], 5.0, "one", r[4]) for r in data if r[1] == 2]
    profiles.update(spark.createDataFrame(fixed, SCHEMA), path, ["delay"], ["tail"])
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if "month=2" not in f} == same
    got = {r.column_name: r for r in profiles.summary(spark, path, (2024, 2), (2024, 2)).collect()}
    assert (got["tail"].distinct_values, got["delay"].low, got["delay"].high) == (1, 5.0, 5.0)


def test_large_columns_keep_their_error(spark):
    path = scratch(spark, "profiles")
    df = spark.range(200_000).select(
        F.lit(2024).alias("year"), (F.col("id") % 4 + 1).cast("int").alias("month"),
        ((F.col("id") * 7919) % 200_003).cast("double").alias("delay"), F.col("id").alias("tail"))
    profiles.update(df, path, ["delay"], ["tail"], k=400, width=512)
    got = {r.column_name: r.distinct_values for r in profiles.summary(spark, path).collect()}
    assert abs(got["tail"] / 200_000 - 1) < 5 / 64  # five standard errors
    for r in profiles.quantiles(spark, path, [0.01, 0.5, 0.99]).collect():
        assert abs(r.value / 200_003 - r.p) < 0.02
    asked = spark.createDataFrame([("tail", "17")], "column_name string, value string")
    n = profiles.frequencies(spark, path, asked).first().n
    assert 1 <= n <= 1 + 2 * 200_000 / 512


def test_columns_without_values(spark):
    path = scratch(spark, "profiles")
    df = spark.createDataFrame([(2024, 1, None, None, "A")], SCHEMA)
    profiles.update(df, path, ["delay"], ["tail"])
    got = {r.column_name: r for r in profiles.summary(spark, path).collect()}
    assert (got["delay"].missing, got["delay"].distinct_values, got["delay"].mean) == (1, 0, None)
    assert profiles.quantiles(spark, path, [0.5]).count() == 0
