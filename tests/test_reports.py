"""Ordered helpers, quantiles, samples, metrics and splits."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens import schemas as S
from delaylens.operators import filters, matrix, quantiles, reports, reshape, risk
from delaylens.operators.filters import FilterSpec
from delaylens.operators.running import running_totals


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(g, v, rng.randint(0, 9)) for g in ("a", "b") for v in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, n long")
    got = running_totals(df, ["g"], F.floor(F.col("v") / 7), ["v"], ["n"]).collect()
    for r in got:
        assert r["running_n"] == sum(n for g, v, n in rows if g == r["g"] and v <= r["v"])


def test_quantiles_match_linear_interpolation(spark):
    rng = random.Random(2)
    # one value holds a third of the rows; one column is mostly NULL
    rows = [(0.0 if rng.random() < 0.34 else rng.gauss(0, 50), rng.randint(0, 9),
             rng.random() if rng.random() < 0.2 else None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    probs = [0.0, 0.25, 0.5, 0.8, 0.92, 0.95, 1.0]
    got = {(r["feature"], r["p"]): r["value"]
           for r in quantiles.quantiles(df, ["a", "b", "c"], probs).collect()}
    for i, name in enumerate("abc"):
        data = [r[i] for r in rows if r[i] is not None]
        for p in probs:
            assert abs(got[name, p] - np.quantile(data, p)) < 1e-9, (name, p)


def test_impute_medians(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    filled, report = quantiles.impute_medians(df, ["a", "b"])
    assert sorted(r["a"] for r in filled.collect()) == [1.0, 2.0, 3.0]
    assert {r["feature"]: (r["missing"], r["median"]) for r in report.collect()} == {
        "a": (1, 2.0), "b": (3, None)}


@pytest.mark.parametrize("n", [0, 1, 50, 5000])
def test_sample_is_the_lowest_hashes(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = {r["k"] for r in reshape.sample_n(df, "k", n, prefix_buckets=64).collect()}
    order = sorted(range(1000), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert got == set(order[:n])


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_has_exact_shares(spark, share):
    df = spark.range(997).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    out = risk.stratified_split(df, "y", "id", share).collect()
    assert len(out) == 997
    for y in (0, 1):
        of_class = [r for r in out if r["y"] == y]
        assert sum(r["split"] == "test" for r in of_class) == int(len(of_class) * share + 0.5)
    again = {r["id"]: r["split"] for r in
             risk.stratified_split(df.repartition(7), "y", "id", share).collect()}
    assert again == {r["id"]: r["split"] for r in out}


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_metrics(spark):
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.4), rng.randint(0, 20) / 20) for _ in range(300)]
    df = spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in pairs],
                               "is_delayed int, risk_score double, prediction int")
    m = risk.binary_metrics(df).first()
    assert abs(m["auc"] - brute_auc(pairs)) < 1e-12
    hit = [(y, int(s >= 0.5)) for y, s in pairs]
    tp, fp, fn = (sum(h == x for h in hit) for x in ((1, 1), (0, 1), (1, 0)))
    assert abs(m["f1"] - 2 * tp / (2 * tp + fp + fn)) < 1e-12
    assert abs(m["accuracy"] - sum(a == b for a, b in hit) / 300) < 1e-12
    curve = risk.roc(df).orderBy(F.desc("score")).collect()
    assert curve[-1]["tpr"] == curve[-1]["fpr"] == 1.0
    report = {r["class"]: r for r in risk.class_report(df).collect()}
    assert abs(report["Delayed >15min"]["precision"] - tp / (tp + fp)) < 1e-12
    assert report["macro avg"]["support"] == 300


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = sorted((r["a"], r["b"]) for r in risk.standardise(df, ["a", "b"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_kpis_ignore_unknown_status(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0, None), ("2024-01-01", 0.0, 20.0),
                                ("2024-01-02", None, 30.0), ("2024-01-03", 0.0, 5.0)],
                               "flightdate string, cancelled double, depdelay double")
    r = reports.kpis(df).first()
    assert (r["total_flights"], r["cancelled"], r["delayed"], r["delay_rate"]) == (4, 1, 1, 0.5)
    day = reports.kpis(df, FilterSpec(date_range=("2024-01-02", "2024-01-02"))).first()
    assert day["total_flights"] == 1 and day["delay_rate"] is None


def test_month_filter_prunes_partitions(spark, tmp_path):
    rows = [("2024-01-05", 1, 0.0), ("2024-02-05", 2, 0.0)]
    df = spark.createDataFrame(rows, "flightdate string, month int, cancelled double")
    df.write.partitionBy("month").parquet(str(tmp_path / "t"))
    kept = filters.filter_flights(spark.read.parquet(str(tmp_path / "t")), FilterSpec([2]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 1 and "PartitionFilters: [isnotnull(month" in plan


def test_scores_filter_includes_the_last_day(spark):
    df = spark.sql("SELECT timestamp'2024-01-31 23:00:00' AS flight_date, 'Low' AS risk_label "
                   "UNION ALL SELECT timestamp'2024-02-01 00:00:00', 'Low'")
    spec = FilterSpec(date_range=("2024-01-01", "2024-01-31"), labels=["Low"])
    assert filters.filter_scores(df, spec).count() == 1


def test_scaffold_keeps_missing_members(spark):
    df = spark.createDataFrame([("Tue", 1.0)], "d string, v double")
    got = reshape.with_scaffold(df, "d", ["Mon", "Tue"]).orderBy("position").collect()
    assert [(r["d"], r["v"]) for r in got] == [("Mon", None), ("Tue", 1.0)]


def test_min_max_of_constant_and_clipped(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (100.0,)], "v double")
    got = sorted(r["scaled"] for r in reshape.min_max(df, "v", clip_q=0.5).collect())
    assert got == [0.0, 1.0, 1.0]
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r["scaled"] for r in reshape.min_max(same, "v").collect()] == [0.0, 0.0]


def test_risk_matrix(spark):
    df = spark.createDataFrame([("a", 4.0, 0.9, 10), ("b", 3.0, 0.1, 20), ("c", 2.0, 0.8, 30),
                                ("d", 1.0, 0.2, 40)],
                               "airport string, pagerank double, delay_rate double, count long")
    got = {r["airport"]: r["quadrant"].split(" (")[0] for r in matrix.risk_matrix(df).collect()}
    assert got == {"a": "High Risk", "b": "Safe Hub", "c": "Unreliable", "d": "Low Priority"}


def test_drivers_rank_by_size(spark):
    features = spark.createDataFrame([(1, 10.0, 0.5, 3.0)], "scenario int, a double, b double, c double")
    middle = spark.createDataFrame([("a", 5.0), ("b", 0.0)], "feature string, median double")
    weight = spark.createDataFrame([("a", 0.1), ("b", -1.0), ("c", 1.0)],
                                   "feature string, importance double")
    got = risk.drivers(features, middle, weight, 2, ["a", "b", "c"]).collect()
    # c has no median, so it does not deviate
    assert [(r["feature"], r["contribution"]) for r in got] == [("b", -0.5), ("a", 0.1)]


def test_missing_profile_and_steps(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {r[0]: (r[1], r[2]) for r in reports.missing_profile(df).collect()}
    assert got == {"a": (0, 0.0), "b": (1, 50.0)}
    steps = reports.step_counts(all=df, full=df.dropna()).orderBy("position").collect()
    assert [(r["step"], r["row_count"], r["null_cells"]) for r in steps] == [
        ("all", 2, 1), ("full", 1, 0)]


def test_bin_edges_have_labels():
    assert len(S.WIND_BAND_LABELS) == len(S.WIND_BAND_EDGES) - 1


def test_roc_of_clustered_scores(spark):
    """All scores within one ten-thousandth: ranges are cut by the scores that are there."""
    rows = [(0.5 + (i * 37 % 400) / 4e6, int(i * i % 7 < 3)) for i in range(3000)]
    scored = spark.createDataFrame(rows, "risk_score double, is_delayed int")
    got = {r["score"]: (r["running_pos"], r["running_neg"], r["tpr"], r["fpr"])
           for r in risk.roc(scored).collect()}
    pos = sum(y for _, y in rows)
    assert len(got) == 400
    for score, (up, down, tpr, fpr) in got.items():
        above = [y for s, y in rows if s >= score]
        assert (up, down) == (sum(above), len(above) - sum(above))
        assert tpr == pytest.approx(up / pos) and fpr == pytest.approx(down / (3000 - pos))
    none = risk.roc(scored.where("false"))
    assert none.count() == 0
