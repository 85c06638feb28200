"""Models on a small frame: fit, score, save, load, scenarios, registry contract."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from delaylens import schemas as S
from delaylens.operators import risk
from delaylens.plans import fact, scoring

TINY = scoring.Settings(logistic_iterations=20, forest_trees=5, forest_depth=4, boosted_rounds=3,
                        boosted_depth=3)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        wind = rng.uniform(0, 40)
        rows.append((f"f{i}", "AA", rng.choice("AB"), rng.choice("AB"), *[
            wind if c == "wind_speed_knots" else rng.random() for c in S.FEATURE_COLUMNS],
            wind + rng.gauss(0, 6) - 5, 0.0, 0.0))
    fields = ", ".join(f"{c} double" for c in S.FEATURE_COLUMNS)
    df = spark.createDataFrame(
        rows, f"flight_id string, airline_code string, Origin string, Dest string, {fields}, "
              "dep_delay_minutes double, arr_delay_minutes double, weather_delay_mins double")
    return risk.stratified_split(scoring.with_target(df), "is_delayed", "flight_id").cache()


def test_models_beat_chance(spark, frame):
    fit, test = frame.where("split = 'train'"), frame.where("split = 'test'")
    models = {n: scoring.train(fit, k, TINY) for n, k in scoring.CLASSIFIERS.items()}
    table = {r["model"]: r for r in scoring.compare(models, test).collect()}
    assert set(table) == set(scoring.CLASSIFIERS)
    assert all(r["auc"] > 0.7 for r in table.values())
    assert sum(r["best"] for r in table.values()) == 1
    top = scoring.importance(spark, models["Random Forest"]).first()
    assert top["feature"] == "wind_speed_knots" and top["label"] == "Wind speed (knots)"
    linear = scoring.importance(spark, models["Logistic Regression"])
    assert linear.first()["feature"] == "wind_speed_knots"
    assert scoring.weather_importance(linear).count() == len(S.WEATHER_FEATURES)
    scored = scoring.score_flights(frame, models["Gradient Boosting"])
    assert scored.count() == 400 and "split" in scored.columns
    assert scored.where("risk_score < 0 OR risk_score > 1 OR risk_score IS NULL").count() == 0


def test_artifacts_and_scenarios(spark, frame, tmp_path):
    path = str(tmp_path / "models")
    assert scoring.load_artifacts(path, spark) is None
    medians = spark.createDataFrame([("wind_speed_knots", 12.0), ("temperature_c", 9.0)],
                                    "feature string, median double")
    models = {k: scoring.train(frame, k, TINY) for k in ("boosted", "minutes")}
    scoring.save_artifacts(path, spark, models, medians)
    art = scoring.load_artifacts(path, spark)
    assert art.features == S.FEATURE_COLUMNS and art.regressor is not None
    asked = spark.createDataFrame([(1, "A", "B", 38.0), (2, "A", "?", None)],
                                  "scenario int, Origin string, Dest string, wind_speed_knots double")
    hubs = spark.createDataFrame([("A", 0.5, 0.25)],
                                 "airport string, pagerank double, betweenness double")
    places = spark.createDataFrame([("A", 33.64, -84.43), ("B", 33.94, -118.41)],
                                   "airport string, lat double, lon double")
    got = {r["scenario"]: r for r in scoring.score_scenarios(asked, art, hubs, places).collect()}
    assert abs(got[1]["Distance"] - 1943) < 6 and got[2]["Distance"] == S.DEFAULT_DISTANCE_MILES
    assert got[2]["wind_speed_knots"] == 12.0 and got[2]["temperature_c"] == 9.0
    assert got[1]["origin_pagerank"] == 0.5 and got[1]["dest_betweenness"] == 0.0
    assert got[1]["risk_score"] > got[2]["risk_score"]
    assert got[1]["predicted_minutes"] > got[2]["predicted_minutes"]
    assert got[1]["band"] == "High"


def test_registry_contract():
    import __spark_entry__ as e
    queries, oracles = e.queries(), e.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100
    assert all(callable(f) for f in queries.values())


@pytest.mark.parametrize("name", ["delay_rate_by_hour", "flight_weather_fact", "type2_history",
                                  "risk_bands", "route_counts", "stratified_split"])
def test_registered_query_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import glob
    import os

    import __spark_entry__ as e
    from tools.check import digest
    if not os.path.isdir(e.SMOKE_DIR):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for path in glob.glob(f"{e.SMOKE_DIR}/*.parquet"):
        view = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    df = e.queries()[name](spark, e.SMOKE_DIR)
    cur = con.execute(e.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert digest(df.columns, df.collect()) == digest(columns, cur.fetchall())


class _RowsRead:
    """Counts how often rows of a frame are gone over while a function runs."""

    def __init__(self, spark):
        self.total = spark.sparkContext.accumulator(0)

    def watched(self, df):
        total = self.total

        def run(batches):
            for batch in batches:
                total.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)


def test_models_of_a_run_share_their_learnt_rows(spark, frame, monkeypatch):
    """The table is gone over twice for all models, to count it and to draw the sample."""
    cfg = scoring.Settings(logistic_iterations=20, forest_trees=3, forest_depth=3, boosted_rounds=3,
                           boosted_depth=2, histogram=True, fit_rows=300)
    seen = _RowsRead(spark)
    fit = frame.where("split = 'train'").localCheckpoint()
    n = fit.count()
    learnt = scoring.learnt_table(seen.watched(fit), cfg)
    assert seen.total.value <= 2 * n
    whole = replace(cfg, fit_rows=None)
    for kind in ("logistic", "forest", "boosted", "minutes"):
        scoring.train(learnt, kind, whole)
    assert seen.total.value <= 2 * n
    narrow = learnt.columns
    expected = scoring.learnt_rows(fit, cfg).select(*narrow).collect()
    assert 0 < len(expected) < n
    assert sorted(map(str, learnt.collect())) == sorted(map(str, expected))


def test_all_rows_are_learnt_without_a_bound(spark, frame):
    fit = frame.where("split = 'train'")
    assert scoring.learnt_table(fit, scoring.Settings()) is fit
    small = scoring.learnt_table(fit, scoring.Settings(fit_rows=10 ** 6))
    assert small.count() == fit.count()


def test_training_run_reads_the_sample_once(spark, monkeypatch):
    """Every model of a run gets one stored sample; none draws its own from the whole table."""
    got, drawn = [], []
    learnt_rows = scoring.learnt_rows
    monkeypatch.setattr(scoring, "learnt_rows", lambda df, cfg: drawn.append(cfg.fit_rows) or learnt_rows(
        df, cfg))
    train = scoring.train
    monkeypatch.setattr(scoring, "train", lambda df, kind, cfg: got.append((df, kind)) or train(
        df, kind, cfg))
    rows = [(f"f{i}", 1 + i % 5, i % 24, f"A{i % 4}", f"A{(i + 1 + i % 3) % 4}", float(i % 70), i % 9 == 0)
            for i in range(400)]
    facts = spark.createDataFrame(rows, "flight_id string, day_of_week long, hour_id long, "
                                  "origin_airport_id string, dest_airport_id string, "
                                  "dep_delay_minutes double, is_cancelled boolean")
    missing = [c for c in fact.FACT_COLUMNS if c not in facts.columns]
    texts = {"airline_id": "string", "tail_number": "string", "date_id": "date"}
    facts = facts.select("*", *[F.lit(None).cast(texts.get(c, "double")).alias(c) for c in missing])
    cfg = scoring.Settings(logistic_iterations=5, forest_trees=2, forest_depth=2, boosted_rounds=2,
                           boosted_depth=2, histogram=True, fit_rows=100)
    result = scoring.run_training(facts, cfg)
    assert [kind for _, kind in got] == ["logistic", "forest", "boosted", "minutes"]
    assert len({id(df) for df, _ in got}) == 1
    assert drawn == [100, None, None, None, None]
    assert result["scored"].count() == sum(not r[-1] for r in rows)
    assert result["comparison"].count() == 3 and result["mae"].first()["mae"] >= 0


def test_class_weights_and_split_read_their_rows_once(spark):
    """One pass for the weights, three for a split; also with a class that is NULL and repeated keys."""
    data = [(f"k{i % 90}", [0, 1, None][i % 3]) for i in range(300)]
    df = spark.createDataFrame(data, "id string, y int").localCheckpoint()
    seen = _RowsRead(spark)
    weights = {r["y"]: (r["n"], r["weight"]) for r in risk.class_weights(seen.watched(df), "y").collect()}
    assert seen.total.value == 300
    assert weights == {y: (100, 1.0) for y in (0, 1, None)}
    seen = _RowsRead(spark)
    split = risk.stratified_split(seen.watched(df), "y", "id").collect()
    assert seen.total.value <= 3 * 300
    assert len(split) == 300
    # NULL keys count for the size of their class
    odd = spark.createDataFrame([(f"k{i}" if i < 95 else None, i % 2) for i in range(100)], "id string, y int")
    sizes = {(r["y"], r["split"]): r["count"] for r in risk.stratified_split(odd, "y", "id").groupBy(
        "y", "split").count().collect()}
    assert sizes == {(0, "test"): 10, (0, "train"): 40, (1, "test"): 10, (1, "train"): 40}
    none = spark.createDataFrame([], "id string, y int")
    assert risk.class_weights(none, "y").collect() == []
    assert risk.stratified_split(none, "y", "id").collect() == []


def test_drivers_of_odd_rows_and_their_plan(spark):
    """Missing values, medians and weights; and one expression for all features, whatever their number."""
    columns = [f"c{i}" for i in range(12)]
    rng = random.Random(3)
    rows = [(i, *[rng.choice([None, float("nan"), 0.0, rng.uniform(-9, 9)]) for _ in columns])
            for i in range(60)] + [(None, *[1.0] * 12), (0, *[2.5] * 12)]
    df = spark.createDataFrame(rows, "scenario int, " + ", ".join(f"{c} double" for c in columns))
    middles = {c: rng.uniform(-3, 3) for c in columns[:10]} | {"c3": None, "other": 1.0}
    weights = {c: rng.random() for c in columns[1:]} | {"c5": None}
    tables = [spark.createDataFrame(list(d.items()), f"feature string, {n} double")
              for d, n in ((middles, "median"), (weights, "importance"))]
    out = risk.drivers(df, *tables, k=4, columns=columns)

    def expected(scenario, *values):
        parts = []
        for c, value in zip(columns, values):
            middle = middles.get(c) if middles.get(c) is not None else value
            if value is None or weights.get(c) is None:
                parts.append((1.0, c, None))
                continue
            pull = (value - middle) / (max(abs(middle), 1.0) if middle == middle else middle) * weights[c]
            parts.append((-abs(pull) if pull == pull else float("inf"), c, (
                scenario, c, value, middle, weights[c], pull)))
        return [p for *_, p in sorted(parts, key=lambda x: x[:2])[:4] if p]

    got = [tuple(r) for r in out.select("scenario", "feature", "value", "median", "importance",
                                        "contribution").collect()]
    assert sorted(map(str, got)) == sorted(str(p) for r in rows for p in expected(*r))
    assert out.columns == ["scenario", "contribution", "feature", "value", "median", "importance"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("greatest(") <= 2
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        risk.drivers(df, tables[0].union(tables[0].limit(1)), tables[1], columns=columns).collect()


def test_features_of_a_scenario_come_from_one_row_of_medians(spark):
    forms = spark.createDataFrame([("s", "A", "B", None, 3.0), (None, None, "Z", 7.0, None)],
                                  "scenario string, Origin string, Dest string, day_of_week double, "
                                  "temperature_c double")
    medians = spark.createDataFrame([("day_of_week", 4.0), ("temperature_c", None), ("Distance", 500.0)],
                                    "feature string, median double")
    hubs = spark.createDataFrame([("A", 0.1, 0.2)], "airport string, pagerank double, betweenness double")
    coords = spark.createDataFrame([("A", 30.0, -100.0)], "airport string, lat double, lon double")
    full = risk.complete_features(forms, medians, hubs, coords)
    got = {r["scenario"]: r for r in full.collect()}
    assert [got[s][c] for s in ("s", None) for c in ("day_of_week", "temperature_c", "Distance",
            "origin_pagerank", "flight_month")] == [4.0, 3.0, 500.0, 0.1, 0.0, 7.0, 0.0, 500.0, 0.0, 0.0]
    none = risk.complete_features(forms, medians.limit(0), hubs, coords).where("scenario = 's'").first()
    assert (none["Distance"], none["day_of_week"]) == (S.DEFAULT_DISTANCE_MILES, 0.0)
    rows = full._jdf.queryExecution().optimizedPlan().toString().split("coalesce(day_of_week", 1)[1]
    assert "element_at" not in rows.split("\n", 1)[0]
