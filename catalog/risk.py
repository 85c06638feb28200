"""Features, splits, metrics and models."""

import math

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from catalog.network import HUBS, hubs
from catalog.reports import rounded
from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators import quantiles, reshape, risk
from delaylens.plans import scoring
from delaylens.session import cut, scratch, stored

#: The sizes of the scoring job, with the leaf size of the study, learnt from a bounded sample.
SIZES = scoring.Settings(min_leaf=20, fit_rows=10_000, histogram=True)
MEASURES = ["temperature_c", "precipitation_mm", "wind_speed_knots", "cloud_cover_total_pct",
            "cloud_cover_low_pct"]
PLAIN = [c for c in S.FEATURE_COLUMNS if c.startswith(("rolling", "wind_speed_d", "lag", "dest_prev"))]

#: The model frame: operated flights with all features, none missing.
FEATURES = {**HUBS, "feat": (["fact", "hubs"], f"""
    SELECT flight_id, origin_airport_id AS "Origin", dest_airport_id AS "Dest",
      CAST(flight_month AS DOUBLE) AS flight_month, CAST(day_of_week AS DOUBLE) AS day_of_week,
      CAST(hour_id AS DOUBLE) AS scheduled_dep_hour, CAST(distance_miles AS DOUBLE) AS "Distance",
      coalesce(temperature_c, 24.5) AS temperature_c,
      coalesce(precipitation_mm, 0) AS precipitation_mm,
      coalesce(wind_speed_knots, 5) AS wind_speed_knots,
      CAST(coalesce(cloud_cover_total_pct, 22) AS DOUBLE) AS cloud_cover_total_pct,
      CAST(coalesce(cloud_cover_low_pct, 0) AS DOUBLE) AS cloud_cover_low_pct,
      {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in PLAIN)},
      {', '.join(f"coalesce({a}.{m}, 0) AS {side}_{m}" for a, side in (("ho", "origin"), ("hd", "dest"))
                 for m in ("pagerank", "betweenness"))},
      dep_delay_minutes, CASE WHEN dep_delay_minutes > 15 THEN 1 ELSE 0 END AS is_delayed
    FROM fact LEFT JOIN hubs ho ON origin_airport_id = ho.airport
      LEFT JOIN hubs hd ON dest_airport_id = hd.airport WHERE is_cancelled = FALSE""")}


def frame(spark, sf):
    """The model frame, written once for all queries on it."""
    return base.once(spark, sf, "frame", lambda: scoring.feature_frame(
        base.fact(spark, sf), hubs(spark, sf)))


@query("feature_medians", with_tables(recursive=True, extra=FEATURES, body=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(quantile_cont("{c}", 0.5), 9) AS median FROM feat"""
    for c in S.FEATURE_COLUMNS)))
def feature_medians(spark, sf):
    return rounded(quantiles.medians(frame(spark, sf), S.FEATURE_COLUMNS), "median")


@query("constant_imputation", with_tables("scores", body="""
SELECT flight_number, coalesce(temperature_c, 24.5) AS temperature_c,
  coalesce(precipitation_mm, 0) AS precipitation_mm,
  coalesce(wind_speed_knots, 5) AS wind_speed_knots,
  coalesce(cloud_cover_total_pct, 22) AS cloud_cover_total_pct,
  coalesce(cloud_cover_low_pct, 0) AS cloud_cover_low_pct FROM scores"""))
def constant_imputation(spark, sf):
    filled = reshape.impute(base.scores(spark, sf), S.WEATHER_MEDIANS)
    return filled.select("flight_number", *MEASURES)


@query("median_imputation", with_tables("scores", body="SELECT flight_number, " + ", ".join(
    f"round(coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) "
    f"FROM scores)), 9) AS {c}" for c in MEASURES) + " FROM scores"))
def median_imputation(spark, sf):
    filled, _ = quantiles.impute_medians(base.scores(spark, sf), MEASURES)
    return rounded(filled.select("flight_number", *MEASURES), *MEASURES)


@query("median_imputation_report", with_tables("scores", body=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 9) AS median FROM scores"
    for c in MEASURES)))
def median_imputation_report(spark, sf):
    _, report = quantiles.impute_medians(base.scores(spark, sf), MEASURES)
    return rounded(report, "median")


@query("stratified_split", with_tables("scores", body="""
SELECT flight_number, is_delayed, CASE WHEN rn <= goal THEN 'test' ELSE 'train' END AS split
FROM (SELECT flight_number, is_delayed, row_number() OVER (PARTITION BY is_delayed
    ORDER BY md5(CAST(flight_number AS VARCHAR)), flight_number) AS rn FROM scores)
JOIN (SELECT is_delayed, round(count(*) * 0.2) AS goal FROM scores GROUP BY 1) USING (is_delayed)
"""))
def stratified_split(spark, sf):
    rows = stored(base.scores(spark, sf).select("flight_number", "is_delayed"), "scores")
    return risk.stratified_split(rows, "is_delayed", "flight_number")


@query("class_weights", with_tables("scores", body="""
SELECT is_delayed, count(*) AS n, round((SELECT count(*) FROM scores) / (2.0 * count(*)), 9)::DOUBLE
  AS weight FROM scores GROUP BY 1"""))
def class_weights(spark, sf):
    return rounded(risk.class_weights(base.scores(spark, sf)), "weight")


@query("standardised_features", with_tables(recursive=True, extra=FEATURES, body="""
SELECT flight_id, """ + ", ".join(
    f'round(coalesce((f."{c}" - (SELECT avg("{c}") FROM feat)) '
    f'/ nullif((SELECT stddev_pop("{c}") FROM feat), 0), 0), 6) AS "{c}"'
    for c in S.FEATURE_COLUMNS) + " FROM feat f"))
def standardised_features(spark, sf):
    out = risk.standardise(frame(spark, sf), S.FEATURE_COLUMNS)
    return rounded(out.select("flight_id", *S.FEATURE_COLUMNS), *S.FEATURE_COLUMNS, digits=6)


@query("confusion_matrix", with_tables("scores", body="""
SELECT CAST(is_delayed AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction,
  count(*) AS n FROM scores GROUP BY 1, 2"""))
def confusion_matrix(spark, sf):
    return risk.confusion(base.scores(spark, sf))


CURVE = {"curve": (["scores"], """SELECT risk_score AS score,
      sum(is_delayed)::BIGINT AS pos, sum(1 - is_delayed)::BIGINT AS neg,
      sum(sum(is_delayed)) OVER w::BIGINT AS running_pos,
      sum(sum(1 - is_delayed)) OVER w::BIGINT AS running_neg
    FROM scores GROUP BY 1 WINDOW w AS (ORDER BY risk_score DESC)""".replace(
        "OVER w::BIGINT", "OVER w"))}


@query("roc_curve", with_tables("scores", extra=CURVE, body="""
SELECT round(score, 9) AS score, pos, neg, CAST(running_pos AS BIGINT) AS running_pos,
  CAST(running_neg AS BIGINT) AS running_neg,
  round(CAST(running_pos / (SELECT sum(pos) FROM curve) AS DOUBLE), 9) AS tpr,
  round(CAST(running_neg / (SELECT sum(neg) FROM curve) AS DOUBLE), 9) AS fpr FROM curve"""))
def roc_curve(spark, sf):
    return rounded(risk.roc(base.scores(spark, sf)), "score", "tpr", "fpr")


@query("binary_metrics", with_tables("scores", extra=CURVE, body="""
SELECT round(count(*) FILTER (WHERE is_delayed = prediction) / count(*), 9) AS accuracy,
  round(2 * sum(is_delayed * prediction) / (sum(is_delayed) + sum(prediction)), 9)::DOUBLE AS f1,
  (SELECT round(CAST(sum(neg * (running_pos - pos / 2.0)) / (sum(pos) * sum(neg)) AS DOUBLE), 9)
   FROM curve) AS auc FROM scores"""))
def binary_metrics(spark, sf):
    return rounded(risk.binary_metrics(base.scores(spark, sf)), "accuracy", "f1", "auc")


def _class_row(value, name):
    y, p = f"is_delayed = {value}", f"prediction = {value}"
    return (f"SELECT '{name}' AS class, count(*) FILTER (WHERE {y} AND {p}) "
            f"/ count(*) FILTER (WHERE {p}) AS precision, count(*) FILTER (WHERE {y} AND {p}) "
            f"/ count(*) FILTER (WHERE {y}) AS recall, 2 * count(*) FILTER (WHERE {y} AND {p}) "
            f"/ (count(*) FILTER (WHERE {p}) + count(*) FILTER (WHERE {y})) AS f1, "
            f"count(*) FILTER (WHERE {y}) AS support FROM scores")


@query("classification_report", with_tables("scores", extra={"pc": (["scores"],
    _class_row(0, "On-time") + " UNION ALL " + _class_row(1, "Delayed >15min"))}, body="""
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  support FROM (SELECT * FROM pc
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT)
  FROM pc
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
    CAST(sum(support) AS BIGINT) FROM pc)"""))
def classification_report(spark, sf):
    return rounded(risk.class_report(base.scores(spark, sf)), "precision", "recall", "f1")


@query("mean_absolute_error", with_tables("scores", body="""
SELECT round(avg(abs(dep_delay_minutes - risk_score * 100)), 7) AS mae FROM scores"""))
def mean_absolute_error(spark, sf):
    s = base.scores(spark, sf).withColumn("guess", F.col("risk_score") * 100)
    return rounded(risk.mean_absolute_error(s, "dep_delay_minutes", "guess"), "mae", digits=7)


# --- scenarios: every scored flight is taken as one form ---------------------------------

GIVEN = ["flight_month", "day_of_week", "scheduled_dep_hour", "temperature_c", "wind_speed_knots"]
HUB_COLUMNS = ["origin_pagerank", "origin_betweenness", "dest_pagerank", "dest_betweenness"]


def _form_column(c):
    middle = f"(SELECT median FROM med WHERE feature = '{c}')"
    if c == "Distance":
        return f"coalesce(miles, {middle}) AS \"Distance\""
    if c in HUB_COLUMNS:
        side, measure = c.split("_")
        return f"coalesce({'ho' if side == 'origin' else 'hd'}.{measure}, 0) AS {c}"
    given = f"CAST(s.{c} AS DOUBLE), " if c in GIVEN else ""
    return f"coalesce({given}{middle}, 0) AS {c}"


FORM = {**FEATURES, "med": (["feat"], " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, quantile_cont("{c}", 0.5) AS median FROM feat"""
    for c in S.FEATURE_COLUMNS)),
    "miles": (["scores", "airports"], """SELECT s.*, 2 * 3958.8 * asin(sqrt(
        pow(sin(radians(d.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(d.lat))
          * pow(sin(radians(d.lon - o.lon) / 2), 2))) AS miles
      FROM scores s LEFT JOIN airports o ON s."Origin" = o.airport
        LEFT JOIN airports d ON s."Dest" = d.airport"""),
    "form": (["miles", "hubs", "med"], f"""
      SELECT flight_number AS scenario, s."Origin", s."Dest",
        {', '.join(map(_form_column, S.FEATURE_COLUMNS))}
      FROM miles s LEFT JOIN hubs ho ON s."Origin" = ho.airport
        LEFT JOIN hubs hd ON s."Dest" = hd.airport""")}


def _forms(spark, sf):
    medians = cut(quantiles.medians(frame(spark, sf), S.FEATURE_COLUMNS))
    forms = base.scores(spark, sf).select(F.col("flight_number").alias("scenario"), "Origin", "Dest",
                                          *GIVEN)
    return risk.complete_features(forms, medians, hubs(spark, sf), base.airports(spark, sf)), medians


@query("completed_scenarios", with_tables(recursive=True, extra=FORM, body="""
SELECT scenario, "Origin", "Dest", """ + ", ".join(
    f'round("{c}", 6) AS "{c}"' for c in S.FEATURE_COLUMNS) + " FROM form"))
def completed_scenarios(spark, sf):
    full, _ = _forms(spark, sf)
    return rounded(full, *S.FEATURE_COLUMNS, digits=6)


#: Made-up importances, one per feature.
WEIGHTS = {c: (i * 7 % 19 + 1) / 200 for i, c in enumerate(S.FEATURE_COLUMNS)}


@query("scenario_drivers", with_tables(recursive=True, extra={**FORM, "long": (["form", "med"],
    " UNION ALL ".join(f"""SELECT scenario, '{c}' AS feature, "{c}" AS value,
      {w}::DOUBLE AS importance, (SELECT median FROM med WHERE feature = '{c}') AS median FROM form"""
                       for c, w in WEIGHTS.items()))}, body="""
SELECT scenario, feature, round(value, 6) AS value, importance, round(median, 6) AS median,
  round(contribution, 6) AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY abs(contribution) DESC, feature) AS rn
  FROM (SELECT *, (value - median) / greatest(abs(median), 1) * importance AS contribution
    FROM long)) WHERE rn <= 10"""))
def scenario_drivers(spark, sf):
    full, medians = _forms(spark, sf)
    weights = spark.createDataFrame(list(WEIGHTS.items()), "feature string, importance double")
    return rounded(risk.drivers(full, medians, weights, 10), "value", "median", "contribution",
                   digits=6)


# --- models ----------------------------------------------------------------------------

def _parts(spark, sf):
    split = base.once(spark, sf, "split", lambda: risk.stratified_split(
        frame(spark, sf), "is_delayed", "flight_id"))
    return split.where("split = 'train'"), split.where("split = 'test'"), split


@query("feature_vectors", with_tables(recursive=True, extra=FEATURES, body="SELECT flight_id, "
       + ", ".join(f'round("{c}", 6) AS f{i}' for i, c in enumerate(S.FEATURE_COLUMNS))
       + ", CAST(is_delayed AS INTEGER) AS is_delayed FROM feat"))
def feature_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array
    out = scoring.assembler().transform(frame(spark, sf)).withColumn(
        "v", vector_to_array("features"))
    return out.select("flight_id", *[F.round(F.col("v")[i], 6).alias(f"f{i}")
                                     for i in range(len(S.FEATURE_COLUMNS))],
                      F.col("is_delayed").cast("int").alias("is_delayed"))


def _model(spark, sf, kind):
    """One fitted model of each kind per session and data set, saved and loaded by path."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITTED:
        path = scratch(spark, f"model-{kind}")
        scoring.save_model(scoring.train(_parts(spark, sf)[0], kind, SIZES), spark, path)
        _FITTED[key] = path
    return scoring.load_model(spark, _FITTED[key])


_FITTED = {}


def _share(c):
    return F.col(c).isNotNull() & (F.col(c) >= 0) & (F.col(c) <= 1)


# The algorithms are not SQL, so these queries return facts about every row that SQL can state.

@query("model_comparison", """
SELECT model, TRUE AS accuracy_is_share, TRUE AS f1_is_share, TRUE AS auc_is_share,
  CAST(1 AS BIGINT) AS best_models, TRUE AS best_has_highest_auc,
  model <> 'Gradient Boosting' AS separates_learnt_rows
FROM (VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) v(model)""")
def model_comparison(spark, sf):
    """Metrics on test rows; the models that do not stop early also separate the rows they learnt."""
    fit, test, _ = _parts(spark, sf)
    models = {n: _model(spark, sf, k) for n, k in scoring.CLASSIFIERS.items()}
    learnt = scoring.compare(models, scoring.learnt_rows(fit, SIZES)).select(
        "model", ((F.col("auc") > 0.5) & (F.col("model") != "Gradient Boosting")).alias(
            "separates_learnt_rows"))
    table = cut(scoring.compare(models, test).join(learnt, "model"))
    top = table.agg(F.max("auc")).scalar()
    best = table.agg(F.count_if("best")).scalar()
    return table.select(
        "model", _share("accuracy").alias("accuracy_is_share"), _share("f1").alias("f1_is_share"),
        _share("auc").alias("auc_is_share"), best.alias("best_models"),
        (~F.col("best") | (F.col("auc") == top)).alias("best_has_highest_auc"),
        "separates_learnt_rows")


@query("logistic_conditions", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, TRUE AS gradient_is_zero" for c in ["intercept", *S.FEATURE_COLUMNS]))
def logistic_conditions(spark, sf):
    """First-order conditions of the weighted logistic fit: its gradient on the learnt rows is 0.

    A model with other weights, or none, fails them.
    """
    rows = scoring.learnt_rows(_parts(spark, sf)[0], SIZES)
    scored = risk.standardise(scoring.predict(rows, _model(spark, sf, "logistic")), S.FEATURE_COLUMNS)
    weighted = scored.join(F.broadcast(  # one row per class
        risk.class_weights(rows).select("is_delayed", "weight")), "is_delayed")
    slope = F.col("weight") * (F.col("risk_score") - F.col("is_delayed"))
    sums = weighted.agg(F.avg(slope).alias("intercept"), *[
        F.avg(slope * F.col(c)).alias(c) for c in S.FEATURE_COLUMNS])
    return reshape.melt(sums, [], ["intercept", *S.FEATURE_COLUMNS], "feature", "slope").select(
        "feature", (F.abs("slope") < 1e-4).alias("gradient_is_zero"))


@query("boosting_progress", """
SELECT kind, TRUE AS learnt_loss_falls, TRUE AS ends_at_the_best_round, TRUE AS starts_from_the_mean
FROM (VALUES ('boosted'), ('minutes')) v(kind)""")
def boosting_progress(spark, sf):
    """Loss of the boosted models by round, on learnt and held-back rows."""
    rows = scoring.learnt_rows(_parts(spark, sf)[0], SIZES)
    means = rows.agg(F.avg(F.col("is_delayed").cast("double")).alias("boosted"),
                     F.avg("dep_delay_minutes").alias("minutes")).first()
    out = []
    for kind in scoring.BOOSTED:
        model = _model(spark, sf, kind)
        learnt, held = zip(*model.losses)
        first = 1 / (1 + math.exp(-model.base)) if kind == "boosted" else model.base
        out.append((kind, all(b < a for a, b in zip(learnt, learnt[1:])),
                    held[len(model.trees)] == min(held), abs(first - means[kind]) < 1e-6))
    return spark.createDataFrame(out, "kind string, learnt_loss_falls boolean, "
                                 "ends_at_the_best_round boolean, starts_from_the_mean boolean")


@query("scored_flights", with_tables(recursive=True, extra=FEATURES, body="""
SELECT "Origin", "Dest", CAST(scheduled_dep_hour AS BIGINT) AS scheduled_dep_hour,
  count(*) AS flights, count(*) AS scores_in_range, count(*) AS labels_right,
  CAST(sum(is_delayed) AS BIGINT) AS delayed
FROM feat GROUP BY ALL"""))
def scored_flights(spark, sf):
    """Every flight is scored once, from 0 to 1, with the label of its score."""
    _, _, every = _parts(spark, sf)
    scored = scoring.score_flights(every, _model(spark, sf, "boosted"))
    score = F.col("risk_score")
    label = (F.when(score.isNull() | (score <= 0), "none").when(score <= 0.3, "Low")
             .when(score <= 0.6, "Medium").otherwise("High"))
    return scored.groupBy("Origin", "Dest", F.col("scheduled_dep_hour").cast("long").alias(
        "scheduled_dep_hour")).agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(_share("risk_score")).alias("scores_in_range"),
        F.count_if(F.coalesce("risk_label", F.lit("none")) == label).alias("labels_right"),
        F.sum(F.col("is_delayed").cast("long")).alias("delayed"))


@query("delay_minutes_error", with_tables(recursive=True, extra=FEATURES, body="""
SELECT TRUE AS is_error, TRUE AS near_or_below_the_mean_guess, count(*) AS flights FROM feat"""))
def delay_minutes_error(spark, sf):
    """The regressor is no worse than always guessing the mean, on the flights it learnt from."""
    fit, _, every = _parts(spark, sf)
    guessed = scoring.predict_minutes(fit, _model(spark, sf, "minutes")).withColumn(
        "mean", fit.agg(F.avg("dep_delay_minutes")).scalar())
    mae = risk.mean_absolute_error(guessed, "dep_delay_minutes", "predicted_minutes")
    plain = risk.mean_absolute_error(guessed, "dep_delay_minutes", "mean")
    return mae.select(
        (F.col("mae") >= 0).alias("is_error"),
        (F.col("mae") <= 1.01 * plain.scalar()).alias("near_or_below_the_mean_guess"),
        every.agg(F.count(F.lit(1))).scalar().alias("flights"))


@query("feature_importance", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, TRUE AS not_negative, TRUE AS sum_is_one"
    for c in S.FEATURE_COLUMNS))
def feature_importance(spark, sf):
    table = cut(scoring.importance(spark, _model(spark, sf, "forest")))
    total = table.agg(F.sum("importance")).scalar()
    return table.select("feature", (F.col("importance") >= 0).alias("not_negative"),
                        (F.abs(total - 1) < 1e-9).alias("sum_is_one"))


def _weather_label(c):
    return S.WEATHER_FLAG_LABEL if c == S.WEATHER_FLAG else S.FEATURE_LABELS.get(c, c)


@query("weather_importance", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{_weather_label(c)}' AS label, TRUE AS not_negative, "
    "TRUE AS at_most_the_whole" for c in S.WEATHER_FEATURES))
def weather_importance(spark, sf):
    """The weather features of the importance table, under their labels."""
    table = scoring.weather_importance(scoring.importance(spark, _model(spark, sf, "forest")))
    return table.select("feature", "label", (F.col("importance") >= 0).alias("not_negative"),
                        (F.col("importance") <= 1).alias("at_most_the_whole"))


@query("saved_model_scenarios", with_tables(recursive=True, extra=FEATURES, body="""
SELECT flight_id AS scenario, TRUE AS score_is_share, TRUE AS band_is_right,
  TRUE AS same_as_before_saving FROM feat"""))
def saved_model_scenarios(spark, sf):
    """Save and load the models, and score every flight as a scenario with both."""
    _, _, every = _parts(spark, sf)
    path = scratch(spark, "artifacts")
    medians = cut(quantiles.medians(every, S.FEATURE_COLUMNS))
    models = {k: _model(spark, sf, k) for k in ("boosted", "minutes")}
    scoring.save_artifacts(path, spark, models, medians)
    forms = every.select(F.col("flight_id").alias("scenario"), "Origin", "Dest", "flight_month",
                         "day_of_week", "scheduled_dep_hour", "temperature_c")
    loaded, kept = scoring.load_artifacts(path, spark), scoring.Artifacts(
        models["boosted"], S.FEATURE_COLUMNS, medians, models["minutes"])
    a, b = (scoring.score_scenarios(forms, art, hubs(spark, sf), base.airports(spark, sf))
            for art in (loaded, kept))
    other = b.select("scenario", F.col("risk_score").alias("score_b"),
                     F.col("predicted_minutes").alias("minutes_b"))
    return a.join(other, "scenario").select(
        "scenario", _share("risk_score").alias("score_is_share"),
        (F.col("band") == C.risk_band("risk_score")).alias("band_is_right"),
        ((F.col("risk_score") == F.col("score_b"))
         & (F.col("predicted_minutes") == F.col("minutes_b"))).alias("same_as_before_saving"))


@query("training_run", with_tables(recursive=True, extra=FEATURES, body="""
SELECT name, CASE name WHEN 'scored' THEN (SELECT count(*) FROM feat)
  WHEN 'centrality' THEN (SELECT count(*) FROM nodes) WHEN 'medians' THEN 19
  WHEN 'importance' THEN 19 WHEN 'comparison' THEN 3 WHEN 'mae' THEN 1 END AS n
FROM (VALUES ('scored'), ('centrality'), ('medians'), ('importance'), ('comparison'), ('mae')) v(name)"""))
def training_run(spark, sf):
    """The whole job on the fact table and its own network; returns the sizes of its tables."""
    fact = base.once(spark, sf, "fact", lambda: base.fact(spark, sf))
    got = scoring.run_training(fact, SIZES, edges=base.edges(spark, sf))
    names = ["scored", "centrality", "medians", "importance", "comparison", "mae"]
    return reshape.union_all(*[got[n].agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(n).alias("name"), "n") for n in names])
