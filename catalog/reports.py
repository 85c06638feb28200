"""Delay, cancellation and profile reports."""

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from delaylens.functions import columns as C
from delaylens.operators import filters, quantiles, reports, reshape
from delaylens.operators.filters import FilterSpec
from delaylens.session import scratch
from delaylens.sources import profiles

LATE = "count(*) FILTER (WHERE depdelay > 15)"
FLOWN = "cancelled = 0 AND depdelay IS NOT NULL"


def rounded(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _r(expr, name, digits=9):
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {name}"


@query("delay_rate_by_hour", with_tables("ontime", body=f"""
SELECT CAST(floor(crsdeptime / 100) AS BIGINT) AS hour, {_r(LATE + " / count(*)", "delay_rate")},
  count(*) AS n FROM ontime WHERE {FLOWN} AND crsdeptime IS NOT NULL
GROUP BY 1 HAVING CAST(floor(crsdeptime / 100) AS BIGINT) BETWEEN 0 AND 23"""))
def delay_rate_by_hour(spark, sf):
    return rounded(reports.delay_by_hour(base.ontime(spark, sf)), "delay_rate")


@query("filtered_delay_rate_by_hour", with_tables("ontime", body=f"""
SELECT CAST(floor(crsdeptime / 100) AS BIGINT) AS hour, {_r(LATE + " / count(*)", "delay_rate")},
  count(*) AS n FROM ontime WHERE {FLOWN} AND crsdeptime IS NOT NULL
  AND CAST(flightdate AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND month(CAST(flightdate AS DATE)) IN (1, 2) AND reporting_airline IN ('view', 'click')
  AND origin IN ('A01', 'A02', 'A03') GROUP BY 1"""))
def filtered_delay_rate_by_hour(spark, sf):
    spec = FilterSpec([1, 2], ["view", "click"], ["A01", "A02", "A03"],
                      ("2024-01-05", "2024-01-20"))
    return rounded(reports.delay_by_hour(base.ontime(spark, sf), spec), "delay_rate")


@query("flight_kpis", with_tables("ontime", body=f"""
SELECT count(*) AS total_flights, count(*) FILTER (WHERE cancelled = 1) AS cancelled,
  count(*) FILTER (WHERE depdelay > 15 AND cancelled <> 1) AS delayed,
  {_r('''count(*) FILTER (WHERE depdelay > 15 AND cancelled <> 1)
    / count(*) FILTER (WHERE cancelled <> 1)''', "delay_rate")} FROM ontime"""))
def flight_kpis(spark, sf):
    return rounded(reports.kpis(base.ontime(spark, sf)), "delay_rate")


def _ranked(key, name, src, min_n, k):
    return with_tables(src, body=f"""
SELECT {name}, round(rate, 9) AS delay_rate, n FROM (
  SELECT {key} AS {name}, CAST({LATE} / count(*) AS DOUBLE) AS rate, count(*) AS n
  FROM {src} WHERE {FLOWN} GROUP BY 1 HAVING count(*) >= {min_n})
ORDER BY rate DESC, {name} LIMIT {k}""")


@query("delay_rate_by_airline", _ranked("reporting_airline", "airline_code", "legs", 500, 20))
def delay_rate_by_airline(spark, sf):
    return rounded(reports.delay_by_airline(base.legs(spark, sf)), "delay_rate")


@query("delay_rate_by_airport", _ranked("origin", "airport", "legs", 300, 30))
def delay_rate_by_airport(spark, sf):
    return rounded(reports.delay_by_airport(base.legs(spark, sf)), "delay_rate")


@query("top_airports_rising", with_tables("ontime", body=f"""
SELECT airport, round(rate, 9) AS delay_rate, n FROM (
  SELECT origin AS airport, CAST({LATE} / count(*) AS DOUBLE) AS rate, count(*) AS n
  FROM ontime WHERE {FLOWN} GROUP BY 1 HAVING count(*) >= 100)
ORDER BY rate DESC, airport LIMIT 10"""))
def top_airports_rising(spark, sf):
    best = reports.delay_by_airport(base.ontime(spark, sf), min_n=100, k=10)
    return rounded(reshape.top_k(best, "delay_rate", 10, "airport", display_ascending=True),
                   "delay_rate")


@query("monthly_delay_trend", with_tables("legs", body=f"""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  {_r(LATE + " / count(*)", "delay_rate")}, count(*) AS n, strftime(min(d), '%b %Y') AS label
FROM (SELECT *, CAST(flightdate AS DATE) AS d FROM legs) WHERE {FLOWN} GROUP BY 1, 2"""))
def monthly_delay_trend(spark, sf):
    return rounded(reports.monthly_trend(base.legs(spark, sf)), "delay_rate")


@query("delay_minutes_by_cause", with_tables("ontime", body="""
SELECT cause, total_minutes FROM (
  SELECT 'Carrier' AS cause, sum(carrierdelay) AS total_minutes FROM ontime WHERE cancelled <> 1
  UNION ALL SELECT 'Weather', sum(weatherdelay) FROM ontime WHERE cancelled <> 1
  UNION ALL SELECT 'NAS', sum(nasdelay) FROM ontime WHERE cancelled <> 1
  UNION ALL SELECT 'Security', sum(securitydelay) FROM ontime WHERE cancelled <> 1
  UNION ALL SELECT 'Late Aircraft', sum(lateaircraftdelay) FROM ontime WHERE cancelled <> 1)
WHERE total_minutes IS NOT NULL"""))
def delay_minutes_by_cause(spark, sf):
    return reports.delay_causes(base.ontime(spark, sf))


@query("delay_sample", with_tables("ontime", body=f"""
SELECT flight_number_reporting_airline, depdelay FROM ontime
WHERE {FLOWN} AND depdelay BETWEEN -60 AND 180
ORDER BY md5(CAST(flight_number_reporting_airline AS VARCHAR)) LIMIT 2000"""))
def delay_sample(spark, sf):
    return reports.delay_sample(base.ontime(spark, sf), n=2000)


@query("hashed_flight_sample", with_tables("stg_flights", body="""
SELECT flight_id, dep_delay_minutes FROM stg_flights
WHERE ('0x' || substr(md5(flight_id), 1, 8))::BIGINT % 100 < 20"""))
def hashed_flight_sample(spark, sf):
    f = base.stg_flights(spark, sf)
    return f.where(C.hash_bucket("flight_id") < 20).select("flight_id", "dep_delay_minutes")


@query("delay_histogram", with_tables("ontime", body="""
SELECT CAST(CASE WHEN x = 180 THEN 79 ELSE floor((x + 60) / 3.0) END AS BIGINT) AS bin,
  count(*) AS n
FROM (SELECT least(180, greatest(-60, depdelay)) AS x FROM ontime WHERE depdelay IS NOT NULL)
GROUP BY 1"""))
def delay_histogram(spark, sf):
    shown = base.ontime(spark, sf).select(C.clamp("depdelay", -60, 180).alias("depdelay"))
    return reports.histogram(shown, "depdelay", -60, 180, 80)


@query("score_histogram", with_tables("scores", body="""
SELECT CAST(least(floor(risk_score / (1.0::DOUBLE / 70)), 69) AS BIGINT) AS bin, count(*) AS n
FROM scores GROUP BY 1"""))
def score_histogram(spark, sf):
    return reports.histogram(base.scores(spark, sf), "risk_score", 0.0, 1.0, 70)


@query("airline_list", with_tables("legs", body="""
SELECT DISTINCT reporting_airline AS airline FROM legs WHERE reporting_airline IS NOT NULL"""))
def airline_list(spark, sf):
    return reports.airline_list(base.legs(spark, sf))


def _cancel_ranked(key, name, src, min_n, k):
    return with_tables(src, body=f"""
SELECT {name}, cancelled, total, round(rate, 9) AS cancel_rate FROM (
  SELECT {key} AS {name}, count(*) FILTER (WHERE cancelled = 1) AS cancelled, count(*) AS total,
    CAST(count(*) FILTER (WHERE cancelled = 1) / count(*) AS DOUBLE) AS rate
  FROM {src} GROUP BY 1 HAVING count(*) >= {min_n})
ORDER BY rate DESC, {name} LIMIT {k}""")


@query("cancellations_by_airline",
       _cancel_ranked("reporting_airline", "airline_code", "ontime", 500, 20))
def cancellations_by_airline(spark, sf):
    return rounded(reports.cancellations_by_airline(base.ontime(spark, sf)), "cancel_rate")


@query("cancellations_by_airport", _cancel_ranked("origin", "airport", "ontime", 300, 20))
def cancellations_by_airport(spark, sf):
    return rounded(reports.cancellations_by_airport(base.ontime(spark, sf)), "cancel_rate")


@query("cancellation_codes", with_tables("ontime", body="""
SELECT cancellationcode AS code, count(*) AS n FROM ontime
WHERE cancelled = 1 AND cancellationcode IS NOT NULL AND cancellationcode <> '' GROUP BY 1"""))
def cancellation_codes(spark, sf):
    return reports.cancellation_codes(base.ontime(spark, sf))


@query("cancellation_causes_labelled", with_tables("ontime", body="""
SELECT cancellationcode AS code, count(*) AS n,
  CASE cancellationcode WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'NAS / ATC'
    WHEN 'D' THEN 'Security' ELSE cancellationcode END AS label
FROM ontime WHERE cancelled = 1 AND cancellationcode <> '' GROUP BY 1"""))
def cancellation_causes_labelled(spark, sf):
    from delaylens import schemas as S
    from delaylens.operators import joins
    codes = reports.cancellation_codes(base.ontime(spark, sf))
    return joins.with_label(codes, "code", joins.code_table(spark, S.CANCELLATION_LABELS), "label")


@query("cancellation_trend", with_tables("legs", body=f"""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  {_r("count(*) FILTER (WHERE cancelled = 1) / count(*)", "cancel_rate")}, count(*) AS n,
  strftime(min(d), '%b %Y') AS label
FROM (SELECT *, CAST(flightdate AS DATE) AS d FROM legs) GROUP BY 1, 2"""))
def cancellation_trend(spark, sf):
    return rounded(reports.cancellation_trend(base.legs(spark, sf)), "cancel_rate")


@query("delay_rate_by_weekday_hour", with_tables("ontime", body=f"""
SELECT CAST(dayofweek(CAST(flightdate AS DATE)) + 1 AS BIGINT) AS dow,
  CAST(floor(crsdeptime / 100) AS BIGINT) AS hour, {_r(LATE + " / count(*)", "delay_rate")},
  count(*) AS n, strftime(min(CAST(flightdate AS DATE)), '%a') AS dow_label
FROM ontime WHERE {FLOWN} AND crsdeptime IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 30"""))
def delay_rate_by_weekday_hour(spark, sf):
    return rounded(reports.delay_by_dow_hour(base.ontime(spark, sf)), "delay_rate")


HOUR_COLUMNS = ", ".join(
    f'round(avg(delay_rate) FILTER (WHERE hour = {h}), 9) AS "{h}"' for h in range(24))


@query("weekday_hour_matrix", with_tables("ontime", body=f"""
SELECT CAST(position AS INTEGER) AS position, d.dow_label, {HOUR_COLUMNS}
FROM (VALUES (0, 'Mon'), (1, 'Tue'), (2, 'Wed'), (3, 'Thu'), (4, 'Fri'), (5, 'Sat'), (6, 'Sun'))
  d(position, dow_label)
LEFT JOIN (SELECT strftime(CAST(flightdate AS DATE), '%a') AS dow_label,
    CAST(floor(crsdeptime / 100) AS BIGINT) AS hour, {LATE} / count(*) AS delay_rate
  FROM ontime WHERE {FLOWN} AND crsdeptime IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 30) r
  ON d.dow_label = r.dow_label GROUP BY 1, 2"""))
def weekday_hour_matrix(spark, sf):
    m = reports.dow_hour_matrix(reports.delay_by_dow_hour(base.ontime(spark, sf)))
    return rounded(m, *[str(h) for h in range(24)])


def _kpi_body(source):
    return f"""
SELECT CAST(sum(cancelled) AS BIGINT) AS cancelled, CAST(sum(total) AS BIGINT) AS total,
  {_r("sum(cancelled) / sum(total)", "cancel_rate")},
  (SELECT cancellationcode FROM ontime WHERE cancelled = 1 AND cancellationcode <> ''
   GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS top_code
FROM ({source})"""


@query("cancellation_kpi", with_tables("ontime", body=_kpi_body("""
  SELECT count(*) FILTER (WHERE cancelled = 1) AS cancelled, count(*) AS total FROM ontime""")))
def cancellation_kpi(spark, sf):
    return rounded(reports.cancellation_kpi(base.ontime(spark, sf)), "cancel_rate")


@query("cancellation_kpi_of_listed_airlines", with_tables("ontime", body=_kpi_body("""
  SELECT reporting_airline, count(*) FILTER (WHERE cancelled = 1) AS cancelled, count(*) AS total
  FROM ontime GROUP BY 1 HAVING count(*) >= 500
  ORDER BY count(*) FILTER (WHERE cancelled = 1) / count(*) DESC, 1 LIMIT 20""")))
def cancellation_kpi_of_listed_airlines(spark, sf):
    return rounded(reports.cancellation_kpi_listed(base.ontime(spark, sf)), "cancel_rate")


@query("mean_delay_by_weekday", with_tables("ontime", body="""
SELECT CAST(position AS INTEGER) AS position, d.weekday, round(mean_delay, 9) AS mean_delay
FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
  (5, 'Saturday'), (6, 'Sunday')) d(position, weekday)
LEFT JOIN (SELECT strftime(CAST(flightdate AS DATE), '%A') AS weekday, avg(depdelay) AS mean_delay
  FROM ontime GROUP BY 1) r ON d.weekday = r.weekday"""))
def mean_delay_by_weekday(spark, sf):
    return rounded(reports.mean_delay_by_weekday(base.ontime(spark, sf)), "mean_delay")


@query("mean_delay_by_hour", with_tables("ontime", body="""
SELECT CAST(greatest(0, least(23, crsdeptime // 100)) AS BIGINT) AS dep_hour,
  round(avg(depdelay), 9) AS mean_delay FROM ontime GROUP BY 1"""))
def mean_delay_by_hour(spark, sf):
    return rounded(reports.mean_delay_by_hour(base.ontime(spark, sf)), "mean_delay")


PROFILED = [
    "flightdate", "year", "month", "dayofmonth", "reporting_airline",
    "flight_number_reporting_airline", "tail_number", "origin", "dest", "crsdeptime", "deptime",
    "arrtime", "depdelay", "arrdelay", "cancelled", "cancellationcode", "diverted", "distance",
    "carrierdelay", "weatherdelay", "nasdelay", "securitydelay", "lateaircraftdelay"]


@query("missing_values", with_tables("ontime", body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c})) / count(*) * 100, 9) AS missing_pct FROM ontime"
    for c in PROFILED)))
def missing_values(spark, sf):
    return rounded(reports.missing_profile(base.ontime(spark, sf), PROFILED), "missing_pct")


@query("dataset_profile", with_tables("ontime", body="""
SELECT count(*) AS row_count, CAST(23 AS INTEGER) AS column_count, min(flightdate) AS first_date,
  max(flightdate) AS last_date, count(DISTINCT reporting_airline) AS distinct_reporting_airline,
  count(DISTINCT origin) AS distinct_origin, count(DISTINCT dest) AS distinct_dest FROM ontime"""))
def dataset_profile(spark, sf):
    return reports.table_profile(base.ontime(spark, sf), "flightdate",
                                 ["reporting_airline", "origin", "dest"])


@query("delay_summary", with_tables("ontime", body="""
SELECT 'depdelay' AS feature, count(depdelay) AS count, round(avg(depdelay), 9) AS mean,
  round(stddev_samp(depdelay), 6) AS std, min(depdelay) AS min, max(depdelay) AS max,
  round(count(*) FILTER (WHERE depdelay > 15) / count(depdelay), 9) AS share_over_15,
  round(count(*) FILTER (WHERE depdelay > 60) / count(depdelay), 9) AS share_over_60,
  quantile_cont(depdelay, 0.25) AS q25, quantile_cont(depdelay, 0.5) AS q50,
  quantile_cont(depdelay, 0.75) AS q75 FROM ontime"""))
def delay_summary(spark, sf):
    s = reports.numeric_summary(base.ontime(spark, sf), "depdelay")
    s = rounded(s, "mean", "share_over_15", "share_over_60")
    return s.withColumn("std", F.round("std", 6))


@query("outlier_counts", with_tables("legs", body="""
SELECT 'depdelay' AS column_name, count(*) FILTER (WHERE abs(depdelay) > 720) AS extreme,
  round(count(*) FILTER (WHERE abs(depdelay) > 720) / count(*) * 100, 9) AS extreme_pct
FROM legs"""))
def outlier_counts(spark, sf):
    return rounded(reports.outlier_report(base.legs(spark, sf), ["depdelay"]), "extreme_pct")


@query("key_uniqueness", with_tables("legs", body="""
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_keys,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicates,
  round(CAST((sum(n) - count(*)) / sum(n) * 100 AS DOUBLE), 9) AS duplicate_pct
FROM (SELECT count(*) AS n FROM legs
  GROUP BY flight_number_reporting_airline, l_linenumber)"""))
def key_uniqueness(spark, sf):
    return rounded(reports.key_report(
        base.legs(spark, sf), ["flight_number_reporting_airline", "l_linenumber"]),
        "duplicate_pct")


@query("cancellation_summary", with_tables("ontime", body="""
SELECT count(*) AS total, sum(cancelled) AS cancelled, round(avg(cancelled) * 100, 9)
  AS cancel_pct, count(*) FILTER (WHERE cancelled IS NULL OR cancelled <> 1) AS operated
FROM ontime"""))
def cancellation_summary(spark, sf):
    return rounded(reports.cancellation_summary(base.ontime(spark, sf)), "cancel_pct")


@query("operated_split", with_tables("ontime", body="""
SELECT CASE WHEN cancelled = 1 THEN 'cancelled' ELSE 'operated' END AS part, count(*) AS n,
  count(depdelay) AS with_delay FROM ontime GROUP BY 1"""))
def operated_split(spark, sf):
    flown, gone = filters.split_operated(base.ontime(spark, sf))
    count = lambda df, name: df.agg(
        F.count(F.lit(1)).alias("n"), F.count("depdelay").alias("with_delay")).withColumn(
        "part", F.lit(name))
    return count(flown, "operated").unionByName(count(gone, "cancelled"))


# --- scored flights ------------------------------------------------------------

@query("risk_bands", with_tables("scores", body="""
SELECT band, n, round(n / total, 9) AS share FROM (
  SELECT count(*) OVER () AS one, * FROM (
  SELECT 'Low' AS band, count(*) FILTER (WHERE risk_score < 0.3::DOUBLE) AS n, count(*) AS total
  FROM scores
  UNION ALL SELECT 'Medium', count(*) FILTER (WHERE risk_score >= 0.3::DOUBLE
    AND risk_score < 0.6::DOUBLE), count(*) FROM scores
  UNION ALL SELECT 'High', count(*) FILTER (WHERE risk_score >= 0.6::DOUBLE), count(*)
  FROM scores))"""))
def risk_bands(spark, sf):
    return rounded(reports.band_counts(base.scores(spark, sf)), "share")


@query("risk_labels", with_tables("scores", body="""
SELECT risk_label, count(*) AS n FROM scores GROUP BY 1"""))
def risk_labels(spark, sf):
    return base.scores(spark, sf).groupBy("risk_label").agg(F.count(F.lit(1)).alias("n"))


@query("mean_risk_by_origin", with_tables("scores", body="""
SELECT "Origin", round(m, 9) AS avg_risk, n FROM (
  SELECT "Origin", avg(risk_score) AS m, count(*) AS n FROM scores GROUP BY 1
  HAVING count(*) >= 50) ORDER BY m DESC, "Origin" LIMIT 20"""))
def mean_risk_by_origin(spark, sf):
    return rounded(reports.group_mean(base.scores(spark, sf), "Origin", "risk_score", 50, 20,
                                      "avg_risk"), "avg_risk")


@query("mean_risk_by_hour", with_tables("scores", body="""
SELECT scheduled_dep_hour, round(avg(risk_score), 9) AS risk, count(*) AS n
FROM scores GROUP BY 1"""))
def mean_risk_by_hour(spark, sf):
    return rounded(reports.group_mean(base.scores(spark, sf), "scheduled_dep_hour", "risk_score",
                                      out="risk"), "risk")


@query("riskiest_flights", with_tables("scores", body="""
SELECT strftime(flight_date, '%Y-%m-%d') AS flight_date, airline_code, "Origin", "Dest",
  scheduled_dep_hour, round(risk_score, 3) AS risk_score, risk_label, wind_speed_knots
FROM (SELECT * FROM scores ORDER BY risk_score DESC, flight_date, "Origin", "Dest",
  scheduled_dep_hour, airline_code LIMIT 50)"""))
def riskiest_flights(spark, sf):
    return reports.riskiest(base.scores(spark, sf))


def _binned_sql(column, edges, min_n):
    cases = " ".join(f"WHEN {column} <= {float(b)}::DOUBLE THEN {i}"
                     for i, b in enumerate(edges[1:]))
    mids = " ".join(f"WHEN {i} THEN {float(a)}::DOUBLE / 2 + {float(b)}::DOUBLE / 2"
                    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])))
    return with_tables("scores", body=f"""
SELECT CAST(bin AS INTEGER) AS bin, round(avg(is_delayed), 9) AS delay_rate,
  round(avg(risk_score), 9) AS risk, count(*) AS n, round(CASE bin {mids} END, 9) AS mid
FROM (SELECT *, CASE WHEN {column} < {float(edges[0])}::DOUBLE THEN NULL {cases} END AS bin
  FROM scores) WHERE bin IS NOT NULL GROUP BY bin HAVING count(*) >= {min_n}""")


def _register_bins():
    from delaylens import schemas as S
    for column, name in (("wind_speed_knots", "delay_by_wind"),
                         ("precipitation_mm", "delay_by_precipitation"),
                         ("cloud_cover_total_pct", "delay_by_cloud_cover"),
                         ("temperature_c", "delay_by_temperature")):
        edges = S.BIN_EDGES[column]

        def run(spark, sf, column=column):
            return rounded(reports.binned_rate(base.scores(spark, sf), column, min_n=20),
                           "delay_rate", "risk", "mid")
        query(name, _binned_sql(column, edges, 20))(run)


_register_bins()

WIND_COLUMNS = ", ".join(
    f'round(avg(is_delayed) FILTER (WHERE scheduled_dep_hour = {h}), 9) AS "{h}"'
    for h in range(24))


@query("wind_band_by_hour", with_tables("scores", body=f"""
SELECT CASE WHEN wind_speed_knots <= 5 THEN '0-5' WHEN wind_speed_knots <= 10 THEN '5-10'
  WHEN wind_speed_knots <= 15 THEN '10-15' WHEN wind_speed_knots <= 20 THEN '15-20'
  WHEN wind_speed_knots <= 30 THEN '20-30' ELSE '30+' END AS wind_band, {WIND_COLUMNS}
FROM scores WHERE wind_speed_knots BETWEEN 0 AND 60 GROUP BY 1"""))
def wind_band_by_hour(spark, sf):
    return rounded(reports.wind_hour_matrix(base.scores(spark, sf)), *[str(h) for h in range(24)])


@query("class_balance", with_tables("scores", body="""
SELECT is_delayed, count(*) AS n, round(count(*) / (SELECT count(*) FROM scores), 9) AS share
FROM scores GROUP BY 1"""))
def class_balance(spark, sf):
    return rounded(reports.class_balance(base.scores(spark, sf)), "share")


@query("report_delay_by_airline", with_tables("scores", body="""
SELECT airline_code, round(r, 9) AS delay_rate, n FROM (
  SELECT airline_code, avg(is_delayed) AS r, count(*) AS n FROM scores GROUP BY 1
  HAVING count(*) >= 1000) ORDER BY r DESC, airline_code LIMIT 15"""))
def report_delay_by_airline(spark, sf):
    return rounded(reports.report_rates(base.scores(spark, sf), "airline_code", 1000, 15),
                   "delay_rate")


@query("report_delay_by_origin", with_tables("legs", body="""
SELECT "Origin", round(r, 9) AS delay_rate, n FROM (
  SELECT origin AS "Origin", avg(CASE WHEN depdelay > 15 THEN 1 ELSE 0 END) AS r, count(*) AS n
  FROM legs WHERE depdelay IS NOT NULL GROUP BY 1 HAVING count(*) >= 500)
ORDER BY r DESC, "Origin" LIMIT 20"""))
def report_delay_by_origin(spark, sf):
    flown = base.legs(spark, sf).where("depdelay IS NOT NULL").select(
        F.col("origin").alias("Origin"), C.is_delayed("depdelay").alias("is_delayed"))
    return rounded(reports.report_rates(flown, "Origin", 500, 20), "delay_rate")


@query("report_delay_by_hour", with_tables("scores", body="""
SELECT CAST(scheduled_dep_hour AS BIGINT) AS hour, round(avg(is_delayed), 9) AS mean, count(*) AS n
FROM scores GROUP BY 1"""))
def report_delay_by_hour(spark, sf):
    hours = reports.group_mean(base.scores(spark, sf), "scheduled_dep_hour", "is_delayed")
    return rounded(hours.select(F.col("scheduled_dep_hour").cast("long").alias("hour"), "mean", "n"),
                   "mean")


@query("monthly_score_trend", with_tables("scores", body="""
SELECT CAST(date_trunc('month', flight_date) AS DATE) AS month,
  round(avg(is_delayed), 9) AS delay_rate FROM scores GROUP BY 1"""))
def monthly_score_trend(spark, sf):
    return rounded(reports.monthly_score_trend(base.scores(spark, sf)), "delay_rate")


@query("filtered_scores", with_tables("scores", body="""
SELECT risk_label, count(*) AS n, round(avg(risk_score), 9) AS avg_risk FROM scores
WHERE flight_date >= DATE '2024-01-03' AND flight_date < DATE '2024-01-26' AND flight_month = 1
  AND airline_code IN ('view', 'purchase') AND risk_label IN ('Low', 'High') GROUP BY 1"""))
def filtered_scores(spark, sf):
    spec = FilterSpec([1], ["view", "purchase"], None, ("2024-01-03", "2024-01-25"),
                      ["Low", "High"])
    kept = filters.filter_scores(base.scores(spark, sf), spec)
    return rounded(kept.groupBy("risk_label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("risk_score").alias("avg_risk")), "avg_risk")


@query("score_quantiles", with_tables("scores", body=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {p}::DOUBLE AS p, round(quantile_cont({c}, {p}), 9) AS value "
    f"FROM scores"
    for c in ("risk_score", "dep_delay_minutes", "temperature_c", "wind_speed_knots")
    for p in (0.5, 0.8, 0.92, 0.95))))
def score_quantiles(spark, sf):
    return rounded(quantiles.quantiles(
        base.scores(spark, sf),
        ["risk_score", "dep_delay_minutes", "temperature_c", "wind_speed_knots"],
        [0.5, 0.8, 0.92, 0.95]), "value")


# --- profiles from monthly sketches --------------------------------------------------------

def _profiled(spark, sf):
    """A folder with the monthly profile of the multi-year flights, made once."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PROFILED:
        path = scratch(spark, "profiles")
        flights = base.legs(spark, sf).withColumns({
            "year": F.substring("flightdate", 1, 4).cast("int"),
            "month": F.substring("flightdate", 6, 2).cast("int")})
        profiles.update(flights, path, ["depdelay", "cancelled"],
                        ["reporting_airline", "origin", "dest", "l_partkey"])
        _PROFILED[key] = path
    return _PROFILED[key]


_PROFILED = {}
_MONTHLY = """SELECT *, CAST(substr(flightdate, 1, 4) AS INTEGER) AS year,
      CAST(substr(flightdate, 6, 2) AS INTEGER) AS month FROM legs"""
_PROFILE_COLUMNS = {"depdelay": True, "cancelled": True, "reporting_airline": False, "origin": False,
                    "dest": False, "l_partkey": False}


@query("profile_from_sketches", with_tables("legs", extra={"monthly": (["legs"], _MONTHLY), "years": (
    ["monthly"], "SELECT * FROM monthly WHERE year = 1995 OR year = 1996 AND month <= 6")},
    body=" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing,
  count(DISTINCT {c}) AS distinct_values, {f'min({c})' if n else 'NULL'}::DOUBLE AS low,
  {f'max({c})' if n else 'NULL'}::DOUBLE AS high,
  {f'round(avg({c}), 9)' if n else 'NULL'}::DOUBLE AS mean,
  {f'round(stddev_samp({c}), 6)' if n else 'NULL'}::DOUBLE AS std FROM years"""
                            for c, n in _PROFILE_COLUMNS.items())))
def profile_from_sketches(spark, sf):
    """Profile of the months from 1995 to mid-1996, merged from stored monthly rows."""
    out = profiles.summary(spark, _profiled(spark, sf), (1995, 1), (1996, 6))
    return rounded(rounded(out, "mean"), "std", digits=6)


@query("monthly_quantiles_from_sketches", with_tables("legs", extra={"monthly": (["legs"], _MONTHLY)},
       body=" UNION ALL ".join(f"""
SELECT year, month, '{c}' AS column_name, {p}::DOUBLE AS p, quantile_disc({c}, {p}) AS value
FROM monthly GROUP BY year, month HAVING count({c}) > 0"""
                               for c in ("depdelay", "cancelled") for p in (0.25, 0.5, 0.9))))
def monthly_quantiles_from_sketches(spark, sf):
    """Quantiles of every month; months of up to two thousand flights are kept whole."""
    return profiles.quantiles(spark, _profiled(spark, sf), [0.25, 0.5, 0.9], by=["year", "month"])


@query("quantiles_from_merged_sketches", " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, TRUE AS rank_is_right" for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
def quantiles_from_merged_sketches(spark, sf):
    """Quantiles of all years; their ranks among all flights are right to one percent."""
    shares = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = profiles.quantiles(spark, _profiled(spark, sf), shares).where("column_name = 'depdelay'")
    delays = base.legs(spark, sf).where("depdelay IS NOT NULL")
    counts = delays.groupBy("depdelay").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    # five quantiles against the counts of distinct delays
    ranked = F.broadcast(found).join(counts, F.col("depdelay") <= F.col("value"), "left")
    below = ranked.groupBy("p", "value").agg(
        F.sum("n").alias("upto"),
        F.sum(F.when(F.col("depdelay") < F.col("value"), F.col("n")).otherwise(0)).alias("below"))
    return below.select("p", ((F.col("upto") / total >= F.col("p") - 0.01)
                              & (F.col("below") / total <= F.col("p") + 0.01)).alias("rank_is_right"))


@query("value_frequencies_from_sketches", with_tables("legs", body="""
SELECT 'reporting_airline' AS column_name, reporting_airline AS value, count(*) AS n FROM legs
GROUP BY ALL UNION ALL SELECT 'origin', origin, count(*) FROM legs GROUP BY ALL"""))
def value_frequencies_from_sketches(spark, sf):
    """How often each airline and origin occurs; few values, so no two share all their counters."""
    flights = base.legs(spark, sf)
    asked = reshape.union_all(*[flights.select(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                                .distinct() for c in ("reporting_airline", "origin")])
    return profiles.frequencies(spark, _profiled(spark, sf), asked)
