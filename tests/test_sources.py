"""Landing files, tables and streams in temporary folders."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from delaylens import schemas as S
from delaylens.plans import staging
from delaylens.session import scratch, shared_dir
from delaylens.sources import archives, delimited, tables, weather
from delaylens.streaming import feeds


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_delimited_files_with_differing_columns(spark, tmp_path):
    a = write(tmp_path / "a.csv", "FL_DATE,ORIGIN,EXTRA\n2024-01-01,ATL,x\n")
    b = write(tmp_path / "b.txt", "FL_DATE\tDEST\n2024-01-02\tLAX\n")
    rows = {r["source_file"]: r for r in delimited.read_flights_csv(spark, [a, b]).collect()}
    assert rows["a.csv"]["origin"] == "ATL" and rows["a.csv"]["dest"] is None
    assert rows["b.txt"]["dest"] == "LAX" and rows["b.txt"]["source_name"] == "bts"
    assert "extra" not in rows["a.csv"].asDict()


def test_unknown_columns_are_all_kept(spark, tmp_path):
    path = write(tmp_path / "c.csv", " One , Two\n1,2\n")
    row = delimited.read_facility_counts(spark, path).first().asDict()
    assert row["one"] == "1" and row["source_name"] == "opsnet"


def test_mixed_headers_in_one_folder_are_an_error(spark, tmp_path):
    write(tmp_path / "f" / "a.csv", "FL_DATE,ORIGIN\n2024-01-01,ATL\n")
    write(tmp_path / "f" / "b.csv", "ORIGIN,FL_DATE\nATL,2024-01-01\n")
    with pytest.raises(Exception):
        delimited.read_flights_csv(spark, str(tmp_path / "f")).collect()


def test_a_folder_of_several_layouts(spark, tmp_path):
    folder = tmp_path / "mixed folder"
    write(folder / "a b.csv", "FL_DATE,ORIGIN,EXTRA\n2024-01-01,ATL,x\n2024-01-02,ATL,y\n")
    write(folder / "b.csv", "ORIGIN,FL_DATE\nLAX,2024-01-03\n")
    write(folder / "c.txt", "ORIGIN;FL_DATE\nSFO;2024-01-04\n")
    write(folder / "d.tsv", "FL_DATE\tDEST\n2024-01-05\tDEN\n")
    write(folder / "e.csv", "odd,other\n1,2\n")
    write(folder / "f.csv", "FL_DATE,ORIGIN,EXTRA\n2024-01-06,JFK,z\n")
    write(folder / "empty.csv", "")
    kinds = delimited.header_families(spark, str(folder))
    assert len(kinds) == 5 and sorted(len(files) for *_, files in kinds) == [1, 1, 1, 1, 2]
    rows = {(r["fl_date"], r["origin"], r["dest"], r["odd"], r["source_file"])
            for r in delimited.read_mixed_flights(spark, str(folder)).collect()}
    assert {r[:4] for r in rows} == {
        ("2024-01-01", "ATL", None, None), ("2024-01-02", "ATL", None, None),
        ("2024-01-03", "LAX", None, None), ("2024-01-04", "SFO", None, None),
        ("2024-01-05", None, "DEN", None), ("2024-01-06", "JFK", None, None), (None, None, None, "1")}


def test_facility_names(spark, tmp_path):
    path = write(tmp_path / "d.csv", "Date,Service Area,Local Hour\n2024,East,5\n")
    assert delimited.read_facility_counts(spark, path).columns[:3] == [
        "date", "service_area", "local_hour"]


def test_html_table(spark, tmp_path):
    path = write(tmp_path / "x.xls", """<html><body><table>
      <tr><th rowspan="3">Date</th><th colspan="2">Ops</th><th></th></tr>
      <tr><th colspan="2">Count</th><th></th></tr>
      <tr><th>Total Operations</th><th>Delay Count</th><th></th></tr>
      <tr><td>2024-01-01</td><td>10</td><td></td><td></td></tr>
      <tr><td>2024-01-02</td><td>11</td><td></td><td></td></tr></table>
      <table><tr><td>second table</td></tr></table></body></html>""")
    df = delimited.read_html_rows(spark, path)
    assert df.columns == ["date", "total_operations", "source_name", "source_file",
                          "ingestion_stage"]
    assert sorted((r["date"], r["total_operations"]) for r in df.collect()) == [
        ("2024-01-01", "10"), ("2024-01-02", "11")]


def test_html_files_keep_their_own_headers(spark, tmp_path):
    write(tmp_path / "a.xls", "<table><tr><th>Date</th><th>Airport</th><th>Total Operations</th></tr>"
          "<tr><td>2024-01-01</td><td>ATL</td><td>7</td></tr></table>")
    write(tmp_path / "b.xls", "<table><tr><th>Airport</th><th>Date</th><th>Delay Count</th></tr>"
          "<tr><td>JFK</td><td>2024-01-02</td><td>3</td></tr></table>")
    df = delimited.read_html_rows(spark, str(tmp_path))
    assert sorted((r["date"], r["airport"], r["total_operations"], r["delay_count"])
                  for r in df.collect()) == [
        ("2024-01-01", "ATL", "7", None), ("2024-01-02", "JFK", None, "3")]


def test_zip_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("about.html", "x")
        z.writestr("ONE.CSV", "FlightDate,Origin,Junk\n2024-01-01,ATL,1\n2024-01-02,,2\n")
        z.writestr("two.csv", "FlightDate\n1999-01-01\n")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("about.html", "x")
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    rows, rejects = archives.read_zip_csv(spark, str(tmp_path))
    got = sorted((r["flightdate"], r["origin"], r["dest"]) for r in rows.collect())
    assert got == [("2024-01-01", "ATL", None), ("2024-01-02", None, None)]
    assert sorted((r["archive"].split("/")[-1], r["problem"]) for r in rejects.collect()) == [
        ("broken.zip", "bad archive"), ("empty.zip", "no csv")]


def test_unpacked_flights_can_be_staged_and_reported(spark, tmp_path):
    from delaylens.operators import reports
    head = ("FlightDate,Year,Month,Reporting_Airline,Flight_Number_Reporting_Airline,Tail_Number,"
            "Origin,Dest,CRSDepTime,DepDelay,ArrDelay,Cancelled,CancellationCode,Distance\n")
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("m.csv", head + "2024-01-07,2024,1,AA,12,N1,ATL,LAX,0905,16.00,2.00,0.00,,1947.00\n"
                   "2024-01-07,2024,1,AA,13,N1,ATL,LAX,2359,,,1.00,B,1947.00\n")
    rows, _ = archives.read_zip_csv(spark, str(tmp_path))
    got = {r["flight_number"]: r for r in staging.stage_flights(rows).collect()}
    assert got[12]["flight_id"] == "2024-01-07_AA_12_ATL_905"
    assert (got[12]["scheduled_dep_hour"], got[12]["dep_delay_minutes"]) == (9, 16.0)
    assert got[13]["is_cancelled"] is True and got[13]["weather_delay_mins"] == 0
    hours = reports.delay_by_hour(rows).collect()
    assert [(r["hour"], r["delay_rate"], r["n"]) for r in hours] == [(9, 1.0, 1)]


def test_hourly_arrays(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps({"airport_code": "ATL", "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None]}}))
    write(tmp_path / "b.json", json.dumps({"airport_code": "LAX"}))
    docs = weather.read_json(spark, str(tmp_path), S.ARCHIVE_SCHEMA)
    rows = weather.explode_hourly(docs).orderBy("time").collect()
    assert [(r["airport_code"], r["temperature_2m"], r["cloud_cover"]) for r in rows] == [
        ("ATL", 1.5, None), ("ATL", None, None)]
    assert [r[0] for r in weather.without_hours(docs).collect()] == ["LAX"]


def test_station_reports(spark, tmp_path):
    path = write(tmp_path / "m.json", json.dumps([
        {"icaoId": "KATL", "wdir": 270, "visib": 10, "temp": 3}, {"icaoId": "EGLL", "wdir": "VRB"}]))
    rows = weather.flatten_observations(
        weather.read_json(spark, path, S.OBSERVATION_SCHEMA)).collect()
    assert len(rows[0]) == 21
    assert {(r["iata_code"], r["wind_dir_deg"], r["visibility_sm"]) for r in rows} == {
        ("ATL", "270", "10"), ("EGLL", "VRB", None)}


def test_forecast_periods(spark, tmp_path):
    path = write(tmp_path / "t.json", json.dumps([
        {"icaoId": "KATL", "fcsts": [{"timeFrom": 100, "visib": "6+"}, {"timeFrom": "soon"}]},
        {"icaoId": "KLAX"}, {"icaoId": "KDEN", "fcsts": []}]))
    rows = weather.flatten_forecasts(weather.read_json(spark, path, S.FORECAST_SCHEMA)).collect()
    assert len(rows[0]) == 18
    assert sorted((r["iata_code"], r["valid_from"] or -1, r["visibility_sm"] or "") for r in rows
                  ) == [("ATL", -1, ""), ("ATL", 100, "6+"), ("LAX", -1, "")]


# --- tables ------------------------------------------------------------------------

def test_write_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    tables.write_table(df, path, "truncate")
    tables.write_table(df, path, "APPEND")
    assert spark.read.parquet(path).count() == 6
    tables.write_table(df, path, "TRUNCATE")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        tables.write_table(df, path, "merge")
    row = tables.describe_table(df).first()
    assert (row["column_name"], row["column_type"], row["row_count"]) == ("id", "bigint", 3)


def test_load_csv(spark, tmp_path):
    path = write(tmp_path / "in.csv", "a,b\n1,x\n")
    out = tables.load_csv(spark, path, str(tmp_path / "t"))
    assert {(r["column_name"], r["column_type"]) for r in out.collect()} == {
        ("a", "int"), ("b", "string")}
    with pytest.raises(FileNotFoundError):
        tables.load_csv(spark, str(tmp_path / "none.csv"), str(tmp_path / "t"))


def test_months(spark, tmp_path):
    wanted = tables.months_between(spark, "2022-11-15", "2023-02-01")
    assert [tuple(r) for r in wanted.orderBy("year", "month").collect()] == [
        (2022, 11), (2022, 12), (2023, 1), (2023, 2)]
    rows = spark.createDataFrame([("2022", "12", 1), ("2023", "2", 2), ("2030", "1", 3)],
                                 "year string, month string, v int")
    path = str(tmp_path / "t")
    failed = tables.backfill(rows, path, "2022-11-15", "2023-02-01")
    assert sorted(tuple(r) for r in failed.collect()) == [(2022, 11), (2023, 1)]
    assert spark.read.parquet(path).count() == 2
    more = spark.createDataFrame([(2023, 1, 9)], "year int, month int, v int")
    assert tables.load_month(more, path, 2023, 1) == "loaded"
    assert tables.load_month(more, path, 2023, 1) == "already loaded"
    assert tables.load_month(more, path, 2024, 1) == "not published"
    assert spark.read.parquet(path).count() == 3


def test_load_day_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01T05:00", "2024-01-01", "2024-01-01"),
                                  ("2024-01-02T05:00", "2024-01-02", "2024-01-02")],
                                 "time string, extract_start_date string, extract_end_date string")
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.load_day(rows, path, "2024-01-02")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        tables.load_day(rows, path, "2024-05-05")


def test_sample_export(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("FlightDate"), F.lit("x").alias("Junk"),
                                  F.lit("2024-01-01T05:00").alias("Origin"))
    path = str(tmp_path / "s")
    tables.export_sample(df, path, ["FlightDate"], times=["Origin"])
    back = spark.read.csv(path, header=True)
    assert back.count() == 1000 and back.columns == ["FlightDate", "Origin"]
    assert back.first()["Origin"] == "2024-01-01 05:00:00"


def test_scratch_paths_are_new(spark):
    assert scratch(spark, "a") != scratch(spark, "a")
    assert scratch(spark, "a").startswith(shared_dir(spark).rstrip("/"))


# --- streams -----------------------------------------------------------------------

def report(station, minute, temp, seen):
    return {"icaoId": station, "reportTime": f"2024-01-01T05:{minute:02d}:00", "temp": temp,
            "ingested_at": f"2024-01-01T{seen}:00"}


def land(folder, name, rows):
    write(folder / name, "\n".join(json.dumps(r) for r in rows))


def test_polls_are_appended_and_repeats_dropped(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "1.json", [report("KATL", 1, 1.0, "05:05"), report("KLAX", 1, 2.0, "05:05")])
    land(landing, "2.json", [])
    args = (str(landing), str(tmp_path / "all"), str(tmp_path / "c1"))
    feeds.ingest_observations(spark, *args).awaitTermination()
    land(landing, "3.json", [report("KATL", 1, 1.0, "05:35"), report("KATL", 31, 3.0, "05:35")])
    feeds.ingest_observations(spark, *args).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    feeds.ingest_distinct(spark, str(landing), str(tmp_path / "once"),
                          str(tmp_path / "c2")).awaitTermination()
    once = spark.read.parquet(str(tmp_path / "once"))
    assert sorted((r["icao_id"], r["obs_time"][14:16]) for r in once.collect()) == [
        ("KATL", "01"), ("KATL", "31"), ("KLAX", "01")]


def test_late_reports_are_kept_in_any_order_of_batches(spark, tmp_path):
    landing = tmp_path / "in"

    def run():
        feeds.ingest_distinct(spark, str(landing), str(tmp_path / "once"), str(tmp_path / "c"),
                              files_per_batch=1).awaitTermination()

    days = ["2024-01-10", "2024-01-05", "2024-01-01"]
    for k, day in enumerate(days):
        rows = [dict(report("KATL", 1, 1.0, "05:05"), reportTime=f"{day}T05:01:00")]
        land(landing, f"{k}.json", rows + rows)
        run()
    land(landing, "again.json", [dict(report("KATL", 1, 1.0, "05:05"), reportTime=f"{d}T05:01:00")
                                 for d in days])
    run()
    got = spark.read.parquet(str(tmp_path / "once")).collect()
    assert sorted(r["obs_time"][:10] for r in got) == sorted(days)


def test_latest_state_over_several_runs(spark, tmp_path):
    landing, state = tmp_path / "in", str(tmp_path / "state")

    def run():
        feeds.latest_state(feeds.observations(spark, str(landing)), state,
                           str(tmp_path / "c")).awaitTermination()
        return {r["iata_code"]: r["temp_c"] for r in feeds.read_state(spark, state).collect()}

    land(landing, "1.json", [report("KATL", 1, 1.0, "05:05"), report("KLAX", 1, 2.0, "05:05")])
    assert run() == {"ATL": 1.0, "LAX": 2.0}
    land(landing, "2.json", [report("KATL", 31, 9.0, "05:35"), report("KDEN", 2, 4.0, "05:35")])
    assert run() == {"ATL": 9.0, "LAX": 2.0, "DEN": 4.0}
    assert run() == {"ATL": 9.0, "LAX": 2.0, "DEN": 4.0}


def test_better_reports_replace_worse_ones(spark, tmp_path):
    table = str(tmp_path / "hours")
    archive = spark.createDataFrame(
        [("ATL", "2024-01-01T05:00", 1.0, 0.5, 9.0, 80, 40), ("ATL", "2024-01-02T05:00", 2.0, 0.5,
                                                              9.0, 80, 40)],
        "airport_code string, time string, temperature_2m double, precipitation double, "
        "wind_speed_10m double, cloud_cover long, cloud_cover_low long")
    feeds.upsert_airport_hours(staging.archive_hours(archive), table)
    seen = spark.createDataFrame([("ATL", "2024-01-01T05:40:00", 7.0, 3.0, "2024-01-01T06:00:00")],
                                 "iata_code string, obs_time string, temp_c double, "
                                 "wind_speed_knots double, ingested_at string")
    for _ in range(2):
        feeds.upsert_airport_hours(staging.observation_hours(seen), table)
    feeds.upsert_airport_hours(staging.archive_hours(archive), table)  # late and worse
    got = {r["date_id"]: (r["temperature_c"], r["weather_source"])
           for r in spark.read.parquet(table).collect()}
    assert got == {dt.date(2024, 1, 1): (7.0, "metar"), dt.date(2024, 1, 2): (2.0, "openmeteo")}


def test_reports_without_a_readable_time_are_kept_once(spark, tmp_path):
    table = str(tmp_path / "once")
    schema = "icao_id string, obs_time string, temp_c double"
    odd = [("A", None, 1.0), ("A", None, 2.0), ("A", "unreadable", 3.0), (None, None, 4.0)]
    dated = [("A", "2024-01-01 10:00:00", 5.0), (None, "2024-01-01 10:00:00", 6.0)]
    for part in (odd[:2], odd, odd + dated, dated + odd):
        feeds.add_distinct(spark.createDataFrame(part, schema), table)
    got = spark.read.parquet(table).collect()
    assert len(got) == 5
    assert {(r.icao_id, r.obs_time) for r in got} == {r[:2] for r in odd + dated}
    assert sum(r.report_day is None for r in got) == 3
