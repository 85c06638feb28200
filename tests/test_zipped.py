"""ZIP archives as a data source: members, odd records, bad archives, and the stream of new ones."""

import zipfile

import pytest

from delaylens.sources import archives, zipped

COLUMNS = ["FlightDate", "Origin", "Dest", "CRSDepTime", "DepDelay"]


def pack(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "."), text)


@pytest.fixture
def folder(tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    pack(land / "a.zip", readme__html="about", one__csv=(
        'FlightDate,Origin,Dest,CRSDepTime,DepDelay\r\n2024-01-01,ATL,"L,A""X",0905,5\r\n\r\n'
        '2024-01-02,JFK,"two\nlines",1200,\r\n'),
        two__CSV="Junk,Origin,FlightDate\nx,ORD,2024-01-03\n")
    pack(land / "empty.zip", readme__html="about")
    pack(land / "header.zip", none__csv="FlightDate,Origin\n")
    (land / "broken.zip").write_bytes(b"not a zip")
    (land / "other.txt").write_text("no archive")
    return land


def test_records_keep_quoted_breaks():
    lines = ['a,"b\n', 'c"\n', "\n", 'd,"e ""f"""\n', 'g,"open\n']
    assert list(zipped.records(lines)) == ['a,"b\nc"', 'd,"e ""f"""', 'g,"open']
    assert list(zipped.records([])) == []


def test_every_member_by_its_own_header(spark, folder):
    rows, rejects = zipped.read_zipped(spark, str(folder), COLUMNS)
    got = sorted((r["flightdate"], r["origin"], r["dest"], r["crsdeptime"], r["depdelay"])
                 for r in rows.collect())
    assert got == [("2024-01-01", "ATL", 'L,A"X', 905, 5.0), ("2024-01-02", "JFK", "two\nlines", 1200, None),
                   ("2024-01-03", "ORD", None, None, None)]
    assert set(rows.columns) >= {"source_name", "ingestion_stage"}
    assert sorted(map(tuple, rejects.collect())) == [
        ("broken.zip", "bad archive"), ("empty.zip", "no csv")]


def test_partitions_and_batches(spark, folder):
    parts = zipped.planned(str(folder), zipped.listed(str(folder)))
    assert [(p.archive, p.member, p.problem) for p in parts] == [
        ("a.zip", "one.csv", None), ("a.zip", "two.CSV", None), ("broken.zip", None, "bad archive"),
        ("empty.zip", None, "no csv"), ("header.zip", "none.csv", None)]
    pack(folder / "long.zip", long__csv="Origin\n" + "ATL\n" * 25)
    part = zipped.Member("long.zip", "long.csv")
    sizes = [b.num_rows for b in zipped.member_rows(str(folder), ["Origin"], part, batch_rows=10)]
    assert sizes == [10, 10, 5]
    zipped.register(spark)
    raw = spark.read.format(zipped.FORMAT).option("columns", "Origin").load(str(folder))
    assert raw.rdd.getNumPartitions() == 6


def test_damage_inside_a_member(spark, tmp_path):
    path = tmp_path / "cut.zip"
    pack(path, flights__csv="Origin\n" + "".join(f"A{i * 7919 % 1000}\n" for i in range(3000)))
    body = bytearray(path.read_bytes())
    body[200:260] = bytes(60)
    path.write_bytes(body)
    _, rejects = zipped.read_zipped(spark, str(tmp_path), ["Origin"])
    assert list(map(tuple, rejects.collect())) == [("cut.zip", "bad member")]


def test_agrees_with_whole_archives(spark, tmp_path):
    text = "FlightDate,Origin,Dest,CRSDepTime,DepDelay\n" + "".join(
        f"2024-01-{d:02d},A{d % 7},B{d % 5},{d * 40},{d - 9}.0\n" for d in range(1, 29))
    for k in range(3):
        pack(tmp_path / f"m{k}.zip", flights__csv=text)
    mine, _ = zipped.read_zipped(spark, str(tmp_path), COLUMNS)
    whole, _ = archives.read_zip_csv(spark, str(tmp_path), COLUMNS)
    assert mine.dtypes == whole.dtypes
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, whole.collect()))


def test_empty_folder(spark, tmp_path):
    rows, rejects = zipped.read_zipped(spark, str(tmp_path), COLUMNS)
    assert rows.count() == 0 and rejects.count() == 0


def test_fields(spark):
    import csv
    texts = ["", ",", "a,,b", ',a,"x, ""y""",', '"",""""', "a,b\r", '"line\nbreak",2', "é,ü,"]
    df = spark.createDataFrame([(t,) for t in texts], "record string")
    got = [r[0] for r in df.select(zipped.fields(df.record)).collect()]
    assert got == [(next(csv.reader([t])) or [""]) if "\n" not in t and "\r" not in t else e
                   for t, e in zip(texts, [None] * 5 + [["a", "b\r"], ["line\nbreak", "2"], None])]


def test_stream_takes_each_archive_once(spark, folder, tmp_path):
    table, rejects, log = (str(tmp_path / n) for n in ("table", "rejects", "log"))

    def ingest():
        zipped.ingest_zipped(spark, str(folder), table, rejects, log, COLUMNS)
        return spark.read.parquet(table).count(), spark.read.parquet(rejects).count()

    assert ingest() == (3, 2)
    assert ingest() == (3, 2)  # a restart with nothing new
    # an archive whose name sorts before those already taken
    pack(folder / "Early.zip", one__csv="Origin,FlightDate\nSEA,2023-12-31\nSFO,2023-12-31\n")
    assert ingest() == (5, 2)
    (folder / "later.zip").write_bytes(b"PK nonsense")
    assert ingest() == (5, 3)
    assert spark.read.parquet(table).select("batch").distinct().count() == 2
