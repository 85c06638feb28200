"""ZIP archives as a Spark data source, in batches and as a stream.

``register`` makes the format ``zipped_csv`` known to a session. Each CSV member of each archive is
one partition, which seeks into the archive and hands on records in batches: neither an archive nor a
member has to fit memory, and no 2 GB limit applies. Rows are (archive, member, places, record,
problem): the text of one record, which may span lines inside quotes, and where its member has each of
the wanted ``columns`` (NULL where it has not). An archive that cannot be read, or has no CSV, is one
row with a ``problem``.

``parsed`` takes the fields out of the records with Spark's own functions: members may differ in
order and number of columns. ``read_zipped`` and ``stream_zipped`` give typed rows and rejected archives.

Paths are opened through Arrow's file systems. As a stream, an offset names the archives in the folder,
so one moved in late is not missed, however old it is or its name sorts; a batch takes all that came
since the last. An archive that changes under its old name is not taken again, one that was removed
and comes back is.
"""

import json

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from delaylens import schemas as S
from delaylens.sources.archives import split_archives

FORMAT = "zipped_csv"
SCHEMA = "archive string, member string, places array<int>, record string, problem string"
BATCH_ROWS = 10_000


class Member(InputPartition):
    """One CSV of an archive, or what is wrong with the archive."""

    def __init__(self, archive, member=None, problem=None):
        self.archive, self.member, self.problem = archive, member, problem


def _file_system(path):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def listed(folder):
    """Names of the archives in a folder, sorted."""
    from pyarrow import fs
    system, base = _file_system(folder)
    found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(f.base_name for f in found
                  if f.type == fs.FileType.File and f.base_name.lower().endswith(".zip"))


def members(folder, name):
    """Partitions of one archive; only its directory is read."""
    import zipfile
    system, base = _file_system(folder)
    try:
        with system.open_input_file(f"{base}/{name}") as body, zipfile.ZipFile(body) as archive:
            found = [m for m in archive.namelist() if m.lower().endswith(".csv")]
    except (zipfile.BadZipFile, EOFError, pa.ArrowInvalid):  # Arrow's word for a seek before the start
        return [Member(name, problem="bad archive")]
    return [Member(name, m) for m in found] or [Member(name, problem="no csv")]


def planned(folder, names):
    """Partitions of many archives; directories are read side by side."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(16) as pool:
        return [p for parts in pool.map(lambda n: members(folder, n), names) for p in parts]


def records(lines):
    """Join lines that a quoted line break has cut; blank lines are left out."""
    held, quotes = [], 0
    for line in lines:
        held.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            text = "".join(held).rstrip("\r\n")
            held, quotes = [], 0
            if text.strip():
                yield text
    if held:
        yield "".join(held).rstrip("\r\n")


def places_of(header, columns):
    """Position of each column in a header line, None if it is missing."""
    import csv
    at = {}
    for i, name in enumerate(next(csv.reader([header]), [])):
        at.setdefault(name.strip(), i)
    return [at.get(c) for c in columns]


def member_rows(folder, columns, part, batch_rows=BATCH_ROWS):
    """Record batches of one partition. Damage found inside a member becomes a problem row."""
    import io
    import zipfile
    import zlib

    kinds = {"archive": pa.string(), "member": pa.string(), "places": pa.list_(pa.int32()),
             "record": pa.string(), "problem": pa.string()}

    def batch(rows, places=None, problem=None):
        n = len(rows)
        values = {"archive": [part.archive] * n, "member": [part.member] * n,
                  "places": [places] * n, "record": rows, "problem": [problem] * n}
        return pa.RecordBatch.from_arrays([pa.array(values[c], k) for c, k in kinds.items()],
                                          names=list(kinds))

    if part.problem is not None:
        yield batch([None], problem=part.problem)
        return
    system, base = _file_system(folder)
    try:
        with (system.open_input_file(f"{base}/{part.archive}") as body,
              zipfile.ZipFile(body) as archive, archive.open(part.member) as raw):
            # line ends stay as they are, so breaks inside quotes survive
            texts = records(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline=""))
            places, rows = places_of(next(texts, ""), columns), []
            for text in texts:
                rows.append(text)
                if len(rows) == batch_rows:
                    yield batch(rows, places)
                    rows = []
            if rows:
                yield batch(rows, places)
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
        yield batch([None], problem="bad member")


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv").option("columns", "A,B").load(folder)``; see the module."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def wanted(self):
        return self.options["path"], self.options["columns"].split(",")

    def reader(self, schema):
        return ZippedReader(*self.wanted())

    def streamReader(self, schema):
        return ZippedStream(*self.wanted())


class ZippedReader(DataSourceReader):
    def __init__(self, folder, columns):
        self.folder, self.columns = folder, columns

    def partitions(self):
        # an empty folder still needs one partition to plan
        return planned(self.folder, listed(self.folder)) or [Member(None)]

    def read(self, partition):
        if partition.archive is not None:
            yield from member_rows(self.folder, self.columns, partition)


class ZippedStream(DataSourceStreamReader):
    def __init__(self, folder, columns):
        self.folder, self.columns = folder, columns

    def initialOffset(self):
        return {"there": "[]"}

    def latestOffset(self):
        return {"there": json.dumps(listed(self.folder))}

    def partitions(self, start, end):
        before, now = (set(json.loads(o["there"])) for o in (start, end))
        return planned(self.folder, sorted(now - before))

    def read(self, partition):
        yield from member_rows(self.folder, self.columns, partition)


def register(spark) -> None:
    spark.dataSource.register(ZippedCsv)


# --- parsing in the JVM -----------------------------------------------------------------

#: A field after its comma: quoted, with doubled quotes inside, or plain.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def fields(record):
    """Fields of one CSV record as an array of texts."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
    return F.transform(found, lambda f: F.when(f.startswith('"'), F.replace(
        f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))


def parsed(raw: DataFrame, columns=S.FLIGHT_COLUMNS) -> DataFrame:
    """Text ``columns``, ``archive`` and ``problem`` of rows read with the same ``columns``.

    Columns that a member lacks and empty fields are NULL.
    """
    split = raw.withColumn("_fields", fields(F.col("record")))

    def value(i, name):
        text = F.get("_fields", F.get("places", F.lit(i)))
        return F.when(text != "", text).alias(name)

    return split.select(*[value(i, c) for i, c in enumerate(columns)], "archive", "problem")


def _usable(rows: DataFrame, columns, source):
    kept, rejected = split_archives(parsed(rows, columns), source)
    return kept, rejected.distinct()


def read_zipped(spark, folder, columns=S.FLIGHT_COLUMNS, source=S.FLIGHT_SOURCE):
    """(typed flights, rejected archives) of all archives in a folder."""
    register(spark)
    return _usable(spark.read.format(FORMAT).option("columns", ",".join(columns)).load(folder),
                   columns, source)


def stream_zipped(spark, folder, columns=S.FLIGHT_COLUMNS) -> DataFrame:
    """Raw rows of archives as they arrive."""
    register(spark)
    return spark.readStream.format(FORMAT).option("columns", ",".join(columns)).load(folder)


def ingest_zipped(spark, folder, table, rejects, checkpoint, columns=S.FLIGHT_COLUMNS,
                  source=S.FLIGHT_SOURCE) -> None:
    """Bring the archives that are new since the last call into ``table``, unusable ones into ``rejects``.

    Batches are written below their number, so one that is repeated after a failure replaces itself.
    """
    def write(batch, number):
        rows, bad = _usable(batch, columns, source)
        for frame, path in ((rows, table), (bad, rejects)):
            frame.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    query = (stream_zipped(spark, folder, columns).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
