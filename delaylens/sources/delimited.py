"""Delimited and HTML-table landing files as raw, all-string tables."""

from html import unescape
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from delaylens import schemas as S
from delaylens.operators.reshape import select_existing, union_all

SEPARATORS = [",", "\t", "|", ";"]


def plain_name(name):
    return name.strip().lower()


def snake_name(name):
    return plain_name(name).replace(" ", "_").replace("/", "_")


def _paths(paths):
    return [paths] if isinstance(paths, str) else list(paths)


def separator_for(spark, path) -> str:
    """Separator by suffix; otherwise the most frequent one of the header line."""
    for suffix, sep in ((".csv", ","), (".tsv", "\t")):
        if path.lower().endswith(suffix):
            return sep
    header = spark.read.text(path).limit(1).collect()
    line = header[0][0] if header else ""
    return max(SEPARATORS, key=line.count)


def with_provenance(df: DataFrame, source: str, file_name="_metadata.file_name") -> DataFrame:
    return df.withColumns({
        "source_name": F.lit(source), "source_file": F.col(file_name),
        "ingestion_stage": F.lit(S.RAW_STAGE)})


def read_delimited(spark, paths, preferred, source, name_rule=plain_name, sep=None) -> DataFrame:
    """Rows of all files on the preferred columns that exist, values as text.

    Each path is a file, or a folder or pattern of files with one header; a
    file whose header differs from its neighbours is an error, not a shift.
    """
    frames = []
    for path in _paths(paths):
        df = spark.read.csv(path, header=True, sep=sep or separator_for(spark, path),
                            enforceSchema=False, mode="PERMISSIVE")
        df = with_provenance(df, source)
        added = ["source_name", "source_file", "ingestion_stage"]
        kept = select_existing(df.drop(*added), preferred).columns
        frames.append(df.select(
            *[F.col(f"`{c}`").alias(name_rule(c)) for c in kept], *added))
    return union_all(*frames)


def header_families(spark, path) -> list:
    """(header line, separator, files) of every kind of header in a folder, by one job.

    Only first splits of files are looked at; the driver gets one row per kind of header.
    """
    by_name = F.lower("file")
    sep = F.when(by_name.endswith(".csv"), ",").when(by_name.endswith(".tsv"), "\t")
    firsts = (
        spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"))
        .where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header")))
    kinds = firsts.withColumn("sep", sep).groupBy("header", "sep").agg(
        F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["header"], r["sep"] or max(SEPARATORS, key=r["header"].count),
             [unquote(f) for f in r["files"]]) for r in kinds.orderBy("header", "sep").collect()]


def read_mixed(spark, path, preferred, source, name_rule=plain_name) -> DataFrame:
    """As ``read_delimited``, for a folder whose files differ in header, order and separator.

    Files with one header are read together; columns that a kind of file lacks are NULL.
    """
    frames = [read_delimited(spark, [files], preferred, source, name_rule, sep)
              for _, sep, files in header_families(spark, path)]
    if not frames:
        raise FileNotFoundError(f"no rows in {path}")
    return union_all(*frames)


def read_mixed_flights(spark, path) -> DataFrame:
    return read_mixed(spark, path, S.MANUAL_FLIGHT_COLUMNS, S.FLIGHT_SOURCE)


def read_flights_csv(spark, paths) -> DataFrame:
    return read_delimited(spark, paths, S.MANUAL_FLIGHT_COLUMNS, S.FLIGHT_SOURCE)


def read_airport_ops(spark, paths) -> DataFrame:
    return read_delimited(spark, paths, S.AIRPORT_OPS_COLUMNS, S.AIRPORT_OPS_SOURCE)


def read_facility_counts(spark, paths) -> DataFrame:
    return read_delimited(spark, paths, S.FACILITY_COLUMNS, S.FACILITY_SOURCE, snake_name)


# --- HTML tables -------------------------------------------------------------

_CELL = "struct<_VALUE:string,_colspan:int,_rowspan:int>"
_ROW = f"struct<th:array<{_CELL}>,td:array<string>>"
_TABLE = f"tr array<{_ROW}>, thead struct<tr:array<{_ROW}>>, tbody struct<tr:array<{_ROW}>>"


def _column_names(header_rows):
    """Deepest text of each column from header rows with spans."""
    names, open_spans = {}, {}
    for cells in header_rows:
        at = 0
        for cell in cells:
            while open_spans.get(at, 0) > 0:
                open_spans[at] -= 1
                at += 1
            for _ in range(cell["_colspan"] or 1):
                text = unescape(cell["_VALUE"] or "").strip()
                if text and not text.startswith("Unnamed"):
                    names[at] = text
                open_spans[at] = (cell["_rowspan"] or 1) - 1
                at += 1
    return [names.get(i, f"column_{i}") for i in range(max(names, default=-1) + 1)]


def read_html_rows(spark, paths, preferred=S.FACILITY_COLUMNS, source=S.FACILITY_SOURCE,
                   name_rule=snake_name) -> DataFrame:
    """First table of each well-formed HTML file, header levels flattened.

    Each file is read by its own header. One export file is one spreadsheet, so a
    table fits a row; its rows are spread again right away. Columns without any
    value in all files are dropped. The driver sees each distinct header once.
    """
    tables = spark.read.format("xml").schema(_TABLE).option("rowTag", "table").load(_paths(paths))
    none = F.array().cast(f"array<{_ROW}>")
    rows = F.concat(F.coalesce("thead.tr", none), F.coalesce("tr", none),
                    F.coalesce("tbody.tr", none))
    first = (tables.select(F.col("_metadata.file_path").alias("_path"),
                           F.col("_metadata.file_name").alias("source_file"), rows.alias("rows"),
                           F.monotonically_increasing_id().alias("_seq"))
             .groupBy("_path", "source_file").agg(F.min_by("rows", "_seq").alias("rows")))
    head = F.transform(F.filter("rows", lambda r: F.coalesce(F.size(r["th"]), F.lit(0)) > 0),
                       lambda r: r["th"])
    headed = first.withColumn("_layout", F.to_json(head))
    layouts = {r["_layout"]: _column_names(r["head"]) for r in headed.select(
        "_layout", head.alias("head")).distinct().collect()}
    names = list(dict.fromkeys(n for of_file in layouts.values() for n in of_file))
    # one small row per layout
    known = F.broadcast(spark.createDataFrame(
        list(layouts.items()), "_layout string, _names array<string>"))
    lines = headed.join(known, "_layout").select(
        "source_file", "_names", F.explode("rows").alias("_row"))
    cells = lines.where(F.size("_row.td") > 0).select("source_file", *[
        F.nullif(F.trim(F.get("_row.td", F.array_position("_names", F.lit(n)).cast("int") - 1)),
                 F.lit("")).alias(n) for n in names])
    filled = cells.agg(*[F.count(f"`{n}`").alias(n) for n in names]).first() if names else {}
    kept = [n for n in names if filled[n] > 0]
    kept = [n for n in kept if n in preferred] or kept
    return cells.select(
        *[F.col(f"`{n}`").alias(name_rule(n)) for n in kept], F.lit(source).alias("source_name"),
        "source_file", F.lit(S.RAW_STAGE).alias("ingestion_stage"))
