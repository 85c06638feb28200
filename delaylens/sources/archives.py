"""Monthly ZIP archives of flight records."""

from pyspark.sql import Column, DataFrame, functions as F

from delaylens import schemas as S


def archive_files(spark, folder) -> DataFrame:
    """(path, content) of every archive in a folder."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
            .select("path", "content"))


def unzip_csv(files: DataFrame, columns=S.FLIGHT_COLUMNS, batch_rows=50_000) -> DataFrame:
    """Rows of the first CSV of each archive, plus one ``problem`` row per unusable archive.

    Archives are unpacked by the tasks that read them and streamed in batches.
    """
    columns = list(columns)

    def unpack(batches):
        import io
        import zipfile

        import pandas as pd

        def problem(path, text):
            row = {c: [None] for c in columns}
            return pd.DataFrame({**row, "archive": [path], "problem": [text]})

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    yield problem(path, "bad archive")
                    continue
                members = [n for n in archive.namelist() if n.lower().endswith(".csv")]
                if not members:
                    yield problem(path, "no csv")
                    continue
                with archive.open(members[0]) as body:
                    for part in pd.read_csv(body, dtype=str, chunksize=batch_rows,
                                            usecols=lambda c: c in columns):
                        part = part.reindex(columns=columns).astype(object)
                        part = part.where(part.notna(), None)
                        yield part.assign(archive=path, problem=None)

    fields = ", ".join(f"`{c}` string" for c in [*columns, "archive", "problem"])
    return files.mapInPandas(unpack, fields)


def typed(name) -> Column:
    """A raw text column under its lower-case name, with its numeric type if it has one.

    Numbers are read as doubles first, so "0905" and "905.00" are both clocks.
    """
    plain = name.strip().lower()
    kind = S.FLIGHT_TYPES.get(plain)
    value = F.col(name) if kind is None else F.col(name).cast("double").cast(kind)
    return value.alias(plain)


def split_archives(unpacked: DataFrame, source=S.FLIGHT_SOURCE):
    """(typed rows with lower-case names and provenance, rejected archives)."""
    data = [c for c in unpacked.columns if c not in ("archive", "problem")]
    rows = unpacked.where(F.col("problem").isNull()).select(
        *[typed(c) for c in data],
        F.lit(source).alias("source_name"), F.lit(S.RAW_STAGE).alias("ingestion_stage"))
    return rows, unpacked.where(F.col("problem").isNotNull()).select("archive", "problem")


def read_zip_csv(spark, folder, columns=S.FLIGHT_COLUMNS):
    return split_archives(unzip_csv(archive_files(spark, folder), columns))
