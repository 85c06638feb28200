"""Tables laid out along a space-filling curve, with Bloom filters for columns that are only looked up.

``write_clustered`` turns each clustering column into a rank of ``2**bits`` equally filled cells,
interleaves the bits of the ranks and range-partitions rows by the result, so that a filter on any of
the columns (or on several) meets few files and row groups. The cell borders are kept next to the
data: ``append_clustered`` adds later rows on the same curve, ``read_clustered`` reads the table.
``row_groups`` reads the footers, by which ``groups_met`` tells what a filter has to read.

NULLs have the lowest rank. Rows of one hot cell are spread over files by a hash of the row.
"""

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from delaylens.operators.running import running_totals
from delaylens.session import cut

BITS = 8


def cell_borders(df: DataFrame, column, bits=BITS) -> DataFrame:
    """One row (column, borders): the smallest value of each of ``2**bits`` cells of about equal rows.

    Distinct values are counted, ranged by Spark and summed range by range, so neither the column nor
    a frequent value has to fit one task. Cells that a frequent value spans have the border of the next.
    """
    cells = 1 << bits
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    ranged = cut(counts.repartitionByRange("value").withColumn("_range", F.spark_partition_id())
                 .withColumn("_all", F.lit(1)))
    upto = running_totals(ranged, ["_all"], F.col("_range"), ["value"], ["n"])
    total = ranged.agg(F.sum("n").alias("total")).scalar()
    cell = F.floor((F.col("running_n") - F.col("n")) * cells / total).cast("int")
    firsts = upto.groupBy(cell.alias("cell")).agg(F.min("value").alias("value"))
    # one row per cell
    later = W.orderBy("cell").rowsBetween(W.currentRow, W.unboundedFollowing)
    every = df.sparkSession.range(cells).select(F.col("id").cast("int").alias("cell"))
    filled = every.join(firsts, "cell", "left").withColumn(
        "value", F.first("value", ignorenulls=True).over(later))
    return filled.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("cell", "value"))), lambda x: x["value"])
        .alias("borders")).select(F.lit(column).alias("column"), "borders")


def rank_of(value, borders, bits=BITS):
    """Last cell whose border is not above ``value``, by bisection; 0 for NULL."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    # borders are missing behind the last value: those comparisons are NULL, hence not taken
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get(borders, low + step) <= value, low + step).otherwise(low))


def interleaved(ranks, bits=BITS):
    """Bits of all ranks in turn, the first rank's highest bit on top."""
    k = len(ranks)
    if k * bits > 63:
        raise ValueError(f"{k} columns of {bits} bits do not fit a long")
    out = F.lit(0).cast("long")
    for b in range(bits):
        for j, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * k + (k - 1 - j)))
    return out


def _write(df, path, columns, borders, bits, files, bloom, options, mode):
    """Borders are ``2**bits`` values per column, so their single row is broadcast."""
    z, spread = "_curve", "_spread"
    if {z, spread, "_borders"} & set(df.columns):
        raise ValueError("columns named _curve, _spread or _borders cannot be laid out")
    wide = borders.select(F.struct(*[F.col(f"`{c}`").alias(f"b{i}") for i, c in enumerate(columns)])
                          .alias("_borders"))
    placed = df.crossJoin(F.broadcast(wide)).withColumns({
        z: interleaved([rank_of(F.col(c), F.col(f"_borders.b{i}"), bits)
                        for i, c in enumerate(columns)], bits),
        spread: F.xxhash64(*df.columns)}).drop("_borders")
    ranged = (placed.repartitionByRange(files, z, spread) if files
              else placed.repartitionByRange(z, spread))
    writer = ranged.sortWithinPartitions(z, spread).drop(z, spread).write.mode(mode)
    for name, rows in dict(bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{name}", str(rows)))
    writer.options(**dict(options or {})).parquet(f"{path}/data")


def write_clustered(df: DataFrame, path, columns, bloom=None, bits=BITS, files=None,
                    options=None) -> DataFrame:
    """Write a table clustered by ``columns``; returns it.

    ``bloom`` maps columns to the distinct values expected in a row group. ``files`` is left to
    Spark's shuffle settings unless given.
    """
    columns = list(columns)
    spark = df.sparkSession
    borders = None
    for column in columns:
        one = cell_borders(df, column, bits).select(F.col("borders").alias(column))
        # single rows side by side
        borders = one if borders is None else borders.crossJoin(one)
    borders.write.mode("overwrite").parquet(f"{path}/borders")
    _write(df, path, columns, spark.read.parquet(f"{path}/borders"), bits, files, bloom, options,
           "overwrite")
    return read_clustered(spark, path)


def append_clustered(df: DataFrame, path, bloom=None, files=None, options=None) -> DataFrame:
    """Add rows on the curve of the stored table; values beyond its borders go to the outer cells."""
    spark = df.sparkSession
    borders = spark.read.parquet(f"{path}/borders")
    bits = (borders.select(F.size(F.col(f"`{borders.columns[0]}`"))).first()[0] - 1).bit_length()
    _write(df, path, borders.columns, borders, bits, files, bloom, options, "append")
    return read_clustered(spark, path)


def read_clustered(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


# --- what a filter meets --------------------------------------------------------------

def row_groups(spark: SparkSession, path, columns) -> DataFrame:
    """(file, row_group, rows, bytes, low_*, high_*) from the footers, limits as text.

    Footers are read by the tasks, by way of Arrow's file systems; no row is read.
    """
    columns = list(columns)
    fields = ["file string, row_group int, rows long, bytes long",
              *[f"`low_{c}` string, `high_{c}` string" for c in columns]]

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            out = []
            for uri in batch["path"]:
                system, name = fs.FileSystem.from_uri(uri)
                with system.open_input_file(name) as source:
                    meta = pq.ParquetFile(source).metadata
                at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    row = [uri, g, group.num_rows, group.total_byte_size]
                    for c in columns:
                        s = group.column(at[c]).statistics
                        known = s is not None and s.has_min_max
                        row += [str(s.min), str(s.max)] if known else [None, None]
                    out.append(row)
            yield pd.DataFrame(out, columns=["file", "row_group", "rows", "bytes", *[
                f"{end}_{c}" for c in columns for end in ("low", "high")]]).astype(object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select("path")
    return files.mapInPandas(footers, ", ".join(fields))


def groups_met(groups: DataFrame, ranges) -> DataFrame:
    """One row: files and row groups that a filter on closed ranges {column: (low, high)} meets, of all.

    Limits are compared as the type of ``low``; a group without limits is met.
    """
    met = F.lit(True)
    for column, (low, high) in ranges.items():
        lowest, highest = F.col(f"low_{column}"), F.col(f"high_{column}")
        if not isinstance(low, str):
            kind = T._infer_type(low).simpleString()
            lowest, highest = lowest.cast(kind), highest.cast(kind)
        met = met & F.coalesce((lowest <= F.lit(high)) & (highest >= F.lit(low)), F.lit(True))
    mine = F.when(met, F.col("file"))
    return groups.agg(
        F.countDistinct(mine).alias("files_met"), F.countDistinct("file").alias("files"),
        F.count_if(met).alias("groups_met"), F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.when(met, F.col("rows"))), F.lit(0)).alias("rows_met"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
