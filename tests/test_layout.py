"""Clustered tables: the curve, what filters read, later rows and Bloom filters."""

import pytest
from pyspark.sql import functions as F

from delaylens.session import scratch
from delaylens.sources import layout

AIRPORTS, DAYS = 40, 60
SMALL_GROUPS = {"parquet.block.size": "16384", "parquet.page.size": "2048"}


@pytest.fixture(scope="module")
def flights(spark):
    """A third of the flights leave one airport; some dates and airports are NULL."""
    i = F.col("id")
    spun = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    airport = F.when(spun % 3 == 0, 7).otherwise(spun % AIRPORTS)
    return spark.range(40_000).select(
        i, F.when(spun % 101 != 0, F.format_string("A%02d", airport)).alias("origin"),
        F.when(spun % 97 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (i % DAYS).cast("int")))
        .alias("day"), F.concat(F.lit("N"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(5000)) * 2)
        .alias("tail"))


def scanned(df):
    """Rows that the scans of a plan hand on: row groups passed over are not in it."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, seen = [plan], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            seen += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return seen, rows


def test_interleaved_bits(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn(
        "z", layout.interleaved([F.col("a"), F.col("b")], 3)).collect()}
    for a, b in pairs:
        text = "".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}"))
        assert got[a, b] == int(text, 2)
    with pytest.raises(ValueError):
        layout.interleaved([F.lit(1)] * 9, 8)


def test_cells_hold_about_equal_rows(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 500, 5).when(F.col("id") < 990, F.col("id")).alias("v"))
    borders = layout.cell_borders(df, "v", 3).first()["borders"]
    values = sorted([5] * 500 + list(range(500, 990)))
    cells = {}
    for at, v in enumerate(values):
        cells.setdefault(v, at * 8 // len(values))  # cell of the first row with the value
    expected = [min((v for v, c in cells.items() if c >= k), default=None) for k in range(8)]
    assert borders == expected
    probe = spark.createDataFrame([(-3,), (5,), (6,), (499,), (500,), (989,), (5000,), (None,)], "v long")
    array = F.array(*[F.lit(b) for b in borders])
    ranks = [r[0] for r in probe.select(layout.rank_of(F.col("v"), array, 3)).collect()]
    brute = [max((k for k, b in enumerate(expected) if v is not None and b is not None and b <= v),
                 default=0) for v in (-3, 5, 6, 499, 500, 989, 5000, None)]
    assert ranks == brute


def test_filters_read_few_groups(spark, flights):
    plain, curved = scratch(spark, "plain"), scratch(spark, "curved")
    flights.repartition(8, "id").write.options(**SMALL_GROUPS).parquet(plain)
    table = layout.write_clustered(flights, curved, ["origin", "day"], bloom={"tail": 5000}, files=8,
                                   options=SMALL_GROUPS)
    assert sorted(map(tuple, table.collect()), key=str) == sorted(
        map(tuple, flights.collect()), key=str)
    box = {"origin": ("A10", "A12"), "day": ("2024-01-10", "2024-01-16")}

    def met(path, ranges):
        return layout.groups_met(layout.row_groups(spark, path, ["origin", "day"]), ranges).first()

    before, after = met(plain, box), met(f"{curved}/data", box)
    assert before["rows"] == after["rows"] == 40_000
    assert before["rows_met"] == before["rows"] and before["files_met"] == 8
    assert after["groups"] > 20 and after["rows_met"] < 0.25 * after["rows"]
    assert after["files_met"] < after["files"]
    for only in box:  # each column alone also passes groups over
        assert met(f"{curved}/data", {only: box[only]})["rows_met"] < 0.6 * after["rows"]

    wanted = "origin BETWEEN 'A10' AND 'A12' AND day BETWEEN DATE'2024-01-10' AND DATE'2024-01-16'"
    seen, rows = scanned(table.where(wanted))
    assert len(rows) == flights.where(wanted).count() > 0
    # dictionaries and page indexes let Spark pass over more than the limits of row groups tell
    assert len(rows) <= seen <= after["rows_met"]


def test_bloom_filters_pass_groups_over(spark, flights):
    path = scratch(spark, "bloom")
    table = layout.write_clustered(flights, path, ["origin", "day"], bloom={"tail": 5000}, files=4)
    odd = table.where("tail = 'N4321'")  # within the limits of every group, but never there
    seen, rows = scanned(odd)
    assert rows == [] and seen == 0
    some = flights.where("tail IS NOT NULL").first()["tail"]
    seen, rows = scanned(table.where(F.col("tail") == some))
    assert len(rows) == flights.where(F.col("tail") == some).count() and seen > 0


def test_later_rows_follow_the_curve(spark, flights):
    path = scratch(spark, "later")
    layout.write_clustered(flights, path, ["day", "origin"], files=4)
    later = flights.limit(500).withColumn("day", F.lit("2025-05-01").cast("date"))
    table = layout.append_clustered(later, path, files=2)
    assert table.count() == 40_500
    groups = layout.row_groups(spark, f"{path}/data", ["day"])
    met = layout.groups_met(groups, {"day": ("2025-05-01", "2025-05-01")}).first()
    assert met["rows_met"] == 500 and met["files_met"] <= 2


def test_empty_and_constant_tables(spark, flights):
    none = layout.write_clustered(flights.where("false"), scratch(spark, "none"), ["origin", "day"])
    assert none.count() == 0 and none.columns == flights.columns
    same = flights.select("id", F.lit("X").alias("origin"), F.lit(None).cast("date").alias("day"))
    kept = layout.write_clustered(same, scratch(spark, "same"), ["origin", "day"], files=4)
    assert kept.count() == 40_000
    sizes = [r["rows"] for r in layout.row_groups(spark, kept.inputFiles()[0].rsplit("/", 1)[0], []
                                                  ).groupBy("file").agg(F.sum("rows").alias("rows"))
             .collect()]
    assert len(sizes) == 4 and max(sizes) < 15_000  # one hot cell is spread over the files
    with pytest.raises(ValueError):
        layout.write_clustered(same.withColumnRenamed("id", "_curve"), scratch(spark, "no"), ["origin"])
