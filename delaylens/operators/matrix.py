"""Airport risk matrix: importance against delay."""

from pyspark.sql import DataFrame, functions as F

from delaylens import schemas as S
from delaylens.session import cut


def risk_matrix(airports: DataFrame) -> DataFrame:
    """Quadrant, label flag and marker size per airport.

    The input has one row per airport (airport, pagerank, delay_rate, count);
    it is checkpointed, as its quantiles come from it too.
    """
    airports = cut(airports)
    marks = {"p50": ("pagerank", 0.5), "d50": ("delay_rate", 0.5), "p80": ("pagerank", 0.80),
             "d92": ("delay_rate", 0.92)}
    levels = airports.agg(F.struct(*[F.percentile(c, F.lit(q)).alias(name)
                                     for name, (c, q) in marks.items()]).alias("_q"))
    known, level = airports.withColumn("_q", levels.scalar()), F.col("_q")
    important = F.col("pagerank") >= level["p50"]
    late = F.col("delay_rate") >= level["d50"]
    quadrant = F.lit(None).cast("string")
    for (hub, slow), name in S.QUADRANTS.items():
        quadrant = F.when((important == hub) & (late == slow), name).otherwise(quadrant)
    placed = known.withColumns({
        "quadrant": quadrant,
        "show_label": (F.col("pagerank") >= level["p80"])
        | (F.col("delay_rate") >= level["d92"])})
    # four rows
    spans = placed.groupBy("quadrant").agg(
        F.percentile("count", F.lit(0.95)).alias("_top"), F.min("count").alias("_low"))
    sized = placed.join(F.broadcast(spans), "quadrant")
    size = 8 + 22 * (F.least("count", "_top") - F.col("_low")) / (F.col("_top") - F.col("_low") + 1)
    return sized.withColumn("size", size).select(*airports.columns, "quadrant", "show_label", "size")
