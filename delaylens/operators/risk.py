"""Splits, weights, model metrics and driver attribution as DataFrame jobs."""

from pyspark.sql import DataFrame, Window as W, functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators.running import running_totals
from delaylens.session import cut


def _n():
    return F.count(F.lit(1))


def stratified_split(df: DataFrame, label, key, test_share=0.2, salt="") -> DataFrame:
    """Add ``split`` ('train' / 'test') with the exact share of each class.

    Rows are ordered by the hash of the key. A count per (class, hash bucket)
    finds the one bucket per class that holds the border; only its rows are
    ranked, which gives the last test row of the class. The input is then split
    in one pass against those border rows.
    """
    token = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))
    hashed = df.withColumns({"_h": token, "_y": C.group_token(label)})
    coded = hashed.select("_y", "_h", F.col(key).alias("_k")).withColumn(
        "_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    # read several times below; at most 65,536 buckets a class
    sizes = cut(coded.groupBy("_y", "_b").agg(_n().alias("n")))
    running = running_totals(sizes, ["_y"], F.floor(F.col("_b") / 256), ["_b"], ["n"])
    goals = sizes.groupBy("_y").agg(F.round(F.sum("n") * test_share).alias("goal"))
    take = F.col("goal") - F.col("running_n") + F.col("n")
    border = (running.join(goals, "_y").where(F.col("running_n") >= F.col("goal"))
              .groupBy("_y").agg(F.min(F.struct("_b", take.alias("take"))).alias("c"))
              .select("_y", "c._b", "c.take"))
    rank = F.row_number().over(W.partitionBy("_y").orderBy("_h", "_k"))
    # one row per class on both broadcast sides
    last = (coded.join(F.broadcast(border), ["_y", "_b"]).withColumn("_rn", rank)
            .where(F.col("_rn") == F.col("take"))
            .select("_y", F.struct("_h", "_k").alias("_last")))
    tested = F.struct("_h", F.col(key).alias("_k")) <= F.col("_last")
    return hashed.join(F.broadcast(last), "_y", "left").select(
        *df.columns, F.when(tested, "test").otherwise("train").alias("split"))


def class_weights(df: DataFrame, label="is_delayed") -> DataFrame:
    """(label, n, weight) with weight = total / (classes * n)."""
    sizes = df.groupBy(label).agg(_n().alias("n"))
    classes = W.partitionBy(F.lit(1))  # one row per class
    shape = F.sum("n").over(classes) / F.count(F.lit(1)).over(classes)
    return sizes.withColumn("weight", shape / F.col("n"))


def standardise(df: DataFrame, columns) -> DataFrame:
    """(x - mean) / population deviation per column; constant columns become 0."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                              for c in columns]).alias("s"))
    known = df.withColumn("_stats", stats.scalar())
    s = F.col("_stats")
    return known.withColumns({c: F.coalesce(
        F.try_divide(F.col(c) - s[c]["m"], s[c]["s"]), F.lit(0.0)) for c in columns}).drop("_stats")


# --- metrics ------------------------------------------------------------------

def outcome_counts(scored: DataFrame, label="is_delayed", prediction="prediction",
                   score="risk_score") -> DataFrame:
    """(score, label, prediction, n): what every metric needs, made in one pass over the rows."""
    return cut(scored.groupBy(
        F.col(score).alias("score"), F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("prediction")).agg(_n().alias("n")))


def confusion(scored: DataFrame, label="is_delayed", prediction="prediction") -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("label"),
                          F.col(prediction).cast("int").alias("prediction")).agg(_n().alias("n"))


def roc_of(counts: DataFrame) -> DataFrame:
    """The curve from ``outcome_counts``; running counts are taken in ranges of about equally many
    scores, however they cluster.
    """
    by_score = counts.groupBy("score").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("neg"))
    ranged = cut(by_score.repartitionByRange(F.desc("score")).withColumns(
        {"range": F.spark_partition_id(), "all": F.lit(1)}))
    curve = running_totals(ranged, ["all"], F.col("range"), [F.desc("score")], ["pos", "neg"])
    totals = counts.agg(F.struct(
        F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("neg"))).scalar()
    return curve.select(
        "score", "pos", "neg", "running_pos", "running_neg",
        F.try_divide("running_pos", totals["pos"]).alias("tpr"),
        F.try_divide("running_neg", totals["neg"]).alias("fpr"))


def roc(scored: DataFrame, label="is_delayed", score="risk_score") -> DataFrame:
    """(score, tpr, fpr) for every distinct score as threshold, from high to low.

    Equal scores are counted first; the curve never has to fit one task.
    """
    return roc_of(outcome_counts(scored, label, label, score))


def _area(curve):
    """Area under the curve; each tied pair counts one half."""
    area = F.sum(F.col("neg") * (F.col("running_pos") - F.col("pos") / 2))
    return curve.agg(F.try_divide(area, F.sum("pos") * F.sum("neg").cast("double")).alias("auc"))


def auc(scored: DataFrame, label="is_delayed", score="risk_score") -> DataFrame:
    return _area(roc(scored, label, score))


def binary_metrics(scored: DataFrame, label="is_delayed", prediction="prediction",
                   score="risk_score") -> DataFrame:
    """Accuracy, F1 of the positive class and AUC in one row."""
    counts = outcome_counts(scored, label, prediction, score)

    def total(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    y, p = F.col("label") == 1, F.col("prediction") == 1
    row = counts.agg(total(y & p).alias("tp"), total(~y & p).alias("fp"), total(y & ~p).alias("fn"),
                     F.sum("n").alias("n"), total(y == p).alias("hit"))
    return row.select(
        F.try_divide("hit", "n").alias("accuracy"),
        F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                   F.lit(0.0)).alias("f1"),
        _area(roc_of(counts)).scalar().alias("auc"))


def class_report(scored: DataFrame, label="is_delayed", prediction="prediction",
                 names=("On-time", "Delayed >15min")) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages.

    One aggregate over the confusion cells makes one row, which is spread again.
    """
    def total(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    zero = F.lit(0.0)
    sums = []
    for value, name in enumerate(names):
        y, p = F.col("label") == value, F.col("prediction") == value
        tp, called, support = total(y & p), total(p), total(y)
        sums.append(F.struct(
            F.lit(name).alias("class"),
            F.coalesce(F.try_divide(tp, called), zero).alias("precision"),
            F.coalesce(F.try_divide(tp, support), zero).alias("recall"),
            F.coalesce(F.try_divide(2 * tp, called + support), zero).alias("f1"),
            support.alias("support")))
    rows = confusion(scored, label, prediction).agg(F.array(*sums).alias("c"))
    measures = ["precision", "recall", "f1"]

    def over(fn, start=0.0):
        return F.aggregate("c", F.lit(start), fn)

    def plain(name):
        return lambda a, x: a + x[name]

    def by_support(name):
        return lambda a, x: a + x[name] * x["support"]

    n = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["support"])
    macro = F.struct(F.lit("macro avg").alias("class"), *[
        (over(plain(m)) / len(names)).alias(m) for m in measures], n.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), *[
        F.try_divide(over(by_support(m)), n).alias(m) for m in measures], n.alias("support"))
    return rows.select(F.inline(F.concat("c", F.array(macro, weighted))))


def mean_absolute_error(scored: DataFrame, actual, predicted) -> DataFrame:
    return scored.agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))


# --- scenarios ----------------------------------------------------------------

def _lookup(table, value, names):
    """The small (feature, value) table as one struct with a field for each name, NULL when absent.

    Names are looked up once here and not in every row; refer to it through one column.
    """
    known = table.agg(F.map_from_entries(F.collect_list(F.struct("feature", value))).alias("m"))
    return known.select(F.struct(*[F.try_element_at("m", F.lit(n)).alias(n) for n in names])).scalar()


def complete_features(scenarios: DataFrame, medians: DataFrame, centrality: DataFrame,
                      coords: DataFrame, features=S.FEATURE_COLUMNS) -> DataFrame:
    """Scenario rows (scenario, Origin, Dest, partial inputs) with every feature filled.

    Distance comes from the coordinates, hub scores from the centrality table
    (0 when absent), anything else missing from the medians and then 0.
    """
    from delaylens.operators.joins import add_centrality, distances

    def median(name, last=0.0):
        return F.coalesce(F.col("_medians")[name], F.lit(last))

    hubs = ["origin_pagerank", "origin_betweenness", "dest_pagerank", "dest_betweenness"]
    given = scenarios.drop("Distance", *hubs)
    placed = add_centrality(distances(given, coords, default=None), centrality)
    filled = {"Distance": F.coalesce("miles", median("Distance", S.DEFAULT_DISTANCE_MILES))}
    for name in features:
        if name == "Distance" or name in hubs:
            continue
        filled[name] = (F.coalesce(F.col(name).cast("double"), median(name))
                        if name in given.columns else median(name))
    known = placed.withColumn("_medians", _lookup(medians, "median", dict.fromkeys(["Distance", *features])))
    return known.withColumns(filled).select(
        "scenario", "Origin", "Dest", *features)


def drivers(features: DataFrame, medians: DataFrame, importance: DataFrame, k=10,
            columns=S.FEATURE_COLUMNS) -> DataFrame:
    """The k strongest contributions per scenario: scaled deviation x importance.

    Contributions are ranked inside the row, so scenarios are never shuffled;
    the two tables have one entry per feature. Values are zipped with the list of
    these entries: an expression for each feature makes a method that the JVM
    finds too large to compile.
    """
    middles, weights = _lookup(medians, "median", columns), _lookup(importance, "importance", columns)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("_m")[c].alias("median"),
                                 F.col("_w")[c].alias("importance")) for c in columns])
    spark = features.sparkSession
    listed = spark.range(1).select(middles.alias("_m"), weights.alias("_w")).select(entries.alias("e"))
    known = features.select("scenario", F.array(*[F.col(c).cast("double") for c in columns]).alias("_values"),
                            listed.scalar().alias("_entries"))

    def part(value, entry):
        middle = F.coalesce(entry["median"], value)
        pull = (value - middle) / F.greatest(F.abs(middle), F.lit(1.0)) * entry["importance"]
        return F.struct(
            F.coalesce(-F.abs(pull), F.lit(1.0)).alias("_rank"), entry["feature"].alias("feature"),
            value.alias("value"), middle.alias("median"), entry["importance"].alias("importance"),
            pull.alias("contribution"))

    top = F.slice(F.sort_array(F.zip_with("_values", "_entries", part)), 1, k)
    return (known.select("scenario", F.inline(top)).where(F.col("contribution").isNotNull())
            .select("scenario", "contribution", "feature", "value", "median", "importance"))
