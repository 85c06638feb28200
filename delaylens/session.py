"""Session settings and the shared scratch area."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app="delaylens", master=None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Spark's setting under which a query's shuffle files go when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_DIRS = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for local-mode sessions that name none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="delaylens-")
    return _LOCAL_DIRS[sc.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/delaylens/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and has no lineage."""
    spark = df.sparkSession
    where = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


@contextmanager
def freed_shuffles(spark: SparkSession, free=True):
    """Shuffle files of each query run inside go when it ends."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    if free:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if free and before is None:
            spark.conf.unset(FREE_SHUFFLES)
        elif free:
            spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, label: str, free=False) -> DataFrame:
    """Write once to the shared folder and read back, for frames used many times.

    With ``free`` the shuffle files of the write go when it ends. Otherwise they stay until the
    driver happens to collect its garbage, and add up over the writes of a job.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with freed_shuffles(spark, free):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str):
    """Remove a folder made under ``scratch`` that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
