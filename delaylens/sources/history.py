"""Type-2 history in bucketed tables that only grow.

Four tables below one folder:

* ``versions``: every version of every row, whole, in a partition per snapshot that opened it,
* ``closings``: (key, valid_from, valid_to) of versions that ended, in a partition per snapshot,
* ``heads``: key, check columns and ``valid_from`` of the open versions, in one of two partitions
  that take turns,
* ``log``: one row per finished snapshot.

All but the log are bucketed by key, so a snapshot shuffles the incoming rows once, to the buckets, and
joins them with the narrow heads as they lie; reading joins versions and closings bucket by bucket. No
partition of versions or closings is ever written again: a snapshot adds the rows that changed or are
new, however long the history. The log row comes last, so a snapshot that was cut off can be repeated.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens import schemas as S
from delaylens.operators.dedup import first_per_key
from delaylens.session import stored
from delaylens.sources.tables import table_exists

#: Buckets for a new history; a bucket of the heads should fit a task.
BUCKETS = 16


class BucketedHistory:
    def __init__(self, spark: SparkSession, path, schema, key="flight_id",
                 check_cols=S.SNAPSHOT_CHECK_COLUMNS, buckets=BUCKETS):
        """Open, or begin, the history of rows of ``schema`` below ``path``."""
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.body, self.checks = list(schema.names), list(check_cols)
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        mark = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self.names = {t: f"history_{t}_{mark}" for t in ("versions", "closings", "heads")}
        since = {"valid_from": "timestamp"}
        self._declare("versions", types | since)
        self._declare("closings", {key: types[key]} | since | {"valid_to": "timestamp"})
        self._declare("heads", {c: types[c] for c in dict.fromkeys([key, *self.checks])} | since)

    def _declare(self, table, columns):
        """Make the table known to the session, with the partitions that are there already.

        Its own overwrite mode holds whatever the session's is: under a static one a write of one
        partition would drop all others, and the heads could not be read for it.
        """
        if not self.spark.catalog.tableExists(self.names[table]):
            self._create(table, columns)
        self.spark.sql(f"ALTER TABLE {self.names[table]} "
                       "SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")

    def _create(self, table, columns):
        fields = ", ".join(f"`{c}` {t}" for c, t in columns.items())
        self.spark.sql(
            f"CREATE TABLE {self.names[table]} ({fields}, snapshot string) USING parquet "
            f"PARTITIONED BY (snapshot) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}'")
        if table_exists(self.spark, f"{self.path}/{table}"):
            self.spark.sql(f"ALTER TABLE {self.names[table]} RECOVER PARTITIONS")

    def _table(self, name):
        return self.spark.table(self.names[name])

    def _put(self, df, name, snapshot):
        """Write one partition; rows must already lie by bucket."""
        table = self.names[name]
        columns = [c for c in self._table(name).columns if c != "snapshot"]
        df.select(*columns, F.lit(snapshot).alias("snapshot")).write.insertInto(
            table, overwrite=True)
        self.spark.catalog.refreshTable(table)

    def _dealt(self, df):
        return df.repartition(self.buckets, self.key)

    def snapshots(self):
        """Finished snapshots, the oldest first (one small row each)."""
        if not table_exists(self.spark, f"{self.path}/log"):
            return []
        return [r["at"] for r in self.spark.read.parquet(f"{self.path}/log").distinct()
                .orderBy("at").collect()]

    def heads(self) -> DataFrame:
        """Key, check columns and start of the open versions."""
        slot = str(len(self.snapshots()) % 2)
        return self._table("heads").where(F.col("snapshot") == slot).drop("snapshot")

    def changes(self, current: DataFrame) -> DataFrame:
        """Rows of ``current`` that are new or differ from the open version; ``_since`` is its start.

        Of several rows with one key the first counts, in the order of check columns and then of all.
        """
        order = [*self.checks, *[c for c in self.body if c not in self.checks]]
        keyed = current.select(*self.body).where(F.col(self.key).isNotNull())
        one = first_per_key(self._dealt(keyed), [self.key], order)
        known = self.heads().select(
            F.col(self.key).alias("_known"), F.struct(*self.checks).alias("_was"),
            F.col("valid_from").alias("_since"))
        return one.join(known, F.col(self.key) == F.col("_known"), "left").where(
            F.col("_known").isNull() | ~F.struct(*self.checks).eqNullSafe(F.col("_was"))
        ).select(*self.body, "_since")

    def snapshot(self, current: DataFrame, as_of: str) -> None:
        """Close what changed, open what changed or is new. Keys not seen stay open.

        Rows without a key match nothing and are opened every time.
        """
        done = self.snapshots()
        name = "".join(c for c in as_of if c.isdigit())
        if name in done:
            return
        if done and name < done[-1]:
            raise ValueError(f"a later snapshot than {as_of} is there already")
        now = F.lit(as_of).cast("timestamp")
        moved = stored(self.changes(current), "history-moved")
        unkeyed = current.select(*self.body).where(F.col(self.key).isNull())
        self._put(self._dealt(moved.select(*self.body).unionByName(unkeyed)).withColumn(
            "valid_from", now), "versions", name)
        self._put(self._dealt(moved.where("_since IS NOT NULL")).select(
            self.key, F.col("_since").alias("valid_from"), now.alias("valid_to")), "closings", name)
        fresh = self._dealt(moved).select(F.col(self.key).alias("_key"), F.struct(
            *[c for c in self.checks], now.alias("valid_from")).alias("_now"))
        merged = self.heads().join(fresh, F.col(self.key) == F.col("_key"), "full")
        opened = F.col("_key").isNotNull()
        self._put(merged.select(
            F.coalesce("_key", self.key).alias(self.key),
            *[F.when(opened, F.col("_now")[c]).otherwise(F.col(c)).alias(c)
              for c in [*self.checks, "valid_from"] if c != self.key]), "heads",
            str((len(done) + 1) % 2))
        self.spark.range(1).select(F.lit(name).alias("at")).write.mode("append").parquet(
            f"{self.path}/log")

    def history(self) -> DataFrame:
        """All versions with ``valid_from``, ``valid_to`` and ``is_current``."""
        done = self.snapshots()
        versions = self._table("versions").where(F.col("snapshot").isin(done)).drop("snapshot")
        ends = self._table("closings").where(F.col("snapshot").isin(done)).select(
            F.col(self.key).alias("_key"), F.col("valid_from").alias("_from"), "valid_to")
        # the start is compared by difference: as a second join key it would ask for another
        # partitioning than the buckets have, and a key has few versions
        same = F.unix_micros("valid_from") - F.unix_micros("_from") == 0
        return versions.join(ends, (F.col(self.key) == F.col("_key")) & same, "left").select(
            *self.body, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
