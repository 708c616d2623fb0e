"""The keys of the history, for its dedupe (K3, D2): partitioned by day, bucketed and sorted by key.

A micro-batch is compared with the keys of exactly the days it has: an odd
date costs the keys of its own day and no more.  The index side of the join
is read bucket by bucket and never shuffled; the batch brings its keys alone,
and only those that were found go back to its rows.  A batch writes one file
per day and bucket, whatever the number of tasks, so the buckets are few: a
batch over many days costs files in proportion to its days.  Every batch owns
its partitions, so a batch that is run again replaces its entries;
``compact`` rewrites the batches of the days into few files.  Keys are a set,
so a crash in the middle of a compaction, which leaves some of them twice,
changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.session import land
from bellwether.sources.files import delete, ensure_folder, list_folder, path_exists

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
BASE = "base"                 # what compacted partitions have in the place of a stream
BUCKETS = 4                   # of a new index; keys are 16 bytes, so a day of 4 million has 16 MB in each
MOST_DAYS = 1_000             # days that are listed in a partition filter; a batch with more reads all of them


class KeyIndex:
    """Keys seen so far: ``key, day, stream, batch``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        made = [n for n in list_folder(spark, self.path) if n.startswith("buckets-")]
        self.buckets = int(made[0].split("-")[1]) if made else buckets or BUCKETS
        self.where = f"{self.path}/buckets-{self.buckets}"
        self.name = f"keys_{hashlib.md5(self.where.encode()).hexdigest()[:16]}"
        if not made:
            ensure_folder(spark, self.where)
        if not spark.catalog.tableExists(self.name):
            self._register()

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def started(self, stream: str, batch: int) -> bool:
        """Has this batch been begun before?  Marks it as begun."""
        mark = f"{self.path}/started/{stream}/{batch}"
        before = path_exists(self.spark, mark)
        ensure_folder(self.spark, mark)
        return before

    def seen(self, rows: DataFrame, days: Column, stream: str, batch: int) -> DataFrame:
        """The keys of the rows that another batch has; ``days`` is a filter on the column ``day``."""
        own = (F.col("stream") == stream) & (F.col("batch") == batch)
        known = self.table().where(days & ~own).select("key")
        # narrow on both sides, as it has as many tasks as buckets
        return known.join(rows.select("key").hint("merge"), "key", "left_semi")

    def unseen(self, rows: DataFrame, days: Column, stream: str, batch: int) -> DataFrame:
        """The rows (with ``key``) whose key no other batch has."""
        return rows.join(self.seen(rows, days, stream, batch), "key", "left_anti")

    def landed_unseen(self, rows: DataFrame, days: Column, stream: str, batch: int) -> DataFrame:
        """The same with the seen keys landed: Spark drops what it has cached of a table that is written to."""
        where = f"{self.path}/seen/{stream}"                     # the stream's next batch overwrites it
        self.seen(rows, days, stream, batch).write.mode("overwrite").parquet(where)
        return rows.join(self.spark.read.schema("key binary").parquet(where), "key", "left_anti")

    def write(self, rows: DataFrame, stream: str, batch: int) -> None:
        """The keys of one batch (``key, day``), in place of what it may have written before."""
        view = f"keys_{uuid.uuid4().hex[:12]}"
        bucket = F.pmod(F.hash("key"), F.lit(self.buckets))      # Spark's own bucket number: a file of a day has one writer
        rows.select("key", "day", F.lit(stream).alias("stream"), F.lit(batch).cast("long").alias("batch")).repartition(
            "day", bucket).createOrReplaceTempView(view)
        self._insert(view)

    def _insert(self, view: str) -> None:
        mode = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (day, stream, batch) "
                           f"SELECT key, day, stream, batch FROM {view}")
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
            self.spark.catalog.dropTempView(view)
        self.spark.catalog.refreshTable(self.name)

    def compact(self) -> None:
        """Rewrite every day's batches, but for each stream's newest batch, as one partition."""
        table = self.table()
        parts = table.select("day", "stream", "batch").distinct()          # partitions, not keys
        newest = parts.where(F.col("stream") != BASE).groupBy("stream").agg(F.max("batch").alias("newest"))
        old = land(parts.join(F.broadcast(newest), "stream", "left").where(
            F.col("newest").isNull() | (F.col("batch") < F.col("newest"))).select("day", "stream", "batch"), "old-parts")
        many = old.groupBy("day").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("day").alias("__day"))
        chosen = land(old.join(F.broadcast(many), F.col("day").eqNullSafe(F.col("__day"))).select(
            "day", "stream", "batch"), "merged-parts")
        if chosen.limit(1).count() == 0:
            return
        version = 1 + (parts.where(F.col("stream") == BASE).agg(F.max("batch")).first()[0] or 0)
        c = chosen.select(*[F.col(x).alias(f"__{x}") for x in chosen.columns])
        same = F.col("day").eqNullSafe(F.col("__day")) & (F.col("stream") == F.col("__stream")) & (F.col("batch") == F.col("__batch"))
        merged = land(table.join(F.broadcast(c), same, "left_semi").select("key", "day").distinct(), "merged-keys")
        self.write(merged, BASE, version)
        for r in chosen.collect():                                          # partitions, not keys
            day = NO_DAY if r["day"] is None else str(r["day"])
            # an external table keeps the files of a partition that it drops
            delete(self.spark, f"{self.where}/day={day}/stream={r['stream']}/batch={r['batch']}")
        # partitions without files are not read; the catalog is told once for all
        self.spark.sql(f"DROP TABLE {self.name}")
        self._register()

    def _register(self) -> None:
        """Tell the catalog of the table and of the partitions found in its folder."""
        self.spark.sql(f"CREATE TABLE {self.name} (key BINARY, day DATE, stream STRING, batch BIGINT) USING parquet "
                       f"PARTITIONED BY (day, stream, batch) CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.where}'")
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)


def day_filter(rows: DataFrame) -> Column:
    """A filter on ``day`` that holds for the days of ``rows`` (exactly those, unless there are very many)."""
    days = [r["day"] for r in rows.select("day").distinct().limit(MOST_DAYS + 1).collect()]
    if len(days) > MOST_DAYS:
        return F.lit(True)
    some = [d for d in days if d is not None]
    found = F.col("day").isin(some) if some else F.lit(False)
    return found | F.col("day").isNull() if None in days else found
