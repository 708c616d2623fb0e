"""S3: the position up to which a reader has read a topic.

The reference's reader resumes from a committed group position; here the
position is a small table in a shared folder, one row per topic partition.
Every commit is a new version; the last complete one counts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.sources.files import path_exists

SCHEMA = "version long, partition int, next_offset long"


def load(spark: SparkSession, path: str) -> dict[int, int]:
    """Next offset to read, by topic partition (as many entries as the topic has partitions)."""
    if not path_exists(spark, path):
        return {}
    table = spark.read.schema(SCHEMA).parquet(path)
    last = table.agg(F.max("version")).first()[0]
    return {r["partition"]: r["next_offset"] for r in table.where(F.col("version") == F.lit(last)).collect()}


def unread(records: DataFrame, position: dict[int, int]) -> DataFrame:
    """The records that come after the position; unknown partitions are unread."""
    if not position:
        return records
    start = F.create_map(*[F.lit(x) for kv in sorted(position.items()) for x in kv])
    return records.filter(F.col("offset") >= F.coalesce(F.try_element_at(start, F.col("partition")), F.lit(0)))


def behind(records: DataFrame, stop: tuple[int, int] | None) -> dict[int, int]:
    """The position behind the ``records`` read in order of partition and offset, up to and with ``stop``.

    Without a stop all of them were read.  Records that were skipped as
    invalid count as read; partitions after the stop stay unread.
    """
    read = records
    if stop is not None:
        read = records.filter(F.struct("partition", "offset") <= F.struct(F.lit(stop[0]), F.lit(stop[1]).cast("long")))
    rows = read.groupBy("partition").agg((F.max("offset") + 1).alias("n")).collect()     # one row per topic partition
    return {r["partition"]: r["n"] for r in rows}


def commit(spark: SparkSession, path: str, read: DataFrame, position: dict[int, int]) -> dict[int, int]:
    """Store the position behind all of the records ``read``, after an earlier position; return it."""
    merged = position | behind(read, None)
    store(spark, path, merged)
    return merged


def store(spark: SparkSession, path: str, position: dict[int, int]) -> int:
    """Store a position as the newest version, in one file that is there as a whole or not at all; return the version."""
    version = 1
    if path_exists(spark, path):
        version = (spark.read.schema(SCHEMA).parquet(path).agg(F.max("version")).first()[0] or 0) + 1
    rows = [(version, p, n) for p, n in sorted(position.items())]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return version


EARLIEST = -2                # the connector's code for the first offset that a partition still has


def as_kafka_offsets(topic: str, position: dict[int, int], partitions: int | None = None) -> str:
    """The position as the connector's ``startingOffsets``, which must name every partition of the topic.

    Partitions that were never read (there are ``partitions`` in all) start
    at their earliest record; without a position the whole topic does.
    """
    if not position:
        return "earliest"
    every = range(max(partitions or 0, max(position) + 1))
    return json.dumps({topic: {str(p): position.get(p, EARLIEST) for p in every}})
