"""Tables that streams add to batch by batch: every batch counted once, compacted now and then.

A micro-batch that fails after some of its writes is run again.  Here each
batch owns a folder (``delta/stream=<id>/batch=<n>``), which a repeated run
overwrites, so its rows are in the table once.  ``compact`` folds older
batches into a base; a base says up to which batch of each stream it reaches,
and readers leave out the batches it covers, so that neither a crash between
the steps of a compaction nor a batch that comes again counts anything twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.sources.files import delete, list_folder, path_exists

KEPT_BASES = 2               # the newest, and the one that running readers may still use


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the query that owns a checkpoint (it survives restarts; a new checkpoint has a new one)."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


class DeltaTable:
    """Rows of ``schema`` under ``path``, written per batch of a stream."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def write(self, rows: DataFrame, stream: str, batch: int) -> None:
        """The rows of one batch; a batch that is written again replaces itself."""
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.mode(
            "overwrite").parquet(f"{self.path}/delta/stream={stream}/batch={batch}")

    def _version(self) -> int:
        """The newest base that is complete; 0 for none."""
        found = [int(name.split("=")[1]) for name in list_folder(self.spark, f"{self.path}/base")
                 if path_exists(self.spark, f"{self.path}/base/{name}/rows/_SUCCESS")]
        return max(found, default=0)

    def _covered(self, version: int) -> DataFrame:
        schema = "stream string, upto long"
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/base/version={version}/covers")

    def _deltas(self, version: int) -> DataFrame | None:
        """The rows of all batches past the base, with ``stream`` and ``batch``."""
        if not list_folder(self.spark, f"{self.path}/delta"):
            return None
        schema = T.StructType([*self.schema.fields, T.StructField("stream", T.StringType()),
                               T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/delta")
        covered = F.broadcast(self._covered(version))                 # one row per stream
        return rows.join(covered, "stream", "left").where(
            F.col("upto").isNull() | (F.col("batch") > F.col("upto"))).drop("upto")

    def read(self) -> DataFrame:
        """All rows: the base and the batches after it."""
        version = self._version()
        base = None
        if version:
            base = self.spark.read.schema(self.schema).parquet(f"{self.path}/base/version={version}/rows")
        deltas = self._deltas(version)
        if deltas is None:
            return self.spark.createDataFrame([], self.schema) if base is None else base
        deltas = deltas.select(*self._columns())
        return deltas if base is None else base.unionByName(deltas)

    def compact(self, fold: Callable[[DataFrame], DataFrame], replace: DataFrame | None = None,
                everything: bool = False) -> None:
        """Fold the base and all batches but each stream's newest into a new base.

        The newest batch of a stream may still be run again, so it stays a
        batch, unless ``everything`` is folded (no stream is running).
        ``replace`` (rows that stand for everything written so far) takes
        the place of what is folded, and then covers the newest too.
        """
        everything = everything or replace is not None
        version = self._version()
        deltas = self._deltas(version)
        covered = self._covered(version)
        if deltas is not None:
            newest = deltas.groupBy("stream").agg((F.max("batch") - (0 if everything else 1)).alias("upto"))
            reach = covered.unionByName(newest).groupBy("stream").agg(F.max("upto").alias("upto"))
        else:
            newest, reach = None, covered
        target = f"{self.path}/base/version={version + 1}"
        reach.coalesce(1).write.mode("overwrite").parquet(f"{target}/covers")
        if replace is not None:
            rows = replace
        else:
            parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/base/version={version}/rows")] if version else []
            if deltas is not None:
                parts.append(deltas.join(F.broadcast(newest), "stream").where("batch <= upto").select(*self._columns()))
            if not parts:
                return
            rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        fold(rows).select(*self._columns()).write.mode("overwrite").parquet(f"{target}/rows")
        self._remove_covered(version + 1)

    def _remove_covered(self, version: int) -> None:
        """Delete what the base has taken in (left over folders are not read, so a crash here does no harm)."""
        for r in self._covered(version).collect():                    # one row per stream
            folder = f"{self.path}/delta/stream={r['stream']}"
            for name in list_folder(self.spark, folder):
                if int(name.split("=")[1]) <= r["upto"]:
                    delete(self.spark, f"{folder}/{name}")
        for name in list_folder(self.spark, f"{self.path}/base"):
            if int(name.split("=")[1]) <= version - KEPT_BASES:
                delete(self.spark, f"{self.path}/base/{name}")
