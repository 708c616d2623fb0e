"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.session import checkpoint_root, scratch_path

# A key is hot when it holds at least this share of all rows, so there are
# at most 1 / HOT_SHARE hot keys whatever the data.
HOT_SHARE = 1e-4


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def id_split(doc_id: str | Column, mod: int, held: int) -> Column:
    """True for rows whose crc32 of the id as text leaves ``held`` mod ``mod``.

    A null id is never held out.
    """
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % F.lit(mod) == F.lit(held), F.lit(False))


def lookup_join(left: DataFrame, right: DataFrame, key: str, n_col: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key) that no hot key can skew.

    ``right[n_col]`` is the number of ``left`` rows of each key and ``total``
    their sum.  Keys with at least ``HOT_SHARE`` of the rows, of which there
    are at most 1 / HOT_SHARE, are broadcast; every other key holds less than
    that share and goes through a shuffle join.  ``left`` is read twice, so
    pass a materialised table.
    """
    limit = max(1, -(-total // int(1 / HOT_SHARE)))
    hot = right.where(F.col(n_col) >= limit)
    cold = right.where(F.col(n_col) < limit)
    rare = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return (left.join(F.broadcast(hot), key)
            .unionByName(rare.join(cold.hint("merge"), key)))


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
             schema: str | T.StructType) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df`` (no shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every vertex of ``edges`` (a, b): columns ``id, comp``.

    ``comp`` is the least id of the component.  Minimum labels are spread
    over the edges and then along the labels themselves (a label is a vertex
    too), so the rounds grow with the logarithm of a component's diameter.
    Every round is written to the shared folder; nothing is collected but
    the number of labels that changed.
    """
    both = materialize(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("comp")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        spread = labels.join(near, "id").select(
            "id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = materialize(spread.join(jump, "comp").select(
            "id", "was", F.least("comp", "far").alias("comp")), "cc-labels")
        changed = new.where(F.col("was") != F.col("comp")).limit(1).count()
        labels = new.select("id", "comp")
        if not changed:
            return labels
