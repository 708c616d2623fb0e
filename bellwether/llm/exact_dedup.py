"""Operator 5, exact dedup: a persistent digest index, bucketed and sorted.

The index is a table of one row per distinct text: its SHA-256, the id of
the row that stays, the number of rows of its batch that had the text, and
the batch.  It is bucketed and sorted by digest, so a new batch finds its
known texts with a sort-merge anti-join that does not move the index, and
only digests of unknown texts are appended.  A batch owns its partition of
the index: running it again overwrites that partition, so a job that died
half-way leaves nothing twice.

Defined cases: null text counts as empty text; among equal texts of a batch
the row with the largest id stays (a null id only if all are null); a text
that an earlier batch has is not kept; repeated rows count each; very long
texts are digested whole; an empty
table gives an empty result; other columns are ignored by :func:`classify`
and returned by :func:`keep_one`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import fresh_name, lookup_join, materialize
from bellwether.session import scratch_path


class DigestIndex:
    """A bucketed, sorted table of the digests seen so far."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        """Open the index, making it if the catalog has no such table.

        ``path`` is a shared folder (default: a new one under
        ``spark.checkpoint.dir``); ``buckets`` defaults to the session's
        shuffle partitions.
        """
        self.spark, self.name = spark, name
        n = self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(name):
            where = path or scratch_path(spark, name)
            spark.sql(f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, group_size BIGINT, batch STRING) "
                      f"USING parquet PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) "
                      f"INTO {n} BUCKETS LOCATION '{where}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Take the index out of the catalog (its files stay where they are)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Anti-join ``groups`` with the other batches; their unknown digests become batch ``batch``."""
        known = self.table().where(F.col("batch") != batch).select("digest")
        fresh = materialize(groups.join(known.hint("merge"), "digest", "left_anti"), "fresh-digests")
        view = f"fresh_{uuid.uuid4().hex[:12]}"
        fresh.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest").createOrReplaceTempView(view)
        quoted = batch.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{quoted}') SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)
        self.spark.catalog.refreshTable(self.name)


def digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, digest``: SHA-256 of the whole text in UTF-8, null as empty."""
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.unhex(sha).alias("digest"))


def classify(docs: DataFrame, index: DigestIndex, batch: str,
             text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Deduplicate one batch against itself and the index; append what is new.

    One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    digest``.  The groups are counted before they are shuffled, and a text
    with many copies is looked up through a broadcast of the (boundedly
    many) frequent digests.
    """
    rows = materialize(digests(docs, text_col, id_col), "digests")
    groups = materialize(rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
    index.append(groups, batch)
    own = groups.select("digest", "group_size")
    state = index.table().select("digest", "keep_id", (F.col("batch") == batch).alias("new"))
    joined = lookup_join(rows, own.join(state.hint("merge"), "digest"), "digest", "group_size", rows.count())
    kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex[:12]}")


def keep_one(docs: DataFrame, index: DigestIndex | None = None, batch: str = "batch") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat both id and text are one row; of rows with a null id
    and the same text one stays.
    """
    own = index is None
    index = index or new_index(docs.sparkSession)
    kept = materialize(classify(docs, index, batch).where("kept").select("doc_id", "digest"), "kept-rows")
    if own:
        index.forget()
    once = materialize(kept.distinct(), "kept")
    name = fresh_name(docs, "digest")
    mark = docs.withColumn(name, F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    same = mark["doc_id"].cast("bigint").eqNullSafe(once["doc_id"]) & (mark[name] == once["digest"])
    out = mark.join(once, same, "left_semi")
    if kept.count() != once.count():                 # some row came more than once
        out = out.dropDuplicates(["doc_id", name])
    return out.drop(name)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The result of the contract: one row per document, dropped ones too."""
    index = new_index(spark)
    out = materialize(classify(docs, index, "all").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")), "dedup")
    index.forget()
    return out
