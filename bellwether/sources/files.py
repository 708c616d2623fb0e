"""File stand-ins for topics, and the history table.

A topic is replayed from a folder.  The raw topic is text, one JSON message
per line; a topic that this library writes keeps each record's position
(``partition, offset, value`` as JSON lines), as the Kafka source has it.
History is a parquet table partitioned by ``day`` (the publication date),
written by Spark's exactly-once file sink or per batch, never rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from bellwether import constants as K
from bellwether import schemas
from bellwether.operators.serving import reconcile_columns

# Files a topic stand-in hands to one micro-batch (D3).
FILES_PER_TRIGGER = 1_000


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system."""
    fs, hpath = _file_system(spark, path)
    return fs.exists(hpath)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files in ``path`` (none if it does not exist), hidden ones left out."""
    fs, hpath = _file_system(spark, path)
    if not fs.exists(hpath):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hpath)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that a table no longer needs."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, so that a stream can be started before it has files."""
    fs, hpath = _file_system(spark, path)
    fs.mkdirs(hpath)


def stream_path(spark: SparkSession, path: str) -> str:
    """A path the file stream source accepts: folders as is, one file as a glob."""
    fs, hpath = _file_system(spark, path)
    if not fs.exists(hpath) or fs.getFileStatus(hpath).isDirectory():
        return path
    head, _, tail = path.rpartition("/")
    return f"{head}/[{tail[0]}]{tail[1:]}"


# ---- topics ---------------------------------------------------------------------
def read_raw_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Raw-topic stand-in: each line of each new file is one message ``value``."""
    return (spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).text(folder))


def read_topic_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Topic stand-in as a stream of ``partition, offset, value``."""
    return (spark.readStream.schema(schemas.TOPIC_RECORD).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).json(folder))


def read_topic(spark: SparkSession, folder: str, keyed: bool = False) -> DataFrame:
    """Topic stand-in, bounded read (S3); ``keyed`` adds the records' ``key`` (null: none)."""
    schema = schemas.KEYED_RECORD if keyed else schemas.TOPIC_RECORD
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)


def write_topic(records: DataFrame, folder: str) -> None:
    """Write ``partition, offset, value`` as a topic stand-in; the files follow the input's partitions."""
    records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TOPIC_RECORD]).write.mode(
        "overwrite").json(folder)


# ---- history ---------------------------------------------------------------------
def with_day(df: DataFrame) -> DataFrame:
    """Partition column of the history: the publication date."""
    return df.withColumn("day", F.to_date(F.try_to_timestamp(F.col("publishedAt"))))


def with_key(df: DataFrame) -> DataFrame:
    """128-bit key of (title, publishedAt): what the history is de-duplicated by."""
    text = F.to_json(F.struct("title", "publishedAt"))
    return df.withColumn("key", F.unhex(F.md5(text)))


def history_sink(served: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """K3 (stream): append served rows to the day-partitioned history.

    Spark's file sink logs committed files per batch, so a restarted query
    never writes a batch twice.
    """
    return (with_key(with_day(served)).writeStream.format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("day").outputMode("append"))


def append_history(served: DataFrame, path: str) -> None:
    """K3 (batch): append rows in any column order (P20); existing files are never rewritten.

    Rows are gathered by day before the write (a large day is spread over
    several tasks), so a day gets a few files, not one from every task.
    """
    rows = with_key(with_day(reconcile_columns(served, WRITTEN_HISTORY)))
    rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def overwrite_days(served: DataFrame, path: str) -> None:
    """K5: the daily reset.  The days that ``served`` has are replaced by its rows, no other day is touched."""
    rows = with_key(with_day(reconcile_columns(served, WRITTEN_HISTORY)))
    (rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_history(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The history, or an empty typed frame when none exists yet.

    ``day`` selects one partition (K5: the daily view is a partition
    filter; nothing is deleted to start a new day).
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.HISTORY)
    df = spark.read.schema(STORED_HISTORY).parquet(path)
    if day is not None:
        df = df.filter(F.col("day") == F.to_date(F.lit(day)))
    return df.select(*[f.name for f in schemas.HISTORY.fields])


# What the history stores: the served columns, the fetch time (the trend's event time), the key and the day.
WRITTEN_HISTORY = T.StructType([*schemas.HISTORY.fields, T.StructField("fetched_at_ts", T.TimestampType())])
STORED_HISTORY = T.StructType([*WRITTEN_HISTORY.fields, T.StructField("key", T.BinaryType()),
                               T.StructField("day", T.DateType())])

# Quoted fields may hold commas, quotes (doubled) and line breaks.
_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# Read: an empty field is null, a quoted empty field is the empty string (as written).
_CSV_READ = _CSV | {"nullValue": "\\N"}


def export_csv(served: DataFrame, path: str) -> None:
    """History as CSV with a header, in history column order."""
    served.select(*K.HISTORY_COLUMNS).write.mode("overwrite").options(**_CSV).csv(path)


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """S4 (CSV form): columns are found by their header names, in any order.

    Missing columns are filled and others dropped (P20); a confidence that
    is no number is null; a missing file is an empty frame.  Files whose
    headers differ from the first one's are read one by one.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.HISTORY)
    fs, hpath = _file_system(spark, path)
    found = fs.listStatus(hpath)
    files = sorted(f.getPath().toString() for f in found
                   if f.isFile() and not f.getPath().getName().startswith(("_", ".")) and f.getLen())
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        by_header.setdefault(tuple(spark.read.options(**_CSV_READ).csv(f).columns), []).append(f)
    parts = []
    for some in by_header.values():
        df = spark.read.options(**_CSV_READ).csv(some)
        if "confidence" in df.columns:
            df = df.withColumn("confidence", F.col("confidence").try_cast("double"))
        parts.append(reconcile_columns(df, schemas.HISTORY))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.HISTORY)
