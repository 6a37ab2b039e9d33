"""Topics: JSON records with their arrival time, from Kafka or from a folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow import schemas
from tallyflow.functions import columns as C
from tallyflow.session import shuffle_tasks
from tallyflow.sources.slices import CODEC, freed


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_topic(spark: SparkSession, servers: str, topic: str,
                starting: str = "latest") -> DataFrame:
    """A Kafka topic as stream (value, timestamp).

    Needs the Spark Kafka package on the class path.  Offsets are kept in the checkpoint of the
    query, so nothing is lost between a crash and the restart.
    """
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting))
            .load().select(F.col("value").cast("string").alias("value"), "timestamp"))


def folder_topic(spark: SparkSession, path: str, *names: str,
                 files_per_trigger: int | None = None) -> DataFrame:
    """The same from a folder written by ``sinks.topics_to_folder``: one or more topics of it.

    The folder is read from its root, whose sink log lists the complete files only; the filter
    on the partition column ``topic`` keeps the other topics from being read.
    """
    reader = spark.readStream.schema(T.StructType(
        schemas.TOPIC_RECORD.fields + [T.StructField("topic", T.StringType())]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).filter(F.col("topic").isin(*names)).select("value", "timestamp")


def table_stream(spark: SparkSession, path: str, schema: T.StructType,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream; ``path`` is a folder or a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A stream takes a plain path for a folder, a pattern for either.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def ordered_stream(rows: DataFrame, time: str, folder: str, pieces: int, slices: int = 1,
                   read_once: bool = False) -> DataFrame:
    """A table as a stream in order of time: written as ``pieces`` runs of files, one run per trigger.

    A run has as many files as keep the tasks of a shuffle busy, in writing and in reading.
    A file source takes files by their modification time, so the files are dated by their place.  ``slices`` ranges of time are
    sorted one after the other.  With ``read_once`` a file goes when the batch that read it is done.
    """
    spark, n_files = rows.sparkSession, pieces * -(-shuffle_tasks(rows.sparkSession) // pieces)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    at, files = F.unix_micros(time), []
    cuts = rows.select(at.cast("double").alias("at")).approxQuantile(
        "at", [k / slices for k in range(1, slices)], 0.001) if slices > 1 else []
    number = sum((F.when(at >= F.lit(int(cut)), 1).otherwise(0) for cut in cuts), F.lit(0))
    for k in range(len(cuts) + 1):
        with freed(spark):
            (rows.where(number == k) if cuts else rows).repartitionByRange(-(-n_files // (len(cuts) + 1)), time).write.mode(
                "append").option("compression", CODEC).parquet(folder)
        known = {f.getName() for f in files}
        files += sorted((f.getPath() for f in system.listStatus(place) if f.getPath().getName().startswith("part-")
                         and f.getPath().getName() not in known), key=lambda f: f.getName())
    for k, file in enumerate(files):
        system.setTimes(file, 1_000_000_000_000 + 60_000 * k, -1)
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-len(files) // pieces)))
            .option("maxFileAge", "36500d").option("cleanSource", "delete" if read_once else "off").parquet(folder))


def change_stream(spark: SparkSession, folder: str,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Table changes (see ``schemas.CHANGELOG``) from a folder of JSON files."""
    reader = spark.readStream.schema(schemas.CHANGELOG)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).withColumn("timestamp", F.current_timestamp())


def _decode(records: DataFrame, schema: T.StructType, fields: Sequence[str] = ()) -> DataFrame:
    """The record fields as columns; with ``fields``, only these are parsed."""
    wanted = [f for f in schema.fields if not fields or f.name in fields]
    kept = [c for c in records.columns if c not in ("value", "topic")]
    return (C.with_computed(records, "_record", F.from_json("value", T.StructType(wanted)))
            .select(*kept, "_record.*"))


def decode_starts(records: DataFrame) -> DataFrame:
    """Start records; the wire field ``type`` is the log type."""
    return (_decode(records, schemas.START_WIRE)
            .withColumnRenamed("type", "log_type")
            .withColumn("ts", C.to_long(F.col("ts")))
            .withColumn("event_time", F.timestamp_millis("ts")))


def decode_events(records: DataFrame) -> DataFrame:
    return (_decode(records, schemas.EVENT_WIRE)
            .withColumn("ts", C.to_long(F.col("ts")))
            .withColumn("event_time", F.timestamp_millis("ts")))


def decode_orders(records: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    orders = _decode(records, schemas.ORDER_WIRE, fields)
    if "total_amount" not in orders.columns:
        return orders
    return orders.withColumn("total_amount", C.to_double(F.col("total_amount")))


def decode_order_details(records: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    return _decode(records, schemas.ORDER_DETAIL_WIRE, fields)


def decode_users(records: DataFrame) -> DataFrame:
    return _decode(records, schemas.USER_WIRE)
