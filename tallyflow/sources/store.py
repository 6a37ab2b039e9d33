"""Small files and folders on whatever store a path names, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder or file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = hadoop_path(spark, path)
    return system.exists(place)


def listing(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, modification time) of what lies in a folder; nothing where there is none."""
    system, place = hadoop_path(spark, folder)
    try:
        found = system.listStatus(place)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return []
        raise
    return [(f.getPath().getName(), f.getModificationTime()) for f in found]


def read_text(spark: SparkSession, path: str) -> str:
    system, place = hadoop_path(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place whole, or not at all if there is one of this name (then False).

    The text is written beside it and renamed without overwriting, which HDFS does in one step.
    """
    system, place = hadoop_path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = system.create(beside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(beside), system.makeQualified(place), options)
        return True
    except Py4JJavaError as error:
        system.delete(beside, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    system, place = hadoop_path(spark, path)
    system.delete(place, True)
