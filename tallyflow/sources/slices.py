"""Work in slices: the disk holds the shuffle files of one slice of the rows, not those of all.

A slice is the rows whose key has one hash, so all rows of a key are in one slice; how many there are follows from the
number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that are shuffled at once.
SLICE_ROWS = 40_000_000
# Half to two thirds of the size of Spark's usual one.
CODEC = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slices_for(rows: int) -> int:
    return max(1, -(-rows // SLICE_ROWS))


def slice_of(key: str, n: int) -> Column:
    """The slice of a row: the same for keys of the same text, whatever their type."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends; else they stay until the driver happens to collect its
    garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def laid_aside(pieces: Iterable[DataFrame], folder: str, by: str | None = None) -> DataFrame:
    """The rows of all pieces, made one after the other, as they are read back; a filter on ``by`` opens its files only."""
    schema = None
    for piece in pieces:
        writer = piece.write.mode("append").option("compression", CODEC)
        with freed(piece.sparkSession):
            (writer.partitionBy(by) if by else writer).parquet(folder)
        schema, spark = piece.schema, piece.sparkSession
    return spark.read.schema(schema).parquet(folder)
