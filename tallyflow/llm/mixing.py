"""Mixing sources to target weights by systematic sampling.

Targets are filled like water: every source gets size by weight until it reaches ``LIMIT`` times
its own size, the rest is shared again by weight.  Within a source every document expects
target / source size copies.  The expected copies are summed up along the documents in order of
size, one random offset per source is added, and a document is given out once for each whole
number that its stretch of the sum crosses.  Along sizes neighbours are alike, so the words taken
differ from the target by about one of the largest documents at most.

A running sum over a hot source would be one task's work: the rows are laid out by (source, size,
id) in ranges of even size, numbered inside a range, and shifted by the numbers of the ranges
before; mixed documents are found again by a name made of all their columns, not by id.  Sums are whole numbers in units of 2**-24 copies, so the layout can't change a result.

Defined results: null text has size 0; a null source is a source of its own, last in order; an
empty source or a source of empty texts has target 0 and gives nothing; rows equal in source,
size and id are interchangeable, and each is taken by its own place; very long texts count whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.operators.latest import one_per_key
from tallyflow.session import shuffle_tasks, work_dir

WEIGHTS = (5, 2, 1)
LIMIT = 3
UNIT = 1 << 24


def size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): one row per source; windows run over sources only."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]),
                   ((F.row_number().over(named) - 1) % len(weights)).cast("int")).cast("long")
    weighted = sources.select("source", "source_size", weight.alias("weight"))
    # Sources fill up in the order of limit / weight; one stays open if what is left, shared
    # among it and the later ones, is below its limit.
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ahead = weighted.select(
        "*", F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full"),
        F.sum("weight").over(after).alias("open_weight"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"))
    share = F.col("total") - LIMIT * F.col("full")
    closed = LIMIT * F.col("source_size") * F.col("open_weight") <= share * F.col("weight")
    # The first open source fixes the level for itself and all after it.
    marked = ahead.select("source", "source_size", "weight", closed.alias("closed"),
                          share.alias("share"), "open_weight")
    first_open = F.max(F.when(~F.col("closed"), F.struct(
        F.col("open_weight").alias("k"), F.col("share").alias("share")))).over(
            fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return marked.select(
        "source", "source_size",
        F.when(F.col("closed"), (LIMIT * F.col("source_size")).cast("double")).otherwise(
            F.col("weight") * first_open["share"] / first_open["k"].cast("double"))
        .alias("target"))


def offset(source: Column) -> Column:
    """The random offset of a source in units, from its name: reruns agree."""
    digits = F.substring(F.md5(F.coalesce(source, F.lit("null source"))), 1, 6)
    return F.conv(digits, 16, 10).cast("long")


def copies(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id, size, source, source_size, target, n_copies (and the columns ``names``) for every row of
    (doc_id, source, text)."""
    spark = docs.sparkSession
    folder = work_dir(spark, "mixing")
    sized = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                        size(F.col("text")).alias("size"), *names)
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    # The layout is written once: the sums of the ranges and the rows must agree on it.
    laid = sized.repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at"))
    laid.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(laid.schema).parquet(f"{folder}/rows")
    rates = targets(rows).withColumn("rate", F.when(
        F.col("source_size") > 0,
        F.floor(F.col("target") * UNIT / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    along = (Window.partitionBy("source").orderBy("block")
             .rowsBetween(Window.unboundedPreceding, -1))
    # A source's rows lie side by side in a block, from its first place on.
    blocks = (rows.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
              .withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))))
    known = blocks.join(rates, blocks["source"].eqNullSafe(rates["source"])).select(
        blocks["source"].alias("s"), blocks["block"].alias("b"), "before", "first", "source_size",
        "target", "rate")
    placed = rows.join(known, [F.col("source").eqNullSafe(F.col("s")), F.col("block") == F.col("b")])
    end = (F.col("before") + F.col("at") - F.col("first") + 1) * F.col("rate") + offset(F.col("source"))
    crossed = (F.shiftright(end, 24) - F.shiftright(end - F.col("rate"), 24)).cast("long")
    return placed.select("doc_id", "size", "source", "source_size", "target", crossed.alias("n_copies"), *names)


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents with all their columns, each as often as it is taken.

    Rows are taken by their own places and found again by 128 bits of all their columns; rows equal in all of
    them are given out together, as often as they are taken together.  Of such rows each task sends one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # A hash passes over nulls, so it is told where they are.
    whole = [*columns, *[c.isNull() for c in columns]]
    named = docs.select(F.xxhash64(*whole).alias("name_a"), F.xxhash64(F.lit(1), *whole).alias("name_b"),
                        F.struct(*columns).alias("doc"))
    light = named.select("name_a", "name_b", "doc.doc_id", "doc.source", "doc.text")
    taken = (copies(light, "name_a", "name_b").groupBy("name_a", "name_b")
             .agg(F.sum("n_copies").alias("taken_copies")).where("taken_copies > 0"))
    one = one_per_key(named, ["name_a", "name_b"], ["name_a"])
    return (one.join(taken, ["name_a", "name_b"])
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken_copies"))).alias("k"))
            .select("doc.*"))
