"""Spelling variants: words that differ by one inserted, deleted or replaced character.

Words are counted over all documents, combined inside a task before they are shuffled.  The words
are then laid out twice in ranges of even size, sorted forward and sorted from their ends, and the nodes of the two
tries are numbered along the ranges: a node takes the next number of its range where it begins.
A node that reaches over the edge of a range is on the path of a later range's first word; all
such paths are known to every task, which numbers them in the same way, so a node
has one number wherever it occurs.

A word is then a row of integer pairs (prefix node, suffix node): skipping the character at i
gives the nodes of what stands before and behind it, splitting at i the nodes of both sides.  Words
that share a skipped pair differ by the character replaced; a word whose split pair is a skipped pair of
another is that word with one character less.  Only the first of a run of equal characters
is skipped for this, so each such neighbour is found once.  A pair of nodes spells out the rest of the word, so its group
holds one split word and at most one word for each character of the alphabet, however many words there
are: groups are ranked in place and no pairs of words are made.

Defined results: null text has no words; a null doc_id is an empty name in the check number; rows
that share an id are counted each; repeated rows are counted as often as they stand there; ties between near words of equal count go to the smallest in code-point order; very
long words are worked on whole (nodes are numbers, no prefix is stored as text); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.columns import let
from tallyflow.llm.shipping import ship
from tallyflow.session import shuffle_tasks, work_dir

LETTERS = "A-Za-zÀ-ÿ"
# One run in this many is changed by the check number of the query.
ODD_RUN = 199
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
KEPT_COUNTS = 500_000
# Numbers of a range start at range << RANGE_BITS; shared paths have the numbers below the first.
RANGE_BITS = 40


def changed(doc_id: bytes, run: str) -> str:
    """The run without the character that its check number picks, if it picks one."""
    h = zlib.crc32(doc_id + b":" + run.encode())
    if h % ODD_RUN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of (doc_id, text) that are long and frequent enough."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile("[a-zÀ-ÿ]+"), Counter()

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()),
                                               pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            # Bytes fold A-Z alone.
            for doc_id, text in zip(ids, batch.column(1).cast(pa.binary())):
                found = Counter(runs.findall(text.as_py().lower().decode()))
                start = zlib.crc32(doc_id.encode() + b":")
                for run, n in found.items():
                    # Deleting a character never makes a run longer.
                    if len(run) >= least_length:
                        if zlib.crc32(run.encode(), start) % ODD_RUN:
                            held[run] += n
                        elif len(run) > least_length:
                            held[changed(doc_id.encode(), run)] += n
            if len(held) > KEPT_COUNTS:
                yield given()
                held.clear()
        if held:
            yield given()

    return (rows.mapInArrow(count, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def common(a: str, b: str) -> int:
    """Length of the common start of two strings."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Numbers of the nodes of sorted words; ``paths`` are the starts that words of several ranges share."""

    def __init__(self, part: int, paths: list[str]):
        self.next = part + 1 << RANGE_BITS
        self.word, self.nodes = "", [0]
        self.shared: list[tuple[str, list[int]]] = []
        number, last, nodes = 1, "", [0]
        for path in sorted(set(paths)):
            same = common(last, path)
            nodes = nodes[:same + 1] + list(range(number, number + len(path) - same))
            number += len(path) - same
            last = path
            self.shared.append((path, nodes))
        self.at = 0

    def path(self, word: str) -> list[int]:
        """Numbers of the nodes of all starts of a word, the empty one first; words come in order."""
        # The shared path nearest in order has the longest common start with the word.
        while self.at < len(self.shared) and self.shared[self.at][0] <= word:
            self.at += 1
        known, nodes = common(self.word, word), self.nodes
        nodes = nodes[:known + 1]
        for path, numbers in self.shared[max(self.at - 1, 0):self.at + 1]:
            same = common(path, word)
            if same >= len(nodes):
                nodes = numbers[:same + 1]
        new = len(word) + 1 - len(nodes)
        nodes = nodes + list(range(self.next, self.next + new))
        self.next += new
        self.word, self.nodes = word, nodes
        return nodes


def _edges(words: DataFrame) -> list[str]:
    """The starts that the first word of a range shares with the last word before it: one for each range."""
    ranges = words.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    # As many rows as the layout has ranges, whatever the words are.
    ends = sorted((r.part, r.first, r.last) for r in ranges.collect())
    return [b[1][:common(a[2], b[1])] for a, b in zip(ends, ends[1:])]


def numbered(words: DataFrame, folder: str) -> DataFrame:
    """(word, nodes) of distinct words: the number of the trie node of every start of the word."""
    spark = words.sparkSession
    (words.select("word").repartitionByRange(shuffle_tasks(spark), "word").sortWithinPartitions("word")
     .withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(folder))
    stored = spark.read.schema("word string, part int").parquet(folder)
    paths = _edges(stored)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, part = None, None
        for batch in batches:
            found, size = [], [0]
            for of, word in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                if of != part:
                    trie, part = Trie(of, paths), of
                nodes = trie.path(word)
                found.append(np.array(nodes, np.int64))
                size.append(len(nodes))
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.cumsum(size), pa.int32()),
                                                           pa.array(flat))], names=["word", "nodes"])

    ship(spark)
    # A range is read by one task, in order.
    whole = stored.repartition(shuffle_tasks(spark), "part").sortWithinPartitions("part", "word")
    return whole.mapInArrow(number, "word string, nodes array<long>")


def _best(members: Column) -> Column:
    """The member of largest count, the smallest word among equals; members are (n, id, ...)."""
    return F.array_max(F.transform(members, lambda m: F.struct(m["n"].alias("n"), (-m["id"]).alias("id"))))


def neighbours(words: DataFrame, folder: str) -> DataFrame:
    """(id, n, word, n_near, near_n, near_id): ids follow the order of the words; near_id names the
    near word of largest count, the smallest among equals."""
    spark = words.sparkSession
    forward = numbered(words, f"{folder}/forward")
    # Words sorted from their ends, numbered the same way, are the trie of the suffixes.
    backward = numbered(words.select(F.reverse("word").alias("word")), f"{folder}/backward").select(
        F.reverse("word").alias("word"), F.reverse("nodes").alias("ends"))
    # The node of the whole word is a number of its own, but not in order; ids are.
    order = forward.select("word", F.col("nodes").alias("starts"))
    both = (words.join(order, "word").join(backward, "word")
            .repartitionByRange(shuffle_tasks(spark), "word").sortWithinPartitions("word")
            .withColumn("id", F.monotonically_increasing_id()))
    # Is the character at a place another than the one before it?
    opens = let(F.split("word", ""), lambda c: F.transform(c, lambda x, i: (i == 0) | (x != F.get(c, i - 1))))
    both.withColumn("opens", opens).write.parquet(f"{folder}/words")
    stored = spark.read.schema("word string, n long, starts array<long>, ends array<long>, id long, "
                               "opens array<boolean>").parquet(f"{folder}/words")
    size = F.size("starts") - 1
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("starts", i).alias("p"), F.get("ends", i + 1).alias("s"), F.lit(False).alias("split"),
        F.get("opens", i).alias("run_start")))
    split = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("starts", i).alias("p"), F.get("ends", i).alias("s"), F.lit(True).alias("split"),
        F.lit(False).alias("run_start")))
    pairs = (stored.select("id", "n", F.explode(F.concat(skipped, split)).alias("pair"))
             .select("id", "n", "pair.*"))
    groups = (pairs.groupBy("p", "s")
              .agg(F.collect_list(F.struct("n", "id", "split", "run_start")).alias("members"))
              .where(F.size("members") > 1))
    near = F.transform("members", lambda me: F.struct(
        me["id"].alias("id"),
        F.filter("members", lambda m: (m["id"] != me["id"]) & F.when(
            me["split"], m["run_start"]).when(m["split"], me["run_start"]).otherwise(True)).alias("near")))
    found = (groups.select(F.explode(near).alias("x")).where(F.size("x.near") > 0)
             .select("x.id", F.size("x.near").cast("long").alias("k"), _best(F.col("x.near")).alias("top"))
             .groupBy("id").agg(F.sum("k").alias("n_near"), F.max("top").alias("top")))
    return (stored.select("id", "word", "n").join(found, "id", "left")
            .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                    F.col("top.n").alias("near_n"), (-F.col("top.id")).alias("near_id")))


def variants(docs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words of (doc_id, text).

    A form is at least ``factor`` (over 1) times as frequent as its word, so forms lead to no circle
    and a path of forms has at most log(n) steps; it is halved by each self-join.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "spelling")
    word_counts(docs).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("word string, n long").parquet(f"{folder}/counts")
    near = neighbours(counts, folder).withColumn(
        "form_id", F.when(F.col("near_n") >= factor * F.col("n"), F.col("near_id")))
    near.write.parquet(f"{folder}/near")
    words = spark.read.schema("id long, word string, n long, n_near long, near_n long, near_id long, "
                              "form_id long").parquet(f"{folder}/near")
    links, k = words.where("form_id is not null").select("id", F.col("form_id").alias("root_id")), 0
    while True:
        links.write.parquet(f"{folder}/links-{k}")
        links = spark.read.schema("id long, root_id long").parquet(f"{folder}/links-{k}")
        above = links.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        stepped = links.join(above, "root_id", "left")
        if stepped.where("next_id is not null").isEmpty():
            break
        links, k = stepped.select("id", F.coalesce("next_id", "root_id").alias("root_id")), k + 1
    names = words.select(F.col("id").alias("named_id"), F.col("word").alias("name"))
    with_form = words.join(links, "id", "left").join(
        names.select(F.col("named_id").alias("form_id"), F.col("name").alias("form")), "form_id", "left")
    return with_form.join(
        names.select(F.col("named_id").alias("root_id"), F.col("name").alias("root")), "root_id", "left").select(
        "word", "n", "n_near", "form", F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n"),
        F.coalesce("root", "word").alias("root"))
