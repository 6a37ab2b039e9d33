"""The trie of shared beginnings of conversations, from padded matrices of turn ids.

A turn is named by 128 bits of the SHA-256 of its role and text, a conversation is the row of its
turn ids.  Conversations are laid out in ranges (shards) of even size, in the order of these rows and then of
their ids, so copies of one conversation may fill many shards.  A task lays the rows of its shard side by
side in padded matrices, sorts them by numpy lexsort, and OR-accumulates the masks of columns that
differ from the row before: where the mask of a depth begins to hold, a node of that depth begins.
Every depth is then summed up by reduceat.  All sums are taken over rows of the shard, with what a node adds
once (its words, its being a child or a leaf) put on the row where it begins.

Nodes inside a shard are complete.  Nodes on the paths of a shard's first and last row may go on
in the shards beside it: their sums are added up by the SHA-256 of their path, less what the two rows at
an edge between shards have in common, which both shards have counted.  There are at most two paths a shard.

Matrices are cut into blocks of ``WIDTH`` turns; only rows that are long enough are in the later ones, so one very
long conversation does not widen the others.

Defined results: null role or text is empty; a null conv_id is no conversation; turns that share a
number (null comes first) are ordered by role, then text; repeated rows are turns of their own; copies of a conversation share all nodes; a conversation without turns is a
member of the root; very long texts count whole; one conversation's turn ids have to fit into a row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.shipping import ship
from tallyflow.session import shuffle_tasks, work_dir

WIDTH = 64
ROWS = 50_000
NODE = ("shard int, edge boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved long, ends array<long>, "
        "first array<long>, first_words array<int>, last array<long>")
COUNTS = ("n_convs", "n_children", "n_leaves", "saved")
CORRECTION = "key binary, n_children long, n_leaves long, saved long"
_ARROW = pa.schema([
    ("shard", pa.int32()), ("edge", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.list_(pa.int64())), ("first", pa.list_(pa.int64())), ("first_words", pa.list_(pa.int32())),
    ("last", pa.list_(pa.int64()))])


class Trie(NamedTuple):
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, the counts, and ``ends``, the ids of the
    members that end there in ascending order, null where ``parts`` lists them: conv_id, depth, shard, ends."""

    nodes: DataFrame
    parts: DataFrame


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words) of rows (conv_id, turn, role, text): two numbers per turn in ``ids`` and its words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = (turns.where("conv_id is not null")
              .select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"))
              .withColumn("k", F.row_number().over(order)))
    name = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    named = placed.select("conv_id", "k", name.alias("name"), F.regexp_count(
        "text", F.lit(r"[^\x20\x09-\x0D]+")).cast("int").alias("words"))
    return (named.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "name", "words"))).alias("t"))
            .select("conv_id", F.flatten(F.transform("t", lambda t: F.array(
                _half(t["name"], 1), _half(t["name"], 17)))).alias("ids"), F.col("t.words").alias("words")))


def with_shared_starts(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % every, h = crc32(c) % most."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = seqs.select("conv_id", "ids", "words", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    heads = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, 2 * (most - 1)).alias("head_ids"),
        F.slice("words", 1, most - 1).alias("head_words"))

    def taken(head: str, rest: str, each: int) -> Column:
        n = F.col("h") * each
        return F.concat(F.coalesce(F.slice(head, F.lit(1), n), F.slice(rest, F.lit(1), F.lit(0))),
                        F.slice(rest, n + 1, F.greatest(F.size(rest) - n, F.lit(0))))

    return own.join(heads, "base", "left").select(
        "conv_id", taken("head_ids", "ids", 2).alias("ids"), taken("head_words", "words", 1).alias("words"))


class Shard:
    """The rows of a shard in order, and the depth ``begin`` from which a row's nodes are new in it."""

    def __init__(self, conv: np.ndarray, ids: np.ndarray, words: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids[1::2], ids[::2]))
        high, low = ids[::2][order], ids[1::2][order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        turn = np.empty(len(order), np.int64)
        turn[order] = np.cumsum(new)
        starts = np.cumsum(lengths) - lengths
        # From the last block to the first: the rank of what a row has from this block on.
        deepest = int(lengths.max())
        rank = np.zeros(len(conv), np.int64)
        for first in range((deepest - 1) // WIDTH * WIDTH, -1, -WIDTH):
            rows = np.flatnonzero(lengths > first)
            block = self._block(turn, starts[rows], lengths[rows], first)
            keys = (rank[rows], *block.T[::-1])
            at = np.lexsort(keys)
            differs = np.ones(len(at), bool)
            differs[1:] = (block[at][1:] != block[at][:-1]).any(1) | (rank[rows][at][1:] != rank[rows][at][:-1])
            rank = np.zeros(len(conv), np.int64)
            rank[rows[at]] = np.cumsum(differs)
        order = np.lexsort((conv, rank))
        self.order, self.conv, self.lengths = order, conv[order], lengths[order]
        self.starts = starts[order]
        self.ids, self.words = ids, words
        self.begin = self._begins(turn)
        total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
        self._total, self._ends = total, total[self.starts + self.lengths]

    @staticmethod
    def _block(turn, starts, lengths, first) -> np.ndarray:
        """Padded matrix of the turns ``first`` to ``first + WIDTH``; 0 behind the end of a row."""
        width = min(WIDTH, int(lengths.max()) - first)
        at = starts[:, None] + first + np.arange(width)
        inside = first + np.arange(width) < lengths[:, None]
        return np.where(inside, turn[np.where(inside, at, 0)], 0)

    def _begins(self, turn) -> np.ndarray:
        """Depth of each row's first new node; beyond its length for a copy of the row before."""
        begin = self.lengths + 1
        begin[0] = 1
        settled = np.zeros(len(begin), bool)
        settled[0] = True
        before = np.arange(len(begin)) - 1
        for first in range(0, int(self.lengths.max()), WIDTH):
            rows = np.flatnonzero(self.lengths > first)
            last = np.concatenate([[-1], rows[:-1]])
            # The row before it has ended: all of this block is new.
            gone = (last != before[rows]) & ~settled[rows]
            begin[rows[gone]] = first + 1
            settled[rows[gone]] = True
            before[rows] = last
            block = self._block(turn, self.starts[rows], self.lengths[rows], first)
            change = np.logical_or.accumulate(block[1:] != block[:-1], axis=1)
            found = np.flatnonzero(change[:, -1] & ~settled[rows[1:]]) if len(rows) > 1 else []
            begin[rows[1:][found]] = first + 1 + change[found].argmax(1)
            settled[rows[1:][found]] = True
        return begin

    def tail(self, rows, depth) -> np.ndarray:
        """Words of the turns of a row from this depth on."""
        return self._ends[rows] - self._total[self.starts[rows] + np.maximum(depth, 1) - 1]

    def row(self, k: int) -> tuple[list[int], list[int]]:
        """Turn ids and words of a row."""
        a, n = int(self.starts[k]), int(self.lengths[k])
        return self.ids[2 * a:2 * (a + n)].tolist(), self.words[a:a + n].tolist()

    def nodes(self, shard: int) -> Iterator[pa.RecordBatch]:
        n = len(self.conv)
        once = np.where(self.begin <= self.lengths, self.tail(np.arange(n), np.minimum(self.begin, self.lengths)), 0)
        once_before = np.concatenate([[0], np.cumsum(once)])
        # A row begins a leaf if it is the first of its kind and the next kind does not go on from it.
        kinds = np.flatnonzero(self.begin <= self.lengths)
        if not len(kinds) or kinds[0]:
            kinds = np.concatenate([[0], kinds])
        goes_on = np.append(self.begin[kinds[1:]] > self.lengths[kinds[:-1]], False)
        leaf = np.zeros(n, np.int64)
        leaf[kinds[~goes_on]] = 1
        leaf_before = np.concatenate([[0], np.cumsum(leaf)])
        first, last = self.row(0), self.row(n - 1)
        first_keys, last_keys = path_keys(first[0]), path_keys(last[0])
        rows, begins = np.arange(n), np.zeros(1, np.int64)
        above: tuple | None = None
        for depth in range(int(self.lengths.max()) + 1):
            at = np.searchsorted(rows, begins)
            count = np.diff(np.append(at, len(rows)))
            least = np.minimum.reduceat(self.conv[rows], at)
            end = begins + count
            below = rows[self.lengths[rows] > depth]
            next_begins = below[self.begin[below] <= depth + 1]
            deeper = np.searchsorted(below, end) - np.searchsorted(below, begins)
            saved = (np.add.reduceat(self.tail(rows, depth), at) - (
                once_before[end] - once_before[begins] - once[begins] + self.tail(begins, depth)))
            edge = np.zeros(len(begins), bool)
            node_key: list[bytes | None] = [None] * len(begins)
            if begins[0] == 0:
                edge[0], node_key[0] = True, first_keys[depth]
            if end[-1] == n:
                edge[-1], node_key[-1] = True, last_keys[depth]
            if above is None:
                parent_key: list = [None] * len(begins)
                parent = pa.nulls(len(begins), pa.int64())
            else:
                of = np.searchsorted(above[0], begins, side="right") - 1
                parent_key = [above[3][k] for k in of.tolist()]
                parent = pa.array(above[1][of], pa.int64(), mask=above[2][of])
            ends = count - deeper
            offsets = np.concatenate([[0], np.cumsum(ends)])
            member = np.arange(offsets[-1]) - np.repeat(offsets[:-1], ends) + np.repeat(begins, ends)
            # The row of the root tells the shard's first and last row.
            borders = [[first[0]], [first[1]], [last[0]]] if depth == 0 else [[None] * len(begins)] * 3
            batch = pa.RecordBatch.from_arrays([
                pa.array(np.full(len(begins), shard), pa.int32()), pa.array(edge), pa.array(node_key, pa.binary()),
                pa.array(parent_key, pa.binary()), pa.array(least, pa.int64()),
                pa.array(np.full(len(begins), depth), pa.int64()), parent, pa.array(count, pa.int64()),
                pa.array(np.searchsorted(next_begins, end) - np.searchsorted(next_begins, begins), pa.int64()),
                pa.array(leaf_before[end] - leaf_before[begins], pa.int64()), pa.array(saved, pa.int64()),
                pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(self.conv[member])).cast(
                    pa.list_(pa.int64())),
                pa.array(borders[0], pa.list_(pa.int64())), pa.array(borders[1], pa.list_(pa.int32())),
                pa.array(borders[2], pa.list_(pa.int64()))], schema=_ARROW)
            for a in range(0, batch.num_rows, ROWS):
                yield batch.slice(a, ROWS)
            above = (begins, least, edge, node_key)
            rows, begins = below, next_begins


def path_keys(ids: list[int]) -> list[bytes]:
    """Name of the path of every depth, the root first."""
    path = hashlib.sha256()
    out = [path.digest()]
    for a, b in zip(ids[::2], ids[1::2]):
        path.update(a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True))
        out.append(path.digest())
    return out


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = [b for b in batches if b.num_rows]
    if not whole:
        return
    table = pa.Table.from_batches(whole).combine_chunks()
    conv, ids, words = (table.column(k).combine_chunks() for k in ("conv_id", "ids", "words"))
    lengths = np.diff(np.asarray(words.offsets)).astype(np.int64)
    shard = Shard(conv.to_numpy(), ids.flatten().to_numpy(), words.flatten().to_numpy(), lengths)
    yield from shard.nodes(table.column("shard")[0].as_py())


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What both shards beside an edge have counted, as negative counts of the nodes they share."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            last, first, words = row["last"], row["first"], row["first_words"]
            same, most = 0, min(len(last), len(first)) // 2
            while same < most and last[2 * same:2 * same + 2] == first[2 * same:2 * same + 2]:
                same += 1
            ended = 2 * same == len(last)
            shared = 0
            keys = path_keys(first[:2 * same])
            for depth in range(same, -1, -1):
                shared += words[depth - 1] if depth else 0
                # A node's words are not saved once; both shards have left them out.
                rows.append({"key": keys[depth], "n_children": -int(depth < same), "n_leaves": -int(ended),
                             "saved": shared})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("key", pa.binary()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64())]))


def prefix_trie(seqs: DataFrame) -> Trie:
    """All nodes of the trie of (conv_id, ids, words)."""
    spark = seqs.sparkSession
    ship(spark)
    folder = work_dir(spark, "trie")
    (seqs.select("conv_id", "ids", "words")
     .repartitionByRange(shuffle_tasks(spark), "ids", "conv_id")
     .select(F.spark_partition_id().alias("shard"), "conv_id", "ids", "words")
     .mapInArrow(_shard_nodes, NODE).write.partitionBy("edge").parquet(f"{folder}/shards"))
    stored = spark.read.schema(NODE).parquet(f"{folder}/shards")
    inside, edges = stored.where("not edge"), stored.where("edge")
    # One row per shard; the window sees their numbers only.
    numbers = edges.where("depth = 0").select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next"))
    tops = edges.where("depth = 0")
    beside = (numbers.join(tops.select("shard", "last"), "shard")
              .join(tops.select(F.col("shard").alias("next"), "first", "first_words"), "next")
              .select("last", "first", "first_words"))
    less = beside.mapInArrow(_corrections, CORRECTION)
    none = F.lit(None)
    parts = edges.select("key", "parent_key", "depth", "conv_id", *COUNTS).unionByName(less.select(
        "key", none.cast("binary").alias("parent_key"), none.cast("long").alias("depth"),
        none.cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_convs"), *COUNTS[1:]))
    joined = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in COUNTS])
    joined.write.parquet(f"{folder}/edges")
    known = spark.read.schema("key binary, parent_key binary, depth long, conv_id long, n_convs long, "
                              "n_children long, n_leaves long, saved long").parquet(f"{folder}/edges")
    parents = known.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    names = ("conv_id", "depth", "parent_conv_id", *COUNTS)
    no_ends = none.cast("array<long>").alias("ends")
    outer = known.join(parents, "parent_key", "left").select(*names, no_ends)
    # Each shard has the names of its own paths, so the children of a frequent node meet shard by shard.
    own = edges.select("shard", "key").join(known.select("key", "conv_id"), "key").select(
        "shard", F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    below = inside.where("parent_key is not null").drop("parent_conv_id").join(own, ["shard", "parent_key"]).select(
        *[F.col("above").alias("parent_conv_id") if c == "parent_conv_id" else F.col(c) for c in names], "ends")
    nodes = (inside.where("parent_key is null").select(*names, "ends").unionByName(below).unionByName(outer)
             .withColumnRenamed("saved", "saved_tokens"))
    ends = (edges.where(F.size("ends") > 0).select("shard", "key", "ends")
            .join(known.select("key", "conv_id", "depth"), "key").select("conv_id", "depth", "shard", "ends"))
    return Trie(nodes, ends)


def part_digests(parts: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): the ids of a node's parts joined by commas, hashed part after part."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, hashlib.sha256()
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

        def given():
            return pa.RecordBatch.from_pylist(
                [{"conv_id": node[0], "depth": node[1], "ends_sha256": sha.hexdigest()}], schema=schema)

        for batch in batches:
            for k in range(batch.num_rows):
                at = (batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                if at != node:
                    if node is not None:
                        yield given()
                    node, sha = at, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(",".join(map(str, batch.column(3)[k].values.to_pylist())).encode())
        if node is not None:
            yield given()

    return (parts.repartition(shuffle_tasks(parts.sparkSession), "conv_id", "depth")
            .sortWithinPartitions("conv_id", "depth", "shard")
            .mapInArrow(digest, "conv_id long, depth long, ends_sha256 string"))
