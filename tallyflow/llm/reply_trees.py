"""Chat formatting from reply trees: iterative self-joins, one conversation per chosen path.

Messages are nodes with a parent.  ``rooted`` doubles parent pointers by self-joins, so a tree of
depth d takes log2(d) rounds and no node carries its path; every leaf then stands for one
root-to-leaf path with its depth and score.  ``chosen`` ranks the leaves of a conversation and
walks the pointers of the best ones back, again in log2(d) joins.  ``formatted`` writes each
chosen path as one text.  Built-in functions only.

Template: ``### role: text</turn>`` and a line end, per turn.  In texts a backslash, ``##`` and
``</turn>`` are escaped as ``\\\\``, ``#\\#`` and ``<\\/turn>``, so that no text can hold ``###`` or
``</turn>``; ``restored`` undoes it.

Defined results: null text is empty, null role an empty role, a null conversation id one
conversation of its own; a node whose parent is missing is a root; repeated node ids must be made
unique before (``chain`` numbers rows, ties by role and text); nodes on a cycle have no root and
are left out; an empty table gives no rows; other columns are not read.  One conversation is
one output row, so its text has to fit into a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.session import work_dir

NODE = ("conv_id", "node_id", "parent_id", "score", "role", "text")
TURN_END = "</turn>\n"


def chain(turns: DataFrame) -> DataFrame:
    """Rows by turn as a tree without branches: each turn answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("k"))
    return numbered.select(
        "conv_id", F.col("k").cast("long").alias("node_id"),
        F.when(F.col("k") > 1, F.col("k") - 1).cast("long").alias("parent_id"),
        F.lit(0.0).alias("score"), "role", "text")


def kept(frame: DataFrame, path: str) -> DataFrame:
    """The frame written once to the shared folder and read from there."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def rooted(nodes: DataFrame, folder: str) -> tuple[DataFrame, list[DataFrame]]:
    """(node, depth, path score) of all nodes with a root, and the pointer table of each round.

    Round k knows for each node whose root is more than 2**(k - 1) steps away its ancestor 2**k
    steps up and the score of the steps between; a finished node has no ancestor left.  Each round is written to the shared folder, so it is
    never computed again.
    """
    known = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n")).distinct()
    start = (nodes.join(known, [F.col("conv_id").eqNullSafe(F.col("c")),
                                F.col("parent_id") == F.col("n")], "left")
             .select("conv_id", "node_id", F.col("n").alias("up"),
                     F.coalesce("score", F.lit(0.0)).alias("path_score"),
                     F.lit(1).cast("long").alias("depth")))
    pointers, done, going = [], [], start
    # A root is at most as many steps away as its conversation has nodes; what has not come there by then
    # is on a cycle.
    largest = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        step = kept(going, f"{folder}/pointers-{len(pointers)}")
        pointers.append(step)
        done.append(step.where("up is null").drop("up"))
        going = step.where("up is not null")
        if going.isEmpty() or 1 << (len(pointers) - 1) > largest:
            break
        # Only nodes that are still on their way are joined; their ancestors may have arrived.
        reached = reduce(DataFrame.unionByName, done).withColumn("up", F.lit(None).cast("long"))
        above = going.unionByName(reached).select(
            F.col("conv_id").alias("c"), F.col("node_id").alias("n"), F.col("up").alias("up2"),
            F.col("path_score").alias("s2"), F.col("depth").alias("d2"))
        going = (going.join(above, [F.col("conv_id").eqNullSafe(F.col("c")),
                                    F.col("up") == F.col("n")])
                 .select("conv_id", "node_id", F.col("up2").alias("up"),
                         (F.col("path_score") + F.col("s2")).alias("path_score"),
                         (F.col("depth") + F.col("d2")).alias("depth")))
    return reduce(DataFrame.unionByName, done), pointers


def chosen(nodes: DataFrame, folder: str, best: int = 1) -> DataFrame:
    """Nodes of the ``best`` root-to-leaf paths of each conversation, with ``path_rank``.

    Paths rank by score, then length (longer first), then leaf id.
    """
    reached, pointers = rooted(nodes, folder)
    parents = nodes.select(F.col("conv_id").alias("c"), F.col("parent_id").alias("p")).distinct()
    leaves = reached.join(parents, [F.col("conv_id").eqNullSafe(F.col("c")),
                                    F.col("node_id") == F.col("p")], "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc("path_score"), F.desc("depth"), "node_id")
    marked = (leaves.withColumn("path_rank", F.row_number().over(order))
              .where(F.col("path_rank") <= best).select("conv_id", "node_id", "path_rank"))
    marked = kept(marked, f"{folder}/leaves")
    for k, table in enumerate(reversed(pointers[:-1])):
        up = table.where("up is not null").select(F.col("conv_id").alias("c"),
                                                  F.col("node_id").alias("n"), "up")
        above = (marked.join(up, [F.col("conv_id").eqNullSafe(F.col("c")),
                                  F.col("node_id") == F.col("n")])
                 .select("conv_id", F.col("up").alias("node_id"), "path_rank"))
        marked = kept(marked.unionByName(above).distinct(), f"{folder}/marked-{k}")
    at = reached.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "depth")
    placed = marked.join(at, [F.col("conv_id").eqNullSafe(F.col("c")),
                              F.col("node_id") == F.col("n")]).drop("c", "n")
    said = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "role", "text")
    return placed.join(said, [F.col("conv_id").eqNullSafe(F.col("c")),
                              F.col("node_id") == F.col("n")]).drop("c", "n")


def escaped(text: Column) -> Column:
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    body = F.replace(body, F.lit("##"), F.lit("#\\#"))
    return F.replace(body, F.lit("</turn>"), F.lit("<\\/turn>"))


def restored(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(path_nodes: DataFrame) -> DataFrame:
    """conv_id, path_rank, ``formatted`` and ``loss`` (start and length, in characters, of each
    assistant text in it)."""
    role = F.replace(escaped(F.col("role")), F.lit(": "), F.lit(":\\ "))
    turns = path_nodes.select(
        "conv_id", "path_rank", "depth", F.concat(F.lit("### "), role, F.lit(": ")).alias("head"),
        escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    whole = (turns.groupBy("conv_id", "path_rank")
             .agg(F.sort_array(F.collect_list(F.struct("depth", "head", "body", "learn"))).alias("t")))
    end = len(TURN_END)
    spans = F.aggregate(
        "t", F.struct(F.lit(0).alias("at"),
                      F.array().cast("array<struct<start:int,n:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + end).alias("at"),
            F.when(F.coalesce(t["learn"], F.lit(False)), F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(t["head"])).alias("start"),
                F.length(t["body"]).alias("n"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    text = F.array_join(F.transform("t", lambda t: F.concat(
        t["head"], t["body"], F.lit(TURN_END))), "")
    return whole.select("conv_id", "path_rank", text.alias("formatted"), spans.alias("loss"))


def read_turns(text: Column) -> Column:
    """Array of (role, text) from a formatted conversation."""
    parts = F.array_remove(F.split(text, "</turn>\n"), "")
    return F.transform(parts, lambda p: F.struct(
        restored(F.substring_index(F.substr(p, F.lit(5)), ": ", 1)).alias("role"),
        restored(F.substr(p, F.instr(p, ": ") + 2)).alias("text")))


def read_loss(text: Column, loss: Column) -> Column:
    """Array of the texts under the loss mask."""
    return F.transform(loss, lambda x: restored(F.substr(text, x["start"] + 1, x["n"])))


def format_trees(nodes: DataFrame, best: int = 1) -> DataFrame:
    folder = work_dir(nodes.sparkSession, "trees")
    nodes = kept(nodes.select(*NODE), f"{folder}/nodes")
    return formatted(chosen(nodes, folder, best))
