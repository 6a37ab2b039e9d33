"""The named queries of the pipeline operators: thin digests of what the operators return."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import (byte_repeats, decontaminate, mixing, near_dedup, prefix_trie,
                           quality_rules, reply_trees, rule_classifier, sentence_pieces, spelling, token_counts,
                           token_files, word_repeats)
from tallyflow.session import work_dir

# Folder of the public tokenizer files; another one can be named by the environment.
TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "")
WORD_BPE, WORD_BPE_END = "word_bpe_49k.json", 2
PIECE_BPE = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark, folder):
    """Ledger of all documents under the production policy."""
    base = quality_rules.mask("base")
    book = quality_rules.ledger(table(spark, folder, "documents"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        quality_rules.passes(F.col("fail_bits")).alias("kept"), "fail_bits")


@query
def op2_token_files(spark, folder):
    """All documents as token ids in shards, read back from them."""
    manifest = token_files.write_token_files(
        table(spark, folder, "documents"), work_dir(spark, "token-files"), tokenizer(WORD_BPE),
        WORD_BPE_END)
    return token_files.read_token_files(manifest)


@query
def op3_decontaminate(spark, folder):
    """Benchmark windows in all documents."""
    return decontaminate.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark")
                              ).drop("spans")


@query
def op4_bagminhash(spark, folder):
    """Class of every document; copies and near copies share one, named by its least id."""
    return near_dedup.near_classes(table(spark, folder, "documents"))


@query
def op5_rule_ensemble(spark, folder):
    """Quality score of every document by rules fitted on labelled ones."""
    docs = table(spark, folder, "documents")
    return rule_classifier.classify(docs, rule_classifier.fit(docs, table(spark, folder, "labels")))


@query
def op6_systematic_mix(spark, folder):
    """Words taken of every document by the mix of all sources."""
    return mixing.copies(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


@query
def op7_transducer_counts(spark, folder):
    """Tokens of every document."""
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer(PIECE_BPE))


@query
def op8_bucket_refinement(spark, folder):
    """Bytes of every document that an earlier document has in 50-byte strings."""
    return byte_repeats.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op9_recompression(spark, folder):
    """Words of every document in 20-word windows that stand earlier."""
    return word_repeats.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op10_reply_trees(spark, folder):
    """All conversations and conversation -7, formatted and read back."""
    tricky = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"))
    turns = (table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
             .unionByName(added))
    made = reply_trees.format_trees(reply_trees.chain(turns))
    read = made.select(
        "conv_id", "formatted", reply_trees.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(reply_trees.read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op11_prefix_trie(spark, folder):
    """Nodes of the trie of all conversations with shared starts."""
    seqs = prefix_trie.with_shared_starts(prefix_trie.sequences(table(spark, folder, "conversations")))
    trie = prefix_trie.prefix_trie(seqs)
    digests = prefix_trie.part_digests(trie.parts).select("conv_id", "depth", F.col("ends_sha256").alias("long"))
    inside = F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256)
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    whole = trie.nodes.where("ends is not null").select(*columns, inside.alias("ends_sha256"))
    parted = trie.nodes.where("ends is null").join(digests, ["conv_id", "depth"], "left").select(
        *columns, F.coalesce("long", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    return whole.unionByName(parted)


@query
def op12_sentence_pieces(spark, folder):
    """Token ids of every document, and the text they stand for."""
    model = tokenizer(PIECE_BPE)
    encoded = sentence_pieces.encode(table(spark, folder, "documents"), model)
    return sentence_pieces.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query
def op13_spelling_variants(spark, folder):
    """Frequent words of all documents with their near words, most frequent form and root."""
    return spelling.variants(table(spark, folder, "documents"))
