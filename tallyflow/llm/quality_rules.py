"""Rule bitmask ledger: every rule is evaluated once, policies are masks over its bits.

The ledger holds the measurements of a text and one long whose bit k says that rule k failed.  A
policy is a named, versioned mask; applying one, or asking what another one would keep, touches
only the bits.  Built-in functions only.

Defined results: a null text is an empty one (no words, fails ``too_short``); ties and repeated
rows are judged alike, each on its own; an empty table gives an empty ledger; other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.columns import let, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

# Rule name -> what makes a text fail, over the measurements; the position is the bit.
RULES = {
    "too_short": lambda m: m["n_words"] < 50,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["word_chars"],
    "duplicate_lines": lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"],
    "long_words": lambda m: m["word_chars"] > 40 * m["n_words"],
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}

# Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("too_short", "repeated_windows"),
    "v1": ("too_short", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}
PRODUCTION = "v2"


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def measure(text: Column) -> Column:
    """Struct of the measurements of a whole text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long")
    return let(F.struct(found.alias("w"), line_counts.alias("l"), symbols.alias("s")),
               lambda m: F.struct(
                   m["w"]["n_words"].alias("n_words"), m["w"]["word_chars"].alias("word_chars"),
                   m["s"].alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
                   m["l"]["n_lines"].alias("n_lines"),
                   m["w"]["n_repeat_words"].alias("n_repeat_words")))


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that the text has twice or more.

    Most texts have no such window; only the others sort their windows by content, mark the
    equal neighbours and add up the stretches that the marked windows cover.
    """
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    covered = let(grams, lambda g: F.when(
        F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g)))
    return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(covered)


def _covered(grams: Column) -> Column:
    placed = F.sort_array(F.transform(
        grams, lambda g, i: F.struct(g.alias("g"), i.alias("at"))))
    marked = let(placed, lambda s: F.filter(s, lambda x, i: F.coalesce(
        F.get(s, i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(
        F.get(s, i + 1)["g"] == x["g"], F.lit(False))))
    starts = F.sort_array(F.transform(marked, lambda x: x["at"]))
    return let(starts, lambda s: F.aggregate(
        F.transform(s, lambda at, i: F.least(
            F.lit(3), F.coalesce(F.get(s, i + 1) - at, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n))


def fail_bits(m: Column) -> Column:
    """One long, a bit for each failed rule."""
    total = F.lit(0).cast("long")
    for name, fails in RULES.items():
        total = total.bitwiseOR(F.when(fails(m), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return total


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``fail_bits`` of every row."""
    return (docs.select("doc_id", measure(F.col("text")).alias("m"))
            .select("doc_id", *[F.col("m")[x].alias(x) for x in MEASURES],
                    fail_bits(F.col("m")).alias("fail_bits")))


def passes(bits: Column, policy: str = PRODUCTION) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) == 0


def keep(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Rows that pass the policy, with all their columns."""
    return docs.where(let(measure(F.col("text")), lambda m: passes(fail_bits(m), policy)))


def ablation(book: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """For each rule of a policy: rows that fail it, that only it rejects, and what is kept
    without it.  The ledger is first counted per bit pattern, of which there are few."""
    whole = mask(policy)
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(x).alias("rule"), F.lit(BITS[x]).cast("long").alias("bit"))
                      for x in POLICIES[policy]])
    failed = F.col("fail_bits").bitwiseAND(F.lit(whole))
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0)))
    return (patterns.withColumn("r", F.explode(rules))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(total(failed.bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
                 total(failed == F.col("r.bit")).alias("n_only"),
                 total((failed == 0) | (failed == F.col("r.bit"))).alias("n_kept_without")))
