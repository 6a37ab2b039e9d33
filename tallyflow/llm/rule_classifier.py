"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled documents; every path from a root is a rule, a conjunction of
bounds on statistics.  A logistic model with a lasso penalty weighs the rules and drops most.
What is left is compiled into one column expression, so scoring is built-in functions only and
runs wherever the statistics do.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of the id; statistics and
scores are of whole texts and of all documents.

Defined results: a null text is an empty one and gets the score of its statistics (all 0); without
labelled rows every score is 0.5, with a single class it is the smoothed share of that class;
labels without id or quality are ignored, repeated labels count each; a null doc_id is not held
out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.columns import let, words
from tallyflow.session import work_dir

SAMPLE, TREES, DEPTH, PENALTY, SEED = 20_000, 16, 3, 0.002, 7
THRESHOLD = 0.3

# Statistic -> column over the counts of ``counted``.
_share = lambda part, whole: lambda c: c[part] / F.greatest(c[whole], F.lit(1)).cast("double")
STATISTICS = {
    "n_words": lambda c: c["n_words"].cast("double"),
    "word_length": _share("word_chars", "n_words"),
    "distinct_words": _share("n_distinct", "n_words"),
    "stutter": _share("n_stutter", "n_words"),
    "upper": _share("n_upper", "word_chars"),
    "symbols": _share("n_symbols", "word_chars"),
    "bars": _share("n_bars", "n_words"),
    "shouts": _share("n_shouts", "n_words"),
    "stops": _share("n_stops", "n_words"),
    "digits": _share("n_digits", "word_chars"),
    "line_words": _share("n_words", "n_lines"),
    "repeated_lines": _share("n_repeated_lines", "n_lines"),
}


def counted(text: Column) -> Column:
    """Struct of counts over a whole text."""
    whole = F.coalesce(text, F.lit(""))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
        F.size(F.array_distinct(w)).alias("n_distinct"),
        F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))).alias("n_stutter")))
    of_lines = let(F.split(whole, "\n"), lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_repeated_lines")))
    count = lambda pattern: F.regexp_count(whole, F.lit(pattern))
    return let(F.struct(of_words.alias("w"), of_lines.alias("l"), count(r"\p{Lu}").alias("upper"),
                        count(r"[#*$%&<>^~=_]").alias("symbols"), count(r"\|").alias("bars"),
                        count(r"!").alias("shouts"), count(r"[.,;:?]").alias("stops"),
                        count(r"[0-9]").alias("digits")),
               lambda m: F.struct(
                   *[m["w"][x].alias(x) for x in ("n_words", "word_chars", "n_distinct", "n_stutter")],
                   *[m["l"][x].alias(x) for x in ("n_lines", "n_repeated_lines")],
                   *[m[x].alias(f"n_{x}") for x in ("upper", "symbols", "bars", "shouts", "stops", "digits")]))


def statistics(text: Column) -> Column:
    """Array of the statistics, in the order of STATISTICS."""
    return let(counted(text), lambda c: F.array(*[made(c) for made in STATISTICS.values()]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, is upper bound, value), all of which must hold."""

    bounds: tuple[tuple[int, bool, float], ...]

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for k, upper, value in self.bounds:
            stat = F.get(stats, F.lit(k))
            out = out & ((stat <= value) if upper else (stat > value))
        return out

    def __str__(self) -> str:
        names = list(STATISTICS)
        return " and ".join(f"{names[k]} {'<=' if u else '>'} {v:.4g}" for k, u, v in self.bounds)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _rules(node, bounds: tuple = ()) -> list[Rule]:
    """All paths from a node of a fitted tree downwards."""
    found = [Rule(tuple(sorted(bounds)))] if bounds else []
    if node.getClass().getSimpleName() != "InternalNode":
        return found
    split = node.split()
    k, value = int(split.featureIndex()), float(split.threshold())
    for child, upper in ((node.leftChild(), True), (node.rightChild(), False)):
        tightest = {(a, b): v for a, b, v in bounds}
        old = tightest.get((k, upper), value)
        tightest[k, upper] = min(old, value) if upper else max(old, value)
        found += _rules(child, tuple((a, b, v) for (a, b), v in tightest.items()))
    return found


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(label, stats) of at most ``sample`` labelled documents that are not held out."""
    chosen = (labels.where("doc_id is not null and quality is not null")
              .where(~held_out(F.col("doc_id")))
              .select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("double").alias("label"))
              .orderBy(F.xxhash64("labelled"), "label").limit(sample))
    # At most ``sample`` rows of two numbers are broadcast.
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
            .select("doc_id", "label", statistics(F.col("text")).alias("stats")))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    spark, folder = docs.sparkSession, work_dir(docs.sparkSession, "rules")
    training_rows(docs, labels, sample).write.parquet(f"{folder}/sample")
    # One sorted partition, bounded by the sample, so that refits agree.
    rows = (spark.read.parquet(f"{folder}/sample").coalesce(1).sortWithinPartitions("doc_id", "label")
            .withColumn("features", array_to_vector("stats")))
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).head()
    if positive in (0, n):
        share = (positive + 1) / (n + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=10).fit(rows)
    rules = sorted({r for tree in forest.trees for r in _rules(tree._call_java("rootNode"))},
                   key=lambda r: r.bounds)
    flags = F.array(*[r.column(F.col("stats")).cast("double") for r in rules])
    weighed = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=100).fit(
        rows.select("label", array_to_vector(flags).alias("features")))
    kept = [(r, float(w)) for r, w in zip(rules, weighed.coefficients) if w]
    return RuleModel(float(weighed.intercept), tuple(kept))


def classify(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of documents."""
    scored = docs.select("doc_id", statistics(F.col("text")).alias("stats")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
