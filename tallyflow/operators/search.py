"""Search in the wide sale rows: hits, facets, shares, page, index, ranked hits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C


def find_sales(sales: DataFrame, day: str | None, keyword: str | None) -> DataFrame:
    """Rows of one day (``None``: all days) whose product name has all words of the keyword."""
    hits = sales if day is None else sales.filter(F.col("dt") == day)
    return hits.filter(C.has_all_terms(F.col("sku_name"), keyword))


def page_of(hits: DataFrame, page: int, size: int,
            order: tuple[str, ...] = ("order_detail_id",)) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows, ordered by id."""
    return hits.orderBy(*order).offset((page - 1) * size).limit(size)


def gender_age_counts(hits: DataFrame) -> DataFrame:
    """Hits per gender and age.

    Total, both facets and all shares follow from these few rows, so the hits are read once and
    need no cache.
    """
    return hits.groupBy("user_gender", "user_age").agg(F.count(F.lit(1)).alias("n"))


def hit_total(counts: DataFrame) -> DataFrame:
    return counts.agg(C.or_zero(F.sum("n")).alias("total"))


def _top(counts: DataFrame, key: str, size: int) -> DataFrame:
    return (counts.filter(F.col(key).isNotNull())
                  .groupBy(key).agg(F.sum("n").alias("n"))
                  .orderBy(F.desc("n"), key).limit(size))


def gender_facet(counts: DataFrame, size: int = fixed.GENDER_FACET_SIZE) -> DataFrame:
    """The ``size`` largest genders."""
    return _top(counts, "user_gender", size)


def age_facet(counts: DataFrame, size: int = fixed.AGE_FACET_SIZE) -> DataFrame:
    """The ``size`` largest ages."""
    return _top(counts, "user_age", size)


def age_group(age: Column) -> Column:
    return (F.when(age < 20, fixed.AGE_UNDER_20)
             .when(age <= 30, fixed.AGE_20_TO_30)
             .when(age > 30, fixed.AGE_OVER_30))


def nested_stats(counts: DataFrame) -> DataFrame:
    """One row: ``total`` and ``stat``, a list of (title, options (name, value)).

    Shares are of all hits and of all groups, however long the two facet lists are cut.
    """
    def hits_where(cond: Column) -> Column:
        return C.or_zero(F.sum(F.when(cond, F.col("n"))))

    groups = {
        fixed.GENDER_TITLE: [(name, F.col("user_gender") == code)
                             for code, name in fixed.GENDER_LABELS.items()],
        fixed.AGE_TITLE: [(name, age_group(F.col("user_age")) == name) for name in
                          (fixed.AGE_UNDER_20, fixed.AGE_20_TO_30, fixed.AGE_OVER_30)],
    }
    sums = counts.agg(C.or_zero(F.sum("n")).alias("total"),
                      *[hits_where(cond).alias(name)
                        for options in groups.values() for name, cond in options])

    def option(name: str) -> Column:
        return F.struct(F.lit(name).alias("name"),
                        C.percent_share(F.col(name), F.col("total")).alias("value"))

    return sums.select("total", F.array(*[
        F.struct(F.lit(title).alias("title"),
                 F.array(*[option(name) for name, _ in options]).alias("options"))
        for title, options in groups.items()]).alias("stat"))


def stat_rows(counts: DataFrame) -> DataFrame:
    """The same as rows (title, name, value)."""
    return (nested_stats(counts).select(F.inline("stat"))
            .select("title", F.inline("options")))


def words_of(spark: SparkSession, keyword: str) -> list[str]:
    """The words of a keyword, in order, by the same expression as those of the names."""
    return sorted(spark.range(1).select(F.array_distinct(C.tokens(F.lit(keyword)))).first()[0])


def postings(sales: DataFrame) -> DataFrame:
    """(word, order_detail_id, dt): each word of a row's product name once."""
    return sales.select(F.explode(F.array_distinct(C.tokens(F.col("sku_name")))).alias("word"),
                        "order_detail_id", "dt")


def posted(found: DataFrame, n_words: int) -> DataFrame:
    """(order_detail_id, dt) that all words name; ``found`` holds the postings of these words."""
    both = found.select("word", "order_detail_id", "dt").distinct().groupBy("order_detail_id", "dt")
    return both.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n_words).drop("n")


# Usual values of the two parameters: how soon more of a word counts less, how much a long name does.
SATURATION, LENGTH = 1.2, 0.75


def ranked(sales: DataFrame, day: str | None, keyword: str, size: int) -> DataFrame:
    """The ``size`` best hits by BM25, with ``score``; equal ones by id.

    The figures of the collection (rows, mean length, rows that have a word) come from one aggregate over product
    names with their number of rows, as very many rows share a name.  Hits are scored by name, and the best are
    a top-k, which no task sorts whole.
    """
    rows = sales if day is None else sales.filter(F.col("dt") == day)
    wanted = words_of(sales.sparkSession, keyword)
    names = (rows.groupBy("sku_name").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("tokens", F.coalesce(C.tokens(F.col("sku_name")), F.array().cast("array<string>"))))
    has = [F.sum(F.when(F.array_contains("tokens", w), F.col("n"))).cast("double") for w in wanted]
    # One row of numbers, as many as the keyword has words.
    total, mean, *df = names.agg(F.sum("n").cast("double"), F.sum(F.col("n") * F.size("tokens")) / F.sum("n"),
                                 *has).first()
    if not wanted or not all(df):
        return rows.limit(0).withColumn("score", F.lit(0.0))

    def part(word: str, df: float) -> Column:
        tf = F.size(F.filter("tokens", lambda t: t == word)).cast("double")
        idf = F.lit(math.log(1 + (total - df + 0.5) / (df + 0.5)))
        length = F.size("tokens") / F.lit(mean)
        return idf * tf * (SATURATION + 1) / (tf + SATURATION * (1 - LENGTH + LENGTH * length))

    hits = names.where(F.forall(F.array(*[F.lit(w) for w in wanted]), lambda w: F.array_contains("tokens", w)))
    scored = hits.select("sku_name", sum((part(w, n) for w, n in zip(wanted, df)), F.lit(0.0)).alias("score"))
    return (rows.join(scored, "sku_name").orderBy(F.desc(F.round("score", 9)), "order_detail_id").limit(size))
