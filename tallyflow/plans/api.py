"""The query interface over the serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C
from tallyflow.operators import search
from tallyflow.plans import serving
from tallyflow.session import configure
from tallyflow.sources import tables
from tallyflow.sources.commits import Log


class RetailQueries:
    """Totals, hours and search over the tables the streaming jobs keep under ``root``.

    Each call reads only the days it asks for.  ``as_json`` forms give one row with the answer as
    JSON text.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = configure(spark), root

    def _dau(self, *days: str) -> DataFrame:
        return tables.read_dau(self.spark, self.root, *days)

    def _orders(self, *days: str) -> DataFrame:
        return tables.read_orders(self.spark, self.root, *days)

    def realtime_total(self, day: str) -> DataFrame:
        return serving.realtime_total(self._dau(day), self._orders(day), day)

    def realtime_total_json(self, day: str) -> DataFrame:
        figures = self.realtime_total(day).select(F.struct("id", "name", "value").alias("row"))
        return figures.agg(F.to_json(F.array_sort(F.collect_list("row"))).alias("result"))

    def _hour_rows(self, metric: str, day: str) -> DataFrame | None:
        days = (C.day_before(day), day)
        if metric == fixed.METRIC_DAU:
            return self._dau(*days)
        return self._orders(*days)

    def realtime_hour(self, metric: str, day: str) -> DataFrame | None:
        return serving.realtime_hour(metric, self._hour_rows(metric, day), day)

    def realtime_hour_json(self, metric: str, day: str) -> DataFrame | None:
        maps = serving.realtime_hour_maps(metric, self._hour_rows(metric, day), day)
        return maps and maps.select(
            F.to_json(F.struct("yesterday", "today")).alias("result"))

    def hour_figures(self, metric: str, day: str) -> DataFrame:
        """The same as ``realtime_hour`` from the figures the jobs keep: two days of at most 24 rows."""
        days = (C.day_before(day), day)
        return serving.hour_figures(tables.HOURS.read(self.spark, self.root, *days), metric, day)

    def search_index(self, day: str | None, keyword: str) -> DataFrame:
        """The sales of a day (``None``: of all) whose product name has all words, through the index.

        Only the files of the words' buckets are opened, then those of the days that were found.
        """
        spark, root = self.spark, self.root
        state = Log(spark, root).head()
        wanted = search.words_of(spark, keyword)
        found = tables.POSTINGS.read_keys(spark.createDataFrame([(w,) for w in wanted], "word string"), root, state)
        ids = search.posted(found if day is None else found.filter(F.col("dt") == day), len(wanted))
        # One row per day.
        per_day = ids.groupBy(F.coalesce("dt", F.lit("")).alias("dt")).agg(
            F.count(F.lit(1)).alias("n")).collect() if wanted else []
        # Only rows that were found are ranked; the key holds the id, so the newest of them are the same.
        found = tables.SALES.versions(spark, root, [r.dt for r in per_day], state).join(
            ids.select("order_detail_id"), "order_detail_id", "left_semi").select(*tables.SALES.schema.names, tables.VERSION)
        return tables.SALES.current(found, state, sum(r.n for r in per_day))

    def sale_detail(self, day: str, keyword: str | None, page: int,
                    size: int) -> dict[str, DataFrame]:
        return serving.sale_detail(tables.SALES.read(self.spark, self.root, day), day, keyword,
                                   page, size)

    def sale_detail_json(self, day: str, keyword: str | None, page: int, size: int) -> DataFrame:
        return serving.sale_detail_json(tables.SALES.read(self.spark, self.root, day), day,
                                        keyword, page, size)
