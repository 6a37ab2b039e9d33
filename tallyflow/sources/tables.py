"""Serving tables: Parquet parts under a commit log, read as the newest row of each key.

Layout: ``<root>/<table>/parts/<part>/*.parquet``, and ``<root>/<table>/files/<part>`` with the least and the largest
layout value of each file.  The layout value of a row is its day, a number column, or the bucket of its key's hash; a read of
some days (or keys) opens the files whose range holds one of them, and no others.

A batch adds a part.  ``gather`` writes ``FAN`` neighbouring parts of one level as one part of the next, in ranges
of the layout value, so a table has at most a few parts of each level however many batches it has
seen, and a row is rewritten once per level.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow import fixed, schemas
from tallyflow.operators.latest import latest_per_key, one_per_key
from tallyflow.session import shuffle_tasks
from tallyflow.sources import store
from tallyflow.sources.commits import Log
from tallyflow.sources.slices import CODEC, freed

VERSION = "version"
FAN = 8
BUCKETS = 4096
# Rows that one task sorts: their number, not their packed bytes, decides its memory.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    return max(shuffle_tasks(spark), -(-rows // TASK_ROWS))


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def _holds(low, high, wanted: list) -> bool:
    """Is one of the sorted values in the range?"""
    k = bisect_left(wanted, low)
    return k < len(wanted) and wanted[k] <= high


@dataclass(frozen=True)
class ServingTable:
    """Rows with a key; a later row of a key replaces the earlier one.

    Rows are laid out by ``day`` (a text column; null comes first) or by ``number`` (a column of whole
    numbers), else by the bucket of the first column of the key.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    day: str | None = None
    number: str | None = None

    def folder(self, root: str) -> str:
        return f"{root}/{self.name}"

    @property
    def layout(self) -> Column:
        if self.day:
            return F.coalesce(F.col(self.day), F.lit(""))
        return F.col(self.number) if self.number else bucket(self.key[0])

    # --- writing -----------------------------------------------------------------------------

    def write_part(self, rows: DataFrame, root: str, ranged: int | None = None, level: int = 0) -> dict | None:
        """Write rows as a part that no commit names yet; None if there are none.

        A batch is spread to files of even size; ``ranged``, the number of rows (0: unknown), also sorts it into ranges
        of the layout value, which reads the rows twice.  A day that holds most rows is split, as the key belongs to the range.
        """
        name, spark = uuid.uuid4().hex, rows.sparkSession
        self._write(self._spread(self._typed(rows), ranged), root, name)
        return self._noted(spark, root, name, level)

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _spread(self, typed: DataFrame, ranged: int | None) -> DataFrame:
        order = [self.layout, *[F.col(k) for k in self.key]]
        spark = typed.sparkSession
        if ranged and ranged > TASK_ROWS * shuffle_tasks(spark):
            return typed.repartitionByRange(tasks_for(spark, ranged), *order).sortWithinPartitions(*order)
        if ranged is not None:
            return typed.repartitionByRange(*order).sortWithinPartitions(*order)
        return typed.hint("rebalance")

    def _write(self, rows: DataFrame, root: str, name: str) -> None:
        rows.write.mode("append").option("compression", CODEC).parquet(f"{self.folder(root)}/parts/{name}")

    def _noted(self, spark: SparkSession, root: str, name: str, level: int, **more) -> dict | None:
        """The ranges of a part's files, put beside it: one row per file."""
        files = sorted((r.low, r.high, r.file, r.n) for r in (
            spark.read.schema(self.schema).parquet(f"{self.folder(root)}/parts/{name}")
            .select(F.col("_metadata.file_name").alias("file"), self.layout.alias("by"))
            .groupBy("file").agg(F.min("by").alias("low"), F.max("by").alias("high"), F.count(F.lit(1)).alias("n"))
            .collect()))
        if not files:
            return None
        store.put_new(spark, f"{self.folder(root)}/files/{name}", json.dumps(files))
        return {"name": name, "level": level, "rows": sum(f[3] for f in files), "low": files[0][0],
                "high": max(f[1] for f in files), **more}

    def put(self, rows: DataFrame, root: str, job: str | None = None, batch: int = 0) -> None:
        """Write and commit rows at once, in ranges: for tables that are filled in bulk."""
        log = Log(rows.sparkSession, root)
        if job is None or not log.has(job, batch):
            log.append({self.name: self.write_part(rows, root, ranged=0)}, job, batch)

    def put_pieces(self, spark: SparkSession, pieces: Iterable[DataFrame], root: str, cuts: Sequence = ()) -> None:
        """``put`` of rows that come in pieces, with one row per key.

        The pieces are laid aside one by one, by the ranges of the layout value between the ``cuts``, and each
        range is sorted into files by itself; so the disk holds the shuffle files of a piece or a range at a time.  Without cuts
        there is one piece.  Aside is a part that no commit names.
        """
        name, aside = uuid.uuid4().hex, uuid.uuid4().hex
        folder = f"{self.folder(root)}/parts/{aside}"
        number = sum((F.when(self.layout >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))

        def once(rows: DataFrame) -> DataFrame:
            """In the order of the files rows of one key are neighbours, so this shuffles nothing."""
            by, keys = F.col("_layout"), [F.col(k) for k in self._keys]
            ranged = rows.withColumn("_layout", self.layout).repartitionByRange(by, *keys)
            return one_per_key(ranged.sortWithinPartitions(by, *keys), [by, *keys], [by]).drop("_layout")

        with freed(spark):
            if not cuts:
                self._write(once(self._typed(next(iter(pieces)))), root, name)
            else:
                for piece in pieces:
                    (self._typed(piece).withColumn("_slice", number).write.mode("append").option("compression", CODEC)
                     .partitionBy("_slice").parquet(folder))
                for k in range(len(cuts) + 1):
                    held = f"{folder}/_slice={k}"
                    if store.exists(spark, held):
                        self._write(once(spark.read.schema(self.schema).parquet(held)), root, name)
                        store.delete(spark, held)
                store.delete(spark, folder)
            Log(spark, root).append({self.name: self._noted(spark, root, name, 0, once=True)})

    # --- reading -----------------------------------------------------------------------------

    def listed(self, spark: SparkSession, root: str, part: dict) -> list[list]:
        """(low, high, name, rows) of the files of a part, in order."""
        return json.loads(store.read_text(spark, f"{self.folder(root)}/files/{part['name']}"))

    def files(self, spark: SparkSession, root: str, wanted: Sequence | None = None,
              state: dict | None = None, since=None) -> dict[int, list[str]]:
        """commit -> the files of one state that may hold a wanted layout value (None: any), ``since`` or later."""
        state = Log(spark, root).head() if state is None else state
        values = None if wanted is None else sorted(set(wanted))

        def open_for(low, high) -> bool:
            return (since is None or high >= since) and (values is None or _holds(low, high, values))

        found: dict[int, list[str]] = {}
        base = self.folder(root)
        for part in state["tables"].get(self.name, []):
            if open_for(part["low"], part["high"]):
                for low, high, file, _ in self.listed(spark, root, part):
                    if open_for(low, high):
                        found.setdefault(part["commit"], []).append(f"{base}/parts/{part['name']}/{file}")
        return found

    def versions(self, spark: SparkSession, root: str, wanted: Sequence | None = None,
                 state: dict | None = None, since=None) -> DataFrame:
        """All rows of these files with the number of their commit."""
        found = self.files(spark, root, wanted, state, since)
        if not found:
            return self.none(spark).withColumn(VERSION, F.lit(0).cast("long"))
        return reduce(DataFrame.unionByName, [
            spark.read.schema(self.schema).parquet(*paths).withColumn(VERSION, F.lit(n).cast("long"))
            for n, paths in found.items()])

    def none(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def part_rows(self, spark: SparkSession, root: str, part: dict) -> DataFrame:
        """The rows of a part, committed or not."""
        return spark.read.schema(self.schema).parquet(f"{self.folder(root)}/parts/{part['name']}")

    def rows_in(self, spark: SparkSession, root: str, wanted: Sequence | None, state: dict | None) -> int:
        """How many rows the files hold that may have a wanted layout value: noted with them, not counted."""
        state = Log(spark, root).head() if state is None else state
        values = None if wanted is None else sorted(set(wanted))
        return sum(n for part in state["tables"].get(self.name, [])
                   if values is None or _holds(part["low"], part["high"], values)
                   for low, high, _, n in self.listed(spark, root, part) if values is None or _holds(low, high, values))

    def latest(self, rows: DataFrame, n: int = 0) -> DataFrame:
        """The newest row of each key; ``n`` is the number of rows, where it is known.

        Many rows are dealt to tasks of ``TASK_ROWS`` before they are sorted: by size, a task is given the more rows the
        better they pack.
        """
        if n > TASK_ROWS:
            rows = rows.repartition(tasks_for(rows.sparkSession, n), *self._keys)
        return latest_per_key(rows, self._keys, [VERSION]).drop(VERSION)

    @property
    def _keys(self) -> list[str]:
        # A key never changes its day, so the day may join the key and a filter on it is pushed through
        # the ranking.
        return [*self.key, *([self.day] if self.day and self.day not in self.key else [])]

    def once(self, state: dict) -> bool:
        """Does one part hold all rows, one of each key?  Then nothing has to be ranked."""
        parts = state["tables"].get(self.name, [])
        return len(parts) == 1 and parts[0].get("once", False)

    def current(self, rows: DataFrame, state: dict, n: int = 0) -> DataFrame:
        """The newest row of each key of some ``versions`` of a state."""
        return rows.drop(VERSION) if self.once(state) else self.latest(rows, n)

    def read(self, spark: SparkSession, root: str, *days: str, state: dict | None = None) -> DataFrame:
        """The current rows, of the given days or of all."""
        state = Log(spark, root).head() if state is None else state
        rows = self.versions(spark, root, days or None, state)
        return self.current(rows.filter(F.col(self.day).isin(*days)) if days else rows, state)

    def page(self, spark: SparkSession, root: str, page: int, size: int) -> DataFrame:
        """Page ``page`` (from 1) of ``size`` rows in order of layout value and key, from a table in one part.

        The rows of each file are known, and files hold ranges one after the other; so the files before the page
        are counted, not read.
        """
        parts = Log(spark, root).head()["tables"].get(self.name, [])
        if len(parts) > 1:
            raise ValueError(f"gather {self.name} before it is paged")
        first, at, chosen, before = (page - 1) * size, 0, [], 0
        for part in parts:
            for _, _, name, n in self.listed(spark, root, part):
                if at < first + size and at + n > first:
                    before = before if chosen else at
                    chosen.append(f"{self.folder(root)}/parts/{part['name']}/{name}")
                at += n
        if not chosen:
            return self.none(spark)
        rows = spark.read.schema(self.schema).parquet(*chosen)
        return rows.orderBy(self.layout, *self.key).offset(first - before).limit(size)

    def read_keys(self, keys: DataFrame, root: str, state: dict | None = None) -> DataFrame:
        """The current rows of the given keys (the first columns of the table's, under their names); only the
        files of their buckets are opened.  The driver sees the numbers of the buckets, at most ``BUCKETS``."""
        spark = keys.sparkSession
        wanted = [r.b for r in keys.select(bucket(self.key[0]).alias("b")).distinct().collect()]
        state = Log(spark, root).head() if state is None else state
        rows = self.versions(spark, root, wanted, state)
        names = [k for k in self.key if k in keys.columns]
        return self.current(rows.join(keys.select(*names).distinct(), names, "left_semi"), state,
                            self.rows_in(spark, root, wanted, state))


def gather(spark: SparkSession, table: ServingTable, root: str, everything: bool = False) -> bool:
    """Write the newest parts of one level as one part, once there are ``FAN`` of them (or all parts of the
    table); readers keep what they have begun with."""
    log = Log(spark, root)
    state = log.head()
    parts = state["tables"].get(table.name, [])
    tail = len(parts)
    while tail and (everything or parts[tail - 1]["level"] == parts[-1]["level"]):
        tail -= 1
    old = parts[tail:]
    if len(old) < (2 if everything else FAN):
        return False
    rows = table.versions(spark, root, None, {"tables": {table.name: old}})
    part = table.write_part(table.latest(rows), root, ranged=sum(p["rows"] for p in old), level=1 + max(p["level"] for p in old))
    # It stands where the newest of the old ones stood, before what was added meanwhile.
    done = log.replace(table.name, [p["name"] for p in old], part and {
        **part, "commit": max(p["commit"] for p in old)})
    return done is not None


def expire(spark: SparkSession, table: ServingTable, root: str, before, at_once: bool = False) -> bool:
    """Take the parts out of the table that hold only layout values less than ``before``; ``at_once``: delete them, too, if
    nobody else reads the table."""
    log = Log(spark, root)
    old = [p["name"] for p in log.head()["tables"].get(table.name, []) if p["high"] < before]
    done = bool(old) and log.replace(table.name, old, None) is not None
    if done and at_once:
        for name in old:
            store.delete(spark, f"{table.folder(root)}/parts/{name}")
            store.delete(spark, f"{table.folder(root)}/files/{name}")
    return done


def tidy(spark: SparkSession, root: str, *named: ServingTable) -> None:
    """Gather what is due, level by level, and sweep what is given up."""
    due = False
    for table in named:
        while gather(spark, table, root):
            due = True
    if due:
        Log(spark, root).sweep()


DAU = ServingTable("dau", schemas.DAU_TABLE, ("MID", "LOG_DATE"), "LOG_DATE")
ORDERS = ServingTable("order_info", schemas.ORDER_TABLE, ("ID",), "CREATE_DATE")
SALES = ServingTable("sale_detail", schemas.SALE_TABLE, ("order_detail_id",), "dt")
ALERTS = ServingTable("coupon_alert", schemas.ALERT_TABLE, ("alert_id",), "alert_date")
USERS = ServingTable("user_info_dim", schemas.USER_TABLE, ("id",))
# Which sales have a word, laid out by the hash of the word.
POSTINGS = ServingTable("sale_posting", schemas.POSTING_TABLE, ("word", "order_detail_id"))
# Sales in order of their ids, for paging.
PAGES = ServingTable("sale_page", schemas.SALE_TABLE, ("order_detail_id",), "order_detail_id")
# Lines and orders that met no partner within the wait; an order has no line.
UNMATCHED = ServingTable("sale_unmatched", schemas.UNMATCHED_TABLE, ("order_id", "order_detail_id"))
# Figures by hour, kept up to date by the jobs that write the rows they count.
HOURS = ServingTable("hour_figure", schemas.HOUR_TABLE, ("metric", "day", "hour"), "day")
# Devices that started on a day.
SEEN = ServingTable("seen_device", schemas.SEEN_TABLE, ("mid", "log_date"), "log_date")
# Counted parts of device profiles, as long as a window may need them.
PANES = ServingTable("alert_pane", schemas.PANE_TABLE, ("pane", "mid", "kind", "name"), number="pane")


def waiting(job: str) -> ServingTable:
    """Orders and lines of a job's batches by their time, as long as a partner may come; every row is kept."""
    return ServingTable(f"sale_waiting_{job}", schemas.WAITING_TABLE, ("batch", "row"), number="at")


def _records(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.select([F.col(c).alias(f) for f, c in columns.items()])


def read_dau(spark: SparkSession, root: str, *days: str, state: dict | None = None) -> DataFrame:
    """The DAU table under its record field names."""
    return _records(DAU.read(spark, root, *days, state=state), fixed.DAU_COLUMNS)


def read_orders(spark: SparkSession, root: str, *days: str, state: dict | None = None) -> DataFrame:
    return _records(ORDERS.read(spark, root, *days, state=state), fixed.ORDER_COLUMNS)
