"""The commit log: one state for readers, batches counted once, parts gathered and swept."""

import json

import pytest
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.sources import commits, store, tables
from tallyflow.sources.commits import Log
from tallyflow.streaming import sinks


def users(spark, *rows):
    return spark.createDataFrame([(i, name, "1", None, "F", None) for i, name in rows], schemas.USER_TABLE)


def days_of(spark, *rows):
    return spark.createDataFrame([(m, *[None] * 7, "05", 1, day) for m, day in rows], schemas.DAU_TABLE)


def names(df):
    return sorted((r.id, r.login_name) for r in df.collect())


def part_folders(root, table):
    return sorted(p.name for p in (root / table.name / "parts").iterdir())


def test_a_file_is_put_in_place_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1")
    assert store.put_new(spark, path, "ä one") and not store.put_new(spark, path, "two")
    assert store.read_text(spark, path) == "ä one"
    assert [n for n, _ in store.listing(spark, str(tmp_path / "log")) if not n.startswith(".")] == ["1"]
    assert store.listing(spark, str(tmp_path / "none")) == []


def test_a_batch_counts_once_and_the_newest_row_wins(spark, tmp_path):
    root, job = str(tmp_path), commits.job_name(spark, str(tmp_path / "cp"))
    assert commits.job_name(spark, str(tmp_path / "cp")) == job != commits.job_name(spark, str(tmp_path / "cp2"))
    for batch, rows in [(0, [("1", "a")]), (1, [("1", "b"), ("2", "c")]), (1, [("1", "again")]), (0, [("1", "old")])]:
        sinks.commit_batch(spark, root, job, batch, lambda _, rows=rows: {tables.USERS: users(spark, *rows)})
    assert names(tables.USERS.read(spark, root)) == [("1", "b"), ("2", "c")]
    # A new checkpoint counts from 0 again and is not taken for the old one.
    sinks.commit_batch(spark, root, "another", 0, lambda _: {tables.USERS: users(spark, ("3", "d"))})
    assert len(names(tables.USERS.read(spark, root))) == 3
    assert Log(spark, root).head()["commit"] == 3


def test_readers_see_one_state(spark, tmp_path, monkeypatch):
    """Before, during and after a batch and a gathering; a writer killed between files and commit leaves nothing."""
    root = str(tmp_path)
    for k in range(3):
        tables.USERS.put(users(spark, ("1", f"v{k}"), (f"u{k}", "x")), root)
    began = tables.USERS.read(spark, root)
    before = names(began)
    seen = []
    put = store.put_new

    def watched(spark_, path, text):
        if "/_log/" in path:  # all files are written, the commit is not
            seen.append(names(tables.USERS.read(spark, root)))
        return put(spark_, path, text)

    monkeypatch.setattr(store, "put_new", watched)
    sinks.commit_batch(spark, root, "job", 0, lambda _: {tables.USERS: users(spark, ("1", "new"), ("9", "y"))})
    after = names(tables.USERS.read(spark, root))
    assert tables.gather(spark, tables.USERS, root, everything=True)
    assert seen == [before, after]
    assert names(tables.USERS.read(spark, root)) == after != before
    assert len(Log(spark, root).head()["tables"]["user_info_dim"]) == 1

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Log, "append", killed)
    with pytest.raises(KeyboardInterrupt):
        sinks.commit_batch(spark, root, "job", 1, lambda _: {tables.USERS: users(spark, ("1", "lost"))})
    assert names(tables.USERS.read(spark, root)) == after
    # What was read first is still there, although it was gathered meanwhile.
    assert names(began) == before


def test_two_writers_both_get_in(spark, tmp_path, monkeypatch):
    """A commit that comes in between is kept: the slower writer reads the new state and tries again."""
    root, put, raced = str(tmp_path), store.put_new, []

    def slow(spark_, path, text):
        if "/_log/" in path and not raced:
            raced.append(path)
            tables.USERS.put(users(spark, ("2", "fast")), root)
        return put(spark_, path, text)

    monkeypatch.setattr(store, "put_new", slow)
    tables.USERS.put(users(spark, ("1", "slow")), root)
    assert names(tables.USERS.read(spark, root)) == [("1", "slow"), ("2", "fast")]
    assert [p["commit"] for p in Log(spark, root).head()["tables"]["user_info_dim"]] == [1, 2]


def test_parts_are_gathered_by_level_and_swept(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(tables, "FAN", 3)
    for batch in range(10):
        sinks.commit_batch(spark, root, "job", batch, lambda _, b=batch: {
            tables.USERS: users(spark, ("all", f"v{b}"), (f"u{b}", "x"))})
    parts = Log(spark, root).head()["tables"]["user_info_dim"]
    # Nine batches as one part of two levels, and the last one.
    assert [p["level"] for p in parts] == [2, 0] and [p["rows"] for p in parts] == [10, 2]
    assert parts[0]["commit"] < parts[1]["commit"]
    found = dict(names(tables.USERS.read(spark, root)))
    assert found["all"] == "v9" and len(found) == 11
    # Nothing is old enough to go; then everything that no commit names is.
    given_up = set(part_folders(tmp_path, tables.USERS)) - {p["name"] for p in parts}
    assert given_up and Log(spark, root).sweep() == 0
    orphan = tables.USERS.write_part(users(spark, ("z", "z")), root)["name"]
    assert Log(spark, root).sweep(0) >= len(given_up)
    left = set(part_folders(tmp_path, tables.USERS))
    assert {p["name"] for p in parts} <= left and left <= {p["name"] for p in parts} | {orphan}
    assert dict(names(tables.USERS.read(spark, root))) == found
    assert len([n for n, _ in store.listing(spark, f"{root}/_log") if n.isdigit()]) == 1


def test_gathering_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for k in range(2):
        tables.USERS.put(users(spark, ("1", f"v{k}")), root)
    replace = Log.replace

    def late(log, table, old, part):
        tables.USERS.put(users(spark, ("1", "newest")), root)
        return replace(log, table, old, part)

    monkeypatch.setattr(Log, "replace", late)
    assert tables.gather(spark, tables.USERS, root, everything=True)
    assert names(tables.USERS.read(spark, root)) == [("1", "newest")]
    monkeypatch.undo()
    # Parts that another gathering took first are not replaced again.
    assert Log(spark, root).replace("user_info_dim", ["gone"], None) is None


def test_only_files_of_asked_days_are_opened(spark, tmp_path):
    root = str(tmp_path)
    tables.DAU.put(days_of(spark, ("a", "2024-01-01"), ("b", None)), root)
    for k in range(4):
        tables.DAU.put(days_of(spark, (f"c{k}", "2024-01-02"), ("d", "2024-01-03")), root)
    assert list(tables.DAU.files(spark, root, ["2024-01-01"])) == [1]
    assert [r.MID for r in tables.DAU.read(spark, root, "2024-01-01").collect()] == ["a"]
    assert tables.DAU.read(spark, root, "2024-01-09").count() == 0
    assert tables.DAU.read(spark, root).count() == 7
    tables.gather(spark, tables.DAU, root, everything=True)
    assert tables.DAU.read(spark, root).count() == 7 and tables.DAU.read(spark, root, "2024-01-02").count() == 4
    assert Log(spark, root).head()["tables"]["dau"][0]["rows"] == 7


def test_a_day_that_holds_most_rows_is_split(spark, tmp_path):
    root = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.DAU.put(days_of(spark, *[(f"m{k}", "2024-01-01") for k in range(900)], *[
            (f"m{k}", f"2024-02-{1 + k % 9:02d}") for k in range(100)]), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    part = Log(spark, root).head()["tables"]["dau"][0]
    files = json.loads(store.read_text(spark, f"{root}/dau/files/{part['name']}"))
    assert sum(low <= "2024-01-01" <= high for low, high, *_ in files) >= 3


@pytest.mark.parametrize("size", [2_000, 20_000])
def test_buyers_open_their_buckets_only(spark, tmp_path, size):
    """However large the dimension, a batch opens a file or two for each of its buyers."""
    root = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(size // 100))  # files of even size
    try:
        tables.USERS.put(spark.range(size).select(
            F.col("id").cast("string").alias("id"), F.lit("a").alias("login_name"), F.lit("1").alias("user_level"),
            F.lit(None).cast("string").alias("birthday"), F.lit("F").alias("gender"),
            F.lit(None).cast("timestamp").alias("arrival")), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    tables.USERS.put(users(spark, ("7", "newer")), root)
    buyers = spark.createDataFrame([("7",), ("8",), ("1999",), ("nobody",), ("7",)], "id string")
    rows = tables.USERS.read_keys(buyers, root)
    assert names(rows) == [("1999", "a"), ("7", "newer"), ("8", "a")]
    wanted = [r.b for r in buyers.select(tables.bucket("id").alias("b")).distinct().collect()]
    opened = sum(map(len, tables.USERS.files(spark, root, wanted).values()))
    assert opened <= 2 * 4 + 1 < size // 100
    none = spark.createDataFrame([], "id string")
    assert tables.USERS.read_keys(none, root).count() == 0


def test_expired_panes_leave_the_table(spark, tmp_path):
    root = str(tmp_path)
    for k in range(3):
        tables.PANES.put(spark.createDataFrame([(10 * k, "m", "event", "e", 1)], schemas.PANE_TABLE), root)
    assert tables.expire(spark, tables.PANES, root, 20) and not tables.expire(spark, tables.PANES, root, 20)
    assert [r.pane for r in tables.PANES.read(spark, root).collect()] == [20]
    assert tables.PANES.versions(spark, root, since=21).count() == 0


def test_a_page_opens_the_files_that_hold_it(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(5000).select(F.format_string("%05d", (F.col("id") * 7919) % 5000).alias("order_detail_id"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SALE_TABLE.fields[1:]])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.PAGES.put(rows.where("order_detail_id < '04000'"), root)
        tables.PAGES.put(rows.where("order_detail_id >= '03990'"), root)
        with pytest.raises(ValueError):
            tables.PAGES.page(spark, root, 1, 10)
        assert tables.gather(spark, tables.PAGES, root, everything=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    every = tables.PAGES.files(spark, root)
    assert len(sum(every.values(), [])) >= 4
    for page, size in ((1, 10), (400, 10), (500, 10), (3, 1700)):
        got = tables.PAGES.page(spark, root, page, size)
        want = [f"{k:05d}" for k in range(5000)[(page - 1) * size:page * size]]
        assert [r.order_detail_id for r in got.collect()] == want
        assert size > 10 or len(got.inputFiles()) <= 2
    assert tables.PAGES.page(spark, root, 501, 10).count() == 0


def test_newest_rows_are_sorted_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for name in ("old", "new"):
        tables.USERS.put(users(spark, *[(str(k), name) for k in range(600)]), root)
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    keys = spark.createDataFrame([(str(k),) for k in range(600)], "id string")
    rows = tables.USERS.read_keys(keys, root)
    assert rows.rdd.getNumPartitions() == 12  # 1200 noted rows, though four tasks would do by their size
    assert names(rows) == sorted((str(k), "new") for k in range(600))
