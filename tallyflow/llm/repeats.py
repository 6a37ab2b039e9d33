"""Finding repeated windows across documents: what the byte and the word operator share.

An operator cuts every text into pieces: runs of neighbouring windows under one key.  The key
depends on the content of each of these windows alone, so equal windows meet under equal keys.

0. ``identified``: copies of a whole text are settled by its hashes; only the first goes on.
1. ``shared_keys``: keys go to buckets as packed arrays.  A task sends a key once per batch of
   documents, however many of them have it, and settles on the spot which of its documents
   share it; these stay with the batch, and the bucket only tells the batch whether the key is hot.  So a
   key of a third of all documents costs its bucket a few bytes per batch, not per document.
2. ``repeated_windows``: only pieces with shared keys are sent on, again once per batch and equal
   content; what is settled in the batch goes by its bucket.  A bucket compares whole pieces first,
   then the windows of those that differ.
   A key with more than ``HOT`` documents is cut into single windows that are dealt out by
   their own content, so a passage in very many different surroundings does not meet in one task.
3. The removed windows of a document go back to it by id.

Keys, pieces and windows are named by 64 bits.  Keys only bring windows together; pieces and windows
that share a name are compared byte by byte (word by word) before one is removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.llm.hashing import U, slices
from tallyflow.llm.shipping import ship
from tallyflow.session import shuffle_tasks

# Entries that a task gathers before it packs them, documents of a hot key, buckets per partition.
BATCH, HOT, BUCKETS = 1 << 20, 10_000, 4
# Texts are cut into pieces about so many bytes at a time, whose names stay in a core's cache.
CUT = 1 << 17
NO_ID = (1 << 63) - 1


class Pieces:
    """Pieces of a few texts: ``text``, ``key``, ``start`` (first window, counted in its text) and
    ``n`` (windows)."""

    text: np.ndarray
    key: np.ndarray
    start: np.ndarray
    n: np.ndarray

    def split(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, key, start, n) with the marked pieces cut into single windows under own names."""
        raise NotImplementedError

    def content(self, text: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Payload of pieces (bytes), its size for each, and the name of each content."""
        raise NotImplementedError


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places first, first + 1, ... of each run, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def pack(values: np.ndarray) -> bytes:
    """Least number, width in bytes, and differences; ids of a batch are near each other."""
    if not len(values):
        return b""
    low = int(values.min())
    off = (values - low).astype("<u8")
    width = max(1, (int(off.max()).bit_length() + 7) // 8)
    return np.int64(low).tobytes() + bytes([width]) + off.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    low, width = np.frombuffer(data[:8], np.int64)[0], data[8]
    out = np.zeros(((len(data) - 9) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    return out.view("<i8")[:, 0] + low


def place(doc: np.ndarray, version: np.ndarray) -> np.ndarray:
    """What documents are compared by: their ids; rows without an id come last."""
    return np.where(version & 1, NO_ID, doc)


def _place(doc: str = "doc") -> Column:
    return F.when(F.col("version").bitwiseAND(F.lit(1)) == 0, F.col(doc)).otherwise(F.lit(NO_ID))


def identified(docs: DataFrame) -> DataFrame:
    """(doc, version, packed, first) of every row of documents.

    ``doc`` is the id, or a hash of the text where there is none, so rows without id do not meet in one place.
    ``version`` tells rows of one ``doc`` with different texts apart: 0 where an id has one
    text, else 62 bits of a hash of the text; its lowest bit marks rows without id.  ``packed`` is the compressed
    text, ``first`` the least id with this text.  All steps join the
    same rows by ``doc``, so Spark shuffles the texts once and reads the exchange again.
    """
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for batch in batches:
            texts = [packer.compress((t or "").encode()) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.binary())],
                                             names=["doc", "nameless", "own", "packed"])

    ship(docs.sparkSession)
    text, id_ = F.coalesce("text", F.lit("")), F.col("doc_id").cast("long")
    plain = docs.select(F.coalesce(id_, F.xxhash64(F.lit(2), text)).alias("doc"), id_.isNull().alias("nameless"),
                        F.xxhash64(text).alias("own"), text.alias("text"))
    # Not nullable, so that no join adds a filter of its own and all share one exchange.
    texts = plain.mapInArrow(squeeze, T.StructType([
        T.StructField("doc", T.LongType(), False), T.StructField("nameless", T.BooleanType(), False),
        T.StructField("own", T.LongType(), False), T.StructField("packed", T.BinaryType(), False)]))
    name = ["own", "far", "size"]
    named = plain.select("doc", "nameless", "own", F.xxhash64(F.lit(1), "text").alias("far"),
                         F.octet_length("text").alias("size"))
    firsts = named.groupBy(*name).agg(F.min(F.when(~F.col("nameless"), F.col("doc")).otherwise(
        F.lit(NO_ID))).alias("first"))
    known = (named.distinct().join(firsts, name).groupBy("doc")
             .agg(F.collect_list(F.struct("own", "first")).alias("firsts")))
    mine = F.get(F.filter("firsts", lambda x: x["own"] == F.col("own")), F.lit(0))
    hashed = F.col("own").bitwiseAND(F.lit(~3)).bitwiseOR(F.lit(2)).bitwiseOR(F.col("nameless").cast("long"))
    alone = (F.size("firsts") == 1) & ~F.col("nameless")
    return texts.join(known, "doc").select(
        "doc", F.when(alone, F.lit(0).cast("long")).otherwise(hashed).alias("version"), "packed",
        mine["first"].alias("first"))


def originals(texts: DataFrame) -> DataFrame:
    """Rows that are not copies of a text with a smaller id."""
    return texts.where(F.col("first") == _place()).drop("first")


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Are the stretches of ``size`` bytes at a and at b the same?"""
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(9, np.uint8)]), strides=(1,))
    out, pick, at = np.ones(len(a), bool), np.flatnonzero((size > 0) & (a != b)), 0
    while len(pick):
        left = size[pick] - at
        differ = eight[a[pick] + at] ^ eight[b[pick] + at]
        part = left < 8
        differ[part] &= (U(1) << (U(8) * left[part].astype(np.uint64))) - U(1)
        out[pick[differ != 0]] = False
        pick = pick[(left > 8) & (differ == 0)]
        at += 8
    return out


def true_names(keys: np.ndarray, names: np.ndarray, data: np.ndarray, first: np.ndarray,
               size: np.ndarray) -> np.ndarray:
    """Names under which stretches of one key are equal only if their bytes are: those that share a
    name with other bytes get one of their own."""
    k = 0
    while True:
        order = np.lexsort((names, keys))
        lead = order[np.flatnonzero(group_starts(keys[order], names[order]))][
            np.cumsum(group_starts(keys[order], names[order])) - 1]
        wrong = order[(size[order] != size[lead]) | ~equal_bytes(data, first[order], first[lead], np.minimum(
            size[order], size[lead]))]
        if not len(wrong):
            return names
        k, names = k + 1, names.copy()
        for i in wrong.tolist():
            names[i] = xxhash.xxh3_64_intdigest(data[first[i]:first[i] + size[i]].tobytes(), seed=k)


def unsqueezed(column: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(x.as_buffer()) for x in column]


def _by(batches: Iterator[pa.RecordBatch], column: str, work: Callable) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a column, handed on together where they share its value."""
    held, value = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[column] != value:
                yield work(held)
                held = []
            value = row[column]
            held.append(row)
    if held:
        yield work(held)


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each key, by its upper half: keys in order have their buckets in order."""
    return ((key >> U(32)) * U(n) >> U(32)).astype(np.int64)


def by_key(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Order by key and document; only entries that share a key are sorted by both."""
    order = np.argsort(key)
    group = np.cumsum(group_starts(key[order])) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    order[several] = order[several][np.lexsort((doc[order[several]], group[several]))]
    return order


def _bucket_parts(bucket: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    cuts = np.searchsorted(bucket, np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(int(cuts[b]), int(cuts[b + 1]))


def _batch_name(flushed: int) -> int:
    """Number of a batch of entries: the same when a lost task runs again."""
    return (TaskContext.get().partitionId() << 32) | flushed


def _aside(batch: int, n_buckets: int) -> int:
    """A bucket behind the others, for what a batch has settled and nobody has to meet."""
    return n_buckets + xxhash.xxh3_64_intdigest(batch.to_bytes(8, "little")) % n_buckets


def key_entries(texts: DataFrame, cut: Callable[[list[bytes]], Pieces], within: bool) -> DataFrame:
    """Keys of the originals by bucket, packed: see ``KEY_ROWS``.

    ``keys`` are those that one document of the batch has, with the documents; ``seen`` those that several have (``within``:
    or one has twice), with the number of documents.  The documents of these are in a bucket aside.
    """
    n_buckets = BUCKETS * shuffle_tasks(texts.sparkSession)

    def flush(keys: list, owners: list, batch: int) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(owners)
        order = by_key(key, doc)
        key, doc = key[order], doc[order]
        bucket = bucket_of(key, n_buckets)
        new, once = group_starts(key), group_starts(key, doc)
        group = np.cumsum(new) - 1
        distinct = np.bincount(group, once).astype(np.int64)
        many = (np.bincount(group) if within else distinct)[group] > 1
        rows = []
        for b, part in _bucket_parts(bucket, n_buckets):
            k, d, m, first, one = key[part], doc[part], many[part], new[part], once[part]
            rows.append({"bucket": b, "batch": batch, "keys": k[~m & one].tobytes(), "docs": pack(d[~m & one]),
                         "seen": k[m & first].tobytes(), "seen_docs": pack(distinct[group[part]][m & first])})
        rows.append({"bucket": _aside(batch, n_buckets), "batch": batch, "keys": b"", "docs": pack(doc[many & once]),
                     "seen": key[many & new].tobytes(), "seen_docs": pack(distinct[group[many & new]])})
        return pa.RecordBatch.from_pylist(rows, schema=KEY_ROWS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held, flushed = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                ids, own = few.column(0).to_numpy(), unsqueezed(few.column(1))
                for a, b in slices(own, CUT):
                    pieces = cut(own[a:b])
                    keys.append(pieces.key)
                    owners.append(ids[a:b][pieces.text])
                    held += len(pieces.key)
                if held >= BATCH:
                    yield flush(keys, owners, _batch_name(flushed))
                    keys, owners, held, flushed = [], [], 0, flushed + 1
        if held:
            yield flush(keys, owners, _batch_name(flushed))

    return originals(texts).select("doc", "packed").mapInArrow(
        send, "bucket int, batch long, keys binary, docs binary, seen binary, seen_docs binary")


def shared_keys(texts: DataFrame, cut: Callable[[list[bytes]], Pieces], within: bool) -> DataFrame:
    """(doc, keys, hot_keys) of the keys that several originals have (``within``: or one has twice);
    rows that share a ``doc`` may have a row each."""
    tasks = shuffle_tasks(texts.sparkSession)
    n_buckets = BUCKETS * tasks

    def meet(rows: list[dict]) -> pa.RecordBatch:
        """To each batch: which of its single keys are shared, and which of all are hot."""
        if rows[0]["bucket"] >= n_buckets:
            return pa.RecordBatch.from_pylist([{
                "batch": r["batch"], "keys": r["seen"], "counts": r["seen_docs"], "docs": r["docs"], "hot": b""}
                for r in rows], schema=FOUND_ROWS)
        own = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        seen = [np.frombuffer(r["seen"], np.uint64) for r in rows]
        n_own, n_seen = sum(map(len, own)), np.concatenate([unpack(r["seen_docs"]) for r in rows])
        names, at = np.unique(np.concatenate([*own, *seen]), return_inverse=True)
        shared = np.bincount(at, minlength=len(names)) > 1
        shared[at[n_own:]] = True
        hot = np.bincount(at, np.concatenate([np.ones(n_own), n_seen]), minlength=len(names)) > HOT
        out, a, b = [], 0, n_own
        for row, mine, met in zip(rows, own, seen):
            keep = shared[at[a:a + len(mine)]]
            burnt = [mine[hot[at[a:a + len(mine)]]], met[hot[at[b:b + len(met)]]]]
            a, b = a + len(mine), b + len(met)
            out.append({"batch": row["batch"], "keys": mine[keep].tobytes(),
                        "counts": pack(np.ones(keep.sum(), np.int64)), "docs": pack(unpack(row["docs"])[keep]),
                        "hot": np.concatenate(burnt).tobytes()})
        return pa.RecordBatch.from_pylist([r for r in out if r["keys"] or r["hot"]], schema=FOUND_ROWS)

    def gather(rows: list[dict]) -> pa.RecordBatch:
        """A batch's shared keys, document by document."""
        key = np.concatenate([np.repeat(np.frombuffer(r["keys"], np.uint64), unpack(r["counts"])) for r in rows])
        doc = np.concatenate([unpack(r["docs"]) for r in rows])
        hot = np.isin(key, np.concatenate([np.frombuffer(r["hot"], np.uint64) for r in rows]))
        order = np.argsort(doc, kind="stable")
        key, doc, hot = key[order].view(np.int64), doc[order], hot[order]
        starts = np.flatnonzero(group_starts(doc))
        ends = np.append(starts, len(doc))
        n_hot = np.concatenate([[0], np.cumsum(hot)])
        lists = lambda values, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[starts]), lists(key, ends), lists(key[hot], n_hot[ends])], names=["doc", "keys", "hot_keys"])

    met = (key_entries(texts, cut, within).repartition(tasks, "bucket").sortWithinPartitions("bucket")
           .mapInArrow(lambda batches: _by(batches, "bucket", meet),
                       "batch long, keys binary, counts binary, docs binary, hot binary"))
    return (met.repartition(tasks, "batch").sortWithinPartitions("batch")
            .mapInArrow(lambda batches: _by(batches, "batch", gather),
                        "doc long, keys array<long>, hot_keys array<long>"))


KEY_ROWS = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), *[(c, pa.binary()) for c in (
    "keys", "docs", "seen", "seen_docs")]])
FOUND_ROWS = pa.schema([("batch", pa.int64()), *[(c, pa.binary()) for c in ("keys", "counts", "docs", "hot")]])
PIECE_ROWS = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in (
    "keys", "payload", "sizes", "owner", "docs", "versions", "starts", "ns")]])
REMOVED = "doc long, version long, start long, n long"


def repeated_windows(texts: DataFrame, flagged: DataFrame, cut: Callable[[list[bytes]], Pieces],
                     settle: Callable, within: bool) -> DataFrame:
    """Removed windows (doc, version, start, n) of all documents.

    ``settle(keys, payload, sizes, docs, versions, starts)`` gives, for the windows of all given pieces in a
    row, which are removed; ``texts`` is ``identified(docs)``, ``flagged`` is ``shared_keys(texts)``.
    """
    tasks = shuffle_tasks(texts.sparkSession)
    n_buckets = BUCKETS * tasks

    def flush(held: list[tuple], batch: int) -> pa.RecordBatch:
        key, name, doc, version, start, n, size = (np.concatenate([h[i] for h in held]) for i in range(7))
        payload = np.concatenate([h[7] for h in held])
        bucket = bucket_of(key, n_buckets)
        at, rank = np.cumsum(size) - size, place(doc, version)
        name = true_names(key, name, payload, at, size)
        order = np.lexsort((start, version, doc, rank, name, key))
        key, name, doc, version, rank, start, n, size, at, bucket = (
            x[order] for x in (key, name, doc, version, rank, start, n, size, at, bucket))
        new = group_starts(key, name)
        group = np.cumsum(new) - 1
        lead = np.flatnonzero(new)
        # Equal pieces: all but those of the least document (or the first one) are settled here.
        # The same place of the same text can come twice, from a repeated row.
        packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        once = group_starts(key, name, doc, version, start)
        stay = new if within else once & (rank == rank[lead][group])
        same = np.ones(len(key), bool)
        for column in (doc, version, start) if within else (rank,):
            same &= column == column[lead][group]
        rows = []
        for b, part in _bucket_parts(bucket, n_buckets):
            first = np.flatnonzero(new[part]) + part.start
            s = np.flatnonzero(stay[part]) + part.start
            rows.append({
                "bucket": b, "keys": key[first].tobytes(),
                "payload": packer.compress(payload[ragged(at[first], size[first])].tobytes()),
                "sizes": pack(size[first]), "owner": pack(group[s] - group[part.start]),
                "docs": pack(doc[s]), "versions": pack(version[s]), "starts": pack(start[s]), "ns": b""})
        rows.append({"bucket": _aside(batch, n_buckets), **dict.fromkeys(("keys", "payload", "sizes", "owner"), b""),
                     "docs": pack(doc[~same]), "versions": pack(version[~same]), "starts": pack(start[~same]),
                     "ns": pack(n[~same])})
        return pa.RecordBatch.from_pylist(rows, schema=PIECE_ROWS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, flushed = [], 0, 0
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                texts = unsqueezed(few.column(2))
                shared, hot = few.column(3), few.column(4)
                for a, b in slices(texts, CUT):
                    pieces = cut(texts[a:b])
                    cuts = np.searchsorted(pieces.text, np.arange(b - a + 1))
                    keep, burn = np.zeros(len(pieces.key), bool), np.zeros(len(pieces.key), bool)
                    for k in range(b - a):
                        own = slice(cuts[k], cuts[k + 1])
                        keep[own] = np.isin(pieces.key[own], shared[a + k].values.to_numpy().view(np.uint64))
                        if len(hot[a + k]):
                            burn[own] = np.isin(pieces.key[own], hot[a + k].values.to_numpy().view(np.uint64))
                    for part in ("text", "key", "start", "n"):
                        setattr(pieces, part, getattr(pieces, part)[keep])
                    text, key, start, n = pieces.split(burn[keep])
                    if not len(text):
                        continue
                    payload, size, name = pieces.content(text, start, n)
                    held.append((key, name, ids[at + a:at + b][text], versions[at + a:at + b][text],
                                 start, n, size, payload))
                    count += len(key)
                    if count >= BATCH // 8:
                        yield flush(held, _batch_name(flushed))
                        held, count, flushed = [], 0, flushed + 1
        if held:
            yield flush(held, _batch_name(flushed))

    def meet(rows: list[dict]) -> pa.RecordBatch:
        doc, version, start = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("docs", "versions", "starts"))
        if rows[0]["bucket"] >= n_buckets:
            return windows(doc, version, start, np.concatenate([unpack(r["ns"]) for r in rows]))
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        counts = [len(r["keys"]) // 8 for r in rows]
        sizes = np.concatenate([unpack(r["sizes"]) for r in rows])
        before = np.cumsum([0, *counts[:-1]])
        owner = np.concatenate([unpack(r["owner"]) + o for r, o in zip(rows, before)])
        unpacker = zstandard.ZstdDecompressor()
        payload = b"".join(unpacker.decompress(r["payload"]) for r in rows)
        # One entry leads each content; further entries of it are of the same document.
        lead = np.searchsorted(owner, np.arange(len(keys)))
        removed, n = settle(keys, payload, sizes, doc[lead], version[lead], start[lead])
        piece = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        edge = np.flatnonzero(removed & ~((np.concatenate([[False], removed[:-1]])) & (inside > 0)))
        stop = np.flatnonzero(removed & ~(np.concatenate([removed[1:], [False]]) & np.concatenate([inside[1:] > 0, [False]])))
        run_piece, run_at, run_n = piece[edge], inside[edge], stop - edge + 1
        cuts = np.searchsorted(run_piece, np.arange(len(n) + 1))
        runs = (cuts[1:] - cuts[:-1])[owner]
        entry = np.repeat(np.arange(len(owner)), runs)
        run = ragged(cuts[:-1][owner], runs)
        return windows(doc[entry], version[entry], start[entry] + run_at[run], run_n[run])

    def windows(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "version", "start", "n"])

    per_doc = flagged.groupBy("doc").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("keys", "hot_keys")])
    joined = originals(texts).join(per_doc, "doc").select("doc", "version", "packed", "keys", "hot_keys")
    sent = joined.mapInArrow(send, "bucket int, " + ", ".join(f"{c} binary" for c in PIECE_ROWS.names[1:]))
    dealt = sent.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _by(batches, "bucket", meet), REMOVED)


def with_removed(texts: DataFrame, removed: DataFrame) -> DataFrame:
    """(doc_id, packed, copy, starts, ns): every row, whether it is a copy, its removed windows."""
    found = removed.groupBy("doc").agg(F.collect_list(F.struct("version", "start", "n")).alias("found"))
    joined = texts.join(found, "doc", "left")
    # Most ids have one text, and then all windows are its own.
    own = F.when(F.col("version") == 0, F.col("found")).otherwise(
        F.filter("found", lambda x: x["version"] == F.col("version")))
    return joined.select(
        F.when(F.col("version").bitwiseAND(F.lit(1)) == 0, F.col("doc")).alias("doc_id"), "packed",
        (F.col("first") < _place()).alias("copy"), own.alias("own")).select(
            "doc_id", "packed", "copy", "own.start", "own.n")


def covered(copy: pa.Scalar, starts: pa.Scalar, ns: pa.Scalar, length: int, window: int) -> np.ndarray:
    """Which of ``length`` places lie in a removed window; all of a copy, if it has a window."""
    if copy.as_py():
        return np.full(length, length >= window)
    if not starts.is_valid or not len(starts):
        return np.zeros(length, bool)
    start, n = starts.values.to_numpy(), ns.values.to_numpy()
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n + window - 1, -1)
    return np.cumsum(change[:-1]) > 0
