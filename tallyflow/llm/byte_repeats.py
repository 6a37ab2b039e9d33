"""Suffix-array dedup of 50-byte strings by bucket-pointer refinement.

The suffixes that matter are those whose first 50 bytes occur in an earlier document.  They are
brought together by a 16-byte string: the one of least name among the 35 in a suffix's first 50
bytes, which is the same wherever these bytes stand.  Neighbouring suffixes mostly share it and
travel as one piece.  What no two documents share is dropped there, and pieces that are equal as a whole are settled.

The suffixes of the other pieces are sorted by bucket-pointer refinement: at first a bucket holds the suffixes
that share eight bytes; each round sorts the buckets by the bucket pointers at an offset of 8, 16 and 18
bytes, so 16, 32 and 50 bytes are told apart, and updates the pointers that the next round sorts by.  Only suffixes
that still share a bucket are sorted again.  Buckets are compared, not hashed: suffixes of one final bucket have the same
50 bytes, and all but those of the least document are removed.

Defined results: null text is empty; repeated rows of one doc_id do not remove each other's bytes;
a null doc_id is larger than all others, and rows without id do not remove each other's bytes; texts under 50 bytes lose nothing; very long texts are worked on whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tallyflow.llm import repeats
from tallyflow.llm.hashing import _BASE, _BYTE, U, chain, mix, rolled
from tallyflow.llm.repeats import Pieces, group_starts, ragged, true_names

# A key is made of strings of KEY bytes; the first buckets hold strings of GRAM bytes.
WINDOW, KEY, GRAM = 50, 16, 8
# A piece of a periodic text could go on for ever.
LONGEST = 64
# So many bytes are sorted at once, as many as a core's cache holds with their pointers.
SORTED = 1 << 17


def least(names: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` neighbours."""
    have, step = names, 1
    while 2 * step <= size:
        have = np.minimum(have[:-step], have[step:])
        step *= 2
    rest = size - step
    return np.minimum(have[:-rest], have[rest:]) if rest else have


def bucket_pointers(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The bucket of the suffix at every place: those with at least ``WINDOW`` bytes left share one exactly if
    their first ``WINDOW`` bytes are equal.  Also how many suffixes each round sorted.

    The first buckets are the strings of eight bytes.  A round refines each bucket by the buckets of its
    suffixes at a later offset, so that twice as many bytes are told apart; the pointers of one round are
    what the next one sorts by.  Suffixes alone in their bucket, and those with too few bytes left, stay.
    """
    eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    pointer = np.unique(eight, return_inverse=True)[1].astype(np.int64)
    done, sorted_ = GRAM, [len(data)]
    while done < WINDOW:
        offset = min(done, WINDOW - done)
        size = np.bincount(pointer)
        active = np.flatnonzero((size[pointer] > 1) & (left >= done + offset))
        sorted_.append(len(active))
        if len(active):
            # Both pointers as one number, which sorts several times as fast as two columns.
            both = pointer[active] * len(size) + pointer[active + offset]
            order = np.argsort(both)
            pointer[active[order]] = len(size) + np.cumsum(group_starts(both[order])) - 1
        done += offset
    return pointer, sorted_


class BytePieces(Pieces):
    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(size) - size
        n = len(self.data) - WINDOW + 1
        if n <= 0:
            self.text = self.start = self.n = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        self.grams = rolled(_BYTE[self.data], KEY)
        key = least(self.grams, WINDOW - KEY + 1)
        owner = np.repeat(np.arange(len(texts)), size)
        valid = owner[:n] == owner[WINDOW - 1:]
        begin = np.zeros(n, bool)
        begin[:1] = True
        begin[1:] = (key[1:] != key[:-1]) | (owner[1:n] != owner[:n - 1])
        at = np.flatnonzero(begin & valid)
        # Windows that run over a text's end stand behind the last valid one.
        stop = np.flatnonzero(valid & ~np.concatenate([valid[1:] & ~begin[1:], [False]])) + 1
        long = np.maximum(-(-(stop - at) // LONGEST), 1)
        part = ragged(np.zeros(len(at), np.int64), long) * LONGEST
        at, stop = np.repeat(at, long) + part, np.repeat(stop, long)
        # A least name is a small number; mixed, the keys spread over all.
        self.text, self.key = owner[at], mix(key[at])
        self.start, self.n = at - self.first[self.text], np.minimum(stop - at, LONGEST)

    def split(self, which):
        if not which.any():
            return self.text, self.key, self.start, self.n
        n = np.where(which, self.n, 1)
        text, start = np.repeat(self.text, n), ragged(self.start, n)
        key, burnt = np.repeat(self.key, n), np.repeat(which, n)
        at = (self.first[text] + start)[burnt]
        key[burnt] = mix(_windows_at(self.grams, at))
        return text, key, start, np.where(burnt, 1, np.repeat(self.n, n))

    def content(self, text, start, n):
        size = n + WINDOW - 1
        payload = self.data[ragged(self.first[text] + start, size)]
        return payload, size, byte_names(payload, size)


def _windows_at(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    shift = WINDOW - 2 * KEY
    wider = lambda x: mix(grams[x] * _BASE + grams[x + KEY])
    return mix(wider(at) * _BASE + wider(at + shift))


def byte_names(payload: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Name of each stretch."""
    data, ends = memoryview(payload), np.cumsum(size)
    return np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip((ends - size).tolist(), ends.tolist())),
                       np.uint64, len(size))


def few_keys(keys: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> Iterator[np.ndarray]:
    """The picked pieces by their keys, about ``SORTED`` bytes at a time: windows are only equal under one key."""
    pick = pick[np.argsort(keys[pick], kind="stable")]
    size = sizes[pick]
    starts = np.flatnonzero(group_starts(keys[pick]))
    chunk = (np.cumsum(size) - size)[starts] // SORTED
    yield from np.split(pick, starts[1:][chunk[1:] != chunk[:-1]]) if len(pick) else ()


def settle(keys, payload, sizes, docs, versions, starts):
    """Removed windows of the pieces of a bucket."""
    data, n = np.frombuffer(payload, np.uint8), sizes - WINDOW + 1
    first, rank = np.cumsum(sizes) - sizes, repeats.place(docs, versions)
    name = true_names(keys, byte_names(data, sizes), data, first, sizes)
    order = np.lexsort((rank, name, keys))
    new = group_starts(keys[order], name[order])
    group = np.cumsum(new) - 1
    lead = order[np.flatnonzero(new)][group]
    whole = np.zeros(len(keys), bool)
    whole[order] = rank[order] > rank[lead]
    # Pieces alone under their key have no windows in common with others.
    by_key = np.cumsum(group_starts(keys[order])) - 1
    kinds = np.bincount(by_key, new)
    open_ = np.zeros(len(keys), bool)
    open_[order] = (kinds[by_key] > 1)
    open_ &= ~whole
    removed = np.repeat(whole, n)
    for pick in few_keys(keys, sizes, np.flatnonzero(open_)):
        size = sizes[pick]
        ends = np.cumsum(size)
        pointer, _ = bucket_pointers(data[ragged(first[pick], size)], np.repeat(ends, size) - np.arange(ends[-1]))
        bucket = pointer[ragged(ends - size, n[pick])]
        of = np.repeat(rank[pick], n[pick])
        order = np.argsort(bucket, kind="stable")
        begin = np.flatnonzero(group_starts(bucket[order]))
        low = np.repeat(np.minimum.reduceat(of[order], begin), np.diff(np.append(begin, len(order))))
        gone = np.zeros(len(bucket), bool)
        gone[order] = of[order] > low
        removed[ragged((np.cumsum(n) - n)[pick], n[pick])] = gone
    return removed, n


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) of every row of documents."""
    texts = repeats.identified(docs)
    flagged = repeats.shared_keys(texts, BytePieces, within=False)
    removed = repeats.repeated_windows(texts, flagged, BytePieces, settle, within=False)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                rows = []
                for data, copy, starts, ns in zip(repeats.unsqueezed(few.column(1)), *few.columns[2:]):
                    gone = repeats.covered(copy, starts, ns, len(data), WINDOW)
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                    rows.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), *[pa.array(c) for c in list(zip(*rows))[:4]],
                     pa.array([r[4] for r in rows], pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return repeats.with_removed(texts, removed).mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
