"""What grows with the corpus in one task of the operators that look for repeats."""

import numpy as np
import pytest

from tallyflow.llm import byte_repeats, repeats
from tallyflow.llm.hashing import U


def _bucket(keys, draw):
    """Pieces of many keys in one bucket: three differing pieces a key that share a passage."""
    texts, key = [], []
    for k in range(keys):
        passage = bytes(draw.integers(97, 123, 60, dtype=np.uint8))
        for piece in (b"A", b"B", b"C"):
            texts.append(passage + piece + bytes(draw.integers(97, 123, 20, dtype=np.uint8)))
            key.append(k * 7919 % keys)
    sizes = np.array([len(t) for t in texts], np.int64)
    zero = np.zeros(len(texts), np.int64)
    return (np.array(key, np.uint64), b"".join(texts), sizes, np.arange(len(texts), dtype=np.int64), zero, zero)


def test_a_bucket_is_sorted_key_by_key_whatever_its_size(monkeypatch):
    bucket, sorted_ = _bucket(4000, np.random.default_rng(3)), []
    pointers = byte_repeats.bucket_pointers

    def seen(data, left):
        sorted_.append(len(data))
        return pointers(data, left)

    monkeypatch.setattr(byte_repeats, "bucket_pointers", seen)
    removed, n = byte_repeats.settle(*bucket)
    # The windows inside the passage are taken from the second and the third piece.
    assert removed.sum() == 4000 * 2 * (60 - byte_repeats.WINDOW + 1)
    assert sum(sorted_) == len(bucket[1]) and max(sorted_) < 1.1 * byte_repeats.SORTED < len(bucket[1])
    monkeypatch.setattr(byte_repeats, "SORTED", 1 << 40)
    assert (byte_repeats.settle(*bucket)[0] == removed).all()


@pytest.mark.parametrize("kinds", (1, 50, 1 << 62))
def test_entries_in_order_of_their_keys_are_in_order_of_their_buckets(kinds):
    draw = np.random.default_rng(kinds % 1000)
    key = draw.integers(0, kinds, 20_000).astype(np.uint64) * U(2)
    doc = draw.integers(0, 300, 20_000)
    order = repeats.by_key(key, doc)
    assert (order != np.lexsort((doc, key))).sum() == 0 or (
        (key[order] == np.sort(key)).all() and (doc[order] == doc[np.lexsort((doc, key))]).all())
    bucket = repeats.bucket_of(key[order], 96)
    assert (np.diff(bucket) >= 0).all() and bucket.min() >= 0 and bucket.max() < 96


def test_the_keys_of_a_text_spread_over_the_buckets():
    letters = np.random.default_rng(5).integers(97, 123, 200_000, dtype=np.uint8)
    keys = byte_repeats.BytePieces([letters.tobytes()]).key
    held = np.bincount(repeats.bucket_of(keys, 16), minlength=16)
    assert held.min() > 0.7 * held.mean() and held.max() < 1.3 * held.mean()
