"""Substring dedup of 20-word windows by recompression.

A text is a row of symbols, at first its words.  In each round equal neighbours and pairs of a left
and a right symbol become one symbol (a symbol's side is a bit of its name), named by what it is
made of, so equal passages get equal symbols in every document, but for a few at their edges.  With
each symbol goes the stretch of words that it depends on.  A window is found by the symbol of
least name among those that depend on its own words only; neighbouring windows mostly share it
and travel as one piece, keyed by the ten words on the side of the symbol that all of them hold.
Shared keys reveal repeats, the words of the windows verify them.

Defined results: null text has no words; a null doc_id is larger than all others; rows that share
a doc_id (or have none) and differ in text are ordered by hashes of the text; identical rows are one document and
get one result each; very long texts are worked on whole; texts under 20 words lose nothing; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyflow.llm import repeats
from tallyflow.llm.hashing import U, Words, chain, mix, rolled
from tallyflow.llm.repeats import Pieces, group_starts, ragged, true_names

WINDOW, HALF, ROUNDS = 20, 10, 3


def recompressed(names: np.ndarray, text: np.ndarray, rounds: int = ROUNDS):
    """Symbols after some rounds: (name, begin, need from, need to), in words.

    A border between symbols stays unless the two are equal or a left and a right one; that
    depends on both, and on what made them.  Borders between texts stay and are out of reach of any
    window.
    """
    n = len(names)
    border = np.arange(n + 1)
    low, high = border.copy(), border.copy()
    edge = np.ones(n + 1, bool)
    edge[1:-1] = text[1:] != text[:-1]
    for k in range(rounds):
        left, right = names[:-1], names[1:]
        side = lambda x: mix(x + U(k)) & U(1)  # noqa: E731, B023
        stays = edge.copy()
        stays[1:-1] |= ~((left == right) | ((side(left) == 0) & (side(right) == 1)))
        # What a border depends on: the symbols beside it and their outer borders.
        new_low, new_high = low.copy(), high.copy()
        new_low[1:] = np.minimum(low[:-1], border[:-1])
        new_high[:-1] = np.maximum(high[1:], border[1:])
        new_low[edge], new_high[edge] = border[edge] - 1, border[edge] + 1
        at = np.flatnonzero(stays)
        size = np.diff(at)
        place = (np.arange(len(names)) - np.repeat(at[:-1], size)).astype(np.uint64)
        total = np.concatenate([[U(0)], np.cumsum(mix(names + mix(place * U(2) + U(1))), dtype=np.uint64)])
        joined = chain([total[at[1:]] - total[at[:-1]], size.astype(np.uint64)])
        names = np.where(size == 1, names[at[:-1]], joined)
        border, low, high, edge = border[at], new_low[at], new_high[at], edge[at]
    return names, border[:-1], low[:-1], high[1:]


def found_by(symbols, first: np.ndarray) -> np.ndarray:
    """For each window: the symbol of least name within its reach (leftmost of equals), or -1."""
    names, _, low, high = symbols
    a = np.searchsorted(low, first, side="left")
    b = np.searchsorted(high, first + WINDOW, side="right") - 1
    rank = mix(names + U(0x5EED))
    table = [np.arange(len(names))]
    while 2 ** len(table) <= WINDOW:
        step, last = 2 ** (len(table) - 1), table[-1]
        x, y = last[:-step], last[step:]
        table.append(np.where(rank[x] <= rank[y], x, y) if len(y) else last[:0])
    width = np.maximum(b - a + 1, 0)
    level = np.where(width > 0, np.log2(np.maximum(width, 1)).astype(np.int64), 0)
    out = np.full(len(first), -1)
    for k, row in enumerate(table):
        pick = np.flatnonzero((width > 0) & (level == k))
        x, y = row[a[pick]], row[b[pick] - 2 ** k + 1]
        out[pick] = np.where(rank[x] <= rank[y], x, y)
    return out


class WordPieces(Pieces):
    def __init__(self, texts: list[bytes]):
        # Words one blank apart, so that equal runs of words are equal bytes.
        texts = [b" ".join(t.split()) for t in texts]
        w = Words(texts)
        self.data = np.frombuffer(b" ".join(texts), np.uint8)
        self.starts, self.ends = w.starts, w.ends
        self.first = w.first
        first = w.spans(WINDOW)
        if not len(first):
            self.text = self.start = self.n = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        self.windows = rolled(w.names, WINDOW)
        symbols = recompressed(w.names, w.text)
        symbol = found_by(symbols, first)
        at = symbols[1][symbol]
        behind = at - first <= HALF
        half = rolled(w.names, HALF)
        place = np.clip(np.where(behind, at, at - HALF), 0, len(half) - 1)
        key = mix(half[place] + behind.astype(np.uint64))
        key = np.where(symbol < 0, mix(self.windows[first]), key)
        begin = group_starts(symbol, behind)
        begin[1:] |= (first[1:] != first[:-1] + 1) | (symbol[1:] < 0)
        lead = np.flatnonzero(begin)
        self.text, self.key = w.text[first[lead]], key[lead]
        self.start = first[lead] - self.first[self.text]
        self.n = np.diff(np.append(lead, len(first)))

    def split(self, which):
        if not which.any():
            return self.text, self.key, self.start, self.n
        n = np.where(which, self.n, 1)
        text, start = np.repeat(self.text, n), ragged(self.start, n)
        key, burnt = np.repeat(self.key, n), np.repeat(which, n)
        key[burnt] = mix(self.windows[(self.first[text] + start)[burnt]])
        return text, key, start, np.where(burnt, 1, np.repeat(self.n, n))

    def content(self, text, start, n):
        at = self.first[text] + start
        begin, end = self.starts[at], self.ends[at + n + WINDOW - 2]
        windows = self.windows[ragged(at, n)]
        return self.data[ragged(begin, end - begin)], end - begin, run_names(windows, n)


def run_names(windows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Name of each run of windows."""
    place = (np.arange(len(windows)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    total = np.concatenate([[U(0)], np.cumsum(mix(windows + mix(place * U(2) + U(1))), dtype=np.uint64)])
    ends = np.cumsum(n)
    return chain([total[ends] - total[ends - n], n.astype(np.uint64)])


def settle(keys, payload, sizes, docs, versions, starts):
    """Removed windows of the pieces of a bucket: all but the first of equal ones."""
    data, first = np.frombuffer(payload, np.uint8), np.cumsum(sizes) - sizes
    # A blank behind every piece, so that none runs into the next.
    apart = np.full(len(data) + len(sizes), 32, np.uint8)
    apart[ragged(first + np.arange(len(sizes)), sizes)] = data
    w = Words([apart.tobytes()])
    words = np.searchsorted(w.starts, np.append(first + np.arange(len(sizes)), len(apart)))
    n = np.diff(words) - WINDOW + 1
    # From here on words of one name are the same word.
    one = np.zeros(len(w.names), np.uint64)
    names = true_names(one, w.names, apart, w.starts, w.ends - w.starts)
    windows = rolled(names, WINDOW)
    at = ragged(words[:-1], n)
    name = true_names(keys, run_names(windows[at], n), data, first, sizes)
    whole = later(name, keys, docs, versions, starts)
    removed = np.repeat(whole, n)
    pick = np.flatnonzero(~whole)
    inside = ragged((np.cumsum(n) - n)[pick], n[pick])
    spread = lambda x: np.repeat(x[pick], n[pick])
    key, begin = spread(keys), at[inside]
    row = np.ascontiguousarray(names).view(np.uint8)
    window = true_names(key, windows[begin], row, 8 * begin, np.full(len(begin), 8 * WINDOW))
    removed[inside] = later(window, key, spread(docs), spread(versions), ragged(starts[pick], n[pick]))
    return removed, n


def later(name, key, doc, version, start) -> np.ndarray:
    """Which entries equal an earlier one in (key, name)."""
    order = np.lexsort((start, version, doc, repeats.place(doc, version), name, key))
    new = group_starts(key[order], name[order])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.zeros(len(key), bool)
    out[order] = ((doc[order] != doc[lead]) | (version[order] != version[lead])
                  | (start[order] != start[lead]))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept of every row of documents."""
    texts = repeats.identified(docs)
    flagged = repeats.shared_keys(texts, WordPieces, within=True)
    removed = repeats.repeated_windows(texts, flagged, WordPieces, settle, within=True)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                rows = []
                for data, copy, starts, ns in zip(repeats.unsqueezed(few.column(1)), *few.columns[2:]):
                    words = data.split()
                    gone = repeats.covered(copy, starts, ns, len(words), WINDOW)
                    kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                    rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), *[pa.array(c) for c in list(zip(*rows))]],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return repeats.with_removed(texts, removed).mapInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
