"""Benchmark decontamination by one Aho-Corasick automaton over the words of all items.

Items and documents are reduced to lower-case words of letters, digits and non-ASCII bytes; each word
of the items is one character, so an item is a string of as many characters as it has words.  Every window of 13 words (a
shorter item as a whole) holds one of the item's blocks of 7 words that begin at multiples of 7; the automaton
holds these blocks, so it has about one node per word, not one per word of each window.  A document is
scanned once, whole; a block that is found is grown to both sides as far as document and item
agree, and counts if it reaches the length of a window.  Hits are word places, which map to byte offsets of the original
text.

Items are broadcast in blocks of at most ``BLOCK_WORDS`` words (counted, not assumed), so one automaton holds the
usual benchmarks together; a larger one takes a pass over the documents for each further block, and a
worker builds each automaton once.

Defined results: null text has no words and no hits; items without words match nothing; repeated
items count each by its id; a null item id is not counted; empty tables give no hits; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.shipping import ship
from tallyflow.session import work_dir

WINDOW = 13
# A word takes about 60 bytes of a worker's automaton.
BLOCK_WORDS = 1_000_000
# Byte -> byte of the reduced text: letters in lower case, digits, non-ASCII; the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_IS_WORD = np.array([b != 32 for b in _FOLD])
FOUND = "doc_id long, name_a long, name_b long, found array<struct<start:long,stop:long,items:array<long>>>"
HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans binary"


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Automaton:
    """The items as strings with one character per word, and their blocks in one automaton."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        numbers: dict[bytes, str] = {}
        self.items: list[tuple[int, str, int]] = []
        blocks: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            own = text.encode().split()
            for word in own:
                if word not in numbers:
                    # No word has the character 0, and none a surrogate.
                    k = len(numbers) + 1
                    numbers[word] = chr(k if k < 0xD800 else k + 0x800)
            if not own:
                continue
            line = "".join(map(numbers.__getitem__, own))
            least = min(size, len(line))
            # Any ``least`` words in a row hold a whole block that begins at a multiple of its length.
            n = (least + 1) // 2
            for at in range(0, len(line) - n + 1, n):
                blocks[line[at:at + n]].append((len(self.items), at))
            self.items.append((item_id, line, least))
        self.trie = ahocorasick.Automaton()
        for block, places in blocks.items():
            self.trie.add_word(block, (len(block), tuple(places)))
        self.trie.make_automaton()
        self.numbers = numbers

    def scan(self, own: list[bytes]) -> list[tuple[int, int, tuple[int, ...]]]:
        """(first word, last word + 1, item ids) of the longest stretches that hold windows of an item."""
        if not self.items or not own:
            return []
        number = self.numbers.get
        text = "".join([number(w, "\0") for w in own])
        out, reached = [], {}
        for end, (n, places) in self.trie.iter(text):
            first = end + 1 - n
            for item, at in places:
                # Blocks of one stretch lie on one diagonal.
                if reached.get((item, first - at), -1) > end:
                    continue
                item_id, line, least = self.items[item]
                begin, start = at, first
                while begin and start and line[begin - 1] == text[start - 1]:
                    begin, start = begin - 1, start - 1
                stop, last = at + n, end + 1
                while stop < len(line) and last < len(text) and line[stop] == text[last]:
                    stop, last = stop + 1, last + 1
                reached[item, first - at] = last
                if last - start >= least:
                    out.append((start, last, (item_id,)))
        return out


_BUILT: dict[tuple[str, int], Automaton] = {}


def automaton(block: Broadcast, size: int) -> Automaton:
    """The block's automaton, built once per worker; one is held at a time."""
    name, items = block.value
    if (name, size) not in _BUILT:
        _BUILT.clear()
        _BUILT[name, size] = Automaton(items, size)
    return _BUILT[name, size]


def matches(texts: list[str], block: Broadcast, size: int) -> dict[int, list]:
    """Stretches in each text that has any; the words of one text are held at a time."""
    built = automaton(block, size)
    return {k: found for k, text in enumerate(texts) if (found := built.scan(words(text)))}


def spans_of(text: str, hit: np.ndarray) -> bytes:
    """Byte offsets (start, end) in the original text of each run of hit words."""
    marks = _IS_WORD[np.frombuffer(text.encode(), np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    turns = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return np.stack([starts[turns[::2]], ends[turns[1::2] - 1]], 1).astype("<i8").tobytes()


def item_blocks(benchmark: DataFrame, size: int, most: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """Items as words joined by blanks, in blocks of at most ``most`` words, streamed from the executors.
    A longer item is cut into stretches that overlap, so that every window lies in one."""
    block, held = [], 0
    for row in (benchmark.where("item_id is not null and text is not null")
                .select(F.col("item_id").cast("long"), "text").toLocalIterator()):
        own = words(row[1])
        step = max(most - size + 1, size)
        for at in range(0, max(len(own) - size + 1, 1), step):
            part = own[at:at + step + size - 1]
            if block and held + len(part) > most:
                yield block
                block, held = [], 0
            block.append((row[0], b" ".join(part).decode()))
            held += len(part)
    if block:
        yield block


def _judged(n_words: list, found: list, texts: list[str], ids: pa.Array) -> pa.RecordBatch:
    """Result rows from (first word, last word + 1, item ids) of each text."""
    n_hit, n_items, digest, spans = [], [], [], []
    for n, own, text in zip(n_words, found, texts):
        hit, items = np.zeros(n, bool), set()
        for start, end, of in own:
            hit[start:end] = True
            items.update(of)
        n_hit.append(int(hit.sum()))
        n_items.append(len(items))
        digest.append(hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest())
        spans.append(spans_of(text, hit) if items else b"")
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
         pa.array(digest, pa.string()), pa.array(spans, pa.binary())],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "spans"])


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BLOCK_WORDS) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, spans (int64 pairs of byte
    offsets into the original text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = item_blocks(benchmark, window, most)
    first, second = next(blocks, []), next(blocks, None)
    done = (_in_one_pass(rows, first, window) if second is None else
            _in_passes(rows, chain([first, second], blocks), window))
    return done.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _broadcast(rows: DataFrame, block: list) -> Broadcast:
    return rows.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block))


def _in_one_pass(rows: DataFrame, block: list, window: int) -> DataFrame:
    sent = _broadcast(rows, block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = matches(texts, sent, window)
            yield _judged([len(words(t)) for t in texts], [found.get(k, ()) for k in range(len(texts))],
                          texts, batch.column(0))

    return rows.mapInArrow(scan, HITS)


def _text_name() -> list[Column]:
    """128 bits of a text."""
    return [F.xxhash64("text").alias("name_a"), F.xxhash64(F.lit(1), "text").alias("name_b")]


def _gathered(named: DataFrame, blocks: Iterator[list], window: int) -> DataFrame:
    """The stretches of each block are written, then gathered per (doc_id, name of the text): found."""
    spark, folder = named.sparkSession, work_dir(named.sparkSession, "decontaminate")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("items", pa.list_(pa.int64()))]))

    def scan(sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, own in matches(batch.column("text").to_pylist(), sent, window).items():
                    yield pa.RecordBatch.from_pylist([{
                        **{c: batch.column(c)[k].as_py() for c in ("doc_id", "name_a", "name_b")},
                        "found": [{"start": a, "stop": b, "items": list(of)} for a, b, of in own]}],
                        schema=pa.schema([("doc_id", pa.int64()), ("name_a", pa.int64()),
                                          ("name_b", pa.int64()), ("found", kind)]))
        return run

    for k, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        named.select("doc_id", "text", "name_a", "name_b").mapInArrow(scan(sent), FOUND).write.parquet(
            f"{folder}/{k:06d}")
        sent.destroy()
    every = (spark.read.schema(FOUND).parquet(f"{folder}/*").distinct()
             .groupBy(F.col("doc_id").alias("id"), F.col("name_a").alias("a"), F.col("name_b").alias("b"))
             .agg(F.flatten(F.collect_list("found")).alias("found")))
    return named.join(every, [F.col("doc_id").eqNullSafe(F.col("id")), F.col("name_a") == F.col("a"),
                              F.col("name_b") == F.col("b")], "left").drop("id", "a", "b")


def _stretches(found: pa.Array) -> list[list]:
    return [[(x["start"], x["stop"], x["items"]) for x in own or ()] for own in found.to_pylist()]


def _in_passes(rows: DataFrame, blocks: Iterator[list], window: int) -> DataFrame:
    joined = _gathered(rows.select("doc_id", "text", *_text_name()), blocks, window).select(
        "doc_id", "text", "found")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield _judged([len(words(t)) for t in texts], _stretches(batch.column(2)), texts, batch.column(0))

    return joined.mapInArrow(judge, HITS)


def _contaminated(text: str, found: list) -> bool:
    hit = np.zeros(len(words(text)), bool)
    for start, end, _ in found:
        hit[start:end] = True
    return bool(hit.any() and 20 * hit.sum() >= len(hit))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BLOCK_WORDS) -> DataFrame:
    """Documents that are not contaminated, with all their columns; rows are judged each."""
    ship(docs.sparkSession)
    blocks = item_blocks(benchmark, window, most)
    first, second = next(blocks, []), next(blocks, None)
    if second is not None:
        return _clean_in_passes(docs, chain([first, second], blocks), window)
    sent, place = _broadcast(docs, first), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            good = np.ones(len(texts), bool)
            for k, found in matches(texts, sent, window).items():
                good[k] = not _contaminated(texts[k], found)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def _clean_in_passes(docs: DataFrame, blocks: Iterator[list], window: int) -> DataFrame:
    names = docs.columns
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")).select(
        "doc", F.col("doc.doc_id").cast("long").alias("doc_id"),
        F.coalesce("doc.text", F.lit("")).alias("text")).select("doc", "doc_id", "text", *_text_name())
    joined = _gathered(named, blocks, window).select("doc", "text", "found")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [not own or not _contaminated(text, own) for text, own in zip(
                batch.column(1).to_pylist(), _stretches(batch.column(2)))]
            rows = batch.column(0).filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays(rows.flatten(), names=names)

    return joined.mapInArrow(keep, docs.schema)
