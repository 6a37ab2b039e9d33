"""Token ids in shard files of independent zstandard frames with a trailing seek table.

A shard holds one frame per document in ascending doc_id order, then a frame with the directory
(doc ids, numbers of tokens), then the seek table of the public seekable format: a skippable frame
with the compressed size, size and checksum (low half of XXH64) of every frame before it.  Any
zstandard tool unpacks a shard; ``Shard.read`` fetches the table, then only the frames asked for,
and checks each.

Shards are written by the tasks that encode them, into a shared folder, under names no other
attempt uses; the manifest that Spark writes names the shards that count.  A lost executor's task
is run again and leaves at most an unnamed file.

Defined results: null text is an empty document (its end id only); a null doc_id comes last; rows
that share a doc_id are kept each, ordered by a hash of their text; a very long text is one frame; empty tables give an empty
manifest; other columns are not read.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.shipping import ship
from tallyflow.session import shuffle_tasks

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
ID = np.dtype("<u4")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
DIRECTORY = np.dtype([("doc_id", "<i8"), ("n_tokens", "<i8"), ("has_id", "<i8")])
LEVEL = 1
# Bytes of frames read together.
READ_BYTES = 4 << 20
KEPT_WORDS = 500_000
WORD_END, STOPS, JOINED = "</w>", string.punctuation, 200
MANIFEST = "part long, path string, n_docs long, n_tokens long"


class WordEncoder:
    """Ids of whole texts by a library tokenizer that drops white space, one word at a time.

    No token crosses white space, so the ids of a text are those of its words in a row; the ids
    of a word are looked up in a bounded table.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(tokenizer_file)
        # The same for small ASCII letters between blanks, without the costly patterns.
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        last = [i for token, i in self.library.get_vocab().items() if token.endswith(WORD_END)]
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        self.ends[last] = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8) as little-endian 32-bit numbers."""
        split = [self._folded(t).split() for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        new = set().union(*split).difference(known)
        stems, other, made = set(), [], []
        for word in new:
            text = word.decode()
            letters = text.rstrip(STOPS)
            if letters.isalpha():
                # Stops behind letters are a run of their own; ASCII capitals fold alone.
                stem = letters.lower() if letters.isascii() else letters
                made.append((word, stem.encode(), word[len(letters.encode()):]))
                stems.add(stem)
            else:
                other.append(text)
        stems = [x for x in stems if x.encode() not in known]
        for library, some in ((self.plain, [x for x in stems if x.isascii()]),
                              (self.library, [x for x in stems if not x.isascii()])):
            for at in range(0, len(some), JOINED):
                part = some[at:at + JOINED]
                if not self._together(library, part):
                    other += part
        other += [x.decode() for x in {stops for _, _, stops in made} if x and x not in known]
        for text, e in zip(other, self.library.encode_batch_fast(other, add_special_tokens=False)):
            known[text.encode()] = np.array(e.ids, ID).tobytes()
        mixed = []
        for word, stem, stops in made:
            if stops and not stem.isascii() and self._runs(known[stem]) > 1:
                mixed.append(word)  # marks that letters fold to would join the stops
            else:
                known[word] = known[stem] + known[stops] if stops else known[stem]
        for word in mixed:
            known[word] = np.array(self.library.encode(word.decode(), add_special_tokens=False).ids,
                                   ID).tobytes()
        return [b"".join(map(known.__getitem__, words)) for words in split]

    @staticmethod
    def _folded(data: bytes) -> bytes:
        """Lower case where that is the same before as after: in ASCII without special tokens."""
        return data.lower() if data.isascii() and b"<|" not in data else data

    def _runs(self, ids: bytes) -> int:
        return int(self.ends[np.frombuffer(ids, ID)].sum())

    def _together(self, library, part: list[str]) -> bool:
        """Encode words of letters in one call: each is one run of tokens that ends with a word-end
        token.  A word may have more runs (letters that fold to marks), never fewer; the total
        shows it."""
        ids = np.array(library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids,
                       ID)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(part):
            return False
        data, start = ids.tobytes(), 0
        for text, end in zip(part, (4 * ends).tolist()):
            self.known[text.encode()] = data[start:end]
            start = end
        return True


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_file: str) -> WordEncoder:
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


# Hadoop's names of stores that Arrow knows by another one.
STORES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def arrow_uri(uri: str) -> str:
    """A folder as Hadoop names it, as Arrow does; a plain path is a local one."""
    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        return f"file://{uri}"
    return f"{STORES.get(scheme, scheme)}:{rest}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(arrow_uri(uri))


class ShardWriter:
    def __init__(self, uri: str):
        self.fs, path = file_system(uri)
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        self.out = self.fs.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int]] = []

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._frame(ids)
        self.documents.append((doc_id or 0, len(ids) // ID.itemsize, doc_id is not None))

    def close(self) -> None:
        self._frame(np.array(self.documents, DIRECTORY).tobytes())
        table = np.array(self.entries, ENTRY).tobytes()
        footer = struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


class Shard:
    """Random access to a shard."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri} has no seek table")
        self.entries = np.frombuffer(self._at(size - 9 - n * ENTRY.itemsize, n * ENTRY.itemsize), ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["packed"].astype(np.int64))])
        self.unpacker = zstandard.ZstdDecompressor()
        self.documents = np.frombuffer(self._frame(n - 1), DIRECTORY)

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def _frame(self, k: int) -> bytes:
        return self._unpacked(k, self._at(int(self.starts[k]), int(self.entries["packed"][k])))

    def _unpacked(self, k: int, packed: bytes) -> bytes:
        data = self.unpacker.decompress(packed, max_output_size=int(self.entries["size"][k]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.entries["check"][k]:
            raise ValueError(f"frame {k} is damaged")
        return data

    def frames(self) -> Iterator[bytes]:
        """The ids of all documents in order, read a few frames at a time."""
        n, starts = len(self.documents), self.starts.tolist()
        first = 0
        while first < n:
            last = first + 1
            while last < n and starts[last + 1] - starts[first] <= READ_BYTES:
                last += 1
            data = memoryview(self._at(starts[first], starts[last] - starts[first]))
            for k in range(first, last):
                yield self._unpacked(k, data[starts[k] - starts[first]:starts[k + 1] - starts[first]])
            first = last

    def read(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        return np.frombuffer(self._frame(k), ID)

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents with this id; only their frames are read."""
        rows = self.documents
        return [self.read(int(k)) for k in np.flatnonzero((rows["doc_id"] == doc_id) & (rows["has_id"] == 1))]

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int) -> DataFrame:
    """Write all documents as shards below ``folder``; returns the manifest, in shard order."""
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    placed = (docs.select(F.col("doc_id").cast("long"), text.alias("text"))
              .repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, uri, part = encoder(tokenizer_file), None, "", 0
        end = np.array([end_id], ID).tobytes()
        for batch in batches:
            if batch.num_rows and shard is None:
                part = batch.column(0)[0].as_py()
                uri = f"{folder}/shards/{part:06d}-{uuid.uuid4().hex}.zst"
                shard = ShardWriter(uri)
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                texts = few.column(2).cast(pa.binary()).to_pylist()
                for doc_id, ids in zip(few.column(1).to_pylist(), own.encode(texts)):
                    shard.add(doc_id, ids + end)
        if shard is not None:
            shard.close()
            yield pa.RecordBatch.from_pylist([{
                "part": part, "path": uri, "n_docs": len(shard.documents),
                "n_tokens": sum(d[1] for d in shard.documents)}], schema=pa.schema(
                    [("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()),
                     ("n_tokens", pa.int64())]))

    placed.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids_crc32, from the shards."""
    before = (Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spark = manifest.sparkSession
    ship(spark)
    # One row per shard, some hundred MB each: the running sum over shards is short.
    located = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _digests(row["path"], row["at"])

    return located.repartition(shuffle_tasks(spark), "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(path: str, at: int) -> Iterable[pa.RecordBatch]:
    shard = Shard(path)
    try:
        rows = shard.documents
        starts = at + np.concatenate([[0], np.cumsum(rows["n_tokens"])])[:len(rows)]
        crc = [zlib.crc32(ids) for ids in shard.frames()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["doc_id"], pa.int64(), mask=rows["has_id"] == 0),
             pa.array(starts, pa.int64()), pa.array(rows["n_tokens"], pa.int64()),
             pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    finally:
        shard.close()
