"""Near-duplicate classes by BagMinHash over bags of 5-word shingles.

A shingle with count w stands for the weights [0, w), cut at powers of two.  Each piece carries a
Poisson process whose rate is its width; a point has a time, one of ``M`` places and a level, and
counts if its level lies below w.  The earliest point at each place is the signature, and two bags
agree at a place with the probability of their weighted Jaccard similarity.  Times are followed
only as far as every place of a document is filled.

Signatures are cut into bands.  Documents that share a band are compared exactly (bag overlap) with
the document of the band that shares most bands, and verified pairs are joined into classes.  Where a band still
holds several classes, links inside it are searched by an exact prefix filter over its documents:
two bags of similarity ``SIMILAR`` or more share one of the rarest shingles of either, so no pairs
of a large, loosely alike group are ever listed.

Defined results: copies of the same words form a class, texts without words are copies of each
other; a text of one to four words is one shingle; very long texts
are signed and compared whole; rows that share a doc_id are one document; rows
without doc_id take no part and get no class; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.hashing import U, Words, chain, mix, odd, rolled, slices
from tallyflow.llm.shipping import ship
from tallyflow.session import work_dir

SHINGLE, SIMILAR = 5, 0.8
# At similarity 0.8 a pair shares none of 32 bands of 4 with probability 5e-8.
M, BAND = 128, 4


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle name) of all shingles, sorted; number of words; name of the word sequence."""
    w = Words(texts)
    at = w.spans(SHINGLE)
    names = rolled(w.names, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    owner = w.text[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    whole = sequence_names(w)
    owner = np.concatenate([owner, short])
    names = np.concatenate([names, whole[0][short]])
    order = np.lexsort((names, owner))
    return owner[order], names[order], count, np.stack(whole, 1)


def sequence_names(w: Words) -> list[np.ndarray]:
    """Two independent names of the whole word sequence of each text."""
    out = []
    places = np.arange(len(w.names), dtype=np.uint64) - w.first[w.text].astype(np.uint64)
    for seed in (U(0x51), U(0xA3)):
        single = mix(w.names + mix(places * U(2) + seed))
        total = np.concatenate([[U(0)], np.cumsum(single, dtype=np.uint64)])
        out.append(mix((total[w.first[1:]] - total[w.first[:-1]]) + np.diff(w.first).astype(np.uint64)))
    return out


def signatures(owner: np.ndarray, names: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash signatures (n x M) of n bags given as sorted (owner, name) rows."""
    sig = np.full((n, M), np.inf)
    if not len(owner):
        return sig
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])]))
    weight = np.diff(np.concatenate([new, [len(owner)]]))
    doc, name = owner[new], names[new]
    total = np.bincount(owner, minlength=n)
    until = np.zeros(n)
    open_docs = total > 0
    limit = M * (np.log(M) + 4) / np.maximum(total, 1)
    while open_docs.any():
        until[open_docs] = limit[open_docs]
        _points(sig, doc, name, weight, np.where(open_docs, until, 0))
        open_docs &= np.isinf(sig).any(axis=1)
        limit = limit * 4
    return sig


def _points(sig: np.ndarray, doc, name, weight, until: np.ndarray) -> None:
    """Lower ``sig`` to the points of all processes before each document's time."""
    low, width = 0, 1
    pick = np.flatnonzero(until[doc] > 0)
    while len(pick):
        d, w = doc[pick], weight[pick]
        # The seed names shingle and piece; the k-th point of a process adds k.
        seed = mix(name[pick] + odd(low, 0xD6E8FEB86659FD93))
        time, end, k = np.zeros(len(pick)), until[d], 0
        while len(d):
            k += 1
            draw = mix(seed + odd(k, 0x9E3779B97F4A7C15))
            time = time - np.log(((draw >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            go = time < end
            d, w, seed, time, end, draw = d[go], w[go], seed[go], time[go], end[go], draw[go]
            where = mix(draw)
            counts = slice(None)
            if width > 1:
                level = low + (mix(where) % U(width)).astype(np.int64)
                counts = level < w
            np.minimum.at(sig.reshape(-1), d[counts] * M + (where[counts] % U(M)).astype(np.int64),
                          time[counts])
        low, width = (1, 1) if low == 0 else (low * 2, width * 2)
        pick = pick[weight[pick] > low]


def band_names(sig: np.ndarray) -> np.ndarray:
    """One name per band; the last bits of a time may depend on the machine and are left out."""
    bits = np.ascontiguousarray(sig).view(np.uint64) >> U(12)
    return np.stack([chain([bits[:, i + j] for j in range(BAND)]) for i in range(0, M, BAND)], 1)


def overlap(a: bytes, b: bytes) -> tuple[int, int]:
    """Shared and joint size of two sorted bags."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([numbered(x), numbered(y)])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared, len(x) + len(y) - shared


def numbered(bag: np.ndarray) -> np.ndarray:
    """A sorted bag as a set: equal entries get different names by their number."""
    if not len(bag):
        return bag
    new = np.concatenate([[True], bag[1:] != bag[:-1]])
    place = np.arange(len(bag))
    nth = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    return np.where(nth == 0, bag, mix(bag + nth * U(0xD6E8FEB86659FD93)))


def _kept(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _signed(docs: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                owner, names, count, whole = bags(texts[a:b])
                bands = band_names(signatures(owner, names, b - a)).view(np.int64)
                size = np.bincount(owner, minlength=b - a)
                offsets = np.arange(b - a + 1, dtype=np.int32) * bands.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(whole[:, 0].view(np.int64)),
                     pa.array(whole[:, 1].view(np.int64)), pa.array(size, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1)))],
                    names=["doc_id", "k1", "k2", "size", "bands"])

    return docs.mapInArrow(sign, "doc_id long, k1 long, k2 long, size long, bands array<long>")


def _bagged(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, bag): sorted shingle names of the wanted documents."""
    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                owner, names, _, _ = bags(texts[a:b])
                cut = np.searchsorted(owner, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([names[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())],
                    names=["doc_id", "bag"])

    return docs.join(wanted, "doc_id", "left_semi").mapInArrow(bag, "doc_id long, bag binary")


def _verified(pairs: DataFrame, bagged: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bags are similar; hot documents are split by the adaptive join."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                shared, joint = overlap(x.as_py(), y.as_py())
                ok.append(5 * shared >= 4 * joint)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = bagged.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a"))
    right = bagged.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b"))
    return (pairs.join(right, "b").join(left, "a").select("a", "b", "bag_a", "bag_b")
            .mapInArrow(check, "a long, b long"))


def components(links: DataFrame, folder: str) -> DataFrame:
    """(doc_id, label) of all linked documents; the label is the least id they reach.

    Each round takes the least label among the neighbours and then the label of the label, so long
    chains shrink by jumps.  Every round is written to the shared folder.
    """
    edges = _kept(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{folder}/edges")
    labels = _kept(edges.groupBy(F.col("a").alias("doc_id")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), f"{folder}/labels-0")
    k = 0
    while True:
        k += 1
        seen = (edges.join(labels, edges["b"] == labels["doc_id"]).select("a", "label")
                .union(labels.select("doc_id", "label")).groupBy(F.col("a").alias("doc_id"))
                .agg(F.min("label").alias("near")))
        jump = labels.select(F.col("doc_id").alias("at"), F.col("label").alias("far"))
        new = _kept(seen.join(jump, seen["near"] == jump["at"], "left").select(
            "doc_id", F.least("near", F.coalesce("far", "near")).alias("label")), f"{folder}/labels-{k}")
        before = labels.select(F.col("doc_id").alias("d"), F.col("label").alias("l"))
        if new.join(before, [new["doc_id"] == before["d"], new["label"] != before["l"]]).isEmpty():
            return new
        labels = new


def _rare_pairs(members: DataFrame, bagged: DataFrame) -> DataFrame:
    """Pairs of different labels that share one of the rarest shingles of both (prefix filter).

    ``members``: (doc_id, label).  Complete for similarity SIMILAR: if all the rarest
    ``n - ceil(SIMILAR * n) + 1`` entries of each bag missed the other, too few would be shared.
    """
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, label, bag in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names = numbered(np.frombuffer(bag, np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), doc)), pa.array(np.full(len(names), label)),
                     pa.array(np.full(len(names), len(names))), pa.array(names)],
                    names=["doc_id", "label", "size", "name"])

    rows = members.join(bagged, "doc_id").select("doc_id", "label", "bag").mapInArrow(
        entries, "doc_id long, label long, size long, name long")
    common = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"),
                                      F.max("label").alias("hi"))
    order = Window.partitionBy("doc_id").orderBy("n", "name")
    prefix = (rows.join(common, "name").withColumn("place", F.row_number().over(order))
              .where("place <= size - ceil(%r * size) + 1 and lo < hi" % SIMILAR)
              .select("name", "doc_id", "label", "size", (F.col("size") - F.col("place") + 1).alias("left")))
    other = prefix.select("name", F.col("doc_id").alias("b"), F.col("label").alias("label_b"),
                          F.col("size").alias("size_b"), F.col("left").alias("left_b"))
    # From their first common entry on, both bags must hold the entries that a similar pair shares.
    return (prefix.join(other, "name").where("doc_id < b and label <> label_b")
            .where("5 * least(size, size_b) >= 4 * greatest(size, size_b)")
            .where("9 * least(left, left_b) >= 4 * (size + size_b)")
            .select(F.col("doc_id").alias("a"), "b").distinct())


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every document with an id; class_id is the least id of its class."""
    ship(docs.sparkSession)
    folder = work_dir(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    signed = _kept(_signed(texts), f"{folder}/signed")
    firsts = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    copies = _kept(signed.select("doc_id", "k1", "k2").join(firsts, ["k1", "k2"])
                   .select("doc_id", "rep"), f"{folder}/copies")
    apart = signed.where("size > 0").join(
        copies.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    banded = apart.select("doc_id", "size", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = _kept(banded.join(shared, ["band", "value"]), f"{folder}/met")
    # The original of many copies shares more bands than they do among themselves, and links them.
    wide = met.join(met.groupBy("doc_id").agg(F.sum("n").alias("reach")), "doc_id")
    centers = wide.groupBy("band", "value").agg(
        F.max(F.struct("reach", (-F.col("doc_id")).alias("minus"), "size")).alias("c"))
    members = _kept(met.join(centers, ["band", "value"]).select(
        "band", "value", "doc_id", "size", (-F.col("c.minus")).alias("center"),
        F.col("c.size").alias("center_size")), f"{folder}/members")
    bagged = _kept(_bagged(texts, members.select("doc_id").distinct()), f"{folder}/bags")
    stars = (members.where("doc_id <> center").where(
        f"least(size, center_size) >= {SIMILAR} * greatest(size, center_size)")
        .select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = _kept(_verified(stars, bagged), f"{folder}/links")
    labels = components(links, f"{folder}/first")
    # Bands whose documents have not all met.
    labelled = members.join(labels, "doc_id", "left").select(
        "band", "value", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    mixed = labelled.groupBy("band", "value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")
                                                  ).where("lo < hi").select("band", "value")
    rest = _kept(labelled.join(mixed, ["band", "value"]).select("doc_id", "label").distinct(),
                 f"{folder}/rest")
    more = _kept(_verified(_rare_pairs(rest, bagged), bagged), f"{folder}/more")
    every = copies.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.union(more).union(every), f"{folder}/last")
    return (texts.select("doc_id").distinct().join(final, "doc_id", "left")
            .select("doc_id", F.coalesce("label", "doc_id").alias("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the least id; rows without id stay.  Rows that share
    an id are one document and stay or go together."""
    kept = near_classes(docs).where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    found = named.join(kept, F.col("doc.doc_id") == F.col("kept_id"), "left").where(
        "kept_id is not null or doc.doc_id is null")
    return found.select("doc.*")
