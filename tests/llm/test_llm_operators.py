"""Each operator on odd documents, against plain Python or a round trip."""

import hashlib
import math
import random
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import samples
from samples import documents, odd_documents, words
from tallyflow.llm import (byte_repeats, decontaminate, hashing, mixing, near_dedup, quality_rules, repeats,
                           reply_trees, rule_classifier, token_counts, token_files, word_repeats)
from tallyflow.llm.queries import PIECE_BPE, WORD_BPE, tokenizer


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, clash=True).cache()


# --- rules -------------------------------------------------------------------------------------------

def test_ledger(spark, odd):
    got = rows_of(quality_rules.ledger(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                   "n_repeat_words"))
    want = []
    for i, text, *_ in odd_documents():
        text, w = text or "", words(text)
        lines = [x for x in text.split("\n") if words(x)]
        grams = samples.Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
                     len(lines) - len(set(lines)), len(hit)))
    assert got == sorted(want, key=repr)


def test_policies_and_ablation(spark, odd):
    book = quality_rules.ledger(odd).cache()
    kept = book.where(quality_rules.passes(F.col("fail_bits"))).count()
    assert quality_rules.keep(odd).count() == kept
    assert quality_rules.keep(odd).columns == odd.columns
    for row in quality_rules.ablation(book).collect():
        bit, mask = quality_rules.BITS[row.rule], quality_rules.mask(quality_rules.PRODUCTION)
        bits = [r.fail_bits & mask for r in book.collect()]
        assert row.n_failed == sum(bool(b & bit) for b in bits)
        assert row.n_only == sum(b == bit for b in bits)
        assert row.n_kept_without == sum(b & ~bit == 0 for b in bits)
    assert book.where(quality_rules.passes(F.col("fail_bits"), "base")).count() >= kept


# --- tokens -------------------------------------------------------------------------------------------

ALPHABET = [*"abcdethe's  \n\tÉéΣσς日ñß<>|0129.,'▁İ́ \x1c👍", "<|endoftext|>", "İ.", "the ", "  "]


def random_texts(n, size=30):
    draw = random.Random(4)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, size))) for _ in range(n)]


def test_word_encoder_is_the_library():
    own = token_files.encoder(tokenizer(WORD_BPE))
    texts = random_texts(3000) + [t or "" for _, t, *_ in odd_documents()]
    want = own.library.encode_batch(texts, add_special_tokens=False)
    for text, ids, e in zip(texts, own.encode([t.encode() for t in texts]), want):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, text


def test_token_files(spark, odd, tmp_path):
    manifest = token_files.write_token_files(odd, f"file://{tmp_path}", tokenizer(WORD_BPE), 2)
    got = token_files.read_token_files(manifest).orderBy("start").collect()
    library, at, want = token_files.encoder(tokenizer(WORD_BPE)).library, 0, []
    ids = {}
    for i, text, *_ in odd_documents():
        e = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        ids.setdefault(i, []).append(e)
        want.append((i is None, i or 0, len(e), zlib.crc32(e.tobytes())))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    order = [(r.doc_id is None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    for r in got:
        assert r.start == at
        at += r.n_tokens
    shards = [token_files.Shard(r.path) for r in manifest.collect()]
    found = [e.tolist() for s in shards for e in s.find(17)]
    assert sorted(found) == sorted(e.tolist() for e in ids[17])
    assert not any(s.find(999) for s in shards)


def test_shard_is_seekable_zstd_and_checked(tmp_path):
    path = str(tmp_path / "x.zst")
    writer = token_files.ShardWriter(path)
    parts = [np.arange(n, dtype=np.uint32) for n in (5, 0, 70_000)]
    for k, part in enumerate(parts):
        writer.add(k, part.tobytes())
    writer.close()
    whole = open(path, "rb").read()
    reader = token_files.zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True)
    assert reader.read().startswith(b"".join(p.astype("<u4").tobytes() for p in parts))
    shard = token_files.Shard(path)
    assert list(shard.frames()) == [p.tobytes() for p in parts]
    assert [shard.read(k).tolist() for k in (2, 0, 1)] == [parts[k].tolist() for k in (2, 0, 1)]
    shard.entries = shard.entries.copy()
    shard.entries["check"][0] += 1
    with pytest.raises(ValueError, match="damaged"):
        shard.read(0)


def test_folders_under_their_arrow_names(tmp_path):
    assert token_files.arrow_uri("s3a://shop/files/x") == "s3://shop/files/x"
    assert token_files.arrow_uri("hdfs://name:8020/files") == "hdfs://name:8020/files"
    assert token_files.arrow_uri("/files/a:b") == "file:///files/a:b"
    for uri in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        system, path = token_files.file_system(uri)
        assert system.type_name == "local" and path == str(tmp_path)


def test_counts_are_the_library(monkeypatch):
    own = token_counts.counter(tokenizer(PIECE_BPE))
    library = token_counts.sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_BPE))
    texts = random_texts(3000) + [t or "" for _, t, *_ in odd_documents()]
    want = [len(x) for x in library.encode(texts, num_threads=1)]
    assert [own.tokens(t) for t in texts] == want
    draw = random.Random(5)
    for text, n in zip(texts[:800], want):
        monkeypatch.setattr(token_counts, "CHUNK", draw.randint(1, 9))
        assert own.tokens(text) == n
    monkeypatch.setattr(token_counts, "KEPT_LENGTH", 3)
    own.clear()
    assert [own.tokens(t) for t in texts[:300]] == want[:300]


def test_count_query(spark, odd):
    library = token_counts.sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_BPE))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096)
            for i, t, *_ in odd_documents()]
    assert rows_of(token_counts.token_counts(odd, tokenizer(PIECE_BPE))) == sorted(want, key=repr)


# --- benchmark -----------------------------------------------------------------------------------------

ITEMS = [(1, "Seven wizards brew"), (2, samples.prose(40, 3)), (10, samples.SHARED.upper()), (3, None), (4, ""),
         (5, "..."), (6, "Größe, istanbul"), (2, samples.prose(20, 31)), (None, "the")]


def test_decontamination(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(((d[0], *found[:2], len(found[2]), hashlib.sha256(",".join(found[2]).encode()).hexdigest(),
                    found[1] > 0 and 20 * found[1] >= found[0])
                   for d, found in zip(odd_documents(), samples.contamination(
                       odd_documents(), [x for x in ITEMS if x[0] is not None]))), key=repr)
    got = decontaminate.hits(odd, items)
    assert rows_of(got.drop("spans")) == want
    assert rows_of(decontaminate.hits(odd, items, most=40).drop("spans")) == want
    assert rows_of(decontaminate.hits(odd, items, most=15).drop("spans")) == want
    in_passes = decontaminate.clean(odd, items, most=40)
    assert rows_of(in_passes.select("doc_id", "text")) == rows_of(decontaminate.clean(odd, items).select("doc_id", "text"))
    clean = decontaminate.clean(odd, items)
    assert clean.columns == odd.columns
    assert clean.count() == sum(not w[-1] for w in want)
    text = "Oh: SEVEN  wizards, brew! no"
    spans = decontaminate.hits(documents(spark, [(1, text, "", "")]), items).first().spans
    (start, end), = np.frombuffer(spans, "<i8").reshape(-1, 2)
    assert text[start:end] == "SEVEN  wizards, brew"


def test_an_automaton_has_about_a_node_per_word():
    """One automaton for what took sixteen before: 8 MB of items."""
    draw, text = random.Random(4), [samples.prose(40, k) for k in range(60)]
    items = [(k, " ".join(draw.choice(text).split()[::draw.choice([1, -1])])) for k in range(300)]
    items += [(1000 + k, " ".join(f"w{draw.randrange(50_000)}" for _ in range(13 * 40))) for k in range(200)]
    built = decontaminate.Automaton(items, 13)
    n_words = sum(len(t.split()) for _, t in items)
    assert built.trie.get_stats()["nodes_count"] <= n_words + 1
    docs = [(k, " ".join([samples.prose(5, k), *items[draw.randrange(500)][1].split()[k % 9:][:draw.randrange(8, 60)],
                          samples.prose(6, k)]), "", "") for k in range(300)]
    docs += [(900, " ".join("a b".split() * 40), "", "")]
    items.append((5000, " ".join("a b".split() * 9)))
    built = decontaminate.Automaton(items, 13)
    for (_, text, *_), (n, n_hit, found) in zip(docs, samples.contamination(docs, items)):
        hit = np.zeros(n, bool)
        got = built.scan(decontaminate.words(text))
        for a, b, _ in got:
            hit[a:b] = True
        assert int(hit.sum()) == n_hit and sorted({str(i) for *_, of in got for i in of}) == found


def test_states_are_shared_by_what_can_follow():
    """The machine of a vocabulary is finite: twice the texts hardly need more states than half of them."""
    own = token_counts.Transducer(tokenizer(PIECE_BPE))
    draw = random.Random(6)
    words_ = ["".join(draw.choice("abdeilnorst") for _ in range(draw.randrange(1, 14))) for _ in range(12_000)]
    counts, prefixes = [], set()
    for k, word in enumerate(words_):
        own.walk(0, "▁" + word)
        prefixes.update(("▁" + word)[:n] for n in range(len(word) + 2))
        if k in (5_999, 11_999):
            counts.append((len(own.states), len(prefixes)))
    (half, half_prefixes), (states, all_prefixes) = counts
    # A state per prefix would grow as the prefixes do.
    assert states < 0.8 * all_prefixes and states / half < all_prefixes / half_prefixes
    # After a run of one letter longer than any piece nothing new can happen.
    own.walk(0, "e" * 200)
    before = len(own.states)
    own.walk(0, "e" * 20_000)
    assert len(own.states) == before


# --- copies ------------------------------------------------------------------------------------------

def test_near_classes(spark, odd):
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(odd).collect()}
    assert got == samples.near_classes(odd_documents())
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, *got.values()}


def near_group():
    """An original with copies that are alike only through it, among loosely alike texts."""
    base = samples.prose(200, 41).split()
    rows = [(500, " ".join(base), "en", "a")]
    for k in range(40):
        own = list(base)
        for j in range(3 + k % 3):
            own[(k * 5 + j * 47) % 200] = f"new{k}x{j}"
        rows.append((k, " ".join(own), "en", "a"))
    return rows + [(1000 + k, samples.SHARED + " " + samples.prose(30, 100 + k), "en", "b") for k in range(40)]


def test_hub_and_loose_groups(spark):
    rows = near_group()
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(documents(spark, rows)).collect()}
    assert got == samples.near_classes(rows)


def test_rare_pairs_are_complete(spark):
    """The prefix filter alone finds all similar pairs."""
    rows = near_group()
    near_dedup.ship(spark)
    bagged = near_dedup._bagged(documents(spark, rows).select("doc_id", "text"),
                                documents(spark, rows).select("doc_id"))
    members = documents(spark, rows).select("doc_id", F.col("doc_id").alias("label"))
    found = {tuple(r) for r in near_dedup._rare_pairs(members, bagged).collect()}
    bags = {i: samples.bag(t) for i, t, *_ in rows}
    for a in bags:
        for b in bags:
            if a < b and 5 * sum((bags[a] & bags[b]).values()) >= 4 * sum((bags[a] | bags[b]).values()):
                assert (a, b) in found


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        names = draw.integers(1, 1 << 62, 60).astype(np.uint64)
        a, b = draw.integers(0, 9, 60), draw.integers(0, 9, 60)
        both = []
        for k, w in enumerate((a, b)):
            both.append((np.full(w.sum(), k), np.sort(np.repeat(names, w))))
        sig = near_dedup.signatures(np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]), 2)
        errors.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02


def test_components_of_a_chain(spark, tmp_path):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.doc_id: r.label for r in near_dedup.components(links, str(tmp_path)).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- repeats ------------------------------------------------------------------------------------------

def expected_bytes(rows):
    out = []
    for (i, *_), (data, gone) in zip(rows, samples.byte_repeats(rows)):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def short_documents():
    return [r for r in odd_documents() if r[1] is not samples.LONG] + [(7, samples.LONG[:9000], "", "")]


@pytest.mark.parametrize("hot", [2, 10_000])
def test_byte_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = short_documents() + [(30 + k, samples.SHARED + f" {k} " + samples.prose(20, 50 + k), "", "") for k in range(6)]
    got = byte_repeats.remove_repeats(documents(spark, rows, clash=True))
    assert rows_of(got.drop("kept")) == expected_bytes(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


@pytest.mark.parametrize("hot", [2, 10_000])
def test_word_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = short_documents() + [(30 + k, samples.SHARED + f" {k} " + samples.prose(20, 50 + k), "", "") for k in range(6)]
    # Two texts of one id, and texts without id, come in the order of their hashes.
    hashes = {r.text: (r.a, r.b & ~3) for r in documents(spark, [*rows, (0, "", "", "")]).where("text is not null").select(
        "text", F.xxhash64(F.lit(2), "text").alias("a"), F.xxhash64("text").alias("b")).collect()}
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add(r[1] or "")

    def order(r):
        by_text = hashes[r[1] or ""]
        if r[0] is None:
            return (repeats.NO_ID, *by_text)
        return (r[0], r[0], by_text[1] if len(texts[r[0]]) > 1 else 0)

    want = []
    for r, (w, gone) in zip(rows, samples.word_repeats([(i, t or "") for i, t, *_ in rows], order)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = word_repeats.remove_repeats(documents(spark, rows, clash=True))
    assert rows_of(got.drop("kept")) == sorted(want, key=repr)


def doubled(size):
    """Two words that polynomials modulo a power of two cannot tell apart."""
    a, b = "a", "b"
    while len(a) < size:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("size", [1024, 4096])
def test_doubled_words_have_names_of_their_own(spark, size):
    a, b = doubled(size)
    rows = [(1, samples.prose(10, 3) + f" {a} " + samples.prose(9, 5), "", ""),
            (2, samples.prose(10, 3) + f" {b} " + samples.prose(9, 5), "", "")]
    docs = documents(spark, rows)
    assert [r.n_removed for r in word_repeats.remove_repeats(docs).collect()] == [0, 0]
    assert sorted(r.class_id for r in near_dedup.near_classes(documents(
        spark, [(1, a, "", ""), (2, b, "", "")])).collect()) == [1, 2]


def test_equal_names_of_different_bytes():
    data = np.frombuffer(b"same words, same words, other words", np.uint8)
    first, size = np.array([0, 12, 24, 24, 0]), np.array([10, 10, 11, 11, 4])
    keys, names = np.zeros(5, np.uint64), np.full(5, 7, np.uint64)
    got = repeats.true_names(keys, names, data, first, size)
    assert got[0] == got[1] and got[2] == got[3] and len(set(got.tolist())) == 3
    assert repeats.equal_bytes(data, first, np.array([12, 0, 24, 12, 12]), size).tolist() == [
        True, True, True, False, True]


@pytest.mark.parametrize("module, cut", [(byte_repeats, byte_repeats.BytePieces),
                                         (word_repeats, word_repeats.WordPieces)])
def test_names_that_all_collide_change_nothing(monkeypatch, module, cut):
    """With one name for all pieces only the bytes decide."""
    rows = [r for r in short_documents() if r[0] is not None]
    pieces = cut([(r[1] or "").encode() for r in rows])
    payload, size, _ = pieces.content(pieces.text, pieces.start, pieces.n)
    order = np.argsort(pieces.key, kind="stable")
    data = payload[repeats.ragged((np.cumsum(size) - size)[order], size[order])].tobytes()
    ids = np.array([r[0] for r in rows])[pieces.text][order]

    def settled():
        return module.settle(pieces.key[order], data, size[order], ids, np.zeros(len(order), np.int64),
                             pieces.start[order])[0].tolist()

    want = settled()
    assert any(want) and not all(want)
    for name in ("byte_names", "run_names"):
        if hasattr(module, name):
            monkeypatch.setattr(module, name, lambda _, n: np.zeros(len(n), np.uint64))
    if module is word_repeats:
        monkeypatch.setattr(module, "rolled", lambda *a, f=module.rolled: f(*a) & np.uint64(3))
    assert settled() == want


def test_bucket_pointers_are_refined_until_fifty_bytes():
    draw = random.Random(7)
    pieces = ["".join(draw.choice("ab") for _ in range(draw.randrange(50, 120))) for _ in range(60)]
    pieces += [pieces[k][draw.randrange(9):] for k in range(40)] + ["x" * 113, "x" * 90, "y" * 49 + "z" * 3]
    pieces += ["".join(chr(33 + draw.randrange(90)) for _ in range(100)) for _ in range(30)]
    data = np.frombuffer("".join(pieces).encode(), np.uint8)
    size = np.array([len(p) for p in pieces])
    left = np.repeat(np.cumsum(size), size) - np.arange(size.sum())
    pointer, sorted_ = byte_repeats.bucket_pointers(data, left)
    whole = data.tobytes()
    seen = {}
    for at in np.flatnonzero(left >= 50).tolist():
        assert seen.setdefault(whole[at:at + 50], pointer[at]) == pointer[at]
    assert len(set(seen.values())) == len(seen)
    # Four rounds, each over fewer suffixes: what is settled is not sorted again.
    assert len(sorted_) == 4 and sorted_ == sorted(sorted_, reverse=True) and sorted_[3] < sorted_[0] / 2


def test_rows_without_id_keep_their_own_bytes(spark):
    """Many rows without id are documents of their own, told apart by 128 bits."""
    n = 3000
    rows = [(None, samples.prose(12, k) + f" {k}", "", "") for k in range(n)]
    rows += [(1, "x " * 40, "", ""), (None, "x " * 40, "", "")]
    docs = documents(spark, rows)
    got = byte_repeats.remove_repeats(docs).collect()
    assert len(got) == n + 2 and sum(r.n_removed > 0 for r in got) == 1
    texts = repeats.identified(docs)
    assert texts.where("version % 2 <> 0").select("doc", "version").distinct().count() == n + 1


@pytest.mark.parametrize("module,pieces", [(byte_repeats, byte_repeats.BytePieces),
                                           (word_repeats, word_repeats.WordPieces)])
def test_a_passage_of_all_documents_fills_no_bucket(spark, monkeypatch, module, pieces):
    """What a batch has settled goes past the buckets, for every batch and however hot the key."""
    monkeypatch.setattr(repeats, "BATCH", 4000)
    monkeypatch.setattr(repeats, "HOT", 100)
    n = 1500
    rows = [(k, samples.prose(25, 100 + k) + f" own{k} " + samples.SHARED, "", "") for k in range(n)]
    docs = documents(spark, rows).repartition(2)
    within = module is word_repeats
    entries = repeats.key_entries(repeats.identified(docs), pieces, within).withColumn(
        "size", sum(F.length(c) for c in ("keys", "docs", "seen", "seen_docs")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = entries.where(F.col("bucket") < repeats.BUCKETS * tasks)
    sizes = sorted(r.size for r in met.groupBy("bucket").agg(F.sum("size").alias("size")).collect())
    assert entries.select("batch").distinct().count() > 3
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    got = {r.doc_id: r.n_removed for r in module.remove_repeats(docs).collect()}
    least = len(samples.SHARED.split()) if within else len(samples.SHARED.encode())
    assert len(got) == n and all(got[k] >= least for k in range(1, n))


def test_symbols_depend_on_their_stretch_only():
    """Equal stretches of words give equal symbols, wherever they stand."""
    draw = np.random.default_rng(1)
    names = hashing.mix(draw.integers(0, 6, 3000).astype(np.uint64))
    text = np.repeat([0, 1, 2], 1000)
    sym, begin, low, high = word_repeats.recompressed(names, text)
    seen = {}
    for s, b, lo, hi in zip(sym, begin, low, high):
        if lo >= 0 and hi <= 3000 and len(set(text[max(lo, 0):hi])) == 1:
            for at in range(0, 3000 - (hi - lo)):
                if (names[at:at + hi - lo] == names[lo:hi]).all() and text[at] == text[at + hi - lo - 1]:
                    k = np.searchsorted(begin, at + b - lo)
                    assert begin[k] == at + b - lo and sym[k] == s
        if len(seen) > 50:
            break
        seen[b] = s


def test_packing():
    for values in ([], [5], [-3, 70_000, 1 << 40], [repeats.NO_ID, 0]):
        assert repeats.unpack(repeats.pack(np.array(values, np.int64))).tolist() == values


# --- classifier ---------------------------------------------------------------------------------------

def test_classifier_learns_and_scores_everything(spark, odd):
    good = [(i, samples.prose(60, i), "en", "a") for i in range(300)]
    bad = [(i, " | ".join(samples.prose(40, i).split()), "en", "a") for i in range(300, 400)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(400)] + [(None, 1), (1, None)],
                                   "doc_id long, quality int")
    model = rule_classifier.fit(docs, labels)
    assert 0 < len(model.weighted) < 40
    got = rule_classifier.classify(docs, model).collect()
    held = [r for r in got if r.held_out]
    assert 50 < len(held) < 110
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == int(r.doc_id < 300) for r in held) >= 0.95 * len(held)
    again = rule_classifier.fit(docs, labels)
    assert again == model
    scores = rule_classifier.classify(odd, model).collect()
    assert len(scores) == len(odd_documents()) and all(0 <= r.score <= 1 for r in scores)
    assert {r.held_out for r in scores if r.doc_id is None} == {False}


def plain_statistics(text):
    text = text or ""
    w, lines = words(text), text.split("\n")
    chars = sum(map(len, w))
    of = lambda n, whole: n / max(whole, 1)
    found = lambda chars_: sum(c in chars_ for c in text)
    return [float(len(w)), of(chars, len(w)), of(len(set(w)), len(w)),
            of(sum(a == b for a, b in zip(w, w[1:])), len(w)),
            of(sum(unicodedata.category(c) == "Lu" for c in text), chars), of(found("#*$%&<>^~=_"), chars),
            of(found("|"), len(w)), of(found("!"), len(w)), of(found(".,;:?"), len(w)), of(found("0123456789"), chars),
            of(len(w), len(lines)), of(len(lines) - len(set(lines)), len(lines))]


def test_scores_are_those_of_the_rules_in_plain_python(spark, odd):
    from conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = rule_classifier.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert model.weighted
    for table in (docs, odd):
        texts = table.select("doc_id", "text").collect()
        want = []
        for r in texts:
            stats = plain_statistics(r.text)
            total = model.intercept + sum(weight for rule, weight in model.weighted if all(
                stats[k] <= v if upper else stats[k] > v for k, upper, v in rule.bounds))
            want.append((r.doc_id, round(1 / (1 + math.exp(-total)), 9)))
        got = [(r.doc_id, round(r.score, 9)) for r in rule_classifier.classify(table, model).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_classifier_without_or_with_one_class(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rule_classifier.classify(docs, rule_classifier.fit(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    score = {r.score for r in rule_classifier.classify(docs, rule_classifier.fit(docs, ones)).collect()}
    assert len(score) == 1 and 0.5 < score.pop() < 1


# --- mixing ---------------------------------------------------------------------------------------------

def filled(sizes):
    """Targets by filling step by step."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        level = sum(weight[s] for s in sizes if s not in capped)
        over = {s for s in sizes if s not in capped and left * weight[s] / level > 3 * sizes[s]} if level else set()
        if not over:
            break
        capped |= over
    for s in sizes:
        target[s] = 3.0 * sizes[s] if s in capped else left * weight[s] / level
    return target


def test_mixing(spark, odd):
    sizes = {}
    for _, text, _, source in odd_documents():
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = filled(sizes)
    got = mixing.copies(odd).collect()
    assert len(got) == len(odd_documents())
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.n_copies <= 3
    for source in sizes:
        taken = [r.size * r.n_copies for r in got if r.source == source]
        assert abs(sum(taken) - want[source]) <= max(r.size for r in got if r.source == source) + 1
    assert rows_of(mixing.copies(odd)) == rows_of(mixing.copies(odd.repartition(7)))


def test_mixed_rows(spark, odd):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert rows_of(mixed.select("doc_id", "source")) == sorted(
        ((r.doc_id, r.source) for r in mixing.copies(odd).collect() for _ in range(r.n_copies)), key=repr)


def test_mix_of_null_and_repeated_ids_meets_its_targets(spark):
    """Rows that share an id, within and across sources, are taken each by their own place."""
    rows = [(None, samples.prose(1 + k % 13, k), "en", "abc"[k % 3]) for k in range(300)]
    rows += [(k % 4, samples.prose(1 + k % 17, k), "en", "abc"[k % 3]) for k in range(300)]
    docs = documents(spark, rows, clash=True)
    targets = {r.source: r.target for r in mixing.copies(docs).collect()}
    taken = {}
    for r in mixing.mix(docs).select("source", "text").collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
    assert set(taken) == set("abc")
    assert all(abs(taken[s] - targets[s]) <= 18 for s in taken)


# --- chats ----------------------------------------------------------------------------------------------

def test_escapes_are_reversible(spark):
    texts = ["", "\\", "##", "###", "####", "#\\#", "</turn>", "<\\/turn>", "\\\\</turn>\n### x: y", "a: b", "##\\##</turn"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", reply_trees.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", reply_trees.restored(F.col("e")).alias("back")).collect():
        assert r.back == r.t and "###" not in r.e and "</turn>" not in r.e


def test_chats_of_odd_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, None, "x: y"), (2, 5, "a: b:", "### </turn>\n"),
            (None, 0, "user", "q"), (None, 1, "assistant", "a"), (3, 0, "assistant", "👍 é"), (3, 0, "assistant", "👍 é")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = reply_trees.format_trees(reply_trees.chain(turns))
    got = {r.conv_id: ([tuple(t) for t in r.t], r.l) for r in made.select(
        "conv_id", reply_trees.read_turns(F.col("formatted")).alias("t"),
        reply_trees.read_loss(F.col("formatted"), F.col("loss")).alias("l")).collect()}
    assert got == {1: ([("user", "hi"), ("", "x: y"), ("assistant", "")], [""]),
                   2: ([("a: b:", "### </turn>\n")], []), None: ([("user", "q"), ("assistant", "a")], ["a"]),
                   3: ([("assistant", "👍 é")] * 2, ["👍 é"] * 2)}


def test_branches_are_ranked(spark):
    #      1 - 2 - 4        scores: 2: 1, 3: 5, 4: 9, 5: 1 ; 6 is a root of its own, 8 and 9 a cycle
    #        \ 3 - 5
    rows = [(7, 1, None, 0.0), (7, 2, 1, 1.0), (7, 3, 1, 5.0), (7, 4, 2, 9.0), (7, 5, 3, 1.0), (7, 6, 99, 2.0),
            (7, 8, 9, 50.0), (7, 9, 8, 50.0)]
    nodes = spark.createDataFrame([(*r, "user", f"t{r[1]}") for r in rows],
                                  "conv_id long, node_id long, parent_id long, score double, role string, text string")
    made = reply_trees.format_trees(nodes, best=3).orderBy("path_rank")
    got = [[t.text for t in r.t] for r in made.select("path_rank", reply_trees.read_turns(F.col("formatted")).alias("t")).collect()]
    assert got == [["t1", "t2", "t4"], ["t1", "t3", "t5"], ["t6"]]


def test_long_chain(spark):
    turns = spark.range(300).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    r = reply_trees.format_trees(reply_trees.chain(turns)).select(
        reply_trees.read_turns(F.col("formatted")).alias("t")).first()
    assert [t.text for t in r.t] == [str(k) for k in range(300)]


# --- empty tables --------------------------------------------------------------------------------------

def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert quality_rules.ledger(none).count() == 0
    assert quality_rules.ablation(quality_rules.ledger(none)).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(
        none, str(tmp_path / "t"), tokenizer(WORD_BPE), 2)).count() == 0
    assert decontaminate.hits(none, items).count() == 0
    assert decontaminate.hits(documents(spark), items.limit(0)).where("n_hit > 0").count() == 0
    assert near_dedup.near_classes(none).count() == 0
    assert byte_repeats.remove_repeats(none).count() == 0
    assert word_repeats.remove_repeats(none).count() == 0
    assert mixing.copies(none).count() == 0
    assert token_counts.token_counts(none, tokenizer(PIECE_BPE)).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reply_trees.format_trees(reply_trees.chain(turns)).count() == 0
