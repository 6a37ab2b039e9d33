"""Prefix trie, sentence pieces and spelling variants against plain Python and the library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import samples
from tallyflow.llm import prefix_trie, sentence_pieces, spelling
from tallyflow.llm.queries import PIECE_BPE, QUERIES, tokenizer

TURNS = "conv_id long, turn long, role string, text string"


# --- prefix trie ---------------------------------------------------------------------------------------

def plain_trie(sequences):
    """Rows of all nodes from {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, m in members.items():
        gain = (len(m) - 1) * len(samples.words(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += gain
            leaves[path[:d]] += path not in children
    out = []
    for path, m in members.items():
        ends = sorted(c for c in m if len(sequences[c]) == len(path))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), children[path],
                    leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_rows(spark, rows, tmp_path, name="conversations"):
    spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("x") for c in ("shard", "ids", "words", "depth", "key", "k")}).write.parquet(
        f"{tmp_path}/{name}/conversations.parquet")
    got = QUERIES["op11_prefix_trie"](spark, f"{tmp_path}/{name}")
    return sorted([tuple(r) for r in got.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()], key=repr)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_trie_of_random_conversations(spark, tmp_path, shards):
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        r, rows = random.Random(shards), []
        for c in range(-30, 170):
            for t in range(r.choice([0, 1, 2, 3, 3, 5])):
                rows.append((c, t, r.choice(["user", "bot"]), r.choice(["a b", "a", "", "c d e"])))
        copies = [(i, f"shared turn {i}") for i in range(200)]
        for c in range(200, 330):  # long copies, ended at different turns
            rows += [(c, i, "user", x) for i, x in copies[:r.choice([4, 63, 64, 65, 130, 200, 200])]]
        assert trie_rows(spark, rows, tmp_path) == plain_trie(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_trie_of_odd_conversations(spark, tmp_path):
    rows = [(None, 0, "user", "nobody"), (1, None, None, None), (1, None, "user", "first"), (1, 2, "a", "b"),
            (1, 2, "a", "b"), (2, 0, "ab", "c"), (3, 0, "a", "bc"), (40, 0, "user", samples.LONG),
            (41, 0, "user", samples.LONG), (41, 1, "user", None), (20, -1, "x", ""), (21, 5, "x", "")]
    rows += [(c, 0, "user", "same") for c in range(100, 140)]
    assert trie_rows(spark, rows, tmp_path) == plain_trie(rebuilt(rows))
    assert trie_rows(spark, [], tmp_path, "none") == []
    assert trie_rows(spark, [(None, 1, "a", "b")], tmp_path, "nulls") == []


def test_copies_fill_many_shards(spark, tmp_path):
    """Copies of one conversation are dealt to all shards, not to one."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        seqs = spark.range(20_000).select(F.col("id").alias("conv_id"), F.array(F.lit(1).cast("long"), F.lit(2).cast(
            "long")).alias("ids"), F.array(F.lit(3)).alias("words"))
        trie = prefix_trie.prefix_trie(seqs)
        sizes = [r.n for r in trie.parts.groupBy("shard").agg(F.sum(F.size("ends")).alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 16
        rows = {r.depth: r for r in trie.nodes.collect()}
        assert (rows[1].n_convs, rows[1].saved_tokens, rows[0].n_leaves) == (20_000, 19_999 * 3, 1)
        (end,) = prefix_trie.part_digests(trie.parts).collect()
        assert end.ends_sha256 == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# --- sentence pieces -----------------------------------------------------------------------------------

MODEL = tokenizer(PIECE_BPE)
LETTERS = [*"abcdethe's  \n\tÉéΣσς日ñß<>|0129.,'▁İ́ \x1c👍\r\x00", "<|endoftext|>", "İ.", "the ", "  ", "ing", "ion",
           " " * 20, "ation", "<s>", "<0x0A>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return sentence_pieces.Encoder(MODEL)


def ids_of(own, texts):
    return [np.frombuffer(x, sentence_pieces.ID).tolist() for x in own.encode(texts)]


def test_ids_of_random_texts(own, library):
    r = random.Random(3)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 40))) for _ in range(20_000)]
    texts += ["".join(chr(r.choice([r.randint(32, 0x2FFF), r.randint(0x4E00, 0x9FFF), r.randint(0x1F300, 0x1F6FF)]))
                      for _ in range(30)) for _ in range(500)]
    texts += [" " * k + "a" + " " * j for k in range(120) for j in (0, 1, 17, 50)]
    assert ids_of(own, texts) == library.encode(texts)


def test_ids_of_texts_in_parts(own, library, monkeypatch):
    r = random.Random(9)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    for size in (1, 7, 30):
        monkeypatch.setattr(sentence_pieces, "PART", size)
        assert ids_of(own, texts) == library.encode(texts)


@pytest.mark.parametrize("parts", [[*"abcdehilnorstuvwyz"], [*"aab"], ["th", "e", "in", "g", "er", "an", "ion"],
                                   ["a"], [*"ACGT"], [*"日本語"], ["-", "=", "_"]])
def test_ids_of_long_words(own, library, parts):
    """Words beyond LONG take the windowed rule."""
    r = random.Random(len(parts))
    texts = ["".join(r.choice(parts) for _ in range(r.randint(100, 1500))) for _ in range(60)]
    texts.append("".join(r.choice(parts) for _ in range(100_000)))
    assert ids_of(own, texts) == library.encode(texts)


def test_rounds_of_a_long_word_do_not_grow_with_it(own):
    r, counts = random.Random(1), []
    for size in (2_000, 200_000):
        points = np.frombuffer("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size)).encode(
            "utf-32-le"), "<u4")
        rounds = sentence_pieces.Rounds(own.pieces, own.pieces.char[points], np.array([size]))
        rounds.run()
        counts.append(rounds.rounds)
    assert counts[1] < 3 * counts[0]


def test_texts_of_random_ids(own, library):
    r = random.Random(4)
    rows = [[r.randint(0, 31_999) if r.random() < 0.7 else r.randint(0, 300) for _ in range(r.randint(0, 12))]
            for _ in range(30_000)]
    assert [own.decode(np.array(x, sentence_pieces.ID)) for x in rows] == [library.decode(x) for x in rows]


def test_odd_documents_there_and_back(spark, library):
    docs = samples.documents(spark, clash=True)
    got = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL)
    assert got.columns == ["doc_id", "ids", "text"]
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, *_ in
            samples.odd_documents()]
    assert sorted([(r.doc_id, r.ids, r.text) for r in got.collect()], key=repr) == sorted(want, key=repr)
    assert sentence_pieces.encode(samples.documents(spark, []), MODEL).count() == 0


def test_kept_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KEPT_WORDS", 50)
    own, texts = sentence_pieces.Encoder(MODEL), [samples.prose(30, k) for k in range(40)]
    for t in texts:
        assert ids_of(own, [t]) == [library.encode(t)]
        assert len(own.known) < 50 + 30 * 2


# --- spelling variants ---------------------------------------------------------------------------------

def plain_variants(rows):
    import re

    counts = Counter()
    for i, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            counts[spelling.changed(b"" if i is None else str(i).encode(), run)] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    found, forms = {}, {}
    for w, n in words.items():
        others = sorted((-words[v], v) for v in words if near(w, v))
        form = others[0][1] if others and -others[0][0] >= 5 * n else None
        found[w], forms[w] = len(others), form
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, found[w], forms[w], words[forms[w]] if forms[w] else None, root))
    return sorted(out, key=repr)


def test_variants_of_random_words(spark):
    r = random.Random(8)
    base = ["".join(r.choice("abcé") for _ in range(r.randint(6, 9))) for _ in range(40)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaab", "A" * 8, "straße" + "x" * 3, "prefix" * 30 + "a", "prefix" * 30 + "b"]
    weights = [r.choice([1, 5, 30, 200]) for _ in base]
    rows = []
    for i in range(300):
        text = []
        for w in r.choices(base, weights, k=60):
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", "a", "b", w[at] + "c"]) + w[at + 1:]
            text.append(w)
        rows.append((i, r.choice([" ", "-", "1"]).join(text), "en", "a"))
    rows += [(None, " ".join(base), "en", None), (3, None, "en", "a"), (4, "", None, None), (299, rows[299][1], "", "")]
    got = spelling.variants(samples.documents(spark, rows, clash=True))
    want = plain_variants(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[3] is not None for w in want) > 20


def test_a_chain_of_forms_and_very_long_words(spark):
    word = "w" + "abcdefgh" * 2_000
    chain = [(word + "xyz"[:k], 640 // 5 ** (3 - k)) for k in range(4)]
    rows = [(5, " ".join(" ".join([w] * n) for w, n in chain), "en", "a")]
    got = {len(r.word): r for r in spelling.variants(samples.documents(spark, rows)).collect()}
    assert sorted(map(tuple, got.values()), key=repr) == plain_variants(rows)
    assert {r.root for r in got.values()} == {word + "xyz"} and got[len(word)].form == word + "x"
    assert spelling.variants(samples.documents(spark, [])).count() == 0


def test_nodes_are_numbered_once(spark, tmp_path):
    """A start of words has one number, in whatever range the words lie."""
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(400)} | {"x" * 300 + "y"})
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = spelling.numbered(df, str(tmp_path / "nodes")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    number = {}
    for row in rows:
        for k, node in enumerate(row.nodes):
            assert number.setdefault(row.word[:k], node) == node
    assert len(set(number.values())) == len(number) and len(rows) == len(words)
