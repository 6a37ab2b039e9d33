"""Documents with every odd case, and plain Python forms of the operators."""

import datetime as dt
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("the quick brown fox jumps over a lazy dog while seven wizards brew strange potions near "
         "old castle walls and nobody in the village below knows what they will turn out to do when "
         "winter comes again with snow ice and long dark nights full of stories told by firelight").split()


def prose(n, seed):
    return " ".join(PROSE[(i * i * 7 + i * seed + seed) % len(PROSE)] + str((i * seed) % 13)
                    for i in range(n))


LONG = prose(40_000, 5)
SHARED = prose(70, 11)


def odd_documents():
    """(doc_id, text, lang, source) with nulls, empty and very long texts, ties and copies."""
    rows = [
        (1, prose(120, 3), "en", "a"), (2, prose(120, 3), "en", "a"),  # copies
        (3, None, "en", "a"), (4, "", None, None), (5, " \t\n \x0b", "en", "b"), (6, "", "en", "b"),
        (7, LONG, "en", "b"), (8, prose(3, 7), "en", "c"),
        (9, SHARED + " " + prose(90, 17), "en", None), (10, prose(50, 19) + "\n" + SHARED, "de", "c"),
        (11, "Der " * 300, "de", "a"), (12, "ab" * 400, "de", "a"), (13, "Größe, İSTANBUL. 日本語 👍 " * 12, "x", "d"),
        (14, prose(119, 3) + " changed", "en", "a"),  # near copy of 1
        (15, "### Assistant: </turn> <|endoftext|> \\ $$$ %%% ||| !!!", "en", "b"),
        (None, prose(60, 23), "en", "a"), (None, None, None, None),
        (16, prose(80, 29), "en", "d"), (16, prose(80, 29), "en", "d"),  # the same row twice
        (17, prose(80, 31), "en", "d"), (17, prose(75, 37), "en", "d"),  # one id, two texts
        (-5, prose(30, 11) + " " + SHARED, "en", "e"), (18, "word\nword\n\nword\n" * 20, "en", "e"),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"
# Names that the operators use inside.
CLASH = ["n_words", "size", "target", "doc", "version", "own", "packed", "first", "key", "start", "n",
         "class_id", "kept_id", "taken_id", "fail_bits", "m", "block", "bands", "label", "score", "held_out",
         "n_tokens", "part", "contaminated", "n_hit", "rate", "place"]


def documents(spark, rows=None, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_documents() if rows is None else rows, SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit(dt.date(2020, 1, 1)) for c in CLASH})
    return df


def words(text):
    return WORD.findall(text or "")


def bag(text):
    w = words(text)
    if len(w) < 5:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_classes(rows):
    """doc_id -> least id of its class, comparing all pairs."""
    rows = [(i, t) for i, t, *_ in rows if i is not None]
    bags = [(i, bag(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(bags):
        for j, b in bags[:k]:
            shared, total = sum((a & b).values()), sum((a | b).values())
            if 5 * shared >= 4 * total:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in parent}


def byte_repeats(rows):
    """Rows of (bytes, covered) in order, for 50-byte strings of smaller ids."""
    order = lambda i: float("inf") if i is None else i
    least = {}
    for i, text, *_ in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            piece = data[k:k + 50]
            least[piece] = min(order(i), least.get(piece, float("inf")))
    out = []
    for i, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if least[data[k:k + 50]] < order(i):
                gone[k:k + 50] = b"\1" * 50
        out.append((data, gone))
    return out


def word_repeats(rows, order):
    """Rows of (words, covered); ``order(row)`` tells which document comes first."""
    first = {}
    for row in sorted({(order(r), r[1]) for r in rows}):
        w = words(row[1])
        for k in range(len(w) - 19):
            first.setdefault(tuple(w[k:k + 20]), (row[0], k))
    out = []
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if first[tuple(w[k:k + 20])] != (order(r), k):
                gone[k:k + 20] = [True] * 20
        out.append((w, gone))
    return out


def contamination(rows, items, size=13):
    fold = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: fold.findall((t or "").encode().lower() if t is None or t.isascii() else
                                   re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        if w:
            n = min(size, len(w))
            for k in range(len(w) - n + 1):
                windows[tuple(w[k:k + n])].add(item)
    out = []
    for _, text, *_ in rows:
        w = split(text)
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                ids = windows.get(tuple(w[k:k + n]))
                if ids:
                    hit[k:k + n] = [True] * n
                    found |= ids
        out.append((len(w), sum(hit), sorted(map(str, found))))
    return out
