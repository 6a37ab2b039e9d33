"""Token ids of texts by a sentencepiece BPE vocabulary, and texts from ids, in vectorised rounds.

The new words of a batch lie in one flat array of symbols.  A round looks up the pair at every
place, takes the least rank of each word, merges its occurrences from the left at once, and
compacts the array; words without pairs leave it.  Only pairs beside a merge are looked up again.

Merging all occurrences of the least pair at once is the same as one by one if no pair made by
such a merge ranks before it or beside it; for other pieces only the leftmost place is merged in a round.  In
words of more than ``LONG`` symbols a pair is merged as soon as it ranks first among all pairs
within the length of the longest piece: what happens farther away cannot reach it, as every
piece that grows into this stretch from outside is shorter than it.  So a word of a million letters takes as
many rounds as its pairs are nested, not as many as it has pairs.

No piece crosses from a character to a space mark, holds a line end, or mixes Latin letters with
others (checked when the model is loaded), so a text is a row of such segments; each segment is
encoded once and kept in a bounded table.

Defined results: null text is empty; an empty text has no ids; texts of blanks are runs of space
pieces; characters outside the vocabulary are spelled in byte pieces; very long texts and words are
worked on whole; rows are treated one by one, so ties and repeated rows keep their rows; a null
doc_id stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.hashing import slices
from tallyflow.llm.shipping import ship

MARK = "▁"
ID = np.dtype("<i4")
KEPT_WORDS = 500_000
LONG = 128
NONE = -1
# Latin letters share no piece with other characters, so a segment is of one kind.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTER = re.compile(f"[{_LATIN}]")
_SEGMENT = re.compile(rf" *[{_LATIN}]+| *[^ \n{_LATIN}]+|\n| +")

# A segment begins at a line end and at a blank behind something else.
_BORDER = re.compile(r"\n|(?<=[^ ]) ")
PART = 1 << 20


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_by_one", _one_by_one)


class Pieces:
    """The vocabulary as arrays.  A symbol is a piece id, or ``size`` + code point where there is no
    piece for a character."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = size = model.get_piece_size()
        whole = {model.id_to_piece(i): i for i in range(size)
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                         or model.is_unused(i))}
        for probe, want in (("a  b ", "▁a▁▁b▁"), ("ﬁ A\t", "▁ﬁ▁A\t")):
            if model.normalize(probe) != want:
                raise ValueError("only models that leave their text as it is")
        crossing = [p for p in whole if MARK in p.lstrip(MARK) or "\n" in p or
                    len({bool(_LETTER.match(c)) for c in p.lstrip(MARK)}) > 1]
        if crossing:
            raise ValueError(f"pieces across segments: {crossing[:3]}")
        self.reach = max(map(len, whole))
        self.char = np.arange(0x110000, dtype=np.int64) + size
        for piece, i in whole.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], ID)
        scores = -np.array([model.get_score(i) for i in range(size)])
        _, rank, alike = np.unique(scores, return_inverse=True, return_counts=True)
        # The last entry is the rank of no pair.
        self.rank = np.append(rank.astype(np.int32), np.int32(1 << 30))
        pairs, one_at_a_time = [], alike[rank] > 1
        for piece, i in whole.items():
            for cut in range(1, len(piece)):
                left, right = whole.get(piece[:cut]), whole.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, i))
                    for part in (left, right):
                        one_at_a_time[part] |= rank[i] <= rank[part]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_piece = np.array([i for _, i in pairs], np.int64)
        self.one_at_a_time = np.append(one_at_a_time, False)
        self.surface = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else
                        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else
                        model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        self.blank = whole[MARK]
        self.run = max(len(p) for p in whole if not p.strip(MARK))
        self.run_piece = whole[MARK * self.run]
        self.control = np.array([model.is_control(i) for i in range(size)])
        self.marked = np.zeros(size, bool)
        self.marked[[i for p, i in whole.items() if p.startswith(MARK)]] = True

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or NONE."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_piece[at], NONE)


def _window_least(rank: np.ndarray, radius: int) -> np.ndarray:
    """Least entry within ``radius`` places to either side."""
    width, have, size = 2 * radius + 1, np.concatenate([np.full(radius, 1 << 30, rank.dtype), rank,
                                                        np.full(radius, 1 << 30, rank.dtype)]), 1
    while 2 * size <= width:
        have = np.minimum(have[:-size], have[size:])
        size *= 2
    rest = width - size
    return np.minimum(have[:len(have) - rest], have[rest:]) if rest else have


def _first_of_equals(rank: np.ndarray, chosen: np.ndarray, radius: int) -> np.ndarray:
    """Places with no chosen place of equal rank within ``radius`` before them."""
    at = np.flatnonzero(chosen)
    out = np.zeros(len(rank), bool)
    order = np.lexsort((at, rank[at]))
    sorted_at, sorted_rank = at[order], rank[at][order]
    near = np.zeros(len(at), bool)
    near[1:] = (sorted_rank[1:] == sorted_rank[:-1]) & (sorted_at[1:] - sorted_at[:-1] <= radius)
    out[sorted_at[~near]] = True
    return out


class Rounds:
    """Merges the words of one flat array."""

    def __init__(self, pieces: Pieces, symbols: np.ndarray, lengths: np.ndarray):
        self.pieces = pieces
        self.symbols, self.lengths = symbols, lengths
        self.words = np.arange(len(lengths))
        self.rounds = 0

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, length) of all words in order."""
        pieces, done = self.pieces, []
        symbols, lengths, words = self.symbols, self.lengths, self.words
        # The pair that starts at each place; none at the last place of a word.
        made = np.full(len(symbols), NONE, np.int64)
        ends = np.cumsum(lengths)
        inner = np.ones(len(symbols), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        made[at] = pieces.pair(symbols[at], symbols[at + 1])
        while len(words):
            rank = pieces.rank[made]
            starts = np.cumsum(lengths) - lengths
            least = np.minimum.reduceat(rank, starts)
            going = least < 1 << 30
            if not going.all():
                gone = np.repeat(~going, lengths)
                done.append((words[~going], lengths[~going], symbols[gone]))
                symbols, made, rank = symbols[~gone], made[~gone], rank[~gone]
                words, lengths, least = words[going], lengths[going], least[going]
                if not len(words):
                    break
                starts = np.cumsum(lengths) - lengths
            self.rounds += 1
            merge = self._chosen(rank, made, lengths, starts, least)
            left = np.flatnonzero(merge)
            symbols[left] = made[left]
            # The right symbol goes; the place of the merge takes over the pair behind it.
            made[left] = NONE
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            moved = left - np.arange(len(left))
            word_of_merge = np.searchsorted(starts, left, side="right") - 1
            lengths = lengths - np.bincount(word_of_merge, minlength=len(lengths))
            symbols, made = symbols[keep], made[keep]
            starts = np.cumsum(lengths) - lengths
            first, last = starts[word_of_merge], starts[word_of_merge] + lengths[word_of_merge] - 1
            beside = np.zeros(len(symbols), bool)
            beside[moved[moved < last]] = True
            beside[moved[moved > first] - 1] = True
            again = np.flatnonzero(beside)
            made[again] = pieces.pair(symbols[again], symbols[again + 1])
        number = np.concatenate([w for w, _, _ in done])
        length = np.concatenate([n for _, n, _ in done])
        flat = np.concatenate([s for _, _, s in done])
        order = np.argsort(number)
        begin = (np.cumsum(length) - length)[order]
        length = length[order]
        out = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin, length)
        return flat[out], length

    def _chosen(self, rank, made, lengths, starts, least) -> np.ndarray:
        """Places merged in this round."""
        pieces = self.pieces
        chosen = rank == np.repeat(least, lengths)
        long = lengths > LONG
        alone = pieces.one_at_a_time[made] & chosen
        if long.any():
            # Words side by side stay apart: between them lie as many places without a pair.
            which = np.flatnonzero(long)
            of = np.repeat(long, lengths)
            padded = lengths[which] + pieces.reach
            place = np.concatenate([np.arange(n) + s for n, s in zip(
                lengths[which].tolist(), (np.cumsum(padded) - padded).tolist())])
            own = np.full(int(padded.sum()), 1 << 30, rank.dtype)
            own[place] = rank[of]
            near = (own < 1 << 30) & (own == _window_least(own, pieces.reach))
            solo = np.zeros(len(own), bool)
            solo[place] = pieces.one_at_a_time[made[of]]
            near &= ~solo | _first_of_equals(own, own < 1 << 30, pieces.reach)
            # Overlapping places of one pair count from the first of their run, which must be in.
            begin = np.ones(len(own), bool)
            begin[1:] = own[1:] != own[:-1]
            run_start = np.maximum.accumulate(np.where(begin, np.arange(len(own)), 0))
            last_out = np.maximum.accumulate(np.where(~near, np.arange(len(own)), -1))
            near &= solo | (last_out < run_start)
            chosen[of], alone[of] = near[place], False
        if alone.any():
            # Only the leftmost such place of a word.
            at = np.flatnonzero(alone)
            word = np.searchsorted(starts, at, side="right")
            chosen[at[1:][word[1:] == word[:-1]]] = False
        # Of places in a row every second one, from the left; a row stays within its word, as the
        # last place of a word has no pair.
        begin = chosen.copy()
        begin[1:] &= ~chosen[:-1]
        index = np.arange(len(chosen))
        run_start = np.maximum.accumulate(np.where(begin, index, 0))
        return chosen & ((index - run_start) % 2 == 0)


def parts(text: str) -> Iterator[str]:
    """A text cut before segments, into stretches of about PART characters."""
    at = 0
    while len(text) - at > PART:
        border = _BORDER.search(text, at + PART)
        cut = border.start() if border else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


class Encoder:
    def __init__(self, model_file: str):
        self.pieces = Pieces(model_file)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers; a very long text part by part."""
        whole = [" " + t.replace(MARK, " ") if t else "" for t in texts]
        short = iter(self._ids([t for t in whole if len(t) <= PART]))
        return [next(short) if len(t) <= PART else b"".join(self._ids([part])[0] for part in parts(t))
                for t in whole]

    def _ids(self, texts: list[str]) -> list[bytes]:
        split = [_SEGMENT.findall(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        new = list(set().union(*split).difference(known))
        if new:
            known.update(zip(new, self.merged(new)))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of segments (blanks stand for marks), in rounds over all of them."""
        pieces = self.pieces
        # A long run of blanks is taken in full space pieces from the left; the rest joins what follows.
        runs = []
        if any(w.startswith(" " * (3 * pieces.run)) for w in words):
            cut = []
            for w in words:
                n = max(0, (len(w) - len(w.lstrip(" "))) // pieces.run - 2)
                runs.append(n)
                cut.append(w[n * pieces.run:])
            words = cut
        points = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols, lengths = Rounds(pieces, pieces.char[points], lengths).run()
        symbols, lengths = self._spelled(symbols, lengths)
        data = symbols.astype(ID).tobytes()
        ends = (np.cumsum(lengths) * ID.itemsize).tolist()
        out = [data[a:b] for a, b in zip([0, *ends], ends)]
        if runs:
            full = np.array([pieces.run_piece], ID).tobytes()
            out = [full * n + ids for n, ids in zip(runs, out)]
        return out

    def _spelled(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        pieces = self.pieces
        odd = np.flatnonzero(symbols >= pieces.size)
        if not len(odd):
            return symbols, lengths
        spelled = [chr(c).encode() for c in (symbols[odd] - pieces.size).tolist()]
        count = np.ones(len(symbols), np.int64)
        count[odd] = [len(s) for s in spelled]
        out = np.repeat(symbols, count)
        at = np.repeat(symbols >= pieces.size, count)
        out[at] = pieces.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
        word = np.repeat(np.arange(len(lengths)), lengths)
        return out, np.bincount(word, weights=count, minlength=len(lengths)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks become blanks, the first blank goes, broken bytes are replaced."""
        if not len(ids):
            return ""
        pieces = self.pieces
        data = b"".join(map(pieces.surface.__getitem__, ids.tolist()))
        if pieces.marked[ids[np.argmax(~pieces.control[ids])]]:
            data = data[1:]
        return data.decode("utf-8", "one_by_one")


_ENCODERS: dict[str, Encoder] = {}


def encoder(model_file: str) -> Encoder:
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = Encoder(model_file)
    return _ENCODERS[model_file]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_file)
        for batch in batches:
            size = batch.column(1).cast(pa.binary())
            for first, last in slices(size.to_pylist()):
                part = batch.slice(first, last - first)
                ids = own.encode(part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, ids)]) // ID.itemsize
                values = pa.array(np.frombuffer(b"".join(ids), ID), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                    names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids and text of every row of (doc_id, ids); null ids are none."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_file)
        for batch in batches:
            ids = batch.column(1)
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.asarray(ids.offsets)
            ends = ends - ends[0]
            texts = [own.decode(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    rows = encoded.select(F.col("doc_id").cast("long"),
                          F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")
