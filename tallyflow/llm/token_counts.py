"""Token counts by a finite-state transducer compiled from a sentencepiece BPE vocabulary.

BPE of a text is settled at every place by the last piece of the text so far: piece t ends a
prefix if the piece u before it and t stay apart when ``u + t`` is merged alone.  What can still follow depends on
the longest end of the text that begins a piece, and on the last piece and the number of tokens at each place in it: that is a
state.  Prefixes that agree in it are one state, whatever stood before, so the
number of states depends on the vocabulary and not on the texts.  A transition carries the change of the number of tokens
(it may be negative, when a piece swallows earlier ones).  Transitions are compiled when first taken.

No piece crosses from a character to a space mark, mixes letters with others, or touches a line
end; there the machine goes back to its start.  So a chunk of a text acts as a state map that is known but for its
head: whatever state it is entered in, after its first such border its count and exit are the same.
A long text is cut into chunks anywhere, and their maps are composed pairwise.

Defined results: null text is empty and has 0 tokens; repeated rows are counted each; very long
texts are cut into chunks, never shortened; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.shipping import ship

MARK = "▁"
LIMIT = 4096
CHUNK = 1 << 16
KEPT_SEGMENTS = 250_000
KEPT_PAIRS = 250_000
# The machine of a text in a few languages has far fewer states; this bounds it for any input.
KEPT_STATES = 400_000
KEPT_LENGTH = 1024
# Latin letters share no piece with other characters, so a segment is of one kind.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LETTER = re.compile(f"[{_LATIN}]")
SEGMENT = re.compile(rf"\n| *[{_LATIN}]+| *[^ \n{_LATIN}]+| +")


class Transducer:
    """Deterministic machine over the characters of a segment; a state is what its future depends on."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids
                      if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                              or model.is_unused(i))}
        crossing = [p for p in self.score if MARK in p.lstrip(MARK) or "\n" in p or
                    len({bool(LETTER.match(c)) for c in p.lstrip(MARK)}) > 1]
        if crossing:
            raise ValueError(f"pieces across segments: {crossing[:3]}")
        self.begins = {p[:k] for p in self.score for k in range(len(p) + 1)}
        self.apart: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """State 0 is the start of a segment: nothing read, no piece, no token."""
        self.known: dict[tuple, int] = {}
        self.states: list[tuple[str, tuple[str, ...], tuple[int, ...]]] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self._state("", ("",), (0,))

    def _state(self, end: str, last: tuple[str, ...], tokens: tuple[int, ...]) -> int:
        """The state of a text with this end; last piece and tokens (less those of all) at each place in it."""
        # No piece can begin where the rest of the text begins none.
        open_ = [end[k:] in self.begins for k in range(len(end) + 1)]
        key = (end, tuple(x if o else None for x, o in zip(last, open_)),
               tuple(n if o else None for n, o in zip(tokens, open_)))
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return found

    def merged(self, text: str) -> list[str]:
        """Pieces of a short string by repeated best merge, leftmost first among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: str, right: str) -> bool:
        """Do two pieces side by side stay as they are?"""
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) >= KEPT_PAIRS:
                self.apart.clear()
            want = [left, right] if left else [right]
            known = self.apart[left, right] = self.merged(left + right) == want
        return known

    def compiled(self, state: int, char: str) -> tuple[int, int]:
        """The transition of a state by a character: (next state, change of the number of tokens)."""
        end, last, tokens = self.states[state]
        read = end + char
        if char in self.score:
            for start in range(len(read)):
                piece = read[start:]
                if piece in self.score and self.stays(last[start], piece):
                    break
            more = tokens[start] + 1
        else:  # spelled out in bytes, never merged
            piece, more = "", len(char.encode())
        cut = 0
        while read[cut:] not in self.begins:
            cut += 1
        move = self._state(read[cut:], (*last[cut:], piece),
                           tuple(n if n is None else n - more for n in (*tokens[cut:], more)))
        self.moves[state][char] = move, more
        return move, more

    def walk(self, state: int, text: str) -> tuple[int, int]:
        """(state, tokens) after the characters of one segment."""
        moves, total = self.moves, 0
        for char in text:
            move = moves[state].get(char)
            state, more = move if move is not None else self.compiled(state, char)
            total += more
        return state, total


def border(left: str, right: str) -> bool:
    """Does a segment end between two characters?"""
    if left == "\n" or right == "\n":
        return True
    if left == MARK:
        return False
    return right == MARK or bool(LETTER.match(left)) != bool(LETTER.match(right))


class Counter(dict):
    """Segment -> tokens, filled by the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, segment: str) -> int:
        if len(self) >= KEPT_SEGMENTS:
            self.clear()
        found = self.transducer.walk(0, segment.replace(" ", MARK))[1]
        if len(segment) <= KEPT_LENGTH:
            self[segment] = found
        return found

    def chunk_map(self, chunk: str) -> tuple:
        """(head, tokens behind it, exit): the exit is a state and the last character; None for both in a
        chunk that is all head."""
        parts = SEGMENT.findall(chunk)
        head = parts[0].replace(" ", MARK)
        if len(parts) < 2:
            return head, None, None
        state, tokens = self.transducer.walk(0, last := parts[-1].replace(" ", MARK))
        return head, sum(map(self.__getitem__, parts[1:-1])) + tokens, (state, last[-1])

    def _entered(self, exit_: tuple[int, str], head: str) -> tuple[tuple[int, str], int]:
        """Exit and tokens of a head read from this exit."""
        state = 0 if border(exit_[1], head[0]) else exit_[0]
        state, tokens = self.transducer.walk(state, head)
        return (state, head[-1]), tokens

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two chunks in a row."""
        if a[1] is None:
            if not border(a[0][-1], b[0][0]):
                return a[0] + b[0], b[1], b[2]
            a = (a[0], 0, (0, "\n"))
        exit_, tokens = self._entered(a[2], b[0])
        return (a[0], a[1] + tokens, exit_) if b[1] is None else (a[0], a[1] + tokens + b[1], b[2])

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        if len(self.transducer.states) > KEPT_STATES:
            self.transducer.reset()
        whole = " " + text.replace(MARK, " ")
        if len(whole) <= CHUNK:
            return sum(map(self.__getitem__, SEGMENT.findall(whole)))
        maps = [self.chunk_map(whole[i:i + CHUNK]) for i in range(0, len(whole), CHUNK)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i]
                    for i in range(0, len(maps), 2)]
        head, count, _ = maps[0]
        return self.transducer.walk(0, head)[1] + (count or 0)


_COUNTERS: dict[str, Counter] = {}


def counter(model_file: str) -> Counter:
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = Counter(Transducer(model_file))
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of (doc_id, text)."""
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model_file)
        for batch in batches:
            tokens = [own.tokens(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    sized = docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"),
                        text.alias("text"))
    counted = sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
