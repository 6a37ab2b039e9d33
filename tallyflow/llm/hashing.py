"""Vectorised 64-bit naming of words and byte strings inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
# Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE = 1 << 20
LONG_NAME = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def odd(k: int, factor: int) -> np.uint64:
    """``k * factor`` as a 64-bit number."""
    return U(k * factor & 0xFFFFFFFFFFFFFFFF)


def stretch_names(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Names of stretches of bytes: eight bytes at a time are mixed into what the bytes before gave, so no
    pattern inside a stretch cancels out.  Stretches of more than LONG_NAME bytes are hashed one by one."""
    # Eight bytes from any place on, as one number.
    eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    names = mix(sizes.astype(np.uint64) * _BASE + U(1))
    pick, at = np.flatnonzero((sizes > 0) & (sizes <= LONG_NAME)), 0
    while len(pick):
        left = sizes[pick] - at
        block = eight[starts[pick] + at]
        part = left < 8
        block[part] &= (U(1) << (U(8) * left[part].astype(np.uint64))) - U(1)
        names[pick] = mix(names[pick] * _BASE ^ block)
        at += 8
        pick = pick[left > 8]
    for k in np.flatnonzero(sizes > LONG_NAME).tolist():
        names[k] = xxhash.xxh3_64_intdigest(data[starts[k]:starts[k] + sizes[k]].tobytes())
    return names


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Name of the sequence of the given columns of names."""
    out = np.full(len(parts[0]), U(len(parts)), np.uint64)
    for part in parts:
        out = mix(out * _BASE + part)
    return out


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    first = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield first, k
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


class Words:
    """Words of a few texts: ``names``, the text each is of, and ``first[k]``, the place of the
    first word of text k (with one more entry at the end)."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        is_word = ~_SPACE[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], is_word]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        self.names = stretch_names(data, starts, ends - starts)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(text_ends, starts, side="right")
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.starts, self.ends = starts, ends
        self.offset = np.concatenate([[0], text_ends])

    def spans(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words inside one text."""
        n = len(self.names) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[:n] == self.text[size - 1:])


def rolled(names: np.ndarray, size: int) -> np.ndarray:
    """Name of every run of ``size`` entries, built from runs of half its length."""
    have, power, step = names, _BASE, 1
    out, length, done = None, 0, size
    while done:
        if done & 1:
            if out is None:
                out, length = have, step
            else:
                n = len(names) - length - step + 1
                out = out[:max(n, 0)] * power + have[length:length + max(n, 0)]
                length += step
        done >>= 1
        if done:
            n = max(len(have) - step, 0)
            have = have[:n] * power + have[step:step + n]
            power = odd(int(power), int(power))
            step *= 2
    return mix(out)
