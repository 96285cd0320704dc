"""Words of many texts at once, as arrays over their joined UTF-8 bytes.

Texts are handled in groups of bounded size, so that what numpy holds doesn't
follow the number of rows; a text that alone is larger is a group of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text in a group.
GROUP = 2_000_000

_rng = np.random.default_rng(20240607)
#: A random odd value for each byte value, and the base whose powers tell places apart.
_OF_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def lower_table() -> np.ndarray:
    """Bytes with A-Z in lower case."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def white_space() -> np.ndarray:
    """Which bytes part words: space and 09 to 0D."""
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def not_alphanumeric() -> np.ndarray:
    """Which bytes part words when these are digits, a-z and all above ASCII."""
    t = np.ones(256, dtype=bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = False
    return t


LOWER, SPACE, SIGNS = lower_table(), white_space(), not_alphanumeric()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first n powers of the base."""
    if n > len(powers.held):
        out = np.full(max(n, 64), _BASE, dtype=np.uint64)
        out[0] = 1
        powers.held = np.cumprod(out)
    return powers.held[:n]


powers.held = np.ones(0, dtype=np.uint64)


class Words:
    """Of a group of texts: byte start and end of each word, its hash, and the words of each text."""

    def __init__(self, texts: list[bytes], parts: np.ndarray) -> None:
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes + 1)])  # a space after each text
        self.bytes = LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
        edge = np.diff((~parts[self.bytes]).view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.starts, self.offsets)  # words of text i: first[i] to first[i + 1]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = self.ends - self.starts
        if not len(n):
            return np.zeros(0, dtype=np.uint64)
        inside = np.repeat(self.starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        place = inside - np.repeat(self.starts, n)
        of = _OF_BYTE[self.bytes[inside]] * powers(int(n.max()))[place]
        return mix(np.add.reduceat(of, np.concatenate([[0], np.cumsum(n)[:-1]])) + n.astype(np.uint64))

    def of_text(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.sizes)), np.diff(self.first))


def shingles(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct k-word shingles of each text, sorted; fewer words make one shingle of them all."""
    text = words.of_text()
    if len(hashes) >= k:
        n = len(hashes) - k + 1
        whole = text[:n] == text[k - 1 :]
        h = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(3) + hashes[i : i + n] + np.uint64(i + 1))
        t, h = text[:n][whole], h[whole]
    else:
        t, h = text[:0], hashes[:0]
    few = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < k))
    if len(few):
        of = np.zeros(len(few), dtype=np.uint64)
        for i in range(k - 1):
            has = words.first[few] + i < words.first[few + 1]
            of[has] = mix(of[has] * np.uint64(5) + hashes[(words.first[few] + i)[has]] + np.uint64(101 + i))
        t, h = np.concatenate([t, few]), np.concatenate([h, of])
    order = np.lexsort((h, t))
    t, h = t[order], h[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[new], h[new]


def text_groups(batches: Iterator[pa.RecordBatch], column: int, most: int = GROUP, read: Callable[[pa.Scalar], bytes] | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes (null: empty), each of about `most` bytes; read makes bytes of a value."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        at, held, size = 0, [], 0
        for i in range(batch.num_rows):
            x = (read(texts[i]) if read else texts[i].as_py()) or b""
            if held and size + len(x) > most:
                yield batch.slice(at, i - at), held
                at, held, size = i, [], 0
            held.append(x)
            size += len(x)
        if held:
            yield batch.slice(at, batch.num_rows - at), held
