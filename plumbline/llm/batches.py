"""Arrow batches of texts as flat byte arrays: words, word hashes and shingles.

Everything here works on one batch inside a task. Words are told apart by 64-bit
hashes, so equal words have equal hashes everywhere and two of ``n`` distinct
words collide with probability about ``n * n / 2 ** 65``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer text is taken alone.
SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(mix(np.uint64(seed))))


_BYTE_VALUES = random_words(256, 11) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Word bytes: everything but the six ASCII white spaces.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes: ASCII digits, lower-case letters and every byte beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each text (null counts as empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def text_slices(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text."""
    _, offsets = byte_view(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


class Words:
    """Words of a batch of texts, A-Z lower-cased unless ``lower`` is off.

    ``doc`` (row of the text), ``start`` and ``end`` (bytes in ``data``) have one
    entry per word, in the order of the texts.
    """

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, lower: bool = True) -> None:
        raw, self.offsets = byte_view(texts)
        self.rows = len(self.offsets) - 1
        self.data = _LOWER[raw] if lower else raw
        inside = word_bytes[self.data]
        first = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            begins[first] = inside[first]
            ends[:-1] &= ~inside[1:]
            last = first[1:] - 1
            ends[last] = inside[last]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.rows).astype(np.int64)
        #: Position of each text's first word.
        self.first = np.cumsum(self.count) - self.count

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, independent of its place."""
        power, inverse = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_VALUES[self.data] * power[: len(self.data)], out=sums[1:], dtype=np.uint64)
            return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all runs of ``width`` words; a shorter text is one run."""
    h = words.hashes()
    keys = random_words(width, 23) | np.uint64(1)
    with np.errstate(over="ignore"):
        whole = len(h) - width + 1
        total = np.zeros(max(whole, 0), dtype=np.uint64)
        for i in range(width):
            if whole > 0:
                total += mix(h[i : i + whole] ^ keys[i]) * keys[i]
        if whole > 0:
            same = words.doc[:whole] == words.doc[width - 1 :]
            rows, values = words.doc[:whole][same], mix(total[same])
        else:
            rows, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        short = np.flatnonzero((words.count > 0) & (words.count < width))
        if len(short):
            sums = np.zeros(len(short), dtype=np.uint64)
            for i in range(width - 1):
                has = words.count[short] > i
                sums[has] += mix(h[words.first[short[has]] + i] ^ keys[i]) * keys[i]
            sums = mix(sums + words.count[short].astype(np.uint64))
            rows, values = np.concatenate([rows, short]), np.concatenate([values, sums])
            order = np.argsort(rows, kind="stable")
            rows, values = rows[order], values[order]
    return rows, values


def distinct_sets(rows: np.ndarray, values: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, one after another, and their counts."""
    ends = np.searchsorted(rows, np.arange(n_rows), side="right")
    begin, parts, sizes = 0, [], np.zeros(n_rows, np.int64)
    for i, end in enumerate(ends):
        if end > begin:
            own = np.sort(values[begin:end])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            parts.append(own)
            sizes[i] = len(own)
            begin = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes
