"""Words of whole Arrow batches of texts as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
#: Bytes of words between ASCII white space; all bytes of other characters belong to words.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of words of digits, a-z and all that is not ASCII.
ALPHANUMERIC = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: A-Z to a-z, all other bytes to themselves.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class Words:
    """``codes``: per word an index into ``values``, the distinct words (binary).

    ``first``: per text the index of its first word, with the number of all words at the end.
    """

    def __init__(self, texts: pa.Array, is_word: np.ndarray, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
        body = texts.buffers()[2] if n else None
        data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(body) else np.zeros(0, np.uint8)
        bounds = offsets - offsets[0]
        if lower:
            data = LOWER[data]
        inside = is_word[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        before[bounds] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        after[bounds] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.tobytes()), pa.py_buffer(data[inside].tobytes())]
        )
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.values = coded.dictionary
        self.first = np.searchsorted(starts, bounds)
        self.n = len(self.codes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def ends(self) -> np.ndarray:
        """Per word the end of its text, as a word index."""
        return np.repeat(self.first[1:], self.counts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, k: int, multiplier: int = MULTIPLIER) -> np.ndarray:
    """Hash of each ``k`` consecutive word hashes, by doubling; n - k + 1 of them."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    total, width, power = None, 0, hashes
    size = 1
    while True:
        if k & size:
            if total is None:
                total, width = power, size
            else:
                # The part so far, then the next ``size`` words.
                m = min(len(total), len(power) - width)
                total = total[:m] * np.uint64(pow(multiplier, size, 1 << 64)) + power[width : width + m]
                width += size
        if width == k:
            return mix(total[: n - k + 1])
        m = len(power) - size
        power = power[:m] * np.uint64(pow(multiplier, size, 1 << 64)) + power[size:]
        size *= 2


def sliding(values: np.ndarray, w: int, least: bool = True) -> np.ndarray:
    """Least (or greatest) of each ``w`` consecutive values; n - w + 1 of them."""
    pick = np.minimum if least else np.maximum
    n = len(values)
    if n < w:
        return values[:0]
    size, now = 1, values
    while size * 2 <= w:
        now = pick(now[:-size], now[size:])
        size *= 2
    return pick(now[: n - w + 1], now[w - size : w - size + n - w + 1])


def runs_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, end), range by range."""
    lengths = ends - starts
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    if not len(starts):
        return np.zeros(0, np.int64)
    out = np.ones(int(lengths.sum()), np.int64)
    out[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    out[at] = starts[1:] - (starts[:-1] + lengths[:-1]) + 1
    return np.cumsum(out)
