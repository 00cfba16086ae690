"""Words, lines and fingerprints of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes outside space and \\x09-\\x0D. Texts lie one after another in `data`;
text i is `data[offsets[i]:offsets[i + 1]]`. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at a time; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN))


def _power_table(direction: str, size: int) -> np.ndarray:
    if _powers[direction].size < size:
        base = _BASE if direction == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(1 << (size - 1).bit_length(), base, np.uint64)
        steps[0] = 1
        _powers[direction] = np.cumprod(steps, dtype=np.uint64)
    return _powers[direction]


class Spans:
    """64-bit fingerprints of any spans of `data`, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * _power_table("up", data.size + 1)[: data.size], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _power_table("down", self.sums.size)
        length = (end - start).astype(np.uint64) * np.uint64(_GOLDEN)
        return mixed((self.sums[end] - self.sums[start]) * down[start] + length)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of an Arrow string column."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, content = column.buffers()
    if len(column) == 0 or content is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes, at least one text each."""
    first, count = 0, offsets.size - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every word."""
    inside = ~_SPACE[data]
    cut = np.zeros(data.size + 1, bool)
    cut[offsets] = True
    before = np.empty(data.size, bool)
    after = np.empty(data.size, bool)
    before[:1], after[-1:] = False, False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (cut[:-1] | ~before))
    end = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every line; a text has one line more than line feeds."""
    feeds = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], feeds + 1])
    text = np.concatenate([np.arange(offsets.size - 1), np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    end = offsets[1:][text]
    if start.size > 1:
        same = text[1:] == text[:-1]
        end[:-1][same] = start[1:][same] - 1
    return start, end, text


def running(flags: np.ndarray) -> np.ndarray:
    """Counts before every place: differences give the count in any span."""
    out = np.zeros(flags.size + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return np.zeros(keys.size, bool)
    at = np.searchsorted(twice, keys)
    at[at == twice.size] = 0
    return twice[at] == keys
