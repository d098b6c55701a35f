"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

An Arrow string column is cut into chunks of whole documents of about ``CHUNK`` bytes, so
that the working arrays stay a few dozen MB whatever the batch size; only one document that
is longer than a chunk makes a larger one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: a-z, 0-9 and every byte of a code point beyond ASCII (after lower-casing).
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: everything but space, tab, line feed, vertical tab, form feed, carriage return.
NONSPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK + 1), base, np.uint64)
        out[0] = 1
        have = _POWERS[int(base)] = np.cumprod(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive documents. ``bounds[i]:bounds[i+1]`` are those of document i."""
    data: np.ndarray      # lower-cased bytes
    starts: np.ndarray    # byte offsets
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray    # uint64
    sums: np.ndarray      # running polynomial sum of the bytes

    def prefix_hashes(self, which: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the first ``length`` bytes of the words ``which``."""
        s = self.starts[which]
        return mix((self.sums[s + length] - self.sums[s]) * _powers(_P_INV, len(self.sums))[s])

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def doc_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, document offsets into them); null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return
    _, off, dat = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(dat, np.uint8) if dat is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ALNUM) -> Words:
    """Split lower-cased text into maximal runs of ``kind`` bytes and hash each run."""
    low = LOWER[data]
    inside = kind[low]
    n = len(low)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    prev = np.empty(n, bool)
    prev[:1] = False
    prev[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~prev | first[:n]))
    nxt = np.empty(n, bool)
    nxt[-1:] = False
    nxt[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~nxt | first[1:])) + 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_P, n), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers(_P_INV, n + 1)[starts]
    return Words(low, starts, ends, np.searchsorted(starts, offsets), mix(h), prefix)


def grams(hashes: np.ndarray, offsets: tuple[int, ...] | int, salt: int = 0) -> np.ndarray:
    """Hash of the words at i + each offset, for every i (an int k means k consecutive)."""
    offs = tuple(range(offsets)) if isinstance(offsets, int) else offsets
    n = len(hashes) - offs[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(salt * 2 + 1), np.uint64)
    for o in offs:
        out = out * _P + hashes[o:o + n]
    return mix(out)
