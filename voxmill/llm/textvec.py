"""Vectorised text scanning: code points, word spans and 64-bit polynomial hashes for a whole batch at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}
_tables: dict[str, np.ndarray] = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        have = _powers[kind] = np.multiply.accumulate(out, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def table_of(name: str, test) -> np.ndarray:
    """test(character) for the basic plane, kept once per process; characters beyond it count as the last entry."""
    if name not in _tables:
        out = np.zeros(1 << 16, dtype=bool)
        for i in range(1 << 16):
            out[i] = not 0xD800 <= i < 0xE000 and test(chr(i))
        out[0xFFFF] = True
        _tables[name] = out
    return _tables[name]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one uint32 array with a newline after each, and where each text starts (one more entry than texts)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    joined = "".join([t + "\n" for t in texts])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Hasher:
    """Hashes of any slices of one array of code points, from prefix sums: equal slices get equal hashes."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        values = mix(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _power("base", _BASE, n), out=self._sums[1:])
        self._back = _power("inverse", _INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._back[starts])


def is_word_point(points: np.ndarray) -> np.ndarray:
    return table_of("alnum", str.isalnum)[np.minimum(points, 0xFFFF)]


def is_space_point(points: np.ndarray) -> np.ndarray:
    return (points == 0x20) | ((points >= 9) & (points <= 13))


def word_spans(points: np.ndarray, starts: np.ndarray, inside: np.ndarray):
    """(first, end, text index) of each run of `inside` points; runs never cross texts as a newline ends each."""
    first, end = spans(inside)
    return first, end, np.searchsorted(starts, first, side="right") - 1
