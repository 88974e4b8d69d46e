"""Words and word shingles as arrays of 64-bit hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hashes a worker keeps.
KEPT = 150_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_seen = _Hashes()


def tidied(run: Callable) -> Callable:
    """``run`` over batches; then what it held goes back to the system, since workers outlive tasks."""

    @wraps(run)
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _seen.clear()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return inner


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on an unsigned array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_seen) > KEPT:
        _seen.clear()
    return np.fromiter(map(_seen.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words; of fewer words, one for them all."""
    if not len(hashes):
        return hashes
    n_here = min(n, len(hashes))
    out = np.full(len(hashes) - n_here + 1, n_here, np.uint64)
    for k in range(n_here):
        out = mixed(out + hashes[k : len(hashes) - n_here + 1 + k])
    return out


def shingle_set(text: object, n: int) -> np.ndarray:
    """Distinct shingles of a text's words, A-Z lower-cased, in ascending order."""
    if not isinstance(text, str):
        return np.zeros(0, np.uint64)
    return np.unique(windows(word_hashes(text.encode("utf-8", "surrogatepass").lower().split()), n))
