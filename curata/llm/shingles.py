"""Words, word shingles and minwise hashes of whole batches of texts, as numpy arrays.

A word is a longest run of letters and digits (Unicode), compared in lower case.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
#: Words whose hashes a Python worker keeps; the store is emptied when it is full.
CACHE_WORDS = 1_000_000

_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


class _Hash(dict):
    """Word as written -> 64-bit hash of its lower case."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.lower())
        return value


_hash = _Hash()


def scramble(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    a = a ^ (a >> np.uint64(30))
    a = a * np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(27)
    a *= np.uint64(0x94D049BB133111EB)
    a ^= a >> np.uint64(31)
    return a


def joined(prompts, responses) -> list[str]:
    """Prompt followed by response; null counts as the empty text."""
    return [f"{p or ''} {r or ''}" for p, r in zip(prompts, responses)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, one after the other, and the number of words of each text."""
    counts = np.empty(len(texts), np.int64)
    flat: list[int] = []
    get = _hash.__getitem__
    for k, text in enumerate(texts):
        found = WORD.findall(text)
        counts[k] = len(found)
        flat.extend(map(get, found))
    return np.array(flat, np.uint64), counts


def sequence_hash(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers of each text's word sequence, as int64 of shape (texts, 2)."""
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    place = (np.arange(len(words)) - np.repeat(starts, counts)).astype(np.uint64)
    out = np.empty((len(counts), 2), np.int64)
    for lane in range(2):
        mixed = scramble(words + (place + np.uint64(1)) * _MIX[lane])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        out[:, lane] = scramble(total[starts + counts] - total[starts] + counts.astype(np.uint64)).view(np.int64)
    return out


def shingles(words: np.ndarray, counts: np.ndarray, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text in their order, and their number for each text."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    value = np.zeros(n, np.uint64)
    for k in range(width):
        value += words[k : k + n] * _MIX[k % len(_MIX)] + np.uint64(k)
    return scramble(value[owner[:n] == owner[width - 1 :]]), np.maximum(0, counts - width + 1)


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted within the text, and their number for each text. Sorts `values` in place."""
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist()):  # many short sorts are several times faster than one long one
        values[start:end].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[(ends - counts)[counts > 0]] = True
    owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    return values[first], np.bincount(owner[first], minlength=len(counts)).astype(np.int64)


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within the text, and their number for each text."""
    return distinct(*shingles(words, counts, width))


_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(1, 1 << 32, 512, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, 512, dtype=np.uint32)


def minwise(values: np.ndarray, sizes: np.ndarray, functions: int) -> np.ndarray:
    """Minima of so many hash functions over each text's shingles: uint32 of shape (texts, functions); 0 for a text without any."""
    out = np.zeros((len(sizes), functions), np.uint32)
    full = sizes > 0
    if full.any():
        starts = (np.concatenate([[0], np.cumsum(sizes)])[:-1])[full]
        low = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
        for k in range(functions):
            mixed = low * _MULT[k] + _ADD[k]
            mixed ^= mixed >> np.uint32(15)
            out[full, k] = np.minimum.reduceat(mixed, starts)
    return out


def low_bits(minima: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, their number a multiple of 64, as int64 of shape (texts, minima / 32). At similarity j, a bit differs with probability (1 - j) / 2."""
    spread = minima * np.uint32(0x9E3779B1)
    weights = np.arange(64, dtype=np.uint64)
    lanes = []
    for start in range(0, minima.shape[1], 64):
        for bit in (31, 30):
            lanes.append((((spread[:, start : start + 64] >> np.uint32(bit)) & np.uint32(1)).astype(np.uint64) << weights).sum(axis=1, dtype=np.uint64).view(np.int64))
    return np.stack(lanes, axis=1)
