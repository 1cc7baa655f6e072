"""Sets of hashed word shingles and their MinHash signatures, a batch of texts at a time.

Words are cut and hashed straight in the UTF-8 bytes of a whole batch: the
hash of a word is a difference of one running polynomial sum. A set is a
sorted array of 52-bit hashes, so that sets of many texts can be sorted and
made distinct at once, with the text's number in the upper bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HASH_BITS = 52
#: Texts and bytes that are worked on at a time; a longer text is a batch of its own.
MAX_TEXTS = 1 << (64 - HASH_BITS)
MAX_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        step, done = step * step % (1 << 64), done + more
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


def batches(texts: list[str]) -> Iterator[list[int]]:
    part, size = [], 0
    for i, t in enumerate(texts):
        if part and (size + len(t) > MAX_BYTES or len(part) == MAX_TEXTS):
            yield part
            part, size = [], 0
        part.append(i)
        size += len(t)
    if part:
        yield part


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word, A-Z lower-cased, and the number of its text."""
    parts = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts])
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    gap = _GAP[data]
    edge = np.diff(gap.astype(np.int8), prepend=1)
    start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    # Shifted back to the word's own start; the inverse exists as the base is odd.
    hashed = (sums[end] - sums[start]) * _powers(_INVERSE, len(data))[start]
    return _mixed(hashed + (end - start).astype(np.uint64)), np.searchsorted(ends, start, side="right")


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each, and where each text's begin (one more at the end).

    A text of fewer words has all of them as its one shingle; a text without words has none.
    """
    hashed, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    whole = max(0, len(hashed) - words + 1)
    combined = np.zeros(whole, np.uint64)
    for i in range(words):
        combined += hashed[i : i + whole] * _PLACE[i]
    inside = owner[:whole] == owner[words - 1 :]
    shingles, of = [combined[inside]], [owner[:whole][inside]]
    for length in range(1, words):
        short = np.nonzero(n == length)[0]
        total = np.full(len(short), length, np.uint64)
        for i in range(length):
            total += hashed[first[short] + i] * _PLACE[i]
        shingles.append(total)
        of.append(short)
    keys = _mixed(np.concatenate(shingles)) >> np.uint64(64 - HASH_BITS)
    keys = np.unique(keys | np.concatenate(of).astype(np.uint64) << np.uint64(HASH_BITS))
    begins = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(HASH_BITS)) if len(texts) < MAX_TEXTS else np.append(np.searchsorted(keys, np.arange(len(texts), dtype=np.uint64) << np.uint64(HASH_BITS)), len(keys))
    return keys & np.uint64((1 << HASH_BITS) - 1), begins


def signatures(shingles: np.ndarray, begins: np.ndarray, hashes: int, seed: int = 1) -> np.ndarray:
    """MinHash signatures, one row per set; the row of an empty set is all ones."""
    rng = np.random.Generator(np.random.PCG64(seed))
    factors = rng.integers(1, 1 << 63, hashes, dtype=np.uint64) | np.uint64(1)
    shifts = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
    out = np.full((len(begins) - 1, hashes), 0xFFFFFFFF, np.uint32)
    held = np.nonzero(np.diff(begins))[0]
    if len(held):
        starts, buffer = begins[held], np.empty_like(shingles)
        for k in range(hashes):
            np.multiply(shingles, factors[k], out=buffer)
            buffer += shifts[k]
            out[held, k] = np.minimum.reduceat(buffer, starts) >> np.uint64(32)
    return out
