"""Hashed word shingles of whole texts, a batch of texts at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and where each text ends. Words are runs without white space of the
    lower-cased text; each distinct word of the batch is hashed once."""
    import xxhash
    # Trimmed first: the split kernel looks past the end of a batch whose last text ends in white space.
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(texts)))
    flat = words.flatten()
    ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    index = coded.indices.to_numpy(zero_copy_only=False)
    filled = np.array([w != "" for w in distinct], bool)[index] if len(index) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(filled)])
    return hashed[index][filled], kept[ends]


def shingle_sets(texts: pa.Array, n: int = WORDS) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles. A text of fewer words, but at least one,
    is one shingle; a text without words has none."""
    words, ends = word_hashes(texts)
    runs = np.zeros(len(words), np.uint64)
    run = np.zeros(len(words), np.uint64)
    if len(words) >= n:
        run = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            run = run * _BASE + words[k: len(words) - n + 1 + k]
        runs[: len(run)] = mix64(run)
    start = 0
    for end in ends.tolist():
        count = end - start
        if count >= n:
            yield np.unique(runs[start: end - n + 1])
        elif count:
            value = np.uint64(count)
            for w in words[start:end]:
                value = np.uint64((int(value) * int(_BASE) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            yield mix64(np.array([value], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        start = end


def set_digest(shingles: np.ndarray) -> str:
    """128-bit name of a shingle set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive (offset, rows) of at most ``most`` bytes of text, or one row."""
    start, held = 0, 0
    lengths = pc.binary_length(texts).to_pylist()
    for k, n in enumerate(lengths):
        if held and held + n > most:
            yield start, k - start
            start, held = k, 0
        held += n
    if lengths:
        yield start, len(lengths) - start
