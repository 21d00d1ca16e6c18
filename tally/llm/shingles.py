"""Word shingles as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tally.llm.common import translated

# Words end at the blank and at U+0009 to U+000D; A-Z are lower-cased.
_WORDS = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64
_ODD = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)


def scramble(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mix; each seed gives another order of the same values."""
    with np.errstate(over="ignore"):
        h = h ^ _U(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, words of each text)."""
    split = pc.split_pattern(translated(column, _WORDS), " ")
    offsets = np.asarray(split.offsets)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    codes = np.asarray(coded.indices)
    full = np.asarray(pc.not_equal(coded.dictionary, "").cast(pa.int8())).astype(bool)[codes]
    before = np.concatenate([[0], np.cumsum(full)])
    offsets = offsets - offsets[0]
    return hashes[codes[full]], before[offsets[1:]] - before[offsets[:-1]]


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, ascending per text; set sizes).

    A text with fewer words than ``width`` has its whole sequence as its only
    shingle; one without words has none.
    """
    words, lengths = word_hashes(column)
    ends = np.cumsum(lengths)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(words), _U)
        for k in range(width):
            rolled[:max(len(words) - k, 0)] += words[k:] * _ODD[k]
        short = (lengths > 0) & (lengths < width)
        counts = np.where(short, 1, np.maximum(lengths - width + 1, 0))
        last = np.repeat(ends, lengths)  # end of each word's own text
        mine = np.arange(len(words)) + width <= last
        for t in np.flatnonzero(short):
            a, b = ends[t] - lengths[t], ends[t]
            rolled[a] = (words[a:b] * _ODD[:b - a]).sum() + _ODD[32 + b - a]
            mine[a] = True
    flat = scramble(rolled[mine])
    tops = np.cumsum(counts)
    for a, b in zip((tops - counts).tolist(), tops.tolist()):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[(tops - counts)[counts > 0]] = True  # each text's first
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[tops] - kept[tops - counts]
