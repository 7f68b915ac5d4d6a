"""Word n-gram sets of texts as 64-bit hashes, for batches of texts (numpy)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-cased word, where each text's words start)."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    real = np.ones(len(codes), bool)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # the splitter gives empty words at the ends of a text
        real = codes != empty
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return own[codes[real]], np.concatenate(([0], np.cumsum(real)))[bounds]


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the n-grams of each text; a text of fewer
    words (but not none) is one shorter n-gram."""
    words, at = word_hashes(texts)
    sets = []
    for a, b in zip(at[:-1], at[1:]):
        w = words[a:b]
        size = min(n, len(w))
        if not size:
            sets.append(np.zeros(0, np.uint64))
            continue
        total = np.full(len(w) - size + 1, size, np.uint64)
        for j in range(size):
            total += w[j:len(w) - size + 1 + j] * _ODD[j]
        sets.append(np.unique(mix(total)))
    return sets
