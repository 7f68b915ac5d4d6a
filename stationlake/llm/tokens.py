"""Token ids of whole texts, by the ``tokenizers`` library, each word once.

The vocabulary's pre-tokenizer never lets a token cross white space, and
its normaliser (NFC, white space, lower case) does not look across white
space either.  So the ids of a text are the ids of its words one after
another: a batch of texts is split and dictionary-encoded by Arrow, the
tokenizer sees only words that this worker has not met, and the ids are put
together by numpy.  Special-token strings in a text become their ids, as
``Tokenizer.encode`` does by default.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers; beyond this the cache starts anew (about 50 MB).
CACHE_WORDS = 250_000
#: Texts are encoded in slices of about so many bytes (one text is never split).
SLICE_BYTES = 4_000_000

# ASCII punctuation that the vocabulary's pre-tokenizer splits
# from a letter or digit before it (the apostrophe starts contractions and
# is left out), and what special-token strings start with.
_TAIL = b".,!?*#&$%;:"
_SPECIAL = b"<|"
_TAIL_AFTER_WORD = rf"([A-Za-z0-9])([{_TAIL.decode()}]+)(\s|$)"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE spells printable Latin-1 bytes as themselves and the
    other bytes, in order, as the characters from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._alphabet = _byte_alphabet()
        self._cache: dict[bytes, bytes] = {b"": b""}
        self._limit = cache_words

    def _encode_units(self, units: list[bytes]) -> None:
        """A unit of lower-case letters in NFC is one pre-token: the BPE model
        takes it directly.  Others go through the whole tokenizer."""
        rest, texts = [], []
        for u in units:
            s = u.decode("utf-8", "replace")
            if s.isalpha() and s == s.lower() and (s.isascii() or unicodedata.is_normalized("NFC", s)):
                spelled = s if s.isascii() else u.decode("latin-1").translate(self._alphabet)
                self._cache[u] = array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()
            else:
                rest.append(u)
                texts.append(s)
        for u, e in zip(rest, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self._cache[u] = array("I", e.ids).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Put ``words`` into the cache.

        A word that ends in ASCII punctuation after an ASCII letter or digit
        is looked up as these two parts; upper-case ASCII is folded first,
        which the normaliser does anyway (not where a special-token string
        may stand).
        """
        cache, split = self._cache, []
        new: set[bytes] = set()
        for w in words:
            core, tail = w, b""
            if _SPECIAL not in w:
                stem = w.rstrip(_TAIL)
                if stem and stem[-1:].isalnum():
                    core, tail = stem.lower(), w[len(stem):]
                else:
                    core = w.lower()
            split.append((w, core, tail))
            if core not in cache:
                new.add(core)
            if tail not in cache:
                new.add(tail)
        self._encode_units(list(new))
        for w, core, tail in split:
            cache[w] = cache[core] + cache[tail]

    def _words(self, words: list[bytes]) -> list[bytes]:
        if len(self._cache) > self._limit:
            self._cache.clear()
            self._cache[b""] = b""
        self._learn([w for w in words if w not in self._cache])
        return list(map(self._cache.__getitem__, words))

    @staticmethod
    def _folded(texts: pa.Array) -> pa.Array:
        """What ``_learn`` does to single words, done to whole texts: fewer
        different words are left.  The regex comes first, as its result is a
        new array: Arrow's ascii_lower misplaces texts where the first offset
        is not 0."""
        folded = pc.ascii_lower(pc.replace_substring_regex(texts, _TAIL_AFTER_WORD, r"\1 \2\3"))
        special = pc.match_substring(texts, _SPECIAL.decode())
        return pc.if_else(special, texts, folded) if pc.any(special).as_py() else folded

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids start; one longer than
        ``texts``).  A null text has no ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(self._folded(texts))
        coded = lists.flatten().dictionary_encode()
        # Not to_pylist, which makes an Arrow scalar of each word.
        per_word = self._words(coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        found = pa.array(per_word, pa.large_binary()).take(coded.indices)
        _, ends, ids = found.buffers()
        ends = np.frombuffer(ends, np.int64, len(found) + 1) >> 2 if len(found) else np.zeros(1, np.int64)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return np.frombuffer(ids or b"", "<u4", ends[-1]), ends[bounds]


def slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``slice_bytes`` of text; a longer text is alone."""
    size = np.concatenate(([0], np.cumsum(
        pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(size, size[at] + slice_bytes, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield at, end
        at = end


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    return WordEncoder(path)
