from __future__ import annotations

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm.tokens import WordEncoder, default_tokenizer, slices

ENC = WordEncoder(default_tokenizer(), cache_words=50)
ODD = ["İ", "é", "Σ", "ß", "ẞ", "'s", "'LL", "\x1c", " ", " ", "　", "​", "K", "ﬁ", "<|endoftext|>",
       "<|ENDOFTEXT|>", "<|", "|>", "5", "٣", "½", "中", "!", "*", ".", "̸", " ", "\n", "\t", "\x0b", "\x85", "DON'T", "I'm.", "ǅ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=20),
                          st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=8).map("".join)), max_size=5))
def test_ids_equal_those_of_the_whole_tokenizer(texts):
    texts = [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]
    ids, at = ENC.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == ENC._tokenizer.encode(t or "", add_special_tokens=False).ids


def test_words_of_other_case_or_with_a_tail_are_looked_up_once(monkeypatch):
    texts, seen = ["skipped", "The the. THE, the\tthe!\vthe", "THE.<|endoftext|> THE.", None], []
    words = ENC._words
    monkeypatch.setattr(ENC, "_words", lambda w: seen.append(w) or words(w))
    ids, at = ENC.encode(pa.array(texts[:2]).slice(1))
    assert set(seen[0]) == {b"the", b".", b",", b"the!"}  # \v is no white space of the regex
    assert ids.tolist() == ENC._tokenizer.encode(texts[1], add_special_tokens=False).ids
    ids, at = ENC.encode(pa.array(texts).slice(1))
    for k, t in enumerate(texts[1:]):
        assert ids[at[k]:at[k + 1]].tolist() == ENC._tokenizer.encode(t or "", add_special_tokens=False).ids


def test_slices_cover_all_rows_once():
    a = pa.array(["x" * n for n in (5, 100, 1, 1, 30)] + [None])
    got = list(slices(a, 32))
    assert [i for lo, hi in got for i in range(lo, hi)] == list(range(6))
    assert list(slices(a.slice(0, 0), 32)) == []
