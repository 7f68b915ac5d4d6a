from __future__ import annotations

import random

from llm_fixtures import SF_MID, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import sentences as se
from stationlake.llm.queries import QUERIES

PASSAGE = " ".join(f"Sentence number {n} of the shared passage says something plain." for n in ("one", "two", "three", "four", "five", "six"))


def windows(text, n=51):
    w = (text or "").lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def test_passages_stay_once_and_other_text_stays(ws, make_docs):
    one = " ".join(f"word{i}" for i in range(70)) + "."
    rows = [(i, f"Own words of document {i} stand here first.\n{PASSAGE} Then text {i} goes on in its own way.") for i in range(6)]
    rows += [(10, f"Start {one} end ten."), (11, f"Another begin {one} finish eleven."), (12, None), (13, ""), (None, "short."), (14, "short."),
             (15, "a " * 100_000), (16, PASSAGE), (16, PASSAGE)]
    docs = make_docs(rows, parts=1).withColumn("removed", F.lit("old")).withColumn("first", F.lit(1)).withColumn("hash", F.lit(2))
    got = se.dedup_spans(ws, docs).collect()
    assert len(got) == len(rows) and {"first", "hash"} <= set(got[0].asDict())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    whole = [r for r in got if r.text and PASSAGE in r.text]
    assert len(whole) == 1
    for i in range(6):
        text = by[i][0].text
        assert text.startswith(f"Own words of document {i}") and text.endswith(f"Then text {i} goes on in its own way.")
    assert sum(bool(windows(by[k][0].text) & windows(one)) for k in (10, 11)) == 1
    assert by[12][0].text is None and by[13][0].text == "" and by[None][0].text == by[14][0].text == "short."
    for r in got:
        old = next(t for k, t in rows if k == r.doc_id)
        kept, end = [], 0
        for a in r.removed:
            kept.append(old[end:a.start])
            end = a.end
        assert (r.text or "") == "".join([*kept, (old or "")[end:]])


def test_query_leaves_no_long_passage_twice(spark):
    """Of 51-word windows that documents shared before, next to none is left
    in two texts, and unshared ones are not cut."""
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    after = {r.doc_id: r for r in QUERIES["op4_sentence_spans"](spark, SF_MID).collect()}
    assert set(before) == set(after)

    def shared(texts):
        seen, twice = set(), set()
        for t in texts:
            w = windows(t)
            twice |= w & seen
            seen |= w
        return twice
    was, left = shared(before.values()), shared(r.text for r in after.values())
    assert was and len(left) < 0.01 * len(was)
    assert all(r.text == before[k] for k, r in after.items() if not r.n_removed)


def sentence(n, name):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


def test_last_sentences_of_a_repeated_run_go(ws, make_docs):
    """A run of 12, 9, 9 and 3 words, and short whole texts of several sentences."""
    run = " ".join(sentence(n, c) for n, c in ((12, "a"), (9, "b"), (9, "c"), (3, "d")))
    rows = [(1, f"Own one here.\n{run}\nAnd this ends it."), (2, f"Other two there.\n{run}\nSomething else follows."), (3, run), (4, run),
            (5, "All rights reserved. Do not copy."), (6, "All rights reserved. Do not copy."), (7, "All rights reserved. Ask first.")]
    got = {r.doc_id: r.text.split() for r in se.dedup_spans(ws, make_docs(rows, parts=1)).collect()}
    assert sum("a0 a1" in " ".join(got[k]) for k in (1, 2, 3, 4)) == 1
    assert sum("d0 d1 d2." in " ".join(got[k]) for k in (1, 2, 3, 4)) == 1
    assert sum(not got[k] for k in (5, 6)) == 1 and " ".join(got[7]) == rows[6][1]
    assert [" ".join(w for w in got[k] if w[0] not in "abcd" or not w.rstrip(".")[1:].isdigit()) for k in (1, 2)] == [
        "Own one here. And this ends it.", "Other two there. Something else follows."]


def test_short_runs_inside_longer_texts_go(ws, make_docs):
    """Three short sentences, far fewer words than a passage, in five documents."""
    notice = "All rights reserved. Do not copy. Ask first."
    rows = [(i, f"Document {i} begins in its own words here. {notice} Then document {i} ends in others.") for i in range(5)]
    got = {r.doc_id: r.text for r in se.dedup_spans(ws, make_docs(rows, parts=1)).collect()}
    assert sum("rights reserved" in t for t in got.values()) == 1
    assert all(got[i].startswith(f"Document {i} begins in its own words here.") and got[i].endswith(f"Then document {i} ends in others.") for i in got)


def brute(rows, k=se.SPAN_SENTENCES):
    """Sentences left of each text: those of no repeated run of k but its first."""
    seen, out = set(), []
    for text in rows:
        s = [x.strip(" .").lower() for x in text.split(".") if x.strip()]
        size = k if len(s) >= k else len(s)
        gone = set()
        if size > 1:
            for i in range(len(s) - size + 1):
                run = tuple(s[i:i + size])
                if run in seen:
                    gone |= set(range(i, i + size))
                seen.add(run)
        out.append([x for i, x in enumerate(s) if i not in gone])
    return out


def test_equals_brute_force(spark, ws):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.choice('abcd')} {rng.choice('xy')}." for _ in range(rng.randrange(12))) for _ in range(150)]
    texts += [texts[5], texts[5], "a x. b y.", "a x. b y."]
    got = {r.doc_id: r.text for r in se.dedup_spans(ws, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()}
    assert [[x.strip() for x in got[i].split(".") if x.strip()] for i in range(len(texts))] == brute(texts)


def test_empty_table(ws, make_docs):
    assert se.dedup_spans(ws, make_docs([])).collect() == []
