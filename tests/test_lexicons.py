"""Learned word lists against a brute-force version, and their edge cases."""

import math
import re
from collections import Counter
from decimal import Decimal

import pytest

from strata.operators import lexicons as L

WORDS = "alpha beta gamma delta good nice vile nasty".split()


def _corpus():
    rows, marks = [], []
    for i in range(120):
        bad = i % 4 == 0
        text = " ".join(WORDS[(i * k + k) % 4] for k in range(1, 5))
        text += (" VILE, vile nasty" if bad else " good") if i % 3 else ""
        rows.append((i, text))
        if i % 5:
            marks.append((i, int(bad)))
    return rows + [(900, None), (901, ""), (None, "vile good good")], marks + [(900, 1), (901, 0), (5, None), (7777, 1)]


def _tokens(text):
    return [t for t in re.split(r"[^a-z]+", (text or "").lower()) if t]


def _brute_polarity(rows, marks, min_docs=5, z=3.0, shrink=5):
    y = {i: m for i, m in marks if m is not None}
    known = [(y[i], set(_tokens(t))) for i, t in rows if i in y]
    n, k1 = len(known), sum(m for m, _ in known)
    seen, neg = Counter(), Counter()
    for m, ts in known:
        for t in ts:
            seen[t] += 1
            neg[t] += m
    out = {}
    for t, c in seen.items():
        b, g, r = neg[t], c - neg[t], k1 / n
        good, bad = g * k1, b * (n - k1)
        if c >= min_docs and (b - c * r) ** 2 >= z * z * c * r * (1 - r):
            v = math.floor(10000 * abs(good - bad) * c / ((good + bad) * (c + shrink)))
            out[t] = (g, b, Decimal(v if good >= bad else -v) / 10000)
    return out


@pytest.fixture(scope="module")
def frames(spark):
    rows, marks = _corpus()
    # clashing column names must not matter
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, term string, _id int")
    return docs, spark.createDataFrame([(i, m, "y") for i, m in marks], "doc_id long, toxic int, _y string")


def test_polarity_equals_brute_force(frames):
    docs, marks = frames
    got = {r.term: (r.docs_positive, r.docs_negative, r.polarity) for r in L.polarity_words(docs, marks, "toxic", z=3.0).collect()}
    want = _brute_polarity(*_corpus())
    assert got == want
    assert got["vile"][2] < 0 < got["good"][2] and "alpha" not in got


def test_scores_count_every_occurrence(frames):
    docs, marks = frames
    lexicon = L.kept(L.polarity_words(docs, marks, "toxic", z=3.0))
    p = {t: v[2] for t, v in _brute_polarity(*_corpus()).items()}
    got = L.sentiment_by_words(docs, lexicon).collect()
    assert len(got) == len(_corpus()[0])
    text = dict(_corpus()[0])
    for r in got:
        hits = [p[t] for t in _tokens(text[r.doc_id]) if t in p]
        assert float(r.sentiment_score) == pytest.approx(float(sum(hits) / len(hits)) if hits else 0.0, abs=1e-6)


def test_labels_by_words(frames, spark):
    docs, marks = frames
    named = marks.selectExpr("doc_id", "CASE toxic WHEN 1 THEN 'abusive' WHEN 0 THEN 'civil' END AS label")
    words = L.kept(L.label_words(docs, named, ("civil", "abusive"), "label", z=3.0))
    told = {(r.term, r.label) for r in words.collect()}
    assert ("vile", "abusive") in told and ("nasty", "abusive") in told and ("alpha", "civil") not in told
    got = {r.doc_id: (r.label, r.score) for r in L.classify_by_words(docs, words, ("civil", "abusive")).collect()}
    text = dict(_corpus()[0])
    for i, (label, score) in got.items():
        c = Counter(lab for t in _tokens(text[i]) for w, lab in told if w == t)
        best = max(("civil", "abusive"), key=lambda lab: (c[lab], lab == "civil"))
        assert (label, score) == (best, c[best])
    assert got[900] == got[901] == ("civil", 0)


def test_without_marks_or_texts(spark, frames):
    docs, marks = frames
    none = L.kept(L.polarity_words(docs, marks.limit(0), "toxic"))
    assert none.count() == 0
    assert {r.sentiment_score for r in L.sentiment_by_words(docs, none).collect()} == {Decimal("0.000000")}
    assert L.polarity_words(docs, marks.filter("toxic = 1"), "toxic").count() == 0  # one mark tells nothing apart
    assert L.sentiment_by_words(docs.limit(0), none).count() == 0
