"""Collocations against counting every n-gram."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewater.llm import phrases


def expected(rows, threshold, longest, top):
    """{(lang, rank, phrase, a, l, r, n, score)} of (lang, text) rows."""
    f, size = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            size[lang] += len(w)
            f.update((lang, *w[i : i + k]) for i in range(len(w)) for k in range(1, longest + 1) if i + k <= len(w))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= threshold}
    inside = set()
    for (lang, *w), a in candidates.items():
        inside |= {(lang, *w[i:j]) for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and f[(lang, *w[i:j])] <= a}
    out = {}
    for (lang, *w), a in candidates.items():
        if (lang, *w) not in inside:
            cuts = [(1000 * a * size[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return {(lang, i + 1, p.decode(), -a, x, y, size[lang], -s) for lang, held in out.items() for i, (s, a, p, x, y) in enumerate(sorted(held)[:top])}


@pytest.mark.parametrize("frame,threshold,longest,top", [("documents", 5, 5, 2000), ("documents", 20, 5, 7), ("documents", 4, 2, 2000), ("odd", 2, 5, 50)])
def test_collocations(request, frame, threshold, longest, top):
    docs = request.getfixturevalue(frame)
    got = [tuple(r) for r in phrases.collocations(docs, threshold, longest, top).collect()]
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows, threshold, longest, top) and got


def test_blocks_within_texts(spark, documents, monkeypatch):
    """One text of several blocks: phrases do not cross pieces, so blocks end between them."""
    text = "the cat sat on the mat. a dog, a dog; a dog\nThe Cat sat! " * 700
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    docs = spark.createDataFrame([("en", text), ("en", "x y"), (None, text)], "lang string, text string")
    assert set(map(tuple, phrases.collocations(docs, 100).collect())) == expected([("en", text), ("en", "x y"), (None, text)], 100, 5, 2000)


def test_words_of_blocks():
    words, codes = phrases.coded_words(pa.array(["A b,c\td", None, "", "é B\x0bb ?", "...", "b"]))
    names = words.to_pylist()
    assert [names[c] if c >= 0 else "|" for c in codes] == ["a", "b", "|", "c", "d", "|", "é", "b", "|", "b", "|", "b"]


@pytest.mark.parametrize("seed", range(6))
def test_summaries_lose_no_frequent_key(seed):
    """However the shares are merged: counts are too low by at most mass / (capacity + 1)."""
    draw = random.Random(seed)
    shares = [Counter(int(draw.paretovariate(0.6)) % 5000 for _ in range(draw.randrange(400))) for _ in range(60)]
    true = sum(shares, Counter())
    mass, threshold = sum(true.values()), draw.choice([20, 50, 200])
    summary = phrases.Summary(mass // threshold + 1)
    for share in shares:
        keys = np.array(sorted(share), np.uint64)
        summary.add(keys, np.array([share[int(k)] for k in keys], np.uint32))
        if draw.random() < 0.5:
            summary.merge()
    left = summary.frequent(threshold).tolist()
    assert len(left) <= summary.capacity and summary.lost * (summary.capacity + 1) <= mass
    assert {k for k, c in true.items() if c >= threshold} <= set(left)
    assert phrases.Summary(1).frequent(1).tolist() == []


def test_products_beyond_64_bits(spark):
    big = [(10**9 + 7, 10**13 + 1, 2 * 10**9, 3 * 10**9 + 1), (10**12, 10**13, 10**12, 10**12), (100, 10**15, 101, 103), (1, 1, 3000, 1)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(phrases.score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in big]


def test_nothing(spark, empty):
    assert phrases.collocations(empty).count() == 0
    blank = spark.createDataFrame([("en", None), ("de", ""), (None, " .,\n")], "lang string, text string")
    assert phrases.collocations(blank, 1).count() == 0
