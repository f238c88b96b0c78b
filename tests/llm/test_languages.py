"""Hyperdimensional language profiles against plain sums over trigrams."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import FOLDER
from tidewater.llm import languages
from tidewater.llm import queries as llm

_vectors = {}


def vector(letter):
    if letter not in _vectors:
        _vectors[letter] = 1 - 2 * languages.letter_vectors(np.array([0 if letter == " " else ord(letter)], np.uint64))[0].astype(np.int64)
    return _vectors[letter]


def bundled(text):
    total = np.zeros(languages.DIMENSIONS, np.int64)
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "").split()
    line = f" {' '.join(words)} " if words else ""
    for g, n in Counter(zip(line, line[1:], line[2:])).items():
        total += n * np.roll(vector(g[0]), 2) * np.roll(vector(g[1]), 1) * vector(g[2])
    return total


def expected(rows, learned):
    """(doc_id, language, score) of (doc_id, text, lang) rows; ``learned`` says which rows to learn from."""
    profiles = defaultdict(lambda: np.zeros(languages.DIMENSIONS, np.int64))
    for d, text, lang in rows:
        if learned(d) and lang is not None:
            profiles[lang] += bundled(text)
    names = sorted(n for n, v in profiles.items() if v.any())
    out = Counter()
    for d, text, _ in rows:
        v = bundled(text)
        best = ("und", 0.0)
        if names and any(c.isalpha() for c in text or ""):
            cosines = [round(float(v @ profiles[n] / np.linalg.norm(v) / np.linalg.norm(profiles[n])), 6) for n in names]
            k = int(np.argmax(cosines))
            best = (names[k], max(cosines[k], 0.0))
        out[d, *best] += 1
    return out


def learned(d):
    return d is None or zlib.crc32(str(d).encode()) % 4 != 2


@pytest.mark.parametrize("frame", ["documents", "odd"])
def test_languages(spark, request, frame):
    docs = request.getfixturevalue(frame)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    got = languages.predict(docs, languages.learn(docs.where(~held))).collect()
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 6)) for r in got) == expected(rows, learned)


def test_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = llm.QUERIES["op12_language_id"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(r.held_out != learned(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(held) > 200 and sum(held) >= 0.98 * len(held)


def test_language_is_no_input_of_a_prediction(spark, documents):
    profiles = languages.learn(documents)
    got = languages.predict(documents, profiles).collect()
    other = languages.predict(documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), profiles).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, other))


def test_profiles_in_blocks(spark, documents, monkeypatch):
    profiles = languages.learn(documents)
    whole = Counter(map(tuple, languages.predict(documents, profiles).collect()))
    monkeypatch.setattr(languages, "HELD_LANGUAGES", 1)
    assert Counter(map(tuple, languages.predict(documents, profiles).collect())) == whole


def test_nothing_learned(odd, empty):
    none = languages.learn(empty)
    assert none.count() == 0
    assert {(r.lang_pred, r.score) for r in languages.predict(odd, none).collect()} == {("und", 0.0)}
    assert languages.predict(empty, languages.learn(odd)).count() == 0


def test_texts_without_letters(spark):
    docs = spark.createDataFrame([(1, "abc", "a"), (2, "12 34 !", "b"), (3, "", "b"), (4, None, "c"), (5, "x", None), (6, "ABC", "d")], "doc_id int, text string, lang string")
    profiles = languages.learn(docs)
    assert {r.lang for r in profiles.collect()} == {"a", "d"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in languages.predict(docs, profiles).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0) and got[1] == got[6] == ("a", 1.0) and got[5][0] in ("a", "d")
