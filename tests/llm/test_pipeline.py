"""The pipeline against the plain versions of its stages, one after the other."""

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import FOLDER
from tests.llm.test_ops import unigram  # noqa: F401
from tidewater.llm import decontaminate, rules


def test_pipeline(spark, documents, unigram):  # noqa: F811
    rows = {r.doc_id: (r.text, r.lang, r.source) for r in documents.collect()}
    good = brute.kept_by_rules(
        [(d, t, lang) for d, (t, lang, _) in rows.items()], rules.COMMON_SHARE, rules.MIN_CHARS, rules.MIN_WORDS, rules.MAX_CLASS_DISTANCE,
        lambda n, shares: brute.word_limit(n, shares, rules.DEVIATIONS, rules.LEAST_LIMIT, rules.MOST_LIMIT, rules.LONG_WORDS),
    )
    left = [(d, rows[d][0]) for d in sorted(good)]
    assert 0 < len(left) < len(rows)
    left = [(d, t) for (d, t), (_, least) in zip(left, brute.components(left, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)) if least == d]
    assert len(left) < len(good)
    index = decontaminate.build_index([(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()])

    def leaks(text):
        raw = brute.collapsed(text).encode()
        grams = {raw[i : i + 8] for i in range(len(raw) - 7)}
        for passage, allowed in zip(index.passages, index.edits):
            p = passage.tobytes()
            if sum(p[i : i + 8] in grams for i in range(len(p) - 7)) >= len(p) - 7 - 8 * allowed and brute.edits(p, raw) <= allowed:
                return True
        return False

    clean = [(d, t) for d, t in left if not leaks(t)]
    assert len(clean) < len(left)
    expected = {d: brute.redacted(t, brute.personal(t)) for d, t in clean}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert {d: r.text for d, r in got.items()} == expected
    for d, r in got.items():
        assert r.ids == unigram[1].encode(r.text) and r.n_pieces == len(r.ids)
        assert (r.lang, r.source, r.n_chars) == (*rows[d][1:], len(r.text))


@pytest.mark.parametrize("frame", ["odd", "empty"])
def test_stages_on_odd_rows(spark, frame, request):
    docs = request.getfixturevalue(frame)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        assert len(rows) <= docs.count(), name


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "benchmark_decontamination", "personal_data", "sentencepiece"]
