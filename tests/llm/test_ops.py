"""Each operator against its plain version, on the documents and on odd rows; empty tables give no rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import FOLDER
from tidewater.llm import decontaminate, jaccard, licences, lm, pieces, pii, rules, suffixes, token_counts, token_files
from tidewater.llm import queries as llm



def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def bag(rows):
    return Counter(tuple(r) for r in rows)


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


@pytest.fixture(params=["documents", "odd"])
def docs(request):
    return request.getfixturevalue(request.param)


# 1


def test_scores(docs):
    rows = pairs(docs)
    expected, total = brute.base_scores(rows)
    got = lm.lm_scores(docs, held_out()).collect()
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == bag(
        (d, h, n, k, total, round(b, 6)) for (d, _), (h, n, k, b) in zip(rows, expected)
    )


def test_scores_beat_the_base_on_held_out_texts(documents):
    sums = lm.lm_scores(documents, held_out()).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > sums[0]


def test_automaton_is_a_distribution():
    """From every state the weights of all words and of the unknown one add up to one."""
    sentence = "a b a b c a b a c b b a a b c".split()
    counts = Counter()
    for n in (1, 2, 3):
        counts.update(tuple(sentence[i : i + n]) for i in range(len(sentence) - n + 1))
    counts = {g: c for g, c in counts.items() if len(g) == 1 or c > 1}
    # a context counts where something follows it
    counts[("c",)] += 0
    model = brute.build_automaton(counts, len(sentence), lm.DISCOUNT)
    names = list(model.words)
    single = {w: (counts[(w,)] - lm.DISCOUNT) / len(sentence) for w in names}
    unknown = 1 - sum(single.values())
    for history in ([], ["a"], ["b"], ["a", "b"], ["b", "a"], ["a", "b", "c"]):
        start = brute.read(model, [model.words[w] for w in history], [np.log10(single[w]) for w in history])[0]
        total = 0.0
        for w, p in [*single.items(), (None, unknown)]:
            ids = [model.words[x] for x in history] + [-1 if w is None else model.words[w]]
            whole = brute.read(model, ids, [np.log10(single[x]) for x in history] + [np.log10(p)])[0]
            total += 10 ** (whole - start)
        assert abs(total - 1) < 1e-9, history


def test_scores_are_those_of_the_whole_automaton(docs):
    """Every n-gram found twice in training is an arc, however small its share."""
    rows = pairs(docs)
    base, total = brute.base_scores(rows)
    tokens = [[*brute.words(brute.lower(t)), lm.END] for _, t in rows]
    counts = Counter(tuple(x[i : i + n]) for x, (held, *_) in zip(tokens, base) if not held for n in (1, 2, 3) for i in range(len(x) - n + 1))
    kept = {g: c for g, c in counts.items() if len(g) == 1 or c >= 2}
    assert sum(len(g) > 1 and c < 1e-4 * total for g, c in kept.items()) > 20
    model = brute.build_automaton(kept, total, lm.DISCOUNT)
    n_words = sum(len(g) == 1 for g in kept)
    expected = []
    for (d, _), x in zip(rows, tokens):
        root = [np.log10((kept[(w,)] - lm.DISCOUNT if (w,) in kept else lm.DISCOUNT * n_words) / total) for w in x]
        weight, at_root, _ = brute.read(model, [model.words.get(w, -1) for w in x], root)
        expected.append((d, round(weight, 5), at_root))
    got = lm.lm_scores(docs, held_out()).collect()
    key = lambda r: (str(r[0]), r[1])
    for (d, x, n), (e, y, m) in zip(sorted(((r.doc_id, r.score, r.n_at_root) for r in got), key=key), sorted(expected, key=key)):
        assert d == e and abs(x - y) < 1e-4 and n == m
    assert any(r.n_at_root < r.n_tokens for r in got)


def test_keys_travel_as_gaps():
    """op1: what blocks send to ranges takes less than the 12 bytes of a key and its count."""
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**64, 200_000, np.uint64))
    counts = rng.geometric(0.7, len(keys))
    rows = lm._share(3, keys, counts, 20)
    assert sum(rows.column(c).nbytes for c in ("keys", "counts")) < 7 * len(keys)
    totals, lead = lm._in_order(pa.concat_tables([lm._totals(rows.slice(i, 1)) for i in range(rows.num_rows)]))
    assert np.array_equal(totals, np.where(counts < lm.MIN_COUNT, 0, counts)) and np.array_equal(lead, counts >= lm.MIN_COUNT)
    for odd in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)):
        assert np.array_equal(lm._whole_keys(pa.py_buffer(lm._small_keys(odd))), odd)


def test_scores_without_training(empty, odd):
    assert lm.lm_scores(empty, F.lit(False)).count() == 0
    got = lm.lm_scores(odd, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and {r.base_score for r in got} == {0.0}


# 2


def test_rules(docs):
    expected = bag((d, *brute.counts(t)) for d, t in pairs(docs))
    got = rules.quality_scores(docs).collect()
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_know_junk_and_leave_clean_texts(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = rules.quality_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    by = {r.quality: (r.kept, r.n) for r in scored.where("n_words >= 50").groupBy("quality").agg(F.count_if("kept").alias("kept"), F.count("*").alias("n")).collect()}
    assert by[1][0] >= 0.99 * by[1][1] and by[0][0] <= 0.02 * by[0][1]


def test_word_limits():
    shares = np.array([0.06, 0.03, *[0.004] * 30, 0.79])
    limits = rules.word_limits(tuple(shares.tolist()))
    for n in (50, 77, 130, 260, 399, 400):
        plain = brute.word_limit(n, shares.tolist(), rules.DEVIATIONS, rules.LEAST_LIMIT, rules.MOST_LIMIT, rules.LONG_WORDS)
        assert abs(limits[min(n, rules.LONG_WORDS)] - plain) < 2e-3
    assert (np.diff(limits[50:]) <= 1e-9).all()


def test_clean_texts_of_each_length_stay(spark):
    """At least 99 of 100, short ones too; and texts of the same lengths with no word of the language go."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = rules.quality_scores(spark.read.parquet(f"{folder}/documents.parquet")).join(labels.where("quality = 1"), "doc_id").collect()
    for low, high in ((50, 75), (75, 100), (100, 200), (200, 400), (400, 10**9)):
        kept = [r.kept for r in scored if low <= r.n_words < high]
        assert len(kept) > 100 and sum(kept) >= 0.99 * len(kept), (low, sum(kept), len(kept))


def test_case_counts_in_repeated_words(spark):
    text = "One two three four. one two three four. One two three! " + "word " * 3
    row = rules.quality_scores(spark.createDataFrame([(1, text, "en")], "doc_id int, text string, lang string")).first()
    assert row.n_repeat_words == brute.counts(text)[4] == 6


def test_copies_in_a_rare_language_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(rules, "GROUP_ROWS", 5)
    monkeypatch.setattr(rules, "LANGUAGE_SHARE", 2.0)
    rows = [(i, "same text in a rare tongue " * 20, "xx") for i in range(40)] + [(100, "another", "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = rules.references(df)
    dealt = rules.dealt_rows(df, refs, "text", "lang", F.lit(True))
    held = {r["__lang"]: [] for r in dealt.collect()}
    for r in dealt.groupBy("__lang", "__salt").count().collect():
        held[r["__lang"]].append(r["count"])
    assert len(held["xx"]) > 4 and max(held["xx"]) < 20 and held["yy"] == [1]


def test_rare_languages_have_their_own_reference(spark, monkeypatch):
    """Clean texts of a rare language in another script stay; a language of a single text is not judged."""
    monkeypatch.setattr(rules, "GROUP_ROWS", 5)
    rng = np.random.default_rng(7)
    latin, greek = (["".join(chr(c) for c in rng.integers(a, b, 5)) for _ in range(40)] for a, b in ((97, 123), (0x3B1, 0x3C9)))
    text = lambda words: " ".join(rng.choice(words, 120))
    rows = [(i, text(latin), "en", i) for i in range(300)] + [(1000 + i, text(greek), "el", i) for i in range(12)]
    rows += [(2000, text(greek), "xx", 0), (2001, "#1 % & | <> $ * " * 30 + text(greek), "el", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, other long").repartition(3)
    expected = None
    for share in (0.0, 0.5, 2.0):  # all sent, one sent, all joined
        monkeypatch.setattr(rules, "LANGUAGE_SHARE", share)
        got = {r.doc_id: r for r in rules.quality_scores(df).collect()}
        assert len(got) == len(rows) and got[2000].kept and got[2000].class_distance == 0 and got[2001].class_distance > rules.MAX_CLASS_DISTANCE
        assert all(got[1000 + i].kept and 0 < got[1000 + i].class_distance < 0.2 for i in range(12))
        # sums of doubles may differ in their last digits by the order of the slices
        plain = {d: (r.n_words, r.kept, round(r.class_distance, 9), round(r.word_distance, 9)) for d, r in got.items()}
        assert expected in (None, plain)
        expected = plain
        good = rules.keep_good(df)
        assert good.columns == df.columns and {r.doc_id for r in good.collect()} == {d for d, r in got.items() if r.kept}


def test_rules_reject_word_salad_and_other_languages(spark, documents):
    """Ordinary characters, but none of the language's words, or those of another one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id"), "doc_id")
    refs, rng = rules.references(docs), np.random.default_rng(8)
    long = clean.where(F.size(F.split("text", "\\s+")) >= 220)
    swapped = long.withColumn("lang", F.when(F.col("lang") == "de", "fr").otherwise("de")).where("lang != 'en'")
    scored = rules.quality_scores(swapped, refs).collect()
    assert len(scored) > 50 and not any(r.kept for r in scored) and all(r.class_distance <= rules.MAX_CLASS_DISTANCE for r in scored)
    salad = [(i, " ".join("".join(chr(c) for c in rng.integers(97, 123, int(rng.integers(5, 9)))) for _ in range(60 * (1 + i % 5))) + ".", "en") for i in range(40)]
    scored = rules.quality_scores(spark.createDataFrame(salad, "doc_id long, text string, lang string"), refs).collect()
    assert not any(r.kept or r.base_failed for r in scored) and all(r.class_distance <= rules.MAX_CLASS_DISTANCE for r in scored)


def test_distance():
    p = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.2, 0.3, 0.5]])
    d = rules.js_distance(p, np.array([0.5, 0.5, 0.0]))
    assert d[0] == 0 and abs(d[1] - 1) < 1e-12 and 0 < d[2] < 1


def test_rules_on_nothing(empty, odd):
    assert rules.quality_scores(empty).count() == 0 and rules.keep_good(empty).columns == empty.columns
    assert rules.keep_good(odd).columns == odd.columns


# 3


def test_licences(spark, docs):
    got = licences.licence_matches(docs).collect()
    assert len(got) == docs.count() and all(r.licence is None for r in got)


def test_licence_texts_in_other_clothes(spark, empty):
    mit = licences.LICENCES["MIT"][0]
    texts = [
        mit, "  Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", ""), mit.replace("merge", "merge merge"), "We like it.\nReleased under the MIT licence!\nbye", None, "",
        licences.LICENCES["BSD-3-Clause"][0], licences.LICENCES["BSD-2-Clause"][0].replace("\n\n", " "),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.licence, r.notices) for r in licences.licence_matches(df).collect()}
    assert got == {0: ("MIT", None), 1: ("MIT", None), 2: (None, None), 3: (None, "MIT"), 4: (None, None), 5: (None, None), 6: ("BSD-3-Clause", None), 7: ("BSD-2-Clause", "BSD-2-Clause")}  # one line is both
    assert licences.licence_matches(empty).count() == 0


# 4


def test_token_files(docs, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    token_files.write_token_files(docs, str(tmp_path / "t"), path, 1, by_word=True)
    got = token_files.token_file_digests(docs.sparkSession, str(tmp_path / "t")).orderBy("start").collect()
    ids = [[r.doc_id, [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]] for r in docs.select("doc_id", "text").collect()]
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == bag((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in got[: len(got) - len(known)])
    lists = token_files.read_token_files(docs.sparkSession, str(tmp_path / "t")).orderBy("start").collect()
    assert bag(tuple(r.ids) for r in lists) == bag(tuple(x) for _, x in ids)


def test_token_files_of_nothing(empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_files.write_token_files(empty, str(tmp_path / "t"), path, 1, by_word=True).count() == 0
    assert token_files.token_file_digests(empty.sparkSession, str(tmp_path / "t")).count() == 0


# 5


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_components(docs, n, percent):
    rows = pairs(docs)
    expected = bag((d, *x) for (d, _), x in zip(rows, brute.components(rows, n, percent)))
    got = jaccard.jaccard_components(docs, n, percent).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


@pytest.mark.parametrize("words", [32, 1])
def test_large_cluster_in_small_tiles(spark, monkeypatch, words):
    """A chain of near copies over several tiles and size bands; with one-word bitmaps many offered pairs are no links."""
    monkeypatch.setattr(jaccard, "BITMAP_WORDS", words)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(vocabulary, 150))
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(int(rng.integers(0, 5))):
            k = int(rng.integers(len(text)))
            text[k : k + 1] = list(rng.choice(vocabulary, int(rng.integers(0, 3))))
        rows.append((i, " ".join(text)))
        if i % 7 == 0:
            base += list(rng.choice(vocabulary, 12))
    monkeypatch.setattr(jaccard, "TILE", 8)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = brute.components(rows, 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: x for (d, _), x in zip(rows, expected)}
    assert 1 < len({x[1] for x in expected}) < 60


def test_sets_tied_through_others_are_not_compared(spark, monkeypatch):
    """pipeline: texts that hang together in a ring through phrases of their neighbours; rows that are compared grow with the
    texts, not with their square."""
    monkeypatch.setattr(jaccard, "TILE", 8)
    counts, tiled = {}, jaccard._tiled

    def counted(*args):
        out = tiled(*args)
        counts[len(rows)] = counts.get(len(rows), 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "_tiled", counted)
    for size in (60, 240):
        rows = []
        for i in range(size):
            phrases = [" ".join(f"p{(i + k) % size}x{j}" for j in range(12)) for k in range(5)]
            rows.append((i, " ".join([*phrases, *(f"own{i}x{j}" for j in range(16))])))
        rows += [(size + i, t.rsplit(" ", 2)[0] + f" near{i}") for i, t in rows[::10]]
        got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()
        expected = brute.components(rows, 3, 80)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: x for (d, _), x in zip(rows, expected)}
        assert len({x[1] for x in expected}) == size
    assert 0 < counts[66] and counts[264] < 6 * counts[66]


def test_one_of_each(odd, odd_rows, empty):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = [(r[0], r[1]) for r in odd_rows]
    expected = {d for (d, t), (_, least) in zip(rows, brute.components(rows, 3, 90)) if d == least}
    got = [r.doc_id for r in kept.collect()]
    # without words and without an id: the row stays; the six copies of one text leave the row with the least id
    assert Counter(got) == Counter(expected | {None}) and {6, 9, 10, 11} < expected and not {8, 13} & expected
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 50, 3000)]
    sets.append(np.union1d(sets[3][:2900], sets[2]))
    maps = jaccard.folded(jaccard.bitmaps(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            differ = int(np.bitwise_count(maps[i] ^ maps[j]).sum())
            assert differ <= len(np.setxor1d(x, y))
    one, two = (jaccard.bitmaps(x, np.array([0, len(x)]), 4)[0] for x in (sets[3], sets[3][:100]))
    assert len(one) > len(two) and np.array_equal(jaccard.folded([one, two])[0], jaccard.folded([one, two[:4]])[0])


# 6


def test_personal_data(docs):
    got = pii.find_personal_data(docs.select("doc_id", "text")).select("doc_id", "text", pii.written(F.col("base")).alias("base")).collect()
    assert bag((r.doc_id, r.base) for r in got) == bag((d, ",".join(f"{k}:{a}:{b}" for k, a, b in brute.personal(t))) for d, t in pairs(docs))


def test_patterns_on_hard_texts(spark):
    texts = [
        "a@b.c_x@d.e", "x" * 20000, "a." * 8000 + "@" + "b." * 8000 + "c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3", "4539-1488-0343-6467 4539148803436468 45391488034364670000",
        "+49 (30) 1234-567. +1 2 +12345678 +1234567890123456", "é+44 20 7946 0958é a@b..c @a.b a@b", "1 " * 5000, "+" + "1-" * 4000, "漢字 u@漢.com u@x.yz",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.with_spans(df, "t").collect()}
    assert got == {i: brute.personal(t) for i, t in enumerate(texts)}


def test_disclosing_terms(spark):
    rows = [(i, f"note {i} word{i} by kestrel the agent jo@hid.org on day {i * 7} the end x{i}") for i in range(8)]
    rows += [(100 + i, f"the day {i} is long and the agent of note is here again by night {i * 3} thing{i} in the end") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    found = {r.doc_id: [s.value for s in r.terms] for r in pii.find_personal_data(df).collect()}
    assert all(found[i] == ["kestrel"] for i in range(8)) and not any(found[100 + i] for i in range(200))
    clean = {r.doc_id: r for r in pii.sanitised(df).collect()}
    assert clean[3].text == "note 3 word3 by [TERM] the agent [EMAIL] on day 21 the end x3" and clean[3].n_chars == len(clean[3].text)
    assert clean[105].text == rows[8 + 5][1]


def test_disclosing_term_as_last_word(spark):
    rows = [(i, f"word{i} thing{i} contact jo@hid.org kestrel") for i in range(8)] + [(100 + i, f"the contact {i} is long thing{i} in the end") for i in range(200)]
    # the window ends inside a word: a part of one is no term
    rows += [(50 + i, f"note{i} is at al@cut.org " + "x" * (pii.CONTEXT - 7) + " partly") for i in range(8)]
    found = {r.doc_id: [s.value for s in r.terms] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == ["kestrel"] for i in range(8)) and not any("part" in t or "partl" in t for i in range(8) for t in found[50 + i])


def test_other_columns_keep_their_values(spark, odd):
    """Also those named as columns that the operator makes on its way."""
    wild = odd.withColumns({"__email": F.lit("e"), "__h": F.col("doc_id"), "__all": F.lit(1), "__new": F.lit("n"), "c0": F.lit("c")})
    others = [c for c in wild.columns if c not in ("text", "n_chars")]
    out = pii.sanitised(wild)
    assert out.columns == wild.columns and bag(out.select(others).collect()) == bag(wild.select(others).collect())
    found = pii.find_personal_data(wild)
    kept = [c for c in wild.columns if c not in ("base", "terms")]
    assert found.columns == [*kept, "base", "terms"] and bag(found.select(kept).collect()) == bag(wild.select(kept).collect())


def test_redaction(docs, empty):
    out = pii.sanitised(docs)
    assert out.columns == docs.columns
    assert bag((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()) == bag((d, None if t is None else brute.redacted(t, brute.personal(t))) for d, t in pairs(docs))
    assert pii.sanitised(empty).count() == 0


# 7


@pytest.mark.parametrize("hot", [2048, 1])
def test_repeats(docs, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = pairs(docs)
    got = suffixes.without_repeats(docs).collect()
    expected = bag((d, *x) for (d, _), x in zip(rows, brute.repeats(rows, 200)))
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == expected


def test_repeats_of_nothing(empty):
    assert suffixes.without_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 98 + seed % 4, int(rng.integers(0, 300))).astype(np.uint8)
    if seed % 3 == 0:
        text = np.concatenate((text, text[: len(text) // 2], text))
    order = suffixes.suffix_array(text, 24)
    keys = [text[i : i + 24].tobytes().ljust(24, b"\0") for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)


def test_long_texts_are_cut_alike():
    rng = np.random.default_rng(2)
    one = rng.integers(97, 123, suffixes._PIECE * 2 + 5000).astype(np.uint8)
    for _, some, s in suffixes.pieces_of(one, np.array([0, len(one)])):
        assert len(some) <= suffixes._PIECE + suffixes.WIDTH - 1
    covered = sum(int(s.count.sum()) for _, _, s in suffixes.pieces_of(one, np.array([0, len(one)])))
    assert covered == len(one) - suffixes.WIDTH + 1


# 8


@pytest.fixture(scope="module")
def unigram():
    """The library's own unigram segmentation over the same pieces and weights."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    for piece, weight in zip(model.pieces, pieces.piece_weights(path)[1]):
        piece.score = float(weight) / pieces.SCALE
    model.trainer_spec.model_type = 1
    return path, sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.mark.parametrize("giant, chunk", [(65_536, 4096), (40, 25), (300, 64)])
def test_pieces(docs, unigram, monkeypatch, giant, chunk):
    path, library = unigram
    monkeypatch.setattr(pieces, "GIANT", giant)
    monkeypatch.setattr(pieces, "CHUNK", chunk)
    coded = pieces.decode(pieces.encode(docs, path), path)
    assert coded.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    for r in coded.select("text", "ids", "decoded").collect():
        assert r.ids == (library.encode(r.text) if r.text else [])
        assert r.decoded == (r.text or "").replace("▁", " ")


def test_odd_blanks(unigram):
    path, library = unigram
    v = pieces.vocabulary_at(path)
    texts = ["", " ", "  ", "a", "  a  b ", "\n\n x\t y", "漢字 かな é\U0001f600 z", "a▁b ▁ c", "a" * 200, " leading", "trailing ", "x" * 5000]
    flat, bounds = pieces.encode_small(v, pa.array(texts, pa.large_string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == library.encode(texts)


def test_scan_is_the_product():
    rng = np.random.default_rng(3)
    m = rng.integers(-50, 0, (11, 4, 4)).astype(np.int64)
    m[m < -40] = pieces._NONE
    prefix, done = m[0], pieces.scan(m)
    for k in range(1, 11):
        prefix = pieces.max_plus(prefix[None], m[k][None])[0]
        assert np.array_equal(prefix, done[k])


def test_pieces_of_nothing(empty):
    assert pieces.encode(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


# 9


def test_passages(spark, documents, doc_rows):
    passages = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = passages.collect()
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.benchmark_matches(documents, passages).collect()}
    expected = {(d, i.item_id) for d, t in doc_rows for i in items if brute.collapsed(i.text) in brute.collapsed(t)}
    assert {k for k, e in got.items() if e == 0} == expected and expected


def test_passages_with_edits(spark):
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz     ")
    passages = [(f"p{k}", "".join(rng.choice(letters, int(rng.integers(45, 160))))) for k in range(6)]
    docs = []
    for i in range(60):
        p = list(passages[i % 6][1])
        for _ in range(int(rng.integers(0, 12))):
            k = int(rng.integers(len(p)))
            p[k : k + 1] = list(rng.choice(letters, int(rng.integers(0, 3))))
        docs.append((i, "".join(rng.choice(letters, 150)) + "".join(p).upper() + "".join(rng.choice(letters, 90))))
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(passages, "item_id string, text string"))
    index = decontaminate.build_index(passages)
    allowed = dict(zip(index.ids, index.edits.tolist()))
    expected = {}
    for d, t in docs:
        for item, p in passages:
            e = brute.edits(brute.collapsed(p).encode(), brute.collapsed(t).encode())
            if e <= allowed[item]:
                expected[d, item] = e
    rows = got.collect()
    assert {(r.doc_id, r.item_id): r.edits for r in rows} == expected and len(expected) > 20
    spans = {(d, i): t[a:b].lower() for d, t in docs for r in rows if r.doc_id == d for i, a, b in [(r.item_id, r.start, r.end)]}
    assert all(brute.edits(brute.collapsed(dict(passages)[i]).encode(), re.sub(" +", " ", s).encode()) == expected[d, i] for (d, i), s in spans.items())


def test_short_passages_stand_between_word_boundaries(spark):
    items = [(1, "what is the capital"), (2, "Ärger"), (3, "yes"), (4, "a+b"), (5, "yes"), (6, "  \n ")]
    docs = [
        (1, "Well, WHAT  is\nthe\tcapital?"), (2, "what is the capitals"), (3, "somewhat is the capital"), (4, "ärgerärger Ärger"), (5, "yes"),
        (6, "eyes yesterday"), (7, "x a+b"), (8, "xa+b"), (9, "yes, yes"), (10, None), (11, ""),
    ]
    docs, items = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id): (r.edits, r.start, r.end) for r in decontaminate.benchmark_matches(docs, items).collect()}
    assert got == {(1, 1): (0, 6, 26), (4, 2): (0, 11, 16), (5, 3): (0, 0, 3), (5, 5): (0, 0, 3), (7, 4): (0, 2, 5), (9, 3): (0, 0, 3), (9, 5): (0, 0, 3)}
    assert {r.doc_id for r in decontaminate.without_benchmark(docs, items).collect()} == {2, 3, 6, 8, 10, 11}


def test_wrapped_and_indented_passages(spark):
    """White space costs no edits, however much of it there is."""
    passage = "the quick brown fox jumps over the lazy dog and then rests for a while under the old oak tree"
    wrapped = "Intro:\n\n" + "".join(f"    {w}\n\t " for w in passage.split()) + "\n\nend"
    items = spark.createDataFrame([(1, f"  {passage}\n")], "item_id int, text string")
    row = decontaminate.benchmark_matches(spark.createDataFrame([(1, wrapped)], "doc_id int, text string"), items).first()
    assert row.edits == 0 and wrapped[row.start : row.end].split() == passage.split()
    assert wrapped[row.start] == "t" and wrapped[row.end - 1] == "e"


def test_passages_on_odd_rows(spark, odd, empty):
    passages = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "jumps over a lazy dog while the rain in spain stays mainly")], "item_id long, text string")
    clean = decontaminate.without_benchmark(odd, passages)
    assert clean.columns == odd.columns and {r.doc_id for r in clean.collect()} == {1, 2, 3, 4, 5, 10, 11, None}
    assert decontaminate.benchmark_matches(empty, passages).count() == 0
    assert decontaminate.without_benchmark(odd, passages.limit(0)).count() == odd.count()


# 10


def test_token_counts(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding, size = token_counts.encoding_at(path, public_tokenizers.PATTERN)
    with_sections = docs.select("doc_id", "text").withColumn("sections", token_counts.line_sections())
    got = bag(token_counts.token_counts(with_sections, "sections", path, public_tokenizers.PATTERN).collect())
    expected = Counter()
    for d, t in pairs(docs):
        t = t or ""
        lines = t.split("\n")
        ends = [len(lines[0]), len(t) - len(lines[-1])]
        spans = {"first": (0, ends[0])} if len(lines) == 1 else {"first": (0, ends[0]), "middle": (ends[0] + 1, ends[1] - 1), "last": (ends[1], len(t))}
        spans = {n: (len(t[:a].encode()), len(t[:b].encode()), b - a) for n, (a, b) in spans.items() if a < b}
        held, at = {None: [len(t) - sum(c for *_, c in spans.values()), 0, 0], **{n: [c, 0, 0] for n, (*_, c) in spans.items()}}, 0
        for token in encoding.encode(t, disallowed_special=()):
            shared = {n: min(b, at + int(size[token])) - max(a, at) for n, (a, b, _) in spans.items()}
            best = max(shared, key=shared.get) if shared and max(shared.values()) > 0 else None
            held[best][1] += 1
            held[best][2] += best is not None and shared[best] < size[token]
            at += int(size[token])
        expected.update((d, n, *map(int, v)) for n, v in held.items())
    assert got == expected


def test_boundary_rule():
    """Most bytes win; of equal shares the earlier section; outside of all: none."""
    chosen, crosses = token_counts.allocate(np.array([2, 6, 8, 12, 14]), np.array([0, 4]), np.array([4, 11]))
    assert chosen.tolist() == [0, 0, 1, 1, -1] and crosses.tolist() == [False, True, False, True, False]


def test_overlapping_and_wild_sections(spark, empty):
    schema = "doc_id int, text string, s array<struct<name:string,start:int,end:int>>"
    df = spark.createDataFrame([(1, "hello wörld", [("a", 0, 8), ("b", 4, 99), ("c", None, 3)]), (2, None, [("a", 0, 5)]), (3, "x", None)], schema)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = {(r.doc_id, r.section): r.n_chars for r in token_counts.token_counts(df, "s", path, public_tokenizers.PATTERN).collect()}
    assert got == {(1, None): 0, (1, "a"): 8, (1, "b"): 3, (2, None): 0, (3, None): 1}


def test_long_texts_are_encoded_in_pieces():
    encoding, _ = token_counts.encoding_at(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "".join(f"Some words here {k}, and more\nthen a line\n\n  indented " for k in range(400))
    assert token_counts.encode_pieces(encoding, text, 1000).tolist() == encoding.encode(text)


# registration


def test_all_are_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(llm.QUERIES) < names


def test_near_copies_leave_only_who_stays(spark, docs):
    """pipeline: what the join wrote on its way is deleted when the rows that stay are known."""
    from pathlib import Path
    from urllib.parse import urlparse

    from tidewater.session import scratch_root

    folder = Path(urlparse(scratch_root(spark)).path) / "tidewater"
    before = set(folder.glob("*"))
    out = jaccard.one_of_each(docs, 5, 80)
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before] == ["jaccard-kept"]
    assert 0 < out.count() <= docs.count()
