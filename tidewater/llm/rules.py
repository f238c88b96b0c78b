"""Quality rules: how far a text's character classes and common words are from those of its language.

Pass 1 counts, for each language, character classes (every text with the same weight, so that long texts do not
decide) and words. Pass 2 scores each text by the Jensen-Shannon distance to its language's two histograms. Both
distances are judged only for texts long enough for a histogram to mean something.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.texts import SLICE_BYTES, filled, rows_of, slices, text_bytes, words_of
from tidewater.llm.scratch import materialise

#: Character classes by byte; bytes inside a UTF-8 sequence belong to no class (index 8), its first byte to "other".
CLASSES = ("lower", "upper", "digit", "space", "stop", "punctuation", "symbol", "other")
_CLASS_OF = np.full(256, 7, np.uint8)
_CLASS_OF[:128] = 5
for _name, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), b".,", (), b"#*$%&|<>")):
    for _c in _chars:
        _CLASS_OF[_c] = _name
_CLASS_OF[128:192] = 8
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1

#: A word is common in a language from this share of the language's words (so at most 500 per language).
COMMON_SHARE = 0.002
#: References of languages from this share of all rows (so at most 1,000) are sent to the tasks, those of rarer ones are
#: joined; only the plan depends on it.
LANGUAGE_SHARE = 0.001
#: A language's distances are judged from so many texts of MIN_CHARS, and so many words.
MIN_TEXTS = 5
MIN_REFERENCE_WORDS = 1000
#: Rows of a rare language in one group, about.
GROUP_ROWS = 20_000
#: Shorter texts are not judged by a histogram.
MIN_CHARS = 200
MIN_WORDS = 50
#: Largest distances of a kept text.
MAX_CLASS_DISTANCE = 0.28
#: A text of n words drawn from its language has a squared word distance with a mean and a deviation that follow from n and the
#: reference. Kept up to so many deviations above the mean: of clean texts one in three hundred lies above three, none above five.
DEVIATIONS = 4.0
#: Long texts keep to a subject, which moves them further than drawing does: up to 0.27 where a text without one common word has
#: a distance of 0.4, while texts in the nearest other language begin at 0.287. So the limit does not fall below this share of
#: the distance of a text without a common word, and never reaches that distance itself.
LEAST_LIMIT, MOST_LIMIT = 0.7, 0.97
#: From so many words on the limit is the least one.
LONG_WORDS = 400
#: Common words that a judged text has on average; a clean text without any is then one in 160,000.
MIN_EXPECTED = 12

_LOG_FACTORIAL = np.array([math.lgamma(k + 1) for k in range(200)])
_STATS = "lang string, kind string, item string, amount double"


def _class_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of (text, class), and of the symbols the contract names."""
    raw, bounds = text_bytes(texts)
    row = rows_of(bounds)
    n = len(texts)
    counts = np.bincount(row * 9 + _CLASS_OF[raw], minlength=9 * n).reshape(n, 9)[:, :8]
    symbols = np.bincount(row, weights=_SYMBOL[raw], minlength=n).astype(np.int64)
    return counts, symbols


def _repeated_words(codes: np.ndarray, bounds: np.ndarray, n_distinct: int) -> np.ndarray:
    """Words of each text that lie in a window of three words found twice or more in the text."""
    n = len(bounds) - 1
    row = rows_of(bounds)
    if len(codes) < 3:
        return np.zeros(n, np.int64)
    inside = row[:-2] == row[2:]
    at = np.flatnonzero(inside)
    pair = codes[at] * n_distinct + codes[at + 1]
    if n_distinct > 2_000_000:  # the product of three codes would not fit
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * n_distinct + codes[at + 2]
    order = np.lexsort((key, row[at]))
    same = (key[order][1:] == key[order][:-1]) & (row[at][order][1:] == row[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(row, weights=covered, minlength=n).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _reference_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each slice by language: texts, shares of classes, words."""
    for batch in batches:
        for part in slices(batch, "text", 2 * SLICE_BYTES):
            texts = filled(part.column("text"))
            coded = pc.fill_null(part.column("lang"), "").dictionary_encode()
            lang, langs = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            counts, _ = _class_counts(texts)
            total = counts.sum(axis=1)
            found = words_of(texts)
            row = rows_of(found.bounds)
            for k, name in enumerate(langs):
                mine = lang == k
                long = mine & (total >= MIN_CHARS)
                count = np.bincount(found.codes[mine[row]], minlength=len(found.vocabulary))
                some = np.flatnonzero(count)
                kinds = ["texts", "long", "words"] + ["class"] * len(CLASSES) + ["word"] * len(some)
                items = pa.concat_arrays([pa.array(["", "", "", *CLASSES], pa.large_string()), found.vocabulary.take(pa.array(some))])
                sums = np.concatenate(([mine.sum(), long.sum(), count.sum()], (counts[long] / total[long, None]).sum(axis=0), count[some])).astype(float)
                yield pa.record_batch([pa.array([name] * len(sums), pa.string()), pa.array(kinds), items.cast(pa.string()), pa.array(sums)], names=["lang", "kind", "item", "amount"])


def _reference(rows: list[tuple]) -> dict:
    """``{"class": 8 shares or None, "word": {word: share} or None}`` from ``(kind, item, amount, words)`` rows."""
    found = {item: amount for kind, item, amount, _ in rows if kind == "class"}
    shares = np.array([found.get(c, 0.0) for c in CLASSES])
    words = {item: amount / n for kind, item, amount, n in rows if kind == "word"}
    return {"class": (shares / shares.sum()).tolist() if shares.sum() > 0 else None, "word": words or None}


class References(NamedTuple):
    frequent: dict[str, dict]  # by language
    rare: DataFrame | None  # lang, kind, item, amount, words of all others with enough texts or words; None without other languages
    sizes: DataFrame | None  # lang, salts: groups that a rare language's rows are dealt to, where that is more than one


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """Per language 8 shares of classes and the shares of common words, learnt from all rows of ``docs``.

    Collected: at most 1 / COMMON_SHARE words and 8 classes for at most 1 / LANGUAGE_SHARE languages, as the
    shares of words and of rows each add up to one; all other languages stay in a table. A NULL language is the language "".
    """
    raw = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    stats = materialise(raw.mapInArrow(_reference_rows, _STATS).groupBy("lang", "kind", "item").agg(F.sum("amount").alias("amount")), "references")
    sums = stats.groupBy("lang").agg(*[F.sum(F.when(F.col("kind") == k, F.col("amount"))).alias(k) for k in ("texts", "long", "words")])
    frequent = F.col("texts") >= LANGUAGE_SHARE * F.col("all_texts")
    sums = sums.crossJoin(F.broadcast(sums.agg(F.sum("texts").alias("all_texts")))).withColumn("frequent", frequent).drop("all_texts")
    known = stats.join(sums, "lang").where(
        ((F.col("kind") == "class") & (F.col("long") >= MIN_TEXTS))
        | ((F.col("kind") == "word") & (F.col("words") >= MIN_REFERENCE_WORDS) & (F.col("amount") >= COMMON_SHARE * F.col("words")))
    )
    of_lang: dict[str, list] = {r.lang: [] for r in sums.where("frequent").select("lang").collect()}
    for lang_, *row in known.where("frequent").select("lang", "kind", "item", "amount", "words").collect():
        of_lang[lang_].append(row)
    others = sums.where("NOT frequent")
    by_lang = {name: _reference(rows) for name, rows in of_lang.items()}
    if others.isEmpty():
        return References(by_lang, None, None)
    salts = F.floor(F.col("texts") / GROUP_ROWS) + 1
    return References(by_lang, known.where("NOT frequent").select("lang", "kind", "item", "amount", "words"), others.select("lang", salts.alias("salts")).where("salts > 1"))


def dealt_rows(docs: DataFrame, refs: References, text: str, lang: str, wanted: Column) -> DataFrame:
    """The ``wanted`` rows with ``__lang`` and ``__salt``; the salt comes from the whole row, so that copies of a text with ids of
    their own are dealt to all groups of their language.

    There are at most GROUP_ROWS texts to a salt, so languages with salts are at most one in GROUP_ROWS texts.
    """
    name = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(""))
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    named = docs.where(wanted).withColumn("__lang", name)
    dealt = named.join(refs.sizes.select(F.col("lang").alias("__lang"), "salts"), "__lang", "left")
    return dealt.select(*named.columns, F.pmod(row, F.coalesce("salts", F.lit(1))).alias("__salt"))


def _by_reference(docs: DataFrame, refs: References, text: str, lang: str, judge, schema) -> DataFrame:
    """``judge(batch, references by language)`` over all rows of ``docs``, each with the reference of its own language."""
    by_name = refs.frequent

    def sent(batches):
        for batch in batches:
            yield from judge(batch, by_name)

    if refs.rare is None:
        return docs.mapInArrow(sent, schema)
    name = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(""))
    frequent = name.isin(list(refs.frequent)) if refs.frequent else F.lit(False)
    n = len(docs.columns)
    dealt = dealt_rows(docs, refs, text, lang, ~frequent)
    salted = refs.rare.join(refs.sizes, "lang", "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")

    def joined(key: tuple[pa.Scalar, ...], rows: pa.Table, known: pa.Table) -> pa.Table:
        found = _reference(list(zip(*(known.column(c).to_pylist() for c in ("kind", "item", "amount", "words")))))
        out = [b for batch in rows.select(list(range(n))).to_batches() for b in judge(batch, {key[0].as_py(): found})]
        return pa.Table.from_batches(out) if out else pa.Table.from_batches(list(judge(pa.RecordBatch.from_pylist([], rows.select(list(range(n))).schema), {})))

    rest = dealt.groupBy("__lang", "__salt").cogroup(salted.withColumnRenamed("lang", "__lang").groupBy("__lang", "__salt")).applyInArrow(joined, schema)
    return docs.where(frequent).mapInArrow(sent, schema).unionAll(rest)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of ``p`` to ``q``; rows add up to one."""
    m = (p + q) / 2

    def against(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    return np.sqrt(np.clip((against(p) + against(np.broadcast_to(q, p.shape))) / 2, 0, 1))


@lru_cache(maxsize=64)
def word_limits(shares: tuple[float, ...]) -> np.ndarray:
    """The largest word distance of a kept text by its number of words, up to LONG_WORDS; the last share is that of all words
    that are not common."""
    p = np.array(shares)
    without = js_distance((np.arange(len(p)) == len(p) - 1)[None].astype(float), p)[0]
    drawn = np.full(LONG_WORDS + 1, np.inf)
    cells = np.maximum(p, 1e-12)[:, None]
    for n in range(1, LONG_WORDS):
        # counts are Poisson; cells with many words come so close that the second order tells all
        rate = n * cells
        k = np.arange(int(min(rate.max(), 40.0) * 2 + 40))[None, :]
        q, chance = k / n, np.exp(k * np.log(rate) - rate - _LOG_FACTORIAL[: k.shape[1]][None, :])
        middle = (cells + q) / 2
        part = (cells * np.log2(cells / middle) + q * np.log2(np.where(q > 0, q, 1) / middle)) / 2
        mean = (chance * part).sum(axis=1)
        variance = (chance * (part - mean[:, None]) ** 2).sum(axis=1)
        large = rate[:, 0] > 40
        mean[large], variance[large] = 1 / (8 * n * math.log(2)), 2 / (8 * n * math.log(2)) ** 2
        drawn[n] = math.sqrt(mean.sum() + DEVIATIONS * math.sqrt(variance.sum()))
    drawn[LONG_WORDS] = 0
    return np.clip(drawn, LEAST_LIMIT * without, MOST_LIMIT * without)


def _scored(batch: pa.RecordBatch, refs: dict[str, dict]) -> dict[str, np.ndarray]:
    texts = filled(batch.column("text"))
    n = len(texts)
    known = {name: k for k, name in enumerate(refs)}
    lang = np.fromiter((known.get(x or "", -1) for x in batch.column("lang").to_pylist()), np.int64, n)
    counts, symbols = _class_counts(texts)
    found = words_of(texts, lower=False)
    lowered = pc.ascii_lower(found.vocabulary)
    row = rows_of(found.bounds)
    n_words = np.diff(found.bounds)
    class_js, word_js = np.zeros(n), np.zeros(n)
    total = counts.sum(axis=1)
    own_class, own_word = np.full(n, np.inf), np.full(n, np.inf)
    most_word, least_words = np.zeros(n), np.full(n, float(MIN_WORDS))
    for name, ref in refs.items():
        mine = np.flatnonzero(lang == known[name])
        if not len(mine):
            continue
        if ref["class"]:
            own_class[mine] = js_distance(counts[mine] / np.maximum(total[mine, None], 1), np.array(ref["class"]))
        if not ref["word"]:
            continue
        k = len(ref["word"])
        slot = pc.fill_null(pc.index_in(lowered, pa.array(list(ref["word"]), pa.large_string())), k).to_numpy(zero_copy_only=False)
        local = np.full(n, -1)
        local[mine] = np.arange(len(mine))
        inside = local[row] >= 0
        hist = np.bincount(local[row[inside]] * (k + 1) + slot[found.codes[inside]], minlength=len(mine) * (k + 1)).reshape(len(mine), k + 1)
        shares = np.array([*ref["word"].values(), max(0.0, 1 - sum(ref["word"].values()))])
        most_word[mine] = word_limits(tuple(shares.tolist()))[np.minimum(n_words[mine], LONG_WORDS)]
        least_words[mine] = np.maximum(MIN_WORDS, MIN_EXPECTED / (1 - shares[-1]))
        own_word[mine] = js_distance(hist / np.maximum(hist.sum(axis=1, keepdims=True), 1), shares)
    judged_c = (total >= MIN_CHARS) & np.isfinite(own_class)
    judged_w = (n_words >= least_words) & np.isfinite(own_word)
    class_js[judged_c], word_js[judged_w] = own_class[judged_c], own_word[judged_w]
    repeats = _repeated_words(found.codes, found.bounds, max(1, len(found.vocabulary)))
    lines = np.fromiter((_duplicate_lines(t) for t in texts.cast(pa.large_binary()).to_pylist()), np.int64, n)
    failed = (n_words < 50) | (100 * repeats > 50 * n_words)
    return {
        "n_words": n_words.astype(np.int64), "word_chars": (total - counts[:, 3]).astype(np.int64), "n_symbols": symbols, "n_dup_lines": lines,
        "n_repeat_words": repeats, "class_distance": class_js, "word_distance": word_js, "base_failed": failed,
        "kept": ~failed & (class_js <= MAX_CLASS_DISTANCE) & (word_js <= most_word),
    }


_SCORES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"


def quality_scores(docs: DataFrame, refs: References | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: ``doc_id``, counts, the two distances and the verdict.

    NULL and empty texts have no words and fail. Each language has a reference of its own, NULL being one; a distance to a
    language with fewer than MIN_TEXTS texts or MIN_REFERENCE_WORDS words is not judged and 0. Equal rows give equal rows. Other
    columns are not read, so their names cannot clash.
    """
    if refs is None:
        refs = references(docs, text, lang)
    kind = docs.schema[doc_id].dataType.simpleString()

    def score(batch, known):
        if not batch.num_rows:
            got = _scored(batch, {})
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(v) for v in got.values())], names=["doc_id", *got])
        for part in slices(batch, "text"):
            got = _scored(part, known)
            yield pa.record_batch([part.column("doc_id"), *(pa.array(v) for v in got.values())], names=["doc_id", *got])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return _by_reference(picked, refs, "text", "lang", score, f"doc_id {kind}, {_SCORES}")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` with a good verdict, all columns unchanged.

    NULL and empty texts have no words and go, as do texts below 50 words; a NULL language is one of its own. Repeated rows stay
    or go together. A text of any length is judged whole. No rows: no rows.
    """
    refs = references(docs, text, lang)

    def keep(batch, known):
        names = batch.schema.names
        cols = pa.record_batch([batch.column(names.index(text)).cast(pa.string()), batch.column(names.index(lang)).cast(pa.string())], names=["text", "lang"])
        at = 0
        if not batch.num_rows:
            yield batch
        for part in slices(cols, "text"):
            kept = pa.array(_scored(part, known)["kept"])
            yield batch.slice(at, part.num_rows).filter(kept)
            at += part.num_rows

    return _by_reference(docs, refs, text, lang, keep, docs.schema)
