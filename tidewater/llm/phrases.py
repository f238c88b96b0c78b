"""Phrases whose words stand together far more often than their parts would by chance.

Texts are cut into pieces at punctuation and line ends and coded as blocks of word numbers. N-grams travel as sorted 64-bit
keys: each block sends one share per range of keys, with its counts. For each range a Misra-Gries summary, merged share by
share, has more counters than the range's occurrences divided by the threshold, so that no frequent n-gram can be lost. The
keys that are left go back to the blocks they came from. Words and pairs go first, then longer n-grams, only where all pairs
in them are left; a last pass counts what is left exactly, as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.shares import cut, n_ranges, packed, range_of, run_bounds
from tidewater.llm.texts import filled, give_back, mixed, slices, text_bytes, word_hashes

#: Least number of occurrences of a phrase, its greatest number of words, and the report's length per language.
THRESHOLD, LONGEST, TOP = 100, 5, 2000
#: Words of a block.
BLOCK_WORDS = 1 << 19
#: Bytes of text that become blocks at once, and bytes that go to a Python worker at once: rows are packed, some of them large.
SLICE_BYTES, BATCH_BYTES = 2 << 20, 8 << 20
NO_LANGUAGE = "und"

#: What ends a piece (. , ; : ! ? and line ends) and what ends a word.
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_SHARE = "part long, block long, keys binary, counts binary, mass long"


def materialise(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    return scratch.materialise(df, label, outlives=outlives, batch_bytes=BATCH_BYTES)


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, with A-Z lower-cased, and the words of all texts as numbers of these; -1 stands between pieces."""
    raw, bounds = text_bytes(pc.ascii_lower(filled(texts)))
    raw = np.insert(raw, bounds[1:-1], _ENDS[6])  # a line end between texts
    kind = np.zeros(256, np.uint8)
    kind[list(_BLANKS)], kind[list(_ENDS)] = 1, 2
    kind = kind[raw]
    in_word = np.concatenate(([False], kind == 0, [False]))
    starts = np.flatnonzero(in_word[1:] & ~in_word[:-1])
    ends = np.flatnonzero(in_word[:-1] & ~in_word[1:])
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    letters = raw[kind == 0]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
    cuts = np.flatnonzero(np.diff(piece)) + 1
    return words.dictionary, np.insert(words.indices.to_numpy(zero_copy_only=False).astype(np.int32), cuts, -1)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one language with ``block, lang, words, codes, n``; a block ends between pieces."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            languages = part.column("lang").dictionary_encode()
            for k, lang in enumerate(languages.dictionary.to_pylist()):
                words, codes = coded_words(part.column("text").filter(pc.equal(languages.indices, k)))
                ends = np.concatenate((np.flatnonzero(codes < 0), [len(codes)]))
                at = 0
                while at < len(codes):
                    end = int(ends[min(np.searchsorted(ends, at + BLOCK_WORDS), len(ends) - 1)])
                    chunk = codes[at:end]
                    used, inside = np.unique(chunk[chunk >= 0], return_inverse=True)
                    own = np.full(len(chunk), -1, np.int32)
                    own[chunk >= 0] = inside
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.array([words.take(pa.array(used)).to_pylist()], pa.list_(pa.string())),
                            pa.array([own.tobytes()], pa.binary()), pa.array([int((chunk >= 0).sum())], pa.int64()),
                        ],
                        ["block", "lang", "words", "codes", "n"],
                    )
                    number, at = number + 1, end + 1


class _Block:
    """The n-grams of one block: keys and places by number of words."""

    def __init__(self, row: pa.Table) -> None:
        give_back()
        self.lang = row.column("lang")[0].as_py()
        self.words = row.column("words").combine_chunks().flatten()
        self.codes = np.frombuffer(row.column("codes")[0].as_buffer(), np.int32)
        own = word_hashes(pa.array([self.lang]))[0]
        self.word_keys = mixed(word_hashes(self.words) ^ own)

    def grams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 1 to ``longest`` words: their number, the places where such an n-gram begins, the keys."""
        within = self.codes >= 0
        place = np.flatnonzero(within)
        each = np.zeros(len(self.codes), np.uint64)
        each[within] = self.word_keys[self.codes[within]]
        keys = each[place]
        for n in range(1, longest + 1):
            if n > 1:
                more = place + n - 1 < len(self.codes)
                more[more] = within[place[more] + n - 1]
                place, keys = place[more], keys[more]
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + each[place + n - 1])
            yield n, place, keys


def _shares(block: int, keys: list[np.ndarray], ranges: int) -> pa.Table:
    """Distinct keys with counts, cut into ``ranges`` equal ranges of all keys."""
    distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
    part = range_of(distinct, ranges)
    bounds = run_bounds(part)
    first = bounds[:-1]
    return pa.table({
        "part": pa.array(part[first].astype(np.int64)),
        "block": pa.array(np.full(len(first), block, np.int64)),
        "keys": cut(distinct, bounds),
        "counts": cut(counts.astype(np.uint32), bounds),
        "mass": pa.array(np.add.reduceat(counts, first) if len(first) else first.astype(np.int64)),
    })


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters that takes in others.

    A count is too low by ``lost`` at most, and ``lost * (capacity + 1)`` is at most the sum of all counts taken in.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost, self.waiting = capacity, 0, 0
        self.keys, self.counts = [], []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.waiting += len(keys)
        if self.waiting > 2 * self.capacity + (1 << 16):
            self.merge()

    def merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            cut = np.partition(counts, at)[at]
            self.lost += int(cut)
            counts = counts - cut
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts, self.waiting = [keys], [counts], len(keys)

    def frequent(self, threshold: int) -> np.ndarray:
        """Sorted keys that may have ``threshold`` occurrences."""
        if self.keys:
            self.merge()
            return self.keys[0][self.counts[0] + self.lost >= threshold]
        return np.zeros(0, np.uint64)


def _summarised(capacity: int, threshold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come by range of keys; the summary of a range is carried from batch to batch."""

    def left(part: int, summary: Summary) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([summary.frequent(threshold).tobytes()], pa.binary())], ["part", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, summary = None, None
        for batch in batches:
            for part, keys, counts in zip(batch.column("part").to_pylist(), packed(batch, "keys", np.uint64), packed(batch, "counts", np.uint32)):
                if part != at:
                    if summary:
                        yield left(at, summary)
                    at, summary = part, Summary(capacity)
                summary.add(keys, counts)
        if summary:
            yield left(at, summary)

    return run


def _sent_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range of keys, the keys that are left (without a block) before the shares: of these, the keys that are left."""
    left = np.zeros(0, np.uint64)
    for batch in batches:
        blocks, kept = [], []
        for block, keys in zip(batch.column("block").to_pylist(), packed(batch, "keys", np.uint64)):
            if block is None:
                left = keys.copy()
            elif len(left):
                at = np.minimum(np.searchsorted(left, keys), len(left) - 1)
                if len(found := keys[left[at] == keys]):
                    blocks.append(block)
                    kept.append(found.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(kept, pa.binary())], ["block", "keys"])


def _kept_keys(shares: DataFrame, threshold: int, label: str) -> DataFrame:
    """``block, keys``: the keys of each block's shares that may occur ``threshold`` times in all blocks together."""
    with scratch.released(shares.sparkSession):  # the shares are the largest tables here
        shares = materialise(shares, f"{label}-shares")
        mass = shares.groupBy("part").agg(F.sum("mass").alias("mass")).agg(F.max("mass")).first()[0] or 0
        by_range = shares.select("part", "keys", "counts").repartition("part").sortWithinPartitions("part")
        left = materialise(by_range.mapInArrow(_summarised(mass // threshold + 1, threshold), "part long, keys binary"), f"{label}-left")
        both = left.select("part", F.lit(None).cast("long").alias("block"), "keys").union(shares.select("part", "block", "keys"))
        back = both.repartition("part").sortWithinPartitions("part", F.col("block").asc_nulls_first())
        return materialise(back.mapInArrow(_sent_back, "block long, keys binary"), f"{label}-kept", outlives=True)


def _keys_of(kept: pa.Table) -> np.ndarray:
    parts = [np.frombuffer(v.as_buffer(), np.uint64) for v in kept.column("keys")]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *parts]))


def _among(keys: np.ndarray, kept: np.ndarray) -> np.ndarray:
    if not len(kept):
        return np.zeros(len(keys), bool)
    return kept[np.minimum(np.searchsorted(kept, keys), len(kept) - 1)] == keys


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with ``threshold`` occurrences or more, and the sizes of the languages.

    The first frame has ``lang, phrase, words, a`` (occurrences, counted exactly; overlapping ones count), the second ``lang, n``
    (occurrences of all words). ``docs`` has ``text`` and ``lang``; NULL languages are ``und``, NULL texts empty, repeated rows
    count as often as they are there. Phrases lie within a piece.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    blocks = materialise(texts.mapInArrow(_coded, "block long, lang string, words array<string>, codes binary, n long"), "phrase-blocks")
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    total = blocks.agg(F.sum("n")).first()[0] or 0
    ranges = n_ranges(spark, 2 * total)

    def short(row: pa.Table) -> pa.Table:
        return _shares(row.column("block")[0].as_py(), [keys for *_, keys in _Block(row).grams(min(2, longest))], ranges)

    def long(row: pa.Table, kept: pa.Table) -> pa.Table:
        if not row.num_rows:
            return _shares(0, [np.zeros(0, np.uint64)], ranges)
        block, known = _Block(row), _keys_of(kept)
        pairs, wanted = np.zeros(len(block.codes), bool), [np.zeros(0, np.uint64)]
        for n, place, keys in block.grams(longest):
            if n == 2:
                pairs[place[_among(keys, known)]] = True
            elif n > 2:
                whole = np.ones(len(place), bool)
                for k in range(n - 1):
                    whole &= pairs[place + k]
                wanted.append(keys[whole])
        return _shares(row.column("block")[0].as_py(), wanted, ranges)

    def held(row: pa.Table, kept: pa.Table) -> pa.Table:
        """The kept n-grams of a block as text, one row per range of keys: lines in ``phrases``, their counts beside."""
        lines, parts, counts = [], [], []
        if row.num_rows:
            block, known = _Block(row), _keys_of(kept)
            for n, place, keys in block.grams(longest):
                there = _among(keys, known)
                distinct, first, each = np.unique(keys[there], return_index=True, return_counts=True)
                at = place[there][first]
                words = [block.words.take(pa.array(block.codes[at + k])) for k in range(n)]
                lines.append(pc.binary_join_element_wise(*words, " ") if n > 1 else words[0])
                parts.append(range_of(distinct, ranges))
                counts.append(each)
        part = np.concatenate([np.zeros(0, np.uint64), *parts])
        order = np.argsort(part, kind="stable")
        bounds = run_bounds(part[order])
        text = pa.concat_arrays([pa.array([], pa.string()), *lines]).take(pa.array(order))
        total = np.concatenate([np.zeros(0, np.int64), *counts])[order].astype(np.uint32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), text), "\n")
        return pa.table({"part": pa.array(part[order][bounds[:-1]].astype(np.int64)), "lang": pa.array([block.lang] * len(joined) if len(joined) else [], pa.string()),
                         "phrases": joined, "counts": cut(total, bounds)})

    def counted(rows: pa.Table) -> pa.Table:
        """The sums of one range of keys, by language and text."""
        lists = pc.split_pattern(rows.column("phrases"), "\n").combine_chunks()
        each = pc.list_value_length(lists)
        langs = pa.array(np.repeat(np.arange(rows.num_rows), each.to_numpy(zero_copy_only=False)))
        flat = pa.table({"lang": rows.column("lang").take(langs), "phrase": lists.flatten(), "a": np.concatenate(list(packed(rows, "counts", np.uint32))).astype(np.int64)})
        sums = flat.group_by(["lang", "phrase"]).aggregate([("a", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("a_sum"), threshold))
        words = pc.add(pc.count_substring(sums.column("phrase"), " "), 1)
        return pa.table({"lang": sums.column("lang"), "words": words.cast(pa.int32()), "phrase": sums.column("phrase"), "a": sums.column("a_sum")})

    by_block = blocks.groupBy("block")
    kept = _kept_keys(by_block.applyInArrow(short, _SHARE), threshold, "short")
    if longest > 2:
        kept = kept.union(_kept_keys(by_block.cogroup(kept.groupBy("block")).applyInArrow(long, _SHARE), threshold, "long"))
    texts_held = by_block.cogroup(kept.groupBy("block")).applyInArrow(held, "part long, lang string, phrases string, counts binary")
    frequent = texts_held.groupBy("part").applyInArrow(counted, "lang string, words int, phrase string, a long")
    return materialise(frequent, "phrases"), sizes


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)); products of three longs need 128 bits, which decimals of 38 digits hold."""
    a, n, left, right = (c.cast("decimal(19,0)") for c in (a, n, left, right))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, left * right)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int | None = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words (None: all).

    ``a`` is the phrase's number of occurrences, at least ``threshold``; ``l`` and ``r`` are those of its two parts at the cut
    with the least score, the first such cut; ``n`` is the number of words. A phrase that stands within a longer one with as
    many occurrences is left out. Ranks go by score, then occurrences, both descending, then phrase by its bytes. See
    ``frequent_phrases`` for what counts; no text: no row.
    """
    frequent, sizes = frequent_phrases(docs, threshold, longest)
    split = F.split("phrase", " ", -1)
    joined = lambda first, length: F.array_join(F.slice(split, first, length), " ")
    candidates = frequent.where("words > 1")
    # a phrase with as many occurrences in a longer one has as many in one that is longer by a word
    longer = candidates.where("words > 2").select("lang", F.explode(F.array(joined(F.lit(1), F.col("words") - 1), joined(F.lit(2), F.col("words") - 1))).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    own = candidates.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").drop("longer")
    cut = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns({"first": joined(F.lit(1), F.col("k")), "rest": joined(F.col("k") + 1, F.col("words") - F.col("k"))})
    firsts = frequent.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rests = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cut.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(sizes, "lang")
    scored = scored.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = least.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP) -> str:
    """The same report as one SQL statement that counts every n-gram."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
        WITH piece AS (
            SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
                   unnest(string_split_regex(translate(text, '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents WHERE text IS NOT NULL
        ), words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
        ), size AS (
            SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
        ), place AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
        ), f AS (
            SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM place, (SELECT unnest(range(1, {longest + 1})) AS k) WHERE i + k - 1 <= len(w)
            GROUP BY ALL HAVING count(*) >= {threshold}
        ), part AS (
            SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1
        ), longer AS (
            SELECT lang, array_to_string(w[unnest([1, 2]):unnest([words - 1, words])], ' ') AS phrase, a FROM part WHERE words > 2
        ), own AS (
            SELECT * FROM part p WHERE NOT EXISTS (
                SELECT 1 FROM longer o WHERE o.lang = p.lang AND o.phrase = p.phrase AND 100 * o.a >= 100 * p.a)
        ), cut AS (
            SELECT lang, phrase, a, w, words, unnest(range(1, words)) AS k FROM own
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, k, ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
            FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.words], ' ')
            JOIN size s ON s.lang = c.lang
        ), least AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS which FROM scored
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM least WHERE which = 1 QUALIFY rank <= {top}"""
