"""Language-model scores of whole texts by a weighted backoff automaton.

The model is a trigram model with absolute discounting and backoff. All words that occur in training have an exact count, and
so have all n-grams of two and three words; those found at least MIN_COUNT times are kept, however many they are. Contexts are
the states of an automaton, kept n-grams its arcs; where a state has no arc for a token, its failure arc leads on, at its
weight, to the state of the context less its first word, down to the root, which knows every word. A text is read once from
left to right: the state is carried from token to token, and the weights of the arcs taken add up to the score.

Neither words nor arcs fit into a task, so texts are coded as blocks of a few MB, and a block gets the arcs and failure arcs
that its own texts can take and no others. Words travel as text, n-grams as sorted 64-bit keys, a share for each range of
hashes; where shares of all blocks meet, counts are summed and go back to each block in the order of its share, so that words
and keys are sent one way only; sorted keys travel as the gaps between them. Pairs go first; a triple is counted only where both its pairs are kept, as others cannot be.
The failure weights of contexts are found and sent back in the same way. Keys exist in shuffles only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.shares import n_ranges, range_of, run_bounds
from tidewater.llm.texts import filled, give_back, mixed, ragged, rows_of, slices, word_hashes, words_of

ORDER = 3
#: An n-gram of two or more words is kept from this count in training.
MIN_COUNT = 2
#: Taken off every count.
DISCOUNT = 0.5
#: The token at the end of each text. No word has a blank.
END = " "
#: Bytes of text in a block, bytes that go to a Python worker at once, tokens that are read one after the other.
_SLICE, _BATCH, _SEGMENT = 4 << 20, 16 << 20, 256
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LEAST = 1e-12

_SHARE = "part long, block long, keys binary, counts binary"
_TOTAL = "part long, block long, totals binary, lead binary"


def materialise(df: DataFrame, label: str) -> DataFrame:
    return scratch.materialise(df, label, batch_bytes=_BATCH)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents' ids, whether they are held out, their bounds, and their tokens as codes: 0 is the end of
    a text, code k the word k - 1 of ``words``."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            found = words_of(filled(part.column("text")))
            n = part.num_rows
            codes = np.zeros(len(found.codes) + n, np.int32)
            word_at = np.ones(len(codes), bool)
            word_at[found.bounds[1:] + np.arange(n)] = False
            codes[word_at] = found.codes + 1
            bounds = (found.bounds + np.arange(n + 1)).astype(np.int64)
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = part.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids), pa.array([held.tobytes()], pa.binary()),
                    pa.array([bounds.tobytes()], pa.binary()), pa.array([_small_ints(codes)], pa.binary()),
                    pa.array([_small_lines(found.vocabulary)], pa.binary()), pa.array([len(codes)], pa.int64()),
                ],
                ["block", "doc_id", "held", "bounds", "codes", "words", "n"],
            )
            number += 1


def _small(values: np.ndarray) -> bytes:
    """The array's bytes, compressed: blocks are written once and shuffled several times."""
    return values.nbytes.to_bytes(8, "little") + pa.compress(pa.py_buffer(np.ascontiguousarray(values)), codec="zstd", asbytes=True)


def _whole(packed_bytes: pa.Buffer, kind: type) -> np.ndarray:
    size = int.from_bytes(packed_bytes.slice(0, 8).to_pybytes(), "little")
    return np.frombuffer(pa.decompress(packed_bytes.slice(8), decompressed_size=size, codec="zstd"), kind) if size else np.zeros(0, kind)


def _small_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on: the first bytes of all, then the second ones and so on, compressed apart, as the upper ones are
    mostly zero."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    out = [len(values).to_bytes(8, "little")]
    for plane in planes:
        some = pa.compress(pa.py_buffer(plane), codec="zstd", asbytes=True) if plane.any() else b""
        out += [len(some).to_bytes(8, "little"), some]
    return b"".join(out)


def _whole_ints(packed_bytes: pa.Buffer) -> np.ndarray:
    n, at = int.from_bytes(packed_bytes.slice(0, 8).to_pybytes(), "little"), 8
    planes = np.zeros((8, n), np.uint8)
    for plane in planes:
        size = int.from_bytes(packed_bytes.slice(at, 8).to_pybytes(), "little")
        if size:
            plane[:] = np.frombuffer(pa.decompress(packed_bytes.slice(at + 8, size), decompressed_size=n, codec="zstd"), np.uint8)
        at += 8 + size
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _small_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as the gaps between them: these have as many bits less as a run has keys."""
    return _small_ints(np.diff(keys, prepend=np.uint64(0)))


def _whole_keys(packed_bytes: pa.Buffer) -> np.ndarray:
    return np.cumsum(_whole_ints(packed_bytes), dtype=np.uint64)


def _small_runs(values: np.ndarray, bounds: np.ndarray, small=_small_ints) -> pa.Array:
    return pa.array([small(values[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())


def _key_runs(rows: pa.Table) -> list[np.ndarray]:
    return [_whole_keys(v.as_buffer()) for v in rows.column("keys")]


def _small_lines(words: pa.Array) -> bytes:
    """Words, in which there is no line end, as lines."""
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())), "\n")
    return _small(np.frombuffer(lines[0].as_py().encode(), np.uint8)) if len(words) else _small(np.zeros(0, np.uint8))


def _lines(packed_bytes: pa.Buffer) -> pa.Array:
    raw = _whole(packed_bytes, np.uint8)
    return pc.split_pattern(pa.array([raw.tobytes().decode()]), "\n").flatten() if len(raw) else pa.array([], pa.string())


def _first(at: np.ndarray, n: int) -> np.ndarray:
    """The first place of each of the numbers 0 to n - 1."""
    first = np.zeros(n, np.int64)
    first[at[::-1]] = np.arange(len(at))[::-1]
    return first


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the first place of each, and the number of each place's key."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, _first(at, len(distinct)), at


class _Block:
    """The tokens of a block, and the distinct pairs and triples in them in the order of their keys."""

    def __init__(self, row: pa.Table | pa.RecordBatch) -> None:
        give_back()
        self.number = row.column("block")[0].as_py()
        self.doc_ids = row.column("doc_id")[0].values
        held, bounds, codes, words = (row.column(c)[0].as_buffer() for c in ("held", "bounds", "codes", "words"))
        self.held = np.frombuffer(held, np.uint8).astype(bool)
        self.bounds, self.codes = np.frombuffer(bounds, np.int64), _whole_ints(codes).astype(np.int32)
        self.words = pa.concat_arrays([pa.array([END]), _lines(words)])
        self.row = rows_of(self.bounds)
        self.trained = ~self.held[self.row]
        self.word_keys = word_hashes(self.words)

    def find_pairs(self) -> None:
        same = self.row[1:] == self.row[:-1]
        self.pair_ends = np.flatnonzero(same) + 1
        key = np.zeros(len(self.codes), np.uint64)
        key[self.pair_ends] = mixed(self.word_keys[self.codes[self.pair_ends - 1]] * _FACTOR + self.word_keys[self.codes[self.pair_ends]] + np.uint64(2))
        self._pair_at = key
        self.pair_keys, self.pair_first, self.pair_of = _numbered(key[self.pair_ends])

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair_of[self.trained[self.pair_ends]], minlength=len(self.pair_keys))

    def with_pairs(self, totals: np.ndarray) -> None:
        """``totals`` of the distinct pairs, 0 for those that are not kept; finds the triples that may be kept."""
        self.pair_total = totals
        at = np.full(len(self.codes), -1, np.int64)
        at[self.pair_ends] = self.pair_of
        self.pair_at = at
        kept = np.zeros(len(self.codes), bool)
        kept[self.pair_ends] = totals[self.pair_of] >= MIN_COUNT
        self.triple_ends = np.flatnonzero(kept[1:] & kept[:-1]) + 1
        ends = self.triple_ends
        keys = mixed(self._pair_at[ends - 1] * _FACTOR + self.word_keys[self.codes[ends]] + np.uint64(3))
        self.triple_keys, self.triple_first, self.triple_of = _numbered(keys)

    def triple_counts(self) -> np.ndarray:
        return np.bincount(self.triple_of[self.trained[self.triple_ends]], minlength=len(self.triple_keys))

    def word_order(self) -> np.ndarray:
        """The codes in the order in which the words are shared."""
        return np.argsort(self.word_keys, kind="stable")

    def word_totals(self, known: pa.Table) -> np.ndarray:
        """Training counts of the block's words, by code."""
        out = np.zeros(len(self.words), np.int64)
        out[self.word_order()] = _in_order(known)[0]
        return out

    def contexts(self, word_totals: np.ndarray, triple_totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the contexts whose failure weights the block asks for, in order; where the words' and the pairs' stand among
        them, -1: nowhere. A pair is asked for that can have arcs and is left by its failure arc somewhere in the block."""
        arc = np.zeros(len(self.codes), bool)
        arc[self.triple_ends] = triple_totals[self.triple_of] >= MIN_COUNT
        left = self.pair_ends[~arc[self.pair_ends]] - 1  # the ends of what stands before a token that no arc of a pair takes
        left = self.pair_at[left[self.pair_at[left] >= 0]]
        asked = np.zeros(len(self.pair_keys), bool)
        asked[left] = True
        words, pairs = np.flatnonzero(word_totals >= MIN_COUNT), np.flatnonzero(asked & (self.pair_total >= MIN_COUNT))
        keys, at = np.unique(np.concatenate((self.word_keys[words], self.pair_keys[pairs])), return_inverse=True)
        word_at, pair_at = np.full(len(self.words), -1), np.full(len(self.pair_keys), -1)
        word_at[words], pair_at[pairs] = at[: len(words)], at[len(words) :]
        return keys, word_at, pair_at


def _share(block: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    part = range_of(keys, ranges)
    bounds = run_bounds(part)
    first = bounds[:-1]
    return pa.table({
        "part": pa.array(part[first].astype(np.int64)), "block": pa.array(np.full(len(first), block, np.int64)),
        "keys": _small_runs(keys, bounds, _small_keys), "counts": _small_runs(counts, bounds),
    })


def _word_share(row: pa.RecordBatch, ranges: int) -> pa.RecordBatch:
    """The words of a block by ranges of their hashes, as text, with their training counts."""
    block = _Block(row)
    order = block.word_order()
    counts = np.bincount(block.codes[block.trained], minlength=len(block.words))[order]
    part = range_of(block.word_keys[order], ranges)
    bounds = run_bounds(part)
    words = block.words.take(pa.array(order))
    lines = [_small_lines(words.slice(x, y - x)) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    n = len(bounds) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(part[bounds[:-1]].astype(np.int64)), pa.array(np.full(n, block.number, np.int64)), pa.array(lines, pa.binary()), _small_runs(counts, bounds)],
        ["part", "block", "keys", "counts"],
    )


def _word_totals(rows: pa.Table) -> pa.Table:
    """As ``_totals`` for words, which are compared as text; all that occur in training are kept, and in each range the number
    of distinct ones and of their occurrences goes with the first share."""
    rows = rows.sort_by("block")
    lists = [_lines(v.as_buffer()) for v in rows.column("keys")]
    coded = pa.concat_arrays(lists).dictionary_encode()
    out, total = _summed_shares(rows, coded.indices.to_numpy(zero_copy_only=False), [len(x) for x in lists], 1)
    first = [1] + [0] * (rows.num_rows - 1)
    for name, value in (("distinct", int((total > 0).sum())), ("occurrences", int(total.sum()))):
        out = out.append_column(name, pa.array([value * f for f in first], pa.int64()))
    return out


def _totals(rows: pa.Table) -> pa.Table:
    """For one range of keys, each share's sums over all blocks in the share's order, 0 below MIN_COUNT, and a bit for each key
    that is kept whether the share is that of the first block with it."""
    rows = rows.sort_by("block")
    keys = _key_runs(rows)
    return _summed_shares(rows, np.unique(np.concatenate(keys), return_inverse=True)[1], [len(k) for k in keys], MIN_COUNT)[0]


def _summed_shares(rows: pa.Table, at: np.ndarray, sizes: list[int], least: int) -> tuple[pa.Table, np.ndarray]:
    """``at`` numbers the distinct keys of all shares, one after the other; those with less than ``least`` get 0."""
    total = np.bincount(at, weights=np.concatenate([_whole_ints(v.as_buffer()) for v in rows.column("counts")])).astype(np.int64)
    total[total < least] = 0
    lead = np.zeros(len(at), bool)
    lead[_first(at, len(total))] = True
    lead &= total[at] > 0  # nothing is asked of keys that are not kept
    totals, leads = [], []
    for end, size in zip(np.cumsum(sizes), sizes):
        totals.append(_small_ints(total[at[end - size : end]]))
        leads.append(_small(np.packbits(lead[end - size : end])))
    table = pa.table({
        "part": rows.column("part"), "block": rows.column("block"), "totals": pa.array(totals, pa.binary()), "lead": pa.array(leads, pa.binary()),
    })
    return table, total


def _in_order(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The totals and first-block flags of a block's distinct keys, from its shares."""
    known = known.sort_by("part")
    totals, leads = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for t, lead in zip(known.column("totals"), known.column("lead")):
        totals.append(_whole_ints(t.as_buffer()).astype(np.int64))
        leads.append(np.unpackbits(_whole(lead.as_buffer(), np.uint8), count=len(totals[-1])).astype(bool))
    return np.concatenate(totals), np.concatenate(leads)


def _rows(known: pa.Table, kind: str) -> pa.Table:
    return known.filter(pc.equal(known.column("kind"), kind))


def _grouped(keys: np.ndarray, columns: list[np.ndarray], same: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys, sums of ``columns`` and the (common) values of ``same``."""
    distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, [*(np.bincount(at, weights=c, minlength=len(distinct)).astype(np.int64) for c in columns), *(s[first] for s in same)]


def _loaded(row: pa.Table, known: pa.Table) -> tuple[_Block, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block with its pairs and triples: counts of words, first-block flags of pairs, counts and flags of triples."""
    block = _Block(row)
    block.find_pairs()
    totals, pair_lead = _in_order(_rows(known, "pair"))
    block.with_pairs(totals)
    return block, block.word_totals(_rows(known, "word")), pair_lead, *_in_order(_rows(known, "triple"))


def _context_sums(block: _Block, words: np.ndarray, pair_lead: np.ndarray, triples: np.ndarray, triple_lead: np.ndarray, n_tokens: int):
    """Context keys with sums over the arcs that are counted here: what they hold, what the shorter context gives the same
    words, their number; the context's count, and what the shorter one's weights are shares of."""
    codes, kept = block.codes, block.pair_total
    mine = np.flatnonzero(pair_lead & (kept >= MIN_COUNT))
    ends = block.pair_ends[block.pair_first[mine]]
    context = codes[ends - 1]
    pairs = block.word_keys[context], kept[mine], words[codes[ends]], words[context], np.full(len(mine), n_tokens)
    mine = np.flatnonzero(triple_lead & (triples >= MIN_COUNT))
    ends = block.triple_ends[block.triple_first[mine]]
    before = block.pair_at[ends - 1]
    three = block.pair_keys[before], triples[mine], kept[block.pair_at[ends]], kept[before], words[codes[ends - 1]]
    key, own, below, count, shorter = (np.concatenate(x) for x in zip(pairs, three))
    return _grouped(key, [own, below, np.ones(len(key))], [count, shorter])


def _failures(rows: pa.Table) -> pa.Table:
    """Failure weights (log10) of the contexts of one range; each block's request in its order, NaN for contexts without arcs."""
    asks = pc.is_valid(rows.column("block"))
    sums, requests = rows.filter(pc.invert(asks)), rows.filter(asks)
    names = ("own", "below", "arcs", "context", "shorter")
    key = np.concatenate([np.zeros(0, np.uint64), *_key_runs(sums)])
    columns = [np.concatenate([np.zeros(0, np.int64), *(_whole_ints(v.as_buffer()).astype(np.int64) for v in sums.column(c))]) for c in names]
    distinct, (own, below, arcs, context, shorter) = _grouped(key, columns[:3], columns[3:])
    left = [np.maximum(_LEAST, 1 - (x - DISCOUNT * arcs) / of) for x, of in ((own, context), (below, shorter))]
    weight = np.append(np.log10(left[0] / left[1]), np.nan).astype(np.float32)
    out = []
    for asked in _key_runs(requests):
        at = np.minimum(np.searchsorted(distinct, asked), max(len(distinct) - 1, 0))
        found = distinct[at] == asked if len(distinct) else np.zeros(len(asked), bool)
        out.append(_small(weight[np.where(found, at, len(distinct))]))
    return pa.table({"part": requests.column("part"), "block": requests.column("block"), "weights": pa.array(out, pa.binary())})


class Automaton:
    """States 0 (root) to n - 1, sorted arcs ``state * n_words + word``, and a failure arc for each state but the root."""

    def __init__(self, block: _Block, words: np.ndarray, triples: np.ndarray, weights: np.ndarray, root: np.ndarray):
        _, word_at, pair_at = block.contexts(words, triples)
        weights = np.append(weights.astype(np.float64), np.nan)  # -1: no context
        word_weight, pair_weight = weights[word_at], weights[pair_at]
        self.n_words, self.root = len(words), root
        is_word, is_pair = ~np.isnan(word_weight), ~np.isnan(pair_weight)
        # pairs with arcs here are states whether asked for or not; their failure arcs are not taken
        with_arcs = block.pair_at[block.triple_ends[block.triple_first[triples >= MIN_COUNT]] - 1]
        is_pair[with_arcs] = True
        self.after = np.where(is_word, np.cumsum(is_word), 0)  # by word: the state after it at the root
        pair_state = np.where(is_pair, is_word.sum() + np.cumsum(is_pair), 0)
        pair_end = block.pair_ends[block.pair_first]
        first, last = block.codes[pair_end - 1], block.codes[pair_end]
        # the longest context at the end of a pair
        behind = np.where(is_pair, pair_state, self.after[last]) if len(last) else pair_state
        self.failure = np.nan_to_num(np.concatenate(([0.0], word_weight[is_word], pair_weight[is_pair])))
        self.shorter = np.concatenate((np.zeros(1 + is_word.sum(), np.int64), self.after[last[is_pair]]))
        two = np.flatnonzero(block.pair_total >= MIN_COUNT)
        three = np.flatnonzero(triples >= MIN_COUNT)
        end = block.triple_ends[block.triple_first[three]]
        before = block.pair_at[end - 1]
        arcs = np.concatenate((self.after[first[two]] * self.n_words + last[two], pair_state[before] * self.n_words + block.codes[end]))
        weight = np.concatenate((np.log10((block.pair_total[two] - DISCOUNT) / words[first[two]]), np.log10((triples[three] - DISCOUNT) / block.pair_total[before])))
        to = np.concatenate((behind[two], behind[block.pair_at[end]]))
        order = np.argsort(arcs)
        self.arcs, self.weight, self.to = arcs[order], weight[order], to[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next states, weights, and whether the root's arc was taken, of many readers at once."""
        to, total, at_root = np.zeros(len(state), np.int64), np.zeros(len(state)), np.zeros(len(state), bool)
        left = np.arange(len(state))
        while len(left):
            here, w = state[left], word[left]
            arc = here * self.n_words + w
            at = np.minimum(np.searchsorted(self.arcs, arc), max(len(self.arcs) - 1, 0))
            found = self.arcs[at] == arc if len(self.arcs) else np.zeros(len(left), bool)
            found &= here > 0
            total[left[found]] += self.weight[at[found]]
            to[left[found]] = self.to[at[found]]
            rooted = here == 0
            total[left[rooted]] += self.root[w[rooted]]
            to[left[rooted]] = self.after[w[rooted]]
            at_root[left[rooted]] = True
            on = ~found & ~rooted
            total[left[on]] += self.failure[here[on]]
            state = state.copy()
            state[left[on]] = self.shorter[here[on]]
            left = left[on]
        return to, total, at_root

    def read(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each text and the number of its tokens that took the root's arc.

        All texts are read side by side. A long one is read in segments: as the state is told by the last ORDER - 1 words, a
        segment that begins with those before it, unweighted, is in the state in which the one before it ends.
        """
        size = np.diff(bounds)
        parts = -(-size // _SEGMENT)
        text = np.repeat(np.arange(len(size)), parts)
        start = ragged(np.zeros(len(size), np.int64), parts) * _SEGMENT + bounds[text]
        end = np.minimum(start + _SEGMENT, bounds[text + 1])
        place = np.maximum(start - (ORDER - 1), bounds[text])
        state, weights, at_root = np.zeros(len(text), np.int64), np.zeros(len(text)), np.zeros(len(text), np.int64)
        live = np.flatnonzero(place < end)
        while len(live):
            to, weight, rooted = self.step(state[live], codes[place[live]])
            state[live] = to
            counted = place[live] >= start[live]
            weights[live[counted]] += weight[counted]
            at_root[live[counted]] += rooted[counted]
            place[live] += 1
            live = live[place[live] < end[live]]
        return np.bincount(text, weights=weights, minlength=len(size)), np.bincount(text, weights=at_root, minlength=len(size)).astype(np.int64)


def lm_scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_at_root``.

    ``held_out`` is a boolean column expression; NULL counts as false. A token is a word (A-Z lower-cased) or the end of the
    text. ``base_score`` is the add-one unigram log10 probability with one class for all unknown words, ``score`` the
    automaton's, in which unknown words share the mass taken off single words; ``n_at_root`` is the number of tokens that were
    read without a context. NULL and empty texts are one end token. Equal rows give equal rows; other columns are not read.
    Without any training text every token is unknown, at log10(1 / 1).
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = materialise(base.mapInArrow(_coded, f"block long, doc_id array<{kind}>, held binary, bounds binary, codes binary, words binary, n long"), "lm-blocks")
    ranges = n_ranges(spark, blocks.agg(F.sum("n")).first()[0] or 0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _word_share(batch.slice(i, 1), ranges)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.slice(i, 1))
                block.find_pairs()
                yield from _share(block.number, block.pair_keys, block.pair_counts(), ranges).combine_chunks().to_batches()

    counted = blocks.mapInArrow(words, _SHARE).groupBy("part").applyInArrow(_word_totals, f"{_TOTAL}, distinct long, occurrences long")
    counted = materialise(counted, "lm-words")
    n_words, n_tokens = counted.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("occurrences"), F.lit(0))).first()

    def triples(row: pa.Table, known: pa.Table) -> pa.Table:
        if not row.num_rows:
            return _share(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), ranges)
        block = _Block(row)
        block.find_pairs()
        block.with_pairs(_in_order(known)[0])
        return _share(block.number, block.triple_keys, block.triple_counts(), ranges)

    by_block = blocks.groupBy("block")
    kept_pairs = materialise(blocks.mapInArrow(pairs, _SHARE).groupBy("part").applyInArrow(_totals, _TOTAL), "lm-pairs")
    shares = by_block.cogroup(kept_pairs.groupBy("block")).applyInArrow(triples, _SHARE)
    kept_triples = materialise(shares.groupBy("part").applyInArrow(_totals, _TOTAL), "lm-triples")

    none = {c: F.lit(None).cast(t) for c, t in (("part", "long"), ("totals", "binary"), ("lead", "binary"), ("weights", "binary"))}

    def as_known(kind: str, frame: DataFrame, *columns: str) -> DataFrame:
        return frame.select(F.lit(kind).alias("kind"), "block", *[F.col(c) if c in columns else none[c].alias(c) for c in none])

    parts = [as_known(label, frame, "part", "totals", "lead") for label, frame in (("word", counted), ("pair", kept_pairs), ("triple", kept_triples))]
    known = reduce(DataFrame.unionAll, parts)

    def contexts(row: pa.Table, known: pa.Table) -> pa.Table:
        """What the block adds to the sums of contexts, and (rows with a block) the contexts whose weights it asks for."""
        names = ["own", "below", "arcs", "context", "shorter"]
        if row.num_rows:
            block, words, *rest = _loaded(row, known)
            keys, columns = _context_sums(block, words, *rest, n_tokens)
            asked, _, _ = block.contexts(words, rest[1])
        else:
            keys = asked = np.zeros(0, np.uint64)
            columns = [np.zeros(0, np.int64)] * 5
        part, asked_part = range_of(keys, ranges), range_of(asked, ranges)
        bounds, asked_bounds = run_bounds(part), run_bounds(asked_part)
        n, m = len(bounds) - 1, len(asked_bounds) - 1
        empty = pa.nulls(m, pa.binary())
        return pa.table({
            "part": pa.array(np.concatenate((part[bounds[:-1]], asked_part[asked_bounds[:-1]])).astype(np.int64)),
            "block": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([block.number] * m if m else [], pa.int64())]),
            "keys": pa.concat_arrays([_small_runs(keys, bounds, _small_keys), _small_runs(asked, asked_bounds, _small_keys)]),
            **{name: pa.concat_arrays([_small_runs(c, bounds), empty]) for name, c in zip(names, columns)},
        })

    sums = by_block.cogroup(known.groupBy("block")).applyInArrow(
        contexts, "part long, block long, keys binary, own binary, below binary, arcs binary, context binary, shorter binary"
    )
    failure = materialise(sums.groupBy("part").applyInArrow(_failures, "part long, block long, weights binary"), "lm-failure")

    def score(row: pa.Table, known: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_at_root"]
        if not row.num_rows:
            kinds = [row.schema.field("doc_id").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
            return pa.table([pa.array([], t) for t in kinds], names=names)
        block, words, _, triples, _ = _loaded(row, known)
        weights = [_whole(w.as_buffer(), np.float32) for w in _rows(known, "failure").sort_by("part").column("weights")]
        left_over = DISCOUNT * n_words
        root = np.log10(np.where(words > 0, np.maximum(words - DISCOUNT, 0.1), max(left_over, 1e-9)) / n_tokens) if n_tokens else np.zeros(len(words))
        automaton = Automaton(block, words, triples, np.concatenate([np.zeros(0, np.float32), *weights]), root)
        found, at_root = automaton.read(block.codes, block.bounds)
        n, base_weight = len(block.held), np.log10((words + 1) / (n_tokens + n_words + 1))
        known_word = np.bincount(block.row, weights=words[block.codes] > 0, minlength=n).astype(np.int64)
        base = np.bincount(block.row, weights=base_weight[block.codes], minlength=n)
        out = [block.doc_ids, pa.array(block.held), pa.array(np.diff(block.bounds)), pa.array(known_word), pa.array(base), pa.array(found), pa.array(at_root)]
        return pa.table(out, names=names)

    known = known.unionAll(as_known("failure", failure, "part", "weights"))
    scored = by_block.cogroup(known.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_at_root long"
    )
    total = F.lit(n_tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", total, "base_score", "score", "n_at_root")
