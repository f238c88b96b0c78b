"""Benchmark passages in documents, up to an edit budget.

The q-gram lemma: a passage of m bytes found with at most e edits keeps m - q + 1 - q * e of its q-grams, on diagonals
(position in the text less position in the passage) that spread over at most e. So shared q-grams are counted in bands of
diagonals that overlap by half; only bands that reach the bound are aligned, within the band. Passages too short for a budget
are sought as they are, between word boundaries, all at once by an Aho-Corasick automaton. All over bytes, A-Z lower-cased,
runs of white space as one blank. The passages are the stated query set: every document is read against all of them, in
blocks of bounded size.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.texts import filled, ragged, slices, text_bytes

Q = 8
#: Edits allowed per byte of a passage, as far as the lemma leaves a positive bound.
EDIT_RATE = 0.05
#: Shorter passages have no edit budget: with one, so few characters are found by chance.
MIN_PASSAGE = 40
#: Bytes of passages in one block, which a task holds with its index.
BLOCK_BYTES = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Index(NamedTuple):
    ids: list
    passages: list  # folded bytes
    grams: np.ndarray  # sorted distinct q-grams
    first: np.ndarray  # bounds of each q-gram's places
    item: np.ndarray
    place: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    present: np.ndarray  # by hash: whether a q-gram may be in ``grams``
    shift: np.uint64
    window: int  # the region of every match has a window of so many positions
    dense: int  # with so many q-grams of the index
    reach: int  # the longest region
    short: object  # automaton of the passages without a budget, or None; its values are places in ``short_ids``
    short_ids: list[list]  # the ids of each distinct one


def _grams(raw: np.ndarray) -> np.ndarray:
    """The q bytes at each position as one integer."""
    if len(raw) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(raw) - Q + 1,), dtype="<u8", buffer=np.ascontiguousarray(raw).data, strides=(1,))


def _collapsed(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with runs of blanks as one, none at the begin of a text; bounds, and where each byte was."""
    folded = _FOLD[raw]
    blank = folded == 32
    after = np.concatenate(([True], blank[:-1])) if len(blank) else blank
    after[bounds[:-1][bounds[:-1] < len(raw)]] = True
    kept = np.flatnonzero(~(blank & after))
    return folded[kept], np.searchsorted(kept, bounds), kept


def _passage(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    folded = _collapsed(raw, np.array([0, len(raw)]))[0]
    return folded[:-1] if len(folded) and folded[-1] == 32 else folded


def build_index(rows: list[tuple]) -> Index:
    """An index of ``(item_id, text)`` rows; NULL and blank passages are left out."""
    import ahocorasick

    every = [(i, p) for i, p in ((i, _passage(t)) for i, t in rows if t) if len(p)]
    short: dict[str, list] = {}
    for i, p in every:
        if len(p) < MIN_PASSAGE:
            short.setdefault(p.tobytes().decode("latin-1"), []).append(i)
    automaton = ahocorasick.Automaton()
    for k, text in enumerate(short):
        automaton.add_word(text, (k, len(text)))
    automaton.make_automaton()
    kept = [(i, p) for i, p in every if len(p) >= MIN_PASSAGE]
    size = np.array([len(p) for _, p in kept], np.int64)
    edits = np.minimum((size * EDIT_RATE).astype(np.int64), (size - Q) // Q)
    codes = [_grams(p).copy() for _, p in kept]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(kept)), [len(c) for c in codes]) if codes else np.zeros(0, np.int64)
    place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    bits = max(16, int(np.ceil(np.log2(max(1, len(grams)) * 16))))
    shift = np.uint64(64 - bits)
    present = np.zeros(1 << bits, bool)
    present[(grams * _SPREAD) >> shift] = True
    bound, region = size - Q + 1 - Q * edits, size + edits
    window = int(region.min(initial=1 << 20))
    # a region cut into windows has its share of the bound in one of them
    dense = int((-(-bound // -(-region // window))).min(initial=1 << 20))
    return Index(
        [i for i, _ in kept], [p for _, p in kept], grams, np.append(first, len(flat)), item[order], place[order], edits, bound,
        present, shift, window, dense, int(region.max(initial=0)), automaton if short else None, list(short.values()),
    )


def aligned(passage: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Edits, start and end of the best place for the whole ``passage`` in ``text`` on diagonals ``low`` to ``high``.

    Column k of the band is diagonal ``low + k``; a cell holds edits and start in one integer, so that a minimum takes the
    fewest edits and, of equally few, the leftmost start.
    """
    width = high - low + 1
    one, far = np.int64(1) << np.int64(32), np.int64(1) << np.int64(60)
    k = np.arange(width, dtype=np.int64)
    starts = low + k
    cell = np.where((starts >= 0) & (starts <= len(text)), starts, far)
    padded = np.full(len(passage) + width + max(0, -low) + 1, 256, np.int64)
    lo = max(0, low)
    piece = text[lo : lo + len(padded)]
    offset = max(0, -low)
    padded[offset : offset + len(piece)] = piece[: len(padded) - offset]
    for i, c in enumerate(passage):
        seen = padded[i : i + width]
        step = cell + np.where(seen == c, 0, one)
        step[seen == 256] = far  # outside the text
        step[:-1] = np.minimum(step[:-1], cell[1:] + one)  # a byte of the passage is missing in the text
        cell = np.minimum.accumulate(step - k * one) + k * one  # extra bytes in the text
        ends = starts + i + 1
        cell = np.where((ends >= 0) & (ends <= len(text)), cell, far)
    best = int(np.argmin(cell >> np.int64(32)))
    return int(cell[best] >> np.int64(32)), int(cell[best] & np.int64(0xFFFFFFFF)), int(low + best + len(passage))


def _inside_word(text: str, at: int) -> bool:
    """Whether the place before character ``at`` is within a word; bytes of other scripts count as letters."""
    return 0 < at < len(text) and all(c.isascii() and c.isalnum() or c > "\x7f" for c in text[at - 1 : at + 1])


def _find_short(raw: np.ndarray, bounds: np.ndarray, index: Index) -> list[tuple[int, object, int, int, int]]:
    """The first place of each short passage in each text."""
    out = []
    for t in range(len(bounds) - 1):
        text, seen = raw[bounds[t] : bounds[t + 1]].tobytes().decode("latin-1"), {}
        for last, (k, size) in index.short.iter(text):
            start, end = last + 1 - size, last + 1
            if k not in seen and not _inside_word(text, start) and not _inside_word(text, end):
                seen[k] = (start, end)
        out += [(t, i, 0, *place) for k, place in seen.items() for i in index.short_ids[k]]
    return out


def find_passages(raw: np.ndarray, bounds: np.ndarray, index: Index) -> list[tuple[int, object, int, int, int]]:
    """``(text, item_id, edits, start, end)`` for the best place of each item in each text within its budget."""
    folded, at, was = _collapsed(raw, bounds)
    found = [(t, index.ids[i], *rest) for t, i, *rest in _find_long(folded, at, index)]
    if index.short is not None:
        found += _find_short(folded, at, index)
    return [(t, i, edits, int(was[at[t] + start] - bounds[t]), int(was[at[t] + end - 1] + 1 - bounds[t])) for t, i, edits, start, end in found]


def _find_long(raw: np.ndarray, bounds: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """``(text, item, edits, start, end)`` of the items with a budget, over collapsed bytes."""
    if len(raw) < Q or not len(index.grams):
        return []
    codes = _grams(raw)
    hit = index.present[(codes * _SPREAD) >> index.shift]
    held = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
    last = np.minimum(np.arange(len(hit)) + index.window, len(hit))
    full = np.flatnonzero(held[last] - held[:-1] >= index.dense)
    if not len(full):
        return []
    edge = np.zeros(len(hit) + 1, np.int32)
    np.add.at(edge, np.maximum(full - index.reach, 0), 1)
    np.add.at(edge, np.minimum(full + index.window + index.reach, len(hit)), -1)
    at = np.flatnonzero(hit & (np.cumsum(edge[:-1]) > 0))
    found = np.searchsorted(index.grams, codes[at])
    real = index.grams[np.minimum(found, len(index.grams) - 1)] == codes[at]
    at, found = at[real], found[real]
    text = np.searchsorted(bounds, at, "right") - 1
    whole = at + Q <= bounds[text + 1]
    at, found, text = at[whole], found[whole], text[whole]
    n = index.first[found + 1] - index.first[found]
    one = ragged(index.first[found], n)
    item, text = index.item[one], np.repeat(text, n)
    # an item can be in a text only if the two share its bound of q-grams at all
    pair = text * len(index.ids) + item
    enough = np.bincount(pair, minlength=(len(bounds) - 1) * len(index.ids))[pair] >= index.bound[item] if len(bounds) * len(index.ids) < 5e7 else np.ones(len(pair), bool)
    item, text, pair = item[enough], text[enough], pair[enough]
    diagonal = np.repeat(at, n)[enough] - bounds[text] - index.place[one[enough]]
    half = index.edits[item] + 1
    best: dict[tuple[int, int], tuple] = {}
    for shifted in (0, 1):
        band = (diagonal + shifted * half) // (2 * half)
        order = np.lexsort((band, pair))
        p, b = pair[order], band[order]
        begin = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (b[1:] != b[:-1])))) if len(p) else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, len(p)))
        for g in np.flatnonzero(count >= index.bound[item[order[begin]]] if len(begin) else []):
            o = order[begin[g]]
            t, i = int(text[o]), int(item[o])
            e, half_i = int(index.edits[i]), int(half[o])
            if best.get((t, i), (e + 1,))[0] == 0:
                continue
            low = int(b[begin[g]]) * 2 * half_i - shifted * half_i
            got = aligned(index.passages[i], raw[bounds[t] : bounds[t + 1]], low - e, low + 2 * half_i + e)
            if got[0] <= e and got < best.get((t, i), (e + 1,)):
                best[t, i] = got
    return [(t, i, *got) for (t, i), got in sorted(best.items())]


def _blocks(passages: DataFrame, item_id: str, text: str) -> list[list[tuple]]:
    """The passages in blocks of about BLOCK_BYTES; one block at a time is on the driver."""
    total = passages.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    block = F.pmod(F.xxhash64(item_id, text), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in passages.where(block == k).select(item_id, text).collect()]


def benchmark_matches(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and passage found in it: ``doc_id, item_id, edits, start, end`` in code points.

    The best place is given: fewest edits, of those the first. NULL, empty and blank texts and passages match nothing; white
    space counts as one blank in both, passages below MIN_PASSAGE bytes have to stand there as they are, between word
    boundaries. Equal rows give equal rows; equal passages with several ids are found under
    each. Other columns are not read. Nothing in either table: no rows.
    """
    kind, item_kind = docs.schema[doc_id].dataType.simpleString(), passages.schema[item_id].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(item_kind)
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark, out = docs.sparkSession, None
    for rows in _blocks(passages, item_id, item_text):
        shared = spark.sparkContext.broadcast(build_index(rows))

        def find(batches, shared=shared):
            index = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    raw, bounds = text_bytes(filled(part.column("text")))
                    got = find_passages(raw, bounds, index)
                    lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80))) if got else None
                    t = [g[0] for g in got]
                    spans = [(lead[bounds[g[0]] + g[3]] - lead[bounds[g[0]]], lead[bounds[g[0]] + g[4]] - lead[bounds[g[0]]]) for g in got]
                    cols = [part.column("doc_id").take(pa.array(t, pa.int64())), pa.array([g[1] for g in got], arrow), pa.array([g[2] for g in got], pa.int64())]
                    cols += [pa.array([int(s[k]) for s in spans], pa.int64()) for k in (0, 1)]
                    yield pa.record_batch(cols, names=["doc_id", "item_id", "edits", "start", "end"])

        found = picked.mapInArrow(find, f"doc_id {kind}, item_id {item_kind.simpleString()}, edits long, start long, end long")
        out = found if out is None else out.unionAll(found)
    return out


def without_benchmark(docs: DataFrame, passages: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no passage (see ``benchmark_matches``) is found, all columns unchanged.

    Rows with NULL and empty texts stay, repeated rows stay or go together. No passages: all rows.
    """
    spark = docs.sparkSession
    for rows in _blocks(passages, item_id, item_text):
        shared = spark.sparkContext.broadcast(build_index(rows))

        def keep(batches, shared=shared):
            for batch in batches:
                texts = pa.record_batch([batch.column(batch.schema.names.index(text)).cast(pa.string())], names=["text"])
                at = 0
                for part in slices(texts, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[[g[0] for g in find_passages(*text_bytes(filled(part.column("text"))), shared.value)]] = False
                    yield batch.slice(at, part.num_rows).filter(pa.array(clean))
                    at += part.num_rows

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
