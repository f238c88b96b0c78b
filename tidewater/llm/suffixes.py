"""Bytes covered by strings of WIDTH bytes that start at two or more places of the corpus, and texts without them.

1. Every window of WIDTH bytes has an anchor: the k-gram in it with the least hash, of equal ones the leftmost. Equal windows
   have equal anchors at the same place, so windows can only repeat where anchors do. Windows that follow each other with one
   anchor are a segment; its bytes are its context (the windows and what they reach over).
2. Anchors that occur once are done. Segments whose whole context occurs twice repeat in every window.
3. For the other contexts of a repeated anchor, one of each kind meets the others in one place, where their suffixes are
   sorted in two stages: those smaller than their successor directly, the rest induced by scans of the buckets. Adjacent
   suffixes with a common prefix of WIDTH bytes are repeated windows.
4. The verdicts go back to the blocks of documents, which find their anchors again and cut the bytes out.

An anchor in the text that many documents quote meets many different surroundings. Beyond HOT kinds of context its windows
are compared by two hashes each, in a grouped count, instead of in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.scratch import materialise
from tidewater.llm.texts import filled, mixed, ragged, text_bytes

WIDTH = 200
GRAM = 48
#: Bytes of contexts in one sorting task, on average.
SORT_BYTES = 4 << 20
#: Kinds of context of one anchor that are sorted in one task: as many as alone fill it.
HOT = SORT_BYTES // (2 * WIDTH)
#: Bytes that are worked on at once; positions in them fit the low bits of an anchor's key.
_PIECE = 1 << 20
_LOW = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = _PIECE + (1 << 20)
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, np.uint64(base), np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p))
    return _POWERS[0], _POWERS[1]


class Segments:
    """Segments of a run of texts: first window, number of windows, hashes of anchor and context."""

    def __init__(self, start, count, anchor, context):
        self.start, self.count, self.anchor, self.context = start, count, anchor, context

    @property
    def key(self) -> np.ndarray:
        return mixed(self.anchor ^ mixed(self.context))


def _sums(raw: np.ndarray) -> np.ndarray:
    up, _ = _powers()
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODES[raw] * up[: len(raw)])))


def _hash(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    _, down = _powers()
    return mixed((sums[start + length] - sums[start]) * down[start] + np.asarray(length).astype(np.uint64))


def _segments_of(raw: np.ndarray, bounds: np.ndarray) -> Segments:
    """Segments of texts that together fit one piece."""
    n = len(raw) - WIDTH + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return Segments(z, z, z.view(np.uint64), z.view(np.uint64))
    sums = _sums(raw)
    grams = _hash(sums, np.arange(len(raw) - GRAM + 1), GRAM)
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    # minimum over WIDTH - GRAM + 1 grams by doubling
    span, want = 1, WIDTH - GRAM + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < want:
        least = np.minimum(least[: len(least) - (want - span)], least[want - span :])
    at = (least[:n] & _LOW).astype(np.int64)
    valid = np.zeros(n, bool)
    size = np.diff(bounds)
    long = size >= WIDTH
    valid[ragged(bounds[:-1][long], size[long] - WIDTH + 1)] = True
    change = np.concatenate(([True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])))
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    keep = valid[first]
    first, count = first[keep], count[keep]
    return Segments(first, count, grams[at[first]], _hash(sums, first, count + WIDTH - 1) + (at[first] - first).astype(np.uint64))


def pieces_of(raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, Segments]]:
    """Runs of whole texts of about one piece, and pieces of longer texts that overlap by WIDTH - 1 bytes: the offset of the
    bytes, the bytes, their segments. Texts are cut by their own length only, so it is the same cut each time."""
    d, n = 0, len(bounds) - 1
    while d < n:
        if bounds[d + 1] - bounds[d] > _PIECE:
            for at in range(int(bounds[d]), int(bounds[d + 1]), _PIECE):
                some = raw[at : min(at + _PIECE + WIDTH - 1, int(bounds[d + 1]))]
                yield at, some, _segments_of(some, np.array([0, len(some)]))
            d += 1
            continue
        e = d + 1
        while e < n and bounds[e + 1] - bounds[d] <= _PIECE:
            e += 1
        some = raw[bounds[d] : bounds[e]]
        yield int(bounds[d]), some, _segments_of(some, bounds[d : e + 1] - bounds[d])
        d = e


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a byte array in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    # a suffix is smaller than its successor if its first byte that differs from the next byte is smaller
    differ = np.flatnonzero(text[:-1] != text[1:])
    small = np.zeros(n, bool)
    if len(differ):
        i = np.arange(int(differ[-1]) + 1)
        nxt = differ[np.searchsorted(differ, i)]
        small[: len(i)] = text[nxt] < text[nxt + 1]
    direct = _sort_directly(text, np.flatnonzero(small), depth)
    by_first = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))  # the last suffix comes first in its bucket
    out = []
    for c in range(256):
        larger = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        generation, bucket = larger, [larger]
        while len(generation):  # predecessors with the same byte join the bucket they are induced from
            before = generation[generation > 0] - 1
            generation = before[text[before] == c]
            bucket.append(generation)
        bucket.append(direct[by_first[c] : by_first[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[text[before] > c]
        if len(before):
            order = np.argsort(text[before], kind="stable")
            before = before[order]
            cut = np.flatnonzero(np.diff(text[before])) + 1
            for group in np.split(before, cut):
                waiting[text[group[0]]].append(group)
    return np.concatenate(out)


def _sort_directly(text: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes by their first ``depth`` bytes: eight bytes at a time, only where earlier ones tie."""
    padded = np.concatenate((text, np.zeros(depth + 16, np.uint8)))
    words = np.ndarray((len(text) + depth + 8,), dtype=">u8", buffer=padded.data, strides=(1,))
    sums = _sums(padded) if len(padded) < len(_powers()[0]) else None
    order = suffixes[np.argsort(words[suffixes].astype(np.uint64), kind="stable")]
    group = np.zeros(len(order), np.int64)  # first place of each suffix's group
    value = words[order].astype(np.uint64)
    fresh = np.concatenate(([True], value[1:] != value[:-1])) if len(order) else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)) if len(order) else group
    whole = _hash(sums, order, depth) if sums is not None and len(order) else None
    for at in range(8, depth, 8):
        size = np.bincount(group, minlength=len(order))[group] if len(order) else group
        open_ = size > 1
        if whole is not None and open_.any():
            # groups whose members agree to the full depth are done
            first = whole[group]
            mixed_up = np.zeros(len(order), bool)
            np.logical_or.at(mixed_up, group, whole != first)
            open_ &= mixed_up[group]
        live = np.flatnonzero(open_)
        if not len(live):
            break
        value = words[order[live] + at].astype(np.uint64)
        inner = np.lexsort((value, group[live]))
        order[live] = order[live][inner]
        if whole is not None:
            whole[live] = whole[live][inner]
        value, held = value[inner], group[live]
        fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (held[1:] != held[:-1])))
        group[live] = np.maximum.accumulate(np.where(fresh, live, 0))
    return order


def repeated_windows(text: np.ndarray, ok: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For each position, whether the ``width`` bytes from it start at another one, too; only positions in ``ok`` count."""
    order = suffix_array(text, width)
    order = order[ok[order]]
    out = np.zeros(len(text), bool)
    if len(order) < 2:
        return out
    words = np.ndarray((len(text) - 7,), dtype="<u8", buffer=np.ascontiguousarray(text).data, strides=(1,))
    # adjacent common prefixes, as far as the width
    same = np.arange(1, len(order))
    for at in [*range(0, width - 7, 8), width - 8]:
        same = same[words[order[same] + at] == words[order[same - 1] + at]]
    out[order[same]] = True
    out[order[same - 1]] = True
    return out


def _runs(flags: np.ndarray) -> list[int]:
    """Bounds of the runs of True: start, end, start, end."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).tolist()


def _context_rows(rows: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    for a, c, t in zip(rows.column("anchor").to_pylist(), rows.column("context").to_pylist(), rows.column("bytes").to_pylist()):
        yield a, c, t


def _blocked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    blocks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal runs removed) and ``kept`` (binary: what is left).

    A byte goes if it lies in a string of WIDTH bytes that also starts anywhere else, in the same text or another; strings do
    not cross texts. NULL and empty texts have no bytes; texts below WIDTH stay whole. Equal rows are two places. Other columns
    are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    blocked = _blocked(docs, doc_id, text)

    def anchors(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        raw, bounds = text_bytes(filled(rows.column("text").combine_chunks()))
        found = [(s.anchor, s.context) for _, _, s in pieces_of(raw, bounds)]
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
        c = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
        _, first, count = np.unique(mixed(a ^ mixed(c)), return_index=True, return_counts=True)
        return pa.table({"block": pa.array(np.full(len(first), key[0].as_py(), np.int32)), "anchor": pa.array(a[first].view(np.int64)), "context": pa.array(c[first].view(np.int64)), "twice": pa.array(count > 1)})

    # one row per block and kind of context, however often it occurs there
    table = materialise(blocked.groupBy("block").applyInArrow(anchors, "block int, anchor long, context long, twice boolean"), "repeat-anchors")
    live = table.groupBy("anchor").agg(F.count("*").alias("n"), F.max("twice").alias("t")).where((F.col("n") > 1) | F.col("t")).select("anchor")
    places = materialise(table.join(live, "anchor"), "repeat-places")
    kinds = places.groupBy("anchor", "context").agg(((F.count("*") > 1) | F.max("twice")).alias("whole"), F.min("block").alias("block"))
    kinds = materialise(kinds, "repeat-kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    needed = kinds.join(several, "anchor")

    def contexts(key: tuple[pa.Scalar, ...], rows: pa.Table, wanted: pa.Table) -> pa.Table:
        names = ["anchor", "context", "whole", "kinds", "bytes"]
        out: dict[str, list] = {n: [] for n in names}
        if rows.num_rows and wanted.num_rows:
            raw, bounds = text_bytes(filled(rows.column("text").combine_chunks()))
            a, c = (wanted.column(x).to_numpy().view(np.uint64) for x in ("anchor", "context"))
            keys = mixed(a ^ mixed(c))
            order = np.argsort(keys)
            open_ = np.ones(len(keys), bool)
            whole, n_kinds = wanted.column("whole").to_pylist(), wanted.column("kinds").to_pylist()
            for _, some, s in pieces_of(raw, bounds):
                mine = s.key
                at = np.minimum(np.searchsorted(keys[order], mine), len(keys) - 1)
                for i in np.flatnonzero(keys[order][at] == mine):
                    w = order[at[i]]
                    if open_[w]:
                        open_[w] = False
                        bytes_ = some[s.start[i] : s.start[i] + s.count[i] + WIDTH - 1].tobytes()
                        for n, v in zip(names, (int(a[w].view(np.int64)), int(c[w].view(np.int64)), whole[w], n_kinds[w], bytes_)):
                            out[n].append(v)
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
        return pa.table({n: pa.array(out[n], t) for n, t in zip(names, types)})

    schema = "anchor long, context long, whole boolean, kinds long, bytes binary"
    found = materialise(blocked.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(contexts, schema), "repeat-contexts")
    size = found.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // SORT_BYTES) + 1)

    def sort(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        texts = rows.column("bytes").combine_chunks().cast(pa.large_binary())
        texts = texts.take(pa.array(np.arange(len(texts))))
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[: bounds[-1]]
        ok = np.zeros(len(raw), bool)
        ok[ragged(bounds[:-1], np.diff(bounds) - WIDTH + 1)] = True
        flags = repeated_windows(raw, ok)
        runs = [_runs(flags[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
        hit = np.array([bool(r) for r in runs], bool) & ~rows.column("whole").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        picked = rows.select(["anchor", "context"]).filter(pa.array(hit))
        return picked.append_column("runs", pa.array([r for r, h in zip(runs, hit) if h], pa.list_(pa.int32())))

    def windows(batches):
        for batch in batches:
            for a, c, t in _context_rows(batch):
                raw = np.frombuffer(t, np.uint8)
                n = len(raw) - WIDTH + 1
                sums = _sums(raw)
                h = _hash(sums, np.arange(n), WIDTH)
                # the second hash of a window is its anchor with the window's place before it
                yield pa.record_batch([pa.array(np.full(n, a)), pa.array(np.full(n, c)), pa.array(np.arange(n, dtype=np.int32)), pa.array(h.view(np.int64))], names=["anchor", "context", "place", "window"])

    with_bucket = found.where(F.col("kinds") <= HOT).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    sorted_ = with_bucket.groupBy("bucket").applyInArrow(sort, "anchor long, context long, runs array<int>")
    each = found.where(F.col("kinds") > HOT).mapInArrow(windows, "anchor long, context long, place int, window long")
    again = each.groupBy("anchor", "window").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "window")
    hit = each.join(again, ["anchor", "window"])
    runs = hit.groupBy("anchor", "context").agg(F.flatten(F.transform(F.collect_list("place"), lambda p: F.array(p, p + 1))).alias("runs"))
    partial = materialise(sorted_.unionAll(runs), "repeat-runs")
    none = F.array().cast("array<int>")
    verdicts = kinds.select("anchor", "context", "whole").join(partial, ["anchor", "context"], "left").where(F.col("whole") | F.col("runs").isNotNull())
    verdicts = verdicts.select("anchor", "context", F.when(F.col("whole"), none).otherwise(F.coalesce("runs", none)).alias("runs"))
    told = materialise(places.select("block", "anchor", "context").join(verdicts, ["anchor", "context"]), "repeat-verdicts")

    def cut(key: tuple[pa.Scalar, ...], rows: pa.Table, verdict: pa.Table) -> pa.Table:
        n = rows.num_rows
        raw, bounds = text_bytes(filled(rows.column("text").combine_chunks())) if n else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        edge = np.zeros(len(raw) + 1, np.int32)
        if n and verdict.num_rows:
            a, c = (verdict.column(x).to_numpy().view(np.uint64) for x in ("anchor", "context"))
            keys = mixed(a ^ mixed(c))
            order = np.argsort(keys)
            keys = keys[order]
            lists = verdict.column("runs").combine_chunks()
            flat, at_list = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
            at_list = at_list - at_list[0]
            for at, _, s in pieces_of(raw, bounds):
                mine = s.key
                k = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                i = np.flatnonzero(keys[k] == mine)
                v = order[k[i]]
                length = np.diff(at_list)[v]
                full = i[length == 0]
                np.add.at(edge, at + s.start[full], 1)
                np.add.at(edge, at + s.start[full] + s.count[full] + WIDTH - 1, -1)
                part, v = i[length > 0], v[length > 0]
                if len(part):
                    length = length[length > 0]
                    pos = flat[ragged(at_list[v], length)] + np.repeat(at + s.start[part], length)
                    np.add.at(edge, pos[0::2], 1)
                    np.add.at(edge, pos[1::2] + WIDTH - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        start = gone & np.concatenate(([True], ~gone[:-1])) if len(gone) else gone
        first = bounds[:-1][np.diff(bounds) > 0]
        start[first] = gone[first]  # a run does not go on from one text into the next
        before = np.concatenate(([0], np.cumsum(gone)))
        starts = np.concatenate(([0], np.cumsum(start)))
        kept = [raw[x:y][~gone[x:y]].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
        return pa.table({
            "doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(bounds)), "n_removed": pa.array(np.diff(before[bounds])),
            "n_spans": pa.array(np.diff(starts[bounds])), "kept": pa.array(kept, pa.binary()),
        })

    return blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
