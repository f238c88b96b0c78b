"""Encoding and decoding with a SentencePiece vocabulary by best path (max-plus) segmentation.

Each piece has an integer weight, so sums are exact in any order. A text is blanks turned into "▁" with one in front; its
best segmentation has the greatest sum, and where two tie, the longer last piece. A character without a piece of its own
becomes its UTF-8 bytes. With a unigram vocabulary the weights are its scores; a BPE vocabulary stores ranks only, whose
logarithm stands in (Zipf), so its ids are those of a unigram model over its pieces, not of its merges.

Pieces have "▁" only in front, so a text falls into independent units at each "▁" after another character; equal units of a
batch are solved once. Documents over CHUNK characters are cut into chunks instead, wherever that falls:

1. every chunk gives a matrix: best sum by characters already taken at its start and taken beyond its end;
2. matrices combine associatively (max-plus) in a scan, which yields the best sums at every boundary;
3. with them each chunk finds by itself from which start state the best path to each end state comes;
4. these maps compose from the last chunk back, and each chunk traces its own pieces.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.texts import filled, give_back, ragged, slices
from tidewater.llm.scratch import materialise

CHUNK = 4096
#: Longer documents are cut into chunks.
GIANT = 65_536
#: Weight units per unit of logarithm: sums stay exact in 32-bit floats too, which the tests compare with.
SCALE = 64
BLANK = "▁"
_NONE = -(1 << 40)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPREADS = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_BITS = 18


class Vocabulary(NamedTuple):
    weights: np.ndarray  # by piece id
    longest: int
    unknown: int  # weight of a character without a piece
    byte_ids: np.ndarray  # piece id of each byte
    tables: list  # (keys, ids) by hash, one after the other for pieces that collide
    piece_bytes: np.ndarray  # of all pieces together, for decoding
    piece_bounds: np.ndarray


_LOADED: dict[str, Vocabulary] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(_BASE), -1, 1 << 64)
    up = np.full(n + 1, _BASE, np.uint64)
    down = np.full(n + 1, np.uint64(inverse), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class _Keys:
    """Keys of the substrings of a flat array of code points."""

    def __init__(self, points: np.ndarray):
        up, self.down = _powers(len(points))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(7)) * up[: len(points)])))

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start] + np.uint64(length)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def piece_weights(path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces, integer weights, and which ids can be chosen (no control, unknown or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    usable = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)])
    scores = np.array([model.get_score(i) for i in range(n)])
    # ranks are integers, log probabilities are not
    if np.array_equal(scores, np.round(scores)):
        weights = -np.round(SCALE * np.log(np.clip(-scores, 0, n) + 2)).astype(np.int64)
    else:
        weights = np.round(SCALE * scores).astype(np.int64)
    return pieces, weights, usable


def vocabulary_at(path: str) -> Vocabulary:
    """The vocabulary of a model file, loaded once per worker process."""
    if path in _LOADED:
        return _LOADED[path]
    pieces, weights, usable = piece_weights(path)
    byte_ids = np.full(256, -1)
    for i, p in enumerate(pieces):
        if len(p) == 6 and p.startswith("<0x"):
            byte_ids[int(p[3:5], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no piece for some byte")
    chosen = np.flatnonzero(usable)
    if any(BLANK in pieces[i].lstrip(BLANK) for i in chosen):
        raise ValueError("a piece has a blank after another character")
    flat = _points("".join(pieces[i] for i in chosen))
    size = np.array([len(pieces[i]) for i in chosen])
    start = np.cumsum(size) - size
    of = _Keys(flat)
    keys = np.zeros(len(chosen), np.uint64)
    for length in np.unique(size):
        keys[size == length] = of.of(start[size == length], int(length))
    tables, rest = [], np.arange(len(chosen))
    for spread in _SPREADS:
        slot = (keys[rest] * spread) >> np.uint64(64 - _BITS)
        first = np.unique(slot, return_index=True)[1]
        held, ids = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, -1, np.int32)
        held[slot[first]], ids[slot[first]] = keys[rest[first]], chosen[rest[first]]
        tables.append((spread, held, ids))
        rest = np.delete(rest, first)
        if not len(rest):
            break
    if len(rest):
        raise ValueError("the vocabulary is too large for its table")
    is_byte = np.zeros(len(pieces), bool)
    is_byte[byte_ids] = True
    raw = [bytes([int(p[3:5], 16)]) if is_byte[i] else p.replace(BLANK, " ").encode() if usable[i] else b"" for i, p in enumerate(pieces)]
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    unknown = int(weights[chosen].min()) - 10 * SCALE
    _LOADED[path] = Vocabulary(weights, int(size.max()), unknown, byte_ids, tables, np.frombuffer(b"".join(raw), np.uint8), bounds)
    return _LOADED[path]


def _lookup(v: Vocabulary, keys: np.ndarray) -> np.ndarray:
    """Piece ids of the keys, -1 for none."""
    out = np.full(len(keys), -1, np.int32)
    left = np.arange(len(keys))
    for spread, held, ids in v.tables:
        slot = (keys[left] * spread) >> np.uint64(64 - _BITS)
        found = ids[slot]
        same = held[slot] == keys[left]
        out[left[same]] = found[same]
        left = left[~same & (found >= 0)]  # an empty slot ends the search
        if not len(left):
            break
    return out


def _arcs(v: Vocabulary, points: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Piece ids by start and length less one; ``room`` is how many characters may be used from each start. -1: none,
    -2: an unknown character."""
    keys = _Keys(points)
    out = np.full((len(points), v.longest), -1, np.int32)
    for length in range(1, v.longest + 1):
        start = np.flatnonzero(room >= length)
        out[start, length - 1] = _lookup(v, keys.of(start, length))
    out[(out[:, 0] < 0) & (room >= 1), 0] = -2
    return out


def _weights(v: Vocabulary, arcs: np.ndarray) -> np.ndarray:
    w = v.weights[np.maximum(arcs, 0)]
    w[arcs == -1] = _NONE
    w[arcs == -2] = v.unknown
    return w


def _expand(v: Vocabulary, ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters (-2, with their code point) as byte pieces; ids and how many each became."""
    unknown = np.flatnonzero(ids == -2)
    n = np.ones(len(ids), np.int64)
    if not len(unknown):
        return ids, n
    cp = points[unknown]
    n[unknown] = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
    out = np.repeat(ids, n)
    at = np.cumsum(n) - n
    one = cp < 128
    out[at[unknown[one]]] = v.byte_ids[cp[one]]
    for u, c in zip(unknown[~one], cp[~one]):
        out[at[u] : at[u] + n[u]] = v.byte_ids[list(chr(c).encode())]
    return out, n


def solve_units(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Best segmentation of each unit: ids one after the other, and the number of each."""
    size = np.array([len(u) for u in units], np.int64)
    points = _points("".join(units))
    first = np.cumsum(size) - size
    room = np.repeat(first + size, size) - np.arange(len(points))
    counts, per_bucket = np.zeros(len(units), np.int64), []
    # units of about one length together: padding stays below a factor of two
    bucket = np.ceil(np.log2(np.maximum(size, 8))).astype(int)
    for b in np.unique(bucket[size > 0]):
        members = np.flatnonzero((bucket == b) & (size > 0))
        for part in np.array_split(members, max(1, int(size[members].sum() >> 17))):
            part = part[np.argsort(-size[part], kind="stable")]
            n, most = size[part], int(size[part].max())
            at = ragged(first[part], n)
            arcs = _arcs(v, points[at], room[at])
            weights = _weights(v, arcs)
            begin = np.cumsum(n) - n
            best = np.full((len(part), most + 1), _NONE, np.int64)
            best[:, 0] = 0
            back = np.zeros((len(part), most + 1), np.int8)
            for j in range(1, most + 1):
                live = int(np.searchsorted(-n, -j, "right"))
                top, arg = np.full(live, 2 * _NONE, np.int64), np.zeros(live, np.int8)
                for length in range(min(j, v.longest), 0, -1):  # the longer piece keeps a tie
                    value = best[:live, j - length] + weights[begin[:live] + j - length, length - 1]
                    more = value > top
                    top[more], arg[more] = value[more], length
                best[:live, j], back[:live, j] = top, arg
            pos, rows, steps = n.copy(), np.arange(len(part)), []
            while len(rows):
                length = back[rows, pos[rows]].astype(np.int64)
                pos[rows] -= length
                steps.append((rows, begin[rows] + pos[rows], length))
                rows = rows[pos[rows] > 0]
            row = np.concatenate([s[0] for s in steps])
            start = np.concatenate([s[1] for s in steps])
            ids = arcs[start, np.concatenate([s[2] for s in steps]) - 1]
            order = np.argsort(start, kind="stable")
            ids, n_ids = _expand(v, ids[order], points[at][start[order]])
            counts[part] = np.bincount(row[order], weights=n_ids, minlength=len(part)).astype(np.int64)
            per_bucket.append((part, ids))
    out = np.zeros(int(counts.sum()), np.int32)
    base = np.cumsum(counts) - counts
    for part, ids in per_bucket:
        out[ragged(base[part], counts[part])] = ids
    return out, counts


def encode_small(v: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and their bounds; every distinct unit is solved once."""
    odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, BLANK)))
    split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
    coded = split.flatten().dictionary_encode()
    bounds = np.asarray(split.offsets).astype(np.int64)
    codes, n_units = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds)
    units = [BLANK + u for u in coded.dictionary.to_pylist()]
    slow = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    own: dict[int, list[int]] = {}
    if len(slow):  # runs of blanks stay with the word behind them
        import re

        seen: dict[str, int] = {}
        for t in slow:
            norm = BLANK + texts[int(t)].as_py().replace(" ", BLANK)
            own[int(t)] = [seen.setdefault(u, len(units) + len(seen)) for u in re.findall(f"{BLANK}+[^{BLANK}]*", norm)]
        units += list(seen)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(bool)
    lists = []
    if own or empty.any():
        for t in range(len(texts)):
            lists.append(np.array(own[t], np.int64) if t in own else codes[:0] if empty[t] else codes[bounds[t] - bounds[0] : bounds[t + 1] - bounds[0]])
        codes, n_units = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
    ids, counts = solve_units(v, units)
    starts = np.cumsum(counts) - counts
    flat = ids[ragged(starts[codes], counts[codes])] if len(codes) else ids[:0]
    before = np.concatenate(([0], np.cumsum(counts[codes])))
    return flat, before[np.concatenate(([0], np.cumsum(n_units)))]


def decode_texts(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The texts of the id lists; bytes that form no character become U+FFFD."""
    size = np.diff(v.piece_bounds)[ids]
    raw = v.piece_bytes[ragged(v.piece_bounds[ids], size)].tobytes() if len(ids) else b""
    ends = np.concatenate(([0], np.cumsum(size)))[bounds]
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def _run(v: Vocabulary, texts: list[str], own: np.ndarray, entry: np.ndarray | None):
    """Dynamic programs over chunks, side by side: ``own[c]`` characters, then those a last piece may take.

    Without ``entry``: for every start state apart, so the chunk's matrix. With the best sums by start state (one row per
    chunk): the sums by end state, the back pointers and the arcs, all equal to those of one program over the whole document.
    """
    s, k, most = v.longest, len(texts), int(own.max())
    # by end: cell [j, c, L - 1] is the piece of length L that ends before position j of chunk c
    ends = np.full((most + s, k, s), _NONE, np.int64)
    all_arcs = []
    for c, text in enumerate(texts):
        points = _points(text)
        n = min(len(points), int(own[c]) + s - 1)
        arcs = _arcs(v, points[:n], n - np.arange(n))
        weights = _weights(v, arcs)
        weights[own[c] :] = _NONE  # a piece that begins beyond the end belongs to the next chunk
        for length in range(1, s + 1):
            ends[length : length + n, c, length - 1] = weights[: most + s - length, length - 1]
        all_arcs.append(arcs)
    start = np.where(np.eye(s, dtype=bool), 0, _NONE)[None].repeat(k, 0) if entry is None else entry.reshape(k, 1, s)
    best = np.full((most + 2 * s, k, start.shape[1]), _NONE, np.int64)  # s cells in front of the chunk
    back = np.zeros((most + s, k), np.int8)
    for j in range(most + s):
        value = best[j : j + s] + ends[j].T[::-1, :, None]  # lengths s .. 1
        top = value.max(axis=0)
        if entry is not None:
            back[j] = s - value[:, :, 0].argmax(axis=0)
        if j < s:
            # a path that comes in over the boundary has the longer last piece
            if entry is not None:
                over = (start[:, 0, j] > _NONE // 2) & (start[:, 0, j] >= top[:, 0])
                back[j, over] = 0
            top = np.maximum(top, start[:, :, j])
        best[j + s] = np.maximum(top, _NONE)
    end = np.stack([best[own[c] + s : own[c] + 2 * s, c].T for c in range(k)])
    return np.where(end > _NONE // 2, end, _NONE), back, all_arcs


def chunk_matrices(v: Vocabulary, texts: list[str], own: np.ndarray) -> np.ndarray:
    """Max-plus transfer matrix of each chunk: [characters taken at the start, characters taken beyond the end]."""
    return _run(v, texts, own, None)[0]


def start_states(v: Vocabulary, texts: list[str], own: np.ndarray, entry: np.ndarray) -> list[list[int]]:
    """For each chunk and number of characters taken beyond its end, those taken at its start on the best path (-1: none)."""
    end, back, _ = _run(v, texts, own, entry)
    out = []
    for c in range(len(texts)):
        came = []
        for t in range(v.longest):
            j = int(own[c]) + t
            while end[c, 0, t] > _NONE // 2 and back[j, c] > 0:
                j -= int(back[j, c])
            came.append(j if end[c, 0, t] > _NONE // 2 else -1)
        out.append(came)
    return out


def trace(v: Vocabulary, texts: list[str], own: np.ndarray, entry: np.ndarray, state: np.ndarray) -> list[np.ndarray]:
    """For each chunk the ids of the pieces that begin in it, on the best path that takes ``state`` characters beyond its end."""
    _, back, arcs = _run(v, texts, own, entry)
    out = []
    for c, text in enumerate(texts):
        j, at, lengths = int(own[c] + state[c]), [], []
        while back[j, c] > 0:
            lengths.append(int(back[j, c]))
            j -= lengths[-1]
            at.append(j)
        at, lengths = np.array(at[::-1], np.int64), np.array(lengths[::-1], np.int64)
        out.append(_expand(v, arcs[c][at, lengths - 1], _points(text)[at])[0] if len(at) else np.zeros(0, np.int32))
    return out


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of stacked matrices in the (max, +) semiring."""
    out = np.full(a.shape, _NONE, np.int64)
    for k in range(a.shape[2]):
        np.maximum(out, a[:, :, k, None] + b[:, None, k, :], out=out)
    return np.where(out > _NONE // 2, out, _NONE)


def scan(matrices: np.ndarray) -> np.ndarray:
    """All prefix products, by pairs: depth log n, every level in one step."""
    n = len(matrices)
    if n == 1:
        return matrices
    pairs = scan(max_plus(matrices[0 : n - n % 2 : 2], matrices[1::2]))
    out = np.empty_like(matrices)
    out[1::2] = pairs
    out[0] = matrices[0]
    if n > 2:
        out[2::2] = max_plus(pairs[: len(matrices[2::2])], matrices[2::2])
    return out


def _few(batches, n: int = 64):
    """Rows of chunks, as many as are solved side by side."""
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def _entry(rows: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.frombuffer(e, np.int64) for e in rows.column("entry").to_pylist()])


def _giant_ids(giants: DataFrame, path: str) -> DataFrame:
    """``key, ids`` of the distinct texts of ``giants`` (key, text)."""

    def cut(batches):
        s = vocabulary_at(path).longest
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                norm = BLANK + text.replace(" ", BLANK)
                for c, at in enumerate(range(0, len(norm), CHUNK)):
                    yield pa.record_batch([pa.array([key]), pa.array([c], pa.int64()), pa.array([min(CHUNK, len(norm) - at)], pa.int64()), pa.array([norm[at : at + CHUNK + s - 1]])], names=["key", "chunk", "own", "piece"])

    chunks = materialise(giants.dropDuplicates(["key"]).mapInArrow(cut, "key string, chunk long, own long, piece string"), "giant-chunks")
    spread = chunks.repartition("key", "chunk")

    def matrices(batches):
        v = vocabulary_at(path)
        for rows in _few(batches):
            got = chunk_matrices(v, rows.column("piece").to_pylist(), rows.column("own").to_numpy())
            yield pa.record_batch([rows.column("key"), rows.column("chunk"), pa.array([m.tobytes() for m in got], pa.binary())], names=["key", "chunk", "matrix"])

    def entries(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        stack = np.stack([np.frombuffer(m, np.int64) for m in rows.column("matrix").to_pylist()])
        s = int(round(stack.shape[1] ** 0.5))
        sums = scan(stack.reshape(-1, s, s))[:, 0]
        first = np.where(np.arange(s) == 0, 0, _NONE)
        entry = np.concatenate(([first], sums[:-1]))
        return pa.table({"key": rows.column("key"), "chunk": rows.column("chunk"), "entry": pa.array([e.tobytes() for e in entry], pa.binary())})

    at = spread.mapInArrow(matrices, "key string, chunk long, matrix binary").groupBy("key").applyInArrow(entries, "key string, chunk long, entry binary")
    entered = materialise(chunks.join(at, ["key", "chunk"]), "giant-entries")

    def maps(batches):
        v = vocabulary_at(path)
        for rows in _few(batches):
            got = start_states(v, rows.column("piece").to_pylist(), rows.column("own").to_numpy(), _entry(rows))
            yield pa.record_batch([rows.column("key"), rows.column("chunk"), pa.array(got, pa.list_(pa.int32()))], names=["key", "chunk", "came_from"])

    def states(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("chunk", "descending")])
        state, out = 0, []
        for came_from in rows.column("came_from").to_pylist():
            out.append(state)
            state = came_from[state]
        return pa.table({"key": rows.column("key"), "chunk": rows.column("chunk"), "state": pa.array(out, pa.int32())})

    ends = entered.mapInArrow(maps, "key string, chunk long, came_from array<int>").groupBy("key").applyInArrow(states, "key string, chunk long, state int")

    def pieces(batches):
        v = vocabulary_at(path)
        for rows in _few(batches):
            got = trace(v, rows.column("piece").to_pylist(), rows.column("own").to_numpy(), _entry(rows), rows.column("state").to_numpy())
            yield pa.record_batch([rows.column("key"), rows.column("chunk"), pa.array(got, pa.list_(pa.int32()))], names=["key", "chunk", "ids"])

    traced = entered.join(ends, ["key", "chunk"]).mapInArrow(pieces, "key string, chunk long, ids array<int>")
    whole = traced.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    return whole.select("key", F.flatten(F.col("parts.ids")).alias("ids"))


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>, replacing one of that name); the other columns unchanged.

    NULL and empty texts have no ids. Equal texts have equal ids. The path must be there on every executor.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    kept = [c for c in docs.columns if c != ids]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    long = F.coalesce(F.length(F.col(f"`{text}`").cast("string")), F.lit(0)) > GIANT

    def small(batches):
        v = vocabulary_at(model_path)
        for batch in batches:
            texts = pa.record_batch([batch.column(kept.index(text)).cast(pa.string())], names=["text"])
            at = 0
            for part in slices(texts, "text", 1 << 20):
                flat, bounds = encode_small(v, filled(part.column("text")))
                rows = batch.slice(at, part.num_rows)
                at += part.num_rows
                give_back()
                yield pa.record_batch([*rows.columns, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))], names=[*kept, ids])

    schema = StructType([*base.schema.fields]).add(ids, ArrayType(IntegerType()))
    short = base.where(~long).mapInArrow(small, schema)
    key = F.sha2(F.col(f"`{text}`").cast("string"), 256)
    giants = base.where(long)
    found = _giant_ids(giants.select(key.alias("key"), F.col(f"`{text}`").cast("string").alias("text")), model_path)
    solved = giants.withColumn("__key", key).join(found.select(F.col("key").alias("__key"), F.col("ids").alias("__ids")), "__key")
    return short.unionAll(solved.select(*[F.col(f"`{c}`") for c in kept], F.col("__ids").alias(ids)))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``text`` (replacing one of that name) decoded from ``ids``; NULL ids are an empty text."""
    from pyspark.sql.types import StringType, StructType

    kept = [c for c in encoded.columns if c != text]
    base = encoded.select(*[F.col(f"`{c}`") for c in kept])

    def back(batches):
        v = vocabulary_at(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                lists = pc.fill_null(rows.column(kept.index(ids)), pa.scalar([], rows.column(kept.index(ids)).type))
                bounds = np.asarray(lists.offsets).astype(np.int64)
                texts = decode_texts(v, lists.flatten().to_numpy(zero_copy_only=False), bounds - bounds[0])
                yield pa.record_batch([*rows.columns, pa.array(texts, pa.string())], names=[*kept, text])

    return base.mapInArrow(back, StructType([*base.schema.fields]).add(text, StringType()))
