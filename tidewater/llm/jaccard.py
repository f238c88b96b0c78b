"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, and their components.

1. Every text becomes a set of hashed n-grams. Equal sets are one set from here on, whatever the number of copies.
2. Groups are found by size class. Two sets that link differ in at most H elements, with H fixed by their class; hashing
   the elements into more than H parts leaves at least one part equal in both. The sets that share a part of a class are a
   group; groups of the same sets are one.
3. Each set is compared with the least set of each of its groups, which joins most near copies. From here on only groups of
   three or more sets that hold several components are looked at, each by itself: sets that share no part are never compared,
   however they hang together through others.
4. Sets are compared by hashed bitmaps: bits that differ bound the elements that differ from below, hence the overlap from
   above. A group returns a forest that spans its pairs of sets within the bound, never all pairs. A group larger than a tile
   is cut into tiles by size band, and pairs of tiles whose bands can link are compared.
5. The pairs of the forest are checked on the sorted arrays. Links join components; where a pair was no link, the next round
   offers other pairs between the same components, until none is left that is not joined or checked.

Nothing is sampled or capped: a larger group has more tiles. A size band of t tiles in one group repeats its bitmaps t times,
the price of exact links among many sets that share a part and are no near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.components import components
from tidewater.llm.texts import filled, give_back, mixed, ragged, rows_of, slices, word_hashes, words_of
from tidewater.llm.scratch import materialise, released

#: Sets in a tile, on average; a task holds two tiles of bitmaps.
TILE = 1024
#: Up to so many sets are compared at once.
_AT_ONCE = 64
#: 64-bit words of a small set's bitmap, a power of two.
BITMAP_WORDS = 32


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit n-gram hashes of each text (A-Z lower-cased), and their bounds. A text with 1 to n-1 words
    has one element, its whole sequence; one without words has none."""
    found = words_of(texts)
    h = word_hashes(found.vocabulary)[found.codes]
    size = np.diff(found.bounds)
    row = rows_of(found.bounds)
    grams = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        grams = mixed(grams + h[k : len(h) - n + 1 + k] + np.uint64(k + 1)) if len(grams) else grams
    inside = row[: len(grams)] == row[n - 1 :] if len(grams) else np.zeros(0, bool)
    rows, values = row[: len(grams)][inside], grams[inside]
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        whole = []
        for d in short:
            x = np.uint64(1_000_003 + size[d])
            for w in h[found.bounds[d] : found.bounds[d + 1]]:
                x = mixed(np.array([x ^ w]))[0]
            whole.append(x)
        rows, values = np.concatenate((rows, short)), np.concatenate((values, np.array(whole, np.uint64)))
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    if len(rows):
        first = np.concatenate(([True], (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])))
        rows, values = rows[first], values[first]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts)))))
    return values, bounds


def _sums(values: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by slot, wrapped: two exact sums of 32-bit halves."""
    low = np.bincount(slot, weights=(values & np.uint64(0xFFFFFFFF)).astype(float), minlength=n)
    high = np.bincount(slot, weights=(values >> np.uint64(32)).astype(float), minlength=n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def set_ids(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit id of each set, as two 64-bit integers."""
    row, n = rows_of(bounds), len(bounds) - 1
    a = mixed(_sums(mixed(values ^ np.uint64(0x9E3779B97F4A7C15)), row, n) + np.diff(bounds).astype(np.uint64))
    b = mixed(_sums(mixed(values ^ np.uint64(0xD1B54A32D192ED03)), row, n))
    return a.view(np.int64), b.view(np.int64)


def size_bands(percent: int, largest: int) -> np.ndarray:
    """First sizes of the bands: a set links only with sets of its own band and the two beside it."""
    firsts = [1]
    while firsts[-1] <= largest:
        firsts.append(100 * firsts[-1] // percent + 1)
    return np.array(firsts, np.int64)


def size_classes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the smaller set's size: first sizes, parts, and how many parts are spare.

    Sets of which the smaller has at most ``a`` elements link only if they differ in at most H of them, so of H + 1 + spare
    parts at least 1 + spare are equal. Spare parts are as many as may well be empty in a set of the class.
    """
    firsts = [1]
    while firsts[-1] <= largest:
        firsts.append(max(firsts[-1] + 1, firsts[-1] * 3 // 2))
    firsts.append(firsts[-1] * 2)
    first = np.array(firsts, np.int64)
    a = first[1:] - 1
    differ = (100 - percent) * (a + 100 * a // percent) // (100 + percent)
    spare = 1 + np.ceil(3 * (differ + 2) * np.exp(-first[:-1] / (differ + 2.0))).astype(np.int64)
    return first, np.where(differ > 0, differ + 1 + spare, 0), spare  # without a difference only equal sets link


def part_signatures(values: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all parts of each set, and the set of each: for the class of its size, and for the class below if it can
    be the larger partner there."""
    size = np.diff(bounds)
    first, all_parts, all_spare = size_classes(percent, int(size.max(initial=1)) + 1)
    own = np.searchsorted(first, size, "right") - 1
    row = rows_of(bounds)
    scrambled = mixed(values ^ np.uint64(0x2545F4914F6CDD1D))
    out, owners = [], []
    for below in (False, True):
        level = np.maximum(own - below, 0)
        use = size > 0
        if below:
            use &= (own > 0) & (size <= 100 * (first[own] - 1) // percent)
        parts = np.where(use, all_parts[level], 0)
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        if not total:
            continue
        mine = parts[row] > 0
        r = row[mine]
        slot = base[r] + (values[mine] % parts[r].astype(np.uint64)).astype(np.int64)
        sums, held = _sums(scrambled[mine], slot, total), np.bincount(slot, minlength=total)
        owner = np.repeat(np.arange(len(size)), parts)
        place = (np.arange(total) - base[owner]).astype(np.uint64)
        sig = mixed(sums + mixed((level[owner].astype(np.uint64) << np.uint64(32)) + place) + held.astype(np.uint64))
        # equal empty parts say nothing: left out, unless more are empty than there are spare ones
        empty = held == 0
        many = np.bincount(owner, weights=empty, minlength=len(size)) > all_spare[level]
        keep = ~empty | many[owner]
        out.append(sig[keep])
        owners.append(owner[keep])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out).view(np.int64), np.concatenate(owners)


def bitmaps(values: np.ndarray, bounds: np.ndarray, words: int = BITMAP_WORDS) -> list[np.ndarray]:
    """Per set, one bit per hash value, flipped by each element there: bits that differ between two sets are at most the
    elements that differ. Large sets have more bits, by powers of two, so that two for each element are there."""
    size = np.diff(bounds)
    n_words = np.maximum(words, 1 << np.ceil(np.log2(np.maximum(size, 1) * 2 / 64)).clip(0).astype(np.int64))
    base = np.cumsum(n_words) - n_words
    row = rows_of(bounds)
    at = base[row] * 64 + (mixed(values) % (n_words[row] * 64).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=int(n_words.sum()) * 64) & 1).astype(np.uint8)).view(np.uint64)
    return [odd[x : x + w] for x, w in zip(base, n_words)]


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """The bitmaps at the size of the smallest: halves of a larger one are laid over each other."""
    least = min(map(len, maps))
    out = []
    for m in maps:
        while len(m) > least:
            m = m[: len(m) // 2] ^ m[len(m) // 2 :]
        out.append(m)
    return np.stack(out)


def within_bound(size: np.ndarray, maps: np.ndarray, percent: int, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` that set ``i`` may link with, by the bits in which their bitmaps differ."""
    differ = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
    most = (size[others] + size[i] - differ) // 2
    return others[(100 * most >= percent * (size[others] + size[i] - most)) & (others != i)]


def _any_within(size: np.ndarray, maps: np.ndarray, label: np.ndarray, percent: int) -> bool:
    """Whether any two sets with different labels may link, as in ``within_bound``."""
    both = size[:, None] + size
    most = (both - np.bitwise_count(maps[:, None] ^ maps).sum(axis=2, dtype=np.int64)) // 2
    return bool(((100 * most >= percent * (both - most)) & (label[:, None] != label)).any())


def spanning(size, maps, label, percent: int, left, right, checked: list[set[int]], each: int) -> list[tuple[int, int]]:
    """Pairs within the bound that span all such pairs of ``left`` and ``right`` with different labels: up to ``each`` for two
    labels; pairs in ``checked`` (known to be no links) are left out."""
    if len(size) <= _AT_ONCE and not _any_within(size, maps, label, percent):
        return []
    label, out, offered = label.copy(), [], {}
    for i in left:
        may = right[label[right] != label[i]]
        if not len(may):
            continue
        for j in within_bound(size, maps, percent, i, may):
            x, y = label[i], label[j]
            if x == y or int(j) in checked[i]:
                continue
            out.append((int(i), int(j)))
            key = (min(x, y), max(x, y))
            offered[key] = offered.get(key, 0) + 1
            if offered[key] >= each:
                label[label == y] = x
    return out


def _tiled(groups: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The sets of each group (``cluster``, of ``m`` sets) with their columns of ``members``, repeated for each pair of tiles they
    take part in: column ``pair``, and ``side`` 0, 1 or 2 (both). A group that fits into a tile is one pair.

    The tiles are laid out without the bitmaps, which are joined at the end.
    """
    wide = members.select("a", "b", "n", "bits", "root", "checked")
    whole = groups.where(F.col("m") <= TILE).select("cluster", "a", "b", F.lit("").alias("pair"), F.lit(2).alias("side"))
    large = groups.where(F.col("m") > TILE).select("cluster", "a", "b")
    if not large.isEmpty():
        whole = whole.unionAll(_cut(large.join(members.select("a", "b", "n"), ["a", "b"]), percent))
    return whole.join(wide, ["a", "b"]).select("cluster", "pair", "side", "a", "b", "n", "bits", "root", "checked")


def _cut(members: DataFrame, percent: int) -> DataFrame:
    """``cluster, a, b, pair, side`` of the sets of large groups, by size band."""
    largest = members.agg(F.max("n")).first()[0] or 1
    firsts = F.array(*[F.lit(int(x)) for x in size_bands(percent, largest)])
    members = members.withColumn("band", F.size(F.filter(firsts, lambda x: x <= F.col("n"))).cast("long"))
    tiles = members.groupBy("cluster", "band").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("long").alias("tiles"))
    members = members.join(tiles, ["cluster", "band"]).withColumn("tile", F.pmod(F.xxhash64("a", "b", F.lit(7)), F.col("tiles")))
    above = tiles.select("cluster", (F.col("band") - 1).alias("band"), F.col("tiles").alias("above"))
    below = tiles.select("cluster", (F.col("band") + 1).alias("band"), F.col("tiles").alias("below"))
    members = members.join(above, ["cluster", "band"], "left").join(below, ["cluster", "band"], "left")

    def key(band1, tile1, band2, tile2, side):
        return F.struct(F.concat_ws(":", band1.cast("string"), tile1.cast("string"), band2.cast("string"), tile2.cast("string")).alias("pair"), side.alias("side"))

    band, tile = F.col("band"), F.col("tile")
    same = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda q: key(band, F.least(q, tile), band, F.greatest(q, tile), F.when(q == tile, 2).when(tile < q, 0).otherwise(1)),
    )
    upper = F.transform(F.sequence(F.lit(0).cast("long"), F.col("above") - 1), lambda q: key(band, tile, band + 1, q, F.lit(0)))
    lower = F.transform(F.sequence(F.lit(0).cast("long"), F.col("below") - 1), lambda q: key(band - 1, q, band, tile, F.lit(1)))
    pairs = [same, *[F.when(F.col(n).isNotNull(), x).otherwise(F.array()) for n, x in (("above", upper), ("below", lower))]]
    laid = members.select("cluster", "a", "b", F.explode(F.concat(*pairs)).alias("at"))
    return laid.select("cluster", "a", "b", F.col("at.pair").alias("pair"), F.col("at.side").alias("side"))


#: A pair of sets that may link, with the roots of their components so far.
_PAIR = ["a1", "b1", "a2", "b2", "root1", "root2"]
_PAIR_SCHEMA = "a1 long, b1 long, a2 long, b2 long, root1 string, root2 string"


def _tied(percent: int):
    """Pairs of sets with both sizes and bitmaps: those within the bound."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [batch.column(c).to_numpy() for c in ("n1", "n2")]
            differ = np.zeros(batch.num_rows, np.int64)
            for i, maps in enumerate(zip(batch.column("bits1"), batch.column("bits2"))):
                one, two = folded([np.frombuffer(m.as_buffer(), np.uint64) for m in maps])
                differ[i] = np.bitwise_count(one ^ two).sum(dtype=np.int64)
            most = (size[0] + size[1] - differ) // 2
            yield batch.select(_PAIR).filter(pa.array(100 * most >= percent * (size[0] + size[1] - most)))
        give_back()

    return compare


def _compare(percent: int, each: int):
    def flush(rows: list[tuple]) -> list[tuple]:
        side = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if len(rows) < 2 or not len(left) or not len(right):
            return []
        size = np.array([r[3] for r in rows], np.int64)
        maps = folded([np.frombuffer(r[4], np.uint64) for r in rows])
        label = np.unique(np.array([r[5] for r in rows], object), return_inverse=True)[1]
        place = {f"{r[1]}:{r[2]}": i for i, r in enumerate(rows)}
        checked = [{place[x] for x in r[6] or () if x in place} for r in rows]
        found = spanning(size, maps, label, percent, left, right, checked, each)
        return [(*rows[i][1:3], *rows[j][1:3], rows[i][5], rows[j][5]) for i, j in found]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out(cluster, found):
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            cols = [pa.array([cluster] * len(found), pa.int64()), *(pa.array(c, kind) for c, kind in zip(zip(*found), kinds))]
            return pa.record_batch(cols, names=["cluster", *_PAIR])

        for batch in batches:
            keys = list(zip(batch.column("cluster").to_pylist(), batch.column("pair").to_pylist()))
            columns = [batch.column(c).to_pylist() for c in ("side", "a", "b", "n", "bits", "root", "checked")]
            for i, key in enumerate(keys):
                if key != now:
                    if found := flush(rows) if rows else []:
                        yield out(now[0], found)
                    now, rows = key, []
                rows.append(tuple(c[i] for c in columns))
        if found := flush(rows) if rows else []:
            yield out(now[0], found)
        rows.clear()
        give_back()

    return compare


def _node(x: str, y: str) -> Column:
    return F.concat_ws(":", F.col(x).cast("string"), F.col(y).cast("string"))


def _checked(pairs: DataFrame, arrays, percent: int) -> DataFrame:
    """``pairs`` with ``link``: whether the sorted arrays of the two sets (``arrays`` of the sets ``a, b``) share enough."""
    sets = arrays(pairs.select(F.col("a1").alias("a"), F.col("b1").alias("b")).union(pairs.select("a2", "b2")).distinct())
    first = sets.select(F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("grams").alias("x"))
    second = sets.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("grams").alias("y"))

    def check(batches):
        for batch in batches:
            xs, ys = batch.column("x"), batch.column("y")
            link = []
            for i in range(batch.num_rows):
                x, y = xs[i].values.to_numpy(zero_copy_only=False), ys[i].values.to_numpy(zero_copy_only=False)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                link.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.record_batch([*(batch.column(c) for c in _PAIR), pa.array(link, pa.bool_())], names=[*_PAIR, "link"])
        give_back()

    both = pairs.join(first, ["a1", "b1"]).join(second, ["a2", "b2"]).select(*_PAIR, "x", "y")
    return both.mapInArrow(check, f"{_PAIR_SCHEMA}, link boolean")


def _linked(members: DataFrame, groups: DataFrame, arrays, percent: int) -> DataFrame:
    """``node, root`` of all sets of ``members``: components of the links inside the ``groups``.

    The first round compares each set with the least one of its groups. Each later one takes the groups that are still open,
    with the components found so far, and looks at pairs of different components only; its links join components of the
    contracted graph, a node for each component. A group is done when all its pairs of a round link, as its forest spans all
    pairs within the bound, or when it is in one component.
    """
    node, none = _node("a", "b"), F.array().cast("array<string>")
    state = members.select("a", "b", node.alias("node"), node.alias("root"), none.alias("checked"))
    one, two = (members.select(*[F.col(c).alias(f"{c}{k}") for c in ("a", "b", "n", "bits")], node.alias(f"root{k}")) for k in (1, 2))
    ties = groups.where("a <> least").select(F.col("a").alias("a1"), F.col("least").alias("a2")).distinct().join(one, "a1").join(two, "a2")
    ties = ties.where(100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")).select(*_PAIR, "n1", "n2", "bits1", "bits2")
    offered = materialise(ties.mapInArrow(_tied(percent), _PAIR_SCHEMA), "jaccard-offered")
    # in a group of two the tie is the only pair
    open_, least, each = groups.select("cluster", "a"), 3, 1
    while True:
        found = materialise(_checked(offered.select(*_PAIR).distinct(), arrays, percent), "jaccard-pairs")
        failed = found.where("not link")
        moved = materialise(components(found.where("link").select(F.col("root1").alias("u"), F.col("root2").alias("v"))), "jaccard-roots")
        state = state.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").withColumn("root", F.coalesce("to", "root"))
        first, second = _node("a1", "b1"), _node("a2", "b2")
        no = failed.select(first.alias("node"), second.alias("o")).union(failed.select(second.alias("node"), first.alias("o"))).groupBy("node").agg(F.collect_set("o").alias("no"))
        state = state.join(no, "node", "left").select("a", "b", "node", "root", F.array_union("checked", F.coalesce("no", none)).alias("checked"))
        state = materialise(state, "jaccard-state")
        if "cluster" in offered.columns:  # a group with a failed pair is open while it has several components
            pair = ["a1", "b1", "a2", "b2"]
            open_ = open_.join(offered.join(failed.select(*pair), pair, "left_semi").select("cluster").distinct(), "cluster", "left_semi")
        labelled = open_.join(state.select("a", "b", "root"), "a").select("cluster", "a", "b", "root")
        several = labelled.groupBy("cluster").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m")).where((F.col("x") != F.col("y")) & (F.col("m") >= least))
        groups = materialise(labelled.join(several.select("cluster", "m"), "cluster").select("cluster", "a", "b", "m"), "jaccard-open")
        if groups.isEmpty():
            return state.select("node", "root")
        tiled = _tiled(groups, state.join(members, ["a", "b"]), percent).repartition("cluster", "pair").sortWithinPartitions("cluster", "pair")
        offered = materialise(tiled.mapInArrow(_compare(percent, each), f"cluster long, {_PAIR_SCHEMA}"), "jaccard-offered")
        open_, least, each = groups.select("cluster", "a").distinct(), 2, each * 4


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash``, ``n_shingles``, ``component`` (text, equal within a component)
    and ``component_id`` (its least id).

    Texts link when ``100 * shared >= percent * union`` of their n-gram sets. NULL and empty texts have no set, link with
    nothing and keep their own id. Equal rows give equal rows; NULL ids count as larger than others, so a component_id is
    NULL only where all ids are. Other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def sets(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, bounds = shingle_sets(filled(part.column("text")), n)
                a, b = set_ids(values, bounds)
                yield pa.record_batch([part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(bounds)), pa.array(a), pa.array(b)], names=["doc_id", "text_hash", "n", "a", "b"])
        give_back()

    def signatures(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, bounds = shingle_sets(filled(part.column("text")), n)
                a, sizes = set_ids(values, bounds)[0], np.diff(bounds)
                first = np.unique(a, return_index=True)[1]
                first = first[sizes[first] > 0]
                some = values[ragged(bounds[first], sizes[first])]
                sig, owner = part_signatures(some, np.concatenate(([0], np.cumsum(sizes[first]))), percent)
                yield pa.record_batch([pa.array(sig), pa.array(a[first][owner])], names=["sig", "a"])
        give_back()

    table = materialise(texts.mapInArrow(sets, f"doc_id {kind}, text_hash long, n long, a long, b long"), "jaccard-sets")
    # a group for each part that several sets share, numbered by its sets: groups of the same sets are one
    sigs, by_sig = texts.select("text").mapInArrow(signatures, "sig long, a long"), Window.partitionBy("sig")
    shared = sigs.select("sig", "a", F.min("a").over(by_sig).alias("least"), F.max("a").over(by_sig).alias("most")).where("least <> most").select("sig", "a", "least").distinct()
    groups = shared.select(F.bit_xor(F.xxhash64("a")).over(by_sig).alias("cluster"), "a", "least").distinct()
    groups = materialise(groups, "jaccard-groups")

    chosen = table.where("n > 0").join(groups.select("a").distinct(), "a").groupBy("a", "b").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    chosen = materialise(chosen.select("a", "b", "one.doc_id", "one.text_hash"), "jaccard-chosen")

    map_words = BITMAP_WORDS

    def of_texts(rows: DataFrame, column: str, values_of) -> DataFrame:
        """``a, b, n`` and ``column`` of the sets of the ``chosen`` documents in ``rows``."""

        def read(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    values, bounds = shingle_sets(filled(part.column("text")), n)
                    a, b = set_ids(values, bounds)
                    yield pa.record_batch([pa.array(a), pa.array(b), pa.array(np.diff(bounds)), values_of(values, bounds)], names=["a", "b", "n", column])
            give_back()

        # few rows are wanted: the condition, true for each of them, lets Spark filter the texts by their hashes first
        right = rows.where("text_hash is not null").select(F.col("text_hash").alias("h"), F.col("doc_id").alias("d"))
        picked = texts.join(right, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("text")
        kind = "binary" if column == "bits" else "array<long>"
        # repeated rows of the one chosen document are one member
        found = picked.mapInArrow(read, f"a long, b long, n long, {column} {kind}").dropDuplicates(["a", "b"])
        return materialise(found, f"jaccard-{column}", few_match=True)

    def arrays(sets: DataFrame) -> DataFrame:
        lists = lambda values, bounds: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
        return of_texts(chosen.join(sets, ["a", "b"], "left_semi"), "grams", lists)

    member = of_texts(chosen, "bits", lambda values, bounds: pa.array([m.tobytes() for m in bitmaps(values, bounds, map_words)], pa.binary()))
    linked = _linked(member, groups, arrays, percent)
    # ids by set first (copies meet before the shuffle), then by component
    least = F.min("doc_id").alias("least")
    by_set = table.where("n > 0").groupBy("a", "b").agg(least).withColumn("node", _node("a", "b")).join(linked, "node", "left")
    by_set = by_set.withColumn("component", F.coalesce("root", "node")).select("a", "b", "component", "least")
    ids = by_set.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = materialise(by_set.join(ids, "component").select("a", "b", "component", "component_id"), "jaccard-components")
    with_words = table.where("n > 0").join(of_set, ["a", "b"])
    without = table.where("n = 0").withColumn("component", F.lit(None).cast("string")).withColumn("component_id", F.col("doc_id"))
    out = [F.col("doc_id"), F.col("text_hash"), F.col("n").alias("n_shingles"), F.col("component"), F.col("component_id")]
    return with_words.select(*out).unionAll(without.select(*out))


def one_of_each(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near copies, all columns unchanged: the least id, of equal ids the least text hash.

    Rows without words link with nothing and all stay. Fully repeated rows are copies of each other, so one stays.
    """
    with released(docs.sparkSession):  # who stays is all that is read again
        found = jaccard_components(docs, n, percent, doc_id, text)
        kept = found.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"))).alias("one"))
        kept = materialise(kept.select(F.col("one.doc_id").alias("__d"), F.col("one.text_hash").alias("__h")), "jaccard-kept", outlives=True)
    has_words = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    key = F.xxhash64(F.col(text).cast("string"))
    chosen = docs.where(has_words).join(kept, (key == F.col("__h")) & F.col(doc_id).eqNullSafe(F.col("__d")), "left_semi")
    return chosen.dropDuplicates([doc_id, text]).select(*docs.columns).unionAll(docs.where(~has_words))
