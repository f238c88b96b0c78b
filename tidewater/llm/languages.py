"""Languages of texts by hyperdimensional profiles.

Every letter has a random vector of signs, drawn from its code point. A trigram's vector binds (multiplies) the vectors of
its letters, the first two of which are permuted (rotated) by their distance to the end, so that order counts. A text's
vector bundles (adds) those of its trigrams, a language's profile those of all its texts. A text gets the language whose
profile has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.scratch import materialise
from tidewater.llm.texts import filled, mixed, slices, text_bytes

#: Components of a vector. Unrelated trigrams have a cosine of about 1 / sqrt(DIMENSIONS).
DIMENSIONS = 1024
#: Rows bundled at once; with the trigrams of so many texts this bounds the table of counts.
BLOCK_ROWS = 256
#: Languages whose sums a task holds, and profiles that one pass over the texts compares with.
HELD_LANGUAGES = 256
#: Answer for texts without a letter.
UNDETERMINED = "und"


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, as code points, and the row of each.

    A run of other characters is one blank (0), and each text begins and ends with one; a text without a letter is one blank.
    """
    raw, _ = text_bytes(texts)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    folded = np.zeros(int(points.max()) + 1 if len(points) else 1, np.uint32)
    for point in np.flatnonzero(np.bincount(points)).tolist():
        letter = chr(point)
        if letter.isalpha():
            folded[point] = ord(letter.lower()[0])
    rows = np.repeat(np.arange(len(sizes)), sizes + 2)
    out = np.zeros(len(rows), np.uint32)
    out[np.arange(len(points)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1] = folded[points]
    kept = np.ones(len(out), bool)
    kept[1:] = (out[1:] != 0) | (out[:-1] != 0) | (rows[1:] != rows[:-1])
    return out[kept], rows[kept]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """Random bits of each code point, one row each; a set bit stands for -1."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    drawn = mixed(mixed(points.astype(np.uint64))[:, None] + words[None, :] + np.uint64(1))
    return np.unpackbits(drawn.view(np.uint8), axis=1)


def bundles(letters: np.ndarray, texts: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Sums of the trigram vectors of each row: ``rows`` says where the trigrams of each of ``texts`` are added up."""
    inside = texts[2:] == texts[:-2] if len(texts) > 2 else np.zeros(0, bool)
    if not inside.any():
        return np.zeros((n_rows, DIMENSIONS), np.int64)
    alphabet, codes = np.unique(letters, return_inverse=True)
    size = len(alphabet)
    grams, which = np.unique(((codes[:-2] * size + codes[1:-1]) * size + codes[2:])[inside], return_inverse=True)
    counts = np.bincount(rows[texts[2:][inside]] * len(grams) + which, minlength=n_rows * len(grams)).reshape(n_rows, len(grams))
    bits = letter_vectors(alphabet)
    bound = np.roll(bits, 2, axis=1)[grams // (size * size)]
    bound ^= np.roll(bits, 1, axis=1)[grams // size % size]
    bound ^= bits[grams % size]
    # whole numbers below 2 ** 24 are exact in single precision
    kind = np.float32 if len(which) < 1 << 24 else np.float64
    signs = np.subtract(1, 2 * bound.view(np.int8), dtype=kind)
    return (counts.astype(kind) @ signs).astype(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with their letters and the row of each letter, numbered from the run's first."""
    for part in slices(batch, "text"):
        for at in range(0, part.num_rows, BLOCK_ROWS):
            block = part.slice(at, BLOCK_ROWS)
            yield block, *letters_of(filled(block.column("text")))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def flushed() -> pa.RecordBatch:
        names = np.repeat(np.arange(len(held)), DIMENSIONS)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.string()).take(pa.array(names)),
                pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(held))),
                pa.array(np.concatenate([np.zeros(0, np.int64), *held.values()])),
            ],
            ["lang", "at", "value"],
        )
        held.clear()
        return out

    for batch in batches:
        for block, letters, texts in _blocks(batch):
            coded = block.column("lang").dictionary_encode()
            rows = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for name, vector in zip(coded.dictionary.to_pylist(), bundles(letters, texts, rows, len(coded.dictionary))):
                held[name] = held[name] + vector if name in held else vector
            if len(held) > HELD_LANGUAGES:
                yield flushed()
    yield flushed()


def learn(docs: DataFrame) -> DataFrame:
    """``lang, profile`` (array of ``DIMENSIONS`` longs) of every language of ``docs`` with a letter in its texts.

    ``docs`` has ``text`` and ``lang``; rows with a NULL in either add nothing. Sums are whole numbers, so that the result does
    not depend on how rows are dealt; every task adds up its own rows first, however many one language has.
    """
    known = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = known.mapInArrow(_sums, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda s: s["value"])
    return sums.groupBy("lang").agg(in_order.alias("profile")).where(F.exists("profile", lambda v: v != 0))


def predict(docs: DataFrame, profiles: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the profile of the largest cosine, and that cosine (0 if below).

    Equal cosines (to nine digits) go to the first name. NULL texts and texts without a letter are ``und`` with 0, as are all
    texts where there is no profile. Equal rows give equal rows; other columns are not read. Profiles are compared with in
    blocks of ``HELD_LANGUAGES``, one pass over the texts for each, so that a task holds no more of them.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    # a window over all profiles: one row per language
    ranked = profiles.withColumn("block", F.floor((F.row_number().over(Window.orderBy("lang")) - 1) / HELD_LANGUAGES).cast("int"))
    ranked = materialise(ranked, "profiles")
    n_blocks = (ranked.agg(F.max("block")).first()[0] or 0) + 1
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = found.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(-2.0)})
    for block in range(n_blocks):
        held = ranked.where(F.col("block") == block).orderBy("lang").select("lang", "profile").collect()
        names = [r.lang for r in held]
        matrix = np.array([r.profile for r in held], dtype=np.float64).reshape(len(held), DIMENSIONS)
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        found = found.mapInArrow(_compared(names, matrix), f"doc_id {kind}, text string, lang_pred string, score double")
    return found.select("doc_id", "lang_pred", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def _compared(names: list[str], profiles: np.ndarray):
    """A function over batches that puts in the best of these profiles where it is better than what a row has."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, letters, texts in _blocks(batch):
                n = block.num_rows
                vectors = bundles(letters, texts, np.arange(n), n).astype(np.float64)
                lengths = np.linalg.norm(vectors, axis=1)
                with_letters = np.bincount(texts[letters > 0], minlength=n) > 0
                score = block.column("score").to_numpy(zero_copy_only=False)
                best, at = np.full(n, -3.0), np.zeros(n, np.int64)
                if names:
                    cosines = np.round(vectors @ profiles.T / np.maximum(lengths, 1e-9)[:, None], 9)
                    at = cosines.argmax(axis=1)
                    best = cosines[np.arange(n), at]
                better = with_letters & (best > score)
                chosen = pa.array([names[k] if b else None for k, b in zip(at.tolist(), better.tolist())], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("text"), pc.coalesce(chosen, block.column("lang_pred").cast(pa.string())), pa.array(np.where(better, best, score))],
                    block.schema.names,
                )

    return compared
